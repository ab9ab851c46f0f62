"""Column names of the caller beside those that an operator adds."""

from __future__ import annotations

from pyspark.sql import DataFrame

SUFFIX = "_input"


def clear_of(df: DataFrame, *added: str) -> DataFrame:
    """``df`` with each column that is named like one of ``added`` (in any case) renamed to name + ``_input``.

    The suffix is repeated until the name is free, so no column of the caller is lost or doubled.
    """
    taken = {x.lower() for x in added}
    used = {c.lower() for c in df.columns} | taken
    names = []
    for c in df.columns:
        if c.lower() in taken:
            while c.lower() in used:
                c += SUFFIX
            used.add(c.lower())
        names.append(c)
    return df if names == df.columns else df.toDF(*names)
