"""Token counts by offsets: a text is encoded once, whole, and its tokens go to its sections.

The tokens of a byte-level vocabulary tile the text's UTF-8 bytes, so token ends are a
running sum of token lengths. Sections are intervals of bytes that tile the text as well
(by default its lines, each with its line feed). Tokens join to sections by a merge of the two
sorted lists. A token that crosses section boundaries belongs wholly to the section that holds most of its
bytes, of equals to the earlier one; ``n_crossing`` tells how many of a section's tokens do so.
The counts of a text's sections add up to its token count.

Defined results for odd input: a null or empty text has one empty section without tokens; a text of any
length is encoded whole; rows that repeat an id are counted each; an empty table gives an empty result; other columns
pass through, one that has the name of an added column as name + ``_input``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyseq.llm.names import clear_of

#: Columns of a section.
ADDED = ("section", "start_char", "end_char", "n_tokens", "n_crossing")

_encodings: dict[str, tuple] = {}


def load(path: str, pattern: str) -> tuple:
    """The encoding of a rank file and the byte length of each of its tokens."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _encodings[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _encodings[path]


def section_ends(data: bytes) -> np.ndarray:
    """Byte ends of the lines of a text, each with its line feed; a text without bytes has one empty line."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def attribute(token_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section, for the ascending byte ends of both."""
    starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(ends, starts, side="right")  # the section of a token's first byte
    last = np.searchsorted(ends, token_ends - 1, side="right")  # and of its last byte
    owner = first.copy()
    crossing = np.flatnonzero(first != last)
    for t in crossing:
        lo, hi = first[t], last[t]
        cuts = np.concatenate([[starts[t]], ends[lo:hi], [token_ends[t]]])
        owner[t] = lo + int(np.diff(cuts).argmax())
    n = len(ends)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def _char_ends(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Code points before each byte end."""
    heads = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(heads)])[ends]


def count_sections(text: str | None, encoding, sizes: np.ndarray) -> dict[str, np.ndarray]:
    data = (text or "").encode()
    ids = np.asarray(encoding.encode_to_numpy(text or "", disallowed_special=()))
    ends = section_ends(data)
    tokens, crossing = attribute(np.cumsum(sizes[ids]), ends)
    chars = _char_ends(data, ends)
    return {"start_char": np.concatenate([[0], chars[:-1]]), "end_char": chars, "n_tokens": tokens, "n_crossing": crossing}


def token_sections(text: Column, path: str, pattern: str) -> Column:
    """An array with one struct per section of a text."""
    names = ("start_char", "end_char", "n_tokens", "n_crossing")

    @F.pandas_udf(f"struct<{','.join(f'{n}: array<long>' for n in names)}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = load(path, pattern)
        for texts in batches:
            yield pd.DataFrame([count_sections(t, *own) for t in texts], columns=names)

    return run(text)


def token_counts(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """One row per section: the columns of ``docs`` without the text, ``section``, its characters and its tokens.

    ``path`` is a file of ranks that every executor has, ``pattern`` splits a text before merges.
    """
    named = clear_of(docs, *ADDED)
    text = named.columns[docs.columns.index(text_col)]
    keep = [c for c in named.columns if c != text]
    row = F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in keep]).alias("__row")
    rows = named.select(row, token_sections(named[text], path, pattern).alias("__s"))
    zipped = F.arrays_zip(*[F.col(f"__s.{n}").alias(n) for n in ("start_char", "end_char", "n_tokens", "n_crossing")])
    return rows.select("__row", F.posexplode(zipped).alias("section", "__x")).select("__row.*", "section", "__x.*").drop("__none")
