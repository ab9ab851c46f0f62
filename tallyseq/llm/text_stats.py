"""Statistics of whole texts as Spark expressions: no Python runs on the executors.

A null text counts as an empty one, for which every statistic is 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Names of the statistics of a text.
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_shouts", "n_open_lines")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the text holds twice or more, the first included.

    Windows are compared by a 64-bit hash. Sorting them with their places puts equal
    ones side by side, so a text costs n log n however often it repeats itself.
    """
    last = F.size(words) - window

    def of_words(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return let(grams, of_grams)

    def of_grams(g: Column) -> Column:
        placed = F.sort_array(F.zip_with(g, F.sequence(F.lit(0), F.size(g) - 1), lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(placed, of_placed))

    def of_placed(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(twice, lambda x: x["p"])), of_places)

    def of_places(p: Column) -> Column:
        widths = F.transform(p, lambda at, i: F.coalesce(F.least(F.get(p, i + 1) - at, F.lit(window)), F.lit(window)))
        return F.aggregate(widths, F.lit(0), lambda a, b: a + b)

    return F.when(last < 1, F.lit(0)).otherwise(let(words, of_words)).cast("long")


def with_statistics(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add the statistics that the rules and the ranking use, as columns ``prefix`` + name; ``df`` has no column ``__words`` or ``__lines``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    inner = {"__words": F.array_remove(F.split(text, SPACE, -1), ""), "__lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))}
    w, lines = F.col("__words"), F.col("__lines")
    stats = {
        "n_words": F.size(w),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_window_words(w),
        "n_lines": F.size(lines),
        "n_distinct_words": F.size(F.array_distinct(w)),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_digits": F.regexp_count(text, F.lit(r"[0-9]")),
        "n_shouts": F.regexp_count(text, F.lit(r"!")),
        "n_open_lines": F.size(F.filter(lines, lambda x: ~x.rlike(r"[.!?:;,\"')\]][\x20\x09-\x0D]*$"))),
    }
    return df.withColumns(inner).withColumns({prefix + k: c.cast("long") for k, c in stats.items()}).drop(*inner)


def rates(prefix: str = "") -> dict[str, Column]:
    """The features that rules and ranking learn from, as ratios of the statistics."""
    s = lambda name: F.col(prefix + name)
    words, chars, lines = (F.greatest(s(x), F.lit(1)) for x in ("n_words", "word_chars", "n_lines"))
    return {
        "words": s("n_words").cast("double"),
        "word_length": s("word_chars") / words,
        "symbol_rate": s("n_symbols") / words,
        "dup_line_rate": s("n_dup_lines") / lines,
        "repeat_rate": s("n_repeat_words") / words,
        "distinct_rate": s("n_distinct_words") / words,
        "upper_rate": s("n_upper") / chars,
        "digit_rate": s("n_digits") / chars,
        "shout_rate": s("n_shouts") / words,
        "open_line_rate": s("n_open_lines") / lines,
    }


def labelled_features(docs: DataFrame, labels: DataFrame, bound: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep: Column | None = None) -> DataFrame:
    """``label`` (0 or 1), ``draw`` and the features of at most ``bound`` rows of ``docs`` that have a label.

    At most ``bound`` labels are drawn by a hash of their id and broadcast, so no text is shuffled. Where ids repeat
    the join makes more rows than labels; of all rows those of the lowest hash of id and text stay, so the
    bound holds for rows. ``keep`` filters the labels first, by the column ``__label_id``.
    """
    usable = labels.select(F.col(id_col).alias("__label_id"), F.col(label_col).cast("int").alias("__label")).where("__label in (0, 1) and __label_id is not null")
    if keep is not None:
        usable = usable.where(keep)
    place = F.pmod(F.xxhash64(F.col("__label_id"), F.lit(11)), F.lit(1 << 30))
    share = min(1.0, bound / max(1, usable.count()))
    drawn = usable.where(place < int(share * (1 << 30)) + 1).orderBy(place, "__label_id", "__label").limit(bound)
    rows = docs.select(F.col(id_col).alias("__doc_id"), F.col(text_col).alias("__text")).join(F.broadcast(drawn), F.col("__doc_id") == F.col("__label_id"))
    rows = with_statistics(rows.withColumn("__draw", F.xxhash64("__doc_id", "__text")), "__text")
    narrow = rows.select(F.col("__label").alias("label"), F.col("__draw").alias("draw"), *[c.alias(n) for n, c in rates().items()])
    return narrow.orderBy("draw", "label").limit(bound)
