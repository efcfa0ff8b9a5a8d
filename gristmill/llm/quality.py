"""Quality rules, line first: lines that fail are removed, then documents that lost too much.

Everything is built-in expressions over one row at a time: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.names import quoted

SPACE = " \t\n\x0b\f\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document that keeps less than this share of its characters after line cleaning is rejected.
MIN_KEPT_PERCENT = 50
TERMINAL = r"""[.!?:;…。！？]["'”’»)\]]*$"""
#: A line without a terminal mark passes with so many words and some mark inside.
LONG_LINE = 8
NAVIGATION = "[|»›•·>]"
MAX_NAVIGATION = 3
BOILERPLATE = (
    r"(?i)\b(javascript|cookies?|privacy policy|terms of (use|service)|all rights reserved|copyright|"
    r"subscribe|sign (in|up)|log ?in|lorem ipsum)\b|©"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def repeated_words(w: Column) -> Column:
    """Words in windows of ``WINDOW`` words that are found twice or more, the first included.

    Windows are compared by 64-bit hashes. A text without such a window, which is the usual case,
    costs one hash set; else equal windows are found by sorting, never by comparing all pairs.
    """

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            equal = lambda e, other: F.coalesce(other["x"] == e["x"], F.lit(False))
            found = F.filter(s, lambda e, i: equal(e, F.get(s, i - 1)) | equal(e, F.get(s, i + 1)))
            return F.sort_array(F.transform(found, lambda e: e["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return let(pairs, lambda s: let(places(s), total))

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
    )
    none = F.lit(0).cast("bigint")
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)))
    return F.when(F.size(w) < WINDOW + 1, none).otherwise(found)


def line_passes(line: Column) -> Column:
    """Whether a line that has words is text rather than navigation or boilerplate."""
    bare = F.btrim(line, F.lit(SPACE))
    ends = bare.rlike(TERMINAL)
    running = bare.rlike("[.,;:!?]") & (F.size(F.split(bare, "[\\x20\\x09-\\x0D]+")) >= LONG_LINE)
    menu = F.length(bare) - F.length(F.regexp_replace(bare, NAVIGATION, "")) >= MAX_NAVIGATION
    return (ends | running) & ~menu & ~bare.rlike(BOILERPLATE)


def assess(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``clean_text``, ``base_failed`` and ``kept``.

    Columns of these names are replaced. Null text counts as empty, fails the base rules and is not
    kept. ``clean_text`` has the lines that pass; lines without words neither pass nor count.
    """
    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    with_words = lambda lines: F.filter(lines, lambda x: F.btrim(x, F.lit(SPACE)) != "")
    counts = let(
        words(body),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    lines = let(
        with_words(F.split(body, "\n")),
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            F.length(F.array_join(x, "")).alias("chars"),
            F.filter(x, line_passes).alias("good"),
        ),
    )
    symbols = F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]", ""))
    measured = docs.withColumns({"__counts": counts, "__lines": lines, "n_symbols": symbols.cast("bigint")})
    c, x = F.col("__counts"), F.col("__lines")
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    enough = 100 * F.length(F.array_join(x["good"], "")) >= MIN_KEPT_PERCENT * x["chars"]
    return measured.withColumns(
        {n: c[n] for n in ("n_words", "word_chars", "n_repeat_words")}
        | {"n_dup_lines": x["n_dup_lines"], "clean_text": F.array_join(x["good"], "\n"), "base_failed": failed, "kept": ~failed & enough}
    ).drop("__counts", "__lines")
