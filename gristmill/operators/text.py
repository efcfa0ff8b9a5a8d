"""Word counts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import quoted

# Runs of anything Unicode calls white space, plus the four ASCII separators.
WHITESPACE = r"[\p{Z}\t\n\x0B\f\r\x85\x1C-\x1F]+"


def tokens(df: DataFrame, col: str, sep: str | None = " ") -> DataFrame:
    """One row ``word`` per token.

    With a separator, neighbouring separators enclose an empty token, which counts;
    ``sep=None`` splits on white-space runs and yields no empty tokens.
    """
    pattern = WHITESPACE if sep is None else re.escape(sep)
    words = df.select(F.explode(F.split(F.col(quoted(col)), pattern)).alias("word"))
    return words.where(F.col("word") != "") if sep is None else words


def word_count(df: DataFrame, col: str, sep: str | None = " ") -> DataFrame:
    """``word, n``. Counted per task before the shuffle, so frequent words cause no skew."""
    return tokens(df, col, sep).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
