"""Text to double, without ever raising on malformed input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the number the lenient mode looks for inside a text.
LENIENT_PATTERN = r"(-?\d+(?:\.\d+)?)"


def parse_number(col: str | Column, mode: str = "strict", pattern: str = LENIENT_PATTERN) -> Column:
    """Read ``col`` as a double after turning every decimal comma into a point.

    ``strict``  the whole text must be a number, anything else gives null;
    ``lenient`` the first match of ``pattern`` is the number, no match gives null.

    ``try_cast`` keeps both modes total under ANSI, where a plain cast raises.
    """
    source = F.col(col) if isinstance(col, str) else col
    pointed = F.translate(source.cast("string"), ",", ".")
    if mode == "strict":
        return pointed.try_cast("double")
    if mode == "lenient":
        return F.nullif(F.regexp_extract(pointed, pattern, 0), F.lit("")).try_cast("double")
    raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")
