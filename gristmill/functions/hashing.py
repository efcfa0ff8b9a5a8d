"""Partition-independent row ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.names import quoted

RANK_BITS = 32


def key_rank(key: str | Sequence[str], salt: str = "") -> Column:
    """A number in ``[0, 2**32)`` that depends on the key values only, and on the ``salt``.

    It is the first eight hex digits of the key's md5, so the same rows are chosen
    whatever the partitioning, and any SQL engine can repeat the choice.
    """
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.col(quoted(n)).cast("string") for n in names]
    if len(parts) == 1:
        text = F.coalesce(parts[0], F.lit(""))
    else:
        # Lengths and a mark for null keep different composite keys apart.
        text = F.concat(*[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("-")) for p in parts])
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, RANK_BITS // 4), 16, 10).cast("bigint")
