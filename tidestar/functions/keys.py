"""Change priority and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank of a change operation; every other operation, and none, ranks 0.
OP_RANK = {"I": 1, "U": 2, "D": 3}


def op_priority(op: Column) -> Column:
    rank = F.lit(0)
    for code, value in OP_RANK.items():
        rank = F.when(op == code, F.lit(value)).otherwise(rank)
    return rank


def md5_hex(text: Column) -> Column:
    """Hex digest of the UTF-8 text."""
    return F.md5(text)


def surrogate_key(table: str, *parts: Column) -> Column:
    """The first 64 bits of MD5 over ``table|part|part...`` as a signed long.

    A null part is written as the text ``null``.
    """
    texts = [F.coalesce(part.cast("string"), F.lit("null")) for part in parts]
    digest = F.md5(F.concat_ws("|", F.lit(table), *texts))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")
