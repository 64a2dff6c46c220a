"""Column expressions over identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def circuit_id(session_id: Column) -> Column:
    """Third ``_``-separated token of a session id, null when there are fewer.

    Trailing separators are trimmed first, so that ``A_B_`` has two tokens while
    the inner empty token of ``A_B__C`` still counts.
    """
    return F.get(F.split(F.rtrim(session_id, F.lit("_")), "_"), F.lit(2))


def string_hash(key: Column) -> Column:
    """31-based 32-bit string hash over UTF-16 code units, as a signed long."""
    mask = F.lit(0xFFFFFFFF)

    def add_ascii(acc: Column, char: Column) -> Column:
        return (acc * 31 + F.ascii(char)).bitwiseAND(mask)

    def add_any(acc: Column, char: Column) -> Column:
        code = F.ascii(char).cast("long")
        beyond = code - 0x10000
        pair = (acc * 31 + 0xD800 + F.shiftright(beyond, 10)) * 31 + 0xDC00 + beyond.bitwiseAND(0x3FF)
        return F.when(code < 0x10000, acc * 31 + code).otherwise(pair).bitwiseAND(mask)

    chars, start = F.split(key, ""), F.lit(0).cast("long")
    one_byte_each = F.octet_length(key) == F.length(key)
    unsigned = F.when(one_byte_each, F.aggregate(chars, start, add_ascii)).otherwise(
        F.aggregate(chars, start, add_any)
    )
    return unsigned - F.shiftright(unsigned, 31) * (1 << 32)


def key_partition(key: Column, partitions: int, seed: int | None = None) -> Column:
    """Partition number of a record key; a null key goes to a random partition."""
    anywhere = F.floor(F.rand(seed) * partitions)
    return F.coalesce(F.pmod(F.abs(string_hash(key)), F.lit(partitions)), anywhere).cast("int")
