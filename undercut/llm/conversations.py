"""Logged conversations that are prefixes of longer ones, left out; the rest rendered for chat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from undercut.shared import materialise

#: Turns rendered into one row; a longer conversation takes several.
SEGMENT = 64
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def _element(seed: str) -> Column:
    """A hash of one turn at its place; nulls and empty strings differ."""
    return F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text")


def prefixes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every turn with its ``place`` (from 1), ``turns`` in all and the hash of the turns up to it; and the turns.

    The rolling hash is a running exclusive-or of the turns' hashes, each of which covers
    its place: 128 bits that depend on the order. Turns are laid out by conversation and
    turn over range partitions; the stretch of a conversation in a partition is worked on
    alone, and lifted by the counts and hashes of its stretches before, so that one very
    long conversation spreads like any other rows.
    """
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    # A turn without conversation is a conversation of its own.
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", F.col("role").isNull(), "role", "text")).otherwise(F.lit(0))
    order = ["conv_id", "alone", F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last()]
    laid = turns.withColumn("alone", alone.cast("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = materialise(laid.withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}), "turns")

    stretch = ["conv_id", "alone", "part"]
    whole = Window.partitionBy("conv_id", "alone")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = laid.groupBy(*stretch).agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"))
    counted = counted.select(
        *stretch, "first_seq", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lift"), F.sum("n").over(whole).alias("turns")
    )
    placed = _joined(laid, counted, stretch)
    placed = placed.withColumn("place", F.col("seq") - F.col("first_seq") + F.col("lift") + 1).drop("first_seq", "lift")
    placed = placed.withColumns({"e1": _element("first"), "e2": _element("second")})

    lanes = {"p1": "e1", "p2": "e2"}
    hashed = placed.groupBy(*stretch).agg(*(F.bit_xor(e).alias(e) for e in lanes.values()))
    hashed = hashed.select(*stretch, *(F.coalesce(F.bit_xor(e).over(before), F.lit(0)).alias(f"lift_{p}") for p, e in lanes.items()))
    along = Window.partitionBy(*stretch).orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = placed.drop("role", "text").withColumns({p: F.bit_xor(e).over(along) for p, e in lanes.items()})
    rolled = _joined(rolled, hashed, stretch)
    return rolled.select(
        "conv_id", "alone", "seq", "place", "turns", *(F.col(p).bitwiseXOR(F.col(f"lift_{p}")).alias(p) for p in lanes)
    ), placed


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join on keys of which the first may be null."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, match).drop(*(f"_{k}" for k in keys))


def maximal(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, alone, turns, copies) of conversations that no longer one begins with, and all placed turns.

    Of equal conversations the one with the least conv_id stands for all; ``copies``
    counts them. Proper prefixes are reduced to distinct ones before the anti-join, and
    equal conversations to one, so that a first turn shared by all is one row.
    """
    rolled, placed = prefixes(conversations)
    rolled = materialise(rolled, "prefixes")
    ends = rolled.where("place = turns").groupBy("place", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id", "alone")).alias("who"), F.count("*").alias("copies")
    )
    proper = rolled.where("place < turns").select("place", "p1", "p2").distinct()
    kept = ends.join(proper, ["place", "p1", "p2"], "left_anti")
    return kept.select("who.conv_id", "who.alone", F.col("place").alias("turns"), "copies"), placed


def render(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Maximal conversations as chat text: conv_id, segment (from 0), turns, copies, text.

    Each turn is written as its role and text between fixed marks. ``segment`` turns make
    a row, and the rows of a conversation, put together in order, are its whole text.

    A null role is written as an empty one, a null text too. Turns are ordered by turn
    (null last), role and text; repeated rows count once. Rows without conv_id are
    conversations of one turn, returned with a null conv_id. An empty table gives no
    rows. Other columns are ignored.
    """
    kept, placed = maximal(conversations)
    wanted = _joined(placed.drop("turns"), kept, ["conv_id", "alone"])
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    line = F.concat(F.lit(OPEN), role, F.lit(AFTER_ROLE), text, F.lit("\n" + CLOSE))
    number = F.floor((F.col("place") - 1) / segment).alias("segment")
    rows = wanted.select("conv_id", "alone", "turns", "copies", number, F.struct("place", line.alias("line")).alias("x"))
    grouped = rows.groupBy("conv_id", "alone", "segment", "turns", "copies").agg(F.array_sort(F.collect_list("x")).alias("x"))
    text = F.array_join(F.transform("x", lambda x: x["line"]), "")
    return grouped.select("conv_id", "segment", "turns", "copies", text.alias("text"))
