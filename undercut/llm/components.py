"""Connected components: nodes hang on their least neighbour, then only the roots and what links them go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from undercut.shared import Slots


def _pairs(links: DataFrame) -> DataFrame:
    """Distinct links of two nodes, the greater as the child."""
    return links.where("u <> v").select(F.greatest("u", "v").alias("child"), F.least("u", "v").alias("parent")).distinct()


def _flat(hung: DataFrame, few: bool, slots: Slots) -> DataFrame:
    """Each child with the root of its tree, as (node, root); parents are less than their children."""
    while True:
        above = hung.select(F.col("child").alias("node"), F.col("parent").alias("above"))
        above = F.broadcast(above) if few else above
        once = hung.select("child", "parent").join(above, F.col("parent") == F.col("node"), "left")
        once = once.select("child", F.coalesce("above", "parent").alias("first"))
        twice = once.join(above, F.col("first") == F.col("node"), "left")
        hung = slots.put("hung", twice.select("child", F.coalesce("above", "first").alias("parent"), F.col("above").isNotNull().alias("open")))
        if not hung.where("open").count():
            return hung.select(F.col("child").alias("node"), F.col("parent").alias("root"))


def connected(links: DataFrame, slots: Slots | None = None, sent: int = 2**18) -> DataFrame:
    """Each linked node with the least node of its component, as (node, label).

    ``links`` are pairs (u, v). In every round each node that has a lesser neighbour hangs on the
    least one, trees are replaced by their roots, and the links between different roots are
    what the next round has; a number of rounds logarithmic in the size of a component is usual.
    The tables of a round are written to the shared folder in place of those of the round before. The
    hung nodes of a round are sent to all tasks if they are counted and ``sent`` at most, and
    joined by shuffles otherwise. Nodes without links are not returned.
    """
    slots = Slots(links.sparkSession) if slots is None else slots
    edges, labels = slots.put("edges", _pairs(links)), None
    while edges.count():
        hung = slots.put("hung", edges.groupBy("child").agg(F.min("parent").alias("parent")))
        few = hung.count() <= sent
        flat = _flat(hung, few, slots)
        roots = F.broadcast(flat) if few else flat
        moved = edges.join(roots, F.col("child") == F.col("node")).select("parent", F.col("root").alias("u"))
        moved = moved.join(roots, F.col("parent") == F.col("node"), "left").select("u", F.coalesce("root", "parent").alias("v"))
        edges = slots.put("edges", _pairs(moved))
        hung = flat.select("node", F.col("root").alias("label"))
        if labels is not None:
            again = roots.select(F.col("node").alias("was"), "root")
            labels = labels.join(again, F.col("label") == F.col("was"), "left").select("node", F.coalesce("root", "label").alias("label"))
            hung = labels.unionByName(hung)
        labels = slots.put("rooted", hung)
    if labels is None:
        return edges.select(F.col("child").alias("node"), F.col("parent").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
