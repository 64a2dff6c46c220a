"""A hash tree over a dataset: siblings meet by joins on computed slots, level by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from undercut.shared import materialise

ARITY = 3


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length ahead, so that neighbouring ones cannot run together; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["after"]))


def siblings(path: Column) -> Column:
    """All siblings of a path one after another, from the leaf's to the root's, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def _placed(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """Rows with their position (``place``) in an order, and the range partition (``part``) they lie in.

    Positions within partitions are lifted by the totals of the partitions before.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialise(ordered.withColumn("at", F.monotonically_increasing_id()), purpose)
    numbered = numbered.withColumn("part", F.shiftright("at", 33))
    totals = numbered.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # A row for each partition, so at most as many as the shuffle has partitions.
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("part", (earlier - F.col("first")).alias("lift"))
    return numbered.join(F.broadcast(offsets), "part").withColumn("place", F.col("at") + F.col("lift")).drop("at", "lift")


def _met(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with what stands before and after them in their run of ``arity`` siblings.

    Each slot offset is one equijoin. All of them use the one shuffle by run.
    """
    runs = nodes.withColumns({"run": F.floor(F.col("idx") / arity).cast("long"), "slot": F.col("idx") % arity})
    runs = runs.repartition("tree", "run")
    met = runs
    for shift in range(1, arity):
        other = runs.select(F.col("tree").alias("t"), F.col("run").alias("r"), F.col("slot").alias("s"), F.col("h").alias(f"h{shift}"))
        same = (F.col("tree") == F.col("t")) & (F.col("run") == F.col("r")) & ((F.col("slot") + shift) % arity == F.col("s"))
        met = met.join(other, same, "left").drop("t", "r", "s")
    # Offsets in ascending order are slots in ascending order, on either side of the wrap.
    wraps = [F.col("slot") + shift >= arity for shift in range(1, arity)]
    texts = [F.coalesce(f"h{shift}", F.lit("")) for shift in range(1, arity)]
    before = F.concat(*(F.when(w, h).otherwise("") for w, h in zip(wraps, texts)))
    after = F.concat(*(F.when(w, "").otherwise(h) for w, h in zip(wraps, texts)))
    return met.withColumns({"before": before, "after": after}).drop(*(f"h{shift}" for shift in range(1, arity)))


def _grown(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of trees of nodes (tree, idx, width, h, ...), and the root of each tree.

    ``width`` is the number of nodes that a tree has on a level. Roots are (tree, subroot,
    level): the level on which a tree is down to one node.
    """
    levels, roots, level = [], [nodes.where("width = 1").select("tree", F.col("h").alias("subroot"), F.lit(0).alias("level"))], nodes
    while not level.where("width > 1").isEmpty():
        met = materialise(_met(level, arity), "level")
        levels.append(met)
        up = met.where("slot = 0 and width > 1").select(
            "tree",
            F.col("run").alias("idx"),
            F.ceil(F.col("width") / arity).cast("long").alias("width"),
            digest(F.col("h"), F.col("after")).alias("h"),
        )
        level = up
        roots.append(up.where("width = 1").select("tree", F.col("h").alias("subroot"), F.lit(len(levels)).alias("level")))
    if not levels:
        levels.append(_met(nodes, arity))
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return levels, found


def _with_paths(levels: list[DataFrame], ends: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes of the lowest level with the steps from them to the root of all.

    ``ends`` holds the root of each tree with the path from there on (tree, level, path,
    ...). A path is its node's own step and its parent's path, so steps are joined once per
    node of a level, from the top down.
    """
    carried = [c for c in ends.columns if c not in ("tree", "level", "path")]
    above = None
    for k in range(len(levels) - 1, -1, -1):
        # Trees that end on this level or, where it is the lowest, have a single leaf.
        here = ends.where(F.col("level") == k + 1 if k else F.col("level") <= 1)
        here = here.select("tree", F.lit(0).cast("long").alias("idx"), "path", *carried)
        above = here if above is None else above.unionByName(here)
        up = above.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("path").alias("rest"), *carried)
        nodes = levels[k] if k == 0 else levels[k].where("width > 1")
        joined = nodes.join(up, (F.col("tree") == F.col("t")) & (F.col("run") == F.col("i")))
        step = F.array(F.struct("before", "after"))
        path = F.when(F.col("width") > 1, F.concat(step, "rest")).otherwise(F.col("rest"))
        above = joined.select("tree", "idx", path.alias("path"), *carried, *(keep if k == 0 else []))
    return above


def manifest(
    docs: DataFrame, fields: list[str], by: str = "source", key: str = "doc_id", arity: int = ARITY, carry: dict[str, Column] | None = None
) -> DataFrame:
    """Every row's leaf, the root of its group, the root of all, and its path to it.

    Returns ``leaf``, ``subroot``, ``root``, ``path`` (steps of what stands before and after
    the node among its siblings) and the columns named in ``carry``, which are computed
    from the row and may not use those names. Leaves of a group (``by``) ascend by ``key``;
    every run of ``arity`` becomes its digest until one is left. Groups, in the order of
    their bytes with null first, are reduced in the same way.

    Positions come from range partitions and their totals, so that a group of any size is
    spread over tasks. Every level is one shuffle of it and a table in the shared folder;
    the levels are a geometric series.

    Null keys come first and null values count as such. Repeated rows are leaves each;
    leaves of one key are in the order of their digests. An empty table gives no rows.
    Columns other than those named are ignored.
    """
    carry = carry or {}
    inputs = {f"c_{name}": value for name, value in carry.items()}
    # In front of a group's name there is a mark, so that null and every name stay apart.
    branch = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))
    hashed = docs.select(
        branch.alias("branch"),
        F.col(key).alias("k"),
        leaf(*(F.col(name) for name in fields)).alias("h"),
        F.monotonically_increasing_id().alias("tie"),
        *(value.alias(name) for name, value in inputs.items()),
    )
    placed = _placed(materialise(hashed, "leaves"), ["branch", "k", "h", "tie"], "ordered-leaves").drop("k", "tie")
    runs = placed.groupBy("part", "branch").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    trees = runs.groupBy("branch").agg(F.min("first").alias("first"), F.sum("n").alias("width"))
    trees = _placed(trees, ["branch"], "groups").select("branch", "first", "width", F.col("place").alias("tree"))
    # Rows find their group by partition and group, so that one large group is many keys.
    known = materialise(runs.select("part", "branch").join(trees, "branch"), "runs")
    nodes = placed.join(known, ["part", "branch"]).withColumn("idx", F.col("place") - F.col("first"))
    nodes = nodes.select("tree", "idx", "width", "h", *inputs)

    levels, subroots = _grown(nodes, arity)
    subroots = materialise(subroots, "subroots")
    count = subroots.agg(F.count("*").alias("width"))
    top = subroots.join(F.broadcast(count)).select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "width", F.col("subroot").alias("h"), "level"
    )
    top_levels, root = _grown(top, arity)
    no_steps = F.filter(F.array(F.struct(F.lit("").alias("before"), F.lit("").alias("after"))), lambda _: F.lit(False))
    tops = _with_paths(top_levels, root.select("tree", "level", no_steps.alias("path"), F.col("subroot").alias("root")), ["level", "h"])
    tops = materialise(
        tops.select(F.col("idx").alias("tree"), "level", "path", "root", F.col("h").alias("subroot")), "group-paths"
    )
    found = _with_paths(levels, tops, ["h", *inputs])
    return found.select(
        F.col("h").alias("leaf"), "subroot", "root", "path", *(F.col(f"c_{name}").alias(name) for name in carry)
    )
