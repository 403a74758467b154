"""Merkle manifest of a dataset: a hash tree per group of rows and one over the groups' roots.

A leaf is the digest of a row. Inside a group leaves stand in a given order; every ``FANOUT`` consecutive nodes,
a run, have one parent, and the last run may be shorter. A level is a table of nodes with their places. In a
window over each run, lag and lead columns of fixed offsets, masked by the slot in the run and the run's length,
are a node's siblings, and the run's first child hashes the parent, which is a row of the next level.
A node's path is its siblings on the way to the root; it comes from its parent's, level by level downwards, so
that only tables of one node per run are joined and no group stands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.plans.scale import lookup_join, materialize, number_rows, settle

FANOUT = 8
#: A path: per level the digests left and right of the node, lowest level first.
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*fields: Column) -> Column:
    """Leaf of a row: every field is ``-`` if null, else its UTF-8 byte count, a colon and its text."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[framed(f) for f in fields])


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and a path of siblings give."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["before"], node, level["after"]))


def siblings(path: Column) -> Column:
    """All digests of a path as one text, level by level and left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


def _beside(nodes: DataFrame) -> DataFrame:
    """``_before`` and ``_after`` of every node: what its run holds left and right of it."""
    run = Window.partitionBy("_group", "_run").orderBy("_place")
    slot, length = F.col("_place") % FANOUT, F.least(F.lit(FANOUT), F.col("_nodes") - F.col("_run") * FANOUT)
    left = [F.when(slot >= k, F.lag("_node", k).over(run)) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("_node", k).over(run)) for k in range(1, FANOUT)]
    return nodes.select("*", F.concat_ws("", *left).alias("_before"), F.concat_ws("", *right).alias("_after"))


def _with_run(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("_run", F.expr(f"_place div {FANOUT}"))


def _parents(nodes: DataFrame) -> DataFrame:
    first = _beside(_with_run(nodes)).filter(f"_place % {FANOUT} = 0")
    return first.select(
        "_group",
        F.col("_run").alias("_place"),
        F.expr(f"(_nodes + {FANOUT - 1}) div {FANOUT}").alias("_nodes"),
        digest(F.col("_node"), F.col("_after")).alias("_node"),
    )


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Tables of the nodes above the leaves, as far as some group has more than one node."""
    most = leaves.agg(F.max("_nodes")).first()[0] or 0
    levels, below = [], leaves.select("_group", "_place", "_nodes", "_node")
    while most > 1:
        below = materialize(_parents(below.filter("_nodes > 1")))
        levels.append(below)
        most = -(-most // FANOUT)
    return levels


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``_path`` of every node of the first table; ``tops`` holds the path of each group's only top node."""
    found = None
    for nodes in reversed(levels):
        single = nodes.filter("_nodes = 1").join(tops, "_group").select("_group", "_place", "_path")
        if found is None:
            found = single
            continue
        upper = found.select("_group", F.col("_place").alias("_run"), F.col("_path").alias("_above"))
        below = _beside(_with_run(nodes.filter("_nodes > 1"))).join(upper, ["_group", "_run"])
        found = below.select("_group", "_place", _longer().alias("_path")).unionByName(single)
    return found


def _longer() -> Column:
    return F.concat(F.array(F.struct(F.col("_before").alias("before"), F.col("_after").alias("after"))), F.col("_above"))


def _placed(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Rows with ``_place`` from 0 in their ``_group`` and the group's ``_nodes``."""
    placed = settle(
        rows.sparkSession, lambda: number_rows(rows, group, order, "_n").withColumn("_place", F.col("_n") - 1).drop("_n")
    )
    sizes = placed.groupBy("_group").agg(F.count(F.lit(1)).alias("_nodes"))
    # not a join dealt by the group: one may have most of the rows, and the windows would inherit its tasks
    return lookup_join(placed, sizes, ["_group"], how="inner")


def _tree(leaves: DataFrame, tops_of) -> DataFrame:
    """Leaves with ``_top``, the root of their group, and their ``_path``; ``tops_of`` prolongs it beyond the top.

    ``tops_of`` is given (_group, _node) of all groups' tops and gives (_group, _top, _path).
    """
    levels = _levels(leaves)
    of_one = leaves.filter("_nodes = 1").select("_group", "_node")
    tops = of_one
    for nodes in levels:
        tops = tops.unionByName(nodes.filter("_nodes = 1").select("_group", "_node"))
    tops = materialize(tops_of(tops))
    single = leaves.filter("_nodes = 1").join(tops, "_group")
    if not levels:
        return single
    upper = _paths(levels, tops.select("_group", "_path")).select(
        "_group", F.col("_place").alias("_run"), F.col("_path").alias("_above")
    )
    many = _beside(_with_run(leaves.filter("_nodes > 1"))).join(upper, ["_group", "_run"]).withColumn("_path", _longer())
    many = many.drop("_run", "_before", "_after", "_above")
    many = lookup_join(many, tops.select("_group", "_top"), ["_group"], how="inner")
    return many.unionByName(single.select(many.columns))


def manifest(rows: DataFrame, leaf: str, group: str, order: list[str]) -> DataFrame:
    """The rows with ``subroot``, ``root`` and ``path`` (``PATH``) of the tree over the digests in column ``leaf``.

    Groups are the values of ``group``, a null one included, and stand in bytewise order, null first. Leaves
    ascend by ``order``, nulls first; ties by the leaf, so that equal rows may change places without effect.
    A group of one leaf has the leaf as subroot, one group's subroot is the root. No row, no result.
    Pass only columns that the result needs: rows move twice. Columns that the result adds are replaced, names
    that begin with an underscore are reserved.
    """
    kept = [c for c in rows.columns if c not in ("subroot", "root", "path")]
    # a key that is never null and sorts as the groups do
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    keyed = materialize(rows.select(*kept, key.alias("_group"), F.col(leaf).alias("_node")))
    leaves = _placed(keyed, ["_group"], [F.col(c) for c in order] + [F.col("_node")])

    def over_groups(subroots: DataFrame) -> DataFrame:
        # the groups' tops are the leaves of one more tree, whose only group is called "*"
        nodes = subroots.select(F.lit("*").alias("_group"), F.col("_group").alias("_of"), "_node")
        placed = _placed(materialize(nodes), ["_group"], [F.col("_of")])
        whole = _tree(placed, lambda top: top.select("_group", F.col("_node").alias("_top"), F.expr(f"CAST(array() AS {PATH})").alias("_path")))
        return whole.select(
            F.col("_of").alias("_group"), F.struct(F.col("_node").alias("subroot"), F.col("_top").alias("root")).alias("_top"), "_path"
        )

    found = _tree(leaves, over_groups)
    return found.select(*kept, "_top.subroot", "_top.root", F.col("_path").alias("path"))
