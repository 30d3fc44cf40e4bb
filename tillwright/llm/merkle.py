"""Merkle manifest of a dataset, with the inclusion proof of every row by pointer jumping.

Each row is a leaf, the hash of its fields. Per group, leaves in order are hashed in runs of `ARITY`, and runs
again, up to the group's root; the roots of the groups, in order, are folded alike into the root of the dataset.

Every node keeps a pointer to an ancestor and the segment of siblings on the way there, at first its parent and
the other members of its run. A self-join of the nodes doubles the distance: a node takes over its ancestor's
pointer and appends its segment. After as many rounds as the logarithm of the height, all pointers are at the
root. Only inner nodes are doubled, a seventh of the leaves; a leaf takes the segment of its run last, where the
runs' members already lie together, so that no path is shuffled once per leaf. A pointer `n` levels up is shared
by at most `ARITY ** n` nodes, and the nodes so high are as many times fewer: either the key of the join is light,
or its other side is small enough for Spark to broadcast.

Rows are numbered within their group by range partitions, so one group may hold any share of them.

Defined results: rows that agree in the ordering column are ordered by their leaf, and equal rows are leaves of
their own. A null ordering value comes first; the null group is a group of its own and comes first; groups follow
in the byte order of their names. A null field and an empty one have different leaves. A table of one row is its
own root, with an empty proof. An empty table gives no row. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.joins import null_safe_join
from tillwright.llm.components import packed
from tillwright.llm.mixing import numbered
from tillwright.session import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
_DIGEST = 32  # bytes
_TOP = -1  # the tree over the roots of the groups
_STEP = "array<struct<left:binary,right:binary>>"


def _hashed(text: Column) -> Column:
    """SHA-256 of a string, as bytes."""
    return F.unhex(F.sha2(text, 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of a row's fields: `-` for null, else the number of UTF-8 bytes, a colon, and the value."""
    texts = [f.cast("string") for f in fields]
    coded = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return _hashed(F.concat(*coded))


def folded(start: Column, proof: Column) -> Column:
    """Root, in hex, that a leaf's digest leads to by the steps of its proof."""
    return F.aggregate(proof, _hex(start), lambda at, step: F.sha2(F.concat(_hex(step["left"]), at, _hex(step["right"])), 256))


def siblings(proof: Column) -> Column:
    """All siblings of a proof in hex, from the leaf to the root, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(_hex(step["left"]), _hex(step["right"]))), "")


def _step(digests: str, at: Column) -> Column:
    """What stands before and after a member of a run."""
    run = F.col(digests)
    begin = (at * _DIGEST).cast("int")
    return F.struct(
        F.substring(run, F.lit(1), begin).alias("left"), F.substring(run, begin + _DIGEST + 1, F.lit(1 << 30)).alias("right")
    )


def _joined(digests: Column) -> Column:
    """Concatenation of an array of digests."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def _node(tree, level, place) -> Column:
    return F.struct(tree.alias("tree"), F.lit(level).cast("int").alias("level"), place.alias("place"))


def _folded_level(nodes: DataFrame, level: int, arity: int) -> DataFrame:
    """Runs of the nodes of one level: `tree`, `count` (runs of the tree), `place`, `digest`, the members' `digests`
    and `members`. Nodes come as `tree`, `count`, `place`, `digest`, `node`."""
    run = F.expr(f"place div {arity}L")
    grouped = nodes.groupBy("tree", F.expr(f"(count + {arity - 1}) div {arity}L").alias("count"), run.alias("place")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("place").alias("at"), "digest", "node"))).alias("members")
    )
    grouped = grouped.withColumn("digests", _joined(F.col("members.digest")))
    grouped = grouped.withColumns({
        "digest": _hashed(_hex(F.col("digests"))), "members": F.col("members.node"),
        "node": _node(F.col("tree"), level, F.col("place")),
    })
    return packed(grouped, "level")


def _segments(runs: DataFrame) -> DataFrame:
    """Each member of the runs with its parent and the one step there."""
    each = runs.select(F.col("node").alias("up"), "digests", F.posexplode("members").alias("at", "node"))
    return each.select("node", "up", F.array(_step("digests", F.col("at"))).cast(_STEP).alias("path"))


def _height(count: int, arity: int) -> int:
    levels = 0
    while count > 1:
        count, levels = -(-count // arity), levels + 1
    return levels


def _doubled(paths: DataFrame, height: int) -> DataFrame:
    """Paths of one step as paths to the root; the lowest nodes are on level 1."""
    distance = 1
    while distance < height:
        # After `distance` steps no node is lower than this.
        higher = paths.where(F.col("node.level") > distance).select(
            F.col("node").alias("up"), F.col("up").alias("far"), F.col("path").alias("rest")
        )
        joined = paths.join(higher, "up", "left").select(
            "node",
            F.coalesce("far", "up").alias("up"),
            F.when(F.col("rest").isNull(), F.col("path")).otherwise(F.concat("path", "rest")).alias("path"),
        )
        paths = written(joined, "paths")
        distance *= 2
    return paths


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    order: str = "doc_id",
    group: str = "lang",
    presented: Mapping[str, Column] | None = None,
    altered: Column | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """Per row of `docs`: `id` (its `order` column), `group`, `leaf`, `subroot` and `root` (digests as bytes), `proof`
    (per level, what stands `left` and `right` of the node in its run) and `presented`, the leaf of the row as it is
    presented for verification: with the expressions in `presented` for its fields, where `altered` holds."""
    if arity < 2:
        raise ValueError("a run has two members at least")
    own = leaf([F.col(f) for f in fields])
    given = leaf([(presented or {}).get(f, F.col(f)) for f in fields]) if presented else F.lit(None).cast("binary")
    if altered is not None:
        given = F.when(altered, given)
    hashed = docs.select(F.col(order).alias("_id"), F.col(group).alias("_group"), own.alias("_leaf"), given.alias("_given"))
    hashed = written(hashed, "leaves")
    # Equal rows are told apart by their place in the table, so that many copies lie in several partitions.
    ranked = numbered(hashed, "_group", [F.col("_id"), F.col("_leaf"), F.monotonically_increasing_id()])
    groups = ranked.groupBy("_group").agg((F.max("_rank") + 1).alias("_count"))
    groups = numbered(written(groups, "groups").withColumn("_all", F.lit(0)), "_all", [F.col("_group")])
    groups = written(groups.select("_group", "_count", F.col("_rank").alias("_tree")), "trees")
    known = groups.agg(F.count("*").alias("groups"), F.max("_count").alias("most")).first()

    joined = null_safe_join(ranked, groups, ["_group"])
    member = F.struct("_rank", F.col("_id").alias("id"), F.col("_leaf").alias("leaf"), F.col("_given").alias("given"))
    runs = joined.groupBy("_tree", "_count", F.expr(f"_rank div {arity}L").alias("place")).agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )
    runs = written(runs.withColumn("digests", _joined(F.col("members.leaf"))), "runs")

    alone = F.col("_count") == 1  # a lone leaf is its group's root
    nodes = runs.select(
        F.col("_tree").alias("tree"),
        F.expr(f"(_count + {arity - 1}) div {arity}L").alias("count"),
        "place",
        F.when(alone, F.col("digests")).otherwise(_hashed(_hex(F.col("digests")))).alias("digest"),
        _node(F.col("_tree"), 1, F.col("place")).alias("node"),
    )
    levels = max(1, _height(known["most"] or 0, arity))
    segments, subroots = [], []
    for level in range(1, levels):
        subroots.append(nodes.where("count = 1"))
        nodes = _folded_level(nodes.where("count > 1"), level + 1, arity)
        segments.append(_segments(nodes))
        nodes = nodes.select("tree", "count", "place", "digest", "node")
    subroots.append(nodes)
    roots = subroots[0]
    for more in subroots[1:]:
        roots = roots.unionByName(more)
    roots = packed(roots.select("tree", "digest", "node"), "subroots")

    top = roots.select(
        F.lit(_TOP).cast("bigint").alias("tree"), F.lit(known["groups"]).cast("bigint").alias("count"),
        F.col("tree").alias("place"), "digest", "node",
    )
    over = _height(known["groups"], arity)
    for level in range(levels + 1, levels + over + 1):
        top = _folded_level(top, level, arity)
        segments.append(_segments(top))
        top = top.select("tree", "count", "place", "digest", "node")
    root = top.select("digest").first()  # one row, or none
    if segments:
        paths = segments[0]
        for more in segments[1:]:
            paths = paths.unionByName(more)
        paths = _doubled(written(paths, "paths"), levels - 1 + over)
        runs = runs.withColumn("node", _node(F.col("_tree"), 1, F.col("place"))).join(
            paths.select("node", F.col("path").alias("above")), "node", "left"
        )
    else:
        runs = runs.withColumn("above", F.lit(None).cast(_STEP))

    none = F.array().cast(_STEP)
    subroot = roots.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"))
    named = groups.select("_tree", F.col("_group").alias("group"))
    runs = runs.join(subroot.join(named, "_tree"), "_tree")
    each = runs.select("group", "_count", "digests", "above", "subroot", F.posexplode("members").alias("at", "member"))
    first = F.when(F.col("_count") > 1, F.array(_step("digests", F.col("at"))).cast(_STEP)).otherwise(none)
    return each.select(
        F.col("member.id").alias("id"),
        "group",
        F.col("member.leaf").alias("leaf"),
        "subroot",
        F.lit(None if root is None else bytes(root["digest"])).cast("binary").alias("root"),
        F.concat(first, F.coalesce("above", none)).alias("proof"),
        F.coalesce("member.given", "member.leaf").alias("presented"),
    )
