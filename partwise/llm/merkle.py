"""A manifest of a dataset as a Merkle tree with nested-interval labels.

Rows of a group, in order of their ids, are leaves with ranks 0, 1, ...; the nodes of each level are
runs of `fanout` nodes of the level below, and the tops of all groups are leaves of one more tree. A
node carries the interval of leaf ranks that it covers. Ancestors are attached from the top down: a
node meets, in the bucket of its level (its first rank by the width of a node above), the one node above
whose interval contains its own, and inherits what was attached to that. Siblings are the nodes in
the interval of the parent without the node's own: those that end before it, and those that begin after.

Ranks come from a sort by ranges, so a group may hold any share of the rows; runs and buckets hold
`fanout` nodes at most. The text is read once, for the digests; only digests are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwise.functions.skew import broadcast_if_small
from partwise.llm.tables import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value, so that no two rows frame alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows (with a column grp) and, for each, `lo`: its rank from 0 in its group by order, and `nodes`: how many the group has."""
    placed = materialise(
        rows.orderBy("grp", *order).withColumn("pos", F.monotonically_increasing_id()).withColumn("piece", F.shiftright("pos", 33)),
        "placed",
    )
    held = placed.groupBy("grp", "piece").agg(F.min("pos").alias("first"), F.count("*").alias("held"))
    pieces = Window.partitionBy("grp").orderBy("piece")  # as many as the sort had ranges, at most
    before = F.coalesce(F.sum("held").over(pieces.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = materialise(
        held.select(
            "grp", "piece", (before - F.col("first")).alias("shift"), F.sum("held").over(Window.partitionBy("grp")).alias("nodes")
        ),
        "runs",
    )
    return placed.join(broadcast_if_small(runs, runs.count()), ["grp", "piece"]).withColumn("lo", F.col("pos") + F.col("shift")).drop(
        "pos", "piece", "shift"
    )


def levels_above(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels of the trees of all groups: leaves (grp, lo, hi, digest, nodes: how many its level has in the group)
    first, then their parents, which have `children` too. The node of a level that has one is its group's top."""
    levels, width = [leaves], 1
    most = leaves.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        most, width = -(-most // fanout), width * fanout
        runs = levels[-1].where("nodes > 1").withColumn("bucket", F.expr(f"lo div {width}"))
        parents = runs.groupBy("grp", "bucket").agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"), F.max("nodes").alias("below")
        )
        levels.append(materialise(
            parents.select(
                "grp", F.expr("children[0].lo").alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
                F.sha2(F.concat_ws("", F.col("children.digest")), 256).alias("digest"),
                F.ceil(F.col("below") / fanout).alias("nodes"), "children",
            ),
            f"level-{len(levels)}",
        ))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the node that remains in each group."""
    found = [level.where("nodes = 1").select("grp", "digest") for level in levels]
    for more in found[1:]:
        found[0] = found[0].union(more)
    return found[0]


def attach(levels: list[DataFrame], leaves: DataFrame, top: DataFrame, fanout: int) -> DataFrame:
    """leaves (grp, lo, hi, nodes and more columns) with `path` and the other columns of top.

    top has grp and path for each group. A path lists, from the node up, the digests of the siblings
    left and right of each node on the way, each side as one text; a leaf's ends with its group's path.
    """
    given = [c for c in top.columns if c not in ("grp", "path")]

    def below(nodes: DataFrame, above: DataFrame | None, width: int) -> DataFrame:
        whole = nodes.where("nodes = 1").join(top, "grp")
        if above is None:
            return whole
        above = above.select(
            F.col("grp").alias("p_grp"), F.expr(f"lo div {width}").alias("p_bucket"), F.col("lo").alias("p_lo"),
            F.col("hi").alias("p_hi"), "children", F.col("path").alias("p_path"), *given,
        )
        inside = (
            (F.col("grp") == F.col("p_grp")) & (F.expr(f"lo div {width}") == F.col("p_bucket"))
            & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
        )
        siblings = F.expr(
            "struct(concat_ws('', transform(filter(children, c -> c.hi <= lo), c -> c.digest)) as left,"
            " concat_ws('', transform(filter(children, c -> c.lo >= hi), c -> c.digest)) as right)"
        )
        met = nodes.where("nodes > 1").join(above, inside).withColumn("path", F.concat(F.array(siblings), "p_path"))
        return met.select(*nodes.columns, "path", *given).union(whole.select(*nodes.columns, "path", *given))

    above = None
    for depth in range(len(levels) - 1, 0, -1):
        nodes = levels[depth].withColumnRenamed("children", "own")
        above = below(nodes, above, fanout ** (depth + 1)).withColumnRenamed("own", "children")
    return below(leaves, above, fanout)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: Sequence[str] = FIELDS,
    claimed: Mapping[str, Column] | None = None,
    fanout: int = 16,
) -> DataFrame:
    """(id_col, leaf, subroot, root, path, proof_sha256, folded_root, verified) for each row of docs.

    A leaf is the SHA-256 of the framed fields, nulls included. Leaves of a group ascend by id, nulls
    first, rows with equal ids by their digests; groups ascend bytewise, the null group first. A lone
    leaf is its group's subroot, a lone group's subroot is the root. claimed gives, by name of the field, what a holder of the
    row says it is: folded_root is made of the claimed leaf and the manifest's siblings, and verified
    says that it is the root. proof_sha256 is the digest of all siblings on the path.
    Other columns are ignored, whatever their names; very long texts are digested where they are read.
    An empty table gives an empty result.
    """
    said = [(claimed or {}).get(name, F.col(name)) for name in fields]
    id_type = docs.schema[id_col].dataType
    rows = materialise(
        docs.select(
            F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
            leaf_digest([F.col(name) for name in fields]).alias("digest"), leaf_digest(said).alias("claimed"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    leaves = materialise(ranked(rows, ["id", "digest", "row"]).withColumn("hi", F.col("lo") + 1).drop("row"), "ranked")
    levels = levels_above(leaves.select("grp", "lo", "hi", "digest", "nodes"), fanout)
    subroots = materialise(tops(levels), "subroots")

    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    groups = materialise(ranked(named, ["name"]).withColumn("hi", F.col("lo") + 1), "groups")
    forest = levels_above(groups.select("grp", "lo", "hi", "digest", "nodes"), fanout)
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    crown = tops(forest).select("grp", nothing.alias("path"), F.col("digest").alias("root"))
    top = attach(forest, groups, crown, fanout).select(F.col("name").alias("grp"), "path", "root", F.col("digest").alias("subroot"))
    top = materialise(top, "tops")

    again = folded(F.col("claimed"), F.col("path"))
    siblings = F.concat_ws("", F.transform("path", lambda step: F.concat(step["left"], step["right"])))
    return (
        attach(levels, leaves, top, fanout)
        .withColumn("folded_root", again)
        .select(
            F.col("id").cast(id_type).alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path",
            F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )
