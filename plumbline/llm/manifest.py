"""Merkle manifest of a dataset, on nested-interval labels.

Every row is a leaf, the hash of its fields. The leaves of a source stand in the
order of their ids and are ranked; a node is labelled with the interval of leaf
ranks it covers, `lo` to `hi` (exclusive). FANOUT consecutive nodes make a parent
until one node remains, the source's subroot; the subroots, ordered by source,
make a tree of their own whose last node is the root.

Ancestors are attached by joins from parents to children: both sides name the
bucket of the level that `lo` falls into, and the child's interval has to lie
within the parent's. What the parent covers besides, from its `lo` to the child's
and from the child's `hi` to its own, identifies the siblings to the left and to
the right. A leaf's path is the list of these two from level to level; hashing
along it gives the root again.

Bounds: rows are ranked in ranges of source and id, so a source with any share of
the rows is spread; a parent gathers FANOUT nodes; windows run over one row for
each range and source. Only the tallest tree's leaf count and the root reach the driver.

Null fields are hashed as `-`; the null source is a source, the first. Null ids come
first in their source; rows equal in source and id are ordered by their hashes,
and equal rows are a leaf each. An empty table gives no rows. Columns of the
input other than the five hashed ones are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.session import spool

FANOUT = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """UTF-8 byte count, colon and value; `-` for null."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown), F.lit(":"), shown), F.lit("-"))


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(text: Column) -> Column:
    """Hash of a row whose text is `text`."""
    return hashed(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Adds `lo`, `hi` and `n`: each row's place in its tree as an interval, and the size of the tree.

    Rows are dealt out in ranges and numbered within each; what stands before a
    range in its tree comes from one row for each range and tree.
    """
    sort = [F.asc_nulls_first(c) for c in [tree, *order]]
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    ranged = spool(ranged.withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "leaves")
    slices = ranged.groupBy("_slice", tree).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = W.partitionBy(tree)
    before = F.sum("_n").over(whole.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    shift = slices.select("_slice", tree, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n"))
    placed = ranged.join(shift, ["_slice", tree]).withColumn("lo", F.col("_at") + F.col("_shift"))
    return placed.withColumn("hi", F.col("lo") + 1).drop("_slice", "_at", "_shift")


def parents_of(leaves: DataFrame) -> list[DataFrame]:
    """For each level above `tree, n, lo, hi, digest`, its nodes with their children as an array of label and digest."""
    levels, nodes, span = [], leaves, 1
    tallest = leaves.agg(F.max("n")).first()[0] or 0
    while span < tallest:
        nodes = nodes.filter(F.col("n") > span)
        span *= FANOUT
        node = F.struct("lo", "hi", "digest")
        nodes = nodes.groupBy("tree", "n", F.expr(f"lo div {span}").alias("bucket")).agg(F.array_sort(F.collect_list(node)).alias("children"))
        digests = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        nodes = nodes.select(
            "tree",
            "n",
            F.array_min(F.transform("children", lambda c: c["lo"])).alias("lo"),
            F.array_max(F.transform("children", lambda c: c["hi"])).alias("hi"),
            hashed(digests).alias("digest"),
            "children",
        )
        # The two levels with most nodes are stored, then every other one; those between are quickly made again.
        if len(levels) < 2 or len(levels) % 2:
            nodes = spool(nodes, f"level{len(levels) + 1}")
        levels.append(nodes)
    return levels


def subroots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """`tree, digest` of the last node of each tree."""
    last = [nodes.filter(F.col("n") <= FANOUT**level).select("tree", "digest") for level, nodes in enumerate([leaves, *levels])]
    return reduce(DataFrame.union, last)


def _side(first: Column, last: Column) -> Column:
    """Digests of the children whose intervals lie between two ranks."""
    within = F.filter("children", lambda c: (c["lo"] >= first) & (c["hi"] <= last))
    return F.array_join(F.transform(within, lambda c: c["digest"]), "")


def _below(parents: DataFrame, nodes: DataFrame, level: int, carried: list[str]) -> DataFrame:
    """`nodes` of a level with their path: the siblings under the parent that contains them, then the parent's path."""
    span = FANOUT ** (level + 1)
    over = parents.select("tree", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "children", "path", *carried, F.expr(f"lo div {span}").alias("_bucket"))
    kept = [c for c in nodes.columns if c != "children"]
    # Children of the nodes themselves are needed one level down.
    under = nodes.withColumnRenamed("children", "_own") if "children" in nodes.columns else nodes
    under = under.withColumn("_bucket", F.expr(f"lo div {span}"))
    both = under.join(over, ["tree", "_bucket"]).filter((F.col("lo") >= F.col("_lo")) & (F.col("hi") <= F.col("_hi")))
    step = F.struct(_side(F.col("_lo"), F.col("lo")).alias("left"), _side(F.col("hi"), F.col("_hi")).alias("right"))
    own = [F.col("_own").alias("children")] if "children" in nodes.columns else []
    return both.select(*kept, *own, *carried, F.concat(F.array(step), "path").alias("path"))


def with_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """`leaves` with the siblings of every level up to the tree's last node, then the `path` that `tops` has for the tree.

    Other columns of `tops` come along.
    """
    above, carried = None, [c for c in tops.columns if c not in ("tree", "path")]
    for level in range(len(levels), -1, -1):
        nodes = levels[level - 1] if level else leaves
        ended = nodes.filter(F.col("n") <= FANOUT**level).join(tops, "tree")
        if above is None:
            above = ended
        else:
            above = ended.unionByName(_below(above, nodes.filter(F.col("n") > FANOUT**level), level, carried))
    return above


EMPTY_PATH = "CAST(array() AS array<struct<left:string,right:string>>)"


def manifest(df: DataFrame, changed: Column | None = None) -> DataFrame:
    """Every row's `doc_id, leaf, subroot, root, proof_sha256, folded_root, verified` and its `path` in the manifest.

    `changed` is the text as found later, for all rows: `folded_root` hashes the
    leaf of that text along the stored siblings. Without it the texts are as they were.
    """
    text = F.col("text")
    rows = df.select(*FIELDS).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        field(F.col("source")).alias("tree"),
        F.col("source").cast("string").alias("source"),
        leaf(text).alias("digest"),
        (leaf(text) if changed is None else leaf(changed)).alias("found"),
    )
    leaves = ranked(rows, "tree", ["doc_id", "digest"])
    levels = parents_of(leaves)
    names = leaves.select("tree", "source").distinct()
    last = subroots(leaves, levels).join(names, "tree").select(F.lit("").alias("all"), "source", F.col("tree").alias("name"), "digest")
    tops = ranked(last, "all", ["source"]).withColumnRenamed("all", "tree")
    top_levels = parents_of(tops)
    root = subroots(tops, top_levels).first()
    start = df.sparkSession.createDataFrame([("",)], "tree string").withColumn("path", F.expr(EMPTY_PATH))
    ends = with_paths(tops, top_levels, start).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path")
    found = with_paths(leaves.drop("source"), levels, spool(ends, "subroots"))
    folded = F.aggregate("path", F.col("found"), lambda below, step: hashed(F.concat(step["left"], below, step["right"])))
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    out = found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        hashed(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
        "path",
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_text() -> Column:
    """The text, in lower case for A-Z where 5 divides the CRC-32 of the decimal id; rows without id stay."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def audited(df: DataFrame) -> DataFrame:
    """The manifest of `df`, held against the texts with some tampered."""
    return manifest(df, tampered_text()).drop("path")
