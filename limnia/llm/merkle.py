"""Merkle manifest of a dataset: one tree for each group of rows, one over the groups' roots.

A row is a leaf, the digest of its columns. Leaves of a group are numbered in the order of their
key; then conditional aggregates spread each parent's children into slot columns. Hashing the
columns side by side gives the parent's digest, and leaving out the own slot's column gives a
node's siblings. One grouped step pivots as many slots as ``levels`` levels have below one
ancestor, and hashes its columns level by level, so a tree of n leaves takes
log(n) / log(fanout ** levels) shuffles, each of a sixteenth of the digests before it by default.
On the way back a block of slots carries the proof above it, and each leaf meets only its own block.

Numbers come from ranges of sorted rows in a written table: rows in their range, plus the counts
of the ranges before. No group, however large, is in one task. Trees are shaped as if by a loop:
while several nodes are left, every ``fanout`` consecutive ones become their digest, the last run
may be shorter, and even a single node left over is hashed again. A lone leaf is its root.

Cases: a null column counts as ``-``, another value as its UTF-8 length, a colon and its text,
so null and empty differ; rows without group form a group of their own, before all others; a null
key sorts first; rows of equal key sort by leaf, and rows alike in all columns stand side by side
in any order; whole texts are hashed, of any length; an empty table gives no rows; names of other
columns don't matter, only those asked for in ``keep`` come out (names beginning with ``_`` are
this module's).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnia.llm.common import stored

RANGE_ROWS = 4_000_000
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row's columns."""
    return digest(*(field(v) for v in values))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings, from the leaf upwards, give."""
    return F.aggregate(proof, start, lambda below, step: digest(step["left"], below, step["right"]))


def siblings(proof: Column) -> Column:
    """All digests of a proof, from the leaf upwards and left to right, as one text."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def numbered(nodes: DataFrame, order: Sequence[str], fanout: int) -> DataFrame:
    """A written table's rows with ``_index``, their place in the order within ``_tree``, and ``_left``, the tree's height."""
    spark = nodes.sparkSession
    keys = ["_tree", *order, "_place"]
    ranges = nodes.count() // RANGE_ROWS + 1
    given = [ranges] if ranges > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = nodes.repartitionByRange(*given, *keys).sortWithinPartitions(*keys)
    # the number is written: its upper bits are the range's, the lower ones count the rows in it
    held = stored(ordered.withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_at", 33))
    tree = Window.partitionBy("_tree")
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    powers = F.array(*(F.lit(fanout**k).cast("long") for k in range(64) if fanout**k < 1 << 62))
    runs = (
        held.groupBy("_tree", "_range")
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .withColumns({"_before": before, "_size": F.sum("_n").over(tree)})
        .withColumn("_left", F.size(F.filter(powers, lambda p: p < F.col("_size"))))
        .select("_tree", "_range", (F.col("_before") - F.col("_first")).alias("_shift"), "_left")
    )
    joined = held.join(runs, ["_tree", "_range"])
    return joined.withColumn("_index", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift", "_place")


def spread(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row for each ancestor ``levels`` up: the digests of all levels below it as arrays ``_0`` .. ``_<levels>``.

    Slots without a node are null; they are the last ones.
    """
    width = fanout**levels
    slot = F.col("_index") % width
    pivoted = nodes.groupBy("_tree", "_left", F.expr(f"_index DIV {width}").alias("_block")).agg(
        *(F.max(F.when(slot == j, F.col("_digest"))).alias(f"_s{j}") for j in range(width))
    )
    level = [f"_s{j}" for j in range(width)]
    arrays = [F.array(*level).alias("_0")]
    for t in range(1, levels + 1):
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        made = {f"_s{t}_{i}": F.when(F.col(r[0]).isNotNull(), digest(*(F.coalesce(c, F.lit("")) for c in r))) for i, r in enumerate(runs)}
        pivoted = pivoted.withColumns(made)
        level = list(made)
        arrays.append(F.array(*level).alias(f"_{t}"))
    return pivoted.select("_tree", "_left", "_block", *arrays)


def steps_of(slot: Column, fanout: int, levels: int) -> Column:
    """The siblings of a block's slot and of the nodes above it, left and right ones, for the levels left in the tree."""
    out = []
    for t in range(levels):
        at = F.floor(slot / fanout**t).cast("int")
        own = at % fanout
        left = F.array_join(F.slice(f"_{t}", at - own + 1, own), "")
        right = F.array_join(F.slice(f"_{t}", at + 2, fanout - 1 - own), "")  # a null slot adds nothing
        out.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*out), F.lit(1), F.least(F.col("_left"), F.lit(levels)))


def proven(nodes: DataFrame, blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` with ``_proof``: their siblings in their block, then the block's own ``_above``; none without a block."""
    width = fanout**levels
    asked = nodes.withColumn("_block", F.expr(f"_index DIV {width}")).drop("_left")
    joined = asked.join(blocks, ["_tree", "_block"], "left")
    own = F.concat(steps_of(F.col("_index") % width, fanout, levels), F.col("_above"))
    proof = F.coalesce(own, F.array().cast(STEPS)).alias("_proof")
    return joined.select(*nodes.columns, proof)


def grow(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """``_tree``, ``_root`` of all trees over numbered nodes (``_tree``, ``_index``, ``_left``, ``_digest``), and ``nodes`` with ``_proof``."""
    height = nodes.agg(F.max("_left")).first()[0] or 0
    below, steps, roots = nodes.select("_tree", "_index", "_left", "_digest"), [], []
    for _ in range(max(1, -(-height // levels))):
        blocks = stored(spread(below, fanout, levels))
        steps.append(blocks)
        top = F.coalesce(*(F.when(F.col("_left") == t, F.col(f"_{t}")[0]) for t in range(levels + 1)))
        roots.append(blocks.filter(F.col("_left") <= levels).select("_tree", top.alias("_root")))
        below = blocks.filter(F.col("_left") > levels).select(
            "_tree", F.col("_block").alias("_index"), (F.col("_left") - levels).alias("_left"), F.col(f"_{levels}")[0].alias("_digest")
        )
    above = steps[-1].withColumn("_above", F.array().cast(STEPS))
    for blocks in reversed(steps[:-1]):
        named = proven(blocks.withColumnsRenamed({"_block": "_index", "_left": "_rest"}).withColumnsRenamed(
            {f"_{t}": f"_own{t}" for t in range(levels + 1)}), above, fanout, levels)
        above = named.withColumnsRenamed(
            {"_index": "_block", "_rest": "_left", "_proof": "_above", **{f"_own{t}": f"_{t}" for t in range(levels + 1)}})
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    return found, proven(nodes, above, fanout, levels)


def manifest(
    rows: DataFrame, columns: Sequence[str], group: str, key: str, keep: Sequence[str] = (), fanout: int = 2, levels: int = 4
) -> DataFrame:
    """``keep`` columns of every row, with ``_leaf``, ``_subroot`` (its group's root), ``_root`` and ``_proof``.

    ``_proof`` lists the siblings left and right of each node from the leaf, by way of the
    subroot, to the root; ``fold`` and ``siblings`` read it.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # bytewise order, no group first
    leaves = stored(rows.select(
        tree.alias("_tree"), F.col(key).alias("_key"), leaf([F.col(c) for c in columns]).alias("_digest"),
        F.struct(F.lit(0).alias("_"), *(F.col(c) for c in keep)).alias("_kept"), F.monotonically_increasing_id().alias("_place"),
    ))
    subroots, inside = grow(stored(numbered(leaves, ["_key", "_digest"], fanout)), fanout, levels)
    groups = stored(subroots.select(
        F.lit("").alias("_tree"), F.col("_tree").alias("_group"), F.col("_root").alias("_digest"), F.lit(0).alias("_place")))
    root, over = grow(stored(numbered(groups, ["_group"], fanout)), fanout, levels)
    top = over.join(root, "_tree").select(
        F.col("_group").alias("_tree"), F.col("_digest").alias("_subroot"), "_root", F.col("_proof").alias("_over"))
    return inside.join(top, "_tree").select(
        *(F.col("_kept")[c].alias(c) for c in keep), F.col("_digest").alias("_leaf"), "_subroot", "_root",
        F.concat("_proof", "_over").alias("_proof"),
    )
