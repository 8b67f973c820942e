"""Reconciliation by hash tree: digests of ranges are compared level by level, only ranges that differ are read in full.

A leaf is the set of ids whose 64-bit hash begins with the same `bits` bits; a node of level l holds the leaves that share the
first l bits. The digest of a node is the number of its distinct ids and two XORs of independent 64-bit hashes of them, so
nodes with different ids agree with chance 2^-128. Digests of nodes add up from those of leaves, whoever counted them.

Hash ranges hold equally many ids whatever their form, so no leaf is hot: at 10^12 ids and 24 bits a leaf has 60,000. Comparing
two tables that agree reads two trees and no row. A table that is stored with its tree (`store`) lies in folders by the first
bits of the hash, so reading a few leaves opens a few folders.

Ids that are null are not counted, as in the plain reconciliation. Repeated ids count once. Empty tables give a count of 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.plans import reconcile
from riskspark.session import stored

BITS = 16
STEP = 4
FOLDER_BITS = 6
DIGEST = ("n", "x", "y")


def leaf_of(key: str, bits: int) -> Column:
    """Number of the leaf an id belongs to."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 64 - bits)


def leaves(df: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """leaf and its digest, for the leaves that hold an id; one shuffle of distinct ids."""
    ids = df.select(F.col(key).cast("string").alias("id")).where("id IS NOT NULL").distinct()
    hashed = ids.select(leaf_of("id", bits).alias("leaf"), F.xxhash64("id").alias("x"), F.xxhash64("id", F.lit(1)).alias("y"))
    return hashed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))


def tree(leaf_digests: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """level, node and its digest for every `step`-th level from the root (level 0) to the leaves."""
    levels = sorted({*range(0, bits, step), bits})
    placed = leaf_digests.select("*", F.explode(F.array(*map(F.lit, levels))).alias("level"))
    node = F.expr(f"shiftright(leaf, {bits} - level)").alias("node")
    return placed.groupBy("level", node).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))


def differing_leaves(one: DataFrame, two: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """Leaves on which two trees disagree: from the root down, only below nodes that differ."""
    levels = sorted({*range(0, bits, step), bits})
    same = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in DIGEST])
    above: DataFrame | None = None
    for last, level in zip([None, *levels], levels):
        sides = [t.where(F.col("level") == level).select("node", *DIGEST) for t in (one, two)]
        if above is not None:
            sides = [s.join(above, F.shiftright("node", level - last) == F.col("above"), "left_semi") for s in sides]
        both = sides[0].alias("a").join(sides[1].alias("b"), "node", "full").where(~same).select("node")
        above = both.withColumnRenamed("node", "above")
    return above.select(F.col("above").alias("leaf"))


def at_leaves(df: DataFrame, key: str, differing: DataFrame, bits: int = BITS) -> DataFrame:
    """Ids of `df` in these leaves."""
    ids = df.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull())
    return ids.withColumn("leaf", leaf_of(key, bits)).join(differing, "leaf", "left_semi").select(key)


def _counted(trees: list[DataFrame], rows: list[DataFrame], key: str) -> DataFrame:
    """One row: ids per table from the roots, the rest from the rows of leaves that differ."""
    names = ("source_ids", "enriched_ids", "decision_ids")
    found = ("missing_enriched", "unexpected_enriched", "missing_decisions", "unexpected_decisions")
    parts = [t.where("level = 0").select(F.col("n").alias(name)) for t, name in zip(trees, names, strict=True)]
    parts.append(reconcile.report(*rows, key=key).select(*found))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counted = every.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*names, *found)])
    gap = F.coalesce(F.col("missing_enriched") / F.nullif(F.col("source_ids"), F.lit(0)), F.lit(0.0))
    return counted.select("*", gap.alias("gap"), (gap <= reconcile.MAX_GAP).alias("within_limit"))


def report(
    source: DataFrame, enriched: DataFrame, decisions: DataFrame, key: str = "transaction_id", bits: int = BITS, step: int = STEP
) -> DataFrame:
    """The row of `reconcile.report`, from the ids of differing leaves only."""
    tables = [source, enriched, decisions]
    trees = [stored(tree(leaves(df, key, bits), bits, step)) for df in tables]
    differing = [differing_leaves(a, b, bits, step) for a, b in zip(trees, trees[1:])]
    wanted = stored(differing[0].unionByName(differing[1]).distinct())
    return _counted(trees, [at_leaves(df, key, wanted, bits) for df in tables], key)


def store(df: DataFrame, key: str, path: str, bits: int = BITS, step: int = STEP, folder_bits: int = FOLDER_BITS) -> None:
    """Writes `df` to `path`/rows by hash range and its tree to `path`/tree."""
    placed = df.select("*", leaf_of(key, bits).alias("_leaf"))
    placed = placed.withColumn("_range", F.shiftright("_leaf", bits - folder_bits).cast("int"))
    placed.repartition("_range").sortWithinPartitions("_leaf").write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    tree(leaves(rows, key, bits), bits, step).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")


def read_leaves(spark: SparkSession, path: str, wanted: DataFrame, bits: int = BITS, folder_bits: int = FOLDER_BITS) -> DataFrame:
    """The stored rows of these leaves; other folders are not opened, other row groups are skipped.

    The driver learns the folders, of which there are at most 2^folder_bits, and the first and last leaf.
    """
    ranges = wanted.select(F.shiftright("leaf", bits - folder_bits).cast("int").alias("r")).distinct()
    opened = [r.r for r in ranges.collect()]
    low, high = wanted.agg(F.min("leaf"), F.max("leaf")).first()
    rows = spark.read.parquet(f"{path}/rows").where(F.col("_range").isin(opened))
    if opened:
        rows = rows.where(F.col("_leaf").between(low, high))
    return rows.join(wanted.withColumnRenamed("leaf", "_leaf"), "_leaf", "left_semi").drop("_leaf", "_range")


def report_stored(
    spark: SparkSession, source: str, enriched: str, decisions: str, key: str = "transaction_id", bits: int = BITS, step: int = STEP, folder_bits: int = FOLDER_BITS
) -> DataFrame:
    """The same for tables written by `store`: three trees and the rows of differing leaves are all that is read."""
    paths = [source, enriched, decisions]
    trees = [spark.read.parquet(f"{path}/tree") for path in paths]
    differing = [differing_leaves(a, b, bits, step) for a, b in zip(trees, trees[1:])]
    wanted = stored(differing[0].unionByName(differing[1]).distinct())
    return _counted(trees, [read_leaves(spark, path, wanted, bits, folder_bits) for path in paths], key)
