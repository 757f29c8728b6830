"""First-of, best-of and most-frequent-of, with explicit orders for ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """One row a key: the first in the order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank__", rank).where("rank__ = 1").drop("rank__")


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, seen: Column | str, out: str | None = None) -> DataFrame:
    """(keys, out): the most frequent non-empty value; ties go to the one seen first."""
    counted = df.where(F.col(value) != "").groupBy(*keys, value).agg(F.count("*").alias("n__"), F.min(seen).alias("seen__"))
    best = counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n__"), F.col("seen__"), F.col(value))).alias(out or value))
    return best


def min_count_per_pair(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """(keys, first order, rows) of each distinct combination."""
    return df.groupBy(*keys).agg(F.min(order).alias(order), F.count("*").alias("seen"))


def renumbered(df: DataFrame, keys: Sequence[str], out: str, *order: Column | str) -> DataFrame:
    """`out` from 1 without gaps within each key."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int"))


def settled(df: DataFrame) -> DataFrame:
    """df, computed once: in the checkpoint folder where the session has one, so that the
    loss of an executor doesn't deal the rows anew, else in the cache."""
    return df.checkpoint() if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df.persist()


def unbroadcast(df: DataFrame) -> DataFrame:
    """A stored table whose joins, and those of what is derived of it alone, are by shuffles.

    Spark takes a table's size from its files. Compressed columns of repeated values hold a
    hundred times their bytes and more, so a registry of a million entries passes for a few
    megabytes, and would be gathered in the driver and copied to each executor.
    """
    return df.hint("merge")


def running_share(df: DataFrame, amount: str, *order: Column | str) -> DataFrame:
    """(rank, amount, cumulative, share) over all rows in an order.

    The order is total, so rows are dealt by range of the order first: sums of the
    ranges, then running sums within each, instead of one task that sorts everything.
    """
    placed = settled(df.repartitionByRange(*order).withColumn("part__", F.spark_partition_id()))
    sums = placed.groupBy("part__").agg(F.sum(amount).alias("sum__"), F.count("*").alias("rows__"))
    upto = Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part__", F.coalesce(F.sum("sum__").over(upto), F.lit(0)).alias("before__"), F.coalesce(F.sum("rows__").over(upto), F.lit(0)).alias("rank0__"))
    total = df.agg(F.sum(amount).alias("total")).first()["total"]
    within = Window.partitionBy("part__").orderBy(*order)
    out = placed.join(sums, "part__").select(
        *df.columns,
        (F.col("rank0__") + F.row_number().over(within)).alias("rank"),
        (F.col("before__") + F.sum(amount).over(within.rowsBetween(Window.unboundedPreceding, 0))).alias("cumulative"),
    )
    return out.withColumn("share", F.col("cumulative") / F.lit(float(total)) if total else F.lit(0.0))


def at_ranks(curve: DataFrame, ticks: Sequence[int], n_rows: int) -> DataFrame:
    """The rows of a running curve at the ticks, and the last one."""
    return curve.where(F.col("rank").isin(*ticks) | (F.col("rank") == n_rows))


def every_step(curve: DataFrame, n_rows: int, samples: int = 200) -> DataFrame:
    """The first, the last and every max(1, n / samples)-th row."""
    step = max(1, n_rows // samples)
    return curve.where((F.col("rank") == 1) | (F.col("rank") == n_rows) | (F.col("rank") % step == 0))


def sample_at_or_after(curve: DataFrame, n: int) -> DataFrame:
    """The first sample of rank n or more, else the last one."""
    after = curve.where(F.col("rank") >= n).orderBy("rank").limit(1)
    last = curve.orderBy(F.desc("rank")).limit(1)
    return after.unionByName(last).orderBy(F.when(F.col("rank") >= n, F.col("rank")).otherwise(F.lit(1 << 62) - F.col("rank"))).limit(1)
