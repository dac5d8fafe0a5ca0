"""Ordered operations within groups of any size: numbering, the row that follows, the last value so far.

A group is cut into buckets of its order column. Windows run within a
bucket; what crosses buckets (counts, first rows, last values) is carried by
a table with one row per bucket, on which the group's window then runs. So a
group that holds a third of all rows is spread over many tasks, while
results are those of a plain window over the group.

Null orders sort first, as one bucket of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Order values per bucket.
BUCKET = 10_000


def _bucketed(df: DataFrame, order: str, size: int) -> DataFrame:
    return df.withColumn("_bucket", F.coalesce(F.floor(F.col(order) / size), F.lit(-(2**62))))


def _join(df: DataFrame, per_bucket: DataFrame, group: list[str]) -> DataFrame:
    b = per_bucket.select(*[F.col(c).alias(f"_k_{c}") for c in [*group, "_bucket"]], *[c for c in per_bucket.columns if c not in [*group, "_bucket"]])
    cond = F.lit(True)
    for c in [*group, "_bucket"]:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return df.join(b, cond, "left").drop(*[f"_k_{c}" for c in [*group, "_bucket"]])


def numbered(df: DataFrame, group: list[str], order: str, tie: str, name: str, size: int = BUCKET) -> DataFrame:
    """Row number within the group, from 1."""
    b = _bucketed(df, order, size)
    local = F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(order, tie))
    counts = b.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return _join(b.withColumn("_local", local), counts.withColumn("_before", before).drop("_n"), group).withColumn(name, (F.col("_local") + F.col("_before")).cast("long")).drop("_local", "_before", "_bucket")


def following(df: DataFrame, group: list[str], order: str, tie: str, columns: list[str], prefix: str = "_n_", size: int = BUCKET) -> DataFrame:
    """The given columns of the next row of the group, null after its last."""
    b = _bucketed(df, order, size)
    w = Window.partitionBy(*group, "_bucket").orderBy(order, tie)
    row = F.struct(*columns)
    within = b.withColumn("_next", F.lead(row).over(w))
    firsts = b.groupBy(*group, "_bucket").agg(F.min_by(row, F.struct(order, tie)).alias("_first"))
    after = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy(*group).orderBy("_bucket"))).drop("_first")
    out = _join(within, after, group).withColumn("_next", F.coalesce("_next", "_after"))
    for c in columns:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_next.{c}"))
    return out.drop("_next", "_after", "_bucket")


def carried(df: DataFrame, group: list[str], order: str, tie: str, value: Column, name: str, size: int = BUCKET) -> DataFrame:
    """The last non-null value up to and with each row of the group."""
    b = _bucketed(df, order, size).withColumn("_v", value)
    w = Window.partitionBy(*group, "_bucket").orderBy(order, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = b.withColumn("_last", F.last("_v", ignorenulls=True).over(w))
    lasts = b.groupBy(*group, "_bucket").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(order, tie))).alias("_end"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    return _join(within, lasts.withColumn("_before", before).drop("_end"), group).withColumn(name, F.coalesce("_last", "_before")).drop("_v", "_last", "_before", "_bucket")
