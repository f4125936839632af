"""Exact samples, splits and shuffles by hash: the same rows on any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quellwerk.functions.text import uniform


#: Cells of the hash that are counted for each level.
CELLS = 4_096


def exact_sample(df: DataFrame, rate: float, seed: int = 42, key: str = "document_id", by: str | None = None) -> DataFrame:
    """SMP1, INJ5: marks exactly max(1, round half to even(n * rate)) rows, of each level of ``by`` if given.

    Rows are ordered by a hash of the key within the level. Counts by level and cell of the hash tell
    which cells are in whole; only the one cell that the bound runs through is ranked, whatever the size
    of its level.
    """
    level = F.col(by).cast("string") if by else F.lit("all")
    x = df.withColumn("__l", F.coalesce(level, F.lit(""))).withColumn("__u", uniform(seed, F.col(key))).withColumn("__c", F.floor(F.col("__u") * CELLS).cast("int"))
    cells = x.groupBy("__l", "__c").agg(F.count("*").alias("__n"))
    upto, every = Window.partitionBy("__l").orderBy("__c"), Window.partitionBy("__l")
    want = F.greatest(F.lit(1), F.bround(F.sum("__n").over(every) * rate)).cast("bigint")
    cells = cells.select("__l", "__c", (want - (F.sum("__n").over(upto) - F.col("__n"))).alias("__left"), "__n")
    y = x.join(cells, ["__l", "__c"])
    edge = (F.col("__left") > 0) & (F.col("__left") < F.col("__n"))
    rank = F.row_number().over(Window.partitionBy("__l", "__c").orderBy("__u", key))
    whole = y.where(~edge).withColumn("in_sample", F.col("__left") > 0)
    part = y.where(edge).withColumn("in_sample", rank <= F.col("__left"))
    return whole.unionByName(part).select(*df.columns, "in_sample")


def train_test_split(df: DataFrame, share: float = 0.2, seed: int = 42, key: str = "document_id", by: str | None = None) -> DataFrame:
    """SMP1, SET2: column ``split`` is test for the sample and train for the rest."""
    return exact_sample(df, share, seed, key, by).withColumn("split", F.when(F.col("in_sample"), "test").otherwise("train")).drop("in_sample")
