"""Segments of generated documents: reshape, statistics, tiers, scorecards.

The long form (document, segment, text) is canonical; wide ``seg_`` columns are found by name.
"Empty" is null or "". One row group per document, aggregates combine within tasks before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quellwerk.functions.patterns import TIERS


def segment_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("seg_")]


def melt(df: DataFrame, *ids: str) -> DataFrame:
    """RSH1: (ids, segment, text). No segment columns: an empty result of the same type."""
    ids = ids or ("document_id",)
    cols = segment_columns(df)
    if not cols:
        return df.select(*ids, F.lit(None).cast("string").alias("segment"), F.lit(None).cast("string").alias("text")).where(F.lit(False))
    long = df.unpivot(list(ids), cols, "segment", "text")
    return long.withColumn("segment", F.regexp_replace("segment", "^seg_", ""))


def extract_segment(df: DataFrame, name: str, with_id: bool = True) -> DataFrame:
    """RSH2. An unknown name is an error that tells the known ones; without ids rows are numbered."""
    col = name if name.startswith("seg_") else f"seg_{name}"
    if col not in df.columns:
        raise ValueError(f"no segment {name!r}; there are {segment_columns(df)}")
    if not with_id:
        return df.select(F.col(col).alias("text"))
    key = F.col("document_id") if "document_id" in df.columns else F.concat(F.lit("row_"), F.monotonically_increasing_id() + 1)
    return df.select(key.alias("document_id"), F.col(col).alias("text"))


def chars(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0))


def length_stats(long: DataFrame, digits: int | None = 1) -> DataFrame:
    """AGG1 (rounded) and AGG2 (``digits=None``, with estimated tokens)."""
    n = chars(F.col("text"))
    values = {"mean": F.avg(n), "median": F.median(n), "sd": F.stddev(n), "pct_empty": F.avg((n == 0).cast("double")) * 100}
    if digits is None:
        values["est_tokens"] = F.avg(n / 2.0)
    kept = {k: v if digits is None else F.round(v, digits) for k, v in values.items()}
    return long.groupBy("segment").agg(F.count("*").alias("n"), F.min(n).cast("bigint").alias("min"), F.max(n).cast("bigint").alias("max"), *[v.alias(k) for k, v in kept.items()])


def empty_alert(long: DataFrame, most: float = 10.0) -> DataFrame:
    """FIL9: segments that are empty in more than ``most`` percent of the documents."""
    share = F.avg((chars(F.col("text")) == 0).cast("double")) * 100
    return long.groupBy("segment").agg(share.alias("p")).where(F.col("p") > most).select("segment", F.round("p", 1).alias("pct_empty"))


def buyer_scorecard(one: DataFrame) -> DataFrame:
    """AGG22 on one row (n_segments, m: mean characters a segment, n_tiers: documents with a tier, k: critical flaws, n: documents).

    Five checks, their share in percent, and a verdict: sufficient from 80, promising from 60, else doubtful.
    """
    checks = [F.col("n_segments") >= 6, F.col("m") > 100, F.col("n_tiers") > 0, F.col("k") * 100 / F.col("n") < 5, F.col("m") > 200]
    score = sum((F.coalesce(c, F.lit(False)).cast("int") for c in checks), F.lit(0))
    final = F.bround(score / len(checks) * 100).cast("bigint")
    return one.select(score.alias("score"), F.lit(len(checks)).alias("checks"), final.alias("final_score"), F.when(final >= 80, "sufficient").when(final >= 60, "promising").otherwise("doubtful").alias("verdict"))


def tier_order(tier: Column) -> Column:
    """SRT3: the known tiers in order, others last."""
    out = F.lit(len(TIERS))
    for k, (name, *_) in reversed(list(enumerate(TIERS))):
        out = F.when(tier == name, k).otherwise(out)
    return out


def tier_distribution(df: DataFrame) -> DataFrame:
    """AGG3: count and percentage by tier; empty without the column."""
    if "quality_tier" not in df.columns:
        return df.sparkSession.createDataFrame([], "quality_tier string, n long, pct double")
    n = df.groupBy("quality_tier").agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))) * 100, 1))


def compare_tiers(df: DataFrame) -> DataFrame:
    """AGG4: share, error rate and mean segment length by tier against what is expected."""
    cols = segment_columns(df)
    mean_chars = sum((chars(F.col(c)) for c in cols), F.lit(0)) / F.lit(float(max(1, len(cols))))
    expected = F.broadcast(df.sparkSession.createDataFrame([(t, 100 * p) for t, p, _ in TIERS], "quality_tier string, expected_pct double"))
    n = df.groupBy("quality_tier").agg(F.count("*").alias("n"), F.avg("error_rate").alias("mean_error_rate"), F.avg(mean_chars).alias("mean_segment_chars"))
    n = n.withColumn("pct", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))) * 100)
    return n.join(expected, "quality_tier", "left").withColumn("deviation", F.col("pct") - F.col("expected_pct")).withColumn("tier_order", tier_order(F.col("quality_tier")))


def complete_counts(df: DataFrame, a: str, b: str, a_values: DataFrame, b_values: DataFrame) -> DataFrame:
    """AGG15: counts of both columns with zeros filled in; both value lists are small dimensions."""
    grid = a_values.crossJoin(F.broadcast(b_values))
    return grid.join(df.groupBy(a, b).agg(F.count("*").alias("n")), [a, b], "left").fillna(0, ["n"])


def scorecard(stats: DataFrame) -> DataFrame:
    """AGG17 on length_stats(digits=None): completeness, steadiness of length, richness, score."""
    all_rows = Window.partitionBy(F.lit(0))
    steady = F.least(F.lit(100.0), F.lit(100.0) * (1 - F.coalesce("sd", F.lit(0.0)) / F.greatest("mean", F.lit(1.0))))
    complete = 100 - F.col("pct_empty")
    rich = F.col("est_tokens") / F.greatest(F.max("est_tokens").over(all_rows), F.lit(1e-9)) * 100
    return stats.select("segment", complete.alias("completeness"), steady.alias("length_consistency"), rich.alias("token_richness"), ((complete + F.greatest(steady, F.lit(0.0))) / 2).alias("section_score"))


def validation_summary(df: DataFrame) -> DataFrame:
    """AGG21 of wide documents: documents, segments, coverage in percent, mean length, passed above 90 %."""
    long = melt(df)
    n = chars(F.col("text"))
    one = long.agg(F.count("*").alias("n_segments"), F.countDistinct("segment").alias("n_segment_types"), F.avg((n > 0).cast("double")).alias("coverage"))
    docs = df.agg(F.count("*").alias("n_documents"), F.avg(chars(F.col("document_content"))).alias("mean_document_chars"))
    return docs.crossJoin(F.broadcast(one)).select("n_documents", "n_segments", "n_segment_types", F.round(F.col("coverage") * 100, 1).alias("coverage_pct"), F.round("mean_document_chars", 1).alias("mean_document_chars"), (F.col("coverage") > 0.9).alias("passed"))


def rolling_mean(df: DataFrame, value: str, order: str, by: list[str], rows: int = 20) -> DataFrame:
    """WIN1: mean over the last rows; a partition column keeps the window off a single task."""
    return df.withColumn("rolling_mean", F.avg(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)))
