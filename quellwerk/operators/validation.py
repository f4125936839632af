"""Checks of tables and documents, each one row (check, passed, message).

All document checks are aggregates of one pass over the table; their row is then unfolded to one row a
check. "Empty" is null or "". A registry takes checks of one's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quellwerk.functions.patterns import LEGAL_FORMS
from quellwerk.functions.text import is_german, is_japanese
from quellwerk.operators.segments import segment_columns

#: VAL8: name -> function of a DataFrame that gives (passed, message).
REGISTRY: dict[str, Callable[[DataFrame], tuple[bool, str]]] = {}


def register_check(name: str, check: Callable[[DataFrame], tuple[bool, str]]) -> None:
    REGISTRY[name] = check


def _count(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def rows_of(df: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """checks: (name, passed, message) over aggregates of df, as rows, by a single aggregation."""
    one = df.agg(F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(p, F.lit(False)).alias("passed"), m.cast("string").alias("message")) for n, p, m in checks]).alias("rows"))
    return one.select(F.inline("rows"))


def document_checks(
    df: DataFrame, expected_rows: int | None = None, language: str | None = None, lengths: dict[str, tuple[int, int]] | None = None, keywords: dict[str, list[str]] | None = None, expected_segments: list[str] | None = None, order: str = "document_id"
) -> DataFrame:
    """VAL9-VAL16. Missing columns fail their check; the optional ones run when asked for."""
    texts = [c for c, t in df.dtypes if t == "string"]
    segs = expected_segments or segment_columns(df)
    present = [c for c in segs if c in df.columns]
    n = F.count("*")
    empty = _count(_blank("document_content")) if "document_content" in df.columns else F.lit(-1)
    errors = sum((_count(F.col(c).contains("[GENERATION_FAILED")) for c in texts), F.lit(0))
    gaps = sum((_count(_blank(c)) for c in present), F.lit(0)) + F.lit(len(segs) - len(present)) * n
    checks = [] if expected_rows is None else [("document_row_count", n == expected_rows, n)]
    checks += [("no_empty_documents", empty == 0, empty), ("no_generation_errors", errors == 0, errors), ("structural_completeness", (gaps == 0) & F.lit(len(present) == len(segs)), gaps)]
    for seg, (low, high) in (lengths or {}).items():
        size = F.length(f"seg_{seg}")
        bad = _count(size < low) + _count(size > high)
        checks.append((f"segment_length_{seg}", bad == 0, bad))
    for seg, words in (keywords or {}).items():
        bad = sum((_count(~F.coalesce(F.col(f"seg_{seg}").contains(w), F.lit(False))) for w in words), F.lit(0))
        checks.append((f"keyword_{seg}", bad == 0, bad))
    out = rows_of(df, checks)
    return out.unionByName(language_consistency(df, language, order)) if language else out


def language_consistency(df: DataFrame, language: str, order: str = "document_id", first: int = 50, least: float = 0.8) -> DataFrame:
    """VAL13: the first documents in order; blank ones are no hits but count, other languages always fit."""
    c = F.col("document_content")
    right = is_japanese(c) if language == "ja" else is_german(c) if language == "de" else F.lit(True)
    hit = F.coalesce(F.trim(c) != "", F.lit(False)) & F.coalesce(right, F.lit(False))
    share = F.avg(hit.cast("double"))
    return rows_of(df.orderBy(order).limit(first), [("language_consistency", share >= least, F.round(share, 4))])


def table_checks(df: DataFrame, expected_columns: list[str], expected_rows: int) -> DataFrame:
    """VAL1-VAL4, VAL6, VAL7 and the registered checks (VAL8; one that raises is a failed check)."""
    n = F.count("*")
    missing = [c for c in expected_columns if c not in df.columns]
    all_null = sum((F.when(F.count(F.col(f"`{c}`")) == 0, 1).otherwise(0) for c in df.columns), F.lit(0))
    close = (n == 0) if expected_rows == 0 else (F.abs(n - expected_rows) / F.lit(float(expected_rows)) <= 0.01)
    checks = [
        ("no_empty_dataframe", (n > 0) & F.lit(bool(df.columns)), n),
        ("column_completeness", F.lit(not missing), F.lit(",".join(missing))),
        ("no_all_null_columns", all_null == 0, all_null),
        ("row_count", close, n),
    ]
    plz = [c for c in df.columns if "plz" in c.lower()]
    if plz:
        padded = [F.when(F.length(F.col(c).cast("string")) < 5, F.lpad(F.col(c).cast("string"), 5, "0")).otherwise(F.col(c).cast("string")) for c in plz]
        bad = sum((_count(~(p.rlike("^[0-9]{5}$") & (p >= "01000"))) for p in padded), F.lit(0))
        seen = sum((F.count(c) for c in plz), F.lit(0))
        checks.append(("german_plz_valid", (bad == 0) | (bad / seen < 0.01), bad))
    forms = [c for c in df.columns if "rechtsform" in c.lower()]
    if forms:
        odd = sum((_count(F.col(c).isNotNull() & ~F.col(c).isin(LEGAL_FORMS)) for c in forms), F.lit(0))
        checks.append(("rechtsform_consistent", odd == 0, odd))
    out = rows_of(df, checks)
    own = []
    for name, check in REGISTRY.items():
        try:
            own.append((name, *check(df)))
        except Exception as e:  # noqa: BLE001
            own.append((name, False, str(e)))
    return out.unionByName(df.sparkSession.createDataFrame(own, "check string, passed boolean, message string")) if own else out


def quality_score(checks: DataFrame, threshold: float = 0.8) -> DataFrame:
    """AGG12: share of passed checks; 1.0 without any."""
    score = F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(1.0))
    return checks.agg(F.count("*").alias("n_checks"), _count(F.col("passed")).alias("n_passed"), F.round(score, 4).alias("score"), (score >= threshold).alias("passed"))


def profile(df: DataFrame, exact_median: bool = False) -> DataFrame:
    """AGG10: one row a column: nulls, distinct values, moments of numbers, length of strings, top five values.

    The median is that of a quantile sketch; ``exact_median=True`` holds the counts of a column's distinct values in
    one task, which columns with very many of them don't allow.

    One aggregation for all moments; values are counted by one more over (column, value) pairs, so that
    no column needs a pass of its own and no distinct set is held in a task.
    """
    names = df.columns
    numeric = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or t.startswith("decimal")}
    strings = {c for c, t in df.dtypes if t == "string"}
    null = F.lit(None).cast("double")

    def stats(c: str) -> Column:
        x = F.col(f"`{c}`")
        v = x.cast("double") if c in numeric else None
        return F.struct(
            F.lit(c).alias("column"), F.lit(dict(df.dtypes)[c]).alias("dtype"), F.count_if(x.isNull()).alias("null_count"), F.round(F.avg(x.isNull().cast("double")), 4).alias("null_ratio"),
            *[(F.round(f(v), 4) if v is not None else null).alias(n) for n, f in (("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max), ("median", F.median if exact_median else lambda x: F.percentile_approx(x, 0.5, 10_000)))],
            (F.round(F.avg(F.length(x)), 1) if c in strings else null).alias("avg_length"),
        )

    moments = df.agg(F.array(*map(stats, names)).alias("s")).select(F.inline("s"))
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])).alias("p")).select("p.*").where("value is not null")
    counted = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    top = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "value"))), lambda x: F.concat(x["value"], F.lit("="), (-x["k"]).cast("string")))
    best = counted.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value")))
    best = best.where("rank <= 5").groupBy("column").agg(top.alias("top_values"))
    unique = counted.groupBy("column").agg(F.count("*").alias("unique_count"))
    out = moments.join(unique, "column", "left").join(best, "column", "left").fillna(0, ["unique_count"])
    return out.withColumn("top_values", F.when(F.col("column").isin(sorted(strings)) if strings else F.lit(False), F.array_join("top_values", "; ")))
