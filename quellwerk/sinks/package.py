"""Writing data sets: tables in several formats, previews, schema, statistics, datasheet, archive, court lines."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quellwerk.operators.sampling import train_test_split
from quellwerk.operators.validation import profile

# Characters kept of each text of a court line.
TEXT_CAPS = {"full_text": 10_000, "tenor": 2_000, "tatbestand": 3_000, "gruende": 3_000, "leitsatz": 1_000}
TYPES = {"double": "float64", "float": "float64", "int": "int64", "bigint": "int64", "boolean": "bool"}


def write_table(df: DataFrame, path: str, csv: bool = True, parquet: bool = True, jsonl: bool = False, single: bool = False) -> list[str]:
    """SNK1. ``single`` gives one file for small tables; else each task writes its part."""
    x, done = df.coalesce(1) if single else df, []
    if csv:
        x.select(*[F.col(c) if t in ("string", "double", "int", "bigint", "boolean", "timestamp", "date", "float") else F.to_json(c).alias(c) for c, t in df.dtypes]).write.mode("overwrite").csv(f"{path}/csv", header=True)
        done.append("csv")
    if parquet:
        x.write.mode("overwrite").parquet(f"{path}/parquet")
        done.append("parquet")
    if jsonl:
        x.write.mode("overwrite").json(f"{path}/jsonl")
        done.append("jsonl")
    return done


def write_preview(df: DataFrame, path: str, order: str, n: int = 100, jsonl: bool = False) -> None:
    """SNK2, LIM1: the first rows in order."""
    top = df.orderBy(order).limit(n)
    top.write.mode("overwrite").json(path) if jsonl else top.write.mode("overwrite").csv(path, header=True)


def schema_json(tables: dict[str, DataFrame]) -> dict:
    """SNK3."""
    return {t: [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema] for t, df in tables.items()}


def statistics(tables: dict[str, DataFrame]) -> dict:
    """SNK4: rows, columns and the profile of each table, one row a column."""
    return {t: {"row_count": df.count(), "column_count": len(df.columns), "columns": [r.asDict() for r in profile(df).collect()]} for t, df in tables.items()}


def package(tables: dict[str, DataFrame], folder: str, name: str, license_text: str = "", config: dict | None = None) -> dict:
    """SNK3-SNK6, AGG26: schema, statistics, datasheet, licence, config, archive and ``latest``. Profiles are one row a column."""
    root = Path(folder) / name
    root.mkdir(parents=True, exist_ok=True)
    for t, df in tables.items():
        write_table(df, str(root / t), jsonl=False)
    stats = statistics(tables)
    (root / "schema.json").write_text(json.dumps(schema_json(tables), ensure_ascii=False, indent=2), encoding="utf-8")
    (root / "statistics.json").write_text(json.dumps(stats, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    total = sum(s["row_count"] for s in stats.values())
    lines = [f"# {name}", "", f"Rows: {total}", ""] + [f"- {t}: {s['row_count']} rows, {s['column_count']} columns" for t, s in stats.items()]
    (root / "datasheet.md").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (root / "LICENSE.md").write_text(license_text, encoding="utf-8")
    (root / "generation_config.json").write_text(json.dumps(config or {}, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    archive = shutil.make_archive(str(root), "zip", root)
    link = Path(folder) / "latest"
    if link.is_symlink() or link.exists():
        link.unlink()
    os.symlink(root.name, link)
    return {"archive": archive, "rows": total}


def write_tiers(df: DataFrame, path: str) -> dict:
    """SNK7, AGG24: documents by tier, and counts."""
    df.write.mode("overwrite").partitionBy("quality_tier").json(path)
    return {r.quality_tier: r["count"] for r in df.groupBy("quality_tier").count().collect()}


def export_train_test(df: DataFrame, path: str, share: float = 0.2, seed: int = 42, by: str | None = None) -> dict:
    """SNK8: train and test lines and their description."""
    split = train_test_split(df, share, seed, by=by)
    for s in ("train", "test"):
        split.where(F.col("split") == s).drop("split").write.mode("overwrite").json(f"{path}/{s}")
    return {"features": {c: {"dtype": TYPES.get(t, "string")} for c, t in df.dtypes}, "splits": {r.split: r["count"] for r in split.groupBy("split").count().collect()}}


def report_json(checks: DataFrame, score: DataFrame) -> str:
    """SNK9: a validation report, one row a check."""
    return json.dumps({**score.first().asDict(), "checks": [r.asDict() for r in checks.collect()]}, ensure_ascii=False, default=str)


def taxonomy_json(taxonomy: DataFrame, source: str, n_documents: int) -> DataFrame:
    """SNK10: the taxonomy as one JSON document; its rows are types of flaws, not flaws."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("k"), "flaw_type", "flaw_subtype", "segment", "severity", "description", "count", "frequency", "examples")))
    return taxonomy.agg(F.to_json(F.struct(F.lit(source).alias("source_name"), F.lit(n_documents).alias("total_documents_analyzed"), order.alias("categories"))).alias("value"))


def court_lines(cases: DataFrame) -> DataFrame:
    """SNK11: cases with their texts cut to what a line keeps; write by category."""
    return cases.select(*[F.substring(c, 1, TEXT_CAPS[c]).alias(c) if c in TEXT_CAPS else F.col(c) for c in cases.columns])


def run_summary(counts: dict, path: str) -> None:
    """SNK15."""
    Path(path).write_text(json.dumps(counts, ensure_ascii=False, indent=2), encoding="utf-8")
