"""File sources: configs, seeds, JSON lines, checkpoints, archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load_config(path: str | Path) -> dict:
    """SRC1: a YAML file; a missing one is an error. Category values become strings, templates are checked."""
    import yaml

    path = Path(path)
    if not path.is_file():
        raise FileNotFoundError(f"no config {path}")
    config = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    for t in config.get("tables", []):
        names = {c["name"] for c in t.get("columns", [])}
        for c in t.get("columns", []):
            if "values" in c:
                c["values"] = [str(v) for v in c["values"]]
            if c.get("template"):
                import string

                unknown = {n for _, n, *_ in string.Formatter().parse(c["template"]) if n} - names
                if unknown:
                    raise ValueError(f"{path}: template of {c['name']} names unknown columns {sorted(unknown)}")
    return config


def list_configs(folder: str | Path) -> list[str]:
    """SRC2: names of YAML files in order; none without the folder."""
    folder = Path(folder)
    return sorted(p.name for p in folder.glob("*.yaml")) if folder.is_dir() else []


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """SRC23: watches of all product files as rows (product, url, seq); a product is its file's name without ``_triage``."""
    import yaml

    rows = []
    for p in sorted(Path(folder).glob("*.yaml")):
        for w in (yaml.safe_load(p.read_text(encoding="utf-8")) or {}).get("watches", []):
            rows.append((p.stem.removesuffix("_triage"), w["url"], len(rows)))
    return spark.createDataFrame(rows, "product string, url string, seq long")


def seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC3."""
    return spark.read.csv(path, header=True, inferSchema=True)


def sample_pool(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: first column of a CSV without nulls, or the lines of a text that aren't blank."""
    if path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
        return df.select(F.col(df.columns[0]).alias("value")).dropna()
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value != ''")


def load_jsonl(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """SRC5: JSON lines; blank and broken ones are dropped, columns united. SRC6 (``strict``): with its path and
    time of loading, and no rows are an error."""
    found = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    cols = [c for c in found.columns if c != "_corrupt"]
    if not cols:
        raise ValueError(f"{path} holds no JSON object")
    # Lines are parsed as a column, so that a count over pruned columns drops broken ones too.
    types = found.select(*cols).schema.add("_corrupt", "string")
    line = F.from_json("value", types, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_path"), "value").where(F.trim("value") != "")
    df = rows.select("source_path", line.alias("r")).where("r is not null and r._corrupt is null").select("source_path", *[F.col("r").getField(c).alias(c) for c in cols])
    if not strict:
        return df.drop("source_path")
    if df.limit(1).count() == 0:
        raise ValueError(f"{path} is empty")
    return df.withColumn("loaded_at", F.current_timestamp())


def last_record(df: DataFrame, key: str, order: str) -> DataFrame:
    """SRC7: of each key the last row in order."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def checkpoint_ids(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: the source_ids that are done; broken lines are skipped."""
    return spark.read.schema("source_id string").option("mode", "DROPMALFORMED").json(path).where("source_id is not null").distinct()


def resume(todo: DataFrame, done: DataFrame, key: str = "source_id") -> DataFrame:
    """FIL2, FIL3, JOIN6."""
    return todo.join(done.select(key), key, "left_anti")


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: the categories of a taxonomy file, one row each."""
    return spark.read.option("multiLine", True).json(path).select("source_name", "total_documents_analyzed", F.inline("categories"))


def raw_files(spark: SparkSession, folder: str, checkpoint: DataFrame | None = None) -> DataFrame:
    """SRC13, JOIN11: files below a folder as (source_id, path, content); with a checkpoint those it calls parsed."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    df = df.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("source_id"), "path", "content")
    return df if checkpoint is None else df.join(checkpoint.where("parsed").select("source_id"), "source_id", "left_semi")


def unzip(archives: DataFrame) -> DataFrame:
    """SRC11: (source_id, name, bytes, error) of archives(source_id, content): JSON instead of an archive is an API error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, c in zip(b.source_id, b.content):
                c = bytes(c or b"")
                if c.lstrip()[:1] in (b"{", b"["):
                    rows.append((i, None, None, "API error: " + c[:200].decode("utf-8", "replace")))
                    continue
                try:
                    with zipfile.ZipFile(io.BytesIO(c)) as z:
                        rows += [(i, n, z.read(n), None) for n in sorted(z.namelist()) if not n.endswith("/")]
                except zipfile.BadZipFile as e:
                    rows.append((i, None, None, f"bad archive: {e}"))
            yield pd.DataFrame(rows, columns=["source_id", "name", "bytes", "error"])

    return archives.select("source_id", "content").mapInPandas(run, "source_id string, name string, bytes binary, error string")


def decode_japanese(files: DataFrame, column: str = "bytes") -> DataFrame:
    """TXT2: text of bytes: UTF-8 in the JVM where valid, else shift_jis, euc-jp, cp932, then UTF-8 with marks."""

    @F.pandas_udf("string")
    def other(s: pd.Series) -> pd.Series:
        def one(b: bytes | None) -> str | None:
            for e in ("shift_jis", "euc_jp", "cp932"):
                try:
                    return bytes(b).decode(e)
                except UnicodeDecodeError:
                    continue
            return bytes(b).decode("utf-8", "replace")

        return s.map(one, na_action="ignore")

    text = F.col(column).cast("string")
    return files.withColumn("text", F.when(F.is_valid_utf8(text), text).otherwise(other(F.when(~F.is_valid_utf8(text), F.col(column)))))


def main_documents(files: DataFrame) -> DataFrame:
    """TXT3, TXT4: of each archive the public HTML files, else any HTML, else the text blocks of XBRL, joined by name."""
    name = F.lower("name")
    html = name.rlike("\\.x?html?$")
    kind = F.when(html & F.col("name").contains("PublicDoc"), 1).when(html, 2).when(name.rlike("\\.xbrl$"), 3)
    text = F.when(kind == 3, F.array_join(F.regexp_extract_all("text", F.lit("(?is)<[^>]*textBlock[^>]*>(.*?)</[^>]*textBlock[^>]*>"), F.lit(1)), "\n\n")).otherwise(F.col("text"))
    ranked = files.select("source_id", "name", text.alias("text"), kind.alias("kind")).where("kind is not null")
    best = ranked.withColumn("best", F.min("kind").over(Window.partitionBy("source_id"))).where("kind = best")
    banner = F.concat(F.lit("==== "), "name", F.lit(" ====\n"), "text")
    return best.groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", banner.alias("t")))), lambda x: x["t"]), "\n\n").alias("full_text"), F.count("*").alias("n_files"))


def bootstrap_seeds(spark: SparkSession, places: list[tuple[str, str]], n: int = 200) -> DataFrame:
    """SRC24: given (postcode, city) pairs and n made ones."""
    made = spark.range(n).select(F.lpad((10_000 + F.col("id") * 397 % 89_999).cast("string"), 5, "0").alias("plz"), F.concat(F.lit("Ort "), F.col("id").cast("string")).alias("stadt"))
    return spark.createDataFrame(places, "plz string, stadt string").unionByName(made) if places else made
