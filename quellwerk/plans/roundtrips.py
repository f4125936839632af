"""Queries of sources and sinks: tables go out through a sink, or take the form that a source reads, and come back."""

from __future__ import annotations

import html
import io
import json
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from quellwerk.functions import pages
from quellwerk.plans.queries import change_events, docs, query, read, watches
from quellwerk.operators import retrieval, validation
from quellwerk.sinks import package
from quellwerk.sources import files, rest
from quellwerk.streaming import changes


def scratch(spark) -> str:
    """A fresh folder below the session's shared one; a temporary one on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quellwerk-")
    return f"{base.rstrip('/')}/quellwerk-{uuid.uuid4().hex}"


@query("SRC3_4_seed_csv", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, d):
    path = scratch(spark)
    read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").write.csv(path, header=True)
    return files.seed_csv(spark, path).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")


@query("SRC5_6_SNK1_lines", "SELECT rec_id, document_id, quality_tier FROM synth_document")
def _(spark, d):
    path = scratch(spark)
    package.write_table(docs(spark, d), path, csv=False, parquet=False, jsonl=True)
    return files.load_jsonl(spark, f"{path}/jsonl", strict=True).select("rec_id", "document_id", "quality_tier")


@query("SRC8_checkpoint", "SELECT DISTINCT source_id FROM document_record WHERE source_id IS NOT NULL")
def _(spark, d):
    path = scratch(spark)
    read(spark, d, "document_record", "source_id", "title", "parsed").write.json(path)
    return files.checkpoint_ids(spark, path)


@query("SRC9_SNK10_taxonomy_file")
def _(spark, d):
    from quellwerk.operators import flaws

    path = scratch(spark)
    p = read(spark, d, "parsed_document", "rec_id", "segments").select(F.col("rec_id").cast("string").alias("source_id"), "segments")
    n = p.count()
    package.taxonomy_json(flaws.taxonomy(flaws.filing_flaws(p), n), "filings", n).write.text(path)
    return files.load_taxonomy(spark, path).select("flaw_type", "flaw_subtype", "segment", "count", "frequency", "severity")


def _fetch(url: str, params: dict) -> dict:
    """An offline stand-in: two pages of two filings a day."""
    day, page = (params["date"], 1) if params else url.split("#")[1:]
    rows = [{"docID": f"S{day.replace('-', '')}{page}{k}", "docTypeCode": "120" if k else "350", "withdrawalStatus": "0", "filingDate": day, "filerName": "株式会社", "docDescription": "" if k else "x", "odd": str(k)} for k in range(2)]
    return {"results": rows, "next": f"{url}#{day}#2" if str(page) == "1" else None}


@query("SRC10_12_14_TXT28_rest_listing", "SELECT 'S'||replace(strftime(d,'%Y-%m-%d'),'-','')||p::VARCHAR||'1' AS source_id, '有価証券報告書' AS title, strftime(d,'%Y-%m-%d') AS filing_date FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS d), (VALUES (1),(2)) t(p)")
def _(spark, d):
    rows = rest.rest_source(spark, "https://listing.example", rest.days("2024-01-01", "2024-01-31"), _fetch)
    return rest.listings(rows, ["120"]).select("source_id", "title", "filing_date")


def _archives(df):
    """Texts as archives with a public HTML file each, every third with an XBRL file instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t in zip(b.rec_id, map(html.escape, b.full_text)):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w") as z:
                    if i % 3:
                        z.writestr("XBRL/PublicDoc/report.htm", f"<p>{t}</p>")
                        z.writestr("other/note.htm", "<p>no</p>")
                    else:
                        z.writestr("XBRL/report.xbrl", f"<x:OverviewTextBlock>{t}</x:OverviewTextBlock>")
                out.append((str(i), buf.getvalue()))
            yield pd.DataFrame(out, columns=["source_id", "content"])

    return df.mapInPandas(run, "source_id string, content binary")


@query("SRC11_TXT3_4_archives", """SELECT rec_id::VARCHAR AS source_id, 1 AS n_files, (CASE WHEN rec_id%3<>0 THEN '==== XBRL/PublicDoc/report.htm ====' || chr(10) || '<p>' || t || '</p>' ELSE '==== XBRL/report.xbrl ====' || chr(10) || t END) AS full_text
  FROM (SELECT rec_id, replace(replace(replace(replace(replace(full_text,'&','&amp;'),'<','&lt;'),'>','&gt;'),'"','&quot;'),'''','&#x27;') AS t FROM parsed_document WHERE full_text IS NOT NULL)""")
def _(spark, d):
    p = read(spark, d, "parsed_document", "rec_id", "full_text").where("full_text is not null")
    return files.main_documents(files.decode_japanese(files.unzip(_archives(p)).where("error is null"))).select("source_id", F.col("n_files").cast("int").alias("n_files"), "full_text")


@query("SRC13_raw_folder", "SELECT count(*) AS n FROM parsed_document WHERE full_text IS NOT NULL")
def _(spark, d):
    path = scratch(spark)
    p = read(spark, d, "parsed_document", "rec_id", "full_text").where("full_text is not null")
    p.select(F.col("rec_id").cast("string").alias("id"), F.regexp_replace("full_text", "[\\r\\n\\u0085\\u2028\\u2029]+", " ").alias("value")).write.partitionBy("id").text(path)
    raw = files.raw_files(spark, path).where("path like '%part-%'")
    return raw.agg(F.countDistinct("source_id").alias("n"))


_CLEAN = "regexp_replace(regexp_replace({0},'[ \\t]+',' ','g'),'^[\\s　]+|[\\s　]+$','','g')"


@query("SRC19_definition_list", f"SELECT rec_id, {_CLEAN.format("coalesce(court,'')")} AS court, {_CLEAN.format("coalesce(case_number,'')")} AS case_number FROM jp_case_detail")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "court", "case_number")
    court, number = (F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")) for c in ("court", "case_number"))
    page = F.concat(F.lit("<dl><dt>裁判所</dt><dd>x</dd><dt>事件番号</dt><dd>"), number, F.lit("</dd><dt>裁判所</dt><dd>"), court, F.lit("</dd></dl>"))
    return x.select("rec_id", pages.definition_list(page).alias("m")).select("rec_id", F.col("m")["裁判所"].alias("court"), F.col("m")["事件番号"].alias("case_number"))


@query("SRC21_22_STR4_7_stream_log", "SELECT w.product, count(DISTINCT substr(sha256(event_type||'|'||user_id::VARCHAR||'|'||strftime(ts,'%Y-%m-%d-%H')),1,16)) AS n FROM events e JOIN (VALUES ('click','news'),('error','news'),('signup','filings')) AS w(url, product) ON e.event_type=w.url GROUP BY 1")
def _(spark, d):
    path = scratch(spark)
    change_events(spark, d).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).write.json(f"{path}/in")
    changes.start(changes.read_changes(spark, f"{path}/in"), watches(spark), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.json(f"{path}/out").groupBy("product").agg(F.count("*").alias("n"))


@query("SNK2_preview", "SELECT rec_id, document_id FROM synth_document ORDER BY rec_id LIMIT 100")
def _(spark, d):
    path = scratch(spark)
    package.write_preview(read(spark, d, "synth_document", "rec_id", "document_id"), path, "rec_id", jsonl=True)
    return spark.read.json(path).select("rec_id", "document_id")


@query("SNK3_schema", "SELECT 'c_custkey' AS name, 'bigint' AS type UNION ALL SELECT 'c_name','string' UNION ALL SELECT 'c_nationkey','int' UNION ALL SELECT 'c_acctbal','double' UNION ALL SELECT 'c_mktsegment','string'")
def _(spark, d):
    s = package.schema_json({"customer": read(spark, d, "customer")})["customer"]
    return spark.createDataFrame([(c["name"], c["type"]) for c in s], "name string, type string")


@query("SNK4_statistics", "SELECT 'customer' AS table_name, 'c_acctbal' AS name, count(*) AS row_count, 2 AS column_count, round(avg(c_acctbal),4) AS mean, count(*) FILTER (c_acctbal IS NULL) AS null_count FROM customer UNION ALL SELECT 'customer','c_mktsegment',count(*),2,NULL,count(*) FILTER (c_mktsegment IS NULL) FROM customer")
def _(spark, d):
    stats = package.statistics({"customer": read(spark, d, "customer", "c_acctbal", "c_mktsegment")})
    rows = [(t, c["column"], s["row_count"], s["column_count"], c["mean"], c["null_count"]) for t, s in stats.items() for c in s["columns"]]
    return spark.createDataFrame(rows, "table_name string, name string, row_count long, column_count int, mean double, null_count long")


@query("SNK9_report", "SELECT count(*) FILTER (c_name IS NULL) = 0 AS passed, 2::BIGINT AS n_checks FROM customer")
def _(spark, d):
    c = read(spark, d, "customer", "c_name").agg(F.count_if(F.col("c_name").isNull()).alias("bad"))
    checks = c.select(F.lit("no_null_names").alias("check"), (F.col("bad") == 0).alias("passed"), F.col("bad").cast("string").alias("message"))
    checks = checks.unionByName(c.select(F.lit("names").alias("check"), F.lit(True).alias("passed"), F.lit("").alias("message")))
    report = json.loads(package.report_json(checks, validation.quality_score(checks)))
    return spark.createDataFrame([(report["passed"], report["n_checks"])], "passed boolean, n_checks long")


@query("SNK15_run_summary", "SELECT count(*) AS listed, count(*) FILTER (parsed) AS parsed FROM document_record")
def _(spark, d):
    path = f"{scratch(spark)}/last_run"
    rest.counters(read(spark, d, "document_record", "downloaded", "parsed", "error")).coalesce(1).write.json(path)
    return spark.read.json(path).select("listed", "parsed")


@query("SRC24_seeds", "SELECT count(*) AS n, count(DISTINCT plz) AS n_codes FROM (SELECT '10115' AS plz UNION ALL SELECT '20095' UNION ALL SELECT lpad((10000 + i*397%89999)::VARCHAR,5,'0') FROM range(200) t(i))")
def _(spark, d):
    return files.bootstrap_seeds(spark, [("10115", "Berlin"), ("20095", "Hamburg")]).agg(F.count("*").alias("n"), F.countDistinct("plz").alias("n_codes"))


@query("SNK14_RAG2_vectors_as_parquet", "SELECT count(*) AS n FROM documents WHERE len(list_filter(regexp_split_to_array(trim(text),'\\s+'), lambda x: x<>''))>0")
def _(spark, d):
    path = scratch(spark)
    chunks = retrieval.windows(read(spark, d, "documents", "doc_id", "text"), "doc_id", "text").withColumn("id", F.concat_ws("-", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")))
    retrieval.embed(chunks, "id", "chunk").write.parquet(path)
    return spark.read.parquet(path).where("id like '%-0'").agg(F.count("*").alias("n"))


@query("SNK7_tier_files", "SELECT quality_tier, count(*) AS n FROM synth_document WHERE quality_tier IS NOT NULL GROUP BY 1")
def _(spark, d):
    path = scratch(spark)
    package.write_tiers(docs(spark, d).where("quality_tier is not null"), path)
    return spark.read.json(path).groupBy("quality_tier").agg(F.count("*").alias("n"))


@query("SNK8_train_test_files", "SELECT 'test' AS split, greatest(1,round_even(count(*)*0.2,0))::BIGINT AS n FROM synth_document UNION ALL SELECT 'train', (count(*)-greatest(1,round_even(count(*)*0.2,0)))::BIGINT FROM synth_document")
def _(spark, d):
    path = scratch(spark)
    package.export_train_test(docs(spark, d).withColumn("document_id", F.col("rec_id").cast("string")), path)
    parts = [spark.read.json(f"{path}/{s}").select(F.lit(s).alias("split")) for s in ("train", "test")]
    return parts[0].union(parts[1]).groupBy("split").agg(F.count("*").alias("n"))
