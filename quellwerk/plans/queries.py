"""Queries over the test tables, each with SQL that another engine can run, where SQL can say it.

A query is ``@query("ID_name", sql)`` on a function of (spark, folder). They run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quellwerk.functions import pages, text
from quellwerk.functions import patterns as P
from quellwerk.operators import distributions, flaws, generation, retrieval, sampling, segments, validation
from quellwerk.sources import files, rest
from quellwerk.streaming import changes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def read(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*cols) if cols else df


def _u(seed: int, *keys: str) -> str:
    """SQL of :func:`quellwerk.functions.text.uniform`."""
    return f"(('0x'||substr(md5('{seed}:'||{'||chr(58)||'.join(keys)}),1,8))::BIGINT/4294967296.0)"


_SEGS = ["seg_company_overview", "seg_business_status", "seg_business_risks", "seg_md_and_a"]
_MELT = "(" + " UNION ALL ".join(f"SELECT rec_id, document_id, quality_tier, error_rate, '{c[4:]}' AS segment, {c} AS text FROM synth_document" for c in _SEGS) + ")"
_N = "coalesce(length(text),0)"


def docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "synth_document", "rec_id", "document_id", "document_content", *_SEGS, "quality_tier", "error_rate")


def long(spark: SparkSession, d: str, *ids: str) -> DataFrame:
    return segments.melt(docs(spark, d), *(ids or ("rec_id", "document_id")))


# ---- reshape and segment statistics ----


@query("RSH1_melt_segments", f"SELECT rec_id, document_id, segment, text FROM {_MELT}")
def _(spark, d):
    return long(spark, d)


@query("RSH2_extract_segment", "SELECT document_id, seg_business_risks AS text FROM synth_document")
def _(spark, d):
    return segments.extract_segment(docs(spark, d), "business_risks")


@query("RSH3_explode_flaws", "SELECT rec_id, f.type AS type, f.match AS match, f.context AS context FROM (SELECT rec_id, unnest(identified_flaws) AS f FROM jp_case_detail)")
def _(spark, d):
    return read(spark, d, "jp_case_detail", "rec_id", "identified_flaws").select("rec_id", F.inline("identified_flaws"))


@query("AGG1_segment_length_stats", f"""SELECT segment, count(*) AS n, min({_N})::BIGINT AS min, max({_N})::BIGINT AS max, round(avg({_N}),1) AS mean, round(median({_N}),1) AS median,
  round(stddev({_N}),1) AS sd, round(avg(CASE WHEN {_N}=0 THEN 1.0 ELSE 0.0 END)*100,1) AS pct_empty FROM {_MELT} GROUP BY segment""")
def _(spark, d):
    return segments.length_stats(long(spark, d))


@query("AGG2_segment_summary", f"""SELECT segment, count(*) AS n, min({_N})::BIGINT AS min, max({_N})::BIGINT AS max, round(avg({_N}),6) AS mean, round(median({_N}),6) AS median,
  round(stddev({_N}),6) AS sd, round(avg(CASE WHEN {_N}=0 THEN 1.0 ELSE 0.0 END)*100,6) AS pct_empty, round(avg({_N}/2.0),6) AS est_tokens FROM {_MELT} GROUP BY segment""")
def _(spark, d):
    s = segments.length_stats(long(spark, d), None)
    return s.select("segment", "n", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "median", "sd", "pct_empty", "est_tokens")])


@query("AGG3_tier_distribution", "SELECT quality_tier, count(*) AS n, round(count(*)/sum(count(*)) OVER ()*100,1) AS pct FROM synth_document GROUP BY quality_tier")
def _(spark, d):
    return segments.tier_distribution(docs(spark, d))


_TIERS_SQL = "(VALUES " + ",".join(f"('{t}',{100 * p}::DOUBLE)" for t, p, _ in P.TIERS) + ") AS e(t, expected_pct)"
_SUM_LEN = "(" + "+".join(f"coalesce(length({c}),0)" for c in _SEGS) + ")/4.0"


@query("AGG4_compare_tiers", f"""SELECT quality_tier, n, round(mean_error_rate,6) AS mean_error_rate, round(m,6) AS mean_segment_chars, round(pct,6) AS pct, expected_pct, round(pct-expected_pct,6) AS deviation,
  CASE quality_tier WHEN 'perfect' THEN 0 WHEN 'near' THEN 1 WHEN 'moderate' THEN 2 WHEN 'severe' THEN 3 ELSE 4 END AS tier_order
  FROM (SELECT quality_tier, count(*) AS n, avg(error_rate) AS mean_error_rate, avg({_SUM_LEN}) AS m, count(*)/sum(count(*)) OVER ()*100 AS pct FROM synth_document GROUP BY quality_tier) LEFT JOIN {_TIERS_SQL} ON quality_tier=t""")
def _(spark, d):
    x = segments.compare_tiers(docs(spark, d))
    return x.select("quality_tier", "n", *[F.round(c, 6).alias(c) for c in ("mean_error_rate", "mean_segment_chars", "pct")], "expected_pct", F.round("deviation", 6).alias("deviation"), "tier_order")


@query("AGG17_section_scorecard", f"""SELECT segment, round(100-pe,4) AS completeness, round(least(100,100*(1-sd/greatest(m,1))),4) AS length_consistency, round(et/greatest(max(et) OVER (),1e-9)*100,4) AS token_richness,
  round(((100-pe)+greatest(least(100,100*(1-sd/greatest(m,1))),0))/2,4) AS section_score
  FROM (SELECT segment, avg({_N}) AS m, coalesce(stddev({_N}),0) AS sd, avg(CASE WHEN {_N}=0 THEN 1.0 ELSE 0.0 END)*100 AS pe, avg({_N}/2.0) AS et FROM {_MELT} GROUP BY segment)""")
def _(spark, d):
    s = segments.scorecard(segments.length_stats(long(spark, d), None))
    return s.select("segment", *[F.round(c, 4).alias(c) for c in s.columns[1:]])


@query("AGG21_validation_summary", f"""SELECT a.n_documents, b.n_segments, b.n_segment_types, round(b.c*100,1) AS coverage_pct, round(a.m,1) AS mean_document_chars, b.c>0.9 AS passed
  FROM (SELECT count(*) AS n_documents, avg(coalesce(length(document_content),0)) AS m FROM synth_document) a, (SELECT count(*) AS n_segments, count(DISTINCT segment) AS n_segment_types, avg(CASE WHEN {_N}>0 THEN 1.0 ELSE 0.0 END) AS c FROM {_MELT}) b""")
def _(spark, d):
    return segments.validation_summary(docs(spark, d))


@query("AGG24_tier_counts", "SELECT coalesce(quality_tier,'(none)') AS quality_tier, count(*) AS n FROM synth_document GROUP BY 1")
def _(spark, d):
    return docs(spark, d).groupBy(F.coalesce("quality_tier", F.lit("(none)")).alias("quality_tier")).agg(F.count("*").alias("n"))


@query("SRT4_SNK12_segment_order", f"SELECT segment, row_number() OVER (ORDER BY median({_N}), segment) AS position, median({_N})::DOUBLE AS median FROM {_MELT} GROUP BY segment")
def _(spark, d):
    s = long(spark, d).groupBy("segment").agg(F.median(segments.chars(F.col("text"))).cast("double").alias("median"))
    return s.select("segment", F.row_number().over(Window.orderBy("median", "segment")).alias("position"), "median")


@query("FIL8_non_empty_segments", f"SELECT rec_id, segment, length(text)::BIGINT AS n_chars FROM {_MELT} WHERE length(text)>0")
def _(spark, d):
    return long(spark, d).where(F.length("text") > 0).select("rec_id", "segment", F.length("text").cast("bigint").alias("n_chars"))


_EMPTY_SQL = f"(SELECT segment, text FROM {_MELT} UNION ALL SELECT 'outlook', CASE WHEN rec_id%8=0 THEN '' ELSE seg_md_and_a END FROM synth_document)"


@query("FIL9_empty_rate_alert", f"SELECT segment, round(avg(CASE WHEN {_N}=0 THEN 1.0 ELSE 0.0 END)*100,1) AS pct_empty FROM {_EMPTY_SQL} GROUP BY segment HAVING avg(CASE WHEN {_N}=0 THEN 1.0 ELSE 0.0 END)*100>10")
def _(spark, d):
    x = docs(spark, d).withColumn("seg_outlook", F.when(F.col("rec_id") % 8 == 0, "").otherwise(F.col("seg_md_and_a")))  # planted: an eighth is empty
    return segments.empty_alert(segments.melt(x, "rec_id"))


@query("SRT3_tier_order", "SELECT DISTINCT quality_tier, CASE quality_tier WHEN 'perfect' THEN 0 WHEN 'near' THEN 1 WHEN 'moderate' THEN 2 WHEN 'severe' THEN 3 ELSE 4 END AS tier_order FROM synth_document")
def _(spark, d):
    return docs(spark, d).select("quality_tier").distinct().withColumn("tier_order", segments.tier_order(F.col("quality_tier")))


@query("WIN1_rolling_mean", "SELECT rec_id, round(avg(length(document_content)) OVER (PARTITION BY quality_tier ORDER BY rec_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),4) AS rolling_mean FROM synth_document")
def _(spark, d):
    x = docs(spark, d).withColumn("n", F.length("document_content"))
    return segments.rolling_mean(x, "n", "rec_id", ["quality_tier"]).select("rec_id", F.round("rolling_mean", 4).alias("rolling_mean"))


@query("WIN2_share_of_total", "SELECT court, count(*) AS n, round(count(*)/sum(count(*)) OVER (),6) AS share FROM jp_case_detail GROUP BY court")
def _(spark, d):
    n = read(spark, d, "jp_case_detail", "court").groupBy("court").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 6))


@query("WIN6_normalise_by_max", f"SELECT segment, round(avg({_N})/max(avg({_N})) OVER (),6) AS relative FROM {_MELT} GROUP BY segment")
def _(spark, d):
    s = long(spark, d).groupBy("segment").agg(F.avg(segments.chars(F.col("text"))).alias("m"))
    return s.select("segment", F.round(F.col("m") / F.max("m").over(Window.partitionBy(F.lit(0))), 6).alias("relative"))


# ---- flaws ----

def _flaws_of(melt: str) -> str:
    return _FLAW_SQL.replace(_MELT, melt, 1)


_FLAW_SQL = f"""WITH t AS (SELECT rec_id::VARCHAR AS document_id, segment, text, quality_tier FROM {_MELT}),
 w AS (SELECT document_id, segment, list_filter(regexp_split_to_array(text,'\\s+'), lambda x: true) AS w FROM t WHERE coalesce(text,'')<>''),
 g AS (SELECT document_id, segment, unnest(list_transform(range(1, len(w)-1), lambda i: w[i]||' '||w[i+1]||' '||w[i+2])) AS g FROM w WHERE len(w)>=6),
 r AS (SELECT document_id, segment, list_sort(list(g)) AS gs FROM (SELECT document_id, segment, g, count(*) AS n FROM g GROUP BY ALL) WHERE n>=3 GROUP BY 1,2),
 f AS (SELECT document_id, segment, 'structural' AS flaw_type, 'empty_section' AS flaw_subtype, 'high' AS severity, 1.0::DOUBLE AS confidence, 'Section is completely empty' AS description, '<empty>' AS evidence FROM t WHERE coalesce(text,'')=''
  UNION ALL SELECT document_id, segment, 'structural','stub_section','medium',0.9,'Section is suspiciously short (< 20 chars)',text FROM t WHERE text<>'' AND length(text)<20
  UNION ALL SELECT document_id, segment, 'formatting','garbled_characters','high',0.85,'Detected garbled or replacement characters',substr(text,1,100) FROM t WHERE text<>'' AND regexp_matches(text,'�{{2,}}|[\\x{{92}}-\\x{{94}}]')
  UNION ALL SELECT document_id, segment, 'encoding','non_jis_characters','high',0.7,'Possible Simplified Chinese characters in Japanese text',substr(text,1,200) FROM t WHERE text<>'' AND regexp_matches(text,'[\\x{{2e80}}-\\x{{2eff}}]')
  UNION ALL SELECT document_id, segment, 'content','repetition','medium',0.6,'Repeated trigram(s) detected: '||len(gs)::VARCHAR||' unique',array_to_string(gs[1:3],'; ') FROM r
  UNION ALL SELECT document_id, segment, 'generation','generation_failed','critical',1.0,'LLM generation failure sentinel detected',substr(text,1,200) FROM t WHERE contains(text,'[GENERATION_FAILED')
  UNION ALL SELECT document_id, segment, 'disclosure','generic_language','low',0.5,'Generic boilerplate phrase detected',CASE WHEN contains(text,'当社は上記の通り') THEN '当社は上記の通り' WHEN contains(text,'該当事項はありません') THEN '該当事項はありません' ELSE '特記すべき事項はありません' END FROM t WHERE contains(text,'当社は上記の通り') OR contains(text,'該当事項はありません') OR contains(text,'特記すべき事項はありません'))"""


def found_flaws(spark, d):
    return flaws.segment_flaws(long(spark, d, "rec_id").select(F.col("rec_id").cast("string").alias("document_id"), "segment", "text"))


_NOTES = "(SELECT rec_id, document_id, quality_tier, error_rate, 'notes' AS segment, CASE rec_id%5 WHEN 0 THEN 'so it goes, so it goes, so it goes, so it goes on' WHEN 1 THEN 'no words come back here at all today' WHEN 2 THEN 'bad �� mark in the text here' ELSE seg_md_and_a END AS text FROM synth_document)"


@query("FLW4_11_segment_flaws", _flaws_of(f"(SELECT * FROM {_MELT} UNION ALL SELECT * FROM {_NOTES})") + " SELECT document_id, segment, flaw_type, flaw_subtype, severity, confidence, description, evidence FROM f")
def _(spark, d):
    k = F.col("rec_id") % 5
    notes = F.when(k == 0, "so it goes, so it goes, so it goes, so it goes on").when(k == 1, "no words come back here at all today").when(k == 2, "bad \ufffd\ufffd mark in the text here").otherwise(F.col("seg_md_and_a"))
    x = segments.melt(docs(spark, d).withColumn("seg_notes", notes), "rec_id")  # planted: rules that the tables themselves never meet
    return flaws.segment_flaws(x.select(F.col("rec_id").cast("string").alias("document_id"), "segment", "text"))


@query("FLW8_repeated_trigrams", "SELECT doc_id, g AS trigram FROM (SELECT doc_id, unnest(list_transform(range(1, len(w)-1), lambda i: w[i]||' '||w[i+1]||' '||w[i+2])) AS g FROM (SELECT doc_id, regexp_split_to_array(text,'\\s+') AS w FROM documents WHERE text<>'') WHERE len(w)>=6) GROUP BY 1,2 HAVING count(*)>=3")
def _(spark, d):
    x = read(spark, d, "documents", "doc_id", "text").where("text != ''")
    return x.select("doc_id", F.explode(flaws.repeated_trigrams(F.col("text"))).alias("trigram"))


@query("TXT25_trigrams", """SELECT source, count(*) AS n_trigrams, count(DISTINCT g) AS n_different FROM (SELECT source, unnest(list_transform(range(1, len(w)-1), lambda i: w[i]||' '||w[i+1]||' '||w[i+2])) AS g
  FROM (SELECT source, regexp_split_to_array(text,'\\s+') AS w FROM documents WHERE text IS NOT NULL) WHERE len(w)>=6) GROUP BY source""")
def _(spark, d):
    x = read(spark, d, "documents", "source", "text").select("source", F.explode(text.trigrams(F.col("text"))).alias("g"))
    return x.groupBy("source").agg(F.count("*").alias("n_trigrams"), F.countDistinct("g").alias("n_different"))


@query("AGG19_flaws_by_type_severity", _FLAW_SQL + " SELECT flaw_type, severity, count(*) AS n FROM f GROUP BY 1,2")
def _(spark, d):
    return found_flaws(spark, d).groupBy("flaw_type", "severity").agg(F.count("*").alias("n"))


@query("AGG15_flaw_section_grid", _FLAW_SQL + " SELECT a.flaw_subtype, b.segment, count(f.document_id) AS n FROM (SELECT DISTINCT flaw_subtype FROM f) a CROSS JOIN (SELECT DISTINCT segment FROM t) b LEFT JOIN f ON f.flaw_subtype=a.flaw_subtype AND f.segment=b.segment GROUP BY 1,2")
def _(spark, d):
    f = found_flaws(spark, d)
    names = spark.createDataFrame([(c[4:],) for c in _SEGS], "segment string")
    return segments.complete_counts(f, "flaw_subtype", "segment", f.select("flaw_subtype").distinct(), names)


@query("AGG20_flaw_contingency", _FLAW_SQL + " SELECT flaw_type, count(*) FILTER (severity='high') AS high, count(*) FILTER (severity='medium') AS medium, count(*) FILTER (severity='low') AS low, count(*) FILTER (severity='critical') AS critical FROM f GROUP BY 1")
def _(spark, d):
    s = F.col("severity")
    return found_flaws(spark, d).groupBy("flaw_type").agg(*[F.count_if(s == k).alias(k) for k in ("high", "medium", "low", "critical")])


def per_document(spark, d):
    n = found_flaws(spark, d).groupBy("document_id").agg(F.count("*").alias("flaw_n"))
    x = docs(spark, d).select(F.col("rec_id").cast("string").alias("document_id"), "quality_tier")
    return x.join(n, "document_id", "left").fillna(0, ["flaw_n"])


_PER_DOC = _FLAW_SQL + ", p AS (SELECT s.rec_id::VARCHAR AS document_id, s.quality_tier, coalesce(n,0) AS flaw_n FROM synth_document s LEFT JOIN (SELECT document_id, count(*) AS n FROM f GROUP BY 1) c ON c.document_id=s.rec_id::VARCHAR)"


@query("JOIN1_2_flaws_per_document", _PER_DOC + " SELECT document_id, quality_tier, flaw_n FROM p")
def _(spark, d):
    return per_document(spark, d)


@query("JOIN3_flaws_with_tier", _FLAW_SQL + " SELECT s.quality_tier, f.flaw_subtype, count(*) AS n FROM f JOIN synth_document s ON s.rec_id::VARCHAR=f.document_id GROUP BY 1,2")
def _(spark, d):
    x = docs(spark, d).select(F.col("rec_id").cast("string").alias("document_id"), "quality_tier")
    return found_flaws(spark, d).join(x, "document_id").groupBy("quality_tier", "flaw_subtype").agg(F.count("*").alias("n"))


@query("AGG16_tier_flaw_density", _PER_DOC + " SELECT quality_tier, count(*) AS n_docs, round(avg(flaw_n),4) AS mean_flaws, median(flaw_n)::DOUBLE AS median_flaws, max(flaw_n) AS max_flaws FROM p GROUP BY 1")
def _(spark, d):
    return per_document(spark, d).groupBy("quality_tier").agg(F.count("*").alias("n_docs"), F.round(F.avg("flaw_n"), 4).alias("mean_flaws"), F.median("flaw_n").cast("double").alias("median_flaws"), F.max("flaw_n").alias("max_flaws"))


@query("AGG5_anova", _PER_DOC + """, gr AS (SELECT quality_tier, count(*) AS n, avg(flaw_n) AS m, coalesce(var_pop(flaw_n),0) AS v FROM p WHERE quality_tier IS NOT NULL GROUP BY 1),
  s AS (SELECT sum(n) AS n, count(*) AS k, sum(n*m) AS s, sum(n*m*m) AS q, sum(n*v) AS w FROM gr)
  SELECT (k-1)::BIGINT AS df_between, (n-k)::BIGINT AS df_within, round(q-s*s/n,4) AS ss_between, round(w,4) AS ss_within, round(((q-s*s/n)/(k-1))/(w/(n-k)),4) AS f_statistic FROM s""")
def _(spark, d):
    return distributions.anova(per_document(spark, d), "quality_tier", "flaw_n").drop("p_value")


@query("AGG5_anova_p_value")
def _(spark, d):
    return distributions.anova(per_document(spark, d), "quality_tier", "flaw_n").select("f_statistic", "p_value")


_TIER_THERE = "(SELECT (count(quality_tier)>0)::INT FROM synth_document)"


@query("AGG22_buyer_scorecard", _FLAW_SQL + f""", m AS (SELECT avg(a) AS m FROM (SELECT segment, avg({_N}) AS a FROM t GROUP BY 1)), c AS (SELECT count(*) FILTER (severity='critical')*100.0/(SELECT count(*) FROM synth_document) AS c FROM f),
  x AS (SELECT ((SELECT count(DISTINCT segment) FROM t)>=6)::INT+(m>100)::INT+{_TIER_THERE}+(c<5)::INT+(m>200)::INT AS score FROM m, c), y AS (SELECT score, 5 AS checks, round_even(score/5.0*100,0)::BIGINT AS final_score FROM x)
  SELECT *, CASE WHEN final_score>=80 THEN 'sufficient' WHEN final_score>=60 THEN 'promising' ELSE 'doubtful' END AS verdict FROM y""")
def _(spark, d):
    n = segments.length_stats(long(spark, d), None).agg(F.avg("mean").alias("m"), F.count("*").alias("n_segments"))
    own = docs(spark, d).agg(F.count("*").alias("n"), F.count("quality_tier").alias("n_tiers"))
    c = found_flaws(spark, d).agg(F.count_if(F.col("severity") == "critical").alias("k"))
    one = n.crossJoin(c).crossJoin(own)  # one row each
    return segments.buyer_scorecard(one)


@query("FLW1_3_filing_flaws")
def _(spark, d):
    p = read(spark, d, "parsed_document", "rec_id", "segments").select(F.col("rec_id").cast("string").alias("source_id"), "segments")
    return flaws.filing_flaws(p).select("source_id", "segment", "flaw_type", "flaw_subtype", "severity", "evidence")


@query("FLW2_suspiciously_short", "SELECT rec_id, s.key AS segment FROM (SELECT rec_id, unnest(map_entries(segments)) AS s FROM parsed_document) WHERE length(coalesce(s.value,''))<100")
def _(spark, d):
    x = read(spark, d, "parsed_document", "rec_id", "segments").select("rec_id", F.explode("segments").alias("segment", "text"))
    return x.where(F.length(F.coalesce("text", F.lit(""))) < 100).select("rec_id", "segment")


_EXPECTED = "[" + ",".join(f"'{s}'" for s in P.EXPECTED_SECTIONS) + "]"


@query("FLW3_JOIN9_missing_sections", f"SELECT rec_id, unnest(list_filter({_EXPECTED}, lambda x: NOT list_contains(coalesce(map_keys(segments),[]), x))) AS segment FROM parsed_document")
def _(spark, d):
    x = read(spark, d, "parsed_document", "rec_id", "segments")
    return x.select("rec_id", F.explode(F.array_except(F.array(*map(F.lit, P.EXPECTED_SECTIONS)), F.coalesce(F.map_keys("segments"), F.array().cast("array<string>")))).alias("segment"))


@query("AGG8_flaw_taxonomy")
def _(spark, d):
    p = read(spark, d, "parsed_document", "rec_id", "segments").select(F.col("rec_id").cast("string").alias("source_id"), "segments")
    return flaws.taxonomy(flaws.filing_flaws(p), p.count())


_JA_MENTIONS = ["届出書に記載漏れがある。", "申請書の署名がない。", "金額の誤りがあり、理由と矛盾する。", "記載が不十分である。", "両者の説明には食い違いがある。", ""]
_JA_TEXT = "(SELECT rec_id, full_text||list_extract([" + ",".join(f"'{x}'" for x in _JA_MENTIONS) + f"],(rec_id%{len(_JA_MENTIONS)}+1)::INT) AS full_text FROM jp_case_detail)"


def mentioning(spark, d):
    """Whole texts with a planted sentence each: the tables themselves mention none of these flaws."""
    x = read(spark, d, "jp_case_detail", "rec_id", "full_text")
    return x.select("rec_id", F.concat("full_text", F.element_at(F.array(*map(F.lit, _JA_MENTIONS)), (F.col("rec_id") % len(_JA_MENTIONS) + 1).cast("int"))).alias("full_text"))


@query("AGG9_court_taxonomy_ja")
def _(spark, d):
    return flaws.court_taxonomy(flaws.mentions(mentioning(spark, d), P.JP_FLAWS, 50, False))


@query("TXT12_de_flaw_mentions", "SELECT type, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS type, unnest(regexp_extract_all(full_text, '(?i){p}')) AS m FROM de_case_detail" for p, t in P.DE_FLAWS) + ") GROUP BY 1")
def _(spark, d):
    return flaws.mention_counts(read(spark, d, "de_case_detail", "full_text"), P.DE_FLAWS, True)


@query("TXT13_jp_flaw_mentions", "SELECT type, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS type, unnest(regexp_extract_all(full_text, '{p}')) AS m FROM {_JA_TEXT}" for p, t in P.JP_FLAWS) + ") GROUP BY 1")
def _(spark, d):
    return flaws.mention_counts(mentioning(spark, d), P.JP_FLAWS, False)


_PLAN = ["The plan failed to specify the support.", "There is no clear outcome, and the annual review was not completed.", "The wording is plain."]


@query("TXT30_plan_flaws", "WITH x AS (SELECT concat_ws(' ',text,list_extract([" + ",".join(f"'{x}'" for x in _PLAN) + "],(doc_id%3+1)::INT)) AS full_text FROM documents) SELECT type, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS type, unnest(regexp_extract_all(full_text, '(?i){p}')) AS m FROM x" for p, t in P.PLAN_FLAWS) + ") GROUP BY 1")
def _(spark, d):
    planted = F.element_at(F.array(*map(F.lit, _PLAN)), (F.col("doc_id") % 3 + 1).cast("int"))
    return flaws.mention_counts(read(spark, d, "documents", "doc_id", "text").select(F.concat_ws(" ", "text", planted).alias("full_text")), P.PLAN_FLAWS, True)


@query("TXT12_de_flaw_contexts")
def _(spark, d):
    return flaws.mentions(read(spark, d, "de_case_detail", "rec_id", "full_text"), P.DE_FLAWS, 80, True)


# ---- distributions ----


@query("AGG6_ks_two_sample", f"""WITH v AS (SELECT segment, CASE WHEN quality_tier='perfect' THEN 'a' ELSE 'b' END AS s, {_N} AS x FROM {_MELT}), p AS (SELECT segment, x, sum((s='a')::INT) AS na, sum((s='b')::INT) AS nb FROM v GROUP BY 1,2),
  c AS (SELECT segment, sum(na) OVER w AS ca, sum(nb) OVER w AS cb, sum(na) OVER (PARTITION BY segment) AS n, sum(nb) OVER (PARTITION BY segment) AS m FROM p WINDOW w AS (PARTITION BY segment ORDER BY x ROWS UNBOUNDED PRECEDING))
  SELECT segment, max(n)::BIGINT AS n_a, max(m)::BIGINT AS n_b, round(max(abs(ca/n-cb/m)),4) AS ks_statistic FROM c GROUP BY segment""")
def _(spark, d):
    x = segments.melt(docs(spark, d), "quality_tier").select("segment", F.when(F.col("quality_tier") == "perfect", "a").otherwise("b").alias("side"), segments.chars(F.col("text")).alias("n"))
    return distributions.ks_two_sample(x, "segment", "side", "n").select("segment", "n_a", "n_b", "ks_statistic")


@query("AGG6_ks_verdicts")
def _(spark, d):
    x = segments.melt(docs(spark, d), "quality_tier").select("segment", F.when(F.col("quality_tier") == "perfect", "a").otherwise("b").alias("side"), segments.chars(F.col("text")).alias("n"))
    return distributions.ks_two_sample(x, "segment", "side", "n")


@query("AGG7_fit_lengths", f"""SELECT segment, n, round(an,2) AS aic_normal, round(al,2) AS aic_lognormal, CASE WHEN al<an THEN 'lognormal' ELSE 'normal' END AS best_fit FROM (SELECT segment, count(*) AS n,
  4+2*count(*)*(0.5*ln(2*pi())+0.5+ln(greatest(stddev_pop({_N}),1e-300))) AS an, 4+2*count(*)*(0.5*ln(2*pi())+0.5+ln(greatest(stddev_pop(ln({_N})),1e-300)))+2*count(*)*avg(ln({_N})) AS al FROM {_MELT} WHERE {_N}>0 GROUP BY segment HAVING count(*)>=10)""")
def _(spark, d):
    return distributions.fit_lengths(long(spark, d).withColumn("n_chars", segments.chars(F.col("text"))), "segment", "n_chars")


_CDF = "CASE WHEN {0}>=0 THEN 1-{1} ELSE {1} END"
_TAIL = "(0.3989422804014327*exp(-{0}*{0}/2)*{1}*(0.319381530+{1}*(-0.356563782+{1}*(1.781477937+{1}*(-1.821255978+{1}*1.330274429)))))"


def _cdf_sql(z: str) -> str:
    return _CDF.format(z, _TAIL.format(z, f"(1/(1+0.2316419*abs({z})))"))


@query("AGG7_fit_distances", f"""WITH v AS (SELECT segment, {_N}::DOUBLE AS x FROM {_MELT} WHERE {_N}>0), s AS (SELECT segment, count(*) AS n, avg(x) AS m, stddev_pop(x) AS sd, avg(ln(x)) AS lm, stddev_pop(ln(x)) AS lsd FROM v GROUP BY 1),
  c AS (SELECT segment, x, count(*) AS k, sum(count(*)) OVER (PARTITION BY segment ORDER BY x) AS c FROM v GROUP BY 1,2),
  z AS (SELECT segment, n, k, c, (x-m)/greatest(sd,1e-300) AS a, (ln(x)-lm)/greatest(lsd,1e-300) AS b FROM c JOIN s USING (segment)), p AS (SELECT segment, n, k, c, {_cdf_sql("a")} AS pa, {_cdf_sql("b")} AS pb FROM z)
  SELECT segment, round(max(greatest(abs(c/n-pa),abs((c-k)/n-pa))),4) AS ks_normal, round(max(greatest(abs(c/n-pb),abs((c-k)/n-pb))),4) AS ks_lognormal FROM p WHERE n>=10 GROUP BY segment""")
def _(spark, d):
    return distributions.fit_ks(long(spark, d).withColumn("n_chars", segments.chars(F.col("text"))), "segment", "n_chars")


@query("JOIN10_shared_segments", "SELECT key AS segment FROM (SELECT DISTINCT unnest(map_keys(segments)) AS key FROM parsed_document) WHERE key IN (" + ",".join(f"'{c[4:]}'" for c in _SEGS) + ")")
def _(spark, d):
    own = spark.createDataFrame([(c[4:],) for c in _SEGS], "segment string")
    return read(spark, d, "parsed_document", "segments").select(F.explode(F.map_keys("segments")).alias("segment")).intersect(own)


# ---- validation ----


@query("VAL9_16_document_checks", f"""SELECT * FROM (SELECT unnest([{{'check':'no_empty_documents','passed':e=0,'message':e::VARCHAR}},{{'check':'no_generation_errors','passed':g=0,'message':g::VARCHAR}},{{'check':'structural_completeness','passed':s=0,'message':s::VARCHAR}},{{'check':'segment_length_business_risks','passed':l=0,'message':l::VARCHAR}},{{'check':'keyword_business_risks','passed':k=0,'message':k::VARCHAR}}], recursive:=true)
  FROM (SELECT count(*) FILTER (coalesce(document_content,'')='') AS e, (count(*) FILTER (contains(document_id,'[GENERATION_FAILED')) + count(*) FILTER (contains(document_content,'[GENERATION_FAILED')) + count(*) FILTER (contains(quality_tier,'[GENERATION_FAILED'))
  + {'+'.join(f"count(*) FILTER (contains({c},'[GENERATION_FAILED'))" for c in _SEGS)}) AS g, {'+'.join(f"count(*) FILTER (coalesce({c},'')='')" for c in _SEGS)} AS s,
  count(*) FILTER (length(seg_business_risks)<20)+count(*) FILTER (length(seg_business_risks)>400) AS l, count(*) FILTER (NOT coalesce(contains(seg_business_risks,'リスク'),false)) AS k FROM synth_document))""")
def _(spark, d):
    return validation.document_checks(docs(spark, d), lengths={"business_risks": (20, 400)}, keywords={"business_risks": ["リスク"]})


@query("VAL13_language_consistency", "SELECT 'language_consistency' AS check, coalesce(avg(h)>=0.8,false) AS passed, round(avg(h),4)::VARCHAR AS message FROM (SELECT CASE WHEN coalesce(trim(document_content),'')<>'' AND regexp_matches(document_content,'[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') THEN 1.0 ELSE 0.0 END AS h FROM synth_document ORDER BY rec_id LIMIT 50)")
def _(spark, d):
    return validation.language_consistency(docs(spark, d), "ja", "rec_id")


@query("VAL1_7_table_checks")
def _(spark, d):
    c = read(spark, d, "customer")
    return validation.table_checks(c, c.columns, c.count())


@query("VAL6_german_plz", "SELECT count(*) AS n, count(*) FILTER (NOT (regexp_matches(p,'^[0-9]{5}$') AND p>='01000')) AS n_invalid FROM (SELECT CASE WHEN length(c_custkey::VARCHAR)<5 THEN lpad(c_custkey::VARCHAR,5,'0') ELSE c_custkey::VARCHAR END AS p FROM customer)")
def _(spark, d):
    s = F.col("c_custkey").cast("string")
    p = F.when(F.length(s) < 5, F.lpad(s, 5, "0")).otherwise(s)
    return read(spark, d, "customer", "c_custkey").agg(F.count("*").alias("n"), F.count_if(~(p.rlike("^[0-9]{5}$") & (p >= "01000"))).alias("n_invalid"))


@query("AGG28_VAL7_values_outside_set", "SELECT list_sort(list(DISTINCT document_type) FILTER (document_type NOT IN ('120','130')))::VARCHAR[] AS outside FROM document_record")
def _(spark, d):
    allowed = F.array(F.lit("120"), F.lit("130"))
    return read(spark, d, "document_record", "document_type").agg(F.array_sort(F.array_except(F.collect_set("document_type"), allowed)).alias("outside"))


@query("AGG12_quality_score")
def _(spark, d):
    return validation.quality_score(validation.document_checks(docs(spark, d)))


_NUM = ["c_custkey", "c_nationkey", "c_acctbal"]


@query("AGG10_column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, round(avg(({c} IS NULL)::INT),4) AS null_ratio, count(DISTINCT {c}) AS unique_count, "
    + (f"round(avg({c}),4) AS mean, round(stddev({c}),4) AS std, round(min({c})::DOUBLE,4) AS min, round(max({c})::DOUBLE,4) AS max, NULL::DOUBLE AS avg_length" if c in _NUM
       else f"NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, round(avg(length({c})),1)") + " FROM customer" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def _(spark, d):
    p = validation.profile(read(spark, d, "customer"))
    return p.select("column", "null_count", "null_ratio", "unique_count", "mean", "std", "min", "max", "avg_length")


@query("LIM3_top5_values", "SELECT value, n FROM (SELECT c_mktsegment AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS r FROM customer GROUP BY 1) WHERE r<=5")
def _(spark, d):
    return read(spark, d, "customer", "c_mktsegment").groupBy(F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(5)


@query("VAL5_drift_of_halves", "WITH h AS (SELECT CASE WHEN c_custkey<=(SELECT median(c_custkey) FROM customer) THEN 'a' ELSE 'b' END AS s, c_acctbal AS x FROM customer), p AS (SELECT x, sum((s='a')::INT) AS na, sum((s='b')::INT) AS nb FROM h GROUP BY 1), c AS (SELECT sum(na) OVER w AS ca, sum(nb) OVER w AS cb, sum(na) OVER () AS n, sum(nb) OVER () AS m FROM p WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING)) SELECT 'c_acctbal' AS \"column\", round(max(abs(ca/n-cb/m)),4) AS ks_statistic FROM c")
def _(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_acctbal")
    half = c.agg(F.median("c_custkey").alias("half"))
    x = c.crossJoin(F.broadcast(half)).select(F.lit("c_acctbal").alias("column"), F.when(F.col("c_custkey") <= F.col("half"), "a").otherwise("b").alias("side"), "c_acctbal")
    return distributions.ks_two_sample(x, "column", "side", "c_acctbal").select("column", "ks_statistic")


# ---- text functions ----

_ENT = "replace(replace(replace(replace(replace(replace({0},'&nbsp;',' '),'&amp;','&'),'&lt;','<'),'&gt;','>'),'&quot;','\"'),'&#12288;','　')"


def _html_sql(x: str) -> str:
    for p, r in (("(?is)<script[^>]*>.*?</script>", ""), ("(?is)<style[^>]*>.*?</style>", ""), ("(?i)<br\\s*/?\\s*>", "'||chr(10)||'"), ("(?i)</(?:p|div|tr|li|h[1-6])>", "'||chr(10)||'"), ("(?i)<(?:p|div|tr|li|h[1-6])[^>]*>", "'||chr(10)||'"), ("(?i)</(?:td|th)>", "'||chr(9)||'"), ("<[^>]+>", "")):
        x = f"regexp_replace({x},'{p}','{r}','g')"
    x = _ENT.format(x)
    return f"regexp_replace(regexp_replace(regexp_replace({x},'[ \\t]+',' ','g'),'\\n{{3,}}',chr(10)||chr(10),'g'),'^[\\s　]+|[\\s　]+$','','g')"


_PAGE_SQL = "(SELECT rec_id, '<html><style>p {x}</style><body><h1>'||coalesce(case_title,'')||'</h1><p>'||replace(full_text,chr(10),'<br/>')||'</p><script>var a = 1 < 2;</script><td>&amp;&nbsp;x</td></body></html>' AS h FROM jp_case_detail WHERE full_text IS NOT NULL)"


@query("TXT1_html_to_text", f"SELECT rec_id, {_html_sql('h')} AS text FROM {_PAGE_SQL}")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "case_title", "full_text").where("full_text is not null")
    h = F.concat(F.lit("<html><style>p {x}</style><body><h1>"), F.coalesce("case_title", F.lit("")), F.lit("</h1><p>"), F.replace("full_text", F.lit("\n"), F.lit("<br/>")), F.lit("</p><script>var a = 1 < 2;</script><td>&amp;&nbsp;x</td></body></html>"))
    return x.select("rec_id", text.html_to_text(h).alias("text"))


@query("TXT1_2_response_texts")
def _(spark, d):
    """Every response with content, in whatever encoding."""
    x = read(spark, d, "http_response", "rec_id", "content").where("content is not null")
    return files.decode_japanese(x, "content").select("rec_id", text.html_to_text(F.col("text")).alias("text"))


@query("TXT2_charset_fallback")
def _(spark, d):
    x = read(spark, d, "http_response", "rec_id", "content").where("content is not null")
    return files.decode_japanese(x, "content").select("rec_id", F.length("text").cast("bigint").alias("n_chars"))


@query("TXT5_report_sections")
def _(spark, d):
    p = read(spark, d, "parsed_document", "rec_id", "full_text").where("full_text is not null")
    return p.select("rec_id", F.explode(text.report_sections(F.col("full_text"))).alias("section", "text"))


@query("TXT6_german_sections")
def _(spark, d):
    x = read(spark, d, "de_case_detail", "rec_id", "full_text").where("full_text is not null")
    return x.select("rec_id", *[text.german_section(F.col("full_text"), s).alias(s.lower()) for s in ("Tenor", "Tatbestand", "Leitsatz")], text.german_section(F.col("full_text"), "Entscheidungsgründe").alias("gruende"))


@query("TXT7_japanese_sections")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "full_text").where("full_text is not null")
    return x.select("rec_id", text.japanese_section(F.col("full_text"), "主文").alias("judgment"), text.japanese_section(F.col("full_text"), "理由").alias("reasons"))


@query("TXT8_bgb_sections", """SELECT rec_id, list_sort(list_distinct(list_transform(list_concat(list_concat(regexp_extract_all(full_text,'§\\s*(\\d+[a-z]?)\\s*(?:Abs\\.\\s*\\d+\\s*)?(?:S\\.\\s*\\d+\\s*)?(?:Nr\\.\\s*\\d+\\s*)?BGB',1),
  regexp_extract_all(full_text,'§§\\s*([\\d,\\s]+(?:bis|[-–])\\s*\\d+[a-z]?)\\s*BGB',1)),regexp_extract_all(full_text,'BGB\\s*§\\s*(\\d+[a-z]?)',1)), lambda x: '§'||x||' BGB'))) AS sections FROM de_case_detail WHERE full_text IS NOT NULL""")
def _(spark, d):
    x = read(spark, d, "de_case_detail", "rec_id", "full_text").where("full_text is not null")
    return x.select("rec_id", text.bgb_sections(F.col("full_text")).alias("sections"))


def _all_sql(rules) -> str:
    return "list_sort(list_distinct(flatten([" + ",".join(f"regexp_extract_all(full_text,'{p}')" for p in rules) + "])))"


def _first_sql(rules, flags="") -> str:
    return "list_sort(list_distinct(list_filter([" + ",".join(f"regexp_extract(full_text,'{flags}{p}')" for p in rules) + "], lambda x: x<>'')))"


@query("TXT9_jp_statutes", f"SELECT rec_id, {_all_sql(P.JP_STATUTES)} AS statutes FROM jp_case_detail WHERE full_text IS NOT NULL")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "full_text").where("full_text is not null")
    return x.select("rec_id", text.all_matches(F.col("full_text"), P.JP_STATUTES).alias("statutes"))


@query("TXT10_de_documents", f"SELECT rec_id, {_first_sql(P.DE_DOCUMENTS, '(?i)')} AS documents FROM de_case_detail WHERE full_text IS NOT NULL")
def _(spark, d):
    x = read(spark, d, "de_case_detail", "rec_id", "full_text").where("full_text is not null")
    return x.select("rec_id", text.first_matches(F.col("full_text"), P.DE_DOCUMENTS, "(?iu)").alias("documents"))


@query("TXT11_jp_documents", f"SELECT rec_id, {_first_sql(P.JP_DOCUMENTS)} AS documents FROM jp_case_detail WHERE full_text IS NOT NULL")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "full_text").where("full_text is not null")
    return x.select("rec_id", text.first_matches(F.col("full_text"), P.JP_DOCUMENTS).alias("documents"))


@query("TXT14_15_fill_empty_fields", "SELECT rec_id, coalesce(nullif(ecli,''),aktenzeichen) AS reference, coalesce(nullif(leitsatz,''),nullif(case_title,'')) AS title FROM de_case_detail")
def _(spark, d):
    x = read(spark, d, "de_case_detail", "rec_id", "ecli", "aktenzeichen", "leitsatz", "case_title")
    return x.select("rec_id", pages.fill_empty(F.col("ecli"), F.col("aktenzeichen")).alias("reference"), pages.fill_empty(F.col("leitsatz"), F.nullif("case_title", F.lit(""))).alias("title"))


@query("TXT16_17_language_markers", "SELECT doc_id, regexp_matches(text,'[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') AS is_ja, regexp_matches(text,'[äöüÄÖÜß]') OR len(list_intersect(regexp_split_to_array(regexp_replace(lower(text),'^[\\s　]+|[\\s　]+$','','g'),'[\\s　]+'),['und','der','die','das','ist','für','mit','von','auf']))>=2 AS is_de FROM documents")
def _(spark, d):
    return read(spark, d, "documents", "doc_id", "text").select("doc_id", text.is_japanese(F.col("text")).alias("is_ja"), text.is_german(F.col("text")).alias("is_de"))


@query("TXT18_20_assemble")
def _(spark, d):
    parts = F.array(*[F.struct(F.lit(c[4:]).alias("label"), F.coalesce(c, F.lit("")).alias("content")) for c in _SEGS])
    x = docs(spark, d)
    return x.select("rec_id", text.markdown(F.col("document_id"), parts).alias("markdown"), text.json_document(F.col("document_id"), parts).alias("json"), text.plain(parts).alias("plain"))


@query("TXT23_token_estimate", "SELECT doc_id, length(text)/2.0 AS tokens_two, round(length(text)/1.5,4) AS tokens_buyer FROM documents WHERE text IS NOT NULL")
def _(spark, d):
    n = F.length("text")
    return read(spark, d, "documents", "doc_id", "text").where("text is not null").select("doc_id", (n / 2.0).alias("tokens_two"), F.round(n / 1.5, 4).alias("tokens_buyer"))


@query("TXT24_eta", """SELECT event_id, CASE WHEN v<60 THEN format('{}s',v::BIGINT) WHEN v<3600 THEN format('{}m {}s',(v//60)::BIGINT,(v%60)::BIGINT) WHEN v<86400 THEN format('{}h {}m',(v//3600)::BIGINT,((v%3600)//60)::BIGINT) ELSE format('{}d {}h',(v//86400)::BIGINT,((v%86400)//3600)::BIGINT) END AS eta FROM (SELECT event_id, event_id*37 AS v FROM events)""")
def _(spark, d):
    return read(spark, d, "events", "event_id").select("event_id", text.eta(F.col("event_id") * 37).alias("eta"))


@query("TXT26_dedup_hash", "SELECT event_id, substr(sha256(event_type||'|'||props||'|'||strftime(ts,'%Y-%m-%d-%H')),1,16) AS dedup_hash FROM events")
def _(spark, d):
    return read(spark, d, "events", "event_id", "event_type", "props", "ts").select("event_id", text.dedup_hash(F.col("event_type"), F.col("props"), F.col("ts")).alias("dedup_hash"))


_LABEL = "CASE document_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.FILING_TYPES.items()) + " ELSE 'Type-'||document_type END"


@query("TXT29_31_filing_labels", f"SELECT rec_id, {_LABEL} AS label, coalesce(nullif(title,''),{_LABEL}) AS title FROM document_record")
def _(spark, d):
    label = text.filing_label(F.col("document_type"))
    return read(spark, d, "document_record", "rec_id", "document_type", "title").select("rec_id", label.alias("label"), F.coalesce(F.nullif("title", F.lit("")), label).alias("title"))


@query("TXT32_checkpoint_projection", "SELECT rec_id, doc_id, parsed, error, coalesce(len(map_keys(segments)),0)::INT AS segment_count FROM parsed_document")
def _(spark, d):
    x = read(spark, d, "parsed_document", "rec_id", "doc_id", "parsed", "error", "segments")
    return x.select("rec_id", "doc_id", "parsed", "error", F.coalesce(F.size(F.map_keys("segments")), F.lit(0)).cast("int").alias("segment_count"))


@query("SRC20_japanese_era", """SELECT rec_id, CASE WHEN y>=2019 THEN '令和' WHEN y>=1989 THEN '平成' WHEN y>=1926 THEN '昭和' END AS era, CASE WHEN y>=2019 THEN y-2018 WHEN y>=1989 THEN y-1988 WHEN y>=1926 THEN y-1925 ELSE 0 END AS era_year, CASE WHEN y>=1926 THEN m ELSE 0 END AS month, CASE WHEN y>=1926 THEN dd ELSE 0 END AS day
  FROM (SELECT rec_id, CASE WHEN a AND b AND c THEN y END AS y, m, dd FROM (SELECT rec_id, try_cast(split_part(decision_date,'-',1) AS INT) AS y, try_cast(split_part(decision_date,'-',2) AS INT) AS m, try_cast(split_part(decision_date,'-',3) AS INT) AS dd, try_cast(split_part(decision_date,'-',1) AS INT) IS NOT NULL AS a, try_cast(split_part(decision_date,'-',2) AS INT) IS NOT NULL AS b, try_cast(split_part(decision_date,'-',3) AS INT) IS NOT NULL AS c FROM de_case_detail))""")
def _(spark, d):
    return read(spark, d, "de_case_detail", "rec_id", "decision_date").select("rec_id", text.japanese_era(F.col("decision_date")).alias("e")).select("rec_id", "e.*")


@query("SRC17_parse_german_result", "SELECT rec_id, regexp_extract(t,'(BGH|BVerfG|OLG|LG|AG|BAG|BVerwG|BSG|BFH)\\s+[\\w\\-]+') AS court, regexp_extract(t,'\\d{2}\\.\\d{2}\\.\\d{4}') AS decision_date, regexp_extract(t,'(?:Az\\.?:?\\s*)?((?:I+V?|VI+|XI+|XI?I?)\\s+Z[RB]\\s+\\d+/\\d+|\\d+\\s+[A-Z]\\s+\\d+/\\d+)',1) AS aktenzeichen FROM (SELECT rec_id, concat_ws(' ',court,aktenzeichen,full_text) AS t FROM de_case_detail)")
def _(spark, d):
    x = read(spark, d, "de_case_detail", "rec_id", "court", "aktenzeichen", "full_text")
    return x.select("rec_id", pages.german_result(F.concat_ws(" ", "court", "aktenzeichen", "full_text")).alias("r")).select("rec_id", "r.*")


@query("SRC15_list_pages", "SELECT rec_id, regexp_extract(u,'[?&]id=([^&]*)',1) AS id, (rec_id%4)::VARCHAR AS page FROM (SELECT rec_id, url||CASE WHEN contains(url,'?') THEN '&' ELSE '?id=' END||'page='||(rec_id%4)::VARCHAR AS u FROM jp_case_detail WHERE url IS NOT NULL AND contains(url,'?id='))")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "url").where("contains(url, '?id=')").withColumn("u", F.concat("url", F.lit("&page="), (F.col("rec_id") % 4).cast("string")))
    return x.select("rec_id", pages.query_parameter(F.col("u"), "id").alias("id"), pages.query_parameter(F.col("u"), "page").alias("page"))


@query("SRC16_first_full_text", "SELECT rec_id, CASE WHEN length(tenor)>200 THEN tenor WHEN length(tatbestand)>200 THEN tatbestand WHEN length(gruende)>200 THEN gruende WHEN length(tenor)>=100 THEN tenor WHEN length(tatbestand)>=100 THEN tatbestand WHEN length(gruende)>=100 THEN gruende ELSE full_text END AS text FROM de_case_detail")
def _(spark, d):
    x = read(spark, d, "de_case_detail", "rec_id", "tenor", "tatbestand", "gruende", "full_text")
    return x.select("rec_id", pages.first_full_text([F.col("tenor"), F.col("tatbestand"), F.col("gruende")], F.col("full_text")).alias("text"))


_IS_DATE = "(regexp_matches(c,'^(?:令和|平成|昭和)?\\d{1,4}年\\d{1,2}月\\d{1,2}日') OR regexp_matches(c,'^\\d{4}/\\d{1,2}/\\d{1,2}'))"
_IS_COURT = f"(NOT {_IS_DATE} AND regexp_matches(c,'裁判所|最高裁|高裁|地裁|簡裁|家裁'))"


@query("SRC18_classify_cells", f"SELECT rec_id, list_filter(l, lambda c: {_IS_DATE})[-1] AS decision_date, list_filter(l, lambda c: {_IS_COURT})[-1] AS court, list_filter(l, lambda c: NOT {_IS_DATE} AND NOT {_IS_COURT} AND regexp_matches(c,'^(?:令和|平成|昭和)?\\d{{1,4}}[（(].+[）)]\\d+'))[-1] AS case_number FROM (SELECT rec_id, [coalesce(court,''),replace(replace(coalesce(case_number,''),'年',''),'第',''),coalesce(decision_date,'')] AS l FROM jp_case_detail)")
def _(spark, d):
    x = read(spark, d, "jp_case_detail", "rec_id", "court", "case_number", "decision_date").withColumn("case_number", F.translate("case_number", "年第", ""))  # the form of a search page
    return x.select("rec_id", pages.classify_cells(F.array(*[F.coalesce(c, F.lit("")) for c in ("court", "case_number", "decision_date")])).alias("c")).select("rec_id", "c.*")


@query("SRC18_case_id", "SELECT rec_id, coalesce(nullif(regexp_extract(url,'/hanrei/(\\d+)/detail',1),''),nullif(regexp_extract(url,'[?&]id=(\\d+)',1),''),nullif(regexp_extract(url,'detail(\\d+)',1),''),url) AS id FROM jp_case_detail")
def _(spark, d):
    return read(spark, d, "jp_case_detail", "rec_id", "url").select("rec_id", pages.case_id(F.col("url")).alias("id"))


# ---- filters, joins, sets, order ----


@query("FIL1_wanted_filings", "SELECT rec_id, source_id FROM document_record WHERE document_type IN ('120','140') AND coalesce(metadata['withdrawalStatus'],'0') IN ('0','')")
def _(spark, d):
    x = read(spark, d, "document_record", "rec_id", "source_id", "document_type", "metadata")
    return x.where(F.col("document_type").isin("120", "140") & F.coalesce(F.col("metadata")["withdrawalStatus"], F.lit("0")).isin("0", "")).select("rec_id", "source_id")


@query("FIL2_3_JOIN6_resume", "SELECT rec_id, source_id FROM document_record r WHERE NOT EXISTS (SELECT 1 FROM parsed_document p WHERE p.doc_id=r.source_id AND p.parsed)")
def _(spark, d):
    done = read(spark, d, "parsed_document", "doc_id", "parsed").where("parsed").select(F.col("doc_id").alias("source_id"))
    return files.resume(read(spark, d, "document_record", "rec_id", "source_id"), done)


@query("FIL4_JOIN8_rule_applicability", "SELECT segment, count(*) AS n FROM (SELECT segment, CASE WHEN rec_id%3=0 THEN t||'一般的に影響がある。' ELSE t END AS t FROM (SELECT rec_id, unnest(map_keys(segments)) AS segment, unnest(map_values(segments)) AS t FROM parsed_document)) WHERE regexp_matches(t,'一般的に|通常|一般論として|概して') AND segment='business_risks' GROUP BY 1")
def _(spark, d):
    x = read(spark, d, "parsed_document", "rec_id", "segments").select("rec_id", F.explode("segments").alias("segment", "t"))
    x = x.withColumn("t", F.when(F.col("rec_id") % 3 == 0, F.concat("t", F.lit("一般的に影響がある。"))).otherwise(F.col("t")))  # planted
    return x.where((F.col("segment") == "business_risks") & F.col("t").rlike("一般的に|通常|一般論として|概して")).groupBy("segment").agg(F.count("*").alias("n"))


@query("FIL5_6_change_predicates", "SELECT event_id, event_type FROM events WHERE ts>=TIMESTAMP '2024-01-10' AND event_type IN ('error','signup')")
def _(spark, d):
    x = read(spark, d, "events", "event_id", "event_type", "ts").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("urgency", F.col("event_type")).withColumn("seq", F.col("event_id"))
    return changes.select_changes(x, "2024-01-10", ["error ", "signup", ""]).select("event_id", "event_type")


@query("FIL7_keyword_filter", "SELECT doc_id FROM documents WHERE regexp_matches(text,'(?i)visa|residence permit|consent')")
def _(spark, d):
    return read(spark, d, "documents", "doc_id", "text").where(F.col("text").rlike("(?i)visa|residence permit|consent")).select("doc_id")


@query("FIL10_due_config", "SELECT name FROM (SELECT c_name AS name, row_number() OVER (ORDER BY c_name) AS r FROM customer WHERE c_acctbal<0 AND NOT starts_with(c_name,'test-')) WHERE r=1")
def _(spark, d):
    return read(spark, d, "customer", "c_name", "c_acctbal").where("c_acctbal < 0 and not startswith(c_name, 'test-')").select(F.col("c_name").alias("name")).orderBy("name").limit(1)


@query("JOIN4_last_wins_lookup", "WITH w AS (SELECT url, arg_max(court, rec_id) AS court FROM jp_case_detail WHERE url IS NOT NULL GROUP BY url) SELECT h.rec_id, w.court FROM http_response h JOIN w ON h.url=w.url")
def _(spark, d):
    w = read(spark, d, "jp_case_detail", "url", "court", "rec_id").where("url is not null").select("url", F.col("court").alias("product"), F.col("rec_id").alias("seq"))
    return read(spark, d, "http_response", "rec_id", "url").join(changes.watch_table(w), "url").select("rec_id", F.col("product").alias("court"))


@query("JOIN5_13_dimension_lookup", f"SELECT s.rec_id, s.quality_tier, e.expected_pct FROM synth_document s LEFT JOIN {_TIERS_SQL} ON s.quality_tier=e.t")
def _(spark, d):
    dim = F.broadcast(spark.createDataFrame([(t, 100 * p) for t, p, _ in P.TIERS], "quality_tier string, expected_pct double"))
    return read(spark, d, "synth_document", "rec_id", "quality_tier").join(dim, "quality_tier", "left").select("rec_id", "quality_tier", "expected_pct")


@query("JOIN7_positional", "SELECT s.document_id, c.c_name FROM (SELECT document_id, row_number() OVER (ORDER BY rec_id) AS i FROM synth_document) s LEFT JOIN (SELECT c_name, row_number() OVER (ORDER BY c_custkey DESC) AS i FROM customer) c USING (i)")
def _(spark, d):
    x = generation.number_in_order(read(spark, d, "synth_document", "document_id", "rec_id"), F.col("rec_id"), "i")
    seeds = generation.number_in_order(read(spark, d, "customer", "c_custkey", "c_name"), -F.col("c_custkey"), "i")
    return x.join(seeds, "i", "left").select("document_id", "c_name")


@query("JOIN11_parsed_and_listed", "SELECT DISTINCT r.source_id FROM document_record r WHERE r.source_id IN (SELECT doc_id FROM parsed_document WHERE parsed)")
def _(spark, d):
    done = read(spark, d, "parsed_document", "doc_id", "parsed").where("parsed").select(F.col("doc_id").alias("source_id"))
    return read(spark, d, "document_record", "source_id").join(done, "source_id", "left_semi").distinct()


@query("JOIN12_foreign_keys", "SELECT count(*) AS orphans FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey)")
def _(spark, d):
    return read(spark, d, "orders", "o_custkey").join(read(spark, d, "customer", "c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.count("*").alias("orphans"))


@query("SET1_union_of_tiers", "SELECT quality_tier, count(*) AS n FROM synth_document WHERE quality_tier IN ('near','severe') GROUP BY 1")
def _(spark, d):
    x = docs(spark, d)
    return x.where("quality_tier = 'near'").unionByName(x.where("quality_tier = 'severe'").drop("error_rate"), allowMissingColumns=True).groupBy("quality_tier").agg(F.count("*").alias("n"))


@query("SET2_difference", "SELECT o_custkey AS c FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal>0")
def _(spark, d):
    return read(spark, d, "orders", "o_custkey").select(F.col("o_custkey").alias("c")).distinct().join(read(spark, d, "customer", "c_custkey", "c_acctbal").where("c_acctbal > 0").select(F.col("c_custkey").alias("c")), "c", "left_anti")


@query("SET3_intersection", "SELECT source_id FROM document_record INTERSECT SELECT doc_id FROM parsed_document")
def _(spark, d):
    return read(spark, d, "document_record", "source_id").intersect(read(spark, d, "parsed_document", "doc_id"))


@query("SET4_distinct", "SELECT DISTINCT court FROM de_case_detail")
def _(spark, d):
    return read(spark, d, "de_case_detail", "court").distinct()


@query("SRC7_last_record_wins", "SELECT case_id, rec_id FROM (SELECT case_id, rec_id, row_number() OVER (PARTITION BY case_id ORDER BY rec_id DESC) AS r FROM jp_case_detail) WHERE r=1")
def _(spark, d):
    return files.last_record(read(spark, d, "jp_case_detail", "case_id", "rec_id"), "case_id", "rec_id")


@query("SRC12_date_range", "SELECT filing_date, count(*) AS n FROM document_record WHERE filing_date>='2023-01-01' AND filing_date<='2023-12-31' AND regexp_matches(filing_date,'^\\d{4}-\\d{2}-\\d{2}$') GROUP BY 1")
def _(spark, d):
    span = spark.createDataFrame([(x,) for x in rest.days("2023-01-01", "2023-12-31")], "filing_date string")
    return read(spark, d, "document_record", "filing_date").join(span, "filing_date", "left_semi").groupBy("filing_date").agg(F.count("*").alias("n"))


@query("AGG11_SRT2_scout", "SELECT filing_date, count(*) AS n, count(*)*8*90 AS seconds FROM document_record WHERE filing_date IS NOT NULL GROUP BY 1")
def _(spark, d):
    return read(spark, d, "document_record", "filing_date").where("filing_date is not null").groupBy("filing_date").agg(F.count("*").alias("n"), (F.count("*") * 8 * 90).alias("seconds"))


@query("AGG14_watches_per_product", "SELECT coalesce(source,'total') AS product, count(*) AS n FROM de_case_detail GROUP BY ROLLUP (source)")
def _(spark, d):
    return read(spark, d, "de_case_detail", "source").rollup("source").agg(F.count("*").alias("n")).select(F.coalesce("source", F.lit("total")).alias("product"), "n")


@query("AGG18_verification_summary", _FLAW_SQL + ", x AS (SELECT s.rec_id, coalesce(s.quality_tier,'(none)') AS quality_tier, EXISTS (SELECT 1 FROM f WHERE f.document_id=s.rec_id::VARCHAR) AS det FROM synth_document s WHERE s.error_rate>0) SELECT coalesce(quality_tier,'all') AS planted_in, count(*) AS planted, count(*) FILTER (det) AS detected, round(count(*) FILTER (det)/count(*),4) AS survival_rate FROM x GROUP BY ROLLUP (quality_tier)")
def _(spark, d):
    p = per_document(spark, d).join(docs(spark, d).select(F.col("rec_id").cast("string").alias("document_id"), "error_rate"), "document_id").where("error_rate > 0").fillna("(none)", ["quality_tier"])
    det = F.count_if(F.col("flaw_n") > 0)
    return p.rollup("quality_tier").agg(F.count("*").alias("planted"), det.alias("detected"), F.round(det / F.count("*"), 4).alias("survival_rate")).select(F.coalesce("quality_tier", F.lit("all")).alias("planted_in"), "planted", "detected", "survival_rate")


@query("AGG23_run_counters", "SELECT count(*) AS listed, count(*) FILTER (downloaded) AS downloaded, count(*) FILTER (parsed) AS parsed, count(*) FILTER (coalesce(error,'')<>'') AS errors FROM document_record")
def _(spark, d):
    return rest.counters(read(spark, d, "document_record", "downloaded", "parsed", "error"))


@query("AGG25_call_estimate", "SELECT sum(p_size*CASE WHEN p_brand LIKE '%1' THEN floor((5+8)/2) ELSE 1 END)::BIGINT AS calls, (sum(p_size*CASE WHEN p_brand LIKE '%1' THEN floor((5+8)/2) ELSE 1 END)*75)::BIGINT AS seconds FROM part")
def _(spark, d):
    calls = F.sum(F.col("p_size") * F.when(F.col("p_brand").like("%1"), (5 + 8) // 2).otherwise(1)).cast("bigint")
    return read(spark, d, "part", "p_size", "p_brand").agg(calls.alias("calls"), (calls * 75).alias("seconds"))


@query("AGG26_datasheet_totals", "SELECT (SELECT count(*) FROM customer)+(SELECT count(*) FROM orders)+(SELECT count(*) FROM part) AS total_rows, 3 AS n_tables")
def _(spark, d):
    n = [read(spark, d, t).select(F.lit(t).alias("t")) for t in ("customer", "orders", "part")]
    return n[0].union(n[1]).union(n[2]).agg(F.count("*").alias("total_rows"), F.countDistinct("t").cast("int").alias("n_tables"))


@query("LIM1_preview", "SELECT rec_id, document_id FROM synth_document ORDER BY rec_id LIMIT 100")
def _(spark, d):
    return read(spark, d, "synth_document", "rec_id", "document_id").orderBy("rec_id").limit(100)


@query("LIM2_digest_cap", "SELECT event_id FROM events ORDER BY event_id DESC LIMIT 20")
def _(spark, d):
    return read(spark, d, "events", "event_id").orderBy(F.desc("event_id")).limit(20)


@query("WIN5_first_examples", "SELECT court, rec_id FROM (SELECT court, rec_id, row_number() OVER (PARTITION BY court ORDER BY rec_id) AS r FROM jp_case_detail) WHERE r<=3")
def _(spark, d):
    w = Window.partitionBy("court").orderBy("rec_id")
    return read(spark, d, "jp_case_detail", "court", "rec_id").withColumn("r", F.row_number().over(w)).where("r <= 3").drop("r")


# ---- generation, sampling, injection ----


@query("GEN2_categorical", f"SELECT c_custkey, CASE WHEN {_u(7, 'c_custkey::VARCHAR')}<0.45 THEN 'GmbH' WHEN {_u(7, 'c_custkey::VARCHAR')}<0.7 THEN 'AG' WHEN {_u(7, 'c_custkey::VARCHAR')}<0.85 THEN 'KG' ELSE 'UG' END AS form FROM customer")
def _(spark, d):
    return read(spark, d, "customer", "c_custkey").select("c_custkey", generation.categorical(["GmbH", "AG", "KG", "UG"], [0.45, 0.25, 0.15, 0.15], text.uniform(7, F.col("c_custkey")), F.col("c_custkey")).alias("form"))


@query("GEN5_6_9_numeric", f"SELECT c_custkey, greatest(least(round_even(10+90*{_u(8, 'c_custkey::VARCHAR')},1),95),0)::DOUBLE AS uniform_value, round(-ln(greatest(1-{_u(8, 'c_custkey::VARCHAR')},1e-12))/2,6) AS exponential_value FROM customer")
def _(spark, d):
    u = text.uniform(8, F.col("c_custkey"))
    v = F.greatest(F.least(generation.numeric("uniform", u, u, low=10, high=100, decimals=1), F.lit(95.0)), F.lit(0.0))
    return read(spark, d, "customer", "c_custkey").select("c_custkey", v.alias("uniform_value"), F.round(generation.numeric("exponential", u, u, rate=2.0), 6).alias("exponential_value"))


@query("GEN3_4_7_8_distributions")
def _(spark, d):
    k = F.col("c_custkey")
    u, v = text.uniform(9, k), text.uniform(10, k)
    return read(spark, d, "customer", "c_custkey").select("c_custkey", *[generation.numeric(n, u, v, mean=m, std=1.0, decimals=4).alias(n) for n, m in (("normal", 0.0), ("lognormal", 1.0), ("poisson", 5.0), ("beta", 0.0))])


@query("GEN10_ids", "SELECT c_custkey, format('DOC-{:06d}',c_custkey+1) AS sequential, 'X-'||upper(substr(md5('X-'||c_custkey::VARCHAR),1,8)) AS hexadecimal FROM customer")
def _(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer", "c_custkey").select("c_custkey", generation.ids("DOC-", k).alias("sequential"), generation.ids("X-", k, False).alias("hexadecimal"))


@query("GEN11_datetimes", f"SELECT c_custkey, strftime(make_timestamp(((1577836800+floor((1773187200-1577836800)*c_custkey/9999)+floor({_u(11, 'c_custkey::VARCHAR')}*86400))*1000000)::BIGINT),'%Y-%m-%d %H:%M:%S') AS at FROM customer")
def _(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer", "c_custkey").select("c_custkey", generation.datetimes(k, 10_000, text.uniform(11, k)).alias("at"))


@query("GEN14_TXT21_templates", "SELECT c_custkey, c_name||' <'||c_mktsegment||'>' AS label FROM customer")
def _(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey", text.fill_template("{c_name} <{c_mktsegment}>", c.columns).alias("label"))


@query("TXT21_raw_template", "SELECT c_custkey, '{c_name} <{segment}>' AS label FROM customer")
def _(spark, d):
    c = read(spark, d, "customer", "c_custkey", "c_name")
    return c.select("c_custkey", text.fill_template("{c_name} <{segment}>", c.columns, raw_if_unknown=True).alias("label"))


@query("GEN1_12_table")
def _(spark, d):
    cols = [
        {"name": "nr", "type": "id", "prefix": "TEST-"}, {"name": "form", "type": "categorical", "values": P.LEGAL_FORMS}, {"name": "umsatz", "type": "numeric", "distribution": "lognormal", "mean": 13.0, "std": 1.5, "low": 10_000, "high": 50_000_000, "decimals": 0},
        {"name": "seit", "type": "datetime"}, {"name": "aktiv", "type": "boolean", "null_ratio": 0.1}, {"name": "text", "type": "text"}, {"name": "satz", "type": "text", "generator": "template", "template": "{nr}: {form}"},
    ]
    return generation.table_from(spark, 50_000, cols)


@query("GEN13_gaussian_copula")
def _(spark, d):
    return generation.gaussian_copula(read(spark, d, "lineitem", "l_quantity", "l_extendedprice", "l_discount"), ["l_quantity", "l_extendedprice", "l_discount"], 50_000)


@query("GEN15_augment")
def _(spark, d):
    x = read(spark, d, "customer", "c_custkey", "c_name")
    return generation.augment(x, "blurb", F.concat(F.lit("Describe "), "c_name"))


@query("GEN16_20_WIN3_documents")
def _(spark, d):
    seeds = read(spark, d, "customer", "c_custkey", "c_name").select((F.col("c_custkey") - 1).alias("id"), "c_name")
    return generation.prior_context(generation.documents(spark, 500, [{"name": "overview"}, {"name": "risks", "kind": "list", "min": 2, "max": 4}, {"name": "outlook"}], seeds))


@query("GEN21_22_SET1_mixed_dataset")
def _(spark, d):
    base = docs(spark, d).select((F.col("rec_id") - 1).alias("n"), F.col("document_content").alias("text"))
    return generation.mixed_dataset({t: base for t, *_ in P.TIERS}, 400)


@query("SMP1_split", f"SELECT document_id, rec_id, CASE WHEN r<=greatest(1,round_even(n*0.2,0)) THEN 'test' ELSE 'train' END AS split FROM (SELECT document_id, rec_id, row_number() OVER (ORDER BY {_u(42, 'rec_id::VARCHAR')}, rec_id) AS r, count(*) OVER () AS n FROM synth_document)")
def _(spark, d):
    return sampling.train_test_split(read(spark, d, "synth_document", "document_id", "rec_id"), key="rec_id")


@query("SMP1_stratified_split", f"SELECT rec_id, quality_tier, CASE WHEN r<=greatest(1,round_even(n*0.2,0)) THEN 'test' ELSE 'train' END AS split FROM (SELECT rec_id, quality_tier, row_number() OVER (PARTITION BY quality_tier ORDER BY {_u(42, 'rec_id::VARCHAR')}, rec_id) AS r, count(*) OVER (PARTITION BY quality_tier) AS n FROM synth_document)")
def _(spark, d):
    return sampling.train_test_split(read(spark, d, "synth_document", "rec_id", "quality_tier"), key="rec_id", by="quality_tier")


@query("SMP2_shuffle_numbers", f"SELECT rec_id, row_number() OVER (ORDER BY ('0x'||substr(md5('42:'||rec_id::VARCHAR),1,8))::BIGINT, rec_id) AS position FROM synth_document")
def _(spark, d):
    x = read(spark, d, "synth_document", "rec_id")
    # The top bits of the order choose the bucket: 32 bits of the hash, moved up.
    return generation.number(x, F.shiftleft(F.conv(F.substring(F.md5(F.concat(F.lit("42:"), F.col("rec_id").cast("string"))), 1, 8), 16, 10).cast("bigint"), 31), "position")


@query("SMP3_sample_from_pool", f"SELECT c_custkey, ['a','b','c','d','e'][(floor({_u(5, 'c_custkey::VARCHAR')}*5)+1)::INT] AS pick FROM customer")
def _(spark, d):
    return read(spark, d, "customer", "c_custkey").select("c_custkey", generation.pick(list("abcde"), text.uniform(5, F.col("c_custkey"))).alias("pick"))


@query("INJ1_affected_documents", f"SELECT rec_id, {_u(42, 'rec_id::VARCHAR')}<0.3 AS affected FROM synth_document")
def _(spark, d):
    return generation.affected(read(spark, d, "synth_document", "rec_id"), 0.3, key="rec_id")


@query("INJ2_7_weighted_flaw", f"SELECT rec_id, CASE WHEN u<0.2/0.66 THEN 'empty_section' WHEN u<0.2/0.66+0.1/0.66 THEN 'generic_language' WHEN u<0.2/0.66+0.1/0.66+0.3/0.66 THEN 'mojibake' ELSE 'reference_date' END AS flaw FROM (SELECT rec_id, {_u(3, 'rec_id::VARCHAR')} AS u FROM synth_document)")
def _(spark, d):
    w = [("empty_section", 0.2), ("generic_language", 0.1), ("mojibake", 0.3), ("reference_date", 0.06)]
    return read(spark, d, "synth_document", "rec_id").select("rec_id", generation.weighted_flaw(text.uniform(3, F.col("rec_id")), w).alias("flaw"))


@query("INJ3_4_mutations")
def _(spark, d):
    kinds = ["empty_section", "suspiciously_short", "missing_section", "potential_duplicate_figure", "generic_language", "boilerplate_risk", "garbled_symbols", "mojibake", "control_characters", "reference_date", "unknown"]
    x = docs(spark, d).where("document_content is not null")
    sub = generation.pick(kinds, text.uniform(21, F.col("rec_id")))
    return x.select("rec_id", sub.alias("subtype"), generation.mutate(F.col("document_content"), sub, "ja", 22, F.col("rec_id")).alias("mutated"))


@query("INJ5_6_inject_anomalies")
def _(spark, d):
    return generation.inject_anomalies(docs(spark, d).withColumn("document_id", F.col("rec_id").cast("string")), "garbled_characters", 0.1).select("document_id", "injected_flaw", *_SEGS)


# ---- streaming twins, sinks' rows, retrieval ----


def change_events(spark, d):
    e = read(spark, d, "events", "event_id", "ts", "event_type", "user_id", "props")
    return e.select(F.col("event_id").alias("seq"), F.col("event_type").alias("url"), F.col("user_id").cast("string").alias("diff"), F.col("ts").cast("timestamp").alias("ts"), F.col("props"))


def watches(spark):
    return spark.createDataFrame([("click", "housing", 1), ("error", "news", 2), ("signup", "filings", 3), ("click", "news", 4)], "url string, product string, seq long")


#: An example of a routing config: product, urgency, channels.
ROUTES = [("news", "P0", ["email", "pager"]), ("news", "P1", ["email"]), ("news", "P2", ["weekly_digest"]), ("filings", "P0", ["pager"]), ("filings", "P3", ["log_only", "archive"])]
_WATCH = "(VALUES ('click','news'),('error','news'),('signup','filings')) AS w(url, product)"


@query("STR1_admission", f"SELECT e.event_id AS seq, w.product FROM events e JOIN {_WATCH} ON e.event_type=w.url")
def _(spark, d):
    return changes.admit(change_events(spark, d), watches(spark)).select("seq", "product")


@query("STR2_hourly_dedup", "SELECT DISTINCT substr(sha256(event_type||'|'||user_id::VARCHAR||'|'||strftime(ts,'%Y-%m-%d-%H')),1,16) AS dedup_hash FROM events")
def _(spark, d):
    return changes.deduplicate(change_events(spark, d)).select("dedup_hash")


_ROUTE_SQL = "(VALUES " + ",".join(f"('{p}','{u}',[{','.join(repr(c) for c in cs)}])" for p, u, cs in ROUTES) + ") AS r(product, urgency, channels)"


@query("STR3_5_route_channels", f"""SELECT seq, product, urgency, unnest(coalesce(channels,['log_only'])) AS channel FROM (SELECT e.event_id AS seq, w.product, CASE e.user_id%5 WHEN 0 THEN 'P0' WHEN 1 THEN 'P1' WHEN 2 THEN 'P2' WHEN 3 THEN 'P3' ELSE 'PX' END AS urgency FROM events e JOIN {_WATCH} ON e.event_type=w.url) LEFT JOIN {_ROUTE_SQL} USING (product, urgency)""")
def _(spark, d):
    x = changes.admit(change_events(spark, d), watches(spark))
    k = F.col("diff").cast("bigint") % 5
    x = x.withColumn("urgency", F.when(k == 0, "P0").when(k == 1, "P1").when(k == 2, "P2").when(k == 3, "P3").otherwise("PX")).withColumn("parse_error", F.lit(False))
    return changes.route(x, ROUTES).select("seq", "product", "urgency", "channel")


@query("TXT22_triage", """SELECT event_id, CASE WHEN event_id%3=2 THEN 'UNCLEAR' ELSE 'RELEVANT' END AS relevance, CASE WHEN event_id%3=2 THEN 'P2' ELSE 'P1' END AS urgency, event_id%3=2 AS parse_error FROM events""")
def _(spark, d):
    good = '{"relevance": "RELEVANT", "urgency": "P1"}'
    r = F.when(F.col("event_id") % 3 == 0, "```json\n" + good + "\n```").when(F.col("event_id") % 3 == 1, "Here it is: " + good + " as asked.").otherwise("no answer")
    return read(spark, d, "events", "event_id").select("event_id", text.triage(r).alias("t")).select("event_id", "t.result.relevance", "t.result.urgency", "t.parse_error")


@query("TXT27_SNK13_notifications")
def _(spark, d):
    return changes.notifications(changes.route(changes.classify(changes.admit(change_events(spark, d), watches(spark))), ROUTES))


@query("STR6_AGG13_digest", f"""WITH x AS (SELECT w.product, CASE e.user_id%4 WHEN 0 THEN 'P0' WHEN 1 THEN 'P1' WHEN 2 THEN 'P2' ELSE 'P3' END AS u, e.ts FROM events e JOIN {_WATCH} ON e.event_type=w.url), m AS (SELECT max(ts) AS t FROM events)
  SELECT product, count(*) AS n_changes, count(*) FILTER (u='P0') AS P0, count(*) FILTER (u='P1') AS P1, count(*) FILTER (u='P2') AS P2, count(*) FILTER (u='P3') AS P3 FROM x, m WHERE ts>=t-INTERVAL 7 DAY GROUP BY product""")
def _(spark, d):
    e = change_events(spark, d)
    k = F.col("diff").cast("bigint") % 4
    x = changes.admit(e, watches(spark)).withColumn("urgency", F.when(k == 0, "P0").when(k == 1, "P1").when(k == 2, "P2").otherwise("P3"))
    return changes.digest(x, str(e.agg(F.max("ts")).first()[0])).drop("summary")


@query("STR6_weekly_counts", f"SELECT time_bucket(INTERVAL 7 DAY, e.ts, TIMESTAMP '1970-01-01') AS week, w.product, 'P3' AS urgency, count(*) AS n FROM events e JOIN {_WATCH} ON e.event_type=w.url GROUP BY 1,2")
def _(spark, d):
    x = changes.classify(changes.admit(change_events(spark, d), watches(spark)))
    return changes.weekly_counts(x).select(F.col("window.start").cast("timestamp_ntz").alias("week"), "product", "urgency", "n")


@query("SRT1_newest_first", "SELECT event_id AS seq, event_type AS url FROM events ORDER BY event_id DESC LIMIT 50")
def _(spark, d):
    return changes.select_changes(change_events(spark, d), limit=50).select("seq", "url")


@query("SNK11_court_lines", "SELECT rec_id, category, substr(full_text,1,10000) AS full_text, substr(tenor,1,2000) AS tenor, substr(leitsatz,1,1000) AS leitsatz FROM de_case_detail")
def _(spark, d):
    from quellwerk.sinks.package import court_lines

    return court_lines(read(spark, d, "de_case_detail", "rec_id", "category", "full_text", "tenor", "leitsatz"))


@query("SNK10_taxonomy_json")
def _(spark, d):
    from quellwerk.sinks.package import taxonomy_json

    p = read(spark, d, "parsed_document", "rec_id", "segments").select(F.col("rec_id").cast("string").alias("source_id"), "segments")
    n = p.count()
    return taxonomy_json(flaws.taxonomy(flaws.filing_flaws(p), n), "filings", n)


@query("RAG1_articles", """SELECT doc_id, part::INT AS part, body FROM (SELECT doc_id, unnest([0,1,2]) AS part, unnest(['Article '||doc_id::VARCHAR||': Scope'||chr(10)||source||chr(10),'Recital 7: '||lang||chr(10),'Article 12: End']) AS body FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL
  UNION ALL SELECT doc_id, 0, 'No header' FROM documents WHERE source IS NULL OR lang IS NULL)""")
def _(spark, d):
    x = read(spark, d, "documents", "doc_id", "source", "lang")
    law = F.concat(F.lit("Article "), F.col("doc_id").cast("string"), F.lit(": Scope\n"), "source", F.lit("\nRecital 7: "), "lang", F.lit("\nArticle 12: End"))  # null where a field is
    return x.select("doc_id", F.posexplode(retrieval.articles(F.coalesce(law, F.lit("No header")))).alias("part", "body"))


@query("RAG3_embed")
def _(spark, d):
    x = retrieval.embed(read(spark, d, "documents", "doc_id", "text"), "doc_id", "text")
    return x.select("doc_id", F.size("embedding").alias("n"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v), 4).alias("length"))


@query("RAG2_WIN4_chunks", """SELECT doc_id, i AS chunk_index, i*450 AS start, len(list_slice(w,i*450+1,i*450+500))::BIGINT AS n_words FROM (SELECT doc_id, w, unnest(range(0, greatest(0,ceil((len(w)-500)/450.0))::BIGINT+1)) AS i FROM (SELECT doc_id, list_filter(regexp_split_to_array(trim(text),'\\s+'), lambda x: x<>'') AS w FROM documents) WHERE len(w)>0)""")
def _(spark, d):
    return retrieval.windows(read(spark, d, "documents", "doc_id", "text"), "doc_id", "text").drop("chunk")


@query("RAG4_LIM4_top5_search", """WITH q AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS qe FROM embeddings WHERE vec_id%50=0), s AS (SELECT qid AS query_id, vec_id AS neighbour_id, round(list_cosine_similarity(qe, embedding::DOUBLE[]),6) AS similarity FROM q, embeddings WHERE vec_id<>qid)
  SELECT query_id, rank, similarity FROM (SELECT query_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbour_id) AS rank FROM s) WHERE rank<=5""")
def _(spark, d):
    v = read(spark, d, "embeddings", "vec_id", "embedding")
    return retrieval.search(v, v.where("vec_id % 50 = 0")).select("query_id", "rank", "similarity")


@query("AGG27_precision_at_5")
def _(spark, d):
    v = read(spark, d, "embeddings", "vec_id", "embedding", "label")
    return retrieval.precision_at_k(retrieval.search(v, v.where("vec_id % 50 = 0")), v)


@query("RAG5_metadata_filter", "SELECT doc_id FROM documents WHERE lower(lang)='de' AND source='court_de'")
def _(spark, d):
    return read(spark, d, "documents", "doc_id", "lang", "source").where((F.lower("lang") == "de") & (F.col("source") == "court_de")).select("doc_id")
