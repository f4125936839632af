"""Operators on small fixtures: defined results for nulls, empty tables, ties and errors."""

import io
import json
import math
import zipfile

import pytest
from pyspark.sql import functions as F

from quellwerk.functions import pages, text
from quellwerk.functions import patterns as P
from quellwerk.operators import distributions, flaws, generation, retrieval, sampling, segments, validation
from quellwerk.sinks import package
from quellwerk.sources import files, rest
from quellwerk.streaming import changes


def one(spark, sql):
    return spark.sql(f"select {sql} as v").first().v


def col(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("v")).first().v


def test_melt_without_segments_is_empty(spark):
    df = spark.createDataFrame([("a", 1)], "document_id string, n int")
    assert segments.melt(df).columns == ["document_id", "segment", "text"]
    assert segments.melt(df).count() == 0


def test_melt_keeps_nulls_and_extra_columns(spark):
    df = spark.createDataFrame([("a", None, "", 1)], "document_id string, seg_x string, seg_y string, segment int")
    assert sorted(map(tuple, segments.melt(df).collect()), key=str) == [("a", "x", None), ("a", "y", "")]


def test_unknown_segment_is_an_error(spark):
    df = spark.createDataFrame([("a", "t")], "document_id string, seg_x string")
    with pytest.raises(ValueError, match="seg_x"):
        segments.extract_segment(df, "nope")


def test_flaw_fixture(spark):
    long = spark.createDataFrame([("E", "overview", ""), ("E", "risks", None), ("E", "md", "Short"), ("S", "overview", "[GENERATION_FAILED: timeout after 60s]"), ("C", "overview", "An ordinary text about the year that says something different each time.")], "document_id string, segment string, text string")
    got = {(r.document_id, r.flaw_subtype) for r in flaws.segment_flaws(long).collect()}
    assert got == {("E", "empty_section"), ("E", "stub_section"), ("S", "generation_failed")}
    assert flaws.segment_flaws(long.where("document_id = 'C'")).count() == 0


def test_repetition_evidence_is_sorted(spark):
    t = "b c d " * 4
    r = flaws.segment_flaws(spark.createDataFrame([("1", "s", t.strip())], "document_id string, segment string, text string")).collect()
    assert [x.flaw_subtype for x in r] == ["repetition"]
    assert r[0].evidence == "b c d; c d b; d b c"


@pytest.mark.parametrize(
    "segment,body,subtype",
    [("facilities", "設備の状況\n該当事項はありません。", "empty_section"), ("business_risks", "一般的に、" + "あ" * 120, "generic_language"), ("business_risks", "為替変動リスクにより影響を受けます。" + "い" * 100, "boilerplate_risk"), ("overview", "当社は□□□□に設立されました。", "garbled_symbols"), ("overview", "リスクあり", "suspiciously_short")],
)
def test_filing_rules(spark, segment, body, subtype):
    df = spark.createDataFrame([("d", {segment: body})], "source_id string, segments map<string,string>")
    assert subtype in {r.flaw_subtype for r in flaws.filing_flaws(df).collect()}


def test_missing_sections_and_taxonomy(spark):
    t = "一般的に、" + "あ" * 120
    df = spark.createDataFrame([(str(k), {"business_risks": t}) for k in range(3)], "source_id string, segments map<string,string>")
    found = flaws.filing_flaws(df)
    assert found.where("flaw_subtype = 'missing_section' and source_id = '0'").count() == 4
    row = flaws.taxonomy(found, 3).where("flaw_subtype = 'generic_language'").first()
    assert (row["count"], row.frequency, len(row.examples)) == (3, 1.0, 3)


def test_mentions_overlap(spark):
    df = spark.createDataFrame([(1, "Formfehler und Formfehler"), (2, None), (3, "")], "rec_id long, full_text string")
    r = flaws.mentions(df, P.DE_FLAWS, 80, True).collect()
    assert [(x.rec_id, x.type, x.position) for x in r] == [(1, "formal_error", 0), (1, "formal_error", 15)]
    assert r[0].context == r[1].context == "Formfehler und Formfehler"


def test_html(spark):
    html = "<p>A&amp;lt;</p><script>x</script><td>1</td><td>2</td><br/>B&nbsp;C"
    assert col(spark, text.html_to_text, html) == "A<\n 1 2 \nB C".replace("\n 1", "\n1")


def test_report_section_ends_at_next_heading(spark):
    body = "第2 事業等のリスク\n" + "危険" * 40 + "\n第3 設備の状況\n" + "機械" * 40
    got = col(spark, lambda c: text.report_sections(c), body)
    assert got["business_risks"] == "危険" * 40
    assert got["facilities"] == "機械" * 40


@pytest.mark.parametrize("day,era", [("2019-01-05", ("令和", 1)), ("1989-01-01", ("平成", 1)), ("1926-12-25", ("昭和", 1)), ("1900-01-01", (None, 0)), ("x", (None, 0)), (None, (None, 0))])
def test_era(spark, day, era):
    e = col(spark, text.japanese_era, day)
    assert (e.era, e.era_year) == era


@pytest.mark.parametrize("answer,urgency,failed", [('```json\n{"urgency": "P0"}\n```', "P0", False), ('so: {"urgency": "P1"} ok', "P1", False), ("[1]", "P2", True), ("", "P2", True), ("no", "P2", True)])
def test_triage(spark, answer, urgency, failed):
    t = col(spark, text.triage, answer)
    assert (t.result.urgency, t.parse_error) == (urgency, failed)


def test_template_with_unknown_column_fails_at_once():
    with pytest.raises(KeyError, match="nope"):
        text.fill_template("{nope}", ["a"])


def test_definition_list_last_wins(spark):
    html = "<dl><dt>a</dt><dd>1</dd><dt>b</dt><dd>2</dd><dt>a</dt><dd>3</dd></dl>"
    assert col(spark, pages.definition_list, html) == {"b": "2", "a": "3"}


def test_search_rows(spark):
    html = "<table><tr><td><a href='/hanrei/77/detail2/index.html'>建物明渡請求</a></td><td>令和2年1月5日</td><td>東京地方裁判所</td><td>令和1(ワ)12</td></tr><tr><td>x</td></tr></table>"
    r = pages.search_rows(spark.createDataFrame([(html,)], "html string"), "https://h.example").collect()
    assert [tuple(x) for x in r] == [("77", "https://h.example/hanrei/77/detail2/index.html", "建物明渡請求", "令和2年1月5日", "東京地方裁判所", "令和1(ワ)12")]


def test_ks_against_brute_force(spark):
    a, b = [1, 2, 2, 3, 9, 9], [2, 3, 3, 4, 5, 5, 5]
    rows = [("g", "a", v) for v in a] + [("g", "b", v) for v in b] + [("h", "a", 1)]
    got = {r.g: r for r in distributions.ks_two_sample(spark.createDataFrame(rows, "g string, s string, v int"), "g", "s", "v").collect()}
    d = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in a + b)
    assert got["g"].ks_statistic == round(d, 4)
    assert got["h"].verdict == "insufficient_data"


def test_f_tail():
    # With 1 and n degrees of freedom the tail is that of Student's t, at n = 1 the Cauchy distribution.
    assert distributions.f_upper_tail(1.0, 1, 1) == pytest.approx(0.5)
    assert distributions.f_upper_tail(3.0, 1, 1) == pytest.approx(1 - 2 / math.pi * math.atan(math.sqrt(3)))
    assert distributions.f_upper_tail(0.0, 2, 5) == 1.0


def test_document_checks(spark):
    df = spark.createDataFrame([("a", "text", "x"), ("b", "", None)], "document_id string, document_content string, seg_x string")
    got = {r.check: (r.passed, r.message) for r in validation.document_checks(df, expected_rows=2, lengths={"x": (1, 5)}, keywords={"x": ["x"]}, expected_segments=["seg_x", "seg_y"]).collect()}
    assert got["document_row_count"] == (True, "2")
    assert got["no_empty_documents"] == (False, "1")
    assert got["structural_completeness"] == (False, "3")
    assert got["segment_length_x"] == (True, "0")
    assert got["keyword_x"] == (False, "1")


def test_checks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "plz string, rechtsform string")
    got = {r.check: r.passed for r in validation.table_checks(df, ["plz", "name"], 0).collect()}
    assert got == {"no_empty_dataframe": False, "column_completeness": False, "no_all_null_columns": False, "row_count": True, "german_plz_valid": True, "rechtsform_consistent": True}


def test_registered_check_that_raises_fails(spark):
    validation.register_check("boom", lambda df: 1 / 0)
    try:
        got = {r.check: r.passed for r in validation.table_checks(spark.range(3).toDF("a"), ["a"], 3).collect()}
    finally:
        validation.REGISTRY.clear()
    assert got["boom"] is False
    assert got["row_count"] is True


def test_quality_score_without_checks(spark):
    r = validation.quality_score(spark.createDataFrame([], "check string, passed boolean, message string")).first()
    assert (r.score, r.passed) == (1.0, True)


def test_profile(spark):
    df = spark.createDataFrame([("x", 1, True), ("x", None, False), ("yy", 3, None), (None, 5, True)], "s string, n int, `od d` boolean")
    p = {r.column: r for r in validation.profile(df).collect()}
    assert (p["s"].null_count, p["s"].unique_count, p["s"].top_values, p["s"].avg_length) == (1, 2, "x=2; yy=1", 1.3)
    assert (p["n"].mean, p["n"].median, p["n"].min, p["n"].max) == (3.0, 3.0, 1.0, 5.0)
    assert p["od d"].unique_count == 2


@pytest.mark.parametrize("n,rate,k", [(10, 0.25, 2), (10, 0.01, 1), (1, 0.5, 1), (100, 0.3, 30)])
def test_sample_is_exact(spark, n, rate, k):
    df = spark.range(n).select(F.col("id").cast("string").alias("document_id"))
    got = sampling.exact_sample(df, rate)
    assert (got.count(), got.where("in_sample").count()) == (n, k)


def test_sample_of_nothing(spark):
    assert sampling.exact_sample(spark.createDataFrame([], "document_id string"), 0.5).count() == 0


def test_injection(spark):
    df = spark.range(40).select(F.format_string("D%02d", "id").alias("document_id"), F.lit("one two three four five six seven").alias("seg_a"), F.lit("some other text of length").alias("seg_b"))
    for kind in generation.INJECTIONS:
        out = generation.inject_anomalies(df, kind, 0.1)
        assert out.where("injected_flaw is not null").count() == 4
        assert out.columns == [*df.columns, "injected_flaw"]
        changed = out.join(df.withColumnRenamed("seg_a", "a").withColumnRenamed("seg_b", "b"), "document_id").where("(seg_a != a) or (seg_b != b)")
        assert changed.count() == 4
    with pytest.raises(ValueError):
        generation.inject_anomalies(df, "nope", 0.1)
    with pytest.raises(ValueError):
        generation.inject_anomalies(df, "empty_section", 0.1, ["zzz"])


def test_generated_table(spark):
    cols = [{"name": "id2", "type": "id", "prefix": "T-"}, {"name": "c", "type": "categorical", "values": ["a", "b"], "weights": [3, 1]}, {"name": "x", "type": "numeric", "distribution": "normal", "mean": 5, "std": 2, "low": 0, "high": 10, "decimals": 1}, {"name": "t", "type": "text", "generator": "template", "template": "{id2}/{c}"}]
    rows = generation.table_from(spark, 2000, cols).collect()
    assert rows[0].id2 == "T-000001"
    assert 0.7 < sum(r.c == "a" for r in rows) / 2000 < 0.8
    assert 4.8 < sum(r.x for r in rows) / 2000 < 5.2
    assert all(r.t == f"{r.id2}/{r.c}" and 0 <= r.x <= 10 for r in rows)
    assert rows == generation.table_from(spark, 2000, cols).repartition(7).orderBy("id").collect()


def test_numbers_are_consecutive(spark):
    df = spark.range(1000).withColumn("k", F.lit(1))
    got = [r.n for r in generation.number(df, F.xxhash64("id"), "n").orderBy("n").collect()]
    assert got == list(range(1, 1001))


def test_mixed_dataset(spark):
    base = spark.range(500).select(F.col("id").alias("n"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    out = generation.mixed_dataset({t: base for t, *_ in P.TIERS}, 100)
    assert {r.quality_tier: r["count"] for r in out.groupBy("quality_tier").count().collect()} == {"perfect": 80, "near": 10, "moderate": 8, "severe": 2}
    assert out.agg(F.min("document_id"), F.max("document_id")).first()[:] == ("DOC-000001", "DOC-000100")


def test_prior_context(spark):
    docs = generation.documents(spark, 2, [{"name": "a"}, {"name": "b", "kind": "list", "min": 2, "max": 2}, {"name": "c"}])
    r = {x.segment: x for x in generation.prior_context(docs).where("document_id = 'DOC-000001'").collect()}
    assert r["a"].context == ""
    assert r["c"].context == r["a"].text + "\n\n" + r["b"].text
    assert r["b"].text.count("\n\n") == 1


def test_copula_keeps_correlation(spark):
    df = spark.range(2000).select(F.randn(1).alias("a")).withColumn("b", F.col("a") * 2 + F.randn(2) * 0.1)
    out = generation.gaussian_copula(df, ["a", "b"], 1000)
    assert out.agg(F.corr("a", "b")).first()[0] > 0.95


def test_chunks_stop_at_the_end(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(950)))), (2, "a b"), (3, "  "), (4, None)], "doc_id long, text string")
    got = [(r.doc_id, r.chunk_index, r.start, r.n_words) for r in retrieval.windows(df, "doc_id", "text").orderBy("doc_id", "chunk_index").collect()]
    assert got == [(1, 0, 0, 500), (1, 1, 450, 500), (2, 0, 0, 2)]


def test_search_against_brute_force(spark):
    v = spark.createDataFrame([(k, [float((k * 7) % 11 - 5), float((k * 3) % 7 - 3), 1.0]) for k in range(60)] + [(99, None)], "vec_id long, embedding array<float>")
    got = retrieval.search(v.repartition(5), v.where("vec_id < 3"), 5).collect()
    assert len(got) == 15
    rows = {r.vec_id: r.embedding for r in v.where("embedding is not null").collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    for q in range(3):
        want = sorted((-round(cos(rows[q], e), 6), k) for k, e in rows.items() if k != q)[:5]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.similarity for r in own] == pytest.approx([-s for s, _ in want], abs=2e-6)


def test_jsonl_drops_broken_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n\nnot json\n{"b": "x"}\n', encoding="utf-8")
    assert sorted((r.a, r.b) for r in files.load_jsonl(spark, str(p)).collect() if r.a) == [(1, None)]
    assert files.load_jsonl(spark, str(p)).count() == 2
    (tmp_path / "e.jsonl").write_text("zzz\n", encoding="utf-8")
    with pytest.raises(ValueError):
        files.load_jsonl(spark, str(tmp_path / "e.jsonl"))


def test_resume(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"source_id": "a"}\n{bad\n{"source_id": "a"}\n', encoding="utf-8")
    done = files.checkpoint_ids(spark, str(tmp_path / "c.jsonl"))
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    assert sorted(r.source_id for r in files.resume(todo, done).collect()) == ["b", "c"]


def test_archives(spark):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("XBRL/PublicDoc/b.htm", "<p>日本</p>".encode("shift_jis"))
        z.writestr("XBRL/PublicDoc/a.htm", "<p>x</p>")
        z.writestr("other/c.htm", "<p>no</p>")
    df = spark.createDataFrame([("good", bytearray(b.getvalue())), ("json", bytearray(b'{"status": 404}')), ("bad", bytearray(b"zzz")), ("null", None)], "source_id string, content binary")
    out = files.unzip(df)
    assert {r.source_id: r.error is None for r in out.collect()} == {"good": True, "json": False, "bad": False, "null": False}
    doc = files.main_documents(files.decode_japanese(out.where("error is null"))).first()
    assert doc.n_files == 2
    assert doc.full_text == "==== XBRL/PublicDoc/a.htm ====\n<p>x</p>\n\n==== XBRL/PublicDoc/b.htm ====\n<p>日本</p>"


def test_rest_source_pages_and_errors(spark):
    def fetch(url, params):
        if params.get("date") == "2024-01-02":
            raise OSError("down")
        if url.endswith("?2"):
            return {"results": [{"docID": "C", "docTypeCode": "140", "withdrawalStatus": "0"}], "next": None}
        return {"results": [{"docID": "A", "docTypeCode": "120", "withdrawalStatus": "0", "odd": "1"}, {"docID": "B", "docTypeCode": "120", "withdrawalStatus": "1"}], "next": "u?2"}

    rows = rest.rest_source(spark, "u", rest.days("2024-01-01", "2024-01-02"), fetch)
    assert rows.where("error is not null").count() == 1
    got = rest.listings(rows, ["120"]).collect()
    assert [(r.source_id, r.title, r.extra) for r in got] == [("A", "有価証券報告書", {"odd": "1"})]


def test_configs(tmp_path):
    assert files.list_configs(tmp_path / "none") == []
    (tmp_path / "b.yaml").write_text("tables:\n- columns:\n  - {name: a, values: [0.19, x]}\n", encoding="utf-8")
    assert files.load_config(tmp_path / "b.yaml")["tables"][0]["columns"][0]["values"] == ["0.19", "x"]
    (tmp_path / "a.yaml").write_text("tables:\n- columns:\n  - {name: a, template: '{zz}'}\n", encoding="utf-8")
    assert files.list_configs(tmp_path) == ["a.yaml", "b.yaml"]
    with pytest.raises(ValueError, match="zz"):
        files.load_config(tmp_path / "a.yaml")
    with pytest.raises(FileNotFoundError):
        files.load_config(tmp_path / "c.yaml")


ROUTES = [("housing", "P0", ["email", "github_issue"]), ("housing", "P3", ["log_only"]), ("news", "P3", ["log_only"])]


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [{"url": "u", "diff": "d", "ts": "2024-01-01T10:05:00Z"}, {"url": "u", "diff": "d", "ts": "2024-01-01T10:55:00Z"}, {"url": "u", "diff": "d", "ts": "2024-01-01T11:05:00Z"}, {"url": "other", "diff": "d", "ts": "2024-01-01T10:00:00Z"}, {"diff": "d", "ts": "2024-01-01T10:00:00Z"}]
    (src / "a.json").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    watch = spark.createDataFrame([("u", "news", 1), ("u", "housing", 2)], "url string, product string, seq long")
    sent = []
    for _ in range(2):  # a restart sends nothing twice
        changes.start(changes.read_changes(spark, str(src)), watch, str(tmp_path / "out"), str(tmp_path / "ck"), lambda df: sent.extend(df.collect()), ROUTES).awaitTermination(120)
    log = spark.read.json(str(tmp_path / "out"))
    assert log.count() == 2
    assert {r.product for r in log.collect()} == {"housing"}
    assert {r.channel for r in sent} == {"log_only"}


def test_unknown_urgency_is_logged_only(spark):
    df = spark.createDataFrame([("housing", "P9", False), ("housing", "P0", False), ("news", "P3", True), ("zz", None, False)], "product string, urgency string, parse_error boolean")
    got = {(r.product, r.urgency, r.channel) for r in changes.route(df, ROUTES).collect()}
    assert got == {("housing", "P9", "log_only"), ("housing", "P0", "email"), ("housing", "P0", "github_issue"), ("news", "P3", "log_only"), ("news", "P3", "email"), ("zz", "P3", "log_only")}


def test_digest_leaves_out_quiet_products(spark):
    log = spark.createDataFrame([("a", "P0", "2024-01-10 00:00:00", 1), ("a", None, "2024-01-09 00:00:00", 2), ("b", "P1", "2023-12-01 00:00:00", 3)], "product string, urgency string, ts string, seq long").withColumn("ts", F.col("ts").cast("timestamp"))
    r = changes.digest(log, "2024-01-10 12:00:00").collect()
    assert [(x["product"], x.summary) for x in r] == [("a", "Weekly digest (7d): 1 P0, 1 P3")]


def test_package(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    r = package.package({"t": df}, str(tmp_path), "set", "free")
    assert r["rows"] == 2
    assert json.loads((tmp_path / "latest" / "statistics.json").read_text())["t"]["row_count"] == 2
    assert spark.read.parquet(str(tmp_path / "set/t/parquet")).count() == 2
    docs = spark.range(10).select(F.col("id").cast("string").alias("document_id"))
    info = package.export_train_test(docs, str(tmp_path / "hf"))
    assert info["splits"] == {"train": 8, "test": 2}


def test_core_without_llm():
    """Nothing but the entry module knows the llm subpackage."""
    from pathlib import Path

    root = Path(__file__).parent.parent / "quellwerk"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and "quellwerk.llm" in p.read_text(encoding="utf-8")]
