import random
import re
import textwrap
from itertools import combinations

import numpy as np
import pytest

from quellwerk.llm import common, encoding, leakage, lookalikes, neardup, packing, quality, registry, sentences, truncation
from tests.llm.conftest import german, japanese


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_dirty_and_empty_tables(spark, dirty, name):
    full, empty = dirty
    rows = registry.queries()[name](spark, full).collect()
    none = registry.queries()[name](spark, empty)
    assert none.columns == list(registry.queries()[name](spark, full).columns)
    if not name.endswith(("utilisation",)):
        assert none.count() == 0
    assert rows is not None


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_runs_on_data(spark, tiny, name):
    assert len(registry.queries()[name](spark, tiny).take(1)) == 1


# ---- 1 ----


@pytest.mark.parametrize(
    "text,cut",
    [
        ("Die Klage ist begründet.", False), ("Die Klage ist begr", True), ("Die Klage ist", True), ("Die Klage ist begr …", True), ("Die Klage ist begr [mehr]", True), ("Ein Satz.\n\ngez. Unterschriften", False),
        ("Ein Satz\n\ngez. Unterschriften", True), ("Ein Satz.\nAnlagen: 1, 2, 3", False), ("Er sagte: „Ja. Nein", True), ("Er sagte: „Ja. Nein.“", False), ("fällig seit dem 12.", True), ("Beschluss zu TOP 20.", False),
        ("請求を棄却する。\n\n以上", False), ("請求を棄却", True), ("請求を棄却（続きを読む）", True), ("請求を棄却\n\n【PDF全文URL】https://a.example/1.pdf", True), ("（なお、留保した。", True), ("認めない（甲1号証）", True), ("認めない（甲1号証）。", False),
    ],
)
def test_ends(text, cut):
    assert truncation.end_traits(truncation.running(text))[1] is cut


def test_no_running_text():
    assert truncation.end_traits(truncation.running("【PDF全文URL】https://a.example/1.pdf")) is None
    assert truncation.end_traits(truncation.running(" \n")) is None


def test_cut_records(spark, dirty):
    got = {(r.table_name, r.rec_id) for r in truncation.p1_found(spark, dirty[0]).collect()}
    assert got == {("de_case_detail", 102), ("jp_case_detail", 106)}
    shares = {(r.table_name, r.source): r.n_cut for r in truncation.p1_share_by_source(spark, dirty[0]).collect()}
    assert shares["de_case_detail", None] == 1
    assert shares["jp_case_detail", "a.example"] == 1


@pytest.mark.parametrize(
    "end,ok,unclosed",
    [
        # A character lost long before the end of a last line that breaks off.
        ("原告は被告に対し、賃料�円の支払を求めたが、被告はこれを拒み、その後も建物を", False, False),
        # A bracket opened after the lost character, or before it.
        ("原告は賃�料を求めた。被告は「建物を明け渡した。", False, True),
        ("原告は「賃�料を求めた。被告は建物を明け渡した。", True, False),
        ("原告は「賃�料」を求め」た。被告は「建物を」明け渡した。", True, False),
        # An annex list whose label is garbled.
        ("原告は賃�料を求めた。\n蛻･邏�: 74, 97, 49, 76, 49, 29, 60, 77, 18, 68, 91, 42, 97, 92, 64", True, False),
        # The end itself is lost.
        ("原告は被告に対し、賃料の支払を求め�た�", True, False),
    ],
)
def test_lost_characters_before_the_end(end, ok, unclosed):
    kind, open_, *_ = truncation.end_traits(truncation.running("理由\n\n" + end))
    assert (not open_, kind == "unclosed") == (ok, unclosed)


def test_witnesses_decide(spark):
    """Headings are told from fragments by the corpus, abbreviations are learned, each witness weighs."""
    body = "Der Kläger hat die Miete gezahlt, so LG X, Urt. v. 3. Mai. Die Vermieterin hat nach Bl. 5 d. A. den Mangel angezeigt."
    texts_ = [f"Tatbestand\n\n{german(k)}\n\n{body}\n\nKostenpunkt\n\nDer Kläger trägt {k} Euro." for k in range(200)]
    odd = {
        "word": body + "\n\nDie Vermieterin hat den Mangel nicht erkannt und der Kläger die Mie", "short": body + "\n\nDie Vermieterin hat den Mang", "short_words": body + "\n\nDer Kläger hat gegen den",
        "heading": body + "\n\nKostenpunkt", "abbreviation": body + "\n\nDer Kläger hat die Miete gezahlt und den Mangel angezeigt, so LG X, Urt. v.", "whole": body,
    }
    rows = [("de_case_detail", k, "s", t) for k, t in enumerate(texts_)] + [("de_case_detail", 1000 + k, "s", t) for k, t in enumerate(odd.values())]
    df = spark.createDataFrame(rows, "table_name string, rec_id long, source string, text string")
    got = {r.rec_id: r for r in truncation.detect(df, encoding.train([])).collect()}
    assert set(got) == {1000 + k for k, name in enumerate(odd) if name not in ("heading", "whole")}
    assert got[1000].broken_word and not got[1002].broken_word and got[1000].score > got[1004].score


# ---- 2 ----


@pytest.fixture(scope="module")
def model():
    return encoding.train([japanese(k) for k in range(200, 260)] + [german(k) for k in range(200, 230)])


@pytest.mark.parametrize("pair", [p for p, (_, inverse) in encoding.PAIRS.items() if inverse])
def test_round_trip_of_a_garbled_sentence(model, pair):
    clean = japanese(3)
    start = clean.index("令和")
    stop = clean.index("。", start) + 1
    bad = clean[:start] + encoding.PAIRS[pair][0](clean[start:stop]) + clean[stop:]
    spans = encoding.label([bad], model)[0]
    assert spans
    back = encoding.repair(bad, spans)
    if "�" not in bad and "" > max(bad):
        # A number at the edge of the passage reads the same either way.
        assert re.sub(r"\s", "", back) == re.sub(r"\s", "", clean)


@pytest.mark.parametrize("text", ["Северный Порт の名義", "輸入元はSÃO BENTO社", "口座名義はｶ)ﾅｷﾞﾗﾝ", "Größe § 5 – „ja“", "「±0.5℃」の管理幅", "ｴﾚﾍﾞｰﾀｰの改修", "", "a"])
def test_unusual_but_intended(model, text):
    assert encoding.label([japanese(5) + text], model)[0] == []


def test_responses(spark, dirty):
    got = {r.rec_id: r.restored for r in encoding.p2_restored(spark, dirty[0]).collect() if r.table_name == "http_response"}
    assert got == {3: "<p>Größe</p>", 6: "<p>Größe</p>"}


def test_viterbi_is_the_same_alone_and_in_a_block(model):
    texts = [japanese(k, 3) for k in range(5)] + ["", encoding.PAIRS["utf8_as_western"][0](japanese(9, 2))]
    together = encoding.viterbi(texts, model)
    for t, p in zip(texts, together):
        assert (encoding.viterbi([t], model)[0] == p).all()


@pytest.mark.parametrize("pair", [p for p, (_, inverse) in encoding.PAIRS.items() if inverse])
def test_short_runs_come_back(spark, pair):
    """Runs of eight characters inside clean texts of the data are found and restored to the very text."""
    texts = [r.full_text for r in spark.read.parquet("/root/testdata/sf0.001/jp_case_detail.parquet").select("full_text").collect()]
    clean = [t for t in texts if t and len(t) > 200 and not encoding._SUSPICIOUS_PY.search(t)]
    model = encoding.train(clean)
    r, bad, whole = random.Random(8), [], []
    for t in clean * 3:
        a = r.randrange(20, len(t) - 28)
        garbled = encoding.PAIRS[pair][0](t[a : a + 8])
        if garbled != t[a : a + 8] and "�" not in garbled:
            bad.append(t[:a] + garbled + t[a + 8 :])
            whole.append(t)
    found = encoding.label_odd(bad, model)
    back = sum(bool(found.get(k)) and encoding.repair(b, found[k]) == w for k, (b, w) in enumerate(zip(bad, whole)))
    assert len(bad) > 10
    assert back >= 0.8 * len(bad)


def test_filter_leaves_no_escape_run_out():
    for n in (1, 2, 5):
        for k in range(30):
            part = japanese(k)[5 : 5 + n]
            bad = encoding.PAIRS["iso2022jp_as_ascii"][0](part)
            assert bad == part or encoding._SUSPICIOUS_PY.search(bad)


def test_bytes_go_through_the_model(spark, dirty):
    model = encoding.train([japanese(k) for k in range(60)] + [german(k) for k in range(60)])
    for k, (name, pair) in enumerate((("cp932", "cp932_as_western"), ("euc_jp", "eucjp_as_western"), ("cp1252", "cp1252_as_utf8"))):
        want = "<p>Größe der Räume, § 5</p>" if name == "cp1252" else "<h2>主文</h2>\n<p>" + japanese(k + 80) + "</p>"
        text = encoding._read_western(want.encode(name))
        pairs, back = encoding.from_western(text, model, encoding.label_odd([text], model).get(0, []))
        assert (pairs, back) == ([pair], want)


# ---- 3 ----


@pytest.mark.parametrize("block,sent", [(2_000, 8_000_000), (3, 0)])
def test_pairs_against_brute_force(spark, monkeypatch, block, sent):
    """As in use; and with every band of three texts dealt in blocks, and no ids sent to the texts."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SOUGHT", 1 if sent == 0 else 64)
    monkeypatch.setattr(common, "MOST_SENT", sent)
    r = random.Random(1)
    base = [neardup.normal(japanese(k, 30)) for k in range(25)]
    texts = list(base)
    for b in base[:12]:
        for edits in (3, 12, 25):
            x = list(b)
            for _ in range(edits):
                p = r.randrange(len(x))
                x[p : p + r.choice([0, 1])] = r.choice(["の", "", "は"])
            texts.append("".join(x))
    texts += [base[0]] * 7 + [base[1]] * 4 + [base[1][:499]]
    df = spark.createDataFrame([("t", k, t) for k, t in enumerate(texts)], "table_name string, rec_id long, text string")
    got = [(x.rec_id_a, x.rec_id_b) for x in neardup.expand(*neardup.near_texts(df)).collect()]
    want = {(a, b) for a, b in combinations(range(len(texts)), 2) if min(len(texts[a]), len(texts[b])) >= 500 and neardup.similarity(texts[a], texts[b]) >= 0.65}
    assert set(got) == want
    assert len(got) == len(want)


def test_tables_do_not_meet(spark):
    rows = [(t, k, japanese(k // 2, 40)) for t in ("s", "t") for k in range(4)]
    df = spark.createDataFrame(rows, "table_name string, rec_id long, text string")
    got = sorted(tuple(x) for x in neardup.expand(*neardup.near_texts(df)).collect())
    assert got == [(t, a, b) for t in ("s", "t") for a, b in ((0, 1), (2, 3))]


def test_large_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    keys = {0: b"a" * 16, 1: b"b" * 16}
    members = spark.createDataFrame([("t", k, keys[k // 9]) for k in range(16)], "table_name string, rec_id long, text_key binary")
    near = spark.createDataFrame([("t", keys[0], keys[1], 0.9)], "table_name string, key_a binary, key_b binary, similarity double")
    got = [tuple(r)[1:] for r in neardup.expand(members, near).collect()]
    assert sorted(got) == list(combinations(range(16), 2))


def test_no_growing_side_is_broadcast(spark, tiny):
    plan = neardup.p3_found(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.group_id for r in neardup.components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_scattered_edits_share_a_band():
    missed = 0
    for k in range(400):
        r = random.Random(k)
        a = [chr(r.randint(0x4E00, 0x8E00)) for _ in range(600)]
        b = list(a)
        for i in r.sample(range(600), 22):
            b[i] = chr(r.randint(0x4E00, 0x8E00))
        x, y = ({"".join(t[i : i + 5]) for i in range(596)} for t in (a, b))
        if len(x & y) >= 0.7 * len(x | y):
            missed += not (neardup.bands(neardup.signature("".join(a))) == neardup.bands(neardup.signature("".join(b)))).any()
    assert missed == 0


# ---- 4 ----


@pytest.fixture(scope="module")
def splitter(spark):
    texts = [german(k) + f" Die Klage folgt aus § 5 Abs. {k} BGB." for k in range(300)] + [japanese(k) for k in range(40)]
    en = "The filing by Norvika Inc. covers two sites. However, Dr. M. of the office, e.g. the auditor, agreed at approx. 28 percent. Under Art. 5 the provider must answer. The office closed. No further form is needed."
    texts += [en + f" The fee rose to {k} percent." for k in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model, lines = sentences.learn(sentences.count_all(df))
    return sentences.Splitter(sentences.with_lines(model, lines.collect()))


def test_lines_by_a_join_give_the_same_units(spark, monkeypatch):
    df = sentences.texts(spark, "/root/testdata/sf0.001")
    learned = sentences.learn(sentences.count_all(df))
    sent = sorted(map(tuple, sentences.split(df, learned).collect()))
    assert learned[1].count() > 20
    monkeypatch.setattr(common, "MOST_SENT", 0)
    assert sorted(map(tuple, sentences.split(df, learned).collect())) == sent


@pytest.mark.parametrize(
    "text,units",
    [
        ("Tenor\n1. Die Klage wird abgewiesen.\n\nDer Kläger hat die Miete gezahlt, vgl. Urt. v. 3. Mai 2004. Die Beklagte nicht.", ["Tenor", "1. Die Klage wird abgewiesen.", "Der Kläger hat die Miete gezahlt, vgl. Urt. v. 3. Mai 2004.", "Die Beklagte nicht."]),
        ("Der Kläger sagte: „Ja. Gut so.“ Die Beklagte schwieg.", ["Der Kläger sagte: „Ja. Gut so.“", "Die Beklagte schwieg."]),
        ("„Das ist gut.“ heißt es dort. Die Klage", ["„Das ist gut.“ heißt es dort.", "Die Klage"]),
        ("Die Klage folgt nicht aus\n§ 5 Abs. 2 BGB.", ["Die Klage folgt nicht aus\n§ 5 Abs. 2 BGB."]),
        ("主文\n原告は「終える。」と述べた。（なお、被告は怠った。）次に進む。\n\n以上", ["主文", "原告は「終える。」と述べた。", "（なお、被告は怠った。）", "次に進む。", "以上"]),
        ("証拠はない\n（甲1号証）。次。", ["証拠はない\n（甲1号証）。", "次。"]),
        ("However, Dr. M. of the office, e.g. the auditor, agreed. The office closed.", ["However, Dr. M. of the office, e.g. the auditor, agreed.", "The office closed."]),
        ("", []), (" \n \n", []), ("x", ["x"]),
    ],
)
def test_units(splitter, text, units):
    assert [text[a:b] for a, b in splitter.units(text)] == units


def test_units_cover_the_text(splitter):
    for t in (german(7), japanese(7)):
        spans = splitter.units(t)
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert "".join(t[a:b] for a, b in spans).replace(" ", "").replace("\n", "") == t.replace(" ", "").replace("\n", "")


# ---- 5 ----


@pytest.mark.parametrize(
    "value,usual",
    [
        ("株式会社ﾄﾐ電機", "株式会社トミ電機"), ("Ｉｎｃ.", "Inc."), ("が", "が"), ("Münde", "Münde"), ("人事", "人事"), ("⼈事", "人事"), ("社​長", "社長"), ("a b", "a b"), ("Оakfen", "Oakfen"), ("GmbН", "GmbH"), ("Порт Восток", "Порт Восток"),
        ("Ω研究所", "Ω研究所"), ("フ一ズ", "フーズ"), ("ヤマモ卜", "ヤマモト"), ("ハルべル", "ハルベル"), ("というベきである", "というべきである"), ("（ハ）、５", "（ハ）、5"), ("％：；", "％：；"), ("", ""), ("Пoрт", "Порт"),
    ],
)
def test_canonical(value, usual):
    new, kinds = lookalikes.canonical(value)
    assert new == usual
    assert bool(kinds) is (new != value)


def test_canonical_is_stable():
    for c in map(chr, range(0x20, 0x3100)):
        once = lookalikes.canonical("x" + c + "x")[0]
        assert lookalikes.canonical(once)[0] == once


@pytest.mark.parametrize("sent", [8_000_000, 0])  # places in the code, and places by a join
def test_open_places_by_counts(spark, monkeypatch, sent):
    monkeypatch.setattr(common, "MOST_SENT", sent)
    rows = [("t", "f", k, "水力発電と漢カ二字と漢力ニ字") for k in range(10)] + [("t", "f", 99, "水カ発電"), ("t", "f", 100, "ミ工業"), ("t", "f", 101, None), ("t", "f", 102, "漢力二字")]
    df = spark.createDataFrame(rows, "table_name string, field_name string, rec_id long, value string").where("value is not null")
    got = {r.rec_id: r.canonical for r in lookalikes.normalise(df).collect()}
    # Places that overlap are each rewritten.
    assert got == {99: "水力発電", 102: "漢カニ字"}


def test_found_values(spark, dirty):
    got = {(r.table_name, r.field_name, r.rec_id) for r in lookalikes.p5_found(spark, dirty[0]).collect()}
    assert got == {("document_record", "filer_name", 1), ("document_record", "filer_name", 4)}


# ---- 6 ----


def test_best_fit_is_tightest():
    r = random.Random(2)
    for _ in range(50):
        sizes = sorted((r.randint(1, 60) for _ in range(80)), reverse=True)
        left: dict[int, int] = {}
        for size, got in zip(sizes, packing.best_fit(sizes, 60)):
            fits = [v for v in left.values() if v >= size]
            if fits:
                assert left[got] == min(fits)
            else:
                assert got not in left
            left[got] = left.get(got, 60) - size
        assert min(left.values()) >= 0


def test_pack_splits_only_what_is_too_large(spark):
    sizes = spark.createDataFrame([(1, 25), (2, 10), (3, 20), (4, 3), (5, 0), (6, None)], "doc_id long, n_tokens long")
    rows = packing.pack(sizes, 10).collect()
    by = {d: sorted((r.start_token, r.n_tokens) for r in rows if r.doc_id == d) for d in range(1, 7)}
    assert by == {1: [(0, 10), (10, 10), (20, 5)], 2: [(0, 10)], 3: [(0, 10), (10, 10)], 4: [(0, 3)], 5: [], 6: []}
    used: dict[str, int] = {}
    for r in rows:
        used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
    assert max(used.values()) <= 10 and len(used) == 6


# ---- 7 ----

ITEM = "Wer trägt das Wagnis der Zählerablesung, wenn 63 Zeugen nach 12 Monaten in Waldgrund die Zisterne versiegelt sahen und niemand davon erfuhr?"
JA_ITEM = "設問：椿倉の郡の検査役が封印された茶箱を写し取ったあとで霧岡の灯台守の甥から舟小屋の床代を13回に分けて引き取ったとすれば、白野の破産した問屋の立場はどう変わるか。"


@pytest.mark.parametrize("text,leak", [(ITEM, True), ("x " + ITEM.upper().replace(" ", "\n") + " y", True), (" ".join(ITEM.split()[2:14]), True), (" ".join(ITEM.split()[2:13]), False), (ITEM.replace("63", "64").replace("12", "14").replace("Waldgrund", "Moorgrund"), False), ("", False)])
def test_leaks_of_words(text, leak):
    items = leakage.Items([(1, "de", ITEM)])
    assert any(v for _, v, _ in leakage.leaks(text, items)) is leak


@pytest.mark.parametrize("a,b,leak", [(0, 80, True), (5, 49, True), (5, 40, False)])
def test_leaks_of_signs(a, b, leak):
    items = leakage.Items([(1, "ja", JA_ITEM)])
    part = JA_ITEM[a:b]
    text = "主文。" + "\n".join(part[k : k + 7] for k in range(0, len(part), 7)) + "。以上"
    assert any(v for _, v, _ in leakage.leaks(text, items)) is leak


def test_other_parameters_are_told_apart():
    items = leakage.Items([(1, "de", ITEM)])
    other = ITEM.replace("63", "64").replace("12", "14")
    assert [(v, n > 0) for _, v, n in leakage.leaks(other, items)] == [(False, True)]


def test_join_of_many_items(spark):
    docs = spark.createDataFrame([(1, "Vor dem Text: " + ITEM), (2, JA_ITEM), (3, "nichts"), (4, None), (5, ITEM)], "doc_id long, text string")
    evals = spark.createDataFrame([(1, "de", ITEM), (2, "ja", JA_ITEM), (3, "de", None)], "item_id long, lang string, item_text string")
    few = {tuple(r) for r in leakage.detect(docs, evals).where("verbatim").select("doc_id", "item_id").collect()}
    many = {tuple(r) for r in leakage.detect(docs, evals, 0).where("verbatim").select("doc_id", "item_id").collect()}
    assert few == many == {(1, 1), (2, 2), (5, 1)}


@pytest.mark.parametrize("sent", [8_000_000, 0])
def test_both_joins_give_the_same_rows(spark, monkeypatch, sent):
    """All rows of whole tables, re-parameterised ones with other numbers, units and names too."""
    folder = "/root/testdata/sf0.01"
    docs, evals = common.table(spark, folder, "documents", "doc_id", "text"), common.table(spark, folder, "eval_items", "item_id", "lang", "item_text")
    few = sorted(tuple(r) for r in leakage.detect(docs, evals).collect())
    monkeypatch.setattr(common, "MOST_SENT", sent)
    many = sorted(tuple(r) for r in leakage.detect(docs, evals, 0).collect())
    assert few == many
    assert sum(not r[2] for r in few) > 600 and sum(r[2] for r in few) > 40


def test_a_number_split_by_marks_is_one():
    items = leakage.Items([(1, "ja", JA_ITEM)])
    assert any(v for _, v, _ in leakage.leaks(JA_ITEM.replace("13回", "1, 3回"), items))


# ---- 8 ----

WORDS = quality.Words({"de": frozenset(["der", "die", "hat", "den", "des"]), "en": frozenset(["the", "of", "and", "is"]), "ja": frozenset("の に は を た が で て と し から".split())})


@pytest.mark.parametrize(
    "text,prose",
    [
        (german(1), True), (japanese(1), True), ("\n".join(f"{a},{a + 1},{a + 2}" for a in range(20)), False), ("\n".join(f"| a{k} | b | {k} |" for k in range(9)), False), ("\n".join(f"- Miete {k}" for k in range(9)), False),
        ("Loading\n" * 30, False), ("Click here to read the rest of it. " * 40, False), ("qwx zzk plm brt " * 30, False), (german(2) + "\n" + "\n".join(f"- Miete {k}" for k in range(3)), True),
        ("Die Vermieterin hat den\nMangel des Hauses nicht\nbeseitigt, und die Miete\nist der Klägerin zu hoch.", True), ("2024-01-01T00:00:01 INFO worker rc=1\n" * 9, False), ("", True), (" \n", True),
    ],
)
def test_prose(text, prose):
    assert quality.statistics(text, WORDS)[-1] is prose


_NAMES = ["Kessel", "Pumpe im Nebenraum des Kellers", "Zaun", "Dach der alten Scheune am Fluss", "Ofen"]


@pytest.mark.parametrize(
    "text,prose",
    [
        # Indented entries, without a marker, of more than 30 characters and with common words.
        ("\n".join(f"    {_NAMES[k % 5]} und die Wartung der Anlage hat Vorrang" for k in range(12)), False),
        # The same where each second line is indented.
        ("\n".join(f"{'    ' * (k % 2)}{_NAMES[k % 5]} und die Wartung der Anlage hat Vorrang" for k in range(12)), False),
        # A log without indentation: the lengths return with a period.
        ("\n".join(["Worker hat den Auftrag der Warteschlange ohne Fehler ausgeführt", "Speicher hat die Seiten geleert und den Rest behalten"][k % 2] + " " + "abcdefghijkl"[k] for k in range(12)), False),
        # Indented prose, and prose broken at a width or anywhere, goes on from line to line.
        ("\n".join("    " + x for x in textwrap.wrap("Die Vermieterin hat den Mangel des Hauses nicht beseitigt und die Miete ist der Klägerin zu hoch. " * 2, 60)), True),
        ("\n".join("    " + x for x in textwrap.wrap("Die Vermieterin hat den Mangel des Hauses der Mieter und der Nachbarn " + "die der Klägerin bei der Suche nach den Akten halfen und " * 9 + "die der Richter hat.", 50)), True),
        ("\n".join(x[k : k + 31] for x in [japanese(3, 30).split("\n")[-1]] for k in range(0, len(x), 31)), True),
        # Items that are sentences broken into short lines.
        ("\n".join(f"{k}. Das Urteil ist gegen die Sicherheit von\n{k}23.806,51 Euro der Klägerin vollstreckbar." for k in (1, 2)), True),
        # 45 of a hundred characters in sentences are not most.
        ("Der Kläger hat den Mangel des Hauses angezeigt. " * 2 + "\n" + "\n".join(f"- Miete {k:04}" for k in range(10)), False),
    ],
)
def test_prose_by_periods_and_lengths(text, prose):
    assert quality.statistics(text, WORDS)[-1] is prose


@pytest.mark.parametrize("detector,text", [("aligned", "\n".join(f"{_NAMES[k % 5]}\tder Ofen hat\tdie Pumpe\tden Zaun" for k in range(9))), ("_shapes", "\n".join(f"    {_NAMES[k % 5]} und die Wartung der Anlage hat Vorrang" for k in range(12))), ("length_steadiness", "\n".join(["Worker hat den Auftrag der Warteschlange ohne Fehler ausgeführt", "Speicher hat die Seiten geleert und den Rest behalten"][k % 2] + " " + "abcdefghijkl"[k] for k in range(12)))])
def test_each_detector_decides(monkeypatch, detector, text):
    assert not quality.statistics(text, WORDS)[-1]
    off = {"aligned": lambda lines: np.zeros(len(lines), bool), "_shapes": lambda lines: [""] * len(lines), "length_steadiness": lambda lines: 0.0}
    monkeypatch.setattr(quality, detector, off[detector])
    assert quality.statistics(text, WORDS)[-1]


def test_digits_and_common_words_of_japanese():
    text = "金額は１２３４５６７８９０円である。"
    n = dict(zip(quality._NAMES[1:], quality.statistics(text, WORDS)))
    assert round(n["symbol_ratio"], 2) == 0.06 and round(n["digit_ratio"], 2) == 0.56
    assert n["common_word_ratio"] == pytest.approx(2 / 7)
    assert quality.statistics("被告は原告に賃料を支払った。", WORDS)[-1] and not quality.statistics("口座番号 預金種別 支店名称 合計金額", WORDS)[-1]


def test_steadiness_is_an_autocorrelation():
    assert quality.length_steadiness(["a" * 20] * 6) == 1
    assert quality.length_steadiness(["a" * 20, "a" * 60] * 20) > 0.9
    r = random.Random(1)
    assert quality.length_steadiness(["a" * r.randint(50, 70) for _ in range(200)]) < 0.3


def test_statistics_of_null(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.is_prose) for r in quality.measure(df, WORDS).collect()}
    assert got == {1: (None, None), 2: (0, True)}


def test_cut_writes_to_the_shared_folder(spark, tmp_path):
    df = common.cut(spark.range(3))
    assert df.count() == 3
    assert "Range" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, name):
    import glob
    import os

    import duckdb

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    own = sorted(tuple(r) for r in registry.queries()[name](spark, folder).collect())
    assert own == sorted(con.execute(registry.oracle_sql()[name]).fetchall())
