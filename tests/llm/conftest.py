"""Small tables with everything that may go wrong: nulls, blanks, long texts, repeated rows, clashing columns."""

import random

import pytest

COURT = "rec_id long, full_text string, case_title string, url string, text string, table_name string, value string, n long, place string"
DE = "rec_id long, full_text string, source string, text string, token string, n long"


def german(k: int, n: int = 12) -> str:
    r = random.Random(k)
    who, what = ["Der Kläger", "Die Beklagte", "Die Vermieterin"], ["hat die Miete gezahlt", "hat den Mangel angezeigt", "trägt die Kosten des Verfahrens"]
    return "Tenor\n1. Die Klage wird abgewiesen.\n\nTatbestand\n" + " ".join(f"{r.choice(who)} {r.choice(what)}, vgl. Urt. v. {r.randint(1, 28)}. Mai {r.randint(2001, 2024)}." for _ in range(n))


def japanese(k: int, n: int = 20) -> str:
    r = random.Random(k)
    who, what = ["原告", "被告", "賃貸人", "申立人"], ["賃料の支払を求めた", "修繕を怠った", "合意の成立を主張する", "建物を明け渡した"]
    return "主文\n原告の請求を棄却する。\n\n理由\n" + "".join(f"{r.choice(who)}は、令和{r.randint(1, 6)}年{r.randint(1, 12)}月{r.randint(1, 28)}日、{r.choice(who)}に対し、{r.randint(1000, 999999)}円の{r.choice(what)}。" for _ in range(n))


@pytest.fixture(scope="session")
def dirty(spark, tmp_path_factory):
    """(folder with rows, folder with empty tables)."""
    full, empty = (str(tmp_path_factory.mktemp(x)) for x in ("full", "empty"))
    long = japanese(500, 4000)
    jp = [(k, japanese(k), f"事件{k}", f"https://a.example/detail?id={k}", "x", "y", "z", 1, "p") for k in range(40)]
    jp += [(100, None, None, None, None, None, None, None, None), (101, "", "", "", "", "", "", 0, ""), (102, "   \n ", " ", "not a url", "", "", "", 0, ""), (103, long, "長い事件", "https://a.example/x", "", "", "", 0, ""), (104, long, "長い事件", "https://a.example/x", "", "", "", 0, ""), (104, long, "長い事件", "https://a.example/x", "", "", "", 0, "")]
    jp += [(105, "【PDF全文URL】https://a.example/pdf/1.pdf", "t", "https://a.example/y", "", "", "", 0, ""), (106, japanese(7)[:-30], "t", "https://a.example/z", "", "", "", 0, "")]
    de = [(k, german(k), "s", "x", "y", 1) for k in range(40)] + [(100, None, None, None, None, None), (101, "", "", "", "", 0), (102, german(1)[:-9], None, "", "", 0), (103, german(2, 3000), "s", "", "", 0)]
    parsed = [(k, japanese(1000 + k)) for k in range(10)] + [(100, None), (101, "")]
    http = [(1, "<p>Größe</p>".encode(), 200), (2, None, 304), (3, "<p>Größe</p>".encode("latin-1"), 200), (4, b"%PDF-1.4 \xff\xfe", 200), (5, b"\xef\xbb\xbf<p>ok</p>", 200), (6, "<p>Größe</p>".encode().decode("latin-1").encode(), 200), (7, b"", 200)]
    docs = [(k, german(k) if k % 2 else japanese(k), None, "l") for k in range(30)] + [(100, None, None, None), (101, "", None, None), (102, long, "ja", "l")]
    tables = {
        "jp_case_detail": (jp, COURT), "de_case_detail": (de, DE), "parsed_document": (parsed, "rec_id long, full_text string"), "http_response": (http, "rec_id long, content binary, status_code int"),
        "documents": (docs, "doc_id long, text string, lang string, item_id string"), "document_record": ([(1, "株式会社ﾄﾐ"), (2, None), (3, ""), (4, "Oakfen Іnc.")], "rec_id long, filer_name string"),
        "synth_document": ([(k, japanese(2000 + k)) for k in range(5)] + [(100, None), (101, "")], "rec_id long, document_content string"),
        "eval_items": ([(1, "de", "Wer trägt das Wagnis der Zählerablesung, wenn 63 Zeugen nach 12 Monaten in Waldgrund die Zisterne versiegelt sahen und niemand davon erfuhr?"), (2, "ja", None), (3, None, "")], "item_id long, lang string, item_text string"),
        "common_words": ([("de", w, k) for k, w in enumerate(["der", "die", "hat", "den", "des"])] + [(None, None, None)], "lang string, word string, word_rank int"),
        "sentence_scope": ([("jp_case_detail", 1), ("jp_case_detail", 1), ("jp_case_detail", 100), ("de_case_detail", 1), ("nope", 1), (None, None)], "table_name string, rec_id long"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(f"{full}/{name}.parquet")
        df.where("1 = 0").write.parquet(f"{empty}/{name}.parquet")
    return full, empty
