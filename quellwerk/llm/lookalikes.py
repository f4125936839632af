"""Problem 5: characters that look like the usual ones, or cannot be seen.

A longest-match transducer, compiled once from the character database, rewrites grapheme
clusters in one pass: full-width letters and digits, half-width kana with their marks,
separate accents and voicing marks, compatibility forms and radicals of kanji, invisible
characters and spaces. Letters of another script and kana/kanji twins depend on what stands
beside them; they are decided on the rewritten text: within a word by the scripts of its other
letters, between kana by the neighbours, and where either reading is possible by how often the
same three characters stand in all values with the twin instead (the conflict check).

Defined results: null and empty values never count; very long values are rewritten whole;
repeated rows each give a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quellwerk.llm import encoding
from quellwerk.llm.common import cut, sendable, shuffled, table

_INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿"
_SPACES = "   -   　"
_WIDTHS = "０-９Ａ-Ｚａ-ｚ｡-ﾟ"
_FORMS = "⺀-⿟豈-﫿\U0002f800-\U0002fa1f"
_MARKS = "̀-゙ͯ-゜"
#: Twins of Latin letters, by script: letters of the first string look like those of the second.
_TWINS = (
    ("АВЕКМНОРСТХУІЈЅЗаеорсхуіјѕԁһԛԝӏ", "ABEKMHOPCTXYIJS3aeopcxyijsdhqwl"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαγινορυχϲ", "ABEZHIKMNOPTYXayivopuxc"),
    ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏴᏻ", "DRTAJEWMHYGZ4bRWSVSLCPKBG"),
    ("օոսհցՕՏ", "onuhgOS"),
)
_TO_LATIN = {a: b for x, y in _TWINS for a, b in zip(x, y)}
_SCRIPTS = (("latin", "A-Za-zÀ-ÖØ-öø-ɏ"), ("greek", "Ͱ-Ͽἀ-῿"), ("cyrillic", "Ѐ-ԯ"), ("cherokee", "Ꭰ-ᏽꭰ-ꮿ"), ("armenian", "Ա-և"))
_LETTERS = "".join(x for _, x in _SCRIPTS)
_FOREIGN = "".join(x for _, x in _SCRIPTS[1:])
_WORD = re.compile(f"[{_LETTERS}]+")
_OF = [(name, re.compile(f"[{x}]")) for name, x in _SCRIPTS]

#: Kanji and the katakana that look like them.
KANJI_TWINS = dict(zip("一力二八口工夕卜千三才匕又", "ーカニハロエタトチミオヒヌ"))
KANA_TWINS = {b: a for a, b in KANJI_TWINS.items() if b != "ー"}
HIRA_TWINS = dict(zip("へべぺり", "ヘベペリ"))
KATA_TWINS = {b: a for a, b in HIRA_TWINS.items()}
_KATA, _KANJI, _HIRA = "ァ-ヺー", "一-鿿々", "ぁ-ゖ"
#: Without any of these a value is in its usual form; what the patterns find goes to the transducer.
_SHAPES = re.compile(f"[{_INVISIBLE}{_SPACES}{_WIDTHS}{_FORMS}{_MARKS}{_FOREIGN}]")
_BESIDE = re.compile(
    f"[卜匕](?:(?=[{_KATA}])|(?<=[{_KATA}].))|[へべぺり](?:(?=[{_KATA}])|(?<=[{_KATA}].))|[ヘベペリ](?<=[{_HIRA}{_KANJI}].)(?=[{_HIRA}{_KANJI}])"
    f"|[一力二八口工夕千三才又](?<=[{_KATA}].)(?=[{_KATA}\\s0-9第]|$)"
)
#: Places where the neighbours leave it open which twin is meant; the middle is tried first.
_OPEN = re.compile(f"[力二八口工夕千三才又](?<=[{_KANJI}{_HIRA}{_KATA}].)(?=[{_KANJI}{_HIRA}{_KATA}])|[カニハロエタチミオヌ](?<=[{_KANJI}{_HIRA}{_KATA}].)(?=[{_KANJI}{_HIRA}])")
_UNSEEN = re.compile(f"[{_INVISIBLE}]+")
_TWIN = {k: v for k, v in (KANJI_TWINS | KANA_TWINS).items() if k in "力二八口工夕千三才又カニハロエタチミオヌ"}
#: The reading with the twin must stand in so many places, and so many times as often.
OPEN_LEAST, OPEN_RATIO = 5, 5


def _expand(ranges: str) -> list[str]:
    return [chr(c) for a, _, b in re.findall("(.)(-(.))?", ranges, re.S) for c in range(ord(a), ord(b or a) + 1)]


@cache
def transducer() -> ahocorasick.Automaton:
    """Clusters to their usual form. Built from the character database by rule; keys never disagree."""
    to: dict[str, tuple[str, str]] = {}

    def put(key: str, value: str, kind: str) -> None:
        if to.setdefault(key, (value, kind))[0] != value:
            raise ValueError(f"two forms for {key!r}")

    for c in _expand(_INVISIBLE):
        put(c, "", "invisible")
    for c in _expand(_SPACES):
        put(c, " ", "space")
    for c in _expand(_WIDTHS):
        put(c, unicodedata.normalize("NFKC", c), "width")
    for c in _expand("ｦ-ﾝ"):
        for m in "ﾞﾟ":
            both = unicodedata.normalize("NFKC", c + m)
            if len(both) == 1:
                put(c + m, both, "width")
    for c in _expand(_FORMS):
        put(c, unicodedata.normalize("NFKC", c), "form")
    for c in _expand("À-ɏḀ-ỿΆ-ώЀ-џが-ヾ"):
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == c:
            put(parts, c, "accent")
            if len(parts) == 3:
                put(unicodedata.normalize("NFC", parts[:2]) + parts[2], c, "accent")
            if parts[-1] in "゙゚":
                put(parts[0] + ("゛" if parts[-1] == "゙" else "゜"), c, "accent")
    for c in map(chr, (*range(0x300, 0x370), 0x3099, 0x309A)):
        if c not in to:
            put(c, c, "accent")
    a = ahocorasick.Automaton()
    for key, value in to.items():
        a.add_word(key, (len(key), *value))
    a.make_automaton()
    return a


def _words(text: str, kinds: set[str]) -> str:
    def one(m: re.Match) -> str:
        w = m[0]
        n = {name: len(p.findall(w)) for name, p in _OF}
        if sum(v > 0 for v in n.values()) < 2:
            return w
        home = max(n, key=lambda k: (n[k], k == "latin"))
        if home == "latin" or all(c in _TO_LATIN or _OF[0][1].match(c) for c in w):
            new = "".join(_TO_LATIN.get(c, c) for c in w)
        else:
            back = {b: a for x, y in _TWINS for a, b in zip(x, y) if dict(_OF)[home].match(a)}
            new = "".join(back.get(c, c) if _OF[0][1].match(c) else c for c in w)
        if new != w:
            kinds.add("script")
        return new

    return _WORD.sub(one, text)


_NEAR = (
    (re.compile(f"(?<=[{_KATA}])[一力二八口工夕千三才又](?=[{_KATA}]|[\\s0-9第]|$)"), KANJI_TWINS),
    (re.compile(f"(?<=[{_KATA}])[卜匕]|[卜匕](?=[{_KATA}])"), KANJI_TWINS),
    (re.compile(f"(?<=[{_KATA}])[へべぺり](?=[{_KATA}])"), HIRA_TWINS),
    (re.compile(f"(?<=[{_HIRA}])[ヘベペリ](?=[{_HIRA}])"), KATA_TWINS),
    (re.compile(f"(?<=[{_KANJI}])[ヘ](?=[{_KANJI}{_HIRA}])"), KATA_TWINS),
)


def canonical(text: str, open_places: set[str] | frozenset = frozenset()) -> tuple[str, set[str]]:
    """The usual form and what kinds of characters were changed. ``open_places``: three-character places to be read with the twin."""
    out, at, kinds = [], 0, set()
    for end, (n, value, kind) in transducer().iter_long(text):
        start = end - n + 1
        out += [text[at:start], value]
        at = end + 1
        kinds.add(kind)
    text = "".join(out) + text[at:] if out else text
    text = _words(text, kinds)
    for pattern, twins in _NEAR:
        new = pattern.sub(lambda m: twins[m[0]], text)  # noqa: B023
        if new != text:
            kinds.add("kana or kanji")
            text = new
    # All places are found before any is rewritten: they may overlap.
    at_ = {m.start() + 1 for place in open_places for m in re.finditer(f"(?={re.escape(place)})", text)}
    if at_:
        kinds.add("kana or kanji")
        text = "".join(_TWIN[c] if k in at_ else c for k, c in enumerate(text))
    return text, kinds


def places(text: str) -> Counter:
    """Open places of a value, without invisible characters."""
    text = _UNSEEN.sub("", text)
    return Counter(text[m.start() - 1 : m.end() + 1] for m in _OPEN.finditer(text))


def open_places(vals: DataFrame) -> DataFrame:
    """(table_name, field_name, rec_id, place, n) of all values."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, f, i, p, n) for t, f, i, v in zip(b.table_name, b.field_name, b.rec_id, b.value) for p, n in places(v).items()]
            yield pd.DataFrame(rows, columns=["table_name", "field_name", "rec_id", "place", "n"])

    return vals.mapInPandas(run, "table_name string, field_name string, rec_id long, place string, n long")


def open_conflicts(places: DataFrame) -> DataFrame:
    """(place) that reads with the twin, by counts over all values; counts combine before the shuffle."""
    n = places.groupBy("place").agg(F.sum("n").alias("n"))
    twin = F.concat(F.substring("place", 1, 1), F.translate(F.substring("place", 2, 1), "".join(_TWIN), "".join(_TWIN.values())), F.substring("place", 3, 1))
    # Each place tells its own count, and its twin its count too; one aggregation brings both together.
    told = n.select(F.explode(F.array(F.struct("place", "n", F.lit(0).cast("long").alias("other")), F.struct(twin.alias("place"), F.lit(0).cast("long").alias("n"), F.col("n").alias("other")))).alias("t")).select("t.*")
    return told.groupBy("place").agg(F.sum("n").alias("n"), F.sum("other").alias("other")).where(f"n > 0 and other >= {OPEN_LEAST} and other >= {OPEN_RATIO} * n").select("place")


RESULT = "table_name string, field_name string, rec_id long, canonical string, kinds array<string>"


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    jp, rec = table(spark, sf_dir, "jp_case_detail", "rec_id", "full_text", "case_title", spread=True), table(spark, sf_dir, "document_record", "rec_id", "filer_name", spread=True)
    parts = [
        df.select(F.lit(t).alias("table_name"), F.lit(c).alias("field_name"), "rec_id", F.col(c).alias("value"))
        for df, t, c in ((jp, "jp_case_detail", "full_text"), (jp, "jp_case_detail", "case_title"), (rec, "document_record", "filer_name"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("value is not null and value != ''")


def normalise(vals: DataFrame) -> DataFrame:
    """One row per value that isn't in its usual form, with that form."""
    key = ["table_name", "field_name", "rec_id"]
    found = cut(open_places(vals))
    conflicts = cut(open_conflicts(found))
    # A few places go to every task with the code (by a check of their size); more are joined to the values.
    few: frozenset = frozenset()
    if sendable(conflicts, 60):
        few = frozenset(r.place for r in conflicts.collect())
        asked = vals.withColumn("places", F.lit(None).cast("array<string>"))
    else:
        hit = found.join(shuffled(conflicts), "place", "left_semi").groupBy(*key).agg(F.collect_set("place").alias("places"))
        asked = vals.join(shuffled(hit), key, "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, f, i, v, own in zip(b.table_name, b.field_name, b.rec_id, b.value, b.places):
                here = set(own) if own is not None else few.intersection(places(v)) if few else set()
                if here or _SHAPES.search(v) or _BESIDE.search(v):
                    new, kinds = canonical(v, here)
                    if kinds:
                        rows.append((t, f, i, new, sorted(kinds)))
            yield pd.DataFrame(rows, columns=["table_name", "field_name", "rec_id", "canonical", "kinds"])

    return asked.select(*key, "value", "places").mapInPandas(run, RESULT)


def garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose full_text is garbled: they are no cases for full_text."""
    t = encoding.texts(spark, sf_dir, *encoding.TABLES)
    return encoding.detect(t.where("table_name = 'jp_case_detail'"), encoding.fit(t)).select("table_name", F.lit("full_text").alias("field_name"), "rec_id")


def p5_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(values(spark, sf_dir)).join(garbled(spark, sf_dir), ["table_name", "field_name", "rec_id"], "left_anti")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_canonical(spark, sf_dir).select("table_name", "field_name", "rec_id")
