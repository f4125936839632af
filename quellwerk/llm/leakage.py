"""Problem 7: passages of evaluation items inside the corpus.

Items and documents are brought to template form: numbers, units and names become typed
placeholders. Windows of the item templates are hashed; documents are joined on them, each window
that meets is then checked slot by slot. A pair whose slots all agree holds the item's own words, and
is a leak if the run is long enough (12 words; Japanese: 40 letters and digits); a pair whose slots
differ, but one-to-one, is the same question with other parameters and is reported separately.

Items of at most ``FEW_WINDOWS`` windows go to every task with the code (their size is checked);
more items are joined to the documents' windows by a shuffle on the hash instead, with the same rows.

Defined results: null or empty texts and items shorter than a window hold nothing; every copy of a
document and every copy of an item gives its own row; long texts are read whole; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quellwerk.llm.common import cut, sendable, shuffled, table

#: Words (de, en) and letters or digits (ja) of a run that counts.
RUN_WORDS, RUN_SIGNS = 12, 40
#: Template units of a Japanese window: a run of 40 signs holds that many, for numbers shrink to one unit.
WINDOW_WORDS, WINDOW_SIGNS = 12, 22
#: Up to so many item windows are sent along with the code (some 200 bytes each); beyond it the join shuffles.
FEW_WINDOWS = 100_000
#: Tasks that the documents of one template window are dealt to by that shuffle.
SALTS = 16

_TOKEN = re.compile(r"[^\W_]+")
_JA = re.compile("[ぁ-ゖァ-ヺー一-鿿々]")
_JA_UNIT = re.compile(r"\d+|[^\W\d_]")
_NUMBER = re.compile(r"\d+")
_UNITS = frozenset("euro eur prozent percent tage tagen tag days day monate monaten monat months month jahre jahren jahr years year wochen woche weeks week stunden stunde hours hour km kg qm cm mm yen usd".split())
_BEFORE_NAMES = frozenset("aus in von bei of from at for by to".split())


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.casefold())


def signs(text: str) -> list[str]:
    """Letters and numbers of a Japanese text, without what doesn't count between them; a number is one unit."""
    return _JA_UNIT.findall("".join(filter(str.isalnum, text.casefold())))


def is_japanese(lang: str | None, text: str) -> bool:
    """Whether an item is read by signs."""
    lang = (lang or "").lower()
    return lang == "ja" or lang not in ("de", "en") and len(_JA.findall(text)) * 3 > len(text)


def after_prepositions(text: str) -> set[tuple[str, bool]]:
    """(word, whether capitalised) of the words that follow a preposition."""
    w = _TOKEN.findall(text)
    return {(b.casefold(), b[:1].isupper()) for a, b in zip(w, w[1:]) if a.casefold() in _BEFORE_NAMES}


def names(texts: list[str]) -> set[str]:
    """Words that are capitalised after a preposition wherever they stand there, in any item."""
    seen = set().union(*map(after_prepositions, texts))
    return {w for w, upper in seen if upper} - {w for w, upper in seen if not upper}


def word_form(w: str, known_names: set[str] | frozenset[str]) -> str:
    return "#n" if w[0].isdigit() else "#u" if w in _UNITS else "#p" if w in known_names else w


def sign_form(w: str) -> str:
    return "#n" if w[0].isdigit() else w


class Items:
    """Item templates and the hash table of their windows; ``units`` and ``forms`` by item, windows by their forms."""

    def __init__(self, rows: list[tuple[int, str | None, str | None]]):
        rows = [(i, is_japanese(lang, t), t) for i, lang, t in rows if t]
        self.names = names([t for _, ja, t in rows if not ja])
        self.words = {i: tokens(t) for i, ja, t in rows if not ja}
        self.ja = {i: signs(t) for i, ja, t in rows if ja}
        self.word_windows = windows_of({i: [word_form(x, self.names) for x in w] for i, w in self.words.items()}, WINDOW_WORDS)
        self.sign_windows = windows_of({i: list(map(sign_form, w)) for i, w in self.ja.items()}, WINDOW_SIGNS)
        self.known_words = {f for w in self.word_windows for f in w}
        self.known_signs = {f for w in self.sign_windows for f in w}

    def __len__(self) -> int:
        return len(self.word_windows) + len(self.sign_windows)


def windows_of(forms: dict[int, list[str]], n: int) -> dict:
    out = defaultdict(list)
    for i, f in forms.items():
        for k in range(len(f) - n + 1):
            out[tuple(f[k : k + n])].append((i, k))
    return dict(out)


def _runs(known: list[bool], n: int) -> Iterator[tuple[int, int]]:
    start = None
    for k, ok in enumerate([*known, False]):
        if ok and start is None:
            start = k
        elif not ok and start is not None:
            if k - start >= n:
                yield start, k
            start = None


def _meet(units: list[str], forms: list[str], items: dict[int, list[str]], windows: dict, known: set, n: int, whole) -> dict[int, tuple[bool, int]]:
    """item -> (verbatim, windows met). Only stretches of known template units can hold a window."""
    best: dict[int, list] = {}
    for a, b in _runs([f in known for f in forms], n):
        for k in range(a, b - n + 1):
            for i, at in windows.get(tuple(forms[k : k + n]), ()):
                got = best.setdefault(i, [False, 0])
                if not got[0]:
                    item = items[i]
                    pairs = {(x, y) for x, y in zip(units[k : k + n], item[at : at + n]) if x != y}
                    if not pairs:
                        got[0] = whole(units, item, k, at, n)
                    # Slots are consistent if no value stands for two others, either way.
                    if len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs}):
                        got[1] += 1
                else:
                    got[1] += 1
    return {i: (v, c) for i, (v, c) in best.items() if v or c}


def _word_run(doc: list[str], item: list[str], k: int, at: int, n: int) -> bool:
    return n >= RUN_WORDS


def _sign_run(doc: list[str], item: list[str], k: int, at: int, n: int) -> bool:
    """Whether the run of equal signs around a window is long enough; numbers at its edges count as far as they agree."""
    a, b = k, at
    while a and b and doc[a - 1] == item[b - 1]:
        a, b = a - 1, b - 1
    c, d = k + n, at + n
    while c < len(doc) and d < len(item) and doc[c] == item[d]:
        c, d = c + 1, d + 1
    size = sum(map(len, doc[a:c]))
    if a and b and doc[a - 1][0].isdigit() and item[b - 1][0].isdigit():
        x, y = doc[a - 1][::-1], item[b - 1][::-1]
        size += next((j for j, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    if c < len(doc) and d < len(item) and doc[c][0].isdigit() and item[d][0].isdigit():
        x, y = doc[c], item[d]
        size += next((j for j, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    return size >= RUN_SIGNS


def leaks(text: str, items: Items) -> list[tuple[int, bool, int]]:
    """(item, verbatim, template windows met) of a text."""
    found = {}
    if items.words:
        units = tokens(text)
        found = _meet(units, [word_form(u, items.names) for u in units], items.words, items.word_windows, items.known_words, WINDOW_WORDS, _word_run)
    if items.ja and _JA.search(text):
        units = signs(text)
        found |= _meet(units, list(map(sign_form, units)), items.ja, items.sign_windows, items.known_signs, WINDOW_SIGNS, _sign_run)
    return [(i, v, c) for i, (v, c) in sorted(found.items())]


RESULT = "doc_id long, item_id long, verbatim boolean, n_windows long"
_RESULT = [c.split()[0] for c in RESULT.split(", ")]


def _join_few(docs: DataFrame, items: Items) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, *x) for d, t in zip(b.doc_id, b.text) for x in leaks(t, items)]
            yield pd.DataFrame(rows, columns=_RESULT)

    return docs.mapInPandas(run, RESULT)


UNITS = "row string, id long, ja boolean, units array<string>"


def _units(df: DataFrame, text: str, item: bool) -> DataFrame:
    """A row per text and kind of reading, numbered: a document is read by words and, with Japanese in it, by signs too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for row, i, t, lang in zip(b.row, b.id, b.text, b.lang):
                for ja in (False, True):
                    if ja == is_japanese(lang, t) if item else not ja or _JA.search(t):
                        rows.append((f"{row}{'s' if ja else 'w'}", i, ja, signs(t) if ja else tokens(t)))
            yield pd.DataFrame(rows, columns=["row", "id", "ja", "units"])

    key, lang = ("item_id", F.col("lang")) if item else ("doc_id", F.lit(None).cast("string"))
    # Repeated ids are rows of their own; a written table keeps their numbers.
    return cut(df.select(F.monotonically_increasing_id().cast("string").alias("row"), F.col(key).alias("id"), F.col(text).alias("text"), lang.alias("lang")).mapInPandas(run, UNITS))


def _names_of(evals: DataFrame) -> DataFrame:
    """(name), as ``names`` finds them, in one aggregation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen = set().union(*(after_prepositions(t) for lang, t in zip(b.lang, b.item_text) if not is_japanese(lang, t)))
            yield pd.DataFrame(list(seen), columns=["name", "upper"])

    seen = evals.select("lang", "item_text").mapInPandas(run, "name string, upper boolean")
    return cut(seen.groupBy("name").agg(F.min("upper").alias("only")).where("only").select("name"))


def _formed(units: DataFrame, known_names: DataFrame) -> DataFrame:
    """``units`` with their forms. Names are sent along if they are few enough, and joined to the words else."""
    if sendable(known_names, 60):
        known = frozenset(r.name for r in known_names.collect())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b.assign(forms=[[sign_form(u) if ja else word_form(u, known) for u in us] for ja, us in zip(b.ja, b.units)])

        return units.mapInPandas(run, UNITS + ", forms array<string>")
    words = units.where("not ja").select("row", F.posexplode("units").alias("at", "u")).join(shuffled(known_names.withColumn("named", F.lit(True))), F.col("u") == F.col("name"), "left")
    named = words.groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("named"), F.col("at")))).alias("named"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            forms = []
            for ja, us, at in zip(b.ja, b.units, b.named):
                at = set() if at is None else set(at)
                forms.append([sign_form(u) if ja else word_form(u, {u} if k in at else ()) for k, u in enumerate(us)])
            yield b.drop(columns="named").assign(forms=forms)

    return units.join(shuffled(named), "row", "left").select(*units.columns, "named").mapInPandas(run, UNITS + ", forms array<string>")


def _join_many(docs: DataFrame, evals: DataFrame) -> DataFrame:
    """The same by a shuffle: template windows select pairs, each pair is then checked slot by slot."""
    known = _names_of(evals)
    d, e = cut(_formed(_units(docs, "text", False), known)), cut(_formed(_units(evals, "item_text", True), known))

    def windows(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                rows = set()
                for row, ja, f in zip(b.row, b.ja, b.forms):
                    n = WINDOW_SIGNS if ja else WINDOW_WORDS
                    rows |= {(row, ("s " if ja else "w ") + " ".join(f[k : k + n])) for k in range(len(f) - n + 1)}
                yield pd.DataFrame(list(rows), columns=["row", "window"])

        return df.select("row", "ja", "forms").mapInPandas(run, "row string, window string").select("row", F.xxhash64("window").alias("window"))

    # The documents of a window are dealt to several tasks; the items' rows, the fewer, go to each.
    a = windows(d).select(F.col("row").alias("doc_row"), "window", F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    b = windows(e).select(F.col("row").alias("item_row"), "window", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    pairs = a.join(shuffled(b), ["window", "salt"]).select("doc_row", "item_row").distinct()
    for name, df in (("doc", d), ("item", e)):
        own = df.select(F.col("row").alias(f"{name}_row"), F.col("id").alias(f"{name}_id"), F.col("ja").alias(f"{name}_ja"), F.col("units").alias(f"{name}_units"), F.col("forms").alias(f"{name}_forms"))
        pairs = pairs.join(shuffled(own), f"{name}_row")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, du, df, item, iu, if_, ja in zip(b.doc_id, b.doc_units, b.doc_forms, b.item_id, b.item_units, b.item_forms, b.item_ja):
                n, whole = (WINDOW_SIGNS, _sign_run) if ja else (WINDOW_WORDS, _word_run)
                table_ = windows_of({item: list(if_)}, n)
                rows += [(doc, i, v, c) for i, (v, c) in _meet(list(du), list(df), {item: list(iu)}, table_, {f for w in table_ for f in w}, n, whole).items()]
            yield pd.DataFrame(rows, columns=_RESULT)

    return pairs.where("doc_ja = item_ja").mapInPandas(run, RESULT)


def detect(docs: DataFrame, evals: DataFrame, few_windows: int = FEW_WINDOWS) -> DataFrame:
    """(doc_id, item_id, verbatim, n_windows) of all pairs that share a template window with consistent slots."""
    docs = docs.select("doc_id", "text").where("text is not null and text != ''")
    evals = evals.select("item_id", "lang", "item_text").where("item_text is not null and item_text != ''")
    # An item has fewer windows than characters, so this bounds what is sent along.
    size = evals.agg(F.coalesce(F.sum(F.length("item_text")), F.lit(0)).alias("n")).first().n
    if size > few_windows:
        return _join_many(docs, evals)
    return _join_few(docs, Items([tuple(r) for r in evals.collect()]))


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents", "doc_id", "text", spread=True), table(spark, sf_dir, "eval_items", "item_id", "lang", "item_text"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir).where("verbatim").select("doc_id", "item_id")


def p7_reparameterised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share an item's template with other numbers, units or names, and no verbatim run."""
    return _both(spark, sf_dir).where("not verbatim").select("doc_id", "item_id", "n_windows")
