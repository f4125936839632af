"""Problem 4: sentence units across languages and scripts.

Abbreviations, collocations around a period and sentence starters are learned per language from all
texts, unsupervised, by log-likelihood ratios (Kiss and Strunk 2006): one pass counts tokens with and
without a period, the pairs that a period separates, the first words of lines and the lines that stand
alone; the counts meet in one aggregation and the ratios are computed where the counts are. Each
period is then classified with these statistics. Scripts without spaces end their sentences with marks
of their own. Quotations and brackets inside a sentence don't end it; line breaks do only after an
ended sentence, a heading or a list line, or where a line is left empty.

Defined results: null and empty texts have no units; texts of white space have none; very long texts
are split whole; a last unit that was cut off is a unit; repeated scope rows give their units once;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quellwerk.llm.common import cut, sendable, shuffled, table

#: Score of an abbreviation, and log-likelihood of a collocation and of a sentence starter (the published thresholds).
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
#: An abbreviation is followed on its line at least, and by a sentence starter at most, in these shares of its places.
FOLLOWED, STARTED = 0.5, 0.3
#: A short line counts as a heading if it stands so often, digits apart.
HEADING_LEAST, HEADING_MOST = 3, 60
#: Abbreviations, collocations and starters of all languages; they are bounded by the languages' words, not by the corpus,
#: so more would mean that something else than language was learned. Lines, which the corpus adds to, are not bounded.
MOST_ENTRIES = 500_000
#: Distinct counts that a task holds before it passes them on.
MOST_COUNTED = 200_000

_JA = re.compile("[ぁ-ゖァ-ヺ一-鿿]")
_PERIOD = re.compile(r"(\S+\.)[ \t]+([„“\"'‘(\[]*)(\S+)")
_EDGE = "\"'“”„‘’«»()[]（）「」,;:!?"
_MONTHS = frozenset("Januar Februar März April Mai Juni Juli August September Oktober November Dezember January February March May June July October December".split())
_NUMBERING = re.compile(r"\s*(?:\(?(?:\d{1,3}|[IVXLC]{1,5}|[A-Za-z])[.)]|[-–•*・])(?=\s|$)")


def language(text: str) -> str:
    """ja by its script; else de or en by letters and words of German."""
    sample = text
    if len(_JA.findall(sample)) * 4 > len(sample):
        return "ja"
    return "de" if re.search(r"[äöüßÄÖÜ§]|\b(?:der|die|und|nicht)\b", sample) else "en"


def _bare(token: str) -> str:
    t = token.strip(_EDGE)
    return re.sub(r"\d+", "0", t[:-1] if t.endswith(".") else t)


def count(text: str, lang: str, counts: Counter) -> None:
    for line in text.split("\n"):
        s = line.strip()
        if s and len(s) <= HEADING_MOST and not s.endswith(("。", "．", "？")) and (lang == "ja" or not s.endswith((".", "?")) or len(s) < 6):
            counts[lang, "line", re.sub(r"\d+", "0", s), ""] += 1
        if s and lang != "ja":
            counts[lang, "first", _bare(s.split(None, 1)[0]), ""] += 1
    if lang == "ja":
        return
    for t, n in Counter(text.split()).items():
        b = _bare(t)
        if b:
            counts[lang, "dotted" if t.strip(_EDGE).endswith(".") else "plain", b.lower(), ""] += n
            counts[lang, "word", b, ""] += n
    for m in _PERIOD.finditer(text):
        counts[lang, "pair", _bare(m[1]).lower(), _bare(m[3])] += 1


COUNTS = "lang string, kind string, a string, b string, n long"


def count_all(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        names = ["lang", "kind", "a", "b", "n"]
        for b in batches:
            for t in b.text:
                count(t, language(t), counts)
            if len(counts) > MOST_COUNTED:
                yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=names)
                counts.clear()
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=names)

    return texts.select("text").mapInPandas(run, COUNTS).groupBy("lang", "kind", "a", "b").agg(F.sum("n").alias("n"))


def _xlogy(x: Column, p: Column) -> Column:
    return F.when(x > 0, x * F.log(F.greatest(p, F.lit(1e-12)))).otherwise(0.0)


def _likelihood(k: Column, n: Column, p: Column) -> Column:
    return _xlogy(k, p) + _xlogy(n - k, 1 - p)


def ratio(n_a: Column, n_b: Column, n_ab: Column, n: Column) -> Column:
    """Dunning's -2 log lambda for b after a, of n tokens."""
    a, b, ab = n_a.cast("double"), n_b.cast("double"), n_ab.cast("double")
    rest = F.greatest(n - a, F.lit(1.0))
    p, p1, p2 = b / n, ab / F.greatest(a, F.lit(1.0)), F.greatest(b - ab, F.lit(0.0)) / rest
    return -2 * (_likelihood(ab, a, p) + _likelihood(F.greatest(b - ab, F.lit(0.0)), rest, p) - _likelihood(ab, a, p1) - _likelihood(F.greatest(b - ab, F.lit(0.0)), rest, p2))


def starters(counts: DataFrame, total: DataFrame) -> DataFrame:
    """(lang, b): capitalised words that open lines far more often than chance."""
    word = counts.where("kind = 'word'").select("lang", F.col("a").alias("b"), F.col("n").alias("n_b"))
    first = counts.where("kind = 'first'")
    lines = F.broadcast(first.groupBy("lang").agg(F.sum("n").alias("n_lines")))  # one row a language
    both = first.select("lang", F.col("a").alias("b"), F.col("n").alias("n_first")).join(word, ["lang", "b"]).join(total, "lang").join(lines, "lang").where("b rlike '^\\\\p{Lu}'")
    llr = ratio(F.col("n_lines"), F.col("n_b"), F.col("n_first"), F.col("n_all"))
    return both.where((llr >= STARTER) & (F.col("n_first") * F.col("n_all") > F.col("n_lines").cast("double") * F.col("n_b"))).select("lang", "b")


def learn(counts: DataFrame) -> tuple[dict, DataFrame]:
    """The model of all languages, from the counts, and (lang, line): lines that stand alone often, digits alike."""
    counts = cut(counts)

    def kind(k: str, a: str, n: str, *more) -> DataFrame:
        return counts.where(F.col("kind") == k).select("lang", F.col("a").alias(a), *more, F.col("n").alias(n))

    total = counts.where("kind in ('dotted', 'plain')").groupBy("lang").agg(F.sum("n").cast("double").alias("n_all"), F.sum(F.when(F.col("kind") == "dotted", F.col("n")).otherwise(0)).cast("double").alias("n_dots"))
    total = F.broadcast(total)  # one row a language
    # Abbreviations: how much more often the type takes a period than chance, corrected for length, inner periods and use without.
    dotted, plain = kind("dotted", "w", "n_dot"), kind("plain", "w", "n_plain")
    abbr = dotted.join(plain, ["lang", "w"], "left").fillna(0, ["n_plain"]).join(total, "lang")
    size = F.length(F.regexp_replace("w", "\\.", "")).cast("double")
    llr = -2 * (_likelihood(F.col("n_dot").cast("double"), (F.col("n_dot") + F.col("n_plain")).cast("double"), F.col("n_dots") / F.col("n_all")) - _likelihood(F.col("n_dot").cast("double"), (F.col("n_dot") + F.col("n_plain")).cast("double"), F.lit(0.99)))
    inner = F.length("w") - F.length(F.regexp_replace("w", "\\.", "")) + 1
    score = llr * F.exp(-size) * inner * F.pow(size, -F.col("n_plain").cast("double"))
    abbr = abbr.where("w rlike '^[\\\\p{L}.]+$'").withColumn("score", F.when(F.col("n_plain") > 8, 0.0).otherwise(score)).where(F.col("score") >= ABBREVIATION)
    # The score grows with the corpus; words that only ever end sentences are told apart by what follows them on their line.
    starts = starters(counts, total)
    follow = kind("pair", "w", "n_ab", F.col("b").alias("b")).join(starts.select("lang", "b", F.lit(1).alias("starts")), ["lang", "b"], "left")
    follow = follow.groupBy("lang", "w").agg(F.sum("n_ab").alias("n_follow"), F.sum(F.when(F.col("starts") == 1, F.col("n_ab")).otherwise(0)).alias("n_starts"))
    abbr = abbr.join(follow, ["lang", "w"]).where(f"n_follow >= {FOLLOWED} * n_dot and n_starts <= {STARTED} * n_follow")
    # Pairs around a period: collocations hold together; starters follow periods of plain words too often to be chance.
    pair, word = kind("pair", "a", "n_ab", "b"), kind("word", "b", "n_b")
    both = pair.join(dotted.select("lang", F.col("w").alias("a"), F.col("n_dot").alias("n_a")), ["lang", "a"]).join(word, ["lang", "b"]).join(total, "lang")
    close = both.withColumn("llr", ratio(F.col("n_a"), F.col("n_b"), F.col("n_ab"), F.col("n_all"))).where((F.col("llr") >= COLLOCATION) & (F.col("n_ab") * F.col("n_all") > F.col("n_a").cast("double") * F.col("n_b")))
    close = close.where("a rlike '^0$' or length(a) = 1 or b rlike '^0' and 2 * n_ab >= n_a")
    lines = cut(kind("line", "line", "n").where(F.col("n") >= HEADING_LEAST).select("lang", "line"))
    parts = {
        "abbreviation": abbr.select("lang", F.col("w").alias("a"), F.lit("").alias("b")),
        "collocation": close.select("lang", "a", "b"),
        "starter": starts.select("lang", F.col("b").alias("a"), F.lit("").alias("b")),
    }
    model = None
    for name, df in parts.items():
        df = df.withColumn("kind", F.lit(name))
        model = df if model is None else model.unionByName(df)
    rows = model.limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError("the sentence model has more than %d entries" % MOST_ENTRIES)
    out = {(lang, k): set() for lang in ("de", "en", "ja") for k in (*parts, "line")}
    for r in rows:
        out[r.lang, r.kind].add((r.a, r.b) if r.b else r.a)
    return out, lines


def with_lines(model: dict, lines) -> dict:
    """The model with these (lang, line)."""
    out = {k: v if k[1] != "line" else set() for k, v in model.items()}
    for lang, line in lines:
        out[lang, "line"].add(line)
    return out


_AFTER_UNIT = re.compile("(?<=[。．？！?!.…”“\"’»)）」』])")


def asked_lines(text: str) -> set[str]:
    """All lines, or ends of lines after a unit's end, that a splitter may look up."""
    out = set()
    for line in text.split("\n"):
        for a in (0, *(m.start() for m in _AFTER_UNIT.finditer(line))):
            s = re.sub(r"\d+", "0", line[a:].strip())
            if s and len(s) <= HEADING_MOST:
                out.add(s)
    return out


_OPEN, _CLOSE = "„“「『（(【[", "“”」』）)】]"
_PARTNER = {"„": "“”", "“": "”", "「": "」", "『": "』", "（": "）", "(": ")", "【": "】", "[": "]"}
_STOPS = "。．？！?!"


def _depths(text: str, start: int, end: int, last: bool) -> list[bool]:
    """For each position of a paragraph, whether it is inside a quotation or bracket (its marks included)."""
    inside = [False] * (end - start)
    stack: list[tuple[str, int]] = []
    quote = -1
    for i in range(start, end):
        c = text[i]
        if c == '"':
            if quote < 0:
                quote = i
            else:
                for j in range(quote, i):
                    inside[j - start] = True
                quote = -1
        elif stack and c in _PARTNER[stack[-1][0]]:
            _, at = stack.pop()
            if not stack:
                for j in range(at, i):
                    inside[j - start] = True
        elif c in _PARTNER and (c != "“" or not stack):
            if c == "“" and not any(x in text[i:end] for x in "”"):
                continue
            stack.append((c, i))
    # What was opened and never closed counts only at the end of a text, which was then cut off.
    if last:
        at = stack[0][1] if stack else quote
        if at >= 0:
            for j in range(at, end):
                inside[j - start] = True
    return inside


class Splitter:
    def __init__(self, model: dict):
        self.model = model

    def units(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of each unit in code points."""
        lang = language(text)
        out: list[tuple[int, int]] = []
        blocks = [m.span() for m in re.finditer(r"(?:[^\n]|\n(?!\s*\n))+", text)]
        for k, (a, b) in enumerate(blocks):
            out += self._block(text, a, b, lang, k == len(blocks) - 1)
        found = []
        for a, b in out:
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if a < b:
                found.append((a, b))
        return found

    def _block(self, text: str, a: int, b: int, lang: str, last: bool) -> list[tuple[int, int]]:
        inside = _depths(text, a, b, last)
        ends = []
        start = a
        marks = re.compile("[\\n" + _STOPS + ".]")
        i = a
        while m := marks.search(text, i, b):
            i = m.end()
            p = m.start()
            c = text[p]
            if p < start:
                continue
            if c == "\n":
                if self._line_ends(text, start, p, b, lang) and not (inside[p - a] and not self._ended(text[start:p])):
                    ends.append(p)
                    start = p + 1
                continue
            after = p + 1
            while after < b and text[after] in _STOPS + ".…":
                after += 1
            closes = after < b and text[after] in "”“\"’»" and not inside[after - a]
            if inside[p - a] and not (closes and lang != "ja"):
                # A sentence that stands in brackets by itself ends with its bracket.
                q = p + 1
                if q < b and text[q] in "）)" and text[start:p].lstrip()[:1] in ("（", "(") and not (q + 1 < b and inside[q + 1 - a]) and self._alone(text, start, q):
                    ends.append(q + 1)
                    start = i = q + 1
                continue
            q = p + 1
            while q < b and text[q] in _STOPS + ".…":
                q += 1
            while q < b and text[q] in "”“\"’»)）」』":
                if inside[q - a]:
                    break
                q += 1
            if self._stop(text, start, p, q, b, lang):
                ends.append(q)
                start = i = q
        ends.append(b)
        return list(zip([a, *ends[:-1]], ends))

    @staticmethod
    def _alone(text: str, start: int, q: int) -> bool:
        """Whether the bracket that closes at q was opened at the start of the unit."""
        s = text[start : q + 1].lstrip()
        depth = 0
        for k, c in enumerate(s):
            depth += c in "（("
            depth -= c in "）)"
            if depth == 0:
                return k == len(s) - 1
        return False

    @staticmethod
    def _ended(s: str) -> bool:
        return bool(re.search("[。．？！?!.][”“\"’»)）」』]*\\s*$", s))

    def _line_ends(self, text: str, start: int, p: int, b: int, lang: str) -> bool:
        """Whether the unit from start ends at the line break p."""
        here = text[start:p].strip()
        if not here:
            return True
        rest = text[p + 1 : b].lstrip()
        if not rest:
            return True
        if self._ended(here):
            if lang == "ja" or _NUMBERING.match(rest):
                return True
            word = _bare(here.split()[-1]).lower()
            if here.endswith(".") and (word in self.model[lang, "abbreviation"] or len(word) == 1) and (rest[0].islower() or rest[0] in "§(" or rest[0].isdigit() or rest.split()[0][:1].isupper() and not self._starter(rest, lang)):
                return bool(re.fullmatch(_NUMBERING.pattern, here))
            return True
        if "\n" in here:
            return False
        line = re.sub(r"\d+", "0", here)
        if _NUMBERING.match(rest) and len(here) <= HEADING_MOST and not here.endswith((",", "，", "、")) and line in self.model[lang, "line"]:
            return True
        if lang == "ja":
            if re.fullmatch(r"第?[0-9０-９]+\s+\S[^、，。．（]{0,24}|【[^】]*】|主\s*文|理\s*由|事\s*実(?:及び理由)?", here):
                return True
            return rest[0] not in "（(、，。" and len(here) <= 20 and not re.search("[、，]", here) and line in self.model[lang, "line"]
        if rest[0].islower() or rest[0] in "§(,;":
            return False
        if line in self.model[lang, "line"] and len(here.split()) <= 7:
            return True
        return bool(_NUMBERING.match(here)) and len(here.split()) <= 5 and self._starter(rest, lang)

    def _starter(self, rest: str, lang: str) -> bool:
        w = rest.lstrip("„“\"'(").split(None, 1)[:1]
        if not w or re.fullmatch("[^\\W\\d_]\\.", w[0]):  # nothing, or an initial
            return False
        return _bare(w[0]) in self.model[lang, "starter"]

    def _stop(self, text: str, start: int, p: int, q: int, b: int, lang: str) -> bool:
        """Whether the mark at p, which reaches to q with what closes after it, ends the unit from start."""
        c, follows = text[p], text[q:b]
        if lang == "ja" and c in "。．？！":
            if c == "．" and p and text[p - 1].isdigit() and follows[:1].isdigit():
                return False
            return True
        if not follows.strip():
            return False
        if not follows[0].isspace():
            # No space at all: only between a plain word and a sentence starter.
            return c in ".?!" and p >= 2 and (q > p + 1 or text[p - 2 : p].isalnum()) and (follows[0].isupper() or follows[0] == "„") and self._starter(follows, lang)
        rest = follows.lstrip()
        if c in "?!？！。．":
            return not rest[0].islower()
        token = text[text.rfind(" ", start, p) + 1 if text.rfind(" ", start, p) >= 0 else start : p + 1].split()
        token = token[-1] if token else "."
        before = text[start:p].strip()
        word = _bare(token).lower()
        if rest[0].islower() or rest[0] in ",;":
            return False
        # A number or letter that opens the line belongs to its unit.
        if _NUMBERING.fullmatch(before + "."):
            return False
        nxt = rest.lstrip("„“\"'‘([").split()
        nxt = _bare(nxt[0]) if nxt else ""
        closed = q > p + 1
        if not closed:
            if token.strip(_EDGE)[:-1].isdigit() and len(token.strip(_EDGE)) <= 3 and nxt in _MONTHS:
                return False
            if (word, nxt) in self.model[lang, "collocation"] and nxt not in self.model[lang, "starter"]:
                return False
            if word in self.model[lang, "abbreviation"] or len(word) == 1 and word.isalpha():
                return rest[0] not in "§(" and not rest[0].isdigit() and self._starter(rest, lang)
        return True


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = None
    for name in ("jp_case_detail", "de_case_detail", "parsed_document"):
        df = table(spark, sf_dir, name, "rec_id", "full_text", spread=True).select(F.lit(name).alias("table_name"), "rec_id", F.col("full_text").alias("text"))
        parts = df if parts is None else parts.unionByName(df)
    return parts.where("text is not null and text != ''")


def split(rows: DataFrame, learned: tuple[dict, DataFrame]) -> DataFrame:
    """(table_name, rec_id, start_pos, end_pos) of rows(table_name, rec_id, text).

    Known lines go to every task with the rest of the model, by a check of their size; more are joined to the texts that
    ask for them.
    """
    model, lines = learned
    few = sendable(lines, 60)
    if few:
        model = with_lines(model, lines.collect())
        rows = rows.withColumn("lines", F.lit(None).cast("array<string>"))
    else:

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [(t, i, language(x), line) for t, i, x in zip(b.table_name, b.rec_id, b.text) for line in asked_lines(x)]
                yield pd.DataFrame(out, columns=["table_name", "rec_id", "lang", "line"])

        asked = rows.select("table_name", "rec_id", "text").mapInPandas(ask, "table_name string, rec_id long, lang string, line string")
        own = asked.join(shuffled(lines), ["lang", "line"]).groupBy("table_name", "rec_id").agg(F.collect_set("line").alias("lines"))
        rows = rows.join(shuffled(own), ["table_name", "rec_id"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(model)
        for b in batches:
            out = []
            for t, i, x, own in zip(b.table_name, b.rec_id, b.text, b.lines):
                if not few:
                    splitter = Splitter(with_lines(model, [(language(x), line) for line in (() if own is None else own)]))
                out += [(t, i, *u) for u in splitter.units(x)]
            yield pd.DataFrame(out, columns=["table_name", "rec_id", "start_pos", "end_pos"])

    return rows.select("table_name", "rec_id", "text", "lines").mapInPandas(run, "table_name string, rec_id long, start_pos long, end_pos long")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_texts = texts(spark, sf_dir)
    scope = table(spark, sf_dir, "sentence_scope", "table_name", "rec_id").distinct()
    return split(all_texts.join(scope, ["table_name", "rec_id"], "left_semi"), learn(count_all(all_texts)))


def p4_units_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence units of every document, as counts and mean lengths by table."""
    all_texts = texts(spark, sf_dir)
    units = split(all_texts, learn(count_all(all_texts)))
    return units.groupBy("table_name").agg(F.count("*").alias("n_units"), F.countDistinct("rec_id").alias("n_texts"), F.round(F.avg(F.col("end_pos") - F.col("start_pos")), 2).alias("mean_chars"))
