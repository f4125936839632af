"""Problem 8: text statistics per document, and which documents are not natural prose.

Lines that belong to a table or list are found by structure: delimiters that stand as often and,
in fixed columns, at the same place in line after line; and, in runs of lines without any sentence end
that don't go on from each other, indentation and markers that return with a period, line lengths that
do (autocorrelation), or many digits and symbols. What is left is
read as sentences; a sentence runs if it has words enough, common words of its language enough (ja:
places and characters that common particles and endings cover) and few symbols inside words. A document
is prose if running sentences hold most of its characters; a sentence that comes back again and again
holds none.

Everything is computed row by row in one pass without a shuffle. Defined results: a null text has
null statistics and is no case; an empty one has zeros and is no case; long texts are read whole;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from quellwerk.llm.common import table

#: A document is prose if not most of its characters stand outside running sentences.
PROSE_SHARE = 0.5
#: So often may a sentence stand in a text before further repeats stop counting.
REPEATS = 2
#: Lines without a sentence end that follow each other are entries from so many on, if no larger share of them begins
#: in lower case, and their shapes agree with a period or so large a share of their characters are digits and symbols.
ENTRIES, GOES_ON, PERIODIC, ODD_SHARE = 5, 0.2, 0.8, 0.3
#: Lags, in lines, of a period.
PERIODS = (1, 2, 3)
#: A Japanese sentence holds so many common particles and endings, and so large a share of its letters is theirs.
COMMON_JA, COMMON_JA_SHARE = 2, 0.1
#: The table of common words is a fixed reference list; more rows than this are refused.
MOST_COMMON_WORDS = 10_000

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_JA = re.compile("[ぁ-ゖァ-ヺー一-鿿々]")
_JA_RUN = re.compile("[ぁ-ゖァ-ヺー一-鿿々]+")
_DIGITS = re.compile(r"\d+")
_MARKER = re.compile(r"\s*(?:[-–—*•·・»>▪◦‣+]\s*|\(?\d{1,4}[.):]\s+|\d{1,4}\s+[-–]\s+|[a-z]\)\s+|[①-⑳]\s*)")
_LEADER = re.compile(r"(?:\.\s?){4,}|…{2,}|_{4,}|-{4,}|={4,}")
_PAIR = re.compile(r"\s*[^:：\n]{1,40}[:：]\s*\S[^\n]{0,40}$")
_TERMINAL = frozenset(".?!。．？！:：;")
_END_JA = re.compile("(?<=[。．？！])(?![」』）])|(?<=[.?!])\\s+(?=[A-ZÄÖÜ„\"“(])")
_END = re.compile("(?<=[.?!])[\"“”»)]*\\s+(?=[A-ZÄÖÜ„\"“(])")
_CLEAN = re.compile(r"[\"'“”„‘’«»(（\[「『【]*(?:[^\W\d_]+(?:['’./&-][^\W\d_]+)*|[§$€£]*[\d.,:/%–-]+[^\W\d_]{0,4}|[^\W\d_]{1,4}[\d]+|§+|&|–|—|[^\W\d_]+-)[\"'“”‘’«»)）\]」』】.,;:?!%…]*$")
_GAP = re.compile(r"\S\s{2,}(?=\S)")
_SIGNS = re.compile(r"[^\w\s、。，．「」『』（）・【】％%().,–:：〜？！-]+")
_EDGES = "\"'“”„‘’«»()[]（）「」『』【】.,;:?!%…"
_DELIMITERS = "|\t;,／/»>"


def _solid(s: str) -> int:
    """Characters that aren't white space."""
    return sum(map(len, s.split()))


def _held(pattern: re.Pattern, s: str) -> int:
    """Characters of all matches."""
    return sum(map(len, pattern.findall(s)))


class Words:
    """Common words: a set a language; of Japanese, which has no spaces, a pattern that takes the longest first."""

    def __init__(self, by_language: dict[str, frozenset]):
        self.sets = [v for k, v in by_language.items() if k != "ja"]
        ja = sorted(by_language.get("ja", ()), key=lambda w: (-len(w), w))
        self.ja = re.compile("|".join(map(re.escape, ja)) or "(?!)")

    def most(self, lower: list[str]) -> int:
        return max((sum(map(v.__contains__, lower)) for v in self.sets), default=0)


def _ends(line: str) -> bool:
    """Whether a line ends with a sentence mark, closing marks apart."""
    return line.rstrip().rstrip("\"'“”’»)）」』]")[-1:] in _TERMINAL


def aligned(lines: list[str]) -> np.ndarray:
    """Lines whose delimiters stand as in the lines around them: same number of one delimiter, or gaps of spaces at the same places."""
    n = len(lines)
    hit = np.zeros(n, bool)
    if n < 3:
        return hit
    text = "\n".join(lines)
    for d in _DELIMITERS:
        if text.count(d) < 3:
            continue
        count = np.array([x.count(d) for x in lines])
        least = 2 if d in ",/" else 1
        # The cells of a table are short; commas of prose stand between clauses.
        short = np.array([c >= least and max(map(len, x.split(d))) <= 32 for x, c in zip(lines, count)])
        same = short & (count >= least)
        run = same[1:] & same[:-1] & (count[1:] == count[:-1])
        three = run[1:] & run[:-1]
        for k in range(3):
            hit[k : k + len(three)] |= three
        # Ragged rows of a table: many cells each, though not as many in each.
        many = short & (count >= 3)
        if many.sum() >= 3 and many.mean() > 0.6:
            hit |= many
    if "  " not in text:
        return hit
    gaps = [{m.end() for m in _GAP.finditer(x)} if "  " in x else set() for x in lines]
    for i in range(1, n):
        both = gaps[i] & gaps[i - 1]
        if len(both) >= 1 and len(both) >= 0.5 * min(len(gaps[i]), len(gaps[i - 1])):
            hit[i] = hit[i - 1] = True
    return hit


def _shapes(lines: list[str]) -> list[str]:
    """The marker of each line, digits apart, or else its indentation."""
    return [re.sub(r"\d+", "0", m[0]) if (m := _MARKER.match(x)) else " " * (len(x) - len(x.lstrip())) for x in lines]


def periodicity(lines: list[str]) -> float:
    """Share of lines that take up the indentation or marker of the line one, two or three before: the best of the periods."""
    shape = _shapes(lines)
    marked = [s != "" for s in shape]
    best = 0.0
    for p in PERIODS:
        if len(shape) > p:
            best = max(best, sum(a == b and m for a, b, m in zip(shape[p:], shape, marked[p:])) / (len(shape) - p))
    return best


def length_steadiness(lines: list[str]) -> float:
    """Autocorrelation of line lengths about their mean, the best of the periods; 1 if all are of one length, 0 for fewer than four lines."""
    x = np.array([len(v.rstrip()) for v in lines], float)
    if len(x) < 4:
        return 0.0
    x -= x.mean()
    var = float(x @ x)
    if var < 1e-9:
        return 1.0
    return max(0.0, *(float(x[p:] @ x[:-p]) / var for p in PERIODS))


def _wrapped(run: list[str]) -> bool:
    """Whether the lines are broken at a width: the first word of the next line had no room on nearly any of them."""
    width = max(len(x.rstrip()) for x in run)
    full = sum(len(a.rstrip()) + 1 + len((b.split()[0] if not _JA.match(b.lstrip()) else b.lstrip()[:2])) > width for a, b in zip(run, run[1:]))
    return full >= PERIODIC * (len(run) - 1)


def _are_entries(run: list[str]) -> bool:
    """Whether lines without a sentence end are entries of a list or log, by period, length or ratios."""
    n = len(run)
    if sum(x.lstrip()[:1].islower() for x in run[1:]) > GOES_ON * (n - 1):
        return False
    whole = "".join("".join(run).split())
    if sum(not c.isalpha() for c in whole) >= ODD_SHARE * len(whole):
        return True
    wrapped = _wrapped(run)
    if not wrapped:
        shape = _shapes(run)
        for p in PERIODS:
            if n >= ENTRIES + p - 1 and any(shape[-p:]) and sum(map(str.__eq__, shape[p:], shape)) >= PERIODIC * (n - p):
                return True
    # Lengths of unrelated lines agree by chance within two standard errors; Japanese prose broken at a width has one length.
    return not (wrapped and _JA.search(whole)) and length_steadiness(run) >= max(0.5, 2 / n**0.5)


def entries(lines: list[str], taken: np.ndarray, ends: re.Pattern) -> np.ndarray:
    """Lines of runs that are entries of a list or log; ``taken`` lines belong to a table or list already."""
    hit = np.zeros(len(lines), bool)

    def runs(stops: Iterable[bool], start: int) -> Iterator[tuple[int, int]]:
        for i, stop in enumerate((*stops, True), start):
            if stop:
                if i - start >= ENTRIES:
                    yield start, i
                start = i + 1

    # The ends of lines are cheap to see; what stands inside them is looked at only in runs that are long enough.
    for a, b in runs((t or _ends(x) for t, x in zip(taken.tolist(), lines)), 0):
        for c, d in runs((ends.search(x.strip()) is not None for x in lines[a:b]), a):
            if _are_entries(lines[c:d]):
                hit[c:d] = True
    return hit


def _runs(sentence: str, words: Words) -> bool:
    """Whether a sentence is running text."""
    if not sentence.isascii():
        ja = _held(_JA_RUN, sentence)
        if ja:
            solid = _solid(sentence)
            if ja * 3 > solid:
                common = words.ja.findall(sentence)
                return solid >= 8 and len(common) >= COMMON_JA and sum(map(len, common)) >= COMMON_JA_SHARE * ja and _held(_SIGNS, sentence) <= 0.1 * solid
    tokens = sentence.lower().split()
    if len(tokens) < 3:
        return False
    tokens = [t if t.isalpha() else t.strip(_EDGES) for t in tokens]
    plain = list(filter(str.isalpha, tokens))
    if len(plain) < 3 or words.most(plain) < max(1, 0.08 * len(plain)):
        return False
    # Numbers, hyphens and the like are looked at only where they could decide.
    odd = len(tokens) - len(plain)
    if odd > 0.25 * len(tokens):
        odd -= sum(bool(_CLEAN.match(t)) for t in tokens if not t.isalpha())
    return odd <= 0.25 * len(tokens)


def _goes_on(lines: list[str], i: int, body: str, words: Words) -> bool:
    """Whether an item's sentence runs on over the next lines, up to its end."""
    if _ends(body) or i + 1 == len(lines):
        return False
    ja = bool(_JA.search(body))
    # A short item followed by a new sentence is an item; one broken at a width, or within a clause, goes on.
    if not (lines[i + 1].lstrip()[:1].islower() or lines[i + 1].lstrip()[:1].isdigit() or len(lines[i]) >= (20 if ja else 40)):
        return False
    for x in lines[i + 1 : i + 5]:
        if (m := _MARKER.match(x)) and m[0].strip():
            return False
        body += ("" if ja else " ") + x.strip()
        if _ends(x):
            return _runs(body, words)
    return False


def prose_share(text: str, words: Words) -> tuple[float, float, float]:
    """(share of the characters in running sentences, share of the lines in tables and lists, of aligned lines)."""
    lines = [x for x in text.split("\n") if x.strip()]
    total = _solid(text)
    if not total:
        return 0.0, 0.0, 0.0
    table_line = aligned(lines)
    structured = np.zeros(len(lines), bool)
    leaders = _LEADER.search(text) is not None if any(x in text for x in ("..", ". .", "…", "__", "--", "==")) else False
    for i, x in enumerate(lines):
        item = _MARKER.match(x)
        if table_line[i]:
            structured[i] = not (_ends(x) and _runs(x, words))
        elif leaders and _LEADER.search(x):
            structured[i] = True
        elif item:
            body = x[item.end() :]
            structured[i] = not ((len(body) > 60 or _ends(body)) and _runs(body, words)) and not _goes_on(lines, i, body, words)
        elif len(x) <= 90 and _PAIR.match(x):
            structured[i] = not _runs(x, words)
    # Short lines without sentence marks one after the other: cells or names line by line.
    plain = [not structured[i] and len(x) <= 30 and not _ends(x) and not _runs(x, words) for i, x in enumerate(lines)]
    for i in range(len(lines)):
        if plain[i] and sum(plain[max(0, i - 2) : i + 3]) >= 4:
            structured[i] = True
    ja = bool(_JA.search(text))
    ends = _END_JA if ja else _END
    if len(lines) - structured.sum() >= ENTRIES:
        structured |= entries(lines, structured, ends)
    seen: Counter = Counter()
    mass, run = 0, []

    def flush() -> int:
        got, joined = 0, ""
        for x in run:
            # A line goes on from the last one unless that ended.
            joined += ("" if ja and joined[-1:] and _JA.match(joined[-1]) else " ") + x.strip() if joined and not _ends(joined) else "\n" + x.strip()
        for part in joined.split("\n"):
            for s in ends.split(part):
                if s and _runs(s, words):
                    key = _DIGITS.sub("0", s.strip().lower())
                    seen[key] += 1
                    if seen[key] <= REPEATS:
                        got += _solid(s)
        return got

    for x, s in zip(lines, structured):
        if s:
            mass += flush()
            run = []
        else:
            run.append(x)
    mass += flush()
    return mass / total, float(structured.mean()), float(table_line.mean())


RESULT = (
    "doc_id long, n_words long, mean_word_length double, symbol_ratio double, line_end_ratio double, common_word_ratio double, digit_ratio double, "
    "aligned_ratio double, period_ratio double, length_steadiness double, structured_ratio double, prose_share double, is_prose boolean"
)
_NAMES = [x.split()[0] for x in RESULT.split(", ")]


def statistics(text: str, words: Words) -> tuple:
    lines = [x for x in text.split("\n") if x.strip()]
    w = _WORD.findall(text.lower())
    ja = 0 if text.isascii() else _held(_JA_RUN, text)
    solid = max(1, _solid(text))
    n_words = len(w)
    if ja * 3 > solid:
        # Without spaces a word has no end to see: the share of the letters that common particles and endings cover.
        common = _held(words.ja, text) / max(1, ja)
    else:
        common = words.most(w) / max(1, n_words)
    letters, digits = sum(map(len, w)), _held(_DIGITS, text)
    share, structured, in_columns = prose_share(text, words)
    return (
        n_words, letters / max(1, n_words), max(0, solid - letters - digits) / solid, sum(_ends(x) for x in lines) / max(1, len(lines)), common, digits / solid,
        in_columns, periodicity(lines), length_steadiness(lines), structured, share, not lines or share >= PROSE_SHARE,
    )


def common_words(spark: SparkSession, sf_dir: str) -> Words:
    rows = table(spark, sf_dir, "common_words", "lang", "word").where("lang is not null and word is not null").limit(MOST_COMMON_WORDS + 1).collect()
    if len(rows) > MOST_COMMON_WORDS:
        raise ValueError("common_words is a reference list of at most %d rows" % MOST_COMMON_WORDS)
    return Words({k: frozenset(r.word.lower() for r in rows if r.lang == k) for k in {r.lang for r in rows}})


def measure(docs: DataFrame, words: Words) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *((None,) * (len(_NAMES) - 1) if t is None else statistics(t, words))) for i, t in zip(b.doc_id, b.text)]
            yield pd.DataFrame(rows, columns=_NAMES)

    return docs.select("doc_id", "text").mapInPandas(run, RESULT)


def p8_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(table(spark, sf_dir, "documents", "doc_id", "text", spread=True), common_words(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_statistics(spark, sf_dir).where("not is_prose").select("doc_id")
