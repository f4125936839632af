"""Problem 2: text decoded with the wrong character encoding.

A hidden Markov model labels every character: one clean state and one state per encoding pair
``written as -> read as``; pairs that also garble Western letters have one for these, too. Emissions are
learned here, from clean texts of the input (``TRAIN_ROWS`` of each table, chosen by hash) which are
garbled by each pair; the characters that count as known are those of all clean texts. Each labelled span
gets the inverse transform of its state; where that doesn't read as text, those of the other states in
the order of their likelihood for the span. A span counts if its inverse reads as text again; the
replacement character, which no inverse can undo, counts on its own. Bytes that aren't UTF-8 are read as
Western first and go through the same model.

Texts without any character that garbling can leave behind have no other than the clean path, so
only the rest go through the model. (That pattern runs beside the model: its classes of far-apart
ranges cost the JVM's matcher ten times as much as the transfer of the texts.)

Defined results: null and empty texts have no span; very long texts are labelled whole; repeated
rows each give a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quellwerk.llm.common import table

#: Rows of each table from which the emissions are learned; a bound, whatever the input's size.
TRAIN_ROWS = 300
#: A kanji is known if it stands in so many clean texts.
KNOWN_TEXTS = 2
#: Probability of leaving a state at a character.
SWITCH = 1e-3
#: Characters of all texts that are labelled side by side.
BLOCK_CHARS = 400_000

_TYPOGRAPHIC = "–—„“”’‘…•€"
_WESTERN = "äöüÄÖÜßé§"
_CP1252_REST = "ŒœŠšŽžŸƒˆ˜‚†‡‰‹›™"
_MAC_REST = "√∏∑π∫∂Ω≈∆◊˘˙˚˝˛ˇıﬁﬂ⁄∞≤≥≠ÅÊÁËÈÍÎÏÌÓÔÒÚÛÙ"
#: Everything that a pair can leave behind: Latin letters and signs of the upper half, controls,
#: half-width kana, private use, the replacement character, escape runs, and the kanji that lead kana read as Shift-JIS.
SUSPICIOUS = (
    "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f\\u00a1-\\u00a6\\u00a8-\\u00ac\\u00ae\\u00af\\u00b1-\\u00b6\\u00b8-\\u00c3\\u00c5-\\u00d5\\u00d7-\\u00db\\u00dd\\u00de"
    "\\u00e0-\\u00e3\\u00e5-\\u00e8\\u00ea-\\u00f5\\u00f7-\\u00fb\\u00fd-\\u02ff\\u201a\\u2020\\u2021\\u2030\\u2039\\u203a\\u2122\\u2202\\u220f\\u2211\\u221a\\u221e\\u222b\\u2248\\u2260\\u2264\\u2265\\u25ca"
    "\\ue000-\\uf8ff\\ufb01\\ufb02\\uff61-\\uff9f\\ufffd縺繧繝縲]|\\$[B@][!-~]{2}"
)
#: The same without an escape of the pattern language, for Python.
_SUSPICIOUS_PY = re.compile(SUSPICIOUS)
_ESCAPE_RUN = re.compile("\x1b?\\$[B@]([!-~]{2,}?)(?:\x1b?\\([BJ]|(?=[^!-~])|$)")

_CLASSES = 27


def _class_table() -> np.ndarray:
    t = np.full(0x10000, 23, np.uint8)
    for a, b, k in (
        (0x00, 0x1F, 4), (0x20, 0x7E, 3), (0x30, 0x39, 1), (0x41, 0x5A, 2), (0x61, 0x7A, 2), (0x7F, 0x7F, 4), (0x80, 0x9F, 5), (0xA0, 0xBF, 6), (0xC0, 0xDE, 7), (0xDF, 0xFF, 8),
        (0x100, 0x24F, 8), (0x370, 0x52F, 22), (0x3000, 0x303F, 15), (0x3041, 0x309F, 13), (0x30A0, 0x30FF, 14), (0x3400, 0x9FFF, 17), (0xE000, 0xF8FF, 21), (0xFF01, 0xFF60, 15), (0xFF61, 0xFF65, 19), (0xFF66, 0xFF9F, 18),
    ):
        t[a : b + 1] = k
    for chars, k in ((_MAC_REST, 12), (_CP1252_REST, 10), (_TYPOGRAPHIC, 11), (_WESTERN, 9), ("\n\t\r ", 0), ("�", 20), ("\xa0\xad", 26)):
        for c in chars:
            t[ord(c)] = k
    return t


_C1252 = {b: c for b in range(0x80, 0xA0) if (c := bytes([b]).decode("cp1252", "ignore"))}
_TO_C1252 = {ord(c): b for b, c in _C1252.items()}


def _western_bytes(s: str) -> bytes:
    """Bytes of a text read as Windows-1252 or Latin-1; characters of neither are dropped."""
    return s.translate(_TO_C1252).encode("latin-1", "ignore")


def _read_western(b: bytes) -> str:
    return b.decode("latin-1").translate(_C1252)


def _iso(s: str) -> str:
    out = _ESCAPE_RUN.sub(lambda m: (b"\x1b$B" + m[1][: len(m[1]) // 2 * 2].encode() + b"\x1b(B").decode("iso2022_jp", "replace"), s)
    return re.sub("\x1b?\\([BJ]", "", out)


#: Pairs: name, forward (clean text to garbled text), inverse (garbled span to clean text).
PAIRS = {
    "utf8_as_western": (lambda s: _read_western(s.encode()), lambda s: _western_bytes(s).decode("utf-8", "replace")),
    "utf8_as_western_twice": (lambda s: _read_western(_read_western(s.encode()).encode()), lambda s: _western_bytes(_western_bytes(s).decode("utf-8", "replace")).decode("utf-8", "replace")),
    "utf8_as_mac": (lambda s: s.encode().decode("mac_roman"), lambda s: s.encode("mac_roman", "ignore").decode("utf-8", "replace")),
    "utf8_as_cp932": (lambda s: s.encode().decode("cp932", "replace"), lambda s: s.replace("�", "\uf8f3").encode("cp932", "ignore").decode("utf-8", "replace")),
    "cp932_as_western": (lambda s: _read_western(s.encode("cp932", "replace")), lambda s: _western_bytes(s).decode("cp932", "replace")),
    "cp932_as_utf8": (lambda s: s.encode("cp932", "replace").decode("utf-8", "replace"), None),
    "eucjp_as_cp932": (lambda s: s.encode("euc_jp", "replace").decode("cp932", "replace"), lambda s: s.replace("�", "\uf8f3").encode("cp932", "ignore").decode("euc_jp", "replace")),
    "eucjp_as_western": (lambda s: _read_western(s.encode("euc_jp", "replace")), lambda s: _western_bytes(s).decode("euc_jp", "replace")),
    "eucjp_as_utf8": (lambda s: s.encode("euc_jp", "replace").decode("utf-8", "replace"), None),
    "iso2022jp_as_ascii": (lambda s: s.encode("iso2022_jp", "replace").decode("ascii").replace("\x1b", ""), _iso),
}
#: States: the clean one, one a pair, and one more each for Western text, clean or of the pairs that garble it.
WESTERN_PAIRS = ("utf8_as_western", "utf8_as_western_twice", "utf8_as_mac", "utf8_as_cp932")
STATES = ["clean", *PAIRS, *WESTERN_PAIRS, "clean"]
_FORWARD = [lambda s: s, *(f for f, _ in PAIRS.values()), *(PAIRS[p][0] for p in WESTERN_PAIRS), lambda s: s]
#: Share of plain digits, letters, signs and spaces that garbled Japanese holds at least.
PLAIN = 0.02
_PAIR_OF = np.array([STATES.index(p) for p in STATES], np.int8)
_INVERTIBLE = [k for k, p in enumerate(STATES) if p in PAIRS and PAIRS[p][1]]
_KANJI = re.compile("[㐀-鿿]")


def _prior() -> np.ndarray:
    counts = np.full((len(STATES), _CLASSES), 0.5)
    counts[[0, -1], :] = 1e-3
    for c, n in {0: 50, 1: 50, 2: 50, 3: 50, 9: 20, 11: 20, 8: 5, 14: 50, 13: 50, 16: 50, 15: 50, 17: 20, 18: 5, 22: 20, 23: 20, 26: 20}.items():
        counts[0, c] += n
        counts[-1, c] += n / 100 if c > 12 else n
    return counts


def emissions(clean: list[str], known: str) -> np.ndarray:
    """Counts of character classes by state, from clean texts and their garbled forms."""
    model = {"known": known}
    counts = np.zeros((len(STATES), _CLASSES))
    for t in clean:
        japanese = sum("ぁ" <= c <= "鿿" for c in t) * 10 > len(t)
        for k, forward in enumerate(_FORWARD):
            if japanese != (k > len(PAIRS)):
                counts[k] += np.bincount(classes(forward(t), model), minlength=_CLASSES)[:_CLASSES]
    return counts


def build(known: str, counts: np.ndarray) -> dict:
    """The model: emission log probabilities by state, and the kanji known. Western letters are seen by every state that garbles them."""
    seen = counts + _prior() + np.where(np.arange(len(STATES))[:, None] > len(PAIRS), emissions([_WESTERN + _TYPOGRAPHIC + "abcdefghij " * 9], known), 0)
    seen[1 : len(PAIRS) + 1, :4] += PLAIN * seen[1 : len(PAIRS) + 1].sum(1, keepdims=True)
    return {"known": known, "_known": set(known), "emit": np.log(seen / seen.sum(1, keepdims=True))}


def train(clean: list[str]) -> dict:
    """The model of a few texts."""
    known = "".join(sorted({c for t in clean for c in _KANJI.findall(t)}))
    return build(known, emissions(clean, known))


_TABLE = _class_table()


def _tables(model: dict) -> np.ndarray:
    if "_table" not in model:
        t = _TABLE.copy()
        t[[ord(c) for c in model["known"]]] = 16
        model["_table"] = t
    return model["_table"]


def classes(text: str, model: dict) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _tables(model)[np.minimum(codes, 0xFFFF)]
    if "ƒ" in text or "‚" in text:
        # A capital before or after these is left by reading twice; alone by reading once.
        mark, capital = (codes == 0x192) | (codes == 0x201A), out == 7
        before, after = capital[:-1] & mark[1:], capital[1:] & mark[:-1]
        out[:-1][before] = 24
        out[1:][after] = 25
    if "$B" in text or "$@" in text:
        for m in _ESCAPE_RUN.finditer(text):
            out[m.start() : m.end()] = 4
    return out


def viterbi(texts: list[str], model: dict) -> list[np.ndarray]:
    """The likeliest state of every character; the texts of a block run side by side."""
    out: list = [None] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    emit, stay, leave = model["emit"].T.copy(), np.log(1 - SWITCH), np.log(SWITCH)
    i = 0
    while i < len(order):
        j, most = i, len(texts[order[i]])
        while j < len(order) and (j == i or len(texts[order[j]]) * (j - i + 1) <= BLOCK_CHARS):
            most = len(texts[order[j]])
            j += 1
        rows = order[i:j]
        obs = np.zeros((most, len(rows)), np.uint8)
        for r, k in enumerate(rows):
            obs[: len(texts[k]), r] = classes(texts[k], model)
        score = np.full((len(rows), len(STATES)), leave) + emit[obs[0]] if most else None
        if most:
            score[:, [0, -1]] -= leave
        back = np.zeros((most, len(rows), len(STATES)), np.int8)
        me, every = np.arange(len(STATES), dtype=np.int8), np.arange(len(rows))
        for t in range(1, most):
            best = score.argmax(1)
            jump = score[every, best] + leave
            here = score + stay
            moved = jump[:, None] > here
            back[t] = np.where(moved, best[:, None].astype(np.int8), me)
            score = np.where(moved, jump[:, None], here) + emit[obs[t]]
        # Padding is a space, as likely in the clean state as anywhere: paths are read from each text's own end.
        for r, k in enumerate(rows):
            n = len(texts[k])
            path = np.zeros(n, np.int8)
            if n:
                s = int(_end_state(score, back, obs, emit, r, n, most, leave, stay))
                for t in range(n - 1, -1, -1):
                    path[t] = s
                    s = back[t, r, s] if t else s
            out[k] = path
        i = j
    return out


def _end_state(score, back, obs, emit, r, n, most, leave, stay):
    s = int(score[r].argmax())
    for t in range(most - 1, n - 1, -1):
        s = int(back[t, r, s])
    return s


def _readable(s: str, known: set) -> int:
    """Readable characters beyond ASCII, or 0 if other ones are more than a fifth."""
    good = sum("ぁ" <= c <= "ヿ" or c in known or c in _WESTERN or c in _TYPOGRAPHIC or "　" <= c <= "〟" or "！" <= c <= "～" for c in s)
    rest = sum(c > "\x7f" for c in s) - good
    return good if rest * 4 <= good else 0


def _reads(back: str, span: str, state: str, known: set, least: int = 3) -> bool:
    """Whether an inverse gave text again: of two-byte pairs at least ``least`` characters, for two letters of a name can look like one."""
    need = 1 if state.startswith(("utf8", "iso")) else least
    return back != span and "�" not in back and _readable(back, known) >= need and _SUSPICIOUS_PY.search(span) is not None


def _whole_runs(text: str, path: np.ndarray, known: set) -> np.ndarray:
    """The path with one pair for each run without a clean character, where the whole run reads by one of its pairs."""
    change = np.flatnonzero(np.diff(path)) + 1
    if not ((path[change] != 0) & (path[change - 1] != 0)).any():
        return path
    path = path.copy()
    dirty = np.concatenate([[False], path != 0, [False]])
    for a, b in zip(np.flatnonzero(dirty[1:] & ~dirty[:-1]), np.flatnonzero(dirty[:-1] & ~dirty[1:])):
        held = np.bincount(path[a:b])
        for k in np.argsort(-held, kind="stable")[: np.count_nonzero(held)] if np.count_nonzero(held) > 1 else ():
            inverse = PAIRS[STATES[k]][1]
            if inverse and _reads(inverse(text[a:b]), text[a:b], STATES[k], known):
                path[a:b] = k
                break
    return path


def spans(text: str, path: np.ndarray, model: dict, sure: frozenset = frozenset()) -> list[tuple[int, int, str, str | None]]:
    """(start, end, pair, restored or None) of each span that counts. Of pairs that are ``sure``, or that a longer span of
    the text shows, spans of one character count too."""
    known = model["_known"]
    path = _whole_runs(text, _PAIR_OF[path], known)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], path, [0]])))
    found, cut = [], sorted({*edges.tolist(), 0, len(text)})
    done, short = 0, set()
    for a, b in zip(cut, cut[1:]):
        s, a = int(path[a]), max(a, done)
        if a >= b:
            continue
        if not s:
            found += [(m.start() + a, m.end() + a, "lost", None) for m in re.finditer("�+", text[a:b])]
            continue
        name, inverse = STATES[s], PAIRS[STATES[s]][1]
        if inverse is None:
            if "�" in text[a:b]:
                found.append((a, b, name, None))
            continue
        span, back, least = text[a:b], inverse(text[a:b]), 1 if name in sure else 3
        if "�" in back and (wider := _whole_characters(text, a, b, done, inverse)):
            (a, b), back = wider, inverse(text[slice(*wider)])
            span = text[a:b]
        if not _reads(back, span, name, known, least):
            # The inverses of the other states, the likeliest for this span first.
            fit = model["emit"][:, classes(span, model)].sum(1)
            other = next((p for k in sorted(_INVERTIBLE, key=lambda k: -fit[k]) if (p := STATES[k]) != name and _reads(PAIRS[p][1](span), span, p, known)), None)
            if other:
                name, back = other, PAIRS[other][1](span)
            elif "�" not in span:
                if _reads(back, span, name, known, 1):
                    short.add(name)
                continue
        found.append((a, b, name, back))
        done = b
    shown = frozenset(k for _, _, k, back in found if back is not None)
    return spans(text, path, model, shown) if short & shown else found


def _whole_characters(text: str, a: int, b: int, least: int, inverse) -> tuple[int, int] | None:
    """A span up to three characters wider on either side whose inverse is without loss: the path takes a character's first
    or last byte for clean if it reads as a plain one."""
    for x, y in _WIDER:
        if least <= a - x and b + y <= len(text) and "�" not in inverse(text[a - x : b + y]):
            return a - x, b + y
    return None


_WIDER = sorted(((x, y) for x in range(4) for y in range(4) if x or y), key=sum)


def label(texts: list[str], model: dict) -> list[list[tuple[int, int, str, str | None]]]:
    return [spans(t, p, model) for t, p in zip(texts, viterbi(texts, model))]


def repair(text: str, found: list[tuple[int, int, str, str | None]]) -> str:
    out, at = [], 0
    for a, b, _, back in found:
        out += [text[at:a], text[a:b] if back is None else back]
        at = b
    return "".join(out) + text[at:]


def from_bytes(raw: bytes, known: set) -> tuple[str, str] | None:
    """Encoding and text of bytes that aren't UTF-8: the strict reading with most readable characters."""
    best = None
    for name in ("euc_jp", "cp932", "cp1252"):
        try:
            text = raw.decode(name)
        except UnicodeDecodeError:
            continue
        good = _readable(text, known)
        if good and (best is None or good > best[0]):
            best = good, name, text
    return best and best[1:]


def from_western(text: str, model: dict, found: list) -> tuple[list[str], str]:
    """Pairs and text of bytes that aren't UTF-8, read as Western and labelled.

    If all labels agree on one pair, its inverse is taken of the whole, where that is without loss. Where the labels
    leave something unreadable, the strict reading of all bytes with most readable characters is taken, if there is one.
    """
    pairs = sorted({k for _, _, k, _ in found})
    if len(pairs) == 1 and PAIRS.get(pairs[0], (0, None))[1] and "�" not in (whole := PAIRS[pairs[0]][1](text)):
        return pairs, whole
    out, known = repair(text, found), model["_known"]
    if (_UNREADABLE.search(out) or not found and not out.isascii() and not _readable(out, known)) and (strict := from_bytes(_western_bytes(text), known)):
        return [f"{strict[0]}_as_utf8"], strict[1]
    return pairs or ["cp1252_as_utf8"], out


_UNREADABLE = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f�]")

RESULT = "table_name string, rec_id long, n_spans int, garbled_chars int, pairs array<string>, restored string"


def texts(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """(table_name, rec_id, text) of the text tables; responses that aren't PDF are read as UTF-8."""
    parts = []
    for name in names:
        if name == "http_response":
            raw = table(spark, sf_dir, name, "rec_id", "content", spread=True).where("content is not null and not startswith(content, X'25504446')")
            text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "^\ufeff", "")
            raw = raw.withColumn("raw", F.when(~F.is_valid_utf8(F.col("content").cast("string")), F.col("content")))
        else:
            raw = table(spark, sf_dir, name, "rec_id", "full_text", spread=True).withColumn("raw", F.lit(None).cast("binary"))
            text = F.col("full_text")
        parts.append(raw.select(F.lit(name).alias("table_name"), "rec_id", text.alias("text"), "raw"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("text is not null and text != ''")


def known_kanji(all_texts: DataFrame) -> str:
    """Kanji of at least ``KNOWN_TEXTS`` clean texts: one pass, counts combined within tasks, a script's size at the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for b in batches:
            for t in b.text:
                if not _SUSPICIOUS_PY.search(t):
                    counts.update(set(t))
        yield pd.DataFrame([(c, n) for c, n in counts.items() if _KANJI.match(c)], columns=["c", "n"])

    counted = all_texts.select("text").mapInPandas(run, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return "".join(sorted(r.c for r in counted.where(F.col("n") >= KNOWN_TEXTS).select("c").collect()))


def fit(all_texts: DataFrame, names: tuple[str, ...] = ("jp_case_detail", "parsed_document", "http_response")) -> dict:
    """The model. Emissions are counted beside up to ``TRAIN_ROWS`` clean texts a table, the first by hash: a top-k, not a shuffle."""
    known = known_kanji(all_texts.where(F.col("table_name").isin(*names)))
    first = None
    for name in names:
        top = all_texts.where(F.col("table_name") == name).select("table_name", "rec_id", F.xxhash64("text").alias("h")).orderBy("h", "rec_id").limit(2 * TRAIN_ROWS)
        first = top if first is None else first.unionByName(top)
    rank = {(r.table_name, r.rec_id): r.h for r in first.collect()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for t, i, x in zip(b.table_name, b.rec_id, b.text):
                if (t, i) in rank and not _SUSPICIOUS_PY.search(x):
                    yield pd.DataFrame({"table_name": [t], "h": [rank[t, i]], "counts": [emissions([x], known).ravel()]})

    rows = all_texts.where(F.col("rec_id").isin(sorted({i for _, i in rank}))).select("table_name", "rec_id", "text").mapInPandas(run, "table_name string, h long, counts array<double>").collect()
    counts = np.zeros((len(STATES), _CLASSES))
    for name in names:
        for r in sorted((r for r in rows if r.table_name == name), key=lambda r: r.h)[:TRAIN_ROWS]:
            counts += np.array(r.counts).reshape(counts.shape)
    return build(known, counts)


def label_odd(texts: list[str], model: dict) -> dict[int, list]:
    """Spans of the texts that may have any, by position."""
    odd = [k for k, t in enumerate(texts) if _SUSPICIOUS_PY.search(t)]
    return dict(zip(odd, label([texts[k] for k in odd], model))) if odd else {}


def detect(all_texts: DataFrame, model: dict) -> DataFrame:
    """One row per record with a garbled span, with the restored text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raws = {k: bytes(x) for k, x in enumerate(b.raw) if x is not None}
            texts = [_read_western(raws[k]) if k in raws else x for k, x in enumerate(b.text)]
            found, rows = label_odd(texts, model), []
            for k in sorted({*found, *raws}):
                n, i, f = b.table_name.iat[k], b.rec_id.iat[k], found.get(k, [])
                if k in raws and raws[k][:2] in (b"\xff\xfe", b"\xfe\xff"):
                    pairs, text = ["utf_16_as_utf8"], raws[k].decode("utf_16", "replace")
                elif k in raws:
                    pairs, text = from_western(texts[k], model, f)
                elif f:
                    pairs, text = sorted({p for _, _, p, _ in f}), repair(texts[k], f)
                else:
                    continue
                rows.append((n, i, max(1, len(f)), sum(y - x for x, y, *_ in f) or len(text), pairs, text))
            yield pd.DataFrame(rows, columns=["table_name", "rec_id", "n_spans", "garbled_chars", "pairs", "restored"])

    return all_texts.select("table_name", "rec_id", "text", "raw").mapInPandas(run, RESULT)


def repaired(texts: list[str], model: dict) -> list[str]:
    """The texts with garbled spans restored where possible."""
    found = label_odd(texts, model)
    return [repair(t, found[k]) if found.get(k) else t for k, t in enumerate(texts)]


TABLES = ("jp_case_detail", "parsed_document", "http_response")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = texts(spark, sf_dir, *TABLES)
    return detect(t, fit(t)).select("table_name", "rec_id")


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = texts(spark, sf_dir, *TABLES)
    return detect(t, fit(t))
