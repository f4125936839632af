"""Problem 1: texts cut at a field limit or in transfer.

What may follow a break (closing lines, annex lists, links, "read more" marks) is taken off the end. The
running text that is left has an open end if its last sentence isn't ended (a period after a learned
abbreviation ends none) or a quotation or bracket of its last block stays open. Every open end is then
judged by three witnesses, whose weights are log-likelihood ratios learned from all texts:

* its kind of block: how often a complete block of that kind (long; short; a short line that the corpus
  knows, such as a heading; with something unclosed) is open inside texts, where nothing is cut;
* the corpus vocabulary's trie, held as a table of proper prefixes with the number of known words below
  each: whether the final token is an unknown proper prefix of known words, which cut ends are more often
  than ended ones;
* length: whether the text is as long as many texts of its source are, more often open than ended.

An end whose own last few characters are lost to a wrong encoding can't be judged and is no case; of
quotations and brackets, those opened before a lost character may have closed there and aren't counted.

Defined results: null, empty and link-only texts are no cases; repeated rows each count; very long
texts are taken whole; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quellwerk.llm import encoding, lookalikes
from quellwerk.llm.common import cut, shuffled, table

#: A token is known if it stands in so many places besides the ends in question.
KNOWN_LEAST = 3
#: A length is a limit if so many and so large a share of a source's texts have it.
LIMIT_LEAST, LIMIT_SHARE = 20, 0.01
#: A block of at most so many characters on one line is of the short kind; a heading is one that the corpus knows.
SHORT_MOST = 40
#: An abbreviation's period goes on in lower case, a number or § in so large a share of its places, and ends a block in
#: no larger one than that.
GOES_ON, ENDS_BLOCK = 0.1, 0.1
#: Shares are held this far from none and all.
LEAST_SHARE = 0.001

#: In a line with a replacement character, any mark of a wrong encoding among so many last characters means that the
#: end itself is lost.
LOST_END = 5

#: Forms of what may stand after the running text.
_FURNITURE = (
    "gez\\.[^\\n]*|Rechtsmittelbelehrung[^\\n]*|[–—-] [^\\n]* [–—-]|Streitwert:[^\\n]*|Verkündet am [^\\n]*|Ausgefertigt[^\\n]*|Anlagen?:[^\\n]*|\\([^()\\n]*\\)"
    "|以\\s*上|裁判[長官][^\\n]*|（[^（）\\n]*略）|【[^】\\n]*】\\s*https?:[^\\n]*|https?:[^\\s]*|[^\\n]{1,12}裁判所[^\\n]{0,12}第[0-9０-９]+部|別紙[:：][^\\n]*|添付[:：][^\\n]*"
    # The short label of an annex list, with a lost character.
    "|[^\\n:：�]{0,6}�[^\\n:：]{0,6}[:：][^\\n]*"
)
_AFTER = re.compile(f"\\s*(?:{_FURNITURE})\\s*")
_MARKS = re.compile("(?:\\s*(?:…|\\.\\.\\.|\\[[^\\[\\]\\n]{1,20}\\]|（続き[^（）\\n]*）))+$")
_STOPS, _CLOSERS = frozenset(".?!…。．？！"), "'\"“”»›’)）」』]"
#: Numbers whose period is that of a date or an amount that goes on, as the end of a text.
_PENDING = re.compile("\\b(?:am|vom|zum|seit|dem|bis|von|über|um|auf|v\\.)\\s[0-9]{1,3}\\.$")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_TOKEN = "[一-龥々]+|[ァ-ヺー]+|[ぁ-ゖ]+|[A-Za-zÀ-ɏ]+"
_TOKENS = re.compile(_TOKEN)
_LAST_TOKEN = re.compile(f"({_TOKEN})([^\\w\\s]*)$")
_DOTTED = re.compile("(?<![A-Za-zÀ-ɏ])([A-Za-zÀ-ɏ]++)\\.(?=([ \\t]+[a-zß-ÿ0-9§(])?)(?=(\\s*\\n\\s*\\n|\\s*$)?)")
_BLOCK = re.compile("\\n\\s*\\n")

def running(text: str) -> str:
    """The text up to the end of its running part: whole lines of furniture go, from the last on, then marks."""
    end = len(text.rstrip())
    while end:
        start = text.rfind("\n", 0, end) + 1
        line = _INVISIBLE.sub("", text[start:end])
        if not _AFTER.fullmatch(line) and not (lookalikes._SHAPES.search(line) and _AFTER.fullmatch(lookalikes.canonical(line)[0])):
            break
        end = len(text[:start].rstrip())
    # Marks are on the last line; what stands before it isn't looked at again.
    start = text.rfind("\n", 0, end) + 1
    return text[:start] + _MARKS.sub("", _INVISIBLE.sub("", text[start:end]).rstrip()).rstrip()


def _open(block: str, opening: str, closing: str) -> bool:
    """Whether more is opened than closed; after a lost character, of what was opened since."""
    at = block.rfind("�") + 1
    if not at:
        return block.count(opening) > block.count(closing)
    depth = 0
    for c in block[at:]:
        depth = depth + 1 if c == opening else max(0, depth - 1) if c == closing else depth
    return depth > 0


def is_short(block: str) -> bool:
    return len(block) <= SHORT_MOST and "\n" not in block


def shape(line: str) -> str:
    """A line as headings are counted: digits alike."""
    return "\n" + re.sub(r"\d+", "0", line)


def is_ended(last: str) -> bool:
    return last.rstrip(_CLOSERS)[-1:] in _STOPS and not _PENDING.search(last[-24:])


def end_traits(body: str) -> tuple[str, bool, str | None, str, bool] | None:
    """(kind, open, line if short, final token, whether a period ends it) of a running text, or None without any."""
    body = body.rstrip()
    if not body:
        return None
    block = body[body.rfind("\n\n") + 1 :].strip()
    last = block[block.rfind("\n") + 1 :]
    lost = "�" in last and encoding._SUSPICIOUS_PY.search(last[-LOST_END:]) is not None
    unclosed = not lost and any(_open(block, a, b) for a, b in ("„“", "（）", "「」"))
    short = is_short(block)
    token = _LAST_TOKEN.search(last)
    kind = "unclosed" if unclosed else "short" if short else "long"
    return kind, unclosed or not (lost or is_ended(last)), shape(block) if short else None, token[1] if token else "", bool(token) and token[2][:1] == "."


def inner_blocks(body: str) -> Iterator[tuple[str, bool, str | None]]:
    """(kind, open, line if short and open) of the blocks of a running text before its last one: nothing is cut there."""
    blocks = _BLOCK.split(body)
    for b in blocks[:-1]:
        if b := b.strip():
            open_ = not is_ended(b[b.rfind("\n") + 1 :])
            yield ("short" if is_short(b) else "long"), open_, shape(b) if open_ and is_short(b) else None


#: Distinct tokens that a task counts before it passes the counts on.
MOST_COUNTED = 200_000
SCAN = "table_name string, rec_id long, source string, n_chars int, kind string, open boolean, line string, token string, dotted boolean, n long, n_dot long, n_mid long, n_end long"
_SCAN = [c.split()[0] for c in SCAN.split(", ")]


def scan(texts: DataFrame, model: dict) -> DataFrame:
    """One pass over all texts: a row per end with its traits, and rows of counts, combined within each task.

    Counted are tokens, with a period, with one that goes on and with one that ends a block; short lines that stand open as
    blocks inside texts; and such blocks by kind (a row without token). Japanese texts are repaired first (problem 2).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        dots: dict[str, list[int]] = {}
        blocks: Counter = Counter()

        def flush() -> list[tuple]:
            rows = [(*(None,) * 7, k, None, n, *dots.get(k, (0, 0, 0))) for k, n in counts.items()]
            rows += [(t, None, None, None, k, o, None, None, None, n, None, None, None) for (t, k, o), n in blocks.items()]
            counts.clear(), dots.clear(), blocks.clear()
            return rows

        for b in batches:
            bodies = b.text.tolist()
            if (b.table_name == "jp_case_detail").any():
                bodies = encoding.repaired(bodies, model)
            parts = list(map(running, bodies))
            rows = [(t, i, s, len(x), *e, None, None, None, None) for t, i, s, x, y in zip(b.table_name, b.rec_id, b.source, bodies, parts) if (e := end_traits(y))]
            for t, x, y in zip(b.table_name, bodies, parts):
                counts.update(_TOKENS.findall(x))
                for w, mid, end in _DOTTED.findall(x) if "." in x else ():
                    d = dots.setdefault(w, [0, 0, 0])
                    d[0] += 1
                    d[1] += mid != ""
                    d[2] += end != ""
                for kind, open_, line in inner_blocks(y):
                    blocks[t, kind, open_] += 1
                    if line:
                        counts[line] += 1
            if len(counts) > MOST_COUNTED:
                rows += flush()
            yield _frame(rows)
        yield _frame(flush())

    return texts.select("table_name", "rec_id", "source", "text").mapInPandas(run, SCAN)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    types = dict.fromkeys(["rec_id", "n_chars", "n", "n_dot", "n_mid", "n_end"], "Int64") | dict.fromkeys(["open", "dotted"], "boolean")
    return pd.DataFrame(rows, columns=_SCAN).astype(types)


def trie(vocab: DataFrame) -> DataFrame:
    """(token, below): every proper prefix of a known word, with the number of known words below it."""
    known = vocab.where((F.col("n") >= KNOWN_LEAST) & (F.length("token") > 1) & ~F.startswith("token", F.lit("\n")))
    return known.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring(F.col("token"), F.lit(1), i))).alias("token")).groupBy("token").agg(F.count("*").alias("below"))


def _ratio(yes: str, open_: bool) -> Column:
    """Log-likelihood ratio of a trait's presence (or absence) at open against ended ends, a half added to each count."""
    hit = [F.col(f"{yes}_{s}") if open_ else F.col(f"n_{s}") - F.col(f"{yes}_{s}") for s in ("open", "ended")]
    return F.log((hit[0] + 0.5) / (F.col("n_open") + 1)) - F.log((hit[1] + 0.5) / (F.col("n_ended") + 1))


def detect(texts: DataFrame, model: dict) -> DataFrame:
    """One row per cut text with its witnesses: broken_word (trie), at_limit (length), kind of block, and the score."""
    scanned = cut(scan(texts, model))
    end = scanned.where("rec_id is not null")
    vocab = scanned.where("token is not null and n is not null").groupBy("token").agg(*[F.sum(c).alias(c) for c in ("n", "n_dot", "n_mid", "n_end")])
    # The ends' tokens and lines are joined to the vocabulary once each, not it to the ends.
    asked = end.where("token != ''").groupBy("token").agg(F.count("*").alias("asked"))
    seen = asked.join(shuffled(vocab), "token", "left").join(shuffled(trie(vocab)), "token", "left")
    short = (F.col("n_mid") >= KNOWN_LEAST) & (F.col("n_mid") >= GOES_ON * F.col("n_dot")) & (F.col("n_end") <= ENDS_BLOCK * F.col("n_dot"))
    broken = (F.coalesce("n", F.lit(0)) - F.col("asked") < KNOWN_LEAST) & (F.coalesce("below", F.lit(0)) > 0)
    seen = seen.select("token", broken.alias("broken_word"), F.coalesce(short, F.lit(False)).alias("abbreviation"))
    lines = end.where("line is not null").groupBy("line").agg(F.count("*").alias("own")).join(shuffled(vocab.select(F.col("token").alias("line"), "n")), "line", "left")
    lines = lines.select("line", (F.coalesce("n", F.lit(0)) >= KNOWN_LEAST).alias("known"))
    limits = (
        end.groupBy("table_name", "source", "n_chars").agg(F.count("*").alias("n"))
        .withColumn("all", F.sum("n").over(Window.partitionBy("table_name", "source")))
        .where((F.col("n") >= LIMIT_LEAST) & (F.col("n") >= LIMIT_SHARE * F.col("all")))
        .select("table_name", F.coalesce("source", F.lit("")).alias("source_"), "n_chars", F.lit(True).alias("at_limit"))
    )
    judged = end.join(shuffled(seen), "token", "left").join(shuffled(lines), "line", "left").withColumn("source_", F.coalesce("source", F.lit("")))
    judged = judged.join(shuffled(limits), ["table_name", "source_", "n_chars"], "left").select(
        "table_name", "rec_id", "source", F.when((F.col("kind") == "short") & F.col("known"), "line").otherwise(F.col("kind")).alias("kind"),
        (F.col("open") | (F.col("dotted") & F.coalesce("abbreviation", F.lit(False)))).alias("open"),
        F.coalesce("broken_word", F.lit(False)).alias("broken_word"), F.coalesce("at_limit", F.lit(False)).alias("at_limit"),
    )
    judged = cut(judged)
    ended = ~F.col("open")
    # Short lines that stand open inside texts and aren't known: the corpus has that many headings of its texts' own.
    rare = vocab.where(F.startswith("token", F.lit("\n")) & (F.col("n") < KNOWN_LEAST)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rare"))
    inner = scanned.where("token is null and rec_id is null").groupBy("kind").agg(F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("inner_open"), F.sum(F.when(ended, F.col("n")).otherwise(0)).alias("inner_ended"))
    by_kind = judged.groupBy("kind").agg(F.count_if("open").alias("kind_open"), F.count_if(ended).alias("kind_ended")).join(inner, "kind", "left").crossJoin(F.broadcast(rare))  # four rows
    # Open ends that are complete: as many to the ended ones as among all blocks that aren't cut, those inside texts and the
    # ended ones. A known line is open as a rule, a bracket never.
    odds = (F.when(F.col("kind") == "short", F.col("rare")).otherwise(F.coalesce("inner_open", F.lit(0))) + 0.5) / (F.coalesce("inner_ended", F.lit(0)) + F.col("kind_ended") + 1)
    complete = F.when(F.col("kind") == "line", 1.0).when(F.col("kind") == "unclosed", 0.0).otherwise(odds * F.col("kind_ended") / F.greatest("kind_open", F.lit(1)))
    share = F.greatest(F.lit(LEAST_SHARE), F.least(F.lit(1 - LEAST_SHARE), 1 - complete))
    prior = by_kind.select("kind", (F.log(share) - F.log(1 - share)).alias("prior"))
    sums = judged.agg(*[F.count_if(w & o).alias(f"{n}_{s}") for n, w in (("n", F.lit(True)), ("broken", F.col("broken_word")), ("limit", F.col("at_limit"))) for s, o in (("open", F.col("open")), ("ended", ended))])
    weights = sums.select(*[_ratio(n, yes).alias(f"{n}_{'yes' if yes else 'no'}") for n in ("broken", "limit") for yes in (True, False)])
    scored = judged.where("open").join(F.broadcast(prior), "kind").crossJoin(F.broadcast(weights))  # one row a kind, one row
    score = F.col("prior") + F.when(F.col("broken_word"), F.col("broken_yes")).otherwise(F.col("broken_no")) + F.when(F.col("at_limit"), F.col("limit_yes")).otherwise(F.col("limit_no"))
    return scored.withColumn("score", F.round(score, 4)).where("score > 0").select("table_name", "rec_id", "source", "kind", "broken_word", "at_limit", "score")


def texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """(table_name, rec_id, source, text) of both tables, and the model that repairs the Japanese ones."""
    de = table(spark, sf_dir, "de_case_detail", "rec_id", "source", "full_text", spread=True).select(F.lit("de_case_detail").alias("table_name"), "rec_id", "source", F.col("full_text").alias("text"))
    jp = table(spark, sf_dir, "jp_case_detail", "rec_id", "url", "full_text", spread=True).select(F.lit("jp_case_detail").alias("table_name"), "rec_id", F.try_parse_url("url", F.lit("HOST")).alias("source"), F.col("full_text").alias("text"))
    both = de.unionByName(jp).where("text is not null and text != ''")
    return both, encoding.fit(both, ("jp_case_detail",))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(*texts(spark, sf_dir)).select("table_name", "rec_id")


def p1_share_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, cut texts and their share by source (ja: host of the url), and of the cut texts those with each witness."""
    full, model = texts(spark, sf_dir)
    n = full.groupBy("table_name", "source").agg(F.count("*").alias("n_texts"))
    cut_ = detect(full, model).groupBy("table_name", "source").agg(F.count("*").alias("n_cut"), F.count_if("broken_word").alias("n_broken_word"), F.count_if("at_limit").alias("n_at_limit"), F.count_if(F.col("kind") == "unclosed").alias("n_unclosed"))
    same = (n.table_name == cut_.table_name) & n.source.eqNullSafe(cut_.source)
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_cut", "n_broken_word", "n_at_limit", "n_unclosed")]
    return n.join(cut_, same, "left").select(n.table_name, n.source, "n_texts", *counts, F.round(F.coalesce("n_cut", F.lit(0)) / F.col("n_texts"), 4).alias("share_cut"))
