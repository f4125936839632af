"""Flaw rules on text and their roll-up to taxonomies.

Rules become array expressions on the row and are exploded once: no join of texts with patterns, no
shuffle before the roll-up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quellwerk.functions import patterns as P
from quellwerk.functions.text import bound, trigrams

FLAW = "struct<flaw_type:string,flaw_subtype:string,severity:string,confidence:double,description:string,evidence:string>"


def _flaw(kind: str, subtype: str, severity: str, confidence: float, description: Column | str, evidence: Column) -> Column:
    text = F.lit(description) if isinstance(description, str) else description
    return F.struct(F.lit(kind).alias("flaw_type"), F.lit(subtype).alias("flaw_subtype"), F.lit(severity).alias("severity"), F.lit(confidence).alias("confidence"), text.alias("description"), evidence.alias("evidence"))


def repeated_trigrams(text: Column) -> Column:
    """Trigrams that stand three times or more, sorted: equal neighbours of the sorted list, one pass."""
    return bound(F.array_sort(trigrams(text)), lambda t: F.array_distinct(F.filter(t, lambda x, i: (i >= 2) & (F.get(t, i - 2) == x))))


def segment_flaws(long: DataFrame) -> DataFrame:
    """FLW4-11 on (document_id, segment, text): an empty section stops the other rules for its cell."""
    t = F.col("text")
    empty = t.isNull() | (t == "")
    again = repeated_trigrams(t)
    generic = F.coalesce(*[F.when(t.contains(p), F.lit(p)) for p in P.BOILERPLATE])
    rules = [
        (empty, _flaw("structural", "empty_section", "high", 1.0, "Section is completely empty", F.lit("<empty>"))),
        (~empty & (F.length(t) < 20), _flaw("structural", "stub_section", "medium", 0.9, "Section is suspiciously short (< 20 chars)", t)),
        (~empty & t.rlike("\\ufffd{2,}|[\\u0092-\\u0094]"), _flaw("formatting", "garbled_characters", "high", 0.85, "Detected garbled or replacement characters", F.substring(t, 1, 100))),
        (~empty & t.rlike("[\\u2e80-\\u2eff]"), _flaw("encoding", "non_jis_characters", "high", 0.7, "Possible Simplified Chinese characters in Japanese text", F.substring(t, 1, 200))),
        (~empty & (F.size(again) > 0), _flaw("content", "repetition", "medium", 0.6, F.concat(F.lit("Repeated trigram(s) detected: "), F.size(again).cast("string"), F.lit(" unique")), F.array_join(F.slice(again, 1, 3), "; "))),
        (~empty & t.contains("[GENERATION_FAILED"), _flaw("generation", "generation_failed", "critical", 1.0, "LLM generation failure sentinel detected", F.substring(t, 1, 200))),
        (~empty & generic.isNotNull(), _flaw("disclosure", "generic_language", "low", 0.5, "Generic boilerplate phrase detected", generic)),
    ]
    found = F.filter(F.array(*[F.when(c, f.cast(FLAW)) for c, f in rules]), lambda x: x.isNotNull())
    return long.select("document_id", "segment", F.inline(found))


def filing_flaws(docs: DataFrame) -> DataFrame:
    """FLW1-3, FIL4, JOIN8, JOIN9 on (source_id, segments map): patterns by section, short and missing sections."""
    each = docs.select("source_id", F.explode_outer("segments").alias("segment", "text"))
    t = F.coalesce("text", F.lit(""))
    rules = []
    for pattern, kind, subtype, target, severity, description in P.FILING_RULES:
        fits = t.rlike(pattern) if not target else (F.col("segment") == target) & t.rlike(pattern)
        group = 1 if subtype == "potential_duplicate_figure" else 0
        rules.append(F.when(fits, _flaw(kind, subtype, severity, 1.0, description, F.substring(F.regexp_extract(t, pattern, group), 1, 200)).cast(FLAW)))
    short = F.concat(F.lit("Section '"), "segment", F.lit("' is unusually short ("), F.length(t).cast("string"), F.lit(" chars)"))
    rules.append(F.when(F.col("segment").isNotNull() & (F.length(t) < 100), _flaw("structural", "suspiciously_short", "medium", 1.0, short, F.lit("")).cast(FLAW)))
    in_sections = each.where("segment is not null").select("source_id", "segment", F.inline(F.filter(F.array(*rules), lambda x: x.isNotNull())))
    keys = F.coalesce(F.map_keys("segments"), F.array().cast("array<string>"))
    absent = docs.select("source_id", F.explode(F.array_except(F.array(*map(F.lit, P.EXPECTED_SECTIONS)), keys)).alias("segment"))
    missing = _flaw("structural", "missing_section", "high", 1.0, F.concat(F.lit("Expected section '"), F.col("segment"), F.lit("' not found in document")), F.lit(""))
    return in_sections.unionByName(absent.select("source_id", "segment", F.inline(F.array(missing.cast(FLAW)))))


def taxonomy(flaws: DataFrame, n_documents: int, key: str = "source_id", examples: int = 3) -> DataFrame:
    """AGG8: by type, subtype and section the count, frequency, last severity and first examples.

    Order is by key and section: arrival order isn't kept by a distributed scan. No group is gathered
    whole: counts combine within tasks, examples are bounded by rank within tasks.
    """
    group = ["flaw_type", "flaw_subtype", "segment"]
    named = [F.coalesce(c, F.lit("")).alias(c) for c in group]
    first = first_rows(flaws.where("evidence != ''").select(*named, key, "evidence"), group, [key, "evidence"], examples)
    first = first.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "evidence"))), lambda x: x["evidence"]).alias("examples"))
    out = flaws.select(*named, key, "severity", "description").groupBy(*group).agg(F.count("*").alias("count"), F.max_by("severity", key).alias("severity"), F.max_by("description", key).alias("description"))
    out = out.join(first, group, "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))
    return out.withColumn("frequency", F.round(F.col("count") / F.lit(max(n_documents, 1)), 4))


def first_rows(df: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """WIN5: the first k rows of each group. The bound is on the rank itself, so each task drops the rest of a
    large group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


MENTIONS = "rec_id long, type string, match string, context string, position int"


def mentions(docs: DataFrame, rules: list[tuple[str, str]], around: int, ignore_case: bool) -> DataFrame:
    """TXT12, TXT13: every match of every pattern with its context on (rec_id, full_text).

    Contexts overlap, which the JVM's matchers can't return: one Arrow pass over the texts, no shuffle.
    (Matching all patterns in the JVM first, to send fewer texts, took longer than sending them.)
    """
    flags = re.IGNORECASE if ignore_case else 0
    compiled = [(re.compile(p, flags), t) for p, t in rules]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (i, kind, m.group(), x[max(0, m.start() - around) : m.end() + around].replace("\n", " "), m.start())
                for i, x in zip(b.rec_id, b.full_text)
                for p, kind in compiled
                for m in p.finditer(x)
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in MENTIONS.split(", ")])

    return docs.where("full_text is not null and full_text != ''").select("rec_id", "full_text").mapInPandas(run, MENTIONS)


def mention_counts(docs: DataFrame, rules: list[tuple[str, str]], ignore_case: bool) -> DataFrame:
    """TXT12, TXT13 where only counts are asked for: (type, n), matched in the JVM, combined within tasks."""
    flags = "(?iu)" if ignore_case else ""
    each = F.array(*[F.struct(F.lit(t).alias("type"), F.regexp_count("full_text", F.lit(flags + p)).cast("bigint").alias("k")) for p, t in rules])
    return docs.where("full_text is not null and full_text != ''").select(F.inline(each)).groupBy("type").agg(F.sum("k").alias("n")).where("n > 0")


def court_taxonomy(found: DataFrame, examples: int = 5) -> DataFrame:
    """AGG9, WIN5, SRT2: count by type with the first contexts by record and position."""
    first = first_rows(found.select("type", "rec_id", "position", "context"), ["type"], ["rec_id", "position"], examples)
    first = first.groupBy("type").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "context"))), lambda x: x["context"]).alias("examples"))
    return found.groupBy("type").agg(F.count("*").alias("count")).join(first, "type")
