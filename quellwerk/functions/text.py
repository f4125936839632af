"""Column functions on text: all of them stay in the JVM.

Patterns that were written for a Unicode-aware matcher carry ``(?U)`` or spell white space out as
``[\\s\\u3000]``, so that full-width digits and spaces count as they should.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quellwerk.functions import patterns as P

_BLOCKS = "(?:p|div|tr|li|h[1-6])"
# The six entities, in the order in which they are decoded.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#12288;", "　")]


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, r: F.regexp_replace(c, F.lit(r[0]), F.lit(r[1])), rules, text)


def html_to_text(html: Column) -> Column:
    """TXT1. Null gives null. Line marks of blocks, tabs after cells, then entities, then spaces."""
    text = rewrite(
        html,
        [
            ("(?is)<script[^>]*>.*?</script>", ""), ("(?is)<style[^>]*>.*?</style>", ""), ("(?i)<br\\s*/?\\s*>", "\n"),
            (f"(?i)</{_BLOCKS}>", "\n"), (f"(?i)<{_BLOCKS}[^>]*>", "\n"), ("(?i)</(?:td|th)>", "\t"), ("<[^>]+>", ""),
        ],
    )
    text = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)
    return strip(rewrite(text, [("[ \\t]+", " "), ("\\n{3,}", "\n\n")]))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, "^[\\s　]+|[\\s　]+$", "")


def find_section(text: Column, heading: str) -> Column:
    """TXT5 for one heading: what follows its first place, up to the next heading on a new line or 10,000 characters."""
    body = F.when(F.instr(text, heading) > 0, F.substring(text, F.instr(text, heading) + F.lit(len(heading)), F.length(text)))
    end = F.regexp_instr(body, F.lit("\\n[\\s　]*(?:第[一二三四五六七八九十百\\d]+|【|[０-９\\d]+[\\s　]*[\\.．])"))
    return F.when(end > 0, F.substring(body, F.lit(1), end - 1)).otherwise(F.substring(body, 1, 10_000))


def report_sections(text: Column, headings=P.REPORT_HEADINGS) -> Column:
    """TXT5: map of section name to text, for sections of more than 50 characters."""
    pairs = F.array(*[F.struct(F.lit(name).alias("key"), strip(find_section(text, h)).alias("value")) for name, h in headings])
    return F.map_from_entries(F.filter(pairs, lambda x: F.coalesce(F.length(x["value"]), F.lit(0)) > 50))


def german_section(text: Column, name: str) -> Column:
    """TXT6: a named part of a German decision, at most 5,000 characters; "" if absent. The pattern with numbering second."""
    stop = "Tenor|Tatbestand|Entscheidungsgründe|Gründe"
    first = f"(?isu)(?:^|\\n)\\s*{name}\\s*\\n(.*?)(?=\\n\\s*(?:{stop}|Leitsatz)\\s*\\n|\\z)"
    second = f"(?isu)(?:^|\\n)\\s*(?:I+\\.?\\s*)?{name}:?\\s*\\n(.*?)(?=\\n\\s*(?:I+\\.?\\s*)?(?:{stop})\\s*\\n|\\z)"
    got = F.when(text.rlike(first), F.regexp_extract(text, first, 1)).when(text.rlike(second), F.regexp_extract(text, second, 1)).otherwise("")
    return F.substring(strip(got), 1, 5000)


def japanese_section(text: Column, name: str) -> Column:
    """TXT7: a named part of a Japanese decision, at most 5,000 characters; "" if absent."""
    first = f"(?s){name}[\\s　]*\\n(.*?)(?=\\n(?:主文|理由|事実|事実及び理由|結論|当裁判所の判断)[\\s　]*\\n|\\z)"
    second = f"(?s)第?\\d*[\\s　]*{name}(.*?)(?=第?\\d*[\\s　]*(?:主文|理由|事実|結論)|\\z)"
    got = F.when(text.rlike(first), F.regexp_extract(text, first, 1)).when(text.rlike(second), F.regexp_extract(text, second, 1)).otherwise("")
    return F.substring(strip(got), 1, 5000)


def bgb_sections(text: Column) -> Column:
    """TXT8: sorted distinct citations ``§N BGB``."""
    found = [
        F.regexp_extract_all(text, F.lit(p), F.lit(1))
        for p in ("§\\s*(\\d+[a-z]?)\\s*(?:Abs\\.\\s*\\d+\\s*)?(?:S\\.\\s*\\d+\\s*)?(?:Nr\\.\\s*\\d+\\s*)?BGB", "§§\\s*([\\d,\\s]+(?:bis|[-–])\\s*\\d+[a-z]?)\\s*BGB", "BGB\\s*§\\s*(\\d+[a-z]?)")
    ]
    return F.array_sort(F.array_distinct(F.transform(F.concat(*found), lambda x: F.concat(F.lit("§"), x, F.lit(" BGB")))))


def all_matches(text: Column, rules: list[str]) -> Column:
    """TXT9: sorted distinct matches of all patterns."""
    return F.array_sort(F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in rules])))


def first_matches(text: Column, rules: list[str], flags: str = "") -> Column:
    """TXT10, TXT11: sorted distinct first matches, one a pattern.

    A pattern is tried only where its literal start stands in the text, which is a plain search.
    """
    fold = "i" in flags

    def first(t: Column, low: Column, p: str) -> Column:
        start = re.match(r"[^(\[?*+\\|.]*", p)[0]
        start = start[:-1] if p[len(start) : len(start) + 1] == "?" else start
        start = start.lower() if fold else start
        # A match begins where a literal start does: what precedes the first one isn't given to the pattern. (Lower case
        # can change a text's length in rare scripts; such texts are searched whole.)
        near = F.when(F.length(low) == F.length(t), F.substring(t, F.instr(low, start), F.length(t))).otherwise(t)
        return F.when(low.contains(start), F.regexp_extract(near, flags + p, 0)).otherwise("")

    # Bound by a lambda, the lower-case text is made once and not for every pattern.
    both = F.array(F.struct(text.alias("t"), (F.lower(text) if fold else text).alias("low")))
    found = F.element_at(F.transform(both, lambda z: F.array(*[first(z["t"], z["low"], p) for p in rules])), 1)
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x != "")))


def is_japanese(text: Column) -> Column:
    """TXT16."""
    return text.rlike("[\\u3040-\\u30ff\\u4e00-\\u9fff]")


def is_german(text: Column) -> Column:
    """TXT17: a German letter, or two different common words."""
    words = F.split(strip(F.lower(text)), "[\\s　]+")
    return text.rlike("[äöüÄÖÜß]") | (F.size(F.array_intersect(words, F.array(*map(F.lit, P.GERMAN_WORDS)))) >= 2)


def trigrams(text: Column) -> Column:
    """TXT25: triples of neighbouring words of a text with six words or more, else none."""

    def triples(words: Column) -> Column:
        own = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(3))))
        return F.when(F.size(words) >= 6, own).otherwise(F.array().cast("array<string>"))

    return bound(F.split(text, "\\s+"), triples)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once a row: a lambda within would make an expression anew for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dedup_hash(url: Column, diff: Column, ts: Column) -> Column:
    """TXT26: sixteen hex digits over url, difference and hour."""
    return F.substring(F.sha2(F.concat_ws("|", url, diff, F.date_format(ts, "yyyy-MM-dd-HH")), 256), 1, 16)


def eta(seconds: Column) -> Column:
    """TXT24."""
    return (
        F.when(seconds < 60, F.format_string("%ds", seconds.cast("long")))
        .when(seconds < 3600, F.format_string("%dm %ds", F.floor(seconds / 60), F.floor(seconds % 60)))
        .when(seconds < 86400, F.format_string("%dh %dm", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60)))
        .otherwise(F.format_string("%dd %dh", F.floor(seconds / 86400), F.floor(seconds % 86400 / 3600)))
    )


def japanese_era(day: Column) -> Column:
    """SRC20: (era, year of the era, month, day) of YYYY-MM-DD by its year alone; nulls and zeros if it isn't one."""
    part = [F.try_element_at(F.split(day, "-"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    ok = part[0].isNotNull() & part[1].isNotNull() & part[2].isNotNull() & (part[0] >= 1926)
    era = F.when(part[0] >= 2019, "令和").when(part[0] >= 1989, "平成").when(part[0] >= 1926, "昭和")
    year = part[0] - F.when(part[0] >= 2019, 2018).when(part[0] >= 1989, 1988).otherwise(1925)
    return F.struct(F.when(ok, era).alias("era"), F.when(ok, year).otherwise(0).alias("era_year"), F.when(ok, part[1]).otherwise(0).alias("month"), F.when(ok, part[2]).otherwise(0).alias("day"))


def filing_label(code: Column) -> Column:
    """TXT29."""
    known = F.create_map(*[F.lit(x) for kv in P.FILING_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, code), F.concat(F.lit("Type-"), code))


def triage(response: Column, fields: str = "relevance string, urgency string, summary string, recommended_action string") -> Column:
    """TXT22: the JSON object of a model's answer, fences or prose around it apart; else a fallback for review."""
    text = strip(response)
    text = F.when(text.startswith("```"), strip(F.regexp_replace(text, "(?m)^\\s*```.*$", ""))).otherwise(text)
    inner = F.regexp_extract(text, "(?s)\\{.*\\}", 0)

    def parsed(t: Column) -> Column:
        # Only an object counts: its first sign is a brace.
        return F.when(F.try_parse_json(t).isNotNull() & strip(t).startswith("{"), F.from_json(t, fields))

    fallback = F.struct(F.lit("UNCLEAR").alias("relevance"), F.lit("P2").alias("urgency"), F.lit("LLM response could not be parsed as JSON. Manual review needed.").alias("summary"), F.lit("Review raw response below.").alias("recommended_action"))
    good = F.coalesce(parsed(text), parsed(inner))
    return F.struct(F.coalesce(good, fallback).alias("result"), F.when(good.isNull(), F.substring(response, 1, 2000)).alias("raw_response"), good.isNull().alias("parse_error"))


def markdown(preamble: Column, segments: Column) -> Column:
    """TXT18: segments(label, content) under a preamble; blanks, dashes and line marks at the end go."""
    parts = F.transform(segments, lambda s: F.concat(F.when(s["label"].isNotNull(), F.concat(F.lit("### "), s["label"], F.lit("\n\n"))).otherwise(""), s["content"], F.lit("\n\n---\n")))
    return F.regexp_replace(F.concat_ws("\n", F.when(preamble != "", F.concat(preamble, F.lit("\n"))), F.array_join(parts, "\n")), "[\\n\\- ]+$", "")


def plain(segments: Column) -> Column:
    """TXT20."""
    parts = F.transform(segments, lambda s: F.concat(F.when(s["label"].isNotNull(), F.concat(F.lit("["), s["label"], F.lit("]\n"))).otherwise(""), s["content"], F.lit("\n")))
    return F.regexp_replace(F.array_join(parts, "\n"), "\\s+$", "")


def json_document(document_id: Column, segments: Column) -> Column:
    """TXT19: ordered, null labels kept."""
    return F.to_json(F.struct(document_id.alias("document_id"), segments.alias("segments")), {"ignoreNullFields": "false"})


def fill_template(template: str, columns: list[str], raw_if_unknown: bool = False) -> Column:
    """GEN14, TXT21: ``"{a} {b}"`` as an expression; an unknown name is an error at once, or gives the template as it is."""
    import string

    out = []
    if raw_if_unknown and any(name is not None and name not in columns for _, name, *_ in string.Formatter().parse(template)):
        return F.lit(template)
    for literal, name, *_ in string.Formatter().parse(template):
        if literal:
            out.append(F.lit(literal))
        if name is not None:
            if name not in columns:
                raise KeyError(f"template names the unknown column {name!r}")
            out.append(F.coalesce(F.col(name).cast("string"), F.lit("None")))
    return F.concat(*out) if out else F.lit("")


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on seed and keys only, on every engine alike."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
