"""Row generators and flaw injection. Every choice is a hash of seed and key: the same on any partitioning."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quellwerk.functions.patterns import TIERS
from quellwerk.functions.text import fill_template, uniform


def pick(values: list[str], u: Column) -> Column:
    """SMP3: one of the values by a uniform number."""
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(u * len(values)) + 1).cast("int"))


def categorical(values: list[str], weights: list[float] | None, u: Column, i: Column) -> Column:
    """GEN2: by normalised weights; without values ``category_{i % 5}``."""
    if not values:
        return F.concat(F.lit("category_"), (i % 5).cast("string"))
    values = [str(v) for v in values]
    if not weights:
        return pick(values, u)
    total = sum(weights)
    bound, chain = 0.0, None
    for v, w in list(zip(values, weights))[:-1]:
        bound += w / total
        chain = F.when(u < bound, v) if chain is None else chain.when(u < bound, v)
    return F.lit(values[-1]) if chain is None else chain.otherwise(values[-1])


def normal(u1: Column, u2: Column) -> Column:
    """A standard normal number of two uniform ones (Box and Muller)."""
    return F.sqrt(-2 * F.log(F.greatest(u1, F.lit(1e-12)))) * F.cos(2 * math.pi * u2)


def numeric(kind: str, u1: Column, u2: Column, mean: float = 0.0, std: float = 1.0, low: float | None = None, high: float | None = None, rate: float = 1.0, decimals: int | None = None, a: float = 2.0, b: float = 5.0) -> Column:
    """GEN3-GEN9: draws of a distribution; rounded half to even first, then clipped."""
    if kind == "normal":
        x = mean + std * normal(u1, u2)
    elif kind == "lognormal":
        x = F.exp(mean + std * normal(u1, u2))
    elif kind == "uniform":
        x = (low or 0.0) + ((1.0 if high is None else high) - (low or 0.0)) * u1
    elif kind == "exponential":
        x = -F.log(F.greatest(1 - u1, F.lit(1e-12))) / rate
    elif kind in ("poisson", "beta"):
        # No closed inverse: numpy on Arrow batches, from the hash of the row.
        @F.pandas_udf("double")
        def draw(u: pd.Series) -> pd.Series:
            each = (np.random.default_rng(int(v * 2**32)) for v in u)
            return pd.Series([g.poisson(mean or 5) if kind == "poisson" else g.beta(a, b) for g in each], dtype="float64")

        x = draw(u1)
    else:
        raise ValueError(f"no distribution {kind!r}")
    if decimals is not None:
        x = F.bround(x, decimals)
    if low is not None and kind != "uniform":
        x = F.greatest(x, F.lit(float(low)))
    if high is not None and kind != "uniform":
        x = F.least(x, F.lit(float(high)))
    return x


def ids(prefix: str, i: Column, sequential: bool = True) -> Column:
    """GEN10: prefix and six digits from 1, or eight hex digits."""
    return F.format_string(f"{prefix}%06d", i + 1) if sequential else F.concat(F.lit(prefix), F.upper(F.substring(F.md5(F.concat(F.lit(prefix), i.cast("string"))), 1, 8)))


def datetimes(i: Column, n: int, u: Column, start: str = "2020-01-01", end: str = "2026-03-11") -> Column:
    """GEN11: evenly spaced days of a range with a random second of the day, as text."""
    a, b = F.unix_timestamp(F.lit(f"{start} 00:00:00")), F.unix_timestamp(F.lit(f"{end} 00:00:00"))
    s = a + F.floor((b - a) * i / max(1, n - 1)) + F.floor(u * 86400)
    return F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd HH:mm:ss")


def table_from(spark: SparkSession, records: int, columns: list[dict], seed: int = 42) -> DataFrame:
    """GEN1, GEN12, GEN14: a table of column definitions; templates are filled last. Nulls by ``null_ratio``."""
    df, i = spark.range(records), F.col("id")
    names, templates = [], []
    for k, c in enumerate(columns):
        u1, u2 = uniform(seed + 2 * k, i), uniform(seed + 2 * k + 1, i)
        kind = c["type"]
        if kind == "id":
            v = ids(c.get("prefix", ""), i, c.get("sequential", True))
        elif kind == "categorical":
            v = categorical(c.get("values", []), c.get("weights"), u1, i)
        elif kind == "numeric":
            v = numeric(c.get("distribution", "normal"), u1, u2, **{x: c[x] for x in ("mean", "std", "low", "high", "rate", "decimals", "a", "b") if x in c})
        elif kind == "boolean":
            v = u1 < 0.5
        elif kind == "datetime":
            v = datetimes(i, records, u1, c.get("start", "2020-01-01"), c.get("end", "2026-03-11"))
        elif c.get("generator") == "template":
            templates.append(c)
            v = F.concat(F.lit(f"__TEMPLATE_{c['name']}_"), i.cast("string"), F.lit("__"))
        elif c.get("pool"):
            v = pick(c["pool"], u1)
        else:
            v = F.concat(F.lit(f"__TEXT_PLACEHOLDER_{c['name']}_"), i.cast("string"), F.lit("__"))
        if c.get("null_ratio"):
            v = F.when(uniform(seed + 10_000 + k, i) >= c["null_ratio"], v)
        df, names = df.withColumn(c["name"], v), [*names, c["name"]]
    for c in templates:
        df = df.withColumn(c["name"], fill_template(c["template"], names))
    return df.select("id", *names)


def augment(df: DataFrame, column: str, prompt: Column, generate: Callable[[str], str] | None = None, retries: int = 3) -> DataFrame:
    """GEN15: text for each row's prompt by an injected generator; failures become a sentinel. Default: a deterministic stub."""
    schema = df.withColumn(column, F.lit("")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(p: str) -> str:
            if generate is None:
                return "[" + p[:60] + "]"
            for k in range(retries):
                try:
                    return generate(p)
                except Exception as e:  # noqa: BLE001
                    if k == retries - 1:
                        return f"[GENERATION_FAILED: {e}]"
            return ""

        for b in batches:
            yield b.assign(**{column: [one(p) for p in b["__prompt"]]})[schema.names]

    return df.withColumn("__prompt", prompt).mapInPandas(run, schema)


def documents(spark: SparkSession, n: int, segments: list[dict], seeds: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """GEN16, GEN17: (document_id, segment, seq, text) of n documents; a list segment has min..max items.

    A seed row belongs to the document of its number (JOIN7).
    """
    base = spark.range(n).withColumn("document_id", F.format_string("DOC-%06d", F.col("id") + 1))
    if seeds is not None:
        base = base.join(seeds, "id", "left")
    parts = []
    for k, s in enumerate(segments):
        text = F.concat(F.lit(s["name"] + " "), "document_id")
        if s.get("kind") == "list":
            low, high = s.get("min", 1), s.get("max", 3)
            count = F.floor(uniform(seed + k, F.col("id")) * (high - low + 1)).cast("int") + low
            text = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda j: F.concat(text, F.lit(" item "), j.cast("string"))), "\n\n")
        parts.append(F.struct(F.lit(s["name"]).alias("segment"), F.lit(k).alias("seq"), text.alias("text")))
    return base.select("document_id", F.inline(F.array(*parts)))


def prior_context(long: DataFrame) -> DataFrame:
    """GEN18, GEN19, WIN3: the texts before each segment of its document, in order."""
    w = Window.partitionBy("document_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return long.withColumn("context", F.array_join(F.collect_list("text").over(w), "\n\n"))


def mixed_dataset(tiers: dict[str, DataFrame], total: int, seed: int = 42) -> DataFrame:
    """GEN21, GEN22, SET1: of each tier max(1, round(total * share)) documents, tagged, shuffled and renumbered.

    The number of a document is its rank by hash: ranges of the hash are numbered in parallel by an
    offset per range, not by one task.
    """
    parts = []
    for name, share, rate in TIERS:
        k = max(1, round(total * share))
        d = tiers[name].where(F.col("n") < k).select("text").withColumn("quality_tier", F.lit(name)).withColumn("error_rate", F.lit(rate))
        parts.append(d)
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return number(both, F.xxhash64("text", "quality_tier", F.lit(seed)), "n").withColumn("document_id", F.format_string("DOC-%06d", "n")).drop("n")


def number(df: DataFrame, order: Column, name: str, buckets: int = 4_096) -> DataFrame:
    """WIN4: 1, 2, … by order, over buckets of a hash: counts of buckets give each its offset, windows number within."""
    x = df.withColumn("__o", order).withColumn("__b", F.shiftright(F.col("__o"), 64 - buckets.bit_length() + 1))
    sizes = x.groupBy("__b").agg(F.count("*").alias("__n"))
    offsets = sizes.select("__b", (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__at"))  # at most ``buckets`` rows
    w = Window.partitionBy("__b").orderBy("__o", *df.columns)
    return x.join(F.broadcast(offsets), "__b").withColumn(name, F.row_number().over(w) + F.col("__at")).drop("__o", "__b", "__at")


def number_in_order(df: DataFrame, order: Column, name: str, buckets: int = 256) -> DataFrame:
    """1, 2, … by a number's order, over ranges of about one size: a quantile sketch cuts them, counts give each its offset."""
    x = df.withColumn("__o", order)
    edges = x.agg(F.percentile_approx("__o", [k / buckets for k in range(1, buckets)], 10_000).alias("e")).first().e or []
    cuts = F.array(*[F.lit(e) for e in sorted(set(edges))])
    x = x.withColumn("__b", F.size(F.filter(cuts, lambda e: e < F.col("__o"))) if edges else F.lit(0))
    sizes = x.groupBy("__b").agg(F.count("*").alias("__n"))
    offsets = sizes.select("__b", (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__at"))  # at most ``buckets`` rows
    w = Window.partitionBy("__b").orderBy("__o", *df.columns)
    return x.join(F.broadcast(offsets), "__b").withColumn(name, F.row_number().over(w) + F.col("__at")).drop("__o", "__b", "__at")


def gaussian_copula(df: DataFrame, columns: list[str], n: int, seed: int = 42) -> DataFrame:
    """GEN13: n rows with the marginals and rank correlations of numeric columns.

    Correlations (a matrix of columns, not rows) are factored on the driver, and normal draws go back
    through each column's quantiles (a sketch of bounded size): no ranking of all rows.
    """
    grid = [k / 200 for k in range(201)]
    quantiles = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(columns, grid, 0.001)
    usable = {c: q for c, q in zip(columns, quantiles) if q}
    names = list(usable)
    corr = df.agg(*[F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i < j]).first() if len(names) > 1 else None
    m = np.eye(len(names))
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            m[i, j] = m[j, i] = float(corr[f"{i}_{j}"] or 0.0)
    values, vectors = np.linalg.eigh(m)
    factor = vectors @ np.diag(np.sqrt(np.clip(values, 1e-9, None)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        erf = np.vectorize(math.erf)
        for b in batches:
            z = np.stack([np.random.default_rng([seed, int(i)]).standard_normal(len(names)) for i in b.id]) @ factor.T if len(b) else np.zeros((0, len(names)))
            p = 0.5 * (1 + erf(z / math.sqrt(2)))
            yield pd.DataFrame({"id": b.id, **{c: np.interp(p[:, k], grid, usable[c]) for k, c in enumerate(names)}})

    return df.sparkSession.range(n).mapInPandas(run, "id long, " + ", ".join(f"`{c}` double" for c in names))


# ---- flaw injection ----


def affected(df: DataFrame, rate: float, seed: int = 42, key: str = "document_id") -> DataFrame:
    """INJ1: documents drawn one by one with a rate."""
    return df.withColumn("affected", uniform(seed, F.col(key)) < rate)


def weighted_flaw(u: Column, flaws: list[tuple[str, float]]) -> Column:
    """INJ2, INJ7: a flaw by its frequency; zero weights mean equal ones."""
    w = [f for _, f in flaws]
    return categorical([n for n, _ in flaws], w if sum(w) > 0 else None, u, F.lit(0))


def _replace_at(text: Column, marks: list[str], count: Column, seed: int, key: Column) -> Column:
    """Single characters at hashed places replaced by hashed marks."""
    at = F.transform(F.sequence(F.lit(1), count.cast("int")), lambda j: (F.floor(uniform(seed, key, j) * F.length(text)) + 1).cast("int"))
    signs = F.filter(F.split(text, ""), lambda c: c != "")
    out = F.transform(signs, lambda c, i: F.when(F.array_contains(at, i + 1), pick(marks, uniform(seed + 1, key, i))).otherwise(c))
    return F.when(F.length(text) > 0, F.array_join(out, "")).otherwise(text)


_SYMBOLS = list("□■◆◇▲△▽▼●○★☆")


def mutate(text: Column, subtype: Column, language: str, seed: int, key: Column) -> Column:
    """INJ3: the flaw of a subtype in a text; unknown ones cut it short."""
    u = uniform(seed, key)
    n = F.length(text)
    part = F.substring(text, F.lit(1), F.greatest(F.floor(n * (0.1 + 0.3 * u)), F.lit(20)).cast("int"))
    blank = {"ja": ["該当事項はありません", "（未記入）", ""], "de": ["Nicht zutreffend.", "(nicht ausgefüllt)", ""]}.get(language, ["[N/A]", ""])
    hedge = {"ja": "一般的に、", "de": "Im Allgemeinen "}.get(language, "Generally, ")
    stale = {"ja": "令和3年3月31日現在", "de": "(Stand: 31.03.2021)"}.get(language, "(as of 2021-03-31)")
    risk = {"ja": "為替変動リスク、金利変動リスク、及び自然災害リスクが存在します。", "de": "Es bestehen Risiken durch Wechselkursschwankungen, Zinsschwankungen und Naturkatastrophen."}.get(language)
    return (
        F.when(subtype == "empty_section", pick(blank, u))
        .when(subtype.isin("suspiciously_short", "stale_reference"), part)
        .when(subtype == "missing_section", "")
        .when(subtype == "potential_duplicate_figure", F.regexp_replace(text, "^(?s)(.*?)([\\d,]+)", "$1$2$2"))
        .when(subtype == "generic_language", F.concat(F.lit(hedge), text))
        .when(subtype == "boilerplate_risk", F.lit(risk) if risk else text)
        .when(subtype == "garbled_symbols", _replace_at(text, _SYMBOLS, F.greatest(F.floor(n / 30), F.lit(2)), seed + 2, key))
        .when(subtype == "mojibake", _replace_at(text, ["â€", "ã€", "Ã¤", "Ã¶", "Ã¼", "â€™"], 2 + F.floor(u * 4), seed + 4, key))
        .when(subtype == "control_characters", _replace_at(text, [chr(k) for k in range(1, 9)], 1 + F.floor(u * 3), seed + 6, key))
        .when(subtype == "reference_date", F.concat(text, F.lit(" " + stale)))
        .otherwise(naive(text, language, seed + 8, key))
    )


def naive(text: Column, language: str, seed: int, key: Column) -> Column:
    """INJ4: cut, placeholder, garbling or a doubled piece, each as likely."""
    u, v = uniform(seed, key), uniform(seed + 1, key)
    n = F.length(text)
    cut_ = F.substring(text, F.lit(1), F.floor(n * (0.4 + 0.3 * v)).cast("int"))
    at_space = F.regexp_replace(cut_, " [^ ]*$", "")
    short = F.when(F.length(at_space) > F.length(cut_) * 0.3, at_space).otherwise(cut_)
    blank = {"ja": ["（未記入）", "＿＿＿＿＿", "※記入漏れ", ""], "de": ["(nicht ausgefüllt)", "_____", "[FEHLT]", ""]}.get(language, ["[MISSING]", "", "_____"])
    start = F.floor(v * n / 2).cast("int")
    size = (10 + F.floor(uniform(seed + 2, key) * (F.greatest(F.lit(11), F.least(F.lit(50), F.floor(n / 3))) - 9))).cast("int")
    piece = F.substring(text, start + 1, size)
    put = F.least(n, start + size)
    doubled = F.when(n < 30, text).otherwise(F.concat(F.substring(text, F.lit(1), put), piece, F.substring(text, put + 1, n)))
    return F.when(u < 0.25, short).when(u < 0.5, pick(blank, v)).when(u < 0.75, _replace_at(text, _SYMBOLS, F.greatest(F.floor(n / 50), F.lit(1)), seed + 3, key)).otherwise(doubled)


INJECTIONS = ("empty_section", "stub_section", "repetition", "generic_language", "garbled_characters")


def inject_anomalies(df: DataFrame, flaw_type: str, rate: float, segments: list[str] | None = None, seed: int = 42) -> DataFrame:
    """INJ5: exactly max(1, round(n * rate)) documents get the flaw in one segment each; ``injected_flaw`` tells which."""
    from quellwerk.operators.sampling import exact_sample
    from quellwerk.operators.segments import segment_columns

    if flaw_type not in INJECTIONS:
        raise ValueError(f"flaw type {flaw_type!r} is none of {INJECTIONS}")
    cols = segment_columns(df)
    target = [c for c in cols if segments is None or c[4:] in segments]
    if not target:
        raise ValueError(f"none of {segments}; there are {[c[4:] for c in cols]}")
    key = F.col("document_id")
    x = exact_sample(df, rate, seed).withColumn("__c", F.when(F.col("in_sample"), pick(target, uniform(seed + 1, key))))
    boiler = ["該当事項はありません。", "特記すべき事項はありません。", "当社は上記の通りです。"]
    for c in target:
        t = F.col(c)
        words = F.split(t, "\\s+")
        new = {
            "empty_section": F.lit(""),
            "stub_section": F.substring(t, 1, 15),
            "repetition": F.when(F.size(words) >= 3, F.array_join(F.array_repeat(F.array_join(F.slice(words, 1, 3), " "), 8), " ")).otherwise(F.array_join(F.array_repeat(t, 5), " ")),
            "generic_language": F.concat_ws("\n", *[pick(boiler, uniform(seed + 2 + k, key)) for k in range(3)]),
            "garbled_characters": F.when(F.length(t) > 10, _replace_at(t, ["�"], F.lit(5), seed + 5, key)).otherwise(t),
        }[flaw_type]
        x = x.withColumn(c, F.when(F.col("__c") == c, new).otherwise(t))
    return x.withColumn("injected_flaw", F.when(F.col("in_sample"), F.concat(F.lit(flaw_type + ":"), F.regexp_replace("__c", "^seg_", "")))).drop("in_sample", "__c")
