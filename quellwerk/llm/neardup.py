"""Problem 3: near-duplicate records with small edits, in a collection too large for pairwise comparison.

One pass normalises each text (lower case, no white space), keys it by content and draws a minwise
signature of the very sequences that the similarity is defined on, by one-permutation hashing: bands of
it, and a fingerprint of one bit a bin with its Hamming distances to reference fingerprints (pivots taken
from the data). Copies are one text from there on. Texts that share a band are candidates; the pivot
table discards a pair when some coordinate differs by more than the largest admissible distance (the
triangle inequality, so nothing near is lost), the Hamming distance itself comes next, and survivors
are verified exactly: Jaccard similarity of the sets of five-character sequences.

Distances of unrelated texts to any pivot concentrate, so the pivot table alone can't find the
candidates (figures in the README); the bands do.

Every join of sides that grow is one by shuffle: written files are compressed, and their size says little
about memory. A band that very many different texts share, and the copies of a text, are dealt to tasks
in blocks.

Defined results: null texts and texts under ``LEAST`` characters have no pairs; identical texts pair
with each other; repeated rows are rows; empty tables give no pairs; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quellwerk.llm.common import cut, discard, sendable, shuffled, table

#: Similarity of five-character sequences, and characters a text must have.
SIMILAR, LEAST, SHINGLE = 0.65, 500, 5
#: Signature: bins, and bands of so many bins each. A bin of a pair agrees as often as the pair is similar, whatever the
#: edits; of simulated pairs from 0.70 to 0.72 the bands miss 7 in 10,000, of those from 0.72 on none in 9,000.
BINS, BANDS, ROWS = 256, 96, 7
#: Fingerprints of texts alike differ in at most so many of their 256 bits: at 0.65 in 45, by a deviation of 6.
RADIUS = 80
#: Reference fingerprints, the first of the data by hash.
PIVOTS = 64
#: Different texts of a band, and copies of a text, beyond which their pairs are made in blocks of so many.
BLOCK = 2_000
#: Hot bands are sought in one of so many texts; that plans the blocks and changes no result.
SOUGHT = 64
#: Hot bands that are dealt to tasks, the largest first; any others are joined whole.
MOST_HOT = 50_000
#: Bytes of a key in the exchange of bands.
KEY_BYTES = 20
#: Texts that a task remembers, to leave the signatures of further copies away.
REMEMBERED = 200_000

_P = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    return "".join(text.lower().split())


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(33))


def signature(text: str) -> np.ndarray:
    """Minima of the hashes of all ``SHINGLE``-character sequences, by bin; an empty bin borrows from the next."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(1, len(codes) - SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(codes))):
        h = h * _P + codes[k : k + n] + np.uint64(1)
    h = np.sort(_mix(h))
    bins = (h >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out = np.zeros(BINS, np.uint64)
    full = np.zeros(BINS, bool)
    out[bins[first]] = h[first] & np.uint64((1 << 56) - 1)
    full[bins[first]] = True
    if not full.all():
        at = np.flatnonzero(full)
        empty = np.flatnonzero(~full)
        nxt = at[np.searchsorted(at, empty) % len(at)]
        out[empty] = _mix(out[nxt] + ((empty - nxt) % BINS).astype(np.uint64) * _P)
    return out


def _band_bins() -> np.ndarray:
    """Bins of each band: shuffles of all bins by a fixed generator, in groups."""
    g, rows = np.random.RandomState(5), []
    while len(rows) < BANDS:
        rows += list(g.permutation(BINS)[: BINS // ROWS * ROWS].reshape(-1, ROWS))
    return np.array(rows[:BANDS])


_BAND_BINS = _band_bins()


def bands(sig: np.ndarray, seed: int = 0) -> np.ndarray:
    rows = sig[_BAND_BINS]
    h = np.arange(seed * BANDS, (seed + 1) * BANDS, dtype=np.uint64) * _P
    for k in range(ROWS):
        h = _mix(h * _P + rows[:, k])
    return h.view(np.int64)


def fingerprint(sig: np.ndarray) -> np.ndarray:
    return np.packbits(((_mix(sig + _P) >> np.uint64(7)) & np.uint64(1)).astype(np.uint8))


def distances(fp: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances less 128, a byte each."""
    return (np.minimum(np.bitwise_count(pivots ^ fp[None, :]).sum(1), 255) - 128).astype(np.int8)


SIGNED = "table_name string, rec_id long, text_key binary, u long, bands array<long>, fp array<long>, pivots array<tinyint>"
_SIGNED = [c.split()[0] for c in SIGNED.split(", ")]


def sign(texts: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Key of each record's text (and ``u``, its first eight bytes); the signature too, but for copies that a task has met."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[bytes] = set()
        for b in batches:
            rows = []
            for t, i, x in zip(b.table_name, b.rec_id, b.text):
                x = normal(x)
                if len(x) < LEAST:
                    continue
                key = hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=16, person=hashlib.blake2b(t.encode(), digest_size=16).digest()).digest()
                u = int.from_bytes(key[:8], "little", signed=True)
                if key in met:
                    rows.append((t, i, key, u, None, None, None))
                    continue
                if len(met) < REMEMBERED:
                    met.add(key)
                s = signature(x)
                fp = fingerprint(s)
                rows.append((t, i, key, u, bands(s, zlib.crc32(t.encode())), fp.view(np.int64), distances(fp, pivots)))
            yield pd.DataFrame(rows, columns=_SIGNED)

    return texts.mapInPandas(run, SIGNED)


def choose_pivots(texts: DataFrame) -> np.ndarray:
    """Fingerprints of the first ``PIVOTS`` texts by hash; the texts stay with the tasks."""
    first = texts.select("table_name", "rec_id", F.xxhash64("text").alias("h")).orderBy("h", "table_name", "rec_id").limit(PIVOTS).collect()
    wanted = {(r.table_name, r.rec_id) for r in first}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, i, fingerprint(signature(normal(x))).tobytes()) for t, i, x in zip(b.table_name, b.rec_id, b.text) if (t, i) in wanted]
            yield pd.DataFrame(rows, columns=["table_name", "rec_id", "fp"])

    rows = texts.where(F.col("rec_id").isin([r.rec_id for r in first])).mapInPandas(run, "table_name string, rec_id long, fp binary").collect()
    if not rows:
        return np.zeros((PIVOTS, BINS // 8), np.uint8)
    return np.stack([np.frombuffer(r.fp, np.uint8) for r in sorted(rows)][:PIVOTS])


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    jp = table(spark, sf_dir, "jp_case_detail", "rec_id", "full_text", spread=True).select(F.lit("jp_case_detail").alias("table_name"), "rec_id", F.col("full_text").alias("text"))
    synth = table(spark, sf_dir, "synth_document", "rec_id", "document_content", spread=True).select(F.lit("synth_document").alias("table_name"), "rec_id", F.col("document_content").alias("text"))
    return jp.unionByName(synth).where(F.length("text") >= LEAST)


def band_pairs(keys: DataFrame, n_keys: int) -> DataFrame:
    """(u_a, u_b), u_a < u_b, of all u that share a band in keys(u, band); some pairs come more than once.

    Bands that more than about ``BLOCK`` different texts share are joined block by block. ``n_keys`` is about the rows
    of keys: the widest exchange gets as many partitions as the session's advisory size asks for.
    """
    conf = keys.sparkSession.conf
    advised = int(keys.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")))
    parts = max(int(conf.get("spark.sql.shuffle.partitions")), n_keys * KEY_BYTES // advised + 1)
    sought = keys.where(F.pmod(F.xxhash64("u"), F.lit(SOUGHT)) == 0).distinct().groupBy("band").agg(F.count("*").alias("n"))
    sought = sought.where(F.col("n") * SOUGHT >= BLOCK).orderBy(F.desc("n"), "band").limit(MOST_HOT)
    hot = cut(sought.select("band", F.ceil(F.col("n") * SOUGHT / BLOCK).alias("parts")))
    any_hot = hot.count() > 0
    # Both sides of the join read one exchange, with the copies that several tasks have met.
    cold = keys.join(F.broadcast(hot), "band", "left_anti") if any_hot else keys
    cold = cold.repartition(parts, "band")

    def meet(a: DataFrame, b: DataFrame, *on: str) -> DataFrame:
        # One side loses its copies, so that those of the other find each text once.
        a, b = a.withColumnRenamed("u", "u_a"), b.dropDuplicates([*on, "u"]).withColumnRenamed("u", "u_b")
        return a.join(shuffled(b), list(on)).where("u_a < u_b").select("u_a", "u_b")

    pairs = meet(cold, cold, "band")
    if any_hot:
        dealt = keys.join(F.broadcast(hot), "band")
        a = dealt.select("u", "band", F.pmod(F.xxhash64("u"), "parts").alias("part"))
        b = dealt.select("u", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        pairs = pairs.unionByName(meet(a, b, "band", "part"))
    return pairs


def near_texts(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: table_name, rec_id, text_key; near: pairs of different texts that are alike, by their keys)."""
    signed = cut(sign(texts, choose_pivots(texts)))
    firsts = signed.where("bands is not null")
    # One row a text: its representative record and what is compared. Copies combine within tasks first.
    own = signed.groupBy("u", "text_key").agg(F.min("table_name").alias("table_name"), F.min("rec_id").alias("rep"), F.max("fp").alias("fp"), F.max("pivots").alias("pivots"))
    own = cut(own)
    found = band_pairs(firsts.select("u", F.explode("bands").alias("band")), BANDS * own.count()).repartition("u_a").dropDuplicates(["u_a", "u_b"])

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.join(shuffled(own.select(*[F.col(c).alias(f"{c}_{s}") for c in own.columns])), f"u_{s}")

    both = side(side(found, "a"), "b").where("table_name_a = table_name_b")
    apart = F.array_max(F.zip_with("pivots_a", "pivots_b", lambda x, y: F.abs(x.cast("int") - y.cast("int"))))
    differ = sum((F.bit_count(F.col("fp_a")[k].bitwiseXOR(F.col("fp_b")[k])) for k in range(BINS // 64)), F.lit(0))
    near = both.where(apart <= RADIUS).where(differ <= RADIUS).select(F.col("table_name_a").alias("table_name"), "rep_a", "rep_b", F.col("text_key_a").alias("key_a"), F.col("text_key_b").alias("key_b"))
    return signed.select("table_name", "rec_id", "text_key"), cut(verify(cut(near), texts))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose five-character sets are alike enough. Only texts of pairs are carried."""
    # A number for the key picks the texts; the joins below are by the key itself.
    ids = cut(pairs.select(F.xxhash64("table_name", "rep_a").alias("id")).union(pairs.select(F.xxhash64("table_name", "rep_b"))).distinct())
    # The texts themselves are moved only if they stand in a pair; a few pairs' ids go to the texts, not the texts to them.
    picked = F.broadcast(ids) if sendable(ids) else shuffled(ids)
    own = texts.withColumn("id", F.xxhash64("table_name", "rec_id")).join(picked, "id", "left_semi").select("table_name", "rec_id", "text")
    full = pairs.join(shuffled(own.select("table_name", F.col("rec_id").alias("rep_a"), F.col("text").alias("text_a"))), ["table_name", "rep_a"])
    full = full.join(shuffled(own.select("table_name", F.col("rec_id").alias("rep_b"), F.col("text").alias("text_b"))), ["table_name", "rep_b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            j = [similarity(x, y) for x, y in zip(b.text_a, b.text_b)]
            yield pd.DataFrame({"table_name": b.table_name, "key_a": b.key_a, "key_b": b.key_b, "similarity": j})[[v >= SIMILAR for v in j]]

    # Repeated rows of a record give its pair more than once.
    return full.mapInPandas(run, "table_name string, key_a binary, key_b binary, similarity double").dropDuplicates(["key_a", "key_b"])


def shingles(text: str) -> set[str]:
    return {text[k : k + SHINGLE] for k in range(len(text) - SHINGLE + 1)}


def similarity(a: str, b: str) -> float:
    x, y = shingles(normal(a)), shingles(normal(b))
    both = len(x & y)
    return both / max(1, len(x) + len(y) - both)


def expand(members: DataFrame, near: DataFrame) -> DataFrame:
    """All pairs of records: within the copies of a text, and between the copies of texts alike.

    The copies of each text fall to blocks of about ``BLOCK``, and every two blocks that meet do so in a task of their own.
    """
    sizes = cut(members.groupBy("text_key").agg(F.count("*").alias("n"), F.min("table_name").alias("table_name")))
    parts = F.ceil(F.col("n") / BLOCK)
    large = sizes.where(F.col("n") > BLOCK)
    many = members
    if large.count():
        many = many.join(shuffled(large.select("text_key", parts.alias("parts"))), "text_key", "left")
    else:
        many = many.withColumn("parts", F.lit(1))
    many = many.select("rec_id", F.col("text_key").alias("key"), F.pmod(F.xxhash64("rec_id"), F.coalesce("parts", F.lit(1))).alias("part"))
    same = sizes.where("n > 1").select("table_name", F.col("text_key").alias("key_a"), F.col("text_key").alias("key_b"))
    meet = near.select("table_name", "key_a", "key_b").union(same)
    for s in "ab":
        meet = meet.join(shuffled(sizes.select(F.col("text_key").alias(f"key_{s}"), parts.alias(f"parts_{s}"))), f"key_{s}")
    upto = lambda s: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"parts_{s}") - 1)).alias(f"part_{s}")
    meet = meet.select("table_name", "key_a", "key_b", "parts_b", upto("a")).select("table_name", "key_a", "key_b", "part_a", upto("b"))
    for s in "ab":
        meet = meet.join(shuffled(many.select(F.col("key").alias(f"key_{s}"), F.col("part").alias(f"part_{s}"), F.col("rec_id").alias(s))), [f"key_{s}", f"part_{s}"])
    return meet.where("key_a != key_b or a < b").select("table_name", F.least("a", "b").alias("rec_id_a"), F.greatest("a", "b").alias("rec_id_b"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand(*near_texts(texts(spark, sf_dir)))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, group_id) of all ends of edges(a, b): the smallest id reachable, of any type that has an order.

    Labels spread along links and jump to their label's label, so rounds grow with the logarithm of a chain.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("group_id")))
    for _ in range(most_rounds):
        at = label.select(F.col("id").alias("b"), F.col("group_id").alias("g"))
        spread = both.join(shuffled(at), "b").groupBy(F.col("a").alias("id")).agg(F.min("g").alias("g"))
        step = label.join(shuffled(spread), "id").select("id", F.col("group_id").alias("old"), F.least("group_id", "g").alias("g"))
        jump = label.select(F.col("id").alias("g"), F.col("group_id").alias("far"))
        new = cut(step.join(shuffled(jump), "g", "left").select("id", "old", F.least("g", F.coalesce("far", "g")).alias("group_id")))
        discard(label)
        label = new
        if new.where("old != group_id").limit(1).count() == 0:
            discard(both)
            return new.select("id", "group_id")
    raise RuntimeError("components did not settle in %d rounds" % most_rounds)


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record that has a like: its group, named by its smallest record, the number of different texts that its
    own text links to, and of the text's copies."""
    members, near = near_texts(texts(spark, sf_dir))
    copies = cut(members.groupBy(F.col("text_key").alias("id")).agg(F.min("rec_id").alias("rep"), F.count("*").alias("n_copies")))
    ends = near.select(F.col("key_a").alias("id")).union(near.select("key_b"))
    links = ends.groupBy("id").agg(F.count("*").alias("n_links"))
    known = copies.join(shuffled(components(near.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))), "id", "left").join(shuffled(links), "id", "left").where("n_copies > 1 or group_id is not null")
    known = cut(known.select("id", F.coalesce("group_id", "id").alias("group_id"), "rep", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies"))
    names = known.groupBy("group_id").agg(F.min("rep").alias("name"))
    known = known.join(shuffled(names), "group_id").select(F.col("id").alias("text_key"), F.col("name").alias("group_id"), "n_links", "n_copies")
    return members.join(shuffled(known), "text_key").select("table_name", "rec_id", "group_id", "n_links", "n_copies")
