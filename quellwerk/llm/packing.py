"""Problem 6: filling containers of fixed capacity with documents.

Sizes are tokens of a public tokenizer (file and folder are parameters; nothing is trained or copied).
Only a document above the capacity is split: its full containers come first, the rest is packed like
any other item. Items are dealt by hash to shards of a bounded number of documents, each packed by
best-fit decreasing: a segment tree over remaining capacities finds the tightest open container in
logarithmic time. Shards are large enough that each leaves little room (measured in the README), and
only ids and sizes are shuffled, never text.

Defined results: null and empty texts have no tokens and no container; ties in size go by doc_id and
piece, so the result doesn't depend on partitions; repeated rows are items of their own only if their
doc_id differs; extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quellwerk.llm.common import cut, table

CAPACITY = 2_048
#: Folder and file of the tokenizer's ranks, and the pattern that splits text before the merges.
TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents of a shard, about: what one task packs.
SHARD_DOCUMENTS = 20_000


@cache
def encoder(folder: str, ranks: str):
    import tiktoken

    with open(os.path.join(folder, ranks), "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def token_counts(docs: DataFrame, folder: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens); the text stays in its partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, ranks).encode_ordinary
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "n_tokens": [len(encode(t)) for t in b.text]})

    return docs.where("text is not null and text != ''").select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long")


class Room:
    """Open containers by remaining capacity: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.n)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, container: int) -> None:
        self.open[room].append(container)
        i = room + self.n
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, container) of the tightest container with room for size, taken out; None without one."""
        i = size + self.n
        if not self.count[i]:
            # Up to the first subtree on the right with an open container, then down its left side.
            while i > 1 and (i & 1 or not self.count[i ^ 1]):
                i >>= 1
            if i <= 1:
                return None
            i ^= 1
            while i < self.n:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.n
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.open[room].pop()


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[int]:
    """Container of each item; items come in decreasing order of size."""
    room, out, n = Room(capacity), [], 0
    for size in sizes:
        got = room.take(size)
        if got is None:
            left, container = capacity, n
            n += 1
        else:
            left, container = got
        out.append(container)
        room.add(left - size, container)
    return out


def pack(sizes: DataFrame, capacity: int = CAPACITY, shard_documents: int = SHARD_DOCUMENTS) -> DataFrame:
    """(doc_id, piece, start_token, n_tokens, container_id) of sizes(doc_id, n_tokens)."""
    sizes = cut(sizes.where("n_tokens > 0"))
    shards = max(1, round(sizes.count() / shard_documents))
    whole = F.expr(f"n_tokens div {capacity}").cast("int")
    rest = F.col("n_tokens") % capacity
    pieces = F.when(F.col("n_tokens") <= capacity, F.array(F.struct(F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start_token"), F.col("n_tokens").alias("size")))).otherwise(
        F.filter(
            F.transform(F.sequence(F.lit(0), whole), lambda k: F.struct(k.alias("piece"), (k.cast("long") * capacity).alias("start_token"), F.when(k < whole, F.lit(capacity).cast("long")).otherwise(rest).alias("size"))),
            lambda x: x["size"] > 0,
        )
    )
    items = sizes.select("doc_id", F.inline(pieces)).select("doc_id", "piece", "start_token", F.col("size").alias("n_tokens"))
    full = items.where(F.col("n_tokens") == capacity).withColumn("container_id", F.format_string("full-%d-%d", "doc_id", "piece"))

    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True])
        return items.assign(container_id=[f"s{key[0]}-{c}" for c in best_fit(items.n_tokens.tolist(), capacity)])[["doc_id", "piece", "start_token", "n_tokens", "container_id"]]

    loose = items.where(F.col("n_tokens") < capacity).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    packed = loose.groupBy("shard").applyInPandas(run, "doc_id long, piece int, start_token long, n_tokens long, container_id string")
    return packed.unionByName(full)


def p6_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_counts(table(spark, sf_dir, "documents", "doc_id", "text", spread=True)))


def p6_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of room used, with the least number of containers possible by volume."""
    n = p6_assignment(spark, sf_dir).groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("items"))
    total = F.sum("used")
    return n.agg(
        F.count("*").alias("n_containers"), F.sum("items").alias("n_items"), total.alias("n_tokens"), F.max("used").alias("most_used"),
        F.ceil(total / CAPACITY).alias("least_containers"), F.round(total / (F.count("*") * CAPACITY), 5).alias("share_used"),
    )
