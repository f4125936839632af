"""Chunks, vector search and its precision."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a query set that go to every task; more are refused, search in blocks instead.
MOST_QUERIES = 50_000


def articles(text: Column) -> Column:
    """RAG1: the parts that a header ``Article N:`` or ``Recital N:`` opens on a line of its own, with their header."""
    return F.filter(F.split(text, "(?m)(?=^(?:Article|Recital) \\d+)"), lambda p: F.trim(p) != "")


def windows(df: DataFrame, key: str, text: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """RAG2: windows of words, the next starting ``overlap`` before the end of the last; the one that reaches the end is the last."""
    words = F.filter(F.split(F.trim(text), "\\s+"), lambda w: w != "")
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((n - size) / (size - overlap)).cast("int")) * (size - overlap), F.lit(size - overlap))
    x = df.select(key, words.alias("w")).where("size(w) > 0")
    x = x.select(key, "w", F.posexplode(starts).alias("chunk_index", "start"))
    return x.select(key, F.col("chunk_index").cast("bigint").alias("chunk_index"), F.col("start").cast("bigint").alias("start"), F.size(F.slice("w", F.col("start") + 1, F.lit(size))).cast("bigint").alias("n_words"), F.array_join(F.slice("w", F.col("start") + 1, F.lit(size)), " ").alias("chunk"))


def embed(df: DataFrame, key: str, text: str, model=None, dimensions: int = 64, batch: int = 64) -> DataFrame:
    """RAG3: (key, embedding), ``batch`` texts a call of ``model`` (texts to vectors), which each task makes once.

    Without a model a deterministic stub stands in: hashed words, scaled to length one. A null text is embedded as "".
    """

    def stub(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), np.float32)
        for r, t in enumerate(texts):
            for w in t.lower().split():
                h = zlib.crc32(w.encode())
                out[r, h % dimensions] += 1 if h & 0x10000 else -1
        return out / np.maximum(1e-12, np.linalg.norm(out, axis=1, keepdims=True))

    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), batch):
                part = b.iloc[k : k + batch]
                yield pd.DataFrame({key: part[key], "embedding": list(map(list, (model or stub)([t or "" for t in part[text]])))})

    return df.select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<float>")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """RAG4, LIM4: the k nearest others by cosine of each query vector.

    A stated query set (its size is checked) meets all vectors in blocks: each task keeps its own k best
    of every query, so k rows a query and task are shuffled.
    """
    rows = queries.select(key, vector).where(F.col(vector).isNotNull()).limit(MOST_QUERIES + 1).collect()
    if len(rows) > MOST_QUERIES:
        raise ValueError("more than %d queries; search in blocks" % MOST_QUERIES)
    names = [r[0] for r in rows]

    def unit(m: np.ndarray) -> np.ndarray:
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)

    q = unit(np.array([r[1] for r in rows], np.float64)) if rows else np.zeros((0, 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b) or not names:
                continue
            s = np.round(q @ unit(np.stack(b[vector].to_numpy()).astype(np.float64)).T, 6)
            here = b[key].to_numpy()
            s[np.asarray(names)[:, None] == here[None, :]] = -np.inf
            top = np.lexsort((np.broadcast_to(here, s.shape), -s), axis=1)[:, :k]
            at = np.repeat(np.arange(len(names)), top.shape[1])
            out = pd.DataFrame({"query_id": np.asarray(names)[at], "neighbour_id": here[top.ravel()], "similarity": s[at, top.ravel()]})
            yield out[np.isfinite(out.similarity)]

    best = vectors.select(key, vector).where(F.col(vector).isNotNull()).mapInPandas(run, "query_id long, neighbour_id long, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "neighbour_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def precision_at_k(found: DataFrame, labels: DataFrame, key: str = "vec_id", label: str = "label") -> DataFrame:
    """AGG27: the share of queries with a neighbour of their own label among the found."""
    a = labels.select(F.col(key).alias("query_id"), F.col(label).alias("want"))
    b = labels.select(F.col(key).alias("neighbour_id"), F.col(label).alias("got"))
    hit = found.join(a, "query_id").join(b, "neighbour_id").groupBy("query_id").agg(F.bool_or(F.col("want") == F.col("got")).alias("hit"))
    share = F.avg(F.col("hit").cast("double"))
    return hit.agg(F.count("*").alias("n_queries"), F.round(share, 4).alias("precision_at_k"), (share >= 0.85).alias("passed"))
