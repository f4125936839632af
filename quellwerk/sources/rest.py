"""REST sources: a Python data source with an injected fetcher, one partition a day or section.

The fetcher ``fetch(url, params) -> dict`` is a plain function, so tests and offline runs give their own.
Requests are spaced and tried again inside a partition; a day that fails gives an error row, others go on.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str, dict], dict]


def with_retries(fetch: Fetch, times: int = 3, wait: float = 0.0) -> Fetch:
    """STR8: up to ``times`` tries, the pause doubling."""

    def get(url: str, params: dict) -> dict:
        for k in range(times):
            try:
                return fetch(url, params)
            except Exception:  # noqa: BLE001
                if k == times - 1:
                    raise
                time.sleep(wait * 2**k)
        raise RuntimeError("no try left")

    return get


class _Part(InputPartition):
    def __init__(self, value: str):
        self.value = value


class _Reader(DataSourceReader):
    def __init__(self, source: RestSource):
        self.o = source

    def partitions(self) -> list[InputPartition]:
        return [_Part(v) for v in self.o.parts]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        get = with_retries(self.o.fetch, wait=self.o.wait)
        url, n = self.o.url, 0
        params = {self.o.param: partition.value, **self.o.fixed}
        try:
            while url and n < self.o.most:
                body = get(url, params)
                rows = body if isinstance(body, list) else body.get("results") or []
                for r in rows[: self.o.most - n]:
                    n += 1
                    yield partition.value, json.dumps(r, ensure_ascii=False), None
                url, params = (None if isinstance(body, list) else body.get("next")), {}
        except Exception as e:  # noqa: BLE001
            yield partition.value, None, str(e)


class RestSource(DataSource):
    """SRC10, SRC12, SRC14, SRC15: rows (part, body, error). Configure a subclass by :func:`rest_source`."""

    url, param, fixed, parts, most, wait = "", "date", {}, [], 1_000_000, 0.0
    fetch: Fetch = staticmethod(lambda url, params: {})

    @classmethod
    def name(cls) -> str:
        return "quellwerk_rest"

    def schema(self) -> str:
        return "part string, body string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self)


def rest_source(spark: SparkSession, url: str, parts: list[str], fetch: Fetch, param: str = "date", fixed: dict | None = None, most: int = 1_000_000, wait: float = 0.0) -> DataFrame:
    kind = type("Configured", (RestSource,), {"url": url, "parts": parts, "fetch": staticmethod(fetch), "param": param, "fixed": fixed or {}, "most": most, "wait": wait})
    spark.dataSource.register(kind)
    return spark.read.format("quellwerk_rest").load()


def days(start: str, end: str) -> list[str]:
    """SRC12: the days of a range, both ends included."""
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(a + dt.timedelta(k)).isoformat() for k in range((b - a).days + 1)]


def listings(rows: DataFrame, types: list[str]) -> DataFrame:
    """FIL1, TXT28, TXT31: listed filings of the wanted types that aren't withdrawn; unknown keys stay in ``extra``."""
    from quellwerk.functions.text import filing_label

    known = ["docID", "edinetCode", "filerName", "docTypeCode", "docDescription", "filingDate", "withdrawalStatus"]
    m = F.from_json("body", "map<string,string>")
    x = rows.where("body is not null").select(*[F.coalesce(F.try_element_at(m, F.lit(k)), F.lit("")).alias(k) for k in known], F.map_filter(m, lambda k, v: ~k.isin(known)).alias("extra"))
    label = filing_label(F.col("docTypeCode"))
    return x.where(F.col("docTypeCode").isin(types) & F.col("withdrawalStatus").isin("0", "")).select(
        F.col("docID").alias("source_id"), F.coalesce(F.nullif("docDescription", F.lit("")), label).alias("title"), F.col("filingDate").alias("filing_date"), F.col("docTypeCode").alias("document_type"), label.alias("document_type_label"), F.col("filerName").alias("filer_name"), "extra"
    )


def counters(rows: DataFrame) -> DataFrame:
    """AGG23: listed, downloaded, parsed and failed rows of a run."""
    return rows.agg(F.count("*").alias("listed"), F.count_if(F.col("downloaded")).alias("downloaded"), F.count_if(F.col("parsed")).alias("parsed"), F.count_if(F.coalesce(F.col("error"), F.lit("")) != "").alias("errors"))
