"""A stream of page changes: admission, hourly deduplication, triage, routing, digests.

All transformations are the same DataFrame functions for streams and for batches, so the batch twin of
each can be tested against SQL. Event time is used throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quellwerk.functions.text import dedup_hash, triage

CHANGE = "url string, watch_uuid string, current_snapshot string, previous_snapshot string, diff string, ts timestamp"
#: Late events are taken for so long; the deduplication state is dropped after it.
LATE = "1 hour"


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """SRC21: events as JSON files that drop into a folder; a broker's topic has the same columns."""
    return spark.readStream.schema(CHANGE).json(folder)


def watch_table(watches: DataFrame) -> DataFrame:
    """JOIN4: one product a url; of several rows the last in order wins."""
    return watches.groupBy("url").agg(F.max_by("product", "seq").alias("product"))


def admit(events: DataFrame, watches: DataFrame) -> DataFrame:
    """STR1: events with a url that is watched; the registry is a small dimension, and AQE picks the join."""
    return events.where("url is not null and url != ''").join(watch_table(watches), "url")


def deduplicate(events: DataFrame) -> DataFrame:
    """STR2: the first event of each hash of url, difference and hour. State lives as long as events may be late."""
    keyed = events.withColumn("dedup_hash", dedup_hash(F.col("url"), F.col("diff"), F.col("ts")))
    if events.isStreaming:
        return keyed.withWatermark("ts", LATE).dropDuplicatesWithinWatermark(["dedup_hash"])
    return keyed.dropDuplicates(["dedup_hash"])


def classify(events: DataFrame, answer=None) -> DataFrame:
    """STR3: triage of each change from a model's answer column; the default answer is a deterministic stub."""
    size = F.length(F.coalesce("diff", F.lit("")))
    stub = F.to_json(F.struct(F.lit("RELEVANT").alias("relevance"), F.when(size > 2000, "P0").when(size > 500, "P1").when(size > 50, "P2").otherwise("P3").alias("urgency"), F.concat(F.lit("Change of "), "url").alias("summary"), F.lit("Review").alias("recommended_action")))
    t = triage(answer if answer is not None else stub)
    return events.withColumn("__t", t).select(*events.columns, F.col("__t.result.relevance").alias("relevance"), F.col("__t.result.urgency").alias("urgency"), F.col("__t.result.summary").alias("summary"), F.col("__t.result.recommended_action").alias("recommended_action"), F.col("__t.parse_error").alias("parse_error"))


def route(classified: DataFrame, routes: list[tuple[str, str, list[str]]]) -> DataFrame:
    """STR4, STR5, JOIN5: one row a channel by routes(product, urgency, channels) of a config; what has no route goes to
    log_only, a parse error to email as well."""
    spark = classified.sparkSession
    dim = F.broadcast(spark.createDataFrame(list(routes), "product string, urgency string, channels array<string>"))
    x = classified.withColumn("urgency", F.coalesce("urgency", F.lit("P3"))).join(dim, ["product", "urgency"], "left")
    channels = F.coalesce("channels", F.array(F.lit("log_only")))
    return x.withColumn("channel", F.explode(F.when(F.coalesce("parse_error", F.lit(False)), F.array_union(channels, F.array(F.lit("email")))).otherwise(channels))).drop("channels")


def notifications(routed: DataFrame) -> DataFrame:
    """TXT27, SNK13: rows to send, not sent here: channel, subject and body."""
    short = F.substring(F.coalesce("summary", F.lit("No summary available.")), 1, 80)
    subject = F.when(F.col("channel") == "github_issue", F.substring(F.concat(F.lit("["), "urgency", F.lit("] "), short), 1, 100)).otherwise(F.concat(F.lit("["), "urgency", F.lit("] "), "product", F.lit(": "), short))
    body = F.concat_ws(
        "\n", F.concat(F.lit("A change relevant to "), "product", F.lit(".")), F.lit(""), F.concat(F.lit("  Urgency:     "), "urgency"), F.concat(F.lit("  URL:         "), "url"),
        F.concat(F.lit("  Relevance:   "), F.coalesce("relevance", F.lit("N/A"))), F.lit(""), F.concat(F.lit("Summary: "), F.coalesce("summary", F.lit("N/A"))), F.lit(""), F.concat(F.lit("Recommended Action: "), F.coalesce("recommended_action", F.lit("N/A"))),
    )
    return routed.select("channel", "product", "urgency", "url", subject.alias("subject"), body.alias("body"))


def select_changes(log: DataFrame, since: str | None = None, urgencies: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """FIL5, FIL6, SRC22, SRT1: changes since a time, of given urgencies, the last written first."""
    x = log
    if since:
        x = x.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    if urgencies:
        x = x.where(F.col("urgency").isin([u.strip() for u in urgencies if u.strip()]))
    x = x.orderBy(F.desc("seq"))
    return x.limit(limit) if limit else x


def digest(log: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """STR6, AGG13: counts by urgency of the days before ``as_of`` and a summary, one row a product with changes."""
    levels = ["P0", "P1", "P2", "P3"]
    end = F.lit(as_of).cast("timestamp")
    x = log.where((F.col("ts") >= end - F.expr(f"interval {days} days")) & (F.col("ts") <= end))
    u = F.coalesce("urgency", F.lit("P3"))
    n = x.groupBy("product").agg(F.count("*").alias("n_changes"), *[F.count_if(u == k).alias(k) for k in levels])
    parts = F.array_join(F.filter(F.array(*[F.when(F.col(k) > 0, F.concat(F.col(k).cast("string"), F.lit(f" {k}"))) for k in levels]), lambda p: p.isNotNull()), ", ")
    return n.withColumn("summary", F.concat(F.lit(f"Weekly digest ({days}d): "), F.when(parts == "", "no changes").otherwise(parts)))


def weekly_counts(events: DataFrame) -> DataFrame:
    """STR6 as a stream: tumbling weeks by product and urgency; run it in update mode to see the open week."""
    x = events.withWatermark("ts", LATE) if events.isStreaming else events
    return x.groupBy(F.window("ts", "7 days"), "product", "urgency").agg(F.count("*").alias("n"))


def start(events: DataFrame, watches: DataFrame, out: str, checkpoint: str, deliver: Callable[[DataFrame], None] | None = None, routes: list[tuple[str, str, list[str]]] = ()) -> StreamingQuery:
    """STR4, STR5, STR7: the whole stream: each micro-batch goes to the log by product, then to its channels.

    Progress is in ``checkpoint``: a restart goes on where it stopped. Files of a batch are written under
    its number, so a batch that runs twice replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = classify(batch)
        path = f"{out}/batch={number}"
        rows.write.mode("overwrite").partitionBy("product").json(path)
        if deliver:
            # Read back, so that what is sent is what was logged and nothing is classified twice.
            deliver(notifications(route(batch.sparkSession.read.schema(rows.schema).json(path), routes)))

    return deduplicate(admit(events, watches)).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
