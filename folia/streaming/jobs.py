"""Structured Streaming forms of the batch jobs.

Four streaming jobs built from the same functions as the batch ones:

* ``stream_pages``: pages -> shred -> page-level fields, stateless, append;
* ``stream_url_dedupe``: canonical URL keys, first arrival kept, with a
  watermark on the data's own time bounding the dedupe state;
* ``stream_edits_latest``: the newest event per user, in a keyed store;
* ``stream_robots_gate``: the crawl gate as a join of two streams.

Each job has a fixed folder under the shared checkpoint folder (named by the
job and its source), so a run resumes where the last one stopped: files seen
before are not read again, and the sink keeps what they gave. Each runs with
``trigger(availableNow=True)`` and returns the sink as a batch DataFrame.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions import urls as U
from folia.operators.extract import page_frame
from folia.operators.shred import shred
from folia.operators.robots import gate_targets, gate_verdicts, robots_entries
from folia.session import checkpoint_dir, folder_names
from folia.streaming.store import LatestStore


def _workdir(spark: SparkSession, name: str, source: str) -> str:
    tag = hashlib.sha256(source.encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{tag}"


def _source(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1) -> DataFrame:
    """A file stream of a table: one file, or a folder that files are added to."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if _is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _is_folder(spark: SparkSession, path: str) -> bool:
    files = spark.read.parquet(path).inputFiles()
    return not files or not files[0].endswith(f"/{os.path.basename(path)}")


def _run_to_sink(df: DataFrame, work: str) -> DataFrame:
    spark = df.sparkSession
    query = (
        df.writeStream.format("parquet")
        .option("path", f"{work}/out")
        .option("checkpointLocation", f"{work}/chk")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{work}/out")


def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming page heads; equals the batch ``page_heads``."""
    pages = _source(spark, sf_dir, "pages").select("page_id", "url", "html")
    heads = page_frame(shred(pages)).where("quarantine IS NULL").select("page_id", "url", "slug", "title", "intro_text")
    return _run_to_sink(heads, _workdir(spark, "pages", sf_dir))


def url_dedupe(pages: DataFrame, event_time: str, delay: str = "1 hour") -> DataFrame:
    """(url, event time) -> canonical keys, each emitted once while its
    arrivals are within ``delay`` of each other in event time."""
    keyed = pages.selectExpr(f"{U.url_canonical('url')} AS key", f"{event_time} AS seen_at")
    return keyed.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["key"]).select("key")


def stream_url_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical URL keys of the page stream, each emitted once. The fetch
    time is the one of fixture R3: a second per page id."""
    pages = _source(spark, sf_dir, "pages").select("page_id", "url")
    fetched = "TIMESTAMP'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, page_id)"
    return _run_to_sink(url_dedupe(pages, fetched, "365 days"), _workdir(spark, "url_dedupe", sf_dir))


_LATEST_T = "user_id bigint, event_id bigint, ts timestamp, event_type string"


def stream_edits_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user, late events included: every micro-batch is
    merged into a keyed store."""
    events = _source(spark, sf_dir, "events").select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    work = _workdir(spark, "edits_latest", sf_dir)
    store = LatestStore(spark, f"{work}/store", _LATEST_T, "user_id", ["ts", "event_id"])
    query = (
        events.writeStream.foreachBatch(store.merge)
        .option("checkpointLocation", f"{work}/chk")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read()


def gate_stream(urls: DataFrame, robots: DataFrame, user_agent: str, wait: str = "10 minutes", valid: str = "1 hour") -> DataFrame:
    """The crawl gate on streams: (page_id, url, asked_at) and robots.txt
    answers (robots_url, status, text, fetched_at) -> (page_id, url, verdict).

    An answer serves the URLs asked for from ``fetched_at`` to ``valid``
    later, and those that waited for it up to ``wait``: the robots cache of a
    crawler, bounded in time. Where several answers serve, each gives a
    verdict. URLs that no answer serves come out as ``unavailable`` once the
    watermarks of both sides have passed the time an answer could still
    come; answers and URLs later than ``wait`` behind their stream are late
    and dropped.
    """
    targets = gate_targets(urls, "page_id", "url", "asked_at").withWatermark("asked_at", wait)
    known = robots_entries(robots, "fetched_at").withColumnRenamed("robots_url", "origin").withWatermark("fetched_at", wait)
    serves = (F.col("robots_url") == F.col("origin")) & F.expr(f"fetched_at BETWEEN asked_at - INTERVAL {valid} AND asked_at + INTERVAL {wait}")
    return gate_verdicts(targets.join(known, serves, "left_outer"), user_agent)


def stream_robots_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for the page stream, the robots.txt answers of fixture R3
    arriving as a stream of their own; equals the batch ``robots_gate``. A
    page is asked for a second per page id after its origin's answer. A last
    URL and answer far ahead move both watermarks past all others."""
    from folia.plans.fixtures import ROBOTS_AGENT, r3_robots_docs

    work, start, end = _workdir(spark, "robots_gate", sf_dir), "TIMESTAMP'2026-01-01 00:00:00'", "TIMESTAMP'2036-01-01 00:00:00'"
    if not folder_names(spark, f"{work}/in"):
        pages = spark.read.parquet(os.path.join(sf_dir, "pages.parquet")).selectExpr(
            "page_id", "url", f"{start} + make_interval(0, 0, 0, 0, 0, 0, page_id) AS asked_at")
        answers = r3_robots_docs(spark, sf_dir).selectExpr("*", f"{start} AS fetched_at")
        clock = "'https://clock.invalid/robots.txt'"
        pages.unionByName(spark.sql(f"SELECT CAST(NULL AS BIGINT) AS page_id, {clock} AS url, {end} AS asked_at")).write.parquet(f"{work}/in/urls")
        answers.unionByName(spark.sql(f"SELECT {clock} AS robots_url, 200 AS status, '' AS text, {end} AS fetched_at")).write.parquet(f"{work}/in/robots")
    read = lambda name: spark.readStream.schema(spark.read.parquet(f"{work}/in/{name}").schema).parquet(f"{work}/in/{name}")
    gated = gate_stream(read("urls"), read("robots"), ROBOTS_AGENT, valid="3650 days")
    return _run_to_sink(gated, work).where("page_id IS NOT NULL").select("page_id", "verdict")
