"""Forms of the work that go through files of their own, and streams that are stopped or that arrive in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.operators import graph, mail, rides
from streamlab.plans.lineage import scratch_path
from streamlab.sources import bulk, readers, sinks
from streamlab.sources.sinks import batch_writer
from streamlab.streaming import operators as so
from streamlab.streaming.runs import run_available, start_query
from streamlab.workloads import batch, tables
from streamlab.workloads.registry import oracle_of, query
from streamlab.workloads.streams import FLUSH_ID, FLUSH_USER, _files, _flush_row
from streamlab.workloads.tables import Tables

FAR = "2100-01-01 00:00:00"


@query(oracle_of("mbox_to_mails"))
def mbox_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "mbox")
    # A mail in a file ends with its line feed, which the writer adds.
    t.archive.select(F.regexp_replace("value", r"\n\z", "")).write.text(path)
    return mail.mbox_to_mails(readers.read_mbox(t.spark, path))


@query(oracle_of("out_weights"))
def edge_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "edges")
    t.edges.select("src", "dst", "weight").write.csv(path, sep="\t")
    found = graph.out_weights(readers.read_edges(t.spark, path))
    return found.select("src", F.round("outWeight", 2).alias("outWeight"))


@query(oracle_of("pagerank"))
def rank_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ranks")
    sinks.write_ranks(graph.pagerank(t.edges, iterations=batch.ROUNDS), path)
    return t.spark.read.csv(path, sep="\t", schema="id STRING, rank DOUBLE").select("id", batch.rounded("rank"))


@query("SELECT n_nationkey::BIGINT * 10 AS minutes, TIMESTAMP '2024-01-01 00:00:00' AS ts FROM nation")
def control_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "controls")
    t.controls.select(F.col("minutes").cast("string")).write.text(path)
    asked = readers.read_controls(t.spark, path, "ongoing", F.lit(tables.BASE).cast("timestamp"))
    return run_available(asked, "controls").select("minutes", "ts")


@query(oracle_of("line_protocol"))
def point_files(t: Tables) -> DataFrame:
    """Points through the sink that takes bulks."""
    path = scratch_path(t.spark, "points")
    bulk.register_bulk_text(t.spark)
    points = batch.line_protocol(t).select("value")
    points.write.format("bulk_text").option("bulk", bulk.POINTS_BULK).mode("append").save(path)
    return t.spark.read.text(path)


def _ranges(events: DataFrame, parts: int) -> list[DataFrame]:
    """Consecutive ranges of event time."""
    at = F.unix_micros("ts")
    edges = events.select(F.percentile_approx(at, [k / parts for k in range(1, parts)], 10_000)).first()[0]
    place = F.size(F.filter(F.lit(edges), lambda e: e <= at))
    return [events.where(place == k) for k in range(parts)]


def _in_order(events: DataFrame, parts: int) -> list[DataFrame]:
    """Consecutive ranges of event time, a file each."""
    return [part.coalesce(1) for part in _ranges(events, parts)]


def _zoned(t: Tables) -> DataFrame:
    return t["events"].withColumn("ts", F.col("ts").cast("timestamp"))


@query(oracle_of("hourly_tip_max"))
def stream_hourly_tips_in_order(t: Tables) -> DataFrame:
    """Events in order, so that the watermark needs no delay."""
    events = _zoned(t)
    last = _flush_row(t, events, event_id=F.lit(FLUSH_ID), ts=F.lit(FAR), user_id=F.lit(FLUSH_USER), event_type=F.lit("x"), value=F.lit(0.0))
    fares = tables.fares_from_events(_files(t, "ordered", *_in_order(events, 4), last))
    found = run_available(rides.hourly_tip_max(fares.withWatermark("startTime", "0 seconds")), "in-order")
    return found.filter(F.col("driverId") != FLUSH_USER).select("windowEnd", "driverId", batch.rounded("tips"))


@query(oracle_of("long_rides"))
def stream_long_rides_restarted(t: Tables) -> DataFrame:
    """Half of the events, a stop, and the rest with the same checkpoint: open rides are remembered."""
    events = _zoned(t)
    source, out, checkpoint = (scratch_path(t.spark, f"restart-{name}") for name in ("in", "out", "checkpoint"))
    first, second = _ranges(events, 2)
    last = _flush_row(t, events, event_id=F.lit(FLUSH_ID), ts=F.lit(FAR), user_id=F.lit(FLUSH_USER), event_type=F.lit("x"), value=F.lit(0.0))
    for part in (first, second.unionByName(last)):
        part.write.mode("append").parquet(source)
        stream = t.spark.readStream.schema(events.schema).parquet(source)
        found = so.long_rides(tables.rides_from_events(stream), delay="1 minute")
        start_query(found, batch_writer(out, "parquet"), checkpoint, once=True).awaitTermination()
    answers = t.spark.read.schema(found.schema).parquet(f"{out}/*")
    return answers.filter(F.col("taxiId") != FLUSH_USER).select("rideId", "taxiId", "eventTime")
