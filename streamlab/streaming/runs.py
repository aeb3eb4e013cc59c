"""Starting streaming queries, and questions answered per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from streamlab.operators import control
from streamlab.plans.lineage import scratch_path
from streamlab.sources.sinks import batch_writer
from streamlab.streaming import operators


def start_query(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    once: bool = False,
    every: str = "1 second",
    name: str | None = None,
) -> StreamingQuery:
    """Run ``write`` on every micro-batch. ``checkpoint`` is the query's own folder on shared storage;
    starting again with it continues where the query stopped."""
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    if name:
        writer = writer.queryName(name)
    return writer.foreachBatch(write).start()


def console(df: DataFrame, output_mode: str = "append") -> StreamingQuery:
    return df.writeStream.format("console").outputMode(output_mode).start()


def run_available(df: DataFrame, label: str = "run", output_mode: str = "append") -> DataFrame:
    """Process all input there is, and return what came out (with its micro-batch in ``batch``)."""
    spark = df.sparkSession
    out, checkpoint = scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-checkpoint")
    start_query(df, batch_writer(out, "parquet"), checkpoint, output_mode, once=True).awaitTermination()
    schema = StructType([*df.schema.fields, StructField("batch", IntegerType())])
    return spark.read.schema(schema).option("basePath", out).parquet(f"{out}/*")


def start_with_late(
    df: DataFrame, out: str, late_out: str, checkpoint: str, once: bool = False, fmt: str = "parquet"
) -> StreamingQuery:
    """Start a stream that marks its late rows (column ``late``): they go to ``late_out`` and the others to
    ``out``, without the mark. Each micro-batch has a folder of its own in both, so a retry replaces it."""
    write, write_late = batch_writer(out, fmt), batch_writer(late_out, fmt)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch.where("NOT late").drop("late", "behindMs"), batch_id)
            write_late(batch.where("late").drop("late", "seq"), batch_id)
        finally:
            batch.unpersist()

    return start_query(df, step, checkpoint, once=once)


def run_taxi_query(
    rides: DataFrame,
    controls: DataFrame,
    out: str,
    checkpoint: str,
    delay: str = "60 seconds",
    buckets: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """User predicates over a ride stream (see ``control.taxi_query``), with the same rows.

    Rides and questions may come up to ``delay`` late and in any order. Which rows a question is put to
    is decided in state; the questions themselves are evaluated per micro-batch, whose answers go to a
    folder of its own under ``out``.
    """
    found = operators.taxi_query_candidates(rides, controls, delay, buckets)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            control.decide_candidates(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            batch.unpersist()

    return start_query(found, step, checkpoint, once=once)
