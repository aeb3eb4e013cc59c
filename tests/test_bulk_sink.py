"""The bulk sink: whole bulks, nothing of failed jobs, nothing twice."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from streamlab.sources import bulk


def lines(folder):
    return sorted(line for f in Path(folder).rglob("*.txt") for line in f.read_text().splitlines())


@pytest.fixture
def sink(spark, tmp_path):
    bulk.register_bulk_text(spark)
    return str(tmp_path / "out")


def save(df, path, mode="append", rows=10):
    df.write.format("bulk_text").option("bulk", rows).mode(mode).save(path)


def test_append_overwrite_and_nulls(spark, sink):
    some = spark.range(25).select(F.col("id").cast("string").alias("value")).repartition(3)
    save(some, sink)
    save(spark.createDataFrame([("more",), (None,), ("",)], "value string"), sink)
    assert lines(sink) == sorted([*map(str, range(25)), "more", ""])
    assert not (Path(sink) / bulk.STAGED).is_dir() or not list((Path(sink) / bulk.STAGED).iterdir())
    save(some.limit(0), sink)
    assert len(lines(sink)) == 27
    save(spark.createDataFrame([("only",)], "value string"), sink, "overwrite")
    assert lines(sink) == ["only"]
    with pytest.raises(Exception, match="one text column named value"):
        save(spark.range(3), sink)


def test_failed_job_leaves_nothing(spark, sink):
    save(spark.createDataFrame([("kept",)], "value string"), sink)
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("value")
    )
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="broken"):
            save(broken, sink, mode)
        assert lines(sink) == ["kept"]


def test_attempts_that_do_not_count_are_not_published(tmp_path):
    """A task may run twice; only the attempt whose message arrives is moved, in bulks of ten."""
    import pyarrow as pa

    writer = bulk.BulkWriter(str(tmp_path), 10, False)
    rows = pa.RecordBatch.from_pydict({"value": [str(i) for i in range(25)]})
    lost, counted = writer.write(iter([rows])), writer.write(iter([rows.slice(0, 12), rows.slice(12)]))
    assert (counted.rows, counted.bulks) == (25, 3) and lost.staged != counted.staged
    assert not list(tmp_path.glob("*.txt"))
    writer.commit([counted, None])
    assert lines(tmp_path) == sorted(map(str, range(25)))
    stream = bulk.BulkStreamWriter(str(tmp_path / "s"), 10, False)
    stream.commit([stream.write(iter([rows]))], 4)
    again = bulk.BulkStreamWriter(str(tmp_path / "s"), 10, False)  # the batch runs again after a restart
    again.commit([again.write(iter([rows.slice(5)]))], 4)
    assert lines(tmp_path / "s") == sorted(map(str, range(5, 25)))


def test_stream(spark, sink, tmp_path):
    source = str(tmp_path / "in")
    df = spark.range(30).select(F.col("id").cast("string").alias("value"))
    df.write.text(source)

    def run():
        stream = spark.readStream.schema("value string").text(source)
        out = stream.writeStream.format("bulk_text").option("path", sink).option("checkpointLocation", str(tmp_path / "cp"))
        out.trigger(availableNow=True).start().awaitTermination(120)

    run()
    assert lines(sink) == sorted(map(str, range(30)))
    df.selectExpr("concat('x', value) AS value").write.mode("append").text(source)
    run()
    assert len(lines(sink)) == 60 and len(set(lines(sink))) == 60
