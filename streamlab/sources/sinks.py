"""Writers and their encoders. Encoders return DataFrames, so any Spark sink can take the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.functions import rides as rx
from streamlab.operators.mail import FIELD_DELIMITER, RECORD_DELIMITER
from streamlab.schemas import MAIL_COLUMNS

# Names in the target systems.
CLEANSED_TOPIC = "cleansedRides"
PLACES_INDEX = "nyc-places"
PLACES_TYPE = "popular-locations"


def encode_rides(rides: DataFrame) -> DataFrame:
    """Rides as message values. END rows are written end time first, so that decoding gives the
    same row back."""
    return rides.select(rx.ride_text(end_time_first=True).alias("value"))


def encode_fares(fares: DataFrame) -> DataFrame:
    return fares.select(rx.fare_text().alias("value"))


def to_place_documents(places: DataFrame) -> DataFrame:
    """Popular places as JSON documents of strings, with a key that makes rewriting harmless."""
    time = F.unix_millis("windowEnd").cast("string")
    location = F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string"))
    document = F.to_json(
        F.struct(
            time.alias("time"),
            location.alias("location"),
            F.col("isStart").cast("string").alias("isStart"),
            F.col("cnt").cast("string").alias("cnt"),
        )
    )
    return places.select(
        F.concat_ws("|", time, location, F.col("isStart").cast("string")).alias("id"),
        document.alias("document"),
    )


def to_line_protocol(
    df: DataFrame,
    measurement: str,
    ts: Column,
    value: Column,
    field: str = "value",
    key: Column | None = None,
) -> DataFrame:
    """Time-series points as text: ``measurement[,key=k] field=v ms``."""
    def escaped(c: Column) -> Column:
        return F.regexp_replace(c.cast("string"), "([,= ])", "\\\\$1")

    tag = F.lit("") if key is None else F.concat(F.lit(",key="), escaped(key))
    return df.select(
        F.concat(
            F.lit(measurement),
            tag,
            F.lit(f" {field}="),
            value.cast("string"),
            F.lit(" "),
            F.unix_millis(ts).cast("string"),
        ).alias("value")
    )


def encode_mails(mails: DataFrame) -> DataFrame:
    fields = [F.coalesce(F.col(c), F.lit("")) for c in MAIL_COLUMNS]  # each keeps its place
    return mails.select(F.concat_ws(FIELD_DELIMITER, *fields).alias("value"))


def write_mails(mails: DataFrame, path: str) -> None:
    encode_mails(mails).write.option("lineSep", RECORD_DELIMITER).text(path)


def write_ranks(ranks: DataFrame, path: str) -> None:
    ranks.write.csv(path, sep="\t")


def write_documents(
    docs: DataFrame, path: str, index: str = PLACES_INDEX, batch: str | int = "all"
) -> None:
    """Write to the batch's own folder of the index: a retried batch replaces itself, no other one."""
    docs.select("document").write.mode("overwrite").text(f"{path}/{index}/batch={batch}")


def document_writer(path: str, index: str = PLACES_INDEX) -> Callable[[DataFrame, int], None]:
    """The same as a ``foreachBatch`` function."""
    return lambda batch, batch_id: write_documents(batch, path, index, batch_id)


def batch_writer(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: each micro-batch owns one folder, so a retry replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return write
