"""What comes in by calls, once it is stored: page beacons, and sessions with their attendees, as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ATTENDEES

MOST_BEACON = 8192
BEACON = "userid long, record_type string, page string, timespent_ms long, started_at string, contextid long, courseid long, url string, media_id string, media_kind string, media_pos_sec long, bucket_sec long"


def beacons(lines: DataFrame, column: str = "value") -> DataFrame:
    """Beacons of JSON bodies within the size limit; a body that can't be read is left out, a field that can't is null."""
    fits = lines.where(F.octet_length(column) <= MOST_BEACON)
    return fits.withColumn("b", F.from_json(column, BEACON)).where(F.json_object_keys(column).isNotNull()).select("b.*")


def attendees(spark: SparkSession, path: str) -> DataFrame:
    """(sessionuid, instance_no, attendees) of stored answers, one JSON object a line."""
    rows = spark.read.schema(f"sessionuid string, instance_no int, results {ATTENDEES}").json(path)
    return rows.select("sessionuid", "instance_no", F.col("results").alias("attendees"))


def scheduled(tasks: DataFrame, name: str = "classname") -> DataFrame:
    """Scheduled tasks in the order of their class names."""
    return tasks.orderBy(name)


def claims(header: Column, payload: Column) -> Column:
    """The signing input of a token: both parts in URL-safe base64."""
    from tidemark.functions.identity import base64url

    return F.concat_ws(".", base64url(F.encode(header, "UTF-8")), base64url(F.encode(payload, "UTF-8")))
