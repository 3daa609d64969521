"""Time on pages and in media: validation, attribution to context, buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import classify, text

MOST_MS = 14_400_000
STARTED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


def _word(value: Column, known: tuple[str, ...], default: str) -> Column:
    return F.when(value.isin(*known), value).otherwise(F.lit(default))


def validated(beacons: DataFrame, now: str, most_ms: int = MOST_MS, media: bool = False) -> DataFrame:
    """Beacons (record_type, page, timespent_ms, started_at, url, media_*, bucket_sec) within their vocabularies and bounds.

    Media beacons are dropped where media aren't tracked.
    """
    kind = _word(F.col("record_type"), ("page_dwell", "media_segment"), "page_dwell")
    out = beacons.withColumn("record_type", kind)
    if not media:
        out = out.where("record_type <> 'media_segment'")
    is_media = F.col("record_type") == "media_segment"
    number = lambda c, d: F.coalesce(F.col(c), F.lit(d)).cast("long")
    return out.withColumns(
        {
            "page": _word(F.col("page"), classify.PAGES, "other"),
            "timespent_ms": F.least(F.greatest(number("timespent_ms", 0), F.lit(0)), F.lit(most_ms)),
            "started_at": F.when(F.col("started_at").rlike(STARTED), F.col("started_at")).otherwise(F.lit(now)),
            "url": text.cut_bytes(F.coalesce("url", F.lit("")), 2048),
            "media_id": F.when(is_media, text.cut_bytes(F.coalesce("media_id", F.lit("")), 255)),
            "media_kind": F.when(is_media, _word(F.col("media_kind"), classify.MEDIA, "video")),
            "media_pos_sec": F.when(is_media, F.greatest(number("media_pos_sec", 0), F.lit(0))),
            "bucket_sec": F.when(is_media, F.greatest(number("bucket_sec", 30), F.lit(1))),
        }
    )


def attributed(dwell: DataFrame, contexts: DataFrame, access: DataFrame, site_course: int = 1) -> DataFrame:
    """dwell (userid, contextid, courseid as claimed) with level, instance and course from the context.

    contexts: id, contextlevel, instanceid, courseid; access: userid, courseid. A context that doesn't exist is
    discarded; without a course in it the claimed one stands; a course that the user can't see, or that doesn't exist,
    takes all attribution with it, and the time stays.
    """
    c = contexts.select(F.col("id").alias("_cid"), F.col("contextlevel").alias("_level"), F.col("instanceid").alias("_instance"), F.col("courseid").alias("_course"))
    joined = dwell.join(c, (F.col("contextid") == F.col("_cid")) & (F.col("contextid") > 0), "left")
    found = F.col("_cid").isNotNull()
    derived = F.when(F.col("_course") != site_course, F.col("_course"))
    claimed = F.when((F.col("courseid") > 0) & (F.col("courseid") != site_course), F.col("courseid"))
    joined = joined.withColumn("_want", F.coalesce(derived, claimed)).withColumn("_found", found)
    a = access.select(F.col("userid").alias("_u"), F.col("courseid").alias("_c")).distinct().withColumn("_sees", F.lit(True))
    seen = joined.join(a, (F.col("userid") == F.col("_u")) & (F.col("_want") == F.col("_c")), "left")
    keeps = F.col("_want").isNull() | F.coalesce("_sees", F.lit(False))
    value = lambda x: F.when(keeps & F.col("_found"), x).otherwise(F.lit(0))
    own = [F.col(n) for n in dwell.columns if n not in ("contextid", "courseid")]
    return seen.select(*own, F.when(keeps, F.col("_want")).alias("courseid"), value(F.col("contextid")).alias("contextid"), value(F.col("_level")).alias("contextlevel"), value(F.col("_instance")).alias("contextinstanceid"))


def media_changes(positions: DataFrame, player: list[str], order: list[str], position: Column, bucket: int = 30) -> DataFrame:
    """Positions at which playback enters another bucket; not the first."""
    rows = positions.withColumn("bucket", F.floor(position / max(5, bucket)).cast("long"))
    last = F.lag("bucket").over(Window.partitionBy(*player).orderBy(*order))
    return rows.withColumn("previous", last).where("previous IS NOT NULL AND previous <> bucket")
