"""Times: microsecond epochs, RFC 3339 strings, date buckets, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY = 86_400
# Fixed format: what the names of buffer files look like.
FILE_NAME = r"^events-(\d+)-(\d+)(?:-([0-9a-z]+))?(?:-h([0-9a-f]+))?\.jsonl(?:\.closed|\.pulled)?$"


def micros(ntz: Column) -> Column:
    """Microseconds since the epoch of a zoneless time, taken as UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ntz)


def seconds(us: Column) -> Column:
    """Whole seconds of microseconds, cut towards zero."""
    return F.expr("bigint(0)") + F.when(us < 0, -F.floor(-us / MICROS)).otherwise(F.floor(us / MICROS)).cast("long")


def date_bucket(us: Column) -> Column:
    """UTC day of microseconds as yyyy/MM/dd."""
    days = F.floor(seconds(us) / DAY).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyy/MM/dd")


def rfc3339(us: Column) -> Column:
    """UTC time with six digits of a second; microseconds of 1,000,000 have carried, as us is one number."""
    second = F.floor(us / MICROS).cast("long")
    in_day = F.pmod(second, F.lit(DAY))
    day = F.date_from_unix_date(F.floor(second / DAY).cast("int"))
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(in_day / 3600)), two(F.floor(F.pmod(in_day, F.lit(3600)) / 60)), two(F.pmod(in_day, F.lit(60))))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), clock, F.lit("."), F.lpad(F.pmod(us, F.lit(MICROS)).cast("string"), 6, "0"), F.lit("Z"))


def rfc3339_whole(us: Column) -> Column:
    return F.concat(F.substring(rfc3339(us), 1, 19), F.lit("Z"))


def iso_seconds(text: Column) -> Column:
    """Epoch seconds of an ISO-8601 UTC time; 0 if it can't be read."""
    plain = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(?:\.\d+)?(?:Z|\+00:00)?$", 0)
    cut = F.concat_ws(" ", F.substring(plain, 1, 10), F.substring(plain, 12, 8))
    read = F.try_to_timestamp(F.when(plain != "", F.concat(cut, F.lit("+00:00"))), F.lit("yyyy-MM-dd HH:mm:ssXXX"))
    return F.coalesce(F.unix_seconds(read), F.lit(0)).cast("long")


def parsed_file_name(path: Column) -> Column:
    """{pid, created_us, token, hostid} of a buffer file's name, or null for a name that isn't one."""
    name = F.substring_index(path, "/", -1)
    part = lambda i: F.regexp_extract(name, FILE_NAME, i)
    found = F.struct(
        part(1).try_cast("long").alias("pid"),
        part(2).try_cast("long").alias("created_us"),
        F.nullif(part(3), F.lit("")).alias("token"),
        F.nullif(part(4), F.lit("")).alias("hostid"),
    )
    return F.when(name.rlike(FILE_NAME), found)
