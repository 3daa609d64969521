"""Online sessions: which are to be synchronised, attendance folded by person, and roles brought into line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import timefmt

SESSIONS_A_RUN = 50


def unsynced(sessions: DataFrame, markers: DataFrame, now: int, most: int = SESSIONS_A_RUN) -> DataFrame:
    """Finished sessions (uid, timeend, id) without a marker (sessionuid), oldest first."""
    done = sessions.where((F.coalesce("uid", F.lit("")) != "") & (F.col("timeend") > 0) & (F.col("timeend") <= now))
    return done.join(markers, F.col("uid") == F.col("sessionuid"), "left_anti").orderBy("timeend", "id").limit(most)


def folded(instances: DataFrame, summed: bool = False) -> DataFrame:
    """One row a session and person, of instances (sessionuid, instance_no, attendees as in schemas.ATTENDEES).

    People without either id are left out. Of several entries of a person the last instance's holds; summed adds up.
    """
    a = instances.select("sessionuid", "instance_no", F.posexplode("attendees").alias("at", "p")).where("p.userId IS NOT NULL AND p.externalUserId IS NOT NULL")
    joins = F.coalesce("p.attendance", F.array())
    times = lambda f: F.filter(F.transform(joins, lambda j: timefmt.iso_seconds(j[f])), lambda t: t != 0)
    one = a.select(
        "sessionuid",
        "instance_no",
        "at",
        F.col("p.userId").alias("useruid"),
        F.coalesce(F.col("p.externalUserId").try_cast("long"), F.lit(0)).alias("external_user_id"),
        F.col("p.role").alias("role"),
        F.col("p.displayName").alias("display_name"),
        F.coalesce(F.array_min(times("joined")), F.lit(0)).alias("first_join_time"),
        F.greatest(F.coalesce(F.array_max(times("left")), F.lit(0)), F.lit(0)).alias("last_left_time"),
        F.aggregate(joins, F.lit(0).cast("long"), lambda s, j: s + F.coalesce(j["duration"], F.lit(0))).alias("duration"),
        F.size(joins).alias("joins"),
    )
    who = ("useruid", "role", "display_name")
    what = ("first_join_time", "last_left_time", "duration", "joins")
    if summed:
        last = F.struct("instance_no", "at", *who)
        out = one.groupBy("sessionuid", "external_user_id").agg(F.max(last).alias("l"), F.min(F.nullif("first_join_time", F.lit(0))).alias("f"), F.max("last_left_time").alias("last_left_time"), F.sum("duration").alias("duration"), F.sum("joins").alias("joins"))
        out = out.select("sessionuid", "external_user_id", "l.useruid", "l.role", "l.display_name", F.coalesce("f", F.lit(0)).alias("first_join_time"), "last_left_time", "duration", "joins")
    else:
        last = F.struct("instance_no", "at", *who, *what)  # the greatest is combined before the shuffle
        out = one.groupBy("sessionuid", "external_user_id").agg(F.max(last).alias("l")).select("sessionuid", "external_user_id", *[F.col(f"l.{c}") for c in (*who, *what)])
    return out.withColumn("rejoins", F.greatest(F.col("joins") - 1, F.lit(0)).cast("long")).drop("joins")


def holders(assignments: DataFrame, roles: list[int], users: DataFrame) -> DataFrame:
    """Users that exist and hold any of the roles, each once."""
    return users.join(assignments.where(F.col("roleid").isin(*roles)), F.col("id") == F.col("userid"), "left_semi").select(F.col("id").alias("userid"))


def reconciled(desired: DataFrame, current: DataFrame, key: str = "userid") -> DataFrame:
    """(key, action): assign what is desired and not current, unassign what is current and not desired."""
    want, have = desired.select(key).distinct(), current.select(key).distinct()
    return want.join(have, key, "left_anti").withColumn("action", F.lit("assign")).unionByName(have.join(want, key, "left_anti").withColumn("action", F.lit("unassign")))


def adopted(tokens: DataFrame, authorised: DataFrame, key: str = "userid") -> DataFrame:
    """Token holders that aren't authorised yet."""
    return tokens.select(key).distinct().join(authorised, key, "left_anti")
