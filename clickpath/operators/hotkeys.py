"""De-duplicated user join for any distribution of users, from one reading of the sessions.

The users that hold a large share of the sessions are found by a mergeable frequent-items
sketch in one aggregate: it keeps at most ``TRACKED`` candidates whatever the number of users,
and reports every user above ``1 / TRACKED`` of the rows (its counts are never too low by more
than that). Sessions of these users get a salt, and each of their single rows is repeated
once per salt; all other rows have salt 0. The join on (user, salt) is then a plain shuffle join
in which no key holds more than about ``HOT_SHARE`` of the sessions. A user that the sketch
reports wrongly costs some repeated rows, never a result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.operators.sessions import USER_ATTRIBUTES

#: a user with this share of the sessions or more is hot
HOT_SHARE = 0.001
#: candidates that the sketch keeps, and users reported at most
TRACKED, REPORTED = 10_000, 1_000


def hot_users(sessions: DataFrame, share: float = HOT_SHARE) -> dict[int, int]:
    """Hot users and the number of parts that bring each of them below ``share`` of the sessions; one
    aggregate over ``sessions``. The parts of all users are ``1 / share + REPORTED`` at most."""
    found = sessions.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(user_id, {REPORTED}, {TRACKED})").alias("top")).first()
    least = max(2.0, share * found["n"])
    return {r["item"]: math.ceil(r["count"] / least) for r in found["top"] or [] if r["item"] is not None and r["count"] >= least}


def attach_users_salted(sessions: DataFrame, users: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Sessions with the attributes of their user, one row each (the rows of ``sessions.dedupe_users``); sessions
    of unknown users drop out. ``sessions`` is read for the sketch and for the join: pass a written table."""
    hot = hot_users(sessions, share)
    entries = [F.lit(x) for item in sorted(hot.items()) for x in item]
    wanted = F.coalesce(F.create_map(*entries)[F.col("user_id")], F.lit(1)) if hot else F.lit(1)
    columns = [c for c in sessions.columns if c not in USER_ATTRIBUTES]
    left = sessions.select(*columns).withColumn("_salt", F.pmod(F.xxhash64("session_id"), wanted).cast("int"))
    # the smallest row of each user; a user with very many rows is cut down before the exchange (group limit)
    own = Window.partitionBy("user_id").orderBy(*[c for c in users.columns if c != "user_id"])
    single = users.withColumn("_place", F.row_number().over(own)).where("_place = 1")
    right = single.select("user_id", *USER_ATTRIBUTES).withColumn("_salt", F.explode(F.sequence(F.lit(0), (wanted - 1).cast("int"))))
    return left.join(right, ["user_id", "_salt"]).select(*columns, *USER_ATTRIBUTES)
