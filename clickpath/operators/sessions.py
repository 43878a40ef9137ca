"""Session aggregation, user enrichment and session detail rows.

Plan shape at scale: ``aggregate_sessions`` is one hash aggregate keyed by
``session_id`` with a map-side partial step, so a session holding a third of
all actions is pre-reduced in every map task before the shuffle; its list
columns are per-session *sets* (bounded by the distinct keywords/categories),
never per-row lists. Joins with users and actions are plain equi-joins:
AQE measures the shuffled sides at run time, broadcasts a side that turns
out small and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.functions.dates import format_time, ntz_literal, seconds_between
from clickpath.schemas import DETAIL_COLUMNS

SESSION_COLUMNS = [
    "session_id",
    "user_id",
    "start_time",
    "end_time",
    "visit_length",
    "step_length",
    "keywords",
    "click_categories",
]
USER_ATTRIBUTES = ["age", "professional", "city", "sex"]
LIST_COLUMNS = ["keywords", "click_categories"]
# Join sides with a proven row bound (top-k, sample, ranked sessions) are
# broadcast up to this many rows; larger ones are left to AQE, which measures
# them at run time.
BROADCAST_ROWS = 1_000_000


_DEC = "decimal(38,0)"
_USER_BITS = 29  # user ids below 2^29 share a 64-bit key with whole epoch seconds below 2^34
_SECOND_LIMIT = 2**34


def first_user(t: Column, user: Column) -> Column:
    """User id of the earliest action; ties go to the smallest id.

    Implemented as the minimum of a (time, user) key, in two fixed-width
    buffers so the session aggregate stays a plain ``HashAggregate`` (a
    struct minimum would force a sort-based aggregate):

    * ``long`` key ``seconds << 29 | user`` for actions at a whole second in
      1970..2514 with ``0 <= user < 2^29`` (every table here);
    * ``decimal(38,0)`` key ``micros * 2^64 + (user + 2^63)`` for all others,
      computed only for those rows (decimal arithmetic is several times
      slower per row).

    The two minima are decoded and compared once per session. Actions
    without time or user are not considered.
    """
    epoch = ntz_literal("1970-01-01 00:00:00")
    # seconds.micros since the epoch as a long-backed decimal: zone-free interval
    # arithmetic, cheaper per row than timestamp_diff
    exact = (t - epoch).cast("interval second").try_cast("decimal(18,6)")
    secs = exact.cast("long")
    known = t.isNotNull() & user.isNotNull()
    packable = (
        exact.isNotNull()
        & (exact == secs)
        & secs.between(0, _SECOND_LIMIT - 1)
        & user.between(0, 2**_USER_BITS - 1)
    )
    span = F.lit(str(2**64)).cast(_DEC)
    offset = F.lit(str(2**63)).cast(_DEC)
    micros = F.timestamp_diff("MICROSECOND", epoch, t)  # evaluated for the wide rows only
    small = F.min(F.when(known & packable, F.shiftleft(secs, _USER_BITS) + user))
    wide = F.min(F.when(known & ~packable, micros.cast(_DEC) * span + (user.cast(_DEC) + offset)))
    # decode once per session
    small_micros = F.shiftright(small, _USER_BITS) * 1_000_000
    small_user = F.pmod(small, F.lit(2**_USER_BITS))
    wide_micros = ((wide - F.pmod(wide, span)) / span).cast("long")
    wide_user = (F.pmod(wide, span) - offset).cast("long")
    small_first = (small_micros < wide_micros) | ((small_micros == wide_micros) & (small_user < wide_user))
    return (
        F.when(wide.isNull(), small_user)
        .when(small.isNull(), wide_user)
        .when(small_first, small_user)
        .otherwise(wide_user)
    )


def aggregate_sessions(actions: DataFrame, with_lists: bool = True, flags: dict[str, Column] | None = None) -> DataFrame:
    """One row per session.

    ``user_id``       user of the earliest action (ties: smallest id)
    ``start_time``    first / ``end_time`` last action time
    ``visit_length``  whole seconds between them
    ``step_length``   number of actions
    ``keywords``      sorted distinct non-empty search keywords
    ``click_categories`` sorted distinct clicked category ids

    ``with_lists=False`` leaves out the two set columns: the aggregate is then
    a plain ``HashAggregate`` of fixed-width buffers, whatever the size of a
    session (see :func:`attach_lists` to add the sets to selected sessions).
    ``flags`` are further aggregates by name (see ``filters.hit_flags``).
    """
    t = F.col("action_time")
    aggs = [
        first_user(t, F.col("user_id")).alias("user_id"),
        F.min(t).alias("start_time"),
        F.max(t).alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    cols = [c for c in SESSION_COLUMNS if with_lists or c not in LIST_COLUMNS]
    if with_lists:
        aggs += _list_aggs()
    for name, flag in (flags or {}).items():
        aggs.append(flag.alias(name))
        cols.append(name)
    return (
        actions.groupBy("session_id")
        .agg(*aggs)
        .withColumn("visit_length", seconds_between("start_time", "end_time"))
        .select(*cols)
    )


def _list_aggs() -> list[Column]:
    kw = F.col("search_keyword")
    return [
        F.array_sort(F.collect_set(F.when(kw != "", kw))).alias("keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_categories"),
    ]


def attach_lists(sessions: DataFrame, actions: DataFrame, max_broadcast_rows: int | None = None) -> DataFrame:
    """Add ``keywords`` / ``click_categories`` to the given sessions only.

    Used for a few selected sessions (a sample): their actions are picked by a
    semi join (the session ids are broadcast when ``max_broadcast_rows``
    bounds them below ``BROADCAST_ROWS``) and aggregated; sessions without
    actions get empty sets.
    """
    bounded = max_broadcast_rows is not None and max_broadcast_rows <= BROADCAST_ROWS
    ids = sessions.select("session_id").distinct()
    if bounded:
        ids = F.broadcast(ids)
    lists = actions.join(ids, "session_id", "left_semi").groupBy("session_id").agg(*_list_aggs())
    if bounded:
        lists = F.broadcast(lists)  # one row per selected session
    empty_kw = F.array().cast("array<string>")
    empty_cat = F.array().cast("array<bigint>")
    return sessions.join(lists, "session_id", "left").withColumn(
        "keywords", F.coalesce("keywords", empty_kw)
    ).withColumn("click_categories", F.coalesce("click_categories", empty_cat))


def dedupe_users(users: DataFrame) -> DataFrame:
    """One row per ``user_id`` (the smallest attribute tuple), for data whose ids repeat."""
    others = [c for c in users.columns if c != "user_id"]
    best = F.min(F.struct(*others))
    return users.groupBy("user_id").agg(best.alias("_u")).select("user_id", *[F.col(f"_u.{c}").alias(c) for c in others])


# With de-duplicated users, a user holding at least this share of all sessions is
# joined through a broadcast (at most 1 / HOT_USER_SHARE such users).
HOT_USER_SHARE = 0.001


def attach_users(sessions: DataFrame, users: DataFrame, dedupe: bool = False) -> DataFrame:
    """Inner join on ``user_id`` adding age, professional, city and sex.

    Sessions of unknown users drop out. Repeated user ids multiply the
    session row, as the analysed job does, unless ``dedupe`` is set.

    Skew: without ``dedupe`` both join inputs are plain shuffles and AQE splits
    a hot user's partition. The de-duplicated user table is an aggregate
    already partitioned by ``user_id``, which AQE cannot split, so with
    ``dedupe`` the hot users (at least ``HOT_USER_SHARE`` of the sessions each,
    hence at most ``1 / HOT_USER_SHARE`` of them) are joined through a broadcast
    of their rows and only the other sessions are shuffled. ``sessions`` is
    then read several times: pass a materialised table.
    """
    cols = [c for c in sessions.columns if c not in USER_ATTRIBUTES]
    if not dedupe:
        return sessions.join(users.select("user_id", *USER_ATTRIBUTES), "user_id", "inner").select(
            *cols, *USER_ATTRIBUTES
        )
    u = dedupe_users(users).select("user_id", *USER_ATTRIBUTES)
    total = sessions.select(F.count(F.lit(1))).scalar()
    per_user = sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(
        per_user.where(F.col("_n") * F.lit(int(round(1 / HOT_USER_SHARE))) >= total).select("user_id")
    )
    hot_rows = F.broadcast(u.join(hot, "user_id", "left_semi"))
    hot_part = sessions.join(hot, "user_id", "left_semi").join(hot_rows, "user_id", "inner")
    cold_part = sessions.join(hot, "user_id", "left_anti").join(u, "user_id", "inner")
    return hot_part.select(*cols, *USER_ATTRIBUTES).unionByName(cold_part.select(*cols, *USER_ATTRIBUTES))


def full_sessions(actions: DataFrame, users: DataFrame, dedupe: bool = False, with_lists: bool = True) -> DataFrame:
    """Aggregate per session, then enrich with the user's attributes."""
    return attach_users(aggregate_sessions(actions, with_lists), users, dedupe)


def render_sessions(sessions: DataFrame) -> DataFrame:
    """Text form of the session columns: times and comma-joined lists."""
    cols = []
    for name in sessions.columns:
        if name in ("start_time", "end_time"):
            cols.append(format_time(name).alias(name))
        elif name == "keywords":
            cols.append(F.array_join("keywords", ",").alias("search_keywords"))
        elif name == "click_categories":
            cols.append(F.array_join(F.col("click_categories").cast("array<string>"), ",").alias("click_category_ids"))
        else:
            cols.append(F.col(name))
    return sessions.select(*cols)


def session_details(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """All actions of the given sessions (inner join on ``session_id``).

    A session listed twice yields its actions twice.
    """
    return actions.join(sessions.select("session_id"), "session_id", "inner")


def weighted_details(sessions: DataFrame, actions: DataFrame) -> DataFrame:
    """The actions of the given sessions, each once, with ``copies`` = how often
    its session is listed.

    Same information as :func:`session_details` without materialising the
    fan-out (a user id repeated in the user table lists a session several
    times): counts over the result use ``sum(copies)``, and detail outputs
    expand rows with :func:`expand_copies`.

    Skew: a session may hold a third of all actions. AQE splits such a
    partition of a sort-merge join only when both join inputs are plain
    shuffles; an aggregate already partitioned by ``session_id`` on one side
    hides that shape. So the copies are counted per (session, user) (the
    user is fixed per session, the counts are the same), which leaves them
    partitioned by both keys: the join shuffles the small copies table once
    more and AQE can split the hot session's actions over several tasks.
    """
    key = ["session_id", "user_id"] if "user_id" in sessions.columns else ["session_id"]
    copies = sessions.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).select("session_id", "copies")
    return actions.join(copies, "session_id", "inner")


def weight(df: DataFrame) -> Column:
    """Row weight: ``copies`` of a weighted detail table, else 1."""
    return F.col("copies") if "copies" in df.columns else F.lit(1).cast("long")


def expand_copies(df: DataFrame) -> DataFrame:
    """Repeat every row ``copies`` times and drop the column (no-op without it)."""
    if "copies" not in df.columns:
        return df
    rep = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    return df.select("*", rep).drop("_copy", "copies")


def detail_record(details: DataFrame, *keep: str) -> DataFrame:
    """Per-action output record with the action time as text (weighted rows are expanded)."""
    details = expand_copies(details)
    cols: list[Column | str] = [F.col(c) for c in keep]
    for c in DETAIL_COLUMNS:
        cols.append(format_time(c).alias(c) if c == "action_time" else F.col(c))
    return details.select(*cols)
