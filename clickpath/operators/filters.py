"""Session filters: a parameter record turned into Column predicates.

Predicates are plain Column expressions; Catalyst pushes the ones on source
columns (the date range) into the parquet scan and evaluates the rest inside
whole-stage codegen. A missing value on the session side never passes a
given parameter; an absent (or empty) parameter always passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SessionFilter:
    """Optional conditions on a session.

    The age range applies only when both bounds are given.
    """

    start_age: int | None = None
    end_age: int | None = None
    professionals: Sequence[int] | None = None
    cities: Sequence[int] | None = None
    sex: str | None = None
    keywords: Sequence[str] | None = None
    category_ids: Sequence[int] | None = None

    def predicates(self, lists: bool = True) -> list[Column]:
        """Column predicates; ``lists=False`` leaves out keywords and categories."""
        preds: list[Column] = []
        if self.start_age is not None and self.end_age is not None:
            preds.append(age_between(self.start_age, self.end_age))
        if self.professionals:
            preds.append(value_in("professional", self.professionals))
        if self.cities:
            preds.append(value_in("city", self.cities))
        if self.sex is not None and self.sex != "":
            preds.append(value_equals("sex", self.sex))
        if lists and self.keywords:
            preds.append(list_overlaps("keywords", self.keywords))
        if lists and self.category_ids:
            preds.append(list_overlaps("click_categories", [int(c) for c in self.category_ids]))
        return preds

    def condition(self, lists: bool = True) -> Column:
        return reduce(lambda a, b: a & b, self.predicates(lists), F.lit(True))

    @classmethod
    def from_params(cls, text: str | None) -> "SessionFilter":
        """Read a ``name=value|name=value`` task parameter string.

        A fragment counts when it has exactly one ``=`` with text on both
        sides (after trailing ``=`` are dropped); the first fragment of a name
        wins; list values are comma-separated. Date names are left to
        :func:`params_range`; any other name raises ``ValueError``.
        """
        values = param_values(text)

        def ints(name):
            raw = values.get(name)
            return [int(x) for x in raw.split(",") if x.strip() != ""] if raw else None

        def strs(name):
            raw = values.get(name)
            return [x for x in raw.split(",") if x != ""] if raw else None

        def one_int(name):
            raw = values.get(name)
            return int(raw) if raw not in (None, "") else None

        return cls(
            start_age=one_int("startAge"),
            end_age=one_int("endAge"),
            professionals=ints("professionals"),
            cities=ints("cities"),
            sex=values.get("sex") or None,
            keywords=strs("keywords"),
            category_ids=ints("categoryIds"),
        )

    def to_params(self) -> str:
        """The ``name=value|…`` parameter string of this filter (absent values left out)."""
        items = [
            ("startAge", self.start_age),
            ("endAge", self.end_age),
            ("professionals", self.professionals),
            ("cities", self.cities),
            ("sex", self.sex),
            ("keywords", self.keywords),
            ("categoryIds", self.category_ids),
        ]
        out = []
        for name, v in items:
            if v is None or v == "" or (isinstance(v, (list, tuple)) and not v):
                continue
            text = ",".join(str(x) for x in v) if isinstance(v, (list, tuple)) else str(v)
            out.append(f"{name}={text}")
        return "|".join(out)


# Parameter names of the task parameter string (fixed values).
PARAM_NAMES = ["startAge", "endAge", "professionals", "cities", "sex", "keywords", "categoryIds"]
DATE_PARAM_NAMES = ["startDate", "endDate"]


def param_values(text: str | None) -> dict[str, str]:
    """Name → value of a task parameter string; an unknown name is an error."""
    values: dict[str, str] = {}
    for frag in (text or "").split("|"):
        parts = frag.rstrip("=").split("=")
        if parts[0] and parts[0] not in PARAM_NAMES + DATE_PARAM_NAMES:
            raise ValueError(f"unknown parameter {parts[0]!r}; known: {', '.join(PARAM_NAMES + DATE_PARAM_NAMES)}")
        if len(parts) == 2 and parts[0] not in values:
            values[parts[0]] = parts[1]
    return values


def params_range(text: str | None) -> tuple[str | None, str | None]:
    """``(startDate, endDate)`` of a task parameter string, for :func:`action_range`."""
    values = param_values(text)
    return values.get("startDate"), values.get("endDate")


# The filter the analysed job runs with: age 0 to 100, nothing else.
DEFAULT_FILTER = SessionFilter(start_age=0, end_age=100)


def age_between(lo: int, hi: int, column: str = "age") -> Column:
    return F.coalesce(F.col(column).between(F.lit(lo), F.lit(hi)), F.lit(False))


def value_in(column: str, values: Sequence) -> Column:
    return F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def value_equals(column: str, value) -> Column:
    return F.coalesce(F.col(column) == F.lit(value), F.lit(False))


def list_overlaps(column: str, values: Sequence) -> Column:
    wanted = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.arrays_overlap(F.col(column), wanted), F.lit(False))


def apply_filter(sessions: DataFrame, flt: SessionFilter = DEFAULT_FILTER) -> DataFrame:
    return sessions.where(flt.condition())


def hit_flags(flt: SessionFilter) -> dict[str, Column]:
    """One Boolean aggregate per condition on a session's actions: did any action match?

    Fixed width whatever the session holds, so the session aggregate stays a
    hash aggregate and the decision needs no second pass over the log.
    """
    flags = {}
    if flt.keywords:
        kw = F.col("search_keyword")
        flags["keyword_hit"] = F.max(F.coalesce(kw.isin(list(flt.keywords)) & (kw != ""), F.lit(False)))
    if flt.category_ids:
        ids = [int(c) for c in flt.category_ids]
        flags["category_hit"] = F.max(F.coalesce(F.col("click_category_id").isin(ids), F.lit(False)))
    return flags


def apply_filter_by_flags(sessions: DataFrame, flt: SessionFilter = DEFAULT_FILTER) -> DataFrame:
    """:func:`apply_filter` for sessions aggregated with :func:`hit_flags`; drops the flags."""
    flags = list(hit_flags(flt))
    return sessions.where(reduce(lambda a, b: a & b, [F.col(c) for c in flags], flt.condition(lists=False))).drop(*flags)


def apply_filter_by_actions(sessions: DataFrame, actions: DataFrame, flt: SessionFilter = DEFAULT_FILTER) -> DataFrame:
    """:func:`apply_filter` for sessions aggregated without their keyword and
    category sets: those two conditions become left-semi joins with the
    sessions that have a matching action.

    The matching session ids are de-duplicated with a partial aggregate in
    every map task before the shuffle, so a session with a huge number of
    matching actions ships one id per task.
    """
    out = sessions.where(flt.condition(lists=False))
    if flt.keywords:
        kw = F.col("search_keyword")
        hits = actions.where(kw.isin(list(flt.keywords)) & (kw != "")).select("session_id").distinct()
        out = out.join(hits, "session_id", "left_semi")
    if flt.category_ids:
        ids = [int(c) for c in flt.category_ids]
        hits = actions.where(F.col("click_category_id").isin(ids)).select("session_id").distinct()
        out = out.join(hits, "session_id", "left_semi")
    return out


def action_range(actions: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Actions whose ``date`` text lies in ``[start_date, end_date]`` (``yyyy-MM-dd``)."""
    cond = F.lit(True)
    if start_date is not None:
        cond = cond & (F.col("date") >= F.lit(start_date))
    if end_date is not None:
        cond = cond & (F.col("date") <= F.lit(end_date))
    return actions.where(cond)


def non_null(details: DataFrame, column: str) -> DataFrame:
    """Rows that carry the given action kind (click / order / pay column)."""
    return details.where(F.col(column).isNotNull())
