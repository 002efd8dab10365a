"""Planning of sources: months, years, bisection of over-full date ranges, id segments."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import bounded_rows

LIMIT, MAX_DAYS = 10_000, 200_000
FIRST_DAY, LAST_DAY = "19000101", "20991231"


@dataclass(frozen=True)
class Window:
    """What one remote query covers; open ends are None."""

    pub_from: str | None = None
    pub_to: str | None = None
    reg_from: str | None = None
    reg_to: str | None = None

    def label(self) -> str:
        parts = []
        if self.pub_from or self.pub_to:
            parts.append(f"pub={self.pub_from or '*'}~{self.pub_to or '*'}")
        if self.reg_from or self.reg_to:
            parts.append(f"reg={self.reg_from or '*'}~{self.reg_to or '*'}")
        return " ".join(parts)


@dataclass(frozen=True)
class Slice:
    window: Window
    count: int


def months(first: str, last: str) -> list[str]:
    """All YYYYMM from first to last."""
    a, b = int(first[:4]) * 12 + int(first[4:6]) - 1, int(last[:4]) * 12 + int(last[4:6]) - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(a, b + 1)]


def month_ranges(start_year: int | None = None, end_year: int | None = None, span: int = 5, today: date | None = None) -> list[tuple[str, str]]:
    """One-month windows of the years; an end in the present year or later is cut at the present month."""
    now = today or date.today()
    last = (now.year, now.month) if end_year is None or end_year >= now.year else (end_year, 12)
    first = last[0] - span + 1 if start_year is None else start_year
    if first > last[0]:
        raise ValueError("the first year lies after the last")
    return [(m, m) for m in months(f"{first:04d}01", f"{last[0]:04d}{last[1]:02d}")]


def recent_years(span: int = 5, year: int | None = None) -> tuple[int, ...]:
    y = year or date.today().year
    return tuple(range(y - span + 1, y + 1))


def search_years(year: int | None = None) -> tuple[int, ...]:
    y = year or date.today().year
    return tuple(range(y - 5, y + 2))


def _day(s: str) -> date:
    return datetime.strptime(s, "%Y%m%d").date()


def bisect_days(first: str, last: str) -> tuple[tuple[str, str], tuple[str, str]]:
    a, b = _day(first), _day(last)
    if a >= b:
        raise ValueError("a single day can't be divided")
    mid = a + timedelta(days=(b - a).days // 2)
    return (first, mid.strftime("%Y%m%d")), ((mid + timedelta(days=1)).strftime("%Y%m%d"), last)


def plan(window: Window, probe: Callable[[Window], int], limit: int = LIMIT) -> list[Slice]:
    """Windows of at most ``limit`` records each: by months first, then by halving days of registration.  Empty ones go."""
    n = probe(window)
    if n <= limit:
        return [Slice(window, n)] if n else []
    if window.pub_from and window.pub_to and window.pub_from != window.pub_to:
        return [s for m in months(window.pub_from, window.pub_to) for s in plan(Window(m, m), probe, limit)]
    a, b = window.reg_from or FIRST_DAY, window.reg_to or LAST_DAY
    if (window.reg_from, window.reg_to) != (a, b):
        return plan(Window(window.pub_from, window.pub_to, a, b), probe, limit)
    if a == b:
        raise RuntimeError(f"a single day holds {n} records, more than a query may return: {window.label()}")
    return [s for x, y in bisect_days(a, b) for s in plan(Window(window.pub_from, window.pub_to, x, y), probe, limit)]


def bisect_histogram(daily: DataFrame, limit: int) -> list[tuple[date, date, int]]:
    """The same halving for data at rest, over a table of days: d (date), n (rows).  -> (first day, last day, rows).

    Only the histogram reaches the driver: one row per day, at most MAX_DAYS of them; records are never looked at.
    """
    days = sorted((r["d"], r["n"]) for r in bounded_rows(daily.filter("d is not null").select("d", "n"), MAX_DAYS, "days"))
    sums = list(accumulate((n for _, n in days), initial=0))
    keys = [d for d, _ in days]

    def count(a: date, b: date) -> int:
        return sums[bisect_right(keys, b)] - sums[bisect_left(keys, a)]

    out: list[tuple[date, date, int]] = []
    todo = [(keys[0], keys[-1])] if keys else []
    while todo:
        a, b = todo.pop()
        n = count(a, b)
        if n > limit and a < b:
            mid = a + timedelta(days=(b - a).days // 2)
            todo += [(mid + timedelta(days=1), b), (a, mid)]
        elif n:
            out.append((a, b, n))
    return out


def id_segments(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """At most ``parts`` contiguous ranges of even width from low to high."""
    n = max(1, min(parts, high - low + 1))
    width = -(-(high - low + 1) // n)
    return [(a, min(a + width - 1, high)) for a in range(low, high + 1, width)]


def with_segment(df: DataFrame, id_col: str, parts: int) -> DataFrame:
    """Adds ``segment``: 0-based number of the row's range among ``parts`` even ranges of the table's ids."""
    b = df.agg(F.coalesce(F.min(id_col), F.lit(0)).alias("lo"), F.coalesce(F.max(id_col), F.lit(0)).alias("hi")).first()
    n = max(1, min(parts, b["hi"] - b["lo"] + 1))
    width = -(-(b["hi"] - b["lo"] + 1) // n)
    return df.withColumn("segment", F.expr(f"cast((`{id_col}` - {b['lo']}) div {width} as int)"))
