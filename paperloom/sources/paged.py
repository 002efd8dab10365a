"""A Python data source for paged search services, over fixture files or any page function.

Partitions are planned from slices of at most a bounded number of records; a reader walks the pages of its slice, with
a rate limit, retries with growing pauses, and a cap on pages.  What fails in one slice is reported as a row of its own.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from email.utils import parsedate_to_datetime
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAX_PAGES, MAX_DELAY = 100, 120.0


class Throttled(Exception):
    """The service asks to wait; ``after``: a Retry-After value (seconds or HTTP date) or None."""

    def __init__(self, after: str | None = None):
        super().__init__("throttled")
        self.after = after


def retry_after(value: str | None, now: float | None = None) -> float | None:
    if not value:
        return None
    try:
        return max(0.0, float(value))
    except ValueError:
        pass
    try:
        return max(0.0, parsedate_to_datetime(value).timestamp() - (time.time() if now is None else now))
    except (TypeError, ValueError):
        return None


class RateLimiter:
    """Token bucket whose rate halves on trouble (not below the floor) and grows by a tenth of the maximum after five fast answers."""

    FLOOR, GROW_AFTER = 0.5, 5

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.top = self.rate = rate
        self.tokens, self.at, self.good, self.clock, self.sleep = 1.0, clock(), 0, clock, sleep

    def wait(self) -> None:
        if self.rate <= 0:
            return
        now = self.clock()
        self.tokens, self.at = min(1.0, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.tokens, self.at = 1.0, self.clock()
        self.tokens -= 1

    def trouble(self) -> None:
        self.good, self.rate = 0, max(min(self.FLOOR, self.top), self.rate / 2)

    def fast(self) -> None:
        self.good += 1
        if self.good >= self.GROW_AFTER:
            self.good, self.rate = 0, min(self.top, self.rate + self.top / 10)


def with_retries(call: Callable[[], object], retries: int, pause: float, limiter: RateLimiter | None = None, sleep: Callable[[float], None] = time.sleep) -> object:
    """retries + 1 attempts; the pause doubles, with jitter, and is at least what the service asks for, at most MAX_DELAY."""
    for k in range(retries + 1):
        try:
            if limiter:
                limiter.wait()
            out = call()
            if limiter:
                limiter.fast()
            return out
        except Exception as e:
            if limiter:
                limiter.trouble()
            if k == retries:
                raise
            asked = retry_after(e.after) if isinstance(e, Throttled) else None
            sleep(min(MAX_DELAY, max(asked or 0.0, pause * 2**k * (1 + random.random() / 10))))
    return None


def pages(fetch: Callable[[int], tuple[list, int]], max_pages: int | None = None) -> Iterator[tuple[int, list]]:
    """Pages from 1 until one is empty, all stated records are there, or the cap is reached."""
    seen = 0
    for no in range(1, min(max_pages or MAX_PAGES, MAX_PAGES) + 1):
        items, total = fetch(no)
        if not items:
            return
        yield no, items
        seen += len(items)
        if seen >= total:
            return


def overlapping(fetch: Callable[[int, int], tuple[list, int]], size: int, key: Callable[[dict], str | None], known: set[str], overlap: int = 20, max_pages: int | None = None) -> Iterator[dict]:
    """Records of windows that overlap, so that a list that shifts while it is read loses nothing; known and repeated keys are skipped.

    It ends on an empty window or when the windows have passed the stated total.
    """
    step, start, seen = size - min(overlap, size - 1), 0, set(known)
    for _ in range(max_pages or MAX_PAGES):
        items, total = fetch(start, size)
        for x in items:
            k = key(x)
            if k is None or k not in seen:
                if k is not None:
                    seen.add(k)
                yield x
        start += step
        if not items or start + size - step >= total + size:
            return


class SlicePartition(InputPartition):
    def __init__(self, no: int, spec: dict):
        self.no, self.spec = no, spec


class FixtureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = Path(options["path"])
        self.max_pages = int(options["max_pages"]) if options.get("max_pages") else None
        self.retries, self.pause = int(options.get("retries", "3")), float(options.get("pause", "0"))
        self.rate = float(options.get("rate", "0"))

    def partitions(self):
        """One partition per slice folder: its pages are page-1.*, page-2.*, …"""
        return [SlicePartition(i, {"slice": p.name}) for i, p in enumerate(sorted(x for x in self.folder.iterdir() if x.is_dir()))] or [SlicePartition(0, {"slice": ""})]

    def read(self, partition):
        name = partition.spec["slice"]
        if not name:
            return
        limiter = RateLimiter(self.rate) if self.rate > 0 else None

        def fetch(no: int):
            found = sorted((self.folder / name).glob(f"page-{no}.*"))
            return ([found[0].read_text(encoding="utf-8")], 10**9) if found else ([], 0)

        no = 0
        try:
            for no, items in pages(lambda n: with_retries(lambda: fetch(n), self.retries, self.pause, limiter), self.max_pages):
                for body in items:
                    yield (name, no, body, None)
        except Exception as e:
            yield (name, no + 1, None, f"{type(e).__name__}: {e}")


class PagedSource(DataSource):
    """Rows slice, page, body, error.  Options: path, max_pages, retries, pause, rate."""

    @classmethod
    def name(cls):
        return "paged_search"

    def schema(self):
        return "slice string, page int, body string, error string"

    def reader(self, schema):
        return FixtureReader(self.options)


def request_params(query: dict, page: int, size: int) -> dict[str, str]:
    """Parameters of a request: known ones that are not empty; the page size is kept within 1 to 100."""
    # Parameter names of the remote search.
    names = {"title": "title", "keyword": "keyword", "author": "author", "journal": "journal", "pub_from": "dateFrom", "pub_to": "dateTo", "reg_from": "regDateFrom", "reg_to": "regDateTo"}
    out = {n: str(query[k]) for k, n in names.items() if query.get(k)}
    return out | {"page": str(max(1, page)), "displayCount": str(min(100, max(1, size)))}


def read_json_text(path: str) -> object:
    return json.loads(Path(path).read_text(encoding="utf-8"))
