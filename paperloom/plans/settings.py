"""Settings from the environment, with defaults and limits."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def flag(value: str | None, default: bool) -> bool:
    return default if value in (None, "") else value.strip().casefold() in {"1", "true", "yes", "y", "on"}


def optional_int(value: str | None) -> int | None:
    return None if value in (None, "") else int(value)


@dataclass(frozen=True)
class Settings:
    xml_key: str | None = None
    json_key: str | None = None
    timeout: int = 30
    xml_page_size: int = 100
    json_page_size: int = 25
    xml_max_pages: int | None = None
    json_max_pages: int | None = None
    recent_years: int = 5
    start_year: int = 2022
    end_year: int = 2026
    workers: int = 4
    sweep: bool = True
    rate_limit: float = 2.0
    export_dir: str = "reports"
    allowlist: str | None = None
    rules: tuple[str, ...] = ()
    blocklist: str | None = None


def load_settings(env: Mapping[str, str] | None = None) -> Settings:
    e = os.environ if env is None else env
    get = lambda k, d: e.get(k) or d
    return Settings(
        xml_key=e.get("KCI_OPEN_API_KEY"), json_key=e.get("SCOPUS_API_KEY"), timeout=int(get("REQUEST_TIMEOUT", "30")),
        xml_page_size=min(100, max(1, int(get("KCI_PAGE_SIZE", "100")))), json_page_size=max(1, int(get("SCOPUS_PAGE_SIZE", "25"))),
        xml_max_pages=optional_int(e.get("KCI_MAX_PAGES")), json_max_pages=optional_int(e.get("SCOPUS_MAX_PAGES")),
        recent_years=int(get("KCI_RECENT_YEARS", "5")), start_year=int(get("KCI_START_YEAR", "2022")), end_year=int(get("KCI_END_YEAR", "2026")),
        workers=max(1, int(get("KCI_MAX_WORKERS", "4"))), sweep=flag(e.get("KCI_ENABLE_SWEEP"), True),
        rate_limit=max(0.0, float(get("KCI_RATE_LIMIT_RPS", "2"))), export_dir=get("EXPORT_DIR", "reports"),
        allowlist=e.get("SCOPUS_SUBJECT_CODE_ALLOWLIST_PATH"), blocklist=e.get("KCI_BLACKLIST_PATH"),
        rules=tuple(p for p in get("KEYWORD_FILTER_PATHS", "").split(os.pathsep) if p),
    )
