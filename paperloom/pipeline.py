"""The three entries as chains of DataFrame transforms, and a command line over stored tables.

Nothing is collected between reading and the sink but marks and counts.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import classify as C
from paperloom.operators import dedup as D
from paperloom.operators import enrich as E
from paperloom.operators import filters as L
from paperloom.operators import normalize as N
from paperloom.plans.rules import RuleSet, load_allowlist, load_blocklist, load_rules
from paperloom.plans.settings import load_settings
from paperloom.sources.store import Store
from paperloom.streaming.incremental import run_batch


@dataclass(frozen=True)
class Policy:
    """Configuration of a run: rules, years, lists, members."""

    rules: RuleSet
    first_year: int
    last_year: int
    blocked: tuple[str, ...] = ()
    allowed: tuple[str, ...] = ()
    publishers: tuple[str, ...] = ()
    journals: tuple[str, ...] = ()
    extra: tuple[str, ...] = ()
    extra_category: str = "추가 검색어"

    def members(self) -> Column | None:
        return C.member(self.publishers, self.journals) if self.publishers or self.journals else None


def match(papers: DataFrame, policy: Policy) -> DataFrame:
    """Year, block-list, rules: cheap filters first."""
    x = L.year_range(papers, policy.first_year, policy.last_year)
    if policy.blocked:
        x = L.not_blocked(x, L.term_table(papers.sparkSession, policy.blocked), policy.members())
    return C.keep_relevant(C.classify(x, policy.rules), policy.members()).drop("match_field")


def live_xml(raw: DataFrame, detail: DataFrame, policy: Policy, order: str = "ord") -> DataFrame:
    """Normalize, seed, fold duplicates, classify, add details to what is left, classify again, store only real keywords, summarize.

    What is relevant by unseen keywords alone and fails the first pass is lost, as only survivors get details.
    """
    x = N.normalize_xml(raw, keep=(order, "matched_field"))
    x = N.seed_keywords(x).drop("matched_field")
    first = match(D.fold_merge(x, order), policy)
    enriched = E.add_keywords(first, detail)
    second = match(enriched, policy)
    return N.summarize(E.stored_keywords(second))


def live_json(raw: DataFrame, detail: DataFrame, known: DataFrame, policy: Policy, mark: str | None = None, order: str = "ord") -> DataFrame:
    """Normalize, fold duplicates, select new rows, add details, subject filter, rules or extra terms, summarize."""
    x = D.fold_merge(N.normalize_json(L.drop_errata(raw), keep=(order,)), order)
    x = E.add_detail(L.incremental(x, known, mark), detail)
    x = L.allowed_codes(x, policy.allowed)
    if policy.rules.rules:
        x = C.classify(x, policy.rules).drop("match_field")
        if policy.extra:
            x = C.extra_terms(x, policy.extra, policy.extra_category)
        x = x.filter("is_relevant")
    elif policy.extra:
        # without rules extra terms classify but drop nothing
        x = C.extra_terms(x, policy.extra, policy.extra_category)
    return N.summarize(x)


def build_corpus(store: Store, raw: DataFrame, detail: DataFrame, table: str = "corpus", order: str = "ord") -> None:
    """First row per id, only unseen ids, with keywords of their details; stored as they are, irrelevant ones too."""
    x = D.first_wins(N.normalize_xml(raw, keep=(order,)), "source_id", order)
    if store.exists(table):
        x = L.new_rows(x, store.read(table))
    stored = N.to_stored(E.stored_keywords(E.add_keywords(x, detail)), keep=(order,), clean_lists=False)
    store.append_new(table, stored.withColumnRenamed(order, "id"))


def match_corpus(store: Store, policy: Policy, corpus: str = "corpus", target: str = "papers", full: bool = False) -> int:
    """Classifies the corpus rows after the mark and upserts the relevant ones; a full run starts from nothing."""
    def work(part: DataFrame) -> DataFrame:
        kept = N.summarize(match(N.from_stored(part, keep=("id",)), policy))
        return N.checked_evidence(N.to_stored(kept, keep=("id",)))

    return run_batch(store, store.read(corpus), work, target, "match_max_id", full=full)


def clean(store: Store, policy: Policy, table: str = "papers") -> None:
    store.delete(table, L.outside_years(policy.first_year, policy.last_year) | L.invalid_evidence())


def export(papers: DataFrame, path: str, sheets: Callable[[str], str] | None = None) -> None:
    """All rows, and rows by category, as partitioned Parquet; ``sheets`` may rename categories."""
    E.export_rows(papers).write.mode("overwrite").parquet(f"{path}/all")
    E.by_category(papers).write.mode("overwrite").partitionBy("sheet").parquet(f"{path}/by_category")


def sheet_name(value: str, used: set[str], limit: int = 31) -> str:
    """A valid, unused sheet name; names that differ only in case count as used."""
    base = " ".join("".join(" " if c in "[]:*?/\\" else c for c in value).split())[:limit] or "미분류"
    name, n = base, 2
    while name.casefold() in {u.casefold() for u in used}:
        tail = f" {n}"
        name, n = base[: limit - len(tail)] + tail, n + 1
    used.add(name)
    return name


def write_workbook(papers: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    """Small exports as a workbook: one sheet for all and one per category.  Needs openpyxl; larger results are refused."""
    import pandas as pd

    if papers.limit(max_rows + 1).count() > max_rows:
        raise ValueError("too many rows for a workbook; use export()")
    used = {"전체"}
    with pd.ExcelWriter(path, engine="openpyxl") as w:
        E.export_rows(papers).toPandas().to_excel(w, index=False, sheet_name="전체")
        for name, part in E.by_category(papers).toPandas().groupby("sheet", sort=False):
            part.drop(columns="sheet").to_excel(w, index=False, sheet_name=sheet_name(str(name), used))
        for ws in w.book.worksheets:
            ws.freeze_panes = "A2"
            ws.auto_filter.ref = ws.dimensions


def counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if("is_relevant").alias("relevant"), F.countDistinct("source_id").alias("ids"))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="paperloom")
    p.add_argument("step", choices=["match", "clean", "export"])
    p.add_argument("--store", required=True)
    p.add_argument("--rules", nargs="*", default=[])
    p.add_argument("--blocklist")
    p.add_argument("--allowlist")
    p.add_argument("--from-year", type=int)
    p.add_argument("--to-year", type=int)
    p.add_argument("--extra-term", action="append", default=[])
    p.add_argument("--full", action="store_true")
    p.add_argument("--out")
    a = p.parse_args(argv)
    s = load_settings()
    policy = Policy(
        load_rules(*(a.rules or s.rules)), a.from_year or s.start_year, a.to_year or s.end_year,
        load_blocklist(a.blocklist or s.blocklist) if a.blocklist or s.blocklist else (),
        tuple(sorted(load_allowlist(a.allowlist or s.allowlist))) if a.allowlist or s.allowlist else (), extra=tuple(a.extra_term))
    spark = SparkSession.builder.appName("paperloom").getOrCreate()
    store = Store(spark, a.store)
    if a.step == "match":
        match_corpus(store, policy, full=a.full)
    elif a.step == "clean":
        clean(store, policy)
    else:
        export(N.from_stored(store.read("papers")), a.out or s.export_dir)


if __name__ == "__main__":
    main()
