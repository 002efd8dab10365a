"""Joining details to records, and the projections for export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.schema import EXPORT

_EMPTY = "array<string>"


def one_detail(detail: DataFrame, key: str) -> DataFrame:
    """One detail per key: that with the most keywords, of equal ones the greatest by its columns."""
    cols = [c for c in detail.columns if c != key]
    n = [F.size(F.coalesce("keywords", F.array().cast(_EMPTY)))] if "keywords" in cols else []
    return detail.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*n, *cols)).alias("r_")).select(key, "r_.*")


def add_keywords(papers: DataFrame, detail: DataFrame, key: str = "source_id") -> DataFrame:
    """Left lookup of one detail per key; its keywords are added when new (folded), and kept as real_keywords."""
    d = one_detail(detail.select(key, "keywords"), key).withColumnRenamed("keywords", "real_keywords")
    x = papers.join(d, key, "left")
    return x.withColumn("keywords", X.union_folded("keywords", "real_keywords")).select(*papers.columns, "real_keywords")


def stored_keywords(papers: DataFrame) -> DataFrame:
    """What is stored are the real keywords, or none: the others were search terms."""
    return papers.withColumn("keywords", F.coalesce("real_keywords", F.array().cast(_EMPTY))).drop("real_keywords")


def backfill_keywords(stored: DataFrame, detail: DataFrame, key: str = "source_id") -> DataFrame:
    """Rows without keywords take those of their detail; others stay."""
    d = one_detail(detail.filter(F.size("keywords") > 0).select(key, "keywords"), key).withColumnRenamed("keywords", "new_")
    x = stored.join(d, key, "left")
    return x.withColumn("keywords", F.when(F.size("keywords") > 0, F.col("keywords")).otherwise(F.coalesce("new_", "keywords"))).select(*stored.columns)


def merge_subjects(stored: Column, areas: Column) -> Column:
    """JSON array of subject areas: those there are, then the detail's that have a new code."""
    kind = "array<struct<code:string,abbrev:string,name:string>>"
    old = F.coalesce(F.from_json(stored, kind), F.transform(X.subject_codes(stored), lambda c: F.struct(c.alias("code"), F.lit(None).cast("string").alias("abbrev"), F.lit(None).cast("string").alias("name"))))
    old = F.filter(F.coalesce(old, F.array().cast(kind)), lambda s: X.nonempty(s["code"]).isNotNull())
    codes = F.transform(old, lambda s: s["code"])
    new = F.filter(F.coalesce(areas, F.array().cast(kind)), lambda s: X.nonempty(X.strip(s["code"])).isNotNull() & ~F.array_contains(codes, X.strip(s["code"])))
    merged = F.concat(old, new)
    return F.when(F.coalesce(F.size(areas), F.lit(0)) > 0, F.when(F.size(merged) > 0, F.to_json(merged))).otherwise(stored)


def add_detail(papers: DataFrame, detail: DataFrame, key: str = "source_id") -> DataFrame:
    """Fills what is missing from the detail; publisher and payload of the detail replace what is there."""
    names = {c: F.col(c).alias(f"d_{c}") for c in detail.columns if c != key}
    x = papers.join(one_detail(detail, key).select(key, *names.values()), key, "left")
    fill = lambda a, b: F.when(X.nonempty(a).isNull(), F.coalesce(X.nonempty(b), F.col(a))).otherwise(F.col(a))
    no_title = X.nonempty("title").isNull() & X.nonempty("d_title").isNotNull()
    no_abs = X.nonempty("abstract").isNull() & X.nonempty("d_abstract").isNotNull()
    cols = {
        "title": F.when(no_title, F.col("d_title")).otherwise(F.col("title")), "title_eng": F.when(no_title, F.col("d_title")).otherwise(F.col("title_eng")),
        "abstract": F.when(no_abs, F.col("d_abstract")).otherwise(F.col("abstract")), "abstract_eng": F.when(no_abs, F.col("d_abstract")).otherwise(F.col("abstract_eng")),
        "url": fill("url", "d_url"), "registered_at": fill("registered_at", "d_cover_date"), "journal_id": fill("journal_id", "d_publication_name"),
        "institution_id": F.coalesce(X.nonempty("d_publisher"), F.col("institution_id")), "issn": fill("issn", "d_issn"), "eissn": fill("eissn", "d_eissn"),
        "authors": X.union_folded("authors", "d_author_names"), "keywords": X.union_folded("keywords", "d_keywords"),
        "subject_code": merge_subjects(F.col("subject_code"), F.col("d_subject_areas")),
        "raw_payload": F.coalesce(X.nonempty("d_raw_payload"), F.col("raw_payload")),
    }
    return x.select(*[cols.get(c, F.col(c)).alias(c) for c in papers.columns])


def _exported() -> list[Column]:
    joined = {"category": "categories", "keywords": "matched_keywords", "paper_keywords": "keywords", "authors": "authors"}
    return [(X.join_nonempty(joined[c]) if c in joined else F.col(c)).alias(c) for c in EXPORT]


def export_rows(papers: DataFrame) -> DataFrame:
    """The exported columns, lists joined with ``; ``."""
    return papers.select(*_exported())


def by_category(papers: DataFrame, unsorted: str = "미분류") -> DataFrame:
    """Exported rows once per category (column ``sheet``); rows of none under ``unsorted``."""
    c = F.coalesce("categories", F.array().cast(_EMPTY))
    return papers.withColumn("sheet", F.explode(F.when(F.size(c) == 0, F.array(F.lit(unsorted))).otherwise(c))).select("sheet", *_exported())
