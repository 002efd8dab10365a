"""De-duplication: by key with a richness-ordered fold, or the first of each id.

Groups are the copies of one record, some few rows each; where a key may be hot (an id that stands for many records), ``first_wins``
needs no list at all, and ``fold_merge`` collapses equal rows before it collects, so copies of one row never gather.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as X

RICH = ("title", "title_kor", "title_eng", "doi", "abstract", "url", "uci", "journal_id", "institution_id", "issue_id", "issn", "eissn", "registered_at", "updated_at", "summary")
RICH_LISTS = ("keywords", "categories", "matched_keywords", "matched_queries")
FILL = (
    "title", "title_kor", "title_eng", "title_other", "doi", "uci", "url", "abstract", "abstract_kor", "abstract_eng", "abstract_other", "journal_id",
    "institution_id", "issue_id", "first_page", "final_page", "page_count", "issn", "eissn", "subject_code", "is_fulltext", "registered_at", "updated_at",
    "publication_year", "summary",
)
UNION = ("keywords", "categories", "matched_keywords", "matched_queries", "relevance_reasons")


def paper_key(doi="doi", source="source", source_id="source_id", title="title") -> Column:
    """doi, else source and id, else the title's letters."""
    return F.coalesce(
        F.concat(F.lit("doi:"), X.fold(X.nonempty(doi))),
        F.concat(F.lit("id:"), X.fold(F.concat(F.coalesce(F.col(source), F.lit("")), F.lit(":"), X.nonempty(source_id)))),
        F.concat(F.lit("title:"), F.coalesce(X.title_key(title), F.lit(""))),
    )


def richness(get=F.col) -> Column:
    n = F.lit(0)
    for f in RICH:
        n = n + F.coalesce((get(f) != "").cast("int"), F.lit(0))
    for f in RICH_LISTS:
        n = n + F.coalesce(F.size(get(f)), F.lit(0))
    return n


def first_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key; partial aggregation, so a hot key is reduced before it is shuffled."""
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.min_by(F.struct(order, *rest), order).alias("r"))
    return best.select(key, "r.*").select(*df.columns)


def _merge(a: Column, b: Column, names: list[str]) -> Column:
    """Fold step: the richer of the two (ties: the first) is kept and filled from the other."""
    # bound once: a lambda has no shared subexpressions
    return F.transform(F.array(richness(lambda f: b[f]) > richness(lambda f: a[f])), lambda w: _filled(a, b, w, names))[0]


def _filled(a: Column, b: Column, b_wins: Column, names: list[str]) -> Column:
    pick = lambda f: (F.when(b_wins, b[f]).otherwise(a[f]), F.when(b_wins, a[f]).otherwise(b[f]))
    out = []
    more = None
    if "relevance_score" in names:
        x, y = pick("relevance_score")
        more = x.isNull() | (y.isNotNull() & (y > x))
    for n in names:
        x, y = pick(n)
        if n in FILL:
            text = n not in ("page_count", "is_fulltext", "publication_year")
            v = F.when(x.isNull() | (x == "" if text else F.lit(False)), y).otherwise(x)
        elif n in UNION:
            empty = F.array().cast("array<string>")
            base, new = F.coalesce(x, empty), X.distinct_folded(F.coalesce(y, empty))
            have = F.transform(base, X.fold)
            v = F.concat(base, F.filter(new, lambda t: ~F.array_contains(have, X.fold(t))))
        elif n in ("relevance_score", "is_relevant") and more is not None:
            v = F.when(more, y).otherwise(x)
        elif n == "raw_payload":
            v = F.when(x.isNull() | x.isin("", "{}"), F.coalesce(y, x)).otherwise(x)
        else:
            v = x
        out.append(v.alias(n))
    return F.struct(*out)


def fold_merge(papers: DataFrame, order: str = "ord", key: Column | None = None) -> DataFrame:
    """One record per key, merged in arrival order.

    The richness is that of the merged record so far, so the order matters and must be a column.  Rows equal in all but the order
    arrive as the first of them: merging a copy changes nothing.
    """
    names = [c for c in papers.columns if c != order]
    keyed = papers.withColumn("key_", paper_key() if key is None else key)
    rows = keyed.groupBy("key_", *names).agg(F.min(order).alias(order)) if names else keyed
    grouped = rows.groupBy("key_").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.struct(*names).alias("r")))).alias("rows"))
    kind = "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in papers.schema.fields if f.name != order) + ">"
    merged = F.aggregate(F.slice("rows", 2, F.greatest(F.lit(0), F.size("rows") - 1)), F.col("rows")[0]["r"].cast(kind), lambda acc, x: _merge(acc, x["r"], names).cast(kind))
    return grouped.select(F.col("rows")[0]["o"].alias(order), merged.alias("m")).select(order, "m.*")


def duplicate_groups(df: DataFrame, key: Column) -> DataFrame:
    """key, n for the keys of two rows or more."""
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).filter("n > 1 and key is not null")


def rank_within(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))
