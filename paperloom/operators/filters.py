"""Row filters: years, block-lists, allow-lists, sweep candidates, incremental selection, deletes."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.functions.matching import any_of, haystack, keyword_in, near_words, word_in
from paperloom.plans.rules import MAX_RULES, RuleSet


def year_range(df: DataFrame, first: int, last: int, year: str = "publication_year") -> DataFrame:
    """Years from first to last; rows without a year are dropped."""
    return df.filter(F.col(year).between(first, last))


def term_table(spark, terms: Sequence[str]) -> DataFrame:
    """term, k_ (without white space), words (repeated ones too), tv_ (simple names): one row per term, at most MAX_RULES."""
    if len(terms) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} terms")
    rows = []
    for t in terms:
        words = t.casefold().split()
        rows.append((t, "".join(words), words))
    return spark.createDataFrame(rows, "term string, k_ string, words array<string>").withColumn("tv_", X.org_variants("term"))


def blocked_orgs(df: DataFrame, terms: DataFrame, publisher: str = "institution_id", journal: str = "journal_id") -> DataFrame:
    """Distinct (publisher, journal) that a term of the term table (whose size is checked when it is made) matches.

    Names are made distinct first, so the test by containment, which no hash join can do, sees each name once.  Simplified names match
    if either contains the other (a very short name is thus contained in many terms).  Names that hold all words of a term go through
    the proximity test, whatever the number of words.
    """
    orgs = df.select(F.col(publisher).alias("p_"), F.col(journal).alias("j_")).distinct()
    text, ns = haystack("p_", "j_")
    orgs = orgs.withColumns({"t_": text, "s_": ns, "v_": F.array_distinct(F.concat(X.org_variants("p_"), X.org_variants("j_")))})
    both = F.exists("v_", lambda v: F.exists("tv_", lambda x: v.contains(x) | x.contains(v)))
    sure = (F.col("s_").contains(F.col("k_")) & (F.col("k_") != "")) | both
    words = (F.size("words") > 1) & F.forall("words", lambda w: F.col("t_").contains(w))
    pairs = orgs.filter(F.col("t_").rlike(r"\S")).join(F.broadcast(terms), sure | words).select("p_", "j_", "t_", "words", sure.alias("sure"))

    def near(batches):
        for b in batches:
            ok = [s or near_words(w, t) for s, w, t in zip(*(b.column(c).to_pylist() for c in ("sure", "words", "t_")))]
            yield b.select(["p_", "j_"]).filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(near, "p_ string, j_ string").distinct()


def not_blocked(df: DataFrame, terms: DataFrame, exempt: Column | None = None, publisher: str = "institution_id", journal: str = "journal_id") -> DataFrame:
    """Rows whose publisher and journal no term matches; exempt rows stay."""
    bad = blocked_orgs(df, terms, publisher, journal).withColumn("bad_", F.lit(True))
    on = F.col(publisher).eqNullSafe(F.col("p_")) & F.col(journal).eqNullSafe(F.col("j_"))
    keep = F.col("bad_").isNull() if exempt is None else F.col("bad_").isNull() | exempt
    return df.join(bad, on, "left").filter(keep).select(*df.columns)


def sweep_candidates(raw: DataFrame, rules: RuleSet, members: Column, member_name: str, blocked: Column | None = None) -> DataFrame:
    """Candidates of a full sweep: members pass and are tagged; others need no block, no exclude, and an include term."""
    text, ns = haystack("title_original", "title_english", "title_foreign", F.array_join(F.coalesce("keywords", F.array().cast("array<string>")), " "), "abstract_original", "abstract_english")
    x = raw.withColumns({"t_": text, "s_": ns, "m_": members})
    out = any_of(rules.excludes, lambda t: word_in(t, F.col("t_")))
    into = any_of(rules.keywords, lambda t: keyword_in(t, F.col("t_"), F.col("s_")))
    ok = F.col("m_") | (~(blocked if blocked is not None else F.lit(False)) & F.col("t_").rlike(r"\S") & ~out & into)
    return x.filter(ok).withColumns({
        "matched_query": F.when(F.col("m_"), F.lit(member_name)).otherwise(F.col("matched_query")),
        "matched_field": F.when(F.col("m_"), F.lit("journal")).otherwise(F.col("matched_field"))}).drop("t_", "s_", "m_")


def allowed_codes(df: DataFrame, codes: Sequence[str], column: str = "subject_code") -> DataFrame:
    """Rows with an allowed code; without a list all pass, with one rows without codes are dropped."""
    if not codes:
        return df
    return df.filter(F.arrays_overlap(X.subject_codes(column), F.array(*[F.lit(c) for c in codes])))


def latest(updated="updated_at", registered="registered_at") -> Column:
    return X.first_nonempty(updated, registered)


def incremental(df: DataFrame, known: DataFrame, mark: str | None, key: str = "source_id") -> DataFrame:
    """All rows without a mark; with one, those of unknown keys and those later than the mark (compared as text)."""
    if not mark:
        return df
    k = known.select(key).distinct().withColumn("known_", F.lit(True))
    return df.join(k, key, "left").filter(F.col("known_").isNull() | (latest() > F.lit(mark))).select(*df.columns)


def new_rows(df: DataFrame, stored: DataFrame, key: str = "source_id") -> DataFrame:
    return df.join(stored.select(key).distinct(), key, "left_anti")


def drop_errata(raw: DataFrame) -> DataFrame:
    return raw.filter(~(F.lower(F.coalesce("subtype_description", "subtype", F.lit(""))).isin("erratum", "er")))


def outside_years(first: int, last: int, source: str = "kci") -> Column:
    """Rows of the source to delete: no year, or one outside the range."""
    return (F.col("source") == source) & (F.col("publication_year").isNull() | ~F.col("publication_year").between(first, last))


def invalid_evidence(source: str = "kci") -> Column:
    """Stored rows of the source to delete: a list of evidence is empty or holds ``*``."""
    bad = F.lit(False)
    for c in ("category", "matched_keywords_json", "relevance_reasons_json"):
        bad = bad | F.coalesce(F.col(c).isin("", "[]") | F.col(c).contains('"*"'), F.lit(False))
    return (F.col("source") == source) & bad


def delete(df: DataFrame, where: Column) -> DataFrame:
    return df.filter(~F.coalesce(where, F.lit(False)))
