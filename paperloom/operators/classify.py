"""Classification of records by rules held as data, and the filters around it.

The rules are configuration of bounded size.  Each distinct anchor set is one boolean column, each field's hits are one array
of rule numbers; the first field with any hit decides.  Everything is expression over the row: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.functions.matching import any_of, haystack, keyword_in, proximity_pattern
from paperloom.plans.rules import RuleSet

FIELDS = ("title", "keyword", "abstract")
TITLES = ("title", "title_kor", "title_eng", "title_other")
ABSTRACTS = ("abstract", "abstract_kor", "abstract_eng", "abstract_other")
KEYWORD_TEXTS = ("keyword_text_kor", "keyword_text_eng", "keyword_text_other")


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are evaluated once per row.

    The optimizer copies projected expressions into every later use, filters included; output of a generator is not copied.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def field_texts(df: DataFrame) -> DataFrame:
    """Adds f_title, f_keyword, f_abstract: folded, empty parts skipped."""
    have = set(df.columns)
    parts = lambda names: [X.nonempty(n) for n in names if n in have]
    kw = parts(KEYWORD_TEXTS) + ([X.nonempty(F.array_join("keywords", " "))] if "keywords" in have else [])
    return once(df, {f"f_{n}": X.fold(F.concat_ws(" ", *c)) if c else F.lit("") for n, c in zip(FIELDS, (parts(TITLES), kw, parts(ABSTRACTS)))})


_RULE = "array<struct<category:string,keyword:string,mode:string,k:string,words:array<string>,pattern:string,anchor:int>>"


def _keyword_struct(keyword: str) -> list[Column]:
    words = list(dict.fromkeys(keyword.casefold().split()))
    many = len(words) > 1
    return [
        F.lit("".join(keyword.casefold().split())).alias("k"), (F.array(*map(F.lit, words)) if many else F.array().cast("array<string>")).alias("words"),
        F.lit(proximity_pattern(words) if many else None).cast("string").alias("pattern"),
    ]


def _hit(r: Column, text: Column, ns: Column) -> Column:
    """Containment ignoring white space; else, where all words are there, the proximity pattern."""
    near = r["pattern"].isNotNull() & F.forall(r["words"], lambda w: text.contains(w)) & F.rlike(text, r["pattern"])
    return (ns.contains(r["k"]) & (r["k"] != "")) | near


def classify(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Sets categories, matched_keywords, relevance_reasons, relevance_score, is_relevant and match_field.

    The first of title, keyword, abstract with a hit is reported alone; anchored rules need an anchor anywhere; excludes veto.
    Without rules nothing is relevant.  Rules and anchor sets are literal arrays, so the plan does not grow with them.
    """
    base = field_texts(df)
    # joined with empty fields, so matches may span field borders here, unlike within a field
    combined = F.concat_ws(" ", *[f"f_{n}" for n in FIELDS])
    base = once(base, {"c_all": combined, "c_ns": X.no_space(combined), **{f"n_{n}": X.no_space(f"f_{n}") for n in FIELDS}})
    sets = rules.anchor_sets
    table = F.array(*[F.struct(F.lit(r.category).alias("category"), F.lit(r.keyword).alias("keyword"), F.lit(r.mode).alias("mode"), *_keyword_struct(r.keyword),
                               F.lit(sets.index(r.anchors) if r.anchors else -1).alias("anchor")) for r in rules.rules]).cast(_RULE)
    anchors = F.array(*[F.array(*[F.struct(*_keyword_struct(t)) for t in s]) for s in sets])
    base = once(base, {"anchored_": F.transform(anchors, lambda s: F.exists(s, lambda t: _hit(t, F.col("c_all"), F.col("c_ns")))) if sets else F.array().cast("array<boolean>")})

    def hits(n: str) -> Column:
        found = F.filter(table, lambda r: ((r["anchor"] < 0) | F.coalesce(F.get(F.col("anchored_"), r["anchor"]), F.lit(False))) & _hit(r, F.col(f"f_{n}"), F.col(f"n_{n}")))
        brief = F.transform(found, lambda r: F.struct(r["category"].alias("category"), r["keyword"].alias("keyword"), r["mode"].alias("mode")))
        return F.when(F.col(f"f_{n}") != "", F.when(F.size(brief) > 0, F.struct(F.lit(n).alias("field"), brief.alias("rules"))))

    left, right = F.lit("(?<![0-9a-z])\\Q"), F.lit("\\E(?![0-9a-z])")
    out = F.filter(F.array(*map(F.lit, rules.excludes)), lambda t: F.rlike("c_all", F.concat(left, X.fold(t), right))) if rules.excludes else F.array().cast("array<string>")
    # coalesce stops at the first field with a hit
    base = once(base, {"won_": F.coalesce(*[hits(n) for n in FIELDS]), "out_": out})
    won, field = F.coalesce(F.col("won_.rules"), F.array().cast("array<struct<category:string,keyword:string,mode:string>>")), F.col("won_.field")
    why = F.flatten(F.transform(won, lambda r: F.array(F.concat_ws(":", field, r["keyword"]), F.concat(F.lit("category:"), r["category"]), F.concat(F.lit("mode:"), r["mode"]))))
    head = F.when(field.isNull(), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("matched_in:"), field)))
    mk = X.distinct_folded(F.transform(won, lambda r: r["keyword"]))
    made = {
        "categories": X.distinct_folded(F.transform(won, lambda r: r["category"])), "matched_keywords": mk,
        "relevance_reasons": F.concat(head, why, F.transform("out_", lambda t: F.concat(F.lit("exclude:"), t))),
        "relevance_score": (F.size(mk) - F.size("out_")).cast("double"), "is_relevant": field.isNotNull() & (F.size("out_") == 0), "match_field": field,
    }
    return once(base.drop(*made), made).select(*[c for c in df.columns if c not in made], *made)


def contains_any(c, names: Sequence[str]) -> Column:
    t = X.fold(F.coalesce(X.col(c), F.lit("")))
    return any_of(names, lambda n: t.contains(n.casefold()))


def member(publishers: Sequence[str], journals: Sequence[str], publisher="institution_id", journal="journal_id") -> Column:
    """The publisher's or the journal's name contains one of the given names."""
    return contains_any(publisher, publishers) | contains_any(journal, journals)


def keep_relevant(classified: DataFrame, members: Column | None = None, category: str = "members", keyword: str = "member", reason: str = "member") -> DataFrame:
    """Relevant rows, and rows of members (vetoed ones too), which get the fixed classification and score 1."""
    ok = F.col("is_relevant") & (F.size("categories") > 0) & (F.size("matched_keywords") > 0)
    if members is None:
        return classified.filter(ok)
    rescued = ~F.col("is_relevant") & members
    one = lambda v: F.array(F.lit(v))
    x = classified.filter(ok | rescued).withColumn("r_", rescued)
    return x.withColumns({
        "categories": F.when(F.col("r_"), one(category)).otherwise(F.col("categories")),
        "matched_keywords": F.when(F.col("r_"), one(keyword)).otherwise(F.col("matched_keywords")),
        "relevance_reasons": F.when(F.col("r_"), one(reason)).otherwise(F.col("relevance_reasons")),
        "relevance_score": F.when(F.col("r_"), 1.0).otherwise(F.col("relevance_score")),
        "match_field": F.when(F.col("r_"), "journal").otherwise(F.col("match_field")), "is_relevant": F.lit(True),
    }).drop("r_")


def breakdown(kept: DataFrame) -> DataFrame:
    return kept.groupBy("match_field").agg(F.count("*").alias("n"))


def extra_terms(df: DataFrame, terms: Sequence[str], category: str) -> DataFrame:
    """Classifies rows that are not relevant yet by plain terms, without anchors or excludes."""
    text, ns = haystack(*[c for c in (*TITLES, *ABSTRACTS) if c in df.columns], F.array_join("keywords", " "))
    x = once(df, {"t_": text, "s_": ns})
    hit = F.array_compact(F.array(*[F.when(keyword_in(t, F.col("t_"), F.col("s_")), F.lit(t)) for t in terms])) if terms else F.array().cast("array<string>")
    x = once(x, {"hit_": hit}).withColumn("use_", ~F.coalesce("is_relevant", F.lit(False)) & (F.size("hit_") > 0))
    u = F.col("use_")
    return x.withColumns({
        "categories": F.when(u, F.array(F.lit(category))).otherwise(F.col("categories")), "matched_keywords": F.when(u, F.col("hit_")).otherwise(F.col("matched_keywords")),
        "relevance_reasons": F.when(u, F.transform("hit_", lambda t: F.concat(F.lit("extra:"), t))).otherwise(F.col("relevance_reasons")),
        "relevance_score": F.when(u, F.size("hit_").cast("double")).otherwise(F.col("relevance_score")), "is_relevant": u | F.coalesce("is_relevant", F.lit(False)),
    }).drop("t_", "s_", "hit_", "use_")


# Terms and weights of the weighted score.
STRONG = {
    "디지털 포렌식": 4.0, "디지털포렌식": 4.0, "digital forensic": 4.0, "digital forensics": 4.0, "mobile forensic": 3.5, "모바일 포렌식": 3.5,
    "memory forensic": 3.5, "메모리 포렌식": 3.5, "network forensic": 3.0, "네트워크 포렌식": 3.0, "disk forensic": 3.0, "dfir": 3.0,
    "incident response": 2.5, "artifact": 1.0, "forensic artifact": 2.0, "malware forensic": 2.0, "malware analysis": 1.5,
}
WEAK = {"포렌식": 1.5, "forensic": 1.5, "사이버": 0.5, "cyber": 0.5, "로그": 0.5, "log": 0.5, "증거": 0.5, "evidence": 0.5}
EXCLUDED = {"법의학": -3.0, "forensic psychiatry": -3.0, "forensic medicine": -3.0, "forensic nursing": -3.0, "legal medicine": -3.0}


def weigh(c, weights: dict[str, float]) -> Column:
    t = X.fold(F.coalesce(X.col(c), F.lit("")))
    return sum((F.when(t.contains(k), F.lit(v)).otherwise(F.lit(0.0)) for k, v in weights.items()), F.lit(0.0))


def weighted_reasons(c) -> Column:
    t = X.fold(F.coalesce(X.col(c), F.lit("")))
    tags = [(k, "exclude") for k in EXCLUDED] + [(k, "strong") for k in STRONG] + [(k, "weak") for k in WEAK]
    return F.array_compact(F.array(*[F.when(t.contains(k), F.lit(f"{g}:{k}")) for k, g in tags]))


def weighted_score(df: DataFrame, min_score: float = 3.0) -> DataFrame:
    """1.5 title + abstract + 1.2 keywords; relevant by the unrounded score."""
    w = {**EXCLUDED, **STRONG, **WEAK}
    kw = F.array_join("keywords", " ")
    raw = weigh("title", w) * 1.5 + weigh("abstract", w) + weigh(kw, w) * 1.2
    x = once(df.drop("relevance_score", "is_relevant", "relevance_reasons"), {"raw_": raw})
    return x.withColumns({
        "relevance_score": F.round("raw_", 2), "is_relevant": F.col("raw_") >= min_score,
        "relevance_reasons": F.concat(weighted_reasons("title"), weighted_reasons("abstract"), weighted_reasons(kw))}).drop("raw_")
