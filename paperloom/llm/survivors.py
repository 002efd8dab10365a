"""Best representative of each duplicate group, field by field.

Groups are connected components over two kinds of keys.  Every record is an observer that claims facts: the sentences
of its abstract (without markup), the elements of its keyword list.  A latent two-sided quality model gives each class of observers (the
source together with the visible state of the value: clean, cut open, looping, marked up, garbled, …) a sensitivity and a
specificity, learned by expectation-maximisation together with the truth of each fact.  Visible damage is a claim too, and one whose
truth is known: it is false.  A value without a claim judged false is whole; where none is, the one with the greatest odds of its
claims is taken.  An abstract also claims where it ends, which is false if a clean record goes on from there.
Multi-valued fields keep every value judged true (``values``); a query under which a record was found is never false.

Scale.  Facts travel as 64-bit hashes.  A fact's evidence is its counts per class (a fixed set of columns), so equal
evidence is merged before EM, and a group of any size adds one row per fact, never a list.  Only class parameters
are collected (sources x states, checked).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import unescape
from paperloom.session import bounded_rows, cut

WS = r"[\s\x{a0}\x{3000}]"
# Texts that stand for an absent abstract or keyword.
ABSENT = ("", "-", "n/a", "na", "none", "null", "초록 없음", "내용 없음", "없음", "no abstract available", "no abstract", "not available", "로그인 후 열람할 수 있습니다", "abstract", "keyword", "keywords", "*")
MAX_CLASSES = 400


def doi_key(c: Column) -> Column:
    """Canonical DOI, however written; null where there is none."""
    d = F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"(10\.[0-9]{3,}[0-9.]*/[^\s]+)", 1)
    d = F.regexp_replace(d, r"[.,;)\]>\"']+$", "")
    return F.when(d != "", d)


def source_key(source: Column, source_id: Column) -> Column:
    sid = F.trim(source_id)
    return F.when(~F.lower(sid).isin("", "-", "unknown"), F.concat_ws(":", F.coalesce(source, F.lit("")), sid))


def components(df: DataFrame, id_col: str, a: str, b: str, max_rounds: int = 40) -> DataFrame:
    """id -> lead: the smallest id reached through equal a-keys or equal b-keys (null keys link nothing).

    Rows collapse to distinct (a, b) edges first, so a key that holds a third of the rows costs one aggregated row per
    partition.  In each round a node's label, and that of the node its label names, become the smallest among the neighbours, and
    then labels jump to the label of what they name; so chains shrink by a factor, and rounds grow with the logarithm of their length.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(a).alias("a"), F.col(b).alias("b"))
    rows = rows.withColumn("a", F.coalesce("a", F.when(F.col("b").isNull(), F.concat(F.lit("\x00"), F.col("id").cast("string"))), F.concat(F.lit("\x01"), F.col("b"))))
    edges = cut(rows.groupBy("a", "b").agg(F.min("id").alias("low")))
    names = edges.groupBy("a").agg(F.min("low").alias("own"))  # a node is called by its smallest id
    # only keys that meet others can change
    multi = edges.filter("b is not null").groupBy("b").agg(F.count("*").alias("m")).filter("m > 1").select("b")
    live = cut(edges.filter("b is not null").join(multi, "b", "left_semi").select("a", "b").join(names, "a").select("own", "b"))
    labels = cut(live.select("own").distinct().withColumn("label", F.col("own")))
    for _ in range(max_rounds):
        least = live.join(labels, "own").groupBy("b").agg(F.min("label").alias("m"))
        met = live.join(least, "b").groupBy("own").agg(F.min("m").alias("m")).join(labels, "own")
        # hook: the node itself and the node that its label names
        hook = met.select("own", "m").unionByName(met.select(F.col("label").alias("own"), "m")).groupBy("own").agg(F.min("m").alias("m"))
        new = labels.join(hook, "own", "left").select("own", F.least("label", F.coalesce("m", "label")).alias("label"), F.col("label").alias("old"))
        new = cut(new)
        up = new.select(F.col("own").alias("label"), F.col("label").alias("up"))
        jumped = cut(new.join(up, "label", "left").select("own", F.least("label", F.coalesce("up", "label")).alias("label"), "old"))
        changed = jumped.filter("label < old").limit(1).count()
        labels = jumped.select("own", "label")
        if not changed:
            break
    else:
        raise ValueError("components: labels still change; raise max_rounds")
    named = names.join(labels, "own", "left").select("a", F.coalesce("label", "own").alias("label"))
    return rows.select("id", "a").join(named, "a").select(F.col("id").alias(id_col), F.col("label").alias("lead"))


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WS + "+", " "))


def _absent(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"[.\s]+$", "")).isin(*ABSENT) | ~c.rlike(r"\p{L}")


def _observe(df: DataFrame) -> DataFrame:
    """Per record: hashes of sentences and keywords with the state of each value."""
    t = F.col("abs_")
    n, d = F.size("sent_"), F.size(F.array_distinct("sent_"))
    state = (
        F.when(_absent(t), F.lit(None))
        .when(t.contains("�"), "broken")
        .when(F.length(F.regexp_replace(t, "[^\\x{80}-\\x{ff}]", "")) * 5 > F.length(t), "garbled")
        .when(t.rlike(r"<[A-Za-z/!][^<>]*>|&[a-zA-Z]+;|&#[0-9]+;"), "markup")
        .when(d < n, "loop")
        .when(~t.rlike(r"[.!?。][\"'”’)\]]*$") | t.rlike(r"(?:\.\.\.|…)$"), "open")
        .otherwise("clean")
    )
    k = F.col("kw_")
    kn, kd = F.size("kw_"), F.size(F.array_distinct("kw_"))
    kstate = (
        F.when((kn == 0) | F.forall(k, _absent), F.lit(None))
        .when(F.exists(k, _absent), "filler")
        .when(kd < kn, "repeat")
        .when(F.exists(k, lambda x: x.rlike(r";|\||\n|\t") | (F.size(F.split(x, r"[,，、/·]")) > 2)) | (kn == 1) & F.exists(k, lambda x: x.rlike(r"[,，、/·]")), "packed")
        .when(F.exists(k, lambda x: x.contains("�")), "broken")
        .otherwise("clean")
    )
    return (
        df.withColumn("abs_", _clean(F.col("abstract")))
        .withColumn("bare_", _clean(unescape(F.regexp_replace("abs_", r"<[A-Za-z/!][^<>]*>", " "))))
        .withColumn("sent_", F.transform(F.filter(F.split("bare_", r"(?<=[.!?。])\s+"), lambda x: x != ""), lambda x: F.xxhash64(x)))
        .withColumn("raw_kw_", F.transform(F.coalesce("keywords", F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit(""))))
        .withColumn("kw_", F.transform("raw_kw_", lambda x: F.lower(_clean(x))))
        .select(
            "ord", "updated_at", F.coalesce("source", F.lit("")).alias("source"), "a_", "b_",
            state.alias("a_state"), "sent_", F.xxhash64("abs_").alias("a_value"),
            kstate.alias("k_state"), F.transform("kw_", lambda x: F.xxhash64(x)).alias("kwh_"), F.xxhash64(F.array_join("kw_", "\x01")).alias("k_value"),
            F.transform(F.filter(F.coalesce("matched_queries", F.array().cast("array<string>")), lambda x: x.isNotNull() & ~_clean(x).isin("", "*")),
                        lambda x: F.xxhash64(F.lower(_clean(x)))).alias("q_"),
        )
    )


def quality_model(evidence: DataFrame, classes: list[str], rounds: int = 6) -> tuple[list[float], list[float], float]:
    """EM over rows w, c array<int>, n array<int>, damage: per class sensitivity, specificity; and the prior of truth.  Damage is false.

    EM starts from the visible state: a clean value may leave much out but says little that is false.
    """
    k = len(classes)
    sens, prior = [0.6] * k, 0.8
    start = spec = [0.98 if o.endswith("|clean") else 0.6 for o in classes]
    for _ in range(rounds):
        p = truth(sens, spec, prior)
        e = evidence.withColumn("p", F.when(F.col("damage"), 0.0).otherwise(p))
        w, q = F.col("w"), 1 - F.col("p")
        aggs = [F.sum(w * F.col("p")).alias("t"), F.sum(w).alias("all")]
        for i in range(k):
            c, n = F.col("c")[i], F.col("n")[i]
            aggs += [F.sum(w * F.col("p") * c), F.sum(w * F.col("p") * n), F.sum(w * q * (n - c)), F.sum(w * q * n)]
        r = list(e.agg(*aggs).first())
        if not r[1]:
            break
        prior = min(0.95, max(0.05, r[0] / r[1]))
        # Beta priors; that of specificity weighs a fifth of the class's evidence, for false facts are few and else
        # the model could call every minority claim false
        seen = [r[3 + 4 * i] + r[5 + 4 * i] for i in range(k)]
        sens = [(r[2 + 4 * i] + 6) / (r[3 + 4 * i] + 10) for i in range(k)]
        spec = [(r[4 + 4 * i] + start[i] * (10 + seen[i] / 5)) / (r[5 + 4 * i] + 10 + seen[i] / 5) for i in range(k)]
        sens = [min(0.999, max(0.001, x)) for x in sens]
        spec = [min(0.999, max(0.001, x)) for x in spec]
    return sens, spec, prior


def truth(sens: list[float], spec: list[float], prior: float) -> Column:
    x = F.lit(math.log(prior / (1 - prior)))
    for i, (a, b) in enumerate(zip(sens, spec)):
        c, n = F.col("c")[i], F.col("n")[i]
        x = x + c * math.log(a / (1 - b)) + (n - c) * math.log((1 - a) / b)
    return 1 / (1 + F.exp(-x))


KNOWN = 1e-6  # the doubt that remains about any fact


def _judge(papers: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records of groups of two or more; claims with false: claims judged false, and odds; facts with their probability)."""
    base = papers.select(
        "ord", "source", "updated_at", "abstract", "keywords", "matched_queries",
        source_key(F.col("source"), F.col("source_id")).alias("a_"), doi_key(F.col("doi")).alias("b_"),
    )
    obs = _observe(base)
    lead = components(base.select("ord", "a_", "b_"), "ord", "a_", "b_")
    size = lead.groupBy("lead").agg(F.count("*").alias("n")).filter("n > 1").select("lead")
    rec = cut(obs.drop("a_", "b_").join(lead.join(size, "lead", "left_semi"), "ord"))

    at = F.unix_date(F.try_to_date(F.substring(F.rpad("updated_at", 10, "-01-01"), 1, 10), "yyyy-MM-dd"))

    def claim(field, state, value, facts):
        """Witnesses; a repeated fact is claimed once.  A long text that is equal word for word was copied, so its copies in one group and
        class have seen no more than one has; equal lists of keywords agree independently."""
        x = rec.filter(F.col(state).isNotNull()).groupBy("lead", F.lit(field).alias("field"), F.concat_ws("|", F.lit(field), "source", state).alias("obs"), F.col(state).alias("state"), F.col(value).alias("value"), *([] if field == "abstract" else ["ord"]))
        return x.agg(*([F.min("ord").alias("ord")] if field == "abstract" else []), F.max(at).alias("at"), F.array_distinct(F.first(facts)).alias("facts"))

    claims = cut(claim("abstract", "a_state", "a_value", "sent_").unionByName(claim("keywords", "k_state", "k_value", "kwh_")))
    classes = sorted(r[0] for r in bounded_rows(claims.select("obs").distinct(), MAX_CLASSES, "observer classes"))
    n_by = claims.groupBy("lead", "field").agg(F.array(*[F.count_if(F.col("obs") == o) for o in classes] or [F.lit(0)]).alias("n"))
    key = ["lead", "field", "h"]
    said = claims.select("lead", "field", "ord", "obs", "state", F.posexplode("facts").alias("pos", "h"), F.size("facts").alias("size"))
    marred = claims.filter("state <> 'clean'").select("lead", "field", "ord", "obs", "state", F.lit(-1).alias("pos"), F.xxhash64(F.lit("damage"), "state").alias("h"), F.lit(0).alias("size"))
    long = said.unionByName(marred)
    facts = long.groupBy(*key).agg(
        F.array(*[F.count_if(F.col("obs") == o) for o in classes] or [F.lit(0)]).alias("c"),
        F.max((F.col("state") == "clean") & (F.col("pos") < F.col("size") - 1)).alias("followed"), (F.min("pos") < 0).alias("damage"),
    )
    facts = cut(facts.join(n_by, ["lead", "field"]))
    evidence = cut(facts.groupBy("c", "n", "damage").agg(F.count("*").alias("w")))
    sens, spec, prior = quality_model(evidence, classes, rounds)
    p = F.when(F.col("damage"), KNOWN).otherwise(F.least(F.greatest(truth(sens, spec, prior), F.lit(KNOWN)), F.lit(1 - KNOWN)))
    facts = facts.select(*key, "followed", "damage", p.alias("p"))
    # an abstract ends falsely where its last sentence is followed by others in a clean record
    ends = (F.col("field") == "abstract") & (F.col("pos") == F.col("size") - 1) & F.col("followed")
    odds = F.log(F.col("p") / (1 - F.col("p"))) + F.when(ends, math.log(KNOWN)).otherwise(0.0)
    judged = long.join(facts, key).groupBy("lead", "field", "ord").agg((F.count_if(F.col("p") <= 0.5) + F.count_if(ends)).alias("false"), F.sum(odds).alias("odds"))
    return rec, claims.join(judged, ["lead", "field", "ord"]), facts


def survivors(papers: DataFrame, rounds: int = 6) -> DataFrame:
    """lead_ord, field, best_ord for groups of two or more records.

    Null, blank and placeholder values are no claims and are never chosen while another is there; a group without any
    has no row for the field; equal values go to the smallest ord; repeated rows, extra columns and empty tables do no harm.
    """
    rec, r, _ = _judge(papers, rounds)
    is_abs = F.col("field") == "abstract"
    whole = is_abs & (F.col("false") == 0)
    # whole abstracts first, of several the latest; else the value of the greatest odds, which for lists is the longest true one
    rank = F.struct(
        F.when(is_abs, (F.col("false") > 0).cast("int")).otherwise(0),
        F.when(whole, F.lit(0.0)).otherwise(-F.round("odds", 6)),
        F.when(is_abs & F.col("at").isNotNull(), 0).otherwise(1),
        F.when(is_abs, -F.col("at")).otherwise(F.lit(0)),
        F.col("ord"),
    )
    best = r.groupBy("lead", "field").agg(F.min_by("value", rank).alias("value"))
    single = r.join(best, ["lead", "field", "value"]).groupBy("lead", "field").agg(F.min("ord").alias("best"))
    q = rec.select("lead", "ord", F.explode("q_").alias("h")).groupBy("lead", "h").agg(F.min("ord").alias("best"))
    q = q.select("lead", F.lit("matched_queries").alias("field"), "best").distinct()
    return single.select("lead", "field", "best").unionByName(q).select(
        F.col("lead").alias("lead_ord"), "field", F.col("best").alias("best_ord")
    )


def values(papers: DataFrame, rounds: int = 6) -> DataFrame:
    """lead_ord, field, value, confidence: what the surviving record of a group holds.

    Of the abstract one value (without a confidence below 1 where nothing speaks against it); of keywords every one that is judged true, from whatever record,
    with its probability; of matched_queries every one.  Spellings that differ in case or spaces are one value, as the record of the smallest ord has it.
    """
    rec, _, facts = _judge(papers, rounds)
    best = survivors(papers, rounds).filter("field = 'abstract'").select(F.col("lead_ord").alias("lead"), F.col("best_ord").alias("ord"))
    abstract = best.join(papers.select("ord", "abstract"), "ord").select("lead", F.lit("abstract").alias("field"), F.col("abstract").alias("value"), F.lit(1.0).alias("confidence"))
    lists = papers.select("ord", "keywords", "matched_queries").join(rec.select("ord", "lead"), "ord")
    text = lambda c: lists.select("lead", "ord", F.explode(c).alias("value")).filter("value is not null").withColumn("h", F.xxhash64(F.lower(_clean(F.col("value")))))
    kw = text("keywords").filter(~_absent(_clean(F.col("value")))).groupBy("lead", "h").agg(F.min_by("value", "ord").alias("value"))
    kw = kw.join(facts.filter("field = 'keywords' and p > 0.5").select("lead", "h", F.col("p").alias("confidence")), ["lead", "h"])
    q = text("matched_queries").filter(~_clean(F.col("value")).isin("", "*")).groupBy("lead", "h").agg(F.min_by("value", "ord").alias("value"))
    out = abstract.unionByName(kw.select("lead", F.lit("keywords").alias("field"), "value", "confidence"))
    return out.unionByName(q.select("lead", F.lit("matched_queries").alias("field"), "value", F.lit(1.0).alias("confidence"))).withColumnRenamed("lead", "lead_ord")
