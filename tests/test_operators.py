import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import classify as C
from paperloom.operators import dedup as D
from paperloom.operators import enrich as E
from paperloom.operators import filters as L
from paperloom.operators import normalize as N
from paperloom.plans.rules import Rule, RuleSet, parse_rules
from paperloom.schema import PAPER, RAW_JSON, RAW_XML

BASE = {f.name: ([] if f.dataType.simpleString().startswith("array") else None) for f in PAPER.fields}


def papers(spark, *rows, extra=("ord", "bigint")):
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PAPER.fields) + f", {extra[0]} {extra[1]}"
    return spark.createDataFrame([tuple(({**BASE, "source": "kci", "source_id": f"s{i}"} | r)[f.name] for f in PAPER.fields) + (i,) for i, r in enumerate(rows)], cols)


RULES = RuleSet((Rule("a", "cloud"), Rule("b", "cloud store", "anchored", (), ("forensic",)), Rule("c", "log")), ("pcr",))


def test_classify(spark):
    df = papers(
        spark, {"title": "Cloud store", "abstract": "log"}, {"title": "x", "keywords": ["log"], "abstract": "cloud"}, {"title": "store in cloud", "abstract": "a forensic view"},
        {"title": "cloud", "abstract": "a pcr test"}, {"title": None}, {"title": "app credential log"})
    r = C.classify(df, RULES).orderBy("ord").collect()
    assert [x["match_field"] for x in r] == ["title", "keyword", "title", "title", None, "title"]
    assert r[0]["categories"] == ["a"] and r[2]["categories"] == ["a", "b"] and r[1]["matched_keywords"] == ["log"]
    assert r[3]["is_relevant"] is False and r[3]["relevance_score"] == 0.0 and r[3]["relevance_reasons"][-1] == "exclude:pcr"
    assert r[5]["is_relevant"] is True and r[4]["is_relevant"] is False
    assert r[0]["relevance_reasons"] == ["matched_in:title", "title:cloud", "category:a", "mode:direct"]
    assert C.classify(df, RuleSet()).filter("is_relevant").count() == 0
    kept = C.keep_relevant(C.classify(papers(spark, {"title": "cloud pcr", "institution_id": "The Society"}), RULES), C.member(["society"], []), reason="r").first()
    assert kept["relevance_score"] == 1.0 and kept["relevance_reasons"] == ["r"] and kept["match_field"] == "journal"


def test_weighted_score(spark):
    r = C.weighted_score(papers(spark, {"title": "dfir"}, {"title": "forensic medicine"}, {})).orderBy("ord").collect()
    assert (r[0]["relevance_score"], r[0]["is_relevant"]) == (4.5, True)
    assert r[1]["relevance_score"] == -2.25 and r[2]["relevance_score"] == 0.0


def fold_model(rows):
    rich = lambda p: sum(1 for f in D.RICH if p[f]) + sum(len(p[f]) for f in D.RICH_LISTS)
    out = {}
    for p in rows:
        p = {k: list(v) if isinstance(v, list) else v for k, v in p.items()}
        k = ("doi", p["doi"].casefold()) if p["doi"] else ("id", f"{p['source']}:{p['source_id']}".casefold())
        if k not in out:
            out[k] = p
            continue
        a, b = out[k], p
        if rich(b) > rich(a):
            a, b = b, a
        for f in D.FILL:
            if a[f] is None or a[f] == "":
                a[f] = b[f]
        for f in D.UNION:
            have = {x.casefold() for x in a[f]}
            for x in b[f]:
                if x.casefold() not in have:
                    have.add(x.casefold())
                    a[f].append(x)
        if a["relevance_score"] is None or (b["relevance_score"] is not None and b["relevance_score"] > a["relevance_score"]):
            a["relevance_score"], a["is_relevant"] = b["relevance_score"], b["is_relevant"]
        out[k] = a
    return out


def test_fold_merge_is_the_left_fold(spark):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        rows.append(BASE | {
            "source": rng.choice(["kci", "scopus"]), "source_id": f"s{rng.randint(0, 60)}", "title": rng.choice([None, "", f"t{i}"]), "doi": rng.choice([None, "", f"10.1/X{rng.randint(0, 40)}"]),
            "abstract": rng.choice([None, f"a{i}"]), "is_fulltext": rng.choice([None, True, False]), "page_count": rng.choice([None, 0, i]),
            "keywords": rng.sample(["A", "a", "b", "c"], rng.randint(0, 3)), "matched_queries": rng.sample(["q", "Q", "r"], rng.randint(0, 2)),
            "relevance_score": rng.choice([None, 1.0, 2.0]), "is_relevant": rng.choice([None, True, False])})
    # the model keeps repeats within the richer row, as the operator does
    got = {(r["source"], r["source_id"], r["title"], r["doi"]): r.asDict() for r in D.fold_merge(papers(spark, *rows)).collect()}
    want = {(p["source"], p["source_id"], p["title"], p["doi"]): p for p in fold_model(rows).values()}
    assert got.keys() == want.keys()
    for k, p in want.items():
        assert {f: got[k][f] for f in p} == p


def test_first_wins_and_keys(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "x"), (2, None, "n"), (4, None, "m")], "ord int, k string, v string")
    assert sorted(D.first_wins(df, "k", "ord").collect(), key=lambda r: r["ord"]) == [(1, "a", "x"), (2, None, "n")]
    k = papers(spark, {"doi": "10.1/AB"}, {"doi": "", "source_id": "X"}, {"source_id": "", "title": "Foo, Bar"}).select(D.paper_key().alias("k"), "ord").orderBy("ord").collect()
    assert [r["k"] for r in k] == ["doi:10.1/ab", "id:kci:x", "title:foobar"]


def test_normalizers(spark):
    row = {f.name: None for f in RAW_XML.fields} | {"title_original": "", "title_english": "T", "doi": "d", "volume": "3", "issue": "", "keywords": ["가; b", "B"], "pub_year": "2024", "pub_mon": "3", "is_open_access": "Y", "matched_query": "q"}
    r = N.normalize_xml(spark.createDataFrame([row], RAW_XML)).first()
    assert (r["source_id"], r["title"], r["issue_id"], r["keywords"], r["registered_at"], r["is_fulltext"]) == ("d", "T", "3", ["가", "b"], "2024-03", True)
    assert (r["keyword_text_kor"], r["keyword_text_eng"], r["authors"], r["matched_queries"]) == ("가", "b", [], ["q"])
    j = N.normalize_json(spark.createDataFrame([{f.name: None for f in RAW_JSON.fields} | {"title": "T", "cover_date": "2024-1-5"}], RAW_JSON)).first()
    assert (j["source_id"], j["registered_at"], j["publication_year"], j["matched_queries"]) == ("T", "2024-01-05", 2024, [])
    back = N.from_stored(N.to_stored(papers(spark, {"categories": ["a", "*", "A"], "matched_keywords": ["k"], "keywords": ["x", "y"]}))).first()
    assert (back["categories"], back["relevance_reasons"], back["keywords"]) == (["a"], ["k"], ["x", "y"])
    with pytest.raises(Exception, match="no category"):
        N.checked_evidence(N.to_stored(papers(spark, {"source": "kci"}))).collect()


def test_filters(spark):
    p = papers(spark, {"publication_year": 2020, "institution_id": "(사)가나다학회"}, {"publication_year": None}, {"publication_year": 2019, "journal_id": "x", "institution_id": "Other Society"})
    assert [r["ord"] for r in L.year_range(p, 2020, 2021).collect()] == [0]
    t = L.term_table(spark, ("가나다학회", "third thing"))
    assert sorted(r["ord"] for r in L.not_blocked(p, t).collect()) == [1, 2]
    assert sorted(r["ord"] for r in L.not_blocked(p, t, F.col("publication_year") == 2020).collect()) == [0, 1, 2]
    codes = papers(spark, {"subject_code": '[{"code":"1"}]'}, {"subject_code": None}, {"subject_code": "2|1"})
    assert sorted(r["ord"] for r in L.allowed_codes(codes, ("1",)).collect()) == [0, 2] and L.allowed_codes(codes, ()).count() == 3
    known = spark.createDataFrame([("s0",)], "source_id string")
    late = papers(spark, {"updated_at": "2024-02"}, {"updated_at": ""}, extra=("ord", "bigint"))
    assert sorted(r["ord"] for r in L.incremental(late, known, "2024-01").collect()) == [0, 1]
    assert sorted(r["ord"] for r in L.incremental(late, known, "2024-03").collect()) == [1] and L.incremental(late, known, None).count() == 2


def test_enrich(spark):
    p = papers(spark, {"source_id": "a", "keywords": ["K"], "title": None, "institution_id": "old"}, {"source_id": "b"})
    d = spark.createDataFrame([("a", ["k", "L"])], "source_id string, keywords array<string>")
    x = E.stored_keywords(E.add_keywords(p, d)).orderBy("ord").collect()
    assert [r["keywords"] for r in x] == [["k", "L"], []]
    assert E.add_keywords(p, d).orderBy("ord").first()["keywords"] == ["K", "L"]
    rows = E.by_category(papers(spark, {"categories": ["x", "y"], "authors": ["A", "", "B"]}, {})).orderBy("sheet").collect()
    assert [(r["sheet"], r["authors"]) for r in rows] == [("x", "A; B"), ("y", "A; B"), ("미분류", "")]
    assert E.export_rows(papers(spark).limit(0)).count() == 0


def test_rules():
    r = parse_rules({"search_config": {"anchor_modes": {"anchored": ["X", "x"]}}, "top": {"leaf": {"direct": ["a", "A", " b  c "], "other": {"direct": ["no"]}, "anchored": ["d"]}}, "exclude": {"z": ["e"]}, "exclude_any": ["E", "f"]})
    assert [(x.category, x.keyword, x.mode, x.anchors) for x in r.rules] == [("leaf", "a", "direct", ()), ("leaf", "b c", "direct", ()), ("leaf", "d", "anchored", ("X",))]
    assert r.excludes == ("e", "f") and r.direct_keywords == ("a", "b c")
    assert parse_rules({"include_any": ["q"]}).rules[0].mode == "direct"
    with pytest.raises(ValueError):
        parse_rules([])


def test_long_names_are_blocked(spark):
    term = "Korean Institute of Information Security and Cryptology"
    names = [term, "Institute of Information Security and Cryptology, Korean", "Korean Institute of Information and Communication Security and Cryptology", "Korean Institute of Information Security",
             "Korean" + "x" * 17 + "Institute of Information Security and Cryptology", "Law of Society here", "Society for Law of Society"]
    p = papers(spark, *[{"institution_id": n} for n in names])
    assert sorted(r["ord"] for r in L.not_blocked(p, L.term_table(spark, (term, "Society of Law of Society"))).collect()) == [4, 5, 6]
