import json
from datetime import date

import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators.packed import atoms, split_packed
from paperloom.plans import slices as P
from paperloom.plans.rules import Rule, RuleSet, load_allowlist, load_blocklist, load_rules, near_term, remote_queries, rule_clauses
from paperloom.plans.settings import load_settings
from paperloom.pipeline import Policy, build_corpus, clean, export, live_json, live_xml, match_corpus, sheet_name
from paperloom.schema import DETAIL, RAW_JSON, RAW_XML
from paperloom.sources import paged as G
from paperloom.sources import records as S
from paperloom.sources.store import Store, parse_done, pending, upsert, with_ids
from paperloom.streaming.incremental import run_batch, run_stream, windowed_counts


def test_months_and_bisection():
    assert P.months("202311", "202402") == ["202311", "202312", "202401", "202402"]
    assert P.bisect_days("20240101", "20240104") == (("20240101", "20240102"), ("20240103", "20240104"))
    with pytest.raises(ValueError):
        P.bisect_days("20240101", "20240101")
    assert P.month_ranges(2024, 2026, today=date(2025, 2, 3))[-1] == ("202502", "202502")
    with pytest.raises(ValueError):
        P.month_ranges(2026, 2024, today=date(2025, 2, 3))
    assert P.search_years(2025) == (2020, 2021, 2022, 2023, 2024, 2025, 2026) and P.recent_years(2, 2025) == (2024, 2025)
    assert P.Window("202401", None, None, "20250101").label() == "pub=202401~* reg=*~20250101"
    assert P.id_segments(1, 10, 3) == [(1, 4), (5, 8), (9, 10)] and P.id_segments(5, 5, 8) == [(5, 5)]


def test_plan_covers_everything_once():
    days = {f"2024{m:02d}{d:02d}": (m * d) % 7 for m in range(1, 13) for d in range(1, 29)}

    def probe(w):
        return sum(n for d, n in days.items() if (not w.pub_from or w.pub_from <= d[:6]) and (not w.pub_to or d[:6] <= w.pub_to) and (not w.reg_from or w.reg_from <= d) and (not w.reg_to or d <= w.reg_to))

    got = P.plan(P.Window("202401", "202412"), probe, 40)
    assert sum(s.count for s in got) == sum(days.values()) and all(0 < s.count <= 40 for s in got)
    with pytest.raises(RuntimeError):
        P.plan(P.Window(reg_from="20240103", reg_to="20240103"), lambda w: 99, 40)


def test_bisect_histogram(spark):
    d = spark.createDataFrame([(date(2024, 1, i), 10 * i) for i in range(1, 20)], "d date, n bigint")
    got = P.bisect_histogram(d, 300)
    assert sum(n for _, _, n in got) == 1900 and all(n <= 300 or a == b for a, b, n in got)
    assert P.bisect_histogram(d.limit(0), 5) == []


def test_rule_files(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"x": {"direct": ["k", "file system log"]}, "exclude": ["e"]}), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"x": {"direct": ["K", "other"]}, "exclude": ["E"]}), encoding="utf-8")
    r = load_rules(tmp_path / "a.json", tmp_path / "b.json", tmp_path / "none.json")
    assert r.keywords == ("k", "file system log", "other") and r.excludes == ("e",)
    (tmp_path / "b.txt").write_text("﻿ a  b\n# c\nA B\n\nd\n", encoding="utf-8")
    assert load_blocklist(tmp_path / "b.txt") == ("a b", "d")
    (tmp_path / "l.json").write_text("[1, \" 2 \", null]", encoding="utf-8")
    assert load_allowlist(tmp_path / "l.json") == {"1", "2"} and load_allowlist(tmp_path / "no.json") == frozenset()
    assert near_term("file system log") == "file W/16 system W/16 log"
    assert rule_clauses(RuleSet((Rule("c", "a b", "anchored", (), ("x", "y z")), Rule("c", "A B", "anchored", (), ("X", "y z"))))) == ["(a W/16 b) AND ((x) OR (y W/16 z))"]
    assert remote_queries([2024], ["a", "A"])[0].startswith("TITLE-ABS-KEY((a)) AND PUBYEAR = 2024")
    s = load_settings({"KCI_PAGE_SIZE": "500", "KCI_MAX_WORKERS": "0", "KCI_ENABLE_SWEEP": "no"})
    assert (s.xml_page_size, s.workers, s.sweep) == (100, 1, False)


XML = """<root><result><total>x</total></result><record><journalInfo journal-id="J"><journal-name> N &amp;amp; M </journal-name></journalInfo><articleInfo article-id="A1"><title-group>
<article-title>first</article-title><article-title lang="original">제목</article-title><article-title lang="english"></article-title></title-group><author-group><author>b</author><author>b</author></author-group>
<abstract-group><abstract lang="english">abs</abstract></abstract-group><keyword-group><keyword>K</keyword><keyword>k</keyword><keyword> </keyword></keyword-group><citation-count kci="3" wos="1"/></articleInfo></record>
<record>broken</recor></root>"""


def test_xml(spark):
    r = S.parse_xml(S.xml_page_records(spark.createDataFrame([(XML,)], "xml string"))).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["arti_id"], r["journal_id"], r["journal_name"], r["title_original"], r["title_english"], r["keywords"], r["authors"]) == ("A1", "J", "N & M", "제목", None, ["K"], ["b", "b"])
    assert (r["abstract_english"], r["abstract_original"], r["citation_count_kci"]) == ("abs", None, "3")
    assert spark.createDataFrame([(XML,)], "x string").select(S.xml_total("x").alias("t")).first()["t"] == 0


def test_json(spark):
    e = {"dc:identifier": "SCOPUS_ID:7", "dc:title": " T ", "dc:creator": "A", "author": [{"authname": "a"}, {"ce:indexed-name": "B"}], "authkeywords": "x | y", "idxterms": "Y; z", "citedby-count": "n", "link": [{"@ref": "self", "@href": "u1"}, {"@ref": "scopus", "@href": "u2"}]}
    body = json.dumps({"search-results": {"opensearch:totalResults": "2", "entry": [e, {"link": []}]}})
    parsed = S.parse_json(S.json_entries(spark.createDataFrame([(body,), ("{broken",)], "json string")))
    r = parsed.collect()
    assert len(r) == 2 and (r[0]["scopus_id"], r[0]["title"], r[0]["url"], r[0]["author_names"], r[0]["keywords"], r[0]["cited_by_count"]) == ("7", "T", "u2", ["A", "B"], ["x", "y", "z"], None)
    good, bad = S.dead_letters(parsed, "scopus_id")
    assert good.count() == 1 and bad.count() == 1
    d = {"abstracts-retrieval-response": {"coredata": {"dc:title": "T", "dc:publisher": "P"}, "authors": {"author": {"ce:indexed-name": "A"}}, "authkeywords": {"author-keyword": [{"$": "k"}, "K", "l"]}, "subject-areas": {"subject-area": {"@code": "1700", "$": "n"}}}}
    x = S.parse_detail(spark.createDataFrame([(json.dumps(d),)], "json string")).first()
    assert (x["title"], x["publisher"], x["author_names"], x["keywords"], x["subject_areas"][0]["code"]) == ("T", "P", ["A"], ["k", "l"], "1700")


def test_paging(spark, tmp_path):
    data = list(range(7))
    assert [p for p, _ in G.pages(lambda n: (data[(n - 1) * 3 : n * 3], 7))] == [1, 2, 3]
    assert len(list(G.pages(lambda n: ([1], 10**9)))) == G.MAX_PAGES
    got = list(G.overlapping(lambda s, n: ([{"id": str(i)} for i in range(s, min(s + n, 60))], 60), 25, lambda x: x["id"], {"3"}))
    assert [x["id"] for x in got] == [str(i) for i in range(60) if i != 3]
    lim = G.RateLimiter(8, clock=lambda: 0.0, sleep=lambda s: None)
    for _ in range(9):
        lim.trouble()
    assert lim.rate == 0.5
    for _ in range(5):
        lim.fast()
    assert lim.rate == pytest.approx(1.3)
    tries, slept = [], []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise G.Throttled("500")
        return "ok"

    assert G.with_retries(call, 3, 1, sleep=slept.append) == "ok" and slept == [120.0, 120.0]
    assert G.retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 0) == 60 and G.retry_after("?") is None
    assert G.request_params({"title": "t", "keyword": ""}, 0, 900) == {"title": "t", "page": "1", "displayCount": "100"}
    for s, n in (("a", 2), ("b", 1)):
        (tmp_path / s).mkdir()
        for i in range(n):
            (tmp_path / s / f"page-{i + 1}.xml").write_text(f"{s}{i}", encoding="utf-8")
    (tmp_path / "b" / "page-2.xml").mkdir()
    spark.dataSource.register(G.PagedSource)
    rows = spark.read.format("paged_search").option("path", str(tmp_path)).option("retries", "0").load().collect()
    assert sorted((r["slice"], r["page"], r["body"]) for r in rows if r["body"]) == [("a", 1, "a0"), ("a", 2, "a1"), ("b", 1, "b0")]
    assert [(r["slice"], r["page"]) for r in rows if r["error"]] == [("b", 2)]


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    rows = lambda *x: spark.createDataFrame(list(x), "source_id string, v int")
    s.upsert("t", rows(("a", 1), ("b", 2)))
    s.upsert("t", rows(("b", 3), ("c", 4)))
    assert sorted(map(tuple, s.read("t").collect())) == [("a", 1), ("b", 3), ("c", 4)]
    before = sorted(map(tuple, upsert(s.read("t"), rows(("b", 3))).collect()))
    assert before == sorted(map(tuple, s.read("t").collect()))
    s.append_new("t", rows(("a", 9), ("d", 5)))
    s.delete("t", F.col("v") == 4)
    assert sorted(map(tuple, s.read("t").collect())) == [("a", 1), ("b", 3), ("d", 5)]
    s.set_state("k", "1")
    s.set_state("k", "2")
    assert s.get_state("k") == "2" and s.get_state("x", "-") == "-"
    s.mark_done("m", {"202401"})
    s.mark_done("m", {"202402"})
    assert s.done("m") == {"202401", "202402"} and parse_done("{broken") == set() and parse_done(None) == set()
    assert pending(["1", "2", "3", "4"], {"1", "2", "3", "4"}) == ["3", "4"] and pending(["1", "2", "3"], set()) == ["1", "2", "3"]
    ids = with_ids(spark.range(100).repartition(7).withColumnRenamed("id", "o"), "n", "o").orderBy("o").collect()
    assert [r["n"] for r in ids] == list(range(1, 101))
    with pytest.raises(FileNotFoundError):
        s.read("none")
    s.clear("t")
    assert s.read("t").count() == 0 and s.read("t").columns == ["source_id", "v"]


def test_store_versions(spark, tmp_path):
    s = Store(spark, str(tmp_path), buckets=8)
    rows = lambda *x: spark.createDataFrame(list(x), "source_id string, at int, v string")
    s.upsert("t", rows(*((f"k{i}", 1, "old") for i in range(60))))
    begun, before = s.read("t"), s._current("t")["parts"]
    # repeated keys in any order of arrival: the last by the order column stays
    for part in (rows(("k1", 3, "c"), ("k1", 2, "b"), (None, 1, "x")), rows(("k1", 2, "b"), (None, 1, "x"), ("k1", 3, "c")).repartition(3)):
        s.upsert("t", part, order="at")
        assert {(r["at"], r["v"]) for r in s.read("t").filter("source_id = 'k1'").collect()} == {(3, "c")}
    after = s._current("t")["parts"]
    assert sum(before.get(b) != after[b] for b in after) <= 2 < len(after)  # other buckets are not rewritten
    assert begun.filter("v = 'old'").count() == 60  # a reader that had begun keeps its version
    tie = upsert(rows(("a", 0, "s")), rows(("a", 1, "p"), ("a", 1, "q")).repartition(2), order="at").collect()
    assert [tuple(r) for r in tie] == [("a", 1, "q")]
    with pytest.raises(FileExistsError):
        s._files.put_new(f"t/v-{max(s._versions('t')):012d}.json", "{}")
    n = s.read("t").count()
    s.vacuum("t", keep=1)
    assert len(s._versions("t")) == 1 and s.read("t").count() == n


def _raw(spark, n, start=0):
    base = {f.name: None for f in RAW_XML.fields}
    rows = [base | {"arti_id": f"A{i}", "title_original": "cloud" if i % 2 else "other", "pub_year": "2024", "keywords": [], "matched_query": "q"} for i in range(start, start + n)]
    return spark.createDataFrame(rows, RAW_XML).withColumn("ord", F.regexp_extract("arti_id", r"(\d+)", 1).cast("bigint"))


POLICY = Policy(RuleSet((Rule("c", "cloud"),)), 2020, 2025)


def test_incremental_is_full(spark, tmp_path):
    detail = spark.createDataFrame([("A1", ["k"])], "source_id string, keywords array<string>")
    a, b = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    for part in (_raw(spark, 4, 1), _raw(spark, 6, 3)):
        build_corpus(a, part, detail)
        match_corpus(a, POLICY)
    build_corpus(b, _raw(spark, 8, 1), detail)
    match_corpus(b, POLICY, full=True)
    key = lambda s: sorted((r["source_id"], r["keywords_json"], r["category"], r["summary"]) for r in s.read("papers").collect())
    assert key(a) == key(b) and len(key(a)) == 4 and a.get_state("match_max_id") == "8"
    assert match_corpus(a, POLICY) == 0
    clean(a, Policy(POLICY.rules, 2025, 2025))
    assert a.read("papers").count() == 0


def test_live_chains(spark, tmp_path):
    detail = spark.createDataFrame([("A1", ["cloud", "x"])], "source_id string, keywords array<string>")
    x = live_xml(_raw(spark, 4), detail, POLICY).orderBy("source_id").collect()
    assert [(r["source_id"], r["keywords"]) for r in x] == [("A1", ["cloud", "x"]), ("A3", [])]
    j = spark.createDataFrame([{f.name: None for f in RAW_JSON.fields} | {"scopus_id": str(i), "title": "Cloud" if i else "x", "cover_date": "2024"} for i in range(3)], RAW_JSON).withColumn("ord", F.col("scopus_id").cast("bigint"))
    d = spark.createDataFrame([{f.name: None for f in DETAIL.fields} | {"publisher": "P", "subject_areas": [("1", None, None)]}], DETAIL).withColumn("source_id", F.lit("1"))
    known = spark.createDataFrame([("2",)], "source_id string")
    r = live_json(j, d, known, Policy(POLICY.rules, 2020, 2025, allowed=("1",)), "2025").collect()
    assert [(p["source_id"], p["institution_id"]) for p in r] == [("1", "P")]
    export(live_xml(_raw(spark, 4), detail, POLICY), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/by_category")).filter("sheet = 'c'").count() == 2
    used = {"전체"}
    assert [sheet_name(v, used) for v in ("a/b", "A B", "x" * 40, "")] == ["a b", "A B 2", "x" * 31, "미분류"]


def test_stream_equals_batch(spark, tmp_path):
    src, s1, s2 = str(tmp_path / "in"), Store(spark, str(tmp_path / "s1")), Store(spark, str(tmp_path / "s2"))
    df = spark.range(20).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("source_id"), "id")
    work = lambda x: x.filter("id % 2 = 0")
    df.filter("id < 10").coalesce(1).write.parquet(src)
    run_stream(spark, src, df.schema, work, s1, "t", str(tmp_path / "cp"))
    df.filter("id >= 10").coalesce(1).write.mode("append").parquet(src)
    run_stream(spark, src, df.schema, work, s1, "t", str(tmp_path / "cp"))
    run_batch(s2, df.filter("id < 10"), work, "t", "m")
    run_batch(s2, df, work, "t", "m")
    assert sorted(s1.read("t").collect()) == sorted(s2.read("t").collect()) and s1.read("t").count() == 10
    w = windowed_counts(spark.sql("select timestamp'2024-01-01 00:10:00' as ts union all select timestamp'2024-01-01 01:10:00'"), "ts", "1 hour").collect()
    assert sorted(r["n"] for r in w) == [1, 1]


PACKED = [
    ("a; b; c", ["a", "b", "c"]), ("주제어: 가, 나 다", ["가", "나 다"]), ("[주제어] 가;나", ["가", "나"]), ("1) x 2) y", ["x", "y"]), ("#x #y", ["x", "y"]), ("x||y|", ["x", "y"]),
    ('"p, q"; r', ["p, q", "r"]), ("“p; q”, r", ["p; q", "r"]), ("xx, yy.", ["xx", "yy"]), ('"so ""p"""; r', ['so "p"', "r"]), ("\xa0x、y  ", ["x", "y"]), ("KEYWORDS - x\ny", ["x", "y"]), ("x, x", ["x", "x"]),
]


def test_split_packed(spark):
    rows = [(i, t, "k") for i, (t, _) in enumerate(PACKED)] + [(100, None, "k"), (101, "  ", None), (102, "", "")]
    got = split_packed(spark.createDataFrame(rows, "ord bigint, f string, keyword string"), "ord", ["f"]).collect()
    for i, (_, want) in enumerate(PACKED):
        assert [r["keyword"] for r in sorted((r for r in got if r["ord"] == i), key=lambda r: r["pos"])] == want
    assert {r["ord"] for r in got} == set(range(len(PACKED)))
    assert split_packed(spark.createDataFrame([], "ord bigint, f string"), "ord", ["f"]).count() == 0


def test_compounds_are_learned(spark):
    lists = [f"w{i}; TCP/IP; v{i}" for i in range(30)] + [f"w{i}/v{i}/u{i}" for i in range(30)] + ["w1/TCP/IP/v2", "w3, TCP/IP, v4"]
    df = spark.createDataFrame(list(enumerate(lists)), "ord bigint, f string")
    got = {(r["ord"], r["pos"]): r["keyword"] for r in split_packed(df, "ord", ["f"]).collect()}
    assert [got[60, k] for k in (1, 2, 3)] == ["w1", "TCP/IP", "v2"] and [got[61, k] for k in (1, 2, 3)] == ["w3", "TCP/IP", "v4"]
    assert [got[30, k] for k in (1, 2, 3)] == ["w0", "v0", "u0"]
    long = ";".join(f"k{i}" for i in range(3000))
    assert split_packed(spark.createDataFrame([(1, long)], "ord bigint, f string"), "ord", ["f"]).count() == 3000


def test_atoms_keep_text():
    text, spans, kinds = atoms("Key words : a;; b, c")
    assert [text[x:y] for x, y in spans] == ["a", "b", "c"] and kinds == [";", ","]


def test_lattice_against_all_parses():
    import itertools
    import math

    from paperloom.operators import packed as P

    s = P.Splitter({"a": 5, "b": 3, "c, d": 4, "e/f": 2, "e": 9, "g; h; i": 2, "d": 1}, 26)

    def every(text, spans, kinds):
        """Posterior of each value over all parses, one by one, and the weight of the best parse."""
        main = max(set(kinds), key=lambda k: (sum(x == k for x in kinds), k))
        mass, best = {}, -1e9
        for cuts in itertools.product((False, True), repeat=len(kinds)):
            if any(k == "1" and not c for c, k in zip(cuts, kinds)):
                continue
            w = sum((0 if k in (main, "1") else P.OTHER_OUT) if c else (P.SAME_IN if k == main else P.OTHER_IN.get(k, P.RARE_IN)) for c, k in zip(cuts, kinds))
            ends = [i for i, c in enumerate((*cuts, True)) if c]
            parts = list(zip([0, *(e + 1 for e in ends)], ends))
            values = [P._key(text[spans[x][0] : spans[y][1]]) for x, y in parts]
            p = math.exp(w)
            for v, (x, y) in zip(values, parts):
                b, k = math.exp(P.BASE + (y - x) * P.INNER), math.exp(s.logp.get(v, -99))
                p *= b + k
                w += math.log(max(b, k))
            best = max(best, w)
            for v in values:
                mass[v] = mass.get(v, 0) + p
            mass[None] = mass.get(None, 0) + p
        return {v: p / mass[None] for v, p in mass.items() if v is not None}, best

    rng = random.Random(2)
    for _ in range(150):
        text, spans, kinds = atoms("".join(rng.choice("abcdefghijk") + rng.choice([", ", ", ", "; ", "/", " ;, "]) for _ in range(rng.randint(1, 7))) + "z")
        got = {}
        for v, p in s.posteriors(text, spans, kinds):
            got[v] = got.get(v, 0) + p
        want, _ = every(text, spans, kinds)
        assert all(abs(got.get(v, 0) - p) < 5e-3 for v, p in want.items())
        cut_ = s.viterbi(text, spans, kinds)
        assert cut_ and [c for v in cut_ for c in v if c.isalpha()] == [c for c in text if c.isalpha()]
    # long texts and values of many atoms: nothing is left out
    assert len(s.viterbi(*atoms(", ".join(f"w{i}" for i in range(5000))))) == 5000
    assert s.viterbi(*atoms("; ".join(["x", "y", "p, q, r, s, t, u", "z", "k", "l", "m", "n"]))) == ["x", "y", "p, q, r, s, t, u", "z", "k", "l", "m", "n"]
