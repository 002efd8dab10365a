"""The operators on small tables: nulls, blanks, ties, copies, empty tables, long texts, clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm.increments import ShardedIndex, accept, encode, first_ids, repeats, same_paper
from paperloom.llm.languages import find_languages, found
from paperloom.llm import linkage
from paperloom.llm.linkage import _encode, candidates, compare, crowd_patterns, crowds, link, near_titles
from paperloom.llm.mixing import mix, rates, shares
from paperloom.llm.names import link_names, name_pairs
from paperloom.llm.packing import pack, usage
from paperloom.llm.reading import reading_levels
from paperloom.llm.sentences import align
from paperloom.llm.survivors import components, doi_key, source_key, survivors, values
from paperloom.llm.tokens import token_counts

KO = "이 논문에서는 디지털 증거의 수집 절차를 살펴보았다. 분석 결과를 표로 정리하였다."
EN = "This paper examines how digital evidence is collected. The results are given in a table."
DE = "In diesem Beitrag wird untersucht, wie die Beweissicherung funktioniert. Künftig sollte die Datei geregelt werden."
JA = "本稿ではデジタル証拠について検討する。今後は標準化が必要であると考えられる。"


def test_languages(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([(KO, "ko"), (EN, "en"), (DE, "de"), (JA, "ja")] * 8)]
    rows += [(100, KO + "\n" + EN, "ko"), (101, EN, "ko-KR"), (102, "  ", None), (103, EN, None), (104, "12 34.", ""), (105, EN * 300, "eng"), (106, KO + " (" + EN + ")", "kor")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    p = spark.createDataFrame([(1, "디지털 증거의 수집 = Collection of digital evidence", None, JA), (2, "디지털 증거의 수집 절차", "", None)], "ord bigint, title_kor string, title_other string, abstract_other string")
    s = find_languages(docs, p)
    assert all(0 < r["confidence"] <= 1 for r in s.collect())
    got = {}
    for r in found(s).collect():
        got.setdefault((r["field"], r["rec_id"]), []).append((r["seg_no"], r["lang"]))
    got = {k: [l for _, l in sorted(v)] for k, v in got.items()}
    assert got == {("text", 100): ["ko", "en"], ("text", 101): ["en"], ("text", 103): ["en"], ("title_kor", 1): ["ko", "en"], ("abstract_other", 1): ["ja"]}
    assert find_languages(docs.limit(0), p.limit(0)).count() == 0


def test_names(spark):
    rows = [(["지카둔 케논", "Kenon Jikadun", "Jikadun, K.", "외 2인", None, " "], "가나디지털증거학회(Gana Society of Digital Evidence)"), (["지카둔케논", "지카둔 시논", "Sinon Jikadun", "Kneon Jikadun"], "(사)가나디지털증거학회"),
            (None, None), (["Jikadun, K."], "GANA SOCIETY OF DIGITAL EVIDENCE"), ([], "가나디지털즘거학회"), (["Jikadun, K."], "가나대학교 디지털증거연구소")] * 2
    df = spark.createDataFrame(rows, "authors array<string>, institution_id string").withColumn("name", F.lit("clash")).withColumn("kind", F.lit(1))
    by = {}
    for r in link_names(df).collect():
        by.setdefault((r["kind"], r["entity"]), set()).add(r["name"])
    groups = {frozenset(v) for v in by.values()}
    assert frozenset({"지카둔 케논", "Kenon Jikadun", "Jikadun, K.", "지카둔케논", "Kneon Jikadun"}) in groups
    assert frozenset({"지카둔 시논", "Sinon Jikadun"}) in groups
    assert frozenset({"가나디지털증거학회(Gana Society of Digital Evidence)", "(사)가나디지털증거학회", "GANA SOCIETY OF DIGITAL EVIDENCE", "가나디지털즘거학회"}) in groups
    pairs = name_pairs(link_names(df)).collect()
    assert all(r["name_lo"] < r["name_hi"] for r in pairs) and len(pairs) == len(set(pairs))
    assert link_names(df.limit(0)).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, f"a{rng.randint(0, 60)}"]), rng.choice([None, f"b{rng.randint(0, 60)}"])) for i in range(200)]
    up = list(range(200))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k in (1, 2):
        seen = {}
        for r in rows:
            if r[k] is not None:
                a, b = sorted((root(seen.setdefault(r[k], r[0])), root(r[0])))
                up[b] = a
    got = {r["ord"]: r["lead"] for r in components(spark.createDataFrame(rows, "ord bigint, a string, b string"), "ord", "a", "b").collect()}
    assert got == {i: root(i) for i in range(200)}
    # a chain, whose rounds grow with its logarithm
    chain = [(i, f"a{(i + 1) // 2}", f"b{i // 2}") for i in range(400)]
    random.Random(6).shuffle(chain)
    assert {r["lead"] for r in components(spark.createDataFrame(chain, "ord bigint, a string, b string"), "ord", "a", "b", max_rounds=12).collect()} == {0}
    keys = spark.createDataFrame([("https://doi.example/10.123/AB.c", "kci", "unknown"), ("-", "kci", "x"), (None, None, None)], "d string, s string, i string").select(doi_key(F.col("d")).alias("d"), source_key(F.col("s"), F.col("i")).alias("k")).collect()
    assert [tuple(r) for r in keys] == [("10.123/ab.c", None), (None, "kci:x"), (None, None)]


PAPERS = "ord bigint, source string, source_id string, doi string, updated_at string, abstract string, keywords array<string>, matched_queries array<string>, extra int"


def test_survivors(spark):
    full = "첫째 문장이다. 둘째 문장이다. 셋째 문장이다."
    rows = []
    for g in range(30):  # enough groups to learn from
        b, d = g * 10, f"10.999/{g}"
        rows += [(b, "kci", f"A{g}", d, "2020-01-01", full.replace("첫째", f"첫째{g}"), ["a", "b"], ["q", "*"], 1), (b + 1, "scopus", f"B{g}", d.upper(), "2020-02-01", f"첫째{g} 문장이다. 둘째", ["a; b; c"], ["Q", "r"], 1),
                 (b + 2, "kci", f"A{g}", "-", "2020-03-01", "초록 없음", ["a", "b", "c"], None, 1), (b + 3, "kci", f"A{g}", None, None, f"첫째{g} 문장이다.", ["a", "a "], [], 1)]
    rows.append((999, "kci", "Z", None, None, "single.", ["k"], ["z"], 1))
    got = {}
    for r in survivors(spark.createDataFrame(rows, PAPERS)).collect():
        got.setdefault((r["lead_ord"], r["field"]), set()).add(r["best_ord"] - r["lead_ord"])
    for g in range(30):
        assert got[g * 10, "abstract"] == {0} and got[g * 10, "keywords"] == {2} and got[g * 10, "matched_queries"] == {0, 1}
    assert not any(k[0] == 999 for k in got)
    # every keyword judged true stays, from whatever record; packed lists give none; every query stays
    held = {}
    for r in values(spark.createDataFrame(rows, PAPERS)).collect():
        assert 0.5 < r["confidence"] <= 1
        held.setdefault((r["lead_ord"], r["field"]), set()).add(r["value"])
    assert held[0, "keywords"] == {"a", "b", "c"} and held[0, "matched_queries"] == {"q", "r"} and held[0, "abstract"] == {full.replace("첫째", "첫째0")}
    assert survivors(spark.createDataFrame([], PAPERS)).count() == 0
    null = spark.createDataFrame([(1, "kci", "A", None, None, None, None, None, 0), (2, "kci", "A", None, None, "", [], ["*"], 0)], PAPERS)
    assert survivors(null).count() == 0


def test_align(spark):
    rng = random.Random(6)
    pool = [(f"{k}은 중요하다고 판단하였다.", f"The {e} was judged to be important.") for k, e in (("증거", "evidence"), ("기록", "record"), ("영상", "video"), ("암호", "cipher"), ("서버", "server"), ("전화", "phone"), ("지문", "finger"), ("문서", "document"))]
    pool += [(f"{k}의 수는 {{n}}건이다.", f"There are {{n}} cases of {e}.") for k, e in (("삭제", "deletion"), ("침해", "intrusion"), ("위조", "forgery"), ("복구", "recovery"))]
    rows, want = [], {}
    for i in range(150):
        n = str(rng.randint(100, 900))
        pick = rng.sample(pool, 4)
        order = rng.sample(range(4), 4)
        rows.append((i, " ".join(a.format(n=n) for a, _ in pick), " ".join(pick[j][1].format(n=n) for j in order), "x"))
        want[i] = {(j + 1, k + 1) for k, j in enumerate(order)}
    rows += [(900, None, "x y.", ""), (901, "가.", "", ""), (902, " ", "a.", "")]
    got = {}
    df = spark.createDataFrame(rows, "id bigint, a string, b string, a_no string")
    for r in align(df, "id", "a", "b").collect():
        got.setdefault(r["id"], set()).add((r["a_no"], r["b_no"]))
    assert sum(len(got.get(i, set()) & w) for i, w in want.items()) >= 0.9 * 600
    assert set(got) <= set(range(150))
    assert align(df.limit(0), "id", "a", "b").count() == 0


def _paper(i, title, page, **more):
    return {"id": i, "source_id": f"S{i}", "title": title, "title_kor": None, "title_eng": title, "doi": None, "authors_json": '["Kenon Jikadun"]', "journal_id": "J", "institution_id": None, "issue_id": "3_1", "first_page": str(page),
            "final_page": str(page + 9), "issn": "1234-5678", "eissn": None, "publication_year": 2020, "registered_at": "2020-01"} | more


PAPER_SCHEMA = "id bigint, source_id string, title string, title_kor string, title_eng string, doi string, authors_json string, journal_id string, institution_id string, issue_id string, first_page string, final_page string, issn string, eissn string, publication_year int, registered_at string"


def test_link(spark):
    rng = random.Random(7)
    words = "alpha beta gamma delta omega sigma kappa lambda theta zeta iota upsilon".split()
    a, b = [], []
    for i in range(120):
        t = " ".join(rng.sample(words, 6)) + f" study {i}"
        fam = rng.choice(["Jikadun", "Sinon", "Runon", "Rensasa"])
        a.append(_paper(i, t, i * 3 + 1, authors_json=f'["Ke {fam}"]', issue_id=f"{i % 9}_2", issn=f"1000-{i % 7:04d}", publication_year=2000 + i % 9))
        if i % 2:
            b.append(_paper(10_000 + i, t.upper().replace("STUDY", "STUDDY"), i * 3 + 1, authors_json=f'["{fam}, K."]', issue_id=f"{i % 9}_2", issn=f"1000{i % 7:04d}", publication_year=2000 + i % 9))
    b += [_paper(20_000, None, 5000, authors_json=None, issue_id=None, issn=None, first_page=None, final_page=None, publication_year=None, registered_at=None), _paper(20_001, "unlike all others here", 7000, issue_id="44_1", publication_year=1980, authors_json='["Zz, Q."]')]
    kci, scopus = spark.createDataFrame(a, PAPER_SCHEMA), spark.createDataFrame(b, PAPER_SCHEMA)
    got = {(r["a_id"], r["b_id"]) for r in link(kci, scopus).collect()}
    want = {(i, 10_000 + i) for i in range(1, 120, 2)}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 2
    assert link(kci.limit(0), scopus).count() == 0


def test_repeats(spark):
    rng = random.Random(8)
    words = "가나 다라 마바 사아 자차 카타 파하 거너 더러 머버".split()
    old = [_paper(i, " ".join(rng.sample(words, 5)) + f" {i}번", i * 3 + 1, title_eng=None, issue_id=f"{i % 11}_{i % 4}", journal_id=f"J{i % 6}", authors_json=f'["지카둔 {rng.choice("가나다라")}논"]') for i in range(300)]
    new, want = [], set()
    for k in range(40):
        src = old[k * 7]
        no, i = k % 3 + 1, 1000 + k
        new.append(src | {"id": i, "source_id": rng.choice([src["source_id"], f"N{i}", "unknown"]), "title": src["title"].replace(" ", ""), "batch_no": no})
        want.add((src["id"], i))
    new += [_paper(2000, "전혀 다른 논문", 9000, title_eng=None, source_id="unknown", journal_id="Q") | {"batch_no": 1}, _paper(2001, None, 1, source_id="unknown", journal_id=None, issue_id=None, first_page=None, final_page=None, authors_json=None) | {"batch_no": 2},
            _paper(2002, "새 논문 하나", 8000, title_eng=None, journal_id="R") | {"batch_no": 2}, _paper(2003, "새 논문 하나", 8000, title_eng=None, journal_id="R") | {"batch_no": 3}]
    want.add((2002, 2003))
    hist, batch = spark.createDataFrame(old, PAPER_SCHEMA), spark.createDataFrame(new, PAPER_SCHEMA + ", batch_no int")
    got = {(r["first_id"], r["new_id"]) for r in repeats(hist, batch, shard_size=100).collect()}
    assert len(got & want) >= 0.95 * len(want) and not got - want
    assert repeats(hist, batch.limit(0)).count() == 0
    chain = spark.createDataFrame([(5, 4), (4, 3), (3, 1), (9, 8)], "new_id bigint, old_id bigint")
    assert {(r["new_id"], r["first_id"]) for r in first_ids(chain).collect()} == {(5, 1), (4, 1), (3, 1), (9, 8)}


def test_pack_and_mix(spark):
    pytest.importorskip("public_tokenizers")
    docs = spark.createDataFrame([(1, "a b c " * 50, "s"), (2, "", "s"), (3, None, "t"), (4, "가나다 " * 700, "t"), (5, "x y z", "u"), (6, "x y z", "u")], "doc_id bigint, text string, source string")
    sizes = token_counts(docs, keep=("source",)).cache()
    n = {r["doc_id"]: r["n_tokens"] for r in sizes.collect()}
    assert n[2] == n[3] == 0 and n[5] == n[6] > 0
    specs = spark.createDataFrame([(1, 64), (2, 512), (3, None), (4, 0)], "spec_id int, capacity_tokens int")
    p = pack(sizes, specs).collect()
    for spec, cap in ((1, 64), (2, 512)):
        rows = [r for r in p if r["spec_id"] == spec]
        total, at = {}, {}
        for r in rows:
            total[r["container_id"]] = total.get(r["container_id"], 0) + r["n_tokens"]
            at.setdefault(r["doc_id"], []).append((r["start_token"], r["n_tokens"]))
        assert max(total.values()) <= cap and set(at) == {1, 4, 5, 6}
        for d, pieces in at.items():
            pieces.sort()
            assert sum(x for _, x in pieces) == n[d] and all(s == sum(x for _, x in pieces[:k]) for k, (s, _) in enumerate(pieces))
            assert len(pieces) == max(1, -(-n[d] // cap))
    assert {r["spec_id"] for r in usage(pack(sizes, specs), specs).collect()} == {1, 2} and pack(sizes.limit(0), specs).count() == 0

    big = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "big").when(F.col("id") < 2900, "mid").otherwise("small").alias("source"), F.lit(10).cast("bigint").alias("n_tokens"))
    t = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "mid", 0.3, None), ("m", "small", 0.2, 4), ("m2", "absent", 0.5, 1), ("m2", "big", 0.5, 1)], "mix_id string, source string, target_share double, max_repeats int")
    got = {(r["mix_id"], r["source"]): r for r in shares(mix(big, t), rates(big, t)).collect()}
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert abs(got["m", s]["actual_share"] - share) < 0.03
    assert got["m", "small"]["most_copies"] <= 4 and got["m2", "absent"]["short"] and got["m2", "big"]["actual_share"] == 1.0
    assert sorted(mix(big, t).collect()) == sorted(mix(big, t).collect()) and mix(big.limit(0), t).count() == 0


def test_reading(spark):
    rng = random.Random(9)
    easy = ["We see the red door now.", "The cat has a box.", "Put the bag down here.", "I look for my key."]
    mid = ["The report lists every file that was copied before the review.", "The log was checked again because the record did not match.", "Each device should be described together with its owner.", "The result was found after the data had been moved."]
    hard = ["Notwithstanding the epistemic indeterminacy, the characterisation remains irreducibly contingent upon hermeneutic presuppositions.", "The heterogeneity of the construct precludes any straightforward generalisation under asymptotic perturbation.",
            "Such a construal is undermined by heteroscedasticity inherent in the doctrine.", "It follows that the operational definition necessarily entails a formalisation."]
    levels = {1: easy, 3: mid, 5: hard}
    ko = "이것은 상자입니다. 문을 보세요. 열쇠가 있어요. 친구를 찾아요. 책을 다시 보았어요."
    rows = [(i, " ".join(rng.choice(levels[l]) for _ in range(8)), "en", l) for i, l in enumerate(rng.choice([1, 3, 5]) for _ in range(160))]
    rows += [(900, ko, "ko", 1), (901, ko * 2, "ko", 1), (902, "Short. Text.", "en", 1), (903, "", "en", 1)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, "r", l if i % 11 else None) for i, _, _, l in rows if i % 2 == 0 and i < 900] + [(12345, "r", 2)], "doc_id bigint, rater string, read_level int")
    got = {r["doc_id"]: r["read_level"] for r in reading_levels(docs, labels).collect()}
    test = [(i, l) for i, _, _, l in rows if i % 2 and i < 900]
    assert sum(got[i] == l for i, l in test) >= 0.9 * len(test)
    assert 902 not in got and 903 not in got and all(v in (1, 2, 3, 4, 5) for v in got.values())
    assert reading_levels(docs, labels.limit(0)).count() == 0


def test_index_is_taken_up_again(spark, tmp_path):
    """A later run adds a batch to the stored index; it is given the batch alone, and finds what all pairs compared one by one give."""
    rng = random.Random(11)
    words = "가나 다라 마바 사아 자차 카타 파하 거너 더러 머버".split()
    old = [_paper(i, " ".join(rng.sample(words, 5)) + f" {i}번", i * 3 + 1, title_eng=None, issue_id=f"{i % 11}_{i % 4}", journal_id=f"J{i % 6}", source_id=f"S{i % 250}") for i in range(300)]
    new = [rng.choice(old) | {"id": 1000 + k, "source_id": rng.choice(["unknown", f"S{k}", f"N{k}"]), "first_page": rng.choice([None, str(k)])} for k in range(60)]
    hist, batch = spark.createDataFrame(old, PAPER_SCHEMA), spark.createDataFrame(new, PAPER_SCHEMA)
    index = ShardedIndex(spark, str(tmp_path / "index"), shard_size=100)
    index.add_batch(hist.filter("id < 200"))
    index.add_batch(hist.filter("id >= 200"))
    again = ShardedIndex.open(spark, str(tmp_path / "index"))
    got = {(r["new_id"], r["first_id"]) for r in accept(again, batch).collect()}
    assert all(r["recall"] >= 0.9 for r in again.recall().collect()) and again.recall().count() == 4
    e = encode(hist.unionByName(batch)).toPandas().sort_values("id")
    f, b = (np.frombuffer(b"".join(e[k]), np.int64).reshape(len(e), -1) for k in ("feat", "bits"))
    first = {}
    for i, x in enumerate(e["id"]):
        hit = np.flatnonzero(same_paper(np.broadcast_to(f[i], f[:i].shape), np.broadcast_to(b[i], b[:i].shape), f[:i], b[:i]) >= 0)
        if len(hit):
            first[x] = min(first.get(y, y) for y in e["id"].iloc[hit])
    want = {(x, y) for x, y in first.items() if x >= 1000}
    assert len(want) > 30 and got == want
    # a batch beyond the broadcast bound is shuffled to the shards, with the same links
    q = encode(batch).cache()
    assert sorted(again.search(q, 60).collect()) == sorted(again.search(q, 60, max_broadcast=0).collect())
    assert accept(again, batch.limit(0)).count() == 0 and again.batches == 4
    again.compact()
    assert sorted(map(tuple, ShardedIndex.open(spark, str(tmp_path / "index")).search(q, 60).distinct().select("new_id", "old_id").collect())) == sorted(map(tuple, again.search(q, 60).distinct().select("new_id", "old_id").collect()))
    with pytest.raises(FileExistsError):
        ShardedIndex(spark, str(tmp_path / "index"))


def test_repeats_of_a_crowd(spark):
    copy = _paper(0, "가나 다라 마바 사아", 7, title_eng=None, issue_id="3_1", journal_id="J1", doi=None)
    # copies under other ids, unlike copies (the page, the title), and a pair of the history that only hangs together by its second record
    old = [copy | {"id": i, "source_id": f"S{i}"} for i in range(2, 400)]
    old += [copy | {"id": 400 + i, "source_id": f"S{400 + i}", "title": f"가나 다라 마바 사아 {i:03d}", "authors_json": f'["Kenon Jikadun", "Ka N{i}"]', "first_page": "8"} for i in range(200)]
    old += [_paper(1000, "거너 더러 머버 서어 저처", 50, title_eng=None, doi="10.1234/ab", authors_json=None, first_page=None, final_page=None, issue_id="8_1", journal_id="J8"),
            _paper(1001, "거너 더러 머버 서어 저처", 50, title_eng=None, doi="10.1234/ab", authors_json='["Ru Sinon"]', issue_id="8_1", journal_id="J8")]
    new = [copy | {"id": 5000, "source_id": "N0"}, copy | {"id": 5001, "source_id": "N1", "first_page": "8", "title": "가나 다라 마바 사아 777"},
           _paper(5002, None, 50, title_eng=None, authors_json='["Ru Sinon"]', issue_id="8_1", journal_id="J8"),
           _paper(5003, "전혀 다른", 99, title_eng=None, source_id="S1001", issue_id="8_1", journal_id="J8", authors_json=None, first_page=None, final_page=None)]
    got = {r["new_id"]: r["first_id"] for r in repeats(spark.createDataFrame(old, PAPER_SCHEMA), spark.createDataFrame([r | {"batch_no": 1} for r in new], PAPER_SCHEMA + ", batch_no int")).collect()}
    assert got[5000] == 2 and got[5002] == 1000 and got[5001] in (2, 400) and set(got) <= {5000, 5001, 5002, 5003}


def test_candidates_of_common_titles_and_places(spark):
    blank = {k: None for k in ("authors_json", "issue_id", "issn", "first_page", "final_page", "publication_year", "registered_at")}
    a = [_paper(i, "Recent Court Rulings", 1, **blank) for i in range(70)] + [_paper(100 + i, f"{i} alpha {i * 31}", 1, authors_json='["Kim, A."]') for i in range(70)]
    b = [_paper(1000, "Recent Court Ruligs", 1, **blank), _paper(1001, "wholly unlike that", 1, authors_json='["Zz, Q."]', issn=None)]
    x, y = (_encode(spark.createDataFrame(r, PAPER_SCHEMA)) for r in (a, b))
    got = {(r["a_id"], r["b_id"]) for r in candidates(x, y).collect()}
    assert got == {(i, 1000) for i in range(70)} | {(100 + i, 1001) for i in range(70)}


def test_common_titles_are_compared_in_blocks(spark, monkeypatch):
    """Pairs of common titles are never rows, and count and match as they do one by one."""
    rng = random.Random(9)
    more = lambda: {"authors_json": f'["Ke {rng.choice(["Jikadun", "Sinon", "Runon"])}"]', "issue_id": f"{rng.randint(1, 9)}_{rng.choice(['1', '2', ''])}", "issn": rng.choice([None, "1000-0001", "1000-0002"]), "publication_year": rng.choice([None, 2001, 2002]), "registered_at": None}
    a = [_paper(i, "Recent Court Rulings", rng.randint(1, 40), **more()) for i in range(80)]
    b = [r | {"id": 1000 + r["id"], "title_eng": rng.choice(["Recent Court Rulings", "Recent Court Ruligs", "Recent Court Rulings (Part II)"]), "doi": None} for r in a[:70]]
    kci, scopus = (spark.createDataFrame(r, PAPER_SCHEMA) for r in (a, b))
    monkeypatch.setattr(linkage, "SIDE", 30)
    monkeypatch.setattr(linkage, "CROWD", 100)
    x, y = (_encode(t) for t in (kci, scopus))
    x, y = (t.join(t.groupBy("title").agg(F.count("*").alias("common")), "title").cache() for t in (x, y))
    near = near_titles(x, y).filter("a_n * b_n > 100")
    pairs = x.join(near, F.col("title") == F.col("a_title")).select(F.col("id").alias("a_id"), "b_title").join(y.select(F.col("id").alias("b_id"), F.col("title").alias("b_title")), "b_title").select("a_id", "b_id")
    single = {(r["pattern"], r["count"]) for r in compare(x, y, pairs).groupBy("pattern").count().collect()}
    assert len(single) > 20 and {(r["pattern"], r["n"]) for r in crowd_patterns(crowds(x, y, near)).collect()} == single
    assert compare(x, y, candidates(x, y), apart=True).join(pairs, ["a_id", "b_id"]).count() == 0
    got = sorted(map(tuple, link(kci, scopus).select("a_id", "b_id").collect()))
    monkeypatch.setattr(linkage, "CROWD", 1 << 40)
    assert got and got == sorted(map(tuple, link(kci, scopus).select("a_id", "b_id").collect()))
