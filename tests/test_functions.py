import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.functions.matching import haystack, keyword_in, near_words, proximity_pattern, word_in


def one(spark, c, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in cols.items())) if cols else spark.range(1)
    return df.select(c.alias("x")).first()["x"]


def matched(spark, keyword, text):
    t, s = haystack(F.lit(text))
    return one(spark, keyword_in(keyword, t, s))


@pytest.mark.parametrize(("keyword", "text", "want"), [
    ("클라우드 포렌식", "클라우드 포렌식", True), ("클라우드 포렌식", "포렌식 환경 클라우드", True), ("클라우드 포렌식", "클라우드" + "가" * 80 + "포렌식", False),
    ("aaa bbb ccc", "ccc xxx bbb yyy aaa", True), ("ab cd", "ab" + "x" * 16 + "cd", True), ("ab cd", "ab" + "x" * 17 + "cd", False),
    ("클라우드 포렌식", "클라우드포렌식", True), ("클라우드포렌식", "클라우드 포렌식", True), ("pcr", "app credential", True), ("ai", "maintain", True), ("x", "", False), ("a.b", "axb", False),
])
def test_keyword_in(spark, keyword, text, want):
    assert matched(spark, keyword, text) is want


@pytest.mark.parametrize(("text", "want"), [("app credential", False), ("a pcr-based test", True), ("pcr2", False), ("pcr", True)])
def test_word_in(spark, text, want):
    assert one(spark, word_in("PCR", F.lit(text))) is want


def brute(tokens, text, gap=16):
    spots = [[(m.start(), m.start() + len(t)) for m in re.finditer(f"(?={re.escape(t)})", text)] for t in tokens]
    for combo in product(*spots):
        o = sorted(combo)
        if len(set(combo)) == len(combo) and all(b[0] - a[1] <= gap for a, b in zip(o, o[1:])):
            return True
    return False


def test_proximity_against_brute_force(spark):
    rng = random.Random(3)
    for tokens in (["ab", "ba"], ["aa", "bc", "ca"], ["abc", "ca"]):
        texts = ["".join(rng.choice("abc  \n") for _ in range(rng.randint(0, 60))) for _ in range(400)]
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.col("t").rlike(proximity_pattern(tokens, 4)).alias("x")).collect()
        assert all(r["x"] == brute(tokens, texts[r["i"]], 4) for r in rows)


def test_text_helpers(spark):
    assert one(spark, X.title_key(F.lit("Foo, Bar-1_x!"))) == "foobar1_x"
    assert one(spark, X.title_key(F.lit("!!"))) is None
    assert one(spark, X.split_keywords(F.lit("A; b, a|C"))) == ["A", "b", "C"]
    assert [one(spark, X.pub_date(F.lit(y).cast("string"), F.lit(m).cast("string"))) for y, m in (("2024", "3"), ("2024", None), (None, "3"), ("2024", "123"))] == ["2024-03", "2024", None, "2024-123"]
    assert [one(spark, X.normal_date(F.lit(v))) for v in ("2024-1-5", "2024-07", "spring", "2024", "2024-13", "")] == ["2024-01-05", "2024-07", "spring", "2024", "2024-13", None]
    assert sorted(one(spark, X.subject_codes(F.lit('[{"code":"1700"},"1701"]')))) == ["1700", "1701"]
    assert one(spark, X.subject_codes(F.lit("1700|1701; 1702"))) == ["1700", "1701", "1702"]
    assert one(spark, X.fold(F.lit("STRASSE"))) == one(spark, X.fold(F.lit("straße")))
    assert one(spark, X.squeeze(F.lit(" a\x1c b　"))) == "a b"
    assert [one(spark, X.safe_int(F.lit(v))) for v in (" 12 ", "x", "1.5", "", "99999999999")] == [12, None, None, None, None]
    assert one(spark, X.unescape(F.lit("a &lt;b&gt; &amp;lt;"))) == "a <b> &lt;"
    assert one(spark, X.json_list(F.lit("[broken"))) == []


def test_summary(spark):
    kw = F.array(*[F.lit(f"k{i}") for i in range(1, 7)])
    no = F.lit(None).cast("string")
    assert one(spark, X.summary(F.lit("A. B! C?"), F.lit("T"), kw)) == "A. B!"
    assert one(spark, X.summary(no, F.lit("T"), kw)) == "T | keywords: k1, k2, k3, k4, k5"
    assert one(spark, X.summary(F.lit(""), no, F.array().cast("array<string>"))) == "제목 없음 | keywords: 키워드 없음"
    assert one(spark, X.summary(F.lit("x" * 400), no, kw)) == "x" * 400
    assert one(spark, X.summary(F.lit("A. B."), no, kw, F.lit("kept"))) == "kept"


def test_org_variants(spark):
    got = set(one(spark, X.org_variants(F.lit("사단법인 가나학회 (구. Old Society)"))))
    assert got == {"가나학회구oldsociety", "가나학회", "oldsociety"}
    assert one(spark, X.org_variants(F.lit(None).cast("string"))) == []


def test_near_words_against_brute_force():
    rng = random.Random(6)
    for tokens in (["ab", "ba"], ["aa", "bc", "ca"], ["ab", "ca", "ab"], ["a", "b", "c", "ab", "bc", "ca"]):
        for _ in range(200):
            t = "".join(rng.choice("abc  \n") for _ in range(rng.randint(0, 24)))
            assert near_words(tokens, t, 2) == brute(tokens, t, 2), (tokens, t)
    names = "one two three four five six seven eight nine ten eleven twelve".split()
    assert near_words(names[::-1], " ".join(names)) and not near_words(names, " ".join(names[:-1]))


def test_proximity_of_many_words(spark):
    import random

    from pyspark.sql import functions as F

    from paperloom.functions.matching import keyword_in, near_chain, near_words, proximity_pattern

    rng = random.Random(3)
    words = ["aa", "bab", "cc", "dd", "ee", "ff", "gg"]
    texts = ["".join(rng.choice([*words, *words, "x" * rng.randint(1, 20)]) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(0, 14))) for _ in range(150)] + ["", "aa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (2, 3, 5, 7):
        got = df.select("t", near_chain(words[:n], F.col("t")).alias("c"), F.col("t").rlike(proximity_pattern(words[: min(n, 5)])).alias("p")).collect()
        for r in got:
            assert r["c"] == near_words(words[:n], r["t"]), (n, r["t"])
            if n <= 5:
                assert r["c"] == r["p"]
    long = "one two three four five six seven"
    hits = spark.createDataFrame([("seven six, five four; three two one",), ("one two three four five six",), ("one two three four five six " + "y" * 17 + " seven",)], "t string")
    assert [r[0] for r in hits.select(keyword_in(long, F.col("t"), F.replace("t", F.lit(" "), F.lit("")))).collect()] == [True, False, False]
