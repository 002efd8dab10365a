"""Parts of the operators, against brute force or by hand; no Spark."""

import itertools
import random

import numpy as np
import pytest

from paperloom.llm import increments as I
from paperloom.llm import languages as G
from paperloom.llm import linkage as K
from paperloom.llm import names as N
from paperloom.llm import packing as P
from paperloom.llm import reading as R
from paperloom.llm import sentences as S


def test_romanize_and_persons():
    assert N.romanize("지카둔") == "jikadun"
    key = N.person("지카둔 케논")[0]
    for s in ("Kenon Jikadun", "JIKADUN Kenon", "Jikadun, Ke-non", "지카둔 케논(Kenon Jikadun)", "Kenon Jikadun*", "지카둔 케논 (제1저자)"):
        assert N.person(s)[0] == key
    forms = set(N.rewritings(key))
    for s in ("Jikadun, K.", "K. Jikadun", "Jikadun KN", "K.-N. Jikadun", "지카둔케논", "Andy Jikadun", "Ke Jikadun"):
        assert N.person(s)[0] is None and set(N.person(s)[3]) & forms, s
    for s in ("외 4인", "et al.", "", "*"):
        assert N.person(s)[0] is None and not N.person(s)[3]


def test_near_is_one_edit_or_swap():
    def brute(a, b):
        out = {a}
        abc = "abc"
        for i in range(len(a) + 1):
            out |= {a[:i] + c + a[i:] for c in abc} | {a[:i] + a[i + 1 :]} | {a[:i] + c + a[i + 1 :] for c in abc if i < len(a)}
            if i + 1 < len(a):
                out.add(a[:i] + a[i + 1] + a[i] + a[i + 2 :])
        return b in out

    words = ["".join(w) for n in range(4) for w in itertools.product("abc", repeat=n)]
    rng = random.Random(1)
    for _ in range(3000):
        a, b = rng.choice(words), rng.choice(words)
        assert N.near(a, b) == brute(a, b), (a, b)


def test_bands_find_all_close_vectors():
    rng = random.Random(2)
    for _ in range(200):
        v = rng.getrandbits(K.TITLE_BITS)
        w = v
        for bit in rng.sample(range(K.TITLE_BITS), K.TITLE_RADIUS):
            w ^= 1 << bit
        split = lambda x: [(x >> (64 * k)) & (2**64 - 1) for k in range(K.WORDS)]
        n = K.TITLE_RADIUS + 1
        assert set(K.bands(split(v), K.TITLE_BITS, n)) & set(K.bands(split(w), K.TITLE_BITS, n))


def test_linkage_parts():
    assert [K.part_number(t) for t in ("x (II)", "x (Part 3)", "x II †", "X-97", "Windows 10", None)] == [2, 3, 2, 0, 0, 0]
    assert K.families('["지카둔 케논", "Sinon, B.", "B. Runon", "broken')[0] == ["broken", "jikadun", "runon", "sinon"]
    assert K.clean_title("<b>A &amp; B</b> [Korean]") == "a b"


@pytest.mark.parametrize("seed", range(5))
def test_packing_is_whole_and_tight(seed):
    rng = random.Random(seed)
    cap = 100
    sizes = [rng.randint(1, 60) for _ in range(rng.randint(0, 120))]
    got, _ = P.bin_completion(sizes, cap)
    assert sorted(i for c in got for i in c) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in c) <= cap for c in got)
    assert len(got) <= len(P.best_fit(sizes, cap))


def test_packing_reaches_the_optimum_where_best_fit_does_not():
    sizes, cap = [6, 5, 5, 4, 4, 3, 3], 10  # 30 in three containers: 6+4, 5+5, 4+3+3
    assert len(P.bin_completion(sizes, cap)[0]) == 3
    assert P.bin_completion([], 5) == ([], True) and P.bin_completion([5, 5], 5)[0] in ([[0], [1]], [[1], [0]])
    # many equal texts: counted, not walked through
    for many, cap, want in (([1] * 5000, 2048, 3), ([2] * 2001, 2001, 3), ([1] * 2001, 2001, 1)):
        assert len(P.bin_completion(many, cap)[0]) == want


def test_packing_against_brute_force():
    def best(sizes, cap):
        most = [len(sizes)]

        def go(i, bins):
            if len(bins) >= most[0]:
                return
            if i == len(sizes):
                most[0] = len(bins)
                return
            for k in {b: k for k, b in enumerate(bins) if b + sizes[i] <= cap}.values():
                bins[k] += sizes[i]
                go(i + 1, bins)
                bins[k] -= sizes[i]
            go(i + 1, [*bins, sizes[i]])

        go(0, [])
        return most[0]

    rng = random.Random(3)
    for _ in range(120):
        cap = rng.choice([20, 50, 100])
        sizes = sorted((rng.randint(1, cap - 1) if rng.random() < 0.5 else rng.randint(cap // 5, cap // 2) for _ in range(rng.randint(1, 10))), reverse=True)
        got, proven = P.bin_completion(sizes, cap)
        assert proven and len(got) == best(sizes, cap)


def test_undominated_fillings():
    counts = {2: 1, 3: 1, 4: 1, 7: 1}
    got, complete = P.fillings(sorted(counts), counts, 8, 8)
    # 4+2 gives way to 4+3, 3+2 to 4+3, smaller ones to what still fits
    assert complete and [(w, [v for v, _ in f]) for w, f in got] == [(1, [7]), (1, [4, 3])]
    assert P.fillings([3], {3: 2}, 2, 2) == ([(2, [])], True) and P.fillings([3], {3: 2}, 7, 0) == ([], True)


def test_isotonic_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        y = [rng.randint(0, 4) for _ in range(7)]
        x, v = R.isotonic(np.arange(7.0), np.array(y, float), np.ones(7))
        fitted: list[float] = []
        for mean, value in zip(x, v):  # a block of consecutive places ends at twice its mean less its start
            fitted += [value] * (int(round(2 * mean)) - 2 * len(fitted) + 1)
        # the max-min formula of the least-squares fit
        want = [max(min(sum(y[a : b + 1]) / (b + 1 - a) for b in range(i, 7)) for a in range(i + 1)) for i in range(7)]
        assert fitted == pytest.approx(want)


def test_sentences_and_clauses():
    assert S.sentences("A 1.5 b. C! D? E") == ["A 1.5 b.", "C!", "D?", "E"]
    assert [n for n, _ in S.clauses("one two three; four five six. Still, x y z.")] == [1, 1, 2]
    rows, flat, lens = np.eye(4, dtype=np.float32), np.array([0, 1, 1, 3]), np.array([2, 0, 2])
    assert S.segment_sums(rows, flat, lens).tolist() == [[1, 1, 0, 0], [0, 0, 0, 0], [0, 1, 0, 1]]


def test_units_and_slots():
    assert len([u for u in G.units("One (두 번째) two. 셋이다. 四。五\nhttp://x.y/z six", False) if u.strip()]) == 5
    assert len(G.units("a = b / c", True)) == 3
    assert (G.slots("12 .,") == G.SLOTS).all() and (G.slots("ab") < G.SLOTS).all()
    assert G.code_of("ko-KR") == "ko" and G.code_of("und") == "" and G.code_of(None) == "" and G.code_of("nl") == ""


def test_graph_search_against_exhaustive():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, I.DIM))
    x = (centres[rng.integers(0, 40, 3000)] + 0.5 * rng.standard_normal((3000, I.DIM))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = I.build_graph(x, 1)
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in links[:200])
    q = x[::10] + 0.02 * rng.standard_normal((300, I.DIM)).astype(np.float32)
    beam, recall = I.tuned_beam(x, links, q, I._entries(len(x)))
    assert recall >= I.TARGET and beam < len(x)
    # links that lead nowhere: no beam is good, so the shard is searched exhaustively
    assert I.tuned_beam(x, np.full_like(links, -1), q, I._entries(len(x))) == (len(x), 1.0)
    got = I.beam_search(x, links, q, beam, I._entries(len(x)))[:, 0]
    assert (got == (q @ x.T).argmax(axis=1)).mean() >= 0.9
    for n in (0, 1, 2, 5):
        assert I.build_graph(x[:n], 1).shape[0] == n
    assert (I.beam_search(x[:1], I.build_graph(x[:1], 1), q[:3], 8, I._entries(1))[:, 0] == 0).all()


def test_whole_shard_is_searched_along_lists(monkeypatch):
    """A pass over the whole shard finds what comparing every node does, and compares few of them."""
    rng = np.random.default_rng(4)
    n, m = 1500, 60

    def some(k):
        feat = np.stack([np.zeros(k, int), *(rng.integers(0, d, k) for d in (400, 12, 30, 7, 300, 300)), rng.integers(1, 3, k), rng.integers(0, 4, k)], axis=1)
        return feat, rng.integers(-(2**62), 2**62, (k, 20)) * (rng.random((k, 1)) < 0.9)

    feat, bits = some(n)
    qf, qb = some(m)
    like = rng.integers(0, n, 40)  # queries that are nodes with some fields gone
    qf[:40], qb[:40] = np.where(rng.random((40, 9)) < 0.2, 0, feat[like]), bits[like]
    qf[:40, 0], qb[:40, 16:] = 0, np.where(rng.random((40, 1)) < 0.3, 0, bits[like, 16:])
    ids, qid, x, same, compared = np.arange(n), np.arange(n, n + m) - 200, np.zeros((n, I.DIM), np.float32), I.same_paper, []
    want = set()
    for k in range(m):
        s = same(np.broadcast_to(qf[k], feat.shape), np.broadcast_to(qb[k], bits.shape), feat, bits)
        want |= {(k, int(i), float(s[i])) for i in np.flatnonzero((s >= 0) & (ids < qid[k]))}
    monkeypatch.setattr(I, "same_paper", lambda *a: compared.append(len(a[0])) or same(*a))
    got = I.shard_matches(ids, x, feat, bits, np.full((n, 4), -1), n, qid, np.zeros((m, I.DIM), np.float32), qf, qb)
    assert len(want) > 20 and {(int(r), int(i), float(s)) for r, i, s in zip(*got)} == want
    assert sum(compared) < 0.2 * n * m


def test_same_paper():
    base = {k: None for k in I.COLUMNS} | {"source_id": "A1", "title": "가나다 라마바사 아자차", "doi": None, "authors_json": '["지카둔 케논"]', "journal_id": "J", "issue_id": "3_1", "first_page": "5", "final_page": "9"}
    score = lambda a, b: float(I.same_paper(*[np.frombuffer(v, np.int64)[None, :] for r in (a, b) for v in I.encode_record(r)[1:]])[0])
    assert score(base, base | {"source_id": "A2", "title": "가나다라마바사 아자차"}) >= 0
    assert score(base, base | {"source_id": "A2", "title": "[토론] 가나다 라마바사 아자차", "first_page": "10", "final_page": "12"}) < 0
    assert score(base | {"title": "가나다 (I)"}, base | {"source_id": "A2", "title": "가나다 (II)", "first_page": "10"}) < 0
    assert score(base | {"source_id": "unknown"}, {k: None for k in I.COLUMNS} | {"source_id": "unknown"}) < 0


def test_a_crowd_in_a_shard_is_found_whole():
    base = {k: None for k in I.COLUMNS} | {"journal_id": "J", "issue_id": "3_1", "first_page": "5", "final_page": "9"}
    rows = [base | {"title": f"가나다 라마바사 아자차 {i:03d}"} for i in range(500)] + [base | {"title": f"{i} 거너더 {i * 7}", "first_page": str(i + 50), "final_page": None} for i in range(500)]
    e = [I.encode_record(r) for r in rows]
    vec, feat, bits = (np.frombuffer(b"".join(x[k] for x in e), t).reshape(len(e), -1) for k, t in enumerate((np.float32, np.int64, np.int64)))
    ids = np.random.default_rng(4).permutation(1000).astype(np.int64)
    links = I.build_graph(vec, 1)
    for qid in (np.array([5000, 5001]), np.array([300, 700])):
        q = [0, 250]
        r, node, s = I.shard_matches(ids, vec, feat, bits, links, 32, qid, vec[q], feat[q], bits[q])
        for k, a in enumerate(q):
            all_s = I.same_paper(np.repeat(feat[a : a + 1], 1000, 0), np.repeat(bits[a : a + 1], 1000, 0), feat, bits)
            want = np.flatnonzero((all_s >= 0) & (ids < qid[k]))
            assert len(want) > 100 and sorted(node[r == k]) == want.tolist()


def test_language_mixtures():
    from paperloom.llm import languages as L

    rng = np.random.default_rng(4)
    x = rng.normal(-20, 6, (30, 8))
    starts = np.array([0, 1, 7, 20])
    pi = L.proportions(x, starts)
    for k, (a, b) in enumerate(zip(starts, [*starts[1:], 30])):  # each text on its own
        p = np.full(8, 1 / 8)
        for _ in range(L.ROUNDS):
            post = np.exp(x[a:b]) * p
            p = np.maximum((post / post.sum(axis=1, keepdims=True)).mean(axis=0), 1e-9)
        assert np.allclose(p, pi[k], atol=1e-3)
    # two clear sentences each of two languages stay apart, a slight preference does not
    clear = np.full((4, 8), -50.0)
    clear[:2, 0] = clear[2:, 3] = -5
    assert L.choose(clear, [0, 3])[0] == [0, 3]
    clear[2:, 0] = -7
    assert L.choose(clear, [0, 3])[0] == [0]


def test_confidences_are_calibrated():
    """Fields that depend on each other make the plain score too sure of itself; DOIs, some wrong, some missing, put that right."""
    rng = np.random.default_rng(12)
    n = 40_000
    true = rng.random(n) < 0.4
    x = np.zeros((n, len(K.FIELDS)), int)
    x[:, 0] = np.where(true, 2, 1) ^ (rng.random(n) < 0.1) * 3
    for f in (1, 2, 4, 5):  # four fields that mostly repeat one another
        x[:, f] = np.where(rng.random(n) < 0.6, x[:, 0], np.where(true, 2, 1) ^ (rng.random(n) < 0.2) * 3)
    d = K.FIELDS.index("doi")
    x[:, d] = np.where(rng.random(n) < 0.4, 0, np.where(true & (rng.random(n) < 0.85), 3, 1))
    u = rng.integers(1, 3, (n, len(K.FIELDS)))
    u[:, d] = np.where(rng.random(n) < 0.001, 3, 1)
    x[:, 3] = u[:, 3] = 0
    patterns, counts = np.unique(x, axis=0, return_counts=True)
    chance, chance_counts = np.unique(u, axis=0, return_counts=True)
    mix = K.Mixture(patterns, counts, chance, chance_counts, 2.5 * n)

    def error(a, b):
        z = a + b * mix._logit(x, d) + mix.weights(d)[x[:, d]]
        p = 1 / (1 + np.exp(-z))
        bins = np.minimum((p * 10).astype(int), 9)
        return sum(abs(p[bins == k].mean() - true[bins == k].mean()) * (bins == k).mean() for k in range(10) if (bins == k).any())

    assert mix.b < 1 and error(mix.a, mix.b) < 0.08 and error(mix.a, mix.b) < 0.7 * error(0.0, 1.0)


def test_own_words_are_taken_out():
    from paperloom.llm import reading as R

    rng = np.random.default_rng(2)
    texts = [[[f"w{rng.integers(0, 30)}" for _ in range(6)] for _ in range(4)] for _ in range(3)]
    hasher = R.Hasher()

    def counts(parts):
        c = np.zeros((len(R.LANGS), R.LEVELS, 5, R.SLOTS))
        for words, level in parts:
            slots, _ = R.ngram_slots(words, hasher)
            for t in range(5):
                c[0, level, t] += np.bincount(slots[:, t], minlength=R.SLOTS)
        return c

    trans = np.full((R.LEVELS, R.LEVELS), 0.2)
    whole = R.LevelModels(counts([(texts[0], 1), (texts[1], 1), (texts[2], 3)]), trans)
    rest = R.LevelModels(counts([(texts[1], 1), (texts[2], 3)]), trans)
    slots, owner = R.ngram_slots(texts[0], hasher)
    own = np.zeros((len(slots), R.LEVELS))
    own[:, 1] = 1
    assert np.allclose(whole.loglik(0, slots, owner, 4, own), rest.loglik(0, slots, owner, 4), atol=1e-4)
