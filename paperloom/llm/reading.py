"""Reading level of each document from n-gram surprisal.

For each language and level an interpolated word n-gram model (orders 1 to 3) is trained on the labelled texts.  The
sentences of a labelled text belong mostly to its level; expectation-maximisation re-weighs them by their surprisal
under all levels.  Every sentence of a document has a surprisal under each model; a document is described by the distribution of
these over all its sentences: which level's model is least surprised, on average (``score``), and how many bits a word takes under the
model of all levels together (``bits``, and ``spread`` between sentences).  Isotonic regression (pool adjacent violators) maps the score
monotonically to the raters' levels.  It is fitted to scores of labelled texts under models from which the text's own
n-grams have been taken out, so training texts look as new ones do.

Scale.  N-grams are counted in tables of fixed size in each task and added up; all labelled rows are used, copies of a text once.  The
regression sees at most BINS weighted points.  Documents are scored whole, in one pass.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.languages import LanguageModel, segments_of, train
from paperloom.session import cut

LEVELS, LANGS = 5, ("ko", "en")
SLOTS = 1 << 17
BINS = 2000
LAMBDA = (0.05, 0.25, 0.35, 0.35)  # weights of the uniform, uni-, bi- and trigram parts
SCALE = 0.6  # the words of a sentence depend on each other
END = re.compile(r"[.!?](?=\s|<|$)")
_TAG = re.compile(r"<[^<>]{0,200}>|https?://\S+")
_WORD = re.compile(r"[가-힣]+|[a-z][a-z\-]*|\d")


class Hasher:
    """Word -> 32-bit number, with a memory of words seen."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        seen, out = self.seen, []
        for w in words:
            h = seen.get(w)
            if h is None:
                if len(seen) > 500_000:
                    seen.clear()
                h = seen[w] = zlib.crc32(w.encode()) or 1
            out.append(h)
        return out


def sentence_ends(text: str) -> int:
    return len(END.findall(text))


def sentence_words(text: str) -> list[list[str]]:
    """Words of each sentence; lines without an end mark (titles, links) are no sentences."""
    out = []
    at = 0
    text = _TAG.sub(" ", text) if "<" in text or "http" in text else text
    for m in END.finditer(text):
        s = text[at : m.end()]
        at = m.end()
        nl = s.rstrip().rfind("\n")
        w = _WORD.findall((s[nl + 1 :] if nl >= 0 else s).lower())
        if w:
            out.append(w)
    return out


def ngram_slots(words: list[list[str]], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(n words x 5: slots of the uni-, bi-, trigram and of the histories of the last two; owner of each word)."""
    flat, owner, first = [], [], []
    for i, ws in enumerate(words):
        flat += hasher(ws)
        owner += [i] * len(ws)
        first += [0, 1, *([2] * (len(ws) - 2))][: len(ws)]
    c = np.asarray(flat, np.uint64)
    f = np.asarray(first, np.int8)
    p1, p2 = np.zeros_like(c), np.zeros_like(c)
    p1[1:], p2[2:] = c[:-1], c[:-2]
    p1[f < 1] = 7
    p2[f < 2] = 7
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    mix = lambda x: ((x ^ (x >> np.uint64(29))) * a >> np.uint64(40)) % np.uint64(SLOTS)
    out = np.stack([mix(c * a), mix(c * a ^ p1 * b), mix(c * a ^ p1 * b ^ (p2 * a >> np.uint64(3))), mix(p1 * b + np.uint64(11)), mix(p1 * b ^ (p2 * a >> np.uint64(3)) ^ np.uint64(13))], axis=1)
    return out.astype(np.int64), np.asarray(owner, np.int64)


class LevelModels:
    """Counts [lang, level, table, slot]: uni-, bi-, trigram and the two histories."""

    def __init__(self, counts: np.ndarray, trans: np.ndarray):
        self.c, self.trans = counts.astype(np.float32), trans
        self.total = counts[:, :, 0].sum(axis=2)
        self.share = self.total / np.maximum(self.total.sum(axis=1, keepdims=True), 1e-9)

    def loglik(self, lang: int, slots: np.ndarray, owner: np.ndarray, n: int, own: np.ndarray | None = None) -> np.ndarray:
        """Log likelihood of each sentence under each level: n x LEVELS.

        own: weights (words x LEVELS) with which these very words went into the counts; they are taken out first.
        """
        out = np.zeros((n, LEVELS))
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        places = [np.unique(slots[:, k], return_inverse=True)[1] for k in range(5)] if own is not None else None
        for l in range(LEVELS):
            t = self.c[lang, l]
            total = self.total[lang, l] + 1e-6
            c = [t[k][slots[:, k]] for k in range(5)]
            if own is not None:
                total = max(total - own[:, l].sum(), 1e-6)
                c = [np.maximum(c[k] - np.bincount(at, weights=own[:, l])[at], 0) for k, at in enumerate(places)]
            p = LAMBDA[0] / SLOTS + LAMBDA[1] * c[0] / total
            p = p + LAMBDA[2] * np.minimum(1, c[1] / (c[3] + 0.5))
            p = p + LAMBDA[3] * np.minimum(1, c[2] / (c[4] + 0.5))
            out[owner[starts], l] = np.add.reduceat(np.log(p), starts)
        return out


def _posterior(ll: np.ndarray, prior: np.ndarray) -> np.ndarray:
    z = SCALE * ll + np.log(prior)
    z -= z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def _alone(lm: LanguageModel, texts: list[str]) -> list[int]:
    """0 for Korean alone, 1 for English alone, -1 for others."""
    segs = segments_of(lm, texts, [False] * len(texts))
    return [LANGS.index(s[0][0]) if len(s) == 1 and s[0][0] in LANGS else -1 for s in segs]


def _count_pass(labelled: DataFrame, lm_b, model_b) -> tuple[np.ndarray, np.ndarray]:
    """labelled: text, level (0-based).  Adds up n-gram counts weighted by the sentences' level posteriors."""

    def run(batches):
        hasher = Hasher()
        counts = np.zeros((len(LANGS), LEVELS, 5, SLOTS), np.float32)
        trans = np.zeros((LEVELS, LEVELS))
        model = model_b.value if model_b is not None else None
        for b in batches:
            texts, levels = b.column(0).to_pylist(), b.column(1).to_pylist()
            at, weight = [], []
            for text, level, lang in zip(texts, levels, _alone(lm_b.value, texts)):
                words = sentence_words(text) if lang >= 0 else []
                if not words:
                    continue
                slots, owner = ngram_slots(words, hasher)
                if model is None:
                    post = np.zeros((len(words), LEVELS))
                    post[:, level] = 1.0
                else:
                    post = _posterior(model.loglik(lang, slots, owner, len(words)), model.trans[level][None, :])
                trans[level] += post.sum(axis=0)
                for l in np.flatnonzero(post.max(axis=0) > 1e-3):
                    at.append((((lang * LEVELS + l) * 5 + np.arange(5)) * SLOTS + slots).ravel())
                    weight.append(np.repeat(post[owner, l], 5))
            if at:
                counts.ravel()[:] += np.bincount(np.concatenate(at), weights=np.concatenate(weight), minlength=counts.size).astype(np.float32)
        i = np.flatnonzero(counts)
        flat = counts.ravel()
        for at in range(0, len(i), 200_000):
            x = i[at : at + 200_000]
            yield pa.RecordBatch.from_pydict({"i": pa.array(x.astype(np.int64)), "n": pa.array(flat[x].astype(np.float64))})
        yield pa.RecordBatch.from_pydict({"i": pa.array(-1 - np.arange(LEVELS * LEVELS, dtype=np.int64)), "n": pa.array(trans.ravel())})

    pdf = labelled.mapInArrow(run, "i bigint, n double").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(LANGS) * LEVELS * 5 * SLOTS)
    trans = np.zeros(LEVELS * LEVELS)
    i, n = pdf["i"].to_numpy(), pdf["n"].to_numpy()
    counts[i[i >= 0]] = n[i >= 0]
    trans[-1 - i[i < 0]] = n[i < 0]
    return counts.reshape(len(LANGS), LEVELS, 5, SLOTS), trans.reshape(LEVELS, LEVELS)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block positions (mean x) and their non-decreasing values."""
    blocks: list[list[float]] = []
    for a, b, c in sorted(zip(x, y, w)):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _describe(text: str, lang: int, model: LevelModels, hasher: Hasher, level: int | None = None) -> tuple[float, float, float] | None:
    """(mean expected level of the sentences, bits per word, their spread between sentences); level: what the text was labelled in training."""
    words = sentence_words(text)
    if not words:
        return None
    slots, owner = ngram_slots(words, hasher)
    ll = model.loglik(lang, slots, owner, len(words))
    if level is not None:
        ll = model.loglik(lang, slots, owner, len(words), _posterior(ll, model.trans[level][None, :])[owner])
    doc = np.full(LEVELS, 1 / LEVELS)
    for _ in range(4):  # the document's own mixture of levels, by EM
        post = _posterior(ll, doc[None, :])
        doc = 0.9 * post.mean(axis=0) + 0.1 / LEVELS
    top = ll.max(axis=1, keepdims=True)
    n = np.array([len(w) for w in words])
    bits = -(np.log(np.maximum(np.exp(ll - top) @ model.share[lang], 1e-300)) + top[:, 0]) / np.log(2)
    return float((post @ np.arange(1, LEVELS + 1)).mean()), float(bits.sum() / n.sum()), float((bits / n).std())


SCORED = "lang int, score double, bits double, spread double"


def _score(df: DataFrame, key: str, lm_b, model_b, min_ends: int, level: str | None = None) -> DataFrame:
    """key, lang, score, bits, spread of the texts in one language with min_ends sentence ends."""
    kind = dict(df.dtypes)[key]

    def run(batches):
        hasher = Hasher()
        for b in batches:
            texts, rest = b.column(0).to_pylist(), b.column(1).to_pylist()
            levels = b.column(2).to_pylist() if level else [None] * len(texts)
            keep = [i for i, t in enumerate(texts) if t and sentence_ends(t) >= min_ends]
            alone = _alone(lm_b.value, [texts[i] for i in keep])
            k = [(rest[i], a, *d) for i, a in zip(keep, alone) if a >= 0 and (d := _describe(texts[i], a, model_b.value, hasher, levels[i]))]
            types = (b.schema.field(1).type, pa.int32(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in k], t) for j, t in enumerate(types)], names=[key, "lang", "score", "bits", "spread"])

    return df.select("text", key, *([level] if level else [])).mapInArrow(run, f"`{key}` {kind}, {SCORED}")


class Levels:
    """Trained models and the curves from scores to levels, one per language."""

    def __init__(self, docs: DataFrame, labels: DataFrame, rounds: int = 2, min_ends: int = 5):
        spark = docs.sparkSession
        self.min_ends, self.cuts = min_ends, {}
        self.lm_b = spark.sparkContext.broadcast(train(docs))
        marks = labels.filter("read_level between 1 and 5").groupBy("doc_id").agg(F.avg("read_level").alias("level"))
        # copies of a text are one text, whose marks are averaged
        labelled = docs.select("doc_id", "text").join(marks, "doc_id").filter("text is not null").groupBy("text").agg(F.avg("level").alias("mark"))
        labelled = cut(labelled.select("text", (F.round("mark").cast("int") - 1).alias("level"), "mark"))
        model, self.model_b = None, None
        for _ in range(rounds):
            counts, trans = _count_pass(labelled, self.lm_b, self.model_b)
            if not counts.any():
                return
            if model is None:  # sentences of other levels occur mostly at neighbours
                d = np.abs(np.arange(LEVELS)[:, None] - np.arange(LEVELS)[None, :])
                trans = np.array([0.7, 0.12, 0.04, 0.01, 0.01])[d]
            else:
                trans = trans + 1.0
            model = LevelModels(counts, trans / trans.sum(axis=1, keepdims=True))
            self.model_b = spark.sparkContext.broadcast(model)
        self.points = cut(_score(labelled, "mark", self.lm_b, self.model_b, min_ends, "level"))
        p = self.points.groupBy("lang", F.round(F.col("score") * (BINS / LEVELS)).alias("bin")).agg(F.avg("score").alias("x"), F.avg("mark").alias("y"), F.count("*").alias("w")).toPandas()
        for lang in range(len(LANGS)):
            mine = p[p["lang"] == lang]
            mine = mine if len(mine) else p
            if len(mine):
                x, y = isotonic(mine["x"].to_numpy(), mine["y"].to_numpy(), mine["w"].to_numpy(float))
                # the level changes where the fitted curve crosses a half
                self.cuts[lang] = [float(np.interp(h, y, x)) if y[0] < h < y[-1] else (float("-inf") if h <= y[0] else float("inf")) for h in (1.5, 2.5, 3.5, 4.5)]

    def level(self) -> Column:
        out = F.lit(None).cast("int")
        for lang, cuts in self.cuts.items():
            out = F.when(F.col("lang") == lang, sum(((F.col("score") > F.lit(t)).cast("int") for t in cuts), F.lit(1))).otherwise(out)
        return out

    def score(self, docs: DataFrame) -> DataFrame:
        return _score(docs, "doc_id", self.lm_b, self.model_b, self.min_ends).withColumn("read_level", self.level())

    def held_out(self) -> DataFrame:
        """lang, n, agree, near: how many labelled texts, their own n-grams taken out, get the rounded mean of their marks, or one level off."""
        x = self.points.withColumn("off", F.abs(self.level() - F.round("mark")))
        return x.groupBy("lang").agg(F.count("*").alias("n"), F.avg((F.col("off") == 0).cast("double")).alias("agree"), F.avg((F.col("off") <= 1).cast("double")).alias("near"))


RESULT = "doc_id bigint, read_level int, score double, bits double, spread double"


def reading_levels(docs: DataFrame, labels: DataFrame, rounds: int = 2, min_ends: int = 5) -> DataFrame:
    """doc_id, read_level (1 to 5), score, bits, spread for documents in Korean alone or English alone with min_ends sentence ends.

    Null levels and labels of unknown documents count for nothing; without any label no level can be given and the result
    is empty; blank texts and texts in other languages have no row; very long texts are scored whole.
    """
    m = Levels(docs, labels, rounds, min_ends)
    if not m.cuts:
        return docs.sparkSession.createDataFrame([], RESULT)
    return m.score(docs.select("text", F.col("doc_id").cast("bigint"))).select("doc_id", "read_level", "score", "bits", "spread")
