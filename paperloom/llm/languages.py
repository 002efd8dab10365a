"""Language of each document and of each segment of a mixed-language document.

Character n-gram models of eight languages are counted over all labelled documents.  A document is a mixture: its
sentences are drawn from languages with unknown proportions.  Expectation-maximisation estimates the proportions from
the n-gram likelihoods; the set of languages is chosen by penalised likelihood (a language stays only if it explains
the text better by more than the penalty).  Sentences take their likeliest language of the set, equal neighbours
form a segment.  The confidence of a segment is the mean posterior of its sentences, weighted by length, among all
languages and with one more sentence's worth of even proportions, so that a short or doubtful text is never quite certain.

Scale.  One pass counts (a fixed table of n-gram slots per language, merged before the shuffle), one pass
labels.  The model is languages x SLOTS numbers, whatever the size of the corpus.  Sentences are scored whole, in
numpy, a bounded number of characters at a time.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGS = ("ko", "en", "ja", "zh", "de", "fr", "es", "ru")
# Codes of the languages.
CODES = {
    "ko": "ko", "kor": "ko", "en": "en", "eng": "en", "ja": "ja", "jpn": "ja", "zh": "zh", "zho": "zh", "chi": "zh", "cmn": "zh",
    "de": "de", "deu": "de", "ger": "de", "fr": "fr", "fra": "fr", "fre": "fr", "es": "es", "spa": "es", "ru": "ru", "rus": "ru",
}
SLOTS = 1 << 17
CHUNK = 1 << 20
PENALTY = 6.0
ROUNDS = 12

_NOISE = re.compile(r"https?://\S+|www\.\S+|<[^<>]{0,200}>|&[a-z]{2,8};|&#\d+;")
_BRACKET = re.compile(r"\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]|【[^【】]*】|［[^［］]*］")
_SENT = re.compile(r"[^.!?。！？\n]*(?:[.!?](?!\s|$|<)[^.!?。！？\n]*)*(?:[.!?]+(?=\s|$|<)|[。！？]+|\n|$)")
_TITLE = re.compile(r"\s+[=/|]\s+|\s*\n\s*|\s*＝\s*")


def code_of(label: str | None) -> str:
    return CODES.get(re.split(r"[-_]", (label or "").strip().lower())[0], "")


def _classes() -> np.ndarray:
    """Class of each code point: 0 for what is no letter, small numbers for letters, Hangul by its lead, Han by block."""
    t = np.zeros(0x110000, np.uint32)
    a = np.arange(0x110000, dtype=np.uint32)
    for lo, hi in ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x530)):
        t[lo:hi] = a[lo:hi]
    t[0x41:0x5B] += 32
    t[0xC0:0xDF] = a[0xE0:0xFF]
    t[0xD7] = 0
    t[0x410:0x430] += 32
    t[0x3041:0x3100] = 0x600 + (a[0x3041:0x3100] - 0x3041)
    t[0x30FB] = 0
    t[0x3400:0xA000] = 0x800 + (a[0x3400:0xA000] & 0x3FF)
    t[0xAC00:0xD7A4] = 0x700 + (a[0xAC00:0xD7A4] - 0xAC00) // 588
    t[0x3131:0x318F] = 0x7FF
    return t


_CLASS = _classes()


def slots(text: str) -> np.ndarray:
    """Slot of the 1- to 3-gram that ends at each character; SLOTS where the character is no letter."""
    c = _CLASS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    p1 = np.zeros_like(c)
    p1[1:] = c[:-1]
    p2 = np.zeros_like(c)
    p2[2:] = c[:-2]
    p2[p1 == 0] = 0
    h = (c * np.uint32(2654435761)) ^ (p1 * np.uint32(2246822519)) ^ (p2 * np.uint32(3266489917))
    h ^= h >> np.uint32(15)
    return np.where(c == 0, SLOTS, h % SLOTS)


def units(text: str, title: bool) -> list[str]:
    """Sentences (in a title: parallel titles), without links, markup and bracketed remarks."""
    if "http" in text or "<" in text or "&" in text or "www." in text:
        text = _NOISE.sub(" ", text)
    if "(" in text or "（" in text or "[" in text or "【" in text:
        text = _BRACKET.sub(" ", text)
    if title:
        return _TITLE.split(text)
    return [m for m in _SENT.findall(text) if m]


def count_ngrams(docs: DataFrame, text: str, label: str) -> DataFrame:
    """lang, slot, n over all documents whose label names one of the languages."""

    def run(batches):
        sums = np.zeros((len(LANGS), SLOTS), np.int64)
        for b in batches:
            by: dict[int, list[str]] = {}
            for t, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = code_of(c)
                if k and t:
                    by.setdefault(LANGS.index(k), []).append(_NOISE.sub(" ", t))
            for i, ts in by.items():
                joined = "\n".join(ts)
                for at in range(0, len(joined), CHUNK):
                    s = slots(joined[max(0, at - 2) : at + CHUNK])[min(at, 2) :]
                    sums[i] += np.bincount(s, minlength=SLOTS + 1)[:SLOTS]
        i, s = np.nonzero(sums)
        for at in range(0, len(i), 100_000):
            x, y = i[at : at + 100_000], s[at : at + 100_000]
            yield pa.RecordBatch.from_pydict({"lang": pa.array(x.astype(np.int32)), "slot": pa.array(y.astype(np.int32)), "n": pa.array(sums[x, y])})

    it = docs.select(F.col(text).alias("t"), F.col(label).alias("l")).mapInArrow(run, "lang int, slot int, n bigint")
    return it.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class LanguageModel:
    """log P(n-gram slot | language), smoothed; the last row is the slot of characters that are no letters."""

    def __init__(self, counts):
        table = np.zeros((len(LANGS), SLOTS), np.float64)
        table[counts["lang"].to_numpy(), counts["slot"].to_numpy()] = counts["n"].to_numpy()
        table = (table + 0.02) / (table.sum(axis=1, keepdims=True) + 0.02 * SLOTS)
        # a letter of another script costs the same everywhere, so foreign terms decide little
        self.logp = np.zeros((SLOTS + 1, len(LANGS)), np.float32)
        self.logp[:SLOTS] = np.maximum(np.log(table).T, -14.0)

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each text under each language, and its number of letters."""
        out = np.zeros((len(texts), len(LANGS)), np.float64)
        letters = np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) < CHUNK):
                size += len(texts[end]) + 1
                end += 1
            s = slots("\n".join(texts[at:end]) + "\n")
            lens = np.fromiter((len(x) + 1 for x in texts[at:end]), np.int64)
            starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
            out[at:end] = np.add.reduceat(self.logp[s], starts, axis=0, dtype=np.float64)
            letters[at:end] = np.add.reduceat((s < SLOTS).astype(np.int64), starts)
            at = end
        return out, letters


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    return LanguageModel(count_ngrams(docs, text, label).toPandas())


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of the rows, and the log of what they add up to."""
    m = z.max(axis=1, keepdims=True)
    e = np.exp(z - m)
    total = e.sum(axis=1, keepdims=True)
    return e / total, (m + np.log(total))[:, 0]


def proportions(x: np.ndarray, starts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """EM for many texts at once: rows of x (log likelihoods) are sentences, those from one start to the next are a text."""
    n = np.diff(np.append(starts, len(x)))
    pi = np.full((len(starts), x.shape[1]), 1 / x.shape[1])
    for _ in range(rounds):
        post, _ = _softmax(x + np.log(np.repeat(pi, n, axis=0)))
        new = np.maximum(np.add.reduceat(post, starts, axis=0) / n[:, None], 1e-9)
        done = np.abs(new - pi).max() < 1e-4
        pi = new
        if done:
            break
    return pi


def choose(x: np.ndarray, live: list[int], penalty: float = PENALTY) -> tuple[list[int], np.ndarray]:
    """The languages of one text by penalised likelihood, from those of ``live``, and their proportions."""
    one = np.array([0])

    def fit(langs):
        pi = proportions(x[:, langs], one)
        return float(_softmax(x[:, langs] + np.log(pi))[1].sum()), pi[0]

    best, pi = fit(live)
    while len(live) > 1:  # drop the language that is missed least while that costs less than the penalty
        tries = [(*fit([k for k in live if k != l]), l) for l in live]
        value, p, l = max(tries, key=lambda t: t[0])
        if best - value > penalty:
            break
        live, best, pi = [k for k in live if k != l], value, p
    return live, pi


def segments_of(model: LanguageModel, texts: list[str], titles: list[bool]) -> list[list[tuple[str, float]]]:
    """For each text its segments (language, confidence); a text without letters has none.

    The n-grams of a sentence depend on each other; its likelihood counts as that of half its letters.
    """
    us, owner = [], []
    for i, (t, ti) in enumerate(zip(texts, titles)):
        u = units(t, ti)
        us += u
        owner += [i] * len(u)
    out: list[list[tuple[str, float]]] = [[] for _ in texts]
    if not us:
        return out
    x, letters = model.score(us)
    own, keep = np.asarray(owner), letters > 0
    x, letters, own = 0.5 * x[keep], letters[keep], own[keep]
    if not len(own):
        return out
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    n = np.diff(np.append(starts, len(own)))
    pi = proportions(x, starts)
    # a language can be in the set of a text only if it is the likeliest for a sentence of it, under even or the fitted proportions
    text_of = np.repeat(np.arange(len(starts)), n)
    live = np.zeros(pi.shape, bool)
    for top in (x.argmax(axis=1), (x + np.log(pi[text_of])).argmax(axis=1)):
        live[text_of, top] = True
    chosen = np.where(live, 1.0, 0.0)
    several = live.sum(axis=1) > 1
    for k in np.flatnonzero(several):
        langs, p = choose(x[starts[k] : starts[k] + n[k]], [int(l) for l in np.flatnonzero(live[k])])
        chosen[k] = 0.0
        chosen[k, langs] = p
    within = np.log(np.maximum(chosen, 1e-300))
    lang = np.where(chosen[text_of] > 0, x + within[text_of], -np.inf).argmax(axis=1)
    smoothed = (chosen * n[:, None] + 1 / len(LANGS)) / (n[:, None] + 1)
    post, _ = _softmax(x + np.log(smoothed[text_of]))
    sure = post[np.arange(len(lang)), lang] * letters
    head = np.flatnonzero(np.concatenate(([True], (text_of[1:] != text_of[:-1]) | (lang[1:] != lang[:-1]))))
    conf = np.add.reduceat(sure, head) / np.add.reduceat(letters, head)
    for h, c in zip(head, conf):
        out[own[h]].append((LANGS[lang[h]], float(c)))
    return out


def segments(df: DataFrame, model: LanguageModel, kinds: dict[str, bool]) -> DataFrame:
    """df: field, rec_id, label, text -> field, rec_id, label, seg_no, lang, confidence; kinds: field -> is a title.

    Null and blank texts, and texts without a letter, give no rows; texts of any length are read whole.
    """
    m = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            d = b.to_pydict()
            segs = segments_of(m.value, [t or "" for t in d["text"]], [kinds[f] for f in d["field"]])
            rows: dict[str, list] = {k: [] for k in ("field", "rec_id", "label", "seg_no", "lang", "confidence", "n_segs", "langs")}
            for f, i, l, s in zip(d["field"], d["rec_id"], d["label"], segs):
                langs = sorted({x for x, _ in s})
                for no, (lang, conf) in enumerate(s, 1):
                    for k, v in zip(rows, (f, i, code_of(l), no, lang, conf, len(s), langs)):
                        rows[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["field"], pa.string()), pa.array(rows["rec_id"], pa.int64()), pa.array(rows["label"], pa.string()),
                 pa.array(rows["seg_no"], pa.int32()), pa.array(rows["lang"], pa.string()), pa.array(rows["confidence"], pa.float64()),
                 pa.array(rows["n_segs"], pa.int32()), pa.array(rows["langs"], pa.list_(pa.string()))],
                names=list(rows))

    return df.select("field", F.col("rec_id").cast("bigint"), "label", "text").mapInArrow(
        run, "field string, rec_id bigint, label string, seg_no int, lang string, confidence double, n_segs int, langs array<string>"
    )


def find_languages(docs: DataFrame, papers: DataFrame) -> DataFrame:
    """Segments of all documents and of the titles and abstracts in other languages, with label ('' for none)."""
    model = train(docs)
    rows = docs.select(F.lit("text").alias("field"), F.col("doc_id").alias("rec_id"), F.col("lang").alias("label"), "text")
    fields = ("title_kor", "title_other", "abstract_other")
    # one scan of the papers: a row for each of the texts that are there
    texts = papers.select("ord", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("x"))
    rows = rows.unionByName(texts.filter("x.text is not null").select("x.field", F.col("ord").alias("rec_id"), F.lit("").alias("label"), "x.text"))
    return segments(rows, model, {"text": False, "title_kor": True, "title_other": True, "abstract_other": False})


def found(segs: DataFrame) -> DataFrame:
    """Those whose label is missing or wrong or that hold several languages; of title_kor those not in Korean alone."""
    several = F.size("langs") > 1
    case = (
        F.when(F.col("field") == "text", several | ~F.array_contains("langs", F.col("label")))
        .when(F.col("field") == "title_kor", several | ~F.array_contains("langs", "ko"))
        .otherwise(True)
    )
    return segs.filter(case).select("field", "rec_id", F.col("seg_no").cast("bigint").alias("seg_no"), "lang")
