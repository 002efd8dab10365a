"""Match records of two tables that share no key.

Attributes are encoded as fixed bit vectors: q-grams of the title (TITLE_BITS) and of the authors' family names, and one
block for each part of the place of publication (ISSN, volume, first and last page, family name).  Close pairs are found
exactly with multi-index hashing: title vectors within Hamming distance TITLE_RADIUS agree on one of TITLE_RADIUS + 1
bands, and places that differ in two of five blocks at most agree on one of the ten combinations of three.  The Dice score of each
field's bit vectors becomes a level; a two-class mixture fitted to all candidate pairs by expectation-maximisation gives each level
of each field its weight, and the weights add up to the score of a pair.  The scores are calibrated on the pairs whose DOIs are both
known: a logistic curve from the score without the DOI to how often the DOIs agree, corrected for DOIs that are wrong or shared.

Scale.  Candidates come from equi-joins only.  Titles are indexed once per distinct title.  Every pair of records with close titles or
a common combination of three blocks is a candidate, so work grows with the square of the commonest title or place; those that more
than COMMON records share are dealt out by a salt.  The mixture sees counts of level patterns, a table whose
size is bounded by the product of the levels.  Records whose titles are near and common (more than CROWD pairs of two titles) are
compared in blocks that are never written out as pairs: once to count the patterns, once more to find each record's best partner.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.names import romanize
from paperloom.session import cut

TITLE_BITS, TITLE_RADIUS, NAME_BITS, COMMON, MAX_SALTS = 512, 11, 256, 60, 64
CROWD, SIDE, STRIP = COMMON * COMMON, 2048, 16  # pairs of two titles beyond which they go by blocks; records a side of a block, and at a time
NEAR, MIN_KNOWN = 0.5, 200  # Dice of close digits; pairs with both DOIs that a calibration needs
WORDS, NAME_WORDS = TITLE_BITS // 64, NAME_BITS // 64
BLOCKS = ("issn", "volume", "first", "last", "name")
PLACE = ("issn", "volume", "number", "first", "last")
_TAG = re.compile(r"<[^<>]*>|\[[^\[\]]*\]|&[a-z]+;", re.IGNORECASE)
_HANGUL = re.compile("[가-힣]")
_PART = re.compile(r"(?:\bpart\s+|제\s*|\(\s*)(i{1,3}|iv|vi{0,3}|ix|x|\d{1,2})\s*(?:부|편)?\)?[^\w)]*$|\s(ii|iii|iv|vi|vii|viii)[^\w)]*$", re.IGNORECASE)
_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}


def clean_title(t: str | None) -> str:
    t = unicodedata.normalize("NFKC", _TAG.sub(" ", t or "")).casefold()
    return " ".join(re.findall(r"[^\W_]+", t))


def part_number(t: str | None) -> int:
    m = _PART.search(_TAG.sub(" ", t or "").strip())
    if not m:
        return 0
    g = (m[1] or m[2]).lower()
    return _ROMAN.get(g) or (int(g) if g.isdigit() else 0)


@lru_cache(maxsize=100_000)
def _word_bits(w: str, bits: int, q: int) -> int:
    w, v = f"^{w}$", 0
    for i in range(len(w) - q + 1):
        v |= 1 << (zlib.crc32(w[i : i + q].encode()) % bits)
    return v


def qgram_bits(words: list[str], bits: int, q: int = 2) -> list[int]:
    """Bit vector of the words' padded q-grams, as signed 64-bit words; the order of the words does not count."""
    v = 0
    for w in words:
        v |= _word_bits(w, bits, q)
    out = []
    for k in range(bits // 64):
        x = (v >> (64 * k)) & 0xFFFFFFFFFFFFFFFF
        out.append(x - (1 << 64) if x >> 63 else x)
    return out


def bands(words: list[int], bits: int, n: int) -> list[str]:
    v = sum((int(w) & 0xFFFFFFFFFFFFFFFF) << (64 * k) for k, w in enumerate(words))
    edges = [bits * k // n for k in range(n + 1)]
    return [f"{k}:{(v >> a) & ((1 << (b - a)) - 1):x}" for k, (a, b) in enumerate(zip(edges, edges[1:]))]


def families(authors_json: str | None) -> tuple[list[str], list[str]]:
    """(family names that are certain enough to compare, all strings that may be a family name)."""
    sure: list[str] = []
    may: list[str] = []
    for s in re.findall(r'"((?:[^"\\]|\\.)*)"?', authors_json or ""):
        s = unicodedata.normalize("NFKC", s).strip()
        inner = re.search(r"\(([^)]*)\)", s)
        s = re.sub(r"\([^)]*\)", " ", s).strip(" *")
        if inner and re.search("[A-Za-z]{3}", inner[1]) and not _HANGUL.search(s):
            s = inner[1]
        if _HANGUL.search(s):
            t = s.split()
            if len(t) >= 2:
                f = [romanize(t[0])]
            else:
                f = []
                may += [romanize(s[:n]) for n in range(1 if len(s) <= 3 else 2, len(s))]
        else:
            if "," in s:
                t = [s.split(",")[0]]
            else:
                t = [w for w in s.split() if not re.fullmatch(r"(?:[A-Za-z]\.-?)+[A-Za-z]?\.?|[A-Z](?:-?[A-Z]){0,2}", w)]
            f = [x for w in t if len(x := re.sub("[^a-z]", "", w.casefold())) > 1]
        sure += f
        may += f
    return sorted(set(sure)), sorted(set(may))


# what is compared of a record, as 64-bit numbers: title and name vectors, vectors and hashes (0: unknown) of the fields of few digits and the DOI, ...
TV, NV, PV, HASHES = slice(0, WORDS), slice(WORDS, WORDS + NAME_WORDS), WORDS + NAME_WORDS, WORDS + NAME_WORDS + len(PLACE)
YEAR, PART = HASHES + len(PLACE) + 1, HASHES + len(PLACE) + 2
REC, NO_YEAR = PART + 1, -(1 << 40)


@lru_cache(maxsize=100_000)
def _hash(t: str | None) -> int:
    """Of a known value a number other than 0."""
    return (int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "little", signed=True) or 1) if t else 0


def _encode(df: DataFrame) -> DataFrame:
    """id, title and its vector, names, blocks, doi, and ``rec``, of which pairs are compared."""

    def run(batches):
        for b in batches:
            d = b.to_pydict()
            o: dict[str, list] = {k: [] for k in ("id", "title", "tv", "names", "issn", "volume", "first", "last", "doi", "rec")}
            for i in range(len(d["id"])):
                eng = d["title_eng"][i] or (d["title"][i] if d["title"][i] and not _HANGUL.search(d["title"][i]) else None)
                words = clean_title(eng).split()
                sure, may = families(d["authors_json"][i])
                vol, _, num = (d["issue_id"][i] or "").partition("_")
                digits = lambda x: re.sub(r"\D", "", x or "") or None
                o["id"].append(d["id"][i])
                o["title"].append(" ".join(words) or None)
                o["tv"].append(qgram_bits(words, TITLE_BITS) if words else None)
                o["names"].append(may)
                place = {"issn": digits(d["issn"][i]) or digits(d["eissn"][i]), "volume": digits(vol), "number": digits(num), "first": digits(d["first_page"][i]), "last": digits(d["final_page"][i])}
                for k in place.keys() & o.keys():
                    o[k].append(place[k])
                y = d["publication_year"][i] or (int(d["registered_at"][i][:4]) if re.match(r"\d{4}", d["registered_at"][i] or "") else None)
                m = re.search(r"10\.\d{3,}[\d.]*/\S+", (d["doi"][i] or "").lower())
                o["doi"].append(m[0].rstrip(".,;)") if m else None)
                rec = (o["tv"][-1] or [0] * WORDS) + (qgram_bits(sure or may, NAME_BITS) if may else [0] * NAME_WORDS)
                rec += [qgram_bits([place[k]], 64)[0] if place[k] else 0 for k in PLACE] + [_hash(place[k]) for k in PLACE] + [_hash(o["doi"][-1])]
                rec += [NO_YEAR if y is None else y, part_number(eng) or part_number(d["title_kor"][i]) or part_number(d["title"][i])]
                o["rec"].append(np.array(rec, np.int64).tobytes())
            ls, s = pa.list_(pa.int64()), pa.string()
            yield pa.RecordBatch.from_arrays(
                [pa.array(o[k], t) for k, t in zip(o, (pa.int64(), s, ls, pa.list_(s), s, s, s, s, s, pa.binary()))], names=list(o))

    cols = ["id", "title", "title_kor", "title_eng", "authors_json", "issn", "eissn", "issue_id", "first_page", "final_page", "publication_year", "registered_at", "doi"]
    return df.select(*cols).mapInArrow(run, "id bigint, title string, tv array<bigint>, names array<string>, issn string, volume string, first string, last string, doi string, rec binary")


def _place_keys(df: DataFrame) -> DataFrame:
    """id, key: the combinations of three known blocks, hashed (a clash makes one pair more a candidate)."""
    name = F.explode_outer("names").alias("name")
    x = df.select("id", "issn", "volume", "first", "last", name)
    keys = []
    for c in combinations(BLOCKS, 3):
        known = F.lit(True)
        for k in c:
            known = known & F.col(k).isNotNull()
        keys.append(F.when(known, F.xxhash64(F.lit("+".join(c)), *c)))
    k = x.select("id", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    return k.distinct()


def _all_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """a_id, b_id of all pairs of rows (id, key) with one key; a key of many rows is spread over salts."""
    heavy = a.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > COMMON).select("key", F.least(F.ceil(F.col("n") / COMMON), F.lit(MAX_SALTS)).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    x = a.join(heavy, "key", "left").select(F.col("id").alias("a_id"), "key", F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt"))
    y = b.join(heavy, "key", "left").select(F.col("id").alias("b_id"), "key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    return x.join(y, ["key", "salt"]).select("a_id", "b_id")


def near_titles(a: DataFrame, b: DataFrame) -> DataFrame:
    """a_title, b_title within TITLE_RADIUS, and how many records bear them: a_n, b_n."""

    def titles(x: DataFrame, side: str) -> DataFrame:
        return cut(x.filter("title is not null").groupBy("title").agg(F.first("tv").alias("tv"), F.count("*").alias("n")).select(F.col("title").alias(f"{side}_title"), F.xxhash64("title").alias(f"{side}_h"), F.col("tv").alias(f"{side}_tv"), F.col("n").alias(f"{side}_n")))

    def banded(x: DataFrame, side: str) -> DataFrame:
        def run(batches):
            for batch in batches:
                hs, vecs = batch.column(0), batch.column(1)
                vs = vecs.to_pylist()
                ks = [zlib.crc32(b.encode()) | i << 32 for v in vs for i, b in enumerate(bands(v, TITLE_BITS, TITLE_RADIUS + 1))]
                at = np.repeat(np.arange(len(vs)), TITLE_RADIUS + 1)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([hs.take(at), vecs.take(at), pa.array(ks, pa.int64())], names=[f"{side}_h", f"{side}_tv", "band"])

        return x.select(f"{side}_h", f"{side}_tv").mapInArrow(run, f"{side}_h bigint, {side}_tv array<bigint>, band bigint")

    distance = sum((F.bit_count(F.col("a_tv")[i].bitwiseXOR(F.col("b_tv")[i])) for i in range(WORDS)), F.lit(0))
    ta, tb = titles(a, "a"), titles(b, "b")
    # hashes of titles and bands travel, with the vectors, as many more pairs meet in a band than are near; the titles are fetched afterwards
    met = banded(ta, "a").join(banded(tb, "b"), "band").filter(distance <= TITLE_RADIUS).select("a_h", "b_h").distinct()
    return met.join(ta.drop("a_tv"), "a_h").join(tb.drop("b_tv"), "b_h").select("a_title", "b_title", "a_n", "b_n")


def candidates(a: DataFrame, b: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """a_id, b_id, likely: distinct pairs that are close in place or title, and those of one DOI (only by it: likely 0).

    ``near``: the pairs of titles to take, all that are near if not given.
    """
    doi = lambda x: x.filter("doi is not null").select("id", F.col("doi").alias("key"))
    place = _all_pairs(cut(_place_keys(a)), cut(_place_keys(b)))
    near = near_titles(a, b) if near is None else near
    # each record of the first table under the second's titles that are near its own
    near_a = near.join(a.select("id", F.col("title").alias("a_title")), "a_title").select("id", F.col("b_title").alias("key"))
    by_title = _all_pairs(cut(near_a), b.filter("title is not null").select("id", F.col("title").alias("key")))
    by_doi = _all_pairs(doi(a), doi(b)).withColumn("likely", F.lit(0))
    return place.unionByName(by_title).withColumn("likely", F.lit(1)).unionByName(by_doi).groupBy("a_id", "b_id").agg(F.max("likely").alias("likely"))


def _ones(x) -> np.ndarray:
    # of signed numbers numpy would count the bits of the absolute value
    return np.bitwise_count(x.view(np.uint64))


def _dice(x, y) -> np.ndarray:
    both, total = np.int32(0), np.int32(0)
    for k in range(x.shape[-1]):
        both = both + _ones(x[..., k] & y[..., k])
        total = total + (_ones(x[..., k]) + _ones(y[..., k]).astype(np.int32))
    return 2 * both / np.maximum(total, 1)


def _agree(x, y, k: int) -> np.ndarray:
    """Level of field k of few digits (the last is the DOI): 0 unknown, 1 different, 2 close by Dice, 3 equal."""
    p, q = x[..., HASHES + k], y[..., HASHES + k]
    out = np.where(p == q, np.int32(3), np.int32(1))
    if k < len(PLACE):
        out[(out == 1) & (_dice(x[..., PV + k : PV + k + 1], y[..., PV + k : PV + k + 1]) >= NEAR)] = 2
    return out * ((p != 0) & (q != 0))


FIELDS = ("title", "name", "year", "part", "issn", "volume", "number", "first", "last", "doi")
TOPS = (8, 6, 4, 3, 4, 4, 4, 5, 4, 4)  # how many levels each has
REST = int(np.prod(TOPS[1:]))


def title_levels(x, y, common) -> tuple[np.ndarray, np.ndarray]:
    """(level of the title, Dice of the titles or nan); ``common``: how many records bear the commoner title."""
    known = (x[..., TV] != 0).any(axis=-1) & (y[..., TV] != 0).any(axis=-1)
    t = np.where(known, _dice(x[..., TV], y[..., TV]), np.nan)
    level = np.searchsorted([0.48, 0.62, 0.75, 0.85, 0.95], t, "right") + 1
    # the likeness of titles that many records bear is a level of its own
    return np.where(known, np.where((t >= 0.75) & (common > 3), 7, level), 0), t


def other_levels(x, y) -> np.ndarray:
    """Pattern of the levels of all fields but the title, as one number below REST; -1: different parts of a series, which are no pair."""
    n = np.searchsorted([0.35, 0.5, 0.7, 0.9], _dice(x[..., NV], y[..., NV]), "right").astype(np.int32) + 1
    name = n * ((x[..., NV] != 0).any(axis=-1) & (y[..., NV] != 0).any(axis=-1))
    gap = np.abs(x[..., YEAR] - y[..., YEAR])
    year = np.where(gap == 0, 3, np.where(gap == 1, 2, 1)) * ((x[..., YEAR] != NO_YEAR) & (y[..., YEAR] != NO_YEAR))
    part = np.where(x[..., PART] == 0, 0, 2)
    issn, volume, number, first, last, doi = (_agree(x, y, k) for k in range(len(PLACE) + 1))
    # the last page follows from the first but for the length: if both agree, that is one level of one field
    both = (first == 3) & (last == 3)
    first, last = np.where(both, 4, first), np.where(both, 0, last)
    out = np.int64(0)
    for top, level in zip(TOPS[1:], (name, year, part, issn, volume, number, first, last, doi)):
        out = out * top + level
    return np.where(x[..., PART] == y[..., PART], out, -1)


def levels_of(pattern) -> np.ndarray:
    """Levels of FIELDS of each pattern."""
    return np.stack(np.unravel_index(np.asarray(pattern, np.int64), TOPS), axis=1)


def _recs(c: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(c.to_pylist()), np.int64).reshape(-1, REC)


def compare(a: DataFrame, b: DataFrame, pairs: DataFrame, apart: bool = False) -> DataFrame:
    """``pattern`` of the levels of agreement of each pair, 0 meaning unknown; higher is closer; and the titles' Dice.

    Different parts of a series are no pairs; with ``apart`` those are left out that ``crowds`` compares.  Columns of ``pairs`` other than the ids are kept.
    """

    names = pairs.columns

    def run(batches):
        for batch in batches:
            x, y = _recs(batch.column("a_rec")), _recs(batch.column("b_rec"))
            n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a_n", "b_n"))
            title, dice = title_levels(x, y, np.maximum(n, m))
            rest = other_levels(x, y)
            keep = rest >= 0
            if apart:
                far = _ones(x[:, TV] ^ y[:, TV]).sum(axis=1, dtype=np.int64)
                keep &= np.isnan(dice) | (far > TITLE_RADIUS) | (n * m <= CROWD)
            kept = pa.array(keep)
            out = [batch.column(c).filter(kept) for c in names]
            dice = dice[keep]
            yield pa.RecordBatch.from_arrays([*out, pa.array((title * REST + rest)[keep], pa.int64()), pa.array(dice, pa.float64(), mask=np.isnan(dice))], names=[*names, "pattern", "dice"])

    side = lambda x, s: x.select(F.col("id").alias(f"{s}_id"), F.col("rec").alias(f"{s}_rec"), F.col("common").alias(f"{s}_n"))
    j = pairs.join(side(a, "a"), "a_id").join(side(b, "b"), "b_id").select(*names, "a_rec", "b_rec", "a_n", "b_n")
    kept = ", ".join(f"{c} {t}" for c, t in pairs.dtypes)
    return j.mapInArrow(run, f"{kept}, pattern bigint, dice double")


def crowds(a: DataFrame, b: DataFrame, near: DataFrame) -> DataFrame:
    """Blocks (x, y: id and rec by id; n: how many records bear the commoner title) of all records of each pair of titles."""

    def side(t: DataFrame, s: str, out: str) -> DataFrame:
        t = t.join(near.select(F.col(f"{s}_title").alias("title")).distinct(), "title", "left_semi")
        t = t.withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("common") / SIDE)))
        return t.groupBy(F.col("title").alias(f"{s}_title"), "chunk").agg(F.sort_array(F.collect_list(F.struct("id", "rec"))).alias(out)).drop("chunk")

    blocks = near.join(side(a, "a", "x"), "a_title").join(side(b, "b", "y"), "b_title").select("x", "y", F.greatest("a_n", "b_n").alias("n"))
    return cut(blocks.repartition(4 * a.sparkSession.sparkContext.defaultParallelism))


def _block(batch: pa.RecordBatch, i: int):
    """Ids of both sides, level and Dice of the titles, which are alike throughout, and (start, patterns) of strips of the first side."""
    (xi, xr), (yi, yr) = (batch.column(c)[i].values.flatten() for c in ("x", "y"))
    x, y = _recs(xr), _recs(yr)
    title, dice = title_levels(x[:1], y[:1], batch.column("n")[i].as_py())
    strips = ((at, other_levels(x[at : at + STRIP, None], y[None])) for at in range(0, len(x), STRIP))
    return xi.to_numpy(), yi.to_numpy(), int(title[0]), float(dice[0]), strips


def crowd_patterns(blocks: DataFrame) -> DataFrame:
    """pattern, n of the pairs of all blocks."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                _, _, title, _, strips = _block(batch, i)
                counts = np.zeros(REST, np.int64)
                for _, rest in strips:
                    counts += np.bincount(rest[rest >= 0], minlength=REST)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({"pattern": pa.array(title * REST + at), "n": pa.array(counts[at])})

    return blocks.mapInArrow(run, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


def crowd_partners(blocks: DataFrame, patterns: np.ndarray, confidence: np.ndarray) -> DataFrame:
    """a_id, b_id, dice, confidence: in each block the best partner of each record of the second table, if its pattern is among those given."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                xi, yi, title, dice, strips = _block(batch, i)
                value = np.full(REST + 1, -1.0)  # the last for what is no pair
                mine = patterns // REST == title
                value[patterns[mine] % REST] = confidence[mine]
                best, row = np.full(len(yi), -1.0), np.zeros(len(yi), np.int64)
                for at, rest in strips if mine.any() else ():
                    v = value[rest]
                    top = v.argmax(axis=0)  # of equals the first, which has the smallest id
                    v = v[top, np.arange(len(yi))]
                    row, best = np.where(v > best, at + top, row), np.maximum(v, best)
                ok = best >= 0
                yield pa.RecordBatch.from_pydict({"a_id": pa.array(xi[row[ok]]), "b_id": pa.array(yi[ok]), "dice": pa.array(np.full(int(ok.sum()), dice)), "confidence": pa.array(best[ok])})

    return blocks.mapInArrow(run, "a_id bigint, b_id bigint, dice double, confidence double")


class Mixture:
    """Two classes, fields independent given the class; level 0 (unknown) says nothing.

    What chance gives is counted on random pairs (candidates are alike by choice); what true pairs give, and how many of
    all ``total`` pairs are true, is fitted to the candidates by expectation-maximisation.
    """

    def __init__(self, patterns, counts, chance, chance_counts, total: float, rounds: int = 40, likely=None):
        x, w = np.asarray(patterns, int).reshape(-1, len(FIELDS)), np.asarray(counts, float)
        y, v = np.asarray(chance, int).reshape(-1, len(FIELDS)), np.asarray(chance_counts, float)
        top = [int(max(x[:, f].max(initial=1), y[:, f].max(initial=1))) for f in range(len(FIELDS))]

        def levels(z, weights, f):
            c = np.bincount(z[:, f], weights=weights, minlength=top[f] + 1)
            c[0] = 0
            return (c + 0.5) / (c.sum() + 0.5 * len(c))

        self.u = [levels(y, v, f) for f in range(len(FIELDS))]
        self.m = [np.array([1, *np.linspace(0.1, 1, t)]) for t in top]
        self.m = [m / m[1:].sum() for m in self.m]
        self.prior = min(0.5, max(1e-12, 0.3 * w.sum() / max(total, 1)))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-self._logit(x)))
            self.m = [levels(x, w * p, f) for f in range(len(FIELDS))]
            self.prior = min(0.5, max(1e-12, ((w * p).sum() + 0.5) / max(total, 1)))

        self.a, self.b = 0.0, 1.0
        # pairs that only a common DOI brought together would make it seem that DOIs agree whatever the score
        some = np.ones(len(w), bool) if likely is None else np.asarray(likely, int) > 0
        self._calibrate(x[some], w[some])

    def weights(self, f: int) -> np.ndarray:
        """What each level of a field adds to the score."""
        r = np.log(self.m[f] / self.u[f])
        r[0] = 0.0
        return r

    def _logit(self, x, without: int | None = None):
        z = np.full(len(x), np.log(self.prior / (1 - self.prior)))
        for f in range(len(FIELDS)):
            if f != without:
                z += self.weights(f)[x[:, f]]
        return np.clip(z, -50, 50)

    def _calibrate(self, x, w) -> None:
        """The line a + b * score (without the DOI) whose logistic curve is likeliest, given which DOIs agree.

        Of one paper's records the DOIs agree with the probability that the mixture found (some are wrong), of others' by chance (some are
        shared).  With fewer than MIN_KNOWN pairs the score is taken as it is.
        """
        d = FIELDS.index("doi")
        known = x[:, d] > 0
        if w[known].sum() < MIN_KNOWN:
            return
        s, y, n = self._logit(x[known], d), x[known, d] == 3, w[known]
        m, u = self.m[d][3], min(self.u[d][3], 0.5 * self.m[d][3])
        best = -np.inf
        for b in np.linspace(0.1, 1.5, 29):
            for a in np.linspace(-10, 10, 81):
                p = u + (m - u) / (1 + np.exp(-(a + b * s)))
                # a weak pull towards the score as it is
                fit = float((n * np.log(np.where(y, p, 1 - p))).sum()) - 0.5 * (a / 5) ** 2 - 0.5 * ((b - 1) / 0.5) ** 2
                if fit > best:
                    best, self.a, self.b = fit, float(a), float(b)

    def confidence(self, levels) -> np.ndarray:
        """Calibrated confidence of rows of levels."""
        d = FIELDS.index("doi")
        return 1 / (1 + np.exp(-(self.a + self.b * self._logit(levels, d) + self.weights(d)[levels[:, d]])))


def random_pairs(a: DataFrame, b: DataFrame, n: int, salts: int = 32) -> DataFrame:
    """About salts x min(rows) pairs, drawn by hash: each record meets those of its bucket."""
    salt = F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("salt")
    x = a.select("id", salt).select(F.col("id").alias("a_id"), "salt", F.pmod(F.xxhash64("id", "salt"), F.lit(n)).alias("k"))
    y = b.select("id", salt).select(F.col("id").alias("b_id"), "salt", F.pmod(F.xxhash64("salt", "id", F.lit("b")), F.lit(n)).alias("k"))
    return x.join(y, ["salt", "k"]).select("a_id", "b_id")


def link(kci: DataFrame, scopus: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """a_id, b_id, confidence: the records of the two tables that are one thing.

    Nulls and broken lists are unknown attributes; records with too little known are matched by nothing; each record of the second
    table goes to its best partner (ties: higher title Dice, then the smaller id), while one of the first may have several (things stored twice).
    """
    a, b = cut(_encode(kci)), cut(_encode(scopus))
    copies = lambda x: x.filter("title is not null").groupBy("title").agg(F.count("*").alias("common")).filter("common > 1")
    a, b = (cut(x.join(copies(x), "title", "left").withColumn("common", F.coalesce("common", F.lit(1)).cast("bigint"))) for x in (a, b))
    na, nb = a.count(), b.count()
    near = cut(near_titles(a, b))
    many = F.col("a_n") * F.col("b_n") > CROWD
    levels = cut(compare(a, b, candidates(a, b, near.filter(~many)), apart=True))
    blocks = crowds(a, b, near.filter(many))
    found = levels.groupBy("pattern", "likely").agg(F.count("*").alias("n")).unionByName(crowd_patterns(blocks).withColumn("likely", F.lit(1))).groupBy("pattern", "likely").agg(F.sum("n").alias("n")).toPandas()
    chance = compare(a, b, random_pairs(a, b, max(na, nb, 1))).groupBy("pattern").agg(F.count("*").alias("n")).toPandas()
    mix = Mixture(levels_of(found["pattern"]), found["n"], levels_of(chance["pattern"]), chance["n"], float(na) * nb, likely=found["likely"])
    patterns = np.unique(found["pattern"].to_numpy(np.int64))
    confidence = mix.confidence(levels_of(patterns))
    patterns, confidence = patterns[confidence >= min_confidence], confidence[confidence >= min_confidence]
    good = a.sparkSession.createDataFrame(list(zip(patterns.tolist(), confidence.tolist())), "pattern bigint, confidence double")
    scored = levels.join(F.broadcast(good), "pattern").select("a_id", "b_id", "dice", "confidence").unionByName(crowd_partners(blocks, patterns, confidence))
    best = scored.groupBy("b_id").agg(F.max_by(F.struct("a_id", "confidence"), F.struct("confidence", "dice", -F.col("a_id"))).alias("x"))
    return best.select(F.col("x.a_id").alias("a_id"), "b_id", F.col("x.confidence").alias("confidence"))
