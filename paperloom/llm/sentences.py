"""Pair the sentences of a text and its loose translation.

Cross-lingual term vectors come from the singular value decomposition of the paired documents' terms: the
centred, frequency-scaled cross-covariance of source terms and target terms, first over whole documents, then over the
sentences that the first round paired.  Clauses (the windows into which merged sentences fall) are matched by a margin
score, cosine less the mean similarity of either side's neighbours, as mutual nearest neighbours in any order; clauses
left over may join a sentence that is taken (merges), and clauses below the threshold stay unpaired (omissions).

Scale.  Terms below ``FLOOR`` of all term occurrences get no vector, so there are at most 1/FLOOR.  The decomposition is a
randomised range finder: each pass adds up one terms x RANK matrix per task.  Texts are tokenised once and kept as
small integer lists; each document is aligned on its own.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut

FLOOR = 5e-5
RANK = 160
THRESHOLD, JOIN = 0.5, 0.5

_SENT_END = re.compile(r"(?<=[.!?])\s+")
_CLAUSE = re.compile(r"[;,]\s+")
_WORD = re.compile(r"[가-힣]+|[A-Za-z][A-Za-z\-]*[A-Za-z0-9\-]*|\d+(?:[.,]\d+)*")


def sentences(text: str) -> list[str]:
    return [s for s in _SENT_END.split(text.strip()) if s.strip()]


def clauses(text: str) -> list[tuple[int, str]]:
    """(number of the sentence, clause).  A comma or semicolon divides if both sides have three words or more."""
    out = []
    for no, s in enumerate(sentences(text), 1):
        parts = _CLAUSE.split(s)
        merged = [parts[0]]
        for p in parts[1:]:
            if len(merged[-1].split()) < 3 or len(p.split()) < 3:
                merged[-1] += ", " + p
            else:
                merged.append(p)
        out += [(no, c) for c in merged]
    return out


def terms(clause: str) -> tuple[list[str], list[str]]:
    """(terms for the vectors, strings that are the same in both languages: numbers and names)."""
    ts, same = [], []
    for w in _WORD.findall(clause):
        c = w[0]
        if c.isdigit():
            same.append(w.replace(",", ""))
        elif "가" <= c <= "힣":
            ts.append(w[:2])
            if len(w) > 3:
                ts.append(w[:3])
        else:
            w = w.lower()
            ts.append(w[:6])
            same.append(w)
    return ts, same


def _prepare(df: DataFrame, id_col: str, a: str, b: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, *texts = (c.to_pylist() for c in batch.columns)
            rows: dict[str, list] = {k: [] for k in ("id", "a_no", "a_terms", "a_same", "b_no", "b_terms", "b_same")}
            for i, x, y in zip(ids, *texts):
                cx, cy = clauses(x), clauses(y)
                rows["id"].append(i)
                for side, cs in (("a", cx), ("b", cy)):
                    t = [terms(c) for _, c in cs]
                    rows[f"{side}_no"].append([n for n, _ in cs])
                    rows[f"{side}_terms"].append(["\x01".join(u) for u, _ in t])
                    rows[f"{side}_same"].append(["\x01".join(u) for _, u in t])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64() if k == "id" else pa.list_(pa.int32()) if k.endswith("no") else pa.list_(pa.string())) for k, v in rows.items()], names=list(rows))

    both = df.filter(F.col(a).rlike(r"\S") & F.col(b).rlike(r"\S")).select(F.col(id_col).cast("bigint").alias("id"), a, b)
    return both.mapInArrow(run, "id bigint, a_no array<int>, a_terms array<string>, a_same array<string>, b_no array<int>, b_terms array<string>, b_same array<string>")


def segment_sums(rows: np.ndarray, flat: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sums of rows[flat] over consecutive segments, added position by position, long segments first."""
    at = np.cumsum(lens) - lens
    order = np.argsort(-lens, kind="stable")
    at, lens = at[order], lens[order]
    acc = np.zeros((len(lens), rows.shape[1]), rows.dtype)
    for t in range(int(lens[0]) if len(lens) else 0):
        n = int(np.searchsorted(-lens, -t, side="left"))
        acc[:n] += rows[flat[at[:n] + t]]
    out = np.empty_like(acc)
    out[order] = acc
    return out


class Vectors:
    """Term vectors of the two sides, in one space."""

    def __init__(self, a_ids, b_ids, a_weight, b_weight):
        self.a_ids, self.b_ids, self.a_w, self.b_w = a_ids, b_ids, a_weight, b_weight
        self.u = self.v = None

    def clause_matrix(self, side: str, packed: list[str]) -> np.ndarray:
        """Unit vectors of clauses: the weighted sums of their terms' vectors."""
        ids, vec = (self.a_ids, self._scaled("a")) if side == "a" else (self.b_ids, self._scaled("b"))
        get = ids.get
        found = [[k for t in p.split("\x01") if (k := get(t)) is not None] for p in packed]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((k for f in found for k in f), np.int64, int(lens.sum()))
        out = segment_sums(vec, flat, lens)
        out /= np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-9)[:, None]
        return out

    def _scaled(self, side: str) -> np.ndarray:
        if not hasattr(self, "_both"):
            self._both = {"a": self.u * self.a_w[:, None], "b": self.v * self.b_w[:, None]}
        return self._both[side]


def _paired(prepared: DataFrame, model: Vectors, vectors: Vectors | None) -> DataFrame:
    """x, y: distinct term numbers that belong together, of whole documents in the first round, of paired sentences afterwards."""
    v = prepared.sparkSession.sparkContext.broadcast((model.a_ids, model.b_ids, vectors))

    def run(batches):
        a_ids, b_ids, vec = v.value
        for batch in batches:
            d, xs, ys = batch.to_pydict(), [], []
            for x, y, links in zip(d["a_terms"], d["b_terms"], _align_batch(d, vec) if vec else repeat(None)):
                for p, q in [("\x01".join(x), "\x01".join(y))] if links is None else [(x[i], y[j]) for i, j, _ in links]:
                    tx = {k for t in p.split("\x01") if (k := a_ids.get(t)) is not None}
                    ty = {k for t in q.split("\x01") if (k := b_ids.get(t)) is not None}
                    if tx and ty:
                        xs.append(list(tx))
                        ys.append(list(ty))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(xs, kind), pa.array(ys, kind)], names=["x", "y"])

    return cut(prepared.select("a_terms", "a_same", "b_terms", "b_same").mapInArrow(run, "x array<int>, y array<int>"))


def _sketch(pairs: DataFrame, right: np.ndarray, transpose: bool, shape: tuple[int, int]) -> np.ndarray:
    """C @ right (or C.T @ right) for the centred cross-covariance C of the paired term lists."""
    rows, k = shape[1] if transpose else shape[0], right.shape[1]
    b = pairs.sparkSession.sparkContext.broadcast(right.astype(np.float32))

    def run(batches):
        r = b.value
        acc = np.zeros((k, rows))
        left_sum, proj_sum, n = np.zeros(rows), np.zeros(k), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            (xs, x_len), (ys, y_len) = ((c.flatten().to_numpy(), np.diff(c.offsets.to_numpy())) for c in (batch.columns[::-1] if transpose else batch.columns))
            z = segment_sums(r, ys, y_len)
            own = np.repeat(np.arange(len(x_len)), x_len)
            for j, col in enumerate(np.ascontiguousarray(z.T)):
                acc[j] += np.bincount(xs, weights=col[own], minlength=rows)
            left_sum += np.bincount(xs, minlength=rows)
            proj_sum += z.sum(axis=0)
            n += len(x_len)
        if n:
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(np.arange(rows + 1, dtype=np.int32)),
                "n": pa.array(np.concatenate((left_sum, [float(n)]))),
                "x": pa.array(list(np.vstack((acc.T, proj_sum))), pa.list_(pa.float64()))})

    cols = pairs.select("x", "y").mapInArrow(run, "row int, n double, x array<double>")
    total = cols.groupBy("row").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("x")[i]) for i in range(k)]).alias("x"))
    pdf = total.toPandas().sort_values("row")
    if not len(pdf):
        return np.zeros((rows, k))
    x, n = np.stack(pdf["x"].to_numpy()), pdf["n"].to_numpy()
    return x[:-1] - np.outer(n[:-1], x[-1]) / n[-1]


def learn_vectors(prepared: DataFrame, rounds: int = 2, rank: int = RANK, floor: float = FLOOR, seed: int = 7) -> Vectors | None:
    sides = []
    for s in ("a", "b"):
        t = prepared.select(F.explode(F.array_distinct(F.split(F.array_join(f"{s}_terms", "\x01"), "\x01"))).alias("t")).filter("t <> ''")
        sides.append(t.groupBy("t").agg(F.count("*").alias("n")).withColumn("side", F.lit(s)))
    counts = sides[0].unionByName(sides[1])
    total = counts.groupBy("side").agg(F.sum("n").alias("all"))
    docs = prepared.count()
    kept = counts.join(F.broadcast(total), "side").filter((F.col("n") >= 2) & (F.col("n") >= F.col("all") * floor)).toPandas()
    kept = kept.sort_values(["side", "t"])
    a, b = kept[kept["side"] == "a"], kept[kept["side"] == "b"]
    if not len(a) or not len(b):
        return None
    wa, wb = (np.log1p(docs / x["n"].to_numpy(float)).astype(np.float32) for x in (a, b))
    base = Vectors({t: i for i, t in enumerate(a["t"])}, {t: i for i, t in enumerate(b["t"])}, wa, wb)
    sa, sb = (1 / np.sqrt(x["n"].to_numpy(float)) for x in (a, b))
    shape, k = (len(a), len(b)), min(rank, len(a), len(b))
    vectors = None
    for _ in range(rounds):
        pairs = _paired(prepared, base, vectors)
        omega = np.random.default_rng(seed).standard_normal((shape[1], k))
        y = sa[:, None] * _sketch(pairs, sb[:, None] * omega, False, shape)
        q, _ = np.linalg.qr(y)
        bt = sb[:, None] * _sketch(pairs, sa[:, None] * q, True, shape)
        uu, ss, vt = np.linalg.svd(bt.T, full_matrices=False)
        new = Vectors(base.a_ids, base.b_ids, wa, wb)
        root = np.sqrt(np.maximum(ss, 0))
        new.u = ((q @ uu) * root).astype(np.float32)
        new.v = (vt.T * root).astype(np.float32)
        # terms of even length, so that the weights above decide
        for m in (new.u, new.v):
            m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
        vectors = new
    return vectors


def _add_same(s: np.ndarray, xs: list[str], ys: list[str]) -> None:
    """Agreement of numbers and names: shared ones count for, numbers without a like count against."""
    mine = [set(x.split("\x01")) if x else () for x in xs]
    every = set().union(*mine)
    if not every:
        return
    where: dict[str, list[int]] = {}
    nums: list[tuple[int, list[float]]] = []
    for c, y in enumerate(ys):
        words = y.split("\x01")
        for w in every.intersection(words):
            where.setdefault(w, []).append(c)
        n = [float(w) for w in words if w and w[0].isdigit() and w.count(".") < 2]
        if n:
            nums.append((c, n))
    for r, ws in enumerate(mine):
        add: dict[int, float] = {}
        for w in ws:
            digit = w[0].isdigit()
            for c in where.get(w, ()):
                add[c] = add.get(c, 0.0) + (0.3 if digit else 0.35)
            if digit and w.count(".") < 2:
                p = float(w)
                near = max(1.0, 0.03 * p)
                for c, ns in nums:
                    if p not in ns:
                        like = p > 9 and min([abs(p - q) for q in ns]) <= near
                        add[c] = add.get(c, 0.0) + (0.2 if like else -0.1)
        for c, v in add.items():
            s[r, c] += max(-0.3, min(0.7, v))


def _align_batch(d: dict, vec: Vectors) -> list[list[tuple[int, int, float]]]:
    a_all = vec.clause_matrix("a", [c for x in d["a_terms"] for c in x])
    b_all = vec.clause_matrix("b", [c for x in d["b_terms"] for c in x])
    out, i, j = [], 0, 0
    for x, y, xs, ys in zip(d["a_terms"], d["b_terms"], d["a_same"], d["b_same"]):
        p, q = a_all[i : i + len(x)], b_all[j : j + len(y)]
        i, j = i + len(x), j + len(y)
        if not len(x) or not len(y):
            out.append([])
            continue
        s = p @ q.T
        _add_same(s, xs, ys)
        m = s - 0.25 * (s.mean(axis=1, keepdims=True) + s.mean(axis=0, keepdims=True))
        best_b, best_a = m.argmax(axis=1), m.argmax(axis=0)
        links = [(r, int(c), float(m[r, c])) for r, c in enumerate(best_b) if best_a[c] == r and m[r, c] > THRESHOLD]
        done_a, done_b = {r for r, _, _ in links}, {c for _, c, _ in links}
        # what is left: first among itself, then to a clause that is taken
        left = sorted(((float(m[r, c]), r, c) for r in range(len(x)) if r not in done_a for c in range(len(y)) if c not in done_b), reverse=True)
        for v, r, c in left:
            if v > THRESHOLD and r not in done_a and c not in done_b:
                links.append((r, c, v))
                done_a.add(r)
                done_b.add(c)
        for r in range(len(x)):
            if r not in done_a and m[r, best_b[r]] > JOIN:
                links.append((r, int(best_b[r]), float(m[r, best_b[r]])))
        for c in range(len(y)):
            if c not in done_b and m[best_a[c], c] > JOIN:
                links.append((int(best_a[c]), c, float(m[best_a[c], c])))
        out.append(links)
    return out


def align(df: DataFrame, id_col: str, a: str, b: str, rounds: int = 2) -> DataFrame:
    """id, a_no, b_no, score: sentence numbers (from 1) that translate each other.

    Rows with a null or blank side give nothing; an empty table gives an empty table; repeated rows repeat their pairs; texts
    of any length are aligned whole; of equally scored partners the first in the text is taken.
    """
    prepared = cut(_prepare(df, id_col, a, b))
    vectors = learn_vectors(prepared, rounds)
    v = df.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for batch in batches:
            d = batch.to_pydict()
            rows: dict[str, list] = {k: [] for k in ("id", "a_no", "b_no", "score")}
            for i, an, bn, links in zip(d["id"], d["a_no"], d["b_no"], _align_batch(d, v.value)):
                best: dict[tuple[int, int], float] = {}
                for r, c, s in links:
                    k = (an[r], bn[c])
                    best[k] = max(s, best.get(k, s))
                for (x, y), s in sorted(best.items()):
                    for k, val in zip(rows, (i, x, y, s)):
                        rows[k].append(val)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["id"], pa.int64()), pa.array(rows["a_no"], pa.int64()), pa.array(rows["b_no"], pa.int64()), pa.array(rows["score"], pa.float64())], names=list(rows))

    schema = "id bigint, a_no bigint, b_no bigint, score double"
    if vectors is None:
        return df.sparkSession.createDataFrame([], schema)
    return prepared.mapInArrow(run, schema)
