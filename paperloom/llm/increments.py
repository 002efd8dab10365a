"""Duplicates of new batches against all history, through graph index shards.

Every record becomes a vector (signed feature hashing of its place, names, identifiers and title q-grams) and a row of exact
features.  History is cut into segments of about SHARD_SIZE records; each gets a navigable small-world graph: near
neighbours, their reverse links and a few long-range links.  A batch is indexed as a shard of its own and searched with a beam
in every shard.  When a shard is built, its beam is widened until its recall against exhaustive search on retyped members reaches
TARGET; the recall is stored with the shard.  A shard for which no beam is good that is narrower than a SPANth of it is searched exhaustively (smaller
ones always, and so have no graph): lists of the nodes that have a value leave the few that could be the query's paper.  What the beam finds is
reranked with the exact features, which the shard holds too.  A query whose beam has a match in its worse half, so that more may
lie beyond it, is compared with the whole shard.  Equal source_ids are looked up in a sorted list that each shard has.  What is
hit is then searched itself if it never was, until no smaller id of a paper turns up.  After COMPACT_EVERY batches the small shards are merged and
their graphs rebuilt.

The index lies in a folder: encoded records, shards, links found so far, and numbered manifests that say which of these belong to it.
``ShardedIndex.open`` takes it up again in a later run, and ``accept`` adds a batch without reading the records behind the shards.

Scale.  Building is linear in the history (neighbours are sought in cells of bounded size).  A batch is dealt into blocks of about BLOCK
queries; shards are scanned where they lie and the blocks (then fewer and larger) are broadcast to them if the batch has MAX_BROADCAST records at
most (about 700 bytes each), else both are shuffled by the shard's number.  Copies that differ in source_id at most share one node, so hot groups of copies do not clot a
graph; a crowd of unlike copies costs each query that meets it one pass over the shard.  A lost executor costs a re-run of its tasks.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from paperloom.llm.linkage import clean_title, families, part_number, qgram_bits
from paperloom.session import cut, ensure_checkpoint_dir
from paperloom.sources.store import Folder

DIM, SHARD_SIZE, BLOCK, NEAR, BACK, FAR = 96, 32768, 512, 12, 28, 4
CELL, DIVISIONS = 1024, 3
BEAM, TARGET, PROBE_EVERY, OPEN = 32, 0.995, 32, 4
PAIRS = 1 << 16  # compared at a time
SPAN = 512  # a beam of more than a SPANth of a shard takes longer than comparing all of it
MAX_BROADCAST = 65_536
COMPACT_EVERY = 5
TAGS = re.compile(r"^\W*(정정|토론|논평|반론|회신|정오표|서평|correction|corrigendum|erratum|discussion|comment|reply|response)\b|[\[(](정정|토론|논평|반론|회신|정오표|correction|corrigendum|erratum|discussion|comment|reply|response)[\])]", re.IGNORECASE)
_HANGUL = re.compile("[가-힣]")
FEATS = ("source_id", "doi", "journal", "volume", "number", "first", "last", "tag", "titled")


def _h(s: str | None) -> int:
    """Hash of a known value, 0 of an unknown one."""
    if not s:
        return 0
    return (zlib.crc32(s.encode()) << 31 | zlib.adler32(s[::-1].encode())) or 1


_signs: dict[str, np.ndarray] = {}


def _signed(token: str) -> np.ndarray:
    """Eight signed places of a token, as a row of DIM."""
    v = _signs.get(token)
    if v is None:
        if len(_signs) > 200_000:
            _signs.clear()
        v = np.zeros(DIM, np.float32)
        h = zlib.crc32(token.encode())
        g = zlib.crc32(token[::-1].encode(), h)
        for k in range(8):
            x = (h + k * g) & 0xFFFFFFFF
            x = (x ^ (x >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
            v[(x >> 8) % DIM] += 1 if x & 0x80000000 else -1
        _signs[token] = v
    return v


def encode_record(r: dict) -> tuple[bytes, bytes, bytes]:
    """(vector, exact features, bit vectors: two titles of 512 and names of 256 bits)."""
    digits = lambda x: re.sub(r"\D", "", x or "")
    vol, _, num = (r["issue_id"] or "").partition("_")
    vol, num, first, last = digits(vol), digits(num), digits(r["first_page"]), digits(r["final_page"])
    journal = (r["journal_id"] or "").strip()
    title = r["title"] or ""
    kor = r["title_kor"] or (title if _HANGUL.search(title) else "")
    eng = r["title_eng"] or (title if title and not _HANGUL.search(title) else "")
    m = re.search(r"10\.\d{3,}[\d.]*/\S+", (r["doi"] or "").lower())
    doi = m[0].rstrip(".,;)") if m else ""
    sid = (r["source_id"] or "").strip()
    sid = "" if sid.lower() in ("", "-", "unknown") or sid.startswith("10.") or " " in sid else sid
    sure, may = families(r["authors_json"])
    part = part_number(kor) or part_number(eng)
    found = TAGS.search(kor) or TAGS.search(eng)
    kind = {"정정": "correction", "정오표": "correction", "토론": "discussion", "논평": "comment", "반론": "reply", "회신": "reply", "corrigendum": "correction", "erratum": "correction", "response": "reply"}
    word = next((g for g in found.groups() if g), "").lower() if found else ""
    year = re.search(r"(?:19|20)\d\d", kor or eng)
    tag = f"{part}|{kind.get(word, word)}|{year[0] if year else ''}"
    k, e = clean_title(kor).replace(" ", ""), clean_title(eng).replace(" ", "")
    v = np.zeros(DIM, np.float32)
    # from coarse to fine, so that a search can approach: records of one journal, then of its volume, then of the place
    for t, w in (
        (journal and "j" + journal, 1.5), (vol and "v" + vol, 1.0), (vol and journal and f"jv{journal}|{vol}", 1.2), (num and f"n{vol}|{num}", 0.6),
        (first and "f" + first, 1.2), (last and "l" + last, 1.2), (first and vol and f"p{vol}|{first}", 1.2), (doi and "d" + doi, 0.7),
    ):
        if t:
            v += w * _signed(t)
    for name in (sure or may)[:8]:
        v += 1.2 / len((sure or may)[:8]) ** 0.5 * _signed("a" + name)
    for lang, s in (("k", k), ("e", e)):
        grams = {s[i : i + 3] for i in range(len(s) - 2)}
        if grams:
            v += 1.6 / len(grams) ** 0.5 * np.add.reduce([_signed(lang + g) for g in sorted(grams)])
    n = np.linalg.norm(v)
    v /= n if n else 1.0
    feats = np.array([_h(sid), _h(doi), _h(journal), _h(vol), _h(num), _h(first), _h(last), _h(tag), (1 if k else 0) | (2 if e else 0)], np.int64)
    bits = np.array(qgram_bits([k] if k else [], 512) + qgram_bits([e] if e else [], 512) + qgram_bits(sure or may, 256), np.int64)
    return v.tobytes(), feats.tobytes(), bits.tobytes()


COLUMNS = ["source_id", "title", "title_kor", "title_eng", "doi", "authors_json", "journal_id", "issue_id", "first_page", "final_page"]


ENCODED = "id bigint, vec binary, feat binary, bits binary, probe binary"


def retyped(r: dict) -> dict:
    """The record as it might come again: another id, no DOI, one title, a seventh of its letters gone."""
    t = r["title_kor"] or r["title"] or r["title_eng"]
    t = "".join(c for i, c in enumerate(t or "") if i % 7 != 3)
    return r | {"source_id": None, "doi": None, "title": t, "title_kor": None, "title_eng": None}


def encode(df: DataFrame) -> DataFrame:
    """Encoded records; of one in PROBE_EVERY also the vector of a retyped version, against which beams are tuned."""

    def run(batches):
        for b in batches:
            d = b.to_pylist()
            e = [encode_record(r) for r in d]
            probe = [encode_record(retyped(r))[0] if zlib.crc32(str(r["id"]).encode()) % PROBE_EVERY == 0 else None for r in d]
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([r["id"] for r in d], pa.int64()),
                **{n: pa.array([x[i] for x in e], pa.binary()) for i, n in enumerate(("vec", "feat", "bits"))}, "probe": pa.array(probe, pa.binary())})

    return df.select(F.col("id").cast("bigint"), *COLUMNS).mapInArrow(run, ENCODED)


# --- one shard -------------------------------------------------------------------------------------------------------


def _leaves(x: np.ndarray, rng: np.random.Generator, size: int) -> list[np.ndarray]:
    """Cells of at most ``size`` members: halved at the median of the difference of two members, again and again."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        c = todo.pop()
        if len(c) <= size:
            out.append(c)
            continue
        p, q = rng.choice(c, 2, replace=False)
        side = x[c] @ (x[p] - x[q])
        order = np.argsort(side, kind="stable")
        half = len(c) // 2
        todo += [c[order[:half]], c[order[half:]]]
    return out


def build_graph(x: np.ndarray, seed: int) -> np.ndarray:
    """Links of each node: NEAR nearest of several random divisions into cells, reverse links, FAR random ones; -1: none.

    No node is linked twice from one node.  Work is linear in the shard: every node meets CELL others per division.
    """
    n = len(x)
    width = NEAR + BACK + FAR
    links = np.full((n, width), -1, np.int32)
    if n < 2:
        return links
    rng = np.random.default_rng(seed)
    k = min(NEAR, n - 1)
    best = np.full((n, k), -1, np.int64)
    sims = np.full((n, k), -3.0, np.float32)
    for _ in range(1 if n <= CELL else DIVISIONS):
        for c in _leaves(x, rng, CELL):
            s = x[c] @ x[c].T
            np.fill_diagonal(s, -3)
            m = min(k, len(c) - 1)
            if m < 1:
                continue
            top = np.argpartition(-s, m - 1, axis=1)[:, :m]
            ids = np.concatenate((best[c], c[top]), axis=1)
            val = np.concatenate((sims[c], np.take_along_axis(s, top, 1)), axis=1)
            # a neighbour that was found before counts once
            order = np.lexsort((-val, ids), axis=1)
            ids, val = np.take_along_axis(ids, order, 1), np.take_along_axis(val, order, 1)
            val[:, 1:][ids[:, 1:] == ids[:, :-1]] = -3.0
            order = np.argsort(-val, axis=1, kind="stable")[:, :k]
            best[c], sims[c] = np.take_along_axis(ids, order, 1), np.take_along_axis(val, order, 1)
    best[sims <= -3] = -1
    links[:, :k] = best
    src, dst = np.repeat(np.arange(n), k), best.ravel()
    ok = dst >= 0
    src, dst = src[ok], dst[ok]
    # places for links back go first to the nodes that few others link to, so that each can be reached
    liked = np.bincount(dst, minlength=n)
    order = np.lexsort((liked[src], dst))
    src, dst = src[order], dst[order]
    rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
    keep = rank < BACK
    links[dst[keep], NEAR + rank[keep]] = src[keep]
    links[:, NEAR + BACK :] = rng.integers(0, n, (n, FAR))
    order = np.sort(links, axis=1)
    dup = np.zeros_like(links, bool)
    dup[:, 1:] = order[:, 1:] == order[:, :-1]
    order[dup] = -1
    return order


def beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, beam: int, entries: np.ndarray, node_ids: np.ndarray | None = None, before: np.ndarray | None = None) -> np.ndarray:
    """Best nodes of each query found with a beam: len(q) x beam node numbers (-1: none), best first.

    All queries advance together; each step opens the OPEN best nodes of every beam that are not open yet.  With ``before``, an id for
    each query, as many columns follow: the best nodes met on the way whose id is smaller.
    """
    m, n = len(q), len(x)
    beam = min(max(beam, 1), n)
    seen = np.zeros((m, n), bool)
    ids = np.full((m, beam), -1, np.int64)
    sims = np.full((m, beam), -3.0, np.float32)
    opened = np.ones((m, beam), bool)
    # the upper layer: a thin sample of the shard, of which each query starts at the best
    first = q @ x[entries].T
    w = min(beam, len(entries), 8)
    order = np.argsort(-first, axis=1, kind="stable")[:, :w]
    ids[:, :w], sims[:, :w], opened[:, :w] = entries[order], np.take_along_axis(first, order, 1), False
    seen[np.arange(m)[:, None], ids[:, :w]] = True
    older, older_sims = np.full((m, beam), -1, np.int64), np.full((m, beam), -3.0, np.float32)
    if before is not None:
        ok = (ids[:, :w] >= 0) & (node_ids[ids[:, :w]] < before[:, None])
        older[:, :w], older_sims[:, :w] = np.where(ok, ids[:, :w], -1), np.where(ok, sims[:, :w], -3.0)
    live = np.arange(m)
    width = min(OPEN, beam)
    while len(live):
        closed = opened[live]
        todo = ~closed.all(axis=1)
        live, closed = live[todo], closed[todo]
        if not len(live):
            break
        # rows are sorted, so the first unopened columns are the best
        pick = np.argsort(closed, axis=1, kind="stable")[:, :width]
        valid = ~np.take_along_axis(closed, pick, 1)
        rows = live[:, None]
        opened[rows, pick] = True
        nb = links[np.where(valid, ids[rows, pick], 0)]
        nb = np.where(valid[:, :, None], nb, -1).reshape(len(live), -1)
        safe = np.maximum(nb, 0)
        fresh = (nb >= 0) & ~seen[rows, safe]
        r, c = np.nonzero(fresh)
        node = safe[r, c]
        # two opened nodes may share a neighbour: the first stays
        key = r * np.int64(n) + node
        _, one = np.unique(key, return_index=True)
        r, node = r[one], node[one]
        if not len(r):
            continue
        seen[live[r], node] = True
        val = np.einsum("ij,ij->i", q[live[r]], x[node])
        counts = np.bincount(r, minlength=len(live))
        most = int(counts.max())
        pos = np.arange(len(r)) - np.repeat(np.cumsum(counts) - counts, counts)
        new_ids = np.full((len(live), most), -1, np.int64)
        new_sims = np.full((len(live), most), -3.0, np.float32)
        new_ids[r, pos], new_sims[r, pos] = node, val
        if before is not None:
            ok = (new_ids >= 0) & (node_ids[np.maximum(new_ids, 0)] < before[live][:, None])
            o_ids = np.concatenate((older[live], np.where(ok, new_ids, -1)), axis=1)
            o_sims = np.concatenate((older_sims[live], np.where(ok, new_sims, -3.0)), axis=1)
            order = np.argsort(-o_sims, axis=1, kind="stable")[:, :beam]
            older[live], older_sims[live] = np.take_along_axis(o_ids, order, 1), np.take_along_axis(o_sims, order, 1)
        a_ids = np.concatenate((ids[live], new_ids), axis=1)
        a_sims = np.concatenate((sims[live], new_sims), axis=1)
        a_open = np.concatenate((opened[live], new_ids < 0), axis=1)
        order = np.argsort(-a_sims, axis=1, kind="stable")[:, :beam]
        ids[live], sims[live], opened[live] = (np.take_along_axis(a, order, 1) for a in (a_ids, a_sims, a_open))
    return ids if before is None else np.concatenate((ids, older), axis=1)


def tuned_beam(x: np.ndarray, links: np.ndarray, probe: np.ndarray, entries: np.ndarray, span: int = 2) -> tuple[int, float]:
    """The first beam of BEAM, 2 BEAM, … that finds what exhaustive search finds, for TARGET of the probes, and its recall.

    A beam of one ``span``-th of the shard and more is as wide as the shard, which then is searched exhaustively.  Without probes the beam is
    2 BEAM.
    """
    beam, n = BEAM, len(x)
    if not len(probe):
        return 2 * beam, 1.0
    parts = [probe[at : at + 512] for at in range(0, len(probe), 512)]
    truth = np.concatenate([(p @ x.T).max(axis=1) for p in parts])
    while span * beam < n:
        got = np.concatenate([beam_search(x, links, p, beam, entries)[:, 0] for p in parts])
        recall = float((np.einsum("md,md->m", probe, x[got]) >= truth - 1e-5).mean())
        if recall >= TARGET:
            return beam, recall
        beam *= 2
    return n, 1.0


PARTS = (("ids", np.int64, 1), ("vec", np.float32, DIM), ("feat", np.int64, len(FEATS)), ("bits", np.int64, 20), ("links", np.int32, NEAR + BACK + FAR))
SIDS = (("sid", np.int64), ("sid_id", np.int64), ("sid_node", np.int32))


def _pack(ids, vec, feat, bits, links, sids) -> bytes:
    head = np.array([len(ids), len(sids[0])], np.int64).tobytes()
    return b"".join((head, *(v.astype(t).tobytes() for v, (_, t, _) in zip((ids, vec, feat, bits, links), PARTS)), *(v.astype(t).tobytes() for v, (_, t) in zip(sids, SIDS))))


def _unpack(b):
    """ids, vectors, features, bits, links of the nodes; (source_id, id, node) of the records with a source_id, sorted."""
    n, m = np.frombuffer(b, np.int64, 2).tolist()
    at, out, sids = 16, [], []
    for _, t, w in PARTS:
        out.append(np.frombuffer(b, t, n * w, at).reshape(n, w) if w > 1 else np.frombuffer(b, t, n, at))
        at += n * w * np.dtype(t).itemsize
    for _, t in SIDS:
        sids.append(np.frombuffer(b, t, m, at))
        at += m * np.dtype(t).itemsize
    return *out, tuple(sids)


def _entries(n: int) -> np.ndarray:
    return np.unique(np.linspace(0, n - 1, max(16, int(3 * n**0.5))).astype(np.int64))


SHARD = "shard bigint, n bigint, beam int, probes int, recall double, data binary"


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("id").reset_index(drop=True)
    # copies under whatever source_id share the node of the smallest id; source_ids have a list of their own
    bare = [bytes(8) + f[8:] for f in pdf["feat"]]
    node, first = pd.factorize(np.array([f + t for f, t in zip(bare, pdf["bits"])], object))
    keep = np.unique(node, return_index=True)[1]
    ids = pdf["id"].to_numpy(np.int64)
    sid = np.frombuffer(b"".join(f[:8] for f in pdf["feat"]), np.int64)
    # of copies with one source_id the smallest id stands for all
    order = np.lexsort((ids, node, sid))
    order = order[sid[order] != 0]
    s, k = sid[order], node[order]
    order = order[np.concatenate(([True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])))] if len(order) else order
    vec = np.frombuffer(b"".join(pdf["vec"][keep]), np.float32).reshape(-1, DIM)
    feat = np.frombuffer(b"".join(bare[i] for i in keep), np.int64).reshape(-1, len(FEATS))
    bits = np.frombuffer(b"".join(pdf["bits"][keep]), np.int64).reshape(-1, 20)
    graph = SPAN * BEAM < len(vec)
    links = build_graph(vec, 17) if graph else np.full((len(vec), NEAR + BACK + FAR), -1, np.int32)
    probes = [p for p in pdf["probe"] if p is not None]
    beam, recall = tuned_beam(vec, links, np.frombuffer(b"".join(probes), np.float32).reshape(-1, DIM), _entries(len(vec)), SPAN) if graph else (len(vec), 1.0)
    data = _pack(ids[keep], vec, feat, bits, links, (sid[order], ids[order], node[order]))
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "n": [len(pdf)], "beam": [beam], "probes": [len(probes)], "recall": [recall], "data": [data]})


# --- exact comparison ------------------------------------------------------------------------------------------------


def _bitcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).sum(axis=-1).astype(np.float64)


def same_paper(fa, ba, fb, bb) -> np.ndarray:
    """Score of each pair (rows of the arrays): 0 and more means one paper."""
    def eq(i):
        a, b = fa[:, i], fb[:, i]
        known = (a != 0) & (b != 0)
        return known & (a == b), known & (a != b)

    sid, sid_no = eq(0)
    doi, doi_no = eq(1)
    jou, jou_no = eq(2)
    vol, vol_no = eq(3)
    num, num_no = eq(4)
    first, first_no = eq(5)
    last, last_no = eq(6)
    tag_no = fa[:, 7] != fb[:, 7]
    titled = fa[:, 8] & fb[:, 8]
    dice = []
    for k, flag in ((slice(0, 8), 1), (slice(8, 16), 2)):
        both = _bitcount(np.ascontiguousarray(ba[:, k] & bb[:, k]))
        total = _bitcount(np.ascontiguousarray(ba[:, k])) + _bitcount(np.ascontiguousarray(bb[:, k]))
        dice.append(np.where(titled & flag, 2 * both / np.maximum(total, 1), -1.0))
    title = np.maximum(dice[0], dice[1])
    na, nb = np.ascontiguousarray(ba[:, 16:]), np.ascontiguousarray(bb[:, 16:])
    least = np.minimum(_bitcount(na), _bitcount(nb))
    names = np.where(least > 0, _bitcount(na & nb) / np.maximum(least, 1), -1.0)
    s = np.full(len(fa), -5.0)
    s += 3.0 * (title >= 0.85) + 1.5 * ((title >= 0.7) & (title < 0.85)) - 4.0 * ((title >= 0) & (title < 0.55))
    s += 2.0 * first - 2.5 * first_no + 1.5 * last - 2.0 * last_no
    s += 1.0 * jou - 2.0 * jou_no + 0.5 * vol - 2.0 * vol_no + 0.5 * num - 1.5 * num_no
    s += 1.5 * (names >= 0.75) - 2.0 * ((names >= 0) & (names < 0.35))
    s += 1.5 * doi - 1.0 * doi_no
    s += 8.0 * sid
    # parts, corrections, discussions and other years' issues are different papers
    return np.where(tag_no & ~sid & ((titled > 0) | (fa[:, 7] != 0)), np.where((title < 0) & first & last & (vol | jou), s - 1.0, -9.0), s)


class Lists:
    """The nodes that could be a query's paper, whatever their titles and names: exact, as titles and names count at their best.

    What a node loses where its known values differ from the query's depends on which fields the query knows, and is summed up once for each such
    choice; what it gains where they are equal is added along the list of the nodes that have the value.
    """

    FIELDS = ((0, 8.0, 0.0), (1, 1.5, 1.0), (2, 1.0, 2.0), (3, 0.5, 2.0), (4, 0.5, 1.5), (5, 2.0, 2.5), (6, 1.5, 2.0))  # as in same_paper: feature, equal, different

    def __init__(self, feat: np.ndarray, bits: np.ndarray):
        self.order = [np.argsort(feat[:, f], kind="stable").astype(np.int32) for f, _, _ in self.FIELDS]
        self.value = [feat[o, f] for o, (f, _, _) in zip(self.order, self.FIELDS)]
        self.loss = [np.where(feat[:, f] != 0, np.float32(-d), np.float32(0)) for f, _, d in self.FIELDS]
        self.titled, self.named, self.bases = feat[:, 8], (bits[:, 16:] != 0).any(axis=1), {}

    def of(self, qf: np.ndarray, qb: np.ndarray):
        """Candidates of each query."""
        lo, hi = ([np.searchsorted(v, qf[:, f], side) for v, (f, _, _) in zip(self.value, self.FIELDS)] for side in ("left", "right"))
        named = (qb[:, 16:] != 0).any(axis=1)
        for k in range(len(qf)):
            known = [i for i, (f, _, _) in enumerate(self.FIELDS) if qf[k, f] != 0]
            key = (*known, -1, int(qf[k, 8]), bool(named[k]))
            if key not in self.bases:
                if len(self.bases) >= 64:
                    self.bases.clear()
                base = np.float32(-5) + 3 * ((self.titled & qf[k, 8]) != 0).astype(np.float32) + np.float32(1.5) * (self.named & named[k])
                self.bases[key] = sum((self.loss[i] for i in known), base.astype(np.float32))
            s = self.bases[key].copy()
            for i in known:
                s[self.order[i][lo[i][k] : hi[i][k]]] += np.float32(self.FIELDS[i][1] + self.FIELDS[i][2])
            yield np.flatnonzero(s >= 0)


def shard_matches(ids, x, feat, bits, links, beam: int, qid, qv, qf, qb, lists: Lists | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, node, score) of the nodes of smaller ids that are the query's paper.

    A query with a match in the worse half of a full beam is compared with all nodes, as more may lie beyond the beam.
    """
    if beam < len(x):
        mixed = ids.max() >= qid.min()
        got = beam_search(x, links, qv, beam, _entries(len(x)), ids, qid) if mixed else beam_search(x, links, qv, beam, _entries(len(x)))
    else:
        got = np.zeros((len(qid), 0), np.int64)
    r, c = np.nonzero(got >= 0)
    node = got[r, c]
    s = same_paper(qf[r], qb[r], feat[node], bits[node])
    crowded = np.full(len(qid), beam >= len(x))
    if beam < len(x):
        crowded[r[(s >= 0) & (c % beam >= beam // 2)]] = True
    ok = (s >= 0) & (ids[node] < qid[r]) & ~crowded[r]
    # a node may stand both in the beam and among the older ones
    _, one = np.unique(r[ok] * np.int64(len(x)) + node[ok], return_index=True)
    out = [(r[ok][one], node[ok][one], s[ok][one])]
    rows = np.flatnonzero(crowded)
    if len(rows):
        todo, size = [], 0
        for k, node in zip(rows, (lists or Lists(feat, bits)).of(qf[rows], qb[rows])):
            node = node[ids[node] < qid[k]]
            todo.append((np.full(len(node), k), node))
            size += len(node)
            if size > PAIRS or k == rows[-1]:
                r, node = (np.concatenate(v) for v in zip(*todo))
                s = same_paper(qf[r], qb[r], feat[node], bits[node])
                out.append((r[s >= 0], node[s >= 0], s[s >= 0]))
                todo, size = [], 0
    return tuple(np.concatenate(v) for v in zip(*out))


def source_matches(sids, feat, bits, qid, qf, qb, pairs: int = 1 << 18):
    """(query row, id, score), in parts, of the records of smaller ids that share a query's source_id and compare as one paper."""
    sid, sid_id, sid_node = sids
    lo, hi = np.searchsorted(sid, qf[:, 0], "left"), np.searchsorted(sid, qf[:, 0], "right")
    n = np.where(qf[:, 0] != 0, hi - lo, 0)
    at = 0
    while at < len(n):
        # as many queries as make up some pairs; one query of a hot source_id may make up more
        end = at + max(1, int(np.searchsorted(np.cumsum(n[at:]), pairs, "right")))
        m = n[at:end]
        r = np.repeat(np.arange(at, end), m)
        k = np.repeat(lo[at:end] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        ok = sid_id[k] < qid[r]
        r, k = r[ok], k[ok]
        if len(r):
            f = feat[sid_node[k]].copy()
            f[:, 0] = qf[r, 0]
            s = same_paper(qf[r], qb[r], f, bits[sid_node[k]])
            yield r[s >= 0], sid_id[k][s >= 0], s[s >= 0]
        at = end


LINKS = "new_id bigint, old_id bigint, score double"


class ShardedIndex:
    """Shards of history in a folder, appended batch by batch.  Searching reads the shards, never the records behind them."""

    def __init__(self, spark, path: str | None = None, shard_size: int = SHARD_SIZE, block: int = BLOCK):
        ensure_checkpoint_dir(spark)
        self.spark, self.size, self.block = spark, shard_size, block
        self.path = path or f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/index-{uuid.uuid4().hex}"
        self.files = Folder(spark, self.path)
        if self.files.names("manifests"):
            raise FileExistsError(f"{self.path} holds an index; open it")
        self.version, self.batches = 0, 0
        # parts: folders of records, folder of shards, records, shards; links and searched ids: folders
        self.parts: list[dict] = []
        self.links: list[str] = []
        self.searched: list[str] = []

    @classmethod
    def open(cls, spark, path: str) -> ShardedIndex:
        """The index as its last manifest says."""
        self = cls.__new__(cls)
        self.spark, self.path, self.files = spark, path, Folder(spark, path)
        names = self.files.names("manifests")
        if not names:
            raise FileNotFoundError(f"no index in {path}")
        m = json.loads(self.files.text(f"manifests/{names[-1]}"))
        for k in ("size", "block", "version", "batches", "parts", "links", "searched"):
            setattr(self, k, m[k])
        return self

    def _save(self) -> None:
        self.version += 1
        state = {k: getattr(self, k) for k in ("size", "block", "version", "batches", "parts", "links", "searched")}
        self.files.put_new(f"manifests/{self.version:09d}.json", json.dumps(state))

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _write(self, df: DataFrame, kind: str) -> str:
        folder = f"{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    def _build(self, records: list[str], n: int) -> dict:
        k, base = max(1, -(-n // self.size)), (self.version + 1) * 1_000_000
        keyed = self._read(records, ENCODED).withColumn("shard", F.lit(base) + F.pmod(F.xxhash64("id"), F.lit(k)))
        shards = self._write(keyed.groupBy("shard").applyInPandas(_shard, SHARD), "shards")
        return {"records": records, "shards": shards, "n": n, "base": base, "k": k}

    def add(self, encoded: DataFrame) -> tuple[str, int]:
        """Stores encoded records and their shards.  -> (folder of the records, how many)"""
        seen = Observation()
        folder = self._write(encoded.observe(seen, F.count(F.lit(1)).alias("n")), "records")
        n = seen.get["n"]
        if n:
            self.parts.append(self._build([folder], n))
        self._save()
        return folder, n

    def compact(self) -> None:
        """Merges the parts that are smaller than a shard and rebuilds their graphs."""
        small = [p for p in self.parts if p["n"] < self.size]
        if len(small) < 2:
            return
        merged = self._build([f for p in small for f in p["records"]], sum(p["n"] for p in small))
        self.parts = [p for p in self.parts if p not in small] + [merged]
        self._save()

    def recall(self) -> DataFrame:
        """shard, n, beam, probes, recall: what was measured when the shards were built."""
        return self._read([p["shards"] for p in self.parts], SHARD).drop("data")

    def records(self) -> DataFrame:
        return self._read([f for p in self.parts for f in p["records"]], ENCODED)

    def search(self, encoded: DataFrame, n: int, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
        """new_id, old_id (smaller), score: what the beams, the passes over crowded shards and the source_ids find and the exact comparison confirms."""
        if not self.parts:
            return self.spark.createDataFrame([], LINKS)
        shards, k = self._read([p["shards"] for p in self.parts], SHARD).select("shard", "beam", "data"), sum(p["k"] for p in self.parts)
        cast = n <= max_broadcast
        # a shard is read once, or by several tasks with a block of queries each where there are fewer shards than cores
        blocks = max(1, min(-(-n // self.block), 2 * self.spark.sparkContext.defaultParallelism // k) if cast else -(-n // self.block))
        q = encoded.withColumn("block", F.pmod(F.xxhash64("id", F.lit("q")), F.lit(blocks)).cast("int"))
        q = q.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("id", "vec", "feat", "bits"))).alias("qs"))
        if cast:
            of = lambda t: shards.withColumn("block", F.pmod("shard", F.lit(1)).cast("int") + t)
            pairs = of(0)
            for t in range(1, blocks):
                pairs = pairs.unionByName(of(t))
            pairs = pairs.join(F.broadcast(q), "block")
        else:
            every = F.array(*[F.lit(p["base"] + i) for p in self.parts for i in range(p["k"])])
            pairs = q.withColumn("shard", F.explode(every)).join(shards, "shard")

        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    # a shard is tens of MB: it is read in place
                    ids, x, feat, bits, links, sids = _unpack(b.column("data")[i].as_buffer())
                    qs, beam = b.column("qs")[i].as_py(), b.column("beam")[i].as_py()
                    qid = np.array([r["id"] for r in qs])
                    qv = np.frombuffer(b"".join(r["vec"] for r in qs), np.float32).reshape(-1, DIM)
                    qf = np.frombuffer(b"".join(r["feat"] for r in qs), np.int64).reshape(-1, len(FEATS))
                    qb = np.frombuffer(b"".join(r["bits"] for r in qs), np.int64).reshape(-1, 20)
                    lists = Lists(feat, bits)
                    for at in range(0, len(qv), 512):
                        part = slice(at, at + 512)
                        r, node, s = shard_matches(ids, x, feat, bits, links, beam, qid[part], qv[part], qf[part], qb[part], lists)
                        yield pa.RecordBatch.from_pydict({"new_id": pa.array(qid[part][r]), "old_id": pa.array(ids[node]), "score": pa.array(s)})
                    for r, old, s in source_matches(sids, feat, bits, qid, qf, qb):
                        yield pa.RecordBatch.from_pydict({"new_id": pa.array(qid[r]), "old_id": pa.array(old), "score": pa.array(s)})

        return pairs.select("qs", "beam", "data").mapInArrow(run, LINKS)

    def link(self, folder: str, n: int) -> None:
        """Searches the records of a folder and stores the links, and that they have been searched."""
        self.links.append(self._write(self.search(self._read([folder], ENCODED), n), "links"))
        self.searched.append(folder)
        self._save()

    def add_batch(self, batch: DataFrame) -> None:
        """Indexes a batch and links it to everything of smaller id; small shards are merged now and then."""
        self.batches += 1  # stored with what follows
        folder, n = self.add(encode(batch))
        if n:
            self.link(folder, n)
        if self.batches % COMPACT_EVERY == 0:
            self.compact()

    def follow(self) -> None:
        """Records that are hit but never were searched are searched too, then what they hit: each round reaches smaller ids."""
        while True:
            hit = self._read(self.links, LINKS).select(F.col("old_id").alias("id")).distinct().join(self._read(self.searched, "id bigint"), "id", "left_anti")
            seen = Observation()
            folder = self._write(self.records().join(hit, "id", "left_semi").observe(seen, F.count(F.lit(1)).alias("n")), "followed")
            if not seen.get["n"]:
                return
            self.link(folder, seen.get["n"])

    def first_ids(self) -> DataFrame:
        """first_id, new_id: the smallest id of the paper for every record that has been linked to a smaller one."""
        return first_ids(self._read(self.links, LINKS))


def accept(index: ShardedIndex, batch: DataFrame) -> DataFrame:
    """first_id, new_id for the records of a batch that repeat a known one; the batch is known afterwards.

    Reads the batch, the shards and the links found so far; of the records behind the shards those that are hit.
    """
    index.add_batch(batch)
    index.follow()
    ids = batch.select(F.col("id").cast("bigint").alias("new_id")).distinct()
    return index.first_ids().join(ids, "new_id", "left_semi").select("first_id", "new_id")


def first_ids(links: DataFrame, max_rounds: int = 30) -> DataFrame:
    """new_id -> first_id, the smallest id reached over older records; links always lead to smaller ids."""
    label = cut(links.groupBy("new_id").agg(F.min("old_id").alias("first_id")))
    for _ in range(max_rounds):
        up = label.select(F.col("new_id").alias("old_id"), F.col("first_id").alias("root"))
        new = links.join(up, "old_id", "left").groupBy("new_id").agg(F.min(F.coalesce("root", "old_id")).alias("first_id"))
        new = cut(new.join(label.withColumnRenamed("first_id", "was"), "new_id"))
        changed = new.filter("first_id < was").limit(1).count()
        label = new.select("new_id", "first_id")
        if not changed:
            return label
    raise ValueError("first_ids: labels still change; raise max_rounds")


def repeats(history: DataFrame, batches: DataFrame, shard_size: int = SHARD_SIZE, path: str | None = None) -> DataFrame:
    """first_id, new_id for the batch records that repeat a known one; the index stays in ``path``.

    Batches are taken in their order; each is indexed, then searched in all shards.  Null attributes are unknown; the id
    ``unknown`` is none; first_id is the smallest id reached over all records of the paper, those of the history too; empty batches and an empty history give no rows.
    """
    index = ShardedIndex(history.sparkSession, path, shard_size)
    index.add(encode(history))
    # how many batches there are is a matter of the schedule, not of the records
    for no in sorted((r["batch_no"] for r in batches.select("batch_no").distinct().collect()), key=lambda x: (x is None, x)):
        index.add_batch(batches.filter(F.col("batch_no").eqNullSafe(F.lit(no))))
    index.follow()
    ids = batches.select(F.col("id").cast("bigint").alias("new_id")).distinct()
    return index.first_ids().join(ids, "new_id", "left_semi").select("first_id", "new_id")
