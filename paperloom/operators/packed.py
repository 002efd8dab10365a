"""Split fields that pack several values behind inconsistent delimiters.

Model.  A text is a run of atoms divided by possible delimiters.  Every span of atoms is an edge of a
lattice; a parse is a path.  An edge costs -log of the frequency of its value over the whole column,
an atom boundary -log of how likely a delimiter of that kind is to divide, given the text's main
delimiter.  A value that is not known has the base measure, BASE with INNER for each further atom; as that weight adds up
atom by atom, the edges of unknown spans of any length are one state of the lattice ("within an unknown value"), and no span is
left out.  Expectation-maximisation learns the value frequencies: the first E-step divides each text
at its main delimiter, later ones take the forward-backward posteriors of the lattice.  The rows come
from the Viterbi path.  Quoted spans are atomic.  A value counts as known if it occurs beside the text at hand, so one that was
counted once is not.

Scale.  Every E-step is one pass of map-side dictionaries and a partial/final sum.  The frequencies that
go back to the executors are those of at least ``floor`` of all values, so there are at most 1/floor of
them (200,000) however large the column is.  No text, atom or span is dropped: values rarer than the floor score
with the base measure, as any unseen value does.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut

DELIMS = ",;|/·、，；\n\t#・‧ㆍ"
# Words that label a keyword list.
LABELS = ("주제어", "핵심어", "키워드", "중심어", "색인어", "keywords", "keyword", "key words", "key word", "index terms")
LABEL = re.compile(
    r"\s*(?:[\[(<【]\s*(?:%(w)s)\s*[\])>】]\s*[:：]?|(?:%(w)s)(?:\s*[:：]|\s+[-–—]\s))\s*" % {"w": "|".join(LABELS)}, re.IGNORECASE
)
ENUM = re.compile(r"(?:(?<=\s)|^|(?<=[,;|/·、，；#]))(?:\((\d{1,3})\)|(\d{1,3})[.)])(?=\s*\S)")
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "「": "」", "『": "』", "«": "»"}
AFTER_QUOTE = re.compile(r"\s*(?:$|[%s])" % DELIMS)
SEP = re.compile(r"\s*[%s](?:\s*[%s])*\s*" % (DELIMS, DELIMS))
BASE, INNER = math.log(1e-6), math.log(1e-2)  # an unseen value; each further atom of an unseen value
SAME_IN, OTHER_OUT = math.log(1e-4), math.log(0.1)
# how readily a delimiter other than the main one lies within a value: commas, slashes and dots do in names and terms, others hardly
OTHER_IN = {",": math.log(0.5), "/": math.log(0.5), "·": math.log(0.5)}
RARE_IN = math.log(1e-3)
FLOOR = 5e-6
NEVER, TIE = float("-inf"), 1e-9


def _kind(sep: str) -> str:
    for c in sep:
        if c in DELIMS:
            return {"，": ",", "；": ";", "・": "·", "‧": "·", "ㆍ": "·"}.get(c, c)
    return "1"


def _enumerators(text: str) -> list[tuple[int, int]]:
    """Spans of list numbers if they count 1, 2, 3, … from the start of the text; else none."""
    found, want = [], 1
    for m in ENUM.finditer(text):
        if int(m[1] or m[2]) == want and (want > 1 or m.start() == 0):
            found.append(m.span())
            want += 1
        elif want == 1:
            return []
    return found


def atoms(text: str) -> tuple[list[str], list[tuple[int, int]], list[str]]:
    """The text without label and end mark, the atoms' spans, and the kind of each delimiter between them."""
    text = text.strip()
    m = LABEL.match(text)
    if m:
        text = text[m.end() :].strip()
    if text.endswith((".", "。")) and not re.search(r"(?:^|[\s.])[A-Za-z]\.$", text):
        text = text[:-1].rstrip()
    cuts = [(a, b, "1") for a, b in _enumerators(text)]
    quoted: list[tuple[int, int]] = []
    i, start = 0, True
    if any(q in text for q in QUOTES):
        while i < len(text):
            c = text[i]
            if start and c in QUOTES:
                end = text.find(QUOTES[c], i + 1)
                while end > 0 and not AFTER_QUOTE.match(text, end + 1):
                    end = text.find(QUOTES[c], end + 1)
                if end > 0:
                    quoted.append((i, end + 1))
                    i, start = end + 1, False
                    continue
            start = c in DELIMS or (start and c.isspace())
            i += 1
    for m in SEP.finditer(text):
        a, b = m.span()
        if not any(x < b and a < y for x, y in quoted):
            cuts.append((a, b, _kind(m[0])))
        else:  # a run that touches a quote: only what lies outside of it
            for x, y in quoted:
                if a < x < b:
                    cuts.append((a, x, _kind(m[0])))
                elif x < a < y < b:
                    cuts.append((y, b, _kind(text[y:b])))
    cuts.sort()
    spans, kinds, at, pending = [], [], 0, None
    for a, b, k in [*cuts, (len(text), len(text), "")]:
        x, y = at, max(at, a)
        while x < y and text[x].isspace():
            x += 1
        while y > x and text[y - 1].isspace():
            y -= 1
        if y > x:
            if spans:
                kinds.append(pending or k)
            spans.append((x, y))
            pending = None
        pending = k if pending is None or pending == "" else ("1" if "1" in (pending, k) else pending)
        at = max(at, b)
    return text, spans, kinds


def _unquote(v: str) -> str:
    while len(v) > 1 and v[0] in QUOTES and v[-1] == QUOTES[v[0]]:
        q = v[0]
        v = v[1:-1].strip()
        if q in "\"'" and q + q in v:  # a doubled quote inside quotes stands for one
            return v.replace(q + q, q)
    return v


def _key(v: str) -> str:
    return " ".join(_unquote(v).casefold().split())


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))"""
    if x < y:
        x, y = y, x
    return x if y == NEVER else x + math.log1p(math.exp(y - x))


class Splitter:
    """Scores and parses texts with the frequencies of one E-step."""

    def __init__(self, counts: dict[str, float], total: float):
        self.logp = {v: math.log(c / total) for v, c in counts.items() if c > 0}
        self.heads: dict[str, int] = {}  # first atoms of known values that hold delimiters: the number of atoms
        for v in self.logp:
            if any(d in v for d in DELIMS):
                _, spans, _ = atoms(v)
                if len(spans) > 1:
                    h = v[spans[0][0] : spans[0][1]]
                    self.heads[h] = max(self.heads.get(h, 0), len(spans))

    def _lattice(self, text, spans, kinds):
        """Log weights of a boundary after each atom and of none; for each end its edges of known values: (start, value, log weight)."""
        n = len(spans)
        main = max(set(kinds), key=lambda k: (sum(x == k for x in kinds), k)) if kinds else ""
        out = [*(0.0 if k in (main, "1") else OTHER_OUT for k in kinds), 0.0]
        join = [NEVER if k == "1" else INNER + (SAME_IN if k == main else OTHER_IN.get(k, RARE_IN)) for k in kinds]
        known: list[list[tuple[int, str, float]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            head = _key(text[spans[i][0] : spans[i][1]])
            w = 0.0
            for j in range(i, min(n, i + max(1, self.heads.get(head, 1)))):
                if j > i:
                    if kinds[j - 1] == "1":
                        break
                    w += join[j - 1] - INNER
                v = head if j == i else _key(text[spans[i][0] : spans[j][1]])
                if v in self.logp:
                    known[j + 1].append((i, v, w + self.logp[v]))
        return out, join, known

    def posteriors(self, text, spans, kinds) -> list[tuple[str, float]]:
        """Values and the probabilities of their spans, those above 1e-3."""
        n = len(spans)
        if n == 1:
            return [(_key(text[spans[0][0] : spans[0][1]]), 1.0)]
        out, join, known = self._lattice(text, spans, kinds)
        f, opened = [0.0] + [NEVER] * n, [NEVER] * (n + 1)  # opened: within an unknown value, its last atom so far before t
        for t in range(1, n + 1):
            opened[t] = _add(f[t - 1] + BASE, opened[t - 1] + join[t - 2] if t > 1 else NEVER)
            total = opened[t]
            for i, _, w in known[t]:
                total = _add(total, f[i] + w)
            f[t] = total + out[t - 1]
        b, closing = [NEVER] * n + [0.0], [NEVER] * (n + 2)  # closing: from within an unknown value to the end
        for t in range(n, 0, -1):
            closing[t] = _add(out[t - 1] + b[t], join[t - 1] + closing[t + 1] if t < n else NEVER)
            for i, _, w in known[t]:
                b[i] = _add(b[i], w + out[t - 1] + b[t])
            # all known values from t - 1 on have been met: they end at t or later
            b[t - 1] = _add(b[t - 1], BASE + closing[t])
        z, found = f[n], []
        for t in range(1, n + 1):
            found += [(v, p) for i, v, w in known[t] if (p := math.exp(f[i] + w + out[t - 1] + b[t] - z)) > 1e-3]
        for i in range(n):
            w, j = f[i] + BASE - z, i + 1
            while math.exp(w + closing[j]) > 1e-3:  # what all longer spans from here have together
                if (p := math.exp(w + out[j - 1] + b[j])) > 1e-3:
                    found.append((_key(text[spans[i][0] : spans[j - 1][1]]), p))
                if j == n:
                    break
                w += join[j - 1]
                j += 1
        return found

    def viterbi(self, text, spans, kinds) -> list[str]:
        n = len(spans)
        out, join, known = self._lattice(text, spans, kinds)
        best, back = [0.0] + [NEVER] * n, [0] * (n + 1)
        opened, since = NEVER, 0
        for t in range(1, n + 1):
            start, more = best[t - 1] + BASE, opened + join[t - 2] if t > 1 else NEVER
            opened, since = (more, since) if more > start + TIE else (start, t - 1)
            top, at = opened, since
            for i, _, w in known[t]:
                if best[i] + w > top + TIE or (best[i] + w > top - TIE and i > at):
                    top, at = best[i] + w, i
            best[t], back[t] = top + out[t - 1], at
        cuts, j = [], n
        while j:
            cuts.append(text[spans[back[j]][0] : spans[j - 1][1]])
            j = back[j]
        return cuts[::-1]


def _by_main(text, spans, kinds) -> list[str]:
    if not kinds:
        return [text[a:b] for a, b in spans]
    main = max(set(kinds), key=lambda k: (sum(x == k for x in kinds), k))
    out, at = [], 0
    for i, k in enumerate(kinds):
        if k in (main, "1"):
            out.append(text[spans[at][0] : spans[i][1]])
            at = i + 1
    return [*out, text[spans[at][0] : spans[-1][1]]]


def _count_batches(batches: Iterator[pa.RecordBatch], splitter) -> Iterator[pa.RecordBatch]:
    s = splitter.value if splitter is not None else None
    sums: dict[str, float] = defaultdict(float)
    for b in batches:
        for t in b.column(0).to_pylist():
            text, spans, kinds = atoms(t)
            if not spans:
                continue
            if s is None:
                for v in _by_main(text, spans, kinds):
                    sums[_key(v)] += 1.0
            else:
                for v, p in s.posteriors(text, spans, kinds):
                    sums[v] += p
        if len(sums) > 100_000:
            yield pa.RecordBatch.from_pydict({"value": list(sums), "n": list(sums.values())})
            sums.clear()
    if sums:
        yield pa.RecordBatch.from_pydict({"value": list(sums), "n": list(sums.values())})


def learn_splitter(texts: DataFrame, iterations: int = 2, floor: float = FLOOR) -> Splitter:
    """EM over a one-column table of texts. iterations: E-steps, the first being the hard one."""
    sc = texts.sparkSession.sparkContext
    b, s = None, None
    for _ in range(max(1, iterations)):
        it = texts.mapInArrow(lambda bs, b=b: _count_batches(bs, b), "value string, n double")
        sums = cut(it.groupBy("value").agg(F.sum("n").alias("n")).filter("value <> ''"))
        t = sums.agg(F.sum("n")).first()[0] or 1.0
        pdf = sums.filter((F.col("n") >= 1.5) & (F.col("n") >= floor * t)).toPandas()  # at most 1/floor rows: each is at least that share of the total
        s = Splitter(dict(zip(pdf["value"], pdf["n"])), t)
        b = sc.broadcast(s)
    return s


def split_packed(
    df: DataFrame, id_col: str, fields: list[str], iterations: int = 2, floor: float = FLOOR
) -> DataFrame:
    """One row per value: id, field, pos (from 1, in the order of the text), keyword.

    Null and blank texts give no rows, repeated values are kept, empty ones never come out, ties between
    parses go to the one with the shorter last value, an empty table gives an empty table, and columns other than
    the id and the fields are not read.  A text of any length is parsed whole.
    """
    long = None
    for f in fields:
        part = df.select(
            F.col(f"`{id_col}`").alias("id_"), F.lit(f).alias("field_"), F.col(f"`{f}`").cast("string").alias("text_")
        )
        long = part if long is None else long.unionByName(part)
    long = long.filter(F.col("text_").rlike(r"[^\s\x{a0}\x{3000}]"))
    # copies of one text are one witness: else a pair of values that is copied often would look like one value
    s = learn_splitter(long.select("text_").distinct(), iterations, floor)
    b = df.sparkSession.sparkContext.broadcast(s)
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        sp = b.value
        for batch in batches:
            ids, fs, ts = (batch.column(k).to_pylist() for k in range(3))
            o_id, o_f, o_p, o_k = [], [], [], []
            for i, f, t in zip(ids, fs, ts):
                text, spans, kinds = atoms(t)
                pos = 0
                for v in sp.viterbi(text, spans, kinds) if spans else ():
                    v = _unquote(v.strip()).strip()
                    if v:
                        pos += 1
                        o_id.append(i)
                        o_f.append(f)
                        o_p.append(pos)
                        o_k.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(o_id, batch.schema.field(0).type), pa.array(o_f, pa.string()), pa.array(o_p, pa.int32()), pa.array(o_k, pa.string())],
                names=[id_col, "field", "pos", "keyword"],
            )

    return long.mapInArrow(run, f"`{id_col}` {id_type}, field string, pos int, keyword string")
