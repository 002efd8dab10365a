"""Fill containers of fixed capacity with texts, with little unused space.

Texts longer than the capacity are cut into full containers and a rest; nothing else is cut.  What remains is packed by bin
completion: the largest text left opens a container, and the undominated fillings of the space around it are the branches.  A
filling is dominated if a text left out could take the place of some of its texts and leave less space.  A branch ends when its
waste rules out fewer containers than the incumbent has; the first incumbent is the best-fit-decreasing packing.  The search
goes back over its choices until it meets the lower bound (the sum of sizes over the capacity), has tried every branch, or has
opened its budget of containers, so it always returns a complete packing; ``bin_completion`` also says whether that is proven best.

Scale.  Texts are dealt by hash into groups of about GROUP items (merged per capacity), each packed in its own task; the waste of
dealing is at most one container per group.  Only ids and sizes are shuffled.  Equal sizes are one entry with a count, so a group of
many equal texts is as cheap as one of few.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import bounded_rows, cut

GROUP, MAX_SPECS = 2000, 1000
# What a search may spend on a group (bin packing is NP-hard): steps on the fillings of one container, fillings kept of it, and
# containers opened, REOPEN + REPEAT times those of the incumbent.
FILL_STEPS, FILLINGS, REOPEN, REPEAT = 800, 6, 200, 2


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: lists of item numbers."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    free: list[tuple[int, int]] = []  # (space, container), sorted
    out: list[list[int]] = []
    for i in order:
        k = bisect.bisect_left(free, (sizes[i], -1))
        if k == len(free):
            out.append([i])
            space, c = capacity - sizes[i], len(out) - 1
        else:
            space, c = free.pop(k)
            out[c].append(i)
            space -= sizes[i]
        bisect.insort(free, (space, c))
    return out


def _dominated(chosen: list[tuple[int, int]], waste: int, left_out: list[int]) -> bool:
    """Whether a size left out fits where texts of the filling (together no larger) were, leaving less space."""
    if not waste:
        return False
    if left_out and left_out[-1] <= waste:
        return True
    sums = 1  # bit t: some of the chosen texts have t tokens together
    for v, k in chosen:
        take, unit = k, 1
        while take > 0:  # k equal texts as powers of two
            unit = min(unit, take)
            sums |= sums << (v * unit)
            take -= unit
            unit *= 2
    window = (1 << waste) - 1
    return any((sums >> (x - waste)) & window for x in left_out)


def fillings(values: list[int], counts: dict[int, int], space: int, worst: int, want: int = FILLINGS, steps: int = FILL_STEPS) -> tuple[list[tuple[int, list[tuple[int, int]]]], bool]:
    """Undominated fillings of a space with a waste of at most ``worst``: ([(waste, [(size, how many)])], all of them?).

    values: the sizes that are there, ascending; the least waste comes first, at most ``want`` are kept.  Large sizes and many of
    them are tried first; a branch that can't use up the space to within ``worst`` is left.  Stops at the first perfect filling if one is wanted.
    """
    desc = [v for v in reversed(values) if v <= space]
    rest = [0] * (len(desc) + 1)  # what all sizes from here on hold
    for i in range(len(desc) - 1, -1, -1):
        rest[i] = rest[i + 1] + desc[i] * counts[desc[i]]
    neg = [-v for v in desc]
    best: list[tuple[int, list[tuple[int, int]]]] = []
    chosen: list[tuple[int, int]] = []
    frames: list[list[int]] = []  # index of the size, how many are taken, space before

    def enter(i: int, left: int) -> None:
        """Goes down from size i on, taking as many as fit, until nothing fits; then the filling is judged."""
        nonlocal worst
        while True:
            i = max(i, bisect.bisect_left(neg, -left))
            if left - rest[i] > worst:
                return
            if i == len(desc):
                break
            v = desc[i]
            k = min(counts[v], left // v)
            frames.append([i, k, left])
            chosen.append((v, k))
            left -= k * v
            i += 1
        have = dict(chosen)
        fill = [c for c in chosen if c[1]]
        if not _dominated(fill, left, [v for v in desc if counts[v] > have.get(v, 0)]):
            bisect.insort(best, (left, fill), key=lambda x: x[0])
            if len(best) > want:
                best.pop()
            if len(best) == want:
                worst = min(worst, best[-1][0] - 1)

    enter(0, space)
    while frames and worst >= 0 and steps > 0:
        i, k, left = frames[-1]
        chosen.pop()
        if not k:
            frames.pop()
            continue
        steps -= 1
        frames[-1][1] = k - 1
        chosen.append((desc[i], k - 1))
        enter(i + 1, left - (k - 1) * desc[i])
    return best, not frames and len(best) < want


def bin_completion(sizes: list[int], capacity: int) -> tuple[list[list[int]], bool]:
    """(packing of items that each fit, every item in exactly one container; whether no packing has fewer containers)."""
    incumbent = best_fit(sizes, capacity)
    bound = -(-sum(sizes) // capacity)
    if len(incumbent) <= bound:
        return incumbent, True
    counts: dict[int, int] = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    values = sorted(counts)

    def take(v: int, k: int) -> None:
        counts[v] -= k
        if not counts[v]:
            del values[bisect.bisect_left(values, v)]

    def give(v: int, k: int) -> None:
        if not counts[v]:
            bisect.insort(values, v)
        counts[v] += k

    # containers opened on the way down: its largest text, fillings still to try, the one in use, waste before
    path: list[list] = []
    budget = REOPEN + REPEAT * len(incumbent)
    waste, whole, allowed = 0, True, (len(incumbent) - 1) * capacity - sum(sizes)

    def descend() -> list[list[int]] | None:
        """Opens containers down from here; a complete packing, or None at a dead end."""
        nonlocal waste, whole, budget
        while values:
            if budget <= 0:
                whole = False
                return None
            budget -= 1
            top = values[-1]
            take(top, 1)
            first, complete = fillings(values, counts, capacity - top, allowed - waste, want=1)
            if not first:
                whole = whole and complete
                give(top, 1)
                return None
            w, fill = first[0]
            path.append([top, None, fill, waste])  # the other fillings are enumerated when the search comes back here
            for v, k in fill:
                take(v, k)
            # the last container's space is no waste yet: the bound counts it
            waste += w
        return [[t, *(v for v, k in fill for _ in range(k))] for t, _, fill, _ in path]

    found = descend()
    while True:
        if found is not None and len(found) < len(incumbent):
            where: dict[int, list[int]] = {}
            for i, s in enumerate(sizes):
                where.setdefault(s, []).append(i)
            incumbent = [[where[s].pop() for s in c] for c in found]
            allowed = (len(incumbent) - 1) * capacity - sum(sizes)
            if len(incumbent) <= bound:
                return incumbent, True
        if budget <= 0:
            return incumbent, False
        # back to the last container with another filling to try
        while path:
            top, options, fill, before = path[-1]
            for v, k in fill:
                give(v, k)
            waste = before
            if options is None:
                options, complete = fillings(values, counts, capacity - top, allowed - waste)
                whole = whole and complete
                options = path[-1][1] = [o for o in options if o[1] != fill]
            if options and before + options[0][0] <= allowed:
                w, fill = options.pop(0)
                path[-1][2] = fill
                for v, k in fill:
                    take(v, k)
                waste += w
                break
            path.pop()
            give(top, 1)
        if not path:
            return incumbent, whole
        found = descend()


def pack(docs: DataFrame, specs: DataFrame, size: str = "n_tokens", id_col: str = "doc_id", group: int = GROUP) -> DataFrame:
    """spec_id, container_id, doc_id, piece_no, start_token, n_tokens.

    Empty texts need no room and get no row; null or non-positive capacities give no containers; repeated texts are packed
    as often as they occur; equal sizes are taken in the order of their ids.
    """
    items = cut(docs.filter(F.col(size) > 0).select(F.col(id_col).cast("bigint").alias("id"), F.col(size).cast("bigint").alias("size")))
    n = items.count()
    groups = max(1, round(n / group))
    caps = bounded_rows(specs.filter("capacity_tokens > 0").select("spec_id", F.col("capacity_tokens").cast("bigint").alias("cap")), MAX_SPECS, "container specs")
    types = dict(specs.dtypes)
    kind = f"array<struct<spec_id:{types['spec_id']},cap:bigint>>"
    every = F.array(*[F.struct(F.lit(r["spec_id"]).alias("spec_id"), F.lit(r["cap"]).alias("cap")) for r in caps]).cast(kind)
    # every item is stated once for each spec
    x = items.select("id", "size", F.inline(every))
    pieces = x.withColumn("piece", F.explode(F.when(F.col("size") > F.col("cap"), F.sequence(F.lit(0), F.expr("cast((size - 1) div cap as int)"))).otherwise(F.array(F.lit(0)))))
    pieces = pieces.select("spec_id", "cap", "id", "piece", (F.col("piece") * F.col("cap")).alias("start"), F.least("cap", F.col("size") - F.col("piece") * F.col("cap")).alias("n"))
    full = pieces.filter("n = cap").select(
        "spec_id", F.concat_ws("-", "spec_id", F.lit("f"), "id", "piece").alias("container_id"), F.col("id").alias("doc_id"), F.col("piece").alias("piece_no"), F.col("start").alias("start_token"), F.col("n").alias("n_tokens"))

    def fill(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "piece"]).reset_index(drop=True)
        c, _ = bin_completion([int(v) for v in pdf["n"]], int(pdf["cap"].iloc[0]))
        no = [0] * len(pdf)
        for k, members in enumerate(c):
            for i in members:
                no[i] = k
        return pd.DataFrame({
            "spec_id": pdf["spec_id"], "container_id": [f"{key[0]}-{key[1]}-{k}" for k in no], "doc_id": pdf["id"],
            "piece_no": pdf["piece"], "start_token": pdf["start"], "n_tokens": pdf["n"]})

    rest = pieces.filter("n < cap").withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)))
    packed = rest.groupBy("spec_id", "grp").applyInPandas(fill, f"spec_id {types['spec_id']}, container_id string, doc_id bigint, piece_no int, start_token bigint, n_tokens bigint")
    return full.unionByName(packed)


def usage(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """spec_id, containers, least (no packing can have fewer), tokens, unused_share."""
    by = packed.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("t")).groupBy("spec_id").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    cap = F.col("capacity_tokens")
    return by.join(specs.select("spec_id", "capacity_tokens"), "spec_id").select(
        "spec_id", "containers", F.ceil(F.col("tokens") / cap).cast("bigint").alias("least"), "tokens", (1 - F.col("tokens") / (F.col("containers") * cap)).alias("unused_share"))
