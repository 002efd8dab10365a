"""Keyword predicates: spacing-free containment, proximity in any order, whole words."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import WS, fold

GAP, MAX_ORDERED = 16, 4
_SPACE = re.compile(r"\s+")


def quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def proximity_pattern(tokens: list[str], gap: int = GAP) -> str:
    """Pattern for all tokens in any order, each starting at most ``gap`` characters after the end of the one before.

    One lookahead chain per order, so tokens may overlap; the regex engine stops at the first that holds.  Tokens must differ.
    """
    chains = []
    for order in permutations(tokens):
        steps = [f"(?={quote(t)}).{{0,{len(t) + gap}}}" for t in order[:-1]]
        chains.append("".join(steps) + f"(?={quote(order[-1])})")
    return "(?s)(?:" + "|".join(chains) + ")"


def near_words(tokens: list[str], text: str, gap: int = GAP) -> bool:
    """The test of ``proximity_pattern`` on plain strings, for any number of tokens, which may recur (then at other places).

    Occurrences are taken in the order of the text; each keeps the sets of tokens that chains of small gaps ending in it have used.
    """
    need = Counter(tokens)
    names = list(need)
    spots = sorted((m.start(), k, m.start() + len(t)) for k, t in enumerate(names) for m in re.finditer(f"(?={re.escape(t)})", text))
    full = tuple(need[t] for t in names)
    none = (0,) * len(names)
    chains: list[tuple[int, set[tuple[int, ...]]]] = []
    for start, k, end in spots:
        before = {none}.union(*(c for e, c in chains if start - e <= gap))
        here = {(*c[:k], c[k] + 1, *c[k + 1 :]) for c in before if c[k] < full[k]}
        if full in here:
            return True
        chains.append((end, here))
    return False


def near_chain(tokens: list[str], text: Column, gap: int = GAP) -> Column:
    """The test of ``proximity_pattern`` for any number of different tokens (64 at most), as one pass over their occurrences.

    Occurrences are taken in the order of the text; each keeps, as bits, the sets of tokens that chains of small gaps ending in it have used.
    """
    if len(tokens) > 63:
        raise ValueError("more than 63 different words in one term")
    at = F.sequence(F.lit(1), F.length(text))

    def spots_of(k: int, t: str) -> Column:
        found = F.filter(at, lambda p: F.substr(text, p, F.lit(len(t))) == t)
        return F.transform(found, lambda p: F.struct(p.alias("p"), (p + len(t)).alias("e"), F.lit(1 << k).cast("bigint").alias("b")))

    spots = F.array_sort(F.flatten(F.array(*[spots_of(k, t) for k, t in enumerate(tokens)])))

    def step(acc, s):
        before = F.filter(acc, lambda c: (s["p"] - c["e"] <= gap) & (c["m"].bitwiseAND(s["b"]) == 0))
        masks = F.array_distinct(F.concat(F.array(s["b"]), F.transform(before, lambda c: c["m"].bitwiseOR(s["b"]))))
        return F.concat(acc, F.transform(masks, lambda m: F.struct(s["e"].alias("e"), m.alias("m"))))

    full = (1 << len(tokens)) - 1
    return F.aggregate(spots, F.array().cast("array<struct<e:int,m:bigint>>"), step, lambda acc: F.exists(acc, lambda c: c["m"] == full))


def keyword_in(keyword: str, text: Column, spaceless: Column, gap: int = GAP) -> Column:
    """text and spaceless are folded; the second is without white space.

    True where the keyword is contained when spacing is ignored, or where its words are near each other in any order.
    Substrings count: ``ai`` is in ``maintain``.
    """
    k = keyword.casefold()
    hit = spaceless.contains(_SPACE.sub("", k)) if k.strip() else F.lit(False)
    tokens = list(dict.fromkeys(k.split()))
    if len(tokens) > 1:
        present = F.lit(True)
        for t in tokens:
            present = present & text.contains(t)
        # the cheap test first: the others only run where all words are there; orders to try grow with the factorial, occurrences do not
        close = text.rlike(proximity_pattern(tokens, gap)) if len(tokens) <= MAX_ORDERED else near_chain(tokens, text, gap)
        hit = hit | F.when(present, close).otherwise(False)
    return hit


def word_in(term: str, text: Column) -> Column:
    """Whole-word containment: no ASCII letter or digit on either side."""
    return text.rlike(f"(?<![0-9a-z]){quote(term.casefold())}(?![0-9a-z])")


def any_of(terms, test) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | test(t)
    return out


def haystack(*cs) -> tuple[Column, Column]:
    """(folded text of all parts joined by a space, empty ones included; the same without white space)."""
    text = fold(F.concat_ws(" ", *[F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit("")) for c in cs]))
    return text, F.regexp_replace(text, WS, "")
