"""Pieces of DuckDB SQL that say what the text expressions say."""

from __future__ import annotations

from itertools import permutations

from paperloom.functions.text import FOLDS, LEGAL_FORMS, LEGAL_MARKS
from paperloom.plans.rules import RuleSet

WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold(x: str) -> str:
    out = f"lower({x})"
    for k, v in FOLDS.items():
        out = f"replace({out}, {q(k)}, {q(v)})"
    return out


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def no_space(x: str) -> str:
    return f"regexp_replace({x}, '{WS}', '', 'g')"


def title_key(x: str) -> str:
    return f"nullif({fold(rf'''regexp_replace({x}, '[^\p{{L}}\p{{N}}_]+', '', 'g')''')}, '')"


def distinct_folded(a: str) -> str:
    return f"list_filter({a}, lambda x, i: list_position(list_transform({a}, lambda y: {fold('y')}), {fold('x')}) = i)"


def split_keywords(x: str) -> str:
    parts = f"list_filter(list_transform(string_split(regexp_replace({x}, '[;|,\\n\\t]', chr(1), 'g'), chr(1)), lambda k: {strip('k')}), lambda k: k <> '')"
    return distinct_folded(parts)


def keyword_in(keyword: str, text: str, ns: str, gap: int = 16) -> str:
    k = keyword.casefold()
    out = f"contains({ns}, {q(''.join(k.split()))})"
    tokens = list(dict.fromkeys(k.split()))
    if len(tokens) > 1:
        pats = "|".join(f".{{0,{gap}}}".join(o) for o in permutations(tokens))
        out += f" OR regexp_matches({text}, {q('(?s)' + pats)})"
    return f"coalesce({out}, false)"


def word_in(term: str, text: str) -> str:
    return f"regexp_matches({text}, {q('(^|[^0-9a-z])' + term.casefold() + '($|[^0-9a-z])')})"


def any_of(tests: list[str]) -> str:
    return "(" + " OR ".join(tests) + ")" if tests else "false"


def simple_org(x: str) -> str:
    out = fold(x)
    for w in (*LEGAL_FORMS, *LEGAL_MARKS):
        out = f"replace({out}, {q(w)}, '')"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}]', '', 'g')"


def org_variants(x: str) -> str:
    whole = squeeze(f"coalesce({x}, '')")
    bare = squeeze(rf"regexp_replace({whole}, '\([^)]*\)', ' ', 'g')")
    inner = rf"list_transform(regexp_extract_all({whole}, '\(([^)]*)\)', 1), lambda p: {strip('''regexp_replace(''' + squeeze('p') + ''', '^(?:구\\.|구 |전\\.|전 |현\\.|현 )', '')''')})"
    return f"list_distinct(list_filter(list_transform(list_concat([{whole}, {bare}], {inner}), lambda n: {simple_org('n')}), lambda n: n <> ''))"


def field_texts(t: str) -> str:
    """SELECT of t.* with f_title, f_keyword, f_abstract and their forms without white space."""
    parts = lambda names: ", ".join(f"nullif({n}, '')" for n in names)
    title = parts(("title", "title_kor", "title_eng", "title_other"))
    kw = parts(("keyword_text_kor", "keyword_text_eng", "keyword_text_other")) + ", nullif(array_to_string(keywords, ' '), '')"
    ab = parts(("abstract", "abstract_kor", "abstract_eng", "abstract_other"))
    return f"""SELECT *, {no_space('f_title')} AS n_title, {no_space('f_keyword')} AS n_keyword, {no_space('f_abstract')} AS n_abstract,
      concat(f_title, ' ', f_keyword, ' ', f_abstract) AS c_all, {no_space("concat(f_title, ' ', f_keyword, ' ', f_abstract)")} AS c_ns
      FROM (SELECT * EXCLUDE (categories, matched_keywords, relevance_reasons, relevance_score, is_relevant), {fold(f'concat_ws(chr(32), {title})')} AS f_title, {fold(f'concat_ws(chr(32), {kw})')} AS f_keyword, {fold(f'concat_ws(chr(32), {ab})')} AS f_abstract FROM {t})"""


def classified(t: str, rules: RuleSet) -> str:
    """SELECT ord, categories, matched_keywords, relevance_reasons (joined), score, is_relevant, match_field."""
    def hits(f):
        cases = []
        for i, r in enumerate(rules.rules):
            test = keyword_in(r.keyword, f"f_{f}", f"n_{f}")
            if r.anchors:
                test = f"({any_of([keyword_in(a, 'c_all', 'c_ns') for a in r.anchors])} AND {test})"
            cases.append(f"CASE WHEN f_{f} <> '' AND {test} THEN {i} END")
        return f"list_filter([{', '.join(cases)}], lambda h: h IS NOT NULL)"

    table = lambda g: "[" + ", ".join(q(g(r)) for r in rules.rules) + "]"
    outs = f"list_filter([{', '.join(f'CASE WHEN {word_in(e, chr(99) + chr(95) + chr(97) + chr(108) + chr(108))} THEN {q(e)} END' for e in rules.excludes)}], lambda h: h IS NOT NULL)"
    pick = lambda arr: f"list_transform(won, lambda i: ({arr})[i + 1])"
    cats, kws, modes = pick(table(lambda r: r.category)), pick(table(lambda r: r.keyword)), table(lambda r: r.mode)
    why = f"flatten(list_transform(won, lambda i: [match_field || ':' || ({table(lambda r: r.keyword)})[i + 1], 'category:' || ({table(lambda r: r.category)})[i + 1], 'mode:' || ({modes})[i + 1]]))"
    return f"""
    SELECT *, array_to_string({distinct_folded('cats')}, '|') AS categories, array_to_string({distinct_folded('kws')}, '|') AS matched_keywords,
      array_to_string(list_concat(CASE WHEN match_field IS NULL THEN [] ELSE ['matched_in:' || match_field] END, why, list_transform(outs, lambda o: 'exclude:' || o)), '|') AS relevance_reasons,
      cast(len({distinct_folded('kws')}) - len(outs) AS DOUBLE) AS relevance_score, (match_field IS NOT NULL AND len(outs) = 0) AS is_relevant
    FROM (SELECT *, {cats} AS cats, {kws} AS kws, {why} AS why FROM (
      SELECT *, CASE WHEN len(h_title) > 0 THEN 'title' WHEN len(h_keyword) > 0 THEN 'keyword' WHEN len(h_abstract) > 0 THEN 'abstract' END AS match_field,
        CASE WHEN len(h_title) > 0 THEN h_title WHEN len(h_keyword) > 0 THEN h_keyword ELSE h_abstract END AS won
      FROM (SELECT *, {hits('title')} AS h_title, {hits('keyword')} AS h_keyword, {hits('abstract')} AS h_abstract, {outs} AS outs FROM ({field_texts(t)}))))"""


def fold_merge(t: str, columns: dict[str, str], key: str, rich: tuple[str, ...], rich_lists: tuple[str, ...], fill: tuple[str, ...], union: tuple[str, ...], order: str = "ord") -> str:
    """SELECT of the records merged per key in arrival order: a reduction over the list of each key's rows.  columns: name -> type."""
    names = [c for c in columns if c != order]

    def richness(r):
        return "(" + " + ".join([*(f"coalesce(({r}.{c} <> '')::INT, 0)" for c in rich), *(f"coalesce(len({r}.{c}), 0)" for c in rich_lists)]) + ")"

    def field(n):
        x, y = f"CASE WHEN w THEN b.{n} ELSE a.{n} END", f"CASE WHEN w THEN a.{n} ELSE b.{n} END"
        if n in union:
            base, new = f"coalesce({x}, [])", f"coalesce({y}, [])"
            return f"list_concat({base}, list_filter({distinct_folded(new)}, lambda u: NOT list_contains(list_transform({base}, lambda v: {fold('v')}), {fold('u')})))"
        if n in fill:
            return f"CASE WHEN ({x}) IS NULL" + (f" OR ({x}) = ''" if columns[n] == "VARCHAR" else "") + f" THEN {y} ELSE {x} END"
        if n in ("relevance_score", "is_relevant"):
            p, q_ = "CASE WHEN w THEN b.relevance_score ELSE a.relevance_score END", "CASE WHEN w THEN a.relevance_score ELSE b.relevance_score END"
            return f"CASE WHEN ({p}) IS NULL OR (({q_}) IS NOT NULL AND ({q_}) > ({p})) THEN {y} ELSE {x} END"
        if n == "raw_payload":
            return f"CASE WHEN ({x}) IS NULL OR ({x}) IN ('', '{{}}') THEN coalesce({y}, {x}) ELSE {x} END"
        return x

    packed = "struct_pack(" + ", ".join(f"{n} := {n}" for n in names) + ")"
    step = "struct_pack(" + ", ".join(f"{n} := {field(n)}" for n in names) + ")"
    merge = f"list_transform([{richness('b')} > {richness('a')}], lambda w: {step})[1]"
    return f"""SELECT o AS {order}, r.* FROM (SELECT o, unnest([m]) AS r FROM (
      SELECT min({order}) AS o, list_reduce(list({packed} ORDER BY {order}), lambda a, b: {merge}) AS m FROM (SELECT *, {key} AS key_ FROM {t}) GROUP BY key_))"""
