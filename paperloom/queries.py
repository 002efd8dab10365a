"""Core queries: one entry per operator, each (spark, sf_dir) -> DataFrame, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from paperloom import oracle as O
from paperloom.functions import text as X
from paperloom.functions.matching import haystack, keyword_in, word_in
from paperloom.operators import classify as C
from paperloom.operators import dedup as D
from paperloom.operators import enrich as E
from paperloom.operators import filters as L
from paperloom.operators import normalize as N
from paperloom.operators.packed import split_packed
from paperloom.plans import rules as R
from paperloom.plans import slices as P
from paperloom.schema import PAPER
from paperloom.session import table, wide
from paperloom.sources import records as S
from paperloom.sources import store as T
from paperloom.streaming import incremental as I

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


# An invented taxonomy over the words of the test tables.
TAXONOMY = {
    "search_config": {"anchor_modes": {"anchored": ["포렌식", "forensic"], "anchored_digital_forensic": ["디지털 증거", "digital evidence", "증거"]}},
    "storage": {"image": {"direct": ["디스크 이미지", "disk image"]}, "memory": {"direct": {"ko": ["메모리 덤프"], "en": ["memory dump"]}}},
    "network": {"anchored": ["네트워크", "network"], "direct": ["mail server"]},
    "law": {"direct": ["법원 판결", "court ruling"], "anchored_digital_forensic": ["증거능력 판단 기준", "admissibility criterion"]},
    "logs": {"direct": ["로그 기록", "log record"]},
    "exclude": ["ransomware", "랜섬웨어"], "exclude_any": ["deepfake"],
}
RULES = R.parse_rules(TAXONOMY)
BLOCKED = ("형사법학회", "사이버법 연구소", "Society of Police Administration", "(사)통신보안학회")
MEMBERS, MEMBER_JOURNALS = ("디지털증거학회",), ("SER000001",)
ALLOW = ("1700", "1705", "법학")


def papers(spark, d):
    return table(spark, d, "normalized_papers")


MATCHED = ("ord", *C.TITLES, *C.ABSTRACTS, "keywords", *C.KEYWORD_TEXTS, "institution_id", "journal_id")


def matched(spark, d):
    """The columns that matching reads, on all cores."""
    return wide(spark, d, "normalized_papers", *MATCHED)


# --- normalizing ------------------------------------------------------------------------------------------------------


def _raw_xml(spark, d):
    """Raw records of the XML service, as the stored papers imply them."""
    k = table(spark, d, "kci_papers")
    vol = F.split(F.coalesce("issue_id", F.lit("")), "_")
    return k.select(
        "id", F.lit("memory").alias("matched_query"), F.lit("title").alias("matched_field"), F.col("source_id").alias("arti_id"), "journal_id",
        F.lit(None).cast("string").alias("journal_name"), F.col("institution_id").alias("publisher_name"),
        F.substring("registered_at", 1, 4).alias("pub_year"), F.substring("registered_at", 6, 2).alias("pub_mon"),
        F.get(vol, F.lit(0)).alias("volume"), F.get(vol, F.lit(1)).alias("issue"), F.col("subject_code").alias("article_categories"), F.lit("정규").alias("article_regularity"),
        F.col("title_kor").alias("title_original"), F.col("title_other").alias("title_foreign"), F.col("title_eng").alias("title_english"),
        F.col("abstract_kor").alias("abstract_original"), F.col("abstract_eng").alias("abstract_english"),
        X.json_list("keywords_json").alias("keywords"), X.json_list("authors_json").alias("authors"), "doi", "uci", "url", "first_page", F.col("final_page").alias("last_page"),
        "issn", "eissn", F.lit("0").alias("citation_count_kci"), F.lit("0").alias("citation_count_wos"), F.when(F.col("is_fulltext"), "Y").when(~F.col("is_fulltext"), "N").alias("is_open_access"), F.lit("Y").alias("verified"),
    )


def _flat(df):
    """Lists as joined text, so that both engines compare plain values."""
    return df.select(*[F.array_join(c, "|").alias(c) if t == "array<string>" else F.col(c) for c, t in df.dtypes])


_JL = "coalesce(CASE WHEN json_valid({0}) THEN try_cast({0} AS JSON)::VARCHAR[] END, []::VARCHAR[])"
_KW = f"list_filter(list_transform(flatten(list_transform({_JL.format('keywords_json')}, lambda w: string_split(regexp_replace(w, '[;|,\\n\\t]', chr(1), 'g'), chr(1)))), lambda k: {O.strip('k')}), lambda k: k <> '')"


@query("normalize_kci", f"""
SELECT id, 'kci' AS source, source_id, coalesce(nullif(title_kor,''), nullif(title_eng,''), nullif(title_other,'')) AS title,
  coalesce(nullif(abstract_kor,''), nullif(abstract_eng,'')) AS abstract, array_to_string({O.distinct_folded('kw')}, '|') AS keywords,
  nullif(array_to_string(list_filter({O.distinct_folded('kw')}, lambda k: regexp_matches(k, '[가-힣]')), '; '), '') AS keyword_text_kor,
  nullif(array_to_string(list_filter({O.distinct_folded('kw')}, lambda k: NOT regexp_matches(k, '[가-힣]')), '; '), '') AS keyword_text_eng,
  issue_id, CASE WHEN nullif(substr(registered_at,1,4),'') IS NULL THEN NULL WHEN nullif(substr(registered_at,6,2),'') IS NULL THEN substr(registered_at,1,4) ELSE substr(registered_at,1,4) || '-' || lpad(substr(registered_at,6,2),2,'0') END AS registered_at,
  try_cast(substr(registered_at,1,4) AS INTEGER) AS publication_year, is_fulltext, 'memory' AS matched_queries
FROM (SELECT * REPLACE (nullif(concat_ws('_', nullif(split_part(coalesce(issue_id,''),'_',1),''), nullif(split_part(coalesce(issue_id,''),'_',2),'')),'') AS issue_id), {_KW} AS kw FROM kci_papers)""")
def normalize_kci(spark, d):
    x = N.normalize_xml(_raw_xml(spark, d), keep=("id",))
    return _flat(x.select("id", "source", "source_id", "title", "abstract", "keywords", "keyword_text_kor", "keyword_text_eng", "issue_id", "registered_at", "publication_year", "is_fulltext", "matched_queries"))


@query("normalize_scopus", """
SELECT id, 'scopus' AS source, coalesce(nullif(source_id,''), nullif(doi,''), nullif(title,''), 'unknown') AS source_id, title, title AS title_eng,
  nullif(concat_ws('_', nullif(split_part(coalesce(issue_id,''),'_',1),''), nullif(split_part(coalesce(issue_id,''),'_',2),'')),'') AS issue_id,
  try_cast(nullif(regexp_extract(registered_at, '^(\\d{4})', 1), '') AS INTEGER) AS publication_year
FROM scopus_papers""")
def normalize_scopus(spark, d):
    s = table(spark, d, "scopus_papers")
    vol = F.split(F.coalesce("issue_id", F.lit("")), "_")
    raw = s.select("id", F.lit("q").alias("matched_query"), F.col("source_id").alias("scopus_id"), "doi", "title", "abstract", "url", F.col("registered_at").alias("cover_date"),
                   F.col("journal_id").alias("publication_name"), F.get(vol, F.lit(0)).alias("volume"), F.get(vol, F.lit(1)).alias("issue_identifier"), "issn", "eissn",
                   X.json_list("authors_json").alias("author_names"), X.json_list("keywords_json").alias("keywords"), F.lit("{}").alias("raw_item"))
    return N.normalize_json(raw, keep=("id",)).select("id", "source", "source_id", "title", "title_eng", "issue_id", "publication_year")


@query("stored_to_records", f"SELECT id, source_id, array_to_string({_JL.format('keywords_json')}, '|') AS keywords, array_to_string({_JL.format('authors_json')}, '|') AS authors, publication_year FROM kci_corpus")
def stored_to_records(spark, d):
    return _flat(N.from_stored(table(spark, d, "kci_corpus"), keep=("id",)).select("id", "source_id", "keywords", "authors", "publication_year"))


@query("records_to_stored", f"""
SELECT ord, source_id, cast(len(k) AS BIGINT) AS n_keywords, array_to_string({O.distinct_folded('c')}, '|') AS categories FROM (
  SELECT ord, source_id, coalesce(keywords, []) AS k, list_filter(list_transform(coalesce(categories, []), lambda x: {O.strip('x')}), lambda x: x NOT IN ('', '*')) AS c FROM normalized_papers)""")
def records_to_stored(spark, d):
    x = N.to_stored(papers(spark, d), keep=("ord",))
    return x.select("ord", "source_id", F.size(F.from_json("keywords_json", "array<string>")).cast("bigint").alias("n_keywords"), F.array_join(F.from_json("category", "array<string>"), "|").alias("categories"))


@query("seed_keywords", """
SELECT ord, array_to_string(CASE WHEN len(coalesce(keywords, [])) = 0 THEN list_filter(coalesce(matched_queries, []), lambda x: x <> '*') ELSE keywords END, '|') AS keywords FROM normalized_papers""")
def seed_keywords(spark, d):
    e = F.array().cast("array<string>")
    p = papers(spark, d).select("ord", F.coalesce("keywords", e).alias("keywords"), F.coalesce("matched_queries", e).alias("matched_queries"), F.lit("keyword").alias("matched_field"))
    return _flat(N.seed_keywords(p).select("ord", "keywords"))


_SENT = f"list_filter(list_transform(string_split(regexp_replace(nullif(abstract,''), '([.!?。]){O.WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {O.strip('s')}), lambda s: s <> '')"


@query("summarize", f"""
SELECT ord, coalesce(nullif(summary,''), CASE WHEN nullif(abstract,'') IS NOT NULL THEN coalesce(nullif(array_to_string({_SENT}[1:2], ' '), ''), substr(abstract, 1, 300))
  ELSE coalesce(nullif(title,''), '제목 없음') || ' | keywords: ' || CASE WHEN len(coalesce(keywords, [])) > 0 THEN array_to_string(keywords[1:5], ', ') ELSE '키워드 없음' END END) AS summary FROM normalized_papers""")
def summarize(spark, d):
    return N.summarize(papers(spark, d)).select("ord", "summary")


@query("sentence_split", f"SELECT ord, cast(len({_SENT}) AS BIGINT) AS n_sentences, {_SENT}[1] AS first_sentence FROM normalized_papers WHERE nullif(abstract,'') IS NOT NULL")
def sentence_split(spark, d):
    p = papers(spark, d).filter(X.nonempty("abstract").isNotNull()).withColumn("s", X.sentences("abstract"))
    return p.select("ord", F.size("s").cast("bigint").alias("n_sentences"), F.get("s", F.lit(0)).alias("first_sentence"))


@query("normalize_dates", r"""
SELECT id, CASE WHEN nullif(registered_at,'') IS NULL THEN NULL WHEN regexp_matches(registered_at, '^\d{4}-\d{1,2}-\d{1,2}$') AND try_strptime(registered_at, '%Y-%m-%d') IS NOT NULL THEN strftime(try_strptime(registered_at, '%Y-%m-%d'), '%Y-%m-%d')
  WHEN regexp_matches(registered_at, '^\d{4}-\d{1,2}$') AND try_cast(split_part(registered_at,'-',2) AS INTEGER) BETWEEN 1 AND 12 THEN split_part(registered_at,'-',1) || '-' || lpad(split_part(registered_at,'-',2), 2, '0') ELSE trim(registered_at) END AS day,
  try_cast(nullif(regexp_extract(registered_at, '^(\d{4})', 1), '') AS INTEGER) AS year FROM scopus_papers""")
def normalize_dates(spark, d):
    return table(spark, d, "scopus_papers").select("id", X.normal_date("registered_at").alias("day"), X.leading_year("registered_at").alias("year"))


@query("html_unescape", "SELECT ord, nullif(" + O.strip("replace(replace(replace(replace(replace(replace(replace(abstract, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')") + ", '') AS abstract FROM normalized_papers")
def html_unescape(spark, d):
    return papers(spark, d).select("ord", X.clean("abstract").alias("abstract"))


# --- matching and classification ---------------------------------------------------------------------------------------

_TEXT = O.fold("text")


@query("match_v1", "\nUNION ALL\n".join(f"SELECT {O.q(k)} AS keyword, count(*) AS n FROM documents WHERE contains({O.no_space(_TEXT)}, {O.q(''.join(k.split()))})" for k in RULES.keywords))
def match_v1(spark, d):
    t = wide(spark, d, "documents", "text").select(X.no_space(X.fold("text")).alias("t"))
    hit = F.array(*[F.struct(F.lit(k).alias("keyword"), F.col("t").contains("".join(k.casefold().split())).cast("bigint").alias("n")) for k in RULES.keywords])
    return t.select(F.inline(hit)).groupBy("keyword").agg(F.sum("n").alias("n"))


@query("match_v3_proximity", f"SELECT doc_id, {O.keyword_in('memory dump', _TEXT, O.no_space(_TEXT))} AS dump, {O.keyword_in('court ruling', _TEXT, O.no_space(_TEXT))} AS ruling, {O.keyword_in('증거능력 판단 기준', _TEXT, O.no_space(_TEXT))} AS criterion FROM documents")
def match_v3_proximity(spark, d):
    x = wide(spark, d, "documents", "doc_id", "text").withColumn("t", X.fold("text")).withColumn("s", X.no_space("t"))
    return x.select("doc_id", *[keyword_in(k, F.col("t"), F.col("s")).alias(n) for k, n in (("memory dump", "dump"), ("court ruling", "ruling"), ("증거능력 판단 기준", "criterion"))])


@query("exclude_whole_word", f"SELECT doc_id FROM documents WHERE {O.word_in('key', _TEXT)} OR {O.word_in('log', _TEXT)}")
def exclude_whole_word(spark, d):
    return table(spark, d, "documents").filter(word_in("key", X.fold("text")) | word_in("log", X.fold("text"))).select("doc_id")


_CLASSIFIED = O.classified("normalized_papers", RULES)


@query("classify_taxonomy", f"SELECT ord, categories, matched_keywords, relevance_reasons, relevance_score, is_relevant, match_field FROM ({_CLASSIFIED})")
def classify_taxonomy(spark, d):
    x = C.classify(matched(spark, d), RULES)
    return _flat(x.select("ord", "categories", "matched_keywords", "relevance_reasons", "relevance_score", "is_relevant", "match_field"))


_MEMBER = f"({O.fold(chr(99)+'oalesce(institution_id,' + O.q('') + ')')} LIKE '%{MEMBERS[0]}%' OR contains({O.fold('coalesce(journal_id, ' + O.q('') + ')')}, '{MEMBER_JOURNALS[0].casefold()}'))"


@query("classify_breakdown", f"""
SELECT CASE WHEN is_relevant THEN match_field ELSE 'journal' END AS match_field, count(*) AS n FROM ({_CLASSIFIED}) WHERE is_relevant OR {_MEMBER} GROUP BY 1""")
def classify_breakdown(spark, d):
    return C.breakdown(C.keep_relevant(C.classify(matched(spark, d), RULES), C.member(MEMBERS, MEMBER_JOURNALS)))


@query("member_rows", f"SELECT ord FROM normalized_papers WHERE {_MEMBER}")
def member_rows(spark, d):
    return papers(spark, d).filter(C.member(MEMBERS, MEMBER_JOURNALS)).select("ord")


_ALL9 = O.fold("concat(" + ", ' ', ".join(f"coalesce({c}, '')" for c in (*C.TITLES, *C.ABSTRACTS)) + ", ' ', coalesce(array_to_string(keywords, ' '), ''))")


@query("extra_terms", f"""
SELECT ord, concat_ws('|', CASE WHEN {O.keyword_in('압수 절차', 't', O.no_space('t'))} THEN '압수 절차' END, CASE WHEN {O.keyword_in('cloud store', 't', O.no_space('t'))} THEN 'cloud store' END) AS matched_keywords
FROM (SELECT ord, {_ALL9} AS t FROM normalized_papers) WHERE {O.keyword_in('압수 절차', 't', O.no_space('t'))} OR {O.keyword_in('cloud store', 't', O.no_space('t'))}""")
def extra_terms(spark, d):
    p = matched(spark, d).withColumns({"is_relevant": F.lit(False), "relevance_score": F.lit(0.0), **{c: F.array().cast("array<string>") for c in ("categories", "matched_keywords", "relevance_reasons")}}).withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))
    return _flat(C.extra_terms(p, ["압수 절차", "cloud store"], "extra").filter("is_relevant").select("ord", "matched_keywords"))


def _weigh(x):
    return "(" + " + ".join(f"CASE WHEN contains({O.fold(f'coalesce({x}, {O.q(str())})')}, {O.q(k)}) THEN {v} ELSE 0 END" for k, v in {**C.EXCLUDED, **C.STRONG, **C.WEAK}.items()) + ")"


_RAW = f"{_weigh('title')} * 1.5 + {_weigh('abstract')} + {_weigh('array_to_string(keywords, chr(32))')} * 1.2"


@query("score_weighted", f"SELECT ord, round(cast(s AS DOUBLE), 2) AS relevance_score, s >= 3.0 AS is_relevant FROM (SELECT ord, {_RAW} AS s FROM normalized_papers)")
def score_weighted(spark, d):
    return C.weighted_score(matched(spark, d)).select("ord", "relevance_score", "is_relevant")


_HAY = O.fold("concat(coalesce(title_kor,''), ' ', coalesce(title_eng,''), ' ', coalesce(title_other,''), ' ', array_to_string(" + _JL.format("keywords_json") + ", ' '), ' ', coalesce(abstract_kor,''), ' ', coalesce(abstract_eng,''))")


@query("sweep_candidates", f"""
SELECT id, CASE WHEN m THEN {O.q(MEMBERS[0])} ELSE 'memory' END AS matched_query, CASE WHEN m THEN 'journal' ELSE 'title' END AS matched_field
FROM (SELECT id, {_HAY} AS t, {_MEMBER} AS m FROM kci_papers) WHERE m OR (NOT {O.any_of([O.word_in(e, 't') for e in RULES.excludes])} AND {O.any_of([O.keyword_in(k, 't', O.no_space('t')) for k in RULES.keywords])})""")
def sweep_candidates(spark, d):
    m = C.member(MEMBERS, MEMBER_JOURNALS, "publisher_name", "journal_id")
    return L.sweep_candidates(_raw_xml(spark, d), RULES, m, MEMBERS[0]).select("id", "matched_query", "matched_field")


_BT = O.fold("concat(coalesce(institution_id,''), ' ', coalesce(journal_id,''))")
_BV = f"list_concat({O.org_variants('institution_id')}, {O.org_variants('journal_id')})"


@query("blacklist_anti", f"""
SELECT ord FROM (SELECT ord, {_MEMBER} AS m, {_BT} AS t, {_BV} AS v FROM normalized_papers)
WHERE m OR NOT (regexp_matches(t, '\\S') AND (""" + " OR ".join(
    f"{O.keyword_in(b, 't', O.no_space('t')).replace('(사)통신', chr(92) + '(사' + chr(92) + ')통신') if ' ' in b else 'contains(' + O.no_space('t') + ', ' + O.q(b.casefold()) + ')'} OR len(list_filter(v, lambda x: len(list_filter({O.org_variants(O.q(b))}, lambda y: contains(x, y) OR contains(y, x))) > 0)) > 0" for b in BLOCKED) + "))")
def blacklist_anti(spark, d):
    return L.not_blocked(papers(spark, d), L.term_table(spark, BLOCKED), C.member(MEMBERS, MEMBER_JOURNALS)).select("ord")


@query("org_variants", f"SELECT DISTINCT institution_id, array_to_string(list_sort({O.org_variants('institution_id')}), '|') AS variants FROM normalized_papers WHERE institution_id IS NOT NULL")
def org_variants(spark, d):
    p = papers(spark, d).select("institution_id").filter("institution_id is not null").distinct()
    return p.select("institution_id", F.array_join(F.array_sort(X.org_variants("institution_id")), "|").alias("variants"))


_CODES = "list_filter(list_transform(string_split(replace(coalesce(subject_code, ''), '|', ';'), ';'), lambda x: trim(x)), lambda x: x <> '')"


@query("allowlist_overlap", "SELECT event_id FROM events WHERE cast(json_extract(props, '$.k') AS INTEGER) IN (1, 3, 7)")
def allowlist_overlap(spark, d):
    e = table(spark, d, "events").withColumn("subject_code", F.concat(F.lit("["), F.to_json(F.struct(F.get_json_object("props", "$.k").alias("code"))), F.lit("]")))
    return L.allowed_codes(e, ("1", "3", "7")).select("event_id")


@query("subject_codes", f"SELECT ord, array_to_string(list_sort(list_distinct({_CODES})), '|') AS codes FROM normalized_papers WHERE subject_code IS NULL OR subject_code NOT LIKE '[%'")
def subject_codes(spark, d):
    p = papers(spark, d).filter(F.col("subject_code").isNull() | ~F.col("subject_code").startswith("["))
    return p.select("ord", F.array_join(F.array_sort(X.subject_codes("subject_code")), "|").alias("codes"))


_ALL_CODES = f"CASE WHEN json_valid(subject_code) AND ltrim(subject_code) LIKE '[%' THEN list_filter(list_transform(json_extract(subject_code, '$[*]'), lambda x: trim(coalesce(CASE WHEN json_type(x) = 'OBJECT' THEN json_extract_string(x, '$.code') ELSE json_extract_string(x, '$') END, ''))), lambda x: x <> '') ELSE {_CODES} END"


@query("subject_codes_all", f"SELECT ord, array_to_string(list_sort(list_distinct({_ALL_CODES})), '|') AS codes FROM normalized_papers")
def subject_codes_all(spark, d):
    return papers(spark, d).select("ord", F.array_join(F.array_sort(X.subject_codes("subject_code")), "|").alias("codes"))


@query("subject_codes_allowed", f"SELECT ord FROM normalized_papers WHERE list_has_any({_ALL_CODES}, ['1700', '3308', '법학'])")
def subject_codes_allowed(spark, d):
    return L.allowed_codes(papers(spark, d), ("1700", "3308", "법학")).select("ord")


@query("year_range", "SELECT ord FROM normalized_papers WHERE publication_year BETWEEN 2018 AND 2022")
def year_range(spark, d):
    return L.year_range(papers(spark, d), 2018, 2022).select("ord")


# --- de-duplication -----------------------------------------------------------------------------------------------------


@query("title_key_groups", f"SELECT {O.title_key('title')} AS key, count(*) AS n FROM normalized_papers WHERE {O.title_key('title')} IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def title_key_groups(spark, d):
    return D.duplicate_groups(papers(spark, d), X.title_key("title"))


_KEY = f"coalesce('doi:' || {O.fold(chr(110) + 'ullif(doi, ' + O.q('') + ')')}, 'id:' || {O.fold('coalesce(source, ' + O.q('') + ') || ' + O.q(':') + ' || nullif(source_id, ' + O.q('') + ')')}, 'title:' || coalesce({O.title_key('title')}, ''))"


@query("paper_keys", f"SELECT {_KEY} AS key, count(*) AS n FROM normalized_papers GROUP BY 1")
def paper_keys(spark, d):
    return papers(spark, d).groupBy(D.paper_key().alias("key")).agg(F.count("*").alias("n"))


@query("dedup_first_wins", "SELECT source_id, ord, title, publication_year FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ord) AS rn FROM normalized_papers) WHERE rn = 1")
def dedup_first_wins(spark, d):
    return D.first_wins(papers(spark, d).select("source_id", "ord", "title", "publication_year"), "source_id", "ord")


_TYPES = {"ord": "BIGINT"} | {f.name: {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}.get(f.dataType.simpleString(), "VARCHAR[]") for f in PAPER.fields}
_LISTS = [c for c, k in _TYPES.items() if k == "VARCHAR[]"]
_MERGED = O.fold_merge("normalized_papers", _TYPES, _KEY, D.RICH, D.RICH_LISTS, D.FILL, D.UNION)


@query("dedup_fold_merge", f"SELECT * REPLACE ({', '.join(f'array_to_string({c}, {O.q(chr(124))}) AS {c}' for c in _LISTS)}) FROM ({_MERGED})")
def dedup_fold_merge(spark, d):
    return _flat(D.fold_merge(papers(spark, d)))


@query("richness", "SELECT ord, cast(" + " + ".join(f"coalesce(({c} <> '')::INT, 0)" for c in D.RICH) + " + " + " + ".join(f"coalesce(len({c}), 0)" for c in D.RICH_LISTS) + " AS BIGINT) AS richness FROM normalized_papers")
def richness(spark, d):
    return papers(spark, d).select("ord", D.richness().cast("bigint").alias("richness"))


@query("keywords_split_distinct", f"SELECT ord, array_to_string({O.split_keywords('keyword_text_eng')}, '~') AS keywords FROM normalized_papers WHERE keyword_text_eng IS NOT NULL")
def keywords_split_distinct(spark, d):
    return papers(spark, d).filter("keyword_text_eng is not null").select("ord", F.array_join(X.split_keywords("keyword_text_eng"), "~").alias("keywords"))


@query("union_folded", f"SELECT ord, array_to_string({O.distinct_folded('a')}, '|') AS merged FROM (SELECT ord, list_concat(coalesce(keywords, []), coalesce(matched_queries, [])) AS a FROM normalized_papers)")
def union_folded(spark, d):
    return papers(spark, d).select("ord", F.array_join(X.union_folded("keywords", "matched_queries"), "|").alias("merged"))


# --- joins ---------------------------------------------------------------------------------------------------------------


def _corpus_lists(spark, d, name):
    return table(spark, d, name).select("source_id", X.json_list("keywords_json").alias("keywords"))


@query("detail_enrich", f"""
WITH det AS (SELECT source_id, first(k ORDER BY len(k) DESC, array_to_string(k, '|') DESC) AS k FROM (SELECT source_id, {_JL.format('keywords_json')} AS k FROM corpus_batches) GROUP BY 1)
SELECT c.id, cast(len({O.distinct_folded('a')}) AS BIGINT) AS n_keywords, cast(n_real AS BIGINT) AS n_real FROM (
  SELECT c.id, list_concat({_JL.format('c.keywords_json')}, coalesce(det.k, [])) AS a, len(det.k) AS n_real FROM kci_corpus c LEFT JOIN det USING (source_id)) c""")
def detail_enrich(spark, d):
    c = table(spark, d, "kci_corpus").select("id", "source_id", X.json_list("keywords_json").alias("keywords"))
    b = _corpus_lists(spark, d, "corpus_batches").groupBy("source_id").agg(F.max_by("keywords", F.struct(F.size("keywords"), F.array_join("keywords", "|"))).alias("keywords"))
    return E.add_keywords(c, b).select("id", F.size("keywords").cast("bigint").alias("n_keywords"), F.when(F.col("real_keywords").isNotNull(), F.size("real_keywords")).cast("bigint").alias("n_real"))


@query("detail_merge", """
SELECT c.id, coalesce(nullif(c.title,''), nullif(x.title,''), c.title) AS title, coalesce(nullif(c.issn,''), nullif(x.issn,''), c.issn) AS issn, coalesce(nullif(x.institution_id,''), c.institution_id) AS institution_id
FROM kci_corpus c LEFT JOIN (SELECT source_id, title, issn, institution_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY id) AS rn FROM corpus_batches) WHERE rn = 1) x USING (source_id)""")
def detail_merge(spark, d):
    s = lambda n: F.lit(None).cast("string").alias(n)
    e = F.array().cast("array<string>")
    b = D.first_wins(table(spark, d, "corpus_batches"), "source_id", "id").select(
        "source_id", "title", s("abstract"), s("url"), s("cover_date"), s("publication_name"), F.col("institution_id").alias("publisher"), "issn", s("eissn"), s("raw_payload"),
        e.alias("author_names"), e.alias("keywords"), F.lit(None).cast("array<struct<code:string,abbrev:string,name:string>>").alias("subject_areas"))
    return E.add_detail(N.from_stored(table(spark, d, "kci_corpus"), keep=("id",)), b).select("id", "title", "issn", "institution_id")


@query("keyword_backfill", f"""
SELECT c.id, array_to_string(CASE WHEN len(ck) > 0 THEN ck ELSE coalesce(x.k, ck) END, '|') AS keywords FROM (SELECT id, source_id, {_JL.format('keywords_json')} AS ck FROM kci_corpus) c
LEFT JOIN (SELECT source_id, first(k ORDER BY len(k) DESC, array_to_string(k, '|') DESC) AS k FROM (SELECT source_id, {_JL.format('keywords_json')} AS k FROM corpus_batches) WHERE len(k) > 0 GROUP BY 1) x USING (source_id)""")
def keyword_backfill(spark, d):
    c = table(spark, d, "kci_corpus").select("id", "source_id", X.json_list("keywords_json").alias("keywords"))
    b = _corpus_lists(spark, d, "corpus_batches").groupBy("source_id").agg(F.max_by("keywords", F.struct(F.size("keywords"), F.array_join("keywords", "|"))).alias("keywords"))
    return _flat(E.backfill_keywords(c, b).select("id", "keywords"))


@query("new_rows_anti", "SELECT id FROM corpus_batches b WHERE NOT EXISTS (SELECT 1 FROM kci_corpus c WHERE c.source_id = b.source_id)")
def new_rows_anti(spark, d):
    return L.new_rows(table(spark, d, "corpus_batches"), table(spark, d, "kci_corpus")).select("id")


@query("upsert_merge", """
WITH b AS (SELECT source_id, title, id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY id DESC) AS rn FROM corpus_batches) WHERE rn = 1)
SELECT source_id, title, id FROM kci_corpus c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source_id = c.source_id) UNION ALL SELECT source_id, title, id FROM b""")
def upsert_merge(spark, d):
    # keys recur in the batches: the last row counts
    b = table(spark, d, "corpus_batches").select("source_id", "title", "id")
    return T.upsert(table(spark, d, "kci_corpus").select("source_id", "title", "id"), b, order="id")


@query("id_multimap", "SELECT source_id, count(*) AS n, string_agg(cast(ord AS VARCHAR), ',' ORDER BY ord) AS ords FROM normalized_papers GROUP BY 1 HAVING count(*) > 1")
def id_multimap(spark, d):
    g = papers(spark, d).groupBy("source_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("ord")).alias("o"))
    return g.filter("n > 1").select("source_id", "n", F.array_join(F.transform("o", lambda x: x.cast("string")), ",").alias("ords"))


# --- filters over stored rows ------------------------------------------------------------------------------------------


@query("delete_outside_years", "SELECT id FROM kci_corpus WHERE NOT (source = 'kci' AND (publication_year IS NULL OR publication_year < 2015 OR publication_year > 2024))")
def delete_outside_years(spark, d):
    return L.delete(table(spark, d, "kci_corpus"), L.outside_years(2015, 2024)).select("id")


@query("delete_invalid", "SELECT id FROM kci_papers WHERE NOT (source = 'kci' AND coalesce(" + " OR ".join(f"coalesce({c} IN ('', '[]') OR {c} LIKE '%\"*\"%', false)" for c in ("category", "matched_keywords_json", "relevance_reasons_json")) + ", false))")
def delete_invalid(spark, d):
    return L.delete(table(spark, d, "kci_papers"), L.invalid_evidence()).select("id")


@query("incremental_select", """
SELECT b.id FROM corpus_batches b LEFT JOIN (SELECT DISTINCT source_id AS s FROM kci_corpus) c ON b.source_id = c.s
WHERE c.s IS NULL OR coalesce(nullif(updated_at,''), nullif(registered_at,'')) > '2020-06'""")
def incremental_select(spark, d):
    return L.incremental(table(spark, d, "corpus_batches"), table(spark, d, "kci_corpus"), "2020-06").select("id")


@query("incremental_hwm", "SELECT event_type, count(*) AS n, max(event_id) AS mark FROM events WHERE event_id > 700 GROUP BY 1")
def incremental_hwm(spark, d):
    return I.above_mark(table(spark, d, "events"), 700, "event_id").groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("mark"))


@query("event_windows", "SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    return I.windowed_counts(table(spark, d, "events"), "ts", "1 day", by=("event_type",)).select("event_type", F.col("window.start").alias("start"), "n")


@query("late_recheck", """
WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS m FROM orders), late AS (SELECT m FROM m ORDER BY m DESC LIMIT 2)
SELECT m AS month FROM m WHERE m >= '199506' OR m IN (SELECT m FROM late)""")
def late_recheck(spark, d):
    m = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month")).distinct()
    late = m.orderBy(F.desc("month")).limit(2).withColumn("late", F.lit(True))
    done = F.col("month") < "199506"
    return m.join(F.broadcast(late), "month", "left").filter(~done | F.col("late").isNotNull()).select("month")


@query("done_months", "SELECT unnest(CAST(value AS JSON)::VARCHAR[]) AS month FROM pipeline_state WHERE key = 'kci:corpus_done_months'")
def done_months(spark, d):
    s = table(spark, d, "pipeline_state").filter("key = 'kci:corpus_done_months'")
    return s.select(F.explode(X.json_list("value")).alias("month"))


@query("broken_state", "SELECT key, CASE WHEN json_valid(value) AND value LIKE '[%' THEN json_array_length(value)::BIGINT ELSE 0 END AS n_done FROM pipeline_state")
def broken_state(spark, d):
    return table(spark, d, "pipeline_state").select("key", F.size(X.json_list("value")).cast("bigint").alias("n_done"))


# --- planning ------------------------------------------------------------------------------------------------------------


@query("month_ranges", "SELECT strftime(m, '%Y%m') AS date_from, strftime(m, '%Y%m') AS date_to FROM generate_series(DATE '2022-01-01', DATE '2025-03-01', INTERVAL 1 MONTH) t(m)")
def month_ranges(spark, d):
    return spark.createDataFrame(P.month_ranges(2022, 2026, today=date(2025, 3, 9)), "date_from string, date_to string")


@query("month_enumeration", "SELECT strftime(m, '%Y%m') AS month FROM generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders), (SELECT date_trunc('month', max(o_orderdate)) FROM orders), INTERVAL 1 MONTH) t(m)")
def month_enumeration(spark, d):
    b = table(spark, d, "orders").agg(F.date_trunc("month", F.min("o_orderdate")).cast("date").alias("a"), F.date_trunc("month", F.max("o_orderdate")).cast("date").alias("b"))
    return b.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("m")).select(F.date_format("m", "yyyyMM").alias("month"))


@query("slice_bisect", """
WITH RECURSIVE daily AS (SELECT o_orderdate::DATE AS d, count(*)::BIGINT AS n FROM orders GROUP BY 1),
lim AS (SELECT (sum(n) // 12)::BIGINT AS l FROM daily),
r(lo, hi, n) AS (SELECT min(d), max(d), sum(n)::BIGINT FROM daily UNION ALL
  SELECT h.lo, h.hi, (SELECT coalesce(sum(x.n), 0)::BIGINT FROM daily x WHERE x.d BETWEEN h.lo AND h.hi) FROM (
    SELECT CASE WHEN side = 0 THEN lo ELSE (lo + (date_diff('day', lo, hi) // 2)::INT + 1) END AS lo, CASE WHEN side = 0 THEN (lo + (date_diff('day', lo, hi) // 2)::INT) ELSE hi END AS hi
    FROM r, (VALUES (0), (1)) s(side), lim WHERE n > lim.l AND lo < hi) h)
SELECT lo, hi, n FROM r, lim WHERE (n <= lim.l OR lo = hi) AND n > 0""")
def slice_bisect(spark, d):
    daily = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    parts = P.bisect_histogram(daily, (daily.agg(F.sum("n")).first()[0] or 0) // 12)
    return spark.createDataFrame(parts, "lo date, hi date, n bigint")


@query("id_segments", """
WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem)
SELECT cast((l_orderkey - lo) // cast(ceil((hi - lo + 1) / 8.0) AS BIGINT) AS INTEGER) AS segment, count(*) AS n, min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem, b GROUP BY 1""")
def id_segments(spark, d):
    x = P.with_segment(table(spark, d, "lineitem").select("l_orderkey"), "l_orderkey", 8)
    return x.groupBy("segment").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"))


@query("id_bounds", "SELECT coalesce(min(id), 0) AS low, coalesce(max(id), 0) AS high, count(*) AS n, count(*) FILTER (WHERE publication_year IS NULL) AS no_year FROM kci_corpus")
def id_bounds(spark, d):
    return table(spark, d, "kci_corpus").agg(F.coalesce(F.min("id"), F.lit(0)).alias("low"), F.coalesce(F.max("id"), F.lit(0)).alias("high"), F.count("*").alias("n"), F.count_if(F.col("publication_year").isNull()).alias("no_year"))


@query("keyset_page", "SELECT id, source_id FROM kci_corpus WHERE id > 100 ORDER BY id LIMIT 50")
def keyset_page(spark, d):
    return table(spark, d, "kci_corpus").filter("id > 100").orderBy("id").limit(50).select("id", "source_id")


@query("rule_table", "SELECT * FROM (VALUES " + ", ".join(f"({O.q(r.category)}, {O.q(r.keyword)}, {O.q(r.mode)}, {O.q('|'.join(r.anchors))})" for r in RULES.rules) + ") t(category, keyword, mode, anchors)")
def rule_table(spark, d):
    return spark.createDataFrame([(r.category, r.keyword, r.mode, "|".join(r.anchors)) for r in R.parse_rules(TAXONOMY).rules], "category string, keyword string, mode string, anchors string")


@query("remote_query_text", "SELECT y AS year, 'TITLE-ABS-KEY(' || (SELECT string_agg(c, ' OR ') FROM (VALUES " + ", ".join(f"({O.q('(' + c + ')')})" for c in R.rule_clauses(RULES)) + ") t(c)) || ') AND PUBYEAR = ' || y || ' AND SUBJAREA(COMP or SOCI or DECI or MULT or ENGI or PSYC)' AS query FROM generate_series(2020, 2026) g(y)")
def remote_query_text(spark, d):
    ys = P.search_years(2025)
    return spark.createDataFrame(list(zip(ys, R.remote_queries(ys, clauses=R.rule_clauses(RULES)))), "year bigint, query string")


# --- export and parsing --------------------------------------------------------------------------------------------------

_JOIN = lambda c: f"array_to_string(list_filter(coalesce({c}, []), lambda x: x IS NOT NULL AND x <> ''), '; ')"


@query("export_rows", f"SELECT source, source_id, title, {_JOIN('keywords')} AS paper_keywords, {_JOIN('authors')} AS authors, publication_year FROM normalized_papers")
def export_rows(spark, d):
    e = F.array().cast("array<string>")
    p = papers(spark, d).withColumns({c: F.coalesce(c, e) for c in ("categories", "matched_keywords", "keywords", "authors")})
    return E.export_rows(p).select("source", "source_id", "title", "paper_keywords", "authors", "publication_year")


@query("export_by_category", f"SELECT sheet, count(*) AS n FROM (SELECT unnest(CASE WHEN categories = '' THEN ['미분류'] ELSE string_split(categories, '|') END) AS sheet FROM ({_CLASSIFIED})) GROUP BY 1")
def export_by_category(spark, d):
    return E.by_category(C.classify(wide(spark, d, "normalized_papers"), RULES)).groupBy("sheet").agg(F.count("*").alias("n"))


def _esc(c):
    out = F.coalesce(F.col(c), F.lit(""))
    for k, v in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(k), F.lit(v))
    # XML has no other control characters than tab and line ends
    return F.regexp_replace(out, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "")


def _xml(c, tag):
    return F.concat(F.lit(f"<{tag}>"), _esc(c), F.lit(f"</{tag.split(' ')[0]}>"))


@query("parse_xml", f"""SELECT id, source_id AS arti_id, nullif({O.strip('title_kor')}, '') AS title_original, nullif({O.strip('title_eng')}, '') AS title_english, nullif({O.strip('institution_id')}, '') AS publisher_name,
  nullif({O.strip('doi')}, '') AS doi, nullif({O.strip('first_page')}, '') AS first_page, array_to_string({O.distinct_folded('k')}, '|') AS keywords
FROM (SELECT *, list_filter(list_transform({_JL.format('keywords_json')}, lambda x: {O.strip('x')}), lambda x: x <> '') AS k FROM kci_papers)""")
def parse_xml(spark, d):
    """Round trip: pages of records are written from the stored papers and parsed again."""
    k = table(spark, d, "kci_papers")
    kw = F.array_join(F.transform(X.json_list("keywords_json"), lambda x: F.concat(F.lit("<keyword>"), F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</keyword>"))), "")
    doc = F.concat(
        F.lit("<root><result><total>1</total></result><record><journalInfo journal-id=\""), _esc("journal_id"), F.lit("\">"), _xml("institution_id", "publisher-name"), F.lit("</journalInfo><articleInfo article-id=\""), _esc("source_id"), F.lit("\"><title-group>"),
        _xml("title_kor", 'article-title lang="original"'), _xml("title_eng", 'article-title lang="english"'), F.lit("</title-group><keyword-group>"), kw, F.lit("</keyword-group>"), _xml("first_page", "fpage"), _xml("doi", "doi"), F.lit("</articleInfo></record></root>"))
    x = S.parse_xml(S.xml_page_records(k.select("id", doc.alias("xml"))))
    return _flat(x.select("id", "arti_id", "title_original", "title_english", "publisher_name", "doi", "first_page", "keywords"))


@query("parse_json_records", f"""SELECT id, source_id AS scopus_id, nullif({O.strip('title')}, '') AS title, nullif({O.strip('doi')}, '') AS doi, 'https://a.example/' || id AS url,
  array_to_string({O.distinct_folded('k')}, '|') AS keywords FROM (SELECT *, list_filter(list_transform(flatten(list_transform({_JL.format('keywords_json')}, lambda x: string_split(replace(x, '|', ';'), ';'))), lambda x: {O.strip('x')}), lambda x: x <> '') AS k FROM scopus_papers)""")
def parse_json_records(spark, d):
    s = table(spark, d, "scopus_papers")
    link = F.array(F.struct(F.lit("self").alias("@ref"), F.lit("https://b.example/").alias("@href")), F.struct(F.lit("scopus").alias("@ref"), F.concat(F.lit("https://a.example/"), F.col("id").cast("string")).alias("@href")))
    entry = F.struct(F.concat(F.lit("SCOPUS_ID:"), "source_id").alias("dc:identifier"), F.col("title").alias("dc:title"), F.col("doi").alias("prism:doi"), link.alias("link"), F.array_join(X.json_list("keywords_json"), " | ").alias("authkeywords"))
    body = F.to_json(F.struct(F.struct(F.lit("1").alias("opensearch:totalResults"), F.array(entry).alias("entry")).alias("search-results")))
    return _flat(S.parse_json(S.json_entries(s.select("id", body.alias("json")))).select("id", "scopus_id", "title", "doi", "url", "keywords"))


@query("parse_json_payload", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def parse_json_payload(spark, d):
    return table(spark, d, "events").select("event_id", X.safe_int(F.get_json_object("props", "$.k")).alias("k"))


# --- training-data operators of the core ----------------------------------------------------------------------------------


@query("p6_found")
def p6_found(spark, d):
    p = wide(spark, d, "normalized_papers", "ord", "keyword_text_kor", "keyword_text_eng")
    return split_packed(p, "ord", ["keyword_text_kor", "keyword_text_eng"])
