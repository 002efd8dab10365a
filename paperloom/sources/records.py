"""Parsers of the two record formats: XML records and JSON search entries and details, as expressions over a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X

# Element and attribute names of the XML service.
XML_RECORD = """
journalInfo struct<`_journal-id`:string,`journal-name`:string,`publisher-name`:string,`pub-year`:string,`pub-mon`:string,volume:string,issue:string,issn:string,eissn:string>,
articleInfo struct<`_article-id`:string,`article-categories`:string,`article-regularity`:string,
 `title-group`:struct<`article-title`:array<struct<`_lang`:string,`_VALUE`:string>>>,
 `author-group`:struct<author:array<string>>,
 `abstract-group`:struct<abstract:array<struct<`_lang`:string,`_VALUE`:string>>>,
 abstract:string,
 `keyword-group`:struct<keyword:array<string>>,
 fpage:string,lpage:string,doi:string,uci:string,url:string,`orte-open-yn`:string,verified:string,
 `citation-count`:struct<`_kci`:string,`_wos`:string>>
"""


def xml_total(c) -> Column:
    """Number of hits that a response page states; 0 if it is missing or no number."""
    return F.coalesce(X.safe_int(F.regexp_extract(X.col(c), r"(?s)<result\b.*?<total>(.*?)</total>", 1)), F.lit(0))


def xml_page_records(pages: DataFrame, column: str = "xml") -> DataFrame:
    """One row per record of response pages: page columns but the text, and ``record`` (text of the element)."""
    parts = F.regexp_extract_all(F.col(column), F.lit(r"(?s)(<record\b.*?</record>)"), F.lit(1))
    return pages.withColumn("record", F.explode(parts)).drop(column)


def _by_lang(group: Column, lang: str) -> Column:
    """The last text of the language that is not empty; a text without a language is the original."""
    mine = F.filter(F.coalesce(group, F.array().cast("array<struct<_lang:string,_VALUE:string>>")), lambda t: (F.coalesce(X.nonempty(t["_lang"]), F.lit("original")) == lang) & X.clean(t["_VALUE"]).isNotNull())
    return X.clean(F.try_element_at(mine, F.lit(-1))["_VALUE"])


def parse_xml(df: DataFrame, column: str = "record", matched_query: Column | None = None, matched_field: Column | None = None) -> DataFrame:
    """Raw XML records; broken XML gives a row of nulls, to be caught by ``dead_letters``."""
    r = F.from_xml(F.col(column), XML_RECORD.replace("\n", " "), {"rowTag": "record"})
    x = df.withColumn("r_", r)
    j, a = (lambda n: F.col(f"r_.journalInfo.`{n}`")), (lambda n: F.col(f"r_.articleInfo.`{n}`"))
    titles, abstracts = F.col("r_.articleInfo.`title-group`.`article-title`"), F.col("r_.articleInfo.`abstract-group`.abstract")
    texts = lambda arr: F.filter(F.transform(F.coalesce(arr, F.array().cast("array<string>")), X.clean), lambda t: t.isNotNull())
    original = F.coalesce(_by_lang(abstracts, "original"), F.when(_by_lang(abstracts, "english").isNull(), X.clean(a("abstract"))))
    return x.select(
        *[c for c in df.columns if c != column],
        (matched_query if matched_query is not None else F.lit(None).cast("string")).alias("matched_query"),
        (matched_field if matched_field is not None else F.lit(None).cast("string")).alias("matched_field"),
        a("_article-id").alias("arti_id"), j("_journal-id").alias("journal_id"), X.clean(j("journal-name")).alias("journal_name"),
        X.clean(j("publisher-name")).alias("publisher_name"), X.clean(j("pub-year")).alias("pub_year"), X.clean(j("pub-mon")).alias("pub_mon"),
        X.clean(j("volume")).alias("volume"), X.clean(j("issue")).alias("issue"),
        X.clean(a("article-categories")).alias("article_categories"), X.clean(a("article-regularity")).alias("article_regularity"),
        *[_by_lang(titles, k).alias(f"title_{k}") for k in ("original", "foreign", "english")],
        original.alias("abstract_original"), _by_lang(abstracts, "english").alias("abstract_english"),
        X.distinct_folded(texts(F.col("r_.articleInfo.`keyword-group`.keyword"))).alias("keywords"), texts(F.col("r_.articleInfo.`author-group`.author")).alias("authors"),
        *[X.clean(a(n)).alias(m) for n, m in (("doi", "doi"), ("uci", "uci"), ("url", "url"), ("fpage", "first_page"), ("lpage", "last_page"))],
        X.clean(j("issn")).alias("issn"), X.clean(j("eissn")).alias("eissn"),
        F.col("r_.articleInfo.`citation-count`._kci").alias("citation_count_kci"), F.col("r_.articleInfo.`citation-count`._wos").alias("citation_count_wos"),
        X.clean(a("orte-open-yn")).alias("is_open_access"), X.clean(a("verified")).alias("verified"),
    )


_LINKS = "array<struct<`@ref`:string,`@href`:string>>"
_AUTHORS = "array<struct<authname:string,`ce:indexed-name`:string,`ce:surname`:string>>"


def _get(c: Column, key: str) -> Column:
    return X.nonempty(X.strip(F.get_json_object(c, f"$['{key}']")))


def _one_or_many(c: Column, kind: str) -> Column:
    """A JSON array, or one object standing for an array of one."""
    return F.coalesce(F.from_json(c, kind), F.from_json(F.concat(F.lit("["), c, F.lit("]")), kind), F.array().cast(kind))


def preferred_link(c: Column) -> Column:
    links = F.filter(_one_or_many(F.get_json_object(c, "$['link']"), _LINKS), lambda x: X.nonempty(X.strip(x["@href"])).isNotNull())
    best = F.filter(links, lambda x: X.strip(x["@ref"]) == "scopus")
    return X.strip(F.coalesce(F.get(best, F.lit(0))["@href"], F.get(links, F.lit(0))["@href"]))


def json_entries(pages: DataFrame, column: str = "json") -> DataFrame:
    """One row per entry of search responses (column ``entry``), with the stated total."""
    entries = F.coalesce(F.from_json(F.get_json_object(column, "$['search-results']['entry']"), "array<string>"), F.array().cast("array<string>"))
    total = F.coalesce(X.safe_int(F.get_json_object(column, "$['search-results']['opensearch:totalResults']")), F.lit(0))
    return pages.withColumns({"total": total, "e_": entries}).withColumn("entry", F.explode("e_")).drop(column, "e_")


def parse_json(df: DataFrame, column: str = "entry", matched_query: Column | None = None) -> DataFrame:
    """Raw JSON records; broken JSON gives a row of nulls."""
    e = F.col(column)
    names = F.transform(_one_or_many(F.get_json_object(e, "$['author']"), _AUTHORS), lambda a: X.nonempty(X.strip(F.coalesce(X.nonempty(a["authname"]), a["ce:indexed-name"]))))
    authors = X.distinct_folded(F.array_compact(F.concat(F.array(_get(e, "dc:creator")), names)))
    words = F.concat(*[F.split(F.translate(F.coalesce(_get(e, k), F.lit("")), "|", ";"), ";") for k in ("authkeywords", "idxterms")])
    keywords = X.distinct_folded(F.filter(F.transform(words, X.strip), lambda w: w != ""))
    return df.select(
        *[c for c in df.columns if c != column],
        (matched_query if matched_query is not None else F.lit(None).cast("string")).alias("matched_query"),
        _get(e, "eid").alias("eid"), F.regexp_replace(_get(e, "dc:identifier"), "^SCOPUS_ID:", "").alias("scopus_id"), _get(e, "prism:doi").alias("doi"),
        _get(e, "dc:title").alias("title"), _get(e, "dc:description").alias("abstract"), preferred_link(e).alias("url"), _get(e, "prism:coverDate").alias("cover_date"),
        _get(e, "prism:publicationName").alias("publication_name"), _get(e, "prism:volume").alias("volume"), _get(e, "prism:issueIdentifier").alias("issue_identifier"),
        _get(e, "prism:issn").alias("issn"), _get(e, "prism:eIssn").alias("eissn"), authors.alias("author_names"), keywords.alias("keywords"),
        X.safe_int(_get(e, "citedby-count")).alias("cited_by_count"), _get(e, "subtype").alias("subtype"), _get(e, "subtypeDescription").alias("subtype_description"), e.alias("raw_item"),
    )


def parse_detail(df: DataFrame, column: str = "json") -> DataFrame:
    """Details of single records; lists of one may come as a bare object."""
    e = F.get_json_object(F.col(column), "$['abstracts-retrieval-response']")
    core = F.get_json_object(e, "$['coredata']")
    names = F.transform(_one_or_many(F.get_json_object(e, "$['authors']['author']"), _AUTHORS), lambda a: X.nonempty(X.strip(F.coalesce(X.nonempty(a["ce:indexed-name"]), a["ce:surname"]))))
    words = F.get_json_object(e, "$['authkeywords']['author-keyword']")
    kw = F.transform(_one_or_many(words, "array<string>"), lambda w: X.nonempty(X.strip(F.when(w.startswith("{"), F.get_json_object(w, "$['$']")).otherwise(w))))
    areas = F.transform(
        _one_or_many(F.get_json_object(e, "$['subject-areas']['subject-area']"), "array<struct<`@code`:string,`@abbrev`:string,`$`:string,code:string,abbrev:string,name:string>>"),
        lambda s: F.struct(X.nonempty(X.strip(F.coalesce(s["@code"], s["code"]))).alias("code"), X.nonempty(X.strip(F.coalesce(s["@abbrev"], s["abbrev"]))).alias("abbrev"), X.nonempty(X.strip(F.coalesce(s["$"], s["name"]))).alias("name")))
    return df.select(
        *[c for c in df.columns if c != column],
        _get(core, "dc:title").alias("title"), _get(core, "dc:description").alias("abstract"), preferred_link(core).alias("url"), _get(core, "prism:coverDate").alias("cover_date"),
        _get(core, "prism:publicationName").alias("publication_name"), _get(core, "dc:publisher").alias("publisher"), _get(core, "prism:issn").alias("issn"), _get(core, "prism:eIssn").alias("eissn"),
        X.distinct_folded(F.array_compact(names)).alias("author_names"), X.distinct_folded(F.array_compact(kw)).alias("keywords"),
        F.array_distinct(F.filter(areas, lambda s: s["code"].isNotNull())).alias("subject_areas"), X.safe_int(_get(core, "citedby-count")).alias("cited_by_count"), F.col(column).alias("raw_payload"),
    )


def dead_letters(parsed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows whose parse gave no key)."""
    return parsed.filter(F.col(key).isNotNull()), parsed.filter(F.col(key).isNull())
