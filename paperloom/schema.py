"""The canonical record and the raw records, as explicit Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _A = T.StringType(), T.ArrayType(T.StringType())


def _struct(strings: str, arrays: str = "", ints: str = "") -> T.StructType:
    f = [T.StructField(n, _S) for n in strings.split()] + [T.StructField(n, _A) for n in arrays.split()] + [T.StructField(n, T.IntegerType()) for n in ints.split()]
    return T.StructType(f)


_KINDS = {
    "keywords": _A, "authors": _A, "categories": _A, "matched_keywords": _A, "matched_queries": _A, "relevance_reasons": _A,
    "page_count": T.IntegerType(), "publication_year": T.IntegerType(), "is_fulltext": T.BooleanType(), "is_relevant": T.BooleanType(),
    "relevance_score": T.DoubleType(),
}
# Fields of the canonical record, in order.
CANONICAL = """source source_id title title_kor title_eng title_other doi uci url abstract abstract_kor abstract_eng abstract_other
keywords keyword_text_kor keyword_text_eng keyword_text_other authors journal_id institution_id issue_id first_page final_page
page_count issn eissn subject_code is_fulltext registered_at updated_at publication_year categories matched_keywords matched_queries
relevance_score relevance_reasons is_relevant summary raw_payload""".split()
PAPER = T.StructType([T.StructField(n, _KINDS.get(n, _S), n not in ("source", "source_id")) for n in CANONICAL])
RAW_XML = _struct(
    "matched_query matched_field arti_id journal_id journal_name publisher_name pub_year pub_mon volume issue article_categories article_regularity "
    "title_original title_foreign title_english abstract_original abstract_english doi uci url first_page last_page issn eissn "
    "citation_count_kci citation_count_wos is_open_access verified", "keywords authors")
RAW_JSON = _struct(
    "matched_query eid scopus_id doi title abstract url cover_date publication_name volume issue_identifier issn eissn subtype subtype_description raw_item",
    "author_names keywords", "cited_by_count")
DETAIL = T.StructType(_struct("title abstract url cover_date publication_name publisher issn eissn raw_payload", "author_names keywords", "cited_by_count").fields + [
    T.StructField("subject_areas", T.ArrayType(_struct("code abbrev name")))])
# Columns of an exported row, in order.
EXPORT = """source source_id category keywords title title_kor title_eng doi url abstract paper_keywords authors journal_id institution_id
issue_id issn subject_code registered_at publication_year relevance_score summary""".split()
