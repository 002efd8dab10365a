"""Queries of the operators for training data, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.llm.increments import repeats
from paperloom.llm.languages import find_languages, found
from paperloom.llm.linkage import link
from paperloom.llm.names import link_names, name_pairs
from paperloom.llm.mixing import mix, rates, shares
from paperloom.llm.packing import pack, usage
from paperloom.llm.reading import reading_levels
from paperloom.llm.sentences import align
from paperloom.llm.survivors import survivors, values
from paperloom.llm.tokens import token_counts
from paperloom.session import cut, table, wide

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("p4_found")
def p4_found(spark, d):
    return name_pairs(link_names(wide(spark, d, "normalized_papers", "authors", "institution_id")))


@query("p5_found")
def p5_found(spark, d):
    return survivors(wide(spark, d, "normalized_papers", "ord", "source", "source_id", "doi", "updated_at", "abstract", "keywords", "matched_queries"))


@query("p5_values")
def p5_values(spark, d):
    return values(wide(spark, d, "normalized_papers", "ord", "source", "source_id", "doi", "updated_at", "abstract", "keywords", "matched_queries"))


@query("p1_found")
def p1_found(spark, d):
    docs = wide(spark, d, "documents", "doc_id", "text", "lang")
    papers = wide(spark, d, "normalized_papers", "ord", "title_kor", "title_other", "abstract_other")
    return found(find_languages(docs, papers))


@query("p3_found")
def p3_found(spark, d):
    papers = wide(spark, d, "normalized_papers", "ord", "abstract_kor", "abstract_eng")
    pairs = align(papers, "ord", "abstract_kor", "abstract_eng")
    return pairs.select(F.col("id").alias("ord"), F.col("a_no").alias("kor_no"), F.col("b_no").alias("eng_no"))


@query("p10_found")
def p10_found(spark, d):
    docs = wide(spark, d, "documents", "doc_id", "text", "lang")
    return reading_levels(docs, table(spark, d, "reading_labels")).select("doc_id", "read_level")


@query("p2_found")
def p2_found(spark, d):
    pairs = link(wide(spark, d, "kci_papers"), wide(spark, d, "scopus_papers"))
    return pairs.select(F.col("a_id").alias("kci_id"), F.col("b_id").alias("scopus_id"))


@query("p7_found")
def p7_found(spark, d):
    return repeats(wide(spark, d, "kci_corpus"), wide(spark, d, "corpus_batches"))


def _sizes(spark, d):
    return cut(token_counts(wide(spark, d, "documents", "doc_id", "text", "source"), keep=("source",)))


@query("p8_containers")
def p8_containers(spark, d):
    return pack(_sizes(spark, d), table(spark, d, "pack_specs"))


@query("p8_usage")
def p8_usage(spark, d):
    specs = table(spark, d, "pack_specs")
    return usage(pack(_sizes(spark, d), specs), specs)


@query("p9_mixture")
def p9_mixture(spark, d):
    return mix(_sizes(spark, d), table(spark, d, "mix_targets"))


@query("p9_shares")
def p9_shares(spark, d):
    sizes, targets = _sizes(spark, d), table(spark, d, "mix_targets")
    return shares(mix(sizes, targets), rates(sizes, targets))
