"""Raw records to canonical records: projections only, nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.schema import CANONICAL, PAPER

_EMPTY = "array<string>"


def canonical(df: DataFrame, columns: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """All canonical fields in order, those not given as null (lists as empty), with the canonical types."""
    out = []
    for f in PAPER.fields:
        kind = f.dataType.simpleString()
        given = columns.get(f.name)
        if given is None:
            given = F.array() if kind == _EMPTY else F.lit(None)
        out.append(given.cast(kind).alias(f.name))
    return df.select(*keep, *out)


def normalize_xml(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of the XML service.  Empty strings are missing values throughout; lists are distinct when folded."""
    title = X.first_nonempty("title_original", "title_english", "title_foreign")
    kw = X.distinct_folded(F.flatten(F.transform(F.coalesce("keywords", F.array().cast(_EMPTY)), lambda x: X.split_keywords(F.coalesce(x, F.lit(""))))))
    kor, eng = F.filter(kw, X.has_hangul), F.filter(kw, lambda x: ~X.has_hangul(x))
    q = X.nonempty("matched_query")
    return canonical(raw, {
        "source": F.lit("kci"),
        "source_id": F.coalesce(X.first_nonempty("arti_id", "doi", "uci"), title, F.lit("unknown")),
        "title": title, "title_kor": F.col("title_original"), "title_eng": F.col("title_english"), "title_other": F.col("title_foreign"),
        "doi": F.col("doi"), "uci": F.col("uci"), "url": F.col("url"),
        "abstract": X.first_nonempty("abstract_original", "abstract_english"),
        "abstract_kor": F.col("abstract_original"), "abstract_eng": F.col("abstract_english"),
        "keywords": kw,
        "keyword_text_kor": X.nonempty(F.array_join(kor, "; ")), "keyword_text_eng": X.nonempty(F.array_join(eng, "; ")),
        "authors": F.coalesce("authors", F.array().cast(_EMPTY)),
        "journal_id": X.first_nonempty("journal_id", "journal_name"), "institution_id": F.col("publisher_name"),
        "issue_id": X.issue_of("volume", "issue"),
        "first_page": F.col("first_page"), "final_page": F.col("last_page"), "issn": F.col("issn"), "eissn": F.col("eissn"),
        "subject_code": F.col("article_categories"), "is_fulltext": X.tri_state("is_open_access"),
        "registered_at": X.pub_date("pub_year", "pub_mon"), "publication_year": X.safe_int("pub_year"),
        "matched_queries": F.when(q.isNull(), F.array().cast(_EMPTY)).otherwise(F.array(q)),
        "raw_payload": F.to_json(F.struct("arti_id", "matched_field", "verified", "citation_count_kci", "citation_count_wos", "article_regularity")),
    }, keep)


def normalize_json(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of the JSON service."""
    none = F.array().cast(_EMPTY)
    kw = F.coalesce("keywords", none)
    q = X.nonempty("matched_query")
    return canonical(raw, {
        "source": F.lit("scopus"),
        "source_id": F.coalesce(X.first_nonempty("scopus_id", "doi", "title"), F.lit("unknown")),
        "title": F.col("title"), "title_eng": F.col("title"), "doi": F.col("doi"), "url": F.col("url"),
        "abstract": F.col("abstract"), "abstract_eng": F.col("abstract"),
        "keywords": X.distinct_folded(F.flatten(F.transform(kw, lambda x: X.split_keywords(F.coalesce(x, F.lit("")))))),
        "keyword_text_eng": X.nonempty(F.array_join(kw, "; ")),
        "authors": F.coalesce("author_names", none), "journal_id": F.col("publication_name"),
        "issue_id": X.issue_of("volume", "issue_identifier"), "issn": F.col("issn"), "eissn": F.col("eissn"),
        "registered_at": X.normal_date("cover_date"), "publication_year": X.leading_year("cover_date"),
        "matched_queries": F.when(q.isNull(), none).otherwise(F.array(q)), "raw_payload": F.col("raw_item"),
    }, keep)


def from_stored(stored: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored rows (lists as JSON text) to canonical records; broken JSON gives an empty list, unstored fields their defaults."""
    have = set(stored.columns)
    lists = {"keywords": "keywords_json", "authors": "authors_json", "categories": "category", "matched_keywords": "matched_keywords_json", "relevance_reasons": "relevance_reasons_json"}
    cols = {n: F.col(n) for n in CANONICAL if n in have}
    cols |= {n: X.json_list(c) for n, c in lists.items() if c in have}
    if "raw_payload_json" in have:
        cols["raw_payload"] = F.coalesce("raw_payload_json", F.lit("{}"))
    return canonical(stored, cols, keep)


def to_stored(papers: DataFrame, keep: tuple[str, ...] = (), clean_lists: bool = True) -> DataFrame:
    """Canonical records to stored rows.  Lists lose blanks, ``*`` and repeats; reasons fall back to the matched keywords."""

    def tidy(c):
        v = F.coalesce(c, F.array().cast(_EMPTY))
        return X.distinct_folded(F.filter(F.transform(v, X.strip), lambda x: x.isNotNull() & ~x.isin("", "*"))) if clean_lists else v

    mk = tidy("matched_keywords")
    why = tidy("relevance_reasons")
    json_cols = {
        "keywords": ("keywords_json", F.coalesce("keywords", F.array().cast(_EMPTY))), "authors": ("authors_json", F.coalesce("authors", F.array().cast(_EMPTY))),
        "categories": ("category", tidy("categories")), "matched_keywords": ("matched_keywords_json", mk),
        "relevance_reasons": ("relevance_reasons_json", F.when(F.size(why) > 0, why).otherwise(mk)),
    }
    out = []
    for n in CANONICAL:
        if n in ("matched_queries", "keyword_text_kor", "keyword_text_eng", "keyword_text_other"):
            continue
        if n in json_cols:
            name, c = json_cols[n]
            out.append(F.to_json(c).alias(name))
        elif n == "raw_payload":
            out.append(F.col(n).alias("raw_payload_json"))
        else:
            out.append(F.col(n))
    return papers.select(*keep, *out)


def checked_evidence(stored: DataFrame) -> DataFrame:
    """Fails the job at the first record of the XML source without category or matched keyword."""
    bad = (F.col("source") == "kci") & (F.col("category").isin("", "[]") | F.col("matched_keywords_json").isin("", "[]"))
    return stored.withColumn("source_id", F.when(bad, F.raise_error(F.concat(F.lit("no category or matched keyword evidence: "), "source_id"))).otherwise(F.col("source_id")))


def seed_keywords(papers: DataFrame, matched_field: str = "matched_field") -> DataFrame:
    """Records found through their keywords and without any take the queries (but ``*``) as keywords."""
    seed = F.filter("matched_queries", lambda x: x != "*")
    return papers.withColumn("keywords", F.when((F.size("keywords") == 0) & (F.col(matched_field) == "keyword"), seed).otherwise(F.col("keywords")))


def summarize(papers: DataFrame, sentences: int = 2) -> DataFrame:
    return papers.withColumn("summary", X.summary("abstract", "title", "keywords", "summary", sentences))
