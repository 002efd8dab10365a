"""Text expressions, all JVM-side: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in a Unicode-aware \\s.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
# Letters whose full case folding is longer than their lower case.
FOLDS = {"ß": "ss", "ẞ": "ss", "ſ": "s", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ς": "σ"}
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
HANGUL = "[가-힣]"
KEYWORD_DELIMITERS = WS + r"*[;|,\n\t]" + WS + "*"
SENTENCE_END = r"(?<=[.!?。])" + WS + "+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty(c) -> Column:
    """Null for the empty string."""
    return F.nullif(col(c), F.lit(""))


def first_nonempty(*cs) -> Column:
    return F.coalesce(*[nonempty(c) for c in cs])


def fold(c) -> Column:
    """Case folding: lower case plus the letters of FOLDS (others of the rare full foldings stay as they are)."""
    out = F.lower(col(c))
    for k, v in FOLDS.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def strip(c) -> Column:
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def squeeze(c) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), WS + "+", " "))


def no_space(c) -> Column:
    return F.regexp_replace(col(c), WS, "")


def has_hangul(c) -> Column:
    return col(c).rlike(HANGUL)


def title_key(c) -> Column:
    """Letters, digits and underscores, folded; null if nothing is left."""
    return nonempty(fold(F.regexp_replace(col(c), r"[^\p{L}\p{N}_]+", "")))


def safe_int(c) -> Column:
    """Whole decimal numbers only; null otherwise."""
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?\d+(_\d+)*$"), F.replace(s, F.lit("_"), F.lit("")).try_cast("int"))


def pub_date(year, month) -> Column:
    y, m = col(year), col(month)
    padded = F.when(F.length(m) < 2, F.lpad(m, 2, "0")).otherwise(m)
    return F.when(nonempty(y).isNull(), None).when(nonempty(m).isNull(), y).otherwise(F.concat(y, F.lit("-"), padded))


def normal_date(c) -> Column:
    """YYYY-M-D, YYYY-M and YYYY become padded dates; other text stays, stripped; null for null and empty."""
    t = strip(c)
    p = [F.regexp_extract(t, r"^(\d{4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?$", i) for i in (1, 2, 3)]
    month = F.lpad(p[1], 2, "0")
    day = F.try_to_date(F.when(p[2] != "", F.concat_ws("-", p[0], month, F.lpad(p[2], 2, "0"))), "yyyy-MM-dd")
    good_month = p[1].try_cast("int").between(1, 12)
    return (
        F.when(nonempty(col(c)).isNull(), None)
        .when(day.isNotNull(), F.date_format(day, "yyyy-MM-dd"))
        .when((p[0] != "") & (p[2] == "") & (p[1] != "") & good_month, F.concat_ws("-", p[0], month))
        .when((p[0] != "") & (p[1] == ""), p[0])
        .otherwise(t)
    )


def leading_year(c) -> Column:
    return nonempty(F.regexp_extract(col(c), r"^(\d{4})", 1)).try_cast("int")


def issue_of(volume, issue) -> Column:
    return nonempty(F.concat_ws("_", nonempty(volume), nonempty(issue)))


def tri_state(c) -> Column:
    return F.when(col(c) == "Y", True).when(col(c) == "N", False)


def unescape(c) -> Column:
    """The predefined entities and non-breaking space; ampersands last, so that nothing is unescaped twice."""
    out = col(c)
    for k, v in ENTITIES.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def clean(c) -> Column:
    """Unescaped and stripped; null if empty."""
    return nonempty(strip(unescape(c)))


def distinct_folded(a) -> Column:
    """The first of each group of elements equal when folded, in order."""
    a = col(a)
    folded = F.transform(a, fold)
    return F.filter(a, lambda x, i: F.array_position(folded, fold(x)) == i + 1)


def union_folded(a, b) -> Column:
    empty = F.array().cast("array<string>")
    return distinct_folded(F.concat(F.coalesce(col(a), empty), F.coalesce(col(b), empty)))


def split_keywords(c) -> Column:
    """A delimited text, or an array of such texts, as distinct trimmed keywords."""
    text = col(c)
    parts = F.transform(F.split(text, KEYWORD_DELIMITERS), strip)
    return distinct_folded(F.filter(parts, lambda x: x != ""))


def json_list(c) -> Column:
    """A JSON array of strings; empty where it is null or broken."""
    return F.coalesce(F.from_json(col(c), "array<string>"), F.array().cast("array<string>"))


def subject_codes(c) -> Column:
    """Codes of a JSON array (strings or objects with ``code``) or of text divided by | and ;."""
    v = col(c)
    parsed = F.from_json(v, "array<string>")
    codes = F.transform(parsed, lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.code")).otherwise(x))
    plain = F.split(F.translate(v, "|", ";"), ";")
    items = F.when(v.isNull(), F.array().cast("array<string>")).when(parsed.isNotNull() & v.rlike(r"^\s*\["), codes).otherwise(plain)
    return F.array_distinct(F.filter(F.transform(items, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != ""))


def sentences(c) -> Column:
    return F.filter(F.transform(F.split(col(c), SENTENCE_END), strip), lambda x: x != "")


def summary(abstract, title, keywords, existing=None, n: int = 2) -> Column:
    """An existing summary, else the first sentences of the abstract, else its start, else title and keywords."""
    a = nonempty(abstract)
    head = nonempty(strip(F.array_join(F.slice(sentences(a), 1, n), " ")))
    kw = F.when(F.coalesce(F.size(col(keywords)), F.lit(0)) > 0, F.array_join(F.slice(col(keywords), 1, 5), ", ")).otherwise(F.lit("키워드 없음"))
    fallback = F.concat(F.coalesce(nonempty(title), F.lit("제목 없음")), F.lit(" | keywords: "), kw)
    made = F.when(a.isNotNull(), F.coalesce(head, F.substring(a, 1, 300))).otherwise(fallback)
    return made if existing is None else F.coalesce(nonempty(existing), made)


def join_nonempty(a, sep: str = "; ") -> Column:
    return F.array_join(F.filter(col(a), lambda x: x.isNotNull() & (x != "")), sep)


# Legal forms that organisations put before or after their names, and words before former or present names.
LEGAL_FORMS = ("사단법인", "재단법인", "공익사단법인", "공익재단법인")
LEGAL_MARKS = ("(사)", "（사）", "(재)", "（재）")
NAME_TIMES = ("구.", "구 ", "전.", "전 ", "현.", "현 ")


def simple_org(c) -> Column:
    """Folded letters and digits of an organisation's name without its legal form."""
    out = fold(c)
    for w in (*LEGAL_FORMS, *LEGAL_MARKS):
        out = F.replace(out, F.lit(w), F.lit(""))
    return F.regexp_replace(out, r"[^\p{L}\p{N}]", "")


def org_variants(c) -> Column:
    """Simple forms of the whole name, of the name without bracketed parts, and of each bracketed part."""
    whole = squeeze(F.coalesce(col(c), F.lit("")))
    bare = squeeze(F.regexp_replace(whole, r"\([^)]*\)", " "))
    times = "^(?:" + "|".join(w.replace(".", "\\.") for w in NAME_TIMES) + ")"
    inner = F.transform(F.regexp_extract_all(whole, F.lit(r"\(([^)]*)\)"), F.lit(1)), lambda x: strip(F.regexp_replace(squeeze(x), times, "")))
    names = F.concat(F.array(whole, bare), inner)
    return F.array_distinct(F.filter(F.transform(names, simple_org), lambda x: x != ""))
