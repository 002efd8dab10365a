"""Link the spellings of one person or organisation through canonical rewritings.

Every distinct string is rewritten to canonical forms (script, token order, initials, nicknames, legal forms,
abbreviations, one-letter slips); forms are exploded and equi-joined.  A rewriting counts as far as it is rare: its
score is 1 / (number of entities that share it), and only forms with a score above ``min_score`` link.

Scale.  The rows are made distinct (with map-side combine) before anything else, so a name that holds a third of
all rows is one string afterwards.  All joins are equi-joins on forms; the only collected table is the lexicon of
research fields, whose entries each hold at least ``LEXICON_FLOOR`` of the evidence (thus at most 1/LEXICON_FLOOR).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut

# The letters of the public romanisation of Korean, by index of the syllable's parts.
LEADS = "g kk n d tt r m b pp s ss _ j jj ch k t p h".replace("_", "").split(" ")
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" ")
TAILS = "_ k k k n n n t l k l l l l l m p p t t ng t t k t p h".replace("_", "").split(" ")
# Given names that people take beside their own.
NICKNAMES = set(
    "abby adam alan alex alice amy andy angela anna ben betty bill bob brian carol charlie chris cindy dave david diana "
    "emily emma eric eva frank fred gary george grace hannah harry helen henry iris jack jake james jane jason jay jenny "
    "jerry jim joe john joy judy julia justin kate kelly ken kevin leo lily linda lisa lucy luke maria mark martin mary "
    "matt max michael mike nancy nick nina olivia oscar paul peter rachel ray robert rose ruby ryan sam sarah sean sophie "
    "stella steve susan ted theo tim tina tom tony victor wendy will".split()
)
NOBODY = re.compile(r"(?:외\s*\d*\s*(?:인|명)?|et\.?\s*al\.?|and others|u\.?\s*a\.?|others|기타|등)\s*$", re.IGNORECASE)
MARK = re.compile(r"[*†‡§¶#0-9⁰¹²³⁴-⁹]+")
ROLE = re.compile(r"[(\[（][^()\[\]（）]*(?:저자|교신|공동|author|책임)[^()\[\]（）]*[)\]）]", re.IGNORECASE)
HANGUL = re.compile("[가-힣]")
LEXICON_FLOOR = 1e-4


def romanize(s: str) -> str:
    out = []
    for ch in s:
        i = ord(ch) - 0xAC00
        out.append(LEADS[i // 588] + VOWELS[i % 588 // 28] + TAILS[i % 28] if 0 <= i < 11172 else ch)
    return "".join(out)


def _letters(s: str) -> str:
    return re.sub(r"[^a-z]", "", "".join(c for c in unicodedata.normalize("NFKD", s.casefold()) if not unicodedata.combining(c)))


def _syllables(s: str) -> list[str]:
    """Syllables of a romanised name; a consonant before a vowel opens a syllable."""
    return re.findall(r"(?:ch|kk|tt|pp|ss|jj|[^aeiouwy])?[wy]?[aeiou]+(?:(?:ng|[^aeiouwy])(?![aeiouwy]|h[aeiou])(?:g(?![aeiouwy]))?)?", s) or [s]


def _heads(s: str) -> list[str]:
    """The possible first syllables of a given name, open and closed."""
    y = _syllables(s)[0]
    return [y, *({re.sub(r"[^aeiouwy]+$", "", y)} - {y})]


def _initials(s: str) -> str:
    return "".join(y[0] for y in _syllables(s))


def person(s: str) -> tuple[str | None, str | None, str, list[str]]:
    """(entity key of a full name, its key in Hangul, skeleton, partial forms).  No key and no forms: nobody."""
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", ROLE.sub(" ", s))).strip()
    if NOBODY.fullmatch(s):
        return None, None, "", []
    inner = re.search(r"[(\[]([^()\[\]]*)[)\]]", s)
    parts = [re.sub(r"[(\[][^()\[\]]*[)\]]?", " ", s)] + ([inner[1]] if inner else [])
    kor = next((p for p in parts if HANGUL.search(p)), None)
    lat = next((p for p in parts if not HANGUL.search(p) and re.search(r"[A-Za-z]", p)), None)
    if kor:
        t = MARK.sub("", kor).replace(",", " ").split()
        t = [re.sub(r"[^가-힣]", "", x) for x in t]
        t = [x for x in t if x]
        if len(t) == 2:
            a, b = sorted(map(romanize, t))
            return f"{a}|{b}", "".join(t), "".join(t), []
        if t:
            joined = romanize("".join(t))
            return None, "".join(t), "".join(t), [f"cat:{joined}"]
    if not lat:
        return None, None, "", []
    lat = MARK.sub("", lat).strip(" .;") + ("." if re.search(r"\b[A-Z]\.\s*$", lat) else "")
    family = None
    if "," in lat:
        family, _, rest = lat.partition(",")
        toks = [family, *rest.split()]
    else:
        toks = lat.split()
    if len(toks) < 2:
        x = _letters(lat)
        return None, None, x, [f"cat:{x}"] if len(x) > 5 else []
    short = [bool(re.fullmatch(r"(?:[A-Za-z]\.-?)+(?:[A-Za-z]\.?)?|[A-Z](?:-?[A-Z]){0,2}", x)) for x in toks]
    skeleton = " ".join(map(_letters, toks))
    if any(short) and not all(short):
        fam = _letters("".join(x for x, h in zip(toks, short) if not h))
        ini = _letters("".join(x for x, h in zip(toks, short) if h))
        return None, None, skeleton, [f"ini:{fam}:{ini}"]
    words = [_letters(x) for x in toks]
    words = [w for w in words if w]
    if len(words) > 2:
        return None, None, skeleton, [f"cat:{''.join(words)}", f"cat:{words[-1]}{''.join(words[:-1])}"]
    if len(words) < 2:
        return None, None, skeleton, []
    for g, f in ((words[0], words[1]), (words[1], words[0])):
        if g in NICKNAMES and (family is None or _letters(family) == f):
            return None, None, skeleton, [f"nick:{f}"]
    for g, f in ((words[0], words[1]), (words[1], words[0])):
        if _syllables(g) == [g] and re.search("[wy]?[aeiou]+", g)[0] in VOWELS and len(_syllables(f)) > 1:
            return None, None, skeleton, [f"pre:{f}:{g}"]
    a, b = sorted(words)
    return f"{a}|{b}", None, skeleton, []


def rewritings(key: str) -> list[str]:
    """The partial forms that the full name may be written in, for either token order."""
    a, _, b = key.partition("|")
    out = []
    for f, g in ((a, b), (b, a)):
        out += [f"cat:{f}{g}", f"ini:{f}:{g[:1]}", f"ini:{f}:{_initials(g)}", f"nick:{f}"]
        out += [f"pre:{f}:{y}" for y in _heads(g)]
    return sorted(set(out))


# Legal forms and the words for kinds of organisation, with their abbreviations.
LEGAL = re.compile(r"^\s*(?:\(?\s*[사재주]\s*\)|사단법인|재단법인|주식회사|㈔|㈜|㈶)\s*|\s*(?:\(\s*[사재주]\s*\)|㈔|㈜|㈶)\s*$")
KINDS_KOR = (("학회", "society"), ("연구원", "institute"), ("연구소", "university"))
WORDS = {"inst": "institute", "soc": "society", "univ": "university", "res": "research", "dept": "department", "assn": "association"}
STOP = {"the", "of", "for", "and", "in", "at", "affiliated"}
KINDS_ENG = ("university", "society", "institute", "research")


def organisation(s: str) -> tuple[str | None, list[str] | None]:
    """(Hangul without legal form, spaces and affiliation words; English tokens), each None where absent."""
    s = unicodedata.normalize("NFKC", s.replace("㈔", "(사)").replace("㈶", "(재)").replace("㈜", "(주)"))
    s = re.sub(r"\s+", " ", s).strip()
    for _ in range(2):
        s = LEGAL.sub("", s)
    inner = re.search(r"[(\[]([^()\[\]]*)[)\]]?\s*$", s)
    parts = [re.sub(r"[(\[][^()\[\]]*[)\]]?\s*$", "", s)] + ([inner[1]] if inner else [])
    kors = [p for p in parts if HANGUL.search(p)]
    kor = None
    if kors:
        kors = [re.sub(r"대(?=\s+\S)", "대학교", k) if not re.search("대학", k) else k for k in kors]
        k = kors[1] + kors[0] if len(kors) > 1 else kors[0]
        kor = re.sub(r"부설|부속|[^가-힣]", "", k)
    eng = next((p for p in parts if not HANGUL.search(p) and re.search(r"[A-Za-z]{2}", p)), None)
    toks = None
    if eng:
        toks = [WORDS.get(w, w) for w in re.findall(r"[a-z]+", eng.casefold())]
        toks = [w for w in toks if w not in STOP] or None
    return kor, toks


def near(a: str, b: str) -> bool:
    """At most one insertion, deletion, substitution or swap of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    ra, rb = a[i:], b[i:]
    return ra[1:] == rb[1:] or ra[1:] == rb or ra == rb[1:] or (ra[:2] == rb[:2][::-1] and ra[2:] == rb[2:])


def _english_field(toks: list[str], name: str) -> str:
    return " ".join(w for w in toks if w != name and w not in KINDS_ENG)


def field_evidence(kor: str | None, toks: list[str] | None) -> tuple[str, str] | None:
    """(field in Hangul, field in English) of a string that gives the organisation in both."""
    if not kor or not toks:
        return None
    for suffix, _ in KINDS_KOR:
        if kor.endswith(suffix):
            body = kor[: -len(suffix)]
            for n in range(len(body) - 1, 0, -1):
                name = romanize(body[:n])
                if name in toks:
                    rest = body[n:]
                    rest = rest[3:] if rest.startswith("대학교") else rest
                    return (rest, _english_field(toks, name)) if rest else None
    return None


class Organisations:
    """Canonical keys 'name|field|kind' from the learned lexicon of fields."""

    def __init__(self, fields: dict[str, str]):
        self.fields = dict(sorted(fields.items(), key=lambda x: (-len(x[0]), x)))
        self.english = sorted(set(fields.values()), key=lambda x: (-len(x.split()), x))
        self.words = sorted({w for f in self.english for w in f.split()} | set(KINDS_ENG))

    def _word(self, w: str) -> str:
        if w in self.words or len(w) < 4:
            return w
        hits = [x for x in self.words if near(w, x)]
        return hits[0] if len(hits) == 1 else w

    def hangul(self, kor: str) -> tuple[str, str] | None:
        """(romanised key, key with the name in Hangul) of the reading with the fewest slips, one at most."""
        best: tuple | None = None
        for suffix, kind in KINDS_KOR:
            for cut_ in (len(suffix), len(suffix) - 1, len(suffix) + 1):
                end, body = kor[-cut_:], kor[:-cut_]
                kslip = int(end != suffix)
                if not body or (kslip and not near(end, suffix)):
                    continue
                for f, e in self.fields.items():
                    for m in (len(f), len(f) - 1, len(f) + 1):
                        if not 0 < m < len(body):
                            continue
                        slip = kslip + int(body[-m:] != f)
                        if slip > 1 or (best and slip >= best[0]) or (body[-m:] != f and not near(body[-m:], f)):
                            continue
                        name = body[:-m]
                        at = name.rfind("대학교")
                        if kind == "university":
                            if at > 0:
                                name = name[:at] + name[at + 3 :]
                            else:
                                n = next((k for k in (3, 2, 4) if len(name) > k and near(name[-k:], "대학교")), None)
                                if n is None or slip:
                                    continue
                                name, slip = name[:-n], slip + 1
                        elif at > 0:
                            continue
                        if not best or slip < best[0]:
                            best = (slip, f"{romanize(name)}|{e}|{kind}", f"{name}|{e}|{kind}")
        return best[1:] if best else None

    def latin(self, toks: list[str]) -> str | None:
        toks = [self._word(w) for w in toks]
        kind = next((k for k in ("university", "society", "institute") if k in toks), None)
        rest = [w for w in toks if w not in KINDS_ENG]
        if kind:
            for f in self.english:
                ws = f.split()
                if all(w in rest for w in ws) and len(rest) > len(ws):
                    left = list(rest)
                    for w in ws:
                        left.remove(w)
                    return f"{''.join(left)}|{f}|{kind}"
        return None


def _deletes(c: str) -> F.Column:
    """The text itself and every text with one character less."""
    return F.concat(
        F.array(F.col(c)),
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c))),
            lambda i: F.concat(F.substring(F.col(c), F.lit(1), i - 1), F.substring(F.col(c), i + 1, F.length(c))),
        ),
    )


def slips(df: DataFrame) -> DataFrame:
    """df: key, text, weight.  key -> better: the one key of more weight whose text is one slip away.

    Deletion neighbourhoods are exploded and equi-joined, then checked exactly: one edit or one swap.  Only a key
    written in one way (weight 1) can be a slip, and only if there is just one such neighbour; of two keys of weight 1
    that are neighbours of each other alone, the larger is taken as the slip.
    """
    forms = df.select("key", "text", "weight", F.explode(F.array_distinct(_deletes("text"))).alias("form"))
    a = forms.filter("weight = 1").select("form", F.col("key").alias("a"), F.col("text").alias("at"))
    b = forms.select("form", F.col("key").alias("b"), F.col("text").alias("bt"), "weight")
    lev = F.levenshtein("at", "bt", 2)
    swap = (lev == 2) & (F.length("at") == F.length("bt")) & (
        F.array_sort(F.split("at", "")) == F.array_sort(F.split("bt", ""))
    )
    hit = a.join(b, "form").filter("a <> b").filter((lev == 1) | swap).select("a", "b", "weight").distinct()
    one = hit.groupBy("a").agg(
        F.count_if(F.col("weight") > 1).alias("strong"), F.count("*").alias("n"), F.min_by("b", F.struct(-F.col("weight"), "b")).alias("better")
    )
    sure = one.filter("strong = 1").select(F.col("a").alias("key"), "better")
    pair = one.filter("strong = 0 and n = 1 and better < a")
    back = one.filter("strong = 0 and n = 1").select(F.col("a").alias("x"), F.col("better").alias("y"))
    mutual = pair.join(back, (F.col("better") == F.col("x")) & (F.col("a") == F.col("y"))).select(F.col("a").alias("key"), "better")
    return sure.unionByName(mutual)


def _people(names: DataFrame, min_score: float) -> DataFrame:
    """names: name -> (name, entity)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(0).to_pylist()
            p = [person(x) for x in v]
            yield pa.RecordBatch.from_pydict(
                {"name": v, "key": [x[0] for x in p], "hangul": [x[1] for x in p], "skeleton": [x[2] for x in p],
                 "forms": pa.array([x[3] for x in p], pa.list_(pa.string()))})

    parsed = cut(names.mapInArrow(parse, "name string, key string, hangul string, skeleton string, forms array<string>"))
    full = parsed.filter("key is not null")
    keys = full.groupBy("key").agg(F.count("*").alias("weight"), F.max("hangul").alias("hangul"))
    latin = slips(
        keys.select("key", F.replace("key", F.lit("|"), F.lit(" ")).alias("text"), "weight")
        .unionByName(keys.select("key", F.concat_ws(" ", F.split_part("key", F.lit("|"), F.lit(2)), F.split_part("key", F.lit("|"), F.lit(1))).alias("text"), "weight"))
    )
    hangul = slips(keys.filter("hangul is not null").select("key", F.col("hangul").alias("text"), "weight"))
    better = latin.unionByName(hangul).groupBy("key").agg(F.min("better").alias("better"), F.countDistinct("better").alias("n")).filter("n = 1")
    full = full.select("name", "key").join(better.select("key", "better"), "key", "left").select(
        "name", F.coalesce("better", "key").alias("entity")
    )
    full = cut(full)

    def expand(batches):
        for b in batches:
            ent, forms = [], []
            for k in b.column(0).to_pylist():
                for f in rewritings(k):
                    ent.append(k)
                    forms.append(f)
            yield pa.RecordBatch.from_pydict({"entity": ent, "form": forms})

    table = full.select("entity").distinct().mapInArrow(expand, "entity string, form string")
    scored = table.groupBy("form").agg(F.countDistinct("entity").alias("n"), F.min("entity").alias("entity"))
    scored = scored.withColumn("score", 1 / F.col("n"))
    partial = parsed.filter("key is null").select("name", F.explode("forms").alias("form"))
    hit = partial.join(scored.filter(F.col("score") > min_score), "form").groupBy("name").agg(
        F.min("entity").alias("entity"), F.countDistinct("entity").alias("n")
    )
    found = hit.filter("n = 1").select("name", "entity")
    # partial forms of nobody's full name still link among themselves when they are written with the same letters
    rest = (
        partial.join(hit.select("name"), "name", "left_anti").filter("form like 'cat:%' or form like 'ini:%'")
        .groupBy("name").agg(F.min("form").alias("entity"))
    )
    return full.unionByName(found).unionByName(rest)


def _organisations(names: DataFrame) -> DataFrame:
    """names: name -> (name, entity)."""

    def parse(batches):
        for b in batches:
            v = b.column(0).to_pylist()
            p = [organisation(x) for x in v]
            e = [field_evidence(*x) or (None, None) for x in p]
            yield pa.RecordBatch.from_pydict(
                {"name": v, "kor": pa.array([x[0] for x in p], pa.string()), "eng": pa.array([x[1] for x in p], pa.list_(pa.string())),
                 "fk": pa.array([x[0] for x in e], pa.string()), "fe": pa.array([x[1] for x in e], pa.string())})

    parsed = cut(names.mapInArrow(parse, "name string, kor string, eng array<string>, fk string, fe string"))
    seen = parsed.filter("fk is not null").groupBy("fk", "fe").agg(F.count("*").alias("n"))
    total = seen.agg(F.sum("n")).first()[0] or 0
    rows = seen.filter(F.col("n") >= total * LEXICON_FLOOR).toPandas().sort_values(["n", "fk", "fe"], ascending=[False, True, True])
    fields: dict[str, str] = {}
    strong: dict[str, int] = {}
    for fk, fe, n in zip(rows["fk"], rows["fe"], rows["n"]):
        # a slip of a stronger entry is no field of its own
        if fk in fields or any(near(fk, x) and strong[x] > 2 * n for x in fields):
            continue
        if fe and not any(near(fe, x) and x != fe for x in fields.values()):
            fields[fk], strong[fk] = fe, n
    org = names.sparkSession.sparkContext.broadcast(Organisations(fields))

    def key(batches):
        for b in batches:
            d = b.to_pydict()
            ks, hs = [], []
            for kor, eng in zip(d["kor"], d["eng"]):
                h = org.value.hangul(kor) if kor else None
                k = h[0] if h else None
                if eng and not k:
                    k = org.value.latin(eng)
                ks.append(k or (f"h:{kor}" if kor else "l:" + " ".join(sorted(eng)) if eng else None))
                hs.append(h[1] if h else (kor or None))
            yield pa.RecordBatch.from_pydict(
                {"name": d["name"], "key": pa.array(ks, pa.string()), "hangul": pa.array(hs, pa.string()), "kor": pa.array(d["kor"], pa.string()),
                 "skeleton": [k or re.sub(r"\W", "", n.casefold()) for k, n in zip(d["kor"], d["name"])]})

    keyed = cut(parsed.mapInArrow(key, "name string, key string, hangul string, kor string, skeleton string").filter("key is not null"))
    keys = keyed.groupBy("key").agg(F.count("*").alias("weight"), F.min("hangul").alias("hangul"))
    better = (
        slips(keys.select("key", F.col("key").alias("text"), "weight"))
        .unionByName(slips(keys.filter("hangul is not null").select("key", F.col("hangul").alias("text"), "weight")))
        .groupBy("key").agg(F.min("better").alias("better"), F.countDistinct("better").alias("n")).filter("n = 1")
    )
    return keyed.select("name", "key").join(better.select("key", "better"), "key", "left").select(
        "name", F.coalesce("better", "key").alias("entity")
    )


def link_names(df: DataFrame, authors: str = "authors", institution: str = "institution_id", min_score: float = 0.5) -> DataFrame:
    """Rows kind, name, entity: one per distinct string, entity being the canonical form it is linked to.

    Null and blank strings, and strings for unnamed further authors, name nobody and give no row; repeated rows count once;
    a partial form that fits several entities equally (a tie) stays alone; an empty table gives no rows.
    """
    a = df.select(F.explode(F.col(authors)).alias("name")).filter("trim(name) <> ''").distinct()
    o = df.select(F.col(institution).alias("name")).filter("trim(name) <> ''").distinct()
    return (
        _people(a, min_score).withColumn("kind", F.lit("author"))
        .unionByName(_organisations(o).withColumn("kind", F.lit("institution")))
        .select("kind", "name", "entity")
    )


def name_pairs(links: DataFrame) -> DataFrame:
    """All pairs of strings of one entity (the result that is asked for), the smaller by code points first."""
    a = links.select("kind", "entity", F.col("name").alias("name_lo"))
    b = links.select("kind", "entity", F.col("name").alias("name_hi"))
    return a.join(b, ["kind", "entity"]).filter("name_lo < name_hi").select("kind", "name_lo", "name_hi").distinct()
