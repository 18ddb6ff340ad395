"""Kind, jurisdiction, rejection reasons and case name of each candidate.

Dimension tables are folded to one row per key before they are joined, so no join
multiplies candidates; every step adds columns, and a rejected row stays with its
reasons. Only the cutting of case names out of prose runs in Arrow batches.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.scalar import abbreviated_date_form_hit, blank, col, date_form_hit, nk, normalize_code, number, reasons, unpad, word_key

CONFIDENCE = {"estimated": 1, "inferred": 2, "confirmed": 3}
TOKEN_SHAPES = ("shape_bracket", "shape_bracket_range", "shape_neutral_bare", "shape_neutral_glued")


def unique_lookup(dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """CLS05: rows of keys that the table has exactly once."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in columns if c != key]).where("_n = 1").drop("_n")


def all_rows(dim: DataFrame, key: str, columns: list[str], out: str) -> DataFrame:
    """CLS06: all rows of each key as one array."""
    return dim.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(out))


def add_lookups(rows: DataFrame, courts: DataFrame, reporters: DataFrame, token: str = "token", small: bool = False) -> DataFrame:
    """The four lookups that CLS03, CLS04 and CLS11 need, as columns of each row.

    ``small`` says that the tables are dimensions: they travel to the rows, which stay where they are.

    courts: court_code, jurisdiction. reporters: abbreviation, jurisdiction, confidence, vol_from, vol_to, year_from, year_to.
    """
    ce = unique_lookup(courts, "court_code", ["court_code", "jurisdiction"]).select(F.col("court_code").alias("_k1"), F.struct("court_code", "jurisdiction").alias("court_exact"))
    c2 = courts.withColumn("_k", normalize_code("court_code"))
    cn = unique_lookup(c2, "_k", ["court_code", "jurisdiction"]).select(F.col("_k").alias("_k2"), F.struct("court_code", "jurisdiction").alias("court_norm"))
    fields = ["jurisdiction", "confidence", "vol_from", "vol_to", "year_from", "year_to"]
    re_ = all_rows(reporters, "abbreviation", fields, "reporter_exact").withColumnRenamed("abbreviation", "_k3")
    rn = all_rows(reporters.withColumn("_k", nk("abbreviation")), "_k", fields, "reporter_norm").withColumnRenamed("_k", "_k4")
    ce, cn, re_, rn = (F.broadcast(d) if small else d for d in (ce, cn, re_, rn))
    t = blank(token)
    out = rows.join(ce, t == F.col("_k1"), "left").join(cn, normalize_code(t) == F.col("_k2"), "left")
    return out.join(re_, t == F.col("_k3"), "left").join(rn, nk(t) == F.col("_k4"), "left").drop("_k1", "_k2", "_k3", "_k4")


def two_grade(rows: DataFrame, vol: str = "vol", year: str = "year_start") -> DataFrame:
    """CLS03, CLS04: courts and reporters by exact, then normalised spelling; the better grade wins, equal grades conflict.

    A volume bars the normalised court; a volume that is not the year withholds an exact one;
    a court that only matches normalised is withheld.
    """
    has_vol, v = blank(vol) != "", blank(vol)
    exact = F.col("court_exact").isNotNull() & (~has_vol | (v == blank(year)))
    norm = ~F.col("court_exact").isNotNull() & ~has_vol & F.col("court_norm").isNotNull()
    court_mode = F.when(exact, "exact").when(norm, "normalized")
    rep_mode = F.when(F.col("reporter_exact").isNotNull(), "exact").when(F.col("reporter_norm").isNotNull(), "normalized")
    r = rows.withColumn("_cm", court_mode).withColumn("_rm", rep_mode)
    both = F.col("_cm").isNotNull() & F.col("_rm").isNotNull()
    court_wins = F.col("_cm").isNotNull() & (F.col("_rm").isNull() | ((F.col("_cm") == "exact") & (F.col("_rm") == "normalized")))
    conflict = both & (F.col("_cm") == F.col("_rm"))
    kind = F.when(conflict, "ambiguous").when(court_wins, F.when(F.col("_cm") == "exact", "neutral").otherwise("ambiguous")).otherwise("reporter")
    neutral = court_wins & (F.col("_cm") == "exact")
    r = r.withColumn("citation_kind", kind).withColumn("table_conflict", F.coalesce(conflict, F.lit(False)))
    r = r.withColumn("lookup_mode", F.when(kind == "reporter", F.coalesce("_rm", F.lit(""))).otherwise(F.coalesce("_cm", F.lit(""))))
    return r.withColumn("court_jurisdiction", F.when(neutral, F.col("court_exact.jurisdiction"))).drop("_cm", "_rm")


def inside_range(value: Column, low: Column, high: Column, missing: int | None) -> Column:
    """CLS13: between the endpoints, open where an endpoint is missing; a missing value counts as ``missing``, or not at all."""
    ok = value.between(F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(99999)))
    return F.coalesce(F.coalesce(value, F.lit(missing)).between(F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(99999))) if missing is not None else ok, F.lit(missing is None))


def disambiguate(candidates: Column, vol: Column, year: Column) -> Column:
    """CLS12: the only jurisdiction whose windows take the volume and year, else UNSUPPORTED; neither printed is no evidence."""
    fits = F.filter(candidates, lambda c: inside_range(number(vol), c["vol_from"], c["vol_to"], 0) & inside_range(number(year), c["year_from"], c["year_to"], None))
    found = F.array_distinct(F.transform(fits, lambda c: blank(c["jurisdiction"])))
    none = number(vol).isNull() & number(year).isNull()
    return F.when(none | (F.size(found) != 1) | (F.get(found, 0) == ""), "UNSUPPORTED").otherwise(F.get(found, 0))


def weakest(rows: Column, cap: str | None = None) -> Column:
    """CLS14: the weakest confidence of some table rows, at most ``cap``."""
    rank = lambda c: F.coalesce(F.array_position(F.array(*[F.lit(x) for x in CONFIDENCE]), c["confidence"]).cast("int"), F.lit(1))
    low = F.array_min(F.transform(rows, rank))
    low = F.least(low, F.lit(CONFIDENCE[cap])) if cap else low
    return F.get(F.array(*[F.lit(x) for x in CONFIDENCE]), low - 1)


def jurisdiction(rows: DataFrame, vol: str = "vol", year: str = "year_start", prefix_jurisdiction: str | None = None) -> DataFrame:
    """CLS11: jurisdiction of reporters from their table rows; a series prefix must agree, one jurisdiction must fit its windows, several are told apart by structure."""
    c = F.coalesce("reporter_exact", "reporter_norm")
    juris = F.array_distinct(F.transform(c, lambda x: blank(x["jurisdiction"])))
    only = F.get(juris, 0)
    fit = F.filter(c, lambda x: inside_range(number(vol), x["vol_from"], x["vol_to"], None) & inside_range(number(year), x["year_from"], x["year_to"], None))
    pj = blank(prefix_jurisdiction) if prefix_jurisdiction else F.lit("")
    by_prefix = F.when(F.array_contains(juris, pj), pj).otherwise("UNSUPPORTED")
    one = F.when((F.size(fit) > 0) & (only != ""), only).otherwise("UNSUPPORTED")
    j = F.when(F.col("citation_kind") == "neutral", F.col("court_jurisdiction")).when(F.col("citation_kind") != "reporter", "UNSUPPORTED")
    j = j.when(c.isNull(), "UNSUPPORTED").when(pj != "", by_prefix).when(F.size(juris) == 1, one).otherwise(disambiguate(c, col(vol), col(year)))
    r = rows.withColumn("jurisdiction", j)
    chosen = F.filter(c, lambda x: blank(x["jurisdiction"]) == F.col("jurisdiction"))
    several = F.size(juris) > 1
    conf = F.when(F.col("jurisdiction") == "UNSUPPORTED", "unsupported").when(F.col("citation_kind") == "neutral", "confirmed").when(several, weakest(chosen, "inferred")).otherwise(weakest(chosen))
    how = F.when(~several | (F.col("jurisdiction") == "UNSUPPORTED") | (F.col("citation_kind") != "reporter"), "").when(pj != "", "series_prefix").when(blank(vol) == "", "novol_year").when(blank(year) == "", "vol_only").otherwise("vol_year")
    return r.withColumn("jurisdiction_confidence", conf).withColumn("disambiguated_by", F.coalesce(how, F.lit(""))).withColumn("vol_missing", F.coalesce((F.col("citation_kind") == "reporter") & several & (blank(vol) == ""), F.lit(False)))


def registered_id(identifies: Column, verification: Column, scope: Column) -> Column:
    """CLS07: struct(jurisdiction, reason) of a registered identifier: dockets and unverified prefixes are no decisions."""
    ok = blank(verification).startswith("verified")
    why = F.when(blank(identifies) == "docket", "docket_not_decision").when(~ok, "unverified_id_prefix").otherwise("")
    return F.struct(F.when(ok & (blank(scope) != ""), scope).otherwise("UNSUPPORTED").alias("jurisdiction"), why.alias("reason"))


def non_citation_word(abbr: Column, registered: Column, whole: list[str], first: list[str], last: list[str]) -> Column:
    """CLS09: a word of the closed lists in the reporter's place; a registered reporter always wins."""
    words = F.filter(F.transform(F.split(blank(abbr), r"\s+"), lambda w: word_key(w)), lambda w: w != "")
    hit = word_key(abbr).isin(*whole or [""]) | ((F.size(words) >= 2) & (F.get(words, 0).isin(*first or [""]) | F.element_at(words, -1).isin(*last or [""])))
    return ~registered & (F.size(words) > 0) & F.coalesce(hit, F.lit(False))


def non_case_material(abbr: Column, registered: Column, exact: dict[str, str], suffix: list[tuple[str, str]]) -> Column:
    """CLS10: the kind of material that is not a case, by key or by suffix pattern, else blank."""
    out = F.lit("")
    for pattern, material in reversed(suffix):
        out = F.when(blank(abbr).rlike(pattern), material).otherwise(out)
    for key, material in exact.items():
        out = F.when(nk(abbr) == key, material).otherwise(out)
    return F.when(registered, "").otherwise(out)


# Marks of statutes around a citation.
STATUTE, CHAPTER, STATUTE_CUT = r"(?:^|[\s,(])(?:R\.?\s?)?S\.?\s?C\.?\s*,?\s*(?:18|19|20)\d{2}", r"\bc(?:h|hap)?\.\s*[A-Z]?-?\d+", r"(?:R\.\s?S\.\s?C\.|S\.\s?C\.)\s*,?\s*$"


def rejections(rows: DataFrame, words: dict[str, list[str]] | None = None, materials: tuple[dict, list] = ({}, [])) -> DataFrame:
    """CLS08: the reasons against a row in rule order; the row stays."""
    w = {"whole": [], "first_word": [], "last_word": []} | (words or {})
    abbr, raw, pre = F.col("abbreviation"), blank("raw_string"), blank("preceding_text")
    known = F.col("reporter_exact").isNotNull() | F.col("reporter_norm").isNotNull()
    reporter = F.col("citation_kind") == "reporter"
    statute = (F.concat(F.lit(" "), raw).rlike(STATUTE) & F.concat_ws(" ", pre, raw).rlike(CHAPTER)) | pre.rlike(STATUTE_CUT)
    material = non_case_material(abbr, known, *materials)
    listed = reasons(
        ("table_conflict", F.col("table_conflict")),
        ("federal_statute", statute),
        ("party_initials", pre.rlike(r"\b[A-Z]\.\s*(?:v|c)\.\s*$") & raw.rlike(r"^[A-Z]\.")),
        ("date_form", date_form_hit(abbr, "vol", "page")),
        ("abbreviated_date_form", abbreviated_date_form_hit(abbr, "vol", "page")),
        ("non_citation_word", reporter & non_citation_word(abbr, known, w["whole"], w["first_word"], w["last_word"])),
        ("versus_as_page", reporter & ~known & (blank("page_roman") == "v")),
    )
    other = F.when(reporter & (material != ""), F.concat(F.lit("non_case_"), material))
    return rows.withColumn("rejected_reason", F.array_join(F.filter(F.array(F.when(listed != "", listed), other), lambda x: x.isNotNull()), "|"))


def volume_system(rows: DataFrame, rules: DataFrame, abbreviation: str = "abbreviation", vol: str = "vol", year: str = "year_start") -> DataFrame:
    """CLS15: the only volume system of the compatible rules (key, system, vol_from, vol_to, year_from, year_to)."""
    a = all_rows(rules, "key", ["system", "vol_from", "vol_to", "year_from", "year_to"], "_rules").withColumnRenamed("key", "_k")
    j = rows.join(a, nk(abbreviation) == F.col("_k"), "left")
    fit = F.filter("_rules", lambda x: inside_range(number(vol), x["vol_from"], x["vol_to"], None) & inside_range(number(year), x["year_from"], x["year_to"], None))
    one = F.array_distinct(F.transform(fit, lambda x: x["system"]))
    return j.withColumn("volume_system", F.when(F.size(one) == 1, F.get(one, 0)).otherwise("")).drop("_k", "_rules")


def court_designation(rows: DataFrame, table: DataFrame, scope: DataFrame, raw: str = "court_designation_raw", reporter: str = "abbreviation") -> DataFrame:
    """CLS16: a printed court label by a closed table (key, status, canonical_court); an ambiguous one by its reporter (key, reporter, canonical_court)."""
    t = unique_lookup(table, "key", ["status", "canonical_court"]).select(F.col("key").alias("_k"), F.col("status").alias("_st"), F.col("canonical_court").alias("_cc"))
    s = scope.select(F.col("key").alias("_sk"), F.col("reporter").alias("_sr"), F.col("canonical_court").alias("_sc")).dropDuplicates(["_sk", "_sr"])
    j = rows.join(t, nk(raw) == F.col("_k"), "left").join(s, (nk(raw) == F.col("_sk")) & (nk(reporter) == F.col("_sr")), "left")
    label = F.lower(F.trim(blank(raw)))
    bare_pc = F.trim(blank(raw)).rlike(r"(?i)^P\s*C$")
    rec = (F.col("_st") == "recognized") & (blank("_cc") != "") & ~bare_pc
    scoped = (F.col("_st") == "ambiguous_designation") & F.col("_sc").isNotNull() & ~bare_pc
    not_court = label.rlike(r"^\d+$") | label.contains("at p.") | label.contains("at para.") | label.startswith("per ") | label.contains("see above") | label.contains("emphasis") | label.startswith("sub nom")
    status = F.when(label == "", "").when(F.col("_k").isNotNull() & bare_pc, "ambiguous_designation").when(rec | scoped, "recognized").when(F.col("_k").isNotNull(), F.when(F.col("_st") == "recognized", "recognized").otherwise(F.coalesce("_st", F.lit("unrecognized")))).when(not_court, "not_a_court").otherwise("unrecognized")
    court = F.when(rec, F.col("_cc")).when(scoped, F.col("_sc")).otherwise("")
    return j.withColumn("court_designation_status", status).withColumn("observed_deciding_court", court).drop("_k", "_st", "_cc", "_sk", "_sr", "_sc")


def classify_suffixes(annotations: Column, courts: Column, services: list[str]) -> Column:
    """CLS17: struct(allowed, status, court) of the labels after a citation; ``courts`` maps label keys to courts. Several courts are a conflict."""
    key = lambda a: nk(a["raw"])
    service = lambda a: key(a).isin(*services or [""])
    allowed = F.filter(annotations, lambda a: service(a) | F.map_contains_key(courts, key(a)))
    seen = F.array_distinct(F.transform(F.filter(annotations, lambda a: ~service(a) & F.map_contains_key(courts, key(a))), lambda a: F.try_element_at(courts, key(a))))
    status = F.when(F.size(annotations) == 0, "").when(F.size(seen) > 1, "conflict").when(F.size(seen) == 1, "recognized").when(F.forall(annotations, service), "not_a_court").otherwise("unrecognized")
    return F.struct(F.transform(allowed, lambda a: a["raw"]).alias("allowed"), status.alias("status"), F.when(F.size(seen) == 1, F.get(seen, 0)).otherwise("").alias("court"))


# --- case names (CLS18-CLS25)
V = re.compile(r"(?<![\w.])(?:v|vs|c)\.(?=\s)|\b(?:v|versus)\b(?=\s+[A-Z(])")
# Closed word sets for the cutting of names.
LEAD_IN = re.compile(r"^(?:(?:see|voir|also|aussi|cf|compare|contra|accord|citing|citant|applying|following|per|in|and|et|but|e\.g|including|notably)\b[.,:]?\s*)+", re.IGNORECASE)
CONNECTORS = frozenset("of the and a an for de la le les du des et en aux d l".split())
PREFIX_NAME = re.compile(r"^(?:Re|In re|Ex parte|Reference re|Renvoi relatif|R\. c\.|Matter of)\b[:\s]")
TAIL_RE = re.compile(r"\(Re\)\s*,?\s*$")
ANONYMOUS = re.compile(r"^(?:Droit de la famille|LSJPA|Protection de la jeunesse|Adoption)\s*[—–-]\s*\d+")
CITE_TAIL = re.compile(r"[,;]?\s*(?:\[?\(?(?:1[6-9]|20)\d{2}\)?\]?)?[\s,]*\d*\s*(?:[A-Z][A-Za-z.]*\s*)*\d+\s*$")
PARAGRAPH, LETTER, PUNCTUATED = re.compile(r"^\s*\[\d{1,5}\]\s*"), re.compile(r"[^\W\d_]"), re.compile(r"[,;:.\s]+$")
YEAR_TAIL, BRACKETED = re.compile(r"\s*\((?:1[6-9]|20)\d{2}(?:[-–]\d{2,4})?\)$"), re.compile(r"\[(?:18|19|20)\d{2}\]")
EARLIER_CITE = re.compile(r"(?:\d+\s+[A-Z][A-Za-z.]*\.?\s*(?:\(\w+\)\s*)?\d+|\b(?:1[6-9]|20)\d{2}\s+[A-Z]{2,12}\s+\d+)(?:\s*\([^)]*\))?\s*[,;]\s*")
WORD, SEGMENT_END, FIRST_WORD = re.compile(r"\S+"), re.compile(r"[;:\n]"), re.compile(r"(\S+)\s+")
NESTED_FRENCH = re.compile(r"\bcitant\s+(Renvoi\s+(?:sur|relatif)\b[^;:\n]*?)\s*,?\s*$")


def name_like(word: str) -> bool:
    w = word.strip("().,&;:'’“”[]")
    return not w or w[0].isupper() or w[0].isdigit() or w.lower() in CONNECTORS or w in ("v", "vs", "c", "re", "ex", "rel")


def trim_left(name: str) -> str:
    """CLS20: drop prose before the first party: everything up to the last word left of v. that no name has."""
    m = None
    for m in V.finditer(name):
        pass
    if m is None:
        return name
    cut = 0
    for w in WORD.finditer(name[: m.start()]):
        if not name_like(w[0]):
            cut = w.end()
    kept = name[cut:].lstrip(" ,;:")
    while (first := FIRST_WORD.match(kept)) and first[1].lower() in CONNECTORS and first[1].islower():
        kept = kept[first.end() :]
    return kept if V.search(kept) and not V.match(kept) else name


def admit(name: str) -> tuple[str, str]:
    """CLS19, CLS21: the cleaned name, or why it is none."""
    s = LEAD_IN.sub("", PARAGRAPH.sub("", name)).strip()  # a paragraph number is no party
    if s[-1:].isdecimal():  # where a citation's tail ends
        shorter = CITE_TAIL.sub("", s).strip()
        if shorter != s and LETTER.search(shorter) and len(V.findall(shorter)) == len(V.findall(s)) and shorter[-1] not in "—–-":  # a number after a dash belongs to an anonymous name
            s = shorter
    s = PUNCTUATED.sub("", s) if s[-1:] in ",;:." or s[-1:].isspace() else s
    s = (YEAR_TAIL.sub("", s) if s[-1:] == ")" else s).rstrip(" ,;")
    s = trim_left(s)
    why = "too_long" if len(s) > 120 else "has_bracketed_year" if BRACKETED.search(s) else "multi_v" if len(V.findall(s)) >= 2 else "" if s else "empty_after_clean"
    return ("", why) if why else (s, "")


def last_run(text: str) -> str | None:
    """CLS22, CLS23: of a string of citations the last name, which starts after the last earlier citation."""
    ends = [m.end() for m in EARLIER_CITE.finditer(text)]
    if not ends:
        return None
    rest = text[ends[-1] :].strip()
    return rest if V.search(rest) else None


def cut_name(pre: str | None) -> tuple[str, str]:
    """CLS18, CLS24, CLS25: the case name at the end of the text before a citation, or why there is none."""
    pre = pre or ""
    segment = SEGMENT_END.split(pre)[-1].strip()
    if m := NESTED_FRENCH.search(segment):
        return m[1].strip(), ""
    if not V.search(segment):
        plain = segment.rstrip(",").strip()
        if PREFIX_NAME.match(plain) or ANONYMOUS.match(plain):
            return admit(plain)
        if TAIL_RE.search(segment):
            words = list(WORD.finditer(plain))
            start = len(plain)
            for w in reversed(words):
                if not name_like(w[0]):
                    break
                start = w.start()
            if plain[start : start + 1].isupper() or plain[start : start + 1].isdigit() or plain[start : start + 1] == "(":
                return admit(plain[start:])
    hits = list(V.finditer(pre))
    if not hits:
        return "", "no_v_structure"
    last = hits[-1]
    after = pre[last.end() :]
    if ";" in after and (tail := after[after.rfind(";") + 1 :].lstrip(" \t\r\n\"'‘“«"))[:1].isalpha():
        return "", "name_belongs_to_later_segment"
    start = max(pre.rfind(x, 0, last.start()) for x in ";:\n")
    whole = pre[start + 1 :].strip().rstrip(",").strip()
    later = last_run(whole)
    if start < 0 and later is None:
        return "", "no_separator_before_v"
    return admit(later or whole)


def _cut_series(pre: pd.Series) -> pd.DataFrame:
    told = {x: cut_name(x) for x in set(pre)}  # several readings of one place have one text before them
    return pd.DataFrame([told[x] for x in pre], columns=["name", "reason"])


def case_names(rows: DataFrame, preceding: str = "preceding_text") -> DataFrame:
    """CLS18 (Arrow): adds candidate_case_name and name_rejected_reason."""
    cut = F.pandas_udf(_cut_series, "name string, reason string")
    r = rows.withColumn("_cut", cut(col(preceding)))
    return r.withColumn("candidate_case_name", F.col("_cut.name")).withColumn("name_rejected_reason", F.col("_cut.reason")).drop("_cut")


def self_citation(raw: Column, source: Column) -> Column:
    """CLS26: the row cites its own document."""
    own = F.when(F.instr(blank(source), "_") > 0, F.substring_index(blank(source), "_", -1)).otherwise(blank(source))
    return (own != "") & (unpad(nk(raw)) == unpad(own))


def parse_status(conflict: Column, shape: Column, vol: Column, juris: Column) -> Column:
    """CLS27."""
    year_vol = (blank(shape) == "shape_vol_abbr_page") & blank(vol).rlike(r"^(?:1[6-9]|20)\d{2}$") & (blank(juris) == "UNSUPPORTED")
    return F.when(blank(conflict).isin("cross_boundary_year_page", "year_reread_as_vol"), "structurally_conflicted").when(year_vol, "ambiguous_year_vol").otherwise("valid")


def row_status(rejected: Column, not_citation: tuple[str, ...] = ("date_form", "abbreviated_date_form", "non_citation_word", "party_initials", "versus_as_page", "federal_statute")) -> Column:
    """CLS28."""
    why = F.filter(F.split(blank(rejected), r"\|"), lambda x: x != "")
    return F.when(F.size(why) == 0, "citation_counted").when(F.exists(why, lambda x: x.isin(*not_citation)), "not_citation").otherwise("citation_uncounted")


#: The columns of candidates that ``classify`` reads.
READS = "shape_name token abbr leading_abbr vol year_start page page_roman raw_string preceding_text source_decision_citation structural_conflict".split()


def classify(rows: DataFrame, courts: DataFrame, reporters: DataFrame, identifiers: DataFrame | None = None, prefixes: DataFrame | None = None, words: dict | None = None, materials: tuple[dict, list] = ({}, [])) -> DataFrame:
    """CLS01, CLS02: all steps in order. identifiers: token, identifier_kind, scope; prefixes: prefix, jurisdiction.

    The dimension tables are broadcast: few printed abbreviations make up most rows, and a shuffle by them would put those in a few tasks.
    """
    spark = rows.sparkSession
    token = F.col("shape_name").isin(*TOKEN_SHAPES)
    r = rows.withColumn("abbreviation", F.when(token | (F.col("shape_name") == "shape_registered_id"), F.col("token")).otherwise(F.col("abbr")))
    r = two_grade(add_lookups(r, courts, reporters, "abbreviation", small=True))
    r = r.withColumn("citation_kind", F.when(token, F.col("citation_kind")).when(F.col("shape_name") == "shape_registered_id", "identifier").otherwise("reporter")).withColumn("table_conflict", F.col("table_conflict") & token)
    r = r.withColumn("court_jurisdiction", F.when(token, F.col("court_jurisdiction")))
    ids = identifiers if identifiers is not None else spark.createDataFrame([], "token string, identifier_kind string, scope string")
    i = unique_lookup(ids, "token", ["identifier_kind", "scope"]).select(F.col("token").alias("_it"), F.col("identifier_kind").alias("_ik"), F.col("scope").alias("_is"))
    r = r.join(F.broadcast(i), F.col("abbreviation") == F.col("_it"), "left")
    p = prefixes if prefixes is not None else spark.createDataFrame([], "prefix string, jurisdiction string")
    p = unique_lookup(p.withColumn("_pk", normalize_code("prefix")), "_pk", ["jurisdiction"]).select("_pk", F.col("jurisdiction").alias("_pj"))
    r = r.join(F.broadcast(p), (F.col("shape_name") == "shape_leading_abbr") & (normalize_code("leading_abbr") == F.col("_pk")), "left")
    r = r.withColumn("series_prefix", F.when(F.col("_pk").isNotNull(), F.col("leading_abbr")).otherwise(""))
    ident = token & F.col("_it").isNotNull()
    r = r.withColumn("citation_kind", F.when(ident, "identifier").otherwise(F.col("citation_kind"))).withColumn("lookup_mode", F.when(ident, "exact").otherwise(F.col("lookup_mode")))
    r = jurisdiction(r, prefix_jurisdiction="_pj")
    r = r.withColumn("jurisdiction", F.when(ident, blank("_is")).otherwise(F.col("jurisdiction")))
    r = rejections(r, words, materials)
    extra = F.array(
        F.when(F.col("rejected_reason") != "", F.col("rejected_reason")),
        F.when((F.col("shape_name") == "shape_leading_abbr") & F.col("_pk").isNull(), F.lit("unrecognized_series_prefix")),
        F.when(F.col("_ik") == "secondary_source", F.lit("not_a_decision")),
    )
    r = r.withColumn("rejected_reason", F.array_join(F.filter(extra, lambda x: x.isNotNull()), "|"))
    r = case_names(r)
    r = r.withColumn("self_citation", self_citation(F.col("raw_string"), F.col("source_decision_citation")))
    r = r.withColumn("parse_status", parse_status(F.col("structural_conflict"), F.col("shape_name"), F.col("vol"), F.col("jurisdiction")))
    return r.drop("court_exact", "court_norm", "reporter_exact", "reporter_norm", "court_jurisdiction", "table_conflict", "_it", "_ik", "_is", "_pk", "_pj")
