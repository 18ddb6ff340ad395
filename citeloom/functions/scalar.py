"""Scalar expressions of the citation model, as Spark columns.

Every function takes and returns columns and stays inside code generation; the
three that need Unicode tables Spark lacks are Arrow functions and say so.
Blank strings count as absent, and an absent value never turns into a guess.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank(x: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(col(x).cast("string"), F.lit(""))


def present(x: Column | str) -> Column:
    """True where a string has anything but white space."""
    return F.coalesce(col(x).rlike(r"(?U)\S"), F.lit(False))


# --- keys


def nk(x: Column | str) -> Column:
    """FN01: ASCII letters and digits only, in lower case (stripped first: lower() maps the Kelvin sign to k)."""
    return F.lower(F.regexp_replace(blank(x), "[^A-Za-z0-9]", ""))


def normalize_code(x: Column | str) -> Column:
    """FN02: without full stops, white space and hyphens, in upper case."""
    return F.upper(F.regexp_replace(blank(x), r"(?U)[.\s\-]", ""))


def unpad(x: Column | str) -> Column:
    """FN03: without zeros between a letter and a digit."""
    return F.regexp_replace(blank(x), r"(?<=[a-z])0+(?=\d)", "")


def collapse_space(x: Column | str) -> Column:
    """FN04: each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(blank(x), r"(?U)\s+", " "))


def word_key(x: Column | str) -> Column:
    """FN05: a word of a word list: letters only, lower case."""
    return F.lower(F.regexp_replace(blank(x), r"[^\p{L}]", ""))


MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def month_name(x: Column | str) -> Column:
    """FN06: the English month that a slot names in full, else null."""
    w = word_key(x)
    return F.when(w.isin(*MONTHS), w)


def number(x: Column | str) -> Column:
    return F.when(F.trim(blank(x)).rlike(r"^\d{1,9}$"), F.trim(blank(x)).cast("int"))


def date_form_hit(abbr: Column | str, vol: Column | str, page: Column | str) -> Column:
    """FN07: a date read as a citation: a month between a day and a year."""
    return F.coalesce(number(vol).between(1, 31) & number(page).between(1600, 2099) & month_name(abbr).isNotNull(), F.lit(False))


def abbreviated_date_form_hit(abbr: Column | str, vol: Column | str, page: Column | str) -> Column:
    """FN08: as FN07 with the first three or four letters of exactly one month."""
    w = word_key(abbr)
    starts = sum((F.lit(m).startswith(w).cast("int") for m in MONTHS), F.lit(0))
    return F.coalesce(number(vol).between(1, 31) & number(page).between(1600, 2099) & F.length(w).isin(3, 4) & (starts == 1), F.lit(False))


def reasons(*pairs: tuple[str, Column]) -> Column:
    """FN09: the names of the true conditions, in the order given, joined by |."""
    return F.array_join(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]), lambda x: x.isNotNull()), "|")


def canon_series(x: Column | str) -> Column:
    """FN10: (4th), 4th and 4d as 4d."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.trim(blank(x)), r"^[()]+|[()]+$", "")), "(st|nd|rd|th)$", "d")


def series_component(series_paren, series, paren_note, shape) -> Column:
    """FN11: ordinal in parentheses, else plain ordinal, else n: and the note; a nominate note only if ordinal."""
    note = F.trim(blank(paren_note))
    ordinal = note.rlike(r"^\(?\s*\d+(?:st|nd|rd|th|d)\s*\)?$")
    return (
        F.when(blank(series_paren) != "", canon_series(series_paren))
        .when(blank(series) != "", canon_series(series))
        .when((note != "") & (blank(shape) == "shape_nominate"), F.when(ordinal, canon_series(note)).otherwise(""))
        .when(note != "", F.concat(F.lit("n:"), nk(note)))
        .otherwise("")
    )


def abbr_component(abbreviation, series_prefix) -> Column:
    p = nk(series_prefix)
    return F.when(p != "", F.concat(p, F.lit("."), nk(abbreviation))).otherwise(nk(abbreviation))


def merge_key_v1(year, vol, abbreviation, series, page, series_prefix=None) -> Column:
    """FN12: year|vol|abbr|series|page with empty slots kept."""
    prefix = F.lit("") if series_prefix is None else series_prefix
    return F.concat_ws("|", blank(year), blank(vol), abbr_component(abbreviation, prefix), F.lower(blank(series)), blank(page))


def merge_key_v2(year, vol, abbreviation, series_slot, page, page_roman=None, series_prefix=None) -> Column:
    """FN13: v1 with the canonical series slot (FN11) and roman pages marked ro:."""
    prefix = F.lit("") if series_prefix is None else series_prefix
    roman = F.lit("") if page_roman is None else blank(page_roman)
    where = F.when(roman != "", F.concat(F.lit("ro:"), F.lower(F.trim(roman)))).otherwise(blank(page))
    return F.concat_ws("|", blank(year), blank(vol), abbr_component(abbreviation, prefix), blank(series_slot), where)


def family_key(merge_key: Column | str) -> Column:
    """FN14: the key with an empty year slot."""
    return F.regexp_replace(col(merge_key), r"^[^|]*\|", "|")


def key_part(merge_key: Column | str, i: int) -> Column:
    """FN15: slot i of a key: 0 year, 1 vol, 2 abbr, 3 series, 4 page."""
    return F.get(F.split(col(merge_key), r"\|"), i)


def row_year(year_printed, merge_key) -> Column:
    """FN16: the printed year, else the key's, as an int."""
    return F.coalesce(number(year_printed), number(key_part(merge_key, 0)))


def parse_name_classes(x: Column | str) -> Column:
    """FN17: name:n|name:n as map<string,int>."""
    parts = F.filter(F.split(blank(x), r"\|"), lambda p: p.contains(":"))
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(F.substring_index(p, ":", 1), F.substring_index(p, ":", -1).cast("int"))))


def fact_id(**parts: Column | str) -> Column:
    """FN18: SHA-256 of the compact JSON of the parts in the order of their names."""
    body = F.to_json(F.struct(*[col(parts[k]).alias(k) for k in sorted(parts)]), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)


# Words of case names that tell nothing about the parties.
CONTEXT_STOP = frozenset("the and of for a an in re ex parte et al inc ltd co corp company limited v vs c r regina rex canada attorney general minister".split())


def _context_tokens(name: str | None) -> list[str]:
    plain = "".join(c for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c)).lower()
    if not re.search(r"\b(?:v|vs|c)\b\.?", plain):
        return []
    return sorted({w for w in re.findall(r"[a-z]+", plain) if len(w) >= 3 and w not in CONTEXT_STOP})


def _context_series(names: pd.Series) -> pd.Series:
    return names.map(_context_tokens)


def case_context_tokens(names: Column | str) -> Column:
    """FN19 (Arrow): party words of a name that has v, vs or c, without accents."""
    return F.pandas_udf(_context_series, "array<string>")(col(names))


def one_edit(a: Column | str, b: Column | str) -> Column:
    """FN20: exactly one insertion, deletion or substitution apart."""
    return F.levenshtein(col(a), col(b)) == 1


def title_key(x: Column | str) -> Column:
    """FN22: without a year in parentheses at the end, letters and digits in lower case."""
    return nk(F.regexp_replace(blank(x), r"\s*\(\d{4}\)\s*$", ""))


def year_of(x: Column | str) -> Column:
    """FN23: leading four digits as an int."""
    return F.when(blank(x).rlike(r"^\d{4}"), F.substring(blank(x), 1, 4).cast("int"))


def prose_score(x: Column | str) -> Column:
    """FN24: 1 less the share of digits and brackets, less 0.06 per case name, less a half for a list's head."""
    t = blank(x)
    marks = F.length(t) - F.length(F.regexp_replace(t, r"[0-9()\[\]]", ""))
    names = F.regexp_count(t, F.lit(r" v\. "))
    head = t.rlike(r"^\s*(?i:cases cited|authorities|jurisprudence)")
    return 1.0 - marks / F.greatest(F.length(t), F.lit(1)) - 0.06 * names - F.when(head, 0.5).otherwise(0.0)


def spread(x: Column | str) -> Column:
    """FN25: a stable pseudo-random order key."""
    return F.md5(blank(x))


def source_year(source_id: Column | str) -> Column:
    """FN26: the first four digits that look like a year after the court's underscore."""
    y = F.regexp_extract(blank(source_id), r"_((?:1[6-9]|20)\d{2})", 1)
    return F.when(y != "", y.cast("int"))


def dd_bucket(dd: Column | str) -> Column:
    """FN27: 1, 2-4, 5-9, 10+."""
    d = col(dd)
    return F.when(d >= 10, "10+").when(d >= 5, "5-9").when(d >= 2, "2-4").otherwise("1")


def dd_band(dd: Column | str) -> Column:
    """FN27: the sampling bands 0-4, 5-19, 20-99, 100+."""
    d = col(dd)
    return F.when(d >= 100, "100+").when(d >= 20, "20-99").when(d >= 5, "5-19").otherwise("0-4")


def era(year: Column | str) -> Column:
    """FN27: the sampling eras."""
    y = col(year)
    return F.when(y.isNull(), "unknown").when(y < 1950, "before 1950").when(y < 1982, "1950-1981").when(y < 2000, "1982-1999").otherwise("2000 on")


def _folded(x: pd.Series) -> pd.Series:
    return x.map(lambda s: s.casefold() if s is not None else None)


def casefold(x: Column | str) -> Column:
    """FN28 (Arrow): Unicode case folding, which lower() is not."""
    return F.pandas_udf(_folded, "string")(col(x))


def contains_literal(x: Column | str, needle: str) -> Column:
    """FN29: the needle as it is, no wildcards."""
    return F.instr(blank(x), needle) > 0


def valid_date(x: Column | str) -> Column:
    """FN30: the first ten characters as a date of the Gregorian calendar, else null."""
    s = F.substring(blank(x), 1, 10)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))


def decade(year: Column | str) -> Column:
    """FN31."""
    return (F.floor(col(year) / 10) * 10).cast("int")


def passage(text, start, end, before: int = 300, after: int = 300) -> Column:
    """FN32: the text around [start, end), code points from 0, with white space collapsed."""
    a = F.greatest(col(start) - before, F.lit(0))
    return collapse_space(F.substring(col(text), (a + 1).cast("int"), (col(end) + after - a).cast("int")))


def query_terms(q: Column | str) -> Column:
    """FN33: the distinct terms of a question with at least three characters, as they stand."""
    return F.filter(F.array_distinct(F.split(F.lower(blank(q)), r"(?U)[^\p{L}\p{N}]+")), lambda w: F.length(w) >= 3)


def unit(v: Column | str) -> Column:
    """FN34: the vector at length 1; the zero vector stays."""
    x = F.transform(col(v), lambda a: a.cast("double"))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, a: s + a * a))
    return F.when(norm > 0, F.transform(x, lambda a: a / norm)).otherwise(x)


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


_DATE = r"((?:January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}, \d{4}|\d{4}-\d{2}-\d{2})"


def header_dates(header: Column | str, limit: int = 12) -> Column:
    """FN35: the first distinct dates printed in a header."""
    found = F.regexp_extract_all(blank(header), F.lit(_DATE), 1)
    day = lambda s: F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "MMMM d, yyyy"))
    return F.slice(F.array_distinct(F.filter(F.transform(found, day), lambda d: d.isNotNull())), 1, limit)


def history_eligible(citing_court, cited_court, citing_year, cited_year, is_lower) -> Column:
    """FN36: the same or a lower court, not later."""
    later = F.coalesce(col(cited_year) > col(citing_year), F.lit(False))
    return ((col(citing_court) == col(cited_court)) | F.coalesce(col(is_lower), F.lit(False))) & ~later


def gap_text(previous_end, start, preceding_text) -> Column:
    """FN37: the text between two mentions from the later one's preceding text; null if it does not reach."""
    n = col(start) - col(previous_end)
    pre = blank(preceding_text)
    return F.when(n == 0, F.lit("")).when((n > 0) & (n <= F.length(pre)), F.substring(pre, (F.length(pre) - n + 1).cast("int"), n.cast("int")))


def parallel_gap(gap: Column | str, labels: Column | None = None) -> Column:
    """FN38: a comma, or a comma and at most two printed labels out of ``labels`` (array<string>)."""
    g = col(gap)
    plain = g.rlike(r"(?U)^\s*,\s*$")
    if labels is not None:
        said = F.regexp_extract_all(g, F.lit(r"\(([^()]*)\)"), 1)
        rest = F.regexp_replace(g, r"\([^()]*\)", "")
        known = F.forall(said, lambda s: F.array_contains(labels, s))
        plain = plain | (rest.rlike(r"(?U)^\s*,\s*$") & F.size(said).between(1, 2) & known & ~g.contains(";"))
    return F.coalesce(plain, F.lit(False))
