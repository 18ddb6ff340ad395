"""Source checks: one row per document, by expressions; nothing is deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank, nk, present

# Printed marks of court documents.
CONTENT = r"(?im)^[ \t]*(?:Decision Content|Contenu de la décision)[ \t]*$"
BODY = r"(?im)^[ \t]*(?:\[\d{1,5}\][ \t]*|(?:JUDGMENT AND REASONS|REASONS FOR DECISION|ENDORSEMENT|ORDER|JUDGMENT|MOTIFS DU JUGEMENT)[ \t]*$|UPON\b|THE COURT:)"
DATE = r"(?im)^[ \t]*DATE[ \t]*:[ \t]*(?:\r?\n[ \t]*)?\(?(\d{4}(?:[-/]\d{2}[-/]\d{2}|\d{4}))\)?[ \t]*\r?$"
CITATION = r"(?im)^[ \t]*(?:CITATION|RÉFÉRENCE)[ \t]*:"
HEADER_FIELD = r"(?m)^[ \t]*[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ /()-]{1,60}[ \t]*:"
NEUTRAL = r"(?<!\w)((?:18|19|20)\d{2})[ \t]*([A-Z][A-Z.]{1,11})[ \t]*(\d{1,7})(?!\w)"
SIGNATURE = r"^(?:[\"“”']\s*[A-Z][\w .,'’()-]{0,80},\s*(?:[A-Z]\.){1,4}[\"“”']|The Honourable (?:Mr\.? |Madam |Chief )?(?:Justice|Judge) [A-Z][\w .,'’()-]{0,80})$"


def header_region(text: Column) -> Column:
    """INT02: what stands after the web wrapper's marker and before the first body marker."""
    t = blank(text)
    rest = F.when(t.rlike(CONTENT), F.get(F.split(t, CONTENT, 2), 1)).otherwise(t)
    return F.get(F.split(rest, BODY, 2), 0)


def neutral_keys(text: Column, root: Column | None = None) -> Column:
    """INT05: year:code:number of each neutral citation; ``root`` (map code to canonical code) joins languages; zero numbers are dropped."""
    years, codes, numbers = (F.regexp_extract_all(blank(text), F.lit(NEUTRAL), i) for i in (1, 2, 3))
    each = F.arrays_zip(years.alias("y"), codes.alias("c"), numbers.alias("n"))
    code = lambda x: nk(x) if root is None else F.coalesce(F.try_element_at(root, nk(x)), nk(x))
    keys = F.transform(each, lambda x: F.when(x["n"].cast("int") > 0, F.concat_ws(":", x["y"], code(x["c"]), x["n"].cast("int").cast("string"))))
    return F.filter(keys, lambda k: k.isNotNull())


def native_date(text: Column, provider_date: Column, year_min: int = 1800, ahead: int = 1) -> Column:
    """INT03: struct(date, status, conflict, year, basis) of the dates in the header's DATE fields."""
    found = F.regexp_extract_all(header_region(text), F.lit(DATE), 1)
    parsed = F.transform(found, lambda s: F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "yyyy/MM/dd"), F.try_to_date(s, "yyyyMMdd")))
    days = F.array_distinct(F.filter(parsed, lambda d: d.isNotNull()))
    one, py = F.get(days, 0), F.year(provider_date)
    in_range = (F.year(one) >= year_min) & (py.isNull() | (F.year(one) <= py + ahead))
    status = F.when(F.size(found) == 0, "NO_FORMAL_DATE").when(F.size(days) == 0, "INVALID_DATE").when(F.size(days) > 1, "AMBIGUOUS_DATES").when(~in_range, "OUT_OF_RANGE").otherwise("RESOLVED")
    ok = status == "RESOLVED"
    conflict = F.when(ok & py.isNotNull(), F.when(F.year(one) == py, "AGREES").otherwise("CONFLICT")).otherwise("NOT_COMPARED")
    return F.struct(
        F.when(ok, one).alias("date"), status.alias("status"), conflict.alias("conflict"),
        F.coalesce(py, F.when(ok, F.year(one))).alias("year"), F.when(py.isNotNull(), "provider").when(ok, "native").otherwise("unknown").alias("basis"),
    )


def own_citation(text: Column, citation: Column, root: Column | None = None) -> Column:
    """INT04: what the header's citation field says about the document's own citation."""
    head = header_region(text)
    field = F.get(F.split(head, CITATION, 2), 1)
    block = F.get(F.split(field, HEADER_FIELD, 2), 0)
    has = head.rlike(CITATION) & field.rlike(HEADER_FIELD)
    printed, known = F.array_distinct(neutral_keys(block, root)), neutral_keys(citation, root)
    return (
        F.when(~F.coalesce(has, F.lit(False)), "NO_VERIFIED_CITATION")
        .when(F.size(printed) == 0, F.when(block.rlike(r"\d"), "MALFORMED").otherwise("NO_VERIFIED_CITATION"))
        .when(F.size(known) != 1, "METADATA_NOT_COMPARABLE")
        .when(F.size(printed) > 1, F.when(F.array_contains(printed, F.get(known, 0)), "AMBIGUOUS").otherwise("MISMATCH"))
        .when(F.get(printed, 0) == F.get(known, 0), "MATCH")
        .otherwise("MISMATCH")
    )


def text_integrity(text: Column, name: Column, citation: Column) -> Column:
    """INT06: incomplete where nothing but title lines and judges' signatures is left; no length decides."""
    t = blank(text)
    rest = F.when(t.rlike(CONTENT), F.get(F.split(t, CONTENT, 2), 1)).otherwise(t)
    lines = F.filter(F.transform(F.split(rest, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    sign = lambda x: x.rlike(SIGNATURE)
    n, c = nk(name), nk(citation)
    title = lambda x: (nk(x) != "") & nk(x).isin(n, c, F.concat(c, n))
    bad = F.forall(lines, lambda x: sign(x) | title(x)) & F.exists(lines, sign) & F.exists(lines, title)
    return F.when(~present(t), "MISSING_TEXT").when(bad, "INCOMPLETE_HEADER_SIGNATURE").otherwise("PRESENT_UNVERIFIED")


def source_disposition(docs: DataFrame, court: str = "court", citation: str = "citation", text: str = "text", own_status: str | None = None, integrity: str | None = None) -> DataFrame:
    """INT01, INT08: id, hash, size, and the reasons for which a source cannot be measured."""
    own = F.col(own_status) if own_status else F.lit("")
    kept = F.col(integrity) if integrity else F.lit("")
    why = F.array_join(
        F.filter(
            F.array(
                F.when(~present(text), F.lit("MISSING_TEXT")), F.when(~present(citation), F.lit("MISSING_SOURCE_CITATION")),
                F.when(own == "MISMATCH", F.lit("SOURCE_CITATION_MISMATCH")), F.when(kept == "INCOMPLETE_HEADER_SIGNATURE", F.lit("INCOMPLETE_TEXT")),
            ),
            lambda x: x.isNotNull(),
        ),
        ";",
    )
    return docs.select(
        "*", F.concat(F.col(court), F.lit("_"), nk(citation)).alias("source_id"), F.sha2(blank(text), 256).alias("text_sha256"),
        F.length(blank(text)).cast("long").alias("text_characters"), why.alias("quarantine_reason"), (why == "").alias("source_measurable"),
    )


def duplicate_texts(docs: DataFrame, source: str, text: str) -> DataFrame:
    """INT07: hashes of non-empty texts that several sources share: count and first source. Evidence only, nothing is merged."""
    r = docs.where(present(text)).select(F.sha2(text, 256).alias("text_sha256"), F.col(source).alias("_s"))
    return r.groupBy("text_sha256").agg(F.count_distinct("_s").alias("source_count"), F.min("_s").alias("first_source"), F.max("_s").alias("last_source")).where("source_count > 1")


def without_sources(rows: DataFrame, excluded: DataFrame, source: str = "source_id") -> DataFrame:
    """INT09: rows of sources that are not excluded."""
    return rows.join(excluded.select(source).distinct(), source, "left_anti")


def excluded_only(rows: DataFrame, excluded: DataFrame, key: str = "merge_key", source: str = "source_id") -> DataFrame:
    """INT09: keys with sources, all of them excluded."""
    x = excluded.select(source).distinct().withColumn("_x", F.lit(True))
    return rows.join(x, source, "left").groupBy(key).agg(F.every(F.coalesce("_x", F.lit(False))).alias("excluded_source_only"))


def filter_instances(instances: DataFrame, excluded: DataFrame, instance: str = "instance", source: str = "source_id") -> DataFrame:
    """INT10: evidence instances that no excluded source touches."""
    hit = instances.join(excluded.select(source).distinct(), source, "left_semi").select(instance).distinct()
    return instances.join(hit, instance, "left_anti")


def restore_audit(counted: DataFrame, raw: DataFrame, excluded: DataFrame, source: str = "source_id") -> DataFrame:
    """INT11: what was excluded, put back beside the counted rows under its own status."""
    gone = raw.join(excluded.select(source).distinct(), source, "left_semi")
    return counted.withColumn("status", F.lit("counted")).unionByName(gone.withColumn("status", F.lit("excluded_source")), allowMissingColumns=True)


def position_zone(reasons_start: Column, appeal_spans: Column, start: Column, end: Column) -> Column:
    """INT13: reasons, headnote, appeal_block, or unknown where a boundary is crossed or missing."""
    inside = F.exists(appeal_spans, lambda s: (s["start"] <= start) & (end <= s["end"]))
    cross = F.exists(appeal_spans, lambda s: (start < s["end"]) & (s["start"] < end))
    return (
        F.when(reasons_start.isNull() | (reasons_start < 0) | (start < 0) | (end <= start), "unknown")
        .when(start >= reasons_start, "reasons").when(end > reasons_start, "unknown")
        .when(F.coalesce(inside, F.lit(False)), "appeal_block").when(F.coalesce(cross, F.lit(False)), "unknown").otherwise("headnote")
    )


def zone_profile(mentions: DataFrame, keys: list[str], zone: str = "zone") -> DataFrame:
    """INT14, INT15, EDG07: per edge, its zones in one word and whether all its mentions stand in formal history."""
    z = F.col(zone)
    out = mentions.groupBy(*keys).agg(F.every(z == "appeal_block").alias("own_case_history"), F.some(z == "headnote").alias("_h"), F.some(z == "reasons").alias("_r"), F.every(z == "unknown").alias("_u"))
    prof = F.when(F.col("_h") & F.col("_r"), "both").when(F.col("_h"), "headnote_only").when(F.col("_r"), "reasons_only").otherwise("unknown")
    assess = F.when(F.col("own_case_history"), "confirmed_formal_history").when(F.col("_u"), "unassessed_no_zone").otherwise("unassessed_mixed_zone")
    return out.withColumn("zone_profile", prof).withColumn("history_assessment", assess).drop("_h", "_r", "_u")


def locate_zones(docs: DataFrame, markers: list[tuple[str, str]], doc: str = "doc", text: str = "text") -> DataFrame:
    """INT12: where the reasons start and which spans before them are appeal blocks. ``markers`` are (regex, role)."""
    import re

    import pandas as pd

    rx = [(re.compile(p), role) for p, role in markers]

    def run(batches):
        for b in batches:
            out = []
            for t in b["_t"].fillna(""):
                hits: dict[str, list[tuple[int, int]]] = {}
                for r, role in rx:
                    hits.setdefault(role, []).extend(m.span() for m in r.finditer(t))
                hits = {k: sorted(v) for k, v in hits.items()}
                start, status = -1, "no_verified_boundary"
                if hits.get("reasons_delivery"):
                    start, status = hits["reasons_delivery"][0][0], "located"
                elif hits.get("reasons_paragraph"):
                    start, status = hits["reasons_paragraph"][0][0], "located"
                    titles = [a for a, _ in hits.get("reasons_title", []) if a <= start]
                    floor = titles[-1] if titles else 0
                    if any(floor <= a < start for a, _ in hits.get("numbered_paragraph", [])):
                        start, status = -1, "ambiguous_paragraph_order"
                    elif titles:
                        start = titles[-1]
                begins = [s for s in hits.get("appeal_start", []) if s[0] < start]
                spans = []
                for i, (a, e) in enumerate(begins):
                    limit = begins[i + 1][0] if i + 1 < len(begins) else start
                    stop = next((x for x, _ in hits.get("appeal_end", []) if e <= x <= limit), limit)
                    if stop > a:
                        spans.append({"start": a, "end": stop})
                out.append((status, start, spans))
            yield pd.DataFrame({doc: b[doc], "status": [o[0] for o in out], "reasons_start": [o[1] for o in out], "appeal_spans": [o[2] for o in out]})

    kind = docs.schema[doc].dataType.simpleString()
    return docs.select(doc, F.col(text).cast("string").alias("_t")).mapInPandas(run, f"`{doc}` {kind}, status string, reasons_start int, appeal_spans array<struct<start:int,end:int>>")
