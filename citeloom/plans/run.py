"""One call from documents to edges: every step over what the one before it returned.

Each step is lazy but for the staged tables below, which several later steps read: the arbitrated ledger,
keys, their groups, (group, source) pairs, and what the identity solver stages itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions import scalar as fn
from citeloom.operators import arbitrate, classify, decide, extract, identity, integrity, merge
from citeloom.operators.shapes import ShapeSet
from citeloom.sources.store import Published, Stage, Store, counted, same_keys, unique
from citeloom.staging import staged


#: Words between two citations that say that one judgment reviewed the other.
REVIEWED = r"(?i)\b(?:aff['’]?d|aff['’]?g|affirmed|affirming|rev['’]?d|rev['’]?g|reversed|reversing|var['’]?d|varied|varying|conf\.|inf\.|confirmé|confirmant|infirmé|infirmant)(?!\w)"


@dataclass(frozen=True)
class Evidence:
    """What a run may know beside the tables that it must have; what is not given tells nothing.

    ``reviewed`` is the pattern of an appeal history's connector, ``run_sources`` how many documents must print two citations
    side by side. Rules of origin: ``scope_rules`` (code, origin_country, valid_from, valid_to) and ``reporter_rules``, as
    ``decide.scope_origin`` and ``decide.reporter_origin`` read them. ``markers`` are (pattern, role) of document zones.
    """

    reviewed: str = REVIEWED
    run_sources: int = 1
    scope_rules: DataFrame | None = None
    reporter_rules: DataFrame | None = None
    markers: tuple[tuple[str, str], ...] = ()


@dataclass
class Run:
    """Tables of one run: one row per source, candidate, key, group member, group, (group, source), and edge."""

    sources: DataFrame
    ledger: DataFrame
    keys: DataFrame
    members: DataFrame
    groups: DataFrame
    effective: DataFrame
    edges: DataFrame


def read_citations(docs: DataFrame, courts: DataFrame, reporters: DataFrame, shapes: ShapeSet | None = None, words: dict | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Every candidate of the documents with its classification, merge key, support grade and arbitration status; of its other columns those of ``keep``, or all."""
    read = keep and (*classify.READS, *arbitrate.FIELDS, *arbitrate.SPANS, "court", "corpus_row_index", *keep)
    c = classify.classify(extract.extract(docs, shapes, columns=read), courts, reporters, words=words)
    slot = fn.series_component("series_paren", "series", "paren_note", "shape_name")
    c = c.withColumn("merge_key", fn.merge_key_v1("year_start", "vol", "abbreviation", slot, "page", "series_prefix"))
    c = c.withColumn("grade", arbitrate.support_grade(F.col("rejected_reason"), F.col("parse_status"), F.col("citation_kind"), F.col("lookup_mode"), F.col("jurisdiction")))
    return arbitrate.arbitrate(c.withColumn("source_id", F.col("source_decision_citation")), ["court", "corpus_row_index"], keep and (*keep, "source_id"))


def named_mentions(counted: DataFrame) -> DataFrame:
    """What the votes on a key's name and origin read of its counted mentions."""
    return counted.select("merge_key", F.col("candidate_case_name").alias("name"), F.col("source_decision_year").alias("year"), "citation_kind", "jurisdiction", "rejected_reason")


def key_table(counted: DataFrame) -> DataFrame:
    """One row per merge key: counts, modal name and kind."""
    named = named_mentions(counted)
    kinds = named.groupBy("merge_key").agg(F.min("citation_kind").alias("kind"))
    return merge.counted_keys(counted).join(merge.name_vote(named).select("merge_key", "case_name_modal"), "merge_key", "left").join(kinds, "merge_key")


def neighbours(counted: DataFrame, reviewed: str = REVIEWED) -> DataFrame:
    """Counted mentions by document, and whether each is parallel to the one before it or follows a connector."""
    doc = F.concat_ws(":", "court", F.col("corpus_row_index").cast("string"))
    c = counted.select(doc.alias("doc"), "source_id", "merge_key", "candidate_id", F.col("match_start_offset").alias("start"), F.col("match_end_offset").alias("end"), "preceding_text")
    w = Window.partitionBy("doc").orderBy("start", "end", "candidate_id")
    gap = fn.gap_text(F.lag("end").over(w), "start", "preceding_text")
    c = c.withColumn("gap", gap)
    return c.select("doc", "source_id", "merge_key", "candidate_id", "start", "end", F.coalesce(fn.parallel_gap("gap"), F.lit(False)).alias("parallel"), F.coalesce(F.col("gap").rlike(reviewed) & ~F.col("gap").contains(";") & ~F.col("gap").contains("\n"), F.lit(False)).alias("connected"))


#: The columns of the ledger that the steps after it read.
LEDGER = "court corpus_row_index candidate_id match_start_offset match_end_offset preceding_text source_decision_year merge_key candidate_case_name citation_kind jurisdiction rejected_reason".split()
ORDER = ["start", "end", "candidate_id"]


def own_claims(ledger: DataFrame) -> DataFrame:
    """(merge_key, decision_id): what documents print as their own citation, of keys that one document claims."""
    own = ledger.where("arbitration_status = 'self_citation_row'").select("merge_key", F.col("source_id").alias("decision_id")).distinct()
    return own.groupBy("merge_key").agg(F.count(F.lit(1)).alias("_n"), F.min("decision_id").alias("decision_id")).where("_n = 1").select("merge_key", "decision_id")


def identity_table(keys: DataFrame, ledger: DataFrame, evidence: Evidence = Evidence()) -> DataFrame:  # noqa: B008
    """(merge_key, group_id, identity_basis) of every key: links of documents' own citations, of parallel runs and of names, under the guards; then groups that a printed history cuts."""
    counted = ledger.where("arbitration_status = 'counted'")
    near = staged(neighbours(counted, evidence.reviewed), "run-neighbours")
    own = staged(own_claims(ledger), "run-own")
    rows = keys.join(own, "merge_key", "left").select(F.col("merge_key").alias("row_key"), "merge_key", F.coalesce("case_name_modal", F.lit("")).alias("name"), fn.row_year(F.lit(None), "merge_key").alias("year"), "kind", "decision_id")
    runs = merge.islands(near, "doc", ORDER, F.col("parallel"))
    known = keys.select("merge_key")
    links = identity.alias_links(known, own).unionByName(identity.run_links(runs.select("doc", "run", "merge_key"), evidence.run_sources)).unionByName(identity.name_links(rows))
    links = staged(links, "run-links")
    solved, trace = identity.solve(rows, links)
    basis = identity.identity_basis(solved, trace).withColumnRenamed("row_key", "merge_key")
    pairs = staged(merge.history_pairs(near, "doc", ORDER, F.col("connected"), F.col("parallel")), "run-history")
    if pairs.isEmpty():
        return basis
    basis = staged(basis, "run-basis")
    sides = pairs.select(F.concat_ws(":", "doc", F.col("instance").cast("string")).alias("instance"), "side", "merge_key").distinct()
    members = basis.select("group_id", F.col("merge_key").alias("row_key"), "merge_key", F.lit("").alias("court"))
    bridge = merge.decision_ids(counted).select(F.col("merge_key").alias("row_key"), "source_id").distinct()
    parts = identity.history_parts(members, sides, bridge).select(F.col("row_key").alias("merge_key"), "part", "reason")
    cut = ~F.col("reason").isin("", "contradiction")
    j = basis.join(parts, "merge_key").withColumn("_g", F.when(cut, F.col("part")).otherwise(F.col("group_id")))
    size = F.count(F.lit(1)).over(Window.partitionBy("_g"))
    told = F.when(~cut, F.col("identity_basis")).when(size == 1, "singleton").when(F.col("merge_key") == F.col("_g"), "anchor").when(F.col("identity_basis").isin("anchor", "singleton"), "name_year").otherwise(F.col("identity_basis"))
    return j.select("merge_key", F.col("_g").alias("group_id"), told.alias("identity_basis"))


def effective_table(ledger: DataFrame, basis: DataFrame, sources: DataFrame) -> DataFrame:
    """(group, source) pairs and how each counts."""
    own = ledger.where("arbitration_status = 'self_citation_row'").select("source_id", "merge_key").distinct()
    excluded = sources.where(~F.col("source_measurable")).select("source_id")
    return decide.effective_sources(merge.decision_ids(ledger.where("arbitration_status = 'counted'")).join(basis, "merge_key"), own, excluded)


NO_WINDOWS = "code string, vol_from int, vol_to int, year_from int, year_to int"


def member_table(ledger: DataFrame, keys: DataFrame, basis: DataFrame, reporters: DataFrame, countries: DataFrame, mixed: DataFrame, evidence: Evidence = Evidence()) -> DataFrame:  # noqa: B008
    """Keys with their group, basis and origin: the strongest evidence that tells anything decides."""
    named = named_mentions(ledger.where("arbitration_status = 'counted'"))
    kinds = named.select("merge_key", "citation_kind").distinct()
    told = []
    if evidence.scope_rules is not None:
        told.append(("court_scope_rule", decide.scope_origin(kinds.where("citation_kind in ('neutral', 'identifier')"), evidence.scope_rules)))
    if evidence.reporter_rules is not None:
        scope = staged(decide.reporter_origin(kinds, evidence.reporter_rules), "run-reporter-origin")
        told.append(("exclusive_reporter_scope", scope.where("ambiguous_basis = ''").select("merge_key", "origin_country")))
        named = named.join(scope.select("merge_key", "ambiguous_basis"), "merge_key", "left")
    told.append(("classification", decide.classified_origin(named, countries, mixed, decide.reporter_consensus(_consensus_rules(reporters, countries)))))
    return decide.member_origin(keys.join(basis, "merge_key"), told)


def group_table(members: DataFrame, effective: DataFrame, profile: str = "all") -> DataFrame:
    """One row per group: counts, name, origin and whether the profile keeps it."""
    named = decide.adjudicate(members.withColumn("case_name_modal", F.coalesce("case_name_modal", F.lit(""))), effective)
    return decide.threshold_flag(named.join(decide.group_origin(members), "group_id").withColumnRenamed("distinct_decisions_count", "dd"), profile)


def edge_table(ledger: DataFrame, basis: DataFrame, effective: DataFrame, groups: DataFrame, docs: DataFrame | None = None, evidence: Evidence = Evidence()) -> DataFrame:  # noqa: B008
    """Edges; with ``docs`` and zone markers also where in its documents each edge is printed."""
    counted = ledger.where("arbitration_status = 'counted'").join(basis.select("merge_key", "group_id"), "merge_key")
    edges = decide.edges(effective, groups.where("kept").drop("kept"), counted.select("source_id", "merge_key", "group_id"))
    if docs is None or not evidence.markers:
        return edges
    at = F.concat_ws(":", "court", F.col("corpus_row_index").cast("string")).alias("doc")
    zones = integrity.locate_zones(docs.select(at, "text"), list(evidence.markers)).select("doc", "reasons_start", "appeal_spans")
    placed = counted.select(at, "source_id", "group_id", "match_start_offset", "match_end_offset").join(zones, "doc")
    zone = integrity.position_zone(F.col("reasons_start"), F.col("appeal_spans"), F.col("match_start_offset"), F.col("match_end_offset"))
    return edges.join(integrity.zone_profile(placed.withColumn("zone", zone), ["source_id", "group_id"]), ["source_id", "group_id"], "left")


def source_table(docs: DataFrame) -> DataFrame:
    """One row per document: what its header says of its citation, whether its text is whole, and whether it is measured."""
    name = F.col("name") if "name" in docs.columns else F.lit("")
    told = docs.withColumn("own_citation_status", integrity.own_citation(F.col("text"), F.col("citation"))).withColumn("text_integrity_status", integrity.text_integrity(F.col("text"), name, F.col("citation")))
    return integrity.source_disposition(told, own_status="own_citation_status", integrity="text_integrity_status").drop("text")


def run(docs: DataFrame, courts: DataFrame, reporters: DataFrame, countries: DataFrame, mixed: DataFrame | None = None, shapes: ShapeSet | None = None, words: dict | None = None, profile: str = "all", evidence: Evidence = Evidence(), keep: tuple[str, ...] | None = None) -> Run:  # noqa: B008
    """Documents (court, corpus_row_index, citation, year, text and perhaps name) to edges.

    ``courts`` (court_code, jurisdiction), ``reporters`` (abbreviation, jurisdiction, confidence,
    vol_from, vol_to, year_from, year_to) and ``countries`` (jurisdiction, country) are the
    dimension tables; ``mixed`` the windows of reporters of several countries. The ledger has all columns,
    or with ``keep`` those and ``LEDGER``, which the steps after it read.
    """
    mixed = mixed if mixed is not None else docs.sparkSession.createDataFrame([], NO_WINDOWS)
    sources = source_table(docs)
    ledger = staged(read_citations(docs, courts, reporters, shapes, words, None if keep is None else (*LEDGER, *keep)), "run-ledger")
    keys = staged(key_table(ledger.where("arbitration_status = 'counted'")), "run-keys")
    basis = staged(identity_table(keys, ledger, evidence), "run-identity")
    effective = staged(effective_table(ledger, basis, sources), "run-effective")
    members = member_table(ledger, keys, basis, reporters, countries, mixed, evidence)
    groups = staged(group_table(members, effective, profile), "run-groups")
    return Run(sources, ledger, keys, members, groups, effective, edge_table(ledger, basis, effective, groups, docs, evidence))


def stages(shapes: ShapeSet | None = None, words: dict | None = None, profile: str = "all", evidence: Evidence = Evidence()) -> list[Stage]:  # noqa: B008
    """The steps of ``run`` as stages of a store: a change of one table makes only those anew that read it, or what follows from it."""
    return [
        Stage("sources", ("docs",), source_table),
        Stage("ledger", ("docs", "courts", "reporters"), lambda d, c, r: read_citations(d, c, r, shapes, words)),
        Stage("keys", ("ledger",), lambda ledger: key_table(ledger.where("arbitration_status = 'counted'"))),
        Stage("identity", ("keys", "ledger"), lambda k, ledger: identity_table(k, ledger, evidence)),
        Stage("effective", ("ledger", "identity", "sources"), effective_table),
        Stage("members", ("ledger", "keys", "identity", "reporters", "countries", "mixed"), lambda *t: member_table(*t, evidence)),
        Stage("groups", ("members", "effective"), lambda m, e: group_table(m, e, profile)),
        Stage("edges", ("ledger", "identity", "effective", "groups", "docs"), lambda *t: edge_table(*t, evidence)),
    ]


#: What must hold of a run before it is published; the last one of profiles that keep every group.
CHECKS = {
    "one row for each group": unique("groups", ["group_id"]),
    "one edge for each source and group": unique("edges", ["source_id", "group_id"]),
    "edges of known groups": same_keys("edges", "groups", ["group_id"]),
    "members of known groups": same_keys("members", "groups", ["group_id"]),
}


def published_run(store: Store, docs: DataFrame, courts: DataFrame, reporters: DataFrame, countries: DataFrame, mixed: DataFrame | None = None, **options) -> tuple[Published, list[str]]:
    """QLT17, QLT18: a run published in a store, of which only what has changed since the newest one is made anew; its names are returned."""
    mixed = mixed if mixed is not None else docs.sparkSession.createDataFrame([], NO_WINDOWS)
    checks = CHECKS | ({"distinct sources are counted edges": counted("edges", "groups")} if options.get("profile", "all") == "all" else {})
    return store.replay({"docs": docs, "courts": courts, "reporters": reporters, "countries": countries, "mixed": mixed}, stages(**options), checks)


def _consensus_rules(reporters: DataFrame, countries: DataFrame) -> DataFrame:
    """The country of each row of the reporter table by its code."""
    return reporters.select(fn.nk("abbreviation").alias("code"), "jurisdiction").join(countries, "jurisdiction", "left").select("code", "country")
