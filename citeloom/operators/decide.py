"""Origin, effective sources, groups, selection and edges: joins, groupings and CASE ladders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank, key_part, nk, number

# Bases of identity that may carry a court or a name to others, best first.
BASES = ("document_alias", "singleton", "anchor", "anchor_variant_bilingual", "anchor_variant_typo", "same_citation", "co_printed_run", "cocitation", "name_year", "unanchored")
ELIGIBLE = BASES[:7]
THRESHOLDS = (1, 2, 3, 5, 10, 20, 50, 100)
PROFILES = {"all": 1, "repeated": 2, "core": 5, "leading": 10}


def basis_rank(basis: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(b) for b in BASES]), basis), F.lit(0)).cast("int")


def member_origin(rows: DataFrame, evidence: list[tuple[str, DataFrame]], key: str = "merge_key") -> DataFrame:
    """DEC03: the first kind of evidence that says anything about a key decides; several countries are a conflict.

    ``evidence`` are (basis, table with key and origin_country), strongest first.
    """
    out = rows
    status, country, basis = F.lit("UNDETERMINED"), F.lit(None).cast("string"), F.lit("")
    for i, (name, table) in reversed(list(enumerate(evidence))):
        e = table.where(blank("origin_country") != "").groupBy(F.col(key).alias(f"_k{i}")).agg(F.count_distinct("origin_country").alias(f"_n{i}"), F.min("origin_country").alias(f"_c{i}"))
        out = out.join(e, F.col(key) == F.col(f"_k{i}"), "left")
        hit = F.col(f"_n{i}").isNotNull()
        status = F.when(hit, F.when(F.col(f"_n{i}") == 1, "DETERMINED").otherwise("CONFLICT")).otherwise(status)
        country = F.when(hit, F.when(F.col(f"_n{i}") == 1, F.col(f"_c{i}"))).otherwise(country)
        basis = F.when(hit, name).otherwise(basis)
    return out.select(*rows.columns, status.alias("member_origin_status"), country.alias("member_origin_country"), basis.alias("member_origin_basis"))


def scope_origin(rows: DataFrame, rules: DataFrame, key: str = "merge_key") -> DataFrame:
    """DEC04: keys of accepted neutral citations (year, no volume) inside the window of the only rule of their court code."""
    one = rules.groupBy("code").agg(F.count(F.lit(1)).alias("_n"), F.min("origin_country").alias("origin_country"), F.min("valid_from").alias("_a"), F.min("valid_to").alias("_b")).where("_n = 1")
    k = rows.select(key).distinct().withColumn("code", key_part(key, 2)).withColumn("_y", number(key_part(key, 0))).where((key_part(key, 1) == "") & F.col("_y").isNotNull())
    return k.join(one, "code").where(F.col("_y").between(F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(9999)))).select(key, "origin_country")


# Verification states whose rules may tell an origin, kinds of evidence by strength, kinds that tell only what a case is not.
ALLOWED_STATES, NOT_DOMESTIC_STATE = ("verified_exclusive_statute", "verified_exclusive_publisher"), "verified_not_domestic"
TIERS = ("exclusive_statute", "exclusive_publisher")
NOT_DOMESTIC = ("not_domestic_window", "not_domestic_printed_court")
COMMON_COURTS = ("ukpc", "jcpc")


def _in_window(rules: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Reporter rows with the rules of their code (``code``; ``vol_from``, ``vol_to``, ``year_from``, ``year_to``) whose windows do not exclude them.

    ``window_requires`` (optional, of the rules) names what must be printed: year, volume, or both joined by +.
    """
    k = rows.withColumn("code", key_part(key, 2)).withColumn("_y", F.coalesce(number(key_part(key, 0)), *([F.col("year_printed").cast("int")] if "year_printed" in rows.columns else []))).withColumn("_v", number(key_part(key, 1)))
    inside = lambda x, a, b: x.isNull() | x.between(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(99999)))
    asks = (lambda what: blank("window_requires").contains(what)) if "window_requires" in rules.columns else (lambda what: F.lit(False))
    printed = ~(asks("year") & F.col("_y").isNull()) & ~(asks("volume") & F.col("_v").isNull())
    return k.where("citation_kind = 'reporter'").join(rules, "code").where(printed & inside(F.col("_v"), F.col("vol_from"), F.col("vol_to")) & inside(F.col("_y"), F.col("year_from"), F.col("year_to")))


def reporter_origin(rows: DataFrame, rules: DataFrame, key: str = "merge_key") -> DataFrame:
    """DEC05: what exclusive reporters tell of the keys in their windows.

    One country of all rules in whose window a key is decides; several leave it
    undetermined, with the reason in ``ambiguous_basis``. The strongest rule is the
    evidence; a subdivision counts where all agree on one.
    """
    hit = _in_window(rules.where(F.col("verification_status").isin(*ALLOWED_STATES)), rows.select(key, "citation_kind").distinct(), key)
    said = lambda c: F.when(blank(c) != "", F.col(c))
    tier = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("exclusivity")), F.lit(0))
    a = hit.groupBy(key).agg(
        F.count_distinct(said("origin_country")).alias("_n"), F.min(said("origin_country")).alias("_c"), F.count_distinct(said("origin_subdivision")).alias("_s"), F.min(said("origin_subdivision")).alias("_sub"),
        F.min_by(F.struct("abbreviation", "exclusivity"), F.struct(F.when(tier == 0, 99).otherwise(tier), "abbreviation", F.coalesce("origin_subdivision", F.lit("")))).alias("_best"),
    )
    one = F.col("_n") == 1
    return a.select(
        key, F.when(one, F.col("_c")).alias("origin_country"), F.when(one & (F.col("_s") == 1), F.col("_sub")).otherwise("").alias("origin_subdivision"),
        F.when(one, F.concat(F.lit("reporter_scope:"), "_best.abbreviation")).otherwise("").alias("evidence"), F.when(one, "").otherwise("exclusive_reporter_scope_ambiguous").alias("ambiguous_basis"),
    )


def not_domestic(rows: DataFrame, rules: DataFrame, key: str = "merge_key") -> DataFrame:
    """DEC06: keys that a window, or a window and the court printed with the key, show to be no case of the home country; the first rule (by ``rule_no``) counts."""
    r = rules.where((F.col("verification_status") == NOT_DOMESTIC_STATE) & F.col("exclusivity").isin(*NOT_DOMESTIC))
    printed = rows.select(key, "citation_kind", F.when(~F.coalesce("court_designation_conflict", F.lit(False)), blank("observed_deciding_court")).otherwise("").alias("_court")).distinct()
    hit = _in_window(r, printed, key).where((F.col("exclusivity") == NOT_DOMESTIC[0]) | F.array_contains(F.split(F.coalesce("qualifying_printed_courts", F.lit("")), r"\|"), F.col("_court")) & (F.col("_court") != ""))
    return hit.groupBy(key).agg(F.min_by("exclusivity", "rule_no").alias("member_origin_basis")).select(key, F.lit("NOT_DOMESTIC").alias("member_origin_status"), "member_origin_basis")


def classified_origin(rows: DataFrame, countries: DataFrame, mixed: DataFrame, consensus: DataFrame, key: str = "merge_key") -> DataFrame:
    """DEC07: the country of an accepted citation's jurisdiction.

    ``countries`` (jurisdiction, country); ``mixed`` are windows of reporters of several
    countries, in which nothing is told; ``consensus`` (abbreviation code, country) are the
    countries that all rows of a reporter agree on, asked where its jurisdiction is
    unsupported. Rejected rows, rows with an ``ambiguous_basis`` (optional) and appeals
    to a court of several countries tell nothing.
    """
    if "ambiguous_basis" in rows.columns:
        rows = rows.where(blank("ambiguous_basis") == "")
    r = rows.where(F.col("citation_kind").isin("reporter", "neutral", "identifier") & (blank("rejected_reason") == "")).select(key, "citation_kind", "jurisdiction").distinct()
    r = r.withColumn("code", key_part(key, 2)).where(~((F.col("citation_kind") == "neutral") & F.col("code").isin(*COMMON_COURTS)))
    held = _in_window(mixed, r.drop("code"), key).select(F.col(key).alias("_k")).distinct()
    r = r.join(held, F.col(key) == F.col("_k"), "left")
    known = r.join(countries.select("jurisdiction", F.col("country").alias("_known")), "jurisdiction", "left")
    both = known.join(consensus.select("code", F.col("country").alias("_agreed")), "code", "left")
    agreed = F.when((F.col("jurisdiction") == "UNSUPPORTED") & (F.col("citation_kind") == "reporter"), F.col("_agreed"))
    withheld = F.col("_k").isNotNull() & (F.col("citation_kind") == "reporter")
    out = both.select(
        key, F.when(~withheld, F.coalesce("_known", agreed)).alias("origin_country"),
        F.when(withheld, "mixed_reporter_scope").when(F.col("_known").isNotNull(), "classification_jurisdiction").when(agreed.isNotNull(), "classification_reporter_consensus").alias("basis"),
    )
    return out.where("basis is not null").distinct()


def reporter_consensus(rules: DataFrame) -> DataFrame:
    """The country of each reporter code all of whose rows name the same one (rules: code, country)."""
    a = rules.groupBy("code").agg(F.count_distinct(F.coalesce("country", F.lit(""))).alias("_n"), F.min("country").alias("country"))
    return a.where("_n = 1 and country <> ''").select("code", "country")


def source_titles(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """DEC14: the documents' own titles by decision id, of the wanted ids (docs: court, citation, name); of several the smallest."""
    own = docs.select(F.concat(F.col("court"), F.lit("_"), nk("citation")).alias("decision_id"), F.col("name").alias("title")).where(blank("title") != "")
    return own.join(decisions.select("decision_id").distinct(), "decision_id", "left_semi").groupBy("decision_id").agg(F.min("title").alias("title"))


def group_origin(members: DataFrame, group: str = "group_id", home: str = "CA") -> DataFrame:
    """DEC08: members' observations of one group; disagreement is kept, never voted away."""
    s, c = F.col("member_origin_status"), F.col("member_origin_country")
    known = (s == "DETERMINED") & (blank(c) != "")
    a = members.groupBy(group).agg(
        F.some(s == "CONFLICT").alias("_x"), F.some(s == "NOT_DOMESTIC").alias("_nd"), F.count_distinct(F.when(known, c)).alias("_k"),
        F.min(F.when(known, c)).alias("_c"), F.some(known & (c == home)).alias("_home"),
    )
    conflict = F.col("_x") | (F.col("_k") > 1) | (F.col("_nd") & F.col("_home"))
    one = F.col("_k") == 1
    return a.select(
        group,
        F.when(~conflict & one, F.col("_c")).alias("group_origin_country"),
        F.when(conflict, "CONFLICT").when(one, "DETERMINED").otherwise("UNDETERMINED").alias("group_origin_status"),
        F.when(conflict, "CONFLICT").when(one, F.when(F.col("_c") == home, f"DOMESTIC_{home}").otherwise("FOREIGN")).when(F.col("_nd"), "FOREIGN").otherwise("UNDETERMINED").alias("group_foreign_status"),
    )


def self_sources(bridge: DataFrame, own: DataFrame, group: str = "group_id", source: str = "source_id", key: str = "merge_key") -> DataFrame:
    """DEC02: sources all of whose keys into a group are their own citations (``own``: source, key)."""
    o = own.select(source, key).distinct().withColumn("_own", F.lit(True))
    return bridge.join(o, [source, key], "left").groupBy(group, source).agg(F.every(F.coalesce("_own", F.lit(False))).alias("is_self"))


def effective_sources(bridge: DataFrame, own: DataFrame, excluded: DataFrame, group: str = "group_id", source: str = "source_id", key: str = "merge_key", basis: str = "identity_basis") -> DataFrame:
    """DEC09: (group, source) with its best basis, the keys used, and counted, excluded_self or excluded_source."""
    best = F.min_by(F.col(basis), F.struct(basis_rank(F.col(basis)), F.col(basis)))
    a = bridge.groupBy(group, source).agg(best.alias("identity_status"), F.array_join(F.array_sort(F.collect_set(key)), ";").alias("via_member_row_keys"))
    x = excluded.select(source).distinct().withColumn("_x", F.lit(True))
    out = a.join(self_sources(bridge, own, group, source, key), [group, source]).join(x, source, "left")
    status = F.when(F.col("_x"), "excluded_source").when(F.col("is_self"), "excluded_self").otherwise("counted")
    return out.select(group, source, status.alias("status"), "identity_status", "via_member_row_keys")


def adjudicate(members: DataFrame, sources: DataFrame, prefix: str = "XC", group: str = "group_id", key: str = "merge_key") -> DataFrame:
    """DEC01: groups with a run-local name, their primary member and exact counts.

    Numbers follow the smallest member key, by a range-partitioned order: each
    partition counts its own rows and adds what the partitions before it hold.
    """
    primary = F.min_by(F.col(key), F.struct(F.when(blank("case_name_modal") != "", 0).otherwise(1), -F.col("occurrence_count"), F.col(key)))
    g = members.groupBy(group).agg(F.min(key).alias("_first"), primary.alias("primary_key"), F.sum("occurrence_count").alias("occurrence_count"))
    dd = sources.where("status = 'counted'").groupBy(group).agg(F.count_distinct("source_id").alias("distinct_decisions_count"))
    named = ordered_number(g, "_first", "_n")
    return named.join(dd, group, "left").select(
        group, F.concat(F.lit(prefix + "-G"), F.lpad(F.col("_n").cast("string"), 6, "0")).alias("merged_group_id"), "primary_key", "occurrence_count",
        F.coalesce("distinct_decisions_count", F.lit(0).cast("long")).alias("distinct_decisions_count"),
    )


def ordered_number(df: DataFrame, order: str, out: str) -> DataFrame:
    """Dense row numbers from 1 in a unique column's order, without a single-task sort."""
    ranged = df.repartitionByRange(order).withColumn("_p", F.spark_partition_id())
    from citeloom.staging import staged

    ranged = staged(ranged, "ordered")
    size = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = size.withColumn("_b", F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
    w = Window.partitionBy("_p").orderBy(order)
    return ranged.join(F.broadcast(before), "_p").withColumn(out, F.row_number().over(w) + F.coalesce("_b", F.lit(0))).drop("_p", "_c", "_b")


def near_year_peers(groups: DataFrame, group: str = "group_id", name: str = "name", year: str = "year") -> DataFrame:
    """DEC10: how many other groups of the same name are at most a year away, and the smallest of them.

    ``groups`` has one row per group. Groups are counted per (name, year) with their two
    smallest ids, and three neighbouring counts are added: no pair of groups is made,
    however many share a name.
    """
    a = groups.where((blank(name) != "") & F.col(year).isNotNull()).select(group, name, F.col(year).alias("_y"))
    cell = a.groupBy(name, "_y").agg(F.count(F.lit(1)).alias("_n"), F.min(group).alias("_first"))
    second = a.join(cell.select(name, "_y", "_first"), [name, "_y"]).where(F.col(group) != F.col("_first")).groupBy(name, "_y").agg(F.min(group).alias("_second"))
    cell = cell.join(second, [name, "_y"], "left")
    near = cell.select(name, F.explode(F.array(F.col("_y") - 1, F.col("_y"), F.col("_y") + 1)).alias("_y"), "_n", "_first", "_second")
    ids = F.array_compact(F.array(F.min("_first"), F.min(F.when(F.col("_rank") > 1, F.col("_first"))), F.min("_second")))
    w = Window.partitionBy(name, "_y").orderBy("_first")
    around = near.withColumn("_rank", F.row_number().over(w)).groupBy(name, "_y").agg(F.sum("_n").alias("_n"), ids.alias("_ids"))
    j = a.join(around, [name, "_y"])
    return j.where("_n > 1").select(group, (F.col("_n") - 1).alias("peer_count"), F.array_min(F.filter("_ids", lambda x: x != F.col(group))).alias("first_peer"))


def group_court(members: DataFrame, group: str = "group_id", court: str = "observed_deciding_court", basis: str = "identity_basis") -> DataFrame:
    """DEC11: the one court that members of eligible basis print."""
    ok = F.col(basis).isin(*ELIGIBLE) & (blank(court) != "")
    a = members.groupBy(group).agg(F.count_distinct(F.when(ok, F.col(court))).alias("_k"), F.min(F.when(ok, F.col(court))).alias("_c"))
    return a.select(group, F.when(F.col("_k") == 1, F.col("_c")).alias("group_court"), F.when(F.col("_k") == 1, "DETERMINED").when(F.col("_k") > 1, "CONFLICT").otherwise("UNSUPPORTED").alias("group_court_status"))


def cross_court(rounds: list[DataFrame]) -> DataFrame:
    """DEC12: the courts' rows together; their sets of sources are united, never their counts."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rounds)


def decide_invariants(members: DataFrame, groups: DataFrame) -> DataFrame:
    """DEC13."""
    m = members.agg(F.sum("occurrence_count").alias("a"), F.count_distinct("group_id").alias("n"))
    g = groups.agg(F.sum("occurrence_count").alias("b"), F.count(F.lit(1)).alias("k"), F.max(F.col("distinct_decisions_count") - F.col("occurrence_count")).alias("over"))
    return m.crossJoin(g).select((F.col("a") == F.col("b")).alias("occurrences_kept"), (F.col("n") == F.col("k")).alias("groups_kept"), (F.col("over") <= 0).alias("dd_within_occ"))


def threshold_flag(groups: DataFrame, profile: str = "core", dd: str = "dd") -> DataFrame:
    """SEL01: flagged, not filtered."""
    return groups.withColumn("kept", F.col(dd) >= PROFILES[profile])


def dd_profile(groups: DataFrame, dd: str = "dd") -> DataFrame:
    """SEL02: groups at or over each threshold, in one aggregation."""
    a = groups.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(dd) >= t).alias(f"_t{t}") for t in THRESHOLDS])
    rows = F.array(*[F.struct(F.lit(t).alias("threshold_dd"), F.col(f"_t{t}").alias("groups_kept")) for t in THRESHOLDS])
    return a.select("_n", F.explode(rows).alias("r")).select("r.*", F.round(F.try_divide(F.lit(100.0) * F.col("r.groups_kept"), F.col("_n")), 3).alias("pct_of_groups"))


def edges(sources: DataFrame, groups: DataFrame, mentions: DataFrame, group: str = "group_id", source: str = "source_id") -> DataFrame:
    """EDG01, EDG05: one row per counted (source, group) with the group's attributes and mention count; an edge without a mention fails."""
    n = mentions.groupBy(group, source).agg(F.count(F.lit(1)).alias("mention_count"))
    e = sources.where("status = 'counted'").join(groups, group).join(n, [group, source], "left")
    checked = F.coalesce(F.col("mention_count"), F.raise_error(F.concat(F.lit("edge without mention: "), F.col(source))).cast("long"))
    return e.withColumn("mention_count", checked).withColumn("edge_support", F.when(F.col("identity_status").isin(*ELIGIBLE), "supported").otherwise("heuristic_only"))


def group_case_name(members: DataFrame, group: str = "group_id", name: str = "name", occ: str = "occurrence_count", basis: str | None = None) -> DataFrame:
    """EDG02: the name with the most occurrences among eligible members, of equal ones the smallest."""
    m = members.where(blank(name) != "")
    m = m.where(F.col(basis).isin(*ELIGIBLE)) if basis else m
    n = m.groupBy(group, name).agg(F.sum(occ).alias("_n"))
    return n.groupBy(group).agg(F.min_by(F.col(name), F.struct(-F.col("_n"), F.col(name))).alias("group_case_name"))


def edge_origin(observed: DataFrame, groups: DataFrame, keys: list[str], supported: str = "supported", home: str = "CA") -> DataFrame:
    """EDG03: what the members a source really cites say, else the group if the identity is supported."""
    own = group_origin(observed.withColumn("_e", F.struct(*keys)), "_e", home).select("_e.*", F.col("group_foreign_status").alias("_f"), F.col("group_origin_country").alias("_c"))
    e = observed.groupBy(*keys).agg(F.every(supported).alias("_s")).join(own, keys).join(groups.select("group_id", "group_foreign_status", "group_origin_country"), "group_id", "left")
    said = F.col("_f") != "UNDETERMINED"
    return e.select(
        *keys, F.when(said, F.col("_f")).when(F.col("_s"), F.col("group_foreign_status")).otherwise("UNDETERMINED").alias("foreign_status"),
        F.when(said, F.col("_c")).when(F.col("_s"), F.col("group_origin_country")).alias("origin_country"), F.when(said, "member").when(F.col("_s"), "group").otherwise("").alias("origin_basis"),
    )


def reporter_occurrence(observed: DataFrame, keys: list[str], conflicted: str = "conflicted", eligible: str = "eligible") -> DataFrame:
    """EDG04: whether a conflicted complete key is all that supports an edge."""
    a = observed.groupBy(*keys).agg(F.some(conflicted).alias("_a"), F.some(F.col(eligible) & ~F.col(conflicted)).alias("_clean"))
    return a.select(*keys, F.when(~F.col("_a"), "none").when(F.col("_clean"), "ambiguous_member_present").otherwise("uncertain_only_support").alias("reporter_occurrence_status"))


def fan_out(e: DataFrame) -> dict[str, DataFrame]:
    """EDG06: the edge files, as filters of one table."""
    return {"citation": e.where("status = 'counted'"), "foreign": e.where("status = 'counted' and foreign_status = 'FOREIGN'"), "tentative": e.where("edge_support = 'heuristic_only'"), "self_excluded": e.where("status = 'excluded_self'"), "source_excluded": e.where("status = 'excluded_source'")}
