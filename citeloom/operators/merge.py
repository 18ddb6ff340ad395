"""Counting merged keys: voting, canonical strings, bridge table, sessionization.

All of it is grouping, windows and joins. Every order ends in a total tie-break.
Counts of documents are exact and never added up across keys: the bridge table
(key, source) is kept, and counted again after any further grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.scalar import family_key, nk


def modal(rows: DataFrame, keys: list[str], value: str, out: str = "modal") -> DataFrame:
    """FN21, MRG12: each key's most frequent value, of equal ones the smallest; blank values do not vote."""
    n = rows.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(out))


def counted_keys(rows: DataFrame, key: str = "merge_key", source: str = "source_id") -> DataFrame:
    """MRG06: occurrences and distinct sources of each key."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("occurrence_count"), F.count_distinct(source).alias("distinct_decisions_count"))


def canonical_string(rows: DataFrame, key: str = "merge_key", raw: str = "raw_string") -> DataFrame:
    """MRG07: the most frequent spelling of each key, of equal ones the smallest."""
    return modal(rows, [key], raw, "canonical_string")


def folded_log(rows: DataFrame, key: str = "merge_key", raw: str = "raw_string", source: str = "source_id") -> DataFrame:
    """MRG13."""
    return rows.groupBy(key, raw).agg(F.count(F.lit(1)).alias("count"), F.count_distinct(source).alias("distinct_decisions_count"))


def decision_ids(rows: DataFrame, key: str = "merge_key", source: str = "source_id") -> DataFrame:
    """MRG14: the bridge table."""
    return rows.select(key, source).distinct()


def key_mapping(rows: DataFrame, old: str, new: str) -> DataFrame:
    """MRG16."""
    return rows.groupBy(old, new).agg(F.count(F.lit(1)).alias("rows"))


def name_classes(rows: DataFrame, key: str = "merge_key", name: str = "name") -> DataFrame:
    """MRG10: the classes of printed names, name:n joined by |, most frequent first."""
    n = rows.where(nk(name) != "").groupBy(key, nk(name).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("m"), F.col("_c").alias("c"))))
    return n.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["c"], (-x["m"]).cast("string"))), "|").alias("name_classes"))


def name_vote(rows: DataFrame, key: str = "merge_key", name: str = "name", year: str = "year") -> DataFrame:
    """MRG09: names vote by class (most votes, then the latest year, then the smallest class); the class shows its most frequent form."""
    r = rows.where(nk(name) != "").withColumn("_c", nk(name))
    forms = r.groupBy(key, "_c", name).agg(F.count(F.lit(1)).alias("_f"), F.max(year).alias("_y"))
    classes = forms.groupBy(key, "_c").agg(F.sum("_f").alias("_n"), F.max("_y").alias("_y"), F.min_by(F.col(name), F.struct(-F.col("_f"), F.col(name))).alias("_form"))
    best = F.struct(-F.col("_n"), -F.coalesce(F.col("_y"), F.lit(-1)), F.col("_c"))
    out = classes.groupBy(key).agg(F.min_by("_form", best).alias("case_name_modal"), F.min_by("_n", best).alias("case_name_support"), F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("variants_count"))
    return out.withColumn("case_name_agreement", F.round(F.col("case_name_support") / F.col("_all"), 3)).drop("_all")


def vote_pool(rows: DataFrame, mode: str, position: list[str], name: str = "name", counted: str = "counted") -> DataFrame:
    """MRG08: all rows ("current"), counted rows only, or one row per position where its names agree."""
    if mode == "current":
        return rows
    if mode == "counted_only":
        return rows.where(counted)
    if mode != "dedup_position":
        raise ValueError(mode)
    named = rows.where(nk(name) != "")
    return named.groupBy(*position).agg(F.min(name).alias(name), F.count_distinct(nk(name)).alias("_k")).where("_k = 1").drop("_k")


def court_labels(rows: DataFrame, key: str = "merge_key", court: str = "observed_deciding_court", source: str = "source_id") -> DataFrame:
    """MRG11: the one recognised court of a key, else a conflict."""
    r = rows.where(F.coalesce(F.col(court), F.lit("")) != "")
    out = r.groupBy(key).agg(F.count_distinct(court).alias("_k"), F.min(court).alias("_c"), F.count(F.lit(1)).alias("court_designation_support"), F.count_distinct(source).alias("court_designation_citing"))
    return out.select(key, F.when(F.col("_k") == 1, F.col("_c")).otherwise("").alias("observed_deciding_court"), (F.col("_k") > 1).alias("court_designation_conflict"), "court_designation_support", "court_designation_citing")


def repair_years(rows: DataFrame, key: str = "merge_key", year: str = "year", system: str = "volume_system") -> DataFrame:
    """MRG05: continuous volumes lose the year slot; a blank year of year volumes takes the family's only year, else stays.

    ``year_printed`` keeps the year that the key had, or that was filled in.
    """
    fam = rows.withColumn("_fam", family_key(key)).withColumn("year_printed", F.coalesce(F.col(year).cast("string"), F.lit("")))
    years = fam.where(f"{system} = 'year_volume' and year_printed <> ''").groupBy("_fam").agg(F.min("year_printed").alias("_only"), F.count_distinct("year_printed").alias("_k")).where("_k = 1").select("_fam", "_only")
    j = fam.join(years, "_fam", "left")
    fill = (F.col(system) == "year_volume") & (F.col("year_printed") == "") & F.col("_only").isNotNull()
    j = j.withColumn("year_start", F.when(F.col(system) == "continuous", "").when(fill, F.col("_only")).otherwise(F.col("year_printed")))
    return j.withColumn("year_printed", F.when(fill, F.col("_only")).otherwise(F.col("year_printed"))).withColumn(key, F.concat(F.col("year_start"), F.col("_fam"))).drop("_fam", "_only")


def islands(rows: DataFrame, doc: str, order: list[str], joined: Column, key: str = "merge_key") -> DataFrame:
    """MRG18: runs of neighbours; ``joined`` (may use lag columns made before) tells whether a row continues its predecessor's run.

    Kept are runs of at least two different keys. Adds run, member_index, run_size.
    """
    w = Window.partitionBy(doc).orderBy(*order)
    r = rows.withColumn("run", F.sum(F.when(joined, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    one = Window.partitionBy(doc, "run")
    r = r.withColumn("member_index", F.row_number().over(one.orderBy(*order)) - 1).withColumn("run_size", F.count(F.lit(1)).over(one))
    return r.withColumn("_lo", F.min(key).over(one)).withColumn("_hi", F.max(key).over(one)).where("_lo <> _hi").drop("_lo", "_hi")


def run_evidence(runs: DataFrame, counted: DataFrame, doc: str = "doc") -> DataFrame:
    """MRG19: what is wrong with stored runs (instance, member_index, candidate_id, merge_key, start, end, gap_before), a row for each fault; none is sound.

    ``counted`` are the counted candidates (doc, candidate_id, merge_key, start, end, gap: the
    printed text since the one before, ``joins``: whether that is a parallel separator).
    Members must be counted candidates that say the same, of one document, numbered from
    0, each the counted neighbour of the one before across a parallel gap, with two keys at least.
    """
    seat = Window.partitionBy(doc).orderBy("start", "end", "candidate_id")
    c = counted.withColumn("_seat", F.row_number().over(seat)).select("candidate_id", *[F.col(x).alias(f"_{x}") for x in (doc, "merge_key", "start", "end", "gap", "joins")], "_seat")
    j = runs.join(c, "candidate_id", "left")
    w = Window.partitionBy("instance").orderBy("member_index")
    j = j.withColumn("_nth", F.row_number().over(w) - 1).withColumn("_before", F.lag("_seat").over(w))
    first = F.col("member_index") == 0
    own = F.array_compact(F.array(
        F.when(F.col("_seat").isNull(), F.lit("not_counted")),
        F.when((F.col("merge_key") != F.col("_merge_key")) | (F.col("start") != F.col("_start")) | (F.col("end") != F.col("_end")), F.lit("differs_from_ledger")),
        F.when(F.col("member_index") != F.col("_nth"), F.lit("order_incomplete")),
        F.when(first & (F.coalesce("gap_before", F.lit("")) != ""), F.lit("leading_gap")),
        F.when(~first & ((F.col("_seat") != F.col("_before") + 1) | ~F.coalesce("_joins", F.lit(False)) | (F.col("gap_before") != F.col("_gap"))), F.lit("gap_not_parallel")),
    ))
    whole = j.groupBy("instance").agg(F.count_distinct(f"_{doc}").alias("_d"), F.count_distinct("merge_key").alias("_k"))
    group = F.array_compact(F.array(F.when(F.col("_d") > 1, F.lit("several_documents")), F.when(F.col("_k") < 2, F.lit("no_distinct_members"))))
    return j.select("instance", F.explode(own).alias("fault")).unionByName(whole.select("instance", F.explode(group).alias("fault"))).distinct()


def checked_runs(runs: DataFrame, counted: DataFrame, doc: str = "doc") -> DataFrame:
    """MRG19: the runs as they are; the job fails where any of them is unsound."""
    bad = run_evidence(runs, counted, doc).groupBy("instance").agg(F.array_join(F.array_sort(F.collect_set("fault")), ",").alias("_fault"))
    fail = F.when(F.col("_fault").isNotNull(), F.raise_error(F.concat(F.lit("unsound run "), F.col("instance").cast("string"), F.lit(": "), F.col("_fault"))).cast("string"))
    return runs.join(bad, "instance", "left").withColumn("_fault", fail).where("_fault is null").drop("_fault")


def history_pairs(rows: DataFrame, doc: str, order: list[str], connects: Column, joined: Column, key: str = "merge_key") -> DataFrame:
    """MRG17: sides before and after each connector between neighbours; each side is the run that parallel gaps join to it.

    ``connects`` and ``joined`` speak of a row and its predecessor. Instances with one key on both sides are left out.
    """
    w = Window.partitionBy(doc).orderBy(*order)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    r = rows.withColumn("_i", F.row_number().over(w)).withColumn("_on", connects).withColumn("_run", F.sum(F.when(joined, 0).otherwise(1)).over(up))
    hits = r.where("_on").select(F.col(doc).alias("_d"), F.col("_i").alias("_at"), F.col("_run").alias("_after"))
    before = r.select(F.col(doc).alias("_d"), (F.col("_i") + 1).alias("_at"), F.col("_run").alias("_before"))
    inst = hits.join(before, ["_d", "_at"])
    member = r.select(F.col(doc).alias("_d"), "_i", F.col("_run").alias("_r"), F.col(key).alias("_k"))
    side = F.when(F.col("_i") < F.col("_at"), "before").otherwise("after")
    found = member.join(inst, "_d").where("(_r = _before and _i < _at) or (_r = _after and _i >= _at)").select("_d", "_at", side.alias("side"), "_i", "_k")
    both = found.groupBy("_d", "_at", "_k").agg(F.count_distinct("side").alias("_s")).where("_s = 2").select("_d", "_at").distinct()
    out = found.join(both, ["_d", "_at"], "left_anti")
    return out.select(F.col("_d").alias(doc), F.col("_at").alias("instance"), "side", F.col("_i").alias("position"), F.col("_k").alias(key))


def merge_invariants(rows: DataFrame, merged: DataFrame, folded: DataFrame, bridge: DataFrame, key: str = "merge_key") -> DataFrame:
    """MRG20: one row of conservation checks, all true if nothing was lost."""
    n = rows.agg(F.count(F.lit(1)).alias("rows"))
    m = merged.agg(F.sum("occurrence_count").alias("occ"), F.sum("distinct_decisions_count").alias("dd"), F.max(F.col("distinct_decisions_count") - F.col("occurrence_count")).alias("over"))
    f = folded.agg(F.sum("count").alias("folded"))
    b = bridge.agg(F.count(F.lit(1)).alias("pairs"))
    return n.crossJoin(m).crossJoin(f).crossJoin(b).select(
        (F.col("rows") == F.col("occ")).alias("occurrences_kept"), (F.col("folded") == F.col("occ")).alias("folded_kept"), (F.col("dd") == F.col("pairs")).alias("bridge_kept"), (F.col("over") <= 0).alias("dd_within_occ")
    )
