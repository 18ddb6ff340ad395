"""Samples, labelled evaluation, run comparison and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank, dot, unit
from citeloom.operators.components import connected_components
from citeloom.staging import staged
from citeloom.operators.extract import anti_overlap, overlap_join


def hash_order(seed: str, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), key.cast("string")), 256)


def stratified_sample(rows: DataFrame, cells: list[str], key: str, seed: str, per_cell: int = 2, folds: int = 2) -> DataFrame:
    """QLT01: the lowest hashes of each cell, with inclusion probability and fold."""
    # a cell may hold most rows: they are counted by the first digits of their hash, and only the digits that hold the lowest are sorted
    w = Window.partitionBy(*cells)
    r = staged(rows, "sample-rows").withColumn("_h", hash_order(seed, F.col(key)))  # hashes are long and do not compress: they are made twice
    r = r.withColumn("_p", F.substring("_h", 1, 3))
    counted = staged(r.groupBy(*cells, "_p").agg(F.count(F.lit(1)).alias("_n")), "sample-counts")
    before = F.sum("_n").over(w.orderBy("_p")) - F.col("_n")
    size = counted.withColumn("_b", before).groupBy(*cells).agg(F.sum("_n").alias("cell_size"), F.max(F.when(F.col("_b") < per_cell, F.col("_p"))).alias("_cut"))
    r = r.join(staged(size, "sample-cells"), cells).where(F.col("_p") <= F.col("_cut")).drop("_p", "_cut")
    r = r.withColumn("sample_rank", F.row_number().over(w.orderBy("_h", key))).where(F.col("sample_rank") <= per_cell)
    r = r.select(*cells, *[c for c in rows.columns if c not in cells], "_h", "sample_rank", "cell_size")
    fold = F.pmod(F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed + ":fold"), F.col(key).cast("string")), 256), 1, 8), 16, 10).cast("long"), F.lit(folds))
    return r.withColumn("inclusion_probability", F.round(F.least(F.lit(per_cell), F.col("cell_size")) / F.col("cell_size"), 6)).withColumn("fold", fold).drop("_h")


def weighted_precision(rows: DataFrame, by: list[str], correct: str, probability: str) -> DataFrame:
    """QLT02: precision with each row weighing one over its inclusion probability."""
    w = 1.0 / F.col(probability)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("labelled"), F.round(F.sum(F.when(F.col(correct), w).otherwise(0.0)) / F.sum(w), 6).alias("precision"))


def review_queue(reasons: list[DataFrame], limit: int = 500) -> DataFrame:
    """QLT03: reasons for review (group_id, dd, reason, priority), most urgent first."""
    r = reasons[0]
    for x in reasons[1:]:
        r = r.unionByName(x)
    return r.orderBy(F.desc("priority"), F.desc("dd"), F.desc("group_id")).limit(limit)


def language_census(docs: DataFrame, source: str, lang: str, fr: str = "fr", en: str = "en") -> DataFrame:
    """QLT04: the languages of each source as bits (1 English, 2 French, 4 other or none); French only is exactly 2."""
    bit = F.when(F.col(lang) == en, 1).when(F.col(lang) == fr, 2).otherwise(4)
    a = docs.groupBy(source).agg(F.bit_or(bit).alias("language_bits"))
    return a.withColumn("domain", F.when(F.col("language_bits") == 2, "fr_only").when(F.col("language_bits").isin(1, 4), "not_fr").otherwise("ambiguous"))


def review_packet(samples: DataFrame, texts: DataFrame, key: str = "source_id") -> DataFrame:
    """QLT05: the paragraph that holds each sampled mention."""
    j = samples.join(texts, key)
    before = F.substring("text", F.lit(1), F.col("match_start_offset").cast("int"))
    after = F.substring("text", (F.col("match_start_offset") + 1).cast("int"), F.length("text"))
    return j.withColumn("paragraph", F.concat(F.substring_index(before, "\n", -1), F.substring_index(after, "\n", 1))).drop("text")


def set_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """QLT06, QLT14: rows that only one of two tables has, with multiplicity."""
    return old.exceptAll(new).withColumn("side", F.lit("old_only")).unionByName(new.exceptAll(old).withColumn("side", F.lit("new_only")))


def compare_keyed(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """QLT08, QLT16: keys added, lost, changed and unchanged, and the change of the value's sum."""
    o, n = old.select(*keys, F.col(value).alias("_o")), new.select(*keys, F.col(value).alias("_n"))
    j = o.withColumn("_a", F.lit(1)).join(n.withColumn("_b", F.lit(1)), keys, "full_outer")
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "lost").when(F.col("_o").eqNullSafe(F.col("_n")), "unchanged").otherwise("changed")
    return j.groupBy(kind.alias("change")).agg(F.count(F.lit(1)).alias("keys"), F.sum(F.coalesce("_n", F.lit(0)) - F.coalesce("_o", F.lit(0))).alias("value_delta"))


def with_ordinal(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """QLT08: repeated ids numbered in order, so that they can be matched one to one."""
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def match_groups(old: DataFrame, new: DataFrame) -> DataFrame:
    """QLT07: groups of two runs (member, group_id) matched by shared members; components say how they changed."""
    o = old.select("member", F.concat(F.lit("o:"), F.col("group_id").cast("string")).alias("og"))
    n = new.select("member", F.concat(F.lit("n:"), F.col("group_id").cast("string")).alias("ng"))
    j = o.join(n, "member", "full_outer").withColumn("og", F.coalesce("og", "ng")).withColumn("ng", F.coalesce("ng", "og"))
    comp = connected_components(j.select("og", "ng").distinct(), "og", "ng")
    side = F.substring("node", 1, 1)
    c = comp.groupBy("component").agg(F.count_if(side == "o").alias("old_groups"), F.count_if(side == "n").alias("new_groups"))
    mem = lambda d, g: d.groupBy(F.col(g).alias("node")).agg(F.count_distinct("member").alias("members"), F.bit_xor(F.xxhash64("member")).alias("mark"))
    m = mem(o, "og").unionByName(mem(n, "ng")).join(comp, "node").groupBy("component").agg(F.count_distinct("mark").alias("_k"), F.count_distinct("members").alias("_m"))
    same = (F.col("_k") == 1) & (F.col("_m") == 1)
    kind = (
        F.when(F.col("old_groups") == 0, "new_only").when(F.col("new_groups") == 0, "old_only")
        .when((F.col("old_groups") == 1) & (F.col("new_groups") == 1), F.when(same, "one_to_one_same").otherwise("one_to_one_changed"))
        .when(F.col("old_groups") == 1, "split").when(F.col("new_groups") == 1, "merge").otherwise("many_to_many")
    )
    return c.join(m, "component").select("component", "old_groups", "new_groups", kind.alias("change"))


def court_order(old: list[str], new: list[str]) -> list[str]:
    """QLT15: one order that both lists agree with; a contradiction fails."""
    after: dict[str, set] = {c: set() for c in [*old, *new]}
    for seq in (old, new):
        for a, b in zip(seq, seq[1:], strict=False):
            after[b].add(a)
    out: list[str] = []
    while len(out) < len(after):
        free = [c for c in after if c not in out and after[c] <= set(out)]
        if not free:
            raise ValueError("the two orders contradict each other")
        out.append(free[0])
    return out


def source_metrics(sources: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """QLT09: links per document with those without any, distinct groups, foreign share."""
    n = edges.groupBy("source_id").agg(F.count(F.lit(1)).alias("_e"), F.count_if(F.col("foreign_status") == "FOREIGN").alias("_f"))
    j = sources.join(n, "source_id", "left").withColumn("_e", F.coalesce("_e", F.lit(0))).withColumn("_f", F.coalesce("_f", F.lit(0)))
    return j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("_e").alias("links"), F.round(F.avg("_e"), 6).alias("mean_links"),
        F.round(F.percentile("_e", F.lit(0.5)), 6).alias("median_links"), F.count_if(F.col("_e") == 0).alias("without_links"), F.round(F.try_divide(F.sum("_f").cast("double"), F.sum("_e")), 6).alias("foreign_share"),
    )


def top_share(groups: DataFrame, dd: str = "dd", share: float = 0.01) -> DataFrame:
    """QLT09: the share of all links that the most cited ``share`` of groups have, from the histogram of dd."""
    h = groups.groupBy(dd).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(F.desc(dd))  # one row per different dd, not per group
    t = groups.agg(F.ceil(F.count(F.lit(1)) * share).alias("_k"), F.sum(dd).alias("_all"))
    x = h.withColumn("_before", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1))).crossJoin(F.broadcast(t))
    take = F.greatest(F.least(F.col("_c"), F.col("_k") - F.coalesce("_before", F.lit(0))), F.lit(0))
    return x.agg(F.max("_k").alias("top_groups"), F.sum(take * F.col(dd)).alias("top_links"), F.max("_all").alias("all_links")).withColumn("top_share", F.round(F.col("top_links") / F.col("all_links"), 6))


def pair_similarity(vectors: DataFrame, key: str, label: str) -> DataFrame:
    """QLT09: mean cosine of the vectors of each pair of labels, from the labels' sums (no pair of rows is made)."""
    u = vectors.select(F.col(label).alias("l"), F.posexplode(unit(key)).alias("i", "x")).groupBy("l", "i").agg(F.avg("x").alias("m"))
    s = u.groupBy("l").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("_v")).select("l", F.transform("_v", lambda p: p["m"]).alias("v"))
    return s.join(s.select(F.col("l").alias("r"), F.col("v").alias("w")), F.col("l") < F.col("r")).select("l", "r", F.round(dot("v", "w"), 6).alias("similarity"))


def residuals(texts: DataFrame, pattern: str, text: str, top: int) -> DataFrame:
    """QLT10: citation-like strings by their template (digits as 9), commonest first."""
    hits = texts.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("hit"))
    t = hits.groupBy(F.regexp_replace("hit", r"\d+", "9").alias("template")).agg(F.count(F.lit(1)).alias("hits"), F.min("hit").alias("example"))
    return t.orderBy(F.desc("hits"), "template").limit(top)


def recall(truth: DataFrame, kept: DataFrame, superseded: DataFrame, on: list[str]) -> DataFrame:
    """QLT11: ground truth found in the kept rows, only in superseded ones, or nowhere."""
    k = kept.select(*on).distinct().withColumn("_k", F.lit(True))
    s = superseded.select(*on).distinct().withColumn("_s", F.lit(True))
    j = truth.select(*on).distinct().join(k, on, "left").join(s, on, "left")
    return j.groupBy(F.when(F.col("_k"), "kept").when(F.col("_s"), "lost_to_overlap").otherwise("never_extracted").alias("outcome")).agg(F.count(F.lit(1)).alias("pairs"))


def losers_winner(superseded: DataFrame, kept: DataFrame, doc: str = "doc", start: str = "start", end: str = "end") -> DataFrame:
    """QLT11: the longest kept interval over each superseded one."""
    lost = superseded.select(F.col(doc).alias("_d"), F.col(start).alias("_s"), F.col(end).alias("_e")).distinct()
    j = overlap_join(lost, kept.select(F.col(doc).alias("_d"), F.col(start).alias("_s2"), F.col(end).alias("_e2")))
    best = F.max_by(F.struct("_s2", "_e2"), F.struct(F.col("_e2") - F.col("_s2"), -F.col("_s2")))
    won = j.groupBy("_d", "_s", "_e").agg(best.alias("winner"))
    return won.select(F.col("_d").alias(doc), F.col("_s").alias(start), F.col("_e").alias(end), F.col("winner._s2").alias("winner_start"), F.col("winner._e2").alias("winner_end"))


def uncovered(found: DataFrame, covered: DataFrame) -> DataFrame:
    """QLT10: intervals that no extracted one overlaps."""
    return anti_overlap(found, covered)


def propagate_labels(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """QLT12: items without a label take the only label of their neighbours (pairs a, b), round by round, until none is new; proposals only.

    Only the labels of the last round meet the pairs: an item that an earlier round reached has its label, or had
    neighbours of several and keeps none. Each round is staged; there are as many as the longest way of a label.
    """
    both = staged(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a is not null and b is not null").distinct(), "label-pairs")
    new = known.where("item is not null").groupBy("item").agg(F.count_distinct("label").alias("_n"), F.min("label").alias("label"))
    reached = staged(new.withColumn("round", F.lit(0)), "labels")
    out, i = reached, 0
    while True:
        i += 1
        last = reached.where((F.col("round") == i - 1) & (F.col("_n") == 1)).select(F.col("item").alias("b"), "label")
        new = both.join(last, "b").groupBy(F.col("a").alias("item")).agg(F.count_distinct("label").alias("_n"), F.min("label").alias("label"))
        new = staged(new.join(reached.select("item"), "item", "left_anti").withColumn("round", F.lit(i)), "labels")
        if new.isEmpty():
            return out.where("_n = 1").select("item", "label", "round")
        reached = out = staged(reached.unionByName(new), "labels")


def calibration(rows: DataFrame, bucket: Column, correct: str) -> DataFrame:
    """QLT13: precision of each bucket."""
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col(correct).cast("double")), 6).alias("precision"))


def reassess(groups: DataFrame, observed: DataFrame) -> DataFrame:
    """QLT17, QLT18: members that were undetermined, judged again from a stored run; who is one case stays."""
    j = groups.join(observed.select("merge_key", F.col("origin_country").alias("_c")), "merge_key", "left")
    fresh = (F.col("member_origin_status") == "UNDETERMINED") & (blank("_c") != "")
    return j.withColumn("member_origin_country", F.when(fresh, F.col("_c")).otherwise(F.col("member_origin_country"))).withColumn("member_origin_status", F.when(fresh, "DETERMINED").otherwise(F.col("member_origin_status"))).drop("_c")
