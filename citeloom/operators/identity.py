"""Which different citations are one case.

Candidate links (equal names in near years, co-citation, printed runs, document
aliases, complete reporter keys) come from joins on block keys and never from
cross products. Their connected components bound every decision; inside one
component an ordered union under cannot-links decides, as an Arrow group while the
component is small and by rounds over tables (``ordered``) beyond.
Guards only take links away, so no result crosses a component.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank, fact_id, key_part, number, one_edit
from citeloom.operators import ordered
from citeloom.operators.components import connected_components
from citeloom.operators.decide import BASES, near_year_peers
from citeloom.operators.ordered import decision_roots, history_parts
from citeloom.staging import staged, unsent

BAR = 0.8


def windows_of(years: list[int]) -> list[int]:
    """IDN03: the window of each year of a sorted list: greedy, none spans more than a year."""
    out, start, n = [], None, -1
    for y in years:
        if start is None or y - start > 1:
            start, n = y, n + 1
        out.append(n)
    return out


def year_windows(rows: DataFrame, block: str = "name", year: str = "year") -> DataFrame:
    """IDN03: distinct (block, year) with the window's first year.

    A window opens at the first year that no earlier one covers. Years of a block are
    few (calendar years), so the greedy cut folds over their sorted array.
    """
    years = rows.where(F.col(year).isNotNull()).groupBy(block).agg(F.array_sort(F.collect_set(F.col(year).cast("int"))).alias("_y"))
    step = lambda acc, y: F.when((F.size(acc) == 0) | (y - F.element_at(acc, -1)["start"] > 1), F.array_append(acc, F.struct(y.alias("start"), y.alias("year")))).otherwise(
        F.array_append(acc, F.struct(F.element_at(acc, -1)["start"].alias("start"), y.alias("year")))
    )
    opened = F.when(
        F.size("_y") > 0,
        F.aggregate(F.slice("_y", 2, 10000), F.array(F.struct(F.get("_y", 0).alias("start"), F.get("_y", 0).alias("year"))), step),
    )
    return years.select(block, F.explode(opened).alias("w")).select(block, F.col("w.year").alias(year), F.col("w.start").alias("window_start"))


def variant_kind(key_a: Column, key_b: Column, sources_a: Column, sources_b: Column, jurisdiction_a: Column, jurisdiction_b: Column, bilingual: Column, identifier: Column) -> Column:
    """IDN06: whether a (the rarer) is b's printing in the other language or a slip of one digit or year."""
    part = lambda k, i: blank(key_part(k, i))
    same = lambda i: part(key_a, i) == part(key_b, i)
    langs = same(0) & same(4) & same(3) & (blank(jurisdiction_a) != "") & (jurisdiction_a == jurisdiction_b)
    rare = same(2) & same(3) & (2 * sources_a <= sources_b) & ~identifier
    years = F.abs(number(part(key_a, 0)) - number(part(key_b, 0))) == 1
    return F.when(langs & bilingual, "bilingual").when(~langs & rare & same(0) & one_edit(part(key_a, 4), part(key_b, 4)), "typo_number").when(~langs & rare & same(4) & years, "typo_year")


def edit_classes(classes: DataFrame, by: list[str], text: str) -> DataFrame:
    """(by, x, y), x < y: different texts of one block that are one edit apart; texts meet once each, however many rows print them."""
    c = classes.select(*by, F.col(text).alias("x")).where("x is not null").distinct()
    return c.join(c.withColumnRenamed("x", "y"), by).where((F.col("x") < F.col("y")) & one_edit("x", "y"))


def expanded(pairs: DataFrame, rows: DataFrame, by: list[str], item: str, cls: str) -> DataFrame:
    """Pairs of classes (by, x, y, and more) as pairs of their items (a, b, and more), the smaller item first; the work is that of writing them out."""
    r = rows.where(F.col(item).isNotNull())
    one, two = r.select(*by, F.col(cls).alias("x"), F.col(item).alias("_i")), r.select(*by, F.col(cls).alias("y"), F.col(item).alias("_j"))
    more = [c for c in pairs.columns if c not in {*by, "x", "y"}]
    return pairs.join(one, [*by, "x"]).join(two, [*by, "y"]).where("_i <> _j").select(F.least("_i", "_j").alias("a"), F.greatest("_i", "_j").alias("b"), *more)


def edit_pairs(rows: DataFrame, item: str, by: list[str], text: str) -> DataFrame:
    """FN20 as a join: items (a, b), a < b, of one block whose texts are one edit apart."""
    return expanded(edit_classes(rows, by, text), rows, by, item, text)


def typo_pairs(rows: DataFrame, item: str, by: list[str], key: str) -> DataFrame:
    """IDN06 as a join: items (a, b, kind), a < b, of one block whose keys differ by a slip of one digit of the page or by a year.

    Different keys meet, not items: those of one year by their pages, those of one page by neighbouring years.
    """
    part = lambda i: blank(key_part(key, i))
    keys = rows.where(F.col(key).isNotNull()).select(*by, key).distinct()
    k = keys.select(*by, F.col(key).alias("k"), part(2).alias("_abbr"), part(3).alias("_series"), part(0).alias("_year"), part(4).alias("_page"))
    at = [*by, "_abbr", "_series"]
    x = k.select(*at, "_year", F.col("_page").alias("x"), F.col("k").alias("_kx"))
    y = k.select(*at, "_year", F.col("_page").alias("y"), F.col("k").alias("_ky"))
    pages = edit_classes(k, at, "_page").join(x, [*at, "x"]).join(y, [*at, "_year", "y"]).select(*by, "_kx", "_ky")
    a = k.select(*at, "_page", number("_year").alias("_n"), F.col("k").alias("_kx"))
    b = k.select(*at, "_page", (number("_year") - 1).alias("_n"), F.col("k").alias("_ky"))
    years = a.join(b, [*at, "_page", "_n"]).select(*by, "_kx", "_ky")
    kind = variant_kind(F.col("_kx"), F.col("_ky"), F.lit(1), F.lit(2), F.lit(""), F.lit(""), F.lit(False), F.lit(False))
    found = pages.unionByName(years).select(*by, F.col("_kx").alias("x"), F.col("_ky").alias("y"), kind.alias("kind")).where("kind is not null")
    return expanded(found, rows, by, item, key)


#: Items of a source whose pairs are counted at once, not looked up one by one.
LIGHT = 64


def cocitation_classes(bridge: DataFrame, item: str, source: str, bar: float = BAR, least_overlap: int = 1) -> tuple[DataFrame, DataFrame]:
    """IDN10: (item, rep) of items with equal source sets, and pairs (a, b, overlap, smaller) of such classes that share enough.

    Two sides share at least ``bar`` of the smaller one's n sources, so one of its n - ceil(bar * n) + 1 rarest
    sources is on the other side: only these, and all of at most ``LIGHT`` items, meet the full lists of sides that
    are not smaller, and are counted as they meet. Pairs that its other sources could still bring to the bar look for
    those. A source that very many items have is met only by those that have hardly any other, and items of the same sources are one
    class, so such a source costs a row for each class. Items of fewer sources than ``least_overlap`` have no partner.
    """
    b = staged(bridge.select(F.col(item).alias("item"), F.col(source).alias("s")).where("item is not null and s is not null").distinct(), "cocitation")
    mark = b.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("s") % 2**40).alias("_h"), F.bit_xor(F.xxhash64(F.lit(7), "s")).alias("_x"))
    mark = mark.where(F.col("n") >= least_overlap)
    rep = mark.groupBy("n", "_h", "_x").agg(F.min("item").alias("rep"))
    of = staged(mark.join(rep, ["n", "_h", "_x"]).select("item", "rep", "n"), "cocitation-classes")
    lists = b.join(of.where("item = rep").select("item", "n"), "item")
    often = lists.groupBy("s").agg(F.count(F.lit(1)).alias("_f"))
    mine = Window.partitionBy("item")
    need = F.greatest(F.ceil(F.lit(float(bar)) * F.col("n") - F.lit(1e-9)), F.lit(least_overlap), F.lit(1))
    lists = lists.join(often, "s").withColumns({"_r": F.row_number().over(mine.orderBy("_f", "s")), "_light": F.count_if(F.col("_f") <= LIGHT).over(mine), "need": need})
    met = F.greatest(F.col("n") - F.col("need") + 1, F.col("_light"))
    lists = staged(lists.select("item", "n", "s", "need", (F.col("n") - met).alias("left"), (F.col("_r") > met).alias("later")), "cocitation-lists")
    few = lists.where("not later").select(F.col("item").alias("x"), F.col("n").alias("nx"), "s", "need", "left")
    full = lists.select(F.col("item").alias("y"), F.col("n").alias("ny"), "s")
    larger = (F.col("ny") > F.col("nx")) | ((F.col("ny") == F.col("nx")) & (F.col("y") > F.col("x")))
    tried = few.join(full, "s").where(larger).groupBy("x", "y").agg(F.count(F.lit(1)).alias("overlap"), F.first("nx").alias("smaller"), F.first("need").alias("need"), F.first("left").alias("left"))
    tried = staged(tried.where("overlap + left >= need"), "cocitation-tried")
    pairs, open_ = tried, tried.where("left > 0").select("x", "y")
    if not open_.isEmpty():
        late = open_.join(lists.where("later").select(F.col("item").alias("x"), "s"), "x").join(full.select("y", "s"), ["y", "s"])
        pairs = tried.join(late.groupBy("x", "y").agg(F.count(F.lit(1)).alias("_late")), ["x", "y"], "left").withColumn("overlap", F.col("overlap") + F.coalesce("_late", F.lit(0)))
    pairs = pairs.where((F.col("overlap") >= bar * F.col("smaller")) & (F.col("overlap") >= least_overlap))
    return of.select("item", "rep", "n"), pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "overlap", "smaller")


def cocitation_links(bridge: DataFrame, item: str, source: str, bar: float = BAR, least_overlap: int = 1) -> DataFrame:
    """IDN10 as links (a, b, rule, sources): class pairs between representatives, and each item to its own representative."""
    of, pairs = cocitation_classes(bridge, item, source, bar, least_overlap)
    own = of.where("item <> rep").select(F.col("item").alias("a"), F.col("rep").alias("b"), F.col("n").alias("sources"))
    return pairs.select("a", "b", F.col("overlap").alias("sources")).unionByName(own).select("a", "b", F.lit("cocitation").alias("rule"), "sources")


def cocitation(bridge: DataFrame, item: str, source: str, bar: float = BAR, least_overlap: int = 1) -> DataFrame:
    """IDN10: all pairs of items whose shared sources are at least ``bar`` of the smaller side; classes of equal items are written out.

    Where many items have the same sources, ``cocitation_links`` says the same without their pairs.
    """
    of, pairs = cocitation_classes(bridge, item, source, bar, least_overlap)
    one, two = of.select(F.col("item").alias("i"), F.col("rep").alias("a")), of.select(F.col("item").alias("j"), F.col("rep").alias("b"))
    across = pairs.join(one, "a").join(two, "b").select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "overlap", "smaller")
    rep = of.select(F.col("item").alias("a"), "rep", F.col("n").alias("overlap"))
    inside = rep.join(of.select(F.col("item").alias("b"), "rep"), "rep").where("a < b").select("a", "b", "overlap", F.col("overlap").alias("smaller"))
    return across.unionByName(inside)


def name_links(keys: DataFrame) -> DataFrame:
    """IDN02: keys of one name and one year window; the window's smallest key stands for it."""
    k = keys.where((blank("name") != "") & F.col("year").isNotNull())
    w = k.join(year_windows(k), ["name", "year"])
    lead = w.groupBy("name", "window_start").agg(F.min("merge_key").alias("b"))
    return w.join(lead, ["name", "window_start"]).where("merge_key <> b").select(F.col("merge_key").alias("a"), "b", F.lit("name_year").alias("rule"))


def alias_links(keys: DataFrame, own: DataFrame) -> DataFrame:
    """IDN13: keys that one qualified document claims as its own (own: merge_key, decision_id)."""
    o = own.join(keys.select("merge_key"), "merge_key", "left_semi").distinct()
    lead = o.groupBy("decision_id").agg(F.min("merge_key").alias("b"))
    return o.join(lead, "decision_id").where("merge_key <> b").select(F.col("merge_key").alias("a"), "b", F.lit("document_alias").alias("rule"))


def same_key_links(keys: DataFrame) -> DataFrame:
    """IDN15: rows (several courts) of one complete reporter key."""
    k = keys.where((blank(key_part("merge_key", 2)) != "") & (blank(key_part("merge_key", 4)) != ""))
    lead = k.groupBy("merge_key").agg(F.min("row_key").alias("b"))
    return k.join(lead, "merge_key").where("row_key <> b").select(F.col("row_key").alias("a"), "b", F.lit("same_citation").alias("rule"))


def run_links(runs: DataFrame, min_sources: int = 1) -> DataFrame:
    """IDN17: keys printed side by side in runs of at least ``min_sources`` documents (runs: doc, run, merge_key)."""
    first = runs.groupBy("doc", "run").agg(F.min("merge_key").alias("b"))
    p = runs.join(first, ["doc", "run"]).where("merge_key <> b").groupBy(F.col("merge_key").alias("a"), "b").agg(F.count_distinct("doc").alias("n"))
    return p.where(F.col("n") >= min_sources).select("a", "b", F.lit("co_printed_run").alias("rule"))


#: Words of a name whose subsets are counted; longer names are compared one by one.
SUBSET_WORDS = 10


def report_conflicts(rows: DataFrame, key: str = "merge_key", tokens: str = "tokens") -> DataFrame:
    """IDN16: how many pairs of a key's different names have no party word in common.

    Pairs are counted, not made: over all sets of words S, the pairs of names that both hold S, added with the sign
    (-1)^|S|, leave exactly the pairs that share no word. So a key of n names costs n times the subsets of a name.
    Only names of more than ``SUBSET_WORDS`` words meet others, through their words.
    """
    names = staged(rows.where(F.size(tokens) > 0).select(key, F.array_sort(F.array_distinct(tokens)).alias("t")).distinct().withColumn("long", F.size("t") > SUBSET_WORDS), "context-names")
    step = lambda acc, w: F.concat(acc, F.transform(acc, lambda x: F.struct(F.concat(x["s"], F.lit("\n"), w).alias("s"), (-x["sign"]).alias("sign"))))
    subsets = F.aggregate("t", F.array(F.struct(F.lit("").alias("s"), F.lit(1).alias("sign"))), step)
    c = names.where("not long").select(key, F.explode(subsets).alias("x")).select(key, "x.*").groupBy(key, "s", "sign").agg(F.count(F.lit(1)).alias("c"))
    short = c.groupBy(key).agg(F.sum(F.col("sign") * F.col("c") * (F.col("c") - 1) / 2).cast("long").alias("_p"))
    size = names.groupBy(key).agg(F.count_if("long").alias("l"), F.count_if(~F.col("long")).alias("s")).where("l > 0").select(key, (F.col("l") * F.col("s") + F.col("l") * (F.col("l") - 1) / 2).cast("long").alias("_p"))
    mine = names.where("long").select(key, "t", F.explode("t").alias("w"))
    other = names.select(key, F.col("t").alias("u"), F.col("long").alias("_l"), F.explode("t").alias("w"))
    once = (F.col("t") != F.col("u")) & (~F.col("_l") | (F.col("t") < F.col("u"))) & (F.col("w") == F.array_min(F.array_intersect("t", "u")))
    shared = mine.join(other, [key, "w"]).where(once).groupBy(key).agg((-F.count(F.lit(1))).alias("_p"))
    return short.unionByName(size).unionByName(shared).groupBy(key).agg(F.sum("_p").alias("conflicting_pairs")).where("conflicting_pairs > 0")


def mixed_name(classes: Column, target: Column) -> Column:
    """IDN08: the printed names of a key include the target's and another one."""
    return F.map_contains_key(classes, target) & (F.size(classes) > 1)


def gate_allows(mode: str, kind: Column, registered: Column, own: Column, same_name: Column) -> Column:
    """IDN07: whether a variant may fold a key that a registry knows."""
    free = (kind == "bilingual") | same_name
    guard = {"literal": own, "own_or_registry": own | registered, "registered_only": registered, "registered": registered}[mode]
    return F.when((kind != "bilingual") & registered, F.lit(False)).otherwise(free | ~guard) if mode == "registered" else free | ~guard


# The order in which kinds of links are tried; and, in ``blocked``, the guards of a union in their order.
RULES = ("document_alias", "anchor_variant_bilingual", "anchor_variant_typo", "same_citation", "co_printed_run", "cocitation", "name_year")


class Known:
    """What the guards need to know of a class; ``take`` adds another class to it."""

    def __init__(self, row: dict):
        some = lambda k: set() if row.get(k) in (None, "") else {row[k]}
        self.docs, self.holdouts, self.courts, self.registered = some("decision_id"), some("holdout_id"), some("court"), some("registered_id")
        self.ids = {(str(row["merge_key"]).split("|")[2], row["merge_key"])} if row.get("kind") == "identifier" else set()
        self.roots = {row.get("root") or row["merge_key"]} if row.get("kind") == "neutral" else set()
        self.scope = next((frozenset(str(x).split("|")) for x in some("scope")), None)
        self.years = (int(row["year"]),) * 2 if row.get("name") and row.get("year") is not None else None
        self.sides: dict[str, str] = {}
        self.torn = any(self.sides.setdefault(i, side) != side for i, side in row.get("history_sides") or [])

    @property
    def size(self) -> int:
        return len(self.holdouts) + len(self.registered) + len(self.sides)

    def take(self, other: Known) -> None:
        for k in ("docs", "holdouts", "courts", "registered", "ids", "roots"):
            getattr(self, k).update(getattr(other, k))
        self.scope = other.scope if self.scope is None else self.scope if other.scope is None else self.scope & other.scope
        self.years, self.torn = span(self, other), self.torn or apart(self, other)
        self.sides |= other.sides


def span(a: Known, b: Known) -> tuple[int, int] | None:
    """The first and last year of two classes."""
    years = [y for y in (a.years, b.years) if y]
    return (min(y[0] for y in years), max(y[1] for y in years)) if years else None


def apart(a: Known, b: Known) -> bool:
    """Whether two classes stand on both sides of one printed history."""
    few, many = sorted((a.sides, b.sides), key=len)
    return any(many.get(i, side) != side for i, side in few.items())


def blocked(a: Known, b: Known) -> str:
    """IDN11, IDN12, IDN14: the first reason against one case for these two classes."""
    docs, ids, years = a.docs | b.docs, a.ids | b.ids, span(a, b)
    if len(docs) > 1:
        return "different_document_claims"
    if not docs.isdisjoint(a.holdouts) or not docs.isdisjoint(b.holdouts):
        return "explicit_document_holdout"
    if len({system for system, _ in ids}) < len(ids):
        return "different_identifier_numbers"
    if len(a.courts | b.courts) > 1:
        return "positive_court_conflict"
    if a.scope is not None and b.scope is not None and not a.scope & b.scope:
        return "incompatible_reporter_identity_scope"
    if years and years[1] - years[0] > 1:
        return "year_span"
    if len(a.roots | b.roots) > 1:
        return "different_neutral_numbers"
    if docs and any(docs.isdisjoint(x.split(";")) for known in (a, b) for x in known.registered):
        return "registered_other_document"
    return "opposite_history_sides" if a.torn or b.torn or apart(a, b) else ""


def solve_block(rows: list[dict], links: list[dict]) -> tuple[dict, list[tuple]]:
    """IDN01, IDN09, IDN20: ordered union of one component under the guards.

    Returns each row's group (its smallest row key) and the trace (a, b, rule, outcome). Classes are known by what the
    guards read of them, the smaller one is added to the larger, and rows find their class by way of others.
    """
    of: dict[str, str] = {r["row_key"]: r["row_key"] for r in rows}
    known = {r["row_key"]: Known(r) for r in rows}

    def find(k: str) -> str | None:
        while k in of and of[k] != k:
            of[k] = k = of[of[k]]
        return k if k in of else None

    trace = []
    for x in sorted(links, key=lambda x: (RULES.index(x["rule"]), -int(x.get("sources") or 0), x["a"], x["b"])):
        a, b = find(x["a"]), find(x["b"])
        if a is None or b is None or a == b:
            continue
        why = blocked(known[a], known[b])
        trace.append((x["a"], x["b"], x["rule"], why or "accepted"))
        if not why:
            low, high = min(a, b), max(a, b)
            one, two = sorted((known[low], known.pop(high)), key=lambda c: c.size)
            two.take(one)
            of[high], known[low] = low, two
    return {k: find(k) for k in of}, trace


ROW = "row_key string, merge_key string, name string, year int, kind string, root string, decision_id string, holdout_id string, registered_id string, court string, scope string"
SIDES = "array<struct<instance:string,side:string>>"


#: Rows and links of a component that one task may settle; larger components are settled by rounds.
GROUP_ROWS = 20_000
#: Rows and links of the small components that one Arrow group takes, on average.
BIN_ROWS = 5_000


def solve(rows: DataFrame, links: DataFrame, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """IDN01: (row_key, group_id), and the trace of proposals (REG14's ledger) with hashed ids.

    ``rows`` has the columns of ``ROW`` and ``history_sides`` (``SIDES``; absent ones are null), ``links`` row keys a and b with a rule.
    Components of at most ``group_rows`` rows and links go whole to Arrow groups, many to each, for nothing passes between them; larger ones are settled by ``ordered.ordered_union``, with equal results.
    """
    fields = [f.split()[0] for f in ROW.split(", ")]
    r = rows.select(*[(F.col(f) if f in rows.columns else F.lit(None)).cast("int" if f == "year" else "string").alias(f) for f in fields], (F.col("history_sides") if "history_sides" in rows.columns else F.lit(None)).cast(SIDES).alias("history_sides"))
    comp = staged(connected_components(links, "a", "b"), "identity-components")
    r = r.join(unsent(comp.select(F.col("node").alias("row_key"), F.col("component").alias("_block"))), "row_key", "left")
    alone = r.where("_block is null").select("row_key", F.col("row_key").alias("group_id"))
    lk = links.join(unsent(comp.select(F.col("node").alias("a"), F.col("component").alias("_block"))), "a")
    lk = lk.select("_block", F.col("a").alias("row_key"), "b", "rule", (F.col("sources") if "sources" in links.columns else F.lit(0)).cast("int").alias("sources"))
    member = r.where("_block is not null").select("_block", *fields, "history_sides")
    member, lk = staged(member, "identity-members"), staged(lk, "identity-links")  # read for their weight, their groups and the rounds
    weight = member.select("_block").unionByName(lk.select("_block")).groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    large = unsent(staged(weight.where(F.col("_n") > group_rows).select("_block"), "identity-large"))
    bins = max(1, -(-(member.count() + lk.count()) // BIN_ROWS))
    binned = lambda d: d.join(large, "_block", "left_anti").withColumn("_bin", F.pmod(F.xxhash64("_block"), F.lit(bins))).drop("_block")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        clean = left.astype(object).where(left.notna(), None).to_dict("records")
        for x in clean:
            x["history_sides"] = [(h["instance"], h["side"]) for h in x["history_sides"]] if x["history_sides"] is not None else []
        of, trace = solve_block(clean, right.rename(columns={"row_key": "a"}).to_dict("records"))
        out = [("group", k, v, "", "") for k, v in of.items()] + [("trace", *t) for t in trace]
        return pd.DataFrame(out, columns=["what", "x", "y", "rule", "outcome"])

    done = staged(binned(member).groupBy("_bin").cogroup(binned(lk).groupBy("_bin")).applyInPandas(run, "what string, x string, y string, rule string, outcome string"), "identity")
    groups = done.where("what = 'group'").select(F.col("x").alias("row_key"), F.col("y").alias("group_id")).unionByName(alone)
    trace = done.where("what = 'trace'").select(F.col("x").alias("a"), F.col("y").alias("b"), "rule", "outcome")
    if not large.isEmpty():
        some = staged(member.join(large, "_block", "left_semi").drop("_block"), "identity-rows")
        sides = some.select("row_key", F.explode("history_sides").alias("h")).select("row_key", "h.instance", "h.side").distinct()
        order = F.struct((F.array_position(F.array(*[F.lit(x) for x in RULES]), F.col("rule"))).alias("r"), (-F.col("sources")).alias("n"), F.col("row_key").alias("a"), F.col("b"))
        ranked = lk.join(large, "_block", "left_semi").select(F.col("row_key").alias("a"), "b", "rule", order.alias("nth"))
        more, told = ordered.ordered_union(some, ranked, None if sides.isEmpty() else sides)
        groups, trace = groups.unionByName(more), trace.unionByName(told)
    return groups, trace.withColumn("constraint_id", fact_id(a="a", b="b", rule="rule")).withColumn("relation", F.when(F.col("outcome") == "accepted", "must_link").otherwise("cannot_link"))


def identity_basis(groups: DataFrame, trace: DataFrame, group: str = "group_id") -> DataFrame:
    """IDN19: why a row is in its group: singleton, anchor (the group's own name), or the best accepted rule."""
    size = groups.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in BASES]), F.col("rule")), F.lit(99))
    best = trace.where("outcome = 'accepted'").select(F.explode(F.array("a", "b")).alias("row_key"), "rule").groupBy("row_key").agg(F.min_by("rule", F.struct(rank, "rule")).alias("_rule"))
    j = groups.join(size, group).join(best, "row_key", "left")
    return j.select("row_key", group, F.when(F.col("_n") == 1, "singleton").when(F.col("row_key") == F.col(group), "anchor").otherwise(F.coalesce("_rule", F.lit("unanchored"))).alias("identity_basis"))


def court_partition(rows: DataFrame, bridge: DataFrame, bar: float = BAR) -> DataFrame:
    """IDN04: rows of a block without a court join the only court whose sources overlap theirs enough; others stay unassigned.

    Sources do not meet block by block. Rows that have a court in the same blocks are one class, sources of the same classes one
    kind, and each row without a court counts its sources by kind; only kinds are written out by block and court.
    """
    known = rows.where((blank("court") != "") & F.col("row_key").isNotNull()).groupBy("row_key").agg(F.sort_array(F.collect_set(F.struct("block", "court"))).alias("_at"))
    cls = known.groupBy("_at").agg(F.min("row_key").alias("_cls"))
    of = bridge.join(known, "row_key").join(cls, "_at").select("source_id", "_cls")
    kind = staged(of.groupBy("source_id").agg(F.sort_array(F.collect_set("_cls")).alias("_kind")), "court-kinds")
    size = staged(kind.groupBy("_kind").agg(F.count(F.lit(1)).alias("_n")), "court-kind-sizes")
    told = size.select("_kind", F.explode("_kind").alias("_cls")).join(cls, "_cls").select("_kind", F.explode("_at").alias("_x")).select("_kind", "_x.block", "_x.court").distinct()
    told = staged(told, "court-kind-blocks")
    csize = told.join(size, "_kind").groupBy("block", "court").agg(F.sum("_n").alias("_cn"))
    blocks = rows.where((blank("court") == "") & F.col("row_key").isNotNull()).select("block", "row_key").distinct()
    mine = bridge.select("row_key", "source_id").distinct().join(blocks.select("row_key").distinct(), "row_key").join(kind, "source_id", "left")
    mine = staged(mine.groupBy("row_key", "_kind").agg(F.count(F.lit(1)).alias("_m")), "court-sources")
    osize = mine.groupBy("row_key").agg(F.sum("_m").alias("_s")).join(blocks.groupBy("row_key").agg(F.count(F.lit(1)).alias("_b")), "row_key").select("row_key", (F.col("_s") * F.col("_b")).alias("_on"))
    hit = mine.join(told, "_kind").join(blocks, ["block", "row_key"]).groupBy("block", "row_key", "court").agg(F.sum("_m").alias("_o")).join(csize, ["block", "court"]).join(osize, "row_key")
    ok = hit.where(F.col("_o") >= bar * F.least("_cn", "_on")).groupBy("row_key").agg(F.count(F.lit(1)).alias("_k"), F.min("court").alias("_c")).where("_k = 1")
    return rows.join(ok, "row_key", "left").select("block", "row_key", F.when(blank("court") != "", F.col("court")).otherwise(F.coalesce("_c", F.lit("unassigned"))).alias("court"))


def uncertain_rulings(groups: DataFrame, runs: DataFrame) -> DataFrame:
    """IDN18: unanchored groups of one name in neighbouring years, one of which no printed run connects with them.

    ``runs`` has (run, group_id): the groups that a run connects with one another. Counts, not pairs: a group is uncertain
    when it has more neighbours than runs to neighbours. Groups of one name and year in the same runs are one class,
    and only classes meet.
    """
    g = groups.where((blank("name") != "") & F.col("year").isNotNull() & ~F.col("anchored")).select("group_id", "name", "year")
    peers = near_year_peers(g)
    inside = g.join(runs.where("run is not null").select("run", "group_id"), "group_id").groupBy("group_id", "name", "year").agg(F.sort_array(F.collect_set("run")).alias("_runs"))
    cls = staged(inside.groupBy("name", "year", "_runs").agg(F.count(F.lit(1)).alias("_n"), F.min("group_id").alias("_cls")), "ruling-classes")
    at = cls.select("name", F.explode("_runs").alias("run"), "year", "_n", "_cls")
    other = at.select("name", "run", F.col("year").alias("_y"), F.col("_n").alias("_m"), F.col("_cls").alias("_other"))
    met = at.join(other, ["name", "run"]).where("abs(year - _y) <= 1").select("_cls", "_other", "_m").distinct()
    count = cls.select("name", "year", "_runs", "_cls").join(met.groupBy("_cls").agg((F.sum("_m") - 1).alias("_linked")), "_cls").drop("_cls")
    linked = inside.join(count, ["name", "year", "_runs"]).select("group_id", "_linked")
    return peers.join(linked, "group_id", "left").where(F.col("peer_count") > F.coalesce("_linked", F.lit(0))).select("group_id")


def with_held(groups: DataFrame, held: DataFrame) -> DataFrame:
    """IDN21: held-back rows as groups of their own."""
    return groups.unionByName(held.select("row_key", F.col("row_key").alias("group_id")))


# --- registry and evidence


def registry(self_rows: DataFrame, corpus_rows: DataFrame) -> DataFrame:
    """REG01-REG03: (merge_key, decision_id, source_court, source) of both kinds of claims."""
    return self_rows.withColumn("source", F.lit("self_citation")).unionByName(corpus_rows.withColumn("source", F.lit("corpus"))).distinct()


def self_entries(merged: DataFrame) -> DataFrame:
    """REG02: the documents that a neutral key's rows name as themselves."""
    return merged.where("citation_kind = 'neutral'").select("merge_key", F.explode(F.split("self_citation_of", r"\|")).alias("decision_id"), "source_court").where("decision_id <> ''")


def one_key(matches: DataFrame, text_length: str = "text_length") -> DataFrame:
    """REG05: citations with exactly one match that covers them but for brackets and space (matches: citation_id, merge_key, match_span, rejected_reason)."""
    a = matches.groupBy("citation_id").agg(F.count(F.lit(1)).alias("_n"), F.min("merge_key").alias("merge_key"), F.min("rejected_reason").alias("_r"), F.max("match_span").alias("_s"), F.max(text_length).alias("_l"))
    return a.select("citation_id", F.when((F.col("_n") == 1) & (blank("_r") == "") & (F.col("_s") == F.col("_l")), F.col("merge_key")).alias("merge_key"), F.when(F.col("_n") > 1, "several_keys").when(blank("_r") != "", "rejected").when(F.col("_s") != F.col("_l"), "text_outside").otherwise("").alias("reason"))


def own_citations(claims: DataFrame) -> DataFrame:
    """REG04, REG06, REG09: claims (merge_key, decision_id, corpus_row, proven) with their status; qualified is a proven key of one document with one row and no other document's claim."""
    by_key = claims.where("proven").groupBy("merge_key").agg(F.count_distinct("decision_id").alias("_d"))
    by_doc = claims.groupBy("decision_id").agg(F.count_distinct("corpus_row").alias("_r"), F.count_distinct(F.when(F.col("proven"), F.col("merge_key"))).alias("_k"))
    j = claims.join(by_key, "merge_key", "left").join(by_doc, "decision_id")
    status = F.when(~F.col("proven"), "unproven").when(F.col("_r") > 1, "ambiguous_source_row").when(F.col("_d") > 1, "key_of_several_documents").when(F.col("_k") < 2, "single_claim").otherwise("qualified")
    return j.select("merge_key", "decision_id", status.alias("claim_status"), (status == "qualified").alias("identity_qualified"))


def crosscheck(self_rows: DataFrame, corpus_rows: DataFrame) -> DataFrame:
    """REG07: keys of either side and on which they stand."""
    a = self_rows.select("merge_key").distinct().withColumn("_a", F.lit(1))
    b = corpus_rows.select("merge_key").distinct().withColumn("_b", F.lit(1))
    return a.join(b, "merge_key", "full_outer").select("merge_key", F.when(F.col("_b").isNull(), "self_not_in_corpus").when(F.col("_a").isNull(), "corpus_not_in_self").otherwise("both").alias("side"))


def registry_report(keys: DataFrame, reg: DataFrame) -> DataFrame:
    """REG08: registered and foreign keys by the code of their court."""
    r = reg.select("merge_key").distinct().withColumn("_r", F.lit(True))
    return keys.withColumn("family", key_part("merge_key", 2)).join(r, "merge_key", "left").groupBy("family").agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("_r")).alias("registered"))


def pair_separations(table: DataFrame, keys: DataFrame) -> DataFrame:
    """REG10: reviewed pairs that must stay apart, in key order; a pair with an unknown key fails."""
    t = table.select(F.least("left_merge_key", "right_merge_key").alias("a"), F.greatest("left_merge_key", "right_merge_key").alias("b")).distinct()
    k = keys.select("merge_key").distinct().withColumn("_k", F.lit(True))
    j = t.join(k.withColumnRenamed("merge_key", "a"), "a", "left").join(k.select(F.col("merge_key").alias("b"), F.col("_k").alias("_m")), "b", "left")
    return j.select("a", "b", F.when(F.col("_k") & F.col("_m"), F.lit(True)).otherwise(F.raise_error(F.lit("separation of an unknown key")).cast("boolean")).alias("known"))


def court_tokens(aliases: DataFrame) -> DataFrame:
    """REG11: names, codes and labels of one court under its smallest name (aliases: a, b)."""
    return connected_components(aliases, "a", "b").select(F.col("node").alias("label"), F.col("component").alias("court_token"))


def scope_conflict(left: Column, right: Column) -> Column:
    """REG12: both sides say which courts they allow, and no court is on both."""
    return (F.size(left) > 0) & (F.size(right) > 0) & ~F.arrays_overlap(left, right)


def evidence_snapshot(rows: DataFrame, kind: str, value: str, scope: str = "court") -> DataFrame:
    """REG13: facts with ids that follow from their content."""
    r = rows.select(F.lit(kind).alias("fact_kind"), F.col("merge_key"), F.col(value).cast("string").alias("value"), F.lit(scope).alias("scope")).distinct()
    return r.withColumn("evidence_id", fact_id(fact_kind="fact_kind", merge_key="merge_key", scope="scope", value="value"))


def history_split(members: DataFrame, sides: DataFrame, group: str = "group_id") -> DataFrame:
    """IDN14: groups with both sides of one printed history (sides: instance, side, merge_key), which ``history_parts`` parts."""
    m = members.select(group, "merge_key").join(sides, "merge_key")
    return m.groupBy(group, "instance").agg(F.count_distinct("side").alias("_s")).where("_s = 2").select(group, "instance")
