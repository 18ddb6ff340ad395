"""Model judgments from a table of stored answers: gates, scopes and caps. Nothing is called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank

# The gates of the two tiers.
GATES = {"T1": {"p_max": 0.80, "ratio": 3.0}, "T2": {"p_max": 0.90, "ratio": 5.0, "noul": 0.90}, "review_floor": 0.60}


def answers(questions: DataFrame, cache: DataFrame, on: list[str]) -> DataFrame:
    """JEV01: stored answers (choice, p_max, ratio, noul) by question; a miss stays null and is never a default."""
    return questions.join(cache, on, "left")


def gate(tier: str, choice: Column, p_max: Column, ratio: Column, noul: Column | None = None, abstain: tuple[str, ...] = ()) -> Column:
    """JEV02: struct(decision, reason)."""
    g = GATES[tier]
    passed = (p_max >= g["p_max"]) & (ratio >= g["ratio"])
    said = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    out = F.when(blank(choice) == "", said("reject", "no_answer")).when(choice.isin(*abstain or ("\0",)), said("reject", "abstained"))
    if tier == "T2":
        n = F.lit(None).cast("double") if noul is None else noul
        out = out.when(passed & n.isNull(), said("review", "missing_agreement_check")).when(passed & (n < g["noul"]), said("review", "agreement_check_failed"))
    return out.when(passed, said("adopt", "")).when(p_max >= GATES["review_floor"], said("review", f"below_{tier}")).otherwise(said("reject", "low_probability"))


def cap(items: DataFrame, key: str, limit: int, seed: str) -> DataFrame:
    """JEV03: at most ``limit`` questions, those of the lowest seeded hash (another draw than a position sample, as steady)."""
    return items.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key).limit(limit)


def type_scope(rows: DataFrame, audit_rate: float, seed: str, key: str = "candidate_id") -> DataFrame:
    """JEV04: kept rows that no table supports, and a hashed share of the others for audit."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key))), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    open_ = (F.col("jurisdiction") == "UNSUPPORTED") & (blank("rejected_reason") == "")
    return rows.withColumn("scope", F.when(open_, "unsupported").when(h < audit_rate, "audit")).where(F.col("scope").isNotNull())


def name_options(preceding: Column, limit: int = 6) -> Column:
    """JEV05: the last capitalised spans before a citation, nearest last."""
    spans = F.regexp_extract_all(blank(preceding), F.lit(r"([A-Z][\w.&'’-]*(?:\s+(?:[A-Z][\w.&'’-]*|v\.|c\.|of|the|and|de|du|la))*)"), F.lit(1))
    return F.slice(spans, F.greatest(F.size(spans) - limit + 1, F.lit(1)), limit)


def suffix_questions(annotations: Column) -> Column:
    """JEV06: the distinct labels to be asked about, nothing else of the row."""
    return F.array_sort(F.array_distinct(F.transform(annotations, lambda a: a["raw"])))


def apply_judgments(rows: DataFrame, judged: DataFrame, key: str, flag: str, value: str) -> DataFrame:
    """JEV07, JEV08: adopted judgments as a column of their own; what rules said stays."""
    j = judged.where("decision = 'adopt'").select(key, F.lit(value).alias(flag)).dropDuplicates([key])
    return rows.join(j, key, "left").withColumn(flag, F.coalesce(flag, F.lit("")))


def date_corroboration(rows: DataFrame, judged: DataFrame, key: str = "source_id") -> DataFrame:
    """JEV09: a model's header date only confirms or contradicts the provider's year, and changes neither."""
    j = rows.join(judged.select(key, "model_native_date", "model_date_p"), key, "left")
    return j.withColumn("model_date_status", F.when(F.col("model_native_date").isNull(), "not_asked").when(F.year("model_native_date") == F.col("provider_decision_year"), "corroborates").otherwise("contradicts"))


def post_pass(rows: DataFrame, judged: DataFrame, columns: list[str], key: str = "candidate_id") -> DataFrame:
    """JEV10: rule columns are stamped as rule_*, model columns added as model_*."""
    r = rows.select("*", *[F.col(c).alias(f"rule_{c}") for c in columns])
    m = judged.select(key, *[F.col(c).alias(f"model_{c}") for c in columns])
    return r.join(m, key, "left")
