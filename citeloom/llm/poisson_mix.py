"""Mixing sources to target weights by Poisson replication.

A source of n rows and target share w of T output rows has the mean repetition
rate w * T / n. Each row draws its count from the Poisson distribution of its
source's rate, by inverting the distribution function at a uniform number that
is a hash of seed and id; the same row gets the same count on every run. Copies
are numbered, and the output is dealt over the cluster by a hash of seed, id and
copy and sorted by it inside each partition: a global shuffle.

Plan: one aggregation for the sizes of the sources; their table, a row for each
source, is joined by broadcast only while it has at most
``MAX_BROADCAST_SOURCES`` rows, else by an exchange whose hot keys AQE splits;
then one range exchange.

Defined results: a null source is a source of its own, named by the key None;
sources without a target get no rows if ``targets`` is given; a null id is
drawn as the id "null"; repeated rows draw the same count and each is copied;
texts play no part; columns of the input are kept, and the added ones replace
those of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.staging import fresh, staged

MAX_BROADCAST_SOURCES = 10_000
#: 48 bits of MD5 make the uniform number.
_HEX, _RANGE = 12, float(2**48)


def hash_int(*parts: Column) -> Column:
    """48 bits of the MD5 of the parts, joined by |, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, _HEX), 16, 10).cast("long")


def source_rates(docs: DataFrame, source_col: str, targets: dict | None, rows_out: float | None, temperature: float) -> DataFrame:
    """Each source's size, rate and distribution function as an array."""
    sizes = docs.groupBy(F.col(source_col).alias("_src")).agg(F.count(F.lit(1)).alias("_size"))
    if targets is None:
        sizes = sizes.withColumn("_w", F.pow(F.col("_size").cast("double"), F.lit(1.0 / temperature)))
    else:
        names = [k for k in targets if k is not None]
        given = F.create_map(*[F.lit(x) for k in names for x in (k, float(targets[k]))]) if names else F.lit(None).cast("map<string,double>")
        sizes = sizes.withColumn("_w", F.coalesce(F.when(F.col("_src").isNull(), F.lit(float(targets.get(None, 0.0)))).otherwise(F.try_element_at(given, F.col("_src").cast("string"))), F.lit(0.0)))
    total = sizes.agg(F.sum("_size").alias("_t"), F.sum("_w").alias("_tw"))
    out = F.lit(float(rows_out)) if rows_out is not None else F.col("_t").cast("double")
    rates = sizes.crossJoin(F.broadcast(total)).withColumn("_rate", F.when(F.col("_tw") > 0, F.col("_w") * out / F.col("_tw") / F.col("_size")).otherwise(F.lit(0.0)))
    # P(X <= k) for k = 0, 1, ... until what is missing is below a hash step
    last = F.ceil(F.col("_rate") + 12 * F.sqrt("_rate") + 24).cast("int")
    step = lambda acc, k: F.struct(
        (acc["lp"] + F.when(k > 0, F.log(F.col("_rate")) - F.log(k.cast("double"))).otherwise(0.0)).alias("lp"),
        (acc["p"] + F.exp(acc["lp"] + F.when(k > 0, F.log(F.col("_rate")) - F.log(k.cast("double"))).otherwise(0.0))).alias("p"),
        F.array_append(acc["cdf"], acc["p"] + F.exp(acc["lp"] + F.when(k > 0, F.log(F.col("_rate")) - F.log(k.cast("double"))).otherwise(0.0))).alias("cdf"),
    )
    start = F.struct((-F.col("_rate")).alias("lp"), F.lit(0.0).alias("p"), F.array().cast("array<double>").alias("cdf"))
    cdf = F.when(F.col("_rate") > 0, F.aggregate(F.sequence(F.lit(0), last), start, step, lambda a: a["cdf"])).otherwise(F.array(F.lit(2.0)))
    return rates.select("_src", "_size", "_rate", cdf.alias("_cdf"))


def poisson_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    targets: dict | None = None,
    rows_out: float | None = None,
    temperature: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """Rows of ``docs`` replicated to the target shares and shuffled globally.

    ``targets`` maps source to weight; without it the weight is the size to the
    power 1 / ``temperature``. ``rows_out`` is the expected number of rows, by
    default that of the input. Added columns: ``copy`` (from 1), ``n_copies``,
    ``shuffle_key`` (ascending inside partitions and between them).
    """
    rates = staged(source_rates(docs, source_col, targets, rows_out, temperature), "mix-rates")
    small = rates.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES
    kept = docs.drop("copy", "n_copies", "shuffle_key")
    src, cdf = fresh(kept, "_src"), fresh(kept, "_cdf")
    rates = rates.select(F.col("_src").alias(src), F.col("_cdf").alias(cdf))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    u = hash_int(F.lit(str(seed)), name) / F.lit(_RANGE)
    drawn = (
        kept.join(F.broadcast(rates) if small else rates, F.col(source_col).eqNullSafe(F.col(src)))
        .withColumn("n_copies", F.size(F.filter(cdf, lambda c: c <= u)).cast("long"))
        .drop(src, cdf)
        .where(F.col("n_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
        .withColumn("shuffle_key", hash_int(F.lit(str(seed)), name, F.col("copy").cast("string")))
    )
    return drawn.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")


def poisson_cdf(rate: float, k: int) -> float:
    """P(X <= k), for tests."""
    return sum(math.exp(-rate + i * math.log(rate) - math.lgamma(i + 1)) for i in range(k + 1))
