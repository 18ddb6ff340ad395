"""Views of the citation model over star-schema tables, in Spark and as SQL text.

Orders are the citing documents, parts the cited cases, line items the mentions;
each SQL view says the same as its Spark twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.scalar import merge_key_v1


#: Mentions that one task groups, about.
ROWS_A_TASK = 500_000


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def parts(self) -> int:
        """Tasks over which mentions are dealt, so that one holds about as many at every size; files tell their rows without being read."""
        return max(self.spark.sparkContext.defaultParallelism, self.t("lineitem").count() // ROWS_A_TASK + 1)

    def mentions(self) -> DataFrame:
        j = self.t("lineitem").join(self.t("part"), F.col("l_partkey") == F.col("p_partkey"))
        m = j.select(
            F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("source_id"), "l_orderkey", F.col("l_linenumber").alias("position"), F.col("l_partkey").alias("group_id"),
            F.col("l_suppkey").alias("supp"), F.year("l_shipdate").alias("year"), F.col("l_linenumber").cast("string").alias("vol"), F.col("p_brand").alias("abbr"),
            F.col("p_size").cast("string").alias("page"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("long").alias("qty"),
        )
        return m.withColumn("merge_key", merge_key_v1("year", "vol", "abbr", F.lit(""), "page"))

    def sources(self) -> DataFrame:
        j = self.t("orders").join(self.t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(self.t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return j.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("source_id"), F.col("n_name").alias("court"), F.year("o_orderdate").alias("year"))

    def groups(self) -> DataFrame:
        m = self.mentions().select("group_id", "source_id", "name", "year").repartition(self.parts(), "group_id", "source_id")  # as edges
        one = m.groupBy("group_id", "source_id").agg(F.count(F.lit(1)).alias("occ"), F.min("name").alias("name"), F.min("year").alias("year"))
        return one.groupBy("group_id").agg(F.count("source_id").alias("dd"), F.sum("occ").alias("occ"), F.min("name").alias("name"), F.min("year").alias("year"))

    def suppliers(self) -> DataFrame:
        return self.t("supplier").join(self.t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("supp"), "n_name", "n_regionkey")

    def edges(self) -> DataFrame:
        """(source, group) with mention count, origin by its smallest supplier's region, and support by flags."""
        m = self.mentions().join(self.suppliers(), "supp").select("source_id", "group_id", "flag", "n_regionkey")
        m = m.repartition(self.parts(), "source_id")  # hardly any pair repeats, so grouping before the shuffle would hold all pairs of a file's part
        e = m.groupBy("source_id", "group_id").agg(F.count(F.lit(1)).alias("mention_count"), F.min("n_regionkey").alias("_r"), F.some(F.col("flag") == "R").alias("_f"))
        origin = F.when(F.col("_r") == 0, "DOMESTIC_CA").when(F.col("_r") == 4, "UNDETERMINED").otherwise("FOREIGN")
        return e.select("source_id", "group_id", "mention_count", origin.alias("foreign_status"), F.when(F.col("_f"), "heuristic_only").otherwise("supported").alias("edge_support"))

    def intervals(self) -> DataFrame:
        """Spans in a user's hour: start by minute, length by value, shape by type."""
        s = (F.minute("ts") * 60 + F.second("ts")).cast("long")
        rank = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 3).otherwise(4)
        return self.t("events").select("event_id", F.concat_ws(":", F.col("user_id").cast("string"), F.hour("ts").cast("string")).alias("doc"), s.alias("start"), (s + 1 + F.floor(F.col("value") / 10)).alias("end"), "event_type", rank.cast("long").alias("rank"))


M = """m AS (SELECT 'O' || l_orderkey AS source_id, l_orderkey, l_linenumber AS position, l_partkey AS group_id, l_suppkey AS supp,
  CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_linenumber AS VARCHAR) AS vol, p_brand AS abbr, CAST(p_size AS VARCHAR) AS page,
  p_name AS name, p_type AS kind, l_returnflag AS flag, CAST(l_quantity AS BIGINT) AS qty,
  year(l_shipdate) || '|' || l_linenumber || '|' || lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) || '||' || p_size AS merge_key
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
D = """d AS (SELECT 'O' || o_orderkey AS source_id, n_name AS court, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
G = M + """, g AS (SELECT group_id, count(DISTINCT source_id) AS dd, count(*) AS occ, min(name) AS name, min(year) AS year FROM m GROUP BY group_id)"""
S = """s AS (SELECT s_suppkey AS supp, n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
E = (
    G
    + ", "
    + S
    + """, e AS (SELECT source_id, group_id, count(*) AS mention_count,
  CASE WHEN min(n_regionkey) = 0 THEN 'DOMESTIC_CA' WHEN min(n_regionkey) = 4 THEN 'UNDETERMINED' ELSE 'FOREIGN' END AS foreign_status,
  CASE WHEN bool_or(flag = 'R') THEN 'heuristic_only' ELSE 'supported' END AS edge_support
  FROM m JOIN s USING (supp) GROUP BY source_id, group_id)"""
)
I = """i AS (SELECT event_id, user_id || ':' || hour(ts) AS doc, CAST(minute(ts) * 60 + second(ts) AS BIGINT) AS "start",
  CAST(minute(ts) * 60 + second(ts) + 1 + floor(value / 10) AS BIGINT) AS "end", event_type,
  CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS rank FROM events)"""
