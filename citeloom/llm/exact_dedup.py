"""Exact deduplication: 128-bit content hash, then the bytes themselves.

Plan: every text is hashed to 128 bits; rows are grouped by (hash, bytes), so
two texts that only share the hash stay apart. The grouping pre-aggregates
before its exchange: a group of copies that holds a third of all rows sends
one row per map task. Rows then meet their group on small keys (hash and
SHA-256, never the text); AQE may split a hot key of that join, since each
group is one row.

Defined results: a null text counts as empty, and all empty texts are one
group; rows with the same id and text are copies like any others, each is
returned, and all that carry the kept id stay; a null id is only kept where the
group has no other id; an empty table gives an empty result. Columns of the
input other than id and text are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.staging import fresh, staged


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and text_sha256.

    ``keep`` is "smallest" or "largest": which id of equal texts stays. Texts
    are equal when identical after lower-casing A-Z.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), norm.alias("_norm")).withColumn("_h", F.unhex(F.md5("_norm")))
    pick = F.min if keep == "smallest" else F.max
    groups = (
        rows.groupBy("_h", "_norm")
        .agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_h", F.unhex(F.sha2("_norm", 256)).alias("_s"), "keep_id", "group_size")
    )
    groups = staged(groups, "exact-groups")
    each = rows.select("_id", "_h", F.unhex(F.sha2("_norm", 256)).alias("_s"))
    return each.join(groups, ["_h", "_s"]).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_s")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The input's rows, all columns, without the copies that do not stay.

    Rows that agree in id and text both stay: nothing tells them apart. Each row is
    judged by its id and its own text, so a null or repeated id takes no other text along.
    """
    of, own = fresh(docs, "_of"), fresh(docs, "_sha")
    gone = exact_groups(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text", keep).where(~F.col("kept"))
    gone = gone.select(F.col("_id").alias(of), F.col("text_sha256").alias(own)).distinct()
    sha = F.sha2(ascii_lower(F.coalesce(docs[text_col].cast("string"), F.lit(""))), 256)
    return docs.join(gone, docs[id_col].eqNullSafe(gone[of]) & (sha == gone[own]), "left_anti")
