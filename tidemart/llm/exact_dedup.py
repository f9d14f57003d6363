"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then of the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import BLANKS, load, maybe_member, staged

#: Characters of a text that the second step hashes.
HEAD_CHARS = 128


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def full_hash(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and text_sha256.

    text_sha256 is there where the refinement needed it, or for every row if ``digests`` asks for that.

    Texts are equal when identical after replacing each run of white space by one space; null counts as
    empty. The whole text is hashed only for rows whose length and beginning occur more than once; which
    ones these are reaches the scan as a bitmap, so texts are never shuffled. Rows with a null id count as
    larger than all others. Rows that repeat the smallest id of their group all stay: they are one row
    given more than once. An empty table gives an empty result; other columns are ignored.
    """
    text = normalised(F.col(text_col))
    shape = staged(docs.select(F.length(text).alias("chars"),
                               F.xxhash64(F.substring(text, 1, HEAD_CHARS)).alias("head")))
    shared = shape.groupBy("chars").agg(F.count("*").alias("n")).filter("n > 1").select("chars")
    heads = (maybe_member(shape, F.col("chars"), shared, F.col("chars"), "again").filter("again")
             .groupBy("chars", "head").agg(F.count("*").alias("n")).filter("n > 1"))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.struct(F.length(text), F.xxhash64(F.substring(text, 1, HEAD_CHARS))).alias("shape"))
    rows = maybe_member(rows, F.col("shape"), heads, F.struct("chars", "head"), "again")
    sha = full_hash(F.col("text"))
    hashed = staged(rows.select("id", "again", (sha if digests else F.when(F.col("again"), sha)).alias("sha")))

    groups = (hashed.filter("again").groupBy("sha")
              .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"))
    hit = hashed.filter("again").join(groups, "sha", "left")
    alone = hashed.filter("not again").select(
        "sha", "id", F.lit(None).cast(hashed.schema["id"].dataType).alias("keep_id"),
        F.lit(None).cast("long").alias("group_size"))
    found = hit.select("sha", "id", "keep_id", "group_size").unionAll(alone)
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_rows(docs: DataFrame, gone: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id and ``key`` are in ``gone`` (id and key, in this order); only rows that may be
    among them are shuffled.

    The key tells texts apart that share an id. Rows with a null id always stay: no decision can be tied to them.
    """
    gone = gone.toDF("_llm_gone", "_llm_key")
    marked = maybe_member(docs, F.col(id_col), gone, F.col("_llm_gone"), "_llm_maybe")
    checked = marked.filter("_llm_maybe").withColumns({"_llm_gone": F.col(id_col), "_llm_key": key})
    checked = checked.join(gone, ["_llm_gone", "_llm_key"], "left_anti")
    checked = checked.drop("_llm_gone", "_llm_key")
    return marked.filter("not _llm_maybe").unionAll(checked).drop("_llm_maybe")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    gone = staged(exact_groups(docs, id_col, text_col).filter("not kept").select(id_col, "text_sha256").distinct())
    return drop_rows(docs, gone, full_hash(F.col(text_col)), id_col)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document it equals."""
    return exact_groups(load(spark, sf_dir, "documents"), digests=True)


ORACLE = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)"""
