"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import columns, load, ranked, staged, word_count

#: A document can be taken this many times at most, so a source's target stops at this multiple of its size.
LIMIT = 3
#: Sources in order of their names weigh 1, 2, 3, 1, 2, ...
WEIGHTS = 3
#: The one random offset of the sampling, in [0, 1): drawn once, then kept so that reruns agree.
OFFSET = 0.6180339887498949

_WHOLE = "decimal(19,0)"


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target of the rows (source, size), sizes being whole numbers.

    The targets share the sum of all sizes by weight. Where a share is above ``LIMIT`` times its source,
    the target stops there and the excess is shared again by weight, until none is above. Each round is one
    aggregate over the sources; its sums are whole numbers, so no order of adding changes a target.
    """
    sizes = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = staged(ranked(sizes, [F.col("source").asc_nulls_last()], "place").select(
        "source", "source_size", (F.col("place") % WEIGHTS + 1).cast(_WHOLE).alias("weight"),
        (F.col("source_size") * LIMIT).cast(_WHOLE).alias("cap")))
    whole = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]

    share, per = whole, 1  # what each unit of weight gets is share / per
    if whole:
        share, per, capped = int(whole), int(sources.agg(F.sum("weight")).first()[0]), -1
        while True:
            above = _above(share, per)
            row = sources.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight"))),
                              F.count(F.when(above, 1))).first()
            if row[2] == capped or row[1] is None:
                break
            capped, share, per = row[2], int(whole) - int(row[0] or 0), int(row[1])
    part = (F.col("weight") * F.lit(share).cast(_WHOLE)).cast("double") / F.lit(per).cast("double")
    return sources.select("source", "source_size",
                          F.when(_above(share, per), F.col("cap").cast("double")).otherwise(part).alias("target"))


def _above(share: int, per: int) -> Column:
    return F.col("cap") * F.lit(per).cast(_WHOLE) <= F.col("weight") * F.lit(share).cast(_WHOLE)


def mix_copies(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
               offset: float = OFFSET) -> DataFrame:
    """id, size, source_size, target, copies, taken: how often the mix takes each row of ``docs``.

    Each document of a source expects target / source_size copies. Running over the source from its
    smallest to its largest document, a copy is emitted for each whole number that the running sum of
    expected copies, begun at ``offset``, crosses. In that order the words taken stray from the target by no
    more than the longest document. A null source is a source of its own, last; documents without words
    are sampled like others and add nothing; rows with equal source, size and id change places freely,
    which changes no row of the result. An empty table gives an empty result.
    """
    sized = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")))
    targets = source_targets(sized)
    order = ranked(sized, [F.col("source").asc_nulls_last(), F.col("size"), F.col("id")])
    begins = order.groupBy("source").agg(F.min("rank").alias("begin"))
    per_source = (targets.join(begins, targets["source"].eqNullSafe(begins["source"]))
                  .select(targets["source"].alias("of"), "source_size", "target", "begin"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("rank") - F.col("begin")
    crossed = F.floor((place + 1) * expected + offset) - F.floor(place * expected + offset)
    return (order.join(per_source, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("copies", crossed.cast("long"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, all columns kept.

    Rows that share an id are taken equally often, the largest number any of them has.
    """
    copies = (mix_copies(docs, size, id_col, source_col).filter("copies > 0")
              .groupBy(F.col(id_col).alias("_llm_id")).agg(F.max("copies").alias("_llm_copies")))
    taken = docs.join(copies, docs[id_col].eqNullSafe(copies["_llm_id"]))
    taken = taken.withColumn("_llm_copy", F.explode(F.expr("sequence(1L, _llm_copies)")))
    return taken.select(*columns(docs))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = load(spark, sf_dir, "documents")
    return mix_copies(docs, word_count(F.col("text"))).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {WEIGHTS} + 1)::HUGEINT AS weight
  FROM d GROUP BY source),
r(step, share, per) AS (
  SELECT 0, sum(source_size)::HUGEINT, sum(weight)::HUGEINT FROM s
  UNION
  SELECT step + 1,
         (SELECT sum(source_size) FROM s)::HUGEINT
           - (SELECT coalesce(sum({LIMIT} * source_size), 0) FROM s
              WHERE {LIMIT} * source_size * per <= weight * share)::HUGEINT,
         (SELECT sum(weight) FROM s WHERE {LIMIT} * source_size * per > weight * share)::HUGEINT
  FROM r WHERE step < 60),
last AS (SELECT share, per FROM r WHERE per IS NOT NULL ORDER BY step DESC LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN {LIMIT} * source_size * per <= weight * share
    THEN ({LIMIT} * source_size)::DOUBLE ELSE (weight * share)::DOUBLE / per::DOUBLE END AS target
  FROM s, last),
p AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS expected,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) - 1 AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, (floor((place + 1) * expected + {OFFSET}) - floor(place * expected + {OFFSET}))::BIGINT AS copies FROM p)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, (copies * size)::BIGINT AS taken,
       copies FROM c"""
