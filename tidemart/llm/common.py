"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One space, tab, line feed, vertical tab, form feed or carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
_BITMAP_BITS = 32768  # per row of Spark's bitmap functions


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemart-llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``. One is made only where it is unset, on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("start the session with spark.checkpoint.dir, a folder that all executors share")
        folder = _local_folder()
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: a short lineage that survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Texts can be long, so a Python worker gets few rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Every row with its place (from 0) in the total order ``order``.

    A range-partitioned sort deals any key, however frequent, over all tasks as long as the order ends in
    a distinct column; only one row per sort task is then added up to find where each task's rows begin.
    """
    place = staged(df.orderBy(*order).withColumn("_llm_place", F.monotonically_increasing_id()))
    task = F.shiftright("_llm_place", 33)
    begins = place.groupBy(task.alias("_llm_task")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_llm_task").rowsBetween(Window.unboundedPreceding, -1)
    begins = begins.select("_llm_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_llm_begin"))
    within = F.col("_llm_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (place.withColumn("_llm_task", task).join(F.broadcast(begins), "_llm_task")
            .withColumn(name, F.col("_llm_begin") + within).drop("_llm_task", "_llm_begin", "_llm_place"))


def maybe_member(df: DataFrame, key: Column, members: DataFrame, member: Column, name: str,
                 bits: int = 1 << 25) -> DataFrame:
    """``df`` with a boolean ``name``: false only if ``key`` is surely not among ``members``.

    The members become a hashed bitmap of ``bits`` bits, 4 MB by default however many they are, which is
    broadcast; ``df`` isn't shuffled. A crowded bitmap answers true more often and loses nothing.
    """
    spread = lambda x: F.pmod(F.xxhash64(x), F.lit(bits))
    marks = (members.select(spread(member).alias("_llm_bit"))
             .groupBy(F.expr(f"_llm_bit div {_BITMAP_BITS}").alias("_llm_row"))
             .agg(F.expr(f"bitmap_construct_agg(_llm_bit % {_BITMAP_BITS})").alias("_llm_map")))
    byte = F.expr(f"conv(hex(substring(_llm_map, int((_llm_bit % {_BITMAP_BITS}) div 8) + 1, 1)), 16, 10)").cast("int")
    bit = F.expr("int(_llm_bit % 8)")
    return (df.withColumn("_llm_bit", spread(key)).withColumn("_llm_row", F.expr(f"_llm_bit div {_BITMAP_BITS}"))
            .join(F.broadcast(marks), "_llm_row", "left")
            .withColumn(name, F.coalesce(F.call_function("getbit", byte, bit) == 1, F.lit(False)))
            .drop("_llm_bit", "_llm_row", "_llm_map"))


def columns(df: DataFrame) -> list[Column]:
    """All columns by name, whatever characters the names hold."""
    return [df["`" + name.replace("`", "``") + "`"] for name in df.columns]


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")
