"""Message sources (K1-K3, X4, X5): every reader yields a ``value`` text column."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The key of a history line, and the words of a yes/no argument.
GOODS_KEY_PATTERN = r'"goodsId"\s*:\s*"?(\d+)"?'
_YES = ("true", "1", "yes", "on")
_NO = ("false", "0", "no", "off")


@dataclass(frozen=True)
class SourceOptions:
    """Where messages come from. A file without ``local`` is noted but not used."""

    local: bool
    file_given: bool
    path: str | None

    @property
    def kind(self) -> str:
        return "file" if self.local else "kafka"


def resolve_options(args: Sequence[str] | None, default_path: str | None = None) -> SourceOptions:
    """Read ``--local [yes/no]`` and ``--file path`` (also ``--name=value``); bad words raise."""
    words = [w for a in (args or ()) if a and a.strip() for w in a.split()]
    local, path, file_given = False, default_path, False
    n = 0
    while n < len(words):
        name, eq, value = words[n].partition("=")
        follows = words[n + 1] if n + 1 < len(words) else None
        n += 1
        if name == "--local":
            if not eq and follows is not None and not follows.startswith("--"):
                value, n = follows, n + 1
            elif not eq:
                value = "true"
            local = _flag(value)
        elif name == "--file":
            file_given = True
            if not eq:
                if follows is None:
                    raise ValueError("--file needs a path")
                value, n = follows, n + 1
            path = value
    return SourceOptions(local, file_given, path)


def _flag(word: str) -> bool:
    lowered = word.strip().lower()
    if lowered not in _YES + _NO:
        raise ValueError(f"--local takes true/false, 1/0, yes/no or on/off, not {word!r}")
    return lowered in _YES


def read_source(spark: SparkSession, kind: str, location: str, topic: str | None = None,
                group: str | None = None, starting: str = "earliest", **options) -> DataFrame:
    """K1/K2: a stream of messages.

    ``kafka``: one topic, values only, empty ones dropped; a restarted query goes on from its
    checkpoint, a new one from ``starting``. ``file``: one whole document per file. ``lines``: one
    document per line.
    """
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", location)
            .option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "true")
        )
        if group:
            reader = reader.option("kafka.group.id", group)
        rows = reader.options(**options).load().select(F.col("value").cast("string").alias("value"))
    elif kind == "file":
        if spark.read.text(location, wholetext=True).where(F.trim("value") != "").isEmpty():
            raise ValueError(f"no message in {location}")
        rows = _one_file(spark, location) or spark.readStream.text(location, wholetext=True)
    elif kind == "lines":
        rows = spark.readStream.text(location)
    else:
        raise ValueError(f"unknown source kind {kind!r}")
    return rows.where(F.length("value") > 0).select("value")


def _one_file(spark: SparkSession, location: str) -> DataFrame | None:
    """A stream of a single file; streams read folders, so it is picked from its own."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not (fs.exists(target) and fs.getFileStatus(target).isFile()):
        return None
    name = re.sub(r"([\\\[\]{}*?])", r"\\\1", target.getName())
    return spark.readStream.option("pathGlobFilter", name).text(target.getParent().toString(), wholetext=True)


def backfill_lines(lines: DataFrame, key_pattern: str | None = GOODS_KEY_PATTERN) -> DataFrame:
    """K3: JSON lines without blank ones, trimmed, with the first key match (NULL without one)."""
    value = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    key = F.nullif(F.regexp_extract("value", key_pattern, 1), F.lit("")) if key_pattern else F.lit(None)
    return lines.select(value.alias("value")).where("value <> ''").select(key.cast("string").alias("key"), "value")


def jsonl_backfill(spark: SparkSession, path: str, key_pattern: str | None = GOODS_KEY_PATTERN) -> DataFrame:
    """K3 as a stream: the query's checkpoint makes a stopped backfill go on where it was."""
    return backfill_lines(spark.readStream.text(path), key_pattern)
