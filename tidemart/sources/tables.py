"""Tables on shared storage (K4-K7, K9, K11): Parquet, partitioned by day.

A raw table is append-only. A clean or daily table keeps one row per key. Writing a batch costs what the batch holds,
however large the day partitions are; readers take the newest row per key, and ``compact`` folds batches into the merged
part. Where a lakehouse catalog is available its MERGE does the same.

A batch is written to partitions that carry its writer's name and its own, replacing them: a batch that
is replayed after a failure leaves the table as if it had been written once. The merged part keeps
the write order of every row, so a replay after a merge doesn't put older rows back.

A merge writes new folders beside those in use, each day once, and then publishes a version: one small file that names the
merged folders of each day, the batch files that are folded into them, and the kept minima (``STATES``). Readers see the
version before or the version after, never a mixture, and frames made before keep reading their own folders, which stay
until the merge after the next.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.keyed import latest_per_key
from tidemart.operators.quality import write_audit
from tidemart.schemas import STATES, TABLES, Table

#: Directory name of a partition without a value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
SEQ = T.StructField("_seq", T.LongType())
BATCH = T.StructField("_batch", T.StringType())
#: Folders of a kept minimum after which a merge makes one of them.
STATE_FOLDERS = 16


def _on(days: list[str]) -> Column:
    """Rows of the days, given as the names of their partitions."""
    known = [dt.date.fromisoformat(day) for day in days if day != NO_DAY]
    return F.when(F.col("date").isNull(), F.lit(NO_DAY in days)).otherwise(F.col("date").isin(known))


def _batch(batch_id, writer: str) -> Column:
    return F.lit(f"{writer}@{batch_id}" if writer else str(batch_id))


class Version(NamedTuple):
    """What a table consists of, besides the batch files not folded yet. Folders are relative to the table's."""

    number: int = 0
    days: dict[str, list[str]] = {}
    folded: list[str] = []
    states: dict[str, list[str]] = {}


class Warehouse:
    """Tables below ``root``. ``files_per_day`` bounds the files, and with them the tasks, that write a day;
    by default the measured size decides."""

    def __init__(self, spark: SparkSession, root: str, files_per_day: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files_per_day = files_per_day

    # -- paths -----------------------------------------------------------------------------

    def _path(self, table: str, part: str) -> str:
        return f"{self.root}/{table}/{part}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def _found(self, table: str, pattern: str) -> list[str]:
        """Paths below the table's folder, relative to it: names only, nothing is opened."""
        fs, target = self._fs(f"{self.root}/{table}")
        found = fs.globStatus(target.suffix(f"/{pattern}")) or []
        depth = pattern.count("/") + 1
        return ["/".join(s.getPath().toString().rsplit("/", depth)[1:]) for s in found]

    # -- versions --------------------------------------------------------------------------

    def version(self, table: str, number: int | None = None) -> Version:
        """The published version, or an earlier one that is still there."""
        known = sorted(int(name[len("_versions/"):-len(".json")]) for name in self._found(table, "_versions/*.json"))
        if not known:
            return Version()
        fs, target = self._fs(self._path(table, f"_versions/{known[-1] if number is None else number:012d}.json"))
        if not fs.exists(target):
            return Version()
        stream = fs.open(target)
        try:
            return Version(**json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def publish(self, table: str, version: Version) -> None:
        """The file gets its name when it is complete; whoever lists names sees the old version or the new one."""
        fs, draft = self._fs(self._path(table, f"_versions/.{uuid.uuid4().hex}"))
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(version._asdict()).encode()))
        stream.close()
        _, target = self._fs(self._path(table, f"_versions/{version.number:012d}.json"))
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"{table}: version {version.number} was published by another merge")

    def _fresh(self, table: str, version: Version) -> list[str]:
        """Batch files written since the last merge."""
        part = "rows" if TABLES[table].kind == "raw" else "batches"
        return sorted(set(self._found(table, f"{part}/date=*/_batch=*/*.parquet")) - set(version.folded))

    # -- writing ---------------------------------------------------------------------------

    def _write(self, df: DataFrame, path: str, keys, *partitions: str) -> None:
        """K6: day partitions. A large day is split over as many tasks as its size asks for and small ones share a task.

        With a bound on the files, keyed rows are placed by key hash. Raw rows (no ``keys``) are written where they are,
        without a shuffle; a merge makes few files of them.
        """
        if not keys:
            placed = df
        elif self.files_per_day is None:
            placed = df.hint("rebalance", *[F.col(p) for p in partitions])
        else:
            place = F.xxhash64(*[F.col(k).cast("string") for k in keys])
            placed = df.repartition("date", F.pmod(place, F.lit(self.files_per_day)))
        (
            placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions).parquet(path)
        )

    def append_raw(self, df: DataFrame, table: str, batch_id, writer: str = "") -> None:
        """K4/K7: every row, duplicates kept; writing the same batch of the same writer again replaces it."""
        rows = df.withColumn("_batch", _batch(batch_id, writer))
        self._write(rows, self._path(table, "rows"), (), "date", "_batch")

    def upsert_latest(self, df: DataFrame, table: str, batch_id, seq: int, order_cols=(), keys=None,
                      writer: str = "") -> None:
        """K5/K7: whole-row replacement per key, the later ``seq`` wins, also inside a batch.

        ``order_cols`` tell the last row of a key within the batch; ``seq`` grows with write time
        and is the same when a batch is replayed. Writers that share a table give their names, for
        each counts its own batches; a batch replaces only its own writer's batch of that id.
        """
        keys = keys or TABLES[table].keys
        if order_cols:
            df = latest_per_key(df, keys, order_cols).drop(*[c for c in order_cols if c.startswith("_")])
        rows = df.withColumns({"_seq": F.lit(seq).cast("bigint"), "_batch": _batch(batch_id, writer)})
        self._write(rows, self._path(table, "batches"), keys, "date", "_batch")

    def audit(self, df: DataFrame, layer: str, table: str, batch_id) -> None:
        """K9: rows per key of a batch that is already written; a replay replaces its entry."""
        entry = write_audit(df, layer, table, TABLES[table].keys, batch_id)
        (entry.withColumn("_batch", F.lit(f"{table}-{batch_id}"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(self._path("_audit", "rows")))

    def audit_counts(self, counts: list[tuple[str, str, int, int]], batch_id, seq: int) -> None:
        """K9 without keys: loaded and rejected rows of a batch by layer and table, with its time."""
        rows = self.spark.createDataFrame(counts, "layer string, table string, rows long, rejected long").coalesce(1)
        (rows.withColumns({"time": F.timestamp_micros(F.lit(seq)), "_batch": F.lit(str(batch_id))})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(self._path("_audit", "counts")))

    def keep_rejects(self, df: DataFrame, reason: str, batch_id) -> None:
        """Rows that could not be read or loaded, by reason and batch."""
        (df.withColumns({"reason": F.lit(reason), "_batch": F.lit(str(batch_id))})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("reason", "_batch").json(self._path("_rejects", "rows")))

    # -- reading ---------------------------------------------------------------------------

    def _read(self, table: Table, base: str, paths: list[str], *extra: T.StructField) -> DataFrame:
        """Rows of the given folders or files of the table; ``base`` is where its partition folders begin."""
        schema = T.StructType([*table.schema.fields, *extra])
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self._path(table.name, base))
        return found.parquet(*[self._path(table.name, p) for p in paths]).select(*[f.name for f in schema])

    def scan(self, name: str, dates=None) -> DataFrame:
        """The table as it is published now, only the day partitions asked for.

        For keyed tables the newest row per key is taken; the days are part of every key, so the
        day filter reaches the partitions of both parts.
        """
        table, version = TABLES[name], self.version(name)
        fresh, wanted = self._fresh(name, version), F.lit(True) if dates is None else F.col("date").isin(list(dates))
        if table.kind == "raw":
            old = self._read(table, "merged", [p for paths in version.days.values() for p in paths])
            return old.unionByName(self._read(table, "rows", fresh)).where(wanted)
        return self._latest(table, version, fresh, wanted).drop("_seq")

    def _latest(self, table: Table, version: Version, fresh: list[str], wanted: Column) -> DataFrame:
        """The newest row per key with its ``_seq``; only days written since the last merge are ranked.

        Of equal ``_seq`` the row written since the merge wins: the batch was written again.
        """
        touched = set(_days(fresh))
        paths = lambda some: [p for day, held in version.days.items() if (day in touched) == some for p in held]
        rest = self._read(table, "merged", paths(False), SEQ).where(wanted)
        if not fresh:
            return rest
        rows = self._read(table, "batches", fresh, SEQ).withColumn("_fresh", F.lit(True))
        if paths(True):
            rows = rows.unionByName(self._read(table, "merged", paths(True), SEQ).withColumn("_fresh", F.lit(False)))
        newest = latest_per_key(rows.where(wanted), table.keys, ["_seq", "_fresh"]).drop("_fresh")
        return rest.unionByName(newest) if paths(False) else newest

    def state(self, name: str) -> DataFrame:
        """The smallest values per key that a table has held, without a look at its history.

        What merges have kept is combined with the batches written since. Minima don't depend on order: late days and
        replays need nothing more. A value that a later batch replaces counts until then only if a merge had kept it.
        """
        spec = STATES[name]
        table, version = TABLES[spec.source], self.version(spec.source)
        rows = self._read(table, "batches", self._fresh(spec.source, version), SEQ)
        found = spec.minima(latest_per_key(rows, table.keys, ["_seq"]))
        return spec.combine(self._kept(name, version).unionByName(found))

    def _kept(self, name: str, version: Version) -> DataFrame:
        spec = STATES[name]
        folders = version.states.get(name)
        if folders is None:  # merged before there was such a state
            paths = [p for paths in version.days.values() for p in paths]
            return spec.minima(self._read(TABLES[spec.source], "merged", paths))
        paths = [self._path(spec.source, folder) for folder in folders]
        types = spec.minima(self._read(TABLES[spec.source], "merged", [])).schema
        return self.spark.read.schema(types).parquet(*paths)

    def tables(self) -> Mapping[str, DataFrame]:
        """All tables and kept minima by name, for the daily builds; each is looked up when it is first used."""
        return _Tables(self)

    # -- right edges of rebuilt ranges -----------------------------------------------------

    def write_edge(self, df: DataFrame, history: str, day: str) -> None:
        """What a range of days that ends with ``day`` hands to the next one."""
        df.write.mode("overwrite").parquet(self._path("_edges", f"{history}/{day}"))

    def edges(self, history: str) -> list[str]:
        """Last days of the ranges that are complete."""
        return sorted(path.split("/")[1] for path in self._found("_edges", f"{history}/*/_SUCCESS"))

    def read_edge(self, history: str, day: str) -> DataFrame:
        return self.spark.read.parquet(self._path("_edges", f"{history}/{day}"))

    # -- merging ---------------------------------------------------------------------------

    def prepare_merge(self, name: str) -> Version | None:
        """Write the batches' days anew beside the published ones; None if there are no batches.

        A keyed day is replaced as a whole. Of a raw day only the new rows are written, sorted by key, as one more folder.
        Nothing changes for readers until :meth:`publish`; what a lost job has left is overwritten by the next one.
        """
        table, version = TABLES[name], self.version(name)
        fresh = self._fresh(name, version)
        if not fresh:
            return None
        days, number = _days(fresh), version.number + 1
        folder = f"merged/_v={number}"
        if table.kind == "raw":
            rows = self._read(table, "rows", fresh)
            # The last sort column deals even a key that many rows share.
            order = ["date", *[k for k in table.keys if k != "date"], F.xxhash64(*rows.columns)]
            rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("date").parquet(
                self._path(name, folder))
        else:
            rows = self._latest(table, version, fresh, F.lit(True)).where(_on(days))
            self._write(rows, self._path(name, folder), table.keys, "date")
        kept = version.days if table.kind == "raw" else {}
        new = {day: [*kept.get(day, []), f"{folder}/date={day}"] for day in days}
        there = set(self._fresh(name, Version()))
        folded = sorted({*fresh, *(set(version.folded) & there)})
        return Version(number, version.days | new, folded, self._merged_states(name, version, fresh))

    def _merged_states(self, name: str, version: Version, fresh: list[str]) -> dict[str, list[str]]:
        """The new batches' minima as one more folder of each state; many folders become one."""
        out = {}
        for state, spec in STATES.items():
            if spec.source == name:
                folders = version.states.get(state)
                whole = folders is None or len(folders) >= STATE_FOLDERS
                rows = self._read(TABLES[name], "batches", fresh, SEQ)
                found = self.state(state) if whole else spec.minima(latest_per_key(rows, TABLES[name].keys, ["_seq"]))
                folder = f"_state/{state}/_v={version.number + 1}"
                found.write.mode("overwrite").parquet(self._path(name, folder))
                out[state] = [folder] if whole else [*folders, folder]
        return out

    def compact(self, name: str) -> int:
        """Fold the written batches into the merged part; returns the number of days rewritten.

        If the job dies, the table is as it was before or as it is after; the next call goes on from there.
        """
        version = self.prepare_merge(name)
        if version is None:
            return 0
        before = self.version(name)
        self.publish(name, version)
        self.vacuum(name)
        return len(_days(set(version.folded) - set(before.folded)))

    def vacuum(self, name: str) -> None:
        """Delete what neither the published version nor the one before reads. One merge of a table runs at a time."""
        now = self.version(name)
        before = self.version(name, now.number - 1)
        named = {p for v in (now, before) for paths in [*v.days.values(), *v.states.values()] for p in paths}
        known = self._found(name, "merged/_v=*/date=*") + self._found(name, "_state/*/_v=*")
        gone = [p for p in known if p not in named]
        gone += [*before.folded, f"merged/_v={now.number + 1}"]  # the last: what a lost merge has left
        gone += [p for p in self._found(name, "_versions/*.json") if int(p[len("_versions/"):-len(".json")]) < now.number - 1]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda p: self._delete(self._path(name, p)), gone))


def _days(files) -> list[str]:
    """Names of the day partitions that hold the files."""
    return sorted({path.split("/date=")[1].split("/")[0] for path in files})


class _Tables(Mapping):
    def __init__(self, lake: Warehouse):
        self._lake, self._found = lake, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._found:
            self._found[name] = self._lake.state(name) if name in STATES else self._lake.scan(name)
        return self._found[name]

    def __iter__(self):
        return iter((*TABLES, *STATES))

    def __len__(self) -> int:
        return len(TABLES) + len(STATES)

    def __contains__(self, name) -> bool:
        return name in TABLES or name in STATES
