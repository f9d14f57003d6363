"""Running feeds as streams (X1-X4): source -> records -> raw and clean tables, per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.documents import parse_tolerant_json
from tidemart.operators.project import stamp
from tidemart.operators.quality import check_schema, enforce_schema
from tidemart.plans.ingest import FEEDS, Feed
from tidemart.schemas import TABLES
from tidemart.sources.readers import read_source, resolve_options
from tidemart.sources.tables import Warehouse

#: Default time between two batches.
PROCESSING_TIME = "10 seconds"


def write_batch(warehouse: Warehouse, feed: Feed, messages: DataFrame, batch_id: int, run_date=None,
                audit: bool | str = True) -> None:
    """One micro-batch. ``messages`` has ``value`` and ``run_ts``, the batch's own time.

    The documents and the records are computed once and feed both tables. The batch time comes
    from the query's log, so a replayed batch carries the same day and the same write order.
    """
    batch = f"{feed.name}-{batch_id}"
    held = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        parsed = parse_tolerant_json(messages, paths=feed.paths)
        parsed = hold(parsed.withColumn("value", F.when(F.col("doc").isNull(), F.col("value"))))  # else as good as ``doc``
        bad = parsed.where(F.col("doc").isNull() & (F.trim("value") != "")).select("value")
        day = F.to_date("run_ts") if run_date is None else F.lit(run_date).cast("date")
        docs = parsed.where("doc is not null").withColumns(
            {"run_date": day, "run_ts": F.col("run_ts").cast("timestamp_ntz")}).drop("value")
        stamp_row = messages.select(F.unix_micros("run_ts")).first()  # one time for the whole batch; nothing is parsed for it
        if stamp_row is None:
            return
        newest = stamp_row[0]
        records = hold(feed.extract(docs))
        raw = check_schema(feed.to_raw(records), TABLES[feed.raw_table])  # reading it again costs less than keeping it
        clean = hold(check_schema(feed.to_clean(records), TABLES[feed.clean_table]))
        _write(warehouse, feed, raw, clean, bad, batch, newest, audit)
    finally:
        for df in reversed(held):
            df.unpersist()


def _write(warehouse, feed, raw, clean, bad, batch, seq, audit):
    good_raw = raw.where(F.size("reasons") == 0).drop("reasons", "_row")
    good_clean = clean.where(F.size("reasons") == 0).drop("reasons", "_row")
    warehouse.append_raw(good_raw, feed.raw_table, batch)
    arrival = F.monotonically_increasing_id()
    warehouse.upsert_latest(good_clean.withColumn("_arrival", arrival), feed.clean_table, batch, seq, ["_arrival"])
    counts = []
    for layer, table, checked in (("raw", feed.raw_table, raw), ("clean", feed.clean_table, clean)):
        # Counted while the rejects are written: no further job, no shuffle.
        seen, wrong = Observation(), F.size("reasons") > 0
        checked = checked.observe(seen, F.count_if(~wrong).alias("rows"), F.count_if(wrong).alias("rejected"))
        rejects = checked.where(wrong).select("reasons", F.to_json("_row").alias("row"))
        warehouse.keep_rejects(rejects, table, batch)
        counts.append((layer, table, seen.get["rows"], seen.get["rejected"]))
    warehouse.keep_rejects(bad, f"unreadable-{feed.topic}", batch)
    if audit == "counts":
        warehouse.audit_counts(counts, batch, seq)
    elif audit:
        warehouse.audit(good_raw, "raw", feed.raw_table, batch)
        warehouse.audit(good_clean, "clean", feed.clean_table, batch)


def run_feed(messages: DataFrame, feed: str | Feed, warehouse: Warehouse, checkpoint: str,
             bounded: bool = False, run_date=None, audit: bool | str = True,
             interval: str = PROCESSING_TIME) -> StreamingQuery:
    """Start one feed; ``bounded`` reads what is there, commits it and ends.

    ``audit`` keeps rows per key and batch, or with ``"counts"`` only how many rows were loaded and rejected, which is free.
    A batch begins every ``interval``, or when the one before has ended; each is a checkpoint.
    """
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    stamped = messages.withColumn("run_ts", F.current_timestamp())
    trigger = {"availableNow": True} if bounded else {"processingTime": interval}
    return (
        stamped.writeStream.queryName(spec.name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch_id: write_batch(warehouse, spec, df, batch_id, run_date, audit))
        .trigger(**trigger).start()
    )


def launch_feed(spark: SparkSession, feed: str, args: Sequence[str], warehouse: Warehouse, checkpoint: str,
                broker: str | None = None, sample: str | None = None, **settings) -> StreamingQuery:
    """Start a feed from a job's arguments.

    With ``--local`` the documents of ``--file`` (a file or a folder, by default ``sample``) are read whole, and the feed ends
    with them; else the feed's topic is read from ``broker``. ``settings`` go to :func:`run_feed`.
    """
    options, spec = resolve_options(args, sample), FEEDS[feed]
    if options.kind == "file":
        if options.path is None:
            raise ValueError("--local needs --file")
        return run_feed(read_source(spark, "file", options.path), spec, warehouse, checkpoint, **{"bounded": True, **settings})
    if broker is None:
        raise ValueError("no broker to read the topic from")
    messages = read_source(spark, "kafka", broker, topic=spec.topic, group=spec.group)
    return run_feed(messages, spec, warehouse, checkpoint, **settings)


def run_once(messages: DataFrame, feed: str, run_date, run_ts) -> dict[str, DataFrame]:
    """The rows one batch of messages yields, without writing: raw, clean and rejected ones."""
    spec = FEEDS[feed]
    docs = stamp(parse_tolerant_json(messages, paths=spec.paths), run_date, run_ts).where("doc is not null")
    records = spec.extract(docs)
    raw, raw_rejects = enforce_schema(spec.to_raw(records), TABLES[spec.raw_table])
    clean, clean_rejects = enforce_schema(spec.to_clean(records), TABLES[spec.clean_table])
    return {"raw": raw, "clean": clean, "rejects": raw_rejects.union(clean_rejects)}
