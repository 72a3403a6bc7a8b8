"""Starting streams, writing alerts exactly once, and reading state back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waycast import schemas as S
from waycast.functions import codec, times
from waycast.operators import streams
from waycast.session import staged, work_dir
from waycast.sources import logs
from waycast.sources.tables import project_events, read_table
from waycast.streaming.matcher import COPIES, HELD_SCHEMA, ROUTE_SCHEMA, match_stream, one_row_each, page_rows

STATE_SETTINGS = {
    # map state needs the RocksDB provider; changelogs keep its checkpoints small
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """The settings a stateful query reads when it starts; the session's own come back.

    ``partitions`` is the number of state partitions.  It is fixed by the first
    start of a checkpoint; the number of cores is a good choice.
    """
    wanted = dict(STATE_SETTINGS)
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start_files(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rows to parquet files; file sink and checkpoint make it exactly once."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def start_alert_files(alerts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      partitions: int | None = None) -> StreamingQuery:
    """Alerts to parquet files, with the state settings that the operators need."""
    with state_settings(alerts.sparkSession, partitions):
        return start_files(alerts, path, checkpoint, trigger)


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """(batch, folder): the manifest of an alert log."""
    return spark.read.schema("batch long, folder string").parquet(f"{path}/batches")


def _commit(spark: SparkSession, path: str, batch_id: int, folder: str) -> None:
    """One file with one row, so the batch is in the manifest or not."""
    spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(folder).alias("folder")).coalesce(1).write.mode("append").parquet(f"{path}/batches")


def start_alert_log(alerts: DataFrame, path: str, checkpoint: str, key_by: str = "request",
                    trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Alerts as JSON log records, every alert once for readers that obey the manifest (:func:`read_alert_log`).

    Each attempt at a batch writes a folder of its own and only then enters it in the
    manifest.  An attempt that fails before is never read; a batch that is run again
    although it is in the manifest only brings the state up to date.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            if not _committed(spark, path).filter(F.col("batch") == batch_id).isEmpty():
                batch.write.format("noop").mode("overwrite").save()  # the state moves on
                return
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        folder = f"data/batch-{batch_id}-{uuid.uuid4().hex}"
        codec.encode_alerts(batch, key_by).write.parquet(f"{path}/{folder}")
        _commit(spark, path, batch_id, folder)

    with state_settings(alerts.sparkSession, partitions):
        return (
            alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )


def read_alert_log(spark: SparkSession, path: str, after_batch: int = -1) -> DataFrame:
    """The records of all batches in the manifest, or of those behind ``after_batch``."""
    folders = [r.folder for r in _committed(spark, path).filter(F.col("batch") > after_batch).collect()]
    log = spark.read.schema(S.LOG_SCHEMA)
    return log.parquet(*(f"{path}/{f}" for f in folders)) if folders else spark.createDataFrame([], S.LOG_SCHEMA)


def start_job(log: DataFrame, alerts_path: str, rejects_path: str, checkpoint: str, shards: int,
              min_lead: int | None = S.MIN_LEAD_MINUTES, as_of: Column | None = None, live: bool = True,
              trigger: dict | None = None, partitions: int | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """The whole job on a log of JSON records, from files or a broker: alerts to a log, rejects to files.

    The lead time is measured from now, or from the event's own time if ``live`` is
    false, which makes replays repeatable.  Returns both running queries.
    """
    decoded = codec.decode_events(log)
    now = streams.utc_now() if as_of is None and live else as_of
    alerts = match_stream(codec.accepted(decoded), min_lead, now, shards=shards)
    rejects = start_files(codec.rejected(decoded), rejects_path, f"{checkpoint}/rejects", trigger)
    return start_alert_log(alerts, alerts_path, f"{checkpoint}/alerts", trigger=trigger, partitions=partitions), rejects


def start_broker_alerts(alerts: DataFrame, servers: str, checkpoint: str, key_by: str = "request",
                        trigger: dict | None = None, partitions: int | None = None, **options: str) -> StreamingQuery:
    """Alerts to the broker's topic, with the state settings that the operator needs."""
    with state_settings(alerts.sparkSession, partitions):
        writer = logs.write_broker(codec.encode_alerts(alerts, key_by), servers, checkpoint, **options)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def in_parts(rows: DataFrame, order: str, parts: int = 4) -> list[DataFrame]:
    """The rows cut into ``parts`` of about equal size by ``order``."""
    borders = sorted(set(rows.approxQuantile(order, [i / parts for i in range(1, parts)], 0.01)))
    ends = [None, *borders, None]
    column = F.col(order)
    return [
        rows.filter((F.lit(True) if a is None else column > a) & (F.lit(True) if b is None else column <= b))
        for a, b in zip(ends, ends[1:], strict=False)
    ]


def run_to_end(spark: SparkSession, events: DataFrame, min_lead: int | None = S.MIN_LEAD_MINUTES,
               shards: int | None = None) -> tuple[DataFrame, str]:
    """Process everything there is; returns the alerts and the checkpoint folder."""
    out, checkpoint = work_dir(spark, "alerts"), work_dir(spark, "state")
    _run(spark, events, out, checkpoint, min_lead, shards)
    return spark.read.schema(S.ALERT_SCHEMA).parquet(out), checkpoint


def _run(spark: SparkSession, events: DataFrame, out: str, checkpoint: str, min_lead: int | None = S.MIN_LEAD_MINUTES,
         shards: int | None = None, **options) -> None:
    cores = spark.sparkContext.defaultParallelism
    alerts = match_stream(events, min_lead, shards=shards or cores, **options)
    start_alert_files(alerts, out, checkpoint, partitions=cores).awaitTermination()


def replay_table(spark: SparkSession, sf_dir: str, routes: str = "shared", repeat_ids: bool = False,
                 parts: int = 4, **options) -> tuple[DataFrame, str]:
    """The event table as a stream that arrives in ``parts``: one restarted run and micro-batch after the other.

    Returns the alerts of all runs and their common checkpoint.
    """
    source, out, checkpoint = (work_dir(spark, n) for n in ("events", "alerts", "state"))
    raw = read_table(spark, sf_dir, "events")
    for part in in_parts(raw, "event_id", parts):
        # the table may be one file, and a file one task
        part.repartition(spark.sparkContext.defaultParallelism).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(raw.schema).parquet(source)
        _run(spark, project_events(arriving, routes, repeat_ids), out, checkpoint, **options)
    return spark.read.schema(S.ALERT_SCHEMA).parquet(out), checkpoint


def clock(spark: SparkSession, time: str) -> DataFrame:
    """An event record that only tells the time."""
    return spark.range(1).select(*[
        (F.lit(time if f.name == "ts" else None)).cast(f.dataType).alias(f.name) for f in S.EVENT_SCHEMA.fields
    ])


def replay_on_a_clock(spark: SparkSession, sf_dir: str, late_hours: int = 0, parts: int = 3, expiring: bool = False, **options) -> tuple[DataFrame, str]:
    """The event table by event time, in ``parts`` whose records come up to ``late_hours`` too late, and without order.

    A restarted run per part, and a last one with a record that tells a time after all
    events.  Returns the alerts of all runs and their common checkpoint.
    """
    source, out, checkpoint = (work_dir(spark, n) for n in ("events", "alerts", "state"))
    micros = 3_600_000_000 * late_hours
    events = project_events(read_table(spark, sf_dir, "events"))
    delay = F.pmod(F.xxhash64("seq"), F.lit(micros)) if micros else F.lit(0)
    events = events.withColumn("_arrives", (times.epoch_seconds(F.col("ts")) * 1000000).cast("bigint") + delay)
    rest = [p.drop("_arrives").orderBy(F.xxhash64("seq", F.lit(1))) for p in in_parts(events, "_arrives", parts)]
    for part in [*rest, clock(spark, "9999-01-01 00:00:00")]:
        part.write.mode("append").parquet(source)
        arriving = spark.readStream.schema(S.EVENT_SCHEMA).parquet(source)
        _run(spark, arriving, out, checkpoint, disorder=f"{late_hours} hours", expiring=expiring, **options)
    return spark.read.schema(S.ALERT_SCHEMA).parquet(out), checkpoint


def replay_rescaled(spark: SparkSession, sf_dir: str, shards: tuple[int, int] = (2, 5)) -> DataFrame:
    """The event table in two halves, the second under a new checkpoint that starts from the state of the first, with other shards."""
    raw = read_table(spark, sf_dir, "events")
    alerts, state = [], None
    for part, number in zip(in_parts(raw, "event_id", 2), shards, strict=False):
        source, out, checkpoint = (work_dir(spark, n) for n in ("events", "alerts", "state"))
        part.write.parquet(source)
        arriving = project_events(spark.readStream.schema(raw.schema).parquet(source))
        _run(spark, arriving, out, checkpoint, shards=number, state=state)
        state = saved_state(spark, checkpoint)
        alerts.append(spark.read.schema(S.ALERT_SCHEMA).parquet(out))
    return reduce(DataFrame.unionByName, alerts)


def _operators(spark: SparkSession, checkpoint: str) -> list:
    """(operatorId, operatorName, operatorProperties) of the stateful operators."""
    known = spark.read.format("state-metadata").load(checkpoint)
    return sorted(known.select("operatorId", "operatorName", "operatorProperties").distinct().collect())


def _reader(spark: SparkSession, checkpoint: str, operator: int):
    return spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)


def _state_readers(spark: SparkSession, checkpoint: str, name: str) -> list:
    """A reader per operator that keeps the state variable ``name``."""
    numbers = [r[0] for r in _operators(spark, checkpoint) if f'"stateName":"{name}"' in (r[2] or "").replace(" ", "")]
    return [_reader(spark, checkpoint, n).option("stateVarName", name) for n in numbers]


def _read_held(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Held events as ``list_element``, one row each; an aggregation keeps them as keys."""
    numbers = [r[0] for r in _operators(spark, checkpoint) if r[1] == "stateStoreSave"]
    frames = [_reader(spark, checkpoint, n).load().select("key.*", F.col("value.count").alias(COPIES)) for n in numbers]
    return one_row_each(reduce(DataFrame.unionByName, frames)).select(F.struct("*").alias("list_element"))


def read_state(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """One state variable of a stopped query as a table: ``held``, ``timetable``, ``active``, ``early`` or ``route``.

    Records are held back by two operators, one for requests and one for the rest.
    """
    if name == "held":
        return _read_held(spark, checkpoint)
    return reduce(DataFrame.unionByName, [r.load() for r in _state_readers(spark, checkpoint, name)])


def read_changes(spark: SparkSession, checkpoint: str, name: str, first_batch: int = 0, last_batch: int | None = None) -> DataFrame:
    """Puts (``update``) and ``delete``s of a state variable by batch, as far back as the checkpoint keeps its changelogs.

    All of the timetable's if the stream ran with ``every_write``; else what each batch leaves.
    """
    readers = [r.option("readChangeFeed", "true").option("changeStartBatchId", first_batch) for r in _state_readers(spark, checkpoint, name)]
    if last_batch is not None:
        readers = [r.option("changeEndBatchId", last_batch) for r in readers]
    return reduce(DataFrame.unionByName, [r.load() for r in readers])


def _read_pages(spark: SparkSession, checkpoint: str, what: str) -> DataFrame | None:
    """From a stream with ``pages``, else nothing."""
    readers = _state_readers(spark, checkpoint, "page")
    return page_rows(readers[0].load().select("value.routes"), what) if readers else None


def read_timetable(spark: SparkSession, checkpoint: str) -> DataFrame:
    paged = _read_pages(spark, checkpoint, "timetable")
    if paged is not None:
        return paged
    return read_state(spark, checkpoint, "timetable").select(
        *[F.col(f"key.{c}").alias(c) for c in S.ROUTE], "user_map_value.*"
    )


def read_active(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Active requests with the travel all of their route have."""
    paged = _read_pages(spark, checkpoint, "active")
    if paged is not None:
        return paged
    requests = read_state(spark, checkpoint, "active").select(
        "key.*", F.col("user_map_key.key").alias("id"), F.col("user_map_value.n").alias("seen")
    )
    routes = read_state(spark, checkpoint, "route").select("key.*", "value.*")
    return requests.join(routes, [*S.ROUTE, "shard"]).select(
        "id", *S.ROUTE, *S.ENTRY_SCHEMA.fieldNames(),
        F.when(F.col("seen") < F.col("updates"), F.col("moved_from")).alias("last_travel_id"),
    )


def read_early(spark: SparkSession, checkpoint: str) -> DataFrame:
    paged = _read_pages(spark, checkpoint, "early")
    if paged is not None:
        return paged
    return read_state(spark, checkpoint, "early").select(
        F.col("user_map_key.key").alias("id"), *[F.col(f"key.{c}").alias(c) for c in S.ROUTE],
        F.col("user_map_value.n").alias("seq"),
    )


def saved_state(spark: SparkSession, checkpoint: str, disorder: bool = False) -> dict[str, DataFrame]:
    """All state of a stopped query, for ``match_stream(state=...)`` under a new checkpoint and any number of shards.

    Written to the shared folder, since a state reader's batch is that of the moment.  A
    route's common state is the same in all of its shards.
    """
    route = [F.col(f"key.{c}").alias(c) for c in S.ROUTE]
    common = [f.name for f in ROUTE_SCHEMA.fields]
    kept = [
        read_state(spark, checkpoint, name).select(
            *route, F.col("user_map_key.key").alias("id"), F.col("user_map_value.n").alias("n"), F.lit(name == "active").alias("is_active"))
        for name in ("active", "early")
    ]
    routes = read_state(spark, checkpoint, "route").select(*route, "value").groupBy(*S.ROUTE).agg(F.max_by("value", "value.updates").alias("v"))
    requests = kept[0].unionByName(kept[1]).unionByName(routes.select(*S.ROUTE, *[F.col(f"v.{c}").alias(c) for c in common]), allowMissingColumns=True)
    state = {"timetable": staged(read_timetable(spark, checkpoint), "saved-timetable"), "requests": staged(requests, "saved-requests")}
    if disorder:  # a stream: an aggregation takes no state from outside
        held = work_dir(spark, "saved-events")
        read_state(spark, checkpoint, "held").select("list_element.*").write.parquet(held)
        state["held"] = spark.readStream.schema(HELD_SCHEMA).parquet(held)
    return state
