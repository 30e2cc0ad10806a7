"""Streams of payload files and object events."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from framecat.functions import keys
from framecat.operators import sinks

# What runs inside tasks travels with them, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A flush takes up to so many files, or happens after so long.
FILES_PER_FLUSH = 50
FLUSH_INTERVAL = "5 seconds"


def payload_stream(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    files_per_flush: int | None = None,
) -> DataFrame:
    """Stream of payload lines as files arrive; a micro-batch takes all of them, or so many files at most."""
    reader = spark.readStream.schema("value string").option("pathGlobFilter", glob)
    if files_per_flush:
        reader = reader.option("maxFilesPerTrigger", files_per_flush)
    return reader.text(path)


def only_supported(events: DataFrame, key: str = "s3_key") -> DataFrame:
    """Events of media files only."""
    return events.filter(keys.has_suffix(F.col(key)))


def deduplicated(events: DataFrame, key: str = "event_id", at: str = "ts", bound: str = "1 hour") -> DataFrame:
    """Each delivery once, if its copies come within ``bound`` of each other.

    State is kept per key for the bound only. A true re-inspection has another
    event id and passes.
    """
    return events.withWatermark(at, bound).dropDuplicatesWithinWatermark([key])


def running_audit(events: DataFrame, key: str = "file_id", at: str = "ts", idle: str = "1 hour") -> DataFrame:
    """Running audit rows of a stream, for update mode: file_id, segment, first_seen, last_inspected, inspection_count, closed.

    State is kept per file while events come, and dropped once none came for ``idle``. What
    comes later, however late by its own time, opens the file's next segment, so nothing is lost:
    ``audit_of`` adds segments up, in whatever order rows arrive.
    """
    bound = _milliseconds(idle)
    kind = events.schema[key].dataType.simpleString()

    def step(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            segment, first, last, count = state.get
            state.remove()
            yield _audit_row(name[0], segment, first, last, count, True)
            return
        segment, first, last, count = state.get if state.exists else (state.getCurrentProcessingTimeMs(), None, None, 0)
        for frame in frames:
            low, high = frame["at"].min().value // 1000, frame["at"].max().value // 1000
            first = low if first is None else min(first, low)
            last = high if last is None else max(last, high)
            count += len(frame)
        state.update((segment, first, last, count))
        state.setTimeoutDuration(bound)
        yield _audit_row(name[0], segment, first, last, count, False)

    out = f"file_id {kind}, segment long, first_seen timestamp, last_inspected timestamp, inspection_count long, closed boolean"
    named = events.select(F.col(key).alias("file_id"), F.col(at).cast("timestamp").alias("at"))
    return named.groupBy("file_id").applyInPandasWithState(
        step, out, "segment long, first long, last long, count long", "update", GroupStateTimeout.ProcessingTimeTimeout
    )


def _audit_row(name, segment: int, first: int, last: int, count: int, closed: bool) -> pd.DataFrame:
    stamps = [pd.Timestamp(x, unit="us", tz="UTC") for x in (first, last)]
    return pd.DataFrame([(name, segment, *stamps, count, closed)], columns=["file_id", "segment", "first_seen", "last_inspected", "inspection_count", "closed"])


def audit_of(rows: DataFrame) -> DataFrame:
    """First seen, last inspected and count per file from the rows of ``running_audit``, which may repeat."""
    last = rows.groupBy("file_id", "segment").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_inspected").alias("last_inspected"), F.max("inspection_count").alias("n")
    )
    return last.groupBy("file_id").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_inspected").alias("last_inspected"), F.sum("n").alias("inspection_count")
    )


def _milliseconds(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1000)


def flushed(lines: DataFrame, files: int = FILES_PER_FLUSH, wait: str = FLUSH_INTERVAL, lanes: int = 1) -> DataFrame:
    """Lines of arriving files (value, name) in flushes: lane, flush, cause, name, value; for append mode.

    A flush of a lane happens when so many files wait, or so long after the first of them came,
    whichever is first; ``cause`` tells which (``size`` or ``time``). Lines of a file come in one
    micro-batch and stay in one flush. State holds what waits: fewer than ``files`` files a lane,
    with their lines. Without a column ``value`` only names are told and held, once a file however
    many lines it has: lane, flush, cause, name. That is the form for files of many lines.
    """
    bound = _milliseconds(wait)
    if "value" not in lines.columns:
        return _flushed_names(lines, files, bound, lanes)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flush, opened, names, values = state.get if state.exists else (0, 0, [], [])
        names, values, now = list(names), list(values), state.getCurrentProcessingTimeMs()
        waiting = dict.fromkeys(names)

        def out(cause: str) -> pd.DataFrame:
            told = {"lane": key[0], "flush": flush, "cause": cause, "name": names, "value": values}
            return pd.DataFrame(told)

        if not state.hasTimedOut:
            arrived = pd.concat(list(frames)).sort_values("name", kind="stable")
            for name, own in arrived.groupby("name", sort=True)["value"]:
                opened = opened if waiting else now
                waiting[name] = None
                names += [name] * len(own)
                values += own.tolist()
                if len(waiting) == files:
                    yield out("size")
                    flush, names, values, waiting = flush + 1, [], [], {}
        if waiting and now - opened >= bound:
            yield out("time")
            flush, names, values, waiting = flush + 1, [], [], {}
        state.update((flush, opened, names, values))
        if waiting:
            state.setTimeoutDuration(max(1, opened + bound - now))

    named = lines.select(F.pmod(F.xxhash64("name"), F.lit(lanes)).alias("lane"), "name", "value")
    return named.groupBy("lane").applyInPandasWithState(
        step,
        "lane long, flush long, cause string, name string, value string",
        "flush long, opened long, names array<string>, lines array<string>",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


def _flushed_names(lines: DataFrame, files: int, bound: int, lanes: int) -> DataFrame:
    def once(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop_duplicates()

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flush, opened, names = state.get if state.exists else (0, 0, [])
        waiting, now = list(names), state.getCurrentProcessingTimeMs()

        def out(cause: str, taken: list[str]) -> pd.DataFrame:
            return pd.DataFrame({"lane": key[0], "flush": flush, "cause": cause, "name": taken})

        if not state.hasTimedOut:
            arrived = sorted({name for frame in frames for name in frame["name"]} - set(waiting))
            opened = opened if waiting else now
            waiting += arrived
            while len(waiting) >= files:
                yield out("size", waiting[:files])
                flush, opened, waiting = flush + 1, now, waiting[files:]
        if waiting and now - opened >= bound:
            yield out("time", waiting)
            flush, waiting = flush + 1, []
        state.update((flush, opened, waiting))
        if waiting:
            state.setTimeoutDuration(max(1, opened + bound - now))

    named = lines.select(F.pmod(F.xxhash64("name"), F.lit(lanes)).alias("lane"), "name")
    return named.mapInPandas(once, "lane long, name string").groupBy("lane").applyInPandasWithState(
        step,
        "lane long, flush long, cause string, name string",
        "flush long, opened long, names array<string>",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


def stop_when_out(query: StreamingQuery, out: Callable[[], bool], quiet: float = 120) -> None:
    """Stops a query once ``out`` tells that all has left it, however long its micro-batches take.

    A query that has had no input for so many seconds and still holds something back is an error.
    """
    heard = time.monotonic()
    try:
        while not out():
            if query.exception():
                raise query.exception()
            last = query.lastProgress
            if last is None or last["numInputRows"] or query.status["isTriggerActive"]:
                heard = time.monotonic()
            if time.monotonic() - heard > quiet:
                raise TimeoutError(f"the stream was quiet for {quiet} seconds and not all had left it")
            time.sleep(0.5)
    finally:
        query.stop()


def stop_when_quiet(query: StreamingQuery, seconds: float = 600) -> None:
    """Stops a query once a micro-batch found nothing new.

    Queries with timeouts run micro-batches for ever, also to take what is there and end.
    """
    until = time.monotonic() + seconds
    try:
        while time.monotonic() < until and query.isActive:
            last = query.lastProgress
            if last and last["numInputRows"] == 0:
                return
            time.sleep(0.1)
        if query.exception():
            raise query.exception()
        raise TimeoutError(f"the stream still had input after {seconds} seconds")
    finally:
        query.stop()


def arrivals_per_minute(events: DataFrame, at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Files per minute of event time; events later than the bound are left out of a stream."""
    marked = events.withWatermark(at, late) if events.isStreaming else events
    return (
        marked.groupBy(F.window(at, "1 minute"))
        .agg(F.count("*").alias("files"))
        .select(F.col("window.start").alias("minute"), "files")
    )


def start_ingest(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    stream: str = "arrivals",
    interval: str | None = FLUSH_INTERVAL,
    located: bool = True,
) -> StreamingQuery:
    """Log every micro-batch of payload lines; ``merge_log`` folds them in when wanted.

    A micro-batch appends under its own batch number and reads nothing that grows
    with the catalogue. A replayed one replaces itself. The stream's name in the log
    ends with the id that its checkpoint holds, so a restart with a new checkpoint,
    which counts from zero again, is another stream. Without an interval the query
    takes what is there and ends.
    """

    def flush(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        sinks.append_batch(batch, root, number, f"{stream}-{run}", located=located)

    writer = lines.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
