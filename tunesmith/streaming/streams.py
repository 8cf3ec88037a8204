"""Structured Streaming forms.

Each builder returns a streaming DataFrame; ``run_to_table`` drives it with an
``availableNow`` trigger into a parquet sink whose checkpoint lives in the
shared checkpoint folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tunesmith.operators.stats import quantile_sketch, sketch_quantile
from tunesmith.session import shared_scratch

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
TURNS_SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def run_to_table(stream: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Drive a stream over everything available now into parquet; return the sink as a table."""
    spark = stream.sparkSession
    out = shared_scratch(spark, f"{name}-sink")
    q = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", out + "-checkpoint")
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out)


def in_time_order(events: DataFrame, n: int, ts_col: str = "ts") -> list[DataFrame]:
    """``events`` cut into n parts by time, as they would arrive; rows without a time come first."""
    seconds = F.col(ts_col).cast("timestamp").cast("double")
    edges = events.select(seconds.alias("_s")).approxQuantile("_s", [i / n for i in range(1, n)], 0.01) if n > 1 else []
    bounds = [None, *sorted(edges), None]
    parts = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        within = F.lit(True)
        if low is not None:
            within = within & (seconds >= low)
        if high is not None:
            within = within & (seconds < high)
        parts.append(events.filter(F.coalesce(within, F.lit(False)) | (seconds.isNull() if low is None else F.lit(False))))
    return parts


def closing_row(events: DataFrame, ts_col: str, after: str) -> DataFrame:
    """One row of nulls, so far after the last event that the watermark passes every window of the events."""
    last = events.agg((F.max(ts_col) + F.expr(f"interval {after}")).alias("_last"))
    return last.select(*[F.col("_last").cast(t).alias(c) if c == ts_col else F.lit(None).cast(t).alias(c) for c, t in events.dtypes])


def run_deliveries(parts: list[DataFrame], build, name: str, progress: list | None = None) -> DataFrame:
    """Deliver ``parts`` one after the other as files of a folder, each followed by a run of the stream
    ``build`` makes of that folder (a restart that resumes from its checkpoint); the sink as a table.
    ``progress`` gets the progress reports of all runs."""
    spark = parts[0].sparkSession
    src, out = shared_scratch(spark, f"{name}-in"), shared_scratch(spark, f"{name}-sink")
    with rocksdb_state(spark):
        for part in parts:
            part.write.mode("append").parquet(src)
            stream = build(spark.readStream.schema(part.schema).parquet(src))
            q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint").outputMode("append").trigger(availableNow=True).start()
            q.awaitTermination()
            if progress is not None:
                progress += q.recentProgress
    return spark.read.parquet(out)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, which operators with state variables and timers
    need: a batch writes what it changed, and large state stays off the heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stream_table(spark: SparkSession, sf_dir: str, table: str, schema: T.StructType) -> DataFrame:
    """A driver parquet table read as a file stream (one table per glob)."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def stream_jsonl(spark: SparkSession, src_dir: str, schema: T.StructType) -> DataFrame:
    """JSON lines arriving in a folder, parsed strictly (a bad line fails the query)."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").json(src_dir)


def with_event_time(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    return events.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def stream_dedupe_windows(events: DataFrame, keys, window: str = "1 hour", delay: str = "1 hour", ts_col: str = "ts") -> DataFrame:
    """C6 by fixed windows: one row per key and event-time window, with ``window_start`` in place of the time.

    Which rows are duplicates depends on keys and times alone, so the result is the same however rows are cut
    into batches (rows later than ``delay`` are dropped as in any stream with a watermark); the
    state of a window goes once the watermark has passed its end."""
    e = with_event_time(events, ts_col).withWatermark(ts_col, delay)
    # The window takes the place of the time: a stream may have one event-time column.
    e = e.select(*[c for c in e.columns if c != ts_col], F.window(ts_col, window).alias("_window"))
    kept = e.dropDuplicates([*keys, "_window"])
    return kept.withColumn("window_start", F.col("_window.start")).drop("_window")


NEVER = -(1 << 62)


class FirstOfKey(StatefulProcessor):
    """Rows (key, us, row) of a group of keys, those of each key in the order of their time: a row is kept unless one of its key was
    kept less than ``hold_us`` before it. Rows wait until the watermark passes them, as an earlier one may still come.

    ``waiting`` holds what came at a time as one entry (JSON: key -> [[us, row], ...]), written once and removed when all of it has been
    judged. ``mark`` holds (JSON) [entry, earliest waiting time, time up to which it has been judged] of each entry, and the times up to which
    kept rows cover their keys. The group's one timer stands at the earliest waiting time, or without waiting rows at the last of the latter."""

    def __init__(self, hold_us: int):
        self.hold_us = hold_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "entry long", "rows string")
        self.mark = handle.getValueState("mark", "entries string, covered string")

    def _marks(self) -> tuple[list, dict]:
        held = self.mark.get() if self.mark.exists() else None
        return (json.loads(held[0]), json.loads(held[1])) if held else ([], {})

    @staticmethod
    def _timer(entries: list, covered: dict) -> int | None:
        us = min((first for _, first, _ in entries), default=None) if entries else max(covered.values(), default=None)
        return None if us is None else -(-us // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        entries, covered = self._marks()
        before, n = self._timer(entries, covered), len(entries)
        for pdf in rows:
            untimed = pdf["us"].isna()
            if untimed.any():
                yield pdf.loc[untimed, ["us", "row"]]
            new: dict[str, list] = {}
            times = pdf.loc[~untimed, "us"].astype("int64").tolist()
            for k, us, row in zip(pdf.loc[~untimed, "key"].tolist(), times, pdf.loc[~untimed, "row"].tolist(), strict=True):
                new.setdefault(k, []).append((us, row))
            if new:
                entry = entries[-1][0] + 1 if entries else 0
                self.waiting.updateValue((entry,), (json.dumps(new, ensure_ascii=False),))
                entries.append((entry, min(times), NEVER))
        if len(entries) == n:
            return
        self.mark.update((json.dumps(entries), json.dumps(covered, ensure_ascii=False)))
        after = self._timer(entries, covered)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        entries, covered = self._marks()
        left, due, kept = [], {}, []
        for entry, first, judged in entries:
            if first > passed:
                left.append((entry, first, judged))
                continue
            later = []
            for k, each in json.loads(self.waiting.getValue((entry,))[0]).items():
                due.setdefault(k, []).extend((us, row) for us, row in each if judged < us <= passed)
                later += [us for us, _ in each if us > passed]
            if later:
                left.append((entry, min(later), passed))
            else:
                self.waiting.removeKey((entry,))
        for k, each in due.items():
            until = covered.get(k, NEVER)
            for us, row in sorted(each):
                if us >= until:
                    kept.append((us, row))
                    until = us + self.hold_us
            covered[k] = until
        covered = {k: until for k, until in covered.items() if until > passed}
        timer = self._timer(left, covered)
        if timer is None:
            self.mark.clear()
        else:
            self.mark.update((json.dumps(left), json.dumps(covered, ensure_ascii=False)))
            self.handle.registerTimer(timer)
        if kept:
            yield pd.DataFrame(kept, columns=["us", "row"])


def _key_text(events: DataFrame, keys) -> Column:
    """One text for the keys of a row, the same for exactly those rows that ``groupBy`` would put together."""
    kinds = dict(events.dtypes)
    cols = [F.when(F.col(k) == 0, F.lit(0).cast(kinds[k])).otherwise(F.col(k)) if kinds[k] in ("float", "double") else F.col(k) for k in keys]  # -0.0
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*[c.alias(f"key_{i}") for i, c in enumerate(cols)]), exact)


def stream_dedupe(events: DataFrame, keys, hold_seconds: int = 3600, delay: str = "1 hour", ts_col: str = "ts", groups: int = 1 << 12) -> DataFrame:
    """The first row of a key, and no other until ``hold_seconds`` after it; the next row starts anew.

    Rows are judged in the order of their event time once the watermark (``delay`` behind the latest time) has passed
    them, so the result is the same however rows are cut into batches, and a repeat just after a full hour goes as well. Of
    rows of a key and time the first by the JSON text of its other columns stays. The state of a key is what waits and a time; it goes by a
    timer. Rows without a time are kept as they are, rows later than ``delay`` are dropped, and a stream that ends needs a
    ``closing_row`` for its last rows (which itself is never passed).

    Keys share their state and timer in ``groups`` groups by a hash, so a batch costs some calls to the state store for each group it touches, not for
    each key. What a group has waiting must fit a Python worker: take more groups for more keys (fixed for a checkpoint)."""
    e = with_event_time(events, ts_col).withWatermark(ts_col, delay)
    row = F.struct(*[c for c in e.columns if c != ts_col])
    schema = e.select(row.alias("r")).schema["r"].dataType
    packed = e.select(_key_text(e, keys).alias("key"), F.col(ts_col).alias("seen"), F.unix_micros(ts_col).alias("us"), F.to_json(row).alias("row"))  # names without a leading underscore, which pandas would not get
    packed = packed.select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group"), "key", "seen", "us", "row")
    kept = packed.groupBy("group").transformWithStateInPandas(FirstOfKey(hold_seconds * 1_000_000), "us long, row string", "Append", "EventTime")
    kept = kept.withColumn("_r", F.from_json("row", schema))
    return kept.select(*[F.col("_r").getField(c).alias(c) if c != ts_col else F.timestamp_micros("us").alias(c) for c in e.columns])


def stream_serving_metrics(events: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """L1 on a stream; a window is emitted once the watermark passes its end, and rows
    later than the watermark are dropped (append mode). A stream that ends needs a ``closing_row``
    for its last windows.

    ``latency_p99`` comes from a KLL sketch (``stats.quantile_sketch``): an observed latency whose rank is within
    ``stats.SKETCH_ERROR`` of 0.99 with 99 % confidence, and exact for few requests. The sketch is the window's whole state for it, some
    60 KB at any number of requests, and sketches of map tasks and batches merge."""
    e = with_event_time(events).withWatermark("ts", delay)
    e = e.select(
        "ts",
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("latency"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens"),
    )
    sums = e.groupBy(F.window("ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if(~F.col("ok")).alias("n_errors"),
        F.sum("tokens").alias("tokens"),
        F.sum("latency").alias("latency_sum"),
        F.max("latency").alias("latency_max"),
        quantile_sketch("latency").alias("sketch"),
    )
    return sums.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_requests", "n_errors", "tokens", "latency_sum", "latency_max",
        sketch_quantile("sketch", 0.99).alias("latency_p99"), (F.col("tokens") / F.greatest("latency_sum", F.lit(1e-6))).alias("tokens_per_sec"),
    )


HISTORY_OUT = "conv_id long, n_messages long, last_turn long, last_role string, roles string, closed boolean"


class ChatHistory(StatefulProcessor):
    """The messages of a conversation, each appended to a list state once; a timer of the event time closes it."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.messages = handle.getListState("messages", "turn long, role string, text string")
        self.summary = handle.getValueState("summary", "n long, last_turn long, last_role string, last_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = [m for pdf in rows for m in zip(pdf["seen_ms"].tolist(), pdf["turn"].tolist(), pdf["role"].tolist(), pdf["text"].tolist(), strict=True)]
        if pd.isna(key[0]):  # messages of no conversation, as a closing row
            return
        n, last, role, last_ms = self.summary.get() if self.summary.exists() else (0, None, None, None)
        timer, waiting = last_ms, []
        for ms, turn, speaker, text in sorted(new, key=lambda m: (m[0], m[1])):
            if last_ms is not None and ms >= last_ms + self.idle_ms:  # the watermark is still behind, but the pause has been too long
                self._append(waiting)
                yield self._row(key, n, last, role, self._roles())
                self.messages.clear()
                n, last, last_ms, waiting = 0, None, None, []
            waiting.append((turn, speaker, text))
            n, last_ms = n + 1, ms if last_ms is None else max(ms, last_ms)
            if last is None or turn >= last:
                last, role = turn, speaker
        self._append(waiting)
        self.summary.update((n, last, role, last_ms))
        if timer != last_ms:
            if timer is not None:
                self.handle.deleteTimer(timer + self.idle_ms)
            self.handle.registerTimer(last_ms + self.idle_ms)
        yield self._row(key, n, last, role, None)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, last, role, _ = self.summary.get()
        yield self._row(key, n, last, role, self._roles())
        self.messages.clear()
        self.summary.clear()

    def _append(self, new: list[tuple]) -> None:
        if new:
            self.messages.appendList(new)

    def _roles(self) -> str:
        return ",".join(r or "" for _, r in sorted(((t, r) for t, r, _ in self.messages.get()), key=lambda m: m[0]))

    @staticmethod
    def _row(key, n: int, last: int, role: str | None, roles: str | None) -> pd.DataFrame:
        return pd.DataFrame({"conv_id": [key[0]], "n_messages": [n], "last_turn": [last], "last_role": [role], "roles": [roles], "closed": [roles is not None]})


def stream_chat_history(turns: DataFrame, idle_timeout_ms: int = 30 * 60 * 1000, delay: str = "10 minutes", ts_col: str = "ts") -> DataFrame:
    """The history of each conversation of ``turns`` (conv_id, turn, role, text, time) as they arrive.

    Emits the size after every batch with new turns (closed false), and once more, with the roles in
    the order of the turns, when ``idle_timeout_ms`` of event time have gone by without one (closed true), by a timer or because
    the next turn comes later than that; the state of the conversation then goes, and a later turn begins a new history. A message is written to the state once, so a batch writes as much as its new turns
    hold, however long the history is. The timer runs on event time (the watermark, ``delay`` behind the latest time), so a
    run that drains its input ends, and a re-run gives the same rows. Turns of no conversation are ignored; a null turn
    number counts as -1."""
    e = with_event_time(turns, ts_col).withWatermark(ts_col, delay)
    e = e.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), "role", "text", ts_col, F.coalesce(F.unix_millis(ts_col), F.lit(0)).alias("seen_ms"))
    return e.groupBy("conv_id").transformWithStateInPandas(ChatHistory(idle_timeout_ms), HISTORY_OUT, "Append", "EventTime")
