"""Windows, sequences, patterns, enrichment and assembly on streams."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.times import parse_duration
from ..operators.enrich import enrich
from ..operators.sequences import epochs, goes_on
from ..operators.windows import EXACT, finish, moments
from ..plans.spec import Stage
from . import chains

# Fixed value: how late a record may be.
LATE = "1 second"


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def _columns(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def stream_windows(df: DataFrame, ops: dict[str, str], keys: list[str], size: str, slide: str, late: str = LATE) -> DataFrame:
    """keys, win_start, win_end (ms) and a column per operator, when the watermark passes a window; later records go.

    ``df`` has ts (timestamp), seq and value. Equal sizes and slides share one aggregation. MEDIAN and SLOPE keep a
    window's values in its state, all others a few sums.
    """
    v = F.col("value")
    more = []
    if "MEDIAN" in ops.values():
        more.append(F.median(v.cast("double")).alias("mid"))
    if "SLOPE" in ops.values():
        more.append(F.collect_list(F.struct("ms", "seq", v.cast(EXACT).alias("d"))).alias("every"))
    win = F.window("ts", size, slide)
    agg = df.withColumn("ms", _ms(F.col("ts"))).withWatermark("ts", late).groupBy(*keys, win.alias("w")).agg(*moments(v, [o for o in ops.values() if o != "MEDIAN"], []), *more)
    if "SLOPE" in ops.values():
        ranked = F.transform(F.sort_array("every"), lambda x, i: ((i + 1) * x["d"]).cast(EXACT))
        agg = agg.withColumn("xy", F.aggregate(ranked, F.lit(0).cast(EXACT), lambda a, x: (a + x).cast(EXACT)))
    return agg.select(*keys, _ms(F.col("w.start")).alias("win_start"), _ms(F.col("w.end")).alias("win_end"), *(finish(o).alias(k) for k, o in ops.items()))


def stream_each_window(df: DataFrame, op: str, keys: list[str], size: Column, slide: Column, default=("5s", "5s"), late: str = LATE) -> DataFrame:
    """keys, win_start, win_end, value, where each record of a stream brings its own window size and slide.

    The state is the panes of open windows (chains.WindowStep): a few sums each, and its values for MEDIAN and SLOPE. A
    record is late, and goes, when the watermark has passed its pane. Null or 0 sizes and slides mean the default.
    """
    own = lambda x, d: F.when(F.coalesce(x, F.lit(0)) > 0, x).otherwise(F.lit(parse_duration(d))).cast("long")
    timed = df.withWatermark("ts", late).withColumn("ms", _ms(F.col("ts"))).withColumn("_size", own(size, default[0])).withColumn("_slide", own(slide, default[1]))
    named = [*keys, "_size", "_slide"]
    pane = F.when(F.col("_size") % F.col("_slide") == 0, F.col("_slide")).otherwise(F.lit(1)).cast("long")
    rows = chains.singles(timed, named, pane)
    out = chains.run_chains(rows, named, lambda key: (Stage(op, (int(key[-2]), int(key[-1]))),))
    return out.select(*keys, F.col("seq").alias("win_start"), F.col("ms").alias("win_end"), "value")


class _Arrivals(StatefulProcessor):
    """Windows over the time at which records come."""

    def __init__(self, op: str, keys: list[str], size: int, slide: int):
        self.step, self.keys = chains.WindowStep(op, size, slide), keys

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "state binary")

    def _run(self, key, rows: chains.Rows, now: int):
        state, timer = pickle.loads(self.held.get()[0]) if self.held.exists() else (None, None)
        out, state = self.step.run(state, rows, now)
        end = self.step.next(state, now)
        if end is not None and (timer is None or end < timer or timer <= now):
            self.handle.registerTimer(end)
            timer = end
        if end is None:
            self.held.clear()
        else:
            self.held.update((pickle.dumps((state, timer)),))
        if len(out[0]):
            value = pd.Series(out[2]).astype(object).where(~np.isnan(out[2]), None)
            yield pd.DataFrame({**{n: [v] * len(out[0]) for n, v in zip(self.keys, key)}, "win_start": out[1], "win_end": out[0], "value": value})

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        parts = [(np.full(len(pdf), now), pdf["seq"].to_numpy(np.int64), pd.to_numeric(pdf["value"]).to_numpy(float)) for pdf in rows]
        yield from self._run(key, tuple(np.concatenate(c) for c in zip(*parts)) if parts else chains.NONE, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._run(key, chains.NONE, timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def stream_arrival_windows(df: DataFrame, op: str, keys: list[str], size: str, slide: str) -> DataFrame:
    """keys, win_start, win_end, value of windows by the clock: a record counts when it comes, whatever its own time is.

    ``df`` has seq and value. A record's time is that of its micro-batch; a window is told once the clock has passed its
    end, with the next micro-batch or, without new records, by its timer at the query's trigger.
    """
    chains.with_state_store(df.sparkSession)
    schema = f"{_columns(df, keys)}, win_start long, win_end long, value double"
    plain = df.select(*keys, "seq", F.col("value").cast("double").alias("value"))
    return plain.groupBy(*keys).transformWithStateInPandas(_Arrivals(op, keys, parse_duration(size), parse_duration(slide)), schema, "append", "ProcessingTime")


class Sequence:
    """A sequence operator on a stream: each micro-batch is a batch job that goes on from the states of the one before.

    Spark sorts a micro-batch and deals long series in chunks to many tasks, which read them in Arrow batches; so neither
    a long series nor a large micro-batch needs more memory than a small one. The states stand in a table per micro-batch
    in the query's folder. One that is repeated after a failure begins with the same states, and writes the same again.
    """

    def __init__(self, df: DataFrame, op: str, args: tuple, keys: list[str], changing: Column | None, chunk):
        own = [F.lit(float(a)) for a in args]
        numbers = F.array(*(own if changing is None else [changing.cast("double"), *own[1:]]))
        self.df = df.select(*keys, "ms", "seq", F.col("value").cast("double").alias("value"), F.lit(op).alias("_op"), numbers.alias("_args"))
        self.keys, self.varies, self.chunk = keys, changing is not None, chunk
        self.schema = self.df.drop("_op", "_args").schema

    def start(self, path: str):
        """Run over all there is now: results go to ``path``/out, one folder per micro-batch, states to ``path``/state."""
        spark = self.df.sparkSession

        def batch(rows: DataFrame, number: int) -> None:
            held = spark.read.parquet(f"{path}/state/{number - 1}") if number else None

            def save(df: DataFrame, name: str) -> DataFrame:
                df.write.mode("overwrite").parquet(f"{path}/{name}/{number}")
                return spark.read.schema(df.schema).parquet(f"{path}/{name}/{number}")

            rows = epochs(rows, self.keys, F.col("_args")[0], self.chunk) if self.varies else rows.withColumn("_epoch", F.lit(0).cast("long"))
            out, states = goes_on(rows, held, self.keys, self.chunk, save)
            out.select(*self.schema.names).write.mode("overwrite").parquet(f"{path}/out/batch={number}")
            states.write.mode("overwrite").parquet(f"{path}/state/{number}")
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            store = where.getFileSystem(spark._jsc.hadoopConfiguration())
            for old in (f"starts/{number}", f"state/{number - 2}"):  # no micro-batch begins with them any more
                store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}"), True)

        return self.df.writeStream.foreachBatch(batch).option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()


def stream_sequence(df: DataFrame, op: str, args: tuple, keys: list[str] | str, changing: Column | None = None, chunk="1d") -> Sequence:
    """keys, ms, seq, value of LAST, VAR, TREND, RSI or a recursive filter over each key's records in arrival order.

    Of one micro-batch a key's records are taken by (ms, seq). The state is a few numbers per key. ``changing`` is the n
    of a lag operator as each record brings it; a lag operator whose n differs from the one before starts anew. A null
    value gives null and leaves the state as it is. Run it with ``replay``. ``chunk``: see sequences.filtered.
    """
    return Sequence(df, op, args, [keys] if isinstance(keys, str) else list(keys), changing, chunk)


def stream_match(df: DataFrame, steps: list[Column], keys: list[str], within: int | None = None, after: list[Column] | None = None, switch: Column | None = None) -> DataFrame:
    """Contiguous matches in a stream, as pattern.match_next gives them: keys, first_seq, last_seq, first_ms, last_ms.

    From behind the first record that ``switch`` marks the pattern ``after`` holds instead (pattern.match_switching).
    The state of a key is its last records, one fewer than the longest pattern has steps.
    """
    flags = lambda xs: sum((F.when(F.coalesce(x, F.lit(False)), 1 << i).otherwise(0) for i, x in enumerate(xs)), F.lit(0))
    sizes = len(steps), len(after or steps)
    d = df.select(*keys, "ms", "seq", flags(steps).alias("_a"), flags(after or steps).alias("_b"), F.coalesce(switch if switch is not None else F.lit(False), F.lit(False)).alias("_s"))

    def work(k, pdfs, state):
        turned, past = json.loads(state.get[0]) if state.exists else (0, [])
        pdf = pd.concat(list(pdfs)).sort_values(["ms", "seq"])
        rows = pdf[["ms", "seq", "_a", "_b"]].to_numpy(np.int64)
        marks = np.flatnonzero(pdf["_s"].to_numpy(bool))
        out = []
        for begin, end in zip(np.r_[-1, marks] + 1, np.r_[marks, len(rows)]):  # between the marks
            if begin:
                turned, past = 1, []
            stretch = np.concatenate([np.array(past, np.int64).reshape(-1, 4), rows[begin:end]])
            n, flags = sizes[turned], stretch[:, 2 + turned]
            starts = np.arange(max(len(past) - n + 1, 0), max(len(stretch) - n + 1, 0))  # those that end in new records
            for i in range(n):
                starts = starts[flags[starts + i] >> i & 1 == 1]
            if within is not None:
                starts = starts[stretch[starts + n - 1, 0] - stretch[starts, 0] < within]
            out += [(*k, stretch[i, 1], stretch[i + n - 1, 1], stretch[i, 0], stretch[i + n - 1, 0]) for i in starts]
            past = stretch[max(len(stretch) - max(sizes) + 1, 0) :].tolist()
        state.update((json.dumps((turned, past)),))
        yield pd.DataFrame(out, columns=[*keys, "first_seq", "last_seq", "first_ms", "last_ms"])

    schema = f"{_columns(df, keys)}, first_seq long, last_seq long, first_ms long, last_ms long"
    return d.groupBy(*keys).applyInPandasWithState(work, schema, "held string", "append", GroupStateTimeout.NoTimeout)


def stream_enrich(raw: DataFrame, rules: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Start a query that joins each micro-batch with the rules as they are when it comes, and hands it to ``write``.

    ``rules`` is called once a micro-batch, so a changed rule counts from the next one on; a batch that is repeated after
    a failure has its own number again, by which ``write`` replaces what it wrote. ``every`` is a processing-time
    interval; without it the query ends when it has read all there is.
    """
    def batch(df: DataFrame, number: int) -> None:
        write(enrich(df, rules()), number)

    w = raw.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


class _Assembly(StatefulProcessor):
    """The values of one post and time, until they are all there or the watermark has passed their time by too much."""

    def __init__(self, need: dict[str, int], wait_ms: int, urls: dict[str, str]):
        self.need, self.wait_ms, self.urls = need, wait_ms, urls

    def init(self, handle) -> None:
        self.handle = handle
        self.values = handle.getMapState("values", "out_name string", "value double")
        self.told = handle.getValueState("told", "at long")

    def _row(self, key, complete: bool) -> pd.DataFrame:
        post, ms = key
        held = {k[0]: v[0] for k, v in self.values.iterator()}
        return pd.DataFrame({"post_name": [post], "url": [self.urls.get(post)], "ms": [ms], "body": [json.dumps(held, sort_keys=True)], "complete": [complete], "missing": [max(self.need.get(post, 0) - len(held), 0)]})

    def handleInputRows(self, key, rows, timerValues):
        if self.told.exists():  # what comes again for a row that has been told
            return
        new = not self.values.exists()
        for pdf in rows:
            for name, v in zip(pdf["out_name"], pdf["value"]):
                self.values.updateValue((name,), (None if pd.isna(v) else float(v),))
        if new:
            self.handle.registerTimer(max(int(key[1]) + self.wait_ms, timerValues.getCurrentWatermarkInMs() + 1))
        if len(list(self.values.keys())) >= self.need.get(key[0], 1 << 30):
            out = self._row(key, True)
            self.told.update((int(key[1]),))
            self.values.clear()
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.told.exists() and self.values.exists():
            yield self._row(key, False)
        self.values.clear()
        self.told.clear()

    def close(self) -> None:
        pass


def stream_assemble(df: DataFrame, need: dict[str, int], wait_ms: int = 3000, late: str = LATE, urls: dict[str, str] | None = None, incomplete: bool = False) -> DataFrame:
    """(post_name, ts, out_name, value) -> post_name, url, ms, body (JSON) once all keys of a post are there.

    A null value counts as there; what comes again after that is passed over. Rows that are not complete when the
    watermark is ``wait_ms`` past their time leave the state; with ``incomplete`` they are told too, with the columns
    complete (false) and missing (how many values never came), so that what is lost can be counted. ``urls`` says where
    each post goes.
    """
    chains.with_state_store(df.sparkSession)
    rows = df.withWatermark("ts", late).withColumn("ms", _ms(F.col("ts")))
    schema = "post_name string, url string, ms long, body string, complete boolean, missing int"
    out = rows.groupBy("post_name", "ms").transformWithStateInPandas(_Assembly(need, wait_ms, urls or {}), schema, "append", "EventTime")
    return out if incomplete else out.where("complete").drop("complete", "missing")


def replay(df: DataFrame | Sequence, path: str, mode: str = "append"):
    """Run a stream over all there is now into Parquet under ``path`` and read it back."""
    if isinstance(df, Sequence):
        df.start(path).awaitTermination()
        return df.df.sparkSession.read.schema(df.schema).parquet(f"{path}/out/batch=*")
    q = df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out")
