"""Read files and alignments as streams: running barcode counts and pair matching with state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions import names


def barcode_counts(records: DataFrame) -> DataFrame:
    """Running reads per barcode of a stream of records (header, ...)."""
    return records.groupBy(names.barcode(F.col("header")).alias("barcode")).agg(F.count("*").alias("reads"))


def windowed_counts(records: DataFrame, time: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Reads per barcode and event-time window; windows close once the watermark has passed them."""
    return records.withWatermark(time, late).groupBy(F.window(time, window), names.barcode(F.col("header")).alias("barcode")).agg(F.count("*").alias("reads"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIELDS = "qname string, rec_no long, time long, flag int, ref_id int, start_pos long, end_pos long"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
PAIR = "qname string, rec1 long, rec2 long, " + ", ".join(f"{f}{k} {kind}" for k in (1, 2) for f, kind in (("flag", "int"), ("ref_id", "int"), ("start_pos", "long"), ("end_pos", "long")))
BUCKETS = 512  # keys of the state: the reads of some names together, since each key costs calls of its own


class PairProcessor(StatefulProcessor):
    """The reads of a bucket of names wait in a list until the watermark has passed them; then those of each name are paired
    in the order of rec_no, whatever order they came in, a bucket at a time by array arithmetic. One whose mate is more
    than `wait` later, or does not come, is forgotten."""

    def __init__(self, wait_ms: int):
        self.wait = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reads = handle.getListState("reads", FIELDS)

    def _wake(self, at: int) -> None:
        """The bucket's one timer: at the earliest of what is asked for."""
        known = list(self.handle.listTimers())
        for t in known:
            if t > at:
                self.handle.deleteTimer(t)
        if not any(t <= at for t in known):
            self.handle.registerTimer(at)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        times = (new["time"].astype("int64") // (1 if new["time"].dtype.kind == "i" else 10 ** {"s": 0, "ms": 3, "us": 6, "ns": 9}[np.datetime_data(new["time"].dt.tz_localize(None).dtype)[0]])) * 1000
        self.reads.appendList(_tuples(new.assign(time=times)))
        self._wake(int(times.min()))
        return iter([])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = pd.DataFrame([tuple(r) for r in self.reads.get()], columns=NAMES)
        done, kept, wake = paired(held, now, self.wait)
        if len(kept):
            self.reads.put(_tuples(kept))
            self._wake(wake)
        else:
            self.reads.clear()
        if len(done):
            yield done

    def close(self) -> None:
        pass


def _tuples(reads: pd.DataFrame) -> list[tuple]:
    return list(zip(*(reads[c].tolist() for c in NAMES)))


def paired(held: pd.DataFrame, now: int, wait: int) -> tuple[pd.DataFrame, pd.DataFrame, int]:
    """Of the reads held (NAMES): the pairs (PAIR) of those up to `now`, the reads that wait on, and the time of the first of
    these that has something to wait for.

    A read that follows another of its name within `wait` goes on with its run; in a run the second read closes a pair with
    the first, the fourth with the third. A name's last read without a mate waits on.
    """
    later = held[held["time"] > now]
    ready = held[held["time"] <= now].sort_values(["qname", "rec_no", "time"], kind="stable", ignore_index=True)
    at, name, n = ready["time"].to_numpy(np.int64), ready["qname"].to_numpy(object), np.arange(len(ready))
    same = np.zeros(len(ready), bool)
    same[1:] = name[1:] == name[:-1]
    goes_on = same.copy()
    goes_on[1:] &= at[1:] - at[:-1] <= wait
    second = (n - np.maximum.accumulate(np.where(goes_on, 0, n))) % 2 == 1 if len(n) else same
    b = np.flatnonzero(second)
    one, two = ready.iloc[b - 1].reset_index(drop=True), ready.iloc[b].reset_index(drop=True)
    columns = {"qname": one["qname"], "rec1": one["rec_no"], "rec2": two["rec_no"]}
    for k, side in ((1, one), (2, two)):
        columns |= {f"{c}{k}": side[c] for c in ("flag", "ref_id", "start_pos", "end_pos")}
    last = np.ones(len(ready), bool)
    last[:-1] = ~same[1:]
    waiting = ready[last & ~second & (at + wait > now)]
    ends = [int(x) for x in (later["time"].min(), waiting["time"].min() + wait) if x == x]
    return pd.DataFrame(columns), pd.concat([later, waiting]), min(ends, default=0)


def match_pairs(reads: DataFrame, late: str = "1 hour", wait: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Pairs (see PAIR) of a stream of reads (qname, rec_no, time, flag, ref_id, start_pos, end_pos), by event time.

    Rows may come in any order, up to `late` after later ones; those that come later still are dropped. The first read of
    a name, by rec_no, waits, the second closes the pair, the third waits anew; who has no mate after `wait` is forgotten.
    A pair is given once the watermark has passed its reads, so the state holds what arrives within `late` and `wait`. The
    session needs the RocksDB state store. Names go to `buckets` keys by a hash; a task holds one bucket's reads at a time, so
    their number is to grow with what `late` and `wait` hold (some 100,000 reads each are well), and stays the same over a
    checkpoint's life.
    """
    processor = PairProcessor(int(pd.Timedelta(wait).total_seconds() * 1000))
    return reads.withWatermark("time", late).withColumn("bucket", F.pmod(F.xxhash64("qname"), F.lit(buckets))).groupBy("bucket").transformWithStateInPandas(processor, PAIR, "append", "EventTime")
