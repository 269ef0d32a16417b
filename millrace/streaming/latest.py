"""The latest copy of each order from a stream of copies, emitted once.

A copy can be followed by a later one, so an order waits until the watermark has passed its last copy by a
given time. Ids are dealt over a fixed number of buckets by a digest. The state of a bucket is the latest copy
so far of each of its ids that still wait; a timer ends the wait of the first that is due. No table is read:
a micro-batch touches the buckets of the ids it has and those where an id's time has come.

A bucket's state is compressed, as it passes to Python and back as a whole. Spark gathers as many states to a message
as rows, and a Python worker sends its states on only with rows, so it is given rows that say nothing. A stream in which
many ids wait at a time needs more buckets, short messages and a store that keeps states on disk: :func:`room_for`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

ORDER, EVENT = "bronze_row_id", "event_time"
#: Groups that ids are dealt over. A call into Python costs about the same for one id as for hundreds.
BUCKETS = 1024
#: Copies to a bucket and to a partition where a stream waits for so many that the usual numbers would not do. Each
#: partition has a store of its own, which takes some memory of its executor for as long as the stream runs.
COPIES_A_BUCKET, COPIES_A_PARTITION = 4_000, 1_000_000
PARTITIONS = 32
#: Rows, or states of buckets whose time has come, to a message between Spark and Python.
MESSAGE_ROWS = 2_000
#: Bytes of states that a Python worker gathers before it sends them on.
MESSAGE_BYTES = 8 << 20
#: What all states on disk that an executor has open may take of its memory.
STORE_MB = 200
CODEC = "zstd"
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STORE_MB),
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(MESSAGE_ROWS),
}


def buckets_for(copies: int) -> int:
    """Buckets for a stream that waits for the ids of so many copies at a time."""
    return max(BUCKETS, copies // COPIES_A_BUCKET)


@contextmanager
def room_for(spark: SparkSession, copies: int) -> Iterator[None]:
    """A stream that starts inside keeps its states on disk, in as many partitions as so many copies at a time need.

    A stream takes its settings when it starts, and the session has its own again after. A checkpoint keeps the kind of
    store and the partitions, but not the lengths of messages and the store's memory: restart inside, too.
    """
    partitions = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTITIONS), copies // COPIES_A_PARTITION)
    settings = ON_DISK | {"spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def latest_copies(copies: DataFrame, key: str, wait: str, patience_ms: int, event_time: str = EVENT, buckets: int = BUCKETS) -> DataFrame:
    """The copy with the highest ``bronze_row_id`` of each id, once no further one is waited for.

    ``wait`` is how late a copy may arrive behind the newest one of the stream, ``patience_ms`` how long
    after an order's own last copy the watermark must be before it is emitted. The result doesn't depend on
    the order in which copies arrive within that time. A copy that comes later than that is dropped, as
    the watermark says; if its id was emitted before it isn't emitted again. Rows without a ``bronze_row_id``
    count as the lowest; rows without an id are one order, as in a batch. Rows without an event time are
    emitted with the others of their id, or if there are none at the first watermark. ``buckets`` stays as
    it is for as long as a checkpoint lives; a batch rewrites the state of the buckets it touches.
    """
    columns = [f.name for f in copies.schema.fields if f.name != event_time]
    says_nothing = [(None,) * (len(columns) + 1)] * (MESSAGE_ROWS + 1)
    gathered = 0
    at = columns.index(ORDER)
    whole = [i for i, c in enumerate(columns) if isinstance(copies.schema[c].dataType, (IntegerType, LongType))]

    def rank(row: tuple) -> tuple:
        """Equal row ids are ordered by all values, so that any order of arrival gives the same copy."""
        return (row[at] is not None, row[at] or 0, tuple((v is not None, str(v)) for v in row))

    def packed(waiting: dict) -> tuple[bytes, int]:
        plain = pickle.dumps(waiting, pickle.HIGHEST_PROTOCOL)
        return pa.compress(plain, CODEC, asbytes=True), len(plain)

    def unpacked(state: bytes, size: int) -> dict:
        return pickle.loads(pa.decompress(state, size, CODEC, asbytes=True))

    def keep(_: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        nonlocal gathered
        # an id's best copy, the time of its last one, and when it is due
        waiting: dict[str, tuple[tuple, int, int]] = unpacked(*state.get) if state.exists else {}
        now = state.getCurrentWatermarkMs()
        touched = set()
        for batch in [] if state.hasTimedOut else batches:
            # what isn't equal to itself is how pandas tells null
            values = ([None if v != v else v for v in batch[c]] for c in ("_id", "_ms", *columns))
            for name, ms, *row in zip(*values, strict=True):
                for i in whole:
                    row[i] = None if row[i] is None else int(row[i])
                best, until, _due = waiting.get(name, (None, 0, 0))
                copy = tuple(row)
                if best is None or (copy[at] is not None, copy[at] or 0) >= (best[at] is not None, best[at] or 0):
                    best = copy if best is None else max(best, copy, key=rank)
                # an id that has a copy in this batch waits for the next watermark at least
                until = max(until, int(ms or 0))
                waiting[name] = (best, until, max(until + patience_ms, now + 1))
                touched.add(name)
        ended = [name for name, (*_rest, due) in waiting.items() if due < now and name not in touched]
        emitted = [waiting.pop(name)[0] for name in ended]
        if waiting:
            state.update(held := packed(waiting))
            gathered += len(held[0])
            state.setTimeoutTimestamp(max(now, min(due for *_rest, due in waiting.values())))
        elif state.exists:
            state.remove()
        if emitted:
            yield pd.DataFrame([(*copy, True) for copy in emitted], columns=[*columns, "_copy"], dtype=object)
        if gathered > MESSAGE_BYTES:
            gathered = 0
            yield pd.DataFrame(says_nothing, columns=[*columns, "_copy"], dtype=object)

    watched = copies.withWatermark(event_time, wait).withColumn("_ms", F.unix_millis(event_time))
    # pandas would make floats of whole numbers among nulls
    watched = watched.withColumns({columns[i]: F.col(columns[i]).cast("string") for i in whole})
    keyed = watched.withColumn("_id", F.coalesce(F.concat(F.lit("="), F.col(key)), F.lit("")))
    dealt = keyed.withColumn("_bucket", F.pmod(F.xxhash64("_id"), F.lit(buckets))).groupBy("_bucket")
    sent = StructType([*(StructField(c, copies.schema[c].dataType) for c in columns), StructField("_copy", BooleanType())])
    found = dealt.applyInPandasWithState(keep, sent, "held binary, size long", "append", GroupStateTimeout.EventTimeTimeout)
    return found.where("_copy").drop("_copy")
