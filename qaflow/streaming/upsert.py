"""Keyed upserts ahead of the index refresh (E12 / W1): one state value a document.

Deliveries of a document may arrive more than once, late and out of order.  ``transformWithState`` keeps the
time and the digest of the latest accepted delivery of every document in the state store, which the
streaming checkpoint versions with the source offsets.  Documents are dealt by hash to ``BUCKETS`` groups, whose
values are one state value: the state is asked once a bucket and batch instead of several times a document.
(A checkpoint of a stream that kept one state value a document cannot be gone on with.)  A micro-batch emits a
document's latest row if it is newer than the state (equal times: the greater digest), so

* what is emitted over all batches, reduced to the latest row a document, equals the batch result whatever
  the order and the cut into batches;
* a replayed micro-batch starts from the state before it and emits the same rows again.

The rows of a bucket are read in slices and reduced as they come: a document that holds a third of a batch
needs no more memory than any other.  A row without ``doc_id`` is dropped, a row without a time is older than
any with one.  A null text is a deletion like any other update.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


BUCKETS = 4096
MOST_HELD = 4096  # rows that a bucket holds before it drops those that others have replaced


def _digest(text) -> str:
    return "" if text is None or text is pd.NA or text != text else hashlib.md5(str(text).encode()).hexdigest()


def _micros(at: pd.Series) -> list[int]:
    """The times in microseconds, -1 for none."""
    if not np.issubdtype(at.dtype, np.datetime64):
        return [-1 if pd.isna(x) else pd.Timestamp(x).value // 1000 for x in at]
    return np.where(at.isna(), -1, at.to_numpy("datetime64[us]").astype(np.int64)).tolist()


class LatestUpdate(StatefulProcessor):
    """Emits the latest row of the batch of each document of a bucket, if it is newer than what the state holds."""

    def __init__(self, key: str, event_time: str, text: str, columns: list[str], ttl_ms: int | None = None):
        self.key, self.event_time, self.text, self.columns, self.ttl_ms = key, event_time, text, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "known binary", self.ttl_ms)

    def _known(self, now: int) -> dict:
        """``document: (time, digest, when it was accepted)`` of those that are not forgotten."""
        if not self.latest.exists():
            return {}
        with pa.ipc.open_stream(self.latest.get()[0]) as held:
            cols = [c.to_pylist() for c in held.read_all().columns]
        return {doc: (at, digest, seen) for doc, at, digest, seen in zip(*cols) if not self.ttl_ms or seen + self.ttl_ms > now}

    def _keep(self, known: dict) -> None:
        cols = [pa.array(list(known)), *(pa.array([x[k] for x in known.values()], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64())))]
        batch, sink = pa.RecordBatch.from_arrays(cols, names=["doc", "at", "digest", "seen"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        self.latest.update((sink.getvalue().to_pybytes(),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0
        known, held, n = self._known(now), [], 0
        for pdf in rows:
            newer = {}
            for i, (doc, at, text) in enumerate(zip(pdf[self.key].tolist(), _micros(pdf[self.event_time]), pdf[self.text])):
                best = known.get(doc)
                if best is not None and at < best[0]:
                    continue
                digest = _digest(text)
                if best is None or (at, digest) > best[:2]:
                    known[doc], newer[doc] = (at, digest, now), i
            if newer:
                held.append(pdf.iloc[sorted(newer.values())][self.columns])
                n += len(newer)
            if n > MOST_HELD and len(held) > 1:
                held = [pd.concat(held).drop_duplicates(self.key, keep="last")]
                n = 0
        if held:
            self._keep(known)
            yield pd.concat(held).drop_duplicates(self.key, keep="last") if len(held) > 1 else held[0]

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession):
    """Streams started inside keep their state in the provider that ``transformWithState`` needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)


def latest_updates(stream: DataFrame, event_time: str, *, key: str = "doc_id", text: str = "text", ttl_ms: int | None = None) -> DataFrame:
    """The rows of ``stream`` that are newer than every earlier one of their document, one a document and batch.

    With ``ttl_ms`` a document's state is forgotten that long after its last accepted update; an older delivery
    that arrives even later is then accepted again.
    """
    bucket = "bucket"
    while bucket in {c.lower() for c in stream.columns}:
        bucket += "_"
    dealt = stream.where(F.col(key).isNotNull()).withColumn(bucket, F.pmod(F.xxhash64(key), F.lit(BUCKETS)))
    return dealt.groupBy(bucket).transformWithStateInPandas(
        statefulProcessor=LatestUpdate(key, event_time, text, stream.columns, ttl_ms), outputStructType=StructType(list(stream.schema.fields)),
        outputMode="Update", timeMode="ProcessingTime" if ttl_ms else "None")


def upsert_stream(spark: SparkSession, inbox: str, out: str, checkpoint: str, schema, event_time: str, *,
                  max_files_per_trigger: int | None = None, ttl_ms: int | None = None) -> None:
    """Drains ``inbox`` and writes the accepted updates of every micro-batch as ``out/epoch=N`` (replaced on replay)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    with state_store(spark):
        q = (latest_updates(reader.parquet(inbox), event_time, ttl_ms=ttl_ms).writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()


def current_documents(updates: DataFrame, event_time: str) -> DataFrame:
    """The latest row a document of accepted updates, as the batch result has it; deletions leave no row."""
    cols = [c for c in updates.columns if c not in ("doc_id", "epoch")]
    order = F.struct(F.coalesce(F.unix_micros(event_time), F.lit(-1)).alias("at"), F.coalesce(F.md5("text"), F.lit("")).alias("digest"))
    last = updates.groupBy("doc_id").agg(F.max_by(F.struct(*cols), order).alias("r"))
    return last.select("doc_id", *[F.col(f"r.{c}").alias(c) for c in cols]).where(F.col("text").isNotNull())
