"""Index refresh as versioned batch jobs and as a stream.

Layout under ``base``::

    base/version=N/postings/cell=C/part-*.parquet   cells rewritten by version N
    base/version=N/manifest/part-*.parquet           (cell, version): where each live cell is
    base/version=N/centroids/part-*.parquet
    base/_current/part-*.parquet                     a row per version: encoder, n_docs, stream, epoch

A refresh never writes into a published version.  It finds the cells the
change touches (cells of the changed documents' old passages and of their
new ones; at most nlist ids), rewrites only those cells into version N+1,
writes a manifest that keeps every untouched cell pointing at the version
that holds it, and only then moves the pointer.  A small delta therefore
writes a few cells, not the whole index; ``compact=True`` rewrites every
cell into the new version.  A reader that resolved version N keeps a
consistent snapshot; a job lost mid-write leaves the pointer untouched, so
the rerun writes N+1 again (``overwrite`` of a version never published).
"""

from __future__ import annotations

from contextlib import nullcontext
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaflow.operators import models, retrieve, vectors
from qaflow.sources import writers
from qaflow.streaming import upsert

POSTING_COLS = ["passage_id", "doc_id", "idx", "title", "text", "embedding"]  # + updated_at, cell
POSTINGS_SCHEMA = ("passage_id long, doc_id long, idx int, title string, text string, "
                   "embedding array<double>, updated_at timestamp, cell int")


def read_live(spark: SparkSession, base: str) -> tuple[int | None, DataFrame | None, DataFrame | None]:
    """Resolve the pointer: (version, postings, centroids) or Nones before the first build.

    The postings are one partition-pruned read per version named in the
    manifest (``cell IN (...)`` on each), unioned; the manifest has at most
    nlist rows.
    """
    v = writers.current_version(spark, base)
    if v is None:
        return None, None, None
    root = f"{base}/version={v}"
    return v, _live_postings(spark, base, v), spark.read.parquet(f"{root}/centroids")


def _written_cells(spark: SparkSession, path: str) -> list[int]:
    """Cells present in a ``partitionBy(cell)`` output, from the directory listing
    (with the schema given, an output without files reads as no cell)."""
    df = spark.read.schema(POSTINGS_SCHEMA).parquet(path)
    return sorted(int(r[0]) for r in df.select("cell").distinct().collect())


def _manifest(spark: SparkSession, base: str, v: int):
    return spark.read.parquet(f"{base}/version={v}/manifest").toPandas()  # <= nlist rows


def _live_postings(spark: SparkSession, base: str, v: int) -> DataFrame:
    man = _manifest(spark, base, v)
    parts = []
    for ver, grp in man.groupby("version"):
        cells = sorted(int(c) for c in grp["cell"])
        parts.append(spark.read.parquet(f"{base}/version={int(ver)}/postings")
                     .where(F.col("cell").isin(cells)))
    if not parts:  # every passage was deleted
        return spark.createDataFrame([], POSTINGS_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def encode_documents(docs: DataFrame, encoder=None, n: int = 100) -> DataFrame:
    """C1 + E1: documents -> passages with vectors (title := source)."""
    enc = encoder or models.hash_encoder()
    return retrieve.corpus_passages(docs, n).withColumn("embedding", enc(F.col("text")))


def latest_per_doc(docs: DataFrame, event_time: str | None) -> DataFrame:
    """One row per document: the latest by ``event_time`` if given; ties go to the greatest text."""
    cols = [c for c in docs.columns if c != "doc_id"]
    order = F.struct(*([event_time] if event_time else []), "text")
    latest = docs.groupBy("doc_id").agg(F.max_by(F.struct(*cols), order).alias("_r"))
    return latest.select("doc_id", *[F.col(f"_r.{c}").alias(c) for c in cols])


def should_refresh(spark: SparkSession, base: str, docs: DataFrame, *, encoder_version: str = "hash64",
                   min_change: float = 0.05) -> bool:
    """E11 trigger: refresh when there is no index yet, the encoder changed, or
    the document count moved by more than ``min_change`` (a fraction)."""
    ptr = writers.current_pointer(spark, base)
    if ptr is None or ptr.get("encoder") != encoder_version:
        return True
    n = docs.count()
    old = ptr.get("n_docs") or 0
    return old == 0 or abs(n - old) / old > min_change


def refresh_index(spark: SparkSession, base: str, changed_docs: DataFrame, *, nlist: int = 8,
                  seed: int = 42, encoder=None, version: int | None = None,
                  event_time: str | None = None, encoder_version: str = "hash64",
                  compact: bool = False, stream: str | None = None, epoch: int | None = None) -> int:
    """Fold changed documents into a new index version and publish it.

    Every passage of a changed document replaces the old passages of that
    document (a document that got shorter loses its tail passages).  With
    ``event_time``, the latest delivery of a document wins: within the
    change set, and against the live index (a late, older update is
    ignored).  The first build trains the centroids (E5); later versions
    keep them so cell ids stay stable.  Only touched cells are rewritten
    unless ``compact``.  Returns the published version.

    When ``encoder_version`` differs from the live index's, every live passage
    is encoded anew, the centroids are trained again and a full version is
    written, so one version never mixes encoders.

    ``version`` names the version of a job that may be run again: it is not
    applied twice.  A micro-batch gives ``stream`` and ``epoch`` instead; only
    an epoch that the index already holds *of that stream* is skipped, so a
    stream that starts on an existing index, or with a new checkpoint, loses
    no batch.
    """
    live_v, live, cents = read_live(spark, base)
    new_v = version if version is not None else (live_v or 0) + 1
    if live_v is not None and live_v >= new_v:
        return live_v  # already applied (re-run of the same job)
    if stream is not None and live_v is not None:
        done = writers.last_epoch(spark, base, stream)
        if done is not None and done >= epoch:
            return live_v  # a replayed micro-batch
    live_ptr = writers.current_pointer(spark, base) if live_v is not None else None
    reencode = live_ptr is not None and live_ptr["encoder"] != encoder_version
    changed = latest_per_doc(changed_docs, event_time)
    ts = F.col(event_time).cast("timestamp") if event_time else F.lit(None).cast("timestamp")
    if live is not None and event_time is not None:
        # only the touched documents' live timestamps: semi join with the (small) change set first
        touched_docs = live.select("doc_id", "updated_at").join(changed.select("doc_id"), "doc_id", "left_semi")
        current = touched_docs.groupBy("doc_id").agg(F.max("updated_at").alias("_live_ts"))
        changed = (changed.join(current, "doc_id", "left")
                   .where(F.col("_live_ts").isNull() | (ts >= F.col("_live_ts"))).drop("_live_ts"))
    # the delta (bounded by the change set, not by the index) is materialised once:
    # the change set, its encoded passages (training) and their cells (every use after)
    changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
    encoded = (encode_documents(changed, encoder).join(
        changed.select("doc_id", ts.alias("updated_at")), "doc_id")
        .persist(StorageLevel.MEMORY_AND_DISK))
    ids = changed.select("doc_id")  # one row per document
    if reencode:
        enc = encoder or models.hash_encoder()
        kept = live.join(ids, "doc_id", "left_anti").drop("cell").withColumn("embedding", enc(F.col("text")))
        encoded = encoded.unionByName(kept.select(*encoded.columns)).persist(StorageLevel.MEMORY_AND_DISK)
        live = cents = None
    if cents is None:
        cents = vectors.train_centroids(encoded, "embedding", nlist, seed=seed)
    fresh = vectors.assign_cells(encoded, cents, "embedding", key="passage_id") \
        .persist(StorageLevel.MEMORY_AND_DISK)
    cols = POSTING_COLS + ["updated_at", "cell"]
    touched = None  # None: every cell is rewritten
    live_all = live
    if live is not None and not compact:
        old_cells = live.join(ids, "doc_id", "left_semi").select("cell").distinct()
        new_cells = fresh.select("cell").distinct()
        touched = sorted({int(r[0]) for r in old_cells.unionByName(new_cells).distinct().collect()})
        live = live.where(F.col("cell").isin(touched))
    if live is not None:
        keep = live.join(ids, "doc_id", "left_anti")
        merged = keep.select(*cols).unionByName(fresh.select(*cols))
    else:
        merged = fresh.select(*cols)
    root = writers.publish_index(merged, cents, base, new_v)
    rows = [(c, new_v) for c in _written_cells(spark, f"{root}/postings")]  # <= nlist
    if touched is not None:
        old_man = _manifest(spark, base, live_v)
        rows += [(int(c), int(v)) for c, v in zip(old_man["cell"], old_man["version"]) if int(c) not in touched]
    spark.createDataFrame(rows, "cell int, version int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/manifest")
    # document count kept incrementally: previous count - replaced docs + docs written now
    n_fresh = fresh.select("doc_id").distinct().count()
    if live_all is not None and live_ptr.get("n_docs") is not None:
        replaced = live_all.join(ids, "doc_id", "left_semi").select("doc_id").distinct().count()
        n_docs = int(live_ptr["n_docs"]) - replaced + n_fresh
    else:
        n_docs = n_fresh
    writers.swap_version(spark, base, new_v, encoder_version, n_docs, stream, epoch)
    for df in (fresh, encoded, changed):
        df.unpersist()
    return new_v


def refresh_stream(spark: SparkSession, inbox: str, base: str, checkpoint: str, schema, *,
                   max_files_per_trigger: int | None = None, nlist: int = 8, encoder=None,
                   event_time: str | None = None, processing_time: str | None = None,
                   encoder_version: str = "hash64", keyed_state: bool = False):
    """KB changes arriving as parquet files, applied micro-batch by micro-batch.

    ``Trigger.AvailableNow`` drains what is there and stops; the streaming
    checkpoint (which names the stream) plus the epoch check in
    :func:`refresh_index` make every micro-batch apply exactly once, even
    after a restart.  With
    ``event_time`` the latest delivery of a document wins, even when an
    older one arrives in a later micro-batch.

    With ``keyed_state`` (needs ``event_time``), only a document's newest delivery so far reaches a
    refresh (:mod:`qaflow.streaming.upsert`): late and repeated ones are dropped by its state.

    ``processing_time`` (e.g. ``"10 minutes"``) runs the refresh periodically
    instead (W1's step-count trigger as a processing-time trigger) and returns
    the running ``StreamingQuery``; otherwise the published version is returned.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(inbox)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if batch.limit(1).count() == 0:
            return
        refresh_index(spark, base, batch, nlist=nlist, encoder=encoder, event_time=event_time,
                      encoder_version=encoder_version, stream=checkpoint, epoch=epoch_id)

    if keyed_state:
        stream = upsert.latest_updates(stream, event_time)
    with upsert.state_store(spark) if keyed_state else nullcontext():
        w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        w = w.outputMode("update") if keyed_state else w
        if processing_time:
            return w.trigger(processingTime=processing_time).start()
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    return writers.current_version(spark, base) or 0


def answer_stream(spark: SparkSession, inbox: str, out: str, checkpoint: str, schema: str,
                  answer_batch, metrics: str | None = None) -> None:
    """Questions arriving as files are answered and appended, batch by batch.

    ``answer_batch(df) -> df`` is any batch plan (retrieve + generate).  Each
    micro-batch writes its own ``epoch=N`` directory in overwrite mode, so a
    batch replayed after a failure replaces its own output instead of
    duplicating it (``foreachBatch`` itself is at-least-once).  With ``metrics``, what the
    write of each batch counted (rows, rows without an answer) is kept beside it, one
    replaced ``epoch=N`` directory a batch (K6 / W3).
    """
    from qaflow.operators.metrics import observed

    stream = spark.readStream.schema(schema).parquet(inbox)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        answers, seen = observed(answer_batch(batch), f"answers-{epoch_id}", answered=F.count(F.lit(1)),
                                 empty=F.count_if(F.coalesce(F.col("prediction"), F.lit("")) == ""))
        answers.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")
        if metrics:
            got = seen.get
            spark.createDataFrame([(got["answered"], got["empty"])], "answered long, empty long") \
                .write.mode("overwrite").json(f"{metrics}/epoch={epoch_id}")

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def append_metrics_history(metrics: DataFrame, path: str, step: int) -> None:
    """Append one evaluation's metrics to the history (never rewritten)."""
    metrics.withColumn("step", F.lit(step)).write.mode("append").json(path)
