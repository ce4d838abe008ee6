"""One global detector over any amount of data: iterative parameter mixing.

A batch is cut into slices of consecutive events. Every slice starts from the same
models and folds its own events, test then train, in its own task. At the end of the
batch the weights are averaged, the statistics merged exactly, the newest rules kept,
and the drift test sees one block of errors per slice
(McDonald, Hall and Mann, NAACL 2010).

Against the exact fold three things differ: a slice does not see what the other slices
of its batch learn, weights are averages, and drift is answered between batches.

Batches follow one another by their meaning, so what a batch costs beside its folds decides how
long a run takes. The slices of many batches are therefore sorted and packed by one query, each to a partition
that stays with the executors. A batch is then one job over its own partitions, without a plan or a shuffle.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.learning.adwin import AdaptiveWindow
from tidewarden.learning.detector import BLOCK_ROWS, Detector
from tidewarden.learning.exact import (
    FEATURE_COLUMNS,
    WATCHED_SCHEMA,
    copy_columns,
    detections_of,
    fold_frame,
    fold_input,
)
from tidewarden.learning.kernel import Model, model_of_row, row_of_model
from tidewarden.operators.ensemble import initial_state, shard_list
from tidewarden.operators.ordered import instance_number
from tidewarden.schema import MODEL_STATE_SCHEMA, N_FEATURES, DetectorOptions
from tidewarden.session import scratch_path, ship_package
from tidewarden.sources.model_store import (
    is_written,
    load_model,
    newest_version,
    numbered_folders,
    read_log,
    save_model,
)

ROWS_PER_SLICE = 100_000
SLICES_PER_BATCH = 8
#: Batches whose detections and models are written together, and events in them (or one batch);
#: a stopped run goes on after the last of them.
BATCHES_PER_WRITE = 64
ROWS_PER_WRITE = 4_000_000
#: Events of a batch that a task writes.
ROWS_PER_TASK = 50_000
_FOLDS_SCHEMA = T.StructType(WATCHED_SCHEMA.fields + [T.StructField("batch", T.IntegerType())])
#: Columns that folds written by earlier versions have beside detections, in rows without an event.
_EARLIER = ("models", "chunk", "n", "errors")
_CONTROL = "batch int, instance_number bigint, ts bigint, error_rate double, drift boolean, window string"


@dataclass(frozen=True)
class MixRun:
    """Where a run keeps its tables; the run can be read, and resumed, from any session."""

    spark: SparkSession
    root: str

    @property
    def models_path(self) -> str:
        return f"{self.root}/models"

    @property
    def slices_path(self) -> str:
        return f"{self.root}/slices"

    @property
    def folds_path(self) -> str:
        return f"{self.root}/folds"

    @property
    def control_path(self) -> str:
        return f"{self.root}/control"

    def detections(self) -> DataFrame:
        return detections_of(read_log(self.spark, self.folds_path)).drop("batch", *_EARLIER)

    def state(self) -> DataFrame:
        return load_model(self.spark, self.models_path)

    def control(self) -> DataFrame:
        """One row per batch: rows, errors, whether it answered a drift, the window."""
        return read_log(self.spark, self.control_path)

    def drift_events(self) -> DataFrame:
        return self.control().filter("drift").select(
            F.lit(0).alias("shard"),
            "instance_number",
            "ts",
            "error_rate",
            F.lit("DRIFT").alias("type"),
        )


def _own_moments(models: list[Model], centre: np.ndarray, sums: dict) -> None:
    """Put a slice's own statistics in place of the ones it continued from."""
    for m, model in enumerate(models):
        n, s1, s2 = sums["n"][m], sums["s1"][m], sums["s2"][m]
        model.n = int(n)
        model.mean = centre + s1 / max(n, 1)
        model.m2 = np.maximum(s2 - s1 * s1 / max(n, 1), 0.0)


@dataclass
class _Learned:
    """What a slice tells of itself at the end of its batch: its own models, its events and their errors."""

    chunk: int
    models: list[Model]
    n: int
    errors: int


class _SliceFold:
    """The fold of one slice, block by block, from the models that all slices of its batch start with.

    ``offsets`` counts, for each model, the batch's training copies before the slice.
    """

    def __init__(self, common: list[Model], offsets: list[int], options: DetectorOptions):
        begun = [
            Model(**{**vars(m), "clock": m.clock + offset, "correct": 0, "seen": 0})
            for m, offset in zip(common, offsets)
        ]
        self.detector = Detector(begun, AdaptiveWindow(options.drift_delta))
        self.options = options.with_(drift_enabled=False)
        shape = (len(common), N_FEATURES)
        self.sums = {"n": np.zeros(len(common)), "s1": np.zeros(shape), "s2": np.zeros(shape)}
        self.centre, self.rows, self.errors = None, 0, 0

    def fold(self, frame: pd.DataFrame) -> pd.DataFrame:
        """Detections of the slice's next block."""
        x, copies = frame[FEATURE_COLUMNS].to_numpy(float), frame[copy_columns(self.options)].to_numpy()
        self.centre = x[0] if self.centre is None else self.centre
        self.sums["n"] += copies.sum(axis=0)
        self.sums["s1"] += copies.T @ (x - self.centre)
        self.sums["s2"] += copies.T @ (x - self.centre) ** 2
        folded = fold_frame(self.detector, frame, self.options)
        self.rows += len(folded)
        self.errors += int(((folded["is_bot_pred"] != folded["is_bot"]) & folded["is_bot"].notna()).sum())
        return folded

    def learned(self, chunk: int, oldest: list[int]) -> _Learned:
        """What the slice learned; of its rules those from ``oldest`` on, by model."""
        _own_moments(self.detector.models, self.centre, self.sums)
        for model, seq in zip(self.detector.models, oldest):
            new = model.rule_seq >= seq
            model.rules, model.rule_bot = model.rules[new], model.rule_bot[new]
            model.rule_seq = model.rule_seq[new]
        return _Learned(chunk, self.detector.models, self.rows, self.errors)


def _oldest_kept(models: list[Model], totals: list[int], options: DetectorOptions) -> list[int]:
    """By model, the first of a batch's rules that no newer one of the batch will displace."""
    grace = options.grace_period
    return [
        max(m.clock, ((m.clock + total - 1) // grace - options.max_rules + 1) * grace)
        for m, total in zip(models, totals)
    ]


def _blocks(frames: Iterable[pd.DataFrame], names: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Ordered rows as blocks of :data:`BLOCK_ROWS` rows, each with its group (``names``), the last of a group shorter.

    However the rows arrive, a group is cut in the same places, so its fold gives the same to the last digit.
    """
    key, held, size = None, [], 0

    def rest() -> Iterator[tuple[tuple, pd.DataFrame]]:
        if size:
            yield key, pd.concat(held, ignore_index=True)

    for frame in frames:
        if not len(frame):
            continue
        marks = frame[names].to_numpy()
        cuts = (np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist()
        for at, end in zip([0, *cuts], [*cuts, len(frame)]):
            group = tuple(int(mark) for mark in marks[at])
            if group != key:
                yield from rest()
                key, held, size = group, [], 0
            while at < end:
                step = min(end - at, BLOCK_ROWS - size)
                held.append(frame.iloc[at : at + step])
                at, size = at + step, size + step
                if size == BLOCK_ROWS:
                    yield from rest()
                    held, size = [], 0
    yield from rest()


@dataclass
class _Batch:
    """A batch's slices (``chunk``): for each, the batch's training copies per model before it; all
    such copies; the latest time in microseconds."""

    number: int
    starts: dict[int, list[int]]
    totals: list[int]
    ended: int | None


def _known_batches(slices: DataFrame, options: DetectorOptions) -> list[_Batch]:
    """The given batches in order. One row per slice reaches the driver."""
    names = copy_columns(options)
    counted = slices.groupBy("batch", "chunk").agg(
        F.max(F.unix_micros("ts")).alias("ended"), *[F.sum(c).alias(c) for c in names]
    )
    found: dict[int, _Batch] = {}
    for row in sorted(counted.collect(), key=lambda r: (r["batch"], r["chunk"])):
        batch = found.setdefault(row["batch"], _Batch(row["batch"], {}, [0] * len(names), None))
        batch.starts[row["chunk"]] = batch.totals
        batch.totals = [before + row[c] for before, c in zip(batch.totals, names)]
        batch.ended = max((t for t in (batch.ended, row["ended"]) if t is not None), default=None)
    return list(found.values())


def packed_slices(slices: DataFrame, known: list[_Batch]) -> tuple[DataFrame, dict[int, list[int]]]:
    """Sorted blocks of the slices (``batch``, ``chunk``), one slice to a partition, and each batch's partitions.

    Rows are sorted and packed in as many tasks as there are cores; only blocks are dealt to the many partitions.
    """
    spark = slices.sparkSession
    ship_package(spark)
    firsts, partitions, width = [], {}, 0
    for batch in known:
        lowest, highest = min(batch.starts), max(batch.starts)
        firsts += [F.lit(batch.number), F.lit(width - lowest)]
        partitions[batch.number] = [width + chunk - lowest for chunk in sorted(batch.starts)]
        width += highest - lowest + 1
    number = (F.element_at(F.create_map(*firsts), F.col("batch")) + F.col("chunk")).cast("int")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for place, ((batch, chunk), block) in enumerate(_blocks(frames, ["batch", "chunk"])):
            yield pd.DataFrame({"batch": [batch], "chunk": [chunk], "place": [place], "block": [pickle.dumps(block)]})

    tasks = min(width, spark.sparkContext.defaultParallelism)
    ordered = slices.repartitionById(tasks, number).sortWithinPartitions("batch", "chunk", "ts", "event_id")
    blocks = ordered.mapInPandas(pack, "batch int, chunk int, place bigint, block binary")
    dealt = blocks.repartitionById(width, number).sortWithinPartitions("place")
    return dealt.select("chunk", "block"), partitions


def _some_partitions(rdd: RDD, numbers: list[int]) -> RDD:
    """Partitions of an RDD by their numbers; a job over them starts no task for the others."""
    jvm = rdd.ctx._jvm
    wanted = jvm.org.apache.spark.api.python.PythonUtils.toSeq(numbers).toSet()  # a set is a function to booleans
    some = jvm.org.apache.spark.rdd.PartitionPruningRDD.create(rdd._jrdd.rdd(), wanted)
    return RDD(some.toJavaRDD(), rdd.ctx, rdd._jrdd_deserializer)


def fold_slices(packed: RDD, models: list[Model], batch: _Batch, options: DetectorOptions) -> RDD:
    """Fold each slice of a batch from ``models``: (None, detections of a block) for all its blocks,
    then (what it learned, None).

    Rules are taken at the same training indices as by one sequential model. From the
    batch's totals a slice knows which of its rules newer ones will displace, so all
    slices together return at most ``max_rules`` per model.
    """
    starts, oldest, number = batch.starts, _oldest_kept(models, batch.totals, options), batch.number
    names = _FOLDS_SCHEMA.fieldNames()

    def fold(rows: Iterator) -> Iterator[tuple]:
        part = chunk = None
        for chunk, block in rows:
            part = part or _SliceFold(models, starts[chunk], options)
            yield None, pickle.dumps(part.fold(pickle.loads(block)).assign(batch=number)[names])
        if part:
            yield part.learned(chunk, oldest), None

    return packed.mapPartitions(fold)


def mixed_model(model: Model, parts: list[Model], options: DetectorOptions) -> Model:
    """The next common model from the last one and each slice's own.

    Weights are averaged by training copies, statistics merge exactly (around the first
    part's mean, so no digits are lost), and the newest ``max_rules`` rules stay.
    """
    held = [p for p in (model, *parts) if p.n > 0]
    own = [p for p in parts if p.n > 0]
    if not own:
        return model
    counts = np.array([p.n for p in held], float)[:, None]
    centre = held[0].mean
    shifts = np.array([p.mean for p in held]) - centre
    n = counts.sum()
    s1 = (counts * shifts).sum(axis=0)
    s2 = (np.array([p.m2 for p in held]) + counts * shifts**2).sum(axis=0)
    weights = np.average([p.weights for p in own], axis=0, weights=[p.n for p in own])
    total = weights.sum()
    seq = np.concatenate([p.rule_seq for p in (model, *parts)])
    newest = np.argsort(seq)[-options.max_rules :]
    return Model(
        n=int(n),
        mean=centre + s1 / n,
        m2=np.maximum(s2 - s1 * s1 / n, 0.0),
        weights=weights / total if total > 0 else weights,
        rules=np.concatenate([p.rules for p in (model, *parts)])[newest],
        rule_seq=seq[newest],
        rule_bot=np.concatenate([p.rule_bot for p in (model, *parts)])[newest],
        correct=model.correct + sum(p.correct for p in parts),
        seen=model.seen + sum(p.seen for p in parts),
    )


def mixed_models(models: list[Model], parts: list[list[Model]], options: DetectorOptions) -> list[Model]:
    """The next common models, as a table would keep them; ``parts`` holds each slice's own, in slice order."""
    following = [mixed_model(m, [own[i] for own in parts], options) for i, m in enumerate(models)]
    return _kept(following)


def _kept(models: list[Model]) -> list[Model]:
    return [model_of_row(row_of_model(0, m, 0, model)) for m, model in enumerate(models)]


def _without_worst(models: list[Model], vote: str) -> list[Model]:
    """A fresh model in place of the worst one; see :func:`tidewarden.operators.ensemble.replace_worst`."""
    accuracy = [m.correct / m.seen if vote == "weighted" and m.seen else 0.0 for m in models]
    worst = accuracy.index(min(accuracy))
    return [Model() if m == worst else model for m, model in enumerate(models)]


def _last_window(run: MixRun, version: int, options: DetectorOptions) -> tuple[AdaptiveWindow, int]:
    """The drift window and event count that a model version was left with."""
    row = run.spark.read.parquet(f"{run.control_path}/batch={version - 1}").first() if version else None
    if row is None:
        return AdaptiveWindow(options.drift_delta), 0
    kept = json.loads(row["window"])
    return AdaptiveWindow(options.drift_delta, kept["rows"], kept["ticks"]), row["instance_number"]


def mix_batch(run: MixRun, slices: DataFrame, batch: int, options: DetectorOptions) -> None:
    """Detect and learn over one batch of sliced :func:`fold_input` rows."""
    mix_batches(run, slices.withColumn("batch", F.lit(batch)), options)


def mix_batches(run: MixRun, slices: DataFrame, options: DetectorOptions) -> None:
    """Detect and learn over some consecutive batches (``batch``) of sliced :func:`fold_input` rows.

    Reads the newest model version up to the first batch (batches without rows leave gaps) and
    writes version ``batch + 1`` of the last one; every write replaces what an earlier attempt at
    the same batches left behind. A batch costs one job: its slices are folded and kept, and what
    they learned comes to the driver, an element for each slice. Detections are written for all
    batches together.
    """
    spark = run.spark
    known = _known_batches(slices, options)
    version = newest_version(spark, run.models_path, below=known[0].number + 1)
    state = load_model(spark, run.models_path, version)
    models = [model_of_row(row) for row in state.orderBy("model_id").collect()]  # n_models rows
    window, instance = _last_window(run, version, options)
    blocks, partitions = packed_slices(slices, known)
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    folds: list[RDD] = []
    written: list[RDD] = []
    control = []
    try:
        packed = blocks.rdd
        for batch in known:
            own = _some_partitions(packed, partitions[batch.number])
            folds.append(fold_slices(own, models, batch, options).persist(StorageLevel.MEMORY_AND_DISK))
            learned = folds[-1].filter(lambda pair: pair[0] is not None).keys().collect()  # one for each slice
            learned.sort(key=lambda part: part.chunk)
            if [part.chunk for part in learned] != sorted(batch.starts):
                raise RuntimeError(f"batch {batch.number}: not all of its slices were folded")
            models = mixed_models(models, [part.models for part in learned], options)
            drift = False
            for part in learned:
                drift |= window.add(float(part.errors), part.n)
            rows = sum(part.n for part in learned)
            written.append(folds[-1].coalesce(max(1, rows // ROWS_PER_TASK)))
            instance += rows
            rate = window.estimate
            drift = drift and options.drift_enabled
            if drift:
                models = _without_worst(models, options.vote)
                window = AdaptiveWindow(options.drift_delta)
            kept = json.dumps({"rows": window.rows, "ticks": window.ticks})
            control.append((batch.number, instance, batch.ended, rate, drift, kept))
        _log_batches(_detections_of_folds(spark, written), run.folds_path)
    finally:
        for folded in folds:
            folded.unpersist()
        blocks.unpersist()
    told = spark.createDataFrame(control, _CONTROL)  # a batch has a row, so a file
    _log_batches(told.withColumn("ts", F.timestamp_micros("ts")), run.control_path)
    rows = [row_of_model(0, m, 0, model) for m, model in enumerate(models)]
    following = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1), MODEL_STATE_SCHEMA)
    save_model(following, run.models_path, known[-1].number + 1)  # marks them as finished


def _detections_of_folds(spark: SparkSession, folds: list[RDD]) -> DataFrame:
    """The detections that several results of :func:`fold_slices` hold."""
    blocks = spark.sparkContext.union(folds).values().filter(lambda block: block is not None)

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block in frame["block"]:
                yield pickle.loads(block)

    packed = spark.createDataFrame(blocks.map(lambda block: (block,)), "block binary", verifySchema=False)
    return packed.mapInPandas(unpack, _FOLDS_SCHEMA)


def _log_batches(rows: DataFrame, path: str) -> None:
    """:func:`append_log` of several batches, each under its own number."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def batch_starts(chunks: int, per_batch: int) -> list[int]:
    """First chunk of each batch: 1, 1, 2, 4, ... chunks, then ``per_batch`` each.

    Small first batches share what is learned early, when every mistake moves much.
    """
    starts, size, at = [], 1, 0
    while at < chunks:
        starts.append(at)
        at += size
        size = min(per_batch, at)
    return starts


def batch_number(chunk: Column, per_batch: int) -> Column:
    """The batch of a slice, as :func:`batch_starts` deals them, without a list of starts."""
    doubled = max(1, (per_batch - 1).bit_length() and 1 << (per_batch - 1).bit_length())
    steps = doubled.bit_length()
    early = F.floor(F.log2(F.greatest(chunk, F.lit(1)).cast("double")) + F.lit(1e-9)) + 1
    later = F.lit(steps) + F.floor((chunk - doubled) / per_batch)
    return F.when(chunk == 0, 0).when(chunk < doubled, early).otherwise(later).cast("int")


def sliced(events: DataFrame, options: DetectorOptions, rows_per_slice: int) -> DataFrame:
    """:func:`fold_input` of one stream, each ``rows_per_slice`` events in order one ``chunk``."""
    numbered = instance_number(fold_input(events.withColumn("shard", F.lit(0)), options))
    chunk = F.floor((F.col("instance_number") - 1) / rows_per_slice).cast("int")
    return numbered.withColumn("chunk", chunk).drop("instance_number")


def mix(
    events: DataFrame,
    options: DetectorOptions,
    root: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    slices_per_batch: int = SLICES_PER_BATCH,
) -> MixRun:
    """Run over a whole table in event order. A run with an existing ``root`` resumes
    after its last finished batch.

    Slices hold ``rows_per_slice`` events by their exact number in the stream, so the result
    depends on the two sizes alone, not on cores, partitions or sampled borders.
    """
    spark = events.sparkSession
    run = MixRun(spark, root or scratch_path(spark, "mixing"))
    if not is_written(spark, run.slices_path):
        cut = sliced(events, options, rows_per_slice)
        cut = cut.withColumn("batch", batch_number(F.col("chunk"), slices_per_batch))
        cut.repartition("chunk").write.mode("overwrite").partitionBy("batch").parquet(run.slices_path)
    if newest_version(spark, run.models_path) is None:
        save_model(initial_state(shard_list(spark, 1), options), run.models_path, 0)
    done = newest_version(spark, run.models_path)
    per_write = max(1, min(BATCHES_PER_WRITE, ROWS_PER_WRITE // (rows_per_slice * slices_per_batch)))
    left = [batch for batch in numbered_folders(spark, run.slices_path, "batch") if batch >= done]
    if left:
        schema = spark.read.parquet(f"{run.slices_path}/batch={left[0]}").schema.add("batch", T.IntegerType())
    for at in range(0, len(left), per_write):
        paths = [f"{run.slices_path}/batch={batch}" for batch in left[at : at + per_write]]
        part = spark.read.schema(schema).option("basePath", run.slices_path).parquet(*paths)
        mix_batches(run, part, options)
    return run
