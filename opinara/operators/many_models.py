"""Many logistic models over the same rows in one optimisation.

Cross-validation of several targets over a grid fits one model for each target, value
and fold, all on the same vectors. Here they are the columns of one coefficient matrix.
A step of L-BFGS reads the vectors once: each task adds up the gradients of all models
over its rows, the sums are added up in a tree, and one job gives them all. So jobs grow
with the steps, not with targets x values x folds x steps. Step lengths are tried by the
losses alone, ``LENGTHS`` of them in one reading and a number for each, so a step sends
the driver one matrix, whatever the rows, the tasks and the lengths tried.

A model minimises the mean log loss plus ``reg_param / 2`` times the squared length of
its coefficients, those taken for features of unit variance over the rows it is
fitted to; the intercept is free. That is what ``LogisticRegression`` minimises with its
defaults, so both have the same optimum.

Vectors are packed once, in compressed blocks of rows, into the shared folder. A task
holds ``BATCH_BLOCKS`` of them at a time, and no more than ``GROUP_BYTES`` in a row group,
whatever the rows of its part. Tasks take ``PART_BLOCKS`` each or more, since each sends
a matrix. The driver holds ``HISTORY`` pairs of matrices; ``DRIVER_BYTES`` bounds them, and
more models than fit are optimised some at a time. No row reaches the driver.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators.evaluate import areas
from opinara.session import scratch_path

HISTORY = 10
MOST_STEPS = 200
# Steps end when no model's loss falls by more than this share.
TOLERANCE = 1e-8
# Bytes of matrices on the driver, and of tasks' sums that are sent there as they are.
DRIVER_BYTES, DIRECT_BYTES = 256 << 20, 4 << 20
# Entries of a block's rows, which are worked on together for all models.
BLOCK_ENTRIES = 1 << 17
# Vectors and blocks sent to a worker at once, bytes of a row group of blocks, and blocks of a task beyond one task a core.
BATCH_VECTORS, BATCH_BLOCKS, GROUP_BYTES, PART_BLOCKS = 2048, 4, 4 << 20, 256
# Rows of the matrix in one piece of a gradient, and partial sums added at a time.
PIECE, FAN_IN = 8192, 32
# Step lengths tried in one reading of the rows, each half the one before, and readings at most.
LENGTHS, READINGS = 6, 5
RAW_VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


@dataclass(frozen=True)
class Fit:
    """One model: its 0/1 label column, its penalty, and the fold it leaves out, if any."""

    label: str
    reg_param: float
    without: int | None = None


@dataclass
class Fitted:
    """Coefficients by feature and model, intercepts, and how the optimisation ended."""

    fits: list[Fit]
    coefficients: np.ndarray
    intercepts: np.ndarray
    losses: np.ndarray
    gradient: np.ndarray
    steps: int


@dataclass
class Packed:
    """The written blocks of rows, their labels' names, the number of features, and of tasks that read the blocks.

    ``blocks`` belong to a session whose workers get ``BATCH_BLOCKS`` at once, not to ``spark``.
    """

    spark: SparkSession
    blocks: DataFrame
    labels: list[str]
    n_features: int
    parts: int


def _frozen(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    held = out.getvalue()
    return len(held).to_bytes(8, "little") + pa.compress(held, codec="lz4", asbytes=True)


def _thawed(block: bytes) -> Mapping[str, np.ndarray]:
    held = pa.decompress(memoryview(block)[8:], int.from_bytes(block[:8], "little"), codec="lz4")
    return np.load(io.BytesIO(held))


def _few_at_a_time(spark: SparkSession, rows: int) -> SparkSession:
    """A session with the same settings, but for workers that get no more than ``rows`` at once."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return own


def pack(vectors: DataFrame, labels: Sequence[str], fold: str, features: str = "features") -> Packed:
    """Vectors, 0/1 labels and folds as blocks of arrays, ordered by row and by feature."""
    spark = vectors.sparkSession
    path = scratch_path(spark, "raw_vectors")
    held = vectors.select(
        F.col(features).alias("features"), *[F.col(c).cast("double").alias(c) for c in labels], F.col(fold).cast("int").alias("fold")
    )
    held.write.parquet(path)
    schema = f"features {RAW_VECTOR}, {', '.join(f'{c} double' for c in labels)}, fold int"
    raw = _few_at_a_time(spark, BATCH_VECTORS).read.schema(schema).parquet(path)
    names = list(labels)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column("features")
            dense = np.asarray(vector.field("type")) == 1
            sizes = np.asarray(vector.field("size").fill_null(0))
            lengths = np.asarray(vector.field("values").value_lengths()).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(lengths)])
            y = np.stack([np.asarray(batch.column(c)) for c in names], axis=1)
            fold_of = np.asarray(batch.column("fold"))
            low = 0
            while low < batch.num_rows:
                high = int(np.searchsorted(first, first[low] + BLOCK_ENTRIES, side="right")) - 1
                high = min(max(high, low + 1), batch.num_rows)
                starts_at, own = first[low : high + 1] - first[low], lengths[low:high]
                values = np.asarray(vector.field("values").slice(low, high - low).flatten())
                columns = np.arange(starts_at[-1]) - np.repeat(starts_at[:-1], own)
                columns[~np.repeat(dense[low:high], own)] = np.asarray(vector.field("indices").slice(low, high - low).flatten())
                size = max(int(sizes[low:high].max()), int(columns.max(initial=-1)) + 1)
                order = np.argsort(columns, kind="stable")
                ranked = columns[order]
                owner = np.repeat(np.arange(high - low), own)
                starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else order
                made = _frozen(
                    first=starts_at,
                    columns=columns.astype(np.int32),
                    values=values,
                    labels=y[low:high],
                    fold=fold_of[low:high],
                    owner=owner[order].astype(np.int32),
                    ranked_values=values[order],
                    starts=starts,
                    features=ranked[starts].astype(np.int32),
                )
                yield pa.record_batch([pa.array([made], pa.binary()), pa.array([size], pa.int32())], ["block", "size"])
                low = high

    path = scratch_path(spark, "packed_vectors")
    # A block is far larger than the rows these bounds are looked at after by default.
    written = raw.mapInArrow(blocks, "block binary, size int").write.option("compression", "none")
    for name, value in {"block.size": GROUP_BYTES, "block.size.row.check.min": 1, "page.size.row.check.min": 1}.items():
        written = written.option(f"parquet.{name}", value)
    written.option("parquet.enable.dictionary", "false").parquet(path)
    packed = _few_at_a_time(spark, BATCH_BLOCKS).read.schema("block binary, size int").parquet(path)
    size, n_blocks = packed.agg(F.max("size"), F.count("*")).first()
    cores = spark.sparkContext.defaultParallelism
    parts = min(packed.rdd.getNumPartitions(), cores * max(1, -(-n_blocks // (cores * PART_BLOCKS))))
    return Packed(spark, packed.coalesce(max(1, parts)), names, size or 0, parts)


class _Rows:
    """A block's rows, by row and by feature."""

    def __init__(self, block: bytes) -> None:
        held = _thawed(block)
        self.first, self.columns, self.values = held["first"], held["columns"], held["values"]
        self.labels, self.fold = held["labels"], held["fold"]
        self.owner, self.ranked_values = held["owner"], held["ranked_values"]
        self.starts, self.features = held["starts"], held["features"]

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The rows' products with the columns of ``matrix``, which are read one by one."""
        out = np.zeros((len(self.first) - 1, matrix.shape[1]))
        filled = np.flatnonzero(np.diff(self.first))
        if len(filled):
            for i in range(matrix.shape[1]):
                out[filled, i] = np.add.reduceat(matrix[:, i].take(self.columns) * self.values, self.first[:-1][filled])
        return out

    def add_transposed(self, total: np.ndarray, rows: np.ndarray, power: int = 1) -> None:
        """Add the transposed rows' products with ``rows`` to ``total``."""
        if len(self.starts):
            own = np.repeat(np.arange(len(self.starts)), np.diff(self.starts, append=len(self.owner)))
            values = self.ranked_values**power
            for i in range(rows.shape[1]):
                total[self.features, i] += np.bincount(own, rows[:, i].take(self.owner) * values, len(self.starts))


def _tree_sum(packed: Packed, of_block, height: int, width: int) -> np.ndarray:
    """The sum over all blocks of what ``of_block`` adds to a matrix, added up in a tree.

    A task adds up its blocks and sends the matrix in pieces, without those that are all zero;
    equal pieces of some tasks are added up, then those of all. Sums of few tasks,
    ``DIRECT_BYTES`` in all, need no tree.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            for block in batch.column("block"):
                of_block(total, _Rows(block.as_py()))
        for piece in range(0, height, PIECE):
            held = total[piece : piece + PIECE]
            if held.any():
                yield pa.record_batch([pa.array([piece]), pa.array([held.tobytes()], pa.binary())], ["piece", "data"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), dtype=np.float64) for x in table.column("data"))
        return pa.table({"piece": table.column("piece").slice(0, 1), "data": pa.array([total.tobytes()], pa.binary())})

    def add_some(table: pa.Table) -> pa.Table:
        return add(table.drop_columns(["some"]))

    some = packed.blocks.select("block").mapInArrow(of_task, "piece long, data binary")
    if 8 * height * width * packed.parts > DIRECT_BYTES:
        if packed.parts > FAN_IN:
            salted = some.withColumn("some", (F.spark_partition_id() / FAN_IN).cast("int"))
            some = salted.groupBy("piece", "some").applyInArrow(add_some, "piece long, data binary")
        some = some.groupBy("piece").applyInArrow(add, "piece long, data binary")
    # As an Arrow table, of which the driver's JVM makes no rows.
    sums = some.toArrow()
    total = np.zeros((height, width))
    for at, data in zip(sums.column("piece").to_pylist(), sums.column("data"), strict=True):
        piece = np.frombuffer(data.as_buffer(), dtype=np.float64).reshape(-1, width)
        total[at : at + len(piece)] += piece
    return total


class _Problem:
    """The losses of some fits and their gradients, with every feature centred and of unit variance."""

    def __init__(self, packed: Packed, fits: Sequence[Fit], moments: dict[int | None, np.ndarray]) -> None:
        self.packed, self.fits = packed, list(fits)
        features, k = packed.n_features, len(self.fits)
        self.label = np.array([packed.labels.index(f.label) for f in self.fits])
        self.without = np.array([-1 if f.without is None else f.without for f in self.fits])
        self.reg = np.array([f.reg_param for f in self.fits])
        self.mean, self.scale = np.zeros((features, k)), np.zeros((features, k))
        self.n = np.zeros(k)
        positive = np.zeros(k)
        for i, fit in enumerate(self.fits):
            held = moments[None] - (0 if fit.without is None else moments.get(fit.without, 0))
            n = held[features, 0]
            self.n[i] = n
            positive[i] = held[features + 1 + self.label[i], 0]
            if n > 1:
                mean = held[:features, 0] / n
                deviation = np.sqrt(np.maximum(held[:features, 1] - n * mean**2, 0.0) / (n - 1))
                self.mean[:, i] = mean
                self.scale[:, i] = np.where(deviation > 1e-12, 1.0 / np.maximum(deviation, 1e-12), 0.0)
        share = np.clip(positive / np.maximum(self.n, 1), 1e-9, 1 - 1e-9)
        self.start = np.zeros((features + 1, k))
        self.start[-1] = np.log(share / (1 - share))

    def plain(self, at: np.ndarray) -> np.ndarray:
        """Coefficients for the features as they are, the intercept in the last row; each model's lie together."""
        made = at.copy(order="F")
        made[:-1] *= self.scale
        made[-1] -= (self.mean * made[:-1]).sum(axis=0)
        return made

    def losses(self, at: np.ndarray, way: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each model's loss after going ``way`` by each row of ``lengths``, from one reading of the rows."""
        context = self.packed.spark.sparkContext
        shared = context.broadcast((self.plain(at), self.plain(way), lengths, self.label, self.without))

        def of_block(total: np.ndarray, rows: _Rows) -> None:
            weights, ways, lengths, label, without = shared.value
            margin, slope = rows.times(weights[:-1]) + weights[-1], rows.times(ways[:-1]) + ways[-1]
            y, used = rows.labels[:, label], rows.fold[:, None] != without
            for i, length in enumerate(lengths):
                there = margin + length * slope
                total[i] += (used * (np.logaddexp(0.0, there) - y * there)).sum(axis=0)

        total = _tree_sum(self.packed, of_block, len(lengths), len(self.fits))
        shared.destroy()
        a, b = at[:-1], way[:-1]
        squares = (a * a).sum(axis=0) + lengths * (2 * (a * b).sum(axis=0) + lengths * (b * b).sum(axis=0))
        return total / np.maximum(self.n, 1) + 0.5 * self.reg * squares

    def evaluate(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each model's loss and gradient, from one reading of the rows."""
        features, k = self.packed.n_features, len(self.fits)
        context = self.packed.spark.sparkContext
        shared = context.broadcast((self.plain(at), self.label, self.without))

        def of_block(total: np.ndarray, rows: _Rows) -> None:
            weights, label, without = shared.value
            margin = rows.times(weights[:-1]) + weights[-1]
            y = rows.labels[:, label]
            used = rows.fold[:, None] != without
            total[-1] += (used * (np.logaddexp(0.0, margin) - y * margin)).sum(axis=0)
            rest = used * (1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - y)
            total[-2] += rest.sum(axis=0)
            rows.add_transposed(total, rest)

        total = _tree_sum(self.packed, of_block, features + 2, k)
        shared.destroy()
        n = np.maximum(self.n, 1)
        gradient = np.empty((features + 1, k))
        gradient[-1] = total[-2] / n
        gradient[:-1] = self.scale * (total[:-2] - self.mean * total[-2]) / n + self.reg * at[:-1]
        return total[-1] / n + 0.5 * self.reg * (at[:-1] ** 2).sum(axis=0), gradient


def _moments(packed: Packed) -> dict[int | None, np.ndarray]:
    """For each fold, and for all rows: sum and sum of squares by feature; below them the rows, and each label's positives."""
    folds = [r.fold for r in _folds(packed)]
    features, n_labels = packed.n_features, len(packed.labels)
    height = features + 1 + n_labels

    def of_block(total: np.ndarray, rows: _Rows) -> None:
        shaped = total.reshape(len(total), len(folds), 2)
        in_fold = (rows.fold[:, None] == np.array(folds)[None, :]).astype(float)
        for power in (1, 2):
            rows.add_transposed(shaped[:, :, power - 1], in_fold, power)
        shaped[features, :, 0] += in_fold.sum(axis=0)
        for j in range(n_labels):
            shaped[features + 1 + j, :, 0] += in_fold.T @ rows.labels[:, j]

    if not folds:
        return {None: np.zeros((height, 2))}
    total = _tree_sum(packed, of_block, height, len(folds) * 2)
    shaped = total.reshape(-1, len(folds), 2)
    return {None: shaped.sum(axis=1), **{fold: shaped[:, i] for i, fold in enumerate(folds)}}


def _folds(packed: Packed) -> list:
    def folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("block"):
                yield pa.record_batch([pa.array(np.unique(_Rows(block.as_py()).fold))], ["fold"])

    return packed.blocks.select("block").mapInArrow(folds, "fold int").distinct().orderBy("fold").collect()


def _direction(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The step of each model by its last changes of place and gradient."""
    q = gradient.copy()
    used = []
    for s, y in reversed(pairs):
        sy = (s * y).sum(axis=0)
        good = sy > 1e-16
        rho = np.where(good, 1.0 / np.where(good, sy, 1.0), 0.0)
        a = rho * (s * q).sum(axis=0)
        q -= a * y
        used.append((s, y, rho, a, good, sy))
    if used:
        s, y, _, _, good, sy = used[0]
        q *= np.where(good, sy / np.maximum((y * y).sum(axis=0), 1e-300), 1.0)
    for s, y, rho, a, _, _ in reversed(used):
        q += s * (a - rho * (y * q).sum(axis=0))
    return -q


def _minimise(problem: _Problem, most_steps: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All models' minima; each has its own step length, and all are tried in one reading.

    Gradients are read once a step, at the lengths taken.
    """
    at = problem.start
    loss, gradient = problem.evaluate(at)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for step in range(1, most_steps + 1):
        way = _direction(gradient, pairs)
        slope = (way * gradient).sum(axis=0)
        way = np.where(slope < 0, way, -gradient)
        slope = (way * gradient).sum(axis=0)
        length = np.ones(len(loss)) if pairs else 1.0 / np.maximum(np.sqrt((gradient**2).sum(axis=0)), 1.0)
        low_enough = np.zeros(len(loss), dtype=bool)
        for _ in range(READINGS):
            lengths = length * 0.5 ** np.arange(LENGTHS)[:, None]
            # A fall below what the loss can resolve is as good as any.
            low = problem.losses(at, way, lengths) <= loss + 1e-4 * lengths * slope + 1e-15 * np.abs(loss)
            best = np.where(low.any(axis=0), low.argmax(axis=0), LENGTHS - 1)
            length = np.where(low_enough, length, lengths[best, np.arange(len(loss))])
            low_enough |= low.any(axis=0)
            if low_enough.all():
                break
            length = np.where(low_enough, length, 0.5 * length)
        tried = at + length * way
        new_loss, new_gradient = problem.evaluate(tried)
        kept = np.where(low_enough, 1.0, 0.0)
        pairs.append(((tried - at) * kept, (new_gradient - gradient) * kept))
        pairs = pairs[-HISTORY:]
        fallen = np.where(low_enough, loss - new_loss, 0.0)
        at = np.where(low_enough, tried, at)
        gradient = np.where(low_enough, new_gradient, gradient)
        loss = np.where(low_enough, new_loss, loss)
        if (fallen <= tolerance * np.maximum(np.abs(loss), 1e-6)).all():
            break
    return at, loss, np.abs(gradient).max(axis=0), step


def fit_all(packed: Packed, fits: Sequence[Fit], most_steps: int = MOST_STEPS, tolerance: float = TOLERANCE) -> Fitted:
    """Every model of ``fits``, as many at once as the driver has room for."""
    moments = _moments(packed)
    room = max(1, DRIVER_BYTES // (8 * (packed.n_features + 2) * (2 * HISTORY + 12)))
    columns, intercepts, losses, slopes, steps = [], [], [], [], 0
    for low in range(0, len(fits), room):
        problem = _Problem(packed, fits[low : low + room], moments)
        at, loss, slope, taken = _minimise(problem, most_steps, tolerance)
        made = problem.plain(at)
        columns.append(made[:-1])
        intercepts.append(made[-1])
        losses.append(loss)
        slopes.append(slope)
        steps += taken
    return Fitted(
        list(fits), np.concatenate(columns, axis=1), np.concatenate(intercepts), np.concatenate(losses), np.concatenate(slopes), steps
    )


def held_out_scores(packed: Packed, fitted: Fitted) -> DataFrame:
    """``fit, score, label``: the margin of each row under each model that left its fold out; written."""
    context = packed.spark.sparkContext
    label = np.array([packed.labels.index(f.label) for f in fitted.fits])
    without = np.array([-1 if f.without is None else f.without for f in fitted.fits])
    shared = context.broadcast((np.asfortranarray(fitted.coefficients), fitted.intercepts, label, without))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercepts, label, without = shared.value
        for batch in batches:
            for block in batch.column("block"):
                rows = _Rows(block.as_py())
                margin = rows.times(weights) + intercepts
                row, fit = np.nonzero(rows.fold[:, None] == without)
                yield pa.record_batch(
                    [pa.array(fit.astype(np.int32)), pa.array(margin[row, fit]), pa.array(rows.labels[row, label[fit]])],
                    ["fit", "score", "label"],
                )

    scored = packed.blocks.select("block").mapInArrow(score, "fit int, score double, label double")
    path = scratch_path(packed.spark, "validation_scores")
    scored.write.parquet(path)
    return packed.spark.read.schema(scored.schema).parquet(path)


def cross_validate_all(
    vectors: DataFrame,
    labels: Mapping[str, str],
    reg_params: Sequence[float],
    folds: int,
    fold: str = "fold",
    most_steps: int = MOST_STEPS,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, Fitted]:
    """The area of each target, penalty and fold, ``model, reg_param, fold, n_pos, n_neg, auc``, and the fits.

    ``labels`` names each target's label column. The models with a fold left out come first,
    then one over all rows for each target and penalty.
    """
    packed = pack(vectors, list(labels.values()), fold)
    plan = [(name, Fit(label, float(reg), part)) for name, label in labels.items() for reg in reg_params for part in range(folds)]
    whole = [(name, Fit(label, float(reg))) for name, label in labels.items() for reg in reg_params]
    fitted = fit_all(packed, [fit for _, fit in plan + whole], most_steps, tolerance)
    spark = vectors.sparkSession
    named = [(i, name, fit.reg_param, fit.without) for i, (name, fit) in enumerate(plan)]
    names = spark.createDataFrame(named, "fit int, model string, reg_param double, fold int")
    found = areas(held_out_scores(packed, fitted), "fit", "score", "label")
    return names.join(found, "fit", "left").drop("fit"), fitted
