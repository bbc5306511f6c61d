"""Many models at once against Spark's own cross-validation, and the optimum by its gradient."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from opinara.operators import many_models
from opinara.operators.evaluate import areas, auc
from opinara.operators.many_models import Fit

FOLDS = 3
GRID = (0.05, 1.0)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    x = (rng.random((420, 25)) < rng.random(25) * 0.5).astype(float)
    x[:, 7] = 0.0
    x[:, 8] *= 3.5
    w = rng.normal(size=25)
    pos = (rng.random(420) < 1 / (1 + np.exp(-(x @ w)))).astype(int)
    neg = (rng.random(420) < 1 / (1 + np.exp(x @ w + 1))).astype(int)
    return x, np.stack([pos, neg], axis=1), rng.integers(0, FOLDS, 420)


@pytest.fixture(scope="module")
def vectors(spark, rows):
    x, y, fold = rows
    held = [
        (Vectors.dense(a) if i % 9 == 0 else Vectors.sparse(25, [(j, v) for j, v in enumerate(a) if v]), int(b[0]), int(b[1]), int(f))
        for i, (a, b, f) in enumerate(zip(x, y, fold, strict=True))
    ]
    return spark.createDataFrame(held, ["features", "poslabel", "neglabel", "fold"])


@pytest.mark.parametrize("label", ["poslabel", "neglabel"])
def test_mean_areas_are_those_of_the_cross_validator(vectors, label):
    classifier = LogisticRegression(labelCol=label, maxIter=500, tol=1e-13)
    validator = CrossValidator(
        estimator=classifier,
        estimatorParamMaps=ParamGridBuilder().addGrid(classifier.regParam, list(GRID)).build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0),
        numFolds=FOLDS,
        foldCol="fold",
    )
    wanted = validator.fit(vectors).avgMetrics
    found, _ = many_models.cross_validate_all(vectors, {"m": label}, GRID, FOLDS, tolerance=1e-13)
    by_reg = {}
    for r in found.collect():
        by_reg.setdefault(r.reg_param, []).append(r.auc)
    assert np.allclose([np.mean(by_reg[g]) for g in GRID], wanted, atol=1e-6)


def test_coefficients_are_those_of_spark(vectors):
    packed = many_models.pack(vectors, ["poslabel", "neglabel"], "fold")
    fits = [Fit("poslabel", 1.0), Fit("neglabel", 0.05), Fit("poslabel", 0.05, 1)]
    fitted = many_models.fit_all(packed, fits, tolerance=1e-13)
    for i, fit in enumerate(fits):
        seen = vectors if fit.without is None else vectors.where(f"fold <> {fit.without}")
        model = LogisticRegression(labelCol=fit.label, regParam=fit.reg_param, maxIter=500, tol=1e-13).fit(seen)
        assert np.allclose(fitted.coefficients[:, i], model.coefficients.toArray(), atol=1e-5)
        assert abs(fitted.intercepts[i] - model.intercept) < 1e-5


def test_the_gradient_vanishes_at_the_optimum(rows, vectors):
    x, y, fold = rows
    packed = many_models.pack(vectors, ["poslabel", "neglabel"], "fold")
    fits = [Fit("poslabel", 0.05, 0), Fit("neglabel", 1.0)]
    fitted = many_models.fit_all(packed, fits, tolerance=1e-13)
    for i, fit in enumerate(fits):
        used = fold != (-1 if fit.without is None else fit.without)
        own, label = x[used], y[used, ["poslabel", "neglabel"].index(fit.label)]
        w, b = fitted.coefficients[:, i], fitted.intercepts[i]
        deviation = own.std(axis=0, ddof=1)
        rest = 1 / (1 + np.exp(-(own @ w + b))) - label
        gradient = own.T @ rest / len(own) + fit.reg_param * w * deviation**2
        assert np.abs(gradient).max() < 1e-5 and abs(rest.mean()) < 1e-6
        assert fitted.gradient[i] < 1e-4


def test_the_tree_gives_the_same_sums(vectors, monkeypatch):
    packed = many_models.pack(vectors.repartition(5), ["poslabel", "neglabel"], "fold")
    fits = [Fit("poslabel", 1.0), Fit("neglabel", 1.0, 2)]
    direct = many_models.fit_all(packed, fits)
    monkeypatch.setattr(many_models, "DIRECT_BYTES", 0)
    monkeypatch.setattr(many_models, "PIECE", 7)
    monkeypatch.setattr(many_models, "FAN_IN", 2)
    tree = many_models.fit_all(packed, fits)
    assert np.allclose(direct.coefficients, tree.coefficients, atol=1e-9)


def test_jobs_grow_with_steps_alone(spark, vectors):
    def jobs(fits):
        packed = many_models.pack(vectors, ["poslabel", "neglabel"], "fold")
        spark.sparkContext.setJobGroup(f"fits-{len(fits)}", "fits")
        fitted = many_models.fit_all(packed, fits, most_steps=4, tolerance=0.0)
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"fits-{len(fits)}")
        spark.sparkContext.setJobGroup("after", "after")
        return len(ids), fitted.steps

    few = jobs([Fit("poslabel", 1.0)])
    many = jobs([Fit(label, reg, f) for label in ("poslabel", "neglabel") for reg in GRID for f in range(FOLDS)])
    assert few[1] == many[1] == 4 and many[0] <= few[0] + 8


def test_a_step_sends_the_driver_one_matrix(vectors, monkeypatch):
    """However many lengths a step tries, and not one matrix for each task."""
    sent, added = [], many_models._tree_sum

    def watched(packed, of_block, height, width):
        sent.append(height)
        return added(packed, of_block, height, width)

    packed = many_models.pack(vectors, ["poslabel", "neglabel"], "fold")
    fits = [Fit(label, reg, f) for label in ("poslabel", "neglabel") for reg in GRID for f in range(FOLDS)]
    monkeypatch.setattr(many_models, "_tree_sum", watched)
    fitted = many_models.fit_all(packed, fits, most_steps=20, tolerance=0.0)
    full = [height for height in sent if height > packed.n_features]
    # One of them for the moments, one for the start.
    assert len(full) == fitted.steps + 2


def test_blocks_are_written_and_read_a_few_at_a_time(spark):
    """One part of four million values: no row group, and nothing a worker gets at once, holds all of it."""
    value = F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: (F.xxhash64("id", i) % 1000003).cast("double"))
    held = spark.range(0, 2000, 1, 1).select(array_to_vector(value).alias("features"), (F.col("id") % 2).alias("y"), F.lit(0).alias("fold"))
    packed = many_models.pack(held, ["y"], "fold")

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    got = packed.blocks.select("block").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) > 25 and max(r.size for r in got) < 20 << 20
    files = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in packed.blocks.inputFiles()]
    groups = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert sum(groups) > 30 << 20 and max(groups) < 10 << 20


def test_blocks_hold_the_rows_as_they_are(spark, rows, vectors, monkeypatch):
    monkeypatch.setattr(many_models, "BLOCK_ENTRIES", 64)
    x, y, fold = rows
    packed = many_models.pack(vectors, ["poslabel", "neglabel"], "fold")
    seen = []
    for r in packed.blocks.collect():
        block = many_models._Rows(r.block)
        products = block.times(np.eye(25))
        back = np.zeros((25, len(products)))
        block.add_transposed(back, np.eye(len(products)))
        assert np.array_equal(back.T, products)
        seen += [(*a, *b, f) for a, b, f in zip(products, block.labels, block.fold, strict=True)]
    assert packed.n_features == 25
    assert sorted(seen) == sorted((*a, *b, f) for a, b, f in zip(x, y.astype(float), fold, strict=True))


def test_small_files_do_not_make_more_sums_than_cores(spark, vectors):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        packed = many_models.pack(vectors.repartition(40), ["poslabel", "neglabel"], "fold")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert packed.parts == packed.blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_areas_by_key_equal_each_area_alone(spark):
    rng = np.random.default_rng(2)
    held = [(int(k), float(rng.integers(0, 12)), float(rng.integers(0, 2))) for k in rng.choice(4, 900, p=[0.7, 0.1, 0.1, 0.1])]
    held += [(7, 1.0, 1.0), (7, 2.0, 1.0), (8, None, 1.0), (9, float("nan"), 0.0), (9, 1.0, 1.0)]
    df = spark.createDataFrame(held, "k int, s double, y double")
    found = {r.k: (r.n_pos, r.n_neg, r.auc) for r in areas(df, "k", "s", "y", ranges=5).collect()}
    for k in (0, 1, 2, 3, 7, 9):
        row = auc(df.where(f"k = {k}"), "s", "y").first()
        assert found[k][:2] == (row.n_pos, row.n_neg)
        assert found[k][2] == row.auc or abs(found[k][2] - row.auc) < 1e-12
    assert 8 not in found


def test_rows_of_one_class_and_an_empty_fold_have_no_area(spark):
    held = [(Vectors.sparse(2, {i % 2: 1.0}), 1, 0) for i in range(10)]
    one = spark.createDataFrame(held, ["features", "y", "fold"])
    found, _ = many_models.cross_validate_all(one, {"m": "y"}, (1.0,), 2)
    assert sorted((r.fold, r.auc) for r in found.collect()) == [(0, None), (1, None)]
