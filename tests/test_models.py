import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from opinara.operators import evaluate, models
from opinara.operators.features import fit_vocabulary
from opinara.plans import catalog, flows
from opinara.sources import load_model, save_model


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts whose words tell the label, and a hundred without a number as label."""
    ids = spark.range(0, 400, 1, 4)
    kind = F.col("id") % 4
    body = F.concat(
        F.when(kind == 0, "good fine day ").when(kind == 1, "bad awful night ").otherwise("so so "),
        F.concat(F.lit("w"), F.col("id") % 17),
    )
    label = F.when(kind == 0, "1").when(kind == 1, "-1").when(kind == 2, "0").otherwise("n/a")
    id = F.col("id").cast("string")
    comments = ids.select(id.alias("id"), body.alias("body"))
    labels = ids.select(id.alias("iid"), label.alias("Trump"))
    return flows.labelled_words(comments, labels)


@pytest.fixture(scope="module")
def trained(labelled):
    return flows.train_models(labelled, folds=2)


def weights(model):
    vectoriser, classifier = model.stages
    by_term = dict(zip(vectoriser.vocabulary, classifier.coefficients.toArray(), strict=True))
    return by_term | {None: classifier.intercept}


def test_labelled_words(labelled):
    counts = labelled.agg(
        F.count("*"), F.sum("poslabel"), F.sum("neglabel"), F.count("label")
    ).first()
    assert tuple(counts) == (400, 100, 100, 300)


def test_split_is_disjoint_and_stable(labelled):
    one, two = models.hash_split(labelled, "id")
    first = {r.id for r in one.collect()}
    second = {r.id for r in two.collect()}
    assert not first & second and len(first | second) == 400
    assert 150 < len(first) < 250
    assert first == {r.id for r in models.hash_split(labelled.repartition(9), "id")[0].collect()}
    third, _ = models.hash_split(labelled, "id", fraction=0.1, seed=5)
    assert 15 < third.count() < 70


def test_prediction_is_probability_above_threshold(trained):
    fitted, held_out = trained
    scored = models.with_probability(models.score(held_out, fitted), fitted)
    rows = scored.collect()
    assert rows
    for row in rows:
        assert row.pos == float(row.pos_probability > models.POSITIVE.threshold)
        assert row.neg == float(row.neg_probability > models.NEGATIVE.threshold)


def test_models_share_the_vocabulary_and_the_vectors(trained):
    fitted, held_out = trained
    scored = models.score(held_out, fitted).select("pos", "neg")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    vocabularies = {tuple(m.stages[0].vocabulary) for m in fitted.values()}
    assert len(vocabularies) == 1
    assert "_features_0" in plan and "_features_1" not in plan


def test_models_tell_the_classes_apart(trained):
    fitted, held_out = trained
    scored = models.with_probability(models.score(held_out, fitted), fitted)
    for name, target in models.TARGETS.items():
        assert evaluate.auc(scored, f"{name}_probability", target.label).first().auc > 0.99


def test_training_is_reproducible(labelled, trained):
    again, _ = flows.train_models(labelled.repartition(3), folds=2)
    for name, model in trained[0].items():
        before, after = weights(model), weights(again[name])
        assert before.keys() == after.keys()
        assert [after[t] for t in before] == pytest.approx(list(before.values()), abs=1e-9)


def test_grid_prefers_less_regularisation(labelled):
    vectoriser = fit_vocabulary(labelled)
    vectors = vectoriser.transform(labelled)
    found = models.cross_validate(vectors, models.NEGATIVE, (0.1, 1.0), folds=3)
    assert len(found.avgMetrics) == 2
    assert all(0.5 < area <= 1.0 for area in found.avgMetrics)
    assert found.bestModel.getLabelCol() == "neglabel"
    assert found.bestModel.getThreshold() == 0.25


def test_saved_model_scores_the_same(trained, tmp_path):
    fitted, held_out = trained
    path = str(tmp_path / "model")
    save_model(fitted["pos"], path)
    with pytest.raises(Exception, match="already exists"):
        save_model(fitted["pos"], path)
    save_model(fitted["pos"], path, overwrite=True)
    both = models.score(held_out, {"a": fitted["pos"], "b": load_model(path)})
    assert both.where("a <> b OR a_probability <> b_probability").count() == 0


@pytest.mark.parametrize("broken", [None, 0, 1])
def test_roundtrip_scores_with_each_loaded_vectoriser(spark, tmp_path, monkeypatch, broken):
    """A model that comes back with another vocabulary is told, whichever of the two it is."""
    ids = spark.range(0, 400, 1, 1).withColumnRenamed("id", "doc_id")
    kind = F.col("doc_id") % 3
    text = F.when(kind == 0, "good fine day").when(kind == 1, "bad awful night").otherwise("so so")
    ids.select("doc_id", text.alias("text"), F.lit("web").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    quality, toxic = (kind == 0).cast("int"), (kind == 1).cast("int")
    ids.select("doc_id", quality.alias("quality"), toxic.alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    loaded = []

    def load(path):
        vectoriser, classifier = load_model(path).stages
        loaded.append(path)
        if len(loaded) - 1 == broken:
            other = CountVectorizerModel.from_vocabulary(vectoriser.vocabulary[::-1], inputCol="words", outputCol="features")
            vectoriser = other._resetUid(vectoriser.uid).setBinary(True)
        return PipelineModel(stages=[vectoriser, classifier])

    monkeypatch.setattr(catalog, "load_model", load)
    same = [r.same for r in catalog.model_roundtrip(spark, str(tmp_path)).collect()]
    assert len(loaded) == 2 and len(same) > 100
    assert all(same) == (broken is None)


def test_saved_cross_validation_keeps_its_metrics(labelled, tmp_path):
    vectors = fit_vocabulary(labelled).transform(labelled)
    found = models.cross_validate(vectors, models.NEGATIVE, (0.1, 1.0), folds=2)
    path = str(tmp_path / "validated")
    save_model(found, path)
    again = load_model(path)
    assert again.avgMetrics == found.avgMetrics
    assert again.bestModel.coefficients == found.bestModel.coefficients


def test_penalties_are_chosen_for_all_targets_at_once(labelled):
    vectors = fit_vocabulary(labelled).transform(labelled)
    chosen = models.choose_reg_params(vectors, models.TARGETS, (0.1, 50.0), folds=2)
    assert set(chosen) == {"pos", "neg"} and set(chosen.values()) <= {0.1, 50.0}
    assert models.choose_reg_params(vectors, models.TARGETS, (1.0,)) == {"pos": 1.0, "neg": 1.0}
    with pytest.raises(ValueError, match="two folds"):
        models.choose_reg_params(vectors, models.TARGETS, (0.1, 1.0), folds=1)


def test_scoring_before_the_join_gives_the_joined_rows(spark, trained):
    fitted, _ = trained
    comments = spark.createDataFrame(
        [
            ("1", "good fine day", "t3_a"), ("2", "bad awful night", "t3_a"),
            ("3", "good &gt; quoted", "t3_a"), ("4", "good /s", "t3_a"),
            ("5", "good", "t3_none"), ("6", None, "t3_a"), ("1", "good fine day", "t3_b"),
        ],
        "id string, body string, link_id string",
    )
    submissions = spark.createDataFrame(
        [("a", "title a", 3), ("b", "title b", 4)], "sub_id string, title string, sub_score long"
    )
    scored = flows.score_comments(comments, submissions, fitted)
    assert scored.columns == ["id", "pos", "neg", "title", "sub_score"]
    rows = sorted((r.id, r.pos, r.neg, r.title) for r in scored.collect())
    assert rows == [
        ("1", 1.0, 0.0, "title a"), ("1", 1.0, 0.0, "title b"), ("2", 0.0, 1.0, "title a"),
    ]


def test_no_text_goes_through_the_join(spark, trained):
    fitted, _ = trained
    rows = [(str(i), f"good day {i}", "t3_a") for i in range(100)]
    comments = spark.createDataFrame(rows, "id string, body string, link_id string")
    submissions = spark.createDataFrame(
        [("a", "title", 1)], "sub_id string, title string, sub_score long"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = flows.score_comments(comments, submissions, fitted)
        plan = joined._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len(below) == 2
    assert not any("body" in line or "_words" in line or "_features" in line.split(" AS ")[-1]
                   for line in below)


def test_rows_without_words_get_no_prediction(spark, trained):
    fitted, _ = trained
    df = spark.createDataFrame([(["good"],), (None,)], "words array<string>")
    rows = models.with_probability(models.score(df, fitted), fitted).collect()
    assert [row.pos is None and row.neg_probability is None for row in rows] == [False, True]
