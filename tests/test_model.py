"""The model on a planted signal."""

import datetime as dt

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.operators import features, strength_model, vocabulary
from casewright.plans import registry
from casewright.session import cut_lineage, scratch_path
from casewright.sources import sinks, tables

AS_OF = dt.date(2001, 8, 1)
GRID = {"bootstrap": (True,), "num_trees": (5,), "max_depth": (4,), "feature_fraction": ("0.6",),
        "class_weight": ("balanced", None)}


@pytest.fixture(scope="module")
def planted(spark):
    """Arrest when both flags are set; a number that says nothing; one flag that is never set."""
    return spark.range(900).selectExpr(
        "concat('s', cast(id as string)) as suspect_id", "concat('c', cast(id as string)) as cif_number",
        "date_sub(date'2001-08-01', cast(id % 400 as int)) as interview_date",
        "id % 2 = 0 as flag_a", "id % 3 = 0 as flag_b", "false as never", "cast(id % 11 as double) as noise",
        "case when id % 6 = 0 then 1 else 0 end as arrest", "'x' as name", "id % 6 = 0 as arrested")


def test_training_rows(planted):
    rows = strength_model.training_rows(planted, AS_OF, 90)
    assert rows.filter("days <= 90 and arrest = 0").count() == 0
    assert rows.filter("arrest = 1").count() == 150


def test_parts_are_stable_and_sized(planted):
    parts = strength_model.with_part(planted)
    again = strength_model.with_part(planted.repartition(5))
    assert parts.select("suspect_id", "part").exceptAll(again.select("suspect_id", "part")).count() == 0
    shares = {r.part: r["count"] / 900 for r in parts.groupBy("part").count().collect()}
    assert abs(shares["test"] - .2) < .05 and abs(shares["validation"] - .1) < .04


def test_identity_and_label_columns_are_no_features(planted):
    assert strength_model.feature_columns(planted) == ["flag_a", "flag_b", "never", "noise"]


def test_train_save_load_predict(spark, planted):
    path = scratch_path(spark, "model")
    model = strength_model.train_or_load(spark, planted, path, True, AS_OF, 90, grid=GRID, folds=2, parallelism=2)
    assert model.columns == ["flag_a", "flag_b", "noise"]
    majority = 1 - 150 / strength_model.training_rows(planted, AS_OF, 90).count()
    assert model.metrics["test_accuracy"] > majority
    loaded = strength_model.train_or_load(spark, planted, path, False, AS_OF, 90)
    assert strength_model.load_columns(spark, path) == model.columns
    ours = strength_model.predict(planted, model).select("suspect_id", "soc")
    theirs = strength_model.predict(planted, loaded).select("suspect_id", "soc")
    assert ours.count() == 900 and ours.exceptAll(theirs).count() == 0
    means = {r.arrest: r.m for r in strength_model.predict(planted, model).groupBy("arrest").agg(F.avg("soc").alias("m")).collect()}
    assert means[1] > means[0] + .3
    fewer = strength_model.predict(planted.drop("flag_a").withColumn("unknown", F.lit(True)), model)
    assert fewer.count() == 900


def test_forests_are_saved_tree_by_tree(spark, planted, monkeypatch):
    """Never the nodes of all trees at once on the driver; what is read back is the same forest, parameters and all."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassificationModel
    path = scratch_path(spark, "model")
    model = strength_model.train(planted, AS_OF, 90, grid=GRID, folds=2)
    forest = model.pipeline.stages[-1]
    with monkeypatch.context() as m:
        m.setattr(RandomForestClassificationModel, "write", lambda self: pytest.fail("the whole forest was written at once"))
        manifest = strength_model.save(spark, model, path)
    folder = f"{path}/{manifest.tables['model'][0]}"
    assert not any("RandomForest" in s.uid for s in PipelineModel.load(f"{folder}/pipeline").stages)
    loaded = strength_model.load(spark, path).pipeline.stages[-1]
    assert [t.toDebugString.split("\n", 1)[1] for t in loaded.trees] == [t.toDebugString.split("\n", 1)[1] for t in forest.trees]
    assert loaded.featureImportances == forest.featureImportances
    assert {p.name: loaded.getOrDefault(p) for p in loaded.params if loaded.isSet(p)} == {
        p.name: forest.getOrDefault(p) for p in forest.params if forest.isSet(p)}


def test_models_of_other_classifiers_and_of_older_layout_load(spark, planted):
    from pyspark.ml.classification import LogisticRegression
    path = scratch_path(spark, "model")
    rows = strength_model.with_part(planted)
    plain = strength_model.classifier_pipeline(rows, ["flag_a", "flag_b"], LogisticRegression(labelCol="arrest", maxIter=3)).fit(rows)
    strength_model.save(spark, strength_model.StrengthModel(plain, ["flag_a", "flag_b"], {}), path)
    scored = strength_model.predict(planted, strength_model.load(spark, path))
    assert scored.filter("soc between 0 and 1").count() == 900


def test_searches_go_by_rows_cores_and_heap(planted, monkeypatch):
    """Few rows are not dealt to many tasks, and the cores left over grow further forests if the driver has room for them."""
    gb = 1 << 30
    assert strength_model.search_tasks(250_000, 1_850_000, 6, 3 * gb) == (2, 3)
    assert strength_model.search_tasks(250_000, 1_850_000, 6, 3 * gb // 4) == (2, 1)
    assert strength_model.search_tasks(2_500_000, 18_500_000, 12, 30 * gb) == (13, 1)
    assert strength_model.search_tasks(0, 0, 8, gb) == (1, 8)
    seen, fit = [], strength_model.CrossValidator.fit
    monkeypatch.setattr(strength_model.CrossValidator, "fit", lambda self, vectors: (
        seen.append((vectors.rdd.getNumPartitions(), self.getParallelism() > 1)), fit(self, vectors))[1])
    rows = planted.repartition(5)
    strength_model.grid_search(rows, ["flag_a", "flag_b"], GRID, 2)
    monkeypatch.setattr(strength_model, "TASK_ROWS", 300)
    strength_model.grid_search(rows, ["flag_a", "flag_b"], GRID, 2, parallelism=1)
    assert seen == [(1, True), (3, False)]


def test_one_class_is_refused(planted):
    with pytest.raises(ValueError):
        strength_model.with_balanced_weight(planted.filter("arrest = 0"))


def test_grids():
    from pyspark.ml.classification import RandomForestClassifier
    forest = RandomForestClassifier()
    assert len(strength_model.search_grid(forest, fv.GRID_V3)) == 32
    # Depths 30, 40, 50 and none are one; so are the two balanced weights.
    assert len(strength_model.search_grid(forest, fv.GRID_V2)) == 2 * 2 * 4 * 5 * 2


def test_forests_keep_node_ids_and_grow_one_at_a_time(planted, monkeypatch):
    """Trees are not sent to every task in every pass, and the driver holds one growing forest."""
    seen = []

    class Search(strength_model.CrossValidator):
        def fit(self, rows):
            seen.append((self.getParallelism(), self.getEstimator().getCacheNodeIds()))
            raise StopIteration

    monkeypatch.setattr(strength_model, "CrossValidator", Search)
    rows = strength_model.training_rows(planted, AS_OF, 90)
    columns = strength_model.feature_columns(rows)
    with pytest.raises(StopIteration):
        strength_model.grid_search(rows, columns, GRID, 2)
    assert seen == [(1, True)]
    best, _ = strength_model.one_forest(rows, columns)
    assert best.stages[-1].getCacheNodeIds()


def test_node_ids_change_no_tree(planted):
    columns = strength_model.feature_columns(planted)
    trees = []
    for kept in (False, True):
        grown = strength_model.forest(numTrees=4, maxDepth=8, seed=3).setCacheNodeIds(kept)
        fitted = strength_model.classifier_pipeline(planted, columns, grown).fit(planted).stages[-1]
        trees.append([tree.toDebugString.split("\n", 1)[1] for tree in fitted.trees])
    assert trees[0] == trees[1]


def test_training_reads_written_features(spark, monkeypatch):
    """The feature rows of ``s11`` are made once, not again for every pass over them."""
    trained = []
    real = registry.one_forest
    monkeypatch.setattr(registry, "one_forest", lambda b, rows: trained.append(rows) or real(b, rows))
    registry.QUERIES["s11_training_columns"](spark, "/root/testdata/sf0.001")
    assert all("casewright-" in path for path in trained[0].inputFiles())


def test_empty_features_are_dropped(planted):
    kept = features.drop_empty_features(planted, ("suspect_id",))
    assert "never" not in kept.columns and "flag_a" in kept.columns


def test_any_number_of_categories_reaches_the_model(spark):
    rows = spark.range(5000).selectExpr("concat('job ', id) as pv_occupation", "id % 7 as n", "id % 2 = 0 as flag", "cast(id % 2 as int) as arrest")
    columns = strength_model.feature_columns(rows)
    assert set(columns) == {"pv_occupation", "n", "flag"}
    fitted = Pipeline(stages=strength_model.transformer_stages(rows, columns)).fit(rows)
    vector = fitted.transform(rows).select("features").first().features
    assert len(vector) >= 5002
    unseen = rows.limit(1).withColumn("pv_occupation", F.lit("never seen"))
    assert len(fitted.transform(unseen).select("features").first().features) == len(vector)


def test_one_writer_per_version(spark, monkeypatch):
    path = scratch_path(spark, "table")
    tables.replace(spark, path, spark.range(2))
    monkeypatch.setattr(tables, "latest_version", lambda *_: None)  # another run took the same number
    with pytest.raises(FileExistsError):
        tables.replace(spark, path, spark.range(3))
    monkeypatch.undo()
    assert tables.read(spark, path).count() == 2


def test_tabs_are_published_together(spark):
    root = scratch_path(spark, "published")
    good = spark.createDataFrame([("K1", "a")], "case_id string, name string")
    sinks.publish(spark, root, {"one": (good, ("case_id",)), "two": (good, ("name",))})
    broken = good.withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):  # noqa: B017
        sinks.publish(spark, root, {"one": (good.limit(0), ("case_id",)), "two": (broken, ("name",))})
    assert sinks.published(spark, root, "one").count() == 1 and sinks.published(spark, root, "two").count() == 1


def test_models_have_generations(spark, planted, monkeypatch):
    path = scratch_path(spark, "model")
    first = strength_model.train_or_load(spark, planted, path, True, AS_OF, 90, grid=None)
    # A save that is ended before its manifest leaves the model in force.
    monkeypatch.setattr(strength_model.generations, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    other = strength_model.StrengthModel(first.pipeline, first.columns, {"test_accuracy": -1.0}, first.kinds)
    with pytest.raises(OSError):
        strength_model.save(spark, other, path)
    assert strength_model.load(spark, path).metrics == first.metrics
    monkeypatch.undo()
    strength_model.save(spark, other, path)
    assert strength_model.load(spark, path).metrics["test_accuracy"] == -1.0
    assert strength_model.load(spark, path, 1).metrics == first.metrics
    assert first.kinds == {"flag_a": "flag", "flag_b": "flag", "noise": "number"}
    with pytest.raises(strength_model.ForeignRows, match="flag_a"):
        strength_model.predict(planted.withColumn("flag_a", F.col("flag_a").cast("string")), strength_model.load(spark, path))
    with pytest.raises(FileNotFoundError):
        strength_model.load(spark, path + "-none")


JOBS = "id long, pv_occupation string, education string"


def listed(vocabulary_rows):
    return {(r.feature, r.value): (r.id, r.first_seen) for r in vocabulary_rows.collect()}


def test_vocabulary_keeps_its_ids(spark):
    first = vocabulary.extended(None, spark.createDataFrame([(1, "cook", None), (2, "cook", ""), (3, "a", "b")], JOBS),
                                ["pv_occupation", "education"], AS_OF)
    assert {i for i, _ in listed(first).values()} == {1, 2, 3, 4, 5}
    later = spark.createDataFrame([(9, "baker", None), (10, None, ""), (11, "cook", "b"), (11, "cook", "b")], JOBS)
    first = cut_lineage(spark, "vocabulary", first)
    second = vocabulary.extended(first, later, ["pv_occupation", "education"], AS_OF + dt.timedelta(days=1))
    both = listed(second)
    assert {k: both[k] for k in listed(first)} == listed(first)
    assert {k: v[1] for k, v in both.items() if k not in listed(first)} == dict.fromkeys(
        [("pv_occupation", "baker"), ("pv_occupation", None)], AS_OF + dt.timedelta(days=1))
    assert sorted(i for i, _ in both.values()) == list(range(1, 8))
    for nothing in (later, later.limit(0)):
        assert listed(vocabulary.extended(second, nothing, ["pv_occupation"], AS_OF)) == both
    assert vocabulary.extended(None, later.limit(0), ["education"], AS_OF).count() == 0
    got = {tuple(r) for r in vocabulary.encoded(later.unionByName(
        spark.createDataFrame([(12, "new", "b")], JOBS)), ["pv_occupation", "education"], second).collect()}
    assert got == {(9, both["pv_occupation", "baker"][0], both["education", None][0]),
                   (10, both["pv_occupation", None][0], both["education", ""][0]),
                   (11, both["pv_occupation", "cook"][0], both["education", "b"][0]),
                   (12, None, both["education", "b"][0])}


def test_encoding_collects_nothing_and_joins_by_hash(spark):
    rows = spark.createDataFrame([(1, "cook", None)], JOBS)
    known = cut_lineage(spark, "vocabulary", vocabulary.extended(None, rows, ["pv_occupation"], AS_OF))
    plan = vocabulary.encoded(rows, ["pv_occupation"], known)._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan or "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_retrained_model_keeps_positions(spark):
    def fitted(rows, known):
        pipeline = Pipeline(stages=strength_model.transformer_stages(rows, ["flag", "n", "pv_occupation"], known))
        return {r.pv_occupation: r.features.toArray() for r in pipeline.fit(rows).transform(rows).collect()}

    rows = spark.createDataFrame([(True, 1.0, "m"), (False, 2.0, "z"), (True, 4.0, None)], "flag boolean, n double, pv_occupation string")
    known = cut_lineage(spark, "vocabulary", vocabulary.extended(None, rows, ["pv_occupation"], AS_OF))
    # New values sort before, between and after the old ones.
    more = rows.unionByName(spark.createDataFrame([(True, 0.0, v) for v in ("a", "n", "zz")], rows.schema))
    longer = cut_lineage(spark, "vocabulary", vocabulary.extended(known, more, ["pv_occupation"], AS_OF))
    before, after = fitted(rows, known), fitted(more, longer)
    for value, vector in before.items():
        assert (vector[2:] == after[value][2:len(vector)]).all() and vector[2:].sum() == 1 and after[value][2:].sum() == 1
    unknown = fitted(more, known)
    assert all(unknown[v][2:].sum() == 0 for v in ("a", "n", "zz"))
    with pytest.raises(ValueError, match="without gaps"):
        vocabulary.tokens(longer.filter("id <> 2"))


def test_model_with_a_vocabulary_is_saved(spark, planted):
    rows = planted.withColumn("pv_occupation", F.when(F.col("flag_a"), "broker").otherwise("cook"))
    known = cut_lineage(spark, "vocabulary", vocabulary.extended(None, rows, ["pv_occupation"], AS_OF))
    path = scratch_path(spark, "model")
    model = strength_model.train_or_load(spark, rows, path, True, AS_OF, 90, grid=GRID, folds=2, known=known)
    assert "pv_occupation" in model.columns
    loaded = strength_model.predict(rows, strength_model.load(spark, path))
    assert loaded.columns == [*rows.columns, "soc"] and loaded.count() == 900
    means = {r.arrest: r.m for r in loaded.groupBy("arrest").agg(F.avg("soc").alias("m")).collect()}
    assert means[1] > means[0] + .3
