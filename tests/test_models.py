"""The whole way from raw rows to a saved model, on both entry paths."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sievework.operators import features, inspection, quality, scaling, training
from sievework.plans import modelling, prepare
from sievework.plans.bookings_view import bookings
from sievework.sources import load_model, save_model, write_csv
from sievework.specs import BOOKING


@pytest.fixture(scope="module")
def small(spark):
    return {
        "Tree": DecisionTreeClassifier(maxDepth=3, seed=1),
        "Regression": LogisticRegression(maxIter=3),
    }


@pytest.fixture(scope="module")
def catalog(spark, sf_dir, tmp_path_factory):
    database = "prepared"
    spark.sql(f"CREATE DATABASE {database}")
    bookings(spark, sf_dir).write.saveAsTable(f"{database}.raw")
    work = str(tmp_path_factory.mktemp("work"))
    return prepare.prepare_catalog(spark, f"{database}.raw", BOOKING, database, work)


def test_catalog_tables(spark, catalog):
    counts = {r["table"]: r["rows"] for r in catalog.reports["table_counts"].collect()}
    train, test = counts["prepared.train_normalized"], counts["prepared.test_normalized"]
    assert train + test == counts["prepared.clean"]
    assert counts["prepared.clean"] + counts["prepared.rejected"] == 1500
    names = {r["tableName"] for r in catalog.reports["tables"].collect()}
    assert {"raw", "clean", "rejected", "train_normalized", "test_normalized"} <= names


def test_the_clean_table_is_scanned_twice_for_both_sides(spark, sf_dir, tmp_path, statements):
    """Once for the scaling statistics and once for the rows; the views read their own part."""
    spark.sql("CREATE DATABASE passes")
    bookings(spark, sf_dir).write.saveAsTable("passes.raw")
    spark.sql("CREATE TABLE passes.test_normalized (x INT) USING parquet")  # what a former run may have left
    seen = statements()
    found = prepare.prepare_catalog(spark, "passes.raw", BOOKING, "passes", str(tmp_path))
    assert len(seen.scans_of("passes.clean")) == 2
    split = spark.table("passes.normalized")
    for name, side in (("train_normalized", "train"), ("test_normalized", "test")):
        view = spark.table(f"passes.{name}")
        assert "split" not in view.columns and view.columns[0] == "booking_id"
        assert sorted(view.collect()) == sorted(split.where(F.col("split") == side).drop("split").collect())
        assert "PartitionFilters: [isnotnull(split" in view._jdf.queryExecution().executedPlan().toString()
    prepare.prepare_catalog(spark, "passes.raw", BOOKING, "passes", str(tmp_path))
    assert found.train.count() + found.test.count() == spark.table("passes.clean").count()


def test_one_write_gives_the_same_sides(spark, sf_dir, tmp_path):
    clean = quality.clean_and_rejected(bookings(spark, sf_dir), BOOKING)[0]
    table = features.feature_table(clean, BOOKING)
    for keep in (True, False):
        lazy = scaling.train_test_tables(table, BOOKING, keep)
        stored = scaling.write_split(table, BOOKING, str(tmp_path / "split"), keep_key=keep)
        for a, b in zip(lazy, stored):
            assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_compare_save_and_describe(spark, catalog, small, tmp_path):
    path = str(tmp_path / "model")
    chosen = modelling.compare_models(
        catalog.train, catalog.test, BOOKING, small, partitions=4, model_path=path
    )
    rows = chosen.comparison.collect()
    assert [r["model"] for r in rows][0] == chosen.best.name
    assert all(0 <= r["accuracy"] <= 1 and 0 <= r["roc_auc"] <= 1 for r in rows)
    sizes = {r["split"]: r for r in chosen.reports["input_sizes"].collect()}
    assert sizes["train"]["features"] == 37 and sizes["train"]["partitions"] == 4
    assert sizes["train"]["rows"] == catalog.train.count()
    matrix = chosen.reports["confusion_matrix/Tree"].collect()
    assert sum(r["count"] for r in matrix) == sizes["test"]["rows"]
    importance = chosen.reports["feature_importance/Tree"].collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1)

    for trained in chosen.models:
        target = str(tmp_path / trained.name)
        save_model(trained.model, target)
        assert type(load_model(spark, target)) is type(trained.model)
    columns = modelling.model_columns(catalog.train, BOOKING)
    nodes = modelling.describe_saved_model(spark, str(tmp_path / "Tree"), columns)
    tree = chosen.models[0].model
    assert nodes.count() == tree.numNodes
    assert nodes.where("feature is null").count() == (tree.numNodes + 1) // 2
    weights = modelling.describe_saved_model(spark, str(tmp_path / "Regression"), columns)
    assert weights.count() == 38


def test_ensembles_reload(spark, tmp_path):
    rows = [(float(i % 2), float(i)) for i in range(40)]
    df = training.assemble(spark.createDataFrame(rows, "y double, x double"), ["x"], "y")
    for name, estimator in training.four_models().items():
        if name in ("Random Forest", "Gradient Boosted Tree"):
            model = estimator.fit(df)
            path = str(tmp_path / name)
            save_model(model, path)
            assert type(load_model(spark, path)) is type(model)
            nodes = inspection.tree_nodes(spark, path)
            assert nodes.select("tree").distinct().count() == 15
    save_model(estimator.fit(df), path)
    assert load_model(spark, path).numFeatures == 1


@pytest.fixture(scope="module")
def line(spark):
    rows = [(float(i % 2), float(i)) for i in range(200)]
    return training.assemble(spark.createDataFrame(rows, "y double, x double"), ["x"], "y")


def test_every_model_scores_in_a_session_with_an_observation(spark, line, tmp_path):
    """Scoring ships no training summary, whatever the session holds by then."""
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 5}
    results = training.train_models(training.four_models() | training.two_models(), line, line)
    assert len(results) == 4 and all(sum(c[2] for c in r.cells) == 200 for r in results)
    forest = results[1].model
    assert forest.hasSummary and not training.scoring_handle(forest).hasSummary


def test_a_forest_scores_after_a_csv_was_written(spark, line, tmp_path):
    assert write_csv(spark.range(10), str(tmp_path / "csv")) == 10
    forest = training.four_models()["Random Forest"].fit(line)
    assert len(training.score_rows(forest, line).collect()) == 200


def test_models_fitted_side_by_side_are_the_same(spark, line):
    """On a fixed partitioning, in the order of the estimators, with the caller's job properties left alone."""
    estimators = training.four_models()
    rows = line.coalesce(2).cache()
    serial = training.train_models(estimators, rows, rows)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "mine")
    together = training.train_models(estimators, rows, rows, at_once=4)
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "mine"
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    assert [r.name for r in together] == list(estimators)
    for one, other in zip(serial, together):
        assert one.rounded()[:-1] == other.rounded()[:-1] and sorted(one.cells) == sorted(other.cells)
        assert other.training_seconds > 0
    assert together[0].model.toDebugString.split("\n")[1:] == serial[0].model.toDebugString.split("\n")[1:]
    rows.unpersist()


def test_a_failing_fit_is_raised(spark, line):
    bad = {"Good": DecisionTreeClassifier(maxDepth=2), "Bad": LogisticRegression(featuresCol="missing")}
    with pytest.raises(Exception, match="missing"):
        training.train_models(bad, line, line, at_once=2)


def trained(name, auc):
    return training.Trained(name, None, auc, 0, 0, 0, 0, 0, 0)


def test_ties():
    assert training.best_model([trained("b", 0.5), trained("a", 0.5)]).name == "a"
    assert training.best_model([trained("a", 0.50001), trained("b", 0.50002)]).name == "b"
    assert training.better_of_two(trained("x", 0.5), trained("a", 0.5)).name == "x"
    assert training.better_of_two(trained("x", 0.5), trained("a", 0.6)).name == "a"


def test_invalid_features(spark):
    df = spark.createDataFrame([(1.0, 0), (float("nan"), 1), (None, 1)], "x double, y int")
    assert training.assemble(df, ["x"], "y").count() == 1
    with pytest.raises(Exception, match="[Nn]ull|NaN"):
        training.assemble(df, ["x"], "y", invalid="error").collect()


def test_prepare_file(spark, sf_dir, tmp_path):
    write_csv(bookings(spark, sf_dir), str(tmp_path / "raw"))
    p = prepare.prepare_file(spark, str(tmp_path / "raw"), BOOKING, str(tmp_path / "out"))
    assert p.counts["clean"] + p.counts["rejected"] == 1500
    assert p.counts["train"] + p.counts["test"] == p.counts["clean"]
    assert p.train.columns[0] == "no_of_adults_scaled" and len(p.train.columns) == 38
    assert p.reports["target_correlations"].count() == 12
    assert p.reports["pair_correlations"].count() == 10


def test_fits_have_as_many_partitions_as_their_rows_need(spark):
    """The rows of a task are bounded however many there are; a small table stays as its scan gives it."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("y")).coalesce(1)
    assert training.fit_partitions(rows) is None and training.fit_partitions(rows, 1000) is None
    assert training.fit_partitions(rows.limit(0)) is None
    assert training.fit_partitions(rows, 999) == cores
    n = training.fit_partitions(rows, 10)
    assert n % cores == 0 and n >= 100
    sizes = training.partition_sizes(training.spread(training.assemble(rows, ["x"], "y"), n)).collect()
    assert sum(r["rows"] for r in sizes) == 1000 and max(r["rows"] for r in sizes) <= 20


def test_rows_of_a_fit_are_spread(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_A_TASK", 50)
    rows = spark.range(4000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("y")).coalesce(1)
    held = training.fit_rows(rows, ["x"], "y")
    assert max(r["rows"] for r in training.partition_sizes(held).collect()) <= 60


def test_model_tables_are_stored_once_with_the_same_rows(spark, sf_dir):
    """Fits read plain columns of one write; the rows are those of the lazy tables."""
    from sievework.plans.queries import model_tables, stored_model_tables

    for lazy, stored in zip(model_tables(spark, sf_dir), stored_model_tables(spark, sf_dir)):
        assert stored.columns == lazy.columns and stored.dtypes == lazy.dtypes
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, lazy.collect()))
        assert "ScalarSubquery" not in stored._jdf.queryExecution().optimizedPlan().toString()
