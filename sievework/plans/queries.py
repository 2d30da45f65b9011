"""Registered queries: every operator on the given tables, as (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import (
    contract,
    correlation,
    curves,
    dedupe,
    evaluation,
    features,
    inspection,
    profile,
    quality,
    ranking,
    reports,
    scaling,
    split,
    stored_trees,
    training,
)
from sievework.plans import modelling
from sievework.plans.bookings_view import bookings, table
from sievework.sources import (
    drop_embedded_header,
    list_tables,
    load_model,
    read_csv,
    read_csv_inferred,
    read_table,
    save_model,
    scratch_dir,
    small_table,
    table_counts,
    write_csv,
    write_table,
    write_tables,
)
from sievework.specs import BOOKING, CUSTOMER, LINEITEM, ORDERS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_NUMBERS = list(LINEITEM.feature_spec.scaled)
LINE_KEY = ["l_orderkey", "l_linenumber"]
PRICE_CUT = 250_000  # the rule-based prediction: dear orders are the positive class


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs -----------------------------------------------------------------------


def typed_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.standardize(bookings(spark, sf_dir), BOOKING)


def flagged_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_rows(bookings(spark, sf_dir), BOOKING)


def clean_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_rows(flagged_bookings(spark, sf_dir), BOOKING)


def booking_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(clean_bookings(spark, sf_dir), BOOKING)


def flagged_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.add_quality_flags(table(spark, sf_dir, "lineitem"), LINEITEM)


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, rule-based prediction and score of every order."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.col("o_totalprice") > PRICE_CUT).cast("double").alias("prediction"),
        F.col("o_totalprice").alias("score"),
    )


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table over the clean rows stored in one pass."""
    clean, _ = quality.write_verdicts(bookings(spark, sf_dir), BOOKING, scratch_dir(spark))
    return features.feature_table(clean, BOOKING)


def model_tables(
    spark: SparkSession, sf_dir: str, digits: int = 6
) -> tuple[DataFrame, DataFrame]:
    """Normalised training and test bookings; the statistics and both sides read the stored
    clean table instead of cleaning three times."""
    features_ = stored_features(spark, sf_dir)
    return scaling.train_test_tables(features_, BOOKING, method="md5", digits=digits)


def stored_model_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`model_tables` from one write: models read them several times, and what they
    read is plain columns instead of all features and their scaling again for each side and model."""
    return scaling.write_split(stored_features(spark, sf_dir), BOOKING, scratch_dir(spark), method="md5")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def date_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- scans, contract, quality ------------------------------------------------------------


@query
def schema_audit(spark, sf_dir):
    return contract.column_audit(table(spark, sf_dir, "customer"), CUSTOMER)


@query
def table_shape(spark, sf_dir):
    return profile.table_shape(table(spark, sf_dir, "lineitem"))


@query
def preview(spark, sf_dir):
    return date_as_text(
        ranking.preview(table(spark, sf_dir, "orders"), 5, ["o_orderkey"]), "o_orderdate"
    )


@query
def trim_and_coerce(spark, sf_dir):
    return typed_bookings(spark, sf_dir)


@query
def embedded_header_filter(spark, sf_dir):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    rows = table(spark, sf_dir, "customer").select([F.col(c).cast("string") for c in columns])
    header = rows.limit(1).select([F.lit(c).alias(c) for c in columns])
    return drop_embedded_header(header.unionByName(rows), "c_custkey")


@query
def assemble_date(spark, sf_dir):
    """No rule is asked for, so the scan reads the key and the parts of the date only."""
    dated = quality.add_check_columns(typed_bookings(spark, sf_dir), BOOKING)
    return date_as_text(dated.select("booking_id", "arrival_date_full"), "arrival_date_full")


@query
def quality_flags(spark, sf_dir):
    flags = [F.col(f).cast("int").alias(f) for f in BOOKING.flags]
    sums = [rule.output for rule in BOOKING.sums]
    return flagged_bookings(spark, sf_dir).select("booking_id", *sums, *flags)


@query
def violation_summary(spark, sf_dir):
    """All rules, their union, and the price check that is reported but rejects nothing."""
    return profile.violation_totals(flagged_bookings(spark, sf_dir), BOOKING)


@query
def clean_rows(spark, sf_dir):
    """A global sort samples its input first, so it reads the stored rows, not the raw ones twice."""
    clean, _ = quality.write_verdicts(bookings(spark, sf_dir), BOOKING, scratch_dir(spark))
    return date_as_text(clean.orderBy("arrival_date_full", "booking_id"), "arrival_date_full")


@query
def rejected_rows(spark, sf_dir):
    return quality.rejection_report(flagged_bookings(spark, sf_dir), BOOKING)


@query
def stored_verdicts(spark, sf_dir):
    """One pass over the raw rows, then both sides from the stored table."""
    clean, rejected = quality.write_verdicts(
        bookings(spark, sf_dir), BOOKING, scratch_dir(spark)
    )
    sides = [
        df.agg(F.lit(name).alias("side"), F.count(F.lit(1)).alias("rows"))
        for name, df in (("clean", clean), ("rejected", rejected))
    ]
    return sides[0].unionByName(sides[1])


@query
def clean_assertion(spark, sf_dir):
    """The checks take two scans, so they read the stored clean table."""
    clean, _ = quality.write_verdicts(bookings(spark, sf_dir), BOOKING, scratch_dir(spark))
    return quality.clean_violations(clean, BOOKING)


@query
def generic_rules_lineitem(spark, sf_dir):
    return profile.violation_totals(flagged_lineitem(spark, sf_dir), LINEITEM)


@query
def negative_numeric_customer(spark, sf_dir):
    flagged = quality.add_quality_flags(table(spark, sf_dir, "customer"), CUSTOMER)
    return quality.rejection_report(flagged, CUSTOMER)


@query
def clean_assertion_faults(spark, sf_dir):
    """The same checks over rows that are not clean: nothing filtered, some rows doubled."""
    rows = flagged_bookings(spark, sf_dir).select(BOOKING.clean_names)
    doubled = rows.unionByName(rows.where("no_of_adults = 1"))
    return quality.clean_violations(doubled, BOOKING)


@query
def large_keys(spark, sf_dir):
    """Keys beyond 32 bits, from text through the rules."""
    raw = table(spark, sf_dir, "orders").withColumn("o_orderkey", F.col("o_orderkey") + 6_000_000_000)
    flagged = quality.flag_rows(raw.select([F.col(c).cast("string") for c in ORDERS.names]), ORDERS)
    return flagged.select("o_orderkey", *[F.col(f).cast("int").alias(f) for f in ORDERS.flags])


# --- profile -----------------------------------------------------------------------------


def _findings(reports, parts):
    """(report, item, value) rows of several reports: item and value are columns of each."""
    rows = [
        reports[name].select(
            F.lit(name).alias("report"), item.cast("string").alias("item"), value.cast("double").alias("value")
        )
        for name, item, value in parts
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query
def quality_report(spark, sf_dir):
    """Violations, observed conditions, duplicates and unknown labels of the raw bookings."""
    found = reports.full_profile(typed_bookings(spark, sf_dir), BOOKING)
    return _findings(
        found,
        [
            ("violations", F.col("rule"), F.col("violations")),
            ("duplicate_rows", F.lit("*"), F.col("duplicates")),
            ("duplicate_keys", F.lit(BOOKING.key), F.col("duplicates")),
            ("unknown_labels", F.concat_ws("=", "column", "value"), F.lit(1)),
        ],
    )


@query
def full_profile(spark, sf_dir):
    """Shape, NULLs, categories, target shares and means of the raw bookings."""
    found = reports.full_profile(typed_bookings(spark, sf_dir), BOOKING)
    return _findings(
        found,
        [
            ("shape", F.lit("rows"), F.col("rows")),
            ("nulls", F.col("column"), F.col("nulls")),
            ("categories", F.concat_ws("=", "column", "value"), F.col("count")),
            ("target", F.col(BOOKING.target), F.col("percentage")),
            ("numbers", F.col("column"), F.round("mean", 6)),
        ],
    )


@query
def unknown_labels(spark, sf_dir):
    return profile.unknown_labels(typed_bookings(spark, sf_dir), BOOKING)


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(typed_bookings(spark, sf_dir))


@query
def frequency_tables(spark, sf_dir):
    orders = profile.frequency_tables(
        table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"]
    )
    customers = profile.frequency_tables(table(spark, sf_dir, "customer"), ["c_mktsegment"])
    return orders.unionByName(customers)


@query
def target_distribution(spark, sf_dir):
    return profile.value_distribution(table(spark, sf_dir, "orders"), "o_orderstatus").orderBy(
        F.desc("count"), "o_orderstatus"
    )


@query
def numeric_summary(spark, sf_dir):
    """Approximate quartiles, as the built-in summary has them."""
    return profile.numeric_summary(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)


@query
def numeric_moments(spark, sf_dir):
    summary = profile.numeric_summary(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return rounded(summary, 6, "mean", "stddev").drop("p25", "p50", "p75")


@query
def exact_percentiles(spark, sf_dir):
    return profile.exact_percentiles(
        table(spark, sf_dir, "lineitem"), LINE_NUMBERS, (0.1, 0.25, 0.5, 0.75, 0.99)
    )


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "lineitem"))


@query
def duplicate_documents(spark, sf_dir):
    """Whole documents that repeat, whatever their id; wide rows, so by fingerprint."""
    documents = table(spark, sf_dir, "documents").drop("doc_id")
    return profile.duplicate_rows(documents, fingerprint=True)


@query
def duplicate_rows_fingerprint(spark, sf_dir):
    """Rows that differ only in which of two columns is NULL."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey") % 3
    rows = table(spark, sf_dir, "orders").select(
        F.when(key != 0, status).alias("a"), F.when(key != 1, status).alias("b")
    )
    return profile.duplicate_rows(rows, fingerprint=True)


@query
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query
def dedupe_keep_one(spark, sf_dir):
    return date_as_text(dedupe.keep_one(table(spark, sf_dir, "lineitem"), LINE_KEY), "l_shipdate")


@query
def retention_summary(spark, sf_dir):
    return profile.retention_summary(flagged_bookings(spark, sf_dir), BOOKING)


@query
def clean_target_distribution(spark, sf_dir):
    return profile.value_distribution(clean_bookings(spark, sf_dir), BOOKING.target)


# --- features, split, scaling, correlation -----------------------------------------------


@query
def engineered_features(spark, sf_dir):
    derived = [name for stage in BOOKING.feature_spec.derived for name in stage]
    out = features.add_engineered_features(clean_bookings(spark, sf_dir), BOOKING)
    return out.select("booking_id", *derived, BOOKING.label)


@query
def one_hot_orders(spark, sf_dir):
    encoded = features.add_one_hot(table(spark, sf_dir, "orders"), ORDERS)
    return encoded.select("o_orderkey", *ORDERS.one_hot_names)


@query
def feature_table(spark, sf_dir):
    return booking_features(spark, sf_dir)


@query
def hash_split_xxhash64(spark, sf_dir):
    return split.split_sizes(table(spark, sf_dir, "orders"), "o_orderkey")


@query
def hash_split_total(spark, sf_dir):
    """Both sides of the default split together, and the keys on both of them."""
    train, test = split.hash_split(table(spark, sf_dir, "orders"), "o_orderkey")
    both = train.select("o_orderkey").unionByName(test.select("o_orderkey"))
    shared = train.join(test, "o_orderkey", "left_semi").agg(F.count(F.lit(1)).alias("shared"))
    return both.agg(F.count(F.lit(1)).alias("rows")).withColumn("shared", shared.scalar())


@query
def hash_split_md5(spark, sf_dir):
    train, test = split.hash_split(table(spark, sf_dir, "orders"), "o_orderkey", method="md5")
    return train.select("o_orderkey", F.lit("train").alias("split")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("split"))
    )


@query
def split_sizes(spark, sf_dir):
    return split.split_sizes(clean_bookings(spark, sf_dir), "booking_id", method="md5")


@query
def scaling_stats(spark, sf_dir):
    train, _ = split.hash_split(booking_features(spark, sf_dir), "booking_id", method="md5")
    stats = scaling.scaling_table(train, BOOKING.feature_spec.scaled)
    return rounded(stats, 6, "mean", "std")


@query
def standardized(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    train, _ = split.hash_split(lines, "l_orderkey", method="md5")
    stats = scaling.scaling_statistics(train, LINE_NUMBERS)
    return scaling.standardize_columns(lines, stats, LINE_NUMBERS, keep=LINE_KEY, digits=4)


@query
def normalized_test_rows(spark, sf_dir):
    """Test side of the model input, scaled with statistics of the training side."""
    return model_tables(spark, sf_dir, digits=4)[1]


@query
def target_correlation(spark, sf_dir):
    found = correlation.target_correlations(
        booking_features(spark, sf_dir), BOOKING.feature_names, BOOKING.label
    )
    return rounded(found, 6, "r")


@query
def pairwise_correlation(spark, sf_dir):
    found = correlation.pair_correlations(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return rounded(found, 6, "r")


@query
def correlation_report(spark, sf_dir):
    """Every correlation with the label and every pair, from one matrix."""
    target, pairs = correlation.correlation_report(
        booking_features(spark, sf_dir), BOOKING.feature_names, BOOKING.label, None, None
    )
    target = target.select(F.col("feature").alias("feature_a"), F.lit(BOOKING.label).alias("feature_b"), "r")
    return target.unionByName(pairs).withColumn("r", F.round("r", 6) + 0.0)


# --- evaluation of a rule-based prediction -----------------------------------------------


@query
def majority_baseline(spark, sf_dir):
    train, test = split.hash_split(scored_orders(spark, sf_dir), "o_orderkey", method="md5")
    return rounded(evaluation.majority_baseline(train, test), 9, "accuracy")


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(scored_orders(spark, sf_dir)).orderBy("label", "prediction")


@query
def label_distribution(spark, sf_dir):
    return evaluation.label_distribution(scored_orders(spark, sf_dir)).orderBy("label")


@query
def prediction_distribution(spark, sf_dir):
    return evaluation.prediction_distribution(scored_orders(spark, sf_dir)).orderBy("prediction")


@query
def classification_metrics(spark, sf_dir):
    matrix = evaluation.confusion_matrix(scored_orders(spark, sf_dir))
    return rounded(evaluation.classification_metrics(matrix), 9, *evaluation.METRICS)


@query
def roc_auc(spark, sf_dir):
    areas = curves.areas_under_curves(scored_orders(spark, sf_dir))
    return rounded(areas, 9, "roc_auc").drop("pr_auc")


@query
def pr_auc(spark, sf_dir):
    """Many orders share a score here: the price in thousands."""
    tied = scored_orders(spark, sf_dir).withColumn("score", F.floor(F.col("score") / 1000))
    return rounded(curves.areas_under_curves(tied), 9, "pr_auc").drop("roc_auc")


@query
def binned_areas(spark, sf_dir):
    """The binned evaluator next to the exact areas: within a thousandth of each other."""
    scored = scored_orders(spark, sf_dir).withColumn("label", F.col("label").cast("double"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score")
    close = []
    for name, area in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        binned = evaluator.setMetricName(area).evaluate(scored)
        close.append((F.abs(F.col(name) - binned) < 1e-3).cast("int").alias(f"{name}_close"))
    exact = curves.areas_under_curves(scored)
    return rounded(exact.select("roc_auc", "pr_auc", *close), 9, "roc_auc", "pr_auc")


# --- models ------------------------------------------------------------------------------


@query
def ml_input_sizes(spark, sf_dir):
    train, test = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    sides = [training.assemble(t, columns, BOOKING.label) for t in (train, test)]
    return training.input_sizes(*sides, len(columns)).drop("partitions")


@query
def model_comparison(spark, sf_dir):
    """Four classifiers on the bookings, best first."""
    return modelling.compare_models(*stored_model_tables(spark, sf_dir), BOOKING).comparison


@query
def two_model_comparison(spark, sf_dir):
    """The large forest against the standardising regression."""
    train, test = stored_model_tables(spark, sf_dir)
    return modelling.compare_models(train, test, BOOKING, training.two_models()).comparison


@query
def best_model(spark, sf_dir):
    """Confusion matrix of the best of the four models."""
    train, test = stored_model_tables(spark, sf_dir)
    chosen = modelling.compare_models(train, test, BOOKING)
    matrix = chosen.reports[f"confusion_matrix/{chosen.best.name}"]
    return matrix.select(F.lit(chosen.best.name).alias("model"), "*")


@query
def model_label_totals(spark, sf_dir):
    """Test rows by label in the confusion matrix of each of the four models."""
    chosen = modelling.compare_models(*stored_model_tables(spark, sf_dir), BOOKING)
    cells = [(m.name, *cell) for m in chosen.models for cell in m.cells]
    rows = small_table(spark, cells, "model string, label double, prediction double, count bigint")
    return rows.groupBy("model", F.col("label").cast("int").alias("label")).agg(F.sum("count").alias("rows"))


@query
def two_models_from_file(spark, sf_dir):
    """The submitted job: a CSV file, both models, rows with NULLs refused, the better one saved."""
    path = scratch_dir(spark)
    write_csv(bookings(spark, sf_dir), f"{path}/raw")
    return modelling.train_two_from_csv(
        spark, f"{path}/raw", BOOKING, f"{path}/work", f"{path}/model"
    ).comparison


@query
def rescored_rows(spark, sf_dir):
    """Test rows by label on which a saved and reloaded regression and its stored coefficients,
    as a column expression, agree."""
    train, test = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    with training.kept(training.fit_rows(train, columns, BOOKING.label)) as (rows,):
        model = training.two_models()["Logistic Regression"].fit(rows)
    path = scratch_dir(spark)
    save_model(model, path)
    model = load_model(spark, path)
    terms = {r["term"]: r["value"] for r in inspection.coefficients(spark, model, columns).collect()}
    odds = sum((F.col(c) * terms[c] for c in columns), F.lit(terms["(intercept)"]))
    by_hand = test.withColumn("by_hand", (odds > 0).cast("double"))
    scored = model.transform(VectorAssembler(inputCols=columns, outputCol="features").transform(by_hand))
    agreed = F.count_if(F.col("by_hand") == F.col("prediction")).alias("agreed")
    return scored.groupBy(F.col(BOOKING.label).alias("label")).agg(agreed)


def _saved_trees(spark, train, columns, estimator):
    """A fitted model, and its nodes as they were saved."""
    with training.kept(training.fit_rows(train, columns, BOOKING.label)) as (rows,):
        model = estimator.fit(rows)
    path = scratch_dir(spark)
    save_model(model, path)
    return model, stored_trees.stored_trees(spark, path)


def _with_values(df: DataFrame, columns) -> DataFrame:
    return training.assemble(df, columns, BOOKING.label).withColumn("x", vector_to_array("features"))


@query
def node_predictions(spark, sf_dir):
    """Test rows by label on which each tree model and its saved nodes, as a column expression, agree."""
    train, test = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    models = {n: e for n, e in training.four_models().items() if n != "Logistic Regression"}
    models["Large Forest"] = training.two_models()["Random Forest"]
    out = None
    for name, estimator in models.items():
        model, trees = _saved_trees(spark, train, columns, estimator)
        scored = training.scoring_handle(model).transform(_with_values(test, columns))
        scored = scored.select("label", "x", F.col("prediction").alias("fitted"))
        agreed = F.count_if(F.col("fitted") == F.col("prediction")).alias("agreed")
        found = stored_trees.score_by_nodes(scored, trees, "x").groupBy("label").agg(agreed)
        found = found.select(F.lit(name).alias("model"), "label", "agreed")
        out = found if out is None else out.unionByName(found)
    return out


@query
def leaf_occupancy(spark, sf_dir):
    """Training rows by label in the leaves of a saved decision tree: as stored, as routed by its nodes, and the leaves where these differ."""
    train, _ = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    _, trees = _saved_trees(spark, train, columns, training.four_models()["Decision Tree"])
    routed = stored_trees.score_by_nodes(_with_values(train, columns), trees, "x")
    routed = routed.groupBy(F.col("leaves")[0].alias("node"), "label").agg(F.count(F.lit(1)).alias("routed"))
    stored = stored_trees.leaf_rows(trees).select("node", "label", F.col("rows").alias("stored"))
    both = routed.join(stored, ["node", "label"], "full").na.fill(0, ["routed", "stored"])
    return both.groupBy("label").agg(
        F.sum("stored").cast("long").alias("stored"),
        F.sum("routed").alias("routed"),
        F.count_if(F.col("stored") != F.col("routed")).alias("differing"),
    )


@query
def importance_file(spark, sf_dir):
    """Importances of the three tree models, written as CSV reports and read back, against those of the saved splits."""
    train, _ = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    out = None
    for name, estimator in training.four_models().items():
        if name == "Logistic Regression":
            continue
        model, trees = _saved_trees(spark, train, columns, estimator)
        path = scratch_dir(spark)
        write_csv(inspection.feature_importance(spark, model, columns, None), path, single_file=True)
        by_nodes = stored_trees.importance_by_nodes(trees, columns).withColumnRenamed("importance", "by_nodes")
        both = read_csv_inferred(spark, path).join(by_nodes, "feature", "full")
        close = F.abs(F.col("importance") - F.col("by_nodes")) < 1e-9
        found = both.agg(
            F.lit(name).alias("model"),
            F.round(F.sum("importance"), 9).alias("total"),
            F.count_if(~F.coalesce(close, F.lit(False))).alias("differing"),
            F.count_if(~F.col("feature").isin(columns)).alias("unknown"),
        )
        out = found if out is None else out.unionByName(found)
    return out


@query
def reloaded_best_model(spark, sf_dir):
    """Test rows by label, scored by the best of four models after it was saved and loaded, the cells of its confusion
    matrix that differ from the fitted model's, and the models with a larger area."""
    train, test = stored_model_tables(spark, sf_dir)
    path = scratch_dir(spark)
    chosen = modelling.compare_models(train, test, BOOKING, model_path=path)
    rows = training.assemble(test, modelling.model_columns(test, BOOKING), BOOKING.label)
    matrix = evaluation.confusion_matrix(training.score_rows(load_model(spark, path), rows))
    fitted = training.matrix_of(spark, chosen.best).withColumnRenamed("count", "fitted")
    both = matrix.join(fitted, ["label", "prediction"], "full").na.fill(0, ["count", "fitted"])
    better = sum(m.roc_auc > chosen.best.roc_auc for m in chosen.models)
    return both.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.sum("count").alias("rows"),
        F.count_if(F.col("count") != F.col("fitted")).alias("differing"),
        F.lit(better).alias("better"),
    )


@query
def spread_sizes(spark, sf_dir):
    """Sizes of both sides of the model input after each was dealt over five partitions and persisted."""
    train, test = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    sides = [training.spread(training.assemble(t, columns, BOOKING.label), 5) for t in (train, test)]
    with training.kept(*sides):
        sizes = training.input_sizes(*sides, len(columns)).collect()  # one row per side
    return small_table(spark, sizes, "split string, rows bigint, features int, partitions bigint")


def _fitted(spark, sf_dir, estimator):
    train, _ = stored_model_tables(spark, sf_dir)
    columns = modelling.model_columns(train, BOOKING)
    with training.kept(training.fit_rows(train, columns, BOOKING.label)) as (rows,):
        return estimator.fit(rows), columns


@query
def feature_importance(spark, sf_dir):
    model, columns = _fitted(spark, sf_dir, training.four_models()["Gradient Boosted Tree"])
    return inspection.feature_importance(spark, model, columns)


@query
def model_nodes(spark, sf_dir):
    model, columns = _fitted(spark, sf_dir, training.four_models()["Random Forest"])
    path = scratch_dir(spark)
    save_model(model, path)
    return modelling.describe_saved_model(spark, path, columns)


@query
def model_coefficients(spark, sf_dir):
    model, columns = _fitted(spark, sf_dir, training.two_models()["Logistic Regression"])
    path = scratch_dir(spark)
    save_model(model, path)
    return inspection.coefficients(spark, load_model(spark, path), columns)


@query
def split_table(spark, sf_dir):
    """Rows by side and label of both sides of the split, stored in one write."""
    features_ = booking_features(spark, sf_dir)
    sides = scaling.write_split(features_, BOOKING, scratch_dir(spark), method="md5")
    both = [t.withColumn("split", F.lit(n)) for n, t in zip((scaling.TRAIN, scaling.TEST), sides)]
    return both[0].unionByName(both[1]).groupBy("split", BOOKING.label).agg(F.count(F.lit(1)).alias("rows"))


@query
def embedding_correlations(spark, sf_dir):
    """Correlations of all dimensions of the vectors, in blocks."""
    vectors = table(spark, sf_dir, "embeddings")
    names = [f"d{i}" for i in range(vectors.select(F.max(F.size("embedding"))).head()[0])]
    wide = vectors.select([F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)])
    matrix = correlation.blocked_correlations(wide, names, block=24)
    return rounded(matrix.where("position_a < position_b").select("feature_a", "feature_b", "r"), 6, "r")


# --- round trips -------------------------------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    """CSV sink, then the reader that infers the types."""
    path = scratch_dir(spark)
    write_csv(table(spark, sf_dir, "customer"), path)
    return read_csv_inferred(spark, path)


@query
def csv_contract_scan(spark, sf_dir):
    """Bookings through a CSV file and the checked reader to the rejection report."""
    path = scratch_dir(spark)
    write_csv(bookings(spark, sf_dir), path)
    flagged = quality.flag_rows(read_csv(spark, path, BOOKING), BOOKING)
    return quality.rejection_report(flagged, BOOKING)


def _database(spark: SparkSession) -> str:
    location = scratch_dir(spark)
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name


@query
def table_round_trip(spark, sf_dir):
    """Managed table sink, then the catalog scan: every column as text."""
    name = f"{_database(spark)}.customer"
    write_table(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), name)
    kept = ("c_custkey", "c_name", "c_mktsegment")
    spec = type(CUSTOMER)(
        "customer", tuple(CUSTOMER[c] for c in kept), key="c_custkey"
    )
    return read_table(spark, name, spec)


@query
def written_table_counts(spark, sf_dir):
    """Row counts of the four managed tables of one preparation."""
    database = _database(spark)
    clean, rejected = quality.write_verdicts(
        bookings(spark, sf_dir), BOOKING, scratch_dir(spark)
    )
    train, test = scaling.train_test_tables(
        features.feature_table(clean, BOOKING), BOOKING, method="md5"
    )
    tables = {"clean": clean, "rejected": rejected, "train": train, "test": test}
    for name, df in tables.items():
        write_table(df, f"{database}.{name}")
    counts = table_counts(spark, [f"{database}.{name}" for name in tables])
    return counts.withColumn("table", F.substring_index("table", ".", -1))


@query
def listed_tables(spark, sf_dir):
    """Tables of a database as the catalog lists them, with their rows."""
    database = _database(spark)
    tables = {n: table(spark, sf_dir, n) for n in ("nation", "customer", "orders")}
    write_tables({f"{database}.{n}": df for n, df in tables.items()})
    counts = table_counts(spark, [f"{database}.{n}" for n in tables])
    counts = counts.select(F.substring_index("table", ".", -1).alias("tableName"), "rows")
    listed = list_tables(spark, database).select("tableName", F.col("isTemporary").cast("int").alias("temporary"))
    return listed.join(counts, "tableName", "full")


@query
def report_files(spark, sf_dir):
    """Distributions, confusion matrix and metrics as CSV reports, read back."""
    path = scratch_dir(spark)
    matrix = evaluation.confusion_matrix(scored_orders(spark, sf_dir))
    written = {
        "actual_label_distribution": evaluation.distribution_in_matrix(matrix, "label"),
        "prediction_distribution": evaluation.distribution_in_matrix(matrix, "prediction"),
        "confusion_matrix": matrix,
        "metrics": rounded(evaluation.classification_metrics(matrix), 9, *evaluation.METRICS),
    }
    for name, df in written.items():
        write_csv(df, f"{path}/{name}", single_file=True)
    back = {n: read_csv_inferred(spark, f"{path}/{n}") for n in written}
    back["metrics"] = back["metrics"].unpivot([], list(evaluation.METRICS), "metric", "value")
    label, prediction = F.col("label").cast("int"), F.col("prediction").cast("int")
    return _findings(
        back,
        [
            ("actual_label_distribution", label, F.col("percentage")),
            ("prediction_distribution", prediction, F.col("percentage")),
            ("confusion_matrix", F.concat_ws("/", label, prediction), F.col("count")),
            ("metrics", F.col("metric"), F.col("value")),
        ],
    )


@query
def result_files(spark, sf_dir):
    """Confusion matrix written as a CSV report and read back."""
    path = scratch_dir(spark)
    matrix = evaluation.confusion_matrix(scored_orders(spark, sf_dir))
    write_csv(matrix.orderBy("label", "prediction"), path, single_file=True)
    return read_csv_inferred(spark, path)
