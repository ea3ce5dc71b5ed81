"""One query per operator, each over whole tables of ``sf_dir``.

The tables hold no missing cells, so the queries derive some from the data itself:
zero discounts and taxes, one column per event type, text in place of numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.functions import column, grade_label, majority
from gradewise.operators import (
    cleaning,
    comparison,
    evaluation,
    features,
    labeling,
    sampling,
    training,
    tuning,
)
from gradewise.plans import ExperimentConfig, Prepared, prepare, run_experiment
from gradewise.sources import (
    export_readable,
    fixed_decimals,
    metric_report,
    preview,
    read_delimited,
    scratch_path,
    table_profile,
    write_report,
)
from gradewise.sources.reports import BASE, OPTIMISED

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

PICK_100G = cleaning.by_suffix()
EVENT_CANDIDATES = [
    "value_100g",
    "click_100g",
    "error_100g",
    "refund_100g",
    "nan_100g",
    "mixed_100g",
]
PRICE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_FEATURES = ["p_size", "p_retailprice", "constant"]
# Text in one file of cells that span lines: some splits' worth, which one task writes.
SPANNING_FILE_BYTES = 1 << 28
TEXT_FEATURES = ["chars_n", "spaces_n", "digits_n", "capitals_n", "marks_n", "lines_n"]


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# Inputs -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a wide product table: a five-step grade, sparse and mixed columns, text."""
    kind, value = F.col("event_type"), F.col("value")
    grade = F.create_map(
        *[F.lit(x) for pair in zip(["click", "view", "signup", "purchase", "error"], "abcde") for x in pair]
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        grade[kind].alias("nutrition_grade_fr"),
        value.alias("value_100g"),
        F.when(kind == "click", value).alias("click_100g"),
        F.when(kind == "error", value).alias("error_100g"),
        F.when(kind == "refund", value).alias("refund_100g"),
        F.when(kind == "view", F.lit(float("nan"))).otherwise(value).alias("nan_100g"),
        F.when(kind == "signup", F.col("props")).otherwise(value.cast("string")).alias("mixed_100g"),
        F.col("user_id").alias("nutrition-score-fr_100g"),
        F.concat_ws("-", kind, "props").alias("packaging"),
    )


def graded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a label from the five-step priority; the middle step has none."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return labeling.assign_label(orders, "o_orderpriority", priority_label)


def priority_label(priority):
    return grade_label(priority, ("1-URGENT", "2-HIGH"), ("4-NOT SPECIFIED", "5-LOW"))


def line_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with zero discounts and taxes as missing cells."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", F.lit(7.0).alias("constant")
    )


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a length score and predictions from two cut-offs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id").select(
        "doc_id",
        "label",
        "n_chars",
        F.col("n_chars").cast("double").alias("raw_score"),
        (F.col("n_chars") > 400).cast("int").alias("prediction"),
        (F.col("n_chars") > 200).cast("int").alias("prediction_low"),
    )


def judged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items scored by price for being returned."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("l_extendedprice").alias("score"),
    )


def text_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as counts over their whole text, with the quality grade where there is one.

    The counts are taken before the join, so no text is shuffled.
    """
    text = F.col("text")

    def left_after_deleting(pattern: str):
        return F.length(F.regexp_replace(text, pattern, ""))

    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(text).alias("chars_n"),
        left_after_deleting(r"\S+").alias("spaces_n"),
        left_after_deleting("[^0-9]+").alias("digits_n"),
        left_after_deleting("[^A-Z]+").alias("capitals_n"),
        left_after_deleting(r"[\w\s]+").alias("marks_n"),
        left_after_deleting(r"[^\n]+").alias("lines_n"),
        F.col("lang").alias("empty_n"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")


def quality_config(**options) -> ExperimentConfig:
    return ExperimentConfig(
        grade="quality",
        mapping=lambda grade: grade_label(grade, (0,), (1,)),
        features=cleaning.by_suffix("_n"),
        key="doc_id",
        shown_features=("chars_n", "digits_n"),
        parallelism=4,
        **options,
    )


def prepared_documents(spark: SparkSession, sf_dir: str) -> tuple[Prepared, list[str]]:
    prepared = prepare(text_shapes(spark, sf_dir), quality_config())
    return prepared, cleaning.dense_columns(prepared.train, prepared.candidates)


# Sources and sinks ------------------------------------------------------------------


def _events_as_tsv(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-tsv")
    export_readable(events, path, sep="\t")
    return events, path


@query
def tsv_round_trip(spark, sf_dir):
    events, path = _events_as_tsv(spark, sf_dir)
    return read_delimited(spark, path, schema=events.schema)


@query
def tsv_inferred_profile(spark, sf_dir):
    _, path = _events_as_tsv(spark, sf_dir)
    return table_profile(read_delimited(spark, path))


@query
def tsv_lines_in_cells(spark, sf_dir):
    """Texts with line ends inside quoted cells."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-tsv")
    export_readable(docs, path, sep="\t")
    # A final line end inside a cell is part of the text, so no cell is trimmed on the way in.
    return read_delimited(spark, path, schema=docs.schema, lineSep="\n")


def files_for(docs: DataFrame, file_bytes: int = SPANNING_FILE_BYTES) -> int:
    """Files of about ``file_bytes`` bytes of text that hold ``docs``; one task writes each."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(size / file_bytes))


@query
def tsv_one_spanning_file(spark, sf_dir):
    """Texts over many lines in one file, or in one for each 256 MB, read in as many tasks as there are splits."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "one-tsv")
    # Dealt out row by row, as splits of the table can be of very unequal size.
    export_readable(docs.repartition(files_for(docs)), path, sep="\t")
    return read_delimited(spark, path, schema=docs.schema, lineSep="\n", min_splits=1)


@query
def table_profile_lineitem(spark, sf_dir):
    return table_profile(table(spark, sf_dir, "lineitem"))


@query
def export_readable_csv(spark, sf_dir):
    rows = parts(spark, sf_dir)
    model = training.fit_features(rows, PART_FEATURES, relative_error=0)
    path = scratch_path(spark, "parts-csv")
    export_readable(model.transform(rows), path)
    columns = [*rows.columns, *[features.imputed(f) for f in PART_FEATURES]]
    schema = ", ".join(f"{c} {'bigint' if c == 'p_partkey' else 'double'}" for c in columns)
    return read_delimited(spark, path, schema=schema, sep=",")


@query
def preview_long(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), 5, order_by="o_orderkey")


@query
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), 5, transpose=False, order_by="o_orderkey")


@query
def metric_report_file(spark, sf_dir):
    judged = judged_documents(spark, sf_dir)
    low = judged.withColumn("prediction", F.col("prediction_low"))
    both = evaluation.metrics(judged).select(F.lit(BASE).alias("variant"), "*").unionByName(
        evaluation.metrics(low).select(F.lit(OPTIMISED).alias("variant"), "*")
    )
    path = scratch_path(spark, "metrics")
    write_report(metric_report(both), path)
    return spark.read.schema("variant string, metric string, value double").json(path)


@query
def base_vs_optimised_file(spark, sf_dir):
    path = scratch_path(spark, "base-vs-optimised")
    write_report(compare_confusions(spark, sf_dir), path, "csv")
    schema = "position int, measure string, base bigint, optimised bigint"
    return read_delimited(spark, path, schema=schema, sep=",")


@query
def feature_rank_file(spark, sf_dir):
    path = scratch_path(spark, "importance")
    write_report(fixed_decimals(importance_rank(spark, sf_dir)), path)
    return spark.read.schema("rank int, feature string, importance double").json(path)


@query
def model_comparison_file(spark, sf_dir):
    path = scratch_path(spark, "comparison")
    report = compare_models(spark, sf_dir).select("model", "accuracy", "auc")
    write_report(fixed_decimals(report), path)
    return spark.read.schema("model string, accuracy double, auc double").json(path)


# Cleaning ---------------------------------------------------------------------------


@query
def select_by_suffix(spark, sf_dir):
    events = product_events(spark, sf_dir)
    return events.select("event_id", *[column(c) for c in cleaning.pick_columns(events, PICK_100G)])


@query
def cast_numeric(spark, sf_dir):
    events = product_events(spark, sf_dir).select("event_id", "mixed_100g")
    return cleaning.cast_numeric(events, ["mixed_100g"])


@query
def malformed_profile(spark, sf_dir):
    events = product_events(spark, sf_dir)
    return cleaning.malformed_profile(events, ["mixed_100g", "packaging", "value_100g"])


@query
def null_profile(spark, sf_dir):
    numeric = cleaning.cast_numeric(product_events(spark, sf_dir), EVENT_CANDIDATES)
    return cleaning.null_profile(numeric, EVENT_CANDIDATES)


@query
def dense_columns(spark, sf_dir):
    numeric = cleaning.cast_numeric(product_events(spark, sf_dir), EVENT_CANDIDATES)
    return cleaning.dense_profile(numeric, EVENT_CANDIDATES)


def _clean_events(spark, sf_dir):
    return cleaning.clean(
        product_events(spark, sf_dir),
        PICK_100G,
        target="nutrition_grade_fr",
        keep=["event_id", "packaging"],
    )


@query
def clean_project(spark, sf_dir):
    return _clean_events(spark, sf_dir)[0]


@query
def clean_summary(spark, sf_dir):
    cleaned, numeric = _clean_events(spark, sf_dir)
    return cleaning.clean_summary(cleaned, numeric, ["packaging"])


@query
def normalize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cleaning.clean_text(docs, ["text"])


# Labels -----------------------------------------------------------------------------


@query
def grade_labels(spark, sf_dir):
    return graded_orders(spark, sf_dir)


@query
def drop_unlabelled(spark, sf_dir):
    return labeling.drop_unlabelled(graded_orders(spark, sf_dir))


@query
def label_stats(spark, sf_dir):
    return labeling.label_stats(graded_orders(spark, sf_dir))


@query
def label_distribution(spark, sf_dir):
    return labeling.label_distribution(graded_orders(spark, sf_dir))


# Features ---------------------------------------------------------------------------


@query
def impute_median(spark, sf_dir):
    rows = line_prices(spark, sf_dir)
    filled = features.median_imputer(PRICE_FEATURES, relative_error=0).fit(rows).transform(rows)
    return filled.select("l_orderkey", "l_linenumber", *[features.imputed(f) for f in PRICE_FEATURES])


@query
def minmax_scale(spark, sf_dir):
    rows = parts(spark, sf_dir)
    model = training.fit_features(rows, PART_FEATURES, relative_error=0)
    unpacked = features.vector_columns(model.transform(rows), PART_FEATURES, keep=["p_partkey"])
    return fixed_decimals(unpacked, 6)


@query
def vector_columns(spark, sf_dir):
    rows = line_prices(spark, sf_dir)
    model = training.fit_features(rows, PRICE_FEATURES, relative_error=0)
    unpacked = features.vector_columns(
        model.transform(rows), PRICE_FEATURES, keep=["l_orderkey", "l_linenumber"]
    )
    return fixed_decimals(unpacked, 6)


@query
def scale_test_rows(spark, sf_dir):
    """Stages fitted on training rows only, applied to the test rows."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = sampling.hash_split(rows, "o_orderkey")
    model = training.fit_features(train, ["o_totalprice"], relative_error=0)
    unpacked = features.vector_columns(model.transform(test), ["o_totalprice"], keep=["o_orderkey"])
    return fixed_decimals(unpacked, 6)


@query
def preprocess_status(spark, sf_dir):
    rows = line_prices(spark, sf_dir)
    return features.preprocess_status(training.fit_features(rows, PRICE_FEATURES))


# Splits and subsets -----------------------------------------------------------------


@query
def hash_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    train, test = sampling.hash_split(orders, "o_orderkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def hash_folds(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return labels.withColumn("fold", sampling.fold_of("doc_id"))


@query
def balanced_subsets(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return sampling.balanced_subsets(labels, "doc_id")


@query
def balanced_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("label")
    )
    return sampling.balanced_subsets(orders, "o_orderkey", subsets=3)


@query
def majority_vote_fixed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    length, spaces = F.length("text"), F.regexp_count("text", F.lit(" "))
    voted = docs.select(
        "doc_id",
        (F.col("n_chars") > 400).cast("int").alias("vote_0"),
        (spaces * 6 < length).cast("int").alias("vote_1"),
        (F.col("lang") == "en").cast("int").alias("vote_2"),
        (F.col("source") == "src0").cast("int").alias("vote_3"),
    ).join(labels, "doc_id")
    three = [F.col(f"vote_{i}") for i in range(3)]
    return voted.select("*", majority(three).alias("of_three"), majority([*three, F.col("vote_3")]).alias("of_four"))


# Evaluation of given predictions ----------------------------------------------------


@query
def confusion(spark, sf_dir):
    return evaluation.confusion(judged_documents(spark, sf_dir))


@query
def metrics_fixed(spark, sf_dir):
    return evaluation.metrics(judged_documents(spark, sf_dir))


@query
def roc_points(spark, sf_dir):
    return evaluation.roc_points(judged_documents(spark, sf_dir), score="raw_score")


@query
def roc_points_lines(spark, sf_dir):
    return evaluation.roc_points(judged_lines(spark, sf_dir))


@query
def roc_corners_lines(spark, sf_dir):
    return evaluation.roc_points(judged_lines(spark, sf_dir), drop_collinear=True)


@query
def auc_exact(spark, sf_dir):
    return evaluation.area_under_roc(judged_documents(spark, sf_dir))


@query
def auc_exact_lines(spark, sf_dir):
    return evaluation.area_under_roc(judged_lines(spark, sf_dir), score="score")


@query
def misclassified(spark, sf_dir):
    return evaluation.misclassified(judged_documents(spark, sf_dir), "doc_id", ["n_chars"])


@query
def misclassified_all(spark, sf_dir):
    judged = judged_documents(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    return evaluation.misclassified(judged, "doc_id", ["n_chars", "lang"], limit=None, source=docs)


@query
def label_pairs(spark, sf_dir):
    return evaluation.label_pairs(judged_documents(spark, sf_dir), "doc_id")


@query
def compare_confusions(spark, sf_dir):
    judged = judged_documents(spark, sf_dir)
    return comparison.compare_confusions(
        evaluation.confusion(judged), evaluation.confusion(judged, prediction="prediction_low")
    )


# Trained models ---------------------------------------------------------------------
#
# Labels follow a rule that a model must find, so the right answers are known: line items
# are labelled by their number, customers by their nation's.


def ruled_lines(spark: SparkSession, sf_dir: str) -> tuple[Prepared, list[str]]:
    """All line items, labelled 1 from line 4 on, with a telling feature and one that tells nothing."""
    lines = table(spark, sf_dir, "lineitem")
    source = lines.select(
        "l_orderkey",
        F.col("l_linenumber").alias("line_n"),
        F.col("l_quantity").alias("quantity_n"),
        (F.col("l_linenumber") > 3).cast("int").alias("rule"),
    )
    prepared = prepare(source, rule_config("l_orderkey"))
    return prepared, cleaning.dense_columns(prepared.train, prepared.candidates)


def ruled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, labelled 1 from nation 13 on."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("nation_n"),
        F.col("c_acctbal").alias("balance_n"),
        (F.col("c_nationkey") > 12).cast("int").alias("rule"),
    )


def rule_config(key: str, **options) -> ExperimentConfig:
    return ExperimentConfig(
        grade="rule",
        mapping=lambda rule: grade_label(rule, (0,), (1,)),
        features=cleaning.by_suffix("_n"),
        key=key,
        shown_features=("line_n", "nation_n"),
        parallelism=4,
        **options,
    )


def _train_and_evaluate(spark, sf_dir, classifier):
    prepared, names = ruled_lines(spark, sf_dir)
    split = prepared.train, prepared.test
    trained = training.train_model(prepared.labelled, names, classifier, split=split)
    return evaluation.evaluate(trained.model, trained.test, ["l_orderkey"])[0]


@query
def train_forest(spark, sf_dir):
    return _train_and_evaluate(spark, sf_dir, training.base_forest())


@query
def train_boosted(spark, sf_dir):
    return _train_and_evaluate(spark, sf_dir, training.boosted_trees())


@query
def train_logistic(spark, sf_dir):
    return _train_and_evaluate(spark, sf_dir, training.logistic())


@query
def train_forest_lines(spark, sf_dir):
    """The base forest's answer for every test row."""
    prepared, names = ruled_lines(spark, sf_dir)
    trained = training.train_model(prepared.labelled, names, split=(prepared.train, prepared.test))
    _, scored = evaluation.evaluate(trained.model, trained.test, ["l_orderkey", "line_n"])
    return scored.select("l_orderkey", "line_n", "label", "prediction", (F.col("score") > 0.5).alias("leans_to_one"))


@query
def training_info(spark, sf_dir):
    prepared, names = prepared_documents(spark, sf_dir)
    trained = training.train_model(prepared.labelled, names, training.logistic(), key="doc_id")
    return training.training_info(trained.model, trained.train)


@query
def score_rows(spark, sf_dir):
    """Which rows were scored, with the raw columns they carry."""
    prepared, names = prepared_documents(spark, sf_dir)
    trained = training.train_model(
        prepared.labelled, names, training.logistic(), split=(prepared.train, prepared.test)
    )
    scored = training.score(trained.model, trained.test, ["doc_id", "chars_n"])
    return scored.select(
        "doc_id",
        "chars_n",
        "label",
        F.col("prediction").isin(0, 1).alias("is_class"),
        F.col("score").between(0, 1).alias("is_probability"),
    )


def _compared(spark, sf_dir):
    prepared, names = ruled_lines(spark, sf_dir)
    return comparison.compare_models(prepared.train, prepared.test, names, ["l_orderkey"])


@query
def compare_models(spark, sf_dir):
    return _compared(spark, sf_dir).report


@query
def model_roc_curves(spark, sf_dir):
    """How high each curve gets without a false alarm, and how low it is with one."""
    points = evaluation.roc_curves(_compared(spark, sf_dir).scored)
    return points.groupBy("model").agg(
        F.max(F.when(F.col("fpr") == 0, F.col("tpr"))).alias("tpr_without_alarm"),
        F.min(F.when(F.col("fpr") > 0, F.col("tpr"))).alias("tpr_with_alarm"),
        F.max("fpr").alias("last_fpr"),
    )


@query
def importance_rank(spark, sf_dir):
    prepared, names = ruled_lines(spark, sf_dir)
    trained = training.train_model(prepared.labelled, names, split=(prepared.train, prepared.test))
    return evaluation.importance_rank(trained.model, names, prepared.train)


@query
def select_top_features(spark, sf_dir):
    """Judged by the one feature that the ranking picks."""
    prepared, names = ruled_lines(spark, sf_dir)
    model = training.fit_on_top_features(prepared.train, names, k=1)
    return evaluation.evaluate(model, prepared.test, ["l_orderkey"])[0]


@query
def balanced_ensemble(spark, sf_dir):
    prepared, names = ruled_lines(spark, sf_dir)
    ensemble = training.fit_balanced_ensemble(prepared.train, names, "l_orderkey")
    return ensemble.score(prepared.test, ["l_orderkey", "line_n"])


@query
def tuning_report(spark, sf_dir):
    prepared = prepare(ruled_customers(spark, sf_dir), rule_config("c_custkey"))
    names = cleaning.dense_columns(prepared.train, prepared.candidates)
    forest = training.plain_forest()
    report = tuning.cross_validate(
        prepared.train, names, forest, tuning.forest_grid(forest), fold="fold", parallelism=4
    ).report
    return fixed_decimals(report.withColumns({p: F.col(p).cast("int") for p in ("numTrees", "maxDepth")}))


@query
def experiment_metrics(spark, sf_dir):
    result = run_experiment(ruled_customers(spark, sf_dir), rule_config("c_custkey"))
    return result.report("metrics")


@query
def experiment_report_files(spark, sf_dir):
    """The reports that a run leaves behind, read again: both confusions, labels, chosen parameters."""
    output = scratch_path(spark, "reports")
    run_experiment(ruled_customers(spark, sf_dir), rule_config("c_custkey", output=output))
    counts = spark.read.schema("variant string, tp bigint, tn bigint, fp bigint, fn bigint").json(f"{output}/confusions")
    labels = spark.read.schema("label int, n_rows bigint").json(f"{output}/label_distribution")
    wrong = spark.read.schema("c_custkey bigint").json(f"{output}/misclassified")
    cells = [counts.select(F.concat("variant", F.lit(f" {c}")).alias("name"), F.col(c).alias("n")) for c in ("tp", "tn", "fp", "fn")]
    rest = [
        labels.select(F.concat(F.lit("label "), "label"), "n_rows"),
        wrong.agg(F.count(F.lit(1))).select(F.lit("wrong rows"), "count(1)"),
    ]
    return reduce(DataFrame.unionAll, [*cells, *rest])


@query
def median_sketch_rank(spark, sf_dir):
    """Is the default imputer's value within its error of the middle rank?"""
    rows = line_prices(spark, sf_dir)
    model = features.median_imputer(PRICE_FEATURES).fit(rows)
    filled = model.surrogateDF.first().asDict()
    n = F.count(F.col("value"))
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.lit(filled[c]).alias("middle")) for c in PRICE_FEATURES])).alias("c")).select("c.*")
    below, upto = F.count_if(F.col("value") < F.col("middle")), F.count_if(F.col("value") <= F.col("middle"))
    error = 2 * features.MEDIAN_ERROR
    return long.groupBy("column").agg(
        n.alias("n_values"), ((below <= n * (0.5 + error)) & (upto >= n * (0.5 - error))).alias("is_middle")
    )


@query
def three_class_accuracy(spark, sf_dir):
    """Accuracy of three classes, with missing predictions."""
    flags = F.create_map(*[F.lit(x) for pair in zip("ANR", range(3)) for x in pair])
    judged = table(spark, sf_dir, "lineitem").select(
        flags[F.col("l_returnflag")].alias("label"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber") % 3).alias("prediction"),
    )
    return evaluation.metrics(judged, raw_score=None).select("accuracy")


@query
def split_without_keys(spark, sf_dir):
    """A third of the orders without a key: are both parts 80 to 20, within four standard errors?"""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("key"), "o_custkey", "o_totalprice", "o_orderdate"
    )
    train, test = sampling.hash_split(orders, "key")
    counted = train.select("key", F.lit(1).alias("t")).unionAll(test.select("key", F.lit(0).alias("t")))
    return counted.groupBy(F.col("key").isNull().alias("without_key")).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.abs(F.avg("t") - 0.8) < 1.6 / F.sqrt(F.count(F.lit(1)))).alias("is_split")
    )


@query
def tsv_mixed_files(spark, sf_dir):
    """A folder of plain files, files whose cells span lines, and files with carriage returns."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "mixed-tsv")
    kind = F.pmod("doc_id", F.lit(3))
    one_line = F.regexp_replace("text", "[\\n\\r]", " ")
    export_readable(docs.filter(kind == 0).withColumn("text", one_line), f"{path}/plain", sep="\t")
    export_readable(docs.filter(kind == 1), f"{path}/deep/spanning", sep="\t")
    returns = F.regexp_replace("text", "\n", "\r\n")
    export_readable(docs.filter(kind == 2).withColumn("text", returns), f"{path}/deep/returns", sep="\t")
    read = read_delimited(spark, path, schema=docs.schema, recursiveFileLookup=True, lineSep="\n")
    return read.withColumn("text", F.regexp_replace("text", "[\\r\\n]+", " "))


@query
def misclassified_lookup(spark, sf_dir):
    """Wrong rows with looked-up columns; some keys are null, some are not in the source."""
    judged = judged_documents(spark, sf_dir).withColumn("key", F.when(F.col("doc_id") % 50 != 0, F.col("doc_id")))
    docs = table(spark, sf_dir, "documents").filter(F.col("doc_id") % 7 != 0).select(F.col("doc_id").alias("key"), "lang")
    return evaluation.misclassified(judged, "key", ["n_chars", "lang"], limit=None, source=docs)


# Overlapping classes: no rule tells the label, yet what each family makes of four cells of two
# flags is known. Trees end at the share of ones of each cell, or at the steps of boosting
# towards it; a logistic model has no interaction of the flags, on which the shares do depend.


def flagged_lines(spark: SparkSession, sf_dir: str) -> tuple[Prepared, list[str]]:
    """All line items with two flags, labelled 1 in 2, 7, 6 or 4 of ten cases, by the part's key."""
    late, large = F.col("l_linenumber") > 3, F.col("l_quantity") > 25
    tenths = F.when(~late & ~large, 2).when(late & ~large, 7).when(~late, 6).otherwise(4)
    source = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        late.cast("int").alias("late_n"),
        large.cast("int").alias("large_n"),
        (F.col("l_partkey") % 10 < tenths).cast("int").alias("rule"),
    )
    prepared = prepare(source, rule_config("l_orderkey"))
    return prepared, ["late_n", "large_n"]


def cell_scores(prepared: Prepared, scored: DataFrame, model: str, n_trees: int | None) -> DataFrame:
    """Test rows and mean score of each cell; a forest's score counts as the share it is near to.

    Near is within six standard errors of a mean over that many bootstrap samples.
    """
    cells = ["late_n", "large_n"]
    shares = prepared.train.groupBy(cells).agg(F.avg(F.col("label").cast("double")).alias("p"), F.count("label").alias("n"))
    found = scored.groupBy(cells).agg(
        F.count(F.lit(1)).alias("n_test"),
        (F.max("score") == F.min("score")).alias("is_one_score"),
        F.avg("score").alias("score"),
    )
    score = F.col("score")
    if n_trees is not None:
        near = F.abs(score - F.col("p")) < 6 * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n") / n_trees)
        score = F.when(near, F.col("p")).otherwise(score)
    return found.join(shares, cells).select(
        F.lit(model).alias("model"),
        F.lit(n_trees).cast("int").alias("n_trees"),
        *cells,
        "n_test",
        "is_one_score",
        F.round(score, 4).alias("score"),
    )


@query
def trained_cells(spark, sf_dir):
    """Each stock model's score in each cell."""
    prepared, names = flagged_lines(spark, sf_dir)
    split = prepared.train, prepared.test
    stages = training.fit_features(prepared.train, names)  # the same ones for all three
    found = []
    for name, classifier in (
        ("base forest", training.base_forest()),
        ("boosted trees", training.boosted_trees()),
        ("logistic", training.logistic()),
    ):
        trained = training.train_model(prepared.labelled, names, classifier, split=split, prepared=stages)
        scored = training.score(trained.model, trained.test, names)
        model = training.classifier_of(trained.model)
        trees = model.getNumTrees if "RandomForest" in type(model).__name__ else None
        found.append(cell_scores(prepared, scored, name, trees))
    return reduce(DataFrame.unionAll, found)


def _compared_flags(spark, sf_dir):
    prepared, names = flagged_lines(spark, sf_dir)
    return prepared, comparison.compare_models(prepared.train, prepared.test, names, names)


@query
def compare_overlapping(spark, sf_dir):
    """Metrics of the three families: trees catch the interaction, the logistic model does not."""
    return _compared_flags(spark, sf_dir)[1].report


@query
def compared_cells(spark, sf_dir):
    """Scores of the compared models in each cell, which differ by family where the metrics agree."""
    prepared, compared = _compared_flags(spark, sf_dir)
    trees = {"Random Forest": training.classifier_of(compared.models["Random Forest"]).getNumTrees}
    found = [cell_scores(prepared, scored, name, trees.get(name)) for name, scored in compared.scored.items()]
    return reduce(DataFrame.unionAll, found)


@query
def train_stump(spark, sf_dir):
    """A tree of one split must take the best of all features and values."""
    lines = table(spark, sf_dir, "lineitem")
    source = lines.select(
        "l_orderkey",
        F.col("l_linenumber").alias("line_n"),
        F.col("l_quantity").alias("quantity_n"),
        (F.col("l_partkey") % 10 < F.when(F.col("l_quantity") > 33, 7).when(F.col("l_linenumber") > 5, 5).otherwise(3))
        .cast("int")
        .alias("rule"),
    )
    prepared = prepare(source, rule_config("l_orderkey"))
    stump = RandomForestClassifier(numTrees=1, maxDepth=1, maxBins=64, bootstrap=False, labelCol="label")
    trained = training.train_model(
        prepared.labelled, ["line_n", "quantity_n"], stump, split=(prepared.train, prepared.test)
    )
    scored = training.score(trained.model, trained.test, ["quantity_n"])
    return scored.groupBy("prediction", F.round("score", 6).alias("score")).agg(
        F.count(F.lit(1)).alias("n_test"), F.min("quantity_n").alias("least"), F.max("quantity_n").alias("most")
    )


@query
def balanced_votes(spark, sf_dir):
    """Votes of trees on labels that features tell nothing of, so that members disagree and the majority decides."""
    source = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.pmod("o_custkey", F.lit(8)).alias("cell_n"), (F.col("o_orderkey") % 7 < 2).cast("int").alias("rule")
    )
    prepared = prepare(source, rule_config("o_orderkey"))
    # One tree on all of its rows, deep enough for a leaf per cell.
    tree = RandomForestClassifier(numTrees=1, maxDepth=8, bootstrap=False, labelCol="label")
    ensemble = training.fit_balanced_ensemble(prepared.train, ["cell_n"], "o_orderkey", classifier=tree)
    return ensemble.score(prepared.test, ["o_orderkey", "cell_n"])


# What must hold of any trained model, whatever it learned ----------------------------


def _totals(report: DataFrame, name: str) -> DataFrame:
    return report.select(
        name,
        (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n_test"),
        (F.col("tp") + F.col("fn")).alias("n_positive"),
        F.col("auc").between(0, 1).alias("auc_in_range"),
    )


@query
def model_totals(spark, sf_dir):
    prepared, names = prepared_documents(spark, sf_dir)
    return _totals(comparison.compare_models(prepared.train, prepared.test, names, ["doc_id"]).report, "model")


@query
def ensemble_votes(spark, sf_dir):
    votes = [F.col(f"vote_{i}") for i in range(5)]
    return balanced_ensemble(spark, sf_dir).select(
        "l_orderkey", "label", sum(v for v in votes).alias("n_votes")
    )


@query
def tuning_candidates(spark, sf_dir):
    """Candidates of unequal parameters, told by name: a tree of depth 0 cannot know, one of depth 5 can."""
    prepared = prepare(ruled_customers(spark, sf_dir), rule_config("c_custkey"))
    forest = training.plain_forest()
    grid = [{forest.maxDepth: 0, forest.numTrees: 3}, {forest.numTrees: 5, forest.maxDepth: 5}, {forest.maxDepth: 5}]
    tuned = tuning.cross_validate(prepared.train, prepared.candidates, forest, grid, fold="fold", parallelism=3)
    return tuned.report.select(
        "candidate",
        F.col("numTrees").cast("int").alias("num_trees"),
        F.col("maxDepth").cast("int").alias("max_depth"),
        F.round("mean_auc", 4).alias("mean_auc"),
        "is_best",
    )


@query
def importance_features(spark, sf_dir):
    """Importances of customers' features by the boosted trees, beside their number of values."""
    prepared = prepare(ruled_customers(spark, sf_dir), rule_config("c_custkey"))
    trained = training.train_model(
        prepared.labelled, prepared.candidates, training.boosted_trees(), split=(prepared.train, prepared.test)
    )
    ranked = evaluation.importance_rank(trained.model, prepared.candidates, prepared.train)
    return ranked.select("feature", (F.col("importance") > 0.9).alias("is_telling"))


@query
def experiment_totals(spark, sf_dir):
    """Row counts after each step of the experiment."""
    result = run_experiment(text_shapes(spark, sf_dir), quality_config())
    stats = result.report("label_stats")
    parts = [
        result.report("cleaning_summary").select(F.lit("rows"), "final_row_count"),
        *[stats.select(F.lit(c), c) for c in ("negatives", "positives", "discarded")],
        result.report("training_info").select(F.lit("training rows"), "training_rows"),
        result.dataset().agg(F.count(F.lit(1)).alias("n")).select(F.lit("exported rows"), "n"),
        _totals(result.report("metrics"), "variant").select("variant", "n_test"),
    ]
    return reduce(DataFrame.unionAll, [p.toDF("step", "n") for p in parts])
