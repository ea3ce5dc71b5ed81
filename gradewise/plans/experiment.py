"""The whole experiment: raw table in, models and reports out (O1)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.functions import column, grade_label, row_key
from gradewise.operators import cleaning, comparison, evaluation, labeling, training, tuning
from gradewise.operators.features import MEDIAN_ERROR, preprocess_status, store_vectors, vector_columns
from gradewise.operators.labeling import LABEL
from gradewise.operators.sampling import SEED, TRAIN_RATIO, fold_of, identity, in_train
from gradewise.sources import (
    export_readable,
    fixed_decimals,
    materialize,
    metric_report,
    preview,
    read_delimited,
    write_report,
)
from gradewise.sources.reports import BASE, OPTIMISED

# Raw features shown beside wrong predictions, as far as they exist.
SHOWN_FEATURES = (
    "saturated-fat_100g",
    "fat_100g",
    "sugars_100g",
    "energy_100g",
    "salt_100g",
)

ADDED_COLUMNS = frozenset({LABEL, "part", "fold", "prediction", "raw_score", "score"})


@dataclass
class ExperimentConfig:
    """What to predict from what. ``key`` names a unique column; without one rows are hashed."""

    grade: str = "nutrition_grade_fr"
    mapping: Callable[[Column], Column] = grade_label
    features: cleaning.Picker = field(default_factory=cleaning.by_suffix)
    key: str | None = None
    text_columns: tuple[str, ...] = cleaning.TEXT_COLUMNS
    keep: tuple[str, ...] = ()
    shown_features: tuple[str, ...] = SHOWN_FEATURES
    max_missing_share: float = cleaning.MAX_MISSING_SHARE
    relative_error: float = MEDIAN_ERROR
    train_ratio: float = TRAIN_RATIO
    seed: int = SEED
    folds: int = tuning.FOLDS
    parallelism: int = tuning.PARALLELISM
    trees: tuple[int, ...] = tuning.TREES
    depths: tuple[int, ...] = tuning.DEPTHS
    wrong_limit: int | None = evaluation.WRONG_LIMIT
    output: str | None = None


@dataclass
class Prepared:
    """The cleaned table, written once and laid out by part and fold."""

    table: DataFrame
    key: str
    candidates: list[str]
    text: list[str]
    keep: list[str]

    @property
    def labelled(self) -> DataFrame:
        return self.table.filter(F.col("part") != "unlabelled")

    @property
    def train(self) -> DataFrame:
        return self.table.filter(F.col("part") == "train")

    @property
    def test(self) -> DataFrame:
        return self.table.filter(F.col("part") == "test")


def prepare(source: DataFrame, config: ExperimentConfig) -> Prepared:
    """Cast, clean, label and split in one pass over the source, and store the result.

    Later steps read columns and directories of that table, never the source. Rows
    without a label are kept for the label counts only, so their other cells are left out.
    Rebalancing on a hash of the key gives even files, splits a hot key, and with the sort
    makes the layout that tree training depends on the same on each run.
    """
    source = cleaning.without_dots(source)
    key = cleaning.undotted(config.key or "row_key")
    if config.key is None:
        source = source.select("*", row_key(source).alias(key))
    source = source.withColumn("__identity", identity(source, key))  # the key, content where it is null
    who = F.col("__identity")
    candidates = cleaning.pick_columns(source, config.features)
    text = [c for c in map(cleaning.undotted, config.text_columns) if c in source.columns]
    keep = [c for c in map(cleaning.undotted, config.keep) if c in source.columns and c not in candidates]
    taken = ADDED_COLUMNS & {key, *candidates, *keep}
    if taken:
        raise ValueError(f"rename these columns, the experiment adds its own: {sorted(taken)}")
    cleaned = cleaning.clean_text(cleaning.cast_numeric(source, candidates), text)
    labelled = labeling.assign_label(cleaned, cleaning.undotted(config.grade), config.mapping)
    has_label = F.col(LABEL).isNotNull()
    # A column of its own, so that a row is hashed for it once.
    split = labelled.withColumn("__train", in_train(who, config.train_ratio, config.seed))
    in_training = F.col("__train")
    rows = split.select(
        *[F.when(has_label, column(c)).alias(c) for c in dict.fromkeys([key, *candidates, *keep])],
        LABEL,
        F.when(~has_label, "unlabelled").when(in_training, "train").otherwise("test").alias("part"),
        F.when(has_label & in_training, fold_of(who, config.folds, config.seed))
        .otherwise(-1)
        .alias("fold"),
        F.xxhash64(who).alias("spread"),
    )
    even = rows.hint("rebalance", F.col("spread")).sortWithinPartitions("part", "fold", "spread")
    table = materialize(even.drop("spread"), "prepared", ("part", "fold"))
    return Prepared(table, key, candidates, text, keep)


@dataclass
class ExperimentResult:
    """Fitted models, scored test rows, and one report table per step.

    A report is built when it is asked for, from stored tables.
    """

    prepared: Prepared
    features: list[str]
    models: dict[str, PipelineModel]
    scored: dict[str, DataFrame]
    best_params: dict[str, object]
    reports: dict[str, Callable[[], DataFrame]]

    def report(self, name: str) -> DataFrame:
        return self.reports[name]()

    def dataset(self) -> DataFrame:
        """Key, label and scaled features of all labelled rows."""
        vectors = self.models[BASE].transform(self.prepared.labelled)
        return vector_columns(vectors, self.features, keep=[self.prepared.key, LABEL])


def run_experiment(source: DataFrame, config: ExperimentConfig) -> ExperimentResult:
    """Prepare, train the base forest, tune it, compare model families, report."""
    prepared = prepare(source, config)
    train, test, key = prepared.train, prepared.test, prepared.key
    features = cleaning.dense_columns(train, prepared.candidates, config.max_missing_share)
    shown = [c for c in map(cleaning.undotted, config.shown_features) if c in features]
    carried = list(dict.fromkeys([key, *shown]))  # all else is in the prepared table, by key

    # Imputing and scaling run once per fitted set of stages; every model reads the stored vectors.
    sets = tuning.fold_stages(train, features, "fold", config.folds, config.parallelism, config.relative_error)
    stages = sets["features"]
    layout = ("part", "fold")
    vectors = store_vectors(prepared.labelled, sets, [*carried, LABEL, *layout], layout)
    train_vectors, test_vectors = (vectors.filter(F.col("part") == part) for part in ("train", "test"))

    forest = training.plain_forest()
    tuned = tuning.cross_validate(
        train,
        features,
        forest,
        tuning.forest_grid(forest, config.trees, config.depths),
        fold="fold",
        folds=config.folds,
        parallelism=config.parallelism,
        vectors=tuning.FoldVectors(sets, train_vectors),
    )
    tuned_metrics, tuned_scored = evaluation.evaluate(training.classifier_of(tuned.model), test_vectors, carried)
    fitted = comparison.fit_and_evaluate(
        (train_vectors, test_vectors),
        stages,
        {BASE: training.base_forest(), **training.stock_classifiers()},
        carried,
        parallelism=config.parallelism,
    )
    base, base_metrics, base_scored = fitted.pop(BASE)
    compared = comparison.compared(fitted)

    scored = {BASE: base_scored, OPTIMISED: tuned_scored, **compared.scored}
    models = {BASE: base, OPTIMISED: tuned.model, **compared.models}
    result = ExperimentResult(prepared, features, models, scored, tuned.params, {})
    result.reports.update(
        null_profile=lambda: cleaning.null_profile(train, prepared.candidates),
        cleaning_summary=lambda: cleaning.clean_summary(prepared.table, features, prepared.text),
        label_stats=lambda: labeling.label_stats(prepared.table),
        label_distribution=lambda: labeling.label_distribution(prepared.labelled),
        preprocess_status=lambda: preprocess_status(stages),
        preview=lambda: preview(result.dataset(), order_by=key),
        training_info=lambda: training.training_info(base, train),
        metrics=lambda: _by_variant({BASE: base_metrics, OPTIMISED: tuned_metrics}),
        tuning=lambda: tuned.report,
        importance=lambda: evaluation.importance_rank(tuned.model, features, train),
        top_features=lambda: evaluation.importance_rank(
            tuned.model, features, train, evaluation.TOP_FEATURES
        ),
        confusions=lambda: _by_variant(
            {BASE: evaluation.confusion(base_scored), OPTIMISED: evaluation.confusion(tuned_scored)}
        ),
        best_params=lambda: _name_values(train.sparkSession, tuned.params),
        base_vs_optimised=lambda: comparison.compare_confusions(
            evaluation.confusion(base_scored), evaluation.confusion(tuned_scored)
        ),
        misclassified=lambda: evaluation.misclassified(tuned_scored, key, shown, config.wrong_limit),
        comparison=lambda: compared.report,
        roc=lambda: evaluation.roc_curves(scored),
        roc_areas=lambda: evaluation.roc_areas(scored),
    )
    if config.output is not None:
        write_reports(result, config.output.rstrip("/"))
    return result


def _by_variant(parts: dict[str, DataFrame]) -> DataFrame:
    named = [df.select(F.lit(name).alias("variant"), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def _name_values(spark: SparkSession, params: dict[str, object]) -> DataFrame:
    return spark.createDataFrame([(n, str(v)) for n, v in params.items()], "parameter string, value string")


def run_experiment_file(
    spark: SparkSession, path: str, config: ExperimentConfig | None = None
) -> ExperimentResult:
    """The experiment on a tab-separated file.

    Cells are cast one by one later, so they are read as text, without an inference pass.
    """
    return run_experiment(read_delimited(spark, path, infer=False), config or ExperimentConfig())


def write_reports(result: ExperimentResult, path: str) -> None:
    """The scaled dataset and the reports, each in a folder of its own under ``path``."""
    export_readable(result.dataset(), f"{path}/dataset")
    compared = result.report("comparison").select("model", "accuracy", "auc")
    write_report(metric_report(result.report("metrics")), f"{path}/metrics")
    write_report(fixed_decimals(compared), f"{path}/comparison")
    write_report(fixed_decimals(result.report("importance")), f"{path}/importance")
    for name in (
        "base_vs_optimised",
        "confusions",
        "label_distribution",
        "label_stats",
        "cleaning_summary",
        "training_info",
        "misclassified",
        "tuning",
        "best_params",
        "roc",
        "roc_areas",
    ):
        write_report(result.report(name), f"{path}/{name}")
