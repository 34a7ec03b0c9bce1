"""Splits, weights, Spark ML pipelines, tuning and cross-validated figures."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from math import fsum
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.functions.scalars import numpy_round
from stayline.operators.ordering import attach
from stayline.plans.binned import binned
from stayline.plans.boosting import GBTClassifier
from stayline.plans.evaluation import balanced_weights, class_balance, model_metrics
from stayline.plans.features import fit_fills, impute
from stayline.plans.forests import ForestModel, RandomForestClassifier
from stayline.plans.trees import first_rounds, gathered
from stayline.session import ensure_checkpoint_dir

SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
# The tuning grids. Spark caps tree depth at 30, which stands for "no limit".
FOREST_GRID = {
    "numTrees": [100, 200],
    "maxDepth": [30, 10, 20],
    "minInstancesPerNode": [1, 5],
}
BOOST_GRID = {
    "maxIter": [100, 200],
    "maxDepth": [3, 5, 7],
    "stepSize": [0.05, 0.1],
    "subsamplingRate": [0.8, 1.0],
}
# The parameter that counts boosting rounds.
ROUNDS = "maxIter"
# The parameters of a forest whose smaller values are beginnings of a larger forest: its number of trees, their depth.
TREES = "numTrees"
DEPTH = "maxDepth"
# The parameter that says how features are binned.
BINS = "maxBins"
# Every id hashes to one of 65,536 buckets.
_BUCKET_DIGITS = 4


# --- stratified splits -------------------------------------------------------


def _shuffle_key(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def _in_buckets(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add a hash of the id and the bucket its leading hex digits name."""
    return df.withColumn("_hash", _shuffle_key(key, seed)).withColumn(
        "_bucket", F.conv(F.substring("_hash", 1, _BUCKET_DIGITS), 16, 10).cast("int")
    )


def _bucket_starts(keyed: DataFrame, label: str) -> DataFrame:
    """Rows of a class before each bucket, and in the class: at most a row per bucket."""
    sizes = keyed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(label)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        label,
        "_bucket",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_size").over(whole).alias("n_class"),
    )


def _with_class_rank(keyed: DataFrame, starts: DataFrame, label: str, key: str) -> DataFrame:
    """Rank 1..n_class of each row within its class, in the order of the hash.

    One class can hold most of the table, so it is not ranked as one window
    partition: the buckets of a class are equally full, rows are ranked inside
    their bucket, and the rows of earlier buckets are added.
    """
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash", key)
    return (
        keyed.withColumn("_within", F.row_number().over(inside))
        .join(starts, [label, "_bucket"])
        .withColumn("class_rank", F.col("_start") + F.col("_within"))
        .drop("_hash", "_bucket", "_within", "_start", "n_class")
    )


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def quotas(sizes: DataFrame, label: str, share: float = TEST_SHARE) -> DataFrame:
    """Test rows per class, from a row per class.

    The total is rounded up, classes get their share of it, and the rows left over go
    to the largest remainders (the lower label on a tie).
    """
    everyone = Window.partitionBy()
    exact = F.col("n_class") * F.col("n_test") / F.col("n")
    leftover = Window.orderBy(F.desc("remainder"), F.asc(label))
    extra = (F.row_number().over(leftover) <= F.col("open")).cast("int")
    return (
        sizes.withColumn("n", F.sum("n_class").over(everyone))
        .withColumn("n_test", F.ceil(F.col("n") * F.lit(share)))
        .withColumn("floor", F.floor(exact))
        .withColumn("remainder", exact - F.col("floor"))
        .withColumn("open", F.col("n_test") - F.sum("floor").over(everyone))
        .select(label, "n_class", (F.col("floor") + extra).cast("bigint").alias("quota"))
    )


def stratified_split(
    df: DataFrame,
    label: str = "churned",
    share: float = TEST_SHARE,
    seed: int = SEED,
    key: str = "account_id",
) -> DataFrame:
    """Add ``is_test``: exact class quotas, the same rows on every run."""
    keyed = _in_buckets(df, key, seed)
    starts = _bucket_starts(keyed, label)
    allowed = quotas(starts.select(label, "n_class").distinct(), label, share).drop("n_class")
    # Two quota rows for a 0/1 label.
    limits = starts.join(F.broadcast(allowed), label)
    return (
        _with_class_rank(keyed, limits, label, key)
        .withColumn("is_test", F.col("class_rank") <= F.col("quota"))
        .drop("class_rank", "quota")
    )


def stratified_folds(
    df: DataFrame,
    label: str = "churned",
    k: int = FOLDS,
    seed: int = SEED,
    key: str = "account_id",
) -> DataFrame:
    """Add ``fold`` 0..k-1. Classes are dealt out one after the other, so neither the
    folds nor a class over the folds differ by more than one row."""
    keyed = _in_buckets(df, key, seed + 1)
    starts = _bucket_starts(keyed, label)
    earlier = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    # One row per class.
    dealt = (
        starts.select(label, "n_class")
        .distinct()
        .select(label, F.coalesce(F.sum("n_class").over(earlier), F.lit(0)).alias("_dealt"))
    )
    limits = starts.join(F.broadcast(dealt), label)
    return (
        _with_class_rank(keyed, limits, label, key)
        .withColumn("fold", ((F.col("_dealt") + F.col("class_rank") - 1) % k).cast("int"))
        .drop("class_rank", "_dealt")
    )


# --- scaling -----------------------------------------------------------------


def scaling_figures(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, one row."""
    return train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"std_{c}") for c in columns],
    )


def standardize(df: DataFrame, figures: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores with figures learnt elsewhere; a constant column becomes 0."""
    row = attach(df, figures)
    scaled = {}
    for c in columns:
        spread = F.when(F.col(f"std_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"std_{c}"))
        scaled[c] = (F.col(c).cast("double") - F.col(f"mean_{c}")) / spread
    return row.withColumns(scaled).drop(*figures.columns)


def population_scaler(figures: DataFrame, columns: Sequence[str]) -> StandardScalerModel:
    """The scaling of ``standardize`` as a stage that is stored with a model: z-scores of a vector with the figures'
    means and population deviations (Spark's own estimator divides by n - 1). One row of figures comes to the driver."""
    row = figures.first()
    spread, middle = (Vectors.dense([row[f"{kind}_{c}"] or 0.0 for c in columns]) for kind in ("std", "mean"))
    context = figures.sparkSession.sparkContext
    java = context._jvm.org.apache.spark.ml.feature.StandardScalerModel
    model = StandardScalerModel(java(f"population_{uuid.uuid4().hex[:12]}", _py2java(context, spread), _py2java(context, middle)))
    return model._set(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)


# --- weights -----------------------------------------------------------------


def with_balanced_weight(df: DataFrame, label: str = "churned") -> DataFrame:
    """n / (2 n_class) per row; the weight table has one row per class."""
    weights = balanced_weights(df, label).select(label, F.col("class_weight").alias("weight"))
    return df.join(F.broadcast(weights), label)


def positive_weight(df: DataFrame, label: str = "churned") -> float:
    """Negatives per positive, to two decimals (one number)."""
    return class_balance(df, label).first()["neg_per_pos"]


def with_positive_weight(df: DataFrame, weight: float, label: str = "churned") -> DataFrame:
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))


# --- estimators --------------------------------------------------------------


def logistic(n_train: int, c: float = 1.0, max_iter: int = 1000, label: str = "churned") -> LogisticRegression:
    """L2 logistic regression whose penalty matches ``C`` on population-scaled columns.

    Spark averages the weighted loss, so the penalty is divided by the weight total (n
    under balanced weights).
    """
    return LogisticRegression(
        labelCol=label,
        weightCol="weight",
        regParam=1 / (c * n_train),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    )


def forest(label: str = "churned", seed: int = SEED, **params) -> RandomForestClassifier:
    """Random forest whose trees are grown in parts and never come to the driver (``forests``)."""
    return RandomForestClassifier(labelCol=label, weightCol="weight", seed=seed, **params)


def boosted(label: str = "churned", seed: int = SEED, **params) -> GBTClassifier:
    """Gradient-boosted trees; a small table is fitted in one job (``boosting``)."""
    return GBTClassifier(labelCol=label, weightCol="weight", seed=seed, **params)


def predict(model, df: DataFrame) -> DataFrame:
    """Add ``churn_proba`` and the 0/1 ``prediction``."""
    return (
        model.transform(df)
        .withColumn("churn_proba", vector_to_array("probability")[1])
        .withColumn("prediction", F.col("prediction").cast("int"))
    )


# --- tuning and cross-validation ---------------------------------------------


@dataclass
class Tuned:
    model: object
    best: dict
    trials: DataFrame


def param_grid(estimator: Estimator, grid: dict[str, list]) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def grid_search(
    estimator: Estimator,
    grid: dict[str, list],
    train: DataFrame,
    label: str = "churned",
    parallelism: int = 8,
) -> Tuned:
    """Best parameters by mean exact ROC-AUC over the ``fold`` column, refitted on all rows.

    Points that differ in their boosting rounds, or in a forest's number or depth of trees only, share one fit per fold,
    that of the most: the others are its beginnings (``first_rounds``, ``first_trees``, ``first_levels``). The rows are
    put into few partitions and held once for all fits, and the rows of a fold are binned once; fits are independent jobs
    and are submitted side by side, those of the deepest trees first. What is stored of a forest is deleted once it is
    judged.
    """
    ensure_checkpoint_dir(train.sparkSession)
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    beginning = (TREES, DEPTH) if isinstance(estimator, RandomForestClassifier) else (ROUNDS,)
    shared: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        shared.setdefault(tuple((k, v) for k, v in point.items() if k not in beginning), []).append(i)
    # numBins=0 keeps every distinct score; the default would sample the curve.
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    rows = gathered(train.select("features", label, "weight", "fold")).persist(StorageLevel.MEMORY_AND_DISK)

    def with_params(point: dict) -> Estimator:
        return estimator.copy({estimator.getParam(k): v for k, v in point.items()})

    def longest(mine: list[int]) -> Estimator:
        return with_params(points[mine[0]] | {k: max(points[i][k] for i in mine) for k in beginning if k in grid})

    def beginnings(model, mine: list[int]) -> dict:
        if isinstance(model, ForestModel):
            depths = {depth: model.first_levels(depth) for depth in {points[i].get(DEPTH, model.settings.depth) for i in mine}}
            return {i: depths[points[i].get(DEPTH, model.settings.depth)].first_trees(points[i].get(TREES, model.getNumTrees)) for i in mine}
        if ROUNDS in grid:
            return {i: first_rounds(model, points[i][ROUNDS]) for i in mine}
        return dict.fromkeys(mine, model)

    @inheritable_thread_target(train.sparkSession)
    def fit(job: tuple[int, list[int]]) -> list[tuple[int, float]]:
        fold, mine = job
        model = longest(mine).fit(ready[fold])
        held = rows.where(F.col("fold") == fold)
        models = beginnings(model, mine)
        found = [(i, judge.evaluate(m.transform(held))) for i, m in models.items()]
        if isinstance(model, ForestModel):
            for m in {m.path: m for m in [model, *models.values()]}.values():
                m.discard()
        return found

    @inheritable_thread_target(train.sparkSession)
    def binned_fold(fold: int):
        seen = rows.where(F.col("fold") != fold)
        return binned(estimator, seen) if isinstance(estimator, RandomForestClassifier | GBTClassifier) and BINS not in grid else seen

    try:
        folds = rows.agg(F.max("fold")).first()[0] + 1
        jobs = [(fold, mine) for mine in shared.values() for fold in range(folds)]
        jobs.sort(key=lambda job: -points[job[1][0]].get("maxDepth", 0))
        with ThreadPool(parallelism) as pool:
            ready = pool.map(binned_fold, range(folds))
            found = [pair for pairs in pool.imap_unordered(fit, jobs) for pair in pairs]
        scores = [fsum(auc for i, auc in found if i == k) / folds for k in range(len(points))]
        winner = max(range(len(scores)), key=scores.__getitem__)
        best = with_params(points[winner]).fit(rows)
    finally:
        rows.unpersist()
    columns = ", ".join(["trial int", *[f"{name} double" for name in grid], "cv_roc_auc double"])
    table = [(i, *[float(v) for v in point.values()], scores[i]) for i, point in enumerate(points)]
    return Tuned(best, points[winner], train.sparkSession.createDataFrame(table, columns))


def out_of_fold(
    estimator: Estimator, train: DataFrame, label: str = "churned", parallelism: int = FOLDS
) -> DataFrame:
    """Each row scored by a model that has not seen its fold.

    The rows are checkpointed, as every fold reads them for its fit and its scores.
    The fits are independent jobs and are submitted side by side; rows are scored once.
    """
    ensure_checkpoint_dir(train.sparkSession)
    rows = gathered(train.select("account_id", "features", label, "weight", "fold").checkpoint())
    folds = range(rows.agg(F.max("fold")).first()[0] + 1)

    @inheritable_thread_target(rows.sparkSession)
    def fit(fold: int):
        return estimator.fit(rows.where(F.col("fold") != fold))

    with ThreadPool(parallelism) as pool:
        models = pool.map(fit, folds)
    held = [predict(model, rows.where(F.col("fold") == fold)) for fold, model in zip(folds, models)]
    columns = ["account_id", label, "fold", "churn_proba", "prediction"]
    return reduce(DataFrame.unionByName, [part.select(*columns) for part in held]).checkpoint()


def fold_metrics(held_out: DataFrame, label: str = "churned") -> DataFrame:
    """Figures per fold, all folds in one evaluation."""
    return model_metrics(held_out, label, "churn_proba", ["fold"], strictly_above=True)


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation of each figure over the folds."""
    figures = ("roc_auc", "f1", "precision", "recall")
    one = per_fold.agg(
        *[
            F.struct(F.avg(m).alias("mean"), F.stddev_pop(m).alias("std")).alias(m)
            for m in figures
        ]
    )
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in figures]
    return one.select(F.explode(F.array(*rows)).alias("r")).select(
        F.col("r.metric").alias("metric"), F.col("r.v.mean").alias("mean"), F.col("r.v.std").alias("std")
    )


def comparison_row(name: str, test_metrics: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of the comparison table, figures to three decimals."""
    auc = summary.where("metric = 'roc_auc'").select(
        F.col("mean").alias("cv_roc_auc_mean"), F.col("std").alias("cv_roc_auc_std")
    )
    whole = attach(test_metrics, auc)
    figures = (
        "roc_auc",
        "average_precision",
        "f1",
        "precision",
        "recall",
        "cv_roc_auc_mean",
        "cv_roc_auc_std",
    )
    return whole.select(
        F.lit(name).alias("model"), *[numpy_round(F.col(c), 3).alias(c) for c in figures]
    )


# --- model tables ------------------------------------------------------------


def coefficient_table(model, names: Sequence[str]) -> DataFrame:
    """Feature and coefficient, on population-scaled columns."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, coefficient double")


def penalised_gradient(model, train: DataFrame, names: Sequence[str], label: str = "churned") -> DataFrame:
    """Slope of the fitted loss in each coefficient and in the intercept, one pass over the rows.

    The loss is the weighted mean of the log loss plus half the penalty times the squared coefficients. All slopes are
    zero at its minimum, so this says whether a fit has arrived, whoever made it.
    """
    scored = predict(model, train).select("weight", vector_to_array("features").alias("x"), (F.col("churn_proba") - F.col(label)).alias("off"))
    pull = F.col("weight") * F.col("off")
    sums = scored.agg(
        F.sum("weight").alias("whole"),
        F.sum(pull).alias("of_intercept"),
        *[F.sum(pull * F.col("x")[j]).alias(f"of_{j}") for j in range(len(names))],
    )
    penalty = model.getRegParam()
    slopes = [(n, F.col(f"of_{j}") / F.col("whole") + F.lit(penalty * float(c))) for j, (n, c) in enumerate(zip(names, model.coefficients.toArray()))]
    slopes.append(("intercept", F.col("of_intercept") / F.col("whole")))
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), slope.alias("gradient")) for n, slope in slopes])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def margins_from_table(rows: DataFrame, coefficients: DataFrame, intercept: float, figures: DataFrame, names: Sequence[str]) -> DataFrame:
    """account_id and probability of a logistic model from its coefficient table and the scaling figures (one row)."""
    # One row per feature.
    table = {r["feature"]: r["coefficient"] for r in coefficients.collect()}
    scaled = standardize(rows, figures, names)
    margin = reduce(Column.__add__, [F.col(n) * F.lit(table[n]) for n in names], F.lit(intercept))
    return scaled.select("account_id", (1 / (1 + F.exp(-margin))).alias("p"))


def importance_table(model, names: Sequence[str]) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def strongest(coefficients: DataFrame, k: int = 15) -> DataFrame:
    """The k lowest and the k highest coefficients, each once."""
    low = coefficients.orderBy("coefficient", "feature").limit(k)
    high = coefficients.orderBy(F.desc("coefficient"), "feature").limit(k)
    return low.unionByName(high).dropDuplicates()


# --- preparation and pipelines -------------------------------------------------


def fit_vectors(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Assembler and scaler, learnt on the training rows only, in one pass."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="raw_features")
    return PipelineModel(stages=[assembler, population_scaler(scaling_figures(train, columns), columns)])


def fill_stage(fills: dict[str, float]) -> SQLTransformer:
    """The learnt replacement values as a stage that is stored with the model."""
    filled = ", ".join(f"coalesce(cast({c} as double), {v!r}D) AS {c}" for c, v in fills.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(fills)}), {filled} FROM __THIS__")


def bundle(vectors: PipelineModel, model, fills: dict[str, float] | None = None) -> PipelineModel:
    """Imputation, assembler, scaler and classifier as one model to store and score with."""
    first = [fill_stage(fills)] if fills else []
    return PipelineModel(stages=[*first, *vectors.stages, model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class Prepared:
    """Split and imputed rows with the scaled ``features`` vector."""

    train: DataFrame
    test: DataFrame
    everyone: DataFrame
    vectors: PipelineModel
    fills: dict
    n_train: int
    names: list


def prepare(
    features: DataFrame, names: Sequence[str], label: str = "churned", fit_on: str = "train"
) -> Prepared:
    """Split, impute, assemble and scale a feature table.

    ``features`` is a written table (a file or a checkpoint, as ``finished`` gives it), as the
    split reads it more than once. The split rows are checkpointed, once, for every fit and score. The imputed median comes from the training rows;
    ``fit_on="all"`` takes it from the whole table. Features the imputation rules do
    not name (no contract dates, an unknown tier) become 0: no account is left out.
    """
    ensure_checkpoint_dir(features.sparkSession)
    split = stratified_split(features, label).checkpoint()
    learnt = fit_fills(split.where("not is_test") if fit_on == "train" else split)
    fills = {**{name: 0.0 for name in names}, **learnt}
    filled = impute(split, fills)
    train = filled.where("not is_test")
    vectors = fit_vectors(train, names)
    everyone = vectors.transform(filled)
    return Prepared(
        everyone.where("not is_test"),
        everyone.where("is_test"),
        everyone,
        vectors,
        fills,
        train.count(),
        list(names),
    )
