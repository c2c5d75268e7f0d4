"""Purged splits, baselines, boosted trees, evaluation and the promotion gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import floor_div, micros
from tickflow.functions.flow import skill
from tickflow.operators.ordered import over_chunks, running_sum
from tickflow.session import materialize
from tickflow.spec import BarSpec

KEYS = ("product_id", "as_of_ts")
DAY_US = 86_400_000_000


def train_rows(gold_rows: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Gold rows fit for training: well covered, with label and persistence."""
    return gold_rows.where(
        (F.col("bar_count_5m") >= spec.train_coverage)
        & (F.col("label_bar_count") >= spec.train_coverage)
    ).dropna(subset=[schemas.LABEL, "rv_5m"])


def split_cut(rows: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row: the distinct as_of_ts at position int(n * (1 - test_fraction)).

    Positions come from per-day counts, so no task sorts the whole time line.
    """
    stamps = (
        rows.select("as_of_ts")
        .distinct()
        .withColumns(
            {
                "_all": F.lit(0),
                "_one": F.lit(1),
                "_day": floor_div(micros("as_of_ts"), DAY_US),
            }
        )
    )
    n = stamps.count()
    at = int(n * (1 - spec.test_fraction))
    ranked = over_chunks(stamps, "_all", "as_of_ts", "_day", [running_sum("_one", "position")])
    return ranked.where(F.col("position") == at + 1).select(F.col("as_of_ts").alias("cut"))


def time_split(
    rows: DataFrame, spec: BarSpec = BarSpec()
) -> tuple[DataFrame, DataFrame, datetime | None]:
    """(train, test, cut). A row whose label window crosses the cut is in neither."""
    found = split_cut(rows, spec).first()
    if found is None:
        return rows, rows, None
    cut = found.cut
    at = F.lit(cut).cast("timestamp_ntz")
    return rows.where(F.col("label_ts") <= at), rows.where(F.col("as_of_ts") >= at), cut


def feature_vector(rows: DataFrame) -> DataFrame:
    """The model's inputs in fixed order, all DOUBLE, missing values as NaN."""
    nan = F.lit(float("nan"))
    return rows.select(
        *KEYS, *[F.coalesce(F.col(c).cast("double"), nan).alias(c) for c in schemas.FEATURES]
    )


def with_persistence(rows: DataFrame) -> DataFrame:
    """Persistence forecast: the next window is as volatile as the last."""
    return rows.withColumn("persistence", F.col("rv_5m"))


def har_inputs(rows: DataFrame) -> DataFrame:
    """Lags for least squares: a window without any return did not move (0)."""
    return rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) for c in schemas.HAR_FEATURES}
    )


def har_moments(rows: DataFrame) -> DataFrame:
    """Cross products of (1, lags, label): all that least squares needs."""
    names = [*schemas.HAR_FEATURES, schemas.LABEL]
    usable = har_inputs(rows).dropna(subset=[schemas.LABEL])
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(c).alias(f"s_{c}") for c in names]
    sums += [
        F.sum(F.col(a) * F.col(b)).alias(f"s_{a}_{b}")
        for i, a in enumerate(names)
        for b in names[i:]
    ]
    return usable.agg(*sums)


def _assemble(columns: Sequence[str], out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error")


def fit_har(rows: DataFrame) -> PipelineModel:
    """Least squares of the label on lagged volatilities, solved in closed form."""
    usable = har_inputs(rows).dropna(subset=[schemas.LABEL])
    line = LinearRegression(
        featuresCol="har_vector",
        labelCol=schemas.LABEL,
        predictionCol="har",
        solver="normal",
        regParam=0.0,
    )
    return Pipeline(stages=[_assemble(schemas.HAR_FEATURES, "har_vector"), line]).fit(usable)


def har_coefficients(model: PipelineModel) -> dict[str, float]:
    line: LinearRegressionModel = model.stages[-1]
    named = dict(zip(schemas.HAR_FEATURES, (float(c) for c in line.coefficients), strict=True))
    return {**named, "intercept": float(line.intercept)}


@dataclass(frozen=True)
class TreeSpec:
    """Boosted-tree settings (fixed values of the forecast model).

    Depth 4 gives at most 16 leaves per tree.
    """

    trees: int = 300
    learning_rate: float = 0.05
    depth: int = 4
    min_leaf_rows: int = 10
    row_share: float = 0.9
    feature_share: float = 0.8
    seed: int = 7


# Spark's trees take no missing values: NULL becomes 0 plus an indicator.
NULLABLE = ("depth_imb_5m", "taker_imb_5m")
TREE_INPUTS = (*schemas.FEATURES, *[f"{c}_missing" for c in NULLABLE], "product_index")


def tree_inputs(rows: DataFrame) -> DataFrame:
    flags = {f"{c}_missing": F.col(c).isNull().cast("double") for c in NULLABLE}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in schemas.FEATURES}
    return rows.withColumns(flags).withColumns(filled)


def fit_trees(rows: DataFrame, spec: TreeSpec = TreeSpec()) -> PipelineModel:
    """One pooled model; the product is a categorical input."""
    index = StringIndexer(
        inputCol="product_id", outputCol="product_index", handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    trees = GBTRegressor(
        featuresCol="tree_vector",
        labelCol=schemas.LABEL,
        predictionCol="trees",
        maxIter=spec.trees,
        stepSize=spec.learning_rate,
        maxDepth=spec.depth,
        minInstancesPerNode=spec.min_leaf_rows,
        subsamplingRate=spec.row_share,
        featureSubsetStrategy=str(spec.feature_share),
        seed=spec.seed,
    )
    return Pipeline(stages=[index, _assemble(TREE_INPUTS, "tree_vector"), trees]).fit(
        tree_inputs(rows)
    )


def forecast(rows: DataFrame, har: PipelineModel, trees: PipelineModel) -> DataFrame:
    """Test rows with one column per model."""
    # The original columns ride along, so both models see their own inputs.
    kept = with_persistence(rows).withColumn("row", F.struct("*"))
    lined = har.transform(har_inputs(kept)).select("row.*", "har")
    kept = lined.withColumn("row", F.struct("*"))
    return trees.transform(tree_inputs(kept)).select("row.*", "trees")


def evaluate(scored: DataFrame, models: Sequence[str], label: str = schemas.LABEL) -> DataFrame:
    """MAE and RMSE per model, overall (product NULL) and per product."""
    pairs = ", ".join(f"'{m}', `{m}`" for m in models)
    long = scored.select(
        "product_id",
        F.col(label).alias("y"),
        F.expr(f"stack({len(models)}, {pairs}) AS (model, forecast)"),
    )
    error = F.col("y") - F.col("forecast")
    model, product = F.col("model"), F.col("product_id")
    return (
        long.groupingSets([[model], [model, product]], model, product)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        )
        .select("model", "product_id", "n", "mae", "rmse")
    )


def model_skill(metrics: DataFrame, baseline: str = "persistence") -> DataFrame:
    """Overall skill of every model against the baseline."""
    overall = metrics.where(F.col("product_id").isNull())
    base = overall.where(F.col("model") == baseline).select(F.col("mae").alias("base_mae"))
    return overall.select(
        "model", "mae", "rmse", skill(F.col("mae"), base.scalar()).alias("skill")
    )


def metric_names(metrics: DataFrame) -> DataFrame:
    """Long (metric, value) rows; dashes in product names become underscores."""
    suffix = F.concat(F.lit("_"), F.replace("product_id", F.lit("-"), F.lit("_")))
    named = metrics.select(
        "model",
        "product_id",
        F.expr("stack(2, 'mae', mae, 'rmse', rmse) AS (kind, value)"),
    ).where(F.col("product_id").isNull() | (F.col("kind") == "mae"))
    return named.select(
        F.concat("model", F.lit("_"), "kind", F.coalesce(suffix, F.lit(""))).alias("metric"),
        "value",
    )


def importances(model: PipelineModel, spark) -> DataFrame:
    """Input columns by importance, largest first."""
    values = model.stages[-1].featureImportances
    rows = [(name, float(values[i])) for i, name in enumerate(TREE_INPUTS)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def champion(versions: DataFrame) -> Column:
    """The newest registered version serves."""
    return F.max(F.col("version").cast("long"))


def promotion(
    skills: DataFrame, versions: DataFrame, candidate: str, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Decision row: promoted when skill passes the gate or nothing serves yet."""
    incumbent = versions.agg(champion(versions).alias("incumbent"))
    decided = skills.where(F.col("model") == candidate).withColumn(
        "incumbent", incumbent.scalar()
    )
    first = F.col("incumbent").isNull()
    passed = F.coalesce(F.col("skill") >= spec.promotion_min_skill, F.lit(False))
    return decided.withColumns(
        {
            "status": F.when(passed | first, "promoted").otherwise("rejected"),
            "reason": F.when(first, "bootstrap").otherwise("skill_gate"),
            "version": F.when(passed | first, F.coalesce("incumbent", F.lit(0)) + 1),
        }
    )


def products(rows: DataFrame) -> DataFrame:
    return rows.select("product_id").distinct().orderBy("product_id")


def enough_rows(rows: DataFrame, spec: BarSpec = BarSpec()) -> bool:
    """Whether there are enough rows to train on, without counting them all."""
    return rows.limit(spec.min_train_rows).count() >= spec.min_train_rows


def prepare(gold_rows: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Training rows as a written table: every boosting round reads them again."""
    return materialize(train_rows(gold_rows, spec), "train-rows")
