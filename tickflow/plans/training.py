"""Train, evaluate and gate a forecast model on accumulated gold rows."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.operators import modelling
from tickflow.operators.modelling import TreeSpec
from tickflow.spec import BarSpec

MODELS = ("persistence", "har", "trees")
CANDIDATE = "trees"


@dataclass(frozen=True)
class Run:
    """Outcome of one training run; ``record`` is one row for the run table."""

    status: str
    record: DataFrame | None = None
    metrics: DataFrame | None = None
    skills: DataFrame | None = None
    decision: DataFrame | None = None
    har: PipelineModel | None = None
    trees: PipelineModel | None = None


def train(
    gold_rows: DataFrame,
    versions: DataFrame,
    spec: BarSpec = BarSpec(),
    tree_spec: TreeSpec = TreeSpec(),
) -> Run:
    """All three models are judged on the identical purged test rows.

    ``versions`` is the registry: one row per promoted version. If it cannot be
    read the caller must not pass an empty one, which would promote anything.
    """
    rows = modelling.prepare(gold_rows, spec)
    if not modelling.enough_rows(rows, spec):
        return Run("insufficient_data")
    train_part, test_part, cut = modelling.time_split(rows, spec)
    har = modelling.fit_har(train_part)
    trees = modelling.fit_trees(train_part, tree_spec)
    metrics = modelling.evaluate(modelling.forecast(test_part, har, trees), MODELS)
    skills = modelling.model_skill(metrics)
    decision = modelling.promotion(skills, versions, CANDIDATE, spec)
    names = rows.agg(F.array_join(F.array_sort(F.collect_set("product_id")), ",").alias("p"))
    params = {
        **{k: str(v) for k, v in asdict(tree_spec).items()},
        "features": ",".join((*schemas.FEATURES, "product_id")),
        "split_cut": str(cut),
        "n_train": str(train_part.count()),
        "n_test": str(test_part.count()),
        "products": names.first().p,
        "promotion_min_skill": str(spec.promotion_min_skill),
    }
    record = decision.select(
        F.lit(json.dumps(params)).alias("params"),
        "skill",
        "mae",
        "rmse",
        "status",
        "reason",
        "version",
    )
    return Run(
        decision.first().status, record, metrics, skills, decision, har=har, trees=trees
    )
