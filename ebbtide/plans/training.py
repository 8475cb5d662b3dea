"""A whole training as one unit: split, fit, measure, log, save, publish."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators import evaluation
from ebbtide.operators.splitting import stratified_split
from ebbtide.plans import models
from ebbtide.plans.runs import FAILED, RunStore
from ebbtide.session import written


def run_training(store: RunStore, df: DataFrame, numeric, categorical, key: str, label: str = "label",
                 names=models.MODEL_TYPES, experiment: str = "training", test_size: float = 0.2, seed: int = 42,
                 folds: int = 3, tuned: bool = True, params: dict | None = None, grids: dict | None = None, at: datetime | None = None,
                 training_id: str | None = None, **options) -> DataFrame:
    """Train every model type and give back the training's summary, read from the store.

    Rows are split by class, each type is fitted (with its search, if ``tuned``) and measured on the test
    side. Every run leaves its settings, the fold means and deviations of all measures, its test
    measures and its model. Its rows go to the store as soon as it is through, but count only from the
    manifest on, which is written when all are. Where a type fails, the manifest says ``failed`` with the
    message, none of the runs counts, and the error is raised; where the process dies, there is no
    manifest and none counts either. ``params`` holds fixed settings and
    ``grids`` what to search by model type (the library's own grids where absent).
    """
    training_id, at = training_id or uuid.uuid4().hex, at or datetime.now()
    logged = []
    try:
        # written, or every pass of every fit would look for the split's limits again
        split = written(stratified_split(df.where(F.col(label).isNotNull()), key, label, test_size, seed), "training")
        train_df, test_df = split.where("split = 'train'"), split.where("split = 'test'")
        for name in names:
            fixed = (params or {}).get(name)
            result = models.train(train_df, test_df, name, numeric, categorical, key, label, tuned=tuned,
                                  folds=folds, params=fixed, grid=(grids or {}).get(name), **options)
            settings = {"model_type": result.model_type, "hyperparameter_tuning": tuned, "cv_folds": folds,
                        "random_state": seed, "test_size": test_size}
            settings |= {f"best_{k}": v for k, v in result.params.items()}
            measured = {f"test_{m}": result.metrics.get(m) for m in evaluation.MEASURES} | result.folds
            run_id = f"{training_id}-{result.model_type}"
            logged.append(run_id)
            store.log_run(experiment, result.model_type, measured, settings, result.seconds, at, run_id=run_id, publish=False)
            store.save_model(result.model, result.model_type, run_id, at)
    except Exception as error:
        store.publish(training_id, experiment, logged, at, FAILED, str(error))
        raise
    store.publish(training_id, experiment, logged, at)
    return store.summary(training_id)
