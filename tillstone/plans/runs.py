"""Experiment runs and model versions, kept as a table next to the layers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators.features import FeatureModel
from tillstone.sources.layers import LayerStore
from tillstone.sources.paths import exists

_RUNS_DDL = (
    "run_id string, experiment string, status string, started_at timestamp, ended_at timestamp, "
    "params map<string,string>, metrics map<string,double>, row_counts map<string,bigint>, "
    "schemas map<string,string>, "
    "model_name string, model_version int, model_path string"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class RunLog:
    """Append-only table of finished and failed runs; a model is registered by its run's row."""

    def __init__(self, store: LayerStore):
        self.spark: SparkSession = store.spark
        self.store = store
        self.path = f"{store.root}/runs"

    def append(
        self,
        experiment: str,
        status: str,
        *,
        started_at: datetime,
        params: Mapping[str, str] | None = None,
        metrics: Mapping[str, float] | None = None,
        row_counts: Mapping[str, int] | None = None,
        schemas: Mapping[str, str] | None = None,
        model: tuple[str, int, str] | None = None,
    ) -> str:
        run_id = uuid.uuid4().hex
        name, version, path = model or (None, None, None)
        row = (
            run_id,
            experiment,
            status,
            started_at,
            utc_now(),
            dict(params or {}),
            {k: float(v) for k, v in (metrics or {}).items()},
            dict(row_counts or {}),
            dict(schemas or {}),
            name,
            version,
            path,
        )
        self.spark.createDataFrame([row], _RUNS_DDL).coalesce(1).write.mode("append").parquet(self.path)
        return run_id

    def read(self) -> DataFrame:
        return self.spark.read.schema(_RUNS_DDL).parquet(self.path)

    def params(self) -> DataFrame:
        """One row per run and parameter."""
        return self.read().select("run_id", F.explode("params").alias("name", "value"))

    def metrics(self) -> DataFrame:
        """One row per run and metric."""
        return self.read().select("run_id", F.explode("metrics").alias("name", "value"))

    def new_model_version(self, name: str) -> tuple[str, int, str]:
        """Name, version and directory for a model about to be saved."""
        path = self.store.next_path(f"models/{name}")
        return name, int(path.rsplit("/v", 1)[1]), path

    def load_model(self, name: str, version: int | None = None) -> tuple[FeatureModel, RandomForestRegressionModel]:
        """A registered model, the latest version unless one is given."""
        if not exists(self.spark, self.path):
            raise LookupError(f"no run was recorded under {self.store.root}")
        rows = self.read().where((F.col("model_name") == name) & (F.col("status") == "FINISHED"))
        if version is not None:
            rows = rows.where(F.col("model_version") == version)
        found = rows.orderBy(F.desc("model_version")).select("model_path", "params").first()
        if found is None:
            raise LookupError(f"no finished run registered model {name!r}" + (f" v{version}" if version else ""))
        features = FeatureModel.load(
            self.spark, f"{found.model_path}/features", found.params.get("handle_invalid", "error")
        )
        return features, RandomForestRegressionModel.load(f"{found.model_path}/forest")
