"""The whole flow: raw file to bronze, silver, gold and a registered model."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstone.operators.clean import clean, funnel_metrics
from tillstone.operators.gold import gold_by_country
from tillstone.operators.guards import require_any_column, require_columns, warn_if_empty
from tillstone.operators.training import TrainingOptions, evaluate, fit_forest, prepare
from tillstone.plans.runs import RunLog, utc_now
from tillstone.schema import GOLD_DDL, GOLD_INPUT_COLUMNS, REJECT_COLUMN, SILVER_DDL, bronze_ddl
from tillstone.sources.csv_files import read_retail_csv, with_audit
from tillstone.sources.layers import LayerStore, clustered
from tillstone.sources.paths import remove, scratch_dir

log = logging.getLogger(__name__)

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


@dataclass(frozen=True)
class FlowConfig:
    raw_path: str
    root: str
    dialect: str = "spark"
    strict_header: bool = False
    price_type: str = "float"
    id_type: str = "float"
    reject_nan_price: bool = False
    keep_rejects: bool = False
    approx_distinct: bool = False
    partition_gold: bool = True
    ingested_at: datetime | None = None
    experiment: str = "quantity_prediction"
    model_name: str = "quantity_forest"
    training: TrainingOptions = field(default_factory=TrainingOptions)


@dataclass(frozen=True)
class FlowReport:
    funnel: dict[str, int]
    run_id: str
    rows: dict[str, int]


def ingest(store: LayerStore, cfg: FlowConfig) -> dict[str, int]:
    """Raw file to bronze. The counts of every cleaning step are taken while writing."""
    raw = read_retail_csv(
        store.spark,
        cfg.raw_path,
        dialect=cfg.dialect,
        strict_header=cfg.strict_header,
        price_type=cfg.price_type,
        id_type=cfg.id_type,
        keep_rejects=cfg.keep_rejects,
    )
    funnel = Observation("cleaning_funnel")
    audited = with_audit(raw, cfg.ingested_at)
    counted = audited.observe(funnel, *funnel_metrics(audited, reject_nan_price=cfg.reject_nan_price))
    store.overwrite(BRONZE, counted)
    return funnel.get


def read_bronze(store: LayerStore, cfg: FlowConfig) -> DataFrame:
    """The declared columns that bronze has, in the types that it was written with."""
    return store.read(BRONZE, bronze_ddl(cfg.price_type, cfg.id_type), missing="drop", stored_types=True)


def read_rejects(store: LayerStore, cfg: FlowConfig) -> DataFrame:
    """Bronze rows with the line that did not parse, for an ingest that keeps rejects.

    The lines are a column of bronze, so the raw files are parsed and written once; the null test skips all row
    groups without a reject.
    """
    ddl = f"{bronze_ddl(cfg.price_type, cfg.id_type)}, {REJECT_COLUMN} string"
    return store.read(BRONZE, ddl, stored_types=True).where(F.col(REJECT_COLUMN).isNotNull())


def read_silver(store: LayerStore) -> DataFrame:
    """The declared columns that silver has; what reads it checks for those that it needs."""
    return store.read(SILVER, SILVER_DDL, missing="drop")


def read_gold(store: LayerStore) -> DataFrame:
    return store.read(GOLD, GOLD_DDL)


def _counted(df: DataFrame, layer: str) -> tuple[DataFrame, Observation]:
    rows = Observation(f"{layer}_rows")
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def build_silver(store: LayerStore, cfg: FlowConfig) -> int:
    """Clean stored bronze into silver; returns the rows written, counted by the write itself."""
    bronze = read_bronze(store, cfg)
    require_any_column(bronze, SILVER)
    warn_if_empty(bronze, SILVER)
    rows, counted = _counted(clean(bronze, reject_nan_price=cfg.reject_nan_price), SILVER)
    store.overwrite(SILVER, rows, rebalance_by=("Country",))
    log.info("silver has %s rows", counted.get["rows"])
    return counted.get["rows"]


def build_gold(store: LayerStore, cfg: FlowConfig) -> int:
    """Aggregate stored silver and write the result laid out by revenue, once; returns the rows written."""
    silver = read_silver(store)
    require_columns(silver, GOLD_INPUT_COLUMNS, GOLD)
    split = ("Country",) if cfg.partition_gold else ()
    placed = clustered(gold_by_country(silver, approx=cfg.approx_distinct), ("TotalRevenue",), split)
    rows, counted = _counted(placed, GOLD)  # above the sampling of ranges, which reads rows too
    store.overwrite(GOLD, rows, partition_by=split)
    log.info("gold has %s rows", counted.get["rows"])
    return counted.get["rows"]


def train(store: LayerStore, cfg: FlowConfig) -> str:
    """Fit, score, save and record one model from silver alone; returns the run's id.

    The schemas are those of the stored layers that exist. Without rows nothing
    is fitted and the run is recorded as FAILED. Whatever raises after the
    start, reads included, is recorded as FAILED and raised again.
    """
    runs = RunLog(store)
    options = cfg.training
    run = {"started_at": utc_now(), "params": options.all_params()}
    rows_path = scratch_dir(store.spark, "training")
    try:
        stored = {layer: store.stored_schema(layer) for layer in (BRONZE, SILVER, GOLD) if store.has(layer)}
        run["schemas"] = {layer: schema.json() for layer, schema in stored.items() if schema is not None}
        silver = read_silver(store)
        if warn_if_empty(silver, "train"):
            return runs.append(cfg.experiment, "FAILED", **run)
        name, version, path = runs.new_model_version(cfg.model_name)
        data = prepare(silver, options, f"{path}/features", rows_path)
        forest = fit_forest(data.train, options)
        counts = {
            SILVER: silver.count(),
            "train": data.train.count(),
            "test": data.test.count(),
        }
        if store.has(GOLD):
            counts[GOLD] = read_gold(store).count()
        metrics = evaluate(forest.transform(data.test)).first().asDict()
        data.features.save(f"{path}/features")
        forest.write().save(f"{path}/forest")
    except Exception:
        runs.append(cfg.experiment, "FAILED", **run)
        raise
    finally:
        remove(store.spark, rows_path)
    known = {k: v for k, v in metrics.items() if v is not None}
    return runs.append(cfg.experiment, "FINISHED", metrics=known, row_counts=counts, model=(name, version, path), **run)


def run_flow(spark: SparkSession, cfg: FlowConfig) -> FlowReport:
    """All stages in order; an exception stops the run."""
    store = LayerStore(spark, cfg.root)
    funnel = ingest(store, cfg)
    rows = {SILVER: build_silver(store, cfg), GOLD: build_gold(store, cfg)}
    return FlowReport(funnel, train(store, cfg), rows)
