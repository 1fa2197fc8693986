"""Run the flow, or one stage of it, with spark-submit.

    spark-submit main.py --raw "/data/raw/*.csv" --root /data/lake
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tillstone.operators.training import TrainingOptions
from tillstone.plans.medallion import FlowConfig, build_gold, build_silver, ingest, train
from tillstone.sources.csv_files import DIALECTS
from tillstone.sources.layers import LayerStore

STAGES = ("ingest", "etl", "train")


def parse(argv: list[str] | None = None) -> tuple[FlowConfig, tuple[str, ...]]:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True, help="raw CSV file, folder or glob")
    parser.add_argument("--root", required=True, help="folder of the layers, runs and models")
    parser.add_argument("--stage", choices=(*STAGES, "all"), default="all")
    parser.add_argument("--dialect", choices=sorted(DIALECTS), default="spark")
    parser.add_argument("--strict-header", action="store_true")
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--depth", type=int, default=15)
    parser.add_argument("--seed", type=int, default=42)
    args = parser.parse_args(argv)
    cfg = FlowConfig(
        args.raw,
        args.root,
        dialect=args.dialect,
        strict_header=args.strict_header,
        training=TrainingOptions(num_trees=args.trees, max_depth=args.depth, seed=args.seed),
    )
    return cfg, STAGES if args.stage == "all" else (args.stage,)


def run(spark: SparkSession, cfg: FlowConfig, stages: tuple[str, ...]) -> None:
    """The chosen stages in order; an exception stops the run."""
    log = logging.getLogger("tillstone")
    store = LayerStore(spark, cfg.root)
    if "ingest" in stages:
        log.info("row counts by cleaning step: %s", ingest(store, cfg))
    if "etl" in stages:
        log.info("silver rows: %s", build_silver(store, cfg))
        log.info("gold rows: %s", build_gold(store, cfg))
    if "train" in stages:
        log.info("run %s is recorded", train(store, cfg))


def main() -> None:
    cfg, stages = parse()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("tillstone").getOrCreate()
    try:
        run(spark, cfg, stages)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
