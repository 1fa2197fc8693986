"""One Spark query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators import clean as cleaning
from tillstone.operators.features import (
    FEATURE_COLUMNS,
    INDEXED,
    LABEL,
    assemble,
    fit_labels,
    index_all,
    index_column,
    recast_measures,
    with_split,
)
from tillstone.operators.forest import forest_nodes, leaf_means, with_walked_score
from tillstone.operators.gold import gold_by_country, line_revenue, sort_gold
from tillstone.operators.guards import require_any_column
from tillstone.operators.moments import MomentStore
from tillstone.operators.sketches import PARTIAL_DDL, gold_from_partials, gold_partials
from tillstone.operators.training import TrainingOptions, TrainingSet, evaluate, fit_forest, prepare
from tillstone.plans.medallion import (
    FlowConfig,
    build_gold,
    build_silver,
    ingest,
    read_bronze,
    read_gold,
    read_rejects,
    train,
)
from tillstone.plans.runs import RunLog
from tillstone.schema import AUDIT_COLUMN, GOLD_DDL, RAW_COLUMNS, REJECT_COLUMN, SILVER_DDL, bronze_ddl
from tillstone.sources.csv_files import read_retail_csv, with_audit, write_retail_csv
from tillstone.sources.layers import LayerStore, clustered, overlapping
from tillstone.sources.paths import scratch_dir
from tillstone.sources.star import retail_from_star, star_table
from tillstone.sources.synthetic import retail_from_ids

INGESTED_AT = datetime(2024, 1, 1)
LINE = "l_linenumber"
SPLIT_KEYS = ("InvoiceNo", LINE, "StockCode")
MODEL_COLUMNS = (*SPLIT_KEYS, "Quantity", "UnitPrice", "CustomerID", "Country")

Query = Callable[[SparkSession, str], DataFrame]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_from_star(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(bronze(spark, sf_dir), extra=(LINE,))


def _widened(df: DataFrame) -> DataFrame:
    """Float columns as doubles, the same value in a type every checker prints alike."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t == "float"})


def _store(spark: SparkSession, label: str) -> LayerStore:
    return LayerStore(spark, scratch_dir(spark, label))


# --- aggregation -------------------------------------------------------------


def _rounded_revenue(gold: DataFrame) -> DataFrame:
    return gold.withColumn("TotalRevenue", F.round("TotalRevenue", 2))


def gold_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_revenue(gold_by_country(silver(spark, sf_dir)))


def gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_by_country(silver(spark, sf_dir)).select(
        "Country", "TotalTransactions", "TotalQuantitySold", "TotalItemsSold"
    )


def gold_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_revenue(gold_by_country(silver(spark, sf_dir))).select("Country", "TotalRevenue")


def gold_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_by_country(silver(spark, sf_dir)).select("Country", "UniqueCustomers", "UniqueProductsSold")


def gold_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_gold(gold_country(spark, sf_dir))


# --- projections, filters, cleaning --------------------------------------------


def line_revenue_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select("InvoiceNo", LINE, "StockCode", line_revenue().alias("Revenue"))


def filter_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.filter_quantity(bronze(spark, sf_dir)).select("InvoiceNo", LINE, "StockCode", "Quantity")


def filter_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.filter_price(bronze(spark, sf_dir))
    return _widened(kept.select("InvoiceNo", LINE, "StockCode", "UnitPrice"))


def filter_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.filter_customer(bronze(spark, sf_dir))
    return _widened(kept.select("InvoiceNo", LINE, "StockCode", "CustomerID"))


def silver_drop_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _widened(cleaning.drop_invoice_date(bronze(spark, sf_dir)))


def silver_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = bronze(spark, sf_dir).transform(cleaning.cast_measures).transform(cleaning.cast_customer)
    return typed.select("InvoiceNo", LINE, "StockCode", "Quantity", "UnitPrice", "CustomerID")


def silver_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = cleaning.trim_strings(bronze(spark, sf_dir))
    return trimmed.select("InvoiceNo", LINE, "StockCode", "Description", "Country")


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(bronze(spark, sf_dir))


def cleaning_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_funnel(bronze(spark, sf_dir))


# --- ingest, stores and layout ---------------------------------------------------


def _with_ingest_time(df: DataFrame) -> DataFrame:
    """The ingest time as text, which every checker prints alike."""
    return df.withColumn("ingested_at", F.date_format(AUDIT_COLUMN, "yyyy-MM-dd HH:mm:ss"))


def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    write_retail_csv(bronze(spark, sf_dir).select(*RAW_COLUMNS), path)
    return _widened(read_retail_csv(spark, path))


def bronze_audit_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = _with_ingest_time(with_audit(bronze(spark, sf_dir), INGESTED_AT)).drop(AUDIT_COLUMN)
    live = with_audit(fixed)
    one_value = (F.col(AUDIT_COLUMN) == F.current_timestamp()) & (F.col(AUDIT_COLUMN) > F.lit(INGESTED_AT))
    return live.select("InvoiceNo", LINE, "StockCode", "ingested_at", one_value.alias("live_time_is_one"))


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "bronze")
    store.overwrite("bronze", with_audit(bronze(spark, sf_dir).select(*RAW_COLUMNS), INGESTED_AT))
    return _widened(_with_ingest_time(store.read("bronze", bronze_ddl())).drop(AUDIT_COLUMN))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "silver")
    rows = cleaning.clean(with_audit(bronze(spark, sf_dir), INGESTED_AT))
    store.overwrite("silver", rows, rebalance_by=("Country",))
    return _with_ingest_time(store.read("silver", SILVER_DDL)).drop(AUDIT_COLUMN)


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "gold")
    store.overwrite("gold", gold_by_country(silver(spark, sf_dir)), partition_by=("Country",))
    return _rounded_revenue(store.read("gold", GOLD_DDL))


def gold_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "gold")
    store.overwrite("gold", gold_by_country(silver(spark, sf_dir)))
    store.cluster("gold", GOLD_DDL, ("TotalRevenue",))
    return _rounded_revenue(store.read("gold", GOLD_DDL))


def csv_doubled_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions with quoted words, written with doubled quotes and read back by a splittable scan."""
    path = scratch_dir(spark, "csv")
    quoted = F.concat(F.lit('"'), F.regexp_replace("Description", " ", '" "'), F.lit('", new'))
    rows = bronze(spark, sf_dir).withColumn("Description", quoted)
    write_retail_csv(rows.select(*RAW_COLUMNS), path, dialect="doubled")
    return _widened(read_retail_csv(spark, path, dialect="doubled"))


def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with cells spoiled by a rule on the keys: what ingest keeps of each row, and which rows it rejects."""
    store = _store(spark, "rejects")
    cfg = FlowConfig(f"{store.root}/raw", store.root, ingested_at=INGESTED_AT, keep_rejects=True)
    spoiled = lambda by, line: (F.col("InvoiceNo").cast("bigint") % by == 0) & (F.col(LINE) == line)
    text = lambda c: F.col(c).cast("string")
    rows = bronze(spark, sf_dir).withColumns(
        {
            "Quantity": F.when(spoiled(7, 1), F.concat(F.lit("x"), text("Quantity"))).otherwise(text("Quantity")),
            "UnitPrice": F.when(spoiled(11, 2), F.lit("n/a")).otherwise(text("UnitPrice")),
            "CustomerID": F.when(spoiled(13, 3), F.lit("12.5.1")).otherwise(text("CustomerID")),
        }
    )
    write_retail_csv(rows.select(*RAW_COLUMNS), cfg.raw_path)
    ingest(store, cfg)
    kept = store.read("bronze", f"{bronze_ddl()}, {REJECT_COLUMN} string")
    return _widened(
        kept.select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "CustomerID", F.col(REJECT_COLUMN).isNotNull().alias("rejected"))
    )


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that ``read_rejects`` gives back, field by field as they were written."""
    store = _store(spark, "rejects")
    cfg = FlowConfig(f"{store.root}/raw", store.root, ingested_at=INGESTED_AT, keep_rejects=True)
    quantity = F.when(F.col("InvoiceNo").cast("bigint") % 5 == 0, F.lit("many")).otherwise(F.col("Quantity").cast("string"))
    rows = bronze(spark, sf_dir).withColumn("Quantity", quantity).withColumn("Description", F.lit("thing"))
    write_retail_csv(rows.select(*RAW_COLUMNS), cfg.raw_path)
    ingest(store, cfg)
    fields = F.split(REJECT_COLUMN, ",")
    return read_rejects(store, cfg).select(
        "InvoiceNo", F.col("Quantity").isNull().alias("no_quantity"), *[F.get(fields, F.lit(i)).alias(f"field_{i}") for i in (0, 2, 3)]
    )


def _with_revenue(df: DataFrame) -> DataFrame:
    return df.select("InvoiceNo", LINE, "StockCode", line_revenue().alias("Revenue"))


def _revenue_store(spark: SparkSession, sf_dir: str) -> tuple[LayerStore, str]:
    """Line revenue clustered into 16 files, with an index of their ranges."""
    store, rows = _store(spark, "revenue"), _with_revenue(silver(spark, sf_dir))
    ddl = f"InvoiceNo string, {LINE} int, StockCode string, Revenue double"
    store.overwrite("lines", clustered(rows, ("Revenue",), files=16))
    store.index_files("lines", ddl, ("Revenue",))
    return store, ddl


def revenue_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in all, and whether any two of the files overlap in revenue."""
    store, ddl = _revenue_store(spark, sf_dir)
    ranges = store.file_ranges("lines", ddl, ("Revenue",))
    crossing = overlapping(ranges, "Revenue").agg(F.count(F.lit(1)).alias("overlapping_files"))
    totals = ranges.agg(
        F.sum("rows").alias("rows"),
        F.round(F.min("least_Revenue"), 2).alias("least"),
        F.round(F.max("most_Revenue"), 2).alias("most"),
        (F.count(F.lit(1)) > 8).alias("many_files"),
    )
    return totals.withColumn("overlapping_files", crossing.scalar())


def revenue_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a range of revenue, read from the files of that range alone."""
    store, ddl = _revenue_store(spark, sf_dir)
    low, high = 20000.0, 30000.0
    found = store.read_within("lines", ddl, "Revenue", low, high)
    opened, within = len(found.inputFiles()), store.files_within("lines", "Revenue", low, high).count()
    return found.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("Revenue"), 2).alias("revenue")).select(
        "rows",
        "revenue",
        F.lit(opened == within).alias("opens_files_in_range"),
        F.lit(opened < store.file_ranges("lines", ddl, ()).count()).alias("skips_files"),
    )


def silver_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per country, and whether a country lies in one file unless its files are too large for one task."""
    store, advisory = _store(spark, "placement"), 64 << 20
    store.overwrite("silver", cleaning.clean(bronze(spark, sf_dir)), rebalance_by=("Country",))
    ddl = ", ".join(c for c in SILVER_DDL.split(", ") if AUDIT_COLUMN not in c)
    placed = store.placement("silver", ddl, "Country")
    return placed.select("Country", "rows", ((F.col("files") == 1) | (F.col("bytes") > advisory)).alias("in_one_file"))


def gold_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts beside estimates from stored sketches of batches, united per country."""
    store, rows = _store(spark, "sketches"), silver(spark, sf_dir)
    store.overwrite("batches", gold_partials(rows, LINE))
    batches = store.read("batches", f"{PARTIAL_DDL}, {LINE} int")
    estimates = gold_from_partials(batches).alias("e")
    at_once = gold_from_partials(gold_partials(rows)).alias("o")
    exact = gold_by_country(rows).alias("x")
    names = ("UniqueCustomers", "UniqueProductsSold")
    near = [F.abs(F.col(f"e.{c}") - F.col(f"x.{c}")) <= 0.05 * F.col(f"x.{c}") for c in names]
    same = [F.col(f"e.{c}") == F.col(f"o.{c}") for c in names]
    joined = exact.join(estimates, F.col("x.Country") == F.col("e.Country")).join(at_once, F.col("x.Country") == F.col("o.Country"))
    return joined.select(
        "x.Country",
        *[F.col(f"x.{c}") for c in names],
        F.col("e.TotalTransactions"),
        (near[0] & near[1]).alias("within_5_percent"),
        (same[0] & same[1]).alias("merged_equals_at_once"),
    )


def flow_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the flow's own writes observe."""
    store = _store(spark, "flow")
    cfg = FlowConfig(f"{store.root}/raw", store.root, ingested_at=INGESTED_AT)
    write_retail_csv(bronze(spark, sf_dir).select(*RAW_COLUMNS), cfg.raw_path)
    counts = {**ingest(store, cfg), "stored_silver": build_silver(store, cfg), "stored_gold": build_gold(store, cfg)}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each guard makes of a stored layer that was spoiled, and the rows of that layer."""
    rows = with_audit(bronze(spark, sf_dir).select(*RAW_COLUMNS), INGESTED_AT)
    cleaned = cleaning.clean(rows)
    told = []

    def stored(layer: str, df: DataFrame) -> tuple[LayerStore, FlowConfig]:
        store = _store(spark, "guards")
        store.overwrite(layer, df)
        return store, FlowConfig(f"{store.root}/raw", store.root)

    def note(guard: str, layer: str, df: DataFrame, act: Callable[[LayerStore, FlowConfig], object]) -> None:
        store, cfg = stored(layer, df)
        count = spark.read.parquet(store.current_path(layer)).count()
        try:
            outcome = str(act(store, cfg))
        except ValueError as error:
            outcome = type(error).__name__
        told.append((guard, outcome, count))

    def trained(store: LayerStore, cfg: FlowConfig) -> str:
        run_id = train(store, cfg)
        run = RunLog(store).read().where(F.col("run_id") == run_id).first()
        return f"{run.status} {','.join(sorted(run.schemas))}"

    note("no columns", "bronze", rows, lambda s, c: require_any_column(read_bronze(s, c).select(), "etl"))
    note("empty bronze", "bronze", rows.where("Quantity is null"), lambda s, c: f"{build_silver(s, c)} rows")
    note("no silver column", "bronze", rows, lambda s, c: cleaning.select_silver(read_bronze(s, c).select("InvoiceDate")))
    note("no gold input", "silver", cleaned.drop("CustomerID"), build_gold)
    note("empty silver", "silver", cleaned.where("Quantity <= 0"), trained)
    return spark.createDataFrame(told, "guard string, outcome string, rows bigint")


def synthetic_retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star_table(spark, sf_dir, "lineitem")
    return retail_from_ids(lines.select((F.col("l_orderkey") * 10 + F.col(LINE)).alias("id")))


def flow_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV to stored gold through every stored layer."""
    store = _store(spark, "flow")
    cfg = FlowConfig(f"{store.root}/raw", store.root, ingested_at=INGESTED_AT)
    write_retail_csv(bronze(spark, sf_dir).select(*RAW_COLUMNS), cfg.raw_path)
    ingest(store, cfg)
    build_silver(store, cfg)
    build_gold(store, cfg)
    return _rounded_revenue(read_gold(store))


# --- features and model ------------------------------------------------------------


def stored_silver(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The silver layer with the given columns, written once for queries that read it several times."""
    store = _store(spark, "silver")
    rows = silver(spark, sf_dir).select(*columns)
    store.overwrite("silver", rows)
    return store.read("silver", rows.schema)


def _indexed(column: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = tuple(dict.fromkeys(("InvoiceNo", LINE, "StockCode", column)))
        rows = stored_silver(spark, sf_dir, *keys)
        labels = fit_labels(rows, [column], scratch_dir(spark, "labels"))
        return index_column(rows, labels[column], column, INDEXED[column])

    return query


def _unnested(rows: DataFrame, vector: str) -> DataFrame:
    values = vector_to_array(F.col(vector))
    return rows.select("InvoiceNo", LINE, "StockCode", *(values[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)))


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_silver(spark, sf_dir, *MODEL_COLUMNS)
    labels = fit_labels(rows, tuple(INDEXED), scratch_dir(spark, "labels"))
    return _unnested(assemble(index_all(rows, labels)), "features")


def scale_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled by the merged moments of stored parts, the lines of each line number being one; labels are looked up once."""
    rows = stored_silver(spark, sf_dir, *MODEL_COLUMNS)
    labels = fit_labels(rows, tuple(INDEXED), scratch_dir(spark, "labels"))
    path = scratch_dir(spark, "indexed")
    indexed = index_all(rows, labels)
    indexed.write.parquet(path)
    stored = spark.read.schema(indexed.schema).parquet(path)
    moments = MomentStore(spark, scratch_dir(spark, "moments"), FEATURE_COLUMNS)
    moments.add_all(stored, LINE)
    wide = _unnested(moments.scaler().transform(assemble(stored)), "scaledFeatures")
    return wide.withColumns({c: F.round(c, 6) for c in FEATURE_COLUMNS})


def recast_text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities and prices as text, some of which is no number, cast as before training."""
    number = F.col("InvoiceNo").cast("bigint")
    text = bronze(spark, sf_dir).withColumns(
        {
            "Quantity": F.when(number % 3 == 0, F.concat(F.col("Quantity").cast("string"), F.lit(" pcs"))).otherwise(F.col("Quantity").cast("string")),
            "UnitPrice": F.when(number % 4 == 0, F.lit("free")).otherwise(F.format_string("%.2f", F.col("UnitPrice").cast("double"))),
        }
    )
    return recast_measures(text).select("InvoiceNo", LINE, "StockCode", "Quantity", F.round("UnitPrice", 2).alias("UnitPrice"))


def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(silver(spark, sf_dir), SPLIT_KEYS).select("InvoiceNo", LINE, "StockCode", "is_train")


def _country_mean_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict each line's quantity by its country's mean and score every line; no country is a country too."""
    rows = stored_silver(spark, sf_dir, "Country", "Quantity")
    return evaluate(mean_predictions(rows))


def mean_predictions(rows: DataFrame) -> DataFrame:
    means = rows.groupBy(F.col("Country").alias("of")).agg(F.avg("Quantity").alias("prediction"))
    return rows.join(means, F.col("Country").eqNullSafe(F.col("of"))).drop("of")


def eval_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _country_mean_scores(spark, sf_dir).select(F.round("rmse", 6).alias("rmse"))


def eval_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _country_mean_scores(spark, sf_dir).select(F.round("r2", 6).alias("r2"))


def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = TrainingOptions(split_keys=SPLIT_KEYS)
    rows = stored_silver(spark, sf_dir, *MODEL_COLUMNS)
    data = prepare(rows, options, scratch_dir(spark, "features"), scratch_dir(spark, "training"), carry=SPLIT_KEYS)
    return fit_forest(data.train, options).transform(data.test).drop("scaledFeatures")


def _fitted(spark: SparkSession, sf_dir: str, options: TrainingOptions) -> tuple[TrainingSet, DataFrame, DataFrame]:
    """Training and test rows, the test rows scored, and the nodes of the saved forest."""
    rows, path = stored_silver(spark, sf_dir, *MODEL_COLUMNS), scratch_dir(spark, "forest")
    data = prepare(rows, options, scratch_dir(spark, "features"), scratch_dir(spark, "training"), carry=SPLIT_KEYS)
    forest = fit_forest(data.train, options)
    forest.write().save(path)
    return data, forest.transform(data.test), forest_nodes(spark, path)


def forest_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out lines, and whether walking the node table gives the model's own score."""
    options = TrainingOptions(num_trees=20, max_depth=5, split_keys=SPLIT_KEYS)
    _, scored, nodes = _fitted(spark, sf_dir, options)
    same = F.abs(F.col("walked") - F.col("prediction")) <= 1e-9
    return with_walked_score(scored, nodes, options.max_depth).select(*SPLIT_KEYS, "Quantity", same.alias("walk_equals_model"))


def forest_tree_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree without resampling: its leaves hold all training lines, and each scores the mean of its own."""
    options = TrainingOptions(num_trees=1, max_depth=5, split_keys=SPLIT_KEYS, bootstrap=False)
    data, _, nodes = _fitted(spark, sf_dir, options)
    leaves = leaf_means(data.train, nodes, options.max_depth, LABEL)
    equal = (F.col("seen") == F.col("rows")) & (F.abs(F.col("mean") - F.col("value")) <= 1e-9)
    return leaves.agg(
        F.sum("seen").alias("train_rows"),
        F.round(F.sum(F.col("value") * F.col("rows")) / F.sum("rows"), 6).alias("mean_quantity"),
        F.bool_and(equal).alias("leaves_equal_means"),
        (F.count(F.lit(1)) > 4).alias("has_splits"),
    )


def training_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training run on stored silver leaves in the runs table."""
    store = _store(spark, "run")
    rows = cleaning.clean(bronze(spark, sf_dir))
    store.overwrite("silver", rows)
    options = TrainingOptions(num_trees=3, max_depth=4, split_keys=("InvoiceNo", "StockCode"))
    run_id = train(store, FlowConfig(f"{store.root}/raw", store.root, training=options))
    run = RunLog(store).read().where(F.col("run_id") == run_id)
    told = lambda kind, named, value: run.select("status", F.lit(kind).alias("kind"), F.explode(named).alias("name", "value")).select(
        "status", "kind", "name", value.cast("string").alias("value")
    )
    model = F.create_map("model_name", "model_version")
    positive = F.when(F.col("value") > 0, "positive").when(F.col("value").isNotNull(), "not positive")
    number = F.when(F.col("name") == "rmse", positive).otherwise(F.when(F.col("value") <= 1, "at most 1"))
    parts = (
        told("param", "params", F.col("value")),
        told("metric", "metrics", number),
        told("rows", "row_counts", F.col("value")),
        told("schema", F.map_filter("schemas", lambda k, v: v.contains("Quantity")), F.lit("stored")),
        told("model", model, F.col("value")),
    )
    return reduce(DataFrame.unionAll, parts)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = RunLog(_store(spark, "runs"))
    counts = cleaning_funnel(spark, sf_dir).first().asDict()
    runs.append("check", "FINISHED", started_at=INGESTED_AT, params=TrainingOptions().params(), metrics=counts)
    logged = runs.read().select("run_id", "experiment", "status")
    params = runs.params().select("run_id", F.lit("param").alias("kind"), "name", "value")
    metrics = runs.metrics().select(
        "run_id", F.lit("metric").alias("kind"), "name", F.col("value").cast("bigint").cast("string").alias("value")
    )
    return logged.join(params.union(metrics), "run_id").drop("run_id")


QUERIES: dict[str, Query] = {
    "gold_country": gold_country,
    "gold_counts": gold_counts,
    "gold_revenue": gold_revenue,
    "gold_distinct": gold_distinct,
    "gold_sorted": gold_sorted,
    "line_revenue": line_revenue_query,
    "filter_quantity": filter_quantity,
    "filter_price": filter_price,
    "filter_customer": filter_customer,
    "silver_drop_date": silver_drop_date,
    "silver_casts": silver_casts,
    "silver_trim": silver_trim,
    "silver_clean": silver_clean,
    "cleaning_funnel": cleaning_funnel,
    "bronze_csv_scan": bronze_csv_scan,
    "bronze_audit_column": bronze_audit_column,
    "bronze_roundtrip": bronze_roundtrip,
    "silver_roundtrip": silver_roundtrip,
    "gold_roundtrip": gold_roundtrip,
    "gold_clustered": gold_clustered,
    "flow_gold": flow_gold,
    "index_country": _indexed("Country"),
    "index_stock": _indexed("StockCode"),
    "assemble_features": assemble_features,
    "scale_features": scale_features,
    "split_train_test": split_train_test,
    "eval_rmse": eval_rmse,
    "eval_r2": eval_r2,
    "run_log": run_log,
    "forest_predictions": forest_predictions,
    "synthetic_retail": synthetic_retail,
    "csv_doubled_quotes": csv_doubled_quotes,
    "bronze_rejects": bronze_rejects,
    "rejected_lines": rejected_lines,
    "revenue_layout": revenue_layout,
    "revenue_range_read": revenue_range_read,
    "silver_placement": silver_placement,
    "gold_sketches": gold_sketches,
    "flow_counts": flow_counts,
    "guards": guards,
    "recast_text_measures": recast_text_measures,
    "forest_walk": forest_walk,
    "forest_tree_means": forest_tree_means,
    "training_run": training_run,
}
