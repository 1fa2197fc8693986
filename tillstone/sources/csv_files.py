"""Raw retail CSV files, read under the declared schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.schema import AUDIT_COLUMN, REJECT_COLUMN, raw_ddl

# "spark" keeps Spark's backslash escape, so files stay splittable, but a doubled
# quote is kept as written and a line break inside quotes splits the row.
# "doubled" reads doubled quotes and files stay splittable; a line break inside
# quotes still splits the row. "rfc4180" reads both correctly at the cost of one
# task per file.
DIALECTS: dict[str, dict[str, str]] = {
    "spark": {},
    "doubled": {"quote": '"', "escape": '"'},
    "rfc4180": {"quote": '"', "escape": '"', "multiLine": "true"},
}


def read_retail_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    dialect: str = "spark",
    strict_header: bool = False,
    price_type: str = "float",
    id_type: str = "float",
    keep_rejects: bool = False,
) -> DataFrame:
    """Lazy scan of raw files. Cells that do not parse become null and the row is kept.

    Columns bind by position. ``strict_header`` makes a header that differs from
    the schema an error instead of ignoring it. ``keep_rejects`` adds the whole
    line as it was written to every row that has such a cell or the wrong number
    of fields; other rows have null there.
    """
    if dialect not in DIALECTS:
        raise ValueError(f"unknown CSV dialect {dialect!r}, expected one of {sorted(DIALECTS)}")
    ddl = raw_ddl(price_type, id_type)
    reader = (
        spark.read.schema(f"{ddl}, {REJECT_COLUMN} string" if keep_rejects else ddl)
        .option("columnNameOfCorruptRecord", REJECT_COLUMN)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", str(not strict_header).lower())
        .options(**DIALECTS[dialect])
    )
    return reader.csv(path)


def write_retail_csv(df: DataFrame, path: str, *, dialect: str = "spark") -> None:
    """Write rows as CSV with a header, keeping padding that Spark's writer would trim."""
    quoting = {k: v for k, v in DIALECTS[dialect].items() if k != "multiLine"}
    (
        df.write.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .options(**quoting)
        .csv(path)
    )


def with_audit(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Add the ingest time, one value per query; ``at`` fixes it for repeatable runs."""
    return df.withColumn(AUDIT_COLUMN, F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))
