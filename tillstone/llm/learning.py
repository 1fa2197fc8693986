"""Labelled training samples and row-wise scoring, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.common import Scratch, in_fold, parts


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, sample: int, id_col: str, text_col: str
) -> DataFrame:
    """Rows (id, text, label) of at most ``sample`` labels outside the held-out fold, of each class those with the least id hash.

    Rows of docs that share a labelled id all come along.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~in_fold(id_col, folds, held_out))
    rows = None
    for value in (0, 1):
        some = usable.filter(F.col(label) == value).orderBy(F.xxhash64(id_col), id_col).limit(sample // 2)
        rows = some if rows is None else rows.unionByName(some)
    wanted = F.broadcast(rows.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")))  # at most `sample` rows
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id")


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, sample: int, id_col: str, text_col: str
) -> DataFrame:
    """labelled_rows without the ids."""
    return labelled_rows(docs, labels, label, folds, held_out, sample, id_col, text_col).select("text", "label")


def brought_within(rows: DataFrame, sample: int, letters: int) -> list:
    """At most ``sample`` of the rows (id, text, label), brought to the driver with at most ``letters`` characters.

    Repeated rows count once. In order of a hash, a row whose text goes beyond what the ones before it have left is
    passed over.
    """
    scratch = Scratch(rows.sparkSession, "labelled")
    stored = scratch.store(
        rows.select(
            F.xxhash64("id", "text", "label").alias("h"), F.coalesce("text", F.lit("")).alias("text"), "label"
        ).dropDuplicates(["h"]),
        "rows",
    )
    taken = []
    for h, n in stored.select("h", F.length("text")).orderBy("h").limit(sample).collect():
        if n <= letters:
            letters -= n
            taken.append(h)
    # an Arrow table needs no Python on the executors; rows would start a second daemon with workers of its own there
    wanted = rows.sparkSession.createDataFrame(pa.table({"h": pa.array(taken, pa.int64())}))
    found = stored.join(F.broadcast(wanted), "h").select("text", "label").collect()  # wanted: at most `sample` numbers
    scratch.drop("rows")
    return found


def with_scores(docs: DataFrame, score, text_col: str, column: str = "score") -> DataFrame:
    """docs with a double column from ``score``, a function of a list of texts; a column of that name is replaced."""
    docs = docs.drop(column)

    def run(batches):
        for batch in parts(batches):
            values = score([t or "" for t in batch.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.asarray(values, np.float64))], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
