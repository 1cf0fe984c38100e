"""Helpers shared by the operators: column functions over whole texts, bounded samples, folds."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The word separators of the shingle contracts: space and \x09 to \x0D.
WHITE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of whole texts that travel to a Python worker at once: bounds its memory.
BATCH_ROWS = 512


def small_batches() -> None:
    """Lower the session's Arrow batches to BATCH_ROWS; Spark's default is meant for narrow rows."""
    spark, name = SparkSession.getActiveSession(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark is not None and not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def text_udf(schema: T.StructType, load: Callable[[], Callable[[list], dict]]):
    """A column function from texts (null: empty) to a struct.

    ``load()`` runs once per task and returns the function from a list of texts to
    the struct's columns. Only the text column travels to Python; all other columns
    of the frame stay with Spark, whatever their names are.
    """

    small_batches()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = load()
        for texts in batches:
            rows = score(["" if t is None else t for t in texts])
            yield pd.DataFrame({f.name: rows[f.name] for f in schema.fields})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, schema)


def fold(id_column: str, parts: int, held: int) -> Column:
    """True for rows kept away from training; a null id trains nothing and counts as held out."""
    return F.coalesce(
        F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(parts)) == held, F.lit(True)
    )


def bounded_sample(rows: DataFrame, keys: list[str], most: int, seed: int, total: int | None = None) -> DataFrame:
    """At most ``most`` rows, in the order of a hash of their keys, so the same for every partitioning.

    Rows above a cut on the hash are left out first; what tasks then send to be ordered follows
    ``most`` and not the number of partitions.
    """
    total = rows.count() if total is None else total
    span = 1 << 30
    cut = span if total <= 4 * most else 4 * most * span // total
    place = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(span))
    return rows.filter(place < cut).orderBy(place, *keys).limit(most)


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    parts: int,
    held: int,
    rows: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``rows`` training rows, half of them of each class if there are enough.

    The chosen ids are few by construction, hence the broadcast.
    """
    known = (
        labels.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_y"))
        .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~fold("_id", parts, held))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    chosen = [bounded_sample(known.filter(F.col("_y") == y), ["_id"], rows // 2, 17) for y in (0, 1)]
    few = chosen[0].unionByName(chosen[1])
    found = (
        documents.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
        .join(F.broadcast(few), "_id")
        .groupBy("_id", "_y")
        .agg(F.min("_text").alias("_text"))
        .collect()
    )
    found.sort(key=lambda r: (r["_id"] * 2654435761 & 0xFFFFFFFF, r["_id"]))
    return [r["_text"] or "" for r in found], [r["_y"] for r in found]


def class_prior(labels: DataFrame, label: str, parts: int, held: int, id_column: str = "doc_id") -> float:
    """Share of label 1 over all training labels, for undoing the balance of a sample."""
    row = (
        labels.filter(F.col(id_column).isNotNull() & ~fold(id_column, parts, held))
        .agg(F.avg(F.col(label).cast("double")).alias("p"))
        .first()
    )
    return min(max(row["p"] if row["p"] is not None else 0.5, 0.01), 0.99)


def tokenizer_folder(path: str = "/opt/tokenizers"):
    """The folder of vocabulary files with its own ``path(name)``; a parameter everywhere."""
    import importlib.util
    import os

    spec = importlib.util.spec_from_file_location("public_tokenizers", os.path.join(path, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    sys.modules.setdefault("public_tokenizers", module)
    spec.loader.exec_module(module)
    return module
