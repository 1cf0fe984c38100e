"""Splits, tails, heads, repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import bin_index, bin_label
from ..functions.scalars import key_hash, row_text
from ..session import spread
from .ordering import running_total

HASH_BITS = 32
HASH_BUCKET_BITS = 16


def series_split(regular: DataFrame, share: float = 0.85) -> DataFrame:
    """First ``int(n * share)`` bins of each item are train, the rest validation.

    ``pos`` and ``n_bins`` then count within the part.
    """
    cut = F.floor(F.col("n_bins") * F.lit(share).cast("double")).cast("int")
    is_train = F.col("pos") < F.col("_cut")
    return (
        regular.withColumn("_cut", cut)
        .withColumn("split", F.when(is_train, "train").otherwise("validation"))
        .withColumns(
            {
                "pos": F.when(is_train, F.col("pos")).otherwise(F.col("pos") - F.col("_cut")),
                "n_bins": F.when(is_train, F.col("_cut")).otherwise(F.col("n_bins") - F.col("_cut")),
            }
        )
        .drop("_cut")
    )


def tail_context(regular: DataFrame, n: int = 28) -> DataFrame:
    """Last ``n`` bins of each item, fewer if it is shorter."""
    return regular.filter(F.col("pos") >= F.col("n_bins") - n)


def head_horizon(regular: DataFrame, n: int = 28) -> DataFrame:
    """First ``n`` bins of each item."""
    return regular.filter(F.col("pos") < n)


def _spans(df: DataFrame, key: str, ts: str, freq: str) -> DataFrame:
    """First and last bin per item, which are the same for observations and their regular series."""
    number = bin_index(F.col(ts), freq)
    return (
        df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(key)
        .agg(F.min(number).alias("_first"), F.max(number).alias("_last"))
    )


def midpoint_cutoff(df: DataFrame, key: str, ts: str, freq: str = "D") -> DataFrame:
    """One row ``cutoff``: the time of regular row ``n // 2`` in (item, time) order.

    Only one row per item takes part: running lengths locate the item that owns
    the row, and the position inside the gap-free series gives its time.
    """
    lengths = _spans(df, key, ts, freq).withColumn("_n", F.col("_last") - F.col("_first") + 1)
    ends = running_total(lengths, [key], "_n", "_end")
    middle = ends.agg(F.floor(F.sum("_n") / 2)).scalar()
    offset = middle - (F.col("_end") - F.col("_n"))
    return ends.filter((offset >= 0) & (middle < F.col("_end"))).select(
        bin_label(F.col("_first") + offset, freq).alias("cutoff")
    )


def midpoint_split(regular: DataFrame, key: str, ts: str, freq: str = "D") -> DataFrame:
    """Adds ``split``: train before the midpoint cutoff, test from it on."""
    cutoff = midpoint_cutoff(regular, key, ts, freq).scalar()
    return regular.withColumn("split", F.when(F.col(ts) < cutoff, "train").otherwise("test"))


def median_cutoff(df: DataFrame, key: str, ts: str, freq: str = "D") -> DataFrame:
    """One row ``cutoff``: the upper median bin over all regular rows.

    An item adds one row to every bin from its first to its last. The number of
    items per bin therefore only changes where one starts or has ended; between
    two such bins the running number of rows is a line: ``bin * items - weighted`` rows
    lie before a bin, with running sums of the changes and of the changes times their bin.
    """
    changes = (
        _spans(df, key, ts, freq)
        .select(
            F.inline(
                F.array(
                    F.struct(F.col("_first").alias("_bin"), F.lit(1).alias("_change")),
                    F.struct((F.col("_last") + 1).alias("_bin"), F.lit(-1).alias("_change")),
                )
            )
        )
        .groupBy("_bin")
        .agg(F.sum("_change").alias("_change"))
        .withColumn("_weight", F.col("_change") * F.col("_bin"))
    )
    items = running_total(changes, ["_bin"], "_change", "_items")
    upto = running_total(items, ["_bin"], "_weight", "_weighted")
    middle = upto.agg(F.shiftright(-F.sum("_weight"), 1)).scalar()
    before = F.col("_bin") * F.col("_items") - F.col("_weighted")
    line = F.struct("_bin", "_items", before.alias("_before"))
    last = upto.filter((before <= middle) & (F.col("_items") > 0)).agg(F.max_by(line, "_bin").alias("_at"))
    rest = F.floor((middle - F.col("_at._before")) / F.col("_at._items"))
    return last.filter(F.col("_at").isNotNull()).select(
        bin_label(F.col("_at._bin") + rest, freq).alias("cutoff")
    )


# Copies of a row that one task numbers.
COPIES_PER_TASK = 4096


def number_rows(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Adds a text that tells every row apart: the hash of its columns, a dash, its number among equal rows.

    Equal rows are counted map-side and numbered by their count, so the result does not depend on
    the partitioning, and a row that fills the table is spread over many tasks. Nulls are equal to
    each other and differ from empty text. Map columns cannot be compared and raise.
    """
    columns = df.columns
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COPIES_PER_TASK))
    first = F.col("_block") * COPIES_PER_TASK + 1
    numbers = F.sequence(first, F.least(first + COPIES_PER_TASK - 1, F.col("_n")))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    blocked = counted.withColumn("_hash", F.sha2(row_text(columns), 256)).withColumn("_block", F.explode(blocks))
    return (
        spread(blocked, "_hash", "_block")
        .withColumn("_number", F.explode(numbers))
        .select(*columns, F.concat_ws("-", "_hash", "_number").alias(name))
    )


def random_split(
    df: DataFrame, key: str, train_percent: int, val_percent: int, seed: int = 1729
) -> DataFrame:
    """Adds ``split`` from a stable hash of the row key: no shuffle, sizes right on average."""
    bucket = F.pmod(key_hash(seed, key), F.lit(100))
    return df.withColumn(
        "split",
        F.when(bucket < train_percent, "train")
        .when(bucket < train_percent + val_percent, "validation")
        .otherwise("test"),
    )


def random_split_exact(
    df: DataFrame, key: str, train_percent: int, val_percent: int, seed: int = 1729
) -> DataFrame:
    """Adds ``split`` with ``int(share * n)`` rows up to each cut, in hash order of a unique key.

    A histogram of the hash tells which bucket holds the last row before a cut.
    Only that bucket, about n / 2^16 rows, is ordered to find the row; the final
    pass compares every row with the two cut rows and needs no shuffle.
    """
    order = F.struct(F.col("_h"), F.col(key))
    hashed = df.select(key).withColumn("_h", key_hash(seed, key))
    bucket = F.shiftright("_h", HASH_BITS - HASH_BUCKET_BITS)
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = lambda percent: F.floor(F.lit(percent * 0.01).cast("double") * F.col("_all"))
    histogram = (
        hashed.groupBy(bucket.alias("_b"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(upto))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy()))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumns({"_cut1": size(train_percent), "_cut2": size(train_percent + val_percent)})
    )
    holds = lambda cut: (F.col("_start") < F.col(cut)) & (F.col(cut) <= F.col("_end"))
    # At most two buckets qualify.
    holders = histogram.filter(holds("_cut1") | holds("_cut2")).select(
        "_b", "_start", "_cut1", "_cut2"
    )
    nth = F.col("_start") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    cuts = (
        hashed.withColumn("_b", bucket)
        .join(F.broadcast(holders), "_b")
        .withColumn("_nth", nth)
        .agg(
            F.struct(
                F.max(F.when(F.col("_nth") == F.col("_cut1"), order)).alias("first"),
                F.max(F.when(F.col("_nth") == F.col("_cut2"), order)).alias("second"),
            )
        )
        .scalar()
    )
    within = lambda cut: F.coalesce(order <= cuts[cut], F.lit(False))
    return (
        df.withColumn("_h", key_hash(seed, key))
        .withColumn(
            "split",
            F.when(within("first"), "train")
            .when(within("second"), "validation")
            .otherwise("test"),
        )
        .drop("_h")
    )


def oversample(df: DataFrame, factor: int = 8) -> DataFrame:
    """Every row ``factor`` times. Training uses a weight column instead of copies."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(factor)))).drop("_copy")


def union_parts(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Both parts in one frame, marked by ``split``."""
    return train.withColumn("split", F.lit("train")).unionByName(
        validation.withColumn("split", F.lit("validation"))
    )
