"""Exact top-k search by inner product with vector-approximation files.

Vectors become integers floor(256 x). The approximation file holds one byte per component: each vector's
range is cut into 256 equal cells whose width is a power of two. For a query, a cell gives a lower and an
upper bound of its part of the score, so a scan of the cells alone gives bounds of all scores. Exact vectors are then
read in the order of their upper bounds, in growing rounds, until no unread bound can reach the k-th exact score.

Equal vectors are one entry with their k + 1 smallest different ids (no more can be in an answer) and the number of
rows of each, and equal queries are searched once; so a vector held by a third of all rows is one entry. Queries are
broadcast in blocks of at most about ``QUERY_BYTES``; each block is one pass over the cell file, whose tasks keep the
k best lower bounds of each query and pass on only entries that may still reach them. No task holds all bounds of a query.

Cases: null vectors, vectors with null or non-finite components and null ids take no part, nor do vectors with a
component of 2**48 or more, whose products may pass 38 digits; a vector of
another length than the query's is no candidate of it; repeated ids count once per row on both sides, as pairs of
rows do in a join (an id twice among the queries and twice among the candidates gives four equal answers), whether
their vectors are equal or not, and no row of the query's own id is an answer; fewer than k candidates give fewer rows; ties go to the smaller id; an empty table gives no rows;
where scores may leave 64 bits they are summed in decimals of 38 digits, ranked by them and cut to 64 bits in the result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

QUERY_BYTES = 1 << 24  # bound of the queries that one pass broadcasts
CELL_BLOCK = 65_536  # entries that one task scans
NUMBERS = 1 << 21  # bound of the numbers in one matrix of a task
LARGEST = 2.0**48
CELLS = "_u long, _size int, _base long, _shift int, _c binary, _only long, _only_set boolean"
BOUNDS = "_q long, _u long, _low double, _up double"


def integers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """_id, _v: usable vectors as arrays of 64-bit integers."""
    x = F.col(vector)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & ((F.abs(c) < LARGEST)))
    return rows.filter(F.col(key).isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(key).cast("long").alias("_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long")).alias("_v"),
    )


def distinct_vectors(ints: DataFrame, keep: int) -> DataFrame:
    """_v, _ids: each distinct vector with its ``keep`` smallest different ids, ascending, each with its number of rows.

    Rows are counted per id before the cut. The rank limit is applied before the shuffle as well, so copies do not pile up.
    """
    order = Window.partitionBy("_v").orderBy("_id")
    counted = ints.groupBy("_v", "_id").agg(F.count(F.lit(1)).alias("_n"))
    first = counted.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= keep)
    return first.groupBy("_v").agg(F.array_sort(F.collect_list(F.struct("_id", "_n"))).alias("_ids"))


def flagged(rows: DataFrame, name: str) -> DataFrame:
    """Nullable ids for pandas, which would make them floating: 0 and a flag instead of null."""
    return rows.withColumn(f"{name}_set", F.col(name).isNotNull()).withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def matrix(rows, size: int, dtype) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(dtype).reshape(len(rows), size)


def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The approximation file: _u (entry), its cells and the id of an entry that only one id holds."""
    for batch in batches:
        for size, rows in batch.groupby(batch["_v"].map(len)):
            v = matrix(rows["_v"], size, np.int64)
            base = v.min(axis=1, initial=np.iinfo(np.int64).max) if size else np.zeros(len(rows), np.int64)
            # Differences wrap in 64 bits, so unsigned ones are right for every range.
            above = v.astype(np.uint64) - base.astype(np.uint64)[:, None]
            span = above.max(axis=1, initial=0)
            shift = np.zeros(len(rows), np.uint64)
            while (wide := span >> shift > np.uint64(255)).any():
                shift += wide.astype(np.uint64)
            packed = (above >> shift[:, None]).astype(np.uint8)
            yield pd.DataFrame(
                {
                    "_u": rows["_u"].to_numpy(), "_size": np.full(len(rows), size, np.int32), "_base": base, "_shift": shift.astype(np.int32),
                    "_c": [r.tobytes() for r in packed], "_only": rows["_only"].to_numpy(), "_only_set": rows["_only_set"].to_numpy(),
                }
            )


def bounded_scores(queries: np.ndarray, base: np.ndarray, shift: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of queries against cells, widened by what doubles may round."""
    base, width = base.astype(np.float64), np.ldexp(1.0, shift)
    corner = queries.sum(axis=1, keepdims=True) * base + (queries @ cell.T) * width
    rounding = np.abs(queries).sum(axis=1, keepdims=True) * (np.abs(base) + 256 * width) * (queries.shape[1] + 8) * 2.0**-51
    up = np.maximum(queries, 0).sum(axis=1, keepdims=True) * (width - 1)
    down = np.minimum(queries, 0).sum(axis=1, keepdims=True) * (width - 1)
    return corner + down - rounding, corner + up + rounding


def query_blocks(rows: pd.DataFrame) -> dict[int, tuple]:
    """Per length: numbers, vectors, and own ids (with a flag) of one broadcast block of queries."""
    return {
        int(size): (part["_q"].to_numpy(), matrix(part["_v"], size, np.float64), part["_x"].to_numpy(), part["_x_set"].to_numpy())
        for size, part in rows.groupby(rows["_v"].map(len))
    }


def scan(shared, keep: int):
    """One pass over cells: entries whose upper bound reaches the keep-th lower bound their query has met in the task.

    Entries that only the query's own id holds are left out before.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = shared.value
        best = {size: np.full((len(block[0]), keep), -np.inf) for size, block in blocks.items()}
        for batch in batches:
            for size, rows in batch.groupby("_size"):
                if size not in blocks:
                    continue
                q, vectors, own_id, own_set = blocks[size]
                most = max(1, NUMBERS // max(size, 1024))
                for at in range(0, len(rows), most):
                    part = rows.iloc[at : at + most]
                    cell = np.array([np.frombuffer(c, np.uint8) for c in part["_c"]], np.float64).reshape(len(part), size)
                    u, only, single = part["_u"].to_numpy(), part["_only"].to_numpy(), part["_only_set"].to_numpy()
                    few = max(1, NUMBERS // max(size, len(part)))
                    for a in range(0, len(q), few):
                        b = a + few
                        lower, upper = bounded_scores(vectors[a:b], part["_base"].to_numpy(), part["_shift"].to_numpy(), cell)
                        own = (own_id[a:b, None] == only) & own_set[a:b, None] & single
                        lower[own] = -np.inf
                        met = np.concatenate([best[size][a:b], lower], axis=1)
                        best[size][a:b] = np.partition(met, met.shape[1] - keep, axis=1)[:, -keep:]
                        i, j = np.nonzero((upper >= best[size][a:b].min(axis=1, keepdims=True)) & ~own)
                        yield pd.DataFrame({"_q": q[a:b][i], "_u": u[j], "_low": lower[i, j], "_up": upper[i, j]})

    return run


def dot(a: str, b: str, number: str):
    """Inner product of two arrays of integers in the type ``number``."""
    product = lambda x, y: (x.cast(number) * y.cast("decimal(20,0)" if number != "long" else number)).cast(number)
    return F.aggregate(F.zip_with(a, b, product), F.lit(0).cast(number), lambda s, x: (s + x).cast(number))


def top_k(rows: DataFrame, query_ids, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for every row for which ``query_ids(id column)`` holds."""
    ints = integers(rows, key, vector)
    named = distinct_vectors(ints, k + 1).withColumn("_only", F.when(F.size("_ids") == 1, F.get("_ids", F.lit(0))["_id"]))
    entries = materialize(named.select(F.monotonically_increasing_id().alias("_u"), "_v", "_ids", "_only"))
    # _x: the query's id if some entry is held by it alone, which then is no candidate. Other queries share their entry's search.
    alone = entries.filter(F.col("_only").isNotNull()).select(F.col("_only").alias("_x")).distinct()
    wanted = ints.filter(query_ids(F.col("_id"))).groupBy("_id", "_v").agg(F.count(F.lit(1)).alias("_n"))
    met = wanted.join(entries.select("_u", F.col("_v").alias("_w")), F.col("_v") == F.col("_w")).select("_id", "_n", "_u")
    met = materialize(met.join(alone, F.col("_id") == F.col("_x"), "left"))
    queries = met.select("_u", "_x").distinct().join(entries.select("_u", "_v"), "_u")
    queries = materialize(queries.select(F.monotonically_increasing_id().alias("_q"), "_u", "_x", "_v"))
    numbers = queries.select("_q", F.col("_u").alias("_e"), F.col("_x").alias("_y"))
    asked = met.join(numbers, (F.col("_u") == F.col("_e")) & F.col("_x").eqNullSafe(F.col("_y"))).select("_id", "_n", "_q")
    facts = entries.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("_v")).alias("size"),
        F.max(F.array_max(F.transform("_v", lambda c: F.abs(c)))).alias("most"),
    ).first()
    fits = (facts["most"] or 0) ** 2 * (facts["size"] or 0) < 2**63
    number = "long" if fits else "decimal(38,0)"
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-facts["n"] // CELL_BLOCK))
    packed = flagged(entries.select("_u", "_v", "_only"), "_only").mapInPandas(cells, CELLS)
    # By bytes a cell file is small; it is dealt by entries, as the work is.
    packed = materialize(packed).repartition(parts, "_u")
    weight = queries.agg(F.sum(F.size("_v") * 8 + 64).alias("w")).first()["w"] or 0
    count = max(1, -(-weight // QUERY_BYTES))
    passes = []
    for i in range(count):
        block = flagged(queries.filter(F.pmod(F.xxhash64("_q"), F.lit(count)) == i).drop("_u"), "_x")
        shared = rows.sparkSession.sparkContext.broadcast(query_blocks(block.toPandas()))
        passes.append(materialize(packed.mapInPandas(scan(shared, k), BOUNDS)))
        shared.destroy()
    bounds = reduce(DataFrame.unionByName, passes)
    # Only bounds that reach the k-th lower bound over all tasks matter: every entry holds a row of another id than the query's.
    by_low = Window.partitionBy("_q").orderBy(F.desc("_low"), "_u")
    floor = bounds.withColumn("_r", F.row_number().over(by_low)).filter(F.col("_r") <= k).groupBy("_q").agg(F.min("_low").alias("_floor"))
    unread = materialize(bounds.join(floor, "_q").filter(F.col("_up") >= F.col("_floor")).select("_q", "_u", "_up"))

    def exact(pairs: DataFrame) -> DataFrame:
        seen = pairs.join(entries.select("_u", "_v", "_ids"), "_u")
        return seen.join(queries.select("_q", F.col("_v").alias("_w")), "_q").select("_q", "_u", "_up", "_ids", dot("_v", "_w", number).alias("_score"))

    # Rounds of growing size in the order of the bounds; after each, the k-th exact score so far rules unread entries
    # out. The last round reads all that still may answer, without ordering them.
    by_up = Window.partitionBy("_q").orderBy(F.desc("_up"), "_u")
    by_score = Window.partitionBy("_q").orderBy(F.desc("_score"), "_u")
    read = []
    for size in (k, 4 * k):
        read.append(materialize(exact(unread.withColumn("_r", F.row_number().over(by_up)).filter(F.col("_r") <= size).drop("_r"))))
        so_far = reduce(DataFrame.unionByName, read).select("_q", "_u", "_score")
        reached = so_far.withColumn("_r", F.row_number().over(by_score)).filter(F.col("_r") <= k).groupBy("_q").agg(F.min("_score").alias("_least"))
        last = read[-1].groupBy("_q").agg(F.min(F.struct("_up", (-F.col("_u")).alias("_m"))).alias("_last"))
        later = F.struct("_up", (-F.col("_u")).alias("_m")) < F.col("_last")
        left = unread.join(reached.join(last, "_q"), "_q").filter(later & (F.col("_up") >= F.col("_least")))
        unread = materialize(left.select("_q", "_u", "_up"))
    found = reduce(DataFrame.unionByName, [*read, exact(unread)]).select("_q", "_score", F.explode("_ids").alias("_hit"))
    found = found.groupBy("_q", "_score", F.col("_hit._id").alias("_hit")).agg(F.sum("_hit._n").alias("_c"))
    # At each score stands at most one id to be left out, and another one: 2 k of them hold k others.
    best = Window.partitionBy("_q").orderBy(F.desc("_score"), "_hit")
    few = found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= 2 * k).drop("_r")
    answers = asked.join(few, "_q").filter(F.col("_hit") != F.col("_id"))
    counted = answers.groupBy("_id", "_hit", "_score").agg(F.sum(F.col("_n") * F.col("_c")).alias("_rows"))
    final = Window.partitionBy("_id").orderBy(F.desc("_score"), "_hit").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(final), F.lit(0))).filter(F.col("_before") < k)
    ranks = F.sequence((F.col("_before") + 1).cast("int"), F.least(F.col("_before") + F.col("_rows"), F.lit(k)).cast("int"))
    score = F.greatest(F.least("_score", F.lit(2**63 - 1)), F.lit(-(2**63 - 1))).cast("long")
    return ranked.select(F.col("_id").alias("query_id"), F.explode(ranks).alias("rank"), F.col("_hit").alias("vec_id"), score.alias("score"))
