"""Ranked lexical search: MaxScore whose bounds come from lists of term pairs.

The index is a table of blocks: up to ``BLOCK_DOCS`` documents each, with their ids, lengths and, per term, the
documents that hold it and how often. Blocks are made where documents are read, so no text and no posting is
shuffled. Only terms in a fixed-size bit table of the queries' terms are kept (``FILTER_BITS``; a wrong hit costs
space, never a result); lengths and totals count all terms.

Queries come in groups of about ``QUERY_TERMS`` entries, a pass over the index for each, so what is sent to
executors is bounded. A pass first turns occurrences into impacts and writes, per block, each term's largest impact
and, for each pair of neighbours of a query in the order of weights, the joint maximum over the intersection
of both lists. The k-th largest such maximum of a term or pair over all blocks is a score that k different
documents reach: the start of the query's threshold.

The second step works block by block. Terms in ascending weight are taken two by two, and a pair is bounded by the
greater of its joint maximum and its single maxima, which is less than the sum of the two. The leading pairs
whose bounds together stay below the threshold are not essential: documents holding only those are skipped, and
with them the whole block if all pairs are such. The others' lists are added up; candidates that may still
reach the threshold look up the rest, pair by pair, and leave as soon as their bound falls below. The
threshold rises with the best scores seen by the task. Bounds only ever skip documents that cannot be
among the best, so results are exact.

Cases: null, empty and termless texts have no terms (not counted as documents, no rows as items); every row of
documents is a document and every row of items an item, also if ids repeat; null ids rank after others of the
same score; empty tables give an empty result; texts of any length are read whole, in pieces; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import small_batches, text_udf

TOP = 20
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 2_000_000
QUERY_TERMS = 200_000
FILTER_BITS = 1 << 20
KNOWN_TERMS = 500_000
PIECE = 1 << 22

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SPACE = re.compile(b" ")
TERMS = T.StructType([T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.LongType()))])
# Ids travel as text: a null beside large numbers would turn them into floats.
BLOCKS = "block long, ids array<string>, lengths array<long>, n_docs long, n_terms long, terms array<string>, sizes array<int>, docs array<int>, times array<long>"
LISTS = "block long, ids array<string>, terms array<int>, sizes array<int>, docs array<int>, impacts array<long>, most array<long>, pairs array<int>, joint array<long>"


def term_counts(text: str) -> Counter:
    """Occurrences of each term of the whole text, as bytes."""
    raw = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    if len(raw) <= PIECE:
        return Counter(raw.split())
    found, at = Counter(), 0
    while at < len(raw):
        cut = _SPACE.search(raw, min(at + PIECE, len(raw)))
        end = cut.start() if cut else len(raw)
        found.update(raw[at:end].split())
        at = end
    return found


def place(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term, 7) % FILTER_BITS


def _item_terms():
    def run(texts: list[str]) -> dict:
        counts = [sorted((k.decode("utf-8", "replace"), n) for k, n in term_counts(t).items()) for t in texts]
        columns = {"terms": [[k for k, _ in c] for c in counts], "times": [[n for _, n in c] for c in counts]}
        return {k: pd.Series(v, dtype=object) for k, v in columns.items()}

    return run


def query_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """_q (a number per row), _item, term, times."""
    rows = items.select(F.col(key).alias("_item"), text_udf(TERMS, _item_terms)(F.col(text)).alias("_t"))
    numbered = materialize(rows.withColumn("_q", F.monotonically_increasing_id()))
    zipped = F.explode(F.arrays_zip("_t.terms", "_t.times")).alias("_z")
    return materialize(numbered.select("_q", "_item", zipped).select("_q", "_item", F.col("_z.terms").alias("term"), F.col("_z.times").alias("times")))


def filter_bits(terms: DataFrame) -> np.ndarray:
    """Which of FILTER_BITS places hold a term: at most that many numbers reach the driver."""

    @F.pandas_udf("int")
    def placed(column: pd.Series) -> pd.Series:
        return pd.Series([place(t.encode()) for t in column], dtype="int32")

    found = terms.select(placed("term").alias("p")).distinct().toPandas()["p"].to_numpy(np.int64)
    bits = np.zeros(FILTER_BITS, bool)
    bits[found] = True
    return bits


def build_index(documents: DataFrame, bits: np.ndarray | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents with the lists of their terms (all of them, or those in the bit table)."""
    small_batches()
    packed = None if bits is None else np.packbits(bits).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = None if packed is None else np.unpackbits(np.frombuffer(packed, np.uint8)).tobytes()
        known: dict[bytes, bool] = {}
        part, number = TaskContext.get().partitionId(), 0
        ids, lengths, lists, postings = [], [], {}, 0

        def block() -> pd.DataFrame:
            terms = sorted(lists)
            docs = [np.array(lists[t][0], np.int32) for t in terms]
            row = {
                "block": (part << 32) + number,
                "ids": list(ids),
                "lengths": list(lengths),
                "n_docs": sum(n > 0 for n in lengths),
                "n_terms": sum(lengths),
                "terms": [t.decode("utf-8", "replace") for t in terms],
                "sizes": np.array([len(d) for d in docs], np.int32),
                "docs": np.concatenate([np.zeros(0, np.int32), *docs]),
                "times": np.concatenate([np.zeros(0, np.int64), *[np.array(lists[t][1], np.int64) for t in terms]]),
            }
            return pd.DataFrame({k: pd.Series([v], dtype=object if isinstance(v, (list, np.ndarray)) else "int64") for k, v in row.items()})

        for batch in batches:
            for i, t in zip(batch["_id"], batch["_text"]):
                counts = term_counts(t) if t is not None else Counter()
                if len(known) > KNOWN_TERMS:
                    known.clear()
                at = len(ids)
                for term, n in counts.items():
                    if table is not None:
                        keep = known.get(term)
                        if keep is None:
                            keep = known[term] = table[place(term)] == 1
                        if not keep:
                            continue
                    entry = lists.get(term)
                    if entry is None:
                        entry = lists[term] = ([], [])
                    entry[0].append(at)
                    entry[1].append(n)
                    postings += 1
                ids.append(i)
                lengths.append(counts.total())
                if len(ids) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield block()
                    number, postings = number + 1, 0
                    ids, lengths, lists = [], [], {}
        if ids:
            yield block()

    rows = documents.select(F.col(key).cast("long").cast("string").alias("_id"), F.col(text).alias("_text"))
    return materialize(rows.mapInPandas(run, BLOCKS))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Queries:
    """A group of queries: terms numbered, each query's terms in ascending weight, neighbours paired."""

    def __init__(self, entries: pd.DataFrame, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        vocabulary = entries[["term", "df"]].drop_duplicates("term").sort_values("term")
        self.number = {t: k for k, t in enumerate(vocabulary["term"])}
        self.weights = np.array([weight(n_docs, int(d)) for d in vocabulary["df"]], np.int64)
        self.items, pairs = [], {}
        for q, own in entries.groupby("_q"):
            t = np.array([self.number[x] for x in own["term"]])
            times = own["times"].to_numpy(np.int64)
            order = np.lexsort([t, times * self.weights[t]])
            t, times = t[order], times[order]
            numbers = [pairs.setdefault((min(a, b), max(a, b)), len(pairs)) for a, b in zip(t[0:-1:2].tolist(), t[1::2].tolist())]
            self.items.append((int(q), t, times, np.array(numbers, np.int64)))
        self.pairs = list(pairs)
        self.start = np.ones(len(self.items), np.int64)

    def set_thresholds(self, term_floor: dict[int, int], pair_floor: dict[int, int]) -> None:
        """From the k-th largest maximum of each term and pair; a score has to be above 0 in any case."""
        for n, (_, t, times, numbers) in enumerate(self.items):
            least = np.minimum(times[0 : 2 * len(numbers) : 2], times[1::2])
            known = [c * term_floor.get(x, 0) for x, c in zip(t.tolist(), times.tolist())]
            known += [c * pair_floor.get(p, 0) for p, c in zip(numbers.tolist(), least.tolist())]
            self.start[n] = max([1, *known])


def impact_lists(index: DataFrame, queries) -> DataFrame:
    """Per block: impacts of the queries' terms, their maxima, and joint maxima of the pairs that meet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = queries.value
        for batch in batches:
            for row in batch.itertuples(index=False):
                m = np.array([75 + 25 * int(n) * group.n_docs // max(group.n_terms, 1) for n in row.lengths], np.int64)
                numbers, docs, impacts, at = [], [], [], 0
                for term, size in zip(row.terms, row.sizes):
                    k = group.number.get(term)
                    if k is not None:
                        d, tf = np.asarray(row.docs[at : at + size]), np.asarray(row.times[at : at + size], np.int64)
                        numbers.append(k)
                        docs.append(d)
                        impacts.append(group.weights[k] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[d])))
                    at += size
                where = {k: x for x, k in enumerate(numbers)}
                dense, pairs, joint = np.zeros(len(m), np.int64), [], []
                for number, (a, b) in enumerate(group.pairs):
                    x, y = where.get(a), where.get(b)
                    if x is None or y is None:
                        continue
                    dense[docs[x]] = impacts[x]
                    met = dense[docs[y]]
                    both = met > 0
                    if both.any():
                        pairs.append(number)
                        joint.append(int((met + impacts[y])[both].max()))
                    dense[docs[x]] = 0
                out = {
                    "block": row.block,
                    "ids": row.ids,
                    "terms": np.array(numbers, np.int32),
                    "sizes": np.array([len(d) for d in docs], np.int32),
                    "docs": np.concatenate([np.zeros(0, np.int32), *docs]),
                    "impacts": np.concatenate([np.zeros(0, np.int64), *impacts]),
                    "most": np.array([x.max() for x in impacts], np.int64),
                    "pairs": np.array(pairs, np.int32),
                    "joint": np.array(joint, np.int64),
                }
                yield pd.DataFrame({k: pd.Series([v], dtype=object if k != "block" else "int64") for k, v in out.items()})

    return materialize(index.mapInPandas(run, LISTS))


def floors(lists: DataFrame, number: str, value: str, k: int) -> dict[int, int]:
    """The k-th largest block maximum of each term or pair: so many different documents reach it."""
    rows = lists.select(F.explode(F.arrays_zip(number, value)).alias("z")).select(F.col(f"z.{number}").alias("n"), F.col(f"z.{value}").alias("v"))
    place_ = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("v")))
    return {r["n"]: r["v"] for r in rows.withColumn("r", place_).filter(F.col("r") <= k).filter(F.col("r") == k).collect()}


def pair_bounds(times: np.ndarray, most: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Bound of each pair of neighbours (and of a last single term): what one document can add to a score."""
    n = len(joint)
    a, b, p, q = most[0 : 2 * n : 2], most[1 : 2 * n : 2], times[0 : 2 * n : 2], times[1 : 2 * n : 2]
    least = np.minimum(p, q)
    out = least * np.maximum(joint, np.maximum(a, b)) + (p - least) * a + (q - least) * b
    return out if len(most) == 2 * n else np.append(out, times[-1] * most[-1])


class Block:
    """One block's lists, by number of term and pair."""

    def __init__(self, row, n_terms: int, n_pairs: int):
        self.size = len(row.ids)
        # Null ids come last among equal scores.
        self.order = np.array([math.inf if i is None else int(i) for i in row.ids], object)
        ends = np.cumsum(np.concatenate([[0], np.asarray(row.sizes, np.int64)]))
        self.at = {int(k): (int(ends[x]), int(ends[x + 1])) for x, k in enumerate(row.terms)}
        self.docs, self.impacts = np.asarray(row.docs), np.asarray(row.impacts, np.int64)
        self.most, self.joint = np.zeros(n_terms, np.int64), np.zeros(n_pairs, np.int64)
        self.most[np.asarray(row.terms, np.int64)] = row.most
        self.joint[np.asarray(row.pairs, np.int64)] = row.joint

    def candidates(self, t: np.ndarray, times: np.ndarray, numbers: np.ndarray, threshold: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places in the block) and scores of all that may be among the k best at this threshold."""
        bounds = np.cumsum(pair_bounds(times, self.most[t], self.joint[numbers]))
        if bounds[-1] < threshold:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = int(np.searchsorted(bounds, threshold))  # pairs before it stay below the threshold together
        total = np.zeros(self.size, np.int64)
        for x, c in zip(t[2 * first :].tolist(), times[2 * first :].tolist()):
            if x in self.at:
                low, high = self.at[x]
                total[self.docs[low:high]] += c * self.impacts[low:high]
        rest = int(bounds[first - 1]) if first else 0
        found = np.flatnonzero((total > 0) & (total + rest >= threshold))
        score = total[found]
        for pair in range(first - 1, -1, -1):
            if len(found) > k:
                threshold = max(threshold, int(np.partition(score, -k)[-k]))
                stay = score + int(bounds[pair]) >= threshold
                found, score = found[stay], score[stay]
            for x, c in zip(t[2 * pair : 2 * pair + 2].tolist(), times[2 * pair : 2 * pair + 2].tolist()):
                if x in self.at and len(found):
                    low, high = self.at[x]
                    docs = self.docs[low:high]
                    at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    score = score + np.where(docs[at] == found, c * self.impacts[low:high][at], 0)
        stay = score >= threshold
        return found[stay], score[stay]


def best(lists: DataFrame, queries, k: int) -> DataFrame:
    """_q, doc_id, score: the k best documents of each query in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = queries.value
        kept: dict[int, list] = {}
        limit = group.start.copy()
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row, len(group.weights), len(group.pairs))
                for n, (_, t, times, numbers) in enumerate(group.items):
                    found, score = block.candidates(t, times, numbers, int(limit[n]), k)
                    if len(found):
                        merged = kept.get(n, []) + [(-int(s), block.order[d]) for d, s in zip(found, score)]
                        kept[n] = merged = sorted(merged)[:k]
                        if len(merged) == k:
                            limit[n] = max(limit[n], -merged[-1][0])
        rows = [(group.items[n][0], None if d == math.inf else str(d), -s) for n, top in kept.items() for s, d in top]
        for at in range(0, len(rows), 10_000):
            yield pd.DataFrame(rows[at : at + 10_000], columns=["_q", "_id", "score"])

    found = lists.mapInPandas(run, "_q long, _id string, score long")
    return found.select("_q", F.col("_id").cast("long").alias("doc_id"), "score")


def ranked(documents: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = documents.sparkSession
    asked = query_terms(items, item_key, item_text)
    index = build_index(documents, filter_bits(asked), key, text)
    totals = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    held = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("z")).groupBy(F.col("z.terms").alias("term")).agg(F.sum("z.sizes").alias("df"))
    entries = materialize(asked.join(held, "term").select("_q", "term", "times", "df"))
    groups = max(1, -(-entries.count() // QUERY_TERMS))
    results = []
    for number in range(groups):
        own = entries.filter(F.pmod(F.xxhash64("_q"), F.lit(groups)) == number).toPandas()
        if own.empty:
            continue
        group = Queries(own, totals["n"], totals["l"])
        first = spark.sparkContext.broadcast(group)
        lists = impact_lists(index, first)
        first.unpersist()
        group.set_thresholds(floors(lists, "terms", "most", k), floors(lists, "pairs", "joint", k))
        second = spark.sparkContext.broadcast(group)
        results.append(materialize(best(lists, second, k)))
        second.unpersist()
    if not results:
        results = [spark.createDataFrame([], "_q long, doc_id long, score long")]
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("_q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = asked.select("_q", "_item").distinct()
    return top.join(names, "_q").select(F.col("_item").alias("item_id"), "rank", "doc_id", "score")


RANKED_SQL = r"""
WITH t AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
f AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS MATERIALIZED (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY doc_id),
a AS (SELECT count(*) AS c, CAST(sum(n) AS BIGINT) AS l FROM n),
m AS MATERIALIZED (SELECT doc_id, 75 + (25 * n * c) // l AS m FROM n, a),
w AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT c FROM a) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f GROUP BY term),
i AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
