"""Benchmark decontamination by the q-gram lemma over diagonal bands.

Benchmark items are normalised (lower case, white space runs to one blank) and cut into adjacent segments of
``SEGMENT`` to 2 * SEGMENT - 1 characters, which cover them, and into overlapping windows of SEGMENT characters, a new
one every ``STEP``, the last one flush with the item's end. So every run of SEGMENT + STEP - 1 characters of an item
holds a whole window. A segment of length m with at most e = floor(RATE * m) edits
shares at least m - q + 1 - q * e of its q-grams with the text region it matches, all of them on
diagonals that differ by at most e from each other's start. The hits of a text are therefore counted in
overlapping bands of 2 * (e + 1) diagonals, one starting every e + 1; only bands that reach the bound
are verified by a banded alignment of the segment with the region. q is ``Q``; short segments for which
that bound is not positive have an index of their own with a smaller q.

The benchmark's q-gram index is broadcast block by block, each of at most ``BLOCK_CHARS`` characters, and no item is
left out. A larger benchmark takes one written pass over the texts per block, whose broadcast ends with it; a pass
writes only the matches of texts that have any, under the digest of the text.

A text whose q-grams have more than ``HITS`` postings (one that repeats itself like some item) is searched in
overlapping pieces of ``PIECE`` characters, equal pieces once, so memory and time stay bounded. Equal segments of
several items are searched once. Matches of one item that overlap in the text, or lie within the segment's edit
budget of each other, are one region; in a text that repeats itself its ends are exact to within a segment.

Cases: null or empty texts match nothing; items shorter than Q match nothing, items shorter than
SEGMENT + STEP are one segment; null or repeated items and repeated documents are fine; an empty benchmark or
an empty table gives no match; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import text_udf

Q = 8
SEGMENT = 64
STEP = SEGMENT // 2
RATE = 0.1
BLOCK_CHARS = 2_000_000  # bound of what one pass broadcasts, each character in up to three segments
BITS = 22
HITS = 1_000_000  # postings that one search of a whole text holds at most
PIECE = 3 * 2 * SEGMENT
MATCH = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("segment_start", T.IntegerType()),
        T.StructField("region_start", T.IntegerType()),
        T.StructField("region_end", T.IntegerType()),
        T.StructField("edits", T.IntegerType()),
    ]
)
SCHEMA = T.StructType([T.StructField("matches", T.ArrayType(MATCH))])


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def gram_codes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit code of every q-gram."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    # Codes of doubled width, each from two of the half width; a last one of overlapping halves gives any q.
    codes, width = points.astype(np.uint64), 1
    for factor in (0x100000001B3, 0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C15):
        step = min(width, q - width)
        if step:
            codes = codes[:-step] * np.uint64(factor) + codes[step:]
            codes ^= codes >> np.uint64(31)
            width += step
    return codes * np.uint64(0xD6E8FEB86659FD93)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def segments(items: list[tuple[int, str]], length: int = SEGMENT, step: int = STEP) -> list[tuple[int, int, str]]:
    """(item, start, characters): pieces of near equal length covering each item, then its overlapping windows."""
    out = []
    for item, text in items:
        n = len(text)
        if n < Q:
            continue
        pieces = max(1, n // length)
        cuts = [n * k // pieces for k in range(pieces + 1)]
        spans = list(zip(cuts, cuts[1:]))
        if n >= length + step:
            spans += [(a, a + length) for a in (*range(0, n - length, step), n - length)]
        out += [(item, a, text[a:b]) for a, b in dict.fromkeys(spans)]
    return out


def postings(q: int, numbers: np.ndarray, points: list[np.ndarray]) -> dict:
    """q-gram codes → postings (segment, position) of the numbered segments, sorted by code, and a bitmap of the codes."""
    codes = [gram_codes(points[s], q) for s in numbers]
    flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
    segment = np.repeat(numbers, [len(c) for c in codes]) if codes else np.zeros(0, np.int64)
    position = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    unique, first, count = np.unique(flat[order], return_index=True, return_counts=True)
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[unique >> np.uint64(64 - BITS)] = True
    return {"q": q, "unique": unique, "first": first, "count": count, "segment": segment[order], "position": position[order], "bitmap": bitmap}


def build_index(items: list[tuple[int, str]], rate: float = RATE) -> dict:
    """The segments of the items, and their postings by Q and, where its bound is not positive, by a smaller q."""
    owners: dict[str, list[tuple[int, int]]] = {}
    for item, start, piece in segments(items):
        owners.setdefault(piece, []).append((item, start))
    points = [points_of(piece) for piece in owners]
    size = np.array([len(p) for p in points], np.int64)
    edits = (rate * size).astype(np.int64)
    # The largest q whose bound is positive; short segments share the smallest of theirs.
    most = np.minimum(Q, size // (edits + 1))
    short = most < Q
    least = max(1, int(most[short].min())) if short.any() else Q
    q = np.where(short, least, Q)
    return {
        "owners": list(owners.values()),
        "text": points,
        "size": size,
        "edits": edits,
        "need": np.maximum(1, size - q + 1 - q * edits),
        "parts": [postings(g, np.flatnonzero(q == g), points) for g in sorted({Q, least}, reverse=True)],
    }


def banded(pattern: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int]:
    """Fewest edits (and the end) of the pattern against any part of the region; most + 1 if above.

    The alignment may start and end anywhere in the region, whose length limits the band.
    """
    n, m = len(region), len(pattern)
    if n >= m:  # verbatim passages need no alignment
        whole = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(region, m) == pattern).all(axis=1))
        if len(whole):
            return 0, int(whole[0]) + m
    row = np.zeros(n + 1, np.int64)
    at = np.arange(n + 1)
    for i, c in enumerate(pattern, 1):
        best = np.empty(n + 1, np.int64)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (region != c), row[1:] + 1)
        row = np.minimum.accumulate(best - at) + at
        if row.min() > most:
            return most + 1, -1
    end = int(row.argmin())
    return int(row[end]), end


def find(index: dict, text: str) -> list[tuple[int, int, int, int, int]]:
    """Regions of one text: item, segment start, region start and end in the normalised text, fewest edits."""
    points = points_of(normal(text))
    return merged({m for part in index["parts"] for m in found_by(index, part, points)}, index)


def merged(matches: set[tuple[int, int, int, int]], index: dict) -> list[tuple[int, int, int, int, int]]:
    """Matches of segments as regions of items; those with at most the segment's edit budget between them are one."""
    named = ((i, b, e, a, n, int(index["edits"][s])) for s, b, e, n in matches for i, a in index["owners"][s])
    out = []
    for item, begin, end, start, edits, budget in sorted(named):
        if out and out[-1][0] == item and begin <= out[-1][3] + budget:
            _, first, low, high, few = out[-1]
            out[-1] = (item, min(first, start), low, max(high, end), min(few, edits))
        else:
            out.append((item, start, begin, end, edits))
    return out


def found_by(index: dict, part: dict, points: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(segment, region start, region end, edits) of one text, whole or in pieces."""
    at, place = known_grams(part, points)
    if part["count"][place].sum() <= HITS or len(points) <= PIECE:
        return found_at(index, part, points, at, place)
    # Every match lies whole in some piece.
    step = PIECE - int((index["size"] + index["edits"]).max()) - Q
    out, seen = [], {}
    for begin in range(0, max(1, len(points) - PIECE + step), step):
        piece = points[begin : begin + PIECE]
        key = piece.tobytes()
        if key not in seen:
            seen[key] = found_at(index, part, piece, *known_grams(part, piece))
        out += [(s, begin + a, begin + b, e) for s, a, b, e in seen[key]]
    return out


def known_grams(part: dict, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose q-gram occurs in the index, and its number there."""
    codes = gram_codes(points, part["q"])
    at = np.flatnonzero(part["bitmap"][codes >> np.uint64(64 - BITS)])
    if len(at) == 0 or len(part["unique"]) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(part["unique"], codes[at]), len(part["unique"]) - 1)
    real = part["unique"][place] == codes[at]
    return at[real], place[real]


def found_at(index: dict, part: dict, points: np.ndarray, at: np.ndarray, place: np.ndarray) -> list[tuple[int, int, int, int]]:
    if len(at) == 0:
        return []
    n = part["count"][place]
    post = np.repeat(part["first"][place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    at = np.repeat(at, n)
    segment, position = part["segment"][post], part["position"][post]
    enough = np.bincount(segment, minlength=len(index["need"])) >= index["need"]
    if not enough.any():
        return []
    at, segment, position = (x[enough[segment]] for x in (at, segment, position))
    diagonal = at - position
    # The text as a sequence of windows on the diagonal axis: each hit is in two overlapping bands.
    step = index["edits"][segment] + 1
    band = np.floor_divide(diagonal, step)
    low, span = int(band.min()) - 1, int(band.max() - band.min()) + 3
    key = np.concatenate([segment * span + band - low, segment * span + band - 1 - low])
    both = np.concatenate([position, position])
    # A q-gram of the segment counts once in a band, however often the text repeats it.
    wide = int(index["size"].max()) + 1
    once = np.unique(key * wide + both) // wide
    keys, hits = np.unique(once, return_counts=True)
    keep = hits >= index["need"][keys // span]
    out = {}
    for k in keys[keep]:
        s, b = int(k // span), int(k % span) + low
        e, m = int(index["edits"][s]), int(index["size"][s])
        begin, end = max(0, b * (e + 1) - e), min(len(points), (b + 2) * (e + 1) + m + e)
        edits, stop = banded(index["text"][s], points[begin:end], e)
        if edits <= e:
            old = out.get((s, (begin + stop) // m))
            if old is None or edits < old[3]:
                out[s, (begin + stop) // m] = (s, max(begin, begin + stop - m), begin + stop, edits)
    return list(out.values())


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", chars: int = BLOCK_CHARS):
    """Distinct normalised items in blocks of at most ``chars`` characters (one item at least)."""
    given = (
        benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull())
        .groupBy(F.col(text).alias("_t"))
        .agg(F.min(item).cast("long").alias("_i"))
        .orderBy("_i", "_t")
    )
    block, size = [], 0
    for row in given.toLocalIterator():
        value = normal(row["_t"])
        if block and size + len(value) > chars:
            yield block
            block, size = [], 0
        block.append((row["_i"], value))
        size += len(value)
    if block:
        yield block


def finder(index: dict):
    def score(texts: list[str]) -> dict:
        return {"matches": pd.Series([[dict(zip(MATCH.names, m)) for m in find(index, t)] for t in texts], dtype=object)}

    return score


def with_matches(documents: DataFrame, benchmark: DataFrame, text: str = "text", name: str = "matches", rate: float = RATE) -> DataFrame:
    """Adds the array column ``name`` of all matched regions (empty if none)."""
    empty = F.array().cast(T.ArrayType(MATCH))
    given = blocks(benchmark)
    first, second = next(given, None), next(given, None)
    if first is None:
        return documents.withColumn(name, empty)
    if second is None:
        _, matches = block_matches(documents, first, text, rate)
        return documents.withColumn(name, F.coalesce(matches, empty))
    passes = []
    for block in chain([first, second], given):
        shared, matches = block_matches(documents, block, text, rate)
        rows = documents.select(F.sha2(text, 256).alias("_digest"), matches.alias("_found")).filter(F.size("_found") > 0)
        passes.append(materialize(rows.groupBy("_digest").agg(F.first("_found").alias("_found"))))
        shared.destroy()
    every = reduce(DataFrame.unionByName, passes).groupBy("_digest").agg(F.array_sort(F.flatten(F.collect_list("_found"))).alias("_found"))
    joined = documents.alias("d").join(materialize(every).alias("m"), F.sha2(F.col(f"d.{text}"), 256) == F.col("m._digest"), "left")
    return joined.select(*[F.col(f"d.`{c}`") for c in documents.columns if c != name], F.coalesce("m._found", empty).alias(name))


def block_matches(documents: DataFrame, block: list[tuple[int, str]], text: str, rate: float):
    """The broadcast index of one block, and the column of a text's regions in it."""
    shared = documents.sparkSession.sparkContext.broadcast(build_index(block, rate))
    return shared, text_udf(SCHEMA, lambda: finder(shared.value))(F.col(text))["matches"]


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, n_regions, item_ids (sorted), regions."""
    found = with_matches(documents.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.size("matches").cast("long").alias("n_regions"),
        F.array_sort(F.array_distinct("matches.item_id")).alias("item_ids"),
        F.col("matches").alias("regions"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any match, with their own columns."""
    return with_matches(documents, benchmark, name="_found").filter(F.size("_found") == 0).drop("_found")
