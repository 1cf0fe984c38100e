"""Near-duplicate documents by SimHash with covering locality-sensitive hashing.

A text (lower case A-Z, split at blanks) gives its three-word shingles with repeats; bit b of its fingerprint is
set if more than half of the shingles' XXH64 values have it. Fingerprints link at ``RADIUS`` or fewer
differing bits.

Every bit position is dealt a non-zero vector of GF(2)^(RADIUS + 1), and table v keeps the positions whose
vector is not orthogonal to v. RADIUS positions span at most RADIUS dimensions, so some v is orthogonal to all
of them: each pair within the radius agrees on all bits of at least one of the 2^(RADIUS + 1) - 1 tables. No
link can be missed, for any texts.

Equal fingerprints are one class first, so copies never meet in a bucket. A bucket of more than ``LIMIT``
classes is covered again on the bits its table leaves free; free bits fall from 64 to at most 28, 12 and 6,
which bounds a bucket of the third covering by 64 classes. Pairs are compared only inside buckets of up to
``LIMIT`` classes, each pair in the first table of its covering that holds it, and only links leave a bucket.

Cases: null, empty and white texts have fingerprint zero and link like any other; texts of one or two words are
one shingle; rows repeating an id are linked by their own texts; a null id has a fingerprint but links with nothing
(component null, kept); an empty table gives an empty result; long texts are hashed whole, in
pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import text_udf
from .minhash import components

WORDS = 3
SEED = 42
RADIUS = 2
BITS = 64
LIMIT = 64
PIECE = 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")
SIGNATURE = T.StructType([T.StructField("f", T.LongType())])


def shingle_lists(raw: bytes) -> Iterator[list[bytes]]:
    """All shingles of a lower-cased text, a bounded piece of the text at a time."""
    at, last, whole = 0, [], True
    while at < len(raw):
        cut = _BLANK.search(raw, min(at + PIECE, len(raw)))
        end = cut.start() if cut else len(raw)
        words = last + raw[at:end].split()
        if len(words) >= WORDS:
            whole = False
            yield [b" ".join(x) for x in zip(*(words[k:] for k in range(WORDS)))]
            words = words[1 - WORDS :]
        last, at = words, end
    if whole and last:
        yield [b" ".join(last)]


def fingerprint(text: str) -> int:
    """The 64 majority bits as an unsigned number."""
    raw = text.encode("utf-8", "surrogatepass").lower()  # bytes.lower: A-Z only
    counts, total = np.zeros(BITS, np.int64), 0
    for shingles in shingle_lists(raw):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        for at in range(0, len(hashes), 8192):
            bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return sum(1 << b for b in range(BITS) if 2 * int(counts[b]) > total)


def _signatures():
    def run(texts: list[str]) -> dict:
        return {"f": np.array([fingerprint(t) for t in texts], np.uint64).astype(np.int64)}

    return run


def covering(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the positions; any ``radius`` of them are all left out by at least one mask."""
    size = (1 << (radius + 1)) - 1
    vector = {p: 1 + i % size for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() % 2) for v in range(1, size + 1)]


def refined(masks: list[int], radius: int = RADIUS) -> list[int]:
    """For each mask the masks that extend it by a covering of its free positions."""
    out = []
    for mask in masks:
        out += [mask | m for m in covering([p for p in range(BITS) if not mask >> p & 1], radius)]
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near(x: Column, y: Column, radius: int) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= radius


def bucketed(rows: DataFrame, masks: list[int], parents: int, radius: int) -> DataFrame:
    """_t, _k, _f: each row of (_t, _f) in every table that refines its table ``_t``."""
    each = len(masks) // parents
    literal = F.array(*[F.lit(signed(m)) for m in masks])
    table = F.explode(F.sequence(F.col("_t") * each, F.col("_t") * each + each - 1))
    spread = rows.select("_f", table.alias("_t"))
    return spread.select("_t", F.col("_f").bitwiseAND(F.element_at(literal, F.col("_t") + 1)).alias("_k"), "_f")


def links_inside(radius: int) -> Column:
    """Links among the sorted fingerprints ``_all`` of one bucket."""

    def partners(x: Column, i: Column) -> Column:
        others = F.filter(F.slice("_all", i + 2, F.lit(LIMIT)), lambda y: near(x, y, radius))
        return F.transform(others, lambda y: F.struct(x.alias("_u"), y.alias("_v")))

    return F.flatten(F.transform("_all", partners))


def fingerprint_links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """_u, _v: all pairs of the distinct ``_f`` within the radius, each at least once."""
    masks = covering(list(range(BITS)), radius)
    rows, parents, found = fingerprints.select(F.lit(0).alias("_t"), "_f"), 1, []
    while True:
        keyed = bucketed(rows, masks, parents, radius)
        sizes = keyed.groupBy("_t", "_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_f").alias("_u"), F.max("_f").alias("_v"))
        sizes = materialize(sizes.filter("_n > 1"))
        found.append(sizes.filter("_n = 2").filter(near(F.col("_u"), F.col("_v"), radius)).select("_u", "_v"))
        crowded = keyed.join(sizes.filter("_n > 2").select("_t", "_k", "_n"), ["_t", "_k"])
        small = crowded.filter(F.col("_n") <= LIMIT).groupBy("_t", "_k").agg(F.sort_array(F.collect_list("_f")).alias("_all"))
        found.append(small.select(F.explode(links_inside(radius)).alias("_l")).select("_l._u", "_l._v"))
        if not sizes.filter(F.col("_n") > LIMIT).take(1):
            break
        rows = materialize(crowded.filter(F.col("_n") > LIMIT).select("_t", "_f"))
        masks, parents = refined(masks, radius), len(masks)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(documents: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id, kept: one row per row of ``documents``."""
    own = documents.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    rows = materialize(own.select("_id", text_udf(SIGNATURE, _signatures)(F.col("_text"))["f"].alias("_f")))
    classes = materialize(rows.filter(F.col("_id").isNotNull()).groupBy("_f").agg(F.min("_id").alias("_least")))
    roots = components(fingerprint_links(classes, radius))
    named = classes.join(roots.withColumnRenamed("_node", "_f"), "_f", "left").withColumn("_root", F.coalesce("_root", "_f"))
    least = named.groupBy("_root").agg(F.min("_least").alias("_component"))
    known = materialize(named.join(least, "_root").select("_f", "_component"))
    component = F.when(F.col("_id").isNotNull(), F.col("_component"))
    return rows.join(known, "_f", "left").select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("_f"), 16, "0")).alias("fingerprint"),
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
    )


# The primes of XXH64.
_P = [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261]
_ALL = 1 << 64


def near_duplicates_sql(radius: int = RADIUS) -> str:
    """The same over table ``documents``: XXH64 in wide integers, every pair of distinct fingerprints compared."""
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in _P)
    low = lambda x: f"(({x}) % {_ALL}::UHUGEINT)"
    turn = lambda x, r: f"(({x}) * {1 << r}::UHUGEINT % {_ALL}::UHUGEINT + ({x}) // {1 << (64 - r)}::UHUGEINT)"
    lane = lambda at, size: "(" + " + ".join(f"b[{at} + {k + 1}] * {256**k}::UHUGEINT" for k in range(size)) + ")"
    mixed = lambda v: low(f"{turn(low(f'({v}) * {p2}'), 31)} * {p1}")
    step = lambda v, x: low(f"{turn(low(f'{v} + {x} * {p2}'), 31)} * {p1}")
    start = [(SEED + _P[0] + _P[1]) % _ALL, (SEED + _P[1]) % _ALL, SEED, (SEED - _P[0]) % _ALL]
    stripes = ", ".join(
        f"list_reduce(list_transform(range(0, n // 32), lambda s: {lane(f's * 32 + {8 * k}', 8)}), lambda v, x: {step('v', 'x')}, {start[k]}::UHUGEINT) AS v{k}"
        for k in range(4)
    )
    merged = low(" + ".join(turn(f"v{k}", r) for k, r in enumerate((1, 7, 12, 18))))
    for k in range(4):
        merged = low(f"xor({merged}, {mixed(f'v{k}')}) * {p1} + {p4}")
    tail = (
        f"list_concat(list_transform(range(n // 32 * 32, n - 7, 8), lambda i: {{'x': {mixed(lane('i', 8))}, 'r': {1 << 27}::UHUGEINT, 'q': {1 << 37}::UHUGEINT, 'm': {p1}, 'a': {p4}}}), "
        f"list_transform(range(n // 8 * 8, n - 3, 4), lambda i: {{'x': {low(lane('i', 4) + ' * ' + p1)}, 'r': {1 << 23}::UHUGEINT, 'q': {1 << 41}::UHUGEINT, 'm': {p2}, 'a': {p3}}}), "
        f"list_transform(range(n // 4 * 4, n), lambda i: {{'x': {low('b[i + 1] * ' + p5)}, 'r': {1 << 11}::UHUGEINT, 'q': {1 << 53}::UHUGEINT, 'm': {p1}, 'a': 0::UHUGEINT}}))"
    )
    fold = low(f"(xor(z.x, e.x) * e.r % {_ALL}::UHUGEINT + xor(z.x, e.x) // e.q) * e.m + e.a")
    bits = " + ".join(f"CASE WHEN 2 * sum(c * CAST(h // {1 << b}::UHUGEINT % 2 AS BIGINT)) > sum(c) THEN {1 << b}::UHUGEINT ELSE 0::UHUGEINT END" for b in range(BITS))
    return rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {WORDS} THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i : i + {WORDS - 1}], ' ') for i in range(1, len(ws) - {WORDS - 2})] END) AS s FROM w),
d AS (SELECT DISTINCT s FROM s),
y AS (SELECT s, list_transform(range(0, strlen(s)), lambda i: CAST('0x' || substr(hex(encode(s)), 2 * i + 1, 2) AS UHUGEINT)) AS b,
  strlen(s) AS n FROM d),
v AS MATERIALIZED (SELECT s, b, n, {stripes} FROM y),
t AS (SELECT s, list_prepend({{'x': {low(f"CASE WHEN n >= 32 THEN {merged} ELSE {SEED + _P[4]}::UHUGEINT END + n::UHUGEINT")}, 'r': 1::UHUGEINT, 'q': 1::UHUGEINT, 'm': 1::UHUGEINT, 'a': 0::UHUGEINT}}, {tail}) AS parts FROM v),
r0 AS (SELECT s, list_reduce(parts, lambda z, e: {{'x': {fold}, 'r': e.r, 'q': e.q, 'm': e.m, 'a': e.a}}).x AS z FROM t),
r1 AS (SELECT s, {low(f"xor(z, z // {1 << 33}::UHUGEINT) * {p2}")} AS z FROM r0),
r2 AS (SELECT s, {low(f"xor(z, z // {1 << 29}::UHUGEINT) * {p3}")} AS z FROM r1),
h AS MATERIALIZED (SELECT s, xor(z, z // {1 << 32}::UHUGEINT) AS h FROM r2),
c AS (SELECT doc_id, s, count(*) AS c FROM s GROUP BY ALL),
g AS (SELECT doc_id, {bits} AS f FROM c JOIN h USING (s) GROUP BY doc_id),
n AS MATERIALIZED (SELECT w.doc_id, CAST(coalesce(f, 0) AS UBIGINT) AS f FROM w LEFT JOIN g USING (doc_id)),
k AS MATERIALIZED (SELECT f, min(doc_id) AS i FROM n GROUP BY f),
l AS MATERIALIZED (SELECT a.i AS u, b.i AS v FROM k a JOIN k b ON a.i <> b.i AND bit_count(CAST(xor(a.f, b.f) AS BIT)) <= {radius}),
r AS (SELECT i AS a, i AS z FROM k UNION SELECT r.a, l.v FROM r JOIN l ON l.u = r.z WHERE r.a > 0 OR r.a <= 0),
m AS (SELECT a AS i, min(z) AS component_id FROM r GROUP BY a)
SELECT doc_id, lower(lpad(to_hex(n.f), 16, '0')) AS fingerprint, component_id, doc_id = component_id AS kept
FROM n JOIN k USING (f) JOIN m USING (i)
"""
