"""Trie of conversation prefixes by fixed-length block hashing.

A turn becomes a digest of two 64-bit hashes of its role and text where it is read; no text is shuffled. Mixed
with their positions the digests of a prefix add up by exclusive or, so a prefix is named by 128 bits, and the
prefixes of one conversation are running totals. ``BLOCK`` turns make a block. Conversations are
grouped by the digests of their prefixes at block ends first: each group, a class, stands for all its
conversations from there on. Where a class has no sibling, its turns are nodes as they are; turn boundaries are
grouped only where the classes below one block end differ.

Sums over subtrees need no walk. Call the smallest member of a node its owner, and A(c) the code points conversation
c has in front of its first owned node. The text repeated in a subtree is the sum of A over the members without the
owner, less (members - 1) times the code points above the node; and the leaves of a subtree are its members that own a
childless node. Both are sums over members, so over classes.

Running totals are taken along range partitions, so a conversation of very many turns, or a node where very many
conversations end, is spread over tasks; the list of a node's ends is joined to texts of up to
``CHUNK`` ids in parallel, and one task streams a node's few texts through its hash.

Cases: null turns come first, rows of one turn number in the order of their digests (equal rows count each); null
roles and texts are empty; rows without a conversation id take no part; a conversation without turns is a
member of the root only; an empty table gives an empty result; texts of any length count whole; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BLOCK = 4
CHUNK = 4096
FAMILY, SHARED = 100, 6
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ID, PARENT = ["_i1", "_i2"], ["_p1", "_p2"]


def running(df: DataFrame, group: str, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """Adds running totals inside each group along ``order`` (unique in a group, or among equal rows).

    ``totals``: name to F.sum, F.count or F.bit_xor of a column; names starting with ``_x`` are xors. Rows are range
    partitioned, so one group may take many partitions; what a group has in earlier partitions
    comes from a table of at most two rows per partition.
    """
    placed = materialize(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()))
    ends = placed.groupBy("_part").agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
    outer = placed.join(F.broadcast(ends), "_part").filter(F.col(group).isin(F.col("_low"), F.col("_high")))
    parts = outer.groupBy("_part", group).agg(*[agg.alias(name) for name, agg in totals.items()])
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = {name: (F.bit_xor if name.startswith("_x") else F.sum)(name) for name in totals}
    before = parts.select("_part", group, *[F.coalesce(agg.over(earlier), F.lit(0)).alias(f"{name}_before") for name, agg in whole.items()])
    inside = Window.partitionBy("_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = placed.join(F.broadcast(materialize(before)), ["_part", group], "left")
    for name, agg in totals.items():
        start = F.coalesce(f"{name}_before", F.lit(0))
        both = both.withColumn(name, start.bitwiseXOR(agg.over(inside)) if name.startswith("_x") else start + agg.over(inside))
    return both.drop("_part", *[f"{name}_before" for name in totals])


def digested(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """_c, _at, _d1, _d2, _len: conversation, position from 1, digest and code points of each turn."""
    words = F.coalesce(F.col(text), F.lit(""))
    said = [F.coalesce(F.col(role), F.lit("")), words]
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("_c"),
        F.col(turn).alias("_turn"),
        F.xxhash64(F.lit(1), *said).alias("_d1"),
        F.xxhash64(F.lit(2), *said).alias("_d2"),
        F.length(words).cast("long").alias("_len"),
    )
    numbered = running(rows, "_c", ["_turn", "_d1", "_d2"], {"_at": F.count(F.lit(1))})
    return materialize(numbered.select("_c", "_at", "_d1", "_d2", "_len"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their first turns with the first one of their family, and all ids.

    Conversation c takes the first h turns of conversation c - c % FAMILY, then its own turns after its first
    h; h is crc32 of its decimal id modulo SHARED. At most SHARED - 1 turns of a conversation are copied.
    """
    own = turns.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    ids = own.select("_c", (F.col("_c") - F.col("_c") % FAMILY).alias("_base"), (F.crc32(F.col("_c").cast("string")) % SHARED).alias("_h"))
    heads = turns.filter((F.col("_c") % FAMILY == 0) & (F.col("_at") < SHARED))
    heads = heads.groupBy(F.col("_c").alias("_base")).agg(F.collect_list(F.struct("_at", "_d1", "_d2", "_len")).alias("_head"))
    ids = materialize(ids.join(heads, "_base", "left"))
    taken = ids.select("_c", F.explode(F.filter("_head", lambda t: t["_at"] <= F.col("_h"))).alias("_t")).select("_c", "_t.*")
    shift = ids.select("_c", "_h", (F.least("_h", F.coalesce(F.array_size("_head"), F.lit(0))) - F.col("_h")).alias("_shift"))
    rest = turns.join(shift, "_c").filter(F.col("_at") > F.col("_h")).withColumn("_at", F.col("_at") + F.col("_shift"))
    return taken.unionByName(rest.select(*taken.columns)), ids.select("_c")


def blocks(turns: DataFrame, size: int) -> DataFrame:
    """One row per conversation and block: its turns, the prefix digests before (_p) and after it (_x)."""
    mixed = [F.xxhash64(F.lit(s), "_at", "_d1", "_d2").alias(f"_e{s}") for s in (1, 2)]
    rows = turns.select("_c", F.floor((F.col("_at") - 1) / size).alias("_k"), "_at", "_len", *mixed)
    cut = rows.groupBy("_c", "_k").agg(
        F.bit_xor("_e1").alias("_b1"),
        F.bit_xor("_e2").alias("_b2"),
        F.sum("_len").alias("_chars"),
        F.sort_array(F.collect_list(F.struct("_at", "_e1", "_e2", "_len"))).alias("_turns"),
    )
    out = running(cut, "_c", ["_k"], {"_x1": F.bit_xor("_b1"), "_x2": F.bit_xor("_b2"), "_total": F.sum("_chars")})
    before = [F.col(f"_x{s}").bitwiseXOR(F.col(f"_b{s}")).alias(f"_p{s}") for s in (1, 2)]
    return materialize(out.select("_c", "_k", "_x1", "_x2", *before, "_total", (F.col("_total") - F.col("_chars")).alias("_above"), "_turns"))


def class_turns(classes: DataFrame) -> DataFrame:
    """The turns of each class as nodes: digest, parent's digest, depth, code points and those above."""

    def folded(start: str, name: str, upto: Column) -> Column:
        return F.aggregate(F.slice("_turns", F.lit(1), upto), F.col(start), lambda z, t: z.bitwiseXOR(t[name]))

    def node(t: Column, i: Column) -> Column:
        above = F.aggregate(F.slice("_turns", F.lit(1), i), F.col("_above"), lambda z, x: z + x["_len"])
        ids = [folded(f"_p{s}", f"_e{s}", i + 1).alias(f"_i{s}") for s in (1, 2)]
        parents = [folded(f"_p{s}", f"_e{s}", i).alias(f"_p{s}") for s in (1, 2)]
        return F.struct(*ids, *parents, t["_at"].alias("_depth"), t["_len"].alias("_len"), above.alias("_above"))

    return classes.select("_x1", "_x2", "_n", "_least", F.explode(F.transform("_turns", node)).alias("_t")).select("_x1", "_x2", "_n", "_least", "_t.*")


def end_hashes(ends: DataFrame) -> DataFrame:
    """_i1, _i2, _sha: SHA-256 of the ascending comma-joined ids (_c) that end at each node."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for (a, b), part in batch.groupby(ID, sort=False)["_c"]:
                ids = part.tolist()
                out += [(a, b, ids[at], ",".join(map(str, ids[at : at + CHUNK]))) for at in range(0, len(ids), CHUNK)]
            yield pd.DataFrame(out, columns=[*ID, "_first", "_ids"])

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(batch["_i1"], batch["_i2"], batch["_ids"]):
                if (a, b) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=[*ID, "_sha"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*ID, "_sha"])

    placed = ends.select(*ID, "_c").repartitionByRange(*ID, "_c").sortWithinPartitions(*ID, "_c")
    texts = placed.mapInPandas(join, "_i1 long, _i2 long, _first long, _ids string")
    return texts.repartition(*ID).sortWithinPartitions(*ID, "_first").mapInPandas(digest, "_i1 long, _i2 long, _sha string")


def prefix_trie(turns: DataFrame, ids: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of ``turns`` (as of ``digested``), the root included.

    ``ids`` (_c) lists all conversations, also those without turns. Columns: node_1, node_2 (the prefix digest), conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    cut = blocks(turns, size)
    classes = materialize(
        cut.groupBy("_p1", "_p2", "_x1", "_x2").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_c").alias("_least"), F.first("_above").alias("_above"), F.first("_turns").alias("_turns")
        )
    )
    split = materialize(classes.groupBy(*PARENT).count().filter("count > 1").select(*PARENT))
    steps = materialize(
        class_turns(classes.join(split, PARENT, "left_anti"))
        .withColumn("_split", F.lit(False))
        .unionByName(class_turns(classes.join(split, PARENT, "left_semi")).withColumn("_split", F.lit(True)))
    )
    node = [*ID, *PARENT, "_depth", "_len", "_above", "_n", "_least"]
    refined = steps.filter("_split").groupBy(*node[:-2]).agg(F.sum("_n").alias("_n"), F.min("_least").alias("_least"))
    none = [F.lit(0).cast("long").alias(c) for c in ID]
    root = ids.agg(F.count(F.lit(1)).alias("_n"), F.min("_c").alias("_least")).filter("_n > 0").select(
        *none, *[F.lit(None).cast("long").alias(c) for c in PARENT], *[F.lit(0).cast("long").alias(c) for c in node[4:7]], "_n", "_least"
    )
    nodes = steps.filter("not _split").select(*node).unionByName(refined).unionByName(root)
    children = nodes.filter("_depth > 0").groupBy(*[F.col(p).alias(i) for p, i in zip(PARENT, ID)]).agg(F.count(F.lit(1)).alias("_children"))
    nodes = materialize(nodes.join(children, ID, "left").withColumn("_children", F.coalesce("_children", F.lit(0))))

    owners = nodes.groupBy(F.col("_least").alias("_c")).agg(
        F.min_by("_above", "_depth").alias("_a"), F.max((F.col("_children") == 0).cast("long")).alias("_leaf")
    )
    owners = materialize(owners)
    last = cut.groupBy("_c").agg(F.max(F.struct("_k", "_x1", "_x2", "_total")).alias("_last"))
    members = materialize(
        ids.join(last, "_c", "left").join(owners, "_c", "left").select(
            "_c",
            *[F.coalesce(f"_last._x{s}", F.lit(0)).cast("long").alias(f"_i{s}") for s in (1, 2)],
            F.coalesce("_a", "_last._total", F.lit(0)).cast("long").alias("_a"),
            F.coalesce("_leaf", F.lit(0)).cast("long").alias("_leaf"),
        )
    )
    sums = [F.sum("_a").alias("_a"), F.sum("_leaf").alias("_leaf")]
    of_class = cut.select("_c", "_x1", "_x2").join(members.select("_c", "_a", "_leaf"), "_c").groupBy("_x1", "_x2").agg(*sums)
    of_node = steps.select("_x1", "_x2", *ID).join(of_class, ["_x1", "_x2"]).groupBy(*ID).agg(*sums)
    of_node = of_node.unionByName(members.agg(*sums).select(*none, "_a", "_leaf"))

    above = nodes.select(*[F.col(i).alias(p) for i, p in zip(ID, PARENT)], F.col("_least").alias("parent_conv_id"))
    own = owners.select(F.col("_c").alias("_least"), F.col("_a").alias("_own"))
    out = nodes.join(above, PARENT, "left").join(of_node, ID).join(own, "_least").join(end_hashes(members), ID, "left")
    return out.select(
        F.col("_i1").alias("node_1"),
        F.col("_i2").alias("node_2"),
        F.col("_least").alias("conv_id"),
        F.col("_depth").alias("depth"),
        "parent_conv_id",
        F.col("_n").alias("n_convs"),
        F.col("_children").alias("n_children"),
        F.col("_leaf").alias("n_leaves"),
        (F.col("_a") - F.col("_own") - (F.col("_n") - 1) * F.col("_above")).alias("saved_tokens"),
        F.coalesce("_sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def family_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns, ids = rebuilt(digested(conversations))
    return prefix_trie(turns, ids).drop("node_1", "node_2")


# crc32 bit by bit: DuckDB has no function of that name.
_CRC = "list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))), lambda z, x: {})"


def family_trie_sql() -> str:
    state = "xor(z, x)"
    # Eight shifts of the reflected polynomial, one after the other.
    step = "list_reduce([{start}, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda y, o: xor(y >> 1, (y & 1) * 3988292384::UBIGINT))".replace("{start}", state)
    crc = "xor(" + _CRC.format(step) + ", 4294967295::UBIGINT)"
    return f"""
WITH t AS MATERIALIZED (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS s FROM conversations WHERE conv_id IS NOT NULL),
i AS MATERIALIZED (SELECT DISTINCT c, c - c % {FAMILY} AS base FROM t),
h AS MATERIALIZED (SELECT c, base, CAST({crc} % {SHARED} AS BIGINT) AS h FROM i),
b AS (
  SELECT h.c, 0 AS own, t.place, t.s FROM h JOIN t ON t.c = h.base AND t.place <= h.h
  UNION ALL SELECT h.c, 1, t.place, t.s FROM h JOIN t ON t.c = h.c AND t.place > h.h),
l AS MATERIALIZED (SELECT h.c, coalesce(list(b.s ORDER BY own, place) FILTER (WHERE b.s IS NOT NULL), []) AS turns FROM h LEFT JOIN b ON b.c = h.c GROUP BY h.c),
p AS MATERIALIZED (
  SELECT c, len(turns) AS n, d AS depth, md5(CAST(turns[1 : d] AS VARCHAR) || '|' || d) AS node,
         CASE WHEN d > 0 THEN md5(CAST(turns[1 : d - 1] AS VARCHAR) || '|' || (d - 1)) END AS parent,
         CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS chars
  FROM l, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d)),
v AS MATERIALIZED (
  SELECT node, parent, depth, chars, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM p GROUP BY node, parent, depth, chars),
k AS MATERIALIZED (SELECT parent AS node, count(*) AS n_children FROM v WHERE parent IS NOT NULL GROUP BY parent),
u AS (
  SELECT p.node, CAST(sum((v.n_convs - 1) * v.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves
  FROM v LEFT JOIN k ON k.node = v.node JOIN p ON p.c = v.conv_id AND p.depth <= v.depth GROUP BY p.node)
SELECT v.conv_id, v.depth, o.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, u.n_leaves, u.saved_tokens, v.ends_sha256
FROM v JOIN u ON u.node = v.node LEFT JOIN k ON k.node = v.node LEFT JOIN v o ON o.node = v.parent
"""
