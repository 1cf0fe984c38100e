"""SimHash groups, the prefix trie and ranked search against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stockweave.llm import prefix_trie, ranked_search, simhash

DOCS = "doc_id long, text string"
LONG = "word and more words of it " * 9000


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ------------------------------------------------------------ 11 SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints, radius=2):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(list(root), 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    return {f: find(f) for f in prints}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_of_positions_is_left_out_by_a_mask(radius):
    masks = simhash.covering(list(range(64)), radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for left_out in itertools.combinations(range(64), radius):
        assert any(all(not m >> p & 1 for p in left_out) for m in masks)


def test_three_coverings_bound_a_bucket():
    masks, free = simhash.covering(list(range(64))), []
    for _ in range(3):
        free.append(max(64 - m.bit_count() for m in masks))
        masks = simhash.refined(masks)
    assert free == [28, 12, 6] and 2 ** free[2] <= simhash.LIMIT


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_fingerprints_equal_the_definition(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    texts = ["", " \t\n", "One", "one two", "A b C", "ÄÖ x y z", "a b c " * 40, "\U0001f600 " * 5]
    texts += [" ".join(random.Random(s).choices("the of and Data SET x y z".split(), k=s)) for s in range(3, 60)]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t), t


@pytest.mark.parametrize("case", ["spread", "crowded", "star"])
def test_no_link_is_missed(spark, case):
    draw = random.Random(5)
    if case == "spread":
        base = [draw.getrandbits(64) for _ in range(60)]
        prints = base + [f ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for f in base for _ in range(3)]
    elif case == "crowded":  # 700 of 4096 neighbours: buckets are refined up to three times
        prints = [0xABCD << 48 | x for x in draw.sample(range(1 << 12), 700)]
    else:
        prints = [0] + [1 << b for b in range(64)] + [1 << b | 1 << c | 1 << 63 for b in range(0, 60, 2) for c in range(1, 60, 7) if b != c]
    prints = sorted(set(prints))
    rows = spark.createDataFrame([(simhash.signed(f),) for f in prints], "_f long")
    got = {frozenset((r["_u"], r["_v"])) for r in simhash.fingerprint_links(rows).collect()}
    want = {frozenset((simhash.signed(a), simhash.signed(b))) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2}
    assert got == want and want


def test_simhash_groups_whole_documents(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    changed = {10_000 + i: t + " x" for i, t in list(texts.items())[:40]} | {20_000 + i: t for i, t in list(texts.items())[:20]}
    both = texts | changed
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark.createDataFrame(list(both.items()), DOCS)).collect()}
    prints = {i: plain_fingerprint(t) for i, t in both.items()}
    groups, least = plain_groups(set(prints.values())), {}
    for i in sorted(both):
        least.setdefault(groups[prints[i]], i)
    assert len(got) == len(both)
    for i in both:
        assert got[i]["fingerprint"] == f"{prints[i]:016x}"
        assert got[i]["component_id"] == least[groups[prints[i]]] and got[i]["kept"] == (got[i]["component_id"] == i)


def test_simhash_edge_cases(spark):
    rows = [(5, None, "k"), (4, "", "k"), (9, " \n\t ", "k"), (7, "one two", "k"), (7, "one two", "k"), (8, LONG, "k"), (6, LONG, "k"), (None, LONG, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _f string").repartition(3)
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"], r["kept"]) for r in simhash.near_duplicates(docs).collect())
    many, few = f"{plain_fingerprint(LONG):016x}", f"{plain_fingerprint('one two'):016x}"
    zero = "0" * 16
    assert got == [(-1, many, None, True), (4, zero, 4, True), (5, zero, 4, False), (6, many, 6, True), (7, few, 7, True), (7, few, 7, True), (8, many, 6, False), (9, zero, 4, False)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# ------------------------------------------------------------ 12 prefix trie


def plain_trie(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        turns = [t[2:] for t in sorted(turns)]
        if rebuild:
            base, h = int(math.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6
            first = [t[2:] for t in sorted(own.get(c - base, []))]
            turns = first[:h] + turns[h:]
        paths[c] = tuple(turns)
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if len(paths[c]) == len(p)).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], ends(p)) for p, m in members.items()
    )


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_rebuilt_conversations(spark, seed):
    draw, rows = random.Random(seed), []
    for c in [*range(0, 130), *range(300, 330), -7, -205, -200]:
        if c not in (4, 300):
            kind = draw.randrange(4)
            length = 31 if c == 17 else draw.randrange(1, 9)
            rows += [(c, None if t == 0 else t, draw.choice([None, "user"]) if kind == 0 else "user", "hi" * (t % 3) if kind else draw.choice([None, "a", "ä\U0001f600"])) for t in range(length)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("_c", F.lit("x")).withColumn("_i1", F.lit(1)).repartition(5)
    assert trie_rows(prefix_trie.family_trie(df)) == plain_trie(rows)


@pytest.mark.parametrize("size", [1, 3, 4])
def test_trie_for_any_size_of_block(spark, size):
    draw = random.Random(9)
    rows = [(c, t, "u", draw.choice("ab")) for c in range(60) for t in range(draw.randrange(1, 12))]
    turns = prefix_trie.digested(spark.createDataFrame(rows, CONVERSATIONS))
    assert trie_rows(prefix_trie.prefix_trie(turns, turns.select("_c").distinct(), size)) == plain_trie(rows, rebuild=False)


def test_trie_of_many_equal_conversations(spark, monkeypatch):
    """One node where most conversations end: its list is hashed in pieces from several partitions."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    rows = [(c, t, "u", "same" if c % 5 else f"x{c}") for c in range(400) for t in range(3)]
    turns = prefix_trie.digested(spark.createDataFrame(rows, CONVERSATIONS))
    assert trie_rows(prefix_trie.prefix_trie(turns, turns.select("_c").distinct())) == plain_trie(rows, rebuild=False)


def test_trie_edge_cases(spark):
    rows = [(None, 0, "u", "lost"), (1, 0, None, None), (1, 0, None, None), (1, None, "u", "first"), (2, 5, "u", LONG), (101, 1, "u", "b"), (101, 1, "u", "a")]
    assert trie_rows(prefix_trie.family_trie(spark.createDataFrame(rows, CONVERSATIONS))) == plain_trie(rows)
    empty = spark.createDataFrame(rows, CONVERSATIONS)
    assert prefix_trie.family_trie(empty.limit(0)).count() == 0
    assert prefix_trie.family_trie(empty.filter("conv_id is null")).count() == 0


def test_running_totals_of_a_long_group(spark):
    rows = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") < 4000, F.lit(3)).otherwise(F.col("id") % 5).alias("g"), F.col("id").alias("o"))
    got = prefix_trie.running(rows, "g", ["o"], {"n": F.count(F.lit(1)), "_x": F.bit_xor("o")}).toPandas().sort_values(["g", "o"])
    want = rows.toPandas().sort_values(["g", "o"])
    assert got["n"].tolist() == (want.groupby("g").cumcount() + 1).tolist()
    xors = want.groupby("g")["o"].transform(lambda s: np.bitwise_xor.accumulate(s.to_numpy()))
    assert got["_x"].tolist() == xors.tolist()


# ------------------------------------------------------------ 13 ranked search


def plain_ranks(docs, items, k=20):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    total, n = sum(c.total() for _, c in counts), sum(1 for _, c in counts if c)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, c in counts:
            m = 75 + 25 * c.total() * n // total if total else 0
            s = sum(q * weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if s > 0:
                found.append((-s, math.inf if i is None else i))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def search_rows(df):
    return sorted([(r["item_id"], r["rank"], math.inf if r["doc_id"] is None else r["doc_id"], r["score"]) for r in df.collect()], key=str)


ITEMS = "item_id long, text string"
VOCABULARY = [f"w{int(k)}" for k in np.random.default_rng(3).zipf(1.3, 4000) if k < 400]


def random_texts(n, seed, longest=60):
    draw = random.Random(seed)
    return [" ".join(draw.choices(VOCABULARY, k=draw.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("block", [8, 4096])
def test_ranked_search_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    docs = list(enumerate(random_texts(500, 1)))
    docs += [(1000 + i, docs[i][1]) for i in range(30)]  # equal scores
    items = list(enumerate(random_texts(40, 2, 30))) + [(90, "W1 w1 w2-w3_w4"), (91, docs[7][1])]
    got = ranked_search.ranked(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS))
    assert search_rows(got) == plain_ranks(docs, items)


def test_ranked_search_in_groups_of_queries(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", 50)
    docs, items = list(enumerate(random_texts(200, 4))), list(enumerate(random_texts(30, 5, 20)))
    got = ranked_search.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 5)
    assert search_rows(got) == plain_ranks(docs, items, 5)


def test_bounds_hold_and_skip(spark, monkeypatch):
    """Pair bounds are never below a score and never above the sum of single bounds; blocks are skipped by them."""
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 8)
    docs, items = list(enumerate(random_texts(400, 6))), list(enumerate(random_texts(30, 7, 20)))
    frame, asked = spark.createDataFrame(docs, DOCS), ranked_search.query_terms(spark.createDataFrame(items, ITEMS))
    index = ranked_search.build_index(frame)
    df = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("z")).groupBy(F.col("z.terms").alias("term")).agg(F.sum("z.sizes").alias("df"))
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    group = ranked_search.Queries(asked.join(df, "term").toPandas(), *totals)
    lists = ranked_search.impact_lists(index, spark.sparkContext.broadcast(group))
    group.set_thresholds(ranked_search.floors(lists, "terms", "most", 5), ranked_search.floors(lists, "pairs", "joint", 5))
    scores = defaultdict(list)
    for item, _, _, s in plain_ranks(docs, items, 400):
        scores[item].append(s)
    names = dict(asked.select("_q", "_item").distinct().collect())
    skipped = tighter = 0
    for row in lists.toPandas().itertuples(index=False):
        block = ranked_search.Block(row, len(group.weights), len(group.pairs))
        for n, (q, t, times, numbers) in enumerate(group.items):
            pairs, single = ranked_search.pair_bounds(times, block.most[t], block.joint[numbers]).sum(), int((times * block.most[t]).sum())
            _, all_scores = block.candidates(t, times, numbers, 1, 400)
            assert pairs <= single and (len(all_scores) == 0 or all_scores.max() <= pairs)
            tighter += pairs < single
            skipped += pairs < group.start[n] <= single
    for n, (q, *_) in enumerate(group.items):
        assert group.start[n] <= sorted(scores[names[q]], reverse=True)[4]
    assert tighter > 100 and skipped > 10


def test_ranked_search_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "\x85alpha beta"), (4, "alpha  BETA"), (4, "alpha BETA"), (None, "alpha beta"), (2**60 + 1, "alpha beta"), (5, LONG), (6, "é-è \U0001f600"), (7, "... !")]
    items = [(1, "Alpha beta alpha"), (1, "word"), (None, "é"), (3, None), (4, ""), (5, "unknown"), (6, LONG)]
    d = spark.createDataFrame(docs, DOCS).withColumn("_id", F.lit("x")).withColumn("terms", F.lit(1)).repartition(3)
    i = spark.createDataFrame(items, ITEMS).withColumn("_q", F.lit("x")).withColumn("term", F.lit(1))
    assert search_rows(ranked_search.ranked(d, i)) == plain_ranks(docs, items)
    assert ranked_search.ranked(d.limit(0), i).count() == 0 and ranked_search.ranked(d, i.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [1 << 22, 5])
def test_terms_are_those_of_the_pattern(monkeypatch, piece):
    monkeypatch.setattr(ranked_search, "PIECE", piece)
    draw = random.Random(8)
    for _ in range(300):
        text = "".join(draw.choices("aZ09 .-_@[`{~\x7f\x80\x85\xa0é \U0001f600\n\t\x00", k=draw.randrange(40)))
        want = Counter(x.encode() for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))
        assert ranked_search.term_counts(text) == want
