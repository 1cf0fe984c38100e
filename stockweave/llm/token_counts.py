"""Token counts by a map-side two-tier lookup.

A text is cut into pre-tokens by the tokenizer's own pattern. The length in tokens of a frequent
pre-token comes from a broadcast table of at most ``TABLE_SIZE`` entries; any other pre-token is
encoded once per worker and kept in that worker's bounded cache. No pre-token is ever shuffled.
The table only saves time: counts are the same whatever it holds.

Cases: null and empty texts have 0 bytes and 0 tokens; special strings inside a text count as the
tokenizer counts them by default (one token each); long texts are cut and looked up like others;
repeated rows count alike; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
from collections import Counter

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_udf, tokenizer_folder

TABLE_SIZE = 1 << 16  # entries of the broadcast table
SAMPLE_ROWS = 2000  # texts whose pre-tokens fill it
CACHE_SIZE = 300_000  # entries a worker keeps beside it
VOCABULARY = "byte_bpe_50k.json"
SCHEMA = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

_workers: dict = {}


class Lengths(dict):
    """Token length per pre-token: the broadcast table, then this worker's own encodings."""

    def __init__(self, table: dict, path: str):
        from tokenizers import Tokenizer

        super().__init__(table)
        self.table, self.tokenizer = table, Tokenizer.from_file(path)

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(self) >= len(self.table) + CACHE_SIZE:
            self.clear()
            self.update(self.table)
        self[piece] = n
        return n


def splitter(folder, path: str):
    """Function from a text to (special tokens in it, its pre-tokens)."""
    pattern = regex.compile(folder.PATTERN)
    with open(path, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens", []) if t["special"]]
    parts = regex.compile("|".join(map(regex.escape, special))) if special else None

    def split(text: str) -> tuple[int, list[str]]:
        if parts is None or not parts.search(text):
            return 0, pattern.findall(text)
        between = parts.split(text)
        return len(between) - 1, [piece for x in between for piece in pattern.findall(x)]

    return split


def frequent(documents: DataFrame, folder: str, vocabulary: str, text_column: str = "text") -> dict:
    """Lengths of the most frequent pre-tokens of a bounded sample of texts."""
    names = tokenizer_folder(folder)
    split = splitter(names, names.path(vocabulary))
    total = documents.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    rows = documents.select(text_column).sample(share, seed=29).limit(2 * SAMPLE_ROWS).collect()
    seen: Counter = Counter()
    for row in rows:
        seen.update(split(row[0] or "")[1])
    lengths = Lengths({}, names.path(vocabulary))
    return {piece: lengths[piece] for piece, _ in seen.most_common(TABLE_SIZE)}


def counter(table: dict, folder: str, vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    names = tokenizer_folder(folder)
    path = names.path(vocabulary)
    key = (path, len(table), hash(frozenset(table)))
    if key not in _workers:
        _workers.clear()
        _workers[key] = Lengths(table, path), splitter(names, path)
    lengths, split = _workers[key]

    def count(texts: list[str]) -> dict:
        sizes, tokens = [], []
        for text in texts:
            special, pieces = split(text)
            sizes.append(len(text.encode("utf-8", "surrogatepass")))
            tokens.append(special + sum(map(lengths.__getitem__, pieces)))
        return {"n_bytes": sizes, "n_tokens": tokens}

    return count


def count_tokens(
    documents: DataFrame,
    text_column: str = "text",
    folder: str = "/opt/tokenizers",
    vocabulary: str = VOCABULARY,
    prefix: str = "",
) -> DataFrame:
    """Adds n_bytes and n_tokens (replacing columns of these names) of the whole text."""
    table = frequent(documents, folder, vocabulary, text_column)
    shared = documents.sparkSession.sparkContext.broadcast(table)
    udf = text_udf(SCHEMA, lambda: counter(shared.value, folder, vocabulary))
    return (
        documents.withColumn("_tokens", udf(F.col(text_column)))
        .withColumn(f"{prefix}n_bytes", F.col("_tokens.n_bytes"))
        .withColumn(f"{prefix}n_tokens", F.col("_tokens.n_tokens"))
        .drop("_tokens")
    )


def token_counts(documents: DataFrame, limit: int = 1024, folder: str = "/opt/tokenizers") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``documents``."""
    return count_tokens(documents.select("doc_id", "text"), folder=folder).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
