"""Mixing sources to target weights: iterative proportional fitting of token weights, DataFrame only.

Tokens (words) are summed per cell (source, language, topic) before anything is shuffled. The cells' token
weights are raked: scaled in turn so that the sums per source, per language and per topic meet their
targets, ``ROUNDS`` times. A cell's ratio of raked to available tokens times ``rate`` is the expected number
of copies of each of its documents: the whole part is certain, the fraction is drawn by a hash of seed
and id, so the draw does not depend on partitioning and is the same in every attempt of a task.

Targets are shares per value of a dimension; by default the square root of the available tokens, which
lifts small values. A value without target keeps the share zero; missing mass is rescaled.

Cases: null source or language is a value of its own (the empty text); null and empty texts have no tokens
and get 0 copies; a null id draws as the text "null"; repeated rows draw alike; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROUNDS = 8
RATE = 1.0
SEED = 1729
WORD = r"[^\x20\x09-\x0D]+"
DIMENSIONS = ("source", "lang", "topic")
# Topic of a text: the first rule that matches anywhere in it, else "prose".
TOPICS = (
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]"),
    ("listing", r" \| "),
    ("licence", r"[Ll]icen[sc]ed under|[Cc]opyright|[Aa]ll rights reserved"),
    ("emphatic", r"!!"),
)


def topic_of(text: Column, rules=TOPICS) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def described(documents: DataFrame, source: str, lang: str, text: str, rules) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumns(
        {
            "_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
            "_lang": F.coalesce(F.col(lang).cast("string"), F.lit("")),
            "_topic": topic_of(whole, rules),
            "_tokens": F.regexp_count(whole, F.lit(WORD)).cast("long"),
        }
    )


def default_targets(cells: DataFrame, column: str) -> DataFrame:
    """Share per value: square root of its tokens."""
    return cells.groupBy(column).agg(F.sqrt(F.sum("_n").cast("double")).alias("_target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Adds _w to the cells (_source, _lang, _topic, _n): the raked token weights, in total as many as given."""
    out = cells.withColumn("_w", F.col("_n").cast("double"))
    whole = cells.agg(F.sum("_n").cast("double").alias("_total"))
    for name in DIMENSIONS:
        given = (targets or {}).get(name)
        share = default_targets(cells, f"_{name}") if given is None else given.toDF(f"_{name}", "_target")
        live = share.join(cells.groupBy(f"_{name}").agg(F.sum("_n").alias("_has")).filter("_has > 0").drop("_has"), f"_{name}")
        mass = float(live.agg(F.sum("_target").alias("_all")).first()["_all"] or 1.0)
        out = out.join(live.select(f"_{name}", (F.col("_target") / mass).alias(f"_t_{name}")), f"_{name}", "left")
    total = float(whole.first()["_total"] or 0.0)
    for turn in range(rounds):
        for name in DIMENSIONS:
            have = F.sum("_w").over(Window.partitionBy(f"_{name}"))
            want = F.coalesce(F.col(f"_t_{name}"), F.lit(0.0)) * total
            out = out.withColumn("_w", F.when(have > 0, F.col("_w") * (want / have)).otherwise(F.lit(0.0)))
        if turn % 4 == 3 or turn == rounds - 1:
            out = materialize(out)
    return out.select(*[f"_{d}" for d in DIMENSIONS], "_n", "_w")


def mix(
    documents: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    rate: float = RATE,
    rounds: int = ROUNDS,
    seed: int = SEED,
    key: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    text: str = "text",
    rules=TOPICS,
) -> DataFrame:
    """Adds topic, n_tokens, weight (expected copies) and copies, replacing columns of these names."""
    rows = described(documents, source, lang, text, rules)
    at = [f"_{d}" for d in DIMENSIONS]
    cells = materialize(rows.groupBy(*at).agg(F.sum("_tokens").alias("_n")))
    raked = rake(cells, targets, rounds)
    expected = F.when(F.col("_n") > 0, F.col("_w") / F.col("_n") * rate).otherwise(F.lit(0.0))
    weights = materialize(raked.select(*at, expected.alias("_weight")))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))), 1, 8), 16, 10).cast("double") / 4294967296.0
    certain = F.floor("_weight")
    copies = F.when(F.col("_tokens") > 0, certain + F.when(draw < F.col("_weight") - certain, 1).otherwise(0)).otherwise(0)
    named = {"topic": F.col("_topic"), "n_tokens": F.col("_tokens"), "weight": F.round("_weight", 6), "copies": copies.cast("int")}
    out = rows.join(weights, at, "left")
    return out.select(*[c for c in documents.columns if c not in named], *[c.alias(n) for n, c in named.items()])


def mixture(documents: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, copies for every row of ``documents``."""
    return mix(documents.select("doc_id", "source", "lang", "text")).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "copies")


def mixture_sql(documents: str = "documents", rounds: int = ROUNDS, rate: float = RATE, seed: int = SEED) -> str:
    """The same as a chain of SQL steps, one per scaling."""
    topic = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS) + " ELSE 'prose' END"
    steps = [
        f"d AS (SELECT *, coalesce(text, '') AS t FROM {documents})",
        f"""e AS (SELECT doc_id, source, lang, coalesce(source, '') AS _source, coalesce(lang, '') AS _lang, {topic} AS _topic,
            CAST(len(regexp_extract_all(t, '{WORD}')) AS BIGINT) AS n_tokens FROM d)""",
        "c AS (SELECT _source, _lang, _topic, CAST(sum(n_tokens) AS DOUBLE) AS n FROM e GROUP BY ALL)",
    ]
    for name in DIMENSIONS:
        steps.append(f"t_{name} AS (SELECT _{name}, sqrt(sum(n)) / sum(sqrt(sum(n))) OVER () AS s FROM c GROUP BY _{name} HAVING sum(n) > 0)")
    sides = " ".join(f"LEFT JOIN t_{x} USING (_{x})" for x in DIMENSIONS)
    steps.append(f"w0 AS (SELECT c.*, sum(n) OVER () AS total, n AS w, {', '.join(f't_{x}.s AS s_{x}' for x in DIMENSIONS)} FROM c {sides})")
    last = "w0"
    for turn in range(rounds):
        for name in DIMENSIONS:
            now = f"w{turn}_{name}"
            have = f"sum(w) OVER (PARTITION BY _{name})"
            steps.append(f"{now} AS (SELECT * REPLACE (CASE WHEN {have} > 0 THEN w * (coalesce(s_{name}, 0) * total / {have}) ELSE 0 END AS w) FROM {last})")
            last = now
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
x AS (SELECT e.*, CASE WHEN n > 0 THEN w / n * {rate}::DOUBLE ELSE 0 END AS p,
  CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS UBIGINT) / 4294967296.0::DOUBLE AS u
  FROM e JOIN {last} USING (_source, _lang, _topic))
SELECT doc_id, source, lang, _topic AS topic, n_tokens, round(p, 6) AS weight,
  CAST(CASE WHEN n_tokens > 0 THEN floor(p) + CASE WHEN u < p - floor(p) THEN 1 ELSE 0 END ELSE 0 END AS INTEGER) AS copies
FROM x"""
    )
