"""Language identification by Bayesian fusion of several kinds of evidence.

    log P(l | page) = tempered text log-likelihood + log P(declared | l) + log P(suffix | l) + log prior(l | host)

* text: hashed 1- to 3-grams of code points under one smoothed model per language, over the whole
  text; the mean per n-gram times at most ``TEXT_WEIGHT`` n-grams, because neighbours are dependent;
* declared: the language named by markup, right with probability ``DECLARED_RIGHT``;
* suffix: the language named by the address (two-letter path part or country suffix), likewise;
* host: soft counts of the text model's posteriors, summed by grouped aggregation per host, shrunk
  towards the host's domain, which is shrunk towards all rows.

A document takes the evidence of all its pages: their declarations and suffixes add up, their hosts' log priors
are averaged. A document without page has its text and its source as host; the column that names its language
trains the text models and is no evidence of the answer. Every language of that column is modelled, at
``BUCKETS`` floats (0.26 MB) each.

Cases: a missing declaration, suffix or host is no evidence (the prior of all rows remains); a text
without letters gives no text evidence; such rows and rows whose best posterior is below
``min_confidence`` are rejected. Ties go to the language first in the model. Repeated rows get the
same answer, repeated rows of a page count once, a page whose address names no document is left out; an empty
table gives an empty result. Columns of any other name are left as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import text_udf

BUCKETS = 1 << 16
TEXT_WEIGHT = 60.0
DECLARED_RIGHT = 0.9
SUFFIX_RIGHT = 0.8
HOST_STRENGTH, DOMAIN_STRENGTH = 20.0, 50.0
MIN_CONFIDENCE = 0.6
TRAIN_ROWS = 400  # bound of the sample per language
ALPHABETIC = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
ANSWER = ("predicted_lang", "confidence", "accepted")
SCHEMA = T.StructType([T.StructField("letters", T.LongType()), T.StructField("loglik", T.ArrayType(T.DoubleType()))])


def gram_ids(text: str) -> tuple[int, np.ndarray]:
    """Number of letters, and buckets of all 1- to 3-grams; everything but letters is one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = ALPHABETIC[points]
    points = np.where(letters, points, 32).astype(np.uint32)
    n = int(letters.sum())
    if n == 0:
        return 0, np.zeros(0, np.int64)
    keep = letters | np.concatenate([[True], letters[:-1]])
    points = np.concatenate([[32], points[keep], [32]]).astype(np.uint32)
    parts, h = [points], points
    for k in (1, 2):
        h = h[:-1] * np.uint32(0x01000193) ^ points[k:]
        parts.append(h + np.uint32(k * 7919))
    ids = np.concatenate(parts) * np.uint32(0x9E3779B1)
    return n, (ids >> np.uint32(16)).astype(np.int64)


def train(texts: list[str], languages: list[str], known: list[str]) -> dict:
    """Smoothed log-probabilities of the buckets, one column per language."""
    table = np.zeros((BUCKETS, len(known)), np.float32)
    for i, name in enumerate(known):
        counts = np.full(BUCKETS, 0.05)
        for text, language in zip(texts, languages):
            if language == name:
                counts += np.bincount(gram_ids(text)[1], minlength=BUCKETS)
        table[:, i] = np.log(counts / counts.sum())
    return {"languages": known, "table": table}


def fit(documents: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", language: str = "lang", key: str = "doc_id") -> dict:
    """Models of all languages named in ``language``, from at most ``rows`` texts of each.

    A cut on a hash of the id leaves about twice as many rows per language, of which the first in the hash's
    order are taken before anything reaches the driver.
    """
    given = documents.filter(F.col(language).isNotNull() & F.col(text).isNotNull())
    given = given.select(F.col(language).alias("_l"), F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 30)).alias("_place"), F.col(text).alias("_t"))
    counts = materialize(given.groupBy("_l").agg(F.count(F.lit(1)).alias("_n")))
    cut = F.least(F.lit(1 << 30), F.floor(F.lit(2 * rows * (1 << 30)) / F.col("_n")))
    near = given.join(counts, "_l").filter(F.col("_place") < cut)
    place = F.row_number().over(Window.partitionBy("_l").orderBy("_place", "_t"))
    found = near.withColumn("_r", place).filter(F.col("_r") <= rows).select("_l", "_t").collect()
    known = sorted(r[0] for r in counts.select("_l").collect())
    return train([r[1] for r in found], [r[0] for r in found], known)


def scorer(model: dict):
    table, k = model["table"], len(model["languages"])

    def score(texts: list[str]) -> dict:
        letters, out = [], []
        for text in texts:
            n, ids = gram_ids(text)
            letters.append(n)
            if len(ids) == 0 or k == 0:
                out.append([0.0] * k)
                continue
            total = np.zeros(k)
            for at in range(0, len(ids), 1 << 14):
                part = table[ids[at : at + (1 << 14)]]
                total += np.ones(len(part), np.float32) @ part
            out.append((total / len(ids) * min(len(ids), TEXT_WEIGHT)).tolist())
        return {"letters": letters, "loglik": out}

    return score


def once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def softmax(scores: Column) -> Column:
    """Array of probabilities from an array of log scores, in time proportional to its length."""
    shares = lambda raised: once(
        F.aggregate(raised, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(raised, lambda x: x / total)
    )
    lifted = lambda s: once(F.array_max(s), lambda best: F.transform(s, lambda x: F.exp(x - best)))
    return once(scores, lambda s: once(lifted(s), shares))


def chances(languages: list[str], right: float) -> tuple[float, float]:
    """Log-likelihood of a claim under the language it names and under any other."""
    return float(np.log(right)), float(np.log((1 - right) / max(1, len(languages) - 1)))


def claim(languages: list[str], named: Column, right: float) -> Column:
    """Log-likelihood of a claimed language under each language; an unknown claim is no evidence."""
    yes, no = chances(languages, right)
    known = F.array(*[F.lit(x) for x in languages])
    believed = F.transform(known, lambda name: F.when(named == name, yes).otherwise(no))
    return F.when(F.array_contains(known, named), believed).otherwise(F.transform(known, lambda _: F.lit(0.0)))


def added(*arrays: Column) -> Column:
    total = arrays[0]
    for other in arrays[1:]:
        total = F.zip_with(total, other, lambda a, b: a + b)
    return total


def dense(value: str) -> Column:
    """The values of one group ordered by language number ``_l``; every number occurs once."""
    return F.transform(F.array_sort(F.collect_list(F.struct("_l", value))), lambda x: x[value])


def host_priors(scored: DataFrame, k: int) -> DataFrame:
    """_host, _domain → log prior array. ``scored`` has _host, _domain and _p (text posterior).

    Rows are summed per (host, language) before anything is shuffled; domains and the total are sums of
    hosts. Number ``k`` counts the rows.
    """
    parts = scored.select("_host", "_domain", F.posexplode(F.concat("_p", F.array(F.lit(1.0)))).alias("_l", "_p"))
    hosts = materialize(parts.groupBy("_host", "_domain", "_l").agg(F.sum("_p").alias("_s")))
    # One number per language.
    whole = {r["_l"]: r["_s"] for r in hosts.groupBy("_l").agg(F.sum("_s").alias("_s")).collect()}
    base = F.array(*[F.lit((whole.get(i, 0.0) + 1.0) / (whole.get(k, 0.0) + k)) for i in range(k)])
    domains = hosts.groupBy("_domain", "_l").agg(F.sum("_s").alias("_t")).groupBy("_domain").agg(dense("_t").alias("_t"))
    shrink = lambda counts, towards, strength: F.zip_with(
        F.slice(counts, 1, k), towards, lambda s, p: (s + strength * p) / (F.get(F.col(counts), F.lit(k)) + strength)
    )
    domains = domains.select("_domain", shrink("_t", base, DOMAIN_STRENGTH).alias("_d"))
    at = hosts.groupBy("_host", "_domain").agg(dense("_s").alias("_s")).join(domains, "_domain")
    prior = F.transform(shrink("_s", F.col("_d"), HOST_STRENGTH), lambda p: F.log(p))
    return materialize(at.select("_host", "_domain", prior.alias("_prior")))


def with_text_evidence(rows: DataFrame, model: dict, text: Column) -> DataFrame:
    """Adds _e: letters and tempered log-likelihoods of the whole text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return rows.withColumn("_e", text_udf(SCHEMA, lambda: scorer(shared.value))(text))


def answer(rows: DataFrame, languages: list[str], log_post: Column | None, keep: list[str], min_confidence: float) -> DataFrame:
    """``keep`` with predicted_lang, confidence and accepted from the log posterior; without a language nothing is accepted."""
    if log_post is None:
        named = (F.lit(None).cast("string"), F.lit(0.0), F.lit(False))
        return rows.select(*keep, *[c.alias(n) for c, n in zip(named, ANSWER)])
    out = rows.withColumn("_post", softmax(log_post))
    best = F.array_max("_post")
    name = F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("_post", best).cast("int"))
    accepted = (F.col("_e.letters") > 0) & (best >= min_confidence)
    return out.select(*keep, name.alias(ANSWER[0]), best.alias(ANSWER[1]), accepted.alias(ANSWER[2]))


def fuse(
    scored: DataFrame,
    model: dict,
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    domain: Column | None = None,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Posterior from _e and the other evidence; adds predicted_lang, confidence and accepted, drops _e."""
    languages = model["languages"]
    k = len(languages)
    keep = [c for c in scored.columns if c not in (*ANSWER, "_e")]
    if k == 0:
        return answer(scored, languages, None, keep, min_confidence)
    none = F.lit(None).cast("string")
    at = scored.withColumns(
        {
            "_host": F.coalesce(host if host is not None else none, F.lit("")),
            "_domain": F.coalesce(domain if domain is not None else none, F.lit("")),
        }
    )
    lettered = at.filter(F.col("_e.letters") > 0)
    priors = host_priors(lettered.select("_host", "_domain", softmax(F.col("_e.loglik")).alias("_p")), k)
    log_post = added(
        F.col("_e.loglik"),
        claim(languages, declared if declared is not None else none, DECLARED_RIGHT),
        claim(languages, suffix if suffix is not None else none, SUFFIX_RIGHT),
        F.coalesce("_prior", even(k)),
    )
    return answer(at.join(priors, ["_host", "_domain"], "left"), languages, log_post, keep, min_confidence)


def even(k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(k)), lambda _: F.lit(float(-np.log(k))))


def identify(rows: DataFrame, model: dict, text: Column, **evidence) -> DataFrame:
    """Adds predicted_lang, confidence and accepted, replacing columns of these names.

    The text is read twice: once to sum posteriors per host, once for the answer. ``evidence`` as in ``fuse``.
    """
    return fuse(with_text_evidence(rows, model, text), model, **evidence)


def page_text(html: Column) -> Column:
    """Visible text of a page, whole, by expressions: scripts, styles, comments and tags become blanks."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?\w+;", " ")


def markup_language(html: Column) -> Column:
    """Primary part of the lang attribute of the html element."""
    found = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)
    return F.nullif(F.lower(found), F.lit(""))


def address_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def address_language(url: Column, languages: list[str]) -> Column:
    """The two-letter first path part if it is a language, else the country suffix of the host."""
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]+/([a-zA-Z]{2})(?:[/?#]|$)", 1))
    country = F.regexp_extract(address_host(url), r"\.([a-z]{2})$", 1)
    return F.when(path.isin(languages), path).when(country.isin(languages), country)


def page_evidence(pages: DataFrame, languages: list[str], url: str = "url", html: str = "html") -> dict[str, Column]:
    """The evidence of web pages; a host's domain is its last two names."""
    host = address_host(F.col(url))
    return {
        "declared": markup_language(F.col(html)),
        "suffix": address_language(F.col(url), languages),
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1),
    }


def identify_pages(pages: DataFrame, model: dict, url: str = "url", html: str = "html", **options) -> DataFrame:
    """``identify`` of pages by their visible text."""
    return identify(pages, model, page_text(F.col(html)), **page_evidence(pages, model["languages"], url, html), **options)


def pages_of_documents(pages: DataFrame, languages: list[str], address_id: str = r"/(\d+)(?:[/.?#]|$)") -> DataFrame:
    """_doc, _page, _declared, _suffix, _host, _domain of each page whose address names a document."""
    seen = page_evidence(pages, languages)
    named = F.regexp_extract("url", address_id, 1).try_cast("long").alias("_doc")
    per = pages.select(named, F.col("page_id").alias("_page"), *[c.alias(f"_{k}") for k, c in seen.items()])
    return per.filter("_doc is not null").distinct()


def page_claims(seen: DataFrame, languages: list[str]) -> DataFrame:
    """_doc → summed log-likelihoods of the declarations and suffixes of all its pages, under each language.

    Equal claims of a document are counted before they are gathered, so a group holds at most two per language.
    """
    rights = {"_declared": chances(languages, DECLARED_RIGHT), "_suffix": chances(languages, SUFFIX_RIGHT)}
    each = F.array(*[F.struct(F.col(c).alias("name"), F.lit(yes).alias("yes"), F.lit(no).alias("no")) for c, (yes, no) in rights.items()])
    said = seen.select("_doc", F.inline(each)).filter(F.col("name").isin(languages))
    votes = said.groupBy("_doc", "name", "yes", "no").agg(F.count(F.lit(1)).alias("n"))
    gathered = votes.groupBy("_doc").agg(F.array_sort(F.collect_list(F.struct("name", "yes", "no", "n"))).alias("_votes"))
    total = lambda name: F.aggregate(
        "_votes", F.lit(0.0), lambda s, v: s + v["n"] * F.when(v["name"] == name, v["yes"]).otherwise(v["no"])
    )
    return gathered.select("_doc", F.transform(F.array(*[F.lit(x) for x in languages]), total).alias("_claims"))


def fuse_documents(scored: DataFrame, seen: DataFrame, model: dict, key: str, source: str, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``fuse`` for documents, with the evidence of all their pages (``seen``, of ``pages_of_documents``)."""
    languages = model["languages"]
    k = len(languages)
    keep = [c for c in scored.columns if c not in (*ANSWER, "_e")]
    if k == 0:
        return answer(scored, languages, None, keep, min_confidence)
    own = F.coalesce(F.col(source).cast("string"), F.lit(""))
    links = materialize(seen.filter("_host is not null").select("_doc", F.col("_host").alias("_h"), F.col("_domain").alias("_g")).distinct())
    lettered = scored.filter(F.col("_e.letters") > 0).select(F.col(key).alias("_id"), own.alias("_own"), softmax(F.col("_e.loglik")).alias("_p"))
    counted = lettered.join(links, F.col("_id") == F.col("_doc"), "left").select(
        F.coalesce("_h", "_own").alias("_host"), F.coalesce("_g", F.lit("")).alias("_domain"), "_p"
    )
    priors = host_priors(counted, k)
    of_pages = links.join(priors, (F.col("_h") == F.col("_host")) & (F.col("_g") == F.col("_domain")))
    means = of_pages.select("_doc", F.posexplode("_prior").alias("_l", "_q")).groupBy("_doc", "_l").agg(F.avg("_q").alias("_q"))
    means = means.groupBy("_doc").agg(dense("_q").alias("_of_pages"))
    known = materialize(means.join(page_claims(seen, languages), "_doc", "full").withColumn("_paged", F.col("_of_pages").isNotNull()))
    sources = priors.filter("_domain = ''").select(F.col("_host").alias("_s"), "_prior")
    out = scored.join(known, F.col(key) == F.col("_doc"), "left").join(sources, ~F.coalesce("_paged", F.lit(False)) & (own == F.col("_s")), "left")
    log_post = added(
        F.col("_e.loglik"),
        F.coalesce("_claims", F.transform(even(k), lambda _: F.lit(0.0))),
        F.coalesce("_of_pages", "_prior", even(k)),
    )
    return answer(out, languages, log_post, keep, min_confidence)


def identify_documents(
    documents: DataFrame, model: dict, pages: DataFrame | None = None, text: str = "text", source: str = "source", key: str = "doc_id", **options
) -> DataFrame:
    """``identify`` for documents; a page whose address names a document is evidence of it.

    The text is read twice. The evidence by document joins the rows by broadcast while Spark finds it small, else by shuffle.
    """
    scored = with_text_evidence(documents, model, F.col(text))
    if pages is None:
        return fuse(scored, model, host=F.col(source).cast("string"), **options)
    return fuse_documents(scored, pages_of_documents(pages, model["languages"]), model, key, source, **options)


def identify_with_pages(documents: DataFrame, pages: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang and the answer of ``identify_documents``. Texts are read once, and only their evidence is joined."""
    scored = materialize(with_text_evidence(documents.select("doc_id", "lang", "source", "text"), model, F.col("text")).drop("text"))
    found = fuse_documents(scored, pages_of_documents(pages, model["languages"]), model, "doc_id", "source")
    return found.select("doc_id", "lang", "predicted_lang", F.round("confidence", 6).alias("confidence"), "accepted")
