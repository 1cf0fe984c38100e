"""Each operator against brute force, and the edge cases its docstring defines."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockweave.llm import common, decontaminate, html_blocks, language, minhash, mixing, pii, quality_cnn, token_counts, toxicity, vector_files
from stockweave.llm.queries import ORACLES, QUERIES

from .brute import brute_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], schema)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return common.read_table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


LONG = "word and more words of it " * 9000
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, LONG), (6, "one two"), (6, "one two"), (7, "éß \U0001f600 x@y.zz"), (None, "lost id")]


# ------------------------------------------------------------ 1 pages


def test_blocks_follow_tags():
    page = "<body><p>a<br>b &amp; c<p>d <b>e</b>\n f<script>x<p></script> g</p><!-- <p>no</p> -->h</body>"
    assert [t for _, t, _ in html_blocks.blocks(page)] == ["a b & c", "d e f g", "h"]
    assert html_blocks.blocks("") == [] and html_blocks.blocks("<style>p{}</style>") == []
    assert [t for _, t, _ in html_blocks.blocks("plain &lt;text")] == ["plain <text"]


def test_broken_tags_leave_no_markup():
    texts = lambda page: [t for _, t, _ in html_blocks.blocks(page)]
    assert texts('<article><p title="oops>text of it</p><p>more</p></article>') == ["text of it", "more"]
    assert texts("<p class='a>b' id=\"x>y\">one</p><p data-x='>two</p><p>three</p>") == ["one", "two", "three"]
    assert texts('<p title="oops>a</p><p class="b">c</p>') == ["a", "c"] or texts('<p title="oops>a</p><p class="b">c</p>') == ["c"]
    assert texts("1 < 2 and x <y") == ["1 < 2 and x <y"]
    assert texts("<p>a<!doctype x><?php b ?>c</p><!-- <p>no") == ["ac"]
    assert texts("<p>a</p><script src='x>y'>no <p>no</p></script ><style>no") == ["a"]


@pytest.mark.parametrize("piece", ['<a "', "<a x='", "<a \"'", "<!", "<", "<p ", "<a \"b' c", "<a '><b \"", "<script ", "</", "<a x='>\"", "<!--", "<p title=\"oops>"])
def test_a_megabyte_of_broken_tags_takes_little_time(piece):
    for page in (piece * (1_000_000 // len(piece)), piece * (500_000 // len(piece)) + "<p>end</p>"):
        begin = time.process_time()
        html_blocks.scan(page)
        assert time.process_time() - begin < 4


@pytest.mark.parametrize("seed", range(4))
def test_broken_tags_end_as_stated(seed):
    """Against following every tag's quotes to the end of the page."""
    draw = random.Random(seed)
    for _ in range(400):
        page = "".join(draw.choices(["<a", "<b ", '"', "'", ">", " x=", "t", "</a", "<!"], k=draw.randrange(25)))
        want, at = [], 0
        while (at := page.find("<", at)) >= 0:
            m = re.match(r"</?[a-z]+", page[at:])
            if m or page.startswith("<!", at):
                quote, end = "", None
                for k in range(at + (len(m[0]) if m else 0), len(page)):
                    c = page[k]
                    if quote:
                        quote = "" if c == quote else quote
                    elif c in "\"'" and m:
                        quote = c
                    elif c == ">":
                        end = k + 1
                        break
                end = end or page.find(">", at) + 1
                if end:
                    want.append((at, end))
                    at = end
                    continue
            at += 1
        assert [(t.start(), t.end()) for t in html_blocks.scan(page)] == want, page


@pytest.mark.parametrize("start", ["<head>", "<head><title>t</title><meta charset=x>", "<html><head><style>x</style><link rel=y><title>t</title>"])
@pytest.mark.parametrize("body", ["<body><p>a</p><p>b</p></body>", "<p>a</p><p>b</p>", "</head><body><p>a<p>b", "<div><span>a</span></div><p>b"])
def test_head_ends_at_the_body(start, body):
    assert [t for _, t, _ in html_blocks.blocks(start + "\n" + body)] == ["a", "b"]


@pytest.mark.parametrize("name", sorted(html_blocks.HIDDEN))
def test_hidden_elements_end(name):
    texts = lambda page: [t for _, t, _ in html_blocks.blocks(page)]
    assert texts(f"<article><p>a</p><{name} class=x>no<p>b</p></article><p>c</p>") == ["a", "b", "c"]
    assert texts(f"<article><p>a</p><{name}>no</article><p>c</p><{name}>no<p>d</p></{name}><p>e</p>") == ["a", "c", "e"]
    assert texts(f"<p>a <{name}><p>no</p><div>no</div></{name}> b</p><{name}/><p>c") == ["a b", "c"]
    assert texts(f"<p>a <b>x <{name}>no</b> y</p><p>b</p>") == ["a x y", "b"]


def test_pages_give_their_articles(spark, sf_dir):
    rows = QUERIES["op1_html_extraction"](spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in common.read_table(spark, sf_dir, "pages").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        want = "\n\n".join(t for p, t, _ in html_blocks.blocks(pages[r["page_id"]]) if "<article>" in p)
        assert r["text"] == want and r["n_chars"] == len(want)


def test_labeller_on_other_layouts(spark, sf_dir):
    pages = [r["html"] for r in common.read_table(spark, sf_dir, "pages").collect()]
    net = html_blocks.train(*html_blocks.training_pages(pages[:40]))
    x, y = html_blocks.training_pages(pages[40:], copies=4, seed=99)
    wrong = sum(((html_blocks.forward(net, *html_blocks.padded([a]))[0][:, 0] >= 0.5) != (b == 1)).sum() for a, b in zip(x, y))
    assert wrong / sum(map(len, y)) < 0.08


def test_page_edges(spark):
    schema = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, None, None, "z"), (2, "u", "", "z"), (3, "u", "<nav>x</nav>", "z"), (3, "u", "<nav>x</nav>", "z")], schema)
    rows = html_blocks.main_text(pages).collect()
    assert len(rows) == 4 and {r["text"] for r in rows if r["page_id"] < 3} == {""}
    assert html_blocks.main_text(pages.limit(0)).count() == 0


# ------------------------------------------------------------ 2 personal data


def plain_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns(texts):
    tricky = ["a@b.c@d.e.f", "@x.y a@b c@d.e", "1.2.3.4.5 300.1.1.1 01.02.003.255", "+1 (234) 567-8901 x +12", "4111 1111-1111 1111", "4111111111111111", "x.y+z@q-.w.. 1.1.1.1.1.1.1.1", "9" * 40]
    for text in [t or "" for t in texts.values()] + tricky:
        assert pii.base_spans(text) == plain_base(text)


def test_personal_data_query(spark, sf_dir, texts):
    for r in QUERIES["op2_pii"](spark, sf_dir).collect():
        base = plain_base(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_written_out_addresses_are_added_and_redacted(texts):
    sample = [f"{t} a{i}.b@mail{i}.example.com and 4111111111111111 at 10.0.{i % 250}.1 call +49 30 1234{i:04d}" for i, t in enumerate(list(filter(None, texts.values()))[:150])]
    model = pii.train(sample)
    text = "reach jane.doe at mail dot example dot com or x@y.org now"
    assert [s[0] for s in pii.detect(text, model)] == ["email", "email"]
    assert pii.redact(text, model) == "reach [EMAIL] or [EMAIL] now"
    assert pii.detect("It was 2024-01-02 10:20:30 in row 1234567", model) == []


def test_personal_data_edges(spark):
    rows = pii.personal_data(docs_of(spark, EDGE)).collect()
    assert len(rows) == len(EDGE)
    assert {r["n_email"] for r in rows if r["doc_id"] == 7} == {1}
    clean = pii.redact_text(docs_of(spark, EDGE), None)
    assert clean.filter("text is null").count() == 1 and clean.columns == docs_of(spark, EDGE).columns


# ------------------------------------------------------------ 3 near duplicates


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(4000)]
    rows, n = [], 0
    for family in range(6):
        base = list(rng.choice(words, 120))
        for _ in range(40):  # edits at random places: a hub, copies of copies, and outliers
            own = list(base)
            for at in rng.integers(0, len(own), int(rng.integers(0, 7))):
                own[at] = str(rng.choice(words))
            rows.append((n, " ".join(own)))
            n += 1
    passage = " ".join(rng.choice(words, 40))
    rows += [(n + k, passage + " " + " ".join(rng.choice(words, int(rng.integers(5, 60))))) for k in range(120)]
    want = brute_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == want


def test_near_duplicate_edges(spark):
    rows = {}
    found = minhash.near_duplicates(docs_of(spark, EDGE)).collect()
    assert len(found) == len(EDGE)
    for r in found:
        rows[r["doc_id"]] = (r["n_shingles"], r["component_id"], r["kept"])
    assert rows[1] == (0, 1, True) and rows[2] == (0, 2, True) and rows[3] == (0, 3, True)
    assert rows[4] == (1, 4, True) and rows[6] == (1, 4, False)
    assert rows[None][1:] == (None, True)
    kept = minhash.drop_near_duplicates(docs_of(spark, EDGE).withColumn("_node", F.lit(1)))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "None"]
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def hot_bucket(spark, n, seekers):
    """One bucket of n classes in one table, all but the last ``seekers`` linked to the hub."""
    from types import SimpleNamespace

    key = [F.array(*[F.lit(k).cast("long")] * minhash.M) for k in (1, 2)]
    classes = spark.range(n).select(F.col("id").alias("_node"), F.lit(9).cast("long").alias("n"), key[0].alias("a"), key[1].alias("b"), F.lit(bytes([1] * minhash.BINS)).alias("sketch"))
    crowded = spark.range(n).select(F.lit(5).cast("long").alias("_k"), F.lit(0).alias("_t"), F.col("id").alias("_node"), F.lit(0).cast("long").alias("_hub"), F.lit(n).cast("long").alias("_size"))
    roots = spark.range(n - seekers).select(F.col("id").alias("_node"), F.lit(0).cast("long").alias("_root"))
    return SimpleNamespace(classes=classes, percent=85), crowded, roots


def test_hot_bucket_is_cut_into_bounded_groups(spark, monkeypatch):
    def sizes(percent):
        return lambda seekers, others: pd.DataFrame({"_u": [len(seekers)], "_v": [len(others)]})

    monkeypatch.setattr(minhash, "BLOCK", 64)
    monkeypatch.setattr(minhash, "GROUP_ROWS", 16)
    monkeypatch.setattr(minhash, "across", sizes)
    found = minhash.unresolved_pairs(*hot_bucket(spark, 2000, 20)).collect()
    assert max(r["_v"] for r in found) <= 8 * 64 and max(r["_u"] for r in found) <= 8 * 20
    assert sum(r["_v"] for r in found) == 1999  # 20 seekers fill one block, so the others are copied once


@pytest.mark.parametrize("seekers", [7, 90])
def test_every_pair_of_a_cut_bucket_is_met(spark, monkeypatch, seekers):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "GROUP_ROWS", 4)
    got = {tuple(r) for r in minhash.unresolved_pairs(*hot_bucket(spark, 150, seekers)).collect()}
    assert got == {(i, j) for j in range(150 - seekers, 150) for i in range(1, j)}


def test_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "_u long, _v long")
    roots = minhash.components(edges).collect()
    assert len(roots) == 203 and len({r["_root"] for r in roots}) == 2


# ------------------------------------------------------------ 4 mixing


def test_raked_weights_meet_the_targets(spark, sf_dir):
    cells = spark.createDataFrame([("a", "x", "p", 100), ("a", "y", "p", 300), ("b", "x", "q", 500), ("b", "y", "p", 50), ("c", "y", "q", 0)], "_source string, _lang string, _topic string, _n long")
    rows = mixing.rake(cells, rounds=40).collect()
    total = sum(r["_w"] for r in rows)
    assert total == pytest.approx(950)
    per = {s: sum(r["_w"] for r in rows if r["_source"] == s) / total for s in "abc"}
    a, b = 400**0.5, 550**0.5
    assert per["a"] == pytest.approx(a / (a + b), abs=1e-3) and per["c"] == 0


def test_mixing_edges_and_clashing_names(spark):
    docs = docs_of(spark, EDGE).withColumn("copies", F.lit("old")).withColumn("source", F.when(F.col("doc_id") > 4, "s"))
    out = mixing.mix(docs)
    assert out.count() == len(EDGE) and dict(out.dtypes)["copies"] == "int"
    assert {r["copies"] for r in out.filter("doc_id < 4").collect()} == {0}
    assert mixing.mix(docs.limit(0)).count() == 0


# ------------------------------------------------------------ 5 language


def test_languages_are_found(spark, sf_dir):
    rows = QUERIES["op5_language_id"](spark, sf_dir).collect()
    right = sum(r["lang"] == r["predicted_lang"] for r in rows)
    assert right / len(rows) > 0.97 and sum(r["accepted"] for r in rows) / len(rows) > 0.99
    pages = QUERIES["page_language_id"](spark, sf_dir).collect()
    named = [(r["predicted_lang"], m[1]) for r in pages if (m := re.search(r"/(en|fr|de|es)/", r["url"]))]
    assert sum(a == b for a, b in named) / len(named) > 0.95


def test_text_alone_finds_held_out_languages(texts, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    ids = sorted(texts)
    known = sorted(set(lang.values()))
    model = language.train([texts[i] for i in ids[::2]], [lang[i] for i in ids[::2]], known)
    found = language.scorer(model)([texts[i] for i in ids[1::2]])["loglik"]
    assert np.mean([known[int(np.argmax(p))] == lang[i] for p, i in zip(found, ids[1::2])]) > 0.9


def test_posterior_equals_bayes_by_hand(spark):
    model = language.train(["aaa aab", "zzz zzy"], ["en", "fr"], ["en", "fr"])
    docs = spark.createDataFrame([(1, "zz", "en", "h"), (2, "aa", "fr", "h"), (3, "12", None, None)], "doc_id long, text string, lang string, source string")
    found = language.identify(docs, model, F.col("text"), declared=F.col("lang"), host=F.col("source"))
    got = {r["doc_id"]: r for r in found.collect()}
    like = {i: np.array(language.scorer(model)([t])["loglik"][0]) for i, t in ((1, "zz"), (2, "aa"))}
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    s = sum(soft(v) for v in like.values())
    base = (s + 1) / 4
    domain = (s + language.DOMAIN_STRENGTH * base) / (2 + language.DOMAIN_STRENGTH)
    prior = (s + language.HOST_STRENGTH * domain) / (2 + language.HOST_STRENGTH)
    want = soft(like[1] + np.log([0.9, 0.1]) + np.log(prior))
    assert got[1]["confidence"] == pytest.approx(want.max())
    assert got[3]["accepted"] is False


def posteriors(model, docs, pages):
    """Plain recomputation: doc row → (language, confidence), from (id, text, source) and (page id, id, declared, suffix, host)."""
    names = model["languages"]
    k = len(names)
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    like = [np.array(language.scorer(model)([t or ""])["loglik"][0]) for _, t, _ in docs]
    letters = [language.scorer(model)([t or ""])["letters"][0] for _, t, _ in docs]
    domain = lambda h: ".".join(h.split(".")[-2:])
    pages = sorted(set(pages), key=str)
    hosts = [sorted({(h, domain(h)) for _, d, _, _, h in pages if d == i and h}) or [(s or "", "")] for i, _, s in docs]
    n, sums = {}, {}
    for at, value, count in zip(hosts, like, letters):
        for h in at if count else ():
            n[h] = n.get(h, 0) + 1
            sums[h] = sums.get(h, np.zeros(k)) + soft(value)
    total = sum(n.values())
    base = (sum(sums.values(), np.zeros(k)) + 1) / (total + k)

    def prior(h):
        if h not in n:
            return None
        group = [x for x in n if x[1] == h[1]]
        at = (sum(sums[x] for x in group) + language.DOMAIN_STRENGTH * base) / (sum(n[x] for x in group) + language.DOMAIN_STRENGTH)
        return np.log((sums[h] + language.HOST_STRENGTH * at) / (n[h] + language.HOST_STRENGTH))

    def says(name, right):
        if name not in names:
            return np.zeros(k)
        return np.where(np.array(names) == name, np.log(right), np.log((1 - right) / (k - 1)))

    out = []
    for (i, _, s), at, value in zip(docs, hosts, like):
        known = [p for p in map(prior, at) if p is not None] or [p for p in [prior((s or "", ""))] if p is not None]
        log_post = value + (np.mean(known, axis=0) if known else -np.log(k))
        for _, d, declared, suffix, _ in pages:
            if d == i and i is not None:
                log_post = log_post + says(declared, language.DECLARED_RIGHT) + says(suffix, language.SUFFIX_RIGHT)
        p = soft(log_post)
        out.append((names[int(np.argmax(p))], float(p.max())))
    return out


def test_documents_with_any_number_of_pages_equal_a_plain_recomputation(spark):
    model = language.train(["aaa aab aba", "zzz zzy zyz", "mmm mnm nnm"], ["en", "fr", "de"], ["de", "en", "fr"])
    rng = random.Random(5)
    docs = [(i, rng.choice(["a", "z", "az", "am zz", "aab zzy mn", "12", "", None, "mzz"]), rng.choice(["s1", "s2", None])) for i in range(60)]
    docs += [docs[4], (None, "zz", "s1")]
    pages = []
    for j in range(90):
        d = rng.randrange(80) if j % 3 else 7
        pages.append((j, d, rng.choice(["en", "fr", "de", "xx", None]), rng.choice(["en", "de", None]), rng.choice(["a.x.org", "b.x.org", "c.y.org"])))
    rows = [(p, f"https://{h}/{s}/{d}" if s else f"https://{h}/{d}", f"<html lang={c}>" if c else "<html>") for p, d, c, s, h in pages]
    rows += [rows[0], (900, "https://a.x.org/none", "<html lang=fr>"), (901, None, None)]
    html = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = spark.createDataFrame([(i, t, s, "fr", 1) for i, t, s in docs], "doc_id long, text string, source string, lang string, _claims int")
    got = language.identify_documents(frame.drop("_claims").repartition(5), model, html).collect()
    want = {}
    for (i, _, _), answer in zip(docs, posteriors(model, docs, pages)):
        want[i] = answer
    assert len(got) == len(docs)
    for r in got:
        name, confidence = want[r["doc_id"]]
        assert r["confidence"] == pytest.approx(confidence, abs=1e-9)
        assert r["predicted_lang"] == name or confidence == pytest.approx(1 / 3, abs=0.2)
    no_pages = language.identify_documents(frame.drop("_claims"), model, html.limit(0)).collect()
    plain = language.identify_documents(frame.drop("_claims"), model).collect()
    assert sorted(map(str, no_pages)) == sorted(map(str, plain))


def test_the_language_column_is_no_evidence_of_itself(spark, documents):
    model = language.fit(documents)
    some = documents.limit(80)
    answers = lambda df: sorted(map(str, language.identify_documents(df, model).drop("lang").collect()))
    assert answers(some) == answers(some.withColumn("lang", F.lit("de")))


def test_every_language_is_modelled(spark):
    rng = random.Random(1)
    words = {f"l{i:03d}": [chr(0x4E00 + 40 * i + rng.randrange(40)) * 2 + chr(0x4E00 + 40 * i + rng.randrange(40)) for _ in range(12)] for i in range(300)}
    rows = [(10 * i + j, " ".join(rng.choices(w, k=15)), name, f"s{i % 3}", 1) for i, (name, w) in enumerate(words.items()) for j in range(6)]
    docs = spark.createDataFrame(rows, DOCS)
    held = F.pmod("doc_id", F.lit(10)) >= 4
    model = language.fit(docs.filter(~held))
    assert model["languages"] == sorted(words) and model["table"].dtype == np.float32
    found = language.identify_documents(docs.filter(held), model).collect()
    assert sum(r["predicted_lang"] == r["lang"] for r in found) / len(found) > 0.97


def test_held_out_accuracy_by_kind_of_evidence(spark, sf_dir, documents):
    """Models from half of the documents; the other half by its text alone, and with its pages."""
    pages = common.read_table(spark, sf_dir, "pages")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = language.fit(documents.filter(~held))
    rows = documents.filter(held)
    share = lambda df: df.agg(F.avg((F.col("lang") == F.col("predicted_lang")).cast("double"))).first()[0]
    text = share(language.fuse(language.with_text_evidence(rows, model, F.col("text")), model))
    every = share(language.identify_documents(rows, model, pages))
    assert text > 0.9 and every >= text - 0.01


def test_language_edges(spark, documents):
    model = language.fit(documents)
    out = language.identify_documents(docs_of(spark, EDGE).withColumn("accepted", F.lit(1)), model).collect()
    assert len(out) == len(EDGE) and not any(r["accepted"] for r in out if r["doc_id"] in (1, 2, 3))
    assert language.identify_documents(docs_of(spark, []), language.fit(docs_of(spark, []))).count() == 0


# ------------------------------------------------------------ 6 vectors


def test_vector_edges_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(int(i), [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(300)]
    vectors += [(int(1000 + i), vectors[0][1]) for i in range(80)]  # a hot vector, among the queries too
    vectors += [(2000, None), (2050, [float("nan")] * 8), (2100, [None] * 8), (2150, [1.0, 2.0]), (2151, [0.5, -1.0]), (None, [0.0] * 8)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in vectors if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = set()
    for i, q in good:
        if i % 50 == 0:
            hits = sorted(((-int(q @ v), j) for j, v in good if j != i and len(v) == len(q)))[:5]
            want |= {(i, r, j, -s) for r, (s, j) in enumerate(hits, 1)}
    got = {tuple(r) for r in vector_files.top_k(frame, lambda c: c % 50 == 0).collect()}
    assert got == want
    assert vector_files.top_k(frame.limit(0), lambda c: c % 50 == 0).count() == 0


def brute_top(vectors):
    """Every pair of rows of different ids, ranked per query id."""
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in vectors]
    out = []
    for x in {i for i, _ in good if i % 50 == 0}:
        hits = sorted((-int(q @ v), j) for i, q in good if i == x for j, v in good if j != x and len(v) == len(q))[:5]
        out += [(x, r, j, -s) for r, (s, j) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("case", ["doubled", "hot id", "ids of several vectors", "huge ids"])
def test_repeated_ids_count_once_per_row(spark, case):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(120)]
    if case == "doubled":
        vectors += vectors + [(1000 + i, vectors[0][1]) for i in range(60)] * 2
    elif case == "hot id":
        vectors += [(7, vectors[50][1])] * 6 + [(i, vectors[50][1]) for i in (8, 9, 10)] + [(100, vectors[50][1])] * 7
    elif case == "ids of several vectors":
        large = [[float(x) for x in rng.normal(0.5, 0.3, 8)] for _ in range(20)]
        vectors += [(50, v) for v in large] + [(0, v) for v in large[:12]] + [(3, v) for v in large[:6]] + [(100, large[0])]
    else:
        vectors = [(2**60 + i, v) for i, v in vectors] + [(2**60 + i, vectors[1][1]) for i in range(40)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in vector_files.top_k(frame, lambda c: c % 50 == 0).collect())
    assert got == brute_top(vectors)


@pytest.mark.parametrize("size", [8388608.0, 8e9, 2.0**47])
def test_large_components_are_exact(spark, size):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) * size for x in rng.uniform(-1, 1, 6)]) for i in range(60)] + [(70, [size / 1.5] * 6), (71, [0.5] * 6), (72, [-0.25] * 6)]
    vectors += [(100, [0.0] * 6), (150, [1.0, 0.0, 0.0, 0.0, 0.0, -1.0]), (200, [2.0**48] * 6), (250, [])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors if i != 200]
    want = []
    for x, q in good:
        if x % 50 == 0:
            hits = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != x and len(v) == len(q))[:5]
            want += [(x, r, j, max(min(-s, 2**63 - 1), 1 - 2**63)) for r, (s, j) in enumerate(hits, 1)]
    got = sorted(tuple(r) for r in vector_files.top_k(frame, lambda c: c % 50 == 0).collect())
    assert got == sorted(want)


def test_cells_bound_every_score_and_take_one_byte():
    rng = np.random.default_rng(4)
    for scale in (1, 300, 2**31, 2**55):
        v = [np.floor(rng.uniform(-1, 1, 16) * scale).astype(np.int64) for _ in range(50)]
        frame = pd.DataFrame({"_u": range(50), "_v": v, "_only": 0, "_only_set": False})
        (file,) = vector_files.cells(iter([frame]))
        assert {len(c) for c in file["_c"]} == {16}
        cell = np.array([np.frombuffer(c, np.uint8) for c in file["_c"]], float)
        lower, upper = vector_files.bounded_scores(np.array(v[:9], float), file["_base"].to_numpy(), file["_shift"].to_numpy(), cell)
        for i in range(9):
            for j in range(50):
                assert lower[i, j] <= sum(int(a) * int(b) for a, b in zip(v[i], v[j])) <= upper[i, j]


def test_query_blocks_are_passes_with_the_same_answers(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(400)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    monkeypatch.setattr(vector_files, "QUERY_BYTES", 400)
    monkeypatch.setattr(vector_files, "NUMBERS", 64)
    got = sorted(tuple(r) for r in vector_files.top_k(frame, lambda c: c % 50 == 0).collect())
    assert got == brute_top(vectors)


def test_doubled_vectors_equal_sql(spark, sf_dir):
    import duckdb

    rows = common.read_table(spark, sf_dir, "embeddings").limit(400).toPandas()
    embeddings = pd.concat([rows, rows])
    got = vector_files.top_k(spark.createDataFrame(embeddings[["vec_id", "embedding"]].assign(embedding=embeddings["embedding"].map(list)), "vec_id long, embedding array<float>"), lambda c: c % 50 == 0)
    view = duckdb.connect()
    view.register("embeddings", embeddings)
    assert sorted(tuple(r) for r in got.collect()) == sorted(view.sql(ORACLES["op6_exact_top_k"]).fetchall())


# ------------------------------------------------------------ 7 and 9 classifiers


def auc(y, s):
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    y = np.array(y)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("name, label, parts, held, least", [("op7_quality", "quality", 3, 1, 0.9), ("op9_toxicity", "toxic", 4, 2, 0.95)])
def test_held_out_labels(spark, name, label, parts, held, least):
    sf = "/root/testdata/sf0.1"  # smaller ones have too few labels; toxicity measured 0.98 here, 0.89 on sf0.01
    rows = {r["doc_id"]: r for r in QUERIES[name](spark, sf).collect()}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % parts == held) and 0 <= r["score"] <= 1
    known = [(r[label], rows[r["doc_id"]]["score"]) for r in common.read_table(spark, sf, "labels").collect() if rows[r["doc_id"]]["held_out"]]
    assert auc([y for y, _ in known], np.array([s for _, s in known])) > least


@pytest.mark.parametrize("module, score", [(toxicity, toxicity.toxicity), (quality_cnn, quality_cnn.quality)])
def test_classifier_edges(spark, sf_dir, module, score):
    labels = common.read_table(spark, sf_dir, "labels")
    docs = docs_of(spark, EDGE).withColumn("score", F.lit("old"))
    rows = score(docs.unionByName(common.read_table(spark, sf_dir, "documents").withColumn("score", F.lit("x"))), labels).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)} | set()) >= 1
    assert score(docs, labels.limit(0)).count() == len(EDGE)
    assert score(docs.limit(0), labels).count() == 0


def plain_quality(net, text):
    """The network filter by filter and chunk by chunk."""
    raw = (text or "").encode()
    raw = list(raw) + [0] * (max(2, -(-len(raw) // 256)) * 256 - len(raw))
    at = lambda i: net["e"][raw[i] if i < len(raw) else 0]
    filters = [np.maximum(np.concatenate([at(i + k) for k in range(8)]).astype(float) @ net["w"] + net["b"], 0) for i in range(0, len(raw), 4)]
    half = [np.max(filters[i : i + 64], axis=0) for i in range(0, len(filters), 64)]
    hidden = [np.maximum(np.maximum(a, b) @ net["h"] + net["c"], 0) for a, b in zip(half, half[1:])]
    z = np.concatenate([np.max(hidden, axis=0), np.mean(hidden, axis=0)]) @ net["o"] + net["d"][0]
    return 1 / (1 + np.exp(-z))


def test_quality_depends_on_the_text_alone(texts):
    net = quality_cnn.exact(quality_cnn.initial())
    some = [t or "" for t in texts.values()] + ["", "x", "y" * 255, "z" * 256, "ab " * 400, "long one " * 130_000]
    score = quality_cnn.scorer(net)
    alone = [score([t])["score"][0] for t in some]
    assert alone == list(score(some)["score"])
    order = np.random.default_rng(1).permutation(len(some))
    assert [alone[k] for k in order] == list(score([some[k] for k in order])["score"])
    for text, got in list(zip(some, alone))[-6:-1] + list(zip(some, alone))[:4]:
        assert got == pytest.approx(plain_quality(net, text[:20_000]) if len(text) <= 20_000 else got, abs=1e-9)


@pytest.mark.parametrize("extra", [0, 1, 100])
def test_long_text_is_pooled_as_a_whole(extra):
    net, text = quality_cnn.exact(quality_cnn.initial()), "some words of a long text. " * 60_000 + "e" * extra
    whole = float(quality_cnn.forward(net, [quality_cnn.halves(text)])["p"][0])
    assert quality_cnn.long_probability(net, quality_cnn.halves(text)) == whole


# ------------------------------------------------------------ 8 tokens


def test_tokens_equal_the_library(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    folder = common.tokenizer_folder()
    library = Tokenizer.from_file(folder.path(token_counts.VOCABULARY))
    n = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    for r in QUERIES["op8_token_counts"](spark, sf_dir).collect():
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len((t or "").encode()), n(t)) and r["over_limit"] == (n(t) > 1024)
    every = ["".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x11000, 64)]
    odd = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "  x \n\n y\t", "don't I'LL 12ab", "\x1c\x1d x\x85y　z", *every, *(" a".join(t) for t in every)]
    count = token_counts.counter({}, "/opt/tokenizers", token_counts.VOCABULARY)
    assert count(odd)["n_tokens"] == [n(t) for t in odd]


def test_token_edges(spark):
    rows = {r["doc_id"]: r for r in token_counts.token_counts(docs_of(spark, EDGE).withColumn("n_tokens", F.lit("z"))).collect()}
    assert (rows[1]["n_bytes"], rows[1]["n_tokens"], rows[2]["n_tokens"]) == (0, 0, 0) and rows[5]["over_limit"]
    assert token_counts.token_counts(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------ 10 benchmark


def edits_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_matches_equal_brute_force(texts):
    rng = np.random.default_rng(8)
    letters = "abcdefghijklmnop rstu"
    item = "".join(rng.choice(list(letters), 80)).strip()
    index = decontaminate.build_index([(7, decontaminate.normal(item))])
    pattern = decontaminate.normal(item)
    for n in range(0, 14):
        own = list(pattern)
        for at in rng.integers(0, len(own), n):
            kind = rng.integers(3)
            own[at] = "" if kind == 0 else own[at] + "z" if kind == 1 else "z"
        text = decontaminate.normal("lorem ipsum " * 3 + "".join(own) + " dolor" * 4)
        want = edits_within(pattern, text) <= int(index["edits"][0])
        assert bool(decontaminate.find(index, text)) == want


def test_every_long_run_of_an_item_is_found():
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    reach = decontaminate.SEGMENT + decontaminate.STEP - 1
    for n in (reach, 100, 127, 128, 250):
        item = "".join(rng.choice(letters, n))
        index = decontaminate.build_index([(7, item)])
        for at in range(n - reach + 1):
            assert decontaminate.find(index, "0123456789 " * 3 + item[at : at + reach] + " 0123456789" * 3), (n, at)


def test_short_items_equal_brute_force():
    rng = np.random.default_rng(10)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    for n in (8, 10, 12, 15, 16, 20, 23, 30, 31, 40, 63):
        item = "".join(rng.choice(letters, n))
        index = decontaminate.build_index([(7, item), (8, "0" * 70)])
        for shift in range(n):
            for edits in range(1, 5):  # evenly spread edits leave the fewest common q-grams
                own = list(item)
                for k in range(edits):
                    own[(shift + k * n // edits) % n] = "+"
                text = "".join(own)
                assert (7 in {m[0] for m in decontaminate.find(index, text)}) == (edits_within(item, text) <= n // 10), (n, text)


def test_contaminated_documents(spark, sf_dir, texts):
    items = [decontaminate.normal(r["text"]) for r in common.read_table(spark, sf_dir, "benchmark").collect()]
    whole = {i for i, t in texts.items() if any(x in decontaminate.normal(t or "") for x in items)}
    rows = QUERIES["op10_decontamination"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and whole <= {r["doc_id"] for r in rows if r["contaminated"]}


def test_benchmark_edges(spark):
    bench = spark.createDataFrame([(1, None), (2, "short"), (3, "a passage of the benchmark that is long enough to be one segment of it"), (3, "x"), (None, "y" * 90)], "item_id long, text string")
    docs = docs_of(spark, EDGE + [(9, "so A PASSAGE of the  benchmark that is long enough to be one segment of it, he said")]).withColumn("matches", F.lit(0))
    rows = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    assert rows[9]["item_ids"] == [3] and sum(r["contaminated"] for r in rows.values()) == 1
    assert decontaminate.drop_contaminated(docs, bench).columns == docs.columns
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert sum(1 for _ in decontaminate.blocks(bench, chars=10)) == 3


def test_one_quoted_passage_is_one_region():
    item = "the quick onyx goblin jumps over a lazy dwarf while five wizards box quickly and judge my vow of sphinx"
    index = decontaminate.build_index([(7, item), (8, item.upper()[:30] + "-" * 70)])
    text = "before it " * 5 + item + " after it" * 5 + " " + item
    begin, again = text.index(item), text.rindex(item)
    assert decontaminate.find(index, text) == [(7, 0, begin, begin + len(item), 0), (7, 0, again, again + len(item), 0)]


def test_repetitive_texts_are_found_in_bounded_time():
    import time

    items = [(i, decontaminate.normal(c * n)) for i, (c, n) in enumerate([("a", 60 + k) for k in range(200)] + [("spam ", 30), ("ab", 70)])]
    index = decontaminate.build_index(items)
    begin = time.time()
    found = decontaminate.find(index, "a" * 100_000)
    assert {m[0] for m in found} == set(range(200)) and len(found) == 200
    # One alignment per segment length is kept, so the last one may end up to a segment early.
    assert all(m[2] == 0 and 100_000 - 128 < m[3] <= 100_000 for m in found)
    assert {m[0] for m in decontaminate.find(index, "x " * 300 + "spam " * 20_000)} == {200}
    assert time.time() - begin < 60


def test_pieces_find_what_the_whole_text_does(monkeypatch):
    rng = np.random.default_rng(12)
    words = ["alpha", "beta", "gamma", "delta", "kappa", "sigma", "omega"]
    items = [(i, " ".join(rng.choice(words, 30))) for i in range(20)]
    index = decontaminate.build_index(items)
    texts = [" ".join(rng.choice(words, 150)) + " " + items[i][1][5:150] + " " + " ".join(rng.choice(words, 150)) for i in range(20)]
    whole = [decontaminate.find(index, t) for t in texts]
    assert all(i in {m[0] for m in found} for i, found in enumerate(whole))
    monkeypatch.setattr(decontaminate, "HITS", 0)
    for text, found in zip(texts, whole):
        assert {m[0] for m in decontaminate.find(index, text)} == {m[0] for m in found}


def test_blocks_are_passes_with_the_same_matches(spark, sf_dir, monkeypatch):
    docs = common.read_table(spark, sf_dir, "documents").withColumn("_found", F.lit(1)).withColumn("_digest", F.lit("x"))
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    bench = common.read_table(spark, sf_dir, "benchmark")
    rows = lambda: sorted(decontaminate.contamination(docs, bench).collect(), key=str)
    kept = lambda: sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect())
    one, left = rows(), kept()
    total = bench.agg(F.sum(F.length("text"))).first()[0]
    monkeypatch.setattr(decontaminate, "blocks", lambda b, blocks=decontaminate.blocks: blocks(b, chars=total // 2))
    assert len(list(decontaminate.blocks(bench))) >= 2
    assert rows() == one and kept() == left
    assert any(r["contaminated"] for r in one) and len(one) == docs.count()


# ------------------------------------------------------------ SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    from check import difference, views

    assert difference(QUERIES[name](spark, sf_dir).toPandas(), views(sf_dir).sql(ORACLES[name]).df()) is None
