"""Language, URL, quality and toxicity models on held-out rows; search against brute force; the pipeline."""

import zlib
from collections import Counter
from urllib.parse import quote

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scoreloom.llm import hilbert, langid, queries, toxicity, urlfilter, weaklabels
from odd_rows import ODD


def auc(score, label):
    score, label = np.array(score), np.array(label)
    return np.mean([(score[label == 1] > s).mean() + 0.5 * (score[label == 1] == s).mean() for s in score[label == 0]])


def test_language_on_held_out_rows(spark, corpus, sf):
    got = queries.op2_language(spark, sf).collect()
    text = {r.doc_id: (r.text, r.lang) for r in corpus}
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in corpus)
    right = known = 0
    for r in got:
        body, lang = text[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        if body is None or not any(c.isalpha() for c in body):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.held_out and lang is not None and len(body) > 40:
            known += 1
            right += r.lang_pred == lang
    assert right / known > 0.95


def test_language_odd_rows(docs_of):
    docs = docs_of(ODD, extra=True)
    model = langid.fit_languages(docs, "doc_id", "text", "lang")
    got = docs.select("text", langid.language_of(F.col("text"), model).alias("p")).collect()
    assert len(got) == len(ODD)
    assert all(r.p.lang_pred == "und" and r.p.rejected for r in got if r.text is None or not any(map(str.isalpha, r.text)))
    empty = langid.fit_languages(docs_of([]), "doc_id", "text", "lang")
    assert {r.p.lang_pred for r in docs.select(langid.language_of(F.col("text"), empty).alias("p")).collect()} == {"und"}


def test_language_rejects_what_is_far(docs_of):
    rows = [(i, f"the house and the garden of the town {i} with a river and some trees", "en", "s", 1) for i in range(40)]
    model = langid.fit_languages(docs_of(rows), "doc_id", "text", "lang")
    asked = docs_of([(1, "the garden of the house", None, None, 1), (2, "字字字字", None, None, 1)])
    got = {r.doc_id: r.p.rejected for r in asked.select("doc_id", langid.language_of(F.col("text"), model).alias("p")).collect()}
    assert got == {1: False, 2: True}


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, tail = rest[:end], rest[end:]
    end = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"),
                                                  ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_rules(spark, sf):
    url = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op3_url_words(spark, sf).collect()
    assert len(got) == len(url)
    for r in got:
        assert (r.host, r.path) == plain_url(url[r.page_id])
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or ("block" if r.score > 0 else "allow"))


def test_url_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://EXAMPLE.net/en/x", "http://a.example.net/fr/", "http://x.org/fr/",
            "http://x.org", "http://net/", "http://example.com/de/?q", "a://b://c/d", "http://x.com\n.net/a",
            "http://cheapcasinopills.com/" + quote("é") * 5000, "http://universitylibrary.com/"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(None, "http://x.net/", "<p>a</p>")],
                               "page_id long, url string, html string").withColumn("words", F.lit(1)).withColumn("score", F.lit(1))
    got = {r.page_id: r for r in urlfilter.judge(df).collect()}
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path) == plain_url(u)
        assert got[i].rule == plain_rule(got[i].host, got[i].path)[0]
    assert got[12].verdict == "block" and {"cheap", "casino", "pills"} <= set(got[12].words)
    assert got[13].verdict == "allow" and {"university", "library"} <= set(got[13].words)
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_url_words_know_every_word(spark):
    """More words than a collected lexicon would hold: the rare ones split names all the same."""
    rare = ["".join(chr(97 + n // 26 ** k % 26) for k in range(4)) + "qzx" for n in range(urlfilter.LEXICON + 10_000)]
    urls = [f"http://meadow{w}.meadow/{w[::-1]}/{w}{rare[7]}" for w in rare[::3000]]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [
        (-1 - i, None, "<p>meadow " + " ".join(rare[i::100])) for i in range(100)], "page_id long, url string, html string")
    got = {r.page_id: r.words for r in urlfilter.judge(pages).collect()}
    counts = Counter({w: 1 for w in rare} | {"meadow": 100})
    counts.update({w: urlfilter.SEED_COUNT for w in [*urlfilter.BLOCK_SEEDS, *urlfilter.ALLOW_SEEDS]})
    lexicon = urlfilter.Lexicon.of(counts)
    for i, w in enumerate(rare[::3000]):
        assert got[i] == ["meadow", w, "meadow", *lexicon.split(w[::-1]), w, rare[7]]


def test_lexicon_keeps_whole_levels(spark):
    html = " ".join(["often"] * 9 + ["some"] * 5 + ["other"] * 5 + ["rare"])
    df = spark.createDataFrame([(f"<b>{html}</b>",), (None,)], "html string")
    for size, words in ((4, {"often", "some", "other", "rare"}), (3, {"often", "some", "other"}), (2, {"often"}), (0, set())):
        assert set(urlfilter.learn_lexicon(df, "html", [], size).costs) == words
    assert set(urlfilter.learn_lexicon(df.limit(0), "html", ["seed"]).costs) == {"seed"}


def plain_search(rows, queries_, k=20):
    ids = np.array([i for i, _ in rows])
    values = np.array([v for _, v in rows], np.float64)
    for q in queries_:
        scores = values @ values[ids == q][0]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        yield q, [(int(ids[j]), float(scores[j])) for j in order]


def test_search_recall(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
            if r.embedding is not None and any(r.embedding) and np.isfinite(np.array(r.embedding, float)).all()]
    got = {}
    for r in queries.op5_hilbert(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = total = 0
    value = dict(rows)
    for q, best in plain_search(rows, [i for i, _ in rows if i % 20 == 0]):
        found = got[q]
        assert len(found) == len(best) and found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, s in found:
            assert s == pytest.approx(float(np.dot(np.array(value[q], float), np.array(value[i], float))), rel=1e-9, abs=1e-9)
        hit += len({i for i, _ in found} & {i for i, _ in best})
        total += len(best)
    assert hit / total >= 0.9


def test_search_recall_over_many_ranges(spark):
    """22,000 vectors in 22 ranges: the given ones with their components turned by 0 to 10 places."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("embedding is not null")
    turned = given.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(10)))).select(
        (F.col("vec_id") * 11 + F.col("t")).alias("vec_id"),
        F.expr("concat(slice(embedding, t + 1, size(embedding)), slice(embedding, 1, t))").alias("embedding"))
    rows = {r.vec_id: np.array(r.embedding, float) for r in turned.collect()}
    got = {}
    for r in hilbert.nearest(turned, F.col("vec_id") % 200 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ids, values = np.array(list(rows)), np.stack(list(rows.values()))
    hit = []
    for q in [i for i in rows if i % 200 == 0]:
        scores = np.where(ids == q, -np.inf, values @ rows[q])
        hit.append(len(got[q] & set(ids[np.argsort(-scores, kind="stable")[:20]])) / 20)
    assert len(rows) >= 20_000 and len(hit) == 110 and np.mean(hit) >= 0.9


def test_windows_are_as_narrow_as_the_data_allow():
    rng = np.random.default_rng(3)
    flat = rng.normal(size=(5000, 3)) @ rng.normal(size=(3, 32))
    ids, shares = np.arange(5000), []
    for values in (flat, rng.normal(size=(5000, 32))):
        values = values / np.linalg.norm(values, axis=1)[:, None]
        index = hilbert.Curves(32, 1.0).fit(values, ids, 5)
        shares.append(index.window(values, ids, 20, 0.95))
    assert shares[0] < 0.02 < shares[1]
    assert hilbert.Curves(32, 1.0).fit(values[:1], ids[:1], 1).window(values[:1], ids[:1], 20, 0.95) == 1.0


def test_search_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, 2.0]) for i in range(60)] + [(60, None), (61, [0.0, 0.0, 0.0]), (62, [1.0, None, 2.0]),
                                                                (63, [nan, 1.0, 1.0]), (64, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
                                                                (65, []), (0, [0.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cid", F.lit("x")).withColumn("n", F.lit(1))
    got = {}
    for r in hilbert.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in best] for q, best in plain_search(rows[:60], [0, 20, 40])}
    assert hilbert.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_hilbert_keys_walk_to_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = hilbert.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    walked = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_toxicity_on_held_out_rows(spark, sf, corpus):
    got = queries.op9_toxicity(spark, sf).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None}
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in corpus)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    if len({y for _, y in held}) == 2:
        assert auc(*zip(*held)) > 0.9


def test_toxicity_ignores_identity_terms(spark, docs_of):
    rows = [(i, ("you vile stupid muslims" if i % 2 else "a nice day for people") + f" n{i % 9}", "en", "s", 1) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    asked = docs_of([(1, "muslims meet today", None, None, 1), (2, "believers meet today", None, None, 1),
                     (3, "you vile stupid", None, None, 1)])

    def scores(groups):
        model = toxicity.fit_toxicity(docs_of(rows), labels, F.lit(True), groups=groups)
        return {r.doc_id: r.s for r in asked.select("doc_id", toxicity.toxicity_score(F.col("text"), model).alias("s")).collect()}

    plain, fair = scores(()), scores(toxicity.IDENTITY_GROUPS)
    assert plain[1] - plain[2] > 0.1
    assert abs(fair[1] - fair[2]) < 0.01 and fair[1] < plain[1]
    assert fair[3] > 0.9 > fair[1]


def test_toxicity_odd_rows(spark, docs_of):
    docs = docs_of(ODD, extra=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    for labels in (none, some):
        model = toxicity.fit_toxicity(docs, labels, F.lit(True))
        got = docs.select(toxicity.toxicity_score(F.col("text"), model).alias("s")).collect()
        assert len(got) == len(ODD) and all(0 <= r.s <= 1 for r in got)
    assert docs_of([]).select(toxicity.toxicity_score(F.col("text"), model)).count() == 0


def test_quality_separates_labels(spark, sf, corpus):
    got = queries.op8_quality(spark, sf).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in corpus)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None}
    pairs = [(r.score, label[r.doc_id]) for r in got if r.doc_id in label]
    assert auc(*zip(*pairs)) > 0.75


def test_quality_odd_rows(docs_of):
    docs = docs_of(ODD, extra=True)
    got = weaklabels.quality_scores(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ODD) and all(0 <= r.score <= 1 for r in got)
    assert weaklabels.quality_scores(docs_of([])).count() == 0


def test_pipeline_stages(spark, sf, corpus):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < 4:
            assert out.columns == names
            out = spark.createDataFrame(out.collect(), docs.schema)
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        seen.append(ids)
        docs = out
    toxic, language, dedup, mixed, packed = seen
    assert set(mixed) == set(dedup) == set(packed) and set(dedup) <= set(language) <= set(toxic)
    assert max(dedup.values()) == 1
    assert len(toxic) > 0.8 * len(corpus) and len(language) > 0.8 * len(toxic)
