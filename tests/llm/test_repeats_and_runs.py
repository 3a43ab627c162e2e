"""Samples of models when rows repeat, and texts with very long runs of blanks or letters."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from scoreloom.llm import langid, packing, tokentrees, toxicity, weaklabels
from scoreloom.llm.textarrays import RUN_TEXTS, runs
from scoreloom.llm.tokens import Encoder, default_path
from test_added_tokens import three_edits
from test_llm_texts import check_pieces

GERMAN, ENGLISH = "das haus und der garten mit dem fluss {}", "the house and the garden with a river {}"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(default_path())


@pytest.mark.parametrize("n", [9_999, 10_000, 10_001, 2_000_000])
def test_ids_of_long_blank_runs(exact, n):
    encoder = Encoder()
    for text in (" " * n, "a" + " " * n + "b", "x\n" + "\n" * n, "\t" * n + "y"):
        assert encoder.ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_operators_take_long_runs(spark, docs_of, exact):
    texts = [" " * 2_000_000, "a " + "\n" * 1_500_000 + "b", "q" * 2_000_000, None, "one two"]
    docs = docs_of([(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)])
    check_pieces(packing.pack(docs).collect(), list(enumerate(texts)), exact)
    check_pieces(corpus_pipeline.packed(spark, docs, "").collect(), list(enumerate(texts)), exact)
    for r in tokentrees.edited_counts(docs).collect():
        text = texts[r.doc_id] or ""
        assert r.tokens == len(exact.encode(text, add_special_tokens=False).ids)
        assert r.edited_tokens == len(exact.encode(three_edits(text), add_special_tokens=False).ids)


def test_runs_hold_few_texts():
    found = list(runs([b"ab"] * 2_000))
    assert found[0] == (0, RUN_TEXTS) and found[-1][1] == 2_000 and all(b - a <= RUN_TEXTS for a, b in found)


def test_language_of_one_id(docs_of):
    """Twenty languages, each of 1,500 rows that share one id."""
    rows = [(i, GERMAN.format(j % 3), f"l{i}", "s", 1) for i in range(1, 21) for j in range(1_500)]
    rows += [(100 + i, ENGLISH.format(i), "en", "s", 1) for i in range(40)]
    model = langid.fit_languages(docs_of(rows), "doc_id", "text", "lang")
    assert set(model.languages) == {"en"} | {f"l{i}" for i in range(1, 21)}


def test_language_of_many_texts_with_one_id(docs_of):
    rows = [(7, GERMAN.format(i), "de", "s", 1) for i in range(3_000)] + [(8, ENGLISH.format(0), "en", "s", 1)] * 3_000
    model = langid.fit_languages(docs_of(rows), "doc_id", "text", "lang")
    assert set(model.languages) == {"de", "en"}
    got = docs_of([(1, GERMAN.format(9), None, None, 1), (2, ENGLISH.format(9), None, None, 1)])
    got = {r.doc_id: r.p.lang_pred for r in got.select("doc_id", langid.language_of(F.col("text"), model).alias("p")).collect()}
    assert got == {1: "de", 2: "en"}


def test_quality_of_repeated_rows(spark, docs_of):
    row = docs_of([(0, ENGLISH.format("and some words more, as people write them. ") * 8, "en", "s", 1)])
    scores = set()
    for own_id in (1, 5, 9, 14):
        same = row.crossJoin(spark.range(30_000).select(F.lit(own_id).cast("long").alias("own"))).select(
            F.col("own").alias("doc_id"), "text")
        got = weaklabels.quality_scores(same).select(F.round("weak_label", 6), F.round("score", 6)).distinct().collect()
        assert len(got) == 1
        scores.add(tuple(got[0]))
    assert len(scores) == 1 and min(next(iter(scores))) > 0.5


def test_toxicity_sample_is_bounded_with_repeated_ids(spark, docs_of):
    """Equal rows count once; of many texts of one id about ``sample`` are used."""
    n = 4_000
    same = [(1, "you bad fool", "en", "s", 1)] * n + [(i, f"a kind word {i}", "en", "s", 1) for i in range(2, 60)]
    marks = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 60)], "doc_id long, toxic int")
    once = toxicity.fit_toxicity(docs_of(same[n - 1:]), marks, F.lit(True))
    often = toxicity.fit_toxicity(docs_of(same), marks, F.lit(True))
    assert once.bias == pytest.approx(often.bias) and (once.words == often.words).all()
    many = [(1, f"text number {i} of one id", "en", "s", 1) for i in range(n)] + [(2, "the other", "en", "s", 1)]
    model = toxicity.fit_toxicity(docs_of(many), marks, F.lit(True), sample=500)
    got = docs_of(many[:3]).select(toxicity.toxicity_score(F.col("text"), model).alias("s")).collect()
    assert all(r.s > 0.5 for r in got)
