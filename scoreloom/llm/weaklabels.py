"""Quality by weak labels: heuristics vote, expectation-maximisation weighs them, a linear model learns.

Each heuristic votes good, bad or nothing on a text. What all documents voted is counted by vote
pattern; expectation-maximisation over those counts estimates how often each heuristic is
right and gives every pattern a posterior probability of good. A linear model over hashed words and
a few shape features learns the posteriors and scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import col
from scoreloom.llm.textarrays import runs, shape_hashes, word_hashes

ROUNDS = 200
#: Texts the linear scorer is fitted on at most, those with the least hashes of id and text, a repeated row once.
SAMPLE = 20_000
#: Slots of the scorer: size classes, classes of repetition, hashed shapes of words, hashed words.
SIZES, REPEATS, SHAPES, SLOTS = 24, 40, 2048, 1 << 14
RIDGE = 0.3
STEPS = 300
#: Good documents are assumed to be at least as frequent as this in the first round.
PRIOR = 0.7
#: Votes: good, bad, none.
GOOD, BAD, NONE = 1, 0, -1
HEURISTICS = ("length", "word_length", "letters", "marks", "capitals", "repeats", "lines", "stop_words")

# Frequent function words of the languages the corpus has.
STOP_WORDS = ("the of and to in is that for with was are this der die das und den von zu mit ist ein eine im "
              "le la les de des et un une du est que pour dans el los las y en una con por para del").split()


def measures(text: Column) -> dict[str, Column]:
    """Plain statistics of a text; the arrays of its words and lines are made once and not kept."""
    whole = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(w: Column) -> Column:
        # a blank at the begin or end of the text leaves an empty part there
        ends = (w[0] == "").cast("int") + ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int")
        return F.struct((F.size(w) - ends).alias("n"), F.size(F.array_distinct(w)).alias("spread"),
                        F.size(F.array_intersect(w, F.array(*map(F.lit, STOP_WORDS)))).alias("stops"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("spread"))

    words = F.split(F.lower(whole), r"[\x20\x09-\x0D]+")
    lines = F.filter(F.split(whole, "\n"), lambda x: x != "")
    return {"chars": F.length(whole),
            "words": F.transform(F.array(words), of_words)[0],
            "letters": F.regexp_count(whole, F.lit(r"\p{L}+")),
            "marks": F.regexp_count(whole, F.lit(r"[#|*%$&!<>{}=+~^@]")),
            "capitals": F.regexp_count(whole, F.lit("[A-Z]")),
            "lines": F.transform(F.array(lines), of_lines)[0]}


def votes(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``votes``, the heuristics' votes in their order as an array of small integers."""
    found = measures(col(text_col))
    kept = df.columns
    df = df.withColumn("__m", F.explode(F.array(F.struct(*[v.alias(k) for k, v in found.items()]))))
    m = {k: F.col("__m")[k] for k in found}
    counted = m["words"]["n"]
    words = F.greatest(counted, F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, BAD).when(good, GOOD).otherwise(NONE).cast("tinyint")

    stops = m["words"]["stops"]
    repeats = m["words"]["spread"] / words
    lines = m["lines"]["spread"] / F.greatest(m["lines"]["n"], F.lit(1))
    marks, capitals = m["marks"] / words, m["capitals"] / F.greatest(m["chars"], F.lit(1))
    mean = m["chars"] / words
    columns = [vote((counted >= 50) & (counted <= 20_000), counted < 12),
               vote((mean >= 4) & (mean <= 9), (mean < 2.5) | (mean > 20)),
               vote(m["letters"] >= 0.95 * words, m["letters"] < 0.6 * words),
               vote(marks < 0.02, marks > 0.2),
               vote(capitals < 0.06, capitals > 0.3),
               vote(repeats > 0.4, repeats < 0.2),
               vote(lines > 0.9, lines < 0.6),
               vote(stops >= 4, stops < 2)]
    return df.withColumn("votes", F.array(*columns)).select(*[col(c) for c in kept], "votes")


@dataclass
class LabelModel:
    """How often each heuristic votes good or bad given the class, and the share of good texts."""

    prior: float
    given_good: np.ndarray
    given_bad: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes; rows without votes have the prior."""
        odds = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for v, side in ((GOOD, 0), (BAD, 1)):
            ratio = np.log(self.given_good[:, side] / self.given_bad[:, side])
            odds += (patterns == v) @ ratio
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, prior: float = PRIOR) -> LabelModel:
    """Expectation-maximisation over vote patterns and how often each occurs.

    Heuristics are independent given the class; a vote of none is uninformative. The first
    posterior is the majority vote, which settles which class is called good.
    """
    n_votes = patterns.shape[1]
    balance = ((patterns == GOOD).sum(axis=1) - (patterns == BAD).sum(axis=1)) / max(n_votes, 1)
    good = np.clip(prior + balance * (1 - prior), 0.02, 0.98) if len(patterns) else np.empty(0)
    model = LabelModel(prior, np.full((n_votes, 2), 0.5), np.full((n_votes, 2), 0.5))
    for _ in range(rounds):
        mass = [counts * good, counts * (1 - good)]
        tables = []
        for m in mass:
            cast = np.stack([m @ (patterns == GOOD), m @ (patterns == BAD)], axis=1) + 1.0
            tables.append(cast / cast.sum(axis=1, keepdims=True))
        share = float(np.clip((mass[0].sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
        model = LabelModel(share, *tables)
        new = model.posterior(patterns)
        if len(new) == 0 or np.abs(new - good).max() < 1e-9:
            break
        good = new
    return model


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, slot, value), sorted by text: what the linear scorer sees of a text.

    Distinct words share a length of one, a shape has the root of its share of all words, and
    the classes of size and of repetition are 1.
    """
    n, each = len(texts), np.arange(len(texts))
    owner, value, _ = word_hashes(texts)
    pairs = np.unique(owner * np.int64(SLOTS) + (value >> np.uint64(50)).astype(np.int64) % (SLOTS - SHAPES) + SHAPES)
    words, distinct = np.bincount(owner, minlength=n), np.bincount(pairs // SLOTS, minlength=n)
    shaped, shape, _ = shape_hashes(texts)
    kinds, times = np.unique(shaped * np.int64(SLOTS) + (shape >> np.uint64(50)).astype(np.int64) % (SHAPES - REPEATS)
                             + REPEATS, return_counts=True)
    total = np.maximum(np.bincount(shaped, minlength=n), 1)
    sized = np.minimum(np.log2(words + 1).astype(np.int64), SIZES - 1)
    repeated = SIZES + (15 * distinct // np.maximum(words, 1))
    keys = np.concatenate([pairs, kinds, each * SLOTS + sized, each * SLOTS + repeated])
    values = np.concatenate([1 / np.sqrt(distinct)[pairs // SLOTS], np.sqrt(times / total[kinds // SLOTS]), np.ones(2 * n)])
    order = np.argsort(keys, kind="stable")
    return keys[order] // SLOTS, keys[order] % SLOTS, values[order]


def fit_scorer(owner: np.ndarray, slot: np.ndarray, value: np.ndarray, targets: np.ndarray, ridge: float = RIDGE,
               steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Nesterov's method, each weight's step scaled to its curvature bound."""
    n = len(targets)
    rate = (targets.sum() + 0.5) / (n + 1)
    weights, bias = np.zeros(SLOTS), float(np.log(rate / (1 - rate)))
    reach = np.bincount(owner, weights=value, minlength=n) + 1
    curvature = 0.25 * np.bincount(slot, weights=value * reach[owner], minlength=SLOTS) + ridge
    ahead, ahead_bias, t = weights.copy(), bias, 1.0
    for _ in range(steps if n else 0):
        z = np.bincount(owner, weights=ahead[slot] * value, minlength=n) + ahead_bias
        error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - targets
        new = ahead - (np.bincount(slot, weights=error[owner] * value, minlength=SLOTS) + ridge * ahead) / curvature
        new_bias = ahead_bias - error.sum() / (0.25 * reach.sum())
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum, t = (t - 1) / after, after
        ahead, ahead_bias = new + momentum * (new - weights), new_bias + momentum * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, bias


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, votes, weak_label, score, predicted`` of every document.

    ``weak_label`` is the label model's posterior, fitted on the votes of all documents; ``score`` is the
    linear scorer's probability of good over the whole text, ``predicted`` 1 from one half on. Null
    and empty texts have no words: the heuristics vote bad on them. Repeated rows and null ids are
    scored each by itself. An empty table gives an empty one; further columns are ignored.

    The driver gets one row per vote pattern (at most 3 ** heuristics) and the sample's slots; the sample's
    texts stay in the tasks that read them. Votes are taken anew where they are needed, as a staged copy of
    all texts would cost more.
    """
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    hashed = rows.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text")))
    # rows with equal hashes vote alike, so the numbers of different hashes add up over the patterns
    counted = votes(hashed, "text").groupBy("votes").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("different")).collect()
    patterns = np.array([r["votes"] for r in counted], np.int64).reshape(-1, len(HEURISTICS))
    model = fit_label_model(patterns, np.array([r["n"] for r in counted], float))
    edge = min(1.0, 1.2 * sample / max(sum(r["different"] for r in counted), 1))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, slots, values = [t.encode("utf-8", "surrogatepass") for t in batch["text"]], [], []
            for a, b in runs(texts):
                owner, slot, value = _features(texts[a:b])
                cut = np.searchsorted(owner, np.arange(1, b - a))
                slots += [x.tobytes() for x in np.split(slot.astype("<u2"), cut)]
                values += [x.tobytes() for x in np.split(value.astype("<f4"), cut)]
            yield pd.DataFrame({"h": batch["h"], "votes": batch["votes"], "slots": slots, "values": values})

    near = (hashed.where((F.col("h") / F.lit(2.0 ** 64) + 0.5) <= edge)
            .groupBy("h").agg(F.min("text").alias("text")))
    picked = (votes(near, "text")
              .mapInPandas(features, "h long, votes array<tinyint>, slots binary, values binary")
              .orderBy("h").limit(sample).toPandas())
    targets = model.posterior(np.array(picked["votes"].tolist(), np.int64).reshape(-1, len(HEURISTICS)))
    slots, values = (np.frombuffer(b"".join(picked[c]), kind) for c, kind in (("slots", "<u2"), ("values", "<f4")))
    owner = np.repeat(np.arange(len(picked)), [len(s) // 2 for s in picked["slots"]])
    weights, bias = fit_scorer(owner, slots.astype(np.int64), values.astype(float), targets)

    @F.pandas_udf("weak_label double, score double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, cast in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in text]
            z = np.full(len(texts), bias)
            for a, b in runs(texts):
                owner, slot, value = _features(texts[a:b])
                z[a:b] += np.bincount(owner, weights=weights[slot] * value, minlength=b - a)
            yield pd.DataFrame({"weak_label": model.posterior(np.array(cast.tolist(), np.int64)
                                                              .reshape(-1, len(HEURISTICS))),
                                "score": 1 / (1 + np.exp(-np.clip(z, -35, 35)))})

    return (votes(rows, "text").withColumn("p", score("text", "votes"))
            .select("doc_id", "votes", "p.weak_label", "p.score", (F.col("p.score") >= 0.5).cast("int").alias("predicted")))
