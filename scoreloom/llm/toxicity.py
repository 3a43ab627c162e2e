"""Toxicity by a linear classifier that is indifferent to identity terms.

A logistic model over the distinct words of a text is fitted to labelled rows. In labelled texts
that mention an identity term, the term is swapped for the others of its group and for a
neutral word; the square of each score change is added to the loss. A term that is frequent in
toxic texts then can't carry weight of its own, so neutral mentions are not flagged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col
from scoreloom.llm.textarrays import runs, word_hash, word_hashes

#: Labelled rows the model is fitted on at most, those whose ids have the least hashes.
SAMPLE = 20_000
#: Words the model weighs at most, the rows a word is in at least, and its least chi-square.
WORDS = 4_096
LEAST_ROWS = 4
LEAST_CHI2 = 10.83
RIDGE = 0.3
SWAP_PENALTY = 20.0
STEPS = 300

# Groups of words that are swapped for each other; the last of each is neutral.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys", "people"),
    ("woman", "man", "girl", "boy", "person"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "religious"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "believers"),
    ("gay", "lesbian", "bisexual", "transgender", "queer", "straight", "married"),
    ("black", "white", "asian", "african", "latino", "european", "american", "local"),
    ("immigrant", "refugee", "foreigner", "migrant", "citizen", "resident"),
    ("immigrants", "refugees", "foreigners", "migrants", "citizens", "residents"),
    ("disabled", "deaf", "blind", "autistic", "old", "young", "tall"),
    ("frauen", "männer", "ausländer", "flüchtlinge", "muslime", "christen", "juden", "leute"),
    ("femmes", "hommes", "étrangers", "réfugiés", "musulmans", "chrétiens", "juifs", "gens"),
    ("mujeres", "hombres", "extranjeros", "refugiados", "musulmanes", "cristianos", "judíos", "personas"),
)


@dataclass
class ToxicityModel:
    """Sorted word hashes, the weight of each, and the intercept."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def _encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def _distinct(texts: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, index in ``known``) of every known word in a text, once each."""
    owner, value, _ = word_hashes(texts)
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    hit = known[at] == value
    pairs = np.unique(owner[hit].astype(np.int64) * len(known) + at[hit])
    return pairs // len(known), pairs % len(known)


@F.pandas_udf(ArrayType(LongType()))
def _word_sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        texts, out = _encoded(batch), []
        for a, b in runs(texts):
            owner, value, _ = word_hashes(texts[a:b])
            for part in np.split(value, np.searchsorted(owner, np.arange(1, b - a))):
                out.append(np.unique(part).view(np.int64))
        yield pd.Series(out, dtype=object)


def lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text.cast("string"), F.lit("")))


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, n_words: int, swaps: dict[tuple[int, int], int],
                ridge: float = RIDGE, penalty: float = SWAP_PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept: logistic loss, ridge, and squared score changes under swaps.

    ``rows`` holds word indices per text, ``swaps`` how many texts had word a swapped for b. The
    optimiser is Nesterov's, each weight's step scaled to its own curvature bound.
    """
    n = max(len(rows), 1)
    sizes = np.array([len(r) for r in rows], np.int64)
    owner, index = np.repeat(np.arange(len(rows)), sizes), (np.concatenate(rows) if rows else np.empty(0)).astype(np.int64)
    pairs = np.array(list(swaps), np.int64).reshape(-1, 2)
    times = np.array(list(swaps.values()), float)
    curvature = 0.25 * np.bincount(index, weights=sizes[owner] + 1.0, minlength=n_words) + ridge
    for side in (0, 1):
        curvature += np.bincount(pairs[:, side], weights=4 * penalty * times, minlength=n_words)
    rate = (labels.sum() + 0.5) / (n + 1)
    weights, bias = np.zeros(n_words), float(np.log(rate / (1 - rate)))
    ahead, ahead_bias, t = weights.copy(), bias, 1.0
    for _ in range(steps):
        z = np.bincount(owner, weights=ahead[index], minlength=len(rows)) + ahead_bias
        error = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels
        slope = np.bincount(index, weights=error[owner], minlength=n_words) + ridge * ahead
        change = 2 * penalty * times * (ahead[pairs[:, 0]] - ahead[pairs[:, 1]])
        slope += np.bincount(pairs[:, 0], weights=change, minlength=n_words)
        slope -= np.bincount(pairs[:, 1], weights=change, minlength=n_words)
        new = ahead - slope / np.maximum(curvature, 1e-9)
        new_bias = ahead_bias - error.sum() / (0.25 * (sizes + 1.0).sum() + 1e-9)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = (t - 1) / after
        ahead, ahead_bias = new + momentum * (new - weights), new_bias + momentum * (new_bias - bias)
        weights, bias, t = new, new_bias, after
    return weights, float(bias)


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample: int = SAMPLE,
                 groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> ToxicityModel:
    """Fit on at most ``sample`` labelled texts whose id satisfies ``learn`` (a column of ``doc_id``).

    Rows without id or label are left out; of several labels of an id the largest counts, and of equal
    rows of an id one. The sample of ids is bounded, so it is broadcast; where ids have several texts, those with
    the least hashes are kept, about ``sample`` in all. The driver gets the chosen words of these. With no
    labelled row the model says 0.5 less than half: score is the smoothed share of toxic rows.
    """
    marks = (labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull()).where(learn)
             .groupBy("doc_id").agg(F.max("y").alias("y"))
             .withColumn("h", F.xxhash64(F.col("doc_id").cast("string"))))
    n = marks.count()
    if n > sample:  # before the sort, drop what can't be among the least hashes
        edge = min(1.0, 1.2 * sample / n + 1e-3)
        marks = marks.where(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= edge)
    marks = marks.orderBy("h", "doc_id").limit(sample)
    texts = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    rows = stage(texts.join(F.broadcast(marks.drop("h")), "doc_id")
                 .groupBy(F.xxhash64("doc_id", "text").alias("h")).agg(F.max("y").alias("y"), F.min("text").alias("text"))
                 .select("h", "y", _word_sets(lowered(F.col("text"))).alias("words")), "toxicity")
    different = rows.count()
    if different > sample:
        rows = rows.where(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= sample / different)
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    split = F.lit(float(toxic) / max(total, 1))
    a, both = F.col("toxic"), F.col("n")
    expected = both * split
    chi2 = (a - expected) * (a - expected) / (expected * (1 - split) * (1 - both / F.lit(float(total + 1))))
    ranked = (rows.select("y", F.explode("words").alias("word")).groupBy("word")
              .agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS)
              .withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
              .orderBy(F.desc("chi2"), "word").limit(WORDS).collect()) if 0 < toxic < total else []
    hashed = [[word_hash(w) for w in g] for g in groups]
    identity = {h for g in hashed for h in g}
    words = np.unique(np.array([r["word"] % (1 << 64) for r in ranked] + (list(identity) or [0]), np.uint64))

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = []
            for values in batch["words"]:
                values = np.asarray(values, np.int64).view(np.uint64)
                at = np.minimum(np.searchsorted(words, values), len(words) - 1)
                held.append(at[words[at] == values].astype(np.int32))
            yield pd.DataFrame({"y": batch["y"], "at": held})

    picked = rows.mapInPandas(chosen, "y int, at array<int>").toPandas()
    place = {int(h): i for i, h in enumerate(words)}
    others = {place[h]: [place[o] for o in g if o != h] for g in hashed for h in g}
    swaps = Counter()
    for at in picked["at"]:
        for i in at:
            swaps.update((int(i), o) for o in others.get(int(i), ()))
    y = picked["y"].to_numpy(float) if len(picked) else np.empty(0)
    weights, bias = fit_weights([np.asarray(r) for r in picked["at"]], y, len(words), dict(swaps))
    return ToxicityModel(words, weights, bias)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Probability that a text is toxic, over all of its distinct words; null counts as empty."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = _encoded(batch)
            z = np.full(len(texts), model.bias)
            for a, b in runs(texts):
                owner, index = _distinct(texts[a:b], model.words)
                z[a:b] += np.bincount(owner, weights=model.weights[index], minlength=b - a)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    return score(lowered(text))
