"""Language identification by the nearest of several centroids per language.

Texts become normalised TF-IDF vectors of hashed byte n-grams (1 to 3 bytes, word edges
included). A bounded sample of labelled texts of each language is clustered by spherical k-means;
a text gets the language of the centroid with the largest cosine, and is rejected when
that cosine is far below what the centroid's own members have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.llm.common import col
from scoreloom.llm.textarrays import ngram_counts, runs

WIDTH = 4096
#: Labelled texts of a language that its centroids are fitted on at most.
SAMPLE = 512
CENTROIDS = 4
ROUNDS = 15
UNKNOWN = "und"
#: A text is rejected below this share of the least cosine among a centroid's own texts.
REJECT_SHARE = 0.25
LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    """Centroid rows (unit length), the language and reject threshold of each, and the idf weights."""

    centroids: np.ndarray
    languages: list[str]
    thresholds: np.ndarray
    idf: np.ndarray


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(LETTER), F.lit(False))


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    counts = ngram_counts(texts, len(idf)).astype(np.float32)
    out = np.log1p(counts, out=counts) * idf.astype(np.float32)
    norms = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.maximum(norms, 1e-12)[:, None]


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and least member cosines. Starts from the row farthest from those chosen."""
    chosen = [0]
    for _ in range(1, min(k, len(rows))):
        best = (rows @ rows[chosen].T).max(axis=1)
        if best.min() > 1 - 1e-9:
            break
        chosen.append(int(best.argmin()))
    centroids = rows[chosen].copy()
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        norms = np.sqrt((sums ** 2).sum(axis=1))
        centroids[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    cosines = rows @ centroids.T
    nearest = cosines.argmax(axis=1)
    least = np.array([cosines[nearest == i, i].min(initial=1.0) for i in range(len(centroids))])
    return centroids, least


def _frequencies(width: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(width, np.int64), 0
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            for a, b in runs(texts):
                total += (ngram_counts(texts[a:b], width) > 0).sum(axis=0)
            n += len(texts)
        yield pd.DataFrame({"slot": np.arange(-1, width), "n": np.concatenate([[n], total])})

    return count


def fit_languages(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, width: int = WIDTH,
                  sample: int = SAMPLE, centroids: int = CENTROIDS,
                  reject_share: float = REJECT_SHARE) -> LanguageModel:
    """Fit on the rows given; rows without id, language or letters are left out.

    Document frequencies are counted over all of them. Centroids are fitted on at most
    ``sample`` texts of each language, those whose ids and texts have the least hashes, a repeated
    row once; each language is clustered in a task of its own, which that bound keeps small.
    """
    rows = labelled.select(F.xxhash64(col(id_col).cast("string"), col(text_col)).alias("h"),
                           F.lower(col(text_col)).alias("text"), col(lang_col).alias("lang")).where(
        col(id_col).isNotNull() & col(lang_col).isNotNull() & has_letters(col(text_col)))
    counted = (rows.select("text").mapInPandas(_frequencies(width), "slot int, n long")
               .groupBy("slot").agg(F.sum("n").alias("n")).collect())
    frequency = np.zeros(width)
    total = 0
    for slot, n in counted:
        if slot < 0:
            total = n
        else:
            frequency[slot] = n
    idf = np.log((1 + total) / (1 + frequency)) + 1
    # a hash threshold per language lets through about twice ``sample`` rows, before any shuffle of texts; it goes
    # by the number of different hashes, as repeated rows pass it all or not at all
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("n"))
    # one row per language, as in the model itself: the threshold then acts before rows are dealt by language
    near = (rows.join(F.broadcast(sizes), "lang").where((F.col("h") / F.lit(2.0 ** 64) + 0.5) <= share)
            .groupBy("lang", "h").agg(F.min("text").alias("text")))
    picked = near.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).where(
        F.col("nth") <= sample)

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("nth")
        texts = [t.encode("utf-8", "surrogatepass") for t in frame["text"]]
        found, least = spherical_kmeans(np.concatenate([vectors(texts[a:b], idf) for a, b in runs(texts)]), centroids)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": found.astype(float).tolist(),
                             "least": least.astype(float)})

    models = (picked.select("lang", "text", "nth").groupBy("lang")
              .applyInPandas(cluster, "lang string, centroid array<double>, least double").collect())
    models.sort(key=lambda r: (r["lang"], r["centroid"]))
    return LanguageModel(np.array([r["centroid"] for r in models], np.float32).reshape(-1, width),
                         [r["lang"] for r in models], np.array([r["least"] * reject_share for r in models]), idf)


def language_of(text: Column, model: LanguageModel) -> Column:
    """A struct of ``lang_pred``, ``score`` (the largest cosine) and ``rejected`` for a text column.

    Texts that are null or have no letter are ``und`` with score 0 and rejected; so is every text
    when nothing was learned. Among equal cosines the first language by name wins.
    """
    names = np.array(model.languages + [UNKNOWN], object)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, lettered in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in text]
            best, cosine = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            if len(model.centroids):
                for a, b in runs(texts):
                    cosines = vectors(texts[a:b], model.idf) @ model.centroids.T
                    best[a:b] = cosines.argmax(axis=1)
                    cosine[a:b] = cosines.max(axis=1)
            known = lettered.to_numpy(bool) & (best < len(names) - 1)
            best[~known] = len(names) - 1
            cosine = np.where(known, np.clip(cosine, 0.0, 1.0), 0.0)
            limits = np.append(model.thresholds, np.inf)
            yield pd.DataFrame({"lang_pred": names[best], "score": cosine, "rejected": cosine < limits[best]})

    whole = F.coalesce(text.cast("string"), F.lit(""))
    return predict(F.lower(whole), has_letters(whole))
