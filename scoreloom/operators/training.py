"""Training, tuning, stacking, saving and applying models through Spark ML.

A trained model is a feature pipeline and a predictor. Each fold has a feature
pipeline fitted on its own training rows, whose output is staged and serves every
grid point; folds and holdouts come from a row hash, so reruns agree.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier,
    RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import (
    Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
    VectorSlicer)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column, hash_share
from scoreloom.functions.staging import stage
from scoreloom.operators.bayes import (
    BayesTables, bayes_score, bayes_tables, load_bayes, save_bayes)
from scoreloom.operators.cluster import quality_by_set
from scoreloom.operators.folds import FoldFits, fit_folds, in_parallel
from scoreloom.operators.grids import combinations, default_folds, default_grid
from scoreloom.operators.kmeans import Wanted, centres_model, fit_centres, pack
from scoreloom.operators.sample import holdout, modulo_fold

FEATURES = "__features"
FOLD = "__fold"
CLASSIFIERS = ("DL", "LR", "GBM", "NB", "RF")
# The driver holds a matrix of slots x slots doubles for the collinearity check, up to 288 MB; beyond it
# the check is left out with a warning.
COLLINEAR_WIDTH = 6_000


# --------------------------------------------------------------------------
# naive Bayes as an estimator, so that it tunes like the others
# --------------------------------------------------------------------------

class _BayesParams(Params):
    laplace = Param(Params._dummy(), "laplace", "added to level counts", TypeConverters.toFloat)
    min_sdev = Param(Params._dummy(), "min_sdev", "replacement deviation", TypeConverters.toFloat)
    eps_sdev = Param(Params._dummy(), "eps_sdev", "deviation that is replaced", TypeConverters.toFloat)

    def _start(self) -> None:
        self._setDefault(laplace=0.0, min_sdev=0.001, eps_sdev=0.0)

    def smoothing(self) -> dict[str, float]:
        return {n: self.getOrDefault(n) for n in ("laplace", "min_sdev", "eps_sdev")}


class MixedNaiveBayes(Estimator, _BayesParams):
    """Naive Bayes on text and number columns of the table itself."""

    @keyword_only
    def __init__(self, *, label: str, numeric: Sequence[str], factors: Sequence[str]):
        super().__init__()
        self._start()
        self.columns = dict(self._input_kwargs)

    def _tables(self, df: DataFrame) -> BayesTables:
        c = self.columns
        return bayes_tables(df, c["label"], c["numeric"], c["factors"])

    def _fit(self, df: DataFrame) -> "MixedNaiveBayesModel":
        return MixedNaiveBayesModel(self._tables(df), self.smoothing())

    def fitMultiple(self, df, paramMaps):
        # the counts do not depend on the smoothing: one aggregation for the grid
        tables = self._tables(df)
        # a list iterator: the tuner draws from it on several threads
        return iter([(i, MixedNaiveBayesModel(tables, self.copy(m).smoothing()))
                     for i, m in enumerate(paramMaps)])


class MixedNaiveBayesModel(Model, _BayesParams):
    def __init__(self, tables: BayesTables | None = None, smoothing: dict[str, float] | None = None):
        super().__init__()
        self._start()
        self.tables = tables
        self._set(**(smoothing or {}))

    def _transform(self, df: DataFrame) -> DataFrame:
        return bayes_score(df, self.tables, **self.smoothing())


# --------------------------------------------------------------------------
# features
# --------------------------------------------------------------------------

def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def feature_pipeline(numeric: Sequence[str], factors: Sequence[str], *, one_hot: bool,
                     missing_flags: bool, scale: bool = False, centre: bool = False) -> Pipeline:
    """Index or one-hot factors (missing and unseen levels get a slot of their
    own), fill numerics with the mean, optionally flag missing numerics.
    """
    stages, parts = [], []
    doubles = ["__x%d" % i for i in range(len(numeric))]
    flags = ["__na%d" % i for i in range(len(numeric))]
    if numeric:
        made = [f"CAST({_sql_name(c)} AS DOUBLE) AS {d}" for c, d in zip(numeric, doubles)]
        if missing_flags:
            made += [f"CAST({_sql_name(c)} IS NULL AS DOUBLE) AS {f}" for c, f in zip(numeric, flags)]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__"))
        filled = [d + "_f" for d in doubles]
        stages.append(Imputer(strategy="mean", inputCols=doubles, outputCols=filled))
        parts += filled + (flags if missing_flags else [])
    if factors:
        texts = ["__t%d" % i for i in range(len(factors))]
        index = ["__i%d" % i for i in range(len(factors))]
        cast = ", ".join(f"CAST({_sql_name(c)} AS STRING) AS {t}" for c, t in zip(factors, texts))
        stages.append(SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__"))
        stages.append(StringIndexer(inputCols=texts, outputCols=index, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        if one_hot:
            hot = ["__h%d" % i for i in range(len(factors))]
            stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True,
                                        handleInvalid="keep"))
            parts += hot
        else:
            parts += index
    raw = "__raw" if scale else FEATURES
    stages.append(VectorAssembler(inputCols=parts, outputCol=raw))
    if scale:
        stages.append(StandardScaler(inputCol=raw, outputCol=FEATURES, withMean=centre, withStd=True))
    return Pipeline(stages=stages)


def feature_names(df: DataFrame, numeric: Sequence[str], factors: Sequence[str],
                  features: str = FEATURES) -> list[str]:
    """Readable names of the vector slots, from the column metadata."""
    # the scaler keeps the slots but not their names
    source = "__raw" if features == FEATURES and "__raw" in df.columns else features
    attrs = df.schema[source].metadata.get("ml_attr", {})
    found = {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.get("attrs", {}).values() for a in group}
    out = []
    for i in range(attrs.get("num_attrs", len(found))):
        name = found.get(i, str(i))
        for prefix, source in (("__x", numeric), ("__na", numeric), ("__i", factors), ("__h", factors)):
            head = name.removeprefix(prefix)
            digits = head[:len(head) - len(head.lstrip("0123456789"))]
            if head != name and digits:
                rest = head[len(digits):].removesuffix("_f").strip("_")
                tail = "missing" if prefix == "__na" else rest
                name = source[int(digits)] + ("." + tail if tail else "")
                break
        out.append(name)
    return out


def independent_slots(df: DataFrame, features: str = FEATURES, width: int | None = None) -> list[int] | None:
    """Slots left after removing constant and collinear ones, None when all stay.

    One distributed pass gives the correlation matrix (slots x slots, so its size
    does not depend on the rows); an elimination on it, slot by slot, finds dependencies.
    """
    if width is not None and width > COLLINEAR_WIDTH:
        warnings.warn(f"{width} slots: collinear ones are not looked for beyond {COLLINEAR_WIDTH}", stacklevel=2)
        return None
    return independent_columns(np.nan_to_num(Correlation.corr(df, features).first()[0].toArray(), nan=0.0, copy=False))


def independent_columns(matrix: np.ndarray, least: float = 1e-8) -> list[int] | None:
    """The columns of a correlation matrix that no earlier ones give, None when all are, or none.

    Each kept column adds one factor column; what the factors leave of a column's own entry decides.
    """
    factors = np.zeros_like(matrix)
    kept: list[int] = []
    for j in range(len(matrix)):
        k = len(kept)
        rest = matrix[j:, j] - factors[j:, :k] @ factors[j, :k]
        if rest[0] > least:
            factors[j:, k] = rest / np.sqrt(rest[0])
            kept.append(j)
    return None if len(kept) == len(matrix) or not kept else kept


# --------------------------------------------------------------------------
# estimators
# --------------------------------------------------------------------------

def _share_strategy(rate: float, full: str) -> str:
    return full if rate >= 1 else str(rate)


def _tree_names(params: dict) -> dict:
    known = {"max_depth": "maxDepth", "min_rows": "minInstancesPerNode", "sample_rate": "subsamplingRate",
             "learn_rate": "stepSize"}
    out = {known[k]: v for k, v in params.items() if k in known}
    for k in ("maxDepth", "minInstancesPerNode"):
        if k in out:
            out[k] = int(out[k])
    return out


# Hyper-parameters each algorithm accepts.
ACCEPTED = {
    "LR": {"alpha", "lambda"},
    "GBM": {"ntrees", "max_depth", "learn_rate", "min_rows", "sample_rate",
            "col_sample_rate", "col_sample_rate_per_tree"},
    "RF": {"ntrees", "max_depth", "sample_rate", "min_rows", "col_sample_rate_per_tree"},
    "NB": {"laplace", "min_sdev", "eps_sdev"},
    "DL": {"hidden", "l1", "l2", "input_dropout_ratio"},
    "KM": {"k", "max_iterations", "standardize"},
}


def spark_params(algorithm: str, params: dict, width: int) -> dict:
    """Spark parameter names and values of one combination."""
    unknown = set(params) - ACCEPTED[algorithm]
    if unknown:
        raise ValueError(f"{algorithm} has no hyper-parameters {sorted(unknown)}")
    if algorithm == "LR":
        names = {"alpha": "elasticNetParam", "lambda": "regParam"}
        return {names[k]: float(v) for k, v in params.items()}
    if algorithm == "GBM":
        out = _tree_names(params)
        if "ntrees" in params:
            out["maxIter"] = int(params["ntrees"])
        share = params.get("col_sample_rate", 1) * params.get("col_sample_rate_per_tree", 1)
        return out | {"featureSubsetStrategy": _share_strategy(share, "all")}
    if algorithm == "RF":
        out = _tree_names(params)
        if "ntrees" in params:
            out["numTrees"] = int(params["ntrees"])
        share = params.get("col_sample_rate_per_tree", 1)
        return out | {"featureSubsetStrategy": _share_strategy(share, "auto")}
    if algorithm == "NB":
        return {k: float(v) for k, v in params.items()}
    if algorithm == "DL":
        unavailable = [k for k in ("l1", "l2", "input_dropout_ratio") if params.get(k)]
        if unavailable:
            raise ValueError(f"the neural net does not offer {unavailable}: only 0 is accepted")
        return {"layers": [width, *params.get("hidden", [20, 20]), 2]}
    raise ValueError(f"unknown algorithm {algorithm}")


def _estimator(algorithm: str, label: str, numeric, factors, max_bins: int, width: int) -> Estimator:
    shape = {"featuresCol": FEATURES, "labelCol": label}
    if algorithm == "LR":
        return LogisticRegression(maxIter=50, standardization=True, **shape)
    if algorithm == "GBM":
        return GBTClassifier(seed=1, maxBins=max_bins, **shape)
    if algorithm == "RF":
        return RandomForestClassifier(seed=1, maxBins=max_bins, **shape)
    if algorithm == "DL":
        return MultilayerPerceptronClassifier(seed=1, layers=[width, 20, 20, 2], **shape)
    return MixedNaiveBayes(label=label, numeric=list(numeric), factors=list(factors))


# --------------------------------------------------------------------------
# trained models
# --------------------------------------------------------------------------

_LOADERS = {"LR": LogisticRegressionModel, "GBM": GBTClassificationModel,
            "RF": RandomForestClassificationModel, "DL": MultilayerPerceptronClassificationModel,
            "KM": KMeansModel}


@dataclass
class TrainedModel:
    """A classifier with its features, chosen parameters and label levels."""

    algorithm: str
    numeric: list[str]
    factors: list[str]
    params: dict
    features: PipelineModel | None
    predictor: Model
    levels: tuple[str, str] = ("0", "1")
    threshold: float = 0.5
    trials: list[dict] = field(default_factory=list)

    def score(self, df: DataFrame, name: str = "p1") -> DataFrame:
        """The input columns and the probability of the second level."""
        if self.features is None:
            scored = self.predictor.transform(df)
            return scored if name == "p1" else scored.withColumnRenamed("p1", name)
        out = self.predictor.transform(self.features.transform(df))
        return out.select(*[column(c) for c in df.columns],
                          vector_to_array("probability")[1].alias(name))

    def meta(self) -> dict:
        return {"algorithm": self.algorithm, "numeric": self.numeric, "factors": self.factors,
                "params": self.params, "levels": list(self.levels), "threshold": self.threshold}

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        write_json(spark, path + "/meta", self.meta())
        if self.features is None:
            save_bayes(self.predictor.tables, path + "/bayes", **self.predictor.smoothing())
        else:
            self.features.write().overwrite().save(path + "/features")
            self.predictor.write().overwrite().save(path + "/predictor")


@dataclass
class StackedModel:
    """Base models and a non-negative logistic regression on their scores."""

    bases: list[TrainedModel]
    combiner: LogisticRegressionModel
    levels: tuple[str, str] = ("0", "1")
    threshold: float = 0.5
    algorithm: str = "Stacking"
    params: dict = field(default_factory=dict)

    def _columns(self) -> list[str]:
        return ["__p%d" % i for i in range(len(self.bases))]

    def score(self, df: DataFrame, name: str = "p1") -> DataFrame:
        out = df
        for base, c in zip(self.bases, self._columns()):
            out = base.score(out, c)
        out = self.combiner.transform(_assemble(out, self._columns()))
        return out.select(*[column(c) for c in df.columns],
                          vector_to_array("probability")[1].alias(name))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        write_json(spark, path + "/meta", {"algorithm": "Stacking", "bases": len(self.bases),
                                           "levels": list(self.levels), "threshold": self.threshold})
        for i, base in enumerate(self.bases):
            base.save(f"{path}/base{i}")
        self.combiner.write().overwrite().save(path + "/combiner")


@dataclass
class ClusterModel:
    """K-means with its features."""

    numeric: list[str]
    factors: list[str]
    params: dict
    features: PipelineModel
    predictor: KMeansModel
    algorithm: str = "KM"
    trials: list[dict] = field(default_factory=list)
    iterations: int | None = None  # of the fit; not saved

    def assign(self, df: DataFrame) -> DataFrame:
        """The input columns, ``cluster`` and the squared distance to its centre."""
        out = with_distance(self.predictor.transform(self.features.transform(df)),
                            self.predictor.clusterCenters())
        return out.select(*[column(c) for c in df.columns], F.col("prediction").alias("cluster"), "sq_dist")

    def quality(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(one-row between/within/total sums of squares, per-cluster rows)."""
        return centre_quality(self.predictor, self.features.transform(df))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        write_json(spark, path + "/meta", {"algorithm": "KM", "numeric": self.numeric,
                                           "factors": self.factors, "params": self.params})
        self.features.write().overwrite().save(path + "/features")
        self.predictor.write().overwrite().save(path + "/predictor")


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_model(spark: SparkSession, path: str) -> TrainedModel | StackedModel | ClusterModel:
    meta = read_json(spark, path + "/meta")
    algorithm = meta["algorithm"]
    if algorithm == "Stacking":
        bases = [load_model(spark, f"{path}/base{i}") for i in range(meta["bases"])]
        return StackedModel(bases, LogisticRegressionModel.load(path + "/combiner"),
                            tuple(meta["levels"]), meta["threshold"])
    if algorithm == "NB":
        tables, smoothing = load_bayes(spark, path + "/bayes")
        features, predictor = None, MixedNaiveBayesModel(tables, smoothing)
    else:
        features = PipelineModel.load(path + "/features")
        predictor = _LOADERS[algorithm].load(path + "/predictor")
    if algorithm == "KM":
        return ClusterModel(meta["numeric"], meta["factors"], meta["params"], features, predictor)
    return TrainedModel(algorithm, meta["numeric"], meta["factors"], meta["params"], features,
                        predictor, tuple(meta["levels"]), meta["threshold"])


def predict(model: TrainedModel | StackedModel | ClusterModel, df: DataFrame,
            id_name: str | None = None) -> DataFrame:
    """``[id,] predict, p0, p1`` of a classifier, ``[id,] predict`` of k-means."""
    first = [column(id_name)] if id_name else []
    if isinstance(model, ClusterModel):
        return model.assign(df).select(*first, F.col("cluster").alias("predict"))
    low, high = model.levels
    scored = model.score(df, "__p")
    p = F.col("__p")
    return scored.select(*first, F.when(p >= F.lit(model.threshold), F.lit(high)).otherwise(F.lit(low))
                         .alias("predict"), (1 - p).alias("p0"), p.alias("p1"))


# --------------------------------------------------------------------------
# tuning
# --------------------------------------------------------------------------

def _assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(df)


@dataclass
class _Prepared:
    algorithm: str
    label: str
    numeric: list[str]
    factors: list[str]
    features: PipelineModel | None
    estimator: Estimator
    width: int
    shaped: DataFrame | None = None  # the rows it was made of, where their features are staged already

    def transform(self, df: DataFrame) -> DataFrame:
        if self.features is None:
            return df
        return self.features.transform(df).select(column(self.label), FEATURES)

    def fits(self, df: DataFrame, points: Sequence[dict]):
        """An iterator of (number of the point, model) that threads can share; a model is fitted when drawn."""
        return self.estimator.fitMultiple(df, [self._map(p) for p in points])

    def _map(self, params: dict) -> dict:
        return {self.estimator.getParam(k): v
                for k, v in spark_params(self.algorithm, params, self.width).items()}

    def fit(self, df: DataFrame, params: dict) -> Model:
        return self.estimator.fit(df, self._map(params))


def _prepare(algorithm: str, train: DataFrame, label: str, numeric, factors) -> _Prepared:
    numeric, factors = list(numeric), list(factors)
    if algorithm == "NB":
        est = _estimator("NB", label, numeric, factors, 0, 0)
        return _Prepared("NB", label, numeric, factors, None, est, 0)
    trees = algorithm in ("GBM", "RF")
    features = feature_pipeline(numeric, factors, one_hot=not trees, missing_flags=trees,
                                scale=algorithm == "DL", centre=True).fit(train)
    levels = [len(a) + 1 for s in features.stages if hasattr(s, "labelsArray") for a in s.labelsArray]
    shaped = features.transform(train)
    width = shaped.schema[FEATURES].metadata["ml_attr"]["num_attrs"]
    own = None
    if algorithm == "LR":
        # read by the correlations and by every fit
        own = stage(shaped.select(column(label), FEATURES), "features")
        slots = independent_slots(own, width=width)
        if slots is not None:
            inner = features.stages[-1].setOutputCol("__wide")
            slicer = VectorSlicer(inputCol="__wide", outputCol=FEATURES, indices=slots)
            features = PipelineModel(stages=[*features.stages[:-1], inner, slicer])
            own = slicer.transform(own.withColumnRenamed(FEATURES, "__wide")).select(column(label), FEATURES)
            width = len(slots)
    est = _estimator(algorithm, label, numeric, factors, max([32, *levels]), width)
    return _Prepared(algorithm, label, numeric, factors, features, est, width, own)


def _check(algorithm: str, known: Sequence[str]) -> None:
    if algorithm not in known:
        raise ValueError(f"unknown algorithm {algorithm}, known are {', '.join(known)}")


@dataclass
class TrainingResult:
    """The best model, the scored evaluation rows and their kind."""

    model: TrainedModel | StackedModel | ClusterModel
    evaluation: DataFrame | None      # y, p1 (and fold for cross-validation)
    kind: str                         # "xval" or "valid"
    folds: int
    holdout: DataFrame | None = None
    train: DataFrame | None = None
    quality: DataFrame | None = None   # k-means: sums of squares by set
    clusters: DataFrame | None = None  # k-means: sizes by set, fold and cluster


def train_classifier(df: DataFrame, label: str, numeric: Sequence[str], factors: Sequence[str],
                     algorithm: str, keys: Sequence[str], hparams: dict | None = None,
                     cv_k: int | None = None, levels: tuple[str, str] = ("0", "1")) -> TrainingResult:
    """Grid search by exact AUC with k folds, or on a 70/30 holdout when ``cv_k`` is below 2.

    No (point, fold) pair is fitted twice: the winner's evaluation rows are the out-of-fold scores that
    ranked it. The winner of a cross-validation is fitted once more, on all rows with features of all rows.
    """
    _check(algorithm, CLASSIFIERS)
    used = dict.fromkeys([*numeric, *factors, label, *keys])
    known = df.select(*[column(c) for c in used])
    if cv_k is not None and cv_k >= 2:
        known = known.withColumn(FOLD, modulo_fold(keys, cv_k))  # hashed once, read by all folds
    whole = stage(known, "train")
    rows = whole.count()
    folds = default_folds(algorithm, rows) if cv_k is None else cv_k
    points = combinations(hparams or default_grid(algorithm, rows))

    def prepare(part: DataFrame) -> _Prepared:
        return _prepare(algorithm, part, label, numeric, factors)

    if folds >= 2:
        train, valid, kind = whole, None, "xval"
        fits = fit_folds(fold_splits(whole, keys, folds), prepare, points, label, whole)
    else:
        (train, valid), kind = holdout(whole, keys), "valid"
        fits = fit_folds([(train, valid)], prepare, points, label)
    best = fits.best
    if kind == "xval":
        prepared, shaped = fits.whole
        predictor = prepared.fit(shaped, points[best])
    else:
        prepared, predictor = fits.prepared[0], fits.models[best, 0]
    model = TrainedModel(algorithm, list(numeric), list(factors), points[best], prepared.features, predictor, levels,
                         trials=[dict(p, auc=a) for p, a in zip(points, fits.auc)])
    evaluation = fits.evaluation(best)
    return TrainingResult(model, evaluation if kind == "xval" else evaluation.drop("fold"), kind, folds, valid,
                          train.drop(FOLD))


def fold_splits(rows: DataFrame, keys: Sequence[str], folds: int) -> list[tuple[DataFrame, DataFrame]]:
    """(the other folds' rows, the fold's rows) for each fold of the keys' hash, or of the stored fold."""
    own = F.col(FOLD) if FOLD in rows.columns else modulo_fold(keys, folds)
    return [(rows.where(own != k), rows.where(own == k)) for k in range(folds)]


def train_stacking(df: DataFrame, label: str, numeric: Sequence[str], factors: Sequence[str],
                   bases: dict[str, dict | None], keys: Sequence[str], cv_k: int | None = None,
                   levels: tuple[str, str] = ("0", "1")) -> TrainingResult:
    """Tune each base with k folds, combine their out-of-fold scores, judge on a holdout.

    The level-one rows are scored by the models that the folds' loop has fitted already.
    """
    for algorithm in bases:
        _check(algorithm, CLASSIFIERS)
    if not bases:
        raise ValueError("stacking needs at least one base algorithm")
    used = list(dict.fromkeys([*numeric, *factors, label, *keys]))
    train, valid = holdout(stage(df.select(*[column(c) for c in used]), "train"), keys)
    rows = train.count()
    folds = cv_k if cv_k and cv_k >= 2 else max(2, *[default_folds(a, rows) for a in bases], 2)
    splits = fold_splits(train, keys, folds)

    models: list[TrainedModel] = []
    fitted: list[tuple[FoldFits, int]] = []
    for algorithm, grid in bases.items():
        def prepare(part: DataFrame, algorithm: str = algorithm) -> _Prepared:
            return _prepare(algorithm, part, label, numeric, factors)

        points = combinations(grid or default_grid(algorithm, rows))
        fits = fit_folds(splits, prepare, points, label, train)
        prepared, shaped = fits.whole
        models.append(TrainedModel(algorithm, list(numeric), list(factors), points[fits.best], prepared.features,
                                   prepared.fit(shaped, points[fits.best]), levels))
        fitted.append((fits, fits.best))

    names = ["__p%d" % i for i in range(len(models))]
    out = None
    for k, (_, fold) in enumerate(splits):
        # every base scores the rows of the fold in turn, so no join brings them together
        for (fits, best), base, name in zip(fitted, models, names):
            fold = TrainedModel(base.algorithm, base.numeric, base.factors, base.params,
                                fits.prepared[k].features, fits.models[best, k]).score(fold, name)
        fold = fold.select(column(label), *names)
        out = fold if out is None else out.unionByName(fold)
    level_one = _assemble(stage(out, "levelone"), names)
    floor = Matrices.dense(1, len(names), [0.0] * len(names))
    combiner = LogisticRegression(featuresCol=FEATURES, labelCol=label,
                                  lowerBoundsOnCoefficients=floor).fit(level_one)
    model = StackedModel(models, combiner, levels)
    evaluation = model.score(valid).select(column(label).alias("y"), "p1")
    return TrainingResult(model, evaluation, "valid", folds, valid, train)


# --------------------------------------------------------------------------
# k-means
# --------------------------------------------------------------------------

def with_distance(assigned: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Add the squared distance of each row to the centre of its cluster."""
    # the centres are model parameters
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    own = F.element_at(table, F.col("prediction") + 1)
    gaps = F.zip_with(vector_to_array(FEATURES), own, lambda a, b: (a - b) * (a - b))
    return assigned.withColumn("sq_dist", F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g))


def centre_quality(predictor: KMeansModel, shaped: DataFrame) -> tuple[DataFrame, DataFrame]:
    assigned = with_distance(predictor.transform(shaped), predictor.clusterCenters())
    spread = F.col("s.variance")
    totals = (assigned.agg(F.sum("sq_dist").alias("tot_withinss"),
                           Summarizer.metrics("variance", "count").summary(F.col(FEATURES)).alias("s"))
              .select("tot_withinss", F.aggregate(
                  vector_to_array(spread), F.lit(0.0), lambda s, v: s + v).alias("v"),
                  (F.col("s.count") - 1).alias("df"))
              .select((F.col("v") * F.col("df")).alias("totss"), "tot_withinss",
                      (F.col("v") * F.col("df") - F.col("tot_withinss")).alias("betweenss")))
    per = assigned.groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"), F.sum("sq_dist").alias("withinss"))
    return totals, per


def train_kmeans(df: DataFrame, numeric: Sequence[str], factors: Sequence[str], keys: Sequence[str],
                 hparams: dict | None = None, cv_k: int | None = None) -> TrainingResult:
    """Grid search by the between-cluster sum of squares on held-out rows.

    Sums of squares can be compared only on one scale, so each scaling has one feature pipeline, fitted on all
    training rows, and one staged feature table with the number of the fold. All (point, fold) models of a table
    are fitted in the same passes over it and judged by one. The result holds the winner's totals and clusters
    of the sets ``train`` and ``xval`` or ``valid``.
    """
    used = list(dict.fromkeys([*numeric, *factors, *keys]))
    part = "__part"
    known = df.select(*[column(c) for c in used])
    rows = None
    if cv_k is None or hparams is None:
        known = stage(known, "train")
        rows = known.count()
    folds = default_folds("KM", rows) if cv_k is None else cv_k
    points = combinations(hparams or default_grid("KM", rows))
    for p in points:
        unknown = set(p) - ACCEPTED["KM"]
        if unknown:
            raise ValueError(f"KM has no hyper-parameters {sorted(unknown)}")
    crossed = folds >= 2
    number = modulo_fold(keys, folds) if crossed else F.when(hash_share(keys, "split:1") < F.lit(0.7), 0).otherwise(1)
    whole = stage(known.withColumn(part, number.cast("int")), "train")
    train = whole if crossed else whole.where(F.col(part) == 0)

    def scaled(p: dict) -> bool:
        return bool(p.get("standardize", True))

    def shape(scale: bool) -> tuple[PipelineModel, DataFrame]:
        made = feature_pipeline(numeric, factors, one_hot=True, missing_flags=False, scale=scale, centre=True).fit(train)
        return made, stage(pack(made.transform(whole), FEATURES, part), "features")

    scalings = sorted({scaled(p) for p in points})
    shapes = dict(zip(scalings, in_parallel([lambda s=s: shape(s) for s in scalings])))

    def fit(models: Sequence[tuple[int, int | None]]) -> dict:
        """Centres of (point, part that is left out), all models of a scaling in the same passes."""
        out = {}
        for s, (_, table) in shapes.items():
            chosen = [(i, k) for i, k in models if scaled(points[i]) == s]
            wanted = [Wanted(frozenset(range(folds if crossed else 2)) - {k}, int(points[i].get("k", 3)),
                             int(points[i].get("max_iterations", 20))) for i, k in chosen]
            out |= dict(zip(chosen, fit_centres(table, FEATURES, part, wanted))) if chosen else {}
        return out

    # the parts that are held out in turn; on a holdout part 1 alone
    held = range(folds) if crossed else [1]
    pairs = [(i, k) for i in range(len(points)) for k in held]
    fitted = fit(pairs)
    kind = "xval" if crossed else "valid"
    totals, clusters = None, None
    for s, (_, table) in shapes.items():
        judged = [(k, kind, i, k if crossed else 0, fitted[i, k].centres) for i, k in pairs if scaled(points[i]) == s]
        t, c = quality_by_set(table, FEATURES, part, judged)
        totals, clusters = (t, c) if totals is None else (totals.unionByName(t), clusters.unionByName(c))
    totals = stage(totals, "quality")
    between = {r["model"]: r["betweenss"] for r in totals.collect()}
    scores = [between.get(i) for i in range(len(points))]
    best = int(np.argmax([-np.inf if b is None else b for b in scores]))
    features, table = shapes[scaled(points[best])]
    won = fit([(best, None)])[best, None] if crossed else fitted[best, 1]
    predictor = centres_model(table, FEATURES, won.centres, int(points[best].get("k", 3)))
    centres = predictor.clusterCenters()
    own, per = quality_by_set(table, FEATURES, part, [(k, "train", best, 0, centres) for k in (held if crossed else [0])])
    winner = F.col("model") == best
    model = ClusterModel(list(numeric), list(factors), points[best], features, predictor,
                         trials=[dict(p, betweenss=None if b is None else b / len(held)) for p, b in zip(points, scores)],
                         iterations=won.iterations)
    sides = [whole.where(F.col(part) == 1).drop(part), train.drop(part)]
    return TrainingResult(model, None, kind, folds, None if crossed else sides[0], sides[1],
                          quality=own.unionByName(totals.where(winner)).drop("model"),
                          clusters=per.unionByName(clusters.where(winner)).drop("model"))
