"""One Spark query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import new_path, stage
from scoreloom.operators import (
    audit, bayes, clean, cluster, combine, describe, profile, quantile, sample, score, training, woe)
from scoreloom.plans import act as act_plan
from scoreloom.plans import evaluate as evaluate_plan
from scoreloom.plans import learn as learn_plan
from scoreloom.plans.config import LearnConfig
from scoreloom.sources import artifacts, delimited, tables
from verification.fixtures import (
    CREDIT_FACTORS, CREDIT_NUMERIC, CREDIT_VARIABLES, LINE_FACTORS, LINE_KEYS, LINE_NUMERIC,
    coded_events, credit, credit_missing, labelled_documents, lines, scored, strong_lines, table)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6, names: Sequence[str] | None = None) -> DataFrame:
    """Round the doubles, since summation order differs between engines."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    chosen = [c for c in doubles if names is None or c in names]
    return df.withColumns({c: F.round(column(c), digits) + F.lit(0.0) for c in chosen}) if chosen else df


def flagged(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    return (first.select(key, F.lit("first").alias("part"))
            .unionByName(second.select(key, F.lit("second").alias("part"))))


# ---- audits ---------------------------------------------------------------

@query
def audit_id(spark, d):
    return audit.audit_id(table(spark, d, "orders"), "o_orderkey")


@query
def audit_id_repeated(spark, d):
    return audit.audit_id(table(spark, d, "lineitem"), "l_orderkey")


@query
def audit_label(spark, d):
    documents = table(spark, d, "documents").select("doc_id")
    return audit.audit_label(documents.join(table(spark, d, "labels"), "doc_id", "left"), "quality")


@query
def audit_volume(spark, d):
    return audit.audit_volume(table(spark, d, "orders"), "o_orderkey", "o_orderpriority")


@query
def audit_dictionary(spark, d):
    rows = table(spark, d, "part").select(F.col("p_name").alias("variable"), F.col("p_type").alias("type"))
    return audit.audit_dictionary(delimited.resolve_aliases(rows, ["standard", "large"], ["small"]))


@query
def audit_columns(spark, d):
    part = table(spark, d, "part")
    wide = part.select(F.col("p_size").alias("large"), F.col("p_retailprice").alias("promo"), "p_brand")
    return audit.audit_columns(wide, part.select(F.lower("p_type").alias("variable")))


# ---- sources --------------------------------------------------------------

@query
def typed_columns(spark, d):
    types = {"c_mktsegment": "factor", "c_nationkey": "factor", "c_custkey": "numeric",
             "c_acctbal": "numeric", "c_name": "numeric"}
    table(spark, d, "customer").createOrReplaceTempView("customer_to_type")
    return tables.as_declared(tables.read_table(spark, "customer_to_type"), types)


def _as_text(df: DataFrame) -> DataFrame:
    """Text cells; a NULL takes one of the missing spellings, by row."""
    spellings = F.array(*[F.lit(s) for s in delimited.MISSING_SPELLINGS if s])
    pick = (F.col("o_orderkey") % F.size(spellings)).cast("int") + 1
    return df.select(*[F.coalesce(column(c).cast("string"), F.element_at(spellings, pick)).alias(c)
                       for c in df.columns])


CSV_TYPES = {"o_orderkey": "numeric", "o_totalprice": "numeric", "c_acctbal": "numeric",
             "o_orderstatus": "factor"}


@query
def csv_import_na(spark, d):
    path = new_path(spark, "csv")
    _as_text(credit_missing(spark, d)).write.option("header", True).csv(path)
    return delimited.read_declared(spark, path, CSV_TYPES)


@query
def csv_import_no_header(spark, d):
    path = new_path(spark, "csv")
    _as_text(credit_missing(spark, d).select(*CSV_TYPES)).write.option("sep", ";").csv(path)
    return delimited.read_declared(spark, path, CSV_TYPES, sep=";", header=False)


@query
def csv_import_inferred(spark, d):
    path = new_path(spark, "csv")
    _as_text(credit_missing(spark, d).select(*CSV_TYPES)).write.option("header", True).csv(path)
    return delimited.read_inferred(spark, path)[0]


@query
def dictionary_import(spark, d):
    """A dictionary file made from the distinct part names, read back and resolved."""
    path = new_path(spark, "dictionary")
    kind = (F.when(F.col("t") == "STANDARD", "date").when(F.col("t") == "SMALL", "String")
            .when(F.col("t") == "LARGE", "factor").otherwise("int"))
    names = table(spark, d, "part").groupBy(F.col("p_name").alias("variable")).agg(F.min("p_type").alias("t"))
    names.select("variable", kind.alias("type")).coalesce(1).write.option("header", True).csv(path)
    types = delimited.read_dictionary(spark, path, ["int", "double"], ["string", "char"])
    return spark.createDataFrame(list(types.items()), "variable string, type string")


@query
def table_export(spark, d):
    path = new_path(spark, "export")
    table(spark, d, "customer").createOrReplaceTempView("customer_to_export")
    tables.export_csv(spark, "customer_to_export", path)
    return spark.read.option("header", True).csv(path).select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query
def report_json_and_text(spark, d):
    """The JSON and text sinks, read back."""
    counts = profile.label_counts(table(spark, d, "orders"), "o_orderpriority")
    path = new_path(spark, "report")
    artifacts.write_json_rows(counts, path + "/counts.json")
    artifacts.write_report(counts.select(F.lit("labels").alias("section"), F.col("label").alias("key"),
                                         F.col("n").cast("string").alias("value")), path + "/report.txt")
    back = spark.read.schema("label string, n bigint").json(path + "/counts.json")
    lines_back = spark.read.text(path + "/report.txt")
    return back.join(lines_back, F.col("value") == F.concat(
        F.lit("labels\t"), "label", F.lit("\t"), F.col("n").cast("string"))).select("label", "n", "value")


# ---- profiles -------------------------------------------------------------

@query
def numeric_profile(spark, d):
    whole = profile.numeric_profile(lines(spark, d), LINE_NUMERIC)
    return rounded(whole.unionByName(profile.numeric_profile(credit_missing(spark, d), CREDIT_NUMERIC)), 4)


@query
def profile_auto_sample(spark, d):
    rows = profile.profile_input(table(spark, d, "lineitem"), "auto", LINE_KEYS)
    return rounded(profile.numeric_profile(rows, LINE_NUMERIC), 4)


@query
def factor_profile(spark, d):
    return profile.factor_profile(credit_missing(spark, d), CREDIT_FACTORS)


@query
def level_counts(spark, d):
    return profile.level_counts(credit_missing(spark, d), CREDIT_FACTORS)


@query
def label_counts(spark, d):
    documents = table(spark, d, "documents").select("doc_id")
    return profile.label_counts(documents.join(table(spark, d, "labels"), "doc_id", "left"), "quality")


@query
def row_missing(spark, d):
    return profile.row_missing(credit_missing(spark, d), CREDIT_VARIABLES).select("o_orderkey", "n_missing")


@query
def column_missing(spark, d):
    return profile.column_missing(credit_missing(spark, d), CREDIT_VARIABLES)


@query
def column_std(spark, d):
    return rounded(profile.column_std(credit_missing(spark, d), CREDIT_NUMERIC), 4)


@query
def level_domain(spark, d):
    return profile.level_domain(credit_missing(spark, d), CREDIT_FACTORS)


# ---- cleaning -------------------------------------------------------------

@query
def drop_sparse_rows(spark, d):
    return clean.drop_sparse_rows(credit_missing(spark, d), CREDIT_VARIABLES, 0.3).select(*CREDIT_VARIABLES,
                                                                                          "o_orderkey")


@query
def droppable_variables(spark, d):
    df = lines(spark, d).withColumns({
        "same_text": F.lit("x"), "same_number": F.lit(1.0),
        "mostly_null": F.when(F.col("l_linenumber") == 1, F.col("l_tax")),
        "null_factor": F.when(F.col("l_orderkey") < 0, F.col("l_returnflag"))})
    factors = ["l_linestatus", "l_orderkey", "same_text", "null_factor"]
    numeric = profile.numeric_profile(df, ["l_quantity", "same_number", "mostly_null"])
    return clean.droppable_variables(numeric, profile.factor_profile(df, factors), df.count(),
                                     max_levels=0.01, max_missing_share=0.8)


@query
def drop_named_variables(spark, d):
    return clean.drop_variables(table(spark, d, "customer"), ["c_name", "c_acctbal", "absent"])


@query
def fill_missing(spark, d):
    return clean.fill_missing(credit_missing(spark, d), {"c_acctbal": -1, "o_orderstatus": "none"})


@query
def learned_fill(spark, d):
    df = credit_missing(spark, d)
    fill = clean.learned_fill(profile.numeric_profile(df, CREDIT_NUMERIC),
                              profile.factor_profile(df, CREDIT_FACTORS))
    number = F.col("fill_value").try_cast("double")
    return fill.select("variable", F.round(F.when(F.col("variable").isin(*CREDIT_NUMERIC), number), 4)
                       .alias("fill_number"),
                       F.when(~F.col("variable").isin(*CREDIT_NUMERIC), F.col("fill_value")).alias("fill_text"))


@query
def as_categories(spark, d):
    df = table(spark, d, "labels").withColumn("quality", F.col("quality").cast("double"))
    return clean.as_categories(df, "doc_id", "quality").select("doc_id", "quality")


@query
def keep_columns(spark, d):
    return clean.keep_columns(table(spark, d, "part"), ["p_brand", "p_partkey"])


@query
def rows_with_level(spark, d):
    return clean.rows_with_level(table(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey")


# ---- sampling -------------------------------------------------------------

@query
def ratio_split(spark, d):
    return flagged(*sample.split_by_share(table(spark, d, "orders"), 0.25, ["o_orderkey"]), "o_orderkey")


@query
def holdout_split(spark, d):
    return flagged(*sample.holdout(table(spark, d, "orders"), ["o_orderkey"]), "o_orderkey")


@query
def stratified_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return flagged(*sample.stratified_split(orders, 0.3, "o_orderstatus", ["o_orderkey"]), "o_orderkey")


@query
def sample_share(spark, d):
    return sample.sample_share(table(spark, d, "lineitem"), 0.1, LINE_KEYS).select(*LINE_KEYS, "l_quantity")


@query
def sample_n(spark, d):
    return sample.sample_n(table(spark, d, "lineitem").select(*LINE_KEYS, "l_quantity"), 5000, LINE_KEYS)


@query
def under_sample(spark, d):
    return sample.under_sample(labelled_documents(spark, d), "quality", 2, ["doc_id"])


@query
def modulo_folds(spark, d):
    return table(spark, d, "orders").select("o_orderkey", sample.modulo_fold(["o_orderkey"], 5).alias("fold"))


# ---- joins ----------------------------------------------------------------

@query
def join_left(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang")
    right = table(spark, d, "labels").withColumnRenamed("doc_id", "labelled")
    return combine.merge(documents, right, ["doc_id"], ["labelled"], left_all=True, right_all=False)


@query
def join_right(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang")
    return combine.merge(table(spark, d, "labels"), documents, ["doc_id"], left_all=False, right_all=True)


@query
def join_inner(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    right = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return combine.merge(orders, right, ["o_custkey"], ["c_custkey"], left_all=False, right_all=False)


@query
def join_full(spark, d):
    items = table(spark, d, "lineitem")
    left = items.where("l_quantity > 45").groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_large"))
    right = items.where("l_discount > 0.09").groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_cheap"))
    return combine.merge(left, right, ["l_partkey", "l_suppkey"])


@query
def join_full_tables(spark, d):
    """Every lineitem and every event, by numbers of which either side lacks some; each side is aggregated once."""
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_items"))
    events = table(spark, d, "events").groupBy("event_id").agg(F.count(F.lit(1)).alias("n_events"))
    return combine.merge(stage(items), stage(events), ["l_orderkey"], ["event_id"])


@query
def lookup_join(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderkey")
    return combine.lookup(table(spark, d, "customer").select("c_custkey", "c_name"), orders,
                          ["c_custkey"], ["o_custkey"], ["o_totalprice"])


@query
def union_widen(spark, d):
    first = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("v"))
    second = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"),
                                                F.col("s_name").alias("name"))
    return combine.union_rows(first, second)


# ---- binning, WOE, IV -----------------------------------------------------

@query
def quantile_breaks(spark, d):
    whole = quantile.quantile_breaks(lines(spark, d), LINE_NUMERIC)
    return rounded(whole.unionByName(quantile.quantile_breaks(credit_missing(spark, d), CREDIT_NUMERIC)), 4)


@query
def quantile_bins(spark, d):
    df = credit_missing(spark, d).select("o_orderkey", *CREDIT_NUMERIC)
    return woe.quantile_bins(df, CREDIT_NUMERIC)


@query
def label_to_binary(spark, d):
    df = woe.label_to_binary(table(spark, d, "lineitem"), "l_linestatus")
    return df.groupBy("l_linestatus", "y").agg(F.count(F.lit(1)).alias("n"))


def _credit_woe(spark, d) -> DataFrame:
    df = stage(credit_missing(spark, d))  # one join for the three passes
    breaks = quantile.breaks_by_column(quantile.quantile_breaks(df, CREDIT_NUMERIC))
    return woe.woe_table(woe.bin_counts(df, "y", CREDIT_FACTORS, breaks))


STRONG_FACTORS = ["l_linenumber", "l_suppkey"]


def _strong_woe(spark, d) -> DataFrame:
    df = strong_lines(spark, d)
    breaks = quantile.breaks_by_column(quantile.quantile_breaks(df, LINE_NUMERIC))
    return woe.woe_table(woe.bin_counts(df, "y", STRONG_FACTORS, breaks))


@query
def woe_table(spark, d):
    return rounded(_credit_woe(spark, d))


@query
def adjacent_chi2(spark, d):
    df = strong_lines(spark, d)
    breaks = quantile.breaks_by_column(quantile.quantile_breaks(df, LINE_NUMERIC))
    return rounded(woe.adjacent_chi2(woe.bin_counts(df, "y", (), breaks)), 4, ["chi2"])


@query
def chi_merge(spark, d):
    return rounded(woe.chi_merge(_credit_woe(spark, d)))


@query
def chi_merge_strong(spark, d):
    return rounded(woe.chi_merge(_strong_woe(spark, d)))


@query
def merge_groups_streamed(spark, d):
    """The walk in slices, as for variables with very many levels, forced on all variables."""
    return woe.merge_groups(stage(_strong_woe(spark, d)), slice_bins=12).select("variable", "bin", "group")


@query
def woe_order(spark, d):
    factors = woe.woe_table(woe.bin_counts(strong_lines(spark, d), "y", STRONG_FACTORS))
    return rounded(woe.woe_order(factors).select("variable", "bin", "rank", "woe"))


@query
def iv_table(spark, d):
    df = stage(credit_missing(spark, d))  # one join for the three passes
    return rounded(woe.iv_analysis(df, "y", CREDIT_NUMERIC, CREDIT_FACTORS)[0])


@query
def iv_table_strong(spark, d):
    return rounded(woe.iv_analysis(strong_lines(spark, d), "y", LINE_NUMERIC, STRONG_FACTORS)[0])


@query
def woe_values(spark, d):
    merged = woe.iv_analysis(strong_lines(spark, d), "y", LINE_NUMERIC, STRONG_FACTORS)[1]
    return rounded(woe.woe_values(merged))


@query
def woe_levels(spark, d):
    """The WOE list with one row per original bin."""
    groups = woe.binned_groups(strong_lines(spark, d), "y", LINE_NUMERIC, STRONG_FACTORS)
    return rounded(woe.merged_levels(groups))


@query
def woe_level_code(spark, d):
    return rounded(woe.level_codes(coded_events(spark, d), "y", ["user_id"]))


@query
def reduce_levels(spark, d):
    df = coded_events(spark, d)
    numbers = {r["variable"]: r["level_num"] for r in profile.factor_profile(df, ["user_id"]).collect()}
    return woe.reduce_levels(df, "y", ["user_id"], numbers, max_levels=100)[0].select("event_id", "user_id")


# ---- scores ---------------------------------------------------------------

def _steps(spark, d) -> DataFrame:
    return score.score_steps(score.score_counts(scored(spark, d)))


def _grid(spark, d) -> DataFrame:
    return score.threshold_grid(score.score_counts(scored(spark, d)))


@query
def score_histogram(spark, d):
    return rounded(score.score_histogram(scored(spark, d)))


@query
def threshold_grid(spark, d):
    return _grid(spark, d)


@query
def threshold_rates(spark, d):
    return rounded(score.threshold_rates(_grid(spark, d)))


@query
def ks_grid(spark, d):
    return rounded(score.ks_on_grid(_grid(spark, d)))


@query
def ks_exact(spark, d):
    return rounded(score.ks_exact(_steps(spark, d)))


@query
def ks_thinned(spark, d):
    return rounded(score.thinned_steps(_steps(spark, d)).select(
        "idx", "threshold", "tps", "fps", "tns", "fns", "tpr_fpr"))


@query
def confusion_at(spark, d):
    return rounded(score.confusion_at(_grid(spark, d)))


@query
def score_group(spark, d):
    return rounded(score.score_groups(_grid(spark, d)))


@query
def top_n(spark, d):
    return rounded(score.top_n(_steps(spark, d)))


@query
def gains_lift(spark, d):
    return rounded(score.gains_lift(_steps(spark, d)))


@query
def best_thresholds(spark, d):
    return rounded(score.best_thresholds(_steps(spark, d)))


@query
def max_criteria(spark, d):
    return rounded(score.max_criteria(_steps(spark, d)))


@query
def overall_metrics(spark, d):
    return rounded(score.overall_metrics(_steps(spark, d)))


@query
def metric_sets(spark, d):
    """The same metrics per set of a split."""
    share = sample.hash_share(LINE_KEYS, "split:1")
    split = scored(spark, d).withColumn("split", F.when(share < 0.7, F.lit("train")).otherwise(F.lit("valid")))
    out = None
    for which in ("train", "valid"):
        steps = score.score_steps(score.score_counts(score.metric_set(split, which)))
        one = score.overall_metrics(steps).select(F.lit(which).alias("split"), "nobs", "mse", "logloss", "auc")
        out = one if out is None else out.unionByName(one)
    return rounded(out)


@query
def nb_score(spark, d):
    df = credit_missing(spark, d)
    model = bayes.bayes_tables(df, "y", CREDIT_NUMERIC, CREDIT_FACTORS)
    return rounded(bayes.bayes_score(df, model, laplace=1.0).select("o_orderkey", "p1"))


@query
def nb_score_unsmoothed(spark, d):
    moved = (F.col("y") == 1) & (F.col("c_mktsegment") == "BUILDING")
    df = credit_missing(spark, d).withColumn(
        "c_mktsegment", F.when(moved, "MACHINERY").otherwise(F.col("c_mktsegment")))
    model = bayes.bayes_tables(df, "y", CREDIT_NUMERIC, CREDIT_FACTORS)
    return rounded(bayes.bayes_score(df, model, laplace=0.0).select("o_orderkey", "p1"))


def _centres(spark, d) -> list[list[float]]:
    """Seven centres from the data: one per line number."""
    rows = table(spark, d, "lineitem").groupBy("l_linenumber").agg(
        *[F.round(F.avg(c), 4).alias(c) for c in LINE_NUMERIC]).orderBy("l_linenumber").collect()
    return [[r[c] + i for c in LINE_NUMERIC] for i, r in enumerate(rows)]


@query
def cluster_assign(spark, d):
    assigned = cluster.assign(table(spark, d, "lineitem"), LINE_NUMERIC, _centres(spark, d))
    return rounded(assigned.select(*LINE_KEYS, "l_quantity", "cluster", "sq_dist"), 2)


@query
def cluster_quality(spark, d):
    assigned = cluster.assign(table(spark, d, "lineitem"), LINE_NUMERIC, _centres(spark, d))
    per = cluster.cluster_quality(assigned, LINE_NUMERIC)[1]
    return rounded(rounded(per.withColumn("withinss", F.col("withinss") / F.lit(1e9)), 3, ["withinss"]),
                   1, ["mean_" + c for c in LINE_NUMERIC])


@query
def cluster_totals(spark, d):
    assigned = cluster.assign(table(spark, d, "lineitem"), LINE_NUMERIC, _centres(spark, d))
    totals = cluster.cluster_quality(assigned, LINE_NUMERIC)[0]
    scale = F.lit(1e9)
    return rounded(totals.select(*[(F.col(c) / scale).alias(c) for c in totals.columns]), 3)


# ---- training, descriptions, plans ---------------------------------------

def _train(spark, d, algorithm: str, grid: dict, cv_k: int) -> training.TrainingResult:
    df = credit_missing(spark, d).withColumn(
        "y", ((F.col("o_totalprice") > 250000) | (F.col("c_nationkey") % 5 == 0)).cast("int"))
    return training.train_classifier(df, "y", CREDIT_NUMERIC, CREDIT_FACTORS, algorithm,
                                     ["o_orderkey"], grid, cv_k)


def _metrics(result: training.TrainingResult) -> DataFrame:
    steps = score.score_steps(score.score_counts(result.evaluation))
    return score.overall_metrics(steps, describe.fitted_parameters(result.model))


@query
def metrics_by_line(spark, d):
    """The metrics of several groups of scored rows from one pass."""
    found = score.metrics_by(scored(spark, d), ["l_linenumber"])
    return rounded(found.select("l_linenumber", "nobs", "mse", "r2", "auc"))


@query
def train_lr(spark, d):
    return _metrics(_train(spark, d, "LR", {"alpha": [0, 1], "lambda": [0, 0.1]}, 2))


@query
def train_lr_folds(spark, d):
    """Rows, positives and scored rows of each fold that the grid search judged on."""
    result = _train(spark, d, "LR", {"alpha": [0, 1], "lambda": [0.1]}, 3)
    return result.evaluation.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("positives"),
        F.count_if(F.col("p1").between(0, 1)).alias("scored"))


@query
def train_holdout(spark, d):
    """Rows and positives of the two sides of the 70/30 holdout, as trained and as judged."""
    result = _train(spark, d, "NB", {"laplace": [1]}, 1)
    judged = result.evaluation.select(F.lit("judged").alias("side"), "y")
    return judged.unionByName(result.train.select(F.lit("trained").alias("side"), "y")).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("positives"))


@query
def train_gbm(spark, d):
    return _metrics(_train(spark, d, "GBM", {"ntrees": [10], "max_depth": [3, 5], "learn_rate": [0.1],
                                             "min_rows": [5], "sample_rate": [0.8],
                                             "col_sample_rate_per_tree": [0.8]}, 1))


@query
def train_rf(spark, d):
    return _metrics(_train(spark, d, "RF", {"ntrees": [20], "max_depth": [5, 8], "sample_rate": [0.6],
                                            "min_rows": [5]}, 1))


@query
def train_nb(spark, d):
    return _metrics(_train(spark, d, "NB", {"laplace": [0.1, 1], "min_sdev": [0.001], "eps_sdev": [0]}, 2))


@query
def train_mlp(spark, d):
    return _metrics(_train(spark, d, "DL", {"hidden": [[10, 10]]}, 1))


@query
def train_stacking(spark, d):
    df = credit_missing(spark, d).withColumn(
        "y", ((F.col("o_totalprice") > 250000) | (F.col("c_nationkey") % 5 == 0)).cast("int"))
    bases = {"LR": {"alpha": [0], "lambda": [0.01]}, "NB": {"laplace": [1]},
             "RF": {"ntrees": [10], "max_depth": [5]}}
    return _metrics(training.train_stacking(df, "y", CREDIT_NUMERIC, CREDIT_FACTORS, bases,
                                            ["o_orderkey"], 2))


@query
def train_kmeans(spark, d):
    df = table(spark, d, "lineitem").select(*LINE_NUMERIC, *LINE_KEYS)
    result = training.train_kmeans(df, LINE_NUMERIC, [], LINE_KEYS,
                                   {"k": [3, 5], "max_iterations": [5], "standardize": [True]}, 1)
    return result.model.quality(df)[1]


@query
def kmeans_properties(spark, d):
    df = table(spark, d, "lineitem").select(*LINE_NUMERIC, *LINE_KEYS)
    result = training.train_kmeans(df, LINE_NUMERIC, [], LINE_KEYS,
                                   {"k": [3], "max_iterations": [5], "standardize": [True]}, 1)
    return describe.cluster_centres(result.model, df)


def _line_parts(spark, d) -> DataFrame:
    """Line items as vectors, with the fold of the row."""
    return training._assemble(table(spark, d, "lineitem").withColumn("part", sample.modulo_fold(LINE_KEYS, 3)), LINE_NUMERIC)


def _judged(spark, d) -> list:
    """A model of seven given centres for all rows, and one less centre a fold for its own rows."""
    centres = _centres(spark, d)
    return [(k, "train", 0, 0, centres) for k in range(3)] + [(k, "xval", 0, k, centres[:7 - k]) for k in range(3)]


@query
def cluster_sets(spark, d):
    """Sizes and sums of squares of each cluster of several models, by set and fold."""
    per = cluster.quality_by_set(_line_parts(spark, d), training.FEATURES, "part", _judged(spark, d))[1]
    return rounded(per.select("set", "fold", "cluster", "size", (F.col("withinss") / F.lit(1e9)).alias("withinss")), 3)


@query
def cluster_set_totals(spark, d):
    totals = cluster.quality_by_set(_line_parts(spark, d), training.FEATURES, "part", _judged(spark, d))[0]
    sums = [(F.col(c) / F.lit(1e9)).alias(c) for c in ("totss", "tot_withinss", "betweenss")]
    return rounded(totals.select("set", "size", *sums), 3)


def _kmeans_sets(spark, d, folds: int) -> DataFrame:
    df = table(spark, d, "lineitem").select(*LINE_NUMERIC, *LINE_KEYS)
    result = training.train_kmeans(df, LINE_NUMERIC, [], LINE_KEYS,
                                   {"k": [3, 5], "max_iterations": [5], "standardize": [True]}, folds)
    sizes = result.clusters.groupBy("set").agg(F.sum("size").alias("in_clusters"), F.sum("withinss").alias("within"))
    close = F.abs(F.col("within") - F.col("tot_withinss")) <= F.lit(1e-6) * F.col("totss")
    return result.quality.join(sizes, "set").select(
        F.concat(F.lit(f"{folds} "), F.col("set")).alias("set"), "size", "in_clusters",
        F.round(F.col("totss") / F.col("size"), 5).alias("totss_per_row"), (close & (F.col("betweenss") > 0)).alias("adds_up"))


@query
def kmeans_sets(spark, d):
    """Rows, rows in clusters and total sum of squares of the training, holdout and cross-validation sets."""
    return _kmeans_sets(spark, d, 1).unionByName(_kmeans_sets(spark, d, 3))


@query
def variable_importance(spark, d):
    result = _train(spark, d, "RF", {"ntrees": [10], "max_depth": [5]}, 1)
    return describe.variable_importance(result.model, result.train)


@query
def linear_coefficients(spark, d):
    result = _train(spark, d, "LR", {"alpha": [0], "lambda": [0]}, 1)
    return describe.linear_coefficients(result.model, result.train)


@query
def actual_parameters(spark, d):
    return describe.actual_parameters(spark, _train(spark, d, "LR", {"alpha": [0], "lambda": [0.1]}, 1).model)


@query
def model_summary(spark, d):
    return describe.model_summary(spark, _train(spark, d, "RF", {"ntrees": [10], "max_depth": [5]}, 1).model)


@query
def cv_summary(spark, d):
    result = _train(spark, d, "LR", {"alpha": [0], "lambda": [0.01]}, 3)
    return describe.cross_validation_summary(stage(result.evaluation), result.folds).select(
        "metric", "mean", "sd", F.size("fold_values").alias("folds"))


@query
def classification_report(spark, d):
    """The sizes of all report tables of a scored table."""
    out = None
    for name, df in score.classification_report(scored(spark, d)).items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n")
        out = one if out is None else out.unionByName(one)
    return out


LEARN_TYPES = {"o_orderkey": "numeric", "label": "factor", "o_totalprice": "numeric",
               "c_acctbal": "numeric", "c_mktsegment": "factor", "o_orderstatus": "factor",
               "c_nationkey": "factor"}


def _learn_table(spark, d) -> DataFrame:
    expensive = (F.col("o_totalprice") > 420000) | (F.col("c_nationkey") == 3)
    return credit_missing(spark, d).withColumn("label", expensive.cast("int").cast("string")).drop("y")


def _learn_config(algorithm: str, hparams: dict | None, **more) -> LearnConfig:
    return LearnConfig(types=LEARN_TYPES, id_name="o_orderkey", target_name="label",
                       sampling_method="undersampling", unbalanced_cutoff=2,
                       algorithm=algorithm, hparams=hparams, cv_k=1, **more)


@query
def preprocess_report(spark, d):
    config = _learn_config("NB", None)
    data = learn_plan.import_data(spark, config, _learn_table(spark, d))
    return learn_plan.prepare(spark, data, config).tables["preprocess_report.txt"]


@query
def learn_score_evaluate(spark, d):
    """Learn, save, score new rows and test, through the written artefacts."""
    df = _learn_table(spark, d)
    folder = new_path(spark, "learned")
    learn_plan.learn(spark, _learn_config("LR", {"alpha": [0], "lambda": [0.01]}, calculate_iv=True),
                     df, folder + "/learn")
    result = act_plan.act(spark, folder + "/learn", df=df.drop("label"), folder=folder + "/act")
    metrics = evaluate_plan.evaluate(spark, act_folder=folder + "/act", df=df, folder=folder + "/test")
    tested = metrics["overall_metrics"].select("nobs", "auc", "logloss")
    return (tested.select(F.inline(F.array(*[
                F.struct(F.lit(m).alias("measure"), F.col(c).cast("double").alias("value"))
                for m, c in (("tested_rows", "nobs"), ("auc", "auc"), ("logloss", "logloss"))])))
            .unionByName(result.predictions.agg(F.count(F.lit(1)).cast("double").alias("value"))
                         .select(F.lit("predicted_rows").alias("measure"), "value")))
