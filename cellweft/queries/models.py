"""Model search, scoring and registry on the cells. Searches make all draws on all folds, as the library's defaults do."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.operators import metrics, power, sampling, scoring, search, training
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import KEY
from cellweft.session import scratch_path, settle
from cellweft.sources.cells import BASIC, cells

def labelled(spark, d, marker="CD8", keep=("row_key", "source_file", *BASIC)):
    """Cells with a parsed label of the marker, as training rows."""
    c = cells(spark, d).select(L.parse_marker(F.col("Classification"), marker).cast("double").alias("label"), *keep)
    return settle(c.filter("label is not null"), "labelled")


def fit_one(spark, d, family, params, marker="CD8", features=("cd3_cell_median", "cd8_cell_median", "cd31_cell_median")):
    rows = labelled(spark, d, marker, features)  # no row key: its hash costs more than the fit's passes
    return rows, search._fit(rows, family, params, list(features), 421, "mean", None)


@query("ml_05_supervised_search")
def supervised_search(spark, d):
    rows = training.training_rows(cells(spark, d), keep=["row_key", *BASIC]).filter("marker = 'CD3'")
    fitted = search.train_marker(rows, ["cd3_cell_median", "na2_cell_median"])
    return search.board(spark, "CD3", fitted).drop("params")


@query("ml_06_weighted_search")
def weighted_search(spark, d):
    data = metrics.class_weights(labelled(spark, d), "label")
    data = sampling.group_split(data)
    train = data.filter("part = 'train'")
    groups = train.select("source_file").distinct().count()
    n_folds = min(5, groups) if groups >= 3 else 3
    folds = sampling.group_folds(train, "label", folds=n_folds) if groups >= 3 else sampling.row_folds(train, "label", n_folds)
    train = settle(folds.withColumns({f"fold_{i}": F.col("fold") == i for i in range(n_folds)}), "train")
    fitted = search.search_families(train, [f"fold_{i}" for i in range(n_folds)], search.recovery_draws(30),
                                    ["cd3_cell_median", "na2_cell_median", "cd31_cell_median"], 421, "pr_auc", "median",
                                    "weight", True)
    search.evaluate(fitted, data.filter("part = 'validation'"))
    return metrics.leaderboard(search.board(spark, "CD8", fitted)).drop("params")


def _family(name, family, params):
    @query(name)
    def run(spark, d):
        rows, model = fit_one(spark, d, family, params)
        return rounded(metrics.binary_scores(search.transform(model, rows), "label", "prediction"))
    return run


# Trees without a depth limit, as far as Spark lets them grow.
FOREST = {"numTrees": 100, "maxDepth": 30, "impurity": "gini", "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"}
_family("ml_07_random_forest", "RandomForest", FOREST)
_family("ml_08_forest_no_bootstrap", "ForestNoBootstrap", FOREST)
_family("ml_09_logistic", "LogisticRegression", {"regParam": 1e-4, "elasticNetParam": 0.5, "maxIter": 50})
_family("ml_10_linear_svc", "LinearSVC", {"regParam": 1e-4, "maxIter": 20})


@query("ml_11_choose_model")
def choose_model(spark, d):
    board = supervised_search(spark, d).withColumn("model", F.col("model"))
    return metrics.best_by_f1(board.select("marker", "model", "f1"))


def _models(spark, d):
    params = {"regParam": 1e-4, "elasticNetParam": 0.0, "maxIter": 30}
    out = []
    for marker, features in (("CD3", ("cd3_cell_median",)), ("CD8", ("cd8_cell_median", "na2_cell_median"))):
        _, model = fit_one(spark, d, "LogisticRegression", params, marker, features)
        out.append(scoring.MarkerModel(marker, model, features))
    return out


@query("ml_12_score_cells")
def score_cells(spark, d):
    return scoring.score_wide(cells(spark, d), _models(spark, d), ["row_key", *KEY])


@query("join_05_models_by_tables", """select source_file, m as marker, count(*) as n from cells
    join (select 'CD3' as m union all select 'CD8') k on true group by 1, 2""")
def models_by_tables(spark, d):
    long = scoring.score(cells(spark, d), _models(spark, d), ["row_key", "source_file"])
    return long.groupBy("source_file", "marker").agg(F.count("probability").alias("n"))


@query("ml_13_score_rows")
def score_rows(spark, d):
    return scoring.label_rows(cells(spark, d), _models(spark, d)[0].model, "CD3").select(
        "row_key", "source_file", "probability", "predicted_label")


@query("fn_10_threshold", """select row_key, case when 1 / (1 + exp(-(cd3_cell_median - 25) / 8)) >= 0.5 then 'CD3+' else 'CD3-' end
    as predicted_label from cells""")
def threshold(spark, d):
    p = 1 / (1 + F.exp(-(F.col("cd3_cell_median") - 25) / 8))
    return cells(spark, d).select("row_key", L.sign_label("CD3", (p >= 0.5).cast("int")).alias("predicted_label"))


@query("snk_05_model_registry", """select 'CD8' as marker, 'LogisticRegression' as family, 1e0 as f1,
    'cd3_cell_median,cd8_cell_median,cd31_cell_median' as features, count(distinct row_key) as n_scored from tok
    where label in ('CD8+', 'CD8-')""", "tok")
def model_registry(spark, d):
    features = ["cd3_cell_median", "cd8_cell_median", "cd31_cell_median"]
    params = {"regParam": 1e-4, "maxIter": 20}
    rows = settle(sampling.stratified_split(labelled(spark, d), "label", 0.3, 42), "split")
    model = search._fit(rows.filter("not is_test"), "LogisticRegression", params, features, 421, "mean", None)
    fitted = search.Fitted("LogisticRegression", params, 0.0, model)
    search.evaluate([fitted], rows.filter("is_test"))
    path = scratch_path(spark, "model")
    search.save_model(fitted, path)
    loaded = search.load_model(path, "LogisticRegression")
    same = search.transform(loaded, rows).agg(F.count("probability").alias("n")).first()["n"]
    return search.registry(spark, [("CD8", fitted, path, features)]).select(
        "marker", "family", "f1", F.array_join("features", ",").alias("features")).withColumn("n_scored", F.lit(same).cast("long"))


@query("agg_11_boxcox_record", "select feature as \"Feature\", round(avg(v), 6) as \"Pre_Mean\", '0.500' as \"Lambda\", " +
       ", ".join(f"round({fn}((pow(v + 1, 0.5) - 1) / 0.5), 6) as \"Post_{n}\"" for fn, n in
                 (("avg", "Mean"), ("min", "Min"), ("max", "Max"))) + """ from melted group by 1 union all
       select 'blank', 3.0, 'Failed', 0.0, 0.0, 0.0""", "melted")
def boxcox_record(spark, d):
    fits = [power.Fit(b, 0.5) for b in BASIC] + [power.Fit("blank", None)]
    return rounded(power.record(cells(spark, d).withColumn("blank", F.lit(3.0)), fits))
