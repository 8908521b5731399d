"""Random hyper-parameter search, evaluation and choice of binary classifiers.

Draws are seeded parameter lists; a draw that cannot be expressed here is not made. All draws of all families are scored on
all folds and all labelled rows, by ``grid`` in one job over the counts of equal rows. Where equal rows are too few to hold
their counts in a task, forests are scored on the counts of equal binned rows, other draws each by a fit of Spark's. The best
draw of each family is then fitted by Spark on all training rows: linear ones on the counts of equal rows, forests on those
of equal binned rows (``forests``).
"""

from __future__ import annotations

import json
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.operators import forests, grid, metrics, sampling
from cellweft.operators.scaling import numeric_stages
from cellweft.session import col, release, settle

FAMILIES = ("RandomForest", "ForestNoBootstrap", "LogisticRegression")
RECOVERY_FAMILIES = FAMILIES + ("LinearSVC",)

# The ranges that draws are made from (supervised search, recovery search).
IMPURITIES = ("gini", "entropy", "entropy")
DEPTHS = ((None, *range(5, 30)), (None, *range(3, 14)))
TREES = ((100, 200), tuple(range(150, 500)))
LEAVES = tuple(range(1, 10))
SUBSETS = (("sqrt", "log2"), ("sqrt", "log2", "all"))
FOREST_WEIGHTS = ((None,), (None, "balanced", "balanced_subsample"))
LINEAR_WEIGHTS = ((None,), (None, "balanced"))
PENALTIES = ("elasticnet", "l1", "l2")
STRENGTHS = tuple(10.0 ** e for e in range(-10, 11))
TOLERANCES = tuple(10 ** -(2 + i / 2) for i in range(37))
MIXES = tuple(i / 23 for i in range(24))
DEEPEST = 30  # no limit, as far as Spark lets trees grow


def draw(family: str, rng: random.Random, wide: bool = False) -> dict:
    """One seeded draw. ``wide`` is the recovery search, the other the supervised one."""
    k = int(wide)
    if family in grid.FORESTS:
        return {"impurity": rng.choice(IMPURITIES), "numTrees": rng.choice(TREES[k]),
                "maxDepth": rng.choice(DEPTHS[k]) or DEEPEST, "minInstancesPerNode": rng.choice(LEAVES),
                "featureSubset": rng.choice(SUBSETS[k]), "classWeight": rng.choice(FOREST_WEIGHTS[k])}
    out = {"classWeight": rng.choice(LINEAR_WEIGHTS[k]), "maxIter": 5000}
    if family == "LinearSVC":
        return out | {"C": 10 ** rng.uniform(-3, 3), "maxIter": 100}
    mix = {"l2": 0.0, "l1": 1.0, "elasticnet": rng.random() if wide else rng.choice(MIXES)}[rng.choice(PENALTIES)]
    return out | {"C": 10 ** rng.uniform(-4, 3) if wide else rng.choice(STRENGTHS), "elasticNetParam": mix,
                  "tol": 10 ** rng.uniform(-6, -2) if wide else rng.choice(TOLERANCES)}


def recovery_draws(draws: int, families: tuple[str, ...] = RECOVERY_FAMILIES) -> dict[str, int]:
    """Draws of each family; the support vector machine gets half of them, 10 at least."""
    return {f: draws if f != "LinearSVC" else max(10, draws // 2) for f in families}


def classifier(family: str, params: dict, seed: int, weight: str | None = None, total: float = 1.0, features: int = 1):
    """Spark's estimator for a draw, or for Spark's own parameter names. ``total`` is the summed weight of its rows."""
    own = {k: v for k, v in params.items() if k not in ("C", "featureSubset", "classWeight")}
    if "C" in params:
        own["regParam"] = 1.0 / (params["C"] * max(total, 1.0))
    if "featureSubset" in params:
        own["featureSubsetStrategy"] = str(grid.subset_size(params["featureSubset"], features))
    own |= {"featuresCol": "features", "labelCol": "label"}
    if weight:
        own["weightCol"] = weight
    if family == "RandomForest":
        return RandomForestClassifier(seed=seed, **own)
    if family == "ForestNoBootstrap":
        return RandomForestClassifier(seed=seed, bootstrap=False, subsamplingRate=1.0, **own)
    if family == "LogisticRegression":
        return LogisticRegression(standardization=False, **own)
    return LinearSVC(standardization=False, **own)


@dataclass
class Fitted:
    family: str
    params: dict
    search_score: float
    model: object = None
    calibration: object = None
    error: str | None = None
    scores: dict = field(default_factory=dict)


def _weigh(rows: DataFrame, params: dict, weight: str | None) -> tuple[DataFrame, str | None, float]:
    """Rows with the draw's class weights multiplied in, the weight column and its sum.

    Weights drawn per tree ("balanced_subsample") are balanced over all rows here, since Spark's forests take one weight a row;
    forests grown from entries (``forests``) balance each bootstrap.
    """
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(col(weight) if weight else F.lit(1.0)).alias("w")).collect()
    n = sum(r["n"] for r in sizes)
    if not params.get("classWeight"):
        return rows, weight, float(sum(r["w"] for r in sizes))
    factor = {r["label"]: n / (2 * r["n"]) for r in sizes}
    own = F.lit(1.0)
    for value, f in factor.items():
        own = F.when(F.col("label") == value, f).otherwise(own)
    rows = rows.withColumn("__weight", own * (col(weight) if weight else F.lit(1.0)))
    return rows, "__weight", float(sum(factor[r["label"]] * r["w"] for r in sizes))


def _fit(rows: DataFrame, family: str, params: dict, features: list[str], seed: int, strategy: str,
         weight: str | None):
    if family in grid.FORESTS:
        model = forests.fit(rows, family, params, features, seed, strategy, weight)
        if model is not None:
            return model
    rows, weight, total = _weigh(rows, params, weight)
    if family in grid.FORESTS:
        stages = numeric_stages(features, strategy) + [classifier(family, params, seed, weight, total, len(features))]
        return Pipeline(stages=stages).fit(rows)
    # A linear loss is a sum over rows: equal rows are one row with their number as its weight.
    prepared = Pipeline(stages=numeric_stages(features, strategy)).fit(rows)
    own = F.col("__rows") * col(weight) if weight else F.col("__rows").cast("double")
    keys = list(dict.fromkeys([*features, "label", *([weight] if weight else [])]))
    merged = settle(rows.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__rows")), "merged").withColumn("__own", own)
    fitted = classifier(family, params, seed, "__own", total, len(features)).fit(prepared.transform(merged))
    model = PipelineModel(stages=[*prepared.stages, fitted])
    if family != "LinearSVC":
        return model
    # Margins become probabilities through a one-feature logistic regression.
    margin = model.transform(merged).withColumn("margin", vector_to_array("rawPrediction")[1])
    stages = [VectorAssembler(inputCols=["margin"], outputCol="margin_vector"),
              LogisticRegression(featuresCol="margin_vector", labelCol="label", predictionCol="calibrated", weightCol="__rows",
                                 probabilityCol="calibrated_probability", rawPredictionCol="calibrated_raw")]
    calibration = Pipeline(stages=stages).fit(margin.select("margin", "label", F.col("__rows").cast("double")))
    return model, calibration


def transform(fitted_model, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (int) and ``probability`` (double, class 1)."""
    if isinstance(fitted_model, forests.ForestModel):
        return fitted_model.transform(df)
    if isinstance(fitted_model, tuple):
        model, calibration = fitted_model
        out = calibration.transform(model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1]))
        score = vector_to_array("calibrated_probability")[1]
    else:
        out = fitted_model.transform(df)
        score = vector_to_array("probability")[1]
    return out.select(*[col(c) for c in df.columns], F.col("prediction").cast("int").alias("__p"),
                      score.alias("__s")).withColumnsRenamed({"__p": "prediction", "__s": "probability"})


def _table_scores(train: DataFrame, folds: list[str], drawn: dict[str, list[dict]], features: list[str], scoring: str,
                  strategy: str, weight: str | None, seed: int, parallelism: int) -> dict[tuple[str, int], list[float]]:
    """As ``grid.grid_scores``, for rows that no task can hold: nothing but counts of binned rows leaves the cluster."""
    keep = list(dict.fromkeys(["label", *features, *([weight] if weight else [])]))
    out: dict[tuple[str, int], list[float]] = {(f, d): [] for f, draws in drawn.items() for d in range(len(draws))}
    trees = {f: draws for f, draws in drawn.items() if f in grid.FORESTS}
    for name in folds:
        held = F.coalesce(col(name), F.lit(False))
        parts = [settle(train.where(side).select(*[col(k) for k in keep]), "fold") for side in (~held, held)]
        found: dict[tuple[str, int], list[float]] = {}
        if trees:
            prepare = forests.prepared(parts[0], features, strategy)
            counts = [forests.counted(part, prepare, features, weight, forests.ENTRY_LIMIT) for part in parts]
            if all(c is not None for c in counts):
                fold = forests.fold_of(counts[0], features, counts[1])
                found = grid.grid_scores(train.sparkSession, [fold], trees, scoring, strategy, seed)

        def score(draw: tuple[str, int]) -> list[float]:
            model = _fit(parts[0], draw[0], drawn[draw[0]][draw[1]], features, seed, strategy, weight)
            scored = settle(transform(model, parts[1]).select("label", "prediction", "probability"), "scored")
            row = (metrics.binary_scores(scored, "label", "prediction") if scoring == "f1"
                   else metrics.ranking_scores(scored, "label", "probability")).first()
            release(scored)
            return [float((row["f1" if scoring == "f1" else "pr_auc"] if row else None) or 0.0)]

        rest = [key for key in out if key not in found]
        with ThreadPoolExecutor(parallelism) as pool:
            found |= dict(zip(rest, pool.map(score, rest)))
        for key, own in out.items():
            own += found[key]
        release(*parts)
    return out


def search_families(train: DataFrame, folds: list[str], draws: dict[str, int], features: list[str], seed: int,
                    scoring: str = "f1", strategy: str = "mean", weight: str | None = None, wide: bool = False,
                    rows: int | None = None, parallelism: int = 4) -> list[Fitted]:
    """The best draw of each family of ``draws`` (how many to make) by mean fold score, fitted on all training rows.

    ``folds`` are boolean columns: true marks the held-out rows of that fold. The search sees all rows; those that are equal
    are counted, and with more than ``rows`` different ones (or too many values to hold) it fits from tables.
    Of equal draws the earlier one wins. A family whose fit fails keeps its error.
    """
    drawn = {}
    for family, n in draws.items():
        rng = random.Random(f"{seed}-{family}")
        drawn[family] = [draw(family, rng, wide) for _ in range(n)]
    classes = train.agg(*[F.coalesce(F.max((F.col("label") > 0) == F.lit(up)), F.lit(False)) for up in (True, False)]).first()
    if not all(classes):
        return [Fitted(f, {}, 0.0, error="training rows of one class") for f in draws]
    whole = grid.whole_rows(train, folds, features, weight, rows)
    scores = (grid.grid_scores(train.sparkSession, whole, drawn, scoring, strategy, seed) if whole is not None
              else _table_scores(train, folds, drawn, features, scoring, strategy, weight, seed, parallelism))

    def refit(family: str) -> Fitted:
        means = [sum(own) / len(own) if (own := scores.get((family, d))) else 0.0 for d in range(len(drawn[family]))]
        best = max(range(len(means)), key=lambda d: (means[d], -d))
        out = Fitted(family, drawn[family][best], means[best])
        try:
            out.model = _fit(train, family, out.params, features, seed, strategy, weight)
        except Exception as error:  # the family is reported as failed
            out.error = str(error).splitlines()[0][:200]
        return out

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(refit, draws))


def evaluate(fitted: list[Fitted], held_out: DataFrame, test: DataFrame | None = None) -> list[Fitted]:
    for f in fitted:
        if f.error:
            continue
        for prefix, part in (("", held_out), ("test_", test)):
            if part is None:
                continue
            scored = settle(transform(f.model, part).select("label", "prediction", "probability"), "scored")
            row = metrics.binary_scores(scored, "label", "prediction").first()
            rank = metrics.ranking_scores(scored, "label", "probability").first()
            f.scores.update({f"{prefix}{k}": row[k] for k in ("accuracy", "f1", "balanced_accuracy")})
            f.scores.update({f"{prefix}roc_auc": rank["roc_auc"] if rank else None,
                             f"{prefix}pr_auc": rank["pr_auc"] if rank else None})
    return fitted


BOARD = ("marker string, model string, accuracy double, f1 double, roc_auc double, pr_auc double, "
         "balanced_accuracy double, search_score double, params string, error string")


def board(spark: SparkSession, marker: str, fitted: list[Fitted]) -> DataFrame:
    """One row per family; families that failed keep their error."""
    rows = [(marker, f.family, *[f.scores.get(k) for k in ("accuracy", "f1", "roc_auc", "pr_auc", "balanced_accuracy")],
             f.search_score, json.dumps(f.params), f.error) for f in fitted]
    return spark.createDataFrame(rows, BOARD)


def choose_by_f1(fitted: list[Fitted]) -> Fitted | None:
    """Strictly better f1 wins, so the earlier family keeps ties; none if all are 0."""
    best = None
    for f in fitted:
        if not f.error and (f.scores.get("f1") or 0.0) > (best.scores["f1"] if best else 0.0):
            best = f
    return best


def choose_by_rank(fitted: list[Fitted]) -> Fitted | None:
    alive = [f for f in fitted if not f.error]
    return min(alive, key=lambda f: (-(f.scores.get("pr_auc") or 0), -(f.scores.get("balanced_accuracy") or 0),
                                     -(f.scores.get("f1") or 0), f.family)) if alive else None


def train_marker(rows: DataFrame, features: list[str], draws: int = 100, splits: int = 5, seed: int = 421,
                 families: tuple[str, ...] = FAMILIES) -> list[Fitted]:
    """Supervised search for one marker: stratified 70/30 split, stratified shuffle splits, f1.

    ``rows`` holds row_key, key_label and the features.
    """
    from cellweft.functions.labels import is_positive
    data = rows.select("row_key", "key_label", *[F.coalesce(col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    # Stored once: every counting pass of the splits would parse the cells again.
    data = settle(data.withColumn("label", is_positive(F.col("key_label")).cast("double")), "labelled")
    data = sampling.stratified_split(data, "key_label", 0.3, 42)
    data = settle(sampling.shuffle_splits(data, "key_label", splits, 0.1, 911), "training")
    train, test = data.filter("not is_test"), data.filter("is_test")
    fitted = search_families(train, [f"fold_{i}" for i in range(splits)], {f: draws for f in families}, features, seed)
    return evaluate(fitted, test)


def save_model(fitted: Fitted, path: str) -> None:
    if isinstance(fitted.model, forests.ForestModel):
        fitted.model.save(path)
    elif isinstance(fitted.model, tuple):
        fitted.model[0].write().overwrite().save(f"{path}/model")
        fitted.model[1].write().overwrite().save(f"{path}/calibration")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")


def load_model(path: str, family: str):
    if family in grid.FORESTS:
        try:
            return forests.load(SparkSession.active(), path)
        except AnalysisException:  # a forest that Spark fitted
            pass
    model = PipelineModel.load(f"{path}/model")
    return (model, PipelineModel.load(f"{path}/calibration")) if family == "LinearSVC" else model


REGISTRY = "marker string, family string, f1 double, path string, features array<string>"


def registry(spark: SparkSession, entries: list[tuple[str, Fitted, str, list[str]]]) -> DataFrame:
    return spark.createDataFrame(
        [(m, f.family, f.scores.get("f1"), path, list(features)) for m, f, path, features in entries], REGISTRY)
