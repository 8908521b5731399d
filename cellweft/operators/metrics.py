"""Classification and clustering scores as DataFrames.

Rows are first counted by (groups, label, prediction) or by (groups, score); everything after that
works on those counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweft.operators.ranks import running_totals
from cellweft.session import attach, col, settle


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str, groups: list[str] = ()) -> DataFrame:
    return df.groupBy(*[col(g) for g in groups], col(label).alias("label"), col(prediction).alias("prediction")).agg(
        F.count("*").cast("long").alias("n"))


def class_report(df: DataFrame, label: str, prediction: str, groups: list[str] = ()) -> DataFrame:
    """(groups..., class, precision, recall, f1, support); 0 where a ratio is undefined."""
    counts = confusion(df, label, prediction, groups)
    keys = [col(g) for g in groups]
    both = counts.select(*keys, "n", F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.lit(1).alias("is_label")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).alias("is_label")))),
        (F.col("label") == F.col("prediction")).alias("hit"))
    zero = F.lit(0)
    sums = both.groupBy(*keys, "class").agg(
        F.sum(F.when((F.col("is_label") == 1), F.col("n")).otherwise(zero)).alias("support"),
        F.sum(F.when((F.col("is_label") == 0), F.col("n")).otherwise(zero)).alias("predicted"),
        F.sum(F.when((F.col("is_label") == 1) & F.col("hit"), F.col("n")).otherwise(zero)).alias("tp"))
    p, r = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    return sums.select(*keys, "class", p.alias("precision"), r.alias("recall"),
                       _ratio(2 * p * r, p + r).alias("f1"), F.col("support").cast("long").alias("support"))


def binary_scores(df: DataFrame, label: str, prediction: str, groups: list[str] = ()) -> DataFrame:
    """accuracy, f1 of class 1, balanced accuracy and the four cells, one row per group."""
    y, p = col(label) == 1, col(prediction) == 1
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    cells = df.groupBy(*[col(g) for g in groups]).agg(
        one(y & p).alias("tp"), one(~y & p).alias("fp"), one(y & ~p).alias("fn"), one(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    pos, neg = tp + fn, tn + fp
    # Balanced accuracy is the mean recall over the classes that occur.
    classes = (pos > 0).cast("int") + (neg > 0).cast("int")
    return cells.select("*", _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
                        _ratio(_ratio(tp, pos) + _ratio(tn, neg), classes).alias("balanced_accuracy"))


def score_counts(df: DataFrame, label: str, score: str, groups: list[str] = ()) -> DataFrame:
    return df.groupBy(*[col(g) for g in groups], col(score).alias("score")).agg(
        F.sum((col(label) == 1).cast("long")).alias("pos"), F.sum((col(label) != 1).cast("long")).alias("neg"))


def ranking_scores(df: DataFrame, label: str, score: str, groups: list[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """roc_auc and pr_auc (step sum) per group; ties share a rank. NULL with only one class."""
    groups = list(groups)
    cum = running_totals(score_counts(df, label, score, groups), groups, "score", ["pos", "neg"], True, buckets)
    total_pos, total_neg = F.sum("pos"), F.sum("neg")
    above = F.col("cum_pos") - F.col("pos")
    area = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    step = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    product = total_pos.cast("double") * total_neg.cast("double")
    return cum.groupBy(*[col(g) for g in groups]).agg(
        F.when(product > 0, area / product).alias("roc_auc"),
        F.when(total_pos > 0, step / total_pos).alias("pr_auc"))


def class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Inverse class-frequency weight on every row (one average, attached as one row)."""
    share = settle(df.agg(F.avg((col(label) == 1).cast("double")).alias("__p")).withColumn("__one", F.lit(1)), "share")
    p = F.when(col(label) == 1, F.col("__p")).otherwise(1 - F.col("__p"))
    return attach(df.withColumn("__one", F.lit(1)), share, ["__one"]).withColumn(
        weight, 1.0 / F.greatest(p, F.lit(1e-6))).drop("__p", "__one")


def cluster_agreement(df: DataFrame, label: str, cluster: str, groups: list[str] = ()) -> DataFrame:
    """ARI and NMI (arithmetic mean) from the contingency table."""
    keys = [col(g) for g in groups]
    table = df.groupBy(*keys, col(label).alias("a"), col(cluster).alias("b")).agg(F.count("*").cast("double").alias("n"))
    table = settle(table, "contingency")
    pairs = lambda n: F.sum(n * (n - 1) / 2)
    xlogx = lambda n: F.sum(n * F.ln(n))

    def side(name: str, tag: str) -> DataFrame:
        sums = table.groupBy(*keys, name).agg(F.sum("n").alias("m"))
        return sums.groupBy(*keys).agg(pairs(F.col("m")).alias(f"p{tag}"), xlogx(F.col("m")).alias(f"h{tag}"),
                                       F.count("*").alias(f"k{tag}"), F.sum("m").alias(f"n{tag}"))

    both = table.groupBy(*keys).agg(pairs(F.col("n")).alias("pab"), xlogx(F.col("n")).alias("hab"))
    if groups:
        joined = both.join(side("a", "a"), list(groups)).join(side("b", "b"), list(groups))
    else:
        one = lambda d: d.withColumn("__one", F.lit(1))
        joined = one(both).join(one(side("a", "a")), "__one").join(one(side("b", "b")), "__one")
    n = F.col("na")
    expected = F.col("pa") * F.col("pb") / (n * (n - 1) / 2)
    top = (F.col("pa") + F.col("pb")) / 2
    ari = F.when((top - expected) == 0, F.lit(1.0)).otherwise((F.col("pab") - expected) / (top - expected))
    ha, hb = F.ln(n) - F.col("ha") / n, F.ln(n) - F.col("hb") / n
    mutual = F.greatest(F.lit(0.0), F.ln(n) + (F.col("hab") - F.col("ha") - F.col("hb")) / n)
    same = (F.col("ka") == 1) & (F.col("kb") == 1)
    nmi = F.when(same, F.lit(1.0)).when((ha + hb) <= 1e-15, F.lit(0.0)).otherwise(2 * mutual / (ha + hb))
    return joined.select(*keys, ari.alias("ari"), nmi.alias("nmi"))


def leaderboard(scores: DataFrame) -> DataFrame:
    """Best first: pr_auc, balanced accuracy, f1; the model name breaks ties. One row per model."""
    return scores.orderBy(F.desc_nulls_last("pr_auc"), F.desc("balanced_accuracy"), F.desc("f1"), "model")


# The order in which families win ties.
FAMILY_ORDER = ("RandomForest", "ForestNoBootstrap", "LogisticRegression")


def best_by_f1(scores: DataFrame, marker: str = "marker", model: str = "model", f1: str = "f1",
               order: tuple[str, ...] = FAMILY_ORDER) -> DataFrame:
    """Best family per marker by f1, the earlier family on ties, none where every f1 is 0."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), col(model))
    window = Window.partitionBy(col(marker)).orderBy(F.desc(f1), place, col(model))
    return scores.filter(col(f1) > 0).withColumn("__r", F.row_number().over(window)).filter("__r = 1").drop("__r")
