"""Statistics, histograms and classification scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.functions.keys import cell_key
from cellweft.operators import boosting, counts, metrics, ranks, stats
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import KEY, scored, truth
from cellweft.session import col
from cellweft.sources.cells import BASIC, cells, quant, table


@query("agg_05_thresholds", "select source_file, feature, round(threshold, 6) as threshold from thr", "thr")
def thresholds(spark, d):
    return rounded(boosting.thresholds(cells(spark, d), BASIC, 12.0))


@query("agg_06_describe", """select source_file, feature, count(v) as n, round(avg(v), 6) as mean,
    round(stddev_samp(v), 6) as std, round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as q25,
    round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75, round(max(v), 6) as max
    from melted group by 1, 2""", "melted")
def describe(spark, d):
    return rounded(stats.describe(cells(spark, d), ["source_file"], BASIC))


@query("agg_07_running_stats", """select source_file, feature, count(v) as n, round(avg(v), 6) as mean,
    round(stddev_pop(v), 6) as std, round(min(v), 6) as min, round(max(v), 6) as max from melted group by 1, 2""", "melted")
def running_stats(spark, d):
    return rounded(stats.running_stats(cells(spark, d), ["source_file"], BASIC))


def _histogram(bins: int, groups: list[str]):
    part = "".join(g + ", " for g in groups)
    on = " and ".join([f"r.{g} = m.{g}" for g in groups] + ["r.feature = m.feature"])
    sql = f"""select {"".join("m." + g + ", " for g in groups)} m.feature,
        cast(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) as integer) as bin, count(*) as n
        from melted m join (select {part} feature, min(v) as lo, max(v) as hi from melted group by {part} feature) r
        on {on} group by {"".join("m." + g + ", " for g in groups)} m.feature, bin"""

    @query(f"agg_08_histogram_{bins}", sql, "melted")
    def run(spark, d):
        return stats.histogram(cells(spark, d), groups, BASIC, bins).select(*groups, "feature", "bin", "n")
    return run


_histogram(20, ["source_file"])
_histogram(40, [])
_histogram(30, ["Image"])


@query("agg_09_box_stats", """select m.Image, q.n, round(q25, 6) as q25, round(q50, 6) as q50, round(q75, 6) as q75,
    round(min(v) filter (where v >= q25 - 1.5 * (q75 - q25)), 6) as low_whisker,
    round(max(v) filter (where v <= q75 + 1.5 * (q75 - q25)), 6) as high_whisker
    from melted m join (select Image, count(*) as n, quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.5) as q50,
      quantile_cont(v, 0.75) as q75 from melted group by 1) q on q.Image = m.Image group by 1, 2, 3, 4, 5""", "melted")
def box_stats(spark, d):
    return rounded(stats.box_stats(cells(spark, d), "Image", BASIC))


@query("agg_12_crosstab", """select source_file, count(*) filter (where prediction = 0) as "CD3-",
    count(*) filter (where prediction = 1) as "CD3+" from scored where marker = 'CD3' group by 1""", "scored")
def crosstab(spark, d):
    from cellweft.functions.labels import sign_label
    s = scored(spark, d).filter("marker = 'CD3'").withColumn("p", sign_label("CD3", F.col("prediction")))
    return counts.crosstab(s, "source_file", "p", ["CD3-", "CD3+"])


@query("agg_14_duplicate_keys", """select marker, (count(*) - count(distinct (Image, x_um, y_um)))::bigint as duplicates
    from scored group by 1""", "scored")
def duplicate_keys(spark, d):
    return ranks.duplicate_keys(scored(spark, d), cell_key(KEY), "marker")


@query("agg_16_confusion", "select marker, label, prediction, count(*) as n from truth group by 1, 2, 3", "truth")
def confusion(spark, d):
    return metrics.confusion(truth(spark, d), "label", "prediction", ["marker"])


@query("agg_16_binary_scores", """select marker, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy,
    round(2 * tp / (2 * tp + fp + fn), 6) as f1, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) as balanced_accuracy
    from (select marker, count(*) filter (where label = 1 and prediction = 1) as tp,
      count(*) filter (where label = 0 and prediction = 1) as fp, count(*) filter (where label = 1 and prediction = 0) as fn,
      count(*) filter (where label = 0 and prediction = 0) as tn from truth group by 1) t""", "truth")
def binary_scores(spark, d):
    return rounded(metrics.binary_scores(truth(spark, d), "label", "prediction", ["marker"]))


@query("agg_16_class_report", """select marker, class, round(tp / predicted, 6) as precision, round(tp / support, 6) as recall,
    round(2 * (tp / predicted) * (tp / support) / (tp / predicted + tp / support), 6) as f1, support from (
    select marker, c.class, count(*) filter (where label = c.class) as support,
      count(*) filter (where prediction = c.class) as predicted,
      count(*) filter (where prediction = c.class and label = c.class) as tp
    from truth join (select 0 as class union all select 1) c on true group by 1, 2) t""", "truth")
def class_report(spark, d):
    return rounded(metrics.class_report(truth(spark, d), "label", "prediction", ["marker"]))


RANKED = """select marker, probability as score, sum(label) as pos, sum(1 - label) as neg from truth group by 1, 2"""
CUM = f"""select *, sum(pos) over w as cp, sum(neg) over w as cn, sum(pos) over g as tp, sum(neg) over g as tn
    from ({RANKED}) r window w as (partition by marker order by score desc), g as (partition by marker)"""


@query("agg_17_roc_auc", f"""select marker, round(sum(neg * (cp - pos + pos / 2.0)) / (max(tp) * max(tn)), 6) as roc_auc
    from ({CUM}) c group by 1""", "truth")
def roc_auc(spark, d):
    return rounded(metrics.ranking_scores(truth(spark, d), "label", "probability", ["marker"]).select("marker", "roc_auc"))


@query("agg_18_average_precision", f"""select marker, round(sum(pos * cp / (cp + cn)) / max(tp), 6) as pr_auc
    from ({CUM}) c group by 1""", "truth")
def average_precision(spark, d):
    return rounded(metrics.ranking_scores(truth(spark, d), "label", "probability", ["marker"]).select("marker", "pr_auc"))


@query("agg_19_weights", """select row_key, round(case when label = 1 then 1 / p else 1 / (1 - p) end, 6) as weight from
    (select *, avg(label) over () as p from truth where marker = 'CD3') t""", "truth")
def weights(spark, d):
    return rounded(metrics.class_weights(truth(spark, d).filter("marker = 'CD3'"), "label").select("row_key", "weight"))


AGREE = """with t as (select o_orderstatus as a, o_orderpriority as b, count(*)::double as n from orders group by 1, 2),
 ra as (select a, sum(n) as m from t group by 1), rb as (select b, sum(n) as m from t group by 1),
 s as (select (select sum(n*(n-1)/2) from t) as pab, (select sum(m*(m-1)/2) from ra) as pa,
   (select sum(m*(m-1)/2) from rb) as pb, (select sum(n) from t) as n, (select sum(n*ln(n)) from t) as hab,
   (select sum(m*ln(m)) from ra) as ha, (select sum(m*ln(m)) from rb) as hb)
 select round((pab - pa*pb/(n*(n-1)/2)) / ((pa+pb)/2 - pa*pb/(n*(n-1)/2)), 6) + 0.0 as ari,
   round(2*(ln(n) + (hab-ha-hb)/n) / ((ln(n)-ha/n) + (ln(n)-hb/n)), 6) + 0.0 as nmi from s"""


@query("agg_20_ari_nmi", AGREE, "")
def ari_nmi(spark, d):
    return rounded(metrics.cluster_agreement(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority"))


@query("agg_20_ari_nmi_by_file", """select source_file, round((pab - pa*pb/e) / ((pa+pb)/2 - pa*pb/e), 6) as ari,
    round(2*(ln(n) + (hab-ha-hb)/n) / ((ln(n)-ha/n) + (ln(n)-hb/n)), 6) as nmi from (
    select x.source_file, pab, hab, pa, ha, pb, hb, n, n*(n-1)/2 as e from
    (select source_file, sum(n*(n-1)/2) as pab, sum(n*ln(n)) as hab, sum(n) as n from
      (select source_file, label, prediction, count(*)::double as n from truth group by 1, 2, 3) t group by 1) x
    join (select source_file, sum(n*(n-1)/2) as pa, sum(n*ln(n)) as ha from
      (select source_file, label, count(*)::double as n from truth group by 1, 2) t group by 1) y on x.source_file = y.source_file
    join (select source_file, sum(n*(n-1)/2) as pb, sum(n*ln(n)) as hb from
      (select source_file, prediction, count(*)::double as n from truth group by 1, 2) t group by 1) z
      on x.source_file = z.source_file) q""", "truth")
def ari_nmi_by_file(spark, d):
    return rounded(metrics.cluster_agreement(truth(spark, d), "label", "prediction", ["source_file"]))


@query("agg_21_unique_values", """select marker, count(distinct label) as classes, count(distinct source_file) as files,
    count(distinct Classification) as label_texts from train group by 1""", "train")
def unique_values(spark, d):
    from cellweft.operators.training import training_rows
    return training_rows(cells(spark, d)).groupBy("marker").agg(
        F.count_distinct("label").alias("classes"), F.count_distinct("source_file").alias("files"),
        F.count_distinct("Classification").alias("label_texts"))


@query("agg_23_by_table", """select source_file, marker, count(*) as n, sum(prediction)::bigint as positive from scored
    group by 1, 2""", "scored")
def by_table(spark, d):
    return scored(spark, d).groupBy("source_file", "marker").agg(
        F.count("*").alias("n"), F.sum("prediction").cast("long").alias("positive"))


@query("agg_24_inverted_axis", """select row_key, Image, max(y_um) over (partition by Image) - y_um as inverted_y from cells""")
def inverted_axis(spark, d):
    from cellweft.operators.merging import inverted
    return inverted(cells(spark, d), "y_um", ["Image"], "inverted_y").select("row_key", "Image", "inverted_y")


@query("win_07_running_totals", f"""select marker, score, cp::bigint as cum_pos, cn::bigint as cum_neg from ({CUM}) c""", "truth")
def running_totals(spark, d):
    data = metrics.score_counts(truth(spark, d), "label", "probability", ["marker"])
    return ranks.running_totals(data, ["marker"], "score", ["pos", "neg"]).select("marker", "score", "cum_pos", "cum_neg")


BOARD = """select source_file as model, accuracy, f1, balanced_accuracy, pr_auc from (
    select t.source_file, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy, round(2 * tp / (2 * tp + fp + fn), 6) as f1,
      round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) as balanced_accuracy, pr_auc from (
      select source_file, count(*) filter (where label = 1 and prediction = 1) as tp,
        count(*) filter (where label = 0 and prediction = 1) as fp, count(*) filter (where label = 1 and prediction = 0) as fn,
        count(*) filter (where label = 0 and prediction = 0) as tn from truth group by 1) t
      join (select source_file, round(sum(pos * cp / (cp + cn)) / max(tp), 6) as pr_auc from (
        select *, sum(pos) over (partition by source_file order by score desc) as cp,
          sum(neg) over (partition by source_file order by score desc) as cn, sum(pos) over (partition by source_file) as tp
        from (select source_file, probability as score, sum(label) as pos, sum(1 - label) as neg from truth group by 1, 2) r) c
        group by 1) p on p.source_file = t.source_file) b"""


def _board(spark, d):
    t = truth(spark, d)
    a = metrics.binary_scores(t, "label", "prediction", ["source_file"])
    b = metrics.ranking_scores(t, "label", "probability", ["source_file"])
    return rounded(a.join(b, "source_file").select(F.col("source_file").alias("model"), "accuracy", "f1",
                                                   "balanced_accuracy", "pr_auc"))


@query("srt_02_leaderboard", BOARD + " order by pr_auc desc, balanced_accuracy desc, f1 desc, model limit 1", "truth")
def leaderboard(spark, d):
    return metrics.leaderboard(_board(spark, d)).limit(1)


@query("srt_03_best_by_f1", f"""select marker, model, f1 from (select *, row_number() over (partition by marker
    order by f1 desc, model) as r from (select 'all' as marker, model, f1 from ({BOARD}) b) x where f1 > 0) y where r = 1""",
       "truth")
def best_by_f1(spark, d):
    rows = _board(spark, d).select(F.lit("all").alias("marker"), "model", "f1")
    return metrics.best_by_f1(rows, order=("none",))


@query("rep_09_long_board", f"""select model, 'accuracy' as metric, accuracy as value from ({BOARD}) a union all
    select model, 'f1', f1 from ({BOARD}) b union all select model, 'balanced_accuracy', balanced_accuracy from ({BOARD}) c
    union all select model, 'pr_auc', pr_auc from ({BOARD}) e
    union all select model, 'roc_auc', cast(null as double) from ({BOARD}) f""", "truth")
def long_board(spark, d):
    from cellweft.operators.reports import long_board as melt
    return melt(_board(spark, d).withColumn("roc_auc", F.lit(None).cast("double")))
