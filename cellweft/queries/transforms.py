"""Power transforms, gating and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.functions import numeric
from cellweft.operators import gating, power, scaling, stats
from cellweft.queries.base import query, rounded
from cellweft.session import col
from cellweft.sources.cells import BASIC, cells, table

LAMBDAS = [-0.5, 0.0, 0.5, 1.5]
GRID = "(values (-0.5e0), (0e0), (0.5e0), (1.5e0)) g(l)"


@query("tr_01_boxcox_profile", f"""select feature, l as lambda, count(*) as n, round((l - 1) * sum(ln(v + 1))
    - count(*) / 2.0 * ln(var_pop(case when l = 0 then ln(v + 1) else (pow(v + 1, l) - 1) / nullif(l, 0) end)), 4) as llf
    from melted join {GRID} on true group by 1, 2""", "melted")
def boxcox_profile(spark, d):
    return rounded(power.profile(cells(spark, d), BASIC, LAMBDAS), 4)


YJ = """case when w >= 0 then case when l = 0 then ln(w + 1) else (pow(greatest(w, 0) + 1, l) - 1) / nullif(l, 0) end
    else -(pow(1 - least(w, 0), 2 - l) - 1) / (2 - l) end"""


@query("tr_02_yeojohnson_profile", f"""select feature, l as lambda, count(*) as n, round((l - 1) * sum(sign(w) * ln(abs(w) + 1))
    - count(*) / 2.0 * ln(var_pop({YJ})), 4) as llf from (select feature, v - 5 as w from melted) m join {GRID} on true
    group by 1, 2""", "melted")
def yeojohnson_profile(spark, d):
    c = cells(spark, d)
    shifted = c.select(*[(F.col(b) - 5).alias(b) for b in BASIC])
    return rounded(power.profile(shifted, BASIC, LAMBDAS, "yeo"), 4)


@query("tr_01_boxcox_fit")
def boxcox_fit(spark, d):
    c = cells(spark, d).withColumn("blank", F.lit(3.0))
    fits = power.fit(c, BASIC + ["blank"])
    return rounded(power.record(c, fits))


def _peak_sql(source: str, value: str, llf: str) -> str:
    """Best exponent on a grid of hundredths, by the exact likelihood."""
    return f"""select feature, round(l, 2) as lambda from (select feature, l, row_number() over (partition by feature
        order by llf desc) as r from (select feature, l, {llf} as llf from {source}
        join (select range / 100e0 as l from range(30, 171)) g on true group by 1, 2) p) q where r = 1"""


@query("tr_01_boxcox_lambda", _peak_sql("(select feature, ln(v + 1) as t from melted) m", "t",
       "(l - 1) * sum(t) - count(*) / 2.0 * ln(var_pop((exp(l * t) - 1) / l))"), "melted")
def boxcox_lambda(spark, d):
    fits = power.fit(cells(spark, d), BASIC)
    return spark.createDataFrame([(f.feature, round(f.lam, 2)) for f in fits], "feature string, lambda double")


@query("tr_02_yeojohnson_lambda", _peak_sql("(select feature, v - 5 as w from melted) m", "w", f"""(l - 1) * sum(sign(w) *
       ln(abs(w) + 1)) - count(*) / 2.0 * ln(var_pop({YJ}))"""), "melted")
def yeojohnson_lambda(spark, d):
    shifted = cells(spark, d).select(*[(F.col(b) - 5).alias(b) for b in BASIC])
    fits = power.fit(shifted, BASIC, "yeo")
    return spark.createDataFrame([(f.feature, round(f.lam, 2)) for f in fits], "feature string, lambda double")


@query("tr_02_yeojohnson_fit")
def yeojohnson_fit(spark, d):
    c = cells(spark, d)
    fits = power.fit(c, BASIC, "yeo")
    return rounded(stats.running_stats(power.apply(c, fits, "yeo"), [], BASIC))


@query("fn_13_boxcox", """select row_key, round((pow(cd8_cell_median + 1, 0.3) - 1) / 0.3, 6) as half,
    round(ln(cd3_cell_median + 1), 6) as log, round(sqrt(na2_cell_median), 6) as root from cells""")
def boxcox_values(spark, d):
    return rounded(cells(spark, d).select("row_key", numeric.boxcox(F.col("cd8_cell_median") + 1, 0.3).alias("half"),
                                          numeric.boxcox(F.col("cd3_cell_median") + 1, 0.0).alias("log"),
                                          F.sqrt("na2_cell_median").alias("root")))


@query("fn_11_coerce", """select o_orderkey, coalesce(try_cast(case when o_custkey % 3 = 0 then 'n/a' when o_custkey % 3 = 1
    then 'about 5' else cast(o_custkey as varchar) end as double), 0) as value from orders""", "")
def coerce(spark, d):
    k = F.col("o_custkey")
    text = F.when(k % 3 == 0, "n/a").when(k % 3 == 1, "about 5").otherwise(k.cast("string"))
    return table(spark, d, "orders").select("o_orderkey", numeric.fill_zero(numeric.to_number(text)).alias("value"))


@query("fn_17_melt", "select row_key, feature as variable, v as value from melted", "melted")
def melt(spark, d):
    return stats.melt(cells(spark, d), ["row_key"], BASIC)


FIXED = [gating.Gate("cd3_cell_median", 10.0, 2, (5.0, 30.0), (2.5, 8.0)),
         gating.Gate("cd8_cell_median", 20.5, 1, (50.0,), (20.0,))]


@query("tr_03_clip", """select row_key, greatest(cd3_cell_median, 10.0) as cd3_cell_median,
    greatest(cd8_cell_median, 20.5) as cd8_cell_median from cells""")
def clip(spark, d):
    return gating.apply(cells(spark, d).select("row_key", "cd3_cell_median", "cd8_cell_median"), FIXED)


@query("fn_12_clip", "select row_key, greatest(cd31_cell_median, 3.5) as value from cells")
def clip_value(spark, d):
    return cells(spark, d).select("row_key", numeric.raise_to(F.col("cd31_cell_median"), 3.5).alias("value"))


@query("agg_10_gating_summary", """select feature, t as threshold, k as n_components, round(avg(v), 6) as pre_mean,
    round(avg(greatest(v, t)), 6) as post_mean, round(avg(greatest(v, t) - v), 6) as delta_mean,
    count(*) filter (where v < t) as cells_gated, round(count(*) filter (where v < t) * 100.0 / count(*), 6) as percent_gated
    from melted join (values ('cd3_cell_median', 10e0, 2), ('cd8_cell_median', 20.5e0, 1)) g(f, t, k) on f = feature
    group by 1, 2, 3""", "melted")
def gating_summary(spark, d):
    return rounded(gating.summary(cells(spark, d), FIXED).drop("gmm_means", "gmm_stds"))


# The whole gate on every value: two means, expectation and maximisation until the mean log-likelihood moves by less than
# 0.001 (100 rounds at most), choice by BIC, first minimum of the density on 1000 points. ``values`` names feature and v.
def gate_sql(values: str) -> str:
    near = "abs(v - c0) > abs(v - c1)"
    ln = lambda k: f"(ln(s{k}) - 0.5 * ln(2 * pi() * v{k}) - 0.5 * (v - m{k}) * (v - m{k}) / v{k})"
    top = f"greatest({ln(0)}, {ln(1)})"
    norm = f"({top} + ln(exp({ln(0)} - {top}) + exp({ln(1)} - {top})))"
    return f"""h as (select feature, v::double as v, count(*)::double as w from ({values}) group by 1, 2),
t as (select feature, sum(w) as n, sum(w * v) / sum(w) as mean, min(v) as lo, max(v) as hi from h group by 1),
u as (select t.*, (select sum(w * (v - t.mean) * (v - t.mean)) / t.n from h where h.feature = t.feature) as var from t),
km as (select feature, 0 as k, lo as c0, hi as c1 from u union all
  select feature, k + 1, coalesce(sum(w * v) filter (where not {near}) / sum(w) filter (where not {near}), c0),
    coalesce(sum(w * v) filter (where {near}) / sum(w) filter (where {near}), c1)
  from km join h using (feature) where k < 50 group by feature, k, c0, c1),
k as (select feature, c0, c1 from km where k = 50),
r as (select feature, v, w, n, case when {near} then 0e0 else 1e0 end as r0 from k join h using (feature) join u using (feature)),
f as (select feature, n, sum(w * r0) + 2.220446049250313e-15 as a0, sum(w * (1 - r0)) + 2.220446049250313e-15 as a1,
    sum(w * r0 * v) as b0, sum(w * (1 - r0) * v) as b1 from r group by all),
em as (select feature, 1 as k, b0 / a0 as m0, b1 / a1 as m1,
    greatest(sum(w * r0 * (v - b0 / a0) * (v - b0 / a0)) / a0, 0) + 1e-6 as v0,
    greatest(sum(w * (1 - r0) * (v - b1 / a1) * (v - b1 / a1)) / a1, 0) + 1e-6 as v1, a0 / n as s0, a1 / n as s1,
    null::double as bound, null::double as last from f join r using (feature, n) group by feature, n, a0, a1, b0, b1
  union all select feature, k + 1, b0 / a0, b1 / a1, greatest(q0 / a0 - (b0 / a0 - m0) * (b0 / a0 - m0), 0) + 1e-6,
    greatest(q1 / a1 - (b1 / a1 - m1) * (b1 / a1 - m1), 0) + 1e-6, a0 / n, a1 / n, likelihood / n, bound from (
    select feature, k, m0, m1, n, bound, sum(w * p0) + 2.220446049250313e-15 as a0, sum(w * p1) + 2.220446049250313e-15 as a1,
      sum(w * p0 * v) as b0, sum(w * p1 * v) as b1, sum(w * p0 * (v - m0) * (v - m0)) as q0,
      sum(w * p1 * (v - m1) * (v - m1)) as q1, sum(w * norm) as likelihood from (
        select *, exp({ln(0)} - norm) as p0, exp({ln(1)} - norm) as p1 from (
          select em.*, h.v, h.w, u.n, {norm} as norm from em join h using (feature) join u using (feature)
          where k <= 100 and not coalesce(abs(bound - last) < 1e-3, false)) a) b
    group by feature, k, m0, m1, n, bound)),
e as (select a.feature, a.m0, a.m1, a.v0, a.v1, b.bound * u.n as two, -0.5 * u.n * (ln(2 * pi() * (u.var + 1e-6))
      + u.var / (u.var + 1e-6)) as one, u.* exclude (feature)
  from em a join em b on b.feature = a.feature and b.k = a.k + 1 join u on u.feature = a.feature
  where b.k = (select max(k) from em where em.feature = a.feature)),
g as (select *, case when hi > lo and -2 * two + 5 * ln(n) < -2 * one + 2 * ln(n) then 2 else 1 end as n_components from e),
d as (select *, case when n_components = 1 then mean when m0 <= m1 then m0 else m1 end as dark, sqrt(case
    when n_components = 1 then var + 1e-6 when m0 <= m1 then v0 else v1 end) as sd from g),
x as (select feature, i, lo + i * ((hi - lo) / 999) as x, sqrt(var * n / (n - 1)) * n ** -0.2 as width from d,
  (select unnest(range(1000)) as i) where hi > lo and lo + greatest(i - 2, 0) * ((hi - lo) / 999) <= dark + 2 * sd),
y as (select feature, i, x, (select sum(w * exp(-0.5 * ((x.x - v) / width) * ((x.x - v) / width))) from h
    where h.feature = x.feature) as y from x),
z as (select feature, min(x) as dip from (select *, lag(y) over (partition by feature order by i) as before,
    lead(y) over (partition by feature order by i) as after from y) where y < before and y < after group by 1),
gate as (select feature, least(dark + 2 * sd, coalesce(dip, dark + 2 * sd)) as threshold, n_components, dark, sd
  from d left join z using (feature))"""


def shown(df, gates):
    """The summary with the lower Gaussian, rounded, as bins stand for values."""
    own = F.create_map(*[F.lit(x) for g in gates for x in (g.feature, float(min(g.means)))])
    dev = F.create_map(*[F.lit(x) for g in gates for x in (g.feature, float(min(zip(g.means, g.stds))[1]))])
    out = gating.summary(df, gates).withColumns({"dark": own[F.col("feature")], "sd": dev[F.col("feature")]})
    out = rounded(out.select("feature", "threshold", "n_components", "dark", "sd", "post_mean", "cells_gated", "percent_gated"), 3)
    return out.withColumns({c: F.round(c, 1) + 0.0 for c in ("dark", "sd")})


SHOWN = """select feature, round(threshold, 3) as threshold, n_components, round(dark, 1) as dark, round(sd, 1) as sd,
    round(avg(greatest(v, threshold)), 3) as post_mean, count(*) filter (where v < threshold) as cells_gated,
    round(count(*) filter (where v < threshold) * 100e0 / count(*), 3) as percent_gated"""


@query("tr_03_gating_fit", ", " + gate_sql("select * from melted") + SHOWN + """
    from gate join melted using (feature) group by feature, threshold, n_components, dark, sd""", "recursive melted")
def gating_fit(spark, d):
    c = cells(spark, d)
    return shown(c, gating.fit(c, BASIC))


EVENT_VALUES = """select k as feature, case when event_type = k then coalesce(value, 0) else 0 end::double as v
    from events, (select distinct event_type as k from events where event_type is not null)"""


@query("tr_03_gating_events", f"with recursive m as ({EVENT_VALUES}), " + gate_sql("select * from m") + SHOWN + """
    from gate join m using (feature) group by feature, threshold, n_components, dark, sd""", "")
def gating_events(spark, d):
    """The skewed event values, one feature per event type."""
    e = table(spark, d, "events")
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect() if r[0] is not None)
    wide = e.select(*[F.when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds])
    return shown(wide, gating.fit(wide, kinds))


@query("tr_04_gating_off", """select feature, cast(null as double) as threshold, 0 as n_components, round(avg(v), 6) as pre_mean,
    round(avg(v), 6) as post_mean, 0e0 as delta_mean, 0::bigint as cells_gated, 0e0 as percent_gated from melted group by 1""",
       "melted")
def gating_off(spark, d):
    return rounded(gating.empty_summary(cells(spark, d), BASIC).drop("gmm_means", "gmm_stds"))


@query("tr_05_no_features", "select row_key, Image from cells")
def no_features(spark, d):
    from cellweft.plans.tables import preprocess
    from cellweft.settings import Options
    return preprocess(cells(spark, d).select("row_key", "Image"), [], Options())[0]


HOLES = """select row_key, case when na2_cell_median = 4 then null else cd3_cell_median end as a,
    case when cd31_cell_median = 2 then null else cd8_cell_median end as b from cells"""


def _holes(spark, d):
    return cells(spark, d).select("row_key", F.expr("case when na2_cell_median = 4 then null else cd3_cell_median end").alias("a"),
                                  F.expr("case when cd31_cell_median = 2 then null else cd8_cell_median end").alias("b"))


@query("tr_06_impute_median", f"""select row_key, coalesce(a, (select quantile_cont(a, 0.5) from ({HOLES}) x)) as a,
    round(coalesce(b, (select quantile_cont(b, 0.5) from ({HOLES}) x)), 6) as b from ({HOLES}) t""")
def impute_median(spark, d):
    return rounded(scaling.impute(_holes(spark, d), ["a", "b"], "median"))


@query("tr_06_impute_mean", f"""select row_key, round(coalesce(a, (select avg(a) from ({HOLES}) x)), 6) as a,
    round(coalesce(b, (select avg(b) from ({HOLES}) x)), 6) as b from ({HOLES}) t""")
def impute_mean(spark, d):
    return rounded(scaling.impute(_holes(spark, d), ["a", "b"], "mean"))


@query("tr_07_standard_scale", "select row_key, " + ", ".join(
    f"round(({b} - avg({b}) over ()) / stddev_pop({b}) over (), 6) + 0.0 as {b}" for b in BASIC) + " from cells")
def standard_scale(spark, d):
    return rounded(scaling.standard_scale(cells(spark, d), BASIC).select("row_key", *BASIC))


@query("tr_07_robust_scale", "select row_key, " + ", ".join(
    f"round(({b} - m{i}) / (h{i} - l{i}), 6) + 0.0 as {b}" for i, b in enumerate(BASIC)) + " from cells join (select " + ", ".join(
    f"quantile_cont({b}, 0.25) as l{i}, quantile_cont({b}, 0.5) as m{i}, quantile_cont({b}, 0.75) as h{i}"
    for i, b in enumerate(BASIC)) + " from cells) q on true")
def robust_scale(spark, d):
    return rounded(scaling.robust_scale(cells(spark, d), BASIC).select("row_key", *BASIC))


@query("tr_08_pca")
def pca(spark, d):
    scaled = scaling.robust_scale(cells(spark, d), BASIC)
    return rounded(scaling.project(scaled, BASIC).select("row_key", "PC1", "PC2"))


@query("tr_09_one_hot", """select row_key, case when Image = 'img_0' then 1e0 else 0e0 end as first from cells""")
def one_hot(spark, d):
    from pyspark.ml.functions import vector_to_array
    out = scaling.one_hot(cells(spark, d).select("row_key", "Image"), ["Image"])
    # The slot of img_0 depends on counts, so it is read off the row itself.
    slot = F.array_position(vector_to_array("Image_hot"), 1.0)
    mark = out.withColumn("slot", slot)
    own = mark.filter("Image = 'img_0'").agg(F.min("slot").alias("s0"))
    return mark.join(F.broadcast(own), mark["slot"] == own["s0"], "left").select(
        "row_key", F.when(F.col("s0").isNotNull(), 1.0).otherwise(0.0).alias("first"))
