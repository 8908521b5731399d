"""Projections and filters."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.functions import numeric
from cellweft.operators import boosting, counts, merging, scoring, stats, training
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import CELL_OPTIONS, KEY, MARKERS, scored
from cellweft.session import attach, col, settle
from cellweft.settings import CELL_KEY, Options, X, Y
from cellweft.sources import catalog, tables
from cellweft.sources.cells import BASIC, cells, quant

POSITION = '"Centroid X µm", "Centroid Y µm"'


def pick(df, names):
    return df.select("row_key", *[col(n) for n in names if n != "row_key"])


@query("prj_01_label_only", "select Classification from cells")
def label_only(spark, d):
    return tables.project_labels(cells(spark, d), "Classification")


@query("prj_02_boost_columns", f"""select row_key, source_file, Classification, "Image", {POSITION},
    "CD3: Cell: Median", "CD3: Nucleus: Median", "CD8: Cell: Median", "CD31: Cell: Median", "NA2: Cell: Median",
    "HLA-DR: Cell: Median" from quant""", "quant")
def boost_columns(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.boost_columns(q.columns, Options()))


@query("prj_03_without_pattern", f"""select row_key, source_file, "Image", {POSITION}, Classification, ROI,
    "CD3: Cell: Median", "CD3: Cell: Mean", "CD8: Cell: Median", "CD8: Cell: Mean", "CD31: Cell: Median",
    "CD31: Cell: Max", "NA2: Cell: Median", "HLA-DR: Cell: Median", "Blank: Cell: Max" from quant""", "quant")
def without_pattern(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.without_pattern(q.columns, catalog.PANEL_SKIP_LARGE))


@query("prj_04_panel_markers", 'select row_key, "HLA-DR: Cell: Median" from quant', "quant")
def panel_markers(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.panel_markers(q))


@query("prj_05_marker_columns", f"""select row_key, "Image", {POSITION}, Classification, ROI, "CD3: Cell: Median",
    "CD3: Cell: Mean", "CD3: Nucleus: Median", "CD3: Cytoplasm: Std.Dev." from quant""", "quant")
def marker_columns(spark, d):
    q = quant(spark, d)
    return pick(q, [c for c in catalog.marker_columns(q.columns, "cd3", "Classification") if c != "row_key"])


ALL_FEATURES = """"CD3: Cell: Median", "CD3: Cell: Mean", "CD3: Nucleus: Median", "CD3: Cytoplasm: Std.Dev.",
    "CD8: Cell: Median", "CD8: Cell: Mean", "CD31: Cell: Median", "CD31: Cell: Max", "NA2: Cell: Median",
    "NA2: Cell: Variance", "HLA-DR: Cell: Median", "Blank: Cell: Max\""""


@query("prj_06_training_features", f"select row_key, {ALL_FEATURES} from quant", "quant")
def training_features(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.training_features(q.columns))


@query("prj_07_metadata_split", f'select row_key, source_file, "Image", {POSITION}, Classification, ROI from quant', "quant")
def metadata_split(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.metadata_columns(q.columns))


@query("prj_08_marker_prefix", 'select row_key, "CD3: Cell: Median", "CD3: Cell: Mean" from quant', "quant")
def marker_prefix(spark, d):
    q = quant(spark, d).withColumn("CD3_label", L.parse_marker(F.col("Classification"), "CD3"))
    return pick(q, catalog.prefixed_columns(q.columns, "CD3", ("Nucleus", "Cytoplasm")))


@query("prj_09_positions", f'select row_key, "Image", {POSITION} from quant', "quant")
def positions(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.position_columns(q.columns))


@query("prj_10_varying", 'select row_key, "CD31: Cell: Max" from quant', "quant")
def varying(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.varying_columns(q, ["CD31: Cell: Max", "Blank: Cell: Max"]))


@query("prj_11_boxcox_columns", """select row_key, "CD3: Cell: Median", "CD3: Cell: Mean", "CD3: Nucleus: Median",
    "CD8: Cell: Median", "CD8: Cell: Mean", "CD31: Cell: Median", "CD31: Cell: Max", "NA2: Cell: Median",
    "HLA-DR: Cell: Median", "Blank: Cell: Max" from quant""", "quant")
def boxcox_columns(spark, d):
    q = quant(spark, d)
    return pick(q, catalog.boxcox_columns(catalog.feature_columns(q.columns)))


@query("prj_12_reorder", f"""select "Image", {POSITION}, max(ROI) as "ROI", max("CD3: Cell: Median") as "CD3: Cell: Median"
    from (select *, row_number() over (partition by "Image", {POSITION} order by row_key) as r from quant) t
    where r = 1 group by 1, 2, 3""", "quant")
def reorder(spark, d):
    q = quant(spark, d)
    first = merging.first_per_key(q, [merging.cell_key()], [F.col("row_key")])
    return merging.join_context(first.select(col("CD3: Cell: Median"), X, Y, "Image"), q, ["ROI"])


@query("prj_13_rename", """select "Image" as Image, x_um, y_um, prediction as "Prediction_CD3" from scored
    where marker = 'CD3'""", "scored")
def rename(spark, d):
    s = scored(spark, d).filter("marker = 'CD3'")
    named = s.select(*KEY, F.col("prediction").alias(merging.prediction_name("CD3", 0)))
    return named.toDF(*[merging.strip_index(c) for c in named.columns])


@query("prj_14_constant_group", "select 'all' as grp, count(*) as n from cells")
def constant_group(spark, d):
    df, group = stats.with_group(cells(spark, d), "Batch")
    return df.groupBy(col(group).alias("grp")).agg(F.count("*").alias("n"))


@query("flt_01_label_present", "select row_key, Classification from cells where Classification is not null")
def label_present(spark, d):
    return cells(spark, d).filter(F.col("Classification").isNotNull()).select("row_key", "Classification")


@query("flt_02_carrying_label", "select distinct row_key from tok where label = 'CD31+'", "tok")
def carrying_label(spark, d):
    return cells(spark, d).filter(F.array_contains(L.tokens(F.col("Classification")), "CD31+")).select("row_key")


@query("flt_03_low_rows", """select m.row_key, m.feature from melted m join thr t
    on t.source_file = m.source_file and t.feature = m.feature where m.v <= t.threshold""", "melted thr")
def low_rows(spark, d):
    c = cells(spark, d)
    limit = settle(boosting.thresholds(c, BASIC, 12.0).groupBy("source_file").agg(
        *[F.max(F.when(F.col("feature") == b, F.col("threshold"))).alias(f"t_{b}") for b in BASIC]))
    near = attach(c, limit, ["source_file"])
    low = F.filter(F.array(*[F.when(F.col(b) <= F.col(f"t_{b}"), F.lit(b)) for b in BASIC]), lambda x: x.isNotNull())
    return near.select("row_key", F.explode(low).alias("feature"))


@query("flt_04_parsed_label", """select row_key, max(case when label = 'CD8+' then 1 else 0 end)::bigint as value from tok
    where label in ('CD8+', 'CD8-') group by 1""", "tok")
def parsed_label(spark, d):
    value = L.parse_marker(F.col("Classification"), "CD8").cast("long")
    return cells(spark, d).select("row_key", value.alias("value")).filter("value is not null")


@query("flt_06_positioned", "select row_key, x_um, y_um from cells where na2_cell_median <> 0 and cd31_cell_median <> 0")
def positioned(spark, d):
    c = cells(spark, d).withColumns({"x_um": F.expr("case when na2_cell_median <> 0 then x_um end"),
                                     "y_um": F.expr("case when cd31_cell_median <> 0 then y_um end")})
    return c.dropna(subset=["x_um", "y_um"]).select("row_key", "x_um", "y_um")


@query("flt_07_finite", """select row_key, case when na2_cell_median > 0 and cd31_cell_median <> 3 then
    cd8_cell_median else 0 end as value from cells""")
def finite(spark, d):
    v = F.when(F.col("na2_cell_median") == 0, F.lit(float("inf"))).when(
        F.col("cd31_cell_median") == 3, F.lit(float("nan"))).otherwise(F.col("cd8_cell_median"))
    return cells(spark, d).select("row_key", numeric.finite_or_zero(v).alias("value"))


@query("flt_08_class_guard", """select marker, count(distinct label)::bigint as classes, case when count(distinct label) < 2
    then 'fewer than two classes' end as reason from train group by 1""", "train")
def class_guard(spark, d):
    return training.class_guard(training.training_rows(cells(spark, d)),
                                {"CD3": 1, "CD8": 1, "CD31": 1, "FOXP3": 0})


@query("flt_09_label_gate", "select count(*) as total from tok", "tok")
def label_gate(spark, d):
    n = counts.token_counts(cells(spark, d))
    counts.require_labels(n)
    return counts.total_labels(n)


@query("flt_10_missing_features", """select row_key, 'GHOST' as marker, cast(null as integer) as prediction,
    cast(null as double) as probability from cells""")
def missing_features(spark, d):
    ghost = scoring.MarkerModel("GHOST", None, ("ghost_a", "ghost_b"))
    return scoring.score(cells(spark, d), [ghost], ["row_key"])


@query("flt_11_file_without_counts", "select row_key, Classification from cells where source_file = 'batch_1.tsv'")
def file_without_counts(spark, d):
    c = cells(spark, d)
    counted = c.select("source_file").distinct().filter("source_file <> 'batch_1.tsv'")
    done = boosting.boost(c, CELL_OPTIONS, BASIC, MARKERS, counted)
    return done.filter("source_file = 'batch_1.tsv'").select("row_key", "Classification")
