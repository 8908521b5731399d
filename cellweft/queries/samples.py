"""Seeded choices, splits, set operations and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.functions.keys import cell_key
from cellweft.operators import metrics, ranks, reports, sampling, stats
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import KEY, scored, truth
from cellweft.sources import tables
from cellweft.sources.cells import BASIC, cells, table


@query("win_02_first_per_key", """select row_key, Image, x_um, y_um from (select *, row_number() over (
    partition by Image, x_um, y_um order by row_key) as r from cells) t where r = 1""")
def first_per_key(spark, d):
    c = cells(spark, d)
    return ranks.first_per_key(c, [cell_key(KEY)], [F.col("row_key")]).select("row_key", *KEY)


@query("win_03_sample_fraction", "select row_key from cells where substr(md5('42-' || row_key), 1, 8) < '0ccccccc'")
def sample_fraction(spark, d):
    return sampling.sample_fraction(cells(spark, d), 0.05).select("row_key")


@query("win_03_sample_exact", """select row_key from (select row_key, row_number() over (order by md5('42-' || row_key)) as r,
    count(*) over () as n from cells) t where r <= round_even(n * 0.05, 0)""")
def sample_exact(spark, d):
    return sampling.sample_exact(cells(spark, d), 0.05).select("row_key")


@query("win_03_sample_rows", "select row_key from cells order by md5('421-' || row_key) limit 5000")
def sample_rows(spark, d):
    return sampling.sample_rows(cells(spark, d)).select("row_key")


@query("win_04_stratified_split", """select row_key, Classification, r <= ceil(n * 0.3) as is_test from (select row_key,
    Classification, row_number() over (partition by Classification order by md5('42-' || row_key)) as r,
    count(*) over (partition by Classification) as n from cells) t""")
def stratified_split(spark, d):
    return sampling.stratified_split(cells(spark, d), "Classification").select("row_key", "Classification", "is_test")


@query("win_05_group_split", """with f as (select source_file, row_number() over (order by md5('421-' || source_file)) as r,
    count(*) over () as n from (select distinct concat('slide_', l_suppkey % 23) as source_file from lineitem) t),
    g as (select source_file, row_number() over (order by md5('422-' || source_file)) as r, count(*) over () as n
      from f where r > ceil(n * 0.3))
    select l.source_file, l.n, case when f.r <= ceil(f.n * 0.3) then 'test' when g.r <= ceil(g.n * 0.25) then 'validation'
      else 'train' end as part from (select concat('slide_', l_suppkey % 23) as source_file, count(*) as n from lineitem group by 1) l
    join f on f.source_file = l.source_file left join g on g.source_file = l.source_file""", "")
def group_split(spark, d):
    rows = table(spark, d, "lineitem").select(F.concat(F.lit("slide_"), (F.col("l_suppkey") % 23).cast("string")).alias("source_file"))
    return sampling.group_split(rows).groupBy("source_file", "part").agg(F.count("*").alias("n"))


@query("win_06_shuffle_splits", "select marker, label, " + ", ".join(
    f"count(*) filter (where r{i} <= ceil(n * 0.1)) as fold_{i}" for i in range(3)) + """ from (select *, """ + ", ".join(
    f"row_number() over (partition by label order by md5('911.{i}-' || row_key)) as r{i}" for i in range(3)) + """,
    count(*) over (partition by label) as n from truth where marker = 'CD3') t group by 1, 2""", "truth")
def shuffle_splits(spark, d):
    t = truth(spark, d).filter("marker = 'CD3'")
    return sampling.shuffle_splits(t, "label", 3).groupBy("marker", "label").agg(
        *[F.sum(F.col(f"fold_{i}").cast("long")).alias(f"fold_{i}") for i in range(3)])


@query("win_06_group_folds", """with recursive s as (select concat('slide_', l_suppkey % 23) as g,
      [count(*) filter (where l_quantity <= 40), count(*) filter (where l_quantity > 40)] as n from lineitem group by 1),
    t as (select [sum(n[1]), sum(n[2])] as total from s),
    o as (select *, row_number() over (order by round(abs(n[1] - n[2]) / 2e0, 9) desc, n[1] + n[2] desc, g) as i from s),
    w(i, held, fold) as (select 0::bigint, [[0::hugeint, 0::hugeint] for x in range(5)], 0::bigint union all
      select i, held, fold from (select o.i, f as fold, h.held, row_number() over (partition by o.i order by
          round((list_stddev_pop([x[1] / total[1] for x in h.held]) + list_stddev_pop([x[2] / total[2] for x in h.held])) / 2, 12),
          w.held[f + 1][1] + w.held[f + 1][2], f) as place
        from w join o on o.i = w.i + 1, t, (select unnest(range(5)) as f) f,
          lateral (select [case when k - 1 = f then [w.held[k][1] + o.n[1], w.held[k][2] + o.n[2]] else w.held[k] end
            for k in range(1, 6)] as held) h) c where place = 1)
    select g as source_file, n[2]::bigint as positives, fold from w join o using (i)""", "")
def group_folds(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.concat(F.lit("slide_"), (F.col("l_suppkey") % 23).cast("string")).alias("source_file"),
        (F.col("l_quantity") > 40).cast("int").alias("label"))
    return sampling.group_folds(rows, "label").groupBy("source_file", F.col("fold").cast("long").alias("fold")).agg(
        F.sum("label").alias("positives"))


@query("win_06_row_folds", """select row_key, ((row_number() over (partition by label order by md5('421-' || row_key)) - 1) % 3)::bigint
    as fold from truth where marker = 'CD3'""", "truth")
def row_folds(spark, d):
    t = truth(spark, d).filter("marker = 'CD3'")
    return sampling.row_folds(t, "label").select("row_key", F.col("fold").cast("long").alias("fold"))


@query("win_08_first_groups", """select row_key, Image from cells where Image in (select Image from (select Image,
    min(row_key) as f from cells group by 1) t order by f limit 5)""")
def first_groups(spark, d):
    return stats.first_groups(cells(spark, d), "Image", 5).select("row_key", "Image")


@query("srt_05_head", "select row_key, source_file, Image from cells order by row_key limit 5")
def head(spark, d):
    return reports.first_rows(cells(spark, d)).select("row_key", "source_file", "Image")


@query("srt_06_label_order", """select label, row_number() over (order by rtrim(label, '+-'),
    case when label like '%+' then 1 else 0 end)::bigint as position from (select distinct label from signed) t""", "signed")
def label_order(spark, d):
    from pyspark.sql import Window

    from cellweft.operators.counts import distinct_labels
    # One row per distinct label.
    rank = F.row_number().over(Window.orderBy(*reports.label_order("label")))
    return distinct_labels(cells(spark, d)).select("label", rank.cast("long").alias("position"))


@query("set_01_outer_union", """select row_key, cd3_cell_median, cast(null as double) as cd8_cell_median from cells
    where source_file = 'batch_0.tsv' union all select row_key, null, cd8_cell_median from cells where source_file <> 'batch_0.tsv'""")
def outer_union(spark, d):
    c = cells(spark, d)
    return tables.unite([c.filter("source_file = 'batch_0.tsv'").select("row_key", "cd3_cell_median"),
                         c.filter("source_file <> 'batch_0.tsv'").select("row_key", "cd8_cell_median")])


@query("set_05_fill_text", """select row_key, case when Image = 'img_0' then 'NA' else Image end as Image, 'NA' as extra
    from cells where source_file = 'batch_0.tsv' union all
    select row_key, 'NA', source_file from cells where source_file <> 'batch_0.tsv'""")
def fill_text(spark, d):
    c = cells(spark, d)
    a = c.filter("source_file = 'batch_0.tsv'").select("row_key", F.expr("case when Image <> 'img_0' then Image end").alias("Image"))
    return tables.unite([a, c.filter("source_file <> 'batch_0.tsv'").select("row_key", F.col("source_file").alias("extra"))], "NA")


@query("set_04_flag_union", """select row_key, cd3_cell_median > (select quantile_cont(cd3_cell_median, 0.98) from cells)
    or cd8_cell_median > (select quantile_cont(cd8_cell_median, 0.98) from cells) as is_outlier from cells""")
def flag_union(spark, d):
    from cellweft.operators.outliers import flag_top
    both = flag_top(flag_top(cells(spark, d), "cd3_cell_median", 0.02, "a"), "cd8_cell_median", 0.02, "b")
    return both.select("row_key", (F.col("a") | F.col("b")).alias("is_outlier"))
