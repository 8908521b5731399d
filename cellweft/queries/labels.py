"""Label operators: counts, sets, boosting, training rows and the label functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.functions import labels as L
from cellweft.functions import text
from cellweft.operators import boosting, counts, training
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import CELL_OPTIONS, MARKERS
from cellweft.session import settle
from cellweft.sources import catalog
from cellweft.sources.cells import BASIC, cells, table

LABELS = ["CD3+", "CD3-", "CD31+", "CD31-", "CD8+", "CD8-", "FOXP3+"]
def _c():
    return F.col("Classification")


@query("agg_01_token_counts", "select source_file as file, count(*) as label_count from tok group by 1", "tok")
def token_counts(spark, d):
    return counts.token_counts(cells(spark, d))


@query("agg_02_label_table", "select source_file as file, " + ", ".join(
    f"count(*) filter (where label = '{v}') as \"{v}\"" for v in LABELS) + " from tok group by 1", "tok")
def label_table(spark, d):
    return counts.label_table(cells(spark, d))


@query("agg_03_total", "select count(*) as total from tok", "tok")
def total(spark, d):
    return counts.total_labels(counts.token_counts(cells(spark, d)))


@query("agg_04_label_summary", """select label as "Label", count(*) as total,
    count(*) filter (where label like '%+') as "+", count(*) filter (where label like '%-') as "-"
    from signed group by 1""", "signed")
def label_summary(spark, d):
    return counts.label_summary(cells(spark, d))


@query("agg_13_rows_per_file", "select source_file, count(*) as n_rows from cells group by 1")
def rows_per_file(spark, d):
    return counts.rows_per_file(cells(spark, d))


@query("agg_15_unmatched_counts", """select label, count(*) as n from tok where label in ('FOXP3+', 'FOXP3-')
    group by 1""", "tok")
def unmatched_counts(spark, d):
    c = cells(spark, d)
    return boosting.unmatched_counts(c, boosting.unmatched_tokens(c, CELL_OPTIONS, BASIC, MARKERS), CELL_OPTIONS)


@query("agg_22_group_by_marker", """select left(marker_file, length(marker_file) - 9) as marker, sum(n)::bigint as n from
    (select concat(marker, '_', substr(md5(source_file), 1, 8)) as marker_file, count(*) as n from train group by 1) f
    group by 1""", "train")
def group_by_marker(spark, d):
    rows = training.training_rows(cells(spark, d))
    return rows.groupBy("marker").agg(F.count("*").alias("n"))


@query("set_02_marker_pairs", """select left(label, length(label) - 1) as marker, bool_or(label like '%+') as has_plus,
    bool_or(label like '%-') as has_minus, bool_or(label like '%+') and bool_or(label like '%-') as paired
    from signed group by 1""", "signed")
def marker_pairs(spark, d):
    return counts.marker_pairs(counts.distinct_labels(cells(spark, d)))


@query("set_03_distinct_labels", "select distinct label from tok where label <> ''", "tok")
def distinct_labels(spark, d):
    return counts.distinct_labels(cells(spark, d))


@query("srt_01_sorted_labels", "select label, row_number() over (order by label)::bigint as position from "
       "(select distinct label from tok) t", "tok")
def sorted_labels(spark, d):
    names = [c for c in counts.label_table(cells(spark, d)).columns if c != "file"]
    order = F.array(*[F.lit(n) for n in names])
    return counts.distinct_labels(cells(spark, d)).withColumn(
        "position", F.array_position(order, F.col("label")).cast("long"))


@query("join_06_counts_lookup", """select c.row_key, coalesce(n.n, 0) as n from cells c left join cnt n
    on n.source_file = c.source_file and n.label = 'CD31-'""", "cells cnt")
def counts_lookup(spark, d):
    from cellweft.session import attach
    c = cells(spark, d)
    own = settle(counts.label_counts(c).filter("label = 'CD31-'").select(F.col("file").alias("source_file"), "n"))
    return attach(c.select("row_key", "source_file"), own, ["source_file"]).select(
        "row_key", F.coalesce("n", F.lit(0)).alias("n"))


def _match(kind: str, condition: str):
    @query(f"join_08_match_{kind}", f"""select marker, name as original_name from (
        select m.marker, k.name, row_number() over (partition by m.marker order by
          case when contains(k.name, 'Cell:') then 0 else 1 end, k.pos) as r
        from (select distinct left(label, length(label) - 1) as marker from signed) m
        join (select 1 as pos, 'CD3: Cytoplasm: Median' as name union all select 2, 'CD31: Cell: Median'
              union all select 3, 'CD3: Cell: Median' union all select 4, 'CD8: Cell: Median'
              union all select 5, 'Ratio CD8.CD3') k on {condition}) t where r = 1""", "signed")
    def run(spark, d):
        names = ["CD3: Cytoplasm: Median", "CD31: Cell: Median", "CD3: Cell: Median", "CD8: Cell: Median", "Ratio CD8.CD3"]
        markers = counts.marker_pairs(counts.distinct_labels(cells(spark, d))).select("marker")
        return catalog.match_columns(markers, catalog.frame(spark, names), kind).select("marker", "original_name")
    return run


_match("exact", "k.name like m.marker || ':%' and position(':' in k.name) = length(m.marker) + 1")
_match("contains", "contains(k.name, m.marker)")
_match("prefix", "starts_with(k.name, m.marker)")
_match("delimited", "regexp_matches(k.name, '(^|[_.: -])' || m.marker || '([_.: -]|$)')")


@query("win_01_boost_picks", "select source_file, label, row_key, r as rank from picks", "picks")
def boost_picks(spark, d):
    c = cells(spark, d)
    targets = settle(boosting.negative_targets(c, CELL_OPTIONS, BASIC, MARKERS), "targets")
    return boosting.pick_cells(c, targets, BASIC, CELL_OPTIONS).withColumn("rank", F.col("rank").cast("long"))


@query("ml_03_boosted_labels", """select c.row_key, case when p.add is null then c.Classification
    when t.label is null then p.add else t.label || '|' || p.add end as Classification
    from cells c left join (select row_key, string_agg(label, '|' order by label) as add from picks group by 1) p
      on p.row_key = c.row_key
    left join (select row_key, string_agg(trim(t), '|') as label from (
        select row_key, unnest(string_split(Classification, '|')) as t from cells) u group by 1) t
      on t.row_key = c.row_key""", "cells picks")
def boosted_labels(spark, d):
    return boosting.boost(cells(spark, d), CELL_OPTIONS, BASIC, MARKERS).select("row_key", "Classification")


@query("ml_04_drop_unpaired", """select c.row_key, case when c.Classification is null then null else
    coalesce(t.label, '') end as Classification from cells c left join (
      select row_key, string_agg(label, '|' order by pos) as label from (
        select row_key, trim(unnest(string_split(Classification, '|'))) as label,
               unnest(range(len(string_split(Classification, '|')))) as pos
        from cells where Classification is not null) u where label not in ('FOXP3+', 'FOXP3-') group by 1) t
    on t.row_key = c.row_key""")
def drop_unpaired(spark, d):
    return boosting.drop_unmatched(cells(spark, d), CELL_OPTIONS, BASIC, MARKERS).select("row_key", "Classification")


@query("ml_01_training_rows", """select row_key, marker, label, label as key_label, false as conflict from train""", "train")
def training_rows(spark, d):
    return training.training_rows(cells(spark, d), keep=["row_key"]).select(
        "row_key", "marker", "label", "key_label", "conflict")


@query("ml_02_small_tables", """select marker, case when marker in ('CD3', 'CD8', 'CD31') then 6 else 5 end::bigint as n_columns,
    marker not in ('CD3', 'CD8', 'CD31') as small from (select distinct marker from train) t""", "train")
def small_tables(spark, d):
    c = cells(spark, d)
    named = c.select("row_key", "source_file", "Image", F.col("x_um").alias("Centroid X µm"),
                     F.col("y_um").alias("Centroid Y µm"), "Classification",
                     *[F.col(b).alias(f"{MARKERS[b]}: Cell: Median") for b in BASIC])
    return training.small_tables(named).select("marker", "n_columns", "small")


@query("fn_01_tokens", "select row_key, label as token from tok", "tok")
def tokens(spark, d):
    return cells(spark, d).select("row_key", F.explode(L.tokens(_c())).alias("token"))


@query("fn_02_marker_of", "select row_key, rtrim(label, '+-') as marker from tok", "tok")
def marker_of(spark, d):
    t = cells(spark, d).select("row_key", F.explode(L.tokens(_c())).alias("t"))
    return t.select("row_key", L.marker_of(F.col("t")).alias("marker"))


@query("fn_03_sign_of", """select row_key, label, case when label like '%+' then 1 when label like '%-' then 0 end as sign
    from tok""", "tok")
def sign_of(spark, d):
    t = cells(spark, d).select("row_key", F.explode(L.tokens(_c())).alias("label"))
    return t.select("row_key", "label", L.sign_of(F.col("label")).alias("sign"))


@query("fn_04_parse_marker", """select c.row_key, case when t.label like '%+' then 1 when t.label like '%-' then 0 end as value
    from cells c left join (select row_key, max(label) as label from tok where label in ('CD31+', 'CD31-') group by 1) t
    on t.row_key = c.row_key""", "cells tok")
def parse_marker(spark, d):
    return cells(spark, d).select("row_key", L.parse_marker(_c(), "CD31").alias("value"))


@query("fn_04_parse_map", "select row_key, left(label, length(label) - 1) as marker, right(label, 1) as sign from signed", "signed")
def parse_map(spark, d):
    return cells(spark, d).select("row_key", F.explode(L.parse_map(_c())).alias("marker", "sign"))


@query("fn_05_key_label", """select c.row_key, coalesce(t.label, '') as key_label from cells c left join
    (select row_key, string_agg(label, '|') as label from tok where lower(label) in ('cd3', 'cd3+', 'cd3-') group by 1) t
    on t.row_key = c.row_key where c.Classification is not null""", "cells tok")
def key_label(spark, d):
    return cells(spark, d).filter(_c().isNotNull()).select("row_key", L.key_label(_c(), F.lit("cd3")).alias("key_label"))


@query("fn_06_append_token", """select c.row_key, case when t.label is null then 'CD8-'
    when list_contains(t.parts, 'CD8-') then t.label else t.label || '|CD8-' end as label from cells c left join
    (select row_key, string_agg(label, '|' order by pos) as label, list(label) as parts from (
        select row_key, trim(unnest(string_split(Classification, '|'))) as label,
               unnest(range(len(string_split(Classification, '|')))) as pos from cells
        where Classification is not null) u group by 1) t on t.row_key = c.row_key""")
def append_token(spark, d):
    return cells(spark, d).select("row_key", L.append_tokens(_c(), F.array(F.lit("CD8-"))).alias("label"))


@query("fn_07_remove_token", """select c.row_key, case when c.Classification is not null then coalesce(t.label, '') end as label
    from cells c left join (select row_key, string_agg(label, '|' order by pos) as label from (
        select row_key, trim(unnest(string_split(Classification, '|'))) as label,
               unnest(range(len(string_split(Classification, '|')))) as pos from cells
        where Classification is not null) u where label <> 'CD3+' group by 1) t on t.row_key = c.row_key""")
def remove_token(spark, d):
    return cells(spark, d).select("row_key", L.remove_tokens(_c(), F.array(F.lit("CD3+"))).alias("label"))


@query("fn_08_file_id", """select o_orderkey, concat('scan', o_orderkey % 7, '_subset', o_custkey % 5, '_subset', o_custkey % 5)
    as file_id, regexp_replace(regexp_replace(o_orderpriority, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as safe
    from orders""", "")
def file_id(spark, d):
    path = F.concat(F.lit("/data/scan"), (F.col("o_orderkey") % 7), F.lit("_subset"), (F.col("o_custkey") % 5), F.lit(".ome.tif"))
    return table(spark, d, "orders").select("o_orderkey", text.file_id(path).alias("file_id"),
                                            text.safe_name(F.col("o_orderpriority")).alias("safe"))


@query("fn_09_sign_label", """select row_key, case when cd3_cell_median >= 25 then 'CD3+' else 'CD3-' end as label from cells""")
def sign_label(spark, d):
    return cells(spark, d).select("row_key", L.sign_label("CD3", (F.col("cd3_cell_median") >= 25).cast("int")).alias("label"))


@query("fn_14_stem", """select o_orderkey, concat('table ', o_orderkey % 7, '.tsv') as name,
    concat('table ', o_orderkey % 7) as stem from orders""", "")
def stem(spark, d):
    path = F.concat(F.lit("/data/sub dir/table "), (F.col("o_orderkey") % 7), F.lit(".tsv"))
    return table(spark, d, "orders").select("o_orderkey", text.basename(path).alias("name"), text.stem(path).alias("stem"))


@query("fn_15_token_sizes", """select c.row_key, coalesce(t.n, -1)::bigint as n, coalesce(t.has, false) as has,
    coalesce(t.hits, 0)::bigint as hits from cells c left join (select row_key, count(*) as n, bool_or(label = 'CD8+') as has,
    count(*) filter (where label = 'CD8+') as hits from tok group by 1) t on t.row_key = c.row_key""", "cells tok")
def token_sizes(spark, d):
    t = L.tokens(_c())
    return cells(spark, d).select(
        "row_key", F.coalesce(F.size(t), F.lit(-1)).cast("long").alias("n"),
        F.coalesce(F.array_contains(t, "CD8+"), F.lit(False)).alias("has"),
        F.greatest(F.coalesce(L.count_token(_c(), F.lit("CD8+")), F.lit(0)), F.lit(0)).cast("long").alias("hits"))


@query("fn_16_json", """select source_file, concat('{"file":"', source_file, '","label_count":', n, '}') as record from
    (select source_file, count(*) as n from tok group by 1) t""", "tok")
def json_record(spark, d):
    n = counts.token_counts(cells(spark, d))
    return n.select(F.col("file").alias("source_file"), F.to_json(F.struct("file", "label_count")).alias("record"))
