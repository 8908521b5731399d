"""Directory of tables to boosted, normalised tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.operators import boosting, gating, power, stats
from cellweft.operators import counts as C
from cellweft.session import col, settle
from cellweft.settings import Options
from cellweft.sources import catalog


@dataclass
class Prepared:
    table: DataFrame
    label_counts: DataFrame
    label_table: DataFrame
    unmatched: DataFrame
    boxcox_record: DataFrame | None
    gating_summary: DataFrame


def preprocess(df: DataFrame, features: list[str], options: Options) -> tuple[DataFrame, DataFrame]:
    """Gate, then optionally Yeo-Johnson. Returns the table and the gating summary."""
    if not features:
        return df, gating.empty_summary(df, [])
    if options.run_gating:
        gates = gating.fit(df, features)
        summary = gating.summary(df, gates)
        out = gating.apply(df, gates)
    else:
        summary = gating.empty_summary(df, features)
        out = df.select(*[gating.value_of(c).alias(c) if c in features else col(c) for c in df.columns])
    if options.run_power:
        out = power.apply(out, power.fit(out, features, "yeo"), "yeo")
    return out, summary


def prepare(df: DataFrame, options: Options = Options()) -> Prepared:
    """Count and gate the labels, boost negatives, drop unmatched labels, transform, gate.

    The fits between the steps are small tables or numbers; cells stay one lazy table that is
    stored once after boosting and once at the end.
    """
    counts = settle(C.token_counts(df, options.label_column, options.delimiter), "label-counts")
    C.require_labels(counts)
    medians = catalog.median_columns(catalog.feature_columns(df.columns))
    table = C.label_table(df, options.label_column, options.delimiter)
    narrow = df.select(*[col(c) for c in catalog.boost_columns(df.columns, options)])
    tokens = settle(boosting.unmatched_tokens(narrow, options, medians), "unmatched")
    unmatched = boosting.unmatched_counts(narrow, tokens, options)
    boosted = settle(boosting.drop_unmatched(boosting.boost(narrow, options, medians), options, medians), "boosted")
    record = None
    if options.use_boxcox:
        targets = catalog.boxcox_columns(medians)
        fits = power.fit(boosted, targets)
        record = power.record(boosted, fits)
        boosted = power.apply(boosted, fits)
    out, summary = preprocess(boosted, medians, options)
    return Prepared(settle(out, "prepared"), counts, table, unmatched, record, summary)
