"""The tables that reports are drawn from."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.functions.labels import sign_label
from cellweft.functions.numeric import fill_zero, finite_or_null
from cellweft.operators import gating, power, stats
from cellweft.operators.merging import inverted, probability_intensity
from cellweft.operators.counts import crosstab
from cellweft.operators.sampling import sample_exact
from cellweft.operators.scaling import project
from cellweft.session import attach, col, settle
from cellweft.settings import CELL_KEY, IMAGE
from cellweft.sources import catalog


def table_profile(df: DataFrame, names: int = 40, numerics: int = 30) -> dict[str, DataFrame]:
    """Shape, first column names, first rows, describe of the first numerics, a 40-bin histogram."""
    spark = df.sparkSession
    own = [c for c in df.columns if c not in ("row_key", "ordinal")]
    numbers = [c for c in catalog.numeric_columns(df) if c in own][:numerics]
    out = {
        "shape": df.agg(F.count("*").cast("long").alias("n_rows")).withColumn("n_columns", F.lit(len(own))),
        "columns": spark.createDataFrame([(i, c) for i, c in enumerate(own[:names])], "position int, name string"),
        "head": first_rows(df, 5),
    }
    if numbers:
        out["describe"] = stats.describe(df, [], numbers)
        out["histogram"] = stats.histogram(df, [], numbers[:1], 40)
    return out


def first_rows(df: DataFrame, n: int = 5, ordinal: str = "row_key") -> DataFrame:
    return df.orderBy(col("ordinal" if "ordinal" in df.columns else ordinal)).limit(n)


def panel_report(df: DataFrame, markers: list[str] | None = None, bins: int = 20) -> dict[str, DataFrame]:
    """Statistics and histograms of the panel's markers per file."""
    markers = markers if markers is not None else catalog.panel_markers(df)
    if not markers:
        return {}
    return {"statistics": stats.describe(df, ["source_file"], markers),
            "histograms": stats.histogram(df, ["source_file"], markers, bins)}


def nucleus_column(columns: list[str], nucleus: str) -> str:
    hits = [c for c in columns if nucleus in c]
    if not hits:
        raise ValueError(f"no column for the nucleus marker {nucleus!r} among {columns}")
    return hits[0]


def value_pairs(df: DataFrame, fits: list[power.Fit], nucleus: str, fraction: float = 0.05,
                seed: int = 42) -> DataFrame:
    """(row_key, Feature, Mark, Original_Value, Transformed_Value) of a sample of rows, for each
    intensity column and the nucleus column beside it."""
    names = [f.feature for f in fits]
    nuc = nucleus_column(names, nucleus)
    picked = sample_exact(df.select("row_key", *[col(n) for n in names]), fraction, seed)
    done = power.apply(picked, fits)
    both = picked.alias("a").join(done.alias("b"), "row_key")
    rows = []
    for n in names:
        for source, mark in ((nuc, nucleus), (n, n.split(":")[0])):
            q = source.replace("`", "``")
            rows.append(F.struct(F.lit(n).alias("Feature"), F.lit(mark).alias("Mark"),
                                 F.col(f"a.`{q}`").cast("double").alias("Original_Value"),
                                 F.col(f"b.`{q}`").alias("Transformed_Value")))
    return both.select("row_key", F.inline(F.array(*rows)))


def density(df: DataFrame, features: list[str], points: int = 200) -> DataFrame:
    """(feature, x, density): Gaussian density on a grid around the values, from bins that are fine where they are dense.

    Missing and non-finite values take no part; a feature without values has no rows.
    """
    value = lambda f: finite_or_null(stats.number(f))
    binned = gating.sketch(df, features, gating.first_binnings(df, features, value), value)

    def curve(pdf: pd.DataFrame) -> pd.DataFrame:
        w, s = pdf["n"].to_numpy(float), pdf["s"].to_numpy(float)
        x, inner = pdf["c"].to_numpy(float) + s / w, np.maximum(pdf["ss"].to_numpy(float) - s * s / w, 0)
        n, lo, hi = w.sum(), float(pdf["lo"].min()), float(pdf["hi"].max())
        mean = (w * x).sum() / n
        sd = np.sqrt(((w * (x - mean) ** 2).sum() + inner.sum()) / max(n - 1, 1))
        h = sd * n ** (-0.2) or 1.0
        span = hi - lo or 1.0
        grid = np.linspace(lo - 0.5 * span, hi + 0.5 * span, points)
        y = gating.kernel_sums(grid, x, w, inner / w, h) / (n * h * np.sqrt(2 * np.pi))
        return pd.DataFrame({"feature": [features[int(pdf["i"].iloc[0])]] * points, "x": grid, "density": y})

    return binned.groupBy("i").applyInPandas(curve, "feature string, x double, density double")


def boxcox_report(df: DataFrame, group: str, nucleus: str, object_type: str = "CellObject", fraction: float = 0.05,
                  tables: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Record, box statistics before and after, mean pairs and value pairs against the nucleus.

    ``tables`` names those to make (all unless given): samples and bins of the others take passes of their own.
    """
    df, group = stats.with_group(df, group)
    targets = catalog.boxcox_columns(catalog.feature_columns(df.columns))
    shown = [c for c in targets if "Mean" in c or "Median" in c]
    # All passes but that of the sample read these columns.
    values = settle(df.select(col(group), *[col(c) for c in targets if c != group]), "boxcox-values")
    plotted = catalog.varying_columns(values, catalog.intensity_columns(shown, object_type))
    nucleus_column(plotted, nucleus)
    fits = power.fit(values, targets)
    after = power.apply(values, fits)
    own = [f for f in fits if f.feature in shown]
    record = functools.cache(lambda: settle(power.record(values, fits), "boxcox-record"))
    make = {
        "record": record,
        "means": lambda: record().filter("Lambda <> 'Failed'").select("Feature", "Pre_Mean", "Post_Mean"),
        "before": lambda: stats.box_stats(values, group, shown),
        "after": lambda: stats.box_stats(after, group, shown),
        "pairs": lambda: value_pairs(df, own, nucleus, fraction),
        "density_before": lambda: density(values, plotted),
        "density_after": lambda: density(after, plotted),
    }
    return {name: one() for name, one in make.items() if tables is None or name in tables}


def gated_histogram(summary: DataFrame) -> DataFrame:
    """30 bins of percent_gated over features."""
    return stats.histogram(summary, [], ["percent_gated"], 30)


def spatial_table(merged: DataFrame, markers: list[str], key: tuple[str, ...] = CELL_KEY,
                  group: list[str] | None = None) -> DataFrame:
    """(image, x, inverted y, marker, label) per cell and marker."""
    placed = settle(merged.dropna(subset=[key[1], key[2]]), "placed")
    placed = inverted(placed, key[2], group or [key[0]], "Inverted " + key[2])
    rows = F.array(*[F.struct(F.lit(m).alias("marker"), sign_label(m, col(f"Prediction_{m}")).alias("label"))
                     for m in markers])
    return placed.select(*[col(k) for k in key], col("Inverted " + key[2]), F.inline(rows))


# Fixed values: '-' is drawn before '+'.
def label_order(label: str = "label"):
    return [F.regexp_replace(col(label), r"[+-]+$", ""), col(label).endswith("+")]


def logistic_curves(df: DataFrame, groups: list[str], x: str, y: str, rounds: int = 25,
                    tolerance: float = 1e-6) -> DataFrame:
    """(groups..., n, intercept, slope): logistic curve of a fraction on a value.

    All groups are fitted together: each Newton round is one grouped aggregation of five sums with
    the last coefficients attached, so many markers and images cost no more rounds than one. Rounds read counts of equal rows.
    """
    keys = [col(g) for g in groups]
    data = df.select(*keys, col(x).cast("double").alias("__x"), col(y).cast("double").alias("__y")).filter(
        F.col("__x").isNotNull() & F.col("__y").isNotNull())
    data = settle(data.groupBy(*keys, "__x", "__y").agg(F.count("*").cast("double").alias("__w")), "curve-rows")
    weighted = lambda v: F.sum(F.col("__w") * v) / F.sum("__w")
    base = settle(data.groupBy(*keys).agg(
        F.sum("__w").cast("long").alias("n"), weighted(F.col("__x")).alias("mx"), weighted(F.col("__y")).alias("my")), "curve-means")
    spread = attach(data, base.select(*keys, "mx"), groups, "inner").groupBy(*keys).agg(
        F.sqrt(weighted(F.pow(F.col("__x") - F.col("mx"), F.lit(2.0)))).alias("sx"))
    base = settle(attach(base, spread, groups), "curve-base")
    groups_n = base.count()
    scale = F.when(F.col("sx") > 0, F.col("sx")).otherwise(F.lit(1.0))
    start = F.least(F.greatest(F.col("my"), F.lit(1e-6)), F.lit(1 - 1e-6))
    state = base.select(*keys, "n", "mx", scale.alias("sx"), F.ln(start / (1 - start)).alias("a"), F.lit(0.0).alias("b"),
                        F.lit(False).alias("done"))
    for _ in range(rounds):
        near = attach(data, state, groups, "inner", known_rows=groups_n).filter("not done")
        z = (F.col("__x") - F.col("mx")) / F.col("sx")
        p = 1 / (1 + F.exp(-(F.col("a") + F.col("b") * z)))
        w = F.col("__w") * p * (1 - p)
        r = F.col("__w") * (F.col("__y") - p)
        sums = near.groupBy(*keys).agg(F.sum(r).alias("g0"), F.sum(r * z).alias("g1"), F.sum(w).alias("h00"),
                                       F.sum(w * z).alias("h01"), F.sum(w * z * z).alias("h11"))
        h00, h11 = F.col("h00") + 1e-9, F.col("h11") + 1e-9
        det = h00 * h11 - F.col("h01") * F.col("h01")
        da = (h11 * F.col("g0") - F.col("h01") * F.col("g1")) / det
        db = (h00 * F.col("g1") - F.col("h01") * F.col("g0")) / det
        limit = lambda d: F.greatest(F.least(F.coalesce(d, F.lit(0.0)), F.lit(5.0)), F.lit(-5.0))
        state = settle(attach(state, sums, groups, known_rows=groups_n).select(
            *keys, "n", "mx", "sx", (F.col("a") + limit(da)).alias("a"), (F.col("b") + limit(db)).alias("b"),
            (F.greatest(F.abs(limit(da)), F.abs(limit(db))) < tolerance).alias("done")), "curve-state")
        if not state.filter("not done").limit(1).count():
            break
    slope = F.col("b") / F.col("sx")
    return state.select(*keys, "n", (F.col("a") - slope * F.col("mx")).alias("intercept"), slope.alias("slope"))


def probability_rows(predictions: DataFrame, intensities: DataFrame, marker_columns: dict[str, str],
                     key: tuple[str, ...] = CELL_KEY) -> DataFrame:
    """Rows (image, marker, intensity, probability, label). Markers without their column are left out."""
    rows = None
    for marker, column in marker_columns.items():
        if column not in intensities.columns:
            continue
        part = probability_intensity(predictions.filter(F.col("marker") == marker), intensities, column, key)
        part = part.select(col(key[0]), F.lit(marker).alias("marker"), "intensity", "probability",
                           sign_label(marker, F.col("prediction")).alias("label"))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise ValueError("no marker has an intensity column")
    return rows


def probability_curves(rows: DataFrame, image: str = IMAGE) -> DataFrame:
    """One logistic curve per image and marker."""
    return logistic_curves(rows, [image, "marker"], "intensity", "probability")


def outlier_plane(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(row_key, PC1, PC2, is_outlier, label)."""
    return project(df, features, 2).select("row_key", "PC1", "PC2", "is_outlier", col(label).alias("label"))


def long_board(board: DataFrame) -> DataFrame:
    """Leaderboard as (model, metric, value)."""
    names = ["accuracy", "balanced_accuracy", "f1", "roc_auc", "pr_auc"]
    return board.unpivot(["model"], names, "metric", "value")


def abundance(predictions: DataFrame, marker: str) -> DataFrame:
    """Predicted labels per file."""
    return crosstab(predictions, "source_file", "predicted_label", [f"{marker}-", f"{marker}+"])


def run_summary(df: DataFrame, marker: str, parsed: str, outlier: str, selected: str | None) -> DataFrame:
    """One record of a recovery run."""
    per_file = df.groupBy("source_file").agg(
        F.count("*").cast("long").alias("n"), F.sum(col(parsed).isNotNull().cast("long")).alias("p"),
        F.sum((col(parsed).isNotNull() & ~F.coalesce(col(outlier), F.lit(False))).cast("long")).alias("i"))
    return per_file.agg(
        F.lit(marker).alias("marker"), F.array_sort(F.collect_list("source_file")).alias("input_files"),
        F.sum("n").alias("n_rows_total"), F.sum("p").alias("n_rows_parseable_marker"),
        F.sum("i").alias("n_rows_inlier_for_modeling"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_file", "n")))).alias("rows_per_file"),
        F.lit(selected).alias("selected_model"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"))
