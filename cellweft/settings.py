"""Options shared by all operators; the defaults are the documented run defaults."""

from __future__ import annotations

from dataclasses import dataclass

IMAGE = "Image"
X = "Centroid X µm"
Y = "Centroid Y µm"
CELL_KEY = (IMAGE, X, Y)

# Words that mark a column as metadata.
META_WORDS = ("Centroid", "Classification", "Name", "Image", "ROI", "Binary")

# Texts read as missing.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Options:
    label_column: str = "Classification"
    delimiter: str = "|"
    context_columns: tuple[str, ...] = CELL_KEY
    object_type: str = "CellObject"
    nucleus_marker: str = "NA2"
    use_boxcox: bool = True
    group_column: str = IMAGE
    negative_percentile: float = 12.0
    negative_cells: int = 8
    add_only_missing: bool = True
    all_markers: bool = False
    signed_removal: bool = True
    marker_match: str = "exact"
    run_gating: bool = True
    run_power: bool = False
    seed: int = 421
    recovery_marker: str = "NAK"
    test_size: float = 0.3
    validation_size: float = 0.25
    cv_splits: int = 5
    draws: int = 30  # of the recovery search
    supervised_draws: int = 100
    contamination: float = 0.02
    neighbours: int = 35
    exclude_patterns: tuple[str, ...] = ()
    drop_outliers: bool = False
