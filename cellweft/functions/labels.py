"""Functions over the delimited label column (``CD3+|CD8-``)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(label: Column, delimiter: str = "|") -> Column:
    """Trimmed tokens in order; NULL for a NULL label; empty tokens are kept."""
    return F.transform(F.split(label, re.escape(delimiter)), lambda t: F.trim(t))


def filled_tokens(label: Column, delimiter: str = "|") -> Column:
    return F.filter(tokens(label, delimiter), lambda t: t != "")


def is_signed(token: Column) -> Column:
    return token.endswith("+") | token.endswith("-")


def signed_tokens(label: Column, delimiter: str = "|") -> Column:
    """Distinct tokens that end in a sign."""
    return F.array_distinct(F.filter(tokens(label, delimiter), is_signed))


def marker_of(token: Column) -> Column:
    return F.regexp_replace(token, r"[+-]+$", "")


def sign_of(token: Column) -> Column:
    """1 for ``+``, 0 for ``-``, NULL for a token without a sign."""
    return F.when(token.endswith("+"), F.lit(1)).when(token.endswith("-"), F.lit(0))


def is_positive(label: Column) -> Column:
    """Training target: 1 when the label text ends in ``+``, else 0."""
    return F.when(label.endswith("+"), F.lit(1)).otherwise(F.lit(0))


def parse_marker(label: Column, marker: str, delimiter: str = "|") -> Column:
    """1, 0 or NULL for one marker; the last signed token of that marker wins."""
    pair = (marker + "+", marker + "-")
    last = F.try_element_at(F.filter(tokens(label, delimiter), lambda t: t.isin(*pair)), F.lit(-1))
    return sign_of(last)


def parse_map(label: Column, delimiter: str = "|") -> Column:
    """Marker -> sign of its last signed token."""
    found = F.filter(tokens(label, delimiter), lambda t: is_signed(t) & (F.length(t) > 1))
    head = lambda t: F.substring(t, F.lit(1), F.length(t) - 1)
    names = F.array_distinct(F.transform(found, head))
    last = lambda m: F.right(F.try_element_at(F.filter(found, lambda t: head(t) == m), F.lit(-1)), F.lit(1))
    return F.when(label.isNotNull(), F.map_from_arrays(names, F.transform(names, last)))


def own_tokens(parts: Column, marker: Column) -> Column:
    """Those of an array of tokens that equal the marker with an optional sign, in any case."""
    wanted = F.lower(marker)
    return F.filter(parts, lambda t: F.lower(t).isin(wanted, F.concat(wanted, F.lit("+")), F.concat(wanted, F.lit("-"))))


def key_label(label: Column, marker: Column, delimiter: str = "|") -> Column:
    """The marker's own tokens joined by ``|``; '' if none."""
    return F.coalesce(F.array_join(own_tokens(tokens(label, delimiter), marker), "|"), F.lit(""))


def append_tokens(label: Column, extra: Column, delimiter: str = "|") -> Column:
    """Append an array of labels; empty tokens go, the first of duplicates stays."""
    before = F.coalesce(filled_tokens(label, delimiter), F.array().cast("array<string>"))
    return F.array_join(F.array_distinct(F.concat(before, extra)), delimiter)


def remove_tokens(label: Column, unwanted: Column, delimiter: str = "|") -> Column:
    """Drop every token found in the array ``unwanted``; an emptied label becomes ''."""
    kept = F.filter(tokens(label, delimiter), lambda t: ~F.array_contains(unwanted, t))
    return F.when(label.isNull(), label).otherwise(F.array_join(kept, delimiter))


def count_token(label: Column, token: Column, delimiter: str = "|") -> Column:
    return F.size(F.filter(tokens(label, delimiter), lambda t: t == token))


def sign_label(marker: Column | str, value: Column) -> Column:
    """0/1 to ``marker-``/``marker+``."""
    name = F.lit(marker) if isinstance(marker, str) else marker
    return F.when(value == 1, F.concat(name, F.lit("+"))).when(value == 0, F.concat(name, F.lit("-")))
