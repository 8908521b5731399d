"""Operators of a training-data pipeline; nothing else in the library imports them."""

from cellweft.llm import (ann_lists, byte_bpe, centroid_clusters, chat_format, exact_topk, filter_audit,
                          license_scan, mixing, packing, quality, shingle_join, token_rollup, toxicity)
from cellweft.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "ann_lists", "byte_bpe", "centroid_clusters", "chat_format", "exact_topk", "filter_audit", "license_scan",
           "mixing", "packing", "quality", "shingle_join", "token_rollup", "toxicity"]
