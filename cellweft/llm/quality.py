"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text is a histogram over pairs of neighbouring byte classes (each letter a class, capitals, digits, spaces, marks and
other bytes in a few more) plus how often its words repeat. The labelled sample's log-scaled, inverse-frequency-weighted histograms give
a truncated singular value decomposition; its labelled vectors (at most SAMPLE, so of proven size) are broadcast. Every document's exact
cosine to all of them is taken in blocks, and its NEIGHBOURS nearest vote with their similarity, sharpened by POWER.

Null and empty texts have a zero vector and get the labelled share of label 1 (0.5 without labels). Rows of labels with
nulls are left out, repeated labels of a document count once. Repeated rows stay rows. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.llm.common import give_back, plain, table, utf8
from cellweft.llm.registry import query

SAMPLE = 3000       # labelled documents, at most, chosen by a hash of their id
RANK = 48
NEIGHBOURS = 15
POWER = 8.0
BLOCK = 512         # documents of one block of cosines
SPECIAL = b"!.,?:;'\"-*$%&#|/\\<>()"

CLASSES = np.full(256, 41, np.uint16)
CLASSES[128:] = 40
for _c in range(256):
    if 97 <= _c <= 122:
        CLASSES[_c] = _c - 97
    elif 65 <= _c <= 90:
        CLASSES[_c] = 26
    elif 48 <= _c <= 57:
        CLASSES[_c] = 27
    elif _c == 10:
        CLASSES[_c] = 29
    elif chr(_c).isspace() and _c < 128:
        CLASSES[_c] = 28
for _i, _c in enumerate(SPECIAL):
    CLASSES[_c] = 30 + _i % 10
N = 42
WIDTH = N * N + 12


def histogram(text: str | None) -> np.ndarray:
    raw = utf8(text)
    out = np.zeros(WIDTH, np.float32)
    if not raw:
        return out
    kinds = CLASSES[np.frombuffer(raw, np.uint8)]
    if len(kinds) > 1:
        out[:N * N] = np.bincount(kinds[:-1].astype(np.int64) * N + kinds[1:], minlength=N * N)
    out[:N * N] *= 1000 / len(raw)
    words = raw.split()
    if words:
        # Repetition: distinct share, commonest share, and words equal to the one before, each by length of text.
        distinct = len(set(words)) / len(words)
        same = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        out[N * N + min(5, int(np.log10(len(words)) * 2))] = 20 * (1 - distinct)
        out[N * N + 6] = 100 * same
        out[N * N + 7] = 100 * (len(re.findall(rb"[A-Z]{2,}", raw)) / len(words))
        out[N * N + 8] = 100 / len(words) ** 0.5
        lines = [x for x in raw.split(b"\n") if x]
        out[N * N + 9] = 50 * (1 - len(set(lines)) / max(1, len(lines)))
    return out


def fit(texts: list[str | None], labels: np.ndarray) -> dict:
    x = np.log1p(np.array([histogram(t) for t in texts], np.float64).reshape(len(texts), WIDTH))
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1
    mean = (x * idf).mean(0) if len(x) else np.zeros(WIDTH)
    if len(x):
        _, s, vt = np.linalg.svd(x * idf - mean, full_matrices=False)
        axes = vt[:min(RANK, len(s))].T
        scale = 1 / np.sqrt(s[:axes.shape[1]] + 1e-9)
        axes = axes * scale
    else:
        axes = np.zeros((WIDTH, 1))
    model = {"idf": idf, "mean": mean, "axes": axes, "labels": labels.astype(float),
             "share": float(labels.mean()) if len(labels) else 0.5}
    model["vectors"] = project(model, x)
    return model


def project(model: dict, x: np.ndarray) -> np.ndarray:
    v = (x * model["idf"] - model["mean"]) @ model["axes"]
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def vote(model: dict, texts: list[str | None]) -> np.ndarray:
    x = np.log1p(np.array([histogram(t) for t in texts], np.float64).reshape(len(texts), WIDTH))
    if not len(model["labels"]):
        return np.full(len(texts), model["share"])
    cosine = project(model, x) @ model["vectors"].T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6) ** POWER
    score = (weight * model["labels"][near]).sum(1) / weight.sum(1)
    score[np.array([not t for t in texts], bool)] = model["share"]
    return np.clip(score, 0, 1)


def training_rows(docs: DataFrame, labels: DataFrame, target: str, modulus: int, held: int, limit: int) -> DataFrame:
    """doc_id, text, y of at most ``limit`` labelled documents outside the held-out fold, by a hash of the id."""
    known = plain(labels, "doc_id", target).where(f"{target} in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max(target).alias("y")).where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) != held)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = plain(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.dropDuplicates(["doc_id"])


def scored(docs: DataFrame, score, modulus: int, held: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``score`` maps a list of texts to an array."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), block):
                part = batch.iloc[at:at + block]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "score": score(list(part["text"]))})
        batch = part = None
        give_back()

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))
    return plain(docs, "doc_id", "text").mapInPandas(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept_rows(docs: DataFrame, score, keep, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score ``keep`` accepts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                yield part.filter(pa.array(keep(score(part.column("text").to_pylist()))))
        batch = part = None
        give_back()

    return docs.mapInArrow(run, docs.schema)


def quality_model(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> dict:
    rows = training_rows(docs, labels, "quality", modulus, held, SAMPLE).toPandas().sort_values("doc_id")
    return fit(list(rows["text"]), rows["y"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Score ``docs`` with the model learned from ``source`` (``docs`` itself if not given)."""
    model = docs.sparkSession.sparkContext.broadcast(quality_model(docs if source is None else source, labels))
    return scored(docs, lambda texts: vote(model.value, texts), 3, 1, 0.5)


def keep_good(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(quality_model(docs if source is None else source, labels))
    return kept_rows(docs, lambda texts: vote(model.value, texts), lambda s: s >= 0.5)


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
