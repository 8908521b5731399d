"""License scans by diagonal voting.

Every rolling k-word hash of every text is joined to the positions of the templates' k-word hashes (a broadcast
table, bounded by the templates). A hit at word w of position p votes for the diagonal w - p; votes are aggregated per
document, template and stretch of the diagonal, neighbouring diagonals are merged, and each merged span is verified
against the words. A short phrase counts wherever it stands in full (base places); longer notices add labels where a
verified span covers most of the notice.

Null and empty texts, and texts without words, have no places, no labels and score 0. Repeated rows stay rows. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweft.llm.common import LOWER, plain, table, utf8
from cellweft.llm.registry import query
from cellweft.session import settle

# The phrases and the labels they stand for.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Opening sentences of well-known notices, by label.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files to deal in the software without restriction",
    "apache": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "cc-by": "this work is licensed under a creative commons attribution",
}
K = 2
MERGE = 3          # diagonals this close belong to one passage with a word or two put in or left out
COVER = 0.7        # share of a notice's grams that a verified span must hold
P = np.uint64(0x9E3779B97F4A7C15)
SPLIT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(LOWER).translate(SPLIT).split()


def word_hash(word: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(word)


def grams(h: np.ndarray, k: int = K) -> np.ndarray:
    """Rolling hashes of k words; modulo 2**64, order matters."""
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * P + h[j:j + len(out)]
    return out.view(np.int64)


def templates(phrases: dict[str, str], notices: dict[str, str]) -> list[tuple[int, str, bool, list[bytes]]]:
    every = [(v, True, k) for k, v in phrases.items()] + [(k, False, v) for k, v in notices.items()]
    return [(i, label, base, words_of(text)) for i, (label, base, text) in enumerate(every)]


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_words and spans (label, base, start, end, cover) that were verified.

    A text is known by its digest, so the votes of exact copies fall together before they are shuffled.
    """
    spark = docs.sparkSession
    known = templates(PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, len(batch), 256):
                part, keys, counts, rolled = batch.iloc[at:at + 256], [], [], []
                for text in part["text"]:
                    own = words_of(text)
                    if len(cache) > 400_000:
                        cache.clear()
                    for w in set(own):
                        if w not in cache:
                            cache[w] = word_hash(w)
                    rolled.append(grams(np.fromiter((cache[w] for w in own), np.uint64, len(own))))
                    keys.append(hashlib.md5(b" ".join(own)).digest())
                    counts.append(len(own))
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "key": keys, "n_words": counts,
                                    "hashes": rolled})

    # Template -1 marks the document itself, whose row lies behind its last gram.
    positions = [(int(x), i, p) for i, _, _, own in known
                 for p, x in enumerate(grams(np.array([word_hash(w) for w in own], np.uint64)))]
    spots = spark.createDataFrame([*positions, (None, -1, 0)], "hash long, template int, p int")
    facts = spark.createDataFrame([(i, label, base, len(own)) for i, label, base, own in known],
                                  "template int, label string, base boolean, size int")
    rolled = plain(docs, "doc_id", "text").mapInPandas(
        hashed, "doc_id long, key binary, n_words long, hashes array<long>")
    every = rolled.select("doc_id", "key", "n_words", F.posexplode(F.concat(
        "hashes", F.array(F.lit(None).cast("long")))).alias("w", "gram"))
    hits = settle(every.join(F.broadcast(spots), F.col("gram").eqNullSafe(F.col("hash")))
                  .select("doc_id", "key", "n_words", "template", "w", "p"), "license")
    rows = hits.where("template = -1").select("doc_id", "key", "n_words")
    votes = hits.where("template >= 0").groupBy("key", "template", (F.col("w") - F.col("p")).alias("diagonal")).agg(
        F.collect_set("p").alias("seen"), F.min("w").alias("low"), F.max("w").alias("high"))
    votes = votes.join(F.broadcast(facts), "template")
    # A phrase stands where one diagonal has the votes of all its grams.
    base = votes.where(F.col("base") & (F.size("seen") == F.col("size") - K + 1)).select(
        "key", "label", "base", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("size") - 1).alias("end"),
        F.lit(1.0).alias("cover"))
    # Of a notice, diagonals at most MERGE apart belong together as long as their places lie within one length of it.
    line = Window.partitionBy("key", "template").orderBy("diagonal", "low")
    far = (F.col("diagonal") - F.lag("diagonal").over(line) > MERGE) | F.lag("diagonal").over(line).isNull()
    merged = (votes.where(~F.col("base")).withColumn("fresh", far.cast("int"))
              .withColumn("passage", F.sum("fresh").over(line))
              .groupBy("key", "template", "label", "base", "size", "passage")
              .agg(F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"), F.min("low").alias("start"),
                   (F.max("high") + K - 1).alias("end")))
    cover = F.size("seen") / (F.col("size") - K + 1)
    fits = (cover >= COVER) & (F.col("end") - F.col("start") < 2 * F.col("size"))
    longer = merged.where(fits).select("key", "label", "base", "start", "end", cover.alias("cover"))
    spans = base.unionByName(longer).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "base", "cover"))).alias("spans"))
    return rows.join(spans, "key", "left").select("doc_id", "n_words", "spans")


# The base places, by consecutive words.
SQL = r"""with w as (select row_number() over () as r, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
e as (select r, ws, unnest(range(len(ws))) as i from w),
h as (select r, i, case when ws[i+1:i+4] = ['gnu', 'general', 'public', 'license'] then 'gpl'
        when ws[i+1:i+2] = ['apache', 'license'] then 'apache' when ws[i+1:i+2] = ['cc', 'by'] then 'cc-by'
        when ws[i+1:i+2] = ['mit', 'license'] then 'mit' end as label from e),
g as (select r, count(*) as n_base, min(i) as first_word, max(i) as last_word,
        string_agg(distinct label, ',' order by label) as base_labels from h where label is not null group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(base_labels, '') as base_labels, coalesce(base_labels, '') as labels,
    case when n_base > 0 then 1e0 else 0e0 end as score from w left join g using (r)"""


@query("op3_license_scan", SQL)
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels may exceed base_labels where a text holds a longer notice; the tables hold none, as the SQL assumes."""
    found = scan(table(spark, sf_dir, "documents")).withColumn(
        "spans", F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint,label:string,"
                                            "base:boolean,cover:double>>)")))
    own = F.filter("spans", lambda s: s["base"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(own, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(own).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        names(own).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0)).alias("score"))
