"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into pre-tokens; a block of texts keeps its distinct pre-tokens once and, per text, their positions as
indexes into that list. The pre-tokens of all blocks are dealt to buckets by their hash, many to a row, encoded once
each there, sent back to their blocks, which are stored in buckets and so are not shuffled themselves, and each block's
texts are put together by position. Decoding joins the token-byte table, one broadcast row of the vocabulary's size. A
block holds a bounded number of text bytes (one longer text is a block of its own), so no task gathers more.

Null texts count as empty and give no ids. Repeated ids and rows stay rows. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.llm.common import plain, table
from cellweft.llm.registry import query
from cellweft.session import scratch_path

BLOCK_BYTES = 16_000_000
LEAST_BUCKETS, MOST_BUCKETS = 512, 2048
SLICE = 1_000_000    # ids that are put together at once
DEFAULT = "byte_bpe_multi_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank is merged, leftmost first, until none is left."""
    if word in ranks:
        return [ranks[word]]
    import heapq
    n = len(word)
    end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(word[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not alive[i] or end[i] != j or not alive[j] or end[j] != k:
            continue
        alive[j], end[i] = False, k
        if k < n:
            prev[k] = i
        if prev[i] >= 0:
            offer(prev[i])
        offer(i)
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def pressed(numbers: np.ndarray) -> bytes:
    """int32 numbers, their bytes in four planes, deflated: a fraction of their size on disk and in shuffles."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpressed(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def packed_words(words: list[bytes]) -> bytes:
    return zlib.compress(np.array([len(words), *map(len, words)], "<u4").tobytes() + b"".join(words), 1)


def unpacked_words(data: bytes) -> list[bytes]:
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)).tolist()
    return [raw[i:j] for i, j in zip([4 + 4 * n, *ends], ends)]


def blocks_of(batches: Iterator[pd.DataFrame], pattern: str, block_bytes: int) -> Iterator[pd.DataFrame]:
    find = regex.compile(pattern).findall
    # A task that is run again gives its blocks the same numbers.
    block = TaskContext.get().partitionId() << 32

    def close(ids, offsets, spots, words):
        flat = np.concatenate(spots) if spots else np.empty(0, np.int32)
        return pd.DataFrame({"block": [block], "doc_ids": [ids], "offsets": [offsets], "positions": [pressed(flat)],
                             "words": [packed_words([w.encode() for w in words])]})

    ids, offsets, spots, words, size = [], [0], [], {}, 0
    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"]):
            found = find(text or "")
            spots.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.int32, len(found)))
            ids.append(None if pd.isna(doc) else int(doc))
            offsets.append(offsets[-1] + len(found))
            size += len(text or "") + 16
            if size >= block_bytes:
                yield close(ids, offsets, spots, words)
                ids, offsets, spots, words, size, block = [], [0], [], {}, 0, block + 1
    if ids:
        yield close(ids, offsets, spots, words)


def gather(starts: np.ndarray, sizes: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Indexes of the stretches ``spots``, one after another."""
    own = sizes[spots]
    ends = np.cumsum(own)
    return np.repeat(starts[spots] - ends + own, own) + np.arange(int(ends[-1]) if len(ends) else 0)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, spots: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The stretches ``spots`` of ``flat``, one after another; ``cuts`` are their ends after a 0. Slices of some SLICE ids
    bound the indexes at hand."""
    out, a = np.empty(int(cuts[-1]), flat.dtype), 0
    while a < len(spots):
        b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + SLICE, "right")) - 1)
        out[cuts[a]:cuts[b]] = flat[gather(starts, sizes, spots[a:b])]
        a = b
    return out


def stored_blocks(blocks: DataFrame) -> DataFrame:
    """The blocks stored in buckets of their number, as many as shuffles have partitions: words sent back to a block by
    a shuffle on that number meet its positions where they lie, so these are written once and never shuffled."""
    spark = blocks.sparkSession
    name, n = f"bpe_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.format("parquet").option("path", scratch_path(spark, "bpe")).bucketBy(n, "block").saveAsTable(name)
    stored = spark.table(name)
    stored.schema  # resolved here: the table's name is needed no longer, its files stay
    spark.sql(f"DROP TABLE {name}")
    return stored


def encode(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, doc_ids, offsets (ids of each text end there), ids (pressed) and vocabulary of every text."""
    blocks = stored_blocks(plain(docs, "doc_id", "text").mapInPandas(
        lambda it: blocks_of(it, pattern, block_bytes),
        "block long, doc_ids array<long>, offsets array<long>, positions binary, words binary"))
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, blocks.count()))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, data in zip(batch["block"], batch["words"]):
                words = unpacked_words(data)
                bucket = np.array([xxhash.xxh32_intdigest(w) for w in words], np.int64) % buckets
                order = bucket.argsort(kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                yield pd.DataFrame([(int(bucket[own[0]]), block, pressed(own), packed_words([words[i] for i in own]))
                                    for own in np.split(order, cuts[1:]) if len(own)],
                                   columns=["bucket", "block", "slots", "words"])

    def encode_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, known, at = read_ranks(ranks_path), {}, None
        for batch in batches:
            rows = []
            for bucket, block, slots, data in zip(batch["bucket"], batch["block"], batch["slots"], batch["words"]):
                if bucket != at:  # no word of one bucket is in another
                    known, at = {}, bucket
                own = []
                for w in unpacked_words(data):
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = np.array(merge_word(w, ranks), "<i4").tobytes()
                    own.append(ids)
                rows.append((block, slots, pressed(np.array([len(x) // 4 for x in own])),
                             pressed(np.frombuffer(b"".join(own), "<i4"))))
            yield pd.DataFrame(rows, columns=["block", "slots", "sizes", "word_ids"])

    # All blocks' uses of a word meet in one bucket, a block's at most once; they are encoded once there.
    dealt = blocks.select("block", "words").mapInPandas(deal, "bucket int, block long, slots binary, words binary")
    known = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        encode_words, "block long, slots binary, sizes binary, word_ids binary")
    back = known.groupBy("block").agg(F.collect_list(F.struct("slots", "sizes", "word_ids")).alias("lexicon"))
    # The words sent back grow with the corpus, so they are never broadcast.
    joined = blocks.drop("words").join(back.hint("merge"), "block", "left")

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                spots, ends, flat = unpressed(row.positions), np.asarray(row.offsets, np.int64), np.empty(0, "<i4")
                n = int(spots.max(initial=-1)) + 1
                starts, sizes = np.zeros(n, np.int64), np.zeros(n, np.int64)
                if n:
                    parts = [[unpressed(part[k]) for k in ("slots", "sizes", "word_ids")] for part in row.lexicon]
                    slots, each, flat = (np.concatenate(x) for x in zip(*parts))
                    starts[slots], sizes[slots] = np.cumsum(each) - each, each
                cuts = np.concatenate([[0], np.cumsum(sizes[spots])]).astype(np.int64)
                yield pd.DataFrame({"block": [row.block], "doc_ids": [row.doc_ids], "offsets": [cuts[ends].tolist()],
                                    "ids": [pressed(gathered(flat, starts, sizes, spots, cuts))], "vocabulary": [ranks_path]})

    return joined.mapInPandas(
        assemble, "block long, doc_ids array<long>, offsets array<long>, ids binary, vocabulary string")


def token_bytes(spark: SparkSession, ranks_path: str) -> DataFrame:
    """vocabulary, token_ids, tokens: the token-byte table in one row; its size is the vocabulary's."""
    ranks = read_ranks(ranks_path)
    return spark.createDataFrame([(ranks_path, bytearray(pressed(np.array(list(ranks.values())))),
                                   bytearray(packed_words(list(ranks))))],
                                 "vocabulary string, token_ids binary, tokens binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every encoded text, the bytes joined from the table."""
    joined = encoded.join(F.broadcast(token_bytes(encoded.sparkSession, ranks_path)), "vocabulary")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part: dict[int, bytes] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if not part:
                    part = dict(zip(unpressed(row.token_ids).tolist(), unpacked_words(row.tokens)))
                    text = {i: str(i) for i in part}
                ids, rows = unpressed(row.ids), []
                for doc, a, b in zip(row.doc_ids, row.offsets[:-1], row.offsets[1:]):
                    own = ids[a:b].tolist()  # numbers of one text at a time
                    rows.append((doc, b - a, hashlib.sha256(",".join([text[i] for i in own]).encode()).hexdigest(),
                                 hashlib.sha256(b"".join([part[i] for i in own])).hexdigest()))
                yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype(
                    {"doc_id": "Int64"})

    return joined.mapInPandas(write, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(DEFAULT)
    return decode(encode(table(spark, sf_dir, "documents"), path), path)
