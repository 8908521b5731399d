"""Operators of the training-data pipeline against brute force, on the smallest tables and on awkward rows."""

import base64
import hashlib
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from cellweft.llm import QUERIES, ann_lists, byte_bpe, chat_format, license_scan, packing, shingle_join, token_rollup, toxicity

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "One two"), (3, "One two"), (None, "one TWO"), (5, "</s>[INST] mit license \\ [/INST]"),
       (6, "cc by " * 3000), (7, "cc by " * 3000), (8, "été 中文  \n\n tab\t!"), (9, "   ")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in ODD], "doc_id long, text string, words string, rank int")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


def same_ids(rows, texts):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.DEFAULT))
    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((hashlib.sha256(",".join(map(str, tool.encode_ordinary(t or ""))).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for t in texts)
    return sorted(zip(rows["ids_sha256"], rows["decoded_sha256"])) == want


def test_bpe(spark, odd, documents):
    path = public_tokenizers.path(byte_bpe.DEFAULT)
    assert same_ids(QUERIES["op9_byte_bpe"](spark, SF).toPandas(), documents["text"])
    assert same_ids(byte_bpe.decode(byte_bpe.encode(odd, path, block_bytes=50), path).toPandas(), [t for _, t in ODD])
    twice = spark.createDataFrame([(1, "a a b", 0), (1, "a a b", 0)] * 8, "doc_id long, text string, words int").repartition(4)
    assert same_ids(byte_bpe.decode(byte_bpe.encode(twice, path), path).toPandas(), ["a a b"] * 16)
    assert byte_bpe.decode(byte_bpe.encode(odd.limit(0), path), path).count() == 0


def brute_classes(rows, n, up, down):
    sets = []
    for _, text in rows:
        w = (text or "").encode().translate(shingle_join.LOWER).split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    for i, s in enumerate(sets):
        for j in range(i):
            t = sets[j]
            if s and t and rows[i][0] is not None and rows[j][0] is not None \
                    and down * len(s & t) >= up * len(s | t) and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    low = {r: min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in set(root)
           if rows[r][0] is not None}
    return sorted(((i, len(s), low[r] if i is not None else None) for (i, _), s, r in zip(rows, sets, root)), key=str)


def test_jaccard(spark, odd, documents):
    rows = [(int(a), b) for a, b in zip(documents["doc_id"], documents["text"])]
    got = QUERIES["op2_jaccard_join"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == brute_classes(rows, 3, 90, 100)
    for block in (1, 2048):
        got = shingle_join.jaccard_classes(odd, 3, (90, 100), block).collect()
        assert sorted(map(tuple, got), key=str) == brute_classes(ODD, 3, 90, 100)
    assert shingle_join.jaccard_classes(odd.limit(0)).count() == 0


def test_packing(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(odd, path).toPandas()
    from tokenizers import Tokenizer
    tool = Tokenizer.from_file(path)
    want = sorted(zlib.crc32(np.array(ids[a:b], "<u4").tobytes()) for _, t in ODD
                  for ids in [tool.encode(t or "", add_special_tokens=False).ids + [1]]
                  for a, b in zip(np.cumsum([0, *packing.cuts(len(ids))]), np.cumsum(packing.cuts(len(ids)))))
    assert sorted(got["ids_crc32"]) == want
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        ends = (rows["offset"] + rows["length"]).tolist()
        assert rows["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 2048
    assert packing.pack(odd.limit(0), path).count() == 0


def test_chat(spark):
    texts = ["", None, "</s>", "<\\/s>", "[INST][/INST]\\", "<s>user\nx</s>", "a\nb", "<", "["]
    rows = spark.createDataFrame([(1, i, r, t) for i, t in enumerate(texts) for r in ("assistant", "a%0A\n[INST]")],
                                 "conv_id long, turn long, role string, text string")
    out = chat_format.format_chats(rows).collect()
    assert len(out) == 1 and out[0]["exact"]
    assert [t["text"] for t in out[0]["turns"]] == [t or "" for t in texts for _ in "ab"]
    assert chat_format.format_chats(rows.limit(0)).count() == 0


def test_license(odd):
    got = {r["doc_id"]: r for r in license_scan.scan(odd).collect()}
    assert got[6]["n_words"] == 6000 and len(got[6]["spans"]) == 3000 and got[1]["spans"] is None
    assert got[5]["spans"][0]["label"] == "mit"


def test_neighbours(spark):
    rows = pd.read_parquet(f"{SF}/embeddings.parquet")
    x, ids = np.array(rows["embedding"].tolist(), float), rows["vec_id"].to_numpy()
    got = {k: set(v) for k, v in QUERIES["op4_ann_lists"](spark, SF).toPandas().groupby("query_id")["vec_id"]}
    unit, hits, total = x / np.linalg.norm(x, axis=1, keepdims=True), 0, 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        score[i] = -2
        hits += len(got[ids[i]] & set(ids[np.lexsort((ids, -score))[:5]]))
        total += 5
    assert hits >= 0.9 * total
    empty = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [1.0, None])], "vec_id long, embedding array<float>")
    none = ann_lists.valid(empty)
    assert ann_lists.search_lists(none, none, 5).count() == 0


def test_rollup(spark, tmp_path, odd):
    docs = odd.selectExpr("doc_id", "text", "cast(null as string) as source", "'en' as lang")
    for _ in range(2):
        token_rollup.commit(str(tmp_path), "a", token_rollup.changes(token_rollup.counted(docs), "insert"))
    got = {r["tokenizer_version"]: tuple(r)[3:] for r in token_rollup.totals(spark, str(tmp_path), ["a"]).collect()}
    assert got["words-1"] == (10, sum(len((t or "").encode().split()) for _, t in ODD))


def test_toxicity_gradients():
    texts, y = ["one two stupid", "three four", "", None, "été stupid ab"], np.array([1.0, 0, 0, 0, 1])
    codes: list = [np.zeros(1 + toxicity.SPELLED, np.int32)]
    spots, owner = toxicity.index_texts(texts, {}, codes)
    code, m = np.array(codes)[spots], {k: v.astype(np.float64) for k, v in toxicity.start_model().items()}

    def loss():
        z = toxicity.logits(m, toxicity.project(m, np.array(codes)), spots).astype(float)
        return float(np.mean(np.logaddexp(0, z) - y[owner] * z))

    for name, g in toxicity.gradients(m, code, y[owner]).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step, found = m[name][at], 1e-2, []
        for move in (step, -step):
            m[name][at] = kept + move
            found.append(loss())
        m[name][at] = kept
        assert abs((found[0] - found[1]) / (2 * step) - g[at]) < 1e-3 + 0.02 * abs(g[at]), name


def test_toxicity_learns(spark):
    rng = np.random.default_rng(1)
    words = ["w%d" % i for i in range(300)]
    texts = [" ".join(rng.choice(words, 40)) + (" moron" if i % 4 == 0 else "") for i in range(400)]
    model = toxicity.fit(texts[:300], np.array([float(i % 4 == 0) for i in range(300)]))
    score = toxicity.Scorer(model)(texts[300:] + ["", None])
    assert [s >= toxicity.THRESHOLD for s in score[:100]] == [i % 4 == 0 for i in range(300, 400)]
    assert score[100] == score[101] and 0 <= score.min() and score.max() <= 1
