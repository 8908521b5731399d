"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is cut into windows of WINDOW words, STEP apart, so that each overlaps half of the next and any STEP + 1 words in a
row lie whole in one; words longer than LETTERS bytes count as several that overlap by half. A word's input is a
hashed word embedding, whose first component starts from the word's smoothed log-odds among the training documents,
beside the mean of the embeddings of its character grams (beginnings and trigrams) and the highest of their log-odds. Two gated recurrent layers read the window in both directions,
attention pools their states, and the document's score is that of its highest window. Training knows document labels
only: each round takes every document's highest window and steps on those (multiple-instance learning). Every REVIEW
rounds the windows that compete are chosen anew among all windows of the sample: the highest HARDEST and as many at random.

Texts that are null, empty or without words get the bias of an empty window. Rows of labels with nulls are left out,
repeated labels of a document count once, and without any label every score is 0. Repeated rows stay rows. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from cellweft.llm.common import table
from cellweft.llm.license_scan import words_of
from cellweft.llm.quality import kept_rows, scored, training_rows
from cellweft.llm.registry import query

SAMPLE = 3000        # labelled documents learned from, at most, chosen by a hash of their id
WINDOW, STEP = 24, 12
BUCKETS, GRAMS = 16384, 16384
PREFIXES, TRIGRAMS, LETTERS = (3, 4, 5, 6, 7), 3, 48
SPELLED = len(PREFIXES) + TRIGRAMS
P = np.uint64(0x9E3779B97F4A7C15)
WORD, CHAR, HIDDEN = 8, 4, 8
ROUNDS, BATCH, RATE, DECAY = 16, 128, 0.01, 1e-4
HARDEST, REVIEW = 3, 4
TOGETHER = 1024      # windows scored together
KNOWN = 50_000       # words whose inputs are kept from one list of texts to the next, at most
THRESHOLD = 0.3


def word_codes(words: list[bytes]) -> np.ndarray:
    """Bucket of each word, then of its beginnings of PREFIXES bytes and of up to TRIGRAMS trigrams spread over it; 0 pads."""
    out = np.zeros((len(words), 1 + SPELLED), np.int32)
    if not words:
        return out
    out[:, 0] = [1 + xxhash.xxh32_intdigest(w) % (BUCKETS - 1) for w in words]
    text = np.array([b"^" + w[:LETTERS] + b"$" for w in words], f"S{LETTERS + 2}")
    chars = text.view(np.uint8).reshape(len(words), LETTERS + 2).astype(np.uint64)
    size = (chars > 0).sum(1)
    rolled = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(max(PREFIXES) + 1):
            rolled = (rolled + chars[:, i] + np.uint64(1)) * P
            if i in PREFIXES:
                own = (rolled >> np.uint64(33)) % np.uint64(GRAMS - 1) + np.uint64(1)
                out[:, 1 + PREFIXES.index(i)] = np.where(size > i, own, 0)
        last, row = np.maximum(0, size - 3), np.arange(len(words))
        for slot in range(TRIGRAMS):
            at = slot * last // (TRIGRAMS - 1)
            key = ((chars[row, at] * np.uint64(65536) + chars[row, at + 1] * np.uint64(256) + chars[row, at + 2]) * P)
            own = (key >> np.uint64(33)) % np.uint64(GRAMS - 1) + np.uint64(1)
            out[:, 1 + len(PREFIXES) + slot] = np.where((slot == 0) | (slot <= last), own, 0)
    return out


def units_of(text: str | None) -> list[bytes]:
    """The words of a text; longer ones than LETTERS bytes in pieces, each half of which is in the next."""
    out = words_of(text)
    if any(len(w) > LETTERS for w in out):
        half = LETTERS // 2
        out = [w[i:i + LETTERS] for w in out for i in range(0, max(1, len(w) - half), half)]
    return out


def windows_of(n: int) -> np.ndarray:
    return np.arange(0, max(1, n - WINDOW + STEP), STEP) if n > WINDOW else np.zeros(1, int)


def start_model(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d, h = WORD + CHAR + 1, HIDDEN
    m = {"word": rng.normal(0, 0.1, (BUCKETS, WORD)), "char": rng.normal(0, 0.1, (GRAMS, CHAR)),
         "att": rng.normal(0, 0.3, (2 * h, h)), "att_v": rng.normal(0, 0.3, h), "out": rng.normal(0, 0.3, 2 * h),
         "bias": np.zeros(1), "odds": np.zeros(GRAMS)}
    for way in "fb":
        m["w" + way] = rng.normal(0, 0.3, (d, 3 * h))
        m["u" + way] = rng.normal(0, 0.3, (h, 3 * h))
        m["c" + way] = np.zeros(3 * h)
    m["word"][0], m["char"][0] = 0, 0
    return {k: v.astype(np.float32) for k, v in m.items()}


def inputs(m: dict, codes: np.ndarray) -> np.ndarray:
    """Input vectors of words by their codes."""
    spelled = codes[..., 1:]
    n = np.maximum(1, (spelled > 0).sum(-1, keepdims=True)).astype(np.float32)
    highest = m["odds"][spelled].max(-1, keepdims=True)
    return np.concatenate([m["word"][codes[..., 0]], m["char"][spelled].sum(-2) / n, highest], -1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def recur(pre: np.ndarray, u: np.ndarray, order, keep: list | None = None) -> np.ndarray:
    """States (windows, words, hidden) of one gated recurrent layer over projected inputs."""
    h = np.zeros((len(pre), HIDDEN), np.float32)
    out = np.empty((len(pre), pre.shape[1], HIDDEN), np.float32)
    a, b = HIDDEN, 2 * HIDDEN
    for t in order:
        hu = h @ u
        gates = sigmoid(pre[:, t, :b] + hu[:, :b])
        z, r = gates[:, :a], gates[:, a:]
        n = np.tanh(pre[:, t, b:] + r * hu[:, b:])
        if keep is not None:
            keep.append((t, h, z, r, n, hu[:, b:]))
        h = n + z * (h - n)
        out[:, t] = h
    return out


def pool(m: dict, states: np.ndarray, real: np.ndarray):
    key = np.tanh(states @ m["att"])
    weight = np.where(real, key @ m["att_v"], -30).astype(np.float32)
    weight = np.exp(weight - weight.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    context = (weight[..., None] * states).sum(1)
    return context @ m["out"] + m["bias"][0], key, weight, context


def logits(m: dict, pre: dict[str, np.ndarray], spots: np.ndarray) -> np.ndarray:
    """Of windows given as indexes into the projected words; index 0 pads."""
    out = []
    for at in range(0, len(spots), TOGETHER):
        own = spots[at:at + TOGETHER]
        states = np.concatenate([recur(pre["f"][own], m["uf"], range(WINDOW)),
                                 recur(pre["b"][own], m["ub"], range(WINDOW - 1, -1, -1))], 2)
        out.append(pool(m, states, own > 0)[0])
    return np.concatenate(out) if out else np.empty(0, np.float32)


def project(m: dict, codes: np.ndarray) -> dict[str, np.ndarray]:
    x = inputs(m, codes)
    return {way: x @ m["w" + way] + m["c" + way] for way in "fb"}


def gradients(m: dict, codes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss over windows whose words' codes are (windows, words, 1 + SPELLED)."""
    x, pre, h = inputs(m, codes), project(m, codes), HIDDEN
    kept: dict[str, list] = {"f": [], "b": []}
    states = np.concatenate([recur(pre["f"], m["uf"], range(WINDOW), kept["f"]),
                             recur(pre["b"], m["ub"], range(WINDOW - 1, -1, -1), kept["b"])], 2)
    logit, key, weight, context = pool(m, states, codes[..., 0] > 0)
    dl = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
    g = {"out": context.T @ dl, "bias": np.array([dl.sum()])}
    dc = dl[:, None] * m["out"]
    dw = (states * dc[:, None]).sum(2)
    dw = weight * (dw - (weight * dw).sum(1, keepdims=True))
    g["att_v"] = np.einsum("bth,bt->h", key, dw)
    dk = dw[..., None] * m["att_v"] * (1 - key ** 2)
    g["att"] = np.einsum("btd,bth->dh", states, dk)
    ds = weight[..., None] * dc[:, None] + dk @ m["att"].T
    dx = np.zeros_like(x)
    for way, part in (("f", ds[..., :h]), ("b", ds[..., h:])):
        dh, u, dpre = np.zeros((len(y), h), np.float32), m["u" + way], np.zeros_like(pre[way])
        g["u" + way] = np.zeros_like(u)
        for t, before, z, r, n, hn in reversed(kept[way]):
            dh = dh + part[:, t]
            dn = dh * (1 - z) * (1 - n ** 2)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            inner = np.concatenate([dz, dr, dn * r], 1)
            dpre[:, t] = np.concatenate([dz, dr, dn], 1)
            g["u" + way] += before.T @ inner
            dh = dh * z + inner @ u.T
        g["w" + way] = np.einsum("btd,bth->dh", x, dpre)
        g["c" + way] = dpre.sum((0, 1))
        dx += dpre @ m["w" + way].T
    g["word"], g["char"] = np.zeros_like(m["word"]), np.zeros_like(m["char"])
    np.add.at(g["word"], codes[..., 0], dx[..., :WORD])
    spelled = codes[..., 1:]
    n = np.maximum(1, (spelled > 0).sum(-1, keepdims=True))
    np.add.at(g["char"], spelled, np.repeat((dx[..., WORD:WORD + CHAR] / n)[..., None, :], SPELLED, -2))
    g["word"][0], g["char"][0] = 0, 0
    return g


def index_texts(texts: list[str | None], lexicon: dict[bytes, int], codes: list[np.ndarray]):
    """Windows of all texts as word indexes, and the text each belongs to."""
    spots, owner = [], []
    every = [units_of(text) for text in texts]
    fresh = sorted({w for own in every for w in own}.difference(lexicon))
    lexicon.update(zip(fresh, range(len(codes), len(codes) + len(fresh))))
    codes.extend(word_codes(fresh))
    for i, own in enumerate(every):
        starts = windows_of(len(own))
        flat = np.zeros(int(starts[-1]) + WINDOW, np.int32)
        flat[:len(own)] = np.fromiter((lexicon[w] for w in own), np.int32, len(own))
        spots.append(flat[starts[:, None] + np.arange(WINDOW)])
        owner.append(np.full(len(starts), i))
    return (np.concatenate(spots), np.concatenate(owner)) if spots else (np.empty((0, WINDOW), int), np.empty(0, int))


def fit(texts: list[str | None], y: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> dict | None:
    if not len(y):
        return None
    lexicon: dict[bytes, int] = {}
    codes: list[np.ndarray] = [np.zeros(1 + SPELLED, np.int32)]
    spots, owner = index_texts(texts, lexicon, codes)
    code, m = np.array(codes), start_model(seed)
    held, parts = np.zeros((2, BUCKETS)), np.zeros((2, GRAMS))
    for label, text in zip(y, texts):
        own = code[[lexicon[w] for w in set(units_of(text))]].reshape(-1, 1 + SPELLED)
        held[int(label), np.unique(own[:, 0])] += 1
        parts[int(label), np.unique(own[:, 1:])] += 1

    def log_odds(seen: np.ndarray) -> np.ndarray:
        odds = np.log((seen[1] + 0.5) / ((y == 1).sum() + 1)) - np.log((seen[0] + 0.5) / ((y == 0).sum() + 1))
        return odds * seen.sum(0) / (seen.sum(0) + 8)

    m["word"][:, 0], m["odds"] = log_odds(held), log_odds(parts).astype(np.float32)
    m["word"][0], m["odds"][0] = 0, 0
    first, second = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    rng, step, y = np.random.default_rng(seed), 0, y.astype(np.float32)
    # Before anything is learned windows rank by log-odds.
    strength = np.maximum(m["word"][code[:, 0], 0], m["odds"][code[:, 1:]].max(1))
    rank = np.sort(strength[spots], 1)[:, -3:] @ np.array([0.1, 0.2, 1.0])

    def competing() -> np.ndarray:
        """Of each document the HARDEST windows, and as many at random."""
        keep = np.zeros(len(owner), bool)
        for key in (-rank, rng.random(len(owner))):
            order = np.lexsort((key, owner))
            keep[order[np.arange(len(owner)) - np.searchsorted(owner, owner) < HARDEST]] = True
        return np.flatnonzero(keep)

    for turn in range(rounds):
        if turn % REVIEW == 0:
            if turn:
                rank = logits(m, project(m, code), spots)
            mine = competing()
        elif turn:
            rank[mine] = logits(m, project(m, code), spots[mine])
        held_by, best = owner[mine], rank[mine]
        # Each document's highest window, and for label 0 a second one at random, so that all its windows count.
        order = np.lexsort((best, held_by))
        top = mine[order[np.flatnonzero(np.r_[held_by[order][1:] != held_by[order][:-1], True])]]
        extra = rng.permutation(mine[y[held_by] == 0])[:len(y)]
        chosen = rng.permutation(np.concatenate([top, extra]))
        for at in range(0, len(chosen), BATCH):
            own = chosen[at:at + BATCH]
            step += 1
            for k, g in gradients(m, code[spots[own]], y[owner[own]]).items():
                g = g.astype(np.float32)
                if k not in ("bias", "word", "char"):
                    g = g + DECAY * m[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                m[k] -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    return m


class Scorer:
    """Scores lists of texts; keeps the projected inputs of words it has met, a bounded number."""

    def __init__(self, model: dict | None):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.lexicon: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = [np.zeros(1 + SPELLED, np.int32)]
        self.pre = {way: np.empty((0, 3 * HIDDEN), np.float32) for way in "fb"}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(texts))
        out = np.full(len(texts), -np.inf)
        spots, owner = index_texts(texts, self.lexicon, self.codes)
        done = len(self.pre["f"])
        if done < len(self.codes):
            fresh = project(self.model, np.array(self.codes[done:]))
            self.pre = {way: np.concatenate([self.pre[way], fresh[way]]) for way in "fb"}
        np.maximum.at(out, owner, logits(self.model, self.pre, spots))
        if len(self.codes) > KNOWN:
            self.forget()
        return sigmoid(out)


def learned(docs: DataFrame, labels: DataFrame):
    """A function that maps lists of texts to scores, by a model learned on the driver from the bounded sample."""
    rows = training_rows(docs, labels, "toxic", 4, 2, SAMPLE).toPandas().sort_values("doc_id")
    model = docs.sparkSession.sparkContext.broadcast(fit(list(rows["text"]), rows["y"].to_numpy(float)))
    scorer: list[Scorer] = []

    def score(texts: list[str | None]) -> np.ndarray:
        if not scorer:
            scorer.append(Scorer(model.value))
        return scorer[0](texts)
    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Score ``docs`` with the model learned from ``source`` (``docs`` itself if not given)."""
    return scored(docs, learned(docs if source is None else source, labels), 4, 2, THRESHOLD)


def keep_clean(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None) -> DataFrame:
    return kept_rows(docs, learned(docs if source is None else source, labels), lambda s: s < THRESHOLD)


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
