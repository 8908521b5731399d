"""Ids of the packing encoder are the tokenizer's, whatever the characters, in runs of any length."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellweft.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
POOL = ([chr(i) for i in range(128)] * 4 + list("'''srevmldtSRE 000<|>") * 10
        + list("ΣςσİIıßééüﬁ²½٣ 　\u0085‍﻿😀漢字") * 8
        + ["<|startoftext|>", "<|endoftext|>", "<|EndOfText|>"] * 5)


@pytest.mark.parametrize("size", [1, 500, 10**6])
def test_ids(size, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 2000)  # cleared on the way
    rng, tok = random.Random(size), Tokenizer.from_file(PATH)
    texts = [None, "", " ", "0", " 0 0 "] + ["".join(rng.choices(POOL, k=rng.randrange(60))) for _ in range(3000)]
    ids = packing.encoder(PATH)
    got = [own.tolist() for run in packing.runs(texts, size) for own in ids(run)]
    assert got == [tok.encode(t or "", add_special_tokens=False).ids + [packing.END] for t in texts]


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    text = "héllo"
    assert packing.encoder(path)([text])[0].tolist() == tok.encode(text, add_special_tokens=False).ids + [packing.END]
