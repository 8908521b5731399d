"""Token counts by real vocabularies against the libraries."""

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from cellweft.llm import byte_bpe, token_rollup

ROWS = [(1, "a", "de", "Die Geschwindigkeitsbegrenzung gilt überall"), (2, "a", "de", None), (3, "a", "fr", "l’été  dernier\n\n ça va"),
        (3, "a", "fr", "l’été  dernier\n\n ça va"), (7, "b", "es", "gone"), (None, None, "en", " unbelievably  long\ttail "),
        (8, "b", "en", ""), (13, "b", "en", "</s> 中文 <unk>")]


def library_counts(text):
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path),
                             special_tokens={})
    return {"word_bpe_49k": len(word.encode(text or "", add_special_tokens=False).ids),
            "byte_bpe_multi_50k": len(tool.encode_ordinary(text or ""))}


def test_vocabulary_counts(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, source string, lang string, text string")
    want = {}
    for i, source, lang, text in ROWS:
        if i is not None and i % 10 == 7:
            continue
        for version, n in library_counts((text or "") + " revised" if i is not None and i % 10 == 3 else text).items():
            d, t = want.get((source, lang, version), (0, 0))
            want[source, lang, version] = (d + 1, t + n)
    got = token_rollup.vocabulary_rollup(spark, docs, str(tmp_path))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == want
    assert token_rollup.tokenized(docs.limit(0)).count() == 0
