"""Delta-maintained token counts by source, language and tokenizer version.

Versions are the vocabularies of VOCABULARIES, by which texts are really tokenized, and two that SQL can check: words
between blanks and bytes. op6_token_counts reports the latter two only, as its SQL has no tokenizer;
op6_vocabulary_counts reports all four. A document is tokenized once for each of its texts; deletes and replays read the stored counts.

A batch is a table of signed changes: an insert adds a document's count, a delete takes it away, a revision replaces
the old count by the new one. Every batch is summed to one row per key and committed to a folder of its own, which a
repeated commit replaces as a whole; totals are the sums over committed batches, so replays and lost executors change
nothing and no document is counted again. Sums are additive and pre-aggregated before the shuffle, whatever the key.

Null sources and languages are keys of their own, null and empty texts count no tokens, a null old or new count is 0.
Repeated rows count each. Empty batches commit and change nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellweft.llm.byte_bpe import read_ranks
from cellweft.llm.common import plain, table
from cellweft.llm.registry import query
from cellweft.session import scratch_path, settle

KEYS = ["source", "lang", "tokenizer_version"]
TOTALS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
VOCABULARIES = ("word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken")
CACHE = 300_000      # chunks whose counts a task keeps


class Chunks(dict):
    """Token counts of the chunks between spaces, which bound the vocabulary's words."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[chunk] = len(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return n


def vocabulary_counter(name: str) -> Callable[[str], int]:
    """text -> number of ids under a vocabulary, without special tokens."""
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        counts = Chunks(Tokenizer.from_file(path))
        return lambda text: sum(map(counts.__getitem__, text.split(" ")))
    tool = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    return lambda text: len(tool.encode_ordinary(text))


def tokenized(docs: DataFrame, names: tuple[str, ...] = VOCABULARIES) -> DataFrame:
    """doc_id, source, lang, tokenizer_version, n_tokens of every document under every vocabulary."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters_ = {n: vocabulary_counter(n) for n in names}
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for n, counter in counters_.items():
                yield batch[["doc_id", "source", "lang"]].astype({"doc_id": "Int64"}).assign(
                    tokenizer_version=n.split(".")[0], n_tokens=[counter(t) for t in texts])

    rows = plain(docs, "doc_id", "source", "lang", "text")
    return rows.mapInPandas(count, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long")


def counters(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    return {"words-1": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
            "bytes-1": F.octet_length(text).cast("long")}


def counted(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """doc_id, source, lang, tokenizer_version, n_tokens of every document under every version."""
    each = [F.struct(F.lit(v).alias("v"), n.alias("n")) for v, n in counters(F.col("text") if text is None else text).items()]
    return plain(docs, "doc_id", "source", "lang", "text").select(
        "doc_id", "source", "lang", F.explode(F.array(*each)).alias("c")).select(
        "doc_id", "source", "lang", F.col("c.v").alias("tokenizer_version"), F.col("c.n").alias("n_tokens"))


def changes(rows: DataFrame, kind: str, old: str = "old_tokens", new: str = "n_tokens") -> DataFrame:
    """Signed rows of a batch: kind is insert, delete or revise."""
    sign = {"insert": 1, "delete": -1, "revise": 0}[kind]
    now = F.coalesce(F.col(new), F.lit(0))
    tokens = now - F.coalesce(F.col(old), F.lit(0)) if kind == "revise" else now * sign
    return rows.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens"))


def sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def commit(root: str, batch: str, signed: DataFrame) -> None:
    """Commit a batch under its name; the same name again replaces it, and readers see batches as a whole."""
    sums(signed).write.mode("overwrite").parquet(f"{root}/batch-{batch}")


def totals(spark: SparkSession, root: str, batches: list[str]) -> DataFrame:
    """Totals over the committed batches; keys without documents and tokens are gone."""
    if not batches:
        return spark.createDataFrame([], TOTALS)
    rows = spark.read.schema(TOTALS).parquet(*[f"{root}/batch-{b}" for b in batches])
    return sums(rows).where("n_docs <> 0 or n_tokens <> 0")


SQL = r"""with d as (select source, lang, doc_id, coalesce(text, '') as t from documents
    where doc_id is null or (doc_id % 10 + 10) % 10 <> 7),
r as (select source, lang, case when (doc_id % 10 + 10) % 10 = 3 then t || ' revised' else t end as t from d),
c as (select source, lang, 'bytes-1' as tokenizer_version, strlen(t) as n from r union all
    select source, lang, 'words-1',
        len(list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) from r)
select source, lang, tokenizer_version, count(*) as n_docs, sum(n)::bigint as n_tokens from c group by 1, 2, 3"""


@query("op6_token_counts", SQL)
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; every tenth goes again, every tenth is revised; both later batches come twice."""
    docs, root = table(spark, sf_dir, "documents"), scratch_path(spark, "rollup")
    gone, revised = docs.where("pmod(doc_id, 10) = 7"), docs.where("pmod(doc_id, 10) = 3")
    later = F.concat(F.coalesce("text", F.lit("")), F.lit(" revised"))
    was = counters(F.col("text"))
    both = [F.struct(F.lit(v).alias("v"), was[v].alias("o"), n.alias("n")) for v, n in counters(later).items()]
    renewed = revised.select("source", "lang", F.explode(F.array(*both)).alias("c")).select(
        "source", "lang", F.col("c.v").alias("tokenizer_version"), F.col("c.o").alias("old_tokens"),
        F.col("c.n").alias("n_tokens"))
    commit(root, "inserts", changes(counted(docs), "insert"))
    for _ in range(2):
        commit(root, "deletes", changes(counted(gone), "delete"))
        commit(root, "revisions", changes(renewed, "revise"))
    return totals(spark, root, ["inserts", "deletes", "revisions"])


@query("op6_vocabulary_counts")
def op6_vocabulary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches under the real vocabularies, beside the versions of op6_token_counts."""
    docs, root = table(spark, sf_dir, "documents"), scratch_path(spark, "rollup")
    return vocabulary_rollup(spark, docs, root).unionByName(op6_token_counts(spark, sf_dir))


def vocabulary_rollup(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    later = F.concat(F.coalesce("text", F.lit("")), F.lit(" revised"))
    counts = settle(tokenized(docs), "counts")
    revised = docs.where("pmod(doc_id, 10) = 3").withColumn("text", later)
    # A revision takes the stored old counts away and brings the new text's.
    renewed = settle(changes(tokenized(revised), "insert").unionByName(
        changes(counts.where("pmod(doc_id, 10) = 3"), "delete")), "renewed")
    commit(root, "inserts", changes(counts, "insert"))
    for _ in range(2):
        commit(root, "deletes", changes(counts.where("pmod(doc_id, 10) = 7"), "delete"))
        commit(root, "revisions", renewed)
    return totals(spark, root, ["inserts", "deletes", "revisions"])
