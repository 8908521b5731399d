"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

* Targets share all words by weight; a target stops at ``repeats`` times its source's size and the rest is shared
  again, until none is above.
* Every source's documents, shuffled by a hash, form one stream of words that is cut into blocks of ``block`` words
  (the last one may be shorter). Stream positions are prefix sums over hash buckets, so no source is sorted in one task.
* A source owns as many consecutive integers below S as it has slots (the cumulative weights); the van der Corput
  sequence, i.e. the integers below S in the order of their reversed bits, visits them evenly. Both an integer's place
  in that order and its rank among its own source's integers are counts of integers with given low bits in an interval,
  so they are computed in closed form: no slot is sorted, and no source's slots meet in one task.
* Slot r of a source takes block r modulo its blocks; only its last slot may take a part. Slots and blocks meet in
  one join, each block at most ``repeats`` times.

Null texts count as empty. Documents without words, and empty sources, take no part (taken 0). A null source is a
source of its own, ordered last. Repeated rows count each; a null doc_id is an id like any other. Texts of any length are cut at
blocks, never dropped. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.llm.common import plain, table
from cellweft.llm.registry import query
from cellweft.operators.prefix import offsets, ordinals
from cellweft.session import attach, settle

BLOCK = 256       # words of a block
BUCKET_ROWS = 512  # documents of a source that one window orders
STEP = 65536      # elements that one row is exploded to at a time
SLOTS_STEP = 8192  # slots of a source that are made at a time
WORD = r"[^\x20\x09-\x0D]+"
ROW = ["sid", "doc_id", "content", "copy", "size"]


@dataclass
class Mix:
    sources: DataFrame  # sid, source, source_size, target, taken, slots
    rows: DataFrame     # sid, doc_id, content (md5 of the text), copy, size, start: all documents in stream order
    spans: DataFrame    # position, sid, pass, doc_id, content, copy, size, start, length: what stands in the mix, in order


def exploded(df: DataFrame, n: str, name: str, step: int | None = None) -> DataFrame:
    """One row per number below ``n`` (column ``name``); rows of more than ``step`` are dealt to tasks in parts first."""
    step = STEP if step is None else step
    few = df.where(F.col(n) <= step).select("*", F.explode(F.expr(f"sequence(0L, {n} - 1)")).alias(name))
    many = df.where(F.col(n) > step)
    total = many.agg(F.sum(n)).first()[0]
    if not total:
        return few
    parts = many.select("*", F.explode(F.expr(f"sequence(0L, ({n} - 1) div {step})")).alias("__part"))
    # The number of tasks is given, as small rows that grow when exploded would be dealt to few.
    parts = parts.repartition(-(-total // (4 * step)), F.xxhash64("__part", *[F.col(c) for c in df.columns]))
    inside = parts.select(*df.columns, F.explode(F.expr(
        f"sequence(__part * {step}, least({n}, (__part + 1) * {step}) - 1)")).alias(name))
    return few.unionByName(inside)


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def weigh_123(sid: Column) -> Column:
    return F.pmod(sid, F.lit(3)) + 1


def with_targets(sources: DataFrame, repeats: int) -> DataFrame:
    """Adds ``target``. Sources above their limit are set to it and the rest shared again; numbers are exact until the last."""
    whole, held, held_weight, above = sources.agg(F.sum("source_size"), F.sum("weight")).first(), 0, 0, -1
    total, weights = whole[0] or 0, whole[1] or 0
    big, limit = "decimal(38,0)", F.col("source_size") * repeats
    while True:
        left, rest = total - held, max(weights - held_weight, 1)
        share = F.lit(left).cast(big) * F.col("weight")
        over = limit.cast(big) * F.lit(rest) < share
        row = sources.where(over).agg(F.count("*"), F.sum(limit), F.sum("weight")).first()
        if row[0] == above or row[0] == 0:
            return sources.withColumn("target", F.when(over, limit.cast("double")).otherwise(
                share.cast("double") / F.lit(float(rest))))
        above, held, held_weight = row[0], row[1], row[2]


def reversed_rank(v: str, low: str, high: str, bits: int) -> Column:
    """How many integers of [low, high) come before ``v`` in the order of reversed bits.

    They agree with v in the j lowest bits and have 0 where v has 1 in bit j, for some j; those of one j are a
    residue class, counted in both ends of the interval.
    """
    def below(x: str) -> str:
        return f"(({x} + (2L << j) - 1 - ({v} & ((1L << j) - 1))) >> (j + 1))"
    return F.expr(f"aggregate(sequence(0, {max(bits - 1, 0)}), 0L, (n, j) -> n + "
                  f"if((({v} >> j) & 1) = 1, {below(high)} - {below(low)}, 0L))")


def schedule(sources: DataFrame) -> DataFrame:
    """sid, rank (of the slot among its source's), position (among all): ``sources`` has sid, slots and first (cumulative)."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    bits = max(total - 1, 1).bit_length()
    own = exploded(sources.where("slots > 0").select("sid", "slots", "first"), "slots", "k", SLOTS_STEP)
    own = own.select("sid", (F.col("first") + F.col("k")).alias("v"), "first", (F.col("first") + F.col("slots")).alias("end"))
    return own.select("sid", reversed_rank("v", "first", "end", bits).alias("rank"),
                      reversed_rank("v", "0L", f"{total}L", bits).alias("position"))


def mix(docs: DataFrame, weigh=weigh_123, repeats: int = 3, block: int = BLOCK, seed: int = 11,
        bucket_rows: int = BUCKET_ROWS) -> Mix:
    """Mix all of ``docs`` (doc_id, text, source). ``weigh`` makes a source's integer weight from its place in code point order."""
    one = plain(docs, "doc_id", "text", "source").select(
        "doc_id", "source", words(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("content"))
    units = settle(one.groupBy("source", "doc_id", "content", "size").agg(F.count("*").alias("copies")), "units")
    named = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"),
                                        F.sum("copies").alias("n"))
    named = ordinals(named, [F.col("source").asc_nulls_last()], "sid")
    named = settle(named.withColumn("weight", weigh(F.col("sid")).cast("long")), "sources")
    sources = with_targets(named, repeats)
    taken = F.floor(F.col("target") + 0.5).cast("long")
    sources = sources.withColumns({"taken": taken, "blocks": F.expr(f"(source_size + {block - 1}) div {block}")})
    slots = F.expr(f"""case when source_size = 0 then 0L else (taken div source_size) * blocks
        + (taken % source_size + {block - 1}) div {block} end""")
    sources = settle(sources.withColumn("slots", slots), "targets")
    sources = settle(offsets(sources, [], "sid", ["slots"]).withColumnRenamed("before_slots", "first"), "sources")

    known = attach(units, sources.select("source", "sid", F.expr(f"(n + {bucket_rows - 1}) div {bucket_rows}").alias("__buckets")),
                   ["source"], "left", salt_by=["doc_id", "content"])
    rows = exploded(known, "copies", "copy")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "content",
                              F.col("copy").cast("string")))
    rows = rows.withColumn("order", order).withColumn(
        "bucket", F.expr("shiftright(cast(conv(substring(order, 1, 8), 16, 10) as bigint) * __buckets, 32)"))
    rows = settle(rows.select(*ROW, "order", "bucket"), "shuffled")
    totals = settle(rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words")), "totals")
    before = offsets(totals, ["sid"], "bucket", ["words"]).select("sid", "bucket", "before_words")
    # A document without words shifts nothing, so it needs no place in the stream.
    inside = rows.where("size > 0").selectExpr("*", """coalesce(sum(size) over (partition by sid, bucket order by order
        rows between unbounded preceding and 1 preceding), 0L) as __inside""")
    placed = attach(inside, before, ["sid", "bucket"], "left", salt_by=["order"]).withColumn(
        "start", F.col("before_words") + F.col("__inside"))
    pieces = placed.select(*ROW, "start", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"))
    pieces = pieces.select(*ROW, "block", F.greatest("start", F.col("block") * block).alias("at"), F.expr(
        f"least(start + size, (block + 1) * {block})").alias("end"), F.col("start").alias("doc_at"))

    lengths = sources.select("sid", "source_size", "taken", F.col("blocks").alias("__blocks"))
    takes = attach(schedule(sources), lengths, ["sid"], "left", salt_by=["rank"]).where("__blocks > 0").selectExpr(
        "sid", "position", "rank div __blocks as pass", "rank % __blocks as block",
        "case when rank div __blocks = taken div source_size then taken % source_size else source_size end as upto")
    spans = pieces.join(takes, ["sid", "block"]).where("at < upto").selectExpr(
        "position", "pass", *ROW, "at - doc_at as start", "least(end, upto) - at as length")
    return Mix(sources, rows, spans)


def span_texts(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds ``text``: the words of each span, joined by blanks."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = plain(docs, "doc_id", "text").select(
        F.col("doc_id").alias("__id"), F.md5(text).alias("content"), text.alias("text")).dropDuplicates(["__id", "content"])
    joined = spans.join(source, spans["doc_id"].eqNullSafe(F.col("__id")) & (spans["content"] == source["content"]))
    return joined.select(*[spans[c] for c in spans.columns], F.array_join(F.slice(
        F.regexp_extract_all("text", F.lit(WORD), 0), F.col("start").cast("int") + 1, F.col("length").cast("int")), " ").alias("text"))


SQL = r"""with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        md5(coalesce(text, '')) as content from documents),
u as (select *, row_number() over (partition by source, doc_id, content) - 1 as copy from d),
s as (select source, sum(size)::bigint as source_size from u group by source),
r as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from s),
o as (select *, 3 * source_size::hugeint as cap, row_number() over (order by 3 * source_size::double / w, source nulls last) as k from r),
c as (select *, sum(source_size) over () as total,
        coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0) as held,
        sum(w) over () - coalesce(sum(w) over (order by k rows between unbounded preceding and 1 preceding), 0) as rest from o),
f as (select min(k) as k from c where (total - held) * w <= cap * rest),
t as (select c.source, c.source_size, case when c.k < f.k or f.k is null then c.cap::double
        else ((l.total - l.held) * c.w)::double / l.rest::double end as target
    from c, f left join c l on l.k = f.k),
x as (select u.*, t.source_size, t.target, floor(t.target + 0.5)::bigint as n, coalesce(sum(size) over (partition by u.source
        order by md5('11:' || coalesce(doc_id::varchar, '') || ':' || content || ':' || copy)
        rows between unbounded preceding and 1 preceding), 0) as pos
    from u join t on u.source is not distinct from t.source)
select doc_id, size, source_size, target, case when size = 0 then 0 else (n // source_size) * size
    + greatest(0, least(size, n % source_size - pos)) end::bigint as taken from x"""


@query("op11_mixing", SQL)
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mix(table(spark, sf_dir, "documents"))
    each = done.rows.select(*ROW, F.lit(0).cast("long").alias("length")).unionByName(done.spans.select(*ROW, "length"))
    each = each.groupBy(*ROW).agg(F.sum("length").alias("taken"))
    return attach(each, done.sources.select("sid", "source_size", "target"), ["sid"], "left", salt_by=["doc_id", "content"]).select(
        "doc_id", "size", "source_size", "target", "taken")
