"""Mixing sources to target weights (operator 7).

Sources sorted by code point (null last) weigh 5, 2, 1, repeating, and share
``budget`` times all words; no source gets more than ``max_repeat`` times its
own words, and what a capped source leaves is shared among the others by
weight (water filling: target = min(cap, level * weight)).

A source's words, its documents in shuffled order (a hash of the id), are cut
into blocks of equal size (to a word), ``block_words`` at most.  The source
gets as many slots as its target, rounded to a word, needs: the r-th slot
takes the r-th block, after the last block a new pass begins, and the last
slot takes only the words still due.  So every source, however small, takes its
target to a word, and no document is taken more than ``max_repeat`` times.

The order of the mix is a low-discrepancy schedule: the slots are numbered
source by source, and the mix takes them in the order of the base-2 van der
Corput sequence (numbers with their bits reversed), so every stretch of the
mix holds each source in its share of the slots.  A document's place in the mix
is the first slot that takes words of it.

Ranks and word positions are two-level running sums (bucket totals, then
inside a bucket), so a source with a third of all rows is spread over many
tasks.  The map from a number to its source is an equi-join on cells of the
numbers.

Defined cases: null text or text without words has size 0 and takes 0;
null source is a source of its own, last; repeated rows are mixed as
separate documents; without words there is no slot and every target is 0;
reruns agree, since order depends on ids and texts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, repeat_rows, running_total, saved

WEIGHTS = (5, 2, 1)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, budget: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """One row per source: ``src`` (its rank), ``source``, ``rows``,
    ``source_size``, ``weight``, ``target``.  The windows run over one row per
    source, never over documents."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("src") % len(WEIGHTS) + 1).cast("double")
    per = (per.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * max_repeat)
           .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(budget)))
           .withColumn("all_weight", F.sum("weight").over(everything)))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("capped", F.col("cap") * left_weight <= F.col("weight") * left)
    free_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    free = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * free / free_weight)
    return per.select("src", "source", "rows", "source_size", "weight", target.alias("target"))


def bit_reversed(i: Column, bits: int) -> Column:
    """The non-negative integer below 2^bits whose bits are those of ``i`` in reverse."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, "0")), 2, 10).cast("long")


def blocks_of(targets: DataFrame, block_words: int = 64) -> DataFrame:
    """Per source with words: ``n_blocks``, the first ``longer`` of ``short + 1``
    words and the others of ``short``; ``due`` words to take, in ``n_slots``
    slots, the last of ``last_words``."""
    ceil = F.expr(f"source_size div {block_words} + cast(source_size % {block_words} > 0 as bigint)")
    per = (targets.filter("source_size > 0").withColumn("n_blocks", ceil).withColumn("due", F.floor(F.col("target") + F.lit(0.5)))
           .withColumn("short", F.expr("source_size div n_blocks")).withColumn("longer", F.expr("source_size % n_blocks"))
           .withColumn("rest", F.expr("due % source_size")))
    last = block_at(F.col("rest") - 1)                           # the block that the last pass ends in
    per = per.withColumn("n_slots", F.expr("due div source_size") * F.col("n_blocks") + F.when(F.col("rest") > 0, last + 1).otherwise(0))
    cut = F.when(F.col("rest") > 0, F.col("rest") - block_start(last)).otherwise(block_start(F.col("n_blocks")) - block_start(F.col("n_blocks") - 1))
    return per.select("src", "n_blocks", "short", "longer", "due", "n_slots", cut.alias("last_words"))


def block_start(block: Column) -> Column:
    return block * F.col("short") + F.least(block, F.col("longer"))


def block_at(word: Column) -> Column:
    """The block that holds the word."""
    in_longer = F.col("longer") * (F.col("short") + 1)
    return F.when(word < in_longer, F.floor(word / (F.col("short") + 1))).otherwise(F.col("longer") + F.floor((word - in_longer) / F.col("short")))


def slots(blocks: DataFrame, chunk_bits: int = 14) -> DataFrame:
    """The schedule: (slot, src, rank), rank counting the slots of one source;
    slots are ordered, not without gaps."""
    spark = blocks.sparkSession
    n_slots, n_sources = blocks.agg(F.sum("n_slots"), F.count(F.lit(1))).first()
    n_slots = n_slots or 0
    bits = max(0, n_slots - 1).bit_length()
    width = max(1, n_slots // max(64, 4 * n_sources))
    upto = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = (blocks.select("src", "n_slots", F.sum("n_slots").over(upto).alias("hi")).withColumn("lo", F.col("hi") - F.col("n_slots"))
              .filter("hi > lo")
              .select("src", "lo", "hi", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))).alias("cell")))
    numbers = spark.range(1 << bits if n_slots else 0).select(F.col("id").alias("slot"), bit_reversed(F.col("id"), max(1, bits)).alias("number"))
    placed = (numbers.filter(F.col("number") < n_slots).withColumn("cell", F.expr(f"number div {width}")).join(shares, "cell")
              .filter("lo <= number AND number < hi")
              .select("slot", "src", F.shiftright("slot", chunk_bits).alias("chunk")))
    inside = Window.partitionBy("chunk", "src").orderBy("slot")
    ranked = placed.withColumn("inside", F.row_number().over(inside) - 1)
    bases = running_total(placed.groupBy("chunk", "src").agg(F.count(F.lit(1)).alias("n")), ["src"], "chunk", "n", "base")
    return (ranked.join(bases.select("chunk", "src", "base"), ["chunk", "src"])
            .select("slot", "src", (F.col("base") + F.col("inside")).alias("rank")))


def positions(docs: DataFrame, targets: DataFrame, bucket_rows: int = 4096) -> DataFrame:
    """``docs`` with ``start``: the words of its source before it in shuffled order."""
    spot = F.col("key").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    n_buckets = F.ceil(F.col("rows") / bucket_rows)
    keyed = docs.withColumn("bucket", F.least(F.floor(spot * n_buckets), n_buckets - 1))
    bases = running_total(keyed.groupBy("src", "bucket").agg(F.sum("size").alias("n")), ["src"], "bucket", "n", "base")
    inside = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    return (keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(bases.select("src", "bucket", "base"), ["src", "bucket"])
            .withColumn("start", F.col("base") + F.col("inside")).drop("inside", "base", "bucket"))


def mix(docs: DataFrame, budget: float = 1.5, max_repeat: int = 2, block_words: int = 64, seed: int = 20,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """``(documents, schedule)``.

    ``documents``: per input row doc_id, source, size, source_size, target, taken,
    first_slot (the earliest slot that takes words of it, null if none does), tie
    (a hash of the text).  ``schedule``: rows (slot, src, pass, block, first, words):
    slot order is the mix's order, and a slot takes the words ``[first, first + words)``
    of its source in shuffled order."""
    sizes = saved(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                              word_count(text).alias("size"),
                              F.xxhash64(F.lit(seed), F.col(doc_id).cast("long")).alias("key"),
                              F.xxhash64(F.col(text).cast("string")).alias("tie")), "mix-sizes")
    targets = saved(source_targets(sizes, budget, max_repeat), "mix-targets")
    blocks = saved(blocks_of(targets, block_words), "mix-blocks")
    whole = block_start(F.col("block") + 1) - F.col("first")
    schedule = (slots(blocks).join(blocks, "src")
                .withColumn("pass", F.expr("rank div n_blocks")).withColumn("block", F.expr("rank % n_blocks"))
                .withColumn("first", block_start(F.col("block")))
                .select("slot", "src", "pass", "block", "first",
                        F.when(F.col("rank") == F.col("n_slots") - 1, F.col("last_words")).otherwise(whole).alias("words")))
    known = targets.withColumnRenamed("source", "_source")
    docs_in = sizes.join(known, sizes["source"].eqNullSafe(known["_source"])).drop("_source")
    placed = positions(docs_in, targets)
    first, last = block_at(F.col("start")), block_at(F.col("start") + F.col("size") - 1)
    pieces = (placed.filter("size > 0").join(blocks.select("src", "short", "longer"), "src")
              .withColumn("block", F.explode(F.sequence(first, last)))
              .withColumn("lo", F.greatest(F.col("start"), block_start(F.col("block"))))
              .withColumn("hi", F.least(F.col("start") + F.col("size"), block_start(F.col("block") + 1)))
              .select("src", "start", "block", "lo", "hi"))
    # A block's visits differ in words only where the last slot takes less than all.
    visits = schedule.groupBy("src", "block", "first", "words").agg(F.count(F.lit(1)).alias("visits"), F.min("slot").alias("slot"))
    words = F.greatest(F.least(F.col("hi"), F.col("first") + F.col("words")) - F.col("lo"), F.lit(0))
    # Every row with words has a start of its own inside its source.
    taken = (pieces.join(visits, ["src", "block"]).groupBy("src", "start")
             .agg(F.sum(words * F.col("visits")).alias("taken"), F.min(F.when(words > 0, F.col("slot"))).alias("first_slot"))
             .withColumn("has_words", F.lit(True)))
    out = (placed.withColumn("has_words", F.col("size") > 0).join(taken, ["src", "start", "has_words"], "left")
           .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "tie"))
    return out, schedule


def take_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes its words,
    rounded to whole documents; rows without words go."""
    documents, _ = mix(docs, doc_id=doc_id, text=text, **settings)
    times = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + F.lit(0.5))
    copies = documents.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("rows"), F.sum(times).alias("copies"))
    return repeat_rows(docs, copies, doc_id, text)
