"""Mixing sources to target weights, in DataFrame operations only.

Every source's words, documents in a fixed pseudorandom order, are packed into
blocks of ``block_words`` words. The mix is a row of output shards with
``shard_blocks`` slots each. A source's total is its expectation, rounded with a
random offset, so it is within one block of its target. Given the totals, the
counts of the sources per shard are drawn multinomially: all turns are shuffled
over all slots by one permutation. The j-th slot of a source is mapped
through that source's index permutation (one per pass over the source) to a
block, and blocks and slots meet in a join on the block index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import exclusive_sums, stage, text_or_empty, uniform

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
DOCS_PER_BIN = 256
SEED = 20240601
ROUNDS = 10
BLOCKS_PER_TASK = 1 << 18
CHUNK = 1 << 12


@dataclass
class Mix:
    """``rows``: one row per document; ``sources``: one per source; ``blocks``:
    the words of a document in a block; ``slots``: the mix in output order."""

    rows: DataFrame
    sources: DataFrame
    blocks: DataFrame
    slots: DataFrame


def permuted(index: Column, size: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """``index`` under a swap-or-not shuffle of [0, size): a keyed bijection on
    any domain size. Each round pairs an index with its mirror image around a
    keyed point and swaps the pair or not by a keyed bit of the larger one."""
    def swap(x, r):
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        bit = F.xxhash64(*key, r, F.greatest(x, mirror)).bitwiseAND(1)
        return F.when(bit == 1, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), swap)


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = 1.5,
                   epochs: float = 2.0) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size; one row per
    source): weights in code point order of the source (null last) share
    ``budget`` times all sizes; a target stops at ``epochs`` times its size and
    the excess is shared anew by weight.

    With caps c and weights w the solution is min(c, w * level); sources reach
    their caps in the order of c / w, so one running sum finds the level.
    """
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("__ratio", "rank")
    ws = F.array(*[F.lit(float(w)) for w in weights])
    df = (sizes.withColumn("rank", F.row_number().over(named).cast("long") - 1)
          .withColumn("weight", F.get(ws, F.pmod("rank", F.lit(len(weights))).cast("int")))
          .withColumn("__cap", F.col("source_size") * F.lit(float(epochs)))
          .withColumn("__ratio", F.col("__cap") / F.col("weight"))
          .withColumn("__all", F.sum("source_size").over(everything) * F.lit(float(budget))))
    before, rest = (Window.unboundedPreceding, -1), (Window.currentRow, Window.unboundedFollowing)
    df = (df.withColumn("__done", F.coalesce(F.sum("__cap").over(by_ratio.rowsBetween(*before)), F.lit(0.0)))
          .withColumn("__left", F.sum("weight").over(by_ratio.rowsBetween(*rest)))
          .withColumn("__capped", F.col("__ratio") * F.col("__left") <= F.col("__all") - F.col("__done")))
    free = F.sum(F.when(~F.col("__capped"), F.col("weight"))).over(everything)
    used = F.coalesce(F.sum(F.when(F.col("__capped"), F.col("__cap"))).over(everything), F.lit(0.0))
    return (df.withColumn("target", F.when(F.col("__capped"), F.col("__cap"))
                          .otherwise((F.col("__all") - used) / free * F.col("weight")))
            .select("source", "source_size", "rank", "weight", "target"))


def _turns(sources: DataFrame, epochs: float) -> DataFrame:
    """Per source the number of its ``turns`` in the mix, the ``first`` place of
    them when all sources' turns stand in one row, and that row's length ``slots``.

    A source's expectation in blocks plus an offset in [0, 1) of the source is
    rounded down, so its total is within one block of its target."""
    df = (sources.filter("source_size > 0")
          .withColumn("__want", F.least(F.col("target") * F.col("blocks") / F.col("source_size"),
                                        F.col("blocks") * F.lit(float(epochs))))
          # the last turn of the cap by rounding of doubles only
          .withColumn("turns", F.least(F.floor(F.col("__want") + uniform(F.lit(SEED), F.col("rank"))).cast("long"),
                                       F.floor(F.col("blocks") * F.lit(float(epochs))).cast("long")))
          .filter("turns > 0"))
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    return df.select("rank", "blocks", "turns", F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("first"),
                     F.sum("turns").over(Window.partitionBy()).alias("slots"))


def _shard_counts(turns: DataFrame, shard_blocks: int, parts: int) -> DataFrame:
    """(rank, blocks, shard, count, before): the turns of each source drawn for
    each output shard, and how many of its turns are in earlier ones.

    The row of all turns is shuffled by a permutation of its places and cut into
    shards, so the counts are a multinomial draw by the sources' shares given
    the sources' totals, and all shards but the last are full. The row is
    unfolded in two steps, dealt out anew before each."""
    chunk, step = F.lit(CHUNK).cast("long"), F.lit(CHUNK * CHUNK).cast("long")
    last = F.col("turns") - 1
    chunks = (turns.withColumn("__step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / step))))
              .repartition(parts, "rank", "__step")
              .withColumn("__chunk", F.explode(F.sequence(F.col("__step") * chunk, F.least((F.col("__step") + 1) * chunk - 1, F.floor(last / chunk)))))
              .repartition(parts, "rank", "__chunk"))
    places = chunks.withColumn("turn", F.explode(F.sequence(F.col("__chunk") * chunk, F.least((F.col("__chunk") + 1) * chunk - 1, last))))
    drawn = permuted(F.col("first") + F.col("turn"), F.col("slots"), F.lit(SEED + 2))
    counts = (places.select("rank", "blocks", F.floor(drawn / F.lit(shard_blocks)).cast("long").alias("shard"))
              .groupBy("rank", "blocks", "shard").agg(F.count("*").alias("count")))
    return exclusive_sums(stage(counts, "mix-counts"), ["rank"], "shard", "count", "before")


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = 1.5, epochs: int = 2,
        block_words: int = 32, shard_blocks: int = 4096) -> Mix:
    """Plan a mix of ``docs`` (doc_id, text, source; other columns unused).

    A null text has no words; a null source is a source of its own; repeated
    rows count as rows of their own; an empty table gives an empty mix. The
    result depends on the rows only, not on their partitioning or order.
    """
    rows = stage(docs.select("doc_id", "source",
                             F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size")), "mix-sizes")
    # One row per source, as many as the mix's configuration names.
    sources = stage(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")),
                                   weights, budget, epochs)
                    .withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")), "mix-sources")
    bins = max(1, -(-rows.count() // DOCS_PER_BIN))
    keyed = (rows.join(sources.select(F.col("source").alias("__s"), "rank"), F.col("source").eqNullSafe(F.col("__s")))
             .drop("__s", "source")
             .withColumn("bin", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(bins))))
    within = Window.partitionBy("rank", "bin").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    starts = exclusive_sums(keyed.groupBy("rank", "bin").agg(F.sum("size").alias("__n")), ["rank"], "bin", "__n", "start")
    placed = stage(keyed.withColumn("__in", F.coalesce(F.sum("size").over(within), F.lit(0)))
                   .join(starts.select("rank", "bin", "start"), ["rank", "bin"])
                   .select("doc_id", "size", "rank", (F.col("__in") + F.col("start")).alias("offset")), "mix-placed")
    # Few compact rows unfold into many: deal them out by what they unfold to.
    n_blocks = sources.agg(F.sum("blocks")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_blocks // BLOCKS_PER_TASK + 1)
    width = F.lit(block_words).cast("long")
    first, last = F.floor(F.col("offset") / width), F.floor((F.col("offset") + F.col("size") - 1) / width)
    blocks = (placed.filter("size > 0").repartition(parts, "rank", "offset").withColumn("block", F.explode(F.sequence(first, last)))
              .withColumn("words", F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * width)
                          - F.greatest(F.col("offset"), F.col("block") * width)))
    slots = (_shard_counts(_turns(sources, epochs), shard_blocks, parts).repartition(parts, "rank", "shard")
             .withColumn("turn", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("count") - 1)))
             .withColumn("epoch", F.floor(F.col("turn") / F.col("blocks")).cast("long")))
    block = permuted(F.pmod("turn", "blocks"), F.col("blocks"), F.lit(SEED), F.col("rank"), F.col("epoch"))
    slots = slots.select("shard", "rank", "epoch", "turn", block.alias("block"))
    return Mix(placed, sources, blocks, slots)


def taken_words(plan: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words the mix takes from
    each document, repeats counted. One row per input row."""
    times = plan.slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
    # offsets are unique among a source's rows with words, so they name the row
    # both sides grow with the input, and their files say little of their unfolded size: no broadcast
    used = (plan.blocks.hint("merge").join(times, ["rank", "block"])
            .groupBy("rank", "offset", "doc_id", "size").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    key = ["rank", "offset", "size"]
    full = plan.rows.hint("merge").join(used.select(*key, "taken"), key, "left")
    return (full.join(plan.sources.select("rank", "source_size", "target"), "rank")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each document appears taken / size
    times, the fraction rounded up or down by a fixed pseudorandom draw (so a
    source keeps its target on average). Columns are those of ``docs``. Rows
    sharing a doc_id are taken alike; texts without words are not taken."""
    share = (taken_words(mix(docs, **options)).groupBy(F.col("doc_id").alias("__id"))
             .agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("__share")))
    whole = F.floor("__share")
    copies = (whole + (uniform(F.lit(SEED + 1), F.col("__id")) < F.col("__share") - whole).cast("long")).cast("int")
    narrow = stage(share.select("__id", copies.alias("__copies")).filter("__copies > 0"), "mix-copies")
    kept = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__doc")).join(
        narrow.hint("shuffle_hash"), F.col("__doc").eqNullSafe(F.col("__id")))
    return (kept.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select("__row.*"))
