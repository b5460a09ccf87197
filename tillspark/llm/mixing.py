"""Mixing sources to target weights in fixed-length blocks.

The words of a source, document after document, are packed into blocks of a
fixed number of words.  The mix is a number of output shards of equally many
block slots.  Each shard draws its counts of slots per source from a
multinomial distribution; the slots of a source are numbered through all
shards, and a pseudorandom permutation of the source's block indices, another
for every pass over the source, maps them to blocks.  Blocks join by index.

Chance alone would leave a source above or below its target, and could take a
block once too often.  So of a source's slots only as many count as its target
has blocks; those beyond are given to the sources that have drawn too few.
Every source then ends within one block of its target.

Everything follows from hashes of ids and positions: reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.llm.tables import stored
from tillspark.llm.words import WORD

#: Weights of the sources in order, again and again.
WEIGHTS = (5, 2, 1)
#: The times that any document may be taken.
MOST = 3
BLOCK_WORDS, SHARD_SLOTS, SEED = 64, 4096, 20
#: Slots that a task makes, about.
TASK_SLOTS = 200_000
#: Rounds of the index permutation.
ROUNDS = 12
#: Numbers under one join cell of the draw.
CELL = 1024


def running(df: DataFrame, by: list[str], order: list[str], value: str, name: str, rows: int, bucket: Column | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``by`` that come earlier.

    Rows are dealt to about sqrt(rows) buckets, by the first order column's
    hash unless ``bucket`` numbers them; the order is by bucket, then by
    ``order``.  So no task holds more than about sqrt(rows) rows of one ``by``.
    """
    n = max(1, math.isqrt(rows))
    rows_in = df.withColumn("_bucket", F.pmod(F.xxhash64(order[0]), F.lit(n)) if bucket is None else bucket)
    keys = [*by, "_bucket"]
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows_in.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(earlier(Window.partitionBy(*by or [F.lit(0)]).orderBy("_bucket"))), F.lit(0))
    offsets = sums.select(*keys, before.alias("_before"))
    inside = F.coalesce(F.sum(value).over(earlier(Window.partitionBy(*keys).orderBy(*order))), F.lit(0))
    return rows_in.withColumn("_inside", inside).join(offsets, keys).withColumn(name, F.col("_before") + F.col("_inside")).drop("_bucket", "_inside", "_before")


def permuted(index: Column, size: Column, *keys: Column) -> Column:
    """Image of ``index``, 0 to ``size`` - 1, under a pseudorandom permutation that ``keys`` choose.

    Swap-or-not: every round pairs index x with k - x and swaps the pair or not
    by a hash of the round and the larger of the two.  Each round is its own
    inverse, so the whole is a permutation, of any size.
    """

    def swapped(x: Column, r: Column) -> Column:
        pair = F.pmod(F.pmod(F.xxhash64(*keys, 2 * r), size) + size - x, size)
        heads = F.xxhash64(*keys, 2 * r + 1, F.greatest(x, pair)).bitwiseAND(F.lit(1)) == 1
        return F.when(heads, pair).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index, swapped)


def with_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``number`` in order (null last), ``source_size`` and ``target`` in words.

    Targets share the sum of all sizes by weight; none exceeds ``MOST`` times
    its source's size, and what is cut is shared among the others.  The words
    per unit of weight that this ends at is the largest that any number of the
    sources that fill up first leaves to the rest.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = Window.partitionBy(F.lit(0))
    k = F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("number"), F.lit(len(WEIGHTS))) + 1)
    per = per.withColumn("number", k - 1).withColumn("weight", weight).withColumn("most", MOST * F.col("source_size"))
    fills = whole.orderBy((F.col("most") / F.col("weight")).asc(), "number")
    full = F.coalesce(F.sum("most").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(fills.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    share = F.max("_share").over(whole)
    return (
        per.withColumn("_share", (F.sum("source_size").over(whole) - full) / rest)
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * share))
        .select("source", "number", "source_size", "target")
    )


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size in words of every document; a null text has none."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def placed(sizes: DataFrame, sources: DataFrame, rows: int) -> DataFrame:
    """Every document with its source's columns and ``offset``, the words before it in its source's line of documents."""
    own = sources.withColumnRenamed("source", "_source")
    numbered = sizes.join(own, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return running(numbered, ["number"], ["doc_id", "size"], "size", "offset", rows)


def pieces(documents: DataFrame) -> DataFrame:
    """Parts of documents by block: number, block, doc_id, offset, first_word (in the document) and n_words."""
    start, end = F.col("offset"), F.col("offset") + F.col("size")
    block = F.explode(F.sequence(F.floor(start / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS)))
    cut = documents.filter("size > 0").select("number", "doc_id", "offset", "size", block.alias("block"))
    low = F.greatest(start, F.col("block") * BLOCK_WORDS)
    high = F.least(end, (F.col("block") + 1) * BLOCK_WORDS)
    return cut.select("number", "block", "doc_id", "offset", (low - start).alias("first_word"), (high - low).alias("n_words"))


def block_draws(sources: DataFrame) -> DataFrame:
    """Per source that has words: n_blocks, and how many block draws (``draws``) reach its target."""
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    wanted = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")
    return sources.filter("source_size > 0").withColumn("n_blocks", blocks.cast("long")).withColumn("draws", wanted)


def _each(start: str, n: str) -> Column:
    """The n numbers from start on, a row each."""
    return F.explode(F.sequence(F.col(start), F.col(start) + F.col(n) - 1))


def slots(sources: DataFrame) -> DataFrame:
    """One row per slot of the mix: shard, number, n_blocks and ``draw``, the slot's place among its source's draws."""
    spark = sources.sparkSession
    drawn = stored(block_draws(sources), "block-draws")
    total = drawn.agg(F.sum("draws")).first()[0] or 0
    if not total:
        return drawn.select(F.lit(0).cast("long").alias("shard"), "number", "n_blocks", F.col("draws").alias("draw")).limit(0)
    shards = -(-total // SHARD_SLOTS)
    n_sources = drawn.count()

    # Each slot of a shard throws a number; the source whose span of numbers it falls in is drawn.
    spans = running(drawn, [], ["number"], "draws", "low", n_sources).withColumn("high", F.col("low") + F.col("draws")).filter("draws > 0")
    cells = spans.select("number", "draws", "n_blocks", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL))).alias("cell"))
    thrown = spark.range(total).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"), F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(total)).alias("x")
    ).withColumn("cell", F.floor(F.col("x") / CELL))
    counts = thrown.join(cells, "cell").filter("x >= low and x < high").groupBy("shard", "number", "draws", "n_blocks").agg(F.count(F.lit(1)).alias("n"))

    # A source's slots are numbered through the shards; those beyond its draws are free for others.
    by_root = lambda n: F.floor(F.col("shard") / max(1, math.isqrt(n)))
    counts = stored(running(counts, ["number"], ["shard"], "n", "start", shards, by_root(shards)), "slot-counts")
    counts = counts.withColumn("own", F.greatest(F.least(F.col("n"), F.col("draws") - F.col("start")), F.lit(0)))
    # The counts are few rows, each of which becomes many slots: deal them out by what they become.
    dealt = counts.filter("own > 0").repartition(-(-total // TASK_SLOTS), "shard", "number")
    own = dealt.select("shard", "number", "n_blocks", _each("start", "own").alias("draw"))

    freed = counts.groupBy("shard").agg(F.sum(F.col("n") - F.col("own")).alias("free")).filter("free > 0")
    freed = running(freed, [], ["shard"], "free", "first", shards, by_root(shards))
    freed = freed.select("shard", _each("first", "free").alias("place"))
    got = counts.groupBy("number").agg(F.sum("own").alias("got"))
    short = drawn.join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0))).withColumn("missing", F.col("draws") - F.col("got")).filter("missing > 0")
    short = stored(running(short, [], ["number"], "missing", "first", n_sources), "short-sources")
    missing = short.agg(F.sum("missing")).first()[0] or 0
    refill = short.select("number", "n_blocks", "got", "first", _each("first", "missing").alias("place"))
    refill = refill.select(
        "number", "n_blocks", (F.col("got") + F.col("place") - F.col("first")).alias("draw"),
        permuted(F.col("place"), F.lit(missing).cast("long"), F.lit(SEED)).alias("place"),
    )
    return own.unionByName(freed.join(refill, "place").select("shard", "number", "n_blocks", "draw"))


def mixed(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix: shard, number, draw, block, and the parts of documents that the block consists of."""
    turn, n = F.pmod("draw", "n_blocks"), F.col("n_blocks")
    block = permuted(turn, n, F.col("number"), F.floor(F.col("draw") / n))
    drawn = slots(sources).select("shard", "number", "draw", block.alias("block"))
    return drawn.join(pieces(documents), ["number", "block"])


def mix(docs: DataFrame) -> DataFrame:
    """Every document with size, its source's source_size and target, and the words ``taken`` from it.

    A document without words is never taken.  Documents with the same doc_id
    are documents of their own; null ids and a null source are as good as any.
    """
    sizes = stored(sized(docs), "sizes")
    rows = sizes.count()
    sources = stored(with_targets(sizes), "sources")
    documents = stored(placed(sizes, sources, rows), "documents")
    taken = mixed(documents, sources).groupBy("number", "offset").agg(F.sum("n_words").alias("taken"))
    place = F.when(F.col("size") > 0, F.col("offset")).alias("offset")
    all_of = documents.select("doc_id", "source", "number", place, "size", "source_size", "target")
    return all_of.join(taken, ["number", "offset"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
