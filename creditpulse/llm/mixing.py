"""Mixing sources to target weights, with DataFrame functions only.

Method: each source's documents, in pseudorandom order, form one stream of
words that is packed into blocks of fixed length (documents may be cut between
blocks). Every output shard draws its slots' sources independently, a
multinomial count per source; the draw is then settled so that each source
fills just its number of slots, surplus slots going to the sources that fell
short. A source's ``k``-th slot takes block ``p(k mod blocks)``, where ``p`` is a
pseudorandom permutation of the source's block numbers (swap-or-not rounds),
another one for each pass over the source; slots and blocks are joined by
``(source, block)``. Before any block comes a second time all came once.

Running sums go by two levels (within and over about ``sqrt(n)`` buckets), so a
source with a third of all rows is spread over many tasks.

Targets: sources in code-point order, null last, share ``ratio`` times all
words by ``weights`` (repeating); a target stops at ``cap`` times its source's
words and the excess is shared anew by weight. In closed form each target is
``min(cap * size, weight * level)`` with the level at which they sum up.

Defined results: null or empty texts have size 0 and are never taken; a source
without words has target 0; rows with equal ids are separate documents, ties
in the order are settled by the row's place in its file.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditpulse.llm.common import WORD, cut, numbered

ROUNDS = 24  # swap-or-not rounds


def uniform(*cols) -> Column:
    """A pseudorandom number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def running_start(df: DataFrame, key: str, bucket: Column, order: list, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same ``key``, by bucket and
    then by ``order``: within buckets, plus the sums of the earlier buckets."""
    rows = df.withColumn("__bucket", bucket)
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(key, "__bucket").agg(F.sum(value).alias("__sum"))
              .withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum"))
    inside = Window.partitionBy(key, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(starts, [key, "__bucket"])
            .withColumn(name, (F.col("__start") + F.col("__inside")).cast("long"))
            .drop("__start", "__inside", "__bucket"))


def source_targets(sizes: DataFrame, weights: tuple, ratio: float, cap: float) -> DataFrame:
    """``source, source_size`` -> with number ``s``, ``weight`` and ``target``; one row per source."""
    everything = Window.partitionBy()  # one row per source
    ranked = sizes.withColumn("s", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("s") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "s")
    level = ((F.sum(F.col("source_size")).over(everything) * ratio
              - F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    return (capped.withColumn("level", level).withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least("most", F.col("weight") * F.col("level")))
            .select("source", "source_size", "s", "weight", "target"))


def permuted(x: Column, blocks: Column, *names: Column) -> Column:
    """``x`` under a pseudorandom permutation of ``0 .. blocks - 1`` chosen by
    ``names``. Each round pairs ``x`` with ``key - x`` and swaps the pair or not."""
    def turn(now, r):
        other = F.pmod(F.xxhash64(*names, r) - now, blocks)
        swap = F.pmod(F.xxhash64(*names, r, F.greatest(now, other), F.lit("swap")), F.lit(2)) == 1
        return F.when(swap, other).otherwise(now)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, turn)


class Mixture:
    """A mix of ``docs``.

    ``documents``: what the mix takes of every row; ``slots``: shard, place in
    the shard, source number and block of every slot; ``pieces``: the words of
    documents that make up each block; ``sources``: sizes and targets.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: tuple = (3, 1, 2), ratio: float = 1.5, cap: float = 2.0, block_words: int = 128,
                 shard_slots: int = 1024, seed: int = 7, row_col: str | None = None):
        self.block_words, self.shard_slots, self.seed = block_words, shard_slots, F.lit(seed)
        sized = numbered(docs, row_col).select(
            F.col("__row").alias("row_id"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"))
        rows = cut(sized.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
        sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        blocks = F.ceil(F.col("source_size") / block_words)
        slots = F.least(F.round(F.col("target") / F.col("source_size") * blocks), F.lit(cap) * blocks)
        self.sources = cut(
            source_targets(sizes, weights, ratio, cap).withColumn("blocks", blocks.cast("long"))
            .withColumn("n_slots", F.when(F.col("source_size") > 0, slots).otherwise(0).cast("long")), "mix-sources")
        of = self.sources.withColumnRenamed("source", "of_source")
        self.rows = rows.join(of, rows["source"].eqNullSafe(of["of_source"])).drop("of_source")
        self.pieces = self._pieces(math.isqrt(rows.count()))
        self.total = self.sources.agg(F.sum("n_slots")).first()[0] or 0
        self.counts = self._counts(self.total)
        self.slots = self._slots()
        self.documents = self._documents()

    def _pieces(self, buckets: int) -> DataFrame:
        placed = running_start(
            self.rows.where("size > 0").select("row", "row_id", "id", "s", "size", F.xxhash64(self.seed, "id").alias("place")),
            "s", F.pmod("place", F.lit(max(1, buckets))), ["place", "id", "row_id"], "size", "start")
        width = self.block_words
        at, end = F.col("block") * width, F.col("start") + F.col("size")
        blocks = F.expr(f"sequence(start div {width}, (start + size - 1) div {width})")
        return placed.withColumn("block", F.explode(blocks)).select(
            "s", "block", "row", "id", (F.greatest("start", at) - F.col("start")).alias("first_word"),
            (F.least(end, at + width) - F.greatest("start", at)).alias("words"))

    def _drawn(self, total: int) -> DataFrame:
        """Multinomial source counts of every shard. A slot draws a point of
        ``[0, total)``; sources lie there as intervals, met by way of equal cells."""
        earlier = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        cell = max(1, total // 4096)
        cells = (self.sources.where("n_slots > 0")
                 .select("s", "n_slots", F.coalesce(F.sum("n_slots").over(earlier), F.lit(0)).alias("low"))
                 .withColumn("high", F.col("low") + F.col("n_slots"))
                 .withColumn("cell", F.explode(F.expr(f"sequence(low div {cell}, (high - 1) div {cell})"))))
        points = self.sources.sparkSession.range(total).select(
            F.expr(f"id div {self.shard_slots}").alias("shard"),
            F.pmod(F.xxhash64(self.seed, F.lit("draw"), "id"), F.lit(max(1, total))).alias("point"))
        return (points.withColumn("cell", F.expr(f"point div {cell}")).join(cells, "cell")
                .where("point >= low and point < high").groupBy("shard", "s").agg(F.count("*").alias("drawn")))

    def _counts(self, total: int) -> DataFrame:
        """Settled slots per ``shard, s`` and ``first_k``, the source's slots in earlier shards."""
        group = F.expr(f"shard div {max(1, math.isqrt(total // self.shard_slots))}")
        drawn = cut(self._drawn(total), "mix-draws")
        kept = (running_start(drawn, "s", group, ["shard"], "drawn", "before").join(self.sources.select("s", "n_slots"), "s")
                .withColumn("kept", F.least("drawn", F.greatest(F.lit(0), F.col("n_slots") - F.col("before")))))
        kept = cut(kept.select("shard", "s", "kept", (F.col("drawn") - F.col("kept")).alias("surplus")), "mix-kept")
        # Surplus slots, by shard, and missing slots, by source, lie on one line; they meet in cells of it.
        surplus = kept.groupBy("shard").agg(F.sum("surplus").alias("n")).where("n > 0").withColumn("all", F.lit(0))
        surplus = running_start(surplus, "all", group, ["shard"], "n", "low").drop("all")
        missing = (self.sources.select("s", "n_slots").join(kept.groupBy("s").agg(F.sum("kept").alias("have")), "s", "left")
                   .select("s", (F.col("n_slots") - F.coalesce("have", F.lit(0))).alias("n")).where("n > 0"))
        earlier = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        missing = missing.withColumn("low", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        in_cells = lambda df, name: df.select(
            name, F.col("low").alias(f"low_{name}"), (F.col("low") + F.col("n")).alias(f"high_{name}"),
            F.explode(F.expr(f"sequence(low div {self.shard_slots}, (low + n - 1) div {self.shard_slots})")).alias("cell"))
        low, high = F.greatest("low_shard", "low_s", F.col("cell") * self.shard_slots), F.least(
            "high_shard", "high_s", (F.col("cell") + 1) * self.shard_slots)
        given = (in_cells(surplus, "shard").join(in_cells(missing, "s"), "cell")
                 .select("shard", "s", (high - low).alias("n")).where("n > 0"))
        settled = (kept.select("shard", "s", F.col("kept").alias("n")).union(given)
                   .groupBy("shard", "s").agg(F.sum("n").alias("n")).where("n > 0"))
        return running_start(settled, "s", group, ["shard"], "n", "first_k")

    def _slots(self) -> DataFrame:
        # A row becomes up to shard_slots slots: dealt out first, as sizes at run time do not show that.
        tasks = max(int(self.sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), self.total >> 19)
        each = (self.counts.join(self.sources.select("s", "blocks"), "s").repartition(tasks, "s", "shard")
                .withColumn("k", F.explode(F.expr("sequence(first_k, first_k + n - 1)")))
                .withColumn("round", F.expr("k div blocks")))
        return each.select("shard", "s", "k", permuted(F.expr("k % blocks"), F.col("blocks"), self.seed, F.col("s"), F.col("round")).alias("block"))

    def ordered_slots(self) -> DataFrame:
        """``slots`` with ``slot``, the pseudorandom place within the shard."""
        by_hash = Window.partitionBy("shard").orderBy(F.xxhash64(self.seed, "shard", "s", "k"), "s", "k")
        return self.slots.withColumn("slot", F.row_number().over(by_hash) - 1)

    def _documents(self) -> DataFrame:
        times = self.slots.groupBy("s", "block").agg(F.count("*").alias("times"))
        taken = (self.pieces.join(times, ["s", "block"])
                 .groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
        return self.rows.join(taken, "row", "left").select(
            "row_id", "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def copies(documents: DataFrame, seed: int = 7) -> DataFrame:
    """Whole-document form of a mix: ``row_id, copies``, where copies is
    ``taken / size`` rounded up or down by the id's hash."""
    share = F.col("taken") / F.col("size")
    return (documents.where("taken > 0")
            .select("row_id", F.floor(share + uniform(F.lit(seed), F.lit("copies"), "id")).cast("int").alias("copies")))
