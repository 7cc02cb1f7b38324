"""SimHash near-duplicates: fingerprints that differ in few bits are linked.

Method: bit-sliced comparison. Fingerprints that can be within the radius agree
in two of ``radius + 2`` bit blocks, so each pair of blocks is a table of
buckets. Within buckets the fingerprints are stored as vertical bit planes;
shifting the planes by ``s`` lanes compares every fingerprint with its ``s``-th
neighbour at once, carry-save counters hold all those distances bitwise, and a
block of lanes is abandoned once every distance is past the radius.

Equal fingerprints collapse before any comparison. A bucket above
``TILE_ROWS`` is dealt into tiles and every pair of tiles is compared in a
task of its own, so no task holds more than two tiles. A task hands on the
links of a spanning forest of what it found, not all pairs.

Defined results: null or empty text has fingerprint zero, linked like any
other; fewer words than a shingle: the whole sequence is one shingle; null ids
are ignored by ``component_id`` (null if a component has no other); repeated
ids and rows are kept row by row; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import byte_rows, cut, numbered, small_batches
from creditpulse.llm.components import components, union

SEED = 42
BITS = 64
TILE_ROWS = 2048
SHINGLE_BLOCK = 1 << 16
BUFFER_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash: a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        total = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        total = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, SHINGLE_BLOCK):
        n = min(SHINGLE_BLOCK, total - start)
        block = np.fromiter((digest(g, SEED) for g in itertools.islice(grams, n)), np.uint64, n)
        bits = np.unpackbits(block.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row ``b`` holds bit ``b`` of every fingerprint, 64 lanes a word.
    One spare word at the end feeds the lane shifts."""
    n = len(fps)
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    wide = np.zeros((BITS, (n // 64 + 2) * 8), np.uint8)
    wide[:, :packed.shape[1]] = packed
    return wide.view(np.uint64)


def near_lanes(planes: np.ndarray, shift: int, active: np.ndarray, radius: int) -> np.ndarray:
    """Lanes ``i`` (of ``active``) whose fingerprint is within ``radius`` of lane ``i + shift``."""
    words, bits = divmod(shift, 64)
    width = planes.shape[1] - 1 - words
    lanes = np.zeros(width * 8, np.uint8)
    packed = np.packbits(active, bitorder="little")[:width * 8]
    lanes[:len(packed)] = packed
    lanes = lanes.view(np.uint64)
    counters = [np.zeros(width, np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(width, np.uint64)
    for b in range(BITS):
        other = planes[b, words:words + width]
        if bits:
            other = (other >> np.uint64(bits)) | (planes[b, words + 1:words + 1 + width] << np.uint64(64 - bits))
        carry = planes[b, :width] ^ other
        for c in counters:  # carry-save: add the plane to the bitwise counters
            carry, c[:] = c & carry, c ^ carry
        over |= carry
        if b % 8 == 7 and not (lanes & ~over).any():
            return np.empty(0, np.int64)
    left = np.flatnonzero(np.unpackbits((lanes & ~over).view(np.uint8), bitorder="little"))
    distance = sum(((c[left >> 6] >> (left & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << j
                   for j, c in enumerate(counters))
    return left[distance <= radius]


def link_groups(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among near fingerprints of equal ``group`` (rows sorted by group)."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.repeat(np.diff(np.r_[first, len(group)]), np.diff(np.r_[first, len(group)]))
    parent = np.arange(len(fps))
    index, shift = parent.copy(), 1
    while True:
        index = index[size[index] > shift]  # groups with a partner that far away
        if not len(index):
            break
        planes, own = planes_of(fps[index]), group[index]
        stop = min(2 * shift, int(size[index].max()))
        for s in range(shift, stop):
            active = own[:-s] == own[s:] if s < len(own) else np.empty(0, bool)
            if not active.any():
                break
            hit = near_lanes(planes, s, active, radius)
            if len(hit):
                parent = union(parent, index[hit], index[hit + s])
        shift = stop if stop > shift else shift + 1
    linked = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[linked], fps[parent[linked]]


def bucket_links(fps: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links among the distinct fingerprints of ``fps (fp long)``."""
    blocks = radius + 2
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(masks[i] | masks[j]))).alias("key"))
            for t, (i, j) in enumerate(itertools.combinations(range(blocks), 2))]
    rows = fps.select("fp", F.inline(F.array(*keys)))
    big = cut(rows.groupBy("t", "key").count().where(F.col("count") > TILE_ROWS)
              .select("t", "key", F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("tiles")), "simhash-big")
    tile = F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1))).cast("int")
    dealt = (rows.join(big, ["t", "key"], "left").withColumn("tile", tile)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)))
             .select("fp", F.xxhash64("t", "key", F.least("tile", "other"), F.greatest("tile", "other")).alias("bucket")))
    # Two buckets with one 64-bit name would only be compared more, never less.
    sorted_rows = dealt.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches):
        held_fp, held_group = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held_fp = np.concatenate([held_fp, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)])
                held_group = np.concatenate([held_group, batch.column(1).to_numpy(zero_copy_only=False)])
                if len(held_fp) < BUFFER_ROWS:
                    continue
                ready = int(np.searchsorted(held_group, held_group[-1]))  # the last group may go on
                if not ready:
                    continue
            else:
                ready = len(held_fp)
            if ready:
                a, b = link_groups(held_fp[:ready], held_group[:ready], radius)
                held_fp, held_group = held_fp[ready:], held_group[ready:]
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return sorted_rows.mapInArrow(run, "a long, b long")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, row_col: str | None) -> DataFrame:
    """``row_id, id, fp`` of every row."""
    small_batches(docs.sparkSession)
    rows = numbered(docs, row_col).select(F.col("__row").alias("row_id"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t or b"", shingle) for t in byte_rows(batch.column("text"))]
            yield pa.record_batch([batch.column("row_id"), batch.column("id"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                                  names=["row_id", "id", "fp"])

    return rows.mapInArrow(run, f"row_id {kind['row_id']}, id {kind['id']}, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, row_col: str | None = None) -> DataFrame:
    """``row_id``, id, ``fingerprint``, ``component_id`` and ``kept`` of every row.

    ``kept`` is true for one row of each component: the smallest id's, and the
    first such row if it repeats. ``row_id`` is ``row_col``'s value, or
    the row's place in its file.
    """
    rows = cut(fingerprints(docs, id_col, text_col, shingle, row_col), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row_id")
    distinct = cut(rows.groupBy("fp").agg(F.min("id").alias("id"), F.min(order).alias("first")), "simhash-distinct")
    roots = components(bucket_links(distinct.select("fp"), radius))
    rooted = cut(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                 .withColumn("root", F.coalesce("root", "fp")), "simhash-roots")
    groups = rooted.groupBy("root").agg(F.min("id").alias("component_id"), F.min("first").alias("keeper"))
    classes = cut(rooted.select("fp", "root").join(groups, "root")
                  .select("fp", "component_id", F.col("keeper.row_id").alias("keeper")), "simhash-classes")
    return rows.join(classes, "fp").select(
        "row_id", F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", (F.col("row_id") == F.col("keeper")).alias("kept"))
