"""Language-model scores from a log-frequency Bloom filter.

Method: the training documents' unigram and bigram counts are quantised to
levels (exact up to 8, then in steps of about a quarter), and every n-gram is
entered into one Bloom filter once per level up to its own. The filter is
broadcast; a worker reads a count back by asking for level 1, 2, ... until one
is missing. Probabilities are interpolated with the unigram model:

    P(w | h) = (c(h, w) + (c(h) - s(h) + mu) * P(w)) / (c(h) + mu)

where ``s(h)``, the summed counts of ``h``'s stored bigrams, is a third kind of
entry, so that the mass that is not stored goes to ``P(w)``.

Size: the filter grows with the corpus. The histogram of all counts gives the
number of keys, and the filter has as many groups of ``group_bytes`` as leave
``bits_per_key`` bits for each key; every word and every bigram seen
``min_bigram`` times is stored at any size. A group is one broadcast, and a
worker holds one group at a time: it gathers ``GATHER_BYTES`` of text and probes
group after group, each with the keys that live there, so memory is bounded and
a worker's reads of groups grow with their number. Only with ``filter_bytes``
set is there one filter of that size, and the cut-off rises until its keys fit.

Exact base columns need exact counts of every word. Those of the ``hot_words``
most frequent words at most (up to a level of counts; at most ``HOT_CHARS``
bytes each) are broadcast; all other words travel, summed per document, to a join with the full count table.

Defined results: null text counts as empty, which is one end token; null or
repeated ids and repeated rows are kept row by row (a null id is held out of
nothing: it trains, as does any id whose remainder is not 1); with no training
tokens at all every probability is that of the empty model; other columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import CHUNK_BYTES, byte_rows, chunks, cut, small_batches
from creditpulse.session import scratch_path

END = b"\n"  # no word: white space only
HOT_CHARS = 64
KEY_BITS = 48  # of an n-gram's hash; far more than the filter's own false positives need
SLICES = 1 << 12
COUNT_TOKENS = 4 << 20  # tokens that are counted together before they are sent on
SENT_ROWS = 1 << 16  # rows of counts in a batch
KNOWN_WORDS = 250_000  # words that a worker remembers besides the frequent ones
GATHER_BYTES = 8 << 20  # text that is probed together where the filter has several groups
MASK = np.uint64((1 << KEY_BITS) - 1)
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LEVEL_FLOORS = np.unique(np.concatenate([np.arange(1, 9), np.round(8 * 1.25 ** np.arange(1, 160))])).astype(np.float64)
#: What a level stands for: the middle of its range, in logs.
LEVEL_VALUES = np.r_[0.0, np.sqrt(LEVEL_FLOORS * np.maximum(LEVEL_FLOORS, np.r_[LEVEL_FLOORS[1:] - 1, LEVEL_FLOORS[-1]]))]


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def byte_values(column: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls, cut out of its bytes (a scalar
    made of each takes ten times as long)."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes() if data is not None else b""
    at = (at - at[0]).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


def coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``tokens`` of all texts at once: the distinct ones (``END`` is the last), each
    token's place among them, and the texts' numbers of tokens."""
    data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)  # a space ends each text
    inside = ~WHITE[data]
    start, stop = np.flatnonzero(np.diff(inside, prepend=False)).reshape(-1, 2).T
    offsets = np.r_[0, np.cumsum(stop - start)].astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    words = words.dictionary_encode()
    distinct = [*byte_values(words.dictionary), END]
    until = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))  # words up to each text's end
    place = np.insert(words.indices.to_numpy().astype(np.int64), until, len(distinct) - 1)
    return distinct, place, np.diff(until, prepend=0) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def unigram_keys(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words)) & MASK


def bigram_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(1)) & MASK


def context_keys(words: np.ndarray) -> np.ndarray:
    return mix(words + np.uint64(0x632BE59BD9B4E019)) & MASK


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Highest level whose floor the count reaches; 0 for less than 1."""
    return np.searchsorted(LEVEL_FLOORS, counts, side="right")


@dataclass
class LogFrequencyFilter:
    """Bit array in ``SLICES`` equal slices; a key lives in one slice."""

    slices: np.ndarray  # uint8, SLICES x bytes
    hashes: int
    cache: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def slice_of(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(KEY_BITS - 12)).astype(np.int64)

    @staticmethod
    def walk(keys: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Start and step of a key's places (double hashing)."""
        a = mix(keys * np.uint64(0xD6E8FEB86659FD93) + np.asarray(level, np.uint64) * np.uint64(0xA0761D6478BD642F))
        return a & np.uint64(0xFFFFFFFF), (a >> np.uint64(32)) | np.uint64(1)

    @staticmethod
    def places(keys: np.ndarray, level: np.ndarray | int, bits: int, hashes: int) -> np.ndarray:
        """Bit places in the key's slice, ``hashes`` columns."""
        start, step = LogFrequencyFilter.walk(keys, level)
        return (start[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(bits)

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        width = self.slices.shape[1]
        flat, place, bits = self.slices.reshape(-1), self.walk(keys, level), width * 8
        low = np.uint64(bits - 1) if bits & (bits - 1) == 0 else None  # of a power of two the remainder is its low bits
        found, (start, step), base = np.arange(len(keys)), place, self.slice_of(keys) * width
        for _ in range(self.hashes):  # most keys that are missing fail at the first places
            at = (start % np.uint64(bits) if low is None else start & low).astype(np.int64)
            hit = np.flatnonzero((flat[base + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1)
            found, start, step, base = found[hit], start[hit] + step[hit], step[hit], base[hit]
        yes = np.zeros(len(keys), bool)
        yes[found] = True
        return yes

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts read back: membership of level 1, 2, ... until one is missing.
        Keys are asked slice by slice: all places of a key are in its slice, which
        stays in the processor's cache."""
        order = np.argsort(self.slice_of(keys).astype(np.uint16), kind="stable")
        level, asked, keys = np.zeros(len(keys), np.int64), np.arange(len(keys)), keys[order]
        for j in range(1, len(LEVEL_FLOORS) + 1):
            asked = asked[self.has(keys[asked], j)]
            if not len(asked):
                break
            level[asked] = j
        out = np.empty(len(keys))
        out[order] = LEVEL_VALUES[level]
        return out


@dataclass
class GroupedFilter:
    """A filter in groups, each a broadcast ``LogFrequencyFilter``; a key lives in one group."""

    groups: list
    cache: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def group_of(keys: np.ndarray, groups: int) -> np.ndarray:
        """By the low 32 bits; slices go by the high ones."""
        return (((keys & np.uint64(0xFFFFFFFF)) * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        if len(self.groups) == 1:
            return self.groups[0].value.counts(keys)
        out, home = np.zeros(len(keys)), self.group_of(keys, len(self.groups))
        for g, group in enumerate(self.groups):
            at = np.flatnonzero(home == g)
            if len(at):
                out[at] = group.value.counts(keys[at])
                vars(group).pop("_value", None)  # read again from the local disk when needed
        return out


def filled(spark, entries: DataFrame, group_bytes: int, groups: int, hashes: int) -> GroupedFilter:
    """The filter with ``entries (key long, level int)``; every task fills the slices it is dealt."""
    width = group_bytes // SLICES

    def run(batches):
        own: dict[int, np.ndarray] = {}  # by group and slice
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            level = batch.column(1).to_numpy().astype(np.int64)
            which = GroupedFilter.group_of(keys, groups) * SLICES + LogFrequencyFilter.slice_of(keys)
            order = np.argsort(which, kind="stable")
            keys, level, which = keys[order], level[order], which[order]
            repeats = np.repeat(np.arange(len(keys)), level)
            each = np.arange(len(repeats)) - np.repeat(np.cumsum(level) - level, level) + 1
            at = LogFrequencyFilter.places(keys[repeats], each, width * 8, hashes).astype(np.int64)
            home = which[repeats]
            first = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else []
            for start, stop in zip(first, [*first[1:], len(home)]):
                bits = own.setdefault(int(home[start]), np.zeros(width, np.uint8))
                p = at[start:stop].ravel()
                np.bitwise_or.at(bits, p >> 3, (1 << (p & 7)).astype(np.uint8))
        for at in chunks([width] * len(own)):
            some = list(own)[at.start:at.stop]
            yield pa.record_batch([pa.array([x // SLICES for x in some], pa.int64()), pa.array([x % SLICES for x in some], pa.int64()),
                                   pa.array([own[x].tobytes() for x in some], pa.binary())], names=["of", "slice", "bits"])

    group = F.expr(f"((key & {0xFFFFFFFF}L) * {groups}L) >> 32")
    dealt = entries.repartition(group, F.shiftright("key", KEY_BITS - 12))
    path = scratch_path(spark, "llm-lm-filter")
    dealt.mapInArrow(run, "of long, slice long, bits binary").write.partitionBy("of").parquet(path)
    found = spark.read.schema("slice long, bits binary, of long").parquet(path)
    shared = []
    for g in range(groups):  # one group of group_bytes at a time on the driver
        slices = np.zeros((SLICES, width), np.uint8)
        for low in range(0, SLICES, SLICES // 4):  # a quarter travels at once
            some = found.where((F.col("of") == g) & F.col("slice").between(low, low + SLICES // 4 - 1)).select("slice", "bits").toArrow()
            for row in some.to_batches(max_chunksize=64):
                for number, bits in zip(row.column(0).to_pylist(), row.column(1).to_pylist()):
                    slices[number] |= np.frombuffer(bits, np.uint8)
            del some
        shared.append(spark.sparkContext.broadcast(LogFrequencyFilter(slices, hashes)))
    return GroupedFilter(shared)


def training(docs: DataFrame, id_col: str) -> DataFrame:
    """Rows that the model learns from."""
    return docs.where(F.coalesce(F.crc32(docs[id_col].cast("string").cast("binary")) % 5 != 1, F.lit(True)))


def text_chunks(batches):
    """The texts (null: empty) of ``batches (text)``, about ``CHUNK_BYTES`` at once."""
    for batch in batches:
        texts = [t or b"" for t in byte_rows(batch.column(0))]
        for r in chunks([len(t) for t in texts]):
            yield [texts[i] for i in r]


def small(batch: pa.RecordBatch):
    """``batch`` in slices: the JVM holds a batch that it is sent whole, outside its heap."""
    for at in range(0, batch.num_rows, SENT_ROWS):
        yield batch.slice(at, SENT_ROWS)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over ``texts (text)``; batches are summed before they are sent on."""
    from collections import Counter

    def run(batches):
        total, n = Counter(), 0
        for texts in text_chunks(batches):
            words, place, _ = coded(texts)
            total.update(dict(zip(words, np.bincount(place).tolist())))
            n += len(place)
            if n > COUNT_TOKENS:
                yield from small(rows(total))
                total, n = Counter(), 0
        yield from small(rows(total))

    def rows(total):
        return pa.record_batch([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "c"])

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def counted_pairs(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of ``held (keys, lefts)``, the first left of each and its
    number of times. Empties ``held`` and keeps no array longer than it is needed:
    what a worker holds at most is all this."""
    key = np.concatenate([k for k, _ in held])
    left = np.concatenate([x for _, x in held])
    held.clear()
    order = np.argsort(key, kind="stable")
    key = key[order]
    first, n = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)]), len(key)
    order = order[first]
    left = left[order]
    del order
    key = key[first]
    return key, left, np.diff(first, append=n)


def bigram_counts(texts: DataFrame) -> DataFrame:
    """``key, left, c`` of the bigrams in ``texts (text)``; ``left`` is the context's key."""

    def run(batches):
        held, n = [], 0
        for texts in text_chunks(batches):
            words, place, _ = coded(texts)
            keys, inner = unigram_keys(words)[place], place[:-1] != len(words) - 1  # a text's end has no successor
            left = keys[:-1][inner]
            held.append((bigram_keys(left, keys[1:][inner]), left))
            n += len(place)
            if n > COUNT_TOKENS:
                yield from small(rows(held))
                n = 0
        if held:
            yield from small(rows(held))

    def rows(held):
        key, left, count = counted_pairs(held)
        return pa.record_batch([pa.array(key.view(np.int64)), pa.array(left.view(np.int64)), pa.array(count)], names=["key", "left", "c"])

    return texts.mapInArrow(run, "key long, left long, c long").groupBy("key").agg(F.min("left").alias("left"), F.sum("c").alias("c"))


def level_column(c):
    """``levels_of`` as a column."""
    floors = [float(x) for x in LEVEL_FLOORS]
    return F.when(c <= 8, c).otherwise(F.aggregate(F.array(*map(F.lit, floors)), F.lit(0), lambda n, x: n + (c >= x).cast("int"))).cast("int")


@dataclass
class Model:
    filter: GroupedFilter
    hot: list[bytes]
    hot_counts: np.ndarray
    n: int
    v: int
    mu: float
    cut_off: int


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int | None = None, hashes: int = 6,
          group_bytes: int = 64 << 20, bits_per_key: int = 9, min_bigram: int = 2, hot_words: int = 300_000, mu: float = 20.0):
    """The model, and the table of all words' exact counts ``word, c``."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = training(docs, id_col).select(F.col(text_col).cast("string").alias("text"))
    words = cut(word_counts(texts), "lm-words")
    n, v = words.agg(F.sum("c"), F.count("*")).first()
    level = level_column(F.col("c"))

    def histogram_of(table: DataFrame) -> np.ndarray:
        out = np.zeros(len(LEVEL_FLOORS) + 1)
        for lv, k in table.groupBy(level.alias("lv")).count().collect():
            out[lv] = k
        return out

    bigrams = cut(bigram_counts(texts).where(F.col("c") >= min_bigram), "lm-bigrams")
    histogram = np.stack([histogram_of(words), histogram_of(bigrams)])

    # The frequent words: those from the first level on with which they are no more than hot_words.
    above = np.cumsum(histogram[0][::-1])[::-1]  # words of each level or more
    least = int(np.flatnonzero(np.r_[above, 0] <= hot_words)[0])
    frequent = words.where(F.octet_length("word") <= HOT_CHARS).where(F.col("c") >= (float(LEVEL_FLOORS[max(least, 1) - 1]) if least <= len(LEVEL_FLOORS) else float("inf")))
    arrow = frequent.toArrow()
    hot, hot_counts = arrow.column(0).to_pylist(), np.array(arrow.column(1).to_pylist(), np.int64)

    # Keys that each cut-off would store; cut-offs are level floors.
    room = filter_bytes * 8 // bits_per_key if filter_bytes else math.inf
    stored = lambda h, lv: (h[lv:] * np.arange(lv, len(h))).sum()
    own = int(levels_of(np.array([min_bigram]))[0])
    contexts = lambda lv: 3 * min(histogram[0].sum(), histogram[1, lv:].sum())  # noqa: E731  a context holds few levels
    keys = lambda lv: stored(histogram[0], max(1, lv - own + 1)) + stored(histogram[1], lv) + contexts(lv)
    lv = own
    while lv < len(LEVEL_FLOORS) and keys(lv) > room:
        lv += 1
    groups = 1 if filter_bytes else max(1, math.ceil(keys(lv) * bits_per_key / 8 / group_bytes))
    word_floor, gram_floor = float(LEVEL_FLOORS[max(1, lv - own + 1) - 1]), float(LEVEL_FLOORS[lv - 1])

    entries = keyed_words(words.where(F.col("c") >= word_floor))
    kept = bigrams.where(F.col("c") >= gram_floor)
    entries = entries.union(kept.select("key", "c")).union(keyed_contexts(kept.groupBy("left").agg(F.sum("c").alias("c"))))
    found = filled(spark, entries.select("key", level.alias("level")), filter_bytes or group_bytes, groups, hashes)
    return Model(found, hot, hot_counts, int(n or 0), int(v or 0), mu, int(gram_floor)), words


def keyed_words(words: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.record_batch([pa.array(unigram_keys(byte_values(b.column(0))).view(np.int64)), b.column(1)], names=["key", "c"])

    return words.mapInArrow(run, "key long, c long")


def keyed_contexts(contexts: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.record_batch([pa.array(context_keys(b.column(0).to_numpy().view(np.uint64)).view(np.int64)), b.column(1)],
                                  names=["key", "c"])

    return contexts.mapInArrow(run, "key long, c long")


class Scorer:
    """Scores batches of texts under a model, remembering the words it has met:
    a number for each, and arrays of their key, count and stored mass (read from
    the filter) by that number."""

    def __init__(self, model: Model):
        self.m = model
        self.floor = 0.5 * (model.v + 1)
        self.forget()

    def forget(self) -> None:
        """Keep the frequent words only; their numbers come first."""
        if not hasattr(self, "frequent"):
            self.number: dict[bytes, int] = {}
            self.key = np.empty(0, np.uint64)
            self.c = self.s = np.empty(0)
            self.learn(self.m.hot)
            self.frequent = len(self.m.hot)
            self.base = np.log10((self.m.hot_counts + 0.5) / (self.m.n + self.floor))
        n = self.frequent
        self.number = dict(zip(self.m.hot, range(n)))
        self.key, self.c, self.s = self.key[:n], self.c[:n], self.s[:n]

    def learn(self, new: list[bytes]) -> None:
        first = len(self.number)
        self.number.update(zip(new, range(first, first + len(new))))
        keys = unigram_keys(new)
        both = self.m.filter.counts(np.r_[keys, context_keys(keys)])  # each group is read once
        count = np.minimum(both[:len(keys)], self.m.n)  # a false positive may read more
        self.key, self.c = np.r_[self.key, keys], np.r_[self.c, count]
        self.s = np.r_[self.s, both[len(keys):]]

    def score(self, texts: list[bytes]):
        """Per text: tokens, known hot tokens, summed base log10 of hot tokens, model's
        log10 probability. And the other words: text's place, word, times."""
        distinct, place, length = coded(texts)
        new = [w for w in distinct if w not in self.number]
        if len(self.number) + len(new) > self.frequent + KNOWN_WORDS:
            self.forget()
            new = [w for w in distinct if w not in self.number]
        if new:
            self.learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        flat = numbers[place]
        first = np.cumsum(length) - length
        total = self.m.n + self.floor
        hot = flat < self.frequent
        base = np.zeros(len(flat))
        base[hot] = self.base[flat[hot]]
        pair, where = np.unique((np.r_[0, flat[:-1]] << 32) | flat, return_inverse=True)
        left, right = pair >> 32, pair & 0xFFFFFFFF
        c, key = self.c, self.key
        joint = self.m.filter.counts(bigram_keys(key[left], key[right]))
        joint = np.minimum(joint, np.minimum(c[left], c[right]))  # no pair is more frequent than its words
        single = (c[right] + 0.5) / total
        rest = np.maximum(c - np.minimum(self.s, c), 0)[left] + self.m.mu
        logs = np.log10(np.minimum((joint + rest * single) / (np.maximum(c[left], joint) + self.m.mu), 1.0))[where]
        logs[first] = np.log10((c[flat[first]] + 0.5) / total)  # a text's first token has no context
        add = np.add.reduceat
        rare = np.flatnonzero(~hot)
        row = np.repeat(np.arange(len(texts)), length)[rare]
        at, times = np.unique((row << 32) | flat[rare], return_counts=True)
        spelled = dict(zip(numbers.tolist(), distinct))
        words = list(map(spelled.__getitem__, (at & 0xFFFFFFFF).tolist()))
        return length, add(hot.astype(np.int64), first), add(base, first), add(logs, first), (at >> 32, words, times)


def gathered(batches, column: int):
    """The rows of ``batches`` in batches of about ``GATHER_BYTES`` of ``column``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= GATHER_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, ``held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    spark = docs.sparkSession
    model, words = learn(docs, id_col, text_col, **options)
    # The groups travel as broadcasts of their own, named by the task's closure.
    groups, n_groups = model.filter.groups, len(model.filter.groups)
    shared = spark.sparkContext.broadcast(replace(model, filter=None))
    total = model.n + 0.5 * (model.v + 1)
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        model = shared.value
        if model.filter is None:
            model.filter = GroupedFilter(groups)
        scorer = model.filter.cache.setdefault("scorer", None) or Scorer(model)
        model.filter.cache["scorer"] = scorer
        part, at = TaskContext.get().partitionId() << 40, 0
        for batch in gathered(batches, 2) if n_groups > 1 else batches:
            texts = [t or b"" for t in byte_rows(batch.column(2))]
            for r in chunks([len(t) for t in texts], GATHER_BYTES if n_groups > 1 else CHUNK_BYTES):
                length, known, base, logs, tails = scorer.score([texts[i] for i in r])
                n, k = len(length), len(tails[1])
                at_rows = part + at + np.arange(n)
                at += n
                cols = batch.slice(r.start, n)
                yield pa.record_batch([
                    pa.concat_arrays([pa.array(at_rows), pa.array(at_rows[tails[0]], pa.int64())]),
                    pa.concat_arrays([cols.column(0), pa.nulls(k, cols.column(0).type)]),
                    pa.concat_arrays([cols.column(1), pa.nulls(k, pa.bool_())]),
                    pa.array([None] * n + tails[1], pa.binary()),
                    pa.array(np.r_[length, tails[2]]),
                    pa.array(np.r_[known, np.zeros(k, np.int64)]), pa.array(np.r_[base, np.zeros(k)]),
                    pa.array(np.r_[logs, np.zeros(k)])],
                    names=["row", "id", "held_out", "word", "n", "known", "base", "logs"])

    # One kind of row per document and one per document and rare word, in one pass.
    # The number of a row is its place in the task's input, used in this plan alone.
    parts = rows.mapInArrow(run, f"row long, id {kind['id']}, held_out boolean, word binary, n long, known long, base double, logs double")
    # A document's own row meets no word: its key is no word and differs per row.
    parts = parts.withColumn("word", F.coalesce("word", F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary")))
    joined = parts.join(words, "word", "left")
    own = F.col("held_out").isNotNull()
    summed = joined.groupBy("row").agg(
        F.max("id").alias("id"), F.max("held_out").alias("held_out"), F.sum(F.when(own, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(own, F.col("known")).when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(own, F.col("base")).otherwise(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / total))).alias("base_score"),
        F.sum("logs").alias("score"))
    return summed.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                         F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
