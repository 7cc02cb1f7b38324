"""Phrase collocations by weighted acyclic automata.

Pieces of a text are what lies between ``. , ; : ! ?`` and line ends; words are
runs without spaces and tabs. Counts of word sequences are kept as transducers:
acyclic automata whose arcs are words and whose last arcs carry the count.

1. Words are counted by Spark. For each length k from 2 to ``longest`` one pass
   over the texts counts in every task the sequences whose first and last k-1
   words are both frequent by a bitmap of fixed size: a sequence with
   ``least`` occurrences has no rarer part, so nothing is lost, and a bit that
   is set by chance only lets more through.
2. A task sorts its sequences, cuts them at the corpus's prefix ranges and
   builds a transducer of each part incrementally: in sorted order a state is
   complete when the next prefix differs, and is looked up among the states
   already there, so equal tails are stored once.
3. Shards' transducers of a range are united and their weights summed; paths
   below ``least`` go. Ranges are cut by a weighted sample of words, inside a
   hot first word by the second one; they only decide where work is done.
4. Counts of parts come by composition: a range's phrases give an automaton of
   the distinct parts they need in each other range; composed with the counts
   there, it comes back as a transducer part -> count.

Defined results: null texts are empty; null languages are ``und`` (one with a
language of that name); rows with equal or null ids all count; an empty table
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditpulse.llm.common import byte_rows, chunks, cut

LONGEST = 4
FILTER_BITS = 27  # a bitmap of 16 MiB, at any size
RANGE_WORDS = 5_000_000  # words of the corpus for each range
SAMPLE_WORDS = 4096  # expected size of the sample that cuts the ranges
BOUND_BYTES = 64  # of a word in a bound
TASK_WORDS = 300_000  # distinct words that a task counts at once
TASK_ROWS = 1_000_000  # distinct sequences that a task holds at once
KNOWN_WORDS = 1_000_000  # words that a task remembers
RANKERS = 64  # parts of a language that are ranked first
BREAK = b"\xff"  # no byte of UTF-8: stands for the end of a piece
#: Bytes that end a piece.
ENDS = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


# --- transducers -------------------------------------------------------------


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for each start, ``sizes`` many."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def sort_keys(columns: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Columns of labels below ``size`` as few 63-bit keys, the first one first."""
    bits = max(1, int(size - 1).bit_length())
    keys, used = [], 64
    for c in columns:
        if used + bits > 63:
            keys.append(c.astype(np.int64))
            used = bits
        else:
            keys[-1] = keys[-1] << bits | c
            used += bits
    return keys


def summed(columns: list[np.ndarray], weights: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows in lexicographic order, equal rows as one with their weights' sum."""
    keys = sort_keys(columns, size)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [c[order][first] for c in columns], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


@dataclass
class Transducer:
    """Sequences of ``len(labels)`` words with weights.

    State ``s`` of level ``j`` has the arcs ``starts[j][s]`` to
    ``starts[j][s + 1]``, sorted by label; ``targets[j]`` are states of the next
    level, on the last level weights. Level 0 has one state.
    """

    words: list[bytes]  # label -> word, sorted
    starts: list[np.ndarray]
    labels: list[np.ndarray]
    targets: list[np.ndarray]

    @classmethod
    def build(cls, words: list[bytes], columns: list[np.ndarray], weights: np.ndarray) -> Transducer:
        """From distinct rows in lexicographic order. Words that no row has are left out."""
        used = np.unique(np.concatenate(columns)) if len(weights) else np.empty(0, np.int64)
        columns = [np.searchsorted(used, c) for c in columns]
        out = cls([words[i] for i in used.tolist()], [], [], [])
        label, target = columns[-1], weights.astype(np.int64)
        new = np.zeros(len(weights), bool)  # where another prefix begins
        new[:1] = True
        changes = []
        for c in columns[:-1]:
            new[1:] |= c[1:] != c[:-1]
            changes.append(np.flatnonzero(new))
        for j in range(len(columns) - 1, 0, -1):
            first = changes[j - 1]
            at = first if j == len(columns) - 1 else np.searchsorted(changes[j], first)
            # States in sorted order: a finished one is looked up in the register of its level.
            arcs = np.column_stack([label, target]).astype("<i8").tobytes()
            ends = (np.r_[at, len(label)] * 16).tolist()
            register: dict[bytes, int] = {}
            state = [register.setdefault(arcs[a:b], len(register)) for a, b in zip(ends[:-1], ends[1:])]
            own = np.frombuffer(b"".join(register), "<i8").reshape(-1, 2)
            sizes = np.fromiter((len(s) // 16 for s in register), np.int64, len(register))
            out.starts.insert(0, np.r_[0, np.cumsum(sizes)])
            out.labels.insert(0, own[:, 0])
            out.targets.insert(0, own[:, 1])
            label, target = columns[j - 1][first], np.array(state, np.int64)
        out.starts.insert(0, np.array([0, len(label)]))
        out.labels.insert(0, label)
        out.targets.insert(0, target)
        return out

    def paths(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Columns of labels and weights, in lexicographic order."""
        columns, state = [self.labels[0]], self.targets[0]
        for starts, label, target in zip(self.starts[1:], self.labels[1:], self.targets[1:]):
            sizes = starts[state + 1] - starts[state]
            at = ragged(starts[state], sizes)
            columns = [np.repeat(c, sizes) for c in columns] + [label[at]]
            state = target[at]
        return columns, state

    def weights(self, words: list[bytes], columns: list[np.ndarray]) -> np.ndarray:
        """Composition with rows over another label table: their weights, 0 if not accepted."""
        label_of = dict(zip(self.words, range(len(self.words))))
        own = np.array([label_of.get(w, -1) for w in words], np.int64)
        out, rows = np.zeros(len(columns[0]), np.int64), np.arange(len(columns[0]))
        state = np.zeros(len(rows), np.int64)
        for j, c in enumerate(columns):
            label, size = own[c[rows]], len(self.words)
            rows, state, label = rows[label >= 0], state[label >= 0], label[label >= 0]
            arcs = np.repeat(np.arange(len(self.starts[j]) - 1), np.diff(self.starts[j])) * size + self.labels[j]
            wanted = state * size + label
            at = np.searchsorted(arcs, wanted)
            hit = at < len(arcs)
            hit[hit] = arcs[at[hit]] == wanted[hit]
            rows, state = rows[hit], self.targets[j][at[hit]]
        out[rows] = state
        return out

    def pack(self) -> bytes:
        text = b" ".join(self.words)
        arrays = [a for level in zip(self.starts, self.labels, self.targets) for a in level]
        small = [a.astype("<i4") if i < len(arrays) - 1 else a.astype("<i8") for i, a in enumerate(arrays)]
        head = np.array([len(self.labels), len(text), *map(len, small)], "<i8")
        return head.tobytes() + text + b"".join(a.tobytes() for a in small)

    @classmethod
    def unpack(cls, data: bytes) -> Transducer:
        levels, size = np.frombuffer(data, "<i8", 2).tolist()
        lengths = np.frombuffer(data, "<i8", 3 * levels, 16).tolist()
        at = 16 + 24 * levels
        words = data[at:at + size].split(b" ") if size else []
        at, arrays = at + size, []
        for i, n in enumerate(lengths):
            kind = "<i8" if i == len(lengths) - 1 else "<i4"
            arrays.append(np.frombuffer(data, kind, n, at).astype(np.int64))
            at += arrays[-1].nbytes if kind == "<i8" else 4 * n
        return cls(words, arrays[0::3], arrays[1::3], arrays[2::3])


class Union:
    """Sums transducers of one length as they come; holds distinct rows only."""

    def __init__(self):
        self.words: list[bytes] = []
        self.columns: list[np.ndarray] = []
        self.weights = np.empty(0, np.int64)
        self.waiting: list[Transducer] = []
        self.size = 0

    def add(self, net: Transducer) -> None:
        self.waiting.append(net)
        self.size += len(net.targets[-1])
        if self.size > TASK_ROWS:
            self.settle()

    def settle(self) -> None:
        words = sorted(set(self.words).union(*(n.words for n in self.waiting)))
        label_of = dict(zip(words, range(len(words))))
        parts = [(self.words, self.columns, self.weights)] if len(self.weights) else []
        for net in self.waiting:
            parts.append((net.words, *net.paths()))
        if parts:
            maps = [np.array([label_of[w] for w in own], np.int64) for own, _, _ in parts]
            columns = [np.concatenate([m[c[j]] for m, (_, c, _) in zip(maps, parts)]) for j in range(len(parts[0][1]))]
            self.columns, self.weights = summed(columns, np.concatenate([w for _, _, w in parts]), len(words))
            self.words = words
        self.waiting, self.size = [], 0

    def net(self, least: int = 1) -> Transducer | None:
        """The union, without paths below ``least``."""
        self.settle()
        good = self.weights >= least
        return Transducer.build(self.words, [c[good] for c in self.columns], self.weights[good]) if good.any() else None


# --- ranges and bitmaps ------------------------------------------------------


@dataclass
class Ranges:
    """Bounds of the prefix ranges of each language: ``(word, second word)`` pairs."""

    bounds: dict[str, list[tuple[bytes, bytes]]] = field(default_factory=dict)

    @classmethod
    def of(cls, sample: list[tuple[str, bytes, int]]) -> Ranges:
        """From sampled words with the weight each stands for."""
        out, by_lang = cls(), defaultdict(list)
        for lang, word, weight in sample:
            by_lang[lang].append((word, weight))
        for lang, rows in by_lang.items():
            rows.sort()
            ends = np.cumsum([w for _, w in rows])
            parts = -(-int(ends[-1]) // RANGE_WORDS)
            found = set()
            for i in range(1, parts):
                at = ends[-1] * i / parts
                k = int(np.searchsorted(ends, at, side="right"))
                word, weight = rows[k]
                second = b""
                if weight * parts * 4 > ends[-1]:  # hot: the share of the word before the bound, among second words
                    second = rows[int(np.searchsorted(ends, ends[-1] * (at - ends[k] + weight) / weight, side="right"))][0]
                found.add((word[:BOUND_BYTES], second[:BOUND_BYTES]))
            out.bounds[lang] = sorted(found)
        return out

    def cut(self, lang: str, words: list[bytes], columns: list[np.ndarray]):
        """``range, slice`` of rows in lexicographic order."""
        bounds = self.bounds.get(lang, [])
        key = columns[0].astype(np.int64) << 32
        if len(columns) > 1:
            key |= columns[1]
        places = []
        for word, second in bounds:
            a = bisect.bisect_left(words, word)
            # A row of one word lies before every bound inside its word.
            b = bisect.bisect_left(words, second) if a < len(words) and words[a] == word else 0
            b += len(columns) == 1 and second != b"" and a < len(words) and words[a] == word
            places.append(a << 32 | b)
        edges = [0, *np.searchsorted(key, np.array(places, np.int64)).tolist(), len(key)]
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if b > a:
                yield i, slice(a, b)


def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def word_hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def phrase_hash(seed: np.uint64, hashes: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(hashes[0]), seed, np.uint64)
    for h in hashes:
        out = (out ^ h) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def bit_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def bitmap(nets: DataFrame) -> np.ndarray:
    """Bits of all paths of ``nets (lang, net)``; at most ``2 ** FILTER_BITS`` bits reach the driver."""
    def run(batches):
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                net = Transducer.unpack(data)
                own = word_hashes(net.words)
                yield pa.record_batch([pa.array(bit_of(phrase_hash(lang_seed(lang), [own[c] for c in net.paths()[0]])) + 1)], names=["bit"])

    bits = nets.select("lang", "net").mapInArrow(run, "bit long")
    slices = bits.groupBy(F.bitmap_bucket_number("bit").alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in slices.collect():
        at = (row["slice"] - 1) * 4096  # bits and slices are counted from 1
        out[at:at + len(row.bits)] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


def has_bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


# --- counting ----------------------------------------------------------------


def by_language(batch):
    """``lang, tokens`` of a batch's texts, a few MiB at a time; ``BREAK`` between pieces."""
    groups = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
        if text:
            groups[lang].append(text)
    for lang, texts in groups.items():
        for part in chunks([len(t) for t in texts]):
            text = b"\n".join(texts[part.start:part.stop]).lower()
            yield lang, text.translate(ENDS).replace(BREAK, b" \xff ").split()


def count_words(rows: DataFrame) -> DataFrame:
    """``lang, word, n`` of ``rows (lang, text)``."""
    def run(batches):
        found = defaultdict(Counter)

        def out():
            for lang, words in found.items():
                words.pop(BREAK, None)
                yield pa.record_batch([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()),
                                       pa.array(words.values(), pa.int64())], names=["lang", "word", "n"])
            found.clear()

        for batch in batches:
            for lang, tokens in by_language(batch):
                found[lang].update(tokens)
                if sum(map(len, found.values())) > TASK_WORDS:
                    yield from out()
        yield from out()

    return rows.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Shard:
    """A language's sequences of ``k`` words in one task."""

    def __init__(self, lang: str, k: int, words: np.ndarray, parts: np.ndarray | None):
        self.lang, self.k, self.seed = lang, k, lang_seed(lang)
        self.word_bits, self.part_bits = words, parts
        self.code: dict[bytes, int] = {BREAK: -1}  # -1: cannot be part of a frequent sequence
        self.words: list[bytes] = []
        self.hashes = np.empty(0, np.uint64)
        self.clear()

    def clear(self) -> None:
        self.columns: list[list[np.ndarray]] = [[] for _ in range(self.k)]
        self.counts: list[np.ndarray] = []
        self.rows = 0

    def codes(self, tokens: list[bytes]) -> np.ndarray:
        new = list(set(tokens).difference(self.code))
        if new:
            hashes = word_hashes(new)
            good = has_bit(self.word_bits, bit_of(phrase_hash(self.seed, [hashes])))
            if len(self.code) > KNOWN_WORDS:
                self.code = {BREAK: -1} | {w: i for w, i in self.code.items() if i >= 0}
                self.code.update(dict.fromkeys(set(tokens).difference(self.code), -1))
            self.code.update(dict.fromkeys(new, -1))
            frequent = [w for w, g in zip(new, good.tolist()) if g]
            self.code.update(zip(frequent, range(len(self.words), len(self.words) + len(frequent))))
            self.words += frequent
            self.hashes = np.concatenate([self.hashes, hashes[good]])
        return np.fromiter(map(self.code.__getitem__, tokens), np.int32, len(tokens))

    def add(self, tokens: list[bytes]) -> None:
        codes, k = self.codes(tokens), self.k
        if len(codes) < k:
            return
        places = len(codes) - k + 1
        good = codes >= 0
        ok = np.logical_and.reduce([good[j:j + places] for j in range(k)])
        at = np.flatnonzero(ok)
        if self.part_bits is not None and len(at):
            own = [self.hashes[codes[at + j]] for j in range(k)]
            first, last = (has_bit(self.part_bits, bit_of(phrase_hash(self.seed, part))) for part in (own[:-1], own[1:]))
            at = at[first & last]
        if len(at):
            self.hold([codes[at + j] for j in range(k)], np.ones(len(at), np.int64))

    def hold(self, columns: list[np.ndarray], counts: np.ndarray) -> None:
        """Keep rows, equal ones as one. Two sequences with one 64-bit hash may leave
        rows in two: their counts are summed later all the same."""
        order = np.argsort(phrase_hash(self.seed, [self.hashes[c] for c in columns]))
        columns = [c[order] for c in columns]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        for held, c in zip(self.columns, columns):
            held.append(c[first])
        self.counts.append(np.add.reduceat(counts[order], first))
        self.rows += len(first)

    def compact(self) -> None:
        columns, counts = [np.concatenate(c) for c in self.columns], np.concatenate(self.counts)
        self.clear()
        self.hold(columns, counts)

    def nets(self, ranges: Ranges):
        """``lang, k, range, net`` of what is held; nothing is held afterwards."""
        if self.rows:
            order = sorted(range(len(self.words)), key=self.words.__getitem__)
            words = [self.words[i] for i in order]
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            columns, counts = summed([rank[np.concatenate(c)] for c in self.columns], np.concatenate(self.counts), len(words))
            for r, rows in ranges.cut(self.lang, words, columns):
                yield self.lang, self.k, r, Transducer.build(words, [c[rows] for c in columns], counts[rows]).pack()
        self.clear()


NET_SCHEMA = "lang string, k int, range int, net binary"


def net_batch(rows) -> pa.RecordBatch:
    lang, k, r, net = zip(*rows)
    return pa.record_batch([pa.array(lang, pa.string()), pa.array(k, pa.int32()), pa.array(r, pa.int32()), pa.array(net, pa.binary())],
                           names=["lang", "k", "range", "net"])


def count_sequences(rows: DataFrame, k: int, word_bits, part_bits, ranges) -> DataFrame:
    """``lang, k, range, net``: the tasks' transducers."""
    def run(batches):
        shards: dict[str, Shard] = {}
        for batch in batches:
            for lang, tokens in by_language(batch):
                if lang not in shards:
                    shards[lang] = Shard(lang, k, word_bits.value, part_bits and part_bits.value)
                shards[lang].add(tokens)
                if sum(s.rows for s in shards.values()) > 2 * TASK_ROWS:
                    for s in shards.values():
                        if s.rows:
                            s.compact()
                    if sum(s.rows for s in shards.values()) > TASK_ROWS:
                        for s in shards.values():
                            for row in s.nets(ranges.value):
                                yield net_batch([row])
        for s in shards.values():
            for row in s.nets(ranges.value):
                yield net_batch([row])

    return rows.mapInArrow(run, NET_SCHEMA)


def grouped(nets: DataFrame, *order):
    """Rows of a range in one task, one after the other."""
    return nets.repartition("lang", "k", "range").sortWithinPartitions("lang", "k", "range", *order)


def groups(batches):
    """``(lang, k, range), row`` one after the other."""
    for batch in batches:
        for row in batch.to_pylist():
            yield (row["lang"], row["k"], row["range"]), row


def unite(shards: DataFrame, least: int) -> DataFrame:
    """One transducer for each range, with the sums of at least ``least``."""
    def run(batches):
        key, union = None, Union()
        for own, row in groups(batches):
            if own != key:
                if key and (net := union.net(least)):
                    yield net_batch([(*key, net.pack())])
                key, union = own, Union()
            union.add(Transducer.unpack(row["net"]))
        if key and (net := union.net(least)):
            yield net_batch([(*key, net.pack())])

    return grouped(shards).mapInArrow(run, NET_SCHEMA)


def word_nets(words: DataFrame, ranges) -> DataFrame:
    """``words (lang, word, n)`` as transducers of length 1."""
    def run(batches):
        held = defaultdict(dict)

        def out():
            for lang, counts in held.items():
                names = sorted(counts)
                column = [np.arange(len(names))]
                weights = np.array([counts[w] for w in names], np.int64)
                for r, rows in ranges.value.cut(lang, names, column):
                    yield net_batch([(lang, 1, r, Transducer.build(names, [column[0][rows]], weights[rows]).pack())])
            held.clear()

        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                held[lang][word] = n
            if sum(map(len, held.values())) > TASK_WORDS:
                yield from out()
        yield from out()

    return words.select("lang", "word", "n").mapInArrow(run, NET_SCHEMA)


# --- parts -------------------------------------------------------------------


def parts_of(k: int) -> list[tuple[int, int]]:
    """``start, end`` of all contiguous proper parts."""
    return [(a, b) for a in range(k) for b in range(a + 1, k + 1) if b - a < k]


def ask(nets: DataFrame, ranges) -> DataFrame:
    """Automata of the parts that each range's phrases need of the others:
    ``lang, k, range, net`` and where it comes from, ``from_k, from_range``."""
    def run(batches):
        for (lang, k, own), row in groups(batches):
            net = Transducer.unpack(row["net"])
            columns, _ = net.paths()
            by_length = defaultdict(list)
            for a, b in parts_of(k):
                by_length[b - a].append(columns[a:b])
            for length, found in by_length.items():
                part = [np.concatenate([f[j] for f in found]) for j in range(length)]
                part, ones = summed(part, np.ones(len(part[0]), np.int64), len(net.words))
                for r, rows in ranges.value.cut(lang, net.words, part):
                    asked = Transducer.build(net.words, [c[rows] for c in part], np.ones(rows.stop - rows.start, np.int64))
                    yield pa.record_batch([pa.array([lang]), pa.array([length], pa.int32()), pa.array([r], pa.int32()), pa.array([asked.pack()], pa.binary()),
                                           pa.array([k], pa.int32()), pa.array([own], pa.int32())],
                                          names=["lang", "k", "range", "net", "from_k", "from_range"])

    return nets.mapInArrow(run, NET_SCHEMA + ", from_k int, from_range int")


def answer(nets: DataFrame, asked: DataFrame) -> DataFrame:
    """Composes what is asked with the counts of its range; ``lang, k, range, net``
    go back to where the question came from."""
    def run(batches):
        key, counts = None, None
        for own, row in groups(batches):
            net = Transducer.unpack(row["net"])
            if row["from_k"] is None:
                key, counts = own, net
            elif own == key:
                columns, _ = net.paths()
                weights = counts.weights(net.words, columns)
                some = weights > 0
                if some.any():
                    found = Transducer.build(net.words, [c[some] for c in columns], weights[some])
                    yield net_batch([(own[0], row["from_k"], row["from_range"], found.pack())])

    both = nets.withColumns({"from_k": F.lit(None).cast("int"), "from_range": F.lit(None).cast("int")}).unionByName(asked)
    return grouped(both, F.col("from_k").asc_nulls_first()).mapInArrow(run, NET_SCHEMA)


def scored(columns: list[np.ndarray], a: np.ndarray, part: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``l, r, score`` of the lowest-scoring cut of each phrase, the first of equal ones."""
    exact = object if len(a) and int(a.max()) >= 1 << 41 else np.int64  # the product stays below 63 bits
    out = None
    for j in range(1, len(columns)):
        left, right = part[0, j], part[j, len(columns)]
        score = a.astype(exact) * 2_000_000 // (left + right)
        if out is None:
            out = [left, right, score]
        else:
            lower = score < out[2]
            out = [np.where(lower, new, old) for new, old in zip((left, right, score), out)]
    return out[0], out[1], out[2].astype(np.int64)


PHRASES = "lang string, phrase string, a long, l long, r long, score long, inside boolean"


def judge(nets: DataFrame, answers: DataFrame, inside: int) -> DataFrame:
    """Every phrase with its counts, and as rows with ``inside`` the parts that are
    dropped because of it."""
    def phrases(words, columns):
        texts = [words[i] for i in columns[0].tolist()]
        for c in columns[1:]:
            texts = [t + b" " + words[i] for t, i in zip(texts, c.tolist())]
        return pa.array(texts, pa.binary()).cast(pa.string())

    def out(lang, words, columns, a, left, right, score, dropped):
        n = len(a)
        return pa.record_batch([pa.array([lang] * n, pa.string()), phrases(words, columns), *(pa.array(x, pa.int64()) for x in (a, left, right, score)),
                                pa.array([dropped] * n, pa.bool_())], names=["lang", "phrase", "a", "l", "r", "score", "inside"])

    def finish(key, net, unions):
        columns, a = net.paths()
        known = {k: u.net() for k, u in unions.items()}
        part = {(i, j): known[j - i].weights(net.words, columns[i:j]) for i, j in parts_of(key[1])}
        yield out(key[0], net.words, columns, a, *scored(columns, a, part), False)
        for (i, j), n in part.items():
            if j - i > 1:
                # 100 * a >= inside * n, in parts that stay exact in 64 bits
                q, rest = np.divmod(n, 100)
                drop = a >= q * inside + -(-rest * inside // 100)
                rows, weights = summed([c[drop] for c in columns[i:j]], n[drop], len(net.words))
                if len(weights):
                    zero = np.zeros(len(weights), np.int64)
                    yield out(key[0], net.words, rows, zero, zero, zero, zero, True)

    def run(batches):
        key, net, unions = None, None, {}
        for own, row in groups(batches):
            found = Transducer.unpack(row["net"])
            if row["own"]:
                if key:
                    yield from finish(key, net, unions)
                key, net, unions = own, found, {}
            else:
                unions.setdefault(len(found.labels), Union()).add(found)
        if key:
            yield from finish(key, net, unions)

    both = nets.withColumn("own", F.lit(True)).unionByName(answers.withColumn("own", F.lit(False)))
    return grouped(both, F.col("own").desc()).mapInArrow(run, PHRASES)


# --- the operator ------------------------------------------------------------


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000,
                 longest: int = LONGEST, inside: int = 80) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text"))
    words = cut(count_words(rows), "phrase-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = words.where(F.col("n") >= least)
    # A word is in the sample with a chance in proportion to its count, and surely if it has its share.
    stride = max(1, total // SAMPLE_WORDS)
    chance = F.pmod(F.xxhash64("lang", "word"), F.lit(stride)) < F.col("n")
    sample = frequent.where(chance).select("lang", "word", F.greatest("n", F.lit(stride)).alias("n"))
    ranges = share(Ranges.of([(r.lang, bytes(r.word), r.n) for r in sample.collect()]))
    nets = cut(unite(word_nets(frequent, ranges), least), "phrase-nets")
    word_bits, part_bits, levels = share(bitmap(nets)), None, [nets]
    for k in range(2, longest + 1):
        level = cut(unite(count_sequences(rows, k, word_bits, part_bits, ranges), least), "phrase-nets")
        levels.append(level)
        if k < longest:
            part_bits = share(bitmap(level))
    for level in levels[1:]:
        nets = nets.unionByName(level)
    phrases = nets.where("k > 1")
    judged = cut(judge(phrases, answer(nets, ask(phrases, ranges)), inside), "phrase-judged")
    kept = judged.where("not inside").join(judged.where("inside").select("lang", "phrase").distinct(), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKERS))
    first = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    first = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return first.where(F.col("rank") <= top).join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
