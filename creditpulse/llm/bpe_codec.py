"""BPE encoding and decoding of whole texts under a vocabulary with word ends.

Method: a pre-token's symbols form a doubly linked list. A priority queue holds
the merge rank of every adjacent pair with its place; the lowest rank is taken,
the leftmost first. An entry is stale, and skipped, if its left symbol is gone
or the pair there has another rank by now. A merge joins the two symbols and
queues the pairs on both sides. Decoding looks every id up in the vocabulary
and concatenates the strings, one space between them, as the library does for
a file without a decoder.

White space is no part of any pre-token and no character composes with it, so a
text's ids are those of its chunks between ASCII white space. Distinct chunks
and pre-tokens are merged once per worker as long as they are remembered: two
generations of bounded size, in which what is met again outlives the rest.
Up to U+024F normalising is plain lower-casing; chunks with other characters go
through the normaliser and pre-tokeniser of the vocabulary's own library.

Defined results: null text counts as empty and has no ids; a special string
inside a text is one token; null or repeated ids and repeated rows are kept row
by row; other columns are ignored, whatever their names. Decoding null ids
gives null, no ids the empty text.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import byte_rows, chunks
from creditpulse.llm.token_counts import printable_bytes

MAX_TABLE_BYTES = 64 << 20  # bound of what is broadcast
GENERATION = 200_000  # entries of a generation of the two caches
NONE, GONE = -1, -1  # no merge; a symbol that was joined to the one before it
PLACE = 32  # bits of a queue entry below the rank
PLACES = (1 << PLACE) - 1
#: The parts of the vocabulary file that this module stands for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
ASCII_PRETOKEN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
UNSETTLED = re.compile("[^\x00-ɏ]")


@dataclass
class Vocabulary:
    """Ids of the byte symbols (inside a word, at its end), merge ranks, strings."""

    source: str = field(repr=False)
    inner: list[int]
    final: list[int]
    ranks: dict[int, int] = field(repr=False)  # left << 32 | right -> rank
    results: list[int] = field(repr=False)  # rank -> merged id
    pairs: list[int] = field(repr=False)  # byte << 8 | byte, both inside a word -> rank
    strings: list[bytes] = field(repr=False)  # id -> vocabulary string
    specials: dict[bytes, int]


def read_vocabulary(path: str) -> Vocabulary:
    """Tables of a tokenizers file: byte-level BPE over lower-cased words with word ends."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    if len(source) > MAX_TABLE_BYTES:
        raise ValueError(f"{path}: larger than the {MAX_TABLE_BYTES} bytes that may be broadcast")
    spec = json.loads(source)
    model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
    if model["type"] != "BPE" or not suffix or steps != NORMALIZERS or split != PATTERN or spec["decoder"]:
        raise ValueError(f"{path}: not a lower-casing BPE vocabulary with word ends")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: special tokens that take white space or normalised text are not supported")
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    strings = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for s, i in vocab.items():
        strings[i] = s.encode()
    for t in spec["added_tokens"]:
        strings[t["id"]] = t["content"].encode()
    alphabet = printable_bytes()
    inner = [vocab[alphabet[b]] for b in range(256)]
    ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
    return Vocabulary(
        source=source, inner=inner, final=[vocab[alphabet[b] + suffix] for b in range(256)], ranks=ranks,
        results=[vocab[a + b] for a, b in pairs], strings=strings,
        pairs=[ranks.get(a << 32 | b, NONE) for a in inner for b in inner],
        specials={t["content"].encode(): t["id"] for t in spec["added_tokens"]})


def merged(pretoken: bytes, v: Vocabulary) -> list[int]:
    """Ids of one pre-token."""
    size = len(pretoken)
    if size == 1:
        return [v.final[pretoken[0]]]
    symbols = list(map(v.inner.__getitem__, pretoken))
    symbols[-1] = v.final[pretoken[-1]]
    # rank[i]: of the pair at i and the symbol after it, NONE if it does not merge
    rank = [v.pairs[a << 8 | b] for a, b in zip(pretoken, pretoken[1:])]
    rank[-1] = v.ranks.get(symbols[-2] << 32 | symbols[-1], NONE)
    rank.append(NONE)
    queue = [r << PLACE | at for at, r in enumerate(rank) if r != NONE]
    if not queue:
        return symbols
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    rank_of, results = v.ranks.get, v.results
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        at, low = entry & PLACES, entry >> PLACE
        if rank[at] != low:
            continue  # stale
        right = after[at]
        symbols[at] = joined = results[low]
        symbols[right], rank[right] = GONE, NONE
        after[at] = beyond = after[right]
        if beyond < size:
            before[beyond] = at
            rank[at] = low = rank_of(joined << 32 | symbols[beyond], NONE)
            if low != NONE:
                heapq.heappush(queue, low << PLACE | at)
        else:
            rank[at] = NONE
        left = before[at]
        if left >= 0:
            rank[left] = low = rank_of(symbols[left] << 32 | joined, NONE)
            if low != NONE:
                heapq.heappush(queue, low << PLACE | left)
    return [s for s in symbols if s != GONE]


class Generations:
    """A bounded map: when the young generation is full it becomes the old one,
    and what the old one held and nobody asked for since is forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def settle(self, keys: set) -> set:
        """Bring known ``keys`` into the young generation; returns the unknown ones."""
        missing = keys.difference(self.young)
        if len(self.young) + len(missing) > self.size:
            self.old, self.young = self.young, {}
            missing = keys
        again = missing.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        return missing - again


class Encoder:
    """Encodes texts, remembering chunks and pre-tokens."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.pattern = regex.compile(PATTERN)
        self.special = re.compile(b"(" + b"|".join(map(re.escape, sorted(v.specials, key=len, reverse=True))) + b")") if v.specials else None
        self.chunks, self.pretokens = Generations(GENERATION), Generations(GENERATION)
        self.library = None

    def cut(self, chunk: bytes) -> list[bytes]:
        """Pre-tokens of a chunk without special strings."""
        if chunk.isascii():
            chunk = chunk.lower()
            return ASCII_PRETOKEN.findall(chunk)
        text = chunk.decode("utf-8", "replace")
        if not UNSETTLED.search(text):
            return [p.encode() for p in self.pattern.findall(text.lower())]
        if self.library is None:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_str(self.v.source)
            self.library = whole.normalizer, whole.pre_tokenizer
            self.byte_of = {c: b for b, c in printable_bytes().items()}
        normal, pre = self.library
        found = pre.pre_tokenize_str(normal.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in found]

    def parts(self, chunk: bytes) -> list[bytes | int]:
        """Pre-tokens, and ids of special strings, in order."""
        out = []
        for piece in self.special.split(chunk):
            if piece in self.v.specials:
                out.append(self.v.specials[piece])
            elif piece:
                out += self.cut(piece)
        return out

    def learn(self, new) -> None:
        """Remember the ids of new chunks, as little-endian 32-bit numbers."""
        special = self.special.search if self.special else lambda chunk: None
        whole, cut = {}, {}  # chunks that are one pre-token, and others
        for chunk in new:
            if chunk.isalpha():  # ASCII letters only
                whole[chunk] = chunk.lower()
            else:
                cut[chunk] = self.parts(chunk) if special(chunk) else self.cut(chunk)
        wanted = set(whole.values()).union(*cut.values())
        wanted.difference_update(self.v.specials.values())
        fresh = self.pretokens.settle(wanted)
        own = self.pretokens.young
        for p in fresh:
            own[p] = array("i", merged(p, self.v)).tobytes()
        known = self.chunks.young
        for chunk, p in whole.items():
            known[chunk] = own[p]
        for chunk, parts in cut.items():
            known[chunk] = b"".join([own[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in parts])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        cut = [t.split() for t in texts]  # at ASCII white space
        self.learn(self.chunks.settle(set().union(*cut) if cut else set()))
        get = self.chunks.young.__getitem__
        return [b"".join(map(get, c)) for c in cut]


def decoded(ids: list[int], strings: list[bytes]) -> bytes:
    return b" ".join(map(strings.__getitem__, ids))


def _shared(spark, path: str):
    return spark.sparkContext.broadcast({"vocabulary": read_vocabulary(path)})


def _encoder(shared) -> Encoder:
    """The worker's encoder, kept for its next task."""
    holder = shared.value
    if "encoder" not in holder:
        holder["encoder"] = Encoder(holder["vocabulary"])
    return holder["encoder"]


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] = ("doc_id",),
           decoded_col: str | None = None) -> DataFrame:
    """``keep`` columns, ``n_tokens long, ids array<int>`` of every row, and the
    decoded text as ``decoded_col`` if that is named."""
    shared = _shared(docs.sparkSession, path)
    keep, more = list(keep), [decoded_col] if decoded_col else []
    rows = docs.select(*(docs[k] for k in keep), docs[text_col].cast("string").alias("__text"))
    schema = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep),
                        "n_tokens long, ids array<int>", *(f"`{c}` string" for c in more)])

    def run(batches):
        encoder = _encoder(shared)
        strings = encoder.v.strings
        for batch in batches:
            texts = [t or b"" for t in byte_rows(batch.column(len(keep)))]
            for part in chunks([len(t) for t in texts]):
                ids = encoder.encode(texts[part.start:part.stop])
                ends = np.cumsum([0, *(len(b) // 4 for b in ids)])
                flat = np.frombuffer(b"".join(ids), "<i4")
                columns = [pa.array(np.diff(ends), pa.int64()),
                           pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))]
                if more:
                    numbers = flat.tolist()
                    columns.append(pa.array([decoded(numbers[a:b], strings) for a, b in zip(ends[:-1], ends[1:])], pa.binary()).cast(pa.string()))
                kept = batch.slice(part.start, len(part))
                yield pa.record_batch([*(kept.column(i) for i in range(len(keep))), *columns], names=[*keep, "n_tokens", "ids", *more])

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``tokens`` with the text of ``ids_col`` as ``out_col`` (replaced if there)."""
    shared = _shared(tokens.sparkSession, path)

    @F.pandas_udf("string")
    def text(ids):
        strings = shared.value["vocabulary"].strings
        return ids.map(lambda x: None if x is None else decoded(list(x), strings).decode())

    return tokens.withColumn(out_col, text(F.col(ids_col)))
