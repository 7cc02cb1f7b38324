"""Token counts of whole texts under a byte-level BPE vocabulary.

Method: rank-synchronous array merging. The distinct pre-tokens of a batch are
laid end to end as one ragged array of symbols; each round finds every
sequence's lowest-rank adjacent pair and merges all its occurrences in all
sequences at once. The symbols left are the tokens. A merge never makes a pair
of lower rank than its own, so a round equals that many single merges.

Defined results: null text counts as empty (0 bytes, 0 tokens); a special
string inside a text is one token; null or repeated ids and repeated rows are
kept row by row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from creditpulse.llm.common import CHUNK_BYTES, byte_rows, chunks, small_batches

MAX_TABLE_BYTES = 64 << 20  # bound of what is broadcast
CACHE_ENTRIES = 500_000  # segments whose counts a worker remembers
NONE = np.iinfo(np.int32).max


@dataclass
class BpeTables:
    """Merge table as sorted arrays: key ``left * size + right`` -> rank, result."""

    size: int
    byte_symbol: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    specials: list[str]
    pattern: str
    source: str
    cache: dict = field(default_factory=dict, repr=False)


def printable_bytes() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the
    others take the code points from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = (b for b in range(256) if b not in set(visible))
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def read_bpe(path: str, pattern: str) -> BpeTables:
    """Merge tables from a tokenizers file (byte-level BPE)."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    spec = json.loads(source)
    if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError(f"{path}: not a byte-level BPE vocabulary")
    vocab = spec["model"]["vocab"]
    size = max(vocab.values()) + 1
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    result = np.array([vocab[a + b] for a, b in pairs], np.int64)
    key = left * size + right
    order = np.argsort(key, kind="stable")
    alphabet = printable_bytes()
    tables = BpeTables(
        size=size,
        byte_symbol=np.array([vocab[alphabet[b]] for b in range(256)], np.int64),
        keys=key[order], ranks=order.astype(np.int32), results=result[order],
        specials=[t["content"] for t in spec.get("added_tokens", [])], pattern=pattern, source=source,
    )
    if len(source) + tables.keys.nbytes * 3 > MAX_TABLE_BYTES:
        raise ValueError(f"{path}: larger than the {MAX_TABLE_BYTES} bytes that may be broadcast")
    return tables


def pair_ranks(left: np.ndarray, right: np.ndarray, t: BpeTables) -> tuple[np.ndarray, np.ndarray]:
    """Rank and merged symbol of symbol pairs; rank ``NONE`` where there is no merge."""
    key = left * t.size + right
    at = np.minimum(np.searchsorted(t.keys, key), len(t.keys) - 1)
    return np.where(t.keys[at] == key, t.ranks[at], NONE), t.results[at]


def merged_lengths(pretokens: list[bytes], t: BpeTables) -> np.ndarray:
    """Number of symbols each pre-token ends with.

    ``rank[i]`` belongs to the pair at ``i`` and ``i + 1``; a round only looks
    up again the pairs beside a merge, and drops the sequences that are done.
    """
    lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
    final = lengths.copy()
    sym = t.byte_symbol[np.frombuffer(b"".join(pretokens), np.uint8)]
    seq = np.repeat(np.arange(len(pretokens)), lengths)
    last = np.cumsum(lengths) - 1
    rank, result = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int64)
    # Pre-tokens repeat byte pairs: each of the 65,536 is looked up once.
    byte = np.arange(256)
    first_rank, first_result = pair_ranks(np.repeat(t.byte_symbol, 256), np.tile(t.byte_symbol, 256), t)
    back = np.zeros(t.size, np.int64)
    back[t.byte_symbol] = byte
    pair = back[sym[:-1]] * 256 + back[sym[1:]]
    rank[:-1], result[:-1] = first_rank[pair], first_result[pair]
    rank[last] = NONE
    while len(sym):
        first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        width = np.diff(np.r_[first, len(seq)])
        lowest = np.minimum.reduceat(rank, first)
        final[seq[first]] = width
        done = lowest == NONE
        if done.any():
            going = np.repeat(~done, width)
            sym, seq, rank, result = sym[going], seq[going], rank[going], result[going]
            lowest, width = lowest[~done], width[~done]
            if not len(sym):
                break
        hits = np.flatnonzero(rank == np.repeat(lowest, width))
        # In a run like "aaa" hits touch; taken from the left, every other one merges.
        touch = np.r_[False, np.diff(hits) == 1]
        if touch.any():
            index = np.arange(len(hits))
            hits = hits[(index - np.maximum.accumulate(np.where(touch, 0, index))) % 2 == 0]
        sym[hits] = result[hits]
        stay = np.ones(len(sym), bool)
        stay[hits + 1] = False
        new = hits - np.arange(len(hits))  # where the merged symbols are afterwards
        sym, seq, rank, result = sym[stay], seq[stay], rank[stay], result[stay]
        beside = np.concatenate([new, new - 1])
        beside = beside[(beside >= 0) & (beside < len(sym) - 1)]
        ranks, results = pair_ranks(sym[beside], sym[beside + 1], t)
        rank[beside] = np.where(seq[beside] == seq[beside + 1], ranks, NONE)
        result[beside] = results
        if new[-1] == len(sym) - 1:
            rank[-1] = NONE
    return final


#: Beyond this code point Unicode versions may differ; all up to it is settled.
SETTLED = re.compile("[^\x00-\u024f]")
#: A space that is not alone between two characters that aren't white space.
LOOSE = re.compile(r"^ | $|\s | \s")


class Counter:
    """Counts tokens of texts, remembering the segments it has met.

    A single space between two characters that are not white space always
    begins a pre-token, so a text may be cut there: its count is the sum over
    the segments, most of which repeat. Other texts are pre-tokenised whole.
    """

    def __init__(self, tables: BpeTables):
        self.t = tables
        self.pattern = regex.compile(tables.pattern)
        self.special = re.compile("|".join(map(re.escape, tables.specials))) if tables.specials else None
        self.seen: dict[str, int] = {}  # segment after a space -> tokens, the space included
        self.library = None

    def pretokens(self, text: str) -> list[str]:
        if SETTLED.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Assigned by newer Unicode tables only: the vocabulary's own library decides.
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_str(self.t.source).pre_tokenizer
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def merged(self, flat: list[str]) -> list[int]:
        distinct = list(set(flat))
        if not distinct:
            return []
        get = dict(zip(distinct, merged_lengths([p.encode() for p in distinct], self.t).tolist())).__getitem__
        return list(map(get, flat))

    def segment_lengths(self, segments: list[str]) -> list[int]:
        """Token counts of segments, each with the space before it. Run together,
        they are cut again at the pre-tokens that begin with a space."""
        if not segments:
            return []
        flat = self.pretokens(" " + " ".join(segments))
        starts = [i for i, p in enumerate(flat) if p[0] == " "]
        return np.add.reduceat(np.array(self.merged(flat)), starts).tolist()

    def count(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        whole, tails = [], []  # (row, text) to pre-tokenise whole; (row, segments)
        for row, text in enumerate(texts):
            parts = [text]
            if self.special is not None and any(s in text for s in self.t.specials):
                parts = self.special.split(text)
                totals[row] += len(parts) - 1
            for part in parts:
                if LOOSE.search(part):
                    whole.append((row, part))
                elif part:
                    head, *rest = part.split(" ")
                    whole.append((row, head))
                    tails.append((row, rest))
        new = set().union(*(rest for _, rest in tails)).difference(self.seen)
        if len(self.seen) + len(new) > CACHE_ENTRIES:
            self.seen = {}
            new = set().union(*(rest for _, rest in tails))
        new = list(new)
        self.seen.update(zip(new, self.segment_lengths(new)))
        get = self.seen.__getitem__
        for row, rest in tails:
            totals[row] += sum(map(get, rest))
        found = [(row, self.pretokens(t)) for row, t in whole]
        counts = iter(self.merged([p for _, f in found for p in f]))
        for row, f in found:
            totals[row] += sum(itertools.islice(counts, len(f)))
        return totals


def count_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(read_bpe(tokenizer_path, pattern))
    id_type = docs.schema[id_col].dataType

    def run(batches):
        tables = shared.value
        counter = tables.cache.setdefault("counter", None) or Counter(tables)
        tables.cache["counter"] = counter  # kept for the worker's next task
        for batch in batches:
            rows = [b or b"" for b in byte_rows(batch.column(1))]
            sizes = [len(b) for b in rows]
            counts: list[int] = []
            for part in chunks(sizes, CHUNK_BYTES):
                counts += counter.count([rows[i].decode("utf-8", "replace") for i in part])
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    out = docs.select(docs[id_col], docs[text_col].cast("string")).mapInArrow(
        run, f"id {id_type.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
