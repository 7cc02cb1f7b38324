"""SentencePiece encoding and decoding on the tokenizers library.

Method: the model's protobuf is read field by field, and its parts are rebuilt
with the tokenizers library: the normaliser (its compiled character map, extra
spaces, dummy prefix), the metaspace marker, the unigram scores or, for a model
of type BPE, the merges that its scores imply, and byte fallback. Batches are
encoded multithreaded, and parity with the sentencepiece library is verified.

If no piece has a marker after another character, no merge or Viterbi path can
cross the start of a run of markers; texts are then cut there, every distinct
segment is encoded and verified once, and a text's ids are its segments' ids.
Other models are encoded and verified by whole texts. A segment on which the
libraries differ (the backend ranks two ways of building one piece, where
sentencepiece takes the leftmost) gets sentencepiece's ids, and ``parity`` is
false for the texts that hold it. A segment that cannot be verified alone has
its texts verified whole.

Defined results: null text counts as empty and has no ids; null or repeated ids
and repeated rows are kept row by row; other columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.bpe_codec import Generations
from creditpulse.llm.common import byte_rows, chunks, small_batches

MARK = "▁"
MAX_MODEL_BYTES = 64 << 20  # bound of what is broadcast
CACHE_ENTRIES = 400_000  # segments whose ids a worker remembers
ROW = 64  # words that are encoded as one text
#: Fixed values of the model format: field numbers, piece types, model types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    def varint(at):
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            at += 1
            if data[at - 1] < 0x80:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    source: bytes = field(repr=False)
    pieces: list[str] = field(default_factory=list, repr=False)
    scores: list[float] = field(default_factory=list, repr=False)
    types: list[int] = field(default_factory=list, repr=False)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_surface: str = " ⁇ "
    charsmap: bytes = field(default=b"", repr=False)
    dummy_prefix: bool = True
    squeeze: bool = True  # remove extra white space
    escape: bool = True

    @property
    def separable(self) -> bool:
        """No piece has a marker after another character."""
        return self.escape and not any(re.search(f"[^{MARK}]{MARK}", p) for p, t in zip(self.pieces, self.types) if t in (NORMAL, USER_DEFINED))


def read_model(source: bytes) -> PieceModel:
    if len(source) > MAX_MODEL_BYTES:
        raise ValueError(f"model larger than the {MAX_MODEL_BYTES} bytes that may be broadcast")
    m = PieceModel(source)
    for number, value in fields(source):
        if number == PIECES:
            piece = dict(fields(value))
            m.pieces.append(piece.get(1, b"").decode())
            m.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            m.types.append(piece.get(3, NORMAL))
        elif number == TRAINER:
            spec = dict(fields(value))
            m.kind, m.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            if spec.get(24) or m.kind not in (UNIGRAM, BPE):
                raise ValueError("only unigram and BPE models with prefix markers are supported")
            if 44 in spec:
                m.unk_surface = spec[44].decode()
        elif number == NORMALIZER:
            spec = dict(fields(value))
            m.charsmap = spec.get(2, b"")
            m.dummy_prefix, m.squeeze, m.escape = (bool(spec.get(i, 1)) for i in (3, 4, 5))
    if USER_DEFINED in m.types or UNUSED in m.types:
        raise ValueError("user-defined and unused pieces are not supported")
    return m


def merges_of(m: PieceModel) -> list[tuple[str, str]]:
    """The pairs that make up a piece, best score first."""
    usable = {p: s for p, s, t in zip(m.pieces, m.scores, m.types) if t == NORMAL}
    pairs = [(-s, p[:k], p[k:]) for p, s in usable.items() for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
    return [(a, b) for _, a, b in sorted(pairs, key=lambda x: x[0])]


def backend(m: PieceModel, threads: int):
    """The model for the tokenizers library, without its normaliser."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)  # of a worker; must stand before the first batch
    from tokenizers import Tokenizer, models

    unknown = m.types.index(UNKNOWN)
    if m.kind == UNIGRAM:
        # Text that spells a control piece is no control piece: noncharacters hide these.
        names = [p + "\uffff\ufffe" if t in (CONTROL, UNKNOWN) else p for p, t in zip(m.pieces, m.types)]
        return Tokenizer(models.Unigram(list(zip(names, m.scores)), unknown, m.byte_fallback))
    return Tokenizer(models.BPE({p: i for i, p in enumerate(m.pieces)}, merges_of(m), unk_token=m.pieces[unknown],
                                fuse_unk=True, byte_fallback=m.byte_fallback))


def normalizer(m: PieceModel):
    """Text -> marked text, as a function."""
    mapped = None
    if m.charsmap:
        from tokenizers.normalizers import Precompiled

        mapped = Precompiled(m.charsmap).normalize_str

    def normal(text: str) -> str:
        if mapped:
            text = mapped(text)
        if m.squeeze:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if not text:
            return ""
        if m.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if m.escape else text

    return normal


class Codec:
    """Encodes and decodes batches, remembering the segments it has met."""

    SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def __init__(self, m: PieceModel, threads: int = 2):
        import sentencepiece

        self.m, self.threads = m, threads
        self.library = backend(m, threads)
        self.normal = normalizer(m)
        self.judge = sentencepiece.SentencePieceProcessor(model_proto=m.source)
        self.separable = m.separable
        #: A text's decoding is its segments' decodings, but for its first one.
        self.piecewise = self.separable and not m.squeeze
        self.known = Generations(CACHE_ENTRIES // 2)  # segment -> ids
        self.odd: set[str] = set()  # segments without parity
        self.unsure: set[str] = set()  # segments that sentencepiece cannot be given alone
        self.unlike: set[str] = set()  # segments that decoding does not give back
        self.table = [self.surface(i) for i in range(len(m.pieces))]
        #: The normaliser only marks spaces, so what it has marked can be given to it again.
        self.plain_marks = not m.charsmap and not m.squeeze and m.escape and m.dummy_prefix
        self.begins = np.array([t == NORMAL and p[:1] == MARK for p, t in zip(m.pieces, m.types)])

    def surface(self, i: int) -> bytes:
        piece, kind = self.m.pieces[i], self.m.types[i]
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.m.unk_surface.encode()
        return (piece.replace(MARK, " ") if self.m.escape else piece).encode()

    def segments(self, text: str) -> list[str]:
        """Segments of a normalised text."""
        if not text:
            return []
        if not self.separable:
            return [text]
        if MARK + MARK in text or text[0] != MARK:
            return self.SEGMENT.findall(text)
        return [MARK + s for s in text[1:].split(MARK)]

    def learn(self, new: list[str]) -> None:
        """Encode segments in multithreaded batches and verify them, and that
        decoding gives them back: a marker and a word in rows of ``ROW``, which no
        merge crosses, all others, and rows with a difference, one by one."""
        if self.separable and self.plain_marks:
            words = [s for s in new if len(s) > 1 and s[0] == MARK and MARK not in s[1:]]
            rest = set(new).difference(words)
            rest.update(self.learn_rows(words))
            new = list(rest)
        if new:
            self.learn_alone(new)

    def learn_rows(self, words: list[str]) -> list[str]:
        """Learn the words of rows on which all agree; returns the others."""
        cut = [words[i:i + ROW] for i in range(0, len(words), ROW)]
        rows = list(map("".join, cut))
        plain = [r.replace(MARK, " ") for r in rows]
        own = [e.ids for e in self.library.encode_batch_fast(rows, add_special_tokens=False)]
        theirs = self.judge.encode([p[1:] for p in plain], num_threads=self.threads)
        piece = self.table.__getitem__
        good = [a == b and b"".join(map(piece, a)) == p.encode() for a, b, p in zip(own, theirs, plain)]
        flat = np.fromiter(itertools.chain.from_iterable(itertools.compress(own, good)), "<i4")
        agreed = list(itertools.chain.from_iterable(itertools.compress(cut, good)))
        starts = (np.flatnonzero(self.begins[flat]) * 4).tolist()
        if len(starts) != len(agreed):  # a marker is no piece of this model
            return words
        data = flat.tobytes()
        self.known.young.update(zip(agreed, [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]))
        return [w for row, g in zip(cut, good) if not g for w in row]

    def learn_alone(self, new: list[str]) -> None:
        own = [e.ids for e in self.library.encode_batch_fast(new, add_special_tokens=False)]
        plain = [s.replace(MARK, " ") for s in new] if self.m.escape else new
        given = [p[1:] if p[:1] == " " else p for p in plain] if self.m.dummy_prefix else plain
        theirs = self.judge.encode(given, num_threads=self.threads)
        piece = self.table.__getitem__
        for s, p, g, a, b in zip(new, plain, given, own, theirs):
            if self.normal(g) != s:
                self.unsure.add(s)
            elif a != b:
                self.odd.add(s)
                a = b
            if b"".join(map(piece, a)) != p.encode():
                self.unlike.add(s)
            self.known.young[s] = array("i", a).tobytes()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool], list[bool]]:
        """Ids of each text as little-endian 32-bit numbers, whether all its parts
        have parity, and whether decoding gives the normalised text back."""
        normal = list(map(self.normal, texts))
        cut = [self.segments(t) for t in normal]
        distinct = set().union(*cut) if cut else set()
        new = self.known.settle(distinct)
        if new:
            self.learn(list(new))
        for marked in (self.odd, self.unsure, self.unlike):
            if len(marked) > CACHE_ENTRIES:
                marked.intersection_update(self.known.young, self.known.old)
        get = self.known.young.__getitem__
        ids = [b"".join(map(get, s)) for s in cut]
        odd, unsure, unlike = (x & distinct for x in (self.odd, self.unsure, self.unlike))
        parity = [not odd or odd.isdisjoint(s) for s in cut]
        for i, text in enumerate(texts):
            # Marks that look like spaces to be squeezed, and segments not verified alone: the text whole.
            if self.m.squeeze and MARK in text or unsure and not unsure.isdisjoint(cut[i]):
                theirs = np.array(self.judge.encode(text), "<i4").tobytes()
                ids[i], parity[i] = theirs, parity[i] and theirs == ids[i]
        heads = {s: self.gives_back(get(s), s) for s in {s[0] for s in cut if s}} if self.piecewise else {}
        good = [self.piecewise and (not s or heads[s[0]] and unlike.isdisjoint(s)) and parity[i] or self.gives_back(ids[i], normal[i])
                for i, s in enumerate(cut)]
        return ids, parity, good

    def gives_back(self, ids: bytes, normal: str) -> bool:
        return self.decode(np.frombuffer(ids, "<i4").tolist()) == self.plain(normal)

    def plain(self, normal: str) -> str:
        """A normalised text as decoding must give it back."""
        text = normal.replace(MARK, " ") if self.m.escape else normal
        return text[1:] if self.m.dummy_prefix and text[:1] == " " else text

    def decode(self, ids: list[int]) -> str:
        parts = list(map(self.table.__getitem__, ids))
        if self.m.dummy_prefix or self.m.squeeze:
            # The first marker is no space; without extra spaces, none is before any text.
            for i, part in enumerate(parts):
                if part[:1] == b" " and self.m.types[ids[i]] == NORMAL:
                    parts[i] = part = part[1:]
                    if not self.m.squeeze:
                        break
                if part:
                    break
        return b"".join(parts).decode("utf-8", "replace")

    def expected(self, text: str) -> str:
        """What decoding must give back: the text, normalised."""
        return self.plain(self.normal(text))


def shared_codec(shared, threads: int) -> Codec:
    """The worker's codec, made once."""
    holder = shared.value
    if "codec" not in holder:
        holder["codec"] = Codec(read_model(holder["source"]), threads)
    return holder["codec"]


def load(spark, path: str):
    with open(path, "rb") as f:
        source = f.read()
    read_model(source)  # refuse what is not supported before any task runs
    return spark.sparkContext.broadcast({"source": source})


def encode(docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] = ("doc_id",), threads: int = 2) -> DataFrame:
    """``keep`` columns, ``n_tokens, ids, parity, round_trip`` of every row.

    ``round_trip``: decoding ``ids`` gives the normalised text.
    """
    small_batches(docs.sparkSession)
    shared = load(docs.sparkSession, model_path)
    keep = list(keep)
    rows = docs.select(*(docs[k] for k in keep), docs[text_col].cast("string").alias("__text"))
    schema = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep),
                        "n_tokens long, ids array<int>, parity boolean, round_trip boolean"])

    def run(batches):
        codec = shared_codec(shared, threads)
        for batch in batches:
            texts = [t or b"" for t in byte_rows(batch.column(len(keep)))]
            for part in chunks([len(t) for t in texts]):
                strings = [texts[i].decode("utf-8", "replace") for i in part]
                ids, parity, good = codec.encode(strings)
                flat = np.frombuffer(b"".join(ids), "<i4")
                ends = np.cumsum([0, *(len(b) // 4 for b in ids)])
                rows = batch.slice(part.start, len(part))
                yield pa.record_batch(
                    [*(rows.column(i) for i in range(len(keep))), pa.array(np.diff(ends), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                     pa.array(parity, pa.bool_()), pa.array(good, pa.bool_())],
                    names=[*keep, "n_tokens", "ids", "parity", "round_trip"])

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``tokens`` with the text of ``ids_col`` as ``out_col`` (replaced if there); null ids give null."""
    shared = load(tokens.sparkSession, model_path)

    @F.pandas_udf("string")
    def text(ids):
        codec = shared_codec(shared, 1)
        return ids.map(lambda x: None if x is None else codec.decode(list(x)))

    return tokens.withColumn(out_col, text(F.col(ids_col)))
