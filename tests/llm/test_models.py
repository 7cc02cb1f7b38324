"""Toxicity and language-model scores: brute force for what is exact, held-out checks for the rest."""

import math
import random
import timeit
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from creditpulse.llm import lm_scoring as L
from creditpulse.llm import toxicity as T

SMALL = dict(filter_bytes=1 << 20, hot_words=50)


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- language model ----------------------------------------------------------


def corpus(n=300):
    rng = random.Random(6)
    words = [f"W{i}" for i in range(500)]
    odds = [1 / (i + 1) for i in range(500)]
    passage = rng.choices(words, odds, k=60)
    return [" ".join(rng.choices(words, odds, k=rng.randint(0, 80)) + (passage if rng.random() < 0.3 else [])) for _ in range(n)]


def exact(texts):
    tokens = [(t or "").encode().lower().split() + [b"\n"] for t in texts]
    c = Counter(w for i, t in enumerate(tokens) if remainder(i, 5) != 1 for w in t)
    n, v = sum(c.values()), len(c)
    return [(remainder(i, 5) == 1, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
            for i, t in enumerate(tokens)]


def test_coded_tokens_are_the_split_ones():
    texts = [b"", b"A a\tB", b" \n ", "É x\x1cy\u2028z Ä\x0b".encode(), b"\n\x85a\r\n", b"END a"]
    words, place, length = L.coded(texts)
    seqs = [L.tokens(t) for t in texts]
    assert length.tolist() == list(map(len, seqs))
    assert [words[i] for i in place] == [w for s in seqs for w in s]
    assert len(set(words)) == len(words) and words[-1] == L.END
    assert [x.tolist() if hasattr(x, "tolist") else x for x in L.coded([b""])] == [[L.END], [0], [1]]


def test_pairs_are_counted_in_little_memory():
    rng = np.random.default_rng(3)
    key, left = rng.integers(0, 1 << 20, (2, 1 << 20)).astype(np.uint64)
    held = [(key[i:i + (1 << 16)].copy(), left[i:i + (1 << 16)].copy()) for i in range(0, 1 << 20, 1 << 16)]
    tracemalloc.start()
    got = L.counted_pairs(held)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    first, times = np.unique(key, return_index=True, return_counts=True)[1:]
    assert [x.tolist() for x in got] == [key[first].tolist(), left[first].tolist(), times.tolist()]
    assert not held and peak < 2.75 * (key.nbytes + left.nbytes)
    assert [len(x) for x in L.counted_pairs([(key[:0], left[:0])])] == [0, 0, 0]


def test_byte_values_are_those_of_the_column():
    a = pa.array([b"", b"ab", b"\x00\xff", b"", "é".encode()] * 50_000, pa.binary())
    for column in (a, a.cast(pa.large_binary()), a[3:-2], a[:0], a[3:4], pa.array([], pa.large_binary())):
        assert L.byte_values(column) == column.to_pylist()
    timed = lambda f: min(timeit.repeat(f, number=1, repeat=3))
    assert timed(lambda: L.byte_values(a)) < timed(a.to_pylist) / 2


def test_filter_of_any_width_finds_its_keys():
    keys = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) & L.MASK
    for width in (64, 65):  # a power of two and none
        table = np.zeros((L.SLICES, width), np.uint8)
        at = L.LogFrequencyFilter.places(keys[::2], 1, width * 8, 3).astype(np.int64)
        np.bitwise_or.at(table, (L.LogFrequencyFilter.slice_of(keys[::2])[:, None], at >> 3), (1 << (at & 7)).astype(np.uint8))
        found = L.LogFrequencyFilter(table, 3).has(keys, 1)
        assert found[::2].all() and found[1::2].mean() < 0.05


def test_counts_are_sent_in_small_batches():
    batch = pa.record_batch([pa.array(range(2 * L.SENT_ROWS + 3))], names=["c"])
    parts = list(L.small(batch))
    assert [p.num_rows for p in parts] == [L.SENT_ROWS, L.SENT_ROWS, 3] and pa.Table.from_batches(parts)["c"].to_pylist() == list(range(batch.num_rows))


def test_base_columns_are_exact_and_scores_gain_from_repeats(frame):
    texts = corpus() + ["", None, "unseen-word " * 3, "\t\n"]
    got = sorted(L.score_documents(frame(texts), **SMALL).collect())
    want = exact(texts)
    for r, (held, n, known, total, base) in zip(got, want):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score <= 0 and math.isfinite(r.score)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def plain_lm_scores(texts, mu=20.0, quantised=True):
    """Scores from counters in place of the filter; with or without the rounding of counts to levels."""
    read = (lambda c: float(L.LEVEL_VALUES[L.levels_of(np.array([c]))[0]])) if quantised else float
    tokens = [(t or "").encode().lower().split() + [b"\n"] for t in texts]
    words, pairs, stored = Counter(), Counter(), Counter()
    for i, t in enumerate(tokens):
        if remainder(i, 5) != 1:
            words.update(t)
            pairs.update(zip(t, t[1:]))
    for (h, _), c in pairs.items():
        stored[h] += c if c >= 2 else 0
    n = sum(words.values())
    total = n + 0.5 * (len(words) + 1)
    c = lambda w: min(read(words[w]), n)

    def step(h, w):
        joint = min(read(pairs[h, w]) if pairs[h, w] >= 2 else 0.0, c(h), c(w))
        rest = max(c(h) - read(stored[h]), 0.0) + mu
        return math.log10(min((joint + rest * (c(w) + 0.5) / total) / (max(c(h), joint) + mu), 1.0))

    return [math.log10((c(t[0]) + 0.5) / total) + sum(map(step, t, t[1:])) for t in tokens]


def test_scores_equal_brute_force(frame):
    texts = corpus() + ["", None, "unseen-word " * 3, "\t\n", "w1", "W1 unseen-word w2 w1 w2"]
    got = {r.doc_id: r.score for r in L.score_documents(frame(texts), group_bytes=1 << 22, hot_words=50).collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(plain_lm_scores(texts)):
        assert got[i] == pytest.approx(want, rel=1e-9)
    # What the rounding to levels costs: a quarter a step, so single tokens differ and sums hardly.
    assert sum(got.values()) == pytest.approx(sum(plain_lm_scores(texts, quantised=False)), rel=0.03)


def test_probabilities_of_a_context_sum_to_one(frame):
    model, words = L.learn(frame(corpus()), **SMALL)
    vocab = [r.word for r in words.collect()]
    scorer = L.Scorer(model)
    for first in (b"w0", b"w3", b"w40", b"never-seen"):
        alone = scorer.score([first])[3][0]
        c = model.filter.counts(L.unigram_keys([first]))[0]
        start = math.log10((c + 0.5) / (model.n + 0.5 * (model.v + 1)))
        total = 0.0
        for w in vocab:
            two = scorer.score([first + b" " + w])[3][0] if w != L.END else alone
            if w != L.END:
                cw = model.filter.counts(L.unigram_keys([w]))[0]
                after = scorer.score([w])[3][0] - math.log10((cw + 0.5) / (model.n + 0.5 * (model.v + 1)))
                two -= after  # leaves the first word and w after it
            total += 10 ** (two - start)
        assert 0.85 < total < 1.15


def test_filter_reads_counts_back():
    rng = np.random.default_rng(0)
    keys = L.unigram_keys([b"k%d" % i for i in range(3000)])
    counts = np.minimum(rng.zipf(1.6, 3000), 100_000)
    bits = np.zeros((L.SLICES, 64), np.uint8)
    level = L.levels_of(counts)
    for k, lv in zip(keys, level):
        at = L.LogFrequencyFilter.places(np.repeat(k, lv), np.arange(1, lv + 1), 512, 6).astype(np.int64).ravel()
        np.bitwise_or.at(bits[int(L.LogFrequencyFilter.slice_of(np.array([k]))[0])], at >> 3, (1 << (at & 7)).astype(np.uint8))
    found = L.LogFrequencyFilter(bits, 6).counts(keys)
    assert (found >= L.LEVEL_VALUES[level]).all()  # errors are one-sided
    assert (found == L.LEVEL_VALUES[level]).mean() > 0.97
    assert np.abs(np.log(L.LEVEL_VALUES[level] / counts)).max() < 0.2
    missing = L.LogFrequencyFilter(bits, 6).counts(L.unigram_keys([b"m%d" % i for i in range(3000)]))
    assert (missing > 0).mean() < 0.05


def test_small_filter_keeps_the_frequent(frame):
    texts = corpus()
    model, _ = L.learn(frame(texts), filter_bytes=1 << 13, hot_words=50)
    assert model.cut_off > 2
    rows = L.score_documents(frame(texts), filter_bytes=1 << 13, hot_words=50).collect()
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_filter_grows_in_groups_and_drops_no_count(frame):
    """No cut-off rises with the corpus: several groups hold what one filter holds.
    They are wide, as one frequent key fills a small slice."""
    texts = corpus()
    model, words = L.learn(frame(texts), group_bytes=1 << 20, bits_per_key=4000, hot_words=50)
    assert model.cut_off == 2 and len(model.filter.groups) > 2
    counts = {r.word: r.c for r in words.collect()}
    read = model.filter.counts(L.unigram_keys(list(counts)))
    assert (read >= L.LEVEL_VALUES[L.levels_of(np.array(list(counts.values())))]).all()
    pairs = Counter()
    for i, t in enumerate(texts):
        if remainder(i, 5) != 1:
            w = L.tokens(t.encode())
            pairs.update(zip(w, w[1:]))
    often = [p for p, c in pairs.items() if c >= 2]
    left, right = (L.unigram_keys([p[k] for p in often]) for k in (0, 1))
    read = model.filter.counts(L.bigram_keys(left, right))
    assert (read >= L.LEVEL_VALUES[L.levels_of(np.array([pairs[p] for p in often]))]).all()

    one = {r.doc_id: r for r in L.score_documents(frame(texts), hot_words=50).collect()}
    many = {r.doc_id: r for r in L.score_documents(frame(texts), group_bytes=1 << 20, bits_per_key=4000, hot_words=50).collect()}
    assert one.keys() == many.keys()
    for i, r in one.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (many[i].n_tokens, many[i].n_known, many[i].train_tokens)
        assert many[i].base_score == pytest.approx(r.base_score, rel=1e-9) and many[i].score == pytest.approx(r.score, rel=0.03, abs=0.5)


def test_lm_odd_tables(odd_frame, empty_frame):
    rows = L.score_documents(odd_frame, **SMALL).collect()
    assert len(rows) == odd_frame.count() and sum(r.doc_id == 1 for r in rows) == 2
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert L.score_documents(empty_frame, **SMALL).count() == 0


# --- toxicity ----------------------------------------------------------------


def labelled(n=900, biased=True, hidden=0.0):
    """Insults make a text toxic (a share ``hidden`` has none that is seen); a group is named more often in toxic texts."""
    rng = random.Random(9)
    words = [f"plain{i}" for i in range(200)]
    texts, marks = [], []
    for _ in range(n):
        bad = rng.random() < 0.3
        text = rng.choices(words, k=30) + rng.choices(["vilescum", "vilerat", "nastyhead"], k=2 if bad and rng.random() >= hidden else 0)
        text += ["muslim"] if biased and rng.random() < (0.7 if bad else 0.02) else []
        rng.shuffle(text)
        texts.append(" ".join(text).capitalize() + ".")
        marks.append(int(bad))
    return texts, marks


def trained(spark, frame, texts, marks, **options):
    labels = spark.createDataFrame([(i, 0, m) for i, m in enumerate(marks)] + [(None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    return T.train(frame(texts), labels, **options)


def test_held_out_accuracy(spark, frame):
    texts, marks = labelled()
    rows = T.score(frame(texts), trained(spark, frame, texts, marks)).collect()
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == marks[r.doc_id] for r in held]) > 0.97


def test_counterfactual_penalty_spares_neutral_mentions(spark, frame):
    texts, marks = labelled(hidden=0.4)
    neutral = [f"A {g} neighbour plain{i} plain{i + 1} plain{i + 2}" for i, g in enumerate(["muslim", "christian", "jewish", ""] * 20)]
    scores = {}
    for penalty in (0.0, 10.0):
        model = trained(spark, frame, texts, marks, penalty=penalty)
        out = {r.doc_id: r.score for r in T.score(frame(neutral), model).collect()}
        scores[penalty] = [np.mean([out[i] for i in range(k, 80, 4)]) for k in range(4)]
    assert scores[0.0][0] > scores[0.0][3] + 0.05  # unpenalised, the mention alone raises the score
    assert abs(scores[10.0][0] - scores[10.0][1]) < 0.2 * (scores[0.0][0] - scores[0.0][1])
    assert scores[10.0][0] < 0.5 * scores[0.0][0]


def test_labels_of_held_out_rows_are_not_used(spark, frame):
    texts, marks = labelled(300)
    other = [1 - m if remainder(i, 3) == 1 else m for i, m in enumerate(marks)]
    a, b = trained(spark, frame, texts, marks), trained(spark, frame, texts, other)
    assert a.names == b.names and np.allclose(a.weights, b.weights)


def test_toxicity_odd_tables(spark, frame, odd_frame, empty_frame):
    texts, marks = labelled(300)
    model = trained(spark, frame, texts, marks)
    rows = T.score(odd_frame, model).collect()
    assert len(rows) == odd_frame.count()
    empty = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1 and empty.pop() < 0.7
    assert T.score(empty_frame, model).count() == 0
    nothing = T.train(empty_frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in T.score(odd_frame, nothing).collect()} == {0.5}
    one_class = trained(spark, frame, texts, [0] * len(texts))
    assert all(r.score < 0.5 for r in T.score(frame(texts), one_class).collect())
