"""Collocations: the automata against plain dictionaries, the operator against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from creditpulse.llm import collocations as C


def rows_of(net):
    columns, weights = net.paths()
    return {tuple(net.words[c[i]] for c in columns): int(w) for i, w in enumerate(weights)}


def net_of(counts):
    words = sorted({w for key in counts for w in key})
    label = {w: i for i, w in enumerate(words)}
    keys = sorted(counts)
    columns = [np.array([label[k[j]] for k in keys]) for j in range(len(keys[0]))]
    return C.Transducer.build(words, columns, np.array([counts[k] for k in keys]))


def made_up(k, n, seed):
    rng = random.Random(seed)
    letters = [bytes([97 + i]) * (1 + i % 3) for i in range(9)] + ["é".encode(), b"\x01"]
    return {tuple(rng.choices(letters, k=k)): rng.randint(1, 3) for _ in range(n)}


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_a_transducer_holds_its_rows(k):
    counts = made_up(k, 300, k)
    net = C.Transducer.unpack(net_of(counts).pack())
    assert rows_of(net) == counts
    keys = list(counts) + [(b"zz",) * k, (b"a",) * k]
    words = sorted({w for key in keys for w in key})
    columns = [np.array([words.index(key[j]) for key in keys]) for j in range(k)]
    assert net.weights(words, columns).tolist() == [counts.get(key, 0) for key in keys]


def test_equal_tails_are_stored_once():
    counts = {(bytes([97 + i]), b"the", b"end"): 1 for i in range(20)}
    net = net_of(counts)
    assert [len(x) for x in net.labels] == [20, 1, 1] and rows_of(net) == counts


def test_union_sums_weights_and_prunes():
    parts = [made_up(3, 200, s) for s in range(6)]
    union, want = C.Union(), Counter()
    for p in parts:
        union.add(net_of(p))
        want.update(p)
    assert rows_of(union.net(4)) == {k: n for k, n in want.items() if n >= 4}
    assert C.Union().net() is None


def test_ranges_agree_whatever_the_labels(monkeypatch):
    monkeypatch.setattr(C, "RANGE_WORDS", 50)
    counts = made_up(2, 400, 1) | made_up(2, 50, 2)
    ranges = C.Ranges.of([("en", k[0], n * (40 if k[0] == b"a" else 1)) for k, n in counts.items()])
    assert len(ranges.bounds["en"]) > 3 and any(second for _, second in ranges.bounds["en"])

    def place(keys):
        words = sorted({w for key in keys for w in key})
        keys = sorted(keys)
        columns = [np.array([words.index(key[j]) for key in keys]) for j in range(len(keys[0]))]
        return {key: r for r, rows in ranges.cut("en", words, columns) for key in keys[rows]}

    whole = place(list(counts))
    for key in counts:
        assert place([key]) == {key: whole[key]}
        assert place([key[:1]])[key[:1]] <= whole[key]


def brute(rows, least=30, top=2000, longest=4):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]", piece) if w]
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i:j] for p, a in good.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and 100 * a >= 80 * f[p[i:j]]}
        rows = []
        for p, a in good.items():
            if p not in dropped:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(n=300, seed=5):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "times", "a", "é", "世界", "x" * 300, "\x85", "\x1c", "'s", "#"]
    weights = [9, 7, 5, 5, 3, 2, 2, 1, 1, 1, 1, 1, 1]
    seps = [" "] * 12 + ["  ", "\t", ", ", "\n", ".", "\r\n", "!?"]
    return ["".join(w + rng.choice(seps) for w in rng.choices(vocabulary, weights, k=rng.randint(0, 60))) for _ in range(n)]


def test_the_operator_equals_brute_force(spark, frame, monkeypatch):
    monkeypatch.setattr(C, "RANGE_WORDS", 400)  # many ranges
    monkeypatch.setattr(C, "TASK_ROWS", 200)  # many flushes: driver side only
    given = texts() + ["same phrase again " * 4000, "the " * 3000, None, "", "\xff", " . "]
    langs = ["en", "de", None, "und", "LANG"]
    df = frame(given)
    rows = [(langs[i % 5], t) for i, t in enumerate(given)]
    df = spark.createDataFrame([(i, t, lang, None, None) for i, (lang, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, word string, net long")
    got = sorted(map(tuple, C.collocations(df.repartition(5)).collect()))
    assert got == brute(rows) and len(got) > 50


def test_a_limit_and_ties(spark):
    rows = [("en", f"tie{i % 7} word{i % 7}") for i in range(7 * 40)] + [("en", "tie0 word0")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, lang string, text string")
    got = sorted(map(tuple, C.collocations(df, top=3).collect()))
    assert got == brute(rows, top=3) and [r[1] for r in got] == [1, 2, 3]


def test_counts_beyond_64_bit_products():
    a = np.array([3 * 10**13, 7], np.int64)
    part = {(0, 1): np.array([4 * 10**13, 9]), (1, 2): np.array([5 * 10**13, 8])}
    left, right, score = C.scored([None, None], a, part)
    assert score.tolist() == [2_000_000 * 3 * 10**13 // (9 * 10**13), 2_000_000 * 7 // 17]


def test_odd_and_empty_tables(odd_frame, empty_frame):
    rows = [(r.lang, r.text) for r in odd_frame.collect()]
    assert sorted(map(tuple, C.collocations(odd_frame).collect())) == brute(rows)
    out = C.collocations(empty_frame)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
