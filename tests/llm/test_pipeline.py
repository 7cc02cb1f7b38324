"""The pipeline's stages against brute force, and the registered queries on the small tables."""

import duckdb
import pytest
import sentencepiece
import public_tokenizers as P

import __spark_entry__ as entry
import corpus_pipeline
from creditpulse.llm import secret_scans as X
from creditpulse.llm.queries import ORACLES, QUERIES
from creditpulse.llm.stages import COLUMNS, STAGES
from tests.llm.test_dedup import groups, plain_fingerprint
from tests.llm.test_filters import plain_quality

STAGE = dict(STAGES)


def plain(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in STAGES] == ["quality", "simhash", "secrets", "mixing", "encoding"] and corpus_pipeline.STAGES is STAGES


def test_stages_equal_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    now = docs.collect()
    kept = {i for i, _, _, k in plain_quality([(r.doc_id, r.text or "", r.source) for r in now], 100) if k}
    docs = STAGE["quality"](spark, docs, sf_small)
    now = [r for r in now if r.doc_id in kept]
    assert docs.columns == COLUMNS and plain(docs.collect()) == plain(now)

    fps = [plain_fingerprint(r.text) for r in now]
    order = sorted(range(len(now)), key=lambda i: now[i].doc_id)
    fps = [fps[i] for i in order]
    root = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    now = [now[i] for k, i in enumerate(order) if root[k] == k]
    docs = STAGE["simhash"](spark, docs, sf_small)
    assert docs.columns == COLUMNS and plain(docs.collect()) == plain(now)

    docs = STAGE["secrets"](spark, docs, sf_small)
    clean = {r.doc_id: X.redact(r.text, [s[1:] for s in X.spans(r.text)]) for r in now}
    found = docs.collect()
    assert docs.columns == COLUMNS and {r.doc_id: r.text for r in found} == clean
    assert all(r.n_chars == len(r.text) for r in found if "[SECRET]" in r.text)

    docs = STAGE["mixing"](spark, docs, sf_small)
    mixed = docs.collect()
    assert docs.columns == COLUMNS and {r.text for r in mixed} <= {r.text for r in found}
    times = [sum(m.doc_id == r.doc_id for m in mixed) for r in found]
    words = [len(r.text.split()) for r in found]
    assert max(times) <= 2 and 1.3 < sum(t * w for t, w in zip(times, words)) / sum(words) < 1.7

    rows = STAGE["encoding"](spark, docs, sf_small).collect()
    judge = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {r.doc_id: judge.encode(r.text) for r in mixed}
    assert len(rows) == len(mixed) and all(list(r.ids) == want[r.doc_id] and r.round_trip for r in rows)


def test_run(spark, sf_small):
    rows = corpus_pipeline.run(spark, sf_small)
    assert rows.count() > 0 and {"doc_id", "ids"} <= set(rows.columns)


@pytest.mark.parametrize("name", [n for n, _ in STAGES])
def test_stages_on_odd_tables(spark, sf_small, odd_frame, empty_frame, name):
    out = STAGE[name](spark, odd_frame, sf_small)
    rows = out.collect()
    assert (out.columns == COLUMNS) == (name != "encoding")
    if name in ("secrets", "encoding"):
        assert len(rows) == odd_frame.count()
    if name == "simhash":
        assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "5", "6", "7", "8", "None"]
    assert STAGE[name](spark, empty_frame, sf_small).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[name](spark, sf_small)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=str) == sorted(found.fetchall(), key=str)
