"""The registered queries: against their SQL twins, or against brute force on the smallest tables."""

import zlib

import pytest

import brute
from compare import connect, difference
from tidemill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_same_as_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name].run(spark, sf_dir), con, QUERIES[name].sql) is None
    assert con.sql(f"SELECT count(*) FROM ({QUERIES[name].sql})").fetchall()[0][0] > 0


def test_every_number_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_simhash(spark, sf_dir, docs):
    rows = QUERIES["op6_simhash"].run(spark, sf_dir).collect()
    prints = {i: brute.fingerprint(t) for i, t in docs.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute.components(prints)
    assert len({r.component_id for r in rows}) < len(rows) == len(docs)


def test_pii(spark, sf_dir, docs):
    rows = QUERIES["op9_pii"].run(spark, sf_dir).collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        spans = [":".join(map(str, s)) for s in brute.base_spans(docs[r.doc_id])]
        assert r.base_sha256 == brute.sha(",".join(spans))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in spans) for k, _ in brute.KINDS]
        assert set(spans) <= set(r.spans.split(","))


@pytest.mark.parametrize("name, column, right", [("op10_quality", "quality", 0.95), ("op4_toxicity", "toxic", 0.93)])
def test_classifiers_on_held_out_rows(spark, name, column, right):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES[name].run(spark, sf).collect()
    truth = dict(connect(sf).sql(f"SELECT doc_id, {column} FROM labels").fetchall())
    out = {r.doc_id for r in rows if r.held_out}
    assert out == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 for r in rows)
    seen = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    for label in (0, 1):
        of = [p == t for p, t in seen if t == label]
        assert sum(of) / len(of) >= (right if label == (column == "quality") else 0.85)
    assert sum(p == t for p, t in seen) / len(seen) >= right


def test_packing(spark, sf_dir, docs):
    rows = QUERIES["op8_packing"].run(spark, sf_dir).collect()
    words = {i: len(t.split()) for i, t in docs.items()}
    assert {i: sum(r.n_tokens for r in rows if r.doc_id == i) for i in docs} == words
    bins = {}
    for r in rows:
        bins.setdefault((r.bin_id, r.bin_size), []).append((r.bin_offset, r.n_tokens))
    for (_, size), pieces in bins.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= size and (size == 512 or at > size // 2)
    assert len({b for b, _ in bins}) == len(bins)
