"""Tree search, vector codes and sharding: brute force, published values, edges of the input."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest

from tidemill.llm import hard_negatives, hyperplane_tree
from tidemill.llm.exact_gemm import products, squares
from tidemill.llm.hard_negatives import mine
from tidemill.llm.hyperplane_tree import Best, HyperplaneTree, Probes, build_tree, search
from tidemill.llm.sharding import grow_shards, grown_rows, jump_hash, place_rows, write_shards
from tidemill.llm.vector_codes import compress, decode, nearest, with_label_error
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string, shard_note string"


# Exact products


@pytest.mark.parametrize("bits_a, bits_b", [(4, 4), (11, 11), (20, 20), (29, 29), (50, 6), (6, 50), (58, 0), (1, 58)])
def test_products_are_exact(bits_a, bits_b):
    rng = np.random.default_rng(bits_a * 64 + bits_b)
    a = rng.integers(-(1 << bits_a), (1 << bits_a) + 1, (23, 7))
    b = rng.integers(-(1 << bits_b), (1 << bits_b) + 1, (31, 7))
    a[0], b[0] = 1 << bits_a, -(1 << bits_b)
    want = [[sum(x * y for x, y in zip(r, s, strict=True)) for s in b.tolist()] for r in a.tolist()]
    assert products(a, b).tolist() == want
    if bits_a < 29:
        assert squares(a).tolist() == [sum(x * x for x in r) for r in a.tolist()]


def test_products_know_their_range():
    with pytest.raises(OverflowError):
        products(np.full((1, 2), 1 << 40), np.full((1, 2), 1 << 40))
    with pytest.raises(OverflowError):
        squares(np.full((1, 2), 1 << 40))


# Hard negatives


def _brute(v, ids, groups, probe, own, low, high, group, same, k):
    score = v @ probe
    good = [i for i in range(len(v)) if i != own and low <= score[i] <= high and (groups[i] == group) == same]
    return [(int(score[i]), int(ids[i]), i) for i in sorted(good, key=lambda i: (-score[i], ids[i], i))[:k]]


def _clustered(n, clusters, dims=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 200, (clusters, dims))
    return np.floor(centres[rng.integers(0, clusters, n)] + rng.normal(0, 8, (n, dims))).astype(np.int64)


@pytest.mark.parametrize("case", ["clusters", "noise", "twins", "one", "line"])
@pytest.mark.parametrize("same", [True, False])
def test_search_is_exact(case, same):
    rng = np.random.default_rng(5)
    v = {
        "clusters": _clustered(900, 30),
        "noise": rng.integers(-50, 50, (500, 6)),
        "twins": np.repeat(rng.integers(-9, 9, (6, 4)), 70, axis=0),
        "one": np.full((200, 3), 7),
        "line": (2 ** np.arange(28))[:, None] * np.ones((1, 2), np.int64),
    }[case]
    ids, groups = rng.integers(0, len(v) // 2 + 1, len(v)), rng.integers(0, 4, len(v))
    tree = build_tree(v, np.arange(len(v)))
    assert sorted(tree.rows.tolist()) == list(range(len(v))) and (tree.vectors == v[tree.rows]).all()
    again = HyperplaneTree.from_bytes(tree.to_bytes(), v.shape[1])
    picked = np.arange(0, len(v), 7)
    middle = np.median(v[picked] @ v.T, axis=1).astype(np.int64)
    low, high = middle - 500, middle + 5000
    best = Best(len(picked), 6)
    search(again, ids[again.rows], groups[again.rows], Probes(v[picked], picked, low, high, groups[picked], same), best)
    for at, i in enumerate(picked):
        want = _brute(v, ids, groups, v[i], i, low[at], high[at], groups[i], same, 6)
        got = [(int(s), int(d), int(r)) for s, d, r in zip(best.score[at], best.id[at], best.row[at], strict=True) if r >= 0]
        assert got == want


def test_siblings_are_left_out():
    v = _clustered(4000, 60)
    tree = build_tree(v, np.arange(len(v)))
    own = np.arange(0, len(v), 100)
    lengths = squares(v[own])
    none, all_ = np.zeros(len(own), np.int64), np.zeros(len(v), np.int64)
    best = Best(len(own), 10)
    scored = search(tree, tree.rows, all_, Probes(v[own], own, lengths * 3 // 10, lengths * 9 // 10, none, True), best)
    assert 0 < scored < 0.35 * len(own) * len(v)
    nodes, runs = tree.point.shape[0], (tree.stop - tree.first)[tree.child < 0]
    assert nodes > 8 and runs.max() <= hyperplane_tree.LEAF_ROWS


def test_empty_tree():
    tree = build_tree(np.zeros((0, 3), np.int64), np.zeros(0, np.int64))
    probes = Probes(np.ones((2, 3), np.int64), np.arange(2), np.zeros(2, np.int64), np.ones(2, np.int64), np.zeros(2, np.int64), True)
    assert search(tree, tree.rows, tree.rows, probes, Best(2, 3)) == 0


def _mined(v, ids, labels, anchors, k_pos=5, k_neg=10):
    out = []
    for a in anchors:
        pos = _brute(v, ids, labels, v[a], a, -(2**62), 2**62, labels[a], True, k_pos)
        for score, pid, _ in pos:
            low, high = -(-30 * score // 100), 90 * score // 100
            for rank, (s, nid, _) in enumerate(_brute(v, ids, labels, v[a], a, low, high, labels[a], False, k_neg), 1):
                out.append((int(ids[a]), pid, rank, nid, score, s))
    return sorted(out)


def test_mining_over_blocks_and_slices(spark, monkeypatch):
    """Several blocks, cells, slices and groups of probes; repeated ids and rows; a vector that fills a third."""
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 60 * 8 * 6)
    monkeypatch.setattr(hard_negatives, "SLICE_BYTES", 200 * 8 * 6)
    monkeypatch.setattr(hard_negatives, "PROBE_BYTES", 20 * 8 * 6)
    rng = np.random.default_rng(8)
    n = 700
    v = _clustered(n, 12, 6)
    v[rng.permutation(n)[: n // 3]] = v[0]
    ids, labels = rng.integers(0, 600, n), rng.integers(-2, 4, n)
    rows = [(int(i), (x / 256).tolist(), int(g)) for i, x, g in zip(ids, v, labels, strict=True)]
    extra = [(None, [1.0] * 6, 1), (7, None, 1), (8, [1.0, None] * 3, 1), (9, [float("nan")] * 6, 1), (10, [float("inf")] * 6, 2), (11, [1.0] * 6, None)]
    got = mine(spark.createDataFrame(rows + extra, VECTORS).repartition(5), F.col("vec_id") % 20 == 0).collect()
    want = _mined(v, ids, labels, [i for i in range(n) if ids[i] % 20 == 0])
    assert sorted(tuple(r) for r in got) == want and len(want) > 100


def test_mining_without_rows_or_fits(spark):
    anchor = F.col("vec_id") == 0
    assert mine(spark.createDataFrame([], VECTORS), anchor).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1)], VECTORS)
    assert mine(alone, anchor).collect() == []
    # a negative positive score opens no window; a score of nought only fits noughts; short vectors end in zeros
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.5], 2), (3, [], 2)]
    assert mine(spark.createDataFrame(rows, VECTORS), anchor).collect() == []
    rows = [(0, [1.0, 0.0], 1), (1, [], 1), (2, [0.0, 1.0], 2), (3, [0.5], 2)]
    clash = spark.createDataFrame(rows, VECTORS).select("*", F.lit("x").alias("row"), F.lit("y").alias("v"), F.lit("z").alias("block"))
    assert [tuple(r) for r in mine(clash, anchor).collect()] == [(0, 1, 1, 2, 0, 0)]


# Vector codes


def _plain_codes(rows, parts, entries, rounds):
    """Codes, errors and codebooks by loops over whole numbers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    cut = [[r[1][p * width : (p + 1) * width] for r in rows] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def find(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            met = {}
            for x in cut[p]:
                met.setdefault(find(x, books[p])[0], []).append(x)
            for e, xs in met.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    coded = []
    for i, r in enumerate(rows):
        found = [find(cut[p][i], books[p]) for p in range(parts)]
        coded.append((r[0], bytes(f[0] for f in found), sum(f[1] for f in found)))
    return coded, books


def test_codes_against_loops(spark):
    rng = np.random.default_rng(2)
    whole = rng.integers(-3000, 3000, (120, 8))
    whole[40:90] = whole[3]
    whole[100:] = whole[99] + rng.integers(-1, 2, (20, 8))
    ids = [None, *rng.integers(0, 90, 119).tolist()]
    rows = [(i, (x / 1024).tolist(), int(g)) for i, x, g in zip(ids, whole, rng.integers(0, 3, 120), strict=True)]
    bad = [(1, None, 1), (2, [None] * 8, 1), (3, [float("nan")] * 8, 1), (4, [float("-inf")] * 8, None)]
    coded, books = compress(spark.createDataFrame(rows + bad, VECTORS).repartition(7), entries=16)
    want, want_books = _plain_codes([(i, x.tolist()) for i, x in zip(ids, whole, strict=True)], 4, 16, 4)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.vec_id, bytes(r.code), r.error) for r in coded.collect()), key=key) == sorted(want, key=key)
    assert [b.tolist() for b in books.parts] == want_books
    assert books.sha256() == hashlib.sha256(",".join(str(x) for b in want_books for e in b for x in e).encode()).hexdigest()
    assert sum(int(((decode(c, books) - x) ** 2).sum()) for (_, c, _), x in zip(want, [x for _, x in sorted(zip([(i is None, i or 0) for i in ids], whole.tolist()))], strict=True)) == sum(e for *_, e in want)


def test_nearest_takes_the_first_of_ties():
    entries = np.array([[0, 0], [4, 0], [0, 0], [-4, 0]])
    index, error = nearest(np.array([[2, 0], [-2, 0], [0, 0], [9, 9]]), entries)
    assert index.tolist() == [0, 0, 0, 1] and error.tolist() == [4, 4, 0, 106]


def test_codes_of_odd_tables(spark, monkeypatch):
    none, books = compress(spark.createDataFrame([], VECTORS))
    assert none.collect() == [] and [len(p) for p in books.parts] == [0] * 4
    rows = [(1, [], 1), (2, [0.5], None), (2, [0.5, 0.5, 0.5, 0.5, 0.25], None), (3, [0.5], 1)]
    clash = spark.createDataFrame(rows, VECTORS).select("*", F.lit(1).alias("v"), F.lit(2).alias("code"), F.lit(3).alias("error"))
    coded, books = compress(clash)
    assert books.dims == 8 and sorted(r.error for r in coded.collect()) == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        compress(clash, entries=300)


@pytest.mark.parametrize("few", [0, 1000])
def test_label_errors(spark, monkeypatch, few):
    monkeypatch.setattr("tidemill.llm.vector_codes._FEW_LABELS", few)
    rows = [(i, None if i % 3 == 0 else i % 3, b"c", i) for i in range(30)]
    got = with_label_error(spark.createDataFrame(rows, "vec_id long, label int, code binary, error long"))
    want = {g: sum(r[3] for r in rows if r[1] == g) for g in (None, 1, 2)}
    assert {(r.vec_id, r.label, r.error, r.label_error) for r in got.collect()} == {(i, g, e, want[g]) for i, g, _, e in rows}


# Sharding


def _jump(key: int, n: int) -> int:
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    keys = [0, 1, 2, 42, -1, -(2**63), 2**63 - 1, 256, 0xDEAD10CC, 123456789012345, *range(1000, 1200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 40, 41, 666, 5000):
        got = {r.k: r.s for r in df.select("k", jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: _jump(k, n) for k in keys}
    # published values of this hash
    assert [_jump(k, n) for k, n in ((1, 1), (42, 57), (0xDEAD10CC, 1), (0xDEAD10CC, 666), (256, 1024))] == [0, 43, 0, 361, 520]
    with pytest.raises(ValueError):
        jump_hash(F.col("k"), 0)


def test_keys_that_take_many_steps_are_whole(spark, monkeypatch):
    monkeypatch.setattr("tidemill.llm.sharding._USUAL_STEPS", 3)
    df = spark.range(300)
    assert {r.id: r.s for r in df.select("id", jump_hash(F.col("id"), 100).alias("s")).collect()} == {k: _jump(k, 100) for k in range(300)}


def test_places(spark):
    same = [(None, None, "a")] * 40 + [(7, "x" * 9, "b")] * 30
    rows = same + [(i, t, "c") for i, t in enumerate(["", "é\n", "words " * 3000, *[f"text {i}" for i in range(200)]])]
    got = place_rows(spark.createDataFrame(rows, DOCS).repartition(6), 8).collect()
    assert sorted((-1 if r.key is None else r.key, r.size, r.text_crc32) for r in got) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    for shard, of in itertools.groupby(sorted(got, key=lambda r: r.shard), key=lambda r: r.shard):
        assert sorted(r.slot for r in of) == list(range(sum(r.shard == shard for r in got)))
    assert all(r.shard == _jump(r.key or 0, 8) and r.grown_shard == _jump(r.key or 0, 9) for r in got)
    assert {r.grown_shard for r in got if r.grown_shard != r.shard} == {8} and {r.law for r in got} == {"key"}
    other_parts = place_rows(spark.createDataFrame(rows, DOCS).repartition(3), 8)
    assert sorted(map(str, got)) == sorted(map(str, other_parts.collect()))
    assert place_rows(spark.createDataFrame([], DOCS)).collect() == []


def test_text_keys(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "doc_id string, text string")
    assert {r.key for r in place_rows(rows, 5).collect()} == {"a", "b", None}


def test_written_shards_grow(spark, tmp_path):
    source = str(tmp_path / "docs")
    rows = [(i if i % 3 else None, f"text {i} " * 20, "n") for i in range(600)]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(source)
    docs, path, grown = spark.read.parquet(source), str(tmp_path / "shards"), str(tmp_path / "more")
    write_shards(docs, path, 4, file_bytes=20_000)
    back = spark.read.parquet(path)
    hot = back.where("shard = 0").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(hot) > 1  # the shard of the null keys is several files
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((i or -1, t) for i, t, _ in rows)
    assert all(r.shard == _jump(r.doc_id or 0, 4) for r in back.collect())
    grow_shards(spark, path, grown, 4)
    after = grown_rows(spark, path, grown, 4).collect()
    assert sorted((r.doc_id or -1, r.text, r.shard) for r in after) == sorted((i or -1, t, _jump(i or 0, 5)) for i, t, _ in rows)
    with pytest.raises(ValueError):
        write_shards(docs.withColumn("SHARD", F.lit(1)), str(tmp_path / "no"))
