"""Nulls, empty and very long texts, repeated rows, ties, empty tables and clashing names."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from test_shingle_sets import groups_of
import corpus_pipeline
from tidemill.llm import exact_dedup, line_dedup, packing, perfect_hash, pii, quality, simhash, tokens, toxicity, url_filter, vector_search

# Names the operators use inside, as extra columns.
EXTRA = "lost_lines int, k1 int, a int, line int, spans int, fp int, words int, id int, n_tokens int, v int, kept_id int, digest int"
DOCS = f"doc_id long, text string, n_chars long, {EXTRA}"


def table(spark, rows):
    n = EXTRA.count(",") + 1
    return spark.createDataFrame([(i, t, len(t or ""), *range(n)) for i, t in rows], DOCS)


LONG = "\n".join(f"A long line number {i}" for i in range(3000))
ROWS = [
    (5, "Shared line of text\nmine only here\nshort"),
    (3, "  shared LINE of text \t\nother words here\nshort\nshared line of text"),
    (9, "\x0bShared line of text\r\n\nÄhnlich lange Zeile\nähnlich lange zeile"),
    (11, "Ähnlich lange Zeile"),
    (7, None),
    (8, ""),
    (8, ""),
    (None, "Shared line of text"),
    (12, LONG),
    (13, LONG + "\nand one more line"),
    (14, "repeated row of the table"),
    (14, "repeated row of the table"),
    (15, "no-break\xa0space line\xa0"),
    (16, "no-break\xa0space line"),
    (17, "\n\n\n"),
]


def test_lines(spark):
    got = line_dedup.dedup_lines(table(spark, ROWS))
    assert got.columns == table(spark, []).columns
    want = brute.kept_lines(ROWS)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((i, t) for (i, _), t in zip(ROWS, want, strict=True))
    assert all(r.n_chars == len(r.text) for r in got.where("text IS NOT NULL").collect())
    assert line_dedup.dedup_lines(table(spark, [])).collect() == []


def test_exact_groups(spark):
    rows = [(1, "a b\tc"), (2, "abc"), (3, None), (4, " \n"), (5, "a  b  c"), (6, "a  b  c"), (None, "abc     x"), (7, "Abc"), (7, "Abc"), (None, "only"), (8, "x" * 300_000)]
    for old in ([], rows[:4], rows[5:], rows):
        new = [r for r in rows if r not in old]
        got = exact_dedup.exact_groups(table(spark, old), table(spark, new)).collect()
        by = Counter((r.id, r.keep_id, r.group_size) for r in got)
        assert by == Counter([(1, 5, 4), (2, 5, 4), (5, 5, 4), (6, 5, 4), (3, 4, 2), (4, 4, 2), (None, None, 1), (None, None, 1), (7, 7, 2), (7, 7, 2), (8, 8, 1)])


def test_fingerprints_and_groups(spark):
    base = [f"w{i}" for i in range(400)]
    rng = random.Random(1)
    rows = [(i, t) for i, t in ROWS if i not in (None, 14)]
    for i in range(100, 160):
        words = list(base)
        words[rng.randrange(400)] = "changed"
        rows.append((i, "  ".join(words)))
    got = {(r.id, r.fp & (2**64 - 1)): r.component_id for r in simhash.near_groups(table(spark, rows)).collect()}
    prints = {i: brute.fingerprint(t) for i, t in rows}
    want = brute.components(prints)
    assert got == {(i, prints[i]): want[i] for i in want}
    null = simhash.near_groups(table(spark, [(None, "alone here"), (None, "x y z"), (4, "x y z")])).collect()
    assert Counter((r.id, r.component_id) for r in null) == Counter([(None, None), (None, 4), (4, 4)])
    kept = simhash.drop_near_copies(table(spark, rows))
    assert kept.columns == table(spark, []).columns and {r.doc_id for r in kept.collect()} == set(want.values())
    assert simhash.near_groups(table(spark, [])).collect() == []


def test_crowded_values_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FINGERPRINTS_PER_CHUNK", 20)
    rng = random.Random(4)
    prints = {0}
    for _ in range(150):
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)) ^ (1 << rng.randrange(40)))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for limit in (1, 2, 3):
        stars = {r.node: r.root for r in simhash.components(simhash.links(df, limit)).collect()}
        assert {p: stars.get(p, p) for p in prints} == brute.components({p: p for p in prints}, limit)


@pytest.mark.parametrize("seed", range(5))
def test_gray_index(seed):
    rng = np.random.default_rng(seed)
    seeds = rng.integers(0, 2**63, 6).astype(np.uint64)
    prints = seeds[rng.integers(0, 6, 300)]
    for _ in range(seed + 2):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    index = simhash.GrayIndex(np.unique(prints))
    got = index.components(4)
    want = brute.components({i: int(p) for i, p in enumerate(index.prints)})
    assert got.tolist() == [want[i] for i in range(len(got))]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    assert {r.node: r.root for r in simhash.components(edges).collect()} == {**dict.fromkeys(range(1, 61), 0), 101: 100}
    assert simhash.components(edges.limit(0)).collect() == []


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 5000):
        a, b = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, n).astype(np.uint64)
        a[: n // 2] = 7  # equal halves still differ in the other one
        mph = perfect_hash.PerfectHash.build(a, b)
        assert sorted(mph.lookup(a, b).tolist()) == list(range(n))
        assert (mph.lookup(b, a) < max(n, 1)).all()
    with pytest.raises(ValueError, match="distinct"):
        perfect_hash.PerfectHash.build(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def test_crowded_shards_are_copied(spark, monkeypatch):
    monkeypatch.setattr(perfect_hash, "LEAST_LOOKUPS_PER_TASK", 3)
    monkeypatch.setattr(line_dedup, "shard_count", lambda keys, lookups: 40)
    rows = [(i, f"the very same line\nown line {i // 2} of two") for i in range(300)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows)).collect()}
    assert got == {i: t for (i, _), t in zip(rows, brute.kept_lines(rows), strict=True)}


def test_spans_and_masks(spark):
    rows = [
        (1, "write me at a@b.co, or 4111 1111-1111 1111!"),
        (2, "x@y.z_d@e.f %+-@a-b.c-d. a@b a@.b @c.d"),
        (3, "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 001.002.003.0004 01234.1.1.1"),
        (4, "+1 (234) 555-0100 +12 +1 2 3 4 5 6 7 8 9 ( +123456789012345678"),
        (5, None),
        (6, ""),
        (7, "9" * 20_000 + " " + "a" * 50_000 + "@b.c " + "1.1.1." * 5_000 + "x@y.z " * 800),
        (8, "+1.2.3.44 5105105105105100 tail"),
        (8, "+1.2.3.44 5105105105105100 tail"),
        (None, "é é a@b.co é"),
        (9, "é😀 10.0.0.1\n😀 b@c.de"),
    ]
    docs = table(spark, rows)
    marked, mine = pii.spans_per_row(docs)
    names = [k for k, _ in brute.KINDS]
    for r in marked.collect():
        got = [(names[s.place - 1], s.start, s.end) for s in r[mine] or [] if s.is_base]
        assert got == brute.base_spans(r.text), r.doc_id
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns
    want = [t if not t else brute.masked(t, brute.base_spans(t)) for _, t in rows]
    assert Counter((r.doc_id, r.text) for r in masked.collect()) == Counter((i, t) for (i, _), t in zip(rows, want, strict=True))
    assert pii.mask_pii(table(spark, [])).collect() == []


def test_patterns_find_unseen_identifiers(spark):
    known = [(i, f"for orders Mail me: user{i}@shop.example thanks") for i in range(8)]
    unseen = [(20, "please mail me: joe77(at)site99 soon"), (21, "part number 1234567 of the machine"), (22, "mail me: nothing here")]
    rows = [*known, *unseen, *((30 + i, f"invoice total AB{i}99887 was paid") for i in range(9))]
    found = pii.find_pii(table(spark, rows)).where("NOT is_base").collect()
    assert [(r.kind, r.start, r.end) for r in found] == [("email", 16, 31)]


def plain_patterns(rows):
    """Added spans by loops: patterns around the finds of each text, scored in three rounds."""
    word, blank = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"

    def contexts(front, label, behind):
        words = re.split(f"{blank}+", front + label)
        label, one, two = (words[-i] if len(words) >= i else "" for i in (1, 2, 3))
        if re.search("[A-Za-z]", label):
            return {"label:" + brute.lower(label)}
        if len(label) > 2 or not one:
            return set()
        out = {"one:" + brute.lower(one)}
        out |= {"two:" + brute.lower(f"{two} {one}")} if two else set()
        return out | ({"around:" + brute.lower(f"{one} {behind}")} if behind else set())

    def behind(text, end):
        found = re.match(f"{word}{{0,2}}{blank}+({word}+)", text[end:])
        return found.group(1) if found else ""

    def fronted(text, starts, i):
        """What stands in front of find ``i``, with the find before replaced by its kind."""
        (start, _, kind) = starts[i]
        return (f"[{kind}]" if i else "") + text[starts[i - 1][1] if i else 0 : start]

    seeds, tokens = [], []
    for doc, text in rows:
        text = text or ""
        base = brute.base_spans(text)
        for kind, pattern in brute.KINDS:
            found = [(m.start(), m.end(), kind) for m in re.finditer(pattern, text)]
            for i, (s, e, _) in enumerate(found):
                if (kind, s, e) in base:
                    seeds.append((kind, brute.lower(text[s:e]), contexts(fronted(text, found, i), "", behind(text, e))))
        found = [(m.start(), m.end(), "token") for m in re.finditer(rf"(?<!{word}){word}*?[0-9]{word}*", text)]
        for i, (s, e, _) in enumerate(found):
            lead = re.match(r"[^A-Za-z0-9]*(?:[A-Za-z][A-Za-z_-]*[:=][^A-Za-z0-9]*)?", text[s:e]).group()
            core = re.match("[A-Za-z0-9](?:.*[A-Za-z0-9])?", text[s + len(lead) : e])
            if core and len(re.sub("[^A-Za-z0-9]", "", core.group())) >= pii.LEAST_ALNUM:
                a, z = s + len(lead), s + len(lead) + len(core.group())
                if all(z <= b or y <= a for _, b, y in base):
                    tokens.append((doc, a, z, brute.lower(core.group()), contexts(fronted(text, found, i), lead, behind(text, e))))
    of = {}
    for instance, cs in [(x, c) for _, x, c in seeds] + [(x, c) for *_, x, c in tokens]:
        for c in cs:
            of.setdefault(c, set()).add(instance)
    first = {(x, k): 1.0 for k, x, _ in seeds}
    known, good = dict(first), {}
    seed_at = {(c, x) for _, x, cs in seeds for c in cs}
    for _ in range(pii.ROUNDS):
        good = {}
        for c, instances in of.items():
            for kind, _ in brute.KINDS:
                support = round(sum(known.get((x, kind), 0) for x in instances), 6)
                least, score = (8, 0.9) if c.startswith("one:") else (3, 0.8)
                if support >= least and support / len(instances) >= score:
                    good[c, kind] = support / len(instances)
        known = dict(first)
        doubt = {}
        for (c, kind), score in good.items():
            for x in of[c]:
                if (c, x) not in seed_at:
                    doubt[x, kind] = doubt.get((x, kind), 1.0) * (1 - min(score, 0.999))
        for at, d in doubt.items():
            known[at] = max(known.get(at, 0), round(1 - d, 6))
    best = {}
    for (c, kind), score in good.items():
        best[c] = max(best.get(c, (0, "")), (score, kind))
    out = set()
    for doc, a, z, _, cs in tokens:
        kinds = [best[c] for c in cs if c in best]
        if kinds:
            out.add((doc, max(kinds)[1], a, z))
    return out


def test_patterns_against_loops(spark, sf_dir):
    """Spans added to a whole table, among them identifiers behind labels, single words and words on both sides."""
    rng = random.Random(12)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    text = [t for _, t in docs if t and len(t) < 3000]

    def planted(make, n):
        return [(rng.choice(text)[:200] + " " + make(i) + " " + rng.choice(text)[:100]) for i in range(n)]

    more = planted(lambda i: f"email:user{i}@shop.example", 6) + planted(lambda i: "email:joe77(at)site99", 1)
    more += planted(lambda i: f"{rng.choice(['call', 'or', 'ring'])}{i} telephone +49 30 12345{i:03d}", 30) + planted(lambda i: "x9 telephone 0049-30-998877", 1)
    more += planted(lambda i: f"a{i} host 10.0.{i}.7 answered", 5) + planted(lambda i: "b host 10-0-0-7x answered", 1)
    more += ["paid by card 4111111111111111", "Paid  by\ncard (4111 1111 1111 1111)", "z" * 5000 + " 12345678 " + "y" * 5000, "mail a@b.cc, a@b.cc a@b.cc 123456"]
    docs += [(10_000_000 + i, t) for i, t in enumerate(more)]
    got = pii.spans_per_row(table(spark, docs))[0]
    name = pii.spans_per_row(table(spark, docs))[1]
    spans = {
        (r.doc_id, pii.KINDS[s.place - 1], s.start, s.end) for r in got.select("doc_id", F.col(name).alias("s")).collect() for s in r.s or [] if not s.is_base
    }
    want = plain_patterns(docs)
    assert spans == want
    assert {k for _, k, *_ in want} >= {"email", "phone", "ip"}


def test_score_rounds(spark):
    """An instance found by one pattern supports the next one."""
    graph = [("a", f"i{n}", "email") for n in range(9)] + [("a", "new1", None), ("b", "i0", "email"), ("b", "i1", "email"), ("b", "i2", "email"), ("b", "new1", None)]
    df = spark.createDataFrame(graph, "context string, instance string, kind string")
    once = {r.context for r in pii.score_patterns(df, 1).collect()}
    twice = {(r.context, r.kind) for r in pii.score_patterns(df, 2).collect()}
    assert once == {"a"} and twice == {("a", "email"), ("b", "email")}


def test_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("host.org", "", "block")]
    urls = [
        None, "", "no scheme example.com/en/", "http://EXAMPLE.com/en/x", "https://a.www.example.com/en/?q#f", "http://example.com", "http://example.com?x=/en/",
        "http://x.net/es/1", "http://x.net/es", "x://net/es/", "http://notexample.com/en/", "http://host.org#f", "http://sub.host.org/any", "http://ÄB.com/", "http:///en/", "a://b://c.com/",
        "http://example.com./en/", "http://" + "a." * 3000 + "com/" + "p/" * 3000,
    ]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)] + [(3, urls[3], 1, 2)], "page_id long, url string, entry int, host int")
    df = spark.createDataFrame(rules, "host string, path string, verdict string")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = brute.lower(rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")

    got = url_filter.judge_urls(pages, df)
    assert got.columns == ["page_id", "url", "entry", "host", "path", "rule", "verdict"]
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == Counter(
        [(i, *judge(u)) for i, u in enumerate(urls)] + [(3, *judge(urls[3]))]
    )
    assert {r.verdict for r in url_filter.judge_urls(pages, df.limit(0)).collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), df).collect() == []


@pytest.mark.parametrize("most", [10**6, 0])
def test_url_list_of_many_entries(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", most)
    listed = spark.range(2000).select(F.format_string("h%d.org", "id").alias("host"), F.format_string("/p%d/", F.col("id") % 7).alias("path"), F.lit("block").alias("verdict"))
    pages = spark.range(6000).select("id", F.format_string("http://www.h%d.org/p%d/x", F.col("id") % 4000, F.col("id") % 7).alias("url"))
    blocked = {r.id for r in url_filter.judge_urls(pages, listed).where("verdict = 'block'").collect()}
    assert blocked == {i for i in range(6000) if i % 4000 < 2000 and i % 7 == i % 4000 % 7}
    entries = listed.select(F.concat("host", "path").alias("entry"))
    others = spark.range(5000).select(F.format_string("other%d.org/", "id").alias("entry"))
    assert url_filter.possible_hits(entries, entries).count() == 2000
    assert url_filter.possible_hits(others, entries).count() < 250


def brute_top(rows, queries, k=10):
    """By row: one that repeats an id is a candidate and a query of its own."""
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    vectors = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in usable]
    out = []
    for at, (q, own) in enumerate(vectors):
        if q in queries:
            scores = sorted((-sum(x * y for x, y in zip(own, v, strict=False)), i) for other, (i, v) in enumerate(vectors) if other != at)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def test_vectors(spark):
    rng = np.random.default_rng(2)
    same = rng.normal(size=6).tolist()
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)] + [(i, same) for i in range(300, 420)]
    rows += [(100, [2.0] * 6), (150, same), (500, None), (501, [1.0, None]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (504, []), (505, [1.0, 2.0]), (None, same), (506, [1e9] * 6), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, v int, block int")
    got = vector_search.top_k(df, F.col("vec_id") % 50 == 0)
    queries = range(0, 520, 50)
    assert sorted(map(tuple, got.collect())) == sorted(brute_top(rows, queries))
    few = vector_search.top_k(df.where("vec_id IN (1, 2, 3)"), F.col("vec_id") == 3).collect()
    assert sorted(map(tuple, few)) == sorted(brute_top([r for r in rows if r[0] in (1, 2, 3)], [3]))
    assert vector_search.top_k(df.limit(0), F.col("vec_id") == 3).collect() == []


def test_vectors_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "QUERIES_PER_GROUP", 7)
    monkeypatch.setattr(vector_search, "ROWS_PER_BLOCK", 20)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_search.top_k(df, F.col("vec_id") % 4 == 0, k=3)
    assert sorted(map(tuple, got.collect())) == sorted(brute_top(rows, range(0, 200, 4), 3))


def one_by_one(lengths, sizes, costs, rest):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if b[0] - b[1] >= n]
        if fit:
            best = min(fit, key=lambda b: (b[0] - b[1], -b[0]))
        else:
            best = [packing._cheapest_size(n, sizes, costs, rest), 0]
            bins.append(best)
        best[1] += n
    return sorted((min(s for s in sizes if s >= used), used) for _, used in bins)


def test_plans_place_pieces_one_by_one():
    rng = random.Random(6)
    sizes = (8, 16, 32, 64)
    for _ in range(60):
        costs = {s: s + rng.choice([0, 3, 9]) for s in sizes}
        lengths = [rng.choice([rng.randint(1, 64), rng.randint(1, 12), 5]) for _ in range(rng.randint(1, 150))]
        for rest in packing.REST_FILLED:
            bins = packing._pack(Counter(lengths), sizes, costs, rest)
            assert sorted((b.size, b.size - b.room) for b in bins for _ in range(b.number)) == one_by_one(lengths, sizes, costs, rest)
        cheapest = min(sum(costs[s] for s, _ in one_by_one(lengths, sizes, costs, r)) for r in packing.REST_FILLED)
        assert sum(b.number * costs[b.size] for b in packing.plan_bins(Counter(lengths), sizes, costs)) == cheapest


def test_packed_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 3)
    rows = [(i, n) for i, n in enumerate([5, 5, 5, 5, 5, 5, 5, 3, 40, 16, 0, 2, 33])] + [(None, 4), (99, None), (0, 5)]
    df = spark.createDataFrame([(i, n, 1) for i, n in rows], "doc_id long, n long, piece int")
    got = packing.pack(df, F.col("n"), sizes=(4, 8, 16)).collect()
    assert sum(r.n_tokens for r in got) == sum(n or 0 for _, n in rows)
    assert Counter(r.doc_id for r in got) == Counter(i for i, n in rows for _ in range(max(1, -(-(n or 0) // 16))))
    for _, group in itertools.groupby(sorted((r for r in got if r.bin_id is not None), key=lambda r: (r.bin_id, r.bin_offset)), key=lambda r: r.bin_id):
        group = list(group)
        ends = list(itertools.accumulate(r.n_tokens for r in group))
        assert [r.bin_offset for r in group] == [0, *ends[:-1]] and ends[-1] <= group[0].bin_size and len({r.bin_size for r in group}) == 1
    assert sum(r.bin_id is None for r in got) == 2
    assert packing.pack(df.limit(0), F.col("n")).collect() == []


def labelled(spark, sf_dir):
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return read("documents"), read("labels")


def test_quality_scores(spark, sf_dir):
    docs, labels = labelled(spark, sf_dir)
    odd = labels.union(spark.createDataFrame([(None, 1, 0), (10**9, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int"))
    model = quality.fit_quality(docs, odd)
    rows = spark.createDataFrame([(None,), ("",), (" ",), ("same text",), ("same text",), ("word " * 200_000,)], "text string")
    scores = [r.s for r in rows.select(quality.quality_score(F.col("text"), model).alias("s")).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[2] and scores[3] == scores[4]
    again = quality.fit_quality(docs.repartition(5), odd)
    assert (again[0] == model[0]).all() and (again[1].w1 == model[1].w1).all()
    none = quality.fit_quality(docs, labels.limit(0))
    assert {r.s for r in rows.select(quality.quality_score(F.col("text"), none).alias("s")).collect()} == {0.5}
    assert quality.keep_good(table(spark, []), labels).collect() == []


def test_chain(spark, sf_dir):
    docs, labels = labelled(spark, sf_dir)
    extra = docs.withColumn("chain_probabilities", F.lit(1)).withColumn("p_toxic", F.lit("old"))
    judged = toxicity.judge_toxicity(extra, labels, ["toxic"])
    assert set(judged.columns) == {*extra.columns} and dict(judged.dtypes)["p_toxic"] == "double"
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "x" * 300_000)], "doc_id long, text string")
    assert {r.p_toxic for r in toxicity.judge_toxicity(odd, labels.limit(0), ["toxic"]).collect()} == {0.5}
    assert toxicity.judge_toxicity(docs.limit(0), labels, ["toxic"]).collect() == []


def test_chain_uses_earlier_categories():
    """The second category is the first one's opposite; features say nothing about it but through the first."""
    rng = np.random.default_rng(1)
    first = rng.integers(0, 2, 600)
    rows = [np.array(sorted({int(rng.integers(10, 60)), 1 if f else 2})) for f in first]
    labels = np.stack([first, 1 - first], axis=1)
    chain = toxicity.train_chain(rows, labels, ["one", "two"], [np.array([1]), np.array([10])])
    assert chain.links[1].earlier[0] != 0 and len(chain.links[0].earlier) == 0
    chain.links[1].weights.clear()
    chain = toxicity.Chain(chain.categories, chain.links)
    chain._cache = {"yes": (1,), "no": (2,)}
    chain._table.setdefault(1, (0.0, 0.0)), chain._table.setdefault(2, (0.0, 0.0))
    p = chain.predict(["yes", "no"])
    assert p[0, 0] > 0.5 > p[1, 0] and p[0, 1] < p[1, 1]


def test_pipeline_stages(spark, sf_dir):
    """Each stage against brute force over what the one before it kept."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "pii", "packing"] and corpus_pipeline.ORACLE_SQL is None
    docs, labels = labelled(spark, sf_dir)
    docs, columns, kept = docs, docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, sf_dir).cache()
        kept[name] = {r.doc_id: r.text for r in docs.collect()} if name != "packing" else None
        assert name == "packing" or docs.columns == columns
        if name == "quality":
            bad = {r.doc_id for r in labels.where("quality = 0").collect()}
            good = {r.doc_id for r in labels.where("quality = 1").collect()}
            assert kept[name].items() <= before.items() and len(bad & set(kept[name])) <= 3 and len(good - set(kept[name])) <= 1
        elif name == "line_dedup":
            rows = list(before.items())
            assert kept[name] == {i: t for (i, _), t in zip(rows, brute.kept_lines(rows), strict=True)}
        elif name == "near_dedup":
            groups, _ = groups_of(before)
            assert kept[name] == {i: t for i, t in before.items() if groups[i] == i}
        elif name == "pii":
            assert kept[name] == {i: brute.masked(t, brute.base_spans(t)) for i, t in before.items()}
        else:
            assert {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == {i: len(t.split()) for i, t in before.items()}


def test_pipeline_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset"]


def test_equal_lookups_are_dealt_over_copies(spark, monkeypatch):
    """One document of very many equal lines, one text in very many rows: no task gets more lookups than stated."""
    monkeypatch.setattr(perfect_hash, "LEAST_LOOKUPS_PER_TASK", 200)
    real, largest = perfect_hash.probe_shards, []

    def watched(index, lookups, n, answer, schema, deal=None):
        sizes = real(index, lookups, n, lambda shard, rows: pa.table({"n": [rows.num_rows]}), "n long", deal)
        largest.append(max((r.n for r in sizes.collect()), default=0))
        return real(index, lookups, n, answer, schema, deal)

    monkeypatch.setattr(line_dedup, "probe_shards", watched)
    monkeypatch.setattr(exact_dedup, "probe_shards", watched)
    line = "the same line again"
    docs = spark.createDataFrame([(1, "\n".join([line] * 20_000)), (2, line + "\nmine alone here")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {1: docs.first().text, 2: "mine alone here"}
    assert 0 < max(largest) <= 200
    rows = [(None, "")] * 3000 + [(5, "x y")] * 3000 + [(5, "x  y")] * 2 + [(i, f"text {i}") for i in range(10, 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    groups = exact_dedup.exact_groups(table.where("coalesce(doc_id, 0) % 2 = 0"), table.where("doc_id % 2 = 1")).collect()
    assert 0 < max(largest) <= 1.5 * max(200, 4 * len(rows) // 32)
    assert Counter(r.id for r in groups if r.kept) == Counter({i: 1 for i in (None, 5, *range(10, 60))})
    assert {(r.keep_id, r.group_size) for r in groups if r.id == 5} == {(5, 3002)}


@pytest.mark.parametrize("at", range(0, 3000, 500))
def test_a_text_without_white_space_counts_as_a_whole(at):
    """A change anywhere in one very long stretch changes what the classifiers see."""
    text = "".join(random.Random(3).choice("abcXYZ019-.") for _ in range(3000))
    other = text[:at] + "éq#" + text[at + 3 :]
    assert set(toxicity.text_features(text)) != set(toxicity.text_features(other))
    assert not np.array_equal(quality._bag(text)[0], quality._bag(other)[0])
    assert tokens.words("a " + "b" * 100) == ["a", "b" * 48, "b" * 48, "b" * 4]
