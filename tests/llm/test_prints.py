"""Fingerprints, near-duplicates, top-k, URL filter, components: brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm import common, fingerprints, simhash_dedup, topk, urlfilter


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute_components(edges):
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {x: find(parent, x) for x in parent}


@pytest.mark.parametrize("n,edges,seed", [(50, 40, 1), (200, 150, 2), (30, 200, 3)])
def test_components_equal_union_find(spark, n, edges, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(edges)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(50)]
    df = spark.createDataFrame([*pairs, (None, 3), (4, None), (7, 7)], "src long, dst long")
    got = {r["node"]: r["component"] for r in common.connected_components(df).collect()}
    assert got == brute_components([p for p in pairs if p[0] != p[1]])


def test_components_of_no_edges(spark):
    assert common.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def brute_print(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_brute_force(documents, rows):
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_dedup.near_duplicates(documents).collect())
    prints = [(i, brute_print(t)) for i, t in rows]
    values = sorted({f for _, f in prints})
    edges = [(a, a) for a in values] + [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3]
    group = brute_components(edges)
    least = {}
    for i, f in prints:
        least[group[f]] = min(i, least.get(group[f], i))
    assert got == Counter((i, f"{f:016x}", least[group[f]]) for i, f in prints)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def close_prints(seed):
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(300)}
    for f in list(out)[:60]:
        for flips in (1, 2, 3, 3, 4):
            out.add(f ^ sum(1 << b for b in rng.sample(range(64), flips)))
        out.add(f ^ (7 << rng.randrange(61)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_and_block_tables_lose_no_pair(spark, seed):
    values = close_prints(seed)
    want = {(a, b) for a in values for b in values if (a ^ b).bit_count() <= 3}
    df = spark.createDataFrame([(signed(v),) for v in values], "f long")
    mask = (1 << 64) - 1
    got = {(r["a"] & mask, r["b"] & mask) for r in simhash_dedup.links(df).collect()}
    assert got | {(b, a) for a, b in got} == {p for p in want if p[0] != p[1]}
    named = df.withColumnRenamed("f", "fingerprint")
    pairs = [(r["query"] & mask, r["found"] & mask) for r in fingerprints.near(named, named).collect()]
    assert Counter(pairs) == Counter(dict.fromkeys(want, 1))


def test_keep_one_keeps_columns_and_one_of_each(documents, rows):
    kept = simhash_dedup.keep_one(documents)
    assert kept.columns == documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 10_009 in ids and 10_010 not in ids


def test_empty_tables(spark, no_documents):
    assert simhash_dedup.near_duplicates(no_documents).count() == 0
    assert fingerprints.fingerprint_documents(no_documents).count() == 0


def brute_terms(text):
    terms = {t for t in re.split(r"[\x20\x09-\x0D]+", text.lower()) if t}
    votes, total = [0] * 64, 0
    for t in terms:
        w = min(15, max(1, len(t) - 2))
        total += w
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        for b in range(64):
            votes[b] += w * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


@pytest.mark.parametrize("range_bytes", [2 << 20, 300])
def test_fingerprints_and_edits_equal_brute_force(spark, documents, rows, range_bytes, monkeypatch):
    monkeypatch.setattr(fingerprints, "COARSE", 4)
    plain = [(i, t) for i, t in rows if "İ" not in t]
    df = spark.createDataFrame(plain, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(fingerprints.with_next, "__kwdefaults__", {"range_bytes": range_bytes})
    got = Counter(tuple(r) for r in fingerprints.fingerprint_documents(df).collect())
    own = [brute_terms(t) for _, t in plain]
    order = sorted(plain, key=lambda r: (r[0], zlib.crc32(r[1].encode()), r[1].encode()), reverse=True)
    want = Counter()
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = brute_terms(t), brute_terms(edited), brute_terms(after)
        like = lambda x, y: 1 - (x ^ y).bit_count() / 64
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}", like(a, b), like(a, c), sum((a ^ x).bit_count() <= 3 for x in own) - 1 if i % 20 == 0 else None)] += 1
    assert got == want


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 32)
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "GROUP", 2)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(260, 12)) * (rng.random((260, 12)) < 0.5)
    x[40] = x[41] = x[42]
    vectors = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(1000, None), (1050, [None, 1.0]), (1100, [float("nan")] * 12), (1150, [float("inf")] * 12), (None, [1.0] * 12), (1200, [0.5, -0.25]), (1250, [])]
    df = spark.createDataFrame([*vectors, *odd], "vec_id long, embedding array<double>").withColumns({"ids": F.lit(1), "rank": F.lit(2)}).repartition(4)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect()}
    held = [*vectors, (1200, [0.5, -0.25] + [0] * 10), (1250, [0] * 12)]
    e = {i: np.floor(256 * np.array(v)).astype(int) for i, v in held}
    want = {}
    for q in e:
        if q % 50 == 0:
            ranked = sorted((-int(e[q] @ e[c]), c) for c in e if c != q)[:5]
            want |= {(q, n + 1): (c, -s) for n, (s, c) in enumerate(ranked)}
    assert got == want


def test_top_k_of_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (50, [1.0])], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 50), (0, 2, 1), (50, 1, 0), (50, 2, 1)]
    none = df.where("false")
    assert topk.top_k(none, none).count() == 0 and topk.top_k(df, none).count() == 0


PAGES = [
    (1, "http://A.Example.NET/en/x?q#f", ""), (2, "http://a.example.net/fr/", ""), (3, "http://example.com/de/1", ""), (4, "http://sub.example.com/de", ""),
    (5, "http://x.org/fr/1", ""), (6, "http://notorg/fr/1", ""), (7, None, ""), (8, "no scheme", ""), (9, "http://net?x", ""), (10, "http://net/", None),
    (11, "http://clean.example.com/a", "<LINK href='http://example.com/de/other' rel=canonical>"),
    (12, "http://alias.example.com/b", '<meta http-equiv="refresh" content="0; url=http://clean.example.com/a">'),
    (13, "http://mixed.example.com/c", '<link rel="canonical" href="http://bad.net/q"><meta content="1;URL=http://x.org/fr/9" http-equiv=refresh>'),
    (14, "http://lone.example.com/d", '<link rel="canonical" href="/d2">'), (14, "http://lone.example.com/d", '<link rel="canonical" href="/d2">'),
]


def test_url_filter_cases(spark):
    df = spark.createDataFrame(PAGES, "page_id int, url string, html string").withColumns({"host": F.lit("own"), "verdict": F.lit("own"), "node": F.lit(1)})
    got = [tuple(r) for r in urlfilter.judge(df).collect()]
    assert sorted((g[0], g[1], g[2], g[3] or "", g[4]) for g in got) == [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "a.example.net", "/fr/", "net/", "block"),
        (3, "example.com", "/de/1", "example.com/de/", "block"),
        (4, "sub.example.com", "/de", "", "allow"),
        (5, "x.org", "/fr/1", "org/fr/", "allow"),
        (6, "notorg", "/fr/1", "", "allow"),
        (7, "", "", "", "allow"),
        (8, "", "", "", "allow"),
        (9, "net", "", "", "allow"),
        (10, "net", "/", "net/", "block"),
        (11, "clean.example.com", "/a", "", "block"),
        (12, "alias.example.com", "/b", "", "block"),
        (13, "mixed.example.com", "/c", "", "allow"),
        (14, "lone.example.com", "/d", "", "allow"),
        (14, "lone.example.com", "/d", "", "allow"),
    ]


def test_url_filter_redirect_table_and_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/")], "page_id int, url string")
    hops = spark.createDataFrame([("http://a.example.com/", "http://b.x/"), ("http://b.x/", "http://c.net/"), (None, "http://c.net/")], "url string, target string")
    assert urlfilter.judge(pages, redirects=hops).first()["verdict"] == "block"
    assert urlfilter.judge(pages).first()["verdict"] == "allow"
    assert urlfilter.judge(pages.where("false"), redirects=hops.where("false")).count() == 0
