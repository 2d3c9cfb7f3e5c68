"""Whole operators against plain versions: rows that repeat, huge values, hot ids,
trained models, aliases with hubs."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm import fingerprints, packing, quality, topk, toxicity, urlfilter, wordbpe

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# top-k


def best_of(rows, k=5):
    vectors = defaultdict(list)
    for i, v in rows:
        vectors[i].append(v)
    ints = lambda v: [math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v]
    out = []
    for q in sorted(vectors):
        if q % 50 == 0:
            asked = ints(min(vectors[q]))
            ranked = sorted((-sum(a * b for a, b in zip(asked, ints(v))), i) for i, v in rows if i != q)[:k]
            out += [(q, n + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, i) in enumerate(ranked)]
    return out


HUGE = [
    (0, [1.0, 0.0]), (1, [1e6, 0.0]), (2, [-1e6, 3.0]), (3, [1e15, 1.0]), (4, [1e15, 2.0]), (5, [-1e15, 0.5]), (6, [1e200, -1.0]), (7, [1e200, 1.0]),
    (8, [1.7e308, 0.0]), (50, [0.25, 1e16]), (100, [1e300, 1.0]), (150, [-1e300, 2.0]), (200, [float(1 << 40), -float(1 << 40)]),
]


@pytest.mark.parametrize("shard", [2, 8192])
def test_top_k_of_values_of_any_size(spark, shard, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", shard)
    df = spark.createDataFrame(HUGE, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect())
    assert got == best_of(HUGE)
    assert (0, 1, 8, (1 << 63) - 1) in got


def test_top_k_of_rows_that_repeat(spark):
    rows = [(7, [1.0, 2.0])] * 3 + [(50, [2.0, 0.0]), (50, [2.0, 0.0]), (50, [0.5, 1.0]), (8, [1.0, 2.0]), (8, [3.0, 0.0]), (100, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect())
    assert got == best_of(rows)
    c = duckdb.connect()
    c.sql("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    c.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    assert sorted(c.sql(topk.OP4_SQL).fetchall()) == [(q, r, i, s) for q, r, i, s in got]


# packing


def one_by_one(counts, capacity):
    """The reduction with every set fixed on its own."""
    left, fixed = Counter({k: n for k, n in counts.items() if n}), Counter()
    for big in sorted(left, reverse=True):
        while left[big]:
            room = capacity - big
            others = left.copy()
            others[big] -= 1
            items = sorted(x for x, n in others.items() if n and x <= room)
            pairs = [a + b for a in items for b in items if a <= b and a + b <= room and (a != b or others[a] > 1)]
            triples = sorted(others.elements())[:3]
            if not items:
                chosen = (big,)
            elif room in items:
                chosen = (big, room)
            elif pairs and (len(triples) == 3 and sum(triples) <= room or max(pairs) > items[-1]):
                break
            else:
                chosen = (big, items[-1])
            fixed[tuple(sorted(chosen))] += 1
            left.subtract(chosen)
    return fixed, +left


@pytest.mark.parametrize("seed", range(40))
def test_counts_are_fixed_as_single_items_would_be(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 60])
    counts = {rng.randint(1, capacity): rng.randint(1, 6) for _ in range(rng.randint(1, 7))}
    groups, left = packing.reduce_dominated(counts, capacity)
    fixed = Counter()
    for n, lengths in groups:
        fixed[tuple(sorted(lengths))] += n
    assert (fixed, Counter(left)) == one_by_one(counts, capacity)


@pytest.mark.parametrize("n", [2_000, 10**9])
def test_the_plan_does_not_grow_with_the_rows(n):
    began = time.time()
    groups = packing.plan({2038: n, 9: n, 4: n})
    assert len(groups) < 20 and time.time() - began < 0.5
    held = Counter()
    for times, lengths in groups:
        assert sum(lengths) <= 2048
        for x in lengths:
            held[x] += times
    assert held == {2038: n, 9: n, 4: n}


def test_packing_of_null_ids_and_clashing_columns(spark, word_path):
    rows = [(None, "a b c"), (None, "a b c"), (1, None), (None, None), (2, "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("sequence_id", "offset", "length", "piece")})
    got = packing.pack_documents(docs, word_path).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 3, 1: 1, 2: 3}
    used = defaultdict(list)
    for r in got:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


# encoder


def test_a_small_memory_changes_nothing(word_path, monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdeéß'3", k=rng.randint(1, 9))) for _ in range(200)) for _ in range(30)] + ["<|endoftext|> a <|endoftext|>"]
    library = Tokenizer.from_file(word_path)
    monkeypatch.setattr(wordbpe, "MAX_WORDS", 50)
    bpe = wordbpe.WordBpe(word_path)
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(bpe.packed([t])[0], np.uint32).tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(bpe.words) <= 50 + 250


def test_a_very_long_word_takes_time_in_proportion(word_path):
    bpe = wordbpe.WordBpe(word_path)
    bpe.packed(["warm up"])
    took = []
    for n in (50_000, 200_000):
        began = time.time()
        word = "".join(random.Random(n).choices("etaoinshr", k=n))
        bpe.packed([word])
        took.append(time.time() - began)
    assert took[1] < 8 * took[0] + 0.2


# fingerprints


def test_hot_and_null_ids_are_cut_into_ranges(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eps"], k=8))
    rows = [(None, text()) for _ in range(200)] + [(7, text()) for _ in range(200)] + [(i, text()) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(r[1].encode()), r[1].encode()), reverse=True)
    want = Counter((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    got = fingerprints.with_next(df)
    assert Counter((r["doc_id"], r["text"], r["_next"]) for r in got.collect()) == want
    ranges = fingerprints.in_ranges(df).groupBy("doc_id").agg(F.count_distinct("_range").alias("n")).collect()
    assert all(r["n"] > 20 for r in ranges if r["doc_id"] in (None, 7))


def test_letters_whose_lower_case_is_longer(spark):
    df = spark.createDataFrame([(1, "İstanbul SOKAK ΑΣ"), (2, "")], "doc_id long, text string")
    a = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_documents(df).collect()}
    b = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_documents(df.withColumn("text", F.lower("text"))).collect()}
    assert a == b and a[2] == "0" * 16


# trained models, on every row of the smallest tables


def tables(spark, folder=SMALL):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, [(r["doc_id"], r["text"] or "") for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]


def plain_statistics(text):
    raw = text.encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    n, size = max(1, len(words)), max(1, len(raw))
    share = lambda test: math.sqrt(sum(map(test, raw)) / size)
    chars = lambda s: lambda b: chr(b) in s and b < 128
    return [
        math.log1p(len(raw)), math.log1p(len(words)), size / n, len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        (len(set(zip(words, words[1:]))) + 1) / n, 1 - len(set(lines)) / max(1, len(lines)),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n, math.log1p(n / max(1, len(lines))),
        share(chars("!")), share(chars("|")), share(chars("$%&#*")), share(chars(".,;:?")), share(chars("0123456789")), share(chars("\n")),
        share(lambda b: 65 <= b <= 90), share(lambda b: b > 127), share(chars("<>{}[]=/\\@")),
    ]


def test_quality_equals_a_plain_version(spark):
    docs, labels, rows, marks = tables(spark)
    part = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in rows}
    stats = {i: plain_statistics(t) for i, t in rows}
    train = [(i, y) for i, y, _ in marks if i in stats and y is not None and part[i]]
    x = np.array([stats[i] for i, _ in train])
    y, parts = np.array([float(v) for _, v in train]), np.array([part[i] for i, _ in train])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale <= 1e-9] = 1
    rng = np.random.default_rng(7)
    w = rng.standard_normal((x.shape[1], quality.FEATURES)) / quality.BANDWIDTH
    b = rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def features(v):
        z = math.sqrt(2 / quality.FEATURES) * np.cos(np.clip((np.asarray(v) - mean) / scale, -8, 8) @ w + b)
        return np.column_stack([z, np.ones(len(z))])

    def ridge(z, y):
        pen = np.diag([quality.RIDGE] * quality.FEATURES + [1e-6])
        return np.linalg.lstsq(z.T @ z + pen, z.T @ y, rcond=None)[0]

    z = features(x)
    weights, raw = ridge(z, y), np.zeros(len(y))
    for p in range(1, 5):
        raw[parts == p] = z[parts == p] @ ridge(z[parts != p], y[parts != p])
    bins = defaultdict(list)
    for s, v in zip(raw, y):
        bins[int(min(max((s + 0.5) / 2 * quality.BINS, 0), quality.BINS - 1))].append((s, v))
    held = [bins[k] for k in sorted(bins)]
    n, level = [len(h) for h in held], [np.mean([v for _, v in h]) for h in held]
    top = lambda i, j: np.average(level[i : j + 1], weights=n[i : j + 1])
    height = [max(min(top(i, j) for j in range(k, len(n))) for i in range(k + 1)) for k in range(len(n))]
    knots = [np.mean([s for s, _ in h]) for h in held]
    got = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    for i, s in zip(stats, features(list(stats.values())) @ weights, strict=True):
        want = min(1, max(0, 0.99 * np.interp(s, knots, height) + 0.01 / (1 + math.exp(-4 * (s - 0.5)))))
        assert got[i]["score"] == pytest.approx(want, abs=1e-5), i
        assert got[i]["held_out"] == (part[i] == 0) and got[i]["predicted"] == int(got[i]["score"] >= 0.3)


def test_null_ids_count_as_held_out(spark):
    docs = spark.createDataFrame([(None, "some text"), (None, None), (1, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, 0)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [True, True] and all(0 <= r["score"] <= 1 for r in got)
    left = quality.keep_good(docs, labels).where("doc_id IS NULL").count()
    assert left == sum(r["predicted"] for r in got if r["doc_id"] is None)


def words_of(text):
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text.lower()).split(" ")


def plain_ordinal(rows, terms, grades, steps=toxicity.STEPS):
    """rows: (counts by term, grade, times). Adam on the penalised likelihood."""
    x = np.array([[math.log1p(c.get(t, 0)) for t in terms] for c, _, _ in rows])
    g, m = np.array([r[1] for r in rows]), np.array([float(r[2]) for r in rows])
    d, n = len(terms), m.sum()
    share = [min(max(m[g > k].sum() / n, 1e-3), 1 - 1e-3) for k in range(grades - 1)]
    cut0 = np.maximum.accumulate([math.log((1 - s) / s) for s in share])
    p = np.concatenate([np.zeros(d), cut0[:1], np.log(np.maximum(np.diff(cut0), 0.1))])
    a, b = np.zeros(len(p)), np.zeros(len(p))
    sig = lambda t: 1 / (1 + np.exp(-np.clip(t, -40, 40)))
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.concatenate([p[d : d + 1], np.exp(p[d + 1 :])]))
        s = x @ p[:d]
        upper = np.array([sig(cuts[k] - v) if k < grades - 1 else 1.0 for k, v in zip(g, s)])
        lower = np.array([sig(cuts[k - 1] - v) if k else 0.0 for k, v in zip(g, s)])
        like = np.maximum(upper - lower, 1e-12)
        up, low = m * upper * (1 - upper) / like, m * lower * (1 - lower) / like
        cut = np.array([low[g == k + 1].sum() - up[g == k].sum() for k in range(grades - 1)]) / n
        grad = np.concatenate([x.T @ (up - low) / n + toxicity.RIDGE * p[:d] / n, [cut.sum()], [cut[k + 1 :].sum() * math.exp(p[d + 1 + k]) for k in range(grades - 2)]])
        a, b = 0.9 * a + 0.1 * grad, 0.99 * b + 0.01 * grad**2
        p = p - 0.1 * min(1, 2 * (steps - step + 1) / steps) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    return p[:d], np.cumsum(np.concatenate([p[d : d + 1], np.exp(p[d + 1 :])]))


def test_toxicity_equals_a_plain_version(spark):
    docs, labels, rows, marks = tables(spark, LARGER)  # the smallest tables hold too few toxic rows for any term
    texts = dict(rows)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    name = {t: signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in texts.values()}
    known = {(texts[i], y) for i, _, y in marks if i in texts and y in (0, 1)}
    seen = {t: Counter(w for w in words_of(t) if w) for t, _ in known}
    n1, n0 = sum(y for _, y in known), sum(1 - y for _, y in known)
    share, picked = n1 / (n1 + n0), []
    for w in {w for c in seen.values() for w in c}:
        a, o = (sum(w in seen[t] for t, y in known if y == v) for v in (1, 0))
        if a >= 3 and a > (a + o) * share:
            dev = 2 * (a * math.log(a / ((a + o) * share)) + (o * math.log(o / ((a + o) * (1 - share))) if o else 0))
            if dev >= toxicity.DEVIANCE:
                picked.append((-dev, w.encode()))
    vocabulary = [w.decode() for _, w in sorted(picked)]
    assert vocabulary
    merged = Counter()
    for t, y in known:
        merged[y, name[t] % 2, tuple((w, seen[t][w]) for w in vocabulary if w in seen[t])] += 1
    data = [(dict(held), y, n, half) for (y, half, held), n in merged.items()]
    score = {}
    for own in (0, 1):
        w, _ = plain_ordinal([r[:3] for r in data if r[3] != own], vocabulary, 2)
        score |= {k: round(sum(math.log1p(r[0].get(t, 0)) * v for t, v in zip(vocabulary, w)), 9) for k, r in enumerate(data) if r[3] == own}
    toxic = [k for k, r in enumerate(data) if r[1]]
    total = sum(data[k][2] for k in toxic)
    grade = {k: 1 + math.floor(sum(data[o][2] for o in toxic if score[o] < score[k]) / total * 3) for k in toxic}
    w, cuts = plain_ordinal([(r[0], grade.get(k, 0), r[2]) for k, r in enumerate(data)], vocabulary, 4)
    assert len(set(grade.values())) == 3
    got = {r["doc_id"]: r for r in toxicity.severity(docs, labels).collect()}
    for i, t in rows:
        c = Counter(words_of(t))
        above = [1 / (1 + math.exp(k - sum(math.log1p(c[x]) * v for x, v in zip(vocabulary, w)))) for k in cuts]
        assert got[i]["severity"] == pytest.approx(sum(above), abs=0.02), i
        if abs(above[0] - toxicity.CUT) > 0.01:
            assert got[i]["toxic"] == int(above[0] >= toxicity.CUT)


# aliases


def site(rng):
    host = rng.choice(["a.test", "b.example.com", "example.com", "x.example.net", "c.net", "d.org", "e.test", "f.test"])
    return f"http://{host}/{rng.choice(['en', 'de', 'fr', 'it'])}/{rng.randrange(400)}"


@pytest.mark.parametrize("seed", [1, 2])
def test_thousands_of_aliases_with_hubs(spark, seed):
    rng = random.Random(seed)
    urls = [site(rng) for _ in range(3000)]
    hub = "http://hub.test/en/0"
    pages = []
    for i, u in enumerate(urls):
        to = rng.choice([None, site(rng), site(rng), hub if u.startswith("http://e.test") else site(rng)])
        tag = rng.choice(['<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'])
        pages.append((i, u, "<p>x</p>" if to is None or rng.random() < 0.55 else tag.format(to)))
    pages += [(5000 + i, f"http://e.test/chain/{i}", f'<link rel="canonical" href="/chain/{i + 1}">') for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def rule(u):
        host, _, path = u[7:].partition("/")
        fits = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and ("/" + path).startswith(r.path)]
        return max(fits, key=lambda r: len(r.name), default=None)

    for _, u, h in pages:
        if "http://" in h or "/chain/" in h:
            to = h.split('href="')[-1].split("url=")[-1].split('"')[0]
            parent[find(u)] = find("http://e.test" + to if to.startswith("/") else to)
    told = defaultdict(set)
    for x in list(parent):
        if rule(x):
            told[find(x)].add(rule(x).verdict)
    want = []
    for i, u, _ in pages:
        own, group = rule(u), told[find(u)]
        want.append((i, own.name if own else None, own.verdict if own else "allow" if "allow" in group or "block" not in group else "block"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(df).collect()]
    assert Counter((g[0], g[3], g[4]) for g in got) == Counter(want)
    assert sum(1 for _, r, v in want if r is None and v == "block") > 50
    if seed == 1:
        few = pages[:60] + pages[3000:3010]
        c = duckdb.connect()
        c.sql("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
        c.executemany("INSERT INTO pages VALUES (?, ?, ?)", [list(p) for p in few])
        small = Counter(tuple(r) for r in urlfilter.judge(spark.createDataFrame(few, "page_id long, url string, html string")).collect())
        assert Counter(c.sql(urlfilter.OP5_SQL).fetchall()) == small


def test_digest_names(spark):
    """sha256 columns are lower-case hex of UTF-8."""
    r = fingerprints.fingerprint_documents(spark.createDataFrame([(1, "é")], "doc_id long, text string")).first()
    assert r["edited_sha256"] == hashlib.sha256("é".encode()).hexdigest()
