"""Importance resampling, exact top-k and lexical search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablegate.llm import importance, knn, lexical
from tablegate.llm.crc import joined, span_crcs
from tests.llm.tables import awkward_rows, edited, prose, with_extras

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def test_crcs_of_spans_and_of_what_they_make():
    draw = random.Random(1)
    parts = [draw.randbytes(draw.choice([0, 1, 3, 5, 9, 20, 63, 64, 65, 300])) for _ in range(500)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    crcs = span_crcs(data, starts, ends)
    assert crcs.tolist() == [zlib.crc32(p) for p in parts]
    assert joined(crcs[:-1], crcs[1:], (ends - starts)[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


# --- importance resampling


def grams(text):
    w = words(text)
    return [" ".join(w[i : i + k]) for i in range(len(w)) for k in (1, 2, 3) if i + k <= len(w)]


def resampled(docs, target, percent=5, least=20, seed=42):
    """Every document's digest, straight from the definition; rows that share an id stay apart."""
    buckets = lambda text: [zlib.crc32(g.encode()) % 10000 for g in grams(text)]
    own = [buckets(t) for _, t in docs]
    s, t = Counter(b for x in own for b in x), Counter(b for x in target for b in buckets(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    rows = []
    for (i, text), x in zip(docs, own):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x))
        rows.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    taking = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(taking[: percent * len(taking) // 100], 1):
        r[4] = rank
    return sorted(map(str, (tuple(r[:5]) for r in rows)))


def got_rows(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


RESAMPLED = ("doc_id", "n_features", "weight", "score", "rank")


def test_resampling_of_awkward_texts(spark):
    line = "One line that very many documents share."
    rows = [(i, t) for i, t in awkward_rows()] + [(1000 + k, f"{prose(k, 9)}\n{line}\nx\n\n{'y' * (k % 90)} z\n{line}\r\n{prose(k, 3)}\tend") for k in range(300)]
    rows += [(2000, "\n".join("abcd")), (2001, "a\n \n b\n\nc " + "ö" * 70), (2002, line), (2003, f"\n{line.upper()}\n")]
    target = [prose(3, 40), None, "", line, "a b c"]
    docs = with_extras(spark, rows).repartition(5)
    found = importance.resampled(docs, with_extras(spark, [(k, t) for k, t in enumerate(target)], "item_id long, text string"))
    want = resampled(rows, target)
    assert got_rows(found, *RESAMPLED) == want and sum("None" not in w for w in want) > 10


def test_lines_hot_and_cold_count_alike(spark, monkeypatch):
    rows = [(k, "\n".join([prose(k, 25), "the same", f"line {k % 3}"])) for k in range(60)]
    docs, target = with_extras(spark, rows), with_extras(spark, [(1, prose(3, 30))], "item_id long, text string")
    want = resampled(rows, [prose(3, 30)], percent=50)
    for share in (1, 50, 10**9):
        monkeypatch.setattr(importance, "HOT_SHARE", share)
        assert got_rows(importance.resampled(docs, target, percent=50), *RESAMPLED) == want


def test_distinct_lines_are_looked_at_once(spark):
    rows = [(k, "a b c\nd e\n" + "a b c\n" * k) for k in range(5)]
    lines = importance.distinct_lines(with_extras(spark, rows))
    assert sorted((r.occurrences, len(r.features) // 2) for r in lines.collect()) == [(5, 3), (15, 6)]


def test_resampling_of_nothing(spark):
    docs, target = with_extras(spark, [(1, "a b")]), with_extras(spark, [], "item_id long, text string")
    assert importance.resampled(docs.limit(0), target).count() == 0
    assert got_rows(importance.resampled(docs, target), *RESAMPLED) == resampled([(1, "a b")], [])


# --- exact top-k


def nearest(rows, k, asks):
    """(query_id, rank, vec_id, score) by comparing every pair in exact integers."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in good]
    out = []
    for at, (i, q) in enumerate(whole):
        if i is None or not asks(i):
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for other, (j, v) in enumerate(whole) if other != at]
        out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(map(str, out))


def vectors(seed, n, dims, clusters):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, dims))
    return [(k, (centres[k % clusters] + 0.1 * draw.normal(size=dims)).astype(np.float32).tolist()) for k in range(n)]


@pytest.mark.parametrize("pivots,block_bytes", [(128, 1 << 22), (8, 3000), (1, 1 << 22), (30, 100)])
def test_top_k_is_all_pairs(spark, pivots, block_bytes):
    rows = vectors(1, 300, 6, 12) + [(700, [0.0] * 6), (None, [1.0] * 6), (750, None), (751, [1.0, None, 0.0]), (760, [float("nan")] * 6)]
    rows += [(800, [float("inf")] * 6), (801, []), (802, [0.5] * 9), (50, [0.25] * 6), (None, [0.25] * 6)]
    rows += [(900 + k, [0.75, -0.5, 0.25, 0.0, 0.0, 1.0]) for k in range(120)]
    df = with_extras(spark, rows, "vec_id long, embedding array<float>").repartition(4)
    found = knn.top_k(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0, 5, pivots=pivots, block_bytes=block_bytes)
    assert got_rows(found, "query_id", "rank", "vec_id", "score") == nearest(rows, 5, lambda i: i % 10 == 0)


def test_few_rows_are_sent_where_cells_are_tight(spark, monkeypatch):
    rows = vectors(2, 2000, 4, 40)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    sent, real = spark.sparkContext.accumulator(0), knn.mix

    def counted(rows_):
        sent.add(len(rows_))
        return real(rows_)

    monkeypatch.setattr(knn, "mix", counted)  # of every row sent, to find its block
    found = knn.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5, block_bytes=10 * 8 * 4)
    assert got_rows(found, "query_id", "rank", "vec_id", "score") == nearest(rows, 5, lambda i: i % 50 == 0)
    assert 0 < sent.value < 0.5 * 4 * len(rows)  # four groups of queries


def test_products_are_exact_at_any_size():
    draw = np.random.default_rng(3)
    for bits in (8, 27, 31, 40):
        q, d = (draw.integers(-(1 << bits), 1 << bits, (4, 7)) for _ in range(2))
        want = [[max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(x, y)))) for y in d] for x in q]
        assert knn.products(q, d).tolist() == want


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0]), (None, [2.0])], "vec_id long, embedding array<float>")
    for part in (df, df.limit(0)):
        assert knn.top_k(part, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5).collect() == []
    alone = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert knn.top_k(alone, "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5).collect() == []


# --- lexical search


def searched(docs, items, k):
    texts = [(i, Counter(words(t))) for i, t in docs]
    texts = [(i, c, sum(c.values())) for i, c in texts if c]
    n_all, length = len(texts), sum(n for _, _, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_all + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c, n in texts:
            m = 100 - 50 + 50 * n * n_all // length
            score = sum(weight[t] * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(words(text)) if c[t])
            scored += [(-score, i is None, i or 0, i)] * (score > 0)
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("postings,block_docs,block_terms,k", [(1_000_000, 64, 200_000, 50), (300, 4, 40, 7), (2000, 3, 1, 1)])
def test_search_is_all_pairs(spark, postings, block_docs, block_terms, k):
    rows = awkward_rows() + [(1000 + i, edited(prose(i % 40, 30), i, 0.3)) for i in range(400)] + [(5000 + i, prose(3, 30)) for i in range(90)]
    items = [(1, prose(3, 30)), (2, prose(7, 12).upper()), (None, "one"), (3, None), (4, "..."), (5, "日本語 naïve"), (1, prose(900, 5)), (6, "nowhere-found")]
    docs = with_extras(spark, rows).repartition(3)
    found = lexical.search(docs, with_extras(spark, items, "item_id long, text string"), k, block_terms, postings, block_docs)
    assert got_rows(found, "item_id", "rank", "doc_id", "score") == searched(rows, items, k)


def test_blocks_are_skipped_by_their_summaries(monkeypatch):
    """Far fewer documents are scored than postings say, and none of the best is missed."""
    draw = np.random.default_rng(5)
    size, n = 400, 3000
    topic = np.repeat(np.arange(20), n // 20)
    own = [np.unique(np.concatenate([draw.integers(0, 40, 8), 40 + topic[d] * 18 + draw.integers(0, 18, 6)])) for d in range(n)]
    counts, term = np.array([len(x) for x in own]), np.concatenate(own)
    value = draw.integers(1, 100, len(term)) * np.where(term < 40, 1, 20)
    starts = np.concatenate([[0], np.cumsum(counts)])
    query = np.array([1, 2, 3, 45, 46, 50, 51])
    shard = lexical.Shard(np.arange(n), np.ones(n, bool), starts, term, value, {t: query for t in query.tolist()}, size)
    scored = 0

    class Watched(lexical.Best):
        def offer(self, scores, ids, known):
            nonlocal scored
            scored += len(ids)
            super().offer(scores, ids, known)

    best = Watched(10)
    shard.search(query, best)
    asked = np.isin(term, query)
    whole = np.add.reduceat(np.where(asked, value, 0), starts[:-1])
    want = np.lexsort((np.arange(n), -whole))[:10]
    assert best.ids.tolist() == want.tolist() and scored < 0.3 * (whole > 0).sum()
    with monkeypatch.context() as patched:  # nothing is remembered, all is made again
        patched.setattr(lexical, "SUMMARY_BYTES", -1)
        shard.made = {}
        shard.search(query, again := lexical.Best(10))
        assert again.ids.tolist() == want.tolist() and len(shard.made) == 1


def test_shards_hold_bounded_postings():
    told = lexical.Statistics(10, 100, np.full(50, 3, np.int64))
    sizes = [3, 0, 40, 2, 2, 30, 1]
    batch = lambda s: pa.RecordBatch.from_arrays(
        [pa.array(range(len(s))), pa.array([max(1, n) for n in s]), *[pa.array([np.arange(n, dtype="<i4").tobytes() for n in s], pa.binary())] * 2], ["doc_id", "n", "term", "tf"]
    )
    shards = list(lexical._shards(iter([batch(sizes), batch(sizes[:2])]), told, {}, postings=10))
    assert sum(len(s.doc_ids) for s in shards) == 9 and sum(len(s.term) for s in shards) == sum(sizes) + 3
    assert all(len(s.term) <= 10 or len(s.doc_ids) <= 2 for s in shards)


def test_search_of_nothing(spark):
    docs, items = with_extras(spark, [(1, "a"), (2, None)]), with_extras(spark, [(1, "a b")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert got_rows(lexical.search(docs, items), "item_id", "rank", "doc_id", "score") == searched([(1, "a"), (2, None)], [(1, "a b")], 50)
