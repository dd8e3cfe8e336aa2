import random
import re
from collections import defaultdict

import numpy as np
import pytest

from cabflow.llm import near_dedup
from cabflow.llm import queries as q
from tests.llm.helpers import SF, awkward, nothing, pairs
from tests.llm.test_text_operators import decon_words


def shingled(text):
    w = decon_words(text)
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, best[j] = best[j], last + 1 if x == y else max(best[j], best[j - 1])
    return best[-1]


def brute_classes(texts):
    """Class number of each text: links by similarity of all pairs that share a shingle, and equal texts."""
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    same, holders = {}, defaultdict(list)
    s = [shingled(t) for t in texts]
    for i, t in enumerate(texts):
        if t in same:
            parent[root(i)] = root(same[t])
        else:
            same[t] = i
            for x in set(s[i]):
                holders[x].append(i)
    for a, b in {(a, b) for own in holders.values() for a in own for b in own if a < b}:
        if min(len(s[a]), len(s[b])) * 10 >= 8 * max(len(s[a]), len(s[b])) and root(a) != root(b):
            if len(set(s[a]) & set(s[b])) * 2.5 >= min(len(set(s[a])), len(set(s[b]))):
                m = lcs(s[a], s[b])
                if 10 * m >= 8 * (len(s[a]) + len(s[b]) - m):
                    parent[root(a)] = root(b)
    return [root(i) for i in range(len(texts))]


def want(rows):
    low = lambda i: -(2**63) if i is None else i
    classes = brute_classes([t or "" for _, t in rows])
    by = defaultdict(list)
    for (i, _), c in zip(rows, classes, strict=True):
        by[c].append(low(i))
    return sorted((low(i), min(by[c]), len(by[c])) for (i, _), c in zip(rows, classes, strict=True))


def got(df):
    low = lambda i: -(2**63) if i is None else i
    return sorted((low(r.doc_id), low(r.class_id), r.class_size) for r in df.collect())


@pytest.mark.parametrize("seed", range(300))
def test_alignment_is_exact(seed):
    rnd = random.Random(seed)
    a = [rnd.randrange(6 + seed) for _ in range(rnd.randrange(1, 60))]
    b = list(a)
    for _ in range(rnd.randrange(0, 9)):
        at = rnd.randrange(len(b) + 1)
        b[at : at + rnd.randrange(2)] = [rnd.randrange(6 + seed) for _ in range(rnd.randrange(3))]
    m = lcs(a, b)
    near = bool(b) and 10 * m >= 8 * (len(a) + len(b) - m)
    assert near_dedup.aligned(np.array(a, np.uint64), np.array(b, np.uint64)) == near


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        at = rnd.randrange(len(w))
        w[at : at + rnd.randrange(2)] = [f"e{rnd.randrange(10**6)}"] * rnd.randrange(2)
    return w


def test_classes_against_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    rows = []
    line = [f"line{i}" for i in range(30)]  # a passage that many documents share
    for g in range(14):
        base = [f"g{g}w{rnd.randrange(500)}" for _ in range(rnd.choice([6, 40, 120, 300]))]
        for _ in range(rnd.choice([1, 4, 9])):
            w = edited(rnd, base, rnd.randrange(0, 1 + len(base) // 25))
            if rnd.random() < 0.4:
                at = rnd.randrange(len(w))
                w[at:at] = line
            rows.append(rnd.choice([" ", "\n", ", "]).join(w))
    rows += [" ".join(line + [f"s{i}", f"t{i}"]) for i in range(25)]  # near each other
    rows += [" ".join([f"u{i}{j}" for j in range(20)] + line + [f"v{i}{j}" for j in range(20)]) for i in range(25)]  # not near
    chain = [f"c{i}" for i in range(200)]
    for _ in range(12):  # each near the one before
        rows.append(" ".join(chain))
        chain = edited(rnd, chain, 2)
    docs = awkward(spark, [(100 + i, t) for i, t in enumerate(rows)])
    monkeypatch.setattr(near_dedup, "PIVOTS", (1, 2))
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    assert got(near_dedup.find_classes(docs)) == want(pairs(docs))
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    first = {c for _, c, _ in want(pairs(docs))}
    assert {-(2**63) if i is None else i for i, _ in pairs(kept)} == first
    assert near_dedup.find_classes(nothing(spark)).collect() == []


def test_short_pairs_are_all_found(spark):
    """Pairs at the threshold of 2 to 24 shingles: none may be missed, whatever the words."""
    rnd = random.Random(4)
    rows = []
    for g in range(700):
        n, more = [(8, 1), (9, 1), (12, 2), (16, 3), (23, 4)][g % 5]
        w = [f"p{g}x{rnd.randrange(10**6)}" for _ in range(n)]
        rows += [w, w + [f"q{g}y{i}" for i in range(more)]]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(near_dedup.find_classes(docs)) == want(rows)


def test_parity_loses_no_link():
    rnd = random.Random(6)
    for _ in range(200):
        n, m = rnd.randrange(1, 3000), rnd.randrange(0, 600)
        a = np.array(rnd.sample(range(10**9), n + m), np.uint64)
        b = np.append(a[m:], np.array(rnd.sample(range(10**9, 2 * 10**9), m), np.uint64))
        both = near_dedup.parity(np.append(a, b), np.array([0, n + m, 2 * (n + m)]))
        odd = sum((int(x) & 2**64 - 1).bit_count() for x in both[0] ^ both[1])
        assert odd <= 2 * m and (m or odd == 0)


def test_one_document_of_each_class_stays(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words) + " x", " ".join(words) + " y"]
    other = " ".join(words[::-1])
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, other), (7, other + " z"), (7, other), (9, other + " v")]
    kept = pairs(near_dedup.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(str(i) for i, _ in kept) == ["7", "None"] and all(r in rows for r in kept)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    rnd.shuffle(edges)
    named = lambda i: i.to_bytes(2, "big")
    df = spark.createDataFrame([(named(a), named(b)) for a, b in edges], "a binary, b binary")
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert sorted((bytes(r.node), bytes(r.label)) for r in near_dedup.components(df).collect()) == sorted((named(i), named(root(i))) for i in parent)


def test_op6_query(spark):
    rows = pairs(spark.read.parquet(f"{SF}/documents.parquet"))
    found = got(q.op6_near_dedup(spark, SF))
    assert found == want(rows) and any(r[2] > 1 for r in found)


def test_tiles_meet_whatever_the_batches(monkeypatch):
    """Pivots and members of a tile meet once, also when a tile spans batches; sizes, parities and labels decide."""
    import pyarrow as pa

    rnd = np.random.default_rng(8)
    rows = []
    for bucket in (-5, 3, 9, 2**62):
        for block in range(3):
            base = rnd.integers(-(2**63), 2**63, 16)
            for i in range(int(rnd.integers(1, 60))):
                flips = np.array([1 << int(rnd.integers(0, 63)) if rnd.random() < 0.3 else 0 for _ in range(16)], np.int64)
                node, label = f"{bucket}{block}{i}".encode(), f"l{rnd.integers(0, 5)}".encode()
                firsts = rnd.choice([bucket, bucket + 1, bucket + 2], near_dedup.REPEATS)
                rows.append((bucket, block, node, label, int(rnd.integers(40, 60)), bool(rnd.random() < 0.3), base ^ flips, firsts))
    want, told_once = set(), set()
    for r in rows:
        for s in rows:
            near = r[4] * 10 >= s[4] * 8 and s[4] * 10 >= r[4] * 8
            odd = int(np.bitwise_count((r[6] ^ s[6]).view(np.uint64)).sum())
            if r[5] and not s[5] and r[:2] == s[:2] and r[3] != s[3] and near and odd * 18 <= (r[4] + s[4]) * 2:
                want.add((r[2], s[2]))
                shared = [int(u) for u, v in zip(r[7], s[7], strict=True) if u == v]
                if not shared or shared[0] == r[0]:
                    told_once.add((r[2], s[2]))
    assert len(want) > 100 and 30 < len(told_once) < len(want)
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.int32()), ("node", pa.binary()), ("label", pa.binary()), ("n", pa.int64()),
                        ("is_pivot", pa.bool_()), ("parity", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64()))])
    whole = pa.record_batch([pa.array([x.tolist() if hasattr(x, "tolist") else x for x in c], t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    for size in (1, 7, 50, 10_000):
        batches = [whole.slice(i, size) for i in range(0, len(rows), size)]
        got = [(a.as_py(), b.as_py()) for r in near_dedup._meet(iter(batches)) for a, b in zip(r.column("a"), r.column("b"))]
        assert len(got) == len(want) and set(got) == want
        got = [(a.as_py(), b.as_py()) for r in near_dedup._meet(iter(batches), True) for a, b in zip(r.column("a"), r.column("b"))]
        assert len(got) == len(told_once) and set(got) == told_once
