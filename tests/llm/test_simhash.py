import random
import re

import numpy as np
import pytest
import xxhash

from cabflow.llm import queries as q
from cabflow.llm import simhash
from tests.llm.helpers import SF, awkward, nothing, pairs


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(docs):
    """(doc id, fingerprint, smallest id of its component) in the order of the documents."""
    low = lambda i: -(2**63) if i is None else i
    fps = [fingerprint(t) for _, t in docs]
    nodes = sorted(set(fps))
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for n, a in enumerate(nodes):
        for b in nodes[:n]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for (i, _), f in zip(docs, fps, strict=True):
        least[find(f)] = min(least.get(find(f), low(i)), low(i))
    name = lambda f: None if least[find(f)] == -(2**63) else least[find(f)]
    return [(i, f"{f:016x}", name(f)) for (i, _), f in zip(docs, fps, strict=True)]


key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))


def got(df):
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    return sorted(map(tuple, df.collect()), key=key)


def variants(rnd, n):
    """Texts of one group that differ in a few words of a long common rest, and loose ones."""
    base = [f"w{rnd.randrange(500)}" for _ in range(300)]
    out = []
    for i in range(n):
        w = list(base) if i % 3 else [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(1, 40))]
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        out.append((1000 + i, " ".join(w)))
    return out


@pytest.mark.parametrize("large,tile,bucket", [(1 << 17, 4096, 1024), (3, 4, 2), (20, 7, 5)])
def test_components_against_brute_force(spark, large, tile, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE", large)
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "COUNT", 50)
    docs = awkward(spark, variants(random.Random(large), 120 if large > 3 else 40))
    want = sorted(brute(pairs(docs)), key=key)
    assert len({r[2] for r in want}) < len({r[1] for r in want})  # some are linked
    assert got(simhash.find_components(docs)) == want


def test_components_of_nothing(spark):
    assert got(simhash.find_components(nothing(spark))) == []


def test_op11_query(spark):
    assert got(q.op11_simhash(spark, SF)) == sorted(brute(pairs(spark.read.parquet(f"{SF}/documents.parquet"))), key=key)


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_bit_planes_against_popcount(radius):
    rnd = np.random.default_rng(radius)
    base = rnd.integers(0, 2**64, 3, np.uint64)
    flips = np.array([sum(1 << int(b) for b in rnd.integers(0, 64, rnd.integers(0, 4))) for _ in range(700)], np.uint64)
    near = base[rnd.integers(0, 3, 700)] ^ flips
    nodes = np.concatenate([near, rnd.integers(0, 2**64, 401, np.uint64)])
    queries = np.concatenate([near[::2], rnd.integers(0, 2**64, 600, np.uint64)])
    found = {(int(x), int(y)) for a, b in simhash.near_pairs(queries, nodes, radius) for x, y in zip(a, b, strict=True)}
    x, y = np.nonzero(np.bitwise_count(queries[:, None] ^ nodes[None, :]) <= radius)
    assert found == set(zip(x.tolist(), y.tolist(), strict=True)) and len(found) > 1000
    for many, few in ((queries, nodes[:1]), (nodes[:1], nodes[:1]), (queries[:0], nodes)):
        n = sum(len(a) for a, _ in simhash.near_pairs(many, few, radius))
        assert n == int((np.bitwise_count(many[:, None] ^ few[None, :]) <= radius).sum())


def test_near_nodes_share_a_bucket_at_every_level():
    rnd = random.Random(3)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for _ in range(rnd.randrange(4)):
            b ^= 1 << rnd.randrange(64)
        path = 1
        for _ in range(simhash.last_level()):
            agree = [p for p in range(path * 4, path * 4 + 4) if all((a ^ b) >> bit & 1 == 0 for bit in simhash.named_bits(p)[0])]
            assert agree
            path = rnd.choice(agree)
        assert sorted(sum(simhash.named_bits(path), ())) == list(range(64))
