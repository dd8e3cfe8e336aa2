import hashlib
import random

import pytest

from cabflow.llm import anchors, substring_dedup, suffix_dedup
from cabflow.llm import queries as q
from tests.llm.helpers import SF, awkward, nothing, pairs, rows_of, spaced


def words_brute(docs, size):
    """docs: (id, text) with distinct ids, or repeats of both."""
    seen, gone = {}, {}
    low = lambda i: -(2**63) if i is None else i
    for i, t in sorted(set(docs), key=lambda d: (low(d[0]), d[1] or "")):
        w = spaced(t)
        own = set()
        for a in range(len(w) - size + 1):
            x = tuple(w[a : a + size])
            if x in seen:
                own |= set(range(a, a + size))
            seen.setdefault(x, (i, a))
        gone[i, t] = own
    for i, t in docs:
        w = spaced(t)
        kept = " ".join(x for n, x in enumerate(w) if n not in gone[i, t])
        yield i, len(w), len(gone[i, t]), hashlib.sha256(kept.encode()).hexdigest()


def digest(df):
    return [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()]


key = lambda r: (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("size", [2, 4, 11, 20])
def test_words_against_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(anchors, "SOURCE_BYTES", 3000)
    monkeypatch.setattr(substring_dedup, "SOURCE_BYTES", 3000)
    rnd = random.Random(size)
    passages = [" ".join(rnd.choice("abcdefgh") + rnd.choice("xyz") for _ in range(rnd.randrange(15, 45))) for _ in range(6)]
    extra = []
    for i in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(12))) for _ in range(5)]
        extra.append((100 + i, rnd.choice([" ", "\n"]).join(parts)))
    extra += [(200, extra[3][1]), (201, "z " * 90), (202, passages[0][5:] + " " + passages[1])]
    docs = awkward(spark, extra).filter("coalesce(doc_id, 0) <> 12").repartition(4)
    got = sorted(digest(substring_dedup.remove_repeats(docs, size)), key=key)
    rows = pairs(docs)
    assert got == sorted(words_brute(rows, size), key=key)


def test_words_awkward(spark):
    docs = awkward(spark)
    got = digest(substring_dedup.remove_repeats(docs))
    assert sorted(r[:3] for r in got if r[0] in (17, 18)) == [(17, 20, 0), (18, 20, 0)]  # another word each
    assert len(got) == docs.count()
    twelve = sorted(r[1:3] for r in got if r[0] == 12)  # the repeated row is one document, the other text is another
    assert twelve == [(60, 0), (60, 0), (60, 60)]  # the null id, which sorts first, has that other text
    assert substring_dedup.remove_repeats(nothing(spark)).collect() == []


def test_op1_query(spark):
    got = rows_of(q.op1_substring_dedup(spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = sorted(words_brute(pairs(spark.read.parquet(f"{SF}/documents.parquet")), 20))
    assert got == want and sum(r[2] for r in want) > 1000


def bytes_brute(docs, size):
    seen = {}
    for n, (_, t) in enumerate(docs):
        b = (t or "").encode()
        for a in range(len(b) - size + 1):
            seen.setdefault(b[a : a + size], []).append((n, a))
    gone = [bytearray(len((t or "").encode())) for _, t in docs]
    for at in seen.values():
        if len(at) > 1:
            for n, a in at:
                gone[n][a : a + size] = b"\1" * size
    for (i, t), g in zip(docs, gone, strict=True):
        b = (t or "").encode()
        spans = sum(1 for x, y in zip(b"\0" + g[:-1] if g else b"", g, strict=True) if y and not x)
        yield i, len(b), sum(g), spans, hashlib.sha256(bytes(x for x, y in zip(b, g, strict=True) if not y)).hexdigest()


def byte_digest(df):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()]


@pytest.mark.parametrize(("size", "hot"), [(5, 1000), (30, 3), (200, 1000), (200, 2)])
def test_bytes_against_brute_force(spark, size, hot, monkeypatch):
    for module in (anchors, suffix_dedup):
        monkeypatch.setattr(module, "SOURCE_BYTES", 4000)
    monkeypatch.setattr(anchors, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BATCH_STRINGS", 500)
    rnd = random.Random(size + hot)
    text = lambda n: "".join(rnd.choice("abcd é") for _ in range(n))
    passages = [text(rnd.randrange(size // 2, size * 3)) for _ in range(5)]
    extra = [
        (100 + i, "".join(rnd.choice(passages)[rnd.randrange(4) :] if rnd.random() < 0.5 else text(rnd.randrange(size)) for _ in range(5)))
        for i in range(50)
    ]
    extra += [(200, "ab" * size), (201, "z" * (2 * size)), (202, extra[0][1]), (202, extra[1][1])]
    docs = awkward(spark, extra).repartition(4)
    got = sorted(byte_digest(suffix_dedup.remove_repeats(docs, size)), key=key)
    assert got == sorted(bytes_brute(pairs(docs), size), key=key)
    assert suffix_dedup.remove_repeats(nothing(spark), size).collect() == []


def test_op3_query(spark):
    got = rows_of(q.op3_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = sorted(bytes_brute(pairs(spark.read.parquet(f"{SF}/documents.parquet")), 200))
    assert got == want and sum(r[2] for r in want) > 1000
