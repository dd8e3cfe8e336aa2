import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cabflow.llm import lexical
from cabflow.llm import queries as q
from tests.llm.helpers import SF, awkward, nothing, pairs


def terms_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top):
    """(item id, rank, doc id, score), each distinct (id, text) of the items ranked for itself."""
    low = lambda i: -(2**63) if i is None else i
    bags = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, bag, n in bags:
            m = 100 - 25 + 25 * n * n_docs // length if length else 0
            score = 0
            for t in terms_of(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, low(i), i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda s: s[:2])[:top], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    common_words, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(300)]
    word = lambda: rnd.choice(common_words) if rnd.random() < 0.7 else rnd.choice(rare)
    texts = [" ".join(word() for _ in range(rnd.choice([1, 4, 30, 300]))) for _ in range(150)]
    items = [" ".join(word() for _ in range(rnd.choice([1, 5, 40]))) for _ in range(12)]
    items += [" ".join(rare[:90] + common_words), texts[0] + " alpha3 alpha3 C1", "中文5 délta7", "nowhere"]
    return [(500 + i // 2, t) for i, t in enumerate(texts)], items


@pytest.mark.parametrize("block,portion,look,top", [(4 << 20, 2_000_000, 64, 20), (600, 40, 1, 3), (10**6, 700, 2, 1)])
def test_search_against_brute_force(spark, block, portion, look, top, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "PORTION", portion)
    monkeypatch.setattr(lexical, "FIRST_LOOK", look)
    extra, texts = corpus(top)
    docs = awkward(spark, extra)
    items = [*enumerate(texts), (1, texts[2]), (1, texts[2]), (None, texts[3]), (77, None), (78, ""), (None, None)]
    queries = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, rank int")
    want = brute(pairs(docs), items, top)
    assert got(lexical.search(docs, queries, top)) == want and len(want) > 10


def test_search_of_nothing(spark):
    docs, some = awkward(spark), spark.createDataFrame([("a", "alpha1 beta2")], "item_id string, text string")
    for d, s in ((nothing(spark), some), (docs, some.limit(0)), (docs.filter("doc_id = 7"), some)):
        out = lexical.search(d, s)
        assert got(out) == [] and dict(out.dtypes)["item_id"] == "string"


def test_op13_query(spark):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute(pairs(docs), [(r.item_id, r.text) for r in items.collect()], 20)
    assert got(q.op13_lexical_search(spark, SF)) == want


def test_masks_below_the_bound_are_not_evaluated():
    """A rare term decides: documents that have only the frequent one are never scored."""
    n = 10_000
    doc = np.arange(n)
    rare = doc[::100]
    p = lexical.Portion(
        doc, np.array([0, n, n + len(rare)]), np.concatenate([doc, rare]), np.r_[np.full(n, 5), np.full(len(rare), 1000)], np.array([5, 1000])
    )
    best, scratch = lexical.Best(20), np.zeros(n, np.uint64)
    query = lexical.Query(np.array([0, 1]), np.array([1, 1]))
    assert lexical.search_portion(p, query, best, scratch) <= len(rare)
    assert best.doc_id.tolist() == rare[:20].tolist() and (best.score == 1005).all() and not scratch.any()
    assert lexical.search_portion(p, query, best, scratch) <= len(rare)  # the frequent term makes no candidates now


def test_masks_of_many_terms_are_grouped_exactly():
    rnd = np.random.default_rng(5)
    masks = rnd.integers(0, 2, (400, 3)).astype(np.uint64) << np.uint64(63)
    first, which = lexical.group_masks(masks)
    groups = defaultdict(set)
    for mask, g in zip(masks.tolist(), which.tolist(), strict=True):
        groups[g].add(tuple(mask))
    assert all(len(x) == 1 for x in groups.values()) and len(groups) == len(np.unique(masks, axis=0)) == len(first)
    assert (masks[first][which] == masks).all()
