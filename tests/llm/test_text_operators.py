import hashlib
import random
import re
from collections import defaultdict

import pytest

from cabflow.llm import decontaminate, exact_dedup, toxicity
from cabflow.llm import queries as q
from tests.llm.helpers import SF, WORD, awkward, nothing, pairs, rows_of

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


# ---- exact dedup -----------------------------------------------------------------------

def test_exact_copies(spark):
    docs = awkward(spark)
    groups = defaultdict(list)
    for i, t in pairs(docs):
        groups[t or ""].append(i)
    low = lambda i: -(2**63) if i is None else i
    want = sorted(
        (low(i), low(max(g, key=low)), len(g), low(i) == max(map(low, g)), SHA(t)) for t, g in groups.items() for i in g
    )
    got = sorted((low(r.doc_id), low(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact_dedup.find_copies(docs).collect())
    assert got == want
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((low(i), t or "") for i, t in pairs(kept)) == sorted((low(max(g, key=low)), t) for t, g in groups.items())
    assert exact_dedup.find_copies(nothing(spark)).collect() == [] == exact_dedup.drop_copies(nothing(spark)).collect()


def test_drop_copies_hashes_survivors_only(spark, monkeypatch):
    """Only rows that share length and prefix with another row have their whole text hashed."""
    made = []
    stage = exact_dedup.common.stage
    monkeypatch.setattr(exact_dedup.common, "stage", lambda df, name, **o: made.append((name, out := stage(df, name, **o))) or out)
    tail = "p" * 300
    rows = [(1, tail + "a"), (2, tail + "b"), (3, tail + "a"), (4, "alone"), (5, "other"), (6, "longer text")]
    kept = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(i for i, _ in pairs(kept)) == [2, 3, 4, 5, 6]
    hashed = [df for _, df in made if "text_sha256" in df.columns and "doc_id" in df.columns]
    assert [sorted(r.doc_id for r in df.collect()) for df in hashed] == [[1, 2, 3]]


# ---- decontamination -------------------------------------------------------------------

def decon_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def decon_brute(docs, items, size):
    windows = defaultdict(set)
    for i, t in items:
        w = decon_words(t)
        for a in range(max(len(w) - size + 1, min(len(w), 1))):
            windows[tuple(w[a : a + size])].add("null" if i is None else str(i))
    lengths = {len(x) for x in windows}
    for i, t in docs:
        w = decon_words(t)
        hit, names = set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if found := windows.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    names |= found
        yield i, len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block", [2, 5000])
def test_decontaminate_awkward(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", block)
    monkeypatch.setattr(decontaminate.stage_blocks, "__defaults__", ("item_id", "text", block))
    rnd = random.Random(5)
    word = lambda: rnd.choice(["a", "B", "c9", "né", "中"])
    texts = [" ".join(word() for _ in range(rnd.choice([0, 1, 3, 30, 200]))) for _ in range(40)]
    docs = awkward(spark, [(100 + i, t) for i, t in enumerate(texts)])
    items = [(1, texts[3]), (2, None), (3, ""), (4, "A b"), (None, texts[4][:40]), (1, texts[5]), (10, "a--B, C9"), (6, "zzz"), (7, WORD)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for size in (3, 10):
        got = decontaminate.scan(docs, bench, size).collect()
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=key) == sorted(
            decon_brute(pairs(docs), items, size), key=key
        )
        text = defaultdict(list)
        for i, t in pairs(docs):
            text[i].append(decon_words(t))
        named = defaultdict(list)
        for i, t in items:
            named["null" if i is None else str(i)].append(decon_words(t))
        for r in got:  # matches are verbatim and cannot be longer
            for m in r.matches:
                ok = False
                for w in text[r.doc_id]:
                    for x in named[m.item_id]:
                        a, b, n = m.doc_start, m.item_start, m.n_words
                        if w[a : a + n] == x[b : b + n] and len(w[a : a + n]) == n == len(x[b : b + n]):
                            left = a == 0 or b == 0 or w[a - 1] != x[b - 1]
                            ok |= left and (a + n == len(w) or b + n == len(x) or w[a + n] != x[b + n])
                assert ok, m
        lean = decontaminate.scan(docs, bench, size, with_matches=False).collect()
        assert sorted((str(r.doc_id), r.n_hit, *r["items"]) for r in lean) == sorted((str(r.doc_id), r.n_hit, *r["items"]) for r in got)
        clean = decontaminate.drop_contaminated(docs, bench, size)
        assert clean.columns == docs.columns
        assert sorted(map(str, pairs(clean))) == sorted(
            str(p) for p in pairs(docs) if not next(decon_brute([p], items, size))[2]
        )
    assert decontaminate.scan(nothing(spark), bench).collect() == []
    assert all(r.n_hit == 0 for r in decontaminate.scan(docs, bench.limit(0)).collect())


def test_op2_query(spark):
    docs, items = (pairs(spark.read.parquet(f"{SF}/documents.parquet")), spark.read.parquet(f"{SF}/benchmark.parquet").collect())
    want = sorted(
        (i, n, h, len(names), SHA(",".join(names)), h > 0) for i, n, h, names in decon_brute(docs, [(r.item_id, r.text) for r in items], 10)
    )
    got = rows_of(q.op2_decontaminate(spark, SF), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == want and any(r[-1] for r in want)


# ---- toxicity --------------------------------------------------------------------------

def test_toxicity_learns_and_ignores_held_out(spark):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = [rnd.choice("alpha beta gamma delta eps zeta eta".split()) for _ in range(rnd.randrange(20, 60))]
        if bad := i % 5 == 0:
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(["Vile,", "awful", "nasty"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(bad), 1.0))
    rows += [(None, "vile awful", "x"), (1000, None, "x"), (1001, "", "x"), (1002, "vile nasty awful vile " * 3, "x")]
    labels += [(None, 1, 1.0), (1001, None, 1.0), (0, 1, 1.0), (5, 1, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string").repartition(3)
    told = spark.createDataFrame(labels, "doc_id long, toxic int, score double")
    scorer = q.toxicity_scorer(docs, told)
    got = {r.doc_id: r.score for r in toxicity.score(docs, scorer).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in range(600))
    assert got[1002] >= 0.7 and got[1001] == got[1000] < 0.7
    kept = toxicity.drop_toxic(docs, scorer)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.7}
    # held-out labels do not matter
    from pyspark.sql import functions as F

    turned = told.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs, q.toxicity_scorer(docs, turned)).collect()}
    assert again == got
    one = toxicity.train(docs, told.filter("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, one).collect()} == {0.0}
    assert toxicity.score(nothing(spark), scorer).collect() == []


def test_toxicity_tells_all_words_apart(spark):
    """Words whose hashes agree in the first 20 bits are different words; scores as by brute force."""
    from math import exp, log

    import numpy as np

    from cabflow.llm import kernels as k

    names = [f"w{i}" for i in range(6000)]
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    by = defaultdict(list)
    for n, h in zip(names, k.words(data, np.array([0, len(data)]), k.ALNUM).hash.tolist(), strict=True):
        by[h >> 44].append(n)
    bad, good = zip(*[g[:2] for g in by.values() if len(g) > 1][:6], strict=True)
    rnd = random.Random(3)
    rows = [(i, " ".join([rnd.choice(bad) if i % 5 == 0 else "plain", *rnd.sample(good, 3)][: 1 if i % 5 == 0 else 4])) for i in range(600)]
    labels = {i: int(i % 5 == 0) for i, _ in rows}
    rows += [(1000, bad[0] + f" {good[0]}" * 1000), (1001, "unseen words"), (1002, f"{bad[1]} " * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scorer = toxicity.train(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, scorer).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, y in labels.items())
    n = [defaultdict(int), defaultdict(int)]
    for i, t in rows[:600]:
        for w in set(t.split()):
            n[labels[i]][w] += 1
    size = [480, 120]
    most = [1.5 * 480 / 120, 1.5]
    lost = [sum(min(c, most[y]) for c in n[y].values()) for y in (0, 1)]
    both = sum(sum(c.values()) for c in n)

    def weight(w):
        x = n[0][w] + n[1][w]
        like = [(n[y][w] - min(n[y][w], most[y]) + lost[y] * (x / both if x else 1)) / size[y] for y in (0, 1)]
        ratio = log(like[1] / like[0])
        return max(ratio - 1.5, 0) if ratio > 0 else min(ratio + 1.5, 0)

    for i, t in rows:
        w = t.split()
        z = scorer.slope * sum(map(weight, w)) / (len(w) + 10) ** 0.5 + scorer.intercept
        assert got[i] == pytest.approx(1 / (1 + exp(-z)), rel=1e-6)


def test_op7_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in q.op7_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    toxic = [r.predicted for r in rows if labels[r.doc_id]]
    clean = [r.predicted for r in rows if not labels[r.doc_id]]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.005 * len(clean)


def test_toxicity_block_holds_few_bytes_a_word():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    held = []
    for i in range(16):
        doc = (np.sort(rnd.integers(0, 100, 1 << 16)) + 100 * i).astype(np.uint16)
        rows = pa.record_batch({"key": pa.array(range(100 * i, 100 * i + 100))})
        held.append((rows, doc, rnd.integers(0, 1 << 14, 1 << 16).astype(np.uint64)))
    plain = sorted((w, d) for _, docs, words in held for d, w in zip(docs.tolist(), words.tolist(), strict=True))
    tracemalloc.start()
    rows, doc, word, times = toxicity._block(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.num_rows == 1600 and not held
    assert [(w, d) for w, d, n in zip(word.tolist(), doc.tolist(), times.tolist(), strict=True) for _ in range(n)] == plain
    assert peak < 50 << 20  # 43 bytes a word, of 1 << 20 words; before: 63
