import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cabflow.llm import divergence
from cabflow.llm import queries as q
from tests.llm.helpers import SF

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, gid int, value string"


def brute(rows, min_docs, top):
    """rows: (text, lang, source)."""
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        bag = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))
        counts[lang, source].update(bag)
        docs[lang].update(bag.keys())
    out = []
    for lang in {x for x, _ in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        groups = sorted(s for x, s in counts if x == lang)
        whole = Counter()
        for s in groups:
            whole.update(counts[lang, s])

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in groups}
        q_ = shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pair), 1)]
            term = [(-f(p[s][t], q_[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q_[t]]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(term)[:top], 1)]
    return sorted(out)


def corpus(seed, n=160):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("al", "Be", "çé", "中文", "zz") for b in "abcdefghij"]
    rows = []
    for i in range(n):
        source = f"s{min(rnd.randrange(14), rnd.randrange(14))}"
        own = vocab[int(source[1:]) :: 3]
        text = " 7,".join(rnd.choice(own if rnd.random() < 0.6 else vocab) for _ in range(rnd.choice([0, 2, 20, 60])))
        rows.append((i, text, rnd.choice(["en", "fr", None]), rnd.choice([source, source, source, None])))
    rows += [rows[3], rows[3], (None, rows[5][1], "en", "s1"), (900, None, "xx", "alone"), (901, "only one", "yy", "a"), (902, "", "yy", "b")]
    rows += [(903, "Rare " * 12, "en", "éa"), (904, "al" * 40_000 + " " + "ala " * 30_000, "en", "zz"), (905, "ala", "", "s1")]
    return [(i, t, lang, s, 5, "clash", 1, None) for i, t, lang, s in rows]


@pytest.mark.parametrize("groups,terms,portion,held", [(256, 8192, 1 << 16, 400_000), (3, 7, 5, 10), (4, 64, 50, 1), (1, 5, 1000, 100)])
def test_audit_against_brute_force(spark, groups, terms, portion, held, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_GROUPS", groups)
    monkeypatch.setattr(divergence, "TILE_TERMS", terms)
    monkeypatch.setattr(divergence, "PORTION", portion)
    monkeypatch.setattr(divergence, "HELD_ROWS", held)
    rows = corpus(groups)
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), 4, 5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = brute([r[1:4] for r in rows], 4, 5)
    assert sorted(map(tuple, got.collect())) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] == 0 and r[0] == "yy" for r in want)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(empty).collect() == []
    assert divergence.audit(spark.createDataFrame([(1, None, None, None, 1, "", 1, "")], SCHEMA)).collect() == []


def test_op12_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()
    got = sorted(map(tuple, q.op12_source_divergence(spark, SF).collect()))
    assert got == brute([tuple(r) for r in rows], 10, 10) and len(got) > 1000


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 40), (8, 8, 8), (17, 9, 100), (2, 30, 7)])
def test_joint_walk_covers_every_cell_once(shape, same):
    rows_a, rows_b, terms = shape
    rows_b = rows_a if same else rows_b
    rnd = np.random.default_rng(terms)
    p = rnd.integers(1, 10**9, (rows_a, terms)) * (rnd.random((rows_a, terms)) < 0.1)
    q_ = p if same else rnd.integers(1, 10**9, (rows_b, terms)) * (rnd.random((rows_b, terms)) < 0.1)
    zero_p = rnd.integers(1, 10**6, rows_a)
    zero_q = zero_p if same else rnd.integers(1, 10**6, rows_b)
    got = divergence.pair_sums(p, q_, zero_p, zero_q, same)
    x, y = np.where(p > 0, p, zero_p[:, None]), np.where(q_ > 0, q_, zero_q[:, None])
    want = np.array([[divergence.differ(a, b).sum() for b in y] for a in x])
    on = np.triu(np.ones_like(want, bool), 1) if same else np.ones_like(want, bool)
    assert (got[on] == want[on]).all()


def test_empty_quadrants_are_priced_without_a_visit_to_their_cells():
    p = np.zeros((256, 8192), np.int64)
    p[200, 5000] = 7
    steps = list(divergence.walk(t := divergence.quadrants(p > 0, 8), t, (256, 256, 8192), True))
    assert sum(len(i) for _, i, *_ in steps) < 20_000  # of 267 million cells of pairs


def test_shares_are_exact():
    counts = [0, 1, 12345, 10**9, 4 * 10**12, 10**15 - 7]
    for total, kept in ((10**15, 10**6), (10**15 - 7, 1), (4 * 10**15, 10**9 + 7)):
        got = divergence.share(np.array(counts), total, kept).tolist()
        assert got == [1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts]
