import random

import numpy as np
import pyarrow as pa
import pytest

import public_tokenizers
from cabflow.llm import kernels, packing, token_counts, token_files, tokens, warc
from cabflow.llm import queries as q
from tests.llm.helpers import SF, awkward, crc, library, nothing, pairs, rows_of

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def path(name):
    return str(public_tokenizers.path(name))


def encode(name, texts):
    encoder, out = tokens.Encoder.of(path(name)), []
    for c in kernels.chunks([pa.record_batch({"text": pa.array(texts, pa.string())})], max_bytes=5000):
        ids, b = encoder.encode(c.data, c.bounds)
        out += [ids[x:y].tolist() for x, y in zip(b[:-1], b[1:], strict=True)]
    return out


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_encoder_equals_whole_text_encoding(spark, name):
    rnd = random.Random(3)
    parts = [*" \n\t\r ab1'.,́éßΣ<|>\x1c\x0b\x85\xa0中İ 　", "<|endoftext|>", "'s", "The", " and", "İstanbul"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(4000)]
    texts += [t for _, t in pairs(spark.read.parquet(f"{SF}/documents.parquet"))]
    texts += [t for _, t in pairs(awkward(spark))]
    whole = library(name)
    assert encode(name, texts) == [whole(t) for t in texts]


def test_encoder_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_ENTRIES", 50)
    encoder = tokens.Encoder(path(BYTE))
    whole = library(BYTE)
    for i in range(30):
        text = " ".join(f"w{i}x{j} the" for j in range(20))
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == whole(text)
        assert len(encoder.slots) <= 110


def test_token_counts_and_cache(spark, tmp_out):
    docs, whole = awkward(spark), library(BYTE)
    cache = f"{tmp_out}/cache"
    want = sorted(((i is None, i), len((t or "").encode()), len(whole(t))) for i, t in pairs(docs))
    for _ in range(2):  # the second run finds every digest
        got = token_counts.count_tokens(docs, path(BYTE), cache)
        assert sorted(((r.doc_id is None, r.doc_id), r.n_bytes, r.n_tokens) for r in got.collect()) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == docs.fillna("").select("text").distinct().count()
    other = token_counts.count_tokens(docs, path(WORD), cache)  # another version shares no count
    assert {r.n_tokens for r in other.filter("doc_id = 10").collect()} == {len(library(WORD)("a" * 5000))}
    assert token_counts.count_tokens(nothing(spark), path(BYTE), cache).collect() == []


def test_op5_query(spark):
    whole = library(BYTE)
    want = sorted((i, len(t.encode()), len(whole(t)), len(whole(t)) > 512) for i, t in pairs(spark.read.parquet(f"{SF}/documents.parquet")))
    assert rows_of(q.op5_token_counts(spark, SF), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_token_files(spark, tmp_out):
    whole = library(BYTE)
    token_files.write_token_ids(awkward(spark), f"{tmp_out}/t", path(BYTE))
    rows = token_files.read_token_ids(spark, f"{tmp_out}/t").collect()
    assert sorted((r.doc_id is None, r.doc_id, list(r.ids)) for r in rows) == sorted(
        (i is None, i, [*whole(t), 0]) for i, t in pairs(awkward(spark))
    )
    rows.sort(key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    token_files.write_token_ids(nothing(spark), f"{tmp_out}/e", path(BYTE))
    assert token_files.read_token_ids(spark, f"{tmp_out}/e").collect() == []


def test_op9_query_and_file_format(spark, tmp_out):
    import pyarrow.parquet as pq
    import glob

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole, at, want = library(BYTE), 0, []
    for i, t in sorted(pairs(docs)):
        ids = [*whole(t), 0]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert rows_of(q.op9_token_files(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == want
    token_files.write_token_ids(docs, f"{tmp_out}/t", path(BYTE))
    column = pq.ParquetFile(glob.glob(f"{tmp_out}/t/*.parquet")[0]).metadata.row_group(0)
    by = {column.column(i).path_in_schema: column.column(i) for i in range(column.num_columns)}
    assert "RLE_DICTIONARY" in by["ids.list.element"].encodings and by["ids.list.element"].has_offset_index
    assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings


def check_packing(rows, docs, whole, cap=2048):
    got = {}
    for r in rows:
        got.setdefault((r.doc_id is None, r.doc_id), []).append((r.piece, r.start, r.length, r.ids_crc32))
    want = {}
    for i, t in docs:
        ids = [*whole(t), 0]
        cut = [(n, s, len(ids[s : s + cap]), crc(ids[s : s + cap])) for n, s in enumerate(range(0, len(ids), cap))]
        want.setdefault((i is None, i), []).extend(cut)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= cap
    return len(by), sum(r.length for r in rows)


def test_op10_query(spark):
    n, total = check_packing(
        q.op10_packing(spark, SF).collect(), pairs(spark.read.parquet(f"{SF}/documents.parquet")), library(WORD)
    )
    assert n <= 1.03 * total / 2048 + 2


def test_packing_awkward(spark):
    for cap in (64, 2048):
        check_packing(packing.pack(awkward(spark), path(WORD), cap).collect(), pairs(awkward(spark)), library(WORD), cap)
    assert packing.pack(nothing(spark), path(WORD)).collect() == []
    pieces = packing.cut_pieces(awkward(spark).filter("doc_id < 12"), path(WORD), 64)
    placed = packing.place(pieces, 64)
    seqs = {r.sequence_id: list(r.ids) for r in packing.sequences(pieces, placed).collect()}
    for r in placed.collect():
        assert crc(seqs[r.sequence_id][r.offset : r.offset + r.length]) == r.ids_crc32


@pytest.mark.parametrize("seed", range(6))
def test_plan_covers_histogram(seed):
    rnd = np.random.default_rng(seed)
    cap = 2048
    h = np.zeros(cap + 1, np.int64)
    lengths = rnd.lognormal(6, 1, [10, 1000, 50000, 500000, 3, 200000][seed]).astype(int).clip(1, cap)
    np.add.at(h, lengths, 1)
    if seed == 5:
        h[700] += 100000  # a third of all pieces share a length
    plan = packing.make_plan(h, cap)
    n = np.diff(np.append(plan.first, 0))
    last = np.append(plan.length[1:] != plan.length[:-1], True)
    n[last] = h[plan.length[last]] - plan.first[last]
    assert (n > 0).all() and (np.bincount(plan.length, n, cap + 1) == h).all()
    best = -(-int((h * np.arange(cap + 1)).sum()) // cap)
    assert plan.sequences <= best * 1.01 + 3, (plan.sequences, best)
    length, off = np.repeat(plan.length, n), np.repeat(plan.offset, n)
    where = np.repeat(plan.sequence - (np.cumsum(n) - n), n) + np.arange(n.sum())
    order = np.lexsort((off, where))
    length, off, where = length[order], off[order], where[order]
    new = np.r_[True, where[1:] != where[:-1]]
    end = off + length
    assert (off == np.where(new, 0, np.r_[0, end[:-1]])).all()  # gapless from 0 in every sequence
    assert end.max() <= cap and (np.unique(where) == np.arange(plan.sequences)).all()


def page_rows(spark):
    rows = [
        (1, "u1", "x" * 100), (2, "u2", "x" * 100), (3, None, "x" * 99), (4, "u\r\n4", "x" * 99), (5, "u5", None),
        (6, "u6", ""), (None, "u7", "y" * 200), (8, "u8", "y" * 200), (9, "u9", "é\r\n\r\n" * 40000),
        (10, "u10", "é\r\n\r\n" * 40000), (2, "u2", "x" * 100), (11, "u11", "WARC/1.1\r\n\r\n" * 20),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, size string")


def test_warc_round_trip(spark, tmp_out):
    import hashlib

    pages = page_rows(spark)
    got = warc.read_archives(spark, warc.write_archives(pages.repartition(2), f"{tmp_out}/w")).collect()
    assert len(got) == 12
    for r in got:
        payloads = {(p.html or "").encode() for p in pages.collect() if p.page_id == r.page_id}
        assert (r.payload_bytes, r.payload_digest) in {(len(p), hashlib.sha256(p).hexdigest()) for p in payloads}
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) in payloads
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds[2] == ("revisit", 1) and kinds[10] == ("revisit", 9) and kinds[8] == ("revisit", None)
    assert {i for i, (k, _) in kinds.items() if k == "response"} == {1, 3, 4, 5, 6, None, 9, 11}
    assert {r.url for r in got if r.page_id in (3, 4)} == {None, "u%0D%0A4"}
    empty = warc.write_archives(pages.limit(0), f"{tmp_out}/e")
    assert warc.read_archives(spark, empty).collect() == []


def test_warc_reader_validates(spark, tmp_out):
    import glob

    warc.write_archives(page_rows(spark).coalesce(1), f"{tmp_out}/w").collect()
    (file,) = glob.glob(f"{tmp_out}/w/*.zst")
    raw = open(file, "rb").read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    for bad in (raw[:-5], raw[:50], raw[: len(raw) // 2] + b"\0\0\0\0" + raw[len(raw) // 2 + 4 :]):
        open(file, "wb").write(bad)
        with pytest.raises(ValueError):
            list(warc.read_archive(file))
    for data in (b"HTTP/1.1\r\n\r\n", b"WARC/1.1\r\nWARC-Type: x\r\n\r\n\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.parse_record(data, "here")
    good = warc.build_record(1, "u", b"abc", 3, "0", None, False)
    with pytest.raises(ValueError):
        warc.parse_record(good[:-5] + b"\r\n\r\n", "here")


def test_warc_reader_counts_records(spark, tmp_out):
    import glob

    manifest = warc.write_archives(page_rows(spark).coalesce(1), f"{tmp_out}/w")
    (file,) = glob.glob(f"{tmp_out}/w/*.zst")
    raw = open(file, "rb").read()
    last = list(warc.read_archive(file))[-1].offset
    open(file, "wb").write(raw[:last])  # cut exactly between two frames
    with pytest.raises(Exception, match="the archive has 11 records, and the manifest 12"):
        warc.read_archives(spark, manifest).collect()


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_plain_words_before_punctuation_skip_the_slow_path(name, monkeypatch):
    """Punctuation and line ends are chunks of their own, so each word is known after its first time."""
    encoder, whole, slow = tokens.Encoder(path(name)), library(name), []
    through = encoder._through_library
    monkeypatch.setattr(encoder, "_through_library", lambda texts: (slow.extend(texts), through(texts))[1])
    words = [f"{a}{b}{c}é" for a in "abcd" for b in "efgh" for c in "ijkl"]
    text = "".join(f"\n{w}### {w}, {w}$$$ {w}!!" for w in words) + "<|endoftext|>x'll.\n"
    data = np.frombuffer(text.encode(), np.uint8)
    ids, _ = encoder.encode(data, np.array([0, len(data)]))
    assert ids.tolist() == whole(text)
    assert len(slow) < 20  # before: one for each word and punctuation
    assert len(encoder.names) == len(encoder.slots) and (np.diff(encoder.names.astype(object)) > 0).all()


def test_encoder_table_is_small_and_keeps_what_is_used(monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_ENTRIES", 4096)
    encoder, whole, asked = tokens.Encoder(path(BYTE)), library(BYTE), []
    ids_of = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda chunks: (asked.extend(chunks), ids_of(chunks))[1])
    for i in range(12):
        text = " often" * 50 + "".join(f" w{i}x{j}" for j in range(1000))
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == whole(text)
        assert len(encoder.names) <= 4096
    arrays = (encoder.names, encoder.slots, encoder.at, encoder.size, encoder.used)
    assert sum(x.nbytes for x in arrays) <= 100 * max(4096, 1 << 14)  # before: a dict of Python numbers beside arrays
    assert asked.count(" often") == 1
