"""Small awkward tables, and brute-force answers from plain Python."""

import random
import re
import zlib

import public_tokenizers
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, n_words string, rank int, digest string"


# Two words that polynomial hashes modulo 2**64 do not tell apart, whatever their base.
WORD = "".join("ab"[n.bit_count() % 2] for n in range(1024))
OTHER_WORD = WORD.translate(str.maketrans("ab", "ba"))


def awkward(spark, extra=()):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    rnd = random.Random(7)
    vocab = ["alpha", "beta", "Gamma", "délta", "中文", "o'x", "--", "7"]
    prose = [" ".join(rnd.choice(vocab) + str(rnd.randrange(40)) for _ in range(60)) for _ in range(4)]
    rows = [
        (1, prose[0]), (2, prose[0]), (3, prose[0] + " tail"), (4, "x " + prose[1]), (5, prose[1] + "\n" + prose[0]),
        (6, None), (7, ""), (8, "   \n\t "), (9, "one"), (10, "a" * 5000), (11, "ab " * 3000), (12, prose[2]),
        (12, prose[2]), (12, prose[3]), (None, prose[3]), (None, None), (13, "<|endoftext|> x<|endoftext|>y"),
        (14, " ".join(prose)), (15, "é" * 300), (16, "é" * 300), (17, " ".join([*"pqrstuv" * 2, *"wxyz", WORD, "end"])),
        (18, " ".join([*"pqrstuv" * 2, *"wxyz", OTHER_WORD, "end"])), (19, f"{WORD}\n{OTHER_WORD}"),
    ]
    rows = [(i, t, "clash", None, t) for i, t in [*rows, *extra]]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def library(name):
    t = Tokenizer.from_file(str(public_tokenizers.path(name)))
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df, *cols):
    none_last = lambda v: (v is None, v)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple(map(none_last, r)))
