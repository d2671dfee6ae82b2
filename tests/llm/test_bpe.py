"""Byte-level BPE against the tiktoken library."""

import random

import public_tokenizers
import tiktoken

from cardloom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [None, "", " ", "don't  stop\n\n now", "naïve café ½ ²x", "😀😀 漢字かな", "<|endoftext|>", "a" * 3000, "ab" * 2000 + "é" * 500, "\x1c\x85\xa0 x", "don't  stop\n\n now"]


def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_ids_and_round_trip(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(chr(rng.choice([32, 39, 10, rng.randrange(33, 127), rng.randrange(160, 900)])) for _ in range(40)) for _ in range(100)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    coded = docs.select("doc_id", bpe.encode("text", PATH, PATTERN).alias("ids"))
    rows = coded.select("doc_id", "ids", bpe.decode("ids", PATH, PATTERN).alias("bytes"), bpe.ids_text("ids").alias("as_text")).collect()
    own = library()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == own.encode_ordinary(text)
        assert bytes(r.bytes) == text.encode()
        assert r.as_text == " ".join(map(str, r.ids))
    assert docs.limit(0).select(bpe.encode("text", PATH, PATTERN)).count() == 0


def test_repeated_rows_and_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (2, None, 6)], "doc_id long, text string, bytes int")
    rows = docs.withColumn("ids", bpe.encode("text", PATH, PATTERN)).collect()
    assert sorted((r.doc_id, r.bytes, len(r.ids)) for r in rows) == [(1, 5, 2), (1, 5, 2), (2, 6, 0)]


def test_both_splits_agree():
    own = bpe.codec(PATH, PATTERN)
    for text in (t for t in TEXTS if t and all(c <= "ÿ" for c in t)):
        assert own.latin(text) == own.pieces(text)
    assert bpe._latin(r"\w+|\s") is None
