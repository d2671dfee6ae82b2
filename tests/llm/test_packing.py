"""Packing against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from cardloom.llm import packing, pu, simhash, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_every_id_in_one_piece(spark):
    rng = random.Random(4)
    words = ["the", "Ärger,", "naïve", "x1", "e-mail", "don't", "end.", "漢字", "<|endoftext|>", "x<|startoftext|>y.", "<|ENDOFTEXT|>", "\x1c", "ﬁ", "A" * 50]
    texts = [None, "", "one", "one", "The <|endoftext|> END", "The <|EndOfText|> END", "漢 <|ENDOFTEXT|>"] + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 900))) for _ in range(60)] + ["ab" * 9000, "word. " * 9000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int").repartition(3)
    rows = packing.pack(docs, PATH).collect()
    own = Tokenizer.from_file(PATH)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert sorted(pieces) == list(range(len(texts)))
    for i, found in pieces.items():
        found.sort(key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in found]).tolist()
        assert ids == [*own.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        assert [r.start for r in found] == np.cumsum([0, *(r.length for r in found)])[:-1].tolist() and {r.doc_tokens for r in found} == {len(ids)}
    padding = 0
    for found in sequences.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == np.cumsum([0, *(r.length for r in found)])[:-1].tolist()
        total = sum(r.length for r in found)
        assert total <= 4096
        padding += 0 if total & (total - 1) == 0 else 4096 - total
    assert padding < 0.02 * sum(r.length for r in rows)
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_cuts_cost_least():
    """Dynamic programming against all ways to cut, on a small length."""
    rng = random.Random(5)
    for _ in range(30):
        n = rng.randrange(3, 9)
        at = sorted(rng.sample(range(1, 60), n))
        prices = [float(rng.randrange(5)) for _ in at]
        if max(np.diff([0, *at])) > 16:
            continue
        least = {0: 0.0}
        for p, price in zip(at, prices):
            least[p] = min(c + 16 - (p - q) for q, c in least.items() if 0 < p - q <= 16) + price
        found = packing.cuts(at, prices, 16)
        price = dict(zip(at, prices))
        assert found[-1] == at[-1]
        assert sum(16 - d for d in np.diff([0, *found])) + sum(price[c] for c in found) == least[at[-1]]


def test_cuts_cost_least_with_windows_without_padding():
    """Windows of 256, 512 and so on cost nothing, as in all ways to cut."""
    rng = random.Random(6)
    length, powers = 4096, (256, 512, 1024, 2048)
    used = set()
    for _ in range(30):
        at = np.cumsum([rng.choice([64, 128, 192, rng.randrange(20, 400)]) for _ in range(150)]).tolist()
        prices = [float(rng.choice([0, 4, 32])) for _ in at]
        least = {0: 0.0}
        for p, price in zip(at, prices):
            least[p] = min(c + (0 if p - q in powers else length - (p - q)) for q, c in least.items() if 0 < p - q <= length) + price
        found = packing.cuts(at, prices, length)
        price, windows = dict(zip(at, prices)), np.diff([0, *found]).tolist()
        assert found[-1] == at[-1]
        assert sum(0 if d in powers else length - d for d in windows) + sum(price[c] for c in found) == least[at[-1]]
        used.update(windows)
    assert {256, 512} & used


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (4, "c"), (4, "c"), (4, None)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, PATH).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens) for r in rows] == [(None, 0, 3, 3), (4, 0, 2, 2), (4, 0, 2, 2), (4, 0, 1, 1)] and len({r.sequence_id for r in rows}) == 1


def test_workers_let_go_of_the_tokenizer_in_other_stages(spark):
    """A Python worker that packed lives on beside the next stages."""

    def told(batches):
        import gc

        for _ in batches:
            pass
        yield pa.record_batch([pa.array([sum(type(x).__name__ == "Words" for x in gc.get_objects())])], ["n"])

    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60)) + f" end{i % 8} {i // 8}") for i in range(64)], "doc_id long, text string").repartition(8)
    packing.pack(docs, PATH).collect()
    before = [r.n for r in docs.mapInArrow(told, "n long").collect()]
    simhash.near_copies_dropped(docs).collect()
    toxic = docs.select("doc_id", pu.score(pu.Model(), docs["text"], toxicity.words).alias("score"))
    for _ in range(3):  # so that each worker takes part
        toxic.collect()
    after = [r.n for r in docs.mapInArrow(told, "n long").collect()]
    assert sum(before) and not sum(after)


def test_few_words_are_remembered():
    """New words without end: a worker's memory stays bounded, ids the same."""
    own = packing.Words(PATH)
    for i in range(70):
        own.encode(" ".join(f"w{i}x{j}" for j in range(10_000)))
    assert len(own.known) < 600_000
    text = "The w1x1 naïve w69x9999 end."
    assert own.encode(text)[0].tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
