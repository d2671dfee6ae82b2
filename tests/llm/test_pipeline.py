"""The pipeline's stages on small tables and against a plain version, and the registry."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import test_jaccard
import test_secrets
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cardloom.llm import quality, queries, toxicity


def test_registry():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and "pipeline" in __spark_entry__.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The stages one by one, each on what the one before has kept."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    secret = "password: hunter2hunter2 and " + " ".join(f"plain{i}" for i in range(60))
    more = spark.createDataFrame([(10**9 + i, secret, "en", "s", len(secret)) for i in range(3)], docs.schema)
    out = [docs.unionByName(more)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], folder).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages(stages):
    docs, not_toxic, good, single, clean, packed = stages
    assert all(x.columns == docs.columns for x in (not_toxic, good, single, clean))
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4] == ids[5]
    assert 10**9 in ids[3] and not {10**9 + 1, 10**9 + 2} & ids[3]
    text = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert text[10**9][0].startswith("[SECRET] and plain0") and text[10**9][1] == len(text[10**9][0])
    before = {r.doc_id: r.text for r in single.collect()}
    assert sum(before[i] != t for i, (t, _) in text.items()) < len(text)
    tokens = packed.groupBy("doc_id").sum("length").collect()
    whole = {r.doc_id: r.doc_tokens for r in packed.collect()}
    assert all(r["sum(length)"] == whole[r.doc_id] for r in tokens)


def plain_pipeline(docs, labels, models):
    """{doc_id: texts that are packed}: stages one after the other by loops over rows."""
    toxic, good = models
    rows = [r for r in docs if toxic.score(toxicity.words(r[1])) < 0.7 and good.score(quality.traits(r[1])) >= 0.7]
    root = test_jaccard.least_ids([t or "" for _, t in rows])
    groups = {}
    for (doc_id, text), group in zip(rows, root):
        groups.setdefault(group, []).append((doc_id is None, doc_id or 0, text))
    kept = [min(g, key=lambda x: x[:2]) for g in groups.values()]
    texts = [t for *_, t in kept]
    found = {}
    for (none, doc_id, text), spans in zip(kept, test_secrets.every_span(texts)):
        own, parts = text or "", []
        at = 0
        for start, end in sorted(tuple(map(int, x.split(":")[1:])) for x in filter(None, spans.split(","))):
            if start >= at:
                parts += [own[at:start], "[SECRET]"]
            at = max(at, end)
        found.setdefault(None if none else doc_id, []).append("".join([*parts, own[at:]]))
    return found


def made_documents():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(2, 8))) for _ in range(900)]
    docs, labels = [], []
    for i in range(0, 1200, 2):
        toxic, good = rng.random() < 0.2, rng.random() < 0.75
        own = [rng.choice(words) for _ in range(rng.randrange(40, 120))]
        if toxic:
            own[3:6] = rng.choices(["vilest", "rotter", "cretin"], k=3)
        if i % 7 == 0:
            own[10:10] = ["password:", f"hunter{i}{i}", base64.b64encode(rng.randbytes(45)).decode()]
        docs.append((i, " ".join(own if good else [w + "###" for w in own])))
        labels.append((i, int(good), int(toxic)))
        if i % 10 == 0:  # a copy, with an edit or none
            at = rng.randrange(len(own))
            own[at : at + rng.randrange(3)] = ["edited"]
            docs.append((i + 1, " ".join(own if good else [w + "###" for w in own])))
    return docs + [(5000, None), (5001, ""), (None, docs[0][1]), (None, " ".join(f"alone{i}" for i in range(60)))], labels


def test_run_equals_a_plain_version(spark, tmp_path):
    """Null texts and ids among the rows."""
    docs, labels = made_documents()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], columns).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    tables = [spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels")]
    expected = plain_pipeline(docs, labels, [kind.learn(*tables) for kind in (toxicity, quality)])
    assert 250 < len(expected) < 500 and sum("[SECRET]" in t for x in expected.values() for t in x) > 30
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: sorted([*own.encode(t, add_special_tokens=False).ids, 2] for t in x) for i, x in expected.items()}
    found = {}
    for r in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        if r.start == 0:
            found.setdefault(r.doc_id, []).append(ids)
        else:
            found[r.doc_id][-1] += ids
    assert {i: sorted(x) for i, x in found.items()} == tokens


def test_empty_tables(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
