import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from departure_risk.llm import queries
from llm.conftest import sentence


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, junk, copies, benchmark passages, odd rows; with an extra column."""
    rng = np.random.default_rng(31)
    clean = [(i, sentence(rng, int(rng.integers(20, 200))) + ".") for i in range(300)]
    junk = [(1000 + i, " ".join(f"{w.upper()}!!" for w in sentence(rng, 60).split())) for i in range(200)]
    copies = [(2000 + i, clean[i][1]) for i in range(40)] + [(2100 + i, clean[i][1] + " tail") for i in range(40, 80) if len(clean[i][1].split()) > 60]
    items = [(i, sentence(rng, 40)) for i in range(10)]
    leaks = [(3000 + i, sentence(rng, 15) + " " + t + " " + sentence(rng, 15) + ".") for i, t in items]
    odd = [(4000, None), (4001, ""), (4002, sentence(rng, 9000) + "."), (None, sentence(rng, 70) + "."), (None, sentence(rng, 20) + " " + items[0][1])]
    rows = [(i, t, "en", f"s{(i or 1) % 5}" if (i or 1) % 3 else "hot", len(t or "")) for i, t in clean + junk + copies + leaks + odd]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("words", F.lit(1)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(i, 0, 0) for i, _ in junk], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_every_stage_does_its_part(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = after[name] = spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "tokens" or docs.columns == columns
    # texts go on whole, and rows without an id are treated like the others
    texts = {r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(r.text in texts for name in after if name != "tokens" for r in after[name].collect())
    nameless = [{r.text for r in rows.collect() if r.doc_id is None} for name, rows in after.items() if name != "tokens"]
    assert [len(t) for t in nameless[:2]] == [2, 2] and len(nameless[2]) == 1
    ids = {name: [r.doc_id for r in rows.collect()] for name, rows in after.items()}
    assert set(range(300)) <= set(ids["quality"]) and len([i for i in ids["quality"] if 1000 <= (i or 0) < 1200]) < 5
    assert {3000 + i for i in range(10)} <= set(ids["near_duplicates"]) and not [i for i in ids["near_duplicates"] if 2000 <= (i or 0) < 3000]
    assert set(range(300)) <= set(ids["decontamination"]) and not [i for i in ids["decontamination"] if 3000 <= (i or 0) < 4000]
    sizes = {r.source: r.w for r in after["decontamination"].groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("w")).collect()}
    mixed = {r.source: r.w for r in after["mixing"].groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("w")).collect()}
    assert sum(mixed.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01) and all(mixed[s] <= 2 * sizes[s] + 2 for s in sizes)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = sorted(((r.doc_id, r.text or "") for r in after["mixing"].collect()), key=lambda r: (r[0] is not None, r))
    want = [plain.encode(t, add_special_tokens=False).ids + [0] for _, t in texts]
    got = sorted(after["tokens"].collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == [(d, len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for (d, _), w in zip(texts, want)]


def test_run_gives_the_last_stage(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and rows.count() > 200


def test_stages_take_empty_tables(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).isEmpty()


def test_each_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)
    json.dumps(queries.SQL)


def test_waiting_workers_hold_no_unused_memory(monkeypatch):
    from departure_risk.llm import memory

    freed = []

    class Pool:
        def release_unused(self):
            freed.append(True)

    monkeypatch.setattr(memory.pa, "default_memory_pool", Pool)
    class Library:
        def malloc_trim(self, left):
            freed.append(left)

    monkeypatch.setattr(memory.ctypes, "CDLL", lambda _: Library())
    monkeypatch.setattr(memory.sys, "platform", "linux")
    batches = memory.given_back(iter([1, 2]))
    assert next(batches) == 1 and not freed
    assert list(batches) == [2] and freed == [True, 0]
