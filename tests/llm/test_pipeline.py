"""The pipeline's stages on a small table with nulls, copies, leaks and secrets, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from maskline.llm import toxicity
from maskline.llm.queries import byte_bpe


def prose(r, n):
    return " ".join(f"p{i}" for i in r.integers(0, 10**6, n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = np.random.default_rng(17)
    folder = str(tmp_path_factory.mktemp("sf"))
    item = prose(r, 30)
    rows, labels = [], []
    for i in range(120):
        bad = i % 4 == 0
        rows.append((i, prose(r, 40) + (" vile awful scum" if bad else "")))
        labels.append((i, 0, int(bad)))
    clean = rows[1][1]
    rows += [(200, clean), (201, clean + " one"), (202, prose(r, 10) + " " + item), (203, "token=abcdefghij " + prose(r, 20)),
             (204, None), (205, ""), (1, clean), (None, prose(r, 30))]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), "extra") for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score string",
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, folder), name)
        if name != "bpe":
            assert out.columns == docs.columns
        docs = seen[name] = out
    keys = {n: sorted((x[0] for x in d.select("doc_id").collect()), key=lambda k: (k is None, k)) for n, d in seen.items()}
    good = [i for i in range(120) if i % 4] + [1, 200, 201, 202, 203, 204, 205, None]
    assert keys["toxicity"] == sorted(good, key=lambda k: (k is None, k))
    unique = [i for i in range(120) if i % 4] + [202, 203, 204, 205, None]
    assert keys["near_duplicates"] == unique
    assert keys["decontamination"] == [k for k in unique if k != 202] == keys["secrets"] == keys["bpe"]
    red = seen["secrets"].where("doc_id = 203").first()
    assert red["text"].startswith("[SECRET] p") and red["n_chars"] == len(red["text"])
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_bpe())
    counts = {x["doc_id"]: x["n_tokens"] for x in seen["bpe"].collect()}
    for x in seen["secrets"].collect():
        assert counts[x["doc_id"]] == len(library.encode(x["text"] or "", add_special_tokens=False).ids)


def test_run_is_the_stages(spark, tables):
    folder, _ = tables
    assert corpus_pipeline.run(spark, folder).count() == 90 + 4


def test_empty_table(spark, tables):
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
        assert docs.count() == 0


def test_held_out_keys(spark):
    rows = spark.range(200).select(toxicity.held_out(F.col("id"), 5, 0).alias("h"), "id").collect()
    import zlib

    assert all(x["h"] == (zlib.crc32(str(x["id"]).encode()) % 5 == 0) for x in rows)
