import random

import __spark_entry__
import corpus_pipeline
from cases import clashing, documents, prose, texts
from test_decontaminate import items
from test_ngram_join import brute as groups
from test_toxicity import corpus
from wideloom.llm import decontaminate, secrets, toxicity
from wideloom.llm.common import fold

import pytest


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with toxic rows, copies, benchmark passages and secrets."""
    rng = random.Random(1)
    path = tmp_path_factory.mktemp("tables")
    rows, labels = corpus(11, 700)
    marks = items(12, 6)
    for i in range(0, 60, 5):
        rows.append((1000 + i, f"{prose(rng, 30)} {marks[i % 6]} {prose(rng, 20)}"))
        rows.append((1001 + i, rows[i][1]))
        rows.append((1002 + i, rows[i + 1][1] + " more"))
        rows.append((1003 + i, prose(rng, 40) + " password=abcdef123456 " + prose(rng, 5)))
    rows += [(2000 + i, t) for i, t in enumerate(texts(13, 5))] + [(2000, texts(13, 5)[0]), (None, "no key")]
    clashing(documents(spark, rows)).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(marks)), "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), rows, marks


def test_every_stage_against_its_input(spark, folder):
    path, rows, marks = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names, stages = zip(*corpus_pipeline.STAGES)
    assert names == ("toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "packing")
    kept = []
    for stage in stages[:-1]:
        docs = stage(spark, docs, path).cache()
        assert docs.columns == clashing(documents(spark, [])).columns
        kept.append([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    labels = spark.read.parquet(f"{path}/labels.parquet").where(fold("doc_id") != 0)
    model = toxicity.fit(documents(spark, rows), labels)
    clean = documents(spark, rows).where(model.score() < 0.5).select("doc_id", "text").collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(kept[0], key=key) == sorted(map(tuple, clean), key=key)
    shown = lambda k: -1 if k is None else k
    assert sorted(shown(k) for k, _ in kept[1]) == sorted({shown(c) for _, c, _ in groups(kept[0])})
    index = decontaminate.Index(marks)
    assert kept[2] and sorted(kept[2], key=key) == sorted((r for r in kept[1] if not index.find([r[1]])[0]), key=key)
    assert len(kept[2]) < len(kept[1])
    assert sorted(kept[3], key=key) == sorted(((k, secrets._redacted(t, "[secret]")) for k, t in kept[2]), key=key)
    assert kept[3] != kept[2]


def test_run_packs_what_is_kept(spark, folder):
    path, _, _ = folder
    out = corpus_pipeline.run(spark, path).collect()
    total = {}
    for r in out:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in out)
    assert {i for i in range(1003, 1060, 5)} <= set(total) and not {i for i in range(1000, 1060, 5)} & set(total)


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_all_numbers_are_registered():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
