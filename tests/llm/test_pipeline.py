"""The pipeline stage by stage against plain versions, and its guards."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from silverlode.llm import secrets
from tests.llm.test_models import plain_groups
from tests.llm.test_native import plain_leaks

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, place int"
FIELDS = [c.split()[0] for c in COLUMNS.split(", ")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    rows, labels = [], []
    for i in range(200):
        text = [word() for _ in range(rng.randrange(6, 60))]
        if i % 4 == 0:
            text.insert(rng.randrange(len(text)), rng.choice(["idiots", "vermin"]))
        if i % 10 == 1:
            text = rows[i - 1][1].split()
            text[0] = word() if len(text) > 40 else text[0]
        if i % 25 == 2:
            text.append("password: " + word() * 3)
        rows.append((i, " ".join(text)))
        labels.append((i, int(any(w in ("idiots", "vermin") for w in text))))
    items = [(k, " ".join(word() for _ in range(20))) for k in range(5)]
    rows += [(300, "before " + items[0][1] + " after"), (301, None), (302, ""), (None, "no id " + word()), (303, rows[7][1]), (7, rows[7][1])]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = [(d, t, "en", "s", len(t or ""), "x", 1) for d, t in rows]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    insulting = {d for d, t in rows if t and ("idiots" in t or "vermin" in t)}
    clean = pipeline.reject_toxic(spark, docs, path)
    assert clean.columns == FIELDS
    kept = {r.doc_id for r in clean.collect()}
    assert kept == {d for d, _ in rows} - insulting

    single = pipeline.keep_one_of_near_duplicates(spark, docs, path)
    assert single.columns == FIELDS
    want = sorted({d for d, _, _, stays in plain_groups(rows, pipeline.SHINGLE) if stays}, key=str)
    assert sorted((r.doc_id for r in single.collect()), key=str) == want

    left = pipeline.remove_leaks(spark, docs, path)
    assert left.columns == FIELDS
    leaked = {d for d, _ in plain_leaks(rows, items)}
    assert leaked == {300} and left.count() == len(rows) - 1

    masked = pipeline.mask_secrets(spark, docs, path)
    assert masked.columns == FIELDS and masked.count() == len(rows)
    for r in masked.collect():
        assert "password" not in (r.text or "") and r.n_chars == len(r.text or "")
    assert masked.filter(F.col("text").contains(secrets.MARK)).count() == sum("password" in (t or "") for _, t in rows)

    packed = pipeline.pack_sequences(spark, docs, path)
    assert packed.select("doc_id").distinct().count() == len({d for d, _ in rows})


def test_whole_run_and_empty_table(spark, folder, tmp_path):
    path, rows, _ = folder
    result = pipeline.run(spark, path)
    ids = {r.doc_id for r in result.select("doc_id").distinct().collect()}
    assert 300 not in ids and 303 not in ids and 301 in ids and ids < {d for d, _ in rows}
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{path}/documents.parquet").filter("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert "op5_url_filters" in entry.oracle_sql()
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scans", "best_fit_packing"]
