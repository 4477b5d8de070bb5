"""Importance resampling against a plain count of all n-grams."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from silverlode.llm import resample
from silverlode.llm.common import ship_package
from silverlode.llm.queries import QUERIES
from tests.compare import DATA

SCHEMA = "doc_id long, text string, row int, lines string, weight double"
UPPER = re.compile("[A-Z]")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, buckets):
    words = WORD.findall(UPPER.sub(lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, buckets=10_000):
    found = [(doc_id, *features(text, buckets)) for doc_id, text in docs]
    s, t = Counter(), Counter()
    for _, _, own in found:
        s.update(own)
    for text in target:
        t.update(features(text, buckets)[1])
    total, wanted = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in {*s, *t}}
    rows = []
    for doc_id, words, own in found:
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, row in enumerate(enough[: 5 * len(enough) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def run(spark, docs, target, buckets=10_000):
    ship_package(spark)
    wide = spark.createDataFrame([(*r, 1, "x", 2.0) for r in docs], SCHEMA)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    return sorted((tuple(r) for r in resample.resample(wide, wanted, buckets).collect()), key=repr)


def documents():
    rng = random.Random(5)
    vocabulary = [f"W{i}" for i in range(40)] + ["É", "x²", "naïve", "日本", "a-b", "1.5", " ", "İ", "\x7fz"]

    def line(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared = [line(n) for n in (1, 2, 3, 7, 12, 0)] + ["", " -- ", "!"]
    docs = [(i, "\n".join(rng.choice([rng.choice(shared), line(rng.randint(0, 6))]) for _ in range(rng.randint(0, 14)))) for i in range(300)]
    docs += [(None, None), (None, "word"), (400, ""), (401, None), (3, docs[3][1]), (3, docs[3][1]), (402, "\n\n a \r\n b\n\nc\td")]
    docs += [(500, line(30_000).replace(" W1 ", "\n")), (None, docs[5][1]), (None, docs[5][1])]
    # A line that a third of all rows share.
    docs += [(1000 + i, "the same line of every page\n" + line(20)) for i in range(150)]
    return docs, [line(25) + "\n" + line(3) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("buckets", [7, 10_000])
def test_equals_a_plain_count(spark, buckets):
    docs, target = documents()
    assert run(spark, docs, target, buckets) == plain(docs, target, buckets)


def test_light_lines_are_joined_like_heavy_ones(spark, monkeypatch):
    docs, target = documents()
    for share in (1, 60):
        monkeypatch.setattr(resample, "HEAVY_SHARE", share)
        assert run(spark, docs, target) == plain(docs, target)


def test_lines_leave_tasks_in_parts(spark, monkeypatch):
    docs, target = documents()
    monkeypatch.setattr(resample, "HELD_BYTES", 100)
    assert run(spark, docs, target) == plain(docs, target)


def test_empty_tables(spark):
    docs, target = documents()
    assert run(spark, [], target) == []
    assert run(spark, docs[:40], []) == plain(docs[:40], [])
    assert run(spark, [(1, None)], [None]) == plain([(1, None)], [None])


def test_query_on_whole_tables(spark):
    folder = f"{DATA}/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_importance_resampling"](spark, folder).collect()), key=repr)
    assert got == plain(docs, target)
