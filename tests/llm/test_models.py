"""Near-duplicates, toxicity, neighbours, language model and repeats against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
import pytest

from silverlode.llm import hnsw, induced, katz, minhash, repeats, toxicity
from silverlode.llm.common import ship_package

DOCS = "doc_id long, text string"


def table(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    ship_package(spark)
    wide = [(*r, 1, "x", 2.0) for r in rows]
    return spark.createDataFrame(wide, DOCS + ", block int, class string, score double")


def bytes_words(text):
    return (text or "").encode().lower().split()


def plain_groups(rows, size):
    """All pairs of documents; (number of shingles, smallest id) per row."""
    sets = []
    for _, text in rows:
        w = bytes_words(text)
        width = min(size, len(w))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = smallest.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, size):
    rng = random.Random(size)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    rows = [(1000, None), (1001, ""), (1002, " \n "), (1003, "one"), (1004, "ONE"), (None, "one"), (1005, "é É"), (1006, "é é")]
    for family in range(6):
        base = [word() for _ in range(rng.choice([3, 30, 80]))]
        for k in range(25):
            text = list(base)
            for _ in range(rng.randrange(0, 7)):
                text[rng.randrange(len(text))] = word()
            rows.append((family * 25 + k, " ".join(text)))
    rows += [(7, rows[20][1]), (7, rows[20][1]), (None, rows[30][1]), (None, "alone here"), (2000, "long " * 30000)]
    got = minhash.near_duplicates(table(spark, rows), size).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_groups(rows, size), key=str)
    assert minhash.near_duplicates(table(spark, rows).filter("false"), size).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    b = np.concatenate([a[:400], rng.integers(0, 2**63, 100).astype(np.uint64)])
    small = a[:3]
    signed = minhash.super_minhash(np.concatenate([a, b, small]), np.repeat([0, 1, 2], [500, 500, 3]), 3, 200)
    assert (signed != np.uint64(2**64 - 1)).all()
    assert abs((signed[0] == signed[1]).mean() - 400 / 600) < 0.1
    # Each slot is taken once by each element.
    assert len({int(v) for v in signed[2]}) == 200


def test_swapped_identity_terms_do_not_change_scores(spark):
    """The labels blame one group; without the penalty the classifier does too."""
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        group = "muslims" if toxic or rng.random() < 0.05 else rng.choice(["christians", "jews", "hindus", "people"])
        filler = " ".join(rng.choices(["we", "met", "many", "today", "town", "news", "and", "then"], k=8))
        insult = rng.choice(["vermin", "idiots", "scum"]) if toxic and rng.random() < 0.7 else "friendly"
        rows.append((i, f"{filler} the {group} are {insult}!"))
        labels.append((i, int(toxic)))
    docs = table(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    score = model.scorer()
    neutral = [score(f"many friendly {g} met in town today") for g in ("muslims", "christians", "jews", "hindus")]
    assert max(neutral) - min(neutral) < 0.1 and max(neutral) < toxicity.THRESHOLD
    index = dict(model.index)
    sample = [(sorted(index[f] for f in toxicity.features(t) if f in index), [], y) for (_, t), (_, y) in zip(rows, labels)]
    biased = toxicity.fit([(a, a, y) for a, _, y in sample], index).scorer()
    blamed, other = (biased(f"many friendly {g} met in town today") for g in ("muslims", "christians"))
    assert blamed > other + 0.05 and blamed > max(neutral)
    assert score("they are scum and idiots") >= toxicity.THRESHOLD

    extra = table(spark, [(None, None), (700, ""), (701, "idiots " * 50000), (700, "")])
    found = {(r.doc_id, round(r.score, 6), r.predicted) for r in toxicity.score_documents(extra, model).collect()}
    assert len(found) == 3 and all(0 <= s <= 1 for _, s, _ in found)
    held = {r.doc_id: r.held_out for r in toxicity.score_documents(docs, model).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows}
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < 600
    nothing = toxicity.train(docs.filter("false"), marks)
    assert nothing.scorer()("anything") == 0.5 and toxicity.score_documents(docs.filter("false"), nothing).count() == 0


def test_scores_do_not_depend_on_the_bound_of_the_sample(spark):
    """One label in ten is toxic; the bound cuts clean rows only."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(2000):
        toxic = rng.random() < 0.1
        filler = " ".join(rng.choices(["we", "met", "many", "today", "town", "news", "and", "then"], k=8))
        insult = rng.random() < (0.6 if toxic else 0.05)
        rows.append((i, f"{filler} {'vermin' if insult else 'people'}"))
        labels.append((i, int(toxic)))
    docs, marks = table(spark, rows), spark.createDataFrame([*labels, *((i, 1) for i in range(5000, 6000))], "doc_id long, toxic int")
    whole, bounded = toxicity.train(docs, marks).scorer(), toxicity.train(docs, marks, per_class=130).scorer()
    share = sum(y for _, y in labels) / len(labels)
    for score in (whole, bounded):
        assert abs(sum(score(t) for _, t in rows) / len(rows) - share) < 0.03
    assert abs(bounded("nothing known") - whole("nothing known")) < 0.08
    assert abs(bounded("vermin") - whole("vermin")) < 0.15


def test_counts_of_features_leave_tasks_in_bounded_parts(monkeypatch):
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(n, n + 5)) for n in range(0, 300, 2)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(len(texts))], pa.int32())], names=["text", "label"])

    def counted() -> tuple[dict, list[int]]:
        parts = list(toxicity._counts(iter([batch])))
        total: dict[str, tuple[int, int]] = {}
        for name, n, toxic in (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns))):
            total[name] = (total.get(name, (0, 0))[0] + n, total.get(name, (0, 0))[1] + toxic)
        return total, [p.num_rows for p in parts]

    whole, sizes = counted()
    assert len(sizes) == 1
    monkeypatch.setattr(toxicity, "COUNTED_FEATURES", 50)
    parts, sizes = counted()
    assert parts == whole and len(sizes) > 5 and max(sizes) < 50 + 30


def test_neighbours_with_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(vectors)]
    rows += [(2000 + i, rows[40][1]) for i in range(60)]
    rows += [(3000, None), (3020, []), (3040, [0.0] * 16), (3060, [float("nan")] + [1.0] * 15), (3080, [None] + [1.0] * 15)]
    rows += [(3100, [float("inf")] * 16), (3120, [1.0, 2.0]), (3121, [2.0, 2.0]), (None, rows[0][1]), (60, rows[60][1])]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id long, embedding array<float>, key int, shard string")
    ship_package(spark)
    got = hnsw.nearest(df, df.filter("vec_id % 20 = 0"), shard_rows=400).collect()
    usable = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    by_query: dict[int, list] = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by_query) == {i for i in usable if i % 20 == 0}
    hits = total = 0
    for q, found in by_query.items():
        same = {i: float((v * usable[q]).sum()) for i, v in usable.items() if i != q and len(v) == len(usable[q])}
        want = sorted(same, key=lambda i: (-same[i], i))[:20]
        assert len(found) == len(want) and found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(abs(same[i] - s) < 1e-9 for i, s in found)
        hits += len({i for i, _ in found} & set(want))
        total += len(want)
    assert hits / total >= 0.9
    copies = [i for i, _ in by_query[40]]
    assert set(range(2000, 2020)) >= set(copies) or len(set(copies) & set(range(2000, 2060))) >= 19
    assert hnsw.nearest(df.filter("false"), df.filter("false")).count() == 0


def plain_katz(rows, factors_of):
    docs = [(d, bytes_words(t) + [b" end"], d is None or zlib.crc32(str(d).encode()) % 10 != 0) for d, t in rows]
    single, pairs = Counter(), Counter()
    for _, w, train in docs:
        if train:
            single.update(w)
            pairs.update(zip([b" start", *w], w))
    n, v = sum(single.values()), len(single)
    counts = Counter(pairs.values())
    factors = factors_of([0, *[counts[r] for r in range(1, katz.DISCOUNTED + 2)]])
    followers: dict[bytes, dict[bytes, int]] = {}
    for (h, w), c in pairs.items():
        followers.setdefault(h, {})[w] = c
    p1 = lambda w: (single[w] + 0.1) / (n + 0.1 * (v + 1))

    def p(h, w):
        own = followers.get(h)
        if own is None:
            return p1(w)
        share = lambda c: factors[c] if c <= katz.DISCOUNTED else 1.0
        total = sum(own.values())
        freed = sum((1 - share(c)) * c for c in own.values())
        if freed <= 1e-12:
            share, freed, total = (lambda c: 1.0), 1.0, total + 1
        if w in own:
            return share(own[w]) * own[w] / total
        return freed / total * p1(w) / (1 - sum(map(p1, own)))

    for h in [*list(followers)[:20], b"never seen"]:
        assert abs(sum(p(h, w) for w in single) + p(h, b"never seen") - 1) < 1e-9
    out = {}
    for d, w, train in docs:
        base = sum(math.log10(p1(x)) for x in w)
        full = sum(math.log10(p(h, x)) for h, x in zip([b" start", *w], w))
        out.setdefault(d, []).append((not train, len(w), sum(single[x] > 0 for x in w), n, round(base, 6), round(full, 6)))
    return out


def test_walks_step_together_through_few_shards(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1200, 8)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = hnsw.build_graph(vectors, 3)
    queries = vectors[:300]
    found = hnsw.search_graph(graph, queries, 60)
    alone = [hnsw.search_graph(graph, q[None], 60)[0] for q in queries[:20]]
    assert len(found) == 300 and [f.tolist()[:10] for f in found[:20]] == [a.tolist()[:10] for a in alone]
    assert all(f[0] == i and len(set(f.tolist())) == 60 and (np.diff(vectors[f] @ queries[i]) < 1e-6).all() for i, f in enumerate(found))
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :20]
    assert np.mean([np.isin(b, f).mean() for b, f in zip(best, found)]) > 0.95
    # Ten thousand short vectors are one shard, long ones are dealt by their bytes.
    rows = spark.range(10_000).select(F.col("id").alias("key"), F.lit(2).alias("dim"), F.array(F.rand(1).cast("float"), F.rand(2).cast("float")).alias("vector"))
    assert [r["rows"] for r in hnsw.build_index(rows).select("rows").collect()] == [10_000]


def test_katz_scores_equal_a_plain_model(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 40)))) for i in range(120)]
    rows += [(None, "w1 w2"), (500, None), (501, ""), (502, "É é W1"), (3, rows[3][1]), (503, "w0 " * 20000)]
    got: dict = {}
    for parts in (1, 7):
        got.clear()
        for r in katz.score_documents(table(spark, rows), parts=parts).collect():
            values = (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
            got.setdefault(r.doc_id, []).append(values)
        want = plain_katz(rows, katz.discounts)
        assert set(got) == set(want)
        for d, values in want.items():
            for a, b in zip(sorted(got[d]), sorted(values)):
                assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-6)
    assert katz.score_documents(table(spark, rows).filter("false")).count() == 0


def test_discounts_follow_good_turing_or_fall_back():
    counts = [0, 1000, 400, 200, 120, 80, 50]
    found = katz.discounts(np.array(counts))
    common = 6 * 50 / 1000
    assert found[1] == pytest.approx((2 * 400 / 1000 - common) / (1 - common))
    assert found[6] == 1
    assert list(katz.discounts(np.zeros(7))[1:6]) == [1 - 0.5 / r for r in range(1, 6)]


def plain_removal(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(t[i : i + 200] for _, t in texts for i in range(len(t) - 199))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_a_plain_count_of_all_strings(spark):
    rng = random.Random(4)
    body = lambda n: "".join(rng.choices("abcé \n", k=n))
    passages = [body(n) for n in (180, 190, 198, 199, 200, 201, 230, 400, 900)]
    rows = [(i, body(rng.randrange(0, 300)) + rng.choice(passages) + body(rng.randrange(0, 300))) for i in range(80)]
    rows += [(100, None), (None, ""), (101, "x" * 5000), (102, "ab" * 300), (103, body(199)), (104, passages[8][100:350])]
    rows += [(105, rows[0][1]), (105, rows[0][1]), (106, passages[7] + passages[7]), (None, passages[6])]
    # Matches do not cross from one document to the next.
    rows += [(107, passages[8][:150]), (108, passages[8][150:340]), (109, "0" * 199), (110, "0" * 199)]
    want = sorted(plain_removal(rows), key=str)
    # As they come, in many shards, with every anchor of several contexts hot, and with both kinds.
    for parts, hot, shard in ((1, 5000, 10_000), (None, 5000, 3), (5, 1, 10_000), (3, 20, 7)):
        got = repeats.remove_repeats(table(spark, rows), parts=parts, keep_texts=True, hot=hot, shard=shard).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == want
        assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert repeats.remove_repeats(table(spark, rows).filter("false")).count() == 0


@pytest.mark.parametrize("size", [0, 150, 200, 999, 1000, 1001, 7777])
def test_long_documents_have_the_same_anchors_in_pieces(monkeypatch, size):
    data = np.random.default_rng(size).integers(97, 100, size).astype(np.uint8)
    data[size // 2 : size // 2 + 600] = 97
    whole = repeats.anchors(data, np.zeros(1, np.int64), np.array([size]))
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 500)
    for a, b in zip(whole, repeats._anchors_of_long(data)):
        assert a.tolist() == b.tolist()


def test_suffixes_are_ordered_also_with_queues_on_disk(monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(induced, "IN_MEMORY", 64)
    for trial in range(200):
        text = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 60)), 0).astype(np.int64)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        for base in (0, 4_000_000):
            order = induced.suffix_order(text, base=base)
            assert order.tolist() == want
        prefix = induced.common_prefixes(text, order, 5)
        for i in range(1, len(text)):
            a, b = text[order[i - 1] :].tolist(), text[order[i] :].tolist()
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[i] == min(n, 5)
