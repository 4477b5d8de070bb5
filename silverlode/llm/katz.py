"""Katz backoff: Good-Turing discounted word pairs over smoothed single words, scored for every document."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import shuffle_partitions, stored
from silverlode.llm.minhash import WordHashes, mixed

# Counts up to this are discounted.
DISCOUNTED = 5
SMOOTHING = 0.1
# Words of documents that are kept and asked about together.
BLOCK_TOKENS = 1_000_000
# Parts of the model for each shuffle partition, so that a part is small next to a task's memory.
PARTS_PER_PARTITION = 4
# White space cannot be part of a word, so no word has this hash on purpose.
END = xxhash.xxh3_64_intdigest(b" end")
# Words are numbered from 0 on; this is the start of a document.
START = np.uint64(1 << 63)

_hashes = WordHashes()


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _deltas(sorted_values: np.ndarray) -> bytes:
    return _packed(np.diff(sorted_values, prepend=np.uint64(0)))


def _from_deltas(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, so that high bytes that are all zero vanish."""
    return _packed(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T))


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(_unpacked(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash; a larger hash never has a smaller part."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def in_training(doc_id: Column) -> Column:
    """False for the tenth of the documents that is held out; a null id is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) != 0, F.lit(True))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as numbers of the words of their block, many documents to a row."""
    names = ["block", "doc_ids", "trains", "lengths", "words", "tokens"]
    number = TaskContext.get().partitionId() << 32
    ids: list = []
    trains: list[bool] = []
    hashed: list[np.ndarray] = []
    size = 0

    def row(id_type: pa.DataType) -> pa.RecordBatch:
        words, tokens = np.unique(np.concatenate(hashed), return_inverse=True)
        lengths = np.array([len(h) for h in hashed], np.int64)
        values = [[number], [ids], [trains], [_packed(lengths)], [_deltas(words)], [_packed(tokens.astype(np.int32))]]
        kinds = [pa.int64(), pa.list_(id_type), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    id_type = None
    for batch in batches:
        id_type = batch.column(0).type
        for doc_id, train, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
            words = (text.as_py() or "").encode("utf-8", "replace").lower().split()
            hashes = np.empty(len(words) + 1, np.uint64)
            hashes[:-1] = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
            hashes[-1] = END
            ids.append(doc_id)
            trains.append(train)
            hashed.append(hashes)
            size += len(hashes)
            if size >= BLOCK_TOKENS:
                yield row(id_type)
                ids, trains, hashed, size, number = [], [], [], 0, number + 1
    if ids:
        yield row(id_type)


class Block:
    """A block of documents with its distinct words and word pairs."""

    def __init__(self, row: pd.Series) -> None:
        self.number = int(row["block"])
        self.doc_ids = list(row["doc_ids"])
        self.trains = np.asarray(list(row["trains"]), bool)
        self.lengths = _unpacked(row["lengths"], np.int64)
        self.words = _from_deltas(row["words"])
        self.tokens = _unpacked(row["tokens"], np.int32).astype(np.int64)
        self.learnt = np.repeat(self.trains, self.lengths)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learnt], minlength=len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs as (first, second) word numbers, how often they are learnt from, and the pair of each token.

        The number behind the last word is the start of a document.
        """
        width = len(self.words) + 1
        first = np.empty_like(self.tokens)
        first[1:] = self.tokens[:-1]
        first[np.cumsum(self.lengths) - self.lengths] = width - 1
        keys, of_token = np.unique(first * width + self.tokens, return_inverse=True)
        learnt = np.bincount(of_token[self.learnt], minlength=len(keys))
        return keys // width, keys % width, learnt, of_token

    def requests(self, counts: np.ndarray, ids: np.ndarray, totals: dict, parts: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each part its pairs (numbers into pairs(), in the order of word ids), and histories that it only sums up for.

        A history that owns more than 1 / parts of all words is spread over several
        parts by its second words; each of them is asked for its share of the sums.
        """
        first, second, _, _ = self.pairs_cached()
        history = np.append(ids, START)
        frequency = np.append(counts, totals["documents"])
        spread = 1 + frequency * parts // max(totals["tokens"], 1)
        home = _parts_of(mixed(history), parts)
        part = (home[first] + (mixed(ids[second] + np.uint64(1)) % spread[first].astype(np.uint64)).astype(np.int64)) % parts
        used = np.unique(first)
        wide = used[spread[used] > 1]
        wide_histories = np.repeat(wide, spread[wide])
        step = np.arange(len(wide_histories)) - np.repeat(np.cumsum(spread[wide]) - spread[wide], spread[wide])
        wide_parts = (home[wide_histories] + step) % parts
        order = np.lexsort((ids[second], history[first], part))
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        return [(p, order[bounds[p] : bounds[p + 1]], np.unique(wide_histories[wide_parts == p])) for p in range(parts)]

    def pairs_cached(self):
        if not hasattr(self, "_pairs"):
            self._pairs = self.pairs()
        return self._pairs


def _word_requests(parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                block = Block(row)
                counts = block.word_counts()
                bounds = np.searchsorted(_parts_of(block.words, parts), np.arange(parts + 1))
                slices = [slice(bounds[p], bounds[p + 1]) for p in range(parts)]
                yield pd.DataFrame(
                    {
                        "part": np.arange(parts, dtype=np.int32),
                        "block": block.number,
                        "words": [_deltas(block.words[s]) for s in slices],
                        "counts": [_packed(counts[s].astype(np.int64)) for s in slices],
                    }
                )

    return run


def _count_words(parts: int):
    return lambda rows: _counted_words(rows, parts)


def _counted_words(rows: pd.DataFrame, parts: int) -> pd.DataFrame:
    """Counts and ids of words over all blocks, back to each block; one row (block -1) with the totals of the part."""
    words = [_from_deltas(w) for w in rows["words"]]
    counts = np.concatenate([_unpacked(c, np.int64) for c in rows["counts"]])
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    # No two words of the corpus have one id, whatever their part.
    part = int(rows["part"].iloc[0])
    numbered = place.astype(np.uint64) * np.uint64(parts) + np.uint64(part)
    ends = np.cumsum([len(w) for w in words])
    answers, split = [], []
    for own, end in zip(words, ends):
        asked = slice(end - len(own), end)
        counts_of_block = _packed(total[place[asked]])
        answers.append(counts_of_block + _deltas(numbered[asked]))
        split.append(len(counts_of_block))
    return pd.DataFrame(
        {
            "block": [*rows["block"], -1],
            "part": part,
            "kind": "words",
            "answer": [*answers, _packed(np.array([total.sum(), (total > 0).sum()]))],
            "split": [*split, 0],
        }
    )


def _word_answers(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts and ids of the words of a block, in its own order."""
    own = answers[answers["kind"] == "words"].sort_values("part")
    counts = [_unpacked(a[:split], np.int64) for a, split in zip(own["answer"], own["split"])]
    ids = [_from_deltas(a[split:]) for a, split in zip(own["answer"], own["split"])]
    return np.concatenate(counts), np.concatenate(ids)


def _pair_requests(parts: int, totals: dict):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(blocks.iloc[0])
        counts, ids = _word_answers(answers)
        first, second, learnt, _ = block.pairs_cached()
        history = np.append(ids, START)
        rows = []
        for part, pairs, wide in block.requests(counts, ids, totals, parts):
            heads = history[first[pairs]]
            rows.append(
                (
                    part,
                    block.number,
                    _deltas(heads),
                    _planes(ids[second[pairs]]),
                    _packed(learnt[pairs].astype(np.int32)),
                    _packed(counts[second[pairs]].astype(np.int64)),
                    _packed(history[wide]),
                )
            )
        return pd.DataFrame(rows, columns=["part", "block", "heads", "tails", "learnt", "counts", "wide"])

    return run


def _group_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _asked_histories(heads: np.ndarray, wide: np.ndarray) -> np.ndarray:
    return np.union1d(heads, wide)


def _count_pairs(totals: dict):
    """Counts of pairs over all blocks and sums by history, back to each block; one row (block -1) with counts of counts.

    Sums are, over the pairs of a history that occur in training: how many have a
    count of 1 to DISCOUNTED, the sum of their counts, and that of the single-word
    probabilities of their second words.
    """
    scale = totals["tokens"] + SMOOTHING * (totals["distinct"] + 1)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        heads = [_from_deltas(h) for h in rows["heads"]]
        wides = [_unpacked(w, np.uint64) for w in rows["wide"]]
        sizes = np.array([len(h) for h in heads])
        head = np.concatenate(heads)
        tail = np.concatenate([_from_planes(t) for t in rows["tails"]])
        learnt = np.concatenate([_unpacked(c, np.int32) for c in rows["learnt"]]).astype(np.int64)
        single = (np.concatenate([_unpacked(c, np.int64) for c in rows["counts"]]) + SMOOTHING) / scale
        order = np.lexsort((tail, head))
        starts = _group_starts(head[order], tail[order])
        total = np.add.reduceat(learnt[order], starts) if len(starts) else np.zeros(0, np.int64)
        of_row = np.empty(len(head), np.int64)
        of_row[order] = np.repeat(total, np.diff(np.append(starts, len(head))))

        pair_head, pair_single, seen = head[order][starts], single[order][starts], total > 0
        history, place = np.unique(pair_head, return_inverse=True)
        sums = np.zeros((len(history) + 1, DISCOUNTED + 2))
        for r in range(1, DISCOUNTED + 1):
            sums[:-1, r - 1] = np.bincount(place[total == r], minlength=len(history))
        sums[:-1, DISCOUNTED] = np.bincount(place, total, len(history))
        sums[:-1, DISCOUNTED + 1] = np.bincount(place[seen], pair_single[seen], len(history))

        answers, split = [], []
        ends = np.cumsum(sizes)
        for own, wide, end in zip(heads, wides, ends):
            asked = _asked_histories(own, wide)
            found = np.searchsorted(history, asked)
            known = (found < len(history)) & (history[np.minimum(found, len(history) - 1)] == asked) if len(history) else np.zeros(len(asked), bool)
            values = sums[np.where(known, found, len(history))]
            pair_counts = _packed(of_row[end - len(own) : end].astype(np.int32))
            answers.append(pair_counts + _packed(np.ascontiguousarray(values.T)))
            split.append(len(pair_counts))
        counts = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[: DISCOUNTED + 2]
        return pd.DataFrame(
            {
                "block": [*rows["block"], -1],
                "part": int(rows["part"].iloc[0]),
                "kind": "pairs",
                "answer": [*answers, _packed(counts)],
                "split": [*split, 0],
            }
        )

    return run


def discounts(counts: np.ndarray) -> np.ndarray:
    """Good-Turing factors of counts 0 .. DISCOUNTED + 1 from the numbers of pairs with these counts (the last stays 1).

    Where the counts of counts give no factors between 0 and 1, as in tiny
    corpora, each count r up to DISCOUNTED keeps 1 - 0.5 / r.
    """
    k = DISCOUNTED
    n = np.asarray(counts, float)
    factors = np.ones(k + 2)
    r = np.arange(1, k + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        common = (k + 1) * n[k + 1] / n[1]
        factors[1 : k + 1] = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
    if not np.all((factors[1 : k + 1] > 0) & (factors[1 : k + 1] < 1)):
        factors[1 : k + 1] = 1 - 0.5 / r
    return factors


def _scores(parts: int, totals: dict, factors: np.ndarray):
    scale = totals["tokens"] + SMOOTHING * (totals["distinct"] + 1)

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(blocks.iloc[0])
        counts, ids = _word_answers(answers)
        first, second, _, of_token = block.pairs_cached()
        history = np.append(ids, START)
        total = np.zeros(len(first), np.int64)
        sums = np.zeros((len(history), DISCOUNTED + 2))
        by_hash = np.argsort(history, kind="stable")
        own = answers[answers["kind"] == "pairs"].set_index("part")
        for part, pairs, wide in block.requests(counts, ids, totals, parts):
            answer, split = own.loc[part, "answer"], int(own.loc[part, "split"])
            total[pairs] = _unpacked(answer[:split], np.int32)
            asked = _asked_histories(history[first[pairs]], history[wide])
            values = _unpacked(answer[split:], np.float64).reshape(DISCOUNTED + 2, len(asked)).T
            np.add.at(sums, by_hash[np.searchsorted(history, asked, sorter=by_hash)], values)

        r = np.arange(1, DISCOUNTED + 1)
        freed = (sums[:, :DISCOUNTED] * (r * (1 - factors[1 : DISCOUNTED + 1]))).sum(axis=1)
        known = sums[:, DISCOUNTED]
        # A history without a discounted pair gives the place of one occurrence to what it has not seen.
        plain = (known > 0) & (freed <= 1e-12)
        freed = np.where(plain, 1.0, freed)
        whole = np.where(plain, known + 1, np.maximum(known, 1))
        weight = np.where(known > 0, freed / whole / (1 - sums[:, DISCOUNTED + 1]), 1.0)
        single = np.log10((counts + SMOOTHING) / scale)
        factor = np.where(plain[first], 1.0, factors[np.minimum(total, DISCOUNTED + 1)])
        seen = np.log10(np.maximum(factor * total, 1e-300) / whole[first])
        log = np.where(total > 0, seen, np.log10(weight[first]) + single[second])
        starts = np.cumsum(block.lengths) - block.lengths
        return pd.DataFrame(
            {
                "doc_id": pd.array(block.doc_ids, dtype="object"),
                "held_out": ~block.trains,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat((counts[block.tokens] > 0).astype(np.int64), starts),
                "train_tokens": totals["tokens"],
                "base_score": np.add.reduceat(single[block.tokens], starts),
                "score": np.add.reduceat(log[of_token], starts),
            }
        )

    return run


def _merged_totals(answers: DataFrame, size: int) -> np.ndarray:
    """The sum of the rows with the totals of parts: a few numbers from each of a bounded number of parts."""
    rows = answers.filter("block = -1").select("answer").collect()
    return np.sum([_unpacked(r["answer"], np.int64) for r in rows], axis=0) if rows else np.zeros(size, np.int64)


def score_documents(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Log10 probability of every document under a model learnt from those that are not held out.

    A document is its words and an end, each predicted from the word before or the
    start. A pair that occurs in training has its Good-Turing discounted share of its
    history; what is freed goes to all other words in proportion to their smoothed
    single-word probability, so that each history sums to one over the known words
    and one unknown word. ``base_score`` is that of single words alone.

    Null and empty texts are an end alone. Repeated rows are learnt from and scored
    each, a null id counts as training, other columns are left out, an empty table
    gives no rows.

    Blocks of documents stay where they are, in a bucketed table that is dropped at the
    end. Only distinct words and pairs of a block travel, sorted and compressed, to
    the part of the model that owns their history; histories that own much of the
    corpus are spread over parts in proportion. What a block gets back are counts
    and sums in the order it asked.
    """
    spark = docs.sparkSession
    parts = parts or PARTS_PER_PARTITION * shuffle_partitions(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_ids array<{id_type}>, trains array<boolean>, lengths binary, words binary, tokens binary"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), in_training(F.col("doc_id")).alias("train"))
    name = f"katz_blocks_{uuid.uuid4().hex}"
    rows.mapInArrow(_blocks, schema).write.bucketBy(shuffle_partitions(spark), "block").saveAsTable(name)
    try:
        blocks = spark.table(name)
        answer = "block long, part int, kind string, answer binary, split int"
        asked = blocks.mapInPandas(_word_requests(parts), "part int, block long, words binary, counts binary")
        words = stored(asked.groupBy("part").applyInPandas(_count_words(parts), answer))
        tokens, distinct = _merged_totals(words, 2).tolist()
        documents = blocks.select(F.size(F.filter("trains", lambda t: t)).cast("long").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        totals = {"tokens": tokens, "distinct": distinct, "documents": documents}

        requests = "part int, block long, heads binary, tails binary, learnt binary, counts binary, wide binary"
        own_words = words.filter("block >= 0")
        asked = blocks.groupBy("block").cogroup(own_words.groupBy("block")).applyInPandas(_pair_requests(parts, totals), requests)
        pairs = stored(asked.groupBy("part").applyInPandas(_count_pairs(totals), answer))
        factors = discounts(_merged_totals(pairs, DISCOUNTED + 2))

        answers = own_words.unionByName(pairs.filter("block >= 0"))
        result = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_scores(parts, totals, factors), result)
        return stored(scored)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
