"""Importance resampling of documents towards a target distribution, with work shared by equal lines.

The bag of hashed word n-grams of a text decides how much likelier the text is
under the target than under the corpus. Separators cut texts into lines, and a
newline never belongs to a word. So the n-grams within a line depend on the line
alone: they are hashed once per different line, and their counts are multiplied
by how often the line occurs. N-grams that reach over the end of a line are
hashed with their document. Gains of a line are summed once, too, and documents
look up the sums of their lines.

A line is its words (lower case, joined by one space); lines without words are
skipped, and n-grams reach over them. Null and empty texts have no features:
weight 0. Rows that repeat an id, also a null one (written as nothing in the
seed), are judged and may be drawn each for itself; equal scores go to the smaller
id, nulls first. Where the target or the corpus is empty, smoothing gives all buckets
finite gains. Further columns are left out; an empty table gives no rows.

A line that many documents share is one row per task when it is counted. When its
sum is looked up, lines with more than a ten-thousandth of all occurrences (so
fewer than ten thousand) are joined by broadcast and all others by shuffling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import lower_ascii, stored

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
DRAWN_OF_100 = 5
SEED = 42
# A line is heavy beyond this share of all occurrences of lines.
HEAVY_SHARE = 10_000
# Bytes of different lines that a task holds before it passes them on, and rows it turns into Python values at a time.
HELD_BYTES = 8_000_000
ROWS_AT_A_TIME = 200
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_EMPTY = np.zeros(0, np.int64)


def _lines(text: bytes | None) -> list[list[bytes]]:
    """Words of each line of a lower-case text, for lines that have any."""
    found = (_WORD.findall(line) for line in (text or b"").split(b"\n"))
    return [words for words in found if words]


def _key(line: bytes) -> bytes:
    return blake2b(line, digest_size=16).digest()


def _buckets(words: list[bytes], buckets: int) -> list[int]:
    """Buckets of all runs of one to three words."""
    out = []
    crc = zlib.crc32
    ones = [crc(w) for w in words]
    spaced = [b" " + w for w in words[1:]]
    twos = [crc(w, c) for w, c in zip(spaced, ones)]
    threes = [crc(w, c) for w, c in zip(spaced[1:], twos)]
    for codes in (ones, twos, threes):
        out += [c % buckets for c in codes]
    return out


def _crossing(lines: list[list[bytes]], buckets: int) -> list[int]:
    """Buckets of the runs of two and three words that lie in more than one line."""
    words = list(chain.from_iterable(lines))
    twos, threes, end = [], set(), 0
    for line in lines[:-1]:
        end += len(line)
        twos.append(end - 1)
        threes.update((end - 2, end - 1))
    last = len(words) - LONGEST
    return [zlib.crc32(b" ".join(words[i : i + 2])) % buckets for i in twos] + [
        zlib.crc32(b" ".join(words[i : i + 3])) % buckets for i in sorted(threes) if 0 <= i <= last
    ]


def n_features(words: int) -> int:
    return sum(max(words - n, 0) for n in range(LONGEST))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_A_TIME):
            yield batch.slice(at, ROWS_AT_A_TIME)


def _lists(rows: list[list[int]]) -> pa.ListArray:
    """A column of lists of small numbers."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(rows), np.int32, offsets[-1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _lowered(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("binary").alias("text"))


def segmented(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``row, doc_id, n_words, crossing, lines``: buckets across lines, and the key of each line with its repeats."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words, crossing, keys, times, ends = [], [], [], [], [0]
            for text in batch.column(1):
                found = _lines(text.as_py())
                words.append(sum(map(len, found)))
                crossing.append(_crossing(found, buckets))
                own = Counter(_key(b" ".join(line)) for line in found)
                keys += own
                times += own.values()
                ends.append(len(keys))
            each = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(times, pa.int32())], ["line", "times"])
            lines = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)
            columns = [batch.column(0), pa.array(words, pa.int64()), _lists(crossing), lines]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "crossing", "lines"])

    schema = "doc_id long, n_words long, crossing array<int>, lines array<struct<line: binary, times: int>>"
    rows = _lowered(docs, "doc_id").mapInArrow(cut, schema)
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"))


def distinct_lines(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``line, occurrences, features``: each different line once, with the buckets of its n-grams."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            texts = list(held)
            arrays = [pa.array([_key(t) for t in texts], pa.binary()), pa.array(texts, pa.binary()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["line", "words", "n"])

        for batch in _slices(batches):
            for text in batch.column(0):
                for line in _lines(text.as_py()):
                    joined = b" ".join(line)
                    n = held.get(joined, 0)
                    if not n:
                        size += len(joined)
                    held[joined] = n + 1
                if size > HELD_BYTES:
                    yield rows()
                    held.clear()
                    size = 0
        if held:
            yield rows()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by line, so equal ones follow each other, also from batch to batch."""
        last, total, features = None, 0, []
        for batch in _slices(batches):
            lines, times, buckets_of = [], [], []
            keys, texts, numbers = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            for i, key in enumerate(keys):
                if key == last:
                    total += numbers[i]
                    continue
                if last is not None:
                    lines.append(last)
                    times.append(total)
                    buckets_of.append(features)
                last, total = key, numbers[i]
                features = _buckets(texts[i].as_py().split(b" "), buckets)
            yield made(lines, times, buckets_of)
        if last is not None:
            yield made([last], [total], [features])

    def made(lines: list[bytes], times: list[int], features: list[list[int]]) -> pa.RecordBatch:
        arrays = [pa.array(lines, pa.binary()), pa.array(times, pa.int64()), _lists(features)]
        return pa.RecordBatch.from_arrays(arrays, names=["line", "occurrences", "features"])

    once = _lowered(docs).mapInArrow(gather, "line binary, words binary, n long")
    together = once.repartition("line").sortWithinPartitions("line")
    return stored(together.mapInArrow(count, "line binary, occurrences long, features array<int>"))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of lists, and how many each row has."""
    lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    return lists.flatten().to_numpy(zero_copy_only=False), lengths


def bucket_counts(segments: DataFrame, lines: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all documents fall into each bucket."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            features, lengths = _flat(batch.column(0))
            if len(features):
                times = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), lengths)
                # Sums of whole numbers in doubles are exact up to 2 ** 53.
                sums += np.bincount(features, times, buckets).astype(np.int64)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())], names=["bucket", "n"])

    features = lines.select("features", "occurrences").unionAll(segments.select("crossing", F.lit(1).cast("long")))
    found = features.mapInArrow(total, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for bucket, n in found:
        counts[bucket] = n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of each bucket in thousandths, rounded down."""
    buckets = len(corpus)
    above = (target + 1.0) * (float(corpus.sum()) + buckets)
    below = (corpus + 1.0) * (float(target.sum()) + buckets)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def _summed(rows: DataFrame, column: str, gain: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns to keep, and the sum of the gains of each row's features as ``gain``."""
    types = dict(rows.dtypes)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, lengths = _flat(batch.column(0))
            ends = np.cumsum(lengths)
            sums = np.concatenate([[0], np.cumsum(gain[features])]) if len(features) else np.zeros(1, np.int64)
            own = sums[ends] - sums[ends - lengths]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(own, pa.int64())], names=[*keep, "gain"])

    schema = ", ".join([*(f"{c} {types[c]}" for c in keep), "gain long"])
    return rows.select(column, *keep).mapInArrow(add, schema)


def weights(segments: DataFrame, lines: DataFrame, gain: np.ndarray) -> DataFrame:
    """``row, doc_id, n_words, weight`` of each document."""
    line_gains = stored(_summed(lines, "features", gain, ["line", "occurrences"]))
    total = line_gains.agg(F.coalesce(F.sum("occurrences"), F.lit(0))).first()[0]
    is_heavy = F.col("occurrences") * HEAVY_SHARE > total
    parts = segments.select("row", F.inline("lines"))
    heavy = line_gains.filter(is_heavy).select("line", F.col("gain").alias("heavy_gain"))
    # Fewer than HEAVY_SHARE rows, whatever the size of the corpus.
    marked = parts.join(F.broadcast(heavy), "line", "left")
    light = marked.filter("heavy_gain IS NULL").select("row", "line", "times").join(line_gains.filter(~is_heavy), "line")
    own = light.select("row", (F.col("times") * F.col("gain")).alias("gain"))
    common = marked.filter("heavy_gain IS NOT NULL").select("row", (F.col("times") * F.col("heavy_gain")).alias("gain"))
    crossing = _summed(segments, "crossing", gain, ["row", "doc_id", "n_words"])
    nothing = [F.lit(None).cast("long").alias(c) for c in ("doc_id", "n_words")]
    rows = crossing.unionByName(own.unionByName(common).select("row", *nothing, "gain"))
    return rows.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("gain").alias("weight"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a digest of the id."""
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(seeded, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, share_of_100: int = DRAWN_OF_100, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank`` to the highest scores among rows with enough words.

    Rows are dealt out by ranges of score, id and row, so equal scores and ids
    are no hot key; a rank is the place in the range plus the sizes of all
    earlier ranges, one number per range.
    """
    spark = scored.sparkSession
    enough = F.col("n_words") >= min_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    ranges = stored(scored.filter(enough).repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    sizes = sorted(ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect())
    before, at = [], 0
    for number, n in sizes:
        before.append((number, at))
        at += n
    starts = F.broadcast(spark.createDataFrame(before, "range int, before long"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.col("before")
    ranked = ranges.join(starts, "range").withColumn("rank", place)
    drawn = at * share_of_100 // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long"))).drop("range", "before")
    return ranked.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; drawn ones have a rank."""
    segments, lines = segmented(docs, buckets), distinct_lines(docs, buckets)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    gain = gains(
        bucket_counts(segments, lines, buckets), bucket_counts(segmented(wanted, buckets), distinct_lines(wanted, buckets), buckets)
    )
    scored = weights(segments, lines, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    features = sum((F.greatest(F.col("n_words") - n, F.lit(0)) for n in range(1, LONGEST)), F.col("n_words"))
    return draw(stored(scored)).select("doc_id", features.cast("long").alias("n_features"), "weight", "score", "rank")
