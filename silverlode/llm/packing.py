"""Packing tokenised documents into sequences of fixed capacity."""

from __future__ import annotations

import json
import unicodedata
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import shuffle_partitions, stored

CAPACITY = 2048
END_ID = 0
# What a Python worker keeps: words that are split one by one, about 200 bytes each, and parts of words, about 40.
CACHED_WORDS = 30_000
CACHED_PARTS = 250_000
# What a word may not hold if it is split with all others at once: special tokens, white space of two bytes, and a
# letter whose lower case is two.
NOT_PLAIN = ("<|", "\u0085", "\u00a0", "\u0130")
# Bytes of text that a task splits into words at once: so many at least if it has them, and twice as many at most, or one text.
TEXT_AT_ONCE = 2_000_000
# Parts of words that the tokenizer gets at once; it needs a kilobyte for each.
PARTS_AT_ONCE = 10_000
# A plan has a few runs for each length at most; beyond this it is joined by a shuffle.
BROADCAST_RUNS = 200_000


def _chained(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed ids behind each other, and where each value begins, with the end."""
    ends = np.cumsum(np.fromiter(map(len, values), np.int64, len(values))) // 4
    return np.frombuffer(b"".join(values), "<u4"), np.concatenate([[0], ends])


def _picked(ids: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the ``wanted`` values behind each other, and where each begins, with the end."""
    first, size = starts[wanted], np.diff(starts)[wanted]
    begins = np.concatenate([[0], np.cumsum(size)])
    return ids[np.arange(begins[-1]) + np.repeat(first - begins[:-1], size)], begins


def _places(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array without nulls, and where each string begins, with the end."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


class PartIds:
    """Token ids of parts of words. Those asked for lately are kept as flat arrays, of which half go when there are too many."""

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int) -> None:
        self._encode = encode
        self._most = most
        self._names = pa.array([], pa.string())
        self._ids, self._starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self._asked = np.zeros(0, np.int64)
        self._time = 0

    def of(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different parts behind each other, and where each begins, with the end."""
        self._time += 1
        place = pc.index_in(parts, value_set=self._names)
        if place.null_count:
            new = place.is_null()
            place = place.fill_null(0).to_numpy().copy()
            place[new.to_numpy(zero_copy_only=False)] = len(self._names) + np.arange(pc.sum(new).as_py())
            names = parts.filter(new)
            ids, starts = self._encode(names)
            self._names = pa.concat_arrays([self._names, names])
            self._starts = np.concatenate([self._starts, starts[1:] + len(self._ids)])
            self._ids = np.concatenate([self._ids, ids])
            self._asked = np.concatenate([self._asked, np.zeros(len(names), np.int64)])
        else:
            place = place.to_numpy()
        self._asked[place] = self._time
        found = _picked(self._ids, self._starts, place)
        if len(self._names) > self._most:
            kept = np.sort(np.argsort(-self._asked, kind="stable")[: self._most // 2])
            self._names, self._asked = self._names.take(pa.array(kept)), self._asked[kept]
            self._ids, self._starts = _picked(self._ids, self._starts, kept)
        return found


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers.

    For tokenizers that drop white space and never merge across it, the ids of a
    text are those of its words in order. Each different word of some megabytes of
    text is treated once. It is split further by the pattern of the tokenizer, and
    new parts are encoded together: the last id of each part is marked as the end
    of a word in the vocabulary, so the ids fall apart by part. The ids of parts
    met lately are remembered. Words with characters beyond U+02FF, whose lower case
    and composed form may not be plain, are split one by one; those that hold the
    text of a special token go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._words: dict[str, bytes] = {}
        self._parts = PartIds(self._of_parts, CACHED_PARTS)
        self._pattern = None
        described = json.loads(self._tokenizer.to_str())
        suffix = described["model"].get("end_of_word_suffix")
        steps = (described.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = steps[0].get("pattern", {}).get("Regex")
        kinds = [n["type"] for n in (described.get("normalizer") or {}).get("normalizers", [])]
        if suffix and pattern and steps[0].get("invert") and kinds == ["NFC", "Replace", "Lowercase"]:
            self._pattern = regex.compile(pattern)
            vocabulary = self._tokenizer.get_vocab()
            self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self._ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _split(self, word: str) -> list[str] | None:
        if self._pattern is None or "<|" in word:
            return None
        lower = word.lower()
        if not word.isascii() and (
            len(lower) != len(word) or max(word) >= "\u2000" or "Σ" in word or not unicodedata.is_normalized("NFC", word)
        ):
            return None
        return [lower] if lower.isalpha() else self._pattern.findall(lower)

    def _of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        names = parts.to_pylist()
        some = [self._encode(" ".join(names[at : at + PARTS_AT_ONCE])) for at in range(0, len(names), PARTS_AT_ONCE)]
        ids = np.concatenate(some or [np.zeros(0, "<u4")])
        starts = np.concatenate([[0], np.flatnonzero(self._ends[ids]) + 1])
        if len(starts) != len(parts) + 1:
            raise ValueError("the parts of words do not end where the tokenizer ends them")
        return ids, starts

    def _learn(self, words: list[str]) -> None:
        """Words that are split one by one."""
        if len(self._words) > CACHED_WORDS:
            self._words.clear()
        split = {word: self._split(word) for word in words}
        parts = list(dict.fromkeys(part for found in split.values() for part in found or ()))
        ids, starts = self._parts.of(pa.array(parts, pa.string()))
        packed, bounds = ids.tobytes(), (4 * starts).tolist()
        known = {part: packed[low:high] for part, low, high in zip(parts, bounds, bounds[1:])}
        for word, found in split.items():
            self._words[word] = self._encode(word).tobytes() if found is None else b"".join(map(known.__getitem__, found))

    def _of_other_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self._words.get, words))
        if None in found:
            # What is known so far may be forgotten meanwhile, but stays here.
            self._learn([w for w, f in zip(words, found) if f is None])
            found = [self._words[w] if f is None else f for w, f in zip(words, found)]
        return _chained(found)

    def _is_plain(self, words: pa.Array) -> np.ndarray:
        """Which words lower and split alike in any library: above white space, up to U+02FF, without a few characters."""
        data, at = _places(words)
        plain = np.zeros(len(words), bool)
        filled = np.flatnonzero(np.diff(at))
        if self._pattern is None or not len(filled):
            return plain
        # Strings without length have no place of their own; the others follow each other.
        data = data[: at[-1]]
        plain[filled] = (np.maximum.reduceat(data, at[filled]) < 0xCC) & (np.minimum.reduceat(data, at[filled]) > 0x20)
        for left_out in NOT_PLAIN:
            plain &= ~pc.match_substring(words, left_out).to_numpy(zero_copy_only=False)
        return plain

    def _of_plain_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lower = pa.array(["\n".join(words.to_pylist()).lower()])
        marked = pc.replace_substring_regex(lower, self._pattern.pattern, "\\0 ")[0].as_py()
        lists = pc.split_pattern(pa.array(marked[:-1].split(" \n")), " ")
        coded = lists.flatten().dictionary_encode()
        ids, begins = _picked(*self._parts.of(coded.dictionary), coded.indices.to_numpy())
        return ids, begins[lists.offsets.to_numpy()]

    def ids_of(self, texts: pa.Array) -> Iterator[bytes]:
        """Packed ids of each text, a few megabytes of text at a time."""
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())])
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + 2 * TEXT_AT_ONCE, "right")) - 1)
            lists = pc.ascii_split_whitespace(texts.slice(at, end - at).cast(pa.string()).fill_null(""))
            coded = lists.flatten().dictionary_encode()
            plain = self._is_plain(coded.dictionary)
            others = coded.dictionary.filter(pa.array(~plain)).to_pylist()
            ids, begins = self._of_other_words(others)
            if plain.any():
                plain_ids, plain_begins = self._of_plain_words(coded.dictionary.filter(pa.array(plain)))
                begins = np.concatenate([begins, plain_begins[1:] + len(ids)])
                ids = np.concatenate([ids, plain_ids])
            # Other words come first, then plain ones.
            place = np.where(plain, len(others) + np.cumsum(plain) - 1, np.cumsum(~plain) - 1)
            ids, begins = _picked(ids, begins, place[coded.indices.to_numpy()])
            bounds = (4 * begins[lists.offsets.to_numpy()]).tolist()
            packed = ids.tobytes()
            yield from (packed[low:high] for low, high in zip(bounds, bounds[1:]))
            at = end


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with some megabytes of text, as each different word of a batch costs once."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.nbytes for b in waiting) >= TEXT_AT_ONCE:
            yield pa.concat_batches(waiting)
            waiting = []
    if waiting:
        yield pa.concat_batches(waiting)


_cached: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _cached:
        _cached[path] = WordIds(path)
    return _cached[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Each document as token ids with an end id, cut into pieces only where longer than the capacity.

    Null text counts as empty and gives the end id alone. ``keep_ids`` adds the
    ids themselves, 32 bits each.
    """
    id_type = docs.schema["doc_id"].dataType
    fields = [
        T.StructField("doc_id", id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _word_ids(tokenizer)
        end = END_ID.to_bytes(4, "little")
        width = 4 * capacity
        for batch in _together(batches):
            # Pieces of document number `owner` of the batch.
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, ids in enumerate(memory.ids_of(batch.column(1))):
                ids += end
                for number, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    owner.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(part)
            columns = [
                batch.column(0).take(pa.array(owner, pa.int32())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        # The worker may go on with another step, for which these buffers must not stay.
        pa.default_memory_pool().release_unused()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, T.StructType(fields))


class Run(NamedTuple):
    """Items ``first_rank ..`` of one length: ``per_bin`` of them in each bin from ``first_bin`` on."""

    length: int
    first_rank: int
    items: int
    first_bin: int
    per_bin: int
    offset: int


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[Run]:
    """Where the items of each length go, from the number of items of each length alone.

    Items above a third of the capacity come first: at most two share a bin, the
    longest open one with the longest that still fits. Smaller items, longest
    first, go into the smallest gap that holds them. Whole runs of equal bins
    are treated at once, so the work depends on the capacity, not on the items.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    placed = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free space -> (first bin, bins)
    bins = 0

    def put(length: int, items: int, first_bin: int, per_bin: int, offset: int) -> None:
        runs.append(Run(length, placed[length], items, first_bin, per_bin, offset))
        placed[length] += items
        left[length] -= items

    def leave(gap: int, first_bin: int, n: int) -> None:
        if gap and n:
            gaps.setdefault(gap, []).append((first_bin, n))

    large = sorted(length for length in left if 3 * length > capacity)
    for length in reversed(large):
        while left[length]:
            place = bisect_left(large, capacity - length + 1)
            partner = next((p for p in reversed(large[:place]) if left[p] and (p != length or left[p] > 1)), None)
            if partner is None:
                n = left[length]
                put(length, n, bins, 1, 0)
                leave(capacity - length, bins, n)
            else:
                n = left[length] // 2 if partner == length else min(left[length], left[partner])
                put(length, n, bins, 1, 0)
                put(partner, n, bins, 1, length)
                leave(capacity - length - partner, bins, n)
            bins += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            gap = min((g for g in gaps if g >= length), default=None)
            if gap is None:
                gap = capacity
                n = -(-left[length] // (capacity // length))
                first = bins
                bins += n
            else:
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            per_bin = gap // length
            full = min(n, left[length] // per_bin)
            if full:
                put(length, full * per_bin, first, per_bin, capacity - gap)
                leave(gap - per_bin * length, first, full)
            rest = left[length]
            if full < n and 0 < rest < per_bin:
                put(length, rest, first + full, rest, capacity - gap)
                leave(gap - rest * length, first + full, 1)
                full += 1
            leave(gap, first + full, n - full)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to the capacity.

    Only the number of pieces of each length (at most ``capacity`` numbers)
    reaches the driver. A piece finds its place by its rank among the pieces of
    its length, counted within hash buckets and then over buckets, so that a
    length that most pieces share is still ranked by many tasks. An empty table
    gives an empty result.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    buckets = shuffle_partitions(spark)
    items = stored(pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))))
    per_bucket = items.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = plan_bins(counts, capacity)

    # One row per length and bucket: how many pieces of the length lie in earlier buckets.
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    keys = [c for c in ("doc_id", "piece", "ids_crc32") if c in columns]
    within = Window.partitionBy("length", "_bucket").orderBy(*keys)
    ranked = items.withColumn("_within", F.row_number().over(within) - 1).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_within") + F.col("_before"))

    schema = "_length long, _first long, _items long, _bin long, _per long, _offset long"
    places = spark.createDataFrame([tuple(r) for r in runs], schema)
    if len(runs) <= BROADCAST_RUNS:
        places = F.broadcast(places)
    at = F.col("_rank") - F.col("_first")
    return ranked.join(
        places,
        (F.col("length") == F.col("_length")) & (at >= 0) & (at < F.col("_items")),
    ).select(
        *columns,
        (F.col("_bin") + F.floor(at / F.col("_per")).cast("long")).alias("sequence_id"),
        (F.col("_offset") + at % F.col("_per") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences as large-item matching and best fit give.

    Null and empty texts are one end mark. Null and repeated ids are pieces of their own; which of equal pieces goes
    to which sequence is open, as is the order of pieces of one length. Further columns of ``docs`` are left out.
    """
    return pack(token_pieces(docs, tokenizer, capacity, keep_ids), capacity)
