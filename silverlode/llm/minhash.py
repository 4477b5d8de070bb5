"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import stored
from silverlode.llm.groups import components

# At a similarity of 0.8 a pair shares no band with a probability of (1 - 0.8**ROWS) ** BANDS, about 1e-7.
ROWS = 5
BANDS = 40
SIMILARITY = (80, 100)
# About 150 bytes each stay in a worker while other steps use it; a hash is quickly made again.
CACHED_WORDS = 50_000
# Shingles are counted in so many slots (a power of two) to put rare ones first.
SLOT_BITS = 18
# Elements that a task signs at once.
CHUNK = 100_000
CACHED_SETS = 64
# Members that one text of a hub is compared with at most, on average.
SHARE_OF_HUB = 256

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers; one-to-one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text.

    Words are split at ASCII white space and compared with A-Z in lower case. A
    text with fewer words than a shingle has one shingle of all of them; without
    words there is none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size_used = min(size, len(words))
    total = np.zeros(len(words) - size_used + 1, np.uint64)
    for i in range(size_used):
        total = mixed(total * _MIX[0] + hashes[i : len(words) - size_used + 1 + i])
    return np.unique(total + np.uint64(size_used))


def super_minhash(elements: np.ndarray, owner: np.ndarray, sets: int, size: int) -> np.ndarray:
    """SuperMinHash signatures of many sets at once, as ``sets`` rows of ``size`` numbers.

    Each element walks through its own random permutation of the slots: in step j
    it offers the slot at place j the value j + r with a fresh random r. Values of
    step j are below those of step j + 1, so a set is finished as soon as all its
    slots have a value, mostly after few steps. Owners lie in 0 .. sets - 1.
    """
    signature = np.full(sets * size, _EMPTY, np.uint64)
    owner = owner.astype(np.int64)
    rows = places = None
    for step in range(size):
        random = mixed(elements + np.uint64((step + 1) * int(_STEP) % 2**64))
        pick = step + (((random & _LOW) * np.uint64(size - step)) >> np.uint64(32)).astype(np.int64)
        if places is None:
            slot = pick
        else:
            slot = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[rows, step]
            places[rows, step] = slot
        np.minimum.at(signature, owner * size + slot, (np.uint64(step) << np.uint64(32)) | (random >> np.uint64(32)))
        open_sets = (signature.reshape(sets, size) == _EMPTY).any(axis=1)
        active = open_sets[owner]
        if not active.any():
            break
        if places is None or not active.all():
            elements, owner = elements[active], owner[active]
            if places is None:
                places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.int32), (len(elements), 1))
                first = pick[active]
                rows = np.arange(len(elements))
                places[rows, first], places[rows, 0] = 0, first
            else:
                places = places[active]
                rows = np.arange(len(elements))
    return signature.reshape(sets, size)


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    total = np.tile(mixed(np.arange(1, bands + 1, dtype=np.uint64)), (len(signatures), 1))
    parts = signatures.reshape(len(signatures), bands, rows)
    for i in range(rows):
        total = mixed(total * _STEP + parts[:, :, i])
    return total.view(np.int64)


def _sketches(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):
                sets, total, start = [], 0, at
                while at < len(texts) and total < CHUNK:
                    sets.append(shingle_set(texts[at].as_py(), size))
                    total += len(sets[-1])
                    at += 1
                counts = np.array([len(s) for s in sets], np.int64)
                signed = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), counts), len(sets), bands * rows) if total else np.zeros((len(sets), bands * rows), np.uint64)
                hashes = [h if n else None for h, n in zip(band_hashes(signed, bands, rows).tolist(), counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, at - start),
                        batch.column(2).slice(start, at - start),
                        pa.array(counts, pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array(hashes, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "bands"],
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts move between tasks several times, so they are packed once."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pa.array([pack(text.as_py().encode()) for text in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["doc_id", "text_key", "text"])


def _set_of(packed: pa.Scalar, size: int) -> np.ndarray:
    return shingle_set(zstandard.decompress(packed.as_py()).decode(), size)


def _verified(size: int, similarity: tuple[int, int]):
    """Similar enough pairs (a, b), on full sets, of rows (hub, share, class, is_member, text).

    The hub of a share comes first and its members follow; both may be repeated.
    """
    part, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        hub, hub_set = None, None
        for batch in batches:
            smaller, larger = [], []
            hubs, classes, members = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i, (own_hub, own, is_member) in enumerate(zip(hubs, classes, members)):
                if own not in known:
                    if len(known) >= CACHED_SETS:
                        known.pop(next(iter(known)))
                    known[own] = _set_of(batch.column(4)[i], size)
                if not is_member:
                    hub, hub_set = own, known[own]
                    continue
                assert own_hub == hub
                shared = len(np.intersect1d(hub_set, known[own], assume_unique=True))
                if whole * shared >= part * (len(hub_set) + len(known[own]) - shared):
                    smaller.append(min(hub, own))
                    larger.append(max(hub, own))
            yield pa.RecordBatch.from_arrays([pa.array(smaller, pa.int64()), pa.array(larger, pa.int64())], names=["a", "b"])

    return run


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(_slots(_set_of(text, size)), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    return run


def _prefixes(size: int, similarity: tuple[int, int], frequency: np.ndarray):
    part, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, shingles, places, sizes = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                own = _set_of(text, size)
                own = own[np.lexsort((own, frequency[_slots(own)]))]
                first = own[: len(own) + part * len(own) // -whole + 1]
                owner.append(np.full(len(first), row, np.int32))
                shingles.append(first)
                places.append(np.arange(len(first)))
                sizes.append(np.full(len(first), len(own)))
            if not owner:
                continue
            rows = pa.array(np.concatenate(owner))
            numbers = [np.concatenate(shingles).view(np.int64), np.concatenate(places).astype(np.int64), np.concatenate(sizes).astype(np.int64)]
            columns = [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(3).take(rows), *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "root", "minor", "shingle", "place", "n"])

    return run


def _sharing_rare_shingles(apart: DataFrame, texts: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of classes of different groups that may be similar enough, one of them minor.

    Shingles are put in one order, rare ones first. Similar sets share one of their
    first ``n - part * n / whole + 1`` shingles, and from the first that they share
    enough others must follow in both. Every similar pair passes; versions of one
    text with many changes of their own do not meet. The order goes by counts in a
    fixed number of slots, which are all that reaches the driver.
    """
    part, whole = similarity
    rows = apart.join(texts, "class").select("class", "root", "text", "minor")
    counted = rows.select("text").mapInArrow(_slot_counts(size), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    frequency = np.zeros(1 << SLOT_BITS, np.int64)
    for row in counted.collect():  # 2 ** SLOT_BITS rows at most
        frequency[row["slot"]] = row["n"]
    schema = "class long, root long, minor boolean, shingle long, place long, n long"
    first = stored(rows.mapInArrow(_prefixes(size, similarity, frequency), schema))
    own = first.filter("minor").select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("class", "root", "place", "n")])
    following = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))
    possible = following * (part + whole) >= part * (F.col("n") + F.col("n_b"))
    met = first.join(own, (first["shingle"] == own["shingle"]) & (F.col("root") != F.col("root_b")) & possible)
    return met.select(F.least("class", "class_b").alias("a"), F.greatest("class", "class_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, size: int, similarity: tuple[int, int] = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Groups of documents whose shingle sets are linked, one row per row of ``docs``.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id that
    links reach, itself included) and ``kept`` (that id is its own). Two documents
    are linked where ``whole * shared >= part * united`` for ``similarity = (part,
    whole)``. Null, empty and blank texts have no shingles and no links. A null
    doc_id takes part in links but is not a component_id while its group has ids;
    in a group without ids all rows are kept. Repeated rows get the same values.

    Equal sets are one class from the start, whatever the number of copies, so all
    further work is on different sets. In each band that classes share, all are first
    compared with two of them; classes that these links leave apart then meet those
    with which they share rare enough shingles, so no pair is left out that could join
    two groups, and pairs within a group are not made. Candidates are confirmed on full sets.
    """
    part, whole = similarity
    id_type = docs.schema["doc_id"].dataType
    text = F.col("text").cast("string")
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("text_key", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    rows_in = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    sketches = stored(rows_in.mapInArrow(_sketches(size, bands, rows), schema))
    classes = (
        sketches.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("smallest"),
            F.min(F.struct("doc_id", "text_key")).alias("sample"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
        .withColumn("class", F.monotonically_increasing_id())
    )
    classes = stored(classes)

    # Bands that several classes share, with the classes that stand in them.
    in_bands = classes.select("class", F.explode("bands").alias("band"))
    shared = in_bands.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    members = stored(in_bands.join(shared, "band"))

    near_size = (whole * F.least("n", "n_b") >= part * F.greatest("n", "n_b"))
    sizes = classes.select(F.col("class").alias("b"), F.col("n").alias("n_b"))
    met = [members.select("class", F.col(end).alias("hub")).filter(F.col("class") != F.col("hub")) for end in ("low", "high")]
    pivots = met[0].unionByName(met[1]).groupBy(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
    pivots = pivots.agg(F.min("hub").alias("hub"))

    # One text of each class that has a candidate.
    wanted = members.select("class").distinct().join(classes.select("class", "sample"), "class")
    packed = rows_in.select("doc_id", "text_key", "text").filter("text IS NOT NULL")
    packed = packed.mapInArrow(_packed, T.StructType([schema["doc_id"], schema["text_key"], T.StructField("text", T.BinaryType())]))
    texts = packed.join(
        wanted.select("class", F.col("sample.doc_id").alias("sample_id"), F.col("sample.text_key").alias("sample_key")),
        (F.col("text_key") == F.col("sample_key")) & F.col("doc_id").eqNullSafe(F.col("sample_id")),
    )
    texts = stored(texts.select("class", "text"))

    def verify(pairs: DataFrame) -> DataFrame:
        """The text of a hub goes once to each share of the classes that it is compared with."""
        pairs = stored(pairs.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("member")))
        shares = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SHARE_OF_HUB).alias("shares"))
        share = F.pmod(F.xxhash64("member"), F.col("shares")).cast("int").alias("share")
        asked = stored(pairs.join(shares, "hub").select("hub", share, "member"))
        rows = asked.select("hub", "share", F.col("member").alias("class"), F.lit(True).alias("is_member")).unionByName(
            asked.select("hub", "share", F.col("hub").alias("class"), F.lit(False).alias("is_member")).distinct()
        )
        full = rows.join(texts, "class").select("hub", "share", "class", "is_member", "text")
        dealt = full.repartition("hub", "share").sortWithinPartitions("hub", "share", "is_member")
        # A repeated row of the input gives its pairs once more, which changes no group.
        return stored(dealt.mapInArrow(_verified(size, similarity), "a long, b long"))

    sized = pivots.join(classes.select(F.col("class").alias("a"), "n"), "a").join(sizes, "b").filter(near_size)
    links = verify(sized.select("a", "b", "hub"))
    found = components(links)

    # Members of the largest group of a band need no comparison with each other; all others meet everyone of another group.
    grouped = members.select("band", "class").join(found, F.col("class") == F.col("node"), "left")
    grouped = grouped.select("band", "class", F.coalesce("root", "class").alias("root"))
    per_group = grouped.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = per_group.groupBy("band").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("groups"))
    unsettled = stored(grouped.join(largest.filter("groups > 1"), "band").select("class", "root", (F.col("root") != F.col("main")).alias("minor")))
    apart = stored(unsettled.groupBy("class", "root").agg(F.max("minor").alias("minor")))
    rest = _sharing_rare_shingles(apart, texts, size, similarity)
    found = components(links.unionByName(verify(rest.withColumn("hub", F.col("a")))))

    known = classes.select("set_key", "class", "smallest").join(found, F.col("class") == F.col("node"), "left")
    known = known.select("set_key", "smallest", F.coalesce("root", "class").alias("root"))
    group_ids = known.groupBy("root").agg(F.min("smallest").alias("group_id"))
    of_set = known.join(group_ids, "root").select("set_key", "group_id")
    result = sketches.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("group_id")).otherwise(F.col("doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
