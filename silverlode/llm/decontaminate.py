"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import SPACES, stored

SHINGLE = 5
SIMILARITY = (80, 100)
# Bits of a fingerprint are split into blocks. Of two fingerprints within the radius one block differs in RADIUS // BLOCKS
# bits at most, so probing all values that close finds every such pair.
BITS = 64
BLOCKS = 8
RADIUS = 23
# Shingles of all benchmark items that a task may hold; beyond this the first join shuffles.
BROADCAST_SHINGLES = 2_000_000


def lower_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), "")


def shingle_hashes(words: Column, width: int) -> Column:
    """Hash of each run of ``width`` words in order; empty for fewer words."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width)))


def fingerprint_blocks(hashes: Column) -> Column:
    """SimHash of a multiset of hashes as an array of ``BLOCKS`` numbers: each occurrence votes on each bit."""
    width = BITS // BLOCKS

    def bit(position: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, position))
        return F.when(ones * 2 >= F.size(hashes), 1).otherwise(0)

    def block(number: Column) -> Column:
        places = F.sequence(F.lit(0), F.lit(width - 1))
        return F.aggregate(places, F.lit(0), lambda total, i: total * 2 + bit(number * width + i))

    return F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), block)


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _near_masks() -> list[int]:
    """All differences of a block within its share of the radius."""
    return [m for m in range(1 << (BITS // BLOCKS)) if m.bit_count() <= RADIUS // BLOCKS]


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Items with words: their number of words, width of shingles, and shingle hashes in order.

    An item of fewer words than a shingle has one shingle of all its words.
    """
    words = lower_words(F.col("text").cast("string"))
    items = benchmark.select("item_id", words.alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("n", F.size("words")).withColumn("width", F.least("n", F.lit(SHINGLE)))
    hashes = F.coalesce(*[F.when(F.col("width") == w, shingle_hashes(F.col("words"), w)) for w in range(1, SHINGLE + 1)])
    return stored(items.select("item_id", "n", "width", hashes.alias("hashes")).distinct())


def leaked_passages(docs: DataFrame, benchmark: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """Benchmark items that a document contains: ``doc_id``, ``text_key``, ``item_id`` and the best window.

    A window has as many words as the item (or is the whole text, if shorter) and
    matches where the weighted similarity of their shingles, with the number of
    occurrences as weight, reaches ``part / whole``. Windows stand at all starts
    where they hold as many shingles of one item as a match needs, in any order;
    no other window can match. Their fingerprints are looked up by blocks,
    which finds every item within the radius; a similarity of 0.8 lies beyond it
    with a probability of about 1e-5.

    Null and empty texts and items match nothing; a null doc_id is reported as
    null; repeated rows are reported once; other columns are left out.
    """
    part, whole = similarity
    items = benchmark_items(benchmark)
    places = items.select("n", "width", F.explode("hashes").alias("hash"), "item_id").distinct()
    known = places.count()
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # SHINGLE numbers at most

    text = F.col("text").cast("string")
    parts = docs.select("doc_id", F.xxhash64(text).alias("text_key"), lower_words(text).alias("words"))

    def anchored(width: int) -> DataFrame:
        spots = parts.select(
            "doc_id", "text_key", F.size("words").alias("n_words"), F.posexplode(shingle_hashes(F.col("words"), width)).alias("spot", "hash")
        )
        of_width = places.filter(F.col("width") == width)
        found = spots.join(F.broadcast(of_width) if known <= BROADCAST_SHINGLES else of_width, "hash")
        found = found.groupBy("doc_id", "text_key", "item_id", "n", "width", "n_words").agg(F.array_sort(F.collect_set("spot")).alias("spots"))
        # Shingles of the item and of a window, and how many they must share.
        size = F.least("n", "n_words") - width + 1
        found = found.withColumn("size", size).withColumn(
            "need", F.ceil((F.col("n") - width + 1 + F.col("size")) * part / F.lit(whole + part)).cast("int")
        )
        return (
            found.filter(F.size("spots") >= F.col("need"))
            .select("doc_id", "text_key", "n", "width", F.explode(starts()).alias("start"))
            .distinct()
        )

    def starts() -> Column:
        """Starts of the windows that hold ``need`` of the ``spots``; each range has those whose first spot is the same."""

        def of_first(i: Column) -> Column:
            first, enough = F.get("spots", i), F.get("spots", i + F.col("need") - 1)
            before = F.coalesce(F.get("spots", i - 1), F.lit(-1))
            low = F.greatest(enough - F.col("size") + 1, before + 1)
            high = F.least(first, F.greatest(F.col("n_words") - F.col("n"), F.lit(0)))
            return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size("spots") - F.col("need")), of_first))

    none = docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, n int, width int, start int")
    anchors = reduce(DataFrame.unionByName, [anchored(w) for w in widths], none)
    per_doc = anchors.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("n", "width", "start")).alias("windows"))
    per_doc = stored(per_doc.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "windows"))

    # The texts with anchors once more, for the whole windows.
    again = parts.join(per_doc, (F.col("text_key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")))
    again = again.dropDuplicates(["doc_id", "text_key"]).withColumn("window", F.explode("windows"))
    own = F.slice("words", F.col("window.start") + 1, F.col("window.n"))
    windows = again.select("doc_id", "text_key", "window.*", own.alias("own"))
    hashes = F.coalesce(*[F.when(F.col("width") == w, shingle_hashes(F.col("own"), w)) for w in range(1, SHINGLE + 1)])
    windows = windows.select("doc_id", "text_key", "n", "start", hashes.alias("hashes"), F.monotonically_increasing_id().alias("window"))
    windows = stored(windows.withColumn("blocks", fingerprint_blocks(F.col("hashes"))))

    signed = stored(items.withColumn("blocks", fingerprint_blocks(F.col("hashes"))))
    probes = signed.select("item_id", "n", F.posexplode("blocks").alias("block", "value"), F.col("blocks").alias("item_blocks"), F.size("hashes").alias("item_size"))
    probes = probes.withColumn("mask", F.explode(F.array(*map(F.lit, _near_masks()))))
    probes = probes.select("item_id", "n", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), "item_blocks", "item_size")
    looked_up = windows.select("window", "n", F.posexplode("blocks").alias("block", "value"), "blocks", F.size("hashes").alias("window_size"))
    near = looked_up.join(probes, ["n", "block", "value"])
    near = near.select("window", "item_id", "window_size", "item_size", _distance(F.col("blocks"), F.col("item_blocks")).alias("distance"))
    near = near.filter(F.col("distance") <= RADIUS).distinct()

    in_items = items.select("item_id", F.explode("hashes").alias("hash")).groupBy("item_id", "hash").agg(F.count(F.lit(1)).alias("n_item"))
    in_windows = windows.select("window", F.explode("hashes").alias("hash")).groupBy("window", "hash").agg(F.count(F.lit(1)).alias("n_window"))
    shared = near.join(in_windows, "window").join(in_items, ["item_id", "hash"])
    shared = shared.groupBy("window", "item_id", "window_size", "item_size", "distance").agg(F.sum(F.least("n_item", "n_window")).alias("shared"))
    united = F.col("window_size") + F.col("item_size") - F.col("shared")
    alike = shared.filter(F.col("shared") * whole >= united * part).withColumn("similarity", F.col("shared") / united)

    best = F.max_by(F.struct("start", "n", "distance"), F.struct("similarity", -F.col("start"))).alias("best")
    found = alike.join(windows.select("window", "doc_id", "text_key", "start", "n"), "window")
    found = found.groupBy("doc_id", "text_key", "item_id").agg(F.max("similarity").alias("similarity"), best)
    return found.select(
        "doc_id", "text_key", "item_id", "similarity", F.col("best.start").alias("start_word"), F.col("best.n").alias("n_words"), F.col("best.distance").alias("distance")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, all columns kept.

    Null and empty texts stay. Rows with the same id, also a null one, and the same text share their fate.
    """
    leaks = leaked_passages(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key"))
    leaks = stored(leaks.distinct())
    # All columns in one, so that no name of theirs meets those of the leaks.
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    same = (F.xxhash64(F.col("row.text").cast("string")) == F.col("leak_key")) & F.col("row.doc_id").eqNullSafe(F.col("leak_id"))
    return rows.join(leaks, same, "left_anti").select("row.*")
