"""Repeated passages: every byte covered by a string of fixed length that also starts elsewhere is removed."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import shuffle_partitions, stored
from silverlode.llm.induced import common_prefixes, suffix_order
from silverlode.llm.minhash import mixed

LENGTH = 200
# Bytes of an anchor; every string of LENGTH bytes holds one that is chosen by its own bytes alone.
ANCHOR = 150
REACH = LENGTH - ANCHOR
# Bytes of documents in a block, and of those that a task hashes at once.
BLOCK_BYTES = 12_000_000
CHUNK_BYTES = 250_000

# Bytes of documents whose anchors are one part, so that a part is small next to a task's memory at every size.
PART_BYTES = 2_000_000
# Contexts that one task puts in suffix order, and contexts of one anchor from which they are dealt by whole strings.
SHARD_CONTEXTS = 10_000
HOT_CONTEXTS = 5_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

# What becomes of a context: seen once and to be compared, seen several times and to be compared by this block, or decided;
# and the first two for contexts of a hot anchor.
COMPARE, REPEATED_COMPARE, REPEATED, ALONE, SPLIT, REPEATED_SPLIT = range(6)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:size], _powers[1][:size]


def _sliding(pick, values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` neighbouring values."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of documents laid end to end: place, bounds of the context, hash of the anchor and of its context.

    Of the ANCHOR-byte strings in each string of LENGTH bytes those with the smallest
    hash are anchors, so equal strings have their anchors at equal places. The
    context reaches REACH bytes to both sides, within the document.
    """
    width = REACH + 1
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * power[: len(data)], dtype=np.uint64, out=sums[1:])
    found_at, low, high, own = [], [], [], []
    for start, length in zip(starts.tolist(), lengths.tolist()):
        if length < LENGTH:
            continue
        first = np.arange(start, start + length - ANCHOR + 1)
        hashes = mixed((sums[first + ANCHOR] - sums[first]) * inverse[first])
        least = _sliding(np.minimum, hashes, width)
        border = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(hashes == _sliding(np.maximum, np.concatenate([border, least, border]), width))
        found_at.append(start + chosen)
        low.append(start + np.maximum(chosen - REACH, 0))
        high.append(start + np.minimum(chosen + LENGTH, length))
        own.append(hashes[chosen])
    if not found_at:
        empty = np.zeros(0, np.int64)
        return empty, np.zeros((0, 2), np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at, lo, hi = map(np.concatenate, (found_at, low, high))
    context = mixed((sums[hi] - sums[lo]) * inverse[lo] + mixed(((at - lo) * 4096 + hi - at).astype(np.uint64)))
    return at, np.stack([lo, hi], axis=1), np.concatenate(own), context


def _anchors_of_long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchors`` of one document in pieces, each with all bytes that decide its own places."""
    pieces = []
    for first in range(0, max(len(data), 1), CHUNK_BYTES):
        base = max(first - REACH, 0)
        end = min(first + CHUNK_BYTES, len(data))
        piece = data[base : end + LENGTH]
        at, bounds, own, context = anchors(piece, np.zeros(1, np.int64), np.array([len(piece)]))
        inside = (at + base >= first) & (at + base < end)
        pieces.append((at[inside] + base, bounds[inside] + base, own[inside], context[inside]))
    return tuple(np.concatenate(x) for x in zip(*pieces))


class Block:
    """Documents laid end to end, with their anchors grouped by context and dealt to parts."""

    def __init__(self, row: pd.Series, parts: int) -> None:
        self.number = int(row["block"])
        self.doc_ids = list(row["doc_ids"])
        self.lengths = _unpacked(row["lengths"], np.int64)
        self.data = _unpacked(row["data"], np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        pieces = []
        at = 0
        while at < len(self.lengths):
            end = int(np.searchsorted(self.starts, self.starts[at] + CHUNK_BYTES))
            # A document that does not fit in a chunk is one of its own.
            end = max(end - (end > at + 1 and self.starts[end - 1] + self.lengths[end - 1] > self.starts[at] + CHUNK_BYTES), at + 1)
            base = self.starts[at]
            part = slice(at, end)
            data = self.data[base : base + self.lengths[part].sum()]
            if end == at + 1:
                found = _anchors_of_long(data)
            else:
                found = anchors(data, self.starts[part] - base, self.lengths[part])
            pieces.append((found[0] + base, found[1] + base, found[2], found[3]))
            at = end
        self.at, self.bounds, own, context = (np.concatenate(x) for x in zip(*pieces))
        # Contexts of the block in the order of anchor and context hash; `of_anchor` leads from each anchor to its own.
        order = np.lexsort((context, own))
        new = np.ones(len(order), bool)
        new[1:] = (own[order][1:] != own[order][:-1]) | (context[order][1:] != context[order][:-1])
        self.of_anchor = np.empty(len(order), np.int64)
        self.of_anchor[order] = np.cumsum(new) - 1
        self.sample = order[new]
        self.times = np.diff(np.append(np.flatnonzero(new), len(order)))
        self.own, self.context = own[self.sample], context[self.sample]
        part_of = ((self.own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.searchsorted(part_of, np.arange(parts + 1))
        self.slices = [slice(cuts[p], cuts[p + 1]) for p in range(parts)]

    def shards(self, fates: np.ndarray, shares: dict[int, int]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Part, shard and contexts that are put in suffix order there, part by part."""
        for part, where in enumerate(self.slices):
            own = where.start + np.flatnonzero((fates[where] == COMPARE) | (fates[where] == REPEATED_COMPARE))
            if len(own):
                shard = (self.own[own] & np.uint64(0xFFFFFFFF)) % np.uint64(shares[part])
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
                for chosen in np.split(own[order], cuts[1:]):
                    yield part, int(shard[np.searchsorted(own, chosen[0])]), chosen

    def strings(self, fates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Strings around hot anchors: their different digests in order, how often each stands here, and of each string its context, start before the anchor and digest.

        The start is part of the digest: a string found by two anchors is one place for each of them.
        """
        contexts, back, digests = [], [], []
        for c in np.flatnonzero((fates == SPLIT) | (fates == REPEATED_SPLIT)).tolist():
            at, (low, high) = int(self.at[self.sample[c]]), self.bounds[self.sample[c]].tolist()
            text = self.data[low:high].tobytes()
            for k in range(max(0, LENGTH - (high - at)), min(at - low, REACH) + 1):
                begin = at - k - low
                digests.append(xxhash.xxh3_128_digest(text[begin : begin + LENGTH], seed=k))
                contexts.append(c)
                back.append(k)
        keys = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)
        order, new = _in_order(keys)
        which = np.empty(len(keys), np.int64)
        which[order] = np.cumsum(new) - 1
        times = np.bincount(which, minlength=int(new.sum()))
        return keys[order[new]], times, np.array(contexts, np.int64), np.array(back, np.uint64), which


def _in_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys of two numbers, and where in that order a new one begins."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]).any(axis=1)
    return order, new


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids: list = []
    texts: list[bytes] = []
    size = 0
    id_type = None

    def row() -> pa.RecordBatch:
        lengths = np.array([len(t) for t in texts], np.int64)
        values = [[number], [ids], [_packed(lengths)], [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))], [size]]
        kinds = [pa.int64(), pa.list_(id_type), pa.binary(), pa.binary(), pa.int64()]
        names = ["block", "doc_ids", "lengths", "data", "size"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    for batch in batches:
        id_type = batch.column(0).type
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append((text.as_py() or "").encode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield row()
                ids, texts, size, number = [], [], 0, number + 1
    if ids:
        yield row()


def _context_requests(parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, row in rows.iterrows():
                block = Block(row, parts)
                filled = [(part, s) for part, s in enumerate(block.slices) if s.stop > s.start]
                yield pd.DataFrame(
                    {
                        "part": np.array([part for part, _ in filled], np.int32),
                        "block": block.number,
                        "own": [_packed(np.diff(block.own[s], prepend=np.uint64(0))) for _, s in filled],
                        "context": [_packed(block.context[s]) for _, s in filled],
                        "times": [_packed(np.minimum(block.times[s], 2).astype(np.uint8)) for _, s in filled],
                    }
                )

    return run


def _judge_contexts(hot: int, shard: int):
    """Whether each context occurs elsewhere, and whether its anchor stands in other contexts too, or in very many."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = [np.cumsum(_unpacked(o, np.uint64), dtype=np.uint64) for o in rows["own"]]
        ends = np.cumsum([len(o) for o in own])
        anchor = np.concatenate(own)
        context = np.concatenate([_unpacked(c, np.uint64) for c in rows["context"]])
        times = np.concatenate([_unpacked(t, np.uint8) for t in rows["times"]])
        order = np.lexsort((context, anchor))
        anchor, context, times = anchor[order], context[order], times[order]
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new = new_anchor | np.append(True, context[1:] != context[:-1])
        group = np.cumsum(new) - 1
        again = np.bincount(group, times)[group] > 1
        anchor_group = np.cumsum(new_anchor) - 1
        different = np.bincount(anchor_group, new)[anchor_group]
        chosen = np.where(different > hot, SPLIT, COMPARE)
        once = np.where(different > 1, chosen, ALONE)
        fates = np.empty(len(order), np.uint8)
        fates[order] = np.where(again, np.where((different > 1) & new, chosen + 1, REPEATED), once)
        share = int(((fates == COMPARE) | (fates == REPEATED_COMPARE)).sum()) // shard + 1
        return pd.DataFrame(
            {
                "block": rows["block"].to_numpy(),
                "part": int(rows["part"].iloc[0]),
                "shard": share,
                "kind": "fates",
                "answer": [_packed(fates[e - len(o) : e]) for o, e in zip(own, ends)],
            }
        )

    return run


def _answers(answers: pd.DataFrame, kind: str, dtype) -> np.ndarray:
    own = answers[answers["kind"] == kind].sort_values(["part", "shard"])
    return np.concatenate([_unpacked(a, dtype) for a in own["answer"]] or [np.zeros(0, dtype)])


def _fates(answers: pd.DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Fates of the contexts of a block, and the number of shards of each of its parts."""
    own = answers[answers["kind"] == "fates"]
    return _answers(answers, "fates", np.uint8), dict(zip(own["part"].tolist(), own["shard"].tolist()))


def _comparison_requests(parts: int):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(blocks.iloc[0], parts)
        fates, shares = _fates(answers)
        rows = []
        for part, shard, contexts in block.shards(fates, shares):
            chosen = block.sample[contexts]
            low, at, high = block.bounds[chosen, 0], block.at[chosen], block.bounds[chosen, 1]
            pieces = [block.data[a:b] for a, b in zip(low, at)] + [block.data[a + ANCHOR : b] for a, b in zip(at, high)]
            second = np.fromiter((xxhash.xxh3_64_intdigest(block.data[a : a + ANCHOR].tobytes()) for a in at), np.uint64, len(at))
            rows.append(
                (
                    "masks",
                    part,
                    shard,
                    block.number,
                    _packed(block.own[contexts]),
                    _packed(second),
                    _packed((at - low).astype(np.uint8)),
                    _packed((high - at - ANCHOR).astype(np.uint8)),
                    _packed(np.concatenate(pieces)),
                )
            )
        keys, times, *_ = block.strings(fates)
        part_of = ((keys[:, 0] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.flatnonzero(np.append(True, np.diff(part_of) != 0)) if len(keys) else np.zeros(0, np.int64)
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
            counts = _packed(np.minimum(times[begin:end], 2).astype(np.uint8))
            part = int(part_of[begin])
            rows.append(("strings", part, 0, block.number, _packed(keys[begin:end, 0]), _packed(keys[begin:end, 1]), counts, None, None))
        return pd.DataFrame(rows, columns=["kind", "part", "shard", "block", "own", "second", "before", "after", "data"])

    return run


def _starts_of_repeats(anchor: np.ndarray, before: np.ndarray, after: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each context a bit mask of the starts, counted back from its anchor, of strings that also stand in another one.

    Contexts become one string: their bytes, with a number for the whole anchor in
    the middle, each ended by a number of its own kind. Its suffixes are put in
    order by induced sorting; a string of LENGTH bytes is REACH + 1 symbols there
    and repeats where a neighbour in order shares as many.
    """
    n = len(anchor)
    if not n:
        return np.zeros(0, np.uint64)
    sizes = before + after + 2
    ends = np.cumsum(sizes)
    begins = ends - sizes
    text = np.empty(ends[-1] + 1, np.int64)
    middle = np.zeros(len(text), bool)
    middle[begins + before] = True
    middle[ends - 1] = True
    middle[-1] = True
    # `data` has all bytes before anchors, then all after them.
    side = np.zeros(len(text), np.int8)
    side[begins] += 1
    side[begins + before] -= 1
    left = np.cumsum(side).astype(bool) & ~middle
    text[left] = data[: before.sum()].astype(np.int64) + 2
    text[~left & ~middle] = data[before.sum() :].astype(np.int64) + 2
    text[begins + before] = anchor + 258
    text[ends - 1] = 1
    text[-1] = 0
    with tempfile.TemporaryDirectory() as folder:
        order = suffix_order(text, folder)
    symbols = REACH + 1
    # Strings of the full length begin so many symbols before the end of their context, at the anchor or before.
    whole = np.zeros(len(text), bool)
    for k in range(symbols):
        fits = (before >= k) & (after >= REACH - k)
        whole[begins[fits] + before[fits] - k] = True
    prefix = common_prefixes(text, order, symbols, whole)
    shared = np.zeros(len(text), bool)
    both = np.flatnonzero(prefix >= symbols)
    shared[order[both]] = True
    shared[order[both - 1]] = True
    # Bit k: the string that starts k bytes before the anchor.
    masks = np.zeros(n, np.uint64)
    for k in range(symbols):
        fits = (before >= k) & (after >= REACH - k)
        place = begins[fits] + before[fits] - k
        masks[fits] |= shared[place].astype(np.uint64) << np.uint64(k)
    return masks


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Which strings of a shard repeat: contexts by suffix order, strings of hot anchors by their digests."""
    kind = rows["kind"].iloc[0]
    ends, found = (_compare_contexts if kind == "masks" else _compare_strings)(rows)
    answers = [_packed(part) for part in np.split(found, ends[:-1])]
    place = {"part": int(rows["part"].iloc[0]), "shard": int(rows["shard"].iloc[0])}
    return pd.DataFrame({"block": rows["block"].to_numpy(), **place, "kind": kind, "answer": answers})


def _compare_strings(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    first = [_unpacked(o, np.uint64) for o in rows["own"]]
    keys = np.stack([np.concatenate(first), np.concatenate([_unpacked(s, np.uint64) for s in rows["second"]])], axis=1)
    times = np.concatenate([_unpacked(t, np.uint8) for t in rows["before"]])
    order, new = _in_order(keys)
    group = np.cumsum(new) - 1
    again = np.empty(len(keys), np.uint8)
    again[order] = np.bincount(group, times[order])[group] > 1
    return np.cumsum([len(o) for o in first]), again


def _compare_contexts(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    own = [_unpacked(o, np.uint64) for o in rows["own"]]
    before = [_unpacked(b, np.uint8).astype(np.int64) for b in rows["before"]]
    after = [_unpacked(a, np.uint8).astype(np.int64) for a in rows["after"]]
    data = [_unpacked(d, np.uint8) for d in rows["data"]]
    both = np.empty(sum(map(len, own)), [("own", np.uint64), ("second", np.uint64)])
    both["own"], both["second"] = np.concatenate(own), np.concatenate([_unpacked(s, np.uint64) for s in rows["second"]])
    anchor = np.unique(both, return_inverse=True)[1].astype(np.int64)
    lefts = [d[: b.sum()] for d, b in zip(data, before)]
    rights = [d[b.sum() :] for d, b in zip(data, before)]
    masks = _starts_of_repeats(anchor, np.concatenate(before), np.concatenate(after), np.concatenate([*lefts, *rights]))
    return np.cumsum([len(o) for o in own]), masks


def _removals(parts: int, keep_texts: bool):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(blocks.iloc[0], parts)
        fates, shares = _fates(answers)
        masks = np.zeros(len(fates), np.uint64)
        compared = [contexts for *_, contexts in block.shards(fates, shares)]
        if compared:
            masks[np.concatenate(compared)] = _answers(answers, "masks", np.uint64)
        _, _, contexts, back, which = block.strings(fates)
        again = _answers(answers, "strings", np.uint8)[which].astype(bool)
        np.bitwise_or.at(masks, contexts[again], np.uint64(1) << back[again])
        # A byte begins at most one string of each of REACH + 1 starts, so 16 bits hold what begins or ends at it.
        edges = np.zeros(len(block.data) + 1, np.int16)
        of = fates[block.of_anchor]
        whole = (of == REPEATED) | (of == REPEATED_COMPARE)
        np.add.at(edges, block.bounds[whole, 0], 1)
        np.add.at(edges, block.bounds[whole, 1], -1)
        partly = np.flatnonzero(masks[block.of_anchor] != 0)
        for k in range(REACH + 1):
            starts = block.at[partly[(masks[block.of_anchor[partly]] >> np.uint64(k)) & np.uint64(1) == 1]] - k
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + LENGTH, -1)
        removed = np.cumsum(edges, dtype=np.int32)[:-1] > 0
        out = []
        for doc_id, start, length in zip(block.doc_ids, block.starts.tolist(), block.lengths.tolist()):
            gone = removed[start : start + length]
            kept = block.data[start : start + length][~gone].tobytes()
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            row = (doc_id, length, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
            out.append((*row, kept) if keep_texts else row)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_texts
        return pd.DataFrame(out, columns=names).astype({"doc_id": "object"})

    return run


def remove_repeats(
    docs: DataFrame, parts: int | None = None, keep_texts: bool = False, hot: int = HOT_CONTEXTS, shard: int = SHARD_CONTEXTS
) -> DataFrame:
    """Per row of ``docs`` what is left of its UTF-8 bytes without those that a repeated string of LENGTH bytes covers.

    A string is repeated where it also starts anywhere else, in another row or the
    same; overlaps count, and strings are judged on the input. Null and empty texts
    have no bytes; a text below LENGTH bytes loses none; repeated rows remove each
    other; a null id is kept; other columns are left out; an empty table gives no
    rows. ``keep_texts`` adds the bytes themselves, as ``kept``.

    Anchors tell where a repeated string can be. Of each anchor the context on both
    sides is counted by hash: equal contexts are repeated throughout. Only anchors
    with several contexts go on, once per different context, to a shard of their
    anchor (of about ``shard`` contexts), where the order of all suffixes decides
    exactly which strings repeat. An anchor with more than ``hot`` contexts is no
    group: its strings are counted by digests of all their bytes, per block first.
    Blocks of documents stay in a bucketed table, which is dropped at the end.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    name = f"repeat_blocks_{uuid.uuid4().hex}"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"block long, doc_ids array<{id_type}>, lengths binary, data binary, size long"
    rows.mapInArrow(_blocks, schema).write.bucketBy(shuffle_partitions(spark), "block").saveAsTable(name)
    try:
        blocks = spark.table(name)
        if parts is None:
            size = blocks.agg(F.sum("size")).first()[0] or 0
            parts = max(shuffle_partitions(spark), size // PART_BYTES)
        blocks = blocks.drop("size")
        answer = "block long, part int, shard int, kind string, answer binary"
        asked = blocks.mapInPandas(_context_requests(parts), "part int, block long, own binary, context binary, times binary")
        fates = stored(asked.groupBy("part").applyInPandas(_judge_contexts(hot, shard), answer))
        asked = blocks.groupBy("block").cogroup(fates.groupBy("block")).applyInPandas(
            _comparison_requests(parts),
            "kind string, part int, shard int, block long, own binary, second binary, before binary, after binary, data binary",
        )
        compared = stored(asked.groupBy("kind", "part", "shard").applyInPandas(_compare, answer))
        result = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        result += ", kept binary" if keep_texts else ""
        told = fates.unionByName(compared)
        return stored(blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(_removals(parts, keep_texts), result))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
