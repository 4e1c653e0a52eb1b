"""SimHash near-duplicates: all pairs of fingerprints at a small bit distance, by a Gray-order index.

Fingerprints that are equal are one node from the start.  Distinct ones that differ in at
most k bits agree on one of k + 1 blocks of bits, so each is dealt to k + 1 groups; no
pair is lost.  A group that is too large for one task is dealt again by the bits that are
still free, which keeps the same guarantee.  Inside a group an index is built: fingerprints in
Gray order, bits that neighbours share factored into upper nodes (value and mask).  The search
goes down from pairs of upper nodes; the bits in which two nodes are known to differ add up,
and a pair of nodes beyond k is dropped with everything below it.  A group reports a
spanning forest of its links, never all pairs.

Null and empty texts have fingerprint zero, which links like any other.  Rows with the same id
are one document.  A component without any id has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.components import components
from tagledger.session import stage

WORDS = 4
BITS = 4
SEED = 42
GROUP_ROWS = 4_096  # a larger group of distinct fingerprints is dealt again
FAN = 32
_PAIRS = 1 << 12  # pairs of nodes that are compared at once
_SLICE = 1 << 16  # shingles whose bits are counted at once


def text_fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 majority bits of the hashes of a text's word shingles."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, _SLICE):
        stop = min(count, start + _SLICE)
        hashes = np.array([digest(b" ".join(parts[i : i + words]), SEED) for i in range(start, stop)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(text: Column, words: int = WORDS) -> Column:
    """Fingerprint of a text column as a bigint with the same bits."""

    @F.arrow_udf("bigint")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            bits = np.array([text_fingerprint(t, words) for t in batch.to_pylist()], np.uint64)
            yield pa.array(bits.view(np.int64))

    return scan(text)


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the sequence where neighbours differ in one bit."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Distinct fingerprints in Gray order under nodes that hold what their members share."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits[np.argsort(gray_rank(bits), kind="stable")]
        value, mask = self.bits, np.full(len(bits), ~np.uint64(0))
        self.levels = [(value, mask)]
        while len(value) > 1:
            starts = np.arange(0, len(value), FAN)
            first = np.repeat(value[starts], np.diff([*starts, len(value)]))
            mask = np.bitwise_and.reduceat(mask & ~(value ^ first), starts)
            value = value[starts] & mask
            self.levels.append((value, mask))

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j), i < j, of all pairs that differ in at most ``distance`` bits."""
        todo = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, a, b = todo.pop()
            if len(a) > _PAIRS:
                todo.append((level, a[_PAIRS:], b[_PAIRS:]))
                a, b = a[:_PAIRS], b[:_PAIRS]
            value, mask = self.levels[level]
            differ = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b])
            near = differ <= distance
            a, b = a[near], b[near]
            if level == 0:
                apart = a < b
                if apart.any():
                    yield a[apart], b[apart]
            elif len(a):
                below, step = len(self.levels[level - 1][0]), np.arange(FAN)
                x = np.repeat(a * FAN, FAN * FAN) + np.tile(np.repeat(step, FAN), len(a))
                y = np.repeat(b * FAN, FAN * FAN) + np.tile(np.tile(step, FAN), len(b))
                inside = (x < below) & (y < below) & (x <= y)
                todo.append((level - 1, x[inside], y[inside]))

    def forest(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Links that connect what all pairs connect: each member with its root."""
        root = np.arange(len(self.bits))
        for a, b in self.pairs(distance):
            linked = np.unique(np.stack([root[a], root[b]]), axis=1)
            linked = linked[:, linked[0] != linked[1]]
            if not linked.shape[1]:
                continue
            top = {}

            def find(x):
                while top.get(x, x) != x:
                    x = top[x]
                return x

            for x, y in linked.T.tolist():
                x, y = sorted((find(x), find(y)))
                top[y] = x
            moved = np.array(list(top))
            target = np.arange(len(root))
            target[moved] = [find(x) for x in moved.tolist()]
            root = target[root]
        child = np.flatnonzero(root != np.arange(len(root)))
        return self.bits[child], self.bits[root[child]]


def _blocks(mask: int, distance: int) -> list[int]:
    """The bits outside ``mask`` in distance + 1 blocks, each joined with the mask."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [len(free) * i // (distance + 1) for i in range(distance + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cut, cut[1:]) if a < b]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(rows: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Each row once per block of its mask: (mask, key, bits)."""
    out = None
    for mask in masks:
        own = rows.filter(F.col("mask") == _signed(mask)) if "mask" in rows.columns else rows
        more = F.explode(F.array(*[F.lit(_signed(m)) for m in _blocks(mask, distance)])).alias("mask")
        part = own.select("bits", more)
        out = part if out is None else out.unionByName(part)
    return out.select("mask", F.col("mask").bitwiseAND(F.col("bits")).alias("key"), "bits")


def _group_links(distance: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(block: np.ndarray, last: bool):
            """Links of the groups that are complete, and the rows of the one that may go on."""
            ends = np.flatnonzero(np.any(block[:2, 1:] != block[:2, :-1], axis=0)) + 1
            ends = [0, *ends.tolist(), block.shape[1]] if last else [0, *ends.tolist()]
            found = [
                GrayIndex(block[2, a:b].view(np.uint64)).forest(distance)
                for a, b in zip(ends, ends[1:])
                if b - a > 1
            ]
            a = np.concatenate([np.empty(0, np.uint64), *[x for x, _ in found]])
            b = np.concatenate([np.empty(0, np.uint64), *[y for _, y in found]])
            out = pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
            return out, block[:, ends[-1] :]

        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "bits")]
                held.append(np.stack(columns))
                out, rest = links(np.concatenate(held, axis=1), False)
                held = [np.ascontiguousarray(rest)]
                yield out
        if held and held[0].shape[1]:
            yield links(np.concatenate(held, axis=1), True)[0]

    return scan


def links(distinct: DataFrame, distance: int = BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``bits``) that give the same components as all links."""
    masks = [0]
    rows, found = distinct.select("bits"), None
    while masks:
        dealt = stage(_dealt(rows, masks, distance), "gray-groups")
        masks = [m for mask in masks for m in _blocks(mask, distance)]
        sizes = dealt.groupBy(F.col("mask").alias("_mask"), F.col("key").alias("_key")).agg(F.count("*").alias("_n"))
        large = stage(sizes.filter(F.col("_n") > group_rows), "gray-large")
        last = min(bin(m).count("0") for m in masks) and max(m.bit_count() for m in masks) >= 56
        small = dealt
        if large.isEmpty() or last:
            rows, masks = None, []
        else:
            same = (F.col("mask") == F.col("_mask")) & (F.col("key") == F.col("_key"))
            small = dealt.join(large, same, "left_anti")
            rows = dealt.join(large, same, "left_semi").select("mask", "bits")
            used = {r["_mask"] for r in large.select("_mask").distinct().collect()}  # at most one per mask
            masks = [m for m in masks if _signed(m) in used]
        grouped = small.repartition("mask", "key").sortWithinPartitions("mask", "key")
        part = stage(grouped.mapInArrow(_group_links(distance), "a bigint, b bigint"), "gray-links")
        found = part if found is None else found.unionByName(part)
    return found


def _classes(rows: DataFrame, distance: int) -> DataFrame:
    """(_bits, _root, component_id) of the distinct fingerprints of (doc_id, bits, …)."""
    nodes = stage(rows.groupBy("bits").agg(F.min("doc_id").alias("_first")), "simhash-nodes")
    roots = components(links(nodes, distance)).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    placed = nodes.join(roots, nodes.bits == F.col("_node"), "left")
    placed = stage(placed.select("bits", F.coalesce("_root", "bits").alias("_root"), "_first"), "simhash-roots")
    named = placed.groupBy(F.col("_root").alias("_top")).agg(F.min("_first").alias("component_id"))
    by_root = placed.join(named, F.col("_root") == F.col("_top"))
    return stage(by_root.select(F.col("bits").alias("_bits"), "_root", "component_id"), "simhash-named")


def near_duplicates(df: DataFrame, id_: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = BITS) -> DataFrame:
    """(id, bits, component_id) of every row."""
    rows = df.select(F.col(f"`{id_}`").alias("doc_id"), fingerprints(F.col(f"`{text}`"), words).alias("bits"))
    rows = stage(rows, "simhash")
    return rows.join(_classes(rows, distance), F.col("bits") == F.col("_bits")).select("doc_id", "bits", "component_id")


def without_near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = BITS) -> DataFrame:
    """One document of each component, with all its columns: the one of least id, then least hash of the text.

    A document is an id and a text, so texts that share an id, or have none, are told apart; null ids come last.
    Of rows equal in both the least in column order stays.
    """
    tie = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = stage(docs.select("doc_id", tie.alias("tie"), fingerprints(F.col("text"), words).alias("bits")), "simhash")
    placed = rows.join(_classes(rows, distance), F.col("bits") == F.col("_bits")).select("doc_id", "tie", "_root")
    placed = stage(placed.groupBy("doc_id", "tie", "_root").agg(F.count("*").alias("n")), "simhash-documents")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")
    least = placed.groupBy(F.col("_root").alias("_top")).agg(F.min(order).alias("_kept"))
    known = placed.join(least, F.col("_root") == F.col("_top"))
    kept = F.col("doc_id").eqNullSafe(F.col("_kept.doc_id")) & (F.col("tie") == F.col("_kept.tie"))
    pair = [F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")]
    gone = stage(known.filter(~kept).select(*pair), "simhash-gone")
    several = stage(known.filter(kept & (F.col("n") > 1)).select(*pair), "simhash-several")
    mine = docs.withColumn("_mine", tie)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mine") == F.col("_tie"))
    out = mine.join(gone, same, "left_anti")
    if not several.isEmpty():
        rest = F.min(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])).alias("_row")
        once = out.join(several, same, "left_semi").groupBy("doc_id", "_mine").agg(rest)
        once = once.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)], "_mine")
        out = out.join(several, same, "left_anti").unionByName(once)
    return out.drop("_mine")


def simhash_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    shown = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")
