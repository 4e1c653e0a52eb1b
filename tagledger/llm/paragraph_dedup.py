"""Repeated passages: paragraph MinHash banding, exact check, components, removal.

Two kinds of paragraphs are compared, each with its own kind:

* lines, as sets of five-word shingles;
* runs of words whose five-word shingles all occur more than once, as sets of these shingles.
  They find passages that stand inside longer lines, wherever their lines or sentences break.
  The shingles over the seam of two passages are rarer than those within, so the parts of a run
  that occur at least so often are runs of their own, as far as they are not similar to the part around them: a
  passage is found next to other repeated text, and also if a part of it is more frequent.

A run that comes back to its own beginning is cut at the returns, so text repeated inside one document is found as well.

Texts that are equal in full are compared once: later copies of at least ``min_words`` words are occurrences of the whole text.
Equal paragraphs are one node.  Distinct ones get MinHash signatures cut into bands, tuned so
that a pair at the threshold is found with a probability of 99.8 %.  Paragraphs that share a
band are checked by exact Jaccard similarity, and links form components.  Of every component the
first occurrence (by document id, then place) stays, with what overlaps it; the others are removed.

How it scales: of every ``WINDOW`` shingles in a row the least by hash is an anchor, so all windows of a
shared run have the same anchors.  Anchors are counted with partial sums, and only stretches
long enough for ``min_words`` words whose anchors all repeat are spelled out, counted and joined, as short flat rows that
come back sorted by document and place and are read as a stream.  One pass over the texts gives anchors and lines.  Joins with
counts are hashed, so a task holds the counts of its shuffle partition.  Each step is stored and
lets go of its shuffle files before the next.  A group that shares a band is not
spelled out in pairs: its members are compared inside a task, only across what is not yet
connected, and a spanning forest is returned.  A group of more members than fit is dealt to
all pairs of its parts, each of bounded size, so no pair is lost.

Paragraphs of fewer than ``min_words`` words are left alone.  Null and empty texts have no paragraphs.  Rows equal in id and
text are one document.  Null ids come first in the order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.components import components
from tagledger.operators.heavy import fits_broadcast, lookup_join
from tagledger.session import release, stage

MIN_WORDS = 40
SHINGLE = 5
SIMILARITY = 0.8
WINDOW = 20  # shingles of which one is an anchor
BANDS = 9
ROWS = 3
PART = 1_000  # members of a band group that are compared in one go
_SLICE = 2_048  # elements that are permuted at once

_WORD = re.compile(r"\S+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_PERMUTE = np.random.default_rng(11).integers(1, 2**63, (2, BANDS * ROWS), np.uint64) | np.uint64(1)
_digest = xxhash.xxh3_64_intdigest

LINE, RUN, ANCHORS = 0, 1, 2
_SHINGLES = "doc_id {kind}, tie bigint, at int, shingle bigint"
_ROWS_OUT = 65_536  # rows of a batch of shingles, and the text they end in
_HELD = 400_000  # elements of units that are sent on at once
_UNIT_SQL = "kind int, start int, stop int, words int, digest bigint, bands array<bigint>, elements array<int>"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of words in UTF-8."""
    try:
        return np.fromiter(map(_digest, words), np.uint64, len(words))
    except UnicodeEncodeError:
        whole = "\n".join(words).encode("utf-8", "surrogatepass")
        return np.fromiter(map(_digest, whole.split(b"\n")), np.uint64, len(words))


def _mixed(own: np.ndarray) -> np.ndarray:
    """Hashes of the runs of words, by the number of their first word; the upper half is an element of a line."""
    count = max(0, len(own) - SHINGLE + 1)
    mixed = np.zeros(count, np.uint64)
    for i in range(SHINGLE):
        mixed += own[i : i + count] * _ODD[i]
    return (mixed ^ mixed >> np.uint64(31)) * _ODD[0]


def _spread(mixed: np.ndarray) -> np.ndarray:
    """64-bit hashes of which all bits depend on all words."""
    return (mixed ^ mixed >> np.uint64(29)).view(np.int64)


def word_shingles(text: str) -> np.ndarray:
    """64-bit hashes of the runs of words, by the number of their first word."""
    return _spread(_mixed(word_hashes(text.lower().split())))


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the least hash of every window; equal windows have it at the same place."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    # Windows of twice the size are made of two; of equal hashes the first counts.
    least, at, size = hashes, np.arange(len(hashes)), 1
    while size < window:
        step = min(size, window - size)
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        size += step
    return at


def near(chosen: np.ndarray, places: np.ndarray, window: int, least: int) -> np.ndarray:
    """Places in stretches of ``least`` shingles or more whose windows all have one of the places as anchor."""
    wanted = np.zeros(max(chosen.max(initial=-1), places.max(initial=-1)) + 1, bool)
    wanted[places] = True
    known = np.concatenate([[False], wanted[chosen], [False]]).astype(np.int8)
    first, last = np.flatnonzero(np.diff(known) == 1), np.flatnonzero(np.diff(known) == -1)
    long = last - first + window - 1 >= least
    # Stretches may overlap: one more from each beginning on, one less behind each end.
    change = np.zeros(len(chosen) + window, np.int64)
    change[first[long]] += 1
    change[last[long] + window - 1] -= 1
    return np.flatnonzero(np.cumsum(change))


def distinct_values(values: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    ordered = np.sort(values)
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return ordered[fresh]


def _upper(mixed: np.ndarray) -> np.ndarray:
    return (mixed >> np.uint64(32)).astype(np.uint32)


def _line_set(own: np.ndarray, whole: np.ndarray, at: int, size: int) -> np.ndarray:
    """Elements of a line of so many words from this one on; a line shorter than a run is one run of all its words."""
    if size >= SHINGLE:
        return distinct_values(whole[at : at + size - SHINGLE + 1])
    short = (own[at : at + size] * _ODD[:size]).sum(keepdims=True)
    return _upper((short ^ short >> np.uint64(31)) * _ODD[0])


def shingles(lines: list[list[str]]) -> list[np.ndarray]:
    """Distinct 32-bit hashes of runs of words, line by line."""
    own = word_hashes(list(chain.from_iterable(lines)))
    whole, ends = _upper(_mixed(own)), np.cumsum([0, *map(len, lines)]).tolist()
    return [_line_set(own, whole, at, len(line)) for at, line in zip(ends, lines)]


def bands(lists: list[np.ndarray], kinds: list[int]) -> np.ndarray:
    """Hashes of the bands of the MinHash signatures, one row per list; many lists are hashed at once."""
    least = np.full((BANDS * ROWS, len(lists)), ~np.uint64(0))
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate([np.empty(0, np.uint32), *lists]).astype(np.uint64) + np.uint64(1)
    for start in range(0, len(flat), _SLICE):
        stop = min(len(flat), start + _SLICE)
        # The lists of this slice; the first and the last may reach beyond it.
        first, last = np.searchsorted(ends, start, "right") - 1, np.searchsorted(ends, stop)
        part = flat[start:stop] * _PERMUTE[0][:, None] + _PERMUTE[1][:, None]
        part ^= part >> np.uint64(33)
        own = np.minimum.reduceat(part, np.maximum(ends[first:last], start) - start, axis=1)
        np.minimum(least[:, first:last], own, out=least[:, first:last])
    mixed = np.tensordot(_ODD[:ROWS], least.reshape(BANDS, ROWS, -1), (0, 1)).T
    mixed = mixed + np.arange(BANDS, dtype=np.uint64) + np.array(kinds, np.uint64)[:, None] * np.uint64(BANDS)
    mixed = (mixed ^ mixed >> np.uint64(29)) * _ODD[4]
    return (mixed ^ mixed >> np.uint64(32)).view(np.int64)


def unit(kind: int, start: int, stop: int, words: int, elements: np.ndarray) -> dict:
    digest = _signed(_digest(elements.tobytes(), kind))
    return {"kind": kind, "start": start, "stop": stop, "words": words, "digest": digest, "elements": elements}


def text_parts(text: str, min_words: int) -> tuple[np.ndarray, list[dict]]:
    """Shingles of the whole text, and its lines as units; words are split and hashed once for both."""
    lines = [line.split() for line in text.lower().split("\n")]
    own = word_hashes(list(chain.from_iterable(lines)))
    mixed = _mixed(own)
    whole, at, out = _upper(mixed), 0, []
    for size in map(len, lines):
        if size >= min_words:
            out.append(unit(LINE, at, at + size, size, _line_set(own, whole, at, size)))
        at += size
    return _spread(mixed), out


def levels(counts: np.ndarray, least: int, similarity: float) -> list[tuple[int, int]]:
    """(first, behind last) of longest parts whose counts are at least some number.

    Parts shorter than ``least`` are left out, and so are those that are similar to a part around them that
    is listed: what is similar to such a part is similar to the one around it.  So the sizes of nested
    parts fall by a factor, and all parts together are linear in the run, up to a logarithm.
    """
    edges = np.flatnonzero(np.diff(counts)) + 1
    firsts = [0, *edges.tolist()]
    found, held = [], []
    for first, count in zip([*firsts, len(counts)], [*counts[firsts].tolist(), 0]):
        begin = first
        while held and held[-1][1] > count:
            begin = held.pop()[0]
            if first - begin >= least:
                found.append((begin, first))
        if not held or held[-1][1] < count:
            held.append((begin, count))
    out, around = [], []
    for first, last in sorted(found, key=lambda p: (p[0], -p[1])):
        while around and around[-1][1] <= first:
            around.pop()
        if not around or last - first < similarity * (around[-1][1] - around[-1][0]):
            out.append((first, last))
            around.append((first, last))
    return out


def returns(hashes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Parts of a run that comes back to its beginning, each from one return to the next; else the run."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    if not (ordered[1:] == ordered[:-1]).any():
        return [(0, len(hashes))]
    parts, first = [], 0
    while first + least < len(hashes):
        same = order[np.searchsorted(ordered, hashes[first], "left") : np.searchsorted(ordered, hashes[first], "right")]
        later = np.searchsorted(same, first + least)
        if later == len(same):
            break
        parts.append((first, int(same[later])))
        first = parts[-1][1]
    if not parts or len(hashes) - first >= least:
        parts.append((first, len(hashes)))
    return parts


def run_units(elements: np.ndarray, at: int, counts: np.ndarray, least: int, similarity: float) -> Iterator[dict]:
    """Units of one run of shingles that repeat, the first of them at this word."""
    for low, high in levels(counts, least, similarity):
        for first, last in returns(elements[low:high], least):
            first, last = low + first, low + last
            words = last - first + SHINGLE - 1
            yield unit(RUN, at + first, at + first + words, words, distinct_values(elements[first:last]))


def repeated_ids(docs: DataFrame) -> DataFrame | None:
    """(_several): ids of more than one row; None if there are none."""
    ids = docs.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_several")).agg(F.count("*").alias("_n"))
    ids = stage(ids.filter("_n > 1").select("_several"), "repeated-ids")
    return None if ids.isEmpty() else ids


def _keyed(docs: DataFrame, several: DataFrame | None) -> DataFrame:
    """Add ``tie``, which tells texts apart where the id does not: 0 for an id that occurs once."""
    text = F.coalesce("text", F.lit(""))
    unnamed = F.when(F.col("doc_id").isNull(), F.xxhash64(text))
    if several is None:
        return docs.withColumn("tie", unnamed.otherwise(F.lit(0).cast("bigint")))
    joined = lookup_join(docs, several, F.col("doc_id") == F.col("_several"))
    tie = unnamed.when(F.col("_several").isNotNull(), F.hash(text).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return joined.withColumn("tie", tie).drop("_several")


def _text_key() -> Column:
    """Equal for equal texts only, as far as a digest of 256 bits can say."""
    return F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)


def text_keys(keyed: DataFrame) -> DataFrame:
    """(doc_id, tie, _own): what tells the texts of all rows apart, computed once."""
    return stage(keyed.select("doc_id", "tie", _text_key().alias("_own")), "text-keys")


def copied_texts(keys: DataFrame) -> DataFrame:
    """Texts of more than one row: (_key, _first), first the least document that has the text."""
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    grouped = keys.groupBy(F.col("_own").alias("_key"))
    many = grouped.agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    return stage(many.select("_key", F.col("_first.doc_id").alias("_first")), "copied-texts")


def distinct_texts(keyed: DataFrame, copied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tie, text), one row per text, that of its first document; and (_key, n_words) of the copied texts.

    Only texts that occur more than once are brought together, one row of each per task.
    """
    keyed = keyed.select("doc_id", "tie", "text").withColumn("_own", _text_key())
    small = fits_broadcast(copied)
    several = F.broadcast(copied) if small else copied
    single = keyed.join(several, F.col("_own") == F.col("_key"), "left_anti").select("doc_id", "tie", "text")
    merged = keyed.join(several, F.col("_own") == F.col("_key")).groupBy("_own")
    merged = merged.agg(F.first("_first").alias("doc_id"), F.first("tie").alias("tie"), F.first("text").alias("text"))
    words = F.size(F.regexp_extract_all("text", F.lit(r"(\S+)"), F.lit(1)))
    # Without a broadcast the texts are shuffled, which is done once only.
    merged = stage(merged.withColumn("n_words", words), "copied-once")
    out = single.unionByName(merged.select("doc_id", "tie", "text"))
    return out if small else stage(out, "texts"), merged.select(F.col("_own").alias("_key"), "n_words")


def copies(keys: DataFrame, copied: DataFrame, counted: DataFrame, min_words: int) -> DataFrame:
    """Whole texts that occur in several documents, as occurrences like those of passages.

    The texts are not read again: rows come by their keys, words were counted once for each text.
    """
    sized = counted.filter(F.col("n_words") >= min_words).withColumnRenamed("_key", "_sized")
    wanted = copied.join(sized, F.col("_key") == F.col("_sized")).drop("_sized")
    found = lookup_join(keys, stage(wanted, "copied-long"), F.col("_own") == F.col("_key"), "inner")
    rows = found.select(
        "doc_id",
        "tie",
        F.lit(0).alias("start"),
        F.col("n_words").alias("stop"),
        "n_words",
        F.col("_first").alias("kept_doc_id"),
        F.xxhash64("_key").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("_first")).alias("kept"),
    )
    rows = stage(rows.distinct(), "copied-rows")
    # Rows equal in id and text are one document and no copies.
    twice = rows.filter("not kept").select(F.col("component_id").alias("_repeated")).distinct()
    return lookup_join(rows, twice, F.col("component_id") == F.col("_repeated"), "left_semi")


def _near_rows(window: int, least: int):
    """Rows of all shingles near the anchors in column ``places``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, size = [], [], 0

            def close() -> pa.RecordBatch:
                take = pa.array(np.concatenate(rows))
                columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
                names = ["doc_id", "tie", "at", "shingle"]
                return pa.record_batch([batch.column("doc_id").take(take), batch.column("tie").take(take), *columns], names=names)

            for n, text in enumerate(batch.column("text")):
                hashes = word_shingles(text.as_py() or "")
                known = batch.column("places")[n].values.to_numpy(zero_copy_only=False)
                places = near(anchors(hashes, window), known, window, least)
                rows.append(np.full(len(places), n, np.int32))
                parts.append([places.astype(np.int32), hashes[places]])
                size += len(places)
                if size > _ROWS_OUT:
                    yield close()
                    rows, parts, size = [], [], 0
            if rows:
                yield close()

    return scan


def _unit_batch(ids: pa.Array, ties: pa.Array, flat: list[dict]) -> pa.RecordBatch:
    """Units as a batch, built column by column.  Of equal units one has the bands and the elements, the others null."""
    place: dict[int, int] = {}
    for n, u in enumerate(flat):
        place.setdefault(u["digest"], n)
    sets = [flat[n]["elements"] for n in place.values()]
    hashed = bands(sets, [flat[n]["kind"] for n in place.values()]).ravel()
    elements = np.concatenate([np.empty(0, np.uint32), *sets]).view(np.int32)
    repeated = np.ones(len(flat), bool)
    repeated[list(place.values())] = False

    def nested(sizes: list[int], values: np.ndarray) -> pa.Array:
        lengths = np.zeros(len(flat), np.int64)
        lengths[list(place.values())] = sizes
        # The values stand in the order of the rows that have some.
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=pa.array(repeated))

    columns = [ids, ties, *[pa.array([u[n] for u in flat], pa.int32()) for n in ("kind", "start", "stop", "words")]]
    columns += [pa.array([u["digest"] for u in flat], pa.int64()), nested([BANDS] * len(sets), hashed)]
    columns.append(nested(list(map(len, sets)), elements))
    return pa.record_batch(columns, names=["doc_id", "tie", "kind", "start", "stop", "words", "digest", "bands", "elements"])


def _batches_of_units(batch: pa.RecordBatch, made: Iterator[tuple[int, dict]]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size of (row of the batch, unit)."""
    rows, flat, size = [], [], 0
    for row, one in made:
        rows.append(row)
        flat.append(one)
        size += len(one["elements"])
        if size > _HELD:
            take = pa.array(rows)
            yield _unit_batch(batch.column("doc_id").take(take), batch.column("tie").take(take), flat)
            rows, flat, size = [], [], 0
    if rows:
        take = pa.array(rows)
        yield _unit_batch(batch.column("doc_id").take(take), batch.column("tie").take(take), flat)


def _anchor_batch(batch: pa.RecordBatch, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A row per text with anchors, shaped like units: their hashes as bands, their places as elements."""
    take = pa.array([row for row, _, _ in found], pa.int32())
    ends = pa.array(np.cumsum([0, *(len(places) for _, places, _ in found)]), pa.int32())
    places = np.concatenate([np.empty(0, np.int32), *(p for _, p, _ in found)])
    hashes = np.concatenate([np.empty(0, np.int64), *(h for _, _, h in found)])
    zeros = [pa.array(np.zeros(len(found), np.int32))] * 3
    columns = [batch.column("doc_id").take(take), batch.column("tie").take(take), pa.array(np.full(len(found), ANCHORS, np.int32)), *zeros]
    columns += [pa.array(np.zeros(len(found), np.int64)), pa.ListArray.from_arrays(ends, pa.array(hashes)), pa.ListArray.from_arrays(ends, pa.array(places))]
    return pa.record_batch(columns, names=["doc_id", "tie", "kind", "start", "stop", "words", "digest", "bands", "elements"])


def _text_rows(min_words: int, window: int):
    """Lines as units, and the anchors of each text, in one pass over the texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []

            def lines() -> Iterator[tuple[int, dict]]:
                for n, text in enumerate(batch.column("text")):
                    hashes, own = text_parts(text.as_py() or "", min_words)
                    places = distinct_values(anchors(hashes, window))
                    if len(places):
                        found.append((n, places.astype(np.int32), hashes[places]))
                    for one in own:
                        yield n, one

            yield from _batches_of_units(batch, lines())
            if found:
                yield _anchor_batch(batch, found)

    return scan


def _run_rows(min_words: int, similarity: float):
    """Units of shingles (doc_id, tie, at, element, count) that come by document and place."""
    least = max(1, min_words - SHINGLE + 1)

    def made(batch: pa.RecordBatch, edges: np.ndarray) -> Iterator[tuple[int, dict]]:
        at, elements, counts = (batch.column(c).to_numpy() for c in ("at", "element", "count"))
        elements = elements.view(np.uint32)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a >= least:
                for one in run_units(elements[a:b], int(at[a]), counts[a:b], least, similarity):
                    yield a, one

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            at, tie, ids = held.column("at").to_numpy(), held.column("tie").to_numpy(), held.column("doc_id")
            other = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            fresh = other | (known[1:] != known[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] != at[:-1] + 1)
            edges = np.concatenate([[0], np.flatnonzero(fresh) + 1])
            # The last run may go on in the next batch.
            yield from _batches_of_units(held, made(held, edges))
            held = held.slice(int(edges[-1]))
        if held is not None and held.num_rows:
            yield from _batches_of_units(held, made(held, np.array([0, held.num_rows])))

    return scan


def units(docs: DataFrame, min_words: int, similarity: float = SIMILARITY) -> DataFrame:
    """Occurrences of paragraphs of distinct texts: (doc_id, tie, kind, start, stop, words, digest, bands, elements).

    Bands and elements may be null where other rows of the digest have them.
    """
    kind = dict(docs.dtypes)["doc_id"]
    least = max(1, min_words - SHINGLE + 1)
    window = min(WINDOW, least)
    shape = f"doc_id {kind}, tie bigint, {_UNIT_SQL}"

    def repeated(found: DataFrame, counts: DataFrame) -> DataFrame:
        # Counts have one row per shingle; hashed, neither side is sorted, and a hot shingle's rows can still be split.
        return found.join(counts.hint("shuffle_hash"), F.col("shingle") == F.col("_shingle")).drop("_shingle")

    def counted(found: DataFrame, name: str) -> DataFrame:
        counts = found.groupBy(F.col("shingle").alias("_shingle")).agg(F.count("*").alias("count"))
        out = stage(counts.filter("count > 1"), name)
        release()
        return out

    shingled = _SHINGLES.format(kind=kind)
    parts = stage(docs.mapInArrow(_text_rows(min_words, window), shape), "text-parts")
    chosen = parts.filter(F.col("kind") == ANCHORS).select("doc_id", "tie", F.inline(F.arrays_zip("elements", "bands")))
    chosen = chosen.toDF("doc_id", "tie", "at", "shingle")
    anchored = counted(chosen, "anchors")
    marked = repeated(chosen, anchored).groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
    marked = stage(marked.agg(F.collect_set("at").alias("places")), "marked")
    release(anchored)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    held = docs.join(marked.hint("shuffle_hash"), same).select("doc_id", "tie", "text", "places")
    close = stage(held.mapInArrow(_near_rows(window, least), shingled), "near-anchors")
    release(marked)
    shared = counted(close, "shingles")
    # An element of a unit is the upper half of its shingle.
    element = F.shiftright("shingle", 32).cast("int").alias("element")
    count = F.least("count", F.lit(2**31 - 1)).cast("int").alias("count")
    # Stored before they are sorted, so that the files of one shuffle are gone when those of the next are written.
    short = stage(repeated(close, shared).select("doc_id", "tie", "at", element, count), "short")
    release(close, shared)
    placed = short.repartition("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "at")
    runs = stage(placed.mapInArrow(_run_rows(min_words, similarity), shape), "runs")
    release(short)
    return runs.unionByName(parts.filter(F.col("kind") == LINE))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    shared = len(np.intersect1d(a, b, True))
    return shared / (len(a) + len(b) - shared)


def forest(members: list[tuple[int, np.ndarray]], similarity: float) -> list[tuple[int, int]]:
    """Links that connect what all pairs at the similarity connect.

    Each member looks for one link to every component found so far, at its first members first.
    """
    groups: list[list[int]] = []
    links = []
    for n, (digest, own) in enumerate(members):
        joined, apart = [n], []
        for group in groups:
            low, high = similarity * len(own), len(own) / similarity
            near = next((m for m in group if low <= len(members[m][1]) <= high and jaccard(own, members[m][1]) >= similarity), None)
            if near is None:
                apart.append(group)
            else:
                links.append((digest, members[near][0]))
                joined = group + joined
        groups = [*apart, joined]
    return links


def _group_links(similarity: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, {}

        def links() -> pa.RecordBatch:
            found = forest(sorted(members.items()), similarity)
            columns = [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)]
            return pa.record_batch(columns, names=["a", "b"])

        for batch in batches:
            digests, lists = batch.column("digest").to_pylist(), batch.column("elements")
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("band", "low", "high")]))
            for n, (at, digest) in enumerate(zip(keys, digests)):
                if at != key:
                    if len(members) > 1:
                        yield links()
                    key, members = at, {}
                members[digest] = lists[n].values.to_numpy(zero_copy_only=False)
        if len(members) > 1:
            yield links()

    return scan


def similar(distinct: DataFrame, similarity: float, part: int = PART, elements: DataFrame | None = None) -> DataFrame:
    """(a, b): links between distinct paragraphs (digest, bands, elements).

    ``elements`` may come from a table (digest, elements) of its own, with repeated rows, some of them null: only
    those of paragraphs that share a band are looked up.
    """
    dealt = distinct.select("digest", F.explode("bands").alias("band"))
    several = dealt.groupBy(F.col("band").alias("_band")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_band")
    crowded = stage(dealt.join(several, F.col("band") == F.col("_band"), "left_semi"), "crowded-bands")
    release()
    # Bands with the same members, as those of near copies mostly are, are one group: told by the
    # number of members and two sums over hashes of them.
    own = [F.bit_xor(F.xxhash64("digest")).alias("x"), F.sum(F.hash("digest").cast("bigint")).alias("s")]
    sizes = crowded.groupBy(F.col("band").alias("_band")).agg(F.count("*").alias("n"), *own)
    sizes = sizes.groupBy("n", "x", "s").agg(F.min("_band").alias("_band")).select("_band", "n")
    crowded = crowded.join(stage(sizes, "bands"), F.col("band") == F.col("_band"))
    parts = F.ceil(F.col("n") / part)
    own = F.pmod(F.xxhash64("digest", "band"), parts)
    others = F.transform(
        F.sequence(F.lit(0).cast("bigint"), parts - 1),
        lambda j: F.struct(F.least("_own", j).alias("low"), F.greatest("_own", j).alias("high")),
    )
    groups = crowded.withColumn("_own", own).select(F.col("digest").alias("_digest"), "band", F.inline(others))
    groups = stage(groups, "band-groups")
    wanted = groups.select(F.col("_digest").alias("_wanted")).distinct().hint("shuffle_hash")
    known = (distinct if elements is None else elements).select("digest", "elements").filter("elements is not null")
    known = known.join(wanted, F.col("digest") == F.col("_wanted"), "left_semi").dropDuplicates(["digest"])
    full = groups.join(known, F.col("_digest") == F.col("digest"))
    full = full.select("band", "low", "high", "digest", "elements")
    placed = full.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    return placed.mapInArrow(_group_links(similarity), "a bigint, b bigint").distinct()


def repeated_passages(
    df: DataFrame, id_: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """Occurrences of passages that repeat: (doc_id, tie, start, stop, n_words, kept_doc_id, component_id, kept).

    ``start`` and ``stop`` number the words of the text, from 0 and without the last; ``tie`` tells texts of one id apart;
    ``kept_doc_id`` is the document of the occurrence that stays.
    """
    docs = df.select(F.col(f"`{id_}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = _keyed(docs, repeated_ids(docs))
    keys = text_keys(keyed)
    copied = copied_texts(keys)
    texts, counted = distinct_texts(keyed, copied)
    found = units(texts, min_words, similarity)
    places = found.select("doc_id", "tie", "start", "stop", "words", "digest").distinct()
    signed = stage(found.groupBy("digest").agg(F.first("bands", ignorenulls=True).alias("bands")), "passages-signed")
    links = stage(similar(signed, similarity, elements=found), "passages-links")
    release(signed)
    roots = components(links)
    roots = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    placed = places.join(roots, F.col("digest") == F.col("_node"), "left")
    placed = stage(placed.withColumn("component_id", F.coalesce("_root", "digest")).drop("_node", "_root", "digest"), "passages-placed")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie", "start", "stop")
    first = placed.groupBy(F.col("component_id").alias("_component")).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = stage(first.filter("n > 1"), "passages-first")
    listed = placed.join(first, F.col("component_id") == F.col("_component"))
    # Runs within or around the first one, in the same text, are no second occurrence.
    here = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tie") == F.col("first.tie"))
    kept = here & (F.col("start") < F.col("first.stop")) & (F.col("stop") > F.col("first.start"))
    listed = stage(listed.withColumn("kept", kept), "passages-listed")
    twice = listed.filter("not kept").select(F.col("component_id").alias("_repeated")).distinct()
    passages = listed.join(twice, F.col("component_id") == F.col("_repeated"), "left_semi").select(
        "doc_id",
        "tie",
        "start",
        "stop",
        F.col("words").alias("n_words"),
        F.col("first.doc_id").alias("kept_doc_id"),
        "component_id",
        "kept",
    )
    return passages.unionByName(copies(keys, copied, counted, min_words))


def cut(text: Column, spans: Column) -> Column:
    """The text without the spans of words and what is blank behind each; overlapping spans are taken together."""

    @F.arrow_udf("string")
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            for whole, gone in zip(texts.to_pylist(), lists.to_pylist()):
                if whole is not None and gone:
                    starts = [m.start() for m in _WORD.finditer(whole)]
                    places = [0, *starts[1:], len(whole)]
                    at, kept = 0, []
                    for one in sorted(gone, key=lambda s: (s["start"], s["stop"])):
                        start, stop = (places[min(one[c], len(places) - 1)] for c in ("start", "stop"))
                        kept.append(whole[at : max(at, start)])
                        at = max(at, stop)
                    whole = "".join([*kept, whole[at:]])
                out.append(whole)
            yield pa.array(out, pa.string())

    return scan(text, spans)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Documents without the passages that occur before; n_chars, if there, follows the text."""
    found = repeated_passages(docs, min_words=min_words, similarity=similarity).filter("not kept")
    gone = found.groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).agg(
        F.collect_set(F.struct("start", "stop")).alias("_gone")
    )
    renamed = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)], "doc_id", "text")
    keyed = _keyed(renamed, repeated_ids(docs.select("doc_id")))
    joined = keyed.join(stage(gone, "passages-gone"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    touched = F.col("_gone").isNotNull()
    joined = joined.withColumn("text", F.when(touched, cut(F.col("text"), F.col("_gone"))).otherwise(F.col("text")))
    kinds = dict(docs.dtypes)
    out = []
    for i, c in enumerate(docs.columns):
        if c == "text":
            out.append(F.col("text"))
        elif c == "n_chars":
            out.append(F.when(touched, F.length("text").cast(kinds[c])).otherwise(F.col(f"_c{i}")).alias(c))
        else:
            out.append(F.col(f"_c{i}").alias(c))
    return joined.select(*out)


def passage_report(docs: DataFrame) -> DataFrame:
    return repeated_passages(docs.select("doc_id", "text")).select(
        "doc_id", "kept_doc_id", "start", "stop", "n_words", "component_id", "kept"
    )
