"""Near-duplicate vectors by sorted projection passes.

Each pass gives a vector a key of random hyperplane signs and sorts all vectors by it; near
vectors share long prefixes, so they come close in one of the passes.  Every vector is
compared, by exact cosine in double precision, with the next ``window`` vectors of each
pass, and pairs that reach the threshold join components over all passes.  The number of passes follows from the
number of vectors: a pair at the threshold is missed with a probability of ``MISS`` at most, at any size.

A window bounds what is compared in a pass, not what is linked: inside each component all pairs are compared,
block against block, and every vector's links are counted there.  So a group of any number
of near copies has all its links, and pairs are never spelled out.

Equal vectors are one node from the start and are counted, not compared.  Sorting moves keys and
ids only.  The sorted order is cut into blocks of fixed size, each with the first rows of the
next one, so results do not depend on partitions, and vectors are shuffled once per pass.  A component of more than
``MEMBERS`` distinct vectors is dealt to all pairs of its parts, so its work is spread over tasks.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, also
not with their copies; vectors of different lengths do not link.  Rows with the same id are
one node; a null id stays alone, with a null component.  Only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.components import components
from tagledger.operators.ordering import global_row_number
from tagledger.session import stage

COSINE = 0.95
WINDOW = 128
BLOCK = 2_048
PLANES = 60
MISS = 1e-3  # probability that no pass brings a pair at the threshold together
MEMBERS = 8_192  # distinct vectors of a component that are compared as one part
_SLICE = 512  # vectors that are multiplied with a part at once


def passes_for(rows: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes so that a pair at the threshold shares the prefix that a window spans in one of them."""
    same = 1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi
    together = same ** max(0.0, math.log2(max(rows, 1) / max(window, 1)))
    return max(2, math.ceil(math.log(miss) / math.log(max(1 - together, 1e-9))))


def planes(turns: int, size: int) -> np.ndarray:
    """Hyperplanes of all passes, side by side."""
    return np.concatenate([np.random.default_rng([t, size]).standard_normal((size, PLANES)) for t in range(turns)], axis=1)


def clean(values) -> np.ndarray | None:
    """The vector in double precision, if it can link at all."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    vector = np.asarray(values, np.float64) + 0.0
    return vector if np.isfinite(vector).all() and vector.any() else None


def sketch(embedding: Column, passes: int) -> Column:
    """Digest, length and sort keys of a vector; null digest if it cannot link."""

    @F.arrow_udf("digest string, size int, keys array<bigint>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(PLANES)[::-1]
        shape = pa.struct([("digest", pa.string()), ("size", pa.int32()), ("keys", pa.list_(pa.int64()))])
        for batch in batches:
            vectors = [clean(v) for v in batch.to_pylist()]
            rows: list[dict] = [{"digest": None, "size": 0, "keys": []} for _ in vectors]
            by_size: dict[int, list[int]] = {}
            for n, vector in enumerate(vectors):
                if vector is not None:
                    by_size.setdefault(len(vector), []).append(n)
            for size, own in by_size.items():
                whole = known.setdefault(size, planes(passes, size)) if size not in known else known[size]
                for k in range(0, len(own), _SLICE):
                    part = own[k : k + _SLICE]
                    signs = np.stack([vectors[n] for n in part]) @ whole > 0
                    keys = signs.reshape(len(part), passes, PLANES) @ weights
                    for n, key in zip(part, keys):
                        rows[n] = {"digest": xxhash.xxh3_128_hexdigest(vectors[n].tobytes()), "size": size, "keys": key}
            yield pa.array(rows, shape)

    return scan(embedding)


def _units(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one."""
    whole = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # Divided by the largest component first, so that squares neither overflow nor vanish.
    whole /= np.abs(whole).max(axis=1, keepdims=True)
    return whole / np.sqrt((whole * whole).sum(axis=1, keepdims=True))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal keys, which come together, as one batch each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        fresh = np.zeros(max(0, batch.num_rows - 1), bool)
        for c in columns:
            fresh |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(fresh) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            now = tuple(c[a] for c in columns)
            if held and now != last:
                yield pa.concat_batches(held)
                held = []
            last = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.concat_batches(held)


def _window_links(window: int, cosine: float):
    """Links in windows that first connect two parts of a block; the others add nothing to components."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["block", "turn", "size"]):
            unit, ids = _units(group.column("embedding")), group.column("node")
            own = ~group.column("guest").to_numpy(zero_copy_only=False)
            top = np.arange(len(unit))
            found: list[tuple[int, int]] = []
            for step in range(1, min(window, len(unit) - 1) + 1):
                near = np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= cosine
                at = np.flatnonzero(near & own[:-step] & (top[:-step] != top[step:]))
                for a in at.tolist():
                    low, high = sorted((top[a], top[a + step]))
                    if low != high:
                        found.append((a, a + step))
                        top[top == high] = low
            ends = [ids.take(pa.array([f[i] for f in found], pa.int64())) for i in (0, 1)]
            yield pa.record_batch([pc.min_element_wise(*ends), pc.max_element_wise(*ends)], names=["a", "b"])

    return scan


def window_links(nodes: DataFrame, window: int, cosine: float, block: int) -> DataFrame:
    """Links (a, b) of (node, size, keys, embedding) in the windows of all passes, enough for components."""
    turns = nodes.select("node", "size", F.posexplode("keys").alias("turn", "key"))
    order = [F.col("size"), F.col("turn"), F.col("key"), F.col("node")]
    ranked = global_row_number(turns, order, "rank", spread_copies=False)
    at, first = F.floor((F.col("rank") - 1) / block), (F.col("rank") - 1) % block < window
    places = F.when(first & (at > 0), F.array(at, at - 1)).otherwise(F.array(at))
    dealt = ranked.select("node", "turn", "rank", F.posexplode(places).alias("_role", "block"))
    dealt = dealt.select(F.col("node").alias("_node"), "turn", "rank", "block", (F.col("_role") > 0).alias("guest"))
    full = dealt.join(nodes.select("node", "size", "embedding"), F.col("_node") == F.col("node")).drop("_node")
    placed = full.repartition("block").sortWithinPartitions("block", "turn", "size", "rank")
    kind = dict(nodes.dtypes)["node"]
    return placed.mapInArrow(_window_links(window, cosine), f"a {kind}, b {kind}").distinct()


def _counts(cosine: float):
    """Links of every member inside one part, or between two."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "low", "high"]):
            unit, n = _units(group.column("embedding")), group.column("n").to_numpy()
            part = group.column("part").to_numpy()
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            near = np.zeros(len(unit), np.int64)
            if low == high:
                for k in range(0, len(unit), _SLICE):
                    near[k : k + _SLICE] = (unit[k : k + _SLICE] @ unit.T >= cosine) @ n
                    # Every vector meets itself once.
                    itself = np.einsum("ij,ij->i", unit[k : k + _SLICE], unit[k : k + _SLICE]) >= cosine
                    near[k : k + _SLICE] -= itself * n[k : k + _SLICE]
            else:
                one, two = np.flatnonzero(part == low), np.flatnonzero(part == high)
                for k in range(0, len(one), _SLICE):
                    hit = unit[one[k : k + _SLICE]] @ unit[two].T >= cosine
                    near[one[k : k + _SLICE]] += hit @ n[two]
                    near[two] += n[one[k : k + _SLICE]] @ hit
            yield pa.record_batch([group.column("node"), pa.array(near)], names=["node", "near"])

    return scan


def link_counts(members: DataFrame, cosine: float, most: int = MEMBERS) -> DataFrame:
    """(node, near): rows of other vectors linked to each of (root, node, n, embedding), all pairs of a root compared."""
    sizes = members.groupBy(F.col("root").alias("_root")).agg(F.count("*").alias("_size")).filter("_size > 1")
    sized = members.join(stage(sizes, "vector-sizes"), F.col("root") == F.col("_root"))
    parts = F.ceil(F.col("_size") / most)
    sized = sized.withColumn("part", F.pmod(F.xxhash64("node"), parts))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), parts - 1),
        lambda j: F.struct(F.least("part", j).alias("low"), F.greatest("part", j).alias("high")),
    )
    dealt = sized.select("root", "node", "n", "embedding", "part", F.inline(pairs))
    placed = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    kind = dict(members.dtypes)["node"]
    return placed.mapInArrow(_counts(cosine), f"node {kind}, near long").groupBy("node").agg(F.sum("near").alias("near"))


def near_duplicate_vectors(
    df: DataFrame,
    id_: str = "vec_id",
    embedding: str = "embedding",
    cosine: float = COSINE,
    passes: int | None = None,
    window: int = WINDOW,
    block: int = BLOCK,
    members: int = MEMBERS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = df.select(F.col(f"`{id_}`").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    passes = passes or passes_for(rows.count(), cosine, window)
    sketched = rows.withColumn("_s", sketch(F.col("embedding"), passes)).select(
        "vec_id", "embedding", F.col("_s.digest").alias("digest"), F.col("_s.size").alias("size"), F.col("_s.keys").alias("keys")
    )
    vectors = stage(sketched, "vectors")
    able = vectors.filter("digest is not null and vec_id is not null")
    copies = able.select("vec_id", "digest").distinct().groupBy(F.col("digest").alias("_digest"))
    classes = stage(copies.agg(F.min("vec_id").alias("node"), F.count("*").alias("n")), "vector-classes")
    named = able.join(classes, (F.col("digest") == F.col("_digest")) & (F.col("vec_id") == F.col("node")))
    nodes = stage(named.select("node", "n", "size", "keys", "embedding").dropDuplicates(["node"]), "vector-nodes")
    links = stage(window_links(nodes, window, cosine, block), "vector-links")
    roots = stage(components(links), "vector-roots")
    # The least member is its own root.
    tops = roots.select(F.col("root").alias("node"), "root").distinct()
    placed = roots.unionByName(tops).select(F.col("node").alias("_member"), "root")
    grouped = nodes.join(placed, F.col("node") == F.col("_member")).select("root", "node", "n", "embedding")
    counts = stage(link_counts(grouped, cosine, members), "vector-counts").withColumnRenamed("node", "_from")
    known = classes.join(counts, F.col("node") == F.col("_from"), "left").join(placed, F.col("node") == F.col("_member"), "left")
    known = known.select(
        "_digest",
        (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("_root"),
    )
    known = stage(known, "vector-known")
    able_id = F.when(F.col("vec_id").isNotNull(), F.col("digest"))
    out = vectors.select("vec_id", able_id.alias("digest")).join(known, F.col("digest") == F.col("_digest"), "left")
    component = F.coalesce("_root", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
