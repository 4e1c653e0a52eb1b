"""Spelling variants: words one edit apart, by edit-matrix rows over a sorted word list.

Near words are found by walking a sorted list of words with the rows of the edit matrix.  Only
the band that one edit can reach is kept: three cells of a row.  A row depends on the word of
the search and on a prefix of the list, so all words that share the prefix share the row; where
the common prefix of two neighbours in the list (LCP) ends, rows branch.  A range of the list whose shared
prefix is already more than one edit away is left out with all that it holds.  The walk goes
over the positions of the words, with all searches and ranges of a chunk as numpy columns.

How it scales: occurrences are counted with partial sums before any shuffle.  Two words one edit
apart agree in the first half or in the second half of the shorter one, so every word is dealt
to the groups of its halves, and groups are compared apart.  A group with more words than fit
is dealt again by the halves of what is still free, until groups are small or one position is
left; no pair is lost, and the place of the first difference says in which group a pair counts.
Groups send one row per word, with the number of its near words and the best of them, not pairs.
The chain from a word to its root grows by ``ratio`` with each step, so pointers are doubled in a few rounds.

Null and empty texts have no words.  Null ids read as empty text; rows with the same id are counted each.
Ties go to the word that is smaller in code points.  Empty tables give empty results.  Of the
given table only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.session import stage

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
GROUP_ROWS = 20_000  # words that are compared as one group; larger groups are dealt again
GROUP_CELLS = 4_000_000  # code points of a group, likewise
CHUNK_ROWS = 50_000  # rows of whole groups that are walked at once
SEARCHES = 4_096  # searches that are walked at once


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def word_runs(docs: DataFrame, id_: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, run): maximal runs of letters of at least ``least`` code points, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    one = docs.select(F.col(f"`{id_}`").cast("string").alias("doc_id"), F.explode(runs).alias("run"))
    return one.select("doc_id", lower_ascii(F.col("run")).alias("run"))


def dropped_letter(id_: Column, run: Column, every: int = 31) -> Column:
    """The run, or in one of ``every`` cases, by a checksum of id and run, the run without one code point."""
    code = F.crc32(F.concat(F.coalesce(id_, F.lit("")), F.lit(":"), run).cast("binary"))
    at = (code % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(code % every == 0, shorter).otherwise(run)


def count_words(words: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of a column ``word`` of occurrences."""
    counted = words.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


# --- groups of words that agree outside a free part -------------------------------------------


def _halves(rows: DataFrame) -> DataFrame:
    """Deal (word, n, m, lo, s) to both halves of the free part.

    ``m`` is the length of the shorter word of a pair; the first ``lo`` and the last ``s`` code points are
    those of the group.  A pair whose first difference is at the cut or behind it agrees before it; any other agrees behind.
    """
    cut = F.expr("lo + (m - lo - s) div 2").cast("int")
    front = F.struct(cut.alias("lo"), F.col("s").alias("s"))
    back = F.struct(F.col("lo").alias("lo"), (F.col("m") - cut).alias("s"))
    dealt = rows.select("word", "n", "m", F.explode(F.array(front, back)).alias("_part"))
    size = F.length("word")
    dealt = dealt.select("word", "n", "m", "_part.lo", "_part.s")
    group = F.concat_ws(
        ":", "m", "lo", "s", F.expr("substring(word, 1, lo)"), F.when(F.col("s") > 0, F.expr("right(word, s)")).otherwise("")
    )
    return dealt.withColumn("key", group).withColumn("free", F.substring("word", F.col("lo") + 1, size - F.col("lo") - F.col("s")))


def groups(vocabulary: DataFrame, rows: int = GROUP_ROWS, cells: int = GROUP_CELLS) -> DataFrame:
    """Every word in the groups where it can meet words one edit away, each group of a bounded size.

    A word is in groups for pairs with words of its own length or longer (``m`` is its length) and
    shorter (one less).  Groups with one free position are as small as the alphabet makes them.
    """
    lengths = F.explode(F.array(F.length("word"), F.length("word") - 1))
    now = _halves(vocabulary.select("word", "n", lengths.alias("m"), F.lit(0).alias("lo"), F.lit(0).alias("s")).filter("m > 0"))
    ready: list[DataFrame] = []
    while True:
        now = stage(now, "spelling-groups")
        free = F.col("m") - F.col("lo") - F.col("s")
        sizes = now.filter(free > 1).groupBy(F.xxhash64("key").alias("_hot")).agg(
            F.count("*").alias("_n"), F.sum(F.length("free")).alias("_cells")
        )
        hot = stage(sizes.filter((F.col("_n") > rows) | (F.col("_cells") > cells)).select("_hot"), "spelling-hot")
        if hot.isEmpty():
            break
        large = (F.xxhash64("key") == F.col("_hot")) & (free > 1)
        ready.append(now.join(hot, large, "left_anti"))
        now = _halves(now.join(hot, large, "left_semi"))
    for part in ready:
        now = now.unionByName(part)
    return now


# --- the walk over a sorted list ----------------------------------------------------------------


def _matrix(texts: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Code points, a row per text, with zeros behind."""
    flat = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4")
    out = np.zeros((len(sizes), int(sizes.max(initial=0)) + 2), np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def common_prefixes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """LCP of each row with the row before; -1 for the first of a group."""
    same = points[1:] == points[:-1]
    lcp = np.concatenate([[-1], np.where(same.all(axis=1), points.shape[1], same.argmin(axis=1))])
    lcp[first] = -1
    return lcp


def one_edit(points: np.ndarray, sizes: np.ndarray, first: np.ndarray, searches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (search, row) one edit apart, of rows that are distinct and sorted inside their groups.

    ``first`` marks the first row of each group; searches are rows too and look through their own group.
    Cells of a band: the row of the matrix after ``depth`` list characters, at ``depth`` - 1, ``depth`` and
    ``depth`` + 1 characters of the search, with 2 for all that is more than one edit.
    """
    lcp = common_prefixes(points, first)
    starts = np.flatnonzero(lcp < 0)
    group = np.searchsorted(starts, searches, "right") - 1
    who, low = searches, starts[group]
    high = np.append(starts, len(points))[group + 1]
    band = (np.full(len(who), 2, np.int8), np.zeros(len(who), np.int8), np.ones(len(who), np.int8))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for depth in range(points.shape[1]):
        # Words that end here come first in their range; the cell at the end of the search is their distance.
        ended = sizes[low] == depth
        lack = sizes[who] - depth
        for cell, value in enumerate(band):
            hit = ended & (lack == cell - 1) & (value == 1)
            found.append((who[hit], low[hit]))
        # Ranges branch where neighbours part, and only there a new row is computed.
        parts = np.flatnonzero(lcp <= depth)
        child = np.searchsorted(parts, low) + ended
        count = np.searchsorted(parts, high) - child
        from_ = np.repeat(np.arange(len(who)), count)
        if not len(from_):
            break
        nth = np.arange(len(from_)) - np.repeat(np.cumsum(count) - count, count)
        child = child[from_] + nth
        who, low, high = who[from_], parts[child], np.append(parts, len(points))[child + 1]
        sign = points[low, depth]
        left, here, right = (value[from_] for value in band)
        before = points[who, depth - 1] if depth else np.zeros(len(who), np.uint32)
        past = np.minimum(depth + 1, points.shape[1] - 1)
        new_left = np.minimum(left + (before != sign), here + 1)
        new_here = np.minimum(np.minimum(here + (points[who, depth] != sign), right + 1), new_left + 1)
        new_right = np.minimum(right + (points[who, past] != sign), new_here + 1)
        near = np.minimum(np.minimum(new_left, new_here), new_right) <= 1
        who, low, high = who[near], low[near], high[near]
        band = tuple(np.minimum(value[near], 2).astype(np.int8) for value in (new_left, new_here, new_right))
    a, b = (np.concatenate([np.empty(0, np.int64), *side]) for side in zip(*found))
    return a, b


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold whole groups."""
    held: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held.num_rows < rows:
            continue
        keys = held["key"]
        cut = pc.index(keys, keys[-1]).as_py()
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def _blocks(first: np.ndarray, sizes: np.ndarray, cells: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups whose matrix is bounded; rows come by length."""
    edges = np.append(np.flatnonzero(first), len(first))
    begin, widest = 0, 0
    for a, b in zip(edges, edges[1:]):
        widest = max(widest, int(sizes[a:b].max()))
        if a > begin and (b - begin) * (widest + 2) > cells:
            yield begin, int(a)
            begin, widest = int(a), int(sizes[a:b].max())
    if begin < len(first):
        yield begin, len(first)


def _best(table: pa.Table, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """For each ``a`` of the pairs: how many there are, and the ``b`` of largest n, then smallest word."""
    words = table["word"].combine_chunks()
    n = table["n"].to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    of, at, near = np.unique(a, return_index=True, return_counts=True)
    top = b[at]
    return pa.record_batch(
        [words.take(pa.array(of)), pa.array(near.astype(np.int64)), pa.array(n[top]), words.take(pa.array(top))],
        names=["word", "n_near", "best_n", "best"],
    )


def _search_groups(rows: int, cells: int, searches: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, rows):
            m, lo, s = (table[c].to_numpy() for c in ("m", "lo", "s"))
            texts = table["free"].combine_chunks()
            sizes = pc.utf8_length(texts).to_numpy()
            keys = table["key"].combine_chunks()
            first = np.concatenate([[True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)])
            for begin, end in _blocks(first, sizes, cells):
                part = slice(begin, end)
                points = _matrix(texts[part], sizes[part])
                base, own_first = m[part] - lo[part] - s[part], first[part]
                group = np.cumsum(own_first) - 1
                own = sizes[part] == base
                # Only groups that hold a word of the shorter length and another word.
                worth = (np.bincount(group, own) > 0) & (np.bincount(group) > 1)
                todo = np.flatnonzero(own & worth[group])
                block = table.slice(begin, end - begin)
                for k in range(0, len(todo), searches):
                    a, b = one_edit(points, sizes[part], own_first, todo[k : k + searches])
                    longer = ~own[b]
                    # A letter added behind the free part counts in the group of the front half.
                    behind = longer & (s[part][a] > 0)
                    behind[behind] = [np.array_equal(points[i, :w], points[j, :w]) for i, j, w in zip(a[behind], b[behind], base[a[behind]])]
                    a, b, longer = a[~behind], b[~behind], longer[~behind]
                    if len(a):
                        yield _best(block, np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]]))

    return scan


def near_words(
    vocabulary: DataFrame,
    rows: int = GROUP_ROWS,
    cells: int = GROUP_CELLS,
    chunk: int = CHUNK_ROWS,
    searches: int = SEARCHES,
) -> DataFrame:
    """(word, n_near, best, best_n) of the words of (word, n) that have others one edit away."""
    dealt = groups(vocabulary, rows, cells).select("m", "key", "free", "word", "n", "lo", "s")
    placed = dealt.repartition("key").sortWithinPartitions("m", "key", "free")
    found = placed.mapInArrow(_search_groups(chunk, cells, searches), "word string, n_near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("_top"))
    return merged.select("word", "n_near", F.col("_top.best").alias("best"), (-F.col("_top.less")).alias("best_n"))


# --- forms and roots ------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word of each chain, by doubling of pointers."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        joined = now.join(ahead, F.col("root") == F.col("_word"), "left")
        after = stage(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def spelling_forms(vocabulary: DataFrame, ratio: int = RATIO, **limits) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table (word, n) of distinct words."""
    words = stage(vocabulary.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, **limits).withColumnRenamed("word", "_word")
    known = words.join(near, F.col("word") == F.col("_word"), "left")
    leads = F.col("best_n") >= ratio * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best")).alias("form"),
        F.when(leads, F.col("best_n")).alias("form_n"),
    )
    known = stage(known, "spelling-known")
    ends = roots(known.filter("form is not null")).withColumnRenamed("word", "_word")
    return known.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_report(docs: DataFrame) -> DataFrame:
    """Forms of the words of all documents, with one occurrence in 31 misspelt."""
    runs = word_runs(docs)
    return spelling_forms(count_words(runs.select(dropped_letter(F.col("doc_id"), F.col("run")).alias("word"))))


def crc_sql(hexed: str) -> str:
    """DuckDB: the unsigned CRC-32 of bytes given in hex; needs the relation ``_crc`` (t: the table by byte)."""
    return (
        f"xor(list_reduce(list_transform(range(length({hexed}) // 2), lambda i: "
        f"('0x' || substr({hexed}, 2 * i + 1, 2))::BIGINT), "
        "lambda c, b: xor(c >> 8, _crc.t[xor(c, b) % 256 + 1]), 4294967295), 4294967295)"
    )


#: The table of the reflected polynomial, by its rule.
CRC_TABLE_SQL = """_crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
)"""


def spelling_sql() -> str:
    """The same in DuckDB: words meet by what is left of them without one code point."""
    return f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '{LETTERS}{{7,}}')),
    '{ascii_uppercase}', '{ascii_lowercase}') AS w FROM documents
), hexed AS (
  SELECT w, hex(d || ':' || w) AS x, count(*) AS k FROM runs GROUP BY ALL
), coded AS (
  SELECT w, k, {crc_sql("x")} AS h FROM hexed, _crc
), words AS MATERIALIZED (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word,
    sum(k)::BIGINT AS n FROM coded GROUP BY 1 HAVING length(word) >= 7 AND sum(k) >= 2
), cuts AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS MATERIALIZED (
  SELECT a.word AS word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), tops AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top_n, arg_min(near, (-near_n, near)) AS top FROM pairs GROUP BY word
), known AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(t.n_near, 0) AS n_near, CASE WHEN top_n >= 10 * n THEN top END AS form,
    CASE WHEN top_n >= 10 * n THEN top_n END AS form_n
  FROM words w LEFT JOIN tops t USING (word)
), chain AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT c.word, k.form FROM chain c JOIN known k ON c.root = k.word WHERE k.form IS NOT NULL
), ends AS (
  SELECT c.word, c.root FROM chain c JOIN known k ON c.root = k.word WHERE k.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN ends USING (word)
"""
