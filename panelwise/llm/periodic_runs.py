"""Maximal periodic runs of words, by longest common extensions in suffix trees.

Ukkonen's algorithm builds the suffix trees of a text and of its reversal. An
Euler tour of a tree gives the depth of the lowest common ancestor of any two of
its leaves as a range minimum, so the longest common extension of two places
takes constant time. For either order of the alphabet, the longest Lyndon word
that starts at a place ends before the next smaller suffix; the Lyndon roots of
all runs are among these, and each is extended in both directions.

Trees are built over the stretches of a text where a run can lie. All words of a
run but its first `period` were seen at most a period before, and so were the
shingles of up to SHINGLE words in it; places without such a repetition nearby
are ruled out by one sort. This loses no run, as `test_stretches_lose_no_run`
proves on small alphabets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .substring_dedup import kept_text
from .textkernel import Words, ngrams, slices

#: Least length of a run, and least multiple of its period.
LEAST, TIMES = 6, 4
#: Words of the shingles whose repetition tells where runs of longer periods can lie.
SHINGLE = 8


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Ukkonen's suffix tree of s, whose last symbol occurs nowhere else.

    Nodes 0 to n - 1 are the leaves of the suffixes in order, n is the root.
    Gives the start of each node's edge in s, the end of each inner node's edge
    (at node - n), the children by parent * width + first symbol, and width.
    """
    n, width = len(s), max(s) + 1
    start, end, link, child = [0] * (2 * n), [0] * n, [n] * n, {}
    root = node = n
    new, leaf, edge, length, left = n + 1, 0, 0, 0, 0
    for i, c in enumerate(s):
        left += 1
        last = -1
        while left:
            if not length:
                edge = i
            key = node * width + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = leaf
                start[leaf] = i
                leaf += 1
                if last >= 0:
                    link[last - n] = node
                    last = -1
            else:
                a = start[below]
                if below > n:
                    span = end[below - n] - a
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                if s[a + length] == c:
                    if last >= 0:
                        link[last - n] = node
                    length += 1
                    break
                start[new], end[new - n] = a, a + length
                child[key] = new
                child[new * width + c] = leaf
                start[leaf] = i
                leaf += 1
                start[below] = a + length
                child[new * width + s[a + length]] = below
                if last >= 0:
                    link[last - n] = new
                last = new
                new += 1
            left -= 1
            if node == root:
                if length:
                    length -= 1
                    edge = i - left + 1
            else:
                node = link[node - n]
    return start, end, child, width


class Extensions:
    """Longest common extensions of the suffixes of s, and their ranks under the alphabet's order and under its reverse (ends first in both)."""

    def __init__(self, s: list[int], orders: bool):
        n = len(s)
        start, end, child, width = suffix_tree(s)
        keys, nodes = np.fromiter(child, np.int64, len(child)), np.fromiter(child.values(), np.int64, len(child))
        del child
        parents, symbols = keys // width, keys % width
        by = np.lexsort((symbols, parents))
        bounds = np.searchsorted(parents[by], np.arange(n, 2 * n + 1)).tolist()
        tour, depths = self._tour(n, start, end, nodes[by].tolist(), bounds)
        self.rank = np.empty(n, np.int64)
        self.rank[tour] = np.arange(n)
        self.reversed_rank = None
        if orders:  # the symbol 0 ends s and comes first in both orders
            turned = np.lexsort((np.where(symbols == 0, -width, -symbols), parents))
            back, _ = self._tour(n, start, end, nodes[turned].tolist(), bounds)
            self.reversed_rank = np.empty(n, np.int64)
            self.reversed_rank[back] = np.arange(n)
        self.minima = [np.array(depths, np.int32)]
        while (half := 1 << len(self.minima) - 1) * 2 <= len(depths):
            below = self.minima[-1]
            self.minima.append(np.minimum(below[:-half], below[half:]))

    @staticmethod
    def _tour(n: int, start: list[int], end: list[int], children: list[int], bounds: list[int]) -> tuple[list[int], list[int]]:
        """The leaves in the order of an Euler tour, and the least depth the tour comes down to between two of them."""
        depth = [0] * n
        leaves, between, todo, above, fresh = [], [], [n], [n], False
        while todo:
            node, parent = todo.pop(), above.pop()
            if fresh:
                between.append(depth[parent - n])
                fresh = False
            if node < n:
                leaves.append(node)
                fresh = True
                continue
            if node > n:
                depth[node - n] = depth[parent - n] + end[node - n] - start[node]
            own = children[bounds[node - n] : bounds[node - n + 1]]
            own.reverse()
            todo += own
            above += [node] * len(own)
        return leaves, between

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at i and j (never equal) have in common."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            own = level == k
            table = self.minima[k]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller rank; the last place has the smallest."""
    out, open_ = [0] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least `least` symbols and `times` periods, by start and period. Symbols are integers from 1."""
    n = len(symbols)
    if n < max(least, times):
        return []
    ahead = Extensions([*symbols.tolist(), 0], True)
    behind = Extensions([*symbols[::-1].tolist(), 0], False)
    found = []
    for rank in (ahead.rank, ahead.reversed_rank):
        i, j = np.arange(n), np.array(_next_smaller(rank.tolist())[:n])
        own = (j < n) & (times * (j - i) <= n)
        i, j = i[own], j[own]
        right, left = ahead(i, j), np.zeros(len(i), np.int64)
        has = np.flatnonzero(i > 0)
        left[has] = behind(n - i[has], n - j[has])
        found.append(np.stack([i - left, j + right - i + left, j - i], axis=1))
    every = np.concatenate(found)
    every = every[every[:, 1] >= np.maximum(least, times * every[:, 2])]
    return [tuple(r) for r in np.unique(every[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]].tolist()]


def _since(values: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Distance of each value to the one before that equals it in the same text; huge where there is none."""
    out = np.full(len(values), 1 << 40)
    order = np.lexsort((values, texts))
    a, b = order[:-1], order[1:]
    same = (values[a] == values[b]) & (texts[a] == texts[b])
    out[b[same]] = b[same] - a[same]
    return out


def stretches_with_runs(hashes: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of stretches, each within one text, that hold every run and a word on either side of it.

    In a run of period q, words from the q-th on lie at most q after an equal
    one, and so do the shingles of g words in it. So for q in (2**(k - 1), 2**k],
    places whose distance is at most 2**k fill a row of at least
    max((times - 1) * q, least - q) - g + 1 of them.
    """
    counts = np.diff(offsets)
    n, longest = len(hashes), int(counts.max(initial=0))
    cover, texts = np.zeros(n + 1, np.int64), np.repeat(np.arange(len(counts)), counts)
    first, last = offsets[:-1][texts], offsets[1:][texts]
    k, g = 0, 0
    while (q := (1 << k >> 1) + 1) <= longest // times:
        if g != (g := SHINGLE if q > SHINGLE else 1):
            keys = ngrams(hashes, g) if g > 1 else hashes
            whole = np.flatnonzero(np.arange(len(keys)) + g <= last[: len(keys)])
            since = np.full(n, 1 << 40)
            since[whole] = _since(keys[whole], texts[whole])
        row = max(max((times - 1) * q, least - (1 << k)) - g + 1, 1)
        edges = np.diff(np.concatenate([[0], (since <= 1 << k).astype(np.int8), [0]]))
        a, b = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        long = b - a >= row
        a, b = a[long], b[long]
        np.add.at(cover, np.maximum(a - (1 << k) - 1, first[a]), 1)
        np.add.at(cover, np.minimum(b + g, last[a]), -1)
        k += 1
    inside = np.concatenate([[0], np.cumsum(cover)[:-1] > 0, [0]]).astype(np.int8)
    a, b = np.flatnonzero(np.diff(inside) > 0), np.flatnonzero(np.diff(inside) < 0)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = np.unique(cuts[(inside[cuts] > 0) & (inside[cuts + 1] > 0)])  # stretches of neighbouring texts that touch
    return np.sort(np.concatenate([a, cuts])), np.sort(np.concatenate([b, cuts]))


def runs_of_texts(words: Words, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by text, start and period, and the text of each.

    The stretches are one string with a symbol of its own between any two, which no run can hold.
    """
    first, end = stretches_with_runs(words.hash, words.offsets, least, times)
    if not len(first):
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
    sizes = end - first
    at = np.cumsum(sizes + 1) - sizes - 1  # where each stretch begins in the string
    source = np.repeat(first - at, sizes) + (places := np.delete(np.arange(at[-1] + sizes[-1] + 1), at + sizes))
    distinct, ranks = np.unique(words.hash[source], return_inverse=True)
    string = np.empty(at[-1] + sizes[-1] + 1, np.int64)
    string[places] = ranks + 1
    string[at + sizes] = len(distinct) + 1 + np.arange(len(sizes))
    found = np.array(runs(string, least, times), np.int64).reshape(-1, 3)
    own = np.searchsorted(at, found[:, 0], side="right") - 1
    found[:, 0] += (first - at)[own]
    text = np.searchsorted(words.offsets, found[:, 0], side="right") - 1
    found[:, 0] -= words.offsets[text]
    order = np.lexsort((found[:, 2], found[:, 0], text))
    return found[order], text[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _searched(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = Words(part.column("text"), lower=False)
            found, text = runs_of_texts(words, least, times)
            gone = np.zeros(len(words.hash) + 1, np.int64)
            first = words.offsets[text] + found[:, 0]
            np.add.at(gone, first + found[:, 2], 1)
            np.add.at(gone, first + found[:, 1], -1)
            kept = kept_text(words, np.cumsum(gone)[:-1] > 0)
            offsets = np.searchsorted(text, np.arange(words.n_texts + 1)).astype(np.int32)
            own = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(found[:, c]) for c in range(3)], fields=list(_RUN)))
            yield pa.RecordBatch.from_arrays([part.column("id"), own, pa.array([x.decode() for x in kept], pa.string())], names=["id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """id_col, runs (array of start, length, period by start, then period) and collapsed of every row.

    A run is a stretch of words (runs of bytes other than space and tab to
    carriage return) with smallest period q, at least `least` words and `times`
    periods long (`times` >= 2), that no neighbouring word extends. collapsed has
    the words joined by one space, without those that a run contains after its
    first q words. Null and empty texts have no runs and collapse to an empty
    string; rows are treated one by one, so null and repeated ids each give their
    row; other columns are ignored, an empty table gives no rows. A text is one
    task's work, about 400 bytes for each word inside the stretches that can hold a run.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_searched(least, times), schema).withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and text_col; every tenth document by crc32 of its id repeats its words periodically from a word on.

    With h = crc32 of the id as text and g = floor(h / 10), where h % 10 = 0 and
    the text has n > 0 words, word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)). Null ids are left as they are.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"))
    words = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))).withColumn("n", F.size("w"))
    placed = words.withColumn("a", F.expr("if(n > 0, int((h div 10) % n), 0)")).withColumn("p", F.expr("int(1 + (n - a) div (3 + (h div 10) % 8))"))
    turned = "concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p)))), 1, n - a))"
    return placed.select(F.col("id").alias(id_col), F.expr(f"if(n > 0, array_join({turned}, ' '), text)").alias(text_col))


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_runs, the run of greatest length / period (ties: smallest start, then period), and SHA-256 of the runs' lines and of the collapsed text."""
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top)
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    out = found.withColumn("_best", best).withColumn("_lines", F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""))
    return out.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"), F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(F.col("_lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    )
