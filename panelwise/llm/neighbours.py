"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots and posted in their
inverted files. A query opens the files of its own nearest pivots and counts in
how many of them each vector is; those met most often are ranked by the footrule
distance of the two orders, and the best of these are ranked again by the exact
measure. Orders know directions only, so a block also learns which cosine a count
and a footrule stand for, on pairs of its own, and both rankings are by that
cosine times the vector's norm. Vectors are indexed in blocks, so a task holds
one block's files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Files that a vector is posted in, and that a query opens, of all pivots.
POSTED, PROBED = 48, 96
#: Pivots are a power of two near PIVOTS_BY * sqrt(vectors), within these bounds; the first ORDER of them make the orders that are compared.
PIVOTS_BY, LEAST_PIVOTS, MOST_PIVOTS, ORDER = 4.5, 256, 4096, 256
#: Share of a block, and least number, whose footrule a query takes, and which it ranks again exactly.
COUNTED, LEAST_COUNTED = 0.1, 500
EXACT, LEAST_EXACT = 0.04, 160
#: Entries of a block that it learns from, vectors whose orders are taken at once, and most vectors of a block.
LEARNED, SLICE, MOST = 48, 1024, 32768


def pivots_for(vectors: int) -> int:
    return int(np.clip(1 << round(float(np.log2(max(PIVOTS_BY * vectors**0.5, 1)))), LEAST_PIVOTS, MOST_PIVOTS))


def _numbered(rows: np.ndarray) -> np.ndarray:
    """Equal rows get equal numbers, from 0 in the order of their first."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(row.tobytes(), len(seen)) for row in rows], dtype=np.int64)


def _runs(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the runs starts[i]:ends[i]."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def orders(x: np.ndarray, pivots: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """(the places of the first ORDER pivots in each vector's order, its `near` nearest pivots of all), SLICE vectors at a time."""
    near = min(near, len(pivots))
    places, nearest_of_all = np.empty((len(x), min(ORDER, len(pivots))), dtype=np.int16), np.empty((len(x), near), dtype=np.int16)
    for at in range(0, len(x), SLICE):
        products = -(x[at : at + SLICE] @ pivots.T)
        own = np.argsort(products[:, :ORDER], axis=1, kind="stable")
        np.put_along_axis(places[at : at + SLICE], own, np.arange(own.shape[1], dtype=np.int16)[None], axis=1)
        nearest_of_all[at : at + SLICE] = np.argpartition(products, near - 1, axis=1)[:, :near]
    return places, nearest_of_all


def _cosines(feature: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(levels of the feature, mean cosine at each): steps of equal numbers of pairs, to be read off by interpolation."""
    order = np.argsort(feature, kind="stable")
    parts = np.array_split(order, min(24, max(len(order) // 32, 1)))
    return np.array([feature[p].mean() for p in parts]), np.array([cosine[p].mean() for p in parts])


class Block:
    """The inverted files of one block. Equal vectors, and then equal orders, are one entry; of equal vectors the k + 1 smallest ids suffice."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int):
        same = _numbered(x)
        order = np.lexsort((ids, same))
        order = order[(np.diff(same[order], prepend=-1) != 0) | (np.diff(ids[order], prepend=ids[order[0]]) != 0)]
        first, step = np.diff(same[order], prepend=-1) != 0, np.arange(len(order))
        members = order[step - np.maximum.accumulate(np.where(first, step, 0)) <= k]
        heads = np.flatnonzero(np.diff(same[members], prepend=-1))
        places, near = orders(x[members[heads]], pivots, POSTED)
        group = _numbered(places)
        by_group = np.argsort(group, kind="stable")
        self.entry = np.append(np.flatnonzero(np.diff(group[by_group], prepend=-1)), len(group))
        self.vector, self.member = by_group, np.append(heads, len(members))
        self.ids, self.x = ids[members], x[members[heads]]
        one = by_group[self.entry[:-1]]
        self.places, flat = places[one], near[one].ravel()
        by_file = np.argsort(flat, kind="stable")
        self.posted, self.file = by_file // near.shape[1], np.searchsorted(flat[by_file], np.arange(len(pivots) + 1))
        self.size = len(one)
        norms = np.sqrt((self.x * self.x).sum(axis=1))
        self.norm = np.maximum.reduceat(norms[self.vector], self.entry[:-1]) if self.size else np.zeros(0)
        self.alike = not self.size or bool(self.norm.max() <= self.norm.min() * (1 + 1e-6))
        self._learn(pivots)

    def _learn(self, pivots: np.ndarray) -> None:
        """Which cosine a count and a footrule stand for: on some entries as queries against the entries nearest to them and as many others."""
        if self.alike or self.size < 2:
            return
        rng = np.random.default_rng(11)
        unit = self.x[self.vector[self.entry[:-1]]]
        unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        asks = rng.choice(self.size, min(self.size, LEARNED), replace=False)
        places, files = orders(unit[asks], pivots, PROBED)
        others, felt = rng.choice(self.size, min(self.size, 256), replace=False), []
        for own, place, opened in zip(asks.tolist(), places, files, strict=True):
            times = self._times(opened)
            cosine = unit @ unit[own]
            cosine[own] = -2
            to = np.unique(np.concatenate([np.argpartition(-cosine, min(64, self.size - 1))[:64], others]))
            to = to[to != own]
            felt.append((times[to], np.abs(self.places[to] - place).sum(axis=1, dtype=np.int32), cosine[to]))
        times, far, cosine = (np.concatenate(x) for x in zip(*felt, strict=True))
        self.by_times, self.by_far = _cosines(times, cosine), _cosines(far, cosine)

    def _times(self, files: np.ndarray) -> np.ndarray:
        """In how many of the files each entry is."""
        return np.bincount(np.concatenate([self.posted[self.file[f] : self.file[f + 1]] for f in files.tolist()]), minlength=self.size)

    def candidates(self, places: np.ndarray, files: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(entries whose footrule is taken, those of them that are ranked exactly), all that tie with the last included."""
        counted, exact = max(LEAST_COUNTED, k + 1, int(COUNTED * self.size)), max(LEAST_EXACT, k + 1, int(EXACT * self.size))
        met = np.arange(self.size)
        if self.size > counted:
            times = self._times(files)
            worth = times if self.alike else self.norm * np.interp(times, *self.by_times)
            often = np.flatnonzero((worth >= np.partition(worth, self.size - counted)[self.size - counted]) & (times > 0))
            met = often if len(often) > k else met
        if len(met) <= exact:
            return met, met
        far = np.abs(self.places[met] - places).sum(axis=1, dtype=np.int32)
        cost = far if self.alike else -self.norm[met] * np.interp(far, *self.by_far)
        return met, met[cost <= np.partition(cost, exact - 1)[exact - 1]]

    def search(self, query: int, x: np.ndarray, places: np.ndarray, files: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best that are not the query."""
        best = self.candidates(places, files, k)[1]
        vectors = self.vector[_runs(self.entry[best], self.entry[best + 1])]
        score = (self.x[vectors] * x).sum(axis=1)
        rows = _runs(self.member[vectors], self.member[vectors + 1])
        ids, score = self.ids[rows], np.repeat(score, self.member[vectors + 1] - self.member[vectors])
        ids, score = ids[ids != query], score[ids != query]
        top = np.lexsort((ids, -score))[:k]
        return ids[top], score[top]


def _matrix(table: pa.Table) -> np.ndarray:
    return table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(table.num_rows, -1)


def _searched(pivots, k: int):
    def run(base: pa.Table, queries: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if base.num_rows and queries.num_rows:
            block = Block(base.column("id").to_numpy(), _matrix(base), pivots.value, k)
            x = _matrix(queries)
            names = queries.column("id").to_pylist()
            for at in range(0, len(names), SLICE):
                places, files = orders(x[at : at + SLICE], pivots.value, PROBED)
                own = [(np.full(k, query), *block.search(query, x[at + i], places[i], files[i], k)) for i, query in enumerate(names[at : at + SLICE])]
                found.append(tuple(np.concatenate(y) for y in zip(*((a[: len(b)], b, c) for a, b, c in own), strict=True)))
        a, b, c = (np.concatenate(y) for y in zip(*found, strict=True))
        return pa.table({"query_id": a, "vec_id": b, "score": c})

    return run


def nearest(vectors: DataFrame, queries: str, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row that the SQL condition `queries` picks, its k nearest found among all other rows.

    Nearness is the inner product in double precision; ties go to the smaller
    id. Vectors that are null, zero, hold null or non-finite components or differ
    in length from the pivots take no part, nor do null ids. Equal rows count
    once; rows that share an id are not candidates of each other and answer as
    one query. Pivots come from a bounded sample, the rows of least id hash;
    every row is indexed. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if dict(vectors.dtypes)[vec_col] == "array<float>" else "array<double>"  # floats travel as floats
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec"),
        F.coalesce(F.expr(queries), F.lit(False)).alias("asks")
    )
    finite = "forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vec, x -> x <> 0)"
    rows = rows.where(f"id is not null and size(vec) > 0 and {finite}")
    n = rows.count()
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(2 * pivots_for(n)).collect()  # twice as many, as copies are one pivot; 4 MB at most of 64 components
    sample = np.array([r.vec for r in picked if len(r.vec) == len(picked[0].vec)])
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = sample[np.sort(np.unique(_numbered(sample), return_index=True)[1])][: pivots_for(n)]
    pivots = spark.sparkContext.broadcast(sample / np.linalg.norm(sample, axis=1, keepdims=True))
    rows = rows.where(F.size("vec") == sample.shape[1])
    n, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks = -(-n // int(np.clip(n // 16, 4096, MOST))) or 1
    chunks = -(-asking // int(np.clip(asking // 4, 1024, 65536))) or 1
    dealt = lambda many: F.pmod(F.xxhash64("id"), F.lit(many)).cast("int")
    spread = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    base = rows.select("id", "vec", dealt(blocks).alias("block"), spread(chunks).alias("chunk"))
    asks = rows.where("asks").select("id", "vec").distinct().select("id", "vec", spread(blocks).alias("block"), dealt(chunks).alias("chunk"))
    key = ["block", "chunk"]
    found = base.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(_searched(pivots, k), "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
