"""Language-model scores of whole documents: word counts on Spark, a recurrent model trained and applied in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from .scratch import stored
from .textkernel import U, Words, slices, stretches

#: Words with counts in a broadcast table (6 MB at most), and those of them that the model tells apart; the rest is joined by hash.
FREQUENT, VOCABULARY = 1 << 18, 4096
#: Training words of one group, and the rounds in which the groups go over them: after each, their models are averaged and all go on from there.
GROUP_WORDS, ROUNDS = 1 << 22, 12
#: Words that are fitted or scored at once.
BATCH = 1 << 21
#: Numbers of the model in one row of the averaging, and rows that one task of its first step adds up.
PIECE, LANES = 4096, 64
END = np.uint64(0x656E64)


def _with_end(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes as signed numbers with the end sign after each text, and offsets."""
    offsets = words.offsets + np.arange(words.n_texts + 1)
    out = np.full(offsets[-1], END, dtype=U)
    inside = np.ones(len(out), dtype=bool)
    inside[offsets[1:] - 1] = False
    out[inside] = words.hash
    return out.view(np.int64), offsets


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n in texts to learn from, n in all) of a partition, summed as far as memory of a few million words goes."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, learned, every = (np.concatenate(x) for x in zip(*held, strict=True))
        word, back = np.unique(words, return_inverse=True)
        return word, *(np.bincount(back, x, minlength=len(word)).astype(np.int64) for x in (learned, every))

    def out() -> Iterator[pa.RecordBatch]:
        columns = merged()
        for at in range(0, len(columns[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000]) for x in columns], names=["word", "n", "every"])

    for part in slices(batches, "text"):
        words, offsets = _with_end(Words(part.column("text"), lower=True))
        word, back = np.unique(words, return_inverse=True)
        learn = np.repeat(part.column("learn").to_numpy(zero_copy_only=False), np.diff(offsets))
        held.append((word, np.bincount(back, learn, minlength=len(word)), np.bincount(back, minlength=len(word))))
        size += len(word)
        if size > 3_000_000:
            held = [merged()]
            size = len(held[0][0])
            if size > 1_500_000:
                yield from out()
                held, size = [], 0
    if held:
        yield from out()


class Table:
    """Counts of the frequent words by hash, and their numbers in the model's vocabulary."""

    def __init__(self, rows: list[tuple[int, int]]):
        self.lm = np.array([n for _, n in rows[:VOCABULARY] if n > 0], dtype=np.int64)
        word = np.array([w for w, _ in rows], dtype=np.int64)
        order = np.argsort(word)
        self.word, self.n = word[order], np.array([n for _, n in rows], dtype=np.int64)[order]
        self.number = np.minimum(order, len(self.lm))

    def look(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether it is here, its count, its number, which is the vocabulary's size for all other words)."""
        if not len(self.word):
            return np.zeros(len(word), bool), np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        here = self.word[at] == word
        return here, np.where(here, self.n[at], 0), np.where(here, self.number[at], len(self.lm))


def _frequent(counts: DataFrame) -> list[tuple[int, int]]:
    """(word, n) of all words above the least count in all documents that leaves FREQUENT of them or fewer, in descending order of n.

    So no word outside is in more documents than that count. Counts from 1,024 on
    are told apart by 64 steps for each doubling, so the table that fixes the
    least one has some thousand rows.
    """
    step = F.expr("if(every < 1024, every, 1024 + cast(64 * log2(every / 1024) as bigint))")
    least, many = 0, 0
    for at, words in sorted(counts.groupBy(step.alias("at")).count().collect(), reverse=True):
        many += words
        if many > FREQUENT:
            least = at + 1
            break
    found = counts.where(step >= least).select("word", "n").toPandas().sort_values(["n", "word"], ascending=[False, True])
    return list(zip(found["word"].tolist(), found["n"].tolist(), strict=True))


_ENCODED = "round int, grp long, place long, words binary"


def _encoded(table):
    """Each text's words and its end by their numbers in the model's vocabulary, two bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            word, offsets = _with_end(Words(part.column("text"), lower=True))
            number = table.value.look(word)[2].astype("<i2")
            blobs = [number[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("round", "grp", "place")), pa.array(blobs, pa.binary())], names=["round", "grp", "place", "words"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], limit: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of all words of each whole text, and offsets, in blocks of about `limit` words."""
    held, size = [], 0
    for batch in batches:
        for blob in batch.column("words"):
            held.append(np.frombuffer(blob.as_buffer(), "<i2").astype(np.int32))
            size += len(held[-1])
            if size > limit:
                yield np.concatenate(held), np.concatenate([[0], list(map(len, held))]).cumsum()
                held, size = [], 0
    if held:
        yield np.concatenate(held), np.concatenate([[0], list(map(len, held))]).cumsum()


_MODEL = "piece long, lane long, blob binary, weight long"


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[n].ravel() for n in gru.SHAPES]).astype(float)


def _model_rows(total: np.ndarray, weight: int, lane: int) -> pa.RecordBatch:
    """Sums of weighted models, PIECE numbers a row."""
    blobs = [total[a : a + PIECE].tobytes() for a in range(0, len(total), PIECE)]
    k = len(blobs)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(k), pa.int64()), pa.array([lane] * k, pa.int64()), pa.array(blobs, pa.binary()), pa.array([weight] * k, pa.int64())],
        names=["piece", "lane", "blob", "weight"]
    )


def _fitting(state):
    """The sum of a partition's models and of their steps' squares, one a group, each trained on from `state` on all words of its texts and weighted by their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = 0, 0
        for _, group in groupby(stretches(batches, ("grp",)), key=lambda part: part.column("grp")[0].as_py()):
            words = 0

            def counted(group=group) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                nonlocal words
                for block in _blocks(group):
                    words += len(block[0])
                    yield block

            p, squares = gru.train(state.value[0], counted(), squares=state.value[1])
            total, weight = total + np.concatenate([_flat(p), _flat(squares)]) * words, weight + words
        if weight:
            yield _model_rows(total, weight, TaskContext.get().partitionId() % LANES)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for piece, blob, weight in zip(*(batch.column(c).to_pylist() for c in ("piece", "blob", "weight")), strict=True):
            old = sums.setdefault(piece, [0, 0])
            old[0], old[1] = old[0] + np.frombuffer(blob), old[1] + weight
    if sums:
        blobs, weights = zip(*sums.values(), strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.nulls(len(sums), pa.int64()), pa.array([x.tobytes() for x in blobs], pa.binary()), pa.array(weights, pa.int64())],
            names=["piece", "lane", "blob", "weight"]
        )


def _averaged(models: DataFrame, params: dict[str, np.ndarray], squares: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The means of the models and of their steps' squares, weighted by their words; what was given where there are none."""
    sums = models.repartition("piece", "lane").mapInArrow(_summed, _MODEL).repartition("piece").mapInArrow(_summed, _MODEL)
    rows = sorted(sums.select("piece", "blob", "weight").collect())  # one model and its squares, 2 MB
    if not rows:
        return params, squares
    flat = np.concatenate([np.frombuffer(blob) / weight for _, blob, weight in rows]).astype(np.float32)
    cuts = np.cumsum([params[n].size for n in gru.SHAPES] * 2)[:-1]
    parts = np.split(flat, cuts)
    shaped = [{n: x.reshape(params[n].shape) for n, x in zip(gru.SHAPES, own, strict=True)} for own in (parts[: len(gru.SHAPES)], parts[len(gru.SHAPES) :])]
    return params | shaped[0], shaped[1]


def fitted(learned: DataFrame, words: int, table, params: dict[str, np.ndarray], group_words: int) -> dict[str, np.ndarray]:
    """params trained on all texts of learned (id, text), which have so many words, in groups of group_words and ROUNDS rounds."""
    spark, place = learned.sparkSession, F.xxhash64("id", "text")
    dealt = learned.select(
        F.pmod(F.xxhash64(place, F.lit(1)), F.lit(ROUNDS)).cast("int").alias("round"), F.pmod(place, F.lit(-(-words // group_words))).alias("grp"), place.alias("place"), "text"
    )
    encoded = stored(dealt.mapInArrow(_encoded(table), _ENCODED), "zstd", "round")
    squares = gru.no_steps(params)
    for number in range(ROUNDS):
        own = encoded.where(F.col("round") == number).select("grp", "place", "words").repartition("grp").sortWithinPartitions("grp", "place")
        state = spark.sparkContext.broadcast((params, squares))  # 2 MB
        params, squares = _averaged(own.mapInArrow(_fitting(state), _MODEL), params, squares)
    return params


_SCORED = "row long, id long, n_tokens long, known long, logs double, other_logs double, others long, state_score double, words array<long>, times array<long>"


def _rare(word: np.ndarray, offsets: np.ndarray, here: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Each text's distinct words outside the table, and how often they occur in it."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    other = np.flatnonzero(~here)
    order = other[np.lexsort((word[other], owner[other]))]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(word[order]) != 0) | (np.diff(owner[order]) != 0)])) if len(order) else np.zeros(0, int)
    ends = pa.array(np.searchsorted(owner[order[new]], np.arange(len(offsets))).astype(np.int32))
    return tuple(pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int64))) for x in (word[order[new]], np.diff(np.append(new, len(order)))))


def _scored(table, params):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, row = [], 0, TaskContext.get().partitionId() << 33

        def out() -> Iterator[pa.RecordBatch]:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([x[1] for x in held]))])
            number = np.concatenate([x[2] for x in held])
            score = gru.document_scores(params.value, number, offsets) / np.log(10)
            at = 0
            for columns, sizes, _ in held:
                yield pa.RecordBatch.from_arrays(
                    [*columns[:7], pa.array(score[at : at + len(sizes)]), *columns[7:]], names=[c.split()[0] for c in _SCORED.split(", ")]
                )
                at += len(sizes)

        for part in slices(batches, "text"):
            word, offsets = _with_end(Words(part.column("text"), lower=True))
            here, n, number = table.value.look(word)
            other = (number == len(table.value.lm)).astype(np.int64)
            logs = np.log10(n + 1.0)
            known, others, logs, other_logs = (np.add.reduceat(x, offsets[:-1]) for x in ((n > 0).astype(np.int64), other, logs, logs * other))
            columns = [
                pa.array(np.arange(row, row + part.num_rows)), part.column("id"),
                *map(pa.array, (np.diff(offsets), known, logs, other_logs, others)), *_rare(word, offsets, here)
            ]
            held.append((columns, np.diff(offsets), number.astype(np.int32)))
            size, row = size + len(word), row + part.num_rows
            if size > BATCH:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return run


def score_documents(docs: DataFrame, train_condition: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row.

    Tokens are the lower-cased words and one end. Counts cover all documents for
    which train_condition, an SQL condition, holds. The model's vocabulary is the
    4,096 most frequent tokens; a word outside has the chance of that class,
    given the state, times its smoothed share of the class, so the chances of all
    words and one unknown add up to 1. Training documents are dealt to groups of
    about 4 million words, and to twelve rounds, by hashes of id and text; in each
    round each group trains the model on every word and end of its documents of
    that round, the state going on through a document, and the groups' models
    are averaged before the next. So the model depends on the rows alone, but for
    rounding, not on how they are partitioned. Null texts are empty; equal texts
    score alike; null ids and repeated rows are scored like others; other columns
    are ignored; an empty table gives no rows, and where nothing is learned from,
    every word is unknown.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.coalesce(F.expr(train_condition), F.lit(False)).alias("learn"))
    counts = rows.select("text", "learn").mapInArrow(_counted, "word long, n long, every long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("every").alias("every")
    )
    counts = stored(counts)
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    frequent = Table(_frequent(counts))
    table = spark.sparkContext.broadcast(frequent)
    rest_n, rest_v = n - int(frequent.lm.sum()), v - len(frequent.lm)

    params = gru.start(frequent.lm, rest_n + rest_v + 1)
    if n:
        params = fitted(rows.where("learn").select("id", "text"), n, table, params, GROUP_WORDS)
    model = spark.sparkContext.broadcast(params)

    own = stored(rows.select("id", "text").mapInArrow(_scored(table, model), _SCORED))
    rest = own.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    rest = rest.join(counts.where("n > 0").select("word", "n"), "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rest_logs"), F.sum("times").alias("rest_known")
    )
    joined = own.drop("words", "times").join(rest, "row", "left").withColumn("rest_logs", F.coalesce("rest_logs", F.lit(0.0)))
    return joined.select(
        F.col("id").alias("doc_id"), "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("rest_logs") - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (F.col("state_score") + F.col("other_logs") + F.col("rest_logs") - F.col("others") * float(np.log10(rest_n + rest_v + 1))).alias("score"),
    )
