"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. How often each
pattern of votes occurs, over all documents, is all that expectation-
maximisation needs to estimate the labellers' accuracies and the posterior of
each pattern. The posteriors of a bounded sample then train a linear scorer of
hashed features, and the scorer decides on every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import U, Words, mix, shingles, slices

BUCKETS = 1 << 14
#: The scorer is fitted on this many documents, those of least hash of id and text, or fewer of them, so that they have ENTRIES features at most
#: (24 MB on the driver). Every count and every decision covers all documents.
SAMPLE, ENTRIES = 4000, 4_000_000
#: Per labeller: the statistic, at or below which value it votes good, at or above which bad. Between them it abstains.
LABELLERS = (("symbols", 0.06, 0.25), ("capitals", 0.15, 0.4), ("stutter", 0.03, 0.2), ("repeats", 0.25, 0.6), ("doubled_marks", 0.05, 0.3), ("bars", 0.03, 0.15), ("marks", 0.5, 0.9))
_SYMBOL, _LETTER, _CAPITAL = (np.zeros(256, dtype=bool) for _ in range(3))
_SYMBOL[list(b"#$%&*<>=@\\^_~{}[]|")] = True
_CAPITAL[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_CLASS = np.arange(256, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 256, 257, 258, 256


def _per_word(flags: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[words.ends] - total[words.starts]


def _per_text(values: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def statistics(words: Words) -> np.ndarray:
    """The labellers' statistics of each text, in their order; 0 for a wordless one."""
    n = np.maximum(words.counts(), 1)
    raw = words.bytes
    letters, capitals = _per_text(_per_word(_LETTER[raw], words), words), _per_text(_per_word(_CAPITAL[raw], words), words)
    same = np.zeros(len(words.hash), dtype=bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    same[words.offsets[:-1][words.counts() > 0]] = False
    grams, offsets = shingles(words, 3)
    distinct = np.array([len(np.unique(grams[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    total = np.diff(offsets)
    marks = _per_word(_MARK[raw], words)
    return np.stack([
        _per_text(_per_word(_SYMBOL[raw], words) > 0, words) / n, capitals / np.maximum(letters, 1), _per_text(same, words) / n, 1 - distinct / np.maximum(total, 1) * (total > 0) - (total == 0),
        _per_text(marks >= 2, words) / n, _per_text(raw[words.starts] == 124, words) / n, _per_text(marks > 0, words) / n,
    ], axis=1)


def votes(stats: np.ndarray) -> np.ndarray:
    """A pattern of the labellers' votes in base 3: 0 nothing, 1 good, 2 bad."""
    code = np.zeros(len(stats), dtype=np.int64)
    for i, (_, good, bad) in enumerate(LABELLERS):
        code += 3**i * np.where(stats[:, i] <= good, 1, np.where(stats[:, i] >= bad, 2, 0))
    return code


def shapes(words: Words) -> np.ndarray:
    """Hash of each word's shape: runs of small letters, capitals and digits are one sign each, marks stay."""
    kind = _CLASS[words.bytes]
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[words.starts] = True
    rank = np.cumsum(keep) - 1
    place = np.zeros(len(rank), dtype=np.int64)
    if len(words.starts):
        first = words.starts[0]
        place[first:] = rank[first:] - np.repeat(rank[words.starts], np.diff(np.append(words.starts, len(rank))))
    signs = mix((kind.astype(U) << U(32)) + place.astype(U)) * keep
    total = np.concatenate([np.zeros(1, U), np.cumsum(signs, dtype=U)])
    return mix(total[words.ends] - total[words.starts])


def _features(words: Words, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of word shapes and of pairs of shapes, one row a word; buckets of the binned statistics, one row a text."""
    shape = shapes(words)
    before = np.concatenate([np.zeros(1, U), shape[:-1]])[: len(shape)]
    before[words.offsets[:-1][words.counts() > 0]] = U(1)
    pair = mix(shape * U(31) + before)
    local = np.stack([shape % U(BUCKETS), pair % U(BUCKETS)], axis=1).astype(np.int64)
    bins = np.searchsorted(np.array([0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]), stats)
    return local, (mix((bins + 64 * np.arange(stats.shape[1])).astype(U) + U(977)) % U(BUCKETS)).astype(np.int64)


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        words = Words(part.column("text"), lower=False)
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(votes(statistics(words)))], names=["id", "votes"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's features as (bucket, weight) lists of 16 and 32 bits, with its votes."""
    for part in slices(batches, "text"):
        words = Words(part.column("text"), lower=False)
        stats = statistics(words)
        local, whole = _features(words, stats)
        rows = []
        for d in range(words.n_texts):
            own = local[words.offsets[d] : words.offsets[d + 1]].ravel()
            bucket, count = np.unique(own, return_counts=True)
            rows.append((np.concatenate([bucket, whole[d]]), np.concatenate([2 * count / max(len(own), 1), np.ones(len(whole[d]))])))
        columns = [
            part.column("tag"), pa.array(votes(stats)),
            *(pa.array([r[i].astype(kind).tobytes() for r in rows], pa.binary()) for i, kind in ((0, "<u2"), (1, "<f4")))
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["tag", "votes", "buckets", "weights"])


def accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of good of each pattern, chance of each vote given bad and good), by expectation-maximisation over labellers taken as independent."""
    digits = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    good = np.clip(0.9 - 0.3 * (digits == 2).sum(axis=1) + 0.02 * (digits == 1).sum(axis=1), 0.05, 0.95)
    chance = np.empty((2, len(LABELLERS), 3))
    for _ in range(rounds):
        for side, weight in enumerate(((1 - good) * counts, good * counts)):
            for vote in range(3):
                chance[side, :, vote] = ((digits == vote) * weight[:, None]).sum(axis=0) + 1
            chance[side] /= chance[side].sum(axis=1, keepdims=True)
        prior = ((good * counts).sum() + 1) / (counts.sum() + 2)
        log = [np.log(chance[side][np.arange(len(LABELLERS)), digits]).sum(axis=1) for side in (0, 1)]
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1] + np.log((1 - prior) / prior), -500, 500)))
    return good, chance


def _fitted(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, epochs: int = 60) -> np.ndarray:
    """Weights by bucket, the bias last: logistic regression on posterior labels, adaptive gradient steps over all rows."""
    which = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    bucket, value = np.concatenate([b for b, _ in rows]), np.concatenate([w for _, w in rows])
    weights, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    balance = np.where(good >= 0.5, 0.5 / max((good >= 0.5).mean(), 1e-6), 0.5 / max((good < 0.5).mean(), 1e-6))
    for _ in range(epochs):
        score = np.bincount(which, weights[bucket] * value, minlength=len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-score)) - good) * balance / len(rows)
        step = np.append(np.bincount(bucket, error[which] * value, minlength=BUCKETS), error.sum()) + 1e-6 * weights
        squares += step**2
        weights -= 0.3 * step / np.sqrt(squares)
    return weights


def _scored(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for part in slices(batches, "text"):
            words = Words(part.column("text"), lower=False)
            stats = statistics(words)
            local, whole = _features(words, stats)
            score = _per_text(w[local].sum(axis=1), words) / np.maximum(words.counts(), 1) + w[whole].sum(axis=1) + w[-1]
            columns = [part.column(i) for i in range(part.num_columns) if part.schema.names[i] != "text"]
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(votes(stats)), pa.array(1 / (1 + np.exp(-np.clip(score, -500, 500))))],
                names=[*names, "votes", "p_good"]
            )

    return run


def fit_quality(rows: DataFrame) -> tuple[np.ndarray, dict[int, float]]:
    """(the scorer's weights, the posterior of each vote pattern) from rows of id and text without nulls in text."""
    counted = rows.select("id", "text").mapInArrow(_voted, "id long, votes long").groupBy("votes").count().collect()  # 3 ** labellers rows at most
    if not counted:
        return np.zeros(BUCKETS + 1), {}
    patterns, counts = (np.array(x) for x in zip(*counted, strict=True))
    posterior = dict(zip(patterns.tolist(), accuracies(patterns, counts)[0].tolist(), strict=True))
    # Equal texts are alike, so the sample has one row of each; a text's bytes bound its features.
    own = rows.select("id", "tag", F.xxhash64("id", "tag").alias("h"), F.octet_length("text").alias("n"))
    least = own.groupBy("tag").agg(F.min(F.struct("h", "id", "n")).alias("x")).select("tag", "x.*").orderBy("h", "tag").limit(SAMPLE).collect()
    ends = np.cumsum([min(r.n + 16, BUCKETS) for r in least])
    taken = [(r.id, r.tag) for r in least[: max(1, int((ends <= ENTRIES).sum()))]]
    wanted = F.broadcast(rows.sparkSession.createDataFrame(taken, "_id long, _tag long"))  # SAMPLE rows at most
    sample = rows.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left_semi").dropDuplicates(["tag"])
    picked = sample.select("tag", "text").mapInArrow(_sampled, "tag long, votes long, buckets binary, weights binary").collect()
    picked.sort(key=lambda r: r.tag)
    train = [(np.frombuffer(r.buckets, "<u2").astype(np.int64), np.frombuffer(r.weights, "<f4").astype(float)) for r in picked]
    return _fitted(train, np.array([posterior[r.votes] for r in picked])), posterior


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def classify_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, votes, posterior (of its vote pattern), p_good (the scorer's) and keep of every row.

    keep is p_good >= 0.5. A null or wordless text is scored on its statistics,
    all 0, like any other; equal texts get equal scores. Null ids and repeated
    rows are scored like others, other columns are ignored, an empty table gives
    no rows. No gold labels are used: those of a label table are for measuring.
    """
    spark, rows = docs.sparkSession, _rows(docs, id_col, text_col)
    weights, posterior = fit_quality(rows)
    scored = rows.select("id", "text").mapInArrow(_scored(spark.sparkContext.broadcast(weights)), "id long, votes long, p_good double")
    table = spark.createDataFrame([(int(v), float(g)) for v, g in posterior.items()], "votes long, posterior double")
    return scored.join(F.broadcast(table), "votes").select(F.col("id").alias("doc_id"), "votes", "posterior", "p_good", (F.col("p_good") >= 0.5).alias("keep"))


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that classify_quality keeps, with all their columns; nothing is shuffled."""
    weights, _ = fit_quality(_rows(docs, id_col, text_col))
    scored = _scored(docs.sparkSession.sparkContext.broadcast(weights))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            own = pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(text_col))], names=["text"])
            p_good = np.concatenate([x.column("p_good").to_numpy() for x in scored(iter([own]))])
            yield part.filter(pa.array(p_good >= 0.5))

    return docs.mapInArrow(kept, docs.schema)
