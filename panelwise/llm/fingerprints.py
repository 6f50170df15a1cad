"""MinHash fingerprints: universal hash permutations over word shingles, in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import ngram_jaccard_join
from .scratch import stored
from .textkernel import U, Words, mix, set_ids, shingle_sets, shingles, slices

PERMUTATIONS, SHINGLE = 128, 5
#: Bands of a signature, of PERMUTATIONS / BANDS places each.
BANDS = 32
_seeds = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=U))
_A, _B = _seeds[:PERMUTATIONS] | U(1), _seeds[PERMUTATIONS:]


def signatures(words: Words, n: int = SHINGLE) -> np.ndarray:
    """The least value of each permutation over each text's shingles, 16 bits of it; a row of ones for a wordless text."""
    values, offsets = shingles(words, n)
    full = np.flatnonzero(np.diff(offsets))
    out = np.full((words.n_texts, PERMUTATIONS), 0xFFFF, dtype="<u2")
    if len(full):
        starts = offsets[:-1][full]
        for k in range(PERMUTATIONS):
            out[full, k] = (np.minimum.reduceat((values * _A[k] + _B[k]) >> U(24), starts) & U(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places. A wordless text is like a wordless one only."""
    none_a, none_b = (a == 0xFFFF).all(axis=1), (b == 0xFFFF).all(axis=1)
    return np.where(none_a | none_b, none_a & none_b, (a == b).mean(axis=1)).astype(float)


_RESULT = "id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], after: list[str]) -> pa.RecordBatch:
    edited = [t[: len(t) - len(t) // 2] + x[: len(t) // 2] for t, x in zip(texts, after, strict=True)]
    own, changed, following = (signatures(Words(pa.array(x, pa.large_string()), lower=True)) for x in (texts, edited, after))
    columns = [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
        *(pa.array([row.tobytes() for row in x], pa.binary()) for x in (own, changed)), pa.array(likeness(own, changed)), pa.array(likeness(own, following)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of an ordered partition against the next. The partition's first and last text come out as such (kind 1 and 2), for the seams."""
    part = TaskContext.get().partitionId()
    names = ["kind", "part", "text", *(c.split()[0] for c in _RESULT.split(", "))]

    def seam(kind: int, id_, text: str) -> pa.RecordBatch:
        nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string()), pa.array([id_], pa.int64()), *nulls],
            names=names
        )

    ids, texts = [], []
    for piece in slices(batches, "text", 1 << 19):
        if not ids:
            yield seam(1, piece.column("id")[0].as_py(), piece.column("text")[0].as_py())
        ids, texts = ids + piece.column("id").to_pylist(), texts + piece.column("text").to_pylist()
        if len(ids) > 1:
            found = _compared(ids[:-1], texts[:-1], texts[1:])
            k = found.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * k, pa.int32()), pa.array([part] * k, pa.int32()), pa.nulls(k, pa.string()), *found.columns], names=names
            )
            ids, texts = ids[-1:], texts[-1:]
    if ids:
        yield seam(2, ids[0], texts[0])


def _at_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _compared(*(batch.column(c).to_pylist() for c in ("id", "text", "after")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and how like they are.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document in descending id, after the last
    of the first. A null text is empty; null ids come last; rows that share an id
    follow each other by text hash. Equal texts have equal fingerprints, wordless
    ones that of the empty text. The texts are shuffled once, in id order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    order = [F.col("id").desc_nulls_last(), F.col("tag")]
    along = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_along, f"kind int, part int, text string, {_RESULT}"))
    heads = along.where("kind = 1").select("part", F.col("text").alias("after"))
    # One row a partition: the numbering sees part numbers only.
    numbers = heads.select("part", F.expr("lead(part) over (order by part)").alias("then"), F.expr("min(part) over ()").alias("start"))
    seams = along.where("kind = 2").select("part", "id", "text").join(numbers, "part").withColumn("then", F.coalesce("then", "start"))
    seams = seams.join(heads.select(F.col("part").alias("then"), "after"), "then").select("id", "text", "after").mapInArrow(_at_seams, _RESULT)
    out = along.where("kind = 0").select(*seams.columns).union(seams)
    return out.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next"
    )


def _banded(text: str, n: int, percent: int, ranks):
    """Each set under the hashes of its signature's bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            words = Words(part.column(text), lower=True)
            full = np.flatnonzero(words.counts() > 0)
            if len(full):
                bands = signatures(words, n)[full].reshape(len(full), BANDS, -1)
                tokens = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), bands.shape[:2])
                for place in range(bands.shape[2]):
                    tokens = mix(tokens * U(65537) + bands[:, :, place].astype(U))
                ids = pa.array(set_ids(*shingle_sets(words, n)), pa.binary()).take(pa.array(np.repeat(full, BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(tokens.ravel().view(np.int64)), ids], names=["token", "sid"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, as of ngram_jaccard_join, from sets that share a band of their signatures.

    The Jaccard similarity of what shares a band is verified on the whole sets of
    five-word shingles. Sets of similarity s share none of the 32 bands with
    chance (1 - s^4)^32: 5e-8 at 0.8, 0.6% at 0.62. Equal sets count once and a
    band that very many share is compared by its smallest member first, then in
    blocks. Null and wordless texts link with nothing; an empty table gives no rows.
    """
    return ngram_jaccard_join(docs, id_col, text_col, SHINGLE, percent, postings=_banded)
