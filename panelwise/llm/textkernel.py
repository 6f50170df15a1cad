"""Word and shingle hashing over Arrow string batches, in numpy.

Words are maximal runs of bytes other than space and tab..carriage return. A
word's hash is a polynomial of its bytes modulo 2**64, mixed; an n-gram's hash
combines n word hashes. Two different n-grams of one corpus share a hash with a
chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C1B  # odd, 3 modulo 8
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, dtype=U), np.ones(1, dtype=U)]
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(1 << (n - 1).bit_length(), base, dtype=U)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=U)
    return _powers


class Words:
    """The words of a run of texts: `offsets[d]:offsets[d + 1]` are those of text d."""

    def __init__(self, texts: pa.Array, lower: bool):
        texts = texts.fill_null("") if texts.null_count else texts
        if not pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first = int(ends[0]) if len(ends) else 0
        raw = np.frombuffer(data, dtype=np.uint8)[first : int(ends[-1])] if data is not None and len(ends) else np.zeros(0, np.uint8)
        self.bytes, bounds = raw, (ends - first if len(ends) else np.zeros(1, np.int64))
        blank = np.ones(len(raw) + 2, dtype=bool)
        blank[1:-1] = _SEPARATOR[raw]
        left, right = blank[:-2].copy(), blank[2:].copy()
        inner = bounds[(bounds > 0) & (bounds < len(raw))]
        left[inner] = True
        right[inner - 1] = True
        inside = ~blank[1:-1]
        self.starts = np.flatnonzero(inside & left)
        self.ends = np.flatnonzero(inside & right) + 1
        self.offsets = np.searchsorted(self.starts, bounds)
        self.n_texts = len(texts)
        power, inverse = _power_tables(len(raw) + 1)
        letters = (_LOWER[raw] if lower else raw).astype(U) + U(1)
        sums = np.zeros(len(raw) + 1, dtype=U)
        np.cumsum(letters * power[: len(raw)], out=sums[1:], dtype=U)
        self.hash = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that starts at each place, by doubling; the last n - 1 places have none."""
    out, at, power = None, 0, hashes
    width = 1
    while True:
        if n & width:
            if out is None:
                out, at = power, width
            else:
                m = len(hashes) - at - width + 1
                out = mix(out[: max(m, 0)] * U(_BASE) + power[at : at + max(m, 0)])
                at += width
        width *= 2
        if width > n:
            return mix(out ^ U(n * 0x51ED270B))
        m = max(len(power) - width // 2, 0)
        power = mix(power[:m] * U(0xD6E8FEB86659FD93) + power[width // 2 : width // 2 + m])


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-word shingles of each text, with repeats, as values and offsets; a text of 1 to n - 1 words has its whole sequence as one."""
    counts = words.counts()
    have = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(have)])
    out = np.empty(offsets[-1], dtype=U)
    full = ngrams(words.hash, n) if len(words.hash) >= n else np.zeros(0, U)
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - words.offsets[:-1], have)
    long = np.repeat(counts >= n, have)
    out[long] = full[place[long]]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            out[offsets[short]] = ngrams(words.hash, k)[words.offsets[short]]
    return out, offsets


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As shingles(), each text's distinct ones in ascending order."""
    values, offsets = shingles(words, n)
    parts = [np.unique(values[offsets[i] : offsets[i + 1]]) for i in range(len(offsets) - 1)]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return np.concatenate(parts) if parts else np.zeros(0, U), np.concatenate([[0], np.cumsum(sizes)])


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece has about `limit` bytes of text, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def stretches(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The batches cut where one of the integer columns changes."""
    for batch in batches:
        if batch.num_rows:
            change = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in columns:
                change |= np.diff(batch.column(batch.schema.get_field_index(c)).to_numpy()) != 0
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run of values modulo 2**64; 0 for an empty one."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(values, dtype=U)])
    return total[offsets[1:]] - total[offsets[:-1]]


def set_ids(values: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """A 128-bit digest of each set; None for an empty one."""
    pair = np.stack([sums_by(mix(values ^ U(0xA0761D6478BD642F)), offsets), sums_by(mix(values + U(0xE7037ED1A0B428DB)), offsets)], axis=1)
    raw = pair.byteswap().tobytes()
    return [raw[16 * i : 16 * i + 16] if offsets[i + 1] > offsets[i] else None for i in range(len(offsets) - 1)]
