"""Exact substring dedup by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of half a window;
any window holds one whole block of each document that has the window. All
rolling half windows of all documents probe the index of blocks. Around the
places where a block occurs more than once, hits are extended to whole windows;
each window's smallest document is found, and later documents lose the words
that such windows cover, so what goes is the union of maximal exact repeats.

Documents lie in pieces of some megabytes, fixed once in a stored table. A piece
names each of its hashes once to the hash range that counts them, in packed
arrays, and the answers go back to the piece, which alone knows its documents
and places. So a passage that very many documents share costs one entry a piece,
and a probe about five bytes, however many ranges there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import passing, stored
from .textkernel import U, Words, ngrams, slices, stretches

#: Text of one piece, and of what is hashed at once.
PIECE_BYTES, PART_BYTES = 8 << 20, 1 << 20
#: Text whose hashes fall into one range, and the least number of ranges. A range is counted in SPLITS steps: what bounds a task's memory.
RANGE_BYTES, LEAST_RANGES, SPLITS = 128 << 20, 64, 8


def pack(x: np.ndarray) -> bytes:
    """Ascending integers as byte planes of their differences, which the shuffle's codec then shrinks."""
    return np.diff(x, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64))


def kept_text(words: Words, gone: np.ndarray | None = None) -> list[bytes]:
    """Each text's words, but for those marked gone, joined by one space."""
    counts = words.counts()
    last = np.zeros(len(words.ends), dtype=bool)
    last[words.offsets[1:][counts > 0] - 1] = True
    out = words.bytes.copy()
    out[words.ends[~last]] = 32
    stay = slice(None) if gone is None else ~gone
    mask = np.zeros(len(out) + 2, dtype=np.int8)
    np.add.at(mask, words.starts[stay], 1)
    np.add.at(mask, (words.ends + ~last)[stay], -1)  # with the blank after a word, unless the text ends
    mask = np.cumsum(mask[:-1], dtype=np.int8) > 0
    kept = []
    first = words.offsets
    for d in range(words.n_texts):
        if first[d] == first[d + 1]:
            kept.append(b"")
            continue
        a, b = words.starts[first[d]], words.ends[first[d + 1] - 1]
        kept.append(out[a:b][mask[a:b]].tobytes().rstrip(b" "))
    return kept


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    arrays = [
        x if isinstance(x, pa.Array) else pa.nulls(len(columns[0]), kinds[t]) if x is None else pa.array(x, kinds[t]) for x,
        (_, t) in zip(columns, fields, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


_PIECED = "piece long, id long, tag long, text string, size long"


def _pieced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition, numbered by piece."""
    piece, size = TaskContext.get().partitionId() << 32, 0
    for part in slices(batches, "text"):
        bytes_ = part.column("text").nbytes
        if size and size + bytes_ > PIECE_BYTES:
            piece, size = piece + 1, 0
        size += bytes_
        yield _batch(
            _PIECED,
            [np.full(part.num_rows, piece), part.column("id"), part.column("tag"), part.column("text"), pa.array(np.full(part.num_rows, bytes_ // part.num_rows))]
        )


def _places(words: Words, n: int, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word at which n words of one text start, that text), for the texts to take."""
    room = np.where(take, np.maximum(words.counts() - n + 1, 0), 0)
    text = np.repeat(np.arange(words.n_texts), room)
    return words.offsets[text] + np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room), text


def _long(words: Words, ids: pa.Array, window: int) -> np.ndarray:
    return (words.counts() >= window) & np.asarray(ids.is_valid())


def _range_cuts(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(range, first, end) of each range that ascending keys have."""
    ranges = keys >> U(64 - bits)
    starts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])) if len(keys) else np.zeros(0, int)
    yield from zip(ranges[starts].astype(np.int64).tolist(), starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True)


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after a key's range."""
    return ((keys << U(bits)) >> U(32)).astype("<u4")


def _full(short: np.ndarray, n: int) -> np.ndarray:
    return (U(n) << U(32)) | short.astype(U)


def _held_by_piece(batches: Iterator[pa.RecordBatch], hashed: Callable, packed: Callable) -> Iterator[pa.RecordBatch]:
    """packed(piece, all that hashed gives of its parts), piece by piece."""
    now, held = None, []
    for stretch in stretches(batches, ("piece",)):
        piece = stretch.column("piece")[0].as_py()
        if piece != now and held:
            yield packed(now, held)
            held = []
        now = piece
        held += [found for part in slices(iter([stretch]), "text", PART_BYTES) if len((found := hashed(part))[0])]
    if held:
        yield packed(now, held)


_PROBES = "n long, piece long, keys binary, flags binary"


def _probes(window: int, bits: int):
    """Each piece's distinct half windows by hash range; flag 1: a reference block, 2: there twice or more."""
    block = window // 2

    def hashed(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        words = Words(part.column("text"), lower=False)
        place, text = _places(words, block, _long(words, part.column("id"), window))
        return (ngrams(words.hash, block)[place] if len(place) else np.zeros(0, U)), (place - words.offsets[text]) % block == 0

    def packed(piece: int, held: list) -> pa.RecordBatch:
        keys, ref = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        flags = np.logical_or.reduceat(ref[order], starts) + 2 * (np.diff(np.append(starts, len(keys))) > 1)
        keys, flags = keys[starts], flags.astype(np.uint8)
        short = _short(keys, bits)
        rows = [(n, piece, short[a:b].tobytes(), flags[a:b].tobytes()) for n, a, b in _range_cuts(keys, bits)]
        return _batch(_PROBES, list(zip(*rows, strict=True)))

    return lambda batches: _held_by_piece(batches, hashed, packed)


def _by_range(columns: tuple[str, ...], close: Callable):
    """close(range, rows) of each range of rows in order of n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for n, *row in zip(*(batch.column(c).to_pylist() for c in ("n", *columns)), strict=True):
                if n != now:
                    if rows:
                        yield from close(now, rows)
                    now, rows = n, []
                rows.append(row)
        if rows:
            yield from close(now, rows)

    return run


def _split(keys: list[np.ndarray], edges: np.ndarray) -> Iterator[list[slice]]:
    """The places of each array's keys between two edges, step by step."""
    cuts = [np.concatenate([[0], np.searchsorted(k, edges), [len(k)]]).tolist() for k in keys]
    for i in range(len(edges) + 1):
        yield [slice(c[i], c[i + 1]) for c in cuts]


def _joined(arrays: list[np.ndarray], parts: list[slice]) -> np.ndarray:
    return np.concatenate([x[p] for x, p in zip(arrays, parts, strict=True)])


_ANSWERS = "n long, piece long, keys binary"


def _shared(n: int, rows: list) -> Iterator[pa.RecordBatch]:
    """For each piece, those of its half windows that are a reference block somewhere and occur twice or more."""
    keys, flags = [np.frombuffer(k, "<u4") for _, k, _ in rows], [np.frombuffer(f, np.uint8) for _, _, f in rows]
    found: list[list[bytes]] = [[] for _ in rows]
    for parts in _split(keys, (np.arange(1, SPLITS, dtype=np.uint64) << U(29)).astype("<u4")):
        key, flag = _joined(keys, parts), _joined(flags, parts)
        if not len(key):
            continue
        order = np.argsort(key)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
        any_flag = np.bitwise_or.reduceat(flag[order], starts)
        wanted = key[order][starts][(any_flag & 1 > 0) & ((any_flag & 2 > 0) | (np.diff(np.append(starts, len(key))) > 1))]
        if len(wanted):
            for own, part, out in zip(keys, parts, found, strict=True):
                at = np.minimum(np.searchsorted(wanted, own[part]), len(wanted) - 1)
                out.append(own[part][wanted[at] == own[part]].tobytes())
    out = [(n, row[0], b"".join(own)) for row, own in zip(rows, found, strict=True) if any(own)]
    if out:
        yield _batch(_ANSWERS, list(zip(*out, strict=True)))


def _answered(read: Callable, each: Callable):
    """each(part, read(answer rows)) of each piece's texts; rows come by piece, its answers (role 0) before its texts (role 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, answers, ready = None, [], None
        for stretch in stretches(batches, ("piece", "role")):
            piece, role = stretch.column("piece")[0].as_py(), stretch.column("role")[0].as_py()
            if piece != now:
                now, answers, ready = piece, [], None
            if role == 0:
                answers.append(stretch)
                continue
            ready = read(answers) if ready is None else ready
            answers = []
            for part in slices(iter([stretch]), "text", PART_BYTES):
                yield from each(part, ready)

    return run


_NEAR = "kind int, piece long, id long, tag long, n_words long, digest string, text string, places binary"


def _extended(window: int, bits: int):
    """Texts with the places of windows around hits (kind 1); texts without one, done (kind 0)."""
    block = window // 2

    def read(answers: list[pa.RecordBatch]) -> np.ndarray:
        keys = [_full(np.frombuffer(k, "<u4"), n) for x in answers for n, k in zip(x.column("n").to_pylist(), x.column("keys").to_pylist(), strict=True)]
        return np.sort(np.concatenate(keys)) if keys else np.zeros(0, U)

    def each(part: pa.RecordBatch, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, ids = Words(part.column("text"), lower=False), part.column("id")
        near = np.zeros(len(words.hash) + 1, dtype=np.int64)
        place, text = _places(words, block, _long(words, ids, window))
        if len(wanted) and len(place):
            key = ngrams(words.hash, block)[place]
            key = _full(_short(key, bits), 0) | (key >> U(64 - bits) << U(32))
            hit = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
            place, text = place[hit], text[hit]
            first, room = words.offsets[text], words.counts()[text] - window + 1
            np.add.at(near, first + np.clip(place - first - (window - block), 0, room), 1)
            np.add.at(near, first + np.clip(place - first + 1, 0, room), -1)
        at = np.flatnonzero(np.cumsum(near)[:-1] > 0)
        cuts, counts = np.searchsorted(at, words.offsets), pa.array(words.counts())
        has = np.diff(cuts) > 0
        if not has.all():
            rest = pa.array(np.flatnonzero(~has))
            digests = [hashlib.sha256(x).hexdigest() for x, own in zip(kept_text(words), has.tolist(), strict=True) if not own]
            yield _batch(
                _NEAR,
                [np.zeros(len(rest), np.int32), part.column("piece").take(rest), ids.take(rest), part.column("tag").take(rest), counts.take(rest), digests, None, None]
            )
        if has.any():
            own = pa.array(np.flatnonzero(has))
            blobs = [pack(at[cuts[d] : cuts[d + 1]] - words.offsets[d]) for d in own.to_pylist()]
            columns = [part.column(c).take(own) for c in ("piece", "id", "tag")]
            yield _batch(_NEAR, [np.ones(len(own), np.int32), *columns, counts.take(own), None, part.column("text").take(own), blobs])

    return _answered(read, each)


def _window_keys(words: Words, places: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, text, hash) of the windows at each text's places."""
    local = [unpack(x) for x in places.to_pylist()]
    text = np.repeat(np.arange(words.n_texts), list(map(len, local)))
    place = words.offsets[text] + np.concatenate(local)
    return place, text, ngrams(words.hash, window)[place]


_WINDOWS = "n long, piece long, keys binary, least binary, varied binary"


def _windows(window: int, bits: int):
    """Each piece's distinct windows by hash range, with the smallest document of each and whether there are others."""

    def hashed(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        words = Words(part.column("text"), lower=False)
        _, text, key = _window_keys(words, part.column("places"), window)
        return key, part.column("id").to_numpy()[text]

    def packed(piece: int, held: list) -> pa.RecordBatch:
        keys, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(starts[1:], len(keys))
        keys, least, varied = keys[starts], ids[starts], ids[starts] != ids[ends - 1]
        rows = [(n, piece, keys[a:b].tobytes(), least[a:b].tobytes(), varied[a:b].tobytes()) for n, a, b in _range_cuts(keys, bits)]
        return _batch(_WINDOWS, list(zip(*rows, strict=True)))

    return lambda batches: _held_by_piece(batches, hashed, packed)


_LEAST = "n long, piece long, keys binary, least binary"


def _least(bits: int):
    """For each piece, those of its windows that start in a document with a smaller id than one of its own has, with the smallest of all."""

    def close(n: int, rows: list) -> Iterator[pa.RecordBatch]:
        keys, least, varied = ([np.frombuffer(row[i], kind) for row in rows] for i, kind in ((1, U), (2, np.int64), (3, bool)))
        edges = (U(n) << U(64 - bits)) + (np.arange(1, SPLITS, dtype=U) << U(61 - bits))
        found: list[list[tuple[bytes, bytes]]] = [[] for _ in rows]
        for parts in _split(keys, edges):
            key, low = _joined(keys, parts), _joined(least, parts)
            if not len(key):
                continue
            order = np.argsort(key)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            known, lowest = key[order][starts], np.minimum.reduceat(low[order], starts)
            for i, part in enumerate(parts):
                first = lowest[np.searchsorted(known, keys[i][part])]
                tell = varied[i][part] | (first < least[i][part])
                if tell.any():
                    found[i].append((keys[i][part][tell].tobytes(), first[tell].tobytes()))
        out = [(n, row[0], *map(b"".join, zip(*own, strict=True))) for row, own in zip(rows, found, strict=True) if own]
        if out:
            yield _batch(_LEAST, list(zip(*out, strict=True)))

    return _by_range(("piece", "keys", "least", "varied"), close)


_CUT = "id long, tag long, n_words long, gone long, digest string, kept_text string"


def _removed(window: int):
    def read(answers: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        keys, least = (np.frombuffer(b"".join(b for x in answers for b in x.column(c).to_pylist()), kind) for c, kind in (("keys", U), ("least", np.int64)))
        order = np.argsort(keys)
        return keys[order], least[order]

    def each(part: pa.RecordBatch, answer: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        (known, least), words = answer, Words(part.column("text"), lower=False)
        cover = np.zeros(len(words.hash) + 1, dtype=np.int64)
        if len(known):
            place, text, key = _window_keys(words, part.column("places"), window)
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            late = place[(known[at] == key) & (least[at] < part.column("id").to_numpy()[text])]
            np.add.at(cover, late, 1)
            np.add.at(cover, late + window, -1)
        gone = np.cumsum(cover)[:-1] > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        removed, texts = total[words.offsets[1:]] - total[words.offsets[:-1]], kept_text(words, gone)
        cut = [x.decode() if n else None for x, n in zip(texts, removed.tolist(), strict=True)]
        yield _batch(_CUT, [part.column("id"), part.column("tag"), words.counts(), removed, [hashlib.sha256(x).hexdigest() for x in texts], cut])

    return _answered(read, each)


def _by_piece(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of texts (role 1), each piece's answers (role 0) before them."""
    both = answers.withColumn("role", F.lit(0)).unionByName(texts.withColumn("role", F.lit(1)), allowMissingColumns=True)
    return both.repartition("piece").sortWithinPartitions("piece", "role")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text and tag (xxhash64 of the text) of every row.

    A word goes if a window of `window` consecutive words covers it whose words
    also start in a document with a smaller id; windows are judged on the input.
    kept_text, the kept words joined by one space, is null where nothing went. A
    null text has no words. A row with a null id loses nothing and makes others
    lose nothing; rows that share an id do not remove each other's words. Other
    columns are ignored, an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    with passing(docs.sparkSession) as keep:
        pieced = stored(docs.mapInArrow(_pieced, _PIECED), "zstd")
        size = pieced.agg(F.sum("size")).first()[0] or 0
        bits = (max(LEAST_RANGES, -(-size // RANGE_BYTES)) - 1).bit_length()
        texts = pieced.drop("size")

        probes = texts.mapInArrow(_probes(window, bits), _PROBES).repartition("n").sortWithinPartitions("n")
        shared = stored(probes.mapInArrow(_by_range(("piece", "keys", "flags"), _shared), _ANSWERS))
        found = keep(_by_piece(texts, shared).mapInArrow(_extended(window, bits), _NEAR), "zstd")
    near = found.where("kind = 1").select("piece", "id", "tag", "text", "places")
    windows = near.mapInArrow(_windows(window, bits), _WINDOWS).repartition("n").sortWithinPartitions("n")
    least = stored(windows.mapInArrow(_least(bits), _LEAST))
    cut = _by_piece(near, least).mapInArrow(_removed(window), _CUT)
    whole = found.where("kind = 0").select("id", "tag", "n_words", F.lit(0).cast("long").alias("gone"), "digest", F.lit(None).cast("string").alias("kept_text"))
    return whole.unionByName(cut).select(
        F.col("id").alias("doc_id"), "n_words", F.col("gone").alias("n_removed"), F.col("digest").alias("kept_sha256"), "kept_text", "tag"
    )


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", window: int = 50) -> DataFrame:
    """The rows of docs, with all their columns: text_col has the kept words joined by one space where words went, and length_col, if there, its length."""
    cut = substring_dedup(docs, id_col, text_col, window).where("kept_text is not null").select(
        F.col("doc_id").alias("id"), "tag", "kept_text"
    ).dropDuplicates(["id", "tag"])
    # A struct, as columns may have any name. Equal rows are cut alike; null ids lose nothing.
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"))
    new = {
        text_col: F.coalesce("kept_text", F.col("row")[text_col]),
        length_col: F.coalesce(F.length("kept_text").cast("long"), F.col("row")[length_col]) if length_col in docs.columns else None
    }
    return whole.join(cut, ["id", "tag"], "left").select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))
