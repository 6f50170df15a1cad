"""Packing token pieces into sequences: first-fit decreasing in randomised groups."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import slices

#: Pieces of a group, at most about: what one task packs.
PIECES_PER_GROUP = 4096
#: The added token of byte_bpe_50k.json, which the .tiktoken file lacks; where a text holds it, it is this one id.
SPECIAL = {"<|endoftext|>": 50256}
_encoders: dict[str, Callable[[str], np.ndarray]] = {}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids, of a tokenizers .json or a tiktoken .tiktoken file; loaded once in a worker."""
    if path not in _encoders:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            _encoders[path] = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        else:
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
            _encoders[path] = lambda text: np.array(own.encode(text, allowed_special=set(SPECIAL), disallowed_special=()), dtype="<u4")
    return _encoders[path]


def _pieces(path: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(path), np.array([end], dtype="<u4")
        row = TaskContext.get().partitionId() << 33
        for part in slices(batches, "text"):
            rows = []
            for id_, text in zip(*(part.column(c).to_pylist() for c in ("id", "text")), strict=True):
                ids = np.concatenate([encode(text), last])
                rows += [(id_, row, at, min(length, len(ids) - at), zlib.crc32(ids[at : at + length].tobytes()), len(ids)) for at in range(0, len(ids), length)]
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["id", "row", "start", "length", "crc", "tokens"]
            )

    return run


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each size, the sizes being in descending order.

    A tournament tree holds the bins' free room; each node has the larger of its
    children's, so the leftmost bin with room is found in log2(bins) steps.
    """
    leaves = 1 << max(1, (len(sizes) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    out = np.empty(len(sizes), dtype=np.int64)
    for i, size in enumerate(sizes.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        out[i] = at - leaves
        tree[at] -= size
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
    return out


def _packed(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("id", "ascending"), ("row", "ascending"), ("start", "ascending")])
        size = table.column("length").to_numpy()
        bins = first_fit_decreasing(size, length)
        order = np.argsort(bins, kind="stable")
        run_ = np.cumsum(size[order]) - size[order]
        starts = np.flatnonzero(np.diff(bins[order], prepend=-1))
        offset = np.empty(len(size), dtype=np.int64)
        offset[order] = run_ - np.repeat(run_[starts], np.diff(np.append(starts, len(size))))
        sequence = (table.column("grp").to_numpy().astype(np.int64) << 32) + bins
        return table.select(["id", "start", "length", "crc", "tokens"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece of every document.

    A document's ids, then `end`, are cut at multiples of `length`. Pieces are
    dealt to groups of 4,096 or fewer on average by a hash of their row and
    place, so neither equal rows nor a very long document lie in one group, and
    each group is packed on its own. A null text is empty and gives the one id
    `end`; null ids and repeated rows are packed like others; other columns are
    ignored, an empty table gives no rows. sequence_id is the group times 2**32
    plus the bin.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    most = rows.agg(F.sum(1 + F.expr(f"octet_length(text) div {length}"))).first()[0] or 1  # an id has a byte or more
    groups = -(-most // PIECES_PER_GROUP)
    pieces = rows.mapInArrow(_pieces(tokenizer, length, end), "id long, row long, start long, length long, crc long, tokens long")
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))
    packed = dealt.groupBy("grp").applyInArrow(_packed(length), "id long, start long, length long, crc long, tokens long, sequence_id long, offset long")
    return packed.select(
        F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"), "sequence_id",
        "offset"
    )
