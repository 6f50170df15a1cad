"""Sharding by a minimax contiguous partition of atomic groups, in DataFrame functions only.

Equal texts are one group, ordered by a 64-bit hash. The partition's search sees
a bounded table of cells, which are stretches of that order. Taking cells as
whole gives a capacity that suffices, taking them as divisible one that nothing
can undercut; cells that a cut of a capacity in between may fall into are opened
into smaller cells, the largest first, down to single groups, until both are the
same or no such cell is left. Then the cuts are those over all groups. A round
opens OPENED cells into 2**STEP at most; what is left comes in later rounds, so
the row that the search sees grows by what lies around the cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored

#: Bits of the hash that the first cells share not, and bits by which an opened cell is divided each time.
FIRST_SHIFT, STEP = 48, 12
#: Cells opened in one round, the largest first; the others that may hold a cut come in later rounds.
OPENED = 4096
SALTS = 64

# Greedy filling over `cells`, an array of (low, high, bytes) in order. A cell of one group has low = high.
# WHOLE never divides a cell; FLUID fills a cell of several groups as if it could be cut anywhere. Both give the first cell of each shard but the first.
_START = "named_struct('used', 0L, 'i', 0, 'cuts', cast(array() as array<int>))"
_WHOLE = f"""aggregate(cells, {_START}, (a, x) -> if(a.used + x.bytes > {{c}},
    named_struct('used', x.bytes, 'i', a.i + 1, 'cuts', concat(a.cuts, array(a.i))),
    named_struct('used', a.used + x.bytes, 'i', a.i + 1, 'cuts', a.cuts)), a -> a.cuts)"""
_MORE = "cast(ceil((a.used + x.bytes - {c}) / {c}) as int)"
_FLUID = f"""aggregate(cells, {_START}, (a, x) -> case
    when a.used + x.bytes <= {{c}} then named_struct('used', a.used + x.bytes, 'i', a.i + 1, 'cuts', a.cuts)
    when x.low = x.high then named_struct('used', x.bytes, 'i', a.i + 1, 'cuts', concat(a.cuts, array(a.i)))
    else named_struct('used', a.used + x.bytes - {_MORE} * {{c}}, 'i', a.i + 1, 'cuts', concat(a.cuts, array_repeat(a.i, {_MORE}))) end, a -> a.cuts)"""
# The number of shards alone, for the search.
_COUNT = "named_struct('used', 0L, 'n', 1)"
_WHOLE_COUNT = f"""aggregate(cells, {_COUNT}, (a, x) -> if(a.used + x.bytes > {{c}},
    named_struct('used', x.bytes, 'n', a.n + 1), named_struct('used', a.used + x.bytes, 'n', a.n)), a -> a.n)"""
_FLUID_COUNT = f"""aggregate(cells, {_COUNT}, (a, x) -> case
    when a.used + x.bytes <= {{c}} then named_struct('used', a.used + x.bytes, 'n', a.n)
    when x.low = x.high then named_struct('used', x.bytes, 'n', a.n + 1)
    else named_struct('used', a.used + x.bytes - {_MORE} * {{c}}, 'n', a.n + {_MORE}) end, a -> a.n)"""


def _least(count: str, low: str, high: str, shards: int) -> str:
    """The smallest capacity from low to high, which suffices, under which `count` shards are enough."""
    middle = "((s.lo + s.hi) div 2)"
    return f"""aggregate(sequence(1, 62), named_struct('lo', {low}, 'hi', {high}),
        (s, _) -> if(s.lo >= s.hi, s, if({count.format(c=middle)} <= {shards},
            named_struct('lo', s.lo, 'hi', {middle}), named_struct('lo', {middle} + 1, 'hi', s.hi))), s -> s.hi)"""


def _cells(rows: DataFrame, *keys) -> DataFrame:
    """Cells by keys, the last of which is the rows' keys without `shift` bits."""
    by = rows.groupBy("shift", *keys).agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("bytes"))
    return by.select("low", "high", "bytes", "shift")


def _partition(rows: DataFrame, shards: int) -> DataFrame:
    """One row: the capacity and `firsts`, the least key of each shard but the first; no row without rows. rows have key, size."""
    own = F.expr("shiftright(key, shift)")
    cells = stored(_cells(rows.withColumn("shift", F.lit(FIRST_SHIFT)), own))
    while True:
        table = cells.agg(
            F.sort_array(F.collect_list(F.struct("low", "high", "bytes"))).alias("cells"), F.sum("bytes").cast("long").alias("total")
        ).where("size(cells) > 0")
        table = stored(table.withColumn("largest", F.expr("array_max(transform(cells, x -> x.bytes))")).withColumn(
            "group", F.expr("coalesce(array_max(transform(filter(cells, x -> x.low = x.high), x -> x.bytes)), 0L)")
        ))
        # Tables of one row: else the optimizer would put a search into the loop that uses its result.
        enough = f"total div {shards} + 1 + largest"
        table = stored(table.withColumn("floor", F.expr(_least(_FLUID_COUNT, f"greatest(group, cast(ceil(total / {shards}) as bigint), 1L)", enough, shards))))
        table = stored(table.withColumn("capacity", F.expr(_least(_WHOLE_COUNT, "floor", enough, shards))))
        table = stored(table.withColumn("firsts", F.expr(_WHOLE.format(c="capacity"))).withColumn("earliest", F.expr(_WHOLE.format(c="floor"))).withColumn("latest", F.expr(_FLUID.format(c="capacity"))))
        may_cut = f"exists(sequence(0, {shards - 2}), j -> i >= get(earliest, j) and i <= coalesce(get(latest, j), size(cells)))" if shards > 1 else "false"
        opened = table.where("floor < capacity").select(F.expr(f"filter(transform(cells, (x, i) -> if(x.low < x.high and (x.bytes > floor div 4 or {may_cut}), x, null)), x -> x is not null)").alias("opened"))
        named = opened.select(F.explode("opened").alias("x")).select("x.low", "x.high", "x.bytes").join(cells.select("low", "shift"), "low").where("shift > 0")
        opened = stored(named.orderBy(F.desc("bytes"), "low").limit(OPENED))
        if opened.isEmpty():
            return table.select("capacity", F.expr("transform(firsts, i -> cells[i].low)").alias("firsts"))
        spans = F.broadcast(opened.select(
            F.shiftright("low", FIRST_SHIFT).alias("range"), F.col("low").alias("first"), F.col("high").alias("last"), F.expr(f"greatest(shift - {STEP}, 0)").alias("shift")
        ))  # OPENED rows at most
        inside = rows.select("key", "size", F.shiftright("key", FIRST_SHIFT).alias("range")).join(spans, "range").where("key between first and last")
        closed = cells.join(F.broadcast(opened.select("low")), "low", "left_anti").select("low", "high", "bytes", "shift")
        cells = stored(closed.unionByName(_cells(inside, "first", own)))


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, sizes near equal over the shards.

    size is the text's UTF-8 bytes plus 1; a null text counts as empty. Equal
    texts stay together: groups, ordered by xxhash64 of the text, are cut into at
    most `shards` contiguous shards of the smallest feasible largest size. Slots
    are gapless from 0 in each shard, an empty table gives no rows, and rows that
    are equal in all have slots in no particular order. Null ids are placed like
    others, other columns are ignored. grown_shard is null under this law.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key")
    )
    # Salts by place, as equal rows would share a salt of their values; the stored table fixes them.
    rows = stored(rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")))
    cut = stored(_partition(rows.select("key", "size"), shards))
    placed = rows.crossJoin(F.broadcast(cut.select("firsts"))).withColumn("shard", F.expr("size(filter(firsts, x -> x <= key))")).drop("firsts")  # one row
    placed = placed.withColumn("range", F.shiftright("key", FIRST_SHIFT))
    cells = placed.groupBy("shard", "range", "salt").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.expr("sum(n) over (partition by shard, range order by salt) - n")
    )
    ranges = cells.groupBy("shard", "range").agg(F.sum("n").alias("n")).withColumn("base", F.expr("sum(n) over (partition by shard order by range) - n"))
    cells = cells.join(ranges.select("shard", "range", "base"), ["shard", "range"]).select(
        "shard", "range", "salt", (F.col("base") + F.col("before")).alias("base")
    )
    numbered = placed.withColumn("at", F.expr("row_number() over (partition by shard, range, salt order by key, doc_id) - 1"))
    return numbered.join(cells, ["shard", "range", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("at")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
