"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Every source's documents lie in blocks of a seeded permutation. A source's
target fixes how many passes over its blocks it gets and where the last one
stops, so its quota of block draws is exact. A binary tree splits all quotas
among the output shards: at each node the left half's share of every source is
drawn from the multivariate hypergeometric law, source after source, so quotas
add up exactly at every node. Each shard then takes the next slice of each
source's draws, which is disjoint from all others, and shuffles it locally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

#: Rows of a block, and blocks of a source at most: beyond 16.7 million rows a source its blocks grow with it.
ROWS_PER_BLOCK, BLOCKS = 256, 1 << 16
#: The tree's nodes have a number a source, in one row; more sources are refused.
MOST_SOURCES = 10_000
_WORD, _BLANK = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]*"


def word_count(text: Column) -> Column:
    """Number of words; each with the blanks around it becomes one letter. 0 for null."""
    letters = F.regexp_replace(text, _BLANK + _WORD + _BLANK, "x")
    return F.when(letters.startswith("x"), F.length(letters)).otherwise(0).cast("long")


def _ratio(j: str) -> str:
    return f"(cast({j[0]}k - {j[1]} as double) * ({j[0]}n - {j[1]})) / (({j[1]} + 1.0D) * ({j[0]}t - {j[0]}k - {j[0]}n + {j[1]} + 1))"


# A hypergeometric number by inversion: t items, k of them marked, n drawn, u uniform. Weights run from 12 standard deviations below
# the mean to as far above; what lies beyond has a chance below 1e-30.
_SPAN = "named_struct('t', b.t, 'k', b.k, 'n', b.n, 'u', b.u, 'lo', cast(greatest(0, b.n - b.t + b.k, floor(b.mean - 12 * b.sd) - 2) as bigint), 'hi', cast(least(b.k, b.n, ceil(b.mean + 12 * b.sd) + 2) as bigint))"
_SUM = f"aggregate(sequence(c.lo, c.hi), named_struct('w', 1.0D, 's', 0.0D), (z, j) -> named_struct('w', z.w * {_ratio(('c.', 'j'))}, 's', z.s + z.w), z -> z.s)"
_PICK = f"""if(c.lo >= c.hi, c.lo, aggregate(sequence(c.lo, c.hi), named_struct('w', 1.0D, 's', 0.0D, 'goal', c.u * {_SUM}, 'k', c.lo),
    (z, j) -> named_struct('w', z.w * {_ratio(('c.', 'j'))}, 's', z.s + z.w, 'goal', z.goal, 'k', if(z.s <= z.goal, j, z.k)), z -> z.k))"""
_LEFT = f"""aggregate(sequence(0, size(quotas) - 1), named_struct('t', total, 'n', want, 'out', cast(array() as array<bigint>)),
    (a, i) -> transform(transform(transform(
        array(named_struct('t', a.t, 'k', quotas[i], 'n', a.n, 'u', shiftrightunsigned(xxhash64(seed, low, high, i), 11) / 9007199254740992.0D)),
        b -> named_struct('t', b.t, 'k', b.k, 'n', b.n, 'u', b.u, 'mean', b.n * cast(b.k as double) / greatest(b.t, 1L),
            'sd', sqrt(greatest(0.0D, b.n * (cast(b.k as double) / greatest(b.t, 1L)) * (cast(b.t - b.k as double) / greatest(b.t, 1L)) * (cast(b.t - b.n as double) / greatest(b.t - 1, 1L)))))),
        b -> {_SPAN}),
        c -> named_struct('t', a.t - quotas[i], 'n', a.n - {_PICK}, 'out', concat(a.out, array({_PICK}))))[0],
    a -> a.out)"""


def targets(sizes: DataFrame, weights: tuple[int, ...], total: float, cap: float) -> DataFrame:
    """skey, source_size, rows, target of each source: `total` times all words shared by weight, none above `cap` times its own.

    With sources in ascending order of cap / weight, the level at which the
    shares add up is the largest, over all places, of what the sources before
    the place leave, divided by the weights from there on.
    """
    named = sizes.withColumn("w", F.expr(f"array({','.join(map(str, weights))})[(row_number() over (order by source asc nulls last) - 1) % {len(weights)}]"))
    named = named.withColumn("most", cap * F.col("source_size")).withColumn("all", F.expr(f"{total}D * sum(source_size) over ()"))
    order = "order by most / w, skey rows"
    level = F.expr(f"(all - coalesce(sum(most) over ({order} between unbounded preceding and 1 preceding), 0)) / sum(w) over ({order} between current row and unbounded following)")
    return named.withColumn("level", level).withColumn("level", F.expr("max(level) over ()")).select(
        "skey", "source_size", "rows", F.least("most", F.col("level") * F.col("w")).alias("target")
    )


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), total: float = 1.5, cap: float = 2.0, shards: int = 64, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> tuple[DataFrame, DataFrame]:
    """(rows, draws): uid, doc_id, size, source_size, target of every document; uid, doc_id, tag (xxhash64 of the text), skey (its source), shard, pass, words, place of every draw.

    Weights repeat along the sources in code-point order, a null source last.
    size is the number of words, 0 for a null text; texts without words are
    never drawn in a partial pass. A source takes floor(target) words: whole
    passes, then documents of the permutation until they are used up, the last
    one cut. A shard's order is that of place. Equal calls give equal results
    for distinct (doc_id, text); equal rows are drawn each by itself; null ids
    are drawn like others; an empty table gives no rows. Shards must be a power
    of two, and sources at most MOST_SOURCES, else it raises.
    """
    skey = _source_key(F.col(source_col))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), skey.alias("skey"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"), word_count(F.col(text_col)).alias("size")
    )
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "tag", "size")))
    sizes = rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goal = stored(targets(sizes, weights, total, cap))
    if goal.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    number = F.least(F.lit(BLOCKS), F.ceil(F.col("rows") / ROWS_PER_BLOCK)).cast("long")
    laid = rows.join(goal, "skey").withColumn("block", F.pmod(F.shiftright("key", 8), number))
    laid = laid.withColumn("ahead", F.expr("sum(size) over (partition by skey, block order by key, uid) - size"))
    blocks = laid.groupBy("skey", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    blocks = blocks.withColumn(
        "start", F.expr("sum(words) over (partition by skey order by block) - words")
    ).withColumn("at", F.expr("row_number() over (partition by skey order by block) - 1"))
    blocks = blocks.withColumn(
        "full", F.expr("if(source_size = 0, 0L, cast(floor(target) as bigint) div source_size)")
    ).withColumn("rest", F.expr("cast(floor(target) as bigint) - full * source_size"))
    blocks = stored(blocks.withColumn("number", F.expr("count(1) over (partition by skey)")))
    draws = blocks.where("words > 0").withColumn("pass", F.expr("explode(sequence(0, full))")).where("pass < full or start < rest")
    draws = stored(draws.select(
        "skey", "block", "pass", F.expr("if(pass < full, -1L, rest - start)").alias("limit"),
        F.expr("row_number() over (partition by skey, pass order by at) - 1").alias("at")
    ))
    passes = draws.groupBy("skey", "pass").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.expr("sum(n) over (partition by skey order by pass) - n"))
    draws = draws.join(passes.select("skey", "pass", "before"), ["skey", "pass"]).select(
        "skey", "block", "pass", "limit", (F.col("before") + F.col("at")).alias("draw")
    )

    quotas = passes.groupBy("skey").agg(F.sum("n").alias("n"))  # one row a source
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("skey", "n"))).alias("q")).where("size(q) > 0")
    node = node.select(
        F.col("q.skey").alias("skeys"), F.col("q.n").alias("quotas"), F.lit(0).alias("low"), F.lit(shards).alias("high"),
        F.lit(seed).alias("seed")
    )
    node = node.withColumn("all", F.expr("aggregate(quotas, 0L, (a, x) -> a + x)"))
    share = lambda a, b: f"(({b}) * all div {shards} - ({a}) * all div {shards})"
    for _ in range(shards.bit_length() - 1):
        node = node.withColumn("middle", F.expr("(low + high) div 2")).withColumn("want", F.expr(share("low", "middle"))).withColumn(
            "total", F.expr("aggregate(quotas, 0L, (a, x) -> a + x)")
        )
        node = stored(node.withColumn("left", F.expr(_LEFT)))
        halves = F.expr("explode(array(named_struct('l', low, 'h', middle, 'q', left), named_struct('l', middle, 'h', high, 'q', zip_with(quotas, left, (x, y) -> x - y))))")
        node = node.withColumn("half", halves).select(
            "skeys", F.col("half.q").alias("quotas"), F.col("half.l").cast("int").alias("low"), F.col("half.h").cast("int").alias("high"),
            "seed", "all"
        )
    leaves = node.select(
        F.col("low").alias("shard"), F.explode(F.arrays_zip("skeys", "quotas")).alias("z")
    ).select("shard", F.col("z.skeys").alias("skey"), F.col("z.quotas").alias("n"))
    leaves = leaves.withColumn("first", F.expr("sum(n) over (partition by skey order by shard) - n")).where("n > 0")
    slots = leaves.select("skey", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("draw"))
    dealt = draws.join(slots, ["skey", "draw"]).select("skey", "block", "pass", "limit", "shard")
    drawn = laid.join(dealt, ["skey", "block"]).withColumn(
        "words", F.expr("if(limit < 0, size, greatest(0L, least(size, limit - ahead)))")
    ).where("words > 0 or (size = 0 and limit < 0)")
    drawn = drawn.select("uid", "doc_id", "tag", "skey", "shard", "pass", "words", F.xxhash64(F.lit(seed), "shard", "pass", "uid").alias("place"))
    return rows.join(goal, "skey").select("uid", "doc_id", "size", "source_size", "target"), drawn


def mixed(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row, and its draws in order: taken is the words that the mix takes of it, repeats counted; a draw has shard, place, pass and words."""
    rows, draws = mix_sources(docs, **options)
    draw = F.struct("shard", "place", "pass", "words")
    taken = draws.groupBy("uid").agg(F.sum("words").alias("taken"), F.sort_array(F.collect_list(draw)).alias("draws"))  # at most cap + 1 draws of a document
    none = F.expr("cast(array() as array<struct<shard:int,place:bigint,pass:bigint,words:bigint>>)")
    return rows.join(taken, "uid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("draws", none).alias("draws")
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars", **options
) -> DataFrame:
    """The mix itself: a row of docs, with all its columns, for every draw of it.

    The last document of a source may be cut to fewer words; length_col, if
    there, is then its new length. Rows of equal id, text and source are drawn
    each by itself, with the other columns of one of them.
    """
    drawn = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)[1].select(F.col("doc_id").alias("id"), "tag", "skey", "words")
    # A struct, as columns may have any name.
    tag = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    tagged = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("own_id"), tag.alias("own_tag"),
        _source_key(F.col(source_col)).alias("own_skey")
    ).dropDuplicates(["own_id", "own_tag", "own_skey"])
    rows = tagged.join(drawn, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_tag") == F.col("tag")) & (F.col("own_skey") == F.col("skey")))
    old = F.col("row")[text_col]
    short = F.array_join(F.slice(F.split(F.regexp_replace(old, "^" + _BLANK, ""), _BLANK[:-1] + "+"), 1, F.greatest(F.col("words"), F.lit(0)).cast("int")), " ")
    cut = word_count(old) > F.col("words")
    new = {
        text_col: F.when(cut, short).otherwise(old),
        length_col: F.when(cut, F.length(short).cast("long")).otherwise(F.col("row")[length_col]) if length_col in docs.columns else None
    }
    return rows.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))
