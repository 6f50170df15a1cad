"""What filters do to each other, by relations of the ids that fail them.

Each filter stores the table of ids that fail it. All rows pass these relations
one after another: a left-semi and a left-anti join split them into those in the
relation, which take its bit, and those not in it. Survivors, removals,
redundancies and losses of any prefix of any order are sums over the sets of
relations that rows are found in, of which there are few.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored

WORD_BREAK = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_rules(text: Column) -> dict[str, Column]:
    """Failure conditions A to D on a text without nulls."""
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    capitals = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _met(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join by keys that may be null; both sides have a row a key at most, or rows counted by key, so none is hot."""
    other = right.select(*(F.col(c).alias(f"_r_{c}") for c in on))
    condition = [left[c].eqNullSafe(other[f"_r_{c}"]) for c in on]
    return left.join(other, condition, how)


def in_relations(rows: DataFrame, relations: list[DataFrame], on: list[str], out: str = "pattern") -> DataFrame:
    """rows with a column of bits: bit i is set where relations[i] has their key. Each relation's split is stored, so that the next reads it once."""
    rows = rows.withColumn(out, F.lit(0))
    for bit, ids in enumerate(relations):
        inside = _met(rows, ids, on, "left_semi").withColumn(out, F.col(out) + F.lit(1 << bit))
        rows = stored(inside.unionByName(_met(rows, ids, on, "left_anti")))
    return rows


def interaction_audit(rows: DataFrame, relations: dict[str, DataFrame], on: list[str], part: str = "part") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every order of the filters.

    rows has the columns of `on`, part, n (how many documents it counts), good
    and toxic (booleans); relations names the failing keys of each filter by one
    letter. Each step's filter is its letter: removed fail it and none before,
    redundant fail it and one before, unique_fails fail it alone; shapley is what
    it removes in all orders together. Parts without rows give none.
    """
    letters = sorted(relations)
    sums = in_relations(rows, [relations[x] for x in letters], on).groupBy(part, "pattern").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")
    )
    cells = sums.groupBy(part).agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))  # at most 2 ** filters of them
    bit = {x: 1 << i for i, x in enumerate(letters)}
    orders = ["".join(p) for p in permutations(letters)]
    steps = [(o, i, bit[x], sum(bit[y] for y in o[:i])) for o in orders for i, x in enumerate(o)]
    column = lambda k, kind: F.from_json(F.lit("[" + ",".join(f'"{s[k]}"' if kind == "string" else str(s[k]) for s in steps) + "]"), f"array<{kind}>")
    zipped = F.arrays_zip(*(column(k, t).alias(c) for k, (c, t) in enumerate((("filter_order", "string"), ("at", "int"), ("own", "int"), ("before", "int")))))
    wide = cells.select(part, "cells", F.inline(zipped).alias("filter_order", "at", "own", "before"))

    def over(rule: str, value: str) -> Column:
        return F.expr(f"aggregate(filter(cells, c -> {rule}), bigint(0), (s, c) -> s + {value})")

    fails, gone = "(c.pattern & own) <> 0", "(c.pattern & before) <> 0"
    removed = f"{fails} and not {gone}"
    share = f"c.n * {len(orders)} div bit_count(c.pattern)"  # of the orders of k failing filters, one in k has this one first
    return wide.select(
        part, "filter_order", (F.col("at") + 1).alias("step"), over(f"not {gone} and not {fails}", "c.n").alias("kept"), over(removed, "c.n").alias("removed"),
        over(f"{fails} and {gone}", "c.n").alias("redundant"), over("c.pattern = own", "c.n").alias("unique_fails"),
        over(removed, "c.good").alias("good_lost"), over(removed, "c.toxic").alias("toxic_lost"), over(fails, share).alias("shapley")
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interaction_audit of filters A to D (text_rules) and E (the same text under a smaller doc_id) over whole texts, by source.

    A null text is empty, a null source the empty string. Documents are keyed by
    doc_id and a 128-bit digest of the text, so rows that repeat an id are judged
    each by its own text, and equal rows are counted together before anything is
    shuffled. A null doc_id is neither smaller nor greater than another: such
    rows never fail E and make none fail it. A document is good (toxic) if any of
    its labels has quality (toxic) 1; null ids have no labels. Other columns are
    ignored, an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text")
    )
    seen = read.select("id", "digest", "part", *(c.alias(x) for x, c in text_rules(F.col("text")).items()))
    rows = stored(seen.groupBy("id", "digest", "part", *"ABCD").agg(F.count(F.lit(1)).alias("n")))
    on = ["id", "digest"]
    relations = {x: stored(rows.where(x).select(*on).distinct()) for x in "ABCD"}
    known = rows.where("id is not null")
    first = known.groupBy("digest").agg(F.min("id").alias("id"))
    relations["E"] = stored(_met(known.select(*on).distinct(), first, on, "left_anti"))
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("_k")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # A null id gets a key of its text's, so that such rows lie apart; it meets no label.
    keyed = rows.select(*on, "part", "n", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("null "), F.hex("digest"))).alias("_k"))
    marked = keyed.join(flags, "_k", "left").select(*on, "part", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    return interaction_audit(stored(marked), relations, on)


def audit_sql() -> str:
    """DuckDB SQL of audit_documents over the tables documents and labels."""
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{WORD_BREAK}'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
|| CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' ELSE '' END
|| CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN coalesce(doc_id > least, false) THEN 'E' ELSE '' END AS fails,
coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN g USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
o(filter_order) AS (VALUES {orders}),
s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier FROM o, range(1, 6) t(step)),
x AS (SELECT part, filter_order, step, n, good, toxic, own, contains(fails, own) AS hit, len(fails) AS many,
earlier <> '' AND length(translate(fails, earlier, '')) < length(fails) AS gone FROM c, s),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN hit AND many = 1 THEN n ELSE 0 END) AS unique_fails,
sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""
