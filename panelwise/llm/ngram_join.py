"""N-gram Jaccard join by prefix trees.

A document's set holds its distinct word n-grams in one global order, rarest
first. Two sets whose similarity reaches the threshold share one of their first
few n-grams, so each set is posted under those only. The sets posted under a
common n-gram are verified by a prefix tree: sorted in the global order, sets
with a common beginning lie side by side, the overlap of the shared path with
the probing set is computed once, and a path is left, with every set below it,
as soon as its overlap and what remains cannot reach the threshold.

Equal sets are one node throughout. Each posting group is first compared with
its smallest member; members that this already connects are not compared with
each other again, so a large group of near copies costs one comparison a member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import lasting, passing, stored
from .textkernel import U, Words, set_ids, shingle_sets, slices

#: Counters of the table that orders n-grams by how common they are, and the pieces it travels in. The table is 512 KB for any corpus.
COUNTERS, PIECES = 1 << 18, 64
#: Members of one posting group that one block holds.
BLOCK = 1024
#: Buckets of the profile that rules out pairs before their sets are compared.
PROFILE = 256
#: Pairs tried for two labels of a group before all their other pairs are.
FIRST = 4
#: Rows of one id and text beyond which each partition first keeps one of them.
HOT_KEY = 1000


def _needed(x, y, percent: int):
    """Least overlap of sets of x and y members for 100 * intersection >= percent * union."""
    return -((-percent * (x + y)) // (100 + percent))


def _prefix(n: int, percent: int, shared: int = 1) -> int:
    """So many of the first n-grams of each of two linked sets hold at least `shared` common ones, if their overlap has as many."""
    return n - -((-percent * n) // 100) + shared


_SIGNED = "kind int, id long, tag long, n long, blob binary, profile binary"


def _signed(text: str, id_: str, n: int):
    """Rows (kind 0): id, tag, size, digest and profile of each set. Rows (kind 1): this partition's share of the counters."""
    names = [c.split()[0] for c in _SIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for part in slices(batches, text):
            values, offsets = shingle_sets(Words(part.column(text), lower=True), n)
            counts += np.bincount((values & U(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
            k = part.num_rows
            owner = np.repeat(np.arange(k), np.diff(offsets))
            profile = np.bincount(owner * PROFILE + (values >> U(56)).astype(np.int64), minlength=k * PROFILE)
            profiles = pa.array([row.tobytes() for row in np.minimum(profile, 255).astype(np.uint8).reshape(k, PROFILE)], pa.binary())
            columns = [
                pa.array(np.zeros(k, np.int32)), part.column(id_), part.column("tag"), pa.array(np.diff(offsets)),
                pa.array(set_ids(values, offsets), pa.binary()), profiles
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if counts.any():
            pieces, nothing = counts.reshape(PIECES, -1), pa.nulls(PIECES, pa.int64())
            columns = [
                pa.array(np.ones(PIECES, np.int32)), nothing, nothing, pa.array(np.arange(PIECES)),
                pa.array([p.tobytes() for p in pieces], pa.binary()), pa.nulls(PIECES, pa.binary())
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _add_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, blob in zip(batch.column("n").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            sums[piece] = sums.get(piece, 0) + np.frombuffer(blob, dtype=np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["n", "blob"])


def _common(signed: DataFrame) -> np.ndarray:
    """The counters as 16-bit ranks on a logarithmic scale, so that any count has its place."""
    rows = signed.where("kind = 1").select("n", "blob").repartition("n").mapInArrow(_add_pieces, "n long, blob binary").collect()  # PIECES rows at most
    table = np.zeros((PIECES, COUNTERS // PIECES))
    for piece, blob in rows:
        table[piece] = np.frombuffer(blob, dtype=np.int64)
    return np.minimum(np.log2(1 + table.ravel()) * 1024, 65535).astype(np.uint16)


def _ordered(values: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """N-grams as numbers in the global order: how common, then the hash's upper 48 bits."""
    return (ranks[(values & U(COUNTERS - 1)).astype(np.int64)].astype(U) << U(48)) | (values >> U(16))


def _postings(text: str, n: int, percent: int, ranks, common: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            values, offsets = shingle_sets(Words(part.column(text), lower=True), n)
            ids, keys = set_ids(values, offsets), _ordered(values, ranks.value)
            heads = [
                np.partition(keys[a:b], p - 1)[:p] if (p := _prefix(b - a, percent, common)) < b - a else keys[a:b] for a,
                b in zip(offsets[:-1], offsets[1:], strict=True) if b > a
            ]
            if heads:
                owners = np.repeat(np.arange(len(heads)), list(map(len, heads)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(heads).view(np.int64)), pa.array([i for i in ids if i], pa.binary()).take(pa.array(owners))],
                    names=["token", "sid"]
                )

    return run


def _sets(text: str, n: int, ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            values, offsets = shingle_sets(Words(part.column(text), lower=True), n)
            keys = _ordered(values, ranks.value)
            tokens = [np.sort(keys[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(set_ids(values, offsets), pa.binary()), pa.array(tokens, pa.binary())], names=["sid", "tokens"])

    return run


def trie_matches(probe: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Which members link with probe; all are in the global order, members are sorted as a prefix tree visits them.

    path holds the current path's n-grams and hits its running overlap with
    probe; a member that shares the first `shared` n-grams of the path starts
    from the overlap there. dead is the depth at which the path was given up.
    """
    found: list[int] = []
    path, hits = np.zeros(0, U), np.zeros(1, np.int64)
    for i, own in enumerate(members):
        m = min(len(path), len(own))
        differ = np.flatnonzero(path[:m] != own[:m])
        shared = int(differ[0]) if len(differ) else m
        need = _needed(len(probe), len(own), percent)
        running = hits[: shared + 1]
        at, path = len(running) - 1, own
        step = 32
        while at < len(own) and running[-1] + min(len(own) - at, len(probe) - running[-1]) >= need:
            piece = own[at : at + step]
            place = np.searchsorted(probe, piece)
            hit = probe[np.minimum(place, len(probe) - 1)] == piece
            running = np.concatenate([running, running[-1] + np.cumsum(hit)])
            at, step = at + len(piece), step * 2
        hits, path = running, own[:at]
        if at == len(own) and running[-1] >= need:
            found.append(i)
    return found


def _verified(percent: int):
    """Rows arrive by probe, the probe's own set (role 0) first, then its members in tree order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, probe, members, names, out = None, None, [], [], []

        def close() -> None:
            if probe is not None and members:
                out.extend((key[0], names[i]) for i in trie_matches(probe, members, percent))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("probe", "salt", "role", "sid"))
            for p, salt, role, sid, tokens in zip(*columns, batch.column("tokens"), strict=True):
                if (p, salt) != key:
                    close()
                    key, probe, members, names = (p, salt), None, [], []
                own = np.frombuffer(tokens.as_buffer(), dtype=U)
                if role == 0:
                    probe = own.copy()
                else:
                    members.append(own.copy())
                    names.append(sid)
                    if len(members) >= 256:
                        close()
                        members, names = [], []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], names=["a", "b"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], names=["a", "b"])

    return run


def _near(na, pa_, nb, pb, percent: int):
    """Whether profiles (rows of counts, cut at 255) differ by no more than linked sets of these sizes can."""
    return np.abs(pa_.astype(np.int16) - pb).sum(axis=-1) <= na + nb - 2 * _needed(na, nb, percent)


def _stacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, PROFILE)


def _ruled(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = _near(
                    batch.column("n_a").to_numpy(), _stacked(batch.column("p_a")), batch.column("n_b").to_numpy(),
                    _stacked(batch.column("p_b")), percent
                )
                yield batch.select(["probe", "sid"]).filter(pa.array(ok))

    return run


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (probe, sid), those that sizes and profiles do not rule out."""
    of = lambda key, mark: nodes.select(F.col("sid").alias(key), F.col("n").alias(f"n_{mark}"), F.col("profile").alias(f"p_{mark}"))
    sized = pairs.join(nodes.select("sid", F.col("n").alias("n_a")), "sid").join(nodes.select(F.col("sid").alias("probe"), F.col("n").alias("n_b")), "probe")
    sized = sized.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("probe", "sid")
    return sized.join(of("sid", "a"), "sid").join(of("probe", "b"), "probe").select("probe", "sid", "n_a", "p_a", "n_b", "p_b").mapInArrow(
        _ruled(percent), "probe binary, sid binary"
    )


def _links(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, percent: int, ranks) -> DataFrame:
    """Of the stored pairs (probe, sid), those whose sets reach the threshold; a probe's members are dealt over tasks of about 256."""
    active = pairs.select("sid").union(pairs.select("probe")).distinct().join(nodes.select("sid", "rep"), "sid")
    texts = docs.join(active.select(F.col("rep").alias("id")).distinct(), "id").select("text")
    sets = stored(texts.mapInArrow(_sets("text", n, ranks), "sid binary, tokens binary").join(active.select("sid"), "sid", "left_semi").dropDuplicates(["sid"]))
    chunks = pairs.groupBy("probe").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("chunks"))
    salted = pairs.join(chunks, "probe").withColumn("salt", F.pmod(F.hash("sid"), F.col("chunks"))).drop("chunks")
    members = salted.join(sets, "sid").select("probe", "salt", F.lit(1).alias("role"), "sid", "tokens")
    probes = salted.select("probe", "salt").distinct().join(sets.withColumnRenamed("sid", "probe"), "probe")
    rows = members.unionByName(probes.select("probe", "salt", F.lit(0).alias("role"), F.col("probe").alias("sid"), "tokens"))
    return rows.repartition("probe", "salt").sortWithinPartitions("probe", "salt", "role", "tokens").mapInArrow(_verified(percent), "a binary, b binary")


def _across(percent: int, best: bool):
    """Pairs of one posting group under different labels that sizes and profiles leave possible; rows arrive by (token, i, j).

    best: for each two labels of a group, only the FIRST pairs whose profiles are
    nearest, as one link is enough to make two labels one.
    """

    def pairs(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        side, sid, label, n, profile = zip(*rows, strict=True)
        side, n = np.array(side), np.array(n)
        labels = np.unique(np.array(label, dtype=object), return_inverse=True)[1]
        profiles = np.frombuffer(b"".join(profile), dtype=np.uint8).reshape(-1, PROFILE).astype(np.int16)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        found, nearest = [], {}
        for x in left:
            ok = right[(labels[right] != labels[x]) & (100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x]))]
            if len(ok):
                far = np.abs(profiles[ok] - profiles[x]).sum(axis=1)
                near = far <= n[ok] + n[x] - 2 * _needed(n[ok], n[x], percent)
                ok, far = ok[near], far[near]
                if best:
                    ok, far = (z[np.argsort(far, kind="stable")] for z in (ok, far))
                    at = np.unique(labels[ok], return_index=True)[1]
                    ok = ok[at]
                if best:
                    for y, apart in zip(ok.tolist(), far[at].tolist(), strict=True):
                        own = nearest.setdefault((min(labels[x], labels[y]), max(labels[x], labels[y])), set())
                        own.add((apart, min(sid[x], sid[y]), max(sid[x], sid[y])))
                        if len(own) > FIRST:
                            own.remove(max(own))
                else:
                    found += [(min(sid[x], sid[y]), max(sid[x], sid[y])) for y in ok]
        return [*found, *((a, b) for own in nearest.values() for _, a, b in own)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, seen = None, [], set()
        for batch in batches:
            for token, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("token", "i", "j", "side", "sid", "label", "n", "profile")), strict=True):
                if (token, i, j) != key:
                    seen.update(pairs(rows) if len(rows) > 1 else ())
                    key, rows = (token, i, j), []
                rows.append(tuple(row))
            if len(seen) > 10_000:
                yield _pairs(seen)
                seen = set()
        seen.update(pairs(rows) if len(rows) > 1 else ())
        yield _pairs(seen)

    def _pairs(seen: set) -> pa.RecordBatch:
        seen = sorted(seen)
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in seen], pa.binary()), pa.array([b for _, b in seen], pa.binary())], names=["probe", "sid"])

    return run


def _labelled(members: DataFrame, by: list[str]) -> DataFrame:
    """Groups under several labels: their most common label (main), members (m), and members outside that label (away)."""
    sizes = members.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.groupBy(*by).agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("m"), (F.sum("n") - F.max("n")).alias("away"))
    return groups.where("away > 0")


def _split(wide: DataFrame, members: DataFrame, longer: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(token, second, sid, label; groups by token and second; tokens) of the wide groups that a second n-gram makes cheaper.

    Linked sets of different members share two n-grams of their longer prefixes
    at least, so one besides the token: no pair is lost. A token is split only if
    its finer groups together compare fewer pairs.
    """
    own = members.join(wide.select("token"), "token").select("token", "sid", "label")
    finer = stored(own.join(longer(own.select("sid").distinct()), "sid").where("second <> token").select("token", "second", "sid", "label"))
    groups = stored(_labelled(finer, ["token", "second"]))
    cost = groups.groupBy("token").agg(F.sum(F.col("m").cast("double") * F.col("away")).alias("cost"))
    tokens = lasting(wide.join(cost, "token", "left").where("coalesce(cost, 0) < cast(m as double) * away").select("token"))
    return finer, groups, tokens


def _across_labels(shared: DataFrame, labels: DataFrame, nodes: DataFrame, longer: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Members of posting groups of three and more under several labels, by (token, i, j).

    One of any two members under different labels is not of the group's most
    common label. Those (side 0) meet all members (side 1), both in blocks, so a
    large group of one label and few outliers costs about a row a member. Where
    a member's two blocks meet it is there once, on both sides (2). A group of
    more than a block of outliers is first split by second n-grams, where
    longer gives (sid, second) of the sets asked for and that saves work.
    """
    marked = shared.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("token", "sid", "probe", F.coalesce("root", "sid").alias("label"))
    groups = stored(_labelled(marked, ["token"]).where("m > 2"))
    members, key = marked.where("probe <> sid").select("token", "sid", "label"), F.col("token")
    placed = members.join(groups, "token")
    wide = groups.where(F.col("away") > BLOCK)
    if longer and not wide.isEmpty():
        finer, own, tokens = _split(wide, members, longer)
        kept = finer.join(tokens, "token", "left_semi").join(own, ["token", "second"]).withColumn("token", F.xxhash64(key, "second")).drop("second")
        placed = members.join(groups.join(tokens, "token", "left_anti"), "token").unionByName(kept)
    blocks = F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("away") / BLOCK).cast("int").alias("others")
    members = placed.select("token", "sid", "label", "main", *blocks).join(nodes.select("sid", "n", "profile"), "sid")
    own = "pmod(hash(sid), {})".format
    every = f"transform(sequence(0, others - 1), j -> named_struct('i', {own('blocks')}, 'j', j, 'side', if(label <> main and j = {own('others')}, 2, 1)))"
    away = f"filter(sequence(0, blocks - 1), i -> label <> main and i <> {own('blocks')})"
    other = f"transform({away}, i -> named_struct('i', i, 'j', {own('others')}, 'side', 0))"
    cells = members.withColumn("at", F.explode(F.expr(f"concat({every}, {other})"))).select("token", "at.*", "sid", "label", "n", "profile")
    return cells.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")


def _joined(docs: DataFrame, n: int, percent: int, postings) -> tuple[DataFrame, DataFrame]:
    """(id, tag, n, sid of every row; sid, root, component_id of every set) of rows of id, tag and text; rows without an id are in no set."""
    spark = docs.sparkSession
    signed = stored(docs.mapInArrow(_signed("text", "id", n), _SIGNED))
    ranks = spark.sparkContext.broadcast(_common(signed))  # 512 KB
    rows = signed.where("kind = 0").select("id", "tag", "n", F.col("blob").alias("sid"))
    known = signed.where("kind = 0 and blob is not null and id is not null").withColumnRenamed("blob", "sid")
    nodes = stored(known.groupBy("sid").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("profile").alias("profile")))

    def longer(sids: DataFrame) -> DataFrame:
        active = nodes.join(sids, "sid", "left_semi").select("sid", "rep")
        texts = docs.join(active.select(F.col("rep").alias("id")).distinct(), "id").select("text")
        seconds = texts.mapInArrow(_postings("text", n, percent, ranks, 2), "second long, sid binary")
        return seconds.join(active.select("sid"), "sid", "left_semi").distinct()

    with passing(spark) as keep:
        posted = docs.select("text").mapInArrow(postings("text", n, percent, ranks), "token long, sid binary")
        groups = posted.groupBy("token").agg(F.min("sid").alias("probe"), F.max("sid").alias("last")).where("probe <> last")
        shared = stored(posted.join(groups.select("token", "probe"), "token").distinct())
        first = shared.where("probe <> sid").select("probe", "sid").distinct()
        links = stored(_links(stored(_possible(first, nodes, percent)), docs, nodes, n, percent, ranks))
        labels = components(links, "a", "b")
        for best in (True, False):
            # What the groups' smallest members have not connected: first the likeliest pair of each two labels, then all that is left.
            second = stored(_across_labels(shared, labels, nodes, longer).mapInArrow(_across(percent, best), "probe binary, sid binary").distinct())
            if second.isEmpty():
                break
            links = stored(links.union(_links(second, docs, nodes, n, percent, ranks)))
            labels = components(links, "a", "b")
        labels = keep(labels)

    member = nodes.select("sid", "rep").join(
        labels.withColumnRenamed("node", "sid"), "sid", "left"
    ).select("sid", "rep", F.coalesce("root", "sid").alias("root"))
    least = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rows, member.join(least, "root").select("sid", "root", "component_id")


def _tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"), F.col(text_col).alias("text"))


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, postings=_postings) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: links join documents with 100 * intersection >= percent * union.

    Words are lower-cased over A-Z. A text of fewer than n words has its whole
    sequence as one n-gram; a null or wordless text has an empty set, links with
    nothing and is its own component. component_id is the smallest doc_id that
    links reach. Repeated rows and ids give a row each; a row with a null id
    passes through, unlinked, with a null component. Other columns are ignored.
    postings gives each set the tokens that bring it together with others; the
    least frequent n-grams lose no link.
    """
    rows, member = _joined(_tagged(docs, id_col, text_col), n, percent, postings)
    out = rows.join(member, "sid", "left")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")
    )


def _first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each (key, tag) of a partition."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        places = []
        for i, own in enumerate(zip(batch.column("key").to_pylist(), batch.column("tag").to_pylist(), strict=True)):
            if own not in seen:
                seen.add(own)
                places.append(i)
        if places:
            yield batch.take(pa.array(places))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, that stay when one row of each linked group does: that of the smallest id.

    Null ids come last; of rows of one id the text of least hash stays, of equal
    rows one. Rows whose text is null or wordless link with nothing and all stay.
    """
    last = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    rows, member = _joined(_tagged(docs.select(last.alias("id"), F.col(text_col)), "id", text_col), n, percent, _postings)
    kept = rows.join(member, "sid").groupBy("root").agg(F.min(F.struct("id", "tag")).alias("x")).select(
        F.xxhash64("x.id", "x.tag").alias("key"), F.col("x.tag").alias("tag")
    )
    tag, worded = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    whole = docs.where(worded).select(F.struct("*").alias("row"), tag.alias("tag"), F.xxhash64(last, tag).alias("key"))  # a struct, as columns may have any name
    # Keys of very many rows, such as copies of one text without ids, leave one row a partition before rows meet by key.
    hot = stored(rows.groupBy(F.xxhash64("id", "tag").alias("key"), "tag").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_KEY).select("key", "tag"))
    if not hot.isEmpty():
        few = whole.join(hot, ["key", "tag"], "left_semi").select("row", "tag", "key").mapInArrow(_first_seen, whole.schema)
        whole = whole.join(hot, ["key", "tag"], "left_anti").select("row", "tag", "key").unionByName(few)
    once = whole.join(kept, ["key", "tag"], "left_semi").withColumn("n", F.expr("row_number() over (partition by key, tag order by tag)")).where("n = 1")
    return once.select("row.*").unionByName(docs.where(~worded))
