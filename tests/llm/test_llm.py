"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import math
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from panelwise.llm import gru, lm_scoring, neighbours, ngram_join, sharding
from panelwise.llm.fingerprints import fingerprints, near_duplicates
from panelwise.llm.licenses import TEXTS, known_licenses, license_scan, scan_sql
from panelwise.llm.lm_scoring import score_documents
from panelwise.llm.mixing import mix_sources, mixed, mixed_documents
from panelwise.llm.neighbours import nearest
from panelwise.llm.ngram_join import _across_labels, first_of_each, ngram_jaccard_join, trie_matches
from panelwise.llm.packing import encoder, first_fit_decreasing, pack
from panelwise.llm.quality import BUCKETS, LABELLERS, _sampled, _scored, accuracies, classify_quality, good_documents
from panelwise.llm.sharding import shard_documents
from panelwise.llm.substring_dedup import _probes, substring_dedup, unpack
from panelwise.llm.substring_dedup import pack as packed
from panelwise.llm.textkernel import Words, shingle_sets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, tag string, n int, token string"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary, size=n)) for n in (3, 60, 120, 200, 200, 400, 5000)]
    out = [None, "", "  \t\n ", "one", "Two words", *base]
    for text in base[1:5]:
        for edits in (1, 2, 6, 14):
            own = text.split(" ")
            for at in rng.integers(0, len(own), edits):
                own[at] = f"edit{rng.integers(1000)}"
            out += [" ".join(own), text]
    passage = " ".join(f"p{i}" for i in range(70))
    out += [
        f"{base[1]} {passage}\n{base[2]}", f"start {passage} end", f"{passage} {passage}",
        "Copyright 2020 X\nReleased under the  MIT Licence.", "All rights reserved."
    ]
    sources = ["a", "b", None, "c", "hot", "hot", "hot"]
    return [(i * 3 + 1, t, "en", sources[i % 7], len(t or ""), i, "x", 1, "y") for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize(("n", "percent", "bands"), [(3, 90, False), (5, 80, False), (5, 80, True)])
def test_ngram_join(docs, empty, n, percent, bands):
    sets = {}
    for r in rows():
        w = words(low(r[1]))
        sets[r[0]] = frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = (near_duplicates(docs) if bands else ngram_jaccard_join(docs, n=n, percent=percent)).collect()
    assert len(got) == len(sets) and all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id)) for r in got)
    assert (near_duplicates(empty) if bands else ngram_jaccard_join(empty)).count() == 0


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, "a b c d")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in ngram_jaccard_join(df, n=3).collect()) == [("5", "5"), ("5", "5"), ("7", "5"), ("None", "None")]


def test_one_of_very_many_copies_without_ids_stays(spark):
    text = F.expr("if(id % 3 = 0, 'a b c d e f g', concat('own text number ', string(id)))")
    docs = spark.range(9000).repartition(5).select(F.when(F.col("id") % 2 == 1, F.col("id")).alias("doc_id"), text.alias("text"), F.lit("k").alias("key"), F.lit(1).alias("tag"))
    got = first_of_each(docs)
    assert got.columns == docs.columns and got.count() == 6001 and [r.doc_id for r in got.where("text = 'a b c d e f g'").collect()] == [3]
    lone = first_of_each(docs.where("doc_id is null"))
    assert lone.count() == 3001 and lone.where("text = 'a b c d e f g'").count() == 1


def test_one_row_of_each_group_stays(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    near = a.replace("a59", "z")
    data = [
        (5, a, "x"), (5, a, "x"), (7, near, "x"), (5, b, "y"), (None, b, "y"), (None, b, "y"), (None, "alone here", "z"),
        (None, "alone here", "z"), (9, None, "n"), (9, None, "n"), (8, " ", "n")
    ]
    got = first_of_each(spark.createDataFrame(data, "doc_id long, text string, _n string").repartition(3)).collect()
    want = [(5, a, "x"), (5, b, "y"), (None, "alone here", "z"), (9, None, "n"), (9, None, "n"), (8, " ", "n")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_outliers_of_a_large_group_cost_a_row_a_member(spark):
    sid = F.expr("cast(lpad(string(id), 16, '0') as binary)")
    many = spark.range(20_000)
    shared = many.select(F.lit(1).alias("token"), F.expr("cast(lpad('0', 16, '0') as binary)").alias("probe"), sid.alias("sid"))
    labels = many.where("id <> 19999").select(sid.alias("node"), F.lit(b"main").alias("root"))
    nodes = many.select(sid.alias("sid"), F.lit(50).alias("n"), F.lit(bytes(256)).alias("profile"))
    cells = _across_labels(shared, labels, nodes)
    assert cells.count() <= 20_100 and cells.where("side <> 1").select("sid").distinct().count() == 1


def test_unlinked_members_of_a_large_group_are_split(spark):
    sid = F.expr("cast(lpad(string(id), 16, '0') as binary)")
    many = spark.range(32_768)
    shared = many.select(F.lit(1).cast("long").alias("token"), F.expr("cast(lpad('x', 16, '0') as binary)").alias("probe"), sid.alias("sid"))
    labels = spark.createDataFrame([], "node binary, root binary")
    nodes = many.select(sid.alias("sid"), F.lit(50).alias("n"), F.lit(bytes(256)).alias("profile"))
    seconds = many.select(sid.alias("sid"), F.explode(F.expr("array(1, 100000 + id, 200000 + id div 2)")).alias("second"))
    cells = _across_labels(shared, labels, nodes, lambda sids: seconds.join(sids, "sid", "left_semi"))
    assert cells.count() <= 32_768 * 2
    met = cells.groupBy("token", "i", "j").agg(F.collect_set("sid").alias("s")).where("size(s) = 2")
    assert met.select(F.explode("s")).distinct().count() == 32_768
    # Where every second n-gram is shared by all, the group is not split.
    common = many.select(sid.alias("sid"), F.explode(F.expr("array(5L, 6L)")).alias("second"))
    few = _across_labels(shared.limit(3000), labels, nodes, lambda sids: common.join(sids, "sid", "left_semi"))
    assert few.select("token").distinct().collect() == [(1,)]


@pytest.mark.parametrize("own", [20, 60])
def test_split_groups_lose_no_link(spark, monkeypatch, own):
    rng = np.random.default_rng(own)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    ranks = np.ones(ngram_join.COUNTERS, np.uint16)
    ranks[int(shingle_sets(Words(pa.array(["c0 c1 c2"]), lower=True), 3)[0][0]) % ngram_join.COUNTERS] = 0  # what all texts share stands first
    monkeypatch.setattr(ngram_join, "_common", lambda signed: ranks)
    chosen = []
    split = ngram_join._split
    monkeypatch.setattr(ngram_join, "_split", lambda *a: chosen.append(split(*a)) or chosen[-1])
    texts = []
    for _ in range(40):
        text = [*(f"c{i}" for i in range(3)), *(f"w{x}" for x in rng.integers(0, 5000, own))]
        texts.append(text)
        for edits in rng.integers(0, 4, 2):
            near = list(text)
            for at in rng.integers(3, len(near), edits):
                near[at] = f"e{rng.integers(1000)}"
            texts.append(near)
    sets = [frozenset(tuple(t[i : i + 3]) for i in range(len(t) - 2)) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_jaccard_join(docs, n=3, percent=80).collect()}
    assert got == {i: find(i) for i in range(len(sets))}
    assert any(tokens.count() for _, _, tokens in chosen)


def test_trie_shares_paths_and_prunes():
    arrays = [np.array(x, np.uint64) for x in (
        [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], [1, 2, 3, 4, 5, 6, 7, 8, 9, 11], [1, 2, 20, 21, 22, 23, 24, 25, 26, 27], list(range(1, 41))
    )]
    assert trie_matches(np.arange(1, 11, dtype=np.uint64), arrays, 80) == [0, 1]


def test_substring_dedup(docs, empty):
    seen, want = {}, {}
    for r in sorted(rows()):
        w, at = words(r[1]), set()
        for s in range(len(w) - 49):
            if seen.setdefault(tuple(w[s : s + 50]), r[0]) < r[0]:
                at.update(range(s, s + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in at)
        want[r[0]] = (len(w), len(at), hashlib.sha256(kept.encode()).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs).collect()}
    assert got == want and any(v[1] for v in want.values())
    assert substring_dedup(empty).count() == 0
    x = np.array([0, 3, 70000, 70001])
    assert (unpack(packed(x)) == x).all()


@pytest.mark.parametrize("bits", [6, 12, 15])
def test_substring_probes_stay_small(bits):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(20_000, 300).astype(str)) for _ in range(4000)]
    columns = {
        "id": pa.array(range(4000), pa.int64()), "tag": pa.array(range(4000), pa.int64()), "text": pa.array(texts),
        "piece": pa.array([0] * 4000, pa.int64())
    }
    out = list(_probes(50, bits)(iter([pa.RecordBatch.from_pydict(columns)])))
    size, rows = sum(b.nbytes for b in out), sum(b.num_rows for b in out)
    assert rows <= 1 << bits and size + 64 * rows < 3 * sum(map(len, texts))


def test_substring_dedup_over_many_pieces(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(i, f"{' '.join(f'{i}_{k}' for k in range(80))} {passage if i % 3 else ''}") for i in range(300)] + [(None, passage), (0, passage), (7, None)]
    got = substring_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(40)).collect()
    assert len(got) == len(data)
    wrong = [r[:3] for r in got if r.n_removed != (60 if r.doc_id and r.doc_id % 3 and r.n_words > 100 else 0)]
    assert not wrong


def test_fingerprints(docs, empty):
    got = {r.doc_id: r for r in fingerprints(docs).collect()}
    order = sorted(rows(), key=lambda r: -r[0])
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (got[r[0]].n_chars, got[r[0]].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    same = collections.defaultdict(set)
    for r in rows():
        same[r[1] or ""].add(got[r[0]].fingerprint)
    assert all(len(x) == 1 for x in same.values())
    assert fingerprints(empty).count() == 0


def test_likeness_is_near_true_jaccard(docs):
    def shingles(text):
        w = words(low(text))
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    got, order = {r.doc_id: r for r in fingerprints(docs).collect()}, sorted(rows(), key=lambda r: -r[0])
    seen = 0
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        for other, near in ((after, got[r[0]].near_next), (text[: len(text) - half] + after[:half], got[r[0]].near_edited)):
            a, b = shingles(text), shingles(other)
            true = len(a & b) / len(a | b) if a and b else float(a == b)
            seen += 0 < true < 1
            assert abs(near - true) <= 4.5 * math.sqrt(true * (1 - true) / 128) + 0.01, (r[0], near, true)
    assert seen > 10


def test_fingerprints_of_repeated_rows(spark):
    data = [(None, "x y z"), (None, None), (3, "a b c d e f g"), (3, "a b c d e f g"), (3, "zz")]
    got = fingerprints(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == [("3", 2), ("3", 13), ("3", 13), ("None", 0), ("None", 5)]
    assert len({r.fingerprint for r in got if r.n_chars == 13}) == 1 and all(0 <= r.near_next <= 1 for r in got)


def test_very_long_text(spark):
    rng = np.random.default_rng(1)
    long = " ".join(rng.integers(0, 10**6, 150_000).astype(str))
    edited = "other " + long[: len(long) // 2] + " changed " + long[len(long) // 2 :]
    df = spark.createDataFrame([(1, long, "a"), (2, edited, "b"), (3, "short one", "a")], "doc_id long, text string, source string")
    assert {r.doc_id: r.component_id for r in ngram_jaccard_join(df).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r.doc_id: r.n_words - r.n_removed for r in substring_dedup(df).collect()}[2] < 200
    assert {r.doc_id: r.n_chars for r in fingerprints(df).collect()} == {1: len(long), 2: len(edited), 3: 9}
    assert classify_quality(df).count() == 3 and mixed(df).count() == 3 and shard_documents(df, 2).count() == 3


def test_mixing(docs, empty):
    got = mixed(docs).collect()
    by = collections.defaultdict(list)
    source = {r[0]: r[3] for r in rows()}
    for r in got:
        assert r.taken <= 2 * r.size
        by[source[r.doc_id]].append(r)
    for own in by.values():
        assert own[0].source_size == sum(r.size for r in own) and abs(sum(r.taken for r in own) - own[0].target) < 1
    assert sum(own[0].target for own in by.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixed(docs).collect()))
    assert sum(len(words(r.text)) for r in mixed_documents(docs).collect()) == sum(r.taken for r in got)
    assert mixed(empty).count() == 0


def test_mixing_splits_exact_quotas(spark):
    """Each pass over a block lies in one shard, shards get equal numbers of draws, and the split of a source follows the hypergeometric law over seeds."""
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.lit("two words").alias("text"), F.expr("if(id % 3 = 0, 'a', 'b')").alias("source")).cache()
    firsts = []
    for seed in range(12):
        draws = mix_sources(docs, weights=(1, 1), total=1.0, shards=4, seed=seed)[1].toPandas()
        assert not draws.duplicated(["uid", "pass"]).any() and (draws.groupby("skey")["words"].sum() - 24_000).abs().max() <= 16_000
        blocks = draws.groupby(["skey", "pass", "shard"])["uid"].count().unstack(fill_value=0)
        firsts.append(blocks.loc["sa"].sum()[0] / blocks.loc["sa"].sum().sum())
    assert np.mean(firsts) == pytest.approx(0.25, abs=0.06) and 0.005 < np.std(firsts) < 0.12


def least_capacity(texts, shards):
    """Smallest largest shard of groups of equal texts, in the order of their hash, over all contiguous partitions."""
    groups = collections.Counter()
    for t in texts:
        groups[t or ""] += len((t or "").encode()) + 1
    signed = {t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64 for t in groups}
    sizes = [groups[t] for t in sorted(groups, key=signed.get)]

    def parts(capacity):
        n, used = 1, 0
        for s in sizes:
            n, used = (n + 1, s) if used + s > capacity else (n, used + s)
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if parts(middle) <= shards else (middle + 1, high)
    return low


def check_shards(rows, texts, shards):
    slots, where, load = collections.defaultdict(list), collections.defaultdict(set), collections.Counter()
    for r in rows:
        text = texts[r.doc_id] or ""
        slots[r.shard].append(r.slot)
        where[text].add(r.shard)
        load[r.shard] += r.size
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "bytes", None)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and all(len(x) == 1 for x in where.values())
    assert set(slots) <= set(range(shards)) and max(load.values()) == least_capacity([texts[r.doc_id] for r in rows], shards)


def test_sharding(docs, empty):
    check_shards(shard_documents(docs, 4).collect(), {r[0]: r[1] for r in rows()}, 4)
    assert shard_documents(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 5, 8])
def test_sharding_opens_cells_with_cuts(spark, shards):
    rng = np.random.default_rng(shards)
    texts = {i: "x" * int(n) + str(i) for i, n in enumerate(rng.integers(0, 900, 20_000))}
    texts |= {i: "a third of the bytes " * 10 for i in range(20_000, 26_000)} if shards == 8 else {}
    data = [(i, t) for i, t in texts.items()] + [(5, texts[5])] * 3
    check_shards(shard_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(6), shards).collect(), texts, shards)


def test_sharding_opens_few_cells_a_round(spark, monkeypatch):
    monkeypatch.setattr(sharding, "OPENED", 3)
    rng = np.random.default_rng(3)
    texts = {i: "x" * int(n) + str(i) for i, n in enumerate(rng.integers(0, 900, 3000))}
    check_shards(shard_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6), 5).collect(), texts, 5)


def test_sharding_of_repeated_rows(spark):
    data = [(None, None), (1, "a"), (1, "a"), (None, ""), (2, "b" * 50)]
    got = shard_documents(spark.createDataFrame(data, "doc_id long, text string"), 3).collect()
    assert len(got) == 5 and sorted(r.size for r in got) == [1, 1, 2, 2, 51]
    assert len({(r.shard, r.slot) for r in got}) == 5


def test_packing(docs, empty):
    import public_tokenizers as tokenizers_files
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizers_files.path("byte_bpe_50k.json"))
    text = {r[0]: r[1] or "" for r in rows()} | {10_001: "one <|endoftext|> two<|endoftext|>", 10_002: "<|endoftext"}
    more = docs.sparkSession.createDataFrame([(i, text[i]) for i in (10_001, 10_002)], "doc_id long, text string")
    got = pack(docs.select("doc_id", "text").union(more), tokenizers_files.path("byte_bpe_50k.tiktoken")).collect()
    bins, pieces = collections.defaultdict(list), collections.Counter()
    for r in got:
        ids = np.array([*tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(ids[r.start : r.start + r.length].tobytes()), len(ids))
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.length
    assert len(pieces) == len(text)
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 2048
    assert pack(empty, tokenizers_files.path("byte_bpe_50k.tiktoken")).count() == 0


def test_packing_of_repeated_rows(spark):
    import public_tokenizers as tokenizers_files

    data = [(None, None), (1, "a b"), (1, "a b"), (None, "a b"), (2, "word " * 9000)]
    got = pack(spark.createDataFrame(data, "doc_id long, text string"), tokenizers_files.path("byte_bpe_50k.tiktoken")).collect()
    assert sorted(r.length for r in got if r.doc_id == 1) == [3, 3] and sorted(r.length for r in got if r.doc_id is None) == [1, 3]
    assert sum(r.length for r in got if r.doc_id == 2) == next(r.doc_tokens for r in got if r.doc_id == 2) > 2 * 2048


def test_packing_gives_the_added_token_its_id():
    import public_tokenizers as tokenizers_files
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizers_files.path("byte_bpe_50k.json"))
    for text in ("<|endoftext|>", "one <|endoftext|> two", "a<|endoftext|><|endoftext|>\n b", "<|endoftext", "it's  plain é\n"):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert all(encoder(tokenizers_files.path(f"byte_bpe_50k.{kind}"))(text).tolist() == want for kind in ("json", "tiktoken")), text


def test_first_fit_decreasing():
    rng = np.random.default_rng(0)
    sizes = np.sort(rng.integers(1, 101, 300))[::-1]
    room, want = [], []
    for s in sizes:
        at = next((i for i, r in enumerate(room) if r >= s), len(room))
        room += [100] * (at == len(room))
        room[at] -= s
        want.append(at)
    assert first_fit_decreasing(sizes, 100).tolist() == want


def test_license_scan(docs, spark, empty):
    last = max(r[0] for r in rows())
    got = sorted((r.doc_id, r.line, r.license) for r in license_scan(docs, known_licenses(spark)).collect())
    assert got == [(last - 3, 0, "MIT"), (last - 3, 2, "MIT"), (last, 0, "all-rights-reserved"), (last, 1, "all-rights-reserved")]
    assert license_scan(empty, known_licenses(spark)).count() == 0


def test_license_files_in_usual_wrapping(spark):
    isc, mit, bsd = TEXTS["ISC"], TEXTS["MIT"], TEXTS["BSD-3-Clause"]
    wrapped = isc.replace("above copyright notice", "above\ncopyright notice")
    files = [
        f"ISC License\n\nCopyright (c) 2020 A B\n\n{wrapped}\n", f"Copyright A B\n{wrapped}",
        f"MIT License\n\nCopyright 2020 A\n\n{mit.replace('COPYRIGHT HOLDERS', chr(10) + 'COPYRIGHT HOLDERS')}",
        isc.replace("above copyright", "above\ncopyright\n"),
        "BSD 3-Clause License\nCopyright (c) 2001, X\nAll rights\n".replace("All rights\n", "") + bsd.replace(" 2. ", "\n2. ")
    ]
    assert all("\ncopyright" in f.lower() or f.startswith("Copyright") for f in files)
    got = license_scan(spark.createDataFrame(list(enumerate(files)), "doc_id long, text string"), known_licenses(spark)).collect()
    assert sorted((r.doc_id, r.line, r.license) for r in got) == [(0, 0, "ISC"), (1, 0, "ISC"), (2, 0, "MIT"), (3, 0, "ISC"), (4, 0, "BSD-3-Clause")]


def test_license_spellings(spark):
    known = spark.createDataFrame([("X", "license license v. 2 licence")], "license string, body string")
    data = [(1, "Licence licence, V.2 LICENSE"), (2, "licence V 2"), (None, "license license v 2 license"), (3, None), (3, "")]
    got = license_scan(spark.createDataFrame(data, "doc_id long, text string"), known).collect()
    assert sorted((str(r.doc_id), r.line) for r in got) == [("1", 0), ("1", 1), ("None", 0), ("None", 1)]


def test_license_scan_matches_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view documents as select * from read_parquet('/root/testdata/sf0.01/documents.parquet')")
    got = license_scan(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), known_licenses(spark)).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(scan_sql()).fetchall()) and got


def test_quality(docs, spark, empty):
    assert classify_quality(empty).count() == 0 and classify_quality(docs).count() == len(rows())
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [(labels[r.doc_id], r.keep) for r in classify_quality(table).collect() if r.doc_id in labels]
    assert np.mean([bool(q) == k for q, k in got]) > 0.95
    assert good_documents(table).count() == sum(r.keep for r in classify_quality(table).collect())


def test_weak_label_model_against_brute_force():
    rng = np.random.default_rng(3)
    truth = rng.random(3000) < 0.7
    digits = np.zeros((3000, len(LABELLERS)), int)
    for i in range(len(LABELLERS)):
        right, silent = rng.random(3000) < 0.9 - 0.05 * i, rng.random(3000) < 0.2
        digits[:, i] = np.where(silent, 0, np.where(truth == right, 1, 2))
    codes, back, counts = np.unique(digits @ 3 ** np.arange(len(LABELLERS)), return_inverse=True, return_counts=True)
    good, chance = accuracies(codes, counts, 30)
    p = [min(max(0.9 - 0.3 * (d == 2).sum() + 0.02 * (d == 1).sum(), 0.05), 0.95) for d in digits]
    for _ in range(30):  # a document at a time
        tables = [[[1.0 + sum(w for w, d in zip(weights, digits[:, i], strict=True) if d == v) for v in range(3)] for i in range(len(LABELLERS))] for weights in ([1 - x for x in p], p)]
        tables = [[[x / sum(row) for x in row] for row in t] for t in tables]
        prior = (sum(p) + 1) / (len(p) + 2)
        odds = {tuple(d): sum(
            math.log(tables[1][i][v] / tables[0][i][v]) for i, v in enumerate(d)
        ) + math.log(prior / (1 - prior)) for d in np.unique(digits, axis=0)}
        p = [1 / (1 + math.exp(-odds[tuple(d)])) for d in digits]
    assert np.allclose(good[back], p) and np.mean((good[back] > 0.5) == truth) > 0.9 and chance.shape == (2, len(LABELLERS), 3)


def test_scorer_against_its_features(docs, spark):
    texts = pa.RecordBatch.from_pydict({
        "id": pa.array(range(5), pa.int64()), "tag": pa.array(range(5), pa.int64()),
        "text": pa.array(["", "Some words, here.", "$$ ## AAA BBB", "one one one one", "a"])
    })
    weights = np.random.default_rng(2).normal(size=BUCKETS + 1)

    class Shared:
        value = weights

    got = next(_scored(Shared)(iter([texts]))).column("p_good").to_pylist()
    rows = next(_sampled(iter([texts])))
    for p, b, w in zip(got, rows.column("buckets").to_pylist(), rows.column("weights").to_pylist(), strict=True):
        score = sum(weights[i] * x for i, x in zip(np.frombuffer(b, "<u2").tolist(), np.frombuffer(w, "<f4").tolist(), strict=True)) + weights[-1]
        assert p == pytest.approx(1 / (1 + math.exp(-score)), rel=1e-4)
    data = [(None, "a b"), (None, "a b"), (4, None), (4, "a b")]
    same = classify_quality(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert len(same) == 4 and len({r.p_good for r in same}) == 2


def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16))
    data = [(i, [float(v) for v in x[i]]) for i in range(600)] + [(600, None), (700, [0.0] * 16), (800, [float("nan")] * 16), (900, [None] * 16)]
    got = collections.defaultdict(dict)
    for r in nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), "vec_id % 20 = 0", 10).collect():
        got[r.query_id][r.vec_id] = r.score
    found = []
    for q in range(0, 600, 20):
        s = x @ x[q]
        s[q] = -np.inf
        top = np.argsort(-s)[:10]
        found.append(len(set(top) & set(got[q])) / 10)
        assert all(v == pytest.approx(s[i]) for i, v in got[q].items())
    assert set(got) == set(range(0, 600, 20)) and np.mean(found) >= 0.9
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<double>"), "vec_id % 20 = 0").count() == 0


@pytest.mark.parametrize("n", [2000, 6000])
@pytest.mark.parametrize("kind", ["unit", "lognormal", "clustered"])
def test_nearest_where_norms_differ(spark, n, kind):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 48))
    if kind == "clustered":
        x = rng.normal(size=(60, 48))[rng.integers(0, 60, n)] + 0.6 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"unit": 1.0, "lognormal": np.exp(0.5 * rng.normal(size=(n, 1))), "clustered": np.exp(0.7 * rng.normal(size=(n, 1)))}[kind]
    got = collections.defaultdict(set)
    for r in nearest(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>"), "vec_id % 100 = 0").collect():
        got[r.query_id].add(r.vec_id)
    found = []
    for q in range(0, n, 100):
        s = x @ x[q]
        s[q] = -np.inf
        found.append(len(set(np.argsort(-s)[:20].tolist()) & got[q]) / 20)
    assert np.mean(found) >= 0.9


def test_memory_of_a_block_of_vectors():
    """Products with the pivots are taken in slices: as one matrix they are 128 MB here, and 2 GB with their copies beside them in a full block."""
    rng = np.random.default_rng(3)
    x, pivots = rng.normal(size=(8192, 16)), rng.normal(size=(2048, 16))
    tracemalloc.start()
    block = neighbours.Block(np.arange(8192), x, pivots / np.linalg.norm(pivots, axis=1, keepdims=True), 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 96 << 20 and block.size == 8192
    whole = x @ (pivots / np.linalg.norm(pivots, axis=1, keepdims=True)).T
    posted = [set(np.argsort(-row)[: neighbours.POSTED].tolist()) for row in whole[::500]]
    files = np.repeat(np.arange(2048), np.diff(block.file))
    assert [set(files[block.posted == i].tolist()) for i in range(0, 8192, 500)] == posted


def test_nearest_of_floats(spark):
    x = np.random.default_rng(6).normal(size=(400, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got, same = (nearest(d, "vec_id % 20 = 0", 5).orderBy("query_id", "rank").collect() for d in (df, df.withColumn("embedding", F.col("embedding").cast("array<double>"))))
    assert got == same and len(got) == 100 and all(r.score == pytest.approx(float(x[r.query_id].astype(float) @ x[r.vec_id].astype(float)), abs=1e-12) for r in got)


def test_nearest_with_many_copies(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1200, 16))
    x[1::3] = x[1]
    got = collections.defaultdict(list)
    for r in nearest(
        spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>"),
        "vec_id % 20 = 0 or vec_id = 4", 10
    ).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    copies, found = list(range(1, 1200, 3)), []
    for q, ids in got.items():
        s = np.round(x @ x[q], 9)
        s[q] = -np.inf
        top = np.lexsort((np.arange(1200), -s))[:10].tolist()
        found.append(len(set(top) & set(ids)) / 10)
        if q in copies:
            assert ids == [i for i in copies if i != q][:10]
    assert set(got) == {4, *range(0, 1200, 20)} and np.mean(found) >= 0.9


def test_nearest_edges(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    data = [
        (0, one, "c"), (0, one, "c"), (20, two, "c"), (5, one, "d"), (3, one, "d"), (3, one, "d"), (7, two, "e"), (None, one, "f"),
        (8, [float("inf"), 1.0], "g"), (9, [1.0], "h"), (11, [1.0, None], "i")
    ]
    got = nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>, rank string"), "vec_id % 20 = 0", 3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 1.0), (0, 2, 5, 1.0), (0, 3, 7, 0.0), (20, 1, 7, 1.0), (20, 2, 0, 0.0), (20, 3, 3, 0.0)]


def test_lm_scores(spark, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = score_documents(table, "doc_id % 7 <> 2").collect()
    held = [r for r in got if r.doc_id % 7 == 2]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert score_documents(empty, "doc_id % 7 <> 2").count() == 0


def test_lm_counts_match_brute_force(spark):
    data = [(r[0], r[1]) for r in rows()] + [(1, "One  one\tZwei"), (1, "One  one\tZwei"), (None, "only here"), (None, None), (9, "only held out " * 50)]
    got = score_documents(spark.createDataFrame(data, "doc_id long, text string").repartition(4), "doc_id % 3 <> 0").collect()
    tokens = lambda t: [*words(low(t)), None]
    count = collections.Counter(w for i, t in data if i is not None and i % 3 for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(i), len(w := tokens(t)), sum(count[x] > 0 for x in w), round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)) for i,
        t in data
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(np.isfinite(r.score) for r in got)
    nothing = score_documents(spark.createDataFrame(data[:5], "doc_id long, text string"), "false").collect()
    assert all((r.n_known, r.train_tokens) == (0, 0) and np.isfinite(r.score) for r in nothing)


def test_lm_groups_do_not_undo_each_other(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 2 = 0").select("doc_id", "text")
    scores = []
    for words_of_a_group in (1 << 22, 1 << 20):  # one group and two
        monkeypatch.setattr(lm_scoring, "GROUP_WORDS", words_of_a_group)
        held = score_documents(table, "doc_id % 7 <> 2").where("doc_id % 7 = 2").agg(F.sum("score"), F.sum("n_tokens"), F.first("train_tokens"), F.sum("base_score")).first()
        scores.append(held[0] / held[1])
        assert held[0] > held[3]
    assert held[2] > 700_000 and abs(scores[0] - scores[1]) < 0.02


def test_lm_scores_do_not_depend_on_partitions(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = ({r.doc_id: r.score for r in score_documents(table.repartition(k), "doc_id % 7 <> 2").collect()} for k in (2, 9))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-4) for i in a)


def test_lm_fits_last_words_and_ends(spark):
    rng = np.random.default_rng(8)
    train = [(7 * i, " ".join([*rng.choice(["a", "b", "c"], 300), "z"])) for i in range(400)]
    held = [(2, "a b c a b z"), (9, "a b z c a b")]
    got = {r.doc_id: r for r in score_documents(spark.createDataFrame(train + held, "doc_id long, text string"), "doc_id % 7 <> 2").collect()}
    assert got[2].base_score == pytest.approx(got[9].base_score) and got[2].score > got[9].score + 1


def test_gru_documents_in_one_lane():
    rng = np.random.default_rng(7)
    p = gru.start(np.sort(rng.integers(1, 50, 40))[::-1], 30)
    p = {k: (v + rng.normal(size=v.shape) * 0.1 if k != "bounds" else v) for k, v in p.items()}
    data, fresh = rng.integers(0, 41, (3, 6)), np.tile([True, False, True, False, False, False], (3, 1))
    source = np.where(fresh, 41, np.roll(data, 1, axis=1))
    loss = lambda q: -gru.document_scores(q, data.ravel(), np.array([0, 2, 6, 8, 12, 14, 18])).sum() / 18
    g, _ = gru._window(p, source, data, rng.normal(size=(3, gru.HIDDEN)), fresh)
    for name in gru.SHAPES:
        at = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(g[name][at], rel=2e-2, abs=1e-4)


def test_gru_gradients_and_lanes():
    rng = np.random.default_rng(6)
    p = gru.start(np.sort(rng.integers(1, 50, 40))[::-1], 30)
    p = {k: (v + rng.normal(size=v.shape) * 0.1 if k != "bounds" else v) for k, v in p.items()}
    data = rng.integers(0, 41, (3, 6))
    source = np.concatenate([np.full((3, 1), 41), data[:, :-1]], axis=1)
    loss = lambda q: -gru.document_scores(q, data.ravel(), np.arange(0, 19, 6)).sum() / 18
    g, _ = gru._window(p, source, data, np.zeros((3, gru.HIDDEN)))
    for name in gru.SHAPES:
        at = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        assert (loss(up) - loss(down)) / 2e-4 == pytest.approx(g[name][at], rel=2e-2, abs=1e-4)
    chances = sum(np.exp(gru.document_scores(p, np.array([w]), np.array([0, 1])))[0] for w in range(41))
    assert chances == pytest.approx(1.0, abs=1e-4)


def test_gru_long_documents_are_fitted_in_even_lanes(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = np.array([9000, *rng.integers(20, 300, 400), 5000])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = rng.integers(0, 41, offsets[-1]).astype(np.int32)
    p = gru.start(np.sort(rng.integers(1, 50, 40))[::-1], 30)
    seen, window = [], gru._window
    monkeypatch.setattr(gru, "_window", lambda p, source, target, *a: seen.append(target[target >= 0]) or window(p, source, target, *a))
    gru.train(p, iter([(words, offsets)]))
    assert len(seen) < 80 and (np.bincount(np.concatenate(seen)) == np.bincount(words)).all()  # 282 windows where a document keeps to its lane
    # A stretch goes on from the state after all words before it.
    document, place = gru._stretches(sizes, 2048)
    assert place.max() == 8192 and len(place) == len(sizes) + 4 + 2
    states = gru._states_before(p, words, offsets, document, place, 2048)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for d in (0, len(sizes) - 1):
        h, last = np.zeros(gru.HIDDEN), len(p["embed"]) - 1
        for t, word in enumerate(words[offsets[d] : offsets[d + 1]]):
            for i in np.flatnonzero((document == d) & (place == t)):
                assert np.abs(states[i] - h).max() < 1e-4
            x, u = p["embed"][last] @ p["wx"] + p["b"], h @ p["wh"]
            z, r = np.split(sigmoid(x[: 2 * gru.HIDDEN] + u[: 2 * gru.HIDDEN]), 2)
            h, last = z * h + (1 - z) * np.tanh(x[2 * gru.HIDDEN :] + r * u[2 * gru.HIDDEN :]), word


def test_gru_windows_use_their_memory_again(monkeypatch):
    rng = np.random.default_rng(4)
    sizes = rng.integers(20, 300, 3000)
    words = rng.integers(0, 2001, sizes.sum()).astype(np.int32)
    fresh, window = [], gru._window

    def measured(p, source, target, *a):
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        out = window(p, source, target, *a)
        fresh.append((tracemalloc.get_traced_memory()[1] - before) / target.size)
        return out

    monkeypatch.setattr(gru, "_window", measured)
    tracemalloc.start()
    try:
        gru.train(gru.start(np.arange(2000, 0, -1), 30), iter([(words, np.concatenate([[0], np.cumsum(sizes)]))]))
    finally:
        tracemalloc.stop()
    assert len(fresh) > 60 and np.median(fresh) < 600  # bytes a word; 320, and 2,035 where every window takes new arrays


def test_gru_logits_far_from_0():
    rng = np.random.default_rng(3)
    p = gru.start(np.sort(rng.integers(1, 50, 40))[::-1], 30)
    p = {k: (v + rng.normal(size=v.shape) * (200 if k in ("bc", "bo", "wc", "wo") else 0.3) if k != "bounds" else v) for k, v in p.items()}
    words, bounds = rng.integers(0, 41, 50), p["bounds"]
    log_sum = lambda x: x.max() + np.log(np.exp(x - x.max()).sum())
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, last, want = np.zeros(gru.HIDDEN), 41, 0.0
    for word in words:
        x, u = p["embed"][last] @ p["wx"] + p["b"], h @ p["wh"]
        z, r = np.split(sigmoid(x[: 2 * gru.HIDDEN] + u[: 2 * gru.HIDDEN]), 2)
        h, last = z * h + (1 - z) * np.tanh(x[2 * gru.HIDDEN :] + r * u[2 * gru.HIDDEN :]), word
        c = np.searchsorted(bounds, word, side="right") - 1
        classes, own = h @ p["wc"] + p["bc"], p["wo"][bounds[c] : bounds[c + 1]] @ h + p["bo"][bounds[c] : bounds[c + 1]]
        want += classes[c] - log_sum(classes) + own[word - bounds[c]] - log_sum(own)
    assert gru.document_scores(p, words, np.array([0, 50]))[0] == pytest.approx(want, rel=1e-6)
    g, _ = gru._window(p, np.array([[41, *words[:-1]]]), words[None], np.zeros((1, gru.HIDDEN)))
    assert all(np.isfinite(g[n]).all() for n in gru.SHAPES) and abs(g["bc"].sum()) < 1e-9
