"""The pipeline's stages against brute force."""

import collections
import re
import time

import numpy as np
import pytest

import corpus_pipeline as pipeline
from panelwise.llm import scratch
from panelwise.llm.quality import classify_quality

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, tag long, row string, words long"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def rows():
    rng = np.random.default_rng(12)
    vocabulary = [f"word{i}" for i in range(3000)]
    out = []
    for i in range(60):
        text = " ".join(rng.choice(vocabulary, int(rng.integers(30, 200))))
        out.append((2 * i + 1, text))
        if i % 5 == 0:
            own = text.split(" ")
            own[7] = "edited"
            out += [(2 * i + 2, " ".join(own)), (2 * i + 1, text), (None, text)]
        if i % 7 == 0:
            out.append((1000 + i, " ".join([*rng.choice(vocabulary, 90), *(f"p{k}" for k in range(60)), *rng.choice(vocabulary, 40)])))
    out += [(None, None), (3000, ""), (3000, ""), (3001, " \t"), (None, "only one of these"), (None, "only one of these"), (4000, "#### $$$ %%% " * 40)]
    return [(i, t, "en", ["a", "b", None, "hot", "hot"][k % 5], len(t or ""), k, 0, "r", 1) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def key(row):
    return str(tuple(row))


def test_quality(spark, docs):
    kept = collections.Counter((r.doc_id, r.keep) for r in classify_quality(docs).collect())
    got = pipeline.quality(spark, docs, "")
    assert got.columns == docs.columns and got.count() == sum(n for (_, keep), n in kept.items() if keep)
    assert set(map(key, got.collect())) <= set(map(key, docs.collect()))


def test_near_duplicates(spark, docs):
    grams = lambda t: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words((t or '').translate(LETTERS))) else None
    left = sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0))
    stay, groups = [], []
    for r in left:
        own = grams(r[1])
        if own is None:
            stay.append(r)
            continue
        met = [g for g in groups if any(100 * len(own & x) >= 80 * len(own | x) for x in g)]
        groups = [g for g in groups if g not in met] + [sum(met, []) + [own]]
        if not met:
            stay.append(r)
    got = pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(r[0]), str(r[1])) for r in stay)


def test_repeated_passages(spark, docs):
    first = {}
    for i, t in sorted((r[0], r[1]) for r in rows() if r[0] is not None and r[1]):
        w = words(t)
        for s in range(len(w) - 49):
            first.setdefault(tuple(w[s : s + 50]), i)
    want = []
    for r in rows():
        w, gone = words(r[1]), set()
        for s in range(len(w) - 49):
            if r[0] is not None and first[tuple(w[s : s + 50])] < r[0]:
                gone.update(range(s, s + 50))
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r[1]
        want.append(str((r[0], text, *r[2:4], len(text or ""), *r[5:])))
    got = pipeline.repeated_passages(spark, docs, "")
    assert got.columns == docs.columns and sorted(map(key, got.collect())) == sorted(want)


def test_mixing(spark, docs):
    got = pipeline.mixing(spark, docs, "")
    size, source = collections.Counter(), collections.Counter()
    for r in rows():
        source[r[3]] += len(words(r[1]))
    for r in got.collect():
        size[r.source] += len(words(r.text))
        assert r.n_chars == len(r.text or "")
    total, weight = 1.5 * sum(source.values()), dict(zip(sorted(s for s in source if s) + [None], (5, 2, 1, 5), strict=True))
    target, capped = {}, set()
    while len(target) < len(source):
        open_ = [s for s in source if s not in capped]
        share = (total - sum(2 * source[s] for s in capped)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 2 * source[s]}
        target = {s: 2 * source[s] for s in capped} | ({} if over else {s: share * weight[s] for s in open_})
        capped |= over
    assert got.columns == docs.columns and all(abs(size[s] - target[s]) < 2 for s in source)


def test_run_and_empty_tables(spark, docs, tmp_path):
    columns = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, table in (("full", columns), ("empty", columns.limit(0))):
        table.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
    got = pipeline.run(spark, f"file://{tmp_path}/full").collect()
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    assert got and all(sum(n for _, n in own) <= 2048 for own in bins.values())
    assert {r.doc_id for r in got} <= {r[0] for r in rows()} and not any(r.doc_id == 4000 for r in got)
    assert pipeline.run(spark, f"file://{tmp_path}/empty").count() == 0


def test_stages_leave_neither_shuffle_files_nor_tables_of_their_way(spark, docs):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    def tables():
        path = spark._jvm.org.apache.hadoop.fs.Path(scratch._own(spark))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return {str(x.getPath().getName()) for x in files.listStatus(path)} if files.exists(path) else set()

    before = shuffled()
    scratch.stored(spark.range(1000).repartition(4, "id"))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(scratch.SHUFFLES_GO, None) is None
    for stage, most in ((pipeline.near_duplicates, 4), (pipeline.repeated_passages, 2)):  # what the lazy result still reads
        known = tables()
        got = stage(spark, docs, "")
        assert len(tables() - known) <= most and got.count()
