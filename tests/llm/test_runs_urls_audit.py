"""Periodic runs, URL rules and the filter audit against brute force, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelwise.llm import url_filters
from panelwise.llm.filter_audit import audit_documents
from panelwise.llm.periodic_runs import periodic_runs, run_digests, runs, runs_of_texts, stretches_with_runs, suffix_tree, with_planted_runs
from panelwise.llm.textkernel import Words
from panelwise.llm.url_filters import PAGE_RULES, filter_urls


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def brute_runs(s, least=6, times=4):
    codes, found = np.unique(np.array(s, object).astype(str), return_inverse=True)[1] if len(s) else np.zeros(0, int), []
    for q in range(1, len(s) // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], codes[q:] == codes[:-q], [0]])))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            own = codes[i : j + q]
            if len(own) >= max(least, times * q) and not any(np.array_equal(own[r:], own[:-r]) for r in range(1, q)):
                found.append((i, len(own), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rng, symbols, n):
    s = [rng.choice(symbols) for _ in range(n)]
    if n and rng.random() < 0.6:
        p, a = rng.randint(1, max(1, n // 4)), rng.randint(0, n // 3)
        s = s[:a] + [s[a + (i - a) % p] for i in range(a, n)]
    return s


def test_suffix_tree_holds_every_suffix():
    s = [*"mississippi", "$"]
    codes = [sorted(set(s)).index(c) for c in s]
    start, end, child, width = suffix_tree(codes)
    n = len(s)
    for i in range(n):
        node, at = n, i
        while node >= n:
            node = child[node * width + codes[at]]
            stop = end[node - n] if node > n else n
            assert codes[start[node] : stop] == codes[at : at + stop - start[node]]
            at += stop - start[node]
        assert (node, at) == (i, n)


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (10, 3)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(5)
    for _ in range(300):
        s = periodic(rng, range(1, rng.randint(2, 5)), rng.randint(0, 50))
        assert runs(np.array(s, np.int64), least, times) == brute_runs(s, least, times)


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (10, 3)])
def test_stretches_lose_no_run(least, times):
    rng = random.Random(6)
    for _ in range(60):
        texts = [periodic(rng, [f"w{i}" for i in range(rng.randint(1, 60))], rng.randint(0, 150)) for _ in range(rng.randint(0, 6))]
        own = Words(pa.array([" ".join(t) for t in texts], pa.string()), lower=False)
        found, text = runs_of_texts(own, least, times)
        assert [[tuple(r) for r, d in zip(found.tolist(), text.tolist(), strict=True) if d == i] for i in range(len(texts))] == [brute_runs(t, least, times) for t in texts]
        first, end = stretches_with_runs(own.hash, own.offsets, least, times)
        assert all(b <= a for a, b in zip(first[1:], end[:-1], strict=True))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, runs string, w int, h int, text_ string"


def documents():
    rng = random.Random(8)
    names = [f"n{i}" for i in range(300)]
    out = [None, "", " \t\n", "one", "a a a a a a", "a b a b a b a b", "a b a b a b a b a", "x x x x x", "é é é é é é\x0bz"]
    out += [" ".join(periodic(rng, names[: rng.randint(1, 300)], rng.randint(1, 400))) for _ in range(80)]
    out += ["  ".join(periodic(rng, names[:3], 60)), " ".join(names * 40), "boiler plate line\n" * 1500]
    rows = [(3 * i + 1, t) for i, t in enumerate(out)] + [(None, "a a a a a a a"), (None, None), (4, "one"), (4, "one")]
    return [(i, t, "en", None, 0, k, "r", 1, 2, "t") for k, (i, t) in enumerate(rows)]


def planted(i, text):
    w, h = words(text), zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]


def test_periodic_runs_of_documents(spark):
    want = []
    for row in documents():
        w = planted(*row[:2])
        found = brute_runs(w)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((row[0], len(found), *(best or (None,) * 3), best and best[1] * 1000 // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))))
    docs = spark.createDataFrame(documents(), DOCS).repartition(5)
    got = run_digests(periodic_runs(with_planted_runs(docs)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(1 for r in want if r[1]) > 30 and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in want)
    assert run_digests(periodic_runs(with_planted_runs(docs.limit(0)))).count() == 0


PAGES = "page_id long, url string, html string, host string, path string, rule string, verdict string, key string, id int, kind int, tie int"


def pages(hosts):
    rng = random.Random(3)
    urls = [None, "", "no scheme", "https://", "https://?x", "http://com", "http://COM/", "HTTP://Example.COM/en/a?b=://net/es/", "://net/es/", "http://net/es", "http://net#/es/"]
    urls += ["https://www.example.com/en/x", "https://notexample.com/en/x", "https://a.www.example.com/en/", "http://example.com./en/", "http://.com/x", "http://..net/fr/\nq", "https://é.net/fr/é"]
    urls += [f"https://{rng.choice(hosts)}/{rng.choice(['', 'en/', 'es/', 'fr/x', 'en/en/deep/'])}{rng.randint(0, 9)}" for _ in range(600)]
    urls += [f"http://hot.example.net/es/{i % 7}" for i in range(400)]
    return [(k if k % 50 else None, u, "<p>", "h", "p", "r", "v", "k", 1, 2, 3) for k, u in enumerate(urls)]


def judged(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host, path = "", ""
    if rest is not None:
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + (p or "")), len(h), v, h + (p or "")) for h, p, v in rules if h is not None and (h in ("", host) or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("rows", [1 << 20, 40])
def test_url_rules(spark, monkeypatch, rows):
    monkeypatch.setattr(url_filters, "RANGE_ROWS", rows)
    labels, rng = ["com", "net", "example", "www", "a", "b", "en"], random.Random(9)
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    data = pages(hosts)
    df = spark.createDataFrame(data, PAGES).repartition(4)
    many = [(h, rng.choice(["", "/", "/en/", "/en/en/", "/es/", "/fr/x"]), rng.choice(["allow", "block"])) for h in rng.choices(hosts, k=50)]
    many += [(None, "/", "block"), ("net", None, "allow"), ("example.com", "/en/", "allow"), ("example.com", "/en/", "block")]
    for rules in (PAGE_RULES, many, [*many, ("", "", "block")], []):
        known = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = filter_urls(df, known).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(str((r[0], *judged(r[1], rules, "allow"))) for r in data)
    assert filter_urls(df.limit(0), spark.createDataFrame(PAGE_RULES, "host string, path string, verdict string")).count() == 0


AUDIT = "doc_id long, text string, lang string, source string, n_chars long, id long, digest string, part string, n int, pattern int, A int, good int"


def audited():
    rng = random.Random(2)
    names = [f"w{i}" for i in range(500)]
    long = [" ".join(rng.sample(names, 220)) for _ in range(4)]
    texts = [None, "", *long, long[0], long[1], "CAPITALS ARE HERE", "short # text", " ".join(names[:50] * 9), "X" * 30 + " " + long[2], long[3] + " | 100%", "a " * 90_000]
    rows = [(rng.randint(1, 40), t) for t in texts * 3] + [(None, t) for t in texts] + [(7, long[0]), (7, long[0])]
    return [(i, t, "en", rng.choice([None, "", "web", "books"]), 0, k, "d", "p", 1, 2, 3, 4) for k, (i, t) in enumerate(rows)]


def test_filter_audit(spark):
    rng = random.Random(4)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 40, 2)] + [(None, 1, 1), (7, 0, 0), (7, 1, None)]
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, *_ in audited():
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = collections.defaultdict(list)
    for i, t, _, source, *_ in audited():
        w, t = words(t), t or ""
        fails = {x for x, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search("[#$%&*|]", t), i is not None and least[t] < i), strict=True) if bad}
        parts[source or ""].append((fails, i in good, i in toxic))
    want, shapley = {}, collections.Counter()
    for part, own in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                removed = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                failing = [d for d in own if x in d[0]]
                want[part, order, step] = [len(left), len(removed), len(failing) - len(removed), sum(d[0] == {x} for d in own), sum(d[1] for d in removed), sum(d[2] for d in removed)]
                shapley[part, x] += len(removed)
    docs = spark.createDataFrame(audited(), AUDIT).repartition(4)
    table = spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, part int")
    got = audit_documents(docs, table)
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got.collect()} == {k: [*v, shapley[k[0], k[1][k[2] - 1]]] for k, v in want.items()}
    assert got.count() == len(want) and len(want) == 600 * 3
    assert audit_documents(docs.limit(0), table).count() == 0 and audit_documents(docs, table.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
