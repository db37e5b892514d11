"""Jaccard join, components, mixing and toxicity against brute force and held-out rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from malgeul.llm import graph, jaccard, mixture, toxicity

DOC = "doc_id long, text string"


def brute(rows):
    """(doc_id, n, component) by comparing all pairs of sets of words."""
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        i, x = sets[a]
        for j, y in sets[a + 1 :]:
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(i), find(j)))
                up[q] = p
    return sorted((i, len(s), find(i)) for i, s in sets)


def planted(rng, n=260):
    """Families of copies with edits about the limit, a passage that many share, and short texts."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))
    passage = [word() for _ in range(60)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(rng.choice([1, 3, 5, 6, 8, 9, 12, 20, 40, 70, 130, 300, 700]))]
        if rng.random() < 0.3:
            base[len(base) // 2 : len(base) // 2] = passage
        out.append(base)
        for _ in range(rng.choice([0, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                k = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.5:
                    copy[k] = word()
                elif kind < 0.75 and len(copy) > 1:
                    del copy[k]
                else:
                    copy.insert(k, word())
            out.append(copy)
    rng.shuffle(out)
    return [(i, rng.choice([" ", "\n", "\t "]).join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_link_equals_brute_force(spark, seed):
    rows = planted(random.Random(seed)) + [(9000, None), (9001, ""), (9002, " \n"), (9003, "One two"), (9004, "one TWO"), (9005, "one\xa0two")]
    got = sorted(tuple(r) for r in jaccard.link(spark.createDataFrame([(*r, 1, "x") for r in rows], DOC + ", node int, n string")).collect())
    assert got == brute(rows)
    assert len({c for *_, c in got}) < len(rows) - 50


def test_link_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert sorted(tuple(r) for r in jaccard.link(docs).collect()) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_link_odd_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (None, "p q r s t u v w"), (5, text), (5, text), (7, "k l m n o p q"), (7, "p q r s t u v w"), (None, None), (3, "k l m n o p q"), (-(2**63), "only here"), (None, "and only here")]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, DOC)).collect())
    # rows are linked by their texts, not by ids that they share
    assert got == Counter({(None, 4, 5): 1, (5, 4, 5): 2, (None, 4, 7): 1, (7, 3, 3): 1, (7, 4, 7): 1, (3, 3, 3): 1, (None, 0, None): 1, (-(2**63), 1, -(2**63)): 1, (None, 1, None): 1})
    assert jaccard.link(spark.createDataFrame([], DOC)).count() == 0
    named = spark.createDataFrame([("b", text), ("a", text), ("c", "x")], "doc_id string, text string")
    assert sorted(tuple(r) for r in jaccard.link(named).collect()) == [("a", 4, "a"), ("b", 4, "a"), ("c", 1, "c")]


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_links_by_elements(spark, monkeypatch, few):
    """The way of sets that segments cannot tell apart, for all sets."""
    rows = planted(random.Random(3), 120)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", few)
    docs = spark.createDataFrame(rows, DOC)
    sets = jaccard.set_table(docs).filter("n > 0").cache()
    classes = sets.groupBy(F.col("lo").alias("node")).agg(F.min("doc_id").alias("doc_id"))
    links = [(r["a"], r["b"]) for r in jaccard._links_by_elements(docs, classes, classes.select("node"), 1).collect()]
    words = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w := t.split()) >= 5 else {tuple(w)} for i, t in rows}
    name, ids = {r["doc_id"]: r["lo"] for r in sets.collect()}, sorted(words)
    want = {tuple(sorted((name[i], name[j]))) for i in ids for j in ids if i < j and name[i] != name[j] and 100 * len(words[i] & words[j]) >= 80 * len(words[i] | words[j])}
    assert len(links) == len(set(links)) and set(links) == want and len(want) > 20


def test_common_keys_are_dealt_to_all_buckets():
    """Packed signatures give the shared ones back, whether a key is common or not, and whatever sets arrays have in common."""
    rng = np.random.default_rng(0)
    keys = rng.integers(-(2**63), 2**63, 300, dtype=np.int64)
    kept, everything, arrays = None, set(), []
    for _ in range(4):
        los = np.unique(rng.integers(-(2**63), 2**63, 60, dtype=np.int64))
        who, key = rng.integers(0, 60, 900), keys[rng.zipf(1.2, 900) % 300]
        slot = rng.integers(2, 20, 900) << jaccard._BAND | rng.integers(0, 2, 900) << jaccard._D | rng.integers(0, 9, 900)
        _, once = np.unique(np.stack([key, who]), axis=1, return_index=True)
        key, who, slot = key[once], who[once], slot[once]
        if kept:  # the first sets are those of the array before
            los[:5], use = kept[0], who >= 5
            key, who, slot = (np.concatenate([a[use], b]) for a, b in zip((key, who, slot), kept[1:], strict=True))
        first = who < 5
        kept = (los[:5].copy(), key[first], who[first], slot[first])
        everything |= set(zip(key.tolist(), los[who].tolist(), slot.tolist(), strict=True))
        arrays.append((key, who, slot, los))
    by_key = defaultdict(set)
    for key, lo, slot in everything:
        by_key[key].add((lo, slot))
    want = Counter(len(v) for v in by_key.values() if len({lo for lo, _ in v}) > 1 and not all(s >> jaccard._D & 1 for _, s in v) for _ in v)
    for limit in (64, 3):
        before, jaccard.COMMON_KEY = jaccard.COMMON_KEY, limit
        try:
            table = pa.Table.from_batches([jaccard._pack(*a, 7, 240) for a in arrays])
        finally:
            jaccard.COMMON_KEY = before
        found = defaultdict(set)
        for b in range(7):
            for r in jaccard._shared_of(table.filter(pa.compute.equal(table["bucket"], b))).to_pylist():
                found[r["key"]].add((r["node"], r["slot"]))
        assert Counter(len(v) for v in found.values() for _ in v) == want


def test_large_near_copy_group(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = {(r["n_shingles"] > 0, r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {(True, c) for *_, c in brute(rows)}


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 8, 9, 31, 32, 33, 100, 1000, 5000])
def test_bands_cover_every_pair(n):
    for m in range(n, n * 5 // 4 + 1):
        if n >= 4:
            both = set(jaccard.bands(n)) & set(jaccard.bands(m))
            g = n.bit_length() - 1
            assert g in both
            # the difference of a linked pair is within what either allows
            limit = 20 * (n + m) // 180
            assert jaccard.differing(n, g) >= limit and jaccard.differing(m, g) >= limit
            assert jaccard.layout(g)[0] >= max(jaccard.differing(n, g), jaccard.differing(m, g)) + 1


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(999, 999)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        up[q] = p
    rows = [(r["node"], r["label"]) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert dict(rows) == {x: find(x) for x in up} and len(rows) == len(up)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- mixing ----


def expected_targets(sizes, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    left, target, free = share * sum(sizes.values()), {}, list(names)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total >= most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_mix(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 200, 900]))), rng.choice(["a", "b", "b", "b", "Z", "é", None])) for i in range(3000)]
    rows += [(1, "w w", "b")] * 3 + [(None, "w w w", None), (3001, None, "b"), (3002, "big " * 20000, "a"), (3003, "", "void")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOC + ", source string, size int")
    monkeypatch.setattr(mixture, "LEAF", 100)
    monkeypatch.setattr(mixture, "FAN", 4)
    got = mixture.mix(docs)
    out = got.collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = expected_targets(dict(sizes))
    for s in sizes:
        own = [r for r in mixed_rows(out, rows) if r[0] == s]
        assert all(abs(r[2] - want[s]) < 1e-6 and r[1] == sizes[s] for r in own)
        assert abs(sum(r[3] for r in own) - want[s]) <= max(64, 0.01 * want[s]), s
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in out)
    assert sorted(map(str, out)) == sorted(map(str, mixture.mix(docs.repartition(7)).collect()))
    copies = mixture.apply_mix(docs, got)
    assert copies.columns == docs.columns and copies.count() == sum(r["copies"] for r in out)
    assert mixture.mix(docs.limit(0)).count() == 0


def mixed_rows(out, rows):
    return [(r["source"], r["source_size"], r["target"], r["taken"]) for r in out]


def test_settle_keeps_words_and_means():
    rng = random.Random(7)
    rows = [(rng.randint(1, 50), rng.random()) for _ in range(40)]
    total = sum(s * q for s, q in rows)
    mean = np.zeros(40)
    for _ in range(3000):
        p, i = mixture.settle(rows, lambda *_: rng.random())
        assert abs(sum(s * q for (s, _), q in zip(rows, p, strict=True)) - total) < 1e-6
        assert all(q in (0.0, 1.0) for k, q in enumerate(p) if k != i)
        mean += p
    assert abs(mean / 3000 - np.array([q for _, q in rows])).max() < 0.05
    assert mixture.settle([], None) == ([], None) and mixture.settle([(0, 0.5)], None)[0] == [0.0]


# ---- toxicity ----


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 3, (2000, 3))
    s = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=2000)
    y = (s > 0.5).astype(int) + (s > 2.5)
    rows = [[(f, int(v)) for f, v in enumerate(r) if v] for r in x]
    model = toxicity.fit(toxicity.design_of(rows), y.tolist(), ["a", "b", "c"], ridge=1e-5, steps=800)
    assert abs(model.weights["a"] - 2) < 0.25 and abs(model.weights["b"] + 1) < 0.25 and abs(model.weights.get("c", 0)) < 0.2
    assert abs(model.thresholds[0] - 0.5) < 0.3 and abs(model.thresholds[1] - 2.5) < 0.3
    above = model.above(1.0)
    assert above[0] > above[1] and toxicity.fit(toxicity.design_of([]), [], []).above(0)[0] < 0.01


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    scored = toxicity.score(docs.join(labels.filter("doc_id % 2 = 1"), "doc_id"), model)
    hit, miss, alarm, clean = (scored.filter(q).count() for q in ("toxic = 1 and grade > 0", "toxic = 1 and grade = 0", "toxic = 0 and grade > 0", "toxic = 0 and grade = 0"))
    print(hit, miss, alarm, clean)
    assert hit / (hit + miss) > 0.88 and alarm / (alarm + clean) < 0.005


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (1, None, 9), (None, "", 9), (2, "so nasty " * 5000, 9), (3, "fine", 9)], DOC + ", grade int")
    labels = spark.createDataFrame([(2, 1), (3, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert scored.count() == 5 and scored.columns == ["doc_id", "text", "expected_severity", "grade"]
    for empty in (labels.limit(0), labels.filter("toxic = 1")):
        assert toxicity.score(docs, toxicity.train(docs, empty)).filter("grade > 0").count() in (0, 5)
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels)).count() == 0
