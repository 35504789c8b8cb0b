"""Near duplicates, decontamination, sharding and components against plain Python."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roomtrace.llm import decontaminate as D, ngram_join as N, packing as P
from roomtrace.llm.graphs import components
from roomtrace.session import work_dir

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = [f"w{i}" for i in range(4000)]


def words(text):
    return WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def corpus(seed, originals, copies, size=60):
    """Texts of which some are exact, some near copies of others."""
    rnd = random.Random(seed)
    out = []
    for _ in range(originals):
        text = rnd.choices(VOCABULARY, k=size)
        for _ in range(rnd.randint(1, copies)):
            own = list(text)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                own[rnd.randrange(size)] = rnd.choice(VOCABULARY)
            out.append(" ".join(own))
    rnd.shuffle(out)
    return out


def brute_classes(texts):
    sets = [shingles(t) for t in texts]
    near = [
        {j for j in range(len(sets)) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
        for i in range(len(sets))
    ]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        todo, seen = [i], {i}
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root[i] = min(seen)
    sizes = Counter(root)
    return {i: (root[i], len(near[i]), sizes[root[i]]) for i in range(len(sets))}


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("lang", F.lit("x"))


def test_joined_like_brute_force(spark):
    texts = corpus(1, 60, 6) + ["short one", "short one", "a", "", None, "A!", " ".join(["same"] * 500)]
    got = {r.doc_id: (r.class_id, r.n_links, r.class_size) for r in N.join(docs(spark, texts)).collect()}
    assert got == brute_classes(texts)


def test_a_large_group_of_distinct_near_copies(spark, monkeypatch):
    # Several blocks and buckets of several blocks.
    monkeypatch.setattr(N, "BLOCK_NODES", 32)
    monkeypatch.setattr(N, "BUCKET_ROWS", 16)
    rnd = random.Random(4)
    base = rnd.choices(VOCABULARY, k=200)
    texts = []
    for _ in range(150):
        own = list(base)
        for _ in range(rnd.choice([1, 2, 3, 5])):
            own[rnd.randrange(200)] = rnd.choice(VOCABULARY)
        texts.append(" ".join(own))
    got = {r.doc_id: (r.class_id, r.n_links, r.class_size) for r in N.join(docs(spark, texts)).collect()}
    assert got == brute_classes(texts)


def test_one_of_each_class_stays(spark, odd, empty):
    texts = corpus(2, 30, 5)
    df = docs(spark, texts)
    left = N.keep(df)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {c for c, _, _ in brute_classes(texts).values()}
    # Copies 4 and 5, and the row that is there twice.
    assert sorted(str(r.doc_id) for r in N.keep(odd).collect()) == sorted("1 2 3 4 None 7 8 9 10".split())
    assert N.keep(empty).count() == 0 and N.join(empty).count() == 0
    assert N.join(odd).count() == odd.count()


def test_depth_reaches_the_recall():
    d = N.depth()
    assert 1 - (1 - 0.8**d) ** N.TREES >= N.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** N.TREES


def test_shared_counts():
    rnd = np.random.default_rng(0)
    sets = [np.unique(rnd.integers(0, 50, rnd.integers(0, 40))).astype(np.uint64) for _ in range(20)]
    got = N.shared_counts(sets, width=8)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(50)]
    root = {v: v for e in edges for v in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    alone = {a for a, b in edges if a == b and not any((x == a) != (y == a) for x, y in edges)}
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.root for r in components(df).collect()} == {v: r for v, r in root.items() if v not in alone}
    assert components(df.limit(0)).count() == 0


# --- decontamination -----------------------------------------------------------------


def brute_hits(text, items, size=13):
    w = words(text)
    hit, found = set(), set()
    for name, item in items:
        v = words(item)
        for k in range(max(1, len(v) - size + 1)) if v else ():
            part = v[k : k + size]
            for s in range(len(w) - len(part) + 1):
                if w[s : s + len(part)] == part:
                    hit |= set(range(s, s + len(part)))
                    found.add("null" if name is None else str(name))
    return len(w), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, odd):
    rnd = random.Random(9)
    small = VOCABULARY[:30]
    items = [(i, " ".join(rnd.choices(small, k=k))) for i, k in enumerate([1, 2, 5, 13, 14, 20, 40, 40])]
    items += [(10, None), (11, "..."), (None, items[4][1]), (3, items[5][1]), (3, items[3][1])]
    texts = [" ".join(rnd.choices(small, k=rnd.randrange(60))) for _ in range(60)]
    texts += [f"{t[:20]}, {items[6][1].upper()}! {t}" for t in texts[:10]] + [items[7][1] + " " + items[4][1]] * 2
    df = docs(spark, texts).select("doc_id", "text").unionByName(odd.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    folder = work_dir(spark, "i")
    D.build(df, folder, segment=200)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((str(r.key), r.n_words, r.n_hit, r["items"]) for r in D.verdicts(D.search(spark, folder, table)).collect())
    want = sorted((str(r.doc_id), *brute_hits(r.text, items)) for r in df.collect())
    assert got == want


def test_items_in_blocks(spark, monkeypatch):
    texts = ["alpha beta gamma", "beta gamma delta epsilon"]
    folder = work_dir(spark, "i")
    D.build(docs(spark, texts), folder)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["beta gamma", "delta", "alpha beta", "zeta"])], "item_id bigint, text string")
    whole = D.verdicts(D.search(spark, folder, items)).select("key", "n_hit", "items").orderBy("key").collect()
    monkeypatch.setattr(D, "BLOCK_BYTES", 8)
    parts = D.verdicts(D.search(spark, folder, items)).select("key", "n_hit", "items").orderBy("key").collect()
    assert whole == parts and [r.n_hit for r in whole] == [3, 3]


def test_proximity(spark):
    folder = work_dir(spark, "i")
    D.build(docs(spark, ["a big b c", "a b other words c", "c a b"]), folder)
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    near = {s: sorted(r.key for r in D.search(spark, folder, items, slop=s).collect() if r.matches) for s in (0, 1, 2)}
    assert near == {0: [], 1: [0], 2: [0, 1, 2]} or near == {0: [], 1: [0], 2: [0, 1]}


def test_contaminated_documents_go(spark, odd, empty):
    item = " ".join(VOCABULARY[:20])
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    df = docs(spark, [item, item + " x" * 600, "clean"])
    assert sorted(r.doc_id for r in D.keep(df, items).collect()) == [1, 2]
    assert D.keep(df, items).columns == df.columns
    assert D.keep(odd, items).count() == odd.count() and D.keep(empty, items).count() == 0
    assert D.keep(odd, items.limit(0)).count() == odd.count()


# --- sharding --------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60), st.integers(60, 120))
def test_best_fit_decreasing(sizes, capacity):
    free = []
    want = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(f, s) for s, f in enumerate(free) if f >= sizes[i]]
        if fits:
            s = min(fits)[1]
        else:
            s = len(free)
            free.append(capacity)
        free[s] -= sizes[i]
        want[i] = s
    assert P.pack(sizes, capacity) == want


def test_many_shards():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 50) for _ in range(5000)]
    shards = P.pack(sizes, 60)
    load = Counter()
    for s, x in zip(shards, sizes):
        load[s] += x
    assert max(load.values()) <= 60 and len(load) <= 1.1 * sum(sizes) / 60 + 1


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 200)), max_size=120))
def test_free_space(steps):
    tree, plain = P.FreeSpace(), []
    for n, (size, free) in enumerate(steps):
        fits = [e for e in plain if e[0] >= size * 4]
        assert tree.take_tightest(size * 4) == (min(fits) if fits else None)
        if fits:
            plain.remove(min(fits))
        tree.add((free, n))
        plain.append((free, n))


def brute_even(sizes, shards):
    """Loads of the shards: groups above their share alone, then item by item best fit with the least capacity that does."""
    rest, loads = sorted(sizes, reverse=True), []
    while rest and len(loads) < shards - 1 and rest[0] * (shards - len(loads)) > sum(rest):
        loads.append(rest.pop(0))
    left = shards - len(loads)
    capacity = max(-(-sum(rest) // left), max(rest, default=0))

    def fit(capacity):
        free = []
        for x in rest:
            fits = [(f, s) for s, f in enumerate(free) if f >= x]
            if not fits and len(free) == left:
                return None
            if not fits:
                free.append(capacity)
            free[min(fits)[1] if fits else -1] -= x
        return [capacity - f for f in free]

    while fit(capacity) is None:
        capacity += 1
    return sorted(loads + fit(capacity))


def test_whole_assignment_of_a_thousand_groups(spark):
    rnd = random.Random(6)
    texts = [f"{i} " + "x" * rnd.choice([1, 1, 5, 5, 5, 30, 31, 200, 900, rnd.randrange(3000)]) for i in range(1000)]
    texts += [t for t in texts[:300] for _ in range(rnd.randrange(4))]
    got = Counter()
    for r in P.shard(docs(spark, texts), 7).collect():
        got[r["shard"]] += r["size"]
    sizes = Counter()
    for t in texts:
        sizes[t] += len(t) + 1
    assert sorted(got.values()) == brute_even(list(sizes.values()), 7)


def check_shards(rows, shards=16):
    by_text, slots, load = defaultdict(set), defaultdict(list), Counter({s: 0 for s in range(shards)})
    for r in rows:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(load) == set(range(shards))
    return load


def test_sharding_query(answer, texts):
    rows = answer("op6_sharding")
    assert {r["doc_id"] for r in rows} == set(texts) and {r["law"] for r in rows} == {"bytes"}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in rows)
    load = check_shards(rows)
    largest = max(Counter({r["text_crc32"]: r["size"] for r in rows}).values())
    assert max(load.values()) - min(load.values()) <= largest


def test_a_third_in_one_text(spark):
    texts = ["hot " * 50] * 200 + [f"text {i} " * 10 for i in range(400)]
    rows = [r.asDict() for r in P.shard(docs(spark, texts)).collect()]
    load = check_shards(rows)
    rest = sorted(load.values())[:-1]
    assert rest[-1] - rest[0] <= 0.1 * rest[-1]


def test_odd_rows_are_sharded(odd, empty):
    rows = [r.asDict() for r in P.shard(odd, shards=3).collect()]
    assert len(rows) == odd.count()
    check_shards(rows, 3)
    assert P.shard(empty).count() == 0
