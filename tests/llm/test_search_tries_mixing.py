"""Ranked search, conversation tries and mixing on small tables, beside brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing, prefix, ranking, tries


def key(r):
    return repr(r)


# --- running sums

def test_running_sums_of_a_hot_group(spark):
    rows = [("a", i // 3, i, i % 5) for i in range(4000)] + [(f"g{i}", 0, i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o long, i long, v long").repartition(7)
    extra = df.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix.running_sums(df, ["g"], ["o", "i"], {"s": "v"}, extra).collect()
        shares = prefix.stored(df.repartitionByRange("g", "o").withColumn("p", F.spark_partition_id()), "x")[0].where("g = 'a'").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(shares) > 1 and max(r["count"] for r in shares) < 4000
    want, total = {}, Counter()
    for g, o, i, v in sorted(rows):
        want[g, i] = total[g]
        total[g] += v
    assert {(r.g, r.i): r.s for r in got} == want
    assert all(r.size == (4000 if r.g == "a" else 1) for r in got)
    assert prefix.running_sums(df.limit(0), [], ["i"], {"s": "v"}).count() == 0


# --- op11

TEXTS = [
    "The cat sat on the mat", "the CAT and the dog", None, "", "...", "dog dog dog cat", "dog dog dog cat", "éa Éa eÉ cat-dog", "x" * 50_000, "mat " * 30_000,
    "unrelated words only here", "cat", "cat", "cat", "dog", "the", "a_b a1 2", "ünï \x7f cat\x00dog", " ".join(f"w{i}" for i in range(5000)),
]
ITEMS = ["cat dog", "The mat", "éa Éa", None, "", "nothing-of-it", "cat cat CAT", " ".join(f"w{i}" for i in range(300)), "cat dog", "a_b"]


def brute_search(docs, items, k=10):
    words = lambda t: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w)
                       for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    lists = [(d, words(t)) for d, t in docs]
    lists = [(d, w) for d, w in lists if w]
    n, total, df = len(lists), sum(len(w) for _, w in lists), Counter(t for _, w in lists for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for d, w in lists:
            tf, m = Counter(w), 10 + (90 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in set(words(text)) if tf[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def search_tables(spark):
    rng = random.Random(2)
    docs = list(enumerate(TEXTS)) + [(100 + i, " ".join(rng.choice(["cat", "dog", "mat", "sun", "The"]) for _ in range(rng.randint(1, 6)))) for i in range(80)]
    docs += [docs[5], (None, "cat dog"), (None, "cat dog"), (3, "mat sun")]
    items = list(enumerate(ITEMS)) + [(None, "sun"), (0, "sun sun mat")]
    schema = "doc_id long, text string, item_id long, score long, rank int, item long, at string, tf string"
    df = spark.createDataFrame([(*d, 1, 2, 3, 4, "a", "b") for d in docs], schema).repartition(5)
    it = spark.createDataFrame([(*i, 9, "w") for i in items], "item_id long, text string, doc_id long, words string")
    return docs, items, df, it


@pytest.mark.parametrize("limits", [{}, {"postings": 40}, {"documents": 7, "items": 2, "columns": 3}])
def test_search(spark, search_tables, monkeypatch, limits):
    docs, items, df, it = search_tables
    monkeypatch.setattr(ranking, "ITEMS", limits.get("items", ranking.ITEMS))
    monkeypatch.setattr(ranking, "COLUMNS", limits.get("columns", ranking.COLUMNS))
    monkeypatch.setattr(ranking, "DOCUMENTS", limits.get("documents", ranking.DOCUMENTS))
    got = ranking.search(df, it, **({"postings": limits["postings"]} if "postings" in limits else {}))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_search(docs, items), key=key)


def test_search_of_nothing(spark, search_tables):
    _, _, df, it = search_tables
    for d, i in ((df.limit(0), it), (df, it.limit(0)), (df.where("text IS NULL"), it), (df, it.where("text = ''"))):
        assert ranking.search(d, i).count() == 0


def test_partial_sums_stay_exact():
    weight = np.full(10_000, 23_000)
    parts = ranking.cuts(weight, columns=10_000)
    assert parts == [(0, 10_000)]
    heavy = np.full(10, ranking.EXACT // ranking.IMPACT // 3)
    parts = ranking.cuts(heavy)
    assert [z - a for a, z in parts] == [3, 3, 3, 1] and parts[-1][1] == 10
    tile = ranking.Tile([0, 1], [np.arange(10), np.arange(5)], heavy)
    dense = np.full((2, 10), ranking.IMPACT - 1.0)
    want = [sum(int(w) * (ranking.IMPACT - 1) for w in heavy[:n]) for n in (10, 5)]
    assert tile.scores(dense).tolist() == [want, want]
    assert ranking.cuts(np.array([], np.int64)) == []


def test_best_keeps_the_smaller_id_of_equals():
    score, ids = np.array([5, 7, 5, 5, 0, 7]), np.array([9, 8, 1, 4, 0, 2])
    assert [x.tolist() for x in ranking.best(score, ids, 4)] == [[7, 7, 5, 5], [2, 8, 1, 4]]
    assert [x.tolist() for x in ranking.best(score[:0], ids[:0], 4)] == [[], []]


# --- op12

def brute_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        built[c] = convs.get(base, [])[:h] + own[h:]
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += p not in kids
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(-12, 60), 10 ** 12, 10 ** 12 + 3]:
        if c % 15 == 0 and c > 0:
            continue
        shared = rng.choice([0, 2, 5, 12, 20])
        length = rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 24, 33])
        turns = [("user", f"shared {i}") for i in range(min(shared, length))] + [("user", f"own {c % 7} {i} é") for i in range(shared, length)]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    long_ = [("user" if i % 2 else None, f"long {i // 3}") for i in range(140)]
    rows += [(c, i, r, t) for c in (1000, 1001, 1002) for i, (r, t) in enumerate(long_[:140 - c % 3])]
    rows += [(70, None, "user", "first"), (70, 3, None, None), (70, 3, "", ""), (70, 2, "b", "x"), (70, 2, "a", "y"), (70, 2, "a", "y")]
    rows += [(None, 1, "user", "lost"), (75, 0, "user", "z" * 100_000), (76, 0, "user", "z" * 100_000), (rows[0])]
    return rows


def test_conversation_trie(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, conv long, b long, pos long").repartition(4)
    got = tries.conversation_trie(df)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_trie(rows), key=key)
    assert tries.conversation_trie(df.limit(0)).count() == 0
    assert tries.conversation_trie(df.where("conv_id IS NULL")).count() == 0


def test_trie_of_one_long_conversation_and_many_ends(spark, monkeypatch):
    """A conversation of a third of all rows, and a node that many conversations end at, hashed in several runs."""
    monkeypatch.setattr(tries, "RUN", 7)
    rows = [(5000, i, "user", str(i % 2)) for i in range(700)] + [(c, 0, "user", "hello") for c in range(200)] + [(c, 0, "user", "hello") for c in (9005, 9006)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert sorted(map(tuple, tries.conversation_trie(df).collect()), key=key) == sorted(brute_trie(rows), key=key)


@pytest.mark.parametrize("spread", [3, 4096])
def test_rebuilt_turns(spark, monkeypatch, spread):
    monkeypatch.setattr(tries, "SPREAD", spread)
    rows = [(c, t, "r", f"{c} {t}") for c in (5, 6, 7, 12, 20) for t in range(12)] + [(25, 0, "r", "only"), (26, 0, "r", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns, lengths = tries.rebuilt(tries.positions(df))
    n = {r.conv: r.length for r in lengths.collect()}
    got = {}
    for r in turns.collect():
        got.setdefault(r.conv, []).append(r.pos)
    own = Counter(r[0] for r in rows)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        assert n[c] == min(h, own.get(c - c % 5, 0)) + max(0, own[c] - h)
        assert sorted(got.get(c, [])) == list(range(1, n[c] + 1))


# --- op13

def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """By resharing the excess in rounds."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in order if s not in full)
        t = {s: most * sizes[s] if s in full else left * w[s] / free for s in order}
        over = {s for s in order if s not in full and t[s] > most * sizes[s]}
        if not over:
            return t
        full |= over


DOCS = "doc_id long, text string, source string, size long, target double, taken long, epoch int"


@pytest.mark.parametrize("sources", [[400, 3, 0, 1, 250, 7, 2], [1, 1, 1000], [5], [10, 20, 30, 40]])
def test_mix(spark, sources):
    rng = random.Random(len(sources))
    rows, names = [], ["b", "a", "", "é", None, "Z", "c"]
    for name, n in zip(names, sources):
        rows += [(rng.randint(0, 10 ** 6), " ".join(["w"] * rng.randint(0, 9)), name) for _ in range(n)]
    rows += [(1, None, names[0]), (None, "x\ty z", names[0]), (2, "", names[0]), rows[0], rows[0], (7, "v " * 30_000, names[0])]
    df = spark.createDataFrame([(*r, 5, 1.5, 6, 7) for r in rows], DOCS).repartition(5)
    got = mixing.mix(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, size(t)) for d, t, s in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-9)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(tuple, again), key=key) == sorted(map(tuple, got), key=key)


def test_cut_is_in_hash_order(spark):
    rows = [(i, "a b c", "x" if i < 30 else "y") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, weights=(1, 1), seed=4)
    keys = {i: int(hashlib.md5(f"4:{i}".encode()).hexdigest()[:15], 16) for i in range(600)}
    line = sorted((r for r in got.collect() if r.source == "y"), key=lambda r: keys[r.doc_id])
    whole = [r.taken for r in line]
    assert sum(whole) == 1800 - 270 and whole == sorted(whole, reverse=True)
    moved = mixing.mix(df, weights=(1, 1), seed=5)
    assert {r.doc_id for r in moved.collect() if r.taken} != {r.doc_id for r in got.collect() if r.taken}


def test_passages_of_a_mix(spark):
    rows = [(i, f"one  two\nthree {i}", "a") for i in range(5)] + [(10 + i, " ".join(["w"] * 40), "b") for i in range(5)] + [(20, None, "a"), (21, "", "b")]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep=["text"])
    texts = {d: t for d, t, _ in rows}
    words = Counter()
    for r in mixing.passages(mixed).collect():
        assert len(r.text.split()) == r.words and texts[r.doc_id].split()[:r.words] == r.text.split()
        words[r.doc_id] += r.words
    assert words == Counter({r.doc_id: r.taken for r in mixed.collect() if r.taken})
    assert any(w > len((texts[d] or "").split()) for d, w in words.items())


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix(blank).orderBy("doc_id").collect()] == [(1, None, 0, 0, 0.0, 0), (2, "a", 0, 0, 0.0, 0)]
