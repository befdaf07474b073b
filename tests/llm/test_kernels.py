"""Kernels beside brute force, without Spark."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from shelfwise.llm import curves, langid, packing, quality, simhash, sketch, suffixes, warc, windows


@pytest.mark.parametrize("width", [64, 70, 100])
@pytest.mark.parametrize("shard", [100, 300, 1 << 15])
def test_merged_shards_find_what_starts_earlier(width, shard):
    rng = random.Random(width + shard)
    for _ in range(15):
        base = bytes(rng.choice(b"ab") for _ in range(400))
        strings = []
        for _ in range(rng.randint(2, 9)):
            a = rng.randint(0, 200)
            s = bytearray(base[a:a + rng.randint(width, 168)])
            if rng.random() < 0.5:
                s[rng.randrange(len(s))] = rng.choice(b"abc\x00\xff")
            strings.append(bytes(s))
        order = np.array(rng.choices(range(5), k=len(strings)))
        want = {(i, p) for i, s in enumerate(strings) for p in range(len(s) - width + 1)
                if any(order[j] < order[i] and s[p:p + width] in t for j, t in enumerate(strings))}
        who, place = suffixes.later_starts(strings, order, width, shard)
        assert set(zip(who.tolist(), place.tolist())) == want


def test_merged_order_is_the_sorted_order_of_all_rotations():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"abc") for _ in range(rng.randint(100, 160))) for _ in range(12)]
    shards = [suffixes.Shard(strings[i:i + 5], 100) for i in (0, 5, 10)]
    merged = suffixes.Merged(shards, 100)
    prefix = [(s * 2)[p:p + 100] for s in strings for p in range(len(s))]
    prefix = [prefix[r] for r in merged.order]
    assert prefix == sorted(prefix) and sorted(merged.order.tolist()) == list(range(sum(map(len, strings))))
    assert [a == b for a, b in zip(prefix, prefix[1:])] == (np.diff(merged.interval) == 0).tolist()


@pytest.mark.parametrize("n", [0, 99, 100, 101, 500, 5000])
def test_contexts_hold_every_start_once(n, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    data = bytes(random.Random(n).choice(b"abcdef \n") for _ in range(n))
    starts = [p for _, s, c in suffixes.contexts(data) for a, k in zip(s, c) for p in range(a, a + k)]
    assert starts == list(range(max(0, n - 99)))


def test_equal_strings_have_equal_anchors():
    rng = random.Random(5)
    a = bytes(rng.choice(b"abcdef") for _ in range(300))
    b = b"zz" * 37 + a[50:200] + b"yy" * 60
    anchor = lambda d: {d[p:p + 100]: int(h[i]) for h, s, c in suffixes.contexts(d) for i in range(len(h)) for p in range(s[i], s[i] + c[i])}
    x, y = anchor(a), anchor(b)
    both = set(x) & set(y)
    assert len(both) >= 51 and all(x[s] == y[s] for s in both)


def test_window_hashes_agree_with_the_words(monkeypatch):
    monkeypatch.setattr(windows, "PIECE", 50)
    data = b"a bc  d\n" * 30 + b" \t\x0be \xc3\xa9"
    words = windows.word_list(data)
    found = windows.window_hashes(data, 5)
    by = {}
    for i in range(len(words) - 4):
        by.setdefault(tuple(words[i:i + 5]), set()).add(int(found[i]))
    assert len(found) == len(words) - 4
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60))
def test_runs_and_cover(places):
    places = np.unique(np.array(places, np.int64))
    starts, sizes = windows.runs(places)
    assert [p for a, n in zip(starts, sizes) for p in range(a, a + n)] == places.tolist()
    spans = [{"pos": int(a), "size": int(n)} for a, n in zip(starts, sizes)]
    want = {q for p in places.tolist() for q in range(p, p + 3) if q < 45}
    assert set(np.flatnonzero(windows.covered(spans, 45, 3)).tolist()) == want


def test_sketch_never_misses_a_repeat():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 62, 50_000).astype(np.uint64)
    h[:500] = h[500:1000]
    bits = sketch.BLOCK_BITS
    maps = [np.zeros(1 << (bits - 3), np.uint8) for _ in sketch.ROWS]
    parts = [sketch._partial(x, bits) for x in np.array_split(h, 7)]
    for row in range(len(maps)):
        total = np.zeros(1 << bits, np.uint8)
        for p in parts:
            for r in p[p.row == row].itertuples():
                total[sketch._unpacked(r.once)] += 1
                total[sketch._unpacked(r.twice)] += 2
        maps[row] = np.packbits(total > 1)
    maybe = sketch.maybe_repeated(h, maps)
    assert maybe[:1000].all() and maybe[1000:].mean() < 0.02


def test_hilbert_order_is_a_walk_through_all_cells():
    grid = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    keys = curves.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def brute_fingerprint(data: bytes) -> int:
    words = data.lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " ", "A", "a b", "a B c", "the  cat\nsat on\tthe mat " * 40, "É é x y z"])
def test_fingerprint(text, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES", 7)
    for size in (1 << 21, 11):
        monkeypatch.setattr(simhash.word_pieces, "__defaults__", (size,))
        assert simhash.fingerprint(text.encode()) & (2 ** 64 - 1) == brute_fingerprint(text.encode())


def test_links_of_a_bucket_span_all_pairs():
    rng = np.random.default_rng(2)
    f = rng.integers(-2 ** 63, 2 ** 63, 3, dtype=np.int64)
    f = np.unique(np.concatenate([f] + [f[:1] ^ (1 << rng.integers(0, 60, 40)) for _ in range(3)]))
    key = np.zeros(len(f), np.int64)
    a, b = simhash._bucket_links(key, f, 3)
    root = {x: x for x in f.tolist()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        root[find(x)] = find(y)
    u = f.view(np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 3):
            assert find(int(f[i])) == find(int(f[j]))
    assert len(a) < len(f)


def test_ranges_read_each_record_once(tmp_path):
    path, offsets, at = tmp_path / "x.warc.gz", [], 0
    inner = warc.record("response", "urn:page:9", None, b"inner", "D", 5)
    with path.open("wb") as f:
        for i in range(30):
            offsets.append(at)
            payload = inner if i % 7 == 3 else bytes([i]) * (i * 37)
            data = warc.record("response", f"urn:page:{i}", "http://x/é y", payload, "D", len(payload))
            at += f.write(data)
    for step in (1, 13, 100, 1000, at):
        with warc._open(str(path)) as file:
            found = [o for s in range(0, at, step) for o, _ in warc.range_members(file, s, min(at, s + step), at)]
        assert found == offsets


def test_token_ids_equal_the_librarys(monkeypatch):
    vocabularies = pytest.importorskip("public_tokenizers")
    enc = packing.encoder(vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN)
    texts = ["", " ", "  a  b ", " x", "a b c", "a\n\n b", "日本 語 text's", "<|endoftext|> hi", "a\x1cb c\x1d d", "\ta b",
             "I'm don't 123 4 5", "é à  ü  x", "x " * 50, "The quick brown fox. " * 30, "\U0001f600 \U0001f600a"]
    for piece in (1 << 20, 15):
        monkeypatch.setattr(packing, "PIECE", piece)
        for t in texts:
            assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.library.encode(t, add_special_tokens=False).ids, t


def test_evolved_packing_is_whole_and_no_worse_than_best_fit():
    rng = random.Random(4)
    lengths = [rng.randint(1, 1023) for _ in range(500)]
    order = sorted(range(500), key=lambda i: -lengths[i])
    start = packing.best_fit([], order, lengths, 1024)
    bins = packing.evolve(lengths, [], 1024, 1)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 1024
    assert -(-sum(lengths) // 1024) <= len(bins) <= len(start)
    assert packing._bins(packing._genome(bins, 500)) == [sorted(b) for b in bins]


def test_ngrams_over_a_seam_count_once(monkeypatch):
    text = "abc déf 12 ghij kl"
    whole = langid.ngram_counts(text)
    for piece in (1, 2, 3, 5):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert (langid.ngram_counts(text) == whole).all()
    assert langid.ngram_counts("12 ,.").sum() == 0


def test_prior_and_risk():
    rng = np.random.default_rng(6)
    pos = rng.normal(1.5, 1, (2000, quality.DIMS))
    unl = np.concatenate([rng.normal(1.5, 1, (1400, quality.DIMS)), rng.normal(-1.5, 1, (600, quality.DIMS))])
    pos[:, 3:], unl[:, 3:] = 0, 0
    pos[:, -1] = unl[:, -1] = 1
    model = quality.fit_arrays(pos, unl)
    assert abs(model["prior"] - 0.7) < 0.06
    z = np.clip((unl - model["mean"]) / model["std"], -6, 6) @ model["w"]
    assert ((z > 0) == (np.arange(2000) < 1400)).mean() > 0.95
    assert quality.score_bytes(b"", quality.fit_arrays(pos[:0], unl)) == 0.5
