"""Operators on small tables: edge cases, and results beside brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import aliases, components, curves, langid, packing, phrases, quality, queries, simhash, similar, suffixes, warc, windows
from shelfwise.session import scratch_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tag string, fp long, root long"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bcdlmnrst") for _ in range(rng.randint(1, 4)))
    line = " ".join(word() for _ in range(60))
    out = [" ".join(word() for _ in range(rng.randint(5, 150))) for _ in range(40)]
    out += [out[3], out[3], "X " + out[4], line, "pre " + line + " post", line + " é" * 70, "ü" * 300, "y" + "ü" * 200]
    return out + [None, "", " ", "!!! ...", "one", "é", "a" * 20000, " ".join([line] * 40), "<|endoftext|>", "\x00 b"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else "fr", "s", len(t or ""), "t", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[6], None, None, None, None, None, None), (7, "other text of the same id", "en", "s", 1, "", 1, 2)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def key(r):
    return repr(r)


def test_language(spark, docs, none):
    de = spark.createDataFrame([(1000 + i, f"der und die das nicht {i} schön", "de") for i in range(30)], "doc_id long, text string, lang string")
    train = docs.select("doc_id", "text", "lang").unionByName(de)
    model = langid.fit(train)
    assert set(model["langs"]) == {"de", "en", "fr"}
    got = {r.doc_id: r for r in langid.predict(train, model).select("doc_id", "text", "language.*").collect()}
    assert all(got[1000 + i].lang_pred == "de" for i in range(30))
    for r in got.values():
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text)), r
    assert langid.predict(none, langid.fit(none)).count() == 0
    assert langid.predict(docs, langid.fit(none)).select("language.lang_pred").distinct().collect() == [("und",)]


def test_warc(spark):
    pages = [(3, "http://a/é\r\nb c", "dup"), (1, None, "dup"), (2, "u", None), (4, "u", ""), (None, "u", "dup"), (1, None, "dup"), (9, "u", "x" * 300000),
             (8, "u", "\r\n\r\nHTTP/1.1 \x1f\x8b é")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, bytes string")
    got = warc.round_trip(spark, df).select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "record_type",
                                            warc.page_of("refers_to").alias("r"), "payload").collect()
    want = [(3, 3, "revisit", 1), (1, 3, "response", None), (2, 0, "response", None), (4, 0, "revisit", 2), (None, 3, "revisit", 1),
            (1, 3, "response", None), (9, 300000, "response", None), (8, len(pages[-1][2].encode()), "response", None)]
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.r) for r in got), key=key) == sorted(want, key=key)
    payload = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert payload[8] == pages[-1][2] and payload[9] == pages[-2][2]
    assert warc.round_trip(spark, df.limit(0)).count() == 0
    files = warc.write(df, scratch_dir(spark, "warc"), revisit_bytes=4)
    kinds = warc.read(files, range_bytes=50).groupBy("record_type").count().collect()
    assert dict(kinds) == {"response": 8}


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16)).round(3)
    x[100:160] = x[100]
    rows = [(i, v.tolist(), "e") for i, v in enumerate(x)]
    rows += [(900, None, ""), (901, [0.0] * 16, ""), (902, [float("nan")] * 16, ""), (903, [None] + [1.0] * 15, ""), (904, [1.0], ""),
             (905, [float("inf")] * 16, ""), (None, x[0].tolist(), ""), rows[3], rows[40]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, gid string")
    got = curves.nearest(df, F.col("vec_id") % 20 == 0, k=5, block=64).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by) == set(range(0, 600, 20))
    x = x.astype(np.float32).astype(float)
    hit = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        for _, v, s in found:
            assert abs(d[v] - s) < 1e-9
        true = [v for v in sorted(range(600), key=lambda v: (d[v], v)) if v != q][:5]
        hit += len(set(true) & {f[1] for f in found})
        if 100 <= q < 160:
            assert [f[1] for f in found] == true
    assert hit / (5 * len(by)) >= 0.9
    assert len(curves.nearest(df.where("vec_id IN (0, 1, 2)"), F.col("vec_id") == 0).collect()) == 2
    assert curves.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert curves.nearest(df, F.col("vec_id") == -1).count() == 0


def test_phrases(spark, docs, none):
    words = [f"w{i}" for i in range(40)]
    items = [(0, " ".join(words)), (1, "Short one, é"), (2, None), (3, "..."), (4, " ".join(words[5:30])), (None, "lost item here"), (0, " ".join(words))]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    own = [(1, "x " + "-".join(w.upper() for w in words[3:15]) + " y w4"), (2, " ".join(words[:9])), (3, "a SHORT one é b short one é short One"), (4, None), (5, ""),
           (6, " ".join(words[20:32]) + " q " + " ".join(words[0:10])), (1, " ".join(words[0:5] + ["no"] + words[6:15])), (None, "the lost item here")]
    df = spark.createDataFrame([(i, t, 5) for i, t in own], "doc_id long, text string, item_id long")
    report, spans = phrases.decontaminate(df, bench)
    sha = lambda *ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    want = [(1, 15, 12, 2, sha("0", "4"), True), (2, 9, 0, 0, sha(), False), (3, 10, 6, 1, sha("1"), True), (4, 0, 0, 0, sha(), False),
            (5, 0, 0, 0, sha(), False), (6, 23, 22, 2, sha("0", "4"), True), (1, 15, 0, 0, sha(), False), (None, 4, 3, 0, sha(), True)]
    want[2] = (3, 10, 6, 1, sha("1"), True)
    assert sorted(map(tuple, report.collect()), key=key) == sorted(want, key=key)
    assert spans.where("row IS NULL").count() == 0 and spans.where("item_id = 4 AND near < length").count() == 0
    assert phrases.decontaminate(none, bench)[0].count() == 0
    clean = phrases.decontaminate(docs, bench.limit(0))[0]
    assert clean.count() == docs.count() and clean.where("contaminated").count() == 0


def brute_bytes(rows, width):
    first, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            s, at = b[p:p + width], (d if d is not None else 1 << 62, p)
            first[s] = min(first.get(s, at), at)
    for d, t in rows:
        b = (t or "").encode()
        gone = set()
        for p in range(len(b) - width + 1):
            if first[b[p:p + width]] < (d if d is not None else 1 << 62, p):
                gone.update(range(p, p + width))
        spans = sum(1 for p in gone if p - 1 not in gone)
        out.append((d, len(b), len(gone), spans, bytes(c for i, c in enumerate(b) if i not in gone)))
    return out


@pytest.mark.parametrize("large", [suffixes.LARGE, 1])
def test_repeated_strings(spark, docs, none, large):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeated(docs, large=large).collect()]
    assert sorted(got, key=key) == sorted(brute_bytes(rows, 100), key=key)
    assert suffixes.remove_repeated(none).count() == 0
    assert set(docs.columns) - {"text"} <= set(suffixes.remove_repeated(docs).columns)


def test_repeated_windows(spark, docs, none):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    first, want = {}, []
    rank = lambda d: d if d is not None else 1 << 62
    for d, w in rows:
        for p in range(len(w) - 19):
            s = tuple(w[p:p + 20])
            first[s] = min(first.get(s, (rank(d), p)), (rank(d), p))
    for d, w in rows:
        gone = {q for p in range(len(w) - 19) if first[tuple(w[p:p + 20])] < (rank(d), p) for q in range(p, p + 20)}
        want.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    got = [tuple(r) for r in windows.remove_repeated(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert windows.remove_repeated(none).count() == 0


def test_packing(spark, docs, none):
    vocabularies = pytest.importorskip("public_tokenizers")
    path, pattern = vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN
    cut = packing.pieces(docs, path, pattern, with_ids=True)
    got = packing.pack(cut, block=16).collect()
    assert len(got) == cut.count()
    library = packing.encoder(path, pattern).library
    texts = {r.doc_id: r.text for r in docs.where("doc_id IS NOT NULL AND doc_id NOT IN (5, 7)").collect()}
    ids, places = {}, {}
    for r in sorted(got, key=lambda r: r.start):
        ids.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 <= 1024 and (r.length == 1024 or r.piece == 0)
    for d, t in texts.items():
        assert ids[d] == library.encode(t or "", add_special_tokens=False).ids + [2]
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == np.cumsum([0] + [n for _, n in p])[:-1].tolist() and sum(n for _, n in p) <= 1024
    assert len(places) <= -(-sum(r.length for r in got) // 1024) + 4
    assert packing.pack(packing.pieces(none, path, pattern)).count() == 0


def test_url_aliases(spark):
    rules = aliases.rule_table(spark, [("org", "/", "allow"), ("bad.org", "/x", "block"), ("evil.com", "/", "block"), ("com", "/ok/", "allow")])
    link = lambda u: f'<html><LINK href="{u}" rel=canonical></html>'
    pages = [(1, "http://a.net/1", link("http://evil.com/z")), (2, "http://b.net/2", '<meta http-equiv="Refresh" content="0; URL=http://a.net/1">'),
             (3, "HTTP://Sub.BAD.org/x/y?q#f", None), (4, "http://abad.org/x", ""), (5, "http://c.net/", link("/d")), (6, "http://c.net/d", link("http://w.com/ok/1&amp;2")),
             (7, "http://c.net/d#frag", link("https://evil.com/")), (8, None, link("http://evil.com/")), (9, "no scheme", link("http://evil.com/")),
             (10, "http://e.net", link("mailto:x@y")), (11, "http://b.net/2", None), (None, "http://q.net/", link("")), (12, "http://evil.com", None), (13, "http://b.net/2#x", None)]
    df = spark.createDataFrame([(*p, "n") for p in pages], "page_id long, url string, html string, node string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in aliases.judge(df, rules).collect()}
    assert got == {
        1: ("a.net", "/1", None, "block"), 2: ("b.net", "/2", None, "block"), 3: ("sub.bad.org", "/x/y", "bad.org/x", "block"),
        4: ("abad.org", "/x", "org/", "allow"), 5: ("c.net", "/", None, "allow"), 6: ("c.net", "/d", None, "allow"), 7: ("c.net", "/d", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("e.net", "", None, "allow"), 11: ("b.net", "/2", None, "block"),
        None: ("q.net", "/", None, "allow"), 12: ("evil.com", "", None, "allow"), 13: ("b.net", "/2", None, "block")}
    assert aliases.judge(df.limit(0), rules).count() == 0
    assert aliases.judge(df, rules.limit(0)).where("verdict = 'allow' AND rule IS NULL").count() == len(pages)


def test_all_tags_of_a_page_count(spark):
    cases = [
        ('<link rel=canonical><link rel="canonical" href="http://evil.com/z">', "block"),
        ("<LINK href='http://evil.com/z' REL='nofollow\nCanonical'>", "block"),
        ('<link rel="canonical" href="/here"><p><link rel="x canonical y" href="http://evil.com/z">', "block"),
        ('<meta http-equiv=refresh content="5"><meta http-equiv=" refresh" content="0;url=http://evil.com/z">', "block"),
        ("x" * 300_000 + '<link rel=canonical href=http://evil.com/z>', "block"),
        ('<link rel="canonicals" href="http://evil.com/z"><link rel="not-canonical" href="http://evil.com/z">', "allow"),
        ('<link rel="canonical" data-href="http://evil.com/z"><link data-rel="canonical" href="http://evil.com/z">', "allow"),
        ('<link rel="icon" title="canonical" href="http://evil.com/z"><a rel="canonical" href="http://evil.com/z">', "allow")]
    rules = aliases.rule_table(spark, [("evil.com", "/", "block")])
    pages = spark.createDataFrame([(i, f"http://a{i}.net/1", h.replace("/z", f"/{i}")) for i, (h, _) in enumerate(cases)], "page_id long, url string, html string")
    want = {i: v for i, (_, v) in enumerate(cases)}
    assert {r.page_id: r.verdict for r in aliases.judge(pages, rules).collect()} == want
    # The twin follows the rule, not the operator.
    db = duckdb.connect()
    db.register("rows", pages.toPandas())
    db.execute("CREATE VIEW pages AS SELECT page_id, url, replace(html, 'evil.com/', 'x.com/de/') AS html FROM rows")
    assert dict(db.sql(f"SELECT page_id, verdict FROM ({queries.SQL['op8_url_aliases']})").fetchall()) == want


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(30)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(90)] + [(5, 5), (None, 1)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("bucket,most", [(simhash.BUCKET, 3), (4, 3), (simhash.BUCKET, 7), (simhash.BUCKET, 1)])
def test_simhash(spark, docs, none, bucket, most):
    fps = simhash.with_fingerprint(docs).select("fp").distinct()
    rng = random.Random(9)
    f = [rng.getrandbits(64) - 2 ** 63 for _ in range(20)]
    f += [x ^ (rng.getrandbits(63) & rng.getrandbits(63) & rng.getrandbits(63) & rng.getrandbits(63)) for x in f for _ in range(3)]
    f += [x ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for x in f for _ in range(6)]
    fps = fps.unionByName(spark.createDataFrame([(x,) for x in set(f)], "fp long")).distinct()
    got = {r.node: r.root for r in components.components(simhash.links(fps, most, bucket)).collect()}
    all_ = sorted(r.fp for r in fps.collect())
    u, root = np.array(all_, np.int64).view(np.uint64), {x: x for x in all_}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(all_):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= most):
            a, b = find(x), find(all_[j])
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in all_ if find(x) != x}


def test_simhash_classes(spark, docs, none):
    rows = simhash.classes(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id != 7}
    by = {r.doc_id: r.component_id for r in rows if r.doc_id != 7}
    assert by[40] == by[41] == by[3] == 3 and by[None] == 6
    assert len({by[i] for i, t in texts.items() if not (t or "").split()}) == 1
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids.count(i) for i in (5, 3, 7)) == [1, 1, 2] and 40 not in ids and None not in ids
    assert simhash.classes(none).count() == 0 and simhash.keep_first(none).count() == 0


def test_quality(spark, docs, none):
    good = [(i, "The plain words of a calm sentence go on, and stop. " * (1 + i % 7), 1) for i in range(150)]
    bad = [(1000 + i, "BUY$$$ NOW!!! " * (2 + i % 5) + str(i), 0) for i in range(60)]
    rows = spark.createDataFrame(good + bad + [(5000, None, 0), (5001, "", 0)], "doc_id long, text string, quality int")
    labels = rows.where("quality = 1 AND doc_id % 2 = 0").select("doc_id", "quality").unionByName(spark.createDataFrame([(77777, 1), (None, 1), (3, None)], "doc_id long, quality int"))
    model = quality.fit(rows.drop("quality"), labels)
    got = {r.doc_id: r.score for r in quality.score(rows, model).collect()}
    assert len(got) == 212 and all(0 <= s <= 1 for s in got.values())
    assert min(got[i] for i in range(150)) > 0.5 > max(got[1000 + i] for i in range(60))
    assert quality.score(docs, quality.fit(none, labels)).where("score != 0.5").count() == 0
    assert quality.score(none, model).count() == 0


def test_pipeline_stages(spark, sf, none, docs):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = docs.select(names)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, sf)
        assert name == "pack" or out.columns == names
        assert stage(spark, none.select(names), sf).count() == 0
        if name == "quality":
            assert out.count() <= rows.count()


def test_pipeline_takes_effect(spark, sf):
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    kept = read("documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf)
        rows = {r.doc_id: r.text for r in kept.collect()}
        was = {r.doc_id: r.text for r in before.collect()}
        assert set(rows) <= set(was)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in read("labels").collect()}
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in rows for d in good) >= 0.98 * len(good) and len(rows) < len(was)
        elif name == "near_duplicates":
            assert len(set(rows.values())) == len(rows) and set(rows.values()) == set(rows.values()) & set(was.values())
        elif name == "repeated_text":
            want = {d: k.decode("utf-8", "ignore") for d, _, _, _, k in brute_bytes(sorted(was.items()), 100)}
            assert rows == want
        else:
            report = {r.doc_id: r.contaminated for r in phrases.decontaminate(before, read("benchmark"))[0].collect()}
            assert set(rows) == {d for d, c in report.items() if not c} and any(report.values())
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.collect()} == set(rows)


def brute_classes(texts, least=0.8):
    """The root of each of ``texts`` (distinct, in the order of their ids) when pairs of that similarity are linked."""
    grams = []
    for t in texts:
        w = (t or "").encode().lower().split()
        grams.append({b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))})
    size, post, root = [len(g) for g in grams], {}, list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, g in enumerate(grams):
        both = {}
        for x in g:
            for j in post.setdefault(x, []):
                both[j] = both.get(j, 0) + 1
            post[x].append(i)
        for j, n in both.items():
            if n >= least * (size[i] + size[j] - n) - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [similar.BLOCK, 8])
def test_similar_classes(spark, block):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bcdlmnrst") for _ in range(4))
    base, texts = [word() for _ in range(100)], [None, "", " \n", "one two", "ONE two", "one"]
    for _ in range(60):  # some of these reach the bound with each other and some do not
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(100)] = word()
        texts.append(" ".join(t))
    texts = list(dict.fromkeys(texts)) + [" ".join(base[:60]), " ".join(base + [word() for _ in range(70)])]
    rows = spark.createDataFrame([(9, i, t) for i, t in enumerate(texts)], "root long, _tag long, text string")
    got = {r.node: r.root for r in similar.classes(rows, 0.8, block=block).collect()}
    root = brute_classes(texts)
    assert 3 < len(set(root)) < len(texts) and got == {i: r for i, r in enumerate(root) if i != r}
    assert similar.classes(rows.limit(0), 0.8).count() == 0


def test_near_duplicates_go_only_where_shingles_agree(spark):
    """Of the sample table: no text goes without a link of that similarity, and most that have one go."""
    read = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    first = {}
    for r in sorted(read.collect(), key=lambda r: r.doc_id):
        first.setdefault(r.text, r.doc_id)
    texts = list(first)
    kept = {r.text for r in corpus_pipeline.near_duplicates(spark, read, "").collect()}
    may_go = {t for i, (t, r) in enumerate(zip(texts, brute_classes(texts))) if i != r}
    gone = set(texts) - kept
    assert not gone - may_go
    assert len(gone & may_go) >= 0.9 * len(may_go) > 0


def test_texts_of_one_id_that_share_a_start(spark):
    """Two texts without an id open alike in one task, and a smaller id holds the same words in another task."""
    line = " ".join(f"word{i}" for i in range(25))
    rows = [(None, line + " left one"), (None, line + " left two"), (None, line + " left two"), (1, line), (2, "else"), (3, "else")]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    assert sorted(r.kept for r in windows.remove_repeated(df).collect() if r.doc_id is None) == ["left one", "left two", "left two"]
    for large in (suffixes.LARGE, 1):
        kept = [bytes(r.kept) for r in suffixes.remove_repeated(df, large=large).collect() if r.doc_id is None]
        assert sorted(kept) == sorted(k for d, _, _, _, k in brute_bytes([(r.doc_id, r.text) for r in df.collect()], 100) if d is None)
