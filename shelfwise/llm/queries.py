"""The corpus operators bound to the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import aliases, curves, langid, mixing, packing, phrases, quality, ranking, simhash, suffixes, tries, warc, windows
from shelfwise.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query("op1_language_id")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs.drop("lang"), model).select("doc_id", "held_out", "language.*")


@query("op2_warc", """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS payload_bytes, upper(sha1(b)) AS hex FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d),
    bits AS (SELECT *, list_transform(range(0, 40), lambda i: strpos('0123456789ABCDEF', substr(hex, (i + 1)::BIGINT, 1)) - 1) AS nib FROM f)
    SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((nib[(i * 5) // 4 + 1] * 16 + coalesce(nib[(i * 5) // 4 + 2], 0))
            >> (3 - (i * 5) % 4)) & 31)::BIGINT, 1)), 'string_agg', '') AS payload_digest,
        CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
    FROM bits""")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = warc.round_trip(spark, table(spark, sf, "pages"))
    return found.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        warc.page_of("refers_to").alias("refers_to"))


@query("op9_simhash")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.classes(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"))


@query("op8_url_aliases", r"""
    WITH RECURSIVE rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
        ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    parts AS (SELECT *, coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 1, 's'), '') AS s,
        translate(coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 2, 's'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 3, 's'), '') AS path,
        coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 4, 's'), '') AS q FROM pages),
    own AS (SELECT *, CASE WHEN contains(url, '://') THEN lower(s) || '://' || host || path || q END AS node FROM parts),
    links AS (SELECT node, s, host, path, url, unnest(regexp_extract_all(html, '<link\b[^>]*>', 0, 'is')) AS tag FROM own WHERE node IS NOT NULL),
    metas AS (SELECT node, s, host, path, url, unnest(regexp_extract_all(html, '<meta\b[^>]*>', 0, 'is')) AS tag FROM own WHERE node IS NOT NULL),
    rels AS (SELECT *, regexp_extract(tag, '[\s"''/]rel\s*=\s*("[^">]*"|''[^''>]*''|[^"''>\s]+)', 1, 'is') AS rel FROM links),
    tags AS (SELECT node, s, host, path, url, regexp_extract(tag, '[\s"''/]href\s*=\s*["'']?([^"''>\s]+)', 1, 'is') AS raw FROM rels
        WHERE list_contains(string_split_regex(lower(regexp_replace(rel, '["'']', '', 'g')), '\s+'), 'canonical')
        UNION ALL SELECT node, s, host, path, url, regexp_extract(tag, '\burl\s*=\s*["'']?([^"''>\s]+)', 1, 'is') FROM metas
        WHERE regexp_matches(tag, '[\s"''/]http-equiv\s*=\s*["'']?\s*refresh\b', 'is')),
    targets AS (SELECT node, s, host, path, url, replace(raw, '&amp;', '&') AS t FROM tags WHERE raw != ''),
    linked AS (SELECT node, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN t LIKE '//%' THEN s || ':' || t
        WHEN t LIKE '/%' THEN s || '://' || host || t WHEN t LIKE '?%' THEN s || '://' || host || path || t
        WHEN t LIKE '#%' THEN url
        ELSE s || '://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || t END AS target FROM targets),
    edge AS (SELECT node AS a, lower(regexp_extract(target, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 1, 's')) || '://' ||
        translate(regexp_extract(target, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 2, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ||
        regexp_extract(target, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 3, 's') ||
        regexp_extract(target, '^(.*?)://([^/?#]*)([^?#]*)([^#]*)', 4, 's') AS b FROM linked WHERE target IS NOT NULL),
    both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
    nodes AS (SELECT node, regexp_extract(node, '://([^/?#]*)', 1) AS host, regexp_extract(node, '://[^/?#]*([^?#]*)', 1) AS path
        FROM (SELECT node FROM own WHERE node IS NOT NULL UNION SELECT b FROM edge)),
    ruled AS (SELECT n.node, arg_min(r.host || r.path, (-length(r.host || r.path), r.host || r.path)) AS rule,
        arg_min(r.verdict, (-length(r.host || r.path), r.host || r.path)) AS verdict FROM nodes n JOIN rules r
        ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path) AND n.host != '' GROUP BY n.node),
    reach AS (SELECT node, verdict FROM ruled UNION SELECT e.b, r.verdict FROM reach r JOIN both_ways e ON e.a = r.node),
    settled AS (SELECT node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM reach GROUP BY node)
    SELECT o.page_id, o.host, o.path, r.rule, coalesce(r.verdict, s.verdict, 'allow') AS verdict
    FROM own o LEFT JOIN ruled r ON r.node = o.node LEFT JOIN settled s ON s.node = o.node""")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return aliases.judge(table(spark, sf, "pages"), aliases.rule_table(spark, RULES))


@query("op10_quality")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", held_out().alias("held_out"))
    labels = table(spark, sf, "labels").where(~held_out())
    model = quality.fit(docs.where("NOT held_out"), labels)
    scored = quality.score(docs, model).select("doc_id", "held_out", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op7_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers as vocabularies

    path, pattern = vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN
    return packing.pack(packing.pieces(table(spark, sf, "documents"), path, pattern))


@query("op4_decontamination", r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM documents),
    b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM benchmark),
    bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
    dw AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
    m AS (SELECT r, s, k, item_id FROM dw JOIN bw USING (k, g)),
    h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + k)) AS p FROM m) GROUP BY r),
    i AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)""")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))[0]


@query("op6_substring_dedup", r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '') AS w
        FROM documents),
    g AS (SELECT doc_id, r, s, array_to_string(w[s:s + 19], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
    late AS (SELECT r, s FROM (SELECT r, s, rank() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM g) WHERE k > 1),
    gone AS (SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(s, s + 20)) AS p FROM late) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w
        ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256 FROM d LEFT JOIN gone USING (r)""")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.remove_repeated(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_nearest_neighbours")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return curves.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_suffix_dedup", """
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT r, doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS g
        FROM (SELECT *, unnest(range(0, length(h) // 2 - 99)) AS s FROM d WHERE length(h) >= 200)),
    late AS (SELECT r, s FROM (SELECT r, s, rank() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
    runs AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS run FROM (
        SELECT r, s, (s - coalesce(lag(s) OVER (PARTITION BY r ORDER BY s), -1000) > 100)::INT AS fresh FROM late)),
    spans AS (SELECT r, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY r, run),
    gaps AS (SELECT s.r, a, b, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY s.r ORDER BY a), 0) + 1,
        2 * (a - coalesce(lag(b) OVER (PARTITION BY s.r ORDER BY a), 0))) AS part FROM spans s JOIN d USING (r)),
    cut AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(part, '' ORDER BY a) AS kept FROM gaps GROUP BY r)
    SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
        sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256 FROM d LEFT JOIN cut USING (r)""")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.remove_repeated(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_mixing", r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || substr(md5('13:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
        [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w FROM d GROUP BY source),
    o AS (SELECT *, coalesce(sum(cap) OVER before, 0)::BIGINT AS caps, coalesce(sum(w) OVER before, 0)::BIGINT AS ws
        FROM s WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    x AS (SELECT *, ((SELECT sum(source_size) FROM s)::BIGINT - caps) / ((SELECT sum(w) FROM s)::BIGINT - ws) AS x FROM o),
    t AS (SELECT source, source_size, least(cap::DOUBLE, w * (SELECT min_by(x, (cap / w, source IS NULL, source)) FROM x WHERE x <= cap / w)) AS target
        FROM x),
    r AS (SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size::BIGINT AS size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
        + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken FROM r""")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).drop("source")


@query("op12_conversation_trie", r"""
    WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, max(pos) AS n, conv_id - conv_id % 5 AS base, xor(list_reduce(list_transform(
            [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda x: x),
            lambda a, x: list_reduce([xor(a, x)] || range(8), lambda s, i: xor(s >> 1, (s & 1) * 3988292384))), 4294967295) % 9 AS h
        FROM t GROUP BY conv_id),
    r AS (SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
        UNION ALL
        SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
            LEFT JOIN c b ON b.conv_id = c.base),
    l AS (SELECT c.conv_id, coalesce(max(pos), 0) AS len FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
    p AS (SELECT conv_id, pos AS depth, octet_length(encode(text)) AS bytes,
            list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM r
        UNION ALL SELECT conv_id, 0, 0, [] FROM l),
    g AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len), '') AS ends FROM p JOIN l USING (conv_id) GROUP BY depth, path),
    k AS (SELECT g.depth, g.path, count(x.depth) AS n_children FROM g LEFT JOIN g x ON x.depth = g.depth + 1 AND x.path[1:len(x.path) - 1] = g.path
        GROUP BY g.depth, g.path),
    up AS (SELECT a AS depth, path[1:a] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n - 1) * bytes)::BIGINT AS saved
        FROM (SELECT g.*, k.n_children, unnest(range(0, g.depth + 1)) AS a FROM g JOIN k USING (depth, path)) GROUP BY 1, 2)
    SELECT g.conv_id, g.depth, o.conv_id AS parent_conv_id, g.n AS n_convs, k.n_children, up.n_leaves, up.saved AS saved_tokens, sha256(g.ends) AS ends_sha256
    FROM g JOIN k USING (depth, path) JOIN up USING (depth, path) LEFT JOIN g o ON o.depth = g.depth - 1 AND o.path = g.path[1:g.depth - 1]""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return tries.conversation_trie(table(spark, sf, "conversations"))


@query("op11_lexical_search", r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts FROM documents),
    i AS (SELECT item_id, row_number() OVER () AS i, list_distinct(list_transform(regexp_extract_all(coalesce(text, ''),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS ts FROM benchmark),
    c AS (SELECT count(*)::BIGINT AS N, sum(len(ts))::BIGINT AS L FROM d WHERE len(ts) > 0),
    m AS (SELECT r, doc_id, 10 + (90 * len(ts) * N) // L AS m FROM d, c WHERE len(ts) > 0),
    tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
    w AS (SELECT t, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY t, N),
    s AS (SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM (SELECT i, item_id, unnest(ts) AS t FROM i) JOIN w USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY i, item_id, r, doc_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10""")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
