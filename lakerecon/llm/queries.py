"""The registered queries of this subpackage, and the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerecon.llm import (
    arc, bottomk, chat, factorisation, line_dedup, lm_scoring, lsa, mixing, prefix_trie, rule_ledger, string_kernel, url_filter, word_runs
)
from lakerecon.llm.frames import cut, remainder
from lakerecon.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op1_log_frequency_lm(spark: SparkSession, sf: str) -> DataFrame:
    documents, tenth = _table(spark, sf, "documents"), remainder("doc_id", 10)
    found = lm_scoring.score(documents, lm_scoring.train(documents.filter(tenth != 0)))
    return found.select("doc_id", (tenth == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_arc_to_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as ARC archives of both versions, converted to WARC, and the WARC archives read back."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), size.cast("string"),
        F.coalesce(F.concat(F.lit("\r\nX-Page-Id: "), F.col("page_id").cast("string")), F.lit("")), F.lit("\r\n\r\n"),
    )
    contents = _table(spark, sf, "pages").select(
        F.col("page_id"), "url", F.lit("20240101000000").alias("date"), F.lit("text/html").alias("content_type"),
        F.concat(head, F.coalesce("html", F.lit(""))).cast("binary").alias("body"),
    )
    odd = F.coalesce(F.col("page_id") % 2 != 0, F.lit(False))
    archives = arc.pack(contents.filter(odd), "pages", 1).union(arc.pack(contents.filter(~odd), "pages", 2))
    path = shared_dir(spark, "op2-warc")
    arc.convert(archives, arc.http_header("head", "X-Page-Id").cast("long"), path)
    read = arc.read_warc(spark, path, payloads=False).filter("type IN ('response', 'revisit')")
    found = cut(
        read.select(
            arc.http_header("head", "X-Page-Id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
            F.col("type").alias("record_type"), "record_id", F.col("refers_to").alias("target"),
        ),
        "op2-records",
    )
    targets = found.filter("record_type = 'response'").select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"))
    return found.join(targets, "target", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_perspective_rotation(spark: SparkSession, sf: str) -> DataFrame:
    found = chat.rotate(_table(spark, sf, "conversations"))
    return found.select(
        "conv_id",
        "perspective",
        F.col("block").cast("string").alias("block"),
        F.col("part").alias("part"),
        F.size("messages").cast("long").alias("n_messages"),
        "text",
        F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",").alias("assistant_spans"),
    )


def op5_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf, "pages"), rules)


def op6_factorisation_machine(spark: SparkSession, sf: str) -> DataFrame:
    documents, fifth = _table(spark, sf, "documents"), remainder("doc_id", 5)
    model = factorisation.fit(documents.filter(fifth != 0), _table(spark, sf, "labels"))
    found = factorisation.score(documents, model)
    predicted = F.when(F.col("score") >= factorisation.THRESHOLD, 1).otherwise(0)
    return found.select("doc_id", (fifth == 0).alias("held_out"), "score", predicted.cast("int").alias("predicted"))


def op7_rule_ledger(spark: SparkSession, sf: str) -> DataFrame:
    kept = rule_ledger.ledger(_table(spark, sf, "documents"))
    return kept.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rule_ledger.passes(rule_ledger.BASE)).alias("base_failed"),
        rule_ledger.passes(rule_ledger.POLICIES[rule_ledger.CURRENT]).alias("kept"),
        "fail_bits",
    )


def op8_latent_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return lsa.leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op9_string_kernel(spark: SparkSession, sf: str) -> DataFrame:
    documents, fourth = _table(spark, sf, "documents"), remainder("doc_id", 4)
    model = string_kernel.fit(documents.filter(fourth != 2), key=F.col("doc_id"))
    found = string_kernel.predict(documents, model)
    return found.select("doc_id", (fourth == 2).alias("held_out"), "lang_pred", "score")


def op10_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = bottomk.near_duplicates(_table(spark, sf, "documents"), width=2, percent=80)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, a tenth of which are made periodic from some word on, and their runs."""
    hashed = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    parts = _table(spark, sf, "documents").select(
        "doc_id", "text", F.floor(hashed / 10).alias("g"), F.when(hashed % 10 == 0, words).alias("words")
    )
    n = F.size("words")
    parts = parts.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    made = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", source(i).cast("int"))), " ")
    found = word_runs.find(parts.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text")))
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations that begin with turns of the first of each twenty, and their trie."""
    turns = prefix_trie.digest(_table(spark, sf, "conversations"))
    placed = cut(prefix_trie.numbered(turns), "op12-turns").withColumnRenamed("place", "turn")
    first = F.crc32(F.col("conv_id").cast("string")) % 4
    all_ids = placed.select("conv_id").distinct()
    opened = all_ids.select("conv_id", first.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    openings = placed.filter("turn < 3").withColumnRenamed("conv_id", "base").join(opened, "base").filter("turn < h")
    none = all_ids.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("id"), F.lit(None).cast("long").alias("tokens"))
    return prefix_trie.trie(placed.filter(F.col("turn") >= first).unionByName(openings.drop("base", "h")).unionByName(none))


def op13_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.drop(_table(spark, sf, "documents").select("doc_id", "text"), least_documents=10, least_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def registered() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit() and callable(f)}


def oracles() -> dict[str, str]:
    return {name: re.sub(r"CRC32\((\w+)\)", lambda m: _CRC32.format(m[1]), sql) for name, sql in SQL.items()}


SQL: dict[str, str] = {
    "op2_arc_to_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        m AS (SELECT html, max(page_id) AS first FROM p GROUP BY html)
        SELECT page_id, octet_length(encode(p.html)) AS payload_bytes, base32.digest AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN m ON p.html = m.html
        JOIN (
            SELECT html, (
                SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ('0b' || substr(bits, 5 * i + 1, 5))::INT + 1, 1), '' ORDER BY i)
                FROM range(32) AS r(i)
            ) AS digest
            FROM (SELECT html, (
                SELECT string_agg(lpad(bin(('0x' || substr(sha1(html), 2 * j + 1, 2))::INT), 8, '0'), '' ORDER BY j) FROM range(20) AS q(j)
            ) AS bits FROM m)
        ) AS base32 ON base32.html = p.html
    """,
    "op3_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, md5('1:' || coalesce(doc_id::VARCHAR, '')) AS key,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs,
                   [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
                   row_number() OVER (ORDER BY source NULLS LAST) AS place
            FROM d GROUP BY source
        ),
        l AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0))
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
            FROM s WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ),
        t AS (
            SELECT source, source_size, docs,
                   least(2.0::DOUBLE * source_size, weight * (
                       SELECT level FROM l WHERE level <= 2.0::DOUBLE * source_size / weight ORDER BY 2.0::DOUBLE * source_size / weight, place LIMIT 1
                   )) AS target
            FROM l
        ),
        e AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(least(target / source_size, 2.0) * 4294967296.0) ELSE 0 END::HUGEINT AS each,
                   ceil(docs / 8192.0)::BIGINT AS blocks,
                   ('0x' || substr(md5('1:' || coalesce('s' || source, 'n')), 1, 5))::HUGEINT * 4096 AS start
            FROM t
        ),
        p AS (
            SELECT d.doc_id, d.size, e.source_size, e.target, e.each, e.start, row_number() OVER (
                PARTITION BY d.source ORDER BY ('0x' || substr(d.key, 1, 8))::BIGINT % e.blocks, d.size, d.key) AS n
            FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
        )
        SELECT doc_id, size, source_size, target,
               (size * ((n * each + start) // 4294967296 - ((n - 1) * each + start) // 4294967296))::BIGINT AS taken
        FROM p
    """,
    "op4_perspective_rotation": r"""
        WITH m AS (
            SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS content, floor(turn / 256)::BIGINT AS block
            FROM conversations
        ),
        p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
        r AS (
            SELECT m.conv_id, perspective, block, turn, speaker, content, speaker = perspective AS mine,
                   '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user name=' || speaker END
                   || chr(10) AS head, content || '<|im_end|>' || chr(10) AS body
            FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
        ),
        n AS (
            SELECT *, sum(length(head) + length(body)) OVER (
                PARTITION BY conv_id, perspective, block ORDER BY turn NULLS FIRST, speaker, content ROWS UNBOUNDED PRECEDING) AS stop
            FROM r
        )
        SELECT conv_id, perspective, block::VARCHAR AS block, 0::BIGINT AS part, count(*) AS n_messages,
               string_agg(head || body, '' ORDER BY turn NULLS FIRST, speaker, content) AS text,
               coalesce(string_agg((stop - length(body))::BIGINT || '-' || (stop - 1)::BIGINT, ',' ORDER BY stop) FILTER (WHERE mine), '') AS assistant_spans
        FROM n GROUP BY conv_id, perspective, block
    """,
    "op5_url_filters": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ),
        p AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ),
        r(r_host, r_path, r_verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        f AS (
            SELECT page_id, arg_max(r_host || r_path, length(r_host) + length(r_path)) AS rule, arg_max(r_verdict, length(r_host) + length(r_path)) AS verdict
            FROM p JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY page_id
        )
        SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN f ON p.page_id = f.page_id
    """,
    "op7_rule_ledger": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ),
        w AS (SELECT doc_id, i, words[i:i + 2] AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2)),
        c AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS n FROM w) WHERE n > 1),
        t AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) AS o(j) GROUP BY doc_id),
        m AS (
            SELECT d.doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters,
                   length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals
            FROM d LEFT JOIN t ON d.doc_id = t.doc_id
        ),
        b AS (
            SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
                + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
                + CASE WHEN 100 * n_capitals > 50 * n_letters THEN 16 ELSE 0 END
                + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
            FROM m
        )
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
               n_repeat_words::BIGINT AS n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
        FROM b
    """,
    "op11_periodic_runs": r"""
        WITH c AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, CRC32(doc_id) AS h FROM documents
        ),
        g AS (
            SELECT doc_id, words, h, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM c
        ),
        m AS (
            SELECT doc_id, n, CASE WHEN a IS NULL THEN words
                ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS words
            FROM g
        ),
        w AS (SELECT doc_id, n, i, array_to_string(words[i + 1:i + 9], ' ') AS nine FROM (SELECT *, unnest(range(n - 8)) AS i FROM m WHERE n >= 24)),
        p AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w AS x JOIN w AS y ON x.doc_id = y.doc_id AND x.nine = y.nine AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
        s AS (
            SELECT doc_id, q, min(i) AS start, count(*) + 8 + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM p) GROUP BY doc_id, q, island
        ),
        r AS (
            SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= 24 AND length >= 3 * q GROUP BY doc_id, start, length
        ),
        b AS (
            SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256,
                   first(struct_pack(start, length, period) ORDER BY length::DOUBLE / period DESC, start, period) AS best
            FROM r GROUP BY doc_id
        ),
        d AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
        k AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
            FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM m) AS u
            WHERE NOT EXISTS (FROM d WHERE d.doc_id = u.doc_id AND d.i = u.i) GROUP BY doc_id
        )
        SELECT m.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
               (1000 * best.length) // best.period AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
               sha256(coalesce(kept, '')) AS collapsed_sha256
        FROM m LEFT JOIN b ON m.doc_id = b.doc_id LEFT JOIN k ON m.doc_id = k.doc_id
    """,
    "op12_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, CRC32(conv_id) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
        r AS (
            SELECT c.conv_id, 0 AS own, place, role, text FROM c JOIN t ON t.conv_id = c.base WHERE place < h
            UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE place >= h
        ),
        s AS (
            SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY own, place) FILTER (WHERE role IS NOT NULL), []) AS ids,
                   list(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) ORDER BY own, place) AS words
            FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
        ),
        m AS (
            SELECT conv_id, depth, array_to_string(ids[:depth], '') AS prefix, CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words, depth = len(ids) AS ends
            FROM (SELECT *, unnest(range(len(ids) + 1)) AS depth FROM s)
        ),
        n AS (
            SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM m GROUP BY prefix, depth
        ),
        k AS (SELECT left(prefix, 32 * (depth - 1)::INT) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
        x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.prefix = n.prefix),
        u AS (
            SELECT left(prefix, 32 * up::INT) AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS up FROM x) GROUP BY 1
        )
        SELECT x.conv_id, x.depth, n.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256
        FROM x JOIN u ON u.prefix = x.prefix LEFT JOIN n ON n.depth = x.depth - 1 AND n.prefix = left(x.prefix, 32 * (x.depth - 1)::INT)
    """,
    "op13_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
            FROM documents
        ),
        k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ),
        s AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE s.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN s ON s.key = k.key GROUP BY doc_id
    """,
}

#: DuckDB has no crc32: one byte after the other, eight divisions each, by the reversed polynomial 0xEDB88320.
_CRC32 = """(xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split({}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, _: xor(x >> 1, (x & 1) * 3988292384))
), 4294967295))"""
