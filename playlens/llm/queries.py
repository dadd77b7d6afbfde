"""Registered queries of the corpus operators: each applies its operator to the whole of its table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playlens.llm.urls import BLOCKED

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            CHECKS[name] = sql
        return fn
    return keep


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op9_suffix_array_dedup", """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), g AS (
    SELECT doc_id, i, md5(array_slice(b, i, i + 199)) AS k FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM b WHERE octet_length(b) >= 200)
), hit AS (
    SELECT doc_id, i FROM g JOIN (SELECT k FROM g GROUP BY 1 HAVING count(*) > 1) USING (k)
), run AS (  -- runs of window starts at most 200 apart are one span
    SELECT doc_id, min(i) AS low, max(i) + 199 AS high FROM (
        SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM hit)) GROUP BY doc_id, run
), gap AS (
    SELECT doc_id, high + 1 AS low, lead(low, 1, n + 1) OVER (PARTITION BY doc_id ORDER BY low) - 1 AS high FROM run JOIN (SELECT doc_id, octet_length(b) AS n FROM b) USING (doc_id)
    UNION ALL SELECT doc_id, 1, coalesce(first - 1, octet_length(b)) FROM b LEFT JOIN (SELECT doc_id, min(low) AS first FROM run GROUP BY 1) USING (doc_id)
), kept AS (
    SELECT doc_id, string_agg(hex(array_slice(b, low, high)), '' ORDER BY low) AS kept FROM gap JOIN b USING (doc_id) WHERE high >= low GROUP BY 1
)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(r.n_removed, 0)::BIGINT AS n_removed, coalesce(r.n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, sum(high - low + 1) AS n_removed, count(*) AS n_spans FROM run GROUP BY 1) r USING (doc_id)
""")
def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.suffixes import strip_repeats

    return strip_repeats(read(spark, folder, "documents")).drop("kept")


@query("op1_substring_dedup", """
WITH w AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents)
), g AS (
    SELECT doc_id, i, md5(string_agg(word, ' ') OVER d) AS k, count(*) OVER d AS n FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM g WHERE n = 20) WHERE n > 1
), gone AS (SELECT DISTINCT doc_id, i + d AS i FROM later, range(20) t(d)
), n AS (SELECT doc_id, count(*) AS n_words FROM w GROUP BY 1
), k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_words, 0) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
""")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.substrings import strip_substrings

    return strip_substrings(read(spark, folder, "documents")).drop("kept")


@query("op10_line_dedup", """
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents
), f AS (
    SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
    FROM l WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), w AS (
    SELECT doc_id, pos, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS run FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS n FROM w WHERE run IS NOT NULL) WHERE n > 1
), long AS (
    SELECT doc_id, line_no FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS n FROM f
        WHERE len(list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) >= 20) WHERE n > 1
), gone AS (
    SELECT DISTINCT f.doc_id, f.line_no FROM f JOIN later USING (doc_id) WHERE f.pos BETWEEN later.pos AND later.pos + 2 UNION SELECT doc_id, line_no FROM long
)
SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM f GROUP BY 1) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1) g USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS kept FROM l ANTI JOIN gone USING (doc_id, line_no) GROUP BY 1) k USING (doc_id)
""")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.lines import strip_lines

    return strip_lines(read(spark, folder, "documents")).drop("kept")


@query("op5_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.decontaminate import judged

    return judged(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query("op7_minhash_near_dedup", """
WITH RECURSIVE t AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS h FROM t
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * both_have >= 80 * (p.n + q.n - both_have)
), edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links), reach AS (
    SELECT x AS node, x AS seen FROM edges UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.seen
), low AS (SELECT node, min(seen) AS top FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(top, d.doc_id) AS component_id, d.doc_id = coalesce(top, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.node = d.doc_id
""")
def minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.neardup import near_duplicates

    return near_duplicates(read(spark, folder, "documents"), size=2)


def _like(glob: str) -> str:
    """A glob of the URL filter as a SQL condition on ``full``, the canonical URL."""
    pattern = "".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*|\*)", glob))
    return f"regexp_full_match(full_url, '(?s){pattern}')"


@query("op3_url_filters", f"""
WITH u AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), r AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM r
), f AS (SELECT *, '.' || host || path AS full_url,
    CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
         WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
         WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
         WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN {" OR ".join(map(_like, BLOCKED))} THEN 'block' ELSE 'allow' END AS verdict FROM f
""")
def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.urls import judged

    return judged(read(spark, folder, "pages"))


@query("op8_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.html import extracted

    return extracted(read(spark, folder, "pages"))


TOKENIZER = "byte_bpe_multi_50k.tiktoken"


@query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from playlens.llm.bpe import encoded

    return encoded(read(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, columns=("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


@query("op4_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.quality import judged

    return judged(read(spark, folder, "documents")).drop("lang")


@query("op6_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.langid import predicted

    return predicted(read(spark, folder, "documents"))


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds of centroid clustering spelled out; sums are exact, floors are taken by the remainder."""
    steps = ["""v AS (
    SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * x::DOUBLE) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""", f"c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, x AS c FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k}))"]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (
    SELECT vec_id, x, cluster, distance FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS n FROM (
            SELECT vec_id, x, cluster, list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS distance FROM v, c{i}))
    WHERE n = 1
)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
    SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2
), c{i + 1} AS (
    SELECT cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{i} GROUP BY 1) m USING (cluster)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


@query("op12_centroid_clustering", _clusters_sql())
def centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.centroids import clusters

    return clusters(read(spark, folder, "embeddings"))


@query("op11_conversation_prefix_trie", """
WITH ids AS (
    SELECT DISTINCT conv_id AS conv, conv_id - conv_id % 5 AS base, xor(list_reduce(
        [4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
        lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384 * (xor(crc, byte) & 1))), 4294967295) % 9 AS head
    FROM conversations WHERE conv_id IS NOT NULL
), t AS (
    SELECT conv_id AS conv, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item, strlen(coalesce(text, '')) AS bytes,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), taken AS (
    SELECT ids.conv, head, count(t.pos) AS taken FROM ids LEFT JOIN t ON t.conv = ids.base AND t.pos <= ids.head GROUP BY 1, 2
), turns AS (
    SELECT ids.conv, t.pos AS depth, item, bytes FROM ids JOIN t ON t.conv = ids.base AND t.pos <= ids.head
    UNION ALL SELECT t.conv, pos - head + taken, item, bytes FROM t JOIN taken USING (conv) WHERE pos > head
), prefix AS (
    SELECT conv, depth, bytes, sha256(string_agg(item, '') OVER (PARTITION BY conv ORDER BY depth)) AS k FROM turns
    UNION ALL SELECT conv, 0, 0, '' FROM ids
), node AS (
    SELECT k, depth, min(conv) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM prefix GROUP BY 1, 2
), member AS (
    SELECT conv, prefix.depth, conv_id FROM prefix JOIN node USING (k, depth)
), child AS (
    SELECT node.*, member.conv_id AS parent FROM node LEFT JOIN member ON member.conv = node.conv_id AND member.depth = node.depth - 1
), kids AS (
    SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM child WHERE parent IS NOT NULL GROUP BY 1, 2
), below AS (
    SELECT member.conv_id, member.depth, sum((node.n_convs - 1) * node.bytes) AS saved, count(*) FILTER (kids.n_children IS NULL) AS n_leaves
    FROM node LEFT JOIN kids USING (conv_id, depth) JOIN member ON member.conv = node.conv_id AND member.depth <= node.depth GROUP BY 1, 2
), tips AS (
    SELECT conv_id, depth, string_agg(conv::VARCHAR, ',' ORDER BY conv) AS list
    FROM member JOIN (SELECT conv, max(depth) AS depth FROM prefix GROUP BY 1) USING (conv, depth) GROUP BY 1, 2
)
SELECT conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    saved::BIGINT AS saved_tokens, sha256(coalesce(list, '')) AS ends_sha256
FROM child LEFT JOIN kids USING (conv_id, depth) JOIN below USING (conv_id, depth) LEFT JOIN tips USING (conv_id, depth)
""")
def conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.trie import prefix_trie

    return prefix_trie(read(spark, folder, "conversations"))


@query("op13_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    from playlens.llm.lm import scored

    return scored(read(spark, folder, "documents"))
