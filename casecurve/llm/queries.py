"""The operators' named queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.llm import (
    fingerprints,
    line_dedup,
    packing,
    pieces,
    planes,
    prefix_trie,
    quality,
    sharding,
    simhash,
    suffixes,
    url_filter,
    vector_codes,
    warc,
)
from casecurve.llm.common import documents, saved_table, table
from casecurve.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


_RULES_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r),
measured AS (
  SELECT d.r, d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(d.text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(w.lines) - len(list_distinct(w.lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(w.lines) AS n_lines,
         length(regexp_replace(d.text, '[^\\p{Lu}]', '', 'g')) AS n_upper,
         length(regexp_replace(d.text, '[^\\p{Lu}\\p{Ll}]', '', 'g')) AS n_letters
  FROM docs d JOIN words w USING (r) LEFT JOIN covered c USING (r)),
failed AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
    + 32 * (word_chars > 20 * n_words)::INT + 64 * (n_letters > 0 AND 2 * n_upper > n_letters)::INT AS BIGINT) AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed = 0 AS kept, failed
FROM failed
"""


@query(_RULES_SQL)
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's measurements, failed rules and verdicts of the base and the full policy, from the stored ledger."""
    rows = saved_table(quality.ledger(documents(spark, folder)), "ledger")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality.rejected(quality.BASE).alias("base_failed"),
        (~quality.rejected(quality.FULL)).alias("kept"),
        "failed",
    )


@query(
    f"""
WITH ledger AS ({_RULES_SQL}),
rules(version, mask, rule, bit) AS (VALUES {", ".join(f"({p.version}, {p.mask}, '{name}', {bit})" for p in (quality.BASE, quality.FULL) for name, bit in quality.BIT.items() if p.mask & bit)})
SELECT version, rule, count(*) FILTER (failed & bit <> 0) AS n_failed, count(*) FILTER (failed & mask = bit) AS n_alone,
       count(*) FILTER (failed & mask <> 0) AS n_rejected
FROM ledger, rules GROUP BY version, rule
"""
)
def quality_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of the stored policies rejects, and rejects alone, over the stored ledger of all documents."""
    path = scratch_path(spark, "policies")
    quality.store_policies(spark, path, [quality.BASE, quality.FULL])
    rows = saved_table(quality.ledger(documents(spark, folder)).select("failed"), "ledger")
    return quality.ablation(rows, quality.load_policies(spark, path))


@query()
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, folder)).drop("text")


@query()
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, folder), map_path=scratch_path(spark, "map"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


@query(
    """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, i, lines[i] AS line
          FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, s.key IS NOT NULL AND s.keeper <> k.doc_id AS dropped FROM keyed k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.line_dedup(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_digest(packing.packed(documents(spark, folder)))


def packed_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


@query()
def op1_lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared_with_edits(documents(spark, folder))


@query()
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's piece ids and the text they decode to, as checksums."""
    model = pieces.piece_bpe_path()
    found = pieces.encoded(documents(spark, folder), model)
    text = pieces.decoded(F.col("ids"), pieces.Vocabulary.of(model))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(text, 256).alias("decoded_sha256"),
        (text == F.col("text")).alias("round_trip"),
    )


@query()
def op5_plane_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    files = planes.write_ids(docs, scratch_path(spark, "planes"))
    return planes.read_ids(files, docs.schema["doc_id"].dataType.simpleString(), digest_only=True).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32"
    )


@query(
    """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
h AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS head FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head = page_id THEN NULL ELSE head END AS refers_to
FROM h
"""
)
def op7_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write_bundles(table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return warc.read_records(index).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The same training spelled out round by round over (vector, part) rows."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT p.r, p.part, b.entry, p.n + b.n - 2 * list_dot_product(p.x, b.x) AS d FROM p JOIN b{k} b USING (part)) GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (
  SELECT part, entry, list(c ORDER BY i) AS x FROM (
    SELECT part, best.e AS entry, i, floor(sum(x[i]) / count(*)) AS c
    FROM (SELECT part, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{k} JOIN p USING (r, part)) GROUP BY ALL) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (
  SELECT part, entry, x, list_dot_product(x, x) AS n FROM (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry)))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
p AS MATERIALIZED (
  SELECT r, vec_id, part, x, list_dot_product(x, x) AS n FROM (
    SELECT r, vec_id, part, x[part * len(x) // 4 + 1 : (part + 1) * len(x) // 4] AS x
    FROM (SELECT *, unnest(range(4)) AS part FROM v))),
b0 AS MATERIALIZED (
  SELECT part, entry, x, n FROM (
    SELECT part, x, n, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 256),
{",".join(steps)},
books AS (
  SELECT sha256(string_agg(CAST(c AS BIGINT), ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, x[i] AS c, i FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM b{rounds}))),
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN v USING (r), books
"""


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.product_codes(table(spark, folder, "embeddings"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


TRIE_GROUP, TRIE_TURNS = 100, 6

# The checksum bit by bit: DuckDB has no function for it.
_CRC32_SQL = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(t) + 1), lambda i: ord(t[i])::BIGINT),
    lambda c, x: list_reduce([xor(c, x)] || range(8)::BIGINT[], lambda b, _: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295)"""


@query(
    f"""
WITH own AS MATERIALIZED (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT conv_id, turns, {_CRC32_SQL} % 6 AS h FROM (SELECT *, CAST(conv_id AS VARCHAR) AS t FROM own)),
built AS MATERIALIZED (
  SELECT c.conv_id, coalesce(s.turns[1:h], []) || c.turns[h + 1:] AS turns
  FROM cut c LEFT JOIN own s ON s.conv_id = c.conv_id - c.conv_id % {TRIE_GROUP}),
steps AS MATERIALIZED (SELECT conv_id, turns, d, turns[1:d] AS node FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM built)),
nodes AS MATERIALIZED (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(turns) = d), '')) AS ends_sha256
  FROM steps GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS MATERIALIZED (
  SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * length(n.node[d].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids k ON k.node = n.node),
sums AS (
  SELECT node[1:a] AS node, CAST(sum((n_children = 0)::INT) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]
"""
)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    lists = saved_table(prefix_trie.turn_lists(table(spark, folder, "conversations")), "turns")
    shared = (F.crc32(F.col("conv").cast("string").cast("binary")) % TRIE_TURNS).cast("int")
    return prefix_trie.prefix_trie(prefix_trie.regrown(lists, TRIE_GROUP, shared))


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
# Hosts whose pages make up the list of URLs, in both dialects of regular expressions.
UNWANTED_HOST = "(^|[.-])(adult|ads|bets|casino|pills)([.-])"

_PARTS_SQL = r"""
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^#]*?\?([^#]*)', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|\z)'))) AS query
  FROM pages"""


@query(
    rf"""
WITH parts AS ({_PARTS_SQL}),
named AS (
  SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+\z', '') ||
    CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM named WHERE regexp_matches(host, '{UNWANTED_HOST}') AND canonical IS NOT NULL),
rules(rule, verdict, host, path) AS (
  VALUES {", ".join(f"('{r.name}', '{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}),
ruled AS (
  SELECT n.*, (SELECT max(struct_pack(l := length(r.rule), rule := r.rule, verdict := r.verdict)) FROM rules r
               WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)) AS best FROM named n)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled r LEFT JOIN listed l ON l.canonical = r.canonical
"""
)
def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, against the rules and the URLs found on hosts with an unwanted word in their names."""
    pages = table(spark, folder, "pages")
    listed = pages.filter(url_filter.host(F.col("url")).rlike(UNWANTED_HOST))
    return url_filter.judged(pages, URL_RULES, listed)
