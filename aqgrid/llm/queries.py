"""The queries of this subpackage, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqgrid.llm import decontamination, html_extract, language_id, ngram_join, packing, prefix_hashes, prefix_trie, quality_rules, secret_scan, substring_dedup, turn_repair, url_filter, warc
from aqgrid.llm.url_filter import UrlRule

Query = Callable[[SparkSession, str], DataFrame]

# The url rules of the query.
URL_RULES = [
    UrlRule("allow", "com"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = language_id.training_rows(docs)
    model = language_id.train(docs, learn)
    out = language_id.identify(docs.select("doc_id", "text"), model).drop("text")
    return out.select("doc_id", (~language_id.training_rows(out)).alias("held_out"), "lang_pred", "score")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(turn_repair.damage(table(spark, sf_dir, "conversations")), present="here")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hashes.neighbours(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuild(prefix_trie.places(table(spark, sf_dir, "conversations"))))


_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    list_filter(string_split(translate(lower(t), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ',.;:!?"()', repeat(' ', 14)), ' '), lambda x: x IN ({_STOP})) AS sw
  FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
rep AS (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT win.r, unnest([i, i + 1, i + 2]) AS p FROM win JOIN rep USING (r, g)) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    len(ls) AS n_lines, len(sw) AS n_stop, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters
  FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND coalesce(n_symbols / nullif(word_chars, 0) <= 0.25, true)
    AND coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true)
    AND coalesce(word_chars / nullif(n_words, 0) BETWEEN 1.5 AND 20.0, true)
    AND coalesce(n_letters / nullif(word_chars, 0) >= 0.4, true)
    AND coalesce(n_stop / nullif(n_words, 0) >= 0.005, true) AS kept
FROM b
"""

OP5_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM d)),
f AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
r AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 12)) AS p FROM w JOIN f USING (g) WHERE doc_id > least)),
g AS (SELECT doc_id, list(p) AS ps FROM r GROUP BY doc_id),
k AS (SELECT doc_id, ws, CASE WHEN ps IS NULL THEN ws ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda p: NOT list_contains(ps, p)), lambda p: ws[p]) END AS kept FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(kept) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""

OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM d)
    UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
c AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, c.c FROM c JOIN l USING (a))
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(c) AS c FROM c GROUP BY a) m USING (doc_id)
"""

OP10_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM k
"""

OP3_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
h AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM s),
j AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""

def crc32_sql(text: str) -> str:
    """CRC-32 (polynomial 0xEDB88320, bits reversed) of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(a & 255, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda z: ord(z)::BIGINT), lambda a, b: xor(a >> 8, {byte})), 4294967295)"


OP11_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS how
  FROM conversations),
e AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE how WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM d WHERE how <> 0),
f AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS ini, left(lag(role) OVER w, 1) AS before,
    NOT regexp_matches(text, '[^ 	-
]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
g AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT seen AND NOT blank) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
ins(p, k, q) AS (VALUES ('0', 0, '0'), ('0', 1, 'u'), ('0', 2, 'a'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'), ('u', 0, 'u'), ('u', 1, 'a'), ('a', 0, 'a'), ('a', 1, 'u')),
due(q, role) AS (VALUES ('0', 'user'), ('s', 'user'), ('a', 'user'), ('u', 'assistant')),
more AS (SELECT p, k, ins.q, repeat('I', k) AS letters, CASE k WHEN 0 THEN [] WHEN 1 THEN [role || ':'] ELSE ['user:', 'assistant:'] END AS lines FROM ins JOIN due ON due.q = p),
best AS (
  SELECT conv_id, 0::BIGINT AS i, '0' AS p, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, p, least.cost, least.audit, least.lines FROM (
    SELECT conv_id, i, p, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS least FROM (
      SELECT b.conv_id, f.i, b.cost + 2 * m.k + o.cost AS cost, b.audit || m.letters || o.letter AS audit, o.p,
        b.lines || m.lines || CASE o.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [u.role || ':' || f.text] END AS lines
      FROM best b JOIN more m ON m.p = b.p JOIN due u ON u.q = m.q JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1,
        LATERAL (SELECT unnest([
          {{'letter': 'D', 'cost': 3, 'p': m.q, 'ok': true}},
          {{'letter': 'K', 'cost': f.cut::INT, 'p': f.ini, 'ok': NOT (f.blank OR f.seen) AND (f.ini = left(u.role, 1) OR f.ini = 's' AND m.q = '0')}},
          {{'letter': 'R', 'cost': 2 + f.cut::INT, 'p': left(u.role, 1), 'ok': NOT (f.blank OR f.seen)}}]) AS o) x
      WHERE o.ok) GROUP BY conv_id, i, p)),
z AS (
  SELECT conv_id, min({{'cost': b.cost + 2 * m.k, 'audit': b.audit || m.letters, 'lines': b.lines || m.lines}}) AS least
  FROM best b LEFT JOIN g USING (conv_id) JOIN more m ON m.p = b.p AND m.q IN ('0', 'a') WHERE b.i = coalesce(g.n, 0) GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  least.cost AS cost, least.audit AS audit, sha256(coalesce(array_to_string(least.lines, chr(10)), '')) AS repaired_sha256
FROM z LEFT JOIN g USING (conv_id)
"""

OP13_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS base, {crc32_sql("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
b AS (
  SELECT h.c, 0 AS part, i, role, text FROM h JOIN t ON t.c = h.base AND i <= h
  UNION ALL SELECT h.c, 1, i, role, text FROM h JOIN t ON t.c = h.c AND i > h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, len(role) || ':' || role || text AS turn, len(text) AS chars FROM b),
l AS (SELECT h.c, count(d) AS len FROM h LEFT JOIN s USING (c) GROUP BY h.c),
p AS (
  SELECT c, 0::BIGINT AS d, '' AS k, 0::BIGINT AS chars FROM h
  UNION ALL SELECT c, d, sha256(string_agg(len(turn) || ',' || turn, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)), chars FROM s),
n AS (SELECT k, min(c) AS c, any_value(d) AS d, any_value(chars) AS chars, count(*) AS n FROM p GROUP BY k),
e AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM p JOIN l USING (c) WHERE d = len GROUP BY k),
q AS (SELECT n.*, m.c AS parent FROM n LEFT JOIN p ON p.c = n.c AND p.d = n.d - 1 LEFT JOIN n m ON m.k = p.k),
kids AS (SELECT parent AS c, d - 1 AS d, count(*) AS kids FROM q WHERE parent IS NOT NULL GROUP BY ALL),
v AS (SELECT q.*, coalesce(kids, 0) AS kids FROM q LEFT JOIN kids USING (c, d)),
sub AS (
  SELECT p.k, count(*) FILTER (v.kids = 0) AS leaves, sum((v.n - 1) * v.chars) AS saved
  FROM v JOIN p ON p.c = v.c AND p.d <= v.d GROUP BY p.k)
SELECT v.c AS conv_id, v.d AS depth, v.parent AS parent_conv_id, v.n AS n_convs, CAST(v.kids AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM v JOIN sub USING (k) LEFT JOIN e USING (k)
"""

QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_filter": op3_url_filter,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_html_extract": op7_html_extract,
    "op8_language_id": op8_language_id,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_turn_repair": op11_turn_repair,
    "op12_fingerprints": op12_fingerprints,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op3_url_filter": OP3_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_ngram_join": OP6_SQL,
    "op10_warc": OP10_SQL,
    "op11_turn_repair": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
