"""One registered query per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from starloom.llm import alignment, decontam, lm, merkle, minhash, mixing, quality, rules, secrets, sharding, suffix, urls, warc
from starloom.llm.common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


MIX_SQL = r"""
WITH rows AS (
  SELECT source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
sizes AS (SELECT source, sum(size)::DOUBLE AS s FROM rows GROUP BY source),
ranked AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w FROM sizes),
timed AS (SELECT *, 2 * s AS cap, 2 * s / w AS t_out, 1.5 * sum(s) OVER () AS budget FROM ranked),
spent AS (SELECT *, sum(cap) OVER (ORDER BY t_out) + t_out * (sum(w) OVER () - sum(w) OVER (ORDER BY t_out)) <= budget AS is_out FROM timed),
ends AS (SELECT *, (budget - coalesce(sum(CASE WHEN is_out THEN cap END) OVER (), 0)) / sum(CASE WHEN NOT is_out THEN w END) OVER () AS t_end FROM spent),
targets AS (SELECT source, s, w, CASE WHEN is_out THEN cap ELSE t_end * w END AS target FROM ends),
queued AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix|' || coalesce(doc_id::VARCHAR, '')), doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM rows)
SELECT doc_id, size::BIGINT AS size, s::BIGINT AS source_size, target,
  (greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - start - s)))::BIGINT AS taken,
  ((start + size) / w)::DOUBLE AS virtual_finish
FROM queued JOIN targets ON queued.source IS NOT DISTINCT FROM targets.source
"""


@query(MIX_SQL)
def op1_mixing(spark, folder):
    return mixing.mixed_sizes(table(spark, folder, "documents"))


@query()
def op6_sharding(spark, folder):
    return sharding.shard_documents(table(spark, folder, "documents"))


LEAK_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
  FROM items WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM item_windows),
places AS (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS pos FROM words, lengths),
doc_windows AS (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS win FROM places),
hits AS (SELECT DISTINCT d.doc_id, d.pos, d.n, i.item FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.n = i.n),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query(LEAK_SQL)
def op8_decontamination(spark, folder):
    return decontam.contamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


RULES_SQL = (r"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT *, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM words),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS pos FROM words),
windows AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 7], ' ') AS win FROM places),
twice AS (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS p FROM twice WHERE c > 1) GROUP BY doc_id),
counted AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: list_contains(@STOP, lower(x))))::BIGINT AS n_stop_words,
  length(regexp_replace(t, '[^\p{Lu}]+', '', 'g'))::BIGINT AS n_upper
  FROM lines LEFT JOIN repeated USING (doc_id)),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(word_chars / nullif(n_words, 0), 0) BETWEEN 2.0 AND 20.0 AND coalesce(n_symbols / nullif(word_chars, 0), 0) <= 0.1
  AND coalesce(n_stop_words / nullif(n_words, 0), 0) >= 0.02 AND coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.5
  AND coalesce(n_upper / nullif(word_chars, 0), 0) <= 0.5 AS kept
FROM based
""").replace("@STOP", "[" + ", ".join(f"'{w}'" for w in sorted(set(rules.STOP_WORDS))) + "]")


@query(RULES_SQL)
def op9_quality_rules(spark, folder):
    judged = rules.quality_rules(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op4_url_filter(spark, folder):
    return urls.judge_urls(table(spark, folder, "pages"))


WARC_SQL = r"""
WITH rows AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
sums AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM rows),
kept AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS k FROM sums)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < k THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < k THEN k END AS refers_to FROM kept
"""


@query(WARC_SQL)
def op5_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages")).drop("url")


@query()
def op2_quality_classifier(spark, folder):
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op7_minhash(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op10_suffix_dedup(spark, folder):
    return suffix.repeat_report(table(spark, folder, "documents"))


@query()
def op3_lm_scoring(spark, folder):
    return lm.score_texts(table(spark, folder, "documents"))


MANIFEST_SQL = r"""
WITH RECURSIVE fields AS (SELECT lang, doc_id, doc_id::VARCHAR AS a, source AS b, lang AS c, n_chars, text FROM documents),
coded AS (
  SELECT *, coalesce(octet_length(encode(a)) || ':' || a, '-') || coalesce(octet_length(encode(b)) || ':' || b, '-') || coalesce(octet_length(encode(c)) || ':' || c, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
    list_reduce([4294967295::BIGINT] || list_transform(range(1, coalesce(length(a), 0) + 1), lambda i: ascii(a[i])::BIGINT),
      lambda crc, x: list_reduce([xor(crc, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))) AS crc FROM fields),
leaves AS (
  SELECT lang, doc_id, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0
      THEN sha256(head || coalesce(length((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS other FROM coded),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT lang, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2),
subroots AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS (
  SELECT a.lang, a.lvl, a.pos, b.h, b.pos < a.pos AS on_left FROM nodes a LEFT JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND b.pos = xor(a.pos, 1) WHERE a.n > 1),
top_steps AS (SELECT a.lvl, a.pos, b.h, b.pos < a.pos AS on_left FROM top a LEFT JOIN top b ON a.lvl = b.lvl AND b.pos = xor(a.pos, 1) WHERE a.n > 1),
heights AS (SELECT lang, max(lvl) AS height FROM nodes GROUP BY lang),
walk AS (
  SELECT p.lang, p.pos, 0 AS lvl, p.pos AS at, coalesce(other, leaf) AS fold, '' AS proof FROM placed p
  UNION ALL
  SELECT w.lang, w.pos, w.lvl + 1, w.at // 2, sha256(CASE WHEN s.h IS NULL THEN w.fold WHEN s.on_left THEN s.h || w.fold ELSE w.fold || s.h END), w.proof || coalesce(s.h, '')
  FROM walk w JOIN steps s ON w.lang IS NOT DISTINCT FROM s.lang AND w.lvl = s.lvl AND w.at = s.pos),
inner_end AS (SELECT w.* FROM walk w JOIN heights t ON w.lang IS NOT DISTINCT FROM t.lang AND w.lvl = t.height),
outer_walk AS (
  SELECT e.lang, e.pos, 0 AS lvl, s.pos AS at, fold, proof FROM inner_end e JOIN subroots s ON e.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT w.lang, w.pos, w.lvl + 1, w.at // 2, sha256(CASE WHEN s.h IS NULL THEN w.fold WHEN s.on_left THEN s.h || w.fold ELSE w.fold || s.h END), w.proof || coalesce(s.h, '')
  FROM outer_walk w JOIN top_steps s ON w.lvl = s.lvl AND w.at = s.pos),
ended AS (SELECT * FROM outer_walk WHERE lvl = (SELECT max(lvl) FROM top))
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.fold AS folded_root, e.fold = r.h AS verified
FROM placed p JOIN ended e ON p.lang IS NOT DISTINCT FROM e.lang AND p.pos = e.pos JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang, (SELECT h FROM top WHERE n = 1) r
"""


@query(MANIFEST_SQL)
def op11_merkle_manifest(spark, folder):
    return merkle.manifest_report(table(spark, folder, "documents"))


@query()
def op12_secret_scan(spark, folder):
    return secrets.secret_report(table(spark, folder, "documents"))


@query()
def op13_token_alignment(spark, folder):
    return alignment.alignment_report(table(spark, folder, "documents"))
