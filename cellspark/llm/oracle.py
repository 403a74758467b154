"""DuckDB SQL for the training-data queries that SQL can express.

Language ID, both packings, the seeded shuffle and SimHash are not among them (a trained model, a tokenizer, a
random permutation, XXH64); their tests compare with brute force.
"""

from __future__ import annotations

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT r, doc_id, pos, min(doc_id) OVER (PARTITION BY k) AS least
      FROM (SELECT r, doc_id, pos, md5(x[pos + 1:pos + 50]) AS k
            FROM (SELECT r, doc_id, x, unnest(range(octet_length(x) - 49)) AS pos FROM d))),
h AS (SELECT r, pos, pos AS start FROM w WHERE least < doc_id),
b AS (SELECT r, pos, hex(x[pos + 1:pos + 1]) AS b FROM (SELECT r, x, unnest(range(octet_length(x))) AS pos FROM d)),
c AS (SELECT r, pos, b, coalesce(max(start) OVER (PARTITION BY r ORDER BY pos) > pos - 50, false) AS gone
      FROM b LEFT JOIN h USING (r, pos)),
s AS (SELECT *, lag(gone, 1, false) OVER (PARTITION BY r ORDER BY pos) AS before FROM c),
k AS (SELECT r, count_if(gone) AS n_removed, count_if(gone AND NOT before) AS n_spans,
             coalesce(string_agg(b, '' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM s GROUP BY r)
SELECT doc_id, octet_length(x)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP5 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, upper(sha1(body)) AS h FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top,
             list_transform(range(8), lambda g: ('0x' || substr(h, 5 * g + 1, 5))::BIGINT) AS parts FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda v:
         substr('{_BASE32}', (v // 32768) % 32 + 1, 1) || substr('{_BASE32}', (v // 1024) % 32 + 1, 1) ||
         substr('{_BASE32}', (v // 32) % 32 + 1, 1) || substr('{_BASE32}', v % 32 + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM m
"""

OP6 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT r, doc_id, pos, min(doc_id) OVER (PARTITION BY k) AS least
      FROM (SELECT r, doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS k
            FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM d))),
h AS (SELECT r, pos, pos AS start FROM w WHERE least < doc_id),
b AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d),
c AS (SELECT r, pos, word, coalesce(max(start) OVER (PARTITION BY r ORDER BY pos) > pos - 50, false) AS gone
      FROM b LEFT JOIN h USING (r, pos)),
k AS (SELECT r, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
      FROM c GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP7 = f"""
WITH rules(host, path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.action,
             row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC) AS n
      FROM u LEFT JOIN rules r
        ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM f WHERE n = 1
"""

OP8 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
             vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = f"""
WITH i AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
iw AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, least(len(words), 10) AS n,
              array_to_string(words[pos:pos + 9], ' ') AS key
       FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM i WHERE len(words) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
p AS (SELECT r, unnest(range(1, len(words) + 1)) AS pos FROM d),
h AS (SELECT r, pos, iw.n, iw.item
      FROM (SELECT r, pos, l.n, array_to_string(words[pos:pos + l.n - 1], ' ') AS key
            FROM p JOIN d USING (r), (SELECT DISTINCT n FROM iw) l WHERE pos + l.n - 1 <= len(words)) dw
      JOIN iw ON dw.n = iw.n AND dw.key = iw.key),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS place FROM h) GROUP BY r),
its AS (SELECT r, count(DISTINCT item) AS n_items, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

#: Levels that the SQL of the hash tree has: up to 8^7 leaves of a language and 8^2 languages.
_LEVELS, _TOP_LEVELS = 7, 2


def _framed(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _climb(level: int, group: str) -> str:
    """Nodes of a level with their siblings, and the next level; a lone node stays as it is."""
    return f"""
s{level} AS (SELECT *, n{level} > 1 AS many, p{level} // 8 AS run,
  coalesce(string_agg(d{level}, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(d{level}, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM t{level} WINDOW w AS (PARTITION BY {group}, p{level} // 8 ORDER BY p{level})),
t{level + 1} AS MATERIALIZED (SELECT {group}, run AS p{level + 1}, (n{level} + 7) // 8 AS n{level + 1},
  CASE WHEN many THEN sha256(d{level} || a) ELSE d{level} END AS d{level + 1} FROM s{level} WHERE p{level} % 8 = 0),"""


def _crc32(digits: str) -> str:
    """CRC-32 of a short ASCII text, one bit after the other."""
    byte = f"CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr({digits}, (i // 8)::BIGINT + 1, 1))::BIGINT) ELSE c END"
    step = f"list_transform([{byte}], lambda v: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)[1]"
    return f"xor(list_reduce(range(8 * strlen({digits})), lambda c, i: {step}, 4294967295::BIGINT), 4294967295)"


def _op13() -> str:
    fields = [_framed(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    up = "".join(_climb(k, "g") for k in range(_LEVELS))
    top = "".join(_climb(k, "h") for k in range(_LEVELS + 1, _LEVELS + 1 + _TOP_LEVELS))
    first, last = _LEVELS + 1, _LEVELS + 1 + _TOP_LEVELS
    joins, proof = "", []
    for k in range(_LEVELS):
        joins += f" JOIN s{k} ON s{k}.g = l.g AND s{k}.p{k} = l.p0 // {8**k}"
    joins += f" JOIN t{first} r ON r.g = l.g"
    for k in range(first, last):
        joins += f" JOIN s{k} ON s{k}.p{k} = r.p{first} // {8 ** (k - first)}"
    for k in [*range(_LEVELS), *range(first, last)]:
        proof.append(f"CASE WHEN s{k}.many THEN s{k}.b || s{k}.a ELSE '' END")
    return f"""
WITH l0 AS MATERIALIZED (SELECT doc_id, lang IS NULL AS x, coalesce(lang, '') AS y,
  sha256({' || '.join([*fields, _framed('text')])}) AS leaf,
  CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN sha256({' || '.join([*fields, _framed(lowered)])}) END AS tampered_leaf
  FROM documents),
l AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY x DESC, y) AS g,
  row_number() OVER (PARTITION BY x, y ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p0 FROM l0),
t0 AS (SELECT g, p0, count(*) OVER (PARTITION BY g) AS n0, leaf AS d0 FROM l),{up}
t{first} AS MATERIALIZED (SELECT 1 AS h, g, d{_LEVELS} AS d{first}, row_number() OVER (ORDER BY g) - 1 AS p{first},
  count(*) OVER () AS n{first} FROM t{_LEVELS}),{top}
o AS (SELECT doc_id, leaf, r.d{first} AS subroot, (SELECT d{last} FROM t{last}) AS root,
  sha256({' || '.join(proof)}) AS proof_sha256, coalesce(tampered_leaf, leaf) AS node,
  [{', '.join(f"{{'m': s{k}.many, 'b': s{k}.b, 'a': s{k}.a}}" for k in [*range(_LEVELS), *range(first, last)])}] AS path
  FROM l{joins}),
f AS (SELECT *, list_reduce(path, lambda d, s: {{'m': true, 'b': CASE WHEN s.m THEN sha256(s.b || d.b || s.a) ELSE d.b END, 'a': ''}},
  {{'m': true, 'b': node, 'a': ''}}).b AS folded_root FROM o)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f
"""


_NAME = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_TAIL = r"'([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z'"

OP11 = f"""
WITH RECURSIVE d0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32('(' + _NAME + ')')} % 20 AS fate FROM conversations),
d1 AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 0 THEN 0 WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy FROM d0),
d2 AS (SELECT *, coalesce(conv_id::VARCHAR, '') AS g, regexp_extract(text, {_TAIL}, 1) AS tail,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM d1),
d AS MATERIALIZED (SELECT *, substr(role, 1, 1) AS x, CASE WHEN tail = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY g ORDER BY n) AS before FROM d2),
c AS (SELECT g, count(*) AS n, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(n > 1 AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM d GROUP BY g),
w AS (
  SELECT g, 0::BIGINT AS n, '' AS st, 0 AS cost, '' AS audit, '' AS lines FROM c
  UNION ALL
  SELECT g, n, st, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY g, st ORDER BY cost, audit) AS best FROM (
      SELECT i.g, i.n + 1 AS n,
        CASE edit WHEN 'D' THEN i.st WHEN 'K' THEN d.x ELSE CASE i.st WHEN 'u' THEN 'a' ELSE 'u' END END AS st,
        i.cost + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
          + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
        i.audit || edit AS audit,
        i.lines || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || d.role || ':' || d.text
          ELSE chr(10) || CASE i.st WHEN 'u' THEN 'assistant:' ELSE 'user:' END || d.text END AS lines
      FROM (SELECT g, n, CASE WHEN NOT ins THEN st WHEN st = 'u' THEN 'a' ELSE 'u' END AS st,
              cost + CASE WHEN ins THEN 5 ELSE 0 END AS cost, audit || CASE WHEN ins THEN 'I' ELSE '' END AS audit,
              lines || CASE WHEN NOT ins THEN '' WHEN st = 'u' THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END AS lines
            FROM w, (VALUES (false), (true)) AS v(ins)) i
      JOIN d ON d.g = i.g AND d.n = i.n + 1, (VALUES ('D'), ('K'), ('R')) AS e(edit)
      WHERE edit = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR (d.x = 's' AND i.st = '')
        OR (d.x = 'u' AND i.st <> 'u') OR (d.x = 'a' AND i.st = 'u')))))
  WHERE best = 1),
z AS (SELECT w.g, w.cost + CASE st WHEN 'u' THEN 5 WHEN 's' THEN 10 ELSE 0 END AS cost,
    audit || CASE st WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END AS audit,
    lines || CASE st WHEN 'u' THEN chr(10) || 'assistant:' WHEN 's' THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE '' END AS lines
  FROM w JOIN c ON c.g = w.g AND c.n = w.n),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY cost, audit) AS best FROM z)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(r.cost, 0)::BIGINT AS cost, coalesce(r.audit, '') AS audit,
  sha256(coalesce(substr(r.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS g FROM conversations) o
LEFT JOIN c USING (g) LEFT JOIN (SELECT * FROM r WHERE best = 1) r USING (g)
"""


ORACLE_SQL: dict[str, str] = {
    "op4_suffix_array_dedup": OP4,
    "op5_warc": OP5,
    "op6_substring_dedup": OP6,
    "op7_url_filters": OP7,
    "op8_exact_top_k": OP8,
    "op9_decontamination": OP9,
    "op11_conversation_repair": OP11,
    "op13_merkle_manifest": _op13(),
}
