"""The registered queries as DuckDB SQL, where SQL can express them on whole tables."""

VECTORS = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(embedding) = list_count(embedding)
    AND len(list_filter(embedding, lambda x : isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x : x <> 0)) > 0
), links AS (
  SELECT a.vec_id, b.vec_id AS other
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION
  SELECT l.other, r.root FROM reach r JOIN links l USING (vec_id)
), counted AS (SELECT vec_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY 1) USING (vec_id)
  LEFT JOIN counted USING (vec_id)
"""

CHAT = r"""
WITH talk AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *,
    9 + 7 + 4
      + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
      + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) AS chars
  FROM talk
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

_ALONE = r"\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{ac00}-\x{d7af}"
_SPACE = r" \t\n\r\f\v"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"

LINES = rf"""
WITH tiles AS (
  SELECT doc_id, unnest(tiles) AS tile, unnest(range(len(tiles))) AS i, len(tiles) AS n
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''),
      '[{_SPACE}]*(?:[{_ALONE}]|[^{_SPACE}{_ALONE}]{{1,16}})[{_SPACE}]*') AS tiles FROM documents)
), words AS (
  SELECT *, lower(trim(tile, {_SPACES})) AS word, length(trim(tile, {_SPACES})) AS size,
    length(tile) - length(ltrim(tile, {_SPACES})) + coalesce(sum(length(tile)) OVER (PARTITION BY doc_id ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_char,
    contains(substr(tile, length(tile) - length(ltrim(tile, {_SPACES})) + 1), chr(10)) OR i + 1 = n AS line_end
  FROM tiles
), lists AS (
  SELECT doc_id, list(word ORDER BY i) AS words FROM words GROUP BY doc_id
), line_marks AS (
  SELECT doc_id, 0 AS i FROM words WHERE i = 0
  UNION ALL SELECT doc_id, i + 1 FROM words WHERE line_end
), numbers AS (
  SELECT doc_id, i, n, CAST(list_sum(list_transform(string_split(word, ''), lambda c : unicode(c))) AS BIGINT) * 40503 % 65521
    + CASE WHEN right(word, 1) IN ('.', '!', '?', chr(12290), chr(65281), chr(65311)) THEN 0 ELSE 65521 END AS number
  FROM words
), marks AS (
  SELECT * FROM line_marks
  UNION
  SELECT doc_id, least % 100000000 + 1
  FROM (SELECT doc_id, i, n, min(number * 100000000 + i) OVER (PARTITION BY doc_id ORDER BY i
      ROWS BETWEEN CURRENT ROW AND 13 FOLLOWING) AS least FROM numbers)
  WHERE i + 14 <= n
), units AS (
  SELECT a.doc_id, a.i, b.i AS j FROM marks a ASOF JOIN marks b ON a.doc_id = b.doc_id AND a.i + 6 <= b.i
  UNION
  SELECT a.doc_id, a.i, b.i AS j FROM line_marks a ASOF JOIN line_marks b ON a.doc_id = b.doc_id AND a.i + 1 <= b.i
  WHERE b.i - a.i >= 4
), ranked AS (
  SELECT *, first_value(doc_id) OVER w AS first, first_value(i) OVER w AS first_i, first_value(j) OVER w AS first_j
  FROM (SELECT u.*, array_to_string(words[i + 1 : j], ' ') AS key FROM units u JOIN lists USING (doc_id))
  WINDOW w AS (PARTITION BY key ORDER BY doc_id, i, j)
), gone AS (
  SELECT *, coalesce(i > max(j) OVER (PARTITION BY doc_id ORDER BY i, j DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS begins
  FROM ranked WHERE NOT (doc_id = first AND i = first_i AND j = first_j)
), runs AS (
  SELECT doc_id, min(i) AS i, max(j) AS j, arg_min(first, i * 10000000 - j) AS first
  FROM (SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i, j DESC
      ROWS UNBOUNDED PRECEDING) AS run FROM gone)
  GROUP BY doc_id, run
), spans AS (
  SELECT *, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before
  FROM (
    SELECT r.doc_id, CAST(a.at_char AS BIGINT) AS start, CAST(b.at_char + b.size AS BIGINT) AS stop, r.first
    FROM runs r JOIN words a ON a.doc_id = r.doc_id AND a.i = r.i
      JOIN words b ON b.doc_id = r.doc_id AND b.i = r.j - 1
    WHERE r.j - r.i >= 20 OR b.at_char + b.size - a.at_char >= 130)
), cut AS (
  SELECT doc_id, count(*) AS n_removed, sum(stop - start) AS removed_chars, max(stop) AS last,
    string_agg(start || ':' || stop || ':' || first, ',' ORDER BY start) AS spans,
    string_agg(substr(text, before + 1, start - before), '' ORDER BY start) AS head
  FROM spans JOIN documents USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars,
  coalesce(spans, '') AS spans, CASE WHEN n_removed > 0 THEN head || substr(text, last + 1) ELSE text END AS text
FROM documents LEFT JOIN cut USING (doc_id)
"""

URLS = r"""
WITH rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parted AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), fitting AS (
  SELECT page_id, r_host || r_path AS rule, r_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) AS place
  FROM parted JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT p.page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parted p LEFT JOIN fitting f ON f.page_id = p.page_id AND place = 1
"""

WINDOWS = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[k : k + size - 1], ' ') AS w
  FROM (
    SELECT item_id, words, least(10, len(words)) AS size,
      unnest(range(1, len(words) - least(10, len(words)) + 2)) AS k
    FROM item_words WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows
), doc_windows AS (
  SELECT doc_id, size, k, array_to_string(words[k : k + size - 1], ' ') AS w
  FROM (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k
    FROM doc_words, sizes WHERE len(words) >= size)
), met AS (
  SELECT doc_id, item_id, k, size FROM doc_windows JOIN item_windows USING (size, w)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM met))
  GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE digested AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf(_LOWER)} AS lowered,
    list_reduce(
      list_prepend(4294967295, list_transform(range(9 * length(CAST(doc_id AS VARCHAR))), lambda i :
        CASE WHEN i % 9 = 0 THEN ord(substr(CAST(doc_id AS VARCHAR), CAST(i // 9 + 1 AS BIGINT), 1)) ELSE -1 END)),
      lambda c, x : CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
    ) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, leaf,
    CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN lowered ELSE leaf END AS suspect,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM digested
), tree AS (
  SELECT g, 0 AS level, pos, n, leaf AS d FROM leaves
  UNION ALL
  SELECT g, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY g, level, pos // 16, n
), subroots AS (
  SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), upper_tree AS (
  SELECT 0 AS level, pos, n, d FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY pos))
  FROM upper_tree WHERE n > 1 GROUP BY level, pos // 16, n
), beside AS (
  SELECT g, level, pos,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tree WHERE n > 1 WINDOW w AS (PARTITION BY g, level, pos // 16 ORDER BY pos)
), upper_beside AS (
  SELECT level, pos,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM upper_tree WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 16 ORDER BY pos)
), folds AS (
  SELECT doc_id, g, leaf, pos AS place, 0 AS level, pos, suspect AS d, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, f.g, leaf, place, f.level + 1, f.pos // 16, sha256(l || d || r), proof || l || r
  FROM folds f JOIN beside b ON f.g = b.g AND f.level = b.level AND f.pos = b.pos
), upper_folds AS (
  SELECT f.doc_id, f.g, leaf, place, s.d AS subroot, 0 AS level, s.pos, f.d, proof
  FROM folds f JOIN tree t ON f.g = t.g AND f.level = t.level AND t.n = 1 JOIN subroots s ON f.g = s.g
  UNION ALL
  SELECT doc_id, g, leaf, place, subroot, f.level + 1, f.pos // 16, sha256(l || d || r), proof || l || r
  FROM upper_folds f JOIN upper_beside b ON f.level = b.level AND f.pos = b.pos
)
SELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, f.d AS folded_root, f.d = t.d AS verified
FROM upper_folds f JOIN upper_tree t ON t.n = 1 AND f.level = t.level
"""

_DIGEST = """array_to_string(list_transform(range(32), lambda i : substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST((CAST('0x' || substr(sha1(coalesce(html, '')), CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) % 32 + 1 AS BIGINT), 1)), '')"""

WARC = f"""
SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, {_DIGEST} AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM pages WINDOW w AS (PARTITION BY coalesce(html, ''))
"""

NEGATIVES = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x : floor(256 * x)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) = list_count(embedding)
    AND len(list_filter(embedding, lambda x : isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON p.anchor = n.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

ORACLE = {
    "op1_embedding_near_dedup": VECTORS,
    "op2_chat_formatting": CHAT,
    "op3_substring_dedup": LINES,
    "op4_url_filters": URLS,
    "op9_benchmark_decontamination": WINDOWS,
    "op11_merkle_manifest": MERKLE,
    "op12_warc": WARC,
    "op13_hard_negative_mining": NEGATIVES,
}
