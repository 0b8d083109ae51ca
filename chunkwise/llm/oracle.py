"""DuckDB statements with the rows of the native operators, by a plainer path."""

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Every window of every length that the items have, in every document, met with the items' windows as text.
DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS win FROM bs),
ls AS (SELECT DISTINCT l FROM win),
ds AS (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d JOIN ls ON len(w) >= l),
occ AS (SELECT ds.rid, ds.s, ds.l, win.item_id FROM ds JOIN win ON win.l = ds.l AND win.win = array_to_string(ds.w[ds.s:ds.s + ds.l - 1], ' ')),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM occ) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.items, '')) AS items_sha256,
       hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)"""

SPACE = r"[\x20\x09-\x0D]+"
#: One row per window and one per line instead of work inside the row.
QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
ws AS (SELECT rid, s, array_to_string(w[s:s + 4], ' ') AS g
       FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS s FROM w WHERE len(w) >= 5)),
rep AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY rid, g) AS n FROM ws) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(s, s + 5)) AS p FROM rep) GROUP BY rid),
l AS (SELECT rid, x, length(regexp_replace(x, '{SPACE}', '', 'g')) AS c, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
k AS (SELECT rid, count(*) - count(DISTINCT x) AS dup, coalesce(sum(c) FILTER (WHERE
        length(regexp_replace(x, '[^\p{{L}}]+', '', 'g')) * 10 >= c * 4
        AND length(regexp_replace(x, '[^|]+', '', 'g')) * 6 < len(regexp_split_to_array(x, '{SPACE}')) * 2
        AND NOT (length(x) < 80 AND regexp_matches(x,
            '(?i)cookie|privacy policy|terms of (use|service)|all rights reserved|click here|subscribe'))
        AND NOT (length(x) < 80 AND n < 5 AND NOT regexp_matches(x, '[.!?:;…。！？؟۔।)\]}}\x22\x27”’»」』][\x20\x09-\x0D]*\z'))
        AND NOT (n >= 30 AND c < n * 12 AND NOT regexp_matches(x, '\p{{P}}'))), 0) AS kept
      FROM l GROUP BY rid),
m AS (SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(d.t, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(d.t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(k.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(k.kept, 0) AS kept_chars
      FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN k USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND kept_chars * 2 >= word_chars AS kept
FROM m"""


def crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a SQL string; the one row of ``CRC_TABLE`` must be joined."""
    octets = f"list_transform(range(1, len(hex(encode({text}))) // 2 + 1), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crc.t[CAST(xor(c & 255, b) AS BIGINT) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), {step}), 4294967295)"


#: The 256 steps of the crc's polynomial, from its rule.
CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(k, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS k))"""


def leaf_sql(text: str) -> str:
    def enc(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"

    return "sha256(" + " || ".join(map(enc, ("doc_id", "source", "lang", "n_chars", text))) + ")"


LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Trees level by level; every path node by node; the tampered leaf folded step by step.
MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT row_number() OVER () AS rid, *, {leaf_sql("text")} AS leaf,
             coalesce({crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AS hit FROM documents, crc),
a AS (SELECT *, CASE WHEN hit THEN {leaf_sql(LOW)} ELSE leaf END AS alt FROM d),
pos AS (SELECT rid, doc_id, leaf, alt, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM a),
node AS (SELECT tree, 0 AS level, idx, n, leaf AS h FROM pos
         UNION ALL SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY tree, level, idx // 8, n),
sub AS (SELECT tree, level, h FROM node WHERE n = 1),
top AS (SELECT 0 AS level, tree AS idx, count(*) OVER () AS n, h FROM sub
        UNION ALL SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 8, n),
every AS (SELECT tree, level, idx, h FROM node WHERE n > 1 UNION ALL SELECT -1, level, idx, h FROM top WHERE n > 1),
p1 AS (SELECT rid, l AS step, pos.tree AS tree, l AS level, CAST(floor(idx / pow(8, l)) AS BIGINT) AS at
       FROM pos JOIN sub ON sub.tree = pos.tree CROSS JOIN (SELECT unnest(range(40)) AS l) WHERE l < sub.level),
p2 AS (SELECT rid, sub.level + l AS step, -1 AS tree, l AS level, CAST(floor(pos.tree / pow(8, l)) AS BIGINT) AS at
       FROM pos JOIN sub ON sub.tree = pos.tree CROSS JOIN (SELECT unnest(range(40)) AS l) WHERE l < (SELECT max(level) FROM top)),
step AS (SELECT rid, step, coalesce(string_agg(e.h, '' ORDER BY e.idx) FILTER (e.idx < p.at), '') AS pre,
                coalesce(string_agg(e.h, '' ORDER BY e.idx) FILTER (e.idx > p.at), '') AS post
         FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2) p JOIN every e ON e.tree = p.tree AND e.level = p.level AND e.idx // 8 = p.at // 8
         GROUP BY rid, step),
proof AS (SELECT rid, string_agg(pre || post, '' ORDER BY step) AS s FROM step GROUP BY rid),
fold AS (SELECT rid, 0 AS step, alt AS h FROM pos
         UNION ALL SELECT fold.rid, fold.step + 1, sha256(step.pre || fold.h || step.post) FROM fold JOIN step ON step.rid = fold.rid AND step.step = fold.step),
folded AS (SELECT rid, max_by(h, step) AS h FROM fold GROUP BY rid),
root AS (SELECT h FROM top WHERE n = 1)
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(proof.s, '')) AS proof_sha256, folded.h AS folded_root, folded.h = root.h AS verified
FROM pos JOIN sub ON sub.tree = pos.tree JOIN folded ON folded.rid = pos.rid LEFT JOIN proof ON proof.rid = pos.rid, root"""

#: Near words by equal patterns: one place replaced by a mark, or one place left out.
SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
run AS (SELECT doc_id, unnest(regexp_extract_all({LOW}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents WHERE text IS NOT NULL),
part AS (SELECT doc_id, r, count(*) AS c FROM run GROUP BY doc_id, r),
hashed AS (SELECT r, c, CAST({crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)")} AS BIGINT) AS h FROM part, crc),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, c FROM hashed),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelt GROUP BY word HAVING length(word) >= 5 AND sum(c) >= 3),
place AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
mark AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS p FROM place),
less AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS p FROM place),
near AS (SELECT a.word, b.word AS other, b.n FROM mark a JOIN mark b ON a.p = b.p AND a.word <> b.word
         UNION SELECT less.word, v.word, v.n FROM less JOIN v ON v.word = less.p
         UNION SELECT v.word, less.word, less.n FROM less JOIN v ON v.word = less.p),
best AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS k FROM near),
f AS (SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN best.n >= 2 * v.n THEN other END AS form,
             CASE WHEN best.n >= 2 * v.n THEN best.n END AS form_n FROM v LEFT JOIN best ON best.word = v.word AND k = 1),
walk AS (SELECT word, word AS now, 0 AS k FROM f UNION ALL SELECT walk.word, f.form, k + 1 FROM walk JOIN f ON f.word = walk.now WHERE f.form IS NOT NULL),
root AS (SELECT word, max_by(now, k) AS root FROM walk GROUP BY word)
SELECT f.word, n, n_near, form, form_n, root FROM f JOIN root ON root.word = f.word"""

ORACLE = {"op3_decontaminate": DECONTAMINATE, "op7_quality_rules": QUALITY_RULES, "op11_merkle_manifest": MERKLE,
          "op13_spelling_variants": SPELLING}
