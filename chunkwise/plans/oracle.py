"""DuckDB oracle SQL, one statement per registered query with the same
output column names.  Tables are the driver's pre-registered views."""

from __future__ import annotations

from chunkwise.plans import sqltext as S

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


DOCS = S.DOCS
KEPT = f"SELECT * FROM ({DOCS}) d WHERE {S.reason('text')} = 'kept'"
MINCH = f"SELECT * FROM ({DOCS}) d WHERE length(text) >= 200"


def expanded(text: str, k: int) -> str:
    return f"flatten(list_transform({S.units(text)}, lambda uu: {S.long_unit('uu', k)}))"


def chunks(text: str, k: int = 510, m: int | None = 4) -> str:
    return S.chunk_fold(expanded(text, k), k, m)


def split_sql(src: str, ratio: float = 0.1, seed: int = 42, salt: str = "test",
              names: tuple[str, str] = ("train", "test")) -> str:
    return f"""
SELECT * EXCLUDE (_r, _n), CASE WHEN _r <= {S.held_out('_n', ratio)} THEN '{names[1]}' ELSE '{names[0]}' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {S.okey('doc_id', seed, salt)}, doc_id) AS _r,
             count(*) OVER (PARTITION BY label) AS _n FROM ({src}) s0) s1"""


SPLIT = split_sql(MINCH)

# ------------------------------------------------------------------ flagship
sql("chunks_per_class", f"""
WITH c AS (SELECT label, len({chunks('text')}) AS n FROM ({KEPT}) k)
SELECT label, count(*) AS n_docs, round(avg(n), 6) AS avg_chunks, CAST(max(n) AS INTEGER) AS max_chunks FROM c GROUP BY label""")

# ------------------------------------------------------------------ text
sql("clean_text", f"SELECT doc_id, text FROM ({DOCS}) d")
sql("mark_sections", f"SELECT doc_id, {S.mark('text')} AS marked FROM ({DOCS}) d")
sql("split_units", f"""
WITH u AS (SELECT doc_id, {S.units('text')} AS u FROM ({DOCS}) d)
SELECT doc_id, CAST(unnest(range(1, len(u) + 1)) AS INTEGER) AS unit_no, unnest(u) AS unit FROM u""")
sql("count_tokens", f"SELECT doc_id, CAST({S.ntok('text')} AS INTEGER) AS n_tokens_raw, CAST({S.ntok(S.clean('text'))} AS INTEGER) AS n_tokens "
                    f"FROM documents")
sql("split_by_words", f"""
WITH p AS (SELECT doc_id, {S.by_words('text', 64)} AS p FROM ({DOCS}) d)
SELECT doc_id, CAST(unnest(range(1, len(p) + 1)) AS INTEGER) AS piece_no, unnest(p) AS piece FROM p""")
sql("split_long_unit", f"""
WITH u AS (SELECT doc_id, {S.units('text')} AS u FROM ({DOCS}) d),
l AS (SELECT doc_id, CAST(unnest(range(1, len(u) + 1)) AS INTEGER) AS unit_no, unnest(u) AS unit FROM u),
p AS (SELECT doc_id, unit_no, {S.long_unit('unit', 40)} AS p FROM l)
SELECT doc_id, unit_no, CAST(unnest(range(1, len(p) + 1)) AS INTEGER) AS piece_no, unnest(p) AS piece FROM p""")
sql("build_chunks", f"""
WITH c AS (SELECT doc_id, {chunks('text', 128, 8)} AS c FROM ({DOCS}) d)
SELECT doc_id, CAST(unnest(range(1, len(c) + 1)) AS INTEGER) AS chunk_no, unnest(c) AS chunk FROM c""")
sql("explode_chunks", f"""
WITH c AS (SELECT doc_id, {chunks('text')} AS c FROM ({KEPT}) d),
e AS (SELECT doc_id, CAST(unnest(range(0, len(c))) AS INTEGER) AS chunk_no, unnest(c) AS chunk FROM c)
SELECT doc_id, chunk_no, chunk, CAST({S.ntok('chunk')} AS INTEGER) AS n_tokens FROM e""")
sql("pad_chunks", f"""
WITH c AS (SELECT doc_id, {chunks('text')} AS c FROM ({DOCS}) d),
p AS (SELECT doc_id, CASE WHEN len(c) = 0 THEN [''] ELSE c[1:4] END AS b FROM c),
q AS (SELECT doc_id, list_concat(b, list_transform(range(len(b), 4), lambda x: '')) AS ch, len(b) AS r FROM p)
SELECT doc_id, CAST(unnest(range(0, 4)) AS INTEGER) AS slot, unnest(ch) AS chunk,
       unnest(list_transform(range(1, 5), lambda i: CASE WHEN i <= r THEN 1 ELSE 0 END)) AS mask FROM q""")
ONE_LINE = "translate(text, chr(10) || chr(13), '  ')"
sql("single_line", f"SELECT doc_id, {S.strip(ONE_LINE)} AS line FROM documents")
sql("label_lines", f"""
SELECT doc_id, '__label__' || CAST(label AS VARCHAR) || ' ' || {S.strip(ONE_LINE)}
  AS line FROM ({MINCH}) d""")
sql("cast_label", "SELECT doc_id, source, TRY_CAST(substr(source, 4) AS INTEGER) AS label FROM documents")

# ------------------------------------------------------------------ filters
sql("filter_min_chars", f"SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM ({MINCH}) d")
sql("filter_min_tokens", f"SELECT doc_id, CAST({S.ntok('text')} AS INTEGER) AS n_tokens FROM ({DOCS}) d WHERE {S.ntok('text')} >= 50")
sql("filter_max_tokens", f"SELECT doc_id, CAST({S.ntok('text')} AS INTEGER) AS n_tokens FROM ({DOCS}) d WHERE {S.ntok('text')} <= 2040")
sql("filter_with_reason", f"SELECT {S.reason('text')} AS reason, count(*) AS n FROM ({DOCS}) d GROUP BY 1")
sql("reject_empty", f"""
SELECT doc_id, CASE WHEN text IS NULL OR {S.strip('text')} = '' THEN 'empty' ELSE 'ok' END AS status FROM documents""")
sql("drop_rarest", f"""
WITH k AS ({KEPT}), c AS (SELECT label, count(*) AS n FROM k GROUP BY label),
r AS (SELECT label FROM c ORDER BY n, label LIMIT 4)
SELECT label, n FROM c WHERE label NOT IN (SELECT label FROM r)""")

# ------------------------------------------------------------------ lookups
CATS = "SELECT DISTINCT CAST(substr(source, 4) AS INTEGER) AS label, source AS name FROM documents"
sql("with_category", f"""
SELECT d.doc_id, d.label, c.name AS category FROM ({S.RAW_DOCS}) d LEFT JOIN ({CATS}) c ON d.label = c.label""")
sql("default_categories", f"SELECT DISTINCT label, CAST(label AS VARCHAR) AS name FROM ({S.RAW_DOCS}) d")
sql("count_labels", f"""
WITH l AS (SELECT CAST(label AS VARCHAR) || chr(9) || name AS v FROM ({CATS}) c),
f AS (SELECT trim(unnest(string_split(v, chr(9)))) AS f FROM l)
SELECT count(DISTINCT CAST(f AS HUGEINT)) AS num_labels FROM f WHERE regexp_full_match(f, '[0-9]+')""")
sql("label_maps", f"""
SELECT DISTINCT CAST(label AS VARCHAR) AS key, label AS label2id, CAST(label AS VARCHAR) AS id2label FROM ({KEPT}) k""")

# ------------------------------------------------------------------ aggregates
sql("label_distribution", f"""
WITH s AS ({SPLIT})
SELECT split, label, count(*) AS n FROM s GROUP BY split, label
UNION ALL SELECT 'total' AS split, label, count(*) AS n FROM s GROUP BY label""")
sql("label_set", f"""
SELECT CAST(count(*) AS INTEGER) AS num_labels, string_agg(CAST(label AS VARCHAR), ',' ORDER BY label) AS labels
FROM (SELECT DISTINCT label FROM ({KEPT}) k) l""")
sql("split_sizes", f"""
SELECT count(*) AS total_samples, count(*) FILTER (WHERE split = 'train') AS train_samples,
       count(*) FILTER (WHERE split = 'test') AS test_samples FROM ({SPLIT}) s""")
SPLIT_CHUNKS = f"SELECT *, len({chunks('text')}) AS chunk_count FROM ({SPLIT}) s"
sql("chunk_stats", f"""
SELECT split, round(avg(chunk_count), 6) AS avg_chunks, CAST(max(chunk_count) AS DOUBLE) AS max_chunks
FROM ({SPLIT_CHUNKS}) c GROUP BY split""")
sql("length_stats", f"""
SELECT count(*) AS n_docs, round(avg(length(text)), 6) AS mean_chars, round(median(length(text)), 6) AS median_chars,
       CAST(min(length(text)) AS INTEGER) AS min_chars, CAST(max(length(text)) AS INTEGER) AS max_chars FROM ({DOCS}) d""")
sql("token_coverage", f"""
SELECT count(*) AS n_docs, CAST(sum(CASE WHEN {S.ntok('text')} <= 2040 THEN 1 ELSE 0 END) AS BIGINT) AS n_within,
       round(avg(CASE WHEN {S.ntok('text')} <= 2040 THEN 1 ELSE 0 END), 6) AS share_within FROM ({MINCH}) d""")
sql("class_balance", f"""
WITH c AS (SELECT label, count(*) AS n FROM ({KEPT}) k GROUP BY label)
SELECT c.label, cat.name, c.n, round(c.n / sum(c.n) OVER (), 6) AS share FROM c LEFT JOIN ({CATS}) cat
ON c.label = cat.label""")
sql("dataset_manifest", f"""
WITH c AS ({SPLIT_CHUNKS})
SELECT count(*) AS total_samples, count(*) FILTER (WHERE split = 'train') AS train_samples,
       count(*) FILTER (WHERE split = 'test') AS test_samples, CAST(0.1 AS DOUBLE) AS test_size,
       CAST(count(DISTINCT label) AS INTEGER) AS num_labels,
       round(coalesce(avg(chunk_count) FILTER (WHERE split = 'train'), 0.0), 6) AS train_avg_chunks,
       coalesce(CAST(max(chunk_count) FILTER (WHERE split = 'train') AS DOUBLE), 0.0) AS train_max_chunks,
       round(coalesce(avg(chunk_count) FILTER (WHERE split = 'test'), 0.0), 6) AS test_avg_chunks,
       coalesce(CAST(max(chunk_count) FILTER (WHERE split = 'test') AS DOUBLE), 0.0) AS test_max_chunks,
       (SELECT string_agg(CAST(label AS VARCHAR), ',' ORDER BY label) FROM (SELECT DISTINCT label FROM c) l) AS labels,
       (SELECT string_agg(k || ':' || n, ',' ORDER BY k) FROM (SELECT CAST(label AS VARCHAR) AS k, count(*) AS n FROM c GROUP BY 1) l) AS label_distribution_total,
       (SELECT string_agg(k || ':' || n, ',' ORDER BY k) FROM (SELECT CAST(label AS VARCHAR) AS k, count(*) AS n FROM c WHERE split = 'train' GROUP BY 1) l)
         AS label_distribution_train,
       (SELECT string_agg(k || ':' || n, ',' ORDER BY k) FROM (SELECT CAST(label AS VARCHAR) AS k, count(*) AS n FROM c WHERE split = 'test' GROUP BY 1) l)
         AS label_distribution_test FROM c""")
sql("chunk_records", f"""
SELECT split, row_number() OVER (PARTITION BY split ORDER BY {S.okey('doc_id', 42, 'order')}, doc_id) - 1 AS id,
       label, CAST(len(c) AS INTEGER) AS chunk_count, text, array_to_string(c, chr(10)) AS chunks
FROM (SELECT *, {chunks('text')} AS c FROM ({SPLIT}) s) c""")

# ------------------------------------------------------------------ splits
sql("stratified_split", f"SELECT doc_id, label, split FROM ({SPLIT}) s")
sql("dev_split", f"""
SELECT doc_id, label, split FROM ({split_sql(f"SELECT * EXCLUDE (split) FROM ({SPLIT}) t WHERE split = 'train'",
                                             salt='dev', names=('train', 'dev'))}) s""")
sql("three_way_split", f"""
WITH s AS ({SPLIT}),
d AS ({split_sql("SELECT * EXCLUDE (split) FROM s WHERE split = 'train'", salt='dev', names=('train', 'dev'))})
SELECT doc_id, label, split FROM d UNION ALL SELECT doc_id, label, split FROM s WHERE split = 'test'""")
sql("seeded_order", f"""
SELECT doc_id, row_number() OVER (ORDER BY {S.okey('doc_id', 42, 'order')}, doc_id) AS order_no FROM documents""")
sql("row_id", f"""
SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY {S.okey('doc_id', 42, 'order')}, doc_id) - 1 AS id
FROM ({SPLIT}) s""")
