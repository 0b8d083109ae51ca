"""Oracle SQL for the vector, metric and metric-log queries (registered on import)."""

from __future__ import annotations

from chunkwise.plans.oracle import sql

# Parameter tables by the same fixed rules as operators.vectors.
HEAD = """SELECT c, unnest(range(64)) AS i FROM range(10) t(c)"""
HEAD_W = f"SELECT c, i, ((c * 31 + i * 17) % 13 - 6) / 13 AS w FROM ({HEAD}) h"
HEAD_B = "SELECT c, ((c * 7) % 5 - 2) / 10 AS b FROM range(10) t(c)"
ATT_W = "SELECT j, i, ((j * 13 + i * 7) % 11 - 5) / 50 AS w FROM (SELECT j, unnest(range(64)) AS i FROM range(64) t(j)) a"
ATT_B = "SELECT j, ((j * 3) % 7 - 3) / 100 AS b, ((j * 5) % 9 - 4) / 20 AS v FROM range(64) t(j)"

CV = """SELECT vec_id, vec_id // 4 AS doc, CAST(vec_id % 4 AS INTEGER) AS chunk_no, label,
  CASE WHEN vec_id % 4 = 0 OR ((vec_id // 4) * 7 + vec_id % 4) % 5 <> 0 THEN 1 ELSE 0 END AS mask,
  CAST(embedding AS DOUBLE[]) AS e FROM embeddings"""
CV_LONG = f"SELECT vec_id, doc, chunk_no, label, mask, unnest(range(len(e))) AS i, unnest(e) AS x FROM ({CV}) v"

LOGITS = f"""SELECT x.vec_id, w.c, round(sum(w.w * x.x) + any_value(b.b), 9) AS logit
FROM ({CV_LONG}) x JOIN ({HEAD_W}) w ON w.i = x.i JOIN ({HEAD_B}) b ON b.c = w.c GROUP BY x.vec_id, w.c"""
PRED = f"""SELECT vec_id, c AS pred FROM (SELECT vec_id, c, row_number() OVER (PARTITION BY vec_id
  ORDER BY logit DESC, c) AS r FROM ({LOGITS}) l) q WHERE r = 1"""
PAIRS = f'SELECT v.vec_id, v.label AS "true", p.pred FROM embeddings v JOIN ({PRED}) p ON p.vec_id = v.vec_id'
LABELS = "SELECT DISTINCT label FROM embeddings"


def cm(pairs: str) -> str:
    return f"""SELECT t.label AS "true", p.label AS pred, CAST(coalesce(n.n, 0) AS BIGINT) AS n
FROM ({LABELS}) t JOIN ({LABELS}) p ON true LEFT JOIN (SELECT "true", pred, count(*) AS n FROM ({pairs}) x GROUP BY 1, 2) n
ON n."true" = t.label AND n.pred = p.label"""


def per_class(pairs: str) -> str:
    return f"""WITH m AS ({cm(pairs)}),
a AS (SELECT "true" AS label, sum(CASE WHEN "true" = pred THEN n ELSE 0 END) AS tp, sum(n) AS support FROM m GROUP BY 1),
b AS (SELECT pred AS label, sum(n) AS predicted FROM m GROUP BY 1),
c AS (SELECT a.label, a.tp, a.support, b.predicted,
        CASE WHEN b.predicted = 0 THEN 0.0 ELSE a.tp / b.predicted END AS precision,
        CASE WHEN a.support = 0 THEN 0.0 ELSE a.tp / a.support END AS recall FROM a JOIN b ON a.label = b.label)
SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM c"""


def summary(pairs: str) -> str:
    return f"""WITH r AS ({per_class(pairs)}),
s AS (SELECT sum(support) AS n, sum(tp) AS tp, sum(predicted) AS pr,
  avg(precision) FILTER (WHERE support > 0 OR predicted > 0) AS macro_precision,
  avg(recall) FILTER (WHERE support > 0 OR predicted > 0) AS macro_recall,
  avg(f1) FILTER (WHERE support > 0 OR predicted > 0) AS macro_f1,
  avg(precision) AS macro_all_precision, avg(recall) AS macro_all_recall, avg(f1) AS macro_all_f1,
  sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall,
  sum(f1 * support) / sum(support) AS weighted_f1 FROM r),
t AS (SELECT *, tp / n AS accuracy, tp / pr AS micro_precision, tp / n AS micro_recall FROM s)
SELECT *, CASE WHEN micro_precision + micro_recall = 0 THEN 0.0
  ELSE 2 * micro_precision * micro_recall / (micro_precision + micro_recall) END AS micro_f1 FROM t"""


R6 = ["accuracy", "micro_precision", "micro_recall", "micro_f1", "macro_precision", "macro_recall", "macro_f1",
      "macro_all_precision", "macro_all_recall", "macro_all_f1", "weighted_precision", "weighted_recall", "weighted_f1"]

sql("linear_logits", f"SELECT vec_id, CAST(c AS INTEGER) AS class, round(logit, 6) AS logit FROM ({LOGITS}) l")
sql("argmax", f"SELECT vec_id, CAST(pred AS INTEGER) AS pred FROM ({PRED}) p")
sql("pool_mean", f"""
SELECT doc, CAST(i AS INTEGER) AS dim, round(sum(x * mask) / greatest(sum(mask), 1), 6) AS value
FROM ({CV_LONG}) v GROUP BY doc, i""")

ATT = f"""
WITH x AS ({CV_LONG}),
h AS (SELECT x.vec_id, w.j, tanh(sum(w.w * x.x) + any_value(b.b)) * any_value(b.v) AS hv
      FROM x JOIN ({ATT_W}) w ON w.i = x.i JOIN ({ATT_B}) b ON b.j = w.j GROUP BY x.vec_id, w.j),
s AS (SELECT c.vec_id, c.doc, CASE WHEN c.mask = 0 THEN -1e4 ELSE sum(h.hv) END AS s
      FROM ({CV}) c JOIN h ON h.vec_id = c.vec_id GROUP BY c.vec_id, c.doc, c.mask),
e AS (SELECT vec_id, doc, exp(s - max(s) OVER (PARTITION BY doc)) AS e FROM s),
wt AS (SELECT vec_id, doc, e / sum(e) OVER (PARTITION BY doc) AS wt FROM e)"""
sql("pool_attention", f"""{ATT}
SELECT x.doc, CAST(x.i AS INTEGER) AS dim, round(sum(x.x * wt.wt), 6) AS value
FROM x JOIN wt ON wt.vec_id = x.vec_id GROUP BY x.doc, x.i""")

sql("confusion_matrix", cm(PAIRS))
sql("classification_report", f"""
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM ({per_class(PAIRS)}) r""")
sql("metrics_summary", f"""
SELECT CAST(n AS BIGINT) AS n, {', '.join(f'round({c}, 6) AS {c}' for c in R6)} FROM ({summary(PAIRS)}) s""")
sql("cross_entropy", f"""
WITH l AS ({LOGITS}), z AS (SELECT vec_id, max(logit) AS mx FROM l GROUP BY 1),
lse AS (SELECT l.vec_id, any_value(z.mx) + ln(sum(exp(l.logit - z.mx))) AS lse FROM l JOIN z ON z.vec_id = l.vec_id GROUP BY 1)
SELECT count(*) AS n, round(avg(lse.lse - l.logit), 6) AS loss FROM lse JOIN embeddings v ON v.vec_id = lse.vec_id
JOIN l ON l.vec_id = lse.vec_id AND l.c = v.label""")
sql("top_confusions", f"""
SELECT "true", pred, n FROM ({cm(PAIRS)}) m WHERE "true" <> pred AND n > 0 ORDER BY n DESC, "true", pred LIMIT 5""")

DOC_PAIRS = f"""{ATT},
dv AS (SELECT x.doc, x.i, sum(x.x * wt.wt) AS x FROM x JOIN wt ON wt.vec_id = x.vec_id GROUP BY x.doc, x.i),
dl AS (SELECT dv.doc, w.c, round(sum(w.w * dv.x) + any_value(b.b), 9) AS logit
       FROM dv JOIN ({HEAD_W}) w ON w.i = dv.i JOIN ({HEAD_B}) b ON b.c = w.c GROUP BY dv.doc, w.c),
dp AS (SELECT doc, c AS pred FROM (SELECT doc, c, row_number() OVER (PARTITION BY doc ORDER BY logit DESC, c) AS r
       FROM dl) q WHERE r = 1)
SELECT c.doc, c.label AS "true", dp.pred FROM ({CV}) c JOIN dp ON dp.doc = c.doc WHERE c.chunk_no = 0"""
ORACLE_EVAL = f"""
SELECT CAST(n AS BIGINT) AS n, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
  round(weighted_f1, 6) AS weighted_f1 FROM ({summary(f'SELECT * FROM ({DOC_PAIRS}) dq')}) s"""
sql("evaluate", ORACLE_EVAL)

STEPS = """SELECT user_id AS run, value AS metric, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step
FROM events"""
sql("early_stop", f"""
WITH s AS ({STEPS}),
p AS (SELECT *, greatest(coalesce(max(metric) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), -1.0), -1.0) AS best_before FROM s),
i AS (SELECT *, metric > best_before AS imp FROM p),
l AS (SELECT *, max(CASE WHEN imp THEN step ELSE 0 END) OVER (PARTITION BY run ORDER BY step
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_imp FROM i),
g AS (SELECT run, max(step) AS n_steps, min(CASE WHEN step - last_imp >= 2 THEN step END) AS stop_step,
        max(CASE WHEN imp THEN step END) AS last_step, max(metric) AS mx FROM l GROUP BY run),
b AS (SELECT g.*, CASE WHEN stop_step IS NOT NULL THEN stop_step - 2 ELSE last_step END AS bs FROM g)
SELECT b.run, b.n_steps, CASE WHEN b.bs > 0 THEN b.bs END AS best_step,
  round(CASE WHEN b.bs IS NULL OR b.bs <= 0 THEN NULL WHEN b.stop_step IS NOT NULL THEN l.best_before ELSE b.mx END, 6)
    AS best_metric, b.stop_step
FROM b LEFT JOIN l ON l.run = b.run AND l.step = b.stop_step""")
sql("running_mean", f"""
SELECT run, step, round(avg(metric) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW), 6) AS running_mean FROM ({STEPS}) s QUALIFY step % 10 = 0""")

# ------------------------------------------------------------------ features
from chunkwise.plans import sqltext as S  # noqa: E402
from chunkwise.plans.more_queries import STOP_WORDS, TFIDF_FEATURES, VOCAB_SIZE  # noqa: E402
from chunkwise.plans.oracle import DOCS, KEPT, chunks  # noqa: E402

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
sql("tfidf", f"""
WITH d AS ({DOCS}),
t AS (SELECT doc_id, list_filter(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'),
        lambda w: length(w) >= 2), lambda w: NOT list_contains({_STOP}, w)) AS t FROM d),
g AS (SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g FROM t),
tc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM g) x GROUP BY 1, 2),
n AS (SELECT count(DISTINCT doc_id) AS n FROM d),
st AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tc GROUP BY term),
v AS (SELECT term, df FROM st, n WHERE df >= 2 AND df <= 0.9 * n.n ORDER BY total DESC, term LIMIT {TFIDF_FEATURES}),
w AS (SELECT tc.doc_id, tc.term, tc.tf * (ln((1 + n.n) / (1 + v.df)) + 1) AS w FROM tc JOIN v ON v.term = tc.term, n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")

VOCAB = f"""SELECT term, CAST(row_number() OVER (ORDER BY n DESC, term) + 3 AS INTEGER) AS term_id, n FROM
(SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{S.TOKEN_PATTERN}')) AS term
 FROM ({KEPT}) k) x GROUP BY term ORDER BY n DESC, term LIMIT {VOCAB_SIZE}) v"""
sql("build_vocab", VOCAB)
sql("encode_ids", f"""
WITH c AS (SELECT doc_id, {chunks('text')} AS c FROM ({KEPT}) d),
e AS (SELECT doc_id, CAST(unnest(range(0, len(c))) AS INTEGER) AS chunk_no, unnest(c) AS chunk FROM c),
t AS (SELECT doc_id, chunk_no, (regexp_extract_all(lower(chunk), '{S.TOKEN_PATTERN}'))[1:510] AS t FROM e),
u AS (SELECT doc_id, chunk_no, unnest(range(1, len(t) + 1)) AS pos, unnest(t) AS term FROM t),
i AS (SELECT u.doc_id, u.chunk_no, list(coalesce(v.term_id, 1) ORDER BY u.pos) AS ids
      FROM u LEFT JOIN ({VOCAB}) v ON v.term = u.term GROUP BY 1, 2),
f AS (SELECT doc_id, chunk_no, list_concat([2], ids, [3]) AS r FROM i)
SELECT doc_id, chunk_no, CAST(len(r) AS INTEGER) AS n_real,
  array_to_string(list_concat(r, list_transform(range(512 - len(r)), lambda x: 0)), ' ') AS ids FROM f""")
sql("rebalance", f"""
WITH l AS (SELECT doc_id, quality * 2 + toxic AS label FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {S.okey('doc_id', 42, 'rebalance')}, doc_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM l),
m AS (SELECT max(n) AS m FROM r)
SELECT doc_id, label, unnest(range(1, m.m // n + CASE WHEN r <= m.m % n THEN 2 ELSE 1 END)) AS copy_no FROM r, m""")

# ------------------------------------------------------------------ encoder and prediction
from chunkwise.plans.oracle import CATS  # noqa: E402


def slots(docs: str) -> str:
    """(doc_id, slot, chunk, mask): four padded chunks a document."""
    return f"""SELECT doc_id, CAST(unnest(range(0, 4)) AS INTEGER) AS slot,
  unnest(list_transform(range(1, 5), lambda i: CASE WHEN i <= len(c) THEN c[i] ELSE '' END)) AS chunk,
  unnest(list_transform(range(1, 5), lambda i: CASE WHEN i <= greatest(len(c), 1) THEN 1 ELSE 0 END)) AS mask
FROM (SELECT doc_id, {chunks('text')} AS c FROM ({docs}) d) c"""


def chunk_vector(docs: str) -> str:
    """(doc_id, slot, i, x): the non-zero places of each chunk's unit vector."""
    return f"""SELECT doc_id, slot, i, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id, slot)) AS x FROM (
  SELECT doc_id, slot, CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) % 64 AS i, CAST(count(*) AS DOUBLE) AS n
  FROM (SELECT doc_id, slot, unnest(regexp_extract_all(lower(chunk), '{S.TOKEN_PATTERN}')) AS w FROM ({slots(docs)}) p) t GROUP BY 1, 2, 3) c"""


sql("encode_chunks", f"""
SELECT doc_id, slot AS chunk_no, CAST(i AS INTEGER) AS dim, round(x, 6) AS value FROM ({chunk_vector(KEPT)}) x""")

SCORED = f"SELECT doc_id, {S.clean('text')} AS text FROM documents WHERE text IS NOT NULL AND {S.strip('text')} <> ''"
HEAD20 = "SELECT c, i, ((c * 31 + i * 17) % 13 - 6) / 13 AS w FROM (SELECT c, unnest(range(64)) AS i FROM range(20) t(c)) h"
PREDICTED = f"""
WITH p AS ({slots(SCORED)}), x AS ({chunk_vector(SCORED)}),
wx AS (SELECT x.doc_id, x.slot, w.j, sum(w.w * x.x) AS s FROM x JOIN ({ATT_W}) w ON w.i = x.i GROUP BY 1, 2, 3),
s AS (SELECT p.doc_id, p.slot, CASE WHEN p.mask = 0 THEN -1e4 ELSE sum(tanh(coalesce(wx.s, 0) + b.b) * b.v) END AS s
      FROM p CROSS JOIN ({ATT_B}) b LEFT JOIN wx ON wx.doc_id = p.doc_id AND wx.slot = p.slot AND wx.j = b.j GROUP BY p.doc_id, p.slot, p.mask),
e AS (SELECT doc_id, slot, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM s),
wt AS (SELECT doc_id, slot, e / sum(e) OVER (PARTITION BY doc_id) AS wt FROM e),
dv AS (SELECT x.doc_id, x.i, sum(x.x * wt.wt) AS x FROM x JOIN wt ON wt.doc_id = x.doc_id AND wt.slot = x.slot GROUP BY 1, 2),
dl AS (SELECT dv.doc_id, w.c, sum(w.w * dv.x) AS s FROM dv JOIN ({HEAD20}) w ON w.i = dv.i GROUP BY 1, 2),
l AS (SELECT d.doc_id, t.c, round(coalesce(dl.s, 0) + ((t.c * 7) % 5 - 2) / 10, 9) AS logit
      FROM (SELECT DISTINCT doc_id FROM p) d CROSS JOIN range(20) t(c) LEFT JOIN dl ON dl.doc_id = d.doc_id AND dl.c = t.c),
b AS (SELECT doc_id, CAST(c AS INTEGER) AS label FROM l QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY logit DESC, c) = 1)
SELECT b.doc_id, b.label, c.name AS category FROM b LEFT JOIN ({CATS}) c ON c.label = b.label"""
sql("predict", PREDICTED)
sql("score_stream", PREDICTED)
