"""The registered queries in DuckDB's SQL, as an independent check of their results."""

from __future__ import annotations

from pairloom.plans import catalog as c

# The whitespace and word classes of the text rules, and the bucket and sign of a word.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"
STAMP = f"TIMESTAMP '{c.RUN_TS}'"

PASSAGES = r"""
passages AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         CASE WHEN p >= 2 THEN nullif(trim(substr(text, 1, p - 1)), '') END AS title,
         CASE WHEN p > 0 THEN nullif(trim(substr(text, p + 1)), '') ELSE text END AS text
  FROM (SELECT doc_id, text, instr(text, chr(10)) AS p FROM documents)),
numbered AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS source_row FROM passages),
valid AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS valid_row FROM passages
          WHERE title IS NOT NULL AND text IS NOT NULL)"""


# The same passages numbered as they stand in the file.
FILED = r"""
filed AS (SELECT doc_id, text, row_number() OVER () - 1 AS source_row FROM documents),
passages AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         CASE WHEN p >= 2 THEN nullif(trim(substr(text, 1, p - 1)), '') END AS title,
         CASE WHEN p > 0 THEN nullif(trim(substr(text, p + 1)), '') ELSE text END AS text, source_row
  FROM (SELECT doc_id, text, source_row, instr(text, chr(10)) AS p FROM filed)),
numbered AS (SELECT * FROM passages),
valid AS (SELECT *, row_number() OVER (ORDER BY source_row) - 1 AS valid_row FROM passages
          WHERE title IS NOT NULL AND text IS NOT NULL)"""


def draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def chunks(source: str, budget: int = 380) -> str:
    """Chunk rows ``id, k, n, piece`` of a table with ``id`` and ``text``."""
    return rf"""
SELECT id, unnest(range(1, len(pieces) + 1)) AS k, len(pieces) AS n, unnest(pieces) AS piece FROM (
  SELECT id, CASE
    WHEN text IS NULL OR length(text) <= {budget} OR len(words) = 0 THEN [text]
    ELSE string_split(packed.done || packed.cur, chr(1)) END AS pieces
  FROM (SELECT id, text, words, CASE WHEN len(words) > 0 THEN list_reduce(
          list_transform(words, lambda w: {{'done': '', 'cur': w}}),
          lambda a, x: CASE WHEN length(a.cur) + 1 + length(x.cur) > {budget}
            THEN {{'done': a.done || a.cur || chr(1), 'cur': x.cur}}
            ELSE {{'done': a.done, 'cur': a.cur || ' ' || x.cur}} END) END AS packed
        FROM (SELECT id, text, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda w: w <> '') AS words
              FROM {source})))"""


CHUNK_ID = "CASE WHEN n > 1 THEN CAST(id AS VARCHAR) || '_' || k ELSE CAST(id AS VARCHAR) END"


def counts(source: str, text: str) -> str:
    """Non-zero hashed word counts ``id, bucket, weight``."""
    return rf"""
SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {c.DIM} AS bucket,
       CAST(sum(CASE WHEN ('0x' || substr(md5(w), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS BIGINT) AS weight
FROM (SELECT id, unnest(regexp_split_to_array(lower({text}), '{NOT_WORD}')) AS w FROM {source})
WHERE w <> '' GROUP BY 1, 2 HAVING weight <> 0"""


def adapted(source: str, hashed: str, name: str) -> str:
    """Squared length of the hashed counts after each bucket has taken on its neighbour's count."""
    return f"""
SELECT t.id AS {name}, {c.DIM}::BIGINT AS dim, CAST(coalesce(sum(w * w), 0) AS BIGINT) AS norm_squared FROM {source} t LEFT JOIN (
  SELECT id, bucket, sum(weight) AS w FROM (SELECT id, bucket, weight FROM {hashed}
    UNION ALL SELECT id, (bucket + {c.DIM} - 1) % {c.DIM}, weight FROM {hashed}) GROUP BY id, bucket) s ON s.id = t.id
WHERE t.text IS NOT NULL GROUP BY t.id"""


def sparse_top(queries: str, docs: str, k: int, floor: float | None, other: bool) -> str:
    """``query_id, doc_id, similarity, rank`` from two tables of hashed counts."""
    return f"""
SELECT query_id, doc_id, similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) - 1 AS rank FROM (
    SELECT query_id, doc_id, round(d / (sqrt(qn) * sqrt(dn)), 6) AS similarity FROM (
      SELECT q.id AS query_id, t.id AS doc_id, CAST(sum(q.weight * t.weight) AS DOUBLE) AS d
      FROM {queries} q JOIN {docs} t ON q.bucket = t.bucket {"WHERE q.id <> t.id" if other else ""} GROUP BY 1, 2)
    JOIN (SELECT id AS query_id, CAST(sum(weight * weight) AS DOUBLE) AS qn FROM {queries} GROUP BY 1) USING (query_id)
    JOIN (SELECT id AS doc_id, CAST(sum(weight * weight) AS DOUBLE) AS dn FROM {docs} GROUP BY 1) USING (doc_id))
  {"" if floor is None else f"WHERE similarity >= {floor}"})
WHERE rank < {k}"""


POSITIVES = f"""
SELECT 'pos_' || id || '_' || source_row AS training_sample_id, title AS query_text, text AS document_text,
       'positive' AS label, 1.0::DOUBLE AS similarity_score, 'query_' || id AS query_id, id AS document_id,
       'title_text' AS pair_type, source_row, {STAMP} AS event_timestamp
FROM numbered WHERE title IS NOT NULL AND text IS NOT NULL"""

DRAWS = f"""
draws AS (
  SELECT i, q AS query_row, (q + 1 + {draw(f"'{c.SEED}:' || i || ':d'")} % (n - 1)) % n AS doc_row FROM (
    SELECT i, n, {draw(f"'{c.SEED}:' || i || ':q'")} % n AS q
    FROM (SELECT unnest(range(CAST(floor(0.5 * (SELECT count(*) FROM valid)) AS BIGINT))) AS i),
         (SELECT count(*) AS n FROM passages)))"""

NEGATIVES = f"""
SELECT 'neg_' || q.id || '_' || d.id || '_' || i AS training_sample_id, q.title AS query_text,
       d.text AS document_text, 'negative' AS label, 0.0::DOUBLE AS similarity_score, 'query_' || q.id AS query_id,
       d.id AS document_id, 'random_negative' AS pair_type, query_row, doc_row, {STAMP} AS event_timestamp
FROM draws JOIN numbered q ON q.source_row = query_row JOIN numbered d ON d.source_row = doc_row
WHERE q.title IS NOT NULL AND d.text IS NOT NULL"""

MINED = f"""
title_counts AS ({counts("valid", "title")}),
text_counts AS ({counts("valid", "text")}),
mined AS ({sparse_top("title_counts", "text_counts", 2, 0.3, True)})"""

HARD = f"""
SELECT 'hard_neg_' || query_id || '_' || doc_id || '_' || rank AS training_sample_id, q.title AS query_text,
       d.text AS document_text, 'hard_negative' AS label, similarity AS similarity_score,
       'query_' || query_id AS query_id, doc_id AS document_id, 'hard_negative' AS pair_type,
       q.valid_row AS query_row, d.valid_row AS doc_row, {STAMP} AS event_timestamp
FROM mined JOIN valid q ON q.id = query_id JOIN valid d ON d.id = doc_id"""

SHARED = "query_text, document_text, label, similarity_score, query_id, document_id, event_timestamp"


def training(passages: str) -> str:
    return f"""{passages}, {DRAWS}, {MINED},
positives AS ({POSITIVES}), negatives AS ({NEGATIVES}), hard AS ({HARD}),
training AS (
  SELECT 'sample_' || (row_number() OVER (ORDER BY md5('{c.SEED}:' || pair_key), pair_key) - 1) AS training_sample_id,
         {SHARED}, pair_key
  FROM (SELECT training_sample_id AS pair_key, {SHARED} FROM positives
        UNION ALL SELECT training_sample_id, {SHARED} FROM negatives
        UNION ALL SELECT training_sample_id, {SHARED} FROM hard))"""


TRAINING = training(PASSAGES)

SPLIT = f"""
tested AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{c.SEED}:' || training_sample_id)) <= 20 AS test
  FROM training),
split AS (
  SELECT training_sample_id, label, CASE
    WHEN test THEN 'test'
    WHEN row_number() OVER (PARTITION BY test ORDER BY md5('{c.SEED}:split:' || training_sample_id))
         <= floor(0.8 * count(*) OVER (PARTITION BY test)) THEN 'train' ELSE 'eval' END AS split
  FROM tested)"""


def shard(epoch: int) -> str:
    return f"""
SELECT training_sample_id, {epoch}::BIGINT AS epoch, p % {c.WORLD} AS shard, (p // {c.WORLD}) // {c.BATCH} AS batch
FROM (SELECT training_sample_id,
             row_number() OVER (ORDER BY md5('{c.SEED}:{epoch}:' || training_sample_id)) - 1 AS p FROM training)"""


VECTOR_PAIRS = """
vp AS (
  SELECT *, CASE WHEN a_label = b_label THEN 'positive' WHEN similarity >= 0.1 THEN 'hard_negative'
            ELSE 'negative' END AS label FROM (
    SELECT a.vec_id AS a_id, b.vec_id AS b_id, a.label AS a_label, b.label AS b_label,
           a.embedding::DOUBLE[] AS qv, b.embedding::DOUBLE[] AS dv,
           list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = (a.vec_id * 7 + 1) % (SELECT count(*) FROM embeddings)
    WHERE a.vec_id <> b.vec_id)),
pairs AS (
  SELECT 'vp_' || a_id AS training_sample_id, label, similarity, round(similarity, 6) AS similarity_score,
         'q' || a_id AS query_id, 'd' || b_id AS document_id, qv, dv,
         TIMESTAMP '2024-01-01' + to_days(CAST(a_id % 28 AS INTEGER)) AS event_timestamp FROM vp)"""

FINAL = """
stats AS (
  SELECT avg(similarity) FILTER (label = 'positive') AS pm, stddev_pop(similarity) FILTER (label = 'positive') AS ps,
         avg(similarity) FILTER (label <> 'positive') AS nm, stddev_pop(similarity) FILTER (label <> 'positive') AS ns
  FROM pairs),
final AS (
  SELECT *, pm - nm AS sep, CASE WHEN pm - nm IS NULL THEN 0.0 ELSE
    ((CASE WHEN pm > 0 THEN least(pm, 1.0) ELSE 0.0 END)
     + (CASE WHEN pm - nm > 0 THEN least((pm - nm) / 0.6, 1.0) ELSE 0.0 END)) / 2 END AS score FROM stats)"""

PIT = f"""
SELECT s.event_id, s.user_id, s.ts,
       CASE WHEN f.ts >= s.ts - INTERVAL 7 DAY THEN f.event_id END AS click_id,
       CASE WHEN f.ts >= s.ts - INTERVAL 7 DAY THEN f.value END AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') s
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') f ON s.user_id = f.user_id AND s.ts >= f.ts"""


def as_of(kind: str, days: int) -> str:
    return f"""(SELECT s.event_id, CASE WHEN f.ts >= s.ts - INTERVAL {days} DAY THEN f.event_id END AS {kind}_id,
       CASE WHEN f.ts >= s.ts - INTERVAL {days} DAY THEN f.value END AS {kind}_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') s
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = '{kind}') f ON s.user_id = f.user_id AND s.ts >= f.ts)"""


def latest(order: str, where: str = "") -> str:
    return f"""SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS r FROM events {where}) WHERE r = 1"""


def vector_top(k: int, floor: float | None, other: bool) -> str:
    keep = ["rank < %d" % k]
    pair = "WHERE a.vec_id <> b.vec_id" if other else ""
    return f"""
SELECT query_id, doc_id, similarity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, doc_id) - 1 AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
           round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
    FROM embeddings a CROSS JOIN embeddings b {pair})
  {"" if floor is None else f"WHERE similarity >= {floor}"}) WHERE {keep[0]}"""


TOP5 = f"SELECT query_id, doc_id AS id, similarity AS distance, rank FROM ({vector_top(5, None, False)})"

REFRESH = f"""WITH {VECTOR_PAIRS},
asked AS (
  SELECT *, row_number() OVER (ORDER BY k, training_sample_id) - 1 AS i FROM (
    SELECT *, md5('{c.SEED}:refresh5q:' || training_sample_id) AS k FROM pairs WHERE label = 'positive')
  QUALIFY i < 10),
pool AS (
  SELECT *, row_number() OVER (ORDER BY k, training_sample_id) - 1 AS slot FROM (
    SELECT *, md5('{c.SEED}:refresh5d:' || training_sample_id) AS k FROM pairs)
  QUALIFY slot < 100),
met AS (
  SELECT a.i, j, a.query_id, p.document_id, round(list_cosine_similarity(a.qv, p.dv), 6) AS s
  FROM asked a, (SELECT unnest(range(10)) AS j), pool p
  WHERE j < (SELECT count(*) FROM pool) AND p.slot = (a.i * 10 + j) % (SELECT count(*) FROM pool)),
new AS (
  SELECT *, row_number() OVER (ORDER BY i, j) - 1 AS n FROM met m
  WHERE s > {c.BAND[0]} AND s < {c.BAND[1]} AND NOT EXISTS (
    SELECT 1 FROM pairs k WHERE k.label = 'positive' AND k.query_id = m.query_id AND k.document_id = m.document_id)
  QUALIFY n < least(25, (SELECT count(*) FROM pairs WHERE label = 'hard_negative'))),
old AS (
  SELECT training_sample_id FROM pairs WHERE label = 'hard_negative'
  QUALIFY row_number() OVER (ORDER BY event_timestamp, training_sample_id) <= (SELECT count(*) FROM new))
SELECT training_sample_id, label, similarity_score, query_id, document_id, event_timestamp FROM pairs
WHERE training_sample_id NOT IN (SELECT training_sample_id FROM old)
UNION ALL
SELECT 'dynamic_hard_' || n || '_20240201000000', 'hard_negative', s, 'dynamic_' || query_id, 'dynamic_doc_' || j,
       {STAMP} FROM new"""

def _band_draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


REFRESH_ALL = f"""WITH {VECTOR_PAIRS},
asked AS (SELECT *, row_number() OVER (ORDER BY md5('{c.SEED}:refresh5q:' || training_sample_id), training_sample_id) - 1 AS i FROM pairs WHERE label = 'positive'),
met AS (
  SELECT a.i, a.query_id, d.training_sample_id AS d, d.document_id AS doc, round(list_cosine_similarity(a.qv, d.dv), 6) AS s,
         xor({_band_draw(f"'{c.SEED}:refresh5:' || a.training_sample_id")}, {_band_draw(f"'{c.SEED}:refresh5:' || d.training_sample_id")}) AS priority
  FROM asked a CROSS JOIN pairs d),
banded AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY priority, d) - 1 AS j FROM met m WHERE s > 0.4 AND s < 0.8 AND NOT EXISTS (
    SELECT 1 FROM pairs k WHERE k.label = 'positive' AND k.query_id = m.query_id AND k.document_id = m.doc)),
new AS (
  SELECT *, row_number() OVER (ORDER BY i, j) - 1 AS n FROM banded WHERE j < 10
  QUALIFY n < least({c.REFRESH_ALL}, (SELECT count(*) FROM pairs WHERE label = 'hard_negative'))),
old AS (
  SELECT training_sample_id FROM pairs WHERE label = 'hard_negative'
  QUALIFY row_number() OVER (ORDER BY event_timestamp, training_sample_id) <= (SELECT count(*) FROM new))
SELECT training_sample_id, label, similarity_score, query_id, document_id, event_timestamp FROM pairs
WHERE training_sample_id NOT IN (SELECT training_sample_id FROM old)
UNION ALL
SELECT 'dynamic_hard_' || n || '_20240201000000', 'hard_negative', s, 'dynamic_' || query_id, 'dynamic_doc_' || j, {STAMP} FROM new"""

GRADES = f"""WITH {VECTOR_PAIRS},
shares AS (SELECT unnest({list(c.SELF_IN_TEN)})::BIGINT AS k),
means AS (SELECT k, avg(CASE WHEN CAST(substr(query_id, 2) AS BIGINT) % 10 < k THEN list_cosine_similarity(qv, qv) ELSE similarity END) AS p,
  avg(similarity) FILTER (label <> 'positive') AS n FROM pairs, shares GROUP BY k),
scored AS (SELECT *, (CASE WHEN p > 0 THEN least(p, 1.0) ELSE 0 END + CASE WHEN p - n > 0 THEN least((p - n) / 0.6, 1.0) ELSE 0 END) / 2 AS score FROM means)
SELECT k AS self_in_ten, round(p, 6) AS positive_similarity_mean, round(n, 6) AS negative_similarity_mean, round(score, 6) AS overall_quality_score,
  CASE WHEN score >= 0.8 THEN 'excellent' WHEN score >= 0.6 THEN 'good' WHEN score >= 0.4 THEN 'moderate' ELSE 'poor' END AS grade FROM scored"""

# Rows of each epoch of the logged run: a refresh puts as many hard negatives in as it takes out.
LOGGED = f"""WITH {TRAINING}, {SPLIT},
sizes AS (SELECT count(*) FILTER (split <> 'test') AS n, CAST(floor(0.8 * count(*) FILTER (split <> 'test')) AS BIGINT) AS train FROM split),
per_epoch AS (SELECT CAST(ceil(ceil(train / {c.LOG_CONFIG.world_size}) / {c.LOG_CONFIG.batch_size}) AS BIGINT) AS steps FROM sizes),
epochs AS (SELECT unnest(range(1, {c.LOG_CONFIG.epochs + 1}))::INTEGER AS step)"""
LOG = f"""{LOGGED}
SELECT tag, step, value::DOUBLE AS value FROM epochs, (
  SELECT 'Dataset/Total_Size' AS tag, n AS value FROM sizes UNION ALL SELECT 'Dataset/Train_Size', train FROM sizes UNION ALL SELECT 'Dataset/Eval_Size', n - train FROM sizes
  UNION ALL SELECT 'Dataset/' || label || '_count', count(*) FROM split WHERE split <> 'test' GROUP BY label)
UNION ALL SELECT 'Training/Steps', step, step * steps FROM epochs, per_epoch"""
RECORD = f"""{LOGGED}
SELECT 'HashingEncoder' AS base_model, 'ContrastiveLoss' AS loss_function, {c.LOG_CONFIG.epochs}::INTEGER AS epochs, {c.LOG_CONFIG.batch_size}::INTEGER AS batch_size,
  {c.LOG_CONFIG.learning_rate}::DOUBLE AS learning_rate, {c.LOG_CONFIG.world_size}::INTEGER AS world_size, {c.LOG_CONFIG.hard_negative_update_freq}::INTEGER AS hard_negative_update_freq,
  {c.LOG_CONFIG.epochs}::INTEGER AS epochs_completed, {STAMP} AS timestamp, {c.LOG_CONFIG.warmup}::INTEGER AS warmup_steps, {c.LOG_CONFIG.epochs} * steps AS steps FROM per_epoch"""

LOSS = """0.5 * (CASE WHEN label = 'positive' THEN (1 - similarity) * (1 - similarity)
                 ELSE power(greatest(0.0, 0.5 - (1 - similarity)), 2) END)"""

IDENTITY = f"SELECT list_transform(range(1, {c.VECTOR_DIM + 1}), lambda i: list_transform(range(1, {c.VECTOR_DIM + 1}), lambda j: CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS m"


def mapped(matrix: str, rows: str, keep: str) -> str:
    """Pairs with what the loss and its gradient need, after ``matrix`` has mapped both vectors; ``rows`` has ``qv, dv, y``."""
    return f"""
SELECT {keep}, qv, dv, loss, list_transform(range(1, len(u) + 1), lambda i: pull * (v[i] / (un * vn) - cosine * u[i] / (un * un))) AS du,
       list_transform(range(1, len(u) + 1), lambda i: pull * (u[i] / (un * vn) - cosine * v[i] / (vn * vn))) AS dv2
FROM (SELECT *, 0.5 * (y * (1 - cosine) * (1 - cosine) + (1 - y) * slack * slack) AS loss, (1 - y) * slack - y * (1 - cosine) AS pull
      FROM (SELECT *, greatest(0.0, 0.5 - (1 - cosine)) AS slack
            FROM (SELECT *, list_dot_product(u, v) / (un * vn) AS cosine
                  FROM (SELECT *, sqrt(list_dot_product(u, u)) AS un, sqrt(list_dot_product(v, v)) AS vn
                        FROM (SELECT *, list_transform({matrix}, lambda r: list_dot_product(r, qv)) AS u, list_transform({matrix}, lambda r: list_dot_product(r, dv)) AS v FROM {rows})
                        WHERE list_dot_product(u, u) > 0 AND list_dot_product(v, v) > 0))))"""


def full_batch() -> str:
    """One gradient step an epoch: the matrix after each epoch, and the mean loss before it."""
    parts = [f"m0 AS ({IDENTITY})", "given AS (SELECT *, CASE WHEN label = 'positive' THEN 1.0 ELSE 0.0 END AS y FROM pairs)"]
    for e in range(c.EPOCHS):
        parts.append(f"g{e} AS (SELECT du, dv2, qv, dv, loss FROM ({mapped('m', f'(SELECT given.*, m FROM given, m{e})', 'training_sample_id')}))")
        parts.append(f"""cell{e} AS (
  SELECT i, j, avg(du[i] * qv[j] + dv2[i] * dv[j]) AS g FROM (SELECT *, unnest(range(1, {c.VECTOR_DIM + 1})) AS j FROM (SELECT *, unnest(range(1, {c.VECTOR_DIM + 1})) AS i FROM g{e})) GROUP BY i, j)""")
        parts.append(f"""m{e + 1} AS (
  SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(m[i][j] - {c.RATE} * g ORDER BY j) AS r FROM cell{e}, m{e} GROUP BY i))""")
    losses = " UNION ALL ".join(f"SELECT {e}::BIGINT AS epoch, round(avg(loss), 6) AS loss FROM g{e}" for e in range(c.EPOCHS))
    return f"WITH {VECTOR_PAIRS}, {', '.join(parts)} {losses}"


def local_steps() -> str:
    """Steps by batch in each shard, one recursion an epoch, and the mean of the shards' matrices behind it."""
    size, rows = c.VECTOR_DIM + 1, "(SELECT *, CASE WHEN label = 'positive' THEN 1.0 ELSE 0.0 END AS y FROM pairs)"
    parts, losses = [f"m0 AS ({IDENTITY})"], []
    for e in range(c.EPOCHS):
        parts.append(f"""dealt{e} AS (
  SELECT p % {c.WORLD} AS shard, (p // {c.WORLD}) // {c.BATCH} AS batch, y, qv, dv FROM (
    SELECT *, row_number() OVER (ORDER BY md5('{c.SEED}:{e}:' || training_sample_id)) - 1 AS p FROM {rows}))""")
        first = " + ".join(["0", *(f"(SELECT max(batch) + 1 FROM dealt{k})" for k in range(e))])
        parts.append(f"""run{e}(shard, step, m, loss, n) AS (
  SELECT shard, 0::BIGINT, m, 0.0::DOUBLE, 0::BIGINT FROM (SELECT DISTINCT shard FROM dealt{e}), m{e}
  UNION ALL
  SELECT shard, step + 1, list_transform(range(1, {size}), lambda i: list_transform(range(1, {size}), lambda j:
           m[i][j] - rate * list_sum(list_transform(g, lambda x: x.du[i] * x.qv[j] + x.dv2[i] * x.dv[j])))),
         list_sum(list_transform(g, lambda x: x.loss)), len(g)
  FROM (SELECT shard, step, any_value(m) AS m, {c.LOCAL_RATE} * least(1.0, (step + 1 + {first}) / {c.WARMUP}.0) / count(*) AS rate, list({{'du': du, 'dv2': dv2, 'qv': qv, 'dv': dv, 'loss': loss}}) AS g
        FROM ({mapped('m', f'(SELECT r.shard, r.step, r.m, d.y, d.qv, d.dv FROM run{e} r JOIN dealt{e} d ON d.shard = r.shard AND d.batch = r.step)', 'shard, step, m')})
        GROUP BY shard, step))""")
        parts.append(f"""m{e + 1} AS (
  SELECT list_transform(range(1, {size}), lambda i: list_transform(range(1, {size}), lambda j: list_avg(list_transform(ms, lambda m: m[i][j])))) AS m
  FROM (SELECT list(m) AS ms FROM (SELECT arg_max(m, step) AS m FROM run{e} GROUP BY shard)))""")
        losses.append(f"SELECT {e}::BIGINT AS epoch, round(sum(loss) / sum(n), 6) AS loss, sum(n)::BIGINT AS n_rows, max(step) AS n_steps FROM run{e}")
    trace = f"(SELECT round(list_sum(list_transform(range(1, {size}), lambda i: m[i][i])), 6) FROM m{c.EPOCHS})"
    return f"WITH RECURSIVE {VECTOR_PAIRS}, {', '.join(parts)} SELECT *, {trace} AS final_trace FROM ({' UNION ALL '.join(losses)})"


ORACLE = {
    "chunk_passages": f"SELECT {CHUNK_ID} AS id, piece AS text FROM ({chunks('(SELECT doc_id AS id, text FROM documents)')})",
    "chunk_profile": f"""
SELECT 'before' AS stage, count(*) AS n_rows, CAST(max(length(text)) AS BIGINT) AS max_length,
       count(*) FILTER (length(text) > 512) AS n_over FROM documents
UNION ALL
SELECT 'after', count(*), CAST(max(length(piece)) AS BIGINT), count(*) FILTER (length(piece) > 380)
FROM ({chunks('(SELECT doc_id AS id, text FROM documents)')})""",
    "passage_coverage": """
SELECT CAST(doc_id AS VARCHAR) AS id, length(replace(replace(text, ' ', ''), chr(10), '')) AS n_chars FROM documents""",
    "positive_pairs": f"WITH {PASSAGES} {POSITIVES}",
    "positive_pairs_by_file": f"WITH {FILED} {POSITIVES}",
    "training_set_by_file": f"WITH {training(FILED)} SELECT * FROM training",
    "random_negatives": f"WITH {PASSAGES}, {DRAWS} {NEGATIVES}",
    "query_table": f"""WITH {PASSAGES},
titles AS (SELECT min(id) AS id, title FROM passages WHERE title IS NOT NULL GROUP BY title),
hashed AS ({counts("titles", "title")})
SELECT 'query_' || t.id AS query_id, title AS query_text, 'title' AS query_type, {STAMP} AS event_timestamp,
       {c.DIM}::BIGINT AS dim, CAST(coalesce(sum(weight * weight), 0) AS BIGINT) AS norm_squared
FROM titles t LEFT JOIN hashed h ON h.id = t.id GROUP BY t.id, title""",
    "hash_tokens": f"WITH {PASSAGES} {counts('passages', 'text')}",
    "hard_negatives_vec": f"""
SELECT query_id, doc_id AS document_id, label AS doc_label, similarity, rank
FROM ({vector_top(2, 0.3, True)}) JOIN embeddings ON vec_id = doc_id""",
    "hard_negatives_text": f"WITH {PASSAGES}, {MINED} {HARD}",
    "training_set": f"WITH {TRAINING} SELECT * FROM training",
    "pairs_round_trip": f"WITH {TRAINING} SELECT * FROM training",
    "queries_round_trip": f"""WITH {PASSAGES}
SELECT 'query_' || min(id) AS query_id, title AS query_text, 'title' AS query_type, {STAMP} AS event_timestamp, {c.DIM}::BIGINT AS dim
FROM passages WHERE title IS NOT NULL GROUP BY title""",
    "load_pairs_pit": f"WITH {TRAINING} SELECT training_sample_id, {SHARED} FROM training",
    "load_pairs_first": f"""WITH {TRAINING} SELECT training_sample_id, {SHARED} FROM training
ORDER BY training_sample_id LIMIT {c.FIRST}""",
    "spine_completed": f"""WITH p AS (
  SELECT a.text AS query_text, b.text AS document_text FROM conversations a JOIN conversations b
  ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant')
SELECT 'sample_' || (row_number() OVER (ORDER BY md5('spine:' || query_text || ':' || document_text), query_text, document_text) - 1)
  AS training_sample_id, query_text, document_text, {STAMP} AS event_timestamp FROM p""",
    "chunks_written": f"WITH {PASSAGES} SELECT {CHUNK_ID} AS id, piece AS text FROM ({chunks('passages')})",
    "version_history": f"""WITH u AS (SELECT user_id, min(ts) AS first FROM events
  WHERE ts > TIMESTAMP '{c.CUTS[0] - c.WINDOW}' AND ts <= TIMESTAMP '{c.CUTS[1]}' GROUP BY user_id),
n AS (SELECT count(*) FILTER (first <= TIMESTAMP '{c.CUTS[0]}') AS one, count(*) AS two FROM u)
SELECT 1::INTEGER AS version, 'delta' AS kind, '{c.CUTS[0].isoformat(sep=" ", timespec="microseconds")}' AS upto, one AS n_rows FROM n
UNION ALL SELECT 2, 'delta', '{c.CUTS[1].isoformat(sep=" ", timespec="microseconds")}', two FROM n""",
    "label_composition": f"""WITH {TRAINING}
SELECT coalesce(label, 'total') AS label, count(*) AS n FROM training GROUP BY ROLLUP (label)""",
    "holdout_split": f"""WITH {TRAINING}, {SPLIT}
SELECT training_sample_id, label, CASE WHEN label = 'positive' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target, split
FROM split""",
    "split_sizes": f"WITH {TRAINING}, {SPLIT} SELECT split, count(*) AS n FROM split GROUP BY split",
    "holdout_fallback": f"""
WITH ids AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM documents),
tested AS (SELECT id, row_number() OVER (ORDER BY md5('{c.SEED}:' || id), id)
             <= least(60, floor(0.1 * (SELECT count(*) FROM ids))) AS test FROM ids)
SELECT id AS training_sample_id, CASE WHEN test THEN 'test'
    WHEN row_number() OVER (PARTITION BY test ORDER BY md5('{c.SEED}:split:' || id))
         <= floor(0.8 * count(*) OVER (PARTITION BY test)) THEN 'train' ELSE 'eval' END AS split FROM tested""",
    "train_shards": f"WITH {TRAINING} {shard(0)} UNION ALL {shard(1)}",
    "in_batch_negatives": f"""
WITH pairs AS (
  SELECT a.conv_id || '_' || a.turn AS id, 'q_' || a.conv_id || '_' || a.turn AS q,
         'd_' || b.conv_id || '_' || b.turn AS d
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant'),
batched AS (SELECT *, (row_number() OVER (ORDER BY md5('{c.SEED}:' || id), id) - 1) // {c.BATCH} AS batch FROM pairs)
SELECT x.batch, x.q AS query_id, y.d AS document_id FROM batched x JOIN batched y ON x.batch = y.batch AND x.id <> y.id""",
    "pit_features": PIT,
    "pit_features_sliced": PIT,
    "historical_features": """
SELECT s.event_id AS purchase_id, s.user_id, s.at AS event_timestamp,
       CASE WHEN f.ts >= s.at - INTERVAL 30 DAY THEN f.event_id END AS event_id,
       CASE WHEN f.ts >= s.at - INTERVAL 30 DAY THEN f.event_type END AS event_type,
       CASE WHEN f.ts >= s.at - INTERVAL 30 DAY THEN f.value END AS value
FROM (SELECT *, ts - INTERVAL 1 SECOND AS at FROM events WHERE event_type = 'purchase') s
ASOF LEFT JOIN events f ON s.user_id = f.user_id AND s.at >= f.ts""",
    "historical_many": "SELECT event_id, user_id, ts AS event_timestamp, " + ", ".join(f"{k}_id, {k}_value" for k in c.LIFETIMES)
    + " FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') " + " ".join(f"JOIN {as_of(k, d)} USING (event_id)" for k, d in c.LIFETIMES.items()),
    "source_readiness": """
SELECT 'user_events' AS view, true AS path_found, true AS schema_ok, count(*) AS n_rows, count(*) > 0 AS ready FROM events
UNION ALL SELECT 'wiki_passages', false, false, 0, false""",
    "end_to_end": f"""WITH {PASSAGES}
SELECT unnest(['views_registered', 'encoder_inference', 'training_data', 'vector_dimensions']) AS check_name,
       (SELECT count(*) FROM benchmark) > 0 AND (SELECT count(*) FROM valid) > 0 AS passed""",
    "latest_per_key": latest("ts DESC, event_id DESC"),
    "latest_without_time": latest("event_id DESC"),
    "incremental_materialize": latest(
        "ts DESC, event_id DESC", f"WHERE ts > TIMESTAMP '{c.CUTS[0] - c.WINDOW}' AND ts <= TIMESTAMP '{c.CUTS[1]}'"),
    "keyed_materialize": latest(
        "ts DESC, event_id DESC", f"WHERE ts > TIMESTAMP '{c.CUTS[0] - c.WINDOW}' AND ts <= TIMESTAMP '{c.CUTS[1]}'"),
    "keyed_lookup": f"""
SELECT c_custkey AS user_id, event_id, event_type, value
FROM customer LEFT JOIN ({latest("ts DESC, event_id DESC")}) ON user_id = c_custkey""",
    "online_lookup": f"""
SELECT c_custkey AS user_id, event_id, event_type, value
FROM customer LEFT JOIN ({latest("ts DESC, event_id DESC")}) ON user_id = c_custkey""",
    "stream_materialize": latest("ts DESC, event_id DESC"),
    "vector_topk": TOP5,
    "vector_topk_pruned": TOP5,
    "vector_topk_blocks": TOP5,
    "vector_topk_followed": TOP5,
    "vector_topk_ivf": TOP5,
    "rag_answer": f"""WITH {PASSAGES},
chunked AS (SELECT {CHUNK_ID} AS id, piece AS text FROM ({chunks('passages')})),
chunk_counts AS ({counts("chunked", "text")}),
question_counts AS ({counts("(SELECT item_id AS id, text FROM benchmark)", "text")})
SELECT query_id AS item_id, doc_id AS id, similarity AS distance, rank, text
FROM ({sparse_top("question_counts", "chunk_counts", 10, None, False)}) JOIN chunked ON chunked.id = doc_id""",
    "reembed_corpus": f"""WITH {PASSAGES},
chunked AS (SELECT {CHUNK_ID} AS id, piece AS text FROM ({chunks('passages')})),
hashed AS ({counts("chunked", "text")})
SELECT t.id, {c.DIM}::BIGINT AS dim, CAST(coalesce(sum(weight * weight), 0) AS BIGINT) AS norm_squared
FROM chunked t LEFT JOIN hashed h ON h.id = t.id GROUP BY t.id""",
    "reembed_adapted": f"""WITH {PASSAGES}, hashed AS ({counts("passages", "text")}) {adapted("passages", "hashed", "id")}""",
    "on_demand_lookup": f"""WITH asked AS (SELECT item_id AS id, text FROM benchmark), hashed AS ({counts("asked", "text")})
{adapted("asked", "hashed", "item_id")}""",
    "refresh_negatives": REFRESH,
    "refresh_all": REFRESH_ALL,
    "eval_by_label": f"""WITH {VECTOR_PAIRS}
SELECT label, count(*) AS n, round(avg(similarity), 6) AS mean_similarity FROM pairs GROUP BY label""",
    "eval_gaps": f"""WITH {VECTOR_PAIRS}, m AS (
  SELECT avg(similarity) FILTER (label = 'positive') AS p, avg(similarity) FILTER (label = 'hard_negative') AS h,
         avg(similarity) FILTER (label = 'negative') AS n FROM pairs)
SELECT round(p, 6) AS positive_similarity, round(h, 6) AS hard_negative_similarity,
       round(n, 6) AS negative_similarity, round(p - h, 6) AS pos_hard_gap, round(p - n, 6) AS pos_neg_gap FROM m""",
    "eval_final": f"""WITH {VECTOR_PAIRS}, {FINAL}
SELECT round(pm, 6) AS positive_similarity_mean, round(ps, 6) AS positive_similarity_std,
       round(nm, 6) AS negative_similarity_mean, round(ns, 6) AS negative_similarity_std,
       round(sep, 6) AS similarity_separation, round(score, 6) AS overall_quality_score,
       CASE WHEN score >= 0.8 THEN 'excellent' WHEN score >= 0.6 THEN 'good' WHEN score >= 0.4 THEN 'moderate'
            ELSE 'poor' END AS grade FROM final""",
    "eval_grades": GRADES,
    "eval_metrics_table": f"""WITH {VECTOR_PAIRS}, {FINAL}
SELECT 'run' AS run_id, 'Final_Evaluation/' || tag AS tag, 1::INTEGER AS step, round(value, 6) AS value FROM final,
  LATERAL (VALUES ('positive_similarity_mean', pm), ('positive_similarity_std', ps), ('negative_similarity_mean', nm),
    ('negative_similarity_std', ns), ('similarity_separation', sep), ('overall_quality_score', score)) t(tag, value)
WHERE value IS NOT NULL
UNION ALL
SELECT 'run', 'Dataset/' || label || '_count', 1, count(*)::DOUBLE FROM pairs GROUP BY label""",
    "contrastive_loss": f"""WITH {VECTOR_PAIRS}
SELECT count(similarity) AS n, round(avg({LOSS}), 6) AS loss FROM pairs""",
    "training_log": LOG,
    "run_record": RECORD,
    "adapter_training": full_batch(),
    "adapter_training_sharded": local_steps(),
    "view_validation": f"""WITH {PASSAGES},
checks AS (SELECT unnest(['missing_columns', 'wrong_types', 'null_keys', 'null_times', 'wrong_vector_lengths']) AS k)
SELECT v AS view, k AS check_name, CASE WHEN v <> 'wiki_passages' THEN 0
  WHEN k = 'wrong_vector_lengths' THEN (SELECT count(*) FROM passages WHERE title IS NULL)
  WHEN k = 'null_keys' THEN (SELECT count(*) FROM documents WHERE doc_id % 7 = 0)
  WHEN k = 'null_times' THEN (SELECT count(*) FROM documents WHERE doc_id % 5 = 0) ELSE 0 END::BIGINT AS failed
FROM checks, (SELECT unnest(['wiki_passages', 'embedding_training_pairs', 'query_embeddings']) AS v)""",
}
