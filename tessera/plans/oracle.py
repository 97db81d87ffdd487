"""DuckDB SQL that states each registered query independently of Spark.

Tables are the pre-registered views (documents, labels, ...).  Arrays are
returned as space-joined strings, floats rounded to 6 places, integers BIGINT —
the Spark side does the same.
"""

from __future__ import annotations

from tessera.functions import text as T
from tessera.plans import common as C

SQL: dict[str, str] = {}


def _q(s: str) -> str:
    return s.replace("'", "''")


SPACE = _q(T.SPACE)
SPLIT = _q(T.SPLIT_PATTERN)
SPACED_SPLIT = f"({SPACE})"
GLUE = _q("[" + "".join("\\" + c if c in "\\]^-[" else c for c in T.DECODE_GLUE_CHARS) + "]")


def tok(name: str, src: str, id_col: str, text: str = "text") -> str:
    """CTEs ``{name}`` = (id, pos, token): split on delimiters with \\x01
    markers (no look-ahead in RE2), drop blank pieces."""
    return f"""{name}_s AS (
  SELECT {id_col} AS id,
         list_filter(string_split(regexp_replace({text}, '{SPLIT}', chr(1) || '\\1' || chr(1), 'g'), chr(1)),
                     lambda x: NOT regexp_full_match(x, '{SPACE}*')) AS toks
  FROM {src}),
{name} AS (
  SELECT id, unnest(generate_series(0, len(toks) - 1)) AS pos, unnest(toks) AS token FROM {name}_s)"""


def vocab(name: str, toks: str) -> str:
    return f"""{name} AS (
  SELECT token, (row_number() OVER (ORDER BY token) - 1)::BIGINT AS token_id
  FROM (SELECT DISTINCT token FROM {toks}))"""


def specials(name: str, base: str) -> str:
    return f"""{name} AS (
  SELECT token, token_id FROM {base}
  UNION ALL SELECT '{T.END_OF_TEXT}', (SELECT count(*) FROM {base})::BIGINT
  UNION ALL SELECT '{T.UNKNOWN}', (SELECT count(*) FROM {base})::BIGINT + 1)"""


def encoded_docs(name: str = "enc") -> str:
    """(id, ids LIST) of all documents with the all-documents vocabulary."""
    return f"""{tok('dt', 'documents', 'doc_id')},
{vocab('dv', 'dt')},
{name} AS (
  SELECT d.doc_id AS id,
         coalesce(list(v.token_id ORDER BY t.pos) FILTER (WHERE t.pos IS NOT NULL), []::BIGINT[]) AS ids
  FROM documents d LEFT JOIN dt t ON t.id = d.doc_id LEFT JOIN dv v ON v.token = t.token
  GROUP BY d.doc_id)"""


def ids_str(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


def shuffled(name: str, src: str, id_col: str, extra: str = "") -> str:
    return f"""{name} AS (
  SELECT {id_col}{extra}, (row_number() OVER (ORDER BY md5('{C.SEED}:' || {id_col}::VARCHAR), {id_col}) - 1)::BIGINT AS rk,
         count(*) OVER () AS n
  FROM {src})"""


def split_of(rk: str = "rk", n: str = "n") -> str:
    te = f"floor({n}::DOUBLE * {C.TRAIN_FRAC}::DOUBLE)"
    ve = f"({te} + floor({n}::DOUBLE * {C.VALIDATION_FRAC}::DOUBLE))"
    return f"CASE WHEN {rk} < {te} THEN 'train' WHEN {rk} < {ve} THEN 'validation' ELSE 'test' END"


# ---------------------------------------------------------------- corpus
SQL["word_tokens"] = f"""WITH {tok('t', 'documents', 'doc_id')}
SELECT id AS doc_id, pos::BIGINT AS pos, token FROM t"""

SQL["corpus_stats"] = f"""WITH {tok('t', 'documents', 'doc_id')}
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
       (SELECT coalesce(sum(length(text)), 0) FROM documents)::BIGINT AS n_chars,
       (SELECT count(*) FROM t)::BIGINT AS n_tokens,
       (SELECT count(DISTINCT token) FROM t)::BIGINT AS vocab_size"""

SQL["vocab"] = f"""WITH {tok('t', 'documents', 'doc_id')}, {vocab('v', 't')}
SELECT token, token_id FROM v"""

SQL["vocab_special"] = f"""WITH {tok('t', 'documents', 'doc_id')}, {vocab('v', 't')}, {specials('vs', 'v')}
SELECT token, token_id FROM vs"""

SQL["vocab_head"] = f"""WITH {tok('t', 'documents', 'doc_id')}, {vocab('v', 't')}, {specials('vs', 'v')}
SELECT token, token_id FROM vs ORDER BY token_id LIMIT 51"""

SQL["encode_strict"] = f"""WITH {encoded_docs()}
SELECT id AS doc_id, {ids_str('ids')} AS ids FROM enc"""

_EN = f"""{tok('et', 'documents', 'doc_id')},
{vocab('ev', 'et')}, {specials('evs', 'ev')},
{tok('bt', 'benchmark', 'item_id')}"""

SQL["encode_unk"] = f"""WITH {_EN}
SELECT b.item_id,
       coalesce(string_agg(coalesce(v.token_id, (SELECT token_id FROM evs WHERE token = '{T.UNKNOWN}'))::VARCHAR,
                           ' ' ORDER BY t.pos), '') AS ids
FROM benchmark b LEFT JOIN bt t ON t.id = b.item_id LEFT JOIN evs v ON v.token = t.token
GROUP BY b.item_id"""

SQL["encode_spaced"] = SQL["encode_unk"].replace(SPLIT, SPACED_SPLIT)

SQL["decode_characters"] = f"""WITH dv AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(?s).')) AS token FROM documents),
bl AS (SELECT item_id, regexp_extract_all(text, '(?s).') AS l FROM benchmark),
bt AS (SELECT item_id, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS token FROM bl)
SELECT b.item_id, coalesce(string_agg(CASE WHEN t.token IN (SELECT token FROM dv) THEN t.token ELSE '{T.UNKNOWN}' END,
                                      '' ORDER BY t.pos), '') AS text
FROM benchmark b LEFT JOIN bt t ON t.item_id = b.item_id GROUP BY b.item_id"""

SQL["sql_tokens"] = f"""WITH {tok('w', 'documents', 'doc_id')}, {tok('s', 'documents', 'doc_id').replace(SPLIT, SPACED_SPLIT)}
SELECT d.doc_id, len(w_s.toks)::BIGINT AS n_words, len(s_s.toks)::BIGINT AS n_spaced, length(d.text)::BIGINT AS n_characters
FROM documents d JOIN w_s ON w_s.id = d.doc_id JOIN s_s ON s_s.id = d.doc_id"""

SQL["corpus_sketch"] = f"""WITH {tok('t', 'documents', 'doc_id')}
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
       (SELECT coalesce(sum(length(text)), 0) FROM documents)::BIGINT AS n_chars,
       (SELECT count(*) FROM t)::BIGINT AS n_tokens, true AS vocab_size_holds, true AS median_holds"""

SQL["unknown_tokens"] = f"""WITH {_EN}
SELECT token, count(*)::BIGINT AS n FROM bt WHERE token NOT IN (SELECT token FROM evs) GROUP BY token"""

SQL["decode_words"] = f"""WITH {_EN},
named AS (
  SELECT t.id, t.pos, coalesce(v.token, '{T.UNKNOWN}') AS token FROM bt t LEFT JOIN evs v ON v.token = t.token)
SELECT b.item_id,
       replace(regexp_replace(coalesce(string_agg(n.token, ' ' ORDER BY n.pos), ''), '{SPACE}+({GLUE})', '\\1', 'g'), chr(10), ' ') AS text
FROM benchmark b LEFT JOIN named n ON n.id = b.item_id GROUP BY b.item_id"""

L, S = C.WINDOW_LENGTH, C.WINDOW_STRIDE
SQL["token_windows"] = f"""WITH {encoded_docs()},
w AS (SELECT id, ids, unnest(generate_series(0, len(ids) - {L + 1}, {S})) AS start FROM enc WHERE len(ids) > {L})
SELECT id AS doc_id, (start // {S})::BIGINT AS win, start::BIGINT AS start,
       {ids_str(f'ids[start + 1 : start + {L}]')} AS input_ids,
       {ids_str(f'ids[start + 2 : start + {L + 1}]')} AS target_ids
FROM w"""

SQL["next_token"] = f"""WITH {tok('dt', 'documents', 'doc_id')}, {vocab('dv', 'dt')}
SELECT t.id AS doc_id, t.pos::BIGINT AS pos, v.token_id,
       lead(v.token_id) OVER (PARTITION BY t.id ORDER BY t.pos) AS next_id
FROM dt t JOIN dv v ON v.token = t.token"""

SQL["context_pairs"] = f"""WITH {encoded_docs()},
p AS (SELECT id, ids, unnest(generate_series(1, least({C.CONTEXT}, len(ids) - {C.SKIP + 1}))) AS i FROM enc)
SELECT id AS doc_id, i::BIGINT AS i, {ids_str(f'ids[{C.SKIP + 1} : {C.SKIP} + i]')} AS context_ids,
       ids[{C.SKIP + 1} + i] AS target
FROM p"""

SQL["pack_documents"] = f"""WITH {encoded_docs()},
seq AS (SELECT id, (id % {C.PACK_SHARDS})::BIGINT AS shard,
               list_append(ids, (SELECT count(*) FROM dv)::BIGINT) AS s FROM enc),
off AS (SELECT *, coalesce(sum(len(s)) OVER (PARTITION BY shard ORDER BY id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM seq),
flat AS (SELECT shard, o + unnest(generate_series(0, len(s) - 1)) AS g, unnest(s) AS token_id FROM off)
SELECT shard, (g // {C.PACK_LENGTH})::BIGINT AS block, string_agg(token_id::VARCHAR, ' ' ORDER BY g) AS ids
FROM flat GROUP BY shard, g // {C.PACK_LENGTH}"""

SQL["left_crop"] = f"""WITH {encoded_docs()}
SELECT id AS doc_id, {ids_str(f'ids[greatest(len(ids) - {C.CROP}, 0) + 1 : len(ids)]')} AS ids FROM enc"""

_LAB = f"""{encoded_docs()},
{shuffled('sh', '(SELECT l.doc_id FROM labels l JOIN documents d ON d.doc_id = l.doc_id)', 'doc_id')},
lab AS (SELECT sh.doc_id, {split_of()} AS split, e.ids FROM sh JOIN enc e ON e.id = sh.doc_id),
ml AS (SELECT coalesce(max(len(ids)), 0)::BIGINT AS m FROM lab WHERE split = 'train')"""

SQL["max_encoded_length"] = f"""WITH {_LAB} SELECT m AS max_len FROM ml"""

SQL["pad_truncate"] = f"""WITH {_LAB}
SELECT split, doc_id,
       {ids_str(f"list_concat(ids[1 : (SELECT m FROM ml)], list_transform(generate_series(1, greatest((SELECT m FROM ml) - len(ids), 0)), lambda x: {T.PAD_ID}::BIGINT))")} AS ids
FROM lab"""

_SL = min(C.SCORE_LENGTH, C.SCORE_CONTEXT)
SQL["prepare_for_scoring"] = f"""WITH {encoded_docs()}
SELECT id AS doc_id,
       {ids_str(f"list_concat(ids[1 : {_SL}], list_transform(generate_series(1, greatest({C.SCORE_LENGTH} - least(len(ids), {_SL}), 0)), lambda x: {T.PAD_ID}::BIGINT))")} AS ids
FROM enc"""

# ---------------------------------------------------------------- labels / sampling
SQL["filter_label"] = "SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1"
SQL["label_counts"] = "SELECT quality, count(*)::BIGINT AS n FROM labels GROUP BY quality"
SQL["label_name"] = "SELECT doc_id, CASE WHEN toxic = 1 THEN 'spam' ELSE 'not spam' END AS name FROM labels"
SQL["row_fetch"] = f"""SELECT row_id, doc_id, quality, toxic FROM (
  SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_id, * FROM labels) WHERE row_id = {C.ROW}"""

SQL["shuffled_rank"] = f"""WITH {shuffled('sh', 'orders', 'o_orderkey')}
SELECT o_orderkey, rk AS rank FROM sh"""

SQL["batches"] = f"""WITH {shuffled('sh', 'orders', 'o_orderkey')}
SELECT o_orderkey, (rk // {C.BATCH})::BIGINT AS batch_id FROM sh WHERE rk // {C.BATCH} < n // {C.BATCH}"""

SQL["three_way_split"] = f"""WITH {shuffled('sh', 'orders', 'o_orderkey')}
SELECT o_orderkey, {split_of()} AS split FROM sh"""

SQL["balanced_sample"] = f"""WITH r AS (
  SELECT doc_id, toxic,
         row_number() OVER (PARTITION BY toxic ORDER BY md5('{C.SEED}:' || doc_id::VARCHAR), doc_id) - 1 AS rk
  FROM labels),
m AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM labels GROUP BY toxic))
SELECT doc_id, toxic FROM r WHERE rk < (SELECT m FROM m)"""

SQL["char_split"] = """WITH k AS (SELECT doc_id, text, floor(length(text)::DOUBLE * 0.9::DOUBLE)::BIGINT AS k FROM documents)
SELECT doc_id, substring(text, 1, k) AS train_text, substring(text, k + 1) AS val_text FROM k"""

# ---------------------------------------------------------------- vectors / head / metrics
_EMB = f"""{shuffled('esh', 'embeddings', 'vec_id')},
e AS (SELECT m.vec_id, m.label, m.embedding::DOUBLE[] AS v, {split_of()} AS split
      FROM embeddings m JOIN esh s ON s.vec_id = m.vec_id),
cd AS (SELECT label, i, avg(v[i]) AS m
       FROM (SELECT label, v, unnest(generate_series(1, len(v))) AS i FROM e WHERE split = 'train')
       GROUP BY label, i),
cw AS (SELECT label::BIGINT AS class, list(m ORDER BY i) AS w FROM cd GROUP BY label),
cb AS (SELECT class, w, -0.5 * list_sum(list_transform(w, lambda x: x * x)) AS b FROM cw),
lg AS (SELECT e.vec_id, e.label, e.split, c.class, list_dot_product(e.v, c.w) + c.b AS logit FROM e, cb c),
pv AS (SELECT vec_id, max(label) AS label, max(split) AS split,
              first(class ORDER BY logit DESC, class) AS predicted,
              max(logit) AS mx FROM lg GROUP BY vec_id),
ls AS (SELECT l.vec_id, p.mx + ln(sum(exp(l.logit - p.mx))) AS lse FROM lg l JOIN pv p USING (vec_id)
       GROUP BY l.vec_id, p.mx),
pr AS (SELECT p.vec_id, p.label::BIGINT AS label, p.split, p.predicted,
              s.lse - (SELECT logit FROM lg WHERE lg.vec_id = p.vec_id AND lg.class = p.label) AS nll
       FROM pv p JOIN ls s USING (vec_id)),
bt AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY
                    CASE WHEN split = 'train' THEN md5('{C.SEED}:' || vec_id::VARCHAR) ELSE '' END, vec_id) - 1)
                 // {C.BATCH} AS batch_id,
              count(*) OVER (PARTITION BY split) AS n_split FROM pr),
kb AS (SELECT * FROM bt WHERE split <> 'train' OR batch_id < n_split // {C.BATCH})"""

SQL["centroid_logits"] = f"""WITH {_EMB}
SELECT vec_id, class, round(logit, 6) AS value FROM lg"""

SQL["softmax"] = f"""WITH {_EMB}
SELECT l.vec_id, l.class, round(exp(l.logit - s.lse), 6) AS value FROM lg l JOIN ls s USING (vec_id)"""

SQL["argmax_class"] = f"""WITH {_EMB}
SELECT vec_id, predicted FROM pv"""

SQL["top_k_logits"] = f"""WITH {_EMB},
kth AS (SELECT vec_id, list_sort(list(logit), 'DESC')[{C.TOP_K}] AS t FROM lg GROUP BY vec_id)
SELECT l.vec_id, l.class,
       CASE WHEN l.logit >= k.t THEN round(l.logit, 6) ELSE '-inf'::DOUBLE END AS value
FROM lg l JOIN kth k USING (vec_id)"""

_ACC = "SELECT split, count(*)::BIGINT AS n, avg(CASE WHEN predicted = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM kb GROUP BY split"
_LOSS = """SELECT split, count(*)::BIGINT AS n_batches, avg(b) AS loss
FROM (SELECT split, batch_id, avg(nll) AS b FROM kb GROUP BY split, batch_id) GROUP BY split"""

SQL["accuracy"] = f"""WITH {_EMB}, a AS ({_ACC}) SELECT split, n, round(accuracy, 6) AS accuracy FROM a"""
SQL["cross_entropy"] = f"""WITH {_EMB}, l AS ({_LOSS}) SELECT split, n_batches, round(loss, 6) AS loss FROM l"""
SQL["split_report"] = f"""WITH {_EMB}, a AS ({_ACC}), l AS ({_LOSS})
SELECT a.split, a.n, round(a.accuracy, 6) AS accuracy, round(l.loss, 6) AS loss FROM a JOIN l USING (split)"""

SQL["examples_seen"] = f"""WITH {_EMB},
per AS (SELECT batch_id::BIGINT AS batch_id, count(*)::BIGINT AS n FROM kb WHERE split = 'train' GROUP BY batch_id)
SELECT batch_id, n, sum(n) OVER (ORDER BY batch_id)::BIGINT AS examples_seen FROM per"""

SQL["eval_steps"] = f"""WITH {_EMB},
per AS (SELECT batch_id::BIGINT AS batch_id FROM kb WHERE split = 'train' GROUP BY batch_id),
nb AS (SELECT count(*) AS nb FROM per),
st AS (SELECT ep AS epoch, ep * (SELECT nb FROM nb) + batch_id AS step FROM per, range(0, {C.EPOCHS}) r(ep))
SELECT epoch::BIGINT AS epoch, step::BIGINT AS step, ((step + 1) * {C.BATCH})::BIGINT AS examples_seen
FROM st WHERE step % {C.EVAL_FREQ} = 0"""



def mixed(place: str, key: str, src: str, cols: str, a: str = "a", b: str = "b") -> str:
    """The epoch permutation of ``place`` as ``place`` over ``src``, keeping ``cols``."""
    def h(i, digit):
        return f"('0x' || substr(md5({key} || ':{i}:' || ({digit})::VARCHAR), 1, 8))::BIGINT"
    sql = f"SELECT {cols}, ({place}) // {b} AS hi, ({place}) % {b} AS lo FROM {src}"
    for i in (1, 2, 3, 4):
        hi, lo = (f"(hi + {h(i, 'lo')}) % {a}", "lo") if i % 2 else ("hi", f"(lo + {h(i, 'hi')}) % {b}")
        sql = f"SELECT {cols}, {hi} AS hi, {lo} AS lo FROM ({sql})"
    return f"SELECT {cols}, hi * {b} + lo AS place FROM ({sql})"


def epoch_places(name: str, rows: str, id_col: str, n: str, epochs: str) -> str:
    """CTEs ending in ``{name}`` = (id, epoch, place): the permutation of each
    epoch, walked on until a place is below n."""
    key = f"'{C.SEED}:' || epoch"
    cols = "id, epoch, a, b, n"
    walk = mixed("place", key, "{src}", cols)
    return f"""{name}_b AS (SELECT n, a, ceil(greatest(n, 1) / a)::BIGINT AS b FROM (
  SELECT n, ceil(sqrt(greatest(n, 1)))::BIGINT AS a FROM (SELECT ({n})::BIGINT AS n))),
{name}_w AS (
  {walk.format(src=f"(SELECT {id_col} AS id, r::BIGINT AS place, epoch, a, b, n FROM {rows}, {name}_b, range({epochs}) t(epoch))")}
  UNION ALL
  {walk.format(src=f"(SELECT * FROM {name}_w WHERE place >= n)")}),
{name} AS (SELECT id, epoch, place FROM {name}_w WHERE place < n)"""


_TRAIN = f"""WITH RECURSIVE {shuffled('esh', 'embeddings', 'vec_id')},
e AS (SELECT m.vec_id, m.label::BIGINT AS label, list_append(m.embedding::DOUBLE[], 1.0::DOUBLE) AS x, {split_of()} AS split
      FROM embeddings m JOIN esh s ON s.vec_id = m.vec_id),
tr AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM e WHERE split = 'train'),
sz AS (SELECT n, bs, n // bs AS per FROM (SELECT count(*) AS n, greatest(1, count(*) // {C.STEPS_PER_EPOCH}) AS bs FROM tr)),
{epoch_places('pl', 'tr', 'vec_id', 'SELECT count(*) FROM tr', str(C.EPOCHS))},
ob AS MATERIALIZED (SELECT p.epoch, p.place // bs AS batch, p.epoch * per + p.place // bs AS step, t.vec_id, t.label, t.x
       FROM pl p JOIN tr t ON t.vec_id = p.id, sz WHERE p.place // bs < per),
xs AS MATERIALIZED (SELECT step, vec_id, label, unnest(range(1, len(x) + 1)) AS j, unnest(x) AS val FROM ob),
st AS (
  SELECT 0 AS t, class, j, 0.0::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v
  FROM (SELECT DISTINCT label AS class FROM tr), (SELECT DISTINCT j FROM xs)
  UNION ALL
  SELECT t + 1, class, j, w * (1 - 0.05 * 0.1) - 0.05 * (m / (1 - 0.9 ** (t + 1))) / (sqrt(v / (1 - 0.999 ** (t + 1))) + 1e-8), m, v
  FROM (SELECT s.t, s.class, s.j, s.w, 0.9 * s.m + (1 - 0.9) * g.g AS m, 0.999 * s.v + (1 - 0.999) * g.g * g.g AS v
    FROM st s JOIN (
      SELECT p.class, x.j, sum((p.p - CASE WHEN p.class = p.label THEN 1.0 ELSE 0.0 END) * x.val) / any_value(sz.bs) AS g
      FROM (SELECT step, vec_id, label, class, exp(l - mx) / sum(exp(l - mx)) OVER (PARTITION BY vec_id) AS p FROM (
          SELECT *, max(l) OVER (PARTITION BY vec_id) AS mx FROM (
            SELECT x.step, x.vec_id, x.label, s.class, sum(x.val * s.w) AS l
            FROM st s JOIN xs x ON x.step = s.t AND x.j = s.j GROUP BY ALL))) p
      JOIN xs x ON x.step = p.step AND x.vec_id = p.vec_id, sz GROUP BY p.class, x.j) g
    ON g.class = s.class AND g.j = s.j)),
ev AS (SELECT 'step' AS event, k // per AS epoch, k AS step FROM sz, range({C.EPOCHS} * per) t(k) WHERE k % {C.EVAL_FREQ} = 0
       UNION ALL SELECT 'epoch', e, (e + 1) * per - 1 FROM sz, range({C.EPOCHS}) t(e)),
vb AS (SELECT vec_id, label, x, (row_number() OVER (ORDER BY vec_id) - 1) // bs AS batch FROM e, sz WHERE split = 'validation'),
rw AS (SELECT ev.*, 'train' AS side, batch, vec_id, label, x FROM ev JOIN ob USING (epoch) WHERE batch < {C.EVAL_BATCHES}
       UNION ALL SELECT ev.*, 'validation', batch, vec_id, label, x FROM ev, vb WHERE batch < {C.EVAL_BATCHES}),
hw AS (SELECT t - 1 AS step, class, list(w ORDER BY j) AS w FROM st GROUP BY ALL),
lo AS (SELECT r.event, r.epoch, r.step, r.side, r.batch, r.vec_id, r.label, h.class, list_dot_product(r.x, h.w) AS l
       FROM rw r JOIN hw h USING (step)),
on_ AS (SELECT event, epoch, step, side, batch, vec_id, label, first(class ORDER BY l DESC, class) AS top, max(l) AS mx,
       list(l) AS ls, max(l) FILTER (class = label) AS own FROM lo GROUP BY ALL),
bm AS (SELECT event, epoch, step, side, batch, count(*) AS n, count(*) FILTER (top = label) AS ok,
       avg(mx + ln(list_sum(list_transform(ls, lambda z: exp(z - mx)))) - own) AS loss FROM on_ GROUP BY ALL),
ms AS (SELECT event, epoch, step, side, avg(loss) AS loss, sum(ok) / sum(n) AS acc FROM bm GROUP BY ALL)"""


def _side(event: str, col: str, side: str, empty: str) -> str:
    return f"""CASE WHEN event = '{event}' THEN coalesce((SELECT round({col}, 6) FROM ms
  WHERE (ms.event, ms.step, ms.side) = (ev.event, ev.step, '{side}')), {empty}) END AS {side}_{'loss' if col == 'loss' else 'accuracy'}"""


SQL["row_ids"] = """SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_id, doc_id FROM labels"""

SQL["epoch_batches"] = f"""WITH RECURSIVE o AS (
  SELECT o_orderkey, row_number() OVER () - 1 AS r FROM orders),
{epoch_places('pl', 'o', 'o_orderkey', 'SELECT count(*) FROM orders', str(C.EPOCHS))},
c AS (SELECT count(*) // {C.BATCH} AS per FROM orders)
SELECT id AS o_orderkey, epoch, place, place // {C.BATCH} AS batch_id, epoch * per + place // {C.BATCH} AS step
FROM pl, c WHERE place // {C.BATCH} < per"""

SQL["training_trace"] = f"""{_TRAIN}
SELECT event, epoch::BIGINT AS epoch, step::BIGINT AS step, ((step + 1) * bs)::BIGINT AS examples_seen,
  {_side('step', 'loss', 'train', "'nan'::DOUBLE")}, {_side('step', 'loss', 'validation', "'nan'::DOUBLE")},
  {_side('epoch', 'acc', 'train', 'NULL')}, {_side('epoch', 'acc', 'validation', 'NULL')}
FROM ev, sz"""

SQL["train_head_weights"] = f"""{_TRAIN}
SELECT class, (j - 1)::BIGINT AS dim, round(w, 6) AS value FROM st WHERE t = (SELECT max(t) FROM st)"""

SQL["standardize_vectors"] = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT vec_id, v, list_avg(v) AS mu FROM v),
s2 AS (SELECT vec_id, v, mu, list_avg(list_transform(v, lambda x: (x - mu) * (x - mu))) AS var FROM s),
d AS (SELECT vec_id, mu, var, unnest(generate_series(0, len(v) - 1)) AS dim, unnest(v) AS x FROM s2)
SELECT vec_id, dim::BIGINT AS dim, round((x - mu) / sqrt(var + 1e-5) * 1.0 + 0.0, 6) AS value FROM d"""

_RK = """r AS (SELECT label, vec_id, embedding::DOUBLE[] AS v,
              row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS r FROM embeddings)"""

SQL["scaled_dot"] = f"""WITH {_RK}
SELECT a.vec_id, b.vec_id AS next_vec_id, round(list_dot_product(a.v, b.v) / sqrt(len(a.v)), 6) AS value
FROM r a JOIN r b ON a.label = b.label AND b.r = a.r + 1"""


def _soft(window: int, heads: int) -> str:
    return f"""WITH {_RK},
hw AS (SELECT (SELECT max(len(v)) FROM r) // {heads} AS w),
p AS (SELECT a.vec_id, h, b.v[h * (SELECT w FROM hw) + 1 : (h + 1) * (SELECT w FROM hw)] AS kv,
             list_dot_product(a.v[h * (SELECT w FROM hw) + 1 : (h + 1) * (SELECT w FROM hw)],
                              b.v[h * (SELECT w FROM hw) + 1 : (h + 1) * (SELECT w FROM hw)])
               / sqrt((SELECT w FROM hw)) AS s
      FROM r a JOIN r b ON a.label = b.label AND b.r <= a.r AND b.r > a.r - {window}, range(0, {heads}) t(h)),
e AS (SELECT vec_id, h, kv, exp(s - max(s) OVER (PARTITION BY vec_id, h)) AS e FROM p),
w AS (SELECT vec_id, h, kv, e / sum(e) OVER (PARTITION BY vec_id, h) AS w FROM e),
d AS (SELECT vec_id, h, w, unnest(generate_series(0, len(kv) - 1)) AS i, unnest(kv) AS x FROM w)
SELECT vec_id, (h * (SELECT w FROM hw) + i)::BIGINT AS dim, round(sum(w * x), 6) AS value
FROM d GROUP BY vec_id, h, i"""


SQL["soft_history"] = _soft(16, 1)
SQL["soft_history_heads"] = _soft(16, 4)
SQL["soft_context"] = _soft(1024, 4)

SQL["embed_tokens"] = f"""WITH {tok('dt', 'documents', 'doc_id')}, {vocab('dv', 'dt')},
tk AS (SELECT t.id, t.pos, v.token_id FROM dt t JOIN dv v ON v.token = t.token),
nv AS (SELECT count(*) AS n FROM embeddings),
u AS (SELECT id, token_id % (SELECT n FROM nv) AS vid FROM tk
      UNION ALL SELECT id, pos % (SELECT n FROM nv) FROM tk),
c AS (SELECT id, vid, count(*) AS c FROM u GROUP BY id, vid),
x AS (SELECT c.id, c.c, m.embedding::DOUBLE[] AS v FROM c JOIN embeddings m ON m.vec_id = c.vid),
d AS (SELECT id, c, unnest(generate_series(0, len(v) - 1)) AS dim, unnest(v) AS x FROM x)
SELECT id AS doc_id, dim::BIGINT AS dim, round(sum(c * x) * (2.0 / sum(c)), 6) AS value FROM d GROUP BY id, dim"""

SQL["conversation_until_exit"] = f"""WITH st AS (
  SELECT conv_id, min(turn) AS stop FROM conversations
  WHERE lower(text) IN ({", ".join("'" + w + "'" for w in C.EXIT_WORDS)}) AND role = 'user' GROUP BY conv_id)
SELECT c.conv_id, c.turn, c.text FROM conversations c LEFT JOIN st USING (conv_id)
WHERE st.stop IS NULL OR c.turn < st.stop"""

# ---------------------------------------------------------------- naive Bayes
_NB = f"""ld AS (SELECT d.doc_id, d.text, l.toxic AS class FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
{tok('lt', 'ld', 'doc_id')},
tc AS (SELECT d.class, t.token, count(*) AS n FROM lt t JOIN ld d ON d.doc_id = t.id GROUP BY d.class, t.token),
nc AS (SELECT class, sum(n) AS nn FROM tc GROUP BY class),
nv AS (SELECT count(DISTINCT token) AS v FROM tc),
cls AS (SELECT class, count(*) AS nd FROM ld GROUP BY class)"""

SQL["nb_train"] = f"""WITH {_NB}
SELECT tc.class::BIGINT AS class, tc.token, round(ln((tc.n + 1) / (nc.nn + (SELECT v FROM nv))), 6) AS log_p
FROM tc JOIN nc ON nc.class = tc.class"""



def _nb_scores(src: str, id_col: str) -> str:
    """CTEs: ``best`` (id, predicted) of the texts of ``src``."""
    return f"""{_NB},
{tok('allt', src, id_col)},
ac AS (SELECT id, token, count(*) AS c FROM allt WHERE token IN (SELECT token FROM tc) GROUP BY id, token),
lp AS (SELECT cls.class, v.token,
              ln((coalesce(tc.n, 0) + 1) / (coalesce(nc.nn, 0) + (SELECT v FROM nv))) AS lp
       FROM cls CROSS JOIN (SELECT DISTINCT token FROM tc) v
       LEFT JOIN tc ON tc.class = cls.class AND tc.token = v.token LEFT JOIN nc ON nc.class = cls.class),
sc AS (SELECT d.{id_col} AS id, cls.class,
              ln(cls.nd / (SELECT sum(nd) FROM cls)) + coalesce(sum(ac.c * lp.lp), 0) AS s
       FROM {src} d CROSS JOIN cls LEFT JOIN ac ON ac.id = d.{id_col}
       LEFT JOIN lp ON lp.class = cls.class AND lp.token = ac.token
       GROUP BY d.{id_col}, cls.class, cls.nd),
best AS (SELECT id, first(class ORDER BY s DESC, class)::BIGINT AS predicted FROM sc GROUP BY id)"""


SQL["nb_classify"] = f"""WITH {_nb_scores('documents', 'doc_id')}
SELECT id AS doc_id, predicted FROM best"""
SQL["model_roundtrip"] = SQL["nb_classify"]
# the same with another tokenizer: white space alone splits
SQL["nb_pipeline_spaced"] = SQL["nb_classify"].replace(SPLIT, SPACED_SPLIT)

SQL["stream_score"] = f"""WITH kept AS ({SQL["conversation_until_exit"].replace("SELECT c.conv_id", "SELECT c.role, c.conv_id")}),
msgs AS (SELECT conv_id, turn, text, conv_id::VARCHAR || ':' || turn::VARCHAR AS mid FROM kept WHERE role = 'user'),
{_nb_scores('msgs', 'mid')}
SELECT conv_id, turn, text, predicted, CASE WHEN predicted = 1 THEN 'spam' ELSE 'not spam' END AS verdict
FROM msgs JOIN best ON best.id = msgs.mid"""

# ---------------------------------------------------------------- bigram LM and generation
_LM = f"""k AS (SELECT doc_id, text, floor(length(text)::DOUBLE * 0.9::DOUBLE)::BIGINT AS k FROM documents),
sp AS (SELECT doc_id, substring(text, 1, k) AS tr, substring(text, k + 1) AS va FROM k),
{tok('trt', 'sp', 'doc_id', 'tr')},
{tok('vat', 'sp', 'doc_id', 'va')},
cnt AS MATERIALIZED (SELECT a.token AS context, b.token AS next, count(*) AS n
        FROM trt a JOIN trt b ON a.id = b.id AND b.pos = a.pos + 1 GROUP BY a.token, b.token)"""

SQL["ngram_counts"] = f"""WITH {_LM} SELECT context, next, n::BIGINT AS n FROM cnt"""

_LOSS_DOC = f"""{_LM},
vs AS (SELECT count(DISTINCT token) + 1 AS v FROM trt),
ctx AS (SELECT context, sum(n) AS nc FROM cnt GROUP BY context),
vp AS (SELECT a.id, a.token AS context, b.token AS next FROM vat a JOIN vat b ON a.id = b.id AND b.pos = a.pos + 1),
nl AS (SELECT vp.id, -ln((coalesce(c.n, 0) + 1) / (coalesce(x.nc, 0) + (SELECT v FROM vs))) AS nll
       FROM vp LEFT JOIN cnt c ON c.context = vp.context AND c.next = vp.next LEFT JOIN ctx x ON x.context = vp.context),
pd AS (SELECT id, count(*) AS n_targets, avg(nll) AS loss FROM nl GROUP BY id)"""

SQL["doc_perplexity"] = f"""WITH {_LOSS_DOC}
SELECT id AS doc_id, n_targets::BIGINT AS n_targets, round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity FROM pd"""

SQL["lm_loss"] = f"""WITH {_LOSS_DOC}
SELECT count(*)::BIGINT AS n_docs, sum(n_targets)::BIGINT AS n_targets, round(avg(loss), 6) AS loss,
       round(exp(avg(loss)), 6) AS perplexity FROM pd"""


def _kneser_ney(order: int, d: float = 0.75) -> str:
    lags = ", ".join(f"coalesce(lag(token, {j}) OVER (PARTITION BY id ORDER BY pos), '')" for j in range(order - 1, 0, -1))

    def grams(src):
        return f"SELECT id, pos, c, w FROM (SELECT id, pos, token AS w, [{lags}]::VARCHAR[] AS c FROM {src}) WHERE pos >= 1"
    ctes = ["vs AS (SELECT count(DISTINCT token) + 1 AS v FROM trt)", f"hg AS MATERIALIZED ({grams('vat')})",
            f"c{order} AS MATERIALIZED (SELECT c, w, count(*) AS n FROM ({grams('trt')}) GROUP BY c, w)"]
    ctes += [f"c{k} AS MATERIALIZED (SELECT c[2:] AS c, w, count(*) AS n FROM c{k + 1} GROUP BY ALL)" for k in range(order - 1, 0, -1)]
    for k in range(1, order + 1):
        ctes.append(f"t{k} AS MATERIALIZED (SELECT c, sum(n) AS total, {d} * count(*) / sum(n) AS b FROM c{k} GROUP BY c)")
        below = "(SELECT 1.0 / v FROM vs)" if k == 1 else "q.p"
        join = "" if k == 1 else f"JOIN p{k - 1} q ON q.c = a.c[2:] AND q.w = a.w"
        ctes.append(f"p{k} AS MATERIALIZED (SELECT a.c, a.w, greatest(a.n - {d}, 0) / t.total + t.b * {below} AS p "
                    f"FROM c{k} a JOIN t{k} t ON t.c = a.c {join})")
    value, joins = "(SELECT 1.0 / v FROM vs)", ""
    for k in range(1, order + 1):
        value = f"coalesce(p{k}.p, coalesce(t{k}.b, 1.0) * {value})"
        tail = f"h.c[{order - k + 1}:]"
        joins += f" LEFT JOIN p{k} ON p{k}.c = {tail} AND p{k}.w = h.w LEFT JOIN t{k} ON t{k}.c = {tail}"
    return f"""WITH {_LM}, {", ".join(ctes)},
pd AS (SELECT id, count(*) AS n_targets, avg(-ln({value})) AS loss FROM hg h{joins} GROUP BY id)
SELECT count(*)::BIGINT AS n_docs, sum(n_targets)::BIGINT AS n_targets, round(avg(loss), 6) AS loss,
       round(exp(avg(loss)), 6) AS perplexity FROM pd"""


SQL["lm_loss_order3"] = _kneser_ney(3)
SQL["lm_loss_order5"] = _kneser_ney(5)

_GEN = f"""{_LM},
{tok('bt', 'benchmark', 'item_id')},
fb AS MATERIALIZED (SELECT min(token) AS t FROM trt),
best AS MATERIALIZED (SELECT context, first(next ORDER BY n DESC, next) AS best FROM cnt GROUP BY context)"""


def _decode_sql(expr: str) -> str:
    return f"regexp_replace(array_to_string({expr}, ' '), '{SPACE}+({GLUE})', '\\1', 'g')"


def _greedy(steps: int) -> str:
    ctes = ["g0 AS (SELECT b.item_id, s.toks[len(s.toks)] AS c, []::VARCHAR[] AS gen "
            "FROM benchmark b LEFT JOIN bt_s s ON s.id = b.item_id)"]
    for i in range(1, steps + 1):
        ctes.append(f"""g{i} AS MATERIALIZED (SELECT g.item_id, coalesce(b.best, (SELECT t FROM fb)) AS c,
       list_append(g.gen, coalesce(b.best, (SELECT t FROM fb))) AS gen
FROM g{i - 1} g LEFT JOIN best b ON b.context = g.c)""")
    return f"""WITH {_GEN}, {", ".join(ctes)}
SELECT item_id, {_decode_sql('gen')} AS text FROM g{steps}"""


SQL["generate_greedy"] = _greedy(5)
SQL["generate_t0"] = SQL["generate_greedy"]  # <|endoftext|> never occurs in the corpus

_LEVELS = """hist AS (SELECT context, n, count(*) AS m FROM cnt GROUP BY context, n),
h2 AS (SELECT *, sum(m) OVER (PARTITION BY context ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS al
       FROM hist),
thr AS (SELECT context, coalesce(max(CASE WHEN al >= {k} THEN n END), min(n)) AS t FROM h2 GROUP BY context),
lv AS (SELECT h.context, h.n, h.m, exp(ln(h.n::DOUBLE) / {temp}) AS w FROM hist h JOIN thr ON thr.context = h.context
       WHERE h.n >= thr.t),
lv2 AS (SELECT *, sum(m * w) OVER (PARTITION BY context ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e
        FROM lv),
lvl AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY context ORDER BY n DESC), 0) AS bf,
               max(e) OVER (PARTITION BY context) AS tot FROM lv2),
rk AS (SELECT context, n, next, row_number() OVER (PARTITION BY context, n ORDER BY next) - 1 AS j FROM cnt)"""


def _sampled(steps: int, k: int, temp: float, stop: str, out: str) -> str:
    ctes = ["s0 AS (SELECT b.item_id, s.toks[len(s.toks)] AS c, []::VARCHAR[] AS gen, false AS done "
            "FROM benchmark b LEFT JOIN bt_s s ON s.id = b.item_id)"]
    for i in range(1, steps + 1):
        st = i - 1
        ctes.append(f"""u{i} AS (SELECT *, ('0x' || substr(md5('{C.SEED}:' || item_id::VARCHAR || ':{st}'), 1, 13))::BIGINT
                        / 4503599627370496.0 AS u FROM s{st}),
ch{i} AS (SELECT x.item_id, first(l.n ORDER BY l.bf) AS n, first(l.context ORDER BY l.bf) AS context,
                 first(least(greatest(ceil((x.u * l.tot - l.bf) / l.w) - 1, 0), l.m - 1) ORDER BY l.bf)::BIGINT AS j
          FROM u{i} x JOIN lvl l ON l.context = x.c WHERE l.e >= x.u * l.tot GROUP BY x.item_id),
d{i} AS (SELECT x.item_id, x.c, x.gen, x.done, coalesce(r.next, (SELECT t FROM fb)) AS drawn
         FROM u{i} x LEFT JOIN ch{i} h ON h.item_id = x.item_id
         LEFT JOIN rk r ON r.context = h.context AND r.n = h.n AND r.j = h.j),
s{i} AS (SELECT item_id,
                CASE WHEN done OR drawn = '{stop}' THEN c ELSE drawn END AS c,
                CASE WHEN done OR drawn = '{stop}' THEN gen ELSE list_append(gen, drawn) END AS gen,
                done OR drawn = '{stop}' AS done FROM d{i})""")
    sel = f"{_decode_sql('gen')} AS text" if out == "text" else "gen[1] AS next_token"
    return f"""WITH {_GEN}, {_LEVELS.format(k=k, temp=temp)}, {", ".join(ctes)}
SELECT item_id, {sel} FROM s{steps}"""


SQL["sample_next"] = _sampled(1, 25, 1.4, T.END_OF_TEXT, "next")
SQL["generate_sampled"] = _sampled(5, 25, 1.4, T.END_OF_TEXT, "text")

# ---------------------------------------------------------------- sources / sinks (round trips)
SQL["src_labelled_csv"] = """SELECT l.toxic::BIGINT AS label, d.text AS text
FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""

SQL["src_text"] = "SELECT doc_id, text FROM documents"

SQL["src_label_tsv"] = """SELECT CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label, l.toxic::BIGINT AS label_id,
       regexp_replace(d.text, '[\\t\\n\\r]', ' ', 'g') AS text
FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""

SQL["sink_splits"] = f"""WITH {shuffled('sh', '(SELECT l.doc_id, l.toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id)', 'doc_id', ', toxic')}
SELECT {split_of()} AS split, count(*)::BIGINT AS n, sum(toxic)::BIGINT AS n_positive FROM sh GROUP BY 1"""

SQL["sink_csv_splits"] = f"""WITH {shuffled('sh', '(SELECT l.doc_id, l.toxic, d.text FROM labels l JOIN documents d ON d.doc_id = l.doc_id)', 'doc_id', ', toxic, text')}
SELECT {split_of()} AS split, toxic::BIGINT AS label, text FROM sh"""

# ---------------------------------------------------------------- streaming (same answer as the batch form)
SQL["message_log"] = "SELECT conv_id, turn, role, text FROM conversations"
SQL["stream_until_exit"] = SQL["conversation_until_exit"]

# ---------------------------------------------------------------- byte pairs: the round trip is lossless
SQL["bpe_decode"] = "SELECT doc_id, text FROM documents"


SQL["corpus_preview"] = f"""WITH {tok('t', 'documents', 'doc_id')}
SELECT d.doc_id, substring(d.text, 1, 99) AS head_text, array_to_string(s.toks[1:30], ' ') AS head_tokens
FROM documents d JOIN t_s s ON s.id = d.doc_id"""

SQL["eval_first_batches"] = f"""WITH {_EMB},
a AS (SELECT split, avg(CASE WHEN predicted = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM kb
      WHERE batch_id < 10 GROUP BY split),
l AS (SELECT split, avg(b) AS loss FROM (SELECT split, batch_id, avg(nll) AS b FROM kb WHERE batch_id < 5
      GROUP BY split, batch_id) GROUP BY split)
SELECT a.split, round(a.accuracy, 6) AS accuracy, round(l.loss, 6) AS loss FROM a JOIN l USING (split)"""

def _positive_zero(sql: str) -> str:
    """DuckDB's round keeps the sign of a tiny negative (-0.0) where Spark's
    decimal rounding gives 0.0: add 0.0 after every round(...)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while True:
            c = sql[k]
            depth += c == "("
            depth -= c == ")"
            k += 1
            if depth == 0:
                break
        out.append(sql[i:j] + "(round" + _positive_zero(sql[j + 5:k]) + " + 0.0)")
        i = k


SQL.update({k: _positive_zero(v) for k, v in SQL.items()})
