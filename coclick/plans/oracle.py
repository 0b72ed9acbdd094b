"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code: each string is plain SQL over the
test tables, stating the operator's definition directly (windows, self-joins,
group-bys).  Doubles are rounded to 6 places and integer aggregates cast to
BIGINT on both sides.
"""

from __future__ import annotations

import re

from coclick.plans import params as P

# ---------------------------------------------------------------- inputs ---
CP = """cp AS (
  SELECT o.o_custkey AS u, l.l_partkey AS item, o.o_orderdate AS ts, l.l_orderkey AS sess,
         CAST(l.l_linenumber AS BIGINT) AS line
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

STRICT_K = ("CASE WHEN regexp_matches(json_extract_string(props, '$.k'), '^[0-9]+$') "
            "THEN COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) ELSE 0 END")

EV = f"""ev AS (
  SELECT user_id AS u, {STRICT_K} AS item, ts, event_id AS eid, CAST(ts AS DATE) AS day
  FROM events WHERE event_type = 'click' AND user_id > 0),
ev_ok AS (SELECT * FROM ev WHERE item <> 0)"""

WL = f"""wl AS (SELECT DISTINCT p_partkey AS item FROM part WHERE p_size <= {P.WHITELIST_MAX_SIZE})"""


def cf_daily(src: str, keys: str, name: str = "daily", cap: int = 100000, window: int = 10000) -> str:
    """CTEs for CF1 over relation ``src(u, item, ts[, day])`` grouped by ``keys``."""
    dk = keys.replace("u", "").strip(", ")
    dsel = f"{dk}, " if dk else ""
    return f"""{name}_c AS (SELECT {keys}, item, ts, 1.0::DOUBLE AS w FROM {src} WHERE item IS NOT NULL),
{name}_cap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY w DESC, item, ts) AS r
               FROM {name}_c) WHERE r <= {cap}),
{name}_sz AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS n FROM {name}_cap),
{name}_rk AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts, item) AS pos FROM {name}_sz WHERE n >= 2),
{name} AS (
  SELECT {dsel}vi, vj, sum(w) AS weight FROM (
    SELECT {''.join(f'a.{k.strip()}, ' for k in dk.split(',') if k.strip())}least(a.item, b.item) AS vi, greatest(a.item, b.item) AS vj, a.w * b.w AS w
    FROM {name}_rk a JOIN {name}_rk b ON {' AND '.join(f'a.{k.strip()} = b.{k.strip()}' for k in keys.split(','))}
         AND b.pos BETWEEN a.pos AND a.pos + {window}
    WHERE (a.item = b.item) = (a.pos = b.pos))
  GROUP BY ALL)"""


def cf_merged(daily: str, name: str = "merged", min_weight: float = 3, day_filter: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT vi AS va, vj AS vb, sum(weight) AS weight FROM {daily}
  WHERE {day_filter} AND vi IN (SELECT item FROM wl) AND vj IN (SELECT item FROM wl)
  GROUP BY vi, vj HAVING sum(weight) >= {min_weight})"""


# cosine = co-count over the geometric mean of the two diagonal counts
CF_SCORES = """diagonal AS (SELECT map_from_entries(list((va, weight))) AS own FROM merged WHERE va = vb),
scores AS (
  SELECT m.va, m.vb, m.weight, d.own[m.va] AS weight_a, d.own[m.vb] AS weight_b,
         m.weight / sqrt(d.own[m.va] * d.own[m.vb]) AS score
  FROM merged m, diagonal d
  WHERE m.va < m.vb AND map_contains(d.own, m.va) AND map_contains(d.own, m.vb))"""

CF_LISTS = """sym AS (
  SELECT va AS item, vb AS nbr, score, weight, weight_a, weight_b FROM scores
  UNION ALL
  SELECT vb AS item, va AS nbr, score, weight, weight_b AS weight_a, weight_a AS weight_b FROM scores),
rk AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY round(score, 9) DESC, nbr) AS rank FROM sym),
lists AS (SELECT item, CAST(rank AS BIGINT) AS rank, nbr, least(score, 1.0) AS score, weight, weight_a, weight_b
          FROM rk WHERE rank <= 200 AND (rank <= 50 OR least(score, 1.0) > 0.001)),
lists_short AS (SELECT item, CAST(rank AS BIGINT) AS rank, nbr, least(score, 0.3) AS score
          FROM rk WHERE rank <= 10 AND (rank <= 5 OR least(score, 0.3) > 0.2))"""

CP_CHAIN = ",\n".join([CP, WL, cf_daily("cp", "u"), cf_merged("daily")])


SWING = f"""ui AS (SELECT DISTINCT u, item FROM cp WHERE item IS NOT NULL),
uw AS (SELECT u, 1.0 / sqrt(count(*)) AS weight FROM ui GROUP BY u),
isz AS (SELECT item FROM ui GROUP BY item HAVING count(*) BETWEEN 2 AND 1000),
u2u AS (SELECT a.u AS ui, b.u AS uj, CAST(count(*) AS BIGINT) AS weight
        FROM ui a JOIN ui b ON a.item = b.item AND a.u < b.u
        WHERE a.item IN (SELECT item FROM isz) GROUP BY 1, 2),
i2iu AS (SELECT a.item AS itemi, b.item AS itemj, a.u AS u FROM ui a JOIN ui b ON a.u = b.u AND a.item < b.item),
paths AS (SELECT a.itemi, a.itemj, a.u AS ui, b.u AS uj
          FROM i2iu a JOIN i2iu b ON a.itemi = b.itemi AND a.itemj = b.itemj AND a.u < b.u),
-- Swing of an item pair: over user pairs that share both items, 1 / sqrt(|I_u| |I_v|) / (1 + shared items)
basket AS (SELECT u, count(*) AS n, list(item) FILTER (WHERE item IN (SELECT item FROM isz)) AS shared FROM ui GROUP BY u),
buyers AS (SELECT itemi, itemj, list(u) AS users FROM i2iu
           WHERE itemi IN (SELECT item FROM wl) AND itemj IN (SELECT item FROM wl)
           GROUP BY itemi, itemj HAVING count(*) > 1),
pairing AS (SELECT itemi, itemj, x.u AS u, unnest(list_filter(users, lambda y: y > x.u)) AS v
            FROM buyers, unnest(users) AS x(u)),
overlap AS (SELECT p.u, p.v, len(list_intersect(x.shared, y.shared)) AS together,
                   (1.0 / sqrt(x.n)) * (1.0 / sqrt(y.n)) AS closeness
            FROM (SELECT DISTINCT u, v FROM pairing) p JOIN basket x ON x.u = p.u JOIN basket y ON y.u = p.v),
half AS (SELECT itemi, itemj, sum(closeness / (1 + together)) AS s
         FROM pairing p JOIN overlap o ON o.u = p.u AND o.v = p.v WHERE together > 0 GROUP BY itemi, itemj),
swing AS (SELECT unnest([itemi, itemj]) AS itemi, unnest([itemj, itemi]) AS itemj, s AS swing_score FROM half),
swing_top AS (SELECT * FROM (SELECT itemi, CAST(row_number() OVER (PARTITION BY itemi ORDER BY round(swing_score, 9) DESC, itemj) AS BIGINT) AS rank,
              itemj, swing_score FROM swing) WHERE rank <= 200)"""

SWING_DAILY = """evl AS (SELECT CAST(ts AS DATE) AS day, user_id AS u, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item
        FROM events WHERE event_type = 'click' AND user_id > 0),
dui AS (SELECT DISTINCT day, u, item FROM evl WHERE item IS NOT NULL),
counted AS (SELECT day, item FROM dui GROUP BY day, item HAVING count(*) BETWEEN 2 AND 1000),
dbasket AS (SELECT u, count(DISTINCT item) AS n,
                   list((day, item)) FILTER (WHERE (day, item) IN (SELECT (day, item) FROM counted)) AS shared
            FROM dui GROUP BY u),
dbuyers AS (SELECT a.item AS itemi, b.item AS itemj, list(DISTINCT a.u) AS users
            FROM dui a JOIN dui b ON a.day = b.day AND a.u = b.u AND a.item < b.item
            WHERE a.item IN (SELECT item FROM wl) AND b.item IN (SELECT item FROM wl) GROUP BY 1, 2),
dpairing AS (SELECT itemi, itemj, x.u AS u, unnest(list_filter(users, lambda y: y > x.u)) AS v
             FROM dbuyers, unnest(users) AS x(u)),
dhalf AS (SELECT itemi, itemj, sum((1.0 / sqrt(x.n)) * (1.0 / sqrt(y.n)) / (1 + len(list_intersect(x.shared, y.shared)))) AS s
          FROM dpairing p JOIN dbasket x ON x.u = p.u JOIN dbasket y ON y.u = p.v
          WHERE len(list_intersect(x.shared, y.shared)) > 0 GROUP BY itemi, itemj),
dswing AS (SELECT unnest([itemi, itemj]) AS itemi, unnest([itemj, itemi]) AS itemj, s AS swing_score FROM dhalf)"""

FEAT = """feat AS (
  SELECT p_partkey AS itemid, p_retailprice / 4000.0 AS ctcvr30, 'ID' AS country, '2024-01-29' AS dt FROM part
  UNION ALL
  SELECT p_partkey, p_retailprice / 2000.0, 'ID', '2024-01-30' FROM part WHERE p_size % 3 <> 0),
feat_new AS (SELECT itemid, ctcvr30 FROM feat WHERE country = 'ID' AND dt = (SELECT max(dt) FROM feat WHERE country = 'ID')),
rw AS (SELECT a.itemi, a.itemj, b.ctcvr30 * a.swing_score AS swing_score FROM swing a JOIN feat_new b ON a.itemj = b.itemid),
rw_top AS (SELECT * FROM (SELECT itemi, CAST(row_number() OVER (PARTITION BY itemi ORDER BY round(swing_score, 9) DESC, itemj) AS BIGINT) AS rank,
           itemj, swing_score FROM rw) WHERE rank <= 200)"""

SHOPS = """shop AS (SELECT p_partkey AS item_id, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS shop_id FROM part),
cases AS (
  SELECT CAST(b.shop_id AS VARCHAR) || ':' || CAST(a.itemi AS VARCHAR) AS shopi_itemi,
         CAST(c.shop_id AS VARCHAR) || ':' || CAST(a.itemj AS VARCHAR) AS shopj_itemj, a.itemj, a.swing_score
  FROM swing a JOIN shop b ON a.itemi = b.item_id JOIN shop c ON a.itemj = c.item_id),
cases_rk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shopi_itemi ORDER BY round(swing_score, 9) DESC, itemj) AS rk
             FROM cases) WHERE rk <= 100)"""


GRAPH = f"""g AS (SELECT user_id AS u, CAST(ts AS DATE) AS day, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item,
             ts, event_id AS eid FROM events WHERE user_id > 0),
g_next AS (SELECT day, item AS a, lead(item) OVER (PARTITION BY u, day ORDER BY ts, eid) AS b
           FROM g WHERE item IS NOT NULL AND ts IS NOT NULL),
g_daily AS (SELECT day, va, vb, sum(1.0::DOUBLE) AS w FROM (
              SELECT day, a AS va, b AS vb FROM g_next WHERE b IS NOT NULL AND a <> b
              UNION ALL SELECT day, b AS va, a AS vb FROM g_next WHERE b IS NOT NULL AND a <> b) GROUP BY ALL),
g_merged AS (SELECT va, vb, sum(w) AS w FROM g_daily
             WHERE day BETWEEN DATE '{P.DAY}' - INTERVAL {P.MERGE_DAYS} DAY AND DATE '{P.DAY}'
               AND va IN (SELECT item FROM wl) AND vb IN (SELECT item FROM wl)
             GROUP BY va, vb HAVING sum(w) >= 0),
adj AS (SELECT va, CAST(row_number() OVER (PARTITION BY va ORDER BY vb) - 1 AS BIGINT) AS idx, vb, w,
               CAST(count(*) OVER (PARTITION BY va) AS BIGINT) AS deg FROM g_merged WHERE w > {P.EDGE_THRE}),
deg AS (SELECT DISTINCT va, deg FROM adj),
labels AS (SELECT va, vb, w FROM g_daily WHERE day = DATE '{P.DAY}')"""


def _local_days(day: str, n: int, tz: int) -> tuple[str, str]:
    import datetime as dt
    d = dt.date.fromisoformat(day)
    start = dt.datetime.combine(d - dt.timedelta(days=n), dt.time()) - dt.timedelta(hours=tz)
    end = dt.datetime.combine(d + dt.timedelta(days=1), dt.time()) - dt.timedelta(hours=tz)
    return start.isoformat(sep=" "), end.isoformat(sep=" ")


_HS, _HE = _local_days(P.PRED_DAY, P.MERGE_DAYS, P.TZ)
_LS, _LE = _local_days(P.LABEL_DAY, 0, P.TZ)

USERCF = f"""hist_src AS (SELECT u, item, ts FROM ev_ok WHERE ts >= TIMESTAMP '{_HS}' AND ts < TIMESTAMP '{_HE}'
                  AND item IN (SELECT item FROM wl)),
hist AS (SELECT * FROM (SELECT u, item, CAST(row_number() OVER (PARTITION BY u ORDER BY ts DESC, item) AS BIGINT) AS rank
         FROM hist_src) WHERE rank <= 700),
hui AS (SELECT DISTINCT u, item FROM hist),
hsz AS (SELECT u, CAST(count(*) AS BIGINT) AS n FROM hui GROUP BY u),
hw AS (SELECT a.u AS ua, b.u AS ub, CAST(count(*) AS BIGINT) AS weight FROM hui a JOIN hui b ON a.item = b.item AND a.u < b.u GROUP BY 1, 2),
hs AS (SELECT ua, ub, weight, s1.n AS weight_a, s2.n AS weight_b, weight / sqrt(s1.n) / sqrt(s2.n) AS score
       FROM hw JOIN hsz s1 ON ua = s1.u JOIN hsz s2 ON ub = s2.u),
usim AS (SELECT ua AS u1, ub AS u2, weight, weight_a, weight_b, score FROM hs
         UNION ALL SELECT ub, ua, weight, weight_b, weight_a, score FROM hs),
hcnt AS (SELECT u AS u2, item, sum(1.0) AS cnt FROM hist GROUP BY 1, 2),
recv AS (SELECT s.u1, h.item, sum(s.score * h.cnt) AS value FROM usim s JOIN hcnt h ON s.u2 = h.u2 GROUP BY 1, 2),
recs AS (SELECT * FROM (SELECT u1 AS u, CAST(row_number() OVER (PARTITION BY u1 ORDER BY round(value, 9) DESC, CAST(item AS VARCHAR)) AS BIGINT) AS rank,
         item, value FROM recv) WHERE rank <= 700),
lab AS (SELECT DISTINCT u, item FROM ev_ok WHERE ts >= TIMESTAMP '{_LS}' AND ts < TIMESTAMP '{_LE}'),
lsz AS (SELECT u, count(*) AS n FROM lab GROUP BY u),
hits AS (SELECT r.u, count(*) AS h FROM recs r JOIN lab l ON r.u = l.u AND r.item = l.item GROUP BY r.u),
hr AS (SELECT s.u, COALESCE(h.h, 0) / s.n AS score FROM lsz s JOIN (SELECT DISTINCT u FROM recs) p ON s.u = p.u
       LEFT JOIN hits h ON s.u = h.u)"""

QUOTA = """sym1 AS (SELECT va AS item, vb AS nbr, score FROM scores UNION ALL SELECT vb AS item, va AS nbr, score FROM scores),
top1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY round(score, 9) DESC, nbr) AS r FROM sym1) WHERE r <= 1000),
qshop AS (SELECT p_partkey AS nbr, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS shop_id FROM part),
q1 AS (SELECT * FROM (SELECT t.*, q.shop_id, row_number() OVER (PARTITION BY t.item, q.shop_id ORDER BY round(t.score, 9) DESC, t.nbr) AS gr
       FROM top1 t JOIN qshop q ON t.nbr = q.nbr) WHERE gr <= 5),
quota AS (SELECT * FROM (SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY round(score, 9) DESC, nbr) AS BIGINT) AS rank, nbr, score
          FROM q1) WHERE rank <= 500)"""


# user-CF with short histories and lists
USERCF_SHORT = """sh AS (SELECT * FROM (SELECT u, item, row_number() OVER (PARTITION BY u ORDER BY ts DESC, item) AS rank
         FROM hist_src) WHERE rank <= 5),
si AS (SELECT u, list(DISTINCT item) AS items FROM sh GROUP BY u),
sl AS (SELECT a.u AS u, b.u AS v, len(list_intersect(a.items, b.items)) / sqrt(len(a.items) * len(b.items)) AS like_
       FROM si a JOIN si b ON a.u <> b.u AND list_has_any(a.items, b.items)),
sv AS (SELECT l.u, h.item, sum(l.like_) AS value FROM sl l JOIN sh h ON h.u = l.v GROUP BY l.u, h.item),
srec AS (SELECT * FROM (SELECT u, CAST(row_number() OVER (PARTITION BY u ORDER BY round(value, 9) DESC, CAST(item AS VARCHAR)) AS BIGINT) AS rank,
         item, value FROM sv) WHERE rank <= 10)"""

QUOTA_LOW32 = """low AS (SELECT va AS item, (vb << 32) | shop_id AS nbr, score FROM (
            SELECT va, vb, score FROM scores UNION ALL SELECT vb, va, score FROM scores)
          JOIN (SELECT p_partkey AS vb, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS shop_id FROM part) USING (vb)),
low1 AS (SELECT *, row_number() OVER (PARTITION BY item, nbr & 4294967295 ORDER BY round(score, 9) DESC, nbr) AS gr FROM low),
low2 AS (SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY round(score, 9) DESC, nbr) AS BIGINT) AS rank, nbr, score
         FROM low1 WHERE gr <= 2)"""

CLICK_LOG = f"""log AS (SELECT user_id AS u, {STRICT_K} AS item, event_id AS ts, event_type, ts AS utc, props FROM events),
picked AS (SELECT u, item, ts FROM log
           WHERE u > 0 AND length(props) > 0 AND event_type = 'click' AND u % 3 = 1 AND ts % 2 = 0
             AND CAST(utc + INTERVAL {P.TZ} HOUR AS DATE) = DATE '{P.LABEL_DAY}' AND item <> 0)"""

SENT = """sent_rk AS (SELECT u, day, item, row_number() OVER (PARTITION BY u, day ORDER BY ts, eid) AS pos FROM ev_ok),
sent AS (SELECT u, day, CAST((pos - 1) // 1000 AS BIGINT) AS chunk,
                string_agg(CAST(item AS VARCHAR), ' ' ORDER BY pos) AS sentence FROM sent_rk GROUP BY ALL)"""

EMB = """emb AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def knn_sql(space: str, k: int, name: str = "knn", with_emb: bool = True) -> str:
    dist = {"cosine": "1 - list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v))",
            "ip": "1 - list_dot_product(a.v, b.v)",
            "l2": "list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"}[space]
    head = f"{EMB},\n" if with_emb else ""
    return f"""{head}{name}_pairs AS (SELECT a.id AS qid, b.id AS cid, {dist} AS dist FROM emb a CROSS JOIN emb b),
{name} AS (SELECT * FROM (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), cid) AS BIGINT) AS rank,
        cid, dist FROM {name}_pairs) WHERE rank <= {k})"""


INBATCH = f"""{EMB},
pr AS (SELECT a.id // 2 AS pair, a.v AS av, b.v AS bv FROM emb a JOIN emb b ON b.id = a.id + 1 WHERE a.id % 2 = 0),
bp AS (SELECT CAST(pair // {P.BATCH_SIZE} AS BIGINT) AS batch, CAST(pair % {P.BATCH_SIZE} AS BIGINT) AS pos, av, bv FROM pr),
sc AS (SELECT x.batch, x.pos AS i, y.pos AS j, list_dot_product(x.av, y.bv) AS s, round(list_dot_product(x.av, y.bv), 9) AS r
       FROM bp x JOIN bp y ON x.batch = y.batch),
lossr AS (SELECT batch, i, exp(max(CASE WHEN i = j THEN s END) - max(s)) / sum(exp(s - m)) AS p_pos
          FROM (SELECT *, max(s) OVER (PARTITION BY batch, i) AS m FROM sc) GROUP BY batch, i),
dg AS (SELECT batch, i, r AS d, s AS diag FROM sc WHERE i = j),
rowm AS (SELECT c.batch, c.i, max(dg.diag) AS diag, sum(CASE WHEN c.i <> c.j THEN c.s END) AS off_sum,
                sum(CASE WHEN c.i <> c.j THEN 1 ELSE 0 END) AS off_n,
                1 + sum(CASE WHEN c.r > dg.d OR (c.r = dg.d AND c.j < c.i) THEN 1 ELSE 0 END) AS rank
         FROM sc c JOIN dg ON c.batch = dg.batch AND c.i = dg.i GROUP BY c.batch, c.i),
met AS (SELECT batch, CAST(count(*) AS BIGINT) AS n, avg(diag) AS pos_cos, sum(off_sum) / sum(off_n) AS neg_cos,
               avg(CASE WHEN rank = 1 THEN 1.0 ELSE 0.0 END) AS p_at_1, avg(1.0 / rank) AS mrr FROM rowm GROUP BY batch)"""

MMR2 = f"""{knn_sql('cosine', P.MMR_K + 1)},
cand0 AS (SELECT qid, cid, dist, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), cid) AS rk FROM knn WHERE qid <> cid),
cand AS (SELECT qid AS query, cid AS item, 1.0 - dist AS score FROM cand0 WHERE rk <= {P.MMR_K}),
first AS (SELECT * FROM (SELECT query, item, score, 0.5 * score - 0.5 * 0.0 AS mmr,
          row_number() OVER (PARTITION BY query ORDER BY round(0.5 * score - 0.5 * 0.0, 9) DESC, round(score, 9) DESC, item) AS k
          FROM cand) WHERE k = 1),
sec0 AS (SELECT c.query, c.item, c.score,
                0.5 * c.score - 0.5 * greatest(0.0, list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v))) AS mmr
         FROM cand c JOIN first f ON c.query = f.query AND c.item <> f.item
         JOIN emb a ON a.id = c.item JOIN emb b ON b.id = f.item),
second AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(mmr, 9) DESC, round(score, 9) DESC, item) AS k
           FROM sec0) WHERE k = 1),
mmr2 AS (SELECT query, CAST(1 AS BIGINT) AS rank, item, mmr FROM first UNION ALL SELECT query, CAST(2 AS BIGINT), item, mmr FROM second)"""

def mmr_full_sql(csim: str) -> str:
    """Greedy MMR (top_n picks) as a recursive CTE; ``csim`` defines (query, i, j, sim >= 0)."""
    return f"""{knn_sql('cosine', P.MMR_K + 1)},
cand0 AS (SELECT qid, cid, dist, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), cid) AS rk FROM knn WHERE qid <> cid),
cand AS (SELECT qid AS query, cid AS item, 1.0 - dist AS score FROM cand0 WHERE rk <= {P.MMR_K}),
csim AS ({csim}),
first AS (SELECT * FROM (SELECT query, item, 0.5 * score - 0.5 * 0.0 AS mmr,
          row_number() OVER (PARTITION BY query ORDER BY round(0.5 * score - 0.5 * 0.0, 9) DESC, round(score, 9) DESC, item) AS k
          FROM cand) WHERE k = 1),
steps AS (
  SELECT query, CAST(1 AS BIGINT) AS rank, item, mmr, [item] AS chosen FROM first
  UNION ALL
  SELECT s.query, s.rank + 1, b.item, b.mmr, list_append(s.chosen, b.item)
  FROM steps s JOIN LATERAL (
      SELECT c.item, c.score, 0.5 * c.score - 0.5 * COALESCE(max(x.sim), 0.0) AS mmr
      FROM cand c LEFT JOIN csim x ON x.query = c.query AND x.i = c.item AND list_contains(s.chosen, x.j)
      WHERE c.query = s.query AND NOT list_contains(s.chosen, c.item)
      GROUP BY c.item, c.score
      ORDER BY round(0.5 * c.score - 0.5 * COALESCE(max(x.sim), 0.0), 9) DESC, round(c.score, 9) DESC, c.item
      LIMIT 1) b ON TRUE
  WHERE s.rank < {P.MMR_TOP_N})"""


# similarity = cosine of the two candidates' vectors
CSIM_VECTORS = """SELECT a.query, a.item AS i, b.item AS j,
       greatest(0.0, list_dot_product(ea.v, eb.v) / sqrt(list_dot_product(ea.v, ea.v)) / sqrt(list_dot_product(eb.v, eb.v))) AS sim
FROM cand a JOIN cand b ON a.query = b.query AND a.item <> b.item JOIN emb ea ON ea.id = a.item JOIN emb eb ON eb.id = b.item"""

# similarity table = the candidate lists themselves (item_a's list holds item_b with that score); else 0
CSIM_TABLE = """SELECT a.query, a.item AS i, b.item AS j, greatest(0.0, t.score) AS sim
FROM cand a JOIN cand b ON a.query = b.query AND a.item <> b.item JOIN cand t ON t.query = a.item AND t.item = b.item"""


DICT = """tok AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS word FROM documents),
tokw AS (SELECT * FROM tok WHERE length(word) > 0),
dwords AS (SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS word FROM benchmark) WHERE length(word) > 0),
dm AS (SELECT t.doc_id, CAST(count(*) AS BIGINT) AS n_words,
              CAST(count(*) FILTER (WHERE t.word IN (SELECT word FROM dwords)) AS BIGINT) AS n_matched
       FROM tokw t GROUP BY t.doc_id)"""


def ivf_seeded_sql(n_lists: int, n_probe: int, k: int) -> str:
    return f"""{EMB},
en AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM emb),
cen AS (SELECT * FROM (SELECT row_number() OVER (ORDER BY h, id) - 1 AS list, v
        FROM (SELECT id, v, ('0x' || substr(md5(concat_ws('|', '{P.SEED}', id)), 1, 15))::BIGINT AS h FROM en))
        WHERE list < {n_lists}),
dc AS (SELECT e.id, c.list, list_dot_product(e.v, e.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(e.v, c.v) AS d
       FROM en e CROSS JOIN cen c),
rk AS (SELECT id, list, row_number() OVER (PARTITION BY id ORDER BY round(d, 9), list) AS r FROM dc),
ivf_cand AS (SELECT p.id AS qid, a.id AS cid,
             1 - list_dot_product(q.v, c.v) / sqrt(list_dot_product(q.v, q.v)) / sqrt(list_dot_product(c.v, c.v)) AS dist
             FROM rk p JOIN rk a ON a.list = p.list AND a.r = 1 JOIN en q ON q.id = p.id JOIN en c ON c.id = a.id
             WHERE p.r <= {n_probe}),
knn AS (SELECT * FROM (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), cid) AS BIGINT) AS rank,
        cid, dist FROM ivf_cand) WHERE rank <= {k})"""


def _h(tag: str, *ctx: str) -> str:
    parts = ", ".join(["'" + P.SEED + "'", "'" + tag + "'", *ctx, "j"])
    return f"('0x' || substr(md5(concat_ws('|', {parts})), 1, 15))::BIGINT % (j + 1)"


def _draws(n: str, k: int, tag: str, *ctx: str) -> str:
    h = _h(tag, *ctx)
    full = f"CASE WHEN {k} // {n} > 0 THEN list_transform(range(0, ({k} // {n}) * {n}), lambda x: x % {n}) ELSE []::BIGINT[] END"
    floyd = (f"CASE WHEN {k} % {n} > 0 THEN list_reduce(range({n} - {k} % {n}, {n}), lambda acc, j: "
             f"CASE WHEN list_contains(acc, {h}) THEN list_append(acc, j) ELSE list_append(acc, {h}) END, []::BIGINT[]) "
             f"ELSE []::BIGINT[] END")
    return f"CASE WHEN {n} > 0 THEN list_concat({full}, {floyd}) ELSE []::BIGINT[] END"


def sampler(prefix: str, centre: str, other: str) -> str:
    """CTEs <prefix>_h1(tag, va, vb, pos, hop1) and <prefix>_h2(tag, va, vb, pos, hop1, pos2, hop2)."""
    return f"""{prefix}_ctx AS (SELECT unnest(range(CAST(floor(w) AS BIGINT))) AS tag, {centre} AS va, {other} AS vb
                FROM labels WHERE floor(w) >= 1),
{prefix}_d1 AS (SELECT c.tag, c.va, c.vb, d.deg, {_draws('d.deg', P.HOP1, 'h1', 'c.tag', 'c.va', 'c.vb')} AS dr
               FROM {prefix}_ctx c JOIN deg d ON c.va = d.va),
{prefix}_x1 AS (SELECT tag, va, vb, unnest(dr) AS idx, unnest(range(len(dr))) AS pos FROM {prefix}_d1),
{prefix}_h1 AS (SELECT x.tag, x.va, x.vb, CAST(x.pos AS BIGINT) AS pos, a.vb AS hop1
               FROM {prefix}_x1 x JOIN adj a ON a.va = x.va AND a.idx = x.idx),
{prefix}_c2 AS (SELECT h.*, d.deg AS deg1, ci.idx AS cidx, d.deg - CASE WHEN ci.idx IS NULL THEN 0 ELSE 1 END AS n2
               FROM {prefix}_h1 h JOIN deg d ON d.va = h.hop1 LEFT JOIN adj ci ON ci.va = h.hop1 AND ci.vb = h.va),
{prefix}_d2 AS (SELECT *, {_draws('n2', P.HOP2, 'h2', 'tag', 'va', 'vb', 'pos')} AS dr FROM {prefix}_c2),
{prefix}_x2 AS (SELECT tag, va, vb, pos, hop1, cidx, unnest(dr) AS j, unnest(range(len(dr))) AS pos2 FROM {prefix}_d2),
{prefix}_h2 AS (SELECT x.tag, x.va, x.vb, x.pos, x.hop1, CAST(x.pos2 AS BIGINT) AS pos2, a.vb AS hop2
               FROM {prefix}_x2 x JOIN adj a ON a.va = x.hop1
                AND a.idx = x.j + CASE WHEN x.cidx IS NOT NULL AND x.j >= x.cidx THEN 1 ELSE 0 END),
{prefix}_hop1 AS (SELECT c.tag, c.va, c.vb, c.pos, c.hop1,
                  COALESCE((SELECT list(h.hop2 ORDER BY h.pos2) FROM {prefix}_h2 h
                            WHERE h.tag = c.tag AND h.va = c.va AND h.vb = c.vb AND h.pos = c.pos), []::BIGINT[]) AS hop2s
                 FROM {prefix}_c2 c),
{prefix}_rows AS (SELECT tag, va, vb, list(hop1 ORDER BY pos) AS hop1s, list(hop2s ORDER BY pos) AS hop2s
                 FROM {prefix}_hop1 GROUP BY tag, va, vb)"""


def gnn_sql() -> str:
    """NN1 forward pass over the graph samples as joins and aggregates.

    The supplied weights are literal tables; vectors are exploded to
    (id, j, x); each layer is a join on the input index plus a grouped sum,
    max-pooling a grouped max, then L2 normalisation."""
    import numpy as np
    from coclick.operators.gnn import init_weights
    from coclick.plans.catalog import GNN_DIMS, GNN_SEED

    W = init_weights(*GNN_DIMS, seed=GNN_SEED)
    mats = ", ".join(f"('{m}', {j}, {k}, {float(v)!r})" for m in ("mlp2_w", "self2_w", "neigh2_w", "mlp1_w",
                                                                   "self1_w", "neigh1_w")
                     for (j, k), v in np.ndenumerate(W[m]))
    bias = ", ".join(f"('{m}', {k}, {float(v)!r})" for m in ("mlp2_b", "mlp1_b") for k, v in enumerate(W[m]))
    leaky = "CASE WHEN {0} >= 0 THEN {0} ELSE 0.02 * ({0}) END"
    return f"""wt(m, j, k, w) AS (VALUES {mats}),
bt(m, k, b) AS (VALUES {bias}),
ev AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS j, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
g2 AS (SELECT h.tag, h.va, h.vb, h.pos, h.pos2, w.k, sum(e.x * w.w) AS s
       FROM sa_h2 h JOIN ev e ON e.id = h.hop2 JOIN wt w ON w.m = 'mlp2_w' AND w.j = e.j GROUP BY ALL),
pool2 AS (SELECT g.tag, g.va, g.vb, g.pos, g.k, max({leaky.format('g.s + b.b')}) AS p
          FROM g2 g JOIN bt b ON b.m = 'mlp2_b' AND b.k = g.k GROUP BY ALL),
h1s AS (SELECT c.tag, c.va, c.vb, c.pos, w.k, sum(e.x * w.w) AS s
        FROM sa_c2 c JOIN ev e ON e.id = c.hop1 JOIN wt w ON w.m = 'self2_w' AND w.j = e.j GROUP BY ALL),
h1n AS (SELECT p.tag, p.va, p.vb, p.pos, w.k, sum(p.p * w.w) AS s
        FROM pool2 p JOIN wt w ON w.m = 'neigh2_w' AND w.j = p.k GROUP BY ALL),
out2 AS (SELECT a.tag, a.va, a.vb, a.pos, a.k, {leaky.format('a.s + COALESCE(n.s, 0.0)')} AS o
         FROM h1s a LEFT JOIN h1n n ON a.tag = n.tag AND a.va = n.va AND a.vb = n.vb AND a.pos = n.pos AND a.k = n.k),
g1 AS (SELECT o.tag, o.va, o.vb, o.pos, w.k, sum(o.o * w.w) AS s
       FROM out2 o JOIN wt w ON w.m = 'mlp1_w' AND w.j = o.k GROUP BY ALL),
pool1 AS (SELECT g.tag, g.va, g.vb, g.k, max({leaky.format('g.s + b.b')}) AS p
          FROM g1 g JOIN bt b ON b.m = 'mlp1_b' AND b.k = g.k GROUP BY ALL),
cs AS (SELECT r.tag, r.va, r.vb, w.k, sum(e.x * w.w) AS s
       FROM (SELECT DISTINCT tag, va, vb FROM sa_c2) r JOIN ev e ON e.id = r.va
       JOIN wt w ON w.m = 'self1_w' AND w.j = e.j GROUP BY ALL),
cn AS (SELECT p.tag, p.va, p.vb, w.k, sum(p.p * w.w) AS s
       FROM pool1 p JOIN wt w ON w.m = 'neigh1_w' AND w.j = p.k GROUP BY ALL),
gout AS (SELECT a.tag, a.va, a.vb, a.k, a.s + COALESCE(n.s, 0.0) AS o
         FROM cs a LEFT JOIN cn n ON a.tag = n.tag AND a.va = n.va AND a.vb = n.vb AND a.k = n.k),
gnorm AS (SELECT tag, va, vb, sqrt(sum(o * o)) AS n FROM gout GROUP BY ALL)"""


def two_tower_sql() -> str:
    """Both towers, then the softmax loss over the pairs that share a centre."""
    shared, own = gnn_sql().split("\ng2 AS", 1)
    names = "g2 pool2 h1s h1n out2 g1 pool1 cs cn gout gnorm".split()
    other = re.sub(rf"\b({'|'.join(names)})\b", r"\1_b", "g2 AS" + own).replace("sa_", "sb_")
    return f"""{shared}
g2 AS{own},
{other},
ta AS (SELECT o.tag, o.va, o.vb, o.k, o.o / greatest(n.n, 1e-12) AS x FROM gout o JOIN gnorm n USING (tag, va, vb)),
tb AS (SELECT o.tag, o.vb AS va, o.va AS vb, o.k, o.o / greatest(n.n, 1e-12) AS x
       FROM gout_b o JOIN gnorm_b n USING (tag, va, vb)),
both_towers AS (SELECT tag, va, vb, row_number() OVER (PARTITION BY va ORDER BY tag, vb) - 1 AS pos
                FROM (SELECT DISTINCT tag, va, vb FROM ta) SEMI JOIN tb USING (tag, va, vb)),
tsc AS (SELECT p.va AS batch, p.pos AS i, q.pos AS j, sum(a.x * b.x) AS s
        FROM both_towers p JOIN both_towers q ON p.va = q.va
        JOIN ta a ON a.tag = p.tag AND a.va = p.va AND a.vb = p.vb
        JOIN tb b ON b.tag = q.tag AND b.va = q.va AND b.vb = q.vb AND b.k = a.k GROUP BY ALL),
tloss AS (SELECT batch, i AS pos, max(CASE WHEN i = j THEN exp(s) END) / sum(exp(s)) AS p_pos FROM tsc GROUP BY batch, i)"""


def _arr(c: str) -> str:
    return f"'[' || array_to_string(list_transform({c}, lambda x: CAST(x AS VARCHAR)), ',') || ']'"


def _arr2(c: str) -> str:
    inner = f"list_transform({c}, lambda a: '[' || array_to_string(list_transform(a, lambda x: CAST(x AS VARCHAR)), ',') || ']')"
    return f"'[' || array_to_string({inner}, ',') || ']'"


def _q(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


def sql() -> dict[str, str]:
    q = {}
    q["itemcf_daily"] = _q(",\n".join([CP, cf_daily("cp", "u")]),
                           "SELECT vi, vj, round(weight, 6) AS weight FROM daily")
    q["itemcf_merged"] = _q(",\n".join([EV, WL, cf_daily("ev_ok", "day, u"),
                                        cf_merged("daily", min_weight=P.EVENTS_MIN_WEIGHT,
                                                  day_filter=f"day BETWEEN DATE '{P.DAY}' - INTERVAL {P.MERGE_DAYS} DAY AND DATE '{P.DAY}'")]),
                            "SELECT va, vb, round(weight, 6) AS weight FROM merged")
    q["itemcf_scores"] = _q(",\n".join([CP_CHAIN, CF_SCORES]),
                            "SELECT va, vb, weight, weight_a, weight_b, round(score, 6) AS score FROM scores")
    q["itemcf_topk"] = _q(",\n".join([CP_CHAIN, CF_SCORES, CF_LISTS]),
                          "SELECT item, rank, nbr, round(score, 6) AS score FROM lists")
    q["itemcf_lines"] = _q(",\n".join([CP_CHAIN, CF_SCORES, CF_LISTS]),
                           "SELECT item, CAST(item AS VARCHAR) || chr(9) || "
                           "string_agg(printf('%d:%.6f', nbr, round(score, 6)), ';' ORDER BY rank) AS line "
                           "FROM lists GROUP BY item")
    q["itemcf_capped"] = _q(",\n".join([CP, cf_daily("cp", "u", cap=20, window=3)]),
                            "SELECT vi, vj, round(weight, 6) AS weight FROM daily")
    q["itemcf_short_lists"] = _q(",\n".join([CP_CHAIN, CF_SCORES, CF_LISTS]),
                                 "SELECT item, rank, nbr, round(score, 6) AS score FROM lists_short")
    q["itemcf_bounded_lists"] = q["itemcf_short_lists"]
    q["itemcf_pairs_over"] = _q(",\n".join([CP_CHAIN, CF_SCORES]),
                                "SELECT va, vb, weight, weight_a, weight_b, round(score, 6) AS score FROM scores WHERE score > 0.15")
    sw = ",\n".join([CP, WL, SWING])
    q["swing_u2u_rare_items"] = _q(sw.replace("BETWEEN 2 AND 1000", "BETWEEN 2 AND 25"), "SELECT ui, uj, weight FROM u2u")
    q["swing_lines"] = _q(sw, "SELECT itemi, CAST(itemi AS VARCHAR) || chr(9) || "
                              "string_agg(printf('%d:%.6f', itemj, round(swing_score, 6)), ';' ORDER BY rank) AS line "
                              "FROM swing_top GROUP BY itemi")
    q["swing_lines_parsed"] = _q(sw, "SELECT itemi AS key, itemj AS item, round(swing_score, 6) AS score FROM swing_top")
    q["swing_daily_scores"] = _q(",\n".join([WL, SWING_DAILY]),
                                 "SELECT itemi, itemj, round(swing_score, 6) AS swing_score FROM dswing")
    q["swing_user_weight"] = _q(sw, "SELECT u AS user, round(weight, 6) AS weight FROM uw")
    q["swing_u2u"] = _q(sw, "SELECT ui, uj, weight FROM u2u")
    q["swing_i2i_users"] = _q(sw, "SELECT itemi, itemj, u AS user FROM i2iu")
    q["swing_paths"] = _q(sw, "SELECT itemi, itemj, ui, uj FROM paths")
    q["swing_scores"] = _q(sw, "SELECT itemi, itemj, round(swing_score, 6) AS swing_score FROM swing")
    q["swing_topk"] = _q(sw, "SELECT itemi, rank, itemj, round(swing_score, 6) AS swing_score FROM swing_top")
    q["swing_reweighted"] = _q(",\n".join([sw, FEAT]),
                               "SELECT itemi, rank, itemj, round(swing_score, 6) AS swing_score FROM rw_top")
    q["swing_cases"] = _q(",\n".join([sw, SHOPS]),
                          "SELECT shopi_itemi, shopi_itemi || ' ' || string_agg(shopj_itemj, ' ' ORDER BY rk) AS line "
                          "FROM cases_rk GROUP BY shopi_itemi")
    pct = ", ".join(f"round(quantile_cont(length, {q / 100}), 6) AS per{q}" for q in range(10, 100, 10))
    q["list_length_profile"] = _q(sw, "SELECT CAST(count(length) AS BIGINT) AS key_size, round(avg(length), 6) AS avg_length, "
                                      f"{pct} FROM (SELECT CAST(count(*) AS INTEGER) AS length FROM swing_top GROUP BY itemi)")
    gr = ",\n".join([WL, GRAPH])
    q["graph_session_edges"] = _q(gr, "SELECT CAST(day AS VARCHAR) AS day, va, vb, w FROM g_daily")
    q["graph_merged"] = _q(gr, "SELECT va, vb, w FROM g_merged")
    q["graph_adjacency"] = _q(gr, "SELECT va, idx, vb, w, deg FROM adj")
    q["graph_hop1"] = _q(",\n".join([gr, sampler("sa", "va", "vb")]), "SELECT tag, va, vb, pos, hop1 FROM sa_h1")
    q["graph_hop2"] = _q(",\n".join([gr, sampler("sa", "va", "vb")]), "SELECT tag, va, vb, pos, pos2, hop2 FROM sa_h2")
    q["gnn_embeddings"] = _q(",\n".join([gr, sampler("sa", "va", "vb"), gnn_sql()]),
                             "SELECT o.tag, o.va, o.vb, CAST(o.k AS BIGINT) AS dim, "
                             "round(o.o / greatest(n.n, 1e-12), 6) + 0.0 AS value "
                             "FROM gout o JOIN gnorm n ON o.tag = n.tag AND o.va = n.va AND o.vb = n.vb")
    q["gnn_two_tower_loss"] = _q(",\n".join([gr, sampler("sa", "va", "vb"), sampler("sb", "vb", "va"), two_tower_sql()]),
                                 "SELECT batch, CAST(pos AS BIGINT) AS pos, round(-ln(p_pos + 1e-8), 6) + 0.0 AS loss, "
                                 "round(p_pos, 6) + 0.0 AS p_pos FROM tloss")
    q["graph_training_rows"] = _q(
        ",\n".join([gr, sampler("sa", "va", "vb"), sampler("sb", "vb", "va")]),
        f"SELECT a.tag, a.va, a.vb, {_arr('a.hop1s')} AS va_hop1, {_arr2('a.hop2s')} AS va_hop2, "
        f"{_arr('b.hop1s')} AS vb_hop1, {_arr2('b.hop2s')} AS vb_hop2 "
        "FROM sa_rows a JOIN sb_rows b ON a.tag = b.tag AND a.va = b.vb AND a.vb = b.va")
    uc = ",\n".join([EV, WL, USERCF])
    q["usercf_history"] = _q(uc, "SELECT u AS user, rank, item FROM hist")
    q["usercf_similarity"] = _q(uc, "SELECT u1, u2, weight, weight_a, weight_b, round(score, 6) AS score FROM usim")
    q["usercf_recommend"] = _q(uc, "SELECT u AS user, rank, item, round(value, 6) AS value FROM recs")
    q["usercf_lines"] = _q(uc, "SELECT u AS user, CAST(u AS VARCHAR) || chr(9) || string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) "
                               "AS line FROM recs GROUP BY u")
    q["usercf_history_lines"] = _q(uc, "SELECT u AS user, string_agg(CAST(item AS VARCHAR) || ':' || CAST(1.0 AS VARCHAR), ',' "
                                       "ORDER BY rank) AS itemlist FROM hist GROUP BY u")
    q["usercf_short"] = _q(uc + ",\n" + USERCF_SHORT, "SELECT u AS user, rank, item, round(value, 6) AS value FROM srec")
    q["click_log"] = _q(CLICK_LOG, "SELECT u AS user, item, ts FROM picked")
    q["item_ids"] = ("SELECT event_id, " + STRICT_K + " AS item_strict, "
                     "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_cast FROM events")
    q["eval_hit_ratio"] = _q(uc, "SELECT u AS user, round(score, 6) AS score FROM hr")
    q["local_day"] = _q(EV, f"SELECT eid, u AS user, item FROM ev_ok WHERE ts >= TIMESTAMP '{_LS}' AND ts < TIMESTAMP '{_LE}'")
    q["latest_partition"] = _q(FEAT.split(",\nrw AS")[0], "SELECT itemid, round(ctcvr30, 6) AS ctcvr30, dt FROM feat "
                               "WHERE country = 'ID' AND dt = (SELECT max(dt) FROM feat WHERE country = 'ID')")
    q["group_quota"] = _q(",\n".join([CP_CHAIN, CF_SCORES, QUOTA]), "SELECT item, rank, nbr, round(score, 6) AS score FROM quota")
    q["group_quota_low32"] = _q(",\n".join([CP_CHAIN, CF_SCORES, QUOTA_LOW32]),
                                "SELECT item, rank, nbr, round(score, 6) AS score FROM low2 WHERE rank <= 10")
    q["graph_adjacency_blocks"] = q["graph_adjacency"]
    q["item2vec_facts"] = _q(",\n".join([EV, SENT]),
                             "SELECT item AS id, CAST(32 AS BIGINT) AS dim, true AS finite FROM sent_rk "
                             "GROUP BY item HAVING count(*) >= 5")
    q["sentences"] = _q(",\n".join([EV, SENT]), "SELECT u AS user, CAST(day AS VARCHAR) AS day, chunk, sentence FROM sent")
    for sp in ("cosine", "l2", "ip"):
        q[f"knn_{sp}"] = _q(knn_sql(sp, P.KNN_K), "SELECT qid, rank, cid, round(dist, 6) + 0.0 AS dist FROM knn")
    q["item2vec_groups"] = """WITH met AS (
  SELECT l_suppkey AS id, any_value(s_nationkey) AS nation FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY l_suppkey HAVING count(*) >= 5)
SELECT id, true AS same_nation FROM met WHERE nation IN (SELECT nation FROM met GROUP BY nation HAVING count(*) > 1)"""
    q["knn_graph"] = _q(knn_sql("l2", P.KNN_K), "SELECT qid, rank, cid, round(dist, 6) + 0.0 AS dist FROM knn WHERE qid % 50 = 0")
    q["knn_graph_recall"] = "SELECT count(*) AS queries, true AS recall_095 FROM embeddings WHERE vec_id % 50 = 0"
    q["knn_pruned"] = q["knn_l2"]
    q["knn_ivf_all_lists"] = q["knn_cosine"]
    q["knn_ivf_seeded"] = _q(ivf_seeded_sql(P.N_LISTS, P.N_PROBE_WIDE, P.KNN_K), "SELECT qid, rank, cid, round(dist, 6) + 0.0 AS dist FROM knn")
    q["knn_recall_seeded"] = _q(
        ivf_seeded_sql(P.N_LISTS, P.N_PROBE_WIDE, P.KNN_K) + ",\n" + knn_sql("cosine", P.KNN_K, "exact", with_emb=False),
        "SELECT round(avg(r), 6) + 0.0 AS recall, CAST(count(*) AS BIGINT) AS queries FROM ("
        "SELECT e.qid, count(a.cid) / count(*) AS r FROM exact e LEFT JOIN knn a ON a.qid = e.qid AND a.cid = e.cid "
        "GROUP BY e.qid)")
    q["knn_approx"] = _q(ivf_seeded_sql(P.N_LISTS, P.N_PROBE, P.KNN_K), "SELECT qid, rank, cid, round(dist, 6) + 0.0 AS dist FROM knn")
    q["knn_recall"] = _q(
        ivf_seeded_sql(P.N_LISTS, P.N_PROBE, P.KNN_K) + ",\n" + knn_sql("cosine", P.KNN_K, "exact", with_emb=False),
        "SELECT round(avg(r), 6) + 0.0 AS recall, CAST(count(*) AS BIGINT) AS queries FROM ("
        "SELECT e.qid, count(a.cid) / count(*) AS r FROM exact e LEFT JOIN knn a ON a.qid = e.qid AND a.cid = e.cid "
        "GROUP BY e.qid)")
    q["inbatch_loss"] = _q(INBATCH, "SELECT batch, i AS pos, round(-ln(p_pos + 1e-8) * 1.0, 6) + 0.0 AS loss, "
                                    "round(p_pos, 6) + 0.0 AS p_pos FROM lossr")
    q["inbatch_metrics"] = _q(INBATCH, "SELECT batch, n, round(pos_cos, 6) + 0.0 AS pos_cos, round(neg_cos, 6) + 0.0 AS neg_cos, "
                                       "round(p_at_1, 6) + 0.0 AS p_at_1, round(mrr, 6) + 0.0 AS mrr FROM met")
    q["mmr_top2"] = _q(MMR2, "SELECT query, rank, item, round(mmr, 6) + 0.0 AS mmr FROM mmr2")
    q["mmr_rerank"] = _q(mmr_full_sql(CSIM_VECTORS), "SELECT query, rank, item, round(mmr, 6) + 0.0 AS mmr FROM steps",
                         recursive=True)
    q["mmr_sim_table"] = _q(mmr_full_sql(CSIM_TABLE), "SELECT query, rank, item, round(mmr, 6) + 0.0 AS mmr FROM steps",
                            recursive=True)
    q["item_ids_variant"] = q["item_ids"]
    probs = [i / 10 for i in range(11)]
    q["price_quantiles"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({p} AS DOUBLE) AS probability, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM lineitem"
        for c in ("l_extendedprice", "l_discount") for p in probs)
    pieces = """asked AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS w FROM benchmark) WHERE w <> ''),
held AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS w FROM documents) WHERE w <> '')"""
    q["dictionary_prefixes"] = _q(pieces, "SELECT a.w AS prefix, count(h.w) AS n_words FROM asked a LEFT JOIN "
                                          "(SELECT w, left(w, CAST(unnest(range(1, length(w) + 1)) AS BIGINT)) AS b FROM held) h ON h.b = a.w GROUP BY a.w")
    q["dictionary_longest"] = _q(pieces, "SELECT h.w AS word, arg_max(h.b, length(h.b)) AS match FROM "
                                         "(SELECT w, left(w, CAST(unnest(range(1, length(w) + 1)) AS BIGINT)) AS b FROM held) h JOIN asked a ON h.b = a.w GROUP BY h.w")
    q["sentences_overlap"] = """WITH placed AS (
  SELECT o_custkey AS u, l_partkey AS item,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, l_orderkey, l_partkey) AS pos,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
chunked AS (SELECT *, unnest(range(CAST(greatest(0, ceil((pos - 8) / 5)) AS BIGINT), (pos - 1) // 5 + 1)) AS chunk FROM placed)
SELECT u AS user, CAST(chunk AS BIGINT) AS chunk, string_agg(CAST(item AS VARCHAR), ' ' ORDER BY pos) AS sentence
FROM chunked WHERE chunk = 0 OR chunk * 5 + 3 < n GROUP BY u, chunk"""
    q["whitelist_snapshot"] = "SELECT DISTINCT p_partkey AS item FROM part WHERE p_size % 2 = 0"
    q["snapshot_roundtrip"] = """SELECT n_nationkey, n_name, (SELECT CAST(sum(CASE WHEN n_nationkey >= 10 THEN 3 WHEN n_nationkey >= 5
  THEN 2 ELSE 1 END) AS BIGINT) FROM nation) AS rows_written, CAST(2 AS BIGINT) AS snapshots_left, '2024-01-28' AS purged FROM nation"""
    q["itemcf_scores_clustered"] = q["itemcf_scores"]
    q["graph_hop1_clustered"] = q["graph_hop1"]
    q["tsv_roundtrip"] = q["graph_training_rows"]
    q["user_lists_roundtrip"] = _q(uc, "SELECT u AS user, rank, item FROM recs")
    q["eval_roundtrip"] = q["eval_hit_ratio"]
    q["sentences_roundtrip"] = _q(",\n".join([EV, SENT]), "SELECT CAST(item AS VARCHAR) AS token, count(*) AS n FROM sent_rk GROUP BY item")
    q["vectors_roundtrip"] = ("SELECT vec_id AS id, len(embedding) AS dim, "
                              "round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings")
    q["model_roundtrip"] = _q(",\n".join([EV, SENT]),
                              "SELECT item AS id, CAST(32 AS BIGINT) AS dim FROM sent_rk GROUP BY item HAVING count(*) >= 5")
    q["itemcf_rolling"] = _q(",\n".join([EV, WL, cf_daily("ev_ok", "day, u"),
                                         cf_merged("daily", min_weight=2,
                                                   day_filter=f"day BETWEEN DATE '{P.DAY}' - INTERVAL 6 DAY AND DATE '{P.DAY}'")]),
                             "SELECT va, vb, round(weight, 6) AS weight FROM merged")
    q["dictionary_match"] = _q(DICT, "SELECT doc_id, n_words, n_matched FROM dm")
    return q
