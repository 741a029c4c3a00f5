"""SQL of the adapters: the generic events table as a market, as common table expressions."""

TAPE = """tape AS (
  SELECT CAST(ts AS DATE) AS day, ts, epoch_us(ts) AS us, event_id AS seq, user_id, value, CAST(props->>'$.k' AS BIGINT) AS k, event_type,
         CASE WHEN event_type IN ('purchase', 'click') THEN 1 WHEN event_type IN ('view', 'error') THEN -1 ELSE 0 END AS sign
  FROM events)"""
TRADES = """trades AS (
  SELECT day, ts, us, seq, floor(value) * 0.25 AS price, k AS size, CASE WHEN sign > 0 THEN 'buy' ELSE 'sell' END AS side FROM tape WHERE sign <> 0)"""
MIDS = """mids AS (
  SELECT day, ts, us, seq, sign, k, (100 + 0.25 * sum(sign) OVER (PARTITION BY day ORDER BY seq))::DOUBLE AS mid FROM tape)"""
COMMANDS = """c0 AS (
  SELECT day, us, seq, k, user_id, CASE WHEN seq % 8 = 1 AND seq % 512 <> 1 THEN 2 ELSE seq % 8 END AS code FROM tape),
commands AS (
  SELECT day, us, seq, code, k AS qty,
         (CASE WHEN code IN (2, 4, 6) THEN CASE WHEN k = 99 THEN 100.5 ELSE 100 - 0.25 * (1 + user_id % 60) END
               ELSE CASE WHEN k = 99 THEN 99.5 ELSE 100 + 0.25 * (1 + user_id % 60) END END)::DOUBLE AS price
  FROM c0)"""
SNAPSHOTS = "snaps AS (SELECT day, ts, us, seq, mid - 0.25 AS best_bid, mid + 0.25 AS best_ask, 0.5::DOUBLE AS spread, mid AS mid_price,\n  " + ",\n  ".join(
    f"((k * {i + 3} + seq * 7) % 50)::DOUBLE AS bq_{i}, ((k * {i + 5} + seq * 11) % 50)::DOUBLE AS aq_{i}" for i in range(1, 11)
) + ",\n  CASE WHEN sign < 0 THEN k ELSE 0 END::DOUBLE AS vol_bid, CASE WHEN sign > 0 THEN k ELSE 0 END::DOUBLE AS vol_ask FROM mids)"

#: The book as a recursive fold: levels are (key, price, quantity) lists, best first, keys negated for bids.
BOOK = COMMANDS + """,
steps AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY seq) AS i FROM commands WHERE code BETWEEN 1 AND 7),
book AS (
  SELECT day, 0::BIGINT AS i, 0::BIGINT AS seq, 0::BIGINT AS code, false AS missed,
         []::STRUCT(x DOUBLE, q BIGINT)[] AS b, []::STRUCT(x DOUBLE, q BIGINT)[] AS a
  FROM (SELECT DISTINCT day FROM steps)
  UNION ALL
  SELECT s.day, s.i, s.seq, s.code,
         (s.code IN (6, 7) OR s.qty = 0) AND s.code <> 1 AND len(list_filter(CASE WHEN s.code IN (2, 4, 6) THEN p.b ELSE p.a END, lambda v: abs(v.x) = s.price)) = 0,
         CASE WHEN s.code = 1 THEN [] WHEN s.code = 6 OR (s.code IN (2, 4) AND s.qty = 0) THEN list_filter(p.b, lambda v: v.x <> -s.price)
              WHEN s.code IN (2, 4) THEN list_slice(list_sort(list_append(list_filter(p.b, lambda v: v.x <> -s.price), {'x': -s.price, 'q': s.qty})), 1, 20) ELSE p.b END,
         CASE WHEN s.code = 1 THEN [] WHEN s.code = 7 OR (s.code IN (3, 5) AND s.qty = 0) THEN list_filter(p.a, lambda v: v.x <> s.price)
              WHEN s.code IN (3, 5) THEN list_slice(list_sort(list_append(list_filter(p.a, lambda v: v.x <> s.price), {'x': s.price, 'q': s.qty})), 1, 20) ELSE p.a END
  FROM book p JOIN steps s ON s.day = p.day AND s.i = p.i + 1),
states AS (SELECT * FROM book WHERE i > 0 AND code <> 1)"""

#: Changes of the mid and the threshold of each day.
DELTAS = """deltas AS (SELECT day, us, seq, mid, coalesce(mid - lag(mid) OVER (PARTITION BY day ORDER BY seq), 0) AS d FROM mids),
hs AS (SELECT day, greatest(0.5, coalesce(quantile_cont(abs(d), 0.05) FILTER (WHERE abs(d) > 0), 0.25))::DOUBLE AS h FROM deltas GROUP BY day)"""
LADDER = """ladder AS (
  SELECT day, h, abs(d) AS x, row_number() OVER (PARTITION BY day ORDER BY seq) AS i FROM deltas JOIN hs USING (day)),
rungs AS (SELECT day, h * power(2, g.n) AS h2, h FROM hs, (SELECT unnest(range(0, 24)) AS n) g),
walk AS (
  SELECT day, h2, 0::BIGINT AS i, 0::DOUBLE AS s, 0::BIGINT AS hits FROM rungs
  UNION ALL
  SELECT w.day, w.h2, l.i, CASE WHEN w.s + l.x > w.h2 THEN 0 ELSE w.s + l.x END, w.hits + CASE WHEN w.s + l.x > w.h2 THEN 1 ELSE 0 END
  FROM walk w JOIN ladder l ON l.day = w.day AND l.i = w.i + 1 WHERE l.i <= 200000),
rates AS (SELECT day, h2, max(hits)::DOUBLE / max(i) AS rate FROM walk GROUP BY day, h2),
cal AS (SELECT day, min(h2)::DOUBLE AS h FROM rates WHERE rate <= 0.10 OR h2 >= 1e6 GROUP BY day)"""
CUSUM = """path AS (SELECT d.day, d.seq, d.d, t.h, row_number() OVER (PARTITION BY d.day ORDER BY d.seq) AS i FROM deltas d JOIN {thresholds} t USING (day)),
fold AS (
  SELECT day, 0::BIGINT AS i, 0::BIGINT AS seq, 0::DOUBLE AS s, false AS hit FROM (SELECT DISTINCT day FROM path)
  UNION ALL
  SELECT p.day, p.i, p.seq, CASE WHEN f.hit THEN 0 ELSE f.s END + p.d, abs(CASE WHEN f.hit THEN 0 ELSE f.s END + p.d) > p.h
  FROM fold f JOIN path p ON p.day = f.day AND p.i = f.i + 1)"""


def with_views(*views: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(views) + "\n"
