"""DuckDB twins of the registered queries (same names, same columns).

Written independently of the Spark code: plain SQL on the driver's views.
"""

from __future__ import annotations

from typing import Dict

ORACLES: Dict[str, str] = {}

# Panel Q: supplier x ship quarter on each supplier's dense quarter grid.
PANEL_Q = """
q_agg AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period,
         sum(l_quantity) AS qty, round(sum(l_extendedprice), 2) AS rev,
         sum(round(l_discount * 100)) / count(l_discount) / 100 AS disc
  FROM lineitem GROUP BY 1, 2),
q_bounds AS (SELECT entity, min(period) AS lo, max(period) AS hi FROM q_agg GROUP BY 1),
q_grid AS (
  SELECT entity, CAST(unnest(generate_series(lo, hi, INTERVAL 3 MONTH)) AS DATE) AS period
  FROM q_bounds),
q AS (
  SELECT g.entity, g.period, a.qty, a.rev, a.disc
  FROM q_grid g LEFT JOIN q_agg a ON a.entity = g.entity AND a.period = g.period)
"""

WIDE = """
wide AS (
  SELECT date_trunc('hour', ts) AS date,
         max(CASE WHEN event_type = 'click' THEN value END) AS click,
         max(CASE WHEN event_type = 'error' THEN value END) AS error,
         max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
         max(CASE WHEN event_type = 'signup' THEN value END) AS signup,
         max(CASE WHEN event_type = 'view' THEN value END) AS view
  FROM events GROUP BY 1)
"""


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def with_q(body: str, *extra: str) -> str:
    ctes = ",\n".join([PANEL_Q.strip()] + [e.strip() for e in extra])
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- indicators
oracle("pivot_indicators", f"WITH {WIDE.strip()} SELECT * FROM wide")

oracle("inflation_mom", f"""
WITH {WIDE.strip()}
SELECT date, purchase,
       (purchase / nullif(lag(purchase) OVER (ORDER BY date), 0) - 1) * 100 AS purchase_mom
FROM wide""")

oracle("forward_fill", f"""
WITH {WIDE.strip()}
SELECT date,
  last_value(click IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS click,
  last_value(signup IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS signup,
  last_value(view IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS view
FROM wide""")

oracle("indicator_table", f"""
WITH {WIDE.strip()}
SELECT date, error, signup,
  (purchase / nullif(lag(purchase) OVER (ORDER BY date), 0) - 1) * 100 AS purchase_mom,
  last_value(click IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS click,
  last_value(view IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS view
FROM wide ORDER BY date DESC""")

# ---------------------------------------------------------------- periods
oracle("period_slice", with_q("""
SELECT * FROM q WHERE period BETWEEN DATE '1996-01-01' AND DATE '1997-10-01'"""))

oracle("parse_quarter", """
SELECT o_orderkey,
  CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN 'Q' ELSE 'q' END
    || CAST(quarter(o_orderdate) AS VARCHAR) AS qtext,
  CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period,
  CAST(NULL AS DATE) AS bad
FROM orders""")

oracle("period_range", """
WITH b AS (SELECT o_custkey, CAST(date_trunc('quarter', min(o_orderdate)) AS DATE) AS lo,
                  CAST(date_trunc('quarter', max(o_orderdate)) AS DATE) AS hi
           FROM orders GROUP BY 1)
SELECT o_custkey, CAST(unnest(generate_series(lo, hi, INTERVAL 3 MONTH)) AS DATE) AS period FROM b""")

oracle("period_arith", """
WITH p AS (SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period FROM orders)
SELECT o_orderkey, period,
  CAST(period + INTERVAL 69 MONTH AS DATE) AS plus_23,
  CAST(period - INTERVAL 18 MONTH AS DATE) AS minus_6,
  CAST((year(period) * 4 + quarter(period) - 1) - (1995 * 4) AS INTEGER) AS since_start
FROM p""")

oracle("report_window", """
WITH b AS (SELECT o_custkey, CAST(date_trunc('quarter', min(o_orderdate)) AS DATE) AS first_q,
                  CAST(date_trunc('quarter', max(o_orderdate)) AS DATE) AS last_q
           FROM orders GROUP BY 1),
n AS (SELECT *, CAST((year(last_q) * 4 + quarter(last_q)) - (year(first_q) * 4 + quarter(first_q)) AS INTEGER) AS n_qtrs FROM b),
p AS (SELECT *, CAST(greatest(least(round_even(n_qtrs / 4.0, 0), 6), 2) AS INTEGER) AS pad FROM n)
SELECT o_custkey, n_qtrs, pad, CAST(first_q - to_months(3 * pad) AS DATE) AS window_start FROM p""")

# ---------------------------------------------------------------- panel edits
oracle("set_range", with_q("""
SELECT entity, period,
  CASE WHEN period BETWEEN DATE '1998-01-01' AND DATE '1998-10-01' THEN 0.0 ELSE qty END AS qty,
  CAST(CASE WHEN period >= DATE '2000-01-01' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS regime
FROM q"""))

oracle("set_values", with_q("""
SELECT entity, period,
  CASE period WHEN DATE '1999-01-01' THEN 100.0 WHEN DATE '1999-04-01' THEN 200.0
              WHEN DATE '1999-07-01' THEN 300.0 WHEN DATE '1999-10-01' THEN 400.0
              ELSE rev END AS rev
FROM q"""))

oracle("add_shock", with_q("""
SELECT entity, period, CASE WHEN period = DATE '1997-04-01' THEN qty + 1000.0 ELSE qty END AS qty
FROM q"""))

oracle("bulk_update", with_q("""
SELECT q.entity, q.period, coalesce(r.qty, q.qty) AS qty, coalesce(r.rev, q.rev) AS rev
FROM q LEFT JOIN r ON r.entity = q.entity AND r.period = q.period""", """
r AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period,
         sum(l_quantity) AS qty, round(sum(l_extendedprice), 2) AS rev
  FROM lineitem WHERE l_returnflag = 'R'
  GROUP BY 1, 2
  HAVING period BETWEEN DATE '2000-01-01' AND DATE '2000-10-01')"""))

oracle("panel_program", with_q("""
SELECT entity, period, qty2 AS qty, rev, qty2 * 2 AS y FROM (
  SELECT entity, period,
    CASE WHEN period BETWEEN DATE '1996-07-01' AND DATE '1997-04-01' THEN 1.0
         WHEN period BETWEEN DATE '1996-01-01' AND DATE '1996-10-01' THEN 0.0
         ELSE qty END AS qty2,
    CASE WHEN period = DATE '1996-07-01' THEN rev + 500.0 ELSE rev END AS rev
  FROM q)"""))

oracle("add_missing_addfactors", with_q("""
SELECT entity, period, qty, rev, disc, CAST(1.0 AS DOUBLE) AS qty_aerr,
       CAST(0.0 AS DOUBLE) AS rev_aerr, CAST(0.0 AS DOUBLE) AS qty_trac,
       CAST(0.0 AS DOUBLE) AS rev_trac
FROM q"""))

oracle("drop_lead_columns", with_q("SELECT entity, period, qty, rev, disc, rev * 2 AS rev2 FROM q"))

# ---------------------------------------------------------------- lags, growth, leads
oracle("lag_expression", with_q("""
SELECT entity, period,
  round(CASE WHEN qty > 0 THEN ln(qty) END, 6) AS lqty,
  qty - lag(qty) OVER w AS d_qty,
  (rev + lag(rev) OVER w + lag(rev, 2) OVER w) / 3 AS ma_rev
FROM q WINDOW w AS (PARTITION BY entity ORDER BY period)"""))

oracle("pct_change_4", with_q("""
SELECT entity, period,
  (qty / nullif(lag(qty, 4) OVER w, 0) - 1) * 100 AS qty_g4,
  (rev / nullif(lag(rev, 4) OVER w, 0) - 1) * 100 AS rev_g4
FROM q WINDOW w AS (PARTITION BY entity ORDER BY period)"""))

oracle("growth_to_level", with_q("""
SELECT entity, period,
  round(CASE WHEN period BETWEEN DATE '2000-01-01' AND DATE '2001-10-01'
             THEN CASE WHEN f IS NULL THEN NULL
                       ELSE anchor * product(f) OVER (PARTITION BY entity ORDER BY period
                                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END
             ELSE rev END, 6) AS rev
FROM (
  SELECT *, max(CASE WHEN period = DATE '1999-10-01' THEN rev END) OVER (PARTITION BY entity) AS anchor,
         CASE WHEN period BETWEEN DATE '2000-01-01' AND DATE '2001-10-01'
              THEN pow(g / 100.0 + 1.0, 0.25) END AS f
  FROM (SELECT *, (qty / nullif(lag(qty, 4) OVER (PARTITION BY entity ORDER BY period), 0) - 1) * 100 AS g
        FROM q))"""))

_LEADS = ",\n  ".join(
    f"CASE WHEN period = DATE '1998-01-01' THEN lead({c}, {k}) OVER w END AS {c}_{k}"
    for c in ("qty", "rev") for k in (1, 2, 3))
oracle("stack_leads", with_q(f"""
SELECT entity, period, qty, rev,
  {_LEADS}
FROM q WINDOW w AS (PARTITION BY entity ORDER BY period)"""))

oracle("unstack_leads", with_q("""
SELECT entity, period,
  CASE WHEN period BETWEEN DATE '1998-04-01' AND DATE '1998-10-01'
       THEN max(CASE WHEN period = DATE '1998-01-01' THEN 1 END) OVER (PARTITION BY entity) * 10 * qty_at
       ELSE qty END AS qty,
  CASE WHEN period BETWEEN DATE '1998-04-01' AND DATE '1998-10-01'
       THEN CASE WHEN max(CASE WHEN period = DATE '1998-01-01' THEN 1 END) OVER (PARTITION BY entity) = 1
                 THEN rev END
       ELSE rev END AS rev
FROM (SELECT *, qty AS qty_at FROM q)"""))

oracle("scalar_functions", with_q("""
SELECT entity, period,
  CAST(NULL AS DOUBLE) AS f_div0,
  rev / nullif(qty, 0) AS f_div,
  round(CASE WHEN qty - 200 >= 0 THEN pow(qty - 200, 0.5) END, 6) AS f_pow,
  round(CASE WHEN qty - 200 > 0 THEN ln(qty - 200) END, 6) AS f_log,
  round(exp(qty / 1000.0), 6) AS f_exp,
  abs(qty - 200) AS f_abs,
  CASE WHEN qty IS NULL OR rev IS NULL OR lag(qty) OVER w IS NULL THEN NULL
       ELSE greatest(qty, rev / 100.0, lag(qty) OVER w) END AS f_max,
  CASE WHEN qty IS NULL OR lag(qty) OVER w IS NULL THEN NULL
       ELSE least(qty, lag(qty) OVER w) END AS f_min,
  CASE WHEN qty - 200 > 0 THEN 0 ELSE 1 END AS f_ind,
  CASE WHEN qty - 200 > 0 THEN 1 ELSE 0 END AS f_heav,
  CASE WHEN qty > 300 THEN 1 WHEN qty > 100 THEN 2 END AS f_pw,
  -qty AS f_neg
FROM q WINDOW w AS (PARTITION BY entity ORDER BY period)"""))

# ---------------------------------------------------------------- recurrences
oracle("recurrence_ar1", "WITH RECURSIVE " + PANEL_Q.strip() + """,
r AS (
  SELECT entity, period, qty AS y FROM q WHERE period = DATE '1995-10-01'
  UNION ALL
  SELECT q.entity, q.period, 0.5 * r.y + 0.1 * q.qty
  FROM r JOIN q ON q.entity = r.entity AND q.period = CAST(r.period + INTERVAL 3 MONTH AS DATE))
SELECT q.entity, q.period, CASE WHEN q.period >= DATE '1996-01-01' THEN r.y ELSE q.qty END AS y
FROM q LEFT JOIN r ON r.entity = q.entity AND r.period = q.period""")

AR_LAGS = """
h AS (
  SELECT entity, period, qty, disc, lag(qty, 1) OVER w AS l1, lag(qty, 2) OVER w AS l2,
         lag(qty, 3) OVER w AS l3
  FROM q WINDOW w AS (PARTITION BY entity ORDER BY period))
"""

oracle("recurrence_ar_k", "WITH RECURSIVE " + PANEL_Q.strip() + "," + AR_LAGS + """,
r AS (
  SELECT entity, period, qty AS y1, l1 AS y2, l2 AS y3, l3 AS y4
  FROM h WHERE period = DATE '1995-10-01'
  UNION ALL
  SELECT q.entity, q.period, 0.5 * r.y1 + 0.2 * r.y2 + -q.disc * r.y4 + 0.1 * q.qty, r.y1, r.y2, r.y3
  FROM r JOIN q ON q.entity = r.entity AND q.period = CAST(r.period + INTERVAL 3 MONTH AS DATE))
SELECT q.entity, q.period,
       round(CASE WHEN q.period >= DATE '1996-01-01' THEN r.y1 ELSE q.qty END, 6) AS y
FROM q LEFT JOIN r ON r.entity = q.entity AND r.period = q.period""")

oracle("recurrence_general_k", "WITH RECURSIVE " + PANEL_Q.strip() + "," + AR_LAGS + """,
r AS (
  SELECT entity, period, qty AS y1, l1 AS y2 FROM h WHERE period = DATE '1995-10-01'
  UNION ALL
  SELECT q.entity, q.period,
         CASE WHEN r.y1 IS NOT NULL AND r.y2 IS NOT NULL AND q.qty IS NOT NULL
              THEN least(0.75 * r.y1 + 0.5 * r.y2, q.qty) END, r.y1
  FROM r JOIN q ON q.entity = r.entity AND q.period = CAST(r.period + INTERVAL 3 MONTH AS DATE))
SELECT q.entity, q.period, CASE WHEN q.period >= DATE '1996-01-01' THEN r.y1 ELSE q.qty END AS y
FROM q LEFT JOIN r ON r.entity = q.entity AND r.period = q.period""")

oracle("shock_decay", "WITH RECURSIVE " + PANEL_Q.strip() + """,
r AS (
  SELECT entity, period, qty AS x FROM q WHERE period = DATE '1998-10-01'
  UNION ALL
  SELECT q.entity, q.period, 0.5 * r.x
  FROM r JOIN q ON q.entity = r.entity AND q.period = CAST(r.period + INTERVAL 3 MONTH AS DATE))
SELECT q.entity, q.period, CASE WHEN q.period >= DATE '1999-01-01' THEN r.x ELSE q.qty END AS x
FROM q LEFT JOIN r ON r.entity = q.entity AND r.period = q.period""")

oracle("recurrence_general", "WITH RECURSIVE " + PANEL_Q.strip() + """,
r AS (
  SELECT entity, period, qty AS y FROM q WHERE period = DATE '1995-10-01'
  UNION ALL
  SELECT q.entity, q.period,
         CASE WHEN r.y IS NULL OR q.qty IS NULL THEN NULL ELSE least(1.05 * r.y, q.qty) END
  FROM r JOIN q ON q.entity = r.entity AND q.period = CAST(r.period + INTERVAL 3 MONTH AS DATE))
SELECT q.entity, q.period, CASE WHEN q.period >= DATE '1996-01-01' THEN r.y ELSE q.qty END AS y
FROM q LEFT JOIN r ON r.entity = q.entity AND r.period = q.period""")

# ---------------------------------------------------------------- trajectories, report
TRAJ = """
t AS (SELECT *, CASE WHEN (year(period) * 4 + quarter(period) - 1) % 3 = 0 THEN qty * 1.1 END AS qty_t FROM q)
"""

oracle("trajectory_mask", with_q("""
SELECT entity, period, coalesce(qty_t, 0.0) AS qty_t,
       CAST(qty_t IS NOT NULL AS INTEGER) AS qty_switch
FROM t""", TRAJ))

oracle("trajectory_override", with_q("""
SELECT entity, period, coalesce(qty_t, qty) AS qty, qty_t - qty AS rev_gap
FROM t""", TRAJ))

oracle("baseline_vs_scenario", with_q("""
SELECT entity, period, series, base AS base, sim AS sim, sim - base AS diff
FROM (
  SELECT b.entity, b.period, u.series, u.base, u.sim
  FROM g b JOIN gs s ON s.entity = b.entity AND s.period = b.period,
  LATERAL (VALUES ('qty', b.qty_g, s.qty_g), ('rev', b.rev_g, s.rev_g), ('disc', b.disc, s.disc))
    AS u(series, base, sim)
  WHERE b.period BETWEEN DATE '1999-07-01' AND DATE '2001-10-01')""", """
sim AS (
  SELECT entity, period,
    CASE WHEN period BETWEEN DATE '2000-01-01' AND DATE '2001-10-01' THEN qty * 1.1 ELSE qty END AS qty,
    rev,
    CASE WHEN period BETWEEN DATE '2000-01-01' AND DATE '2001-10-01' THEN disc + 0.01 ELSE disc END AS disc
  FROM q)""", """
g AS (
  SELECT entity, period, disc,
    (qty / nullif(lag(qty, 4) OVER w, 0) - 1) * 100 AS qty_g,
    (rev / nullif(lag(rev, 4) OVER w, 0) - 1) * 100 AS rev_g
  FROM q WINDOW w AS (PARTITION BY entity ORDER BY period))""", """
gs AS (
  SELECT entity, period, disc,
    (qty / nullif(lag(qty, 4) OVER w, 0) - 1) * 100 AS qty_g,
    (rev / nullif(lag(rev, 4) OVER w, 0) - 1) * 100 AS rev_g
  FROM sim WINDOW w AS (PARTITION BY entity ORDER BY period))"""))

# ---------------------------------------------------------------- residuals
RES = """
res AS (
  SELECT entity, period, qty, rev,
    CASE WHEN period BETWEEN DATE '1996-01-01' AND DATE '2001-10-01'
         THEN (CASE WHEN rev > 0 THEN ln(rev) END)
              - (0.8 * (CASE WHEN lag(rev) OVER w > 0 THEN ln(lag(rev) OVER w) END)
                 + 0.1 * (CASE WHEN qty > 0 THEN ln(qty) END))
         ELSE 0.0 END AS rev_trac,
    CASE WHEN period BETWEEN DATE '1996-01-01' AND DATE '2001-10-01'
         THEN qty - (lag(qty) OVER w / 3 + rev / 7000)
         ELSE 0.0 END AS qty_trac,
    CASE WHEN rev > 0 THEN ln(rev) END AS lhs_rev,
    0.8 * (CASE WHEN lag(rev) OVER w > 0 THEN ln(lag(rev) OVER w) END)
      + 0.1 * (CASE WHEN qty > 0 THEN ln(qty) END) AS rhs_rev,
    qty AS lhs_qty,
    lag(qty) OVER w / 3 + rev / 7000 AS rhs_qty
  FROM q WINDOW w AS (PARTITION BY entity ORDER BY period))
"""

oracle("tracking_residuals", with_q("""
SELECT entity, period, round(rev_trac, 6) AS rev_trac, qty_trac FROM res""", RES))

oracle("residual_closure", with_q("""
SELECT entity, period,
  abs(rhs_rev + rev_trac - lhs_rev) <= 1e-9 * greatest(1.0, abs(lhs_rev)) AS rev_closes,
  abs(rhs_qty + qty_trac - lhs_qty) <= 1e-9 * greatest(1.0, abs(lhs_qty)) AS qty_closes
FROM res""", RES))

oracle("residual_norm", with_q("""
SELECT entity, period, round(sqrt(pow(rhs_rev - lhs_rev, 2) + pow(rhs_qty - lhs_qty, 2)), 6) AS resid_norm
FROM res""", RES))

oracle("replaced_definitions", with_q("""
SELECT entity, period, round(rev_trac, 6) AS rev_trac,
       round(CASE WHEN period BETWEEN DATE '1996-01-01' AND DATE '2001-10-01'
                  THEN qty - (lag(qty, 2) OVER w / 7 + rev / 9000) ELSE 0.0 END, 6) AS qty_trac,
       round(CASE WHEN period BETWEEN DATE '1996-01-01' AND DATE '2001-10-01'
                  THEN rev - (lag(rev) OVER w / 3 + qty * 11) ELSE 0.0 END, 6) AS price_trac
FROM res WINDOW w AS (PARTITION BY entity ORDER BY period)""", RES))

oracle("domain_violations", with_q("""
SELECT entity, period, 'log_qty_less_200' AS expr, CAST(NULL AS DOUBLE) AS value
FROM q WHERE qty IS NOT NULL AND qty - 200 <= 0
UNION ALL
SELECT entity, period, 'rev_over_zero' AS expr, CAST(NULL AS DOUBLE) AS value
FROM q WHERE qty IS NOT NULL AND rev IS NOT NULL"""))

oracle("backtest_fanout", """
SELECT o_orderkey AS task_index, CAST(2004 + o_orderkey AS BIGINT) AS year,
       (4.0 * o_orderkey - 2.0 * (2004 + o_orderkey)) / -2.0 AS result_x0,
       (1.0 * (2004 + o_orderkey) - 3.0 * o_orderkey) / -2.0 AS result_x1
FROM orders""")

# ---------------------------------------------------------------- bootstrap
BOOT = [RES, """
hw AS (
  SELECT entity, period, qty_trac, rev_trac,
         row_number() OVER (PARTITION BY entity ORDER BY period) AS k
  FROM res WHERE period BETWEEN DATE '1996-01-01' AND DATE '1999-10-01')
""", """
acc AS (
  SELECT entity, k, coalesce(qty_trac, 0.0) AS sq, CAST(qty_trac IS NOT NULL AS INTEGER) AS nq,
         coalesce(rev_trac, 0.0) AS sr, CAST(rev_trac IS NOT NULL AS INTEGER) AS nr
  FROM hw WHERE k = 1
  UNION ALL
  SELECT a.entity, h.k, a.sq + coalesce(h.qty_trac, 0.0), a.nq + CAST(h.qty_trac IS NOT NULL AS INTEGER),
         a.sr + coalesce(h.rev_trac, 0.0), a.nr + CAST(h.rev_trac IS NOT NULL AS INTEGER)
  FROM acc a JOIN hw h ON h.entity = a.entity AND h.k = a.k + 1)
""", """
mean AS (
  SELECT entity, CASE WHEN nq > 0 THEN sq / nq END AS mq, CASE WHEN nr > 0 THEN sr / nr END AS mr
  FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY k DESC) AS last FROM acc)
  WHERE last = 1)
""", """
dm AS (
  SELECT h.entity, h.period, h.qty_trac - m.mq AS qty_trac, h.rev_trac - m.mr AS rev_trac
  FROM hw h JOIN mean m ON m.entity = h.entity)
""", """
sp AS (SELECT DISTINCT period FROM q WHERE period BETWEEN DATE '2000-01-01' AND DATE '2001-10-01')
""", """
mix AS (
  SELECT r.range AS repl, sp.period,
    (1234 * 7919 + r.range * 104729
     + CAST(year(sp.period) * 4 + quarter(sp.period) - 1 AS BIGINT) * 1299709) % 2147483647 AS x0
  FROM sp, range(202) r)
""", """
dr AS (
  SELECT CAST(repl AS INTEGER) AS repl, period,
    CAST(DATE '1996-01-01' + to_months(CAST(3 * ((((((x0 * x0 + 12345) % 2147483647)
         * ((x0 * x0 + 12345) % 2147483647)) + 67891) % 2147483647) % 16) AS INTEGER)) AS DATE)
      AS drawn_period
  FROM mix)
""", """
sh AS (
  SELECT b.entity, dr.repl, b.period,
         b.qty_trac + dm.qty_trac AS qty_trac, b.rev_trac + dm.rev_trac AS rev_trac
  FROM res b JOIN dr ON dr.period = b.period
  JOIN dm ON dm.entity = b.entity AND dm.period = dr.drawn_period
  WHERE b.period BETWEEN DATE '2000-01-01' AND DATE '2001-10-01')
""", """
init AS (SELECT entity, qty AS y FROM q WHERE period = DATE '1999-10-01')
"""]

PATHS = """
p AS (
  SELECT s.entity, s.repl, s.period, 0.5 * i.y + s.qty_trac AS y
  FROM sh s LEFT JOIN init i ON i.entity = s.entity
  WHERE s.period = DATE '2000-01-01'
  UNION ALL
  SELECT s.entity, s.repl, s.period, 0.5 * p.y + s.qty_trac
  FROM p JOIN sh s ON s.entity = p.entity AND s.repl = p.repl
                  AND s.period = CAST(p.period + INTERVAL 3 MONTH AS DATE))
"""

ERRS = """
e AS (
  SELECT entity, repl, period,
    CASE WHEN repl % 50 = 7 THEN NULL ELSE y END AS y,
    CASE WHEN repl % 50 = 7 THEN 'ValueError: replication failed to converge' END AS error
  FROM p)
"""


def with_boot(body: str, *extra: str, recursive: bool = False) -> str:
    ctes = ",\n".join([PANEL_Q.strip()] + [b.strip() for b in BOOT] + [e.strip() for e in extra])
    return "WITH RECURSIVE " + ctes + "\n" + body


oracle("demean_residuals", with_boot("""
SELECT entity, period, round(qty_trac, 6) AS qty_trac, round(rev_trac, 6) AS rev_trac FROM dm"""))

oracle("bootstrap_draws", with_boot("SELECT repl, period, drawn_period FROM dr"))

oracle("bootstrap_shocks", with_boot("""
SELECT entity, repl, period, round(qty_trac, 6) AS qty_trac, round(rev_trac, 6) AS rev_trac FROM sh"""))

oracle("bootstrap_paths", with_boot("""
SELECT entity, repl, period, round(y, 6) AS y FROM p""", PATHS, recursive=True))

oracle("bootstrap_errors", with_boot("""
SELECT entity, repl, period, round(y, 6) AS y, error FROM e""", PATHS, ERRS, recursive=True))

oracle("keep_good_replications", with_boot("""
SELECT e.entity, e.repl, e.period, round(e.y, 6) AS y, e.error
FROM e JOIN kept k ON k.repl = e.repl""", PATHS, ERRS, """
st AS (SELECT repl, max(error) AS error FROM e GROUP BY repl)""", """
st2 AS (
  SELECT *, row_number() OVER (PARTITION BY error IS NOT NULL ORDER BY repl) AS rf FROM st)""", """
rest AS (SELECT repl FROM st2 WHERE NOT (error IS NOT NULL AND rf <= 2))""", """
kept AS (SELECT repl FROM (SELECT repl, row_number() OVER (ORDER BY repl) AS rk FROM rest) WHERE rk <= 200)""",
    recursive=True))

oracle("keep_good_per_entity", with_boot("""
SELECT e.entity, e.repl, e.period, round(e.y, 6) AS y, e.error
FROM e JOIN kept k ON k.entity = e.entity AND k.repl = e.repl""", PATHS, """
e AS (
  SELECT entity, repl, period, CASE WHEN (repl + entity) % 50 = 7 THEN NULL ELSE y END AS y,
         CASE WHEN (repl + entity) % 50 = 7
              THEN 'ValueError: replication failed to converge' END AS error
  FROM p)""", """
st AS (SELECT entity, repl, max(error) AS error FROM e GROUP BY 1, 2)""", """
st2 AS (
  SELECT *, row_number() OVER (PARTITION BY entity, error IS NOT NULL ORDER BY repl) AS rf FROM st)""", """
rest AS (
  SELECT entity, repl, row_number() OVER (PARTITION BY entity ORDER BY repl) AS rk
  FROM st2 WHERE NOT (error IS NOT NULL AND rf <= 2))""", """
kept AS (SELECT entity, repl FROM rest WHERE rk <= 200)""",
    recursive=True))

oracle("quantile_fan", with_boot("""
SELECT f.entity, f.period, f.series, round(b.base, 6) AS base,
       round(f.lo90, 6) AS lo90, round(f.lo70, 6) AS lo70, round(f.hi70, 6) AS hi70,
       round(f.hi90, 6) AS hi90
FROM fan f LEFT JOIN bl b ON b.entity = f.entity AND b.period = f.period AND b.series = f.series
""", PATHS, """
pg AS (
  SELECT entity, repl, period, y,
         (y / nullif(lag(y, 4) OVER (PARTITION BY entity, repl ORDER BY period), 0) - 1) * 100 AS y_g4
  FROM p)""", """
lng AS (
  SELECT entity, period, 'y' AS series, y AS v FROM pg
  UNION ALL SELECT entity, period, 'y_g4' AS series, y_g4 AS v FROM pg)""", """
fan AS (
  SELECT entity, period, series,
    quantile_cont(v, 0.05) AS lo90, quantile_cont(v, 0.15) AS lo70,
    quantile_cont(v, 0.85) AS hi70, quantile_cont(v, 0.95) AS hi90
  FROM lng GROUP BY 1, 2, 3)""", """
bp AS (
  SELECT r.entity, r.period, 0.5 * i.y + r.qty_trac AS y
  FROM res r LEFT JOIN init i ON i.entity = r.entity WHERE r.period = DATE '2000-01-01'
  UNION ALL
  SELECT r.entity, r.period, 0.5 * bp.y + r.qty_trac
  FROM bp JOIN res r ON r.entity = bp.entity AND r.period = CAST(bp.period + INTERVAL 3 MONTH AS DATE))""",
    """
bl AS (
  SELECT entity, period, 'y' AS series, y AS base FROM bp
  UNION ALL
  SELECT entity, period, 'y_g4' AS series,
         (y / nullif(lag(y, 4) OVER (PARTITION BY entity ORDER BY period), 0) - 1) * 100 AS base
  FROM bp)""", recursive=True))

oracle("bootstrap_trim", with_boot("""
SELECT entity, repl, period, round(y, 6) AS y FROM (
  SELECT q.entity, CAST(r.range AS INTEGER) AS repl, q.period, q.qty AS y FROM q, range(202) r
  WHERE q.period < DATE '2000-01-01'
  UNION ALL
  SELECT entity, repl, period, y FROM p)
WHERE period BETWEEN DATE '1998-07-01' AND DATE '2001-10-01'""", PATHS, recursive=True))

# ---------------------------------------------------------------- sources
oracle("scan_union_by_name", """
SELECT o_orderkey, o_custkey,
  CASE WHEN year(o_orderdate) < 1998 THEN o_totalprice END AS o_totalprice,
  CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN year(o_orderdate) < 1998 THEN 'early' ELSE 'late' END AS series_id
FROM orders""")

oracle("series_from_filename", """
SELECT r_name AS series_id, n_nationkey, n_name
FROM nation JOIN region ON r_regionkey = n_regionkey""")

oracle("load_quarterly_csv", """
SELECT l_returnflag AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period,
       sum(l_quantity) AS qty, round(sum(l_extendedprice), 2) AS rev
FROM lineitem GROUP BY 1, 2""")

oracle("csv_by_year_roundtrip", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")

oracle("materialize_table", ORACLES["indicator_table"])

oracle("publish_swap", """
WITH c AS (SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal FROM customer)
SELECT id, nation, CAST(NULL AS DOUBLE) AS balance, 'after_failure' AS seen FROM c
UNION ALL SELECT id, nation, CAST(c_acctbal AS DOUBLE), 'current' FROM c
UNION ALL SELECT id, nation, CAST(NULL AS DOUBLE), 'before' FROM c""")

oracle("view_chain", """
WITH my_first_model AS (
  SELECT c_nationkey AS id FROM customer UNION ALL SELECT CAST(NULL AS INTEGER) AS id FROM nation)
SELECT * FROM my_first_model WHERE id = 1""")

# ---------------------------------------------------------------- checks
DOCS = """
dl AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""

oracle("null_audit", f"""
WITH {DOCS.strip()}
SELECT 'lang' AS "column", count(*) FILTER (WHERE lang IS NULL) AS n_null FROM dl
UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NULL) FROM dl
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM dl
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM dl""")

oracle("check_unique", """
SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1""")

oracle("check_not_null", f"""
WITH {DOCS.strip()}
SELECT doc_id FROM dl WHERE quality IS NULL""")

oracle("missing_series", """
SELECT name FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('refund')) v(name)
WHERE name NOT IN (SELECT event_type FROM events WHERE event_type IS NOT NULL)""")

# ---------------------------------------------------------------- catalogue
CAT = [r"""
cat AS (
  SELECT 'v' || p_partkey AS name, p_partkey AS k, p_size AS s, p_brand,
    CASE WHEN p_size % 5 = 0 THEN 'Exogenous' ELSE 'Behavioral' END AS equation_type,
    CASE WHEN p_size % 3 = 0 THEN 'NO' WHEN p_size % 3 = 1 THEN 'YES' END AS stochastic_type,
    CASE WHEN p_size % 5 <> 0 THEN
      'v' || p_partkey || ' - v' || p_partkey || '_aerr = y_v' || p_partkey || '_1 * '
      || lower(p_type) || '(-' || (p_size % 4) || ') + y_v' || p_partkey || '_2 * log('
      || lower(split_part(p_name, ' ', 1)) || ') + 0.5 * v' || (p_partkey // 2)
      || CASE WHEN p_size % 7 = 0 THEN ' + 0.1 * v' || (p_partkey * 4) ELSE '' END
      || CASE WHEN p_size % 3 > 0 THEN ' + ' || lower(split_part(p_name, ' ', 2)) || '(' || (p_size % 3) || ')' ELSE '' END
      || CASE WHEN p_size % 4 = 3 THEN ' + y_v' || p_partkey || '_3 * ' || lower(split_part(p_name, ' ', 2)) ELSE '' END
    END AS std_eq,
    p_retailprice / 1000 AS cf1, CAST(p_size AS DOUBLE) / 10.0 AS cf2,
    CASE WHEN p_size % 5 <> 0 THEN
      CASE WHEN p_size % 6 = 1 THEN 'mcap' WHEN p_size % 6 = 2 THEN 'mcwp' WHEN p_size % 6 = 4 THEN 'other' END
    END AS mce_group,
    'v' || p_partkey || ' = v' || p_partkey || '(1) + ' || lower(split_part(p_name, ' ', 1)) AS mce_eq
  FROM part)
""", r"""
eqs AS (SELECT name, k, regexp_replace(std_eq, '\s+', '', 'g') AS equation FROM cat WHERE std_eq IS NOT NULL)
""", r"""
tok0 AS (
  SELECT name, unnest(range(len(l))) AS pos, unnest(l) AS m
  FROM (SELECT name, regexp_extract_all(equation, '\b([a-z]\w+)(?:\((-?\d+)\))?', 0) AS l FROM eqs))
""", r"""
tok AS (
  SELECT name, CAST(pos AS INTEGER) AS pos, regexp_extract(m, '^([a-z]\w+)', 1) AS variable,
         coalesce(try_cast(regexp_extract(m, '\((-?\d+)\)$', 1) AS INTEGER), 0) AS "offset",
         regexp_full_match(regexp_extract(m, '^([a-z]\w+)', 1), 'y_\w+_\d+') AS is_coef
  FROM tok0
  WHERE regexp_extract(m, '^([a-z]\w+)', 1) NOT IN ('log', 'exp', 'max', 'min', 'abs', 'ind_ltezero'))
""", r"""
coefs AS (
  SELECT name, 'y_' || name || '_1' AS cf_name, cf1 AS cf_value FROM cat WHERE std_eq IS NOT NULL
  UNION ALL
  SELECT name, 'y_' || name || '_2' AS cf_name, cf2 AS cf_value FROM cat WHERE std_eq IS NOT NULL)
""", r"""
endo AS (SELECT name FROM cat WHERE std_eq IS NOT NULL)
""", r"""
edges AS (
  SELECT DISTINCT t.variable AS src, t.name AS dst FROM tok t
  WHERE t."offset" = 0 AND NOT t.is_coef AND t.variable <> t.name
    AND t.variable IN (SELECT name FROM endo))
"""]


def with_cat(body: str, *extra: str, recursive: bool = False) -> str:
    ctes = ",\n".join([c.strip() for c in CAT] + [e.strip() for e in extra])
    return ("WITH RECURSIVE " if recursive else "WITH ") + ctes + "\n" + body


oracle("catalog_scan", with_cat("""
SELECT name, equation_type, stochastic_type, std_eq AS python_equation,
       CASE WHEN std_eq IS NOT NULL THEN 2 END AS n_coeff, mce_group
FROM cat"""))

oracle("catalog_predicates", with_cat("""
SELECT 'endogenous' AS predicate, name FROM cat WHERE std_eq IS NOT NULL
UNION ALL SELECT 'exogenous', name FROM cat WHERE equation_type = 'Exogenous'
UNION ALL SELECT 'stochastic', name FROM cat WHERE stochastic_type <> 'NO'"""))

oracle("catalog_override", with_cat(r"""
SELECT coalesce(n.name, b.name) AS name, coalesce(n.equation, b.equation) AS equation,
       CASE WHEN n.equation IS NOT NULL THEN 'override' ELSE 'base' END AS source
FROM eqs b FULL OUTER JOIN (
  SELECT name, regexp_replace(mce_eq, '\s+', '', 'g') AS equation FROM cat
  WHERE mce_group IN ('mcap', 'mcwp')) n ON n.name = b.name"""))

oracle("catalog_coefficients", with_cat("SELECT name, cf_name, cf_value FROM coefs"))

oracle("missing_coefficients", with_cat("""
SELECT DISTINCT t.name, t.variable AS cf_name FROM tok t
WHERE t.is_coef AND t.variable NOT IN (SELECT cf_name FROM coefs)"""))

oracle("equation_tokens", with_cat("""SELECT name, pos, variable, "offset", is_coef FROM tok"""))

oracle("equation_edges", with_cat("SELECT src, dst FROM edges"))

oracle("equation_lead_profile", with_cat("""
SELECT name, greatest(max("offset"), 0) AS max_lead, bool_or("offset" > 0) AS has_leads
FROM tok GROUP BY name"""))

STACKED = """
st AS (
  SELECT t.name, CAST(sh.shift AS INTEGER) AS shift, t.pos,
    CASE WHEN t."offset" + sh.shift > 0 THEN t.variable || '_' || (t."offset" + sh.shift)
         ELSE t.variable END AS variable,
    CAST(CASE WHEN t."offset" + sh.shift > 0 THEN 0 ELSE t."offset" + sh.shift END AS INTEGER) AS "offset"
  FROM tok t, (SELECT unnest(range(1, 3)) AS shift) sh)
"""

oracle("stack_tokens", with_cat("""SELECT name, shift, pos, variable, "offset" FROM st""", STACKED))

oracle("split_lead_names", with_cat(r"""
SELECT DISTINCT variable AS name, regexp_matches(variable, '_\d+') AS is_lead FROM st""", STACKED))

oracle("equation_text_functions", with_cat(r"""
SELECT name, regexp_replace(std_eq, '\s+', '', 'g') AS clean,
  split_part(regexp_replace(std_eq, '\s+', '', 'g'), '=', 2) || '-('
    || split_part(regexp_replace(std_eq, '\s+', '', 'g'), '=', 1) || ')' AS flipped,
  name || '_trac' AS trac,
  name || '_trac_' || (s % 3) AS trac_lead,
  true AS size_is_number,
  try_cast(p_brand AS DOUBLE) IS NOT NULL AS brand_is_number
FROM cat WHERE std_eq IS NOT NULL"""))

oracle("prune_unused_series", with_cat("""
SELECT name FROM cat WHERE equation_type = 'Exogenous' AND name IN (SELECT variable FROM tok)"""))

oracle("new_input_series", with_cat(r"""
SELECT name, "order", pos FROM (
  SELECT name, "order", pos, row_number() OVER (PARTITION BY name ORDER BY "order", pos) AS rn
  FROM (
    SELECT k AS "order", CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS name
    FROM (SELECT k, string_split(trim(regexp_replace(equation, '[^\w]+', ' ', 'g')), ' ') AS w FROM eqs))
  WHERE name <> '' AND NOT regexp_matches(name, '^\d')
    AND name NOT IN ('log', 'exp', 'max', 'min', 'abs', 'ind_ltezero')
    AND name NOT IN (SELECT name FROM cat WHERE std_eq IS NOT NULL OR equation_type = 'Exogenous'))
WHERE rn = 1"""))

oracle("exogenize_catalog", with_cat("""
SELECT name, 'equation' AS kind FROM eqs
WHERE name NOT IN (SELECT name FROM cat WHERE p_brand = 'Brand#1' AND std_eq IS NOT NULL)
UNION ALL
SELECT DISTINCT name, 'input' AS kind FROM (
  SELECT name FROM cat WHERE equation_type = 'Exogenous'
  UNION SELECT name FROM cat WHERE p_brand = 'Brand#1' AND std_eq IS NOT NULL)"""))

# ---------------------------------------------------------------- graphs
REACH = """
reach AS (
  SELECT src, dst FROM edges
  UNION
  SELECT r.src, e.dst FROM reach r JOIN edges e ON e.src = r.dst)
""", """
comp AS (
  SELECT n.name AS node,
         least(n.name, coalesce((SELECT min(r.dst) FROM reach r
                                 WHERE r.src = n.name
                                   AND EXISTS (SELECT 1 FROM reach b WHERE b.src = r.dst AND b.dst = n.name)),
                                n.name)) AS comp
  FROM endo n)
""", """
csize AS (SELECT node, comp, count(*) OVER (PARTITION BY comp) AS size FROM comp)
""", """
blocked AS (
  SELECT src AS node FROM reach WHERE src = dst
  UNION SELECT r.dst FROM reach r WHERE r.src IN (SELECT src FROM reach WHERE src = dst))
""", """
dag AS (
  SELECT src, dst FROM edges
  WHERE src NOT IN (SELECT node FROM blocked) AND dst NOT IN (SELECT node FROM blocked))
""", """
depth AS (
  SELECT name AS node, 0 AS d FROM endo
  WHERE name NOT IN (SELECT node FROM blocked) AND name NOT IN (SELECT dst FROM edges)
  UNION
  SELECT e.dst, depth.d + 1 FROM depth JOIN dag e ON e.src = depth.node)
""", """
lvl AS (
  SELECT n.name AS node, CAST(max(depth.d) AS INTEGER) AS level
  FROM endo n LEFT JOIN depth ON depth.node = n.name GROUP BY n.name)
"""

oracle("in_degree", with_cat("""
SELECT n.name AS node, CAST(count(e.src) AS BIGINT) AS in_degree
FROM endo n LEFT JOIN edges e ON e.dst = n.name GROUP BY n.name"""))

oracle("topo_levels", with_cat("SELECT node, level FROM lvl", *REACH, recursive=True))

oracle("scc", with_cat("SELECT node, comp, size FROM csize WHERE size > 1", *REACH, recursive=True))

oracle("smallest_source_component", with_cat("""
SELECT node, comp, size FROM csize
WHERE comp = (
  SELECT arg_min(comp, size * 1000000000 + 0) FROM (
    SELECT DISTINCT c.comp, c.size FROM csize c
    WHERE c.size > 1 AND c.node IN (SELECT node FROM lvl WHERE level IS NULL)
      AND c.comp NOT IN (
        SELECT cd.comp FROM edges e
        JOIN csize cs ON cs.node = e.src JOIN csize cd ON cd.node = e.dst
        WHERE cs.comp <> cd.comp AND e.src IN (SELECT node FROM lvl WHERE level IS NULL))
    ORDER BY c.size, c.comp))""", *REACH, recursive=True))

oracle("block_order", with_cat("""
SELECT c.node, c.comp AS block, bl.level AS block_level, c.size > 1 AS simultaneous
FROM csize c JOIN bl ON bl.comp = c.comp""", *REACH, """
cedges AS (
  SELECT DISTINCT cs.comp AS src, cd.comp AS dst FROM edges e
  JOIN csize cs ON cs.node = e.src JOIN csize cd ON cd.node = e.dst WHERE cs.comp <> cd.comp)""", """
cdepth AS (
  SELECT DISTINCT comp, 0 AS d FROM csize WHERE comp NOT IN (SELECT dst FROM cedges)
  UNION
  SELECT e.dst, cdepth.d + 1 FROM cdepth JOIN cedges e ON e.src = cdepth.comp)""", """
bl AS (SELECT comp, CAST(max(d) AS INTEGER) AS level FROM cdepth GROUP BY comp)""",
    recursive=True))
