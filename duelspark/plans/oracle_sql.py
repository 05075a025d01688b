"""DuckDB text of the fixture views (FIXTURES.md part B, plus player names).

Every oracle in ``catalog.oracle_sql()`` starts with ``WITH`` + these CTEs, so
the check is an independent formulation: self-joins here, ``lead`` in Spark.
"""

CONTESTS_CTE = """
l AS (
  SELECT lineitem.*, p_type, p_size, o_orderpriority, o_orderstatus, s_name,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
           l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS rn
  FROM lineitem JOIN part ON l_partkey = p_partkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey
       JOIN orders ON l_orderkey = o_orderkey),
s AS (
  SELECT l_orderkey, rn, l_shipdate, l_linenumber, p_type, o_orderpriority, o_orderstatus, l_extendedprice,
         l_suppkey AS id, s_name AS nm, l_quantity AS q,
         CAST(l_quantity AS int) AS svpt,
         CAST(floor(l_quantity * 6 / 10) AS int) AS in1,
         CAST(floor(l_quantity * 4 / 10) AS int) AS won1,
         CAST(floor(l_quantity * 2 / 10) AS int) AS won2,
         CAST(round(l_tax * 100) AS int) AS bpf,
         CAST(floor(round(l_tax * 100) / 2) AS int) AS bps,
         CAST(round(l_discount * 100) AS int) AS ace,
         CAST(floor(l_quantity / 25) AS int) AS dfs,
         nullif(p_size % 13, 0) AS rnk,
         CASE WHEN p_size % 3 > 0 THEN p_size * 10 END AS pts,
         CAST(18 + l_suppkey % 20 AS double) AS age,
         CASE WHEN p_size % 7 > 0 THEN 160 + p_size END AS ht,
         CASE WHEN l_suppkey % 5 = 0 THEN 'L' WHEN l_suppkey % 7 = 0 THEN NULL
              WHEN l_suppkey % 11 = 0 THEN 'u' WHEN l_suppkey % 13 = 0 THEN 'A' ELSE 'R' END AS hand
  FROM l),
p AS (
  SELECT a.l_orderkey AS ok, a.rn AS arn, a.l_shipdate AS sd, a.l_linenumber AS ln, a.p_type AS pt,
         a.o_orderpriority AS pri, a.o_orderstatus AS st, a.q AS aq,
         a.l_extendedprice >= b.l_extendedprice AS awin, a.id AS aid, b.id AS bid
  FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND b.rn = a.rn + 1
  WHERE a.rn % 2 = 1 AND a.id <> b.id),
contests AS (
SELECT p.ok * 100 + p.arn AS contest_id,
       CAST(year(p.sd) * 10000 + month(p.sd) * 100 + day(p.sd) AS int) AS tourney_date,
       p.ok AS match_num,
       substr(p.pri, 1, 1) AS tourney_level,
       CASE WHEN p.st = 'P' THEN 'qual_chall' ELSE 'main' END AS match_source,
       p.pt AS surface,
       CASE p.ln WHEN 1 THEN 'R128' WHEN 2 THEN 'R64' WHEN 3 THEN 'R32' WHEN 4 THEN 'QF' WHEN 5 THEN 'F' WHEN 6 THEN 'RR' ELSE 'Q1' END AS round,
       CASE WHEN p.ln = 7 THEN NULL WHEN p.pri LIKE '1%' THEN 5 ELSE 3 END AS best_of,
       CASE WHEN p.aq = 50 THEN '6-4 ret' WHEN p.aq = 49 THEN 'W/O' WHEN p.aq = 48 THEN NULL ELSE '6-4 6-4' END AS score,
       w.id AS winner_id, l.id AS loser_id, w.nm AS winner_name, l.nm AS loser_name,
       w.rnk AS winner_rank, l.rnk AS loser_rank, w.pts AS winner_rank_points, l.pts AS loser_rank_points,
       w.age AS winner_age, l.age AS loser_age, w.ht AS winner_ht, l.ht AS loser_ht, w.hand AS winner_hand, l.hand AS loser_hand,
       w.svpt AS w_svpt, w.in1 AS w_1stIn, w.won1 AS w_1stWon, w.won2 AS w_2ndWon, w.bps AS w_bpSaved, w.bpf AS w_bpFaced, w.ace AS w_ace, w.dfs AS w_df,
       l.svpt AS l_svpt, l.in1 AS l_1stIn, l.won1 AS l_1stWon, l.won2 AS l_2ndWon, l.bps AS l_bpSaved, l.bpf AS l_bpFaced, l.ace AS l_ace, l.dfs AS l_df
FROM p
JOIN s w ON w.l_orderkey = p.ok AND w.rn = CASE WHEN p.awin THEN p.arn ELSE p.arn + 1 END
JOIN s l ON l.l_orderkey = p.ok AND l.rn = CASE WHEN p.awin THEN p.arn + 1 ELSE p.arn END)"""

RANKINGS_CTE = """
rankings AS (
SELECT DISTINCT l_suppkey AS player_id,
       CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS int) AS ranking_date,
       p_size AS rank,
       p_size * 100 AS points
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F' AND l_suppkey % 10 > 0)"""

PREDICTIONS_CTE = """
predictions AS (
SELECT contest_id, tourney_date, surface, tourney_level, round,
       CASE WHEN substr(md5(concat('42:', CAST(contest_id AS varchar))), 1, 1) < '8' THEN 1 ELSE 0 END AS target,
       CAST((w_svpt - l_svpt) * 8 AS double) AS elo_diff,
       w_ace / 10.0E0 AS lr_prob,
       (w_bpFaced + l_bpFaced) / 16.0E0 AS rf_prob,
       (w_svpt + l_svpt) / 100.0E0 AS xgb_prob
FROM contests WHERE match_source = 'main' AND tourney_level IN ('1', '2', '3'))"""


def with_views(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def contests_prefix() -> str:
    return with_views(CONTESTS_CTE)


def predictions_prefix() -> str:
    return with_views(CONTESTS_CTE, PREDICTIONS_CTE)


def _ratio_sql(side: str) -> str:
    s = side
    return f""",
    CASE WHEN {s}_svpt > 0 THEN {s}_1stIn / {s}_svpt END AS {s}_1st_serve_pct,
    CASE WHEN {s}_1stIn > 0 THEN {s}_1stWon / {s}_1stIn END AS {s}_1st_serve_win_pct,
    CASE WHEN {s}_svpt - {s}_1stIn > 0 THEN {s}_2ndWon / ({s}_svpt - {s}_1stIn) END AS {s}_2nd_serve_win_pct,
    CASE WHEN {s}_bpFaced > 0 THEN {s}_bpSaved / {s}_bpFaced END AS {s}_bp_saved_pct,
    CASE WHEN {s}_svpt > 0 THEN {s}_ace / {s}_svpt END AS {s}_ace_rate,
    CASE WHEN {s}_svpt > 0 THEN {s}_df / {s}_svpt END AS {s}_df_rate"""


CLEANED_CTE = """
cleaned AS (
  SELECT * FROM contests
  WHERE tourney_level IN ('1', '2', '3', '4')
    AND NOT (contains(upper(coalesce(score, '')), 'RET') OR contains(upper(coalesce(score, '')), 'W/O')
          OR contains(upper(coalesce(score, '')), 'DEF') OR contains(upper(coalesce(score, '')), 'ABN')
          OR contains(upper(coalesce(score, '')), 'WO'))
    AND winner_id IS NOT NULL AND loser_id IS NOT NULL AND winner_id <> loser_id
    AND try_strptime(CAST(tourney_date AS varchar), '%Y%m%d') IS NOT NULL)"""

RATIOS_CTE = "\nrat AS (SELECT *" + _ratio_sql("w") + _ratio_sql("l") + "\n  FROM cleaned)"

PREP_CTE = """
hmed AS (
  SELECT surface, quantile_disc(ht, 0.5) AS ht_median
  FROM (SELECT surface, CAST(winner_ht AS double) AS ht FROM rat
        UNION ALL SELECT surface, CAST(loser_ht AS double) AS ht FROM rat)
  WHERE ht IS NOT NULL GROUP BY surface),
prep AS (
  SELECT rat.* REPLACE (coalesce(winner_rank, 999) AS winner_rank, coalesce(loser_rank, 999) AS loser_rank,
                        coalesce(CAST(winner_ht AS double), ht_median) AS winner_ht,
                        coalesce(CAST(loser_ht AS double), ht_median) AS loser_ht)
  FROM rat LEFT JOIN hmed ON rat.surface = hmed.surface)"""

POOLED_CTE = """
pooled AS (
  SELECT * REPLACE (CASE WHEN surface IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO') THEN surface ELSE 'ECONOMY' END AS surface)
  FROM prep)"""

FIELDS = ("ace_rate", "df_rate", "1st_serve_pct", "1st_serve_win_pct", "2nd_serve_win_pct", "bp_saved_pct")


def _app_side(tag: str, full: str, won: str) -> str:
    ratios = ", ".join(f'{tag}_{f} AS "{f}"' for f in FIELDS)
    return (f"SELECT contest_id, tourney_date, match_num, surface, tourney_level, '{tag}' AS side, "
            f"{full}_id AS player_id, {won} AS won, "
            "CASE WHEN tourney_level = '1' THEN 1.5::double ELSE 1.0::double END AS wt, "
            "CAST(CAST(strptime(CAST(tourney_date AS varchar), '%Y%m%d') AS date) - DATE '1970-01-01' AS INTEGER) AS day, "
            f"{ratios} FROM pooled")


APP_CTE = ("\napp AS (\n  " + _app_side("w", "winner", "1.0::double") + "\n  UNION ALL\n  "
           + _app_side("l", "loser", "0.0::double") + ")")


def prep_prefix() -> str:
    return with_views(CONTESTS_CTE, CLEANED_CTE, RATIOS_CTE, PREP_CTE)


def app_prefix(*extra: str) -> str:
    return with_views(CONTESTS_CTE, CLEANED_CTE, RATIOS_CTE, PREP_CTE, POOLED_CTE, APP_CTE, *extra)

CONTEST_COLUMNS = (
    "contest_id", "tourney_date", "match_num", "tourney_level", "match_source", "surface", "round", "best_of",
    "score", "winner_id", "loser_id", "winner_name", "loser_name", "winner_rank", "loser_rank",
    "winner_rank_points", "loser_rank_points", "winner_age", "loser_age", "winner_ht", "loser_ht",
    "winner_hand", "loser_hand",
    *[f"{s}_{c}" for s in ("w", "l") for c in ("svpt", "1stIn", "1stWon", "2ndWon", "bpSaved", "bpFaced", "ace", "df")],
)
