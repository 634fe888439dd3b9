"""Independent DuckDB SQL for every SQL-checkable query key.

The SQL follows the reference's own formulation (windows with row_number,
self-joins, per-row lookups, brute-force candidate enumeration) rather than the
Spark operators' rewrites, so a match checks the rewrites too.  The fixture
views are repeated as CTEs over the driver's pre-registered tables.
"""

from __future__ import annotations

from pickwise.sources.views import HERO_POOL

# --- fixture views (FIXTURES.md §B) ----------------------------------------
VIEWS = {
    "pb": """SELECT DISTINCT l_orderkey AS match_id,
       CAST(l_partkey % 40 AS INTEGER) AS hero_id,
       CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS INTEGER) AS team,
       CAST(l_linenumber AS INTEGER) AS "order",
       l_returnflag <> 'R' AS is_pick
  FROM lineitem""",
    "md": """SELECT o_orderkey AS match_id,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS radiant_win,
       CAST(o_custkey % 40 AS INTEGER) AS radiant_score,
       CAST(floor(o_totalprice) % 40 AS INTEGER) AS dire_score,
       CAST(year(o_orderdate) - 1995 AS INTEGER) AS patch,
       CAST(year(o_orderdate) AS INTEGER) AS "year"
  FROM orders""",
    "dt": """SELECT l_orderkey AS match_id,
       l_returnflag <> 'R' AS pick,
       CAST(l_quantity AS INTEGER) AS total_time_taken,
       CAST(round(l_discount * 100) AS INTEGER) AS extra_time
  FROM lineitem""",
    "ev": """SELECT *, CAST(user_id * 31 + day(ts) AS BIGINT) AS mid FROM events""",
    "gold": """SELECT mid AS match_id, CAST(floor(hour(ts) / 2) AS INTEGER) AS minute,
       CAST(sum(CASE WHEN event_type IN ('click', 'view', 'purchase')
                     THEN CAST(round(value * 100) AS BIGINT)
                     ELSE -CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS gold
  FROM ev GROUP BY 1, 2""",
    "xp": """SELECT mid AS match_id, CAST(floor(hour(ts) / 2) AS INTEGER) AS minute,
       CAST(sum(CASE WHEN event_type IN ('click', 'signup')
                     THEN event_id % 997 ELSE -(event_id % 997) END) AS BIGINT) AS exp
  FROM ev GROUP BY 1, 2""",
    "obj": """SELECT mid AS match_id,
       CAST(hour(ts) * 30 + floor(minute(ts) / 2) AS INTEGER) AS time,
       CASE event_type WHEN 'error' THEN 'tower_kill' WHEN 'purchase' THEN 'TOWER_DENY'
            ELSE event_type END AS type
  FROM ev""",
    "tf": """SELECT mid AS match_id,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 10 AS INTEGER) AS start
  FROM ev""",
    "dr": """SELECT match_id AS draft_id, team, hero_id FROM pb WHERE is_pick AND team IN (0, 1)""",
    "nxt": """SELECT DISTINCT match_id AS draft_id, hero_id FROM pb WHERE hero_id IS NOT NULL AND team IN (0, 1)""",
    # score outcome rows (hero_win) of the recommender's statistics
    "hw": """SELECT pb.match_id, pb.team, pb.hero_id,
       CASE WHEN pb.team = 0 AND md.radiant_score > md.dire_score THEN 1
            WHEN pb.team = 1 AND md.dire_score > md.radiant_score THEN 1 ELSE 0 END AS hero_win
  FROM pb JOIN md ON pb.match_id = md.match_id""",
    "meta": """SELECT hero_id, count(*) AS pick_count, CAST(sum(hero_win) AS BIGINT) AS wins,
       CAST(CAST(sum(hero_win) / count(*) AS FLOAT) AS DOUBLE) AS win_rate,
       CAST(CAST(count(*) / (SELECT count(DISTINCT match_id) FROM hw) AS FLOAT) AS DOUBLE) AS pick_rate
  FROM hw GROUP BY hero_id""",
    "sy": """SELECT a.hero_id AS h1, b.hero_id AS h2, CAST(sum(a.hero_win) AS BIGINT) AS wins
  FROM hw a JOIN hw b ON a.match_id = b.match_id AND a.team = 0 AND b.team = 0 AND a.hero_id < b.hero_id
 GROUP BY 1, 2""",
    "cw": """SELECT d.hero_id AS counter_hero, r.hero_id AS target_hero, CAST(sum(d.hero_win) AS BIGINT) AS wins
  FROM hw r JOIN hw d ON r.match_id = d.match_id AND r.team = 0 AND d.team = 1
 WHERE r.hero_id IS NOT NULL AND d.hero_id IS NOT NULL
 GROUP BY 1, 2""",
    # pair win rates: sorted side lists, pairs i < j, games >= 10
    "sp": """SELECT pb.match_id, pb.team, pb.hero_id,
       CASE WHEN (pb.team = 0 AND md.radiant_win = TRUE) OR (pb.team = 1 AND md.radiant_win = FALSE)
            THEN 1 ELSE 0 END AS won,
       row_number() OVER (PARTITION BY pb.match_id, pb.team ORDER BY pb.hero_id) AS rn
  FROM pb JOIN md ON pb.match_id = md.match_id
 WHERE pb.is_pick AND pb.hero_id IS NOT NULL""",
    "st": """SELECT a.hero_id AS hero1, b.hero_id AS hero2, count(*) AS games,
       CAST(sum(a.won) AS BIGINT) AS wins, sum(a.won) / count(*) AS win_rate
  FROM sp a JOIN sp b ON a.match_id = b.match_id AND a.team = b.team AND a.rn < b.rn
 GROUP BY 1, 2 HAVING count(*) >= 10""",
    "tl": """SELECT match_id, team, hero_id,
       row_number() OVER (PARTITION BY match_id, team ORDER BY hero_id) AS rn
  FROM pb WHERE is_pick AND hero_id IS NOT NULL AND team IN (0, 1)""",
    "ps": """SELECT a.match_id, a.team, avg(st.win_rate) AS syn
  FROM tl a JOIN tl b ON a.match_id = b.match_id AND a.team = b.team AND a.rn < b.rn
  JOIN st ON st.hero1 = a.hero_id AND st.hero2 = b.hero_id
 GROUP BY 1, 2""",
    "msyn": """SELECT m.match_id,
       coalesce(r.syn, CAST(0.5 AS DOUBLE)) AS radiant_synergy,
       coalesce(d.syn, CAST(0.5 AS DOUBLE)) AS dire_synergy
  FROM (SELECT DISTINCT match_id FROM pb) m
  LEFT JOIN ps r ON r.match_id = m.match_id AND r.team = 0
  LEFT JOIN ps d ON d.match_id = m.match_id AND d.team = 1""",
}

SERIES_CTE = """{name}_e AS (SELECT * FROM {src} WHERE minute <= 10),
{name}_o AS (SELECT match_id, {v},
       row_number() OVER (PARTITION BY match_id ORDER BY minute) AS ra,
       row_number() OVER (PARTITION BY match_id ORDER BY minute DESC) AS rd
  FROM {name}_e),
{name}_f AS (SELECT e.match_id,
       max(CASE WHEN minute = 10 THEN {v} END) AS {v}_at_10min,
       max({v}) AS {v}_max_10min, min({v}) AS {v}_min_10min,
       avg({v}) AS {v}_avg_10min, stddev_samp({v}) AS {v}_volatility_10min,
       count(*) AS {v}_samples,
       coalesce(max(fl.last_v) - max(fl.first_v), 0) AS {v}_trend_10min
  FROM {name}_e e JOIN (SELECT match_id, max(CASE WHEN ra = 1 THEN {v} END) AS first_v,
                               max(CASE WHEN rd = 1 THEN {v} END) AS last_v
                          FROM {name}_o GROUP BY match_id) fl ON fl.match_id = e.match_id
 GROUP BY e.match_id)"""

EXTRA = {
    "ge": SERIES_CTE.format(name="ge", src="gold", v="gold"),
    "xe": SERIES_CTE.format(name="xe", src="xp", v="exp"),
    "oe": """oe AS (SELECT match_id, count(*) AS early_objective_count,
       CAST(sum(CASE WHEN type LIKE '%tower%' THEN 1 ELSE 0 END) AS BIGINT) AS tower_kills_10min
  FROM obj WHERE time / 60 <= 10 GROUP BY match_id)""",
    "te": """te AS (SELECT match_id, count(*) AS teamfights_count_10min
  FROM tf WHERE start / 60 <= 10 GROUP BY match_id)""",
    "dc": """dc AS (SELECT match_id,
       CAST(sum(CASE WHEN team = 0 THEN 1 ELSE 0 END) AS BIGINT) AS radiant_picks,
       CAST(sum(CASE WHEN team = 1 THEN 1 ELSE 0 END) AS BIGINT) AS dire_picks
  FROM pb WHERE is_pick GROUP BY match_id)""",
    "ef": """ef AS (SELECT md.match_id,
       CASE WHEN CAST(md.radiant_win AS VARCHAR) IN ('True', '1', 'true') THEN 1 ELSE 0 END AS label,
       coalesce(md.patch, 0) AS patch,
       coalesce(dc.radiant_picks, 0) AS radiant_picks, coalesce(dc.dire_picks, 0) AS dire_picks,
       coalesce(gold_at_10min, 0) AS gold_at_10min, coalesce(gold_max_10min, 0) AS gold_max_10min,
       coalesce(gold_min_10min, 0) AS gold_min_10min, coalesce(gold_avg_10min, 0) AS gold_avg_10min,
       coalesce(gold_volatility_10min, 0) AS gold_volatility_10min,
       coalesce(gold_samples, 0) AS gold_samples, coalesce(gold_trend_10min, 0) AS gold_trend_10min,
       coalesce(exp_at_10min, 0) AS exp_at_10min, coalesce(exp_max_10min, 0) AS exp_max_10min,
       coalesce(exp_min_10min, 0) AS exp_min_10min, coalesce(exp_avg_10min, 0) AS exp_avg_10min,
       coalesce(exp_volatility_10min, 0) AS exp_volatility_10min,
       coalesce(exp_samples, 0) AS exp_samples, coalesce(exp_trend_10min, 0) AS exp_trend_10min,
       coalesce(early_objective_count, 0) AS early_objective_count,
       coalesce(tower_kills_10min, 0) AS tower_kills_10min,
       coalesce(teamfights_count_10min, 0) AS teamfights_count_10min,
       CASE WHEN coalesce(gold_at_10min, 0) > 0 AND coalesce(exp_at_10min, 0) > 0 THEN 1 ELSE 0 END
         AS is_radiant_ahead,
       CAST(coalesce(gold_at_10min, 0) AS DOUBLE) / 1000 + CAST(coalesce(exp_at_10min, 0) AS DOUBLE) / 1000
         AS combined_advantage
  FROM md LEFT JOIN dc ON dc.match_id = md.match_id
  LEFT JOIN ge_f ON ge_f.match_id = md.match_id
  LEFT JOIN xe_f ON xe_f.match_id = md.match_id
  LEFT JOIN oe ON oe.match_id = md.match_id
  LEFT JOIN te ON te.match_id = md.match_id)""",
}

EARLY_FEATURES = [
    "radiant_picks", "dire_picks",
    "gold_at_10min", "gold_max_10min", "gold_min_10min", "gold_avg_10min",
    "gold_volatility_10min", "gold_samples", "gold_trend_10min",
    "exp_at_10min", "exp_max_10min", "exp_min_10min", "exp_avg_10min",
    "exp_volatility_10min", "exp_samples", "exp_trend_10min",
    "early_objective_count", "tower_kills_10min", "teamfights_count_10min",
    "is_radiant_ahead", "combined_advantage",
]
ROUNDED_EARLY = {"gold_avg_10min": 6, "gold_volatility_10min": 6, "exp_avg_10min": 6, "exp_volatility_10min": 6}


def with_views(*names: str) -> str:
    """WITH clause holding the named views (dependencies first, in VIEWS order)."""
    deps = {
        "gold": ["ev"], "xp": ["ev"], "obj": ["ev"], "tf": ["ev"], "dr": ["pb"], "nxt": ["pb"],
        "hw": ["pb", "md"], "meta": ["hw"], "sy": ["hw"], "cw": ["hw"], "sp": ["pb", "md"],
        "st": ["sp"], "tl": ["pb"], "ps": ["tl", "st"], "msyn": ["ps", "pb"],
        "ge": ["gold"], "xe": ["xp"], "oe": ["obj"], "te": ["tf"], "dc": ["pb"],
        "ef": ["md", "dc", "ge", "xe", "oe", "te"],
    }
    need: list[str] = []

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n]})" if n in VIEWS else EXTRA[n] for n in need]
    return "WITH " + ",\n".join(parts) + "\n"


def _early_select(prefix: str = "") -> str:
    cols = []
    for c in ["label", "patch"] + EARLY_FEATURES:
        cols.append(f"round({prefix}{c}, {ROUNDED_EARLY[c]}) AS {c}" if c in ROUNDED_EARLY else f"{prefix}{c}")
    return ", ".join(cols)


def onehot_sql(hero_ids=range(HERO_POOL)) -> str:
    cols = []
    for kind, flag in (("pick", "TRUE"), ("ban", "FALSE")):
        for team, side in ((0, "radiant"), (1, "dire")):
            for h in hero_ids:
                cols.append(
                    f"max(CASE WHEN is_pick = {flag} AND team = {team} AND hero_id = {h} THEN 1 ELSE 0 END) AS {side}_{kind}_{h}"
                )
    return "SELECT match_id, " + ",\n  ".join(cols) + "\nFROM pb WHERE is_pick IS NOT NULL AND team IN (0, 1) GROUP BY match_id"


PICK_ORDER = """po AS (SELECT match_id, team, hero_id,
       row_number() OVER (PARTITION BY match_id, team ORDER BY "order", hero_id) AS k,
       count(*) OVER (PARTITION BY match_id, team) AS n
  FROM pb WHERE is_pick AND team IN (0, 1)),
pos AS (SELECT match_id, team, avg(k) AS apo,
       max(CASE WHEN k = 1 THEN hero_id END) AS fp, max(CASE WHEN k = n THEN hero_id END) AS lp
  FROM po GROUP BY 1, 2),
pof AS (SELECT m.match_id,
       coalesce(r.apo, 0) AS radiant_avg_pick_order, CAST(coalesce(r.fp, 0) AS INTEGER) AS radiant_first_pick,
       CAST(coalesce(r.lp, 0) AS INTEGER) AS radiant_last_pick,
       coalesce(d.apo, 0) AS dire_avg_pick_order, CAST(coalesce(d.fp, 0) AS INTEGER) AS dire_first_pick,
       CAST(coalesce(d.lp, 0) AS INTEGER) AS dire_last_pick
  FROM (SELECT DISTINCT match_id FROM pos) m
  LEFT JOIN pos r ON r.match_id = m.match_id AND r.team = 0
  LEFT JOIN pos d ON d.match_id = m.match_id AND d.team = 1)"""

TIMING = """tm AS (SELECT match_id, avg(total_time_taken) AS avg_pick_time,
       max(total_time_taken) AS max_pick_time, min(total_time_taken) AS min_pick_time,
       coalesce(stddev_samp(total_time_taken), 0) AS std_pick_time,
       CAST(sum(extra_time) AS BIGINT) AS total_extra_time
  FROM dt WHERE pick GROUP BY match_id)"""

SCORE_CANDIDATES = """ms AS (SELECT hero_id,
       round(0.7 * coalesce(win_rate, 0.5) + 0.3 * coalesce(pick_rate, 0.05), 12) AS meta_score
  FROM meta WHERE hero_id IS NOT NULL),
syn AS (SELECT h1 AS cand, h2 AS other, CAST(wins AS DOUBLE) AS wins FROM sy
        UNION ALL SELECT h2, h1, CAST(wins AS DOUBLE) FROM sy),
ctr AS (SELECT counter_hero AS cand, target_hero AS other, CAST(wins AS DOUBLE) AS wins FROM cw),
sizes AS (SELECT draft_id, count(*) FILTER (WHERE team = 0) AS n_ally,
                 count(*) FILTER (WHERE team = 1) AS n_enemy FROM dr GROUP BY draft_id),
ss AS (SELECT c.draft_id, c.hero_id, sum(coalesce(syn.wins, 0)) AS syn_sum
         FROM cand c JOIN dr ON dr.draft_id = c.draft_id AND dr.team = 0
         LEFT JOIN syn ON syn.cand = c.hero_id AND syn.other = dr.hero_id GROUP BY 1, 2),
cs AS (SELECT c.draft_id, c.hero_id, sum(coalesce(ctr.wins, 0)) AS ctr_sum
         FROM cand c JOIN dr ON dr.draft_id = c.draft_id AND dr.team = 1
         LEFT JOIN ctr ON ctr.cand = c.hero_id AND ctr.other = dr.hero_id GROUP BY 1, 2),
sc AS (SELECT c.draft_id, c.hero_id,
       (coalesce(ss.syn_sum, 0) + 1) / (coalesce(z.n_ally, 0) + 2) AS synergy_score,
       (coalesce(cs.ctr_sum, 0) + 1) / (coalesce(z.n_enemy, 0) + 2) AS counter_score,
       coalesce(ms.meta_score, 0.5) AS meta_score
  FROM cand c LEFT JOIN ss ON ss.draft_id = c.draft_id AND ss.hero_id = c.hero_id
  LEFT JOIN cs ON cs.draft_id = c.draft_id AND cs.hero_id = c.hero_id
  LEFT JOIN sizes z ON z.draft_id = c.draft_id
  LEFT JOIN ms ON ms.hero_id = c.hero_id),
fs AS (SELECT *, 0.4 * synergy_score + 0.4 * counter_score + 0.2 * meta_score AS score FROM sc)"""


def _scored(extra_cte: str) -> str:
    return with_views("dr", "meta", "sy", "cw", "nxt")[:-1] + ",\n" + extra_cte + ",\n" + SCORE_CANDIDATES + "\n"


def _bands(p: str) -> str:
    """Confidence and advice; the advice texts are the fixed values of functions/exprs.py, repeated to check them."""
    return """CASE WHEN p > 0.65 THEN 'strong' WHEN p > 0.55 THEN 'slight' WHEN p > 0.45 THEN 'slight'
            WHEN p > 0.35 THEN 'strong' ELSE 'very strong' END AS confidence,
       CASE WHEN p > 0.65 THEN 'Radiant should maintain aggressive tempo and secure objectives. Dire needs successful ganks to stabilize.'
            WHEN p > 0.55 THEN 'Game is balanced. Both teams should focus on objective control and avoid mistakes.'
            WHEN p > 0.45 THEN 'Game is even. Next teamfight will be crucial in determining momentum.'
            WHEN p > 0.35 THEN 'Dire has advantage. Radiant needs to avoid fights and farm defensively. Dire should press advantage.'
            ELSE 'Dire has commanding lead. Radiant should defend high ground and look for comeback opportunities.' END
         AS recommendation""".replace("p > 0", f"{p} > 0")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["hero_meta"] = with_views("meta") + "SELECT * FROM meta"
    q["pair_synergy_wins"] = with_views("sy") + "SELECT * FROM sy"
    q["counter_wins"] = with_views("cw") + "SELECT * FROM cw"
    q["recommend_topk"] = _scored(
        """cand AS (SELECT z.draft_id, m.hero_id FROM (SELECT DISTINCT draft_id FROM dr) z
                CROSS JOIN (SELECT hero_id FROM meta WHERE hero_id IS NOT NULL) m
               WHERE NOT EXISTS (SELECT 1 FROM dr u WHERE u.draft_id = z.draft_id AND u.hero_id = m.hero_id))"""
    ) + """SELECT draft_id, CAST(rnk AS INTEGER) AS rank, hero_id, round(score, 9) AS score,
       round(synergy_score, 9) AS synergy_score, round(counter_score, 9) AS counter_score,
       round(meta_score, 9) AS meta_score
  FROM (SELECT *, row_number() OVER (PARTITION BY draft_id ORDER BY score DESC, hero_id) AS rnk
          FROM fs) WHERE rnk <= 3"""
    q["hero_score"] = _scored("cand AS (SELECT DISTINCT draft_id, hero_id FROM nxt)") + """SELECT draft_id, hero_id,
       round(score, 9) AS score, round(synergy_score, 9) AS synergy_score,
       round(counter_score, 9) AS counter_score, round(meta_score, 9) AS meta_score FROM fs"""
    q["dedupe_matches"] = with_views("dt") + """SELECT match_id, s.pick AS pick, s.t AS total_time_taken, s.e AS extra_time
  FROM (SELECT match_id, max({'pick': pick, 't': total_time_taken, 'e': extra_time}) AS s FROM dt GROUP BY match_id)"""
    q["match_label"] = with_views("md") + (
        "SELECT match_id, CASE WHEN radiant_win = TRUE THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label FROM md"
    )
    q["match_label_text"] = with_views("md") + (
        "SELECT match_id, CASE WHEN CAST(radiant_win AS VARCHAR) IN ('True', '1', 'true') THEN 1 ELSE 0 END AS label FROM md"
    )
    q["label_from_scores"] = with_views("md") + """SELECT match_id,
       CASE WHEN radiant_score > dire_score THEN 1 ELSE 0 END AS radiant_win,
       CASE WHEN dire_score > radiant_score THEN 1 ELSE 0 END AS dire_win FROM md"""
    q["label_distribution"] = with_views("md") + """SELECT label, count(*) AS count FROM (
  SELECT CASE WHEN radiant_win = TRUE THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label FROM md)
 GROUP BY label"""
    q["hero_vocabulary"] = with_views("pb") + "SELECT DISTINCT hero_id FROM pb WHERE hero_id IS NOT NULL"
    q["hero_onehot"] = with_views("pb") + onehot_sql()
    q["pick_order"] = with_views("pb")[:-1] + ",\n" + PICK_ORDER + "\nSELECT * FROM pof"
    q["draft_counts"] = with_views("dc") + "SELECT * FROM dc"
    q["draft_timing"] = with_views("dt")[:-1] + ",\n" + TIMING + """
SELECT match_id, avg_pick_time, max_pick_time, min_pick_time, round(std_pick_time, 6) AS std_pick_time,
       total_extra_time FROM tm"""
    q["patch_feature"] = with_views("pb", "md") + """SELECT b.match_id, coalesce(md.patch, 0) AS patch,
       coalesce(md."year", 2020) AS patch_year
  FROM (SELECT DISTINCT match_id FROM pb) b LEFT JOIN md ON md.match_id = b.match_id"""
    q["team_heroes"] = with_views("pb") + """SELECT match_id, team,
       string_agg(CAST(hero_id AS VARCHAR), ',' ORDER BY hero_id) AS heroes, count(*) AS n_heroes
  FROM pb WHERE is_pick AND hero_id IS NOT NULL GROUP BY 1, 2"""
    q["team_pairs"] = with_views("pb") + """, p AS (SELECT match_id, team, hero_id,
       row_number() OVER (PARTITION BY match_id, team ORDER BY hero_id) AS rn
  FROM pb WHERE is_pick AND hero_id IS NOT NULL)
SELECT a.match_id, a.team, a.hero_id AS hero1, b.hero_id AS hero2, count(*) AS pairs
  FROM p a JOIN p b ON a.match_id = b.match_id AND a.team = b.team AND a.rn < b.rn
 GROUP BY 1, 2, 3, 4"""
    q["team_pairs"] = q["team_pairs"].replace("\n, p AS", ",\np AS").replace("FROM lineitem)\n,", "FROM lineitem),")
    q["pair_synergy_winrate"] = with_views("st") + "SELECT * FROM st"
    q["match_synergy"] = with_views("msyn") + """SELECT match_id, round(radiant_synergy, 6) AS radiant_synergy,
       round(dire_synergy, 6) AS dire_synergy, round(radiant_synergy - dire_synergy, 6) AS synergy_diff FROM msyn"""
    for name, cte, v in (("series_gold_early", "ge", "gold"), ("series_exp_early", "xe", "exp")):
        q[name] = with_views(cte) + f"""SELECT match_id, {v}_at_10min, {v}_max_10min, {v}_min_10min,
       round({v}_avg_10min, 6) AS {v}_avg_10min, round({v}_volatility_10min, 6) AS {v}_volatility_10min,
       {v}_samples, {v}_trend_10min FROM {cte}_f"""
    q["series_trend"] = with_views("gold") + """, o AS (SELECT match_id, minute, gold,
       row_number() OVER (PARTITION BY match_id ORDER BY minute) AS ra,
       row_number() OVER (PARTITION BY match_id ORDER BY minute DESC) AS rd
  FROM gold WHERE minute <= 10)
SELECT match_id,
       max(CASE WHEN ra = 1 THEN minute END) AS first_minute, max(CASE WHEN ra = 1 THEN gold END) AS first_value,
       max(CASE WHEN rd = 1 THEN minute END) AS last_minute, max(CASE WHEN rd = 1 THEN gold END) AS last_value,
       coalesce(max(CASE WHEN rd = 1 THEN gold END) - max(CASE WHEN ra = 1 THEN gold END), 0) AS trend
  FROM o GROUP BY match_id"""
    q["series_trend"] = q["series_trend"].replace("\n, o AS", ",\no AS")
    q["objectives_early"] = with_views("oe") + "SELECT * FROM oe"
    q["teamfights_early"] = with_views("te") + "SELECT * FROM te"
    q["early_features"] = with_views("ef") + f"SELECT match_id, {_early_select()} FROM ef"
    q["draft_features"] = draft_features_sql()
    q["split_keyed"] = with_views("md") + "SELECT match_id, (((match_id % 100 + 100) % 100 * 7919 + 42) % 100) < 80 AS is_train FROM md"
    scaled = ", ".join(
        f"round(CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 0 ELSE {c} * (1.0 / s_{c}) END, 6) AS {c}" for c in EARLY_FEATURES
    )
    stds = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in EARLY_FEATURES)
    q["scaled_features"] = with_views("ef") + f""", sd AS (SELECT {stds} FROM ef
  WHERE ((match_id * 7919 + 42) % 100) < 80)
SELECT match_id, {scaled} FROM ef, sd"""
    q["scaled_features"] = q["scaled_features"].replace("\n, sd AS", ",\nsd AS")
    q["eval_auc"] = with_views("ef") + """, g AS (SELECT combined_advantage AS score, sum(label) AS pos,
       count(*) - sum(label) AS neg FROM ef GROUP BY 1),
c AS (SELECT score, pos, neg,
       coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM g)
SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS auc,
       CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM c"""
    q["eval_auc"] = q["eval_auc"].replace("\n, g AS", ",\ng AS")
    q["confusion_matrix"] = with_views("ef") + """SELECT CAST(label AS DOUBLE) AS label,
       CAST(is_radiant_ahead AS DOUBLE) AS prediction, count(*) AS count FROM ef GROUP BY 1, 2"""
    q["eval_prf"] = with_views("ef") + """, cm AS (SELECT CAST(label AS DOUBLE) AS label, CAST(is_radiant_ahead AS DOUBLE) AS prediction,
       count(*) AS n FROM ef GROUP BY 1, 2),
tot AS (SELECT sum(n) AS total FROM cm),
lab AS (SELECT label AS c, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
  FROM cm GROUP BY 1),
prd AS (SELECT prediction AS c, sum(n) AS predicted FROM cm GROUP BY 1),
pc AS (SELECT lab.c, support, tp,
       CASE WHEN coalesce(predicted, 0) = 0 THEN 0 ELSE tp / predicted END AS p,
       CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r
  FROM lab LEFT JOIN prd ON prd.c = lab.c)
SELECT round(sum(tp) / max(total), 9) AS accuracy,
       round(sum(p * support) / max(total), 9) AS weighted_precision,
       round(sum(r * support) / max(total), 9) AS weighted_recall,
       round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * support) / max(total), 9) AS weighted_f1
  FROM pc, tot"""
    q["eval_prf"] = q["eval_prf"].replace("\n, cm AS", ",\ncm AS")
    q["prediction_bands"] = with_views("ef") + """, pr AS (SELECT match_id, round(1 / (1 + exp(-combined_advantage / 10)), 6) AS p FROM ef)
SELECT match_id, p AS radiant_win_probability,
       CASE WHEN p > 0.5 THEN 'Radiant' ELSE 'Dire' END AS predicted_winner,
       CASE WHEN p > 0.5 THEN p ELSE 1 - p END AS predicted_probability,
       """ + _bands("p") + """
  FROM pr"""
    q["prediction_bands"] = q["prediction_bands"].replace("\n, pr AS", ",\npr AS")
    # file sources and sinks: the loaded files must equal the views they were written from
    q["src_yearly_union"] = with_views("pb", "md") + """SELECT pb.is_pick, pb.hero_id, pb.team,
       CASE WHEN md."year" = 1997 THEN NULL ELSE pb."order" END AS "order", pb.match_id,
       CAST(NULL AS BIGINT) AS leagueid, md."year" AS "year"
  FROM pb JOIN md ON pb.match_id = md.match_id"""
    q["src_yearly_optional"] = with_views("md") + """SELECT match_id, CAST(radiant_win AS VARCHAR) AS radiant_win,
       CASE WHEN "year" = 1999 THEN NULL ELSE patch END AS patch, "year" FROM md"""
    q["src_yearly_defaults"] = with_views("dt", "md") + """SELECT dt.match_id, dt.pick,
       CAST(dt.total_time_taken AS DOUBLE) AS total_time_taken,
       CASE WHEN md."year" = 1996 THEN CAST(0 AS DOUBLE) ELSE CAST(dt.extra_time AS DOUBLE) END AS extra_time,
       md."year" AS "year"
  FROM dt JOIN md ON dt.match_id = md.match_id WHERE md."year" <> 1998"""
    q["src_row_audit"] = with_views("pb", "dt", "md") + """SELECT 'picks_bans' AS source, md."year" AS "year", count(*) AS rows
  FROM pb JOIN md ON pb.match_id = md.match_id GROUP BY 2
UNION ALL
SELECT 'draft_timings' AS source, md."year" AS "year", count(*) AS rows
  FROM dt JOIN md ON dt.match_id = md.match_id WHERE md."year" <> 1998 GROUP BY 2"""
    q["src_csv"] = with_views("md") + "SELECT * FROM md"
    q["src_csv_dropmalformed"] = with_views("gold") + "SELECT * FROM gold"
    q["src_json_corrupt"] = with_views("tf") + "SELECT * FROM tf"
    zero = {"early_objective_count", "tower_kills_10min", "teamfights_count_10min"}
    cols = []
    for c in ["label", "patch"] + EARLY_FEATURES:
        if c in zero:
            cols.append(f"CAST(0 AS BIGINT) AS {c}")
        elif c in ROUNDED_EARLY:
            cols.append(f"round({c}, {ROUNDED_EARLY[c]}) AS {c}")
        else:
            cols.append(c)
    q["src_optional"] = with_views("ef") + f"SELECT match_id, {', '.join(cols)} FROM ef"
    q["src_csv_reordered"] = with_views("pb") + 'SELECT match_id, hero_id, team, "order", is_pick, CAST(NULL AS BIGINT) AS leagueid FROM pb'
    q["src_text_label"] = q["match_label_text"]
    q["hero_meta_dup"], q["pair_synergy_winrate_dup"], q["draft_features_dup"] = q["hero_meta"], q["pair_synergy_winrate"], q["draft_features"]
    q["hero_onehot_sparse"] = with_views("pb") + """SELECT match_id, coalesce(string_agg(name, ',' ORDER BY name), '') AS present, count(name) AS n_present
  FROM (SELECT DISTINCT match_id, CASE WHEN hero_id IS NOT NULL THEN
               CASE WHEN team = 0 THEN 'radiant' ELSE 'dire' END || CASE WHEN is_pick THEN '_pick_' ELSE '_ban_' END || hero_id END AS name
          FROM pb WHERE is_pick IS NOT NULL AND team IN (0, 1)) GROUP BY match_id"""
    q["sink_csv"] = q["early_features"]
    q["sink_json"] = q["hero_meta"]
    q.update(model_sql())
    q["early_features_files"], q["draft_features_files"] = q["early_features"], q["draft_features"]
    return q


SPLIT = "(((match_id % 100 + 100) % 100 * 7919 + 42) % 100) < 80"
PRF = """SELECT m, sum(tp) / max(total) AS accuracy, sum(p * support) / max(total) AS "precision", sum(r * support) / max(total) AS recall,
       sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * support) / max(total) AS f1
  FROM (SELECT lab.m, support, tp, total, CASE WHEN coalesce(predicted, 0) = 0 THEN 0 ELSE tp / predicted END AS p, tp / support AS r
          FROM (SELECT m, label, count(*) AS support, sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS tp FROM sc GROUP BY 1, 2) lab
          LEFT JOIN (SELECT m, pred, count(*) AS predicted FROM sc GROUP BY 1, 2) prd ON prd.m = lab.m AND prd.pred = lab.label
          JOIN (SELECT m, count(*) AS total FROM sc GROUP BY 1) tot ON tot.m = lab.m) GROUP BY m"""
AUC = """SELECT m, sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY m ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
          FROM (SELECT m, z, sum(label) AS pos, count(*) - sum(label) AS neg FROM sc GROUP BY 1, 2)) GROUP BY m"""


def _linear(name: str) -> str:
    from pickwise.plans.queries import FIXED

    by, intercept = FIXED[name]
    return " + ".join([f"{w!r}::DOUBLE * {c}" for c, w in by.items()] + [f"{intercept!r}::DOUBLE"])


def _quality(*names: str) -> str:
    """CTEs: the test matches scored by the fixed models, and their metrics by model."""
    rows = "\n  UNION ALL ".join(f"SELECT '{n}' AS m, match_id, label, {_linear(n)} AS z FROM ef WHERE NOT ({SPLIT})" for n in names)
    return with_views("ef")[:-1] + "," + _quality_of(rows, 9)


def _quality_of(rows: str, digits: int) -> str:
    """CTEs from scored rows (m, match_id, label, z) to the metrics ``qu`` by model."""
    return f"""
zz AS ({rows}),
sc AS (SELECT m, label, z, CASE WHEN z > 0 THEN 1 ELSE 0 END AS pred FROM zz),
prf AS ({PRF}),
au AS ({AUC}),
qu AS (SELECT prf.m AS model, round(accuracy, {digits}) AS accuracy, round(auc, {digits}) AS auc_roc, round("precision", {digits}) AS "precision",
              round(recall, {digits}) AS recall, round(f1, {digits}) AS f1 FROM prf JOIN au ON au.m = prf.m)
"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _newton(p: str, columns, penalty: float, steps: int = 8) -> str:
    """CTEs that fit a logistic regression of ``label`` on the columns of ``ef`` (scaled by the
    training rows, intercept last and not penalised) by Newton steps: ``{p}_x`` holds the
    rows, ``{p}_fit`` the coefficients.  Each step sums gradient and Hessian over the
    training rows and solves the system by Gauss-Jordan elimination."""
    d = len(columns) + 1
    scaled = ", ".join(f"coalesce(CAST({c} AS DOUBLE) / nullif((SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM ef WHERE {SPLIT}), 0), 0)" for c in columns)
    out = f""",
{p}_x AS MATERIALIZED (SELECT match_id, label, CAST(label AS DOUBLE) AS y, ({SPLIT}) AS is_train, [{scaled}, 1.0] AS v FROM ef),
{p}_w0 AS MATERIALIZED (SELECT list_transform(range({d}), lambda i: CAST(0 AS DOUBLE)) AS w)"""
    for t in range(1, steps + 1):
        entries = ", ".join(f"avg(s * v[i] * v[{j}]) + CASE WHEN i = {j} AND i < {d} THEN {penalty} ELSE 0 END" for j in range(1, d + 1))
        out += f""",
{p}_p{t} AS MATERIALIZED (SELECT v, q - y AS e, q * (1 - q) AS s FROM (SELECT v, y, 1 / (1 + exp(-list_inner_product(v, w))) AS q FROM {p}_x, {p}_w{t - 1} WHERE is_train)),
{p}_h{t} AS MATERIALIZED (SELECT i, [{entries}, avg(e * v[i]) + CASE WHEN i < {d} THEN {penalty} * any_value(w[i]) ELSE 0 END] AS r
  FROM {p}_p{t}, {p}_w{t - 1}, range(1, {d + 1}) AS n(i) GROUP BY i),
{p}_e{t} AS (
  SELECT 0 AS k, i, r FROM {p}_h{t}
  UNION ALL
  SELECT a.k + 1, a.i, CASE WHEN a.i = b.i THEN list_transform(a.r, lambda x: x / b.r[b.i])
                            ELSE list_transform(range(1, {d + 2}), lambda j: a.r[j] - a.r[b.i] * b.r[j] / b.r[b.i]) END
  FROM {p}_e{t} a JOIN {p}_e{t} b ON b.i = a.k + 1 WHERE a.k < {d}),
{p}_w{t} AS MATERIALIZED (SELECT list_transform(range(1, {d + 1}), lambda j: w[j] - g[j]) AS w
  FROM {p}_w{t - 1}, (SELECT list(r[{d + 1}] ORDER BY i) AS g FROM {p}_e{t} WHERE k = {d}))"""
    return out + f""",
{p}_fit AS (SELECT w FROM {p}_w{steps})"""


def model_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    models = ("logistic_regression", "random_forest", "gradient_boosting")
    n = f"(SELECT count(*) FILTER (WHERE {SPLIT}) AS tr, count(*) FILTER (WHERE NOT ({SPLIT})) AS te FROM {{}})"
    fit = """SELECT '{m}' AS model, tr AS train_rows, te AS test_rows, te AS scored_rows, te AS sound_rows,
       CAST({p} AS BIGINT) AS parts, te AS agreeing_rows, CAST(0 AS BIGINT) AS faults FROM {n}"""
    trees = {models[0]: len(EARLY_FEATURES) + 1, models[1]: 100, models[2]: 100}
    drafted_trees = trees | {models[0]: 4 * HERO_POOL + 16}  # one gradient entry a feature, and the intercept
    for key, m in zip(("fit_logreg", "fit_forest", "fit_gbt"), models):
        q[key] = with_views("md") + fit.format(m=m, n=n.format("md"), p=trees[m])
    drafted = "(SELECT DISTINCT pb.match_id FROM pb JOIN md ON md.match_id = pb.match_id WHERE pb.is_pick IS NOT NULL AND pb.team IN (0, 1))"
    q["draft_model_logreg"] = with_views("pb", "md") + fit.format(m=models[0], n=n.format(drafted), p=drafted_trees[models[0]])
    q["draft_model_set"] = with_views("pb", "md") + " UNION ALL ".join(fit.format(m=m, n=n.format(drafted), p=drafted_trees[m]) for m in models)
    q["fit_planted_signal"] = with_views("md") + " UNION ALL ".join(
        f"SELECT '{m}' AS model, tr AS train_rows, te AS test_rows, TRUE AS finds_signal FROM {n.format('md')}" for m in models
    )
    z = _linear("logistic_regression")
    scored = f"SELECT match_id, label, CAST(CASE WHEN {z} > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, round(1 / (1 + exp(-({z}))), 9) AS radiant_win_probability FROM ef"
    q["batch_score"] = with_views("ef") + scored
    q["prediction_export"] = with_views("ef") + scored + f" WHERE NOT ({SPLIT})"
    variances = " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(var_samp(CAST({c} AS DOUBLE)), 0) AS v FROM ef" for c in EARLY_FEATURES)
    q["variance_share"] = with_views("ef")[:-1] + f""",
va AS ({variances}),
im AS (SELECT feature, round(v / (SELECT sum(v) FROM va), 9) AS importance FROM va)
SELECT CAST(rk AS INTEGER) AS rank, feature, importance
  FROM (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS rk FROM im) WHERE rk <= 10"""
    slopes = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN var_samp({c}) > 0 THEN covar_samp(CAST(label AS DOUBLE), CAST({c} AS DOUBLE)) / var_samp(CAST({c} AS DOUBLE)) ELSE 0 END AS k, avg(label) AS b FROM ef"
        for c in EARLY_FEATURES
    )
    q["single_slopes"] = with_views("ef")[:-1] + f""",
sl AS ({slopes})
SELECT feature, round(k, 9) AS coefficient, abs(round(k, 9)) AS abs_coefficient, round(b, 9) AS intercept FROM sl"""
    order = "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(models)) + " END"
    compared = f"""SELECT CAST({order} AS INTEGER) AS ordinal, model, accuracy, auc_roc, "precision", recall, f1,
       accuracy >= 0.65 AS meets_accuracy_target, auc_roc >= 0.7 AS meets_auc_target FROM qu"""
    q["model_comparison"] = _quality(*models) + compared
    q["best_model"] = _quality(*models) + f"SELECT * FROM ({compared}) ORDER BY auc_roc DESC, ordinal LIMIT 1"
    q["fixed_model_gain"] = _quality("draft_only", models[0]) + f"""SELECT 'radiant_picks,dire_picks' AS draft_columns,
       b.accuracy AS baseline_accuracy, b.auc_roc AS baseline_auc, f.accuracy AS model_accuracy, f.auc_roc AS model_auc,
       round((f.accuracy - b.accuracy) * 100, 6) AS accuracy_gain_points, round(f.auc_roc - b.auc_roc, 6) AS auc_gain
  FROM (SELECT * FROM qu WHERE model = 'draft_only') b, (SELECT * FROM qu WHERE model = '{models[0]}') f"""
    bands = "\n".join(line for line in _bands("p").splitlines())
    q["prediction_examples"] = with_views("ef")[:-1] + f""",
pr AS (SELECT match_id, label, CAST(CASE WHEN {z} > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, gold_at_10min, exp_at_10min,
              teamfights_count_10min, tower_kills_10min, 1 / (1 + exp(-({z}))) AS p
         FROM ef WHERE NOT ({SPLIT}) ORDER BY match_id LIMIT 5)
SELECT match_id, label, prediction, gold_at_10min, exp_at_10min, teamfights_count_10min, tower_kills_10min,
       round(p, 9) AS radiant_win_probability, CASE WHEN p > 0.5 THEN 'Radiant' ELSE 'Dire' END AS predicted_winner,
       round(CASE WHEN p > 0.5 THEN p ELSE 1 - p END, 9) AS predicted_probability,
       {bands}
  FROM pr"""
    q["importance_from_nodes"] = " UNION ALL ".join(f"SELECT '{m}' AS model, CAST({len(EARLY_FEATURES)} AS BIGINT) AS features, CAST({len(EARLY_FEATURES)} AS BIGINT) AS agreeing, CAST(1 AS DOUBLE) AS total" for m in models[1:])
    q["fitted_models"] = with_views("md") + " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{m}' AS model, te AS test_rows, 5 AS metrics_again, TRUE AS accuracy_target_agrees, TRUE AS auc_target_agrees, TRUE AS best_is_no_worse FROM {n.format('md')}" for i, m in enumerate(models)
    )
    full = _newton("lr", EARLY_FEATURES, 0.01)
    named = ", ".join(f"'{c}'" for c in EARLY_FEATURES)
    q["logreg_coefficients"] = _recursive(with_views("ef")[:-1] + full + f"""
SELECT feature, round(c, 3) AS coefficient, abs(round(c, 3)) AS abs_coefficient, round(b, 3) AS intercept
  FROM (SELECT unnest([{named}]) AS feature, unnest(w[1:{len(EARLY_FEATURES)}]) AS c, w[{len(EARLY_FEATURES) + 1}] AS b FROM lr_fit)""")
    scores = "\n  UNION ALL ".join(
        f"SELECT '{m}' AS m, match_id, label, list_inner_product(v, w) AS z FROM {p}_x, {p}_fit WHERE NOT is_train" for m, p in (("draft_only", "dr"), (models[0], "lr"))
    )
    q["draft_baseline_gain"] = _recursive(with_views("ef")[:-1] + full + _newton("dr", ["radiant_picks", "dire_picks"], 0.0) + "," + _quality_of(scores, 12) + f"""SELECT 'radiant_picks,dire_picks' AS draft_columns,
       round(b.accuracy, 4) AS baseline_accuracy, round(b.auc_roc, 4) AS baseline_auc, round(f.accuracy, 4) AS model_accuracy, round(f.auc_roc, 4) AS model_auc,
       round((f.accuracy - b.accuracy) * 100, 1) AS accuracy_gain_points, round(f.auc_roc - b.auc_roc, 3) AS auc_gain
  FROM (SELECT * FROM qu WHERE model = 'draft_only') b, (SELECT * FROM qu WHERE model = '{models[0]}') f""")
    q["model_roundtrip"] = with_views("md") + f"SELECT match_id, TRUE AS same_probability FROM md WHERE NOT ({SPLIT})"
    stages = [f"SELECT {i + 2} AS ordinal, 'train_{m}' AS stage, tr AS rows, 21 AS features, TRUE AS timed, TRUE AS rate_holds FROM {n.format('md')}" for i, m in enumerate(models)]
    q["run_report"] = with_views("md") + """SELECT 0 AS ordinal, 'data_loading' AS stage,
       (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM events) AS rows, CAST(NULL AS INTEGER) AS features, TRUE AS timed, TRUE AS rate_holds
UNION ALL SELECT 1, 'feature_engineering', count(DISTINCT match_id), 21, TRUE, TRUE FROM md UNION ALL """ + " UNION ALL ".join(stages)
    return q


def draft_features_sql(hero_ids=range(HERO_POOL)) -> str:
    oh = onehot_sql(hero_ids)
    onehot_cols = []
    for kind in ("pick", "ban"):
        for side in ("radiant", "dire"):
            onehot_cols += [f"CAST(oh.{side}_{kind}_{h} AS DOUBLE) AS {side}_{kind}_{h}" for h in hero_ids]
    order_cols = [
        "radiant_avg_pick_order", "radiant_first_pick", "radiant_last_pick",
        "dire_avg_pick_order", "dire_first_pick", "dire_last_pick",
    ]
    rest = [f"CAST(coalesce(pof.{c}, 0) AS DOUBLE) AS {c}" for c in order_cols]
    rest += [
        "CAST(coalesce(tm.avg_pick_time, 0) AS DOUBLE) AS avg_pick_time",
        "CAST(coalesce(tm.max_pick_time, 0) AS DOUBLE) AS max_pick_time",
        "CAST(coalesce(tm.min_pick_time, 0) AS DOUBLE) AS min_pick_time",
        "round(CAST(coalesce(tm.std_pick_time, 0) AS DOUBLE), 6) AS std_pick_time",
        "CAST(coalesce(tm.total_extra_time, 0) AS DOUBLE) AS total_extra_time",
        "round(coalesce(ps0.syn, 0.5), 6) AS radiant_synergy",
        "round(coalesce(ps1.syn, 0.5), 6) AS dire_synergy",
        "round(coalesce(ps0.syn, 0.5) - coalesce(ps1.syn, 0.5), 6) AS synergy_diff",
        "CAST(coalesce(md.patch, 0) AS DOUBLE) AS patch",
        "CASE WHEN md.radiant_win = TRUE THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label",
    ]
    head = with_views("ps", "md", "dt")[:-1]
    return (
        head + ",\noh AS (" + oh + "),\n" + PICK_ORDER + ",\n" + TIMING + "\n"
        + "SELECT oh.match_id, " + ", ".join(onehot_cols + rest) + "\n"
        + "  FROM oh JOIN md ON md.match_id = oh.match_id\n"
        + "  LEFT JOIN pof ON pof.match_id = oh.match_id\n"
        + "  LEFT JOIN tm ON tm.match_id = oh.match_id\n"
        + "  LEFT JOIN ps ps0 ON ps0.match_id = oh.match_id AND ps0.team = 0\n"
        + "  LEFT JOIN ps ps1 ON ps1.match_id = oh.match_id AND ps1.team = 1"
    )
