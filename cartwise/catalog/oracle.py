"""SQL counterparts of the registered queries.

They follow the operators' definitions literally, one scan per window and one left join per block, and
share no code with the Spark plans.
"""

from __future__ import annotations

import math
import re
from datetime import date, datetime, timedelta

from cartwise.catalog import setting as cfg

T_END, T_START = cfg.WINDOW.end, cfg.WINDOW.start
TYPES = (1, 2, 3, 4, 5, 6)
NON_BUY = (1, 2, 3, 5, 6)
C8 = f"cate = {cfg.CATE}"


def _ts(t: datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _win(start: datetime, end: datetime) -> str:
    return f"time >= {_ts(start)} AND time < {_ts(end)}"


FULL = _win(T_START, T_END)
SUB = _win(cfg.SUB.start, cfg.SUB.end)
LABEL = _win(cfg.LABEL.start, cfg.LABEL.end)
AGE = f"date_diff('second', time, {_ts(T_END)})"


def _back(days: float = 0, hours: float = 0) -> str:
    return _win(T_END - timedelta(days=days, hours=hours), T_END)


# --- input tables -----------------------------------------------------------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "actions": (
        (),
        """
        SELECT e.user_id, e.k AS sku_id, date_trunc('second', e.ts) AS time,
               CASE WHEN e.event_type = 'click' THEN CAST(floor(e.value) AS BIGINT) % 20 END AS model_id,
               CASE e.event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 2 WHEN 'error' THEN 3
                    WHEN 'purchase' THEN 4 WHEN 'click' THEN CASE WHEN e.k % 2 = 0 THEN 6 ELSE 5 END
               END AS type,
               CASE p.p_type WHEN 'STANDARD' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'MEDIUM' THEN 6
                    WHEN 'LARGE' THEN 7 WHEN 'ECONOMY' THEN 8 WHEN 'PROMO' THEN 9 END AS cate,
               CAST(replace(p.p_brand, 'Brand#', '') AS INTEGER) AS brand,
               CAST(hour(e.ts) AS INTEGER) // 6 AS time_zone, e.value
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
        JOIN part p ON p.p_partkey = e.k""",
    ),
    "users": (
        (),
        """
        SELECT c_custkey AS user_id,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                    WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS user_lv_cd,
               CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE
                    (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey) END AS user_reg_tm
        FROM customer""",
    ),
    "products": (
        (),
        """
        SELECT p_partkey AS sku_id, p_size % 4 - 1 AS a1, p_size % 3 - 1 AS a2, p_size % 3 AS a3
        FROM part WHERE p_type = 'ECONOMY'""",
    ),
    "comments": (
        (),
        """
        SELECT dt, l_partkey AS sku_id, count(*) % 5 AS comment_num,
               CASE WHEN avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) > 1.0 / 3
                         AND 3 * count(*) FILTER (l_returnflag = 'R') > count(*)
                    THEN 1 ELSE 0 END AS has_bad_comment,
               count(*) FILTER (l_returnflag = 'R') / count(*) AS bad_comment_rate
        FROM lineitem JOIN (SELECT make_date(y, 1, 1) AS dt FROM range(1996, 2003) r(y))
             ON l_shipdate < dt
        GROUP BY dt, l_partkey""",
    ),
    "label_known": (
        ("actions", "users", "products"),
        f"""
        SELECT DISTINCT user_id, sku_id FROM actions
        WHERE {LABEL} AND type = 4 AND sku_id IN (SELECT sku_id FROM products)
              AND user_id IN (SELECT user_id FROM users)""",
    ),
    "eval_sub": (
        ("label_known",),
        """
        SELECT user_id, sku_id,
               CASE WHEN row_number() OVER (ORDER BY md5(concat(user_id, ':', sku_id))) <= floor(n * 0.5)
                    THEN 'B' ELSE 'A' END AS board
        FROM (SELECT *, count(*) OVER () AS n FROM
              (SELECT user_id, min(sku_id) AS sku_id FROM label_known GROUP BY user_id))""",
    ),
    "curve": (
        ("actions", "users", "products"),
        f"""
        SELECT h AS time_dist, (share - min(share) OVER ()) / (max(share) OVER () - min(share) OVER ())
               AS weight
        FROM (SELECT h, avg(bought) AS share
              FROM range(1, 721) r(h)
              LEFT JOIN (
                SELECT DISTINCT a.user_id, a.time, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS bought
                FROM (SELECT user_id, max(time) AS time FROM actions
                      WHERE {_win(cfg.CURVE_WINDOW.start, cfg.CURVE_WINDOW.end)} AND {C8}
                      GROUP BY user_id) a
                LEFT JOIN (
                  SELECT DISTINCT user_id FROM actions
                  WHERE {_win(cfg.CURVE_LABEL.start, cfg.CURVE_LABEL.end)} AND type = 4
                        AND sku_id IN (SELECT sku_id FROM products)
                        AND user_id IN (SELECT user_id FROM users)) b ON a.user_id = b.user_id) u
              ON u.time >= {_ts(cfg.CURVE_WINDOW.end)} - to_hours(CAST(h AS INTEGER))
              GROUP BY h)""",
    ),
    "weighted": (
        ("actions", "curve"),
        f"""
        SELECT a.*, c.weight FROM actions a
        LEFT JOIN curve c ON c.time_dist = {AGE} // 3600 + 1""",
    ),
    "cand_users": (
        ("actions", "eval_sub"),
        f"""
        SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM eval_sub) THEN 1 ELSE 0 END AS label
        FROM (SELECT DISTINCT user_id FROM actions WHERE {SUB} AND {C8})
        WHERE user_id NOT IN (SELECT user_id FROM actions WHERE {SUB} AND {C8} AND type = 4)""",
    ),
    "cand_pairs": (
        ("actions", "label_known"),
        f"""
        SELECT p.*, CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS label
        FROM (SELECT DISTINCT user_id, sku_id, cate, brand FROM actions WHERE {SUB} AND {C8}) p
        LEFT JOIN label_known l ON l.user_id = p.user_id AND l.sku_id = p.sku_id
        WHERE p.user_id NOT IN (SELECT user_id FROM actions WHERE {SUB} AND {C8} AND type = 4)""",
    ),
    "pair_scores": (
        ("actions",),
        f"""
        SELECT user_id, sku_id, round(sum(CAST(round(value * 100) AS BIGINT)) / count(*), 6) AS score
        FROM actions WHERE {SUB} AND {C8} GROUP BY user_id, sku_id""",
    ),
    "user_scores": (
        ("actions",),
        f"""
        SELECT user_id, round(sum(CAST(round(value * 100) AS BIGINT)) / count(*), 6) AS score
        FROM actions WHERE {SUB} AND {C8} GROUP BY user_id""",
    ),
    "best": (
        ("pair_scores",),
        """
        SELECT * FROM pair_scores p
        WHERE score = (SELECT max(score) FROM pair_scores q WHERE q.user_id = p.user_id)""",
    ),
    "submission": (
        ("best", "user_scores"),
        f"""
        SELECT user_id, sku_id FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source, sku_id) AS rn FROM (
            (SELECT user_id, sku_id, 0 AS source FROM best
             ORDER BY score DESC, user_id, sku_id LIMIT {cfg.TOP_RANKED})
            UNION ALL
            SELECT user_id, sku_id, 1 FROM best WHERE user_id IN (
              SELECT user_id FROM user_scores ORDER BY score DESC, user_id LIMIT {cfg.TOP_RANKED})))
        WHERE rn = 1""",
    ),
}


_STAMP = re.compile("TIMESTAMP '([^']+)'")
_FIXED = {_ts(cfg.DEFAULT_REG), _ts(cfg.REG_CUTOFF)}


def _earlier(sql: str, days: int) -> str:
    """The same SQL with all its windows `days` earlier; registration defaults are no windows."""

    def moved(match: re.Match) -> str:
        if match.group() in _FIXED:
            return match.group()
        return _ts(datetime.fromisoformat(match.group(1)) - timedelta(days=days))

    return _STAMP.sub(moved, sql) if days else sql


def _with(names: tuple[str, ...], days: int = 0) -> str:
    """The tables and what they need, `days` earlier; the recency curve is the same for all splits."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in CTES[name][0]:
            add(need)
        ordered.append(name)

    for name in names:
        add(name)
    bodies = {n: CTES[n][1] if n == "curve" else _earlier(CTES[n][1], days) for n in ordered}
    return "WITH " + ", ".join(f"{n} AS ({body})" for n, body in bodies.items())


def _sql(needs: tuple[str, ...] | str, body: str, ints=(), doubles=(), raw=(), days: int = 0) -> str:
    """The body's columns with the declared result types."""
    needs = (needs,) if isinstance(needs, str) else needs
    out = (
        [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in ints]
        + [f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in doubles]
        + [f'"{c}"' for c in raw]
    )
    return f"{_with(needs, days)} SELECT {', '.join(out)} FROM ({_earlier(body, days)})"


def _all_splits(needs: tuple[str, ...], body: str, ints=(), doubles=()) -> str:
    """A labelled feature table of every rolling split; the last one has no labels yet."""
    parts = []
    for back, name in ((2, "valid"), (1, "train"), (0, "online")):
        label = "" if back else " REPLACE (CAST(NULL AS BIGINT) AS label)"
        one = _sql(needs, body, ints, doubles, days=back * cfg.SPLIT_STEP_DAYS)
        parts.append(f"SELECT '{name}' AS split, *{label} FROM ({one})")
    return " UNION ALL ".join(parts)


# --- building blocks ---------------------------------------------------------------------------


def _counts(keys: str, where: str, types=TYPES, name: str = "cnt_{t}", table: str = "actions") -> str:
    cols = ", ".join(f"count(*) FILTER (type = {t}) AS {name.format(t=t)}" for t in types)
    return f"SELECT {keys}, {cols} FROM {table} WHERE {where} GROUP BY {keys}"


def _decays(keys: str, where: str, types=TYPES, name: str = "decay_{t}") -> str:
    cols = ", ".join(
        f"coalesce(sum(weight) FILTER (type = {t}), 0) AS {name.format(t=t)}" for t in types
    )
    return f"SELECT {keys}, {cols} FROM weighted WHERE {where} GROUP BY {keys}"


def _total(keys: str, where: str, name: str) -> str:
    return f"SELECT {keys}, count(*) AS {name} FROM actions WHERE {where} GROUP BY {keys}"


def _user_total(where: str, name: str) -> str:
    return (
        f"SELECT user_id, count(*) FILTER (type IN (1, 6)) AS {name} FROM actions"
        f" WHERE {where} GROUP BY user_id"
    )


def _days(keys: str, where: str, name: str) -> str:
    return (
        f"SELECT {keys}, count(DISTINCT CAST(time AS DATE)) AS {name} FROM actions"
        f" WHERE {where} GROUP BY {keys}"
    )


def _dwell(keys: str, where: str, name: str, gap: int = cfg.MAX_GAP) -> str:
    return f"""
      SELECT {keys}, 1 + coalesce(sum(gap) FILTER (gap <= {gap}), 0) AS {name} FROM (
        SELECT {keys}, date_diff('second', time, lead(time) OVER (PARTITION BY {keys} ORDER BY time))
               AS gap
        FROM (SELECT DISTINCT {keys}, time FROM actions WHERE {where}))
      GROUP BY {keys}"""


def _runs(where: str, name: str, keys: str = "user_id, sku_id") -> str:
    return f"""
      SELECT {keys}, count(*) AS {name} FROM (
        SELECT user_id, sku_id,
               lead(sku_id) OVER (PARTITION BY user_id ORDER BY time, sku_id) AS next_sku
        FROM actions WHERE {where})
      WHERE next_sku IS NULL OR next_sku <> sku_id
      GROUP BY {keys}"""


def _zero_one(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / (CASE WHEN {b} = 0 THEN 1 ELSE {b} END)"


def _or_one(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 1)"


def _join(base: str, blocks: list[tuple[str, str]], select: str) -> str:
    """`base` left joined with (sql, key columns) blocks."""
    parts = [f"({base}) b0"]
    for n, (sql, keys) in enumerate(blocks):
        parts.append(f"LEFT JOIN ({sql}) j{n} USING ({keys})")
    return f"SELECT {select} FROM {' '.join(parts)}"


def _comments(end: datetime) -> str:
    onehot = ", ".join(
        f"CASE WHEN comment_num = {c} THEN 1 ELSE 0 END AS comment_num_{c}" for c in range(5)
    )
    return f"""SELECT sku_id, has_bad_comment, bad_comment_rate, {onehot} FROM comments
        WHERE dt = (SELECT max(dt) FROM comments WHERE dt < {_ts(end)})"""


COMMENT_COLS = ["has_bad_comment"] + [f"comment_num_{c}" for c in range(5)]
ATTRS = [("a1", v) for v in range(4)] + [("a2", v) for v in range(3)] + [("a3", v) for v in range(3)]
ATTR_COLS = [f"{a}_{v}" for a, v in ATTRS]


def _attributes() -> str:
    cols = ", ".join(
        f"CASE WHEN (CASE WHEN {a} = -1 THEN 0 ELSE {a} END) = {v} THEN 1 ELSE 0 END AS {a}_{v}"
        for a, v in ATTRS
    )
    return f"SELECT sku_id, {cols} FROM products"


def _top(key: str) -> str:
    return (
        f"SELECT {key} FROM actions WHERE {SUB} AND {C8} AND type = 4 GROUP BY {key}"
        f" ORDER BY count(*) DESC, {key} LIMIT 5"
    )


FLOW_DAYS = (1, 3, 5, 7, 10, 15, 28)
FLOW_COLS = [f"flow_ratio_{d}d" for d in FLOW_DAYS]


def _flows() -> str:
    def flow(where: str, name: str) -> str:
        return (
            f"SELECT sku_id, count(DISTINCT user_id) AS {name} FROM actions WHERE {where} GROUP BY sku_id"
        )

    ratios = ", ".join(
        f"{_zero_one(f'coalesce(f{d}, 0)', 'f_all')} AS flow_ratio_{d}d" for d in FLOW_DAYS
    )
    blocks = [(flow(_back(d), f"f{d}"), "sku_id") for d in FLOW_DAYS]
    return _join(flow(FULL, "f_all"), blocks, f"sku_id, {ratios}")


def _brand_rates() -> str:
    return f"""SELECT brand, avg(bad_comment_rate) AS brand_bad_rate
        FROM ({_comments(T_END)}) LEFT JOIN (SELECT DISTINCT sku_id, brand FROM actions WHERE {FULL})
        USING (sku_id) WHERE brand IS NOT NULL GROUP BY brand"""


SALE_DAYS = (1, 2, 3, 5, 7, 10, 14, 28)
SALE_COLS = [f"sale_ratio_{d}d" for d in SALE_DAYS]


def _sales() -> str:
    blocks = []
    for d in SALE_DAYS:
        sql = f"""
          SELECT sku_id, {_zero_one('coalesce(ic, 0)', 'coalesce(bc, 0)')} AS sale_ratio_{d}d
          FROM (SELECT sku_id, count(*) FILTER (type = 4) AS ic FROM actions WHERE {_back(d)}
                GROUP BY sku_id)
          LEFT JOIN (SELECT DISTINCT sku_id, cate, brand FROM actions) USING (sku_id)
          LEFT JOIN (SELECT brand, cate, count(*) FILTER (type = 4) AS bc FROM actions
                     WHERE {_back(d)} GROUP BY brand, cate) USING (brand, cate)"""
        blocks.append((sql, "sku_id"))
    items = f"SELECT DISTINCT sku_id FROM actions WHERE {_back(28)}"
    return _join(items, blocks, "sku_id, " + ", ".join(SALE_COLS))


# --- user features ----------------------------------------------------------------------------

DAY_COLS = ["user_days", "user_days_7d", "user_days_15d", "cate_days_7d", "cate_days_15d"]
DAY_RATIOS = ["user_day_ratio_7d", "user_day_ratio_15d", "cate_day_ratio_7d", "cate_day_ratio_15d"]


def _day_ratios() -> str:
    blocks = [
        (_days("user_id", _back(7), "u7"), "user_id"),
        (_days("user_id", _back(15), "u15"), "user_id"),
        (_days("user_id", f"{_back(7)} AND {C8}", "c7"), "user_id"),
        (_days("user_id", f"{_back(15)} AND {C8}", "c15"), "user_id"),
    ]
    filled = _join(
        _days("user_id", FULL, "user_days"),
        blocks,
        "user_id, user_days, coalesce(u7, 0) AS user_days_7d, coalesce(u15, 0) AS user_days_15d,"
        " coalesce(c7, 0) AS cate_days_7d, coalesce(c15, 0) AS cate_days_15d",
    )
    return f"""SELECT *, {_zero_one('user_days_7d', 'user_days')} AS user_day_ratio_7d,
        {_zero_one('user_days_15d', 'user_days')} AS user_day_ratio_15d,
        {_zero_one('cate_days_7d', 'user_days_7d')} AS cate_day_ratio_7d,
        {_zero_one('cate_days_15d', 'user_days_15d')} AS cate_day_ratio_15d FROM ({filled})"""


ATTENTION_SPANS = ("7d", "15d", "full")
ATTENTION_COLS = [f"{k}_total_{w}" for w in ATTENTION_SPANS for k in ("user", "cate")]
ATTENTION_RATIOS = [f"cate_attention_{w}" for w in ATTENTION_SPANS]


def _attention() -> str:
    spans = {"7d": _back(7), "15d": _back(15), "full": FULL}
    base = f"SELECT DISTINCT user_id FROM actions WHERE {FULL}"
    blocks, filled = [], []
    for w, where in spans.items():
        blocks.append((_user_total(where, f"u_{w}"), "user_id"))
        blocks.append((_total("user_id", f"{where} AND {C8}", f"c_{w}"), "user_id"))
        filled.append(f"coalesce(u_{w}, 0) AS user_total_{w}, coalesce(c_{w}, 0) AS cate_total_{w}")
    ratios = ", ".join(
        f"{_zero_one(f'cate_total_{w}', f'user_total_{w}')} AS cate_attention_{w}" for w in spans
    )
    return f"SELECT *, {ratios} FROM ({_join(base, blocks, 'user_id, ' + ', '.join(filled))})"


SEQ_DAYS = (1, 2, 3, 5, 7)
DWELL_INTS = [f"{k}_dwell_{d}d" for d in SEQ_DAYS for k in ("cate", "user")]
DWELL_RATIOS = [f"dwell_ratio_{d}d" for d in SEQ_DAYS]
RUN_INTS = [f"{k}_runs_{d}d" for d in SEQ_DAYS for k in ("cate", "user")]
RUN_RATIOS = [f"runs_ratio_{d}d" for d in SEQ_DAYS]


def _cate_over_user(measure: str, block, d: int) -> str:
    of_cate = block(f"{_back(d)} AND {C8}", f"cate_{measure}_{d}d")
    of_user = block(_back(d), f"user_{measure}_{d}d")
    ratio = _zero_one(f"cate_{measure}_{d}d", f"user_{measure}_{d}d")
    return f"""SELECT user_id, cate_{measure}_{d}d, user_{measure}_{d}d, {ratio} AS {measure}_ratio_{d}d
        FROM ({of_cate}) LEFT JOIN ({of_user}) USING (user_id)"""


def _user_dwells(d: int) -> str:
    return _cate_over_user("dwell", lambda w, n: _dwell("user_id", w, n), d)


def _user_runs(d: int) -> str:
    return _cate_over_user("runs", lambda w, n: _runs(w, n, "user_id"), d)


MEAN_COLS = ["cate_mean_per_day"] + [f"cate_tz_{z}_per_day" for z in range(4)]


def _daily_means() -> str:
    zones = ", ".join(f"count(*) FILTER (time_zone = {z}) AS z{z}" for z in range(4))
    ratios = ", ".join(f"{_zero_one(f'z{z}', 'n_days')} AS cate_tz_{z}_per_day" for z in range(4))
    return f"""SELECT user_id, {_zero_one('n', 'n_days')} AS cate_mean_per_day, {ratios} FROM (
        SELECT user_id, count(*) AS n, count(DISTINCT CAST(time AS DATE)) AS n_days, {zones}
        FROM actions WHERE {SUB} AND {C8} GROUP BY user_id)"""


def _other_bought() -> str:
    return f"""SELECT user_id, sum(b) AS other_cates_bought_7d FROM (
        SELECT user_id, cate, CASE WHEN count(*) FILTER (type = 4) > 0 THEN 1 ELSE 0 END AS b
        FROM actions WHERE {SUB} AND cate <> {cfg.CATE} GROUP BY user_id, cate) GROUP BY user_id"""


def _browse_click() -> str:
    return f"""SELECT user_id, {_zero_one('c1', 'c6')} AS cate_browse_click_15d
        FROM ({_counts('user_id', f'{_back(15)} AND {C8}', (1, 6), 'c{t}')})"""


def _user_base() -> str:
    default = _ts(cfg.DEFAULT_REG)
    return f"""SELECT user_id, user_lv_cd,
        floor(date_diff('second', reg, {_ts(T_END)}) / 86400) AS reg_days
        FROM (SELECT user_id, user_lv_cd, CASE WHEN coalesce(user_reg_tm, {default}) >
              {_ts(cfg.REG_CUTOFF)} THEN {default} ELSE coalesce(user_reg_tm, {default}) END AS reg
              FROM users)"""


def _window_ratio(keys: str, where: str = "true") -> str:
    """Sub-window over full-window counts by type."""
    ratios = ", ".join(f"{_or_one(f's{t}', f'a{t}')} AS ratio_{t}" for t in TYPES)
    return f"""SELECT {keys}, {ratios}
        FROM ({_counts(keys, f'{SUB} AND {where}', name='s{t}')})
        LEFT JOIN ({_counts(keys, f'{FULL} AND {where}', name='a{t}')}) USING ({keys})"""


def _rule(min_ratio: float, level: int, max_days: int | None, by_cate: bool) -> str:
    ratios = _window_ratio("user_id", C8 if by_cate else "true")
    cart = f"SELECT user_id FROM actions WHERE {SUB} AND {C8} AND type = 2"
    buy = f"SELECT user_id FROM actions WHERE {SUB} AND {C8} AND type = 4"
    days = ""
    if max_days is not None:
        few = _days("user_id", f"{SUB} AND {C8}", "n")
        days = f" AND user_id IN (SELECT user_id FROM ({few}) WHERE n <= {max_days})"
    return f"""SELECT user_id FROM ({ratios}) WHERE ratio_4 >= {min_ratio} AND ratio_1 >= {min_ratio}
        AND user_id IN ({cart}) AND user_id NOT IN ({buy})
        AND user_id IN (SELECT user_id FROM users WHERE user_lv_cd > {level}){days}"""


USER_INTS = (
    ["user_lv_cd", "reg_days", "rule_user", "user_last_dist", "user_first_dist", "cate_last_dist"]
    + DAY_COLS
    + ATTENTION_COLS
    + ["max_burst"]
    + DWELL_INTS
    + RUN_INTS
    + [f"cate_cnt_{t}_7d" for t in (2, 4, 5)]
    + ["other_cates_bought_7d"]
)
USER_DOUBLES = (
    DAY_RATIOS
    + ATTENTION_RATIOS
    + ["mean_burst"]
    + DWELL_RATIOS
    + RUN_RATIOS
    + [f"cate_decay_{t}" for t in NON_BUY]
    + MEAN_COLS
    + ["cate_browse_click_15d"]
)


def _bursts() -> str:
    return f"""SELECT user_id, max(n) AS max_burst, avg(n) AS mean_burst FROM (
        SELECT user_id, time, count(*) AS n FROM actions WHERE {SUB} GROUP BY user_id, time)
        GROUP BY user_id"""


def _dist(keys: str, where: str, name: str, which: str) -> str:
    return f"SELECT {keys}, {which}({AGE}) AS {name} FROM actions WHERE {where} GROUP BY {keys}"


def _user_feature_blocks() -> list[tuple[str, str]]:
    blocks = [
        _user_base(),
        _dist("user_id", FULL, "user_last_dist", "min"),
        _dist("user_id", FULL, "user_first_dist", "max"),
        _dist("user_id", f"{FULL} AND {C8}", "cate_last_dist", "min"),
        _day_ratios(),
        _attention(),
        _bursts(),
        *[_user_dwells(d) for d in SEQ_DAYS],
        *[_user_runs(d) for d in SEQ_DAYS],
        _decays("user_id", f"{_back(15)} AND {C8}", NON_BUY, "cate_decay_{t}"),
        _counts("user_id", f"{_back(7)} AND {C8}", (2, 4, 5), "cate_cnt_{t}_7d"),
        _daily_means(),
        _other_bought(),
        _browse_click(),
    ]
    return [(b, "user_id") for b in blocks]


def _user_features() -> str:
    base = f"""SELECT *, CASE WHEN user_id IN ({_rule(1.0, 2, 2, True)}) THEN 1 ELSE 0 END AS rule_user
        FROM cand_users"""
    return _join(base, _user_feature_blocks(), "*")


# --- pair features ----------------------------------------------------------------------------

P = "user_id, sku_id"
HOURS = (4, 8, 16, 24, 48, 72, 120, 168, 360, 672)
RUN_HOURS = (4, 8, 16, 24, 48, 72, 120, 168)
TOTAL_DAYS = (1, 2, 3, 5, 7, 15, 28)
RATIO_SPANS = {"7d": _back(7), "15d": _back(15), "28d": _back(28), "full": FULL}
PAIR_DAY_INTS = [f"pair_days_{w}" for w in RATIO_SPANS]
PAIR_DAY_RATIOS = [f"pair_day_ratio_{w}" for w in RATIO_SPANS]
COUNT_COLS = [f"pair_cnt_{t}_{h}h" for h in HOURS for t in NON_BUY]
TOTAL_INTS = [f"{k}_total_{d}d" for d in TOTAL_DAYS for k in ("cate", "pair")]
TOTAL_RATIOS = [f"pair_{k}_{d}d" for d in TOTAL_DAYS for k in ("share", "mean")]
PAIR_DWELL_INTS = [f"{k}_{d}d" for d in SEQ_DAYS for k in ("pair_dwell", "pair_cate_dwell")]
PAIR_DWELL_RATIOS = [f"pair_dwell_ratio_{d}d" for d in SEQ_DAYS]
PAIR_RUNS = [f"pair_runs_{h}h" for h in RUN_HOURS]
LAST_COLS = ["pair_last_2", "pair_last_3", "pair_last_5", "pair_delcart_later"]
SPAN_COLS = ["pair_first_dist", "pair_last_dist", "pair_span"]


def _spans() -> str:
    return f"""SELECT {P}, max({AGE}) AS pair_first_dist, min({AGE}) AS pair_last_dist,
        max({AGE}) - min({AGE}) AS pair_span FROM actions WHERE {FULL} AND {C8} GROUP BY {P}"""


def _pair_days() -> str:
    blocks, cols = [], []
    for w, where in RATIO_SPANS.items():
        blocks.append((_days(P, where, f"p_{w}"), P))
        blocks.append((_days("user_id", where, f"u_{w}"), "user_id"))
        p, u = f"coalesce(p_{w}, 0)", f"coalesce(u_{w}, 0)"
        cols.append(f"{p} AS pair_days_{w}, {_zero_one(p, u)} AS pair_day_ratio_{w}")
    base = f"SELECT DISTINCT {P} FROM actions WHERE {FULL} AND {C8}"
    return _join(base, blocks, f"{P}, " + ", ".join(cols))


def _pair_counts(h: int) -> str:
    return _counts(P, f"{_back(hours=h)} AND {C8}", NON_BUY, "pair_cnt_{t}_" + f"{h}h")


def _all_pair_counts() -> str:
    base = f"SELECT DISTINCT {P} FROM actions WHERE {_back(28)} AND {C8}"
    return _join(base, [(_pair_counts(h), P) for h in HOURS], f"{P}, " + ", ".join(COUNT_COLS))


def _pair_total(d: int) -> str:
    where = _back(d)
    return f"""SELECT {P}, cate_total_{d}d, pair_total_{d}d,
        {_zero_one(f'pair_total_{d}d', f'cate_total_{d}d')} AS pair_share_{d}d,
        {_zero_one(f'pair_total_{d}d', 'n_days')} AS pair_mean_{d}d
        FROM ({_total('user_id', f'{where} AND {C8}', f'cate_total_{d}d')})
        LEFT JOIN ({_total(P, f'{where} AND {C8}', f'pair_total_{d}d')}) USING (user_id)
        LEFT JOIN ({_days(P, where, 'n_days')}) USING ({P})"""


def _all_pair_totals() -> str:
    base = f"SELECT DISTINCT {P} FROM actions WHERE {_back(28)} AND {C8}"
    cols = ", ".join(TOTAL_INTS + TOTAL_RATIOS)
    return _join(base, [(_pair_total(d), P) for d in TOTAL_DAYS], f"{P}, {cols}")


def _pair_dwell(d: int) -> str:
    cate = f"coalesce(c, 0)"
    return f"""SELECT {P}, pair_dwell_{d}d, {cate} AS pair_cate_dwell_{d}d,
        {_zero_one(f'pair_dwell_{d}d', cate)} AS pair_dwell_ratio_{d}d
        FROM ({_dwell(P, f'{_back(d)} AND {C8}', f'pair_dwell_{d}d')})
        LEFT JOIN ({_dwell('user_id', f'{_back(d)} AND {C8}', 'c')}) USING (user_id)"""


def _all_pair_dwells() -> str:
    base = f"SELECT DISTINCT {P} FROM actions WHERE {_back(7)} AND {C8}"
    cols = ", ".join(PAIR_DWELL_INTS + PAIR_DWELL_RATIOS)
    return _join(base, [(_pair_dwell(d), P) for d in SEQ_DAYS], f"{P}, {cols}")


def _pair_runs(h: int) -> str:
    return _runs(f"{_back(hours=h)} AND {C8}", f"pair_runs_{h}h")


def _all_pair_runs() -> str:
    base = f"SELECT DISTINCT {P} FROM actions WHERE {_back(7)} AND {C8}"
    return _join(base, [(_pair_runs(h), P) for h in RUN_HOURS], f"{P}, " + ", ".join(PAIR_RUNS))


def _last_types() -> str:
    cols = ", ".join(
        f"coalesce(min({AGE}) FILTER (type = {t}), 0) AS pair_last_{t}" for t in (2, 3, 5)
    )
    return f"""SELECT *, CASE WHEN pair_last_2 > pair_last_3 THEN 1 ELSE 0 END AS pair_delcart_later
        FROM (SELECT {P}, {cols} FROM actions WHERE {FULL} AND {C8} GROUP BY {P})"""


def _cart_share() -> str:
    carts = "count(*) FILTER (type = 2)"
    return f"""SELECT {P}, {_zero_one('p', 'u')} AS pair_cart_share
        FROM (SELECT {P}, {carts} AS p FROM actions WHERE {FULL} AND {C8} GROUP BY {P})
        LEFT JOIN (SELECT user_id, {carts} AS u FROM actions WHERE {FULL} GROUP BY user_id)
        USING (user_id)"""


def _pair_browse_click() -> str:
    return f"""SELECT {P}, {_zero_one('c1', 'c6')} AS pair_browse_click_7d
        FROM ({_counts(P, f'{_back(7)} AND {C8}', (1, 6), 'c{t}')})"""


PAIR_INTS = (
    SPAN_COLS
    + PAIR_DAY_INTS
    + [f"pair_has_{t}" for t in (2, 3, 5)]
    + COUNT_COLS
    + TOTAL_INTS
    + PAIR_DWELL_INTS
    + PAIR_RUNS
    + LAST_COLS
)
PAIR_DOUBLES = (
    PAIR_DAY_RATIOS
    + ["pair_decay"]
    + TOTAL_RATIOS
    + PAIR_DWELL_RATIOS
    + ["pair_browse_click_7d"]
    + [f"pair_decay_{t}" for t in NON_BUY]
    + ["pair_cart_share"]
)


def _pair_blocks() -> list[tuple[str, str]]:
    flags = ", ".join(
        f"CASE WHEN count(*) FILTER (type = {t}) > 0 THEN 1 ELSE 0 END AS pair_has_{t}" for t in (2, 3, 5)
    )
    blocks = [
        _spans(),
        _pair_days(),
        f"SELECT {P}, coalesce(sum(weight), 0) AS pair_decay FROM weighted WHERE {_back(28)} GROUP BY {P}",
        f"SELECT {P}, {flags} FROM actions WHERE {FULL} GROUP BY {P}",
        *[_pair_counts(h) for h in HOURS],
        *[_pair_total(d) for d in TOTAL_DAYS],
        *[_pair_dwell(d) for d in SEQ_DAYS],
        _pair_browse_click(),
        *[_pair_runs(h) for h in RUN_HOURS],
        _last_types(),
        _decays(P, _back(28), NON_BUY, "pair_decay_{t}"),
        _cart_share(),
    ]
    return [(b, P) for b in blocks]


BRAND_DAYS = (1, 3, 5, 7, 10, 14, 28)
BRAND_COLS = [f"brand_share_{d}d" for d in BRAND_DAYS]


def _brand_share(d: int) -> str:
    return f"""SELECT user_id, brand, {_zero_one('ub', 'u')} AS brand_share_{d}d
        FROM ({_total('user_id, brand', _back(d), 'ub')})
        LEFT JOIN ({_user_total(_back(d), 'u')}) USING (user_id)"""


def _all_brand_shares() -> str:
    base = f"SELECT DISTINCT user_id, brand FROM actions WHERE {_back(28)}"
    blocks = [(_brand_share(d), "user_id, brand") for d in BRAND_DAYS]
    return _join(base, blocks, "user_id, brand, " + ", ".join(BRAND_COLS))


def _item_features(base: str) -> str:
    flagged = f"SELECT *, CASE WHEN sku_id IN ({_top('sku_id')}) THEN 1 ELSE 0 END AS top_item FROM {base}"
    blocks = [(_attributes(), "sku_id"), (_comments(T_END), "sku_id"), (_flows(), "sku_id")]
    # Item attributes belong to items seen in the window, which every candidate item is.
    return _join(flagged, blocks, "*")


def _brand_features(base: str) -> str:
    flagged = f"SELECT *, CASE WHEN brand IN ({_top('brand')}) THEN 1 ELSE 0 END AS top_brand FROM {base}"
    return _join(flagged, [(_brand_rates(), "brand")], "*")


ITEM_INTS = ATTR_COLS + COMMENT_COLS + ["top_item"]
ITEM_DOUBLES = FLOW_COLS + ["bad_comment_rate"]
SKU_INTS = PAIR_INTS + ITEM_INTS + ["top_brand"]
SKU_DOUBLES = PAIR_DOUBLES + BRAND_COLS + ITEM_DOUBLES + ["brand_bad_rate"] + SALE_COLS
KEYS4 = ["user_id", "sku_id", "cate", "brand"]


def _sku_features() -> str:
    base = _brand_features(f"({_item_features('cand_pairs')})")
    blocks = [(_brand_share(d), "user_id, brand") for d in BRAND_DAYS]
    joined = _join(base, _pair_blocks() + blocks + [(_sales(), "sku_id")], "*")
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in SKU_INTS + SKU_DOUBLES)
    return f"SELECT {', '.join(KEYS4)}, label, {filled} FROM ({joined})"


def _training_table() -> str:
    names = USER_INTS + USER_DOUBLES
    prefixed = ", ".join(f"{c} AS user__{c}" for c in names)
    users = f"SELECT user_id, {prefixed} FROM ({_user_features()})"
    return _join(_sku_features(), [(users, "user_id")], "*")


# --- the rest ----------------------------------------------------------------------------------


def _login_days() -> list[date]:
    n = (T_END - T_START).days
    return [(T_START + timedelta(days=i)).date() for i in range(n)]


def _split_query() -> str:
    parts = []
    for back, name in ((2, "valid"), (1, "train"), (0, "online")):
        end = T_END - timedelta(days=back * cfg.SPLIT_STEP_DAYS)
        recent = f"{_win(end - timedelta(days=7), end)} AND {C8}"
        label = "CAST(NULL AS BIGINT)"
        if back:
            bought = f"{_win(end, end + timedelta(days=cfg.SPLIT_LABEL_DAYS))} AND type = 4"
            label = f"""CASE WHEN user_id IN (SELECT user_id FROM actions WHERE {bought}
                AND sku_id IN (SELECT sku_id FROM products)
                AND user_id IN (SELECT user_id FROM users)) THEN 1 ELSE 0 END"""
        parts.append(
            f"""SELECT '{name}' AS split, user_id, {label} AS label
            FROM (SELECT DISTINCT user_id FROM actions WHERE {recent})
            WHERE user_id NOT IN (SELECT user_id FROM actions WHERE {recent} AND type = 4)"""
        )
    return " UNION ALL ".join(parts)


def _split_keys(keys: str, back: int) -> str:
    """Candidates of the split that ends `back` steps early, each with a probability."""
    end = T_END - timedelta(days=back * cfg.SPLIT_STEP_DAYS)
    recent = f"{_win(end - timedelta(days=7), end)} AND {C8}"
    return f"""SELECT DISTINCT {keys}, true AS is_probability FROM actions WHERE {recent}
        AND user_id NOT IN (SELECT user_id FROM actions WHERE {recent} AND type = 4)"""


def _eval(board: str | None = None) -> tuple[str, str]:
    """F11 and F12 as one-row queries with precision and recall."""
    real = "eval_sub" if board is None else f"(SELECT * FROM eval_sub WHERE board = '{board}')"
    f11 = f"""SELECT p AS f11_precision, r AS f11_recall, 6 * p * r / nullif(5 * r + p, 0) AS f11 FROM (
        SELECT hits / preds AS p, hits / nullif(reals, 0) AS r FROM (
          SELECT (SELECT count(*) FROM submission WHERE user_id IN (SELECT user_id FROM {real})) AS hits,
                 (SELECT count(*) FROM submission) AS preds, (SELECT count(*) FROM {real}) AS reals))"""
    f12 = f"""SELECT p AS f12_precision, r AS f12_recall, 5 * p * r / nullif(2 * r + 3 * p, 0) AS f12
        FROM (SELECT hits / preds AS p, hits / nullif(reals, 0) AS r FROM (
          SELECT (SELECT count(*) FROM submission JOIN {real} x USING (user_id, sku_id)) AS hits,
                 (SELECT count(*) FROM submission) AS preds, (SELECT count(*) FROM {real}) AS reals))"""
    return f11, f12


def _score(board: str | None = None) -> str:
    f11, f12 = _eval(board)
    name = "" if board is None else f"'{board}' AS board, "
    return f"""SELECT {name}f11, f12, 0.4 * f11 + 0.6 * f12 AS score
        FROM (SELECT (SELECT f11 FROM ({f11})) AS f11, (SELECT f12 FROM ({f12})) AS f12)"""


def oracle_sql() -> dict[str, str]:
    cnt = [f"cnt_{t}" for t in TYPES]
    has = [f"has_{t}" for t in TYPES]
    dec = [f"decay_{t}" for t in TYPES]
    rat = [f"ratio_{t}" for t in TYPES]
    tz = [f"tz_{z}" for z in range(4)]
    U, UI, UC, UB = ["user_id"], ["user_id", "sku_id"], ["user_id", "cate"], ["user_id", "brand"]
    UIC = ["user_id", "sku_id", "cate"]
    out: dict[str, str] = {}

    def add(name, needs, body, ints=(), doubles=(), raw=()):
        out[name] = _sql(needs, body, ints, doubles, raw)

    def keyed(keys: list[str]) -> str:
        return ", ".join(keys)

    clock = "strftime(time, '%Y-%m-%d %H:%M:%S') AS time"
    add(
        "ingest_actions",
        "actions",
        f"SELECT user_id, sku_id, {clock}, model_id, type, cate, brand, time_zone FROM actions",
        ["user_id", "sku_id", "model_id", "type", "cate", "brand", "time_zone"],
        raw=["time"],
    )
    add(
        "window_scan",
        "actions",
        f"SELECT user_id, sku_id, {clock}, type, cate, brand FROM actions a WHERE {_win_a()}",
        ["user_id", "sku_id", "type", "cate", "brand"],
        raw=["time"],
    )
    for name, keys in {
        "user_action_cnt": U,
        "ui_action_cnt": UIC,
        "uc_action_cnt": UC,
        "item_action_cnt": ["sku_id"],
        "ub_action_cnt": UB,
        "brand_action_cnt": ["brand"],
        "bc_action_cnt": ["brand", "cate"],
    }.items():
        add(name, "actions", _counts(keyed(keys), FULL), keys + cnt)
    for name, keys, where in (
        ("user_timezone_cnt", U, FULL),
        ("uc_timezone_cnt", UC, f"{FULL} AND {C8}"),
        ("ui_timezone_cnt", UI, FULL),
    ):
        cols = ", ".join(f"count(*) FILTER (time_zone = {z}) AS tz_{z}" for z in range(4))
        k = keyed(keys)
        add(name, "actions", f"SELECT {k}, {cols} FROM actions WHERE {where} GROUP BY {k}", keys + tz)
    days = _login_days()
    cols = ", ".join(
        f"max(CASE WHEN CAST(time AS DATE) = DATE '{d}' THEN 1 ELSE 0 END) AS \"login_{d}\"" for d in days
    )
    add(
        "user_login_matrix",
        "actions",
        f"SELECT user_id, {cols} FROM actions WHERE {FULL} GROUP BY user_id",
        U + [f"login_{d}" for d in days],
    )

    add("user_total_cnt", "actions", _user_total(FULL, "total_cnt"), U + ["total_cnt"])
    for name, keys in {"ui_total_cnt": UIC, "uc_total_cnt": UC, "ub_total_cnt": UB}.items():
        add(name, "actions", _total(keyed(keys), FULL, "total_cnt"), keys + ["total_cnt"])
    add(
        "user_total_decay",
        "weighted",
        f"""SELECT user_id, coalesce(sum(weight) FILTER (type IN (1, 6)), 0) AS total_decay
        FROM weighted WHERE {FULL} GROUP BY user_id""",
        U,
        ["total_decay"],
    )
    for name, keys in {"uc_total_decay": UC, "ui_total_decay": UI}.items():
        k = keyed(keys)
        body = f"SELECT {k}, coalesce(sum(weight), 0) AS total_decay FROM weighted WHERE {FULL} GROUP BY {k}"
        add(name, "weighted", body, keys, ["total_decay"])
    for name, keys in {"ui_action_bool": UI, "uc_action_bool": UC, "ub_action_bool": UB}.items():
        flags = ", ".join(f"CASE WHEN cnt_{t} > 0 THEN 1 ELSE 0 END AS has_{t}" for t in TYPES)
        k = keyed(keys)
        add(name, "actions", f"SELECT {k}, {flags} FROM ({_counts(k, FULL)})", keys + has)

    add("decay_curve", "curve", "SELECT * FROM curve", ["time_dist"], ["weight"])
    for name, keys in {
        "user_action_cnt_decay": U,
        "ui_action_cnt_decay": UIC,
        "uc_action_cnt_decay": UC,
    }.items():
        add(name, "weighted", _decays(keyed(keys), FULL), keys, dec)

    conv = ", ".join(f"{_or_one('cnt_4', f'cnt_{t}')} AS buy_per_{t}" for t in NON_BUY)
    add(
        "buy_conversion",
        "actions",
        f"SELECT user_id, {conv} FROM ({_counts('user_id', FULL)})",
        U,
        [f"buy_per_{t}" for t in NON_BUY],
    )
    add("user_window_ratio", "actions", _window_ratio("user_id"), U, rat)
    add("ui_window_ratio", "actions", _window_ratio("user_id, sku_id"), UI, rat)
    add("uc_window_ratio", "actions", _window_ratio("user_id, cate", C8), UC, rat)
    shares = ", ".join(f"CAST(s{t} AS DOUBLE) / nullif(a{t}, 0) AS ratio_{t}" for t in TYPES)
    add(
        "uc_all_ratio",
        "actions",
        f"""SELECT user_id, cate, {shares}
        FROM ({_counts('user_id, cate', f'{SUB} AND {C8}', name='s{t}')})
        LEFT JOIN ({_counts('user_id', FULL, name='a{t}')}) USING (user_id)""",
        UC,
        rat,
    )
    shares = ", ".join(f"{_or_one(f'p{t}', f'c{t}')} AS share_{t}" for t in TYPES)
    add(
        "ui_uc_share",
        "actions",
        f"""SELECT user_id, sku_id, {shares}
        FROM ({_counts('user_id, sku_id, cate', FULL, name='p{t}')})
        LEFT JOIN ({_counts('user_id, cate', FULL, name='c{t}')}) USING (user_id, cate)""",
        UI,
        [f"share_{t}" for t in TYPES],
    )

    add("user_active_days", "actions", _days("user_id", FULL, "day_cnt"), U + ["day_cnt"])
    add("ui_active_days", "actions", _days("user_id, sku_id", FULL, "day_cnt"), UI + ["day_cnt"])
    add("uc_active_days", "actions", _days("user_id, cate", f"{FULL} AND {C8}", "day_cnt"), UC + ["day_cnt"])
    for name, keys, column, alias, where in (
        ("user_cate_nitem", UC, "sku_id", "item_cnt", f"{FULL} AND {C8}"),
        ("item_people_flow", ["sku_id"], "user_id", "user_cnt", FULL),
        ("brand_people_flow", ["brand"], "user_id", "user_cnt", FULL),
        ("ui_model_clicks", UI, "model_id", "model_cnt", f"{FULL} AND model_id IS NOT NULL"),
    ):
        k = keyed(keys)
        body = f"SELECT {k}, count(DISTINCT {column}) AS {alias} FROM actions WHERE {where} GROUP BY {k}"
        add(name, "actions", body, keys + [alias])
    cols = ", ".join(f"count(DISTINCT sku_id) FILTER (type = {t}) AS items_{t}" for t in TYPES)
    add(
        "uc_distinct_items",
        "actions",
        f"SELECT user_id, cate, {cols} FROM actions WHERE {FULL} GROUP BY user_id, cate",
        UC + [f"items_{t}" for t in TYPES],
    )
    add(
        "uc_only_cate",
        "actions",
        f"""SELECT user_id, {cfg.CATE} AS cate, CASE WHEN n = 1 THEN 1 ELSE 0 END AS only_cate FROM (
        SELECT user_id, count(DISTINCT cate) AS n, count(*) FILTER ({C8}) AS hits
        FROM actions WHERE {SUB} GROUP BY user_id) WHERE hits > 0""",
        UC + ["only_cate"],
    )
    add(
        "icb_table",
        "actions",
        f"SELECT DISTINCT sku_id, cate, brand FROM actions WHERE {FULL}",
        ["sku_id", "cate", "brand"],
    )

    for name, keys, which, alias, where in (
        ("user_first_dist", U, "max", "first_dist", FULL),
        ("user_last_dist", U, "min", "last_dist", FULL),
        ("ui_first_dist", UI, "max", "first_dist", FULL),
        ("ui_last_dist", UI, "min", "last_dist", FULL),
        ("uc_last_dist", UC, "min", "last_dist", f"{FULL} AND {C8}"),
        ("uc_type_last_dist", UC, "min", "last_dist", f"{FULL} AND {C8} AND type = 2"),
    ):
        add(name, "actions", _dist(keyed(keys), where, alias, which), keys + [alias])
    cols = ", ".join(f"min({AGE}) FILTER (type = {t}) AS last_dist_{t}" for t in TYPES)
    add(
        "ui_type_last_dist",
        "actions",
        f"SELECT {P}, {cols} FROM actions WHERE {FULL} GROUP BY {P}",
        UI + [f"last_dist_{t}" for t in TYPES],
    )
    add(
        "uc_type_second_dist",
        "actions",
        f"""SELECT user_id, cate, {AGE} AS second_dist FROM (
        SELECT *, dense_rank() OVER (PARTITION BY user_id, cate ORDER BY time DESC) AS r
        FROM (SELECT DISTINCT user_id, cate, time FROM actions WHERE {FULL} AND {C8} AND type = 2))
        WHERE r = 2""",
        UC + ["second_dist"],
    )
    add("user_base_feat", "users", _user_base(), ["user_id", "user_lv_cd", "reg_days"])

    for name, keys, gap in (
        ("user_dwell", U, cfg.MAX_GAP),
        ("ui_dwell", UI, cfg.MAX_GAP),
        ("uc_dwell", UC, cfg.MAX_GAP),
        ("user_dwell_180s", U, 180),
    ):
        add(name, "actions", _dwell(keyed(keys), FULL, "dwell", gap), keys + ["dwell"])
    add("ui_visit_runs", "actions", _runs(FULL, "runs"), UI + ["runs"])
    add(
        "user_visit_runs",
        "actions",
        f"""SELECT user_id, cate_runs, total_runs, {_zero_one('cate_runs', 'total_runs')} AS run_ratio
        FROM ({_runs(f'{FULL} AND {C8}', 'cate_runs', 'user_id')})
        LEFT JOIN ({_runs(FULL, 'total_runs', 'user_id')}) USING (user_id)""",
        U + ["cate_runs", "total_runs"],
        ["run_ratio"],
    )
    add("user_max_burst", "actions", _bursts(), U + ["max_burst"])
    add("user_mean_burst", "actions", _bursts(), U, ["mean_burst"])

    add("label_pairs", "actions", f"SELECT DISTINCT {P} FROM actions WHERE {LABEL} AND type = 4", UI)
    add("label_pairs_sub", "label_known", "SELECT * FROM label_known", UI)
    add(
        "eval_split",
        "actions",
        f"""SELECT {P}, CASE WHEN row_number() OVER (ORDER BY md5(concat(user_id, ':', sku_id)))
        <= floor(n * 0.5) THEN 'B' ELSE 'A' END AS board
        FROM (SELECT *, count(*) OVER () AS n FROM
              (SELECT DISTINCT {P} FROM actions WHERE {LABEL} AND type = 4))""",
        UI,
        raw=["board"],
    )
    add("eval_split_sub", "eval_sub", "SELECT * FROM eval_sub", UI, raw=["board"])
    add("candidate_users", "cand_users", "SELECT * FROM cand_users", U + ["label"])
    add("candidate_pairs", "cand_pairs", "SELECT * FROM cand_pairs", KEYS4 + ["label"])
    add("rule_users", ("actions", "users"), _rule(1.0, 2, 2, True), U)
    add("rule_users_loose", ("actions", "users"), _rule(0.3, 0, 2, True), U)
    add("rule_users_v1", ("actions", "users"), _rule(0.3, 0, None, False), U)
    add(
        "one_day_buyers",
        "actions",
        f"""SELECT user_id FROM ({_days('user_id', _back(3), 'n')}) WHERE n = 1
        AND user_id IN (SELECT user_id FROM actions WHERE {_back(3)} AND type = 4)""",
        U,
    )

    add(
        "comment_asof",
        "comments",
        _comments(cfg.COMMENT_END),
        ["sku_id"] + COMMENT_COLS,
        ["bad_comment_rate"],
    )
    add("item_attr_onehot", "products", _attributes(), ["sku_id"] + ATTR_COLS)
    for name, key, flag in (
        ("top_items_flag", "sku_id", "top_item"),
        ("top_brands_flag", "brand", "top_brand"),
    ):
        body = f"SELECT *, CASE WHEN {key} IN ({_top(key)}) THEN 1 ELSE 0 END AS {flag} FROM cand_pairs"
        add(name, "cand_pairs", body, KEYS4 + [flag])
    add("item_flow_ratio", "actions", _flows(), ["sku_id"], FLOW_COLS)
    add("brand_bad_rate", ("actions", "comments"), _brand_rates(), ["brand"], ["brand_bad_rate"])
    add("icb_sale_ratio", "actions", _sales(), ["sku_id"], SALE_COLS)

    flows = " UNION ALL ".join(
        f"""SELECT sku_id, '{label}' AS span, true AS near, count(DISTINCT user_id) AS exact FROM actions
        WHERE {where} GROUP BY sku_id"""
        for label, where in (("all", FULL), ("week", SUB))
    )
    add("item_flow_sketched", "actions", flows, ["sku_id", "exact"], raw=["span", "near"])

    feature_needs = ("cand_users", "users", "weighted")
    add("user_features", feature_needs, _user_features(), U + ["label"] + USER_INTS, USER_DOUBLES)
    add("user_day_ratios", "actions", _day_ratios(), U + DAY_COLS, DAY_RATIOS)
    add("user_cate_attention", "actions", _attention(), U + ATTENTION_COLS, ATTENTION_RATIOS)
    base = f"SELECT DISTINCT user_id FROM actions WHERE {SUB} AND {C8}"
    add(
        "user_dwell_ratios",
        "actions",
        _join(base, [(_user_dwells(d), "user_id") for d in SEQ_DAYS], "*"),
        U + DWELL_INTS,
        DWELL_RATIOS,
    )
    add("uc_daily_means", "actions", _daily_means(), U, MEAN_COLS)
    add("other_cate_bought", "actions", _other_bought(), U + ["other_cates_bought_7d"])
    add("uc_browse_click", "actions", _browse_click(), U, ["cate_browse_click_15d"])
    add(
        "pair_features",
        ("cand_pairs", "weighted"),
        _join("SELECT * FROM cand_pairs", _pair_blocks(), "*"),
        KEYS4 + ["label"] + PAIR_INTS,
        PAIR_DOUBLES,
    )
    add("ui_span", "actions", _spans(), UI + SPAN_COLS)
    add("ui_day_ratios", "actions", _pair_days(), UI + PAIR_DAY_INTS, PAIR_DAY_RATIOS)
    counted = [f"cnt_{t}_{h}h" for h in HOURS for t in NON_BUY]
    renamed = ", ".join(f"pair_{c} AS {c}" for c in counted)
    add(
        "ui_multi_window_cnt",
        "actions",
        f"SELECT {P}, {renamed} FROM ({_all_pair_counts()})",
        UI + counted,
    )
    add("ui_uc_totals", "actions", _all_pair_totals(), UI + TOTAL_INTS, TOTAL_RATIOS)
    add("ui_dwell_ratios", "actions", _all_pair_dwells(), UI + PAIR_DWELL_INTS, PAIR_DWELL_RATIOS)
    add("ui_runs_multi", "actions", _all_pair_runs(), UI + PAIR_RUNS)
    add("ui_delcart_later", "actions", _last_types(), UI + LAST_COLS)
    add("ui_cart_share", "actions", _cart_share(), UI, ["pair_cart_share"])
    add("ui_browse_click", "actions", _pair_browse_click(), UI, ["pair_browse_click_7d"])
    add("ub_share", "actions", _all_brand_shares(), UB, BRAND_COLS)
    item_needs = ("cand_pairs", "products", "comments")
    add("item_features", item_needs, _item_features("cand_pairs"), KEYS4 + ITEM_INTS, ITEM_DOUBLES)
    add(
        "brand_features",
        ("cand_pairs", "comments"),
        _brand_features("cand_pairs"),
        KEYS4 + ["top_brand"],
        ["brand_bad_rate"],
    )
    sku_needs = ("cand_pairs", "weighted", "products", "comments")
    add("sku_features", sku_needs, _sku_features(), KEYS4 + ["label"] + SKU_INTS, SKU_DOUBLES)
    add(
        "training_table",
        sku_needs + feature_needs,
        _training_table(),
        KEYS4 + ["label"] + SKU_INTS + [f"user__{c}" for c in USER_INTS],
        SKU_DOUBLES + [f"user__{c}" for c in USER_DOUBLES],
    )
    out["user_features_bucketed"] = out["user_features_csv"] = out["user_features"]
    out["user_split_table"] = _all_splits(feature_needs, _user_features(), U + ["label"] + USER_INTS, USER_DOUBLES)
    out["pair_split_table"] = _all_splits(
        sku_needs + feature_needs,
        _training_table(),
        KEYS4 + ["label"] + SKU_INTS + [f"user__{c}" for c in USER_INTS],
        SKU_DOUBLES + [f"user__{c}" for c in USER_DOUBLES],
    )
    add(
        "rolling_splits",
        ("actions", "users", "products"),
        _split_query(),
        ["user_id", "label"],
        raw=["split"],
    )

    add("argmax_item", "best", "SELECT * FROM best", UI, ["score"])
    add("fuse_submission", "submission", "SELECT * FROM submission", UI)
    f11, f12 = _eval()
    needs = ("submission", "eval_sub")
    add("eval_f11", needs, f11, doubles=["f11_precision", "f11_recall", "f11"])
    add("eval_f12", needs, f12, doubles=["f12_precision", "f12_recall", "f12"])
    add("eval_score", needs, _score(), doubles=["f11", "f12", "score"])
    boards = f"{_score('A')} UNION ALL {_score('B')}"
    add("eval_score_ab", needs, boards, doubles=["f11", "f12", "score"], raw=["board"])
    for name, keys, back in (
        ("train_user_model", U, 1),
        ("score_users", U, 0),
        ("train_sku_model", UI, 1),
        ("score_pairs", UI, 0),
    ):
        add(name, "actions", _split_keys(keyed(keys), back), keys, raw=["is_probability"])
    add(
        "cv_best_rounds",
        "actions",
        f"""SELECT r AS round, true AS has_loss FROM range(1, {cfg.MODEL_ROUNDS + 1}) t(r)
        WHERE EXISTS (SELECT 1 FROM actions)""",
        ["round"],
        raw=["has_loss"],
    )
    add(
        "stopped_rounds",
        "actions",
        f"""SELECT count(*) > 1 AS several_folds, count(*) > 1 AS in_range, count(*) > 1 AS stopped
        FROM ({_split_keys('user_id', 1)})""",
        raw=["several_folds", "in_range", "stopped"],
    )
    add(
        "submission_facts",
        "cand_pairs",
        """SELECT true AS one_per_user, true AS all_candidates, true AS full_lists, count(DISTINCT user_id) AS users
        FROM cand_pairs""",
        ["users"],
        raw=["one_per_user", "all_candidates", "full_lists"],
    )
    points = [(i, math.prod(map(len, grid.values()))) for i, grid in enumerate(cfg.SEARCH_GRIDS, 1)]
    add(
        "staged_search",
        "actions",
        f"""SELECT *, true AS is_area FROM (VALUES {', '.join(map(str, points))}) t(stage, points)
        WHERE EXISTS (SELECT 1 FROM actions)""",
        ["stage", "points"],
        raw=["is_area"],
    )
    add(
        "topic_features",
        "actions",
        f"SELECT DISTINCT user_id, 1.0 AS topic_sum FROM actions WHERE {FULL}",
        U,
        doubles=["topic_sum"],
    )
    return out


def _win_a() -> str:
    """The full window on the table's own column where the output renames it."""
    return FULL.replace("time >=", "a.time >=").replace("time <", "a.time <")
