"""The queries in DuckDB SQL over the same tables, from shared named parts."""

from __future__ import annotations

import re

from tidewatch.plans import detector_sql

MARKET = """SELECT {entity} AS coin_id, CAST({date} AS DATE) AS date,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS price,
  20 * CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS market_cap,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS volume
  FROM {tables} GROUP BY ALL"""
FLAGGED = """SELECT coin_id, date, price, market_cap, volume, prev_price, r AS log_return,
  coalesce(coalesce(abs(r) > ln(10), (price = 0) <> (prev_price = 0)), false) AS extreme_move, volume = 0 AS zero_volume,
  coalesce(volume < 0.05 * vb AND volume < 0.05 * va, false) AS volume_glitch,
  CAST(date_diff('day', db, date) - 1 AS INTEGER) AS missing_days_before
  FROM (SELECT *, CASE WHEN price > 0 AND prev_price > 0 THEN ln(price / prev_price) END AS r FROM (
    SELECT *, lag(price) OVER w AS prev_price, lag(volume) OVER w AS vb, lead(volume) OVER w AS va, lag(date) OVER w AS db
    FROM {of} WINDOW w AS (PARTITION BY coin_id ORDER BY date)))"""
QUALITY = """SELECT *, CAST(date_diff('day', first_date, last_date) + 1 - days AS BIGINT) AS missing_days,
  CASE WHEN extreme_moves > 1 THEN 'feed_glitch' WHEN zero_volume_days / days > 0.2 THEN 'stale_feed' ELSE 'ok' END AS status
  FROM (SELECT coin_id, count(*) AS days, min(date) AS first_date, max(date) AS last_date,
    count(*) FILTER (extreme_move) AS extreme_moves, count(*) FILTER (zero_volume) AS zero_volume_days,
    count(*) FILTER (volume_glitch) AS volume_glitch_days FROM {of} GROUP BY coin_id)"""
RETURNS = """SELECT date, median(log_return) AS market_return FROM {of}
  WHERE log_return IS NOT NULL AND NOT extreme_move AND coalesce(missing_days_before, 0) = 0 GROUP BY date"""
SIZED = "SELECT coin_id, count(*) AS n FROM {of} GROUP BY coin_id HAVING count(*) > 41"
SITES = """SELECT f.coin_id, f.date, p.type, p.sign FROM (SELECT coin_id, date, row_number() OVER (PARTITION BY coin_id ORDER BY date) - 1 AS place FROM {of}) f
  JOIN (SELECT coin_id, 40 + h_row % (n - 40) AS place, ['price_spike', 'volume_spike', 'combo'][1 + (row_number() OVER (ORDER BY h_turn, coin_id) - 1) % 3] AS type,
    CASE WHEN h_sign % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign
    FROM (SELECT *, CAST('0x' || substr(md5('2026|row|' || coin_id), 1, 7) AS BIGINT) AS h_row,
      CAST('0x' || substr(md5('2026|turn|' || coin_id), 1, 7) AS BIGINT) AS h_turn,
      CAST('0x' || substr(md5('2026|sign|' || coin_id), 1, 7) AS BIGINT) AS h_sign FROM {sized})) p USING (coin_id, place)"""
SCALES = """SELECT *, coalesce(greatest(1.4826 * mad(log_return) OVER b, 0.005), 0.005) AS sr,
  coalesce(greatest(1.4826 * mad(ln(1 + volume)) OVER b, 0.1), 0.1) AS sv
  FROM {of} WINDOW b AS (PARTITION BY coin_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""
PAST = "(PARTITION BY {by} ORDER BY {on} RANGE BETWEEN INTERVAL {n} DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)"


def _z(x: str) -> str:
    return f"CASE WHEN stddev_samp({x}) OVER w > 1e-12 THEN ({x} - avg({x}) OVER w) / stddev_samp({x}) OVER w END"


def _rz(x: str, floor: float) -> str:
    return f"CASE WHEN count({x}) OVER w >= 20 THEN ({x} - median({x}) OVER w) / greatest(1.4826 * mad({x}) OVER w, {floor}) END"


TOKEN_Z = {
    "transfers_z": "ln(1 + transfers)",
    "amount_z": "ln(1 + amount_total)",
    "addresses_z": "ln(1 + unique_addresses)",
    "rt_share_z": "rt_share",
    "tpa_z": "transfers_per_address",
    "concentration_z": "top10_sender_share",
    "large_transfers_z": "large_transfers",
}
ROBUST = ("rz_return", "rz_volume", "rz_turnover", "rz_residual")
USED = ("transfers_z", "addresses_z", "rt_share_z", "tpa_z", "concentration_z", "large_transfers_z")

PARTS: dict[str, str] = {
    "market": MARKET.format(entity="l_returnflag", date="l_shipdate", tables="lineitem"),
    "wide": MARKET.format(
        entity="p_brand", date="o_orderdate", tables="lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
    ),
    "flagged": FLAGGED.format(of="market"),
    "wide_flagged": FLAGGED.format(of="wide"),
    "verdict": QUALITY.format(of="flagged"),
    "wide_verdict": QUALITY.format(of="wide_flagged"),
    "clean": "SELECT * FROM flagged WHERE coin_id IN (SELECT coin_id FROM verdict WHERE status = 'ok') AND NOT volume_glitch",
    "wide_clean": "SELECT * FROM wide_flagged WHERE coin_id IN (SELECT coin_id FROM wide_verdict WHERE status = 'ok') AND NOT volume_glitch",
    "returns": RETURNS.format(of="flagged"),
    "wide_returns": RETURNS.format(of="wide_flagged"),
    "daily": """SELECT coin_id, date, price, market_cap, volume, extreme_move, market_return,
  CASE WHEN coalesce(missing_days_before, 0) = 0 THEN log_return END AS log_return
  FROM flagged LEFT JOIN returns USING (date)""",
    "moments": f"""SELECT *, count(log_return) OVER w AS n_history, stddev_samp(log_return) OVER w AS spread,
  avg(log_return * m) OVER w - avg(log_return) OVER w * avg(m) OVER w AS cov,
  avg(log_return * log_return) OVER w - pow(avg(log_return) OVER w, 2) AS vr, avg(m * m) OVER w - pow(avg(m) OVER w, 2) AS vm,
  {_z("log_return")} AS rz, {_z("lv")} AS vz, {_z("lt")} AS tz
  FROM (SELECT *, CASE WHEN log_return IS NOT NULL THEN market_return END AS m, ln(1 + volume) AS lv,
    CASE WHEN market_cap > 0 AND volume > 0 THEN ln(volume / market_cap) END AS lt FROM daily)
  WINDOW w AS {PAST.format(by="coin_id", on="date", n=30)}""",
    "features": """SELECT coin_id, date, price, market_cap, volume, log_return, extreme_move, market_return, n_history,
  CASE WHEN n_history >= 20 THEN rz END AS return_z, CASE WHEN n_history >= 20 THEN vz END AS volume_z,
  CASE WHEN n_history >= 20 THEN tz END AS turnover_z, CASE WHEN n_history >= 20 THEN corr END AS market_corr,
  CASE WHEN n_history >= 20 THEN beta END AS market_beta, CASE WHEN n_history >= 20 THEN res END AS residual_return,
  CASE WHEN n_history >= 20 AND own > 1e-12 THEN res / own END AS residual_z,
  CASE WHEN n_history >= 20 THEN vz - abs(rz) END AS volume_price_gap
  FROM (SELECT *, log_return - beta * market_return AS res, spread * sqrt(greatest(0.0, 1 - corr * corr)) AS own FROM (
    SELECT *, CASE WHEN vr > 1e-12 AND vm > 1e-12 THEN cov / sqrt(vr * vm) END AS corr, CASE WHEN vm > 1e-12 THEN cov / vm END AS beta
    FROM moments))""",
    "robust": f"""SELECT *, {_rz("log_return", 0.005)} AS rz_return, {_rz("lv", 0.1)} AS rz_volume, {_rz("lt", 0.1)} AS rz_turnover,
  {_rz("residual_return", 0.005)} AS rz_residual
  FROM (SELECT *, ln(1 + volume) AS lv, CASE WHEN market_cap > 0 AND volume > 0 THEN ln(volume / market_cap) END AS lt FROM features)
  WINDOW w AS {PAST.format(by="coin_id", on="date", n=30)}""",
    "model_rows": """SELECT * REPLACE (coalesce(rz_turnover, 0.0) AS rz_turnover) FROM robust
  WHERE rz_return IS NOT NULL AND rz_volume IS NOT NULL AND rz_residual IS NOT NULL""",
    "zscored": """SELECT *, row_number() OVER (ORDER BY zscore_score DESC, coin_id, date)
    <= greatest(1, round_even(count(*) OVER () * 0.01, 0)) AS zscore_flag
  FROM (SELECT *, round(greatest(abs(rz_return), abs(rz_volume), abs(rz_turnover), abs(rz_residual)), 9) AS zscore_score FROM model_rows)""",
    "pegs": "SELECT coin_id, median(abs(log_return)) AS typical_move FROM clean GROUP BY coin_id",
    "odd": """SELECT *, volume / market_cap AS turnover FROM clean WHERE market_cap > 0 AND volume > 0.052 * market_cap
  AND abs(exp(log_return) - 1) < 0.05 AND coin_id NOT IN (SELECT coin_id FROM pegs WHERE typical_move < 0.002)""",
    "transfers": """SELECT token, CAST(event_id AS VARCHAR) AS tx_hash, 0 AS tx_seq, date_trunc('second', ts) AS block_time, f AS from_address,
  t AS to_address, value AS amount, CASE user_id % 3 WHEN 0 THEN 'swapExactTokensForTokens(uint256)' WHEN 1 THEN 'transfer(address,uint256)'
    ELSE '' END AS function_name, CAST(date_trunc('second', ts) AS DATE) AS day
  FROM (SELECT *, event_type AS token, 'a' || CAST(user_id % 40 AS VARCHAR) AS f,
    lead('a' || CAST(user_id % 40 AS VARCHAR)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS t FROM events)
  WHERE t IS NOT NULL""",
    "labels40": "SELECT 'a' || CAST(i AS VARCHAR) AS address, i % 10 = 0 AS is_contract FROM range(40) r(i) WHERE i % 10 <> 9",
    "sides": "SELECT token, day, from_address AS address FROM transfers UNION ALL SELECT token, day, to_address FROM transfers",
    "rollup_daily": """SELECT *, CAST(day = min(day) OVER (PARTITION BY token) OR day = max(day) OVER (PARTITION BY token) AS INTEGER) AS is_partial_day
  FROM (SELECT token, day, count(*) AS transfers, sum(amount) AS amount_total,
    list_sort(list(amount))[least(count(*), CAST(floor(0.5 * count(*)) AS BIGINT) + 1)] AS amount_median,
    list_sort(list(amount))[least(count(*), CAST(floor(0.99 * count(*)) AS BIGINT) + 1)] AS amount_p99,
    count(DISTINCT from_address) AS unique_senders, count(DISTINCT to_address) AS unique_receivers,
    count(*) FILTER (starts_with(lower(function_name), 'swap')) AS swap_transfers,
    count(*) FILTER (starts_with(lower(function_name), 'transfer')) AS plain_transfers FROM transfers GROUP BY token, day)
  JOIN (SELECT token, day, count(DISTINCT address) AS unique_addresses FROM sides GROUP BY token, day) USING (token, day)""",
    "legs": """SELECT t.* FROM transfers t JOIN labels40 a ON a.address = from_address AND NOT a.is_contract
  JOIN labels40 b ON b.address = to_address AND NOT b.is_contract WHERE from_address <> to_address""",
    "trips": """SELECT * FROM legs l WHERE EXISTS (SELECT 1 FROM legs p WHERE p.token = l.token AND p.from_address = l.to_address
  AND p.to_address = l.from_address AND p.block_time <= l.block_time AND p.block_time >= l.block_time - INTERVAL 7 DAYS)""",
    "hubs": """SELECT token, address, count(DISTINCT other) AS degree FROM (
  SELECT token, from_address AS address, to_address AS other FROM transfers UNION ALL SELECT token, to_address, from_address FROM transfers)
  GROUP BY token, address HAVING count(DISTINCT other) >= 39""",
    "cuts": "SELECT token, quantile_disc(amount, 0.99) AS cut FROM transfers GROUP BY token",
    "activity": """SELECT *, rt_transfers / transfers AS rt_share, CASE WHEN amount_total > 0 THEN rt_amount / amount_total ELSE 0.0 END AS rt_amount_share,
  transfers / unique_addresses AS transfers_per_address, new_addresses / unique_addresses AS new_address_share
  FROM (SELECT b.*, unique_addresses, coalesce(new_addresses, 0) AS new_addresses, top10_sender_share, coalesce(rt_transfers, 0) AS rt_transfers,
    coalesce(rt_amount, 0) AS rt_amount, coalesce(rt_pairs, 0) AS rt_pairs
  FROM (SELECT token, day, count(*) AS transfers, sum(amount) AS amount_total, count(DISTINCT from_address) AS unique_senders,
    count(DISTINCT to_address) AS unique_receivers, count(*) FILTER (amount > cut) AS large_transfers,
    avg(CASE WHEN (token, from_address) IN (SELECT token, address FROM hubs) OR (token, to_address) IN (SELECT token, address FROM hubs)
      THEN 1.0 ELSE 0.0 END) AS hub_share FROM transfers JOIN cuts USING (token) GROUP BY token, day) b
  LEFT JOIN (SELECT token, day, count(DISTINCT address) AS unique_addresses FROM sides GROUP BY token, day) USING (token, day)
  LEFT JOIN (SELECT token, day, count(*) AS new_addresses FROM (SELECT token, address, min(day) AS day FROM sides GROUP BY token, address)
    GROUP BY token, day) USING (token, day)
  LEFT JOIN (SELECT token, day, sum(sent) FILTER (n <= 10) / sum(sent) AS top10_sender_share FROM (
    SELECT *, row_number() OVER (PARTITION BY token, day ORDER BY sent DESC, from_address) AS n FROM (
      SELECT token, day, from_address, sum(amount) AS sent FROM transfers GROUP BY ALL)) GROUP BY token, day) USING (token, day)
  LEFT JOIN (SELECT token, day, count(*) AS rt_transfers, sum(amount) AS rt_amount,
    count(DISTINCT (least(from_address, to_address), greatest(from_address, to_address))) AS rt_pairs FROM trips GROUP BY token, day)
    USING (token, day))""",
    "token_features": "SELECT *, transfers_z - addresses_z AS activity_vs_participants FROM (SELECT *, count(*) OVER w AS n_history, "
    + ", ".join(f"CASE WHEN count(*) OVER w >= 10 THEN {_z(x)} END AS {n}" for n, x in TOKEN_Z.items())
    + " FROM (SELECT * FROM activity QUALIFY day > min(day) OVER (PARTITION BY token) AND day < max(day) OVER (PARTITION BY token))"
    + f" WINDOW w AS {PAST.format(by='token', on='day', n=14)})",
    "pairs": """SELECT * FROM (SELECT token, least(from_address, to_address) AS a, greatest(from_address, to_address) AS b,
  count(*) FILTER (from_address = least(from_address, to_address)) AS ab,
  count(*) FILTER (from_address = greatest(from_address, to_address)) AS ba FROM transfers GROUP BY ALL) WHERE ab >= 1 AND ba >= 1""",
    "snaps": "SELECT coin_id, date, volume, 'snapshot' AS source, 1 AS rank, CAST(date + INTERVAL 1 DAY AS DATE) AS run FROM market",
    "fixes": """SELECT coin_id, date, volume * 2 AS volume, 'reconciled' AS source, 2 AS rank, CAST(date + INTERVAL 7 DAY AS DATE) AS run
  FROM market WHERE dayofweek(date) = 1""",
    "sized": SIZED.format(of="wide_flagged"),
    "sites": SITES.format(of="wide_flagged", sized="sized"),
    "scales": SCALES.format(of="wide_flagged"),
}


ROBUST_ROWS = (
    "SELECT *, "
    + ", ".join(f"{_rz(x, floor)} AS {n}" for n, x, floor in zip(ROBUST, ("log_return", "lv", "lt", "residual_return"), (0.005, 0.1, 0.1, 0.005), strict=True))
    + """ FROM (SELECT *, ln(1 + volume) AS lv, CASE WHEN market_cap > 0 AND volume > 0 THEN ln(volume / market_cap) END AS lt FROM {of}) WINDOW w AS """
    + PAST.format(by="coin_id", on="date", n=30)
)
MODELLED = (
    "SELECT * REPLACE (" + ", ".join(f"round(coalesce({c}, 0.0), 6) AS {c}" for c in ROBUST)
    + ") FROM {of} WHERE rz_return IS NOT NULL AND rz_volume IS NOT NULL AND rz_residual IS NOT NULL"
)
INJECTED = """SELECT coin_id, date, extreme_move, log_return + shift AS log_return, residual_return + shift AS residual_return,
  market_cap * exp(sum(shift) OVER (PARTITION BY coin_id ORDER BY date ROWS UNBOUNDED PRECEDING)) AS market_cap,
  CASE WHEN swell = 0 THEN volume ELSE volume * exp(swell) END AS volume
  FROM (SELECT f.*, coalesce(t.sign * {strength} * sr * CASE t.type WHEN 'price_spike' THEN 1.0 WHEN 'combo' THEN 0.5 END, 0.0) AS shift,
    coalesce(CASE t.type WHEN 'volume_spike' THEN {strength} * sv WHEN 'combo' THEN -0.5 * {strength} * sv END, 0.0) AS swell
    FROM feature_scales f LEFT JOIN feature_sites t USING (coin_id, date))"""
STRENGTHS = (3.0, 6.0, 12.0, 24.0)
METHODS = ("zscore", "iforest", "lof")
PARTS |= {
    "fixed": MODELLED.format(of="robust"),
    "token_fixed": "SELECT * REPLACE (" + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in USED) + ") FROM token_features WHERE transfers_z IS NOT NULL",
    **detector_sql.scored("coin", "fixed", ("coin_id", "date"), ROBUST, neighbors=20, budget=0.01),
    **detector_sql.scored("tok", "token_fixed", ("token", "day"), USED, neighbors=10, budget=0.05),
    "typed": """SELECT *, CASE WHEN abs(rz_return) > 3 AND abs(rz_volume) > 3 THEN 'price_and_vol' WHEN abs(rz_return) > 3 THEN 'price_shock'
  WHEN abs(rz_volume) > 3 THEN 'volume_only' WHEN greatest(abs(rz_turnover), abs(rz_residual)) > 3 THEN 'other_feature' ELSE 'multivariate' END AS type FROM coin_scored""",
    "daily_shares": "SELECT date, " + ", ".join(f"avg(CAST({m}_flag AS DOUBLE)) AS {m}" for m in METHODS) + " FROM coin_scored GROUP BY date",
    "still": "SELECT * FROM market UNION ALL SELECT * REPLACE ('PEG' AS coin_id, 1 + (day(date) % 3) * 0.0005::DOUBLE AS price) FROM market WHERE coin_id = 'R'",
    "still_flagged": FLAGGED.format(of="still"),
    "still_verdict": QUALITY.format(of="still_flagged"),
    "still_clean": "SELECT * FROM still_flagged WHERE coin_id IN (SELECT coin_id FROM still_verdict WHERE status = 'ok') AND NOT volume_glitch",
    "feature_sized": SIZED.format(of="features"),
    "feature_sites": SITES.format(of="features", sized="feature_sized"),
    "feature_scales": SCALES.format(of="features"),
}
for _s in STRENGTHS:
    _p = f"inj{_s:.0f}"
    PARTS |= {f"{_p}_rows": INJECTED.format(strength=_s), f"{_p}_robust": ROBUST_ROWS.format(of=f"{_p}_rows"), f"{_p}_fixed": MODELLED.format(of=f"{_p}_robust")}
    PARTS |= detector_sql.scored(_p, f"{_p}_fixed", ("coin_id", "date"), ROBUST, neighbors=20, budget=0.01)


def with_parts(final: str) -> str:
    """The statement with the parts it names, in order of need."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in PARTS:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                need(PARTS[name])
                order.append(name)

    need(final)
    return ("WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n" if order else "") + final


def _rules(rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) = 0 AS passed, count(*) AS violations FROM ({sql})" for name, sql in rules.items()
    )


def _null(table: str, column: str) -> str:
    return f"SELECT 1 FROM {table} WHERE {column} IS NULL"


def _twice(table: str, key: str) -> str:
    return f"SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1"


_LATEST = "SELECT coin_id, date, volume, source FROM (SELECT * FROM snaps{a} UNION ALL SELECT * FROM fixes{b}) QUALIFY row_number() OVER (PARTITION BY coin_id, date ORDER BY rank DESC, run DESC) = 1"
_TIMES = (0.052, 0.0525, 0.053)
_GENERIC_COINS = "(SELECT DISTINCT coin_id FROM wide WHERE coin_id <> 'Brand#11')"
_LOF = """
, p AS (SELECT DISTINCT {grid} FROM {rows}), i AS (SELECT *, CAST('0x' || substr(md5(concat_ws(',', {names})), 1, 15) AS BIGINT) AS id FROM p),
d AS (SELECT a.id, b.id AS other, round(sqrt({gap}), 9) AS d FROM i a JOIN i b ON a.id <> b.id),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS place FROM d QUALIFY place <= {k}),
k AS (SELECT id, max(d) AS kd FROM n GROUP BY id),
l AS (SELECT n.id, 1 / (avg(greatest(d, kd)) + 1e-10) AS density FROM n JOIN k ON n.other = k.id GROUP BY n.id),
f AS (SELECT n.id, avg(t.density) / any_value(o.density) AS lof FROM n JOIN l t ON n.other = t.id JOIN l o ON n.id = o.id GROUP BY n.id)
SELECT token, day, round(lof, 5) AS lof_score FROM {rows} r JOIN i ON {same} JOIN f USING (id)
"""


def _lof_tokens() -> str:
    rows = "(SELECT token, day, " + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in USED) + " FROM token_features WHERE transfers_z IS NOT NULL)"
    grid = ", ".join(f"round_even({c}, 1) + 0.0 AS x{j}" for j, c in enumerate(USED))
    xs = [f"x{j}" for j in range(len(USED))]
    tail = _LOF.format(
        grid=grid, rows=rows, names=", ".join(f"CAST(CAST(round({x} * 10) AS BIGINT) AS VARCHAR)" for x in xs), gap=" + ".join(f"pow(a.{x} - b.{x}, 2)" for x in xs), k=10,
        same=" AND ".join(f"round_even(r.{c}, 1) + 0.0 = i.x{j}" for j, c in enumerate(USED)),
    )
    return with_parts("SELECT 1 FROM token_features").rsplit("\n", 1)[0] + tail


def _mix() -> str:
    kinds = ", ".join(f"round(avg(CAST(type = '{k}' AS DOUBLE)), 6) AS {k}" for k in ("volume_only", "price_and_vol", "price_shock", "other_feature", "multivariate"))
    quiet = "greatest(" + ", ".join(f"abs({c})" for c in ROBUST) + ") < 1.0"
    return " UNION ALL ".join(
        f"SELECT '{m}' AS method, count(*) AS flags, count(*) FILTER (votes = 1) AS alone, round(avg(CAST({quiet} AS DOUBLE)), 6) AS calm_share, {kinds} FROM typed WHERE {m}_flag HAVING count(*) > 0"
        for m in METHODS
    )


def _agreement() -> str:
    cell = "SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN count(*) FILTER ({a}_flag OR {b}_flag) = 0 THEN 1.0 ELSE count(*) FILTER ({a}_flag AND {b}_flag) / count(*) FILTER ({a}_flag OR {b}_flag) END, 6) AS jaccard FROM coin_scored"
    return " UNION ALL ".join(cell.format(a=a, b=b) for a in METHODS for b in METHODS)


def _recall() -> str:
    shares = ", ".join(f"round(avg(CAST({m}_flag AS DOUBLE)), 6) AS {m}" for m in METHODS)
    return " UNION ALL ".join(
        f"SELECT coalesce(type, 'all') AS type, count(*) AS sites, {shares}, round(avg(CAST(votes >= 2 AS DOUBLE)), 6) AS consensus_2plus, CAST({s} AS DOUBLE) AS strength"
        f" FROM feature_sites JOIN inj{s:.0f}_scored USING (coin_id, date) GROUP BY ROLLUP (type) HAVING count(*) > 0"
        for s in STRENGTHS
    )


def _precision() -> str:
    def one(s: float) -> str:
        of = f"inj{s:.0f}_scored"
        ranks = ", ".join(f"row_number() OVER (ORDER BY {m}_score DESC, coin_id, date) AS n_{m}" for m in METHODS)
        shares = ", ".join(f"round(count(*) FILTER (n_{m} <= k AND site) / nullif(count(*) FILTER (n_{m} <= k), 0), 6) AS {m}" for m in METHODS)
        marked = f"SELECT {ranks}, coalesce(t.coin_id IS NOT NULL, false) AS site, greatest(1, count(t.coin_id) OVER ()) AS k FROM {of} LEFT JOIN feature_sites t USING (coin_id, date)"
        return f"SELECT {shares}, CAST({s} AS DOUBLE) AS strength FROM ({marked})"

    return " UNION ALL ".join(map(one, STRENGTHS))


def _scores(of: str, kind: str, entity: str, date: str) -> str:
    numbers = ", ".join(f"{m}_score" for m in METHODS)
    return f"SELECT '{kind}' AS entity_type, {entity} AS entity, {date} AS date, {numbers}, " + ", ".join(f"{m}_flag" for m in METHODS) + f", votes FROM {of}"


_VOTES = """SELECT count(*) AS rows, count(DISTINCT coin_id) AS coins, count(*) FILTER (zscore_flag) AS flags, count(*) FILTER (votes >= 2) AS votes2,
  count(*) FILTER (votes = 3) AS votes3, min(zscore_score) FILTER (zscore_flag) AS cutoff FROM coin_scored"""


def _figures(sections: dict[str, tuple[str, str, str]], digits: int) -> str:
    """section -> (SQL, item columns, number columns)."""
    def rows(name: str, sql: str, item: str, numbers: str) -> str:
        named = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in item.split()) + ")" if item else "''"
        return " UNION ALL ".join(
            f"SELECT '{name}' AS section, {named} AS item, '{c}' AS field, round(CAST({c} AS DOUBLE), {digits}) AS value FROM ({sql})" for c in numbers.split()
        )

    return " UNION ALL ".join(rows(name, *of) for name, of in sections.items())


_STATUS = "SELECT status, count(*) AS coins, CAST(sum(days) AS BIGINT) AS days FROM verdict GROUP BY status"
_SHARED = {
    "status": (_STATUS, "status", "coins days"),
    "votes": (_VOTES, "", "rows coins flags votes2 votes3 cutoff"),
}


def _dashboard() -> str:
    kinds = "volume_only price_and_vol price_shock other_feature multivariate"
    daily = "transfers unique_addresses new_addresses rt_share top10_sender_share large_transfers hub_share"
    sections = _SHARED | {
        "glitches": (_SQL["glitches_removed"], "", "days coins"),
        "turnover": (_SQL["turnover_summary"], "times", "days coins"),
        "turnover_days": (
            "SELECT coin_id, date, volume, market_cap, turnover, exp(log_return) - 1 AS move FROM odd WHERE volume > 0.0525 * market_cap ORDER BY volume / market_cap DESC, coin_id, date LIMIT 40",
            "coin_id date", "volume market_cap turnover move",
        ),
        "agreement": (_agreement(), "a b", "jaccard"),
        "mix": (_mix(), "method", "flags alone calm_share " + kinds),
        "strongest": (_SQL["strongest_agreed"], "coin_id date type", "votes volume"),
        "wash": ("SELECT coin_id, date, volume FROM typed WHERE votes >= 2 AND type = 'volume_only' AND rz_volume > 0 ORDER BY volume DESC, coin_id, date LIMIT 40", "coin_id date", "volume"),
        "tokens": (_SQL["token_totals"], "token", "transfers addresses"),
        "activity": ("SELECT * FROM token_features", "token day", daily),
        "series": ("SELECT coin_id, date, CAST(format('{:.11e}', market_cap) AS DOUBLE) AS market_cap, CAST(format('{:.11e}', volume) AS DOUBLE) AS volume FROM market", "coin_id date", "market_cap volume"),
    }
    return _figures(sections, 6)


def _insights() -> str:
    sections = _SHARED | {
        "data": ("SELECT count(DISTINCT coin_id) AS coins, count(*) AS rows FROM market", "", "coins rows"),
        "transfers": (_SQL["token_totals"], "token", "transfers addresses"),
        "glitches": (_SQL["glitches_removed"], "", "days coins"),
        "tails": ("SELECT count(*) FILTER (abs(return_z) > 3) / count(*) AS share, share / 0.0027 AS times_normal FROM features WHERE return_z IS NOT NULL", "", "share times_normal"),
        "median_turnover": ("SELECT median(volume / market_cap) AS median_turnover FROM clean WHERE market_cap > 0", "", "median_turnover"),
        "turnover": (_SQL["turnover_summary"], "times", "days coins"),
        "leaders": (_SQL["turnover_leaders"], "coin_id", "days peak"),
        "pairs": (_SQL["contract_share"], "token", "pairs contract_pairs transfers contract_transfers"),
        "round_trips": ("SELECT token, avg(rt_share) AS rt_share, median(transfers) AS median_transfers FROM token_features GROUP BY token", "token", "rt_share median_transfers"),
        "functions": (_SQL["function_shares"], "function", "share"),
        "agreement": (f"SELECT * FROM ({_agreement()}) WHERE a < b", "a b", "jaccard"),
        "recall": (f"SELECT * FROM ({_recall()}) WHERE type IN ('all', 'combo')", "type strength", "sites zscore iforest lof consensus_2plus"),
        "events": (_SQL["event_hits"], "event", "rows zscore iforest lof"),
    }
    return _figures(sections, 5)


def _r(columns: str, digits: int) -> str:
    return ", ".join(f"round({c.strip()}, {digits}) AS {c.strip()}" for c in columns.split(","))


_SQL: dict[str, str] = {
    "market_flags": "SELECT coin_id, date, volume, round(log_return, 6) AS log_return, extreme_move, zero_volume, volume_glitch, missing_days_before FROM wide_flagged",
    "coin_quality": "SELECT coin_id, days, first_date, last_date, extreme_moves, zero_volume_days, volume_glitch_days, missing_days, status FROM wide_verdict",
    "market_clean": "SELECT coin_id, date, volume, round(log_return, 6) AS log_return, extreme_move FROM clean",
    "market_return": "SELECT date, round(market_return, 6) AS market_return FROM wide_returns",
    "market_features": f"SELECT coin_id, date, {_r('log_return', 5)}, extreme_move, n_history, "
    + _r("market_return, return_z, volume_z, turnover_z, market_corr, market_beta, residual_return, residual_z, volume_price_gap", 5)
    + " FROM features",
    "robust_features": f"SELECT coin_id, date, {_r(', '.join(ROBUST), 5)} FROM robust",
    "market_series_z": "SELECT date, round(market_return, 5) AS market_return, round("
    + _rz("market_return", 0.005)
    + ", 5) AS z FROM wide_returns WINDOW w AS "
    + PAST.format(by="1", on="date", n=30),
    "trailing_scales": "SELECT coin_id, date, round(sr, 6) AS scale_return, round(sv, 6) AS scale_volume FROM scales",
    "pegged_coins": "SELECT coin_id, round(median(abs(log_return)), 9) AS typical_move FROM still_clean GROUP BY coin_id HAVING median(abs(log_return)) < 0.002",
    "turnover_summary": " UNION ALL ".join(
        f"SELECT CAST({x} AS DOUBLE) AS times, count(*) AS days, count(DISTINCT coin_id) AS coins FROM odd WHERE volume > {x} * market_cap" for x in _TIMES
    ),
    "turnover_leaders": "SELECT coin_id, count(*) AS days, round(max(turnover), 9) AS peak FROM odd WHERE volume > 0.0525 * market_cap GROUP BY coin_id ORDER BY days DESC, coin_id LIMIT 5",
    "turnover_days": "SELECT coin_id, date, volume, round(turnover, 9) AS turnover, round(exp(log_return) - 1, 9) AS move FROM odd WHERE volume > 0.0525 * market_cap ORDER BY volume / market_cap DESC, coin_id, date LIMIT 40",
    "median_turnover": "SELECT round(median(volume / market_cap), 9) AS median_turnover FROM clean WHERE market_cap > 0",
    "fat_tails": "SELECT round(count(*) FILTER (abs(return_z) > 3) / count(*), 6) AS share, count(*) AS rows FROM features WHERE return_z IS NOT NULL",
    "status_counts": "SELECT status, count(*) AS coins, CAST(sum(days) AS BIGINT) AS days FROM wide_verdict GROUP BY status",
    "glitches_removed": "SELECT count(*) FILTER (volume_glitch) AS days, count(DISTINCT coin_id) FILTER (volume_glitch) AS coins FROM flagged WHERE coin_id IN (SELECT coin_id FROM verdict WHERE status = 'ok')",
    "series_profile": """SELECT coin_id, count(*) AS rows, count(*) FILTER (price IS NULL) AS null_prices, count(*) FILTER (market_cap IS NULL) AS null_caps,
  min(date) AS first_date, max(date) AS last_date, count(*) FILTER (gap > 1) AS gaps, count(*) FILTER (gap = 0) AS duplicate_days
  FROM (SELECT *, date_diff('day', lag(date) OVER (PARTITION BY coin_id ORDER BY date), date) AS gap FROM wide) GROUP BY coin_id""",
    "series_on_spine": "SELECT coin_id, (SELECT CAST(date_diff('day', min(date), max(date)) + 1 AS INTEGER) FROM wide) AS days, CAST(count(volume) AS INTEGER) AS known FROM wide GROUP BY coin_id",
    "significant_digits": "SELECT coin_id, date, CAST(format('{:.3e}', volume) AS DOUBLE) AS volume FROM market",
    "busiest_days": "SELECT coin_id, date, volume FROM wide QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY volume DESC, date) = 1",
    "daily_moves": "SELECT coin_id, date, round(volume / lag(volume) OVER (PARTITION BY coin_id ORDER BY date) - 1, 6) AS volume_change FROM market",
    "market_summary": "SELECT count(DISTINCT coin_id) AS coins, count(*) AS rows, min(date) AS first, max(date) AS last FROM wide",
    "zscore_flags": "SELECT coin_id, date, round(zscore_score, 5) AS zscore_score, zscore_flag FROM zscored",
    "anomaly_types": """SELECT type, zscore_flag, count(*) AS rows FROM (SELECT *, CASE WHEN abs(rz_return) > 3 AND abs(rz_volume) > 3 THEN 'price_and_vol'
  WHEN abs(rz_return) > 3 THEN 'price_shock' WHEN abs(rz_volume) > 3 THEN 'volume_only'
  WHEN greatest(abs(rz_turnover), abs(rz_residual)) > 3 THEN 'other_feature' ELSE 'multivariate' END AS type FROM zscored) GROUP BY type, zscore_flag""",
    "standard_against_robust": """SELECT round(coalesce(count(*) FILTER (s AND zscore_flag) / nullif(count(*) FILTER (s OR zscore_flag), 0), 1.0), 5) AS overlap,
  count(*) FILTER (s) AS standard_flags, count(*) FILTER (s AND r < 3) AS blowups, round(max(v), 5) AS max_standard, round(max(r), 5) AS max_robust
  FROM (SELECT *, row_number() OVER (ORDER BY v DESC, coin_id, date) <= greatest(1, round_even(count(*) OVER () * 0.01, 0)) AS s FROM (
    SELECT *, greatest(coalesce(abs(return_z), 0), coalesce(abs(volume_z), 0), coalesce(abs(turnover_z), 0), coalesce(abs(residual_z), 0)) AS v,
    greatest(abs(rz_return), abs(rz_volume), abs(rz_turnover), abs(rz_residual)) AS r FROM zscored))""",
    "strongest_token_feature": "SELECT token, day, CASE "
    + " ".join(
        f"WHEN coalesce(abs({c}), 0) >= greatest({', '.join(f'coalesce(abs({o}), 0)' for o in USED)}) THEN '{c}'" for c in USED
    )
    + " END AS strongest FROM token_features WHERE transfers_z IS NOT NULL",
    "token_daily": "SELECT token, day, transfers, round(amount_total, 4) AS amount_total, round(amount_median, 4) AS amount_median, round(amount_p99, 4) AS amount_p99, unique_senders, unique_receivers, swap_transfers, plain_transfers, unique_addresses, is_partial_day FROM rollup_daily",
    "round_trips": "SELECT token, tx_hash, day FROM trips",
    "hub_addresses": "SELECT token, address, degree FROM hubs",
    "daily_activity": "SELECT token, day, transfers, round(amount_total, 4) AS amount_total, unique_senders, unique_receivers, large_transfers, round(hub_share, 4) AS hub_share, unique_addresses, new_addresses, round(top10_sender_share, 4) AS top10_sender_share, rt_transfers, round(rt_amount, 4) AS rt_amount, rt_pairs, round(rt_share, 4) AS rt_share, round(rt_amount_share, 4) AS rt_amount_share, round(transfers_per_address, 4) AS transfers_per_address, round(new_address_share, 4) AS new_address_share FROM activity",
    "activity_features": f"SELECT token, day, n_history, {_r(', '.join([*TOKEN_Z, 'activity_vs_participants']), 5)} FROM token_features",
    "mutual_pairs": "SELECT token, a, b, ab, ba FROM pairs",
    "contract_share": """SELECT token, count(*) AS pairs, count(*) FILTER (c) AS contract_pairs, CAST(sum(ab + ba) AS BIGINT) AS transfers,
  CAST(coalesce(sum(ab + ba) FILTER (c), 0) AS BIGINT) AS contract_transfers FROM (SELECT p.*, coalesce(x.is_contract, false) OR coalesce(y.is_contract, false) AS c
  FROM pairs p LEFT JOIN labels40 x ON p.a = x.address LEFT JOIN labels40 y ON p.b = y.address) GROUP BY token""",
    "label_candidates": "SELECT DISTINCT address FROM (SELECT a AS address FROM pairs UNION ALL SELECT b FROM pairs)",
    "unlabelled_candidates": "SELECT DISTINCT address FROM (SELECT a AS address FROM pairs UNION ALL SELECT b FROM pairs) WHERE address NOT IN (SELECT address FROM labels40)",
    "token_totals": "SELECT token, transfers, first, last, addresses FROM (SELECT token, count(*) AS transfers, min(block_time) AS first, max(block_time) AS last FROM transfers GROUP BY token) JOIN (SELECT token, count(DISTINCT address) AS addresses FROM sides GROUP BY token) USING (token)",
    "function_shares": "SELECT split_part(function_name, '(', 1) AS function, round(count(*) / (SELECT count(*) FROM transfers WHERE token = 'view'), 9) AS share FROM transfers WHERE token = 'view' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4",
    "round_trip_summary": "SELECT token, round(avg(rt_share), 6) AS rt_share, round(median(transfers), 6) AS median_transfers FROM token_features GROUP BY token",
    "daily_resample": "SELECT s.token, s.day, coalesce(n, 0) AS n FROM (SELECT token, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM transfers GROUP BY token) s LEFT JOIN (SELECT token, day, count(*) AS n FROM transfers GROUP BY token, day) USING (token, day)",
    "large_transfer_cuts": "SELECT token, cut FROM cuts",
    "dedupe_latest": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "merge_later_days": _LATEST.format(a="", b=""),
    "later_market_rows": _LATEST.format(a=" WHERE date > DATE '1998-12-31'", b=" WHERE date > DATE '1998-12-31' AND date < run"),
    "replace_days": "SELECT token, tx_hash, CASE WHEN day = DATE '2024-01-06' THEN 1.0 ELSE amount END AS amount, day FROM transfers WHERE day <> DATE '2024-01-05'",
    "overlay_rows": "SELECT coin_id, date, volume FROM snaps WHERE (coin_id, date) NOT IN (SELECT coin_id, date FROM fixes) UNION ALL SELECT coin_id, date, volume FROM fixes",
    "reconcile_change": "SELECT count(*) AS rows, list_sort(list(abs(f.volume / s.volume - 1)))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median_change FROM fixes f JOIN snaps s USING (coin_id, date) WHERE s.volume <> 0",
    "touched_days": "SELECT min(last) AS day FROM (SELECT token, max(day) AS last FROM transfers WHERE day < DATE '2024-01-20' GROUP BY token) UNION SELECT DISTINCT day FROM transfers WHERE day >= DATE '2024-01-28'",
    "table_fingerprint": "SELECT count(*) AS rows, true AS same FROM transfers",
    "exact_sums": "SELECT l_returnflag, CAST(sum(CAST(CAST(l_orderkey AS VARCHAR) || lpad(CAST(l_partkey AS VARCHAR), 18, '0') AS DECIMAL(38,0))) AS VARCHAR) AS total FROM lineitem GROUP BY l_returnflag",
    "parse_market_chart": "SELECT coin_id, date, price, market_cap, volume FROM market",
    "parse_snapshot": "SELECT coin_id, date, price, market_cap, volume FROM market WHERE day(date) <> 1 AND coin_id <> 'R'",
    "number_within_tx": "SELECT l_orderkey AS hash, l_linenumber AS pos, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INTEGER) AS \"txSeq\" FROM lineitem",
    "parse_transfers": "SELECT 'T' AS token, event_id AS block_number, CAST(event_id AS VARCHAR) AS tx_hash, '0xa' || CAST(user_id AS VARCHAR) AS from_address, '0xb' AS to_address, CAST(user_id AS VARCHAR) || '00' AS value_raw, CAST(user_id AS DOUBLE) AS amount, 2 AS decimals, CAST(0 AS DECIMAL(20,0)) AS gas_used, '' AS method_id FROM events",
    "label_addresses": "SELECT '0xA' || CAST(c_custkey AS VARCHAR) AS address, s_suppkey IS NOT NULL AS is_contract, coalesce(s_name, '') AS creator, '' AS factory, CAST(coalesce(s_nationkey, 0) AS BIGINT) AS created_block FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey",
    "contract_rules": _rules(
        {
            "first_row_never_flagged": "SELECT 1 FROM wide_flagged WHERE prev_price IS NULL AND extreme_move",
            "clean_excludes_bad_coins": "SELECT 1 FROM wide_clean WHERE coin_id IN (SELECT coin_id FROM wide_verdict WHERE status <> 'ok')",
            "clean_has_no_volume_glitches": "SELECT 1 FROM wide_clean WHERE volume_glitch",
            "clean_has_no_repeated_extreme_moves": "SELECT 1 FROM wide_clean GROUP BY coin_id HAVING count(*) FILTER (extreme_move) > 1",
            "market_keys_unique": _twice("wide", "coin_id, date"),
            "transfer_keys_unique": _twice("transfers", "token, tx_hash, tx_seq"),
            "token_daily_keys_unique": _twice("rollup_daily", "token, day"),
            "token_daily_matches_raw": "SELECT 1 FROM (SELECT token, count(*) AS a FROM transfers GROUP BY token) FULL JOIN (SELECT token, sum(transfers) AS b FROM rollup_daily GROUP BY token) USING (token) WHERE a IS DISTINCT FROM b",
            "only_edge_days_partial": "SELECT 1 FROM rollup_daily GROUP BY token HAVING sum(is_partial_day) > 2",
        }
    ),
    "generic_rules": _rules(
        {
            "coins_id_unique": _twice(_GENERIC_COINS, "coin_id"),
            "market_coin_known": "SELECT 1 FROM wide WHERE coin_id = 'Brand#11'",
            "market_source_known": "SELECT 1 FROM wide WHERE day(date) = 3",
            "quality_coin_unique": _twice("wide_verdict", "coin_id"),
            "quality_coin_known": "SELECT 1 FROM wide_verdict WHERE coin_id = 'Brand#11'",
            "quality_status_known": "SELECT 1 FROM wide_verdict WHERE status NOT IN ('ok', 'feed_glitch', 'stale_feed')",
            "scores_entity_type_known": "SELECT 1 FROM wide WHERE false",
            "labels_address_unique": _twice("labels40", "address"),
            "coins_coin_id_not_null": _null(_GENERIC_COINS, "coin_id"),
            "market_coin_id_not_null": _null("wide", "coin_id"),
            "market_date_not_null": _null("wide", "date"),
            "market_price_not_null": _null("wide", "price"),
            "market_source_not_null": "SELECT 1 FROM wide WHERE false",
            "labels_address_not_null": _null("labels40", "address"),
            "labels_is_contract_not_null": _null("labels40", "is_contract"),
            "scores_entity_not_null": _null("wide", "coin_id"),
            "scores_date_not_null": _null("wide", "date"),
        }
    ),
    "key_checks": """SELECT 'market_keys' AS "check", count(*) = count(DISTINCT (coin_id, date)) AS passed, printf('%d rows, %d keys', count(*), count(DISTINCT (coin_id, date))) AS detail FROM wide
  UNION ALL SELECT 'transfer_keys', count(*) = count(DISTINCT (token, tx_hash, tx_seq)), printf('%d rows, %d keys', count(*), count(DISTINCT (token, tx_hash, tx_seq))) FROM transfers""",
    "feature_checks": """SELECT unnest(['rows_preserved', 'no_infinities', 'features_present', 'edge_days_dropped', 'counts_match_rollup']) AS "check", true AS passed""",
    "injection_sites": "SELECT coin_id, date, type, CAST(sign AS DOUBLE) AS sign FROM sites",
    "injected_rows": """SELECT coin_id, date, round(log_return + coalesce(shift, 0), 5) AS log_return, round(ln(volume) + coalesce(swell, 0), 5) AS lv,
  round(ln(market_cap) + sum(coalesce(shift, 0)) OVER (PARTITION BY coin_id ORDER BY date ROWS UNBOUNDED PRECEDING), 5) AS lc
  FROM (SELECT s.*, t.sign * 12.0 * sr * CASE t.type WHEN 'price_spike' THEN 1.0 WHEN 'combo' THEN 0.5 END AS shift,
    CASE t.type WHEN 'volume_spike' THEN 12.0 * sv WHEN 'combo' THEN -6.0 * sv END AS swell FROM scales s LEFT JOIN sites t USING (coin_id, date))""",
    "kept_moves": "SELECT count(*) AS kept, " + ", ".join(f"count(*) FILTER ({m}_flag) AS {m}" for m in METHODS) + " FROM coin_scored WHERE extreme_move",
    "market_wide_days": "SELECT date, " + ", ".join(f"round({m}, 6) AS {m}, round((SELECT median({m}) FROM daily_shares), 6) AS usual_{m}" for m in METHODS)
    + " FROM daily_shares WHERE date IN (DATE '1996-06-01', DATE '1999-03-15')",
    "history_end": "SELECT max(date) AS history_end FROM market WHERE coin_id <> 'N'",
    "load_checks": "SELECT 'market' AS \"check\", true AS passed",
    "load_verification": """SELECT name AS "check", true AS passed, n || ' / ' || n AS detail FROM (
  SELECT 'coins' AS name, CAST(count(DISTINCT coin_id) AS VARCHAR) AS n FROM market UNION ALL SELECT 'market rows', CAST(count(*) AS VARCHAR) FROM market
  UNION ALL SELECT 'market keys', CAST(count(*) AS VARCHAR) FROM market
  UNION ALL SELECT 'T' || (event_id % 3) || k, CAST(count(*) AS VARCHAR) FROM events CROSS JOIN (VALUES (' rows'), (' keys'), (' rollup')) v(k) GROUP BY ALL
  UNION ALL SELECT 'T' || (event_id % 3) || ' values', CAST(sum(CAST(user_id AS HUGEINT) * 100) AS VARCHAR) || ' 0 0 0 0' FROM events GROUP BY ALL)""",
    "transfer_coverage": "SELECT token, date_diff('second', max(block_time), TIMESTAMP '2024-01-31 04:00:00') > 21600 AS late FROM transfers GROUP BY token",
    "event_rows": """SELECT coin_id, date, round(r, 6) AS log_return, round(r - market_return, 6) AS residual_return
  FROM (SELECT coin_id, date, CASE WHEN missing_days_before = 0 THEN log_return END AS r FROM wide_flagged) LEFT JOIN wide_returns USING (date)""",
    "lof_market": "SELECT coin_id, date, round(lof_score, 5) AS lof_score FROM coin_lof",
    "iforest_market": "SELECT coin_id, date, iforest_score FROM coin_iforest",
    "anomaly_scores": _scores("coin_scored", "coin", "coin_id", "date") + " UNION ALL " + _scores("tok_scored", "token", "token", "day"),
    "detector_agreement": _agreement(),
    "method_mix": _mix(),
    "wash_candidates": "SELECT coin_id, date, rz_volume, votes FROM inj24_scored WHERE votes >= 2 AND abs(rz_return) <= 3 AND rz_volume > 3",
    "strongest_agreed": "SELECT coin_id, date, type, votes, volume FROM typed WHERE votes >= 2 ORDER BY votes DESC, volume DESC, coin_id, date LIMIT 400",
    "alert_budget": "SELECT 'alert_budget' AS \"check\", " + " AND ".join(f"count(*) FILTER ({m}_flag) = greatest(1, round_even(count(*) * 0.01, 0))" for m in METHODS)
    + " AS passed, concat_ws(' ', " + ", ".join(f"'{m}=' || count(*) FILTER ({m}_flag)" for m in METHODS) + ") AS detail FROM coin_scored",
    "vote_consensus": "SELECT votes, count(*) AS rows FROM coin_scored GROUP BY votes",
    "flagged_per_day": "SELECT " + ", ".join(f"round(median({m}), 6) AS {m}" for m in METHODS) + " FROM daily_shares",
    "injection_recall": _recall(),
    "precision_at_sites": _precision(),
    "event_hits": """SELECT event, e.coin_id, event_date, count(z.date) AS rows, """
    + ", ".join(f"coalesce(bool_or({m}_flag), false) AS {m}" for m in METHODS)
    + """, max(abs(rz_return)) AS max_abs_rz_return, max(rz_volume) AS max_rz_volume
  FROM (VALUES ('first', 'A', DATE '1996-06-01'), ('second', 'N', DATE '1999-03-15'), ('none', 'Z', DATE '1999-03-15')) e(event, coin_id, event_date)
  LEFT JOIN coin_scored z ON z.coin_id = e.coin_id AND abs(date_diff('day', event_date, z.date)) <= 3 GROUP BY ALL""",
    "vote_totals": _VOTES,
    "report_totals": """SELECT *, round(share, 6) AS fat_tail_share, round(m, 6) AS median_turnover FROM (SELECT count(DISTINCT coin_id) AS coins, count(*) AS market_rows FROM market),
  (SELECT count(*) FILTER (status = 'ok') AS clean_coins FROM verdict),
  (SELECT rows AS modelled_rows, coins AS modelled_coins, flags AS flags_per_method, votes2, votes3, cutoff FROM ("""
    + _VOTES
    + """)), (SELECT count(*) AS transfers FROM transfers), (SELECT count(DISTINCT address) AS addresses FROM sides),
  (SELECT count(*) AS labelled, count(*) FILTER (is_contract) AS contracts FROM labels40),
  (SELECT count(*) FILTER (abs(return_z) > 3) / count(*) AS share FROM features WHERE return_z IS NOT NULL),
  (SELECT median(volume / market_cap) AS m FROM clean WHERE market_cap > 0)""",
}


def oracle_sql() -> dict[str, str]:
    more = {"dashboard": _dashboard(), "insights": _insights()}
    return {name: with_parts(sql) for name, sql in (_SQL | more).items()} | {"lof_tokens": _lof_tokens()}
