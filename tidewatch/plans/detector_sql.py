"""Detectors in DuckDB SQL: named parts that score any table of model rows."""

from __future__ import annotations

from collections.abc import Sequence

PRIME = 2**31 - 1
TREES, SAMPLE, POOL, DEEPEST = 300, 4096, 32768, 12


def _fifth(x: str) -> str:
    """x to the fifth power modulo the prime, x being below it."""
    square = f"({x} * {x} % {PRIME})"
    return f"({square} * {square} % {PRIME} * {x} % {PRIME})"


def _bonus(n: str) -> str:
    mean = f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"
    return f"round(CAST({mean} AS DOUBLE) * 1048576) / 1048576"


def scored(p: str, rows: str, key: Sequence[str], features: Sequence[str], *, neighbors: int, budget: float) -> dict[str, str]:
    """Parts named p_...: p_zscore, p_iforest and p_lof have the key and a
    score, p_scored has all of rows with scores, flags and votes. Features must
    be at a fixed number of digits."""
    keys, m = ", ".join(key), len(features)
    names = ", ".join(f"CAST({k} AS VARCHAR)" for k in key)
    listed = lambda f: "[" + ", ".join(f.format(c) for c in features) + "]"
    out = {
        f"{p}_named": f"SELECT *, {listed('{}')} AS x, row_number() OVER (ORDER BY place, {keys}) AS no FROM "
        f"(SELECT *, CAST('0x' || substr(md5(concat_ws('|', '7', {names})), 1, 7) AS BIGINT) AS place FROM {rows})",
        f"{p}_size": f"SELECT least(count(*), {SAMPLE}) AS psi, CAST(ceil(log2(greatest(2, least(count(*), {SAMPLE})))) AS INTEGER) AS deepest FROM {rows}",
        f"{p}_trees": f"SELECT i AS tree, CAST('0x' || substr(md5('7|tree|' || CAST(i AS VARCHAR)), 1, 7) AS BIGINT) AS draw FROM range({TREES}) r(i)",
        f"{p}_walk0": f"SELECT tree, draw, no, CAST(1 AS BIGINT) AS node, no <= {POOL} AND row_number() OVER (PARTITION BY tree ORDER BY no > {POOL}, {_fifth('spot')}, no) <= psi AS s "
        f"FROM (SELECT tree, draw, no, (place + draw) % {PRIME} AS spot FROM {p}_named CROSS JOIN {p}_trees) CROSS JOIN {p}_size",
    }
    for d in range(DEEPEST + 1):
        spans = f"SELECT tree, any_value(draw) AS draw, node, count(*) AS n, {listed('min({})')} AS lo, {listed('max({})')} AS hi FROM {p}_walk{d} JOIN {p}_named USING (no) WHERE s GROUP BY tree, node"
        apart = f"SELECT *, list_filter({list(range(1, m + 1))}, lambda f: hi[f] > lo[f]) AS apart, (draw + node * 48271) % {PRIME} AS r FROM ({spans})"
        chosen = f"SELECT *, CASE WHEN len(apart) > 0 AND {d} < deepest THEN apart[CAST(1 + y % len(apart) AS INTEGER)] END AS feature, (y + 69621 * node + 1) % {PRIME} AS r2 FROM (SELECT *, {_fifth('r')} AS y FROM ({apart})) CROSS JOIN {p}_size"
        cut = f"SELECT *, lo[feature] + CAST({_fifth('r2')} AS DOUBLE) / CAST({PRIME} AS DOUBLE) * (hi[feature] - lo[feature]) AS c FROM ({chosen})"
        out[f"{p}_node{d}"] = f"SELECT tree, node, n, feature, CASE WHEN c >= hi[feature] THEN lo[feature] ELSE c END AS cut FROM ({cut})"
        out[f"{p}_walk{d + 1}"] = (
            f"SELECT tree, draw, no, 2 * node + CAST(x[feature] > cut AS BIGINT) AS node, s FROM {p}_walk{d} JOIN {p}_node{d} USING (tree, node) JOIN {p}_named USING (no) WHERE feature IS NOT NULL"
        )
    ends = " UNION ALL ".join(
        f"SELECT no, {d} + {_bonus('n')} AS depth FROM {p}_walk{d} JOIN {p}_node{d} USING (tree, node) WHERE feature IS NULL" for d in range(DEEPEST + 1)
    )
    scale = f"(SELECT CASE WHEN b = 0 THEN 1.0 ELSE b END FROM (SELECT {_bonus('psi')} AS b FROM {p}_size))"
    out[f"{p}_ends"] = f"SELECT no, sum(depth) AS depth FROM ({ends}) GROUP BY no"
    out[f"{p}_iforest"] = f"SELECT {keys}, round(pow(2.0, -depth / {TREES} / {scale}), 9) AS iforest_score FROM {p}_named JOIN {p}_ends USING (no)"
    out[f"{p}_zscore"] = f"SELECT {keys}, greatest({', '.join(f'abs({c})' for c in features)}) AS zscore_score FROM {rows}"

    xs = [f"x{j}" for j in range(m)]
    grid = ", ".join(f"round_even({c}, 1) + 0.0 AS x{j}" for j, c in enumerate(features))
    steps = ", ".join(f"CAST(CAST(round({x} * 10) AS BIGINT) AS VARCHAR)" for x in xs)
    gap = " + ".join(f"pow(a.{x} - b.{x}, 2)" for x in xs)
    same = " AND ".join(f"round_even(r.{c}, 1) + 0.0 = i.x{j}" for j, c in enumerate(features))
    out |= {
        f"{p}_points": f"SELECT *, CAST('0x' || substr(md5(concat_ws(',', {steps})), 1, 15) AS BIGINT) AS id FROM (SELECT DISTINCT {grid} FROM {rows})",
        f"{p}_near": f"SELECT id, place.d AS d, place.other AS other FROM (SELECT a.id, unnest(min({{'d': round(sqrt({gap}), 9), 'other': b.id}}, {neighbors})) AS place "
        f"FROM {p}_points a JOIN {p}_points b ON a.id <> b.id GROUP BY a.id)",
        f"{p}_reach": f"SELECT id, max(d) AS kd FROM {p}_near GROUP BY id",
        f"{p}_density": f"SELECT n.id, 1 / (avg(greatest(d, kd)) + 1e-10) AS density FROM {p}_near n JOIN {p}_reach k ON n.other = k.id GROUP BY n.id",
        f"{p}_factor": f"SELECT n.id, avg(t.density) / any_value(o.density) AS lof FROM {p}_near n JOIN {p}_density t ON n.other = t.id JOIN {p}_density o ON n.id = o.id GROUP BY n.id",
        f"{p}_lof": f"SELECT {keys}, coalesce(round(lof, 9), 1.0) AS lof_score FROM {rows} r JOIN {p}_points i ON {same} LEFT JOIN {p}_factor USING (id)",
    }
    flags = ", ".join(
        f"row_number() OVER (ORDER BY {s}_score DESC, {keys}) <= greatest(1, round_even(count(*) OVER () * {budget}, 0)) AS {s}_flag" for s in ("zscore", "iforest", "lof")
    )
    out[f"{p}_scored"] = (
        f"SELECT *, CAST(zscore_flag AS INTEGER) + CAST(iforest_flag AS INTEGER) + CAST(lof_flag AS INTEGER) AS votes FROM "
        f"(SELECT *, {flags} FROM {rows} JOIN {p}_zscore USING ({keys}) JOIN {p}_iforest USING ({keys}) JOIN {p}_lof USING ({keys}))"
    )
    return out
