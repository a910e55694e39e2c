"""SQL fragments shared by the oracle texts."""

from __future__ import annotations


def dense(src: str, values: str, keys: str = "entity", out: str = "dense") -> str:
    """CTEs giving every day between each key's first and last row of `src`."""
    on = " AND ".join(f"x.{k.strip()} = g.{k.strip()}" for k in keys.split(","))
    gk = ", ".join(f"g.{k.strip()}" for k in keys.split(","))
    xv = ", ".join(f"x.{v.strip()}" for v in values.split(","))
    return f"""{out}_span AS (SELECT {keys}, MIN(date) AS lo, MAX(date) AS hi FROM {src} GROUP BY {keys}),
{out}_days AS (SELECT {keys}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM {out}_span),
{out} AS (SELECT {gk}, g.date, {xv} FROM {out}_days g LEFT JOIN {src} x ON {on} AND x.date = g.date)"""


def interpolated(src: str, value: str, keys: str = "entity", out: str = "filled") -> str:
    """CTEs filling interior gaps of `value` linearly over time; other columns are kept."""
    w = f"PARTITION BY {keys} ORDER BY date"
    f = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    day = f"CASE WHEN {value} IS NOT NULL THEN date END"
    return f"""{out}_n AS (SELECT *,
    last_value({value} IGNORE NULLS) OVER ({w}) AS pv, last_value({day} IGNORE NULLS) OVER ({w}) AS pd,
    first_value({value} IGNORE NULLS) OVER ({w} {f}) AS nv, first_value({day} IGNORE NULLS) OVER ({w} {f}) AS nd
  FROM {src}),
{out} AS (SELECT * REPLACE (COALESCE({value}, pv + (nv - pv) * (CAST(date - pd AS DOUBLE) / NULLIF(nd - pd, 0))) AS {value})
  FROM {out}_n)"""


def undipped(src: str, value: str, keys: str = "entity", out: str = "undipped") -> str:
    return f"""{out} AS (SELECT * REPLACE (CASE WHEN {value} IS NOT NULL THEN MIN({value}) OVER (
    PARTITION BY {keys} ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS {value}) FROM {src})"""
