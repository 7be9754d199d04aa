"""KMeans for several numbers of centres at once.

Every round is one job for all of them: a row meets the centres of each k that is still moving, and one
aggregate by (k, cluster), combined before the shuffle, gives the next centres.  The number of jobs does not
depend on how many k are tried, and the centres are data of the plan, so its generated code is compiled once.
The driver holds centres and a bounded number of drawn rows only.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.functions.casts import named

#: Lloyd rounds at most; the squared way, and the share of its cost, below which a k counts as settled.
ROUNDS = 20
STILL = 1e-8
SETTLED = 1e-4
#: Rows drawn for the starting centres (at least, and per centre), starts tried on them and rounds of each.
DRAWN, DRAWN_PER_CENTRE = 2048, 64
STARTS, START_ROUNDS = 8, 10


class Fit(NamedTuple):
    """The centres, the sum of squared distances and the silhouette of one k."""

    centres: np.ndarray
    cost: float
    silhouette: float


def _drawn(points: DataFrame, dims: int, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for all, and how many each stands for: a lightweight coreset (Bachem, Lucic and Krause, 2018).

    Half of a row's chance is the same for all, half goes with its squared distance from the mean.  The
    smallest of exponential variates divided by the chances are a weighted draw: one top-n of bounded size.
    """
    own = [f"x{i}" for i in range(dims)]
    facts = points.agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in own for f in (F.avg, F.var_pop)]).first()
    spread = sum(facts[f"var_pop_{c}"] for c in own)
    away = reduce(add, [(F.col(c) - facts[f"avg_{c}"]) * (F.col(c) - facts[f"avg_{c}"]) for c in own])
    chance = (0.5 + 0.5 * away / (spread or 1.0)) / facts["n"]
    rows = points.select(*own, chance.alias("chance"), F.rand(seed).alias("u"))
    rows = rows.orderBy(-F.log(1 - F.col("u")) / F.col("chance"), *own).limit(most).drop("u").collect()
    return np.array([r[:-1] for r in rows], float), 1 / np.array([r[-1] for r in rows])


def _away(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows from centres."""
    return np.maximum(0, (rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1))


def _start(found: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centres of the drawn rows: the best of a few weighted draws, each moved to the middle of its rows."""
    best, least = None, np.inf
    for start in range(STARTS):
        rng = np.random.default_rng([seed, k, start])
        centres = found[[rng.choice(len(found), p=weights / weights.sum())]]
        while len(centres) < k:
            share = weights * ((found[:, None] - centres[None]) ** 2).sum(2).min(1)
            even = np.full(len(found), 1 / len(found))  # where all drawn rows lie on centres
            centres = np.vstack([centres, found[rng.choice(len(found), p=share / share.sum() if share.sum() > 0 else even)]])
        for _ in range(START_ROUNDS):
            inside = (_away(found, centres).argmin(1)[:, None] == np.arange(k)) * weights[:, None]
            size = inside.sum(0)
            centres = np.where(size[:, None] > 0, inside.T @ found / np.maximum(size, 1e-300)[:, None], centres)
        cost = weights @ _away(found, centres).min(1)
        if best is None or cost < least:
            best, least = centres, cost
    return best


def _least(names: list[str]) -> str:
    return f"least({', '.join(names)})" if len(names) > 1 else names[0]


def _assigned(points: DataFrame, dims: int, centres: dict[int, np.ndarray], width: int, facts: dict[int, dict] | None = None) -> DataFrame:
    """Every row of x0, x1, ... once for each k, with its nearest centre (lowest wins a tie) and the squared distance to it.

    Unused places up to `width` are null, so all rounds share one generated code.  `facts` adds
    arrays of cluster facts to each k's entry `e`.  Expressions are SQL: hundreds of Column
    objects a round would cost more than the round on small tables.
    """
    entries = []
    for k, c in sorted(centres.items()):
        flat = [float(v) for v in np.ravel(c)]
        entries.append({"k": k, "c": [*flat, *[None] * (width * dims - len(flat))], **(facts or {}).get(k, {})})
    table = F.from_json(F.lit(json.dumps(entries)), "array<struct<k int, c array<double>, n array<double>, psi array<double>, y array<double>>>")
    rows = points.select("*", F.explode(table).alias("e"))
    away = [[f"x{i} - e.c[{j * dims + i}]" for i in range(dims)] for j in range(width)]
    distances = [" + ".join(f"({a}) * ({a})" for a in own) + f" as d{j}" for j, own in enumerate(away)]
    rows = rows.selectExpr("*", *distances).selectExpr("*", _least([f"d{j}" for j in range(width)]) + " as sq")
    nearest = " ".join(f"when d{j} = sq then {j}" for j in range(width))
    return rows.selectExpr("*", f"case {nearest} end as cluster").drop(*[f"d{j}" for j in range(width)])


def _norm(dims: int) -> str:
    return " + ".join(f"x{i} * x{i}" for i in range(dims))


def _sums(assigned: DataFrame, dims: int) -> list:
    """Rows, coordinate sums, squared norms and squared distances per (k, cluster): as many rows as centres."""
    sums = [f"sum(x{i}) as y{i}" for i in range(dims)]
    rows = assigned.selectExpr("*", "e.k as k", f"{_norm(dims)} as norm").groupBy("k", "cluster")
    return rows.agg(*map(F.expr, ["count(*) as n", "sum(sq) as cost", "sum(norm) as psi", *sums])).collect()


def _moved(points: DataFrame, dims: int, centres: dict[int, np.ndarray], width: int) -> dict[int, np.ndarray]:
    """The centres after Lloyd's rounds; a k leaves when it has settled, a centre without rows stays."""
    done, moving, cost = {}, {k: c.copy() for k, c in centres.items()}, dict.fromkeys(centres, np.inf)
    for _ in range(ROUNDS):
        before, cost_before = {k: c.copy() for k, c in moving.items()}, cost
        sums = _sums(_assigned(points, dims, moving, width), dims)
        cost = {k: sum(r["cost"] for r in sums if r["k"] == k) for k in moving}
        for r in sums:
            moving[r["k"]][r["cluster"]] = [r[f"y{i}"] / r["n"] for i in range(dims)]
        for k in list(moving):
            still = ((moving[k] - before[k]) ** 2).sum(1).max() <= STILL
            if still or cost_before[k] - cost[k] <= SETTLED * cost[k]:
                done[k] = moving.pop(k)
        if not moving:
            break
    return done | moving


def _silhouettes(points: DataFrame, dims: int, centres: dict[int, np.ndarray], width: int, sums: list) -> dict[int, float]:
    """The mean silhouette of squared Euclidean distance for each k, from the clusters' counts, sums and norms."""
    facts = {k: {"n": [None] * width, "psi": [None] * width, "y": [None] * width * dims} for k in centres}
    for r in sums:
        own, j = facts[r["k"]], r["cluster"]
        own["n"][j], own["psi"][j] = float(r["n"]), r["psi"] / r["n"]
        own["y"][j * dims : (j + 1) * dims] = [r[f"y{i}"] / r["n"] for i in range(dims)]
    # the mean squared distance to each cluster, null for one without rows
    dots = [" + ".join(f"x{i} * e.y[{j * dims + i}]" for i in range(dims)) for j in range(width)]
    means = [f"{_norm(dims)} + e.psi[{j}] - 2.0 * ({dot}) as m{j}" for j, dot in enumerate(dots)]
    inner = " ".join(f"when {j} then m{j}" for j in range(width))
    outer = _least([f"if(cluster = {j}, null, m{j})" for j in range(width)])
    rows = _assigned(points, dims, centres, width, facts).selectExpr("*", *means)
    rows = rows.selectExpr("e.k as k", "e.n[cluster] as n", f"case cluster {inner} end as own", f"{outer} as b")
    rows = rows.selectExpr("k", "n", "b", "try_divide(own * n, n - 1) as a")  # the mean over the others of its cluster
    value = F.expr("avg(if(n <= 1, 0.0D, coalesce(try_divide(b - a, greatest(a, b)), 0.0D))) as s")
    return {r["k"]: r["s"] for r in rows.groupBy("k").agg(value).collect()}


def fit_together(points: DataFrame, columns: list[str], ks: list[int], seed: int = 42) -> dict[int, Fit]:
    """A fit for each of ks, the cost of none above that of a smaller k.

    points: double columns without nulls, read once a round, so cached or durable, with at least
    max(ks) distinct rows.  Where a cost lies above the cost of the k before, that k starts again from the other's
    centres and the row farthest from them: a round never raises the cost.
    """
    if not ks:
        return {}
    ks, width, dims = sorted(ks), max(ks), len(columns)
    points = points.select(*[named(c).alias(f"x{i}") for i, c in enumerate(columns)])
    found, weights = _drawn(points, dims, max(DRAWN, DRAWN_PER_CENTRE * width), seed)
    centres = _moved(points, dims, {k: _start(found, weights, k, seed) for k in ks}, width)
    for _ in ks:  # each pass settles at least the lowest k that rose
        sums = _sums(_assigned(points, dims, centres, width), dims)
        cost = {k: sum(r["cost"] for r in sums if r["k"] == k) for k in ks}
        rose = {b: a for a, b in zip(ks, ks[1:]) if cost[b] > cost[a]}
        if not rose:
            break
        far = _assigned(points, dims, {a: centres[a] for a in rose.values()}, width).groupBy("e.k")
        farthest = F.expr(f"max_by(array({', '.join(f'x{i}' for i in range(dims))}), sq)")
        row = {r[0]: r[1] for r in far.agg(farthest).collect()}
        starts = {b: np.vstack([centres[a], *[[row[a]]] * (b - a)]) for b, a in rose.items()}
        centres |= _moved(points, dims, starts, width)
    silhouettes = _silhouettes(points, dims, centres, width, sums)
    return {k: Fit(centres[k], cost[k], silhouettes[k]) for k in ks}
