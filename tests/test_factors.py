"""Factors, worth and weighted least squares against dense algebra on a fixture."""

import numpy as np
import pytest

from fieldglass.operators import models as R
from fieldglass.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"
SIDES = ("home", "away")


def stints(spark, games=120, n=12):
    rng = np.random.default_rng(4)
    rows = []
    for game in range(games):
        for _ in range(4):
            who = rng.permutation(n)[:10].tolist()
            row = [game, who[:5], who[5:], game % 17 != 3]
            for _ in SIDES:
                fga, fta, orb, drb, tov = (int(rng.integers(a, b)) for a, b in ((14, 24), (0, 6), (0, 5), (4, 9), (0, 6)))
                fgm, ftm = int(rng.integers(3, 12)), int(rng.integers(0, fta + 1))
                fg3m = int(rng.integers(0, fgm + 1) // 2)
                row += [fgm, fga, fg3m, fta, ftm, orb, drb, tov, 2 * fgm + fg3m + ftm, fga + int(0.44 * fta) - orb + tov]
            rows.append(tuple(row))
    names = ", ".join(f"{s}_{c} int" for s in SIDES for c in (*R.TALLIES, "pts", "poss"))
    return spark.createDataFrame(rows, f"game int, home_ids array<long>, away_ids array<long>, factors_match boolean, {names}"), rows


def observations(rows):
    k = len(R.TALLIES)
    for r in rows:
        home, away = (dict(zip((*R.TALLIES, "pts", "poss"), r[at : at + k + 2])) for at in (4, 4 + k + 2))
        yield r[0], r[1], r[2], 1, home, away, r[3]
        yield r[0], r[2], r[1], 0, away, home, r[3]


def dense(n, obs, fold, lambdas):
    """obs: (attack, defend, home, y, w)."""
    x = np.zeros((len(obs), 2 * n + 1))
    for at, (attack, defend, home, _, _) in enumerate(obs):
        x[at, attack] = 1
        x[at, [n + p for p in defend]] = 1
        x[at, 2 * n] = home
    y, w = (np.array([o[c] for o in obs], float) for c in (3, 4))
    y = y - (y * w).sum() / w.sum()

    def solve(use, lam):
        pull = np.full(2 * n + 1, lam)
        pull[-1] = 1.0
        return np.linalg.solve((x[use] * w[use, None]).T @ x[use] + np.diag(pull), (x[use] * w[use, None]).T @ y[use])

    errors = {lam: sum((w[fold == f] * (y[fold == f] - x[fold == f] @ solve(fold != f, lam)) ** 2).sum() for f in set(fold.tolist())) for lam in lambdas}
    return solve(np.full(len(y), True), min(errors, key=errors.get))


def test_factors_and_worth_against_dense_algebra(spark):
    df, rows = stints(spark)
    n = 12
    players = spark.range(n).selectExpr("id AS player", "CAST(id AS INT) AS k")
    folds = spark.range(120).selectExpr("CAST(id AS INT) AS game", "id % 3 AS fold")
    got = {r["player"]: r for r in R.six_factors(df, players, folds).collect()}
    obs = [o for o in observations(rows) if o[6]]
    fold = np.array([o[0] % 3 for o in obs])
    tries = lambda o: o["fga"] + 0.44 * o["fta"]
    rate = {
        "ts": lambda o, d: (o["pts"] / (2 * tries(o)), tries(o)),
        "tov": lambda o, d: (o["tov"] / o["poss"], o["poss"]),
        "orb": lambda o, d: (o["orb"] / (o["orb"] + d["drb"]), o["orb"] + d["drb"]),
        "ft": lambda o, d: (o["ftm"] / o["fga"], o["fga"]),
    }
    games = {}
    for game, _, _, home, o, d, _ in obs:
        own, other = games.setdefault((game, home), ({}, {}))
        for into, add in ((own, o), (other, d)):
            for c, v in add.items():
                into[c] = into.get(c, 0) + v
    kept = [(o, d) for o, d in games.values() if o["poss"] >= 40]
    x = np.array([[1.0, *(rate[k](o, d)[0] for k in R.WORTH)] for o, d in kept])
    y, w = np.array([100 * o["pts"] / o["poss"] for o, _ in kept]), np.array([o["poss"] for o, _ in kept], float)
    beta = np.linalg.lstsq(x * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
    left = y - x @ beta
    r2 = 1 - (w * left**2).sum() / (w * (y - np.average(y, weights=w)) ** 2).sum()
    assert r2 > 0.8 and len(kept) > 50
    for k, sign in R.FACTOR_SIGNS.items():
        want = dense(n, [(a, b, home, *rate[k](o, d)) for _, a, b, home, o, d, _ in obs], fold, R.FACTOR_LAMBDAS)
        for p in range(n):
            assert got[p][f"o_{k}"] == pytest.approx(100 * sign * want[p], abs=1e-8)
            assert got[p][f"d_{k}"] == pytest.approx(-100 * sign * want[n + p], abs=1e-8)
            if k in R.WORTH:
                assert got[p][f"o_{k}_pts"] == pytest.approx(beta[1 + R.WORTH.index(k)] * want[p], abs=1e-7)
    assert all(r["r2"] == pytest.approx(r2) for r in got.values())
    few = df.where("game < 5")
    assert R.six_factors(few, players, folds).count() == 0 and R.six_factors(df.limit(0), players, folds).count() == 0


def test_least_squares_with_seasons_left_out(spark):
    rng = np.random.default_rng(9)
    rows = [(k % 4, float(rng.normal()), float(rng.normal()), float(rng.normal()), float(rng.integers(1, 9))) for k in range(200)]
    got = R.wls(spark.createDataFrame(rows, "s int, a double, b double, y double, w double"), "s", ["a", "b"], "y", "w")
    season, a, b, y, w = (np.array(c) for c in zip(*rows))
    x = np.column_stack([np.ones(200), a, b])

    def of(use):
        q = np.sqrt(w[use])
        return np.linalg.lstsq(x[use] * q[:, None], y[use] * q, rcond=None)[0]

    def r2(use, beta):
        return 1 - (w[use] * (y[use] - x[use] @ beta) ** 2).sum() / (w[use] * (y[use] - np.average(y[use], weights=w[use])) ** 2).sum()

    every = np.full(200, True)
    assert got["betas"] == pytest.approx(of(every)) and got["r2"] == pytest.approx(r2(every, of(every)))
    assert got["held"] == pytest.approx({s: r2(season == s, of(season != s)) for s in range(4)})
    assert got["sd"] == pytest.approx([float(np.sqrt(np.cov(c, aweights=w))) for c in (a, b)]) and got["n"] == 200
    assert R.wls(spark.createDataFrame([], "s int, a double, y double, w double"), "s", ["a"], "y", "w") is None


def test_worth_of_the_registered_stints_is_told_by_the_factors(spark):
    rows = QUERIES["six_factor_impact"](spark, FOLDER).collect()
    assert len(rows) == 40 and all(r["r2"] >= 0.8 for r in rows)
    terms = QUERIES["wls_multi"](spark, FOLDER).collect()
    assert len(terms) == 14 and {r["model"] for r in terms} == {"four", "six", "six+ft"}
