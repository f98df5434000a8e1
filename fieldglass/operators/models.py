"""Regressions from sums: normal equations are aggregates, whose solution is found on the driver or, if they are large, by
conjugate gradients on the table of their cells.

The unknowns of one fit are players or factors of one league window.  Their number is checked before cells come to the
driver: beyond ``MOST_UNKNOWNS`` only vectors do, of a number for each unknown.  Rows never do."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.lake import settled

# Penalties that are tried.
LAMBDAS = (250.0, 500.0, 1000.0, 2000.0, 3000.0, 5000.0, 8000.0, 12000.0)
#: Unknowns that are solved for on the driver, whose matrix takes 8 bytes for each pair.
MOST_UNKNOWNS = 6000
#: Numbers in the vectors that conjugate gradients carry on at once, and the residual, to that of no step, that ends them.
AT_ONCE = 4_000_000
RESIDUAL = 1e-11


def simple_wls(df: DataFrame, key: list[str], x: str, y: str, w: str) -> DataFrame:
    """slope, intercept and r2 of y on x weighted by w, in closed form."""
    s = {name: F.sum(e) for name, e in (("w", F.col(w)), ("x", F.col(w) * F.col(x)), ("y", F.col(w) * F.col(y)), ("xx", F.col(w) * F.col(x) * F.col(x)), ("xy", F.col(w) * F.col(x) * F.col(y)), ("yy", F.col(w) * F.col(y) * F.col(y)))}
    sums = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & (F.col(w) > 0)).groupBy(*key).agg(*(v.cast("double").alias(f"_{k}") for k, v in s.items()), F.count(F.lit(1)).alias("n"))
    c = lambda name: F.col(f"_{name}")
    sxx, sxy, syy = c("xx") - c("x") * c("x") / c("w"), c("xy") - c("x") * c("y") / c("w"), c("yy") - c("y") * c("y") / c("w")
    slope = sxy / F.nullif(sxx, F.lit(0.0))
    return sums.select(*key, "n", slope.alias("slope"), ((c("y") - slope * c("x")) / c("w")).alias("intercept"), (sxy * sxy / F.nullif(sxx * syy, F.lit(0.0))).alias("r2"))


def gram(df: DataFrame, key: list[str], columns: list[str], weight: Column | None = None) -> DataFrame:
    """(key, i, j, value): weighted sums of products of every two columns, i <= j, in one pass."""
    w = F.lit(1.0) if weight is None else weight
    k = len(columns)
    cells = [(i, j, F.sum(w * F.col(columns[i]) * F.col(columns[j]))) for i in range(k) for j in range(i, k)]
    wide = df.groupBy(*key).agg(*(v.alias(f"c{i}_{j}") for i, j, v in cells))
    rows = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"c{i}_{j}").alias("value")) for i, j, _ in cells))
    return wide.select(*key, F.inline(rows))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r): correlations of every two columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*(F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)))
    return wide.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)))))


def unit_sums(obs: DataFrame, by: list[str], targets: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Weight, weighted value and its weighted square by target, of the rows that are alike; stored, as all that follows
    is made from these sums.

    targets: value and weight by name."""
    sums = [F.sum(x).alias(f"{s}_{k}") for k, (y, w) in targets.items() for s, x in (("w", w), ("wy", w * y), ("wyy", w * y * y))]
    return settled(obs.groupBy(*by).agg(*sums))


def sums_by_fold(units: DataFrame, fold: str, columns: Column, targets: dict[str, tuple[Column, Column]]) -> tuple[DataFrame, DataFrame]:
    """Sums for regressions on 0/1 rows, whose columns are an array, from ``unit_sums``: cells (fold, i, j with i <= j, and by
    target the weight and, where i = j, the weighted value) and totals by fold.  The design matrix is never laid out."""
    i = units.withColumn("_columns", F.sort_array(columns)).select("*", F.posexplode("_columns").alias("at", "i"))
    pairs = i.select("*", F.explode(F.slice("_columns", F.col("at") + 1, F.size("_columns"))).alias("j"))
    cells = pairs.groupBy(fold, "i", "j").agg(*(x for k in targets for x in (F.sum(f"w_{k}").alias(f"w_{k}"), F.sum(F.when(F.col("i") == F.col("j"), F.col(f"wy_{k}"))).alias(f"wy_{k}"))))
    return cells, units.groupBy(fold).agg(*(F.sum(f"{s}_{k}").alias(f"{s}_{k}") for k in targets for s in ("w", "wy", "wyy")))


def _dense(cells: DataFrame, n: int, target: str) -> tuple[np.ndarray, np.ndarray]:
    got = cells.select("i", "j", F.col(f"w_{target}").cast("double").alias("w"), F.col(f"wy_{target}").cast("double").alias("wy")).toArrow()
    i, j, w, wy = (got[c].to_numpy() for c in ("i", "j", "w", "wy"))
    a, b = np.zeros((n, n)), np.zeros(n)
    a[i, j] = a[j, i] = w
    b[i[i == j]] = wy[i == j]
    return a, b


def fit(cells: DataFrame, totals: DataFrame, n: int, fold: str, target: str, lambdas=LAMBDAS, light: dict[int, float] | None = None) -> tuple[np.ndarray, float, dict[float, float]]:
    """(coefficients, lambda, squared errors by lambda) of one target of ``sums_by_fold``, whose columns are 0 to n - 1.

    light: penalties of single columns instead of lambda.  Ties go to the first lambda.  The driver holds the cells of all
    folds added up and those of one fold at a time, n * n numbers each; see ``_fit_by_steps`` for more unknowns."""
    if n > MOST_UNKNOWNS:
        return _fit_by_steps(cells, totals, n, fold, target, lambdas, light or {})
    sums = {r[fold]: [float(r[f"{s}_{target}"] or 0) for s in ("w", "wy", "wyy")] for r in totals.collect()}
    weight = sum(s[0] for s in sums.values())
    mean = sum(s[1] for s in sums.values()) / weight if weight else 0.0
    a, b = _dense(cells.groupBy("i", "j").agg(*(F.sum(f"{s}_{target}").alias(f"{s}_{target}") for s in ("w", "wy"))), n, target)
    b -= mean * a.diagonal()

    def solve(a: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
        pull = np.full(n, lam)
        for k, v in (light or {}).items():
            pull[k] = v
        return np.linalg.solve(a + np.diag(pull), b)

    errors = dict.fromkeys(lambdas, 0.0)
    for name, (w, wy, wyy) in sums.items():
        fa, fb = _dense(cells.where(F.col(fold).eqNullSafe(F.lit(name))), n, target)
        fb -= mean * fa.diagonal()
        square = wyy - 2 * mean * wy + mean * mean * w
        for lam in lambdas:
            beta = solve(a - fa, b - fb, lam)
            errors[lam] += square - 2 * beta @ fb + beta @ fa @ beta
    best = min(errors, key=errors.get)
    return solve(a, b, best), best, errors


class _Cells:
    """The cells of a target as a table, both halves, and what is needed of them as vectors: by fold, the diagonal and the
    weighted values."""

    def __init__(self, cells: DataFrame, n: int, fold: str, target: str) -> None:
        w, wy = (F.col(f"{c}_{target}").cast("double").alias(c) for c in ("w", "wy"))
        own = cells.select(F.col(fold).alias("fold"), "i", "j", w, wy)
        half = own.select("fold", "i", "j", "w")
        self.n, self.spark = n, cells.sparkSession
        self.both = settled(half.unionByName(half.where("i <> j").select("fold", F.col("j").alias("i"), F.col("i").alias("j"), "w")))
        self.diagonal, self.values = {}, {}
        got = own.where("i = j").groupBy("fold", "i").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy")).toArrow()
        folds, i = got["fold"].to_pylist(), got["i"].to_numpy()
        for f in set(folds):
            at = np.array([x == f for x in folds])
            for of, c in ((self.diagonal, "w"), (self.values, "wy")):
                of[f] = np.zeros(n)
                of[f][i[at]] = got[c].to_numpy()[at]

    def times(self, x: np.ndarray, counts: list[Column]) -> np.ndarray:
        """The cells times the columns of x; counts: which folds' cells count for each.  One join and one aggregate."""
        names = [f"x{k}" for k in range(x.shape[1])]
        vectors = self.spark.createDataFrame(pa.table({"j": np.arange(self.n, dtype=np.int32)} | dict(zip(names, x.T, strict=True))))
        sums = [F.sum(F.when(test, F.col("w") * F.col(c))).alias(c) for c, test in zip(names, counts, strict=True)]
        got = self.both.join(vectors, "j").groupBy("i").agg(*sums).toArrow()
        out = np.zeros_like(x)
        for k, c in enumerate(names):
            out[got["i"].to_numpy(), k] = got[c].fill_null(0.0).to_numpy()
        return out


def conjugate_gradients(times, b: np.ndarray, scale: np.ndarray, residual: float = RESIDUAL) -> np.ndarray:
    """x with times(x) = b for several systems at once, a column each; times may give any symmetric positive definite
    products.  scale: about their diagonals.  A column is done when its residual is that small a part of b."""
    x, r = np.zeros_like(b), b.copy()
    size = np.sqrt((b * b).sum(0))
    z = r / scale
    p, rz = z.copy(), (r * z).sum(0)
    while (on := np.sqrt((r * r).sum(0)) > residual * size).any():
        ap = times(p)
        step = np.where(on, rz / np.where(on, (p * ap).sum(0), 1.0), 0.0)
        x += step * p
        r -= step * ap
        z = r / scale
        before, rz = rz, (r * z).sum(0)
        p = np.where(on, z + np.where(on, rz / np.where(before == 0, 1.0, before), 0.0) * p, 0.0)
    return x


def _fit_by_steps(cells: DataFrame, totals: DataFrame, n: int, fold: str, target: str, lambdas, light: dict[int, float]) -> tuple[np.ndarray, float, dict[float, float]]:
    """``fit`` by conjugate gradients: the fits of all folds and lambdas go on together, as many as ``AT_ONCE`` numbers hold,
    and each step is one product of the cells' table with their vectors."""
    sums = {r[fold]: [float(r[f"{s}_{target}"] or 0) for s in ("w", "wy", "wyy")] for r in totals.collect()}
    weight = sum(s[0] for s in sums.values())
    mean = sum(s[1] for s in sums.values()) / weight if weight else 0.0
    of = _Cells(cells, n, fold, target)
    zero = np.zeros(n)
    diagonal = {f: of.diagonal.get(f, zero) for f in sums}
    right = {f: of.values.get(f, zero) - mean * diagonal[f] for f in sums}
    here = lambda f: F.col("fold").eqNullSafe(F.lit(f))
    fits = [(True, f, lam) for lam in lambdas for f in sums] + [(False, None, lam) for lam in lambdas]
    errors, whole = dict.fromkeys(lambdas, 0.0), {}
    width = max(1, AT_ONCE // n)
    for at in range(0, len(fits), width):
        some = fits[at : at + width]
        pull = np.stack([np.full(n, lam) for _, _, lam in some], axis=1)
        for k, v in light.items():
            pull[k] = v
        others = lambda parts, held, f: sum(v for g, v in parts.items() if not held or g != f) + zero
        b = np.stack([others(right, held, f) for held, f, _ in some], axis=1)
        scale = pull + np.stack([others(diagonal, held, f) for held, f, _ in some], axis=1)
        counts = [~here(f) if held else F.lit(True) for held, f, _ in some]
        beta = conjugate_gradients(lambda x, c=counts, p=pull: of.times(x, c) + p * x, b, scale)
        mine = of.times(beta, [here(f) if held else F.lit(False) for held, f, _ in some])
        for k, (held, f, lam) in enumerate(some):
            if held:
                w, wy, wyy = sums[f]
                errors[lam] += wyy - 2 * mean * wy + mean * mean * w - 2 * beta[:, k] @ right[f] + beta[:, k] @ mine[:, k]
            else:
                whole[lam] = beta[:, k]
    best = min(errors, key=errors.get)
    return whole[best], best, errors


def ridge(obs: DataFrame, n: int, columns: str, y: str, w: str, fold: str, lambdas=LAMBDAS, light: dict[int, float] | None = None) -> tuple[np.ndarray, float, dict[float, float]]:
    """``fit`` of one target of 0/1 rows whose columns are an array of indexes: weighted ridge, lambda by folds."""
    target = {"y": (F.col(y), F.col(w))}
    cells, totals = sums_by_fold(unit_sums(obs, [fold, columns], target), fold, F.col(columns), target)
    return fit(settled(cells), totals, n, fold, "y", lambdas, light)


TALLIES = ("fgm", "fga", "fg3m", "fta", "ftm", "orb", "drb", "tov")
ATTACK, DEFENCE, HOME = 0, 1, 2


def two_ways(stints: DataFrame, tallies: tuple[str, ...] = ()) -> DataFrame:
    """(game, attack, defend, home, pts, poss): two rows a stint, one for each side with possessions; with tallies, the
    attacking side's as o_* and the other's as d_*, 0 where unknown."""
    of = lambda side, as_: [F.coalesce(F.col(f"{side}_{c}"), F.lit(0)).alias(f"{as_}_{c}") for c in tallies]
    sides = [
        F.struct(F.col(f"{o}_ids").alias("attack"), F.col(f"{d}_ids").alias("defend"), F.lit(home).alias("home"), F.coalesce(F.col(f"{o}_pts"), F.lit(0)).alias("pts"), F.col(f"{o}_poss").cast("double").alias("poss"), *of(o, "o"), *of(d, "d"))
        for o, d, home in (("home", "away", True), ("away", "home", False))
    ]
    kept = [c for c in ("game", "factors_match") if c in stints.columns]
    return stints.select(*kept, F.inline(F.array(*sides))).where("poss > 0")


def _numbered(cells: DataFrame, players: DataFrame, n: int) -> DataFrame:
    """Cells of roles as cells of numbers: attackers from 0, defenders from n, home at 2 * n."""
    for c in ("i", "j"):
        number = players.select(F.col("player").alias(f"_{c}"), F.col("k").alias("_k"))
        few = F.broadcast(number) if n <= MOST_UNKNOWNS else number
        named = cells.join(few, F.col(f"{c}.player") == F.col(f"_{c}"), "left")
        k = F.when(F.col(f"{c}.role") == HOME, 2 * n).otherwise(F.col("_k") + F.col(f"{c}.role") * n)
        cells = named.withColumn(c, k.cast("int")).drop(f"_{c}", "_k")
    return cells.where("i IS NOT NULL AND j IS NOT NULL")


def _role_sums(ways: DataFrame, players: DataFrame, n: int, targets: dict[str, tuple[Column, Column]]) -> tuple[DataFrame, DataFrame]:
    role = lambda k, c: F.transform(c, lambda p: F.struct(F.lit(k).alias("role"), p.alias("player")))
    attack = role(ATTACK, F.col("attack"))
    kind = next(f.dataType.elementType for f in ways.schema.fields if f.name == "attack")
    home = F.array(F.struct(F.lit(HOME).alias("role"), F.lit(None).cast(kind).alias("player")))
    columns = F.concat(attack, role(DEFENCE, F.col("defend")), F.when(F.col("home"), home).otherwise(F.filter(attack, lambda x: F.lit(False))))
    cells, totals = sums_by_fold(unit_sums(ways, ["fold", "attack", "defend", "home"], targets), "fold", columns, targets)
    return settled(_numbered(cells, players, n)), totals


def player_impact(stints: DataFrame, players: DataFrame, folds: DataFrame, lambdas=LAMBDAS) -> DataFrame:
    """(player, offence, defence, total) from stints (game, home_ids, away_ids: arrays of five; home_pts, away_pts,
    home_poss, away_poss): two rows a stint, points per 100 possessions, by ridge with folds of games.

    players (player, k) numbers the players from 0, others are left out of the fit; folds (game, fold) deals out the games."""
    n = players.count()
    ways = two_ways(stints).join(folds, "game")
    cells, totals = _role_sums(ways, players, n, {"net": (F.col("pts") * 100.0 / F.col("poss"), F.col("poss"))})
    beta, lam, _ = fit(cells, totals, 2 * n + 1, "fold", "net", lambdas, {2 * n: 1.0})
    rated = stints.sparkSession.createDataFrame([(k, float(beta[k]), float(-beta[n + k])) for k in range(n)], "k int, offence double, defence double")
    return players.join(rated, "k").select("player", "offence", "defence", (F.col("offence") + F.col("defence")).alias("total"), F.lit(lam).alias("lambda"))


# Penalties that are tried for factors, and how well points must be told by them to be split.
FACTOR_LAMBDAS = (50.0, 100.0, 250.0, 500.0, 1000.0, 2000.0, 4000.0, 8000.0, 16000.0)
LEAST_FACTOR_R2, LEAST_TEAM_GAMES, LEAST_POSSESSIONS = 0.80, 50, 40
#: Factors and whether more of one is good (1) or bad (-1) for the attacking side; ft carries no points.
FACTOR_SIGNS = {"ts": 1, "tov": -1, "orb": 1, "ft": 1}
WORTH = ("ts", "tov", "orb")


def shooting_tries(of: str = "o") -> Column:
    return F.col(f"{of}_fga") + 0.44 * F.col(f"{of}_fta")


def factor_rates() -> dict[str, tuple[Column, Column]]:
    """Value and weight of each factor in rows of ``two_ways``; no weight where a rate has no base."""
    tries, rebounds = shooting_tries(), F.col("o_orb") + F.col("d_drb")
    parts = {"ts": (F.col("pts") / 2, tries), "tov": (F.col("o_tov"), F.col("poss")), "orb": (F.col("o_orb"), rebounds), "ft": (F.col("o_ftm"), F.col("o_fga"))}
    return {k: (F.when(base != 0, part / base).otherwise(0.0), base.cast("double")) for k, (part, base) in parts.items()}


def team_games(ways: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``two_ways`` added up by game and side, with the rates efg, ts, tov, orb and ft and points per 100
    possessions (y, of weight poss).  Left out are sides with under 40 possessions or without tries or rebounds."""
    summed = ways.groupBy(*key, "home").agg(*(F.sum(c).alias(c) for c in ("pts", "poss", *(f"o_{t}" for t in TALLIES), "d_drb")))
    whole = summed.where((F.col("poss") >= LEAST_POSSESSIONS) & (F.col("o_fga") != 0) & (F.col("o_orb") + F.col("d_drb") != 0))
    rates = {k: value for k, (value, _) in factor_rates().items()}
    efg = (F.col("o_fgm") + 0.5 * F.col("o_fg3m")) / F.col("o_fga")
    return whole.select(*key, "home", efg.alias("efg"), *(v.alias(k) for k, v in rates.items()), (F.col("pts") * 100.0 / F.col("poss")).alias("y"), "poss")


def wls(df: DataFrame, by: str, x: list[str], y: str, w: str) -> dict | None:
    """Weighted least squares of y on x and a constant: betas (the constant first), r2, the r2 of each value of ``by`` under
    the betas of all others, weighted deviations of x, and the number of rows; None without rows.

    One aggregate gives sums of products by ``by``; what the driver gets is those, never rows."""
    names = ["_one", *x, y, w]
    d = df.select(by, *x, y, w).withColumn("_one", F.lit(1.0))
    k, got = len(names), {}
    for r in gram(d, [by], names, F.col(w)).collect():
        a = got.setdefault(r[by], np.zeros((k, k)))
        a[r["i"], r["j"]] = a[r["j"], r["i"]] = float(r["value"] or 0)
    if not got:
        return None
    p = len(x) + 1

    def betas(a: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(a[:p, :p], a[:p, p], rcond=None)[0]

    def r2(a: np.ndarray, b: np.ndarray) -> float:
        about = a[p, p] - a[0, p] ** 2 / a[0, 0]
        return float(1 - (a[p, p] - 2 * b @ a[:p, p] + b @ a[:p, :p] @ b) / about) if about > 0 else float("nan")

    total = sum(got.values())
    b = betas(total)
    held = {name: r2(a, betas(total - a)) for name, a in got.items()} if len(got) > 1 else {}
    weight, squares = total[0, 0], total[0, p + 1]
    sd = [float(np.sqrt(max(0.0, (total[i, i] - total[0, i] ** 2 / weight) / (weight - squares / weight)))) for i in range(1, p)]
    return {"betas": b, "r2": r2(total, b), "held": held, "sd": sd, "n": df.count()}


def six_factors(stints: DataFrame, players: DataFrame, folds: DataFrame, lambdas=FACTOR_LAMBDAS) -> DataFrame:
    """(player, o_ts, d_ts, ...: each factor's effect in percent, good when positive; o_ts_pts, d_ts_pts, ...: its worth in
    points per 100 possessions; r2) from stints with home_* and away_* ``TALLIES``; games whose factors_match is false have
    no part.  No rows if team games are fewer than 50 or tell under 0.8 of the points."""
    n = players.count()
    ways = two_ways(stints, TALLIES)
    if "factors_match" in ways.columns:
        ways = ways.where("factors_match IS NULL OR factors_match").drop("factors_match")
    ways = settled(ways.join(folds, "game"))
    worth = wls(team_games(ways, ["game", "fold"]), "fold", list(WORTH), "y", "poss")
    names = [c for k in FACTOR_SIGNS for c in (f"o_{k}", f"d_{k}", *((f"o_{k}_pts", f"d_{k}_pts") if k in WORTH else ()))]
    schema = ", ".join(["k int", *(f"{c} double" for c in names), "r2 double"])
    rows = []
    if worth and worth["n"] >= LEAST_TEAM_GAMES and worth["r2"] >= LEAST_FACTOR_R2:
        points = dict(zip(WORTH, worth["betas"][1:], strict=True))
        cells, totals = _role_sums(ways, players, n, factor_rates())
        columns = []
        for k, sign in FACTOR_SIGNS.items():
            beta, _, _ = fit(cells, totals, 2 * n + 1, "fold", k, lambdas, {2 * n: 1.0})
            own, other = beta[:n], beta[n : 2 * n]
            columns += [100 * sign * own, -100 * sign * other]
            if k in points:
                columns += [points[k] * own, -points[k] * other]
        rows = [(at, *(float(c[at]) for c in columns), worth["r2"]) for at in range(n)]
    rated = stints.sparkSession.createDataFrame(rows, schema)
    return players.join(rated, "k").select("player", *names, "r2")


def let(value: Column, of) -> Column:
    """of(value), with value computed once inside a higher-order function."""
    return F.element_at(F.transform(F.array(value), of), 1)


def clamp_normalise(values: Column, weights: Column, target: float = 3.0, low: float = 1.0, high: float = 5.0, rounds: int = 12) -> Column:
    """An array shifted as a whole and clamped, so that its weighted mean comes to target.

    One shift is built up, round by round, from what the mean of the clamped values lacks, until that is within 1e-9; the
    values themselves are clamped once, at the end.  Weights without a sum count as a sum of 1."""
    clamped = lambda x, by: F.greatest(F.lit(low), F.least(F.lit(high), x + by))

    def shift(pairs: Column, total: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            lacks = F.lit(target) - F.aggregate(pairs, F.lit(0.0), lambda a, x: a + clamped(x["v"], at["by"]) * x["w"]) / total
            more = let(lacks, lambda x: F.when(F.abs(x) < 1e-9, F.struct(at["by"].alias("by"), F.lit(True).alias("done"))).otherwise(F.struct((at["by"] + x).alias("by"), F.lit(False).alias("done"))))
            return F.when(at["done"], at).otherwise(more)

        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(F.lit(0.0).alias("by"), F.lit(False).alias("done")), step, lambda at: at["by"])

    def shifted(pairs: Column) -> Column:
        total = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x["w"])
        by = let(F.when(total == 0, F.lit(1.0)).otherwise(total), lambda whole: shift(pairs, whole))
        return let(by, lambda by: F.transform(pairs, lambda x: clamped(x["v"], by)))

    # Values and weights are put together once, not anew in every round.
    return let(F.zip_with(values, weights, lambda v, w: F.struct(v.alias("v"), w.alias("w"))), shifted)
