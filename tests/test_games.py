"""Small games with their possessions, stints, contracts, reasons and metrics written out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldglass.operators import box_metrics, classify, contracts, games, models

EVENT = "game_id string, action_id long, period int, secs double, kind string, sub_kind string, team string, value int, result string, text string"


def fold(spark, *events):
    rows = [("g", k, *e) for k, e in enumerate(events)]
    got = games.possessions(spark.createDataFrame(rows, EVENT)).orderBy("period", "poss_num").collect()
    return [(r["off_team"], r["points"], r["end_reason"], r["start_type"], r["orebs"], r["pts_first"], r["pts_after_oreb"]) for r in got]


def e(kind, team=None, sub=None, value=None, result=None, text=None, period=1, secs=700.0):
    return (period, secs, kind, sub, team, value, result, text)


def test_made_shot_and_defensive_rebound(spark):
    assert fold(spark, e("Made Shot", "A", value=3), e("Missed Shot", "B"), e("Rebound", "A"), e("Turnover", "A", "Bad Pass"), e("Missed Shot", "B"), e("period")) == [
        ("A", 3, "made_fg", "period_start", 0, 3, 0),
        ("B", 0, "def_rebound", "after_score", 0, 0, 0),
        ("A", 0, "turnover", "def_rebound", 0, 0, 0),
        ("B", 0, "period_end", "live_turnover", 0, 0, 0),
    ]


def test_and_one_with_a_foul_between(spark):
    assert fold(spark, e("Made Shot", "A", value=2), e("Foul", "B"), e("Free Throw", "A", "Free Throw 1 of 1", text="x"), e("Made Shot", "B")) == [
        ("A", 3, "made_ft", "period_start", 0, 3, 0),
        ("B", 2, "made_fg", "after_score", 0, 2, 0),
    ]


def test_missed_last_free_throw_and_putback(spark):
    got = fold(spark, e("Free Throw", "A", "1 of 2", text="a"), e("Free Throw", "A", "2 of 2", text="MISS a"), e("Rebound", "A"), e("Made Shot", "A", value=2))
    assert got == [("A", 3, "made_fg", "period_start", 1, 1, 2)]


def test_technical_free_throw_by_the_other_side_ends_it_without_points(spark):
    got = fold(spark, e("Missed Shot", "A"), e("Free Throw", "B", "Technical", text="x"), e("Made Shot", "A"))
    assert got == [("A", 0, "made_ft", "period_start", 0, 0, 0), ("A", 2, "made_fg", "after_score", 0, 2, 0)]


def test_rebound_without_a_miss_dead_turnover_and_new_period(spark):
    got = fold(spark, e("Rebound", "A"), e("Turnover", "A", "Traveling"), e("Missed Shot", "B"), e("Made Shot", "A", period=2))
    assert got == [("A", 0, "turnover", "period_start", 0, 0, 0), ("B", 0, "period_end", "dead_turnover", 0, 0, 0), ("A", 2, "made_fg", "period_start", 0, 2, 0)]


def test_rebound_without_a_team_or_after_a_turnover_or_a_made_free_throw(spark):
    team_less = fold(spark, e("Missed Shot", "A"), e("Rebound"), e("Rebound", "B"), e("Made Shot", "A", value=2))
    assert team_less == [("A", 2, "made_fg", "period_start", 0, 2, 0)]
    turned = fold(spark, e("Missed Shot", "A"), e("Turnover", "A", "Traveling"), e("Rebound", "B"), e("Made Shot", "B", value=2))
    assert turned == [("A", 0, "turnover", "period_start", 0, 0, 0), ("B", 2, "made_fg", "dead_turnover", 0, 2, 0)]
    made = fold(spark, e("Missed Shot", "A"), e("Free Throw", "A", "1 of 1", text="x"), e("Rebound", "A"), e("Made Shot", "A", value=2))
    assert made == [("A", 1, "made_ft", "period_start", 0, 1, 0), ("A", 2, "made_fg", "after_score", 0, 2, 0)]


def test_what_stands_between_a_basket_and_its_free_throw(spark):
    for kind in ("Substitution", "Jump Ball", "Violation", "Ejection", "Timeout", "", None):
        got = fold(spark, e("Made Shot", "A", value=2), e(kind, "B"), e("Free Throw", "A", "Free Throw 1 of 1", text="miss x"), e("Rebound", "B"))
        assert got == [("A", 2, "def_rebound", "period_start", 0, 2, 0), ("B", 0, "period_end", "def_rebound", 0, 0, 0)], kind


def test_offensive_rebound_of_the_side_without_the_ball_and_ends_of_periods(spark):
    got = fold(spark, e("Turnover", "B"), e("Free Throw", "A", "1 of 2", text="x"), e("Missed Shot", "B"), e("Rebound", "B"), e("Made Shot", "A", value=2))
    assert got[1] == ("A", 3, "made_fg", "dead_turnover", 0, 3, 0)
    rows = [("g", k, *x) for k, x in enumerate([e("Missed Shot", "A", secs=9.0), e("period", period=2, secs=720.0), e("Made Shot", "B", period=2, secs=700.0)])]
    ended = games.possessions(spark.createDataFrame(rows, EVENT)).orderBy("period").first()
    assert (ended["end_action"], ended["end_secs"], ended["end_reason"]) == (1, 720.0, "period_end")


def test_context_edges(spark):
    rows = [("g", 4, 1, "A", 300.0, 5), ("g", 4, 2, "B", 300.0, 0), ("g", 4, 3, "A", 301.0, 0)]
    poss = spark.createDataFrame(rows, "game_id string, period int, poss_num int, off_team string, start_secs double, points int")
    g = spark.createDataFrame([("g", "A", "B", "s", "regular")], "game_id string, home string, away string, season string, season_type string")
    got = games.possession_context(poss, g).orderBy("poss_num").collect()
    assert [(r["margin"], r["clutch"], r["def_team"]) for r in got] == [(0, True, "B"), (-5, True, "A"), (5, False, "B")]


ACTION = "game_id string, order_number long, period int, seconds_left double, kind string, sub_kind string, person long, points int, possession string"
BOX = "game_id string, person long, team string, starter boolean, seconds double, team_points int"


def test_stints_of_a_game_that_agrees_with_its_box(spark):
    box = [("g", p, "home", p < 5, {0: 360.0, 5: 360.0}.get(p, 720.0), 2) for p in range(6)] + [("g", p, "away", True, 720.0, 0) for p in range(10, 15)]
    actions = [("g", 1, 1, 700.0, "2pt", None, 0, 2, "home"), ("g", 2, 1, 360.0, "substitution", "out", 0, 0, None), ("g", 3, 1, 360.0, "substitution", "in", 5, 0, None), ("g", 4, 1, 300.0, "2pt", None, 10, 0, "away")]
    a, b = spark.createDataFrame(actions, ACTION), spark.createDataFrame(box, BOX)
    got = games.stints(a, b).orderBy("start_s").collect()
    assert [(r["seconds"], r["home_ids"], r["home_pts"], r["home_poss"], r["away_poss"], r["reliable"]) for r in got] == [(360.0, [0, 1, 2, 3, 4], 2, 1, 0, True), (360.0, [1, 2, 3, 4, 5], 0, 0, 1, True)]
    assert games.minutes_check(games.stints(a, b), b).where("NOT ok").count() == 0
    wrong = games.stints(a, spark.createDataFrame([(*x[:5], 9) for x in box], BOX))
    assert {r["reasons"] for r in wrong.collect()} == {"points"}


def test_contracts():
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    assert contracts.fold_contracts([(day(0), "twoway_sign", "A"), (day(5), "waive", "A"), (day(12), "claim", "B")]) == [("two_way", "A", day(0), day(5)), ("two_way", "B", day(12), None)]
    assert contracts.fold_contracts([(day(0), "twoway_sign", "A"), (day(5), "waive", "A"), (day(13), "claim", "B")])[-1][0] == "standard"
    # A claim that ends a spell goes by the one before it, if that ended within a week.
    assert contracts.fold_contracts([(day(0), "twoway_sign", "A"), (day(31), "claim", "B")]) == [("two_way", "A", day(0), day(31)), ("standard", "B", day(31), None)]
    assert contracts.fold_contracts([(day(0), "twoway_sign", "A"), (day(3), "sign", "A"), (day(5), "claim", "B")])[-1] == ("two_way", "B", day(5), None)
    assert contracts.fold_contracts([(day(0), "sign", "A"), (day(3), "trade", "B"), (day(4), "convert_to_twoway", None)]) == [("standard", "A", day(0), day(3)), ("standard", "B", day(3), day(4)), ("two_way", "B", day(4), None)]


def test_reasons(spark):
    texts = ["Injury/Illness - Left Knee; ACL Tear", "Injury/Illness - Illness", "Concussion Protocol", "Coach's Decision", "", None, "Injury/Illness - Right Calf Strain; Injury Management"]
    got = classify.injury_reason(spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, t string"), "t").orderBy("k").collect()
    assert [tuple(r)[2:] for r in got] == [
        ("injury", "left", "knee", "knee", "tear"),
        ("injury", None, "illness", "illness", "illness"),
        ("injury", None, "concussion", "head", "concussion"),
        ("coach", None, None, None, None),
        (None, None, None, None, None),
        (None, None, None, None, None),
        ("injury", "right", "calf", "lower leg", "strain"),
    ]


def test_clamped_means(spark):
    def slow(values, weights):
        """The rule in plain words: a running shift, and the mean of the originals shifted and clamped."""
        by = 0.0
        for _ in range(12):
            lacks = 3.0 - sum(min(5.0, max(1.0, v + by)) * w for v, w in zip(values, weights)) / (sum(weights) or 1.0)
            if abs(lacks) < 1e-9:
                break
            by += lacks
        return [min(5.0, max(1.0, v + by)) for v in values]

    cases = [([-1.0, 0.5, 2.0, 6.5, 7.0], [10.0, 20.0, 30.0, 5.0, 5.0]), ([1.2, 4.9, 6.0, -2.0, 3.3], [100.0, 900.0, 30.0, 5.0, 700.0]), ([3.0, 3.0], [1.0, 2.0]), ([9.0, 9.5], [0.0, 0.0])]
    df = spark.createDataFrame([(k, v, w) for k, (v, w) in enumerate(cases)], "k int, v array<double>, w array<double>")
    got = [r[0] for r in df.orderBy("k").select(models.clamp_normalise(F.col("v"), F.col("w"))).collect()]
    for (v, w), x in zip(cases, got):
        assert x == pytest.approx(slow(v, w), abs=1e-9)
    assert got[0] == pytest.approx([1.0, 2.1, 3.6, 5.0, 5.0], abs=0.01)


def test_box_plus_minus_adds_up_to_the_net_rating(spark):
    stats = ["pts", "fg3m", "ast", "tov", "orb", "drb", "trb", "stl", "blk", "pf", "fga", "fta"]
    players = [("T", f"p{k}", 500.0 + 100 * k, *(10.0 * (k + 1) + i for i in range(len(stats)))) for k in range(7)]
    p = spark.createDataFrame(players, "team string, who string, mp double, " + ", ".join(f"{s} double" for s in stats))
    total = [sum(x[3 + i] for x in players) for i in range(len(stats))]
    team = spark.createDataFrame([("T", sum(x[2] for x in players), 1000.0, 1000.0, 1050.0, 1020.0, 82, 104.0, *total)], "team string, team_mp double, poss double, opp_poss double, pts_team double, opp_pts double, gp int, league_ortg double, " + ", ".join(f"t_{s} double" for s in stats))
    got = box_metrics.box_plus_minus(p, team, ["team"], "who").join(p.select("who", "mp"), "who").collect()
    share = {r["who"]: r["mp"] / (sum(x[2] for x in players) / 5) for r in got}
    assert abs(sum(r["bpm"] * share[r["who"]] for r in got) - 3.0) < 0.05
    assert abs(sum(r["obpm"] * share[r["who"]] for r in got) - 1.0) < 0.05


def test_ridge_against_dense_algebra(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(int(k % 5), sorted(rng.choice(12, 4, replace=False).tolist()), float(rng.normal()), float(rng.integers(1, 9))) for k in range(300)]
    obs = spark.createDataFrame(rows, "fold int, columns array<int>, y double, w double")
    beta, lam, errors = models.ridge(obs, 12, "columns", "y", "w", "fold", (10.0, 100.0), {11: 1.0})
    x = np.zeros((300, 12))
    for k, r in enumerate(rows):
        x[k, r[1]] = 1
    y, w, fold = (np.array([r[k] for r in rows]) for k in (2, 3, 0))
    y = y - (y * w).sum() / w.sum()

    def solve(use, l):  # noqa: E741
        pull = np.full(12, l)
        pull[11] = 1.0
        return np.linalg.solve((x[use] * w[use, None]).T @ x[use] + np.diag(pull), (x[use] * w[use, None]).T @ y[use])

    slow = {l: sum((w[fold == f] * (y[fold == f] - x[fold == f] @ solve(fold != f, l)) ** 2).sum() for f in range(5)) for l in (10.0, 100.0)}  # noqa: E741
    assert errors == pytest.approx(slow) and lam == min(slow, key=slow.get)
    assert beta == pytest.approx(solve(np.full(300, True), lam))


def test_box_lines_of_stints_and_whether_they_match(spark):
    plays = [
        # order, period, left, kind, sub, result, person, assist, block, steal, points, team
        (1, 1, 700.0, "3pt", None, ": Made", 1, 2, None, None, 3, "home"),
        (2, 1, 690.0, "2pt", None, "Missed", 11, None, 3, None, 0, "away"),
        (3, 1, 689.0, "rebound", "offensive", None, 0, None, None, None, 0, "away"),
        (4, 1, 680.0, "turnover", "bad pass", None, 12, None, None, 4, 0, "away"),
        (5, 1, 660.0, "substitution", "out", None, 5, None, None, None, 0, "home"),
        (6, 1, 660.0, "substitution", "in", None, 6, None, None, None, 0, "home"),
        (7, 1, 640.0, "freethrow", "1 of 1", "Made", 6, None, None, None, 1, "home"),
        (8, 1, 630.0, "rebound", "defensive", None, 13, None, None, None, 0, "away"),
        (9, 1, 620.0, "turnover", "shot clock", None, 0, None, None, None, 0, "home"),
    ]
    a = spark.createDataFrame([("g", *p, p[-1]) for p in plays], "game_id string, order_number long, period int, seconds_left double, kind string, sub_kind string, result string, person long, assist long, block long, steal long, points int, team string, possession string")
    people = [("g", p, "home" if p < 10 else "away", p not in (6, 7, 16), 0.0, None) for p in (1, 2, 3, 4, 5, 6, 11, 12, 13, 14, 15, 16)]
    box = spark.createDataFrame(people, "game_id string, person long, team string, starter boolean, seconds double, team_points int")
    got = games.stints(games.with_tallies(a), box)
    lines = [{c: r[c] for c in r.asDict() if c.split("_")[-1] in games.BOX_TALLIES and r[c]} for r in got.orderBy("start_s", "end_s").collect()]
    assert [x for x in lines if x] == [{"home_fgm": 1, "home_fga": 1, "home_fg3m": 1, "home_fg3a": 1, "home_ast": 1, "home_stl": 1, "home_blk": 1, "away_fga": 1, "away_tov": 1}, {"home_ftm": 1, "home_fta": 1, "home_tov": 1, "away_drb": 1}]
    teams = "game_id string, side string, fga int, fgm int, fg3a int, fta int"
    right, wrong = (spark.createDataFrame([("g", "home", 1, 1, 1, 1), ("g", "away", n, None, None, None)], teams) for n in (1, 2))
    assert [games.factors_match(got, x).collect()[0]["factors_match"] for x in (right, wrong)] == [True, False]
    assert "home_fgm" not in games.stints(a.drop("team"), box).columns
