"""What a task sorts or adds up stays of one size as tables grow, and rows are dealt out once by key."""

import pytest

from fieldglass.plans import registry
from fieldglass.plans.catalogue import QUERIES
from fieldglass.sources.lake import table
from tests import test_queries as as_sql

FOLDER, duck = as_sql.FOLDER, as_sql.duck

LINES = ("overtime_from_minutes", "rank_with_ties", "games_from_lines", "rate_modes", "disagreement", "both_ends_shots", "feed_box_lines", "box_page_lines", "career_regular", "arc_values", "quota_tracker", "player_season", "lineup_measures")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def largest(df):
    return max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(registry, "ROWS_A_TASK", 300)


def test_parts_grow_with_the_lines(spark, small_tasks):
    t = lambda name: table(spark, FOLDER, name)
    n = t("lineitem").count()
    assert registry.line_parts(t) == -(-n // 300) > 4
    assert largest(registry.box(t)) < 600


@pytest.mark.parametrize("name", LINES)
def test_parts_leave_the_rows_as_they_are(spark, duck, small_tasks, name):
    as_sql.test_same_rows_as_sql(spark, duck, name)


def test_tables_that_the_cores_hold_are_left_to_spark(spark):
    assert registry.line_parts(lambda name: table(spark, FOLDER, name)) is None


def test_fives_are_put_together_without_their_sums(spark):
    got = [x for x in plan(QUERIES["lineup_measures"](spark, FOLDER)).splitlines() if "collect_list" in x]
    assert got and all("keys=[five" in x for x in got)


def test_player_season_sends_each_row_once(spark):
    assert "Expand" not in plan(QUERIES["player_season"](spark, FOLDER))


@pytest.mark.parametrize("name", ("disagreement", "arc_values", "career_regular"))
def test_windows_over_players_have_as_many_parts(spark, small_tasks, name):
    n = registry.line_parts(lambda of: table(spark, FOLDER, of))
    assert f", {n}), REPARTITION_BY_NUM" in "".join(x for x in plan(QUERIES[name](spark, FOLDER)).splitlines() if "hashpartitioning(player" in x)


def test_cells_of_box_pages_are_dealt_out_and_sorted_once_by_game(spark, small_tasks):
    n = registry.line_parts(lambda of: table(spark, FOLDER, of))
    later = plan(QUERIES["box_page_lines"](spark, FOLDER)).split("BatchEvalPythonUDTF")[0].splitlines()
    assert [f", {n}), REPARTITION_BY_NUM" in x for x in later if "Exchange" in x] == [True]
    assert sum("+- Sort [" in x for x in later) == 1


def test_bpm_like_deals_rosters_out_by_team_with_the_same_rows(spark, small_tasks):
    n = registry.line_parts(lambda of: table(spark, FOLDER, of))
    got = QUERIES["bpm_like"](spark, FOLDER)
    assert f", {n}), REPARTITION_BY_NUM" in "".join(x for x in plan(got).splitlines() if "hashpartitioning(season" in x)
    registry.ROWS_A_TASK = 10**9
    whole = QUERIES["bpm_like"](spark, FOLDER)
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()


def test_steps_of_bpm_like_are_short_enough_for_the_jvm_to_compile(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        steps = QUERIES["bpm_like"](spark, FOLDER)._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(steps.apply(k)._3().maxMethodCodeSize() for k in range(steps.size())) < 8000
