"""Seasons to the archive and back, cut off after each thing that is done."""

import pytest

from fieldglass.sources import lake
from fieldglass.sources.archive import Archive

SCHEMA = "game long, season string, value double"
ROWS = [(k, ("2021", "2022", "2023", None)[k % 4], k / 2) for k in range(40)]


class Cut(Exception):
    pass


def cut_after(n):
    left = [n]

    def after(what):
        left[0] -= 1
        if not left[0]:
            raise Cut(what)

    return after


@pytest.fixture
def at(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{tmp_path}/hot")
    return lambda after=lambda what: None: Archive(spark, f"{tmp_path}/hot", f"{tmp_path}/cold", "season", after)


def rows(df):
    return sorted(map(tuple, df.select("game", "season", "value").collect()), key=repr)


def seasons(df):
    return {r["season"] for r in df.select("season").distinct().collect()}


ALL = sorted(ROWS, key=repr)


@pytest.mark.parametrize("n", range(1, 9))
def test_no_row_is_lost_or_twice_wherever_archiving_ends(at, n):
    try:
        at(cut_after(n)).archive(["2021", "2022"])
        assert n > 7
    except Cut:
        pass
    assert rows(at().both()) == ALL  # as it was left
    done = at().resume()
    assert rows(at().both()) == ALL and at().noted() is None
    if done == "undone":
        assert n <= 2 and seasons(at().cold_rows()) == set()
        at().archive(["2021", "2022"])
    assert seasons(at().hot_rows()) == {"2023", None} and seasons(at().cold_rows()) == {"2021", "2022"} and rows(at().both()) == ALL


@pytest.mark.parametrize("n", range(1, 8))
def test_no_row_is_lost_or_twice_wherever_restoring_ends(at, n):
    at().archive(["2021", "2022"])
    try:
        at(cut_after(n)).restore(["2021", "2022"])
        assert n > 6
    except Cut:
        pass
    assert rows(at().both()) == ALL
    at().resume()
    assert at().noted() is None and seasons(at().cold_rows()) == set() and rows(at().hot_rows()) == ALL


def test_work_under_way_isn_t_begun_again(at):
    with pytest.raises(Cut):
        at(cut_after(3)).archive(["2021"])
    with pytest.raises(ValueError, match="resume"):
        at().archive(["2022"])
    assert at().resume() == "archived" and at().resume() is None
    with pytest.raises(ValueError, match="hot table has rows"):
        at().restore(["2022"])
    at().restore(["2021"])
    assert rows(at().hot_rows()) == ALL


def test_a_season_that_is_archived_again_is_replaced(spark, at):
    at().archive(["2021"])
    lake.swapped(at().hot_rows().unionByName(spark.createDataFrame([(99, "2021", 1.0)], SCHEMA)), at().hot)
    at().archive(["2021", "1999"])
    assert rows(at().cold_rows()) == [(99, "2021", 1.0)]
