import datetime as dt

from fieldglass.sources import pages

PAGE = """<html><body><p>no table</p>
<table id="one"><caption>x</caption><thead><tr><th rowspan="2">Who</th><th colspan="2">Shots</th></tr><tr><th>in</th><th>out</th></tr></thead>
<tbody><tr class="odd thin"><th data-stat="player" data-append-csv="a01"><a href="/players/a/a01.html">Ann&nbsp;<b>Lee</b></a></th><td data-stat="fg">1<td>2</tr>
<tr><td rowspan=3 colspan="0">all</td><td>3</td><td>4<table id="in"><tr><td>deep</td></tr></table></td></tr>
<tr><td>5</td></tr></tbody></table>
<!-- a remark --><!-- <div><TABLE id="hidden"><tr><td>late &amp; found</td></tr></TABLE></div> --></body></html>"""


def test_the_grid_of_a_page():
    rows = list(pages.grid(PAGE))
    text = {(t, r, c): (x, first) for t, _, r, c, _, _, _, first, x, _ in rows}
    assert text == {
        (0, 0, 0): ("Who", True), (0, 0, 1): ("Shots", True), (0, 0, 2): ("Shots", False),
        (0, 1, 0): ("Who", False), (0, 1, 1): ("in", True), (0, 1, 2): ("out", True),
        (0, 2, 0): ("Ann Lee", True), (0, 2, 1): ("1", True), (0, 2, 2): ("2", True),
        (0, 3, 0): ("all", True), (0, 3, 1): ("3", True), (0, 3, 2): ("4deep", True),
        (0, 4, 0): ("all", False), (0, 4, 1): ("5", True),
        (1, 0, 0): ("deep", True), (2, 0, 0): ("late & found", True),
    }
    assert [(x[1], x[4], x[6]) for x in rows][0] == ("one", "head", True) and [x[1] for x in rows if x[0] == 2] == ["hidden"]
    who = next(x for x in rows if x[8] == "Ann Lee")
    assert who[5] == "odd thin" and who[9] == {"data-stat": "player", "data-append-csv": "a01", "href": "/players/a/a01.html"}


def test_pages_without_tables_and_broken_ones(spark):
    rows = [(1, None), (2, ""), (3, "<p>x"), (4, "<table><tr><td>a<tr><td colspan='x' rowspan='99999'>b"), (5, "</table></td><td>stray</td>"), (6, "<table></table>"), (7, "<table><td>alone")]
    got = pages.cells(spark.createDataFrame(rows, "id long, html string"), ["id"], "html").collect()
    assert sorted((r["id"], r["row_no"], r["col_no"], r["text"]) for r in got) == [(4, 0, 0, "a"), (4, 1, 0, "b"), (7, 0, 0, "alone")]
    assert pages.cells(spark.createDataFrame([], "id long, html string"), ["id"], "html").count() == 0


def line(player, *stats, reason=None):
    th = f'<tr><th data-stat="player" data-append-csv="{player}">{player.title()}</th>'
    return th + (f'<td data-stat="reason" colspan="19">{reason}</td></tr>' if reason is not None else "".join(f'<td data-stat="{k}">{v}</td>' for k, v in stats) + "</tr>")


def test_box_lines(spark):
    ann = line("ann", ("mp", "31:05"), ("fg", 4), ("pts", 11), ("plus_minus", "+7"))
    body = ann + "".join(line(f"p{k}", ("mp", "10:00"), ("pts", k)) for k in range(4)) + '<tr class="thead over"><th>Reserves</th></tr>' + line("bob", ("mp", "12"), ("pts", "")) + line("cy", reason="Did Not Dress") + line("di", reason="")
    away = "".join(line(f"q{k}", ("mp", "1:00"), ("pts", 2)) for k in range(7))
    page = f'<table id="box-AAA-game-basic"><thead><tr><th>h</th></tr></thead><tbody>{body}</tbody></table><!--<table id="box-BBB-game-basic"><tbody>{away}</tbody></table>--><table id="box-AAA-q1-basic"><tr><th data-stat="player" data-append-csv="zed">Z</th></tr></table>'
    df = spark.createDataFrame([("g", "BBB", page)], "game string, home string, html string")
    got = {r["player"]: r for r in pages.box_lines(pages.cells(df, ["game", "home"], "html"), ["game"], "home").collect()}
    assert len(got) == 15 and "zed" not in got
    a = got["ann"]
    assert (a["team"], a["opponent"], a["is_home"], a["name"], a["started"], a["seconds_played"], a["fgm"], a["pts"], a["plus_minus"], a["fga"]) == ("AAA", "BBB", False, "Ann", True, 1865, 4, 11, 7, None)
    assert {p for p, r in got.items() if r["started"]} == {"ann", "p0", "p1", "p2", "p3", "q0", "q1", "q2", "q3", "q4"}
    assert (got["bob"]["started"], got["bob"]["seconds_played"], got["bob"]["pts"]) == (False, 720, None)
    assert [(got[p]["played"], got[p]["dnp_reason"], got[p]["seconds_played"]) for p in ("cy", "di", "q0")] == [(False, "Did Not Dress", None), (False, "DNP", None), (True, None, 60)]


def test_roster_lines(spark):
    cell = lambda s, x, more="": f'<td data-stat="{s}"{more}>{x}</td>'
    row = f'<tr><th data-stat="number">7</th>{cell("player", "<a href=/players/l/leean01.html>Ann Lee</a> (TW)")}{cell("pos", "G")}{cell("height", "6-3")}{cell("weight", 190)}{cell("birth_date", "May 1", " csk=20000501")}{cell("years_experience", "R")}{cell("college", "")}</tr>'
    bad = f'<tr>{cell("player", "no link")}</tr><tr>{cell("player", "<a href=/players/b/bo01.html>Bo</a>")}{cell("birth_date", "?", " csk=20009901")}{cell("weight", "heavy")}</tr>'
    df = spark.createDataFrame([("AAA", f'<table id="roster"><tbody>{row}{bad}</tbody></table>')], "team string, html string")
    got = sorted(map(tuple, pages.roster_lines(pages.cells(df, ["team"], "html"), ["team"]).collect()))
    assert got == [("AAA", "bo01", "Bo", None, None, None, None, None, None, None, False), ("AAA", "leean01", "Ann Lee", "7", "G", 75, 190, dt.date(2000, 5, 1), "R", None, True)]
