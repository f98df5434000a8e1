"""Tables of web pages as rows: every cell by its place in the grid, by a table function joined laterally to the pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = "table_no int, table_id string, row_no int, col_no int, part string, row_class string, header boolean, first boolean, text string, attributes map<string,string>"
#: A page's span is believed up to here, as by browsers.
MOST_SPAN = 1000
_COMMENT = re.compile(r"<!--(.*?)-->", re.S)


def uncommented(html: str) -> str:
    """A page with the comments that hold tables opened: some sites keep tables there until a script shows them."""
    return _COMMENT.sub(lambda m: m[1] if "<table" in m[1].lower() else "", html)


class _Table:
    def __init__(self, number: int, table_id: str | None) -> None:
        self.number, self.table_id, self.rows = number, table_id, []
        self.part, self.cell = "body", None


def _span(attributes: dict, name: str) -> int:
    digits = re.match(r"\s*(\d+)", attributes.get(name) or "")
    return min(max(int(digits[1]), 1), MOST_SPAN) if digits else 1


class _Tables(HTMLParser):
    """The tables of a page in the order in which they begin; a table within a cell is a table of its own, whose text also
    counts as the cell's."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.open: list[_Table] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "table":
            table = _Table(len(self.tables), a.get("id"))
            self.tables.append(table)
            self.open.append(table)
            return
        if not self.open:
            return
        table = self.open[-1]
        if tag in ("thead", "tbody", "tfoot"):
            table.part, table.cell = tag[1:], None
        elif tag == "tr":
            table.rows.append((table.part, a.get("class"), []))
            table.cell = None
        elif tag in ("td", "th"):
            if not table.rows:
                table.rows.append((table.part, None, []))
            table.cell = {"header": tag == "th", "attributes": {k: v or "" for k, v in a.items()}, "text": []}
            table.rows[-1][2].append(table.cell)
        elif table.cell is not None:
            # The first link of a cell is as good as an attribute of it.
            if tag == "a" and "href" in a:
                table.cell["attributes"].setdefault("href", a["href"] or "")
            if tag in ("br", "p", "div", "li"):
                self.handle_data(" ")

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        if tag == "table":
            self.open.pop()
        elif tag in ("td", "th", "tr"):
            self.open[-1].cell = None
        elif tag in ("thead", "tbody", "tfoot"):
            self.open[-1].part, self.open[-1].cell = "body", None

    def handle_data(self, data: str) -> None:
        for table in self.open:
            if table.cell is not None:
                table.cell["text"].append(data)


def grid(html: str | None) -> Iterator[tuple]:
    """``CELL`` rows: a cell has a row for each place it covers, the first of which is its own.  Spans that reach below the
    last row end there; a place that is taken moves the next cell on."""
    parser = _Tables()
    parser.feed(uncommented(html or ""))
    parser.close()
    for table in parser.tables:
        taken: dict[int, tuple[int, tuple]] = {}  # by column: rows that the cell still covers, and what it says
        for r, (part, row_class, cells) in enumerate(table.rows):
            out, column = {}, 0
            for c, (left, said) in list(taken.items()):
                out[c] = (False, *said)
                if left == 1:
                    del taken[c]
                else:
                    taken[c] = left - 1, said
            for cell in cells:
                while column in out:
                    column += 1
                a = cell["attributes"]
                said = cell["header"], " ".join("".join(cell["text"]).split()), a
                down = _span(a, "rowspan")
                for k in range(_span(a, "colspan")):
                    if column + k in out:
                        break
                    out[column + k] = (k == 0, *said)
                    if down > 1:
                        taken[column + k] = down - 1, said
            for c in sorted(out):
                first, header, text, a = out[c]
                yield table.number, table.table_id, r, c, part, row_class, header, first, text, a


@F.udtf(returnType=CELL)
class PageCells:
    """The cells of a page's tables; see ``grid``."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from grid(html)


def cells(pages: DataFrame, key: list[str], html: str) -> DataFrame:
    """key with ``CELL`` for every place of every table of the pages; pages without tables have no rows."""
    own = pages.select(*key, F.col(html).alias("_html"))
    return own.lateralJoin(PageCells(F.col("_html").outer())).drop("_html")


def _stat(name: str) -> Column:
    return F.col("attributes")[F.lit("data-stat")] == name


def _seconds(x: Column) -> Column:
    """Of MM:SS or of whole minutes."""
    minutes, seconds = (F.nullif(F.regexp_extract(x, r"^(\d+)(?::(\d{1,2}))?$", k), F.lit("")).cast("int") for k in (1, 2))
    return minutes * 60 + F.coalesce(seconds, F.lit(0))


# Marks of the pages' tables, and the columns of a box by their marks.
BOX_TABLE = r"^box-([A-Z]{3})-game-basic$"
BOX_STATS = {"fg": "fgm", "fga": "fga", "fg3": "fg3m", "fg3a": "fg3a", "ft": "ftm", "fta": "fta", "orb": "orb", "drb": "drb", "trb": "trb", "ast": "ast", "stl": "stl", "blk": "blk", "tov": "tov", "pf": "pf", "pts": "pts", "plus_minus": "plus_minus"}


def box_lines(page_cells: DataFrame, key: list[str], home: str) -> DataFrame:
    """Lines of the players of box pages: key, team, opponent, is_home, player, name, started, played, dnp_reason,
    seconds_played and ``BOX_STATS``; from ``cells`` of pages whose column home names the home team.

    The first five who played above the line that parts a table are its starters."""
    box = page_cells.withColumn("team", F.regexp_extract("table_id", BOX_TABLE, 1)).where("team <> '' AND first AND part = 'body'")
    of_row = [*key, "team", "row_no", home]  # in the windows' order: cells that come dealt out by key are sorted once
    value = lambda test, x: F.max(F.when(test, x))
    a = F.col("attributes")
    player = _stat("player") & F.col("header")
    rows = box.groupBy(*of_row).agg(
        F.bool_or(F.coalesce(F.array_contains(F.split("row_class", r"\s+"), "thead"), F.lit(False))).alias("line"),
        value(player, F.nullif(a[F.lit("data-append-csv")], F.lit(""))).alias("player"), value(player, F.col("text")).alias("name"),
        F.bool_or(F.coalesce(_stat("reason"), F.lit(False))).alias("out"), value(_stat("reason"), F.nullif("text", F.lit(""))).alias("reason"),
        value(_stat("mp"), F.col("text")).alias("mp"), *(value(_stat(s), F.col("text")).alias(f"_{c}") for s, c in BOX_STATS.items()),
    )
    from pyspark.sql.window import Window

    w = Window.partitionBy(*key, "team").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    played = F.col("player").isNotNull() & ~F.col("line") & ~F.col("out")
    told = rows.withColumns({"parted": F.max("line").over(w), "nth": F.count_if(played).over(w)})
    other = Window.partitionBy(*key)
    told = told.withColumn("teams", F.array_sort(F.collect_set("team").over(other)))
    opponent = F.get(F.filter("teams", lambda t: t != F.col("team")), 0)
    number = lambda c: F.regexp_replace(c, r"^\+", "").try_cast("int")
    return told.where("player IS NOT NULL AND NOT line").select(
        *key, "team", opponent.alias("opponent"), (F.col("team") == F.col(home)).alias("is_home"), "player", "name", (~F.col("out") & ~F.col("parted") & (F.col("nth") <= 5)).alias("started"), (~F.col("out")).alias("played"),
        F.when(F.col("out"), F.coalesce("reason", F.lit("DNP"))).alias("dnp_reason"), F.when(~F.col("out"), _seconds(F.col("mp"))).alias("seconds_played"), *(F.when(~F.col("out"), number(F.col(f"_{c}"))).alias(c) for c in BOX_STATS.values()),
    )


def roster_lines(page_cells: DataFrame, key: list[str]) -> DataFrame:
    """Players of the roster tables: key, player (from the link), name, jersey, position, height_in, weight_lb, birthdate,
    years, school, two_way; from ``cells``."""
    own = page_cells.where("table_id = 'roster' AND first AND part = 'body'")
    text = lambda s: F.max(F.when(_stat(s), F.nullif("text", F.lit(""))))
    mark = lambda s, a: F.max(F.when(_stat(s), F.col("attributes")[F.lit(a)]))
    rows = own.groupBy(*key, "row_no").agg(
        F.regexp_extract(mark("player", "href"), r"/players/\w/(\w+)\.html", 1).alias("player"), text("player").alias("shown"), text("number").alias("jersey"), text("pos").alias("position"), text("height").alias("height"), text("weight").alias("weight"),
        mark("birth_date", "csk").alias("csk"), text("years_experience").alias("years"), text("college").alias("school"), F.bool_or(F.contains("text", F.lit("(TW)"))).alias("two_way"),
    )
    from fieldglass.functions.text import height_inches

    return rows.where("player <> ''").select(
        *key, "player", F.trim(F.regexp_replace("shown", r"\(TW\)", "")).alias("name"), "jersey", "position", height_inches(F.col("height")).alias("height_in"), F.when(F.col("weight").rlike(r"^\d+$"), F.col("weight").try_cast("int")).alias("weight_lb"),
        F.try_to_date(F.substring("csk", 1, 8), "yyyyMMdd").alias("birthdate"), "years", "school", "two_way",
    )
