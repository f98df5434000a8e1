"""Pages of moves: sentences that follow fixed forms, and entries whose teams, players and picks are marked."""

from __future__ import annotations

import html as H
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldglass.operators.classify import transaction_class

# Kinds of moves, their sentences with {P} for the player and {T} for teams, any of which may be missing, and
# what the teams are, in order.  The first form that begins a sentence wins.
SENTENCES = (
    ("rights_trade", "{P} was inactive and had his rights acquired by the {T} from the {T} in a trade", ("to", "from")),
    ("gl_trade", "{P} was acquired by the {T} from the {T} in a trade", ("to", "from")),
    ("return_from_callup", "{P} returned to the {T} after an NBA call up", ("to",)),
    ("returned", "{P} returned to the {T}", ("to",)),
    ("gl_waive", "The {T} placed the contract of {P} on waivers", ("from",)),
    ("twoway_sign", "{P} signed a two-way contract with the {T} and {T}", ("nba", "to")),
    ("allocate", "{P}, whose NBA Rights is held by the {T}, was allocated to the {T}", ("nba", "to")),
    ("allocate", "{P} was allocated to the {T} from the {T}", ("to", "nba")),
    ("allocate", "{P} was allocated to the {T}", ("to",)),
    ("deallocate", "{P} was deallocated from the {T}", ("from",)),
    ("tryout", "{P} tried out with the {T}", ("to",)),
    ("draft", "The {T} selected {P} in Round {N} with Pick {N} in the {N} {D} G League Draft", ("to",)),
    ("assign", "The {T} assigned {P} to the {T}", ("nba", "to")),
    ("recall", "The {T} recalled {P} from the {T}", ("nba", "from")),
    ("call_up", "The {T} called up {P} from the {T}", ("nba", "from")),
    ("twoway_end", "The {T} ended the two-way contract of {P}", ("nba",)),
    ("gl_terminate", "The G League terminated the contract of {P} from the {T}", ("from",)),
    ("pool_claim", "The {T} claimed {P} from the player pool", ("to",)),
    ("gl_claim", "The {T} made a successful waiver claim for the contract of {P}", ("to",)),
    ("deactivate", "The {T} deactivated {P}", ("from",)),
)
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
PLAYER = r'<a href="/player/[^"]*/(\d+)"[^>]*>(.*?)</a>'


def sentence_pattern(sentence: str) -> str:
    """The sentence as a pattern: a group for each team slot, which takes its spaces along when it is empty."""
    slots = re.sub(r" \{T\} ?", lambda _: r"(?: (\{T\}))? ?", sentence.replace("{P}", r"\{P\}"))
    return "^" + slots.replace("{N}", r"(\d+)").replace("{D}", "(Annual|International)")


def _reading(form: Column, teams: Column) -> Column:
    """kind, from_team, to_team, nba_team and detail of a sentence whose links are {P} and {T}."""
    blank = {x: F.lit(None).cast("string") for x in ("from_team", "to_team", "nba_team", "detail")}
    fields = lambda kind, of: F.struct(F.lit(kind).alias("kind"), *((of.get(x, blank[x])).alias(x) for x in blank))
    out = None
    for kind, sentence, roles in SENTENCES:
        pattern = sentence_pattern(sentence)
        group = lambda k, p=pattern: F.regexp_extract(form, p, k)
        of, at = {}, F.lit(0)
        for k, role in enumerate(roles, 1):
            named = group(k) != ""
            of[f"{role}_team"] = F.when(named, F.get(teams, at))
            at = at + named.cast("int")
        if kind == "draft":
            of["detail"] = F.format_string("%s draft %s, round %s, pick %s", group(5), group(4), group(2), group(3))
        out = (F if out is None else out).when(form.rlike(pattern), fields(kind, of))
    return out.otherwise(fields("other", {}))


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescaped(texts: pd.Series) -> pd.Series:
    """Character references of HTML read in every text of an array."""
    return texts.map(lambda xs: [None if x is None else H.unescape(x) for x in xs], na_action="ignore")


def _untagged(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def _one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def _day(year: Column, month: Column, day: Column, months: list[str]) -> Column:
    """The date; null when there is no such month or day."""
    number = F.array_position(F.array(*(F.lit(m) for m in months)), month).cast("int")
    number_of = lambda c: F.nullif(c, F.lit("")).cast("int")
    return F.try_make_timestamp(number_of(year), number, number_of(day), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)")).cast("date")


def sentence_moves(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, txn_date, block_no, line_no, kind, name, player_id, from_team, to_team, nba_team, detail, raw_text) of pages with
    an h3 for each date and an li for each move.

    Sentences of no form are of kind other; lines without a link to a player and blocks without a date are left out."""
    blocks = pages.select(key, F.posexplode(F.split(F.col(html), "(?i)<h3[^>]*>")).alias("block_no", "_block")).where("block_no > 0")
    dated = lambda k: F.regexp_extract("_block", r"^\s*([A-Z][a-z]{2}) (\d{1,2}), (\d{4})", k)
    day = _day(dated(3), dated(1), dated(2), [m[:3] for m in MONTHS])
    body = F.split("_block", "(?i)<h[123][^>]*>")[0]
    lines = blocks.select(key, "block_no", day.alias("txn_date"), F.posexplode(F.regexp_extract_all(body, F.lit("(?is)<li>(.*?)</li>"), F.lit(1))).alias("line_no", "_li"))
    lines = lines.where(F.col("txn_date").isNotNull() & F.col("_li").rlike(PLAYER))
    teams = F.regexp_extract_all("_li", F.lit(r"""(?is)<a href=['"](?!/player/)[^'"]*['"][^>]*>(.*?)</a>"""), F.lit(1))
    form = F.regexp_replace(F.regexp_replace("_li", '(?is)<a href="/player/[^"]*"[^>]*>.*?</a>', "{P}"), "(?is)<a [^>]*>.*?</a>", "{T}")
    texts = F.concat(F.array(F.regexp_extract("_li", PLAYER, 2), _untagged(form), _untagged(F.col("_li"))), F.transform(teams, _untagged))
    read = lines.select("*", F.regexp_extract("_li", PLAYER, 1).alias("player_id"), unescaped(texts).alias("_t"))
    ends = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    own = F.transform(F.slice("_t", 4, F.greatest(F.size("_t") - 3, F.lit(0))), ends)
    plain = read.select("*", ends(F.col("_t")[0]).alias("name"), _one_line(F.col("_t")[1]).alias("_form"), _one_line(F.col("_t")[2]).alias("raw_text"), own.alias("_teams"))
    return plain.select(key, "txn_date", "block_no", "line_no", _reading(F.col("_form"), F.col("_teams")).alias("_r"), "name", "player_id", "raw_text").select(
        key, "txn_date", "block_no", "line_no", "_r.kind", "name", "player_id", "_r.from_team", "_r.to_team", "_r.nba_team", "_r.detail", "raw_text"
    )


# What is marked in an entry: teams by direction, players, picks, and notes of what a pick became.
TEAM = r'data-attr-(from|to)="([A-Z]{3})"'
LINKED = r'<a href="/players/[a-z]/([a-z0-9]+)\.html">([^<]+)</a>'
PICK = r"(?i)(?:(\d{4})\s+)?(1st|2nd|first|second)[- ]round\s+(?:draft\s+)?pick"
NOTE = r"(?i)\([^)]*?\s+(?:was|were)\s+later\s+(?:selected|drafted)[^)]*\)"


def _either(*patterns: str) -> Column:
    """One pattern of several, without their groups, each with its own case rule."""
    return F.lit("|".join(re.sub(r"(?<!\\)\((?!\?)", "(?:", p if not p.startswith("(?i)") else f"(?i:{p[4:]})") for p in patterns))


def entries(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, transaction_id, txn_date, txn_type, raw_text, markup) of pages with an li for each date and a p for each entry.

    Numbers run by date within a page; an entry without text takes a number but has no row."""
    dated = r"(?s)<li>\s*<span>([A-Z][a-z]+) (\d{1,2}), (\d{4})</span>(.*?)</li>"
    blocks = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(dated), F.lit(0))).alias("_b", "_block"))
    part = lambda k: F.regexp_extract("_block", dated, k)
    each = F.posexplode(F.regexp_extract_all(part(4), F.lit("(?s)<p>(.*?)</p>"), F.lit(1))).alias("_p", "markup")
    rows = blocks.select(key, "_b", _day(part(3), part(1), part(2), list(MONTHS)).alias("txn_date"), each).where("txn_date IS NOT NULL")
    number = (F.row_number().over(Window.partitionBy(key, "txn_date").orderBy("_b", "_p")) - 1).cast("string")
    label = F.concat(F.lit("T"), F.date_format("txn_date", "yyyyMMdd"), F.lit("_"), F.lpad(number, F.greatest(F.length(number), F.lit(3)), F.lit("0")))
    text = _one_line(_untagged(F.col("markup")))
    return rows.select(key, label.alias("transaction_id"), "txn_date", transaction_class(text).alias("txn_type"), text.alias("raw_text"), "markup").where("raw_text <> ''")


def entry_items(entries_: DataFrame, key: str) -> DataFrame:
    """(key, transaction_id, item_no, item_type, player_id, raw_name, from_team, to_team, pick_year, pick_round, detail): players,
    picks and cash of each of ``entries``, and players that a pick became, which move nowhere.

    The marks of an entry are rows in order.  A mark's sender is the last one before it, else the first after; its receiver
    the first after, else the last before; behind the first "for" of a trade the two change places.  detail is the words of
    the pick or of the note itself."""
    mark = _either(TEAM, LINKED, PICK, r"(?i)\bcash\b", r"(?i)\bfor\b")
    alone = lambda m: F.array(F.struct(m.alias("mark"), F.lit(None).cast("string").alias("note")))
    inside = lambda m: F.transform(F.regexp_extract_all(m, mark, F.lit(0)), lambda x: F.struct(x.alias("mark"), m.alias("note")))
    found = F.regexp_extract_all(F.col("markup"), F.concat(_either(NOTE), F.lit("|"), mark), F.lit(0))
    marks = F.flatten(F.transform(found, lambda m: F.when(m.startswith("("), inside(m)).otherwise(alone(m))))
    rows = entries_.select(key, "transaction_id", "txn_type", F.posexplode(marks).alias("item_no", "_m")).select(key, "transaction_id", "txn_type", "item_no", "_m.*")
    team = lambda way: F.when(F.regexp_extract("mark", TEAM, 1) == way, F.regexp_extract("mark", TEAM, 2))
    word = F.lower("mark")
    kind = (
        F.when(F.col("mark").rlike(LINKED), F.when(F.col("note").isNotNull(), "pick_became").otherwise("player"))
        .when(F.col("mark").rlike(PICK), "pick").when(word == "cash", "cash")
    )
    entry = Window.partitionBy(key, "transaction_id")
    order = entry.orderBy("item_no")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    last = lambda way: F.last(team(way), True).over(before)
    first = lambda way: F.first(team(way), True).over(after)
    near = rows.select(
        "*", kind.alias("item_type"), F.coalesce(last("from"), first("from")).alias("_gives"), F.coalesce(first("to"), last("to")).alias("_gets"),
        F.min(F.when((word == "for") & (F.col("txn_type") == "trade"), F.col("item_no"))).over(entry).alias("_turn"),
        F.min(F.when(word == "cash", F.col("item_no"))).over(entry).alias("_cash"),
    )
    turned, moves = F.coalesce(F.col("item_no") > F.col("_turn"), F.lit(False)), F.col("item_type") != "pick_became"
    pick = lambda k: F.nullif(F.regexp_extract("mark", PICK, k), F.lit(""))
    said = F.when(F.col("item_type") == "cash", "cash considerations").when(F.col("item_type") == "pick", _one_line(F.col("mark"))).when(~moves, _one_line(_untagged(F.col("note"))))
    return near.where("item_type IS NOT NULL AND (item_type <> 'cash' OR item_no = _cash)").select(
        key, "transaction_id", "item_no", "item_type", F.nullif(F.regexp_extract("mark", LINKED, 1), F.lit("")).alias("player_id"), F.nullif(F.regexp_extract("mark", LINKED, 2), F.lit("")).alias("raw_name"),
        F.when(moves, F.when(turned, F.col("_gets")).otherwise(F.col("_gives"))).alias("from_team"), F.when(moves, F.when(turned, F.col("_gives")).otherwise(F.col("_gets"))).alias("to_team"),
        pick(1).cast("int").alias("pick_year"), F.when(F.lower(pick(2)).isin("1st", "first"), 1).when(pick(2).isNotNull(), 2).alias("pick_round"), said.alias("detail"),
    )
