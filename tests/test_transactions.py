"""Pages of moves: every sentence form, with and without its teams."""

import datetime

import pytest

from fieldglass.operators import transactions as X

P = '<a href="/player/A-B/Summary/{0}">N&eacute;mo {0}</a>'
T = '<a href="/team/{0}">{0} &amp; Co</a>'


def filled(sentence, teams):
    for name in teams:
        sentence = sentence.replace("{T}", T.format(name) if name else "", 1)
    for value in ("3", "14", "2023"):
        sentence = sentence.replace("{N}", value, 1)
    return sentence.replace("{D}", "Annual")


@pytest.mark.parametrize("missing", [None, 0, 1])
def test_every_form(spark, missing):
    lines, want = [], []
    for k, (kind, sentence, roles) in enumerate(X.SENTENCES):
        names = ["Ox" if n != missing else "" for n in range(len(roles))]
        names = [x and x + str(n) for n, x in enumerate(names)]
        lines.append(f"<li>{filled(sentence, names).replace('{P}', P.format(k))}</li>")
        got = {f"{r}_team": f"{x} & Co" for r, x in zip(roles, names) if x}
        want.append((k, kind, str(k), f"Némo {k}", got.get("from_team"), got.get("to_team"), got.get("nba_team"), "Annual draft 2023, round 3, pick 14" if kind == "draft" else None))
    page = "<h1>x</h1><li>" + P.format(77) + " lost</li><H3 class='d'> Jan 5, 2024</H3><ul>" + "\n".join(lines) + "</ul><h2>end</h2><li>" + P.format(99) + " lost</li><h3>Feb 31, 2024</h3><li>" + P.format(98) + " lost</li>"
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<h3>Mar 1, 2020</h3><li>no link</li><li>" + P.format(5) + " slept &nbsp; well</li>")], "page int, html string")
    rows = X.sentence_moves(df, "page", "html").orderBy("page", "line_no").collect()
    first = [tuple(r[c] for c in ("line_no", "kind", "player_id", "name", "from_team", "to_team", "nba_team", "detail")) for r in rows if r["page"] == 1]
    shorter = {"allocate", "return_from_callup"} if missing is not None else set()
    assert len(first) == len(want) and [a for a, b in zip(first, want) if b[1] not in shorter] == [b for b in want if b[1] not in shorter]
    assert all(r["txn_date"] == datetime.date(2024, 1, 5) for r in rows if r["page"] == 1)
    assert [(r["kind"], r["raw_text"], r["line_no"]) for r in rows if r["page"] == 4] == [("other", "Némo 5 slept well", 1)]


def marked(way, team):
    return f'<a data-attr-{way}="{team}" href="/teams/{team}/2025.html">{team.title()}</a>'


def linked(key):
    return f'<a href="/players/x/{key}.html">{key.upper()}</a>'


def test_entries_and_their_items(spark):
    swap = f"In a trade, {marked('from', 'AAA')} traded {linked('one')} and a 2027 1st round draft pick ({linked('later')} was later selected) to {marked('to', 'BBB')} for {linked('six')}, a second-round pick, cash and more cash."
    other = f"{marked('to', 'CCC')} signed {linked('ten')} for two years."
    gone = f"{marked('from', 'DDD')} waived {linked('ace')}."
    page = f"<ul><li> <span>October 7, 2024</span><p>{swap}</p><p> <b></b></p><p>{other}</p></li><li><span>Octember 8, 2024</span><p>{gone}</p></li><li><span>October 7, 2024</span><p>{gone}</p><p>No marks.</p></li></ul>"
    df = spark.createDataFrame([(1, page, 0), (2, None, 0), (3, "nothing", 0), (4, "", 0)], "page int, html string, item_no int")
    got = X.entries(df, "page", "html")
    kinds = {r["transaction_id"]: (r["txn_type"], r["txn_date"]) for r in got.collect()}
    day = datetime.date(2024, 10, 7)
    assert kinds == {"T20241007_000": ("trade", day), "T20241007_002": ("sign", day), "T20241007_003": ("waive", day), "T20241007_004": ("other", day)}
    rows = X.entry_items(got, "page").orderBy("transaction_id", "item_no").collect()
    names = ("transaction_id", "item_type", "player_id", "from_team", "to_team", "pick_year", "pick_round", "detail")
    assert [(r["transaction_id"][-1:], *(r[c] for c in names[1:])) for r in rows] == [
        ("0", "player", "one", "AAA", "BBB", None, None, None),
        ("0", "pick", None, "AAA", "BBB", 2027, 1, "2027 1st round draft pick"),
        ("0", "pick_became", "later", None, None, None, None, "(LATER was later selected)"),
        ("0", "player", "six", "BBB", "AAA", None, None, None),
        ("0", "pick", None, "BBB", "AAA", None, 2, "second-round pick"),
        ("0", "cash", None, "BBB", "AAA", None, None, "cash considerations"),
        ("2", "player", "ten", None, "CCC", None, None, None),
        ("3", "player", "ace", "DDD", None, None, None, None),
    ]
    assert X.entry_items(X.entries(df.limit(0), "page", "html"), "page").count() == 0
