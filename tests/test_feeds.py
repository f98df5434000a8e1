import json

from pyspark.sql import functions as F

from fieldglass.sources import feeds

PAYLOAD = "game string, home long, payload string"


def person(k, **more):
    return {"personId": k, "firstName": f"F{k}", "familyName": f"L{k}", "position": "", "comment": "", "statistics": {"minutes": "", "points": 0}} | more


def test_traditional_lines(spark):
    home = [person(1, position="G", statistics={"minutes": "31:05", "points": 7, "fieldGoalsMade": 3, "plusMinusPoints": -4.0}), person(2, comment=" DND - Back ", statistics={"minutes": None}), person(3, firstName="", familyName="Lone", statistics={"minutes": "", "reboundsTotal": 1})]
    away = [person("4", firstName=None, familyName=None, nameI="A. Four", statistics={"minutes": "2.5"}), {"personId": 5}]
    box = {"boxScoreTraditional": {"homeTeam": {"teamTricode": "AAA", "players": home}, "awayTeam": {"teamTricode": "BBB", "players": away}}}
    rows = [("g", 1, json.dumps(box)), ("bad", 1, "{not json"), ("none", 1, "{}"), ("null", 1, None), ("odd", 1, json.dumps({"boxScoreTraditional": {"homeTeam": {"players": "x"}}}))]
    got = {r["person"]: r for r in feeds.traditional_lines(spark.createDataFrame(rows, PAYLOAD), ["game"], "payload").collect()}
    assert set(got) == {"1", "2", "3", "4", "5"}
    assert [got["1"][c] for c in ("team", "opponent", "is_home", "name", "started", "played", "dnp_reason", "seconds_played", "fgm", "pts", "plus_minus", "fga")] == ["AAA", "BBB", True, "F1 L1", True, True, None, 1865, 3, 7, -4, None]
    assert [got["2"][c] for c in ("played", "dnp_reason", "seconds_played")] == [False, "DND - Back", None]
    assert (got["3"]["name"], got["3"]["played"], got["4"]["name"], got["4"]["seconds_played"], got["5"]["dnp_reason"], got["5"]["name"]) == ("Lone", True, "A. Four", 150, "Did Not Play", None)


def test_live_lines(spark):
    stats = {"minutes": "PT12M30.40S", "points": 4, "plusMinusPoints": 2.5}
    home = [{"personId": 1, "name": "A", "starter": "1", "played": "1", "status": "ACTIVE", "statistics": stats}, {"personId": 2, "name": "B", "starter": "1", "played": "0", "statistics": stats, "notPlayingDescription": "Ankle"}, {"personId": 3, "name": "C", "status": "inactive"}]
    df = spark.createDataFrame([("g", 1, json.dumps({"game": {"homeTeam": {"teamTricode": "AAA", "players": home}, "awayTeam": {"teamTricode": "BBB"}}}))], PAYLOAD)
    got = {r["person"]: r for r in feeds.live_lines(df, ["game"], "payload").collect()}
    assert set(got) == {"1", "2"}
    assert [got["1"][c] for c in ("started", "played", "seconds_played", "pts", "plus_minus")] == [True, True, 750, 4, 2]
    assert [got["2"][c] for c in ("started", "played", "dnp_reason", "seconds_played", "pts")] == [False, False, "Ankle", None, None]


def act(n, t, sub="", desc="", result=None, person=7, team=10, **more):
    return {"orderNumber": n, "actionNumber": n + 100, "actionType": t, "subType": sub, "descriptor": desc, "shotResult": result, "personId": person, "teamId": team, "period": 1} | more


def test_actions_in_the_older_feeds_words(spark):
    acts = [
        act(5, "3pt", "Jump Shot", "step back", ": Made", shotDistance=25.1, xLegacy=-3), act(1, "2pt", "layup", "", "Missed"), act(2, "2pt", "DUNK", "alley-oop", "made"), act(3, "freethrow", "1of2", "", "Made"), act(4, "freethrow", "technical", "", "Missed", person=8, team=20),
        act(6, "turnover", "out-of-bounds", "bad pass"), act(7, "turnover", "3-second-violation"), act(8, "turnover", "offensive-kicked-ball"), act(9, "turnover", ""), act(10, "turnover", "odd one"), act(11, "foul", "personal", "shooting"), act(12, "foul", "technical"),
        act(13, "period", "start", person=0, team=0), act(14, "jumpball", "recovered"), act(15, "game", "end"), act(0, "heave", "long", person=None, team=None), act(16, "turnover", "lane violation"),
    ]
    rows = [("g", 10, json.dumps({"game": {"actions": acts}})), ("x", 10, "[]")]
    got = {r["action_id"]: r for r in feeds.translated(spark.createDataFrame(rows, PAYLOAD), ["game"], "payload", "home").collect()}
    assert {k: (r["kind"], r["sub_kind"]) for k, r in got.items()} == {
        5: ("Made Shot", "Step Back Jump Shot"), 1: ("Missed Shot", "Layup Shot"), 2: ("Made Shot", "Alley-oop Dunk Shot"), 3: ("Free Throw", "Free Throw 1 of 2"), 4: ("Free Throw", "Free Throw Technical"),
        6: ("Turnover", "Out of Bounds - Bad Pass Turnover"), 7: ("Turnover", "3 Second Violation"), 8: ("Turnover", "Kicked Ball Violation"), 9: ("Turnover", "Unknown"), 10: ("Turnover", "Odd One"), 11: ("Foul", "Shooting"), 12: ("Foul", "Technical"),
        13: ("period", "start"), 14: ("Jump Ball", "Recovered"), 100: ("Heave", "Long"), 16: ("Turnover", "Lane Violation Turnover"),
    }
    assert {k: r["points_total"] for k, r in got.items() if r["points_total"]} == {2: 2, 3: 3, 5: 6}
    assert [got[5][c] for c in ("result", "value", "location", "distance", "x", "y", "is_field_goal", "action_number")] == ["Made", 3, "h", 25.1, -3.0, None, True, 105]
    assert (got[4]["location"], got[13]["location"], got[100]["person"], got[6]["result"]) == ("v", "", 0, "")
    assert feeds.translated(spark.createDataFrame([], PAYLOAD), ["game"], "payload", "home").select(F.count("*")).first()[0] == 0
