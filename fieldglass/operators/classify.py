"""Ordered text classifiers: transactions, moves, injury reasons; and links of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes in order, the first that matches wins; texts are lower-case.  "exhibit10" is written with a capital
# and so never matches, which later readers of these classes rely on.
TRANSACTIONS = (
    ("trade", r"\btraded\b|\bin a \d-team trade\b"),
    ("draft", r"\bdrafted\b|\bselected\b.*\bdraft\b"),
    ("claim", r"\bclaimed\b"),
    ("waive", r"\bwaived\b|\breleased\b"),
    ("extension", r"\bcontract extension\b|\bextension\b"),
    ("two_way", r"\btwo-way\b"),
    ("exhibit10", r"\bExhibit 10\b"),
    ("option", r"\boption\b"),
    ("sign", r"\bsigned\b|\bre-signed\b"),
    ("convert", r"\bconverted\b"),
    ("assign", r"\bassigned\b|\brecalled\b"),
    ("retire", r"\bretired\b"),
    ("suspend", r"\bsuspended\b"),
    ("hire", r"\bhired\b|\bnamed\b.*\bcoach\b"),
    ("fire", r"\bfired\b|\brelieved\b"),
)
REASONS = (
    ("injury", r"^injury/illness|^concussion"),
    ("reconditioning", r"return to competition|reconditioning"),
    ("two_way", r"^g league\s*-\s*two-way"),
    ("assignment", r"^g league\s*-\s*on assignment"),
    ("g_league", r"^g league"),
    ("coach", r"coach'?s decision"),
    ("rest", r"^rest"),
    ("personal", r"^personal"),
    ("suspension", r"suspension"),
    ("not_with_team", r"not with team"),
    ("protocols", r"health and safety|protocols"),
    ("not_submitted", r"not yet submitted"),
    ("trade", r"trade pending|^trade"),
)
# A body part and its region.
PARTS = (
    ("great toe", "foot"), ("big toe", "foot"), ("plantar fascia", "foot"), ("plantar", "foot"), ("metatarsal", "foot"),
    ("navicular", "foot"), ("cuneiform", "foot"), ("toe", "foot"), ("heel", "foot"), ("foot", "foot"),
    ("high ankle", "ankle"), ("ankle", "ankle"),
    ("achilles", "lower leg"), ("soleus", "lower leg"), ("plantaris", "lower leg"), ("tibialis", "lower leg"),
    ("calf", "lower leg"), ("shin", "lower leg"), ("tibia", "lower leg"), ("fibula", "lower leg"),
    ("lower leg", "lower leg"), ("leg", "lower leg"),
    ("acl", "knee"), ("mcl", "knee"), ("pcl", "knee"), ("lcl", "knee"), ("meniscus", "knee"), ("patellar", "knee"),
    ("patella", "knee"), ("knee", "knee"),
    ("hamstring", "thigh"), ("quadriceps", "thigh"), ("quad", "thigh"), ("thigh", "thigh"),
    ("adductor", "groin/hip"), ("groin", "groin/hip"), ("hip flexor", "groin/hip"), ("hip", "groin/hip"),
    ("pelvis", "groin/hip"), ("pelvic", "groin/hip"), ("glute", "groin/hip"),
    ("low back", "back"), ("lower back", "back"), ("lumbar", "back"), ("back", "back"), ("disc", "back"),
    ("spine", "back"), ("sciatica", "back"), ("sacral", "back"), ("tailbone", "back"),
    ("neck", "neck"), ("cervical", "neck"),
    ("rotator cuff", "shoulder"), ("ac joint", "shoulder"), ("ac", "shoulder"), ("labrum", "shoulder"),
    ("shoulder", "shoulder"), ("clavicle", "shoulder"),
    ("elbow", "arm"), ("forearm", "arm"), ("bicep", "arm"), ("tricep", "arm"), ("arm", "arm"),
    ("wrist", "hand"), ("thumb", "hand"), ("finger", "hand"), ("metacarpal", "hand"), ("hand", "hand"),
    ("concussion", "head"), ("migraine", "head"), ("head", "head"), ("face", "head"), ("facial", "head"), ("eye", "head"),
    ("orbital", "head"), ("nasal", "head"), ("nose", "head"), ("jaw", "head"), ("tooth", "head"), ("mouth", "head"),
    ("ear", "head"),
    ("oblique", "core"), ("abdominal", "core"), ("abdomen", "core"), ("rib", "core"), ("chest", "core"), ("core", "core"),
    ("sternum", "core"),
    ("illness", "illness"), ("non-covid", "illness"), ("covid", "illness"), ("flu", "illness"), ("virus", "illness"),
    ("respiratory", "illness"), ("gastro", "illness"),
)
# A word's beginning and the injury it tells; the first that a text has wins.
INJURIES = (
    ("surgery", "surgery"), ("repair", "surgery"), ("procedure", "surgery"), ("reconstruction", "surgery"),
    ("arthroscopy", "surgery"), ("meniscectomy", "surgery"),
    ("herniation", "herniation"),
    ("rupture", "tear"), ("tear", "tear"), ("torn", "tear"),
    ("fracture", "fracture"), ("break", "fracture"),
    ("stress reaction", "stress reaction"),
    ("dislocation", "dislocation"), ("dislocated", "dislocation"), ("displacement", "dislocation"),
    ("subluxation", "dislocation"),
    ("cartilage", "cartilage"),
    ("sprain", "sprain"), ("hyperextension", "sprain"),
    ("strain", "strain"), ("strained", "strain"),
    ("contusion", "contusion"), ("bruise", "contusion"),
    ("tendinitis", "tendinopathy"), ("tendinopathy", "tendinopathy"), ("tendinosis", "tendinopathy"),
    ("tendonitis", "tendinopathy"),
    ("bursitis", "inflammation"), ("fasciitis", "inflammation"), ("inflammation", "inflammation"),
    ("impingement", "impingement"),
    ("spasm", "spasms"),
    ("soreness", "soreness"), ("sore", "soreness"),
    ("tightness", "tightness"),
    ("irritation", "soreness"), ("discomfort", "soreness"),
    ("concussion", "concussion"),
    ("illness", "illness"), ("infection", "illness"),
    ("injury management", "management"), ("load management", "management"), ("management", "management"),
    ("rest", "management"),
    ("injury recovery", "recovery"), ("recovery", "recovery"), ("rehab", "recovery"),
    ("return to competition", "recovery"), ("reconditioning", "recovery"),
)
MOVES = {"Waive": "waive", "AwardOnWaivers": "claim", "Trade": "trade"}


def first_class(text: Column, classes: tuple[tuple[str, str], ...], other: str | None = "other") -> Column:
    """The first class whose pattern the text has."""
    out = F.when(text.rlike(classes[0][1]), classes[0][0])
    for name, pattern in classes[1:]:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise(F.lit(other))


def transaction_class(text: Column) -> Column:
    return first_class(F.lower(text), TRANSACTIONS)


def move_kind(kind: Column, text: Column) -> Column:
    low = F.lower(text)
    out = F.when(kind == "Signing", F.when(low.contains("two-way"), "twoway_sign").otherwise("sign"))
    out = out.when(kind == "ContractConverted", F.when(low.contains("to a two-way"), "convert_to_twoway").otherwise("convert_to_standard"))
    for name, to in MOVES.items():
        out = out.when(kind == name, to)
    return out.otherwise(F.lower(F.coalesce(kind, F.lit("other"))))


def earliest_word(text: Column, words: list[str]) -> Column:
    """The word of the list that the text has first as a whole word, of two at one place the longer; null without one."""
    found = [F.struct(F.regexp_instr(text, F.lit(rf"\b{w}\b")).alias("at"), F.lit(-len(w)).alias("short"), F.lit(w).alias("word")) for w in words]
    return F.array_min(F.filter(F.array(*found), lambda x: x["at"] > 0))["word"]


def injury_reason(df: DataFrame, text: str) -> DataFrame:
    """df with category, side, part, region and injury, read off the text; null where it doesn't say."""
    low = F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.lower(F.col(text)), r"\s+", " ")), "^-+|-+$", ""))
    region = F.create_map(*(F.lit(v) for pair in PARTS for v in pair))
    d = df.withColumn("_low", low).withColumn("category", F.when(F.coalesce(F.col("_low"), F.lit("")) != "", first_class(F.col("_low"), REASONS)))
    hurt = F.col("category") == "injury"
    d = d.withColumn("_body", F.when(hurt, F.regexp_replace("_low", r"^injury/illness\s*-?\s*", "")))
    d = d.withColumn("side", F.nullif(F.regexp_extract("_body", r"\b(left|right|bilateral)\b", 1), F.lit("")))
    d = d.withColumn("part", F.when(hurt, earliest_word(F.col("_body"), [w for w, _ in PARTS]))).withColumn("region", region[F.col("part")])
    kind = F.when(hurt, first_class(F.col("_body"), tuple((kind, rf"\b{word}") for word, kind in INJURIES), None))
    return d.withColumn("injury", F.coalesce(kind, F.when(F.col("region") == "illness", "illness"))).drop("_low", "_body")


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, position, href) of every link."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]*)"'), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("position", "href"))
