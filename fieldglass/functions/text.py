"""Units, clocks, names and similarity.

The four name normalisers differ on purpose and are not to be merged: what one source keeps, another drops."""

from __future__ import annotations

import difflib
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Letters that have no decomposition, and name suffixes with their ranks.
PLAIN = {"Đ": "D", "đ": "d", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "ı": "i", "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th"}
SUFFIX_RANK = {"sr": 1, "jr": 2, "ii": 2, "iii": 3, "iv": 4, "v": 5}
_SUFFIX = r"\s+(jr|sr|ii|iii|iv|v)\.?$"


def iso_clock_seconds(x: Column) -> Column:
    """Seconds of PT11M35.00S; null if it isn't one."""
    minutes, seconds = (F.regexp_extract(x, r"^PT(\d+)M(\d+(?:\.\d+)?)S$", k) for k in (1, 2))
    return F.when(minutes != "", minutes.cast("double") * 60 + F.nullif(seconds, F.lit("")).cast("double"))


def clock_seconds(x: Column) -> Column:
    """Seconds of MM:SS; null if it isn't one."""
    minutes, seconds = (F.regexp_extract(x, r"^(\d+):(\d{1,2})$", k) for k in (1, 2))
    return F.when(minutes != "", F.nullif(minutes, F.lit("")).cast("bigint") * 60 + F.nullif(seconds, F.lit("")).cast("bigint"))


def height_inches(x: Column) -> Column:
    """Inches of 6-8; null if it isn't one."""
    feet, inches = (F.nullif(F.regexp_extract(x, r"^\s*(\d+)-(\d+)\s*$", k), F.lit("")).cast("bigint") for k in (1, 2))
    return feet * 12 + inches


def elapsed_seconds(period: Column, left: Column) -> Column:
    """Seconds of the game gone, with left to go in a period of 12 minutes, of 5 from the fifth on."""
    return F.when(period <= 4, period * 720 - left).otherwise(2880 + (period - 4) * 300 - left)


def repair_mojibake(x: Column) -> Column:
    """UTF-8 that was read as Latin-1, read right; anything else as it is."""
    raw = F.encode(x, "ISO-8859-1")
    back = F.try_validate_utf8(raw.cast("string"))
    narrow = ~x.rlike("[^\\x00-\\xff]")
    return F.when(narrow & back.isNotNull(), back).otherwise(x)


def letters_only(x: Column, fold) -> Column:
    """Lower-case letters a-z alone, accents folded by fold."""
    return F.regexp_replace(F.lower(fold(x)), "[^a-z]", "")


def without_suffix(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(x)), _SUFFIX, "")


def suffix_rank(x: Column) -> Column:
    """1 for sr, 2 for jr and ii, then 3, 4, 5; null without one."""
    of = F.regexp_extract(F.lower(F.trim(x)), _SUFFIX, 1)
    return F.create_map(*(F.lit(v) for pair in SUFFIX_RANK.items() for v in pair))[of]


def strip_accents(names: pd.Series) -> pd.Series:
    """Compatibility decomposition without marks, and PLAIN for letters that have none."""
    table = str.maketrans(PLAIN)
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x.translate(table)) if not unicodedata.combining(c))
    return names.map(plain, na_action="ignore")


@F.pandas_udf(StringType())
def fold_accents(names: pd.Series) -> pd.Series:
    return strip_accents(names)


def name_key(x: Column) -> Column:
    """Folded, lower-case, single spaces, punctuation but the hyphen gone, suffix kept, "Last, First" turned."""
    turned = F.regexp_replace(F.trim(x), r"^([^,]+),\s*(.+)$", "$2 $1")
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(fold_accents(turned)), r"[^a-z0-9\- ]", ""), r"\s+", " "))


def name_bare(x: Column) -> Column:
    """As name_key, with hyphens, points and apostrophes gone."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(fold_accents(x)), r"[.'\-]", ""), r"\s+", " "))


def name_base(x: Column) -> Column:
    """As name_key, with the suffix gone."""
    return F.regexp_replace(name_key(x), _SUFFIX, "")


@lru_cache(maxsize=1 << 16)
def _ratio(x: str, y: str) -> float:
    return difflib.SequenceMatcher(None, x, y).ratio()


@F.pandas_udf(DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of candidate pairs."""
    return pd.Series([None if x is None or y is None else _ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def token_jaccard(a: Column, b: Column) -> Column:
    x, y = (F.array_distinct(F.split(v, " ")) for v in (a, b))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
