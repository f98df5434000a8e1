import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from fieldglass.llm import warc as A

SCHEMA = "page_id long, url string, html string"
ROWS = [(5, "http://a", "same"), (2, "http://b", "same"), (9, None, "same"), (1, "u", ""), (3, "u", None), (4, "x y", "é" * 90000), (None, "n", "same"), (None, "n", "alone"), (7, "z", "dup"), (7, "z", "dup")]


def expected(rows, least=0):
    for key, _, html in rows:
        raw = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        first = min(same) if same and len(raw) >= least else key
        revisit = first != key
        yield key, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None


@pytest.mark.parametrize("least", [0, 5])
def test_archives_give_back_the_pages(spark, least):
    got = A.read(A.write(spark.createDataFrame(ROWS, SCHEMA), least)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected(ROWS, least)))


def test_members_are_single_records_and_damage_is_found():
    one, two = A.record(1, "http://a", b"x" * 200000, None), A.record(2, "http://a", b"x" * 200000, 1)
    assert [A.parse(m)[0]["warc-type"] for m in A.members(io.BytesIO(one + two))] == ["response", "revisit"]
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\n")
    with pytest.raises(ValueError):
        A.parse(gzip.decompress(one).replace(b"xxx", b"xyx", 1))
    with pytest.raises(ValueError):
        list(A.members(io.BytesIO(one[:-20])))


def test_every_cut_is_found():
    one, two = A.record(1, "http://a", b"first" * 10, None), A.record(2, "http://a", b"second" * 300, None)
    for cut in range(1, len(two)):
        with pytest.raises(ValueError):
            list(A.members(io.BytesIO(one + two[:-cut])))
    assert len(list(A.members(io.BytesIO(one)))) == 1 and list(A.members(io.BytesIO(b""))) == []


def test_a_lost_record_is_found(spark):
    files = A.write(spark.createDataFrame(ROWS[:3], SCHEMA).withColumn("records", F.lit("clash")))
    assert A.read(files).count() == 3
    with pytest.raises(Exception, match="records instead of"):
        A.read(files.withColumn("records", F.col("records") + 1)).collect()


def test_empty_table(spark):
    assert A.read(A.write(spark.createDataFrame([], SCHEMA))).count() == 0
