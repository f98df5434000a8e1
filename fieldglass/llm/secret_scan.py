"""Secret scan: candidate credentials in texts, told apart by how many owners and repositories hold each of them.

One pass over the texts finds candidates with the position, kind and SHA-256 of each; only these rows, never the texts,
are shuffled.  Hashes are counted by distinct owners and repositories over the whole corpus: the pairs (hash, owner,
repository) are made distinct first, so a credential that a third of all rows hold reaches the second count as one row
for each owner and repository.  The counts go back by a join on the hash, which Spark splits where a hash is hot.

Classes of a candidate, by the counts: ``example`` (``WIDELY`` owners or more, or several owners and ``REPOSITORIES``
repositories or more: a widely copied sample), ``live`` (one owner, in however many repositories, and it looks random),
``unclear`` (the rest).  Kinds ``assign``, ``access`` and ``hex`` come from fixed patterns and
always stay.  The frequency adds the kind ``owned``: a random-looking token of ``OWNED_LENGTH`` characters or more in no
span of the others, kept only where its class is live.

Defined results: a null text is an empty one; no candidates give empty spans; a null owner or repository counts as an
owner of its own; repeated rows are scanned each, and count as one holder; matches of a kind don't overlap; texts of any
length are scanned whole; columns of any name pass through ``redact`` as they are.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldglass.llm._shared import IdMap, Tables, columns, free, map_batches, quoted, stored, texts

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "owned")
_ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12

OWNED_LENGTH = 20
_OWNED = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_DIGIT, _ALPHA = re.compile("[0-9]"), re.compile("[A-Za-z]")
#: Bits a character that a random token has at least, and words that mark a stand-in.
ENTROPY = 3.0
_STAND_IN = re.compile("(?i)example|sample|changeme|placeholder|dummy|your[-_]?(key|token|secret)|x{6}|1234567|abcdef")

WIDELY, REPOSITORIES = 3, 6

_SPAN = "kind int, start int, end int, vstart int, vend int, hash binary, random boolean"


def looks_random(token: str) -> bool:
    n = len(token)
    bits = -sum(k / n * math.log2(k / n) for k in Counter(token).values())
    return bits >= ENTROPY and bool(_DIGIT.search(token)) and not _STAND_IN.search(token)


def candidates(text: str) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, start of the value, its end) in code points; end exclusive."""
    out = [(0, m.start(), m.end(), m.start(1), m.end(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    out += [(1, m.start(), m.end(), m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [(2, m.start(), m.end(), m.start(), m.end()) for m in _HEX.finditer(text)]
    found, at, taken = sorted((s, e) for _, s, e, _, _ in out), 0, 0
    for m in _OWNED.finditer(text):
        token = m.group()
        # Of the spans that begin before this token ends, the last end: one pass over both in order.
        while at < len(found) and found[at][0] < m.end():
            taken = max(taken, found[at][1])
            at += 1
        if taken <= m.start() and _DIGIT.search(token) and _ALPHA.search(token) and looks_random(token):
            out.append((3, m.start(), m.end(), m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("vstart", pa.int32()), ("vend", pa.int32()), ("hash", pa.binary()), ("random", pa.bool_())])
    for batch in batches:
        found = []
        for text in texts(batch.column("text")):
            own = []
            for kind, start, end, vs, ve in candidates(text):
                value = text[vs:ve]
                own.append({"kind": kind, "start": start, "end": end, "vstart": vs, "vend": ve, "hash": hashlib.sha256(value.encode()).digest(), "random": looks_random(value)})
            found.append(own)
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(found, pa.list_(span))], [*rest, "spans"])


def scan(docs: DataFrame, key: list[str], owner: str = "source", repository: tuple[str, ...] = ("source", "lang"), store=stored) -> DataFrame:
    """A row for each of docs: its columns in key, and spans, an array of (start, kind, end, vstart, vend, class, owners,
    repositories) by start, then kind; kind is an index of KINDS.  Positions are code points.  store keeps the candidates."""
    by, repo, row = (free(docs, name) for name in ("_owner", "_repo", "_row"))
    # A null is told from every text, the empty one too.
    known = lambda c: F.coalesce(F.concat(F.lit("="), quoted(c).cast("string")), F.lit(""))
    given = docs.select(*columns(key), known(owner).alias(by), F.concat_ws("\0", *map(known, repository)).alias(repo), "text")
    schema = T.StructType([*given.drop("text").schema.fields, T.StructField("spans", T.ArrayType(T.StructType.fromDDL(_SPAN)))])
    found = store(map_batches(given, _find, schema).withColumn(row, F.monotonically_increasing_id()), "secret-candidates")
    each = found.where(F.size("spans") > 0).select(F.col(row).alias("_row"), F.col(by).alias("_owner"), F.col(repo).alias("_repo"), F.explode("spans").alias("s"))
    holders = each.select("s.hash", "_owner", "_repo").distinct()
    counts = holders.groupBy("hash").agg(F.count_distinct("_owner").alias("owners"), F.count_distinct("_repo").alias("repositories"))
    judged = each.select("_row", "s.*").join(counts, "hash").withColumn(
        "class", F.when((F.col("owners") >= WIDELY) | (F.col("owners") > 1) & (F.col("repositories") >= REPOSITORIES), "example").when((F.col("owners") == 1) & F.col("random"), "live").otherwise("unclear")
    ).where((F.col("kind") < len(KINDS) - 1) | (F.col("class") == "live"))
    spans = judged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "vstart", "vend", "class", "owners", "repositories"))).alias("spans"))
    spans = spans.withColumnRenamed("_row", row)
    return found.drop("spans").join(spans, row, "left").select(*columns(key), F.coalesce("spans", F.expr("cast(array() as " + spans.schema["spans"].dataType.simpleString() + ")")).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(scanned: DataFrame, key: list[str]) -> DataFrame:
    """Counts by kind, the digest of the spans of the fixed patterns, all spans, and counts by class."""
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS) - 1)
    count = lambda test: F.expr(f"cast(size(filter(spans, s -> s.{test})) as long)")
    return scanned.select(
        *columns(key),
        *(count(f"kind = {k}").alias(f"n_{name}") for k, name in enumerate(KINDS[:-1])),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        *(count(f"class = '{c}'").alias(f"n_{c}") for c in ("live", "example", "unclear")),
    )


def redact(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """docs with the value of every span that isn't a widely copied example replaced by mark in text, and n_chars, where
    there is one, set anew.  All rows stay, with their columns.

    Rows are known again by a hash of their doc_id and text.  Those without a span never travel: a map of fixed size holds
    the others' hashes, and only what it holds is joined to its spans."""
    key, cuts_, touched_ = (free(docs, name) for name in ("_key", "_cuts", "_touched"))
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    with Tables(docs.sparkSession) as own:
        found = scan(keyed, [key], store=lambda df, name: own.stored(df, name)).select(key, F.filter("spans", lambda s: s["class"] != "example").alias(cuts_)).where(F.size(cuts_) > 0)
        cuts = stored(found.dropDuplicates([key]), "secret-cuts")
    held = docs.sparkSession.sparkContext.broadcast(IdMap(cuts.select(key)))
    names = docs.columns

    @F.pandas_udf(T.BooleanType())
    def touched(keys: pd.Series) -> pd.Series:
        return pd.Series(held.value.may_hold(keys.to_numpy(np.int64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(cuts_).to_pylist(), strict=True):
                at, parts = 0, []
                for start, end in sorted((s["vstart"], s["vend"]) for s in spans or ()):
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]) if parts else text)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string())).select(names)

    marked = keyed.withColumn(touched_, touched(F.col(key)))
    # A merge join, so that marking and cutting are in different tasks: in one they would hold a Python process each.
    changed = map_batches(marked.where(touched_).join(cuts.hint("merge"), key, "left").select(*columns(names), cuts_), cut, docs.schema)
    if "n_chars" in names:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return marked.where(~F.col(touched_)).select(*columns(names)).unionByName(changed.select(*columns(names)))


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return summary(scan(docs, ["doc_id"]), ["doc_id"])
