"""Repair of conversations by Knuth's lightest derivation.

A repaired conversation has the roles ``(system? (user assistant)+)?``, told by their initials.  Repairing is deducing: an
item (k, state) says that the first k rows are dealt with and what may come next, an edit of row k is an axiom, and

    (k, state) , edit of row k   =>  (k + 1, next state)        keep, rerole, delete
    (k, state) , insertion       =>  (k, next state)
    (end, nothing open)          =>  goal

The weight of an item is (cost, audit), the audit being the initials of the edits so far; a deduction adds the cost of its
edit and appends its letter, so a conclusion is never lighter than its premise, nor does a lighter premise ever give a
heavier conclusion (of two audits of equal cost for one item neither is a prefix of the other, since insertions cost
something).  With such superior functions the agenda finalises items in the order in which it pops them, and stops when it
pops the goal.

Rows are shuffled by conversation once and solved as they stream by, a conversation at a time.  Conversations of more than
``LONG_ROWS`` rows or ``LONG_BYTES`` bytes go another way: their rows are dealt out by ranges of turns and cut into pieces of
at most ``LONG_ROWS`` rows, every piece is solved from every state to every state, and the pieces' tables are the axioms of
a second, shorter deduction.  Only letters and costs of such a conversation come together, a few bytes for each row; its
texts pass through the last task one after another, which is what one digest or one ordered transcript of them takes.

Defined results: rows of one turn stand by role and then text; a null turn comes before the others; null role, text,
conv_id or turn are one space where they are read as text, so a null role and a role of one space are the same; a null
conv_id is a conversation of its own; an empty role has no initial and can't be kept; a role's case counts; repeated rows
are rows like others; other columns play no part; a table without rows gives none.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import chain, groupby, islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._shared import stored

LONG_ROWS = 1024
LONG_BYTES = 16 << 20
SPACE = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of leaving a truncated text in.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLE = {"u": "user", "a": "assistant"}
#: What may follow: at the start, after a system row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
CLOSED = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
INSERTS = [("I", x, INSERT) for x in ROLE]
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
#: The letters of the faults, in the order in which they count.
BLANK, DUPLICATE, CUT, SOUND = "bdt-"


def lightest(axioms: list[tuple], deduce: Callable[[tuple, int, str], Iterator[tuple]], goal: tuple | None) -> dict[tuple, tuple[int, str]]:
    """Items with their lightest weights, (cost, audit), by Knuth's agenda; it ends when goal is finalised, or with the last
    item.  axioms: (cost, audit, item); deduce: what follows from an item that has just been finalised, likewise."""
    agenda, final = list(axioms), {}
    heapq.heapify(agenda)
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item == goal:
            break
        for conclusion in deduce(item, cost, audit):
            if conclusion[2] not in final:
                heapq.heappush(agenda, conclusion)
    return final


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str


def edits(row: Row) -> list[tuple[str, str | None, int]]:
    """(letter, initial that is left or None, cost) of each edit of a row."""
    out = [("D", None, DELETE)]
    if row.fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if row.fault == CUT else 0
        out += [("K", row.role[:1], extra), *(("R", x, REROLE + extra) for x in ROLE)]
    return out


GOAL = (-1, -1)


def _deductions(axioms: list[list[tuple]], goals: bool) -> Callable:
    """What follows from the item (k, state) by the edits of row k and by insertions."""
    end = len(axioms)

    def deduce(item: tuple, cost: int, audit: str) -> Iterator[tuple]:
        k, state = item
        if k == end and goals and state in CLOSED:
            yield cost, audit, GOAL
        for letter, left, own in axioms[k] if k < end else ():
            to = state if left is None else NEXT.get((state, left))
            if to is not None:
                yield cost + own, audit + letter, (k + 1, to)
        for letter, left, own in INSERTS:
            to = NEXT.get((state, left))
            if to is not None:
                yield cost + own, audit + letter, (k, to)

    return deduce


def whole(rows: list[Row]) -> tuple[int, str]:
    """(cost, audit) of the lightest repair of a conversation."""
    return lightest([(0, "", (0, START))], _deductions([edits(r) for r in rows], True), GOAL)[GOAL]


def table(rows: list[Row]) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, audit) of the lightest repairs of a piece of a conversation."""
    axioms = [edits(r) for r in rows]
    out = []
    for state in STATES:
        final = lightest([(0, "", (0, state))], _deductions(axioms, False), None)
        out += [(state, to, *final[len(rows), to]) for to in STATES if (len(rows), to) in final]
    return out


def joined(tables: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of a conversation from its pieces' tables: (piece, state) with a span of the piece gives (piece + 1,
    its other end)."""

    def deduce(item: tuple, cost: int, audit: str) -> Iterator[tuple]:
        k, state = item
        if k == len(tables):
            if state in CLOSED:
                yield cost, audit, GOAL
            return
        for start, to, own, letters in tables[k]:
            if start == state:
                yield cost + own, audit + letters, (k + 1, to)

    return lightest([(0, "", (0, START))], deduce, GOAL)[GOAL]


def mended(rows: Iterator[Row], audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves or inserts."""
    rows, open_user = iter(rows), False
    for letter in audit:
        row = None if letter == "I" else next(rows)
        if letter == "D":
            continue
        turn_to = "assistant" if open_user else "user"
        role = row.role if letter == "K" else turn_to
        open_user = role[:1] == "u"
        yield letter, role, row.text if row else ""


class Tally:
    """Counts over a conversation's rows in order; tallies of pieces add up."""

    NAMES = ("n", "distinct", "low", "high", "first_turn", "last_turn", "first", "last", "blank", "duplicate", "truncated", "illegal")

    def __init__(self, rows: list[Row] = (), **have) -> None:
        """Of rows, or with the counts that are known."""
        turns = [r.turn for r in rows if r.turn is not None]
        faults = "".join(r.fault for r in rows)
        initials = [r.role[:1] for r in rows]
        own = {
            "n": len(rows), "distinct": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
            "first": initials[0] if rows else None, "last": initials[-1] if rows else None,
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        }
        self.__dict__.update(own | have)

    def add(self, o: Tally) -> None:
        """o: of the rows that follow."""
        self.distinct += o.distinct - (self.last_turn is not None and self.last_turn == o.first_turn)
        self.illegal += o.illegal + (self.n > 0 and o.n > 0 and self.last + o.first not in LEGAL)
        for name in ("n", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(o, name))
        for name, of in (("low", min), ("high", max)):
            both = [x for x in (getattr(self, name), getattr(o, name)) if x is not None]
            setattr(self, name, of(both, default=None))
        self.first, self.last = (self.first if self.first is not None else o.first), (o.last if o.n else self.last)
        self.first_turn = self.first_turn if self.first_turn is not None else o.first_turn
        self.last_turn = o.last_turn if o.last_turn is not None else self.last_turn

    @property
    def gaps(self) -> int:
        """Turns that are missing between the first and the last; at most what a long holds."""
        return 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, (1 << 63) - 1)


Told = tuple[object, dict, Iterator[tuple[str, str, str]]]
Output = Callable[[Iterator[Told]], Iterator[pa.RecordBatch]]
SUMMARY = ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string"
_PIECE = ", ".join(f"{c} {'string' if c in ('first', 'last') else 'long'}" for c in Tally.NAMES) + ", spans array<struct<start: int, to: int, cost: bigint, audit: string>>"


def _summary(tally: Tally, weight: tuple[int, str]) -> dict:
    return {c: getattr(tally, c) for c in COUNTS} | {"cost": weight[0], "audit": weight[1]}


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _written(rows: Iterator[dict], schema: pa.Schema, at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, at_once)):
        yield pa.RecordBatch.from_pylist(some, schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[Told]:
    """Conversations from their rows in order."""
    for conv, own in groupby(_rows(batches, "conv_id", "turn", "role", "text", "gone", "same", "kind"), key=lambda r: r[0]):
        rows, seen = [], set()
        for _, turn, role, text, gone, same, kind in own:
            if not gone:
                rows.append(Row(turn, role, text, DUPLICATE if kind != BLANK and same in seen else kind))
                seen.add(same)
        weight = whole(rows)
        yield conv, _summary(Tally(rows), weight), mended(rows, weight[1])


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict]:
    """Tallies and tables of the pieces of long conversations, from their rows in order without texts."""
    for conv, own in groupby(_rows(batches, "conv_id", "turn", "role", "kind", "same", "again"), key=lambda r: r[0]):
        before, rows = None, []
        index = 0
        for _, turn, role, kind, same, again in chain(own, [(None,) * 6]):
            if rows and (kind is None or len(rows) == most):
                tally = Tally(rows)
                yield {"conv_id": conv, "turn": rows[0].turn, "index": index, "spans": [dict(zip(("start", "to", "cost", "audit"), x, strict=True)) for x in table(rows)]} | {c: getattr(tally, c) for c in Tally.NAMES}
                index, rows = index + 1, []
            if kind is not None:
                again, before = again or before == (turn, same), (turn, same)
                rows.append(Row(turn, role, "", DUPLICATE if kind != BLANK and again else kind))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Summaries of long conversations from their pieces in order, the first of which is an empty one."""
    for conv, own in groupby(_rows(batches, "conv_id", "index", "spans", *Tally.NAMES), key=lambda r: r[0]):
        tally, tables = Tally(), []
        for _, index, spans, *counts in own:
            if index >= 0:
                tally.add(Tally(**dict(zip(Tally.NAMES, counts, strict=True))))
                tables.append([tuple(x[c] for c in ("start", "to", "cost", "audit")) for x in spans])
        yield {"conv_id": conv} | _summary(tally, joined(tables))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[Told]:
    """Long conversations from their summaries, each followed by its rows in order."""
    names = (*COUNTS, "cost", "audit")
    for conv, own in groupby(_rows(batches, "conv_id", "turn", "role", "text", *names), key=lambda r: r[0]):
        own = iter(own)
        summary = dict(zip(names, next(own)[4:], strict=True))
        yield conv, summary, mended((Row(turn, role, text, SOUND) for _, turn, role, text, *_ in own), summary["audit"])


def prepared(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) with same, a digest of role and text, and kind, the row's fault but for repetition."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    kind = F.when(end == "", BLANK).when(F.substring(end, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    return rows.select("conv_id", "turn", "role", "text", "gone", F.unhex(F.md5(F.concat("role", F.lit("\0"), "text"))).alias("same"), kind.alias("kind"))


def plain(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): whatever else rows has left out, nulls of role and text as one space."""
    return rows.select(*(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))


def _ordered(df: DataFrame, *first: str) -> DataFrame:
    return df.sortWithinPartitions(*(F.asc_nulls_first(c) for c in ("conv_id", *first, "turn", "role", "same")))


def _told(rows: DataFrame, output: Output, schema: str) -> DataFrame:
    """What output makes of the repaired conversations of rows (conv_id, turn, role, text, gone): it gets (conv_id, counts,
    cost and audit, its turns as (edit, role, text)) of one after another and yields batches of schema.  Rows that are gone
    only tell that their conversation is there."""
    own = prepared(rows)
    size = own.groupBy("conv_id").agg(F.count_if(~F.col("gone")).alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    long = stored(size.where((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select(F.col("conv_id").alias("long_id"), F.lit(True).alias("is_long")), "long-conversations")

    def solve(source: Callable) -> Callable:
        return lambda batches: output(source(batches))

    if long.isEmpty():
        return _ordered(own.repartition("conv_id")).mapInArrow(solve(_solved), schema)
    same_conv = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = _ordered(own.join(long, same_conv, "left_anti").repartition("conv_id")).mapInArrow(solve(_solved), schema)
    rest = own.join(long, same_conv, "left_semi").where("NOT gone")
    # A row repeats an earlier one if its role and text were seen at a turn before; within a turn such rows are neighbours.
    light = rest.select("conv_id", "turn", "role", "kind", "same")
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    first = light.groupBy(F.col("conv_id").alias("first_conv"), F.col("same").alias("first_same")).agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    on = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("same") == F.col("first_same"))
    told = light.join(first, on, "left").select(*light.columns, F.coalesce(turn > F.col("first"), F.lit(False)).alias("again"))
    dealt = told.repartitionByRange(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"))
    told_as = f"conv_id long, {SUMMARY}"
    piece = f"conv_id long, turn long, index int, {_PIECE}"
    most, piece_rows, told_rows = LONG_ROWS, _arrow(piece), _arrow(told_as)
    pieces = _ordered(dealt).mapInArrow(lambda b: _written(_pieces(b, most), piece_rows), piece)
    marks = long.select(F.col("long_id").alias("conv_id"), F.lit(-1).alias("index"))
    in_order = pieces.unionByName(marks, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*(F.asc_nulls_first(c) for c in ("conv_id", "turn", "index")))
    summaries = stored(in_order.mapInArrow(lambda b: _written(_composed(b), told_rows), told_as), "long-summaries")
    both = summaries.withColumn("tag", F.lit(0)).unionByName(rest.select("conv_id", "turn", "role", "text", "same").withColumn("tag", F.lit(1)), allowMissingColumns=True)
    return short.unionByName(_ordered(both.repartition("conv_id"), "tag").mapInArrow(solve(_streamed), schema))


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, edit, role, text): the turns of every repaired conversation, numbered from 1, and the edit that each
    comes from: K as it was, R another role, I inserted."""
    schema = "conv_id long, n int, edit string, role string, text string"
    arrow = _arrow(schema)

    def turns(told: Iterator[Told]) -> Iterator[pa.RecordBatch]:
        each = ({"conv_id": conv, "n": n, "edit": edit, "role": role, "text": text} for conv, _, own in told for n, (edit, role, text) in enumerate(own, 1))
        return _written(each, arrow)

    return _told(plain(conversations).withColumn("gone", F.lit(False)), turns, schema)


def digests(rows: DataFrame) -> DataFrame:
    """A row for each conversation of rows (conv_id, turn, role, text, gone): counts of faults, the cost and the letters of
    its repair, and the SHA-256 of the repaired ``role:text``, a line each."""
    schema = f"conv_id long, {SUMMARY}, repaired_sha256 string"
    arrow = _arrow(schema)

    def digest(told: Iterator[Told]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for conv, summary, own in told:
                sha = hashlib.sha256()
                for n, (_, role, text) in enumerate(own):
                    sha.update(("\n" * (n > 0) + f"{role}:{text}").encode())
                yield {"conv_id": conv, **summary, "repaired_sha256": sha.hexdigest()}

        return _written(each(), arrow)

    return _told(rows, digest, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with the faults that their conv_id and turn call for; those dropped are marked gone."""
    rows = plain(conversations)
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    own = rows.withColumn("code", F.crc32(key) % 20).withColumn("copy", copies)
    return own.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("code") == 0).alias("gone"))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return digests(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
