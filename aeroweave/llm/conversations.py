"""Conversation structure repair: the cheapest edits, found by depth-first branch-and-bound and proved optimal."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import SPACE, arrow_schema, discard, record_batch, written

#: A conversation is solved in stretches of so many rows, each between all pairs of states, which are then chained.
STRETCH = 24
#: Solved stretches a task remembers.
REMEMBERED = 50_000
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

# what the role initials so far allow: nothing yet, a system row, an open user row, whole pairs
EMPTY, SYSTEM, OPEN, PAIRED = STATES = range(4)
_AFTER = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): OPEN, (SYSTEM, "u"): OPEN, (OPEN, "a"): PAIRED, (PAIRED, "u"): OPEN}
_WANTED = {EMPTY: "u", SYSTEM: "u", OPEN: "a", PAIRED: "u"}
_ROLE = {"u": "user", "a": "assistant"}
_ENDS = (EMPTY, PAIRED)
#: Code of a row that has to go; other rows are coded by their initial, truncated ones in upper case, any other initial as o.
GONE = "x"


def _suffix_bounds(codes: str) -> list[int]:
    """What the rows from each position on cost at least: a row that must go, or a truncated one, costs a deletion."""
    bounds = [0]
    for code in reversed(codes):
        bounds.append(bounds[-1] + (0 if code.islower() and code != GONE else min(DELETE_COST, TRUNCATED_COST)))
    return bounds[::-1]


def _inserts_left(state: int, end: int) -> int | None:
    """Insertions that lead from a state to another; None where none do."""
    count = 0
    while state != end:
        if count == len(STATES):
            return None
        state, count = _AFTER[state, _WANTED[state]], count + 1
    return count


_INSERTS = {(a, b): _inserts_left(a, b) for a, b in product(STATES, STATES)}


def cheapest(codes: str, start: int, end: int) -> tuple[int, str] | None:
    """Least cost and, among its edits, the ASCII-least audit that lead from one state to another; None if none do.

    A node is a position and a state. Branches wait on an explicit stack, the most promising on top. A branch goes when its cost
    with the bound of the suffix exceeds the incumbent's, when it ties and its audit can't get smaller, or when the node's
    dominance table holds a prefix of less cost, or of equal cost and smaller audit. Once the stack is empty the incumbent is optimal.
    """
    bounds = _suffix_bounds(codes)
    incumbent: tuple[int, str] | None = None
    dominant: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if dominant.get((at, state), (cost, audit)) < (cost, audit):
            continue
        if at == len(codes) and state == end:
            incumbent = (cost, audit)  # dominance keeps larger ones from coming here
            continue
        branches = []
        if at < len(codes):
            code = codes[at]
            if code != GONE:
                worn = TRUNCATED_COST if code.isupper() else 0
                kept = _AFTER.get((state, code.lower()))
                if kept is not None:
                    branches.append((at + 1, kept, cost + worn, audit + KEEP))
                forward = _AFTER[state, _WANTED[state]]
                if kept != forward:
                    branches.append((at + 1, forward, cost + worn + REROLE_COST, audit + REROLE))
            branches.append((at + 1, state, cost + DELETE_COST, audit + DELETE))
        branches.append((at, _AFTER[state, _WANTED[state]], cost + INSERT_COST, audit + INSERT))
        open_branches = []
        for branch in branches:
            to, into, spent, edits = branch
            least = bounds[to]
            if to == len(codes):
                left = _INSERTS[into, end]
                if left is None:
                    continue
                least = left * INSERT_COST
            if incumbent is not None:
                if spent + least > incumbent[0] or (spent + least == incumbent[0] and edits > incumbent[1]):
                    continue
            if dominant.get((to, into), (spent + 1, "")) <= (spent, edits):
                continue
            dominant[to, into] = (spent, edits)
            open_branches.append((spent + least, edits, branch))
        stack += [branch for _, _, branch in sorted(open_branches, reverse=True)]
    return incumbent


@lru_cache(REMEMBERED)
def stretch(codes: str) -> dict[tuple[int, int], tuple[int, str]]:
    """The best (cost, audit) of a stretch for each pair of states at its ends that edits can connect."""
    found = {(a, b): cheapest(codes, a, b) for a, b in product(STATES, STATES)}
    return {ends: best for ends, best in found.items() if best is not None}


def chained(first: dict, second: dict) -> dict:
    """The best of two stretches in a row: the least over the state between them."""
    best: dict = {}
    for (a, m), (cost, audit) in first.items():
        for b in STATES:
            if (m, b) in second:
                more, rest = second[m, b]
                found = (cost + more, audit + rest)
                if (a, b) not in best or found < best[a, b]:
                    best[a, b] = found
    return best


NOTHING = {(a, a): (0, "") for a in STATES}


def solved(table: dict) -> tuple[int, str]:
    """The best way through a whole conversation."""
    return min(table[EMPTY, end] for end in _ENDS if (EMPTY, end) in table)


def is_legal(before: str | None, after: str) -> bool:
    return before is None or before + after in ("su", "ua", "au")


_SEGMENT = "conv long, first string, last string, illegal long, ends array<int>, costs array<long>, audits array<string>"


def _segments(batches):
    """One row for each conversation of a sorted partition: its part there, solved between all pairs of states."""
    schema = arrow_schema(_SEGMENT)
    done: list[tuple] = []
    conv: object = batches  # equal to no conversation
    table, codes, first, last, illegal = NOTHING, "", None, None, 0

    def finished():
        whole = chained(table, stretch(codes)) if codes else table
        return (conv, first, last, illegal, [4 * a + b for a, b in whole], [c for c, _ in whole.values()], [a for _, a in whole.values()])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "role", "n", "fault", "earlier")]
        for this, role, n, fault, earlier in zip(*columns):
            if this != conv:
                if first is not None:
                    done.append(finished())
                conv, table, codes, first, last, illegal = this, NOTHING, "", None, None, 0
            initial = role[:1]
            own = GONE if fault == "blank" or earlier else (initial if initial in "sua" and initial else "o")
            own = own.upper() if fault == "truncated" and own != GONE else own
            for i in range(n):
                illegal += not is_legal(last, initial)
                first, last = initial if first is None else first, initial
                codes += own if i == 0 else GONE  # what repeats an identical row is a duplicate
                if len(codes) == STRETCH:
                    table, codes = chained(table, stretch(codes)), ""
        if len(done) > 1000:
            yield record_batch(done, schema)
            done = []
    if first is not None:
        done.append(finished())
    if done:
        yield record_batch(done, schema)


class _Repair:
    """A conversation on its way through a task: first its segments in order, then its rows, edited as they come."""

    def __init__(self, conv):
        self.conv, self.table, self.last, self.illegal, self.best = conv, NOTHING, None, 0, None
        self.at, self.state = 0, EMPTY

    def add_segment(self, first, last, illegal, ends, costs, audits):
        self.illegal += illegal + (not is_legal(self.last, first))
        self.table = chained(self.table, {divmod(e, 4): (c, a) for e, c, a in zip(ends, costs, audits)})
        self.last = last

    def rows_begin(self):
        if self.best is None:
            self.best, self.table = solved(self.table), None

    def inserted(self):
        """The (edit, role, text) that the audit puts in before the next row."""
        while self.best[1][self.at:self.at + 1] == INSERT:
            wanted = _WANTED[self.state]
            self.state, self.at = _AFTER[self.state, wanted], self.at + 1
            yield INSERT, _ROLE[wanted], ""

    def edited(self, role, text):
        """The (edit, role, text) that the next row becomes, with what is put in before it."""
        yield from self.inserted()
        edit, wanted = self.best[1][self.at], _WANTED[self.state]
        self.at += 1
        if edit == KEEP:
            self.state = _AFTER[self.state, role[:1]]
            yield edit, role, text
        elif edit == REROLE:
            self.state = _AFTER[self.state, wanted]
            yield edit, _ROLE[wanted], text


class _Hashed:
    """Collects one (conv, illegal, cost, audit, hash) per conversation."""

    schema = "conv long, illegal long, cost long, audit string, repaired_sha256 string"

    def begin(self):
        self.hash, self.between = hashlib.sha256(), ""

    def add(self, repair, edit, role, text):
        self.hash.update(f"{self.between}{role}:{text}".encode("utf-8", "replace"))
        self.between = "\n"

    def end(self, repair):
        return [(repair.conv, repair.illegal, *repair.best, self.hash.hexdigest())]


class _Rows:
    """Collects the repaired rows themselves."""

    schema = "conv long, place long, edit string, role string, text string"

    def begin(self):
        self.place, self.found = 0, []

    def add(self, repair, edit, role, text):
        self.found.append((repair.conv, self.place, edit, role, text))
        self.place += 1

    def end(self, repair):
        found, self.found = self.found, []
        return found


def _finish(kind):
    """Goes through conversations whose segments and rows come sorted, and holds nothing of one but its audits."""
    def finish(batches):
        schema, out, collector = arrow_schema(kind.schema), [], kind()
        now: _Repair | None = None

        def ended():
            now.rows_begin()
            for written_row in now.inserted():
                collector.add(now, *written_row)
            return collector.end(now)

        names = ("conv", "part", "first", "last", "illegal", "ends", "costs", "audits", "role", "n", "text")
        for batch in batches:
            for conv, part, *segment, role, n, text in zip(*[batch.column(c).to_pylist() for c in names]):
                if now is None or conv != now.conv:
                    if now is not None:
                        out += ended()
                    now = _Repair(conv)
                    collector.begin()
                if part is not None:
                    now.add_segment(*segment)
                    continue
                now.rows_begin()
                for _ in range(n):
                    for written_row in now.edited(role, text):
                        collector.add(now, *written_row)
            if kind is _Rows and now is not None:
                out += collector.end(now)
            if out:
                yield record_batch(out, schema)
                out = []
        if now is not None and (out := ended()):
            yield record_batch(out, schema)
    return finish


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows as conv, turn, role, text and n, the times each occurs, after damage by crc32 of ``conv:turn`` modulo 20.

    0 drops a row (n = 0), 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out, 3 repeats it, 4 makes it the user's. Null roles and
    texts, and null ids within the hashed text, count as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"),
        space(text).alias("text"), case.alias("case"),
    ).select(
        "conv", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("case") == 0, 0).when(F.col("case") == 3, 2).otherwise(1).cast("long").alias("n"))


def _whole(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows as they are, with n = 1; nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"),
                       space(text).alias("text"), F.lit(1).cast("long").alias("n"))


def _fault(text: Column) -> Column:
    ending = F.substring(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return F.when(~text.rlike(SPACE.replace("[", "[^")), "blank").when(~ending.isin(".", "!", "?"), "truncated").otherwise("none")


def _marked(source: DataFrame) -> DataFrame:
    """Equal rows as one, with their number ``n`` (0 for dropped ones), their fault and whether role and text came earlier."""
    facts = source.withColumn("fault", _fault(F.col("text"))).groupBy("conv", "turn", "role", "digest").agg(
        F.sum("n").alias("n"), F.max("fault").alias("fault"))
    facts = written(facts, "facts")
    firsts = facts.filter("n > 0").groupBy("conv", "role", "digest").agg(
        F.min(F.struct("turn")).alias("began"), F.count("*").alias("times")).filter("times > 1")
    again = firsts.select(*[F.col(c).alias(f"_{c}") for c in ("conv", "role", "digest")], "began")
    same = facts["conv"].eqNullSafe(again["_conv"]) & (facts["role"] == again["_role"]) & (facts["digest"] == again["_digest"])
    earlier = F.coalesce(F.struct("turn") > F.col("began"), F.lit(False))
    marked = written(facts.join(again, same, "left").select(*facts.columns, earlier.alias("earlier")), "marked")
    discard(facts)
    return marked


_ORDER = ("turn", "role", "digest")


def _edited(source: DataFrame, marked: DataFrame, kind) -> DataFrame:
    """Segments solved under a range partitioning, then chained and applied to the rows of their conversation."""
    order = [F.asc_nulls_first(c) for c in ("conv", *_ORDER)]
    segments = (
        marked.filter("n > 0").repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "role", "n", "fault", "earlier").mapInArrow(_segments, _SEGMENT)
        .withColumn("part", F.spark_partition_id().cast("long")))
    texts = source.filter("n > 0").select("conv", *_ORDER, "n", "text")
    stream = written(segments, "segments").unionByName(texts, allowMissingColumns=True)
    return (
        stream.repartition("conv")
        .sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_last("part"), *order[1:])
        .select("conv", "part", "first", "last", "illegal", "ends", "costs", "audits", "role", "n", "text")
        .mapInArrow(_finish(kind), kind.schema))


def _source(rows: DataFrame, damage: bool, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return (damaged if damage else _whole)(rows, conv, turn, role, text).withColumn("digest", F.unhex(F.sha2("text", 256)))


def repair(
    rows: DataFrame, damage: bool = False, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """The repaired rows of every conversation: conv_id, place (from 0), edit, role and text.

    A row goes (D), stays (K), takes the other role (R) or is put in with empty text (I), at the least cost and, of that, with the
    ASCII-least audit, so that role initials become ``(s?(ua)+)?``. Conversations of which nothing is left have no rows.

    Rows follow their turn, unknown turns first; rows of one turn follow role and then a hash of the text. A null conversation id is a
    conversation; null roles and texts are one space; initials other than s, u and a fit nowhere. Repeated rows are duplicates. An
    empty table gives no rows. Texts may be of any length. Other columns are not read. ``damage`` first spoils rows (:func:`damaged`).

    Equal rows are counted before anything is ordered. What is left, without texts, is range-partitioned by conversation and order,
    so that a conversation of any length is cut at partition borders and solved in stretches (:func:`stretch`); the tables of
    its segments are chained afterwards. Then a conversation's texts pass through one task as a stream that Spark has sorted.
    """
    source = _source(rows, damage, conv_column, turn_column, role_column, text_column)
    return _edited(source, _marked(source), _Rows).withColumnRenamed("conv", conv_column)


def audit(
    rows: DataFrame, damage: bool = False, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair, and the SHA-256 of the repaired ``role:text`` lines.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 by the rules of :func:`repair`. A
    conversation all of whose rows ``damage`` dropped has zeros, an empty audit and the hash of the empty string. The hash follows
    the rows of :func:`repair` as they come, so no conversation is ever put together.
    """
    source = _source(rows, damage, conv_column, turn_column, role_column, text_column)
    marked = _marked(source)
    results = _edited(source, marked, _Hashed)
    blank, duplicate = F.col("fault") == "blank", F.col("earlier")
    counts = marked.filter("n > 0").groupBy("conv", "turn").agg(
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).otherwise(F.col("n") - F.when(duplicate, 0).otherwise(1))).alias("duplicate"),
        F.count_if((F.col("fault") == "truncated") & ~duplicate).alias("truncated"),
    ).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    every = marked.select(F.col("conv").alias("id")).distinct()
    counts, results = (df.withColumnRenamed("conv", f"conv_{i}") for i, df in enumerate((counts, results)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (
        every.join(counts, F.col("id").eqNullSafe(F.col("conv_0")), "left")
        .join(results, F.col("id").eqNullSafe(F.col("conv_1")), "left")
        .select(F.col("id").alias(conv_column), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
