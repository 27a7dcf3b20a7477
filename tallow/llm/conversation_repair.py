"""Conversation structure repair by a rank-convergence parallel Viterbi.

The turns of a conversation are edited at least cost so that the initials of
their roles read ``(s?(ua)+)?``: each row is kept (0), given the role user or
assistant (1) or deleted (2, the only choice for blank rows and for those that
repeat a role and text of the conversation), and empty user or assistant turns
(5) may be inserted anywhere. A row whose last visible character is none of
``.!?`` costs 5 more unless deleted.

The pattern has four states (START, after s, after u, after a). Backward, the
cost to finish is a vector over the states; a row is a min-plus linear map of it.

1. Rows are range-sorted by conversation and turn, so a conversation of any size
   lies in consecutive partitions. Each task walks its rows; conversations that
   begin and end inside it are solved there. The pieces at a task's two ends, and
   pieces of PIECE rows of longer conversations, are left open.
2. All open pieces are swept backward at once, from a speculative vector of costs.
   Products of such maps soon have rank one: whatever the vector at the end, the
   vectors at the start differ only by a constant. A fix-up pass hands every piece
   the start vector of the piece after it (the last piece the true end) and sweeps
   again only those whose end vector changed by more than a constant. When none is
   left, the constants add up to the true costs.
3. The stitched costs drive the trace: in each state the first of D, I, K, R that
   lies on a cheapest path is taken, which gives the ASCII-least audit. A piece is
   traced from all four states; chaining the pieces' state maps tells the one it
   really starts in.

The digest of a whole conversation is sequential by nature: the edited turns of
an open one stream in order through one task, which holds a batch of them and the
audit.

Null ids are one conversation. Rows run by turn, nulls first; rows of equal turn
by a hash of role and text, so that repeated rows are adjacent (ties are settled
alike in every run). Null roles and texts count as one space, which is blank;
very long texts and conversations are split or streamed as said. Roles other than
these three can be deleted or renamed, not kept, unless their initial fits. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import WHITE, bounded_batches, materialize
from tallow.sources.tables import delete_path

PIECE = 1024             # rows of an open piece
PIECE_BYTES = 32 << 20   # text of an open piece, unless a single row has more

# States, costs and the moves between states.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, RENAME, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
ROLE = {USER: "user", ASSISTANT: "assistant"}
FOLLOWS = (USER, USER, ASSISTANT, USER)  # where a renamed or inserted turn leads from each state
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
TERMINAL = (0, 2 * INSERT, INSERT, 0)    # costs to finish after the last row
LEGAL = ("su", "ua", "au")

REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
WALK = ("kind int, conv_id bigint, piece bigint, pos bigint, turn bigint, role string, text string, live boolean, "
        "is_blank boolean, is_cut boolean, edit string, k int, " + REPORT)
NAMES = [c.split()[0] for c in WALK.split(", ")]
TYPES = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
WALK_SCHEMA = pa.schema([(n, TYPES[t]) for n, t in (c.split() for c in WALK.split(", "))])
SOLVED, OPEN, TURN = range(3)


# ---------------------------------------------------------------- one piece

def sweep(rows: list[tuple[str, bool, bool]], end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs to finish before each row of ``(initial, must go, cut off)`` and after the last."""
    costs = [tuple(end)]
    for initial, must_go, cut in reversed(rows):
        after = costs[-1]
        here = [DELETE + c for c in after]
        if not must_go:
            extra = CUT if cut else 0
            kept = KEPT.get(initial, {})
            for q in range(4):
                here[q] = min(here[q], RENAME + extra + after[FOLLOWS[q]])
                if q in kept:
                    here[q] = min(here[q], KEEP + extra + after[kept[q]])
        # Up to two turns can usefully be inserted before the row.
        once = [min(here[q], INSERT + here[FOLLOWS[q]]) for q in range(4)]
        costs.append(tuple(min(once[q], INSERT + once[FOLLOWS[q]]) for q in range(4)))
    return costs[::-1]


def trace(rows: list[tuple[str, bool, bool]], costs: list[tuple[int, ...]], state: int,
          last: bool) -> tuple[list[tuple[str, int, str | None]], int]:
    """The ASCII-least cheapest edits ``(D, I, K or R; row; new role)`` from ``state``, and the end state."""
    out: list[tuple[str, int, str | None]] = []
    for i, (initial, must_go, cut) in enumerate(rows):
        extra = CUT if cut else 0
        while True:
            cost, after, to = costs[i][state], costs[i + 1], FOLLOWS[state]
            if cost == DELETE + after[state]:
                out.append(("D", i, None))
            elif cost == INSERT + costs[i][to]:
                out.append(("I", i, ROLE[to]))
                state = to
                continue
            elif not must_go and state in KEPT.get(initial, {}) and cost == KEEP + extra + after[KEPT[initial][state]]:
                out.append(("K", i, None))
                state = KEPT[initial][state]
            else:
                out.append(("R", i, ROLE[to]))
                state = to
            break
    while last and TERMINAL[state]:
        state = FOLLOWS[state]
        out.append(("I", len(rows), ROLE[state]))
    return out, state


def edited(edits, roles: list[str], texts: list[str]) -> Iterator[tuple[str, int, str | None, str | None]]:
    """``(edit, row, role, text)`` of each edit; role and text are null for deleted rows."""
    for edit, i, role in edits:
        if edit == "D":
            yield edit, i, None, None
        elif edit == "I":
            yield edit, i, role, ""
        else:
            yield edit, i, roles[i] if edit == "K" else role, texts[i]


def faults(rows: list[tuple], repeated: list[bool]) -> list[tuple[str, bool, bool]]:
    """What :func:`sweep` takes, of rows ``(pos, turn, role, text, live, blank, cut)``."""
    return [(r[2][:1], r[5] or again, r[6] and not r[5] and not again) for r, again in zip(rows, repeated, strict=True)]


def counts(rows: list[tuple], repeated: list[bool]) -> dict:
    """Faults and turns of a run of live rows, with what joining it to its neighbours needs."""
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    blank = sum(r[5] for r in rows)
    duplicate = sum(again and not r[5] for r, again in zip(rows, repeated, strict=True))
    return {"n": len(rows), "blank": blank, "duplicate": duplicate,
            "truncated": sum(r[6] and not r[5] and not again for r, again in zip(rows, repeated, strict=True)),
            "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:], strict=False)),
            "first_initial": initials[0] if rows else None, "last_initial": initials[-1] if rows else None,
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "distinct": len(set(turns))}


def _gaps(low, high, distinct) -> int:
    return 0 if low is None else high - low + 1 - distinct


# ---------------------------------------------------------------- rows in order

def _prepared(conversations: DataFrame, live: Column) -> DataFrame:
    """Rows with their faults, in order of conversation and turn over all partitions."""
    spaced = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.coalesce(live, F.lit(False)).alias("live"))
    bare = F.btrim("text", F.lit(WHITE))
    marked = spaced.withColumn("blank", bare == "").withColumn("cut", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))
    order = ["conv_id", "turn", F.xxhash64("role", "text")]
    # Equal rows are alike, so a salt may deal a great many of them to several ranges.
    salted = marked.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(4096)))
    return salted.repartitionByRange(*order, "salt").sortWithinPartitions(*order, "role", "text").drop("salt")


class _Writer:
    """Collects rows of the walk's schema into batches."""

    def __init__(self):
        self.rows: list[dict] = []

    def add(self, **values) -> None:
        self.rows.append(values)

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_pylist(rows, schema=WALK_SCHEMA)


def _solve(conv_id, rows: list[tuple], out: _Writer, turns: bool) -> None:
    """A whole conversation: its report, or its repaired turns."""
    live = [r for r in rows if r[4]]
    seen: set[tuple[str, str]] = set()
    repeated = []
    for r in live:
        repeated.append((r[2], r[3]) in seen)
        seen.add((r[2], r[3]))
    steps = faults(live, repeated)
    costs = sweep(steps, TERMINAL)
    done = list(edited(trace(steps, costs, START, True)[0], [r[2] for r in live], [r[3] for r in live]))
    if turns:
        for k, (edit, i, role, text) in enumerate(done):
            if edit != "D":
                row = live[min(i, len(live) - 1)]
                out.add(kind=TURN, conv_id=conv_id, pos=rows[0][0], k=k, turn=None if edit == "I" else row[1], role=role, text=text, edit=edit)
        return
    c = counts(live, repeated)
    body = "\n".join(f"{role}:{text}" for edit, _, role, text in done if edit != "D")
    out.add(kind=SOLVED, conv_id=conv_id, gaps=_gaps(c["low"], c["high"], c["distinct"]), blank=c["blank"], duplicate=c["duplicate"],
            truncated=c["truncated"], illegal=c["illegal"], cost=costs[0][START], audit="".join(e[0] for e in done),
            repaired_sha256=hashlib.sha256(body.encode()).hexdigest())


def _walk(turns: bool):
    """Solve the conversations that lie inside a partition; give out the others in pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos = TaskContext.get().partitionId() << 33
        out = _Writer()
        rows: list[tuple] = []
        size, conv_id, is_open = 0, None, True  # a conversation may have begun before the partition

        def give_out():
            for r in rows:
                out.add(kind=OPEN, conv_id=conv_id, piece=rows[0][0], pos=r[0], turn=r[1], role=r[2], text=r[3], live=r[4],
                        is_blank=r[5], is_cut=r[6])

        started = False
        for b in batches:
            for c, *rest in zip(*[col.to_pylist() for col in b.columns], strict=True):
                if started and c != conv_id:
                    if is_open:
                        give_out()
                    else:
                        _solve(conv_id, rows, out, turns)
                    rows, size, is_open = [], 0, False
                elif len(rows) >= PIECE or size >= PIECE_BYTES:
                    give_out()
                    rows, size, is_open = [], 0, True
                started, conv_id = True, c
                rows.append((pos, *rest))
                size += len(rest[2])
                pos += 1
            yield out.batch()
        give_out()  # it may go on in the next partition
        yield out.batch()

    return run


# ---------------------------------------------------------------- open pieces

VECTORS = "conv_id bigint, piece bigint, used array<bigint>, begin array<bigint>"
PIECES = (VECTORS + ", n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, "
          "last_initial string, low bigint, high bigint, distinct bigint")


def _live_rows(t: pa.Table) -> tuple[list[tuple], list[bool]]:
    """The live rows of a piece in order, and whether each repeats an earlier one."""
    t = t.sort_by("pos")
    cols = [t.column(c).to_pylist() for c in ("pos", "turn", "role", "text", "live", "is_blank", "is_cut")]
    rows, again = list(zip(*cols, strict=True)), t.column("again").to_pylist()
    keep = [i for i, r in enumerate(rows) if r[4]]
    return [rows[i] for i in keep], [again[i] for i in keep]


def _piece(t: pa.Table) -> dict:
    return {"conv_id": t.column("conv_id")[0].as_py(), "piece": t.column("piece")[0].as_py()}


def _schema(ddl: str) -> pa.Schema:
    types = TYPES | {f"array<{k}>": pa.list_(v) for k, v in TYPES.items()}
    return pa.schema([(n, types[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _speculate(t: pa.Table) -> pa.Table:
    rows, again = _live_rows(t)
    used = (0, 0, 0, 0)
    return pa.Table.from_pylist([{**_piece(t), "used": used, "begin": sweep(faults(rows, again), used)[0], **counts(rows, again)}],
                                schema=_schema(PIECES))


def _again(t: pa.Table) -> pa.Table:
    rows, again = _live_rows(t)
    used = t.column("want")[0].as_py()
    return pa.Table.from_pylist([{**_piece(t), "used": used, "begin": sweep(faults(rows, again), used)[0]}], schema=_schema(VECTORS))


def _state_map(t: pa.Table) -> pa.Table:
    rows, again = _live_rows(t)
    steps = faults(rows, again)
    costs = sweep(steps, t.column("want")[0].as_py())
    ends = [trace(steps, costs, q, False)[1] for q in range(4)]
    return pa.Table.from_pylist([{**_piece(t), "ends": ends}], schema=_schema("conv_id bigint, piece bigint, ends array<int>"))


def _chain(t: pa.Table) -> pa.Table:
    """The state that each piece of a conversation starts in."""
    t = t.sort_by("piece")
    state, states = START, []
    for ends in t.column("ends").to_pylist():
        states.append(state)
        state = ends[state]
    return pa.table({"piece": t.column("piece"), "state": pa.array(states, pa.int32())})


EDITS = "conv_id bigint, pos bigint, k int, edit string, turn bigint, role string, text string"


def _edits(t: pa.Table) -> pa.Table:
    """The edits of one piece, in order of ``pos`` and ``k``."""
    rows, again = _live_rows(t)
    steps = faults(rows, again)
    state, last, conv_id = t.column("state")[0].as_py(), t.column("last")[0].as_py(), t.column("conv_id")[0].as_py()
    end = max(t.column("pos").to_pylist())
    found, _ = trace(steps, sweep(steps, t.column("want")[0].as_py()), state, last)
    out = [{"conv_id": conv_id, "pos": rows[i][0] if i < len(rows) else end, "k": k, "edit": edit,
            "turn": None if edit == "I" else rows[i][1], "role": role, "text": text}
           for k, (edit, i, role, text) in enumerate(edited(found, [r[2] for r in rows], [r[3] for r in rows]))]
    return pa.Table.from_pylist(out, schema=_schema(EDITS))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation, from edits sorted by it and their order."""
    names = ["conv_id", "audit", "repaired_sha256"]
    conv_id, digest, audit, lines, started = None, hashlib.sha256(), [], 0, False

    def row():
        return pa.RecordBatch.from_arrays([pa.array([conv_id], pa.int64()), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=names)

    for b in batches:
        for c, edit, role, text in zip(*[b.column(n).to_pylist() for n in ("conv_id", "edit", "role", "text")], strict=True):
            if started and c != conv_id:
                yield row()
                digest, audit, lines = hashlib.sha256(), [], 0
            started, conv_id = True, c
            audit.append(edit)
            if edit != "D":
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
                lines += 1
    if started:
        yield row()


def _shape(v: Column) -> Column:
    return F.transform(v, lambda x: x - F.array_min(v))


def _converged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every piece's counts, and its vectors once all end vectors differ from the true ones by constants."""
    spark = rows.sparkSession
    info = materialize(rows.groupBy("piece").applyInArrow(_speculate, PIECES), "pieces")
    vectors, old = info.select("conv_id", "piece", "used", "begin"), None
    order = Window.partitionBy("conv_id").orderBy("piece")
    terminal = F.array(*[F.lit(c).cast("long") for c in TERMINAL])
    while True:
        wanted = (vectors.withColumn("next", F.lead("begin").over(order))
                  .withColumn("last", F.col("next").isNull()).withColumn("want", F.coalesce("next", terminal)).drop("next")
                  .withColumn("stale", _shape(F.col("want")) != _shape(F.col("used"))))
        wanted = materialize(wanted, "piece_vectors")
        if old is not None:
            delete_path(spark, old._tallow_path)
        stale = wanted.where("stale").select("piece", "want")
        if stale.isEmpty():
            return info, wanted
        fixed = rows.join(stale, "piece").groupBy("piece").applyInArrow(_again, VECTORS)
        vectors = wanted.where("NOT stale").select("conv_id", "piece", "used", "begin").union(fixed)
        old = wanted


def _open_edits(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """The edits of all open conversations."""
    wanted = rows.join(vectors.select("piece", "want", "last"), "piece")
    maps = wanted.groupBy("piece").applyInArrow(_state_map, "conv_id bigint, piece bigint, ends array<int>")
    states = maps.groupBy("conv_id").applyInArrow(_chain, "piece bigint, state int")
    return wanted.join(states, "piece").groupBy("piece").applyInArrow(_edits, EDITS)


def _open_reports(info: DataFrame, vectors: DataFrame, edits: DataFrame) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("piece")
    sums = info.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "distinct")], F.min("low").alias("low"), F.max("high").alias("high"))
    # Neighbouring rows and equal turns of different pieces.
    joints = (info.where("n > 0").withColumn("pair", F.concat(F.lag("last_initial").over(order), "first_initial"))
              .groupBy("conv_id").agg(F.count_if(~F.col("pair").isin(*LEGAL)).alias("illegal_joints")))
    shared = (info.where("low IS NOT NULL").withColumn("before", F.lag("high").over(order))
              .groupBy("conv_id").agg(F.count_if(F.col("before") == F.col("low")).alias("shared")))
    cost = vectors.groupBy("conv_id").agg(
        (F.min_by(F.col("begin")[START], "piece") + F.sum(F.array_min("want") - F.array_min("used"))).alias("cost"))
    digests = edits.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "k").mapInArrow(
        _digests, "conv_id bigint, audit string, repaired_sha256 string")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    out = sums.withColumn("key", key)
    for part in (joints, shared, cost, digests):
        out = out.join(part.withColumn("key", key).drop("conv_id"), "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "conv_id", F.when(F.col("low").isNull(), F.lit(0)).otherwise(
            F.col("high") - F.col("low") + 1 - (F.col("distinct") - zero("shared"))).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", (F.col("illegal") + zero("illegal_joints")).alias("illegal"), zero("cost").alias("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _open_rows(walked: DataFrame) -> DataFrame:
    """The rows of open pieces, with ``again``: the conversation had the row's role and text before."""
    rows = walked.where(F.col("kind") == OPEN).select("conv_id", "piece", "pos", "turn", "role", "text", "live", "is_blank", "is_cut")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = (rows.where("live").withColumn("same", same).groupBy("conv_id", "same").agg(F.min("pos").alias("pos"))
             .select("pos", F.lit(False).alias("again")))
    return rows.join(first, "pos", "left").withColumn("again", F.coalesce("again", F.lit(True)))


def _run(conversations: DataFrame, live: Column, turns: bool) -> DataFrame:
    spark = conversations.sparkSession
    bounded_batches(spark)
    walked = materialize(_prepared(conversations, live).mapInArrow(_walk(turns), WALK), "walked")
    report = ["conv_id", *[c.split()[0] for c in REPORT.split(", ")]]
    rows = materialize(_open_rows(walked), "open_rows")
    info, vectors = _converged(rows)
    edits = _open_edits(rows, vectors)
    if turns:
        of_edits = ["conv_id", "pos", "k", "edit", "turn", "role", "text"]
        out = walked.where(F.col("kind") == TURN).select(of_edits).union(edits.where("edit <> 'D'").select(of_edits))
    else:
        out = walked.where(F.col("kind") == SOLVED).select(report).union(_open_reports(info, vectors, edits).select(report))
    out = materialize(out, "repaired")
    for t in (walked, rows, info, vectors):
        delete_path(spark, t._tallow_path)
    return out


def repaired_turns(conversations: DataFrame, live: Column | None = None) -> DataFrame:
    """The repaired turns: ``conv_id, pos, k, edit, turn, role, text``, in order of ``pos, k``.

    ``edit`` is K, R or I; inserted turns have no ``turn``. Rows where ``live``
    (a condition on the input) is not true are left out.
    """
    return _run(conversations, F.lit(True) if live is None else live, True)


def repair_report(conversations: DataFrame, live: Column | None = None) -> DataFrame:
    """One row per ``conv_id``, also where no row is ``live``: faults, cost, audit and digest."""
    return _run(conversations, F.lit(True) if live is None else live, False)


# ---------------------------------------------------------------- damage

def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the damage of the test query; ``live`` is false for dropped rows."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                                (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("harm"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("harm") != 0).alias("live"), F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def damage_report(conversations: DataFrame) -> DataFrame:
    """:func:`repair_report` of the damaged table."""
    return repair_report(damaged(conversations), F.col("live"))
