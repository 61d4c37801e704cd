"""Conversation repair by a rank-convergence parallel Viterbi.

A conversation's rows, in order of turn, are edited at least cost until the
initials of their roles read ``(s?(ua)+)?``: Keep 0, Rerole to user or
assistant 1, Delete 2 (the only edit of a blank or repeated row), Insert an
empty user or assistant row 5; a truncated row that stays adds 5.  Four states
(nothing yet, after s, after u, after a) and min-plus steps per row.

1. Rows are reduced to slim facts (the text to its SHA-256 and a few flags).
   Equal rows of one turn collapse to one with a number of copies, and the
   first of all equal rows of a conversation is found by partial minima, so no
   hot text or hot conversation is gathered.
2. The facts are sorted by range (conversation, turn): a conversation that is
   a third of the table lies over many tasks.  Each task cuts its rows into
   pieces of at most ``CHUNK`` rows: one byte a row.
3. Backward costs of all pieces are swept side by side.  A piece that does not
   end its conversation starts from a speculative vector (all states alike).
   Fix-up passes give it the true vector of the piece behind it, up to a
   constant, and sweep it and the old vector until both differ by a constant
   only; from there on the old result holds.  Passes end when no vector
   changes; the costs are stitched from the constants.  Rows whose two
   alternating readings cost alike never make vectors converge: what is still
   wrong after ``PASSES`` passes gets one more, in which the pieces of those
   conversations are swept from each single state; that tells their left
   vector for any right one, and the vectors are chained exactly.
4. Tracing goes forward along the stitched costs and takes the ASCII-least
   letter that stays optimal.  Which state follows is fixed by the letters
   taken, so a piece is traced for the four states it may be entered in, the
   entries of a conversation's pieces are chained, and one trace is kept.

A driver sees one row count a pass.  One task sees, at once, a slice of pieces;
a conversation's list of pieces (one short row per ``CHUNK`` rows) is streamed.
Only the repaired text of one conversation is one stream, as its hash is.

Defined cases: null conv_id is a conversation of its own, null turns come
first, null role and text are one space; rows of one turn are ordered by role,
then by SHA-256 of the text; a role without an initial s, u or a can only be
reroled or deleted; repeated rows are duplicates; empty and very long texts
are as other texts; an empty table gives no rows; extra columns do no harm."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growlytics.llm.common import by_value, pick, small, staged

by_value(__name__)
CHUNK, ROWS, PASSES = 4096, 1 << 17, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NONE, S, U, A = range(4)
_FAR = 1 << 40
#: The next state by an inserted or reroled row, and by a kept s, u, a or other row.
_MADE = np.array([U, U, A, U])
_KEPT = np.array([[S, U, -1, -1], [-1, U, -1, -1], [-1, -1, A, -1], [-1, U, -1, -1]])
_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
WHITE = " \t\n\x0b\f\r"


def _steps() -> np.ndarray:
    """Cost from state i before a row of a class to state j behind it, with
    any insertions before the row.  Class 0 must go; class 1 + 2 * role +
    truncated may stay."""
    out = np.full((9, 4, 4), _FAR, np.int64)
    for c in range(9):
        for i in range(4):
            at, cost = i, 0
            for _ in range(4):
                moves = [(at, DELETE)]
                if c:
                    role, cut = divmod(c - 1, 2)
                    moves.append((_MADE[at], REROLE + cut * TRUNCATED))
                    if _KEPT[at, role] >= 0:
                        moves.append((_KEPT[at, role], KEEP + cut * TRUNCATED))
                for j, x in moves:
                    out[c, i, j] = min(out[c, i, j], cost + x)
                at, cost = _MADE[at], cost + INSERT
    return out


_STEP = _steps()


# ------------------------------------------------------------------- facts


def facts(rows: DataFrame) -> DataFrame:
    """Slim rows: conv, has_conv, turn, has_turn, role, digest, m (copies),
    fault (0, 1 truncated, 2 blank)."""
    end = F.rtrim("text", F.lit(WHITE))
    fault = F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    return rows.select("conv", "has_conv", "turn", "has_turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "m", fault.alias("fault"))


def rows_of(conversations: DataFrame) -> DataFrame:
    """Conversations without nulls: what was null is marked, m = 1."""
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    return rows.select(F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce("turn", F.lit(0)).alias("turn"),
                       F.col("turn").isNotNull().alias("has_turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("m"))


CONV, TURN = ["has_conv", "conv"], ["has_turn", "turn", "role", "digest"]
PIECE = ("has_conv boolean, conv long, part int, seq int, lo boolean, ro boolean, codes binary, copies array<long>, has_turn boolean, turn long, role string, digest binary, "
         "blank long, duplicate long, truncated long, illegal long, first_role int, last_role int, turns long, first_turn long, last_turn long")


def _pieces(chunk: int):
    """Sorted slim rows to pieces; ``lo``, ``ro``: the conversation may go on
    before, behind the piece."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(PIECE))

    def made(f, cuts, lo, seq, ends):
        import pandas as pd

        m, role, fault, seen = (f[c].to_numpy() for c in ("m", "role_no", "fault", "again"))
        head, last = cuts[:-1], cuts[1:] - 1
        blank, again = fault == 2, (fault < 2) & seen
        cut = (fault == 1) & ~seen
        code = np.where(blank | again, 0, 1 + 2 * role + (fault == 1)).astype(np.uint8)
        total = lambda x: np.add.reduceat(x.astype(np.int64), head)
        turn = np.where(f["has_turn"], f["turn"], 0)
        known = f["has_turn"].to_numpy(bool)
        new = known.copy()
        new[1:] &= ~known[:-1] | (turn[1:] != turn[:-1])
        new[head] = known[head]
        pair = np.zeros(len(f), bool)  # an illegal pair with the row before
        pair[1:] = ~((role[1:] == 1) & ((role[:-1] == 0) | (role[:-1] == 2)) | (role[1:] == 2) & (role[:-1] == 1))
        pair[head] = False
        def of(name, at):
            return f[name].to_numpy()[at]
        some = known[last]  # nulls come first: a piece has a known turn if its last row has
        first_known = head + total(~known)
        raw = code.tobytes()
        return pd.DataFrame({
            "has_conv": of("has_conv", head), "conv": of("conv", head), "part": of("part", head).astype(np.int32), "seq": np.arange(seq, seq + len(head), dtype=np.int32),
            "lo": lo, "ro": ends, "codes": [raw[a:b] for a, b in zip(head, cuts[1:])], "copies": [m[a:b] for a, b in zip(head, cuts[1:])],
            "has_turn": of("has_turn", head), "turn": of("turn", head), "role": of("role", head), "digest": of("digest", head),
            "blank": total(np.where(blank, m, 0)), "duplicate": total(np.where(blank, 0, np.where(again, m, m - 1))), "truncated": total(cut),
            "illegal": total(pair) + total(m - 1), "first_role": role[head].astype(np.int32), "last_role": role[last].astype(np.int32), "turns": total(new),
            "first_turn": pd.array(np.where(some, turn[np.minimum(first_known, last)], 0), "Int64").astype(object), "last_turn": pd.array(turn[last], "Int64").astype(object)}
        ).assign(first_turn=lambda d: d["first_turn"].where(some, None), last_turn=lambda d: d["last_turn"].where(some, None))

    def run(batches):
        import pandas as pd
        import pyarrow as pa

        held, inside, seq = None, True, 0  # inside: the held rows' conversation may have begun before

        def cut(f, final):
            nonlocal held, inside, seq
            conv, has = f["conv"].to_numpy(), f["has_conv"].to_numpy(bool)
            runs = np.concatenate([[0], np.flatnonzero((conv[1:] != conv[:-1]) | (has[1:] != has[:-1])) + 1, [len(f)]])
            starts = np.concatenate([np.arange(a, b, chunk) for a, b in zip(runs, runs[1:])])
            cuts = np.append(starts, len(f)) if final else starts
            fresh = np.isin(starts, runs[1:-1])
            lo = ~fresh
            lo[0] = inside
            if not final:
                held, inside = f.iloc[starts[-1]:], bool(lo[-1])
            n = len(cuts) - 1
            if n:
                ends = np.append(lo[1:], True)[:n]
                out = made(f.iloc[:cuts[-1]], cuts, lo[:n], seq, ends)
                seq += n
                return pa.RecordBatch.from_pandas(out, schema, preserve_index=False)

        for b in batches:
            f = b.to_pandas()
            if held is not None:
                f = pd.concat([held, f], ignore_index=True)
            if len(f) and (out := cut(f, False)) is not None:
                yield out
        if held is not None and len(held):
            yield cut(held.reset_index(drop=True), True)

    return run


def pieces(slim: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The encoded pieces of a table of :func:`facts`."""
    at = F.min(F.struct("has_turn", "turn")).alias("at")
    firsts = slim.groupBy(*CONV, "role", "digest").agg(at).select(*CONV, "at.has_turn", "at.turn", "role", "digest", F.lit(0).cast("long").alias("m"), F.lit(0).alias("fault"), F.lit(False).alias("again"))
    rows = slim.withColumn("again", F.lit(True)).unionByName(firsts)
    # a turn's equal rows are one; it is the first of its kind if a minimum fell on it
    rows = rows.groupBy(*CONV, *TURN).agg(F.sum("m").alias("m"), F.max("fault").alias("fault"), F.min("again").alias("again"))
    initial = F.left("role", F.lit(1))
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    rows = rows.orderBy(*CONV, *TURN).select(*CONV, *TURN, "m", "fault", "again", number.alias("role_no"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(_pieces(chunk), PIECE)


# ------------------------------------------------------------------- costs


def _flat(codes, copies):
    size = np.array([len(c) for c in codes], np.int64)
    m = np.concatenate([np.asarray(c, np.int64) for c in copies]) if len(size) else np.empty(0, np.int64)
    return np.frombuffer(b"".join(codes), np.uint8), m, np.concatenate([[0], np.cumsum(size)])[:-1], size


def _swept(code, m, begin, size, right, old=None):
    """Cost vectors at the left ends from those at the right ends.  With
    ``old`` (right, left) of an earlier sweep, a piece stops where its vector
    differs from the old one by a constant."""
    v = right.copy()
    w = None if old is None else old[0].copy()
    live, t = np.arange(len(size)), 0
    while True:
        live = live[size[live] > t] if old is None else live
        if old is not None:
            apart = v[live] - w[live]
            alike = (apart == apart[:, :1]).all(1)
            done = live[alike]
            v[done] = old[1][done] + apart[alike]
            live = live[~alike]
            live = live[size[live] > t]
        if not len(live):
            return v
        at = begin[live] + size[live] - 1 - t
        step, more = _STEP[code[at]], DELETE * (m[at] - 1)[:, None]
        v[live] = (step + v[live][:, None, :]).min(2) + more
        if w is not None:
            w[live] = (step + w[live][:, None, :]).min(2) + more
        t += 1


def _costs(code, m, begin, size, right):
    """The cost vectors before and behind every row."""
    here, behind = np.empty((len(code), 4), np.int64), np.empty((len(code), 4), np.int64)
    v, live, t = right.copy(), np.arange(len(size)), 0
    while len(live := live[size[live] > t]):
        at = begin[live] + size[live] - 1 - t
        behind[at] = v[live]
        v[live] = here[at] = (_STEP[code[at]] + v[live][:, None, :]).min(2) + DELETE * (m[at] - 1)[:, None]
        t += 1
    return here, behind, v


def _traced(code, m, begin, size, here, behind, state):
    """Letters of the least audits for each entry state (n, E), and the
    states at the right ends."""
    state = state.copy()
    n, e = state.shape
    out = np.zeros((len(code), e, 5), np.uint8)
    live, t = np.arange(n), 0
    while len(live := live[size[live] > t]):
        at = begin[live] + t
        s, h, b = state[live], here[at] - DELETE * (m[at] - 1)[:, None], behind[at]
        pick = lambda x, k: np.take_along_axis(x, k, 1)
        for slot in range(3):
            more = (pick(b, s) + DELETE != pick(h, s)) & (pick(h, _MADE[s]) + INSERT == pick(h, s))
            out[at, :, slot] = np.where(more, ord("I"), 0)
            s = np.where(more, _MADE[s], s)
        c = code[at].astype(np.int64)
        role, cut = (np.maximum(c, 1) - 1) // 2, (np.maximum(c, 1) - 1) % 2 * TRUNCATED
        kept = _KEPT[s, role[:, None]]
        delete = pick(b, s) + DELETE == pick(h, s)
        keep = ~delete & (c > 0)[:, None] & (kept >= 0) & (pick(b, np.maximum(kept, 0)) + KEEP + cut[:, None] == pick(h, s))
        out[at, :, 3] = np.where(delete, ord("D"), np.where(keep, ord("K"), ord("R")))
        out[at, :, 4] = (m[at] > 1)[:, None]
        state[live] = np.where(delete, s, np.where(keep, kept, _MADE[s]))
        t += 1
    return out, state


def _spelt(letters: np.ndarray, m: np.ndarray) -> str:
    """The letters of one trace; the further copies of a row are deleted."""
    text = letters.tobytes().replace(b"\0", b"").decode("ascii")
    if "\1" not in text:
        return text
    parts = text.split("\1")
    return parts[0] + "".join("D" * (x - 1) + p for x, p in zip(m[m > 1].tolist(), parts[1:]))


def _slices(size):
    lo = total = 0
    for i, n in enumerate(size):
        if total + n > ROWS and i > lo:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(size):
        yield lo, len(size)


def _sweeping(again: bool):
    """codes, copies, right (and old_right, old_left) to left."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            f = {c: b.column(c).to_pylist() for c in ("codes", "copies", "right", *(["old_right", "old_left"] if again else []))}
            left = []
            for lo, hi in _slices([len(c) for c in f["codes"]]):
                vector = lambda c: np.array(f[c][lo:hi], np.int64)  # noqa: E731, B023
                old = (vector("old_right"), vector("old_left")) if again else None
                left += _swept(*_flat(f["codes"][lo:hi], f["copies"][lo:hi]), vector("right"), old).tolist()
            names = ["part", "seq"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(left, pa.list_(pa.int64()))], [*names, "left"])

    return run


SWEPT, STATE = "part int, seq int, left array<long>", ["part", "seq", *CONV, "idx", "last", "right", "left"]


def _vector(x) -> F.Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in x])


def stitched(cut: DataFrame) -> tuple[DataFrame, int]:
    """For pieces whose conversation may have others (``lo`` or ``ro``): their
    place, and the cost vectors at both ends, each true up to a constant.  And
    the number of fix-up passes."""
    open_ = staged(cut.where("lo or ro").select("part", "seq", *CONV, "codes", "copies", "first_role", "last_role", "first_turn", "last_turn"), "turns-open")
    line = Window.partitionBy(*CONV).orderBy("part", "seq")
    state = open_.select("part", "seq", *CONV, F.row_number().over(line).alias("idx"), F.lead("seq").over(line).isNull().alias("last"))
    state = state.withColumn("right", F.when(F.col("last"), _vector(_END)).otherwise(_vector([0] * 4)))
    state = staged(state, "turns-guess")
    body = open_.select("part", "seq", "codes", "copies")
    swept = body.join(small(state.select("part", "seq", "right")), ["part", "seq"]).mapInArrow(_sweeping(False), SWEPT)
    state = staged(state.join(swept, ["part", "seq"]).select(*STATE), "turns-swept")
    order, passes = Window.partitionBy(*CONV).orderBy("idx"), 0
    while True:
        behind = F.lead("left").over(order)
        true = F.when(F.col("last"), F.col("right")).otherwise(F.transform(behind, lambda x: x - F.array_min(behind)))
        state = staged(state.withColumn("fitting", true), "turns-true")
        wrong = state.where("fitting <> right")
        if wrong.isEmpty():
            return state.drop("fitting"), passes
        passes += 1
        if passes > PASSES:
            return _linked(body, state.drop("fitting"), wrong), passes
        redo = wrong.select("part", "seq", F.col("fitting").alias("right"), F.col("right").alias("old_right"), F.col("left").alias("old_left"))
        swept = body.join(small(staged(redo, "turns-redo")), ["part", "seq"]).mapInArrow(_sweeping(True), SWEPT)
        state = state.withColumnsRenamed({"left": "old", "right": "was"}).join(swept, ["part", "seq"], "left")
        state = staged(state.select("part", "seq", *CONV, "idx", "last", F.col("fitting").alias("right"), F.coalesce("left", "old").alias("left")), "turns-fixed")


def _single(batches):
    """codes, copies to the left vectors from each single state on the right."""
    import pyarrow as pa

    for b in batches:
        codes, copies = b.column("codes").to_pylist(), b.column("copies").to_pylist()
        left = []
        for lo, hi in _slices([len(c) for c in codes]):
            flat = _flat(codes[lo:hi], copies[lo:hi])
            alone = [_swept(*flat, np.tile(np.where(np.arange(4) == j, 0, _FAR), (hi - lo, 1))) for j in range(4)]
            left += np.concatenate(alone, axis=1).tolist()
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("seq"), pa.array(left, pa.list_(pa.int64()))], ["part", "seq", "left"])


def _chain(batches):
    """Pieces of a conversation from its end: right and left vectors."""
    import pyarrow as pa

    right = None
    for b in batches:
        out = []
        for last, moves in zip(b.column("last").to_pylist(), b.column("moves").to_pylist()):
            right = _END if last else left - left.min()  # noqa: F821
            left = (right[:, None] + np.array(moves, np.int64).reshape(4, 4)).min(0)
            out.append((right.tolist(), left.tolist()))
        vectors = [pa.array([x[i] for x in out], pa.list_(pa.int64())) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("seq"), *vectors], ["part", "seq", "right", "left"])


def _linked(body: DataFrame, state: DataFrame, wrong: DataFrame) -> DataFrame:
    """The state with the conversations of ``wrong`` chained exactly."""
    which = small(staged(wrong.select(*CONV).distinct().withColumn("again", F.lit(True)), "turns-unsettled"))
    state = staged(state.join(which, CONV, "left"), "turns-marked")
    todo = state.where("again").select("part", "seq", *CONV, "idx", "last")
    moves = body.join(small(staged(todo.select("part", "seq"), "turns-todo")), ["part", "seq"]).mapInArrow(_single, SWEPT).withColumnRenamed("left", "moves")
    line = todo.join(moves, ["part", "seq"]).repartition(*CONV).sortWithinPartitions(*CONV, F.desc("idx"))
    done = line.select("part", "seq", "last", "moves").mapInArrow(_chain, "part int, seq int, right array<long>, left array<long>")
    done = state.where("again").drop("right", "left").join(done, ["part", "seq"]).select(*STATE)
    return staged(state.where("again IS NULL").select(*STATE).unionByName(done), "turns-linked")


# ------------------------------------------------------------------ traces


def _tracing(batches):
    """part, seq, cost, exits, audits of each piece (for every entry state if
    its first row is not the conversation's first)."""
    import pyarrow as pa

    for b in batches:
        f = {c: b.column(c).to_pylist() for c in ("codes", "copies", "right", "first", "last")}
        cost, exits, audits = [], [], []
        for lo, hi in _slices([len(c) for c in f["codes"]]):
            code, m, begin, size = _flat(f["codes"][lo:hi], f["copies"][lo:hi])
            here, behind, left = _costs(code, m, begin, size, np.array(f["right"][lo:hi], np.int64))
            first, last = f["first"][lo:hi], f["last"][lo:hi]
            entry = np.tile(np.arange(4), (hi - lo, 1)) if not all(first) else np.zeros((hi - lo, 1), np.int64)
            letters, state = _traced(code, m, begin, size, here, behind, entry)
            for i, (a, n) in enumerate(zip(begin.tolist(), size.tolist())):
                many = range(1 if first[i] else 4)
                cost.append(int(left[i, NONE] if first[i] else left[i].min()))
                ends = ["I" * (int(_END[state[i, e]]) // INSERT) if last[i] else "" for e in many]
                exits.append([int(state[i, e]) for e in many])
                audits.append([_spelt(letters[a:a + n, e], m[a:a + n]) + ends[e] for e in many])
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("seq"), pa.array(cost, pa.int64()), pa.array(exits, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
                                         ["part", "seq", "cost", "exits", "audits"])


def _chained(batches):
    """Pieces in order of conversation and place: the state each is entered in."""
    import pyarrow as pa

    at, state = None, 0
    for b in batches:
        entry = []
        for conv, exits in zip(zip(b.column("has_conv").to_pylist(), b.column("conv").to_pylist()), b.column("exits").to_pylist()):
            if conv != at:
                at, state = conv, 0
            entry.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("seq"), pa.array(entry, pa.int32())], ["part", "seq", "entry"])


def traced(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The pieces of all conversations with ``entry`` and ``audit``, their
    share of the cost, and what their borders add to the counts."""
    cut = staged(pieces(staged(facts(rows), "turns-facts"), chunk), "turns-pieces")
    state, _ = stitched(cut)
    place = state.select("part", "seq", "idx", "last", "right")
    whole = cut.join(small(staged(place, "turns-place")), ["part", "seq"], "left")
    whole = whole.withColumns({"idx": F.coalesce("idx", F.lit(1)), "last": F.coalesce("last", F.lit(True)), "right": F.coalesce("right", _vector(_END))})
    got = whole.select("part", "seq", "codes", "copies", "right", (F.col("idx") == 1).alias("first"), "last").mapInArrow(
        _tracing, "part int, seq int, cost long, exits array<int>, audits array<string>")
    got = staged(got, "turns-traces")
    chain = state.select("part", "seq", *CONV, "idx").join(got.select("part", "seq", "exits"), ["part", "seq"])
    chain = chain.repartition(*CONV).sortWithinPartitions(*CONV, "idx").select("part", "seq", *CONV, "exits")
    entry = staged(chain.mapInArrow(_chained, "part int, seq int, entry int"), "turns-entries")
    # what a border between two pieces of a conversation adds
    line = Window.partitionBy(*CONV).orderBy("part", "seq")
    border = cut.where("lo or ro").select("part", "seq", (F.lag("last_turn").over(line) == F.col("first_turn")).alias("same"), F.lag("last_role").over(line).alias("r"), "first_role")
    legal = ((F.col("first_role") == 1) & F.col("r").isin(0, 2)) | ((F.col("first_role") == 2) & (F.col("r") == 1))
    border = border.select("part", "seq", F.coalesce(F.col("same").cast("long"), F.lit(0)).alias("same_turn"), F.when(F.col("r").isNull() | legal, 0).otherwise(1).alias("bad_border"))
    out = cut.drop("codes", "copies").join(got, ["part", "seq"]).join(small(entry), ["part", "seq"], "left").join(small(staged(border, "turns-borders")), ["part", "seq"], "left")
    out = out.withColumn("entry", F.coalesce("entry", F.lit(0)))
    audit = F.get("audits", F.when(F.size("audits") > 1, F.col("entry")).otherwise(0))
    return staged(out.withColumn("audit", audit).drop("audits", "exits"), "turns-audits")


def _conv_id():
    return F.when(F.col("has_conv"), F.col("conv")).alias("conv_id")


def report(pieces_: DataFrame) -> DataFrame:
    """Per conversation of :func:`traced` pieces: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit."""
    per = pieces_.groupBy(*CONV).agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")], F.sum(F.col("illegal") + F.coalesce("bad_border", F.lit(0))).alias("illegal"),
        (F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - F.coalesce("same_turn", F.lit(0)))).alias("gaps"),
        F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))).alias("a"))
    return per.select(_conv_id(), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", F.array_join("a.audit", "").alias("audit"))


def _applied(batches):
    """Sorted pieces and texts of whole conversations to the repaired rows."""
    import pyarrow as pa

    names = {U: "user", A: "assistant"}
    at, state, audit, p, pos = None, 0, "", 0, 0
    for b in batches:
        out = []

        def put(role, text):
            nonlocal pos
            out.append((*at, pos, role, text))
            pos += 1

        def inserted():
            nonlocal p, state
            while p < len(audit) and audit[p] == "I":
                p, state = p + 1, int(_MADE[state])
                put(names[state], "")

        for has, conv, role, text, m, edits, entry in zip(*[b.column(c).to_pylist() for c in ("has_conv", "conv", "role", "text", "m", "audit", "entry")]):
            if edits is not None:
                if at is not None:
                    inserted()
                if at != (has, conv):
                    at, pos = (has, conv), 0
                audit, p, state = edits, 0, entry
                if text is None:
                    continue
            for _ in range(m):
                inserted()
                edit, p = audit[p], p + 1
                if edit == "K":
                    state = int(_KEPT[state, "sua".index(role[0])])
                    put(role, text)
                elif edit == "R":
                    state = int(_MADE[state])
                    put(names[state], text)
        yield _batch(out, pa)
    if at is not None:
        out = []
        while p < len(audit) and audit[p] == "I":
            p, state = p + 1, int(_MADE[state])
            out.append((*at, pos, names[state], ""))
            pos += 1
        yield _batch(out, pa)


def _batch(out, pa):
    cols = list(zip(*out)) if out else [[]] * 5
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["has_conv", "conv", "pos", "role", "text"])


def repaired(rows: DataFrame, pieces_: DataFrame) -> DataFrame:
    """The repaired conversations: has_conv, conv, pos, role, text; each
    conversation lies in one partition, in order."""
    texts = rows.select(*CONV, "has_turn", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(1).alias("kind"), "text", "m", F.lit(None).cast("string").alias("audit"), F.lit(0).alias("entry"))
    edits = pieces_.select(*CONV, *TURN, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("m"), "audit", "entry")
    both = texts.unionByName(edits).repartition(*CONV).sortWithinPartitions(*CONV, *TURN, "kind")
    return both.select(*CONV, "role", "text", "m", "audit", "entry").mapInArrow(_applied, "has_conv boolean, conv long, pos long, role string, text string")


def _hashing(batches):
    import hashlib

    import pyarrow as pa

    at, h = None, None
    for b in batches:
        done = []
        for has, conv, role, text in zip(*[b.column(c).to_pylist() for c in ("has_conv", "conv", "role", "text")]):
            if at != (has, conv):
                if at is not None:
                    done.append((*at, h.hexdigest()))
                at, h = (has, conv), hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(f"{role}:{text}".encode())
        yield _digests(done, pa)
    if at is not None:
        yield _digests([(*at, h.hexdigest())], pa)


def _digests(done, pa):
    cols = list(zip(*done)) if done else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.bool_(), pa.int64(), pa.string()))], ["has_conv", "conv", "repaired_sha256"])


# ------------------------------------------------------------------ damage


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`rows_of` with faults by crc32 of ``conv_id:turn`` mod 20."""
    name = F.concat_ws(":", F.when(F.col("has_conv"), F.col("conv").cast("string")).otherwise(" "), F.when(F.col("has_turn"), F.col("turn").cast("string")).otherwise(" "))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return rows.where(kind != 0).select("conv", "has_conv", "turn", "has_turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("m"))


def digests(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Damage, repair and digest of every conversation of the table."""
    rows = rows_of(conversations)
    broken = damaged(rows)
    done = traced(broken, chunk)
    hashes = repaired(broken, done).mapInArrow(_hashing, "has_conv boolean, conv long, repaired_sha256 string")
    hashes = hashes.select(_conv_id(), "repaired_sha256")
    ids = rows.select(_conv_id()).distinct()

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "its")
        return left.join(right, left["conv_id"].eqNullSafe(right["its"]), "left").drop("its")

    out = beside(beside(ids, report(done)), hashes)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
