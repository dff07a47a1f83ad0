"""Repair of conversation structure by least-cost edits, found on a tight-arc DAG.

A repaired conversation's roles read ``(s?(ua)+)?`` by their initials.  Its nodes
are (rows consumed, state); the states are 0 nothing yet, 1 after the system
row, 2 after a user row, 3 after an assistant row.  Arcs are the edits: keep K,
rerole R to the role that the state wants, delete D, insert I of an empty row.

Minimum costs run forward from the start and backward from the end; an arc is
*tight* when both ends' costs and its own make up the total, so the tight arcs
are exactly those of the cheapest repairs.  A set of frontier nodes then walks
the tight arcs and takes the least edit letter that any of its nodes offers.

The rows are sorted once, over all conversations, and cut into pieces of at most
``2 ** PIECE_BITS`` rows, so a conversation of any length is worked on by many tasks.  A
piece of it is summed up as a matrix of costs from state to state; products of
these, a few numbers a piece, give each piece the costs that reach it from both
sides.  Then every piece walks once from each state it may be entered in, and
the states chain up.  Only the digest reads a conversation from its first to its
last row, as a stream, since a hash of its whole text asks for that.

Nulls: a null role or text is one space, a null conv_id is a conversation, rows
with a null turn stand first.  Rows of one turn stand in the order in which the
table is read.  A role is judged by its first character; where that is neither
s, u nor a (or there is none) the row can only be reroled or deleted.  Repeated
rows are duplicates.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consolida.llm.common import forget, materialise, rows_of

#: Rows of a piece: two to this power, and no more than one partition of the sorted table has.
PIECE_BITS = 15
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 60
STATES = 4
#: The state after the row that a state wants, and that row's initial.
NEXT = (2, 2, 3, 2)
WANTS = "uuau"
ROLES = {"u": "user", "a": "assistant"}
BLANKS = r"\x20\x09-\x0D"


# Rows and their faults -------------------------------------------------------------------------


def whole(conversations: DataFrame) -> DataFrame:
    """The four columns without nulls in role and text, and ``place``, the order in which the table is read."""
    space = F.lit(" ")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.monotonically_increasing_id().alias("place")
    )


def damaged(rows: DataFrame, outcomes: int = 20) -> DataFrame:
    """Damage by the CRC-32 of ``conv_id:turn``: 0 drops a row, 1 empties it, 2 takes its stops, 3 repeats it, 4 makes it the user's."""
    named = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    how = F.crc32(named.cast("binary")) % outcomes
    rows = rows.withColumn("_how", how).where("_how <> 0")
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_how") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "place", copies.alias("copy"))


def ordered(rows: DataFrame, piece_bits: int = PIECE_BITS) -> DataFrame:
    """All rows sorted by conversation and turn, stored with their position ``pos`` and ``piece``."""
    rows = rows if "copy" in rows.columns else rows.withColumn("copy", F.lit(0))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("place"), F.col("copy")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    return materialise(rows.select("conv_id", "turn", "role", "text", "pos", F.shiftright("pos", piece_bits).alias("piece")), "turns")


def _fault(text: Column) -> Column:
    return F.when(~text.rlike(f"[^{BLANKS}]"), "blank").when(~text.rlike(rf"[.!?][{BLANKS}]*\z"), "truncated")


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, piece, initial, fault) of sorted rows; a duplicate has role and text of an earlier row.

    Equal rows are found by their digest: one minimum a digest, combined before
    the shuffle, is joined back where it stands for several rows.
    """
    digest = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    light = rows.select("conv_id", "pos", "piece", F.substring("role", 1, 1).alias("initial"), digest.alias("digest"), _fault(F.col("text")).alias("fault"))
    first = light.groupBy("conv_id", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    met = light.join(first, light["conv_id"].eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    repeated = F.coalesce(F.col("pos") > F.col("first"), F.lit(False)) & ~F.coalesce(F.col("fault") == "blank", F.lit(False))
    return met.select("conv_id", "pos", "piece", "initial", F.when(repeated, "duplicate").otherwise(F.col("fault")).alias("fault"))


# Costs -----------------------------------------------------------------------------------------


def arcs(initial: str, fault: str | None, state: int) -> list[tuple[str, str, int, int]]:
    """(letter, initial of the row it leaves, cost, next state) of the edits of a row in a state."""
    out = [("D", "-", DELETE, state)]
    if fault in ("blank", "duplicate"):
        return out
    more = TRUNCATED if fault == "truncated" else 0
    if initial == "s" and state == 0:
        out.append(("K", "-", KEEP + more, 1))
    elif initial == WANTS[state]:
        out.append(("K", "-", KEEP + more, NEXT[state]))
    return [*out, ("R", WANTS[state], REROLE + more, NEXT[state])]


def _inserts() -> np.ndarray:
    """Cost from state to state by insertions alone."""
    out = np.full((STATES, STATES), FAR, np.int64)
    for state in range(STATES):
        at, cost = state, 0
        for _ in range(STATES):
            out[state, at] = min(out[state, at], cost)
            at, cost = NEXT[at], cost + INSERT
    return out


INSERTS = _inserts()
#: What it costs to end from a state by insertions alone.
END = np.minimum(INSERTS[:, 3], [0, FAR, FAR, FAR])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least costs over a state between: of matrices, or a vector and a matrix."""
    return np.minimum((a[..., :, None] + b).min(axis=-2), FAR)


class Steps(dict):
    """For an (initial, fault): the costs of its edits from state to state, after any insertions."""

    def __missing__(self, key: tuple) -> tuple[np.ndarray, np.ndarray]:
        edit = np.full((STATES, STATES), FAR, np.int64)
        for state in range(STATES):
            for _, _, cost, to in arcs(*key, state):
                edit[state, to] = min(edit[state, to], cost)
        out = self[key] = edit, product(INSERTS, edit)
        return out


def backward(steps: list[tuple], end: np.ndarray, known: Steps) -> list[np.ndarray]:
    """Before each row and after the last one, the least cost to the end from every state."""
    out = [end]
    for key in reversed(steps):
        out.append(product(known[key][1], out[-1][:, None])[:, 0])
    return out[::-1]


def forward(steps: list[tuple], start: np.ndarray, known: Steps) -> list[np.ndarray]:
    """Before each row and after the last one, the least cost from the start to every state, insertions there included."""
    out = [product(start, INSERTS)]
    for key in steps:
        out.append(product(product(out[-1], known[key][0]), INSERTS))
    return out


def walk(steps: list[tuple], fore: list[np.ndarray], back: list[np.ndarray], state: int, last: bool) -> tuple[list[str], set[int]]:
    """The least edits, two characters each, by row, and the states it ends in.

    The frontier holds the nodes that the letters so far lead to along tight
    arcs; of the letters that leave any of them the least is taken.  After the
    last row of a whole conversation its insertions join the last row's edits.
    """
    total = int((fore[0] + back[0]).min())
    out, frontier, k = [""], {state}, 0
    while True:
        offers: dict[str, set[tuple[int, int]]] = {}
        done = k == len(steps) and (not last or any(q in (0, 3) and back[k][q] == 0 for q in frontier))
        if done:
            break
        for q in frontier:
            here = int(fore[k][q])
            if here + INSERT + int(back[k][NEXT[q]]) == total:
                offers.setdefault("I" + WANTS[q], set()).add((k, NEXT[q]))
            if k < len(steps):
                for letter, role, cost, to in arcs(*steps[k], q):
                    if here + cost + int(back[k + 1][to]) == total:
                        offers.setdefault(letter + role, set()).add((k + 1, to))
        least = min(offers)
        nodes = offers[least]
        out[-1] += least
        at = next(iter(nodes))[0]
        if at > k and at < len(steps):
            out.append("")
        k, frontier = at, {q for _, q in nodes}
    return out, frontier


# Pieces ----------------------------------------------------------------------------------------


def _runs(table: pa.Table) -> Iterator[tuple[object, list[int], list[tuple]]]:
    """The conversations of a piece in order: id, positions and (initial, fault) of its rows."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("pos", "conv_id", "initial", "fault")), strict=True), key=lambda r: r[0])
    begin = 0
    for k in range(1, len(rows) + 1):
        if k == len(rows) or rows[k][1] != rows[begin][1]:
            yield rows[begin][1], [r[0] for r in rows[begin:k]], [r[2:] for r in rows[begin:k]]
            begin = k


def _edge_matrices(table: pa.Table) -> pa.Table:
    """Cost matrices of the first and the last conversation of a piece, which may go on in others."""
    runs, known = list(_runs(table)), Steps()
    ids, matrices = [], []
    for conv_id, _, steps in runs if len(runs) < 2 else (runs[0], runs[-1]):
        matrix = np.full((STATES, STATES), FAR, np.int64)
        np.fill_diagonal(matrix, 0)
        for key in steps:
            matrix = product(matrix, known[key][1])
        ids.append(conv_id)
        matrices.append(matrix.ravel().tolist())
    piece = table.column("piece")[0].as_py()
    return pa.table({"conv_id": pa.array(ids, table.schema.field("conv_id").type), "piece": [piece] * len(ids), "matrix": pa.array(matrices, pa.list_(pa.int64()))})


def _reached(table: pa.Table) -> pa.Table:
    """For each piece of a conversation the costs before it and after it, and whether it is the first or last."""
    rows = sorted(zip(table.column("piece").to_pylist(), table.column("matrix").to_pylist(), strict=True))
    matrices = [np.array(m, np.int64).reshape(STATES, STATES) for _, m in rows]
    fore = [np.array([0] + [FAR] * (STATES - 1), np.int64)]
    for m in matrices[:-1]:
        fore.append(product(fore[-1], m))
    back = [END]
    for m in matrices[:0:-1]:
        back.append(product(m, back[-1][:, None])[:, 0])
    n = len(rows)
    return pa.table(
        {
            "conv_id": table.column("conv_id").combine_chunks(),
            "piece": pa.array([p for p, _ in rows], pa.int64()),
            "fore": pa.array([x.tolist() for x in fore], pa.list_(pa.int64())),
            "back": pa.array([x.tolist() for x in back[::-1]], pa.list_(pa.int64())),
            "opens": [k == 0 for k in range(n)],
            "ends": [k == n - 1 for k in range(n)],
        }
    )


_PATHS = "piece long, pos long, paths array<string>, exits array<int>"
_PATHS_SCHEMA = pa.schema([("piece", pa.int64()), ("pos", pa.int64()), ("paths", pa.list_(pa.string())), ("exits", pa.list_(pa.int32()))])


def _paths(rows: pa.Table, edges: pa.Table) -> pa.Table:
    """The edits of each row, for every state its piece may be entered in; with ``pos`` null, the states it is left in.

    Conversations that begin in the piece are entered in state 0 alone.
    """
    piece, known = rows.column("piece")[0].as_py(), Steps()
    at = {r["conv_id"]: r for r in edges.to_pylist()}
    zero = np.array([0] + [FAR] * (STATES - 1), np.int64)
    out: list[tuple] = []
    for conv_id, positions, steps in _runs(rows):
        edge = at.get(conv_id)
        start, end, opens, ends = (np.array(edge["fore"]), np.array(edge["back"]), edge["opens"], edge["ends"]) if edge else (zero, END, True, True)
        fore, back = forward(steps, start, known), backward(steps, end, known)
        total = int((fore[0] + back[0]).min())
        by_state, exits = [], []
        for state in range(1 if opens else STATES):
            if int(start[state]) + int(back[0][state]) == total:
                path, left = walk(steps, fore, back, state, ends)
                by_state.append(path)
                exits.append(next(iter(left)))
            else:
                by_state.append(None)
                exits.append(-1)
        out += [(piece, pos, [p and p[k] for p in by_state], None) for k, pos in enumerate(positions)]
        if not ends:
            out.append((piece, None, None, exits))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PATHS_SCHEMA, strict=True)], schema=_PATHS_SCHEMA)


def _entered(table: pa.Table) -> pa.Table:
    """The state in which each piece of a conversation but the first is entered."""
    rows = sorted(zip(table.column("piece").to_pylist(), table.column("exits").to_pylist(), strict=True), key=lambda r: r[0])
    state, out = 0, []
    for k, (piece, exits) in enumerate(rows):
        if k:
            out.append((piece, state))
        if exits is not None:
            state = exits[state if k else 0]
    return pa.table({"piece": pa.array([p for p, _ in out], pa.int64()), "state": pa.array([s for _, s in out], pa.int32())})


def _chosen(light: DataFrame) -> DataFrame:
    """(pos, path): the edits of each row of the least cheapest repair, two characters each."""
    kind = light.schema["conv_id"].dataType.simpleString()
    edges = light.groupBy("piece").applyInArrow(_edge_matrices, f"conv_id {kind}, piece long, matrix array<long>")
    edges = materialise(edges, "edges")
    n = F.count("*").over(Window.partitionBy("conv_id"))  # a row or two a piece
    spans = edges.withColumn("n", n).where("n > 1").drop("n")
    reached = spans.groupBy("conv_id").applyInArrow(_reached, f"conv_id {kind}, piece long, fore array<long>, back array<long>, opens boolean, ends boolean")
    reached = materialise(reached, "reached")
    paths = light.groupBy("piece").cogroup(reached.groupBy("piece")).applyInArrow(_paths, _PATHS)
    paths = materialise(paths, "paths")
    exits = paths.where("pos is null").select("piece", F.col("exits").alias("left_in"))  # of the one conversation that goes on
    exits = reached.join(exits, "piece", "left").select("conv_id", "piece", F.when(~F.col("ends"), F.col("left_in")).alias("exits"))
    entered = materialise(exits.groupBy("conv_id").applyInArrow(_entered, "piece long, state int"), "entered")
    forget(edges)
    rows = paths.where("pos is not null").join(entered, "piece", "left")
    several = F.size("paths") > 1
    return rows.select("pos", F.when(several, F.element_at("paths", F.coalesce("state", F.lit(0)) + 1)).otherwise(F.col("paths")[0]).alias("path"))


# Repairs ---------------------------------------------------------------------------------------


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest repairs, edit by edit: (conv_id, pos, nth, edit, role, text, turn, initial, fault).

    ``rows`` come from ``ordered``.  Rows that are inserted have the position of
    the row that they stand beside and no fault; deleted rows are there, with
    their edit.  What is kept of a conversation, by (pos, nth), is its repair.
    """
    light = materialise(with_faults(rows), "faults")
    chosen = _chosen(light).withColumnRenamed("pos", "p")
    met = rows.drop("piece").join(light.select(F.col("pos").alias("q"), "initial", "fault"), F.col("pos") == F.col("q")).join(chosen, F.col("pos") == F.col("p"))
    pair = F.posexplode(F.expr("transform(sequence(1, length(path), 2), i -> substring(path, i, 2))")).alias("nth", "pair")
    met = met.select("conv_id", "pos", "role", "text", "turn", "initial", "fault", pair)
    edit, new = F.substring("pair", 1, 1), F.substring("pair", 2, 1)
    inserted = edit == "I"
    role = F.when(new == "u", ROLES["u"]).when(new == "a", ROLES["a"]).otherwise(F.col("role"))
    own = lambda c: F.when(~inserted, F.col(c)).alias(c)
    return met.select("conv_id", "pos", "nth", edit.alias("edit"), role.alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"), own("turn"), own("initial"), own("fault"))


_DIGEST = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = frozenset(("su", "ua", "au"))
_COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


class _Sum:
    """What the digest of one conversation needs, row after row."""

    def __init__(self, conv_id: object):
        self.conv_id, self.n, self.audit, self.hash = conv_id, dict.fromkeys(_DIGEST, 0), [], hashlib.sha256()
        self.first = self.turn = self.initial = None
        self.turns, self.any = 0, False

    def add(self, edit: str, role: str, text: str, turn: int | None, initial: str | None, fault: str | None) -> None:
        self.audit.append(edit)
        self.n["cost"] += _COSTS[edit] + (fault == "truncated" and edit != "D")
        if edit != "I":
            if fault:
                self.n[fault] += 1
            if self.initial is not None and self.initial + initial not in _LEGAL:
                self.n["illegal"] += 1
            self.initial = initial
            if turn is not None and turn != self.turn:
                self.first = turn if self.first is None else self.first
                self.turn, self.turns = turn, self.turns + 1
        if edit != "D":
            self.hash.update((("\n" if self.any else "") + role + ":" + text).encode())
            self.any = True

    def row(self) -> tuple:
        self.n["gaps"] = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, *self.n.values(), "".join(self.audit), self.hash.hexdigest())


def digest(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of the table."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    columns = ["conv_id", "edit", "role", "text", "turn", "initial", "fault"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, id_type = None, [], None

        def emitted() -> pa.RecordBatch:
            names = ["conv_id", *_DIGEST, "audit", "repaired_sha256"]
            types = [id_type, *[pa.int64()] * len(_DIGEST), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv_id, *row in rows_of([batch], *columns):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.row())
                    now = _Sum(conv_id)
                now.add(*row)
            if out:
                yield emitted()
                out = []
        if now is not None:
            out = [now.row()]
            yield emitted()

    streams = repaired.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos", "nth")
    sums = streams.select(columns).mapInArrow(stream, f"conv_id {kind}, {', '.join(c + ' long' for c in _DIGEST)}, audit string, repaired_sha256 string")
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    met = ids.join(sums, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _DIGEST]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return met.select(F.col("_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
