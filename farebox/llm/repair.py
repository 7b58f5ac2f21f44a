"""Conversation structure repair (operator 13).

Least-cost edits that make a conversation's role initials match
``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 3, Delete 4 (the only edit
of blank and duplicate rows), Insert an empty user or assistant turn 3;
truncated rows that stay add 3.

Four Russians: the cost to go from each of the four states of that pattern's
automaton, less its least entry, takes a few dozen values over all inputs.
Tables give, for every such vector and every block of four symbols, the vector
before the block and the cost it adds.  A conversation is cut into chunks of at
most 4,096 rows.  Tasks reduce each chunk to a function on vectors by block
lookups; one pass per conversation over those functions, last chunk first,
gives the vector after each chunk; tasks then expand the blocks of each chunk
against the direction of that pass, taking the ASCII-least edit that keeps the
cost, from each of the four states; and one pass, first chunk first, picks the
state.  Only the passes over chunks (a few hundred bytes per 4,096 rows) see a
whole conversation.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, materialize

WHITE = " \t\n\x0b\f\r"
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 3, 3, 4, 3
BLOCK = 4
_CHUNK_BITS = 12
_STATES = range(4)                                  # nothing yet, after s, after u, after a
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT_ROLE = "uuau"                                 # the role an inserted or reroled turn takes from each state
_FAR = 99
SYMBOLS = 9                                         # 0: must go; 1 + 2 * initial + truncated, initials s, u, a, other
LEGAL_PAIRS = {(0, 1), (1, 2), (2, 1)}
NO_LINES = hashlib.sha256(b"").hexdigest()


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Least costs when turns may be inserted first."""
    u, a = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + u), min(costs[1], INSERT + u), u, a


END = _inserted([0, _FAR, _FAR, 0])


def _options(symbol: int, state: int, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(edit, next state, cost to go) of a row's own edits."""
    out = [("D", state, DELETE + after[state])]
    if symbol:
        initial, extra = "sua?"[(symbol - 1) // 2], KEEP_TRUNCATED * ((symbol - 1) % 2)
        if (state, initial) in _STEP:
            to = _STEP[state, initial]
            out.append(("K", to, extra + after[to]))
        to = _STEP[state, _NEXT_ROLE[state]]
        out.append(("R", to, REROLE + extra + after[to]))
    return out


class Tables:
    """Vectors, one-symbol and block transitions (last symbol first), and the edits of each (vector after, symbol, state)."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = [END]
        known, steps = {END: 0}, []
        for after in self.vectors:                  # grows while it is walked, until no new vector appears
            row = []
            for symbol in range(SYMBOLS):
                before = _inserted([min(c for *_, c in _options(symbol, q, after)) for q in _STATES])
                least = min(before)
                vector = tuple(c - least for c in before)
                if vector not in known:
                    known[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((known[vector], least))
            steps.append(row)
        one = np.array(steps)
        self.step, self.add = one[:, :, 0], one[:, :, 1]
        self.block_step, self.block_add = self.step, self.add
        for _ in range(BLOCK - 1):                  # one more symbol in front of the block
            put = self.block_step
            self.block_step = np.concatenate([self.step[put, s] for s in range(SYMBOLS)], axis=1)
            self.block_add = np.concatenate([self.block_add + self.add[put, s] for s in range(SYMBOLS)], axis=1)
        self.edits = [[[self._expand(v, s, q) for q in _STATES] for s in range(SYMBOLS)] for v in range(len(self.vectors))]
        self.tail = [self._tail(q) for q in _STATES]

    def _expand(self, v: int, symbol: int, state: int) -> tuple[str, str, int]:
        """Edits at a row (insertions before it, then its own), roles they set, next state: ASCII-least of the cheapest."""
        after = self.vectors[v]
        before = [c + int(self.add[v, symbol]) for c in self.vectors[self.step[v, symbol]]]
        edits, roles = "", ""
        while True:
            own = {e: to for e, to, c in _options(symbol, state, after) if c == before[state]}
            to = _STEP[state, _NEXT_ROLE[state]]
            if "D" not in own and INSERT + before[to] == before[state]:
                edits, roles, state = edits + "I", roles + _NEXT_ROLE[state], to
                continue
            edit = min(own)
            return edits + edit, roles + (_NEXT_ROLE[state] if edit == "R" else "-"), own[edit]

    def _tail(self, state: int) -> str:
        """Roles inserted after the last row."""
        roles = ""
        while END[state]:
            roles += _NEXT_ROLE[state]
            state = _STEP[state, _NEXT_ROLE[state]]
        return roles

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading symbols that fill no block, codes of the blocks)."""
        lead = len(symbols) % BLOCK
        return symbols[:lead], symbols[lead:].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))

    def function(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector after the symbols: the vector before them, and the cost they add."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        lead, codes = self.blocks(symbols)
        for code in codes[::-1].tolist():
            cost += self.block_add[at, code]
            at = self.block_step[at, code]
        for s in lead[::-1].tolist():
            cost += self.add[at, s]
            at = self.step[at, s]
        return at, cost

    def trace(self, symbols: np.ndarray, after: int) -> list[tuple[list[str], list[str], int]]:
        """From each state: edits and roles per row, and the state after the rows."""
        lead, codes = self.blocks(symbols)
        ends = [after]                              # vectors after the last block, the one before it, ...
        for code in codes[::-1].tolist():
            ends.append(int(self.block_step[ends[-1], code]))
        parts = [(lead, ends[-1])] + [(block, v) for block, v in zip(symbols[len(lead):].reshape(-1, BLOCK), ends[-2::-1])]
        rows = []                                   # (vector after the row, symbol), first row first
        for block, v in parts:
            inside = []
            for s in block[::-1].tolist():
                inside.append((v, s))
                v = int(self.step[v, s])
            rows += inside[::-1]
        out = []
        for state in _STATES:
            edits, roles = [], []
            for v, s in rows:
                e, r, state = self.edits[v][s][state]
                edits.append(e)
                roles.append(r)
            out.append((edits, roles, state))
        return out


@functools.cache
def tables() -> Tables:
    return Tables()


def group_key(conv_id) -> F.Column:
    return F.coalesce(conv_id.cast("string"), F.lit(" "))


def faults(conversations: DataFrame) -> DataFrame:
    """Rows in order with their first fault: grp, at, turn, role, text, blank, duplicate, truncated, code.

    Ordered by (turn, null first; role; text) within a conversation, by a
    range shuffle; ``at`` grows with the order and by one within a range.
    """
    keys = [F.col("grp"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    rows = conversations.select(
        group_key(F.col("conv_id")).alias("grp"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "grp", "turn", "role", "text", F.monotonically_increasing_id().alias("at")), "repair_rows")
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    marked = rows.select(
        "grp", "at", "turn", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("same"),
        F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        F.substring(bare, -1, 1).isin(".", "!", "?").alias("ended"))
    first = marked.groupBy("grp", "same").agg(F.min("at").alias("first"))
    repeat = ~F.col("blank") & (F.col("at") > F.col("first"))
    cut = ~F.col("blank") & ~repeat & ~F.col("ended")
    place = F.expr("CASE initial WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")
    symbol = F.when(F.col("blank") | repeat, 0).otherwise(1 + 2 * place + cut.cast("int"))
    return rows, marked.join(first, ["grp", "same"]).select(
        "grp", "at", "turn", "blank", repeat.alias("duplicate"), cut.alias("truncated"),
        F.char((65 + symbol + SYMBOLS * place).cast("long")).alias("code"))


def _symbols(code: str) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(code.encode(), np.uint8).astype(np.int64) - 65
    return both % SYMBOLS, both // SYMBOLS


def edits(marked: DataFrame) -> DataFrame:
    """One row per chunk: grp, chunk, first_at, ops and roles (arrays, an entry per row), tail, cost, illegal.

    ``tail`` holds the roles inserted after a conversation's last row; cost and
    illegal pairs sum to the conversation's over its chunks.
    """
    bound_batches(marked.sparkSession)
    chunks = marked.groupBy("grp", F.shiftright("at", _CHUNK_BITS).alias("chunk")).agg(
        F.min("at").alias("first_at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "").alias("codes"))

    def functions(batches):
        for batch in batches:
            got = [tables().function(_symbols(c)[0]) for c in batch.column("codes").to_pylist()]
            least = [int(cost.min()) for _, cost in got]
            columns = [*batch.columns, pa.array([at.astype(np.uint8).tobytes() for at, _ in got], pa.binary()),
                       pa.array([(cost - m).astype(np.uint8).tobytes() for (_, cost), m in zip(got, least)], pa.binary()),
                       pa.array(least, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["grp", "chunk", "first_at", "codes", "step", "more", "least"])

    def last_first(batches):
        grp, vector = None, 0
        for batch in batches:
            after, added, final, before = [], [], [], []
            for name, step, more, least in zip(*(batch.column(c).to_pylist() for c in ("grp", "step", "more", "least"))):
                final.append(name != grp)
                if name != grp:
                    grp, vector = name, 0           # vector 0 stands after the last row
                after.append(vector)
                added.append(least + more[vector])
                vector = step[vector]
                before.append(tables().vectors[vector][0])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("grp", "chunk", "first_at", "codes")), pa.array(after, pa.int32()),
                 pa.array(added, pa.int64()), pa.array(before, pa.int64()), pa.array(final, pa.bool_())],
                names=["grp", "chunk", "first_at", "codes", "after", "added", "before", "final"])

    def traces(batches):
        for batch in batches:
            ops, roles, ends, bad, sides = [], [], [], [], []
            for codes, after in zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist()):
                symbols, initials = _symbols(codes)
                got = tables().trace(symbols, after)
                ops.append([" ".join(e) for e, _, _ in got])
                roles.append([" ".join(r) for _, r, _ in got])
                ends.append([q for *_, q in got])
                who = initials.tolist()
                bad.append(sum(pair not in LEGAL_PAIRS for pair in zip(who, who[1:])))
                sides.append([who[0], who[-1]])
            text, small = pa.list_(pa.string()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("grp", "chunk", "first_at", "added", "before", "final")), pa.array(ops, text),
                 pa.array(roles, text), pa.array(ends, small), pa.array(bad, pa.int64()), pa.array(sides, small)],
                names=["grp", "chunk", "first_at", "added", "before", "final", "ops", "roles", "ends", "bad", "sides"])

    def first_first(batches):
        grp, state, last = None, 0, None
        for batch in batches:
            ops, roles, tail, cost, illegal = [], [], [], [], []
            for r in batch.to_pylist():
                start = r["grp"] != grp
                if start:
                    grp, state = r["grp"], 0
                ops.append(r["ops"][state])
                roles.append(r["roles"][state])
                cost.append(r["added"] + (r["before"] if start else 0))
                illegal.append(r["bad"] + (not start and (last, r["sides"][0]) not in LEGAL_PAIRS))
                state, last = r["ends"][state], r["sides"][1]
                tail.append(tables().tail[state] if r["final"] else "")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("grp", "chunk", "first_at")), pa.array(ops, pa.string()), pa.array(roles, pa.string()),
                 pa.array(tail, pa.string()), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64())],
                names=["grp", "chunk", "first_at", "ops", "roles", "tail", "cost", "illegal"])

    key = "grp string, chunk long, first_at long, "
    found = (chunks.mapInArrow(functions, key + "codes string, step binary, more binary, least long")
             .repartition("grp").sortWithinPartitions("grp", F.col("chunk").desc())
             .mapInArrow(last_first, key + "codes string, after int, added long, before long, final boolean")
             .repartition("grp", "chunk")
             .mapInArrow(traces, key + "added long, before long, final boolean, ops array<string>, roles array<string>, "
                                       "ends array<int>, bad long, sides array<int>")
             .repartition("grp").sortWithinPartitions("grp", "chunk")
             .mapInArrow(first_first, key + "ops string, roles string, tail string, cost long, illegal long"))
    return materialize(found.withColumn("ops", F.split("ops", " ")).withColumn("roles", F.split("roles", " ")), "repair_edits")


def row_edits(chunk_edits: DataFrame) -> DataFrame:
    """(grp, at, op, role_set, tail): each row's edits; ``tail`` on a conversation's last row only."""
    each = chunk_edits.select("grp", "first_at", F.size("ops").alias("n"), "tail",
                              F.posexplode(F.arrays_zip("ops", "roles")).alias("i", "e"))
    return each.select("grp", (F.col("first_at") + F.col("i")).alias("at"), F.col("e.ops").alias("op"),
                       F.col("e.roles").alias("role_set"), F.when(F.col("i") == F.col("n") - 1, F.col("tail")).otherwise("").alias("tail"))


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, at, place, edit (K, R or I), role, text.

    Ordered by (at, place) within a conversation.  Rows meet their edits by a
    join on (conversation, at), so no conversation is gathered.
    Null conv_ids are one conversation; null roles and texts are one space;
    an empty table gives no rows.
    """
    rows, marked = faults(conversations)
    rows = rows.join(row_edits(edits(marked)), ["grp", "at"])
    named = lambda c: F.when(c == "u", "user").otherwise("assistant")
    both = F.concat("op", F.repeat(F.lit("I"), F.length("tail")))
    steps = rows.select("grp", "at", "role", "text", both.alias("op"), F.concat("role_set", "tail").alias("role_set"))
    steps = steps.select("*", F.posexplode(F.split("op", "")).alias("place", "edit")).where("edit IN ('K', 'R', 'I')")
    letter = F.substring("role_set", F.col("place") + 1, F.lit(1))
    return steps.select(F.when(F.col("grp") != " ", F.col("grp")).cast("long").alias("conv_id"), "at", "place", "edit",
                        F.when(F.col("edit") == "K", F.col("role")).otherwise(named(letter)).alias("role"),
                        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def _digests(rows: DataFrame, chunk_edits: DataFrame) -> DataFrame:
    """(grp, repaired_sha256): SHA-256 of the repaired ``role:text`` lines.

    Rows and edits stream through one hash per conversation in order, in
    constant memory; SHA-256 takes its input in order, so this step alone
    visits a conversation in one task.
    """
    blank = F.lit(None).cast("string")
    told = row_edits(chunk_edits).select("grp", "at", F.lit(0).alias("kind"), F.col("op").alias("a"), F.col("role_set").alias("b"), "tail")
    said = rows.select("grp", "at", F.lit(1).alias("kind"), F.col("role").alias("a"), F.col("text").alias("b"), blank.alias("tail"))
    bound_batches(rows.sparkSession)

    def run(batches):
        grp, state, empty, told = None, None, True, None
        names = {"u": b"user:", "a": b"assistant:"}
        for batch in batches:
            done = []
            for name, kind, a, b, tail in zip(*(batch.column(c).to_pylist() for c in ("grp", "kind", "a", "b", "tail"))):
                if name != grp:
                    if grp is not None:
                        done.append((grp, state.hexdigest()))
                    grp, state, empty = name, hashlib.sha256(), True
                if not kind:
                    told = (a, b, tail)
                    continue
                lines = [names[r] if e == "I" else (names[r] if e == "R" else a.encode() + b":") + b.encode()
                         for e, r in zip(*told[:2]) if e != "D"]
                lines += [names[r] for r in told[2]]
                for line in lines:
                    state.update(line if empty else b"\n" + line)
                    empty = False
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["grp", "repaired_sha256"])
        if grp is not None:
            yield pa.RecordBatch.from_arrays([pa.array([grp]), pa.array([state.hexdigest()])], names=["grp", "repaired_sha256"])

    order = ("grp", "at", "kind")
    return (told.unionByName(said).repartition("grp").sortWithinPartitions(*order)
            .mapInArrow(run, "grp string, repaired_sha256 string"))


def audit(conversations: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``of`` (default: the conversations themselves) names the conv_ids to
    report; one without rows has zeros, an empty audit and the hash of the
    empty string.  Null conv_ids are one conversation; null roles and texts
    are one space; null turns come first; equal turns are ordered by role and
    text; repeated rows are rows of their own (and duplicates); other columns
    are ignored; an empty table gives no rows.
    """
    names = (conversations if of is None else of).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows, marked = faults(conversations)
    marked = materialize(marked, "repair_marked")
    by_turn = marked.groupBy("grp", "turn").agg(*[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    counts = by_turn.groupBy("grp").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    chunk_edits = edits(marked)
    whole = F.concat(F.array_join("ops", ""), F.repeat(F.lit("I"), F.length("tail")))
    scripts = chunk_edits.select("grp", "chunk", "cost", "illegal", whole.alias("part")).groupBy("grp").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))), lambda x: x["part"]), "").alias("audit"))
    out = (names.withColumn("grp", group_key(F.col("conv_id"))).join(counts, "grp", "left").join(scripts, "grp", "left")
           .join(_digests(rows, chunk_edits), "grp", "left"))
    zero = F.lit(0).cast("long")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(NO_LINES)).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """The table with every twentieth row dropped, emptied, stripped of ``.!?``, repeated or given to the user, by a hash of its key."""
    key = F.concat(group_key(F.col("conv_id")), F.lit(":"), F.coalesce(F.col("turn").cast("long").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
