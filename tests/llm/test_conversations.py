"""Operators over conversations (12, 13) against brute force, and on odd rows."""

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from farebox.llm import prefixes, repair

SCHEMA = "conv_id long, turn long, role string, text string, node string, grp string, at long"
EXTRA = ("n", "g", 7)


def order(turn):
    return (turn is not None, turn or 0)


# -- 12 prefix trie

def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((order(turn), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    nodes = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def under(p):
        return [p] + [q for c in children.get(p, []) for q in under(c)]

    out = set()
    for p, members in nodes.items():
        subtree = under(p)
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(p))))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])),
                 sum(q not in children for q in subtree),
                 sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in subtree if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_rows(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rnd.choice([0, 1, 2, 3, 5, 9, 12])):
            rows.append((c, rnd.choice([turn, turn, turn, None]), rnd.choice(["user", "assistant", None]), rnd.choice(["", "a", "é!", "b b", None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(prefixes, "_BLOCK_BITS", seed)  # blocks of 2 and 4 turns: sums and id lists cross them
    rows = trie_rows(seed)
    rows += [(1000 + 5 * i, t, "user", f"hot {t}") for i in range(40) for t in range(3)] + rows[:3] + [(None, 1, "user", "x")]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in prefixes.prefix_trie(df).collect()]
    want = brute_trie(rows)
    assert len(got) == len(want) and set(got) == want


def test_trie_long_conversation_is_spread_and_whole(spark):
    rows = [(5, t // 2, "user", f"{t % 7}" * (t % 3)) for t in range(9000)] + [(6, 0, "user", ""), (7, None, None, None)]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)
    turns = prefixes.positions(df)
    assert sorted(r.pos for r in turns.where("conv_id = 5").collect()) == list(range(1, 9001))
    got = prefixes.prefix_trie(df).where("conv_id = 5").collect()
    assert len(got) == 9001 and {r.n_leaves for r in got if r.depth > 8} == {1}


def test_trie_texts_are_shuffled_once(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", *EXTRA)], SCHEMA)
    plan = prefixes.positions(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan  # after the ordering only hashes and sizes go on


def test_trie_empty_and_turnless(spark):
    none = prefixes.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns[0] == "conv_id"
    c = next(c for c in range(11, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    got = prefixes.prefix_trie(spark.createDataFrame([(c, 0, "user", "x", *EXTRA)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


# -- 13 structure repair

WHITE = " \t\n\x0b\f\r"


def brute_script(rows):
    """(cost, edits) of the cheapest, ASCII-least script, by strings from the end; rows are (initial, must_go, truncated)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, ""))
        if inserted < 4:
            for role in "ua":
                if (state, role) in step:
                    cost, script = best(i, step[state, role], inserted + 1)
                    options.append((cost + 3, "I" + script))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            cost, script = best(i + 1, state, 0)
            options.append((cost + 4, "D" + script))
            if not must_go:
                if (state, initial) in step:
                    cost, script = best(i + 1, step[state, initial], 0)
                    options.append((cost + 3 * truncated, "K" + script))
                for role in "ua":
                    if (state, role) in step:
                        cost, script = best(i + 1, step[state, role], 0)
                        options.append((cost + 3 + 3 * truncated, "R" + script))
        return min(options, default=(10 ** 9, ""))

    return best(0, "", 0)


def brute_damage(rows):
    out = []
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_audit(rows):
    """Result columns for the rows of one conversation."""
    rows = sorted((order(t), " " if r is None else r, " " if x is None else x, t) for _, t, r, x in rows)
    seen, state = set(), []
    for _, role, text, _ in rows:
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        state.append((role, text, fault))
    turns = [t for *_, t in rows if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(state, state[1:])]
    cost, script = brute_script(tuple((r[:1], f in ("blank", "duplicate"), f == "truncated") for r, _, f in state))
    lines, at, before = [], 0, ""
    for e in script:
        role = {"": "user", "s": "user", "a": "user", "u": "assistant"}[before]
        if e == "I":
            lines.append(role + ":")
        else:
            if e != "D":
                role = state[at][0] if e == "K" else role
                lines.append(role + ":" + state[at][1])
            at += 1
        if e != "D":
            before = role[0]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines)) is not None
    faults = [f for *_, f in state]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, script,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def messy(seed, n):
    rnd = random.Random(seed)
    texts = ["Hi.", "yes", "What?", "", " \t", "ok!  ", "no .x", "end.\n", "...", None, "long " * 50 + "."]
    rows = []
    for c in range(n):
        for turn in range(rnd.choice([1, 2, 4, 7, 11])):
            rows.append((c, rnd.choice([turn, turn, turn, 2 * turn, None]), rnd.choice(["user", "assistant", "system", "tool", "u2", "", None]),
                         rnd.choice(texts)))
    return rows


def test_tables_have_few_vectors_and_blocks_match_single_steps():
    t = repair.tables()
    assert len(t.vectors) < 256
    rnd = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 41):
        symbols = rnd.integers(0, repair.SYMBOLS, n)
        at, cost = t.function(symbols)
        for v in range(len(t.vectors)):
            x, total = v, 0
            for s in symbols[::-1]:
                total += t.add[x, s]
                x = t.step[x, s]
            assert (at[v], cost[v]) == (x, total)


def test_scripts_equal_brute_force():
    rnd = random.Random(7)
    t = repair.tables()
    for _ in range(1500):
        rows = tuple((rnd.choice("suat"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.randint(0, 11)))
        symbols = np.array([0 if gone else 1 + 2 * "suat".index(i) + cut for i, gone, cut in rows], dtype=np.int64)
        at, cost = t.function(symbols)
        edits, _, state = t.trace(symbols, 0)[0]
        script = "".join(edits) + "I" * len(t.tail[state])
        assert (t.vectors[at[0]][0] + cost[0], script) == brute_script(rows)


@pytest.mark.parametrize("bits", [1, 12])
def test_audit_equals_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(repair, "_CHUNK_BITS", bits)  # chunks of two rows: both passes cross them
    rows = messy(bits, 80) + [(None, 3, "user", "A."), (None, None, "assistant", "B."), (999, 0, "user", "gone")]
    rows += rows[:4]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair.audit(df).collect()}
    fixed = {}
    for r in repair.repair(df).collect():
        fixed.setdefault(r.conv_id, []).append((r.at, r.place, f"{r.role}:{r.text}"))
    for c in {r[0] for r in rows}:
        want, lines = brute_audit([r for r in rows if r[0] == c])
        assert got.pop(c) == want, c
        assert [x for *_, x in sorted(fixed.get(c, []))] == lines
    assert not got


def test_damage_and_report_of_every_conversation(spark):
    rows = messy(5, 120)
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)
    hurt = brute_damage(rows)
    assert sorted(map(repr, hurt)) == sorted(repr(tuple(r)) for r in repair.damage(df).collect())
    got = {r.conv_id: tuple(r)[1:] for r in repair.audit(repair.damage(df), of=df).collect()}
    for c in {r[0] for r in rows}:
        left = [r for r in hurt if r[0] == c]
        assert got[c] == (brute_audit(left)[0] if left else (0, 0, 0, 0, 0, 0, "", repair.NO_LINES))
    assert set(got) == {r[0] for r in rows}
    assert any(not v[6] for v in got.values())


def test_repair_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(10_001)]
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(6)
    r = repair.audit(df).first()
    lines = [f"{role}:{text}" for _, _, role, text in rows] + ["assistant:"]
    assert (r.cost, r.audit) == (3, "K" * 10_001 + "I")
    assert r.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_repair_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.audit(repair.damage(df), of=df).count() == 0 and repair.repair(df).count() == 0
