"""The conversation trie beside a plain one."""

import hashlib
import random
import zlib

from feedweave.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}\n{role}\n{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = (own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def below(node):
        stack, leaves, saved = [node], 0, 0
        while stack:
            x = stack.pop()
            saved += (len(members[x]) - 1) * len(x[-1][1]) if x else 0
            leaves += x not in kids
            stack += kids.get(x, [])
        return leaves, saved

    out = []
    for node, ms in members.items():
        leaves, saved = below(node)
        ends = ",".join(map(str, sorted(c for c, e in ms if e)))
        out.append((min(ms)[0], len(node), min(members[node[:-1]])[0] if node else None, len(ms), len(kids.get(node, [])),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(table, rows, schema=SCHEMA):
    found = trie.prefix_trie(table(rows, schema))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain([r[:4] for r in rows])


def test_nulls_ties_and_repeats(table):
    """Null turns first, null roles and texts empty, equal turn numbers, repeated rows, null conversations left out."""
    rows = [(0, None, "user", "first"), (0, 1, None, "a"), (0, 1, "b", None), (0, 2, "user", "x\U0001f600"), (0, 2, "user", "x\U0001f600"),
            (1, 0, "user", "q"), (2, 0, None, None), (None, 0, "user", "nobody"), (-7, 0, "user", "below"), (-107, 0, "user", "no base"),
            (105, 3, "user", ""), (205, 0, "user", "long " * 50_000), (-100, 0, "assistant", "base"), (-130, 5, "system", "s")]
    check(table, rows)


def test_random_tables(table, spark):
    for seed in range(3):
        rnd = random.Random(seed)
        rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "bb", None]))
                for c in rnd.sample(range(-250, 400), 160) for t in range(rnd.choice([1, 1, 2, 3, 5, 7, 9]))]
        check(table, rows)


def test_one_conversation_many_times(table):
    """A group of equal conversations: end lists longer than one joined text."""
    rows = [(c, t, "user", f"turn {t}") for c in range(1300) for t in range(3)]
    check(table, rows)


def test_long_conversation(table):
    """Rows of one conversation over several batches."""
    check(table, [(c, t, "user", str(t // 7 if c else t % 5)) for c in (0, 3, 111) for t in range(700)])


def test_no_turns_and_other_columns(table):
    assert trie.prefix_trie(table([], SCHEMA)).collect() == []
    check(table, [(1, 0, "user", "a", b"n", "p", 4), (1, 1, "user", "b", None, None, None)],
          SCHEMA + ", node binary, parent string, depth int")
