import random

from hypothesis import given, settings
from hypothesis import strategies as st

from brute import deduped_lines, edit_distance
from feedweave.llm import lines

SCHEMA = "doc_id long, text string, lines_removed string, id string, line int, place int"


@settings(max_examples=500, deadline=None)
@given(st.text("abc", max_size=25), st.text("abc", max_size=25), st.integers(1, 5))
def test_banded_distance(a, b, most):
    assert lines.within(a, b, most) == (edit_distance(a, b) <= most)


def test_banded_distance_of_long_lines():
    rnd = random.Random(2)
    for _ in range(150):
        a = [rnd.choice("ab c") for _ in range(150)]
        b = list(a)
        for _ in range(rnd.randint(1, 4)):
            b[rnd.randrange(len(b)) :][:0] = "x"
            b.insert(rnd.randrange(len(b)), "y") if rnd.random() < 0.5 else b.pop(rnd.randrange(len(b)))
        a, b = "".join(a), "".join(b)
        assert lines.within(a, b, 3) == (edit_distance(a, b) <= 3)


def corpus():
    rnd = random.Random(5)
    line = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n)).strip().ljust(n, "z")
    common, pool = line(60), [line(rnd.choice([10, 19, 20, 39, 40, 41, 45, 80, 200])) for _ in range(40)]

    def near(x):
        x = list(x)
        for _ in range(rnd.randint(1, 3)):
            at = rnd.randrange(len(x))
            x[at : at + rnd.randint(0, 1)] = rnd.choice(["", "q", "r"])
        return "".join(x)

    docs = []
    for i in range(60):
        parts = [rnd.choice(pool) if rnd.random() < 0.5 else near(rnd.choice(pool)) for _ in range(rnd.randint(0, 6))]
        if i % 3 == 0:
            parts.insert(rnd.randrange(len(parts) + 1), f"  {common}\t")
        docs.append((i, "\n".join(parts)))
    rnd.shuffle(docs)
    return [*docs, (100, None), (101, ""), (102, "\n\n"), (103, "x" * 50_000), (104, "x" * 50_000 + "\r\nend"), (105, common + "\n" + common)]


def test_what_stays_is_what_all_pairs_leave(table):
    docs = corpus()
    found = lines.dedup_lines(table([(i, t, "s", "i", 1, 2) for i, t in docs], SCHEMA).repartition(4))
    assert found.columns == ["doc_id", "text", "id", "line", "place", "lines_removed"]
    assert sorted((r.doc_id, r.text, r.lines_removed) for r in found.collect()) == deduped_lines(docs)


def test_no_rows_null_ids_and_repeated_rows(table):
    assert lines.dedup_lines(table([], SCHEMA)).count() == 0
    same = "a line that is long enough to be compared with others"
    rows = [(None, same), (1, same), (2, same + "!"), (2, same + "!")]
    found = lines.dedup_lines(table([(i, t, None, None, None, None) for i, t in rows], SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == [("1", same), ("2", ""), ("2", ""), ("None", same)]


def test_many_near_copies_of_one_line(table):
    base = "this is the base line of a large group of nearly equal lines"
    docs = [(i, base[: i % 50] + "#" + base[i % 50 :]) for i in range(120)]
    found = lines.dedup_lines(table([(i, t, None, None, None, None) for i, t in docs], SCHEMA))
    assert sorted((r.doc_id, r.text, r.lines_removed) for r in found.collect()) == deduped_lines(docs)
