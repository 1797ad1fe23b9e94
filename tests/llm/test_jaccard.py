import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import jaccard_classes
from feedweave.llm import jaccard

SCHEMA = "doc_id long, text string, id string, n int, key string, component_id int"


def corpus(seed=0):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage, docs = text(60), []
    for size in (1, 3, 5, 6, 9, 14, 30, 70, 200, 600):
        for _ in range(3):
            base = text(size)
            docs.append(base)
            for _ in range(6):
                copy = list(base)
                for _ in range(rnd.randint(0, max(1, size // 25))):
                    copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
                docs.append(copy)
    docs += [passage + text(rnd.choice([5, 20, 60])) for _ in range(25)]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    extra = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "Same Words Twice here now"), (1004, "same words twice here now"),
             (1005, "two words"), (1006, "two  words"), (1007, "x" * 100_000)]
    rows += extra
    rnd.shuffle(rows)
    return rows


def test_classes_are_those_of_all_pairs(table):
    rows = corpus()
    found = jaccard.near_classes(table([(i, t, "a", 1, "b", 2) for i, t in rows], SCHEMA).repartition(3))
    assert sorted(map(tuple, found.collect())) == jaccard_classes(rows)


def test_a_chain_of_copies_is_one_class(table):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i : i + 50])) for i in range(0, 11)] + [(50, "a b"), (51, "a b")]
    found = jaccard.near_classes(table([(i, t, None, None, None, None) for i, t in rows], SCHEMA))
    assert sorted(map(tuple, found.collect())) == jaccard_classes(rows)


def test_repeated_rows_null_ids_and_no_rows(table):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")]
    full = table([(i, t, None, None, None, None) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, jaccard.near_classes(full).collect())) == [(1, 2, 1), (2, 2, 1)]
    kept = jaccard.one_of_each(full)
    assert kept.columns == full.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]
    assert jaccard.near_classes(table([], SCHEMA)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.data())
def test_linked_sets_share_a_signature(size, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 1 << 30)))
    a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    gone = data.draw(st.integers(0, size // 5))
    more = data.draw(st.integers(0, size // 4))
    b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, more, dtype=np.uint64)])
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b))
    keys, owner = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    if 100 * both >= 80 * (len(a) + len(b) - both):
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


@pytest.mark.parametrize("percent", [70, 90])
def test_other_thresholds(table, percent):
    rows = corpus(percent)[:120]
    found = jaccard.near_classes(table([(i, t, None, None, None, None) for i, t in rows], SCHEMA), percent=percent)
    assert sorted(map(tuple, found.collect())) == jaccard_classes(rows, percent)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 300), st.integers(0, 300), st.integers(0, 300), st.integers(0, 1 << 30))
def test_sketches_never_rule_out_a_link(both, only_a, only_b, seed):
    x = np.random.default_rng(seed).integers(0, 1 << 63, both + only_a + only_b, dtype=np.uint64)
    a, b = x[: both + only_a], np.concatenate([x[:both], x[both + only_a :]])
    if len(a) and len(b) and 100 * both >= 80 * (both + only_a + only_b):
        one, two = jaccard._content(len(a), a), jaccard._content(len(b), b)
        assert jaccard._compare(80)(one, [two]) == [0] and jaccard._compare(80)(two, [one, one]) == [0, 1]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.data())
def test_sets_have_few_signatures_and_linked_ones_share_one_whatever_is_common(size, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 1 << 30)))
    a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    b = np.concatenate([a[data.draw(st.integers(0, size // 5)) :], rng.integers(0, 1 << 63, data.draw(st.integers(0, size // 4)), dtype=np.uint64)])
    a, b = np.unique(a), np.unique(b)
    known = np.unique(rng.choice(np.concatenate([a, b]), data.draw(st.integers(0, size))))
    common = known, rng.integers(2, 9, len(known))
    keys, owner = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), common=common)
    assert np.bincount(owner, minlength=2).tolist() == [len(x) // 5 + 1 for x in (a, b)]
    both = len(np.intersect1d(a, b))
    if 100 * both >= 80 * (len(a) + len(b) - both):
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_common_shingles_are_no_signatures_of_texts_that_have_others():
    sets, before = np.arange(1, 61, dtype=np.uint64), np.array([0, 30, 60])
    common = np.array([1, 2, 3, 31, 32], dtype=np.uint64), np.array([9, 9, 2, 5, 4])
    keys, owner = jaccard.signatures(sets, before, common=common)
    assert keys.tolist() == [*range(4, 11), *range(33, 40)] and owner.tolist() == [0] * 7 + [1] * 7
    few = jaccard.signatures(sets[:4], np.array([0, 4]), common=common)[0]
    assert few.tolist() == [4]


def test_texts_with_a_passage_in_common_give_the_classes_of_all_pairs(table, tmp_path):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(5000)}"
    passage, rows = [word() for _ in range(40)], []
    for i in range(0, 240, 2):
        own = [word() for _ in range(rnd.choice([3, 8, 60]))]
        rows += [(i, " ".join(passage + own)), (i + 1, " ".join(passage + own[:-1] + [word()]))]
    docs = table([(i, t) for i, t in rows], "id long, text string")
    shingle, n = jaccard._common(docs, str(tmp_path))
    assert len(shingle) >= 36 and n.min() > 1 and (np.diff(shingle.astype(float)) >= 0).all()
    found = jaccard.near_classes(table([(i, t, None, None, None, None) for i, t in rows], SCHEMA))
    assert sorted(map(tuple, found.collect())) == jaccard_classes(rows)


def test_texts_pass_the_bitmap_first_and_staged_rows_go_when_read(table, tmp_path, monkeypatch):
    plans, stage = {}, jaccard.stage

    def watched(df, label, folder=None):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, label, folder)

    monkeypatch.setattr(jaccard, "stage", watched)
    monkeypatch.setattr(jaccard, "fresh_dir", lambda spark, label: str(tmp_path / label))
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(12)]
    found = jaccard.near_classes(table([(i, t, None, None, None, None) for i, t in rows], SCHEMA))
    left = {p.name for p in (tmp_path / "jaccard").iterdir()}
    assert "sizes" in left and not left & {"met", "members", "texts", "raw-pairs"}
    # A semi-join would be moved in front of the bitmap.
    assert "LeftSemi" not in plans["texts"] and "bitmap" in plans["texts"]
    assert sorted(map(tuple, found.collect())) == jaccard_classes(rows)
