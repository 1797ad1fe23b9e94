"""The source divergence audit beside a plain one, and the pointer sort beside sorted()."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from feedweave.llm import divergence, termsort
from feedweave.llm.text import utf8

SCHEMA = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(rows, least=3, most=200):
    docs = [(lang or "", source or "", terms(text)) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= least)
        groups = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= least) for s in {d[1] for d in mine}}
        whole, v = sum(groups.values(), Counter()), len(kept)

        def p(counts, t):
            return 1 + 10**9 * (counts[t] + 1) // (sum(counts.values()) + v)

        def f(a, b):
            return (a - b) ** 2 // b

        for s, counts in groups.items():
            pairs = [(o, sum(f(p(counts, t), p(groups[o], t)) for t in kept)) for o in groups if o != s]
            single = [(t, f(p(counts, t), p(whole, t))) for t in kept if counts[t] and p(counts, t) > p(whole, t)]
            for part, found, limit in [("pair", pairs, None), ("term", single, most)]:
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, n, k) for k, (i, n) in enumerate(found[:limit], 1)]
    return sorted(out)


def check(table, rows, schema=SCHEMA, **how):
    assert sorted(map(tuple, divergence.audit(table(rows, schema), **how).collect())) == plain([r[:4] for r in rows], **{
        {"least_docs": "least", "most_terms": "most"}[k]: v for k, v in how.items()})


@pytest.mark.parametrize("small", [2, 50, 1 << 14])
def test_pointer_sort(small, monkeypatch):
    monkeypatch.setattr(termsort, "SMALL", small)
    rnd = random.Random(small)
    tables = [["".join(rnd.choices("aAbBzZé漢 1.'", k=rnd.randint(0, 60))) if rnd.random() > 0.1 else None for _ in range(rnd.randint(0, 12))]
              for _ in range(60)]
    for texts in [*tables, ["abcdefgh" * k + " abcdefgh" * k for k in range(20)], ["x" * 100_000, "x" * 99_999, "x"]]:
        data, bounds = utf8(pa.array(texts, pa.string()))
        starts, ends = termsort.term_places(data, bounds)
        order, first = termsort.TermSort(data, starts, ends).order()
        want = sorted(t.encode() for x in texts for t in terms(x))
        assert [bytes(termsort.LOWER[data[starts[i] : ends[i]]]) for i in order] == want
        assert first.tolist() == [i for i, t in enumerate(want) if not i or want[i - 1] != t]


def test_nulls_empty_groups_and_repeats(table):
    """Null columns are '', a group without terms stays, each row is a document, other columns are not looked at."""
    rows = [(1, "The cat, the CAT; the dog", "en", "a"), (2, "cat dog dog", "en", "b"), (2, "cat dog dog", "en", "b"), (3, None, "en", "empty"),
            (4, "the dog's", None, None), (None, "dog dog", None, ""), (5, "dog", "", "c"), (6, "", None, "c"),
            (7, "alone alone alone", "fr", "a"), (8, "Été été 9漢x", "de", "a"), (9, "Été été", "de", "b"), (9, "été", "de", "b"),
            (10, "word " * 200_000 + "cat", "en", "long")]
    check(table, rows)
    check(table, [(*r, "t", 5, "p") for r in rows], SCHEMA + ", term string, n int, part string")
    check(table, rows, least_docs=1, most_terms=1)


def test_random_tables(table, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 7)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 500)
    rnd = random.Random(4)
    words = ["w" * rnd.randint(1, 20) + rnd.choice("abc") for _ in range(40)]
    rows = [(i, " ".join(rnd.choices(words, weights=range(40, 0, -1), k=rnd.randint(0, 30))), rnd.choice(["en", "de"]), rnd.choice("pqrst"))
            for i in range(120)]
    check(table, rows)


def test_shares_of_huge_counts(spark):
    """Counts beyond what a product of 64-bit numbers holds."""
    from pyspark.sql import functions as F

    n, total = 812_345_678_901, 16_000_000_000_007
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 1) // total


def test_no_documents(table):
    assert divergence.audit(table([], SCHEMA)).collect() == []
