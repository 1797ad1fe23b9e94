import hashlib
import math

import pytest

from feedweave.llm import mixing

SCHEMA = "doc_id long, source string, text string, mix_key int, n int, rate int"


def count_of(doc_id, rate, seed):
    steps = max(1, math.ceil(rate / 4.0))
    part, total = rate / steps, 0
    for step in range(1, steps + 1):
        digest = hashlib.md5(f"{'~' if doc_id is None else doc_id}|{seed}|{step}".encode()).hexdigest()
        u, p, s = int(digest[:13], 16) / 2**52, math.exp(-part), math.exp(-part)
        for k in range(1, 41):
            if s > u:
                break
            total, p = total + 1, p * part / k
            s += p
    return total


def rows(counts):
    at, out = 0, []
    for source, n in counts.items():
        for _ in range(n):
            out.append((at, source, f"text {at}", 1, 2, 3))
            at += 1
    return out


@pytest.mark.parametrize("weights", [None, {"a": 1.0, "b": 3.0, "c": 6.0}])
def test_copies_follow_the_inverse_distribution(table, weights):
    counts = {"a": 300, "b": 60, "c": 5, None: 20}
    docs = rows(counts)
    mixed = mixing.mix_sources(table(docs, SCHEMA), weights=weights, seed=3)
    assert mixed.columns == ["doc_id", "source", "text", "n", "rate", "mix_copy", "mix_key"]
    found = mixed.collect()
    wanted_weight = {s: (n**0.5 if weights is None else weights.get(s, 0.0)) for s, n in counts.items()}
    total = sum(wanted_weight.values())
    wanted = []
    for doc_id, source, *_ in docs:
        rate = wanted_weight[source] * len(docs) / (total * counts[source])
        wanted += [(doc_id, k + 1) for k in range(count_of(doc_id, rate, 3))]
    assert sorted((r.doc_id, r.mix_copy) for r in found) == sorted(wanted)
    assert [r.mix_key for r in found] == sorted(r.mix_key for r in found)


def test_rates_reach_the_target_weights(table):
    docs = table(rows({"big": 6000, "small": 200}), SCHEMA)
    mixed = mixing.mix_sources(docs, weights={"big": 0.5, "small": 0.5}).groupBy("source").count().collect()
    for r in mixed:
        assert abs(r["count"] - 3100) < 5 * 3100**0.5 + 0.1 * 3100


def test_no_rows_null_ids_and_unknown_sources(table):
    assert mixing.mix_sources(table([], SCHEMA)).count() == 0
    docs = table([(None, "a", None, 0, 0, 0), (1, "a", "", 0, 0, 0), (1, "a", "", 0, 0, 0)], SCHEMA)
    counts = {(r.doc_id): r["count"] for r in mixing.mix_sources(docs, size=30).groupBy("doc_id").count().collect()}
    assert counts.get(1, 0) == 2 * count_of(1, 10.0, 7) and counts.get(None, 0) == count_of(None, 10.0, 7)
    assert mixing.mix_sources(docs, weights={"other": 1.0}).count() == 0


def test_it_stays_in_the_jvm(table):
    plan = mixing.mix_sources(table(rows({"a": 3}), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
