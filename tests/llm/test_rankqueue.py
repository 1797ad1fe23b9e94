"""Byte-level BPE by a rank queue, beside the plain rule and the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from feedweave.llm import queries, rankqueue


@pytest.fixture(scope="module")
def library():
    ranks = rankqueue.codec().ranks
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain(ranks, piece):
    """Lowest rank first, leftmost among equals."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@given(st.dictionaries(st.text("abc", min_size=2, max_size=5), st.none(), max_size=30), st.randoms(), st.text("abc", min_size=1, max_size=40))
@settings(max_examples=300, deadline=None)
def test_any_order_of_ranks(tokens, rnd, text):
    """Joined tokens may rank below their parts: the queue goes back to lower ranks as they appear."""
    every = [bytes([b]) for b in b"abc"] + [t.encode() for t in tokens]
    rnd.shuffle(every)
    ranks = {t: 97 * i for i, t in enumerate(every)}
    queue = rankqueue.RankQueue(ranks)
    assert queue.merge(text.encode()) == plain(ranks, text.encode())
    assert not any(queue.buckets) and not any(queue.low) and not any(queue.mid)


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_library(library, text):
    assert np.frombuffer(rankqueue.codec().encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_very_long_pre_tokens(library):
    rnd = random.Random(3)
    for text in ["a" * 40_000, "ab" * 9_000, "".join(rnd.choices("aetihnsr", k=60_000)), " " * 9_000 + "x", "é漢" * 5_000]:
        assert np.frombuffer(rankqueue.codec().encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_forgetting_changes_nothing(library):
    tool = rankqueue.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, most=3, longest=4)
    texts = ["one two three four five", "", "two's company, three is a crowd of 1234567 people  \n\n end"]
    assert [np.frombuffer(x, "<u4").tolist() for x in tool.encode(texts)] == [library.encode_ordinary(x) for x in texts]


ROWS = [(1, "Hello, world's  end\n", "x"), (2, None, "x"), (3, "", "x"), (4, "<|endoftext|> is text", None), (4, "<|endoftext|> is text", None),
        (None, "Grüße, 漢字 \U0001f600", "y"), (5, "long " * 30_000, "y")]


def test_rows(table, library):
    """Null and empty texts, special strings, repeated rows, a null id, a long text and other columns."""
    docs = table([(*r, b"1") for r in ROWS], "doc_id long, text string, ids string, bytes binary")
    rows = rankqueue.encode(docs)
    assert rows.columns == ["doc_id", "ids"]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rows.collect())
    assert found == sorted((i is None, i or 0, library.encode_ordinary(t or "")) for i, t, _ in ROWS)
    back = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.bytes)) for r in rankqueue.decode(rows).collect())
    assert back == sorted((i is None, i or 0, (t or "").encode()) for i, t, _ in ROWS)
    none = table([(7, None)], "doc_id long, ids array<int>")
    assert rankqueue.digests(none).first().n_tokens == 0
    assert rankqueue.decode(none).first().bytes == b""


def test_no_rows_and_other_columns(table):
    docs = table([], "key string, body string")
    assert rankqueue.decode(rankqueue.encode(docs, "key", "body"), "key").collect() == []
    assert rankqueue.encode(table([("a", "bc")], "key string, body string"), "key", "body").first().key == "a"


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, text in docs:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, queries.QUERIES["op13_byte_bpe"](spark, folder).collect())) == sorted(want)
