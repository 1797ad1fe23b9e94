import zlib

import numpy as np

from feedweave.llm import packing, tokens
from feedweave.llm.bpe import encoder

SCHEMA = "doc_id long, text string, n_tokens string, ids string, start int"
ROWS = [(3, "three three", "x", "y", 1), (1, "", None, None, None), (2, None, None, None, None), (None, "no id", None, None, 2),
        (7, "long " * 3000, None, None, 0), (7, "same id", None, None, 0), (9, "<|endoftext|> it's  there\n", None, None, 0)]


def ids_of(text):
    return encoder().tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_files_hold_all_ids_in_order(spark, table, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(table(ROWS, SCHEMA), path)
    back = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == [None, 1, 2, 3, 7, 7, 9]
    start = 0
    for r in back:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += len(r.ids)
    assert sorted((r.doc_id or 0, list(r.ids)) for r in back) == sorted((i or 0, ids_of(t)) for i, t, *_ in ROWS)
    sums = tokens.crc32_of_ids(tokens.read_tokens(spark, path), ["doc_id", "n_tokens"]).collect()
    assert sorted((r.doc_id or 0, r.ids_crc32) for r in sums) == sorted((i or 0, crc(ids_of(t))) for i, t, *_ in ROWS)


def test_a_look_up_is_pushed_down(spark, table, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(table(ROWS, SCHEMA), path)
    found = tokens.read_tokens(spark, path, ids=[3])
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(shard), In(doc_id" in plan or "EqualTo(doc_id,3)" in plan or "In(doc_id, [3])" in plan
    whole = {r.doc_id: r.start for r in tokens.read_tokens(spark, path).collect()}
    assert [(r.doc_id, r.start) for r in found.collect()] == [(3, whole[3])]


def test_no_documents(spark, table, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(table([], SCHEMA), path)
    assert tokens.crc32_of_ids(tokens.read_tokens(spark, path), ["doc_id", "start", "n_tokens"]).count() == 0
    assert packing.pack(table([], SCHEMA)).count() == 0


def check_packing(rows, pieces, size):
    wanted = {}
    for i, t, *_ in rows:
        wanted.setdefault(i, []).append(ids_of(t))
    by_sequence, by_doc = {}, {}
    for p in pieces:
        assert p.length == len(p.ids) // 4 and p.length > 0
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append((p.start, np.frombuffer(p.ids, "<i4").tolist()))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    for i, lists in wanted.items():
        if len(lists) == 1:
            assert [x for _, part in sorted(by_doc[i]) for x in part] == lists[0]
    assert sum(p.length for p in pieces) == sum(len(x) for lists in wanted.values() for x in lists)
    return len(by_sequence)


def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(table):
    docs = table(ROWS, SCHEMA).coalesce(1)
    pieces = packing.pack(docs, size=64).collect()
    used = check_packing(ROWS, pieces, 64)
    assert used == -(-sum(p.length for p in pieces) // 64)


def test_windows_keep_memory_bounded_and_lose_nothing(table):
    rows = [(i, f"text {i} " * (i % 40), None, None, None) for i in range(300)]
    pieces = packing.pack(table(rows, SCHEMA).coalesce(2), size=128, window_tokens=1000).collect()
    used = check_packing(rows, pieces, 128)
    assert used <= sum(p.length for p in pieces) / 128 + 30


def test_rests_go_to_the_cheapest_sequence_with_room():
    placed, costs = packing.pack_rests([60, 50, 40, 30, 20], 100, 0.01)
    assert sum(p[2] for p in placed) == 200 and len(costs) == 2
    # Longest first: 60 and 50 open both sequences, 40 joins the cheaper.
    assert [(p[0], p[3]) for p in placed[:3]] == [(0, 0), (1, 1), (2, 1)]
    assert max(costs) - min(costs) < 40


def test_added_tokens_are_those_of_the_file(spark, table, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>b it's", "<|endof", "text|>", "é 語 <|endoftext|>", "plain"]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    wanted = {i: tool.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    path = str(tmp_path / "tokens")
    tokens.write_tokens(table(rows, SCHEMA), path)
    assert {r.doc_id: list(r.ids) for r in tokens.read_tokens(spark, path).collect()} == wanted
    pieces = packing.pack(table(rows, SCHEMA)).collect()
    assert {p.doc_id: np.frombuffer(p.ids, "<i4").tolist() for p in pieces} == wanted
