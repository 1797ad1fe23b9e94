import random

import numpy as np
import pyarrow as pa

from brute import shingle_set
from feedweave.llm.bpe import encoder
from feedweave.llm.text import WHITE, shingles, utf8, word_hashes

ODD = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "é", "1", "٣", "\xa0", "\x85", "\x1c", "!", "#",
       "<|endoftext|>", "中", "ß", "D", "'S", "_", "é́", "½", "\x00", "'ll", "\U0001f600"]


def test_pieces_give_the_library_s_ids():
    rnd, tool = random.Random(1), encoder()
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14))) for _ in range(5000)]
    texts += ["", None, "a" * 3000, "' " * 50, "'s" * 100]
    ids, counts = tool.encode(texts)
    wanted = tool.tokenizer.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)
    assert counts.tolist() == [len(x.ids) for x in wanted]
    assert ids.tolist() == [i for x in wanted for i in x.ids]


def test_a_full_table_of_pieces_is_started_anew():
    from feedweave.llm.bpe import Encoder
    import public_tokenizers

    tool = Encoder(public_tokenizers.path("byte_bpe_50k.json"), most_pieces=5)
    texts = [f"word{i} and more" for i in range(50)]
    for text in texts:
        ids, _ = tool.encode([text])
        assert ids.tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids


def test_shingles_count_distinct_runs_of_five_words():
    texts = ["", "a", "A b", " a b c d e ", "x y z w v u", "a a a a a a a a", "É É é", "one\x0btwo\r\nthree four five six",
             "a\xa0b c d e f", None, "\n \t"]
    data, bounds = utf8(pa.array(texts))
    words, before = word_hashes(data, bounds, WHITE)
    sets, first = shingles(words, before)
    assert np.diff(first).tolist() == [len(shingle_set(t)) for t in texts]
    lower = shingles(*word_hashes(*utf8(pa.array(["the CAT sat on it", "The cat Sat on it"])), WHITE))[0]
    assert lower[0] == lower[1]


def test_words_do_not_run_over_texts():
    data, bounds = utf8(pa.array(["ab", "cd", "", "abcd"]))
    words, before = word_hashes(data, bounds, WHITE)
    assert before.tolist() == [0, 1, 2, 2, 3] and len(set(words.tolist())) == 3
