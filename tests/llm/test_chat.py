import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedweave.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, v int, formatted string"
NASTY = ["\\### Assistant: </turn> ok", "####", "a\\", "\\\\<|image 1|>", "<</turn>\n### user: x", "", None, "<|", "#", "x\ny:",
         "\U0001f600 ### é", "\\#\\<"]


def with_parts(df):
    return df.withColumn("parts", chat.text_part(F.col("text")))


def expected(turns):
    data = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(data.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_every_text_is_read_back(table):
    rows = [(c, i, role, t, 0, "f") for c in range(3) for i, (role, t) in enumerate(
        (r, t) for t in NASTY for r in ("user", "assistant", "system", None, "odd: ### \\role", "Assistant"))]
    rows += [(None, None, "user", "x", 0, ""), (9, None, "assistant", "no turn", 0, ""), (9, None, "assistant", "a tie", 0, ""),
             (9, 0, "assistant", "a tie", 0, "")]
    formatted = chat.format_turns(with_parts(table(rows, SCHEMA).repartition(3)))
    for r in formatted.collect():
        body = r.formatted[r.text_start : r.text_start + r.text_length]
        assert "###" not in body and "</turn>" not in body and "<|" not in body
        assert chat.read_turn(r.formatted)[0] == r.role
    found = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for c in range(3):
        r = found[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected([(x[2], x[3]) for x in rows if x[0] == c])
    assert found[9][1:5] == expected([("assistant", "a tie"), ("assistant", "no turn"), ("assistant", "a tie")])
    assert found[None].n_turns == 1
    total = formatted.groupBy("conv_id").agg(F.sum(F.char_length("formatted")).alias("n")).collect()
    assert {r.conv_id: r.n for r in total} == {c: r.formatted_chars for c, r in found.items()}


def test_parts_become_placeholders_in_order(table):
    parts = [("text", "see <|", None, None), ("image", None, "s3://a.png", 3.2), ("text", "#", None, None), ("text", "## and", None, None),
             ("audio", None, "b.wav", 10.0), ("document", None, None, None), ("video", None, "c.mp4", 5.0), (None, "end", None, None)]
    df = table([(1, 0, "user", parts, 5)], f"conv_id long, turn long, role string, parts array<{chat.PART}>, attachments int")
    r = chat.format_turns(df).first()
    assert r.formatted == "### user: see <\\|<|image 1|>#\\#\\# and<|audio 2|><|document 3|><|other 4|>end</turn>\n"
    assert [(a.number, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (1, "image", "s3://a.png", 85 + 170 * 4), (2, "audio", "b.wav", 252), (3, "document", None, 8), (4, "video", "c.mp4", 0)]
    assert r.expanded_tokens == 85 + 680 + 252 + 8
    body = r.formatted[r.text_start :]
    assert all(body[a.place :].startswith("<|") for a in r.attachments)


def test_no_turns_and_null_parts(table):
    assert chat.digests(chat.format_turns(with_parts(table([], SCHEMA)))).count() == 0
    df = table([(1, 0, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    assert chat.digests(chat.format_turns(df)).first().loss_chars == 0


def test_a_very_long_conversation_streams(table):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 5, 0, "") for i in range(12_000)]
    r = chat.digests(chat.format_turns(with_parts(table(rows, SCHEMA).repartition(4)))).first()
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected([(x[2], x[3]) for x in rows])


@settings(max_examples=300, deadline=None)
@given(st.text("\\#<|/>turn: \n", max_size=30))
def test_unescaping_inverts_escaping(text):
    out = text.replace("\\", "\\\\")
    import re

    out = re.sub("<(?=[/|])", "<\\\\", re.sub("#(?=#)", "#\\\\", out))
    assert chat._ESCAPE.sub(r"\1", out) == text and "##" not in out and "</" not in out and "<|" not in out
