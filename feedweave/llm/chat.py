r"""Chat formatting: turns of typed content parts to marked text, and back.

A turn is ``### role: text</turn>`` and a line end. A visitor walks its parts in order: text is escaped; an image,
audio or document part becomes a numbered placeholder ``<|image 3|>``, recorded with its reference and the tokens it
expands to. Inside texts a backslash is doubled, and one is put between ``##``, ``</`` and ``<|``, so none of the control strings
occurs there; taking one backslash off every escaped character gives the text back. The loss mask is the span of
an assistant turn's text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLE_MARK, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"

#: Tokens of a placeholder by kind: a fixed number, and some for each unit of the part's ``extent``
#: (tiles of an image, seconds of audio, pages of a document).
EXPANSION = {"image": (85, 170), "audio": (2, 25), "document": (8, 500)}

PART = "struct<kind:string,text:string,ref:string,extent:double>"
FORMATTED = "conv_id, turn, role, formatted, text_start, text_length, in_loss, attachments, expanded_tokens"


def escaped(text) -> F.Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(text, "#(?=#)", r"#\\"), "<(?=[/|])", r"<\\")


def text_part(text) -> F.Column:
    """One text part; a null text is an empty one."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("extent")))


def _expansion(part) -> F.Column:
    out = F.lit(0)
    for kind, (fixed, each) in EXPANSION.items():
        out = F.when(part.kind == kind, fixed + each * F.ceil(F.greatest(F.coalesce(part.extent, F.lit(0.0)), F.lit(0.0)))).otherwise(out)
    return out.cast("long")


def _visit(state, part) -> F.Column:
    """Append one part: text as it is, anything else as the next placeholder."""
    number = F.size(state.attachments) + 1
    kind = F.coalesce(part.kind, F.lit("text"))
    name = F.when(kind.isin(*EXPANSION), kind).otherwise(F.lit("other"))
    mark = F.concat(F.lit("<|"), name, F.lit(" "), number.cast("string"), F.lit("|>"))
    entry = F.struct(number.alias("number"), kind.alias("kind"), part.ref.alias("ref"),
                     (F.char_length(state.text)).alias("place"), _expansion(part).alias("tokens"))
    plain = kind == "text"
    text = escaped(F.coalesce(part.text, F.lit("")))
    # Two texts in a row must not make a control string either.
    meets = (F.endswith(state.text, F.lit("#")) & F.startswith(text, F.lit("#"))) | (
        F.endswith(state.text, F.lit("<")) & F.substring(text, 1, 1).isin("/", "|"))
    text = F.when(meets, F.concat(F.lit("\\"), text)).otherwise(text)
    return F.struct(
        F.concat(state.text, F.when(plain, text).otherwise(mark)).alias("text"),
        F.when(plain, state.attachments).otherwise(F.concat(state.attachments, F.array(entry))).alias("attachments"))


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted turns of ``turns`` (conv_id, turn, role, parts), a row each and no shuffle.

    ``formatted`` is the marked text, ``text_start`` and ``text_length`` (code points) its content, ``in_loss`` says whether the
    content is learnt, ``attachments`` lists number, kind, reference, place in the content and tokens of every
    placeholder, ``expanded_tokens`` sums them. Null parts are no part, a null role is the empty one, a part of an
    unknown kind is kept as an attachment of no tokens. Conversation and turn may be null. Other columns are left out.
    """
    empty = F.struct(F.lit("").alias("text"), F.lit([]).cast(
        "array<struct<number:int,kind:string,ref:string,place:int,tokens:bigint>>").alias("attachments"))
    parts = F.coalesce(F.col("parts"), F.lit([]).cast(f"array<{PART}>"))
    visited = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                           F.aggregate(parts, empty, _visit).alias("v"))
    head = F.concat(F.lit(ROLE_MARK), F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\:")), F.lit(ROLE_END))
    return visited.select(
        "conv_id", "turn", "role", F.concat(head, F.col("v.text"), F.lit(TURN_END)).alias("formatted"),
        F.char_length(head).alias("text_start"), F.char_length("v.text").alias("text_length"),
        (F.col("role") == LOSS_ROLE).alias("in_loss"), F.col("v.attachments").alias("attachments"),
        F.aggregate(F.col("v.attachments"), F.lit(0).cast("long"), lambda n, a: n + a.tokens).alias("expanded_tokens"))


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = _TURN.fullmatch(formatted).groups()
    return _ESCAPE.sub(r"\1", role), _ESCAPE.sub(r"\1", text)


def digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its formatted turns in order.

    Turns are ordered by number, null first, then by role and content. They stream past, sorted on disk by Spark:
    a task holds a few turns and the running digests, whatever a conversation's length.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    ordered = formatted.select("conv_id", "turn", "role", "formatted", "text_start", "text_length", "in_loss").repartition(
        "conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")

    def run(batches):
        current, state, out = None, None, []

        def done():
            n, turns, chars, loss, total = state
            return current[0], n, turns.hexdigest(), chars, loss.hexdigest(), total

        def table():
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=[f.split(" ")[0] for f in schema.split(", ")])

        for batch in batches:
            columns = [batch.column(i) for i in (0, 3, 4, 5, 6)]
            for conv, text, start, length, in_loss in zip(*(c.to_pylist() for c in columns)):
                if current is None or current[0] != conv:
                    if current is not None:
                        out.append(done())
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, content = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{content}\n".encode())
                if in_loss:
                    learnt = _ESCAPE.sub(r"\1", text[start : start + length])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
            if len(out) >= 1000:
                yield table()
                out = []
        if current is not None:
            out.append(done())
        yield table()

    return ordered.mapInArrow(run, schema)
