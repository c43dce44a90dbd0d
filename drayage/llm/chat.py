"""Chat formatting with prefix-target expansion.

Each assistant turn becomes an example of its own: all turns before it are the context, and
only the text of the reply is trainable. Turns behind the last reply make one more example
without anything trainable, so that nothing of a conversation is lost.

Examples of a conversation share their beginnings, so they are kept by what each adds:
``added`` is the text from ``context_chars``, where the example before ended, to its own end.
The whole text of an example is all that the examples up to it add, and ``expanded`` writes
it out, which takes time in the square of the turns; ``read_back`` reads these texts. The trainable part is
``loss_start`` to ``loss_end`` in the whole text, in code points, ends exclusive.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Backslashes in roles and texts are doubled,
line ends in roles get one in front, and each control string gets one after its first
character, so that none is left; taking every backslash away but the one behind another
gives the text back.

Rows come by conversation and in order within it: by turn, nulls last, then by role and text,
so repeated turns stay and come next to each other. A null text or role counts as empty, a
null conversation id is an id of its own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.frames import numbered, pieces

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
TRAINABLE = "assistant"
#: Characters of written examples that go on together, but for a longer one.
HELD_CHARS = 1 << 22
# Control strings of this and of other templates.
CONTROLS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)


def escaped(text: Column) -> Column:
    """``text`` without control strings, such that :func:`unescaped` gives it back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """``conv_id``, ``example`` (from 0), ``n_turns`` that it adds, ``context_chars``, ``added``,
    ``loss_start`` and ``loss_end`` (null where nothing is trainable). One shuffle of the turns."""
    plain, names = numbered(turns)
    text = F.coalesce(F.col(names[text_col]).cast("string"), F.lit(""))
    role = F.coalesce(F.col(names[role_col]).cast("string"), F.lit(""))
    head = F.concat(F.lit(BEGIN), F.replace(escaped(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    body = escaped(text)
    rows = plain.select(
        F.col(names[conv_col]).alias("conv_id"), F.col(names[turn_col]).alias("turn"),
        role.alias("role"), text.alias("text"), F.length(head).alias("head"),
        F.length(body).alias("body"), F.concat(head, body, F.lit(END)).alias("segment"),
    )
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(partitions, "conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "role", "text"
    ).select("conv_id", (F.col("role") == TRAINABLE).alias("trainable"), "head", "body", "segment")
    schema = T.StructType([ordered.schema["conv_id"]])
    for name, kind in (("example", "long"), ("n_turns", "long"), ("context_chars", "long"), ("added", "string"),
                       ("loss_start", "long"), ("loss_end", "long")):
        schema = schema.add(name, kind)
    kind = schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = [to_arrow_type(kind), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), arrow)],
                ["conv_id", "example", "n_turns", "context_chars", "added", "loss_start", "loss_end"],
            )

        conv, number, at, waiting = _NONE, 0, 0, []
        for piece in pieces(batches):
            done = []
            for of, trainable, head, body, segment in zip(*(c.to_pylist() for c in piece.columns)):
                if of != conv:
                    if waiting:
                        done.append((conv, number, len(waiting), at, "".join(waiting), None, None))
                    conv, number, at, waiting = of, 0, 0, []
                waiting.append(segment)
                if trainable:
                    added = "".join(waiting)
                    start = at + len(added) - len(segment) + head
                    done.append((conv, number, len(waiting), at, added, start, start + body))
                    number, at, waiting = number + 1, at + len(added), []
            if done:
                yield batch(done)
        if waiting:
            yield batch([(conv, number, len(waiting), at, "".join(waiting), None, None)])

    return ordered.mapInArrow(run, schema)


_NONE = object()


def expanded(found: DataFrame) -> DataFrame:
    """``examples`` with ``text``, the context and the reply written out, in place of ``added``.

    ``found`` is as :func:`examples` gives it, a conversation's rows in order; they are read as a stream,
    of which the last text is held.
    """
    out = found.select("conv_id", "example", "context_chars", "added", "loss_start", "loss_end")
    schema = T.StructType([out.schema["conv_id"]]).add("example", "long").add("text", "string")
    schema = schema.add("loss_start", "long").add("loss_end", "long")

    def run(batches):
        conv, text = _NONE, ""
        for piece in pieces(batches):
            texts, held, first = [], 0, 0
            for k, (of, context, added) in enumerate(zip(*(piece.column(n).to_pylist() for n in (0, 2, 3)))):
                if of != conv:
                    conv, text = of, ""
                if context != len(text):
                    raise ValueError("examples of a conversation are not in order")
                text += added
                texts.append(text)
                held += len(text)
                if held > HELD_CHARS or k == piece.num_rows - 1:
                    rows = piece.slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), rows.column(1), pa.array(texts, pa.string()), rows.column(4), rows.column(5)], schema.names
                    )
                    texts, held, first = [], 0, k + 1

    return out.mapInArrow(run, schema)


def read_turns(added: str) -> list[tuple[str, str]]:
    """The roles and texts of formatted turns."""
    turns = []
    for segment in added.split(END)[:-1]:
        role, text = re.fullmatch(r"((?:\\.|[^\\\n])*)\n(.*)", segment[len(BEGIN) :], re.DOTALL).groups()
        turns.append((unescaped(role), unescaped(text)))
    return turns


def read_back(found: DataFrame) -> DataFrame:
    """What the examples of :func:`examples`, written out by :func:`expanded`, hold, one row per
    conversation: ``n_turns`` and the digest of its turns, ``loss_chars`` and the digest of the text
    under the loss masks, ``formatted_chars`` of the conversation, ``n_examples`` and
    ``example_chars`` of all examples. Each text must begin with the one before it, as its context."""
    written = expanded(found)
    fields = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars")
    schema = T.StructType([found.schema["conv_id"]])
    for name in fields:
        schema = schema.add(name, "string" if name.endswith("sha256") else "long")
    kind = schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = [to_arrow_type(kind), *[pa.string() if n.endswith("sha256") else pa.int64() for n in fields]]
        conv, state, done, before = _NONE, None, [], ""

        def closed():
            n, turns, chars, loss, length, count, total = state
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, count, total)

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), arrow)], ["conv_id", *fields]
            )

        for piece in pieces(batches, 64):
            for of, text, start, end in zip(*(c.to_pylist() for c in piece.columns)):
                if of != conv:
                    if state:
                        done.append(closed())
                    conv, state, before = of, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0], ""
                if not text.startswith(before):
                    raise ValueError("an example does not begin with its context")
                for role, said in read_turns(text[len(before) :]):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                before = text
                if start is not None:
                    reply = unescaped(text[start:end])
                    state[2] += len(reply)
                    state[3].update(reply.encode())
                state[4] = len(text)
                state[5] += 1
                state[6] += len(text)
            if done:
                yield batch(done)
                done = []
        if state:
            yield batch([closed()])

    return written.select("conv_id", "text", "loss_start", "loss_end").mapInArrow(run, schema)
