"""Formatting conversations with a compiled template, and reading them back.

The template marks each turn and puts a backslash before every control string
inside a text, so that the formatted text can be read back exactly.  Turns are
rendered in order within Spark's sorted partitions, one at a time: a
conversation may have any number of turns.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.chat_template import Template, looped
from dimforge.llm.shared import batch_of, pick

# Control strings of the format; texts and roles have a backslash before them.
HEAD, COLON, END = "### ", ":\n", "</turn>"
CONTROL = re.compile(r"\\|### |:\n|</turn>")
READ = re.compile(r"\\(\\|### |:\n|</turn>)|(### |:\n|</turn>)")

SOURCE = """{% for message in messages %}{% if loop.first %}{{ '<conversation>' + '\\n' }}{% endif %}### {{ message.role | escape }}:
{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}{% else %}{{ message.text | escape }}{% endif %}</turn>
{% if loop.last %}</conversation>{% endif %}{% endfor %}"""


def escape(text: str) -> str:
    """A backslash before each control string and backslash."""
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return READ.sub(lambda m: m[1] if m[1] is not None else m[0], text)


FILTERS = {"escape": escape, "trim": str.strip}


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    start = segment.index(HEAD) + len(HEAD)
    fields: list[str] = []
    for m in READ.finditer(segment, start):
        if m[2] is not None and m[2] == (COLON, END)[len(fields)]:
            fields.append(segment[start:m.start()])
            start = m.end()
            if len(fields) == 2:
                return unescape(fields[0]), unescape(fields[1])
    raise ValueError("not a formatted turn")


_SEGMENT = pa.schema([("conv_id", pa.int64()), ("index", pa.int64()), ("segment", pa.string()),
                      ("loss", pa.list_(pa.list_(pa.int64()))), ("last", pa.bool_())])


def _conversations(batches, columns):
    """Rows of sorted batches, a conversation after the other: (conv_id, iterator over its rows)."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in range(columns)), strict=True))
    held = next(rows, None)
    while held is not None:
        conv = held[0]

        def own(conv=conv):
            nonlocal held
            while held is not None and held[0] == conv:
                row, held = held, next(rows, None)
                yield row
        items = own()
        yield conv, items
        for _ in items:  # what the caller has left
            pass


def _render(source):
    def run(batches):
        template = Template(source, FILTERS)
        out = []
        for conv, turns in _conversations(batches, 3):
            at = 0
            for (_, role, text), state in looped(turns):
                got = template.message({"role": role or "", "text": text or ""}, state)
                out.append((conv, state["index"], got.text(), [[a + at, b + at] for a, b in got.marked], state["last"]))
                at += got.size
                if len(out) == 500:
                    yield batch_of(_SEGMENT, *zip(*out, strict=True))
                    out = []
        if out:
            yield batch_of(_SEGMENT, *zip(*out, strict=True))
    return run


def format_conversations(conversations: DataFrame, source: str = SOURCE) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> a row per turn: its part of the formatted conversation.

    Columns: conv_id, index (from 1), segment, loss (pairs of code point offsets
    into the whole formatted conversation that the loss covers), last.  The
    segments of a conversation joined in order are its formatted text; they come
    in order within one partition.  Rows go by turn, then role, then text; null
    role or text is empty, a null turn comes first, rows without conv_id are one
    conversation; repeated rows are turns of their own; an empty table gives no
    rows.  Other columns are ignored.
    """
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text")
            .mapInArrow(_render(source), "conv_id long, index long, segment string, loss array<array<long>>, last boolean"))


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_back(batches):
    out = []
    for conv, segments in _conversations(batches, 5):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = loss_chars = size = 0
        for _, _, segment, marked, _ in segments:
            role, text = read_turn(segment)
            turns.update(f"{role}\n{text}\n".encode())
            for a, b in marked:
                under = unescape(segment[a - size:b - size])
                loss.update(under.encode())
                loss_chars += len(under)
            n, size = n + 1, size + len(segment)
        out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), size))
        if len(out) == 2000:
            yield batch_of(_DIGEST, *zip(*out, strict=True))
            out = []
    if out:
        yield batch_of(_DIGEST, *zip(*out, strict=True))


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the output of ``format_conversations`` gives: a row per conversation.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    return formatted.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                            "loss_sha256 string, formatted_chars long")


def control_conversation(spark) -> DataFrame:
    """Conversation -7, whose texts hold the format's own control strings."""
    text = "\\### Assistant: </turn> ok"
    return (spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(text).alias("text")))


DIGEST_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (30 + sum(14 + length(role) + length(text) + len(regexp_extract_all(role, '\\|### |:\n|</turn>'))
                 + len(regexp_extract_all(text, '\\|### |:\n|</turn>'))))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
