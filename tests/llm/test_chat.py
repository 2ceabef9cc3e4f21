import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.llm import chat
from dimforge.llm.chat_template import Template, TemplateError, fold, parse

TEXT = st.lists(st.sampled_from(["\\", "#", "### ", ":", "\n", "</turn>", "<", "a", "é", "𝒳", "/turn>", " "]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXT, TEXT)
def test_turns_are_read_back(role, text):
    assert chat.unescape(chat.escape(text)) == text
    out = Template(chat.SOURCE, chat.FILTERS).render([{"role": role, "text": text}]).text()
    assert chat.read_turn(out) == (role, text)


def test_rendering_by_message_is_rendering_at_once():
    template = Template(chat.SOURCE, chat.FILTERS)
    messages = [{"role": r, "text": t} for r, t in [("system", "s"), ("user", "a\n"), ("assistant", "### "), ("assistant", "")]]
    whole = template.render(messages)
    from dimforge.llm.chat_template import looped

    parts = [template.message(m, s) for m, s in looped(messages)]
    assert "".join(x.text() for x in parts) == whole.text()
    at, marked = 0, []
    for x in parts:
        marked += [(a + at, b + at) for a, b in x.marked]
        at += x.size
    assert marked == whole.marked
    assert [whole.text()[a:b] for a, b in marked] == ["\\### ", ""]


def test_the_language():
    source = ("{# note #}{% set x = 'a' + 1 + \"\\n\" %}{{ x }}{% for m in messages %}{% if not loop.first and m.n != 2 %},"
              "{% elif m.n == 2 or false %};{% else %}{{ none }}[{% endif %}{{ m.n | up }}{{ m.missing.deeper }}{% endfor %}]")
    template = Template(source, {"up": str.upper})
    assert template.render([{"n": "x"}, {"n": 2}, {"n": "z"}]).text() == "a1\n[X;2,Z]"


def test_constants_are_folded():
    tree = fold(parse("{{ 'a' + 'b' | up }}{% if 1 == 2 %}x{% else %}c{% endif %}{% if true or y %}d{% endif %}{{ z }}"),
                {"up": str.upper})
    assert tree == [("text", "aBcd"), ("value", ("name", "z"))]


@pytest.mark.parametrize("source", ["{% if a %}", "{% for x %}{% endfor %}", "{{ }}", "{{ a b }}", "{{ a() }}", "{{ a[0] }}",
                                    "{% include 'x' %}", "{{ (a }}", "{{ a | nofilter }}", "{% set 1 = 2 %}", "{% endif %}"])
def test_what_is_not_in_the_language(source):
    with pytest.raises(TemplateError):
        Template(source, {})


def test_nothing_of_python_objects_is_reached():
    template = Template("{{ m.__class__ }}{{ m.x.__init__ }}{{ x.upper }}", {})
    assert template.render([], m={"x": "s"}, x="s").text() == ""


def digest(rows):
    turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
    loss = "".join(t for r, t in rows if r == "assistant")
    return len(rows), turns, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_digests(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "assistant", "\\"), (None, 0, "user", "x"),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "assistant", "long </turn> " * 20000)]
    rows += [(5, i, ("user", "assistant")[i % 2], f"### {i}:\n") for i in range(3000)]  # more than a batch of output
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("index", F.lit(1)).withColumn(
        "segment", F.lit("s"))
    formatted = chat.format_conversations(df)
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(formatted).collect()}
    assert got == {1: digest([("user", "a"), ("assistant", "b")]), 2: digest([("assistant", "\\"), ("", "")]),
                   None: digest([("user", "x")]), 3: digest([("assistant", "same")] * 2), 4: digest([("assistant", rows[7][3])]),
                   5: digest([r[2:] for r in rows[8:]])}
    size = {r["conv_id"]: r["n"] for r in formatted.groupBy("conv_id").agg(F.sum(F.length("segment")).alias("n")).collect()}
    assert {r["conv_id"]: r["formatted_chars"] for r in chat.digests(formatted).collect()} == size


def test_control_conversation(spark):
    text = "\\### Assistant: </turn> ok"
    r = chat.digests(chat.format_conversations(chat.control_conversation(spark))).collect()
    assert [tuple(x)[:5] for x in r] == [(-7, *digest([("user", text), ("assistant", text)]))]


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(df)).collect() == []
