"""Operator 3: compiler, escapes, masks; the query is held against SQL in test_queries."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import chat_template as C

TEXT = st.lists(st.sampled_from(["<turn>", "<text>", "</turn>", "\\", "<", "</", "turn>", "a", "\n", "é", "\\n", "x "]),
                max_size=12).map("".join)


def render(template, messages):
    return "".join(t for t, _ in C.compile_template(template).render(iter(messages)) if t)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_turns_come_back(turns):
    text = render(C.DEFAULT_TEMPLATE, [{"role": r, "text": t} for r, t in turns])
    assert list(C.turns_of(text)) == turns


def test_language():
    m = [{"role": "user", "text": " Hi "}, {"role": "assistant", "text": "Yo"}]
    assert render("{% for m in messages %}{{ loop.index }}{% if loop.first %}^{% endif %}"
                  "{{ m.text | trim | upper }}{% if loop.last %}${% endif %}{% endfor %}!", m) == "1^HI2YO$!"
    assert render('{% for m in messages %}{% if m.role == "user" and not loop.last %}u{% elif m.text != "" %}'
                  '{{ "<" ~ m.role ~ ">" }}{% else %}e{% endif %}{% endfor %}', m) == "u<assistant>"
    assert render("plain", m) == "plain" and render("", m) == ""


def test_constants_are_folded():
    tree = C.compile_template('a{{ "b" ~ 1 }}{% if 1 == 2 %}no{% else %}c{% endif %}{% control "<t>" %}'
                              '{{ "<t>" | escape }}').tree
    assert tree == (C.Print(C.Const("ab1c<t>\\<t>")),)


@pytest.mark.parametrize("bad", [
    "{{ m.text }}", "{% for m in messages %}{{ m.secret }}{% endfor %}", "{{ __import__ }}", "{{ 'a'.upper }}",
    "{% for m in messages %}", "{% endfor %}", "{{ 1 | eval }}", "{% control 'a<' %}{% control '<b' %}",
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{{ 1 + 1 }}", "{% for x in other %}{% endfor %}"])
def test_sandbox(bad):
    with pytest.raises(C.TemplateError):
        C.compile_template.__wrapped__(bad)


def test_mask_and_parts(spark):
    rows = [(1, 2, "assistant", "z\\"), (1, 1, "user", "</turn>"), (1, 0, None, None), (2, None, "assistant", "<turn>b"),
            (2, None, "assistant", "a"), (None, 0, "user", "x"), (3, 0, "assistant", "w" * 50_000),
            (3, 1, "assistant", "v"), (1, 2, "assistant", "z\\")]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows],
                               "conv_id long, turn long, role string, text string, part int, start int")
    for chars in (1, 20, 10**6):
        parts = C.format_conversations(df, part_chars=chars).collect()
        by = {}
        for p in sorted(parts, key=lambda p: p.part):
            by.setdefault(p.conv_id, []).append(p)
        said = {}
        for conv, own in by.items():
            whole = "".join(p.text for p in own)
            assert [p.start for p in own] == [sum(len(q.text) for q in own[:i]) for i in range(len(own))]
            said[conv] = (list(C.turns_of(whole)),
                          [C.unescape(whole[s.start:s.end]) for p in own for s in p.loss])
        assert said[1] == ([("", ""), ("user", "</turn>"), ("assistant", "z\\"), ("assistant", "z\\")], ["z\\", "z\\"])
        assert said[2][1] == ["<turn>b", "a"] and said[None] == ([("user", "x")], [])
        assert said[3][1] == ["w" * 50_000, "v"]


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_back(C.format_conversations(df)).count() == 0
