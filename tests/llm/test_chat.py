"""Chat formatting: round trips of hostile texts, digests by brute force, nulls, ties, repeats, empty tables."""

import hashlib
import random

import pytest

from aftermath.llm import chat, queries
from tests.compare import DATA, compare, duck

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, mask_start string, source_hash int"
CLASH = ("f", "m", 1)
PARTS = ["[", "]", "/", "\\", "<", ">", "s", "INST", "/INST", "[INST]", "[/INST]", "</s>", "<s>", "[\\INST]", "<\\\\/s>", "[TURN]", " ", "\n", "é", "SYS", "[/TURN]"]


def hostile(seed: int) -> str:
    chooser = random.Random(seed)
    return "".join(chooser.choices(PARTS, k=chooser.randrange(12)))


def test_every_conversation_reads_back():
    template = chat.Template()
    for seed in range(3000):
        roles = random.Random(seed).choices(["user", "assistant", "system", "tool", "", "a b\n%[INST]"], k=3)
        turns = [(role, hostile(3 * seed + i)) for i, role in enumerate(roles)]
        text = template.formatted(turns)
        assert template.recovered(text) == turns
        assert text == "".join(template.formatted([turn]) for turn in turns)
        for role, body in turns:
            assert template.unescaped(template.escaped(body)) == body


def test_only_conflicts_are_escaped():
    template = chat.Template()
    for text in ("plain", "[INST", "< s>", "a [inst] b", "\\", "[\\", "x <", "[TURN"):
        assert template.formatted([("user", text)]) == f"[INST] {text} [/INST]\n"
    assert template.formatted([("user", "[INST]")]) == "[INST] [\\INST] [/INST]\n"
    assert template.formatted([("user", "[\\INST]")]) == "[INST] [\\\\INST] [/INST]\n"


def test_parser_refuses_what_the_grammar_does_not_allow():
    template = chat.Template()
    for text in ("x", "[INST]x [/INST]\n", "[INST] x[/INST]\n", "[INST] x [/INST]", "[INST] x </s>\n", "[INST] [/INST]\n", "[TURN]x [/TURN]\n", "[/INST]"):
        with pytest.raises(chat.GrammarError):
            template.parsed(text)
    with pytest.raises(chat.GrammarError) as fault:
        template.parsed("[INST] x [/INST]\n<s> [INST] </s>\n")
    assert [t.role for t in fault.value.turns] == ["user"] and fault.value.place == 17


def test_templates_with_ambiguous_markers_are_refused():
    for pair in (("[a]", "[a]"), ("x", "[/a]"), ("[a b]", "[/a]"), ("[a]", "[a]b"), ("ab", "bc"), ("[a\\]", "[/a]"), ("<|a|", "|b>")):
        with pytest.raises(ValueError):
            chat.Template({"user": pair})
    other = chat.Template({"user": ("<|user|>", "<|end|>")}, ("<|other|>", "<|stop|>"), ())
    for seed in range(200):
        turns = [("user", hostile(seed) + "<|user|>" + hostile(seed + 1) + "<|end|><|stop|>")]
        assert other.recovered(other.formatted(turns)) == turns


def brute(rows):
    template, found = chat.Template(), {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, template.formatted([(r[2] or "", r[3] or "")])))]
        loss = "".join(t for role, t in turns if role == "assistant")
        found[conv] = (
            len(turns),
            hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            len(template.formatted(turns)),
        )
    return found


def test_digests_against_brute_force(spark):
    rows = [(c, t, ["user", "assistant", "system", "tool", None][(c + t) % 5], hostile(31 * c + t), *CLASH) for c in range(40) for t in range(5)]
    rows += [(7, 2, "assistant", None, *CLASH), (7, None, "assistant", "last", *CLASH), (None, 0, "user", "x", *CLASH), (None, 0, "user", "x", *CLASH)]
    rows += [(50, 0, "assistant", "word " * 200_000 + "</s>", *CLASH), (51, 0, "user", "", *CLASH)]
    rows += [(60, i, "assistant", f"turn {i}", *CLASH) for i in range(3000)]
    got = chat.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows) and len(got) == 44
    assert chat.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_masks_show_assistant_texts_only(spark):
    rows = [(1, 0, "user", "ask", *CLASH), (1, 1, "assistant", "<s>", *CLASH)]
    got = {r.role: r for r in chat.formatted_turns(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["user"].mask_start is None and got["assistant"].formatted[got["assistant"].mask_start : got["assistant"].mask_end] == "<\\s>"


def test_query_against_its_sql(spark):
    folder = DATA / "sf0.01"
    assert compare(queries.op12_chat(spark, str(folder)), duck(folder), queries.OP12_CHAT) is None
