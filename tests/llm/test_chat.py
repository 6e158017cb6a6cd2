import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from rulegrove.llm import chat

PIECES = st.lists(st.sampled_from(list("\\<[|lbp>é😀\n") + ["<|end|>", "</s>", "[INST]"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_escape_round_trip(text):
    code = chat.escape(text)
    assert chat.unescape(code) == text
    assert not any(c in code for c in "<[|")


ROWS = [
    (1, 0, "system", "be <|end|> nice", "x"), (1, 1, "user", "hi", "x"), (1, 2, "assistant", "\\l <b> [INST] |>", "x"), (1, 3, "user", "more 😀", "x"),
    (1, 4, "assistant", "é" * 50, "x"), (1, 5, "user", "trailing", "x"), (2, 0, "user", None, None), (2, 1, "assistant", "", None), (2, 1, "assistant", "", None),
    (3, 0, "user", "alone", None), (None, 0, None, "who", None), (None, 1, "assistant", "reply\n", None), (4, 0, "assistant", "first", None), (5, 1, "a|>b", "odd role", None),
    (6, None, "user", "no turn", None), (6, 1, "assistant", "yes", None),
]


def test_read_back(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, formatted string")
    examples = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    convs = {}
    for c, t, role, text, _ in ROWS:
        convs.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    rows = {(r.conv_id, r.example): r for r in examples.collect()}
    assert {k for k in rows if k[0] == 1} == {(1, 0), (1, 1), (1, 2)}
    second = rows[1, 1]
    assert second.formatted.startswith(rows[1, 0].formatted) and not second.last and rows[1, 2].last and rows[1, 2].target_turn is None
    assert chat.unescape(second.formatted[second.loss_start : second.loss_start + second.loss_chars]) == "é" * 50


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(df)).collect() == []
