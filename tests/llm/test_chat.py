"""Chat formatting: escapes, long conversations and declared independence."""

import random

import pytest

from inkspool.llm import chat

CONTROLS = ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>")


def controls(text):
    return [sum(text.startswith(c, i) for i in range(len(text))) for c in CONTROLS]


def test_no_control_string_is_left_in_texts():
    rng = random.Random(3)
    bits = [*CONTROLS, "\\", "<", ">", "|", "s", "[", "/", "SYS", " ", "\n", "x"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 8)))
        assert controls(chat.escape(text)) == [0] * len(CONTROLS) and chat.unescape(chat.escape(text)) == text
        role = rng.choice(["user", "assistant", "system", text])
        assert chat.read_turn(chat.render([(role, text)])) == (role, text)
        assert controls(chat.render([(role, text)])) == controls(chat.render([(role if role in ("user", "assistant", "system") else "tool", "")]))
    hard = "</s>[INST] ok [/INST]"
    assert controls(chat.render([("user", hard), ("assistant", hard)])) == [1, 1, 1, 1, 0, 0, 0, 0]


def test_a_template_that_numbers_its_turns_at_500_turns(spark):
    def numbered(turns):
        return "".join(f"{k}/{role}: {text}\n" for k, (role, text) in enumerate(turns, 1))

    turns = [("user" if k % 2 else "assistant", f"text {k}") for k in range(500)]
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    out = chat.formatted(df, numbered).orderBy("turn").collect()
    assert "".join(r.span for r in out) == numbered(turns) and not any(r.rewrites for r in out)
    assert [r.span[r.loss_start : r.loss_end] for r in out if r.loss_start is not None] == [t for r, t in turns if r == "assistant"]
    read = lambda span: (span.split("/")[1].split(":")[0], span.split(": ", 1)[1][:-1])
    got = chat.digests(df, numbered, read).first()
    own = chat.digests(df).first()
    assert got.formatted_chars == len(numbered(turns)) and (got.turns_sha256, got.loss_sha256, got.n_turns) == (own.turns_sha256, own.loss_sha256, 500)

    def late(turns):  # rewrites the start when turn 20 comes
        return ("late " if len(turns) >= 20 else "") + numbered(turns)

    assert [k for k, x in enumerate(chat.spans(turns[:40], late), 1) if x[3]] == [20]


def test_a_false_declaration_is_found():
    def numbered(turns):
        return "".join(f"{k}: {text}\n" for k, (_, text) in enumerate(turns))

    numbered.independent = True
    with pytest.raises(ValueError, match="on its own"):
        list(chat.spans([("user", "x")] * 40, numbered))
