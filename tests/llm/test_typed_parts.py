"""Typed parts there and back."""

import itertools
import random

from replylens.llm import chat_format

PIECES = ["<|image:0|>", "<", "|image:0|>", "</tur", "n>", "</turn>", "###", "#", "# a", "\\", "\\n", "n", "P{image:0}P\\", "\\P{", "", "ü\n", "<|", "|>", "a |> b"]


def joined(parts):
    """(type, text, ref) with neighbouring texts joined and empty ones left out."""
    out = []
    for is_text, group in itertools.groupby(parts, lambda p: p[0] == "text"):
        group = list(group)
        if is_text:
            text = "".join(p[1] or "" for p in group)
            out += [("text", text, None)] if text else []
        else:
            out += [(p[0] or "unknown", None, p[2]) for p in group]
    return out


def test_any_mix_of_parts_comes_back(spark):
    rng, rows = random.Random(7), []
    for i in range(400):
        parts = []
        for _ in range(rng.randrange(7)):
            kind = rng.choice(["text"] * 4 + ["image", "audio", "document", None])
            text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(4))) if kind == "text" else None
            parts.append((kind, text, None if kind == "text" else f"ref {rng.randrange(9)}", None, None, None, None))
        rows.append((i // 4, i % 4, rng.choice(["user", "a\\n b\n</turn>", None, "### x"]), parts))
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    formatted = chat_format.format_conversations(df)
    got = {(r.conv_id, r.turn): (r.role, [tuple(p) for p in r.parts]) for r in chat_format.read_messages(formatted).collect()}
    assert got == {(c, t): (role or "", joined(parts)) for c, t, role, parts in rows}


def test_placeholders_and_look_alikes_differ(spark):
    parts = [[("text", "<|image:0|>", None, None, None, None, None), ("image", None, "real", 28, 28, None, None)]]
    df = spark.createDataFrame([(1, 0, "user", p) for p in parts], f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    row = chat_format.format_conversations(df).first()
    assert row.formatted == "### user\n<\\|image:0|><|image:0|></turn>\n"
    assert [tuple(a) for a in row.attachments] == [(0, 1, "image", "real", 4, 0)]
