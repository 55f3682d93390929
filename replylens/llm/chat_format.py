r"""Chat formatting of typed content parts, with DataFrame functions only.

A message is a list of typed parts (text, image, audio, document). `flatten_parts` visits them in
order: text is kept, any other part becomes a placeholder `<|kind:n|>` with n counting the
attachments of the message, and is recorded as an attachment with its reference, its position among
the parts and the number of tokens that it expands to. `format_conversations` joins the turns of a
conversation by the template

    ### {role}\n{text}</turn>\n

and marks what the loss covers. `read_turns` reads turns and loss text back, `read_messages` typed parts with
their attachments.

Escaping: `\` becomes `\\`, a backslash goes after the first character of `</turn>`, after a `#`
that two more follow, after the first `<|` character of a placeholder look-alike, and a line end in a
role becomes `\n`. Decoding splits at `\\`, which is exact because a single backslash never comes
before another one, so control strings in texts, escaped or not, come back unchanged.

Loss spans are (turn, start, length): code points counted inside a turn's own segment, which ends
with `</turn>\n`; so reading them back costs no more than the length of the conversation.

Defined cases: null text, null role and null parts count as empty; turns are ordered by turn (null
first), ties by role, then by content; repeated rows are turns of their own; a null conv_id is a conversation;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
LEARNED_ROLES = ("assistant",)
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
# Tokens per attachment: image patches of 14 x 14 points, audio frames a second, document pages.
PATCH, FRAMES, PAGE = 14, 25, 512


# A placeholder until the texts around it are escaped; texts have no backslash but in pairs by then.
OPENED, CLOSED = "\\P{", "}"
PLACEHOLDER = r"<\|[^|\\]*:\d+\|>"


def doubled(text: Column) -> Column:
    return F.replace(text, F.lit("\\"), F.lit("\\\\"))


def broken(text: Column) -> Column:
    return F.regexp_replace(text, r"<(?=/turn>)|#(?=##)|<(?=\|)", r"$0\\")


def escape(text: Column) -> Column:
    return broken(doubled(text))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Undo `escape` and `escape_role`."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(plain, "\\")).otherwise(text)


def expanded_tokens(part: Column) -> Column:
    """Tokens that a part other than text expands to; 1 if its size is unknown."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    counted = (
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * FRAMES))
        .when(part["type"] == "document", part["pages"].cast("long") * PAGE)
    )
    return F.greatest(F.coalesce(counted, F.lit(1)), F.lit(1)).cast("long")


def flatten_parts(parts: Column) -> Column:
    """struct(content, attachments): escaped text with placeholders, and what they stand for."""
    parts = F.coalesce(parts.cast(PARTS), F.array().cast(PARTS))
    numbered = F.transform(parts, lambda p, i: F.struct(i.cast("int").alias("position"), p.alias("part")))
    other = F.filter(numbered, lambda x: ~F.equal_null(x["part"]["type"], F.lit("text")))
    kind = lambda p: F.coalesce(p["type"], F.lit("unknown"))
    attachments = F.transform(
        other,
        lambda x, n: F.struct(
            n.cast("int").alias("number"),
            x["position"].alias("position"),
            kind(x["part"]).alias("kind"),
            x["part"]["ref"].alias("ref"),
            expanded_tokens(x["part"]).alias("tokens"),
        ),
    )
    number_of = F.map_from_arrays(
        F.transform(attachments, lambda a: a["position"]), F.transform(attachments, lambda a: a["number"])
    )
    holder = lambda x: F.concat(
        F.lit(OPENED),
        F.regexp_replace(kind(x["part"]), r"[^A-Za-z0-9_-]", "_"),
        F.lit(":"),
        F.element_at(number_of, x["position"]).cast("string"),
        F.lit(CLOSED),
    )
    # Control strings may lie across neighbouring text parts, so these are broken up after joining.
    texts = F.transform(
        numbered, lambda x: F.when(x["part"]["type"] == "text", doubled(F.coalesce(x["part"]["text"], F.lit("")))).otherwise(holder(x))
    )
    joined = broken(F.array_join(texts, ""))
    opened = F.regexp_replace(joined, r"(?<!\\)((?:\\\\)*)\\P\{([A-Za-z0-9_-]+:\d+)\}", r"$1<|$2|>")
    only = F.coalesce(parts[0]["text"], F.lit(""))
    plain = (F.size(parts) == 1) & F.equal_null(parts[0]["type"], F.lit("text"))
    return F.struct(F.when(plain, escape(only)).otherwise(opened).alias("content"), attachments.alias("attachments"))


def text_parts(text: Column) -> Column:
    """The one text part of a plain message."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), none.cast("string").alias("ref"),
        none.cast("int").alias("width"), none.cast("int").alias("height"),
        none.cast("double").alias("seconds"), none.cast("int").alias("pages"),
    )
    return F.array(part)


def format_conversations(messages: DataFrame, learned=LEARNED_ROLES) -> DataFrame:
    """Messages (conv_id, turn, role, parts) to one row per conversation.

    Returns conv_id, formatted, loss_spans, attachments (with the index of their turn) and
    attachment_tokens. The segments are made per row, before the rows of a conversation meet.
    """
    flat = flatten_parts(F.col("parts"))
    role = F.coalesce(F.col("role"), F.lit(""))
    head = F.concat(F.lit("### "), escape_role(role), F.lit("\n"))
    turns = messages.select("conv_id", "turn", role.alias("role"), flat.alias("flat")).select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            F.concat(head, F.col("flat.content"), F.lit(END)).alias("segment"),
            F.char_length(head).alias("start"),
            F.char_length("flat.content").alias("length"),
            F.col("flat.attachments").alias("attachments"),
        ).alias("t"),
    )
    ordered = F.array_sort(F.collect_list("t"))
    spans = F.filter(
        F.transform("turns", lambda t, i: F.when(
            t["role"].isin(*learned),
            F.struct(i.cast("int").alias("turn"), t["start"].alias("start"), t["length"].alias("length")),
        )),
        lambda s: s.isNotNull(),
    )
    attached = F.flatten(
        F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: a.withField("turn", i.cast("int"))))
    )
    return (
        turns.groupBy("conv_id")
        .agg(ordered.alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
            spans.alias("loss_spans"),
            attached.alias("attachments"),
        )
        .withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Adds turns (role, text) and loss_text, both read back from `formatted` and `loss_spans`."""
    pieces = F.split("formatted", END, -1)
    segments = F.slice(pieces, 1, F.size(pieces) - 1)
    header_end = lambda s: F.instr(s, F.lit("\n"))
    turns = F.transform(
        "segments",
        lambda s: F.struct(
            unescape(F.substr(s, F.lit(5), header_end(s) - 5)).alias("role"),
            unescape(F.substr(s, header_end(s) + 1)).alias("text"),
        ),
    )
    learned = F.transform(
        "loss_spans",
        lambda p: unescape(F.substr(F.element_at("segments", p["turn"] + 1), p["start"] + 1, p["length"])),
    )
    return (
        formatted.withColumn("segments", segments)
        .withColumn("turns", turns)
        .withColumn("loss_text", F.array_join(learned, ""))
        .drop("segments")
    )


def read_messages(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts), one row per turn, read back from `formatted` and `attachments`.

    parts are (type, text, ref): the texts between placeholders, empty ones left out and neighbouring
    ones joined, and the attachments that the placeholders stand for.
    """
    pieces = F.split("formatted", END, -1)
    turn = F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1)).alias("turn", "segment")
    rows = formatted.select("conv_id", turn, "attachments")
    header_end = F.instr("segment", F.lit("\n"))
    role = unescape(F.substr("segment", F.lit(5), header_end - 5))
    texts = F.transform(
        F.split(F.substr("segment", header_end + 1), PLACEHOLDER, -1),
        lambda t: F.struct(F.lit("text").alias("type"), unescape(t).alias("text"), F.lit(None).cast("string").alias("ref")),
    )
    own = F.filter("attachments", lambda a: a["turn"] == F.col("turn"))
    held = F.transform(
        own, lambda a: F.struct(a["kind"].alias("type"), F.lit(None).cast("string").alias("text"), a["ref"].alias("ref"))
    )
    both = F.zip_with(texts, held, lambda t, a: F.array(F.when(t["text"] != "", t), a))
    return rows.select("conv_id", "turn", role.alias("role"), F.filter(F.flatten(both), lambda p: p.isNotNull()).alias("parts"))


def chat_report(conversations: DataFrame) -> DataFrame:
    """Per conversation, read back from the output: turns, loss text and lengths."""
    messages = conversations.select("conv_id", "turn", "role", text_parts(F.coalesce("text", F.lit(""))).alias("parts"))
    back = read_turns(format_conversations(messages))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("loss_spans").cast("long").alias("n_loss_spans"),
    )
