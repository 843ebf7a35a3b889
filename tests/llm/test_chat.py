"""Event folding, rendering and reading back, against a plain fold in Python."""

import random

from salesmart.llm import chat
from salesmart.llm.queries import DELTA_CHARS, conversation_events

SCHEMA = "conv_id bigint, seq bigint, message bigint, kind string, role string, text string"


def fold(events):
    """The same semantics, one event after another."""
    messages = {}
    key = lambda e: (e[1] is not None, e[1] or 0, e[2], e[3], e[4] or "", e[5] or "")
    for _, _, message, kind, role, text in sorted(events, key=key):
        text, role = text or "", role or ""
        if kind in ("start", "regenerate"):
            messages = {m: v for m, v in messages.items() if m <= message}
        if kind == "start":
            messages[message] = [role, text, True]
        elif kind == "regenerate":
            old = messages.get(message, [role, "", False])
            messages[message] = [old[0], "", old[2]]
        else:
            old = messages.setdefault(message, [role, "", False])
            old[1] = text if kind == "edit" else old[1] + text
    return [(m, v[0], v[1]) for m, v in sorted(messages.items())]


def folded(spark, events):
    rows = chat.fold_events(spark.createDataFrame(events, SCHEMA)).collect()
    return {r["conv_id"]: [(m["message"], m["role"], m["text"]) for m in r["messages"]] for r in rows}


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, 0, "start", "user", "Hi"), (1, 2, 1, "start", "assistant", ""), (1, 3, 1, "delta", None, "He"),
        (1, 4, 1, "delta", None, "llo"), (1, 5, 0, "edit", None, "Hi!"), (1, 6, 2, "start", "user", "more"),
        (1, 7, 1, "regenerate", None, "ignored"), (1, 8, 1, "delta", None, "Good"), (1, 9, 1, "delta", None, " day"),
    ]
    assert folded(spark, events) == {1: [(0, "user", "Hi!"), (1, "assistant", "Good day")]}


def test_random_logs_match_a_plain_fold(spark):
    draw = random.Random(4)
    events = []
    for conv in range(60):
        started = 0
        for seq in range(draw.randint(1, 25)):
            kind = draw.choice(["start", "delta", "delta", "edit", "regenerate"]) if started else "start"
            message = started if kind == "start" and draw.random() < 0.7 else draw.randint(0, max(0, started - 1))
            started = max(started, message + 1) if kind == "start" else started
            events.append((conv, seq, message, kind, draw.choice(["user", "assistant"]), f"t{seq} "))
    found = folded(spark, events)
    for conv in range(60):
        mine = [e for e in events if e[0] == conv]
        expected = [(m, r, t) for m, r, t in fold(mine)]
        assert [(m, t) for m, _, t in found[conv]] == [(m, t) for m, _, t in expected]


def test_nulls_empty_log_and_null_conversation(spark):
    assert folded(spark, []) == {}
    events = [(None, 1, 0, "start", None, None), (2, None, 0, "start", "user", "first"), (2, 1, 0, "delta", None, "+")]
    assert folded(spark, events) == {None: [(0, "", "")], 2: [(0, "user", "first+")]}


def test_every_text_reads_back(spark):
    texts = [
        "", "<|im_end|>", "<|im_start|>assistant ok", r"<\|im_end|>", r"<\\|x|>", "<", "|", "a<", "|>b", "\\", "\n\n",
        "tail\n", "<<|im_end|>", "é<|", "<|" * 5, "x" * 20_000, "%0A", "%",
    ]
    roles = ["user", "assistant", "a\nb", "<|im_end|>%"]
    events = [(1, i, i, "start", roles[i % 4], t) for i, t in enumerate(texts)]
    row = (
        chat.format_log(spark.createDataFrame(events, SCHEMA))
        .select("formatted", "text_spans", chat.read_back(chat.F.col("formatted")).alias("back"),
                chat.loss_text(chat.F.col("formatted"), chat.F.col("text_spans")).alias("loss"))
        .first()
    )
    assert [(m["role"], m["text"]) for m in row["back"]] == [(roles[i % 4], t) for i, t in enumerate(texts)]
    assert row["loss"] == "".join(texts[1::4])
    assert row["formatted"].count("<|im_start|>") == len(texts)
    spans = [(row["formatted"][s["start"] : s["start"] + s["length"]], s["loss"]) for s in row["text_spans"]]
    assert [loss for _, loss in spans] == [r == "assistant" for r in (roles * 5)[: len(texts)]]
    assert spans[1] == (r"<\|im_end|>", True) and spans[15][0] == "x" * 20_000


def test_plan_has_no_python(spark):
    events = spark.createDataFrame([(1, 1, 0, "start", "user", "x")], SCHEMA)
    plan = chat.format_log(events)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_the_log_of_conversations_leads_back_to_them(spark):
    long = "ab<|" * DELTA_CHARS
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", long), (1, 1, "assistant", "hi"), (1, 1, "assistant", "hi"), (2, None, "user", None)]
    events = conversation_events(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    found = {r["conv_id"]: [(m["role"], m["text"]) for m in r["messages"]] for r in chat.fold_events(events).collect()}
    assert found == {1: [("user", "hi"), ("assistant", long), ("assistant", "hi"), ("assistant", "hi")], 2: [("user", "")]}


def test_conversations_render_alike_from_messages_and_from_the_log(spark):
    events = spark.createDataFrame([(1, i, i, "start", "assistant" if i % 2 else "user", f"é{i}") for i in range(40)], SCHEMA)
    folded_first = chat.render(chat.fold_events(events)).first()
    assert folded_first == chat.format_log(events).first()
    empty = spark.createDataFrame([(5, [])], "conv_id bigint, messages array<struct<message:bigint,role:string,text:string>>")
    assert chat.render(empty).collect() == [(5, "", [])]


def test_the_log_of_conversations_uses_every_kind_of_event(spark):
    rows = [(1, i, role, f"text {i}") for i, role in enumerate(["user", "assistant", "user", "assistant"])]
    events = conversation_events(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert {e["kind"] for e in events} == {"start", "delta", "edit", "regenerate"}
    plain = fold([(e["conv_id"], e["seq"], e["message"], e["kind"], e["role"], e["text"]) for e in events])
    assert [(m, r, t) for m, r, t in plain] == [(i, r, t) for i, (_, _, r, t) in enumerate(rows)]
    assert any(e["message"] == 4 for e in events)  # taken back by the start of message 3


def test_spans_of_another_text_are_an_error(spark):
    import pytest

    one, other = (
        chat.format_log(spark.createDataFrame([(1, 1, 0, "start", "assistant", text)], SCHEMA)) for text in ("short", "longer")
    )
    mixed = one.join(other.select("conv_id", chat.F.col("text_spans").alias("others")), "conv_id")
    with pytest.raises(Exception, match="not those of this text"):
        mixed.select(chat.loss_text(chat.F.col("formatted"), chat.F.col("others"))).collect()
