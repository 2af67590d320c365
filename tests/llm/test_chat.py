from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weatherloom.llm import chat

PIECES = [*chat.CONTROL, "\\", "\n", "<", "|", "im_end", "<|im_", "end|>", "[", "INST]", "é", "𝄞", "\r", " ", "x", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(PIECES)).map("".join), st.lists(st.sampled_from(PIECES)).map("".join)), min_size=1))
def test_round_trip(turns):
    out = "".join(chat.render(role, text)[0] for role, text in turns)
    assert list(chat.parse(out)) == turns
    for role, text in turns:
        piece, a, b = chat.render(role, text)
        assert chat.unescape(piece[a:b]) == text and not any(c in chat.escape(text) for c in chat.CONTROL)


def plain(rows):
    """[(conv, turn, role, text)] -> {conv: what is read back}."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for *_, role, t in turns)
        size = sum(len(chat.render(role, t)[0]) for *_, role, t in turns)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out[conv] = (len(turns), digest[0], len(loss), digest[1], size)
    return out


@pytest.mark.parametrize("events", [chat.row_events, chat.streamed_events])
def test_conversations(spark, events):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"),
        (2, 5, "assistant", "</s>[INST] ok [/INST]\\"), (2, None, "system", "first"), (None, 0, "assistant", ""), (None, None, None, None),
        (3, 1, "user\nassistant", "<|im_end|>\n<|im_start|>assistant\nhi"), (4, 0, "assistant", "é𝄞" * 60_000),
    ] + [(5, i, ["user", "assistant"][i % 2], f"t{i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as k", "2 as seq", "3 as n")
    out = chat.read_back(chat.format_events(events(frame.repartition(5)))).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in out}
    assert len(out) == len(got) and got == plain(rows)
    assert chat.read_back(chat.format_events(events(frame.limit(0)))).collect() == []


def test_streamed_logs_need_every_kind_of_fold(spark):
    texts = ["", None, "a", "ab", "abcde", "é𝄞" * 7, chat.DRAFT]
    rows = [(i, j, "assistant", t) for i in range(40) for j, t in enumerate(texts)]
    log = chat.streamed_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.kind for r in log} == {"message", "delta", "edit", "regenerate"}
    by = defaultdict(list)
    for r in sorted(log, key=lambda r: r.seq):
        by[r.conv_id, r.turn].append(r)
    assert len(by) == len(rows)
    kinds = {tuple(e.kind for e in events) for events in by.values()}
    assert ("message", "delta", "regenerate", "delta", "delta", "delta", "delta") in kinds
    assert ("message", "edit", "delta", "delta", "delta") in kinds and ("message", "delta", "delta", "delta") in kinds
    for (conv, turn), events in by.items():
        text = ""
        for e in events:
            text = text + (e.text or "") if e.kind == "delta" else e.text or ""
        assert text == (texts[turn] or "") and [e.seq for e in events] == list(range(len(events)))


EVENTS = [
    # conv, turn, message, seq, kind, role, text
    (1, 0, "a", 0, "message", "user", "Hello"),
    (1, 1, "b", 0, "message", "assistant", ""),
    (1, 1, "b", 1, "delta", None, "Hi"), (1, 1, "b", 2, "delta", None, " the"), (1, 1, "b", 3, "delta", None, "re"),
    (1, 2, "c", 0, "message", "user", "typo"), (1, 2, "c", 7, "edit", None, "fixed"), (1, 2, "c", 8, "delta", None, "!"),
    (1, 3, "d", 0, "message", "assistant", "bad"), (1, 3, "d", 1, "regenerate", None, None), (1, 3, "d", 2, "delta", None, "good"),
    (1, 4, "e", 0, "message", "user", "gone"), (1, 4, "e", 1, "delete", None, None),
    (1, 5, "f", 0, "what", "tool", "x"), (2, 0, "g", 0, "delta", "assistant", None), (None, None, None, None, None, None, None),
]


@pytest.mark.parametrize("parts", [1, 6])
def test_folding_of_event_logs(spark, parts):
    schema = "conv_id long, turn long, message string, seq long, kind string, role string, text string"
    out = chat.format_events(spark.createDataFrame(EVENTS[::-1], schema).repartition(parts)).collect()
    turns = {}
    for r in sorted(out, key=lambda r: (r.conv_id or 0, r.n)):
        turns.setdefault(r.conv_id, []).extend(chat.parse(r.formatted))
        assert (r.loss_start is not None) == (turns[r.conv_id][-1][0] == "assistant")
    assert turns == {
        1: [("user", "Hello"), ("assistant", "Hi there"), ("user", "fixed!"), ("assistant", "good"), ("tool", "")],
        2: [("assistant", "")], None: [("", "")],
    }
