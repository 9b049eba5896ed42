import hashlib

from factpanel.llm import chat

ODD = "\\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "user", ODD, "x"), (1, 1, "assistant", ODD, "x"), (None, None, None, None, "x"),
    (2, 0, "a\\n\n#b", None, "x"), (2, 1, "assistant", "x\n\\n<\\l😀", "x"), (2, 1, "assistant", "x\n\\n<\\l😀", "x"), (2, 1, "assistant", "", "x"),
    (3, 1, "assistant", "late" * 1000, "x"), (3, None, "system", "first", "x"),
    *[(4, i, "assistant" if i % 2 else "user", f"t{i} #", "x") for i in range(500)],
]
KINDS = "conv_id long, turn long, role string, text string, block string"


def test_reading_gives_the_turns_and_the_learned_text(spark):
    found = {r.conv_id: r for r in chat.written_and_read(spark.createDataFrame(ROWS, KINDS)).collect()}
    assert set(found) == {r[0] for r in ROWS}
    for conv, r in found.items():
        own = [(-1 if t is None else t, role or "", text or "") for c, t, role, text, _ in ROWS if c == conv]
        own.sort()
        plain = "".join(f"{role}\n{text}\n" for _, role, text in own)
        learned = "".join(text for _, role, text in own if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(own), len(learned))
        assert r.turns_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_a_long_conversation_is_many_parts(spark):
    parts = chat.format_conversations(spark.createDataFrame(ROWS, KINDS)).where("conv_id = 4")
    assert parts.count() == 8


def test_many_messages_of_one_place_are_many_parts(spark):
    rows = [(1, 7, "user" if i % 3 else "assistant", f"{i % 40} <", "x") for i in range(5000)] + [(1, None, "user", "n", "x")] * 700
    parts = chat.format_conversations(spark.createDataFrame(rows, KINDS).repartition(3))
    sizes = parts.selectExpr("size(split(formatted, '</turn>')) - 1 AS n").collect()
    assert max(r.n for r in sizes) <= chat.BLOCK_MESSAGES and sum(r.n for r in sizes) == 5700
    own = sorted((-1 if t is None else t, role, text) for _, t, role, text, _ in rows)
    found = chat.digests(parts).first()
    assert found.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
    assert found.loss_sha256 == hashlib.sha256("".join(t for _, r, t in own if r == "assistant").encode()).hexdigest()


def test_events_are_folded(spark):
    events = [
        (1, 0, "m", "user", 0, "delta", "dra"), (1, 0, "m", "user", 1, "delta", "ft"), (1, 0, "m", "user", 2, "edit", "new"),
        (1, 0, "m", "user", 3, "delta", "er"), (1, 1, "n", "assistant", 0, "delta", "bad"),
        (1, 1, "n", "assistant", 5, "regenerate", "ignored"), (1, 1, "n", "assistant", 9, "delta", "good"),
        (1, 1, "n", "assistant", 9, "delta", " again"), (1, 2, "o", None, None, None, None), (1, 3, "p", "user", 1, "edit", "kept"),
        (1, 3, "p", "user", 1, "delta", "gone"),
    ]
    kinds = "conv_id long, place long, message string, role string, sequence long, kind string, text string"
    found = chat.fold_events(spark.createDataFrame(events, kinds)).orderBy("place").collect()
    assert [r.text for r in found] == ["newer", " againgood", "", "kept"]


def test_no_python_in_the_plan(spark):
    parts = chat.format_conversations(spark.createDataFrame(ROWS, KINDS))
    for df in (parts, chat.digests(parts)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_no_conversations(spark):
    assert chat.written_and_read(spark.createDataFrame([], KINDS)).collect() == []
