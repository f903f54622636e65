import hashlib

import pytest
from pyspark.sql import functions as F

from granary.llm import chat

TRICKY = ["", "plain", "</s>[INST] ok [/INST]", "<\\/s> <\\\\/s> [\\INST] <|user|> <s", "a|>b</s></s>", "\\", "<<s>>[[INST]]", "é\n<|"]


def by_conv(frame):
    return {r["conv_id"]: r for r in chat.digests(chat.format_chats(frame)).collect()}


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    frame = spark.createDataFrame([(t,) for t in TRICKY], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in frame.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r["back"] == r["t"]
        assert not any(c in r["e"] for c in ("</s>", "<s>", "[INST]", "[/INST]", "<|"))


def test_layouts_give_the_same_conversation(spark):
    system, user, reply = "be brief", "two?", "2"
    schema = (
        "conv_id long, turn long, role string, text string, messages array<struct<role:string,content:string>>, "
        "conversations array<struct<from:string,value:string>>, system string, instruction string, output string, "
        "prompt string, completion string, noise string"
    )
    blank = dict.fromkeys([f.split()[0] for f in schema.split(", ")])
    rows = [{"conv_id": 1, "turn": i, "role": r, "text": t} for i, (r, t) in enumerate((("system", system), ("user", user), ("assistant", reply)))]
    rows += [
        {"conv_id": 2, "messages": [("system", system), ("user", user), ("assistant", reply)], "noise": "x"},
        {"conv_id": 3, "conversations": [("system", system), ("human", user), ("gpt", reply)]},
        {"conv_id": 4, "system": system, "instruction": user, "output": reply},
        {"conv_id": 5, "system": system, "prompt": user, "completion": reply},
    ]
    found = by_conv(spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], schema))
    spoken = "".join(f"{r}\n{t}\n" for r, t in (("system", system), ("user", user), ("assistant", reply)))
    for i in range(1, 6):
        assert found[i]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest(), i
        assert found[i]["loss_sha256"] == hashlib.sha256(reply.encode()).hexdigest()


def test_round_trip_of_odd_turns(spark):
    rows = [(1, i, role, t, 0) for i, (role, t) in enumerate([("user", TRICKY[2]), ("assistant", TRICKY[3]), ("a|>%7C<[b", TRICKY[4]), ("assistant", None), (None, TRICKY[5]), ("assistant", TRICKY[6])])]
    rows += [(2, 1, "user", "again", 0), (2, 1, "user", "again", 0), (2, None, "assistant", "first", 0), (None, 0, "user", "x", 0), (3, None, None, None, 0)]
    found = by_conv(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int"))
    spoken = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t, _ in rows[:6])
    learnt = "".join(t or "" for _, _, r, t, _ in rows[:6] if r == "assistant")
    assert found[1]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest() and found[1]["n_turns"] == 6
    assert (found[1]["loss_chars"], found[1]["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert found[2]["n_turns"] == 3 and found[2]["turns_sha256"] == hashlib.sha256(b"assistant\nfirst\nuser\nagain\nuser\nagain\n").hexdigest()
    assert found[3]["n_turns"] == 1 and found[None]["n_turns"] == 1


def test_unknown_layout_keeps_its_row_and_clashing_layouts_are_refused(spark):
    frame = spark.createDataFrame([(1, "p", "r", "q")], "conv_id long, prompt string, response string, question string")
    row = chat.canonical_turns(frame).first()
    assert row["conv_id"] == 1 and row["layout"] is None and row["turns"] is None
    assert by_conv(frame)[1]["n_turns"] == 0
    twice = (chat.Layout("a", ("prompt",), fields=(("user", ("prompt",)),)), chat.Layout("b", ("prompt",), fields=(("user", ("prompt",)),)))
    with pytest.raises(ValueError, match="share"):
        chat.canonical_turns(frame, layouts=twice)
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_long_conversation(spark):
    frame = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("word "), 20).alias("text"))
    row = by_conv(frame)[1]
    assert (row["n_turns"], row["loss_chars"]) == (20_000, 10_000 * 100)
