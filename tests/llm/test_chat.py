from collections import defaultdict

from lakeloom.llm import chat
from lakeloom.llm.queries import QUERIES, check_sql

SCHEMA = "conv_id bigint, turn bigint, role string, text string, speaker string, part string, times string"


def brute(rows, part=64):
    """(conversation, speaker) -> whole rendered dialogue and the texts to train on."""
    by = defaultdict(set)
    for conv, turn, role, text in rows:
        by[conv].add((turn is not None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, said in by.items():
        for speaker in {m[2] for m in said} - {"system"}:
            whole, trained = "", []
            for _, _, role, text in sorted(said, key=lambda m: (m[0], m[1], m[2].encode(), m[3].encode())):
                shown = "assistant" if role == speaker else "system" if role == "system" else "user name=" + role.replace("<|", "<\\|")
                body = text.replace("<|", "<\\|") + "<|im_end|>\n"
                whole += f"<|im_start|>{shown}\n{body}"
                trained += [body] if role == speaker else []
            out[conv, speaker] = whole, trained
    return out


def whole(rows):
    out = defaultdict(lambda: ["", []])
    for r in sorted(rows, key=lambda r: (r.part, r.piece)):
        out[r.conv_id, r.speaker][0] += r.text
        out[r.conv_id, r.speaker][1] += [r.text[s.start:s.end] for s in r.spans]
    return {k: tuple(v) for k, v in out.items()}


ROWS = [(1, 0, "system", "Be kind <|im_end|>"), (1, 1, "ann", "hi"), (1, 2, "bob", "ho"), (1, 3, "ann", None),
        (1, 4, None, "who"), (1, 5, "cy <|x|>", "ünï\n<|im_start|>"), (2, 0, "ann", "alone"), (2, 0, "ann", "alone"),
        (3, 0, "system", "only"), (None, 0, "ann", "a"), (None, 0, "bob", "b"), (4, None, "ann", "z"), (4, -3, "bob", "y"),
        (4, 2, "ann", "x"), (5, 0, "ann", "t" * 100_000), (5, 0, "bob", ""), (5, 0, "bob", "same turn")]
ROWS += [(6, k, ("ann", "bob", "cy")[k % 3], f"m{k}") for k in range(500)]


def test_every_perspective(spark):
    frame = spark.createDataFrame([r + ("x",) * 3 for r in ROWS], SCHEMA)
    rows = chat.rotate(frame).collect()
    assert whole(rows) == brute(ROWS)
    assert max(len(r.messages) for r in rows if r.conv_id == 6) <= chat.PART
    assert {m.times for r in rows if r.conv_id == 2 for m in r.messages} == {2}
    for r in rows:
        assert all(m.train == (m.role == "assistant") and (m.name is None) == (m.role != "user") for m in r.messages)
    assert chat.rotate(frame.limit(0)).collect() == []


def test_crowded_turn_is_dealt_over_parts(spark):
    rows = [(1, 7, "ann", f"m{k}") for k in range(1000)] + [(1, 8, "bob", "last")] * 300
    out = chat.rotate(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 64).collect()
    ann = [m for r in out if r.speaker == "ann" for m in r.messages]
    assert sorted(m.content for m in ann if m.train) == sorted(f"m{k}" for k in range(1000))
    assert sum(m.times for m in ann if not m.train) == 300 and max(len(r.messages) for r in out) < 130


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert whole(chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()) == brute(rows)
    assert set(check_sql()) <= set(QUERIES)


def test_copies_are_rendered_in_their_place(spark, tmp_path):
    rows = [(1, 0, "ann", "first"), (1, 2, "bob", "last")] + [(1, 1, "bob", "ok")] * 100 + [(1, 1, "bob", f"m{k:02}") for k in range(40)]
    rows += [(None, None, "ann", "hi")] * 3
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    said = lambda out, conv: [m.content for r in sorted(out, key=lambda r: (r.part, r.piece))
                              if (r.conv_id, r.speaker) == (conv, "ann") for m in r.messages for _ in range(m.times)]
    out = chat.rotate(frame, copies=True).collect()
    assert said(out, 1) == ["first", *(f"m{k:02}" for k in range(40)), *["ok"] * 100, "last"] and said(out, None) == ["hi"] * 3
    assert all(sum(m.times for m in r.messages) <= chat.PART == 64 for r in out)
    assert sum(r.text.count("ok<|im_end|>") for r in out if r.speaker == "ann") == 100
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op6_chat_rotation"](spark, str(tmp_path)).collect()
    assert sum(r.n_messages for r in got if r.conv_id == 1) == 2 * 142 and [r.n_messages for r in got if r.conv_id is None] == [3]
