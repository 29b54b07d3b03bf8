"""Round trips of the chat template."""

import hashlib
import random

import lociframe.llm.chat as C
from lociframe.llm.chat import PART, assemble, format_turns, parse, read_back, unescape
from pyspark.sql import functions as F


def expected(rows):
    """Digests straight from the rows (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        all_text = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(all_text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def result(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(3))
    got = read_back(assemble(format_turns(df))).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(5)
    bits = ["\\", "<", "|", "<|", "<|start|>", "<|message|>", "<|end|>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<</s>",
            "\n", "é🙂", "a", "", "\\\\", "$1", "<<s>", "[[INST]"]
    text = lambda: None if rng.random() < .1 else "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 0, 1, 2]), rng.choice(["user", "assistant", None, "<|end|>", "a\n"]), text())
            for _ in range(400)]
    assert result(spark, rows) == expected(rows)


def test_segments_of_a_long_conversation(spark, monkeypatch):
    rows = [(9, i, "assistant" if i % 2 else "user", f"text {i} \\<|end|>" * 40) for i in range(3000)]
    monkeypatch.setattr(C, "SEGMENT_CHARS", 5000)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments = assemble(format_turns(df))
    assert segments.count() >= 1
    assert result(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert result(spark, [(1, 0, "user", "x")]) == expected([(1, 0, "user", "x")])
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(assemble(format_turns(df))).count() == 0


def test_no_control_string_survives_in_a_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "<<|start|>[INST]</s><</SYS>>")], "conv_id long, turn long, role string, text string")
    piece = format_turns(df).first().piece
    (role, content, _, _), = parse(piece)
    assert role == "user" and not any(c in content for c in [*C.CONTROL, "<|"])
    assert unescape(content) == "<<|start|>[INST]</s><</SYS>>"


def test_typed_parts(spark):
    parts = [("text", "look <|end|> ", None, None), ("image", None, "s3://a/1.png", 4), ("text", " and ", None, None),
             ("audio", None, "b.wav", 10), ("document", None, None, None), ("video", None, "v", 2), None]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{PART}>")
    rows = {r.turn: r for r in format_turns(df, "parts").collect()}
    assert rows[0].piece == ("<|start|>user<|message|>look <\\|end|> <|image:1|> and <|audio:2|><|document:3|><|video:4|><|end|>")
    assert [(a.n, a.type, a.ref, a.tokens) for a in rows[0].attachments] == [
        (1, "image", "s3://a/1.png", 1024), (2, "audio", "b.wav", 250), (3, "document", None, 512), (4, "video", "v", 0)]
    assert rows[1].piece == "<|start|>assistant<|message|><|end|>" and rows[1].attachments == []


def test_attachments_are_numbered_through_a_conversation(spark, monkeypatch):
    one = [("text", "see <|image:1|> ", None, None), ("image", None, "a.png", 2), ("text", " or ", None, None), ("audio", None, "b.wav", 3)]
    two = [("document", None, "c.pdf", 1), ("text", "\\</s>", None, None), ("image", None, "d.png", None)]
    rows = [(1, 0, "user", one), (1, 1, "assistant", two), (1, 2, "user", [("text", "no file", None, None)]), (1, 3, "user", two), (2, 0, "user", two)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PART}>")
    for size in (1 << 20, 10):
        monkeypatch.setattr(C, "SEGMENT_CHARS", size)
        segments = assemble(format_turns(df, "parts"))
        text = "".join(r.text for r in sorted(segments.collect(), key=lambda r: (r.conv_id, r.segment)) if r.conv_id == 1)
        got = {r.conv_id: r for r in read_back(segments).collect()}
        files = got[1].attachments
        assert [(f.n, f.type, f.ref, f.tokens) for f in files] == [
            (1, "image", "a.png", 512), (2, "audio", "b.wav", 75), (3, "document", "c.pdf", 512), (4, "image", "d.png", 256),
            (5, "document", "c.pdf", 512), (6, "image", "d.png", 256)]
        assert all(text.startswith(f"<|{f.type}:{f.n}|>", f.offset) for f in files)
        assert [f.n for f in got[2].attachments] == [1, 2] and got[1].n_turns == 4
        trained = "<|document:3|>\\</s><|image:4|>"
        assert got[1].loss_chars == len(trained) and got[1].loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()


def test_clashing_columns(spark):
    rows = [(1, 0, "user", "a <|end|>"), (1, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = df.withColumns({c: F.lit("clash") for c in ("flat", "order_text", "loss", "attachments", "segment", "files", "a.b")})
    assert read_back(assemble(format_turns(more))).collect() == read_back(assemble(format_turns(df))).collect()
