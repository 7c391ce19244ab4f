import random

from pyspark.sql import functions as F

from latticework.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<|", "|>", "<|end|>", "<|turn|>", "<|text|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\\\\",
          "<", "[", "$1", "\n", "é𝄞", "ok", " ", "<|image|>", "s>", "INST]", "\r\n", " ", "/"]
CONTROLS = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def random_turns(n=150, seed=9):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 12)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "a<|text|>b\n"]), text))
    return rows


def test_escaping_is_reversible_and_leaves_no_control(spark):
    texts = [(r[3],) for r in random_turns()] + [("".join(p),) for p in zip(PIECES, PIECES[1:])]
    df = spark.createDataFrame(texts, "text string").withColumn("escaped", chat.escaped(F.col("text")))
    for r in df.withColumn("back", chat.unescaped(F.col("escaped"))).collect():
        assert r.back == r.text
        assert not any(c in r.escaped for c in CONTROLS)


def test_turns_and_loss_read_back(spark):
    rows = random_turns()
    chats = chat.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(4), parts="text")
    got = chats.select(
        "conv_id", "n_turns", "formatted", chat.parsed(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted")).alias("loss"), chat.loss_spans(F.col("formatted")).alias("spans"),
    ).collect()
    for r in got:
        want = sorted((t, role, text) for c, t, role, text in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in want]
        assert r.n_turns == len(want)
        assert r.loss == "".join(text for _, role, text in want if role == "assistant")
        pieces = [r.formatted[s.start : s.start + s.length] for s in r.spans]
        assert len(pieces) == sum(role == "assistant" for _, role, _ in want)
        assert all(r.formatted[s.start + s.length :].startswith(chat.END) for s in r.spans)


def test_typed_parts(spark):
    parts = [
        ("text", "see <|image|> ", None, None), ("image", None, "s3://a.png", 28 * 28 * 10), None,
        ("document", "x", "b.pdf", 9), ("audio", None, None, None), ("text", None, None, None), ("video", "v", "v", 1),
        (None, "n", None, None),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("text", "fine", None, None)]), (1, 2, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, parts array<struct<type string, text string, ref string, size long>>")
    r = chat.format_chats(df).first()
    assert r.formatted == (
        "<|turn|>user<|text|>see <\\|image|> <|image|><|document|><|audio|><|end|>"
        "<|turn|>assistant<|text|>fine<|end|><|turn|>user<|text|><|end|>"
    )
    found = [(a.type, a.ref, a.tokens, a.place, a.turn) for a in r.attachments]
    assert found == [("image", "s3://a.png", 10, 0, 0), ("document", "b.pdf", 3, 1, 0), ("audio", None, 1, 2, 0)]
    assert (r.n_turns, r.expanded_tokens) == (3, 14)
    assert df.transform(chat.flatten).columns == ["conv_id", "turn", "role", "content", "attachments", "expanded_tokens"]


def test_edge_rows(spark):
    rows = [(None, None, None, None), (1, 5, "user", "b"), (1, 5, "user", "a"), (1, 5, "user", "a"), (2, 0, "assistant", "")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in chat.format_chats(docs, parts="text").collect()}
    assert got[None].formatted == "<|turn|><|text|><|end|>"
    assert got[1].formatted == "".join(f"<|turn|>user<|text|>{t}<|end|>" for t in "aab")
    loss = chat.format_chats(docs, parts="text").select(chat.loss_text(F.col("formatted")).alias("l")).collect()
    assert {r.l for r in loss} == {""}
    assert chat.format_chats(spark.createDataFrame([], SCHEMA), parts="text").collect() == []
    text = "[INST]" * 200_000
    long = chat.format_chats(spark.createDataFrame([(1, 0, "assistant", text)], SCHEMA), parts="text")
    assert long.select(chat.loss_text(F.col("formatted")).alias("l")).first().l == text


def test_no_python_in_the_plan(spark):
    chats = chat.format_chats(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA), parts="text")
    plan = chats.select(chat.loss_text(F.col("formatted")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
