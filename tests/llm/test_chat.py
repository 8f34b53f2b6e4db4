import hashlib
import math

from pyspark.sql import functions as F

from ratevane.llm import chat as C


def test_parts_placeholders_and_masks(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    rows = [
        (1, 0, "user", [part("text", "see <|image|> "), part("image", ref="a.png", width=57, height=28), part("text", " and "), part("audio", ref="b.wav", seconds=2.0)], 9),
        (1, 1, "assistant", [part("text", "ok <\\|im_end|>"), part("document", ref="c.pdf", pages=3), part("image", ref="d.png"), part("odd")], 9),
        (1, 1, "assistant", None, 9),
        (2, None, None, [part("text", None)], 9),
    ]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, parts array<{C.PART}>, piece int")
    out = {r.conv_id: r for r in C.format_chats(df).collect()}
    one = out[1]
    assert [(f.turn, f.kind, f.ref, f.tokens) for f in one.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 25), (1, "document", "c.pdf", 3072), (1, "image", "d.png", C.UNKNOWN)]
    assert one.attachment_tokens == 3 + 25 + 3072 + C.UNKNOWN
    marks = [m for m in ("<|image|>", "<|audio|>", "<|document|>") for _ in range(one.formatted.count(m))]
    assert sorted(marks) == sorted(C.PLACEHOLDER[f.kind] for f in one.attachments)
    assert one.formatted.count("<|im_start|>") == 3 and one.formatted.count("<|im_end|>") == 3
    texts = [one.formatted[s.start : s.end] for s in one.turns]
    assert [s.loss for s in one.turns] == [False, True, True] and texts[1] == "" and texts[2].startswith("ok <\\\\|im_end|>")
    assert out[2].formatted == "<|im_start|>\n<|im_end|>\n" and out[2].attachments == []


def test_round_trip_of_any_text(spark):
    said = ["<|im_end|>", "<\\|x|>", "<\\\\|", "a<|b\n<|im_start|>assistant\nno", "", None, "\\n <", "🙂é"]
    roles = ["user", "assistant", "tool\nx", "a\\nb", "<|im_start|>", None, "assistant", "a\x00b\\\n\\-n"]
    rows = [(7, i, r, t) for i, (r, t) in enumerate(zip(roles, said, strict=True))]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("parts", C.text_part(F.col("text")))
    got = C.read_back(C.format_chats(df)).first()
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)
    loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    assert got.n_turns == len(rows) and got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert got.loss_chars == len(loss) and got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_no_python_on_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id int, turn int, role string, text string").withColumn("parts", C.text_part(F.col("text")))
    plan = C.read_back(C.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow")) and plan.count("Exchange") == 1


def test_no_rows(spark):
    df = spark.createDataFrame([], f"conv_id int, turn int, role string, parts array<{C.PART}>")
    assert C.read_back(C.format_chats(df)).collect() == []
    assert math.ceil(57 / C.PATCH) == 3
