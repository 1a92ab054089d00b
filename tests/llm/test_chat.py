import hashlib
import random
import re

from pyspark.sql import functions as F

from moodtide.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "<\\\\/s>", "[\\IMG]", "[DOC]", "[AUD", "]", "<", "[", "/", "\\", "s>", "INST]", " ", "\n", "ok", "é😀", "$1", "", " [/INST] "]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(seed):
    rng = random.Random(seed)
    out = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(BITS) for _ in range(rng.randrange(12)))
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "a b\n[/INST] +%", "", None]), rng.choice([text, text, None])))
    out += [(99, 0, "assistant", "x" * 200_000), (99, 0, "assistant", "x" * 200_000), (99, None, "user", "first"), (None, 1, "assistant", "</s>")]
    return out


def expected(all_rows):
    convs = {}
    for conv, turn, role, text in all_rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        escaped = lambda t: re.sub(rf"([<\[])(\\*(?:{chat.INNER}))", r"\1\\\2", t)
        turns.sort(key=lambda t: (*t[:3], escaped(t[3])))
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=str)


def test_reads_back_exactly(spark):
    all_rows = rows(1)
    df = spark.createDataFrame(all_rows, SCHEMA).repartition(4)
    formatted = chat.format_conversations(df)
    out = chat.digest(formatted).collect()
    assert sorted((tuple(r)[:5] for r in out), key=str) == expected(all_rows)
    lengths = {r.conv_id: len(r.formatted) for r in formatted.collect()}
    assert {r.conv_id: r.formatted_chars for r in out} == lengths


def test_no_control_string_survives_in_a_text(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(15))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROLS)


def test_typed_parts(spark):
    parts = [
        [("text", "see </s>", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), ("text", " and ", None, None, None, None, None),
         ("audio", None, "b.wav", None, None, 1.0, None)],
        [("document", None, "c.pdf", None, None, None, 3), ("strange", "[IMG]", None, None, None, None, None), (None, None, None, None, None, None, None)],
        None,
    ]
    df = spark.createDataFrame([(1, k, "assistant" if k else "user", p) for k, p in enumerate(parts)], f"conv_id long, turn long, role string, parts array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>")
    r = chat.format_parts(df).first()
    assert r.formatted == "<s>[INST] user [/INST] see <\\/s>[IMG] and [AUD]</s>[INST] assistant [/INST] [DOC][\\IMG]</s>[INST] assistant [/INST] </s>"
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 4), (0, "audio", "b.wav", 25), (1, "document", "c.pdf", 1536)]
    assert r.n_placeholder_tokens == 1565 and [r.formatted[a:b] for a, b in r.loss_spans] == ["[DOC][\\IMG]", ""]


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi", "x", "y")], SCHEMA + ", parts string, formatted string")
    assert chat.format_conversations(df).first().formatted == "<s>[INST] user [/INST] hi</s>"
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0
