import hashlib
import random

from compare import connect, difference

from passagerank.llm import chat
from passagerank.llm.oracle import SQL
from passagerank.llm.queries import QUERIES

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, turns STRING, formatted STRING"


def formatted(spark, rows):
    given = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = chat.format_conversations(given).withColumn("read", chat.read_turns(chat.F.col("formatted")))
    return {r["conv_id"]: r for r in found.withColumn("learned", chat.learned_text(chat.F.col("segments"))).collect()}


def test_query_equals_sql(spark, sf_dir):
    df = QUERIES["op2_chat"](spark, sf_dir)
    result = connect(sf_dir).execute(SQL["op2_chat"])
    assert difference(df.collect(), df.columns, result.fetchall(), [d[0] for d in result.description]) is None


def test_template(spark):
    found = formatted(spark, [(1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c")])
    assert found[1]["formatted"] == "<s>[SYS] be kind [/SYS][INST] a[NEXT]b [/INST][ANS] c </s>"
    assert found[1]["learned"] == "c"


def test_any_text_reads_back(spark):
    draw = random.Random(4)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[INST] ", "\\", "[\\INST]", "<\\\\s>", "[", "<", "/s>", "INST]", "a", " ", "\n",
            "[NEXT]", "[SAY]", "[ROLE] ", "é", "$1"]
    roles = ["user", "assistant", "system", "tool", "", None, "[SAY]", "[NEXT]"]
    rows = [
        (c, t, draw.choice(roles), "".join(draw.choice(bits) for _ in range(draw.randint(0, 9))))
        for c in range(150) for t in range(draw.randint(1, 6))
    ]
    found = formatted(spark, rows)
    for c in range(150):
        turns = [(r or "", x) for k, _, r, x in rows if k == c]
        assert [(t["role"], t["text"]) for t in found[c]["read"]] == turns
        assert found[c]["learned"] == "".join(x for r, x in turns if r == "assistant")
        assert "".join(s["text"] for s in found[c]["segments"]) == found[c]["formatted"]


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [(None, None, None, None), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, None, "user", None), (5, 1, "user", "a")]
    rows += [(6, i, "user" if i % 2 == 0 else "assistant", str(i)) for i in range(3000)]
    found = formatted(spark, rows)
    assert [t["text"] for t in found[5]["read"]] == ["", "a", "a", "b"]
    assert [(t["role"], t["text"]) for t in found[None]["read"]] == [("", "")]
    assert [t["text"] for t in found[6]["read"]] == [str(i) for i in range(3000)]
    assert formatted(spark, []) == {}


def test_digest_of_the_added_conversation(spark, sf_dir):
    row = QUERIES["op2_chat"](spark, sf_dir).filter("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_very_long_texts_and_clashing_columns(spark):
    long = "a [INST] word é " * 100_000
    given = spark.createDataFrame(
        [(1, 0, "user", long, "x", "y", "z"), (1, 1, "assistant", long + "!", "x", "y", "z")],
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING, segments STRING, starts STRING, runs STRING",
    )
    row = chat.format_conversations(given).withColumn("read", chat.read_turns(chat.F.col("formatted"))).first()
    assert [t["text"] for t in row["read"]] == [long, long + "!"] and "".join(s["text"] for s in row["segments"]) == row["formatted"]
