import hashlib
import json

from pyspark.sql import functions as F

from rollbook.llm import chat, queries

NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi<|im_end|>", "\\", "\\\\<|im_end|>", "<\\|im_end|>", "", None, "a\nb\n", "[[INST]]", "é\U0001f600\\n",
         "<|im_start|><|im_start|>", "\\<s>\\", "$1 $0 \\1", "<<SYS>>x<</SYS>>"]


def check(rows, got):
    """Everything read back from the formatted text equals the turns."""
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn is None, turn if turn is not None else 0, role or "", text or ""))
    assert len(got) == len(turns)
    for r in got:
        expected = [t[2:] for t in sorted(turns[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == expected
        formatted = r["formatted"]
        spans = [formatted[s["start"]:s["start"] + s["length"]] for s in r["loss"]]
        plain = [s for s in spans]
        assert len(plain) == sum(role == "assistant" for role, _ in expected)


def test_round_trip_of_nasty_texts(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", text) for c in range(3) for t, text in enumerate(NASTY[c:])]
    rows += [(9, 0, "odd\nrole\\", "x"), (9, 0, "a", "same turn"), (9, None, None, None), (None, 0, "user", "no id"), (10, 0, "assistant", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("id", F.lit(2))
    got = chat.format_conversations(df).withColumn("turns", chat.read_back(F.col("formatted")))
    masked = F.transform("loss", lambda s: chat.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    got = got.withColumn("masked", masked).collect()
    check(rows, got)
    for r in got:
        assert r["masked"] == [t["text"] for t in r["turns"] if t["role"] == "assistant"]
        assert r["formatted"].count(chat.OPEN) == r["formatted"].count(chat.CLOSE) == len(r["turns"])
    assert chat.format_conversations(df.filter("conv_id > 1000")).count() == 0


def test_layouts(spark):
    records = [('{"role":"user","text":"hi"}', "turn", [("user", "hi")]),
               ('{"completion":"b","prompt":"a"}', "prompt", [("user", "a"), ("assistant", "b")]),
               ('{"prompt":"a","response":null}', "prompt-response", [("user", "a"), ("assistant", "")]),
               ('{"instruction":"a","input":"c","output":"b"}', "instruction-input", [("user", "a"), ("user", "c"), ("assistant", "b")]),
               ('{"instruction":"a","output":"b"}', "instruction", [("user", "a"), ("assistant", "b")]),
               ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}', "messages", [("user", "a"), ("assistant", "b")]),
               ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', "conversations", [("user", "a"), ("assistant", "b")]),
               ('{"data":{"turns":[{"speaker":"bot","text":"b"}]}}', "nested", [("assistant", "b")]),
               ('{"other":1}', None, []), ("no json", None, []), (None, None, []), ('{"messages":[]}', None, [])]
    df = spark.createDataFrame([(r[0],) for r in records], "record string")
    got = {r["record"]: (r["mapping"], [tuple(t) for t in r["turns"]]) for r in chat.canonical_turns(df).collect()}
    assert got == {r[0]: (r[1], r[2]) for r in records}
    layouts = [r[0] for r in df.select(chat.layout(F.col("record"))).collect()]
    assert layouts[5] == chat.layout_of(json.loads(records[5][0]))
    assert len({chat.layout_of(m.example) for m in chat.MAPPINGS}) == len(chat.MAPPINGS)


def test_query(spark, plan_of):
    sf = "/root/testdata/sf0.001"
    turns = {-1: [(0, "user", NASTY[0]), (1, "assistant", NASTY[0])]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    query = queries.QUERIES["op9_chat_format"](spark, sf)
    assert "Python" not in plan_of(query) and "Arrow" not in plan_of(query)
    got = {r["conv_id"]: r for r in query.collect()}
    assert set(got) == set(turns)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, rows in turns.items():
        rows, r = sorted(rows), got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(rows), digest("".join(f"{role}\n{text}\n" for _, role, text in rows)))
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), digest(loss))
