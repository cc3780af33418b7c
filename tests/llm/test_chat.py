import random

from sparkloom.llm import chat
from sparkloom.llm.queries import OP8_SQL, op8_chat_collapse


def test_sql(spark, sf_dir):
    from oracle import assert_same, connect

    assert_same(op8_chat_collapse(spark, sf_dir), connect(sf_dir), OP8_SQL)


def test_prefixes(spark):
    r = random.Random(5)
    convs = {}
    for i in range(120):
        base = [(r.choice(["user", "assistant", None]), r.choice(["hi", "hello", "", None, "é"])) for _ in range(r.randint(1, 4))]
        convs[i] = base if r.random() < 0.5 or not convs else convs[r.randrange(i)] + base
    rows = [(c, t, role, text, "x") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    out = {r["conv_id"]: r for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, n_turns string")).collect()}
    want = {}
    for c, turns in convs.items():
        if not any(o[: len(turns)] == turns and (len(o) > len(turns) or d < c) for d, o in convs.items() if d != c):
            want[c] = sum(o == turns for o in convs.values())
    assert {c: r["n_equal"] for c, r in out.items()} == want
    assert all(r["n_turns"] == len(convs[c]) and r["rendered"].count("<|im_end|>") >= len(convs[c]) for c, r in out.items())


def test_odd_rows(spark):
    schema = "conv_id long, turn int, role string, text string"
    rows = [(None, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (3, 1, "user", "<|im_end|>")]
    out = {r["conv_id"]: r["n_turns"] for r in chat.render(spark.createDataFrame(rows, schema)).collect()}
    assert out == {1: 2, 2: 1, 3: 1}
    assert chat.render(spark.createDataFrame([], schema)).count() == 0


def test_rows_without_an_id_are_conversations_of_their_own(spark, tmp_path):
    import duckdb
    from oracle import assert_same

    rows = [(None, 0, "user", "a"), (None, 1, "user", "a"), (None, None, None, None), (None, 5, "user", "b"), (1, 0, "user", "b"), (2, 0, "user", "c"), (2, 1, "assistant", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = sorted((r["conv_id"] or -1, r["n_turns"], r["n_equal"], r["rendered"]) for r in chat.render(df).collect())
    say = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert out == [(-1, 1, 1, say("", "")), (-1, 1, 2, say("user", "a")), (1, 1, 2, say("user", "b")), (2, 2, 1, say("user", "c") + say("assistant", "d"))]
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert_same(chat.render(df), con, OP8_SQL)
