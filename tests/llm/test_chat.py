import random

from oracle import assert_same
from tidebook.llm import chat_trees, queries


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    parts = ["</s>", "[INST]", "<\\s>", "<|im_end|>", "\\", "<", "[", "x", "<<SYS>>", "<</SYS>>", "\n", "<|im_start|>user"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        safe = chat_trees.escape(text)
        assert chat_trees.unescape(safe) == text
        assert not any(c in safe for c in ("</s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>", "<<SYS>>"))
        turns = [("user", text), ("assistant", text + "y"), ("od\nd\\", "")]
        formatted, mask = chat_trees.format_turns(turns)
        assert chat_trees.parse_turns(formatted) == turns
        assert [chat_trees.unescape(formatted[a:b]) for a, b in mask] == [text + "y"]


def test_query_against_sql(spark, sf_dir):
    assert assert_same(spark, sf_dir, queries.op2_chat, queries.ORACLE_SQL["op2_chat"]) > 1


def test_branches_of_trees(spark):
    rows = [
        (1, 10, None, "user", "q", 0.0), (1, 11, 10, "assistant", "a1", 1.0), (1, 12, 10, "assistant", "a2", 2.0), (1, 13, 12, "user", "more", -5.0), (1, 14, 11, "user", "x", 0.5),
        (2, 20, 999, "user", "orphan", None), (3, 30, 31, "user", "loop", 1.0), (3, 31, 30, "user", "loop", 1.0),
    ]
    df = spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, role string, text string, score double")
    got = {r["tree"]: chat_trees.parse_turns(r["formatted"]) for r in chat_trees.format_trees(df).collect()}
    assert got == {1: [("user", "q"), ("assistant", "a1"), ("user", "x")], 2: [("user", "orphan")]}
    both = [(r["tree"], r["path"]) for r in chat_trees.format_trees(df, top=2).collect()]
    assert sorted(both) == [(1, 13), (1, 14), (2, 20)]


def test_odd_turns(spark):
    rows = [(1, 5, "user", None), (1, 5, "user", None), (1, 2, None, "sys\nx"), (1, None, "assistant", "last"), (None, 1, "user", "n"), (None, 0, "assistant", "m"), (2, 0, "assistant", "z" * 100_000)]
    rows += [(3, i, "user" if i % 2 else "assistant", str(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["tree"]: chat_trees.parse_turns(r["formatted"]) for r in chat_trees.format_trees(chat_trees.as_messages(df.withColumn("node", df.turn))).collect()}
    assert got[1] == [("", "sys\nx"), ("user", ""), ("user", ""), ("assistant", "last")]
    assert got[None] == [("assistant", "m"), ("user", "n")] and got[2] == [("assistant", "z" * 100_000)]
    assert [t for _, t in got[3]] == [str(i) for i in range(700)]
    empty = chat_trees.format_trees(chat_trees.as_messages(df.limit(0)))
    assert chat_trees.digests(empty).count() == 0


def test_rounds_write_few_files(spark):
    import glob

    from tidebook.llm.common import LEAST_FILES, shared_dir

    conf = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    folder = f"{shared_dir(spark)}/tidebook".removeprefix("file:")
    known = set(glob.glob(f"{folder}/chat-level-*") + glob.glob(f"{folder}/chat-walk-*"))
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(600).selectExpr("id div 6 AS conv_id", "id % 6 AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
        got = {r["tree"]: chat_trees.parse_turns(r["formatted"]) for r in chat_trees.format_trees(chat_trees.as_messages(df)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {c: [("assistant" if t % 2 else "user", f"t{6 * c + t}") for t in range(6)] for c in range(100)}
    made = set(glob.glob(f"{folder}/chat-level-*") + glob.glob(f"{folder}/chat-walk-*")) - known
    assert len(made) >= 4 and max(len(glob.glob(f"{d}/part-*")) for d in made) <= LEAST_FILES
