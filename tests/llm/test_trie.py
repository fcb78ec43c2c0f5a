"""Conversation prefix trie against its plain SQL statement, on odd rows."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from scorelake.llm import prefix_trie, queries

SF = "/root/testdata/sf0.001"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("conversations", frame)
    return con.sql(queries.OP11_SQL).df()


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    def norm(frame):
        frame = frame[COLS].astype({c: "Int64" for c in COLS[:-1]}).sort_values(["depth", "conv_id"]).reset_index(drop=True)
        return frame.astype(str)

    a, b = norm(got), norm(want)
    assert a.equals(b), (a.compare(b) if a.shape == b.shape else (a.shape, b.shape))


ODD = [
    # the group's first conversation, and members taking up to three of its turns
    (0, 0, "user", "hello there"), (0, 1, "assistant", "hi  you  all"), (0, 2, "user", "bye"), (0, 3, "assistant", "x " * 4000),
    (1, 0, "user", "other"), (2, 5, "user", "a"), (2, 6, "user", "b"), (3, None, "user", "null turn first"), (3, 1, None, None),
    # ties of turn, repeated rows, null ids, a conversation whose rebuilt turns are none
    (5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a"), (None, 0, "user", "no id"), (7, 0, "user", "hello there"),
    (20, 0, "user", "hello there"), (21, 0, "system", ""), (40, 0, "user", "hello there"), (41, 3, "user", "\t\n"), (60, 2, None, "z")]


def test_trie_equals_sql_on_odd_rows(spark):
    frame = pd.DataFrame(ODD, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string").withColumns({"c": F.lit(1), "k1": F.lit("x"), "depth": F.lit(9.5)})
    got = prefix_trie.trie(df).toPandas()
    same(got, plain(frame))
    root = got[got.depth == 0].iloc[0]
    assert root.n_convs == len({r[0] for r in ODD if r[0] is not None}) and pd.isna(root.parent_conv_id)


def test_trie_hot_parents_by_broadcast(spark):
    """With a per-task limit of one child, every parent goes the broadcast way; results stay the same."""
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = plain(df.toPandas())
    same(prefix_trie.trie(df, hot_children=1, max_hot=10**9).toPandas(), want)
    same(prefix_trie.trie(df).toPandas(), want)


def test_trie_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(df).count() == 0
