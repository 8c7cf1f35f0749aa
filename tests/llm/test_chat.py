"""Reply trees and their template."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandloom.llm import chat, queries

SCHEMA = "tree string, node long, parent long, role string, text string, score double"


def trees(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_branches_are_ranked_and_enumerated(spark):
    rows = [
        ("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 3.0),
        ("t", 4, 2, "user", "c", 5.0), ("t", 5, 3, "user", "d", 0.0), ("t", 6, 5, "assistant", "e", 9.0),
        ("u", 1, 77, None, None, None),
    ]
    out = chat.branches(trees(spark, rows)).orderBy("tree", "rank", "position").collect()
    paths = {}
    for r in out:
        paths.setdefault((r.tree, r["rank"], r.leaf), []).append((r.role, r.text))
    assert paths == {
        ("t", 1, 6): [("user", "q"), ("assistant", "b"), ("user", "d"), ("assistant", "e")],
        ("t", 2, 4): [("user", "q"), ("assistant", "a"), ("user", "c")],
        ("u", 1, 1): [("", "")],
    }
    best = chat.branches(trees(spark, rows), best=1).select("tree", "leaf").distinct().collect()
    assert sorted(map(tuple, best)) == [("t", 6), ("u", 1)]


def test_odd_trees(spark):
    rows = [
        ("cycle", 1, 2, "user", "x", 1.0), ("cycle", 2, 1, "user", "y", 1.0), ("cycle", 3, 1, "user", "below", 1.0),
        ("self", 1, 1, "user", "z", 1.0), (None, 1, None, "user", "no tree", 1.0), ("a", None, 1, "user", "no node", 1.0),
        ("dup", 1, None, "user", "b", 1.0), ("dup", 1, None, "user", "a", 1.0), ("dup", 1, None, "user", "a", 1.0),
        ("ties", 1, None, "user", "r", 0.0), ("ties", 2, 1, "user", "s", 1.0), ("ties", 3, 1, "user", "t", 1.0),
    ]
    messages = trees(spark, rows).withColumn("up", F.lit("clash")).withColumn("rank", F.lit("clash"))
    out = chat.branches(messages).collect()
    got = sorted((str(r.tree), r["rank"], r.leaf, r.position, r.text) for r in out)
    assert got == [
        ("None", 1, 1, 1, "no tree"), ("dup", 1, 1, 1, "a"),
        ("ties", 1, 2, 1, "r"), ("ties", 1, 2, 2, "s"), ("ties", 2, 3, 1, "r"), ("ties", 2, 3, 2, "t"),
    ]
    assert chat.format_branches(chat.branches(trees(spark, []))).count() == 0


def test_long_chain(spark):
    rows = spark.range(1, 301).select(
        F.lit("t").alias("tree"), F.col("id").alias("node"), (F.col("id") - 1).alias("parent"),
        F.when(F.col("id") % 2 == 1, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("m"), "id").alias("text"), F.lit(1.0).alias("score"),
    )
    row = chat.format_branches(chat.branches(rows)).first()
    turns = re.findall(r"\[TURN\](\w+)\n(m\d+)\[/TURN\]", row.formatted)
    assert [t for _, t in turns] == [f"m{k}" for k in range(1, 301)]
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss] == [f"m{k}" for k in range(2, 301, 2)]


PARTS = st.sampled_from(
    ["<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[/TURN]", "<|im_start|>", "\\", "<", "[", "s>", "/s>", "TURN]", "\n", "a", "é🙂", "|", "$1"]
)


def test_escaping_is_reversible(spark):
    found = set()

    @settings(max_examples=600, deadline=None, derandomize=True)
    @given(st.lists(PARTS, max_size=8).map("".join))
    def gather(text):
        found.add(text)

    gather()
    rows = [("t", k, None, a, b, 0.0) for k, (a, b) in enumerate(zip(sorted(found), sorted(found, reverse=True)), 1)]
    done = chat.format_branches(chat.branches(trees(spark, rows)))
    read = {r.leaf: r.turns for r in done.select("leaf", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert len(read) == len(rows)
    for _, k, _, role, text, _ in rows:
        assert [tuple(t) for t in read[k]] == [(role, text)]
    for r in done.collect():
        marks = re.findall(r"</?s>|\[/?TURN\]|\[/?INST\]|<\|\w+\|>", r.formatted)
        assert marks == ["<s>", "[TURN]", "[/TURN]", "</s>"]


def test_loss_covers_the_assistant_only(spark):
    rows = [
        ("t", 1, None, "system", "s", 0.0), ("t", 2, 1, "user", "[/TURN]", 0.0), ("t", 3, 2, "assistant", "</s>🙂", 0.0),
        ("t", 4, 3, "assistant", "", 0.0), ("t", 5, 4, "assistant", "end", 0.0),
    ]
    done = chat.format_branches(chat.branches(trees(spark, rows)))
    row = done.select("formatted", "loss", chat.read_loss(F.col("formatted"), F.col("loss")).alias("read")).first()
    assert row.read == "</s>🙂end" and len(row.loss) == 3
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss] == ["<\\/s>🙂", "", "end"]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_has_all_conversations(spark, sf):
    out = queries.op1_chat_format(spark, sf)
    wanted = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count() + 1
    assert out.count() == out.select("conv_id").distinct().count() == wanted
    row = out.filter("conv_id = -7").first()
    assert row.n_turns == 2 and row.loss_chars == len("</s>[INST] ok [/INST]")
