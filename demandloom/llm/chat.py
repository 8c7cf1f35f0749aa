"""Chat formatting of reply trees.

Every message names the message it answers. Paths from the roots to the leaves are enumerated by
self-joins that double the reach per round, so a chain of n messages takes log2(n) rounds, and
rows stay small: texts join only the paths that were chosen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.operators.runs import checkpointed

#: The template's own marks, and the control strings that texts may not contain.
BEGIN, OPEN, CLOSE, END = "<s>", "[TURN]", "[/TURN]", "</s>"
_REST = r"/?s>|/?INST\]|/?TURN\]|\|im_start\|>|\|im_end\|>|\|endoftext\|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Put a backslash behind the first character of every control string.

    Strings that look escaped already get one more, so ``unescape`` restores every text exactly.
    """
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", "$1$2$3")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    plain = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def _reach(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Per round k: the nodes that have an ancestor 2^k steps up, with it. And all finished nodes
    with depth and total score from the root; nodes on or below a cycle never finish. Only nodes
    that still climb take part in a round."""
    a, b = messages.alias("a"), messages.select("tree", "node").alias("b")
    start = a.join(
        b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.parent") == F.col("b.node")), "left"
    ).select(
        "a.tree", "a.node", F.col("b.node").alias("up"),
        F.lit(1).cast("long").alias("depth"), F.col("a.score").alias("total"),
    )
    now = checkpointed(start)
    pieces, rounds, n_nodes = [], [], now.count()
    while True:
        pieces.append(now.filter("up is null"))
        climbing = now.filter("up is not null")
        # twice as far as there are messages: what still climbs goes round in a cycle
        if climbing.isEmpty() or 2 ** len(rounds) > 2 * n_nodes:
            return rounds, reduce(DataFrame.unionByName, pieces)
        rounds.append(climbing)
        a, b = climbing.alias("a"), reduce(DataFrame.unionByName, [climbing, *pieces]).alias("b")
        now = checkpointed(
            a.join(b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.up") == F.col("b.node"))).select(
                "a.tree", "a.node", F.col("b.up").alias("up"),
                (F.col("a.depth") + F.col("b.depth")).alias("depth"),
                (F.col("a.total") + F.col("b.total")).alias("total"),
            )
        )


def branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """The messages of every chosen root-to-leaf path: tree, leaf, rank, position, role, text.

    ``messages`` has tree, node, parent, role, text, score. Branches of a tree are ranked by
    mean score, ties by the smaller leaf; ``best`` keeps that many per tree, None keeps all. A
    parent that is null or no message of the tree makes a root. Null scores count as 0, null
    roles and texts as empty. Of rows that repeat a node, the least (role, text, score) stays;
    rows with a null node are no messages; a null tree is a tree of its own. Messages on or
    below a cycle have no root and appear in no path. An empty table gives no rows; further
    columns are left behind.
    """
    nodes = (
        messages.filter(F.col("node").isNotNull())
        .groupBy("tree", "node")
        .agg(
            F.min(
                F.struct(
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                    F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
                    "parent",
                )
            ).alias("m")
        )
        .select("tree", "node", "m.*")
    )
    rounds, done = _reach(nodes)
    leaves = done
    if rounds:
        parents = rounds[0].select("tree", F.col("up").alias("node")).distinct()
        leaves = done.alias("a").join(
            parents.alias("b"),
            F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node")),
            "left_anti",
        )
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        leaves = leaves.filter(F.col("rank") <= best)
    paths = leaves.select(
        "tree", F.col("node").alias("leaf"), "rank", "node", F.col("depth").alias("position")
    )
    for k in reversed(range(len(rounds))):
        step = rounds[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        above = paths.join(step, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
            "tree", "leaf", "rank", F.col("up").alias("node"), (F.col("position") - 2**k).alias("position")
        )
        paths = checkpointed(paths.unionByName(above))
    texts = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    return paths.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
        "tree", "leaf", "rank", "position", "role", "text"
    )


def format_branches(paths: DataFrame) -> DataFrame:
    """One conversation per path: tree, leaf, rank, formatted, loss (array of start, length).

    Marks stand around every turn; control strings inside roles and texts are escaped. The loss
    spans cover the assistant's texts, in code points from 0. A conversation is one row, so its
    turns meet in one task by definition.
    """
    own = Window.partitionBy("tree", "leaf", "rank").orderBy("position")
    head = F.concat(F.lit(OPEN), _escape_role(F.col("role")), F.lit("\n"))
    marked = paths.select(
        "tree", "leaf", "rank", "position", "role", head.alias("head"), escape(F.col("text")).alias("body")
    ).withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    placed = marked.select(
        "tree", "leaf", "rank", "position", "turn",
        (F.col("role") == LOSS_ROLE).alias("loss"),
        (F.sum(F.length("turn")).over(own) - F.length("turn") + len(BEGIN) + F.length("head")).alias("start"),
        F.length("body").cast("long").alias("length"),
    )
    turns = placed.groupBy("tree", "leaf", "rank").agg(
        F.sort_array(F.collect_list(F.struct("position", "turn", "loss", "start", "length"))).alias("turns")
    )
    return turns.select(
        "tree", "leaf", "rank",
        F.concat(F.lit(BEGIN), F.array_join("turns.turn", ""), F.lit(END)).alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["loss"]),
            lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
        ).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN + END))
    parts = F.filter(F.split(body, r"\[/TURN\]"), lambda p: p != "")
    after = F.transform(parts, lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    return F.transform(
        after,
        lambda p: F.struct(
            _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss spans, unescaped and joined."""
    parts = F.transform(
        loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(parts, "")
