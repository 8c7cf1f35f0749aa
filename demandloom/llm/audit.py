"""Audit of how filters interact: what every order of them removes, and who deserves the credit.

Each document gets a mask of the filters that it fails. All that an audit needs are the removals of
the 32 coalitions, v(S) = documents that fail a filter of S, and these are sums over the at most 32
masks of a part of the corpus. A step of an order is a difference of two coalitions.

A filter's Shapley value is the solution phi of a constrained least squares problem: v(S) is fitted by
the sum of phi over S, weighted by the Shapley kernel, with the values adding up to v of all filters.
The normal equations with their constraint are solved once, in rationals, for every unit vector v;
that gives a matrix which turns the removals of any part into its values, without rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm.common import written

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
FULL = (1 << len(FILTERS)) - 1
#: Texts judged before a batch goes back.
ROWS_AT_ONCE = 1_000
UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
COUNTS = ("n", "good", "toxic")


def failed(text: bytes, code_points: int) -> int:
    """Mask of the filters A to D that a text fails; bytes split at exactly the six ASCII blanks."""
    words = text.split()
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, UPPER))) > 10 * code_points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """key, part and mask of every row, written. Filter E: a smaller key has an identical text.

    A null text counts as empty and a null part as the empty string. A null key is no smaller than
    any and has none smaller; repeated rows do not fail for one another. Texts are compared by 128
    bits of hash. One group of copies may hold any part of the rows: it is one row of the side that
    joins back.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    kept = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2"), F.length(body).alias("points"), body.alias("body"),
    )
    schema = kept.drop("points", "body").schema.add("mask", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                texts, points = batch.column(5).cast(pa.binary()).to_pylist(), batch.column(4).to_pylist()
                masks = pa.array(map(failed, texts, points), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], masks], schema.names)

    judged = written(kept.mapInArrow(run, schema))
    ends = judged.groupBy("h1", "h2").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    copied = written(ends.filter("first < last").select("h1", "h2", "first"))
    copy = F.coalesce(F.col("key") > F.col("first"), F.lit(False)).cast("int") * (1 << FILTERS.index("E"))
    return judged.join(copied, ["h1", "h2"], "left").select("key", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def coalitions(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """A row per part: for n, good and toxic an array of what each of the 32 coalitions removes, and n_all.

    ``labels`` has ``key``, quality and toxic; several rows of a key count as one, good or toxic if any is.
    """
    marks = labels.groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    tally = (
        masks.join(marks, "key", "left")
        .groupBy("part", "mask")
        .agg(F.count("*").alias("n"), *(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in COUNTS[1:]))
    )
    each = tally.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(FULL))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    removed = each.groupBy("part", "coalition").agg(
        *(F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in COUNTS), F.sum("n").alias("n_all")
    )
    packed = removed.groupBy("part").agg(  # 32 rows a part
        F.sort_array(F.collect_list(F.struct("coalition", *COUNTS))).alias("by"), F.max("n_all").alias("n_all")
    )
    return packed.select("part", "n_all", *(F.col(f"by.{c}").alias(c) for c in COUNTS))


def _solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Gauss and Jordan in rationals, all right sides at once."""
    rows = [a + b for a, b in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(len(rows)):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k])]
    return [row[len(matrix) :] for row in rows]


def shapley_matrix(m: int = len(FILTERS)) -> list[list[Fraction]]:
    """Row i holds what v of each coalition (by its mask) adds to the value of filter i.

    Least squares over the proper coalitions with the kernel (m - 1) / (C(m, s) s (m - s)), a
    Lagrange multiplier for the sum of the values; the empty coalition removes nothing.
    """
    full = (1 << m) - 1
    weight = {
        s: Fraction(m - 1, comb(m, s.bit_count()) * s.bit_count() * (m - s.bit_count())) for s in range(1, full)
    }
    both = [[sum((w for s, w in weight.items() if s >> i & s >> j & 1), Fraction()) for j in range(m)] for i in range(m)]
    matrix = [[*row, Fraction(1)] for row in both] + [[Fraction(1)] * m + [Fraction()]]
    right = [[weight.get(s, Fraction()) * (s >> i & 1) for s in range(full + 1)] for i in range(m)]
    right += [[Fraction(s == full) for s in range(full + 1)]]
    return _solved(matrix, right)[:m]


def _whole_numbers(values: list[Fraction]) -> list[int]:
    if any(x.denominator != 1 for x in values):
        raise AssertionError("a sum over all orders is whole")
    return [int(x) for x in values]


def steps(removed: DataFrame) -> DataFrame:
    """Every part, order and step: what ``audit`` returns."""
    sums = [_whole_numbers([ORDERS * x for x in row]) for row in shapley_matrix()]
    value = F.array(*(sum((F.get("n", s) * x for s, x in enumerate(row) if x), F.lit(0)) for row in sums))
    plan = F.array(
        *(
            F.struct(
                F.lit("".join(FILTERS[f] for f in order)).alias("filter_order"), F.lit(k + 1).alias("step"),
                F.lit(f).alias("f"), F.lit(sum(1 << x for x in order[:k])).alias("before"),
            )
            for order in permutations(range(len(FILTERS)))
            for k, f in enumerate(order)
        )
    )
    rows = removed.withColumn("value", value).withColumn("s", F.explode(plan)).select("*", "s.*")
    bit = F.expr("shiftleft(1, f)")
    after = F.col("before").bitwiseOR(bit)
    here = {c: F.get(c, after) - F.get(c, F.col("before")) for c in COUNTS}
    return rows.select(
        "part", "filter_order", "step", (F.col("n_all") - F.get("n", after)).alias("kept"), here["n"].alias("removed"),
        (F.get("n", bit) - here["n"]).alias("redundant"),
        (F.get("n", F.lit(FULL)) - F.get("n", F.lit(FULL) - bit)).alias("unique_fails"),
        here["good"].alias("good_lost"), here["toxic"].alias("toxic_lost"), F.get("value", F.col("f")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step, with counts of documents within the part:

    kept (after this step), removed (here), redundant (failing its filter, removed earlier),
    unique_fails (failing its filter only), good_lost and toxic_lost (of the removed ones, by the
    labels), shapley (its filter's removals, summed over all orders).

    Filters: A fewer than 100 words; B fewer than 80 % of the words distinct; C more than 10 %
    capitals A-Z; D one of ``#$%&*|``; E the text of a smaller key. Nulls, ties and repeats as in
    ``failures``; documents without a label are neither good nor toxic. An empty table gives no
    rows. Columns other than these three are not read.
    """
    return steps(coalitions(failures(docs, key, text, part), labels, key))
