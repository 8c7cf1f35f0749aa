"""Quality rules: counts of each text, and how much it resembles trusted documents.

The resemblance is the log-likelihood ratio of the text's words and word pairs, hashed into
``BUCKETS``, between two multinomials (trusted documents, and all documents), divided by the
number of features. Everything is a column expression; no text moves between tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import packed, runs, unpacked, words

BUCKETS = 16_384
#: Trusted documents that the target multinomial is fitted on, those with the smallest key hash.
TRUSTED_ROWS = 20_000
#: Texts below this mean log-likelihood ratio go.
LEAST_RATIO = -0.1
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def base_counts(own: Column, text: Column) -> dict[str, Column]:
    """Counts of a text and its words, null counting as empty, and its three-word windows.

    word_chars: code points in words; n_dup_lines: lines with a word that equal an earlier line;
    windows: a 64-bit hash of every three neighbouring words.
    """
    text = F.coalesce(text, F.lit(""))
    bare = F.translate(text, " \t\n\x0b\f\r", "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    windows = runs(own, 3, lambda i: F.xxhash64(F.get(own, i), F.get(own, i + 1), F.get(own, i + 2)))
    return {
        "n_words": F.size(own).cast("long"),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "windows": windows,
    }


def features(own: Column) -> Column:
    """Bucket of every word and of every pair of neighbouring words."""
    single = F.transform(own, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)))
    pairs = runs(own, 2, lambda i: F.pmod(F.xxhash64(F.get(own, i), F.get(own, i + 1)), F.lit(BUCKETS)))
    return F.concat(single, pairs)


def bucket_weights(docs: DataFrame, trusted: DataFrame, text: str = "text", key: str = "doc_id") -> list[float]:
    """Log ratio of every bucket, smoothed by one; BUCKETS numbers, whatever the corpus size.

    All documents count into the raw multinomial. ``trusted`` lists keys; of those that occur, at
    most ``TRUSTED_ROWS`` count into the target. Only the bounded list of keys and the bucket sums
    leave their tasks. Null keys and null texts add nothing.
    """
    chosen = (
        trusted.select(F.col(key).alias("__key"))
        .filter("__key is not null")
        .distinct()
        .orderBy(F.xxhash64("__key"), "__key")
        .limit(TRUSTED_ROWS)
        .withColumn("__trusted", F.lit(1))
    )
    flagged = docs.select(F.col(key).alias("__key"), words(F.col(text)).alias("own")).join(
        F.broadcast(chosen), "__key", "left"
    )
    sums = (
        flagged.select("__trusted", F.explode(features(F.col("own"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("__trusted").alias("target"))
        .collect()
    )
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for row in sums:
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    n_raw, n_target = sum(raw), sum(target)
    return [math.log(t / n_target) - math.log(r / n_raw) for t, r in zip(target, raw)]


def judge(docs: DataFrame, weights: list[float], text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``ratio``, ``base_failed`` and ``kept``, row by row.

    Null and empty texts have no words, ratio 0, and fail the base rules. Repeated rows stay;
    columns of ``docs`` stay, but for those that carry one of the new names. An empty table
    gives an empty table. Texts are read whole, and no shuffle happens.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "base_failed", "kept"]
    names = [c for c in docs.columns if c not in new]
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    own = packed(docs, names, own=words(F.col(text)), whole=F.col(text))
    counts = base_counts(F.col("own"), F.col("whole"))
    ratio = F.aggregate(features(F.col("own")), F.lit(0.0), lambda a, b: a + F.get(table, b.cast("int")))
    out = own.select(
        "row",
        *(c.alias(n) for n, c in counts.items()),
        (ratio / F.greatest(2 * F.size("own") - 1, F.lit(1))).alias("ratio"),
    )
    # Only texts that repeat a window are sorted.
    out = out.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    again = F.transform(
        "placed",
        lambda w, k: F.when(
            F.get("placed", k - 1)["h"].eqNullSafe(w["h"]) | F.get("placed", k + 1)["h"].eqNullSafe(w["h"]), w["i"]
        ),
    )
    covered = F.array_distinct(
        F.flatten(F.transform(F.array_compact(again), lambda i: F.array(i, i + 1, i + 2)))
    )
    n_repeat = F.when(F.col("placed").isNull(), 0).otherwise(F.size(covered)).cast("long")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        out.withColumn("n_repeat_words", n_repeat)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("ratio") >= LEAST_RATIO))
        .select(*unpacked(names), *new)
    )
