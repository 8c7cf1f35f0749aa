"""Benchmark decontamination with spaced seeds.

Fixed masks pick some of the neighbouring tokens and ignore the others. Hashes of what the masks
pick, at every position of every item and every document, are joined; each hit fixes how the item
lies on the document, and the overlap there is counted token by token. So passages with some
tokens substituted are found, and chance hits fall away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.columns import checked_broadcast
from demandloom.llm.common import packed, row_key, runs, same_row, unpacked, written

#: Fixed masks, six tokens each: a plain run, and two spaced ones. 1 is picked, 0 is ignored.
MASKS = ("111111", "1101011001", "1001101011")
#: With these, for items of (from, to) tokens, every pattern of substitutions that still counts leaves
#: some mask untouched: one for the longer items, two for shorter ones, two for five tokens.
MORE_MASKS = (("1100010100011", 15, None), ("1111", 6, 14), ("110011", 6, 14), ("111", 5, 5), ("11011", 5, 5))
#: An overlap counts if this many neighbouring tokens (or the whole item, if it is shorter) ...
WINDOW = 16
#: ... agree in at least this percentage of places.
LEAST_PERCENT = 80
#: Item hashes that go to every task at most; more of them join by shuffle.
BROADCAST_HASHES = 2_000_000
#: Marked documents that go to every task at most; more of them join by shuffle.
BROADCAST_ROWS = 500_000
#: About how many hits of a text lie in one row.
HITS_A_ROW = 1_024


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null gives none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _masks(lengths: list[int]) -> list[tuple[str, int, int | None]]:
    """The masks that items of these lengths need, with the least and the greatest length each is for."""
    fixed = [(m, 1, None) for m in MASKS] + [*MORE_MASKS, *(("1" * n, n, n) for n in range(1, 5))]
    return [m for m in fixed if m[0] in MASKS or any(m[1] <= n <= (m[2] or n) for n in lengths)]


def _hashes(coded: Column, masks: list[str]) -> Column:
    """Per mask an array with the hash at every position, in one array."""

    def hashed(k: int, mask: str) -> Column:
        picked = [i for i, c in enumerate(mask) if c == "1"]
        return runs(coded, len(mask), lambda i: F.xxhash64(F.lit(k), *(F.get(coded, i + j) for j in picked)))

    return F.concat(*(hashed(k, mask) for k, mask in enumerate(masks)))


def _located(pos: Column, n: Column, masks: list[str]) -> tuple[Column, Column]:
    """Mask number, and position in the text, of the ``pos``-th hash of a text of ``n`` tokens."""
    before, mask, place = F.lit(0), F.lit(None).cast("int"), F.lit(None).cast("int")
    for k, own in enumerate(masks):  # the last mask that does not start behind pos wins
        mask, place = F.when(pos >= before, k).otherwise(mask), F.when(pos >= before, pos - before).otherwise(place)
        before = before + F.greatest(n - len(own) + 1, F.lit(0))
    return mask, place


def _positions(rows: DataFrame, keys: list[str], masks: list[str]) -> DataFrame:
    """``keys``, hash, mask and place of every mask at every position of the column ``own``."""
    # n stands beside the array, so that the spread rows do not carry the array along
    coded = rows.select(*keys, F.size("own").alias("n"), F.transform("own", lambda t: F.xxhash64(t)).alias("coded"))
    spread = coded.select(*keys, "n", F.posexplode(_hashes(F.col("coded"), masks)).alias("pos", "hash"))
    mask, place = _located(F.col("pos"), F.col("n"), masks)
    return spread.select(*keys, "hash", mask.alias("mask"), place.alias("place"))


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Every overlap: __key and __text of the document row, item, place (where the item's first
    token lies in the document, in tokens), matched (agreeing tokens in the best window), window.

    A null text has no tokens and overlaps nothing, items and documents alike. Items of fewer
    than five tokens must agree whole. Repeated items and a null item key count as items of
    their own. Empty tables give no rows; further columns do not matter. No position and no
    candidate is left out, however common a passage is.
    """
    bench = items.select(F.col(item_key).alias("item"), tokens(F.col(item_text)).alias("own")).filter(F.size("own") > 0)
    ranges = _masks(bench.agg(F.collect_set(F.least(F.size("own"), F.lit(WINDOW)))).first()[0])
    masks = [m for m, _, _ in ranges]
    named = bench.select("item", F.size("own").alias("n_item"), F.xxhash64("own").alias("code"), "own")
    low, high = (
        F.get(F.array(*(F.lit(r[k]).cast("int") for r in ranges)), F.col("mask")) for k in (1, 2)
    )
    seeds = (
        _positions(named, ["item", "n_item", "code"], masks)
        .filter(F.col("n_item").between(low, F.coalesce(high, F.col("n_item"))))
        .select("item", "n_item", "code", "hash", F.col("place").alias("item_place"))
    )
    texts = docs.select(*row_key(docs, key, text), F.col(text).alias("__whole"))
    hits = _positions(
        texts.select("__key", "__text", tokens(F.col("__whole")).alias("own")), ["__key", "__text"], masks
    ).join(checked_broadcast(seeds.distinct(), BROADCAST_HASHES), "hash")
    hit = F.struct("item", "code", "n_item", (F.col("place") - F.col("item_place")).alias("place"))
    # a text's hits travel in pieces, so that no row holds all of a text that repeats a passage
    single = written(hits.select("__key", "__text", hit.alias("hit")).distinct())
    many = single.groupBy("__text").agg(F.ceil(F.count("*") / HITS_A_ROW).alias("pieces")).filter("pieces > 1")
    piece = F.pmod(F.xxhash64("hit"), F.coalesce("pieces", F.lit(1))).alias("piece")
    per_text = single.join(many, "__text", "left").groupBy("__key", "__text", piece)
    per_text = per_text.agg(F.collect_set("hit").alias("hits"))
    part = F.transform(
        "hits",
        lambda h: F.struct(
            h["item"].alias("item"), h["code"].alias("code"), h["place"].alias("place"),
            F.slice(
                F.col("own"), F.greatest(h["place"], F.lit(0)) + 1, h["n_item"] + F.least(h["place"], F.lit(0))
            ).alias("part"),
        ),
    )
    cut = (
        texts.alias("a")
        .join(per_text.alias("b"), same_row("a", "b"))
        .select("a.__key", "a.__text", tokens(F.col("__whole")).alias("own"), "hits")
        .select("__key", "__text", F.explode(part).alias("h"))
        .select("__key", "__text", "h.*")
    )
    own_tokens = bench.select(
        F.col("item").alias("i"), F.xxhash64("own").alias("c"), F.col("own").alias("whole")
    ).distinct()
    aligned = cut.join(own_tokens, F.col("item").eqNullSafe(F.col("i")) & (F.col("code") == F.col("c")))
    agree = F.transform(
        "whole",
        lambda t, k: F.when(F.get(F.col("part"), k + F.least(F.col("place"), F.lit(0))).eqNullSafe(t), 1).otherwise(0),
    )
    width = F.least(F.size("whole"), F.lit(WINDOW))
    counted = aligned.select("__key", "__text", "item", "place", width.alias("window"), agree.alias("agree"))
    sums = F.transform(
        F.sequence(F.lit(1), F.size("agree") - F.col("window") + 1),
        lambda s: F.aggregate(F.slice("agree", s, F.col("window")), F.lit(0), lambda a, x: a + x),
    )
    return (
        counted.select("__key", "__text", "item", "place", F.array_max(sums).alias("matched"), "window")
        .filter(100 * F.col("matched") >= LEAST_PERCENT * F.col("window"))
        .distinct()
    )


def mark(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_items, first_item, best_match (percent) and contaminated, row by row.

    Documents without an overlap have 0 items, null first_item, 0 percent. Repeated rows stay,
    columns of ``docs`` stay but for those with one of the new names, whatever they are called.
    """
    new = ["n_items", "first_item", "best_match", "contaminated"]
    sums = found.groupBy("__key", "__text").agg(
        F.countDistinct("item").alias("n_items"),
        F.min("item").alias("first_item"),
        F.max(F.floor(100 * F.col("matched") / F.col("window"))).alias("best_match"),
        F.lit(True).alias("contaminated"),
    )
    kept = [c for c in docs.columns if c not in new]
    sums = checked_broadcast(written(sums), BROADCAST_ROWS)
    own_key, own_text = row_key(docs, key, text)
    return (
        packed(docs, kept, __key=own_key, __text=own_text)
        .alias("a")
        .join(sums.alias("b"), same_row("a", "b"), "left")
        .select(
            *unpacked(kept),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            "first_item",
            F.coalesce("best_match", F.lit(0)).cast("long").alias("best_match"),
            F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        )
    )
