"""Line dedup with a log-template tree.

A line goes down a tree of fixed depth: first by its number of words, then by its leading words,
where words with a digit count as a variable. At the leaf, a word stays constant in its place if
enough documents have it there, else the place becomes variable; what remains is the line's
template. A line that repeats as a whole is a template too, and needs fewer documents the more it
holds (``needed``). Templates that recur in enough documents are boilerplate, and their lines go.

A copied document repeats all its lines without any of them being boilerplate. So a template's
documents are counted in units: equal texts are one document, and documents that share at least half of
their phrases are joined, however many they are and over others too. Phrases are what full stops
and words that end in ``n`` cut a line into, so an edit changes one of many. Every document is compared
with the first and the last document, by hash, of each phrase that it shares, where these hold an
eighth of its phrases; so the comparisons grow with the documents, not with the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import BLANKS, kept_only, packed, text_code, unpacked, written
from demandloom.llm.components import components

#: Leading words on the way to a leaf.
DEPTH = 4
#: Lines with fewer words are templates only if they have that many characters, or letters of a
#: script that sets no blanks.
LEAST_WORDS = 3
LEAST_CHARS = 10
LEAST_LETTERS = 6
#: Characters, and letters of such a script, that count as much as a word (see ``needed``).
CHARS_A_WORD = 5
LETTERS_A_WORD = 2
NO_BLANKS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
#: Documents that a word needs in its place, and that a template with variable places needs.
LEAST_DOCUMENTS = 5
#: Part of a template's places that must be constant.
LEAST_CONSTANT = 0.5
#: A phrase ends at a full stop or at one of these, and has that many bytes at least.
PHRASE_ENDS = ("n ", "\n", "。", "，")
PHRASE_BYTES = 8
#: A document is compared with those that lead this part of its phrases, one in ...
LED = 8
VARIABLE = "<*>"
#: Leaves that go to every task at most, of 12 bytes each; more of them join by shuffle.
BROADCAST_LEAVES = 200_000

LEAF = ["n", "leaf"]


def needed(weight: Column) -> Column:
    """Documents that a line of this many words must recur in: 5 below 10 words, 2 from 20 on."""
    return F.least(F.lit(LEAST_DOCUMENTS), F.greatest(F.lit(2), 6 - F.floor(weight / 5))).cast("int")


def _script_letters(line: Column) -> Column:
    """Letters of scripts without blanks, all from U+0E00 on; lines without any such character are not counted."""
    far = (F.octet_length(line) > F.length(line)) & line.rlike(r"[\x{E00}-\x{10FFFF}]")
    return F.when(far, F.regexp_count(line, F.lit(f"[{NO_BLANKS}]"))).otherwise(0)


def split_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every line with enough words: body (a hash of the text), line (from 0), masked, n (words), leaf, code, need and solid.

    ``masked`` has the words, those with a digit as variables, with one blank between them; too few words are one, with
    variable digits. ``leaf`` and ``code`` are 64-bit hashes of its leading words and of all of it; ``solid`` lines
    have enough constant places to be a template by themselves, which needs ``need`` documents.
    """
    # the text ends here: behind the generator it would go along with every line
    texts = docs.select(text_code(F.col(text)).alias("body"), F.split(F.col(text), "\n").alias("lines"))
    rows = texts.select("body", F.posexplode("lines").alias("line", "whole"))
    trimmed = F.btrim("whole", F.lit(" \t\n\x0b\f\r"))
    uneven = F.lit(False)
    for blank in ("  ", "\t", "\x0b", "\f", "\r"):
        uneven = uneven | F.contains("trimmed", F.lit(blank))
    even = F.when(uneven, F.regexp_replace("trimmed", BLANKS, " ")).otherwise(F.col("trimmed"))
    blanks = F.octet_length("even") - F.octet_length(F.replace("even", F.lit(" ")))
    number = F.when(F.col("even") == "", 0).otherwise(blanks + 1)
    digits = F.col("even").rlike("[0-9]")
    masked = F.when(F.col("words") >= LEAST_WORDS, F.when(digits, F.regexp_replace("even", "[^ ]*[0-9][^ ]*", VARIABLE)).otherwise(F.col("even")))
    few = F.when(digits, F.regexp_replace("trimmed", "[0-9]+", VARIABLE)).otherwise(F.col("trimmed"))
    weight = F.greatest("n", F.floor(F.length("whole") / CHARS_A_WORD), F.floor(F.col("letters") / LETTERS_A_WORD))
    variable = F.when(
        F.contains("masked", F.lit(VARIABLE)), F.size(F.filter(_places(), lambda w: w == VARIABLE))
    ).otherwise(0)
    return (
        rows.select("body", "line", "whole", trimmed.alias("trimmed"))
        .withColumn("even", even)
        .withColumn("words", number)
        .withColumn("letters", _script_letters(F.col("whole")))
        .withColumn("masked", F.coalesce(masked, few))
        .withColumn("n", F.when(F.col("words") >= LEAST_WORDS, F.col("words")).otherwise(1))
        .select(
            "body", "line", "masked", "n",
            F.xxhash64(F.when(F.col("n") > 1, F.substring_index("masked", " ", DEPTH)).otherwise(F.col("masked"))).alias("leaf"),
            F.xxhash64("masked").alias("code"), needed(weight).alias("need"),
            (F.col("n") - variable >= F.col("n") * LEAST_CONSTANT).alias("solid"),
            ((F.col("words") >= LEAST_WORDS) | (F.length("trimmed") >= LEAST_CHARS) | (F.col("letters") >= LEAST_LETTERS)).alias("taken"),
        )
    )


def _places() -> Column:
    """The words of a masked line."""
    return F.when(F.col("n") > 1, F.split("masked", " ")).otherwise(F.array("masked"))


def _shuffled(df: DataFrame) -> DataFrame:
    """Written, and joined by shuffle at every size: a side that grows with the documents."""
    return written(df).hint("merge")


def _templates(lines: DataFrame) -> DataFrame:
    """n, leaf, code -> template of every distinct line whose leaf may hold a recurring one."""
    busy = written(lines.groupBy(*LEAF).agg(F.count("*").alias("lines")).filter(F.col("lines") >= LEAST_DOCUMENTS).select(*LEAF))
    side = F.broadcast(busy) if busy.count() <= BROADCAST_LEAVES else busy
    # one row per distinct line: a very common line is one row from here on
    distinct = written(
        lines.select("body", *LEAF, "code", "masked")
        .join(side, LEAF, "left_semi")
        .distinct()
        .groupBy(*LEAF, "code", "masked")
        .agg(F.count("*").alias("documents"))
    )
    places = distinct.select(*LEAF, "code", "documents", F.posexplode(_places()).alias("place", "word"))
    constant = (
        places.filter(F.col("word") != VARIABLE)
        .groupBy(*LEAF, "place", "word")
        .agg(F.sum("documents").alias("d"))
        .filter(F.col("d") >= LEAST_DOCUMENTS)
        .select(*LEAF, "place", "word")
    )
    kept = places.join(written(constant), [*LEAF, "place", "word"], "left_semi")
    return (
        kept.groupBy(*LEAF, "code")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("constants"))
        .filter(F.size("constants") >= F.col("n") * LEAST_CONSTANT)
        .select(*LEAF, "code", F.xxhash64("n", "leaf", "constants").alias("template"))
    )


def _phrases(docs: DataFrame, text: str) -> DataFrame:
    """body and the distinct hashed phrases of every text, as one array."""
    marked = F.col(text)
    for end in PHRASE_ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(f"{end.strip()}."))
    long = F.filter(F.split(marked, r"\."), lambda p: F.octet_length(p) >= PHRASE_BYTES)
    return docs.select(
        text_code(F.col(text)).alias("body"), F.array_distinct(F.transform(long, lambda p: F.xxhash64(p))).alias("own")
    )


def units(docs: DataFrame, bodies: DataFrame, text: str = "text") -> DataFrame:
    """body and unit of those of the texts with these hashes that share half of their phrases with others."""
    sets = written(
        _phrases(docs, text).join(bodies.hint("merge"), "body", "left_semi").groupBy("body").agg(F.any_value("own").alias("own")).withColumn("n", F.size("own"))
    )
    shared = sets.select("body", "n", F.explode("own").alias("phrase"))
    ends = shared.groupBy("phrase").agg(F.min("body").alias("first"), F.max("body").alias("last")).filter("first < last")
    led = shared.join(_shuffled(ends), "phrase").select("body", "n", F.explode(F.array("first", "last")).alias("leader"))
    tried = (
        led.filter("body <> leader")
        .groupBy("body", "n", "leader")
        .agg(F.count("*").alias("c"))
        .filter(F.col("c") * LED >= F.col("n"))
        .select(F.least("body", "leader").alias("u"), F.greatest("body", "leader").alias("v"))
    )
    pairs = written(tried.distinct())
    for end in ("u", "v"):
        pairs = pairs.join(sets.select(F.col("body").alias(end), F.col("own").alias(f"own_{end}")).hint("merge"), end)
    half = 3 * F.size(F.array_intersect("own_u", "own_v")) >= F.size("own_u") + F.size("own_v")
    return components(written(pairs.filter(half).select("u", "v"))).select(F.col("node").alias("body"), F.col("component").alias("unit"))


def recurring_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Lines to drop: body (``text_code``) and line number, of every line whose template recurs."""
    lines = written(split_lines(docs, text)).filter("taken")
    codes = lines.select("body", "line", *LEAF, "code", "need", "solid")
    by_tree = codes.join(_shuffled(_templates(lines)), [*LEAF, "code"]).select("body", "line", "template", F.lit(LEAST_DOCUMENTS).alias("need"))
    alone = codes.filter(F.col("solid") & (F.col("need") < LEAST_DOCUMENTS))
    alone = alone.select("body", "line", F.xxhash64(F.lit("alone"), *LEAF, "code").alias("template"), "need")
    found = by_tree.unionByName(alone)
    # every template's texts; most lines recur nowhere and end here
    held = found.select("template", "need", "body").distinct()
    often = written(held.groupBy("template").agg(F.count("*").alias("d"), F.min("need").alias("need")).filter("d >= need").select("template"))
    found = written(found.join(often.hint("merge"), "template", "left_semi"))
    bodies = written(found.select("body").distinct())
    joined = _shuffled(units(docs, bodies, text))
    evidence = found.select("template", "need", "body").distinct().join(joined, "body", "left")
    evidence = evidence.select("template", "need", F.coalesce("unit", "body").alias("unit")).distinct()
    dropped = evidence.groupBy("template").agg(F.count("*").alias("d"), F.min("need").alias("need")).filter("d >= need").select("template")
    return found.join(_shuffled(dropped), "template", "left_semi").select("body", "line").distinct()


def drop_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the recurring lines, plus n_lines and n_dropped.

    All rows stay, a text may end up empty. A null text stays null with 0 lines, an empty text
    has one line; rows of equal text are treated alike and count as one document. An empty table
    gives an empty table. Columns of any name stay, but for those with one of the new names.
    Lines are split at ``\\n`` only; what is kept stays as it was. A line of any length is read whole.
    """
    gone = kept_only(lambda: recurring_lines(docs, text).groupBy("body").agg(F.collect_list("line").alias("gone")))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # by shuffle at every size: the lines to drop grow with the documents
    joined = packed(docs, names, body=text_code(F.col(text))).join(gone.hint("merge"), "body", "left")
    own = F.col("row").getField(text)
    parts = F.split(own, "\n")
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("gone", i)), "\n")
    return joined.select(
        *unpacked(names, {text: F.when(F.col("gone").isNull(), own).otherwise(kept)}),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
