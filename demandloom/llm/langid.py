"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three characters of lower-cased
words, with a mark at word ends), most frequent first. A document is given the language whose
profile has the smallest out-of-place distance to the document's own: the sum over the
document's n-grams of how far their two ranks lie apart, or the profile length for n-grams that
the language's profile does not have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

PROFILE = 300
MAX_LANGUAGES = 2_000
UNKNOWN = "und"
EDGE = 1  # stands for a word's end; no letter has this code
BITS = 21  # of a code point
ROWS_AT_ONCE = 1_000
CHARS_AT_ONCE = 4_000_000


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, with repeats; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one mark behind each word
    chars = np.where(letter, codes, EDGE)[keep].astype(np.uint64)
    if not len(chars) or (len(chars) == 1 and chars[0] == EDGE):
        return np.empty(0, np.uint64)
    ends = [np.full(1, EDGE, np.uint64)]
    chars = np.concatenate(ends + [chars] + (ends if chars[-1] != EDGE else []))
    pairs = chars[:-1] << np.uint64(BITS) | chars[1:]
    triples = pairs[:-1] << np.uint64(BITS) | chars[2:]
    return np.concatenate([chars[chars != EDGE], pairs, triples[chars[1:-1] != EDGE]])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def profile(text: str, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams of a text, ties by the smaller code."""
    codes, counts = counted(grams(text))
    if len(codes) > size:  # only counts that can be among the first are sorted
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn(docs: DataFrame, size: int = PROFILE, text: str = "text", lang: str = "lang") -> DataFrame:
    """Profiles as rows: lang, gram, rank (from 0), over all documents with text and language.

    Null and empty texts and null languages teach nothing. Tasks count their own n-grams, so the
    shuffle moves counts, not texts. Ties in count go to the smaller n-gram code.
    """
    kept = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        "text is not null and lang is not null"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "gram", "n"]
        waiting: dict[str, list[np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            codes, n = counted(np.concatenate(waiting.pop(lang)))
            del sizes[lang]
            columns = [pa.array([lang]).take(pa.array(np.zeros(len(codes), np.int32)))]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names
            )

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = grams(text)
                waiting.setdefault(lang, []).append(codes)
                sizes[lang] = sizes.get(lang, 0) + len(codes)
                if sizes[lang] >= CHARS_AT_ONCE:
                    yield flush(lang)
            if sum(sizes.values()) >= 4 * CHARS_AT_ONCE:  # many languages at once
                for lang in list(waiting):
                    yield flush(lang)
        for lang in list(waiting):
            yield flush(lang)

    totals = (
        kept.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        totals.withColumn("rank", F.row_number().over(order) - 1)
        .filter(F.col("rank") < size)
        .select("lang", "gram", "rank")
    )


@dataclass
class Profiles:
    """All learned profiles as one table: n-grams in code order, a row of ranks per language."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]], size: int) -> Profiles:
        languages = sorted({r[0] for r in rows})
        if len(languages) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        codes = np.array(sorted({r[1] for r in rows}), np.uint64)
        ranks = np.full((len(languages), len(codes)), size, np.int64)
        row = {name: i for i, name in enumerate(languages)}
        column = {int(c): i for i, c in enumerate(codes)}
        for lang, code, rank in rows:
            ranks[row[lang], column[code]] = rank
        return cls(languages, codes, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        own = profile(text, self.size) if text else np.empty(0, np.uint64)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        apart = np.abs(self.ranks[:, at] - np.arange(len(own)))
        apart[self.ranks[:, at] == self.size] = self.size
        apart[:, ~known] = self.size
        distances = apart.sum(axis=1)
        best = int(np.argmin(distances))  # ties: first by name
        return self.languages[best], 1.0 - float(distances[best]) / (self.size * len(own))


def identify(
    docs: DataFrame,
    profiles: DataFrame,
    size: int = PROFILE,
    text: str = "text",
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keys``, ``lang_pred`` and ``score`` (1: same order as the profile, 0: nothing shared).

    Row by row without a shuffle, over whole texts. A null text, a text without letters, or no
    learned language gives ``und`` with score 0. Repeated rows and null keys stay; an empty table
    gives an empty table; further columns are left behind. The profiles (``size`` rows for each
    of at most MAX_LANGUAGES languages) travel with the task.
    """
    rows = profiles.select("lang", "gram", "rank").limit(MAX_LANGUAGES * size + size).collect()
    model = Profiles.of([tuple(r) for r in rows], size)
    kept = docs.select(*keys, F.col(text).alias("text"))
    schema = T.StructType(
        [
            *(kept.schema[k] for k in keys),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                found = [model.predict(t) for t in batch.column(len(keys)).to_pylist()]
                out = [batch.column(k) for k in range(len(keys))]
                out += [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return kept.mapInArrow(run, schema)
