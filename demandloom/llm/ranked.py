"""Ranked lexical search: the best documents of every item, by exact integer scores, with norm buckets.

A document is a vector of impacts over the items' terms, an item a vector of counts; a term's weight is
dealt to both by its square root. Documents are ordered by the length of their vectors and cut into
buckets of similar length. An item's threshold is the least score among its best documents so far.

* A bucket whose longest vector times the item's length stays below the threshold is left out, and so are all
  after it (Cauchy and Schwarz).
* Inside a bucket the item's coordinates are read in order of weight until what the rest can add, by the lengths
  or by the largest impact, stays below the threshold. Documents without any of these focus coordinates are
  out. For the others the exact part plus the bound of the rest must reach the threshold.
* Survivors get their score from all coordinates, in 64-bit integers.

Bounds are floats, widened by SLACK; they only decide what is scored. The longest buckets go first and give the
thresholds with which all other buckets start, and every task raises its own further. Items come in blocks of bounded
size, so what goes to every task has a bound whatever their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandloom.llm.common import written

DEPTH = 20
#: Items and bytes of their texts in one block, on average.
BLOCK_ITEMS = 512
BLOCK_BYTES = 256_000
#: Buckets a doubling of the length.
BUCKETS = 8
#: Part of the documents whose buckets are searched first, to find thresholds.
FIRST_PART = 1 / 16
#: Documents of a bucket that are scored together.
ROWS_AT_ONCE = 512
SLACK = 1 + 1e-9
#: The impact is IMPACT * tf div (1000 * tf + 12 * m).
IMPACT = 1_000_000_000

#: Terms are runs of ASCII letters and digits and of everything beyond ASCII; A-Z become small.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n and the (term, tf) of the vocabulary of every document with a term, written."""
    schema = "doc_id long, n long, term array<int>, tf array<int>"
    names = ["doc_id", "n", "term", "tf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                lengths, term, tf = [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    own = terms(text or b"")
                    lengths.append(len(own))
                    counts = Counter(own)
                    held = counts.keys() & known
                    term.append([vocabulary[t] for t in held])
                    tf.append([counts[t] for t in held])
                columns = [part.column(0), pa.array(lengths, pa.int64()), pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return written(docs.mapInArrow(run, schema).filter("n > 0"))


@dataclass
class _Flat:
    """Vectors of a batch as flat arrays: entries of document d are those from start[d] to start[d + 1]."""

    start: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, term: pa.ListArray, value: pa.ListArray) -> _Flat:
        sizes = np.diff(term.offsets.to_numpy())
        doc = np.repeat(np.arange(len(sizes)), sizes)
        start = np.concatenate([[0], np.cumsum(sizes)])
        return cls(start, doc, term.flatten().to_numpy(), value.flatten().to_numpy().astype(np.int64))


def _impacts(vectors: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """doc_id, term, impact, norm and bucket of every document that can score, written in order of length."""
    schema = "doc_id long, term array<int>, impact array<long>, norm double, bucket int"
    names = ["doc_id", "term", "impact", "norm", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _Flat.of(batch.column(2), batch.column(3))
            n = batch.column(1).to_numpy()
            m = 100 - 25 + (25 * n * documents) // length
            impact = (IMPACT * flat.value) // (1000 * flat.value + 12 * m[flat.doc])
            squares = np.bincount(flat.doc, weights=weights[flat.term] * impact.astype(float) ** 2, minlength=len(n))
            norm = np.sqrt(squares)
            bucket = np.floor(BUCKETS * np.log2(np.maximum(norm, 1))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(flat.start, pa.int32()), pa.array(impact))
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists, pa.array(norm), pa.array(bucket)], names)
            yield out.filter(pa.array(norm > 0))

    return written(vectors.mapInArrow(run, schema).sortWithinPartitions(F.desc("bucket")))


@dataclass
class _Items:
    """A block of items, their coordinates in descending order of length; ``place`` is a coordinate's rank in its item."""

    length: np.ndarray
    tail_norm: np.ndarray
    tail_sum: np.ndarray
    term: np.ndarray
    item: np.ndarray
    place: np.ndarray
    amount: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, counts: list[dict[int, int]], weights: np.ndarray) -> _Items:
        ordered = [
            sorted(((v, n) for v, n in own.items() if weights[v]), key=lambda p: (-p[1] * p[1] * int(weights[p[0]]), p[0]))
            for own in counts
        ]
        widest = max(map(len, ordered), default=0)
        tail_norm, tail_sum = np.zeros((len(counts), widest + 1)), np.zeros((len(counts), widest + 1))
        flat = []
        for q, own in enumerate(ordered):
            for place in range(len(own) - 1, -1, -1):
                v, n = own[place]
                tail_norm[q, place] = tail_norm[q, place + 1] + float(n) * n * weights[v]
                tail_sum[q, place] = tail_sum[q, place + 1] + float(n) * weights[v]
                flat.append((v, q, place, n * int(weights[v])))
        flat.sort()
        term, item, place, amount = (np.array([f[k] for f in flat], np.int64) for k in range(4))
        tail_norm = np.sqrt(tail_norm)
        return cls(tail_norm[:, 0].copy(), tail_norm, tail_sum, term, item, place, amount, weights)

    def matched(self, flat_term: np.ndarray, flat_doc: np.ndarray, taken: np.ndarray):
        """Entry numbers and coordinate numbers of all meetings with the taken coordinates (in term order)."""
        own = np.flatnonzero(taken)
        terms = self.term[own]
        low, high = np.searchsorted(terms, flat_term), np.searchsorted(terms, flat_term, side="right")
        entries = np.flatnonzero(high > low)
        sizes = high[entries] - low[entries]
        first = np.repeat(low[entries] - (np.cumsum(sizes) - sizes), sizes)
        return np.repeat(entries, sizes), own[first + np.arange(sizes.sum())]


@dataclass
class _Best:
    """The best documents of every item that a task has seen, and each item's threshold."""

    floor: np.ndarray
    depth: int

    def __post_init__(self):
        self.item, self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.least = self.floor.copy()

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, null = np.concatenate([self.doc, doc]), np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.depth
        self.item, self.score, self.doc, self.null = item[kept], score[kept], doc[kept], null[kept]
        last = place[kept] == self.depth - 1
        self.least[self.item[last]] = np.maximum(self.least[self.item[last]], self.score[last])


def _search_chunk(items: _Items, flat: _Flat, low: int, high: int, norms: np.ndarray, best: _Best):
    """Survivors (document, item, score) among the documents low to high, which share a bucket."""
    longest = norms[low:high].max()
    a, b = flat.start[low], flat.start[high]
    term, doc, impact = flat.term[a:b], flat.doc[a:b] - low, flat.value[a:b]
    most = int(impact.max(initial=0))
    reach = np.minimum(items.tail_norm * longest, items.tail_sum * most) * SLACK
    # coordinates to read: all places from which on the rest could still reach the threshold
    focus = ((reach >= best.least[:, None]) & (reach > 0)).sum(axis=1)
    taken = items.place < focus[items.item]
    if not taken.any():
        return None
    q, width = len(items.length), high - low
    entry, coordinate = items.matched(term, doc, taken)
    cell = doc[entry] * q + items.item[coordinate]
    part = np.zeros(width * q, np.int64)
    np.add.at(part, cell, items.amount[coordinate] * impact[entry])
    seen = np.bincount(cell, weights=items.weights[term[entry]] * impact[entry].astype(float) ** 2, minlength=width * q)
    cells = np.flatnonzero(part)
    d, i = cells // q, cells % q
    left = np.sqrt(np.maximum(norms[low + d] ** 2 * SLACK - seen[cells], 0))
    rest = np.minimum(items.tail_norm[i, focus[i]] * left, items.tail_sum[i, focus[i]] * most)
    cells = cells[(part[cells] + rest) * SLACK >= best.least[i]]
    if not len(cells):
        return None
    more = ~taken
    if more.any():  # the coordinates behind the focus, for survivors only
        wanted = np.zeros(width * q, bool)
        wanted[cells] = True
        docs = np.zeros(width, bool)
        docs[cells // q] = True
        own = np.flatnonzero(docs[doc])
        entry, coordinate = items.matched(term[own], doc[own], more)
        entry = own[entry]
        cell = doc[entry] * q + items.item[coordinate]
        hit = wanted[cell]
        np.add.at(part, cell[hit], items.amount[coordinate[hit]] * impact[entry[hit]])
    score = part[cells]
    keep = score >= best.least[cells % q]
    return low + cells[keep] // q, cells[keep] % q, score[keep]


def _search(impacts: DataFrame, items: _Items, floor_: np.ndarray, depth: int) -> DataFrame:
    """item (its number in the block), doc_id and score: every task's best documents, written."""
    names = ["item", "doc_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(floor_, depth)
        for batch in batches:
            norms, bucket = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            if (items.length * norms.max(initial=0) * SLACK < best.least).all():
                continue  # no item can reach its threshold in any bucket of the batch
            flat = _Flat.of(batch.column(1), batch.column(2))
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc_id = ids.fill_null(0).to_numpy()
            edges = np.flatnonzero(np.diff(bucket)) + 1
            for start, end in zip([0, *edges], [*edges, len(norms)]):
                for low in range(start, end, ROWS_AT_ONCE):
                    found = _search_chunk(items, flat, low, min(end, low + ROWS_AT_ONCE), norms, best)
                    if found:
                        d, item, score = found
                        best.add(item, score, doc_id[d], null[d])
        ids = pa.array(best.doc, pa.int64(), mask=best.null)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), ids, pa.array(best.score)], names)

    return written(impacts.mapInArrow(run, "item long, doc_id long, score long"))


def _ranked(found: DataFrame, depth: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= depth)


def _rank_block(docs: DataFrame, block: list, depth: int) -> DataFrame:
    counts = [Counter(terms((text or "").encode())) for _, text in block]
    vocabulary = {t: v for v, t in enumerate(sorted(set().union(*counts)))}
    vectors = _vectors(docs, vocabulary)
    documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
    held = dict(vectors.select(F.explode("term").alias("v")).groupBy("v").agg(F.count("*").alias("df")).collect())
    weights = np.array(
        [floor(1000 * log((2 * documents + 2) / (2 * held.get(v, 0) + 1))) for v in range(len(vocabulary))], np.int64
    )
    items = _Items.of([{vocabulary[t]: n for t, n in own.items()} for own in counts], weights)
    impacts = _impacts(vectors, weights, documents, max(1, length or 0))
    sizes = sorted(impacts.groupBy("bucket").count().collect(), reverse=True)
    total, first, seen = sum(r[1] for r in sizes), 0, 0
    for bucket, size in sizes:
        first, seen = bucket, seen + size
        if seen >= FIRST_PART * total:
            break
    start = np.zeros(len(block), np.int64)
    found = _search(impacts.filter(F.col("bucket") >= first), items, start, depth)
    least = _ranked(found, depth).filter(F.col("rank") == depth).select("item", "score").collect()
    for item, score in least:
        start[item] = score
    shortest = (start / (np.maximum(items.length, 1e-300) * SLACK)).min(initial=np.inf)
    last = floor(BUCKETS * log2(max(1, shortest))) - 1
    rest = impacts.filter((F.col("bucket") < first) & (F.col("bucket") >= last))
    both = found.unionByName(_search(rest, items, start, depth))
    names = F.broadcast(docs.sparkSession.createDataFrame([(k, r[0]) for k, r in enumerate(block)], "item long, item_id long"))
    return _ranked(both, depth).join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def rank(
    docs: DataFrame, items: DataFrame, depth: int = DEPTH, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``depth`` best documents of every item.

    Scores are above 0; equal ones rank by ascending key, null keys last. Keys are integers. Texts without a
    term, null ones among them, take no part; repeated rows of ``docs`` are documents of their own, repeated
    rows of ``items`` are one item, and rows with the same id but another text are ranked apart. Empty tables,
    on either side, give an empty result. Further columns are not read.
    """
    kept = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = written(items.select(F.col(item_key).cast("long").alias("id"), F.col(item_text).alias("text")).distinct())
    number, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-number // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for k in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).orderBy("id", "text").collect()
        if block:
            out = out.unionByName(_rank_block(kept, [tuple(r) for r in block], depth))
    return out
