"""Exact set-similarity self-join by universe partition.

Two shingle sets with Jaccard similarity of at least 0.8 differ in at most H elements, where H
follows from their sizes. A size band cuts the universe into m > H segments by hash, so two such
sets agree in at least one whole segment. What a set holds in a segment, hashed, is a signature;
sets that share a signature are candidates, and candidates are verified exactly.

Segments that tell little are passed over, and paid for (cost-based allocation). A passed segment
takes one from the m - 1 - H spare ones; where none is left, another segment is looked up with
one difference allowed, through its one-deletion neighbourhood (the signatures of the segment
without one of its elements). Passed over are empty segments, and *hot* ones, whose signature still
joins many components after the first round. A pair found only in passed segments has to be short
of spare segments on both sides, so only such sets need neighbourhoods.

Candidates are first held against sketches (one bit per element or so), which rule out nearly all
that only share a passage; only what is left moves whole sets.

Large groups of near copies never give all their pairs: a round first verifies every member of a
signature against one leader, and afterwards only members of different components meet. Where
many do, their sketches are compared in blocks, and only what the sketches allow becomes a row.

No group is gathered anywhere. Signatures that stand alone fall out of a sort by range, which cuts
a signature that very many sets share into as many ranges as it needs; leaders are partial minima
that join back; partners of one document travel in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from demandloom.functions.columns import checked_broadcast
from demandloom.llm.common import discard, owned, packed, unpacked, words, written
from demandloom.llm.components import components
from demandloom.llm.urls import LOWER, UPPER

SHINGLE = 5
PERCENT = 80
#: Width of a size band: wide bands repeat fewer sets in the next band, but cut finer.
BAND = 1.5625
#: Signatures with more members than this are compared in blocks of about BLOCK members.
SMALL = 12
BLOCK = 1_024
#: Sketch words that one step of a comparison holds.
CELLS = 2_000_000
#: Signatures that join more components than this are looked up by other segments.
HOT = 2_048
#: Ids of texts that travel to every task at most; more of them join by shuffle.
BROADCAST_IDS = 1_000_000
#: About how many partners travel beside one set.
PARTNERS = 1_024
#: Partners of one document that blocks find are merged by pieces of about so many documents of the whole table.
PIECE = 65_536
ROWS_AT_ONCE = 500

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
SIZE_BITS = 27
CODE_BYTES = 8
MARK = 1 << 40


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (fixed constants of splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(codes: np.ndarray) -> np.ndarray:
    """Distinct shingles of a text given by its words' hashes, sorted. Shorter texts are one."""
    n = len(codes)
    if n == 0:
        return codes
    if n < SHINGLE:
        whole = _U(n)
        for code in codes:
            whole = _mix(np.array([whole ^ code]))[0]
        return np.array([whole], np.uint64)
    whole = codes[: n - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        whole = whole * _STEP + codes[k : n - SHINGLE + 1 + k]
    return np.unique(_mix(whole))


def most_different(a: int, b: int) -> int:
    """Elements in which sets of these sizes can differ at most."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


@cache
def _bands(count: int) -> tuple[tuple[int, int], ...]:
    """The first bands, as (lowest, highest) size."""
    out, low = [], 1
    for _ in range(count):
        high = max(low, int(low * BAND))
        out.append((low, high))
        low = high + 1
    return tuple(out)


@cache
def segments(band: int) -> int:
    """How many segments a band has: one more than its sets can differ in, and some spare."""
    high = _bands(band + 1)[band][1]
    most = most_different(high, high)
    return most + 1 + (most // 50 + 1 if most >= 20 else 0)


@cache
def bands_of(n: int) -> tuple[int, ...]:
    """The bands a set of this size is entered in: its own, where the larger set of a pair
    decides, and the next if a larger partner can lie there."""
    band = 0
    while _bands(band + 1)[band][1] < n:
        band += 1
    low = _bands(band + 2)[band + 1][0]
    return (band, band + 1) if 100 * n >= PERCENT * low else (band,)


def spare(n: int, band: int) -> int:
    """Segments that a set may pass over: partners are no larger than similarity and band allow."""
    largest = min(_bands(band + 1)[band][1], n * 100 // PERCENT)
    return segments(band) - 1 - most_different(n, largest)


def cut(own: np.ndarray, band: int) -> tuple[np.ndarray, ...]:
    """Of every element: its segment, in segment order, and its own hash; of every segment that
    is not empty: its number, start, and sum of hashes."""
    m = segments(band)
    part = (_mix(own ^ _U(band + 1)) % _U(m)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, value = part[order], _mix(own[order] ^ _STEP)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    return part, value, part[starts], starts, np.add.reduceat(value, starts)


def signature(band: int, numbers: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return _mix(sums + _mix(numbers.astype(np.uint64) + (_U(band + 1) << _U(40)))).astype(np.int64)


def sketch(own: np.ndarray) -> bytes:
    """Parities of how many elements fall on each of at least as many bits as there are elements.
    Every element in which two sets differ flips one bit, so sketches never differ in more bits
    than the sets in elements."""
    bits = 1 << max(6, (len(own) - 1).bit_length())
    hit = (_mix(own ^ _U(7)) & _U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(hit, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(data: bytes, size: int) -> int:
    """A sketch of ``size`` bytes from a longer one: the bits that fall together add up."""
    while len(data) > size:
        half = len(data) // 2
        data = (int.from_bytes(data[:half], "little") ^ int.from_bytes(data[half:], "little")).to_bytes(half, "little")
    return int.from_bytes(data, "little")


def least_different(a: bytes, b: bytes) -> int:
    """Elements in which the sets behind two sketches differ at least."""
    size = min(len(a), len(b))
    return (_folded(a, size) ^ _folded(b, size)).bit_count()


def _coded(text: str) -> Column:
    return F.transform(words(F.translate(F.col(text), UPPER, LOWER)), lambda w: F.xxhash64(w))


def _values(column: pa.Array) -> Iterator[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    offsets = column.offsets.to_numpy()
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield values[a:b]


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    return map(shingle_set, _values(column))


def _signatures(docs: DataFrame, text: str, key: str) -> DataFrame:
    """sig, doc, info, sketch. For every row one *set* row (info >= 0: size, and more of the set's
    hash in the high bits; sketch is the set's hash, CODE_BYTES long, and its sketch), then its
    signatures (info = -size, no sketch). A set with too few spare segments for its empty ones also
    gets a mark (info = -size - MARK)."""

    def hashed(doc: int | None) -> np.ndarray:
        return _mix(np.array([doc or 0], np.int64).view(np.uint64)).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # sets that this task has already cut
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                out: list[tuple[np.ndarray, int | None, int, bytes]] = []  # signatures, doc, info, sketch
                for doc, own in zip(batch.column(0).to_pylist(), _sets(batch.column(1))):
                    n = len(own)
                    if not n:
                        out.append((hashed(doc), doc, 0, b""))
                        continue
                    first = int(_mix(own ^ _U(1)).sum(dtype=np.uint64))
                    second = int(_mix(own ^ _U(2)).sum(dtype=np.uint64)) >> (1 + SIZE_BITS)
                    mark = (first, second << SIZE_BITS | n)
                    out.append((hashed(doc), doc, mark[1], first.to_bytes(CODE_BYTES, "little") + sketch(own)))
                    if doc is None or mark in seen:
                        continue
                    seen.add(mark)
                    for band in bands_of(n):
                        _, _, numbers, _, sums = cut(own, band)
                        out.append((signature(band, numbers, sums), doc, -n, b""))
                        if segments(band) - len(numbers) > spare(n, band):
                            out.append((hashed(doc), doc, -n - MARK, b""))
                sigs, docs_, infos, sketches = zip(*out)
                sizes = [len(x) for x in sigs]
                ids = np.repeat(np.array([-1 if d is None else d for d in docs_], np.int64), sizes)
                no_doc = np.repeat(np.array([d is None for d in docs_]), sizes)
                ends = np.repeat(np.cumsum([len(x) for x in sketches]), sizes).astype(np.int32)
                data = pa.py_buffer(b"".join(sketches))
                offsets = pa.py_buffer(np.r_[np.int32(0), ends])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(sigs)),
                        pa.array(ids, mask=no_doc),
                        pa.array(np.repeat(np.array(infos, np.int64), sizes)),
                        pa.Array.from_buffers(pa.binary(), len(ids), [None, offsets, data]),
                    ],
                    ["sig", "doc", "info", "sketch"],
                )

    return docs.select(F.col(key).cast("long").alias("doc"), _coded(text).alias("own")).mapInArrow(
        run, "sig long, doc long, info long, sketch binary"
    )


def _shared(signatures: DataFrame) -> DataFrame:
    """Of the rows sig, doc, n those whose signature stands in another row too. The first and the
    last signature of a range stay, for they may go on in the range beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_stays, first = None, False, None  # the last row so far, and whether it is known to stay
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            sig = rows.column("sig").to_numpy()
            first = sig[0] if first is None else first
            same = sig[1:] == sig[:-1]
            stays = sig == first
            stays[1:] |= same
            stays[:-1] |= same
            stays[0] |= held_stays
            yield from rows.slice(0, len(sig) - 1).filter(pa.array(stays[:-1])).to_batches()
            held, held_stays = rows.slice(len(sig) - 1), stays[-1]
        if held is not None:
            yield from held.to_batches()

    ranges = signatures.repartitionByRange("sig", "doc").sortWithinPartitions("sig", "doc")
    return ranges.mapInArrow(run, "sig long, doc long, n long")


def _texts(docs: DataFrame, ids: DataFrame, text: str, key: str, small: bool) -> DataFrame:
    """Columns of ``ids`` (with a column doc) and the set of that document. ``small``: ``ids``, with
    what its arrays hold, was counted to be at most BROADCAST_IDS numbers."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).join(
        F.broadcast(ids) if small else ids, "doc"
    )
    coded = rows.select(*ids.columns, _coded("text").alias("own"))
    at = len(ids.columns)
    schema = T.StructType([*coded.schema.fields[:at], T.StructField("own", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                sets = [x.view(np.int64) for x in _sets(batch.column(at))]
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:at], flat], schema.names)

    return coded.mapInArrow(run, schema)


def _plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) that their sketches leave possible; none that links is lost."""
    a = sets.select(F.col("doc").alias("u"), F.col("n").alias("u_n"), F.col("sketch").alias("u_sketch"))
    b = sets.select(F.col("doc").alias("v"), F.col("n").alias("v_n"), F.col("sketch").alias("v_sketch"))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "u_n", "v_n", "u_sketch", "v_sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)))
            near = [least_different(x, y) <= most_different(m, n) for m, n, x, y in sizes]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "u long, v long").distinct()


def _in_blocks(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) of different components that share a signature and that sketches allow.

    ``crowded`` has sig, doc, n and component. The largest component of a signature is not
    compared within itself; the rest meets it, and itself, block by block, so no comparison holds
    more than two blocks and a signature of k members costs k * (k / BLOCK) rows at most. What a
    document meets in one comparison is one row for every piece of the table; a pair that shares
    several signatures is made one by merging those rows, each of which holds a piece at most.
    """
    pieces = -(-sets.count() // PIECE) or 1
    sizes = crowded.groupBy("sig", "component").agg(F.count("*").alias("c"))
    layout = sizes.groupBy("sig").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"),
        F.max("c").alias("main_size"),
        (F.sum("c") - F.max("c")).alias("rest_size"),
    )
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    placed = crowded.join(written(layout), "sig").withColumns(
        {"m": blocks("main_size"), "r": blocks("rest_size"), "in_main": F.col("component") == F.col("main")}
    )
    at = F.pmod(F.xxhash64("doc"), F.when(F.col("in_main"), F.col("m")).otherwise(F.col("r"))).cast("int")
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    meet = lambda a, b, main: F.struct(a.alias("a"), b.alias("b"), F.lit(main).alias("with_main"))
    place = F.col("at")
    meets = F.when(F.col("in_main"), F.transform(upto("r"), lambda i: meet(i, place, True))).otherwise(
        F.concat(
            F.transform(upto("r"), lambda i: meet(F.least(i, place), F.greatest(i, place), False)),
            F.transform(upto("m"), lambda j: meet(place, j, True)),
        )
    )
    group = ["sig", "a", "b", "with_main"]
    spread = (
        placed.withColumn("at", at)
        .select("sig", "doc", "n", "component", "in_main", "at", F.explode(meets).alias("meet"))
        .select("sig", "doc", "n", "component", "in_main", "at", "meet.*")
        .join(sets.select("doc", "sketch").distinct(), "doc")
        .repartition(*group)
        .sortWithinPartitions(*group)
    )

    def compare(table: pa.Table) -> Iterator[tuple[int, int]]:
        docs, sizes, groups, main, at, a = (
            table.column(c).to_numpy() for c in ("doc", "n", "component", "in_main", "at", "a")
        )
        b, with_main = (table.column(c)[0].as_py() for c in ("b", "with_main"))
        sketches = table.column("sketch").to_pylist()
        width = min(map(len, sketches))
        bits = np.frombuffer(b"".join(_folded(x, width).to_bytes(width, "little") for x in sketches), np.uint64)
        bits = bits.reshape(len(docs), width // 8)
        # one side against the other; a block that meets itself is both sides
        left = np.flatnonzero(~main if with_main else at == a)
        right = np.flatnonzero(main if with_main else at == b)
        rows = max(1, CELLS // max(1, len(right) * bits.shape[1]))
        for start in range(0, len(left), rows):
            i = left[start : start + rows][:, None]
            limit = (sizes[i] + sizes[right]) * (100 - PERCENT) // (100 + PERCENT)
            apart = np.bitwise_count(bits[i] ^ bits[right]).sum(axis=2, dtype=np.int64)
            near = (apart <= limit) & (groups[i] != groups[right])
            near &= 100 * np.minimum(sizes[i], sizes[right]) >= PERCENT * np.maximum(sizes[i], sizes[right])
            x, y = np.nonzero(near)
            x, y = docs[left[start + x]], docs[right[y]]
            yield from zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(parts: Iterator[pa.Table]) -> pa.RecordBatch:
            found: dict[tuple[int, int], set[int]] = {}
            for part in parts:
                for u, v in compare(part):
                    found.setdefault((u, (v * 0x9E3779B1 >> 16) % pieces), set()).add(v)
            columns = [pa.array([k[i] for k in found], pa.int64()) for i in (0, 1)]
            columns.append(pa.array([sorted(v) for v in found.values()], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, ["u", "piece", "vs"])

        held = None  # the group that may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in group])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            yield pairs(table.slice(x, y - x) for x, y in zip(starts, starts[1:]))
            held = table.slice(starts[-1])
        if held is not None and held.num_rows:
            yield pairs([held])

    met = spread.mapInArrow(run, "u long, piece long, vs array<long>")
    merged = met.groupBy("u", "piece").agg(F.array_distinct(F.flatten(F.collect_list("vs"))).alias("vs"))
    return merged.select("u", F.explode("vs").alias("v"))


def _verified(docs: DataFrame, pairs: DataFrame, text: str, key: str) -> DataFrame:
    """Those of the written pairs (u, v) that link. The sets of v move to u, in pieces of about
    PARTNERS of them; u's set joins them there."""
    small = pairs.count() <= BROADCAST_IDS
    pieces = F.ceil(F.count("*") / PARTNERS).alias("pieces")
    many = pairs.groupBy("v").agg(pieces).filter("pieces > 1")
    piece = F.pmod(F.xxhash64("u"), F.coalesce("pieces", F.lit(1)))
    members = pairs.join(many, "v", "left").groupBy(F.col("v").alias("doc"), piece.alias("piece"))
    members = members.agg(F.collect_set("u").alias("partners")).drop("piece")
    right = _texts(docs, members, text, key, small).select(F.explode("partners").alias("u"), F.col("doc").alias("v"), "own")
    left = _texts(docs, pairs.select(F.col("u").alias("doc")).distinct(), text, key, small)
    left = left.select(F.col("doc").alias("u"), F.col("own").alias("other"))
    both = F.size(F.array_intersect("own", "other"))
    return (
        right.join(left, "u")
        .filter(100 * both >= PERCENT * (F.size("own") + F.size("other") - both))
        .select("u", "v")
        .distinct()
    )


def _sizes_fit(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _shortage(own: np.ndarray, passed: set[int], band: int):
    """How many segments a set of this band is short of, its cut, and which segments it looks up
    with one difference allowed: the first ones that it does not pass over and that hold two
    elements or more."""
    cut_ = _, _, numbers, starts, sums = cut(own, band)
    sigs = signature(band, numbers, sums).tolist()
    ends = np.r_[starts[1:], len(own)]
    short = segments(band) - len(numbers) + sum(s in passed for s in sigs) - spare(len(own), band)
    usable = [k for k, s in enumerate(sigs) if s not in passed and ends[k] - starts[k] > 1]
    return short, cut_, sigs, ends, usable[: max(short, 0)]


def _neighbourhoods(docs: DataFrame, hot: DataFrame, text: str, key: str) -> DataFrame:
    """Of the sets that are short of spare segments: doc, n, sig, deleted, probed, lost.

    ``hot`` has doc and its hot signatures. ``probed`` rows are the segments that a set looks up,
    as many as it is short of, with their one-deletion neighbourhoods. A pair is found when one
    side's lookups meet the other's segments; the side that is short of fewer suffices. So a set
    enters its first segments only, up to the last that any set of its band looks up which is
    short of as many or fewer. Where a set has too few segments to look up, the sets of its band
    also enter the segments they pass over, as ``lost``.
    """
    held = hot.agg(F.sum(F.size("passed") + 1)).first()[0] or 0
    rows = written(_texts(docs, hot, text, key, held <= BROADCAST_IDS))

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[tuple[int, int], int] = {}
        for batch in batches:
            for passed, own in zip(batch.column(1).to_pylist(), _values(batch.column(2))):
                for band in bands_of(len(own)) if len(own) else ():
                    short, (_, _, numbers, _, _), _, _, probed = _shortage(own, set(passed), band)
                    if short > 0:
                        deepest = int(numbers[probed[-1]]) if probed else -1
                        last[band, short] = max(last.get((band, short), -1), deepest)
                        if len(probed) < short:
                            last[band, -1] = 0
        keys = list(last)
        columns = [[k[0] for k in keys], [k[1] for k in keys], [last[k] for k in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["band", "short", "last"])

    # a row per band and shortage, however many documents there are
    found = rows.mapInArrow(needs, "band long, short long, last long").groupBy("band", "short").agg(F.max("last"))
    deepest = {(r[0], r[1]): r[2] for r in found.collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids, hot_sigs = (batch.column(i).to_pylist() for i in (0, 1))
            for doc, passed, own in zip(ids, hot_sigs, _values(batch.column(2))):
                n = len(own)
                for band in bands_of(n) if n else ():
                    short, (_, value, numbers, starts, sums), sigs, ends, probed = _shortage(own, set(passed), band)
                    if short <= 0:
                        continue
                    reach = max(x for (b, k), x in deepest.items() if b == band and 0 < k <= short)
                    for k in range(int(np.searchsorted(numbers, reach, "right"))):
                        out.append((doc, n, sigs[k], False, k in probed, False))
                        if ends[k] - starts[k] > 1:
                            rest = sums[k] - value[starts[k] : ends[k]]
                            near = signature(band, np.full(len(rest), numbers[k]), rest)
                            out.extend((doc, n, int(s), True, k in probed, False) for s in near)
                    if (band, -1) in deepest:
                        empty = np.setdiff1d(np.arange(segments(band)), numbers)
                        nothing = signature(band, empty, np.zeros(len(empty), np.uint64)).tolist()
                        lost = len(probed) < short
                        out.extend((doc, n, s, False, lost, True) for s in [*nothing, *(s for s in sigs if s in set(passed))])
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "n", "sig", "deleted", "probed", "lost"]
            )

    return rows.mapInArrow(run, "doc long, n long, sig long, deleted boolean, probed boolean, lost boolean")


def links(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The sets (doc, n: one row per row of ``docs``) and edges (u, v) that connect all similar
    documents: copies to the first of them, and verified pairs between first copies. Every two
    similar documents lie in one component of the edges, and no edge joins documents that are not
    joined by links."""
    info = F.col("info")
    with owned() as passing:
        raw = written(_signatures(docs, text, key))
    once = written(raw.filter((info >= 0) | (info <= -MARK)).select("doc", "info", "sketch"))
    kept = written(_shared(raw.filter((info < 0) & (info > -MARK)).select("sig", "doc", (-info).alias("n"))))
    discard(docs.sparkSession, passing)
    size = info.bitwiseAND(F.lit((1 << SIZE_BITS) - 1))
    code, rest = F.substring("sketch", 1, CODE_BYTES), F.expr(f"substring(sketch, {CODE_BYTES + 1})")
    sets = once.filter("info >= 0").select(code.alias("code"), "doc", "info", size.alias("n"), rest.alias("sketch"))

    named = sets.filter("doc is not null and n > 0")
    groups = written(
        named.groupBy("code", "info").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first <> last")
    )
    copies = written(
        named.join(groups.select("code", "info", "first"), ["code", "info"]).filter("doc <> first").select("doc", "first").distinct()
    )

    shared = written(
        kept.join(copies, "doc", "left").select("sig", F.coalesce("first", "doc").alias("doc"), "n").distinct()
    )
    leaders = written(
        shared.groupBy("sig")
        .agg(F.min(F.struct("doc", "n")).alias("leader"), F.max("doc").alias("last"))
        .filter(F.col("leader.doc") != F.col("last"))
        .select("sig", F.col("leader.doc").alias("leader"), F.col("leader.n").alias("leader_n"))
    )
    entries = written(shared.join(leaders, "sig"))
    tried = written(
        entries.filter((F.col("doc") != F.col("leader")) & _sizes_fit("n", "leader_n"))
        .select(F.col("leader").alias("u"), F.col("doc").alias("v"))
        .distinct()
    )
    found = written(_verified(docs, written(_plausible(tried, sets)), text, key))
    edges = found.unionByName(copies.select(F.col("first").alias("u"), F.col("doc").alias("v")))

    groups_now = written(components(found))
    placed = entries.select("sig", "doc", "n").join(
        groups_now.withColumnRenamed("node", "doc"), "doc", "left"
    ).select("sig", "doc", "n", F.coalesce("component", "doc").alias("component"))
    between = written(
        placed.groupBy("sig", "component").agg(F.count("*").alias("c"))
        .groupBy("sig").agg(F.count("*").alias("groups"), F.sum("c").alias("members")).filter("groups > 1")
    )
    few = placed.join(between.filter(F.col("members") <= SMALL).select("sig"), "sig")
    a, b = few.alias("a"), few.alias("b")
    more = (
        a.join(b, F.col("a.sig") == F.col("b.sig"))
        .filter((F.col("a.component") != F.col("b.component")) & (F.col("a.doc") < F.col("b.doc")) & _sizes_fit("a.n", "b.n"))
        .select(F.col("a.doc").alias("u"), F.col("b.doc").alias("v"))
        .distinct()
    )
    crowded = between.filter((F.col("members") > SMALL) & (F.col("groups") <= HOT)).select("sig")
    crowd = written(_in_blocks(placed.join(crowded, "sig"), sets))

    hot_sigs = between.filter(F.col("groups") > HOT).select("sig")
    hot = placed.join(hot_sigs, "sig").select("doc", "sig")
    marked = (
        once.filter(F.col("info") <= -MARK)
        .join(copies, "doc", "left")
        .select(F.coalesce("first", "doc").alias("doc"), F.lit(None).cast("long").alias("sig"))
    )
    short = hot.unionByName(marked).groupBy("doc").agg(F.collect_set("sig").alias("passed"))
    near = written(_neighbourhoods(docs, written(short), text, key))
    near = near.join(groups_now.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "component", F.coalesce("component", "doc")
    )
    p, q = near.filter("probed").alias("p"), near.alias("q")
    around = (
        p.join(q, F.col("p.sig") == F.col("q.sig"))
        .filter(
            (F.col("p.component") != F.col("q.component"))
            & ~(F.col("p.deleted") & F.col("q.deleted"))
            & (F.col("p.lost") == F.col("q.lost"))
            & _sizes_fit("p.n", "q.n")
        )
        .select(F.least("p.doc", "q.doc").alias("u"), F.greatest("p.doc", "q.doc").alias("v"))
        .distinct()
    )
    rest = written(more.unionByName(around).unionByName(crowd).distinct().join(tried, ["u", "v"], "left_anti"))
    return sets.select("doc", "n"), edges.unionByName(written(_verified(docs, written(_plausible(rest, sets)), text, key)))


def similar_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, n_shingles and component_id of every row of ``docs``.

    ``key`` is a whole number. Rows that share a key are one node of the graph, each with its own
    set. Null texts and texts without words have the empty set and no links; a null key takes no
    part in linking and has a null component. Letter case counts beyond A-Z. Empty tables give an
    empty table; further columns are left behind. Sets are compared by 64-bit shingle hashes.
    """
    sets, edges = links(docs, text, key)
    found = written(components(edges))
    return sets.join(found.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of every group of similar documents, the one with the smallest key; columns as
    they came. Of rows that share a key, the least text stays (null before others). Rows with a
    null key stay, and an empty table gives an empty table."""
    groups = written(similar_groups(docs, text, key))
    again = groups.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")
    gone = groups.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    again = written(again.join(gone, key, "left_anti").select(key))
    touched = written(gone.unionByName(again))
    alone = docs.join(checked_broadcast(touched, BROADCAST_IDS), key, "left_anti")
    doubled = docs.join(checked_broadcast(again, BROADCAST_IDS), key, "left_semi")
    place = F.row_number().over(Window.partitionBy(key).orderBy(text))
    first = packed(doubled, docs.columns, place=place).filter("place = 1").select(*unpacked(docs.columns))
    return alone.unionByName(first).select(*docs.columns)
