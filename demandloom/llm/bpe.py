"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled in rank order, one *merge gadget* each, starting from the automaton with
one state and a loop per byte. A state stands for the token read last. The gadget for ``a b -> c``

* gives c's state the outgoing arcs that b's state has at that moment,
* removes the arc b from a's state, and
* adds an arc c wherever there is an arc a.

What is left after the last merge are exactly the correct tokenizations: a chain of tokens is the
library's encoding of its bytes when every arc on its path exists. Writing all arcs out would
need the square of the vocabulary, so a gadget is kept as what it changed (parent states and the
removed arc, each with its rank) and an arc is resolved through the gadgets when first used.

Encoding reads a word once from left to right through a transition table over bytes. Its states are the
prefixes of the labels, a transition leads to the longest one that the bytes read so far end in, and a
state lists the labels that end there, longest first. Every prefix of a word has exactly one path, so per position one arc is
kept: the first label of the state's list that may follow the token before it. Decoding emits the arc labels.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path
from struct import pack
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

#: Fixed value: how byte-level BPE splits text before merging.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept with their ids per Python worker; the oldest half goes when they are twice as many.
CACHED_WORDS = 64_000
#: Places for the hashes of words met once, which are not kept yet; emptied when a quarter is taken.
MET_PLACES = 1 << 22
#: Arcs, and entries of the transition table, kept per Python worker.
CACHED_ENTRIES = 170_000
#: Texts encoded before a batch goes back, so that long texts do not pile up.
ROWS_AT_ONCE = 200


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, the byte-level alphabet of such vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = dict(zip(map(chr, plain), plain))
    rest = (b for b in range(256) if b not in stand_in.values())
    return stand_in | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Compiled merges. ``spec`` is a byte-level BPE file of the tokenizers library, parsed."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (
            (model["type"], pre["type"], spec["normalizer"]) != ("BPE", "ByteLevel", None)
            or pre["add_prefix_space"]
            or not pre["use_regex"]
            or model.get("ignore_merges")
            or any(a[k] for a in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
        ):
            raise ValueError("not a plain byte-level BPE file")
        alphabet = byte_alphabet()
        ids = {bytes(alphabet[c] for c in s): i for s, i in model["vocab"].items()}
        self.labels = {i: s for s, i in ids.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.labels |= {i: s.encode() for s, i in self.special.items()}
        none = array("i", [-1]) * (max(self.labels) + 1)
        self.born, self.left, self.right = none, none[:], none[:]  # by token
        self.removed: dict[int, int] = {}
        self.n_merges = len(model["merges"])
        reachable = {s for s in ids if len(s) == 1}
        for rank, pair in enumerate(model["merges"]):
            first, second = pair if isinstance(pair, list) else pair.split(" ")
            self._gadget(rank, *(bytes(alphabet[c] for c in s) for s in (first, second)), ids, reachable)
        self.arcs: dict[int, bool] = {}
        self._tabulate(sorted(reachable), ids)

    def _gadget(self, rank: int, first: bytes, second: bytes, ids: dict[bytes, int], reachable: set[bytes]) -> None:
        a, b, c = ids[first], ids[second], ids[first + second]
        if self.born[c] >= 0:
            raise ValueError("two merges make the same token")
        if not {first, second} <= reachable or not self._resolve(a, b):
            return  # earlier merges never leave a next to b, so no path has this token
        reachable.add(first + second)
        self.born[c], self.left[c], self.right[c] = rank, a, b
        self.removed[a << 32 | b] = rank

    def _tabulate(self, labels: list[bytes], ids: dict[bytes, int]) -> None:
        """The prefixes of the sorted labels that some path has, as states by length: the states behind state s are
        ``first[s]`` up to ``first[s + 1]``, by the bytes ``into`` them. ``shorter`` is the longest proper ending that is
        a state, ``ends`` has the labels that end in a state, and ``table`` the transitions used last."""
        self.into, self.first = bytearray(1), array("i")
        self.shorter, self.ends = array("i", [0]), [()]
        self.table: dict[int, int] = {}
        level, depth, state = [(0, len(labels))], 0, 0  # of every state the labels that begin with it
        while level:  # by length, so that a state's endings are there before it
            deeper = []
            for start, stop in level:
                self.first.append(len(self.into))
                start += start < stop and len(labels[start]) == depth
                while start < stop:
                    byte, low = labels[start][depth], start
                    while start < stop and labels[start][depth] == byte:
                        start += 1
                    ending = self._follow(self.shorter[state], byte) if state else 0
                    self.into.append(byte)
                    self.shorter.append(ending)
                    ends, label = self.ends[ending], labels[low]
                    self.ends.append(((ids[label], depth + 1), *ends) if len(label) == depth + 1 else ends)
                    deeper.append((low, start))
                state += 1
            level, depth = deeper, depth + 1
        self.first.append(len(self.into))

    def _follow(self, state: int, byte: int) -> int:
        """The longest state that ``state`` and then ``byte`` end in."""
        into, first = self.into, self.first
        while (found := into.find(byte, first[state], first[state + 1])) < 0 and state:
            state = self.shorter[state]
        return max(found, 0)

    def _transition(self, key: int) -> int:
        """An entry of the table, filled in when first used."""
        if len(self.table) >= CACHED_ENTRIES:
            self.table.clear()
        found = self.table[key] = self._follow(key >> 8, key & 255)
        return found

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state``."""
        key = state << 32 | token
        return self.arcs[key] if key in self.arcs else self._arc(key)

    def _arc(self, key: int) -> bool:
        if len(self.arcs) >= CACHED_ENTRIES:
            self.arcs.clear()
        found = self.arcs[key] = self._resolve(key >> 32, key & 0xFFFFFFFF)
        return found

    def _resolve(self, x: int, y: int) -> bool:
        before = self.n_merges
        while True:
            if self.removed.get(x << 32 | y, before) < before:
                return False
            x_born, y_born = self.born[x], self.born[y]
            if x_born < 0 and y_born < 0:
                return True
            if y_born >= x_born:  # the arc was copied after its gadget's removal
                before, y = y_born + 1, self.left[y]
            else:  # the state was copied before it
                before, x = x_born, self.right[x]

    def encode_word(self, word: bytes) -> list[int]:
        table, ends, arcs = self.table, self.ends, self.arcs
        last, state = [(-1, 0)] * (len(word) + 1), 0
        for end, byte in enumerate(word, 1):
            key = state << 8 | byte
            state = table.get(key, -1)
            if state < 0:
                state = self._transition(key)
            for label in ends[state]:
                token, length = label
                if length == end:
                    last[end] = label
                    break
                key = last[end - length][0] << 32 | token
                follows = arcs.get(key)
                if follows if follows is not None else self._arc(key):
                    last[end] = label
                    break
        path, end = [], len(word)
        while end:
            token, length = last[end]
            path.append(token)
            end -= length
        return path[::-1]


class _Packed(dict):
    """Word -> its ids as little-endian unsigned 32-bit integers: the last CACHED_WORDS words or more,
    and as many before them. A word is kept when it comes again, as most words of a large table never do."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton
        self.before: dict[str, bytes] = {}
        self.met, self.n_met = bytearray(MET_PLACES), 0

    def __missing__(self, word: str) -> bytes:
        packed = self.before.get(word)
        if packed is None:
            ids = self.automaton.encode_word(word.encode())
            packed = pack(f"<{len(ids)}I", *ids)
            place = hash(word) % MET_PLACES
            if not self.met[place]:
                if self.n_met >= MET_PLACES // 4:
                    self.met, self.n_met = bytearray(MET_PLACES), 0
                self.met[place] = 1
                self.n_met += 1
                return packed
        if len(word) < 200:
            if len(self) >= CACHED_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = packed
        return packed


def _unassigned() -> re.Pattern:
    """Matches characters that this Python's Unicode tables do not know."""
    ranges, start = [], None
    for c in range(0x500, 0x110001):
        new = c < 0x110000 and category(chr(c)) == "Cn"
        if new and start is None:
            start = c
        elif not new and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


class Codec:
    """Splits texts, encodes their words and decodes ids; one per Python worker and file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text())
        self.automaton = Automaton(spec)
        self.packed = _Packed(self.automaton)
        self.split = regex.compile(PRE_SPLIT)
        special = sorted(self.automaton.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.has_special = bool(special)
        self.far = re.compile("[\u0500-\U0010ffff]")
        self.unassigned = _unassigned()

    def words(self, text: str) -> list[str]:
        """The words of a text. Unicode tables of the installed libraries differ in age, so a
        text with characters that may be letters only for one is split by the other."""
        if not text.isascii() and self.far.search(text) and self.unassigned.search(text):
            alphabet = byte_alphabet()
            parts = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
            return [bytes(alphabet[c] for c in word).decode() for word, _ in parts]
        return self.split.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.has_special:
            return b"".join(map(self.packed.__getitem__, self.words(text)))
        out = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(self.automaton.special[part].to_bytes(4, "little"))
            elif part:
                out.extend(map(self.packed.__getitem__, self.words(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        labels = self.automaton.labels
        return b"".join(
            map(labels.__getitem__, np.frombuffer(ids, "<u4").tolist())
        ).decode(errors="replace")


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode(
    docs: DataFrame, path: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keys``, ``ids`` and ``n_tokens`` of every row, in one pass without a shuffle.

    ``ids`` holds the ids as little-endian unsigned 32-bit integers in one binary value. A null
    text counts as empty and an empty text has no ids. Repeated rows and null keys stay as they
    are; an empty table gives an empty table; further columns are left behind. A text's length
    is bounded only by the row size Spark itself allows. ``path`` names the vocabulary file,
    present on every node.
    """
    return _mapped(docs, path, text, keys, decoded=False)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``encode`` plus ``decoded``, the text that the ids give back, in the same pass."""
    return _mapped(docs, path, text, keys, decoded=True)


def decode(
    encoded: DataFrame, path: str, ids: str = "ids", keys: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keys`` and ``decoded`` of every row; null ids give an empty text."""
    kept = encoded.select(*keys, F.col(ids).alias("ids"))
    schema = T.StructType([*(kept.schema[k] for k in keys), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_one = codec(path).decode
        for batch in batches:
            texts = [decode_one(x or b"") for x in batch.column("ids").to_pylist()]
            columns = [batch.column(k) for k in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema.names)
            pa.default_memory_pool().release_unused()

    return kept.mapInArrow(run, schema)


def _mapped(docs: DataFrame, path: str, text: str, keys: tuple[str, ...], decoded: bool) -> DataFrame:
    kept = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    more = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    more += [T.StructField("decoded", T.StringType())] * decoded
    schema = T.StructType([*(kept.schema[k] for k in keys), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                ids = [own.encode(t) for t in batch.column(len(keys)).to_pylist()]
                out = [batch.column(k) for k in range(len(keys))]
                out += [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
                if decoded:
                    out.append(pa.array([own.decode(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, schema.names)
            pa.default_memory_pool().release_unused()  # else it holds several times what is in use

    return kept.mapInArrow(run, schema)
