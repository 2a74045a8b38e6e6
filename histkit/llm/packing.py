"""Packing: documents as token windows by best-fit decreasing.

A document is tokenized, ended by an end id and cut into full windows and one rest. Best-fit
decreasing then only depends on how many pieces there are of each length, so it runs on that
histogram (at most ``window`` numbers, whatever the input's size) and yields a plan: pieces of
length L with ranks lo..hi go to consecutive windows. Ranks are counted inside the tokenizing
tasks and shifted by the counts of earlier tasks, so no length, however frequent, meets in one
task, and token ids are never shuffled.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histkit.llm.common import bounded_batches, store

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, rank long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, padded_length long"


#: Bytes of each of the two generations of words that a worker process remembers.
ROOM = 120_000_000


class WordIds:
    """Token ids of whole texts, remembered per white-space separated word.

    Holds for tokenizers that drop white space and never merge across it, as the pre-tokenizer
    of ``word_bpe_49k.json`` does. Memory is bounded: two generations of ``room`` bytes.
    """

    #: Bytes of a remembered word beside its own and its ids': two objects and a place in the table.
    EACH = 180

    #: Lower-case letters that neither normalization nor lower-casing changes.
    PLAIN = re.compile("[a-zà-öø-ÿ]+")
    ENDS = b".,;:!?"

    def __init__(self, path: str, room: int = ROOM):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.room, self.held = room, 0
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # The byte-level alphabet: visible Latin-1 characters stand for themselves, the other
        # bytes for the characters from 256 on, in order.
        seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in seen]
        self.alphabet = [chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)]

    def limit(self, room: int) -> None:
        """Remember ``room`` bytes a generation from now on; with less room than before nothing is kept."""
        if room < self.room:
            self.new, self.old, self.held = {}, {}, 0
        self.room = room

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        raw = text.encode()
        if b"<|" not in raw:  # else a special token could arise
            raw = raw.lower()
        words = raw.split()
        ids = list(map(self.new.get, words))
        if None in ids:
            ids = [self._word(w) if x is None else x for x, w in zip(ids, words)]
        return b"".join(ids)

    def _word(self, word: bytes) -> bytes:
        known = self.new.get(word) or self.old.get(word)
        if known is None:
            stem = word.rstrip(self.ENDS)
            # Marks behind a letter or digit are a piece of their own; behind any other sign they belong to its piece.
            if stem != word and b"<|" not in word and (stem[-1:].isalnum() or self.PLAIN.fullmatch(stem.decode()[-1:])):
                known = self._word(stem) + self._word(word[len(stem) :])
            else:
                known = self._tokenize(word.decode())
        if self.held >= self.room:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[word] = known
        self.held += len(word) + len(known) + self.EACH
        return known

    def _tokenize(self, word: str) -> bytes:
        if self.PLAIN.fullmatch(word):
            letters = word if word.isascii() else "".join(map(self.alphabet.__getitem__, word.encode()))
            ids = [t.id for t in self.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


def word_ids(path: str, room: int = ROOM) -> WordIds:
    """This process' memory of a tokenizer's words. A worker process runs many tasks, so it is kept
    on an installed module: this one is sent along with each task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_word_ids", {})
    if path not in kept:
        kept[path] = WordIds(path, room)
    kept[path].limit(room)
    return kept[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, room: int = ROOM) -> DataFrame:
    """One row per piece, with the number of the task that cut it and its rank among the pieces
    of its length there. Stored, as a second run of a task may see other rows."""
    bounded_batches(docs)
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = word_ids(tokenizer_path, room), TaskContext.get().partitionId()
        ranks = [0] * (window + 1)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    n = len(piece) // 4
                    rows.append((doc, start, n, zlib.crc32(piece), total, part, ranks[n]))
                    ranks[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 7, names=[f.split()[0] for f in PIECES.split(", ")])

    return store(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES), "pieces")


class FreeWindows:
    """Runs of open windows by remaining capacity, under a segment tree of the capacities in use."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.used = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _mark(self, capacity: int, used: bool) -> None:
        node = self.leaves + capacity
        self.used[node] = used
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def add(self, capacity: int, first: int, n: int) -> None:
        self.runs[capacity].append((first, n))
        if not self.used[self.leaves + capacity]:
            self._mark(capacity, True)

    def tightest(self, length: int) -> int | None:
        """The least capacity in use that is at least ``length``."""
        node = self.leaves + length
        while not self.used[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node //= 2
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node = 2 * node if self.used[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].pop()
        if not self.runs[capacity]:
            self._mark(capacity, False)
        return run


def best_fit_plan(counts: Sequence[int], window: int) -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """Best-fit decreasing on ``counts[length]``.

    Returns the moves (length, first rank, end rank, pieces per window, first window, offset)
    and the runs of windows at the end (first window, number of windows, tokens in each).
    Equal pieces fill the tightest window as often as it holds them, so a run of windows
    moves as a whole: a run is used at most log2(window) times, and each length adds at most
    two runs.
    """
    free, moves, windows = FreeWindows(window), [], 0
    full = []
    for length in range(window, 0, -1):
        rank, n = 0, int(counts[length])
        while rank < n:
            capacity = free.tightest(length)
            if capacity is None:
                capacity = window
                first, k = windows, -(-(n - rank) // (window // length))
                windows += k
            else:
                first, k = free.take(capacity)
            each = capacity // length
            taken = min(n - rank, each * k)
            moves.append((length, rank, rank + taken, each, first, window - capacity))
            rank += taken
            whole, rest = divmod(taken, each)
            for left, start, m in (
                (capacity - each * length, first, whole),
                (capacity - rest * length, first + whole, int(rest > 0)),
                (capacity, first + whole + (rest > 0), k - whole - (rest > 0)),
            ):
                if m and left:
                    free.add(left, start, m)
                elif m:
                    full.append((start, m, window))
    ends = full + [(first, n, window - c) for c, runs in free.runs.items() for first, n in runs]
    return moves, sorted(ends)


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, room: int = ROOM) -> DataFrame:
    """Every document's pieces with their sequence and offset there.

    ``docs`` has doc_id and text; other columns are ignored. A null or empty text is the end
    id alone, a repeated row is packed again, an empty table gives no rows. A sequence is
    padded to ``window``, unless its number of tokens is a power of two.

    ``room`` bounds what worker processes remember of words, which they hold as long as they
    live; it changes time and memory only.
    """
    pieces = token_pieces(docs, tokenizer_path, window, end_id, room)
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    counts = [0] * (window + 1)
    for length, n in pieces.groupBy("length").count().collect():  # at most `window` rows
        counts[length] = n
    moves, ends = best_fit_plan(counts, window)
    plan = pieces.sparkSession.sparkContext.broadcast((np.array(moves, np.int64).reshape(-1, 6), np.array(ends, np.int64).reshape(-1, 3)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, runs = plan.value
        steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
        keys = (steps[:, 0] << 48) + steps[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            step = steps[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            nth = rank - step[:, 1]
            sequence = step[:, 4] + nth // step[:, 3]
            offset = step[:, 5] + nth % step[:, 3] * length
            tokens = runs[np.searchsorted(runs[:, 0], sequence, "right") - 1, 2]
            padded = np.where(tokens & (tokens - 1) == 0, tokens, window)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *(pa.array(x, pa.int64()) for x in (sequence, offset, tokens, padded))], names=[f.split()[0] for f in PLACED.split(", ")])

    ranked = pieces.join(bases, ["length", "part"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(place, PLACED)
