"""Phrase collocations from depth-truncated suffix subtrees, partitioned vertically by word prefixes.

Every word starts a suffix of at most ``depth`` words that ends with its piece. A task counts
its own suffixes first, so a passage that stands in many documents travels as one leaf per
task. Suffixes are then dealt by their prefix: all prefixes of one word that share a hash slot
go together, slots that hold more leaves than a subtree may have are divided by prefixes of
two words, then three, and slots are packed into groups that fit the memory budget. Each group
builds its subtrees alone: leaves in order, branches where neighbours part, and the total of
leaves below a node is the number of times its words occur. Nodes above the prefix of a slot
are in several groups and are summed afterwards.

The driver sees one number per slot. Leaves move as packed arrays with the words they need.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.llm.common import bounded_batches, store

UNKNOWN = "und"
#: Bytes that end a piece become line feeds, A-Z become a-z and tabs become blanks.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
_GAP = re.compile(rb"[ \n]")

#: Leaves that one group of subtrees holds in memory.
BUDGET = 1 << 18
#: Slots per group that is expected, and the most slots there are at any size (a number each on the driver).
SLOTS, MOST_SLOTS = 2, 1 << 18
#: A task hands on its counts when it has this many suffixes or words.
ROOM = 1 << 19
WORDS = 1 << 17
#: Bytes of text that are cut into words at once.
SEGMENT = 1 << 19

_BITS = 21  # of a word's number inside a task; a segment adds at most SEGMENT / 2 words to WORDS
#: Bits of a slot's number that the parts of a divided slot take.
_PARTS = 20
_LEAVES = "level int, slot long, n long, body binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def slots_of(hashes: Sequence[np.ndarray], level: int, slots: int) -> np.ndarray:
    """The slot of each prefix: language and the first ``level`` words, by their hashes."""
    x = _mix(hashes[0])
    for h in hashes[1 : level + 1]:
        x = _mix(x + h)
    return (x % np.uint64(slots)).astype(np.int64)


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) for w in words), np.uint64, len(words))


def pack_leaves(leaves: np.ndarray, counts: np.ndarray, words: Sequence[bytes]) -> bytes:
    """Leaves (rows of language, words; numbers into ``words``, 0 for none) with the words they use."""
    used, small = np.unique(leaves.ravel(), return_inverse=True)
    names = b"\n".join(words[i] for i in used)
    wide, most = np.min_scalar_type(max(len(used) - 1, 0)), np.min_scalar_type(int(counts.max()))
    import zstandard

    head = np.array([len(names), len(leaves), leaves.shape[1], wide.itemsize, most.itemsize], np.int64).tobytes()
    raw = head + names + small.reshape(leaves.shape).astype(wide).tobytes() + counts.astype(most).tobytes()
    return zstandard.compress(raw, 1)


def unpack_leaves(body: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    import zstandard

    body = zstandard.decompress(body)
    names, n, columns, wide, most = np.frombuffer(body, np.int64, 5).tolist()
    at = 40 + names
    leaves = np.frombuffer(body, f"u{wide}", n * columns, at).reshape(n, columns).astype(np.int64)
    counts = np.frombuffer(body, f"u{most}", n, at + n * columns * wide).astype(np.int64)
    return leaves, counts, body[40:at].split(b"\n")


def dealt(leaves: np.ndarray, counts: np.ndarray, words: Sequence[bytes], level: int, slots: int, inside: int = 0) -> pa.RecordBatch:
    """One row per slot of the leaves' prefixes; ``inside``: the slot of shorter prefixes that these divide."""
    hashes = word_hashes(words)
    slot = (inside << _PARTS) + slots_of([hashes[leaves[:, k]] for k in range(level + 1)], level, slots)
    order = np.argsort(slot, kind="stable")
    ends = np.append(np.nonzero(np.diff(slot[order]))[0] + 1, len(order))
    rows = []
    for part in np.split(order, ends[:-1]) if len(order) else []:
        rows.append((level, int(slot[part[0]]), len(part), pack_leaves(leaves[part], counts[part], words)))
    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["level", "slot", "n", "body"])


class Numbers(dict):
    """Words by number, in the order in which they were met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Counter:
    """Counts a task's suffixes, and hands them on by slots whenever it is full."""

    def __init__(self, depth: int, slots: int):
        self.depth, self.slots = depth, slots
        self.clear()

    def clear(self) -> None:
        self.number = Numbers({b"": 0, b"\n": 1})
        self.seen: dict[bytes, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: bytes, text: bytes) -> Iterator[pa.RecordBatch]:
        """Suffixes of texts that are joined by line feeds, segment by segment."""
        at, before = 0, []
        while at < len(text):
            end = at + SEGMENT
            cut = _GAP.search(text, end) if end < len(text) else None
            end = cut.start() if cut else len(text)
            words = before + text[at:end].replace(b"\n", b" \n ").split(b" ")
            if end == len(text):
                words += [b"\n"] * self.depth
            before = [w for w in words[-20:] if w][-(self.depth - 1) :]
            if len(before) < self.depth - 1:
                before = [w for w in words if w][-(self.depth - 1) :]
            yield from self._count(lang, words)
            at = end

    def _count(self, lang: bytes, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        ids = ids[ids != 0]
        n = max(len(ids) - self.depth + 1, 0)
        key, alive = ids[:n].copy(), ids[:n] != 1
        going = alive
        for k in range(1, self.depth):
            going = going & (ids[k : n + k] != 1)
            key = (key << _BITS) | np.where(going, ids[k : n + k], 0)
        self.seen.setdefault(lang, []).append(key[alive])
        self.size += n
        if self.size >= ROOM or len(self.number) >= WORDS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        words, leaves, counts = [*self.number], [], []
        for lang, keys in self.seen.items():
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            # The language is the first number of a leaf.
            columns = [np.full(len(key), len(words))] + [(key >> (_BITS * k)) & ((1 << _BITS) - 1) for k in reversed(range(self.depth))]
            words.append(lang)
            leaves.append(np.stack(columns, axis=1))
            counts.append(n)
        if self.size:
            yield dealt(np.concatenate(leaves), np.concatenate(counts), words, 1, self.slots)
        self.clear()


def suffix_leaves(docs: DataFrame, depth: int, slots: int) -> DataFrame:
    """Every task's suffixes of all texts, dealt by their first word."""
    bounded_batches(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(depth, slots)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts: dict[bytes, list[bytes]] = {}
            for lang, text in zip(langs, batch.column(1)):
                if body := text.as_py():
                    texts.setdefault(lang.encode().hex().encode(), []).append(body)
            for lang, bodies in texts.items():
                yield from counter.add(lang, b"\n".join(bodies).translate(_FOLD))
        yield from counter.flush()

    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text")).mapInArrow(count, _LEAVES)


def longer_prefixes(leaves: DataFrame) -> DataFrame:
    """The leaves of overfull slots, each slot divided into its number of ``parts`` by prefixes that
    are one word longer."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for level, slot, body, parts in zip(*(batch.column(k).to_pylist() for k in range(4))):
                yield dealt(*unpack_leaves(body), level + 1, parts, slot)

    return leaves.select("level", "slot", "body", "parts").mapInArrow(deal, _LEAVES)


def packed_groups(sizes: Sequence[int], budget: int) -> list[int]:
    """First-fit decreasing over the open groups of each remaining room (in 64ths of the budget)."""
    group, rooms, next_group = [0] * len(sizes), [[] for _ in range(65)], 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        need = min(64, -(-64 * sizes[i] // budget))
        for room in range(need, 65):
            if rooms[room]:
                g = rooms[room].pop()
                break
        else:
            g, room, next_group = next_group, 64, next_group + 1
        group[i] = g
        if room > need:
            rooms[room - need].append(g)
    return group


def _in_order(leaves: np.ndarray, words: int) -> np.ndarray:
    """The order of the rows: by one number per row where the words' numbers are small enough."""
    bits = max(words - 1, 1).bit_length()
    if bits * (leaves.shape[1] - 1) > 62:
        return np.lexsort([leaves[:, k] for k in reversed(range(leaves.shape[1]))])
    key = leaves[:, 1].copy()
    for k in range(2, leaves.shape[1]):
        key = (key << bits) | leaves[:, k]
    order = np.argsort(key)
    _, lang = np.unique(leaves[:, 0], return_inverse=True)
    return order[np.argsort(lang.astype(np.uint16)[order], kind="stable")] if lang.max() < 1 << 16 else np.lexsort([key, lang])


def subtree_nodes(bodies: Sequence[tuple[int, bytes]], depth: int, least: int) -> pa.Table:
    """Nodes of the subtrees over some slots' leaves (level, packed leaves): words and the number
    of leaves below. Nodes that are whole here and occur fewer than ``least`` times are left out.

    Leaves are put in order; where a leaf shares fewer than d words with the one before, a new
    node of depth d begins, and its total runs to the next such place.
    """
    number = Numbers({b"": 0})
    parts, counts, levels = [], [], []
    for level, body in bodies:
        leaves, n, words = unpack_leaves(body)
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        parts.append(ids[leaves])
        counts.append(n)
        levels.append(np.full(len(n), level))
    names = list(number)
    leaves, n, level = np.concatenate(parts), np.concatenate(counts), np.concatenate(levels)
    order = _in_order(leaves, len(names))
    leaves, n, level = leaves[order], n[order], level[order]
    differ = leaves[1:] != leaves[:-1]
    columns: list[list] = [[] for _ in range(depth + 3)]
    for d in range(depth + 1):  # the node of depth 0 holds all words of a language
        starts = np.append(0, np.nonzero(differ[:, : d + 1].any(axis=1))[0] + 1)
        total = np.add.reduceat(n, starts)
        # A node is whole if all leaves below it were dealt by prefixes no longer than its own words.
        whole = np.maximum.reduceat(level, starts) <= d
        keep = ((leaves[starts, d] != 0) | (d == 0)) & (~whole | (total >= least))
        rows = leaves[starts[keep]]
        columns[0] += [bytes.fromhex(names[i].decode()).decode() for i in rows[:, 0]]
        columns[1] += [d] * len(rows)
        for k in range(1, depth + 1):
            columns[k + 1] += [names[i].decode(errors="replace") if k <= d else None for i in rows[:, k]]
        columns[-1] += total[keep].tolist()
    types = [pa.string(), pa.int32(), *[pa.string()] * depth, pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "depth", *[f"w{k}" for k in range(1, depth + 1)], "f"])


def phrase_counts(docs: DataFrame, depth: int = 3, least: int = 10, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``depth`` words that occur ``least`` times or more (lang, depth, w1,
    w2, ..., f), and the number of word occurrences per language (lang, n)."""
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = int(min(MOST_SLOTS, max(64, SLOTS * (size // (5 * budget) + 1))))
    budget = max(budget, SLOTS * size // (5 * MOST_SLOTS))  # so that slots stay finer than groups at any size
    part = store(suffix_leaves(docs, depth, slots), "leaves")
    parts, fitting = [], []
    for level in range(1, depth + 1):
        sizes = {r.slot: r.n for r in part.groupBy("slot").agg(F.sum("n").alias("n")).collect()}  # about `slots` numbers
        full = {s for s, n in sizes.items() if n > budget} if level < depth else set()
        fitting += [(level, s, n) for s, n in sizes.items() if s not in full]
        parts.append(part)
        if not full:
            break
        # As fine as slots are on average, so a blob of leaves falls into few parts.
        named = [(s, min(1 << _PARTS, max(2, -(-2 * sizes[s] // budget)))) for s in sorted(full)]
        named = docs.sparkSession.createDataFrame(named, "slot long, parts int")
        part = store(longer_prefixes(part.join(F.broadcast(named), "slot")), "leaves")
    groups = packed_groups([n for *_, n in fitting], budget)
    # A level has about `slots` slots at most, as parts are no finer, so this table is bounded too. Divided slots are not in it.
    plan = docs.sparkSession.createDataFrame([(level, s, g) for (level, s, _), g in zip(fitting, groups)], "level int, slot long, group long")
    leaves = parts[0]
    for more in parts[1:]:
        leaves = leaves.unionByName(more)
    leaves = leaves.join(F.broadcast(plan), ["level", "slot"])
    schema = f"lang string, depth int, {', '.join(f'w{k} string' for k in range(1, depth + 1))}, f long"

    def build(group: pa.Table) -> pa.Table:
        return subtree_nodes(list(zip(group.column("level").to_pylist(), (b.as_py() for b in group.column("body")))), depth, least)

    words = [f"w{k}" for k in range(1, depth + 1)]
    nodes = leaves.select("group", "level", "body").groupBy("group").applyInArrow(build, schema)
    nodes = store(nodes.groupBy("lang", "depth", *words).agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("depth") == 0)), "phrases")
    return nodes.where("depth > 0"), nodes.where("depth = 0").select("lang", F.col("f").alias("n"))


def _score(a: Column, lr: Column) -> Column:
    """floor(1000000 a a / (l r)) in 38 decimal digits: exact up to 10^13 occurrences of a phrase."""
    wide = a.cast("decimal(13,0)")
    return F.call_function("div", wide * wide * F.lit(1_000_000).cast("decimal(7,0)"), lr)


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int | None = 2000, budget: int = BUDGET) -> DataFrame:
    """Phrases of 2 or 3 words with their scores, ranked per language.

    ``docs`` has text and lang; other columns are ignored. A null lang is ``und``, a null text
    empty, repeated rows count as often as they are there, and an empty table gives no rows. A
    phrase is left out when one of the longer phrases around it has ``share`` percent of its
    occurrences. Ties are ranked by count, then by the phrase's bytes; ``top`` rows per language
    are returned (None: all).
    """
    nodes, totals = phrase_counts(docs, 3, least, budget)
    one = nodes.where("depth = 1").select("lang", F.col("w1").alias("word"), "f")
    two = nodes.where("depth = 2").select("lang", "w1", "w2", "f")
    three = nodes.where("depth = 3").select("lang", "w1", "w2", "w3", "f")

    def counted(rows: DataFrame, counts: DataFrame, of: dict[str, str], alias: str) -> DataFrame:
        """``rows`` with the count of the phrase whose words are the columns ``of``."""
        side = counts.select(F.col("lang").alias("_lang"), *[F.col(c).alias(f"_{c}") for c in of], F.col("f").alias(alias))
        on = F.col("lang") == F.col("_lang")
        for c, mine in of.items():
            on &= F.col(mine) == F.col(f"_{c}")
        return rows.join(side, on).drop("_lang", *[f"_{c}" for c in of])

    # Parts of a frequent phrase are frequent themselves, so inner joins lose nothing.
    pairs = counted(counted(two, one, {"word": "w1"}, "l"), one, {"word": "w2"}, "r")
    triples = counted(counted(three, one, {"word": "w1"}, "l1"), two, {"w1": "w2", "w2": "w3"}, "r1")
    triples = counted(counted(triples, two, {"w1": "w1", "w2": "w2"}, "l2"), one, {"word": "w3"}, "r2")
    around = three.select("lang", "w1", "w2", "f").union(three.select("lang", "w2", "w3", "f")).groupBy("lang", "w1", "w2").agg(F.max("f").alias("longer"))
    pairs = pairs.join(around, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("f")))

    def product(l: str, r: str) -> Column:  # noqa: E741
        return F.col(l).cast("decimal(13,0)") * F.col(r).cast("decimal(13,0)")

    scored_pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), "l", "r", _score(F.col("f"), product("l", "r")).alias("score"))
    first, second = _score(F.col("f"), product("l1", "r1")), _score(F.col("f"), product("l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    scored_triples = triples.withColumns({"s1": first, "s2": second}).select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        F.col("f").alias("a"),
        F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    over = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored_pairs.union(scored_triples).withColumn("rank", F.row_number().over(over))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
