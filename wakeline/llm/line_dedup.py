"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Lines with equal sets are one class, which its first line stands
for. Words are ordered by rarity: those of a table of frequent words last, by count, the others
before them by hash. Two lines as similar as asked share a word among their first
``n - ceil(s * n) + 1``; if the first word they share is a frequent one, the first two are, among
one word more. So rare words are keys by themselves and frequent ones in twos, which keeps the
lists of lines under a key short. Keys are dealt to blocks by hash, as packed arrays; within a
block, lengths, positions and small bitmaps discard pairs, and word sets verify the rest. A line
goes if a similar one stands before it, in the order of ``doc_id`` and line number. One such match
is enough, so each line is verified against the earlier candidates whose bitmaps are nearest first,
and against all other earlier ones only where those fail: many versions of a line cost a few pairs
each, not the square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import (
    BROADCAST_IDS,
    dropped,
    kept,
    memory_returned,
    slices,
    tasks_find_package,
    text_of,
)

PERCENT = 80
#: Lines' words in a chunk, the count in a chunk that may make a word frequent, the count over all
#: that does, and the most frequent words kept (their ranks are the upper 16 bits of a code).
CHUNK, LOCAL, FREQUENT, FREQUENT_LIMIT = 1 << 19, 8, 256, (1 << 16) - 2
RANK_SHIFT = 48
BLOCK = 1 << 19
#: Blocks' worth of entries from which on they are worked off in rounds, so that only a round's
#: are shuffled at a time, and the rounds.
MANY, ROUNDS = 16, 4
#: Words of lines worked on at a time, bytes of text that have about one, and classes that a task
#: remembers.
LINES, LETTERS, WORDS = 1 << 17, 8, 150_000
#: Bytes of stored keys that are made entries at a time.
STORED = 1 << 20
ENTRY = np.dtype(
    [
        ("key", "<u4"),
        ("node", "<u8"),
        ("doc", "<u4"),
        ("n", "<u2"),
        ("at", "u1"),
        ("bits", "<u8", (2,)),
    ]
)
#: The same as it is stored: what a line's entries share once, and of each entry its key, its block
#: and its line's place among those stored with it.
LINE = np.dtype([("node", "<u8"), ("doc", "<u4"), ("n", "<u2"), ("bits", "<u8", (2,))])
KEY = np.dtype([("key", "<u4"), ("block", "<u4"), ("line", "<u4"), ("at", "u1")])
#: Sizes from here on are not told apart in an entry, nor are positions above 255; both only make
#: its filters let more through.
MOST_N = 65_535
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, eight bytes of all words at a time."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    ends = ends.astype(np.int64)
    if not len(words) or ends[0] == ends[-1]:
        return mixed(np.zeros(len(words), dtype=np.uint64))
    text = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    text = np.append(text, np.zeros(8, dtype=np.uint8))
    start, left = ends[:-1] - ends[0], np.diff(ends)
    out, own = left.astype(np.uint64) * _MIX, np.arange(len(words))
    while len(own):
        eight = text[start[:, None] + np.arange(8)].view("<u8")[:, 0]
        # what follows a word is no part of it
        beyond = (np.maximum(8 - left, 0) * 8).astype(np.uint64)
        out[own] = mixed(out[own] ^ (eight << beyond >> beyond))
        on = left > 8
        own, start, left = own[on], start[on] + 8, left[on] - 8
    return out


class Codes:
    """A word's rank among frequent words, 0 for all others, above the lower bits of its hash."""

    def __init__(self, frequent: np.ndarray):
        # frequent hashes in order, and the rank of each
        self.often = np.sort(frequent)
        self.ranks = np.argsort(frequent).astype(np.uint64) + np.uint64(1)

    def __call__(self, words: pa.Array) -> np.ndarray:
        found = hashes(words)
        codes = found & np.uint64((1 << RANK_SHIFT) - 1)
        if len(self.often):
            at = np.minimum(np.searchsorted(self.often, found), len(self.often) - 1)
            hit = self.often[at] == found
            codes[hit] |= self.ranks[at[hit]] << np.uint64(RANK_SHIFT)
        return codes


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one array, A-Z in lower case, and how many of them every text has."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    # white space at the ends leaves empty ones
    some = pc.greater(pc.binary_length(flat), 0)
    if some.false_count:
        owner = np.repeat(np.arange(len(sizes)), sizes)[some.to_numpy(zero_copy_only=False)]
        flat, sizes = flat.filter(some), np.bincount(owner, minlength=len(sizes))
    return flat, sizes


def _chunks(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[tuple[pa.Array, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array] | None]]:
    """Documents and their numbers of lines, and words of their lines.

    Of every line with a word: document, line number, number of words, and the words in one array.
    """
    for batch in slices(batches, 1, min(CHUNK, LINES) * LETTERS):
        lines = pc.split_pattern(batch.column(1), "\n")
        count = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
        number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        words, sizes = _split(lines.flatten())
        some = sizes > 0
        doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), count)
        split = (doc[some], number[some], sizes[some], words) if some.any() else None
        yield (batch.column(0), count), split


def frequent_words(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Frequent words' hashes, the rarest first, and the bytes of all texts.

    Only the order of words and the number of blocks rest on them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(words: pa.Array, n: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

        def standing_out(parts: list[pa.Array]) -> pa.RecordBatch:
            counts = pa.chunked_array(parts, pa.string()).value_counts()
            counts = counts.filter(pc.greater_equal(counts.field("counts"), LOCAL))
            words = hashes(counts.field("values"))
            return counted(pa.array(words.view(np.int64)), counts.field("counts"))

        parts, size, read = [], 0, 0
        for batch in slices(batches, 1, CHUNK * LETTERS):
            read += pc.sum(pc.binary_length(batch.column(1))).as_py()
            parts.append(_split(batch.column(1))[0])
            size += len(parts[-1])
            if size >= CHUNK:
                yield standing_out(parts)
                parts, size = [], 0
        if parts:
            yield standing_out(parts)
        # the row without a word has the bytes
        yield counted(pa.nulls(1, pa.int64()), pa.array([read], pa.int64()))
        parts.clear()
        memory_returned()

    each = docs.mapInArrow(run, "word long, n long")
    often = (F.col("n") >= FREQUENT) | F.col("word").isNull()
    counts = kept(each.groupBy("word").agg(F.sum("n").alias("n")).where(often))
    read = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
    counts, least = counts.where("word is not null"), FREQUENT
    while counts.where(F.col("n") >= least).count() > FREQUENT_LIMIT:
        least *= 2
    rows = counts.where(F.col("n") >= least).toPandas().sort_values(["n", "word"])
    return rows["word"].to_numpy(dtype=np.int64).view(np.uint64), read


def _line_sets(
    words: pa.Array, sizes: np.ndarray, coder: Codes
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of every line in order, their lines, and where each line begins."""
    words = words.dictionary_encode()
    codes, place = np.unique(coder(words.dictionary), return_inverse=True)
    # line and place in one number, so that a plain sort does
    both = np.repeat(np.arange(len(sizes), dtype=np.uint64) << np.uint64(32), sizes)
    both |= place.astype(np.uint64)[words.indices.to_numpy()]
    both.sort()
    both = both[np.insert(both[1:] != both[:-1], 0, True)]
    line = (both >> np.uint64(32)).astype(np.int64)
    codes = codes[both & np.uint64(0xFFFFFFFF)]
    return codes, line, np.searchsorted(line, np.arange(len(sizes)))


def _keys(codes, line, begin, n, node, doc, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All lines, and keys of every line: its leading rare words, and its leading frequent ones in twos."""
    lead = n - (percent * n + 99) // 100 + 1
    at = np.arange(len(codes)) - begin[line]
    often = codes >> np.uint64(RANK_SHIFT) > 0
    # whether an odd number of words falls on each of 128 bits, in two halves: two sets differ in
    # no fewer words than bits, and sets of many words fill a bitmap no more than half
    place = mixed(codes)
    bit = np.left_shift(np.uint64(1), place & np.uint64(63))
    half = place & np.uint64(64) > 0
    halves = [np.where(half, np.uint64(0), bit), np.where(half, bit, np.uint64(0))]
    bits = np.column_stack([np.bitwise_xor.reduceat(h, begin) for h in halves])
    # a set of few words is similar to none but its own class, which needs no candidates
    wide = (100 * n >= percent * (n + 1))[line]
    # one that may share a single word has no two of them for a key
    alone = (percent * n <= 100)[line]
    single = np.flatnonzero((~often | alone) & (at < lead[line]) & wide)
    keys, where = [mixed(codes[single])], [single]
    first = np.flatnonzero(often & (at <= lead[line]) & wide)
    step = 1
    while len(first):
        first = first[first + step < len(codes)]
        second = first + step
        fits = (line[second] == line[first]) & (at[second] <= lead[line[second]])
        first, second = first[fits], second[fits]
        keys.append(mixed(codes[first] * _MIX + codes[second]))
        where.append(first)
        step += 1
    key, where = np.concatenate(keys), np.concatenate(where)
    lines = np.empty(len(n), dtype=LINE)
    lines["node"], lines["n"], lines["bits"] = node, np.minimum(n, MOST_N), bits
    # tells documents with ids from 0 to 2^32 - 2 apart; others count as one
    lines["doc"] = np.clip(doc, -1, 2**32 - 2) + 1
    keys = np.empty(len(key), dtype=KEY)
    keys["key"] = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    keys["block"] = (key >> np.uint64(32)).astype(np.uint32)
    keys["line"], keys["at"] = line[where], np.minimum(at[where], 255)
    return lines, keys


def _whole(lines: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys), dtype=ENTRY)
    own = lines[keys["line"]]
    for column in ("node", "doc", "n", "bits"):
        out[column] = own[column]
    out["key"], out["at"] = keys["key"], keys["at"]
    return out


def _entries(codes, line, begin, n, node, doc, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of all lines, and the number by which each is dealt to a block."""
    lines, keys = _keys(codes, line, begin, n, node, doc, percent)
    return _whole(lines, keys), keys["block"]


def _stored(rows: np.ndarray) -> bytes:
    """The first bytes of all rows, then the second: those that rows share compress."""
    return np.ascontiguousarray(rows).view(np.uint8).reshape(-1, rows.itemsize).T.tobytes()


def _restored(stored: pa.Scalar, kind: np.dtype) -> np.ndarray:
    rows = np.frombuffer(stored.as_buffer(), np.uint8).reshape(kind.itemsize, -1).T
    return np.ascontiguousarray(rows).view(kind)[:, 0]


def _read_lines(
    docs: DataFrame, frequent: np.ndarray, percent: int, blocks: int, rounds: int, least_words: int
) -> DataFrame:
    """Rows of lines (``node, doc_id, line``), of stored ``lines`` with their ``keys`` by round, and
    of documents without both (``doc_id`` and, as ``line``, their number of lines).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = Codes(frequent), {}
        schema = pa.schema(
            [("node", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int32()),
             ("lines", pa.binary()), ("keys", pa.list_(pa.binary()))]
        )
        for (ids, count), split in _chunks(batches):
            columns = [pa.nulls(len(ids), pa.int64()), ids.cast(pa.int64())]
            columns.append(pa.array(count.astype(np.int32)))
            columns += [pa.nulls(len(ids), kind) for kind in schema.types[3:]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            if split is None:
                continue
            doc, numbers, sizes, words = split
            codes, line, begin = _line_sets(words, sizes, coder)
            n = np.diff(np.append(begin, len(codes)))
            node = np.add.reduceat(mixed(codes), begin)
            wide = n >= least_words
            columns = [
                pa.array(node[wide].view(np.int64)),
                pa.array(doc[wide].astype(np.int64)),
                pa.array(numbers[wide].astype(np.int32)),
                *(pa.nulls(int(wide.sum()), kind) for kind in schema.types[3:]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            # copies of a line within a task need no second entry, unless they stand earlier: the
            # least document of all entries of a class is that of its first line
            order = np.lexsort((doc, node))
            head = np.insert(node[order][1:] != node[order][:-1], 0, True)
            fresh = np.zeros(len(n), dtype=bool)
            joins = (n >= least_words) & (100 * n >= percent * (n + 1))
            head = order[head]
            for i in head[joins[head]].tolist():
                own, at = int(node[i]), int(doc[i])
                if own not in seen or at < seen[own]:
                    seen[own] = at
                    fresh[i] = True
            if len(seen) > WORDS:
                seen.clear()
            stay = fresh[line]
            if not stay.any():
                continue
            codes, line = codes[stay], (np.cumsum(fresh) - 1)[line[stay]]
            n, node, doc = n[fresh], node[fresh], doc[fresh]
            begin = np.searchsorted(line, np.arange(len(n)))
            lines, keys = _keys(codes, line, begin, n, node, doc, percent)
            keys["block"] %= np.uint32(blocks)
            keys = keys[np.argsort(keys["block"], kind="stable")]
            own = [_stored(keys[keys["block"] % rounds == r]) for r in range(rounds)]
            columns = [pa.nulls(1, kind) for kind in schema.types[:3]]
            columns += [pa.array([_stored(lines)], pa.binary()), pa.array([own], schema.types[4])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        seen.clear()
        memory_returned()

    schema = "node long, doc_id long, line int, lines binary, keys array<binary>"
    return docs.mapInArrow(run, schema)


def _dealt(stored: DataFrame, number: int) -> DataFrame:
    """``block, entries``: whole entries of the blocks of a round, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, STORED):
            entries, block = [], []
            for lines, keys in zip(batch.column(0), batch.column(1)):
                keys = _restored(keys, KEY)
                entries.append(_whole(_restored(lines, LINE), keys))
                block.append(keys["block"])
            entries, block = np.concatenate(entries), np.concatenate(block)
            order = np.argsort(block, kind="stable")
            entries, block = entries[order], block[order]
            cut = np.flatnonzero(np.diff(block.astype(np.int64), prepend=-1))
            packed = [e.tobytes() for e in np.split(entries, cut[1:])] if len(cut) else []
            arrays = [pa.array(block[cut].astype(np.int32)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "entries"])
        memory_returned()

    own = stored.select("lines", F.col("keys")[number].alias("keys"))
    return own.mapInArrow(run, "block int, entries binary")


def _close(entries: np.ndarray, percent: int) -> tuple[np.ndarray, Iterator]:
    """Sorted entries, and positions of pairs that sizes, places and bitmaps leave possible.

    With the positions comes the share of bits in which the two differ, in 65,535ths.
    """
    key, node, doc = (np.ascontiguousarray(entries[c]) for c in ("key", "node", "doc"))
    n = entries["n"].astype(np.uint64)
    lead = key.astype(np.uint64) << np.uint64(32) | n << np.uint64(16) | node & np.uint64(0xFFFF)
    order = np.argsort(lead)
    lead = lead[order]
    # what one number does not tell apart goes by all of node and document
    same = lead[1:] == lead[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False)) if len(lead) else []
    if len(tied):
        own = order[tied]
        order[tied] = own[np.lexsort((doc[own], node[own], lead[tied]))]
    key, node = key[order], node[order]
    again = (key[1:] == key[:-1]) & (node[1:] == node[:-1])
    order = order[np.insert(~again, 0, True)] if len(order) else order
    e = entries[order]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        key, n = e["key"].copy(), e["n"].astype(np.int64)
        after = np.where(n == MOST_N, 1 << 40, n - e["at"] - 1)
        low, high = e["bits"][:, 0].copy(), e["bits"][:, 1].copy()
        active, step = np.arange(len(e)), 1
        while len(active):
            active = active[active + step < len(e)]
            x, y = active, active + step
            near = (key[x] == key[y]) & (100 * n[x] >= percent * n[y])
            active = x = x[near]
            y = y[near]
            need = (percent * (n[x] + n[y]) + 99 + percent) // (100 + percent)
            fits = 1 + np.minimum(after[x], after[y]) >= need
            x, y, need = x[fits], y[fits], need[fits]
            apart = np.bitwise_count(low[x] ^ low[y]).astype(np.int64)
            apart += np.bitwise_count(high[x] ^ high[y])
            fits = apart <= n[x] + n[y] - 2 * need
            x, y = x[fits], y[fits]
            yield x, y, MOST_N * apart[fits] // (n[x] + n[y])
            step += 1

    return e, pairs()


def close_pairs(entries: np.ndarray, percent: int, among: np.ndarray | None = None) -> np.ndarray:
    """Distinct possible pairs of nodes under one key; of those ``among`` some, with earlier ones.

    A pair stays if the later of the two, either one in a document of both, is among them.
    """
    if among is not None:  # keys that none of them has bring no pair
        entries = entries[np.isin(entries["key"], entries["key"][np.isin(entries["node"], among)])]
    e, pairs = _close(entries, percent)
    wanted = np.ones(len(e), dtype=bool) if among is None else np.isin(e["node"], among)
    found = [np.empty((0, 2), dtype=np.uint64)]
    doc = e["doc"].copy()
    for x, y, _ in pairs:
        take = wanted[x] & (doc[y] <= doc[x]) | wanted[y] & (doc[x] <= doc[y])
        found.append(np.column_stack([e["node"][x[take]], e["node"][y[take]]]))
    both = np.concatenate(found).view(np.int64).reshape(-1, 2)
    return np.unique(np.sort(both, axis=1), axis=0)


def earliest_partners(entries: np.ndarray, percent: int) -> pd.DataFrame:
    """``a, b, more``: for every node the nearest of its possible earlier partners under a key.

    ``more`` tells that it has others that may stand before it: a second one, or one whose
    document cannot be told to be earlier.
    """
    e, pairs = _close(entries, percent)
    doc = e["doc"].astype(np.uint64)
    best, count = np.full(len(e), ~np.uint64(0)), np.zeros(len(e), dtype=np.int64)
    for x, y, apart in pairs:
        first = doc[x] < doc[y]
        same = doc[x] == doc[y]
        later = np.concatenate([np.where(first, y, x), np.where(first, x, y)[same]])
        other = np.concatenate([np.where(first, x, y), np.where(first, y, x)[same]])
        near = np.concatenate([apart, apart[same]]).astype(np.uint64)
        np.minimum.at(best, later, near << np.uint64(32) | other.astype(np.uint64))
        np.add.at(count, later, 1)
        np.add.at(count, np.concatenate([x[same], y[same]]), 1)
    has = np.flatnonzero(count)
    other = (best[has] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    node = e["node"].view(np.int64) if e["node"].flags["C_CONTIGUOUS"] else e["node"].copy().view(np.int64)
    return pd.DataFrame({"a": node[has], "b": node[other], "more": count[has] > 1})


def _unpacked(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["entries"]), dtype=ENTRY)


def _first_candidates(packed: DataFrame, percent: int) -> DataFrame:
    """``a, b, more, block``."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = earliest_partners(_unpacked(frame), percent)
        pa.default_memory_pool().release_unused()
        return found.assign(block=frame["block"].iloc[0])

    return packed.groupBy("block").applyInPandas(run, "a long, b long, more boolean, block int")


def _other_candidates(packed: DataFrame, open_nodes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: all possible pairs of the nodes ``block, a``."""

    def run(frame: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(frame):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        among = nodes["a"].to_numpy(dtype=np.int64).view(np.uint64)
        pairs = close_pairs(_unpacked(frame), percent, among)
        pa.default_memory_pool().release_unused()
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    both = packed.groupBy("block").cogroup(open_nodes.groupBy("block"))
    return both.applyInPandas(run, "a long, b long").distinct()


def _word_sets(docs: DataFrame, wanted: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``node, words``: sorted codes of the words of the lines ``node, doc_id, line``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Codes(frequent)
        for batch in slices(batches, 0, LINES * LETTERS):
            lines, places = pc.split_pattern(batch.column(0), "\n"), batch.column(1)
            count = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
            of = pc.list_value_length(places).to_numpy(zero_copy_only=False)
            owner, places = np.repeat(np.arange(len(of)), of), places.flatten()
            line, node = (places.field(c).to_numpy(zero_copy_only=False) for c in ("line", "node"))
            there = line < count[owner]
            at = (np.cumsum(count) - count)[owner[there]] + line[there]
            words, sizes = _split(lines.flatten().take(pa.array(at)))
            some = sizes > 0
            if not some.any():
                continue
            codes, _, begin = _line_sets(words, sizes[some], coder)
            # lines of other texts of the same id go again
            node = node[there][some]
            own = np.flatnonzero(np.add.reduceat(mixed(codes), begin).view(np.int64) == node)
            ends = np.append(begin, len(codes))
            sets = [codes[ends[i] : ends[i + 1]].tobytes() for i in own.tolist()]
            arrays = [pa.array(node[own]), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "words"])
        memory_returned()

    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line", "node")).alias("places"))
    places = kept(places)
    # few places are broadcast, which spares the texts a shuffle
    few = (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= BROADCAST_IDS
    found = docs.join(F.broadcast(places) if few else places, "doc_id").select("text", "places")
    sets = found.mapInArrow(run, "node long, words binary")
    sets = kept(sets.dropDuplicates(["node"]))
    dropped(places)
    return sets


def _flat(sets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all sets in one array, and how many every set has."""
    ends = np.frombuffer(sets.buffers()[1], np.int32)[sets.offset : sets.offset + len(sets) + 1]
    codes = np.frombuffer(sets.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy().view(np.uint64)
    return codes, np.diff(ends) // 8


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (x, n), (y, m) = _flat(batch.column(2)), _flat(batch.column(3))
            place = np.unique(np.concatenate([x, y]), return_inverse=True)[1].astype(np.uint64)
            pair = np.arange(batch.num_rows, dtype=np.uint64) << np.uint64(32)
            both = np.sort(np.concatenate([np.repeat(pair, n), np.repeat(pair, m)]) | place)
            shared = both[1:][both[1:] == both[:-1]] >> np.uint64(32)
            overlap = np.bincount(shared.astype(np.int64), minlength=batch.num_rows)
            good = 100 * overlap >= percent * (n + m - overlap)
            yield batch.select(["a", "b"]).filter(pa.array(good))
        memory_returned()

    one = sets.select(F.col("node").alias("a"), F.col("words").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("words").alias("right"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a long, b long")


def _places(lines: DataFrame) -> tuple[Column, Column, Column]:
    """A line's place, to be compared, and the ``doc_id`` and ``line`` of a place ``first``.

    Both are in one number where they fit, which aggregates without sorting, else in a struct.
    """
    row = lines.agg(F.min("doc_id"), F.max("doc_id"), F.max("line")).first()
    low, high, line = (x or 0 for x in row)
    width, first = line.bit_length(), F.col("first")
    if low >= 0 and high.bit_length() + width < 64:
        place = F.shiftleft("doc_id", width).bitwiseOR(F.col("line").cast("long"))
        line = first.bitwiseAND(F.lit((1 << width) - 1).cast("long")).cast("int")
        return place, F.shiftright(first, width).alias("doc_id"), line.alias("line")
    return F.struct("doc_id", "line"), F.col("first.doc_id"), F.col("first.line")


def later_lines(docs: DataFrame, percent: int = PERCENT, least_words: int = 1) -> DataFrame:
    """``doc_id, removed``: numbers, from 0, of the lines that repeat an earlier one.

    Words are runs of characters other than ASCII white space, A-Z in lower case; lines are cut at
    line feeds. Two lines are similar if their sets of words overlap in ``percent`` of their union
    or more. Lines without a word, or with fewer different words than ``least_words``, are left
    alone, as are rows without ``doc_id`` or text. Rows that share a ``doc_id`` stand at one
    place, so their lines of one number do not remove each other. Sets are told apart by 64-bit
    hashes. Documents with nothing to remove have no row; an empty table gives none; further
    columns are ignored.
    """
    return _later_lines(docs, percent, least_words)[0]


def _later_lines(docs: DataFrame, percent: int, least_words: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, removed`` and, of every row with an id and a text, ``doc_id, n`` lines."""
    tasks_find_package(docs.sparkSession)
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    frequent, read = frequent_words(docs)
    # about one key for every 30 bytes
    full = read // 30 // BLOCK
    blocks, rounds = max(64, full), ROUNDS if full >= MANY else 1
    read = kept(_read_lines(docs, frequent, percent, blocks, rounds, least_words))
    lines = read.where("node is not null").select("node", "doc_id", "line")
    texts = read.where("node is null and lines is null")
    texts = kept(texts.select("doc_id", F.col("line").cast("long").alias("n")))
    place, *own_place = _places(lines)
    classes = lines.groupBy("node").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows"))
    classes = kept(classes)
    stored = read.where("lines is not null")
    packed = [_dealt(stored, number) for number in range(rounds)]

    def late(pairs: DataFrame) -> DataFrame:
        """``node``: those of the pairs that are similar to an earlier one."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = kept(classes.join(ends.hint("shuffle_hash"), "node").select("node", "first"))
        sets = _word_sets(docs, wanted.select("node", *own_place), frequent)
        similar = _similar(pairs, sets, percent)
        one = wanted.select(F.col("node").alias("a"), F.col("first").alias("first_a"))
        two = wanted.select(F.col("node").alias("b"), F.col("first").alias("first_b"))
        ordered = similar.join(one, "a").join(two, "b")
        later = F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a"))
        nodes = kept(ordered.select(later.alias("node")).distinct())
        dropped(sets, wanted)
        return nodes

    def together(frames: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    # a line needs one earlier match: the nearest candidates first, others where those fail
    first = together([kept(_first_candidates(own, percent)) for own in packed])
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = kept(first.select(*ends).distinct())
    known = late(pairs)
    still = first.where("more").join(known, F.col("a") == F.col("node"), "left_anti")
    still = kept(still.select("block", "a").distinct())
    if not still.isEmpty():
        rest = [
            kept(_other_candidates(own, still.where(F.col("block") % rounds == number), percent))
            for number, own in enumerate(packed)
        ]
        others = together(rest).distinct().join(pairs, ["a", "b"], "left_anti")
        others = kept(others)
        dropped(*rest)
        known = known.unionByName(late(others)).distinct()
        dropped(others)
    late_nodes = known.withColumn("late", F.lit(True))
    # lines that stand once and stay need not be met again
    marked = classes.join(late_nodes, "node", "left").where("late or rows > 1")
    marked = marked.select("node", "first", "late").hint("shuffle_hash")
    gone = lines.join(marked, "node").where(F.col("late") | (place != F.col("first")))
    out = kept(gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed")))
    dropped(read, classes, first, pairs, still)
    return out, texts


def without_later_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with all their columns, less the lines that repeat an earlier one.

    A document all of whose lines go stays with an empty text. A column ``n_chars`` is set anew.
    """
    gone = later_lines(docs, percent).withColumnRenamed("doc_id", "d")
    # few lines are broadcast, which spares the texts a shuffle
    few = (gone.agg(F.sum(F.size("removed") + 1)).first()[0] or 0) <= BROADCAST_IDS
    gone = F.broadcast(gone) if few else gone
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    both = packed.join(gone, F.col("doc_id") == F.col("d"), "left")
    stay = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda p: ~F.array_contains("removed", p["i"]),
    )
    shorter = F.array_join(F.transform(stay, lambda p: p["x"]), "\n")
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(shorter)
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    columns = [new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return both.select(*columns)


def line_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` for every row; a null text has no lines."""
    gone, texts = _later_lines(docs, percent, 1)
    gone = gone.withColumnRenamed("doc_id", "d")
    other = docs.select("doc_id", "text").where("doc_id is null or text is null")
    lines = F.size(F.split(text_of("text"), "\n")).cast("long")
    lines = F.when(F.col("text").isNull(), 0).otherwise(lines)
    rows = texts.unionByName(other.select("doc_id", lines.alias("n")))
    rows = rows.withColumnRenamed("n", "n_lines")
    both = rows.join(gone, F.col("doc_id") == F.col("d"), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return both.select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed")
    )
