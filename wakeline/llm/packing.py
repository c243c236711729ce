"""Packing of tokenised documents into sequences of one length, by bounded-space online best fit.

A task reads its documents once, in order, and keeps at most ``open_bins`` sequences open. A bitset
holds a bit for every amount of free space that some open sequence has, so the tightest sequence
that takes a piece is the lowest set bit at or above the piece's length. When a new sequence is
needed and all places are taken, the fullest one closes. Nothing is shuffled and no piece waits:
a task's memory is its open sequences and one batch of rows, whatever the input's size.
"""

from __future__ import annotations

import string
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from wakeline.llm.common import memory_returned, slices, tasks_find_package

SCHEMA = (
    "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
)
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
ID_BYTES = 4
#: Words that each of two generations of a worker's memory holds.
WORD_CACHE = 250_000
#: Rows handed on at a time, and about the bytes of text encoded at a time.
ROWS, TEXT = 2_000, 1 << 20
MARK_CACHE = 10_000


class BestFit:
    """Open sequences in a bitset keyed by their free space."""

    def __init__(self, capacity: int, open_bins: int, first_id: int = 0):
        self.capacity, self.open_bins, self.next_id = capacity, open_bins, first_id
        self.free_bits, self.open_count = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.free_bits ^= 1 << free
        self.open_count -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes a piece of this length, and the piece's offset there."""
        fitting = self.free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            if self.open_count == self.open_bins:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            if not self.by_free[left]:
                self.free_bits |= 1 << left
            self.by_free[left].append(sequence)
            self.open_count += 1
        return sequence, self.capacity - free


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordIds:
    """Ids of whole texts, put together from the ids of their words.

    The tokenizer never joins characters across white space, so words separated by ASCII white
    space can be encoded by themselves; each distinct word is encoded once and remembered. It
    lowers case and cuts letters from punctuation. A plain word (letters below U+0180, where
    composition and case have no exceptions but U+0130 and U+0149, perhaps with ASCII punctuation
    after them) therefore goes to its merge model as it is; all others take the whole way.
    """

    LETTERS = _byte_letters()
    PLAIN_BELOW, ODD = 0x180, "\u0130\u0149"
    PUNCTUATION = string.punctuation.encode()

    def __init__(self, tokenizer_path: str):
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.known_marks: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        out = []
        for text in texts:
            # lowers ASCII letters only, as these are bytes; special tokens are told by their case
            parts = (text if b"<|" in text else text.lower()).split()
            try:
                out.append(b"".join(map(self.known.__getitem__, parts)))
            except KeyError:
                self._learn(parts)
                out.append(b"".join(map(self.known.__getitem__, parts)))
        return out

    def _plain(self, word: bytes) -> bytes | None:
        """Ids of a plain word, or nothing if it is not plain."""
        text = word.decode()
        if not text.isalpha() or max(text) >= chr(self.PLAIN_BELOW) or any(c in text for c in self.ODD):
            return None
        letters = text.lower().encode().decode("latin-1").translate(self.LETTERS)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _learn(self, parts: list[bytes]) -> None:
        if len(self.known) > WORD_CACHE:
            self.known, self.older = {}, self.known
        known, rest = self.known, []
        for word in {p for p in parts if p not in known}:
            ids = self.older.get(word)
            if ids is None:
                letters = word.rstrip(self.PUNCTUATION)
                ids = self._plain(letters)
                if ids is None:
                    rest.append(word)
                    continue
                ids += self._mark(word[len(letters) :])
            known[word] = ids
        encoded = self.tokenizer.encode_batch_fast(
            [word.decode() for word in rest], add_special_tokens=False
        )
        for word, found in zip(rest, encoded):
            known[word] = array("I", found.ids).tobytes()

    def _mark(self, mark: bytes) -> bytes:
        """Ids of punctuation that follows a plain word."""
        if mark not in self.known_marks:
            if len(self.known_marks) > MARK_CACHE:
                self.known_marks.clear()
            found = self.tokenizer.encode(mark.decode(), add_special_tokens=False)
            self.known_marks[mark] = array("I", found.ids).tobytes()
        return self.known_marks[mark]


_encoders: dict[str, WordIds] = {}


def _encoder(tokenizer_path: str) -> WordIds:
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = WordIds(tokenizer_path)
    return _encoders[tokenizer_path]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    open_bins: int = 4096,
) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers. A document ends with
    ``end_id``; one with more tokens than fit is cut, any other stays whole. A null or empty text
    is the end id alone, repeated rows are packed once each, a null ``doc_id`` stays null, an
    empty table gives none, and further columns are ignored. Sequence numbers hold the number of
    the task, so a task that runs again gives the same rows.
    """
    tasks_find_package(docs.sparkSession)
    ending = array("I", [end_id]).tobytes()
    cut = capacity * ID_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        bins = BestFit(capacity, open_bins, TaskContext.get().partitionId() << 36)
        for batch in slices(batches, 1, TEXT):
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [b"" if t is None else t for t in part.column(1).cast(pa.binary()).to_pylist()]
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    ids += ending
                    for piece, begin in enumerate(range(0, len(ids), cut)):
                        own = ids[begin : begin + cut]
                        length = len(own) // ID_BYTES
                        sequence, offset = bins.place(length)
                        rows.append(
                            (doc_id, piece, begin // ID_BYTES, length, own, sequence, offset)
                        )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*rows), ARROW)], schema=ARROW
                )
        memory_returned()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
