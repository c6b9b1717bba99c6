"""Bounded-space online packing of documents into fixed-length windows.

Each partition keeps at most `open_windows` windows open.  A document's tokens
first fill whole windows by themselves; what remains goes, uncut, into the open
window that it fits best.  When none has room and no more may be opened, the
fullest one is topped up with the head of the piece and emitted.  At the end of
a partition its open windows are merged into full ones and at most one partial
window, and those of FAN_IN neighbouring partitions are merged in turn, so that
each such group leaves one window that is not full.

Memory: open_windows windows, one document and CACHED_BYTES of known words.  A lost task is run again with
the same rows in the same order as long as the input is a table; give a written
table, not the output of a shuffle.

Defined cases: a null text is an empty one and still has its end token; repeated
rows are packed each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize

CAPACITY = 4096
OPEN_WINDOWS = 64
FAN_IN = 64
WIDTH = 4  # bytes of an id
#: Words of up to so many characters are kept with their ids, up to so many bytes in all.
CACHED_CHARS = 64
CACHED_BYTES = 1 << 28
_ALONE = re.compile("<\\||[\x1c-\x1f]")

Piece = tuple  # (doc_id, start, ids, doc_tokens)


class Packer:
    """Best-fit over a bounded number of open windows; emit(pieces) takes each closed one."""

    def __init__(self, emit: Callable[[list[Piece]], None], capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS):
        self.emit, self.capacity, self.most = emit, capacity, open_windows
        self.room: list[tuple[int, int]] = []  # (free tokens, window), ascending
        self.windows: dict[int, list[Piece]] = {}
        self.made = 0

    def add(self, doc_id, start: int, ids: bytes, total: int) -> None:
        size = self.capacity * WIDTH
        while len(ids) >= size:
            self.emit([(doc_id, start, ids[:size], total)])
            start, ids = start + self.capacity, ids[size:]
        while ids:
            length = len(ids) // WIDTH
            at = bisect.bisect_left(self.room, (length, -1))
            if at < len(self.room):
                free, window = self.room.pop(at)
                self._put(free - length, window, (doc_id, start, ids, total))
                return
            if len(self.room) < self.most:
                self.made += 1
                self.windows[self.made] = []
                self._put(self.capacity - length, self.made, (doc_id, start, ids, total))
                return
            free, window = self.room.pop(0)  # the fullest
            self._put(0, window, (doc_id, start, ids[: free * WIDTH], total))
            start, ids = start + free, ids[free * WIDTH :]

    def _put(self, free: int, window: int, piece: Piece) -> None:
        self.windows[window].append(piece)
        if free:
            bisect.insort(self.room, (free, window))
        else:
            self.emit(self.windows.pop(window))

    def finish(self) -> list[Piece]:
        """Close all windows; the pieces of the one that stays partial are returned."""
        full_first = [self.windows[w] for _, w in self.room]
        self.room, self.windows = [], {}
        self.most = 1
        for window in full_first:
            for piece in window:
                self.add(*piece)
        return [p for w in self.windows.values() for p in w]


class _Words(dict):
    """Ids of words, worked out when first asked for; long words aren't kept."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.held = encode, 0

    def __missing__(self, word: str) -> bytes:
        found = self.encode(word)
        if len(word) <= CACHED_CHARS:
            self[word] = found
            self.held += 180 + 2 * len(word) + len(found)  # two objects and a place in the table
        return found

    def trim(self) -> None:
        if self.held > CACHED_BYTES:
            self.clear()
            self.held = 0


class WordEncoder:
    """Ids of whole texts by way of a bounded cache of words.

    The vocabulary's normalizer and splitter never look across white space, so a
    text's ids are those of its words in order.  A text with a special token's
    opening or a control character that only Python takes for white space is
    encoded in one piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Words(self._ids)

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            if not text:
                yield b""
            elif _ALONE.search(text):
                yield self._ids(text)
            else:
                self.known.trim()
                yield b"".join(map(self.known.__getitem__, text.split()))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, part long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]
_TYPES = [pa.int64()] * 7 + [pa.binary(), pa.int64()]


class _Out:
    """Rows of closed windows."""

    def __init__(self, first: int, keep_ids: bool):
        self.sequence, self.keep, self.rows = first, keep_ids, []

    def window(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // WIDTH, zlib.crc32(ids), total, self.sequence, offset, ids if self.keep else None, None))
            offset += len(ids) // WIDTH
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _pack_partition(path: str, end_id: int, capacity: int, open_windows: int, keep_ids: bool):
    end = end_id.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out = _Out(part << 32, keep_ids)
        packer = Packer(out.window, capacity, open_windows)
        enc = encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                for doc_id, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist()), strict=True):
                    ids += end
                    packer.add(doc_id, 0, ids, len(ids) // WIDTH)
                yield out.batch()
        left = packer.finish()
        out.rows += [(d, s, len(i) // WIDTH, None, t, None, None, i, part) for d, s, i, t in left]
        yield out.batch()

    return run


def _merge(capacity: int, keep_ids: bool):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = _Out((1 << 62) + (int(key[0]) << 32), keep_ids)
        packer = Packer(out.window, capacity, 1)
        for row in pdf.sort_values(["part", "doc_id", "start"]).itertuples():
            packer.add(None if pd.isna(row.doc_id) else int(row.doc_id), int(row.start), bytes(row.ids), int(row.doc_tokens))
        last = packer.finish()
        if last:
            out.window(last)
        return out.batch().to_pandas()

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Pieces of a sequence_id in the order of offset are one window of at most
    capacity tokens.  ids holds them as unsigned 32-bit little-endian if keep_ids.
    """
    docs = docs.select(F.col(doc_id).cast("long"), F.col(text))
    packed = materialize(docs.mapInArrow(_pack_partition(tokenizer_path, end_id, capacity, open_windows, keep_ids), SCHEMA), "packed")
    left = packed.where(F.col("sequence_id").isNull())
    merged = left.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(_merge(capacity, keep_ids), SCHEMA)
    out = packed.where(F.col("sequence_id").isNotNull()).unionByName(merged).drop("part")
    return out if keep_ids else out.drop("ids")
