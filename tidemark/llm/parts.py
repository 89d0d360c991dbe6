"""Texts to token ids by their distinct parts, a block of texts at a time.

A space after something else than white space always begins a new word of the
tokenizers' pattern, so a text may be cut before each such space and its parts
treated alone.  The cuts of a block are found in its bytes at once, equal
parts are found by dictionary encoding, only parts that are new to the worker
are tokenised, and the ids are gathered by index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Parts, and ids of parts, that a worker remembers from block to block.
CACHED, CACHED_IDS = 600_000, 8_000_000
#: Bytes of text in a block, about (one text at least).
BLOCK_BYTES = 8_000_000


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a part may begin: spaces that follow a character of which the
    bytes alone show that it's no white space."""
    at = np.flatnonzero(data == 0x20)
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    ascii_sign = (one > 0x20) & (one < 0x7F)
    # White space beyond ASCII begins with C2 or with E1 to E3.
    other_sign = (one >= 0x80) & (at >= 3) & (two != 0xC2) & ((three < 0xE1) | (three > 0xE3))
    return at[(at > 0) & (ascii_sign | other_sign)]


class Parts:
    """Ids of texts; ``learn`` gives the ids (int32) of some parts: all of them
    in one array, and where each part's begin and how many they are."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.learn = learn
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)

    def _rows(self, parts: list[bytes]) -> np.ndarray:
        """The row of each part in the store; new ones are learned."""
        if len(self.index) > CACHED or len(self.flat) > CACHED_IDS:
            self._clear()
        new = [p for p in parts if p not in self.index]
        if new:
            ids, first, sizes = self.learn(new)
            first = first + len(self.flat)
            self.index.update(zip(new, range(len(self.start), len(self.start) + len(new))))
            self.flat = np.concatenate([self.flat, ids])
            self.start = np.concatenate([self.start, first])
            self.size = np.concatenate([self.size, sizes])
        return np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids end to end, where each text's begin and the last one's
        end)."""
        if not len(texts):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        begins = np.zeros(len(data) + 1, bool)
        begins[cuts(data)] = True
        begins[offsets] = True
        bounds = np.flatnonzero(begins)
        parts = pa.Array.from_buffers(
            pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
        ).dictionary_encode()
        row = self._rows(parts.dictionary.to_pylist())
        if not len(row):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        row = row[parts.indices.to_numpy()]
        size = self.size[row]
        end = np.cumsum(size)
        place = np.arange(end[-1]) + np.repeat(self.start[row] - (end - size), size)
        return self.flat[place], np.concatenate([[0], end])[np.searchsorted(bounds, offsets)]


def joined(parts: list[bytes], most: int) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, np.ndarray]]:
    """Parts that begin with a space, laid end to end in texts of about
    ``most`` bytes: (which parts, the text, where each part begins and the
    last one's end, which of these places are sure cuts)."""
    spaced = np.flatnonzero([p[:1] == b" " for p in parts])
    size = np.array([len(parts[i]) for i in spaced], np.int64)
    number = (np.cumsum(size) - size) // most
    for own in np.split(np.arange(len(spaced)), np.flatnonzero(np.diff(number)) + 1):
        if len(own):
            text = b"".join([parts[i] for i in spaced[own]])
            bounds = np.concatenate([[0], np.cumsum(size[own])])
            sure = np.zeros(len(text) + 1, bool)
            sure[cuts(np.frombuffer(text, np.uint8))] = True
            sure[[0, len(text)]] = True
            yield spaced[own], text, bounds, sure[bounds]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches joined up to about ``most`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
