"""Words of whole Arrow text columns, cut and numbered on their bytes without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Classes of a byte: part of a word, between words, between words that are no neighbours.
WORD, GAP, BREAK = 0, 1, 2

#: Bytes of text that are cut together.
GROUP_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


@dataclass
class Words:
    """Words in order: ``code`` numbers them in ``spelling``, ``row`` is their text's, ``run`` changes where neighbours end."""

    code: np.ndarray
    row: np.ndarray
    run: np.ndarray
    spelling: pa.Array


def byte_classes(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    table = np.full(256, WORD, dtype=np.uint8)
    table[list(gaps)] = GAP
    table[list(breaks)] = BREAK
    return table


def cut(texts: pa.Array, classes: np.ndarray, lower: bool = True, parts: bool = False) -> Words:
    """Words of all ``texts`` (no nulls), A-Z in lower case unless told otherwise; bytes above 0x7F must have one class, so no character is cut.

    With ``parts``, words are also cut between a Latin letter and an ASCII
    character that is no letter and no apostrophe, whichever comes first.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kind = classes[data]
    inside = kind == WORD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if parts:
        letter = _LETTER[data]
        latin = letter.copy()
        latin[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        other = inside & (data < 0x80) & ~letter & (data != 0x27)
        begins[1:] |= (latin[:-1] & other[1:]) | (other[:-1] & letter[1:])
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    row = np.searchsorted(offsets, at, side="right") - 1
    # what is counted per byte is summed per word at once; running sums would hold eight bytes for each
    parted = row[1:] != row[:-1]
    if len(at) and (classes == BREAK).any():
        parted |= np.add.reduceat(kind == BREAK, at, dtype=np.int64)[:-1] > 0
    run = np.cumsum(np.r_[False, parted]) if len(at) else np.zeros(0, np.int64)
    spelled = _LOWER[data[inside]] if lower else data[inside]
    ends = np.r_[0, np.cumsum(np.add.reduceat(inside, at, dtype=np.int64))] if len(at) else np.zeros(1, np.int64)
    del kind, inside, begins, data
    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(spelled.tobytes())])
    coded = words.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row, run, coded.dictionary)


def grouped(batches: Iterator[pa.RecordBatch], group_bytes: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``group_bytes`` (``GROUP_BYTES`` unless given)."""
    most = group_bytes or GROUP_BYTES
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        whole = max(1, -(-batch.nbytes // most))
        step = max(1, -(-batch.num_rows // whole))
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            size += batch.nbytes // whole
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
