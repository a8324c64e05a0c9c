"""Helpers inside Arrow tasks: byte-bounded slices, plain byte texts, words, per-worker caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

# A byte table for words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: letters and digits
# of ASCII and every byte of a longer UTF-8 character stay, A-Z become a-z, the rest are blanks.
LETTER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                     for b in range(256))
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`: what bytes.split() splits at is exactly that set."""
    return text.split()


def letter_words(text: bytes) -> list[bytes]:
    """Lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`."""
    return text.translate(LETTER_TABLE).split()


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts as UTF-8; null becomes empty."""
    return [t or b"" for t in batch.column(column).cast(pa.large_binary()).to_pylist()]


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, so that tasks after the first find it filled."""
    module = sys.modules.setdefault("_duskwatch_worker_cache", types.ModuleType("_duskwatch_worker_cache"))
    return vars(module)


def segment_sums(flags: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over consecutive pieces of the given lengths (empty pieces give 0)."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]
