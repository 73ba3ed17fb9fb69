"""Arrow columns of byte strings and lists as whole NumPy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: bytes of a batch's rows that are worked on at a time
SLICE_BYTES = 4_000_000


def sliced(batches):
    """The batches' rows in slices of about SLICE_BYTES at most, none of them empty."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, bytes one after the other) of a string or binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return np.diff(bounds), np.frombuffer(data or b"", dtype=np.uint8)[bounds[0]:bounds[-1]]


def bounds_of(lengths: np.ndarray) -> np.ndarray:
    """0 and where each of the runs of these lengths ends."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def owners(lengths: np.ndarray) -> np.ndarray:
    """The number of its run for each unit of runs of these lengths."""
    return np.repeat(np.arange(len(lengths)), lengths)


def every_other(places: np.ndarray) -> np.ndarray:
    """Of each run of places one beside the next, the first, third, ...: pairs that don't overlap."""
    first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    run = np.repeat(first, np.diff(np.append(first, len(places))))
    return places[(np.arange(len(places)) - run) % 2 == 0]


def merged(symbols: np.ndarray, owner: np.ndarray, places: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols and their owners after the symbols at the places and those behind them became ``made``."""
    symbols, keep = symbols.copy(), np.ones(len(symbols), dtype=bool)
    symbols[places] = made
    keep[places + 1] = False
    return symbols[keep], owner[keep]


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) << 32) | right


def found_in(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flags of the wanted values that are among the sorted keys (one at least), where they are)."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at
