"""Keys that texts share or look up, as packed numbers that travel in chunks instead of a row each.

A chunk is about a million keys of some texts, sorted and cut into ranges. The owner of a range gets its
part of every chunk and answers with a number for each key, in the order in which the keys came.
"""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tellmark.session import stored  # noqa: F401  for the tables of packed keys and of what came of them

# Ship the in-task helpers by value, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 20  # keys of a chunk, on average
RANGE_BITS = 10  # ranges of keys, of which an owner takes one or several
#: A row for each range that a chunk has keys in; a row with the rest of what is known has `about`.
ROWS = "chunk bigint, kind int, range int, keys binary, places binary, counts binary, about binary"
NAMES = [c.split()[0] for c in ROWS.split(", ")]
TYPES = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs, byte by byte, so that sorted or small ones compress."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return bytes([width]) + np.ascontiguousarray(raw[:, :width].T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel()


def joined(packed: list[bytes]) -> np.ndarray:
    return np.concatenate([unpack(p) for p in packed]) if packed else np.zeros(0, np.uint64)


def table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(NAMES), TYPES)], names=NAMES)


def counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, how often each occurs or the sum of its times, the order that sorts all of them)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    if times is None or not len(starts):
        return ranked[starts], np.diff(np.append(starts, len(keys))).astype(np.uint64), order
    return ranked[starts], np.add.reduceat(times[order], starts), order


def ranges(chunk: int | None, kind: int, keys: np.ndarray, places: np.ndarray | None, counts: np.ndarray | None) -> list[tuple]:
    """A row for each range that some of the sorted keys are in."""
    ends = np.searchsorted(keys >> np.uint64(64 - RANGE_BITS), np.arange((1 << RANGE_BITS) + 1, dtype=np.uint64)).tolist()
    part = lambda x, r: None if x is None else pack(x[ends[r] : ends[r + 1]])
    return [(chunk, kind, r, part(keys, r), part(places, r), part(counts, r), None) for r in range(1 << RANGE_BITS) if ends[r] < ends[r + 1]]


def home(chunk: int) -> int:
    """The range whose owner passes on what is known of a chunk."""
    return int(mix(np.array([chunk], np.uint64))[0] >> np.uint64(64 - RANGE_BITS))


def chunks(batches: Iterator[pa.RecordBatch], texts: Callable, rows: Callable) -> Iterator[pa.RecordBatch]:
    """The rows of all chunks of a task. `texts` gives an item for each row of a batch, with its number
    of keys; `rows` those of a chunk, from its number and items."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for item, n in texts(batch):
            held.append(item)
            size += n
            if size >= CHUNK or len(held) == 1 << 16:
                yield table(rows(number, held))
                number, held, size = number + 1, [], 0
    if held:
        yield table(rows(number, held))


def owner(rows: DataFrame) -> Column:
    """The ranges that are worked on together: more groups than tasks, as many as there are ranges at most."""
    groups = max(64, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return F.shiftright("range", max(0, RANGE_BITS - (groups - 1).bit_length()))


def ids_of(column: pa.Array, **more: np.ndarray) -> bytes:
    """Ids of any type, and numbers of the same rows, as bytes."""
    whole = pa.table({"id": column, **more})
    with pa.ipc.new_stream(sink := pa.BufferOutputStream(), whole.schema) as out:
        out.write_table(whole)
    return sink.getvalue().to_pybytes()


def of_ids(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all().combine_chunks()
