"""Parts: a stored table in numbered pieces of bounded text, and side tables that meet each piece where it lies.

A table of texts is stored once, every row with the number of its part.  What other tasks find out about a part's
rows is dealt by part to one file each; a task that reads rows of the part loads that file.  So texts are scanned
as often as needed and never shuffled, and a key that a third of all rows hold costs one row per part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marketlake.session import shared_dir

SEQ_BITS = 10   # parts a task may begin by text volume; then its last one goes on
TASK_BITS = 20  # a million scan tasks: 100 TB in splits of 128 MB


def part_numbers(limit: int) -> Callable[[int], int]:
    """A function that is told each row's size in turn and gives the row's part: a new one after ``limit``."""
    task, seq, held = TaskContext.get().partitionId(), 0, 0
    if task >= 1 << TASK_BITS:
        raise ValueError(f"a scan of over {1 << TASK_BITS} tasks; read larger splits")

    def number(size: int) -> int:
        nonlocal seq, held
        if held and held + size > limit and seq + 1 < 1 << SEQ_BITS:
            seq, held = seq + 1, 0
        held += size
        return task << SEQ_BITS | seq

    return number


def dealt(df: DataFrame, name: str) -> str:
    """Writes ``df`` to the shared folder, the rows of each value of its column ``part`` to a file of their own,
    and returns the folder."""
    path = shared_dir(df.sparkSession, name)
    df.repartition("part").write.partitionBy("part").parquet(path)
    return path


def side(folder: str, part: int, columns: list[str]) -> list[np.ndarray]:
    """The columns of a part's rows in a dealt table, in order of the first; empty where the part has none."""
    store, path = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(f"{path}/part={part}", allow_not_found=True))
    tables = [pq.ParquetFile(store.open_input_file(f.path)).read(columns) for f in found if f.path.endswith(".parquet")]
    if not tables:
        return [np.zeros(0, np.int64) for _ in columns]
    whole = pa.concat_tables(tables)
    arrays = [whole[c].to_numpy() for c in columns]
    order = np.argsort(arrays[0], kind="stable")
    return [a[order] for a in arrays]


def blocks(it: Iterator[pa.RecordBatch], part: int, text: int, limit: int) -> Iterator[pa.Table]:
    """Rows of a batch stream as tables of one part each and of about ``limit`` bytes in column ``text`` (by
    number, as ``part``); a longer row is a block of its own."""
    held, size, own = [], 0, None
    for batch in it:
        at = 0
        numbers = batch.column(part).to_numpy()
        lens = np.diff(_offsets(batch.column(text)))
        for i, (p, n) in enumerate(zip(numbers.tolist(), lens.tolist())):
            if own is not None and (p != own or size + n > limit) and (held or i > at):
                if i > at:
                    held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held)
                held, size, at = [], 0, i
            own, size = p, size + n
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The position of each wanted value in the sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)
