"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketlake.session import shared_dir

#: [^\x20\x09-\x0D]+ is what bytes.split() calls a word: its white space is
#: exactly these six bytes, and none of them occurs inside a UTF-8 sequence.
WORD = r"[^\x20\x09-\x0D]+"


_ready: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Sends this package's sources to the executors once per application, for clusters that do not have it
    installed: tasks unpickle functions by their module's name."""
    sc = spark.sparkContext
    if sc.applicationId not in _ready:
        top = Path(__file__).resolve().parents[1]
        made = Path(tempfile.mkdtemp(prefix="marketlake-")) / "marketlake.zip"
        with zipfile.ZipFile(made, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        sc.addPyFile(str(made))
        _ready.add(sc.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: later readers
    neither recompute it nor depend on any executor's local files."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(fn: Callable[[pa.RecordBatch], dict], schema: pa.Schema,
            rows: int = 2000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that hands ``fn`` slices of at most ``rows`` rows
    and makes a batch of the columns it returns."""
    def run(it):
        for batch in it:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
    return run


def texts(column: pa.Array) -> list[str]:
    """A text column as Python strings; null counts as the empty text."""
    return [t or "" for t in column.to_pylist()]


def union_find(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index of each of ``n`` items' component, from arrays of links.

    Whole arrays at a time: the larger root of each link is hung below the
    smaller, paths are shortened, until every link joins equal roots.
    """
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


_LOWER = re.compile(r"[A-Z]+")


def lower_ascii(text: str) -> str:
    """A-Z lower-cased, everything else as it is."""
    return _LOWER.sub(lambda m: m[0].lower(), text)
