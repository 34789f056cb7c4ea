"""Token ids in flat binary files with 64-bit document offsets."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.session import shared_dir

from .common import stored, texts
from .vocab import WordIds, load, tokenizer_path

PART = "name string, first_doc long, first_hash long, first_row long, n_docs long, n_tokens long"


def _open(folder: str):
    """The file system of a folder (a URI or a path) and the folder's path in it."""
    return fs.FileSystem.from_uri(folder)


def _array(folder: str, name: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped into memory where the folder is mounted, else read from its store."""
    store, path = _open(folder)
    if isinstance(store, fs.LocalFileSystem):
        size = store.get_file_info(f"{path}/{name}").size
        return np.memmap(f"{path}/{name}", dtype=dtype, mode="r") if size else np.zeros(0, dtype)
    with store.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read_buffer(), dtype=dtype)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all documents' ids to ``folder`` in ascending doc_id order and returns the manifest, one row per
    part in order: name, the first row's key (first_doc, first_hash, first_row), n_docs, n_tokens, start (ids in all
    parts before it), part, dtype.

    Each part has <name>.ids (flat unsigned little-endian integers, 16 bits where the vocabulary fits, else
    32), <name>.docs (signed 64-bit doc_ids; null as the smallest value) and <name>.off (unsigned 64-bit
    offsets of its documents in the whole sequence, one more than documents).  The documents are range
    partitioned by doc_id, which puts one text per row through one shuffle; a task streams its part to files
    whose names no other attempt shares, and only the names of tasks that succeeded reach the manifest, which
    is written to the shared folder at once: a lost executor or a second attempt leaves files that nothing
    names.  The parts' bases are the prefix sums of their counts; a second small job writes the offsets.

    Null text is the empty text (its ids are ``end_id`` alone); null ids come first; rows of one id come in order of
    a hash of their text, so starts agree between runs, and equal rows are dealt by their place in the table: an id
    that a third of the rows hold is split over parts like any others.  An empty table gives an empty manifest.
    """
    where = tokenizer if "/" in tokenizer else tokenizer_path(tokenizer)
    dtype = "<u2" if max(load(where).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    held: dict = {}
    null_id = -(1 << 63)

    def write(it):
        store, path = _open(folder)
        words = held.get("words") or held.setdefault("words", WordIds(tokenizer if "/" in tokenizer else tokenizer_path(tokenizer), dtype))
        name, files = f"part-{uuid.uuid4().hex}", None
        end, first, n_docs, n_tokens = np.array([end_id], dtype=dtype).tobytes(), (None, 0, 0), 0, 0
        for batch in it:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                if files is None:
                    store.create_dir(path, recursive=True)
                    files = [store.open_output_stream(f"{path}/{name}.{x}") for x in ("ids", "docs", "len")]
                    first = tuple(b.column(k)[0].as_py() for k in (0, 2, 3))
                ids = [e + end for e in words.encode(texts(b.column(1)))]
                own = np.array([len(e) for e in ids], dtype=np.uint64) // np.dtype(dtype).itemsize
                files[0].write(b"".join(ids))
                files[1].write(np.array([null_id if d is None else d for d in b.column(0).to_pylist()], dtype="<i8").tobytes())
                files[2].write(own.astype("<u8").tobytes())
                n_docs, n_tokens = n_docs + len(ids), n_tokens + int(own.sum())
        if files:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pydict({"name": [name], **{c: pa.array([v], pa.int64()) for c, v in zip(("first_doc", "first_hash", "first_row"), first)},
                                              "n_docs": [n_docs], "n_tokens": [n_tokens]})

    key = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")]
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
                           F.monotonically_increasing_id().alias("row"))
               .repartitionByRange(*key).sortWithinPartitions(*key))
    parts = stored(ordered.mapInArrow(write, PART), "token-parts")
    # one row per written part: as many as there are partitions, whatever the documents
    order = Window.orderBy(F.col("first_doc").asc_nulls_first(), "first_hash", "first_row")
    parts = (parts.withColumn("start", F.sum("n_tokens").over(order) - F.col("n_tokens")).withColumn("part", F.row_number().over(order))
             .withColumn("dtype", F.lit(dtype)))

    def offsets(it):
        store, path = _open(folder)
        for b in it:
            for name, start in zip(b.column("name").to_pylist(), b.column("start").to_pylist()):
                sums = np.concatenate([[0], np.cumsum(_array(folder, f"{name}.len", "<u8"), dtype=np.uint64)]).astype(np.uint64)
                with store.open_output_stream(f"{path}/{name}.off") as f:
                    f.write((sums + np.uint64(start)).astype("<u8").tobytes())
            yield b

    spread = parts.repartition(max(1, parts.sparkSession.sparkContext.defaultParallelism), "name")
    return stored(spread.mapInArrow(offsets, spread.schema), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str, docs_at_once: int = 4096) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers).  Parts are mapped into memory, one document's ids at a time."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    names = manifest.columns

    def read(it):
        for b in it:
            for row in b.to_pylist():
                ids, docs, off = (_array(folder, f"{row['name']}.{x}", d) for x, d in (("ids", row["dtype"]), ("docs", "<i8"), ("off", "<u8")))
                base = int(row["start"])
                for at in range(0, len(docs), docs_at_once):
                    own = docs[at:at + docs_at_once]
                    cut = off[at:at + len(own) + 1].astype(np.int64)
                    crc = [zlib.crc32(ids[a - base:z - base].astype("<u4").tobytes()) for a, z in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == -(1 << 63)), pa.array(cut[:-1]), pa.array(np.diff(cut)), pa.array(crc, pa.int64())], schema=schema)

    spread = manifest.select(*names).repartition(max(1, 4 * manifest.sparkSession.sparkContext.defaultParallelism), "name")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the files and reads them back; ``folder`` defaults to a fresh one in the shared folder."""
    folder = folder or shared_dir(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, **options), folder)


def open_parts(spark: SparkSession, manifest: DataFrame) -> list[dict]:
    """The manifest's rows in order, for a loader that maps the files itself."""
    return [r.asDict() for r in manifest.orderBy("part").collect()]
