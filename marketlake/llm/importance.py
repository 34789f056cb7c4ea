"""Importance resampling towards a target distribution of hashed n-grams."""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, stored

#: every byte but 0-9, a-z and those of characters beyond ASCII separates words, once A-Z are lower-cased
_SEPARATED = bytes(b if b >= 0x80 or chr(b).isdecimal() or chr(b).islower() else 0x20 for b in range(256))
_SPACES = re.compile(rb" +")
_SPAN = itemgetter(0)


@lru_cache(maxsize=None)
def scanner(n: int) -> regex.Pattern:
    """Matches n words that single spaces join, from the start of a word to the end of one: with overlaps, every
    run of n consecutive words once."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def collapsed(text: str) -> bytes:
    """The text with A-Z lower-cased and every run of separators as one space, in UTF-8."""
    return _SPACES.sub(b" ", text.encode("utf-8", "surrogatepass").lower().translate(_SEPARATED))


def feature_buckets(text: bytes, ngrams: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words of a collapsed text, and the bucket of each of its n-grams of 1 to ``ngrams`` words."""
    found = [np.fromiter(map(crc32, map(_SPAN, scanner(n).finditer(text, overlapped=True))), dtype=np.uint32)
             for n in range(1, ngrams + 1)]
    return len(found[0]), np.concatenate(found) % np.uint32(buckets)


def hashed_features(docs: DataFrame, ngrams: int, buckets: int, id_col: str, text_col: str, name: str) -> DataFrame:
    """(rid, doc_id, n_words, n_features, features), stored: features holds the buckets as little-endian unsigned
    integers of 16 bits, or 32 where there are more buckets than that."""
    dtype = _dtype(buckets)
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("features", pa.binary())])

    def run(b):
        n_words, n_features, found = [], [], []
        for text in b.column(2).to_pylist():
            words, own = feature_buckets(collapsed(text or ""), ngrams, buckets)
            n_words.append(words)
            n_features.append(len(own))
            found.append(own.astype(dtype).tobytes())
        return {"rid": b.column(0), "doc_id": b.column(1), "n_words": n_words, "n_features": n_features, "features": found}

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(batches(run, schema, rows=500), "rid long, doc_id long, n_words long, n_features long, features binary"), name)


def _dtype(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(hashed: DataFrame, buckets: int) -> np.ndarray:
    """How many features all documents hold in each bucket.  Every task sums its rows; what Spark adds up and the
    driver takes is one row per bucket, however many documents there are."""
    dtype = _dtype(buckets)

    def run(it):
        total = np.zeros(buckets, np.int64)
        for batch in it:
            for own in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(own, dtype), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = hashed.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of the target's over the corpus's smoothed share)."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """A document's Gumbel draw in thousandths, from the seed and its id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_resample(docs: DataFrame, target: DataFrame, ngrams: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10,
                        least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    Separators collapse to single spaces, and one overlapped regular expression with boundary lookarounds per n
    emits the spans of all n-grams; a span's bucket is its CRC-32 modulo ``buckets``.  A bucket's gain compares
    its share of the target's features with that of all documents' features; weight is the sum of a document's
    gains, score adds a Gumbel draw.  Of the N documents of at least ``least_words`` words, the
    floor(percent * N / 100) highest scores are drawn without replacement and numbered from 1, ties to the
    smaller doc_id, null ids last, and among rows of one id the fewer features, then the smaller weight; rows
    that are equal in all of these are interchangeable.  All other rows have a null rank.

    Texts are scanned once; their buckets are stored and read for counts and weights.  The ranking deals rows of
    six numbers by range and adds each range's start, so no task holds all scores.  Null text counts as empty (no
    features, weight 0); an empty target leaves every bucket its smoothed share; no documents give no rows.
    """
    hashed = hashed_features(docs, ngrams, buckets, id_col, text_col, "hashed-documents")
    wanted = hashed_features(target.withColumn("__no_id", F.lit(None).cast("long")), ngrams, buckets, "__no_id", target_text_col, "hashed-target")
    gain = gains(bucket_counts(hashed, buckets), bucket_counts(wanted, buckets))
    dtype = _dtype(buckets)
    schema = pa.schema([(n, pa.int64()) for n in ("rid", "doc_id", "n_words", "n_features", "weight", "score")])

    def run(b):
        weight = [int(gain[np.frombuffer(own, dtype)].sum()) for own in b.column(4).to_pylist()]
        return {**{n: b.column(i) for i, n in enumerate(("rid", "doc_id", "n_words", "n_features"))}, "weight": weight,
                "score": [w + noise(seed, d) for w, d in zip(weight, b.column(1).to_pylist())]}

    scored = hashed.mapInArrow(batches(run, schema), ", ".join(f"{f.name} long" for f in schema))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("rid")]
    # rows too short to be drawn come after all others, in ranges of their own
    short = F.col("n_words") < least_words
    ranges = stored(scored.withColumn("short", short).repartitionByRange("short", *order).withColumn("rng", F.spark_partition_id()), "score-ranges")
    sizes = ranges.groupBy("rng").agg(F.count(F.when(~F.col("short"), 1)).alias("n"))
    # one row per range
    sizes = sizes.select("rng", (F.sum("n").over(Window.orderBy("rng")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("n_all"))
    nth = F.col("before") + F.row_number().over(Window.partitionBy("rng").orderBy("short", *order))
    drawn = (~F.col("short")) & (F.col("nth") <= F.floor(F.col("n_all") * percent / 100))
    return (ranges.join(sizes, "rng").withColumn("nth", nth.cast("long"))
            .select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("nth")).alias("rank")))
