"""SimHash near-duplicates, verified behind pivot distance tables."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, stored, union_find
from .graph import components

NO_ID = (1 << 63) - 1


def simhash(text: str, words: int = 4) -> int:
    """64-bit SimHash of a whole text: a bit is 1 if over half of the shingles' XXH64 have it; no words: 0."""
    own = text.encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    flat = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    m = max(1, len(own) - words + 1)
    digest, one, n = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), m
    for at in range(0, m, 1 << 15):  # a very long text costs no more memory than this
        to = min(m, at + (1 << 15))
        if len(own) < words:
            h = [digest(flat, 42)]
        else:
            h = [digest(flat[s:e], 42) for s, e in zip(starts[at:to].tolist(), ends[at + words - 1:to + words - 1].tolist())]
        one += np.unpackbits(np.array(h, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * one > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long; null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(b):
        fp = np.array([simhash(t or "", words) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        return {"doc_id": b.column(0), "fp": fp}

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(batches(run, schema), "doc_id long, fp long"))


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of every fingerprint (rows) to every reference fingerprint (columns)."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)


def block_links(fps: np.ndarray, left: np.ndarray, right: np.ndarray, table: np.ndarray, max_bits: int):
    """The pairs (left[k], right[k]) within ``max_bits``: by the triangle inequality a pair whose distances
    to some reference differ by more cannot be, the rest is verified bit by bit."""
    near = np.abs(table[left] - table[right]).max(axis=1, initial=0) <= max_bits
    left, right = left[near], right[near]
    true = np.bitwise_count(fps[left] ^ fps[right]) <= max_bits
    return left[true], right[true]


def near_links(distinct: DataFrame, max_bits: int = 4, blocks: int = 6, pivots: int = 16, cell_rows: int = 4096) -> DataFrame:
    """Links (a, b) among the distinct fingerprints of column fp that join exactly what all pairs within
    ``max_bits`` would join.

    Candidates: the 64 bits are cut into ``blocks`` blocks; two fingerprints that differ in at most
    ``max_bits`` of them agree on at least blocks - max_bits whole blocks, so each choice of that many blocks
    makes a key, and every true pair meets under some key.  A key with more than ``cell_rows`` fingerprints is
    cut into parts, and every two parts meet in a task of their own: no task holds a hot key, and none is
    capped.  In a task the distances to ``pivots`` reference fingerprints are computed once per fingerprint;
    pairs whose coordinates differ by more than ``max_bits`` anywhere are discarded and the survivors
    verified.  Each task returns the links of a spanning forest, at most one per fingerprint.
    """
    if not 0 <= max_bits < blocks:
        raise ValueError("max_bits must be below the number of blocks")
    cut = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - max_bits):
        mask = sum(((1 << (cut[i + 1] - cut[i])) - 1) << cut[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    refs = np.random.default_rng(42).integers(0, 1 << 64, pivots, dtype=np.uint64)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    met = (keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
           .withColumn("parts", F.ceil(F.col("n") / cell_rows).cast("int")).drop("n"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int")
    cells = (keyed.join(met, ["t", "key"]).withColumn("p", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("fp", "t", "key", F.least("p", "other").alias("lo"), F.greatest("p", "other").alias("hi")))
    cells = cells.repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")

    def forest(pdf):
        fps = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        table, group = pivot_table(fps, refs), pdf["g"].to_numpy()

        def pairs():
            at, step = np.arange(len(fps)), 0
            while True:
                step += 1
                at = at[at + step < len(fps)]
                at = at[group[at] == group[at + step]]
                if not len(at):
                    return
                for s in range(0, len(at), 1 << 16):
                    yield block_links(fps, at[s:s + (1 << 16)], at[s:s + (1 << 16)] + step, table, max_bits)

        root = union_find(len(fps), pairs())
        child = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[child].view(np.int64), "b": fps[root[child]].view(np.int64)})

    def run(it):
        # rows arrive sorted by cell: whole cells are compared, the last one waits for the next batch
        rest, names = None, ["t", "key", "lo", "hi"]
        for pdf in it:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            new = (pdf[names] != pdf[names].shift()).any(axis=1).to_numpy()
            pdf["g"] = np.cumsum(new)
            last = int(np.flatnonzero(new)[-1]) if len(pdf) else 0
            rest = pdf.iloc[last:].drop(columns="g")
            if last:
                yield forest(pdf.iloc[:last].reset_index(drop=True))
        if rest is not None and len(rest):
            yield forest(rest.assign(g=0).reset_index(drop=True))

    return cells.mapInPandas(run, "a long, b long")


def simhash_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                            max_bits: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles of ``words`` words count
    with repeats; a shorter text is one shingle, a text without words (null included) has fingerprint zero and
    links like any other.  Fingerprints within ``max_bits`` link; component_id is the smallest doc_id
    reachable.  Documents of one fingerprint are one node, so copies are never paired.  A null id takes part
    but never names a component that has another id; repeated rows each keep their row.
    """
    fps = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(nodes.select("fp"), max_bits), "simhash-components")
    # only linked fingerprints need another's name; the names are a row per component, written so that their size is known
    linked = stored(nodes.join(roots, nodes.fp == roots.node).select("fp", "least", "root"), "simhash-linked")
    named = stored(linked.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    named = linked.join(named, "root").select("fp", "component_id")
    named = nodes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return (fps.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
