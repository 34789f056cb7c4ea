"""Substring dedup: documents streamed through suffix automata of reference shards.

A window is ``words`` consecutive words of one document; every word of a window whose words also start earlier
goes.  The references are the passages that later documents repeat, each where it starts first.  A shard of them is
an automaton of bounded size, sent to all groups of passages that may repeat something in it; streaming a passage
gives its matching statistics, and spans of at least ``words`` matched words are removed.

What has to be streamed where is found by hashes alone, so nothing is compared with a shard it shares nothing with:
sampled word runs first (a sixth of the positions), then windows around those that repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .parts import blocks, dealt, lookup, part_numbers, side

ADDRESS_BITS = 33          # a word's address is its part (30 bits) and its place among the part's words
LAST = (1 << 63) - 1       # a null id comes after all others
ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, mixed so that its order tells nothing about the words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for i in range(n):
        out = out * ODD + hashes[i:i + len(out)]
    out ^= out >> np.uint64(32)
    out *= ODD
    return out ^ (out >> np.uint64(29))


class Block:
    """Some documents of a part, in order of id and address, as one sequence of words."""

    def __init__(self, block: pa.Table, words: int, run: int):
        self.part = block.column("part")[0].as_py()
        key, at = block.column("key").to_numpy(), block.column("at").to_numpy()
        own = [t.encode("utf-8", "surrogatepass").split() for t in block.column("text").to_pylist()]
        order = np.lexsort((at, key))
        own = [own[i] for i in order]
        lengths = np.array([len(w) for w in own], dtype=np.int64)
        self.words = [w for d in own for w in d]
        n, first = len(self.words), np.cumsum(lengths) - lengths
        self.address = np.repeat(at[order] - first, lengths) + np.arange(n)
        self.key = np.repeat(key[order], lengths)
        self.hashes = word_hashes(self.words)
        self.size, self.run = words, run
        # starts of windows that lie in one document
        self.starts = np.flatnonzero(np.repeat(first + lengths, lengths) - np.arange(n) >= words)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The least run hash in each window, and the hash of every position that is some window's least.  Equal
        windows have equal anchors, so a window that repeats has an anchor that repeats."""
        runs, per = run_hashes(self.hashes, self.run), self.size - self.run + 1
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        least = runs[self.starts].copy()
        for k in range(1, per):
            np.minimum(least, runs[self.starts + k], out=least)
        chosen = np.zeros(len(runs), dtype=bool)
        for k in range(per):
            chosen[self.starts[runs[self.starts + k] == least] + k] = True
        return least, runs[chosen]

    def windows(self) -> np.ndarray:
        return run_hashes(self.hashes, self.size)[self.starts].view(np.int64)


class SuffixAutomaton:
    """All substrings of some passages, each a list of symbols."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def _state(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state that c leads to from p, of p's length and one more; split off q where q is longer."""
        length, link, to = self.length, self.link, self.next
        if length[q] == length[p] + 1:
            return q
        own = self._state(length[p] + 1, dict(to[q]), link[q])
        link[q] = own
        while p >= 0 and to[p].get(c) == q:
            to[p][c] = own
            p = link[p]
        return own

    def add(self, passage: list) -> None:
        to, link = self.next, self.link
        last = 0
        for c in passage:
            q = to[last].get(c)
            if q is not None:
                last = self._split(last, c, q)
                continue
            own, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and c not in to[p]:
                to[p][c] = own
                p = link[p]
            if p >= 0:
                link[own] = self._split(p, c, to[p][c])
            last = own

    def matched(self, passage: list) -> list[int]:
        """Matching statistics: the length of the longest substring of the automaton that ends at each symbol."""
        to, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for c in passage:
            q = to[state].get(c)
            while q is None and state:
                state = link[state]
                n = length[state]
                q = to[state].get(c)
            if q is None:
                n = 0
            else:
                state, n = q, n + 1
            out.append(n)
        return out


def spans_above(matched: list[int], least: int) -> list[tuple[int, int]]:
    """The maximal spans (start, end) that matches of at least ``least`` symbols cover."""
    out: list[tuple[int, int]] = []
    for end, n in enumerate(matched, 1):
        if n >= least:
            if out and end - n <= out[-1][1]:
                out[-1] = (min(out[-1][0], end - n), end)
            else:
                out.append((end - n, end))
    return out


def addressed(docs: DataFrame, id_col: str, text_col: str, part_bytes: int) -> DataFrame:
    """(part, at, doc_id, key, text), stored: at is the address of the text's first word."""
    schema = pa.schema([("part", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("text", pa.string())])

    def run(it):
        number, part, used = part_numbers(part_bytes), -1, 0
        for batch in it:
            parts, at = [], []
            for text in batch.column(1).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass")
                own = number(len(raw))
                if own != part:
                    part, used = own, 0
                parts.append(part)
                at.append((part << ADDRESS_BITS) + used)
                used += len(raw.split())
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(at, pa.int64()), ids, ids.fill_null(LAST), batch.column(1).fill_null("")], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, "part long, at long, doc_id long, key long, text string"), "addressed-documents", compression="zstd")


def repeated_passages(base: DataFrame, words: int, run: int, shard_bits: int, block_bytes: int) -> DataFrame:
    """(shard, first, at, n, text), stored: the passages of windows that occur more than once.  first marks where
    a window starts first of all: those are the shard's references.  The others are to be streamed through the
    shard that holds their windows' first start."""
    def anchors(it):
        for table in blocks(it, 0, 4, block_bytes):
            block = Block(table, words, run)
            found, n = np.unique(block.anchors()[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block.part)), pa.array(found.view(np.int64)), pa.array(n > 1)], names=["part", "anchor", "again"])

    seen = base.mapInArrow(anchors, "part long, anchor long, again boolean")
    alike = Window.partitionBy("anchor")
    more = (F.count("*").over(alike) > 1) | F.max("again").over(alike)
    anchor_folder = dealt(seen.withColumn("more", more).where("more").select("part", "anchor"), "repeated-anchors")

    def windows(it):
        held = None
        for table in blocks(it, 0, 4, block_bytes):
            block = Block(table, words, run)
            if held != block.part:
                held, (known,) = block.part, side(anchor_folder, block.part, ["anchor"])
            may = lookup(known, block.anchors()[0].view(np.int64)) >= 0
            starts = block.starts[may]
            found, at, n = np.unique(block.windows()[may], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(block.key[starts[at]]), pa.array(block.address[starts[at]]), pa.array(n > 1)],
                                             names=["window", "key", "at", "again"])

    seen = base.mapInArrow(windows, "window long, key long, at long, again boolean")
    alike = Window.partitionBy("window")
    more = (F.count("*").over(alike) > 1) | F.max("again").over(alike)
    first = F.min(F.struct("key", "at")).over(alike)["at"]
    window_folder = dealt(seen.withColumn("more", more).withColumn("first", first).where("more")
                          .select(F.shiftright("at", ADDRESS_BITS).alias("part"), "window", "first"), "repeated-windows")

    def passages(it):
        held = None
        for table in blocks(it, 0, 4, block_bytes):
            block = Block(table, words, run)
            if held != block.part:
                held, (known, firsts) = block.part, side(window_folder, block.part, ["window", "first"])
            at = lookup(known, block.windows())
            starts, first = block.starts[at >= 0], firsts[at[at >= 0]]
            if not len(starts):
                continue
            own, shard = first == block.address[starts], first >> shard_bits
            # runs of windows that start one after the other in a document and belong to the same shard
            new = np.ones(len(starts), dtype=bool)
            new[1:] = (np.diff(starts) != 1) | (np.diff(block.address[starts]) != 1) | (own[1:] != own[:-1]) | (shard[1:] != shard[:-1])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(starts)) - 1
            lo, hi = starts[begin], starts[end] + words
            texts = [b" ".join(block.words[a:z]).decode("utf-8", "surrogatepass") for a, z in zip(lo.tolist(), hi.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard[begin]), pa.array(own[begin]), pa.array(block.address[lo]), pa.array(hi - lo), pa.array(texts, pa.string())],
                                             names=["shard", "first", "at", "n", "text"])

    return stored(base.mapInArrow(passages, "shard long, first boolean, at long, n long, text string"), "repeated-passages", compression="zstd")


def streamed(passages: DataFrame, words: int, stream_words: int) -> DataFrame:
    """(part, start, end): spans of word addresses that repeat an earlier passage, from matching statistics.

    A shard's passages are dealt into groups of about ``stream_words`` words, however many they are, and its
    references go to each of the groups, which builds the automaton of them and streams its passages."""
    # a row per shard with more words than one group takes: written first, so that Spark knows its size and joins it
    # to the passages where they lie while it is small, and by a shuffle beyond that
    many = passages.where("not first").groupBy("shard").agg(F.ceil(F.sum("n") / stream_words).cast("int").alias("groups")).where("groups > 1")
    rows = passages.join(stored(many, "busy-shards"), "shard", "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
    salt = F.when(F.col("first"), F.sequence(F.lit(0), F.col("groups") - 1)).otherwise(F.array(F.pmod(F.xxhash64("at"), F.col("groups")).cast("int")))
    rows = rows.withColumn("salt", F.explode(salt)).select("shard", "salt", "first", "at", "text")

    def match(table: pa.Table) -> pa.Table:
        automaton, first = SuffixAutomaton(), table["first"].to_pylist()
        symbols: dict[bytes, int] = {}
        texts = [t.encode("utf-8", "surrogatepass").split() for t in table["text"].to_pylist()]
        for own, passage in zip(first, texts):
            if own:
                automaton.add([symbols.setdefault(w, len(symbols)) for w in passage])
        start, end = [], []
        for own, at, passage in zip(first, table["at"].to_pylist(), texts):
            if not own:
                for a, z in spans_above(automaton.matched([symbols.get(w, -1) for w in passage]), words):
                    start.append(at + a)
                    end.append(at + z)
        return pa.table({"part": pa.array([a >> ADDRESS_BITS for a in start], pa.int64()), "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())})

    return rows.groupBy("shard", "salt").applyInArrow(match, "part long, start long, end long")


def remove_repeats(docs: DataFrame, words: int = 20, run: int = 10, shard_bits: int = 15, stream_words: int = 200_000, id_col: str = "doc_id",
                   text_col: str = "text", part_bytes: int = 64 << 20, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept: the words left over, joined by single spaces.

    Words are runs of other characters than space, tab and line breaks, unchanged.  Of equal windows of ``words``
    words the one that starts first stays, in order of doc_id, null ids last, rows of one id in the order in which
    the table stores them; every word that another of them covers goes.  Windows are judged on the input.

    Steps: texts get word addresses and are stored in parts; anchors (the least hash of ``run`` words in each
    window) that occur twice tell which windows may repeat, hashes of those windows which do and where they start
    first.  Passages of windows that start first are the references, in shards of 2^shard_bits addresses; the rest
    are streamed through the automata of their shards, and only words the automaton has matched are removed.  A
    frequent line or passage costs a row per block of ``block_bytes`` and never meets in one task; texts are
    scanned in place and never shuffled, only repeated passages travel.

    Null text has no words; a text of fewer than ``words`` words loses nothing; no documents give no rows.  Hashes
    have 64 bits: words never go for a hash's sake, but of two different windows with one hash only the first
    one's repeats are found.
    """
    base = addressed(docs, id_col, text_col, part_bytes)
    found = streamed(repeated_passages(base, words, run, shard_bits, block_bytes), words, stream_words)
    folder = dealt(found, "repeated-spans")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def keep(it):
        held = None
        for table in blocks(it, 0, 4, block_bytes):
            part = table.column("part")[0].as_py()
            if held != part:
                held, (starts, ends) = part, side(folder, part, ["start", "end"])
            n_words, n_removed, kept = [], [], []
            for at, text in zip(table.column("at").to_pylist(), table.column("text").to_pylist()):
                own = text.encode("utf-8", "surrogatepass").split()
                lo, hi = np.searchsorted(starts, [at, at + len(own)])
                n_words.append(len(own))
                if lo < hi:
                    edges = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edges, starts[lo:hi] - at, 1)
                    np.add.at(edges, ends[lo:hi] - at, -1)
                    own = [own[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(own))
                kept.append(b" ".join(own).decode("utf-8", "surrogatepass"))
            columns = [table.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
            yield from pa.table(columns, schema=schema).to_batches()

    return base.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")
