"""URL filter: rules behind a memory-mapped, sorted array of 64-bit digests."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

#: The rules of the registered query: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@dataclass
class RuleIndex:
    """Rules ordered by digest; ``at`` has where each rule's string starts in ``strings``; ``shapes`` has the
    pairs (length of host, length of path) that occur, which bound the probes of any URL.

    A stored string is verdict, host and path, split by NUL; a probe is only
    a hit when the string found behind its digest is the one it looked for.
    """

    digests: np.ndarray
    at: np.ndarray
    strings: np.ndarray
    shapes: np.ndarray

    @staticmethod
    def write(rules: list[tuple[str, str, str]], path: str, digest=None) -> None:
        digest = digest or (lambda s: xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")))
        best: dict[tuple[str, str], str] = {}
        for verdict, host, start in rules:  # block wins over allow for the same rule
            key = (host.lower(), start)
            best[key] = "block" if "block" in (verdict, best.get(key)) else verdict
        made = sorted((digest(f"{h}\0{p}"), f"{v}\0{h}\0{p}".encode("utf-8", "surrogatepass")) for (h, p), v in best.items())
        shapes = sorted({(len(h), len(p)) for h, p in best})
        with open(path, "wb") as f:
            np.array([len(made), len(shapes)], dtype="<u8").tofile(f)
            np.array([d for d, _ in made], dtype="<u8").tofile(f)
            np.cumsum([0, *(len(s) for _, s in made)], dtype="<u8").tofile(f)
            np.array(shapes, dtype="<u8").tofile(f)
            f.write(b"".join(s for _, s in made))

    @staticmethod
    def open(path: str) -> RuleIndex:
        head = np.fromfile(path, dtype="<u8", count=2)
        n, k = int(head[0]), int(head[1])
        words = np.memmap(path, dtype="<u8", mode="r", shape=(3 + 2 * n + 2 * k,))
        size = os.path.getsize(path) - 8 * len(words)
        strings = np.memmap(path, dtype=np.uint8, mode="r", offset=8 * len(words), shape=(size,)) if size else np.zeros(0, np.uint8)
        return RuleIndex(words[2:2 + n], words[2 + n:3 + 2 * n], strings, np.array(words[3 + 2 * n:]).reshape(-1, 2))

    def probe(self, digests: np.ndarray, wanted: list[str]) -> list[str | None]:
        """The verdict of the rule whose string each probe names, or None; equal digests are all looked at."""
        lo = np.searchsorted(self.digests, digests, "left")
        hi = np.searchsorted(self.digests, digests, "right")
        out: list[str | None] = [None] * len(wanted)
        for i in np.flatnonzero(hi > lo):
            for r in range(lo[i], hi[i]):
                verdict, _, own = bytes(self.strings[self.at[r]:self.at[r + 1]]).decode("utf-8", "surrogatepass").partition("\0")
                if own == wanted[i]:
                    out[i] = verdict
        return out


def split_url(column) -> tuple:
    """(host, path) columns: host between the first :// and the next / ? # or the end, A-Z lower-cased; path from
    there to the next ? # or the end.  Null, or no ://: both empty."""
    rest = F.when(F.instr(column, "://") > 0, F.expr(f"substring({_name(column)}, instr({_name(column)}, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def _name(column) -> str:
    return f"`{column}`"


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id",
                url_col: str = "url", digest=None) -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path of the rule, or null), verdict.

    A rule fits its host and all subdomains where the path starts with the rule's; the longest rule (host and
    path together, then the longer host) wins, and without one the verdict is ``default``.  Hosts of rules are
    compared lower-cased; a rule listed with both verdicts blocks.

    The digests are sorted into a file that every executor gets once and maps into memory: a task touches only
    the pages its binary search reads, so a list may exceed a worker's memory.  Each URL is probed with its
    host's suffixes and path prefixes of the lengths that rules have, a batch of URLs at once, and every digest
    found is confirmed by the stored string, so a collision changes nothing.

    Null ids stay null, repeated rows keep their rows, an empty list gives ``default`` everywhere, and an
    empty table an empty result.
    """
    spark = pages.sparkSession
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="url-rules-"), name)
    RuleIndex.write(rules, local, digest)
    spark.sparkContext.addFile(local)
    hash_of = digest or (lambda s: xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")))
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                        ("verdict", pa.string())])
    opened: dict[str, RuleIndex] = {}

    def judge(b):
        index = opened.get(name) or opened.setdefault(name, RuleIndex.open(SparkFiles.get(name)))
        hosts, paths = b.column(1).to_pylist(), b.column(2).to_pylist()
        shapes = [(int(m), int(n)) for m, n in index.shapes]
        owner, wanted = [], []
        for i, (h, p) in enumerate(zip(hosts, paths)):
            for m, n in shapes:
                if n <= len(p) and (m == len(h) or 0 < m < len(h) and h[-m - 1] == "."):
                    owner.append(i)
                    wanted.append(f"{h[len(h) - m:]}\0{p[:n]}")
        digests = np.array([hash_of(w) for w in wanted], dtype=np.uint64)
        best: dict[int, tuple[int, int, str, str]] = {}
        for i, w, verdict in zip(owner, wanted, index.probe(digests, wanted)):
            if verdict is not None:
                h, p = w.split("\0", 1)
                best[i] = max(best.get(i, (-1, -1, "", "")), (len(h) + len(p), len(h), h + p, verdict))
        return {"page_id": b.column(0), "host": hosts, "path": paths,
                "rule": [best[i][2] if i in best else None for i in range(len(hosts))],
                "verdict": [best[i][3] if i in best else default for i in range(len(hosts))]}

    host, path = split_url("url")
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
            .select("page_id", host.alias("host"), path.alias("path"))
            .mapInArrow(batches(judge, schema), "page_id long, host string, path string, rule string, verdict string"))
