"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, texts
from .vocab import tokenizer_path

MARK = "▁"
MEMO_UNITS = 200_000
UNK_PENALTY = 10.0
LONG = 256


@dataclass
class DoubleArray:
    """A byte trie in two arrays: from state s, byte c leads to t = base[s] + c if check[t] == s.
    value[t] is the id of the piece that ends there, or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @staticmethod
    def build(keys: dict[bytes, int]) -> DoubleArray:
        ordered = sorted(keys)
        size = 1 << 10
        base, check, value = (np.full(size, -1, dtype=np.int32) for _ in range(3))
        # no slot below ``free`` is open, none from ``top`` on is used: single children fill the holes, families
        # go behind all others; the first 256 slots stay unused, so that no base is below 1
        check[0], free, top = 0, 257, 257
        todo = [(0, 0, len(ordered), 0)]  # state, range of keys that pass it, depth
        while todo:
            state, lo, hi, depth = todo.pop()
            if lo < hi and len(ordered[lo]) == depth:
                value[state] = keys[ordered[lo]]
                lo += 1
            if lo == hi:
                continue
            starts, labels = [lo], [ordered[lo][depth]]
            for i in range(lo + 1, hi):
                if ordered[i][depth] != labels[-1]:
                    starts.append(i)
                    labels.append(ordered[i][depth])
            codes = np.array(labels)
            at = (free if len(labels) == 1 else top) - labels[0]
            while at + 256 >= size:
                base, check, value = (np.concatenate([x, np.full(size, -1, dtype=np.int32)]) for x in (base, check, value))
                size *= 2
            while check[at + labels[0]] >= 0:
                at += 1
            top = max(top, at + labels[-1] + 1)
            base[state], check[at + codes] = at, state
            while free < top and check[free] >= 0:
                free += 1
            for a, z, c in zip(starts, [*starts[1:], hi], labels):
                todo.append((at + c, a, z, depth + 1))
        return DoubleArray(base, check, value)

    def matches(self, b: np.ndarray, starts: np.ndarray):
        """All keys that begin at ``starts`` in the bytes ``b``, by length: yields (starts, length, ids).
        Every start walks the trie at the same time; ``b`` must end in a byte that no key has."""
        state, at, n = np.zeros(len(starts), dtype=np.int64), starts, 0
        while len(at):
            to = self.base[state] + b[at + n]
            ok = (self.base[state] >= 0) & (to < len(self.check))
            ok &= self.check[np.where(ok, to, 0)] == state
            at, state, n = at[ok], to[ok], n + 1
            found = self.value[state]
            hit = found >= 0
            if hit.any():
                yield at[hit], n, found[hit]


@dataclass
class Pieces:
    """A vocabulary: the trie of ordinary pieces, their log scores, and the ids of the 256 byte pieces."""

    trie: DoubleArray
    scores: np.ndarray
    byte_ids: np.ndarray
    unk_id: int
    unk_score: float
    surface: list[bytes]
    dtype: str
    units: re.Pattern
    memo: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def load(path: str) -> Pieces:
        """From a .model file of the sentencepiece library; its scores are the log scores, whatever algorithm
        they were made for.  The unknown score is the least one less ``UNK_PENALTY``."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [(sp.id_to_piece(i), sp.get_score(i), sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
                  for i in range(n)]
        return Pieces.make([(p, s) for p, s, _ in pieces], {i for i, (_, _, special) in enumerate(pieces) if special},
                           {i: int(p[3:5], 16) for i, (p, _, _) in enumerate(pieces) if sp.is_byte(i)}, sp.unk_id())

    @staticmethod
    def make(pieces: list[tuple[str, float]], special: set[int], byte_pieces: dict[int, int], unk_id: int) -> Pieces:
        keys = {p.encode(): i for i, (p, _) in enumerate(pieces) if i not in special}
        scores = np.array([s for _, s in pieces], dtype=np.float64)
        byte_ids = np.full(256, -1, dtype=np.int64)
        surface = [b"" if i in special else p.encode() for i, (p, _) in enumerate(pieces)]
        for i, b in byte_pieces.items():
            byte_ids[b], surface[i] = i, bytes([b])
        own = [scores[i] for i in range(len(pieces)) if i not in special]
        # a text may be cut before a marker that follows something else if no piece has one inside, and around
        # a character of no piece: the best path has a boundary there
        inner = any(MARK in p.lstrip(MARK) for i, (p, _) in enumerate(pieces) if i not in special)
        feeds = any("\n" in p for i, (p, _) in enumerate(pieces) if i not in special)
        units = r"(?s).+" if inner else rf"{MARK}*[^{MARK}]+|{MARK}+" if feeds else rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n"
        return Pieces(DoubleArray.build(keys), scores, byte_ids, unk_id, min(own, default=0.0) - UNK_PENALTY, surface,
                      "<u2" if len(pieces) <= 1 << 16 else "<u4", re.compile(units))

    def viterbi(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of the best path of every word (UTF-8): the greatest sum of log scores; of equal sums the
        one whose last piece starts first.  A character without a piece of its own may be unknown; it becomes
        its bytes' pieces, or the unknown id where the vocabulary has none."""
        flat = np.frombuffer(b"\0".join([*words, b""]) + b"\0", dtype=np.uint8).astype(np.int64)
        length = np.array([len(w) for w in words])
        begin = np.cumsum(length + 1) - (length + 1)
        word = np.repeat(np.arange(len(words)), length)
        inside = np.arange(len(word)) + word  # positions without the separators
        lead = (flat[inside] & 0xC0) != 0x80
        starts = inside[lead]
        chars = np.ones(len(flat) + 1, dtype=np.int64)  # bytes of the character that starts here
        first = flat[starts]
        chars[starts] = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
        single = np.zeros(len(flat) + 1, dtype=bool)
        edges = []
        for at, n, ids in self.trie.matches(flat, starts):
            single[at[chars[at] == n]] = True
            edges.append((at, np.full(len(at), n), ids.astype(np.int64)))
        alone = starts[~single[starts]]
        edges.append((alone, chars[alone], np.full(len(alone), -1)))
        at, n, ids = (np.concatenate(x) for x in zip(*edges))
        score = np.where(ids >= 0, self.scores[ids], self.unk_score)
        local = at - begin[np.searchsorted(begin, at, "right") - 1]
        best = np.full(len(flat) + 1, -np.inf)
        back, piece = np.zeros(len(flat) + 1, dtype=np.int64), np.full(len(flat) + 1, -2)
        best[begin] = 0.0
        order = np.lexsort((n, local))
        at, n, ids, score, local = at[order], n[order], ids[order], score[order], local[order]
        # words up to LONG bytes: one step for every start and length, over all words at once
        cut = int(np.searchsorted(local, LONG))
        key = local[:cut] * 4096 + np.minimum(n[:cut], 4095)
        bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if cut else np.zeros(0, dtype=np.int64)
        for a, z in zip(bounds, [*bounds[1:], cut]):
            to, new = at[a:z] + n[a:z], best[at[a:z]] + score[a:z]
            better = new > best[to]
            to = to[better]
            best[to], back[to], piece[to] = new[better], at[a:z][better], ids[a:z][better]
        if cut < len(at):  # the rest of longer words, edge by edge
            for s, k, i, v in zip(at[cut:].tolist(), n[cut:].tolist(), ids[cut:].tolist(), score[cut:].tolist()):
                if best[s] + v > best[s + k]:
                    best[s + k], back[s + k], piece[s + k] = best[s] + v, s, i
        # walk back, all words at once
        ends, path = begin + length, []
        who, pos = np.arange(len(words)), ends.copy()
        while True:
            live = pos > begin[who]
            who, pos = who[live], pos[live]
            if not len(who):
                break
            path.append((who, back[pos], pos, piece[pos]))
            pos = back[pos]
        if not path:
            return [np.zeros(0, dtype=self.dtype) for _ in words]
        who, a, z, ids = (np.concatenate(x) for x in zip(*path))
        order = np.lexsort((a, who))
        who, a, z, ids = who[order], a[order], z[order], ids[order]
        unknown = ids < 0
        count = np.where(unknown, z - a, 1)
        out_id, out_who = np.repeat(ids, count), np.repeat(who, count)
        offset = np.arange(len(out_id)) - np.repeat(np.cumsum(count) - count, count)
        as_bytes = self.byte_ids[flat[np.repeat(a, count) + offset]]
        hidden = np.repeat(unknown, count)
        out_id = np.where(hidden, np.where(as_bytes >= 0, as_bytes, self.unk_id), out_id)
        keep = ~hidden | (as_bytes >= 0) | (offset == 0)
        out_id, out_who = out_id[keep].astype(self.dtype), out_who[keep]
        return np.split(out_id, np.searchsorted(out_who, np.arange(1, len(words))))

    def encode(self, texts: list[str], dummy_prefix: bool = True) -> list[bytes]:
        """The ids of whole texts, as little-endian integers of ``dtype``: spaces become markers, with one in
        front; units are looked up or, when new, segmented together."""
        split, own = self.units.findall, []
        for t in texts:
            t = t.encode("utf-8", "replace").decode() if not t.isascii() else t
            own.append(split((MARK if dummy_prefix and t else "") + t.replace(" ", MARK)))
        if len(self.memo) > MEMO_UNITS:
            self.memo.clear()
        new = [u for u in set().union(*own) if u not in self.memo]
        new.sort(key=len)
        for at in range(0, len(new), 1 << 13):
            part = new[at:at + (1 << 13)]
            self.memo.update(zip(part, [x.tobytes() for x in self.viterbi([u.encode() for u in part])]))
        get = self.memo.__getitem__
        out = [b"".join(map(get, units)) for units in own]
        for u in new:  # a huge unit isn't worth its memory
            if len(u) > 4 * LONG:
                self.memo.pop(u, None)
        return out

    def decode(self, ids: np.ndarray, dummy_prefix: bool = True) -> str:
        """The text of ids: byte pieces joined to UTF-8 (what is none becomes U+FFFD), markers to spaces, the
        one in front dropped."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if dummy_prefix and text.startswith(" ") else text


def encode_pieces(docs: DataFrame, keep: list[str], model: str = "piece_bpe_32k.model", text_col: str = "text") -> DataFrame:
    """The columns ``keep``, ids (array of int) and decoded (the text decoded from those ids) of every document.

    The trie and the scores are built once and sent to the executors (their size is the vocabulary's).  Null
    text counts as empty and has no ids.  ``decoded`` is the text itself, unless it has the marker character
    (which reads as a space) or halves of surrogates (which become question marks).  Repeated rows keep their
    rows; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model if "/" in model else tokenizer_path(model)))
    fields = [docs.schema[c] for c in keep]

    def run(it):
        pieces = shared.value
        for batch in it:
            for at in range(0, batch.num_rows, 250):
                b = batch.slice(at, 250)
                ids = [np.frombuffer(x, dtype=pieces.dtype) for x in pieces.encode([t or "" for t in b.column(len(keep)).to_pylist()])]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k) for k in range(len(keep))), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))),
                     pa.array([pieces.decode(x) for x in ids], pa.string())], names=[*keep, "ids", "decoded"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "ids array<int>", "decoded string"])
    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def piece_digests(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, n_byte_pieces, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), decoded_sha256, round_trip (whether the decoded text is the text; null counts as empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model if "/" in model else tokenizer_path(model)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("n_byte_pieces", pa.int64()), ("ids_crc32", pa.int64()),
                        ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])

    def run(b):
        # digests are taken where the ids are, so that no second worker holds them
        pieces, own = shared.value, texts(b.column(1))
        ids = [np.frombuffer(x, dtype=pieces.dtype) for x in pieces.encode(own)]
        decoded = [pieces.decode(x) for x in ids]
        return {"doc_id": b.column(0), "n_pieces": [len(x) for x in ids],
                "n_byte_pieces": [int(np.isin(x, pieces.byte_ids).sum()) for x in ids],
                "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                "decoded_sha256": [sha256(t.encode()).hexdigest() for t in decoded], "round_trip": [a == t for a, t in zip(own, decoded)]}

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(batches(run, schema, rows=250),
                        "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean"))
