"""Cross-tokenizer alignment: the token ends of two tokenizers merged along independent merge-path pieces."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from .common import batches, stored
from .parts import blocks, dealt, lookup, part_numbers, side
from .vocab import byte_alphabet, cuts, tokenizer_path

MARK = "▁"
MEMO_WORDS, LONG_WORD = 200_000, 64
UNITS = 12  # words that are learnt as one text
# white space at an end of the text or beside other white space: its token hangs on what surrounds it
_ODD = re.compile(r"\s\s|\A\s|\s\Z")


class ByteTokens:
    """A byte-level tokenizer of a .json file, given a space and the text; strings of its special tokens inside
    texts are plain text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_words = cuts(path) == "leading"
        bytes_of = {c: b for b, c in byte_alphabet().items()}
        vocabulary = self.tokenizer.get_vocab()
        self.spelt = [b""] * (max(vocabulary.values()) + 1)
        for entry, at in vocabulary.items():
            known = all(c in bytes_of for c in entry)
            self.spelt[at] = bytes(bytes_of[c] for c in entry) if known else entry.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceTokens:
    """A sentencepiece model that puts a space before a text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            made = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        norm = made.normalizer_spec
        # no piece goes on behind a word's end, and texts are taken as they are
        self.by_words = (norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix
                         and not norm.remove_extra_whitespaces
                         and not any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece for p in made.pieces))
        self.spelt = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).replace(MARK, " ").encode() for i in range(self.model.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


@lru_cache(maxsize=4)
def loaded(name: str) -> tuple[ByteTokens | PieceTokens, np.ndarray, list[str]]:
    """A tokenizer, the byte length of each of its ids and the three forms an id has in the text of groups."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = name if "/" in name else tokenizer_path(name)
    tokens = (ByteTokens if path.endswith(".json") else PieceTokens)(path)
    forms = [f"{i}{sep}" for i in range(len(tokens.spelt)) for sep in ",|;"]
    return tokens, np.array([len(s) for s in tokens.spelt], dtype=np.int64), forms


class Encoder:
    """Ids of texts by both tokenizers, as arrays; none where either does not spell a space and the text.

    Where both tokenizers must cut before a single space, and around a single line feed, between two characters that
    are no white space, a word is encoded once per worker and not once per occurrence; texts with other white space at
    a space or line feed are encoded whole.
    """

    def __init__(self, a: str, b: str):
        (self.a, self.length_a, _), (self.b, self.length_b, _) = loaded(a), loaded(b)
        self.memo_a, self.memo_b, self.bad = {}, {}, set()
        self.by_words = self.a.by_words and self.b.by_words
        if self.by_words:
            # the space before a line feed is a token of its own
            self.by_words = all(t.spelt[t.encode(["\nx"])[0][0]] == b" " for t in (self.a, self.b))

    def _spelt(self, want: list[bytes], ids: list[list[int]], tokens: ByteTokens | PieceTokens, length: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Each text's ids as bytes of 32-bit integers, and whether their bytes are those wanted."""
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        ends = np.append(0, np.cumsum([len(x) for x in ids]))
        raw, cuts_ = flat.tobytes(), (ends * 4).tolist()
        size = np.diff(np.append(0, np.cumsum(length[flat]))[ends]) == np.array([len(w) for w in want])
        if not size.all() or b"".join(map(tokens.spelt.__getitem__, flat.tolist())) != b"".join(want):
            size = np.array([b"".join(map(tokens.spelt.__getitem__, x)) == w for x, w in zip(ids, want)], dtype=bool)
        return [raw[lo:hi] for lo, hi in zip(cuts_[:-1], cuts_[1:])], size

    def _both(self, texts: list[str], ids_a: list[list[int]]) -> tuple[list[bytes], list[bytes], np.ndarray]:
        want = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
        x, same_x = self._spelt(want, ids_a, self.a, self.length_a)
        y, same_y = self._spelt(want, self.b.encode(texts), self.b, self.length_b)
        return x, y, same_x & same_y

    def _learn(self, units: list[str]) -> None:
        """Ids of units: a word, or a line feed and the word after it.  Both tokenizers cut between units, so
        ``UNITS`` of them are encoded as one text and its ids are cut at the units' last bytes; units of a text that
        is not given back byte for byte are encoded one by one, which tells the bad ones."""
        chunks = [" ".join(units[k:k + UNITS]) for k in range(0, len(units), UNITS)]
        x, y, same = self._both(chunks, self.a.encode(chunks))
        good = np.flatnonzero(same).tolist()
        own = [u for k in good for u in units[k * UNITS:(k + 1) * UNITS]]
        rest = [u for k in np.flatnonzero(~same).tolist() for u in units[k * UNITS:(k + 1) * UNITS]]
        # the space before a unit is the first of its bytes
        ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) + 1 for u in own])
        found = []
        for side, length in ((x, self.length_a), (y, self.length_b)):
            raw = b"".join([side[k] for k in good])
            at = np.append(0, np.cumsum(length[np.frombuffer(raw, np.int32)]))
            cut = np.searchsorted(at, ends)
            if not (at[cut] == ends).all():
                raise ValueError("a token goes on behind a word's end")
            # a line feed's unit leaves out the space, which both give as a token of its own before it
            cut = (cut * 4).tolist()
            found.append([raw[lo + 4 if u[0] == "\n" else lo:hi] for u, lo, hi in zip(own, [0, *cut], cut)])
        if rest:
            x, y, same = self._both(rest, self.a.encode(rest))
            self.bad.update(rest[n] for n in np.flatnonzero(~same))
            for kept, side in zip(found, (x, y)):
                kept += [s[4:] if u[0] == "\n" else s for u, s in zip(rest, side)]
        for memo, kept in zip((self.memo_a, self.memo_b), found):
            memo.update(zip(own + rest, kept))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        # a line feed begins a unit, as a space does; only the space itself is left out
        plain = {i: t.replace("\n", " \n").split(" ") for i, t in enumerate(texts) if t and self.by_words and not _ODD.search(t)}
        if len(self.memo_a) > MEMO_WORDS:
            for held in (self.memo_a, self.memo_b, self.bad):
                held.clear()
        get_a, get_b, bad = self.memo_a.__getitem__, self.memo_b.__getitem__, self.bad
        new = [u for u in set().union(*plain.values()) if u not in self.memo_a]
        if new:
            self._learn(new)
        out = [(b"", b"")] * len(texts)
        for i, units in plain.items():
            if bad.isdisjoint(units):
                out[i] = b"".join(map(get_a, units)), b"".join(map(get_b, units))
        whole = [i for i, t in enumerate(texts) if t and i not in plain]
        if whole:
            own = [texts[i] for i in whole]
            x, y, same = self._both(own, self.a.encode(own))
            for i, *p, s in zip(whole, x, y, same):
                if s:
                    out[i] = tuple(p)
        for u in new:
            if len(u) > LONG_WORD:  # kept for this batch alone
                del self.memo_a[u], self.memo_b[u]
                bad.discard(u)
        return out


@lru_cache(maxsize=2)
def encoder(a: str, b: str) -> Encoder:
    return Encoder(a, b)


def cut_points(ends_a: np.ndarray, ends_b: np.ndarray, diagonals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each diagonal d, how many of the first d ends of the merged sequence come from A and how many from B,
    where an end of A precedes an equal one of B.  All diagonals are searched at once, each by bisection."""
    lo, hi = np.maximum(0, diagonals - len(ends_b)), np.minimum(diagonals, len(ends_a))
    while (lo < hi).any():
        mid = (lo + hi) // 2
        open_ = lo < hi
        more = open_ & (ends_a[np.minimum(mid, len(ends_a) - 1)] <= ends_b[np.where(open_, diagonals - mid - 1, 0)])
        lo, hi = np.where(more, mid + 1, lo), np.where(open_ & ~more, mid, hi)
    return lo, diagonals - lo


def merge_piece(ends_a: np.ndarray, ends_b: np.ndarray, a: tuple[int, int], b: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The overlaps one piece of the merge finds: pairs (i, j) of A and B tokens that share a byte, in order.

    The piece holds the ends a[0]..a[1] of A and b[0]..b[1] of B and looks at nothing else.  Each of its ends is
    the last byte that some pair shares: an end of A with the token of B whose end is the next one not before it,
    an end of B with the token of A that is still open there.  Where both end together the end of A has found the
    pair; that holds too where its end is the last of the piece before, which only stitching can tell.
    """
    own_a, own_b = ends_a[a[0]:a[1]], ends_b[b[0]:b[1]]
    under_a = b[0] + np.searchsorted(own_b, own_a, "left")
    taken = np.searchsorted(own_a, own_b, "right")
    alone = np.ones(len(own_b), dtype=bool)
    after = taken > 0
    alone[after] = own_a[taken[after] - 1] != own_b[after]
    i = np.concatenate([np.arange(a[0], a[1]), a[0] + taken[alone]])
    j = np.concatenate([under_a, np.arange(b[0], b[1])[alone]])
    order = np.argsort(i + j, kind="stable")
    return i[order], j[order]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, piece: int = 65_536) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (i, j) of A and B tokens that share a byte, in order, and whether both end together there.

    Diagonals of the merge path cut the merge into pieces of ``piece`` ends; pieces know nothing of each other,
    and each costs the same whatever lies in it.  Stitching joins them where two equal ends lie on both sides of a
    border: the piece before has their pair, and the one the next piece makes of the end of B is dropped.  Groups
    run across borders as any others do.
    """
    n = len(ends_a) + len(ends_b)
    if not len(ends_a) or not len(ends_b):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    at_a, at_b = cut_points(ends_a, ends_b, np.append(np.arange(0, n, piece), n))
    found = []
    for k in range(len(at_a) - 1):
        i, j = merge_piece(ends_a, ends_b, (at_a[k], at_a[k + 1]), (at_b[k], at_b[k + 1]))
        if k and len(i) and at_a[k] and at_b[k] < at_b[k + 1] and ends_a[at_a[k] - 1] == ends_b[at_b[k]]:
            keep = (i != at_a[k]) | (j != at_b[k])
            i, j = i[keep], j[keep]
        found.append((i, j))
    i, j = (np.concatenate(x) for x in zip(*found))
    return i, j, ends_a[i] == ends_b[j]


def aligned(texts: list[str | None], a: str, b: str, piece: int = 65_536) -> dict:
    """Tokens of a batch of texts and their alignment, the texts laid end to end on one axis of bytes.

    ids_a, ids_b and n_a, n_b per text (0 where either tokenizer's bytes are not a space and the text), the pairs
    i, j that share bytes, and together: whether they end together, which closes a group.
    """
    found = encoder(a, b).encode(texts)
    n_a, n_b = (np.array([len(f[k]) // 4 for f in found], dtype=np.int64) for k in (0, 1))
    ids_a, ids_b = (np.frombuffer(b"".join([f[k] for f in found]), np.int32).astype(np.int64) for k in (0, 1))
    i, j, together = overlaps(np.cumsum(loaded(a)[1][ids_a]), np.cumsum(loaded(b)[1][ids_b]), piece)
    return {"ids_a": ids_a, "ids_b": ids_b, "n_a": n_a, "n_b": n_b, "i": i, "j": j, "together": together}


def group_texts(found: dict, a: str, b: str) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``: ids of A and B in order."""
    (_, _, forms_a), (_, _, forms_b) = loaded(a), loaded(b)
    i, j = found["i"][found["together"]], found["j"][found["together"]]
    last_a, last_b = np.zeros(len(found["ids_a"]), np.int64), np.zeros(len(found["ids_b"]), np.int64)
    last_a[i], last_b[j] = 1, 2
    # a token's place: tokens of A and B before its group, and for B those of A in its group
    group_a, group_b = np.cumsum(last_a) - last_a, (np.cumsum(last_b) - last_b) // 2
    ends_i, ends_j = np.append(-1, i) + 1, np.append(-1, j) + 1
    place_a = np.arange(len(last_a)) + ends_j[group_a]
    place_b = np.arange(len(last_b)) + ends_i[group_b + 1] if len(i) else np.zeros(0, np.int64)
    names = np.empty(len(last_a) + len(last_b), dtype=object)
    names[place_a] = list(map(forms_a.__getitem__, (found["ids_a"] * 3 + last_a).tolist()))
    names[place_b] = list(map(forms_b.__getitem__, (found["ids_b"] * 3 + last_b).tolist()))
    cuts = np.append(0, np.cumsum(found["n_a"] + found["n_b"])).tolist()
    return ["".join(names[lo:hi].tolist())[:-1] for lo, hi in zip(cuts[:-1], cuts[1:])]


def links_per_text(found: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the A and B tokens linked (both end together), and how many links each text has."""
    i, j = found["i"][found["together"]], found["j"][found["together"]]
    ends = np.append(0, np.cumsum(found["n_a"]))
    return i, j, np.diff(np.searchsorted(i, ends))


def align_tokens(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                 text_col: str = "text", piece: int = 65_536) -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, and group by group (a_end, b_end) how many tokens of each lie
    before its end.  Nulls, empty texts and texts that a tokenizer does not give back byte for byte: empty arrays."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.list_(pa.int32())) for c in ("a_ids", "b_ids", "a_end", "b_end")]])

    def run(batch):
        found = aligned(batch.column(1).to_pylist(), a, b, piece)
        i, j, n = links_per_text(found)
        at_a, at_b, at = (np.append(0, np.cumsum(x)) for x in (found["n_a"], found["n_b"], n))
        cut = lambda x, ends: [x[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])]
        return {"doc_id": batch.column(0), "a_ids": cut(found["ids_a"], at_a), "b_ids": cut(found["ids_b"], at_b),
                "a_end": [x + 1 - lo for x, lo in zip(cut(i, at), at_a)], "b_end": [x + 1 - lo for x, lo in zip(cut(j, at), at_b)]}

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(batches(run, schema, rows=200), "doc_id long, a_ids array<int>, b_ids array<int>, a_end array<int>, b_end array<int>"))


def alignment_table(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                    text_col: str = "text", piece: int = 65_536, chars: int = 250_000, part_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Every text is encoded by both tokenizers, and the byte ends of their tokens are merged in merge-path pieces;
    an offset where tokens of both end closes a group and links the two tokens.  A pair of ids counts its links in
    all documents; count_sum adds the counts of a document's links, n_best counts those whose count no other pair
    of their B id exceeds.

    Encoding happens once: the linked pairs of each text are stored as flat integers.  Counts are summed per block
    first, and what travels are distinct pairs of a part (the frequent ones, which a third of all links may hold,
    are one row per part), with their totals back to the part's file; no text or list of links is shuffled.  A
    task encodes texts of ``chars`` characters together (a longer text alone), and a part's table of pairs is
    bounded by its ``part_bytes`` of links.

    Null and empty texts, and texts whose tokens of either kind do not spell a space and the text byte for byte,
    have no tokens: zeros, and an empty groups_sha256.  Null ids stay null, repeated rows keep their rows, an
    empty table gives an empty result.
    """
    width = len(loaded(b)[0].spelt)
    link = np.dtype("<u4" if len(loaded(a)[0].spelt) * width <= 1 << 32 else "<u8")
    names = ["doc_id", "n_a", "n_b", "n_groups"]
    schema = pa.schema([("part", pa.int64()), *[(n, pa.int64()) for n in names], ("groups_sha256", pa.string()), ("links", pa.binary())])

    def encode(it):
        number = part_numbers(part_bytes)
        for batch in it:
            ids, own = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(own):
                to, size = at + 1, len(own[at] or "")
                while to < len(own) and size + len(own[to] or "") <= chars:
                    size, to = size + len(own[to] or ""), to + 1
                found = aligned(own[at:to], a, b, piece)
                i, j, n = links_per_text(found)
                pairs = (found["ids_a"][i] * width + found["ids_b"][j]).astype(link).tobytes()
                cuts = np.append(0, np.cumsum(n) * link.itemsize).tolist()
                rows = [pairs[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])]
                digests = [sha256(t.encode()).hexdigest() if t else "" for t in group_texts(found, a, b)]
                columns = [[number(len(r)) for r in rows], ids[at:to], found["n_a"], found["n_b"], n, digests, rows]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                at = to

    def block_counts(it):
        for block in blocks(it, 0, 1, part_bytes):
            pairs, n = np.unique(np.frombuffer(b"".join(block.column(1).to_pylist()), link), return_counts=True)
            part = np.full(len(pairs), block.column(0)[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], names=["part", "pair", "n"])

    out = pa.schema([*[(n, pa.int64()) for n in (*names, "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())])

    def score(it):
        held = None
        for block in blocks(it, 0, 6, part_bytes):
            part = block.column(0)[0].as_py()
            if held != part:
                held, (pairs, total, best) = part, side(folder, part, ["pair", "total", "best"])
            rows = block.column(6).to_pylist()
            at = lookup(pairs, np.frombuffer(b"".join(rows), link).astype(np.int64))
            ends = np.append(0, np.cumsum([len(r) // link.itemsize for r in rows]))
            sums = [np.diff(np.append(0, np.cumsum(x[at]))[ends]) if len(at) else np.zeros(len(rows), np.int64) for x in (best, total)]
            columns = [*[block.column(n) for n in names], block.column("n_groups"), *sums, block.column("groups_sha256")]
            yield from pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, pa.int64()) for c in columns], schema=out).to_batches()

    sql = "part long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
    base = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, sql), "aligned-documents")
    seen = stored(base.select("part", "links").mapInArrow(block_counts, "part long, pair long, n long"), "link-counts")
    totals = seen.groupBy("pair").agg(F.sum("n").alias("total"))
    # a B id's rows here are at most A's vocabulary
    best = F.col("total") == F.max("total").over(Window.partitionBy((F.col("pair") % width).alias("b")))
    totals = totals.withColumn("best", best.cast("long"))
    folder = dealt(seen.select("part", "pair").distinct().join(totals, "pair"), "link-totals")
    return base.mapInArrow(score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
