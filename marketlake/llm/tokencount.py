"""Token counts; huge documents by overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, texts
from .vocab import WordCounts, cuts, load, tokenizer_path

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def stable(text: str, p: int) -> bool:
    """Whether the tokenizer must cut before position p: a single space between two characters that are not
    white space starts a piece, whatever is left and right of them."""
    return 0 < p < len(text) - 1 and text[p] == " " and not text[p - 1].isspace() and not text[p + 1].isspace()


def spliced_count(text: str, tokenizer, chunk: int, overlap: int, known_cuts: bool = True) -> int:
    """Tokens of ``text``: chunks of ``chunk`` characters are encoded with offsets, each starting inside the
    last one.  A boundary is taken at the last position of the overlap where a token of the left chunk and one
    of the right chunk both begin and the cut is proven (``stable``); the left chunk's tokens before it and the
    right chunk's from it on are the whole text's.  Without such a position the overlap is doubled, up to the
    whole rest of the text.  Without a rule for proven cuts the text is encoded whole."""
    def begins(lo: int, hi: int) -> list[int]:
        e = tokenizer.encode(text[lo:hi], add_special_tokens=False)
        return [lo + a for a, _ in e.offsets]

    if not known_cuts or len(text) <= chunk:
        return len(tokenizer.encode(text, add_special_tokens=False))
    lo, hi = 0, min(len(text), chunk)
    starts, total, width = begins(lo, hi), 0, overlap
    while hi < len(text):
        width = min(width, hi - lo)
        start, end = hi - width, min(len(text), hi - width + max(chunk, 2 * width))
        right = begins(start, end)
        # the last 64 characters of the left chunk may be cut inside a token and don't count as agreement
        common = set(starts) & set(right)
        at = max((p for p in common if start < p < hi - 1 and stable(text, p)), default=None)
        if at is None:
            if width == hi - lo:  # nothing to splice in this chunk: take it whole together with as much again
                hi = min(len(text), hi + max(chunk, hi - lo))
                starts, width = begins(lo, hi), overlap
            else:
                width *= 2
            continue
        total += sum(p < at for p in starts)
        starts = [p for p in right if p >= at]
        lo, hi, width = at, end, overlap
    return total + len(starts)


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, chunk: int = 65_536, overlap: int = 256) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is a .json file of the public tokenizers, or a path to one.  Documents of more than ``chunk``
    characters are encoded in overlapping chunks and resynchronised (``spliced_count``), so a worker never
    holds the encoding of a whole huge document; the others word by word where that is exact, else whole.
    Null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows keep their rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
    path = tokenizer if "/" in tokenizer else None
    held: dict = {}

    def run(b):
        where = path or tokenizer_path(tokenizer)
        if "counts" not in held:
            held["counts"], held["cuts"] = WordCounts(where), cuts(where) == "leading"
        own = texts(b.column(1))
        huge = [i for i, t in enumerate(own) if len(t) > chunk]
        n = held["counts"].count([t if len(t) <= chunk else "" for t in own])
        for i in huge:
            n[i] = spliced_count(own[i], load(where), chunk, overlap, held["cuts"])
        return {"doc_id": b.column(0), "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in own], "n_tokens": n,
                "over_limit": [k > limit for k in n]}

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(batches(run, schema, rows=500), SCHEMA))
