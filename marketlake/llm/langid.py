"""Language identification by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

DIM = 1 << 14
PIECE = 1 << 18
UNKNOWN = "und"

# bytes as the classifiers see them: A-Z lower-cased, other ASCII that is no letter a space
_SEEN = np.arange(256, dtype=np.int64)
_SEEN[65:91] += 32
_SEEN[[i for i in range(128) if not chr(i).isalpha()]] = 32


def grams(raw: np.ndarray) -> np.ndarray:
    """Hashed byte trigrams of a text's bytes with a space on either side; trigrams of spaces alone are left out."""
    b = np.concatenate([[32], _SEEN[raw], [32]])
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    code = code[code != 0x202020]
    return ((code * 0x9E3779B1) >> 13) & (DIM - 1)


def pieces(raw: np.ndarray):
    """A very long text in pieces that overlap by two bytes, so that every trigram is met once."""
    if len(raw) <= PIECE:
        yield grams(raw)
        return
    for at in range(0, len(raw), PIECE):
        b = _SEEN[raw[max(0, at - 2):at + PIECE]]
        b = np.concatenate([[32] if at == 0 else [], b, [32] if at + PIECE >= len(raw) else []]).astype(np.int64)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        code = code[code != 0x202020]
        yield ((code * 0x9E3779B1) >> 13) & (DIM - 1)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(classes: int) -> np.ndarray:
    """A row of +1/-1 bits for every class, from the Hadamard rule: bit b of class c is the parity of c & b.
    Any two rows differ in half of the code's length, so an eighth of the bits and more may be wrong."""
    order = max(2, int(np.ceil(np.log2(classes + 1))))
    c, b = np.arange(1, classes + 1)[:, None], np.arange(1, 1 << order)[None, :]
    return 1 - 2 * (np.bitwise_count(c & b).astype(np.int64) & 1)


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray      # classes x bits
    weights: np.ndarray   # DIM x bits: log odds of a trigram for the bit's classes against the rest

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, score, ambiguous) of rows of bit margins: the codeword of least loss, where a bit's loss is
        log(1 + exp(-agreement)), so that an undecided classifier weighs little and a sure one much.  The score
        is the codeword's share of exp(-loss); ambiguous: the runner-up is less than one bit's even odds away."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).sum(axis=2)
        best = loss.argmin(axis=1)
        rest = np.exp(loss.min(axis=1, keepdims=True) - loss)
        ahead = np.sort(loss, axis=1)
        close = (ahead[:, 1] - ahead[:, 0] < np.log(2)) if loss.shape[1] > 1 else np.zeros(len(loss), dtype=bool)
        return best, 1 / rest.sum(axis=1), close


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """The model of all labelled rows (text and label not null).

    One pass counts hashed trigrams per language in every partition; Spark adds them up.  A bit's classifier is
    the log odds of a trigram between the languages with that bit and those without, every language weighing
    the same.  What reaches the driver is one count per language and hash value (DIM of them), whatever the
    number of documents.  No rows: a model without languages.
    """
    def count(it):
        total: dict[str, np.ndarray] = {}

        def flush():
            for lang, n in total.items():
                g = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(g), "g": pa.array(g, pa.int32()), "n": n[g]})

        for b in it:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = total.setdefault(lang, np.zeros(DIM, dtype=np.int64))
                raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                for g in pieces(raw):
                    own += np.bincount(g, minlength=DIM)
            if len(total) > 256:  # many labels: hand on what there is, memory stays bounded
                yield from flush()
                total.clear()
        yield from flush()

    counted = (rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
               .where("lang is not null and text is not null").mapInArrow(count, "lang string, g int, n long")
               .groupBy("lang", "g").agg(F.sum("n").alias("n")))
    found = stored(counted, "trigram-counts").toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    table = np.zeros((len(langs), DIM))
    at = {lang: i for i, lang in enumerate(langs)}
    table[[at[x] for x in found.column("lang").to_pylist()], found.column("g").to_numpy()] = found.column("n").to_numpy()
    if not langs:
        return Model([], np.zeros((0, 0)), np.zeros((DIM, 0), dtype=np.float32))
    share = (table + 0.01) / (table.sum(axis=1, keepdims=True) + 0.01 * DIM)
    code = codewords(len(langs))
    code = code[:, (code.min(axis=0) < 0) & (code.max(axis=0) > 0)] if len(langs) > 1 else code[:, :1]
    mean = lambda chosen: share[chosen].mean(axis=0) if chosen.any() else share.mean(axis=0)
    weights = np.stack([np.log(mean(code[:, k] > 0)) - np.log(mean(code[:, k] < 0)) for k in range(code.shape[1])], axis=1)
    return Model(langs, code, weights.astype(np.float32))


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", evidence: int = 64) -> DataFrame:
    """The columns ``keep`` of ``docs`` and lang_pred, score, ambiguous, from the text alone.

    The margin of a bit is the mean log odds of the text's trigrams, times their number up to ``evidence``.
    ``und`` with score 0 and ambiguous true: null text, a text without a letter, or a model without languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [docs.schema[c] for c in keep]

    def run(it):
        m = shared.value
        for batch in it:
            for at in range(0, batch.num_rows, 2000):
                b = batch.slice(at, 2000)
                column = b.column(len(keep))
                margins, known = np.zeros((b.num_rows, m.code.shape[1])), np.zeros(b.num_rows, dtype=bool)
                for i, text in enumerate(column):
                    if not m.langs or not text.is_valid or not has_letter(text.as_py()):
                        continue
                    known[i], n, total = True, 0, np.zeros(m.code.shape[1])
                    for g in pieces(np.frombuffer(text.as_buffer(), dtype=np.uint8)):
                        # a bag of hash values: sum the weights of the distinct ones, times their counts
                        total += np.bincount(g, minlength=DIM).astype(np.float32) @ m.weights if len(g) > 2048 else m.weights[g].sum(axis=0, dtype=np.float64)
                        n += len(g)
                    margins[i] = total / max(n, 1) * min(n, evidence)
                if m.langs:
                    best, score, close = m.decode(margins)
                    pred = [m.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())]
                else:
                    pred, score, close = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), np.ones(b.num_rows, dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k) for k in range(len(keep))), pa.array(pred, pa.string()),
                     pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, close, True))],
                    names=[*keep, "lang_pred", "score", "ambiguous"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string", "score double", "ambiguous boolean"])
    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text leaves 1 modulo 3 (a null id: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def identify_languages(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> DataFrame:
    """doc_id (or the columns ``keep``), held_out, lang_pred, score, ambiguous for every document.

    Trains on the documents that are not held out and have text and label, then predicts every whole text;
    label, source and id are never looked at in a prediction.  Repeated rows keep their rows and extra columns
    do not matter; an empty table gives an empty result.
    """
    keep = keep or [id_col]
    model = train(docs.where(~held_out(id_col)), lang_col, text_col)
    return predict(docs, model, keep, text_col).withColumn("held_out", held_out(id_col))
