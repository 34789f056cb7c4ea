"""Personal data: base patterns, and bootstrapped contextual extraction on top."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, stored, texts

KINDS = ["email", "ip", "card", "phone"]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches of the e-mail pattern, found from the @ signs: a match starts where the run of local
    characters before an @ starts, so a long run without one costs nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, per kind leftmost and non-overlapping, in order of kind and start."""
    if not _HINT.search(text):
        return []
    out = [("email", a, z) for a, z in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# what an identifier may look like that the base patterns miss; context decides.  Lengths are those of the things
# themselves (a mail address's parts, a card's digits); longer runs are no identifiers of these looser forms
_LOOSE = {
    "email": re.compile(r"(?<![^\s<(\"'])[A-Za-z0-9._%+-]{1,64} ?(?:@|\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]{1,63}){0,4}"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{2,5}(?![0-9])"),
}
_OTHER = re.compile(r"(?<![0-9A-Za-z_-])(?=[A-Za-z_-]{0,64}[0-9])[0-9A-Za-z_-]{4,128}(?![0-9A-Za-z_-])")
_AT = re.compile(r"@|[\[(]at[\])]")
_EDGE = re.compile(r"^\W+|\W+$")
NEAR = 80


def context(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a mention: two words before, one before and one after, two after, from what lies within
    ``NEAR`` characters of it.  A pattern is words: one without a letter (a line's edge, punctuation, numbers) stands
    around times and versions as well as around identifiers, and is none."""
    norm = lambda w: re.sub(r"[0-9]+", "#", _EDGE.sub("", w).lower())
    left = ["", "", *map(norm, text[max(0, start - NEAR):start].split()[-2:])]
    right = [*map(norm, text[end:end + NEAR].split()[:2]), "", ""]
    made = [f"{left[-2]} {left[-1]} _", f"{left[-1]} _ {right[0]}", f"_ {right[0]} {right[1]}"]
    return [p for p in made if any(map(str.isalpha, p))]


def mentions(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Seeds (the base spans) and candidates (looser forms outside of them, kind by kind; other identifiers,
    which only count against a pattern) with the patterns around them.  A candidate that lies in one of another
    kind is inner: what is part of an identifier is no evidence against it.  Other identifiers in a candidate go."""
    if not _HINT.search(text) and not _AT.search(text):
        return []
    found = [(k, a, z, True, False) for k, a, z in base]
    starts, ends = [], []  # the base spans' union, in order
    for a, z in sorted((a, z) for _, a, z in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], z)
        else:
            starts.append(a)
            ends.append(z)

    def free(a: int, z: int) -> bool:
        before = bisect_left(starts, z)
        return before == 0 or ends[before - 1] <= a

    loose = {kind: [m.span() for m in pattern.finditer(text) if free(*m.span())]
             for kind, pattern in _LOOSE.items() if kind != "email" or _AT.search(text)}
    reach = {kind: ([a for a, _ in spans], list(accumulate((z for _, z in spans), max))) for kind, spans in loose.items()}

    def inner(a: int, z: int, kind: str) -> bool:
        return any((before := bisect_right(firsts, a)) and lasts[before - 1] >= z for k, (firsts, lasts) in reach.items() if k != kind)

    for kind, spans in loose.items():
        found += [(kind, a, z, False, inner(a, z, kind)) for a, z in spans]
    found += [("other", *m.span(), False, False) for m in _OTHER.finditer(text) if free(*m.span()) and not inner(*m.span(), "other")]
    return [{"kind": k, "start": a, "end": z, "seed": s, "inner": i, "value": re.sub(r"\s+", " ", text[a:z]).lower(),
             "patterns": context(text, a, z)} for k, a, z, s, i in found]


_MENTION = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()),
                      ("inner", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
_MENTIONS = "array<struct<kind:string,start:int,end:int,seed:boolean,inner:boolean,value:string,patterns:array<string>>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, mentions, rid) of every document, stored without the texts; rid is ``row_col``, a long of each
    row's own, or made here."""
    schema = pa.schema([("doc_id", pa.int64()), ("mentions", pa.list_(_MENTION)), ("rid", pa.int64())])

    def run(b):
        return {"doc_id": b.column(0), "mentions": [mentions(t, base_spans(t)) for t in texts(b.column(1))], "rid": b.column(2)}

    rid = F.col(row_col) if row_col else F.monotonically_increasing_id()
    found = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), rid.alias("rid"))
             .mapInArrow(batches(run, schema), f"doc_id long, mentions {_MENTIONS}, rid long"))
    return stored(found, "pii-mentions")


def bootstrap(found: DataFrame, min_seeds: int = 3, confidence: float = 0.8) -> DataFrame:
    """(value, kind) of the identifiers that trusted patterns discover.

    The graph has an edge for every pattern and every distinct value seen in it.  For a kind, a pattern's values
    are known (seeds of the kind, and accepted values), against it (of another kind or no kind, unless inside a
    candidate of another kind), or open (candidates of the kind, which say nothing).  Its confidence is the known
    over the known and those against (and a half, so that few values prove less); a pattern around ``min_seeds``
    known values with at least ``confidence`` is trusted, and the open values in it are accepted.  That repeats
    until no value is added; accepting never lowers a confidence, so the order doesn't matter.  An accepted value
    scores 1 - the product of (1 - confidence) over its trusted patterns, and has the kind of its best score.

    Every round is joins and sums over the whole graph and is written to the shared folder.  Frequent patterns
    are summed before the shuffle and their join rows may be split.
    """
    m = found.select(F.explode("mentions").alias("m"))
    edges = stored(m.select(F.explode("m.patterns").alias("p"), F.col("m.value").alias("value"), F.col("m.kind").alias("kind"),
                            F.col("m.seed").alias("seed"), F.col("m.inner").alias("inner"))
                   .groupBy("p", "value", "kind").agg(F.max("seed").alias("seed"), F.min("inner").alias("inner")), "pii-edges")
    counts = edges.where("kind <> 'other'").groupBy("p", "kind").agg(
        F.sum(F.col("seed").cast("long")).alias("seeds"), F.sum((~F.col("inner")).cast("long")).alias("own"))
    seen = edges.groupBy("p").agg(F.sum((~F.col("inner")).cast("long")).alias("values"))
    patterns = stored(counts.join(seen, "p").select("p", "kind", F.col("seeds").alias("known"), (F.col("values") - F.col("own")).alias("against")), "pii-patterns")
    open_ = stored(edges.where("not seed and kind <> 'other'").select("p", "value", "kind"), "pii-open")
    c = F.col("known") / (F.col("known") + F.col("against") + 0.5)
    accepted = None
    while True:
        rated = patterns.where(F.col("known") >= min_seeds).withColumn("c", c).where(F.col("c") >= confidence)
        scores = stored(open_.join(rated.select("p", "kind", "c"), ["p", "kind"]).groupBy("value", "kind")
                        .agg((1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("score")), "pii-scores")
        new = scores if accepted is None else scores.join(accepted.select("value", "kind"), ["value", "kind"], "left_anti")
        new = stored(new.select("value", "kind"), "pii-new")
        accepted = scores  # trust is never lost: the scored are those accepted so far and the new
        if new.isEmpty():
            break
        more = open_.join(new, ["value", "kind"]).groupBy("p", "kind").agg(F.count("*").alias("more"))
        patterns = stored(patterns.join(more, ["p", "kind"], "left").select(
            "p", "kind", (F.col("known") + F.coalesce("more", F.lit(0))).alias("known"), "against"), "pii-patterns")
    best = scores.withColumn("rank", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
    return (best.groupBy("value").agg(F.max_by("kind", F.struct("score", -F.col("rank"))).alias("kind")))


def _joined(spans) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(set(spans), key=lambda s: (order[s[0]], s[1], s[2])))


def additions(found: DataFrame, **options) -> DataFrame:
    """(rid, doc_id, kind, start, end) of the mentions that the bootstrapped patterns add."""
    accepted = stored(bootstrap(found, **options), "pii-accepted")
    loose = found.select("rid", "doc_id", F.explode("mentions").alias("m")).where("not m.seed and m.kind <> 'other'")
    loose = loose.select("rid", "doc_id", F.col("m.start").alias("start"), F.col("m.end").alias("end"),
                         F.col("m.value").alias("value"), F.col("m.kind").alias("as"))
    return (loose.join(accepted, "value").where(F.col("as") == F.col("kind"))
            .select("rid", "doc_id", "kind", "start", "end").distinct())


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all,
    kind:start:end in code points, by kind and start), n_added.

    Base spans come from fixed patterns over the whole text.  They seed the bootstrap: the words around them
    become patterns, a graph of patterns and the values seen in them is scored until it adds none (``bootstrap``), and
    values of an identifier's looser form (``_LOOSE``: addresses of parts up to 64 and 63 characters, IPv6, cards of 13
    to 19 digits, phones without a plus) in trusted patterns are added as spans of that kind.  Base spans
    stay as they are, added ones never overlap them.  The n_ columns count base spans, n_added the others.

    Null text counts as empty; null ids stay null; every repeated row keeps its row and finds the same.
    """
    found = scan(docs, id_col, text_col)
    more = stored(additions(found, **options).groupBy("rid").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")), "pii-added")
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                        ("spans", pa.string()), ("n_added", pa.int64())])

    def run(b):
        base = [[(m["kind"], m["start"], m["end"]) for m in row if m["seed"]] for row in b.column(1).to_pylist()]
        extra = [[(m["kind"], m["start"], m["end"]) for m in row or ()] for row in b.column(2).to_pylist()]
        return {"doc_id": b.column(0), **{f"n_{k}": [sum(s[0] == k for s in own) for own in base] for k in KINDS},
                "base_sha256": [hashlib.sha256(_joined(own).encode()).hexdigest() for own in base],
                "spans": [_joined([*own, *add]) for own, add in zip(base, extra)], "n_added": [len(set(add)) for add in extra]}

    return (found.join(more, "rid", "left").select("doc_id", F.col("mentions"), "more")
            .mapInArrow(batches(run, schema), "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
                        + ", base_sha256 string, spans string, n_added long"))


def redact(docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The columns of ``docs`` with every span of ``find_personal_data`` replaced by [EMAIL], [IP], [CARD] or
    [PHONE]; overlapping spans become one, named by the first.  Null text stays null."""
    docs = stored(docs.select(*columns, F.monotonically_increasing_id().alias("__rid")), "keyed-documents", compression="zstd")
    found = scan(docs, id_col, text_col, "__rid")
    more = (additions(found, **options).groupBy(F.col("rid").alias("__rid"))
            .agg(F.collect_list(F.struct("kind", "start", "end")).alias("__more")))  # of one row's text
    more = stored(more, "pii-added")
    at = columns.index(text_col)
    fields = [docs.schema[c] for c in columns]

    def hide(text: str, extra) -> str:
        spans = sorted([*base_spans(text), *((e["kind"], e["start"], e["end"]) for e in extra or ())], key=lambda s: (s[1], -s[2]))
        out, end = [], 0
        for kind, a, z in spans:
            if a >= end:
                out += [text[end:a], f"[{kind.upper()}]"]
            end = max(end, z)
        return "".join([*out, text[end:]])

    def run(it):
        for batch in it:
            for lo in range(0, batch.num_rows, 2000):
                b = batch.slice(lo, 2000)
                done = [None if t is None else hide(t, e) for t, e in zip(b.column(at).to_pylist(), b.column(len(columns)).to_pylist())]
                own = [b.column(k) if k != at else pa.array(done, pa.string()) for k in range(len(columns))]
                yield pa.RecordBatch.from_arrays(own, names=columns)

    joined = docs.join(more, "__rid", "left").select(*columns, "__more")
    return joined.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
