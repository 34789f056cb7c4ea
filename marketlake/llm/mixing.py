"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, stored
HEAVY = 0.02


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          row_col: str | None = None) -> DataFrame:
    """(rid, doc_id, source, size, tie): size is the number of words of the whole text, null counts as empty; rid is
    ``row_col``, a long of each row's own, or made here; tie is a hash of id, source and text."""
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("rid", pa.int64()), ("tie", pa.int64())])

    def run(b):
        return {"doc_id": b.column(0), "source": b.column(1), "rid": b.column(3), "tie": b.column(4),
                "size": [len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in b.column(2).to_pylist()]}

    rid = F.col(row_col) if row_col else F.monotonically_increasing_id()
    doc_id, source = F.col(id_col).cast("long"), F.col(source_col).cast("string")
    tie = F.xxhash64(doc_id, source, F.coalesce(F.col(text_col), F.lit("")))
    out = (docs.select(doc_id.alias("doc_id"), source.alias("source"), F.col(text_col).alias("text"), rid.alias("rid"), tie.alias("tie"))
           .mapInArrow(batches(run, schema), "doc_id long, source string, size long, rid long, tie long"))
    return stored(out, "document-sizes")


def repeats(sized: DataFrame) -> DataFrame:
    """(rid, nth): for rows that others equal in every value, their number among those, from 0.  Equal rows are
    counted per stored file part and numbered there, so however many there are they never meet in one task."""
    again = sized.groupBy("tie").agg(F.count("*").alias("n")).where("n > 1").select("tie")
    rows = stored(sized.join(again, "tie", "left_semi").select("tie", "rid").withColumn("part", F.shiftright("rid", 20)), "equal-rows")
    parts = rows.groupBy("tie", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tie").orderBy("part")) - F.col("n")
    within = F.row_number().over(Window.partitionBy("tie", "part").orderBy("rid")) - 1
    return rows.join(parts.select("tie", "part", before.alias("before")), ["tie", "part"]).select("rid", (F.col("before") + within).alias("nth"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, docs, target), a row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes; a target
    stops at ``most`` times its source's size and the excess is reshared by weight.  Where that ends, a target
    is the smaller of its stop and its weight times a common level; with the sources in order of stop over
    weight, the level is the largest remainder per weight among those that stay below the stop there.  The
    windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(at, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("stop", F.col("source_size") * most).withColumn("r", F.col("stop") / F.col("w"))
    order = Window.orderBy("r", F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = (per.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("stop").over(before), F.lit(0)))
           .withColumn("wleft", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("c", F.col("left") / F.col("wleft")))
    per = per.withColumn("level", F.max(F.when(F.col("c") <= F.col("r"), F.col("c"))).over(whole))
    target = F.least(F.col("stop").cast("double"), F.coalesce(F.col("level"), F.col("r")) * F.col("w"))
    return per.select("source", "source_size", "docs", target.alias("target"))


def pivot_round(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rounds probabilities in pairs until at most one is fractional; sum(size * p) stays what it is, and each
    p is 1 at the end with probability p.

    A pair moves mass, measured in words, one way or the other until one of the two is 0 or 1; the chances of
    the two ways are such that neither probability changes in expectation.  All pairs of a round move at once,
    the fractional ones meet again in the next.
    """
    p = p.astype(np.float64).copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    while len(open_) > 1:
        odd, n = open_[len(open_) & ~1:], len(open_) // 2
        i, j = open_[0:2 * n:2], open_[1:2 * n:2]
        a, b = size[i] * 1.0, size[j] * 1.0
        up = np.minimum((1 - p[i]) * a, p[j] * b)       # words that can move from j to i
        down = np.minimum(p[i] * a, (1 - p[j]) * b)     # and from i to j
        to_i = rng.random(n) * (up + down) < down
        fills, empties = (1 - p[i]) * a <= p[j] * b, p[i] * a <= (1 - p[j]) * b
        pi = np.where(to_i, np.where(fills, 1.0, p[i] + up / a), np.where(empties, 0.0, p[i] - down / a))
        pj = np.where(to_i, np.where(fills, p[j] - up / b, 0.0), np.where(empties, p[j] + down / b, 1.0))
        p[i], p[j] = np.clip(pi, 0, 1), np.clip(pj, 0, 1)
        both = np.concatenate([np.stack([i, j], axis=1).ravel(), odd])
        open_ = both[(p[both] > 1e-12) & (p[both] < 1 - 1e-12)]
    return p


def pool_round(p: float, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Rounds documents that share one probability, largest first; sum(size * p) stays what it is, and what is left
    fractional is the smallest that can be.

    A document is paired with the pool of all smaller ones, which move together and so keep one probability.  Mass
    moves one way or the other until the document is integral, with chances that leave both where they are in
    expectation, so it is 1 at the end with probability p; then the next largest meets the rest of the pool.  A
    document that the pool can't cover leaves the pool integral and stays fractional itself.  Only where that would
    miss the sum by much, for a document of over ``HEAVY`` of the words to take that the pool can cover one way, it
    goes that way without a draw."""
    order = np.argsort(-size, kind="stable")
    out, rest, draws = np.empty(len(size)), float(size.sum()), rng.random(len(size))
    heavy = HEAVY * p * rest
    for k, i in enumerate(order.tolist()):
        a = float(size[i])
        rest -= a
        if p <= 1e-12 or p >= 1 - 1e-12:
            out[order[k:]] = round(p)
            break
        if k == len(order) - 1:
            out[i] = p
            break
        fills, empties = (1 - p) * a <= p * rest, p * a <= (1 - p) * rest
        up, down = min((1 - p) * a, p * rest), min(p * a, (1 - p) * rest)   # words from and to the pool
        if fills if fills != empties and a > heavy else draws[k] * (up + down) < down:
            out[i], p = p + up / a, p - up / rest
        else:
            out[i], p = p - down / a, p + down / rest
    return np.clip(out, 0, 1)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), most: int = 3, group_rows: int = 8192, fan_in: int = 64,
                seed: int = 1, row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, and first ``row_col`` if given (a
    long of each row's own, to join by where ids are null or repeat).

    A document of a source is due target / source_size copies, ``most`` at the most.  It surely gets the whole
    part; the fractions are rounded by the pivotal method.  A source's documents are dealt by hash into groups
    of about ``group_rows``; every group is rounded, each document against the pool of its smaller ones, down to one
    small residual document with a fraction; residuals of ``fan_in`` groups meet in pairs in the next level of a tree,
    until one is left per source, whose fraction is rounded.  So a source's taken words miss its target
    by less than a small document wherever no document outweighs the rest of its group, no task holds a hot source,
    and all that goes up the tree is one row per group.

    Draws hang on the seed, the level, the group and the documents' own values (id, source, text), never on where rows
    lie, so reruns agree; rows that repeat in every value are numbered, dealt by their number and interchangeable.
    Null sources are a source of their own, null ids stay null and are told apart by their texts, a text without words
    takes nothing, an empty table gives an empty result.
    """
    sized = sizes(docs, id_col, text_col, source_col, row_col)
    per = stored(targets(sized, weights, most), "source-targets")
    per = per.withColumn("groups", F.greatest(F.lit(1), F.ceil(F.col("docs") / group_rows)).cast("int"))
    due = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    # equal rows get different ties by their numbers, the same in every run
    tie = F.xxhash64(F.lit(seed), "tie", F.coalesce("nth", F.lit(0)))
    rows = (sized.join(repeats(sized), "rid", "left").withColumnRenamed("source", "s").join(per, F.col("s").eqNullSafe(F.col("source"))).drop("s")
            .withColumn("due", due).withColumn("whole", F.floor("due").cast("long")).withColumn("p", F.col("due") - F.col("whole"))
            .withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(0.0)).withColumn("tie", tie)
            .withColumn("grp", F.pmod(F.xxhash64(F.lit(seed + 1), "tie"), F.col("groups").cast("long")).cast("int"))
            .select("rid", "doc_id", "source", "size", "source_size", "target", "whole", "p", "tie", "grp", "groups"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)

    def rounded(level):
        def run(key, rows):
            rows = rows.sort_by([("tie", "ascending"), ("size", "ascending"), ("rid", "ascending")])
            source, grp = key[0].as_py(), key[1].as_py()
            name = [seed, level, grp, *("" if source is None else "x" + source).encode()]
            p, size, rng = rows["p"].to_numpy().copy(), rows["size"].to_numpy(), np.random.default_rng(name)
            open_ = np.flatnonzero((p > 0) & (p < 1))
            if level == 0 and len(open_):  # a source's documents start with one probability
                p[open_] = pool_round(float(p[open_[0]]), size[open_], rng)
            else:
                p = pivot_round(p, size, rng)
            return rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p))
        return run

    most_groups = per.agg(F.max("groups")).first()[0] or 0
    fraction = (F.col("p") > 1e-12) & (F.col("p") < 1 - 1e-12)
    done, level, current = [], 0, rows
    while most_groups:
        current = stored(current.groupBy("source", "grp").applyInArrow(rounded(level), schema), "rounded")
        done.append(current.where(~fraction))
        level, last = level + 1, most_groups == 1
        current = current.where(fraction).withColumn("grp", F.floor(F.col("grp") / fan_in).cast("int"))
        if last:
            break
        most_groups = -(-most_groups // fan_in)
    # a source's last fraction goes to the nearer side
    out = current.withColumn("p", F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0))
    for part in done:
        out = out.unionByName(part)
    copies = F.col("whole") + F.round("p").cast("long")
    own = [F.col("rid").alias(row_col)] if row_col else []
    return out.select(*own, "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))
