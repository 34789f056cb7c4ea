"""Embedding near-duplicates: spherical k-means cells, cosine products in blocks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, union_find
from .graph import components


def unit(rows) -> np.ndarray:
    """The rows at length 1.  They are first brought near 1 by a power of two, which changes no digit, so that the
    squares of very short and very long vectors neither vanish nor overflow."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in rows])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def plane_gaps(c: np.ndarray) -> np.ndarray:
    """Distances between unit centroids, from their products: k x k numbers whatever the length of a vector.  What the
    products round off is added, so that no gap is too small."""
    return np.sqrt(np.maximum(0.0, np.add.outer(q := (c * c).sum(axis=1), q) - 2 * (c @ c.T))) + 1e-7


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k unit centroids of the unit vectors ``x``; a cell that empties keeps its centroid."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 1e-12] = total[norm > 1e-12] / norm[norm > 1e-12, None]
    return c


def embedding_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                              label_col: str = "label", threshold: float = 0.93, sample_rows: int = 4096,
                              cell_rows: int = 1024, block_rows: int = 4096) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of the same non-null label (and length) whose cosine in double
    precision reaches ``threshold`` are linked.  Per label, spherical k-means
    on a sample of at most ``sample_rows`` vectors gives the cells; every
    vector has the home cell of its nearest centroid.  A vector within the
    threshold's angle of another lies no further than that angle from the
    other's cell, so it also visits each cell whose dividing plane towards its
    own is that near: no link is lost, whatever the clusters look like.
    Visitors are compared with home rows in blocks of at most ``block_rows``
    on either side, so no task holds a whole hot cell.  A block sends back its
    rows' link counts and the links of a spanning forest, never all pairs.

    Equal vectors of a label are one class with a multiplicity; every member
    links to the others.  Null, zero and non-finite vectors, vectors with null
    components and null labels link with nothing (n_links 0, component = own
    id).  Rows that repeat an id count as vectors of their own; a component
    takes the smallest id.  A null id links as any other, sorts last, and a
    component with no id but null has a null component_id and kept false.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.col(label_col).alias("label"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are the same component
    v0 = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = rows.withColumn("ok", usable).withColumn("v", F.when(F.col("ok"), v0))
    classes = (rows.where("ok").groupBy("label", "v")
               .agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = stored(classes, "vector-classes")  # from here on a class keeps its number

    per = (classes.groupBy("label", F.size("v").alias("d")).agg(F.count("*").alias("rows"))
           .withColumn("salts", F.ceil(F.col("rows") / block_rows).cast("int"))
           .withColumn("k", F.least(F.ceil(F.col("rows") / cell_rows), F.lit(max(1, sample_rows // 8))).cast("int")))
    sized = classes.withColumn("d", F.size("v")).join(per, ["label", "d"])
    # the sample: the rows of least hash, up to about sample_rows of them
    share = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = sized.where(share < F.lit(float(sample_rows)) / F.col("rows")).select("label", "d", "k", "v")
    label_type = dict(classes.dtypes)["label"]

    def fit(key, pdf):
        x = unit(pdf["v"])
        c = spherical_kmeans(x, max(1, min(int(pdf["k"].iloc[0]), len(x))))
        return pd.DataFrame({"label": [key[0]], "d": [key[1]], "c": [c.ravel().tolist()]})

    centroids = sample.groupBy("label", "d").applyInPandas(fit, f"label {label_type}, d int, c array<double>")
    centroids = (stored(centroids, "centroids").join(per.select("label", "d", "salts"), ["label", "d"])
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("cid", F.lit("salt")), F.col("salts").cast("long")).cast("int"))
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9

    def assign(key, pdf, cpdf):
        if not len(pdf):
            return pd.DataFrame({"cid": [], "home": [], "cells": []})
        x = unit(pdf["v"])
        if len(cpdf):
            c = np.asarray(cpdf["c"].iloc[0]).reshape(-1, x.shape[1])
        else:  # a few rows, none of them drawn: one cell
            c = x[:1] * 0
        p = x @ c.T
        home = np.argmax(p, axis=1)
        gap = plane_gaps(c)
        near = p - p[np.arange(len(x)), home][:, None] >= -reach * gap[home]
        near[np.arange(len(x)), home] = True
        return pd.DataFrame({"cid": pdf["cid"].to_numpy(), "home": home.astype("int32"),
                             "cells": [np.flatnonzero(r).astype("int32").tolist() for r in near]})

    homes = (salted.select("label", "d", "salt", "cid", "v").groupBy("label", "d", "salt")
             .cogroup(centroids.groupBy("label", "d", "salt"))
             .applyInPandas(assign, "cid long, home int, cells array<int>"))
    placed = stored(classes.withColumn("d", F.size("v")).join(homes, "cid"), "vector-cells")

    visits = placed.select("label", "d", F.explode("cells").alias("cell"), "home", "cid", "n", "v")
    counts = (visits.groupBy("label", "d", "cell")
              .agg(F.count("*").alias("nv"), F.sum((F.col("home") == F.col("cell")).cast("long")).alias("nm"))
              .where("nm > 0")
              .withColumn("nv", F.ceil(F.col("nv") / block_rows).cast("int"))
              .withColumn("nm", F.ceil(F.col("nm") / block_rows).cast("int")))
    visits = visits.join(counts, ["label", "d", "cell"])
    part = lambda n: F.pmod(F.xxhash64("cid", F.lit("block")), F.col(n).cast("long")).cast("int")
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_visitor = visits.withColumn("a", part("nv")).withColumn("b", F.explode(span("nm"))).withColumn("guest", F.lit(True))
    as_member = (visits.where("home = cell").withColumn("b", part("nm")).withColumn("a", F.explode(span("nv")))
                 .withColumn("guest", F.lit(False)))

    def compare(pdf):
        guest = pdf["guest"].to_numpy(dtype=bool)
        q, m = pdf[guest].reset_index(drop=True), pdf[~guest].reset_index(drop=True)
        if not len(q) or not len(m):
            return pd.DataFrame({"a": [], "b": [], "n": []})
        ids = np.concatenate([q["cid"].to_numpy(), m["cid"].to_numpy()])
        known, at = np.unique(ids, return_inverse=True)
        qa, ma, weight = at[:len(q)], at[len(q):], m["n"].to_numpy(dtype=np.int64)
        mx, qx = unit(m["v"]), unit(q["v"])
        n, found = np.zeros(len(q), dtype=np.int64), []
        for s in range(0, len(q), 512):
            i, j = np.nonzero((qx[s:s + 512] @ mx.T >= threshold) & (qa[s:s + 512, None] != ma[None, :]))
            np.add.at(n, i + s, weight[j])
            found.append((qa[i + s], ma[j]))
        root = union_find(len(known), iter(found))
        child = np.flatnonzero(root != np.arange(len(known)))
        linked = np.flatnonzero(n)
        return pd.DataFrame({"a": np.concatenate([known[child], q["cid"].to_numpy()[linked]]),
                             "b": np.concatenate([known[root[child]], np.zeros(len(linked), dtype=np.int64)]),
                             "n": np.concatenate([np.zeros(len(child), dtype=np.int64), n[linked]])})

    found = stored(as_visitor.unionByName(as_member).select("label", "d", "cell", "a", "b", "guest", "cid", "n", "v")
                   .groupBy("label", "d", "cell", "a", "b").applyInPandas(compare, "a long, b long, n long"), "vector-links")
    roots = components(found.where("n = 0").select("a", "b"), "vector-components")
    links = found.where("n > 0").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("linked"))
    # a component is named by its smallest id
    named = (classes.select("cid", "n", "first_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    least = stored(named.groupBy("root").agg(F.min("first_id").alias("component")), "vector-names")
    named = (named.join(least, "root").join(links, "cid", "left")
             .select("cid", "component", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    named = classes.select("cid", "label", "v", F.lit(True).alias("ok")).join(named, "cid")
    out = rows.join(named, ["ok", "label", "v"], "left")
    component = F.when(F.col("ok"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
