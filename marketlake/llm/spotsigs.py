"""SpotSigs document fingerprints, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# The common words that chains are anchored at (English, French, German, Spanish).
ANCHORS = (
    "the of and to a in is it that for on with as be by this are or from at an was not he she they we you "
    "le la les de des du un une et est pour qui que dans par plus pas au sur ne se ce il elle avec son "
    "der die das den von zu mit sich auf für im dem nicht ein eine als auch es aus bei wird einer "
    "el en y los del las por con no su para al lo como más pero sus"
).split()

FIRST = -(1 << 63)
COVER = 16


def with_signatures(df: DataFrame, text: str, out: str, chain: int = 3) -> DataFrame:
    """Adds ``out``: the sorted array of the text's distinct spot signatures (64-bit hashes).

    Words are runs of letters and digits, lower-cased.  A signature is an anchor and the next ``chain`` words
    that are no anchors, however many anchors lie between; of several anchors before the same word the nearest
    counts, and near the end of a text the chain is as long as there are words.  A text whose anchors reach fewer
    than one in ``COVER`` of its content words (code, tables, a language without anchors here) would be told by
    those few alone; it anchors a chain at every word instead.  No words: the empty array.
    """
    w, u, c = f"__w_{out}", f"__u_{out}", f"__c_{out}"
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    # every anchor is glued to the word after it: the~cat sat on~the~mat
    glued = F.array_join(F.transform(F.col(w), lambda x: F.concat(x, F.when(x.isin(ANCHORS), "~").otherwise(" "))), "")
    step1 = df.withColumn(w, words).withColumn(u, F.split(F.rtrim(glued), " "))
    step2 = step1.withColumn(c, F.transform(F.col(u), lambda x: F.substring_index(x, "~", -1)))

    def links(i: Column) -> list[Column]:
        return [F.get(F.col(c), i + k) for k in range(chain)]

    anchored = F.transform(F.col(u), lambda x, i: F.when(
        x.contains("~") & ~x.endswith("~"), F.xxhash64(F.substring_index(F.substring_index(x, "~", -2), "~", 1), *links(i))))
    every = F.transform(F.col(u), lambda x, i: F.when(F.get(F.col(c), i) != "", F.xxhash64(F.lit(""), *links(i))))
    step3 = step2.withColumn(out, F.array_compact(anchored))
    # texts of hardly any anchored words: a chain at every word; words that are all anchors count as words
    alone = F.transform(F.col(w), lambda x: F.xxhash64(F.lit("~"), x))
    content = F.size(F.filter(F.col(c), lambda x: x != ""))
    step3 = step3.withColumn(out, F.when((F.size(out) > 0) & (F.size(out) * COVER >= content), F.col(out)).otherwise(F.array_compact(every)))
    step3 = step3.withColumn(out, F.array_sort(F.array_distinct(F.when(F.size(out) > 0, F.col(out)).otherwise(alone))))
    return step3.drop(w, u, c)


def digest(signatures: str) -> Column:
    """The fingerprint of a signature set: SHA-256 of its sorted members, as lowercase hex."""
    return F.sha2(F.array_join(F.col(signatures).cast("array<string>"), ","), 256)


def length_part(n: Column, threshold: float) -> Column:
    """The partition of a set by its length: two sets whose Jaccard reaches the threshold lie in the same or in
    neighbouring partitions, as the smaller has at least threshold times the larger's members."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / F.lit(-math.log(threshold))).cast("int")


def pruned_jaccard(a: str, b: str, threshold: float = 0.0) -> Column:
    """Jaccard of two signature arrays; 0 without looking at the members where the lengths alone rule the
    threshold out.  Two empty sets are alike (1), an empty and a non-empty one are not (0)."""
    m, n = F.size(a), F.size(b)
    common = F.size(F.array_intersect(F.col(a), F.col(b)))
    return (F.when((m == 0) & (n == 0), F.lit(1.0)).when((m == 0) | (n == 0), F.lit(0.0))
            .when(F.least(m, n) < F.lit(threshold) * F.greatest(m, n), F.lit(0.0))
            .otherwise(common / (m + n - common)))


def signature_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 3) -> tuple[DataFrame, DataFrame]:
    """(classes, members), both stored: classes has a row per distinct signature set (class_id: the least id that has
    it, null ids first; sigs, n), members a row per document (doc_id, fingerprint).  Equal sets are reduced before
    the shuffle, however many documents have one."""
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = stored(with_signatures(base, "text", "sigs", chain).select("k", "sigs", digest("sigs").alias("fingerprint")), "spot-sets")
    classes = own.groupBy("fingerprint").agg(F.min("k").alias("class_id"), F.first("sigs").alias("sigs"))
    return stored(classes.withColumn("n", F.size("sigs")), "spot-classes"), own.select(F.col("k"), "fingerprint")


def spot_pairs(classes: DataFrame, threshold: float = 0.8, rows_per_salt: int = 500) -> DataFrame:
    """(a, b, likeness): the fingerprints of all pairs of signature sets whose Jaccard is ``threshold`` or more, each
    pair once; every pair is found.

    Sets are partitioned by their length, so a set meets those of its own and the next partition only.  There they
    meet by a shared signature among their rarest: of two such sets, ordered by how many sets have a signature, the
    first n - ceil(threshold n) + 1 of both share one, and signatures of a single set are left out.  What common
    passages bring is frequent and so hardly ever among the rarest.  A signature and partition that many sets share
    even so is salted: one side is dealt over its salts, the other goes to all of them.  Pairs that met are told
    apart by length and then compared in full (``pruned_jaccard``)."""
    sets = classes.where("n > 0").select("fingerprint", "n", F.explode("sigs").alias("sig"))
    shared = sets.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1")
    rare = (sets.join(shared, "sig").groupBy("fingerprint", "n").agg(F.array_sort(F.collect_list(F.struct("c", "sig"))).alias("shared")))
    take = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("shared"))
    index = (rare.select("fingerprint", "n", F.explode(F.slice("shared", F.lit(1), F.greatest(F.lit(0), take).cast("int"))).alias("s"))
             .select("fingerprint", "n", F.col("s.sig").alias("sig"), length_part(F.col("n"), threshold - 1e-9).alias("part")))
    index = stored(index, "spot-index")
    busy = index.groupBy("sig", "part").agg(F.ceil(F.count("*") / rows_per_salt).cast("int").alias("salts")).where("salts > 1")
    busy = stored(busy, "spot-busy")
    salted = lambda rows: rows.join(busy, ["sig", "part"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    larger = salted(index).select("sig", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("fingerprint").alias("b"), F.col("n").alias("m"))
    smaller = index.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    smaller = salted(smaller).select("sig", "part", F.pmod(F.xxhash64("fingerprint"), F.col("salts")).cast("int").alias("salt"), F.col("fingerprint").alias("a"), "n")
    met = smaller.join(larger, ["sig", "part", "salt"]).where("(n < m or (n = m and a < b))").where(F.col("n") >= F.col("m") * threshold - 1e-9)
    met = stored(met.select("a", "b").distinct(), "spot-met")
    side = lambda name: classes.select(F.col("fingerprint").alias(name), F.col("sigs").alias(f"sigs_{name}"))
    both = met.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", pruned_jaccard("sigs_a", "sigs_b", threshold).alias("likeness")).where(F.col("likeness") >= threshold)


def spot_search(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", chain: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint, class_id (the least id with the same signature set) and n_similar:
    how many other signature sets have a Jaccard of ``threshold`` or more with its own.

    Copies are one class and aren't expanded into pairs; no link between different sets is lost.  Null text counts
    as empty, texts without words are one class; null ids come first and stay null; repeated rows keep their rows."""
    classes, members = signature_classes(docs, id_col, text_col, chain)
    pairs = stored(spot_pairs(classes, threshold), "spot-pairs")
    links = pairs.select(F.col("a").alias("f")).unionAll(pairs.select("b")).groupBy("f").agg(F.count("*").alias("links"))
    known = classes.join(links, F.col("fingerprint") == F.col("f"), "left").select("fingerprint", "class_id", F.coalesce("links", F.lit(0)).alias("n_similar"))
    real = lambda c: F.when(F.col(c) != FIRST, F.col(c))
    return members.join(known, "fingerprint").select(real("k").alias("doc_id"), "fingerprint", real("class_id").alias("class_id"), "n_similar")


def next_documents(docs: DataFrame) -> DataFrame:
    """(k, half, next): every distinct id, half the length of its text (of the longest, where it repeats) and
    the next id, after the last the first.  Ids are dealt by range, so no task sorts them all; what crosses
    range borders is one row per range."""
    ids = docs.groupBy("k").agg(F.max(F.floor(F.length("text") / 2)).alias("half"))
    ids = stored(ids.repartitionByRange("k").withColumn("bucket", F.spark_partition_id()), "spot-ids")
    by_range = Window.orderBy("bucket")
    firsts = ids.groupBy("bucket").agg(F.min("k").alias("first"))
    firsts = firsts.select("bucket", F.coalesce(F.lead("first").over(by_range), F.min("first").over(Window.partitionBy())).alias("border"))
    return (ids.join(firsts, "bucket")
            .select("k", "half", F.coalesce(F.lead("k").over(Window.partitionBy("bucket").orderBy("k")), F.col("border")).alias("next")))


def spot_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 3) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_signatures.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the
    next document's, in ascending order of id, after the last the first.  Fingerprints digest the whole set of
    spot signatures; near_edited and near_next are the Jaccard likeness of the document's set to the edited
    text's and the next document's.

    Texts travel by id once, and of a next text only what its predecessor takes over, with its signatures.
    Null text counts as empty; a null id comes before all others; where an id repeats, every row keeps its row
    and the text of the smallest head (of equal heads the smallest signatures) stands for the id as a next document.  A single id is its own next document.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = stored(next_documents(base), "spot-order")
    successor = base.join(order.select(F.col("k").alias("before"), F.col("next").alias("k"), "half"), "k")
    successor = with_signatures(successor, "text", "next_sigs", chain)
    head = F.expr("left(text, cast(half as int))")
    successor = (successor.select("before", F.struct(head.alias("head"), F.col("next_sigs").alias("sigs")).alias("s"))
                 .groupBy("before").agg(F.min("s").alias("s")).select(F.col("before").alias("k"), "s.head", F.col("s.sigs").alias("next_sigs")))
    n = F.length("text")
    both = base.join(successor, "k").withColumn("n_chars", n.cast("long"))
    edited = F.concat(F.expr("left(text, cast(n_chars - n_chars div 2 as int))"), F.expr("left(head, cast(n_chars div 2 as int))"))
    both = both.withColumn("edited", edited).drop("head")
    both = with_signatures(both, "text", "sigs", chain)
    both = with_signatures(both, "edited", "edited_sigs", chain)
    return both.select(F.when(F.col("k") != FIRST, F.col("k")).alias("doc_id"), "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       digest("sigs").alias("fingerprint"), digest("edited_sigs").alias("edited_fingerprint"),
                       pruned_jaccard("sigs", "edited_sigs").alias("near_edited"), pruned_jaccard("sigs", "next_sigs").alias("near_next"),
                       F.size("sigs").alias("n_signatures"))
