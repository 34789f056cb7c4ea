"""A training corpus from documents: language, near-duplicates, personal data, mix, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import ready, stored, table
from marketlake.llm.langid import UNKNOWN, identify_languages
from marketlake.llm.mixing import mix_sources
from marketlake.llm.pii import redact
from marketlake.llm.sentencepieces import encode_pieces
from marketlake.llm.simhash import simhash_near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with certainty; lang becomes the predicted one.  Texts without a letter
    and texts whose two nearest codewords are too close to tell apart go."""
    ready(spark)
    told = identify_languages(docs, keep=COLUMNS)
    return told.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select(
        *[F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in COLUMNS])


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """The documents, stored, with a key of each row's own: ids may be null or repeat."""
    return stored(docs.select(*COLUMNS).withColumn("rid", F.monotonically_increasing_id()), name, compression="zstd")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates, whatever its ids: of least doc_id, null last, and among rows of
    that id the least text.  Groups are of rows, so rows that share an id or have none may lie in different ones."""
    ready(spark)
    own = keyed(docs, "keyed-documents")
    groups = simhash_near_duplicates(own, id_col="rid", words=4, max_bits=4).select(F.col("doc_id").alias("rid"), F.col("component_id").alias("grp"))
    rows = stored(groups.join(own.select("rid", "doc_id"), "rid"), "grouped-documents")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "n")
    least = (rows.groupBy("grp", "doc_id").agg(F.count("*").alias("n")).groupBy("grp").agg(F.min(first).alias("f"))
             .select(F.col("grp").alias("g"), F.col("f.doc_id").alias("id"), F.col("f.n").alias("n")))
    # n rows of a group share its least id: where there is one, it is known without its text
    first = stored(rows.join(least, (F.col("grp") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("rid", "grp", "n"), "kept-documents")
    # the same join at every size: texts meet the kept rows by a shuffle, also where few rows would fit a broadcast
    kept = own.hint("merge").join(first, "rid")
    once = kept.where("n = 1").select(*COLUMNS)
    again = (kept.where("n > 1").groupBy("grp").agg(F.min(F.struct("text", "lang", "source", "n_chars", "doc_id")).alias("r"))
             .select(*[F.col(f"r.{c}").alias(c) for c in COLUMNS]))
    return once.unionByName(again)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data replaced by the name of its kind; n_chars counts the new text."""
    ready(spark)
    return redact(docs, COLUMNS).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, whatever its id; those it leaves out go."""
    ready(spark)
    own = keyed(docs, "keyed-documents")
    copies = stored(mix_sources(own, row_col="rid").where("copies > 0").select("rid", "copies"), "mix-copies")
    joined = own.hint("merge").join(copies, "rid")  # as in one_of_each
    return (joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*COLUMNS))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's piece ids, and the text decoded from them."""
    ready(spark)
    return encode_pieces(docs, ["doc_id", "lang", "source", "n_chars", "text"]).select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").alias("text"))


STAGES = [("language identification", known_language), ("SimHash near-dedup", one_of_each), ("personal data", without_personal_data),
          ("mixing sources", mixed), ("SentencePiece", pieces)]

#: No stage but the last two's row counts can be put in SQL: trained classifiers, SimHash and Viterbi can't.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage-{at}", compression="zstd")
    return docs
