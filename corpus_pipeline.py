"""From raw documents to token ids, in five stages.

1. quality rules: documents that the rules reject go;
2. n-gram Jaccard join: of each group of near duplicates (five-word shingles,
   similarity 0.8 or more) the document with the smallest id stays;
3. secret scans: found secrets are replaced by a mark in the text;
4. mixing: documents are repeated or left out so that sources meet their weights;
5. BPE encoding: token ids of every remaining row.

Each stage works on all rows that its predecessor kept and returns the columns of
``documents``, the last one its token ids. ``run`` writes every stage as Parquet in the
shared folder and reads it again, so a lost executor repeats tasks of one stage only.
Inside a stage rows are known by their place in the files that they are read from
(``placed``), so no stage keeps a copy of the texts of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.bpe_trie import encode_documents
from foldwise.llm.mixing import mix_sources
from foldwise.llm.ngram_join import ngram_jaccard
from foldwise.llm.quality_rules import quality_rules
from foldwise.llm.secret_grammar import infer_grammars, redacted, secret_scan
from foldwise.llm.work import Workspace, inside, placed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: most ids (8 bytes each) that are broadcast; above it they are joined by a shuffle
MAX_BROADCAST_IDS = 1_000_000
#: rows of an Arrow batch: Spark's 10 000 whole texts are tens of MB in the executor and once more in its Python worker
BATCH_ROWS = 1000


def _bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep. A null or empty text is rejected."""
    _bounded_batches(spark)
    rows = docs.select(*COLUMNS).withColumn("verdict", quality_rules(F.col("text")))
    return rows.where("verdict.kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that with the smallest doc_id (null last), then the smallest hash of its columns. Rows are compared
    by their text alone, so rows that share a doc_id or have none are rows like others. Texts without words have no near duplicates and stay."""
    _bounded_batches(spark)
    ws = Workspace(spark, "near")
    docs = placed(docs, *COLUMNS)
    groups = ws.keep(ngram_jaccard(docs.select(F.col("row_key").alias("doc_id"), "text"), n=5, percent=80).select(F.col("doc_id").alias("row_key"), "component_id"))
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*COLUMNS), "row_key")
    rows = groups.join(several, "component_id").join(docs.select("row_key", rank.alias("rank")), "row_key")
    first = rows.groupBy("component_id").agg(F.min("rank").alias("first")).select("component_id", F.col("first.row_key").alias("first"))
    gone = ws.close(rows.join(first, "component_id").where("row_key <> first").select("row_key"))
    return docs.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone, "row_key", "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts replaced; ``n_chars`` follows a changed text. A null text stays null; repeated rows stay."""
    _bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    rows = docs.withColumn("found", secret_scan(docs, infer_grammars(docs)))
    hit = F.size("found.cuts") > 0
    clean = redacted(F.col("text"), F.col("found.cuts"))
    return rows.select("doc_id", clean.alias("text"), "lang", "source", F.when(hit, F.length(clean).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it (0 to 3 times). Null texts have no words and go; repeated rows are drawn one by one."""
    _bounded_batches(spark)
    docs = placed(docs, *COLUMNS)
    copies = mix_sources(docs, row_key="row_key").where("copies > 0").select("row_key", "copies")
    rows = docs.join(copies.hint("merge"), "row_key")  # both grow with the input: the same join at every size
    return rows.withColumn("copy", F.explode(F.expr("array_repeat(0, cast(copies as int))"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) of every row, and digests of the ids and of the decoded text. A null text has no tokens."""
    _bounded_batches(spark)
    rows = encode_documents(docs.select(*COLUMNS), carry=("doc_id", "lang", "source"))
    return rows.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("secret_scans", secrets), ("mixing", mixing), ("bpe_encoding", tokens)]

#: SQL can express neither the learned automata, the draws nor the byte-pair merges
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with inside(ws, name):
            docs = ws.keep(stage(spark, docs, sf_dir))
        if ws.n > 1:  # the stage's input has been read
            ws.remove(f"{ws.root}/t{ws.n - 1}")
    return ws.close(STAGES[-1][1](spark, docs, sf_dir))
