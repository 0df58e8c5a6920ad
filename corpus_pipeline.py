"""Documents made ready for training, in stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import bpe, decontaminate, languages, pii, simhash
from tallyworks.llm.common import documents, text_settings
from tallyworks.llm.queries import WORD_BPE
from tallyworks.session import work_path

# Whole texts on the way between Spark and Python, in one batch; rows that a scan decodes at
# once; a row group of what a stage hands on. All are held once for each running task.
BATCH_BYTES = 2 << 20
SCAN_ROWS = 512
ROW_GROUP_BYTES = 16 << 20


def _settings(spark: SparkSession) -> None:
    """Settings of the operators, with less held at once: five of them share a process."""
    text_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


def _kept(docs: DataFrame) -> DataFrame:
    """A stage's result, written to the shared folder and read again."""
    spark = docs.sparkSession
    path = work_path(spark, "stage")
    docs.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until ``docs`` has no such column, in any case of its letters."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter, and those that look like no learned language.

    NULL and empty texts have no letter and go; of two languages that fit alike the first in
    the alphabet counts. With no learned language all go. Rows that repeat fare alike.
    """
    _settings(spark)
    found = languages.identify(docs, languages.learn(docs))
    foreign = (F.col("score") < languages.LEAST_COSINE) & (
        F.length("text") >= languages.LEAST_CHARS
    )
    known = (F.col("lang_pred") != languages.UNDETERMINED) & ~foreign
    return found.where(known).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: the smallest id, of equal ids the first row.

    Rows are told apart by their place in the scan, so rows that repeat are one group, and rows
    with one id but different texts are not. A NULL id comes after all others.
    """
    _settings(spark)
    number = _unused(docs, "row")
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(number).alias("row"))
    keyed = numbered.select(key.alias("key"), "text")
    found = simhash.near_duplicates(keyed, id_col="key", width=3, max_bits=2)
    kept = found.where("id.row = component.row").select(F.col("id.row").alias(number))
    return numbered.join(kept, number, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that give away an item of the benchmark.

    NULL and empty texts hold no item and stay; so do all where the benchmark is empty. Rows
    that repeat are judged alike, whatever their ids.
    """
    _settings(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contaminated(docs, benchmark).select("row").distinct()
    number = _unused(docs, "row")
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    return numbered.join(
        found.withColumnRenamed("row", number), number, "left_anti"
    ).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; NULL and empty texts stay as they are.

    ``n_chars`` becomes the length of the new text, NULL where that is NULL.
    """
    _settings(spark)
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and the texts as the ids decode: none, and "", for NULL and empty."""
    _settings(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode(rows, WORD_BPE, decoded="decoded").select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"
    )


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("BPE encoding and decoding", encode),
]

# No stage before the last can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written and read again."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = _kept(docs)
    return docs
