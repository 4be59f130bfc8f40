"""From raw documents to token files: each stage works on all that its predecessor kept.

Every stage takes any number of rows, none included, and returns the columns it got, but for the last. Other columns
travel along, whatever their names. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reqmart.llm import decontaminate, mixing, odd_sketch_dedup, token_files
from reqmart.llm.queries import LEAST_TAIL, graded, table, tokenizer
from reqmart.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that are unlikely to have the best grade.

    Null and empty texts have no token that tells against them: they are graded like the best and stay, as do all rows
    where no label has a grade but the best. Equal texts are graded alike, also where ids are null or repeat.
    """
    return graded(docs, table(spark, sf_dir, "labels")).where(F.col("tail") >= LEAST_TAIL).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies: the smallest id's, null last, then the smallest text hash.

    Null, empty and wordless texts are no copies of each other; such rows stay once per id and text. Of rows that are
    equal in id and text one stays.
    """
    return odd_sketch_dedup.deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that contain a benchmark item.

    Null and empty texts contain nothing. Rows of one id, or of none, are judged by their own texts; repeated ones go or
    stay together. Without items all stay.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources asks for.

    A null source is one of its own. Texts without words weigh nothing: they are taken as their neighbours in size are,
    and not at all if their source has no words. Documents of one size go by id, null first, then by a hash of the text.
    """
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they hold: doc_id, start, n_tokens, ids_crc32, null ids first.

    A null or empty text gives the end id alone. Repeated rows are documents of their own, ordered by their texts' hash.
    """
    return token_files.token_table(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: SQL can express neither the fitted classifier nor the tokenizer; a brute-force version tests the run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
