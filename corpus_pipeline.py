"""From raw documents to a training mix: five stages, each over all that the one before kept.

All stages but the last return the columns of their input, whatever these are named, and give an empty
table for an empty one.
"""

from candlegrowth.llm import decontaminate, langid, lines, mixing, simhash

BATCH_ROWS = "2000"  # whole texts go to Python in batches of so many rows


def _small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark, docs, sf_dir):
    """Drops documents without a letter and longer texts that are like no language.

    NULL and empty texts go; where no document names a language, all texts with a letter stay.
    """
    _small_batches(spark)
    return langid.keep_identified(docs)


def dedup_lines(spark, docs, sf_dir):
    """Drops lines that repeat an earlier line, and documents of which nothing is left.

    NULL and empty texts stay; repeated rows count as one document.
    """
    _small_batches(spark)
    return lines.keep_unrepeated(docs)


def dedup_documents(spark, docs, sf_dir):
    """Keeps the document of the smallest id of each group whose fingerprints are linked over steps
    of 2 bits or fewer; of repeated rows one stays, and texts without words are one group."""
    _small_batches(spark)
    return simhash.keep_first(docs)


def decontaminate_documents(spark, docs, sf_dir):
    """Drops documents that hold a benchmark item, with a fifth of its words edited at most.

    NULL and empty texts hold none; an empty benchmark drops none.
    """
    _small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark, docs, sf_dir):
    """The words that the mix takes of each document: doc_id, source, size, source_size, target, taken.

    NULL is a source like any other; a NULL or empty text has no words to take.
    """
    return mixing.taken(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("mixing", mix_sources),
]

#: SQL can't express the profiles, the walks and the keyed permutations; the tests compare with
#: brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


QUERIES = {"pipeline": run}
SQL = {}
