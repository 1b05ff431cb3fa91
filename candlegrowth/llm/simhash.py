"""SimHash near-duplicates with anchor points: fingerprints meet at the words of a covering code.

The 64 bits hold two parts of 31 bits (bits 0-30 and 31-61). Two fingerprints that differ in at
most 3 bits differ in at most one bit of one part. The anchors of a part are the words of the
perfect Hamming code of length 31, whose covering radius is 1: each 31-bit value lies within one
bit of exactly one anchor, its home. A fingerprint goes to every anchor within the covering radius
plus the part's threshold, and at each anchor those at home are compared with all that came. A
bucket is cut further by the bits outside the part: of threshold + 1 pieces one must be equal.
"""

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from candlegrowth.llm.common import components, free_names, forest, runs, stored, text_bytes, whole_runs, word_chunks

PART = 31
PART_MASK = (1 << PART) - 1
SEED = 42
#: Bits i of a part whose position i + 1 has bit j set, for the five checks of the Hamming code.
CHECKS = [sum(1 << i for i in range(PART) if (i + 1) >> j & 1) for j in range(5)]
SMALL_RUN = 64


def simhash(data, width=3):
    """The 64-bit fingerprint of a text given in bytes: bits set in over half of the hashes of its
    shingles of `width` words, A-Z lower-cased. Without words it is zero."""
    if data is None:
        return 0
    counts, total, held = np.zeros(64, dtype=np.int64), 0, []
    for words in word_chunks(data.lower()):
        words = held + words
        if len(words) >= width:
            counts, total = _add(counts, total, zip(*(words[i:] for i in range(width))))
        held = words[-(width - 1):] if width > 1 else []
    if not total:
        if not held:
            return 0
        counts, total = _add(counts, total, [held])
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<i8")[0])


def _add(counts, total, shingles):
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), dtype="<u8"
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return counts + bits.sum(axis=0, dtype=np.int64), total + len(hashes)


def _fingerprint_udf(width):
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, width) for x in texts], dtype="int64")

    return fingerprint


def fingerprints(documents, id_column="doc_id", text_column="text", width=3):
    """(doc_id, text_key, fp) of each row; only the two named columns are read.

    text_key tells rows of one id apart that have different texts.
    """
    return documents.select(
        F.col(id_column).alias("doc_id"),
        F.xxhash64(F.col(text_column)).alias("text_key"),
        _fingerprint_udf(width)(text_bytes(text_column)).alias("fp"),
    )


def _anchored(prints, threshold):
    """(key, fp, home) of each distinct fingerprint: one row per anchor in reach and piece."""
    fp = F.col("fp")
    low, high = fp.bitwiseAND(PART_MASK), F.shiftrightunsigned(fp, PART).bitwiseAND(PART_MASK)
    rest_low = F.shiftrightunsigned(fp, PART)
    rest_high = low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 2 * PART), PART))
    pieces = threshold + 1
    width = -(-(64 - PART) // pieces)
    sides = F.array(*[
        F.struct(
            F.lit(side).alias("side"), F.lit(piece).alias("piece"), part.alias("part"),
            F.shiftrightunsigned(rest, piece * width).bitwiseAND((1 << width) - 1).alias("same"),
        )
        for side, (part, rest) in enumerate(((low, rest_low), (high, rest_high)))
        for piece in range(pieces)
    ])
    at = prints.select("fp", F.explode(sides).alias("at")).select("fp", "at.*")
    syndrome = F.lit(0)
    for j, check in enumerate(CHECKS):
        odd = F.bit_count(F.col("part").bitwiseAND(check)).bitwiseAND(1)
        syndrome = syndrome.bitwiseOR(F.shiftleft(odd, j))

    def anchor(flip):
        """The anchor of the part with bit flip - 1 turned (0: none)."""
        fix = F.col("syndrome").bitwiseXOR(flip)
        one = F.lit(1).cast("long")
        turned = F.when(flip == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", one, flip - 1))
        mended = F.when(fix == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", one, fix - 1))
        return F.col("part").bitwiseXOR(turned).bitwiseXOR(mended)

    reach = threshold // 2  # differences in the part
    flips = F.array(*[F.lit(i) for i in range(PART + 1 if reach else 1)])
    at = at.withColumn("syndrome", syndrome.cast("int")).withColumn("own", anchor(F.lit(0)))
    return (
        at.withColumn("anchor", F.explode(F.array_distinct(F.transform(flips, anchor))))
        .select(
            F.xxhash64("side", "piece", "same", "anchor").alias("key"), "fp",
            (F.col("anchor") == F.col("own")).alias("home"),
        )
    )


def _near(keys, prints, home, threshold):
    """Pairs of unlike fingerprints within the threshold among rows sorted by key, as an array."""
    found = []
    start, end = runs(keys)
    length = end - start
    large = length > SMALL_RUN
    for s, e in zip(start[large], end[large]):
        found.append(_near_in_run(prints[s:e], home[s:e], threshold))
    alive = np.flatnonzero(np.repeat((length > 1) & ~large, length))
    for step in range(1, SMALL_RUN):
        alive = alive[alive + step < len(keys)]
        alive = alive[keys[alive] == keys[alive + step]]
        if not len(alive):
            break
        a, b = prints[alive], prints[alive + step]
        near = (np.bitwise_count((a ^ b).view(np.uint64)) <= threshold) & (home[alive] | home[alive + step])
        found.append(np.stack([a[near], b[near]], axis=1))
    pairs = np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)
    return pairs[pairs[:, 0] != pairs[:, 1]]


def _near_in_run(prints, home, threshold):
    """Compares those at home with all, or looks up all values within the threshold of each if
    these are fewer; so a run of any length costs its length times a constant at most."""
    own, every = np.unique(prints[home]), np.unique(prints)
    masks = [sum(1 << b for b in bits) for k in range(1, threshold + 1) for bits in combinations(range(64), k)]
    found = []
    if len(own) <= len(masks):
        for s in range(0, len(own), 256):
            block = own[s:s + 256]
            a, b = np.nonzero(np.bitwise_count((block[:, None] ^ every[None, :]).view(np.uint64)) <= threshold)
            found.append(np.stack([block[a], every[b]], axis=1))
    else:
        for mask in np.array(masks, dtype=np.uint64).view(np.int64):
            other = own ^ mask
            hit = every[np.minimum(np.searchsorted(every, other), len(every) - 1)] == other
            found.append(np.stack([own[hit], other[hit]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


def _linker(threshold):
    def link(batches):
        for key, prints, home in whole_runs(batches):
            tree = forest(np.unique(_near(key, prints, home, threshold), axis=0))
            if len(tree):
                yield pa.RecordBatch.from_arrays([pa.array(tree[:, 0]), pa.array(tree[:, 1])], ["a", "b"])

    return link


def links(prints, threshold=2):
    """Edges (a, b) that connect all fingerprints of `prints` (column fp, distinct) which differ in
    `threshold` bits or fewer, directly or over others; not every such pair is listed."""
    if not 0 <= threshold <= 3:
        raise ValueError("the threshold must be 0 to 3 bits")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        _anchored(prints, threshold)
        .repartition(parts, "key").sortWithinPartitions("key")
        .mapInArrow(_linker(threshold), "a long, b long")
    )


def near_duplicates(documents, id_column="doc_id", text_column="text", width=3, threshold=2):
    """One row per document: doc_id, text_key, fp (long), component_id, keep.

    Copies share a fingerprint and are one node. component_id is the smallest doc_id that can be
    reached over links of `threshold` differing bits or fewer; NULL ids count only where there is
    no other. keep is true for the documents of that id in each component. Texts that are NULL or
    without words have fingerprint zero and are linked like any other. Repeated rows are rows of
    their own with equal results; an empty table gives no rows; other columns are never read.
    """
    docs = stored(fingerprints(documents, id_column, text_column, width), "simhash")
    return labelled(docs, components(links(docs.select("fp").distinct(), threshold)))


def labelled(docs, labels):
    """The documents (doc_id, text_key, fp) with root, component_id and keep by the labels (node,
    root) of their fingerprints."""
    prints = docs.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = stored(labels.withColumnRenamed("node", "fp").join(prints, "fp"), "simhash-linked")
    best = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = prints.join(linked.join(best, "root").select("fp", "root", "component_id"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # stored, so that the last join stands alone and Spark can split a fingerprint with many documents
    return docs.join(stored(named, "simhash-named"), "fp").withColumn(
        "keep", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_first(documents, id_column="doc_id", text_column="text", width=3, threshold=2):
    """The documents, all columns, without those that near-duplicate one of a smaller id.

    Of rows of one component that share the smallest id one stays. Texts that are NULL or without
    words are one group; an empty table gives none; columns of any other name stay.
    """
    found = near_duplicates(documents, id_column, text_column, width, threshold)
    return kept(documents, found, id_column, text_column)


def kept(documents, found, id_column="doc_id", text_column="text"):
    """The documents, all columns, that are the first of their component in `found`."""
    kept_id, first_key, text_key = free_names(documents, 3)
    first = (
        found.where("keep").groupBy("root", "doc_id").agg(F.min("text_key").alias("text_key"))
        .select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(first_key))
    )
    keyed = documents.withColumn(text_key, F.xxhash64(F.col(text_column)))
    same = (keyed[id_column].eqNullSafe(first[kept_id])) & (keyed[text_key] == first[first_key])
    return keyed.join(first, same, "left_semi").dropDuplicates([id_column, text_key]).drop(text_key)


def op6_simhash(spark, folder):
    """Fingerprints of all documents and their components at 2 differing bits."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    found = near_duplicates(documents)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
