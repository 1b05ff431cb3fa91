"""Counts over all documents, sent and returned in compact blocks.

Documents are encoded once into batches: a sorted array of the hashes of a batch's distinct words,
and numbers into it. A batch sends its counts as one block per shard of the hash range; a shard
adds what all batches sent and returns to each the totals of its own words, in its own order. So
what is shuffled grows with the distinct words of the batches, and a word that is in every text
comes once per batch.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlegrowth.llm.common import runs


SHARD_KEYS = 1_000_000  # keys that a shard gets on the average at most


def pack(numbers):
    """Whole numbers of 64 bits as compressed bytes, equal bytes of all numbers side by side."""
    flat = np.ascontiguousarray(numbers, dtype="<i8").view(np.uint8).reshape(-1, 8)
    return zlib.compress(flat.T.tobytes(), 1)


def unpack(data):
    flat = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view("<i8").reshape(-1)


def pack_rising(numbers):
    """Like pack, for rising numbers, of which the steps are kept."""
    numbers = np.asarray(numbers)
    return pack(np.diff(numbers.view("<i8"), prepend=np.int64(0)))


def unpack_rising(data):
    return np.cumsum(unpack(data), dtype=np.int64)


def shards_of(spark, keys):
    """How many shards so many keys are dealt to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(keys or 0) // SHARD_KEYS))


def parts_of(spark, count):
    """Partitions for so many shards or batches: each is large enough for a task of its own."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(count or 0))


def shard_bounds(shards):
    """The first hashes of all shards but the first, as unsigned numbers."""
    return np.array([(i << 64) // shards for i in range(1, shards)], dtype=np.uint64)


def _deal(shards):
    def deal(batches):
        bounds = shard_bounds(shards)
        for part in batches:
            rows = []
            for batch, words, counts in zip(*(x.to_pylist() for x in part.columns)):
                words, counts = unpack_rising(words).view(np.uint64), unpack(counts)
                if not len(words):
                    continue
                owner = np.searchsorted(bounds, words, side="right")  # only shards that occur are visited
                for s, e in zip(*(x.tolist() for x in runs(owner))):
                    rows.append((int(owner[s]), batch, pack_rising(words[s:e]), pack(counts[s:e])))
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)], ["shard", "batch", "words", "counts"]
            )

    return deal


def merged(blocks, counts):
    """Sorted distinct keys of several sorted blocks, their summed counts, and for each block the
    places of its keys."""
    keys = np.concatenate(blocks) if blocks else np.empty(0, dtype=np.int64)
    distinct, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(total, place, np.concatenate(counts) if counts else np.empty(0, dtype=np.int64))
    return distinct, total, np.split(place, np.cumsum([len(x) for x in blocks])[:-1])


def _add(group: pd.DataFrame) -> pd.DataFrame:
    blocks = [unpack_rising(x).view(np.uint64) for x in group["words"]]
    distinct, total, places = merged(blocks, [unpack(x) for x in group["counts"]])
    return pd.DataFrame({
        "shard": group["shard"], "batch": group["batch"],
        "ranks": [pack_rising(x) for x in places], "totals": [pack(total[x]) for x in places],
        "types": len(distinct), "seen": int((total > 0).sum()), "sum": int(total.sum()),
    })


def totals(counted, shards):
    """Rows (shard, batch, ranks, totals, types, seen, sum) for counted (batch, words, counts).

    ranks and totals are those of the batch's words of the shard, in order: a word's place among
    the shard's distinct words, and the sum of its counts in all batches. types, seen and sum are
    the shard's numbers of words, of words with a total above 0, and its sum of counts.
    """
    dealt = counted.select("batch", "words", "counts").mapInArrow(
        _deal(shards), "shard int, batch long, words binary, counts binary"
    )
    return dealt.repartition(parts_of(counted.sparkSession, shards), "shard").groupBy("shard").applyInPandas(
        _add, "shard int, batch long, ranks binary, totals binary, types long, seen long, sum long"
    )


def by_batch(rows, *columns, name):
    """One row per batch: its blocks, sorted by shard, as an array `name` of structs."""
    return rows.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("shard", *columns))).alias(name)
    )
