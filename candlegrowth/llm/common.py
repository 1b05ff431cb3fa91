"""Helpers of the training-data operators: words, row keys, stored steps, connected components."""

import ctypes
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from candlegrowth.session import scratch_path

#: A word is a run of anything but these: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
_GAP = re.compile(rb"[\x20\x09-\x0D]")

PIECE = 1 << 20  # bytes of one text that are split into words at a time


def word_chunks(data, size=PIECE):
    """The words of a text in bytes, as lists of the words of about `size` bytes each.

    bytes.split() cuts at just the six blanks of WORD. Chunks end between words, so a very long
    text never stands in memory as one list.
    """
    start, end = 0, len(data)
    while start < end:
        stop = start + size
        if stop < end:
            gap = _GAP.search(data, stop)
            stop = gap.start() if gap else end
        else:
            stop = end
        words = data[start:stop].split()
        start = stop
        if words:
            yield words


SLICE = 8 << 20  # bytes of texts that stand as Python objects at a time


def slices(batch, column, size=SLICE):
    """An Arrow batch in parts of about `size` bytes of a text or binary column, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def release():
    """Gives back the memory of freed batches and arrays, which Arrow and the C library otherwise keep
    in a worker from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def free_names(rows, count):
    """So many column names that the rows do not have."""
    taken, found, number = {x.lower() for x in rows.columns}, [], 0
    while len(found) < count:
        if f"_own_{number}" not in taken:
            found.append(f"_own_{number}")
        number += 1
    return found


def text_bytes(column="text"):
    """The text as UTF-8 bytes; NULL stays NULL."""
    return F.col(column).cast("string").cast("binary")


def squeezed(data):
    """Bytes compressed one by one, for texts that are dealt: blocks of a shuffle compress less."""

    @F.pandas_udf("binary")
    def squeeze(texts: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else zlib.compress(x, 1) for x in texts])

    return squeeze(data)


def stored(df, name):
    """The rows written once to the shared folder and read back, so that they are made only once.

    The files outlive lost executors, unlike cached or locally checkpointed rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges):
    """Connected components of an edge list with columns a and b.

    Returns (node, root): each node of an edge with the smallest node of its component; roots are
    listed too. Alternates large-star and small-star steps, each a minimum per node (combined
    before the shuffle) joined back, until the edges no longer change; every round is stored.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    sign = _signature(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.withColumnRenamed("m", "v")).distinct()
        )
        now = stored(small, "edges")
        after = _signature(now)
        if after == sign:
            break
        sign = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _signature(edges):
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def forest(pairs):
    """Of an array of pairs, (node, root) rows that connect the same nodes, one row per node at most."""
    parent = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs.tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    return np.array([(x, root(x)) for x in nodes if root(x) != x], dtype=pairs.dtype).reshape(-1, 2)


def runs(keys):
    """Start and end of each run of equal neighbours."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])


def whole_runs(batches, keys=1):
    """Arrow batches of rows sorted by their first `keys` columns, as lists of arrays that never cut
    a run of equal keys. At most one run is held besides a batch."""
    held = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if not len(rows[0]):
            continue
        held = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
        last = held[0] == held[0][-1]
        for column in held[1:keys]:
            last &= column == column[-1]
        cut = len(last) - int(last.sum())
        if cut:
            yield [x[:cut] for x in held]
            held = [x[cut:] for x in held]
    if held is not None:
        yield held


class WordHashes(dict):
    """The hash of each word, kept for words that come again; emptied when it grows too large."""

    MOST = 400_000

    def __missing__(self, word):
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words):
        if len(self) > self.MOST:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(h):
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hash(hashes, starts, length, factor):
    """A 64-bit hash of the `length` word hashes from each start on."""
    total = np.zeros(len(starts), dtype=np.uint64)
    for k in range(length):
        total = total * np.uint64(factor) + hashes[starts + k]
    return mixed(total)
