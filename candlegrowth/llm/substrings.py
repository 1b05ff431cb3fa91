"""Removal of passages that repeat anywhere in the corpus, over difference-cover anchors.

A difference cover of period v has, for any two positions i and j, a shift below v that brings both
onto cover positions. So two equal windows of `window` words share an equal anchor: the hash of the
window - v + 1 words at a cover position, at the same place in both. Only cover positions are
hashed and dealt; where an anchor is repeated, it is extended to the whole windows around it, and
these are compared by a hash of all their words. No pairs are formed: a hash is counted.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlegrowth.llm.common import (
    WordHashes, mixed, squeezed, text_bytes, whole_runs, window_hash, word_chunks,
)

WINDOW = 35
#: Difference covers by period; every remainder is a difference of two of them.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}
LEAST_ANCHOR = 10
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def period_of(window):
    """The longest period that leaves anchors of LEAST_ANCHOR words or more; else 1."""
    return max(v for v in COVERS if v == 1 or window - v + 1 >= LEAST_ANCHOR)


def _hashes(data, cache):
    parts = [cache.of(words) for words in word_chunks(data)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _told(hashes, keys, places, step):
    """What a task sends of its (hash, key, place) rows, in document order, hash being one or two
    columns.

    Places of a hash that comes more than once in the task are known to repeat: they go out as
    ranges (n = -length) without gaps of over `step`, dealt by their document, and one row with
    n = 2 tells of the hash. So a hash has one row per task at most, however often it comes.
    """
    order = np.lexsort(hashes[::-1])
    new = np.ones(len(keys), dtype=bool)
    new[1:] = np.any([h[order[1:]] != h[order[:-1]] for h in hashes], axis=0)
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(keys)))
    known = np.zeros(len(keys), dtype=bool)
    known[order] = np.repeat(length > 1, length)
    once, often, at = np.flatnonzero(~known), order[start[length > 1]], np.flatnonzero(known)
    apart = (np.diff(at) != 1) | (keys[at[1:]] != keys[at[:-1]]) | (np.diff(places[at]) > step)
    cut = np.flatnonzero(apart) + 1
    first = at[np.concatenate([[0], cut]).astype(int)] if len(at) else at
    last = at[np.concatenate([cut - 1, [len(at) - 1]]).astype(int)] if len(at) else at
    zero = np.zeros(len(often), dtype=np.int64)
    columns = [
        np.concatenate([h[once], h[often], keys[first].astype(h.dtype) if i == 0 else zero[:0].astype(h.dtype),
                        np.zeros(len(first) * (i > 0), dtype=h.dtype)])
        for i, h in enumerate(hashes)
    ]
    columns.append(np.concatenate([keys[once], zero, keys[first]]))
    columns.append(np.concatenate([places[once], zero, places[first]]).astype("i4"))
    columns.append(np.concatenate([
        np.ones(len(once)), np.full(len(often), 2), places[first] - places[last] - 1
    ]).astype("i4"))
    names = [f"hash{i}" for i in range(len(hashes))] + ["key", "place", "n"]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


def _spans(packed):
    packed = np.array(packed, dtype=np.int64)
    return packed >> 32, packed & 0xFFFFFFFF


def _unzipped(data):
    return b"" if data is None else zlib.decompress(data)


def _anchors(window):
    period = period_of(window)
    length = window - period + 1
    cover = np.zeros(period, dtype=bool)
    cover[list(COVERS[period])] = True

    def anchors(batches):
        cache = WordHashes()
        for batch in batches:
            keys, found, places = [], [], []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = _hashes(data or b"", cache)
                if len(hashes) >= window:
                    at = np.flatnonzero(np.resize(cover, len(hashes) - length + 1))
                    found.append(window_hash(hashes, at, length, FACTORS[0]).view("<i8"))
                    places.append(at)
                    keys.append(np.full(len(at), key, dtype=np.int64))
            if found:
                yield _told([np.concatenate(found)], np.concatenate(keys), np.concatenate(places), period)

    return anchors


def _windows(window):
    """Hashes of the windows that hold a repeated anchor where equal windows would share it."""
    period = period_of(window)

    def windows(batches):
        cache = WordHashes()
        for batch in batches:
            keys, found, other, places = [], [], [], []
            for key, data, at in zip(*(batch.column(n).to_pylist() for n in ("key", "zipped", "spans"))):
                hashes = _hashes(_unzipped(data), cache)
                at, length = _spans(at)
                rise = np.zeros(len(hashes) + 1, dtype=np.int64)
                np.add.at(rise, np.maximum(at - period + 1, 0), 1)
                np.add.at(rise, at + length, -1)
                starts = np.flatnonzero(np.cumsum(rise[:len(hashes) - window + 1]) > 0)
                found.append(window_hash(hashes, starts, window, FACTORS[1]).view("<i8"))
                other.append((window_hash(mixed(hashes), starts, window, FACTORS[2]) >> np.uint64(32)).astype("i4"))
                places.append(starts)
                keys.append(np.full(len(starts), key, dtype=np.int64))
            if found:
                yield _told(
                    [np.concatenate(found), np.concatenate(other)], np.concatenate(keys), np.concatenate(places), 1
                )

    return windows


def _repeated(n_hashes):
    """Of rows sorted by hash, (key, span) of those whose hash comes twice or more; a span is its
    first place and its length in one number."""

    def repeated(batches):
        for *hashes, keys, places, n in whole_runs(batches, n_hashes):
            new = np.ones(len(n), dtype=bool)
            new[1:] = np.any([h[1:] != h[:-1] for h in hashes], axis=0)
            total = np.add.reduceat(np.maximum(n, 0), np.flatnonzero(new))
            often = (total > 1)[np.cumsum(new) - 1]
            out = (n < 0) | (often & (n == 1))
            if out.any():
                span = places[out].astype("i8") << 32 | np.abs(n[out])
                yield pa.RecordBatch.from_arrays([pa.array(keys[out]), pa.array(span)], ["key", "span"])

    return repeated


def _counted(rows, n_hashes):
    """(key, spans) of each document that has repeated places."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"hash{i}" for i in range(n_hashes)]
    return (
        rows.repartition(parts, "hash0").sortWithinPartitions(*names)
        .mapInArrow(_repeated(n_hashes), "key long, span long")
        .groupBy("key").agg(F.collect_list("span").alias("spans"))
    )


def repeated_windows(keyed, window=WINDOW):
    """(key, spans): the word numbers at which a repeated window starts, by document.

    `keyed` has key (long), data (text as bytes) and zipped (the same, compressed).
    """
    anchors = keyed.select("key", "data").mapInArrow(
        _anchors(window), "hash0 long, key long, place int, n int"
    )
    near = keyed.drop("data").join(_counted(anchors, 1), "key")
    windows = near.mapInArrow(_windows(window), "hash0 long, hash1 int, key long, place int, n int")
    return _counted(windows, 2)


def _cutter(window):
    @F.pandas_udf("text string, n_words long, n_removed long")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for data, found in zip(texts, spans):
            kept, before, removed = [], 0, 0
            start, end = _spans([] if found is None else found)
            end = start + end + window - 1
            for words in word_chunks(_unzipped(data)):
                n = len(words)
                near = (end > before) & (start < before + n)
                if near.any():
                    rise = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(rise, np.maximum(start[near] - before, 0), 1)
                    np.add.at(rise, np.minimum(end[near] - before, n), -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(rise[:-1]) == 0).tolist()]
                if words:
                    kept.append(b" ".join(words))
                before, removed = before + n, removed + n - len(words)
            rows.append((b" ".join(kept).decode("utf-8", "replace"), before, removed))
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed"])

    return cut


def remove_repeats(documents, id_column="doc_id", text_column="text", window=WINDOW):
    """(doc_id, text, n_words, n_removed) of each row: its words, joined by one space, without those
    in a window of `window` words whose sequence starts anywhere else too.

    All copies of a repeated passage go; windows are judged on the input. Case and punctuation
    count. A NULL or blank text has no words and gives ''. Repeated rows repeat each other, and all
    their windows go. Rows with one id are told apart by their text. Other columns are not read.
    """
    keyed = documents.select(
        F.xxhash64(F.col(id_column), F.col(text_column)).alias("key"),
        F.col(id_column).alias("doc_id"), text_bytes(text_column).alias("data"),
        squeezed(text_bytes(text_column)).alias("zipped"),
    )
    spans = repeated_windows(keyed, window)
    return keyed.drop("data").join(spans, "key", "left").select(
        "doc_id", _cutter(window)("zipped", "spans").alias("_cut")
    ).select("doc_id", "_cut.*")


def op8_substring_dedup(spark, folder):
    """Words kept of every document without windows of 35 words that repeat."""
    found = remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = f"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS row_id,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), starts AS (
    SELECT row_id, i, sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h
    FROM (SELECT row_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words)
), repeated AS (
    SELECT row_id, i FROM starts WHERE h IN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT row_id, unnest(range(i, i + {WINDOW})) AS i FROM repeated
), kept AS (
    SELECT row_id, string_agg(x, ' ' ORDER BY i) AS text, count(*) AS n
    FROM (SELECT row_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM words)
    ANTI JOIN gone USING (row_id, i)
    GROUP BY row_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (row_id)
"""
