"""I-Match fingerprints: hashes of a text's distinct terms of middling frequency, sorted, for many
randomised subsets of the lexicon.

The lexicon holds the terms whose inverse document frequency lies in a band, counted over all
documents. Each of LEXICONS subsets takes a share 2 ** -level of it by hash; a subset of a level
holds that of the next. A text has the level at which a subset meets few of its terms, so that a
long text with edits keeps some subsets whole just as a short one does. Its fingerprint is the
level and the hashes at DEPTH levels from there (0000: no term); texts are compared at the levels
they share.

Documents are sorted by id over range partitions, so that each meets its follower; the last of a
partition gets the first of the next one in a second, small step. What a fingerprint may need of a
text is kept until the frequencies are known, about as much for a long text as for a short one.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlegrowth.llm.common import WordHashes, mixed, squeezed, stored, text_bytes, word_chunks
from candlegrowth.llm.counting import by_batch, pack, pack_rising, shards_of, totals, unpack, unpack_rising

LEXICONS = 64
DEPTH = 3
LEAST_DOCUMENTS = 2  # documents that hold a term of the lexicon, at least
MOST_SHARE = 0.1  # of all documents, at most
BATCH_DOCUMENTS, BATCH_CHARS = 2000, 20_000_000
SEED = 1
WHOLE = "zz"  # instead of the level, where no term of the lexicon is in reach: all terms count
_SPACES = bytes.maketrans(bytes(c for c in range(33, 127) if not chr(c).isalnum()), b" " * 32)


def terms(data, cache):
    """Sorted hashes of the distinct terms of a text in bytes: words, A-Z lower-cased, ASCII
    punctuation as blanks."""
    found = [np.unique(cache.of(words)) for words in word_chunks(data.lower().translate(_SPACES))]
    return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.uint64)


def edited(text, follower):
    """The text whose last quarter of code points is replaced by as many first ones of the next."""
    cut = len(text) // 4
    return text[:len(text) - cut] + follower[:cut]


def _factors():
    return np.random.default_rng(SEED).integers(1 << 63, size=LEXICONS, dtype=np.uint64) | np.uint64(1)


def _reach(hashes, factors):
    """Level of a text, and the rows (term, subset, number of further levels) it may use."""
    level = min(len(hashes).bit_length(), 40)
    marks = hashes[:, None] * factors[None, :]
    term, subset = np.nonzero(marks <= np.uint64((1 << 64 - level) - 1))
    deep = sum((marks[term, subset] <= np.uint64((1 << 64 - level - i) - 1)).astype(int) for i in range(1, DEPTH))
    return level, hashes[term], (subset * DEPTH + deep).astype(np.int64)


def _encode(pairs, id_type, first_batch):
    """Batches of (id, text, follower); a batch also holds the terms of its last follower."""
    cache, factors = WordHashes(), _factors()

    def emit(number, docs, prints):
        hashes = np.concatenate([p[1] for p in prints])
        own = [doc[3] for doc in docs]
        known = np.unique(np.concatenate([hashes, *own]))
        counts = np.zeros(len(known), dtype=np.int64)
        for x in own:
            counts[np.searchsorted(known, x)] += 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([[d[0] for d in docs]], pa.list_(id_type)),
                pa.array([pack([d[1] for d in docs])]), pa.array([[d[2] for d in docs]], pa.list_(pa.string())),
                pa.array([pack([p[0] for p in prints])]), pa.array([pack([len(p[1]) for p in prints])]),
                pa.array([pack(np.searchsorted(known, hashes))]),
                pa.array([pack(np.concatenate([p[2] for p in prints]))]),
                pa.array([pack([p[3] for p in prints])]),
                pa.array([pack_rising(known)]), pa.array([pack(counts)]), pa.array([len(known)], pa.int64()),
            ],
            ["batch", "ids", "sizes", "shas", "levels", "lengths", "terms", "subsets", "wholes", "words", "counts", "n_words"],
        )

    def print_of(data):
        hashes = terms(data, cache)
        level, term, subset = _reach(hashes, factors)
        whole = int(mixed(mixed(hashes).sum(dtype=np.uint64)[None]).view("<i8")[0])
        return hashes, (level, term, subset, whole)

    number, docs, prints, chars = first_batch, [], [], 0
    follower = None
    for doc_id, text, after in pairs:
        own, print_own = follower if follower else print_of(text.encode("utf-8", "replace"))
        changed = edited(text, after).encode("utf-8", "replace")
        docs.append((doc_id, len(text), hashlib.sha256(changed).hexdigest(), own))
        prints += [print_own, print_of(changed)[1]]
        follower = print_of(after.encode("utf-8", "replace"))
        chars += len(text)
        if len(docs) >= BATCH_DOCUMENTS or chars >= BATCH_CHARS:
            yield emit(number, docs, prints + [follower[1]])
            number, docs, prints, chars = number + 1, [], [], 0
    if docs:
        yield emit(number, docs, prints + [follower[1]])


_BATCH = (
    "batch long, ids array<{id}>, sizes binary, shas array<string>, levels binary, lengths binary, terms binary, "
    "subsets binary, wholes binary, words binary, counts binary, n_words long"
)
_EDGE = ", part int, first binary, last_id {id}, last binary"
_EDGE_NAMES = ["part", "first", "last_id", "last"]


def _text(data):
    return "" if data is None else zlib.decompress(data).decode("utf-8")


def _partition(id_type):
    """Batches of a sorted partition without its last document, then a row with its first text and
    its last document."""

    def partition(batches):
        part = TaskContext.get().partitionId()
        ends = []

        def pairs():
            before = None
            for batch in batches:
                for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    text = _text(data)
                    if before is None:
                        ends.append(data)
                    else:
                        yield before[0], before[1], text
                    before = (doc_id, text, data)
            if before is not None:
                ends.extend(before[::2])

        kinds = [pa.int32(), pa.binary(), id_type, pa.binary()]
        names = None
        for found in _encode(pairs(), id_type, part << 32):
            names = found.schema
            blank = [pa.nulls(1, kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([*found.columns, *blank], [*found.schema.names, *_EDGE_NAMES])
        if ends:
            schema = names or _schema(id_type)
            none = [pa.nulls(1, field.type) for field in schema]
            edge = [pa.array([x], kind) for x, kind in zip([part, *ends], kinds)]
            yield pa.RecordBatch.from_arrays([*none, *edge], [*schema.names, *_EDGE_NAMES])

    return partition


def _schema(id_type):
    return next(_encode([(None, "", "")], id_type, 0)).schema


def _edges(id_type):
    def edges(batches):
        for batch in batches:
            for part, doc_id, last, after in zip(*(x.to_pylist() for x in batch.columns)):
                yield from _encode([(doc_id, _text(last), _text(after))], id_type, -1 - part)

    return edges


def _prints(row, documents):
    """The fingerprints of a batch's texts: level tag and LEXICONS * DEPTH hashes of 16 bits each."""
    total = np.concatenate([unpack(b["totals"]) for b in row["dfs"] or []] or [np.empty(0, np.int64)])
    words = unpack_rising(row["words"]).view(np.uint64)
    levels, lengths, wholes = unpack(row["levels"]), unpack(row["lengths"]), unpack(row["wholes"])
    term, subset = unpack(row["terms"]), unpack(row["subsets"])
    text = np.repeat(np.arange(len(levels)), lengths)
    good = (total[term] >= LEAST_DOCUMENTS) & (total[term] <= max(MOST_SHARE * documents, LEAST_DOCUMENTS))
    out = np.zeros((len(levels), DEPTH * LEXICONS), dtype=np.uint64)
    for depth in range(DEPTH):
        use = np.flatnonzero(good & (subset % DEPTH >= depth))
        cell = text[use] * (DEPTH * LEXICONS) + depth * LEXICONS + subset[use] // DEPTH
        order = np.lexsort((words[term[use]], cell))  # the distinct terms of a subset, sorted
        cell, hashes = cell[order], words[term[use]][order]
        if not len(cell):
            continue
        start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        place = np.arange(len(cell)) - np.repeat(start, np.diff(np.append(start, len(cell))))
        sums = np.add.reduceat(mixed(hashes + mixed(place.astype(np.uint64) + np.uint64(1))), start)
        out.ravel()[cell[start]] = np.maximum(mixed(sums) >> np.uint64(48), np.uint64(1))
    none = ~out.any(axis=1)
    tags = np.where(none, -1, levels)
    out[none] = (mixed(wholes[none].view(np.uint64)) >> np.uint64(48))[:, None]
    out[none, :4] = (wholes[none].view(np.uint64)[:, None] >> np.array([0, 16, 32, 48], dtype=np.uint64)) & np.uint64(0xFFFF)
    return tags, out.astype(np.uint16)


def fingerprint_text(tag, hashes):
    return (WHOLE if tag < 0 else f"{tag:02d}") + hashes.astype(">u2").tobytes().hex()


def likeness(tag, hashes, other_tag, other):
    """The share of equal hashes among those of either text that have a term, at the levels the two
    share; 1 for equal fingerprints, 0 without a common level."""
    if tag == other_tag and (hashes == other).all():
        return 1.0
    gap = abs(tag - other_tag)
    if tag < 0 or other_tag < 0 or gap >= DEPTH:
        return 0.0
    low, high = (hashes, other) if tag < other_tag else (other, hashes)
    hashes, other = low[gap * LEXICONS:], high[:(DEPTH - gap) * LEXICONS]
    either = (hashes > 0) | (other > 0)
    return float(((hashes == other) & either).sum() / either.sum()) if either.any() else 0.0


def _finish(documents, id_type):
    def finish(batches):
        for part in batches:
            for values in zip(*(x.to_pylist() for x in part.columns)):
                row = dict(zip(part.schema.names, values))
                tags, prints = _prints(row, documents)
                n = len(row["ids"])
                own, changed = range(0, 2 * n, 2), range(1, 2 * n, 2)
                after = [*range(2, 2 * n, 2), 2 * n]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], id_type), pa.array(unpack(row["sizes"])), pa.array(row["shas"], pa.string()),
                        pa.array([fingerprint_text(tags[i], prints[i]) for i in own]),
                        pa.array([fingerprint_text(tags[i], prints[i]) for i in changed]),
                        *(pa.array([likeness(tags[i], prints[i], tags[j], prints[j]) for i, j in zip(own, other)])
                          for other in (changed, after)),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return finish


def fingerprints(documents, id_column="doc_id", text_column="text"):
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of
    each row, the next one being that of the next larger id, and of the last the first.

    NULL ids come last; rows of one id follow each other by text hash. A NULL text is empty. Equal
    texts have equal fingerprints; a text without terms in its reach of the lexicon, as an empty
    one, is told by all its terms. An empty table gives no rows. Other columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_key"),
        squeezed(text_bytes(text_column)).alias("data"),
    )
    id_type, name = to_arrow_type(rows.schema["doc_id"].dataType), rows.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_key")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "data")
    schema = _BATCH.format(id=name)
    first = stored(ranged.mapInArrow(_partition(id_type), schema + _EDGE.format(id=name)), "imatch-texts")
    edges = first.where("part is not null").select(*_EDGE_NAMES)
    # one number per partition, to find the next one that has rows
    turn = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = edges.select(
        "part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(turn)).alias("next")
    )
    lasts = (
        edges.join(after, "part")
        .join(edges.select(F.col("part").alias("next"), F.col("first").alias("after")), "next")
        .select("part", "last_id", "last", "after").mapInArrow(_edges(id_type), schema)
    )
    batches = first.where("part is null").drop(*_EDGE_NAMES).unionByName(stored(lasts, "imatch-lasts"))
    size = batches.agg(F.sum("n_words"), F.sum(F.size("ids"))).first()
    found = totals(batches, shards_of(spark, size[0]))
    joined = batches.drop("counts", "n_words").join(by_batch(found, "totals", name="dfs"), "batch", "left")
    return joined.mapInArrow(
        _finish(size[1] or 0, id_type),
        f"doc_id {name}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op10_imatch(spark, folder):
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints(spark.read.parquet(f"{folder}/documents.parquet"))
