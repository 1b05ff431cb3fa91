"""Fill-in-the-middle transformation by secondary-sort assembly.

Texts are cut into units (a word with the blanks before it, or the blanks at the end) and the units
into a prefix, a middle and a suffix. They leave their document as pieces of some units, keyed by the
document and the place in the output, and are dealt by document and sorted by place; so an output
is read as a stream of pieces, and no task ever holds one whole. From the output's pieces alone,
their markers and the form, the places in the original follow, and the same tasks sort again (without
a shuffle, as documents stay where they are) and stream the restored text.

The key of a document is a hash of its id and text with the task and the row that it came from, so
repeated rows stay apart and are spread.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from candlegrowth.llm.common import slices

UNITS = 2048  # units of a piece
PIECE_BYTES = 1 << 14  # bytes of a piece, where units are long
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix, middle
ORDERS = {"plain": "", "psm": "PSM", "spm": "SPM"}
KEY = ("row_key", "row_number")
PIECE_COLUMNS = (
    "row_key long, row_number long, n long, form string, prefix_chars long, middle_chars long, "
    "place long, mark string, piece binary"
)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def unit_ends(data):
    """Where the units of a text in bytes end."""
    blank = _BLANK[np.frombuffer(data, dtype=np.uint8)]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(data)) if len(data) else np.empty(0, dtype=np.int64)


def characters(data):
    """The code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))


def draws(doc_id, seed):
    """Four numbers of 32 bits that the seed and the id give."""
    text = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(text[8 * i:8 * i + 8], 16) for i in range(4)]


def _plan(doc_id, data, rate, spm, seed):
    """Units, form, and the ends of prefix and middle in bytes."""
    ends = unit_ends(data)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    marked = any(mark.encode() in data for mark in MARKS)
    if not n or marked or h3 % 100 >= rate:
        return ends, "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    places = [0, *(int(ends[i - 1]) if i else 0 for i in (a, b))]
    return ends, "spm" if h4 % 100 < spm else "psm", places[1], places[2]


def _cuts(ends, start, stop):
    """The bounds of the pieces of a stretch: some units, or so many bytes of a long unit."""
    inner = ends[np.searchsorted(ends, start, side="right"):np.searchsorted(ends, stop)]
    bounds = [start, *inner[UNITS - 1::UNITS].tolist(), stop]
    for a, b in zip(bounds, bounds[1:]):
        for s in range(a, b, PIECE_BYTES):
            yield s, min(b, s + PIECE_BYTES)


def pieces(documents, rate=50, spm=80, seed=42):
    """The outputs as pieces: doc_id, row_key, row_number, n, form, prefix_chars, middle_chars, place
    (in the output), mark (that stands before the piece, or NULL), piece (compressed UTF-8).

    `rate` of 100 documents are rearranged, `spm` of 100 of these with the suffix first. NULL texts
    count as empty and a NULL id as the text `None`; empty texts and texts that hold a mark stay plain.
    An empty text has one empty piece. Other columns are not read; a repeated row is a document of
    its own; long texts become many pieces; an empty table gives no pieces.
    """

    def cut(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, name, data in zip(*(part.column(i).to_pylist() for i in range(3))):
                    data = data or b""
                    ends, form, first, second = _plan(name, data, rate, spm, seed)
                    key = xxhash.xxh3_64_intdigest(data, seed=xxhash.xxh32_intdigest(str(name)))
                    key, number = key - (1 << 63), number + 1
                    if form == "plain":
                        spans, chars = [(None, 0, len(data))], (None, None)
                    else:
                        parts = {"P": (0, first), "M": (first, second), "S": (second, len(data))}
                        spans = [(f"<{x}>", *parts[x]) for x in ORDERS[form]]
                        chars = characters(data[:first]), characters(data[first:second])
                    place = 0
                    for mark, start, stop in spans:
                        for s, e in list(_cuts(ends, start, stop)) or [(start, start)]:
                            rows.append((doc_id, key, number, len(ends), form, *chars, place, mark,
                                         zlib.compress(data[s:e], 1)))
                            place, mark = place + 1, None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, field.type) for x, field in zip(zip(*rows), kinds)], schema=kinds
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    kinds = _arrow(documents)
    return documents.select(
        "doc_id", F.col("doc_id").cast("string").alias("name"),
        F.col("text").cast("string").cast("binary").alias("text"),
    ).mapInArrow(cut, f"doc_id {kind}, {PIECE_COLUMNS}")


def _arrow(documents):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(
        StructType([documents.schema["doc_id"]] + StructType.fromDDL(PIECE_COLUMNS).fields)
    )


def in_order(rows):
    """The pieces dealt by document, each task's sorted by document and place."""
    return rows.repartition(*KEY).sortWithinPartitions(*KEY, "place")


def outputs(rows):
    """The outputs as text, put together by document: doc_id, n, form, prefix_chars, middle_chars,
    output. A text stands whole in its row, as in the documents."""

    def put(batches):
        held, parts = None, []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["place"] == 0:
                    done.append((held, parts))
                    held, parts = row, []
                parts.append((row["mark"] or "").encode() + zlib.decompress(row["piece"]))
            yield from filled(done)
        yield from filled([(held, parts)])

    def filled(done):
        found = [{k: row[k] for k in kinds.names[:-1]} | {"output": b"".join(parts).decode()}
                 for row, parts in done if row is not None]
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=kinds)

    wanted = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([rows.schema[x] for x in wanted] + [StructField("output", StringType())])
    kinds = to_arrow_schema(schema)
    return in_order(rows).mapInArrow(put, schema)


def restored(rows):
    """The rows of `outputs` with a column `restored`, the text rebuilt from `output` and `form`."""
    part = F.split("output", "<[PSM]>")
    return rows.withColumn(
        "restored",
        F.when(F.col("form") == "psm", F.concat(part[1], part[3], part[2]))
        .when(F.col("form") == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(F.col("output")),
    )


def _read_outputs(batches):
    """Digests the outputs as they stream by, and gives each piece its place in the original.

    Only marks and form tell where a piece belongs. The first piece in the original order, also of an
    empty text, carries the digest of the output, which is known at its end; so it goes as a row of
    its own before all pieces.
    """
    digest, last = None, None

    def closing():
        return {**last, "place": -1, "mark": digest.hexdigest(), "piece": None}

    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["place"] == 0:
                if last is not None:
                    rows.append(closing())
                digest, at = hashlib.sha256(), 0
            last = row
            if row["mark"]:
                digest.update(row["mark"].encode())
                at = {"<P>": 0, "<M>": 1, "<S>": 2}[row["mark"]] << 40
            digest.update(zlib.decompress(row["piece"]))
            rows.append({**row, "place": at, "mark": None})
            at += 1
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)
    if last is not None:
        yield pa.RecordBatch.from_pylist([closing()], schema=batch.schema)


def _read_originals(batches):
    """Digests the restored texts; the row before a text's pieces has the digest of its output."""
    digest, head, names = None, None, None

    def closed():
        return {**{k: head[k] for k in ("doc_id", "n", "form", "prefix_chars", "middle_chars")},
                "output_sha256": head["mark"], "restored_sha256": digest.hexdigest()}

    for batch in batches:
        if names is None:
            kept = [batch.schema.field(k) for k in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            names = pa.schema(kept + [("output_sha256", pa.string()), ("restored_sha256", pa.string())])
        rows = []
        for row in batch.to_pylist():
            if row["place"] == -1:
                if head is not None:
                    rows.append(closed())
                head, digest = row, hashlib.sha256()
            else:
                digest.update(zlib.decompress(row["piece"]))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=names)
    if head is not None:
        yield pa.RecordBatch.from_pylist([closed()], schema=names)


def digests(rows):
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256 and
    restored_sha256, of the output and of the text that is restored from its pieces."""
    read = in_order(rows).mapInArrow(_read_outputs, rows.schema)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return read.sortWithinPartitions(*KEY, "place").mapInArrow(
        _read_originals,
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, "
        "output_sha256 string, restored_sha256 string",
    )


def op12_fill_in_middle(spark, sf_dir):
    """Half of all documents rearranged, four fifths of these with the suffix first."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(pieces(documents))


OP12_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
    [('0x' || substr(h, 1, 8))::BIGINT, ('0x' || substr(h, 9, 8))::BIGINT,
     ('0x' || substr(h, 17, 8))::BIGINT, ('0x' || substr(h, 25, 8))::BIGINT] AS hs
  FROM hashed
), formed AS (
  SELECT doc_id, text, units, n,
    least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR hs[3] % 100 >= 50 THEN 'plain'
         WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT doc_id, text, n, form,
    coalesce(array_to_string(units[1:a], ''), '') AS prefix,
    coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
    coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM formed
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
