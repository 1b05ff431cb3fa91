"""Removal of repeated and nearly repeated lines, by a segment-partition edit join.

Unlike lines are compared once. The threshold of the join is a number of edits, as the segments follow
from it: two lines are alike within MOST_EDITS edits, and within fewer if the shorter line has not
EDIT_CHARS characters for each (`edits_of`). Larger thresholds are asked for with `most`; a line is
probed with about most^3 substrings, so the default is small. Cut the shorter one into k + 1 segments:
one of them stands unchanged in the longer line, shifted by no more than the edits before and after
it allow. So every line is indexed by its segments, and probed with the substrings of its own that may
equal a segment of a line of each length in reach. Lines that meet are verified by a banded
bit-parallel edit distance.

A segment that very many lines share is refined: the lines are matched again by what remains of
them without it, under the key of the segment, and so on. Lines that still share very many keys are
dealt in pairs of blocks, verified there, and only pairs that connect others are kept, at most one a
line and pair of blocks.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from candlegrowth.llm.common import SLICE, components, free_names, release, runs, slices, stored, whole_runs

EDIT_CHARS = 20
MOST_EDITS = 2
HOT = 4096  # lines under one key that are compared directly
LEVELS = 3
BLOCK = 4096  # lines of a block, where a key stays hot
SALTS = 64  # parts in which a hot key's lines meet its number of blocks
MOST_SENT = 1_000_000  # numbers of lines, 8 MB


def edits_of(n, edit_chars=EDIT_CHARS, most=MOST_EDITS):
    """The edits allowed to a pair whose shorter line has n characters."""
    return min(most, n // edit_chars)


def distance(a, b, k):
    """The edit distance of a and b if it is k or less, else k + 1: one word of 2k + 1 bits holds
    the band of a column."""
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > k:
        return k + 1
    if m <= k:  # too short for a band
        row = list(range(n + 1))
        for i, x in enumerate(a, 1):
            left, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
        return min(row[n], k + 1)
    full, low = (1 << 2 * k + 1) - 1, 1 << 2 * k
    where = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i + k
    up, down, now = full & ~((1 << k) - 1), 0, k
    for j, y in enumerate(b):
        same = where.get(y, 0) >> j & full
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        across, back = (down | ~(diagonal | up)) & full, diagonal & up
        if j < m - k:
            now += not diagonal & low
        else:
            at = m - 1 - j + k
            now += (across >> at & 1) - (back >> at & 1)
        up = (back | ~(diagonal >> 1 | across)) & full
        down = diagonal >> 1 & across
    return min(now, k + 1)


def _common(a, b):
    """How many first characters of a and b are equal."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within(a, b, k):
    """Whether a and b are within k edits; what they begin and end with in common costs little."""
    if abs(len(a) - len(b)) > k:
        return False
    start = _common(a, b)
    a, b = a[start:][::-1], b[start:][::-1]
    end = _common(a, b)
    return distance(a[end:], b[end:], k) <= k


def segments(n, k):
    """(start, length) of the k + 1 segments of a line of n characters."""
    size, longer = divmod(n, k + 1)
    start, out = 0, []
    for i in range(k + 1):
        length = size + (i >= k + 1 - longer)
        out.append((start, length))
        start += length
    return out


def _substrings(size, n, k):
    """(segment, its start, start, length) of the substrings of a text of `size` characters that may
    equal a segment of a text of n <= size characters within k edits."""
    gap = size - n
    for i, (start, length) in enumerate(segments(n, k)):
        low = max(start - i, start + gap - (k - i), 0)
        high = min(start + i, start + gap + (k - i), size - length)
        for at in range(low, high + 1):
            yield i, start, at, length


_LIGHT = "key long, line long, sign long, home boolean"
_STATE = _LIGHT + ", n int, k int, rest string, text string"
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string()]


def _batch(rows):
    names = [x.split()[0] for x in _STATE.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(columns, _KINDS)], names
    )


def _signs(blocks):
    """Of each text (as blocks of four bytes a character), which of 64 character classes come an odd
    number of times: an edit changes two at most."""
    sizes = [len(x) // 4 for x in blocks]
    codes = np.frombuffer(b"".join(blocks), dtype="<u4") & 63
    cells = np.repeat(np.arange(len(blocks), dtype=np.int64) * 64, sizes) + codes
    odd = np.bincount(cells, minlength=64 * len(blocks)).reshape(-1, 64) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view("<i8")[:, 0]


def _grams(texts):
    """Of each text how many of its pairs of neighbours fall into each of 64 classes: an edit changes
    the counts by four in all at most."""
    blocks = [x.encode("utf-32-le", "replace") for x in texts]
    row = np.repeat(np.arange(len(blocks), dtype=np.int64) * 64, [len(x) // 4 for x in blocks])
    codes = np.frombuffer(b"".join(blocks), dtype="<u4").astype(np.int64)
    inside = row[1:] == row[:-1]
    cells = (row[1:] + (codes[:-1] * 31 + codes[1:]) % 61)[inside]
    return np.bincount(cells, minlength=64 * len(blocks)).reshape(-1, 64).astype(np.int32)


def _probes(text_size, edit_chars, most):
    """What a text of so many characters is indexed and probed with, as (length of the shorter text,
    segment, first byte, last byte), and which of these are its own segments."""
    found = []
    for n in range(max(text_size - most, edit_chars), text_size + 1):
        k, gap = edits_of(n, edit_chars, most), text_size - n
        if gap > k:
            continue
        for i, start, at, length in _substrings(text_size, n, k):
            found.append((n * (most + 1) + i, 4 * at, 4 * (at + length), gap == 0 and at == start))
    return [x[:3] for x in found], np.array([x[3] for x in found], dtype=bool)


PROBES = 50_000  # substrings that are hashed at a time


def _first_keys(edit_chars, most):
    """The keys of each line, where nothing is matched yet."""

    def some(texts):
        """(start, stop) of the lines whose substrings are hashed together."""
        start, total = 0, 0
        for i, text in enumerate(texts):
            total += len(text) // 100 + 2 * (most + 1) ** 2
            if total > PROBES:
                yield start, i + 1
                start, total = i + 1, 0
        if start < len(texts):
            yield start, len(texts)

    def keys(batches):
        plans = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                lines, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
                for s, e in some(texts):
                    blocks = [x.encode("utf-32-le", "replace") for x in texts[s:e]]
                    long = np.flatnonzero([len(x) >= 4 * edit_chars for x in blocks])
                    blocks = [blocks[i] for i in long.tolist()]
                    if not blocks:
                        continue
                    found, homes, sizes = [], [], []
                    for data in blocks:
                        plan = plans.get(len(data))
                        if plan is None:
                            if len(plans) > 2_000:
                                plans.clear()
                            plan = plans[len(data)] = _probes(len(data) // 4, edit_chars, most)
                        found += [xxhash.xxh3_64_intdigest(data[a:b], seed) for seed, a, b in plan[0]]
                        homes.append(plan[1])
                        sizes.append(len(plan[1]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(found, dtype=np.uint64).view("<i8")),
                            pa.array(np.repeat(lines[s:e][long], sizes)),
                            pa.array(np.repeat(_signs(blocks), sizes)), pa.array(np.concatenate(homes)),
                        ],
                        ["key", "line", "sign", "home"],
                    )
        release()

    return keys


def _started(edit_chars, most):
    """A state for each line and each length of the shorter line: nothing is matched yet."""

    def started(batches):
        for batch in batches:
            rows = []
            for line, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = len(text)
                if size < edit_chars:
                    continue
                sign = int(_signs([text.encode("utf-32-le", "replace")])[0])
                for n in range(max(size - most, edit_chars), size + 1):
                    k = edits_of(n, edit_chars, most)
                    if size - n <= k:
                        rows.append((0, line, sign, n == size, n, k, text, text))
            yield _batch(rows)

    return started


def _refined(most, first):
    """The keys of each state, with the state that is left when the segment is taken out."""

    def refined(batches):
        for batch in batches:
            rows, chars = [], 0
            for group, line, sign, home, n, k, rest, text in zip(*(x.to_pylist() for x in batch.columns)):
                data = rest.encode("utf-32-le", "replace")
                for i, start, at, length in _substrings(len(rest), n, k):
                    block, seed = data[4 * at:4 * (at + length)], n * (most + 1) + i
                    if not first:
                        block += group.to_bytes(8, "little", signed=True)
                    key = int(np.uint64(xxhash.xxh3_64_intdigest(block, seed)).view("<i8"))
                    own = home and len(rest) == n and at == start
                    rows.append((key, line, sign, own, n - length, k, rest[:at] + rest[at + length:], text))
                    chars += len(rest) + len(text)
                if len(rows) > 50_000 or chars > SLICE:
                    yield _batch(rows)
                    rows, chars = [], 0
            yield _batch(rows)

    return refined


def _meet(most, hot):
    """Pairs of lines under one key of which one is at home and whose signs are near enough; for a
    key with over `hot` lines instead a row (key, NULL)."""

    def meet(batches):
        for key, line, sign, home in whole_runs(batches):
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (line[1:] != line[:-1])])
            key, line, sign, home = (x[new] for x in (key, line, sign, home))
            start, end = runs(key)
            size = end - start
            busy = size > hot
            found = []
            for s, e in zip(start[(size > 16) & ~busy], end[(size > 16) & ~busy]):
                own = np.flatnonzero(home[s:e]) + s
                for t in range(0, len(own), 512):
                    part = own[t:t + 512]
                    near = np.bitwise_count((sign[part, None] ^ sign[None, s:e]).view(np.uint64)) <= 2 * most
                    a, b = np.nonzero(near)
                    found.append(np.stack([line[part[a]], line[s + b]], axis=1))
            alive = np.flatnonzero(np.repeat((size > 1) & (size <= 16), size))
            for step in range(1, 16):
                alive = alive[alive + step < len(key)]
                alive = alive[key[alive] == key[alive + step]]
                near = np.bitwise_count((sign[alive] ^ sign[alive + step]).view(np.uint64)) <= 2 * most
                near &= home[alive] | home[alive + step]
                found.append(np.stack([line[alive[near]], line[alive[near] + step]], axis=1))
            pairs = np.concatenate(found)
            pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
            marks = key[start[busy]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([pairs[:, 0], marks])),
                    pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(len(marks), pa.int64())]),
                ],
                ["a", "b"],
            )

    return meet


def _dealt(rest, block):
    """(cell, line, sign, home, mine, inner, text): the lines of each key in blocks of about `block`
    lines, each pair of blocks in a cell of its own. A key's lines meet its number of blocks in
    SALTS parts, so a key of any size is spread before its lines are multiplied."""
    sizes = rest.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks"))
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rest.withColumn("salt", F.pmod(F.xxhash64("line"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    rows = rows.withColumn("mine", F.pmod(F.xxhash64(F.lit(BLOCK), "line"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    return rows.select(
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
        "line", "sign", "home", "mine", (F.col("mine") == F.col("other")).alias("inner"), "text",
    )


def _connected(edit_chars, most):
    """Of rows sorted by cell, pairs of lines within the edits that connect all such lines of the
    cell; inside a block in its inner cell, across its two blocks in any other."""

    def connected(batches):
        for cell, line, sign, home, mine, inner, text in whole_runs(batches):
            new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (line[1:] != line[:-1])])
            cell, line, sign, home, mine, inner, text = (x[new] for x in (cell, line, sign, home, mine, inner, text))
            found = []
            for s, e in zip(*(x.tolist() for x in runs(cell))):
                lefts, rights = np.arange(s, e), np.arange(s, e)
                if not inner[s]:
                    first = mine[s:e] == mine[s]
                    lefts, rights = lefts[first], rights[~first]
                label = np.arange(len(line))  # lines that are connected have the same
                grams = _grams(text[s:e])
                for a in lefts.tolist():
                    near = np.bitwise_count((sign[rights] ^ sign[a]).view(np.uint64)) <= 2 * most
                    near &= (label[rights] != label[a]) & (home[rights] | home[a])
                    some = rights[near]
                    some = some[np.abs(grams[some - s] - grams[a - s]).sum(axis=1) <= 4 * most]
                    for b in some.tolist():
                        k = edits_of(min(len(text[a]), len(text[b])), edit_chars, most)
                        if label[b] != label[a] and within(text[a], text[b], k):
                            label[s:e][label[s:e] == label[b]] = label[a]
                            found.append((line[a], line[b]))
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
        release()

    return connected


def candidates(texts, edit_chars=EDIT_CHARS, most=MOST_EDITS, hot=HOT, levels=LEVELS, block=BLOCK):
    """(a, b): pairs of line numbers that may be within the allowed edits; of the lines under a key
    that stays hot, pairs that are, enough to connect all that are.

    `texts` has a column text, of which each line is taken; a line may come several times. Keys with
    over `hot` lines are refined, at most `levels` times or until there is too little left to cut;
    what still meets is compared in blocks of about `block` lines, each pair of blocks by itself.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def met(keyed):
        dealt = keyed.select("key", "line", "sign", "home").repartition(parts, "key")
        ordered = dealt.sortWithinPartitions("key", "line", F.desc("home"))
        return stored(ordered.mapInArrow(_meet(most, hot), "a long, b long"), "line-pairs")

    def connected(rest):
        dealt = _dealt(rest, block).repartition(parts, "cell")
        ordered = dealt.sortWithinPartitions("cell", "line", F.desc("home"))
        return stored(ordered.mapInArrow(_connected(edit_chars, most), "a long, b long"), "line-links")

    # Lines and keys are made in one step, so that a task holds one Python worker.
    keys, start = _first_keys(edit_chars, most), _started(edit_chars, most)
    found = met(texts.mapInArrow(lambda batches: keys(_texts(batches)), _LIGHT))
    pairs = found.where("b is not null")
    states = texts.mapInArrow(lambda batches: start(_texts(batches)), _STATE)
    for level in range(levels + 1):
        busy = found.where("b is null").select(F.col("a").alias("key"))
        if busy.isEmpty():
            break
        rest = stored(
            states.mapInArrow(_refined(most, level == 0), _STATE).join(busy, "key", "left_semi").distinct(), "hot-lines"
        )
        if level == levels:
            pairs = pairs.unionByName(connected(rest))
            break
        pairs = pairs.unionByName(connected(rest.where("n <= k")))
        states = rest.where("n > k")
        found = met(states.mapInArrow(_refined(most, False), _STATE))
        pairs = pairs.unionByName(found.where("b is not null"))
    return pairs.distinct()


def _alike(edit_chars, most):
    """Of pairs (a, b, text_a, text_b) those that are within the edits."""

    def alike(batches):
        for whole in batches:
            for batch in slices(whole, "text_a"):
                kept = []
                for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                    k = edits_of(min(len(x), len(y)), edit_chars, most)
                    kept.append(k > 0 and within(x, y, k))
                yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
        release()

    return alike


def _hashed(text):
    data = text.encode("utf-8", "replace")
    return xxhash.xxh3_64_intdigest(data), xxhash.xxh64_intdigest(data)


def _places(batches):
    """The place of each line that is not blank, with two hashes of the trimmed text."""
    for whole in batches:
        for batch in slices(whole, "text"):
            rows, docs, numbers = [], [], []
            for doc, text in enumerate(batch.column("text").to_pylist()):
                for number, line in enumerate((text or "").split("\n")):
                    line = line.strip()
                    if line:
                        rows.append(_hashed(line))
                        docs.append(doc)
                        numbers.append(number)
            hashes = np.array(rows, dtype=np.uint64).reshape(-1, 2).view("<i8")
            docs = pa.array(docs, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), batch.column(0).take(docs),
                 batch.column(1).take(docs), pa.array(numbers, pa.int32())],
                ["line", "check", "doc_id", "text_key", "number"],
            )
    release()


def _texts(batches):
    """The different lines that are not blank of each few megabytes of texts."""
    for whole in batches:
        for batch in slices(whole, "text"):
            lines = {x.strip() for text in batch.column("text").to_pylist() if text for x in text.split("\n")}
            lines = [x for x in lines if x]
            numbers = np.array([_hashed(x)[0] for x in lines], dtype=np.uint64).view("<i8")
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(lines, pa.string())], ["line", "text"])
    release()


def classes(texts, edit_chars=EDIT_CHARS, most=MOST_EDITS, hot=HOT, levels=LEVELS, block=BLOCK):
    """(line, root) of the lines that are alike some other line, directly or over others.

    Only lines of candidate pairs are dealt with their text. If these are few, their numbers are
    sent to all tasks that read the texts; else texts and numbers are joined by a shuffle.
    """
    pairs = candidates(texts, edit_chars, most, hot, levels, block)
    wanted = stored(
        pairs.select(F.col("a").alias("line")).unionByName(pairs.select(F.col("b").alias("line"))).distinct(),
        "line-wanted",
    )
    few = wanted.count() <= MOST_SENT
    lines = texts.mapInArrow(_texts, "line long, text string")
    some = lines.join(F.broadcast(wanted) if few else wanted.hint("merge"), "line", "left_semi")
    some = stored(some.dropDuplicates(["line"]), "line-texts")
    near = pairs.join(some.select(F.col("line").alias("a"), F.col("text").alias("text_a")), "a").join(
        some.select(F.col("line").alias("b"), F.col("text").alias("text_b")), "b"
    )
    near = near.select("a", "b", "text_a", "text_b").mapInArrow(_alike(edit_chars, most), "a long, b long")
    return components(near).withColumnRenamed("node", "line")


def repeated_lines(documents, id_column="doc_id", text_column="text", **options):
    """(doc_id, text_key, drops): the numbers of the lines of each document that repeat an earlier
    one. Earlier means a smaller id (NULL last), then text hash, then line number."""
    text = F.col(text_column).cast("string")
    kind = documents.schema[id_column].dataType.simpleString()
    lines = stored(
        documents.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("text_key"), text.alias("text"))
        .mapInArrow(_places, f"line long, check long, doc_id {kind}, text_key long, number int"),
        "line-places",
    )
    texts = documents.select(text.alias("text"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "number")
    first = stored(
        lines.groupBy("line", "check").agg(F.min(place).alias("first"), F.count("*").alias("n")),
        "line-firsts",
    )
    linked = first.join(classes(texts, **options), "line", "left")
    best = linked.where("root is not null").groupBy("root").agg(F.min("first").alias("best"))
    busy = linked.where("root is not null or n > 1").join(best, "root", "left").select(
        "line", "check", F.coalesce("best", "first").alias("keep")
    )
    busy = stored(busy, "line-keep")
    return (
        lines.join(busy, ["line", "check"]).where(~place.eqNullSafe(F.col("keep")))
        .groupBy("doc_id", "text_key").agg(F.collect_set("number").alias("drops"))
    )


def _cutter():
    @F.pandas_udf("text string, n_lines int, n_dropped int")
    def cut(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        rows = []
        for text, gone in zip(texts, drops):
            if not isinstance(text, str):
                rows.append((None, 0, 0))
                continue
            lines = text.split("\n")
            gone = set(() if gone is None else gone)
            kept = [x for i, x in enumerate(lines) if i not in gone] if gone else lines
            rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return cut


def drop_repeated_lines(documents, id_column="doc_id", text_column="text", **options):
    """All columns of the documents and `_lines`, a struct of the text without the lines that repeat
    an earlier one of any document (exactly, or within the allowed edits, directly or over others),
    n_lines and n_dropped.

    Blanks round a line do not count; blank lines stay. A NULL text stays NULL and has no lines.
    Rows equal in id and text count as one document. Of lines of equal rank (same id and text) the one
    with the smaller number is the earlier. Very long lines are compared whole. An empty table gives
    none. Columns of any other name stay, but for `_lines`, which is replaced.
    """
    line_id, line_key, gone, text_key = free_names(documents, 4)
    found = repeated_lines(documents, id_column, text_column, **options).select(
        F.col("doc_id").alias(line_id), F.col("text_key").alias(line_key), F.col("drops").alias(gone)
    )
    keyed = documents.withColumn(text_key, F.xxhash64(F.col(text_column)))
    same = keyed[id_column].eqNullSafe(found[line_id]) & (keyed[text_key] == found[line_key])
    joined = keyed.join(found, same, "left")
    return joined.withColumn("_lines", _cutter()(F.col(text_column).cast("string"), gone)).drop(
        text_key, line_id, line_key, gone
    )


def keep_unrepeated(documents, id_column="doc_id", text_column="text", **options):
    """The documents, all columns, with the text that is left; one whose every line repeats goes.

    NULL, empty and blank texts stay; of repeated rows all stay or go, as they count as one document;
    the first of equal lines stays. An empty table gives none. A column of the user named `_lines`
    stays as it is.
    """
    named = documents
    if "_lines" in documents.columns:
        (held,) = free_names(documents, 1)
        named = documents.withColumnRenamed("_lines", held)
    found = drop_repeated_lines(named, id_column, text_column, **options)
    empty = (F.col("_lines.n_dropped") > 0) & (F.trim("_lines.text") == "")
    found = found.where(~F.coalesce(empty, F.lit(False))).withColumn(
        text_column, F.col("_lines.text")
    ).drop("_lines")
    return found.toDF(*documents.columns)


def op2_line_dedup(spark, folder):
    """All documents without the lines that repeat an earlier one."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(documents).select(
        "doc_id", "_lines.n_lines", "_lines.n_dropped", F.col("_lines.text").alias("kept_text")
    )
