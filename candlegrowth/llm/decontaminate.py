"""Benchmark passages in documents, with edits, by CGK embedding and bit sampling.

Texts are sequences of lower-cased words without punctuation. The CGK walk turns a sequence into
one in which Hamming distance stands for edit distance: at each step it puts out the word it stands
on and moves on or stays, by a random bit of the step and the word, so that after an edit two walks
soon run together again. An item is cut into windows of the class length next to its own, one after
the other and one at its end, and windows of that length are embedded at every word of a document;
several walks are taken, and of each several samples of a few positions. A window of a document and
one of an item that agree in a sample make a candidate, so an item may lack any part that the edits
allow; candidates are verified by the exact edit distance of the item to the best substring around.

One walk serves all classes: the walk over a shorter window is the beginning of the one over a longer
window, with the end of the text put in where the shorter one ends. How many samples a class takes
follows from the recall that is asked for, measured on random windows with the allowed edits.

Windows that hold too few words of any item to be within the allowed edits are not embedded, and
candidates that share too few words with their item are not verified; neither can be a match.
Items too short to say anything after an edit are looked up word for word.
"""

import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

RATE = 0.2  # edits allowed per word of the item: similarity 0.8
LEAST_WORDS = 8  # items with fewer words are sought without edits
RECALL = 0.99  # of one window with its share of the edits
WALKS, POSITIONS = 4, 3
MOST_SAMPLES = 24  # of a walk
TRIALS = 600  # random windows from which the number of samples is taken
BLOCK_CHARS = 4_000_000  # characters of the items that are sent to every task at a time
PIECE = 1 << 20
CHUNK = 100_000  # words that are searched at a time
SEED = 7
CLASSES = (8, 12, 16, 24, 32)  # words of a window; walks that go on much longer seldom run together
#: Scripts without blanks between words, of which each character counts as a word: Thai, Lao, Khmer
#: and Burmese, kana, ideographs.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_WORDS = re.compile(f"[^\\W_{_UNSPACED}]+|[{_UNSPACED}]")
_BLANK = re.compile(r"\s")


def words_of(text):
    """The lower-cased words of a text, in lists of about PIECE characters."""
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            gap = _BLANK.search(text, stop)
            stop = gap.start() if gap else len(text)
        yield _WORDS.findall(text[start:stop].lower())
        start = stop


def allowed(n, rate=RATE):
    return int(rate * n)


def window_starts(n, size):
    """Where the windows of an item of n words start: the last ends with the item."""
    return [*range(0, n - size, size), n - size]


def best_substring(item, text):
    """(edits, start, end) of the substring of `text` that is nearest to `item`, both lists of
    numbers: bit-parallel, one machine word per item. Of equal ones the first that ends is taken,
    and of its starts the last."""
    edits, end = _first_best_end(item, text)
    back, length = _first_best_end(item[::-1], text[:end][::-1], edits)
    return edits, end - length, end


def _first_best_end(item, text, stop=-1):
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    where = {}
    for i, x in enumerate(item):
        where[x] = where.get(x, 0) | 1 << i
    up, down, now = full, 0, n
    best, end = n, 0
    for j, x in enumerate(text):
        same = where.get(x, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        across, under = down | (full & ~(diagonal | up)), up & diagonal
        if across & top:
            now += 1
        elif under & top:
            now -= 1
        across, under = across << 1 & full, under << 1 & full
        up, down = under | (full & ~(diagonal | across)), across & diagonal
        if now < best:
            best, end = now, j + 1
            if best == stop:
                break
    return best, end


def edited(rng, ids, edits, fresh):
    """A list of word numbers after so many random edits."""
    row = list(ids)
    for _ in range(edits):
        at, kind = int(rng.integers(len(row))), int(rng.integers(3))
        row[at:at + (kind != 0)] = [] if kind == 1 else [int(rng.integers(fresh))]
    return row


class Walks:
    """Keys of windows: for each walk and class, samples of the words that the walk puts out."""

    def __init__(self, words, walks=WALKS, positions=POSITIONS, classes=CLASSES):
        rng = np.random.default_rng(SEED)
        self.codes = rng.integers(1 << 63, size=words + 2, dtype=np.uint64)  # last two: unknown, end
        self.bits = rng.integers(1 << 63, size=(walks, 2 * max(classes)), dtype=np.uint64) | np.uint64(1)
        self.picks = {
            size: [[np.sort(rng.choice(2 * size, positions, replace=False)).tolist() for _ in range(MOST_SAMPLES)]
                   for _ in range(walks)]
            for size in classes
        }

    def keys(self, ids, starts, sizes):
        """For each walk, the keys of the windows of each size at the starts: {size: samples x starts}.
        sizes: the number of samples of each size."""
        longest = 2 * max(sizes) + 1  # a window at the end runs into blanks
        codes = self.codes[np.concatenate([ids, np.full(longest, -2)])]
        end = self.codes[-1]
        for walk, bits in enumerate(self.bits):
            use, keys = {}, {}
            for size, samples in sizes.items():
                keys[size] = np.zeros((samples, len(starts)), dtype=np.uint64)
                for k, pick in enumerate(self.picks[size][walk][:samples]):
                    for at in pick:
                        use.setdefault(at, {}).setdefault(size, []).append(k)
            place = starts.astype(np.int64)
            for step in range(max(use) + 1):
                code = codes[place]
                for size, samples in use.get(step, {}).items():
                    # A walk of few steps is inside every window it may be asked for.
                    mine = code if step < size else np.where(place - starts < size, code, end)
                    for k in samples:
                        row = keys[size][k]
                        row ^= mine
                        row *= np.uint64(0x9E3779B97F4A7C15)
                code *= bits[step]
                code >>= np.uint64(63)
                place += code.view(np.int64)
            yield keys

    def samples_for(self, size, edits, recall=RECALL):
        """The samples of each walk that find a random window of a size after so many edits, wherever
        near its place a window of the text begins."""
        rng = np.random.default_rng(SEED)
        fresh, around = len(self.codes) - 2, edits + 1
        plain = rng.integers(fresh, size=(TRIALS, size))
        width = size + edits + 2 * around
        text = rng.integers(fresh, size=(TRIALS, width))
        for row, window in zip(text, plain):
            near = edited(rng, window.tolist(), edits, fresh)
            row[around:around + len(near)] = near
        starts = (np.arange(TRIALS)[:, None] * width + np.arange(2 * around + 1)).ravel()
        mine = self.keys(plain.ravel(), np.arange(TRIALS) * size, {size: MOST_SAMPLES})
        there = self.keys(text.ravel(), starts, {size: MOST_SAMPLES})
        met = np.array([
            (a[size][:, :, None] == b[size].reshape(MOST_SAMPLES, TRIALS, -1)).any(axis=2)
            for a, b in zip(mine, there)
        ])  # walk, sample, window
        for samples in range(2, MOST_SAMPLES, 2):
            if met[:, :samples].any(axis=(0, 1)).mean() >= recall:
                return samples
        return MOST_SAMPLES


@lru_cache(maxsize=64)
def samples_of(size, edits, recall, walks, positions):
    return Walks(10_000, walks, positions).samples_for(size, edits, recall)


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, texts, rate=RATE, walks=WALKS, positions=POSITIONS, recall=RECALL):
        self.words = {}
        self.items, self.numbers = [], []
        for number, text in enumerate(texts):
            words = [w for part in words_of(text or "") for w in part]
            if words:
                self.items.append(np.array([self.words.setdefault(w, len(self.words)) for w in words]))
                self.numbers.append(number)
        self.edits = [allowed(len(x), rate) if len(x) >= LEAST_WORDS else 0 for x in self.items]
        self.longest = max(map(len, self.items), default=0)
        self.reach = 2 * max(self.edits, default=0) + 2
        self.walks = Walks(len(self.words), walks, positions)
        self.shared = np.zeros(1 << 20, dtype=bool)  # pairs of item and word, by hash
        for i, x in enumerate(self.items):
            self.shared[self._pair(np.array([i], dtype=np.uint64), x.astype(np.uint64))] = True
        self.short = {}  # length -> sorted hashes of the short items, and which these are
        for n in sorted({len(x) for x in self.items if len(x) < LEAST_WORDS}):
            who = np.array([i for i, x in enumerate(self.items) if len(x) == n])
            hashes = self._sequence(np.concatenate([self.items[i] for i in who.tolist()]), np.arange(len(who)) * n, n)
            order = np.argsort(hashes, kind="stable")
            self.short[n] = hashes[order], who[order]
        self.tables, self.sizes = [], {}
        for size, longer in zip(CLASSES, (*CLASSES[1:], 1 << 60)):
            members = [(i, at) for i, x in enumerate(self.items) if size <= len(x) < longer for at in window_starts(len(x), size)]
            if members:
                # of the windows that do not overlap, one has its share of the edits at most
                share = max(self.edits[i] // (len(self.items[i]) // size) for i, _ in members)
                self.sizes[size] = samples_of(size, min(share, allowed(size, rate) + 1), recall, walks, positions)
                self.tables.append((size, members, size - share, self._table(size, members)))

    @staticmethod
    def _pair(item, word):
        return (item * np.uint64(0x9E3779B97F4A7C15) + word * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)

    def _sequence(self, ids, starts, n):
        """A hash of the n words from each start on."""
        total = np.zeros(len(starts), dtype=np.uint64)
        for k in range(n):
            total = (total ^ self.walks.codes[ids[starts + k]]) * np.uint64(0x9E3779B97F4A7C15)
        return total

    def _table(self, size, members):
        """For each walk the sorted keys of the windows of the items, whose they are, and which
        beginnings of keys there are."""
        flat = np.concatenate([self.items[i][at:at + size] for i, at in members])
        found = []
        for keys in self.walks.keys(flat, np.arange(len(members)) * size, {size: self.sizes[size]}):
            order = np.argsort(keys[size], axis=1, kind="stable")
            hits = np.zeros((len(order), 1 << 16), dtype=bool)
            for i, row in enumerate(keys[size]):
                hits[i, row >> np.uint64(48)] = True
            found.append((np.take_along_axis(keys[size], order, axis=1), order, hits))
        return found

    def _candidates(self, ids):
        """[item, its first word, first word of the window] of candidates in an array of word numbers;
        -2 stands for unknown words."""
        if not self.tables:
            return
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        places = np.arange(len(ids))
        enough = {}
        for size, _, need, _ in self.tables:
            enough[size] = known[np.minimum(places + size, len(ids))] - known[:-1] >= need
        starts = np.flatnonzero(np.logical_or.reduce(list(enough.values())))
        if not len(starts):
            return
        mine = {size: np.flatnonzero(x[starts]) for size, x in enough.items()}
        found = {size: [] for size in enough}
        for walk, keys in enumerate(self.walks.keys(ids, starts, self.sizes)):
            for size, _, _, table in self.tables:
                ranked, who, hits = table[walk]
                for row, line in enumerate(keys[size]):
                    some = line[mine[size]]
                    near = np.flatnonzero(hits[row, some >> np.uint64(48)])
                    left = np.searchsorted(ranked[row], some[near], "left")
                    many = np.searchsorted(ranked[row], some[near], "right") - left
                    at = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    found[size].append(who[row, at] << 32 | np.repeat(starts[mine[size][near]], many))
        for size, members, _, _ in self.tables:
            met = np.unique(np.concatenate(found[size]))
            item, offset = np.array(members)[met >> 32].T
            start = met & 0xFFFFFFFF
            yield from self._sharing(np.stack([item, start - offset, start], axis=1), ids)

    def _exact(self, ids):
        """(item, start) where the words of a short item stand."""
        for n, (hashes, who) in self.short.items():
            places = np.arange(len(ids) - n + 1)
            if not len(places):
                continue
            found = self._sequence(ids, places, n)
            left = np.searchsorted(hashes, found, "left")
            many = np.searchsorted(hashes, found, "right") - left
            at = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            for item, start in zip(who[at].tolist(), np.repeat(places, many).tolist()):
                if np.array_equal(self.items[item], ids[start:start + n]):
                    yield item, start

    def _sharing(self, pairs, ids):
        lengths = np.array([len(self.items[i]) for i in pairs[:, 0].tolist()], dtype=np.int64)
        for n in np.unique(lengths):
            some = pairs[lengths == n]
            spare = self.edits[some[0, 0]]
            for s in range(0, len(some), 4096):
                part = some[s:s + 4096]
                at = part[:, 1:2] + np.arange(-spare, n + spare)
                words = np.where((at >= 0) & (at < len(ids)), ids[np.clip(at, 0, len(ids) - 1)], -2)
                share = self.shared[self._pair(part[:, :1].astype(np.uint64), words.astype(np.uint64))] & (words >= 0)
                yield from part[share.sum(axis=1) >= n - spare].tolist()

    def find(self, texts):
        """For each text the best match (item number, start word, end word, edits) per item."""
        found = [{} for _ in texts]
        held, length = [], 0
        if not self.items:
            return found
        for number, text in enumerate(texts):
            ids = [np.fromiter(map(self.words.get, part, repeat(-2)), np.int64, len(part)) for part in words_of(text or "")]
            ids = np.concatenate(ids) if ids else np.empty(0, dtype=np.int64)
            lap = self.longest + self.reach
            for s in range(0, max(1, len(ids)), CHUNK):
                piece = ids[s:s + CHUNK + lap]
                if len(piece):
                    held.append((number, s, piece))
                    length += len(piece)
                if length >= CHUNK:
                    self._search(held, found)
                    held, length = [], 0
        if held:
            self._search(held, found)
        return found

    def _search(self, held, found):
        ids = np.concatenate([x for _, _, x in held])
        ends = np.cumsum([len(x) for _, _, x in held])
        seen = {}
        for item, start, window in sorted(self._candidates(ids)):
            piece = int(np.searchsorted(ends, window, "right"))
            low, high = int(ends[piece]) - len(held[piece][2]), int(ends[piece])
            n, spare = len(self.items[item]), self.edits[item]
            left, right = max(low, start - 2 * spare), min(high, start + n + 2 * spare)
            if seen.get(item, (-1, -1))[1] >= right and seen[item][0] <= left:
                continue
            right = min(high, right + n)  # neighbours are searched with it
            seen[item] = (left, right)
            edits, s, e = best_substring(self.items[item].tolist(), ids[left:right].tolist())
            if edits <= spare:
                number, offset, _ = held[piece]
                s, e = left - low + offset + s, left - low + offset + e
                best = found[number].get(item)
                if best is None or (edits, s) < (best[3], best[1]):
                    found[number][item] = (self.numbers[item], s, e, edits)
        for item, start in self._exact(ids):
            piece = int(np.searchsorted(ends, start, "right"))
            low, n = int(ends[piece]) - len(held[piece][2]), len(self.items[item])
            if start + n <= ends[piece]:
                number, offset, _ = held[piece]
                s = start - low + offset
                best = found[number].get(item)
                if best is None or s < best[1]:
                    found[number][item] = (self.numbers[item], s, s + n, 0)


def item_blocks(benchmark, id_column="item_id", text_column="text"):
    """The items as lists of (id, text) of about BLOCK_CHARS characters each."""
    items = benchmark.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = size // BLOCK_CHARS + 1
    for block in range(blocks):
        mark = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
        yield [(r["item_id"], r["text"]) for r in items.where(mark == block).collect()]


def _scanner(texts, ids, rate, id_type):
    def scan(batches):
        matcher = Matcher(texts, rate)
        for batch in batches:
            docs = batch.column(0)
            rows = [
                (i, number, len(matcher.items[item]), s, e, edits)
                for i, found in enumerate(matcher.find(batch.column(1).to_pylist()))
                for item, (number, s, e, edits) in sorted(found.items())
            ]
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 6)]
            yield pa.RecordBatch.from_arrays(
                [docs.take(columns[0]), pa.array([ids[n] for n in columns[1].to_pylist()], id_type), *columns[2:]],
                ["doc_id", "item_id", "item_words", "start_word", "end_word", "edits"],
            )

    return scan


def find_items(documents, benchmark, id_column="doc_id", text_column="text", rate=RATE):
    """(doc_id, item_id, item_words, start_word, end_word, edits): a row for each document and item
    where a substring of the document's words is within rate * item_words edits of the item, with
    the best such place (fewest edits, then first).

    Items of fewer than LEAST_WORDS words match word for word only; items and texts that are NULL or
    without words match nothing; repeated items and documents give repeated rows; empty tables give none. Other columns are not read. The
    benchmark goes to the tasks in blocks of bounded size, one pass over the documents for each.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    docs = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = (
        f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, "
        "item_words long, start_word long, end_word long, edits long"
    )
    rows = None
    for block in item_blocks(benchmark):
        scan = _scanner([t for _, t in block], [i for i, _ in block], rate, to_arrow_type(item_type))
        part = docs.mapInArrow(scan, schema)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def drop_contaminated(documents, benchmark, text_column="text", rate=RATE):
    """The documents, all columns, in which no item is found. NULL and empty texts hold none and
    stay; repeated rows go or stay together; an empty benchmark leaves all; very long texts are
    searched whole, in pieces that overlap. No column is added, so none can clash."""
    for block in item_blocks(benchmark):
        texts = [t for _, t in block]

        def clean(texts=texts):
            held = []

            @F.pandas_udf("boolean")
            def is_clean(column: pd.Series) -> pd.Series:
                if not held:
                    held.append(Matcher(texts, rate))
                found = held[0].find([x if isinstance(x, str) else None for x in column])
                return pd.Series([not x for x in found], dtype=bool)

            return is_clean

        documents = documents.where(clean()(F.col(text_column).cast("string")))
    return documents


def op3_decontamination(spark, folder):
    """All benchmark items in all documents."""
    return find_items(
        spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    )
