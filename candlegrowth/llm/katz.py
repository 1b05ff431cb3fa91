"""A Katz backoff model of word pairs, and its score of every text.

P(w | h) is d(c) * c / norm(h) where the pair (h, w) was seen c times, and else alpha(h) * P(w);
P(w) = (c(w) + 1) / (N + V + 1), as all words unknown to the training share one count. d is the
Good-Turing discount of counts up to TURING, from the numbers of pairs seen once, twice, ... in
all training texts. alpha(h) makes P(. | h) sum to one exactly: what the discounts leave, shared
among the words not seen after h. The history of a text's first word is a start mark.

Texts are encoded into stored batches. Word counts come back to each batch with numbers for the
words; then each batch sends its distinct pairs, sorted, to shards by history. A shard adds the
counts and keeps, per history, the sums that alpha needs. These tables are stored by shard and
batch; then each batch looks its pairs up and scores its tokens, one after another, backing off
where a pair is unseen.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from candlegrowth.llm.common import WordHashes, mixed, release, runs, stored, text_bytes, word_chunks
from candlegrowth.llm.counting import (
    by_batch, merged, pack, pack_rising, parts_of, shards_of, totals, unpack, unpack_rising,
)

TURING = 5
BATCH_TOKENS = 1_500_000
HOT = 1 << 16  # at most so many histories are spread over several shards: those over 1/HOT of all
END, START = np.uint64(1), np.uint64(2)  # marks in place of word hashes


def _encode(id_type):
    """Batches of texts: ids, held, uids and sizes by piece of a text, words, numbers.

    A piece is its history and its tokens; a text longer than a batch goes on in the next one.
    """

    def batch_of(number, pieces):
        words, numbers = np.unique(np.concatenate([x for *_, x in pieces]), return_inverse=True)
        sizes = np.array([len(x) - 1 for *_, x in pieces])
        train = np.concatenate([np.full(len(x), not held) for _, held, _, x in pieces])
        train[np.cumsum([0, *(sizes[:-1] + 1)])] = False  # histories are no tokens
        counts = np.bincount(numbers[train], minlength=len(words))
        ids, held, uids = ([x[i] for x in pieces] for i in range(3))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]), pa.array([ids], pa.list_(id_type)), pa.array([held], pa.list_(pa.bool_())),
                pa.array([uids], pa.list_(pa.int64())), pa.array([pack(sizes)]), pa.array([pack_rising(words)]),
                pa.array([pack(numbers)]), pa.array([pack(counts)]), pa.array([len(words)], pa.int64()),
            ],
            ["batch", "ids", "held", "uids", "sizes", "words", "numbers", "counts", "n_words"],
        )

    def encode(batches):
        cache = WordHashes()
        number = TaskContext.get().partitionId() << 32
        uid, pieces, length = number, [], 0
        for batch in batches:
            for doc_id, held, data in zip(*(x.to_pylist() for x in batch.columns)):
                uid += 1
                last, tokens, size = START, [], 0
                for words in [*word_chunks((data or b"").lower()), None]:
                    found = cache.of(words) | np.uint64(4) if words is not None else np.array([END])
                    tokens.append(found)
                    size += len(found)
                    if words is None or size >= BATCH_TOKENS:
                        whole = np.concatenate([[last], *tokens])
                        pieces.append((doc_id, held, uid, whole))
                        length += size
                        last, tokens, size = whole[-1], [], 0
                    if length >= BATCH_TOKENS:
                        yield batch_of(number, pieces)
                        number, pieces, length = number + 1, [], 0
        if pieces:
            yield batch_of(number, pieces)

    return encode


def _pairs(sizes, words, numbers):
    """Of a batch: distinct (history, word) codes in rising order, and each token's place there."""
    first = np.zeros(len(numbers), dtype=bool)
    first[np.cumsum([0, *(sizes[:-1] + 1)])] = True
    token = np.flatnonzero(~first)
    return np.unique(numbers[token - 1] * np.int64(len(words)) + numbers[token], return_inverse=True)


def _joined(blocks, offsets):
    """Global numbers and totals of a batch's words from its blocks by shard."""
    ids = [unpack_rising(b["ranks"]) + offsets[b["shard"]] for b in blocks]
    return np.concatenate(ids), np.concatenate([unpack(b["totals"]) for b in blocks])


def _shard_of(ids, totals_, history, word, shards, hot_over):
    """The shard of each pair: by its history, and for a hot one by its word too."""
    mark = mixed(ids[history].astype(np.uint64))
    hot = totals_[history] > hot_over
    mark[hot] += mixed(ids[word[hot]].astype(np.uint64) ^ np.uint64(0x5555))
    return (mark % np.uint64(shards)).astype(np.int64)


class _Batch:
    """The pairs of a stored batch with the totals of its words."""

    def __init__(self, row, model):
        self.sizes = unpack(row["sizes"])
        self.ids, self.totals = _joined(row["uni"], model["offsets"])
        codes, place = _pairs(self.sizes, self.ids, unpack(row["numbers"]))
        self.place = place.astype(np.int32)
        self.history, self.word = (x.astype(np.int32) for x in np.divmod(codes, len(self.ids)))
        del codes, place
        held = np.repeat(np.array(row["held"], dtype=bool), self.sizes)
        self.train = np.bincount(self.place[~held], minlength=len(self.word)).astype(np.int32)
        self.token_word = self.word[self.place]
        shard = _shard_of(self.ids, self.totals, self.history, self.word, model["shards"], model["hot_over"])
        order = np.lexsort((self.word, self.history, shard))  # global numbers rise with these
        self.order = order.astype(np.int32)
        shard = shard[self.order]
        starts, ends = runs(shard)  # only shards that occur are visited
        self.cuts = list(zip(shard[starts].tolist(), starts.tolist(), ends.tolist()))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    def blocks(self):
        for shard, s, e in self.cuts:
            yield shard, self.order[s:e]


def _rows(batch):
    """Row after row, so that the blocks of one text batch at a time are unpacked."""
    return (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows))


def _send_pairs(model):
    def send(batches):
        for part in batches:
            for row in _rows(part):
                batch, rows = _Batch(row, model), []
                for shard, at in batch.blocks():
                    pair = batch.ids[batch.history[at]] << np.int64(31) | batch.ids[batch.word[at]]
                    rows.append((
                        shard, row["batch"], pack_rising(pair), pack(batch.train[at]),
                        pack(batch.totals[batch.word[at]]), pack((batch.totals[batch.history[at]] > model["hot_over"])),
                    ))
                columns = list(zip(*rows))
                kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds)],
                    ["shard", "batch", "pairs", "counts", "words", "hot"],
                )
                del batch, rows, columns
                release()

    return send


def _sums(history, count, word_total):
    """Per distinct history (in order): numbers of pairs seen 1 .. TURING times, the counts of those
    seen more often, and the sum of c(w) + 1 over all words seen after it."""
    names, place = np.unique(history, return_inverse=True)
    out = np.zeros((len(names), TURING + 2), dtype=np.int64)
    for r in range(1, TURING + 1):
        out[:, r - 1] = np.bincount(place[count == r], minlength=len(names))
    np.add.at(out[:, TURING], place[count > TURING], count[count > TURING])
    np.add.at(out[:, TURING + 1], place[count > 0], word_total[count > 0] + 1)
    return names, out


def _add_pairs(group: pd.DataFrame) -> pd.DataFrame:
    release()
    blocks = [unpack_rising(x) for x in group["pairs"]]
    distinct, total, places = merged(blocks, [unpack(x) for x in group["counts"]])
    word = np.zeros(len(distinct), dtype=np.int64)
    hot = np.zeros(len(distinct), dtype=bool)
    for place, words, warm in zip(places, group["words"], group["hot"]):
        word[place], hot[place] = unpack(words), unpack(warm) > 0
    names, sums = _sums(distinct >> np.int64(31), total, word)
    warm, warm_sums = _sums(distinct[hot] >> np.int64(31), total[hot], word[hot])
    sent = []
    for block, place in zip(blocks, places):
        mine = np.searchsorted(names, np.unique(block >> np.int64(31)))
        sent.append((pack(total[place]), pack(sums[mine].ravel())))
    times = np.bincount(np.minimum(total, TURING + 2), minlength=TURING + 3)[1:TURING + 2]
    empty = [[]] * (len(group) - 1)
    return pd.DataFrame({
        "shard": group["shard"], "batch": group["batch"],
        "totals": [x for x, _ in sent], "sums": [x for _, x in sent],
        "times": [times.tolist(), *empty], "hot": [warm.tolist(), *empty],
        "hot_sums": [warm_sums.tolist(), *empty],
    })


def discounts(times):
    """d(1) .. d(TURING) of the numbers of pairs seen 1 .. TURING + 1 times. Where these give no
    discount between 0 and 1, as in small samples, half a count is taken off."""
    cut = (TURING + 1) * times[TURING] / times[0] if times[0] else 1.0
    found = []
    for r in range(1, TURING + 1):
        d = 0.0
        if times[r - 1] and cut < 1:
            d = ((r + 1) * times[r] / times[r - 1] / r - cut) / (1 - cut)
        found.append(d if 0 < d < 1 else (r - 0.5) / r)
    return np.array(found)


def _history(sums, discount, n, v):
    """norm and alpha of histories, from their sums; without any pair seen, alpha is 1."""
    turns = np.arange(1, TURING + 1)
    count = sums[:, :TURING] @ turns + sums[:, TURING]
    kept = sums[:, :TURING] @ (turns * discount) + sums[:, TURING]
    norm = np.where(sums[:, :TURING].any(axis=1), count, count + 1)  # nothing discounted: one count more
    free = (n + v + 1 - sums[:, TURING + 1]) / (n + v + 1)
    return norm, np.where(count > 0, (1 - kept / np.maximum(norm, 1)) / free, 1.0)


def _score(model, id_type):
    def score(batches):
        n, v, discount = model["n"], model["v"], model["discount"]
        hot_norm, hot_alpha = _history(model["hot_sums"], discount, n, v)
        for part in batches:
            for row in _rows(part):
                batch = _Batch(row, model)
                count = np.zeros(len(batch.word), dtype=np.int64)
                norm, alpha = np.ones(len(batch.ids)), np.ones(len(batch.ids))
                for (_, at), block in zip(batch.blocks(), row["bi"], strict=True):
                    count[at] = unpack(block["totals"])
                    mine = np.unique(batch.history[at])
                    norm[mine], alpha[mine] = _history(
                        unpack(block["sums"]).reshape(-1, TURING + 2), discount, n, v
                    )
                if len(model["hot"]):
                    near = np.minimum(np.searchsorted(model["hot"], batch.ids), len(model["hot"]) - 1)
                    hot = model["hot"][near] == batch.ids
                    norm[hot], alpha[hot] = hot_norm[near[hot]], hot_alpha[near[hot]]
                low = (batch.totals + 1) / (n + v + 1)
                cut = np.concatenate([[1.0], discount, [1.0]])[np.minimum(count, TURING + 1)]
                value = np.where(
                    count > 0, cut * count / norm[batch.history], alpha[batch.history] * low[batch.word]
                )
                token = np.log10(value)[batch.place]
                base = np.log10(low)[batch.token_word]
                known = (batch.totals > 0)[batch.token_word].astype(np.int64)
                sums = [np.add.reduceat(x, batch.starts) for x in (known, base, token)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], id_type), pa.array(row["held"], pa.bool_()), pa.array(row["uids"], pa.int64()),
                        pa.array(batch.sizes.astype("i8")), *map(pa.array, sums),
                    ],
                    ["doc_id", "held_out", "uid", "n_tokens", "n_known", "base_score", "score"],
                )
                del batch, row, count, norm, alpha, low, cut, value, token, base, known
                release()

    return score


def held_out(id_column="doc_id", parts=7, part=2):
    """Whether crc32 of the id as text leaves the given remainder; false for a NULL id."""
    mark = F.crc32(F.col(id_column).cast("string").cast("binary")) % parts
    return F.coalesce(mark == part, F.lit(False))


def katz_scores(documents, id_column="doc_id", text_column="text", held=None):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Learns from the rows for which `held` (a boolean column) is false. Tokens are the words with A-Z
    lower-cased and one end mark; a NULL or blank text has the end mark alone. Repeated rows count
    and are scored as rows of their own; an empty table gives no rows. Other columns are not read.
    """
    spark = documents.sparkSession
    held = held_out(id_column) if held is None else held
    rows = documents.select(F.col(id_column).alias("doc_id"), held.alias("held"), text_bytes(text_column).alias("data"))
    id_type, name = to_arrow_type(rows.schema["doc_id"].dataType), rows.schema["doc_id"].dataType.simpleString()
    batches = stored(
        rows.mapInArrow(
            _encode(id_type),
            f"batch long, ids array<{name}>, held array<boolean>, uids array<long>, sizes binary, words binary, "
            "numbers binary, counts binary, n_words long",
        ),
        "katz-texts",
    )
    words, count = batches.agg(F.sum("n_words"), F.count("*")).first()
    shards, parts = shards_of(spark, words), parts_of(spark, count)
    uni = stored(totals(batches, shards), "katz-words")
    sizes = uni.groupBy("shard").agg(F.max("types"), F.max("seen"), F.max("sum")).collect()
    types = np.zeros(shards + 1, dtype=np.int64)
    for shard, number, *_ in sizes:
        types[shard + 1] = number
    n, v = sum(x[3] for x in sizes), sum(x[2] for x in sizes)
    if types.sum() >= 1 << 31:
        raise ValueError("more than two billion distinct words")
    pairs_ = shards_of(spark, (n or 1) // 2)
    model = {"offsets": np.cumsum(types), "n": n, "v": v, "shards": pairs_, "hot_over": max(n // HOT, 1)}
    known = by_batch(uni.repartition(parts, "batch"), "ranks", "totals", name="uni")
    texts = batches.select("batch", "ids", "held", "uids", "sizes", "numbers").repartition(parts, "batch")
    texts = texts.join(known, "batch")
    sent = texts.mapInArrow(
        _send_pairs(model), "shard int, batch long, pairs binary, counts binary, words binary, hot binary"
    )
    bi = stored(
        sent.repartition(parts_of(spark, pairs_), "shard").groupBy("shard").applyInPandas(
            _add_pairs,
            "shard int, batch long, totals binary, sums binary, times array<long>, hot array<long>, hot_sums array<array<long>>",
        ),
        "katz-pairs",
    )
    times = bi.where("size(times) > 0").select(*[F.sum(F.col("times")[r]) for r in range(TURING + 1)]).first()
    warm = bi.where("size(hot) > 0").select(F.explode(F.arrays_zip("hot", "hot_sums")).alias("x")).groupBy("x.hot").agg(
        *[F.sum(F.col("x.hot_sums")[i]) for i in range(TURING + 2)]
    ).orderBy("hot").collect()
    model |= {
        "discount": discounts([x or 0 for x in times]),
        "hot": np.array([x[0] for x in warm], dtype=np.int64),
        "hot_sums": np.array([x[1:] for x in warm], dtype=np.int64).reshape(-1, TURING + 2),
    }
    scored = texts.join(by_batch(bi.repartition(parts, "batch"), "totals", "sums", name="bi"), "batch").mapInArrow(
        _score(model, id_type),
        f"doc_id {name}, held_out boolean, uid long, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.groupBy("uid", "doc_id", "held_out").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), F.sum("base_score").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("uid")


def op9_katz_lm(spark, folder):
    """Base and Katz scores of all documents."""
    return katz_scores(spark.read.parquet(f"{folder}/documents.parquet"))
