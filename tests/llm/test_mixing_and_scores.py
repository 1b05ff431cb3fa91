"""Mixing, Katz scores and the pipeline against brute force, and on odd rows."""

import collections
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlegrowth.llm import katz, mixing, queries

DOCS = "doc_id long, text string, source string"


# Mixing


def _targets(sizes, share=1.5, most=2.0, weights=(5.0, 2.0, 1.0)):
    """Shares by weight; what is above the most is shared again until none is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, open_, found = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        for s in full:
            found[s] = most * sizes[s]
            left -= found[s]
        if not full:
            found |= {s: level * weight[s] for s in open_}
            break
        open_ -= full
    return found


def _mix_rows(seed=1, n=150):
    rng = random.Random(seed)
    names = ["b", "a", "é", "Z", "z", None, ""]
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 3, 20, 300]))), rng.choice([*names, "b", "b", "b"])) for i in range(n)]
    return rows + [(n, None, "a"), (n, None, "a"), (None, "x y z", "b"), (3, "p q", "b"), (3, "p q", "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_the_mix_meets_its_targets(spark, seed):
    rows = _mix_rows(seed)
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("x")).withColumn("block", F.lit(1))
    found = mixing.taken(docs, block=8).collect()
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in found), key=str) == sorted(
        ((i, len((t or "").split()), s) for i, t, s in rows), key=str
    )
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets, taken = _targets(sizes), collections.Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    again = mixing.taken(docs.repartition(7), block=8).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_every_slot_holds_one_block(spark):
    docs = spark.createDataFrame([(i, "w " * (10 * i), f"s{i % 4}") for i in range(40)], DOCS)
    rows = mixing.mix(docs, block=16).where("shard IS NOT NULL").collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[(r["source"], r["number"])].append(r)
    uses = collections.Counter()
    for (source, _), parts in slots.items():
        assert len({(p["block"], p["shard"]) for p in parts}) == 1
        assert sum(p["words"] for p in parts) <= 16
        uses[(source, parts[0]["block"])] += 1
    assert max(uses.values()) <= 2


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1001])
def test_block_permutations(spark, size):
    number = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit("k")).alias("x"))
    found = [r["x"] for r in number.collect()]
    assert sorted(found) == list(range(size))
    assert size < 100 or found != sorted(found)


def test_draws_are_many_different_ones(spark):
    sizes = spark.createDataFrame([("a", 30000), ("b", 30000), ("c", 30000)], "source string, source_size long")
    planned = mixing.plan(sizes, 16)
    rows = mixing.draws(planned, shard_slots=256).groupBy("shard", "source").count()
    shares = [r["count"] for r in rows.where("source = 'b'").collect()]
    assert len(set(shares)) > 3  # multinomial, not the same in each shard


def test_no_documents(spark):
    assert mixing.taken(spark.createDataFrame([], DOCS)).count() == 0
    blank = mixing.taken(spark.createDataFrame([(1, " ", "a"), (2, None, None)], DOCS)).collect()
    assert sorted((r["doc_id"], r["taken"], r["target"]) for r in blank) == [(1, 0, 0.0), (2, 0, 0.0)]


# Katz


def _katz(rows):
    """Scores by plain counting."""
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows if i is not None}
    tokens = [["\0start", *(t or "").encode().lower().decode().split(), "\0end"] for _, t in rows]
    words, pairs = collections.Counter(), collections.Counter()
    for (i, _), t in zip(rows, tokens):
        if not held.get(i, False):
            words.update(t[1:])
            pairs.update(zip(t, t[1:]))
    n, v = sum(words.values()), len(words)
    times = [sum(c == r for c in pairs.values()) for r in range(1, katz.TURING + 2)]
    cut = katz.discounts(times)
    after = collections.defaultdict(dict)
    for (h, w), c in pairs.items():
        after[h][w] = c

    def low(w):
        return (words[w] + 1) / (n + v + 1)

    def kept(c):
        return (cut[c - 1] if c <= katz.TURING else 1.0) * c

    def chance(h, w):
        seen = after.get(h)
        if not seen:
            return low(w)
        norm = sum(seen.values()) + (0 if any(c <= katz.TURING for c in seen.values()) else 1)
        if w in seen:
            return kept(seen[w]) / norm
        return (1 - sum(map(kept, seen.values())) / norm) / (1 - sum(map(low, seen))) * low(w)

    for h in list(after)[:50]:  # exactly normalised over the known words and one unknown
        assert math.isclose(sum(chance(h, w) for w in [*words, "\0unknown"]), 1, rel_tol=1e-9)
    return [
        (i, held.get(i, False), len(t) - 1, sum(words[w] > 0 for w in t[1:]), n,
         sum(math.log10(low(w)) for w in t[1:]), sum(math.log10(chance(h, w)) for h, w in zip(t, t[1:])))
        for (i, _), t in zip(rows, tokens)
    ]


def _texts(seed=3, n=80):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("The cat sat on a mat And É dog ran".split()) for _ in range(rng.randrange(40)))) for i in range(n)]
    return rows + [(100, None), (101, ""), (None, "the cat unknown"), (5, "the cat"), (5, "the cat"), (102, "same " * 60)]


@pytest.mark.parametrize("tokens, hot", [(3_000_000, 1 << 16), (50, 8), (7, 1 << 16)])
def test_scores_are_those_of_plain_counting(spark, monkeypatch, tokens, hot):
    monkeypatch.setattr(katz, "BATCH_TOKENS", tokens)
    monkeypatch.setattr(katz, "HOT", hot)
    rows = _texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("batch", F.lit(0)).withColumn("uid", F.lit(0))
    found = sorted((tuple(r) for r in katz.katz_scores(docs).collect()), key=str)
    expected = sorted(_katz(rows), key=str)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for got, want in zip(found, expected):
        assert got[5:] == pytest.approx(want[5:], rel=1e-9)


def test_scores_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    found = katz.katz_scores(docs, held=F.lit(True)).first()
    assert tuple(found)[1:] == (True, 3, 0, 0, 0.0, 0.0)
    assert katz.katz_scores(docs.limit(0)).count() == 0


def test_discounts():
    assert (katz.discounts([0] * 6) == [(r - 0.5) / r for r in range(1, 6)]).all()
    found = katz.discounts([1000, 400, 220, 140, 95, 70])
    assert all(0 < d < 1 for d in found)


# Pipeline and registration


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)


def test_sql_of_queries(spark, data):
    from compare import differences

    for name, text in queries.SQL.items():
        assert differences(queries.QUERIES[name](spark, data), data, text) == []


def test_pipeline(spark, tmp_path):
    """Each planted fault goes in its stage, and clean documents stay."""
    rng = random.Random(8)

    def text(n=80):
        return " ".join(f"{rng.choice(['the', 'of', 'und', 'der'])} {''.join(rng.choice('abcdefghij') for _ in range(6))}" for _ in range(n // 2))

    item = text(20)
    clean = [(i, text(), "en", f"s{i % 3}", 0) for i in range(30)]
    copy = (60, "".join(c.upper() for c in clean[4][1]), "en", "s0", 0)
    rows = [*clean, (50, "12 %% 34", "en", "s0", 0), (51, clean[1][1], "en", "s1", 0), copy,
            (61, text(10) + "\n" + item + "\n" + text(10), None, "s2", 0), (62, None, "en", "s1", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        assert number == 4 or after.columns == docs.columns
        docs = after
        left.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    keep = set(range(30))
    assert left[0] == keep | {51, 60, 61}
    assert left[1] == keep | {60, 61}
    assert left[2] == keep | {61}
    assert left[3] == left[4] == keep
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
    assert corpus_pipeline.ORACLE_SQL is None


CLASHING = ["_own_0", "_own_1", "_language", "_lines", "_line_id", "_text_key", "_kept_key", "_kept_id", "_hits", "_new",
            "line", "root", "fp", "key", "size", "item_id", "take"]


def test_stages_on_odd_rows_and_clashing_names(spark, tmp_path):
    """Repeated rows, NULL in every column, no label at all, and user columns named like inner ones."""
    item = " ".join(f"b{i}" for i in range(20))
    rows = [(i, f"text number {i} " + " ".join(f"w{i * 50 + j}" for j in range(60)), None, f"s{i % 3}", 9) for i in range(20)]
    rows += [rows[3], rows[3], (None, None, None, None, None), (30, "", None, None, 0), (31, "123", None, None, 3),
             (32, "x " + item, None, "s0", 1), (None, "no id but some words", None, None, 1)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        for row in docs.collect():
            assert all(row[x] == (None if row.doc_id is None else f"{x} of {row.doc_id}") for x in CLASHING), name
    assert sorted(r.doc_id for r in docs.where("doc_id is not null").collect()) == list(range(20))
    assert docs.where("doc_id is null").count() == 1
    taken = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path))
    assert taken.count() == 21


def test_pipeline_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_only_shards_that_occur_are_visited():
    """The blocks that are sent grow with the words, not with the shards."""
    import numpy as np
    import pyarrow as pa

    from candlegrowth.llm import counting

    words = np.sort(np.random.default_rng(1).integers(1 << 63, size=50, dtype=np.uint64) * np.uint64(2))
    part = pa.RecordBatch.from_arrays(
        [pa.array([7, 8]), pa.array([counting.pack_rising(words), counting.pack_rising(words[:0])]),
         pa.array([counting.pack(np.arange(50)), counting.pack(np.arange(0))])], ["batch", "words", "counts"],
    )
    for shards in (1, 7, 1_000_000):
        (sent,) = counting._deal(shards)([part])
        assert sent.num_rows <= min(shards, 50)
        rows = sorted(sent.to_pylist(), key=lambda x: x["shard"])
        found = np.concatenate([counting.unpack_rising(x["words"]) for x in rows]).view(np.uint64)
        assert (found == words).all() and {x["batch"] for x in rows} == {7}
        owner = {w: x["shard"] for x in rows for w in counting.unpack_rising(x["words"]).view(np.uint64).tolist()}
        assert all(owner[w] == w * shards >> 64 for w in owner)
