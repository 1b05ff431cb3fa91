"""Language ID, line dedup and decontamination against brute force, and on odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlegrowth.llm import decontaminate, langid, lines

DOCS = "doc_id long, text string, lang string"


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


# Language ID


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def test_held_out_accuracy(documents):
    found = langid.identify(documents).where(langid.held_out())
    right = found.agg(F.avg((F.col("_language.lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.98


def test_bundles_are_sums_of_bound_trigrams():
    text = "Ab, ab! Ça"
    padded = " ab ab ça "
    expected = np.zeros(langid.SIZE)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        expected += (
            np.roll(langid._letter(ord(a)), 2).astype(float) * np.roll(langid._letter(ord(b)), 1) * langid._letter(ord(c))
        )
    sums, has = langid.bundle([text, None, "12 !"], [0, 1, 2], 3)
    assert (sums[0] == expected).all() and has.tolist() == [True, False, False]


def test_pieces_do_not_change_a_bundle(monkeypatch):
    texts = ["the cat sat on the mat " * 40, "x", "ein Haus am See " * 30]
    whole = langid.bundle(texts, range(3), 3)[0]
    monkeypatch.setattr(langid, "PIECE", 50)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.bundle(texts, range(3), 3)[0] == whole).all()


def test_odd_rows_have_a_language(spark):
    rows = [(1, "the the the", "en"), (2, None, "en"), (3, "", None), (4, "123 %%", "de"), (None, "das das", "de"),
            (6, "the the the", None), (6, "the the the", None)]
    found = langid.identify(spark.createDataFrame(rows, DOCS).withColumn("_x", F.lit(1)))
    got = {(r["doc_id"], r["text"]): tuple(r["_language"]) for r in found.collect()}
    assert got[(2, None)] == got[(3, "")] == got[(4, "123 %%")] == ("und", 0.0)
    assert all(0 <= score <= 1 for _, score in got.values())
    assert found.count() == 7 and "_x" in found.columns
    nothing = langid.identify(spark.createDataFrame([], DOCS))
    assert nothing.count() == 0
    unlabelled = langid.identify(spark.createDataFrame([(1, "abc", None)], DOCS)).first()["_language"]
    assert tuple(unlabelled) == ("und", 0.0)


def test_clean_documents_stay(documents):
    kept = langid.keep_identified(documents)
    assert kept.columns == documents.columns and kept.count() == documents.count()


def test_documents_without_letters_go(spark, documents):
    odd = spark.createDataFrame([(-1, "12 34 %%", "en", "s", 8), (-2, None, "en", "s", 0)], documents.schema)
    assert langid.keep_identified(documents.limit(50).unionByName(odd)).where("doc_id < 0").count() == 0


# Line dedup


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def _edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(max(1, len(text)))
        kind = rng.randrange(3) if text else 2
        if kind == 0:
            text[at] = rng.choice("xyz")
        elif kind == 1:
            del text[at]
        else:
            text.insert(at, rng.choice("xyz"))
    return "".join(text)


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
        b = _edited(rng, a, rng.randrange(4)) if a else "b"
        for k in range(4):
            assert lines.distance(a, b, k) == min(_distance(a, b), k + 1)
            assert lines.within(a, b, k) == (_distance(a, b) <= k)


def _line_rows(seed=2, n=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abc de") for _ in range(rng.randrange(15, 70))).strip() for _ in range(12)]
    rows = []
    for i in range(n):
        rows.append((i, "\n".join(_edited(rng, rng.choice(base), rng.randrange(4)) for _ in range(3)) + "\n\n  same  "))
    return rows


def _kept(rows):
    """Brute force: classes of lines over all pairs, then the first line of each class."""
    order = sorted({x.strip() for _, t in rows for x in t.split("\n")} - {""})
    root = {x: x for x in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(order):
        for b in order[:i]:
            k = lines.edits_of(min(len(a), len(b)))
            if k and _distance(a, b) <= k:
                root[find(a)] = find(b)
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        kept = []
        for x in text.split("\n"):
            if x.strip():
                if find(x.strip()) in seen:
                    continue
                seen.add(find(x.strip()))
            kept.append(x)
        out[doc_id] = "\n".join(kept)
    return out


@pytest.mark.parametrize(
    "options", [{}, {"hot": 8}, {"hot": 3, "levels": 1}, {"hot": 3, "levels": 0, "block": 5}, {"hot": 2, "levels": 2, "block": 3}]
)
def test_lines_within_the_edits_are_dropped(spark, options):
    rows = _line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.drop_repeated_lines(docs, **options)
    assert {r["doc_id"]: r["_lines"]["text"] for r in found.collect()} == _kept(rows)


def test_many_lines_of_one_template_are_linked_by_few_pairs(spark):
    numbers = sorted(random.Random(6).sample(range(10**4), 1_500))
    texts = [f"Report number {x:04d} of the daily price service, all rights reserved" for x in numbers]
    rows = spark.createDataFrame([("\n".join(texts[i:i + 500]),) for i in range(0, 1_500, 500)], "text string")
    pairs = lines.candidates(rows, hot=200, levels=0, block=300)
    assert 0 < pairs.count() < 60 * len(texts)  # a million pairs share a segment
    found = lines.classes(rows, hot=200, levels=0, block=300)
    assert found.select("line").distinct().count() == len(texts)
    assert found.select("root").distinct().count() == 1


def test_lines_of_odd_rows(spark):
    rows = [(1, "a line\n\nA line"), (None, "a line\nother"), (2, None), (3, ""), (4, "a line"), (4, "a line"), (4, "more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(7))
    found = lines.drop_repeated_lines(docs)
    assert _rows(found, "doc_id", "_lines.text", "_lines.n_lines", "_lines.n_dropped") == sorted([
        (1, "a line\n\nA line", 3, 0), (None, "other", 2, 1), (2, None, 0, 0), (3, "", 1, 0),
        (4, "", 1, 1), (4, "", 1, 1), (4, "more", 1, 0),
    ], key=str)
    assert lines.drop_repeated_lines(docs.limit(0)).count() == 0
    kept = lines.keep_unrepeated(docs)
    assert kept.columns == docs.columns and kept.count() == 5


# Decontamination


def _items():
    rng = random.Random(4)
    return [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(10, 50))) for _ in range(30)]


def test_best_substring():
    rng = random.Random(3)
    for _ in range(500):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        text = [rng.randrange(5) for _ in range(rng.randrange(0, 14))]
        best = min(_distance(item, text[s:e]) for s in range(len(text) + 1) for e in range(s, len(text) + 1))
        edits, s, e = decontaminate.best_substring(item, text)
        assert edits == best == _distance(item, text[s:e])


def test_recall_and_precision_of_edited_items():
    rng, items = random.Random(5), _items()
    matcher = decontaminate.Matcher(items)
    hit = total = 0
    texts, wanted = [], []
    for number, item in enumerate(items):
        for share in (0, 0.5, 1):
            words = item.split()
            for _ in range(int(decontaminate.allowed(len(words)) * share)):
                words[rng.randrange(len(words))] = f"z{rng.randrange(9)}"
            around = [f"w{rng.randrange(400)}" for _ in range(60)]
            texts.append(" ".join(around[:30] + words + around[30:]))
            wanted.append(number)
    for number, found in zip(wanted, matcher.find(texts)):
        total += 1
        hit += number in {v[0] for v in found.values()}
    assert hit / total >= 0.97
    clean = [" ".join(f"w{rng.randrange(400)}" for _ in range(300)) for _ in range(50)]
    assert not any(matcher.find(clean))


def test_matches_are_those_of_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(docs, items).collect()}

    def words(text):
        return " " + " ".join(w for part in decontaminate.words_of(text) for w in part) + " "

    texts = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    exact = {(d, r["item_id"]) for r in items.collect() for d, t in texts.items() if words(r["text"]) in t}
    assert exact and exact <= found
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(texts) - {d for d, _ in found}


def test_items_of_odd_rows(spark, monkeypatch):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()}!"), (None, item.replace("five", "v")), (2, None), (3, ""), (4, "one two"), (1, f"x {item.upper()}!")],
        "doc_id long, text string",
    ).withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame([(7, item), (8, "two one"), (9, None), (None, item)], "item_id long, text string")
    expected = sorted([(i, k, 1 if i else 0, 0 if i else 1) for i in (1, 1, None) for k in (7, None)], key=str)
    columns = ["doc_id", "item_id", "start_word", "edits"]
    assert _rows(decontaminate.find_items(docs, items), *columns) == expected
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 40)  # several blocks of items
    assert _rows(decontaminate.find_items(docs, items), *columns) == expected
    assert decontaminate.find_items(docs.limit(0), items).count() == 0
    assert decontaminate.find_items(docs, items.limit(0)).count() == 0


def test_long_texts_are_searched_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 40)
    monkeypatch.setattr(decontaminate, "PIECE", 60)
    items = _items()[:5]
    texts = [" ".join(f"q{i}" for i in range(200)) + " " + item + " tail" for item in items]
    found = decontaminate.Matcher(items).find(texts)
    assert [[(v[0], v[1], v[3]) for v in x.values()] for x in found] == [[(i, 200, 0)] for i in range(5)]


@pytest.mark.parametrize("n", [100, 150, 300, 500, 1000])
@pytest.mark.parametrize("kind", ["sub", "ins", "del", "start", "end"])
def test_long_items_are_found_at_the_allowed_edits(n, kind):
    """Items of which a fifth of the words are replaced, put in or taken out, or whose first or
    last fifth is missing."""
    rng = random.Random(n)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for _ in range(20)]
    texts, k = [], decontaminate.allowed(n)
    for number, item in enumerate(items):
        words = list(item)
        if kind in ("start", "end"):
            words = words[k:] if kind == "start" else words[:-k]
        else:
            for at in sorted(rng.sample(range(n), k), reverse=True):
                words[at:at + (kind != "ins")] = [] if kind == "del" else [f"x{rng.randrange(10**6)}"]
        texts.append(" ".join([f"y{number}"] * 30 + words + ["z"] * 30))
    found = decontaminate.Matcher([" ".join(x) for x in items]).find(texts)
    assert sum(i in x for i, x in enumerate(found)) >= 19


@pytest.mark.parametrize("n", [8, 10, 11, 12, 15, 16, 20, 24, 31, 32, 45, 64])
def test_items_of_all_lengths_are_found_at_the_allowed_edits(n):
    rng = random.Random(n)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for _ in range(200)]
    texts = []
    for number, item in enumerate(items):
        words = list(item)
        for _ in range(decontaminate.allowed(n)):
            at, kind = rng.randrange(len(words)), rng.randrange(3)
            words[at:at + (kind != 0)] = [] if kind == 1 else [f"x{rng.randrange(10**6)}"]
        texts.append(" ".join([f"y{number}"] * 20 + words + ["z"] * 20))
    found = decontaminate.Matcher([" ".join(x) for x in items]).find(texts)
    assert sum(i in x for i, x in enumerate(found)) >= 0.9 * len(items)


def test_short_items_are_found_word_for_word():
    items = ["one two three four five", "five", "two three", "日本の文", "not here at all"]
    texts = ["Zero one TWO three, four five six", "one two three four six", None, "", "x 日本の文。", "five five"]
    found = decontaminate.Matcher(items).find(texts)
    assert [sorted(v[:3] for v in x.values()) for x in found] == [
        [(0, 1, 6), (1, 5, 6), (2, 2, 4)], [(2, 1, 3)], [], [], [(3, 1, 5)], [(1, 0, 1)],
    ]


def test_short_items_do_not_stand_over_two_texts():
    found = decontaminate.Matcher(["a b c"]).find(["x a b", "c x", "a b c"])
    assert found == [{}, {}, {0: (0, 0, 3, 0)}]


def test_drop_contaminated_on_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item), (None, "x")], "doc_id long, text string")
    docs = docs.withColumn("item_id", F.lit("x")).withColumn("edits", F.lit(1))
    items = spark.createDataFrame([(7, item), (7, item), (8, None)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert _rows(kept, "doc_id", "text") == sorted([(2, None), (3, ""), (None, "x")], key=str)
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == 5
    assert decontaminate.drop_contaminated(docs.limit(0), items).count() == 0
