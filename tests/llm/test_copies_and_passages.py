"""SimHash, substring dedup, license scans, pseudonyms, I-Match against brute force, and on odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from candlegrowth.llm import imatch, licenses, pseudonyms, simhash, substrings

TEXTS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def _documents(seed=1, n=60):
    """Random texts, copies and near copies."""
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 90))) for _ in range(n // 2)]
    for _ in range(n // 2):
        words = rng.choice(texts).split()
        if rng.random() < 0.6:
            words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    return [(i, x) for i, x in enumerate(texts)]


ODD = [(1, None), (2, ""), (2, ""), (3, " \t\n"), (None, "a b c d"), (5, "A b c D"), (6, "a"), (7, "a b")]


def _frame(spark, rows):
    return spark.createDataFrame(rows, TEXTS).withColumn("fp", F.lit("x")).withColumn("key", F.lit(1))


# SimHash


def _simhash(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints, ids, threshold):
    label = {p: p for p in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    order = sorted(label)
    for i, a in enumerate(order):
        for b in order[:i]:
            if bin(a ^ b).count("1") <= threshold:
                label[find(a)] = find(b)
    first = {}
    for p, i in zip(prints, ids):
        if i is not None:
            first[find(p)] = min(first.get(find(p), i), i)
    return [first.get(find(p)) for p in prints]


def test_simhash_of_long_texts_in_pieces(monkeypatch):
    text = "ÄB c d É f g " * 50
    whole = simhash.simhash(text.encode())
    assert whole % 2**64 == _simhash(text)
    chunks = simhash.word_chunks
    monkeypatch.setattr(simhash, "word_chunks", lambda data: chunks(data, 20))
    assert simhash.simhash(text.encode()) == whole


@pytest.mark.parametrize("rows", [_documents(), ODD])
def test_near_duplicates(spark, rows):
    found = simhash.near_duplicates(_frame(spark, rows))
    prints = [_simhash(t) for _, t in rows]
    expected = _components(prints, [i for i, _ in rows], 2)
    signed = [p - (p >> 63 << 64) for p in prints]
    assert _rows(found, "doc_id", "fp", "component_id") == sorted(zip([i for i, _ in rows], signed, expected), key=str)
    kept = simhash.keep_first(_frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "key"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_all_links_are_found(spark, threshold, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_RUN", 4)
    rng = random.Random(threshold)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = set()
    for _ in range(400):
        x = rng.choice(base)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints = sorted(prints)
    rows = spark.createDataFrame([(x - (x >> 63 << 64),) for x in prints], "fp long")
    from candlegrowth.llm.common import components

    found = dict(map(tuple, components(simhash.links(rows, threshold)).collect()))
    expected = _components(prints, [x - (x >> 63 << 64) for x in prints], threshold)
    for x, component in zip(prints, expected):
        x -= x >> 63 << 64
        assert found.get(x, x) == component
    with pytest.raises(ValueError):
        simhash.links(rows, 4)


# Substring dedup


def _without_repeats(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    count = {}
    for w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            count[key] = count.get(key, 0) + 1
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def test_covers():
    for v, cover in substrings.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("window", [3, 12, 17, 35])
def test_repeated_windows_go(spark, window):
    rng = random.Random(window)
    passages = [[f"p{rng.randrange(9)}" for _ in range(rng.randrange(window, 3 * window))] for _ in range(3)]
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            at, passage = rng.randrange(len(words) + 1), rng.choice(passages)
            words[at:at] = passage[rng.randrange(3):len(passage) - rng.randrange(3)]
        rows.append((i, " \n".join(words)))
    rows.append((99, "x " * (window + 2)))  # a window that repeats itself
    found = substrings.remove_repeats(spark.createDataFrame(rows, TEXTS).repartition(4), window=window)
    assert _rows(found, "doc_id", "text", "n_words", "n_removed") == _without_repeats(rows, window)


def test_repeats_of_odd_rows(spark):
    text = " ".join(map(str, range(40)))
    rows = [*ODD, (8, text), (8, text), (None, "X " + text), (9, " ".join(map(str, range(34))))]
    found = substrings.remove_repeats(_frame(spark, rows))
    assert _rows(found, "doc_id", "text", "n_words", "n_removed") == _without_repeats(rows, 35)
    assert substrings.remove_repeats(_frame(spark, rows).limit(0)).count() == 0


# License scans


def test_templates_with_few_changes_are_found():
    rng = random.Random(6)
    scanner = licenses.Scanner(list(licenses.TEMPLATES.items()))
    texts, wanted = [], []
    for name, text in licenses.TEMPLATES.items():
        words = [w for part in licenses.words_of(text) for w in part]
        own = set(licenses.shingles(words))
        for _ in range(12):
            changed = list(words)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(len(changed))] = "zzz"
            share = len(own & set(licenses.shingles(changed))) / len(own)
            around = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(120))]
            texts.append(" ".join(around + changed + around))
            wanted.append((name, share))
    found = scanner.find(texts)
    right = [
        (share >= licenses.SHARE) == any(scanner.names[v[0]] == name for v in x.values())
        for (name, share), x in zip(wanted, found)
    ]
    assert np.mean(right) >= 0.99


@pytest.mark.parametrize("factor", [1.2, 1.5, 1.8, 1.95])
def test_stretched_templates_are_found(factor):
    """Other words are put in at a few places, up to twice the template's length in all."""
    rng = random.Random(5)
    scanner = licenses.Scanner(list(licenses.TEMPLATES.items()))
    texts, wanted = [], []
    for name, text in licenses.TEMPLATES.items():
        words = [w for part in licenses.words_of(text) for w in part]
        own = set(licenses.shingles(words))
        places = max(1, int(0.2 * len(own) // 4))
        for _ in range(20):
            changed = list(words)
            for place in sorted(rng.sample(range(1, len(words)), places), reverse=True):
                changed[place:place] = [f"x{rng.randrange(10**6)}" for _ in range(int(len(words) * (factor - 1)) // places)]
            if len(own & set(licenses.shingles(changed))) >= licenses.SHARE * len(own):
                around = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(300))]
                texts.append(" ".join(around + changed + around))
                wanted.append(name)
    found = [any(scanner.names[v[0]] == name for v in x.values()) for name, x in zip(wanted, scanner.find(texts))]
    assert len(found) > 150 and np.mean(found) >= 0.98


def test_license_rows_are_those_of_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(docs).collect()}
    expected = set()
    templates = {k: set(licenses.shingles([w for p in licenses.words_of(t) for w in p])) for k, t in licenses.TEMPLATES.items()}
    for r in docs.collect():
        own = set(licenses.shingles([w for p in licenses.words_of(r["text"]) for w in p]))
        expected |= {(r["doc_id"], k) for k, t in templates.items() if len(t & own) >= licenses.SHARE * len(t)}
    assert found == expected and found


def test_licenses_of_odd_rows(spark):
    notice = "Released under the MIT License."
    rows = [*ODD, (8, f"x {notice} y"), (8, f"x {notice} y"), (None, notice.lower())]
    found = licenses.scan_licenses(_frame(spark, rows))
    assert _rows(found, "doc_id", "license", "share", "start_word", "end_word") == sorted([
        (8, "MIT-line", 1.0, 1, 6), (8, "MIT-line", 1.0, 1, 6), (None, "MIT-line", 1.0, 0, 5)
    ], key=str)
    assert licenses.scan_licenses(_frame(spark, rows), templates={"none": "", "null": None}).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(_frame(spark, rows), templates={"long": "a b " * licenses.MOST_WORDS})


# Pseudonyms


def _luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


SHAPES = {
    "4785380592391139": r"\d{16}", "4539-1488-0343-6467": r"\d{4}-\d{4}-\d{4}-\d{4}", "152.143.123.131": r"\d+(\.\d+){3}",
    "+1 (677) 555-7033": r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", "123-45-6789": r"\d{3}-\d\d-\d{4}",
    "2020-02-29": r"\d{4}-\d\d-\d\d", "02/29/2020": r"\d\d/\d\d/\d{4}", "bosbt.42@mail8.example.com": r"[a-z]{5}\.\d\d@mail8\.example\.com",
}


def test_pseudonyms_keep_the_format_and_link_equal_values(spark):
    valid = {x: _luhn(re.sub(r"\D", "", x)) for x in SHAPES if len(re.sub(r"\D", "", x)) == 16}
    rows = [(i, f"a {x}, b {x}.") for i, x in enumerate(SHAPES)]
    found = {r["doc_id"]: r["_pseudonymised"] for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, TEXTS), "k").collect()}
    for i, (value, shape) in enumerate(SHAPES.items()):
        first, second = re.fullmatch(r"a (.*), b (.*)\.", found[i]["text"]).groups()
        assert first == second and re.fullmatch(shape, first)
        assert (first != value) == valid.get(value, True)
        if valid.get(value):
            assert _luhn(re.sub(r"\D", "", first))
    day = {found[i]["text"].split(",")[0][2:] for i in (5, 6)}
    iso, american = sorted(day, key=lambda x: "/" in x)
    assert iso == f"{american[6:]}-{american[:2]}-{american[3:5]}"  # one date, one pseudonym
    other = pseudonyms.pseudonymise(spark.createDataFrame(rows, TEXTS), "another key").collect()
    assert all(r["_pseudonymised"]["text"] != found[r["doc_id"]]["text"] for r in other if valid.get(list(SHAPES)[r["doc_id"]], True))


@pytest.mark.parametrize("split", [(1, 1), (3, 2), (21, 40), (37, 1)])
def test_number_permutations(spark, split):
    size = split[0] * split[1]
    found = spark.range(size).select(pseudonyms.permute_number(F.col("id"), split, "k", "t").alias("x"))
    assert sorted(r["x"] for r in found.collect()) == list(range(size))


def test_text_permutations(spark):
    values = [f"{a}{b}{c}" for a in "0123456789" for b in "abcdefghijklmnopqrstuvwxyz" for c in "0123456789"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r[0] for r in frame.select(pseudonyms.permute_text(F.col("v"), "k", "t")).collect()]
    assert sorted(found) == sorted(values)


def test_values_that_are_not_valid_stay(spark):
    text = "1234567812345678 999.1.1.1 1.2.3.4.5 000-12-1234 2019-02-29 555-12 x4785380592391139 12/45/2020"
    rows = [(1, text), (2, None), (3, ""), (None, "no"), (1, text)]
    frame = spark.createDataFrame(rows, TEXTS).withColumn("_x", F.lit(1))
    found = pseudonyms.pseudonymise(frame, "k")
    assert _rows(found, "doc_id", "_pseudonymised.text", "_pseudonymised.n_values") == sorted(
        [(i, t, 0) for i, t in rows], key=str
    )
    assert pseudonyms.pseudonymise(frame.limit(0), "k").count() == 0


# I-Match


def test_edited_texts_and_likeness(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").repartition(5)
    found = sorted(imatch.fingerprints(docs).collect(), key=lambda r: r["doc_id"])
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    order = sorted(texts)
    prints = {}
    for i, (row, doc_id) in enumerate(zip(found, order)):
        text, after = texts[doc_id], texts[order[(i + 1) % len(order)]]
        changed = text[:len(text) - len(text) // 4] + after[:len(text) // 4]
        assert row["doc_id"] == doc_id and row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        prints.setdefault(text, set()).add(row["fingerprint"])
        assert (row["fingerprint"] == row["edited_fingerprint"]) <= (row["near_edited"] == 1)
        follower = found[(i + 1) % len(order)]
        assert (row["fingerprint"] == follower["fingerprint"]) <= (row["near_next"] == 1)
    assert all(len(x) == 1 for x in prints.values())
    near = [r["near_edited"] for r in found]
    far = [r["near_next"] for r in found]
    assert np.mean(near) > 0.45 and np.mean(far) < 0.05
    assert np.mean([a > b for a, b in zip(near, far)]) > 0.95


def test_fingerprints_of_odd_rows(spark):
    found = imatch.fingerprints(_frame(spark, ODD)).collect()
    assert len(found) == len(ODD)
    empty = {r["fingerprint"] for r in found if r["n_chars"] == 0}
    assert len(empty) == 1
    assert [r["doc_id"] for r in found if r["n_chars"] == 0].count(2) == 2
    one = imatch.fingerprints(_frame(spark, [(3, "abcd")])).collect()
    assert [(r["near_next"], r["edited_sha256"]) for r in one] == [(1.0, hashlib.sha256(b"abca").hexdigest())]
    assert imatch.fingerprints(_frame(spark, ODD).limit(0)).count() == 0


def test_a_fingerprint_hashes_the_sorted_terms_of_a_subset(spark):
    """The hashes are equal if and only if the lexicon terms in reach of a subset are equal."""
    docs = [(i, " ".join(f"t{j}" for j in range(i, i + 6))) for i in range(40)]
    found = {r["doc_id"]: r for r in imatch.fingerprints(spark.createDataFrame(docs, TEXTS)).collect()}
    cache = imatch.WordHashes()
    df = {}
    for _, text in docs:
        for w in text.split():
            df[w] = df.get(w, 0) + 1
    factors, prints = imatch._factors(), {}
    for i, text in docs:
        words = {int(cache[w.encode()]): w for w in text.split()}
        level, hashes, subset = imatch._reach(np.array(sorted(words), dtype=np.uint64), factors)
        tag, hexes = found[i]["fingerprint"][:2], found[i]["fingerprint"][2:]
        assert tag in (f"{level:02d}", imatch.WHOLE)
        if tag == imatch.WHOLE:
            continue
        sets = {}
        for h, s in zip(hashes.tolist(), subset.tolist()):
            if 2 <= df[words[h]] <= max(0.1 * len(docs), 2):
                for depth in range(s % imatch.DEPTH + 1):
                    sets.setdefault(depth * imatch.LEXICONS + s // imatch.DEPTH, set()).add(h)
        for place in range(imatch.DEPTH * imatch.LEXICONS):
            value = hexes[4 * place:4 * place + 4]
            assert (value == "0000") == (place not in sets)
            if place in sets:
                assert prints.setdefault(frozenset(sets[place]), value) == value
