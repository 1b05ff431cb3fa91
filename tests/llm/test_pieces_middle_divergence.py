"""SentencePiece encoding, fill-in-the-middle and source divergence."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlegrowth.llm import divergence, middle, pieces, queries
from compare import differences

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string"

ODD = [
    None, "", " ", "\n", "  a  b ", "a\n\nb\tc", "▁x▁▁ y", "é①ﬁ\xa0x　y", "<s>hi</s><0x0A>", "\x00a\r\n x",
    "日本語の文。" * 50, " " * 5000, "ab" * 5000, "the cat sat", "the cat sat", "🙂‍↔️ x", "<P>", "a <S> b", "<M",
    "ABCabc ÀÉ", "word " * 30000,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, text, "en" if i % 3 else None, f"s{i % 4}") for i, text in enumerate(ODD)]
    rows += [rows[4], rows[4], (None, "no id", "en", "s1"), (None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


# SentencePiece


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(MODEL)


def test_encoding_equals_the_library(encoder):
    rng = random.Random(3)
    known = list(encoder.score)
    letters = [*"abcdefghij      \n\t▁aeiouéà日本語ab12-_.,;<>/sSTHE", "  ", "the", "ing", " th", "    "]
    texts = [t or "" for t in ODD]
    for k in range(3000):
        texts.append("".join(rng.choice(letters) for _ in range(rng.randrange(80))))
        parts = [rng.choice(known)[:rng.randrange(1, 9)] for _ in range(rng.randrange(1, 12))]
        texts.append("".join(parts).replace("▁", " "))
    assert [encoder.encode(t) for t in texts] == encoder.library.encode(texts)


def test_backtracking_over_a_whole_text_needs_no_cuts(encoder):
    """Without cuts between words, one run of backtracking gives the same pieces."""
    text = "▁It▁was▁the▁best▁of▁timesand▁▁▁▁the▁worst,▁unbelievablyantidisestablishment.\n▁日本"
    split = encoder.split(text)
    assert "".join(split) == text
    assert [i for p in split for i in encoder._number(p)] == encoder.encode(text.replace("▁", " ")[1:])


def test_a_piece_that_does_not_suit_gives_way(encoder):
    longest = [p for p in encoder.score if len(p) > 4 and encoder.merge(p) == [p]][:2000]
    rng = random.Random(5)
    taken_back = 0
    for _ in range(500):
        text = rng.choice(longest) + rng.choice(longest)[1:]
        split = encoder.split(text)
        assert split == encoder.merge(text)
        taken_back += split[0] != encoder._longest(text)[0]
    assert taken_back


def test_the_piece_that_suits_is_found_by_one_look(encoder):
    """Kept is what a pair comes to, the longest beginning that suits, and not only whether it suits."""
    encoder.encode("unsuitable neighbours, give way! Straße; 12345")
    for (left, piece), found in list(encoder.suits.items())[:2000]:
        while piece is not None:
            alone = [piece] if left is None else [left, piece]
            if encoder.merge("".join(alone)) == alone:
                break
            piece = encoder.shorter.get(piece)
        assert found == piece


def test_the_cache_may_be_emptied_at_any_time(monkeypatch):
    monkeypatch.setattr(pieces, "MOST_KEPT", 3)
    small = pieces.Encoder(MODEL)
    text = "many different words make the cache overflow again and again " * 3
    assert small.encode(text) == small.library.encode(text)
    assert max(len(small.found), len(small.older), len(small.suits)) <= 4


def test_digests_of_odd_rows(spark, odd, encoder):
    got = Counter(tuple(r) for r in pieces.digests(odd.withColumn("ids", F.lit(1)), MODEL).collect())
    expected = Counter()
    for row in odd.collect():
        ids = encoder.library.encode(row.text or "")
        expected[(row.doc_id, len(ids), hexed(",".join(map(str, ids))), hexed(encoder.library.decode(ids)))] += 1
    assert got == expected
    assert pieces.digests(odd.limit(0), MODEL).count() == 0


def test_encode_and_decode_keep_rows_and_columns(spark, odd, encoder):
    rows = pieces.decode(pieces.encode(odd.withColumn("ids", F.lit("x")), MODEL), MODEL).collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert row.ids == encoder.library.encode(row.text or "")
        assert row.decoded == encoder.library.decode(list(row.ids))
    assert rows[0].__fields__ == ["doc_id", "text", "lang", "source", "ids", "decoded"]


def test_op11_on_a_folder(spark, data, encoder):
    rows = queries.QUERIES["op11_sentencepiece"](spark, data).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = encoder.library.encode(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hexed(",".join(map(str, ids))))
        assert row.decoded_sha256 == hexed(encoder.library.decode(ids))


# Fill in the middle

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def rearranged(doc_id, text, rate=50, spm=80, seed=42):
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, spm, units, size", [(50, 80, 2048, 1 << 14), (100, 50, 1, 3), (100, 0, 3, 1 << 14), (0, 0, 2, 5)])
def test_fill_in_middle_of_odd_rows(spark, odd, monkeypatch, rate, spm, units, size):
    small = odd if size > 5 else odd.where("length(text) < 6000 or text is null")
    monkeypatch.setattr(middle, "UNITS", units)
    monkeypatch.setattr(middle, "PIECE_BYTES", size)
    rows = middle.pieces(small.withColumn("place", F.lit(1)).withColumn("row_key", F.lit("k")), rate, spm)
    expected = [(r.doc_id, *rearranged(r.doc_id, r.text or "", rate, spm), r.text or "") for r in small.collect()]
    digests = Counter(tuple(r) for r in middle.digests(rows).collect())
    assert digests == Counter((*x[:5], hexed(x[5]), hexed(x[6])) for x in expected)
    texts = middle.restored(middle.outputs(rows)).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in texts) == Counter(expected)


def test_fill_in_middle_of_an_empty_table(spark, odd):
    rows = middle.pieces(odd.limit(0))
    assert middle.digests(rows).count() == 0 and middle.outputs(rows).count() == 0


def test_long_documents_leave_as_many_pieces(spark):
    text = "word " * 50_000 + "x" * 100_000
    rows = middle.pieces(spark.createDataFrame([(7, text)], "doc_id long, text string"), rate=100)
    assert rows.count() > 20
    assert max(len(x) for x in (r.piece for r in rows.select("piece").collect())) <= 1 << 14
    row = middle.digests(rows).first()
    assert row.restored_sha256 == hexed(text) and row.form != "plain"


def test_restoring_sorts_without_a_second_shuffle(spark, odd):
    plan = middle.digests(middle.pieces(odd))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2


# Source divergence


def audited(rows, least=10, top=10):
    """The contract, word for word."""
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, docs, groups = {}, Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = Counter(term.findall((text or "").translate(lower)))
        counts.setdefault((lang, source), Counter()).update(words)
        docs.update((lang, w) for w in words)
    found = []
    for lang in {x for x, _ in groups}:
        kept = sorted(w for (x, w), n in docs.items() if x == lang and n >= least)
        mine = sorted(s for x, s in groups if x == lang)

        def shares(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(counts[lang, s]) for s in mine}
        q = shares(sum((counts[lang, s] for s in mine), Counter()))
        for s in mine:
            pair = [(o, sum(gap(p[s][w], p[o][w]) for w in kept)) for o in mine if o != s]
            terms = [(w, gap(p[s][w], q[w])) for w in kept if counts[lang, s][w] > 0 and p[s][w] > q[w]]
            for part, items, most in (("pair", pair, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, w, v, i) for i, (w, v) in enumerate(items[:most], 1)]
    return Counter(found)


def made(seed, documents, sources, words):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{'é' * (i // 26)}" for i in range(words)]
    rows = []
    for i in range(documents):
        own = rng.randrange(sources)
        text = " ".join(rng.choice(vocabulary[own % 7:]) for _ in range(rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "de", "en"]), f"s{own}"))
    return rows


@pytest.mark.parametrize("sources, block, terms", [(9, 48, 4096), (9, 2, 8), (30, 4, 16), (1, 48, 4096)])
def test_audit_equals_the_contract(spark, monkeypatch, sources, block, terms):
    monkeypatch.setattr(divergence, "LEAVES", 512)
    monkeypatch.setattr(divergence.pair_sums, "__defaults__", (block, terms))
    rows = made(sources, 150, sources, 60)
    rows += [(900, None, "en", "silent"), (901, "rare", "xx", "a"), (902, "", "xx", "b"), (None, "W A B", None, None)]
    rows += [(903, "a b c A", "fr", "x")] * 12 + [(904, "a", "fr", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit(1)).withColumn("count", F.lit(2))
    assert Counter(tuple(r) for r in divergence.audit(df).collect()) == audited(rows)


def test_audit_sends_its_counts_when_it_holds_many(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MOST_HELD", 10)
    rows = made(5, 60, 4, 30)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    assert Counter(tuple(r) for r in divergence.audit(df, 5, 3).collect()) == audited(rows, 5, 3)


def test_audit_of_an_empty_table(spark, odd):
    assert divergence.audit(odd.limit(0)).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    rows = [(3 * 10**14 + 1, 7 * 10**15 + 3, 9999991), (0, 0, 1), (5, 5, 1)]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.share("c", "n", "v")).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_zero_quadrants_are_not_walked(monkeypatch):
    """The leaves that are met are those with a count, whatever the number of terms."""
    rng = np.random.default_rng(1)
    levels, squares = 4, 50
    rows, columns = np.unique(rng.integers(0, [[10], [16 * squares]], (2, 60)), axis=1)
    values = rng.integers(1, 10**6, len(rows))
    tree = divergence.Tree(rows, columns, values, levels, squares)
    zero = rng.integers(1, 10**6, 10)
    i, j, total, met = divergence.walk(tree, tree, zero, zero, levels, squares, True)
    full = np.tile(zero[:, None], (1, 16 * squares))
    full[rows, columns] = values
    counted = np.zeros(full.shape, dtype=bool)
    counted[rows, columns] = True
    assert all(i < j)
    for a, b, t, n in zip(i, j, total, met):
        either = counted[a] | counted[b]
        assert n == either.sum()
        assert t == ((full[a] - full[b]) ** 2 // (full[a] + full[b]))[either].sum()
    assert len(tree.bits) == levels and sum(len(x) for x in tree.bits) < 16 * 16 * squares


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_source_divergence"])
def test_query_equals_sql(spark, data, name):
    assert differences(queries.QUERIES[name](spark, data), data, queries.SQL[name]) == []
