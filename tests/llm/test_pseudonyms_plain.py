"""Pseudonyms of numbers and dates against a plain Python pseudonymiser, and language ID against a
plain one; every registered query of the training-data part is run once on a small folder."""

import datetime
import hashlib
import re

import numpy as np
import pytest

from candlegrowth.llm import langid, pseudonyms, queries

KEY = "a key"


def _hash(*parts):
    return int(hashlib.sha256("|".join([KEY, *map(str, parts)]).encode()).hexdigest()[:12], 16)


def _number(number, split, kind):
    x, y, mx, my = number % split[0], number // split[0], *split
    for turn in range(1, pseudonyms.ROUNDS + 1):
        x, y, mx, my = y, (x + _hash(kind, turn, y)) % mx, my, mx
    return x + y * mx


def _text(text, kind):
    x, y = list(text[:len(text) // 2]), list(text[len(text) // 2:])
    for turn in range(1, pseudonyms.ROUNDS + 1):
        moved = []
        for i, c in enumerate(x):
            for alphabet in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "αβγδεζηθ", "κλ"):
                if c in alphabet:
                    c = alphabet[(alphabet.index(c) + _hash(kind, turn, i, "".join(y))) % len(alphabet)]
                    break
            moved.append(c)
        x, y = y, moved
    return "".join(x + y)


def _refill(text, new, kept):
    left = iter(new)
    return "".join(next(left) if re.match(kept, c) else c for c in text)


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))


def plain(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "card":
        body = _text(digits[:-1], "card")
        return _refill(text, body + str(-_luhn(body + "0") % 10), "[0-9]") if _luhn(digits) % 10 == 0 else text
    if kind == "phone":
        own = digits[1:] if text.startswith("+") else digits
        mark = str.maketrans("2345678901", "αβγδεζηθκλ")
        new = _text(own[0].translate(mark) + own[1:3] + own[3].translate(mark) + own[4:], "phone")
        new = new.translate(str.maketrans("αβγδεζηθκλ", "2345678901"))
        return _refill(text, ("1" if text.startswith("+") else "") + new, "[0-9]")
    if kind == "address":
        a, b, c, d = map(int, text.split("."))
        new = _number((c * 256 + d) * 65536 + a * 256 + b, (65536, 65536), "address")
        low, high = new % 65536, new // 65536
        return f"{low // 256}.{low % 256}.{high // 256}.{high % 256}"
    if kind == "date":
        begin = datetime.date(2000, 1, 1)
        days = (datetime.date.fromisoformat(text) - begin).days
        block, rest = divmod(days, pseudonyms.CYCLE)
        new = _number(rest, pseudonyms.CYCLE_SPLIT, "date") + block * pseudonyms.CYCLE
        return (begin + datetime.timedelta(days=new)).isoformat()
    if kind == "ssn":
        area, group, serial = map(int, text.split("-"))
        rank = area - 2 if area > 666 else area - 1
        new = _number(rank + 898 * ((group - 1) + 99 * (serial - 1)), (898, 99 * 9999), "ssn")
        rank, rest = new % 898, new // 898
        return f"{rank + 2 if rank > 664 else rank + 1:03d}-{rest % 99 + 1:02d}-{rest // 99 + 1:04d}"
    local, host = text.split("@")
    return _refill(local, _text(re.sub("[^0-9A-Za-z]", "", local), "email"), "[0-9A-Za-z]") + "@" + host


VALUES = [
    ("card", "4111 1111 1111 1111"), ("card", "5500-0000-0000-0004"), ("phone", "(212) 555-8590"),
    ("phone", "+1 (152) 555-8590"), ("phone", "+1-045-555-0000"), ("phone", "415.555.2671"), ("address", "192.168.0.77"),
    ("date", "2024-02-29"), ("date", "1999-12-31"), ("ssn", "667-01-0001"), ("ssn", "123-45-6789"),
    ("email", "Jo.Doe42@example.org"), ("email", "x@y.de"),
]


def test_pseudonyms_are_those_of_plain_python(spark):
    rows = [(i, f"see {text}, and again {text}.") for i, (_, text) in enumerate(VALUES)]
    rows += [(100 + i, text) for i, (_, text) in enumerate(VALUES)]
    found = pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), KEY)
    got = {r["doc_id"]: r["_pseudonymised"] for r in found.collect()}
    for i, (kind, text) in enumerate(VALUES):
        new = plain(kind, text)
        assert new != text and len(new) >= 5
        assert got[i]["text"] == f"see {new}, and again {new}." and got[100 + i]["text"] == new
        assert re.fullmatch(pseudonyms.PATTERNS[kind], new)


def test_language_profiles_and_choice_are_those_of_plain_counting(spark, data):
    """Profiles as sums over all labelled documents that are not held out, and the nearest by cosine."""
    documents = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang").limit(300)
    rows = documents.collect()
    held = {r["doc_id"] for r in documents.where(langid.held_out()).collect()}

    def vector(text):
        total = np.zeros(langid.SIZE)
        total += langid.bundle([text], [0], 1)[0][0]
        return total

    vectors = {r["doc_id"]: vector(r["text"]) for r in rows}
    sums = {}
    for r in rows:
        if r["doc_id"] not in held and r["lang"] is not None:
            sums[r["lang"]] = sums.get(r["lang"], 0) + vectors[r["doc_id"]]
    names = sorted(sums)
    found = langid.identify(spark.createDataFrame(rows, documents.schema))
    for r in found.collect():
        own = vectors[r["doc_id"]]
        cosines = [own @ sums[x] / (np.linalg.norm(own) or 1) / np.linalg.norm(sums[x]) for x in names]
        best = int(np.argmax(cosines))
        if not own.any():
            assert tuple(r["_language"]) == ("und", 0.0)
        else:
            assert r["_language"]["score"] == pytest.approx(max(0, cosines[best]), abs=1e-9)
            assert cosines[names.index(r["_language"]["lang_pred"])] == pytest.approx(cosines[best], abs=1e-12)


COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op5": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
            "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op10": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
             "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_each_query_on_a_small_folder(spark, tmp_path, name):
    rows = [(i, f"text {i} with some words " * (1 + i % 4), "en" if i % 2 else "de", f"s{i % 3}", 9) for i in range(40)]
    rows += [(40, None, None, None, None), (41, "", None, "s0", 0), rows[3]]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "text 3 with some words text 3 with some words"), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.QUERIES[name](spark, str(tmp_path))
    wanted = COLUMNS.get(name.split("_")[0], {})
    assert wanted.items() <= dict(found.dtypes).items()
    rows = found.collect()
    if "op3" in name or "op7" in name or "op13" in name:
        return
    assert len(rows) == 43
    if "op6" in name:
        assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in rows)
