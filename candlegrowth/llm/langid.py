"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. A trigram is bound as the
product of its letters' vectors, the first rotated twice and the second once, so that order counts.
A text is bundled as the sum over its trigrams, a language as the sum over its texts, and a text is
given the language whose profile has the largest cosine with it.
"""

import hashlib
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlegrowth.llm.common import free_names, stored

SIZE = 1024  # numbers in a vector
SEED = b"letters-1"
PIECE = 1 << 16  # characters that are bundled at a time, of so many texts
PIECE_TEXTS = 64
BLOCK = 4096
GROUPS = 1024
MAX_LANGUAGES = 4096  # profiles are sent to every task: at most this many, 4 KB each
MIN_SCORE = 0.1  # cosine under which a text of MIN_CHARS or more is like no language
MIN_CHARS = 200
UNKNOWN = "und"
_BLANK = 32


def _letter(code):
    """The vector of a letter; a blank has one as well."""
    bits = hashlib.shake_256(SEED + int(code).to_bytes(4, "little")).digest(SIZE // 8)
    return 1 - 2 * np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).astype(np.int8)


def _letters(text):
    """Code points of the lower-cased text with one blank for each run of other characters, and at
    both ends; empty if there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    if not len(codes):
        return codes
    known, at = np.unique(codes, return_inverse=True)
    kinds = [unicodedata.category(chr(c))[0] for c in known.tolist()]
    if "L" not in kinds:
        return codes[:0]
    keep = np.array([k in "LM" for k in kinds])
    codes = np.concatenate([[_BLANK], np.where(keep[at], codes, _BLANK), [_BLANK]]).astype("<u4")
    return codes[np.concatenate([[True], (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)])]


def bundle(texts, groups, n_groups):
    """Sum of the trigram vectors per group, as an array (n_groups, SIZE) of whole numbers, and
    whether the group has a letter. Texts are taken in pieces, so memory does not grow with them."""
    sums, has = np.zeros((n_groups, SIZE)), np.zeros(n_groups, dtype=bool)
    held, length = [], 0
    for text, group in zip(texts, groups):
        if text is None:
            continue
        codes = _letters(text)
        if not len(codes):
            continue
        has[group] = True
        for s in range(0, max(1, len(codes) - 2), PIECE):
            piece = codes[s:s + PIECE + 2]
            held.append((piece, group))
            length += len(piece)
            if length >= PIECE or len(held) >= PIECE_TEXTS:
                _add(sums, held)
                held, length = [], 0
    if held:
        _add(sums, held)
    return sums, has


def _add(sums, held):
    codes = np.concatenate([x for x, _ in held])
    sizes = [len(x) for x, _ in held]
    row = np.repeat(np.arange(len(held)), sizes)
    known, at = np.unique(codes, return_inverse=True)
    n = len(known)
    inside = row[2:] == row[:-2]
    grams, which = np.unique(
        ((at[:-2] * n + at[1:-1]) * n + at[2:])[inside], return_inverse=True
    )
    cell = row[:-2][inside] * len(grams) + which
    counts = np.bincount(cell, minlength=len(held) * len(grams)).reshape(len(held), -1)
    third = np.array([_letter(c) for c in known.tolist()])
    second, first = np.roll(third, 1, axis=1), np.roll(third, 2, axis=1)
    found = np.zeros((len(held), SIZE))
    for s in range(0, len(grams), BLOCK):
        g = grams[s:s + BLOCK]
        bound = first[g // (n * n)] * second[g // n % n] * third[g % n]
        found += counts[:, s:s + BLOCK].astype(np.float32) @ bound.astype(np.float32)
    np.add.at(sums, [group for _, group in held], found)


def _train(batches):
    """(lang, bundle) sums of what a task reads, one row per language."""
    sums = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        names = sorted(set(langs))
        number = {x: i for i, x in enumerate(names)}
        for lang, total in zip(names, bundle(texts, [number[x] for x in langs], len(names))[0]):
            sums[lang] = sums[lang] + total if lang in sums else total
        if len(sums) > MAX_LANGUAGES:
            break
    names = list(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([sums[x].astype("i8").tolist() for x in names], pa.list_(pa.int64()))],
        ["lang", "bundle"],
    )


def profiles(labelled, text_column="text", lang_column="lang"):
    """Learns from all rows whose text and language are not NULL: (languages, unit vectors).

    The tasks' sums are added by Spark; only one vector per language comes to the driver. More than
    MAX_LANGUAGES languages are an error. Languages stand in code point order.
    """
    rows = labelled.select(
        F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")
    ).where("lang is not null and text is not null")
    sums = stored(
        rows.mapInArrow(_train, "lang string, bundle array<long>")
        .select("lang", F.posexplode("bundle").alias("at", "value"))
        .groupBy("lang", "at").agg(F.sum("value").alias("value")),
        "profiles",
    )
    count = sums.agg(F.countDistinct("lang")).first()[0]
    if count > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    found = {}
    for row in sums.collect():
        found.setdefault(row["lang"], np.zeros(SIZE))[row["at"]] = row["value"]
    names = sorted((x for x in found if found[x].any()), key=lambda x: x.encode())
    return names, np.array([found[x] / np.linalg.norm(found[x]) for x in names]).reshape(-1, SIZE)


def score(texts, names, vectors):
    """Language and cosine (0 to 1) of each text; ties go to the first name in code point order."""
    langs, scores = [], []
    for s in range(0, len(texts), GROUPS):
        part = texts[s:s + GROUPS]
        sums, has = bundle(part, range(len(part)), len(part))
        norms = np.linalg.norm(sums, axis=1)
        known = has & (norms > 0) & (len(names) > 0)
        cosines = sums @ vectors.T / np.where(norms > 0, norms, 1)[:, None]
        best = cosines.argmax(axis=1) if len(names) else np.zeros(len(part), dtype=int)
        langs += [names[b] if k else UNKNOWN for b, k in zip(best, known)]
        scores += [float(np.clip(cosines[i, b], 0, 1)) if k else 0.0 for i, (b, k) in enumerate(zip(best, known))]
    return langs, scores


def predictor(learned):
    """A column function text -> struct(lang_pred, score)."""
    names, vectors = learned

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores = score([x if isinstance(x, str) else None for x in texts], names, vectors)
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return predict


def held_out(id_column="doc_id", parts=3, part=1):
    """Whether crc32 of the id as text leaves the given remainder; false for a NULL id."""
    mark = F.crc32(F.col(id_column).cast("string").cast("binary")) % parts
    return F.coalesce(mark == part, F.lit(False))


def identify(documents, id_column="doc_id", text_column="text", lang_column="lang", into="_language"):
    """All columns of the documents and `into`, a struct of lang_pred and score.

    Learns from the text and non-NULL language of the rows that are not held out. A text that is
    NULL or has no letter, and any text if nothing could be learned, is `und` with score 0. Only
    the text is used in a prediction, so repeated texts get equal results.
    """
    learned = profiles(documents.where(~held_out(id_column)), text_column, lang_column)
    return _identified(documents, learned, text_column, into)


def _identified(documents, learned, text_column, into):
    return documents.withColumn(into, predictor(learned)(F.col(text_column).cast("string")))


def keep_identified(
    documents, id_column="doc_id", text_column="text", lang_column="lang", min_score=MIN_SCORE, min_chars=MIN_CHARS
):
    """The documents, all columns, whose text has a letter and is like some language: texts of
    min_chars or more need a cosine of min_score. Shorter ones are too short to be judged by it and
    stay. The profiles are learned from the documents themselves.

    Where no document names a language, nothing can be learned, and every text with a letter stays.
    NULL and empty texts go; repeated rows stay or go together; very long texts are read whole; an
    empty table gives none; no column is added, so none can clash.
    """
    learned = profiles(documents.where(~held_out(id_column)), text_column, lang_column)
    if not len(learned[0]):
        return documents.where(F.col(text_column).rlike(r"\p{L}"))
    (name,) = free_names(documents, 1)
    found = _identified(documents, learned, text_column, name)
    like = (F.col(f"{name}.score") >= min_score) | (F.length(text_column) < min_chars)
    return found.where((F.col(f"{name}.lang_pred") != UNKNOWN) & like).drop(name)


def op1_language_id(spark, folder):
    """The predicted language of every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return identify(documents.select("doc_id", "text", "lang")).select(
        "doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score"
    )
