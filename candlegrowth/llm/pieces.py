"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

A merge-type model joins the adjacent symbols whose joint piece has the best score, leftmost first,
until no two symbols join. What a row of pieces must fulfil for this to be its result is local: a
piece, and each two neighbours, must come out as they are when their text alone is merged anew. So
no queue of merges over the text is kept. The text is cut by the longest piece at each place (one
Aho-Corasick pass over the reversed text finds them all); a piece that does not suit its left
neighbour gives way to its next shorter beginning that is a piece, and where none is left the place
is marked in a bitfield as failed and the piece before it is taken back. Every place is failed once
at most, so the work is linear in the text.

No merge crosses two characters that stand side by side in no piece, so texts are cut there first,
and what stands between such cuts, mostly words, is encoded once per task and looked up afterwards.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from candlegrowth.llm.common import slices

SPACE = "▁"  # stands for a blank in pieces
MOST_KEPT = 300_000  # words and parts, and pairs of pieces, whose result is kept in a task
KEPT_CHARS = 64  # characters of the longest word that is kept
_NONE = float("-inf")  # the score of what is no piece
_RUNS = re.compile(r"▁*[A-Za-zÀ-ÖØ-öø-ɏ]+|.", re.DOTALL)  # Latin letters with the blanks before, or one character


class _Filled(dict):
    """A dictionary that asks a function for what it does not hold."""

    def __init__(self, of, held=()):
        super().__init__(held)
        self.of = of

    def __missing__(self, key):
        return self.of(key)


class Encoder:
    """A merge-type model with byte fallback. Pieces of the user-defined and unused types, which
    merge by other rules, are refused where the library tells them (unused)."""

    def __init__(self, path):
        import ahocorasick
        import sentencepiece

        self.library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.ids, bytes_ids = {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_ids[int(piece[1:-1], 16)] = i
            elif model.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not model.is_control(i) and not model.is_unknown(i):
                self.score[piece], self.ids[piece] = model.get_score(i), (i,)
        if len(bytes_ids) < 256:
            raise ValueError("the model must have a piece for each byte")
        self.bytes_ids = bytes_ids
        self.longest = ahocorasick.Automaton()
        for piece in self.score:
            self.longest.add_word(piece[::-1], piece)
        self.longest.make_automaton()
        self.shorter = {}
        for piece in self.score:
            ends = range(len(piece) - 1, 1, -1)
            self.shorter[piece] = next((piece[:e] for e in ends if piece[:e] in self.score), piece[:1])
            if len(piece) == 1:
                self.shorter[piece] = None
        self.joined = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        # Blanks begin words where no piece has one behind another character.
        self.words = not any(j[1] == SPACE != j[0] for j in self.joined)
        self.suits, self.found, self.older = {}, _Filled(self.word), {}
        self.ids = _Filled(self._number, self.ids)
        self.numbers = [str(i) for i in range(model.get_piece_size())]

    def merge(self, text):
        """The symbols that merging leaves of a short text."""
        symbols, score = list(text), self.score.get
        scores = [score(a + b, _NONE) for a, b in zip(symbols, symbols[1:])]
        while scores:
            best = max(scores)
            if best == _NONE:
                break
            at = scores.index(best)  # the leftmost
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(symbols[at - 1] + symbols[at], _NONE)
            if at < len(scores):
                scores[at] = score(symbols[at] + symbols[at + 1], _NONE)
        return symbols

    def _fit(self, left, piece):
        """The longest beginning of a piece that is a piece and stays as it is beside its left neighbour, or
        None; a first piece has None on its left."""
        alone = [piece] if left is None else [left, piece]
        if self.merge("".join(alone)) == alone:
            found = piece
        else:
            found = self.shorter.get(piece)
            if found is not None:
                key = left, found
                found = self.suits[key] if key in self.suits else self._fit(*key)
        if len(self.suits) >= MOST_KEPT:
            self.suits.clear()
        self.suits[left, piece] = found
        return found

    def _longest(self, text):
        """For each place the longest piece that begins there, or the character alone."""
        found, last, place = list(text), len(text) - 1, -1
        for end, piece in self.longest.iter(text[::-1]):  # of one end the longest comes first
            if end != place:
                place = end
                found[last - end] = piece
        return found

    def split(self, text):
        """The pieces of a text, by backtracking."""
        longest, size = self._longest(text), len(text)
        suits, shorter = self.suits, self.shorter
        failed = bytearray(size // 8 + 1)
        done, at, left = [], 0, None
        piece = longest[0] if size else None
        while at < size:
            while piece is not None:
                key = left, piece
                piece = suits[key] if key in suits else self._fit(left, piece)
                if piece is None:
                    break
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    break
                piece = shorter.get(piece)
            if piece is not None:
                done.append(piece)
                at, left = end, piece
                piece = longest[at] if at < size else None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = done.pop()
                at -= len(piece)
                left = done[-1] if done else None
        return done

    def _number(self, piece):
        known = self.ids.get(piece)
        return known or tuple(self.bytes_ids[b] for b in piece.encode())

    def _cut(self, word):
        """A word between the places that no merge crosses, but for those between Latin letters."""
        joined, parts, start, end = self.joined, [], 0, 0
        for run in _RUNS.findall(word):
            if end and word[end - 1] + run[0] not in joined:
                parts.append(word[start:end])
                start = end
            end += len(run)
        parts.append(word[start:])
        return parts

    def _ids(self, part):
        """The ids of what stands between two cuts."""
        if len(part) == 1:
            return list(self.ids[part])
        return list(chain.from_iterable(map(self.ids.__getitem__, self.split(part))))

    def word(self, word):
        """The ids of a word. Those of the last MOST_KEPT words and parts, and of the as many before
        them, are kept."""
        known = self.older.get(word)
        if known is None:
            if word[1:].isalpha():
                known = self._ids(word)
            else:
                known = []
                for part in self._cut(word):
                    ids = self.found.get(part) or self.older.get(part)
                    if ids is None:
                        ids = self._ids(part)
                        if len(part) <= KEPT_CHARS:
                            self.found[part] = ids
                    known = known + ids
        if len(word) <= KEPT_CHARS:
            if len(self.found) >= MOST_KEPT:
                self.older, self.found = self.found, _Filled(self.word)
            self.found[word] = known
        return known

    def _words(self, text):
        """The normalised text, cut before each run of blanks if pieces allow."""
        text = self.library.normalize(text)
        if not self.words:
            return [text] if text else []
        first, *parts = text.split(SPACE)
        if "" not in parts:
            words = [SPACE + part for part in parts]
            return [first, *words] if first else words
        # Blanks that follow one another stay with the word behind them.
        words, blanks = [first] if first else [], ""
        for part in parts:
            blanks += SPACE
            if part:
                words.append(blanks + part)
                blanks = ""
        if blanks:
            words.append(blanks)
        return words

    def encode(self, text):
        """The ids of a text, without begin and end."""
        return list(chain.from_iterable(map(self.found.__getitem__, self._words(text))))

    def joined_ids(self, ids):
        """The ids as decimal numbers joined by commas."""
        return ",".join(map(self.numbers.__getitem__, ids))


def encode(documents, path):
    """The documents with a column `ids` (array of int), the pieces of the whole `text`.

    `path` names the model file as the executors see it. NULL and empty texts give an empty array;
    all other columns and repeated rows stay as they are, and a column `ids` that is there is replaced.
    Very long texts are encoded whole; a batch for Python is cut by bytes.
    """

    @F.pandas_udf("array<int>")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(path)
        for texts in batches:
            yield pd.Series([[] if x is None else encoder.encode(x) for x in texts])

    return documents.withColumn("ids", ids_of(F.col("text")))


def decode(encoded, path):
    """The rows of `encode` with a column `decoded`, the text of `ids`; NULL ids give an empty text."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        for rows in batches:
            yield pd.Series(["" if x is None else library.decode([int(i) for i in x]) for x in rows])

    return encoded.withColumn("decoded", text_of(F.col("ids")))


def digests(documents, path):
    """One row per document: doc_id, n_tokens, ids_sha256 (of the ids joined by commas),
    decoded_sha256 (of the text decoded from them). NULL texts count as empty, repeated rows come
    again, other columns are not read, an empty table gives no rows. No shuffle."""

    def digest(batches):
        encoder = Encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    ids = encoder.encode(text or "")
                    rows.append((
                        len(ids), hashlib.sha256(encoder.joined_ids(ids).encode()).hexdigest(),
                        hashlib.sha256(encoder.library.decode(ids).encode()).hexdigest(),
                    ))
                n, ids, decoded = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op11_sentencepiece(spark, sf_dir):
    """The pieces of all documents in the public model of 32,000 merge-type pieces."""
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(documents, public_tokenizers.path("piece_bpe_32k.model"))
