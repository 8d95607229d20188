"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

A text gets a leading blank, and blanks become U+2581. While the automaton reads it, every state is reached by the longest
piece prefix that ends there; its output links name all pieces that end at this position, and each of them relaxes the best
score of the position. Following the best predecessors back gives the segmentation of greatest total score. Equal totals
go to the longer last piece. Characters that no piece covers, and a U+2581 of the text itself, are spelt as byte pieces, so
decoding returns exactly the text that went in.

No piece of a model spans certain neighbouring characters, above all a letter followed by a blank. The best path of a text
is then the best paths of what lies between, joined; they are cut there and each distinct part is solved once per task,
in a cache of bounded size. A model whose pieces span such neighbours is simply cut nowhere.

Null texts give null ids; an empty text gives no ids.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from array import array
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.llm.common import fresh, kept_by, with_results

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CACHED = 150_000
PASSING = 50_000
MOST_PIECES = 1_000_000
#: What spelling one byte costs; lower than any ordinary piece, so bytes are used where no piece fits.
BYTE_SCORE = -1e6
#: Scores below this cannot be log probabilities of a vocabulary; they are ranks.
RANKED = -1000


class Cache(dict):
    """Ids of solved parts, as bytes of 32-bit numbers. The first parts stay, as frequent ones come early; later ones pass through."""

    def __init__(self) -> None:
        super().__init__()
        self.passing: list[str] = []

    def put(self, part: str, found: bytes) -> None:
        self[part] = found
        if len(self) > CACHED:
            self.passing.append(part)

    def trim(self) -> None:
        """Between texts: forget what passed through, once it is many parts."""
        if len(self.passing) > PASSING:
            for part in self.passing:
                del self[part]
            self.passing.clear()


@dataclass
class Vocabulary:
    """Pieces with their ids and scores, and the ids of the 256 byte pieces."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]

    def __post_init__(self) -> None:
        self.text_of = {number: piece.replace(BLANK, " ").encode() for piece, (number, _) in self.pieces.items()}
        self.text_of |= {number: bytes([byte]) for byte, number in enumerate(self.byte_ids)}
        inside = {piece[i : i + 2] for piece in self.pieces for i in range(len(piece) - 1)}
        self.cut = self._pattern(inside)
        self.machine = None

    @staticmethod
    def _pattern(inside: set[str]) -> re.Pattern | None:
        """Parts between places that no piece spans; they concatenate to the whole text.

        A part is a line end, or blanks with what follows up to the next blank or line end. Letters are also cut from
        a sign after them, if no piece has a letter before that sign.
        """
        if any(pair[1] == BLANK and pair[0] != BLANK or "\n" in pair for pair in inside):
            return None
        joined = {pair[1] for pair in inside if pair[0].isalpha()}
        stops = "".join(sign for sign in string.punctuation + string.digits if sign not in joined)
        letters = r"[^\W\d_]++"
        return re.compile(rf"\n|{BLANK}*+{letters}(?=[{re.escape(stops)}{BLANK}\n]|\Z)|{BLANK}*[^{BLANK}\n]+|{BLANK}+")

    def automaton(self) -> ahocorasick.Automaton:
        if self.machine is None:
            machine = ahocorasick.Automaton()
            for piece, (number, score) in self.pieces.items():
                machine.add_word(piece, (len(piece), number, score))
            if len(machine):
                machine.make_automaton()
            self.machine = machine
        return self.machine

    def __getstate__(self) -> dict:
        return self.__dict__ | {"machine": None}

    def best(self, part: str) -> list[int]:
        """Ids of the best segmentation of a text in which every U+2581 stands for a blank."""
        n = len(part)
        machine = self.automaton()
        score = [0.0] + [float("-inf")] * n
        start_of, piece_of = [0] * (n + 1), [-1] * (n + 1)
        at = 0  # positions up to here have their final score
        for last, (length, number, value) in machine.iter(part) if len(machine) else ():
            while at < last:
                if score[at + 1] < score[at] + BYTE_SCORE:
                    self._spell(part, at, score, start_of, piece_of)
                at += 1
            end = last + 1
            start = end - length
            total = score[start] + value
            if total > score[end] or total == score[end] and start < start_of[end]:
                score[end], start_of[end], piece_of[end] = total, start, number
        for at in range(at, n):
            if score[at + 1] < score[at] + BYTE_SCORE:
                self._spell(part, at, score, start_of, piece_of)
        ids: list[int] = []
        while n:
            start = start_of[n]
            if piece_of[n] >= 0:
                ids.append(piece_of[n])
            else:
                ids += [self.byte_ids[b] for b in reversed(part[start:n].replace(BLANK, " ").encode())]
            n = start
        ids.reverse()
        return ids

    @staticmethod
    def _spell(part: str, at: int, score: list[float], start_of: list[int], piece_of: list[int]) -> None:
        """The choice that each position always has: its last character in bytes."""
        total = score[at] + BYTE_SCORE * len(part[at].encode())
        if total > score[at + 1]:
            score[at + 1], start_of[at + 1], piece_of[at + 1] = total, at, -1

    def encode(self, text: str, cache: Cache) -> np.ndarray:
        """Ids as 32-bit numbers."""
        if not text:
            return np.empty(0, np.int32)
        out: list[bytes] = []
        own = np.array([self.byte_ids[b] for b in BLANK.encode()], np.int32).tobytes()
        for i, stretch in enumerate((" " + text).split(BLANK)):  # no piece may cover a U+2581 of the text itself
            if i:
                out.append(own)
            marked = stretch.replace(" ", BLANK)
            parts = self.cut.findall(marked) if self.cut else [marked] if marked else []
            for part in [p for p in set(parts) if p not in cache]:
                cache.put(part, array("i", self.best(part)).tobytes())
            out += map(cache.__getitem__, parts)
            cache.trim()
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.text_of.__getitem__, ids.tolist()))[1:].decode("utf-8")


def vocabulary(model: str = MODEL) -> Vocabulary:
    """Pieces of a model file. Control, unknown and unused pieces never stand for text.

    Unigram models store log probabilities. Models made by merging store minus the rank of each merge, whose sum means
    nothing; by Zipf's law the probability is taken to fall with the rank.
    """
    reader = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, byte_ids = {}, {}
    if reader.get_piece_size() > MOST_PIECES:
        raise ValueError(f"a vocabulary may have up to {MOST_PIECES} pieces, as each task holds it")
    for number in range(reader.get_piece_size()):
        piece = reader.id_to_piece(number)
        if reader.is_byte(number):
            byte_ids[int(piece[1:-1], 16)] = number
        elif not (reader.is_control(number) or reader.is_unknown(number) or reader.is_unused(number)):
            pieces[piece] = (number, reader.get_score(number))
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces, so it cannot spell every text")
    if min((score for _, score in pieces.values()), default=0) < RANKED:
        total = math.log(sum(1 / rank for rank in range(1, len(pieces) + 1)))
        pieces = {piece: (number, -math.log(1 - min(score, 0)) - total) for piece, (number, score) in pieces.items()}
    return Vocabulary(pieces, [byte_ids[b] for b in range(256)])


def encoded(spark: SparkSession, text: Column, known: Vocabulary) -> Column:
    """Piece ids of each text as array<int>."""
    shared = spark.sparkContext.broadcast(known)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        words = shared.value
        offsets, parts, total, valid = [0], [], 0, []
        for text in texts:
            valid.append(text.is_valid)
            if text.is_valid:
                ids = words.encode(text.as_py(), kept_by("pieces", Cache))
                parts.append(ids)
                total += len(ids)
            offsets.append(total)
        values = pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32))
        mask = pa.array([not v for v in valid], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=mask)

    return encode(text)


def checked(spark: SparkSession, text: Column, known: Vocabulary) -> Column:
    """Number and SHA-256 of each text's ids (32-bit, little end first), and whether they decode to the text."""
    shared = spark.sparkContext.broadcast(known)

    @F.arrow_udf("struct<n_pieces:bigint,ids_sha256:string,same:boolean>")
    def check(texts: pa.Array) -> pa.Array:
        words = shared.value
        out = []
        for text in texts:
            if not text.is_valid:
                out.append({"n_pieces": None, "ids_sha256": None, "same": None})
                continue
            ids = words.encode(text.as_py(), kept_by("pieces", Cache))
            digest = hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()
            out.append({"n_pieces": len(ids), "ids_sha256": digest, "same": words.decode(ids) == text.as_py()})
        return pa.array(out, pa.struct([("n_pieces", pa.int64()), ("ids_sha256", pa.string()), ("same", pa.bool_())]))

    return check(text)


def decoded(spark: SparkSession, ids: Column, known: Vocabulary) -> Column:
    """The text of each array of piece ids."""
    shared = spark.sparkContext.broadcast(known)

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        words = shared.value
        return pa.array([words.decode(ids.values.to_numpy()) if ids.is_valid else None for ids in lists], pa.string())

    return decode(ids)


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """Docs with the piece ids of the text."""
    return with_results(docs, {ids_col: encoded(docs.sparkSession, F.col(text_col), vocabulary(model))})


def decode(docs: DataFrame, model: str = MODEL, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """Docs with the text of the piece ids."""
    return with_results(docs, {text_col: decoded(docs.sparkSession, F.col(ids_col), vocabulary(model))})


def summary(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """Docs with ``n_pieces``, ``ids_sha256`` and ``same``: :func:`round_trip` where the ids themselves are not wanted."""
    found = checked(docs.sparkSession, F.col(text_col), vocabulary(model))
    return with_results(docs, {name: found[name] for name in ("n_pieces", "ids_sha256", "same")})


def round_trip(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """Docs with ``piece_ids``, ``n_pieces`` and ``same``, whether decoding gives the text back; null where it is null."""
    back = fresh(docs, "decoded")
    both = decode(encode(docs, model, text_col), model, text_col=back)
    results = {"n_pieces": F.when(F.col(text_col).isNotNull(), F.size("piece_ids")), "same": F.col(back) == F.col(text_col)}
    return with_results(both, results).drop(back)
