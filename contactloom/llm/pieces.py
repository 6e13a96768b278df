"""Encoding and decoding with the pieces and scores of a SentencePiece model, by Aho-Corasick and Viterbi.

One automaton over all pieces reads a text once. At each position its output links name every piece that ends there,
and each relaxes the best score of that position: best[end] = max(best[end - length] + score), the longer piece on
ties. A character with no piece of its own is a step of its bytes, at a score below all pieces.

Spaces are written as U+2581, one more stands before the text. No piece of the model goes from another character on to
a U+2581, so the best path of a text is the best paths of its words, and each distinct word is walked once. A U+2581
in the text itself is spelled in bytes, so decoding gives back every text exactly.

Edge cases: doc_id is cast to long (an id that is no number fails or is null, by Spark's ANSI setting); a null text counts as empty; an empty text has no ids; repeated rows give equal results; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.units import UnitEncoder, chunks

SPACE = "\u2581"
MODEL = "piece_bpe_32k.model"


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """Pieces, scores, the automaton, and the Viterbi walk."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.bytes = [0] * 256
        self.spelled: list[bytes] = []
        self.words: dict[str, tuple[int, float]] = {}
        low = 0.0
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.spelled.append(b"")
            else:
                self.words[piece] = (i, sp.get_score(i))
                low = min(low, sp.get_score(i))
                self.spelled.append(piece.replace(SPACE, " ").encode())
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.words):
            raise ValueError("pieces that go on to a space can't be encoded by words")
        self.unknown = low - 10
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.words.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.singles = {p for p in self.words if len(p) == 1}
        self.lengths = np.array([len(s) for s in self.spelled], np.int64)
        self.begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.lengths)[:-1]])
        self.all = np.frombuffer(b"".join(self.spelled), np.uint8)

    def walk(self, text: str) -> tuple[list[int], float]:
        """(ids, score) of the best path over a text in which spaces are U+2581."""
        n = len(text)
        best, via = [float("-inf")] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        at = 0  # positions up to here are settled
        singles, unknown = self.singles, self.unknown

        def settle(to: int) -> None:
            nonlocal at
            while at < to:
                at += 1
                if text[at - 1] not in singles and best[at - 1] + unknown > best[at]:
                    best[at], via[at] = best[at - 1] + unknown, (1, -1)

        for end, (length, score, i) in self.automaton.iter(text):
            settle(end)
            got, old = best[end + 1 - length] + score, best[end + 1]
            if got > old or got == old and length > via[end + 1][0]:
                best[end + 1], via[end + 1] = got, (length, i)
        settle(n)
        out: list[int] = []
        p = n
        while p:
            length, i = via[p]
            if i < 0:
                out += [self.bytes[b] for b in reversed(text[p - 1].encode())]
            else:
                out.append(i)
            p -= length
        return out[::-1], best[n]

    def encode(self, text: str) -> list[int]:
        """ids of any text, in one walk for each stretch free of U+2581."""
        if not text:
            return []
        out: list[int] = []
        for k, part in enumerate(text.split(SPACE)):
            if k:
                out += [self.bytes[b] for b in SPACE.encode()]
            out += self.walk(SPACE * (k == 0) + part.replace(" ", SPACE))[0]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text, by gathering the pieces' bytes."""
        size = self.lengths[ids]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        place = np.arange(total, dtype=np.int64) + np.repeat(self.begins[ids] - (stop - size), size)
        raw = self.all[place].tobytes()
        return raw[1:].decode() if raw[:1] == b" " else raw.decode()


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


class PieceEncoder:
    """Encodes many texts, each distinct word once."""

    PLAIN = re.compile(f"^ |  |{SPACE}")

    def __init__(self, path: str):
        self.model = load(path)
        walk = self.model.walk
        self.units = UnitEncoder(lambda t: pc.split_pattern(t, " "), lambda units: [walk(SPACE + u)[0] for u in units])

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """ids of each text, in order."""
        plain = [bool(t) and not self.PLAIN.search(t) for t in texts]
        quick = self.units([t for t, p in zip(texts, plain, strict=True) if p])
        for t, p in zip(texts, plain, strict=True):
            yield next(quick) if p else np.asarray(self.slow(t), np.uint32)

    def slow(self, text: str) -> list[int]:
        """Texts with runs of spaces or a U+2581: cut where a run of spaces begins."""
        if not text:
            return []
        out: list[int] = []
        for k, part in enumerate(text.split(SPACE)):
            if k:
                out += [self.model.bytes[b] for b in SPACE.encode()]
            whole = SPACE * (k == 0) + part.replace(" ", SPACE)
            for unit in re.findall(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+", whole):
                out += self.model.walk(unit)[0]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, n_byte_ids, decoded_sha256): ids, and the text decoded from them, as digests."""
    kinds = {"doc_id": pa.int64(), "n_ids": pa.int64(), "ids_crc32": pa.int64(), "n_byte_ids": pa.int64(), "decoded_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        model = encode.model
        is_byte = np.zeros(model.size, np.bool_)
        is_byte[model.bytes] = True
        for batch in batches:
            for rows in chunks(batch):
                out = []
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encode(rows.column("text").to_pylist()), strict=True):
                    raw = ids.astype("<u4").tobytes()
                    digest = hashlib.sha256(model.decode(ids).encode()).hexdigest()
                    out.append((doc_id, len(ids), zlib.crc32(raw), int(is_byte[ids].sum()), digest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, n_byte_ids long, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every whole document encoded, and decoded from its ids."""
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_path(MODEL))
