"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here (a dozen fields of its wire format) and rebuilt as a
tokenizer: the normaliser's character map, the white-space marker, unigram scores or the
merge order that BPE scores stand for, and byte fallback.  Words are encoded in batches by
the library's threads, each distinct word once per task, when no piece of the model reaches
over a space; otherwise whole texts are.  What is encoded anew is encoded by the
sentencepiece library as well, and a document's ``parity`` says whether all agreed; or every whole
text is, and ``parity`` says whether its ids are the same.

Decoding joins the bytes that the ids stand for; ``round_trip`` says whether that gives
the normalised text again.

Defined cases: a null text is an empty one, which has no ids and round-trips; null ids and
repeated rows are carried along; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import handing_back
from claimworks.llm.word_encoding import CACHED_WORDS, WordEncoder

MARK = "▁"  # stands for a space (fixed value)
# Kinds of pieces and models in the model file (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
TEXTS = 500  # encoded together
THREADS = 2  # of one task
DIFFERING = 100_000  # words that may be noted to differ; beyond, these and all encodings are forgotten


@dataclass
class Spec:
    """What the model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown_id(self) -> int:
        return next(k for k, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value, shift = 0, 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {wire} is not used by model files")
        yield tag >> 3, value


def parse_model(data: bytes) -> Spec:
    """Pieces, trainer and normaliser settings of a serialized model (field numbers fixed)."""
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    spec.kind = v
                elif n == 35:
                    spec.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    spec.char_map = v
                elif n == 3:
                    spec.dummy_prefix = bool(v)
                elif n == 4:
                    spec.squeeze_spaces = bool(v)
                elif n == 5:
                    spec.escape_spaces = bool(v)
    if spec.kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {spec.kind} is neither unigram nor BPE")
    return spec


def merges(spec: Spec) -> list[tuple[str, str]]:
    """Pairs in the order in which they merge: by the score of what they make."""
    ids = {piece: k for k, (piece, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, score, kind in spec.pieces:
        if kind == NORMAL and len(piece) > 1:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in ids and right in ids:
                    found.append((-score, ids[piece], ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(spec: Spec):
    """The model as a tokenizer of the tokenizers library."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    unknown = spec.pieces[spec.unknown_id][0]
    if spec.kind == UNIGRAM:
        # control pieces never stand for text: names with a space match none that is escaped
        named = (NORMAL, USER_DEFINED, BYTE) if spec.escape_spaces else range(1, 7)
        scores = [
            (piece if kind in named else f" {k} ", score) for k, (piece, score, kind) in enumerate(spec.pieces)
        ]
        model = models.Unigram(scores, spec.unknown_id, spec.byte_fallback)
    else:
        vocabulary = {piece: k for k, (piece, _, _) in enumerate(spec.pieces)}
        model = models.BPE(
            vocabulary, merges(spec), unk_token=unknown, fuse_unk=True, byte_fallback=spec.byte_fallback
        )
    tokenizer = Tokenizer(model)
    tokenizer.encode_special_tokens = True
    user = [AddedToken(p, normalized=False) for p, _, kind in spec.pieces if kind == USER_DEFINED]
    if user:
        tokenizer.add_tokens(user)
    steps = []
    if spec.char_map:
        steps.append(normalizers.Precompiled(spec.char_map))
    if spec.squeeze_spaces:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if spec.escape_spaces else " "))
    if spec.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    after = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if spec.dummy_prefix:
        after.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(after)
    return tokenizer


def splits_at_spaces(spec: Spec) -> bool:
    """Whether texts may be encoded word by word: nothing is normalised away and no piece
    holds a space after something else."""
    inside = re.compile(f"[^{MARK}]{MARK}")
    return (
        not spec.char_map and not spec.squeeze_spaces and spec.dummy_prefix and spec.escape_spaces
        and not any(inside.search(piece) for piece, _, _ in spec.pieces)
        and not any(kind == USER_DEFINED for _, _, kind in spec.pieces)
    )


# Double spaces, spaces at an end and the marker itself are left to whole texts.
ODD = re.compile(f"  |^ | $|{MARK}")


class Codec:
    """Encodes, checks and decodes; one per task."""

    def __init__(
        self, model: bytes, threads: int = THREADS, verify: bool = True, whole: bool = False, words: int = CACHED_WORDS
    ) -> None:
        # read by the library when its thread pool starts
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.spec = parse_model(model)
        self.tokenizer = build_tokenizer(self.spec)
        self.by_piece, self.reference, self.differing = verify and not whole, None, set()
        if verify:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_word = splits_at_spaces(self.spec)
        self.encoder = WordEncoder(self._encoded, ODD, words)
        if not self.by_word:
            self.encoder.odd = re.compile("")  # every text whole
        self.bytes_of = [self._bytes_of(piece, kind) for piece, _, kind in self.spec.pieces]

    def _bytes_of(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(MARK, " ").encode()

    def _encoded(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.by_piece:
            known = self.reference.encode(texts, num_threads=1)
            self.differing.update(t for t, a, b in zip(texts, ids, known) if a != b)
        return [np.array(i, "<i4").tobytes() for i in ids]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.differing) > DIFFERING:
            # a word whose encoding is remembered has been compared, and its mark is kept as long
            self.differing.clear()
            self.encoder.words.forget()
        return [np.frombuffer(ids, "<i4") for ids in self.encoder(texts)]

    def agrees(self, text: str, ids: np.ndarray | None = None) -> bool:
        """Whether ``ids``, or what :meth:`encode` gives, are the sentencepiece library's of the whole text or, if
        pieces are compared, whether all that ``text`` was made of agreed with it."""
        if not self.by_piece:
            ids = self.encode([text])[0] if ids is None else ids
            return self.reference.encode(text) == ids.tolist()
        if not self.differing:
            return True
        if ODD.search(text) or not self.by_word:
            return text not in self.differing
        return self.differing.isdisjoint(text.split(" "))

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        text = b"".join([table[k] for k in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if self.spec.dummy_prefix and text.startswith(" ") else text

    def normalised(self, text: str) -> str:
        if self.by_word:
            return text.replace(MARK, " ")
        out = self.tokenizer.normalizer.normalize_str(text).replace(MARK, " ")
        return out[1:] if self.spec.dummy_prefix and out.startswith(" ") else out


@lru_cache(maxsize=1)
def codec_of(model: bytes, threads: int, verify: bool, whole: bool, words: int) -> Codec:
    """One codec per worker, whatever the number of its tasks."""
    return Codec(model, threads, verify, whole, words)


def _coder(model: Broadcast, threads: int, whole: bool, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value, threads, True, whole, words)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                # a word that differed may be forgotten only after its texts are judged
                ids = codec.encode(texts)
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate([np.zeros(0, "<i4"), *ids])
                trips = [codec.decode(i) == codec.normalised(t) for i, t in zip(ids, texts)]
                parity = [codec.agrees(t, i) for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_tokens": pa.array(np.diff(ends).astype(np.int64)),
                        "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        "parity": pa.array(parity, pa.bool_()),
                        "round_trip": pa.array(trips, pa.bool_()),
                    }
                )

    return run


def encode_documents(
    docs: DataFrame, model_path: str, threads: int = THREADS, whole: bool = False, words: int = CACHED_WORDS
) -> DataFrame:
    """doc_id, n_tokens, ids, parity and round_trip of every document.

    ``parity`` compares whole texts if ``whole`` is set, otherwise what they are made of.  ``model_path`` names a
    model file that the driver can read; it is broadcast (a MB or so).  A worker remembers the ids of at most
    twice ``words`` words; with fewer it needs less memory and encodes more anew.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(
        handing_back(_coder(model, threads, whole, words)),
        "doc_id long, n_tokens long, ids array<int>, parity boolean, round_trip boolean",
    )


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of encoded documents."""
    with open(model_path, "rb") as file:
        model = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value, THREADS, False, False, CACHED_WORDS)
        for batch in batches:
            texts = [codec.decode(np.array(i or [], "<i4")) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        handing_back(run), "doc_id long, text string"
    )
