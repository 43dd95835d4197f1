"""Token ids as Arrow stream files of fixed-size sequences.

Documents are encoded, ended by one id and laid end to end in ascending ``doc_id`` order.
Every range partition streams its ids into one Arrow stream file whose rows are sequences
of equal length (``tokens``: fixed-size list of the smallest unsigned type that holds the
vocabulary, ``mask``: fixed-size list of booleans, false where the last row is filled up),
in batches of equally many rows.  So a memory-mapped file gives any sequence as a view,
without a copy or a scan.  A second small stream per file holds its documents' spans.

A writer never holds more than one batch of rows.  Files are written under a name of the
attempt's own and listed by the rows that the task returns, so an attempt that is lost or
repeated leaves nothing that is read.

Defined cases: a null text is an empty one, which has the end id only; null ids come first;
rows that repeat an id follow each other; an empty table gives no file and an empty result;
other columns are ignored.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimworks.llm.word_encoding import Remembered
from claimworks.plans.workspace import fresh_path, write_table

LENGTH = 2048  # ids of a sequence
BATCH_ROWS = 128  # sequences of a batch
END_ID = 0
PIECE_BYTES = 8 << 20  # of text encoded at a time
JOINED = 1024  # words encoded as one text

# A space between two white spaces, or a last one after another: there the tokenizer's
# white-space runs may reach over the space.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"
ODD = f"{_WHITE} (?:{_WHITE}|$)"


def load_tokenizer(path: str) -> str:
    """The tokenizer file's text, to be broadcast (a few MB whatever the data)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def splits_at_spaces(settings: dict) -> bool:
    """Whether the tokenizer is the byte-level kind whose words begin at spaces."""
    before = settings.get("pre_tokenizer") or {}
    return (
        settings.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
    )


def vocabulary_type(size: int) -> np.dtype:
    return np.dtype("<u2") if size <= 2**16 else np.dtype("<u4")


# The byte-level kind's own way to part words, and its letters for the 256 bytes (fixed).
PARTS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Words that are parted here; what is classed by newer tables is left to the library.
LATIN = re.compile("[!-~\u00a1-\u024f]+")


def byte_letters() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for 256 and up in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (k for k in range(256) if k not in shown)
    return {k: chr(k) for k in shown} | {k: chr(256 + n) for n, k in enumerate(hidden)}


class Encoder:
    """Ids of texts by the tokenizers library.

    For a tokenizer that splits at spaces, a piece of many texts is parted at its spaces and
    its distinct words are encoded or remembered; the texts are put together again by their
    words' numbers.  The library's model is called on words that are already parted and
    spelled in byte letters, many at a time, which spares its tracing of offsets.
    """

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        settings = json.loads(source)
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = vocabulary_type(self.tokenizer.get_vocab_size())
        self.by_word = splits_at_spaces(settings)
        # texts that hold the string of an added token are left to the library as they are
        added = [re.escape(token["content"]) for token in settings.get("added_tokens") or []]
        self.odd = "|".join([ODD, *added])
        self.remembered = Remembered(self._words)
        if not self.by_word:
            return
        letters = byte_letters()
        self.spelling = letters | {0: letters[32], 32: " "}
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for piece, number in self.tokenizer.get_vocab().items():
            self.begins[number] = piece[0] == letters[32]
        bare = {**settings, "added_tokens": [], "pre_tokenizer": None, "post_processor": None}
        self.model = Tokenizer.from_str(json.dumps(bare))
        self.model.pre_tokenizer = pre_tokenizers.Split(" ", "removed")

    def _ids(self, tokenizer, texts: list[str]) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in found]

    def _spelled(self, words: list[str]) -> str:
        """Words after a space in byte letters; a space parts what the model must not join."""
        parted = [w if w.isalpha() else " ".join(PARTS.findall(" " + w)).lstrip(" ") for w in words]
        # no word holds a space or a control character, so \x00 can mark the leading space
        raw = ("\x00" + " \x00".join(parted)).encode().decode("latin-1")
        return raw.translate(self.spelling)

    def _words(self, words: list[str]) -> list[bytes]:
        """Words after a space, many in one text, cut again at the ids that hold the space."""
        out: dict[str, bytes] = {}
        latin = [w for w in words if LATIN.fullmatch(w)]
        groups = [latin[k : k + JOINED] for k in range(0, len(latin), JOINED)]
        width = self.dtype.itemsize
        for group, ids in zip(groups, self._ids(self.model, [self._spelled(g) for g in groups])):
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(group):
                raw, cuts = ids.tobytes(), [*(starts * width).tolist(), len(ids) * width]
                out.update(zip(group, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
        rest = [w for w in words if w not in out]
        out.update(zip(rest, (i.tobytes() for i in self._ids(self.tokenizer, [" " + w for w in rest]))))
        return [out[w] for w in words]

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of ids of each."""
        counts = np.zeros(len(texts), np.int64)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False).astype(bool)
        odd |= not self.by_word
        usual, parts = np.flatnonzero(~odd), {}
        whole = np.flatnonzero(odd)
        for k, ids in zip(whole, self._ids(self.tokenizer, texts.take(pa.array(whole)).to_pylist())):
            counts[k], parts[int(k)] = len(ids), ids
        flat = np.zeros(0, self.dtype)
        if len(usual):
            flat, counts[usual] = self._joined(texts.take(pa.array(usual)))
        if not len(whole):
            return flat, counts
        pieces = np.split(flat, np.cumsum(counts[usual])[:-1]) if len(usual) else []
        parts |= dict(zip(usual.tolist(), pieces))
        return np.concatenate([parts[k] for k in range(len(texts))]).astype(self.dtype), counts

    def _joined(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        # the word that begins a text has no space before it
        firsts = split.flatten().take(pa.array(bounds[:-1])).to_pylist()
        known = self.remembered(coded.dictionary.to_pylist())
        numbers = coded.indices.to_numpy().astype(np.int64)
        numbers[bounds[:-1]] = len(known) + np.arange(len(firsts))
        known += [ids.tobytes() for ids in self._ids(self.tokenizer, firsts)]
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        values = np.frombuffer(b"".join(known), self.dtype)
        found = pa.ListArray.from_arrays(pa.array(ends), pa.array(values)).take(pa.array(numbers))
        steps = np.concatenate([[0], np.cumsum(lengths[numbers])])
        return found.flatten().to_numpy(), np.diff(steps[bounds])


@lru_cache(maxsize=1)
def encoder_of(source: str) -> Encoder:
    """One encoder per worker, whatever the number of its tasks."""
    return Encoder(source)


def pieces_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``PIECE_BYTES`` of text."""
    sizes = pc.binary_length(batch.column("text")).to_numpy()
    piece = np.cumsum(sizes, dtype=np.int64) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def with_ends(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ids with the end id after each text."""
    out = np.full(len(ids) + len(counts), END_ID, ids.dtype)
    own = np.ones(len(out), bool)
    own[np.cumsum(counts) + np.arange(len(counts))] = False
    out[own] = ids
    return out


# --- files ----------------------------------------------------------------------


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema(
        [
            pa.field("tokens", pa.list_(pa.from_numpy_dtype(dtype), length), False),
            pa.field("mask", pa.list_(pa.bool_(), length), False),
        ]
    )


SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Lays ids end to end in a stream of equal sequences."""

    def __init__(self, sink: pa.NativeFile, dtype: np.dtype, length: int) -> None:
        self.schema, self.dtype, self.length = sequence_schema(dtype, length), dtype, length
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.waiting: list[bytes] = []
        self.size, self.total = 0, 0

    def write(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.size += len(ids)
        self.total += len(ids) // self.dtype.itemsize
        if self.size >= BATCH_ROWS * self.length * self.dtype.itemsize:
            self._flush(False)

    def _flush(self, end: bool) -> None:
        flat = np.frombuffer(b"".join(self.waiting), self.dtype)
        batch = BATCH_ROWS * self.length
        whole = len(flat) // batch * batch
        for at in range(0, whole, batch):
            self._batch(flat[at : at + batch], batch)
        left = flat[whole:]
        if end and len(left):
            self._batch(left, -(-len(left) // self.length) * self.length)
            left = left[:0]
        self.waiting = [left.tobytes()]
        self.size = len(self.waiting[0])

    def _batch(self, ids: np.ndarray, size: int) -> None:
        tokens, mask = np.zeros(size, self.dtype), np.zeros(size, bool)
        tokens[: len(ids)], mask[: len(ids)] = ids, True
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in (tokens, mask)
        ]
        self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of a file; views of the mapped file, not copies."""

    def __init__(self, uri: str) -> None:
        system, path = fs.FileSystem.from_uri(uri)
        local = isinstance(system, fs.LocalFileSystem)
        source = pa.memory_map(path) if local else system.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.rows = [len(b) for b in self.batches]

    def __len__(self) -> int:
        return sum(self.rows)

    def _at(self, column: int, index: int) -> pa.Array:
        # every batch but the last has the same number of rows
        first = self.rows[0]
        array = self.batches[index // first].column(column)
        width = array.type.list_size
        row = index % first
        return array.values.slice((array.offset + row) * width, width)

    def tokens(self, index: int) -> np.ndarray:
        return self._at(0, index).to_numpy(zero_copy_only=True)

    def mask(self, index: int) -> np.ndarray:
        return self._at(1, index).to_numpy(zero_copy_only=False)

    def packed_mask(self, index: int) -> np.ndarray:
        """The mask's bits, eight to a byte, the lowest first, as a view; for lengths of whole bytes."""
        mask = self._at(1, index)
        if mask.offset % 8 or len(mask) % 8:
            raise ValueError("the sequences' length is no multiple of 8")
        return np.frombuffer(mask.buffers()[1], np.uint8)[mask.offset // 8 :][: len(mask) // 8]

    def flat(self) -> np.ndarray:
        """All ids of the file without the filling."""
        parts = [b.column(0).flatten().to_numpy() for b in self.batches]
        real = [b.column(1).flatten().true_count for b in self.batches]
        return np.concatenate([p[:n] for p, n in zip(parts, real)]) if parts else np.zeros(0, "<u2")


def _writer(source: Broadcast, root: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = encoder_of(source.value)
                system, folder = fs.FileSystem.from_uri(root)
                system.create_dir(folder)
                name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                files = [f"{name}.tokens.arrows", f"{name}.spans.arrows"]
                sinks = [system.open_output_stream(f"{folder}/{f}") for f in files]
                writer = SequenceWriter(sinks[0], encoder.dtype, length)
                spans, documents = pa.ipc.new_stream(sinks[1], SPANS), 0
            for part in pieces_of(batch):
                ids, sizes = encoder.encode(part.column("text"))
                starts = writer.total + np.cumsum([0, *(sizes[:-1] + 1)])
                spans.write_batch(
                    pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array(starts, pa.int64()), pa.array(sizes + 1, pa.int64())],
                        schema=SPANS,
                    )
                )
                writer.write(with_ends(ids, sizes).tobytes())
                documents += len(sizes)
                pa.default_memory_pool().release_unused()
        if writer is not None:
            writer.close()
            spans.close()
            for sink in sinks:
                sink.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                    "tokens_file": [f"{root}/{files[0]}"], "spans_file": [f"{root}/{files[1]}"],
                    "documents": [documents], "n_tokens": [writer.total],
                }
            )

    return run


# Names of file systems in Spark, and of the same ones in pyarrow where they differ (fixed values).
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def as_uri(spark: SparkSession, path: str, shared: bool) -> str:
    """The path where Spark's default file system puts it, as pyarrow's file systems name it.

    A folder of the machine itself is refused on a cluster unless it is known to be ``shared``.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme, rest = system.makeQualified(target).toString().split(":", 1)
    master = spark.sparkContext.master
    if scheme == "file" and not shared and not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{path} lies on each machine itself; say shared=True if it is a shared mount")
    # one slash begins a path, two an authority
    rest = rest if rest.startswith("//") else f"//{rest}"
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def write_token_files(
    docs: DataFrame, tokenizer: str, root: str | None = None, length: int = LENGTH, shared: bool = False
) -> DataFrame:
    """Write the files below ``root`` and return their list in order.

    ``root`` is a folder that all machines see, by default one below ``spark.checkpoint.dir``; a ``file:``
    folder of a cluster's must be declared as ``shared``.

    ``tokenizer`` is the path of a tokenizer file.  The list has part, tokens_file,
    spans_file, documents, n_tokens and start (ids of all files before).
    """
    spark = docs.sparkSession
    # the work folder is shared by its setting
    root = as_uri(spark, root or fresh_path(spark, "token-files"), shared or root is None)
    source = spark.sparkContext.broadcast(load_tokenizer(tokenizer))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),  # parts the rows that repeat an id
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("row")]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part int, tokens_file string, spans_file string, documents long, n_tokens long"
    files = write_table(
        ranged.select("doc_id", "text").mapInArrow(_writer(source, root, length), schema), "token-list"
    )
    # a row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = SequenceFile(row["tokens_file"]).flat()
            system, path = fs.FileSystem.from_uri(row["spans_file"])
            with system.open_input_file(path) as source:
                for spans in pa.ipc.open_stream(source):
                    start, size = (spans.column(n).to_numpy() for n in ("start", "n_tokens"))
                    crcs = [
                        zlib.crc32(ids[a : a + n].astype("<u4").tobytes()) for a, n in zip(start, size)
                    ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": spans.column("doc_id"),
                            "start": pa.array(start + row["start"]),
                            "n_tokens": spans.column("n_tokens"),
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )


def _spread(files: DataFrame) -> DataFrame:
    """The list dealt out as widely as a shuffle is: small as it is, it stands for much."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part")


def read_spans(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    spread = _spread(files.select("part", "tokens_file", "spans_file", "start"))
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_sequences(files: DataFrame) -> DataFrame:
    """part, row, tokens and mask of every sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = 0
                for found in SequenceFile(row["tokens_file"]).batches:
                    count = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["part"]] * count, pa.int32()),
                            pa.array(range(at, at + count), pa.int64()),
                            found.column(0).cast(pa.list_(pa.int32())),
                            found.column(1).cast(pa.list_(pa.bool_())),
                        ],
                        names=["part", "row", "tokens", "mask"],
                    )
                    at += count

    schema = "part int, row long, tokens array<int>, mask array<boolean>"
    return _spread(files.select("part", "tokens_file")).mapInArrow(run, schema)
