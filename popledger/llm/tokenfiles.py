"""Token-id files: independent zstandard frames with a trailing seek table, read document by document.

A file holds the ids of consecutive documents as one stream of little-endian unsigned integers (16 bits if the vocabulary
fits, else 32), cut into frames of ``FRAME_TOKENS`` ids that are compressed on their own. One more frame holds the document table
(ids and token counts). The file ends with a seek table in a skippable frame: compressed size, size and checksum (low 32 bits of
XXH64) of every frame, then their number, a flag byte and the magic number, as in the seekable zstandard format, so
any zstandard reader can read the whole and ours only what it needs.

Files are written by the tasks of one range-partitioned job, ordered by document id within and across files; a repeated task
writes a file of its own, and only files in the manifest count. Memory of a task is one batch of texts and one frame.

Defined results: a null or empty text has the end id only; rows with equal ids follow each other, in the order of
their texts' digests; rows without an id come last, in that order as well; an empty table gives an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from popledger.llm.common import keyed, lean, numbered, prepare, text_bytes, unnumbered
from popledger.llm.pretokens import BatchEncoder

FRAME_TOKENS = 1 << 16
FILE_BYTES = 32 << 20
# fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "path string, first_id bigint, last_id bigint, n_docs bigint, n_tokens bigint, width int"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


@lru_cache(maxsize=2)
def library_encoder(path: str) -> BatchEncoder:
    """Pieces are encoded by the tokenizers library itself."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}

    def encode(pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    return BatchEncoder(encode, special)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def open_file(path: str, mode: str):
    """A file of the shared folder, by path or URI of any file system that Arrow knows."""
    scheme = urlparse(path).scheme
    if scheme in ("", "file"):
        return open(urlparse(path).path if scheme else path, mode)
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_output_stream(inner) if "w" in mode else fs.open_input_file(inner)


class Writer:
    """Writes one file, frame by frame."""

    def __init__(self, path: str, width: int):
        self.file, self.width, self.kind = open_file(path, "wb"), width, "<u2" if width == 2 else "<u4"
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.docs: list[tuple[int, int]] = []

    def frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.file.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids.astype(self.kind))
        self.n_held += len(ids)
        if self.n_held >= FRAME_TOKENS:
            self.flush()

    def flush(self, final: bool = False) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        whole = len(ids) if final else len(ids) // FRAME_TOKENS * FRAME_TOKENS
        for i in range(0, whole, FRAME_TOKENS):
            self.frame(ids[i : min(i + FRAME_TOKENS, whole)].tobytes())
        self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def close(self) -> int:
        """Number of ids written."""
        self.flush(final=True)
        ids, sizes = (np.array([d[i] for d in self.docs], dtype="<i8") for i in (0, 1))
        self.frame(ids.tobytes() + sizes.tobytes())
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()
        return int(sizes.sum())


class Reader:
    """Reads the documents of one file; a frame is fetched, checked and decompressed only when it is needed."""

    def __init__(self, path: str, width: int):
        self.file, self.width, self.kind = open_file(path, "rb"), width, "<u2" if width == 2 else "<u4"
        self.file.seek(0, 2)
        end = self.file.tell()
        self.file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table with checksums")
        self.file.seek(end - 9 - 12 * n)
        self.frames = np.frombuffer(self.file.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.at = np.cumsum(self.frames[:, 0]) - self.frames[:, 0]
        self.decompressor = zstandard.ZstdDecompressor()
        self.read_frames = 0
        self.recent: tuple[int, np.ndarray] = (-1, np.zeros(0, self.kind))
        table = np.frombuffer(self._frame(n - 1), dtype="<i8")
        self.doc_ids, self.sizes = np.split(table, 2)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _frame(self, i: int) -> bytes:
        self.file.seek(int(self.at[i]))
        data = self.decompressor.decompress(self.file.read(int(self.frames[i, 0])), max_output_size=max(int(self.frames[i, 1]), 1))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        self.read_frames += 1
        return data

    def tokens(self, i: int) -> np.ndarray:
        if self.recent[0] != i:
            self.recent = (i, np.frombuffer(self._frame(i), dtype=self.kind))
        return self.recent[1]

    def ids(self, number: int) -> np.ndarray:
        """Ids of the number-th document of the file."""
        a, b = int(self.starts[number]), int(self.starts[number] + self.sizes[number])
        parts = [self.tokens(i)[max(a - i * FRAME_TOKENS, 0) : b - i * FRAME_TOKENS] for i in range(a // FRAME_TOKENS, -(-b // FRAME_TOKENS))]
        return np.concatenate(parts).astype("<u4") if parts else np.zeros(0, "<u4")

    def close(self) -> None:
        self.file.close()


def write(docs: DataFrame, folder: str, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts and write them in order of their ids. The manifest: one row per file."""
    spark = prepare(docs.sparkSession)
    width = 2 if max(vocabulary_size(path), end_id + 1) <= 1 << 16 else 4
    texts = numbered(keyed(docs, key, text))
    files = max(1, -(-text_bytes(texts) // FILE_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer = library_encoder(path), None
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.tokens.zst"
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode([x or "" for x in batch.column(1).to_pylist()]), strict=True):
                writer = writer or Writer(name, width)
                writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer:
            n = writer.close()
            row = [[name], [writer.docs[0][0]], [writer.docs[-1][0]], [len(writer.docs)], [n], [width]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds)], names=["path", "first_id", "last_id", "n_docs", "n_tokens", "width"])

    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    # rows of one id, or of none, in the order of their texts' digests: so they are spread over files as well
    placed = texts.withColumn("place", F.xxhash64("text")).repartitionByRange(int(files), "doc_id", "place")
    return placed.sortWithinPartitions("doc_id", "place").drop("place").mapInArrow(lean(run), MANIFEST)


def read(manifest: DataFrame, only: list[int] | None = None) -> DataFrame:
    """Documents of the files with the number of ids before each; with ``only``, those documents and no other frames."""
    before = Window.orderBy("first_id", "path").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", "width", "first_id", "last_id", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before"))
    if only is not None:
        files = files.where(F.exists(F.array(*[F.lit(int(i)) for i in only]).cast("array<bigint>"), lambda i: i.between(F.col("first_id"), F.col("last_id"))))
    wanted = None if only is None else np.array(sorted(only), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, width, before in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                reader = Reader(path, width)
                chosen = np.arange(len(reader.doc_ids)) if wanted is None else np.flatnonzero(np.isin(reader.doc_ids, wanted))
                for i in range(0, len(chosen), 256):
                    part = chosen[i : i + 256]
                    ids = [reader.ids(int(k)).tobytes() for k in part]
                    yield pa.record_batch(
                        [pa.array(reader.doc_ids[part]), pa.array(before + reader.starts[part]), pa.array(reader.sizes[part]), pa.array(ids, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                reader.close()

    # a number of its own: the few bytes of a manifest would else be read, with all files behind them, by one task
    spread = files.select("path", "width", "before").repartition(max(1, manifest.count()), F.col("path"))
    return unnumbered(spread.mapInArrow(lean(run), DOCUMENTS))


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
