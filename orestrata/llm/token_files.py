"""Token ids in files for random access: every document compressed by itself with one shared zstandard dictionary.

A file holds, in ascending doc_id order: HEAD and the dictionary's SHA-256; the documents' ids (unsigned 32-bit, little
endian), each a zstandard frame; the index (ids, null flags, offsets, numbers of ids); the index's place and END. A short
document is thus one look into the index and one ranged read. The dictionary is trained on the serialized ids of about
``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS`` characters, chosen by a hash; every document is encoded.

The documents are range-sorted by doc_id, and the tasks that sort them also encode and write. A file has a name of its
own for each attempt; the manifest, which Spark commits, says which files count, so a task that runs again does no harm.

Defined results: null text is empty and still gets its end id; a null doc_id comes first; rows with the same doc_id are
ordered by their text; an empty table gives no files and no rows. Other columns are not looked at.
"""
from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.common import new_folder, sample_texts, store, text_of
from orestrata.llm.tokens import encoder
from orestrata.session import in_arrow, staged

HEAD, END = b"TOKENS01", b"TOKENEND"
SAMPLE_DOCS, SAMPLE_CHARS = 1000, 20_000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
#: Bytes of compressed documents that a reader fetches at once.
READ_BYTES = 4 * 1024 * 1024


def _with_end(path: str, text: str, end_id: int) -> bytes:
    return encoder(path).encode_bytes(text) + struct.pack("<I", end_id)


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int):
    import zstandard

    samples = [_with_end(tokenizer, text, end_id) for text in sample_texts(docs, SAMPLE_DOCS, SAMPLE_CHARS)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few documents to learn from: the samples themselves
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents below ``folder``; the manifest: part (files ascend by it), file, n_docs, n_tokens, n_bytes."""
    spark = docs.sparkSession
    trained = train_dictionary(docs, tokenizer, end_id).as_bytes()
    digest = hashlib.sha256(trained).digest()
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/dictionary") as out:
        out.write(trained)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained))
        ids, nulls, counts, ends, at = [], [], [], [], len(HEAD) + len(digest)
        out = None
        for batch in batches:
            if batch.num_rows and out is None:
                files, root = store(folder)
                name = f"{part:06d}-{uuid.uuid4().hex}.tok"
                out = files.open_output_stream(f"{root}/{name}")
                out.write(HEAD + digest)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = _with_end(tokenizer, text, end_id)
                frame = press.compress(raw)
                out.write(frame)
                at += len(frame)
                ids.append(doc_id or 0)
                nulls.append(doc_id is None)
                counts.append(len(raw) // 4)
                ends.append(at)
        if out is None:
            return
        out.write(np.array(ids, "<i8").tobytes() + np.array(nulls, "u1").tobytes() + np.array(ends, "<u8").tobytes() + np.array(counts, "<u4").tobytes())
        out.write(struct.pack("<QQ", at, len(ids)) + END)
        size = out.tell()
        out.close()
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "file": [name], "n_docs": [len(ids)], "n_tokens": [int(sum(counts))], "n_bytes": [size]},
        )

    # rows of one id, or of none, are told apart by a hash, so that they may fill several ranges
    by_id = docs.select("doc_id", text_of().alias("text")).withColumn("turn", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("turn").asc()]
    by_id = by_id.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
    return staged(spark, by_id.transform(in_arrow, write, "part long, file string, n_docs long, n_tokens long, n_bytes long"), "token-files")


class TokenFile:
    """A reader of one file: its index, and documents by place or by doc_id."""

    def __init__(self, folder: str, name: str):
        import zstandard

        files, root = store(folder)
        with files.open_input_stream(f"{root}/dictionary") as source:
            trained = source.read()
        self.source = files.open_input_file(f"{root}/{name}")
        size = self.source.size()
        start, n, end = struct.unpack("<QQ8s", self.source.read_at(24, size - 24))
        head = self.source.read_at(len(HEAD) + 32, 0)
        if end != END or head[: len(HEAD)] != HEAD or head[len(HEAD):] != hashlib.sha256(trained).digest():
            raise ValueError(f"{name} is not a whole token file of this dictionary")
        index = self.source.read_at(n * 21, start)
        self.ids = np.frombuffer(index, "<i8", n)
        self.null = np.frombuffer(index, "u1", n, n * 8).astype(bool)
        self.ends = np.frombuffer(index, "<u8", n, n * 9)
        self.counts = np.frombuffer(index, "<u4", n, n * 17)
        self.starts = np.concatenate([np.array([len(head)], "<u8"), self.ends[:-1]])
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))

    def raw(self, place: int) -> bytes:
        a, b = int(self.starts[place]), int(self.ends[place])
        return self.press.decompress(self.source.read_at(b - a, a))

    def document(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, by binary search and one ranged read."""
        first = int(self.null.sum())
        place = first + int(np.searchsorted(self.ids[first:], doc_id))
        return np.frombuffer(self.raw(place), "<u4") if place < len(self.ids) and self.ids[place] == doc_id else None

    def documents(self) -> Iterator[bytes]:
        """All documents in order, read a few MB at a time."""
        place, n = 0, len(self.ids)
        while place < n:
            a = int(self.starts[place])
            stop = max(place + 1, int(np.searchsorted(self.ends, a + READ_BYTES, side="right")))
            block = self.source.read_at(int(self.ends[stop - 1]) - a, a)
            for i in range(place, stop):
                yield self.press.decompress(block[int(self.starts[i]) - a : int(self.ends[i]) - a])
            place = stop


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document read back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    # one row for each file
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(folder, name)
                crcs, counts = [], []
                for raw in file.documents():
                    crcs.append(zlib.crc32(raw))
                    counts.append(len(raw) // 4)
                counts = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(file.ids, mask=file.null),
                        pa.array(base + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.repartition(n).transform(in_arrow, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark, sf_dir):
    import public_tokenizers

    from orestrata.llm.common import table

    folder = new_folder(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(manifest, folder)
