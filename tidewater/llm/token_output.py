"""Encode documents and write their token ids (operator 1).

Texts are dealt by ranges of doc_id and sorted within, so the files in the
order of their numbers hold the documents in ascending doc_id order (null ids
first, then ties in the order of their texts). Each task encodes its range and
writes one file; the rows it returns name only the file of the attempt that
succeeded, so a repeated or lost task does no harm."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.chunks import chunks
from tidewater.llm.common import BoundedCache, map_batches, texts_of
from tidewater.llm.token_files import TokenFileReader, TokenFileWriter
from tidewater.session import scratch_path, stage

#: Files whose starts are summed in one task.
FILES_A_GROUP = 4096


class CachedEncoder:
    """``encode(texts)``: the ids that a ``tokenizers`` file gives for whole
    texts. Parts that recur (see ``chunks``) are encoded once and remembered; a
    single stop after a letter is a piece of its own and is encoded apart."""

    STOPS = frozenset(".,;:!?")
    LAST_LATIN = "\u024f"

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.known = BoundedCache(self._part, limit)
        self.signs = byte_signs()

    def _is_word(self, part: str) -> bool:
        """A blank and Latin letters, or letters alone: one piece of the split."""
        word = part[1:] if part[0] == " " else part
        return word.isalpha() and (word.isascii() or max(word) <= self.LAST_LATIN)

    def _word(self, part: str) -> bytes:
        """The library's model on one piece, without its splitting."""
        signs = part.replace(" ", self.signs[32]) if part.isascii() else part.encode().decode("latin-1").translate(self.signs)
        ids = [t.id for t in self.model.tokenize(signs)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pieces(self, part: str) -> tuple[str, ...]:
        return (part[:-1], part[-1]) if len(part) > 1 and part[-1] in self.STOPS and part[-2].isalpha() else (part,)

    def _piece(self, part: str) -> bytes:
        if self._is_word(part):
            return self._word(part)
        ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        pieces = self._pieces(part)
        return self._piece(part) if len(pieces) == 1 else b"".join(map(self.known.__getitem__, pieces))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, chunks(t))), "<u4") for t in texts]


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if
    it is printable, else the next one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> CachedEncoder:
    """One encoder per Python worker, so that later tasks find the parts that
    earlier ones met."""
    return CachedEncoder(path)


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 2, id_bytes: int = 2,
                      n_files: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ids of all texts under ``out_dir`` (any store that pyarrow opens)
    and return the manifest: ``file, part, n_docs, n_tokens, start`` (start: ids
    in all files before).

    A null text is the empty text and yields ``end_id`` alone; a null doc_id is
    written as null, before all others; repeated rows are all written; an empty
    table gives an empty manifest and no file; other columns are not read.
    ``id_bytes`` is 2 only for vocabularies of at most 65,536 ids."""
    spark = docs.sparkSession
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = uuid.uuid4().hex[:12]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, total = TaskContext.get(), None, 0
        part = task.partitionId()
        uri = f"{out_dir.rstrip('/')}/{run}-{part:06d}-{task.taskAttemptId()}.tok"
        encoder = worker_encoder(tokenizer_path)
        for batch in batches:
            out = out or TokenFileWriter(uri, id_bytes)
            for d, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch))):
                out.add(d, np.append(ids, np.uint32(end_id)))
                total += len(ids) + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [uri], "part": pa.array([part], pa.int64()),
                                              "n_docs": [len(out.counts)], "n_tokens": [total]})

    dealt = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
             .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    files = stage(map_batches(dealt, write, "file string, part long, n_docs long, n_tokens long"), "token-manifest")
    # starts: sums within groups of files, then over the groups' totals
    group = F.floor(F.col("part") / FILES_A_GROUP)
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = (files.groupBy(group.alias("g")).agg(F.sum("n_tokens").alias("t"))
              .select("g", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (files.withColumn("g", group).join(groups, "g")
            .select("file", "part", "n_docs", "n_tokens",
                    (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start")))


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Rows ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids`` of the
    files in a manifest, a task per file. With ``doc_ids`` (a short list) only
    those documents' frames are read and decompressed."""
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                reader = TokenFileReader(uri)
                starts = base + np.concatenate(([0], np.cumsum(reader.counts)))
                if wanted is None:
                    some = ((k, d, ids) for k, (d, ids) in enumerate(reader))
                else:
                    some = ((k, d, reader.read(k)) for k, d in enumerate(reader.doc_ids) if d in wanted)
                rows, held = [], 0
                for k, d, ids in some:
                    rows.append((d, int(starts[k]), len(ids), zlib.crc32(ids.tobytes()), ids if with_ids else None))
                    held += len(ids) if with_ids else 1
                    if held > 2_000_000 or len(rows) >= 10_000:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)
                reader.close()

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        data = {"doc_id": pa.array(cols[0], pa.int64()), "start": pa.array(cols[1], pa.int64()),
                "n_tokens": pa.array(cols[2], pa.int64()), "ids_crc32": pa.array(cols[3], pa.int64())}
        if with_ids:
            data["ids"] = pa.array(cols[4], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict(data)

    files = manifest.select("file", "part", "start").repartitionByRange(max(1, manifest.count()), "part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return map_batches(files, read, schema)


def encode_documents(docs: DataFrame, tokenizer_path: str, label: str = "token-files", **kw) -> DataFrame:
    """Write all documents into the shared folder and read them back."""
    manifest = write_token_files(docs, scratch_path(docs.sparkSession, label), tokenizer_path, **kw)
    return read_token_files(stage(manifest, "token-starts"), with_ids=False)
