"""Token ids in seekable files of independent zstandard frames.

A file holds one zstandard frame per document (its ids as little-endian
unsigned integers of 2 or 4 bytes), then a skippable frame with the document
index, then a skippable frame with the seek table of the public seekable
format: per frame the compressed size, the plain size and the low 32 bits of
the plain bytes' XXH64, and a 9-byte footer. Plain ``zstd -d`` can still read
the file; a reader that wants a few documents reads the tail and only their
frames."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow.fs as pafs
import xxhash
import zstandard

INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUM = 0x80
FOOTER = struct.Struct("<IBI")
SKIPPABLE = struct.Struct("<II")
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
#: Bytes asked of the store at once when frames are read in order.
SPAN = 8 << 20


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of ``uri`` (a URI or an absolute path) and the path in it."""
    return pafs.FileSystem.from_uri(uri)


def check32(plain: bytes) -> int:
    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes one file; it appears under its name only when closed whole, so a
    lost task leaves nothing that a reader would take for a file."""

    def __init__(self, uri: str, id_bytes: int = 4, level: int = 3):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = self.path + ".part"
        self.out = self.fs.open_output_stream(self.part)
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.id_bytes, self.entries, self.doc_ids, self.counts = id_bytes, [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """One document. An id that does not fit in ``id_bytes`` raises."""
        if len(ids) and int(ids.max()) >> 8 * self.id_bytes:
            raise ValueError(f"id {int(ids.max())} needs more than {self.id_bytes} bytes")
        plain = ids.astype(f"<u{self.id_bytes}").tobytes()
        packed = self.zstd.compress(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), check32(plain)))
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))

    def close(self) -> None:
        known = np.array([x is not None for x in self.doc_ids], dtype=np.uint8)
        plain = b"".join((
            struct.pack("<BQ", self.id_bytes, len(self.doc_ids)),
            known.tobytes(),
            np.array([x or 0 for x in self.doc_ids], dtype="<i8").tobytes(),
            np.array(self.counts, dtype="<u8").tobytes(),
        ))
        index = self.zstd.compress(plain)
        table = np.array(self.entries, dtype=ENTRY).tobytes()
        self.out.write(SKIPPABLE.pack(INDEX_MAGIC, len(index)) + index)
        self.out.write(SKIPPABLE.pack(SEEK_MAGIC, len(table) + FOOTER.size) + table)
        self.out.write(FOOTER.pack(len(self.entries), HAS_CHECKSUM, FOOTER_MAGIC))
        self.out.close()
        self.fs.move(self.part, self.path)


class TokenFileReader:
    """Reads the tail of a file, then the frames asked for."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        frames, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != FOOTER_MAGIC or not flags & HAS_CHECKSUM:
            raise ValueError(f"{uri}: no seek table with checksums")
        table = frames * ENTRY.itemsize
        self.entries = np.frombuffer(self.file.read_at(table, size - FOOTER.size - table), dtype=ENTRY)
        self.offsets = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        start = int(self.offsets[-1])
        magic, length = SKIPPABLE.unpack(self.file.read_at(SKIPPABLE.size, start))
        if magic != INDEX_MAGIC:
            raise ValueError(f"{uri}: no document index")
        self.zstd = zstandard.ZstdDecompressor()
        plain = self.zstd.decompress(self.file.read_at(length, start + SKIPPABLE.size))
        self.id_bytes, n = struct.unpack_from("<BQ", plain)
        at = 9
        known = np.frombuffer(plain, np.uint8, n, at).astype(bool)
        ids = np.frombuffer(plain, "<i8", n, at + n)
        self.counts = np.frombuffer(plain, "<u8", n, at + 9 * n).astype(np.int64)
        self.doc_ids = [int(x) if k else None for x, k in zip(ids, known)]

    def _ids(self, k: int, packed: bytes) -> np.ndarray:
        plain = self.zstd.decompress(packed) if self.entries["plain"][k] else b""
        if len(plain) != self.entries["plain"][k] or check32(plain) != self.entries["check"][k]:
            raise ValueError(f"frame {k}: checksum differs")
        return np.frombuffer(plain, f"<u{self.id_bytes}").astype("<u4")

    def read(self, k: int) -> np.ndarray:
        """The ids of the k-th document; only its frame is read."""
        return self._ids(k, self.file.read_at(int(self.entries["packed"][k]), int(self.offsets[k])))

    def find(self, doc_ids: Iterable[int | None]) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of the documents with these ids."""
        wanted = set(doc_ids)
        for k, d in enumerate(self.doc_ids):
            if d in wanted:
                yield d, self.read(k)

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, a span of frames at a time."""
        k, n = 0, len(self.entries)
        while k < n:
            end = max(k + 1, int(np.searchsorted(self.offsets, self.offsets[k] + SPAN, "right")) - 1)
            span = self.file.read_at(int(self.offsets[end] - self.offsets[k]), int(self.offsets[k]))
            for i in range(k, end):
                lo = int(self.offsets[i] - self.offsets[k])
                yield self.doc_ids[i], self._ids(i, span[lo : lo + int(self.entries["packed"][i])])
            k = end

    def close(self) -> None:
        self.file.close()
