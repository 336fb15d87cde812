"""Byte-level BPE by prefix dynamic programming (operator 4).

For every prefix of a piece of bytes there is exactly one token that can end
its encoding: token t may follow token s only if merging the bytes of s and t
gives s and t again, and a sequence whose neighbours all pass is the encoding.
The table of last tokens is enough to read off the encoding of any prefix, so
bytes can be appended exactly, and after an edit only the entries near it are
computed anew."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewater.llm.chunks import chunks
from tidewater.llm.common import BoundedCache, map_batches, texts_of


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line per token, base64 of its bytes and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


LAST_LATIN = "\u024f"


class PrefixBpe:
    """Encoder and decoder over a rank table and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = 400_000):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        self.longest = max(map(len, ranks), default=0)
        self._whole: dict[int, bool] = {}
        self._pairs: dict[int, bool] = {}
        self.pieces = BoundedCache(self.encode_piece, cache)
        self.parts = BoundedCache(self._encode_part, cache)

    # -- what may stand where -------------------------------------------------
    def merge(self, data: bytes) -> list[int]:
        """Merge by ranks, lowest first, leftmost on ties: the definition that
        the tests for whole tokens and pairs rest on."""
        ends = list(range(1, len(data) + 1))
        starts = [0, *ends[:-1]]
        while len(starts) > 1:
            best = min(((self.ranks.get(data[starts[k] : ends[k + 1]], 1 << 60), k) for k in range(len(starts) - 1)))
            if best[0] == 1 << 60:
                break
            k = best[1]
            del ends[k], starts[k + 1]
        return [self.ranks[data[a:b]] for a, b in zip(starts, ends)]

    def _is_whole(self, t: int) -> bool:
        if (ok := self._whole.get(t)) is None:
            ok = self._whole[t] = self.merge(self.tokens[t]) == [t]
        return ok

    def _may_follow(self, s: int, t: int) -> bool:
        key = s << 32 | t
        if (ok := self._pairs.get(key)) is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            ok = self._pairs[key] = self.merge(self.tokens[s] + self.tokens[t]) == [s, t]
        return ok

    # -- the table ------------------------------------------------------------
    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Fill ``last`` (entry i: the last token of ``data[:i + 1]``) on from
        where it ends up to ``upto`` bytes."""
        get, tokens, whole, pairs = self.ranks.get, self.tokens, self._whole, self._pairs
        for end in range(len(last) + 1, (len(data) if upto is None else upto) + 1):
            for start in range(max(0, end - self.longest), end):
                t = get(data[start:end])
                if t is None or not (whole.get(t) or self._is_whole(t)):
                    continue
                if start:
                    s = last[start - 1]
                    if s < 0 or not (pairs.get(s << 32 | t) or self._may_follow(s, t)):
                        continue
                last.append(t)
                break
            else:
                last.append(-1)  # no token ends here: bytes outside the vocabulary

    def read_off(self, last: list[int]) -> list[int]:
        """The encoding of the prefix that ``last`` covers."""
        out, at = [], len(last)
        while at:
            t = last[at - 1]
            if t < 0:
                raise ValueError(f"the vocabulary cannot encode byte {at - 1}")
            out.append(t)
            at -= len(self.tokens[t])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        if (t := self.ranks.get(data)) is not None:  # a piece that is a token is that token
            return [t]
        last: list[int] = []
        self.extend(data, last)
        return self.read_off(last)

    # -- texts ----------------------------------------------------------------
    def _encode_part(self, part: str) -> bytes:
        pieces = self.pieces
        word = part[1:] if part[0] == " " else part
        if word.isalpha() and max(word) <= LAST_LATIN:  # a blank and letters are one piece
            return np.array(pieces[part.encode()], dtype="<u4").tobytes()
        ids = [t for p in self.pattern.findall(part) for t in pieces[p.encode()]]
        return np.array(ids, dtype="<u4").tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.parts
        return b"".join([parts[c] for c in chunks(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class EditablePiece:
    """A run of bytes with its prefix table, for appends and edits."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> int:
        """Exact append; returns how many entries were computed."""
        self.data += more
        self.bpe.extend(self.data, self.last)
        return len(more)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for ``data[start:end]``. Entries before ``start`` stay;
        behind the edit the old ones are taken over as soon as as many entries
        in a row as the longest token has bytes are what they were, for each
        entry depends on no more than these. Returns how many entries were
        computed."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, same, done = old[:start], 0, 0
        for at in range(start, len(self.data)):
            self.bpe.extend(self.data, self.last, at + 1)
            done += 1
            if at >= start + len(new):
                same = same + 1 if self.last[at] == old[at - shift] else 0
                if same >= self.bpe.longest:
                    self.last += old[at - shift + 1 :]
                    break
        return done

    def ids(self) -> list[int]:
        if (t := self.bpe.ranks.get(self.data)) is not None:
            return [t]
        return self.bpe.read_off(self.last)


class EditableText:
    """A text as pieces of the split pattern, each encoded. An edit splits the
    text anew only from the last piece whose end the edit cannot move, up to the
    first piece that starts where an old one did."""

    #: How far beyond its end the split pattern looks to end a piece.
    LOOK = 4

    def __init__(self, bpe: PrefixBpe, text: str = ""):
        self.bpe, self.text = bpe, ""
        self.starts: list[int] = []
        self.codes: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` for ``text[start:end]``; returns how many pieces were
        encoded."""
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        ends = [*self.starts[1:], len(self.text)]
        keep = sum(1 for e in ends if e + self.LOOK <= start) if self.starts else 0
        old_at = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        starts, codes, done = self.starts[:keep], self.codes[:keep], 0
        for m in self.bpe.pattern.finditer(text, ends[keep - 1] if keep else 0):
            if m.start() in old_at and m.start() >= start + len(new):
                k = old_at[m.start()]
                starts += [s + shift for s in self.starts[k:]]
                codes += self.codes[k:]
                break
            starts.append(m.start())
            codes.append(self.bpe.pieces[m.group().encode()])
            done += 1
        self.text, self.starts, self.codes = text, starts, codes
        return done

    def ids(self) -> list[int]:
        return [t for c in self.codes for t in c]


@lru_cache(maxsize=1)
def worker_bpe(ranks_path: str, pattern: str) -> PrefixBpe:
    """One encoder per Python worker, kept for its later tasks."""
    return PrefixBpe(load_ranks(ranks_path), pattern)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked, ``ids``
    (array of int) of every whole text, encoded and decoded again.

    A null text is the empty text (no ids); null and repeated doc_ids stay as
    they are, a row each; an empty table gives no rows; other columns are not
    read. The work is row by row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(ranks_path, pattern)
        for batch in batches:
            n, a, b, all_ids = [], [], [], []
            for t in texts_of(batch):
                raw = bpe.encode_bytes(t)
                ids = np.frombuffer(raw, "<u4")
                n.append(len(ids))
                a.append(hashlib.sha256(raw).hexdigest())
                b.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
                if with_ids:
                    all_ids.append(ids.astype(np.int32))
            data = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
            if with_ids:
                data["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(data)

    picked = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_batches(picked, run, schema)
