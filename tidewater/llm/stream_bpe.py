"""BPE as a streaming transducer, and a streaming decoder (operator 12).

Text comes in chunks of any size; ids leave as soon as no later text can change
them, and what is held meanwhile is bounded, however long the text or one of its
pieces is.

Lookahead. In a proper merge list (whatever builds a token stands before
whatever uses it) the rules can be applied one after another. Let two strings
share a prefix; before the first rule they have the same cuts up to its end. A
rule (u, v) moves the last cut they share only if u ends there in both and v
follows in one of them, and then by len(u); the next rule that moves it needs a
right side that starts with this u. The longest such chain of rules of rising
rank, weighted by len(u), bounds how far any difference can reach back: a token
that ends that many bytes before the end of what is known is final. A cut that
stays is never merged over, so encoding may start anew behind it."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewater.llm.common import BoundedCache, map_batches, texts_of
from tidewater.llm.token_output import byte_signs

#: The split of this byte-level pre-tokenizer, and its runs.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUNS = {"letters": r"\p{L}*", "numbers": r"\p{N}*", "signs": r"[^\s\p{L}\p{N}]*", "spaces": r"\s*"}
#: Characters from its start that decide whether a piece is a contraction.
DECIDES = 3
#: Characters fed at once, and the length of a piece that is not kept whole.
CHUNK = 1 << 16
LONG = 1 << 12


class MergeList:
    """A ranked, proper merge list over bytes, with its sufficient lookahead."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.ids = ids
        built: set[bytes] = {bytes([b]) for b in range(256)}
        for u, v in merges:
            if u not in built or v not in built or u + v in built:
                raise ValueError(f"the merge list is not proper at {u!r} {v!r}: no lookahead is known to suffice")
            built.add(u + v)
        if absent := [t for t in built if t not in ids]:
            raise ValueError(f"no id for {sorted(absent)[:3]}")
        self.lookahead = sufficient_lookahead(merges)
        self.block = max(LONG, 4 * self.lookahead)
        self.bytes = [ids[bytes([b])] for b in range(256)]
        self.pairs = {(ids[u], ids[v]): (rank, ids[u + v]) for rank, (u, v) in enumerate(merges)}
        self.length = {i: len(t) for t, i in ids.items()}

    def merge(self, data: bytes) -> list[int]:
        """The encoding of ``data``: the lowest rank first, leftmost on ties."""
        out, get = [self.bytes[b] for b in data], self.pairs.get
        if len(out) < 48:
            none = (1 << 60, 0)
            ranks = [get(p, none) for p in zip(out, out[1:])]
            while ranks and (best := min(ranks)) is not none:
                k = ranks.index(best)
                out[k : k + 2] = [best[1]]
                del ranks[k]
                if k < len(ranks):
                    ranks[k] = get((out[k], out[k + 1]), none)
                if k:
                    ranks[k - 1] = get((out[k - 1], out[k]), none)
            return out
        after = list(range(1, len(out) + 1))
        before = list(range(-1, len(out) - 1))
        heap = [(r[0], k, p, r[1]) for k, p in enumerate(zip(out, out[1:])) if (r := get(p))]
        heapq.heapify(heap)
        end = len(out)
        while heap:
            _, k, pair, new = heapq.heappop(heap)
            j = after[k]
            if j >= end or (out[k], out[j]) != pair:
                continue
            out[k], out[j] = new, -1
            after[k] = n = after[j]
            if n < end:
                before[n] = k
                if r := get(p := (new, out[n])):
                    heapq.heappush(heap, (r[0], k, p, r[1]))
            if (b := before[k]) >= 0 and (r := get(p := (out[b], new))):
                heapq.heappush(heap, (r[0], b, p, r[1]))
        return [t for t in out if t >= 0]


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """The longest chain of rules, see above; one pass from the last rule on."""
    reach: dict[bytes, int] = {}  # by prefix of a right side: the chains of later rules
    most = 0
    for u, v in reversed(merges):
        far = len(u) + reach.get(u, 0)
        most = max(most, far)
        for k in range(1, len(v) + 1):
            if reach.get(v[:k], 0) < far:
                reach[v[:k]] = far
    return most


class PieceEncoder:
    """One piece, fed in parts: holds at most a block and the lookahead."""

    def __init__(self, merges: MergeList):
        self.merges, self.held = merges, bytearray()

    def feed(self, data: bytes) -> Iterator[int]:
        m = self.merges
        for at in range(0, len(data), m.block):
            self.held += data[at : at + m.block]
            if len(self.held) < m.block + m.lookahead:
                continue
            end, final = 0, len(self.held) - m.lookahead
            for t in m.merge(bytes(self.held)):
                if end + m.length[t] > final:
                    break
                end += m.length[t]
                yield t
            del self.held[:end]

    def finish(self) -> list[int]:
        out = self.merges.merge(bytes(self.held))
        self.held.clear()
        return out


class Vocabulary:
    """A ``tokenizers`` file of a byte-level BPE: merges, split and special
    tokens. A file whose settings this transducer does not follow raises."""

    def __init__(self, path: str, special_as_text: bool = False, cache: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                 "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
        odd = [k for k, v in plain.items() if (model.get(k) or None) != (v or None)]
        if (odd or model["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or not split.get("use_regex", True) or (spec["decoder"] or {}).get("type") != "ByteLevel"):
            raise ValueError(f"{path}: no plain byte-level BPE {odd}")
        value = {sign: b for b, sign in byte_signs().items()}
        of_signs = lambda s: bytes(map(value.__getitem__, s))
        ids = {of_signs(t): i for t, i in model["vocab"].items()}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.merges = MergeList([(of_signs(a), of_signs(b)) for a, b in pairs], ids)
        self.tokens = {i: t for t, i in ids.items()}
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: added tokens that take blanks or whole words")
        self.tokens |= {t["id"]: t["content"].encode() for t in added}
        self.special = {} if special_as_text else {t["content"]: t["id"] for t in added}
        self.hold = max(map(len, self.special), default=1) - 1
        any_special = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.find_special = regex.compile(any_special).search if any_special else lambda *_: None
        self.split = regex.compile(PIECES).findall
        self.runs = {name: regex.compile(p).match for name, p in RUNS.items()}
        self.pieces = BoundedCache(self._whole, cache)

    def _whole(self, piece: str) -> bytes:
        return np.array(self.merges.merge(piece.encode()), "<u4").tobytes()


class StreamEncoder:
    """``feed`` chunks of a text, then ``finish``: each returns the ids that are
    now final, as little-endian unsigned 32-bit integers."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.rest, self.run, self.piece = vocab, "", "", PieceEncoder(vocab.merges)

    def feed(self, chunk: str) -> bytes:
        return self._take(self.rest + chunk, False)

    def finish(self) -> bytes:
        return self._take(self.rest, True)

    def _take(self, text: str, last: bool) -> bytes:
        out, at = [], 0
        while found := self.vocab.find_special(text, at):
            self._scan(text[at : found.start()], True, out)
            out.append(np.array([self.vocab.special[found.group()]], "<u4").tobytes())
            at = found.end()
        known = text[at:] if last else text[at : max(at, len(text) - self.vocab.hold)]
        self.rest = text[at + self._scan(known, last, out) :]
        return b"".join(out)

    def _scan(self, text: str, last: bool, out: list[bytes]) -> int:
        """Encode the pieces of ``text`` that no later text can change (with
        ``last``: all); returns where the rest starts."""
        at = self._go_on(text, last, out) if self.run else 0
        if self.run or at == len(text):
            return at
        pieces = self.vocab.split(text, at) if at else self.vocab.split(text)
        end = len(text)
        if not last:
            while pieces and (end == len(text) or end + DECIDES > len(text)):
                end -= len(pieces.pop())
        if len(text) > LONG and max(map(len, pieces), default=0) > LONG:
            for p in pieces:
                out.append(self._long(p) if len(p) > LONG else self.vocab.pieces[p])
        else:
            out.extend(map(self.vocab.pieces.__getitem__, pieces))
        if len(text) - end > LONG and not last:  # a long piece that is still open
            sign = text[-1]
            self.run = next(name for name, match in self.vocab.runs.items() if match(sign).end())
            known = len(text) - (self.run == "spaces")
            self._open(text[end:known], out)
            end = known
        return end

    def _go_on(self, text: str, last: bool, out: list[bytes]) -> int:
        """More of an open piece. The last of a run of spaces belongs to what
        follows, if a visible character does."""
        end = self.vocab.runs[self.run](text).end()
        if end == len(text) and not last:
            end -= self.run == "spaces" and end > 0
            self._open(text[:end], out)
            return end
        if end < len(text) and self.run == "spaces":
            end -= 1
        self._open(text[:end], out)
        out.append(np.array(self.piece.finish(), "<u4").tobytes())
        self.run = ""
        return end

    def _open(self, part: str, out: list[bytes]) -> None:
        out.append(np.fromiter(self.piece.feed(part.encode()), "<u4").tobytes())

    def _long(self, piece: str) -> bytes:
        out: list[bytes] = []
        self._open(piece, out)
        out.append(np.array(self.piece.finish(), "<u4").tobytes())
        return b"".join(out)


class StreamDecoder:
    """Ids to text: ``feed`` returns the characters that are complete, bytes of
    an unfinished one are its state; bytes that are no UTF-8 give U+FFFD."""

    def __init__(self, vocab: Vocabulary):
        self.tokens = vocab.tokens
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.machine.decode(b"".join(map(self.tokens.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


@lru_cache(maxsize=1)
def worker_vocabulary(path: str, special_as_text: bool) -> Vocabulary:
    """One per Python worker, kept for its later tasks."""
    return Vocabulary(path, special_as_text)


def encode_decode(docs: DataFrame, tokenizer_path: str, special_as_text: bool = False, with_ids: bool = False,
                  with_text: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text:
    encoded and decoded chunk by chunk, the digests over the ids (decimal, joined
    by commas) and over the decoded text (UTF-8). ``with_ids`` adds ``ids``
    (array of int), ``with_text`` the text decoded from them. The string of a
    special token in a text is that token, as in the library's default, or with
    ``special_as_text`` ordinary text.

    A null text is the empty text (no ids); null and repeated doc_ids stay as
    they are, a row each; an empty table gives no rows; other columns are not
    read. The work is row by row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = worker_vocabulary(tokenizer_path, special_as_text)
        for batch in batches:
            counts, a, b, all_ids, all_text = [], [], [], [], []
            for t in texts_of(batch):
                encoder, decoder = StreamEncoder(vocab), StreamDecoder(vocab)
                id_hash, text_hash, n, kept, said = hashlib.sha256(), hashlib.sha256(), 0, [], []
                for at in range(0, len(t) + 1, CHUNK):
                    raw = encoder.feed(t[at : at + CHUNK])
                    if at + CHUNK > len(t):
                        raw += encoder.finish()
                    ids = np.frombuffer(raw, "<u4").tolist()
                    if ids:
                        id_hash.update(((("," if n else "") + ",".join(map(str, ids)))).encode())
                        n += len(ids)
                    part = decoder.feed(ids)
                    text_hash.update(part.encode())
                    if with_ids:
                        kept += ids
                    if with_text:
                        said.append(part)
                part = decoder.finish()
                text_hash.update(part.encode())
                counts.append(n)
                a.append(id_hash.hexdigest())
                b.append(text_hash.hexdigest())
                all_ids.append(kept)
                all_text.append("".join([*said, part]))
            data = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
            if with_ids:
                data["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            if with_text:
                data["decoded"] = pa.array(all_text, pa.string())
            yield pa.RecordBatch.from_pydict(data)

    picked = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += (", ids array<int>" if with_ids else "") + (", decoded string" if with_text else "")
    return map_batches(picked, run, schema)
