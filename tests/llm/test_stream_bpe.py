import hashlib
import json
import random

import numpy as np
import pytest

pt = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tests.llm.helpers import SF_SMALL, no_docs, odd_docs  # noqa: E402
from tidewater.llm import registry, stream_bpe  # noqa: E402
from tidewater.llm.stream_bpe import MergeList, PieceEncoder, StreamDecoder, StreamEncoder, Vocabulary  # noqa: E402

JSON = pt.path("byte_bpe_50k.json")
SIGNS = list("ab c\n\t'srelvmd  !?.,  é漢字🙂0 1\x1c\xa0​\r\0<|>") + ["<|endoftext|>", "'re", "<|endof"]


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(JSON)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def stream(vocab, text, sizes):
    encoder, decoder, ids, out, at = StreamEncoder(vocab), StreamDecoder(vocab), [], "", 0
    while at < len(text):
        n = next(sizes)
        got = np.frombuffer(encoder.feed(text[at : at + n]), "<u4").tolist()
        ids, out, at = ids + got, out + decoder.feed(got), at + n
    got = np.frombuffer(encoder.finish(), "<u4").tolist()
    return ids + got, out + decoder.feed(got) + decoder.finish()


def check(vocab, library, text, sizes):
    ids, out = stream(vocab, text, sizes)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert out == library.decode(ids, skip_special_tokens=False) == text


def sizes_of(rng, most):
    while True:
        yield rng.randint(1, most)


def test_streams_equal_the_library_for_any_chunks(vocab, library):
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 25)))
        check(vocab, library, text, sizes_of(rng, 4))
        check(vocab, library, text, sizes_of(rng, 40))


def test_every_character_is_split_as_by_the_library(vocab, library):
    at = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} " for c in at if c % 7 == 0 or c < 0x3100)
    assert np.frombuffer(StreamEncoder(vocab).feed(text), "<u4").size > 0
    check(vocab, library, text, iter(lambda: 50_000, None))


def test_long_pieces_are_streamed_with_bounded_memory(vocab, library):
    rng = random.Random(4)
    for unit in ("x", "ab", "-", "7", " ", " \n", "=-", "é", "ing", "🙂", "\n"):
        text = "say " + unit * 20_000 + rng.choice(["end", " end", "\nend", "'s", "1", ""])
        check(vocab, library, text, sizes_of(rng, 3_000))
    piece, most, left = PieceEncoder(vocab.merges), 0, 0
    for _ in range(300):
        left += sum(vocab.merges.length[t] for t in piece.feed(b"-=" * 500))
        most = max(most, len(piece.held))
    assert most < 2 * vocab.merges.block + vocab.merges.lookahead
    assert left + len(piece.held) == 300_000


def test_the_lookahead_suffices_for_small_random_lists():
    rng = random.Random(9)
    for _ in range(60):
        tokens, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randint(1, 9)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens:
                merges.append((u, v))
                tokens.append(u + v)
        ids = {bytes([b]): b for b in range(256)} | {u + v: 256 + k for k, (u, v) in enumerate(merges)}
        m = MergeList(merges, ids)
        for _ in range(80):
            data = bytes(rng.choice(b"abc") for _ in range(30))
            whole, cuts = m.merge(data), set(np.cumsum([m.length[t] for t in m.merge(data)]).tolist())
            for known in range(m.lookahead, 30):
                end, final = 0, known - m.lookahead
                for k, t in enumerate(m.merge(data[:known])):
                    end += m.length[t]
                    if end > final:
                        break
                    assert whole[k] == t and end in cuts


def test_merging_is_by_rank_and_improper_lists_are_refused():
    ids = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abab": 301, b"bc": 302}
    m = MergeList([(b"b", b"c"), (b"a", b"b"), (b"ab", b"ab")], ids)
    assert m.merge(b"abababc" * 5) == [301, ord("a"), 302] * 5 and m.merge(b"abababc") == [301, ord("a"), 302]
    for bad in ([(b"ab", b"c"), (b"a", b"b")], [(b"a", b"b"), (b"b", b"c"), (b"a", b"b")]):
        with pytest.raises(ValueError, match="proper"):
            MergeList(bad, ids | {b"abc": 303})


def test_other_kinds_of_files_raise(tmp_path):
    spec = json.load(open(JSON))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte-level"):
        Vocabulary(str(tmp_path / "t.json"))


def test_decoder_keeps_unfinished_characters(vocab, library):
    ids = [i for i in range(0, 50257, 3)]
    random.Random(1).shuffle(ids)
    decoder = StreamDecoder(vocab)
    said = "".join(decoder.feed([i]) for i in ids) + decoder.finish()
    assert said == library.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in registry.llm_queries()["op12_stream_bpe"](spark, SF_SMALL).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, library):
    docs = odd_docs(spark)
    rows = stream_bpe.encode_decode(docs, JSON, with_ids=True, with_text=True).collect()
    want = sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    assert sorted((r.doc_id or 0, r.decoded) for r in rows) == want
    assert all(r.ids == library.encode(r.decoded, add_special_tokens=False).ids for r in rows)
    assert stream_bpe.encode_decode(no_docs(spark), JSON).count() == 0
    plain = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    assert 50256 in stream_bpe.encode_decode(plain, JSON, with_ids=True).first().ids
    assert 50256 not in stream_bpe.encode_decode(plain, JSON, special_as_text=True, with_ids=True).first().ids
