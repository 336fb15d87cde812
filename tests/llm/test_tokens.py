import hashlib
import random
import zlib

import numpy as np
import pytest

pa = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tests.llm.helpers import SF_SMALL, no_docs, odd_docs  # noqa: E402
from tidewater.llm import registry, token_output  # noqa: E402
from tidewater.llm.chunks import chunks  # noqa: E402
from tidewater.llm.prefix_bpe import EditablePiece, EditableText, PrefixBpe, encode_decode, load_ranks  # noqa: E402
from tidewater.llm.token_files import TokenFileReader, TokenFileWriter  # noqa: E402
from tidewater.session import scratch_path  # noqa: E402

JSON, RANKS = pa.path("byte_bpe_50k.json"), pa.path("byte_bpe_multi_50k.tiktoken")
SIGNS = list("ab c\n\t'srel  !?.,  é漢字🙂0 1\x1c\xa0​\r\0<|>")


@pytest.fixture(scope="module")
def bpe():
    return PrefixBpe(load_ranks(RANKS), pa.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=pa.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def _texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 18))) for _ in range(n)]


def test_chunks_join_to_the_text():
    for t in _texts(500):
        assert "".join(chunks(t)) == t


def test_prefix_bpe_is_the_librarys_encoding(bpe, library):
    for t in [*_texts(3000), "<|endoftext|>", "a" * 3000, " " * 500, "É" * 300]:
        ids = bpe.encode(t)
        assert ids == library.encode_ordinary(t)
        assert bpe.decode(ids) == t.encode()


def test_appends_and_edits_are_exact(bpe, library):
    rng = random.Random(5)
    for t in _texts(60, 8):
        text, piece, data = EditableText(bpe, t), EditablePiece(bpe, t.encode()), t.encode()
        for _ in range(6):
            i = rng.randint(0, len(t))
            j, new = min(len(t), i + rng.randint(0, 4)), "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 4)))
            t = t[:i] + new + t[j:]
            text.replace(i, j, new)
            assert text.ids() == library.encode_ordinary(t)
            i = rng.randint(0, len(data))
            data = data[:i] + new.encode() + data[i:]
            piece.replace(i, i, new.encode())
            assert piece.ids() == EditablePiece(bpe, data).ids()
        text.append(" more"), piece.append(b" more")
        assert text.ids() == library.encode_ordinary(t + " more")
        assert piece.ids() == EditablePiece(bpe, data + b" more").ids()


def test_an_edit_computes_only_what_is_near(bpe):
    long = "and then the other one said so " * 200
    text = EditableText(bpe, long)
    assert text.replace(3000, 3001, "X") < 10
    piece = EditablePiece(bpe, b"thereandthenthere" * 400)
    assert piece.replace(2000, 2001, b"q") < 5 * bpe.longest


def test_op4_on_odd_rows(spark, library):
    rows = [r.asDict() for r in encode_decode(odd_docs(spark), RANKS, pa.PATTERN, with_ids=True).collect()]
    texts = [(r["doc_id"], r["text"] or "") for r in odd_docs(spark).collect()]
    want = sorted((str(d), hashlib.sha256(t.encode()).hexdigest(), library.encode_ordinary(t)) for d, t in texts)
    assert sorted((str(r["doc_id"]), r["decoded_sha256"], r["ids"]) for r in rows) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert encode_decode(no_docs(spark), RANKS, pa.PATTERN).count() == 0


def test_op4_query(spark, library):
    got = {r["doc_id"]: r for r in registry.op4_prefix_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"])
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def _plain(texts):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return [[*e.ids, 2] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_op1_query(spark):
    got = registry.op1_token_files(spark, SF_SMALL).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for r, d, ids in zip(got, docs, _plain([d["text"] for d in docs]), strict=True):
        assert tuple(r) == (d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op1_on_odd_rows(spark):
    docs = odd_docs(spark)
    manifest = token_output.write_token_files(docs, scratch_path(spark, "t"), JSON, n_files=3).cache()
    got = token_output.read_token_files(manifest).orderBy("start").collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    assert [r["ids"] for r in got] == _plain([r[1] or "" for r in rows])
    some = token_output.read_token_files(manifest, doc_ids=[4, 8]).collect()
    assert sorted(r["ids"] for r in some) == sorted(r["ids"] for r in got if r["doc_id"] in (4, 8))
    assert token_output.encode_documents(no_docs(spark), JSON).count() == 0


def test_reader_decompresses_only_what_is_asked_and_checks_it(tmp_path):
    out = TokenFileWriter(f"{tmp_path}/a.tok", id_bytes=2)
    docs = [(None, [2]), (1, list(range(300))), (5, [7] * 5000), (9, [])]
    for d, ids in docs:
        out.add(d, np.array(ids, np.uint32))
    out.close()
    reader = TokenFileReader(f"{tmp_path}/a.tok")
    read = []
    plain = reader.zstd
    reader.zstd = type("Seen", (), {"decompress": lambda self, x: read.append(len(x)) or plain.decompress(x)})()
    assert [(d, ids.tolist()) for d, ids in reader.find([5])] == [(5, [7] * 5000)]
    assert len(read) == 1
    assert [(d, ids.tolist()) for d, ids in reader] == docs
    data = bytearray((tmp_path / "a.tok").read_bytes())
    data[int(reader.offsets[1]) + 12] ^= 1
    (tmp_path / "b.tok").write_bytes(data)
    with pytest.raises(Exception, match="checksum|decompress|corrupt|[Dd]ata"):
        TokenFileReader(f"{tmp_path}/b.tok").read(1)


def test_token_files_refuse_ids_that_do_not_fit(tmp_path):
    writer = TokenFileWriter(f"{tmp_path}/a.tok", id_bytes=2)
    writer.add(1, np.array([65535], "<u4"))
    with pytest.raises(ValueError, match="70000"):
        writer.add(2, np.array([3, 70000], "<u4"))


def test_encoder_takes_each_word_in_one_lookup():
    """No pass over the words but the lookup itself; the ids are the library's."""
    from tidewater.llm.common import BoundedCache
    from tidewater.llm.token_output import CachedEncoder

    class OnePass(BoundedCache):
        def __contains__(self, key):
            raise AssertionError("looked up twice")

    path = pa.path("byte_bpe_50k.json")
    encoder = CachedEncoder(path)
    encoder.known = OnePass(encoder.known.make, 5)  # so small that parts are forgotten between texts
    texts = ["the cat, the dog.\nthe 12 cats", "café naïve Жук! a.b", "two  blanks <|endoftext|>", " led", "nul \0 here", "", "the cat 中文."]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
