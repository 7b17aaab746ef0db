import glob
import random
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from popledger.llm import bpe, tokenfiles  # noqa: E402
from popledger.llm.registry import QUERIES  # noqa: E402
from popledger.llm.transducer import Utf8State, decoder, transducer  # noqa: E402
from tests.llm.brute import sha  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
RNG = random.Random(3)
LETTERS = "ab  '’\n\tstrevml é1²!日本'd😀"
ODD = ["".join(RNG.choice(LETTERS) for _ in range(RNG.randrange(60))) for _ in range(1500)]
ODD += [
    "", "a" * 5000, "<|endoftext|>x <|endoftext|>", "'s's 'll", "  \n's", " " * 400, "-" * 700 + "x", "don't  we'll!'s ''s \r\n 'S", " x　 y\x1c\x85z",
    "the" * 3000, "".join(RNG.choice("thequickbrown") for _ in range(6000)), "long text, " * 60_000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_own_encoder_equals_the_library(library):
    want = [e.ids for e in library.encode_batch_fast(ODD, add_special_tokens=False)]
    for encode in (bpe.encoder(PATH), tokenfiles.library_encoder(PATH)):
        assert [x.tolist() for x in encode(ODD)] == want


def test_stream_emits_before_the_end_and_keeps_a_bounded_window(library):
    t = transducer(PATH)
    text = "".join(RNG.choice("thequickbrown") for _ in range(20_000)).encode()
    lists = list(t.stream([text[i : i + 100] for i in range(0, len(text), 100)]))
    assert sum(lists, []) == library.encode(text.decode(), add_special_tokens=False).ids
    done = 0
    assert len(lists) > 50
    for tokens in lists[:-1]:
        done += sum(t.m.length[x] for x in tokens)
    assert len(text) - done <= t.m.lookahead + 2 * t.m.longest + t.m.lookahead


def test_decoder_equals_the_library_on_any_ids(library):
    d = decoder(PATH)
    for _ in range(300):
        ids = [RNG.randrange(50257) for _ in range(20)]
        assert d.text(np.array(ids), step=3) == library.decode(ids, skip_special_tokens=False)


def test_byte_machine_holds_back_unfinished_characters():
    data = "aé日😀".encode() + b"\xff\xe6\x97" + b"z" + b"\xf0\x9f"
    for step in (1, 2, 3):
        s = Utf8State()
        assert "".join([*(s.feed(data[i : i + step]) for i in range(0, len(data), step)), s.feed(b"", final=True)]) == data.decode(errors="replace")


def test_query_equals_the_library(spark, small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op7_bpe_transducer"](spark, small).collect()}
    assert got.keys() == docs.keys()
    for d, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert (got[d].n_tokens, got[d].ids_sha256) == (len(ids), sha(np.array(ids, dtype="<u4").tobytes()))
        assert got[d].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "hi", 3), (3, "hi", 3), (None, "x", 4)], "doc_id bigint, text string, ids int")
    got = bpe.decode(bpe.encode(rows, PATH), PATH)
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in got.collect()) == [(0, 1, "x"), (1, 0, ""), (2, 0, ""), (3, 1, "hi"), (3, 1, "hi")]
    assert bpe.encode(rows.limit(0), PATH).count() == 0


def token_rows(docs, library):
    start, out = 0, []
    for d, text in sorted(docs, key=lambda x: x[0]):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_file_query_equals_the_library(spark, small, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = QUERIES["op10_token_files"](spark, small)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()) == token_rows(docs, library)


def test_files_are_read_in_part_and_checked(spark, tmp_path, library, monkeypatch):
    docs = [(i, f"text {i} " * 3000) for i in range(60)] + [(60, None), (61, "")]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    manifest = tokenfiles.write(rows, f"file://{tmp_path}/f", PATH).cache()
    assert [(r.doc_id, r.start, r.n_tokens, tokenfiles.crc(bytes(r.ids))) for r in tokenfiles.read(manifest).orderBy("doc_id").collect()] == token_rows(docs, library)
    assert [r.doc_id for r in tokenfiles.read(manifest, only=[7, 60, 99]).orderBy("doc_id").collect()] == [7, 60]
    path = manifest.first().path
    reader = tokenfiles.Reader(path, 2)
    reader.ids(3)
    assert len(reader.frames) > 3 and reader.read_frames == 2  # the document table and one frame
    # any zstandard reader can read the stream, and a damaged frame is noticed
    import zstandard

    name = path.removeprefix("file://")
    whole = zstandard.ZstdDecompressor().stream_reader(open(name, "rb"), read_across_frames=True).read()
    assert len(whole) == int(reader.frames[:, 1].sum())
    data = bytearray(open(name, "rb").read())
    data[int(reader.at[1]) + 40] ^= 1
    open(name, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken = tokenfiles.Reader(path, 2)
        [broken.ids(i) for i in range(len(broken.doc_ids))]


def test_no_documents_no_files(spark, tmp_path):
    rows = spark.createDataFrame([], "doc_id bigint, text string")
    assert tokenfiles.write(rows, f"file://{tmp_path}/e", PATH).count() == 0
    assert glob.glob(f"{tmp_path}/e/*") == []


def test_files_keep_rows_without_an_id_and_repeated_ids(spark, tmp_path, library):
    docs = [(None, "no id"), (4, "four"), (None, None), (4, "four again"), (1, "one")]
    rows = spark.createDataFrame([(d, t, 9, "x") for d, t in docs], "doc_id bigint, text string, start int, place string")
    got = tokenfiles.read(tokenfiles.write(rows, f"file://{tmp_path}/n", PATH)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, 4, 4, None, None]
    assert sorted(tokenfiles.crc(bytes(r.ids)) for r in got) == sorted(x[3] for x in token_rows([(d or 0, t) for d, t in docs], library))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


@pytest.mark.parametrize("n", [1024, 2048])
def test_long_pieces_that_a_polynomial_takes_for_equal(spark, tmp_path, library, n):
    one = "".join("ab"[i.bit_count() % 2] for i in range(n))
    docs = [(1, one), (2, one.translate({97: 98, 98: 97}))]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in bpe.encode(rows, PATH).collect()}
    assert got == {d: library.encode(t, add_special_tokens=False).ids for d, t in docs}
    files = tokenfiles.read(tokenfiles.write(rows, f"file://{tmp_path}/t", PATH))
    assert [(r.doc_id, r.start, r.n_tokens, tokenfiles.crc(bytes(r.ids))) for r in files.orderBy("doc_id").collect()] == token_rows(docs, library)


def test_many_special_strings(library):
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    name = max(special, key=len)
    from popledger.llm.bpe import encoder

    text = f"x{name}{name} y" * 50_000
    ids = encoder(PATH)([text])[0].tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
