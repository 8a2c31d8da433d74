import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docloom.llm import token_store
from docloom.llm.token_store import CachedTokenizer, EliasFano, TokenFile

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(VOCABULARY)
CACHED = CachedTokenizer(VOCABULARY)


def ids(text):
    return np.frombuffer(CACHED.encode(text), CACHED.dtype).tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab Z9.'’\n\t\r\x0b\x1c\x85\xa0éÉ×ß 　漢😀<|endoftext>sS", max_size=60))
def test_ids_are_the_librarys(text):
    assert ids(text) == PLAIN.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "a  b", "a \n b", "\n word", "x\n  y", "tail ", " head", "it's we'll 12 34", "a<|endoftext|> b", "é x"],
)
def test_ids_of_odd_spaces(text):
    assert ids(text) == PLAIN.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 10**7))
def test_elias_fano(numbers, more):
    numbers = np.sort(np.array(numbers, np.int64))
    top = (int(numbers[-1]) if len(numbers) else 0) + more
    code = EliasFano.encode(numbers, top)
    back = EliasFano.read(memoryview(code.tobytes() + b"rest"), len(numbers), top, code.low_bits)
    assert back.all().tolist() == numbers.tolist() == [back.select(i) for i in range(len(numbers))]


def test_elias_fano_is_small():
    n, top = 10_000, 10_000 * 700
    ends = np.sort(np.random.default_rng(1).integers(0, top, n))
    assert len(EliasFano.encode(ends, top).tobytes()) * 8 / n < 2.1 + np.log2(top / n)


def test_a_file_gives_random_access():
    bodies = [b"\x01\x00\x02\x00", b"\x02\x00", b"\x05\x00\x06\x00\x02\x00", b"\x02\x00"]
    file = TokenFile(token_store.pack([None, -7, 3, 3], bodies, 2))
    assert [file.doc_id(i) for i in range(4)] == [None, -7, 3, 3]
    assert [file.document(i).tolist() for i in range(4)] == [[1, 2], [2], [5, 6, 2], [2]]
    with pytest.raises(ValueError):
        TokenFile(b"x" * 100)


def test_rows_are_read_through_select_and_stored_samples(monkeypatch):
    lengths = [1 + i % 7 + 900 * (i % 300 == 0) for i in range(1000)]
    packed = token_store.pack([None, *range(0, 2997, 3)], [b"\x01\x00" * n for n in lengths], 2)
    monkeypatch.setattr(EliasFano, "all", None)
    file = TokenFile(packed)
    got = token_store.rows_of(file, 10)
    assert got["n_tokens"] == lengths and got["doc_id"] == [None, *range(0, 2997, 3)]
    assert got["start"] == [10 + sum(lengths[:i]) for i in range(1000)]
    assert packed.endswith(file.names.samples.tobytes()) and len(file.names.samples) == 4


def test_round_trip(spark):
    rows = [(5, "b c"), (1, "a  b"), (None, "x"), (5, "a"), (2, None), (-3, ""), (9, "w" * 3000 + " y" * 500)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, start string, n_tokens int")
    got = [tuple(r) for r in token_store.round_trip(docs, VOCABULARY, part_bytes=100, file_ids=5).orderBy("start").collect()]
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        own = np.array([*PLAIN.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert got == want


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.round_trip(docs, VOCABULARY).count() == 0
