"""Token-ID files: one concatenated id array, document boundaries in Elias-Fano code.

A file holds consecutive documents in ascending doc_id order::

    magic 8 bytes | header: 8 little-endian u64 (documents, null ids, first doc_id, doc_id range, ids, id width,
    low bits of the ends, low bits of the doc_ids) | ids | Elias-Fano of ends | Elias-Fano of doc_ids

An Elias-Fano list of n non-decreasing numbers below u keeps floor(log2(u / n)) low bits of each as they are, and the
high parts in unary, a bit set at high + i for number i: about 2 + log2(u / n) bits each. The places of every 256th set
bit follow (32 bits each); ``select`` finds number i from them and a count of bits within a few bytes. Files are read
through it: no table of 64-bit offsets exists.

Null texts are empty documents (the end id alone); null doc_ids come first; equal doc_ids follow each other by text
and are dealt by its first characters, so that very many of them need not meet in one task; equal rows each are a
document. A very long text is one document, never cut. Only doc_id (an integer) and text are read, so other columns may have any name. An empty
table writes no file and gives no row.
"""

from __future__ import annotations

import array
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.llm.common import batches_of, id_and_text, shared_dir, stored
from docloom.llm.shared_files import read_file, write_file

MAGIC = b"DLTOKEN2"
HEADER = struct.Struct("<2QqQ4Q")
SAMPLE = 256


class EliasFano:
    """A non-decreasing list of numbers from 0 to ``top``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @staticmethod
    def bits_for(n: int, top: int) -> int:
        return max(0, ((top + 1) // max(1, n)).bit_length() - 1)

    @classmethod
    def encode(cls, numbers: np.ndarray, top: int) -> EliasFano:
        numbers = numbers.astype(np.uint64)
        n, bits = len(numbers), cls.bits_for(len(numbers), top)
        planes = (numbers[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(planes.astype(np.uint8).ravel(), bitorder="little")
        unary = np.zeros(n + (top >> bits) + 1, np.uint8)
        places = (numbers >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary[places] = 1
        return cls(n, bits, low.tobytes(), np.packbits(unary, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4"))

    @classmethod
    def sizes(cls, n: int, top: int, bits: int) -> tuple[int, int, int]:
        return (n * bits + 7) // 8, (n + (top >> bits) + 1 + 7) // 8, -(-n // SAMPLE) * 4

    @classmethod
    def read(cls, data: memoryview, n: int, top: int, bits: int) -> EliasFano:
        a, b, c = cls.sizes(n, top, bits)
        if len(data) < a + b + c:
            raise ValueError("the boundary list is cut short")
        low, high, samples = bytes(data[:a]), bytes(data[a : a + b]), data[a + b : a + b + c]
        return cls(n, bits, low, high, np.frombuffer(samples, "<u4"))

    def tobytes(self) -> bytes:
        return self.low + self.high + self.samples.tobytes()

    def select(self, i: int) -> int:
        """Number i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, rest = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place >> 3
        word = int.from_bytes(self.high[byte : byte + 8], "little") >> (place & 7) << (place & 7)
        while (count := word.bit_count()) <= rest:
            rest -= count
            byte += 8
            if byte >= len(self.high):
                raise ValueError("the boundary list is damaged")
            word = int.from_bytes(self.high[byte : byte + 8], "little")
        while (count := (word & 255).bit_count()) <= rest:
            rest -= count
            byte += 1
            word >>= 8
        bit = _SELECT[word & 255][rest]
        at = i * self.low_bits
        low = int.from_bytes(self.low[at >> 3 : (at + self.low_bits + 7) >> 3], "little") >> (at & 7)
        return ((byte * 8 + bit - i) << self.low_bits) | low & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """All numbers at once."""
        high = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[: self.n] - np.arange(self.n)
        planes = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        low = planes.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return (high.astype(np.int64) << self.low_bits) | low


_SELECT = [[j for j in range(8) if i >> j & 1] for i in range(256)]


def pack(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """A file of documents; ``ids``: each document's ids, ``width`` bytes each, little-endian."""
    nulls = sum(x is None for x in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    first = int(known[0]) if len(known) else 0
    span = int(known[-1]) - first if len(known) else 0
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    total = int(ends[-1])
    bounds = EliasFano.encode(ends, total)
    names = EliasFano.encode(known.astype(np.uint64) - np.uint64(first % (1 << 64)), span)
    head = HEADER.pack(len(ids), nulls, first, span, total, width, bounds.low_bits, names.low_bits)
    return b"".join([MAGIC, head, *ids, bounds.tobytes(), names.tobytes()])


class TokenFile:
    """Random access to a file's documents."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n, nulls, first, span, total, width, bits, name_bits = HEADER.unpack_from(data, 8)
        at, view = 8 + HEADER.size, memoryview(data)
        self.ids = np.frombuffer(view[at : at + total * width], f"<u{width}")
        at += total * width
        self.ends = EliasFano.read(view[at:], n, total, bits)
        at += sum(EliasFano.sizes(n, total, bits))
        self.names = EliasFano.read(view[at:], n - nulls, span, name_bits)
        self.n, self.nulls, self.first = n, nulls, first

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.names.select(i - self.nulls)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def rows_of(file: TokenFile, base: int) -> dict[str, list]:
    """The file's documents, one after the other: doc_id, start (``base`` for the first), n_tokens, ids_crc32."""
    names, starts, sizes, sums = [], [], [], []
    for i in range(file.n):
        own = file.document(i)
        names.append(file.doc_id(i))
        starts.append(base)
        sizes.append(len(own))
        sums.append(zlib.crc32(own.astype("<u4").tobytes()))
        base += len(own)
    return dict(zip(RESULT_ARROW.names, (names, starts, sizes, sums), strict=True))


class Pieces(dict):
    """Ids of the piece lead + key, as bytes. It holds two generations of up to ``most`` pieces: when the younger is full
    it becomes the older one, which is forgotten; what is used meanwhile comes back from it."""

    def __init__(self, encode, lead: str = "", most: int = 400_000):
        super().__init__()
        self.encode, self.lead, self.most, self.older = encode, lead, most, {}

    def __missing__(self, key: str) -> bytes:
        out = self.older.get(key)
        if out is None:
            if self.lead and (not key or key[-1].isspace()):
                raise KeyError(key)  # white space may join what follows: not a piece of its own
            out = self.encode(self.lead + key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = out
        return out


# What the byte-level pre-tokenizer makes of ASCII and of Latin letters (fixed: its own pattern, for these characters).
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile(rf"[\x20-\x7e\n\t\r{LATIN}]*")
PRE_TOKENS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\x20\n\t\r0-9{LATIN}]+|[\x20\n\t\r]+(?![^\x20\n\t\r])|[\x20\n\t\r]+"
)


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class CachedTokenizer:
    """A tokenizer of the tokenizers library that encodes each distinct piece of text once.

    The byte-level pre-tokenizer lets a space join only what follows it, unless it stands in a run of white space. A
    text may therefore be cut before each space that stands between two characters that are not white space, and its
    ids are those of its pieces. Texts with other spaces are cut at just those places by an expression. A piece of
    plain Latin text is cut into pre-tokens, which the library's BPE model encodes; any other piece, and any text where
    the vocabulary has another pre-tokenizer, goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.added = [t["content"] for t in kind["added_tokens"]]
        pre, model = kind["pre_tokenizer"] or {}, kind["model"]
        self.known = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex")
            and not pre.get("add_prefix_space")
            and not any((kind["normalizer"], kind["post_processor"], kind["truncation"], kind["padding"]))
            and model["type"] == "BPE"
            and not any((model.get("dropout"), model.get("unk_token"), model.get("end_of_word_suffix")))
            and not any(c.isspace() for t in self.added for c in t)
        )
        self.letters, self.model = byte_letters(), self.tokenizer.model
        self.space = self.letters[0x20]
        self.words = Pieces(self._word)
        self.tails, self.heads = Pieces(self._piece, " "), Pieces(self._piece)
        self.cuts = re.compile(r"(?<=\S)(?= \S)")

    def _bytes(self, ids: list[int]) -> bytes:
        return array.array(self.code, ids).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalpha():
            shown = word if word[0] != " " else self.space + word[1:]
        else:
            shown = word.encode().decode("latin-1").translate(self.letters)
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def _piece(self, piece: str) -> bytes:
        if piece[1:].isalpha() and (piece.isascii() or PLAIN.fullmatch(piece)) and (piece[0] == " " or piece[0].isalpha()):
            return self._word(piece)  # one pre-token, most often seen once
        if not PLAIN.fullmatch(piece) or any(t in piece for t in self.added):
            return self._bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, PRE_TOKENS.findall(piece)))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.known:
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *rest = text.split(" ")
        try:
            if first and not first[-1].isspace() or not rest:
                return self.heads[first] + b"".join(map(self.tails.__getitem__, rest))
        except KeyError:
            pass
        return b"".join(map(self.heads.__getitem__, self.cuts.split(text)))


_TOKENIZERS: dict[str, CachedTokenizer] = {}  # of this Python worker


def tokenizer_of(path: str) -> CachedTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = CachedTokenizer(path)
    return _TOKENIZERS[path]


WRITTEN = "file string, part bigint, number bigint, n_docs bigint, n_ids bigint"
WRITTEN_ARROW = pa.schema([("file", pa.string()), *((x, pa.int64()) for x in ("part", "number", "n_docs", "n_ids"))])
BLOCK_PARTS = 4096
HEAD = 16  # characters by which texts of one doc_id are dealt
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
RESULT_ARROW = pa.schema([(x, pa.int64()) for x in ("doc_id", "start", "n_tokens", "ids_crc32")])


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, *, end_id: int = 2, part_bytes: int = 16 << 20, file_ids: int = 8 << 20
) -> DataFrame:
    """Writes ``docs(doc_id, text)`` as token files under ``folder``; returns their manifest: file, n_docs, n_ids, and
    ``start``, the ids of all files before it.

    Rows are dealt by doc_id ranges of about ``part_bytes`` of text; a partition starts a new file after ``file_ids``
    ids. The manifest is a table in the shared folder that holds what accepted task attempts wrote. Starts are added up
    within blocks of ``BLOCK_PARTS`` partitions and over the blocks.
    """
    rows = id_and_text(docs)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("rows")).first()
    parts = max(1, -(-((size["n"] or 0) + 16 * size["rows"]) // part_bytes))
    first, then, head = (c.asc_nulls_first() for c in (F.col("doc_id"), F.col("text"), F.substring("text", 1, HEAD)))
    rows = rows.repartitionByRange(parts, first, head).sortWithinPartitions(first, then)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task, k = tokenizer_of(vocabulary), TaskContext.get(), 0
        end = np.array([end_id], tokenizer.dtype).tobytes()
        names, ids, total = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{task.partitionId():06d}-{k:04d}-{task.taskAttemptId()}.tok"
            write_file(folder, name, pack(names, ids, tokenizer.width))
            n = sum(map(len, ids)) // tokenizer.width
            value = {"file": f"{folder}/{name}", "part": task.partitionId(), "number": k, "n_docs": len(ids), "n_ids": n}
            return pa.RecordBatch.from_pylist([value], schema=WRITTEN_ARROW)

        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids.append(tokenizer.encode(text or "") + end)
                names.append(doc_id)
                total += len(ids[-1])
                if total >= file_ids * tokenizer.width:
                    yield flush()
                    names, ids, total, k = [], [], 0, k + 1
        if ids:
            yield flush()

    written = stored(rows.mapInArrow(run, WRITTEN), "token-manifest").withColumn("block", F.floor(F.col("part") / BLOCK_PARTS))
    before = lambda x, w: F.coalesce(F.sum(x).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = written.groupBy("block").agg(F.sum("n_ids").alias("n")).select("block", before("n", W.orderBy("block")).alias("base"))
    inside = written.withColumn("inside", before("n_ids", W.partitionBy("block").orderBy("part", "number")))
    return inside.join(blocks, "block").select("file", "part", "n_docs", "n_ids", (F.col("base") + F.col("inside")).alias("start"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """A row for each document of the manifest's files: doc_id, start (ids before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for path, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                yield pa.RecordBatch.from_pydict(rows_of(TokenFile(read_file(path)), base), RESULT_ARROW)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.repartitionById(n, F.pmod("part", F.lit(n)).cast("int"))
    return files.select("file", "start").mapInArrow(run, RESULT)


def round_trip(docs: DataFrame, vocabulary: str, *, end_id: int = 2, **sizes: int) -> DataFrame:
    """Writes the token files and reads them back."""
    folder = shared_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, vocabulary, end_id=end_id, **sizes))
