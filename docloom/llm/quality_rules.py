"""Line-first quality rules: judge lines, drop those that fail, then judge what is left of the document.

Lines are split at ``\\n``. A line without a word is neither kept nor lost. A line fails by

* punctuation: more than ``symbol_share`` of its characters (white space aside) are symbols, or it has
  ``unpunctuated_words`` words or more and no sentence punctuation of any script anywhere;
* navigation: two menu separators or more and at least one for every three words;
* boilerplate: one of the fixed phrases (English ones by default; ``phrases`` takes those of other languages).

A document is rejected if the whole text fails the base rules (too few words, too many words in repeated windows), or
if less than ``keep_share`` of its word characters stand in lines that pass. Null and empty texts have no words and
are rejected by the base rules. Rows are judged one by one, so repeated rows each give a row, and there are no ties. Very
long texts are judged whole, in batches of a bounded number of bytes beside them. Only doc_id (an integer) and text are
read, so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import Vocab, batches_of, id_and_text, mix, texts

RESULT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, n_lines bigint, n_lines_removed bigint, kept_chars bigint, kept boolean"
)
RESULT_ARROW = pa.schema(
    [
        (f.split()[0], {"bigint": pa.int64(), "boolean": pa.bool_()}[f.split()[1]])
        for f in RESULT.split(", ")
    ]
)
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
TAIL_BYTES = bytes(range(0x80, 0xC0))
# Fixed: marks that end or divide sentences, ASCII first, then Chinese, Arabic, Indic, Ethiopic, Armenian and Khmer ones.
SENTENCE_MARKS = ".!?,;:…。、，！？；：؟،؛۔।॥።፣՝։។"
ASCII_MARKS = bytes(ord(c) for c in SENTENCE_MARKS if c.isascii())
OTHER_MARKS = re.compile("|".join(c for c in SENTENCE_MARKS if not c.isascii()).encode())
SEPARATORS = re.compile(rb"\||>|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7")
# Fixed phrases (ASCII, either case).
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "accept cookies",
    "uses cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "subscribe to our newsletter",
    "click here to",
    "released under the",
    "is licensed under",
    "licensed under the",
    "lorem ipsum",
)


def boilerplate(phrases: tuple[str, ...]) -> re.Pattern:
    """Any of the phrases, ASCII letters in either case."""
    return re.compile("|".join(map(re.escape, phrases)).encode() or rb"(?!)", re.IGNORECASE)


BOILERPLATE_BYTES = boilerplate(BOILERPLATE)


def chars_of_words(text: bytes) -> int:
    """Code points that are not white space."""
    return len(text.translate(None, SPACE + TAIL_BYTES))


def line_fails(
    line: bytes, n_words: int, chars: int, *, symbol_share: float, unpunctuated_words: int, phrases: re.Pattern = BOILERPLATE_BYTES
) -> bool:
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols > symbol_share * chars:
        return True
    if n_words >= unpunctuated_words and len(line) == len(line.translate(None, ASCII_MARKS)):
        if line.isascii() or not OTHER_MARKS.search(line):
            return True
    separators = len(SEPARATORS.findall(line))
    return (separators >= 2 and 3 * separators >= n_words) or phrases.search(line) is not None


def repeated_words(docs: list[list[bytes]], width: int) -> np.ndarray:
    """For each list of words, how many stand in a window of ``width`` words that the same list holds twice or more.

    Windows are compared by 64-bit hashes salted with the document's number.
    """
    vocab = Vocab()
    ids = np.array([vocab[w] for words in docs for w in words], dtype=np.uint64)
    sizes = np.array([len(x) for x in docs], np.int64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(docs)), sizes)
    m = len(ids) - width + 1
    if m <= 0:
        return np.zeros(len(docs), np.int64)
    values, key = mix(ids), np.zeros(m, np.uint64)
    for j in range(width):
        key = key * np.uint64(0xD6E8FEB86659FD93) + values[j : j + m]
    inside = np.arange(m) + width <= ends[doc[:m]]
    at = np.flatnonzero(inside)
    key = mix(key[at] ^ mix(doc[at].astype(np.uint64)))
    ordered = np.sort(key)
    twice = np.zeros(len(key), bool)
    if len(key):
        dup = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(dup):
            i = np.minimum(np.searchsorted(dup, key), len(dup) - 1)
            twice = dup[i] == key
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + width, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return covered[ends] - covered[ends - sizes]


def figures(
    bodies: list[bytes],
    *,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    window: int = 8,
    keep_share: float = 0.5,
    symbol_share: float = 0.1,
    unpunctuated_words: int = 12,
    phrases: tuple[str, ...] = BOILERPLATE,
) -> list[tuple]:
    """The result's columns after doc_id, for each text."""
    known = boilerplate(phrases)
    words, out = [x.split() for x in bodies], []
    for text, own, repeat in zip(bodies, words, repeated_words(words, window).tolist(), strict=True):
        seen, dup, n_lines, removed, kept_chars = set(), 0, 0, 0, 0
        for line in text.split(b"\n"):
            n = len(line.split())
            if not n:
                continue
            n_lines += 1
            dup += line in seen
            seen.add(line)
            chars = chars_of_words(line)
            if line_fails(line, n, chars, symbol_share=symbol_share, unpunctuated_words=unpunctuated_words, phrases=known):
                removed += 1
            else:
                kept_chars += chars
        total = chars_of_words(text)
        failed = len(own) < min_words or 100 * repeat > max_repeat_percent * len(own)
        symbols = len(text) - len(text.translate(None, SYMBOLS))
        kept = not failed and kept_chars >= keep_share * total
        out.append((len(own), total, symbols, dup, repeat, failed, n_lines, removed, kept_chars, kept))
    return out


def verdicts(bodies: list[bytes], **rules) -> list[bool]:
    return [x[-1] for x in figures(bodies, **rules)]


def judge(docs: DataFrame, *, chunk_bytes: int = 4_000_000, **rules) -> DataFrame:
    """One row per document with its base figures, its lines' fate and the verdict; ``rules`` as in ``figures``."""

    def made(ids: list, bodies: list[bytes]) -> pa.RecordBatch:
        rows = [(i, *x) for i, x in zip(ids, figures(bodies, **rules), strict=True)]
        return pa.RecordBatch.from_pydict(
            dict(zip(RESULT_ARROW.names, zip(*rows, strict=True), strict=True)), schema=RESULT_ARROW
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bodies, total = [], [], 0
        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                ids.append(doc_id)
                bodies.append(text)
                total += len(text)
                if total >= chunk_bytes or len(ids) >= 20_000:
                    yield made(ids, bodies)
                    ids, bodies, total = [], [], 0
        if ids:
            yield made(ids, bodies)

    return id_and_text(docs).mapInArrow(run, RESULT)


def filter_documents(docs: DataFrame, **rules) -> DataFrame:
    """``docs`` (any columns, text among them) without rejected documents; the failing lines of the others go.

    ``n_chars``, where it is there, follows the text. Rules as in ``judge``.
    """
    spark_schema, names = docs.schema, docs.columns
    at = [i for i, x in enumerate(names) if x == "text"][-1]
    counts = [i for i, x in enumerate(names) if x == "n_chars"]
    line_rules = {k: rules[k] for k in ("symbol_share", "unpunctuated_words", "phrases") if k in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                bodies = texts(pa.RecordBatch.from_arrays([part.column(at)], ["text"]))
                keep = verdicts(bodies, **rules)
                part = part.filter(pa.array(keep))
                cleaned = [clean_lines(b, **line_rules) for b, k in zip(bodies, keep, strict=True) if k]
                columns = list(part.columns)
                columns[at] = pa.array([x.decode() for x in cleaned], part.schema.field(at).type)
                for i in counts:
                    columns[i] = pa.array([len(x.decode()) for x in cleaned]).cast(part.schema.field(i).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, spark_schema)


def clean_lines(
    text: bytes, *, symbol_share: float = 0.1, unpunctuated_words: int = 12, phrases: tuple[str, ...] = BOILERPLATE
) -> bytes:
    """The text without its failing lines."""
    out, known = [], boilerplate(phrases)
    for line in text.split(b"\n"):
        n = len(line.split())
        if not n or not line_fails(
            line, n, chars_of_words(line), symbol_share=symbol_share, unpunctuated_words=unpunctuated_words, phrases=known
        ):
            out.append(line)
    return b"\n".join(out)
