"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` turns documents into index segments: each row holds a bounded run of documents, its sorted-by-term
postings (token positions) and its dictionary. A document is never cut, no posting is shuffled, so a term that holds a
third of all tokens costs no more than its own positions. ``search`` sends the benchmark's phrases, in blocks of a
bounded size, to every segment: a phrase starts from its rarest term there, and the lists of its other terms, each
moved by the term's offset in the phrase, are intersected from rare to frequent.

Nulls and empty texts have no words; benchmark rows without an id or without words match nothing; rows that share an
id each give a row, and equal benchmark rows count once; whole texts are indexed, however long, each in one segment; only
doc_id (an integer), text and item_id are read, so other columns may have any name; an empty benchmark hits nothing; an
empty document table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import WORD_TABLE, Vocab, batches_of, id_and_text, shared_dir, sorted_unique, stored, texts
from docloom.llm.shared_files import read_file, write_file

BEFORE = 1 << 20  # more than a phrase and its slop are long
SEGMENT = "doc_ids array<bigint>, ends array<bigint>, terms binary, counts binary, postings binary"
SEGMENT_ARROW = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("terms", pa.binary()),
        ("counts", pa.binary()),
        ("postings", pa.binary()),
    ]
)
RESULT = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_near bigint, n_items bigint, items array<string>,"
    " near_items array<string>, items_sha256 string"
)
RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_near", pa.int64()),
        ("n_items", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("near_items", pa.list_(pa.string())),
        ("items_sha256", pa.string()),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(WORD_TABLE).split()


def build_index(docs: DataFrame, *, segment_tokens: int = 1_000_000) -> DataFrame:
    """Index segments of ``docs(doc_id, text)``; a segment closes once it holds ``segment_tokens`` tokens."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, parts, ids, ends, total = Vocab(), [], [], [], 0

        def close() -> pa.RecordBatch:
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            order = np.sort((tokens << 32) | np.arange(len(tokens)))
            row = {
                "doc_ids": ids,
                "ends": ends,
                "terms": b" ".join(vocab),
                "counts": np.bincount(tokens, minlength=len(vocab)).astype("<i4").tobytes(),
                "postings": (order & 0xFFFFFFFF).astype("<i4").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=SEGMENT_ARROW)

        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                words = words_of(text)
                parts.append(np.array(list(map(vocab.__getitem__, words)), dtype=np.int64))
                total += len(words)
                ids.append(doc_id)
                ends.append(total)
                if total >= segment_tokens or len(ids) >= segment_tokens:
                    yield close()
                    vocab, parts, ids, ends, total = Vocab(), [], [], [], 0
        if ids:
            yield close()

    return id_and_text(docs).mapInArrow(segments, SEGMENT)


def _phrases(rows: list[tuple[str, bytes]], width: int) -> dict:
    """A block of the query: distinct phrases as rows of term numbers (-1 beyond a short one) and their items."""
    vocab, phrases = Vocab(), {}
    for item, text in rows:
        words = words_of(text)
        numbers = [vocab[w] for w in words]
        for i in range(max(1, len(words) - width + 1) if words else 0):
            phrases.setdefault(tuple(numbers[i : i + width]), set()).add(item)
    matrix = np.full((len(phrases), width), -1, np.int64)
    for i, p in enumerate(phrases):
        matrix[i, : len(p)] = p
    return {"terms": list(vocab), "matrix": matrix, "items": [sorted(x) for x in phrases.values()]}


def query_blocks(benchmark: DataFrame, *, width: int, block_bytes: int = 8_000_000) -> list[str]:
    """The benchmark's phrases as files in the shared folder, of about ``block_bytes`` of text each; returns their names.

    Tasks build and read the blocks; the driver sees names alone.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    rows = rows.where("item is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    if not size:
        return []
    n = -(-size // block_bytes)
    folder = shared_dir(benchmark.sparkSession, "phrases")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [x for b in batches_of(batches) for x in zip(b.column("item").to_pylist(), texts(b), strict=True)]
        if own:
            task = TaskContext.get()
            name = f"block-{task.partitionId():06d}-{task.taskAttemptId()}"
            write_file(folder, name, pickle.dumps(_phrases(own, width)))
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"]})

    dealt = rows.repartitionById(n, F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int"))
    return sorted(r["file"] for r in dealt.mapInArrow(run, "file string").collect())


_BLOCKS: dict[str, dict] = {}  # the last block that this Python worker read


def _block(path: str) -> dict:
    if path not in _BLOCKS:
        _BLOCKS.clear()
        _BLOCKS[path] = pickle.loads(read_file(path))
    return _BLOCKS[path]


def search(index: DataFrame, blocks: list[str], *, slop: int = 0) -> DataFrame:
    """Exact and near matches of the blocks' phrases in an index, one row per document.

    A phrase matches exactly at s if each of its terms stands at s plus its offset. It matches nearly at s if each term
    stands within ``slop`` words of that place, all in one document (s itself may lie before it).
    n_hit counts words in exact matches, n_near those in near ones (exact ones included).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for row in batch.to_pylist():
                yield _search_segment(row, blocks, slop)

    return index.mapInArrow(run, RESULT)


def _search_segment(row: dict, blocks: list[str], slop: int) -> pa.RecordBatch:
    ends = np.array(row["ends"], np.int64)
    begins = np.concatenate(([0], ends[:-1]))
    n = int(ends[-1])
    counts, postings = np.frombuffer(row["counts"], "<i4"), np.frombuffer(row["postings"], "<i4")
    offsets = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    terms = {w: i for i, w in enumerate(row["terms"].split(b" "))} if row["terms"] else {}
    cover = {kind: np.zeros(n + 1, np.int32) for kind in ("exact", "near")}
    items: dict[str, dict[int, set]] = {"exact": {}, "near": {}}
    for path in blocks:
        query = _block(path)
        own = np.array([terms.get(w, -1) for w in query["terms"]] + [-1], np.int64)
        matrix = own[query["matrix"]]
        used = query["matrix"] >= 0
        for k in np.flatnonzero(((matrix >= 0) | ~used).all(axis=1)):
            size = int(used[k].sum())
            at = matrix[k, :size]
            order = np.argsort(counts[at], kind="stable")
            first = int(order[0])
            anchors = postings[offsets[at[first]] : offsets[at[first] + 1]].astype(np.int64)
            doc = np.searchsorted(ends, anchors, side="right")
            starts = anchors - first
            if slop:  # every start that the rarest term may stand near
                starts = (starts[:, None] + np.arange(-slop, slop + 1)).ravel()
                doc = np.repeat(doc, 2 * slop + 1)
                new = sorted_unique((doc << 32) + starts + BEFORE)  # a start may lie before its document
                doc, starts = new >> 32, (new & 0xFFFFFFFF) - BEFORE
            exact = np.ones(len(starts), bool)
            for j in order if slop else order[1:]:
                places = postings[offsets[at[j]] : offsets[at[j] + 1]]
                i = np.searchsorted(places, np.maximum(starts + int(j) - slop, begins[doc]))
                found = places[np.minimum(i, len(places) - 1)]
                near = (i < len(places)) & (found <= starts + int(j) + slop) & (found < ends[doc])
                if slop:
                    i = np.minimum(np.searchsorted(places, starts + int(j)), len(places) - 1)
                    exact &= places[i] == starts + int(j)
                else:
                    exact &= near
                starts, exact, doc = starts[near], exact[near], doc[near]
                if not len(starts):
                    break
            exact &= (starts >= begins[doc]) & (starts + size <= ends[doc])
            for kind, keep in (("exact", exact), ("near", exact | (slop > 0))):
                s, d = starts[keep], doc[keep]
                np.add.at(cover[kind], np.maximum(s, begins[d]), 1)
                np.add.at(cover[kind], np.minimum(s + size, ends[d]), -1)
                for x in np.unique(d).tolist():
                    items[kind].setdefault(x, set()).update(query["items"][k])
    hit = {kind: np.concatenate(([0], np.cumsum(np.cumsum(c[:n]) > 0))) for kind, c in cover.items()}
    found = {kind: [sorted(items[kind].get(i, ())) for i in range(len(ends))] for kind in items}
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": row["doc_ids"],
            "n_words": ends - begins,
            "n_hit": hit["exact"][ends] - hit["exact"][begins],
            "n_near": hit["near"][ends] - hit["near"][begins],
            "n_items": [len(x) for x in found["exact"]],
            "items": found["exact"],
            "near_items": found["near"],
            "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in found["exact"]],
        },
        schema=RESULT_ARROW,
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, slop: int = 0) -> DataFrame:
    """Per document, the benchmark items of which it holds a phrase of ``width`` words (or the whole, if shorter)."""
    index = stored(build_index(docs), "positions", row_group=16 << 20)
    return search(index, query_blocks(benchmark, width=width), slop=slop)
