"""Deleted interpolation: a bigram model mixed from maximum-likelihood estimates by context-frequency buckets.

p(w | h) = a2 c(h, w) / c(h) + a1 c(w) / N + a0 / (V + 1), where the weights a depend on the bucket of c(h) (its
binary logarithm). They are learned by expectation-maximisation: a part of the training documents (crc32 remainder 1)
is held out from the counts, and the weights maximise the likelihood of its tokens under the counts of the rest. The
final estimates use the counts of all training documents.

Counting and look-up are one exchange. Documents become chunks of about a million tokens (a table in the shared
folder). A chunk sends each distinct key (a word's or pair's 64-bit hash) once, with its counts, to the key's range;
a range adds up and answers every chunk with the totals in the order in which it asked. So a word that makes up a
third of all tokens is one key a chunk, nothing is broadcast but the weights, and all counts are exact but for
collisions of 64-bit hashes. The driver sees sums and one histogram of a bounded number of bins: estimates are rounded to
a quarter of a doubling, with exact means in each bin, so learned weights differ a little from those of an EM over every
token (scores by less than 0.1 % in the tests; given the weights, scores are exact). A document's first word follows a
start of its own, seen as often as the end token.

A null text is the end token alone. A null doc_id counts as held out. Rows that share an id each give a row, and repeated
rows count as often as they stand there. A very long text is one document, never cut, in a chunk that it closes. Only
doc_id (an integer) and text are read, so other columns may have any name. Without training documents all weight is
uniform. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import ASCII_LOWER, Vocab, batches_of, id_and_text, mix, stored, texts
from docloom.llm.jaccard_join import hash_words

END, START = 0, np.uint64(0x5DEECE66D)
CHUNKS = "chunk string, kind int, doc_ids array<bigint>, ends array<bigint>, hashes binary, tokens binary"
CHUNKS_ARROW = pa.schema(
    [
        ("chunk", pa.string()),
        ("kind", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("hashes", pa.binary()),
        ("tokens", pa.binary()),
    ]
)
HELD_OUT, TUNING, TRAINING = 0, 1, 2


def kind_of(doc_id: int | None) -> int:
    """Held out, for tuning the weights, or for counts alone."""
    return HELD_OUT if doc_id is None else min(TRAINING, zlib.crc32(str(doc_id).encode()) % 10)


def chunks(docs: DataFrame, *, chunk_tokens: int = 1_000_000) -> DataFrame:
    """Tokenised documents of one kind each; word 0 of a chunk is the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        # (vocabulary, tokens, doc_ids, ends) of each kind
        new = lambda: (Vocab({b"\n": END}), [], [], [0])
        own = {k: new() for k in (HELD_OUT, TUNING, TRAINING)}

        def row(kind: int) -> pa.RecordBatch:
            vocab, tokens, ids, ends = own[kind]
            value = {
                "chunk": f"{part}-{made}",
                "kind": kind,
                "doc_ids": ids,
                "ends": ends[1:],
                "hashes": hash_words(list(vocab)).tobytes(),
                "tokens": np.concatenate(tokens).astype("<i4").tobytes(),
            }
            return pa.RecordBatch.from_pylist([value], schema=CHUNKS_ARROW)

        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                kind = kind_of(doc_id)
                vocab, tokens, ids, ends = own[kind]
                words = list(map(vocab.__getitem__, text.translate(ASCII_LOWER).split()))
                words.append(END)
                tokens.append(np.array(words, np.int32))
                ids.append(doc_id)
                ends.append(ends[-1] + len(words))
                if ends[-1] >= chunk_tokens:
                    yield row(kind)
                    made += 1
                    own[kind] = new()
        for kind, (_, _, ids, _) in own.items():
            if ids:
                yield row(kind)
                made += 1

    return id_and_text(docs).mapInArrow(run, CHUNKS)


def tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a chunk's tokens as words, as pairs with the word before, and as that word (the start: as the end)."""
    hashes, tokens = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["tokens"], "<i4")
    words = mix(hashes) & ~np.uint64(1)
    word = words[tokens]
    before = np.roll(word, 1)
    begins = np.concatenate(([0], row["ends"][:-1])).astype(np.int64)
    before[begins] = words[END]
    first = mix(before)
    first[begins] = START
    return word, mix(first + word * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1), before


def keys_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a chunk, sorted, and how often each occurs. The lowest bit marks pairs."""
    word, pair, _ = tokens_of(row)
    keys = np.sort(np.concatenate((word, pair)))
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.diff(np.concatenate((at, [len(keys)])))


def _shrunk(numbers: np.ndarray) -> bytes:
    """Numbers in the fewest bytes each that hold them all, the width first."""
    width = next(w for w in (1, 2, 4, 8) if not len(numbers) or int(numbers.max()) < 1 << 8 * w)
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def _grown(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


ASK = "range bigint, chunk string, kind int, keys binary, counts binary"
ASK_ARROW = pa.schema(
    [("range", pa.int64()), ("chunk", pa.string()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)
ANSWER = "chunk string, kind int, range bigint, train binary, rest binary, n array<bigint>"
ANSWER_ARROW = pa.schema(
    [
        ("chunk", pa.string()),
        ("kind", pa.int32()),
        ("range", pa.int64()),
        ("train", pa.binary()),
        ("rest", pa.binary()),
        ("n", pa.list_(pa.int64())),
    ]
)


def bounds_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of the key space begins among sorted keys."""
    edges = [(i << 64) // ranges for i in range(1, ranges)]
    return np.concatenate(([0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)])).astype(np.int64)


def ranges_for(df: DataFrame, keys: int, range_keys: int) -> int:
    """Ranges of about ``range_keys`` keys, one for each shuffle partition at least and 16 at most.

    A chunk sends a message to each range, so their number must not grow with the data as chunks do: it follows the
    session's number of shuffle partitions, which is chosen for the size of the data.
    """
    return min(max(_parts(df), -(-keys // range_keys)), 16 * _parts(df))


def ask(table: DataFrame, ranges: int) -> DataFrame:
    """What each chunk sends to each range of the keys. The top 32 bits of keys travel apart: they compress."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for row in batch.to_pylist():
                keys, counts = keys_of(row)
                cuts = bounds_of(keys, ranges)
                some = [i for i in range(ranges) if cuts[i] < cuts[i + 1]]
                columns = {
                    "range": some,
                    "chunk": [row["chunk"]] * len(some),
                    "kind": [row["kind"]] * len(some),
                    "keys": [_packed(keys[cuts[i] : cuts[i + 1]]) for i in some],
                    "counts": [_shrunk(counts[cuts[i] : cuts[i + 1]]) for i in some],
                }
                yield pa.RecordBatch.from_pydict(columns, ASK_ARROW)

    return table.mapInArrow(run, ASK)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as gaps in the fewest bytes that hold the largest gap (few ranges leave 5 or 6 of 8)."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + planes.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(data, np.uint8, offset=9).reshape(-1, data[0])
    wide = np.zeros((len(planes) + 1, 8), np.uint8)
    wide[1:, : data[0]] = planes
    wide[0] = np.frombuffer(data[1:9], np.uint8)
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Runs of rows with one key, from partitions that are sorted by it."""
    rows: list[dict] = []
    for batch in batches_of(batches):
        for row in batch.to_pylist():
            if rows and row[key] != rows[0][key]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def answer(asked: DataFrame) -> DataFrame:
    """Totals over training documents, and over those of them that do not tune, in each asker's order.

    A range's own sums (tokens and distinct words, over all training and without tuning) ride on its first row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "range"):
            keys = [_unpacked(r["keys"]) for r in rows]
            sizes = np.array([len(k) for k in keys])
            counts = [_grown(r["counts"]) for r in rows]
            cat = np.concatenate(keys)
            train = np.concatenate([c * (r["kind"] != HELD_OUT) for c, r in zip(counts, rows, strict=True)])
            rest = np.concatenate([c * (r["kind"] == TRAINING) for c, r in zip(counts, rows, strict=True)])
            order = np.argsort(cat)
            at = np.flatnonzero(np.concatenate(([True], cat[order][1:] != cat[order][:-1])))
            group = np.empty(len(cat), np.int64)
            group[order] = np.repeat(np.arange(len(at)), np.diff(np.concatenate((at, [len(cat)]))))
            totals = np.add.reduceat(train[order], at), np.add.reduceat(rest[order], at)
            word = (cat[order][at] & np.uint64(1)) == 0
            n = [int(x) for t in totals for x in (t[word].sum(), (t[word] > 0).sum())]
            ends = np.cumsum(sizes)
            out: dict[str, list] = {x: [] for x in ANSWER_ARROW.names}
            for r, a, b in zip(rows, ends - sizes, ends, strict=True):
                tuning = _shrunk(totals[1][group[a:b]]) if r["kind"] == TUNING else None
                values = r["chunk"], r["kind"], r["range"], _shrunk(totals[0][group[a:b]]), tuning, n if a == 0 else None
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
                if b == ends[-1] or len(out["chunk"]) >= 1000:
                    yield pa.RecordBatch.from_pydict(out, ANSWER_ARROW)
                    out = {x: [] for x in out}

    n = _parts(asked)
    dealt = asked.repartitionById(n, F.pmod("range", F.lit(n)).cast("int")).sortWithinPartitions("range")
    return dealt.mapInArrow(run, ANSWER)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_chunk(rows: DataFrame) -> DataFrame:
    """Rows dealt by their chunk ("partition-number"): evenly, as chunks are few and large."""
    n, parts = _parts(rows), F.split("chunk", "-")
    return rows.repartitionById(n, F.pmod(parts[0].cast("long") * 13 + parts[1].cast("long"), F.lit(n)).cast("int"))


def _meet(table: DataFrame, answers: DataFrame, which: str) -> DataFrame:
    """Each chunk's row (range -1) and its answers, next to each other."""
    one = table.select("chunk", F.lit(-1).cast("long").alias("range"), "doc_ids", "ends", "hashes", "tokens")
    one = one.withColumn("totals", F.lit(None).cast("binary"))
    more = answers.select("chunk", "range", F.col(which).alias("totals"))
    return by_chunk(one.unionByName(more, allowMissingColumns=True)).sortWithinPartitions("chunk", "range")


def looked_up(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """c(w), c(h, w) and c(h) of a chunk's tokens, from its row and its answers."""
    keys, _ = keys_of(rows[0])
    totals = np.concatenate([_grown(r["totals"]) for r in rows[1:]])
    return tuple(totals[np.searchsorted(keys, x)] for x in tokens_of(rows[0]))


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 and its binary logarithm."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


BINS = "bucket bigint, q2 bigint, q1 bigint, n bigint, r2 double, r1 double"
FINE = 4  # bins for each doubling


def histogram(table: DataFrame, answers: DataFrame, n: int, v: int) -> DataFrame:
    """Tuning tokens by bucket and by how often likelier than uniform the pair's and word's estimates make them.

    Its size is bounded by the number of bins (64 buckets, about 500 by 500 at most); sums keep the bins' means exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x.split()[0], pa.float64() if "double" in x else pa.int64()) for x in BINS.split(", ")])
        for rows in grouped(batches, "chunk"):
            word, pair, context = looked_up(rows)
            r1 = word / max(1, n) * (v + 1)
            r2 = pair / np.maximum(1, context) * (v + 1)
            q = [np.where(r > 0, np.round(np.log2(np.maximum(r, 1e-300)) * FINE).astype(np.int64), -9999) for r in (r2, r1)]
            bucket = bucket_of(context)
            code = (bucket * 20_000 + q[0] + 10_000) * 20_000 + q[1] + 10_000
            found, inverse = np.unique(code, return_inverse=True)
            columns = [
                found // 20_000 // 20_000,
                found // 20_000 % 20_000 - 10_000,
                found % 20_000 - 10_000,
                np.bincount(inverse),
                np.bincount(inverse, r2),
                np.bincount(inverse, r1),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

    met = _meet(table.where(F.col("kind") == TUNING), answers.where(F.col("kind") == TUNING), "rest")
    return met.mapInArrow(run, BINS).groupBy("bucket", "q2", "q1").agg(
        F.sum("n").alias("n"), F.sum("r2").alias("r2"), F.sum("r1").alias("r1")
    )


def learn(bins: list, *, rounds: int = 100, floor: float = 1e-6) -> np.ndarray:
    """Weights (pair, word, uniform) of 65 buckets by expectation-maximisation over the histogram.

    A bucket without tuning tokens takes the weights of the nearest bucket that has some.
    """
    out = np.full((65, 3), np.nan)
    for b in {r["bucket"] for r in bins}:
        own = [r for r in bins if r["bucket"] == b]
        n = np.array([r["n"] for r in own], float)
        ratio = np.stack([np.array([r["r2"] for r in own]) / n, np.array([r["r1"] for r in own]) / n, np.ones(len(n))], 1)
        weight = np.array([1.0, 1.0, 1.0]) / 3
        for _ in range(rounds):
            share = ratio * weight
            share /= share.sum(axis=1, keepdims=True)
            weight = np.maximum(n @ share / n.sum(), floor)
            weight /= weight.sum()
        out[b] = weight
    known = np.flatnonzero(~np.isnan(out[:, 0]))
    if not len(known):
        out[:] = 1 / 3
    for b in range(65):
        if np.isnan(out[b, 0]):
            out[b] = out[known[np.argmin(np.abs(known - b))]]
    if np.isnan(out[0]).any() or 0 not in known:  # a context that was never seen has no pairs
        out[0] = [0, *(out[0, 1:] / out[0, 1:].sum())]
    return out


RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double,"
    " score double"
)


def score(
    docs: DataFrame, *, chunk_tokens: int = 1_000_000, range_keys: int = 2_000_000, weights: np.ndarray | None = None
) -> DataFrame:
    """The model's and the base's log10 probability of every document. ``weights``: (pair, word, uniform) of 65 buckets;
    they are learned where none are given."""
    table = stored(chunks(docs, chunk_tokens=chunk_tokens), "chunks", row_group=16 << 20)
    tokens = table.agg(F.sum(F.octet_length("tokens") / 4).cast("long")).first()[0] or 0
    ranges = ranges_for(docs, tokens, range_keys)
    answers = stored(answer(ask(table, ranges)), "answers", row_group=16 << 20)
    sums = [F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(4)]
    n, v, n_rest, v_rest = answers.where("n is not null").agg(*sums).first()
    if weights is None:
        weights = learn(histogram(table, answers, n_rest, v_rest).collect())
    if not n:
        weights = np.tile([0.0, 0.0, 1.0], (65, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("held_out", pa.bool_()),
                ("n_tokens", pa.int64()),
                ("n_known", pa.int64()),
                ("train_tokens", pa.int64()),
                ("base_score", pa.float64()),
                ("score", pa.float64()),
            ]
        )
        for rows in grouped(batches, "chunk"):
            word, pair, context = looked_up(rows)
            a2, a1, a0 = weights[bucket_of(context)].T
            p = a2 * (pair / np.maximum(1, context)) + a1 * (word / max(1, n)) + a0 / (v + 1)
            base = np.log10((word + 0.1) / (n + 0.1 * (v + 1)))
            ids, ends = rows[0]["doc_ids"], np.array(rows[0]["ends"], np.int64)
            begins = np.concatenate(([0], ends[:-1]))
            columns = [
                ids,
                [kind_of(x) == HELD_OUT for x in ids],
                ends - begins,
                np.add.reduceat((word > 0).astype(np.int64), begins),
                [n] * len(ids),
                np.add.reduceat(base, begins),
                np.add.reduceat(np.log10(p), begins),
            ]
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema)

    return _meet(table, answers, "train").mapInArrow(run, RESULT)
