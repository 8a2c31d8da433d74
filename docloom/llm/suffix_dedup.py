"""Repeated passages by sparse suffix arrays: suffixes at minimiser positions, sorted, compared, extended.

A passage of LENGTH words holds LENGTH - K + 1 runs of K words; the run with the least hash (the leftmost of equals) is
its minimiser. Equal passages have it at the same place, so suffixes that start at minimisers suffice. They are met in
three exchanges:

1. each chunk of documents asks how often the K-word run of each of its suffixes occurs; single ones are dropped;
2. the others travel, each once, with the words that its passages can reach, to the range of their run's hash. There
   they are sorted by what follows and by what stands before; the longest common prefix with a neighbour bounds how far
   any match can reach to the right, and to the left. Of two suffixes that is the answer; of three or more the passages
   within both bounds are compared at every left extension, as the partner on the left need not be the one on the right;
3. each chunk learns which of its passages repeat, and which of them have an earlier copy (smaller doc_id, then place).

A run that occurs more than ``hot_run`` times does not meet in one place. Its suffixes send the hashes of their passages,
each distinct one of a chunk once with its number and first occurrence, to the ranges of those hashes: a passage that
stands in a third of all documents is one short row a chunk, and what stands around it differs and spreads.

A word is repeated if it stands in a passage of LENGTH words that occurs twice or more, in whatever documents. Longer
repeats are unions of such passages. Words are lower-case runs of letters and digits; they are compared by hashes (32
bits each, over LENGTH words). Texts of fewer than LENGTH words, nulls and empty texts have no passage; very long texts
are one document each, never cut. A null doc_id comes after all others. Rows that share an id are documents of their own,
ordered by their text's hash; equal rows are interchangeable. Only doc_id (an integer) and text are read, so other columns
may have any name. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import WORD_TABLE, Vocab, batches_of, id_and_text, mix, stored, texts
from docloom.llm.deleted_interpolation import _grown, _packed, _parts, _shrunk, _unpacked, bounds_of, by_chunk, grouped, ranges_for
from docloom.llm.jaccard_join import hash_words

LENGTH, K = 50, 10
REACH = LENGTH - K  # the farthest that a passage begins before its minimiser
FACTOR = np.uint64(0xD6E8FEB86659FD93)
LAST = 2**63 - 1


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in text.split(", ")])


CHUNKS = (
    "chunk string, doc_ids array<bigint>, ends array<bigint>, ties binary, hashes binary, tokens binary, places binary,"
    " least binary, most binary, firsts binary"
)
CHUNKS_ARROW = _schema(CHUNKS)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for j in range(n):
        out = out * FACTOR + words[j : j + len(out)]
    return mix(out)


def minimisers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct minimiser places of a document's passages, and the least and most words of a passage before each."""
    if len(words) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none
    runs = run_hashes(words, K)
    views = np.lib.stride_tricks.sliding_window_view(runs, REACH + 1)
    before = np.concatenate([views[i : i + 20_000].argmin(axis=1) for i in range(0, len(views), 20_000)])
    at = np.arange(len(before)) + before
    new = np.concatenate(([True], at[1:] != at[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1
    return at[first], before[last], before[first]


def same_surroundings(
    words: np.ndarray, places: np.ndarray, least: np.ndarray, most: np.ndarray, docs: np.ndarray, ties: np.ndarray
) -> np.ndarray:
    """For each suffix the first one (by document, then place) with the same passages around it: itself, if it is alone.

    Copies within a chunk thus travel as one. Surroundings are compared by a 64-bit hash.
    """
    key = mix(least.astype(np.uint64) << np.uint64(8) | most.astype(np.uint64))
    for c in range(-REACH, LENGTH):
        inside = (c >= -most) & (c < LENGTH - least)
        own = words[np.clip(places + c, 0, max(0, len(words) - 1))] if len(words) else key
        key = key * FACTOR + np.where(inside, own, np.uint64(0))
    key = mix(key)
    order = np.lexsort((places, ties, docs, key))
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))[: len(order)]
    firsts = np.empty(len(order), np.int64)
    firsts[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    return firsts


def chunks(docs: DataFrame, *, chunk_tokens: int = 1_000_000) -> DataFrame:
    """Tokenised documents with their minimisers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, vocab, tokens, ids, ties, ends = TaskContext.get().partitionId(), 0, Vocab(), [], [], [], [0]

        def row() -> pa.RecordBatch:
            hashes = (hash_words(list(vocab)) >> np.uint64(32)).astype("<u4")
            cat = np.concatenate(tokens)
            words = hashes.astype(np.uint64)[cat] if len(cat) else np.zeros(0, np.uint64)
            found = [minimisers(words[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            places = np.concatenate([x[0] + a for x, a in zip(found, ends, strict=False)])
            least, most = (np.concatenate([x[i] for x in found]) for i in (1, 2))
            numbers = np.array([LAST if x is None else x for x in ids], np.int64)
            doc = np.searchsorted(np.array(ends[1:]), places, side="right")
            own = np.array(ties, np.int64)
            value = {
                "chunk": f"{part}-{made}",
                "doc_ids": ids,
                "ends": ends[1:],
                "ties": own.astype("<i8").tobytes(),
                "hashes": hashes.tobytes(),
                "tokens": cat.astype("<i4").tobytes(),
                "places": places.astype("<i4").tobytes(),
                "least": least.astype(np.uint8).tobytes(),
                "most": most.astype(np.uint8).tobytes(),
                "firsts": same_surroundings(words, places, least, most, numbers[doc], own[doc]).astype("<i4").tobytes(),
            }
            return pa.RecordBatch.from_pylist([value], schema=CHUNKS_ARROW)

        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                own = np.array(list(map(vocab.__getitem__, text.translate(WORD_TABLE).split())), np.int32)
                tokens.append(own)
                ids.append(doc_id)
                ties.append(xxhash.xxh3_64_intdigest(text) >> 1)
                ends.append(ends[-1] + len(own))
                if ends[-1] >= chunk_tokens or len(ids) >= chunk_tokens:
                    yield row()
                    made, vocab, tokens, ids, ties, ends = made + 1, Vocab(), [], [], [], [0]
        if ids:
            yield row()

    return id_and_text(docs).mapInArrow(run, CHUNKS)


def _suffixes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a chunk, its minimisers' places and their runs' hashes, mixed anew: minimisers have low hashes, and ranges
    of those would be uneven."""
    hashes, tokens = np.frombuffer(row["hashes"], "<u4").astype(np.uint64), np.frombuffer(row["tokens"], "<i4")
    words, places = hashes[tokens], np.frombuffer(row["places"], "<i4").astype(np.int64)
    key = np.zeros(len(places), np.uint64)
    for j in range(K):
        key = key * FACTOR + words[places + j]
    return words, places, mix(mix(key))


ASK = "range bigint, chunk string, keys binary, counts binary"
ANSWER = "chunk string, range bigint, many binary"
SINGLE, SHARED, HOT = 0, 1, 2


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each occurs."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[at], np.diff(np.concatenate((at, [len(keys)])))[: len(at)]


def ask(table: DataFrame, ranges: int) -> DataFrame:
    """The distinct runs of each chunk's suffixes, sorted, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for row in batch.to_pylist():
                keys, counts = _counted(_suffixes(row)[2])
                cuts = bounds_of(keys, ranges)
                some = [i for i in range(ranges) if cuts[i] < cuts[i + 1]]
                columns = [
                    some,
                    [row["chunk"]] * len(some),
                    [_packed(keys[cuts[i] : cuts[i + 1]]) for i in some],
                    [_shrunk(counts[cuts[i] : cuts[i + 1]]) for i in some],
                ]
                yield pa.RecordBatch.from_pydict(dict(zip(_schema(ASK).names, columns, strict=True)), _schema(ASK))

    return table.mapInArrow(run, ASK)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows by their range, ranges dealt evenly."""
    n = _parts(rows)
    return rows.repartitionById(n, F.pmod("range", F.lit(n)).cast("int")).sortWithinPartitions("range")


def answer(asked: DataFrame, hot_run: int) -> DataFrame:
    """For each key of a chunk, in its order, whether it occurs once, more often, or more than ``hot_run`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "range"):
            keys = [_unpacked(r["keys"]) for r in rows]
            cat, counts = np.concatenate(keys), np.concatenate([_grown(r["counts"]) for r in rows])
            order = np.argsort(cat, kind="stable")
            at = np.flatnonzero(np.concatenate(([True], cat[order][1:] != cat[order][:-1])))
            total = np.add.reduceat(counts[order], at)
            state = np.where(total > hot_run, HOT, np.where(total > 1, SHARED, SINGLE)).astype(np.uint8)
            of = np.empty(len(cat), np.uint8)
            of[order] = np.repeat(state, np.diff(np.concatenate((at, [len(cat)]))))
            ends = np.cumsum([len(k) for k in keys])
            own = [of[b - len(k) : b] for b, k in zip(ends, keys, strict=True)]
            out = {
                "chunk": [r["chunk"] for r in rows],
                "range": [r["range"] for r in rows],
                "many": [len(x).to_bytes(4, "little") + np.packbits(x > 0).tobytes() + np.packbits(x == HOT).tobytes() for x in own],
            }
            yield pa.RecordBatch.from_pydict(out, _schema(ANSWER))

    return _dealt(asked).mapInArrow(run, ANSWER)


def _states(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.unpackbits(np.frombuffer(data, np.uint8, offset=4).reshape(2, -1), axis=1)[:, :n] if n else np.zeros((2, 0), np.uint8)
    return planes.sum(axis=0, dtype=np.uint8)


SUFFIXES = (
    "range bigint, chunk string, index binary, doc binary, tie binary, place binary, least binary, most binary, alike binary,"
    " words binary, keys binary, sizes binary, counts binary"
)


def windows(words: np.ndarray, places: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All passages of some suffixes: which (suffix * (REACH + 1) + left extension), and their hashes."""
    which, keys = [], []
    for a in range(REACH + 1):
        own = np.flatnonzero((least <= a) & (a <= most))
        key = np.zeros(len(own), np.uint64)
        for c in range(LENGTH if len(own) else 0):
            key = key * FACTOR + words[places[own] - a + c]
        which.append(own * (REACH + 1) + a)
        keys.append(mix(key))
    return np.concatenate(which), np.concatenate(keys)


def suffixes(table: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """The suffixes that share their run: a row for each chunk and range, with the words around each suffix.

    Of suffixes with the same surroundings a chunk sends the first, marked ``alike``. Words that stand outside the
    document, or that no passage of the suffix reaches, are 0. Of hot runs the passages' hashes go instead (``keys``:
    distinct ones, ``sizes``: how many suffixes here have each, ``index``: which), with the first occurrence of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "chunk"):
            row = rows[0]
            words, places, keys = _suffixes(row)
            states = np.concatenate([_states(r["many"]) for r in rows[1:]] or [np.zeros(0, np.uint8)])
            order = np.argsort(keys, kind="stable")
            state = states[np.cumsum(np.concatenate(([True], keys[order][1:] != keys[order][:-1]))[: len(order)]) - 1]
            firsts = np.frombuffer(row["firsts"], "<i4").astype(np.int64)
            alike = np.bincount(firsts, minlength=len(firsts)) > 1
            least, most = (np.frombuffer(row[x], np.uint8).astype(np.int64) for x in ("least", "most"))
            ends = np.array(row["ends"], np.int64)
            doc = np.searchsorted(ends, places, side="right")
            ids = np.array([LAST if x is None else x for x in row["doc_ids"]], np.int64)[doc]
            ties = np.frombuffer(row["ties"], "<i8")[doc]
            out: dict[str, list] = {x: [] for x in _schema(SUFFIXES).names}

            def send(**values) -> None:
                for name in out:
                    out[name].append(values.get(name))

            kept = order[state == SHARED]
            kept = kept[firsts[kept] == kept]
            cuts = bounds_of(keys[kept], ranges)
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                own = kept[cuts[i] : cuts[i + 1]]
                offset = np.arange(-REACH, LENGTH)
                around = words[np.clip(places[own][:, None] + offset, 0, max(0, len(words) - 1))].astype("<u4")
                around[(offset < -most[own][:, None]) | (offset >= LENGTH - least[own][:, None])] = 0
                send(
                    range=i, chunk=row["chunk"], index=own.astype("<i4").tobytes(), words=around.tobytes(),
                    doc=ids[own].astype("<i8").tobytes(), tie=ties[own].astype("<i8").tobytes(), place=places[own].astype("<i4").tobytes(),
                    least=least[own].astype(np.uint8).tobytes(), most=most[own].astype(np.uint8).tobytes(), alike=alike[own].astype(np.uint8).tobytes(),
                )
            hot = order[state == HOT]
            hot = hot[firsts[hot] == hot]
            which, passages = windows(words, places[hot], least[hot], most[hot])
            own, extension = hot[which // (REACH + 1)], which % (REACH + 1)
            starts = places[own] - extension
            by = np.lexsort((starts, ties[own], ids[own], passages))
            passages, own, code = passages[by], own[by], (own * (REACH + 1) + extension)[by]
            at = np.flatnonzero(np.concatenate(([True], passages[1:] != passages[:-1]))[: len(passages)])
            sizes = np.diff(np.concatenate((at, [len(passages)])))[: len(at)]
            counts = np.add.reduceat(1 + alike[own].astype(np.int64), at) if len(at) else sizes
            cuts = bounds_of(passages[at], ranges)
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                here = slice(cuts[i], cuts[i + 1])
                first = at[here]
                last = first[-1] + sizes[here][-1]
                send(
                    range=i, chunk=row["chunk"], index=code[first[0] : last].astype("<i4").tobytes(),
                    keys=_packed(passages[first]), sizes=_shrunk(sizes[here]), counts=_shrunk(counts[here]),
                    doc=ids[own[first]].astype("<i8").tobytes(), tie=ties[own[first]].astype("<i8").tobytes(),
                    place=starts[by][first].astype("<i4").tobytes(),
                )
            yield pa.RecordBatch.from_pydict(out, _schema(SUFFIXES))

    one = table.withColumn("range", F.lit(-1).cast("long")).select(
        "chunk", "range", "doc_ids", "ends", "ties", "hashes", "tokens", "places", "least", "most", "firsts"
    )
    both = one.unionByName(answers.select("chunk", "range", "many"), allowMissingColumns=True)
    dealt = by_chunk(both).sortWithinPartitions("chunk", "range")
    return dealt.mapInArrow(run, SUFFIXES)


def compare(around: np.ndarray, least: np.ndarray, most: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which passages of each suffix repeat, and which have an earlier copy: bit a of a mask for left extension a.

    ``around``: REACH words before and LENGTH words from each suffix on; ``rank``: order of the occurrences.
    """
    n = len(around)
    right = np.ascontiguousarray(around[:, REACH:])
    left = around[:, REACH - 1 :: -1]
    order = np.argsort(right.astype(">u4").view(f"S{4 * LENGTH}").ravel(), kind="stable")
    group = np.concatenate(([0], np.cumsum((right[order][1:, :K] != right[order][:-1, :K]).any(axis=1))))
    size = np.bincount(group)[group]
    extension = np.arange(REACH + 1)
    bits = np.uint64(1) << extension.astype(np.uint64)
    repeat, later = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    # pairs: the two neighbours are all there is
    pair = np.flatnonzero((size[:-1] == 2) & (group[:-1] == group[1:])) if n > 1 else np.zeros(0, np.int64)
    i, j = order[pair], order[pair + 1]
    lcp = lambda x, y: np.where((d := x != y).any(axis=1), d.argmax(axis=1), x.shape[1])
    to_right, to_left = lcp(right[i], right[j]), lcp(left[i], left[j])
    # words beyond a suffix's own passages are 0, so both ends are cut to what both reach
    low = np.maximum(np.maximum(LENGTH - to_right, least[i]), least[j])
    high = np.minimum(np.minimum(to_left, most[i]), most[j])
    mask = (((extension >= low[:, None]) & (extension <= high[:, None])) * bits).sum(axis=1, dtype=np.uint64)
    repeat[i], repeat[j] = mask, mask
    second = np.where(rank[i] < rank[j], j, i)
    later[second] = mask
    # three or more: how far any neighbour on either side agrees bounds the passages that may repeat
    rows = order[size > 2]
    if not len(rows):
        return repeat, later
    groups = group[size > 2]
    reach_right = _longest_with_neighbour(right[rows], groups)
    by_left = np.lexsort((np.ascontiguousarray(left[rows]).astype(">u4").view(f"S{4 * REACH}").ravel(), groups))
    reach_left = np.empty(len(rows), np.int64)
    reach_left[by_left] = _longest_with_neighbour(left[rows[by_left]], groups[by_left])
    names = mix(groups.astype(np.uint64))
    low = np.maximum(least[rows], LENGTH - reach_right)
    high = np.minimum(most[rows], reach_left)
    for a in range(REACH + 1):
        own = (low <= a) & (a <= high)
        at, key = rows[own], names[own]
        for c in range(REACH - a, REACH - a + LENGTH):
            key = key * FACTOR + around[at, c]
        key = mix(key)
        by = np.lexsort((rank[at], key))
        same = key[by][1:] == key[by][:-1]
        more = np.concatenate(([False], same))
        any_of = more | np.concatenate((same, [False])) if len(by) else more[:0]
        repeat[at[by[any_of]]] |= bits[a]
        later[at[by[more[: len(by)]]]] |= bits[a]
    return repeat, later


def _longest_with_neighbour(words: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """The longest common prefix of each row of a sorted list with the row before or after it in its group."""
    differs = words[1:] != words[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), words.shape[1])
    common[groups[1:] != groups[:-1]] = 0
    return np.maximum(np.concatenate(([0], common)), np.concatenate((common, [0])))


def own_bits(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The mask of all passages of each suffix."""
    bits = np.uint64(1) << np.arange(REACH + 1, dtype=np.uint64)
    a = np.arange(REACH + 1)
    return (((a >= least[:, None]) & (a <= most[:, None])) * bits).sum(axis=1, dtype=np.uint64)


MASKS = "chunk string, range bigint, index binary, repeat binary, later binary"


def _compared(rows: list[dict]) -> pa.RecordBatch:
    """The masks of a range's suffixes."""
    join = lambda x, kind: np.frombuffer(b"".join(r[x] for r in rows), kind)
    sizes = [len(r["index"]) // 4 for r in rows]
    number = np.repeat(np.arange(len(rows)), sizes)
    place = np.lexsort((join("place", "<i4"), number, join("tie", "<i8"), join("doc", "<i8")))
    rank = np.empty(len(place), np.int64)
    rank[place] = np.arange(len(place))
    around = join("words", "<u4").reshape(-1, REACH + LENGTH)
    least, most = (join(x, np.uint8).astype(np.int64) for x in ("least", "most"))
    repeat, later = compare(around, least, most, rank)
    repeat |= np.where(join("alike", np.uint8) > 0, own_bits(least, most), np.uint64(0))
    ends = np.cumsum(sizes)
    columns = [
        [r["chunk"] for r in rows],
        [r["range"] for r in rows],
        [r["index"] for r in rows],
        [repeat[b - n : b].astype("<u8").tobytes() for b, n in zip(ends, sizes, strict=True)],
        [later[b - n : b].astype("<u8").tobytes() for b, n in zip(ends, sizes, strict=True)],
    ]
    return pa.RecordBatch.from_pydict(dict(zip(_schema(MASKS).names, columns, strict=True)), _schema(MASKS))


def _passages_met(rows: list[dict]) -> pa.RecordBatch:
    """Of a range's passages those that occur twice or more: which, and whether an earlier copy exists (no ``repeat``)."""
    keys = [_unpacked(r["keys"]) for r in rows]
    cat, counts = np.concatenate(keys), np.concatenate([_grown(r["counts"]) for r in rows])
    doc, tie = (np.concatenate([np.frombuffer(r[x], "<i8") for r in rows]) for x in ("doc", "tie"))
    number = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
    order = np.lexsort((number, tie, doc, cat))
    at = np.flatnonzero(np.concatenate(([True], cat[order][1:] != cat[order][:-1])))
    group = np.empty(len(cat), np.int64)
    group[order] = np.repeat(np.arange(len(at)), np.diff(np.concatenate((at, [len(cat)]))))
    many = np.add.reduceat(counts[order], at)[group] > 1
    first = np.zeros(len(cat), bool)
    first[order[at]] = True
    out: dict[str, list] = {x: [] for x in _schema(MASKS).names}
    ends = np.cumsum([len(k) for k in keys])
    for r, k, b in zip(rows, keys, ends, strict=True):
        sizes = _grown(r["sizes"])
        begins = np.cumsum(sizes) - sizes
        copied = np.ones(int(sizes.sum()), bool)
        copied[begins] = ~first[b - len(k) : b]
        keep = np.repeat(many[b - len(k) : b], sizes)
        if keep.any():
            index = np.frombuffer(r["index"], "<i4")[keep]
            for name, value in zip(out, (r["chunk"], r["range"], index.tobytes(), None, copied[keep].astype(np.uint8).tobytes()), strict=True):
                out[name].append(value)
    return pa.RecordBatch.from_pydict(out, _schema(MASKS))


def neighbours(met: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "range"):
            rows.sort(key=lambda r: r["chunk"])
            around, passages = [r for r in rows if r["keys"] is None], [r for r in rows if r["keys"] is not None]
            if around:
                yield _compared(around)
            if passages:
                yield _passages_met(passages)

    return _dealt(met).mapInArrow(run, MASKS)


RESULT = "doc_id bigint, n_words bigint, n_repeated bigint, n_copied bigint, spans string, copied_spans string"


def _spans(cover: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate(([0], cover.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def repeats(
    docs: DataFrame, *, chunk_tokens: int = 1_000_000, range_suffixes: int = 100_000, hot_run: int = 250
) -> DataFrame:
    """Documents with repeated passages: their words, those in repeats, those in later copies, and the word spans."""
    table = stored(chunks(docs, chunk_tokens=chunk_tokens), "suffix-chunks", row_group=16 << 20)
    total = table.agg(F.sum(F.octet_length("places") / 4).cast("long")).first()[0] or 0
    ranges = ranges_for(docs, total, range_suffixes)
    answers = stored(answer(ask(table, ranges), hot_run), "suffix-answers")
    masks = neighbours(suffixes(table, answers, ranges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "chunk"):
            row, out = rows[0], {x: [] for x in _schema(RESULT).names}
            places = np.frombuffer(row["places"], "<i4").astype(np.int64)
            ends = np.array(row["ends"], np.int64)
            n, cover = int(ends[-1]), {}
            firsts = np.frombuffer(row["firsts"], "<i4").astype(np.int64)
            others = np.flatnonzero(firsts != np.arange(len(firsts)))  # copies of another suffix of this chunk
            sizes = (np.frombuffer(row[x], np.uint8).astype(np.int64)[others] for x in ("least", "most"))
            local = {"index": others.astype("<i4").tobytes()} | dict.fromkeys(("repeat", "later"), own_bits(*sizes).tobytes())
            for kind in ("repeat", "later"):
                marks = np.zeros(n + 1, np.int32)
                for r in rows[1:]:
                    if r["repeat"] is None:  # passages of hot runs
                        code = np.frombuffer(r["index"], "<i4").astype(np.int64)
                        code = code[np.frombuffer(r["later"], np.uint8) > 0] if kind == "later" else code
                        starts = places[code // (REACH + 1)] - code % (REACH + 1)
                        np.add.at(marks, starts, 1)
                        np.add.at(marks, starts + LENGTH, -1)
                for r in [*(r for r in rows[1:] if r["repeat"] is not None), local]:
                    at, mask = places[np.frombuffer(r["index"], "<i4")], np.frombuffer(r[kind], "<u8")
                    for a in range(REACH + 1):
                        starts = at[(mask >> np.uint64(a)) & np.uint64(1) > 0] - a
                        np.add.at(marks, starts, 1)
                        np.add.at(marks, starts + LENGTH, -1)
                cover[kind] = np.cumsum(marks[:n]) > 0
            for doc_id, a, b in zip(row["doc_ids"], [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                all_of, copied = cover["repeat"][a:b], cover["later"][a:b]
                if not all_of.any():
                    continue
                values = [
                    doc_id,
                    b - a,
                    int(all_of.sum()),
                    int(copied.sum()),
                    ",".join(f"{x}:{y}" for x, y in _spans(all_of)),
                    ",".join(f"{x}:{y}" for x, y in _spans(copied)),
                ]
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, _schema(RESULT))

    one = table.select("chunk", F.lit(-1).cast("long").alias("range"), "doc_ids", "ends", "places", "least", "most", "firsts")
    both = one.unionByName(masks, allowMissingColumns=True)
    dealt = by_chunk(both).sortWithinPartitions("chunk", "range")
    return dealt.mapInArrow(run, RESULT)
