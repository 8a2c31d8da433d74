"""Repeated runs of lines by a suffix array over line numbers, built by distributed prefix doubling.

A document is a sequence of lines (those with a word; blank lines stay in the text but not in the sequence). Suffixes
are ranked by their first line, then by their first 2, 4, 8, ... lines: a round sorts the pairs (rank of i, rank of
i + depth) by ranges and numbers them anew, so ranks stay in suffix order. Suffixes that share their rank with no other
leave after each round, and doubling goes on until none is left.

Suffixes that share a rank at some depth are an interval of the array. Its longest common prefix lies between that depth
and twice it; it is found for each suffix by going down again through the kept ranks (``descend``): at each smaller
depth the pairs (interval, rank of i + length) tell which suffixes of an interval agree for that much longer, and they
form an interval within it. Of those that went deeper one stays behind as a witness for all, so that the others still
find their partners and ``copies`` counts them. What a suffix ends with is the deepest interval that holds it: the length
of the longest run from there that occurs elsewhere, and how often that run occurs. A run is maximal (``runs``) if the
line before it does not lengthen it: the suffix one line earlier does not end in a run that reaches as far.

In every interval of ``min_run`` lines the first occurrence (smallest doc_id, then text hash, then place) stays; the
lines of the others are deleted (``removed``). Shorter runs are judged at their own depth. ``repeats`` has the removed
lines and

* later copies of runs of fewer than ``min_run`` lines that hold ``long_words`` words (between blanks) or more;
* the lines of a document of fewer than ``min_run`` lines that are all the lines of an earlier document.

A chunk of documents sends each distinct pair once with its number, so a line that is a third of all lines is one row
a chunk; a range reads them as a stream and holds eight bytes for each row of the pair that it is at. The driver sees
sums for each range. Lines are compared by 63-bit hashes.

Nulls and empty texts have no lines; a null doc_id comes after all others; rows that share an id are documents of their
own, ordered by their text's hash, so equal rows are interchangeable; a very long text is one document however many lines
it has, and any other column may have any name (only doc_id, an integer, and text are read); empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import batches_of, id_and_text, mix, stored, texts
from docloom.llm.deleted_interpolation import _parts, grouped
from docloom.llm.jaccard_join import hash_words
from docloom.llm.suffix_dedup import FACTOR, _schema, _spans

LAST = 2**63 - 1
BODY, STATE, LEVEL, DEEPER, ANSWERS, JUDGED = range(6)  # kinds of rows that a chunk meets
CHUNKS = "chunk bigint, doc_ids array<bigint>, ids binary, ties binary, ends binary, numbers binary, words binary, hashes binary"
ASKS = "range int, r1 bigint, r2 bigint, doc bigint, tie bigint, chunk bigint, place bigint, n bigint, w bigint"
ORDER = ("r1", "r2", "doc", "tie", "chunk", "place")
REPLIES = "chunk bigint, data binary, range int, count bigint, shared bigint"
FIELDS = 7  # of a reply: r1, r2, range, number in it, members, present members, place of the first (-1: elsewhere)
LEVELS = "chunk bigint, ids binary, ties binary, ends binary, places binary, ranks binary, sizes binary, firsts binary, wholes binary"
STATES = "chunk bigint, ends binary, at binary, stays binary"
TAGS = 64  # numbers of different exchanges never meet
TASK_ROWS = 100_000  # lines or suffixes of a task


def _tasks(most: int, lines: int, suffixes: int | None = None) -> int:
    """Tasks for all lines, or for the suffixes that are left of them (a chunk costs a sixteenth of its lines besides)."""
    rows = lines if suffixes is None else suffixes + lines // 16
    return max(1, min(most, -(-rows // TASK_ROWS)))


def _numbers(data: bytes | None, width: int = 1) -> np.ndarray:
    out = np.frombuffer(data or b"", "<i8")
    return out if width == 1 else out.reshape(-1, width)


def _bytes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).astype("<i8").tobytes()


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_schema(schema))


def chunks(docs: DataFrame, *, chunk_lines: int = 200_000) -> DataFrame:
    """Documents as sequences of 63-bit line hashes, with their line numbers and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, hashes, numbers, words, ids, ties, ends = TaskContext.get().partitionId(), 0, [], [], [], [], [], []

        def row() -> pa.RecordBatch:
            value = {
                "chunk": part << 20 | made,
                "doc_ids": ids,
                "ids": _bytes(np.array([LAST if x is None else x for x in ids], np.int64)),
                "ties": _bytes(np.array(ties, np.int64)),
                "ends": _bytes(np.array(ends, np.int64)),
                "numbers": np.array(numbers, "<i4").tobytes(),
                "words": np.array(words, "<i4").tobytes(),
                "hashes": (np.concatenate(hashes) >> np.uint64(1)).astype("<i8").tobytes(),
            }
            return _batch([value], CHUNKS)

        for batch in batches_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                lines = []
                for number, line in enumerate(text.split(b"\n")):
                    if line and not line.isspace():
                        lines.append(line)
                        numbers.append(number)
                        words.append(len(line.split()))
                hashes.append(hash_words(lines))
                ids.append(doc_id)
                ties.append(xxhash.xxh3_64_intdigest(text) >> 1)
                ends.append(len(numbers))
                if len(numbers) >= chunk_lines or len(ids) >= chunk_lines:
                    yield row()
                    made, hashes, numbers, words, ids, ties, ends = made + 1, [], [], [], [], [], []
        if ids:
            yield row()

    return id_and_text(docs).mapInArrow(run, CHUNKS)


def _gathered(keys: list[np.ndarray], order: list[np.ndarray], n: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (r1, r2), where each is first by ``order``, and the sums of n and w."""
    r1, r2 = keys
    by = np.lexsort((*order[::-1], r2, r1))
    new = np.concatenate(([True], (r1[by][1:] != r1[by][:-1]) | (r2[by][1:] != r2[by][:-1])))[: len(by)]
    at = np.flatnonzero(new)
    sums = [np.add.reduceat(x[by], at) if len(at) else x[:0] for x in (n, w)]
    return by[at], *sums


def _asks(chunk: int, ranges: np.ndarray, r1: np.ndarray, r2: np.ndarray, doc, tie, place, n, w) -> pa.RecordBatch:
    columns = (ranges, r1, r2, doc, tie, np.full(len(r1), chunk), place, n, w)
    schema = _schema(ASKS)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def _whole_documents(hashes: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The documents of 1 to ``most`` lines: place, hash of all lines, number of lines, document."""
    begins = np.concatenate(([0], ends[:-1]))
    size = ends - begins
    doc = np.flatnonzero((size > 0) & (size <= most))
    place, size, key = begins[doc], size[doc], np.zeros(len(doc), np.uint64)
    for j in range(most):
        inside = size > j
        key[inside] = key[inside] * FACTOR + hashes[place[inside] + j].astype(np.uint64)
    return place, (mix(key) >> np.uint64(1)).astype(np.int64), size, doc


def _first_pairs(row: dict, whole: int) -> tuple[np.ndarray, ...]:
    """All places by their line's hash, and short documents by all lines' hash with their number as second rank."""
    hashes, ends = _numbers(row["hashes"]), _numbers(row["ends"])
    place = np.arange(len(hashes))
    lines = place, hashes, np.zeros(len(place), np.int64), np.searchsorted(ends, place, side="right")
    return tuple(np.concatenate(x) for x in zip(lines, _whole_documents(hashes, ends, whole), strict=True))


def _pairs(row: dict, offset: int) -> tuple[np.ndarray, ...]:
    """Places with both ranks shared, in one document: place, ranks here and ``offset`` lines on, document, size."""
    places, ranks, ends = _numbers(row["places"]), _numbers(row["ranks"]), _numbers(row["ends"])
    dense = np.full(int(ends[-1]) + 1, -1, np.int64)
    dense[places] = ranks
    doc = np.searchsorted(ends, places, side="right")
    other = np.where(places + offset < ends[doc], dense[np.minimum(places + offset, len(dense) - 1)], -1)
    ok = other >= 0
    return places[ok], ranks[ok], other[ok], doc[ok], _numbers(row["sizes"])[ok]


def _place_of(rank: np.ndarray, size: np.ndarray, other: np.ndarray, total: int, parts: int) -> np.ndarray:
    """The range of a pair: an interval's ranks are its own, so its share of them, dealt by the second rank, keeps order."""
    inside = np.minimum(size - 1, (other / max(1, total) * size).astype(np.int64))
    return np.minimum(parts - 1, ((rank + inside) / max(1, total) * parts).astype(np.int64))


def first_asks(table: DataFrame, parts: int, whole: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for row in batch.to_pylist():
                place, r1, r2, doc = _first_pairs(row, whole)
                ids, ties, one = _numbers(row["ids"])[doc], _numbers(row["ties"])[doc], np.ones(len(place), np.int64)
                at, n, w = _gathered([r1, r2], [ids, ties, place], one, one * 0)
                ranges = ((r1[at] >> 32) * parts) >> 31
                yield _asks(row["chunk"], ranges, r1[at], r2[at], ids[at], ties[at], place[at], n, w)

    return table.select("chunk", "ids", "ties", "ends", "hashes").mapInArrow(run, ASKS)


def next_asks(level: DataFrame, parts: int, offset: int, total: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for row in batch.to_pylist():
                place, r1, r2, doc, size = _pairs(row, offset)
                ids, ties, one = _numbers(row["ids"])[doc], _numbers(row["ties"])[doc], np.ones(len(place), np.int64)
                at, n, w = _gathered([r1, r2], [ids, ties, place], one, one * 0)
                ranges = _place_of(r1[at], size[at], r2[at], total, parts)
                yield _asks(row["chunk"], ranges, r1[at], r2[at], ids[at], ties[at], place[at], n, w)

    return level.mapInArrow(run, ASKS)


class _Replies:
    """Replies by chunk, let go in batches of a bounded size."""

    def __init__(self, most: int = 100_000):
        self.most, self.chunks, self.rows, self.n = most, [], [], 0

    def add(self, chunk: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(chunk), self.most):
            self.chunks.append(chunk[i : i + self.most])
            self.rows.append(rows[i : i + self.most])
            self.n += len(self.chunks[-1])
            if self.n >= self.most:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            chunk, rows = np.concatenate(self.chunks), np.concatenate(self.rows)
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[order])) + 1
            names = chunk[order][np.concatenate(([0], cuts))]
            values = [{"chunk": int(c), "data": _bytes(x)} for c, x in zip(names, np.split(rows[order], cuts), strict=True)]
            yield _batch(values, REPLIES)
        self.chunks, self.rows, self.n = [], [], 0


def replies(asked: DataFrame, parts: int) -> DataFrame:
    """For each chunk its pairs that have two members or more, one of them present; a last row sums up each range.

    A pair's rows come one after the other, the first occurrence in front; of the pair at hand its chunks are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, local, shared, out = None, 0, 0, _Replies()
        key, held, here, gone, first = None, [], 0, 0, -1

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal local, shared
            if here and here + gone > 1:
                shared += here
                for i, chunk in enumerate(held):
                    rows = np.tile(np.array([*key, part, local, here + gone, here, -1], np.int64), (len(chunk), 1))
                    if i == 0:
                        rows[0, -1] = first
                    yield from out.add(chunk, rows)
            local += here

        for batch in batches_of(batches):
            ranges = batch.column("range").to_numpy()
            part = int(ranges[0]) if part is None else part
            if (ranges != part).any():
                raise RuntimeError("a task holds one range")
            r1, r2, chunk, place, n, w = (batch.column(x).to_numpy() for x in ("r1", "r2", "chunk", "place", "n", "w"))
            new = np.concatenate(([key != (r1[0], r2[0])], (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])))
            at = np.flatnonzero(new)
            head = int(at[0]) if len(at) else len(r1)
            if head:
                held.append(chunk[:head].copy())  # a view would hold its whole batch
                here, gone = here + int(n[:head].sum()), gone + int(w[:head].sum())
            if not len(at):
                continue
            if key is not None:
                yield from close()
            a, b = head, int(at[-1])
            if a < b:
                start = at[:-1] - a
                size = np.diff(np.concatenate((start, [b - a])))
                members, others = np.add.reduceat(n[a:b], start), np.add.reduceat(w[a:b], start)
                ok = (members > 0) & (members + others > 1)
                number = local + np.cumsum(members) - members
                firsts = np.full(b - a, -1, np.int64)
                firsts[start] = place[a:b][start]
                each = lambda x: np.repeat(x, size)
                keep = each(ok)
                columns = r1[a:b], r2[a:b], np.full(b - a, part), each(number), each(members + others), each(members), firsts
                yield from out.add(chunk[a:b][keep], np.stack(columns, 1)[keep])
                local, shared = local + int(members.sum()), shared + int(members[ok].sum())
            key, held, here, gone, first = (r1[b], r2[b]), [chunk[b:].copy()], int(n[b:].sum()), int(w[b:].sum()), int(place[b])
        if key is not None:
            yield from close()
        yield from out.flush()
        if local:
            yield _batch([{"chunk": -1, "range": part, "count": local, "shared": shared}], REPLIES)

    dealt = asked.repartitionById(parts, F.col("range")).sortWithinPartitions(*ORDER)
    return dealt.mapInArrow(run, REPLIES)


class Exchange:
    """A finished exchange: its stored replies, where each range's numbers begin, and how many suffixes share a pair."""

    def __init__(self, asked: DataFrame, parts: int):
        self.rows = stored(replies(asked, parts), "line-replies")
        self.starts, self.total, self.shared = np.zeros(parts, np.int64), 0, 0
        for part, n, shared in sorted(self.rows.where("chunk = -1").select("range", "count", "shared").collect()):
            self.starts[part], self.total, self.shared = self.total, self.total + n, self.shared + shared


def by_chunk(rows: DataFrame, n: int) -> DataFrame:
    """Rows dealt evenly by their chunk. Partitions are 13 apart, so a multiple of 13 tasks would leave most without any."""
    n += n % 13 == 0
    number = F.shiftright("chunk", 20) * 13 + F.col("chunk").bitwiseAND(F.lit((1 << 20) - 1))
    return rows.repartitionById(n, F.pmod(number, F.lit(n)).cast("int"))


def meet(
    frames: dict[int, DataFrame], run: Callable[[dict[int, list[dict]]], dict | list | pa.RecordBatch | None], schema: str, n: int
) -> DataFrame:
    """``run`` on each chunk's rows by kind, in ``n`` tasks that hold one chunk at a time; it gives a row, rows, or None:
    the chunk has nothing to say any more."""

    known = tuple(frames)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, "chunk"):
            kinds: dict[int, list[dict]] = {k: [] for k in known}
            for r in rows:
                kinds[r["kind"]].append(r)
            value = run(kinds)
            if value is not None:
                yield value if isinstance(value, pa.RecordBatch) else _batch(value if isinstance(value, list) else [value], schema)

    both = None
    for kind, frame in frames.items():
        own = frame.withColumn("kind", F.lit(kind))
        own = own.where("chunk >= 0").drop("range", "count", "shared") if kind == ANSWERS else own
        both = own if both is None else both.unionByName(own, allowMissingColumns=True)
    return by_chunk(both, n).sortWithinPartitions("chunk", "kind").mapInArrow(each, schema)


def _answered(r1: np.ndarray, r2: np.ndarray, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the pairs have an answer, the row of each of these, and all rows."""
    rows = np.concatenate([_numbers(a["data"], FIELDS) for a in answers] or [np.zeros((0, FIELDS), np.int64)])
    a = np.concatenate((r1, rows[:, 0]))
    b = np.concatenate((r2, rows[:, 1]))
    order = np.lexsort((b, a))
    code = np.empty(len(a), np.int64)
    code[order] = np.cumsum(np.concatenate(([True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])))[: len(a)])
    row_of = np.full(len(a) + 1, -1, np.int64)
    row_of[code[len(r1) :]] = np.arange(len(rows))
    which = row_of[code[: len(r1)]]
    return np.flatnonzero(which >= 0), which[which >= 0], rows


def levelled(source: DataFrame, exchange: Exchange, offset: int | None, n: int, whole: int = 0) -> DataFrame:
    """The next level: shared places, their ranks, their intervals' sizes, and which are first of their interval.

    ``offset`` None: the first level, from the lines themselves; ``wholes``: later copies of short documents.
    """
    starts, kind = exchange.starts, BODY if offset is None else LEVEL

    def run(kinds: dict[int, list[dict]]) -> dict | None:
        if not kinds[kind] or not kinds[ANSWERS]:
            return None
        row = kinds[kind][0]
        pairs = _first_pairs(row, whole) if offset is None else _pairs(row, offset)
        place, r1, r2 = pairs[:3]
        at, which, rows = _answered(r1, r2, kinds[ANSWERS])
        lines = r2[at] == 0 if offset is None else np.ones(len(at), bool)
        first = rows[which, 6] == place[at]
        by = np.argsort(place[at[lines]], kind="stable")
        at_lines, own = at[lines][by], which[lines][by]
        return {
            **{x: row[x] for x in ("chunk", "ids", "ties", "ends")},
            "places": _bytes(place[at_lines]),
            "ranks": _bytes(starts[rows[own, 2]] + rows[own, 3]),
            "sizes": _bytes(rows[own, 4]),
            "firsts": _bytes(first[lines][by]),
            "wholes": _bytes(np.stack((place[at], r2[at]), 1)[~lines & ~first]),
        }

    keep = ("chunk", "ids", "ties", "ends", "hashes") if offset is None else ("chunk", "ids", "ties", "ends", "places", "ranks", "sizes")
    return meet({kind: source.select(*keep), ANSWERS: exchange.rows}, run, LEVELS, n)


def _dense(row: dict, n: int) -> np.ndarray:
    out = np.full(n + 1, -1, np.int64)
    out[_numbers(row["places"])] = _numbers(row["ranks"])
    return out


def _next_ranks(row: dict, dense: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """The rank behind each (place, length, ...): -1 where the document ends before or the rank is not shared."""
    x = _numbers(row, width)
    after = x[:, 0] + x[:, 1]
    end = ends[np.searchsorted(ends, x[:, 0], side="right")] if len(x) else after
    return np.where(after < end, dense[np.minimum(after, len(dense) - 1)], -1)


def state_asks(state: DataFrame, level: DataFrame, parts: int) -> DataFrame:
    """(interval, rank behind it) of all suffixes in the state and of the witnesses."""

    def run(kinds: dict[int, list[dict]]) -> pa.RecordBatch | None:
        if not kinds[STATE] or not kinds[LEVEL]:
            return None
        row, ends = kinds[STATE][0], _numbers(kinds[STATE][0]["ends"])
        dense = _dense(kinds[LEVEL][0], int(ends[-1]))
        at, stays = _numbers(row["at"], 4), _numbers(row["stays"], 4)
        both = np.concatenate((at, stays))
        r2 = np.concatenate([_next_ranks(row[x], dense, ends, 4) for x in ("at", "stays")])
        ok = r2 >= 0
        present = np.arange(len(both)) < len(at)
        n, w = present.astype(np.int64)[ok], np.where(present, 0, both[:, 3])[ok]
        r1, r2, place = both[ok, 2], r2[ok], both[ok, 0]
        last = np.where(n > 0, 0, LAST)
        first, n, w = _gathered([r1, r2], [last, place], n, w)
        ranges = mix(mix(r1[first].astype(np.uint64)) + r2[first].astype(np.uint64)) % np.uint64(parts)
        return _asks(row["chunk"], ranges.astype(np.int64), r1[first], r2[first], last[first], last[first], place[first], n, w)

    frames = {STATE: state, LEVEL: level.select("chunk", "places", "ranks")}
    return meet(frames, run, ASKS, parts)


def descend(
    state: DataFrame | None, exchange: Exchange | None, level: DataFrame, deeper: DataFrame | None, k: int, enter: bool, tasks: int
) -> DataFrame:
    """The state after depth 2^k: (place, length, interval, members) of each suffix, and its witnesses
    (place, length, interval, members that the place stands for).

    Suffixes whose pair is shared move on by 2^k lines into the pair's interval; the first of them stays behind as a
    witness for all. With ``enter`` those that share just 2^k lines come in, and the first of every interval of twice as
    many lines is a witness in its interval here.
    """
    starts = exchange.starts if exchange else np.zeros(0, np.int64)

    def run(kinds: dict[int, list[dict]]) -> dict | None:
        source = (kinds.get(STATE) or kinds[LEVEL] or [None])[0]
        if source is None:
            return None
        ends = _numbers(source["ends"])
        n = int(ends[-1])
        row = kinds[LEVEL][0] if kinds[LEVEL] else None
        at, stays = np.zeros((0, 4), np.int64), np.zeros((0, 4), np.int64)
        if kinds.get(STATE):
            old = kinds[STATE][0]
            at, stays = _numbers(old["at"], 4).copy(), _numbers(old["stays"], 4)
            if kinds.get(ANSWERS) and row:
                dense = _dense(row, n)
                r2 = [_next_ranks(old[x], dense, ends, 4) for x in ("at", "stays")]
                hit, which, rows = _answered(at[:, 2], r2[0], kinds[ANSWERS])
                name = lambda i: (starts[rows[i, 2]] + rows[i, 3]) * TAGS + TAGS // 2 + k
                own = rows[which, 6] == at[hit, 0]
                left = np.column_stack((at[hit[own], :3], rows[which[own], 5]))
                moved, of, rows_of = _answered(stays[:, 2], r2[1], kinds[ANSWERS])
                more = np.column_stack((stays[moved, 0], stays[moved, 1] + (1 << k), name(of), stays[moved, 3]))
                at[hit] = np.column_stack((at[hit, 0], at[hit, 1] + (1 << k), name(which), rows[which, 4]))
                stays = np.concatenate((stays, left, more))
        if enter and row:
            places, ranks, sizes = (_numbers(row[x]) for x in ("places", "ranks", "sizes"))
            new = ~np.isin(places, at[:, 0])
            come = np.column_stack((places, np.full(len(places), 1 << k), ranks * TAGS + k, sizes))[new]
            if kinds.get(DEEPER):
                below = kinds[DEEPER][0]
                first = _numbers(below["firsts"]) > 0
                where = _numbers(below["places"])[first]
                left = np.column_stack((where, np.full(len(where), 1 << k), _dense(row, n)[where] * TAGS + k, _numbers(below["sizes"])[first]))
                stays = np.concatenate((stays, left))
            at = np.concatenate((at, come))
        if not len(at):
            return None
        return {"chunk": source["chunk"], "ends": source["ends"], "at": _bytes(at), "stays": _bytes(stays)}

    frames = {LEVEL: level.select("chunk", "ends", "places", "ranks", "sizes")}
    if state is not None:
        frames |= {STATE: state, ANSWERS: exchange.rows}
    if deeper is not None and enter:
        frames[DEEPER] = deeper.select("chunk", "places", "sizes", "firsts")
    return meet(frames, run, STATES, tasks)


def later(level: DataFrame, exchange: Exchange, offset: int, n: int) -> DataFrame:
    """The places of each chunk whose run of a depth between two levels has an earlier copy."""

    def run(kinds: dict[int, list[dict]]) -> dict | None:
        if not kinds[LEVEL] or not kinds[ANSWERS]:
            return None
        row = kinds[LEVEL][0]
        place, r1, r2, _, _ = _pairs(row, offset)
        at, which, rows = _answered(r1, r2, kinds[ANSWERS])
        return {"chunk": row["chunk"], "places": _bytes(place[at][rows[which, 6] != place[at]])}

    frames = {LEVEL: level.select("chunk", "ids", "ties", "ends", "places", "ranks", "sizes"), ANSWERS: exchange.rows}
    return meet(frames, run, "chunk bigint, places binary", n)


def _covered(n: int, places: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, places, 1)
    np.add.at(marks, places + lengths, -1)
    return np.cumsum(marks[:-1]) > 0


RESULT = (
    "doc_id bigint, n_lines bigint, n_removed bigint, removed string, n_repeats bigint, repeats string, n_runs bigint,"
    " longest_run bigint, runs string"
)


def _line_spans(gone: np.ndarray, numbers: np.ndarray) -> str:
    if not gone.any():
        return ""
    cover = np.zeros(int(numbers[-1]) + 1, bool)
    cover[numbers[gone]] = True
    return ",".join(f"{a}:{b}" for a, b in _spans(cover))


def reported(body: DataFrame, judged: DataFrame, state: DataFrame | None, tasks: int, *, min_run: int, long_words: int) -> DataFrame:
    """Per document: its lines, those deleted, those of shorter copies too, and its maximal repeated runs."""

    def run(kinds: dict[int, list[dict]]) -> list[dict] | None:
        row = kinds[BODY][0]
        numbers, words, ends = np.frombuffer(row["numbers"], "<i4"), np.frombuffer(row["words"], "<i4"), _numbers(row["ends"])
        n = len(numbers)
        sums = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
        gone, every = np.zeros(n, bool), np.zeros(n, bool)
        for j in kinds[JUDGED]:
            places, depth = _numbers(j["places"]), j["depth"]
            if j["firsts"] is not None:
                places = places[_numbers(j["firsts"]) == 0]
            if depth == min_run:
                gone |= _covered(n, places, depth)
            else:
                every |= _covered(n, places[sums[places + depth] - sums[places] >= long_words], depth)
            wholes = _numbers(j["wholes"], 2)
            every |= _covered(n, wholes[:, 0], wholes[:, 1])
        every |= gone
        length, members = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        if kinds.get(STATE):
            at = _numbers(kinds[STATE][0]["at"], 4)
            length[at[:, 0]], members[at[:, 0]] = at[:, 1], at[:, 3]
        begins = np.concatenate(([0], ends[:-1]))
        fresh = np.zeros(n + 1, bool)
        fresh[begins] = True
        maximal = (length >= min_run) & (fresh | (np.concatenate(([0], length[:-1])) != length + 1))
        out = []
        for doc_id, a, b in zip(row["doc_ids"], begins.tolist(), ends.tolist(), strict=True):
            runs = a + np.flatnonzero(maximal[a:b])
            texts_of = [f"{numbers[p]}:{numbers[p + length[p] - 1] + 1}:{members[p]}" for p in runs.tolist()]
            value = [doc_id, b - a]
            for own in (gone[a:b], every[a:b]):
                value += [int(own.sum()), _line_spans(own, numbers[a:b])]
            value += [len(runs), int(length[runs].max()) if len(runs) else 0, ",".join(texts_of)]
            out.append(dict(zip(_schema(RESULT).names, value, strict=True)))
        return out

    keep = ("chunk", "doc_ids", "ends", "numbers", "words")
    frames = {BODY: body.select(*keep), JUDGED: judged} | ({STATE: state.select("chunk", "at")} if state is not None else {})
    return meet(frames, run, RESULT, tasks)


def repeated_runs(docs: DataFrame, *, min_run: int = 3, long_words: int = 50, chunk_lines: int = 200_000) -> DataFrame:
    """One row per document: the lines that later copies of runs of ``min_run`` lines or more give up (``removed``), with
    those of shorter runs of ``long_words`` words and of short whole documents too (``repeats``), and the maximal runs of
    ``min_run`` lines or more that occur elsewhere too, as first line:end:copies (``runs``, ``n_runs``, ``longest_run``)."""
    body = stored(chunks(docs, chunk_lines=chunk_lines), "line-chunks")
    whole, most = min_run - 1, _parts(docs)
    lines = (body.agg(F.sum(F.octet_length("numbers"))).first()[0] or 0) // 4
    parts = _tasks(most, lines)
    exchange = Exchange(first_asks(body, parts, whole), parts)
    level = stored(levelled(body, exchange, None, parts, whole), "line-level")
    # Each level holds the suffixes that still share a rank, soon a small part of all: so many tasks meet on it.
    levels, totals, tasks = [level], [exchange.total], [_tasks(most, lines, exchange.shared)]
    while exchange.shared:
        offset = 1 << (len(levels) - 1)
        exchange = Exchange(next_asks(levels[-1], tasks[-1], offset, totals[-1]), tasks[-1])
        if exchange.shared:
            levels.append(stored(levelled(levels[-1], exchange, offset, tasks[-1]), "line-level"))
            totals.append(exchange.total)
            tasks.append(_tasks(most, lines, exchange.shared))
    judged = None
    for depth in range(1, min_run + 1):
        k = depth.bit_length() - 1
        if k >= len(levels):
            break
        if depth == 1 << k:
            rows = levels[k].select("chunk", "places", "firsts", "wholes")
        else:
            offset = depth - (1 << k)
            own = Exchange(next_asks(levels[k], tasks[k], offset, totals[k]), tasks[k])
            rows = later(levels[k], own, offset, tasks[k]).select("chunk", "places", F.lit(None).cast("binary").alias("firsts"), F.lit(None).cast("binary").alias("wholes"))
        rows = rows.withColumn("depth", F.lit(depth).cast("long"))
        judged = rows if judged is None else judged.unionByName(rows)
    state = None
    for k in reversed(range(len(levels))):
        enter = (2 << k) - 1 >= min_run  # others cannot reach min_run lines
        if state is None and not enter:
            break
        deeper = levels[k + 1] if k + 1 < len(levels) else None
        own = Exchange(state_asks(state, levels[k], tasks[k]), tasks[k]) if state is not None else None
        state = stored(descend(state, own, levels[k], deeper, k, enter, tasks[k]), "line-intervals")
    return reported(body, judged, state, parts, min_run=min_run, long_words=long_words)


def without(text: str | None, removed: str) -> str:
    """A text without the lines of its spans."""
    lines = (text or "").split("\n")
    for span in reversed(removed.split(",") if removed else []):
        a, b = map(int, span.split(":"))
        del lines[a:b]
    return "\n".join(lines)
