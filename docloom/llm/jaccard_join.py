"""Similarity join on word shingles: Jaccard 0.8 or more on sets of five-word shingles.

Texts with equal shingle sets are one node with a number of copies, so copies never meet in pairs. Nodes that agree in
one of ``BANDS`` bands of ``ROWS`` MinHash values each are candidates (a pair at the threshold is missed with
probability (1 - 0.8^5)^40, about 1e-7); they are linked through the smallest node of their bucket, and the connected
groups are compared inside, a large group in blocks of a bounded size, block against block. In a group of more than
``MOST_BLOCKS`` blocks, which chains what is far from alike, only nodes that share a bucket are compared, each pair in
the first bucket that it shares. A comparison takes the
MinHash values step by step and drops a pair once the posterior probability (uniform prior) that its Jaccard reaches
the threshold falls below ``TOLERANCE``; the rest is verified exactly on the 64-bit shingle hashes. No pair is ever a
row: a node's links are counted, and a spanning tree of its class is kept.

Words are lower-case runs of letters and digits. A text of fewer than five words is one shingle; a text without words
(null, empty) has none and links to nothing. A null doc_id links to nothing and has a null class. Rows that share an id
each give a row, with the class of their own text; equal rows are copies. A class takes its smallest doc_id, so there are
no ties. Very long texts are one set, however large; a block holds such a set alone. Only doc_id (an integer) and text are
read, so other columns may have any name. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Vocab, batches_of, gram_hashes, id_and_text, looked_up, mix, sorted_unique, stored, texts
from docloom.llm.decontamination import words_of
from docloom.llm.graph import components

WIDTH, BANDS, ROWS = 5, 40, 5
STEP, TOLERANCE = 40, 1e-9
FACTORS = mix(np.arange(1, 1 + BANDS * ROWS)) | np.uint64(1)
SHIFTS = mix(np.arange(10_001, 10_001 + BANDS * ROWS))
BLOCK_NODES, BLOCK_SHINGLES = 512, 2_000_000
MOST_BLOCKS = BANDS  # a component of more blocks is compared by its buckets where that sends fewer texts


def word_hashes(words: list[list[bytes]]) -> np.ndarray:
    """64-bit hashes of all words, one after the other; equal words are hashed once."""
    vocab = Vocab()
    ids = np.array([vocab[w] for own in words for w in own], dtype=np.int64)
    return hash_words(list(vocab))[ids] if len(ids) else np.zeros(0, np.uint64)


def hash_words(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def shingles(words: list[list[bytes]], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, at, out = word_hashes(words), 0, []
    for own in words:
        mine = hashes[at : at + len(own)]
        at += len(own)
        out.append(sorted_unique(gram_hashes(mine, min(width, len(own)))) if own else mine)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values: a row for each set, none of them empty."""
    out = np.empty((len(sets), len(FACTORS)), np.uint32)
    i = 0
    while i < len(sets):  # pieces that fit the cache
        j, n = i, 0
        while j < len(sets) and (j == i or n + len(sets[j]) <= 30_000):
            n += len(sets[j])
            j += 1
        cat = np.concatenate(sets[i:j])
        starts = np.cumsum([0] + [len(x) for x in sets[i : j - 1]])
        for k in range(len(FACTORS)):
            values = ((cat * FACTORS[k] + SHIFTS[k]) >> np.uint64(32)).astype(np.uint32)
            out[i:j, k] = np.minimum.reduceat(values, starts)
        i = j
    return out


def node_of(shingle_set: np.ndarray) -> bytes:
    """A 128-bit name of a shingle set."""
    import xxhash

    return xxhash.xxh3_128_digest(shingle_set.tobytes())


SKETCH = "doc_id bigint, node binary, n_shingles bigint, bands array<bigint>"
SKETCH_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("node", pa.binary()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64()))]
)


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: its node (null without words), the size of its set, and its bands' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            for small in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                sets = shingles([words_of(x) for x in texts(small)], width)
                full = [x for x in sets if len(x)]
                table = signatures(full).reshape(len(full), BANDS, ROWS).astype(np.uint64)
                key = np.zeros(table.shape[:2], np.uint64)
                for r in range(ROWS):
                    key = mix(key ^ table[:, :, r])
                bands = iter(mix(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64).tolist())
                columns = [
                    small.column("doc_id"),
                    [node_of(x) if len(x) else None for x in sets],
                    [len(x) for x in sets],
                    [next(bands) if len(x) else None for x in sets],
                ]
                yield pa.RecordBatch.from_pydict(dict(zip(SKETCH_ARROW.names, columns, strict=True)), SKETCH_ARROW)

    return id_and_text(docs).mapInArrow(run, SKETCH)


def least_agreement(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """After each step of STEP values, the fewest agreements at which the posterior still reaches ``tolerance``.

    With a uniform prior and m agreements of n, P(J >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


class Forest:
    """Disjoint sets whose root is the smallest."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def compare(
    sets: list[np.ndarray], copies: np.ndarray, sides: np.ndarray, threshold: float, band: int = -1
) -> tuple[np.ndarray, list]:
    """Links of each node (copies counted) and its root among the sets, which are sorted by node.

    ``sides``: 0 or 1; if both occur, only pairs of both sides are compared. ``band``: only pairs whose first common band
    it is; the others meet in the bucket of that band.
    """
    n, fewest, share = len(sets), least_agreement(threshold), Fraction(str(threshold))
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    known = sorted_unique(np.concatenate(sets))
    ids = np.searchsorted(known, np.concatenate(sets))
    flags = np.zeros(len(known), np.int32)
    table, links, forest = signatures(sets), np.zeros(n, np.int64), Forest(n)
    both = sides.any() and not sides.all()
    for i in range(n):
        others = np.arange(i + 1, n)
        if both:
            others = others[sides[i + 1 :] != sides[i]]
        a, b = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[a * share.denominator >= b * share.numerator]
        if band >= 0:
            same = (table[others].reshape(-1, BANDS, ROWS) == table[i].reshape(BANDS, ROWS)).all(axis=2)
            others = others[same[:, band] & ~same[:, :band].any(axis=1)]
        agree = np.zeros(len(others), np.int64)
        for k, least in enumerate(fewest):
            part = slice(k * STEP, (k + 1) * STEP)
            agree = agree + (table[others, part] == table[i, part]).sum(axis=1)
            others, agree = others[agree >= least], agree[agree >= least]
            if not len(others):
                break
        if not len(others):
            continue
        flags[ids[starts[i] : starts[i + 1]]] = 1
        cat = np.concatenate([ids[starts[j] : starts[j + 1]] for j in others.tolist()])
        common = np.add.reduceat(flags[cat], np.concatenate(([0], np.cumsum(sizes[others])[:-1]))).astype(np.int64)
        flags[ids[starts[i] : starts[i + 1]]] = 0
        union = sizes[i] + sizes[others] - common
        linked = others[common * share.denominator >= union * share.numerator]
        links[i] += copies[linked].sum()
        links[linked] += copies[i]
        for j in linked.tolist():
            forest.join(i, j)
    return links, [forest.root(i) for i in range(n)]


VERIFIED = "node binary, root binary, links bigint, whole boolean"
VERIFIED_ARROW = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("links", pa.int64()), ("whole", pa.bool_())])


def verify(members: DataFrame, threshold: float, width: int = WIDTH) -> DataFrame:
    """``members(component, i, j, side, band, node, copies, text)``: comparisons inside each (component, i, j).

    A row may bring a text of another node (ids that occur twice); it is recognised and dropped.
    """

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
        key, rows = None, []
        for batch in batches_of(batches):
            columns = [batch.column(x).to_pylist() for x in ("component", "i", "j", "band", "side", "node", "copies")]
            for component, i, j, band, side, node, copies, text in zip(*columns, texts(batch), strict=True):
                if (component, i, j, band) != key:
                    if rows:
                        yield key, rows
                    key, rows = (component, i, j, band), []
                rows.append((node, side, copies, text))
        if rows:
            yield key, rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {x: [] for x in VERIFIED_ARROW.names}
        for (_, i, _, band), rows in groups(batches):
            own = {}
            for (node, side, copies, _), s in zip(rows, shingles([words_of(r[3]) for r in rows], width), strict=True):
                if node_of(s) == node:
                    own[node] = (s, side, copies)
            names = sorted(own)
            if not names:
                continue
            sets, sides, copies = zip(*(own[x] for x in names), strict=True)
            links, roots = compare(list(sets), np.array(copies), np.array(sides), threshold, band)
            out["node"] += names
            out["root"] += [names[r] for r in roots]
            out["links"] += links.tolist()
            out["whole"] += [i < 0] * len(names)
            if len(out["node"]) >= 5000:
                yield pa.RecordBatch.from_pydict(out, VERIFIED_ARROW)
                out = {x: [] for x in VERIFIED_ARROW.names}
        yield pa.RecordBatch.from_pydict(out, VERIFIED_ARROW)

    return members.mapInArrow(run, VERIFIED)


def blocks_of(nodes: DataFrame, blocks: Column) -> DataFrame:
    """``nodes(node, component, ...)``, once for each block pair (component, i, j) in which it stands.

    i = -1: the component is one block.
    """
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    pairs = F.when(F.col("_blocks") > 1, F.sequence(F.lit(0), F.col("_blocks") - 1)).otherwise(F.array(F.lit(-1)))
    each = nodes.withColumn("_blocks", blocks).withColumn("_own", own).withColumn("_k", F.explode(pairs))
    one = F.col("_k") < 0
    return each.select(
        *nodes.columns,
        F.when(one, -1).otherwise(F.least("_own", "_k")).alias("i"),
        F.when(one, -1).otherwise(F.greatest("_own", "_k")).alias("j"),
        F.when(one, 0).otherwise((F.col("_own") > F.col("_k")).cast("int")).alias("side"),
    )


def _blocks() -> Column:
    return F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int").alias("blocks")


def dealt_out(members: DataFrame, keys: DataFrame, most_blocks: int) -> DataFrame:
    """``members(node, component, n_shingles, rep, copies)`` in the groups in which they are compared.

    A component of up to ``most_blocks`` blocks is compared whole, block against block. A larger one may be a chain of many
    buckets whose ends have little in common: there only nodes that share a bucket (``keys(node, band, key)``) are
    compared, in the bucket of their first common band, blocks again where a bucket is large, if fewer texts travel that
    way. No pair is lost either way: all candidates share a bucket. ``most_blocks`` 0: all go by buckets.
    """
    columns = ["component", "i", "j", "side", "band", "node", "rep", "copies"]
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("all"))
    sizes = stored(sizes.select("component", "n", _blocks()), "component-sizes")
    large = sizes.where(F.col("blocks") > most_blocks)
    if not large.head(1):
        sized = looked_up(members, sizes, "component", "n")
        return blocks_of(sized, F.col("blocks")).withColumn("band", F.lit(-1)).select(*columns)
    inside = members.join(large.select("component"), "component", "left_semi")
    bucket = F.concat_ws(":", "band", "key").cast("binary").alias("bucket")
    rows = stored(inside.join(keys, "node").select("node", "component", "n_shingles", "rep", "copies", "band", bucket), "bucket-members")
    own = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("all"), F.first("component").alias("of")).where("n > 1")
    own = stored(own.select("bucket", "n", "of", _blocks()), "bucket-sizes")
    cost = own.groupBy(F.col("of").alias("component")).agg(F.sum(F.col("n") * F.col("blocks")).alias("cost"))
    split = large.join(cost, "component", "left").where((F.lit(most_blocks) == 0) | (F.col("cost") < F.col("n") * F.col("blocks")))
    split = stored(split.select("component", F.lit(True).alias("split")), "split-components")
    marked = stored(sizes.join(split, "component", "left").select("component", "n", "blocks", F.coalesce("split", F.lit(False)).alias("split")), "component-sizes")
    sized = looked_up(members, marked, "component", "n")
    whole = blocks_of(sized.where("not split"), F.col("blocks")).withColumn("band", F.lit(-1))
    chosen = own.join(split.select(F.col("component").alias("of")), "of", "left_semi").select("bucket", "n", "blocks")
    found = looked_up(rows.drop("component"), stored(chosen, "bucket-sizes"), "bucket", "n").where("blocks is not null")
    placed = blocks_of(found.withColumnRenamed("bucket", "component"), F.col("blocks"))
    placed = placed.withColumn("i", F.greatest("i", F.lit(0))).withColumn("j", F.greatest("j", F.lit(0)))
    return whole.select(*columns).unionByName(placed.select(*columns))


def classes(
    docs: DataFrame, *, threshold: float = 0.8, width: int = WIDTH, most_blocks: int = MOST_BLOCKS
) -> DataFrame:
    """Per document: doc_id, class_id (smallest doc_id of its class), n_links (documents at the threshold or above,
    copies included) and n_shingles."""
    rows = stored(sketches(docs, width), "sketches")
    known = rows.where("node is not null and doc_id is not null")
    nodes = known.groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles")
    )
    nodes = stored(nodes, "nodes")
    keys = known.groupBy("node").agg(F.first("bands").alias("bands")).select("node", F.posexplode("bands").alias("band", "key"))
    leaders = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    met = looked_up(keys.select("node", "key"), stored(leaders, "buckets"), "key", "n").where("node <> leader")
    edges = met.select(F.col("node").alias("a"), F.col("leader").alias("b"))
    candidates = components(edges)
    members = candidates.join(nodes, "node").select("node", "component", "n_shingles", "rep", "copies")
    body = id_and_text(docs).where("doc_id is not null").withColumnRenamed("doc_id", "rep")
    placed = dealt_out(stored(members, "members"), keys, most_blocks)
    n = _parts(docs)
    dealt = placed.join(body, "rep").select("component", "i", "j", "side", "band", "node", "copies", "text")
    dealt = dealt.repartition(n, "component", "i", "j").sortWithinPartitions("component", "i", "j", "band")
    found = stored(verify(dealt, threshold, width), "verified")
    alone = found.where("whole").select("node", F.col("root").alias("class"))
    split = found.where("not whole").select(F.col("node").alias("a"), F.col("root").alias("b"))
    joined = components(split).select("node", F.col("component").alias("class"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(alone.unionByName(joined), "node", "left").join(links, "node", "left")
    named = named.select(
        "node",
        "rep",
        F.coalesce("class", "node").alias("class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    smallest = named.groupBy("class").agg(F.min("rep").alias("class_id"))
    result = named.join(smallest, "class").select("node", "class_id", "n_links")
    linked = known.select("doc_id", "node", "n_shingles").join(result, "node")
    linked = linked.select("doc_id", "class_id", "n_links", "n_shingles")
    rest = rows.where("node is null or doc_id is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "n_shingles"
    )
    return linked.unionByName(rest)


def _parts(docs: DataFrame) -> int:
    """Partitions for the comparisons: as many as shuffles have, for smaller tasks than their default size."""
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
