"""Secret scans with an incremental blob ledger. Built-in functions only.

Every historical version of a path is content-addressed: its blob is the SHA-256 of its text. The ledger remembers
which rules (name and version) have seen which blob, and what they found. A run scans a blob once, however many paths
and versions share it, and only by rules that have not seen it in their present version; findings then go back to all
paths that hold the blob, and to every version of a path where ``report`` is told the version's column.

``scans``: blob, rules array<string> ("name@version"). ``findings``: blob, rule ("name@version"), start, end (code
points, end exclusive). A null text is an empty one; a blob without findings is in ``scans`` alone; repeated rows and
null paths are rows like others, and there are no ties: spans that start together are ordered by their rule. Texts are
scanned whole, however long. Only the path, version and text columns are read, so others may have any name; doc_id is an
integer. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.llm.common import integer_id, looked_up, shared_dir, stored


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns. A class that is repeated without limit takes its whole run, so a least length may stand in the
# pattern itself where no other match could begin inside a run that is too short.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
FEW_BLOBS = 100_000  # 64 bytes each: pending hashes that are broadcast
SCANS = "blob string, rules array<string>"
FINDINGS = "blob string, rule string, start bigint, end bigint"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


@dataclass
class Ledger:
    """The tables of a ledger. All of its state is in ``folder``: a ledger on a folder that another run has filled goes on
    where that run ended."""

    spark: SparkSession
    folder: str

    @classmethod
    def new(cls, spark: SparkSession) -> Ledger:
        return cls(spark, shared_dir(spark, "ledger"))

    @property
    def started(self) -> bool:
        """Has a run ended here? Scans are written last, and Spark marks a finished write."""
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/scans/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def scans(self) -> DataFrame:
        return self._read("scans", SCANS)

    def findings(self) -> DataFrame:
        return self._read("findings", FINDINGS)

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self.started:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans what is new in ``versions(text)`` and appends it.

        Findings are written before scans: a run that is cut between the two scans those blobs anew, and ``findings``
        then holds some rows twice, which readers drop.
        """
        todo = stored(self.pending(versions, rules), "ledger-pending")
        positions(self.unseen(versions, todo), rules).write.mode("append").parquet(f"{self.folder}/findings")
        todo.select("blob", F.col("pending").alias("rules")).write.mode("append").parquet(f"{self.folder}/scans")

    def pending(self, versions: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """Blobs with rules that have not seen them: blob, pending array<string>. Hashes travel, texts do not."""
        blobs = versions.select(blob_of(F.col("text")).alias("blob")).distinct()
        names = F.array(*[F.lit(r.name) for r in rules])
        if not self.started:
            return blobs.withColumn("pending", names)
        seen = self.scans().select("blob", F.explode("rules").alias("rule")).groupBy("blob")
        seen = seen.agg(F.collect_set("rule").alias("seen"))  # as many as there are rules
        left = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.join(seen, "blob", "left").withColumn("pending", left).drop("seen").where(F.size("pending") > 0)

    def unseen(self, versions: DataFrame, todo: DataFrame) -> DataFrame:
        """The texts of the pending blobs: blob, text, pending.

        The first run takes all texts. Later ones drop those that are not pending where they are read: by a broadcast of
        the pending hashes where Spark finds them small, else by a Bloom filter of them before the join. Copies meet
        before the shuffle as far as one task holds them, so a blob of very many paths stays small.
        """
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        rows = versions.select(blob_of(F.col("text")).alias("blob"), text.alias("text"))
        if self.started:
            bits = todo.agg(F.count("*")).first()[0]
            rows = rows.join(F.broadcast(todo.select("blob")), "blob", "left_semi") if bits <= FEW_BLOBS else rows.join(todo.select("blob"), "blob", "left_semi")
        return rows.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")


def positions(unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of the pending rules: where a match starts follows from the lengths of what stands before it."""

    def lengths(texts: Column) -> Column:
        return F.transform(texts, lambda x: F.length(x).cast("bigint"))

    def scan(rule: Rule) -> Column:
        text, pattern = F.col("text"), F.lit(rule.pattern)
        matches = lengths(F.regexp_extract_all(text, pattern, F.lit(0)))
        tested = lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else matches
        parts = F.arrays_zip(
            lengths(F.slice(F.split(text, rule.pattern, -1), 1, 1 << 30)).alias("gap"),
            matches.alias("size"),
            tested.alias("tested"),
        )
        wanted = F.array_contains("pending", rule.name) & text.rlike(rule.pattern)
        return F.when(wanted, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.least).alias("least"), parts.alias("parts")))

    scans = unseen.select("blob", F.array_compact(F.array(*[scan(r) for r in rules])).alias("scans"))
    one = scans.where(F.size("scans") > 0).select("blob", F.inline("scans"))
    each = one.select("blob", "rule", "least", F.posexplode("parts").alias("n", "part"))
    order = W.partitionBy("blob", "rule").orderBy("n")
    end = F.sum(F.col("part.gap") + F.coalesce("part.size", F.lit(0))).over(order)
    placed = each.withColumn("end", end).where(F.col("part.tested") >= F.col("least"))
    return placed.select("blob", "rule", (F.col("end") - F.col("part.size")).alias("start"), "end")


def kind_of(rule: Column) -> Column:
    return F.substring_index(rule, "@", 1)


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """"kind:start:end" of those kinds, comma-joined; ``spans`` are sorted structs (start, rank, end, kind)."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(
    versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", version: str | None = None
) -> DataFrame:
    """All versions' paths with the findings of their blobs: path, version (if a column is named), blob, spans (sorted
    structs). A blob of very many paths is found where its rows are (``looked_up``)."""
    ranks = F.create_map(*[F.lit(x) for r in enumerate(rules) for x in (r[1].name, r[0])])
    found = ledger.findings().where(F.col("rule").isin(*[r.name for r in rules])).distinct()
    span = F.struct("start", ranks[F.col("rule")].alias("rank"), "end", kind_of(F.col("rule")).alias("kind"))
    found = found.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    names = [F.col(path).alias("path"), *([F.col(version).alias("version")] if version else [])]
    rows = versions.select(*names, blob_of(F.col("text")).alias("blob"))
    paths = rows.groupBy("blob").agg(F.count("*").alias("n"))
    found = stored(found.join(paths, "blob"), "ledger-report")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    out = looked_up(rows, found, "blob", "n")
    return out.select(*rows.columns, F.coalesce("spans", none).alias("spans"))


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The digest columns of every document, by a new ledger."""
    versions = docs.select(integer_id(docs), F.col("text").cast("string").alias("text"))
    ledger = Ledger.new(docs.sparkSession)
    ledger.update(versions, rules)
    rows = report(versions, ledger, rules)
    base = tuple(r.kind for r in BASE_RULES)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        F.col("path").alias("doc_id"),
        *[count(k) for k in base],
        F.sha2(digest(F.col("spans"), base), 256).alias("base_sha256"),
        digest(F.col("spans"), tuple(r.kind for r in rules)).alias("spans"),
    )
