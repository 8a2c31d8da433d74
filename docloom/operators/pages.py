"""Pages to text: each distinct page goes to the expensive step once, caches are tables, retries are bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.operators import quality

CACHE = "key string, text string, checksum string"


def cached(jobs: DataFrame, cache: DataFrame) -> DataFrame:
    """``jobs(key)`` with text from a cache row whose checksum still fits and whose text is healthy; null elsewhere."""
    good = cache.where(F.sha2("text", 256) == F.col("checksum"))
    good = good.where(quality.status(quality.metrics(F.col("text"))) != "FAIL")
    return jobs.join(good.groupBy("key").agg(F.max("text").alias("text")), "key", "left")


def file_hits(files: DataFrame, file_pages: DataFrame, cache: DataFrame) -> DataFrame:
    """``files(file, sha256)`` by ``file_pages(sha256, page, key)``: cached pages without opening the file."""
    known = files.join(file_pages, "sha256").select("file", "page", "key")
    return known.join(cached(known.select("key").distinct(), cache), "key")


def storable(results: DataFrame) -> DataFrame:
    """Cache rows of ``results(key, text)``: failed texts stay out."""
    ok = results.where(quality.status(quality.metrics(F.col("text"))) != "FAIL")
    return ok.select("key", "text", F.sha2("text", 256).alias("checksum"))


def update_cache(cache: DataFrame, results: DataFrame) -> DataFrame:
    """The rows to append: healthy results whose key the cache lacks."""
    return storable(results).join(cache.select("key"), "key", "left_anti").dropDuplicates(["key"])


def recognised(pages: DataFrame, ocr: Callable[[pd.Series], pd.Series], *, key: str = "key", content: str = "content", tries: int = 2) -> DataFrame:
    """(key, text, status, requests) of each distinct key: ``ocr`` runs once a key, again while it fails, ``tries`` times
    at most."""
    distinct = pages.select(key, content).dropDuplicates([key])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts, done, requests = pd.Series([None] * len(pdf), dtype=object), [False] * len(pdf), [0] * len(pdf)
            for _ in range(tries):
                todo = [i for i, x in enumerate(done) if not x]
                if not todo:
                    break
                for i, text in zip(todo, ocr(pdf[content].iloc[todo]), strict=True):
                    requests[i] += 1
                    texts[i], done[i] = text, bool(text and str(text).strip())
            yield pd.DataFrame({"key": pdf[key], "text": texts, "requests": requests})

    return judged(distinct.mapInPandas(run, "key string, text string, requests int"))


def judged(made: DataFrame) -> DataFrame:
    """``made(text)`` with a status: a healthy text that a machine read is a warning, never a pass."""
    status = quality.status(quality.metrics(F.coalesce("text", F.lit(""))))
    return made.withColumn("status", F.when(status == "PASS", "WARNING").otherwise(status))


def pixel_key(version: str, mode: Column, width: Column, height: Column, pixels: Column) -> Column:
    """The key of a rendered page: a hash of its mode, size and pixels, not of a compressed file."""
    head = F.format_string(f"{version}:%s:(%d, %d)", mode, width, height)
    return F.sha2(F.concat(F.encode(head, "utf-8"), pixels), 256)


ENGINE = "doc string, page bigint, key string, text string, method string, requests int, bytes bigint, fallback boolean, error string"


def recognised_in_batches(
    jobs: DataFrame,
    ocr: Callable[[list[bytes]], list[str]],
    ocr_batch: Callable[[list[bytes], str], str],
    usable: Callable[[str], bool] = bool,
    *,
    most: int = 5,
    max_bytes: int = 9 * (2 << 20) // 10,
    bundle_bytes: int = 2 << 20,
    retries: int = 2,
) -> DataFrame:
    """``jobs(doc, page, key, content)``, each distinct page once, through the batch service: a row a page (``ENGINE``).

    Pages of a document go in batches (``batched``). ``ocr_batch(contents, token)`` answers a batch in one text with
    numbered marks; a batch above ``bundle_bytes`` is halved until it fits. A text counts only if every mark is there once,
    in order, with nothing outside, and the page's part is ``usable``; any other page goes to ``ocr`` alone, which is asked
    once more if it fails, ``retries`` times a document at most. ``text`` is null only with an ``error``: a blank page that
    ``usable`` accepts has an empty one. ``requests`` and ``bytes`` of a batch fall to its first page.
    """
    from docloom.functions.messages import split_response

    sized = jobs.withColumn("_size", F.octet_length("content").cast("long"))
    dealt = batched(sized.select("doc", "page", "_size"), "doc", "page", "_size", most=most, max_bytes=max_bytes)
    rows = jobs.join(dealt.select("doc", "page", "batch"), ["doc", "page"])

    def document(pdf: pd.DataFrame) -> pd.DataFrame:
        budget, out = retries, []

        def alone(job, fallback: bool, requests: int, sent: int) -> None:
            nonlocal budget
            error, text = None, ""
            for attempt in range(2):
                if attempt:
                    if not budget:
                        break
                    budget -= 1
                requests, sent = requests + 1, sent + len(job.content)
                try:
                    text = ocr([bytes(job.content)])[0] or ""
                    if usable(text):
                        error = None
                        break
                    error = "the text is not usable"
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
            out.append((job.doc, job.page, job.key, None if error else text, "single", requests, sent, fallback, error))

        def group(items: list) -> None:
            size = sum(len(x.content) for x in items)
            if len(items) > 1 and size > bundle_bytes:
                group(items[: len(items) // 2])
                group(items[len(items) // 2 :])
                return
            if len(items) == 1:
                alone(items[0], False, 0, 0)
                return
            token = f"{items[0].key[:12]}".upper()
            try:
                parts = split_response(ocr_batch([bytes(x.content) for x in items], token), token, len(items))
            except Exception:
                parts = None
            for i, job in enumerate(items):
                requests, sent = (1, size) if i == 0 else (0, 0)
                if parts is not None and usable(parts[i]):
                    out.append((job.doc, job.page, job.key, parts[i], "batch", requests, sent, False, None))
                else:
                    alone(job, True, requests, sent)

        ordered = sorted(pdf.itertuples(index=False), key=lambda x: (x.batch, x.page))
        for number in sorted({x.batch for x in ordered}):
            group([x for x in ordered if x.batch == number])
        return pd.DataFrame(out, columns=[x.split()[0] for x in ENGINE.split(", ")])

    return rows.groupBy("doc").applyInPandas(document, ENGINE)


def engine_totals(results: DataFrame) -> DataFrame:
    """One row: pages, requests, bytes, batch and single pages, fallbacks, failures."""
    n = lambda c: F.count(F.when(c, 1))
    return results.agg(
        F.count("*").alias("pages"), F.sum("requests").alias("requests"), F.sum("bytes").alias("bytes"), n(F.col("method") == "batch").alias("batch_pages"),
        n(F.col("method") == "single").alias("single_pages"), n(F.col("fallback")).alias("fallbacks"), n(F.col("error").isNotNull()).alias("failures"),
    )


def file_counters(files: DataFrame) -> DataFrame:
    """``files(name, outcome)`` of a batch run: one row with a count for each outcome and the run's exit code."""
    names = ("converted", "existing", "digital", "noise", "error")
    counts = [F.count(F.when(F.col("outcome") == n, 1)).alias(n) for n in names]
    row = files.agg(F.count("*").alias("eligible"), *counts)
    code = F.when(F.col("error") == 0, 0).when(F.col("error") < F.col("eligible"), 2).otherwise(1)
    return row.withColumn("exit_code", code)


def document_summary(pages: DataFrame) -> DataFrame:
    """``pages(file, number, method, status, characters)``: a row a document, its pages by method and status."""
    n = lambda c: F.count(F.when(c, 1))
    return pages.groupBy("file").agg(
        F.count("*").alias("pages"), n(F.col("method") == "local").alias("local"), n(F.col("method") == "ocr").alias("ocr"), n(F.col("method") == "cache").alias("cache"),
        *[n(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARNING", "FAIL")], F.sum("characters").alias("characters"),
    )


def checked_markers(docs: DataFrame) -> DataFrame:
    """``docs(doc, raw, pages array<struct<scan:boolean,chars:bigint,anchors:array<string>>>)`` with the texts between page
    marks, judged page by page: (doc, number, text, bounded, complete, ordered, status, reasons).

    A page's text stands between its begin and end mark, each there once. Missing anchors lower the status; a scanned page
    is a warning at best; so is a text of less than 40 % of a source text of more than 300 characters. Marks that are not
    in order fail all pages.
    """
    mark = F.regexp_extract_all("raw", F.lit(fixed.PAGE_MARK), F.lit(0))
    parsed = F.transform(mark, lambda m: F.concat(F.regexp_extract(m, fixed.PAGE_MARK, 1).cast("int").cast("string"), F.upper(F.regexp_extract(m, fixed.PAGE_MARK, 2))))
    numbers = F.when(F.size("pages") > 0, F.sequence(F.lit(1), F.size("pages"))).otherwise(F.array().cast("array<int>"))
    expected = F.flatten(F.transform(numbers, lambda n: F.array(F.concat(n.cast("string"), F.lit("BEGIN")), F.concat(n.cast("string"), F.lit("END")))))
    rows = docs.withColumns({"_seen": parsed, "_expected": expected, "_parts": F.split("raw", fixed.PAGE_MARK)})
    ordered = F.filter("_expected", lambda e: F.array_contains("_seen", e)) == F.col("_seen")
    each = rows.select("doc", (F.col("_seen") == F.col("_expected")).alias("complete"), ordered.alias("ordered"), "_seen", "_parts", F.posexplode("pages").alias("_i", "page"))
    each = each.withColumn("number", F.col("_i") + 1)
    begin, end = (F.concat(F.col("number").cast("string"), F.lit(k)) for k in ("BEGIN", "END"))
    at = lambda m: F.array_position("_seen", m)
    once = lambda m: F.size(F.filter("_seen", lambda x: x == m)) == 1
    bounded = once(begin) & once(end) & (at(begin) < at(end))
    between = F.slice("_parts", (at(begin) + 1).cast("int"), F.greatest(at(end) - at(begin), F.lit(0)).cast("int"))
    each = each.withColumn("bounded", bounded).withColumn("text", F.when(F.col("bounded"), quality.X.strip(F.array_join(between, ""))).otherwise(""))
    each = each.withColumn("_m", quality.metrics(F.col("text")))
    lost = F.filter(F.col("page.anchors"), lambda a: ~F.contains(quality.X.compact(F.col("text")), quality.X.compact(a)))
    base = quality.with_anchors(quality.status(F.col("_m")), lost, F.size("page.anchors"))
    scan = F.coalesce("page.scan", F.lit(False)) & F.col("bounded")
    shrunk = F.col("bounded") & (F.col("page.chars") > 300) & (10 * F.length("text") < 4 * F.col("page.chars"))
    status = F.when(~F.col("ordered"), "FAIL").when((scan | shrunk) & (base != "FAIL"), "WARNING").otherwise(base)
    reasons = F.array_compact(
        F.concat(
            F.when(F.col("bounded"), quality.reasons(F.col("_m"))).otherwise(F.array(F.lit("no_boundaries"))),
            F.array(F.when(F.col("bounded") & (F.size(lost) > 0), F.lit("anchors_missing")), F.when(scan, F.lit("scanned")), F.when(shrunk, F.lit("shrunk")), F.when(~F.col("ordered"), F.lit("order"))),
        )
    )
    return each.select("doc", "number", "text", "bounded", "complete", "ordered", F.when(F.col("bounded"), status).otherwise("FAIL").alias("status"), reasons.alias("reasons"))


def fan_out(results: DataFrame, destinations: DataFrame, key: str = "key") -> DataFrame:
    """Each result at all places that asked for it."""
    return destinations.join(results, key, "left")


def cost(destinations: DataFrame, results: DataFrame) -> DataFrame:
    """Requests of each file: a shared page's cost falls to the first file that asks."""
    owner = destinations.groupBy("key").agg(F.min(F.struct("file", "page")).alias("o"))
    own = owner.join(results, "key").select(F.col("o.file").alias("file"), "requests")
    return own.groupBy("file").agg(F.sum("requests").alias("requests"))


def run_totals(jobs: DataFrame) -> DataFrame:
    """``jobs(key, hit)``, a row per place: places, distinct keys, duplicates, cache hits, requests."""
    keys = jobs.groupBy("key").agg(F.count("*").alias("n"), F.max("hit").alias("hit"))
    return keys.agg(
        F.sum("n").alias("places"),
        F.count("*").alias("keys"),
        (F.sum("n") - F.count("*")).alias("duplicates"),
        F.count(F.when(F.col("hit"), 1)).alias("cache_hits"),
        F.count(F.when(~F.col("hit"), 1)).alias("requests"),
    )


def retried(failed: DataFrame, doc: str, page: str, budget: int = 2) -> DataFrame:
    """The failed pages of each document that its retry budget covers, the first ones."""
    n = F.row_number().over(W.partitionBy(doc).orderBy(page))
    return failed.withColumn("attempt", n).where(F.col("attempt") <= budget)


def assembled(pages: DataFrame) -> DataFrame:
    """``pages(file, number, text, status, method)``: a document's Markdown, its pages in order.

    A failed page leaves a notice; a text from OCR has the warning before it.
    """
    notice = F.lit("> متن این صفحه تأیید نشده است")
    text = F.when(F.col("status") == "FAIL", notice).when(
        F.col("method") == "ocr", F.concat(F.lit(fixed.OCR_WARNING), F.lit("\n\n"), "text")
    ).otherwise(F.col("text"))
    part = F.concat(F.lit("## صفحه "), F.col("number").cast("string"), F.lit("\n\n"), text)
    each = pages.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("number", part.alias("part")))).alias("_p"))
    return each.select("file", F.array_join(F.transform("_p", lambda p: p["part"]), "\n\n").alias("body"))


def in_order(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """``(key, markers array)`` of both: complete (equal), and is what was seen in the expected order?"""
    both = expected.select(key, F.col("markers").alias("_e")).join(observed.select(key, F.col("markers").alias("_o")), key, "left")
    seen = F.coalesce("_o", F.array().cast("array<string>"))
    return both.select(
        key,
        (F.col("_e") == seen).alias("complete"),
        (F.filter("_e", lambda m: F.array_contains(seen, m)) == seen).alias("ordered"),
    )


def batched(pages: DataFrame, doc: str, page: str, size: str, *, most: int = 5, max_bytes: int = 9 * (2 << 20) // 10) -> DataFrame:
    """Batch numbers of each document's pages in order: ``most`` pages and ``max_bytes`` at most; a larger page is alone."""
    from docloom.operators.bundles import assigned

    capped = pages.withColumns({"_one": F.lit(1), "_size": F.least(F.col(size), F.lit(max_bytes))})
    rows = assigned(capped, [page], words="_one", size="_size", max_words=most, max_bytes=max_bytes, run=doc)
    return rows.drop("_one", "_size").withColumnRenamed("bundle", "batch")
