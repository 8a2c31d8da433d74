"""Text health: metrics, status, page routing, document roll-up, and the gate before retrieval.

A status says how healthy a text looks, never how accurate it is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import fixed
from docloom.functions import text as X
from docloom.functions.dates import let

RANK = {"PASS": 0, "WARNING": 1, "FAIL": 2}


def metrics(text: Column) -> Column:
    """Struct of counts over the text without embedded images. The text is cleaned and cut into lines once."""

    def counted(clean: Column, lines: Column) -> Column:
        return F.struct(
            F.length(clean).alias("characters"),
            X.count_words(clean).alias("tokens"),
            X.word_chars(clean).alias("word_chars"),
            F.size(lines).alias("lines"),
            F.size(F.filter(lines, lambda x: ~X.has_words(x))).alias("single_lines"),
            X.count_matches(clean, r"([A-Za-z])\1{4,}").alias("repeats"),
            X.count_matches(clean, r"[\^~<>\\{}]").alias("symbols"),
            X.count_matches(clean, "[؀-ۿ]").alias("persian"),
            clean.rlike("(?iu)" + "|".join(fixed.TABLE_WORDS)).alias("tabular"),
        )

    return let(X.without_images(text), lambda clean: let(X.lines(clean), lambda lines: counted(clean, lines)))


def _findings(m: Column) -> dict[str, Column]:
    """What the checks of a text find, from ``metrics``; shares are compared as products of counts."""
    many = m["lines"] > 15
    noisy = (
        ((2 * m["single_lines"] > m["lines"]) & many)
        | (m["repeats"] >= 3)
        | (100 * m["symbols"] > 12 * F.greatest(m["characters"], F.lit(1)))
    )
    return {
        "too_little_text": m["word_chars"] < 30,
        "noise": noisy,
        "suspect_structure": ~noisy & (((4 * m["single_lines"] > m["lines"]) & many) | (m["repeats"] > 0)),
        "table_or_drawing": m["tabular"],
    }


def status(m: Column) -> Column:
    """PASS, WARNING or FAIL from ``metrics``, which are computed once."""

    def judged(own: Column) -> Column:
        found = _findings(own)
        fail, warning = found["too_little_text"] | found["noise"], found["suspect_structure"] | found["table_or_drawing"]
        return F.when(fail, "FAIL").when(warning, "WARNING").otherwise("PASS")

    return let(m, judged)


def reasons(m: Column) -> Column:
    """Codes of the findings behind a status, in the order of the checks."""
    return let(m, lambda own: F.array_compact(F.array(*[F.when(found, name) for name, found in _findings(own).items()])))


def _known(anchors: tuple[str, ...]) -> Column:
    """The anchors with what they are compared by, as literals."""
    pairs = [F.struct(F.lit(a).alias("name"), F.lit(re.sub("[^A-Z0-9]", "", a.upper())).alias("key")) for a in anchors]
    return F.array(*pairs) if pairs else F.array().cast("array<struct<name:string,key:string>>")


def missing_anchors(source: Column, text: Column, anchors: tuple[str, ...] = fixed.ANCHORS) -> Column:
    """Anchor phrases that the source has and the text lacks, compared by upper-case letters and digits."""
    both = F.struct(X.compact(source).alias("own"), X.compact(X.without_images(text)).alias("other"))

    def lacking(b: Column) -> Column:
        found = F.filter(_known(anchors), lambda a: F.contains(b["own"], a["key"]) & ~F.contains(b["other"], a["key"]))
        return F.transform(found, lambda a: a["name"])

    return let(both, lacking)


def with_anchors(state: Column, missing: Column, n_anchors: Column) -> Column:
    """A status after the anchor check: the critical one, or half of them and two at least, fail it."""
    n = F.size(missing)
    fail = F.array_contains(missing, fixed.CRITICAL_ANCHOR) | ((n >= 2) & (2 * n >= F.greatest(n_anchors, F.lit(1))))
    return F.when(n == 0, state).when(fail | (state == "FAIL"), "FAIL").otherwise("WARNING")


def with_anchor_counts(state: Column, anchors: Column) -> Column:
    """``with_anchors`` from the counts of ``anchor_counts``."""
    n, missing = anchors["n"], anchors["missing"]
    fail = anchors["critical"] | ((missing >= 2) & (2 * missing >= F.greatest(n, F.lit(1))))
    return F.when(missing == 0, state).when(fail | (state == "FAIL"), "FAIL").otherwise("WARNING")


def anchors_of(source: Column, anchors: tuple[str, ...] = fixed.ANCHORS) -> Column:
    def having(own: Column) -> Column:
        return F.transform(F.filter(_known(anchors), lambda a: F.contains(own, a["key"])), lambda a: a["name"])

    return let(X.compact(source), having)


def anchor_counts(rows: DataFrame, source: str, text: str, phrases: DataFrame, *, block_bytes: int = 8_000_000) -> DataFrame:
    """``rows`` with ``anchors``: how many of ``phrases(text)`` the source has (n), of these the text lacks (missing), and
    whether it lacks the critical one. The phrases go to every row in broadcast blocks of about ``block_bytes``."""
    phrases = phrases.where("text is not null")
    blocks = -(-(phrases.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("missing"), F.lit(False).alias("critical"))
    own, other = X.compact(F.col(source)).alias("_own"), X.compact(X.without_images(F.col(text))).alias("_other")
    out = rows.select("*", own, other, none.alias("anchors"))

    def counted(s: Column, a: Column) -> Column:
        gone = ~F.coalesce(F.contains("_other", a["key"]), F.lit(False))
        more = F.struct(
            (s["n"] + 1).alias("n"),
            (s["missing"] + gone.cast("long")).alias("missing"),
            (s["critical"] | (gone & (a["name"] == fixed.CRITICAL_ANCHOR))).alias("critical"),
        )
        return F.when(F.contains("_own", a["key"]), more).otherwise(s)

    for i in range(blocks):
        part = phrases.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == i)
        pair = F.struct(F.col("text").alias("name"), X.compact(F.col("text")).alias("key"))
        out = out.crossJoin(F.broadcast(part.agg(F.collect_list(pair).alias("_phrases"))))
        out = out.withColumn("anchors", F.aggregate("_phrases", F.col("anchors"), counted)).drop("_phrases")
    return out.drop("_own", "_other")


def routing(raw: Column, text: Column, image_ratio: Column, turned: Column, span_text: Column) -> Column:
    """Reasons to send a page to OCR; none keeps its own text.

    ``text`` is ``raw`` after ``messages.page_text``; ``turned``: its text surely runs another way; ``span_text``: the
    whole text layer, normalised.
    """
    known = F.array(*[F.lit(w) for w in fixed.PERSIAN_WORDS])
    english = F.array(*[F.lit(w) for w in fixed.ENGLISH_WORDS])

    def judged(p: Column) -> Column:
        m, persian, latin, lines = p["m"], p["persian"], p["latin"], p["lines"]
        normal = F.size(F.filter(persian, lambda w: F.array_contains(known, w)))
        backward = F.size(F.filter(persian, lambda w: F.array_contains(known, F.reverse(w)) & ~F.array_contains(known, w)))
        short = F.size(F.filter(lines, lambda x: X.word_chars(x) <= 2))
        rules = {
            "health": status(m) == "FAIL",
            "structure": (status(m) != "FAIL") & F.array_contains(reasons(m), "suspect_structure"),
            "glyphs": p["glyphs"],
            "image": p["image"] >= 0.05,
            "reversed": (backward >= 3) & (backward > normal),
            "unknown_persian": (F.size(persian) >= 15) & (10 * normal < F.size(persian)),
            "unknown_latin": (F.size(persian) == 0)
            & (F.size(latin) >= 15)
            & ~F.exists(latin, lambda w: F.array_contains(english, F.lower(w))),
            "fragments": (F.size(lines) >= 10) & (10 * short > 4 * F.size(lines)),
            "turned": p["turned"],
            "lost_text": (p["span"] > 100) & (10 * p["length"] < 8 * p["span"]),
            "little_text": p["word_chars"] < 30,
        }
        return F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(k)) for k, rule in rules.items()]))

    parts = F.struct(
        metrics(text).alias("m"),
        F.regexp_extract_all(F.regexp_replace(text, "‌", ""), F.lit("[؀-ۿ]+"), F.lit(0)).alias("persian"),
        F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0)).alias("latin"),
        X.lines(text).alias("lines"),
        raw.rlike("�|\\x00|\\(cid:\\d+\\)").alias("glyphs"),
        F.length(span_text).alias("span"),
        F.length(text).alias("length"),
        X.word_chars(text).alias("word_chars"),
        image_ratio.alias("image"),
        F.coalesce(turned, F.lit(False)).alias("turned"),
    )
    return let(parts, judged)


def scan_like(text: Column, image_ratio: Column) -> Column:
    return (image_ratio >= 0.5) | (F.length(X.strip(text)) < 20) | F.contains(text, F.lit("�"))


def orientation(lines: DataFrame, keys: list[str], *, least: int = 80) -> DataFrame:
    """``lines(*keys, direction, letters)``: the winning direction of each page, and is it sure?

    Lines of 12 letters or more vote with their letters; sure from 80 letters on, four fifths of them one way.
    """
    votes = lines.where("letters >= 12").groupBy(*keys, "direction").agg(F.sum("letters").alias("letters"))
    page = votes.groupBy(*keys).agg(
        F.sum("letters").alias("total"),
        F.max(F.struct("letters", "direction")).alias("best"),
    )
    sure = (F.col("total") >= least) & (F.col("best.letters") * 5 >= F.col("total") * 4)
    return page.select(*keys, F.col("best.direction").alias("direction"), "total", sure.alias("sure"))


def document_status(pages: DataFrame, keys: list[str], *, state: str = "status", chars: str = "characters") -> DataFrame:
    """Pages rolled up: the worst status, pages that may be used, and whether there is any."""
    rank = F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv])[F.col(state)]
    usable = F.col(state).isin("PASS", "WARNING") & (F.col(chars) > 0)
    grouped = pages.groupBy(*keys).agg(
        F.max(rank).alias("_worst"), F.count("*").alias("pages"), F.count(F.when(usable, 1)).alias("usable_pages")
    )
    names = F.array(*[F.lit(x) for x in RANK])
    return grouped.select(
        *keys, F.get(names, F.col("_worst")).alias("status"), "pages", "usable_pages", (F.col("usable_pages") > 0).alias("ready")
    )


def admitted(df: DataFrame, *, text: str, ready: str, state: str, policy: str) -> DataFrame:
    """The gate before retrieval: no text markers, not declared unready, not failed unless the e-mail comes first."""
    no_text = F.col(text).rlike("|".join(fixed.NO_EXTRACTABLE_TEXT))
    ok = ~(
        F.coalesce(no_text, F.lit(False))
        | F.coalesce(F.col(ready) == F.lit(False), F.lit(False))
        | F.coalesce((F.col(state) == "FAIL") & ~F.col(policy).eqNullSafe(F.lit(fixed.EMAIL_FIRST)), F.lit(False))
    )
    return df.where(ok)


def overlaid(df: DataFrame, report: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``df`` with those fields of a report that has a row for it; its own elsewhere."""
    other = report.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = df.join(other, F.col(key) == F.col("_key"), "left")
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).drop("_key", *[f"_{f}" for f in fields])


def without_failed_pages(body: Column) -> Column:
    """Page sections that failed, or whose text nobody vouches for, go."""
    parts = F.split(body, r"(?m)(?=^## صفحه \d+\s*$)")
    bad = r"(?m)^> کیفیت: FAIL(?![\p{L}\p{N}_])|^> متن این صفحه تأیید نشده است"
    return F.array_join(F.filter(parts, lambda p: ~p.rlike(bad)), "\n\n")


def pages_to_process(total: Column, size_mb: Column) -> Column:
    """All pages, or the first five of a document that has more than 15 or is larger than 10 MB."""
    large = (total > fixed.PAGE_LIMIT) | (size_mb > fixed.SIZE_LIMIT_MB)
    return F.when(large, F.least(F.lit(fixed.PREVIEW_PAGES), total)).otherwise(total)


def coverage(raw: DataFrame, local: DataFrame, ocr: DataFrame) -> DataFrame:
    """``raw(name, ext)`` against text outputs ``local(name)`` and ``ocr(name)``, by full name.

    PDFs need OCR output; others either. States: covered, missing, or not_text (no converter).
    """
    have = raw.join(local.select("name", F.lit(True).alias("_l")).distinct(), "name", "left")
    have = have.join(ocr.select("name", F.lit(True).alias("_o")).distinct(), "name", "left")
    has_local, has_ocr = F.col("_l").isNotNull(), F.col("_o").isNotNull()
    convertible = F.col("ext").isin(*fixed.OFFICE_EXTENSIONS, *fixed.OCR_EXTENSIONS)
    done = F.when(F.col("ext") == ".pdf", has_ocr).otherwise(has_local | has_ocr)
    state = F.when(~convertible, "not_text").when(done, "covered").otherwise("missing")
    return have.select("name", "ext", state.alias("state"), F.coalesce(has_local & has_ocr, F.lit(False)).alias("both"))
