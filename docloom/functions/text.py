"""Text functions as columns: they stay inside code generation, no Python runs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions import fixed

WORD = r"[^\p{L}\p{N}_]"  # what is not a word character
TWO_WORD_CHARS = r"[\p{L}\p{N}_][^\p{L}\p{N}_]*[\p{L}\p{N}_]"
# Fixed: Unicode's white space.
WHITE = "\t\n\x0b\x0c\r\x20\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_ENDS = r"\R|[\x1c-\x1e]"


def strip(text: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.trim(text, F.lit(WHITE))


def lines(text: Column) -> Column:
    """Trimmed lines that are not empty."""
    return F.filter(F.transform(F.split(text, LINE_ENDS), strip), lambda x: x != "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, WORD + "+", ""))


def has_words(text: Column) -> Column:
    """Two word characters or more? The search ends at the second one."""
    return text.rlike(TWO_WORD_CHARS)


def count_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != ""))


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def measurements(text: Column) -> Column:
    """Words, characters and UTF-8 bytes."""
    return F.struct(
        count_words(text).alias("words"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes")
    )


def persian_letters(text: Column) -> Column:
    """Arabic yeh, kaf and heh-with-yeh as Persian letters; direction marks go."""
    return F.translate(text, "يكۀ‎‏", "یکه")


def thread_key(text: Column) -> Column:
    """A name for comparison: Persian letters and digits unified, spaces collapsed, lower case.

    The text must be in composed form already (``messages.composed``); ASCII and precomposed letters are.
    """
    unified = F.translate(persian_letters(text), "۰۱۲۳۴۵۶۷۸۹‌", "0123456789 ")
    return F.lower(strip(F.regexp_replace(unified, r"(?U)\s+", " ")))


def file_name(name: Column, limit: int = 60) -> Column:
    """A name without illegal characters, its stem cut to ``limit``; the extension stays."""
    clean = strip(F.regexp_replace(name, r'[\\/*?:"<>|\x00-\x1f]', "_"))
    extension = F.regexp_extract(clean, r"^\.*[^.].*(\.[^.]*)$", 1)
    stem = F.substring(clean, F.lit(1), F.length(clean) - F.length(extension))
    short = F.when(F.length(stem) > limit, F.regexp_replace(F.substring(stem, 1, limit), r"(?U)\s+$", "")).otherwise(stem)
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit(fixed.NO_NAME)).otherwise(F.concat(short, extension))


def export_name(name: Column, limit: int = 100, *, empty: str = fixed.NO_NAME) -> Column:
    """A name for exports: warnings go, spaces collapse, no trailing dots or spaces; ``empty`` if nothing is left."""
    bare = F.regexp_replace(name, "(?i)" + fixed.SUBJECT_WARNING, "")
    clean = F.regexp_replace(F.regexp_replace(bare, r'[\\/*?:"<>|\x00-\x1f]', "_"), r"(?U)\s+", " ")
    cut = F.regexp_replace(F.substring(clean, 1, limit), r"^[ .]+|[ .]+$", "")
    return F.when(F.coalesce(cut, F.lit("")) == "", F.lit(empty)).otherwise(cut)


def fitted_name(name: Column, limit: Column) -> Column:
    """A name of at most ``limit`` characters: the tail gives way to a hash of the whole."""
    suffix = F.regexp_extract(name, r"[^.].*(\.[^.]+)$", 1)
    cut = F.substring(name, F.lit(1), (limit - F.length(suffix) - 13).cast("int"))
    return F.when(F.length(name) <= limit, name).otherwise(
        F.concat(cut, F.lit("_"), F.substring(F.sha2(name, 256), 1, 12), suffix)
    )


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^./\\](\.[^./\\]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^./\\])\.[^./\\]+$", "")


def subject_key(subject: Column) -> Column:
    """A subject without reply and forward prefixes and warnings."""
    bare = strip(F.regexp_replace(subject, "(?i)" + fixed.SUBJECT_WARNING, ""))
    key = strip(F.regexp_replace(bare, "(?i)" + fixed.SUBJECT_PREFIXES, ""))
    return F.when(F.coalesce(key, F.lit("")) == "", F.lit(fixed.NO_THREAD_SUBJECT)).otherwise(key)


def without_subject_warning(subject: Column) -> Column:
    return F.regexp_replace(subject, "(?i)" + fixed.SUBJECT_WARNING, "")


def without_images(text: Column) -> Column:
    """Without embedded image data and references."""
    data = F.regexp_replace(text, r"\[image\d+\]:\s*<data:image/[^>]+>", "")
    return strip(F.regexp_replace(data, r"!\[[^\]]*\]\([^)]*\)|!\[\]\[image\d+\]", ""))


def ocr_text(text: Column) -> Column:
    """OCR Markdown: escapes undone, image references gone, lines trimmed, runs of blank lines one."""
    plain = F.regexp_replace(text, r"\\([-*_])", "$1")
    plain = F.regexp_replace(plain, r"!\[\]\[image\d+\]|\[image\d+\]:\s*<data:image/[^>]+>", "")
    trimmed = F.array_join(F.transform(F.split(F.regexp_replace(plain, r"(\R|[\x1c-\x1e])\z", ""), LINE_ENDS), strip), "\n")
    return F.coalesce(F.regexp_replace(trimmed, r"\n{3,}", "\n\n"), F.lit(""))


def compact(text: Column) -> Column:
    """Upper-case ASCII letters and digits alone."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def without_links(text: Column) -> Column:
    """Without bracketed mail addresses and links."""
    for pattern in fixed.MAIL_LINKS:
        text = F.regexp_replace(text, pattern, "")
    return text


def without_banners(body: Column, hosts: tuple[str, ...] = ()) -> Column:
    """Security banners go: a short paragraph whole, of a long one the lines that match.

    Paragraphs end at blank lines. ``hosts``: mail hosts whose name alone marks a banner.
    """
    own_hosts = tuple(map(re.escape, hosts))
    banner, banner_line = (f"(?iU){'|'.join((*p, *own_hosts))}" for p in (fixed.BANNERS, fixed.BANNER_LINES))
    paragraphs = F.split(body, r"\n(?:[ \t]*\n)+")

    def judged(p: Column) -> Column:
        own = F.split(F.regexp_replace(p, r"\R\z", ""), LINE_ENDS)
        short = (F.size(own) <= 4) & (F.length(p) < 600)
        rest = F.array_join(F.filter(own, lambda x: ~x.rlike(banner_line)), "\n")
        return F.when(~p.rlike(banner), p).when(~short, rest)

    return F.array_join(F.filter(F.transform(paragraphs, judged), lambda p: p.isNotNull()), "\n\n")


def is_signature_title(line: Column) -> Column:
    """A job title in a signature, by the bounds and patterns of ``fixed.SIGNATURE_TITLE``."""
    rule = fixed.SIGNATURE_TITLE
    checks = {
        "chars": F.length(line).between(*rule["chars"]),
        "words": count_words(line).between(*rule["words"]),
        "with": line.rlike("(?iU)" + rule["with"]),
        "without": ~line.rlike(rule["without"]),
    }
    return F.array_min(F.array(*checks.values()))


def keep_attachment(name: Column, size: Column, hidden: Column) -> Column:
    """Known extensions; no hidden images, no small inline images."""
    kind = extension(name)
    image = kind.isin(*fixed.IMAGE_EXTENSIONS)
    inline = F.lower(name).rlike("|".join(fixed.INLINE_WORDS)) & (size < fixed.INLINE_IMAGE_BYTES)
    return kind.isin(*fixed.VALID_EXTENSIONS) & ~(image & (F.coalesce(hidden, F.lit(False)) | inline))


def is_photo_or_logo(name: Column) -> Column:
    prefixes = "|".join(map(re.escape, fixed.PHOTO_PREFIXES))
    return F.lower(name).rlike(f"^(?:{prefixes})|_(?:{prefixes})|{'|'.join(fixed.NOISE_WORDS)}")


def useful_image_text(text: Column, least: int = 200) -> Column:
    """Has an image's OCR text enough besides white space and markup?"""
    return F.length(F.regexp_replace(text, r"(?U)[\s#*_>`|\-\[\]()!]+", "")) >= least


def references(text: Column) -> Column:
    """Sorted distinct e-mail and attachment ids, in canonical case (upper-case letters mark parts, hex is lower)."""
    found = F.transform(
        F.regexp_extract_all(text, F.lit(fixed.REFERENCE), F.lit(0)),
        lambda r: F.regexp_replace(F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 99))), "-t-", "-T-"),
    )
    return F.array_sort(F.array_distinct(found))


def codes(text: Column, pattern: str) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))


def cell(value: Column) -> Column:
    """A table cell: one line, bars escaped."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "\n", " "), r"\|", r"\\|")
    return strip(text)


def compact_rows(rows: Column) -> Column:
    """``array<array<string>>`` without rows and columns that are all blank; rows get the same width."""
    full = lambda x: F.coalesce(strip(x), F.lit("")) != ""
    some = F.filter(rows, lambda r: F.exists(r, full))
    width = F.aggregate(some, F.lit(0), lambda n, r: F.greatest(n, F.size(r)))
    columns = F.filter(
        F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>")),
        lambda c: F.exists(some, lambda r: F.coalesce(full(F.get(r, c)), F.lit(False))),
    )
    return F.transform(some, lambda r: F.transform(columns, lambda c: F.coalesce(F.get(r, c), F.lit(""))))


def markdown_table(rows: Column) -> Column:
    """``array<array<string>>`` as a Markdown table, its first row the header; ragged rows are filled up."""
    width = F.aggregate(rows, F.lit(0), lambda n, r: F.greatest(n, F.size(r)))
    bar = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    filled = F.transform(
        rows,
        lambda r: bar(F.transform(F.sequence(F.lit(0), width - 1), lambda c: cell(F.get(r, c)))),
    )
    rule = bar(F.array_repeat(F.lit("---"), width))
    table = F.concat(F.slice(filled, 1, 1), F.array(rule), F.slice(filled, F.lit(2), F.greatest(F.size(filled), F.lit(1))))
    return F.when(width > 0, F.array_join(table, "\n")).otherwise(F.lit(""))


def header_field(header: Column, key: str) -> Column:
    """A front-matter field; empty where it is missing."""
    return strip(F.regexp_extract(header, rf"(?m)^\Q{key}\E:[ \t]*(.*)$", 1))


def split_header(text: Column) -> Column:
    """Struct (header, body): front matter between ``---`` lines, BOM and CRLF allowed; else all is body."""
    pattern = r"(?s)\A\x{FEFF}?---\r?\n(.*?)\r?\n---(?:\r?\n|$)"
    has = text.rlike(pattern)
    return F.struct(
        F.when(has, F.regexp_extract(text, pattern, 1)).otherwise("").alias("header"),
        F.when(has, F.regexp_replace(text, pattern, "")).otherwise(text).alias("body"),
    )


def kept_header_lines(header: Column) -> Column:
    """The lines on kind, coverage and notes."""
    names = "|".join(fixed.KEYS[k] for k in ("kind", "coverage", "notes"))
    return F.array_join(F.filter(F.split(header, LINE_ENDS), lambda x: x.rlike(f"^(?:{names}):")), "\n")
