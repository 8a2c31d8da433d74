"""Small tables with every odd case, and brute-force versions."""

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def odd_rows(seed=1, n=40):
    """(doc_id, text, source): copies, near copies, shared passages, nulls, empties, one long text, repeated rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "über", "naïve", "ÅA1"]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k)).capitalize() + "."
    passage = sentence(70)
    rows = []
    for i in range(n):
        lines = [sentence(rng.randint(3, 25)) for _ in range(rng.randint(1, 8))]
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        rows.append((i, "\n".join(lines), f"src{i % 5}"))
    for i in range(8):
        base = rows[i][1].split(" ")
        base[len(base) // 2] = "changed"
        rows.append((100 + i, " ".join(base), "src0"))
        rows.append((200 + i, rows[i][1], None))
    rows += [
        (300, None, "src1"), (301, "", "src1"), (302, " \n\t\n", None), (303, "one", ""), (304, "one", "z"),
        (None, rows[3][1], "src2"), (None, None, None), (5, rows[5][1], "src0"), (5, rows[5][1], "src0"),
        (-7, "Ünï " * 30, "src3"), (305, sentence(4000), "src4"), (306, ". ! ?", "src4"), (307, "a b c", "src1"), (308, "A  b\nC", "src1"),
    ]
    return rows


SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, size int, n_words string, node int, chunk int, spans int"


def odd_docs(spark, rows=None):
    """With more columns, some of them named as results and helpers are."""
    rows = odd_rows() if rows is None else rows
    return spark.createDataFrame([(*r, "en", len(r[1] or ""), 1, "x", 2, 3, None) for r in rows], SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
