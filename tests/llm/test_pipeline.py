"""The pipeline against a brute-force version of its stages, and the registered queries' wiring."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from docloom.llm import mixing, quality_rules
from tests.llm.helpers import BLANK, lower, odd_docs, odd_rows, words
from tests.llm.test_operators import decontaminated, linked


def good_rows():
    """Odd rows whose texts pass the rules more often."""
    rows = [(i, (t or "").replace("\n", ".\n") if i != 300 else None, s) for i, t, s in odd_rows(seed=5)]
    return [r for r in rows if r[0] is not None]


def test_stages(spark, tmp_path):
    rows = good_rows()
    bench = [(1, rows[0][1]), (2, rows[9][1])]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd_docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [(i, t, s) for i, t, s in rows if quality_rules.verdicts([(t or "").encode()])[0]]
    kept = [(i, quality_rules.clean_lines(t.encode()).decode(), s) for i, t, s in kept]
    unique = list(dict.fromkeys((i, t) for i, t, _ in kept))
    assert len(unique) < len(kept)  # a repeated row
    classes = linked([(i, t, "") for i, t in unique])
    groups = {c for _, c, _ in classes}
    bad = {r[0] for r in decontaminated(rows, bench) if r[2]}
    ids = {r["doc_id"] for r in got}
    assert ids and ids.isdisjoint(bad) and ids <= {i for i, _ in unique}
    home = {i: c for i, c, _ in classes}
    assert len({home[i] for i in ids}) == len(ids) <= len(groups)  # one of each group

    tokenizer = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    texts, start = dict(unique), 0
    for r in sorted(got, key=lambda r: r["start"]):
        own = np.array([*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    assert max(Counter(r["doc_id"] for r in got).values()) <= 3
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(r["doc_id"] for r in got)
    assert all(words(texts[i]) and BLANK.search(texts[i]) for i in ids)


def test_stages_return_documents(spark, tmp_path):
    rows = good_rows()
    spark.createDataFrame([(1, "nothing here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd_docs(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_clean_documents_stay(spark, tmp_path):
    clean = [(i, " ".join(f"Word{i}x{k}, then more." for k in range(30)), "s") for i in range(20)]
    spark.createDataFrame([(1, "nothing here at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd_docs(spark, clean)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == len(clean)


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


CLASHING = "doc_id long, text string, source string, time string, left_out long, times int, kept boolean, key string, tie long"


def clashing_docs(spark, rows):
    return spark.createDataFrame([(*r, f"t{i}", i, 1, True, "k", 3) for i, r in enumerate(rows)], CLASHING)


def test_no_stage_loses_a_column_or_stumbles_over_its_name(spark, tmp_path):
    rows = good_rows()
    spark.createDataFrame([(1, rows[0][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = clashing_docs(spark, [*rows, (None, rows[2][1], "src1"), (900, None, "src1"), (901, "", None)])
    own = {r["time"]: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r["left_out"] == own[r["time"]]["left_out"] and r["doc_id"] == own[r["time"]]["doc_id"] for r in got)
    assert {r["doc_id"] for r in corpus_pipeline.tokens(spark, docs, "").collect()} == {r["doc_id"] for r in own.values()}


def test_repeated_ids_change_no_other_survivor(spark, tmp_path):
    rows = [r for r in good_rows() if r[1]]
    stays = lambda more: {(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, odd_docs(spark, [*rows, *more]), "").collect()}
    plain = stays([])
    more = [(7000, " ".join(f"p{i}" for i in range(30)), "a"), (7000, " ".join(f"q{i}" for i in range(30)), "a"), (None, " ".join(f"r{i}" for i in range(30)), "a")]
    assert stays(more) == plain | {(i, t) for i, t, _ in more}
    smallest = {min(i for i, t, _ in rows if i is not None and t == text) for _, text, _ in rows if text}
    assert {i for i, _ in plain} <= smallest


def test_of_equal_rows_one_stays_and_ids_are_integers(spark):
    text = " ".join(f"p{i}" for i in range(30))
    docs = odd_docs(spark, [(5, text, "a"), (5, text, "a"), (5, text, "b"), (None, text, "a"), (9, None, "a"), (9, None, "a"), (10, "", "a")])
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in got) == [(5, text), (9, ""), (10, "")]
    named = spark.createDataFrame([("a", text)], "doc_id string, text string")
    with pytest.raises(TypeError, match="doc_id must be an integer column"):
        mixing.mix(named.withColumn("source", F.lit("s")))


def plain_verdict(text):
    """The quality stage by its stated rules: the text without failing lines, or None where the document is rejected."""
    own = BLANK.findall(text or "")
    windows = defaultdict(list)
    for i in range(len(own) - 7):
        windows[tuple(own[i : i + 8])].append(i)
    repeated = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    if len(own) < 20 or 100 * len(repeated) > 30 * len(own):
        return None
    out, good = [], 0
    for line in text.split("\n"):
        ws = BLANK.findall(line)
        chars = sum(map(len, ws))
        symbols, separators = sum(c in "#*$%&|<>" for c in line), sum(c in "|>»›•·" for c in line)
        bad = bool(ws) and (
            10 * symbols > chars
            or (len(ws) >= 12 and not any(c in quality_rules.SENTENCE_MARKS for c in line))
            or (separators >= 2 and 3 * separators >= len(ws))
            or any(p in lower(line) for p in quality_rules.BOILERPLATE)
        )
        out += [] if bad else [line]
        good += 0 if bad else chars
    return "\n".join(out) if 2 * good >= sum(map(len, own)) else None


def test_quality_stage_against_its_rules(spark, tmp_path):
    rows = good_rows()
    rows += [(800, "Home | News | Sport | About\n" + " ".join(f"Word{k}, then." for k in range(30)) + "\nAll rights reserved.", "s")]
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.quality(spark, odd_docs(spark, rows), "").collect())
    want = [(i, plain_verdict(t)) for i, t, _ in rows]
    assert got == sorted((i, t) for i, t in want if t is not None) and 0 < len(got) < len(rows)


def test_mix_stage_comes_near_its_targets(spark):
    rows = [(i, "w " * (5 + i % 40), f"s{i % 7 % 3}") for i in range(700)]
    got = corpus_pipeline.mixture(spark, odd_docs(spark, rows), "").collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    total, target = sum(size.values()), {}
    left = {s: i % 3 + 1 for i, s in enumerate(sorted(size))}
    while over := [s for s in left if left[s] * (total - sum(target.values())) / sum(left.values()) > 3 * size[s]]:
        for s in over:
            target[s] = 3 * size[s]
            del left[s]
    rest, weights = total - sum(target.values()), sum(left.values())
    target |= {s: w * rest / weights for s, w in left.items()}
    taken = Counter()
    for r in got:
        taken[r["source"]] += len(r["text"].split())
    assert all(abs(taken[s] - target[s]) <= 22 for s in size)  # half of the longest document
    whole = {s: int(target[s] // size[s]) for s in size}
    times = Counter(r["doc_id"] for r in got)
    assert all(whole[s] <= times[i] <= whole[s] + 1 for i, _, s in rows)
