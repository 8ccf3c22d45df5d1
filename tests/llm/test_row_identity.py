"""Rows are told apart by their place, not by their id: repeated rows, several
texts under one id, null ids, hot rows and clashing column names."""

import random

import pytest

import corpus_pipeline
from lading.llm import ngram_join, packing, substring_dedup

SCHEMA = "doc_id long, text string, lang string, drop_id long, again_id long, row long, removed_spans string, given string, gone int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "l", 1, 2, 3, "s", "g", 4) for i, t in rows], SCHEMA)


def _text(rng, n):
    return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    base = _text(rng, 60)
    near = " ".join([*base.split()[:30], "other", *base.split()[31:]])
    return base, near, _text(rng, 60), _text(rng, 60), _text(rng, 60)


def test_components_take_null_and_repeated_ids(spark, texts):
    base, near, a, b, c = texts
    rows = [(None, base), (None, near), (7, a), (7, b), (5, c), (5, c), (None, None), (None, ""), (9, base), (9, a)]
    got = ngram_join.jaccard_components(_frame(spark, rows), percent=80).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(None, 57, 9), (None, 57, 9), (7, 57, 7), (7, 57, 7), (5, 57, 5), (5, 57, 5), (None, 0, None), (None, 0, None), (9, 57, 9), (9, 57, 7)],
        key=repr)
    alone = ngram_join.jaccard_components(_frame(spark, rows[:2]), percent=80).collect()
    assert [r["component_id"] for r in alone] == [None, None]


def test_one_row_of_each_group_stays(spark, texts):
    base, near, a, b, c = texts
    rows = [(None, base), (3, near), (7, a), (7, b), (5, c), (5, c), (5, c), (None, None), (1, a)]
    docs = _frame(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(3, near), (7, b), (5, c), (None, None), (1, a)], key=repr)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_first_of_repeated_rows_keeps_its_text(spark, texts):
    base, _, a, b, _ = texts
    rows = [(1, base), (1, base), (2, a), (2, f"{b}. {a}"), (2, f"{b}."), (None, base), (None, base), (4, None), (4, "")]
    docs = _frame(spark, rows)
    got = substring_dedup.deduplicated(docs)
    assert got.columns == [*docs.columns, "removed_spans_"]
    left = [(r["doc_id"], r["text"], r["lang"]) for r in got.collect()]
    by_id = {i: sorted(t for d, t, _ in left if d == i and t is not None) for i in (1, 2, 4)}
    assert by_id[1] == ["", base]
    assert by_id[2] == sorted([a, f"{b}. ", ""])
    assert [t for d, t, _ in left if d is None] and sorted(t for d, t, _ in left if d is None) == ["", ""]
    assert len(left) == len(rows) and (4, None, "l") in left
    spans = substring_dedup.removed_spans(docs).collect()
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in spans if r["doc_id"] is not None) == sorted(
        [(1, 0, len(base)), (2, len(b) + 2, len(b) + 2 + len(a)), (2, 0, len(b) + 1)])
    assert sum(r["doc_id"] is None for r in spans) == 2 and {r["first_doc_id"] for r in spans} == {1, 2}


def test_removed_text_is_what_a_plain_loop_removes(spark):
    """Unit by unit over the rows in order, for sentences of three words or more."""
    rng = random.Random(12)
    pool = [" ".join(f"{c}{k}" for k in range(12)) + "." for c in "abcdefgh"]
    rows = []
    for i in range(60):
        run = rng.randrange(6)
        parts = [" ".join(f"own{i}x{j}y{k}" for k in range(8)) + "." for j in range(rng.randrange(1, 4))] + pool[run:run + rng.randrange(1, 5)]
        rows.append((i // 2, " ".join(parts)))
    seen, want = set(), []
    for _, text in rows:
        units = [u + "." for u in text.split(".") if u.strip()]
        again = [u.strip() in seen for u in units]
        seen |= {u.strip() for u in units}
        kept, k = "", 0
        while k < len(units):
            end = k
            while end < len(units) and again[end] == again[k]:
                end += 1
            if not again[k] or sum(len(u.split()) for u in units[k:end]) < 25:
                kept += "".join(units[k:end])
            k = end
        want.append(" ".join(kept.split()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [" ".join(r["text"].split()) for r in substring_dedup.deduplicated(docs, often_lines=False).collect()]
    assert sorted(got) == sorted(want) and sum(map(len, got)) < sum(len(t) for _, t in rows)


def test_hot_rows_are_dealt_over_the_packing_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 500)
    rows = [(None, "")] * 3000 + [(5, "a b c")] * 2000 + [(k, "x " * (k % 40)) for k in range(1000)]
    got = packing.packed_sequences(_frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r["length"] for r in got) == 3000 + 4 * 2000 + sum(k % 40 + 1 for k in range(1000))
    held = {}
    for r in got:
        held[r["bin_id"] >> 40] = held.get(r["bin_id"] >> 40, 0) + 1
    assert len(held) == 13 and max(held.values()) < 700
    used, at = {}, {}
    for r in got:
        used[r["bin_id"]] = used.get(r["bin_id"], 0) + r["length"]
        at.setdefault(r["bin_id"], []).append((r["bin_offset"], r["length"]))
        assert r["capacity"] in packing.CAPACITIES
    assert all(used[r["bin_id"]] == r["bin_used"] <= r["capacity"] for r in got)
    for places in at.values():                                # no gap and no overlap inside a bin
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0
