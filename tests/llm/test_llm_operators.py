"""Training-data operators against plain Python, with nulls, empty texts and clashing column names."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lading.llm import decontaminate, lm_scoring, ngram_join, packing, pii, quality_rules, substring_dedup, token_counts

WORD = re.compile("[^\x20\x09-\x0D]+")


def _docs(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(80)) for _ in range(6)]
    texts = [*base, base[0], base[0].upper(), base[1] + " tail", None, "", "  \n ", "one two", "one two", "line\nline\n\nx " * 40]
    rows = [(i, t, 7, "keep") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, row string"), texts


def test_rules_match_plain_python(spark):
    docs, texts = _docs(spark)
    got = {r["doc_id"]: r for r in quality_rules.ledger(docs).collect()}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        wins = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        covered = {k + j for k, w in enumerate(wins) if wins.count(w) > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert got[i]["n_words"] == len(words)
        assert got[i]["word_chars"] == sum(map(len, words))
        assert got[i]["n_repeat_words"] == len(covered)
        assert got[i]["n_dup_lines"] == len(lines) - len(set(lines))
    assert quality_rules.filter_documents(docs).columns == docs.columns


def test_jaccard_components_match_brute_force(spark):
    docs, texts = _docs(spark)
    sets = []
    for t in texts:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}


def test_edit_search_matches_dynamic_programme():
    rng = random.Random(1)
    for _ in range(200):
        p = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        t = [rng.randrange(4) for _ in range(rng.randrange(0, 20))]
        row, best = list(range(len(p) + 1)), (len(p), 0)
        for j, w in enumerate(t):
            prev, row = row, [0]
            for i in range(1, len(p) + 1):
                row.append(min(prev[i - 1] + (p[i - 1] != w), prev[i] + 1, row[i - 1] + 1))
            if row[-1] < best[0]:
                best = (row[-1], j + 1)
        assert decontaminate.edit_search(p, t) == best


def test_contamination_finds_edited_passage_and_offsets(spark):
    item = " ".join(f"word{k}" for k in range(20))
    edited = item.replace("word7", "other").replace("word12 ", "")
    docs = spark.createDataFrame([(1, f"Clean start. {item.upper()}! end"), (2, f"x y {edited} z"), (3, "nothing here"),
                                  (4, None), (5, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (8, None), (7, "short")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    assert set(got) == {1, 2} and got[1]["edits"] == 0 and got[2]["edits"] == 2
    assert (got[1]["start"], got[1]["end"]) == (13, 13 + len(item))


def test_token_counts_match_greedy_matching():
    rng = random.Random(3)
    mark = token_counts.MARK
    for _ in range(60):
        pieces = {mark, *(bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 5))) for _ in range(8))}
        words = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 10))) for _ in range(20)]
        ends = np.cumsum([len(w) for w in words])
        got = token_counts.count_words(token_counts.build(sorted(pieces)), np.frombuffer(b"".join(words), np.uint8),
                                       ends - [len(w) for w in words], ends).tolist()
        for w, n in zip(words, got):
            text, at, count = mark + w, 0, 0
            while at < len(text):
                end = next((e for e in range(len(text), at, -1) if text[at:e] in pieces), None)
                if end is None:
                    count = 1
                    break
                at, count = end, count + 1
            assert n == count


@pytest.mark.parametrize("left,right", [(10, 10), (7, 13), (26, 1)])
def test_permutation_is_one_to_one(left, right):
    assert sorted(pii.permute(v, left, right, b"k", "t") for v in range(left * right)) == list(range(left * right))


def test_surrogates_keep_format_and_coreference(spark):
    text = "a.b@x.org and a.b@x.org, +1 (017) 555-7713, 4111-1111-1111-1111, 10.0.0.1 Frau Schmidt"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "clean")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.replace_documents(docs, b"k").collect()}
    assert got[2] is None and got[3] == "clean"
    for own in ("a.b@x.org", "555-7713", "4111-1111", "10.0.0.1", "Schmidt"):
        assert own not in got[1]
    mails = re.findall(r"\S+@[a-z.]+", got[1])
    assert mails[0] == mails[1] and got[1].split()[-1] in pii.NAMES["f"]


def test_packing_covers_every_token_once(spark):
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate([0, 5, 700, 9000, 20000, 300, 300])], "doc_id long, text string")
    rows = packing.packed_sequences(docs).collect()
    for i, n in enumerate([0, 5, 700, 9000, 20000, 300, 300]):
        assert sum(r["length"] for r in rows if r["doc_id"] == i) == n + 1
    for b in {r["bin_id"] for r in rows}:
        own = sorted((r for r in rows if r["bin_id"] == b), key=lambda r: r["bin_offset"])
        assert [r["bin_offset"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert own[0]["capacity"] in packing.CAPACITIES and sum(r["length"] for r in own) == own[0]["bin_used"] <= own[0]["capacity"]


def test_removed_spans_keep_original_offsets(spark):
    passage = " ".join(f"p{k}" for k in range(30)) + "."
    docs = spark.createDataFrame([(1, f"first. {passage} rest one"), (2, f"other start. {passage} x"), (3, None), (4, "")],
                                 "doc_id long, text string")
    got = substring_dedup.removed_spans(docs).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["first_doc_id"]) for r in got] == [(2, 13, 13 + len(passage), 1)]
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.deduplicated(docs).collect()}
    assert passage in cut[1] and cut[2] == "other start.  x"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules.ledger(none).count() == 0
    assert packing.packed_sequences(none).count() == 0
    assert substring_dedup.removed_spans(none).count() == 0
    assert ngram_join.jaccard_components(none).count() == 0


def _lm_model(rng, docs=60):
    cuts = np.concatenate([[0], np.cumsum([1, 2, 32, 33, 48, 49, *rng.integers(1, 90, docs)])])
    seq = rng.integers(0, 40, cuts[-1])
    seq[cuts[1:] - 1] = lm_scoring.END
    pair, triple = lm_scoring.run_keys(seq, cuts)
    table = lm_scoring.table_of_runs(*np.unique(triple, return_counts=True))
    last = np.bincount((pair[cuts[1:] - 1] >> np.uint64(17)).astype(int), minlength=lm_scoring.IDS)
    totals = lm_scoring.Totals(np.bincount(seq, minlength=lm_scoring.IDS), last, lm_scoring.types_of(table[0]))

    def runs(seq, cuts, own=False):
        keys, back = lm_scoring.asked(seq, cuts)
        c, t, _ = lm_scoring.lookup(table, keys)
        return totals.experts(seq, cuts, back, c, t, own)
    class_of = np.minimum(np.arange(lm_scoring.IDS), lm_scoring.CLASSES - 1).astype(np.int32)
    w = lm_scoring.first_weights()
    for k in w:
        w[k] = w[k] + rng.normal(0, 0.2, w[k].shape).astype(np.float32)
    return seq, cuts, runs, class_of, w


def _lm_batch(class_of, runs, ids):
    seq, cuts = np.array(ids), np.array([0, len(ids)])
    return lm_scoring.Batch(class_of, seq, cuts, runs(seq, cuts))


def test_run_counts_match_plain_python():
    seq, cuts, runs, _, _ = _lm_model(np.random.default_rng(2))
    end, two, three = lm_scoring.END, {}, {}
    rows = [seq[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
    for r in rows:
        for k, y in enumerate(r):
            one, before = (r[k - 1] if k else end), (r[k - 2] if k > 1 else end)
            two.setdefault(one, []).append(y)
            three.setdefault((before, one), []).append(y)
    got, k = runs(seq, cuts)[0], 0
    for r in rows:
        for i, y in enumerate(r):
            one, before = (r[i - 1] if i else end), (r[i - 2] if i > 1 else end)
            p = (np.sum(seq == y) + 0.5) / (len(seq) + 0.5 * lm_scoring.IDS)
            for after in (two[one], three[before, one]):
                p = (after.count(y) + len(set(after)) * p) / (len(after) + len(set(after)))
            assert got[k, 2] == pytest.approx(p, rel=1e-4)
            k += 1


def test_attention_gradients_match_differences():
    rng = np.random.default_rng(3)
    seq, cuts, runs, class_of, w = _lm_model(rng)
    _, _, pos, scored = lm_scoring.windows(cuts)
    examples = (*lm_scoring.Batch(class_of, seq, cuts, runs(seq, cuts, own=True))[pos], scored)
    w = {k: v.astype(float) for k, v in w.items()}
    grad, _ = lm_scoring.gradients(w, *examples)
    for k in w:
        i = np.unravel_index(np.argmax(np.abs(grad[k])), w[k].shape)
        near = []
        for step in (1e-4, -1e-4):
            moved = {a: v.copy() for a, v in w.items()}
            moved[k][i] += step
            near.append(lm_scoring.gradients(moved, *examples)[1])
        assert grad[k][i] == pytest.approx((near[0] - near[1]) / 2e-4, rel=1e-3)


def test_lm_scores_are_the_models_each_id_once_and_sum_to_one():
    seq, cuts, runs, class_of, w = _lm_model(np.random.default_rng(1))
    batch, tables = lm_scoring.Batch(class_of, seq, cuts, runs(seq, cuts)), lm_scoring.score_tables(w)
    _, turn, pos, scored = lm_scoring.windows(cuts)
    assert sorted(pos[scored].tolist()) == list(range(cuts[-1]))
    for chosen, since in ((turn == 0, 0), (turn > 0, lm_scoring.WINDOW // 2)):
        fast = lm_scoring.probabilities(tables, batch, pos[chosen], since)
        for n, window in enumerate(pos[chosen]):
            ask = scored[chosen][n]
            for j in np.flatnonzero(ask)[::7]:
                one = np.zeros((1, lm_scoring.WINDOW), bool)
                one[0, j] = True
                loss = lm_scoring.gradients(w, *batch[window[None, :]], one)[1]
                assert np.exp(-loss) == pytest.approx(fast[n, j - since], rel=1e-3)
    alone = _lm_batch(class_of, runs, [777])      # the pointer meets nothing
    assert 0 < lm_scoring.probabilities(tables, alone, lm_scoring.windows(np.array([0, 1]))[2], 0)[0, 0] < 1
    # every id that could come third: probabilities add up to one
    total = 0.0
    for y in [*range(40), lm_scoring.END]:
        total += lm_scoring.probabilities(tables, _lm_batch(class_of, runs, [3, 4, y]), lm_scoring.windows(np.array([0, 3]))[2], 0)[0, 2]
    unseen = (lm_scoring.IDS - 41) * float(lm_scoring.probabilities(
        tables, _lm_batch(class_of, runs, [3, 4, 777]), lm_scoring.windows(np.array([0, 3]))[2], 0)[0, 2])
    assert total + unseen == pytest.approx(1, rel=1e-3)


def test_lm_scoring_counts_and_held_out_rows(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeio") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 200))) for _ in range(120)]
    texts += [None, "", " \n ", "ÄRGER über\u00a0x Ünd", "q" * 5000, texts[0], texts[0]]
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in lm_scoring.scores(docs, "doc_id % 4 = 1").collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [[*WORD.findall((t or "").translate(lower)), None] for t in texts]
    train = Counter(w for i, ws in enumerate(words) if i % 4 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    for i, ws in enumerate(words):
        r = got[i]
        own = sum(np.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (i % 4 == 1, len(ws), n)
        assert r["n_known"] == sum(train[w] > 0 for w in ws) and r["base_score"] == pytest.approx(own)
        assert r["score"] < 0
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scoring.scores(none, "doc_id % 4 = 1").count() == 0


def test_lm_counts_asked_by_block_equal_the_broadcast_ones(spark, monkeypatch):
    """Which words and runs are broadcast changes no score."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdeio") for _ in range(rng.randrange(2, 9))) for _ in range(120)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 150))) for _ in range(90)] + [None, "q " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)

    def found():
        return {r["doc_id"]: r for r in lm_scoring.scores(docs, "doc_id % 4 = 1").collect()}
    whole = found()
    monkeypatch.setattr(lm_scoring, "RUNS", 8)
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", 4)
    monkeypatch.setattr(lm_scoring, "_SLICE", 4096)
    asked = found()
    assert set(asked) == set(whole) == set(range(len(texts)))
    for i, r in whole.items():
        assert (asked[i]["n_tokens"], asked[i]["n_known"]) == (r["n_tokens"], r["n_known"])
        assert asked[i]["base_score"] == pytest.approx(r["base_score"])
        assert asked[i]["score"] == pytest.approx(r["score"], rel=1e-3)
