"""The pipeline as a whole, the secret scan and the quality classifier, on the small tables."""

import random
import re

import corpus_pipeline
from lading.llm import decontaminate, packing, pii, quality_classifier, quality_rules, secret_scan

SMALL, LABELLED = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0D]+")


def _kept_by_rules(spark, docs):
    led = quality_rules.apply_policy(quality_rules.ledger(docs), quality_rules.POLICIES["default"])
    return {r["doc_id"] for r in led.where("kept").select("doc_id").collect()}


def _first_of_group(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.lower())
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    top = {i: i for i in texts}
    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    return {i for i in ids if root(i) == i}


def _plain(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_pipeline_matches_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [_plain(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items = [p for p in items if len(p) >= decontaminate.MIN_WORDS]
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}

    good = _kept_by_rules(spark, docs)
    short = {i for i, t in texts.items() if len(WORD.findall(t)) < 50}
    assert short and not good & short and len(good) > len(texts) / 3
    first = _first_of_group({i: texts[i] for i in good})
    assert len(first) < len(good)
    near, exact = set(), set()
    for i in first:
        words = _plain(texts[i])
        line = " " + " ".join(words) + " "
        for p in items:
            if f" {' '.join(p)} " in line:
                exact.add(i)
                near.add(i)
            elif i not in near and len(set(p) & set(words)) >= 0.6 * len(set(p)) and \
                    decontaminate.edit_search(p, words)[0] <= decontaminate.MAX_SHARE * len(p):
                near.add(i)

    rows = corpus_pipeline.run(spark, SMALL).collect()
    left = {r["doc_id"] for r in rows}
    assert first - near <= left <= first - exact
    assert len(left & near) <= 0.1 * len(near)                   # the target recall of the search is 0.95
    kept = docs.where(docs.doc_id.isin(list(left)))
    changed = {r["doc_id"]: r["text"] for r in pii.replace_documents(kept, b"k").collect()}
    for i in left:
        own = sorted((r["token_start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        assert sum(n for _, n in own) == len(WORD.findall(changed[i])) + 1
    for b in {r["bin_id"] for r in rows}:
        own = [r for r in rows if r["bin_id"] == b]
        assert sum(r["length"] for r in own) <= own[0]["capacity"] and own[0]["capacity"] in packing.CAPACITIES


def test_pipeline_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_secret_scan_tells_planted_keys_from_other_long_words(spark):
    rng = random.Random(4)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n: "".join(rng.choice(upper) for _ in range(n)) + "7"
    rows, secret, harmless = [], set(), set()
    for i in range(120):
        rows.append((3 * i, f'words before api_key = "{key(32)}" words after'))
        rows.append((3 * i + 1, f"write to user{i}name@mail{i}.example.com or call +49-{rng.randrange(10 ** 9, 10 ** 10)}-22"))
        rows.append((3 * i + 2, f"nothing to see in line {i}"))
        secret.add(3 * i)
        harmless.add(3 * i + 1)
    rows += [(1000, None), (1001, ""), (1002, "  "), (1003, "x" * 3000 + "1"), (1004, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "n", 1.5) for i, t in rows], "doc_id long, text string, value string, length double")
    got = secret_scan.scan(docs).collect()
    found = {r["doc_id"] for r in got if r["is_secret"]}
    assert secret <= found and not found & harmless and 1004 in found
    assert not {1000, 1001, 1002} & {r["doc_id"] for r in got}
    assert all(len(r["masked"]) <= 5 for r in got)
    labelled = spark.createDataFrame([(rows[0][1].split('"')[1], True), ("unmet-value-1", False)], "value string, is_secret boolean")
    assert secret_scan.scan(docs, labelled).count() == len(got)
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_quality_scores_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels"))
    held = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    got = {r["doc_id"]: r["score"] for r in quality_classifier.scores(docs, labels, f"not ({held})").collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    truth = {r["doc_id"]: r["quality"] for r in labels.where(held).collect() if r["doc_id"] in got}
    pairs = [(got[a], got[b]) for a in truth for b in truth if truth[a] == 1 and truth[b] == 0]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.9
