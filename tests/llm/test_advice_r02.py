"""Whole-job tests of the training-data operators: what a cap or a skipped case would lose."""

import itertools

import corpus_pipeline
import numpy as np

from lading.llm import decontaminate, pii, secret_scan, substring_dedup


def _words(rng, n):
    return rng.integers(0, 5000, n)


def _text(words):
    return " ".join(f"w{k}" for k in words)


def test_edited_copies_of_long_items_are_found(spark):
    rng = np.random.default_rng(5)
    items = [_words(rng, n) for n in (16, 60, 120, 300, 300, 700) for _ in range(3)]
    docs = []
    for k, item in enumerate(items):
        for copy in range(10):
            edited = decontaminate._edited(item.astype(np.uint64), len(item) // 5, rng).tolist()
            docs.append((100 * k + copy, " ".join([_text(_words(rng, 9)), _text(edited), _text(_words(rng, 30))])))
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        [(k, _text(i)) for k, i in enumerate(items)], "item_id long, text string")).collect()
    found = {r["doc_id"] for r in got if r["item_id"] == r["doc_id"] // 100}
    for k, item in enumerate(items):
        assert sum((100 * k + c) in found for c in range(10)) >= 8, len(item)
    assert len(found) >= 0.95 * len(docs)


def test_short_items_and_scripts_without_spaces_are_found(spark):
    han = "\u5149\u5408\u4f5c\u7528\u5728\u690d\u7269\u7684\u54ea\u4e2a\u90e8\u5206\u8fdb\u884c\uff1f"       # 14 characters and a sign
    thai = "\u0e20\u0e32\u0e29\u0e32"
    docs = [(1, "He asked: who wrote Faust? Nobody knew"), (2, "who wrote, they say, Faust"), (3, f"abc{han}xyz"),
            (4, "\u524d" + han[:6] + "\u3002" + han[7:] + "\u540e"), (5, f"\u0e01{thai}\u0e01 z"), (6, han[7:]), (7, "who wrote"), (8, "Faust")]
    items = [(1, "Who wrote Faust"), (2, han), (3, thai), (4, "who wrote faust?"), (5, "?!"), (6, "")]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (1, 4), (3, 2), (4, 2), (5, 3)}
    at = {(r["doc_id"], r["item_id"]): (r["start"], r["end"], r["edits"], r["item_words"]) for r in got}
    assert at[1, 1] == (10, 25, 0, 3) and at[3, 2] == (3, 17, 0, 14) and at[4, 2][2:] == (1, 14) and at[5, 3] == (1, 5, 0, 4)


def test_short_units_bridge_repeats_and_frequent_lines_go(spark):
    parts = [" ".join(f"{c}{k}" for k in range(7)) + "." for c in "abcde"]
    passage = f"1. {parts[0]} Mr. {parts[1]} Yes! No! {parts[2]}\n2.\n{parts[3]} Dr. {parts[4]} End."     # runs of 7 long words
    rows = [(1, f"one starts here. {passage} one ends here."), (2, f"Dr. two starts here. {passage} Dr. two ends here."),
            (3, "Dr. Mr. Yes! 1. 2."), (4, "short " * 40), (5, None), (6, "")]
    rows += [(100 + k, f"own text number {k}\nShare this page now. Subscribe to our letter.\nmore of text {k}") for k in range(12)]
    rows += [(200 + k, f"other text number {k}\nA rare line here.\nrest of it {k}") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = sorted(tuple(r) for r in substring_dedup.removed_spans(docs).select("doc_id", "start", "end", "n_words").collect())
    line = [(100 + k, 18 + len(str(k)) - 1, 63 + len(str(k)) - 1, 8) for k in range(1, 12)]
    assert spans == [(2, 21, 21 + len(passage), 42), *[(d, 18 + len(str(d - 100)) - 1, e, w) for d, _, e, w in line]]
    assert {len(r[1][s:e].split()) for r in rows for d, s, e, _ in spans if d == r[0]} == {42, 8}


def test_whole_names_and_their_later_mentions_are_replaced():
    text = ("Mrs. Mary Jones met Dr. Ann-Marie O'Neil, MR BROWN; Prof. Dr. J. K. von Berg left. Jones's friend Mary "
            "called JONES, Neil and Berg. Jonestown and brown stay, write to mary.jones@x.org. Dr. Jones. Drive on.")
    new, found = pii.replace(text, b"k")
    for own in ("Mary", "Jones'", "Jones.", "JONES", "Ann", "Marie", "Neil", "BROWN", "Berg", "J. K.", "mary.jones"):
        assert own not in new, own
    assert "Jonestown and brown stay" in new and new.endswith("Drive on.") and " von " in new
    mary, jones = new.split()[1:3]
    assert mary in pii.NAMES["f"] and jones in pii.NAMES["f"]
    assert f"{jones}'s friend {mary} called {jones.upper()}," in new and f"Dr. {jones}." in new
    assert pii.replace("Only Mrs. Jones.", b"k")[0] == f"Only Mrs. {jones}."              # the same in another document
    at, out = 0, []
    for e in found:
        out += [text[at:e["start"]], e["surrogate"]]
        at = e["end"]
    assert "".join([*out, text[at:]]) == new


def test_no_two_names_share_a_surrogate():
    names = ["".join(p) for n in (1, 2, 3) for p in itertools.product("abemz", repeat=n)] + ["m\u00fcller", "muller", "jones", "joness", "o\u00f1a"]
    names = [n for n in names if len(n) > 1]
    made = {pii.name_surrogate(n, g, b"k") for n in names for g in "fmn"}
    assert len(made) == 3 * len(names) and all(sum(n in pii.NAMES[g] for g in "fmn") == 1 for n in made)


def test_every_run_of_a_word_is_a_candidate_with_its_own_context(spark):
    keys = [f"{c}K7q2Zx9Lm4Tv8Rb1{c}" for c in "ABCDEFGHIJ"]
    rows = [(1, f'{{"access_key_id":"{keys[0]}","commit":"{keys[1]}","token":"{keys[2]}=="}} end'),
            (2, f"config.database-password:{keys[3]}"), (3, f"postgres://database-user:{keys[4]}@host.example.com/db"),
            (4, f"set api_key={keys[5]} now"), (5, f"secret_access_key_name={keys[6]}"), (6, f'token = "{keys[7]}"'),
            (7, f"mail someone_with_1_name@host.example.com,password={keys[8]}"), (8, "tooshort=abc123 , ;; {}"), (9, None)]
    got = secret_scan.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_value = {r["value"]: r for r in got}
    assert {r["value"] for r in got} == {*keys[:2], keys[2] + "==", *keys[3:9], "someone_with_1_name"}
    for k in (keys[0], keys[2] + "==", *keys[3:9]):
        r = by_value[k]
        assert (r["assigned"], r["named"], r["harmless"], r["other_shape"]) == (1, 1, 0, False), r
    assert by_value[keys[1]]["harmless"] == 1 and by_value[keys[1]]["named"] == 0
    assert by_value["someone_with_1_name"]["other_shape"]


def test_pipeline_links_near_duplicates_at_five_words_and_80_percent(spark):
    def pair(n, c):
        words = [f"{c}{k}" for k in range(n)]
        return " ".join(words), " ".join([*words[:20], "other", *words[21:]])
    near, far = pair(49, "a"), pair(48, "b")                     # 40 of 50 shingles are shared, 39 of 49
    docs = spark.createDataFrame(list(enumerate([*near, *far])), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 2, 3]
