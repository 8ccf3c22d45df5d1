"""Surrogates in other scripts and of untitled, prefixless and IPv6 forms;
token counts of long words and of unusual rows."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from lading.llm import pii, token_counts

KEY = b"k" * 32


def spans(text):
    new, found = pii.replace(text, KEY)
    return new, [(e["kind"], text[e["start"]:e["end"]], e["surrogate"]) for e in found]


def test_names_keep_their_script_and_stay_short():
    new, found = spans("Herr Иванов kam, und Иванов ging.")
    ivan = found[0][2].split()[1]
    assert found[0][0] == "name" and found[1][2] == ivan and "Иванов" not in new
    assert all("а" <= c.lower() <= "я" for c in ivan) and len(ivan) <= 3 * 6
    _, found = spans("Herr Παπαδόπουλος kam.")
    name = found[0][2].split()[1]
    assert all("α" <= c.lower() <= "ω" for c in name) and len(name) <= 3 * 12
    _, found = spans("Mr " + "A" + "b" * 300_000 + " left")
    assert len(found[0][2]) < 80


def test_name_surrogates_are_distinct_over_scripts_and_lengths():
    rng = random.Random(3)
    letters = ["abcdefghijklmnopqrstuvwxyz", "abcdeéüßñ", "αβγδεζηθό", "абвгдеёжз", "aбγ1"]
    names = {"".join(rng.choices(alphabet, k=rng.randint(2, 7))) for alphabet in letters for _ in range(2000)} | {"a" * 65, "a" * 66}
    names = {n.lower() for n in names}
    for gender in "fmn":
        assert len({pii.name_surrogate(n, gender, KEY) for n in names}) == len(names)


def test_salutations_need_a_full_name_and_keep_the_title():
    new, found = spans("Dear Customer, Dear Anna Schmidt, thank you. Schmidt")
    assert new.startswith("Dear Customer, Dear ") and [k for k, _, _ in found] == ["name", "name"] and "Schmidt" not in new
    assert spans("Dear Mrs. Mary Jones,")[0].startswith("Dear Mrs. ")


def test_numbers_without_a_country_prefix_and_ipv6():
    for text in ("030 1234567", "0151-23456789", "01 23 45 67 89"):
        new, found = spans(f"call {text} now")
        assert [(k, v) for k, v, _ in found] == [("phone", text)] and new != f"call {text} now"
        assert found[0][2][0] == "0" and len(found[0][2]) == len(text)
    for text in ("2001:db8::ff00:42:8329", "2001:0DB8:85A3:0000:0000:8A2E:0370:7334"):
        _, found = spans(f"from {text}.")
        assert [(k, v) for k, v, _ in found] == [("ip6", text)]
        assert [len(x) for x in found[0][2].split(":")] == [len(x) for x in text.split(":")]
        assert found[0][2].isupper() == text.isupper()
    assert spans("at 10:30:45, std::vector, a::b_c")[1] == []


def test_a_format_without_free_values_grows_and_stays_distinct():
    own = [f"{a}@{b}.de" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcde"] + [f"+1 20 {i:02}" for i in range(3)]
    _, found = spans(" ".join(own))
    made = [s for _, _, s in found]
    assert len(set(made)) == len(made) and not set(made) & set(own)
    hit = {"ab", "ba"}
    free = pii._free("ssn", "1", {str(d) for d in range(10)}, KEY)              # all ten are originals
    assert len(free) == 2 and free not in hit


def test_very_long_texts_take_linear_time():
    started = time.time()
    for text in ("a1" * 300_000, "5 " + "Mr " * 100_000, "x" * 200_000 + "@" + "y" * 200_000 + ".com"):
        pii.replace(text, KEY)
    assert time.time() - started < 20


def test_the_key_comes_from_the_session_or_is_drawn(spark):
    drawn = pii.key_of(spark)
    assert len(drawn) == 32 and drawn == pii.key_of(spark)
    spark.conf.set(pii.KEY_SETTING, "mine")
    try:
        assert pii.key_of(spark) != drawn
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_long_words_are_counted_as_short_ones():
    rng = random.Random(5)
    pieces = [token_counts.MARK, token_counts.MARK + b"a", b"a", b"b", b"ab", b"aab", b"abba", b"c" * 7, b"c"]
    automaton = token_counts.build(pieces)
    words = [bytes(rng.choices(b"abc", k=n)) for n in (1, 5, 255, 256, 257, 1000)] + [b"ab" * 400 + b"x", b"c" * 999]
    buf = np.frombuffer(b"".join(words), np.uint8)
    cut = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    got = token_counts.count_words(automaton, buf, cut[:-1], cut[1:])

    def greedy(word):
        rest, n, inner = token_counts.MARK + word, 0, {p for p in pieces if not p.startswith(token_counts.MARK)}
        while rest:
            known = set(pieces) if n == 0 else inner
            k = next((k for k in range(min(len(rest), 8), 0, -1) if rest[:k] in known), 0)
            if not k:
                return 1
            rest, n = rest[k:], n + 1
        return n
    assert got.tolist() == [greedy(w) for w in words]
    started = time.time()
    assert token_counts.count_long(automaton, np.frombuffer(b"ab" * 2_000_000, np.uint8)) > 1_000_000
    assert time.time() - started < 20


def test_token_counts_of_unusual_rows(spark):
    docs = spark.createDataFrame([(1, "the cat"), (1, "the cat"), (None, None), (2, ""), (3, " \t "), (4, "z" * 100_000)],
                                 "doc_id long, text string").withColumn("n_tokens", F.lit("x")).withColumn("row", F.lit(0))
    got = token_counts.token_counts(docs).select("row.doc_id", "row.n_tokens", "n_words", token_counts_column()).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append((r["n_words"], r["n"]))
    assert by_id[1][0] == by_id[1][1] and by_id[1][0][0] == 2
    assert by_id[None] == by_id[2] == by_id[3] == [(0, 0)] and by_id[4][0][0] == 1
    assert token_counts.token_counts(docs.where("false")).count() == 0


def token_counts_column():
    return F.col("n_tokens").alias("n")
