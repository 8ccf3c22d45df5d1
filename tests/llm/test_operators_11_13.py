"""Filter audit, conversation repair and sharding against brute force and their SQL, with edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from lading.llm import conversation_repair as cr
from lading.llm import filter_audit as fa
from lading.llm import sharding as sh
from lading.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0D]+")
SQL_QUERIES = sorted(ORACLE)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_sql(spark, name):
    from oracle.compare import compare, duck_connection
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck_connection(SF_SMALL).execute(ORACLE[name])
    msgs = compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall())
    assert not msgs, msgs


# --- operator 11 -----------------------------------------------------------
TEXTS = ["", " \t\n", "one", "Ünï çode wörds — wörds", "a b a b a b", "A#B $ % & * |", "x" * 70_000 + " " + "x" * 70_000 + " " + "x" * 69_999 + "y",
         "same same SAME same", "\x00a \x00a \x00", "日本 語 日本", "w " * 60, " ".join(f"Word{k}" for k in range(80))]


def test_transducer_and_table_match_plain_python():
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("aAé# \n日b") for _ in range(rng.randrange(200))) for _ in range(60)]
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = np.array(fa.measure(buf, off)).T.tolist()
    want = []
    for t in texts:
        words = WORD.findall(t)
        want.append([len(words), len(set(words)), sum("A" <= c <= "Z" for c in t), len(t), sum(c in "#$%&*|" for c in t)])
    assert got == want


def test_table_separates_words_of_one_hash(monkeypatch):
    monkeypatch.setattr(fa, "span_hashes", lambda buf, starts, ends, lower: np.zeros(len(starts), np.uint64))
    buf = np.frombuffer(b"ab cd ab abc abcdefghij abcdefghik abcdefghij", dtype=np.uint8)
    _, marks = fa.transduce(buf, np.array([0, len(buf)]))
    starts = np.flatnonzero(marks & fa.OPENS)
    ends = np.array([m.end() for m in WORD.finditer(buf.tobytes().decode())])
    assert fa.first_in_row(buf, starts, ends, np.zeros(len(starts), np.int64)).tolist() == [True, True, False, True, True, True, False]


def _audit(rows, labels):
    """Every order applied row by row."""
    marks = defaultdict(lambda: [False, False])
    for i, q, t in labels:
        marks[i][0] |= q == 1
        marks[i][1] |= t == 1
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    sets = []
    for i, text, part in rows:
        t = text or ""
        words = WORD.findall(t)
        f = {c for c, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and least[t] < i)) if bad}
        sets.append((part or "", f, marks[i] if i is not None else [False, False]))
    out, shapley = {}, defaultdict(int)
    for part in {p for p, _, _ in sets}:
        for order in permutations("ABCDE"):
            mine = [(f, m) for p, f, m in sets if p == part]
            for k, c in enumerate(order):
                before = set(order[:k])
                here = [(f, m) for f, m in mine if c in f and not f & before]
                out[part, "".join(order), k + 1] = [
                    sum(not f & (before | {c}) for f, _ in mine), len(here), sum(c in f and bool(f & before) for f, _ in mine),
                    sum(f == {c} for f, _ in mine), sum(m[0] for _, m in here), sum(m[1] for _, m in here)]
                shapley[part, c] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_matches_brute_force_with_nulls_ties_and_clashing_columns(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(TEXTS), rng.choice(["p", "q", "", None])) for i in range(60)]
    rows += [(None, "one", "p"), (None, None, None), (3, rows[3][1], "p"), (3, rows[3][1], "p"), (7, None, "q")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 50, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, source string, n int, bits string, digest string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in fa.audit(docs, marks, "source").collect()}
    assert got == _audit(rows, labels)
    assert fa.audit(docs.limit(0), marks, "source").count() == 0
    assert fa.audit(docs, marks.limit(0), "source").count() == len(got)


# --- operator 12 -----------------------------------------------------------
LEGAL = re.compile("(s?(ua)+)?")


def _cheapest(rows):
    """Cheapest (cost, audit, turns) of a short conversation by trying all edits."""
    best = [(10 ** 9, "", [])]
    faults, seen = [], set()
    for role, text in rows:
        words = re.sub("[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else
                      "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def go(k, cost, audit, turns, inserted):
        if cost > best[0][0]:
            return
        if k == len(rows):
            if LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
                best[0] = min(best[0], (cost, audit, turns))
        else:
            role, text = rows[k]
            go(k + 1, cost + 3, audit + "D", turns, 0)
            if faults[k] not in ("blank", "duplicate"):
                late = faults[k] == "truncated"
                go(k + 1, cost + late, audit + "K", [*turns, (role, text)], 0)
                for new in ("user", "assistant"):
                    go(k + 1, cost + 2 + late, audit + "R", [*turns, (new, text)], 0)
        if inserted < 2:
            for new in ("user", "assistant"):
                go(k, cost + 2, audit + "I", [*turns, (new, "")], inserted + 1)

    go(0, 0, "", [], 0)
    cost, audit, turns = best[0]
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(), faults


ROLE_CHOICES = ["user", "assistant", "system", "tool", "", "umpire", " "]


def _conversations(rng, n, most):
    return {c: [(rng.choice(ROLE_CHOICES[:3] if rng.random() < .8 else ROLE_CHOICES), rng.choice(["Fine.", "cut off", " ", "", "Yes!", "Ok? \n", f"t{rng.randrange(9)}."]))
                for _ in range(rng.randrange(most + 1))] for c in range(n)}


@pytest.mark.parametrize("block_bits", [14, 1])
def test_repair_matches_trying_all_edits(spark, monkeypatch, block_bits):
    monkeypatch.setattr(cr, "BLOCK_BITS", block_bits)          # 1: spans of two rows, joined as cells
    talks = _conversations(random.Random(block_bits), 60, 5)
    rows = [(c, t, role, text, "x", 5) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string, pos int")
    got = {r["conv_id"]: r for r in cr.repair(cr.undamaged(given)).collect()}
    assert set(got) == {c for c, turns in talks.items() if turns}
    for c, r in got.items():
        cost, audit, digest, faults = _cheapest(talks[c])
        initials = [role[:1] for role, _ in talks[c]]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, digest)
        assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = defaultdict(list)
    for r in cr.repaired_turns(cr.undamaged(given)).orderBy("conv_id", "place").collect():
        turns[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        assert r["place"] == len(turns[r["conv_id"]]) - 1
    for c, r in got.items():
        assert hashlib.sha256("\n".join(turns[c]).encode()).hexdigest() == r["repaired_sha256"]


def test_long_span_equals_any_split():
    rng = random.Random(2)
    codes = "".join(cr.code(rng.choice("sua-"), rng.choice(["fine", "blank", "duplicate", "truncated"])) for _ in range(3000))
    whole = cr.span_cell(codes)
    for cut in (1, 17, 1500, 2999):
        assert cr.join_cells(cr.span_cell(codes[:cut]), cr.span_cell(codes[cut:])) == whole
    cost, audit = cr.best(whole)
    assert len(audit.replace("I", "")) == 3000


def test_damage_and_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, cost int, fault string"
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["A. b! c?", "x", None]), 1, "f") for c in range(40) for t in [None, *range(4)]]
    rows += [(None, 0, "user", "Hm.", 1, "f"), (None, 1, "assistant", "Yes.", 1, "f"), (99, None, "user", "Hm.", 1, "f")]
    given = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: r for r in cr.repair(cr.damage(given)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        kept = []
        for c, t, role, text, *_ in rows:
            if c != conv:
                continue
            d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            text, role = " " if text is None else text, " " if role is None else role
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            kept += [(t, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).digest()))
        cost, audit, digest, faults = _cheapest([k[1:] for k in kept])
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, digest)
        turns = [t for t, _, _ in kept if t is not None]
        assert r["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
    assert cr.repair(cr.damage(given.limit(0))).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    only = spark.createDataFrame([(dropped, 0, "user", "Hi.", 1, "f")], schema)
    r = cr.repair(cr.damage(only)).first()
    assert (r["conv_id"], r["cost"], r["audit"], r["repaired_sha256"]) == (dropped, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_hot_conversation(spark):
    """A conversation that holds most rows is parsed in many spans."""
    n = 40_000
    given = spark.range(n).selectExpr("if(id < 30000, 7, id) as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                      "concat('t', id, '.') as text")
    r = cr.repair(cr.undamaged(given)).where("conv_id = 7").first()
    assert (r["cost"], r["audit"]) == (0, "K" * 30000)
    text = "\n".join(f"{'assistant' if k % 2 else 'user'}:t{k}." for k in range(30000))
    assert r["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- operator 13 -----------------------------------------------------------
def _check_shards(rows, texts, shards, tolerance=None):
    size = lambda t: len((t or "").encode()) + sh.ROW_BYTES
    total = sum(size(t) for _, t in texts)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is not None, i or 0, size(t), zlib.crc32((t or "").encode())) for i, t in texts)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    largest = max(size(t) for _, t in texts)
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    slack = 2 * max(largest, total // (shards * sh.WHOLE_GROUPS))
    for k in range(shards):
        assert abs(sum(r["size"] for r in by[k]) - total / shards) <= slack
    groups, where = defaultdict(int), defaultdict(set)
    for r in rows:
        groups[r["text_crc32"]] += r["size"]
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(where[g]) == 1 for g, n in groups.items() if n * shards * sh.WHOLE_GROUPS <= total)


def test_shards_with_hot_texts_nulls_and_repeats(spark):
    rng = random.Random(6)
    texts = [(k, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(300)))) for k in range(3000)]
    texts += [(5000 + k, "hot " * 30) for k in range(1500)]                # a third of all rows
    texts += [(None, None)] * 700 + [(8, "")] * 300 + [(9, "again")] * 50
    docs = spark.createDataFrame([(*t, "s", 1) for t in texts], "doc_id long, text string, shard string, size int")
    _check_shards(sh.assign(docs, 24).collect(), texts, 24)
    _check_shards(sh.assign(docs, 7).collect(), texts, 7)
    assert sh.assign(docs.limit(0), 24).count() == 0
    one = sh.assign(docs.limit(1), 24).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """Small rows that a size-weighted sample hardly meets are split by the second sample."""
    monkeypatch.setattr(sh, "RANGES_PER_SHARD", 4)
    tables = {}
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 200 = 0, repeat(md5(string(id)), 3000), '') as text")

    class Spy(sh.Materializer):
        def __call__(self, name, df):
            tables[name] = super().__call__(name, df)
            return tables[name]

    monkeypatch.setattr(sh, "Materializer", Spy)
    rows = sh.assign(docs, 4).collect()
    _check_shards(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 4)
    assert tables["fine"].count() > 0
    assert tables["ranges"].count() > tables["coarse"].count()


def test_equal_rows_are_placed_alike_for_any_partitioning(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "repeat(string(id % 300), 20) as text")
    keys = ("doc_id", "shard", "slot")
    a, b = (sorted(tuple(r[k] for k in keys) for r in sh.assign(docs.repartition(p), 24).collect()) for p in (3, 7))
    assert a == b


def test_written_shards_hold_all_columns_in_slot_order(spark, tmp_path):
    docs = spark.range(500).selectExpr("id as doc_id", "repeat(string(id), 10) as text", "'c' as record", "id * 2 as row")
    sh.write_shards(docs, str(tmp_path / "out"), 6)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.select("record.*").collect()) == sorted(docs.collect())
    placed = {r["doc_id"]: (r["shard"], r["slot"]) for r in sh.assign(docs, 6).collect()}
    assert {r["record"]["doc_id"]: (r["shard"], r["slot"]) for r in got.collect()} == placed
