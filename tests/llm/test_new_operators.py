"""Source divergence, conversation repair and exact top-k against straight readings of their rules."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import floor

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aeroweave.llm import conversations, divergence, topk

# Source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def slow_audit(rows, min_docs, listed):
    counts, holding, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        group = lang or "", source or ""
        groups.add(group)
        counts[group].update(terms_of(text))
        holding[group[0]].update(set(terms_of(text)))
    found = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holding[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        totals = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        share = lambda n, total: 1 + 10**9 * (n + 5) // (total + 5 * len(kept))
        p = {s: {t: share(counts[lang, s][t], totals[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(totals.values())) for t in kept}
        for s in sources:
            apart = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            more = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(apart)), ("term", sorted(more)[:listed])):
                found += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(found)


@pytest.fixture
def texts(spark):
    def make(rows):
        full = [(i, t, lang, s, "clash", 1, 2, 3, 4) for i, (t, lang, s) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, term string, n long, docs long, p long, base long")
    return make


def test_audit_equals_a_straight_count(texts, monkeypatch):
    rng = random.Random(4)
    words = [f"{'Éß木x'[i % 4]}{'abCdefgh' * (i % 3)}{chr(97 + i)}" for i in range(25)]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(30))) + rng.choice([".", "7x", "_y~Z"]), rng.choice(["en", "de", None]),
             rng.choice(["a", "b", "c", "é", "", None])) for _ in range(160)]
    rows += [(None, "en", "empty"), ("", "xx", "only"), ("!!", "xx", "other"), ("lone", "yy", "single")] + [("hot hot cold", "en", "a")] * 40
    want = slow_audit(rows, 5, 7)
    got = divergence.audit_sources(texts(rows), min_docs=5, listed=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[2] == "term" for r in want) and ("xx", "only", "pair", "other", 0, 1) in want
    # many slices and blocks give the same
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 3)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    assert sorted(map(tuple, divergence.audit_sources(texts(rows), min_docs=5, listed=7).collect())) == want


def test_audit_of_nothing_and_of_a_very_long_text(texts):
    assert divergence.audit_sources(texts([]).limit(0)).collect() == []
    long = "word " * 400_000 + "x" * 300_000
    got = {r["term"]: (r["n"], r["docs"]) for r in divergence.count_terms(texts([(long, "en", "a"), (long, "en", "a")])).collect()}
    assert got == {"word": (800_000, 2), "x" * 300_000: (2, 2)}


def test_pointers_sort_like_bytes_and_stay_stable():
    rng = random.Random(1)
    for _ in range(50):
        docs = ["".join(rng.choice("abAé木 .") * rng.choice([1, 1, 1, 9]) for _ in range(rng.randrange(40))).encode() for _ in range(6)]
        data = np.frombuffer(b"".join(docs), np.uint8)
        offsets = np.cumsum([0, *map(len, docs)])
        starts, lengths, of = divergence.term_pointers(data, offsets)
        words = [bytes(data[s:s + n]) for s, n in zip(starts, lengths)]
        assert [(i, w.encode()) for i, d in enumerate(docs) for w in TERM.findall(d.decode())] == list(zip(of, words))
        order, new = divergence.sort_pointers(data, starts, lengths)
        assert list(order) == sorted(range(len(words)), key=lambda i: (words[i], i))
        assert list(new) == [i == 0 or words[order[i]] != words[order[i - 1]] for i in range(len(order))]


def test_slices_of_a_shard_do_not_change_counts(texts, monkeypatch):
    rows = [(f"a b{i % 3} c", "en", f"s{i % 4}") for i in range(50)]
    whole = sorted(map(tuple, divergence.count_terms(texts(rows)).collect()))
    monkeypatch.setattr(divergence, "SLICE_BYTES", 16)
    assert sorted(map(tuple, divergence.count_terms(texts(rows)).collect())) == whole


# Conversation repair

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def with_inserts(ways):
    """States and their least (cost, audit, lines), with rows put in where that is cheaper."""
    todo = list(ways)
    while todo:
        state = todo.pop()
        cost, audit, lines = ways[state]
        initial = "a" if state == "u" else "u"
        to, way = NEXT[state, initial], (cost + 5, audit + "I", (*lines, f"{NAMES[initial]}:"))
        if to not in ways or way[:2] < ways[to][:2]:
            ways[to] = way
            todo.append(to)
    return ways


def slow_repair(rows, damage):
    """By conversation, one row after the other over all states."""
    found = {}
    for conv in {r[0] for r in rows}:
        present = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            spoil = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else None
            text = "" if spoil == 1 else re.sub("[.!?]", "", text) if spoil == 2 else text
            present += [(turn, "user" if spoil == 4 else role, text)] * {0: 0, 3: 2}.get(spoil, 1)
        present.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = {r[0] for r in present} - {None}
        faults, seen, ways = [], set(), with_inserts({"": (0, "", ())})
        for _, role, text in present:
            ink = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            after = {}
            for state, (cost, audit, lines) in ways.items():
                options = [(state, cost + 2, "D", lines)]
                if fault not in ("blank", "duplicate"):
                    cost += 5 * (fault == "truncated")
                    initial = "a" if state == "u" else "u"
                    options.append((NEXT[state, initial], cost + 1, "R", (*lines, f"{NAMES[initial]}:{text}")))
                    if (state, role[:1]) in NEXT:
                        options.append((NEXT[state, role[:1]], cost, "K", (*lines, f"{role}:{text}")))
                for to, spent, edit, left in options:
                    if to not in after or (spent, audit + edit) < after[to][:2]:
                        after[to] = (spent, audit + edit, left)
            ways = with_inserts(after)
        cost, audit, lines = min(ways[s] for s in ("", "a") if s in ways) if present else (0, "", ())
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(present, present[1:])]
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def talk(spark, rows):
    return spark.createDataFrame(
        [(*r, "clash", "clash", 7, 8) for r in rows],
        "conv_id long, turn long, role string, text string, audit string, digest string, n long, part long")


def some_rows(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "Why?", "cut", "cut of", " ", "", None, "a\n b.\t", "Ende…", "ok.\x0b"]
    return [(conv, rng.choice([t, t, t, t, t + 3, None]), rng.choice(roles) if rng.random() < 0.5 else ["user", "assistant"][t % 2],
             rng.choice(texts) if rng.random() < 0.5 else f"text {conv} {t}.")
            for conv in [*range(convs), None] for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("damage", [False, True])
def test_repair_equals_a_row_by_row_solution(spark, damage):
    rows = some_rows(3, 60, 9) + some_rows(5, 3, 150)
    want = slow_repair(rows, damage)
    got = {r[0]: tuple(r)[1:] for r in conversations.audit(talk(spark, rows), damage).collect()}
    assert got == want
    lines = defaultdict(list)
    for r in conversations.repair(talk(spark, rows), damage).orderBy("conv_id", "place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_a_conversation_longer_than_a_partition_and_many_equal_rows(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"t{t}.") for t in range(700)] + [(2, 0, "user", "same.")] * 500
    want = slow_repair(rows, False)
    assert {r[0]: tuple(r)[1:] for r in conversations.audit(talk(spark, rows)).collect()} == want
    assert want[2][2] == 499


def test_repair_of_dropped_conversations_long_texts_and_an_empty_table(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    got = conversations.audit(talk(spark, [(dropped, 0, "user", "x.")]), damage=True).collect()
    assert [tuple(r) for r in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert conversations.audit(talk(spark, [(1, 1, "u", "x")]).limit(0)).collect() == []
    assert conversations.repair(talk(spark, [(1, 1, "u", "x")]).limit(0)).collect() == []
    long = "word " * 300_000 + "."
    row = conversations.audit(talk(spark, [(1, 0, "user", long), (1, 1, "assistant", long)])).first()
    assert row.audit == "KK" and row.repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()


def test_branch_and_bound_proves_the_optimum():
    rng = random.Random(2)
    for _ in range(300):
        codes = "".join(rng.choice("uauauauasoUASOxx") for _ in range(rng.randrange(14)))
        names = {s: n for s, n in zip(conversations.STATES, ("", "s", "u", "a"))}
        for start in conversations.STATES:
            ways = with_inserts({names[start]: (0, "", ())})
            for code in codes:
                after = {}
                for state, (cost, audit, _) in ways.items():
                    worn = 5 * (code in "USAO")
                    initial = "a" if state == "u" else "u"
                    options = [(state, cost + 2, "D")]
                    if code != "x":
                        options.append((NEXT[state, initial], cost + 1 + worn, "R"))
                        if (state, code.lower()) in NEXT:
                            options.append((NEXT[state, code.lower()], cost + worn, "K"))
                    for to, spent, edit in options:
                        if to not in after or (spent, audit + edit) < after[to][:2]:
                            after[to] = (spent, audit + edit, ())
                ways = with_inserts(after)
            for end in conversations.STATES:
                found = conversations.cheapest(codes, start, end)
                assert found == (ways[names[end]][:2] if names[end] in ways else None), (codes, start, end)


# Exact top-k

def slow_top(rows, is_query, k):
    known = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in known), default=0)
    units = [[floor(64 * x) for x in v] + [0] * (width - len(v)) for _, v in known]
    found = []
    for q, (query, _) in enumerate(known):
        if query is not None and is_query(query):
            scored = [(-sum(a * b for a, b in zip(units[q], units[c])), i is None, i or 0, i) for c, (i, _) in enumerate(known) if c != q]
            found += [(query, r + 1, s[3], int(-s[0])) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(found, key=repr)


def embedded(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(i, v, "clash", 1, 2, True, 5, 6) for i, v in rows],
        f"vec_id long, embedding array<{kind}>, row string, id long, low long, is_query boolean, units long, score long")


@pytest.mark.parametrize("scale_of", [0.2, 300.0, 4e6], ids=["float", "double", "whole"])
def test_top_scores_equal_brute_force(spark, scale_of):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(0, scale_of, 6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(90)]  # a hot vector, a third of all ties
    rows += [(20, rows[20][1]), (None, rows[3][1]), (None, rows[20][1]), (2000, None), (2001, [1.0, None]), (2002, [float("nan")]),
             (2003, [float("inf")]), (2020, []), (2021, [1.0])]
    got = topk.top_k(embedded(spark, rows, "double"), F.col("vec_id") % 20 == 0, k=20)
    assert got.columns == ["query", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == slow_top(rows, lambda i: i % 20 == 0, 20)


def test_cells_of_any_size_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(200)]
    want = slow_top(rows, lambda i: i % 20 == 0, 5)
    monkeypatch.setattr(topk, "CELL_NUMBERS", 40)
    got = topk.top_k(embedded(spark, rows), F.col("vec_id") % 20 == 0, k=5)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_tiles_of_any_size_give_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    make = lambda n, begin: pa.table({
        "row": np.arange(begin, begin + n), "id": rng.integers(0, 50, n), "units": pa.array(rng.integers(-3, 4, (n, 5)).tolist(), pa.list_(pa.int32())),
        "low": np.full(n, -45), "need": np.full(n, 4)})
    left, right = make(40, 0), make(30, 25)
    whole = [f(left, right) for f in (topk._histograms(5, "float32", 0), topk._hits(5, "float32"))]
    monkeypatch.setattr(topk, "_TILE", (7, 6))
    cut = [f(left, right) for f in (topk._histograms(5, "float32", 0), topk._hits(5, "float32"))]
    for a, b in zip(whole, cut):
        assert a.num_rows and sorted(a.to_pylist(), key=repr) == sorted(b.to_pylist(), key=repr)


def test_top_scores_of_few_or_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None)]
    got = topk.top_k(embedded(spark, rows), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 64 * 32 + 128 * 32)]
    for few in (rows[:1], rows[2:], rows[1:]):
        assert topk.top_k(embedded(spark, few), F.col("vec_id") % 20 == 0).collect() == []
    assert topk.top_k(embedded(spark, rows).limit(0), F.col("vec_id") % 20 == 0).collect() == []
    with pytest.raises(ValueError, match="long"):
        topk.top_k(embedded(spark, [(0, [1e30]), (1, [1e30])], "double"), F.col("vec_id") % 20 == 0)
