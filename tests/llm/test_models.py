import math
import random
import zlib
from collections import Counter

import numpy as np

from aeroweave.llm import decontaminate, gam, gru, language_model

# Decontamination


def slow_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def damaged(text, edits, rng):
    chars = list(text)
    for _ in range(edits):
        i = rng.randrange(len(chars))
        kind = rng.random()
        if kind < 0.4:
            chars[i] = rng.choice("qxz")
        elif kind < 0.7:
            del chars[i]
        else:
            chars.insert(i, rng.choice("qxz"))
    return "".join(chars)


def test_short_items_are_found_as_whole_words():
    ready = decontaminate.Items([(1, "Short one"), (2, "short  ONE"), (3, "a"), (4, "x y z"), (5, ""), (6, None), (7, "twenty four characters ok")])
    found = ready.matches("This SHORT\n one is a short one, b a")
    assert sorted(found) == [(1, 0, 5, 14), (2, 0, 5, 14), (3, 0, 18, 19)]
    assert ready.matches("shortone x y zz") == [] and ready.matches("x y z") == [(4, 0, 0, 5)] and ready.matches(None) == []


def test_leaks_equal_brute_force_edit_distances():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(6, 40))) for i in range(12)] + [(90, "short"), (91, None), (92, "")]
    ready = decontaminate.Items(items)
    caught = 0
    for case in range(90):
        item = rng.choice(items[:12])[1]
        allowed = int(0.08 * len(decontaminate.plain(item)))
        doc = text(rng.randint(0, 30)) + " " + damaged(item, rng.randint(0, allowed + 4), rng).upper() + "\n " + text(rng.randint(0, 30))
        found = {i: cost for i, cost, _, _ in ready.matches(doc)}
        for k, (item_id, content) in enumerate(items[:12]):
            if len(decontaminate.plain(content)) < decontaminate.MIN_CHARS:
                continue
            cost = slow_edits(decontaminate.plain(content), decontaminate.plain(doc))
            budget = ready.edits[ready.ids.index(item_id)]
            assert found.get(item_id) == (cost if cost <= budget else None)
            caught += cost <= budget
    assert caught > 40


def test_leaks_of_tables_in_blocks(spark, documents, monkeypatch):
    passage = "this passage of the benchmark is long enough to be told from chance, and has words"
    rows = [(1, "before " + passage + " after", "a"), (2, "nothing of it here", "a"), (3, None, "a"), (4, "", "a"), (None, passage.upper(), "a"),
            (5, passage[:40], "a"), (6, ("x" * 99 + " ") * 2000 + passage.replace("chance", "chances"), "a"), (1, passage, "b")]
    bench = spark.createDataFrame([(7, passage, "c"), (8, None, "c"), (9, "tiny", "c"), (10, passage, "c")], "item_id long, text string, doc_id string")
    for block in (10**6, 50):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
        found = decontaminate.find_leaks(documents(rows), bench).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.edits) for r in found) == sorted(
            (d, i, 1 if d == 6 else 0) for d in (0, 1, 1, 6) for i in (7, 10))
        clean = decontaminate.drop_leaks(documents(rows), bench)
        assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 5] and clean.columns == documents(rows).columns
    assert decontaminate.find_leaks(documents(rows).limit(0), bench).count() == 0
    assert decontaminate.find_leaks(documents(rows), bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(documents(rows), bench.limit(0)).count() == len(rows)


# Quality classifier

def test_additive_model_learns_shapes_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 4))
    y = ((np.abs(x[:, 0]) > 0.8) ^ False) * 2.0 + 3.0 * (x[:, 1] * x[:, 2] > 0) - 2.5
    labels = (rng.random(6000) < 1 / (1 + np.exp(-2 * y))).astype(float)
    model = gam.fit(x[:5000], labels[:5000])
    predicted = model.score(x[5000:]) > 0.5
    assert (predicted == (y[5000:] > 0)).mean() > 0.93
    assert (1, 2) in model.pairs
    one = model.score(x[:1])[0]
    added = model.start + sum(t[np.searchsorted(e, v, "right")] for e, t, v in zip(model.edges, model.tables, x[0]))
    added += sum(t[np.searchsorted(model.pair_edges[a], x[0, a], "right"), np.searchsorted(model.pair_edges[b], x[0, b], "right")]
                 for (a, b), t in zip(model.pairs, model.pair_tables))
    assert math.isclose(one, 1 / (1 + math.exp(-added)))


def test_scores_of_odd_tables(spark, documents):
    good, bad = "some calm words that follow each other in a line of text.", "###*** BUY!! BUY!! BUY!! $$$ BUY!! BUY!! %%%"
    rows = [(i, (good if i % 3 else bad) + f" {i}", "s") for i in range(400)] + [(900, None, "s"), (901, "", None), (None, good, "s"), (902, bad * 5000, "s")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(5, None, 0), (None, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    found = gam.score_quality(documents(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in held if r.doc_id < 400)
    assert {r.score for r in gam.score_quality(documents(rows), labels.limit(0)).collect()} == {0.5}
    assert gam.score_quality(documents(rows).limit(0), labels).count() == 0


# Language model

def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    params = {k: v.astype(np.float64) for k, v in gru.initial(np.ones(200), 30.0).items()}
    params = {k: v + rng.normal(0, 0.1, v.shape) for k, v in params.items()}
    inputs, targets = rng.integers(0, 200, (5, 3)), rng.integers(0, 200, (5, 3))
    targets[1, 1], targets[4, 2], targets[0, 0] = -1, gru.RARE, gru.RARE
    fresh = np.zeros((5, 3), bool)
    fresh[2, 0] = True
    state = rng.normal(size=(3, gru.WIDTH))

    def loss(p):
        states, _, _ = gru.forward(p, inputs, fresh, state)
        valid = targets >= 0
        return -gru.log_probability(p, states[valid].astype(np.float64), targets[valid]).mean()

    grad, _ = gru.gradients(params, inputs, targets, fresh, state)
    for name in params:
        direction = rng.normal(size=params[name].shape)
        step = 1e-3
        up, down = ({**params, name: params[name] + s * step * direction} for s in (1, -1))
        slope = (loss(up) - loss(down)) / (2 * step)
        assert math.isclose(slope, float((grad[name] * direction).sum()), rel_tol=0.02, abs_tol=2e-3)


def test_probabilities_sum_to_one_and_state_crosses_windows():
    rng = np.random.default_rng(2)
    params = gru.initial(rng.integers(1, 50, gru.HEAD), 500.0)
    states = rng.normal(size=(1, gru.WIDTH)).astype(np.float32).repeat(gru.HEAD + 1, 0)
    assert abs(np.exp(gru.log_probability(params, states, np.arange(gru.HEAD + 1))).sum() - 1) < 1e-3
    docs = [rng.integers(0, gru.HEAD + 1, n).astype(np.int32) for n in (1, 5, 100, 3000, 17, 64, 65)]
    together, alone = gru.score(params, docs), [gru.score(params, [d])[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-4)
    plain = []
    for d in docs:
        inputs = np.r_[gru.START, d[:-1]][:, None]
        fresh = np.zeros(inputs.shape, bool)
        fresh[0] = True
        whole, _, _ = gru.forward(params, inputs, fresh, np.zeros((1, gru.WIDTH), np.float32))
        plain.append(gru.log_probability(params, whole[:, 0], d).sum(dtype=float))
    assert np.allclose(together, plain, rtol=1e-4)


def test_words_past_the_first_two_thousand_follow_their_context():
    docs = [np.array([3000 + 2 * (k % 8), 3001 + 2 * (k % 8)] * 8, np.int32) for k in range(400)]
    start = gru.initial(np.full(4000, 10.0), 1.0)
    trainer = gru.Trainer(start)
    for _ in range(60):
        trainer.learn(docs)
    assert gru.score(trainer.params, docs[:8]).mean() > 0.6 * gru.score(start, docs[:8]).mean()
    number = np.array([2047, 2048, 4095, 4096, 9999, -1])
    assert language_model._head(number).tolist() == [2047, 2048, 4095, gru.RARE, gru.RARE, gru.RARE]


def slow_base(rows):
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t, _ in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = Counter(w for i, words in tokens.items() if not held[i] for w in words)
    n, v = sum(counts.values()), len(counts)
    return {i: (held[i], len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for i, w in tokens.items()}


def test_scores_of_texts(documents):
    rng = random.Random(6)
    follow = {w: [rng.choice("abcdefghij") + str(k) for k in range(3)] for w in "abcdefghij"}
    rows = []
    for i in range(900):
        word, text = rng.choice("abcdefghij"), []
        for _ in range(rng.randint(5, 120)):
            nxt = rng.choice(follow[word])
            text.append(nxt)
            word = nxt[0]
        rows.append((i, " ".join(text) + (f" Unique{i}" if i % 5 == 0 else ""), "s"))
    rows += [(2000, None, "s"), (2001, "", None), (None, "A1 b1 New", "s"), (2002, "a1 " * 30_000, "s")]
    for held_words in (language_model.HELD_WORDS, 10):
        found = {r.doc_id: r for r in language_model.score_texts(documents(rows), held_words=held_words, rounds=3).collect()}
        expected = slow_base(rows)
        assert found.keys() == expected.keys()
        for i, (held, n, known, tokens, base) in expected.items():
            r = found[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, tokens)
            assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in language_model.score_texts(documents(rows), rounds=3).collect() if r.held_out and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the order of words is learnt
    assert language_model.score_texts(documents(rows).limit(0)).count() == 0


def test_scores_do_not_depend_on_partitions(documents, monkeypatch):
    monkeypatch.setattr(language_model, "SHARE_WORDS", 2_000)
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randint(1, 60))), "s") for i in range(400)]
    first, second = ({r.doc_id: r.score for r in language_model.score_texts(documents(rows).repartition(n)).collect()} for n in (1, 7))
    assert language_model.shares_of(12_000) == 3 and first.keys() == second.keys()
    assert all(math.isclose(first[i], second[i], rel_tol=1e-4) for i in first)


def test_frequent_words_never_exceed_their_number(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 5) for i in range(3000)] + [(b"top", 900), (b"next", 800)], "word binary, n long")
    some = [bytes(r.word) for r in language_model.frequent_words(counts, 1000).collect()]
    assert 600 < len(some) <= 1000 and {b"top", b"next"} <= set(some)
    assert language_model.frequent_words(counts, 10_000).count() == 3002
