import hashlib
import random
from pathlib import Path

import pytest

from aeroweave.llm import repeats


def slow(rows):
    """(bytes, removed, spans, hash) per row in (id, text) order, from all strings."""
    seen, out = set(), {}
    texts = sorted({((i is None, i or 0), (t or "").encode(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows},
                   key=lambda x: (x[0], x[2]))
    for key, data, digest in texts:
        gone = [False] * len(data)
        for p in range(len(data) - 99):
            if data[p:p + 100] in seen:
                gone[p:p + 100] = [True] * 100
            seen.add(data[p:p + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key, digest] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return sorted(out[(i is None, i or 0), hashlib.sha256((t or "").encode()).hexdigest()] for i, t in rows)


def corpus():
    random.seed(5)
    word = lambda: random.choice(["wind", "rain", "été", "of", "the", "sun", "cloud", "über", "storm", "a"])
    text = lambda n: " ".join(word() + str(random.randint(0, 9)) for _ in range(n))
    passages = [text(n) for n in (15, 25, 40, 90)]
    rows = []
    for i in range(40):
        parts = [text(random.randint(1, 40))]
        for _ in range(random.randint(0, 3)):
            passage = random.choice(passages)
            cut = random.randint(0, 60)
            parts += [passage[cut:] if random.random() < 0.5 else passage[:len(passage) - cut], text(random.randint(0, 20))]
        rows.append((i, random.choice(["", " "]).join(parts)))
    near = list(rows[3][1] * 2)
    near[150] = "#"
    rows += [(50, rows[3][1]), (51, "".join(near)), (52, "ab" * 400), (53, "z" * 350), (54, "xyz" * 60 + text(9)),
             (55, None), (56, ""), (57, "y" * 99), (58, "y" * 100), (59, "y" * 100), (60, "été" * 150)]
    return rows


@pytest.mark.parametrize("array_rows", [repeats.ARRAY_ROWS, 2])
def test_equals_brute_force(documents, array_rows):
    rows = corpus()
    found = repeats.dedup_substrings(documents([(i, t, "s") for i, t in rows]), array_rows=array_rows).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == slow(rows)
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)


def test_null_and_repeated_ids(documents):
    a, b = "first text " * 12 + "end", "second text " * 12
    rows = [(1, a), (1, b), (1, a), (None, a), (None, b + a), (0, "short")]
    found = repeats.dedup_substrings(documents([(i, t, "s") for i, t in rows])).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == slow(rows)


def test_empty_table(documents):
    assert repeats.dedup_substrings(documents([(1, "x", "s")]).limit(0)).count() == 0


def test_every_string_holds_a_sampled_gram_that_depends_on_it_alone():
    random.seed(8)
    shared = bytes(random.choice(b"abcd ") for _ in range(400))
    a, b = b"left side" * 9 + shared + b"x" * 150, shared + b"other end"
    at_a, at_b = (set(map(int, repeats.anchors(x)[1])) for x in (a, b))
    for p in range(301):
        in_a = {q - 81 for q in at_a if 81 + p <= q <= 81 + p + repeats.REACH}
        in_b = {q for q in at_b if p <= q <= p + repeats.REACH}
        assert in_a & in_b


def test_groups_hold_all_occurrences(spark):
    shared = "a passage that three documents share, long enough to be found, with more than a hundred bytes of text in it"
    rows = [(1, "x " + shared + "#one"), (2, "y " + shared + "!two"), (3, "z " + shared), (4, "nothing shared")]
    df = spark.createDataFrame([(i, i, t) for i, t in rows], "doc long, id long, text string")
    groups = {}
    for r in repeats.find_repeats(df).collect():
        groups.setdefault((r.gram, r.number), []).append((r.doc, r.first))
    assert groups and all(sorted(g) == [(1, True), (2, False), (3, False)] for g in groups.values())


def test_steps_leave_no_contexts_and_no_shuffles(spark, documents, monkeypatch):
    settings, tables, write = [spark.conf.get(name) for name in repeats._SPARING], {}, repeats.written
    monkeypatch.setattr(repeats, "written", lambda df, label: tables.setdefault(label, write(df, label)))
    passage = "a passage of well over a hundred bytes that many documents hold, with words enough around every gram, and so on " * 2
    rows = [(i, f"{i} {passage}" if i % 4 else passage) for i in range(60)]
    found = repeats.dedup_substrings(documents([(i, t, "s") for i, t in rows]).repartition(8), array_rows=4).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == slow(rows)
    assert set(tables) == {"grams", "contexts", "repeats"}
    assert not Path(tables["contexts"]._llm_path.removeprefix("file:")).exists()
    assert [spark.conf.get(name) for name in repeats._SPARING] == settings
    assert tables["grams"].filter("n > 4").count() > 0
    kept = tables["repeats"].filter("right is not null").count()
    assert 0 < kept < tables["repeats"].count() / 2  # a task hands on one of equal contexts
