import random

import corpus_pipeline
import xxhash
from pyspark.sql import functions as F

from aeroweave.llm import simhash
from aeroweave.llm.components import components


def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(numbers):
    root = {n: n for n in numbers}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in numbers:
        for b in numbers:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in numbers}


def test_fingerprint_follows_its_definition():
    random.seed(1)
    texts = ["", " \n", "one", "one TWO", "Één twee drie"] + [
        " ".join(random.choice("the of and Wind rain sun".split()) for _ in range(n)) for n in (3, 4, 50, 40_000)]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def links_as_groups(spark, numbers):
    signed = [n - (1 << 64) if n >> 63 else n for n in numbers]
    df = spark.createDataFrame([(n,) for n in signed], "fingerprint long")
    found = {r.node % (1 << 64): r.root for r in components(simhash.near_links(df)).collect()}
    groups = {}
    for n in numbers:
        groups.setdefault(found.get(n, n), set()).add(n)
    return {frozenset(g) for g in groups.values()}


def test_links_and_components_equal_brute_force_in_small_and_large_buckets(spark):
    random.seed(2)
    numbers = {random.getrandbits(64) for _ in range(60)}
    for n in list(numbers)[:20]:
        for k in (1, 2, 3):
            for bit in random.sample(range(64), k):
                n ^= 1 << bit
            numbers.add(n)
    centre = random.getrandbits(64)
    for _ in range(300):  # one dense group: more members of a bucket than pairs are made of
        n = centre
        for bit in random.sample(range(20, 40), random.randint(0, 6)):
            n ^= 1 << bit
        numbers.add(n)
    slow, expected = slow_components(sorted(numbers)), {}
    for n, r in slow.items():
        expected.setdefault(r, set()).add(n)
    assert links_as_groups(spark, sorted(numbers)) == {frozenset(g) for g in expected.values()}


def test_no_pair_within_the_distance_escapes_the_chains():
    ones = [1 << b for b in range(64)]
    for a in range(64):
        for b in range(a, 64):
            difference = ones[a] | ones[b]
            hits = 0
            for start in range(simhash.SEGMENTS):
                ok = all(
                    bin(difference & simhash.segment_masks(start, k) % (1 << 64)).count("1") <= k * 2 // simhash.SEGMENTS
                    for k in range(1, simhash.SEGMENTS + 1))
                hits += ok
            assert hits >= 1


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(6, 90)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(5, 90)} == {5}


def test_groups_on_nulls_copies_and_an_empty_table(spark, documents):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(3, text, "a"), (9, text, "b"), (4, text.upper(), "a"), (None, text, "a"), (7, None, "a"), (6, "", None), (8, "other text here", "a"),
            (8, "other text here", "a")]
    found = sorted(((r.id or -1, r.component) for r in simhash.near_groups(documents(rows)).collect()))
    assert found == [(-1, 3), (3, 3), (4, 3), (6, 6), (7, 6), (8, 8), (8, 8), (9, 3)]
    kept = simhash.keep_one(documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 8] and kept.columns == documents(rows).columns
    assert simhash.near_groups(documents(rows).filter(F.lit(False))).count() == 0
    assert simhash.keep_one(documents([(None, "a b c", "x"), (None, "a b c", "x")])).count() == 1


def test_one_document_of_each_group_stays_with_all_its_columns(spark, documents):
    random.seed(5)
    rows = []
    for i in range(12):
        words = [f"w{random.randrange(5000)}" for _ in range(3000)]
        rows.append((10 * i, " ".join(words), "a"))
        for k in range(1, 4):
            words[random.randrange(3000)] = f"new{k}"
            rows.append((10 * i + k, " ".join(words), "b"))
    rows += [(500, None, "a"), (501, " ", "a"), (502, "", None), (None, rows[0][1], "a"), (0, rows[0][1], "a")]
    prints = {i: slow_fingerprint(t or "") for i, t, _ in rows if i is not None}
    root = slow_components(sorted(set(prints.values())))
    least = {}
    for i, p in sorted(prints.items()):
        least.setdefault(root[p], i)
    kept = simhash.keep_one(documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values()) and kept.columns == documents(rows).columns
    assert len(least) < 40  # copies with few changes are found
    stage = corpus_pipeline.keep_one_of_each(spark, documents(rows), "")
    assert sorted(r.doc_id for r in stage.collect()) == sorted(least.values())
    assert simhash.keep_one(documents(rows).limit(0)).count() == 0
