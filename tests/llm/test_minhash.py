import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from mirrorset.llm import minhash
from mirrorset.llm.components import components
from mirrorset.llm.shingles import shingles, similarity


def grams(text, size=5):
    words = (text or "").encode().split()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def alike(x, y):
    """The greater of set and probability Jaccard similarity of two counters."""
    common, every = x.keys() & y.keys(), x.keys() | y.keys()
    if not common:
        return 0.0
    sets = len(common) / len(every)
    if max(x.values()) == max(y.values()) == 1 or sets >= 0.8:
        return sets
    return max(sets, sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in every) for i in common))


def brute(rows, threshold=0.8):
    """Class of each row by comparing all pairs of different texts."""
    texts = sorted({t or "" for _, t in rows})
    sets = [grams(t) for t in texts]
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if alike(sets[i], sets[j]) >= threshold - 1e-9:
                up[top(i)] = top(j)
    place = {t: top(i) for i, t in enumerate(texts)}
    least = defaultdict(list)
    for i, t in rows:
        least[place[t or ""]].append(i)
    return sorted(((i, min([x for x in least[place[t or ""]] if x is not None], default=None)) for i, t in rows), key=repr)


def corpus(seed, groups=12, near=8):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(8, 300))]
        for _ in range(near):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += texts[:5] + [None, "", " \n ", "one", "one", "two words", "a b c d", "a  b\nc d", "x " * 5000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("block", [128, 3])
def test_classes_as_brute_force(spark, make_documents, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", block)
    rows = corpus(block)
    got = minhash.near_duplicates(make_documents(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute(rows)
    kept = Counter(r.class_id for r in got if r.kept)
    assert set(kept) == {r.class_id for r in got} and set(kept.values()) == {1}
    assert all(r.doc_id == r.class_id for r in got if r.kept)


def test_a_star_of_edits_is_one_class(spark, make_documents):
    """Edits of one text that are near it but not near each other."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, "z y x w v u"), (500, " ".join(base))]
    for i in range(1, 60):
        copy = list(base)
        for at in rng.sample(range(10), 1) + [20 * rng.randrange(1, 9), 199 - rng.randrange(8)]:
            copy[at] = f"e{i}.{at}"
        rows.append((i, " ".join(copy)))
    got = minhash.near_duplicates(make_documents(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute(rows)


def test_lines_repeated_differently_often_do_not_hide_a_pair(spark, make_documents):
    """Near texts with a line that one repeats often and the other seldom: their sets are nearly the same."""
    rng = random.Random(4)
    rows = []
    for n, (few, many) in enumerate([(3, 60), (1, 30), (2, 200)] * 5):
        base = [f"t{n}.{i}" for i in range(300)]
        line = [f"l{n}.{i}" for i in range(8)]
        edited = list(base)
        edited[rng.randrange(300)] = "edited"
        rows += [(2 * n, " ".join(base + line * few)), (2 * n + 1, " ".join(edited + line * many))]
    got = minhash.near_duplicates(make_documents(rows)).collect()
    want = brute(rows)
    assert len({c for _, c in want}) == 15
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == want


def test_one_row_of_each_class_is_kept(spark, make_documents):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "other"), (None, None), (None, ""), (None, "")]
    given = make_documents(rows).selectExpr("*", "'x' AS k", "1 AS node", "2 AS bucket")
    kept = minhash.keep_one(given)
    assert kept.columns == given.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr) == [(1, "a b c d e f"), (2, "other"), (None, "")]
    assert minhash.keep_one(given.limit(0)).count() == 0
    assert minhash.near_duplicates(given.limit(0)).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    m = 4000
    element = np.arange(1, 61, dtype=np.uint64)
    left, right = rng.integers(1, 9, 60).astype(float), rng.integers(1, 9, 60).astype(float)
    right[40:] = 0
    used = right > 0
    kept = minhash.signatures(np.repeat([0, 1], [60, used.sum()]), np.concatenate((element, element[used])),
                              np.concatenate((left, right[used])), 2, m)
    exact = sum(1 / np.maximum(left / left[i], right / right[i]).sum() for i in range(40))
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.03


def test_shingles_and_similarity():
    texts = ["a b c d e f", "a b c d e", "a b", "", None, "  ", "é\tü  x y z z z z z z", "z z z z z z z z a", "z z z z z z q z z z z z"]
    owner, _, count = shingles(pa.array(texts), 5)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(grams(t)) for t in texts]
    assert count.sum() == sum(sum(grams(t).values()) for t in texts)
    pairs = [(a, b) for a in texts for b in texts]
    got = similarity(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]), 5)
    assert np.allclose(got, [alike(grams(a), grams(b)) for a, b in pairs])


@pytest.mark.parametrize("block", [128, 5])
def test_weights_link_what_sets_do_not(spark, make_documents, monkeypatch, block):
    """Texts of one much repeated line and a few other words, which differ: their sets are not alike, their weights are."""
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", block)
    rng = random.Random(11)
    rows = []
    for n in range(6):
        line = [f"l{n}.{i}" for i in range(9)]
        for i in range(5):
            rest = [f"r{n}.{i}.{j}" for j in range(rng.randint(4, 8))]
            rows.append((10 * n + i, " ".join(line * rng.randint(30, 33) + rest)))
    want = brute(rows)
    assert len({c for _, c in want}) == 6 and alike(grams(rows[0][1]), grams(rows[1][1])) > 0.8
    assert len(grams(rows[0][1]).keys() & grams(rows[1][1]).keys()) / len(grams(rows[0][1]).keys() | grams(rows[1][1]).keys()) < 0.8
    got = minhash.near_duplicates(make_documents(rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == want


def test_a_row_repeated_often_is_compared_once(spark, make_documents, monkeypatch):
    """Two near texts, one row each, repeated 400 times: one pair of texts is looked at."""
    seen = []
    plain = minhash._similar

    def watched(pairs, texts, *rest):
        seen.append((pairs.count(), texts.count()))
        return plain(pairs, texts, *rest)

    monkeypatch.setattr(minhash, "_similar", watched)
    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1]))] * 400
    got = minhash.near_duplicates(make_documents(rows).repartition(6)).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(1, 1), (2, 1)} and len(got) == 800
    assert seen == [(1, 2)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
