import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from mirrorset.llm import suffix_dedup
from mirrorset.llm.suffix_dedup import Options
from mirrorset.llm.suffixes import common_prefixes, smaller_than_next, two_stage_order


@pytest.mark.parametrize("seed", range(8))
def test_two_stage_order(seed):
    rng = random.Random(seed)
    letters = b"ab" if seed % 2 else b"a\x00\xffbcd"
    pieces = [bytes(rng.choice(letters) for _ in range(rng.randint(12, 60))) for _ in range(rng.randint(1, 30))]
    pieces += pieces[: len(pieces) // 2] + [b"a" * 40, b"\x00" * 30, b"\xff" * 30]
    depth = 12
    text = np.frombuffer(b"".join(pieces), np.uint8)
    starts = np.cumsum([0] + [len(p) for p in pieces[:-1]])
    counts = np.array([len(p) - depth + 1 for p in pieces])
    order = two_stage_order(text, starts, counts, depth)
    whole = text.tobytes()
    wanted = np.concatenate([np.arange(s, s + c) for s, c in zip(starts, counts)])
    assert sorted(order.tolist()) == sorted(wanted.tolist())
    found = [whole[i : i + depth] for i in order]
    assert found == sorted(found)
    common = common_prefixes(text, order, depth)
    for c, a, b in zip(common, found, found[1:]):
        assert c == next((i for i in range(depth) if a[i] != b[i]), depth)


def test_types_of_suffixes():
    text = b"mississippi\x00\xff\xffaab"
    rising = smaller_than_next(np.frombuffer(text, np.uint8))
    assert rising.tolist() == [text[i:] < text[i + 1 :] for i in range(len(text))]


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + width] for t in texts for p in range(len(t) - width + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        covered = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - width + 1):
            if seen[t[p : p + width]] > 1:
                covered[p : p + width] = True
        kept = bytes(b for b, c in zip(t, covered) if not c)
        spans = int((np.diff(covered.astype(int)) == -1).sum())
        out.append((i, len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "naïve", "ab", "of", "日本", "xyz", "q", "lorem", "ipsum", "aaaa"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(n))
    passages = [say(rng.randint(3, 25)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [say(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(passages), say(rng.randint(0, 20))]
        rows.append((i, " ".join(parts)))
    rows += [(200 + i, "hot line number one " + say(4)) for i in range(60)]
    rows += [(300 + i, t) for i, (_, t) in enumerate(rows[:8])] + [rows[3], rows[3]]
    rows += [(400, None), (401, ""), (402, "short"), (None, passages[0]), (None, passages[1]), (403, "a" * 3000), (404, "xyxy" * 200)]
    rows += [(405, say(4000)), (3, "other text under a used id " + passages[2])]
    return rows


@pytest.mark.parametrize(
    "options",
    [
        Options(width=24, gram=9),
        Options(width=24, gram=24, flush=2000, sort=500, piece=1000),
        Options(width=24, gram=9, flush=2000, sort=500, piece=1000, sent=2, sorted_=3),
        Options(width=24, gram=12, sent=1, sorted_=0),
        Options(width=24, gram=9, flush=2000, met=10),
    ],
)
def test_report_as_brute_force(spark, make_documents, options):
    rows = corpus(options.gram)
    got = suffix_dedup.removal_report(make_documents(rows).repartition(5), options).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, options.width)


def test_default_width_on_the_test_table(spark, sf, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = suffix_dedup.removal_report(documents).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 200)


def test_texts_without_repeats(spark, make_documents):
    options = Options(width=10, gram=4)
    rows = [(1, "0123456789abé"), (2, "x0123456789y"), (3, None), (3, None), (4, "clean text")]
    given = make_documents(rows).selectExpr("*", "1 AS id", "'t' AS tag", "2 AS start", "'m' AS marks")
    kept = suffix_dedup.remove_repeats(given, options)
    assert kept.columns == given.columns
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in kept.collect()), key=repr) == [
        (1, "abé", 3), (2, "xy", 2), (3, None, None), (3, None, None), (4, "clean text", 10)]
    assert suffix_dedup.remove_repeats(given.limit(0), options).count() == 0
    assert suffix_dedup.removal_report(given.limit(0), options).count() == 0


def same_checksum(text, seed):
    """A text of 64 letters that, behind ``seed``, has the CRC-32 of ``text``: the checksum is linear in the bits."""
    base, size = seed + "a" * 64, 64
    start = zlib.crc32(base.encode())
    wanted, rows = start ^ zlib.crc32(text.encode()), []
    for i in range(size):
        toggled = seed + "a" * i + "c" + "a" * (size - i - 1)
        rows.append((zlib.crc32(toggled.encode()) ^ start, 1 << i))
    basis = {}
    for effect, chosen in rows:
        while effect and effect.bit_length() in basis:
            other, more = basis[effect.bit_length()]
            effect, chosen = effect ^ other, chosen ^ more
        if effect:
            basis[effect.bit_length()] = (effect, chosen)
    picked = 0
    while wanted:
        effect, chosen = basis[wanted.bit_length()]
        wanted, picked = wanted ^ effect, picked ^ chosen
    return seed + "".join("c" if picked >> i & 1 else "a" for i in range(size))


@pytest.mark.parametrize("number", [7, None])
def test_equal_checksums_under_one_id(make_documents, number):
    rng = random.Random(3)
    line = lambda: "".join(rng.choices("klmnopqr ", k=300))
    first, other = line(), line()
    twin = same_checksum(first, other)
    assert zlib.crc32(first.encode()) == zlib.crc32(twin.encode())
    rows = [(number, first), (number, twin), (8, "x" + first[:260])]
    got = suffix_dedup.removal_report(make_documents(rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 200)
    assert [r.n_removed for r in got if r.n_bytes == len(twin)] == [0]


def thue_morse(n, letters):
    word = letters[0]
    while len(word) < n:
        word += "".join(letters[1 - letters.index(c)] for c in word)
    return word


def test_strings_with_equal_polynomial_hashes(make_documents):
    rows = [(i, side + thue_morse(4096, letters) + side) for i, (letters, side) in enumerate([("ab", "x"), ("ba", "y"), ("xy", "z")])]
    for options in (Options(width=1024, gram=600), Options(width=2048, gram=1100, sent=1, sorted_=0)):
        got = suffix_dedup.removal_report(make_documents(rows), options).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, options.width)


def test_marks_of_a_repeated_row_are_linear(spark, make_documents):
    """A row repeated 5,000 times has as many marks as one repeated twice, and each copy is cut."""
    rng = random.Random(6)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(300))
    near = text[:700] + " changed " + text[700:]
    counts = []
    for copies in (2, 5_000):
        rows = [(1, text)] * copies + [(2, near), (3, "short")]
        df = make_documents(rows).repartition(11)
        marks = suffix_dedup._grouped(suffix_dedup.repeated_runs(df)).selectExpr("sum(size(marks)) AS n").first().n
        got = suffix_dedup.removal_report(df).collect()
        assert Counter(tuple(r) for r in got) == Counter(brute([(1, text)] * 2 + rows[copies:], 200)[:1] * (copies - 2) + brute([(1, text)] * 2 + rows[copies:], 200))
        counts.append(marks)
    assert counts[1] <= counts[0] + 50
