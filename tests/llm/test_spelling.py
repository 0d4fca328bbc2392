"""Spelling variants against all pairs of words, and their odd rows."""

import random
import zlib
from collections import Counter

import pytest
import regex

from aisleflow.llm import spelling

SCHEMA = "doc_id BIGINT, text STRING, word STRING, n STRING, key STRING, choice STRING, label STRING"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "w", "n", "k", "c", "l") for i, t in rows], SCHEMA)


def some_words(seed, alphabet, n):
    own = random.Random(seed)
    found = {"".join(own.choice(alphabet) for _ in range(own.randint(7, 9))) for _ in range(n)}
    for word in sorted(found):
        for _ in range(6):
            k, kind, c = own.randrange(len(word)), own.randrange(3), own.choice(alphabet + "z")
            found.add(word[:k] + (c if kind != 1 else "") + word[k + (kind != 2) :])
    return sorted(w for w in found if len(w) >= 7)


def brute_force(counts):
    near = {a: [b for b in counts if spelling.one_edit_apart(a, b)] for a in counts}
    form, rows = {}, []
    for a, others in near.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best and counts[best] >= 10 * counts[a] else None
    for a in counts:
        root = a
        while form[root]:
            root = form[root]
        rows.append((a, form[a], root, counts[a], len(near[a]), counts[form[a]] if form[a] else None))
    return sorted(rows)


def test_one_edit():
    close = [("abc", "abd"), ("abc", "ab"), ("abc", "xabc"), ("aab", "ab"), ("é", "è")]
    apart = [("abc", "abc"), ("abc", "acb"), ("abc", "a"), ("ab", "ba"), ("abcd", "abdce")]
    assert all(spelling.one_edit_apart(a, b) and spelling.one_edit_apart(b, a) for a, b in close)
    assert not any(spelling.one_edit_apart(a, b) or spelling.one_edit_apart(b, a) for a, b in apart)


@pytest.mark.parametrize("block", [None, 30])
def test_variants_equal_all_pairs(spark, block):
    """Whole blocks, and blocks dealt out in cells; ties of counts, words wider than the padding and beyond it."""
    own = random.Random(4)
    words = some_words(1, "abcdé", 120) + ["x" * 300, "x" * 301, "x" * 100 + "y" + "x" * 199, "q" * 47, "q" * 48, "q" * 49]
    counts = {w: own.choice([2, 3, 20, 20, 300, 4000]) for w in words}
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"), block=block)
    assert sorted(map(tuple, found.collect())) == brute_force(counts)


def test_long_chains_end_at_their_root(spark):
    chain = ["a" * (7 + k) for k in range(7)]
    counts = {w: 2 * 10**k for k, w in enumerate(chain)}
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert {r.word: r.root for r in found.collect()} == {w: chain[-1] for w in chain}


def test_counts_are_exact_for_very_long_words():
    long = ["e" * 5000 + c for c in ("", "f", "ff")]
    tile = spelling._Tile(long)
    assert tile.vectors.dtype == "float64" and tile.letters is None
    together = tile.sizes[:, None] < tile.sizes[None, :]
    assert list(zip(*(x.tolist() for x in tile.candidates(tile, together)))) == [(0, 1), (1, 2)]


def test_words_equal_brute_force(spark):
    rows = [(k, " ".join(some_words(k, "AbCdÉ×ÿ", 8)) + " Straße-Straße Straße, naïveté2naïveté Ωmegaomega") for k in range(40)]
    rows += [(None, "nowhere nowhere"), (1, None), (2, ""), (3, "short one"), (4, "Z" * 40), rows[0], rows[0]]
    expected = Counter()
    for i, text in rows:
        for run in regex.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            expected[run] += 1
    found = spelling.words(documents(spark, rows)).collect()
    assert {r.word: r.n for r in found} == {w: n for w, n in expected.items() if len(w) >= 7 and n >= 2}


def test_no_words(spark):
    assert spelling.group_variants(spelling.words(documents(spark, []))).collect() == []
    assert spelling.group_variants(spelling.words(documents(spark, [(1, None), (2, "a b c")]))).collect() == []
