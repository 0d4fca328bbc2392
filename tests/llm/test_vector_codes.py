"""Vector codes against plain rounds in Python's whole numbers, and their odd rows."""

import math
import random

import numpy as np

from aisleflow.llm import vector_codes

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, code STRING, error STRING, row STRING, part STRING, _label STRING"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "c", "e", "r", "p", "l") for i, v, y in rows], SCHEMA)


def brute_force(rows, rounds=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    started = sorted((r for r in kept if r[0] is not None), key=lambda r: r)
    d = len(started[0][1]) // 16
    cut = lambda v, p: v[p * d : (p + 1) * d]
    book = [[cut(v, p) for _, v in started[:64]] for p in range(16)]

    def nearest(x, entries):
        apart = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries]
        return apart.index(min(apart)), min(apart)

    for _ in range(rounds):
        for p in range(16):
            own = {}
            for _, v in kept:
                own.setdefault(nearest(cut(v, p), book[p])[0], []).append(cut(v, p))
            for e, points in own.items():
                book[p][e] = [sum(c) // len(points) for c in zip(*points)]
    out = []
    for i, v in kept:
        found = [nearest(cut(v, p), book[p]) for p in range(16)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(m for _, m in found)))
    return out, vector_codes.codebook_digest([np.array(e, object) for e in book])


def some(seed, n, d=32, spread=1.0):
    own = random.Random(seed)
    return [(k, [own.gauss(0, spread) for _ in range(d)]) for k in range(n)]


def check(spark, rows, d=32):
    coded, book = vector_codes.compress(vectors(spark, [(i, v, None if i is None else i % 3) for i, v in rows]))
    expected, digest = brute_force(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=key) == sorted(expected, key=key)
    assert vector_codes.codebook_digest(book) == digest


def test_codes_equal_plain_rounds(spark):
    """Copies of one vector, repeated ids, a null id, equal entries."""
    rows = some(1, 700) + [(5000 + k, [0.25] * 32) for k in range(400)] + [(3, [0.5] * 32), (3, [0.25] * 32), (None, [0.1] * 32)]
    check(spark, rows)


def test_wide_and_narrow_parts(spark):
    rows = some(3, 100, d=16) + [(901, [-3e5] * 16), (902, [8388608.0] + [0.5] * 15), (903, [0.5] * 15 + [-1e7])]
    check(spark, rows)


def test_components_beyond_a_long(spark):
    """Exact codes; an error that no long can hold is null, and so is a sum with it."""
    rows = some(4, 70, d=16) + [(900, [1e30] * 16), (901, [2e30] * 8 + [0.0] * 8), (902, [3.4e38] + [0.0] * 15)]
    coded, book = vector_codes.compress(vectors(spark, [(i, v, i // 900) for i, v in rows]))
    expected, digest = brute_force(rows)
    found = {r.vec_id: r for r in vector_codes.with_label_error(coded).collect()}
    assert vector_codes.codebook_digest(book) == digest
    for i, code, error in expected:
        assert found[i].code == code and found[i].error == (error if error < 2**63 else None)
    assert found[0].label_error == sum(e for i, _, e in expected if i < 900)
    if any(e >= 2**63 for _, _, e in expected):
        assert found[900].label_error is None


def test_odd_rows(spark):
    good = some(5, 20)
    odd = [(100, None, 1), (101, [], 1), (102, [None] * 32, 1), (103, [float("nan")] * 32, 1), (104, [float("inf")] * 32, 1), (105, [1.0] * 16, 1), (106, [1.0] * 30, 1)]
    coded, _ = vector_codes.compress(vectors(spark, [(i, v, None) for i, v in good] + odd))
    found = vector_codes.with_label_error(coded).collect()
    assert sorted(r.vec_id for r in found) == list(range(20))
    assert {r.label_error for r in found} == {sum(r.error for r in found)}  # null labels are one


def test_nothing_to_code(spark):
    for rows in ([], [(1, None, 1)], [(None, [1.0] * 16, 1)]):
        coded, book = vector_codes.compress(vectors(spark, rows))
        assert coded.columns == ["vec_id", "label", "code", "error"] and coded.count() == 0 and book == []
        assert vector_codes.with_label_error(coded).count() == 0


def test_shortlist_keeps_every_nearest_entry():
    own = np.random.default_rng(2)
    for _ in range(200):
        entries, points = own.integers(-9, 9, (12, 3)), own.integers(-9, 9, (5, 3))
        best, _ = vector_codes.nearest(points, entries)
        short = vector_codes.shortlist(entries, points.min(0), points.max(0))
        assert set(best.tolist()) <= set(short.tolist())
        again, _ = vector_codes.nearest(points, entries[short])
        assert (short[again] == best).all()


def test_hilbert_neighbours_are_one_step_apart():
    """On a full grid each place is visited once and each step moves along one axis by one."""
    bits = vector_codes.MOST_BITS
    side = np.arange(2**bits)
    grid = np.stack(np.meshgrid(side, side, indexing="ij"), -1).reshape(-1, 2)
    level = (grid / (2**bits - 1) * 2 - 1) * math.log1p(2.0**30)
    place = vector_codes.hilbert(np.sign(level) * np.expm1(np.abs(level)))
    assert len(set(place.tolist())) == len(grid)
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(1) == 1).all()
