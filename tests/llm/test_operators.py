"""Each operator against brute force or known answers, and the defined cases of odd rows."""

import math
import random
import time
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from aisleflow.llm import (
    decontaminate,
    hidden_markov,
    languages,
    licences,
    metric_search,
    near_copies,
    pages,
    repeats,
    sentencepieces,
    weak_labels,
)
from aisleflow.llm.common import WordHashes, rolling, sliding
from aisleflow.llm.queries import ORACLE_SQL, PIECES, QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
WORDS = [f"w{n}" for n in range(400)]
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, chunk STRING, rep_bytes STRING, items STRING"


@pytest.fixture(scope="module", autouse=True)
def package_path(spark):
    from aisleflow.llm.common import reach_package

    reach_package(spark)


def text_of(seed, n):
    own = random.Random(seed)
    return " ".join(own.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """Documents of (doc_id, text), with columns whose names the operators use inside."""
    full = [(i, t, "en" if t else None, None, len(t) if t else None, "c", None, "i") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    long = text_of(5, 30_000)
    return [(1, None), (2, ""), (3, "  \n "), (4, "!?"), (5, long), (5, long), (6, "one"), (None, text_of(6, 80)), (7, "ünï 日本 😀")]


# --- helpers ------------------------------------------------------------------


def test_rolling_and_sliding():
    memo = WordHashes()
    h = memo.of([b"a", b"b", b"c", b"a", b"b", b"c", b"d"])
    for k in (1, 2, 3, 5, 7):
        grams = rolling(h, k).tolist()
        assert len(grams) == 8 - k
        keys = [tuple(h[i : i + k]) for i in range(8 - k)]
        assert len(set(grams)) == len(set(keys)) and (k > 3 or grams[0] == grams[3])
    values = np.random.default_rng(0).integers(0, 99, 50).astype(np.uint64)
    for w in (1, 2, 5, 8):
        assert sliding(values, w, np.minimum).tolist() == [min(values[i : i + w]) for i in range(51 - w)]


@pytest.mark.parametrize("name", [n for n in ORACLE_SQL])
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name]) == []


# --- 1 languages --------------------------------------------------------------


def two_languages(spark, n=60):
    a, b = ["strasse", "und", "nicht", "haus"], ["улица", "дом", "нет", "это"]
    own = random.Random(1)
    rows = [(i, " ".join(own.choice(a if i % 2 else b) for _ in range(30)), "de" if i % 2 else "ru") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")


def test_languages_of_mixed_and_odd_texts(spark):
    model = languages.learn(two_languages(spark), F.lit(True))
    mixed = "und nicht haus strasse und haus улица дом нет это дом нет это это"
    found = languages.spans_of([mixed, "", None, "123 --", "haus und nicht"], model)
    assert [s["lang"] for s in found[0][2]] == ["de", "ru"]
    span = found[0][2][0]
    assert mixed[span["start"] : span["end"]] == "und nicht haus strasse und haus"
    assert [f[:2] for f in found[1:4]] == [("und", 0.0)] * 3 and found[4][:2] == ("de", 1.0)
    out = languages.identify(frame(spark, odd_rows()), model)
    assert out.count() == len(odd_rows())
    assert out.filter("doc_id < 5 and lang_pred <> 'und'").isEmpty()
    assert languages.keep_identified(frame(spark, odd_rows()), model).columns == DOCS.replace(",", "").split()[::2]


def test_marks_alone_are_no_word():
    w = languages.Words(["\u2764\ufe0f 123", "\ufe0fe\u0301a \u0301", "a\u0301", ""])
    assert w.text.tolist() == [1, 2] and w.length.tolist() == [3, 2]


def test_languages_viterbi_is_the_best_path():
    scores = np.random.default_rng(4).normal(0, 9, (7, 3)).astype(np.float32)
    label = languages._best_path(scores, np.array([0]), np.array([7]))
    cost = lambda p: sum(scores[i, c] for i, c in enumerate(p)) - languages.SWITCH_PENALTY * sum(a != b for a, b in zip(p, p[1:]))
    best = max(np.ndindex(*[3] * 7), key=cost)
    assert math.isclose(cost(label), cost(best), rel_tol=1e-5)


def test_languages_without_training(spark):
    empty = frame(spark, [])
    model = languages.learn(empty, F.lit(True))
    assert languages.spans_of(["haus"], model) == [("und", 0.0, [])]
    assert languages.identify(empty, model).count() == 0


def test_languages_held_out_accuracy(spark):
    out = QUERIES["op1_languages"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


# --- 2 repeats ----------------------------------------------------------------


def brute_repeats(rows):
    seen, out = {}, []
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - 49) if i is not None else ():
            seen[data[k : k + 50]] = min(seen.get(data[k : k + 50], i), i)
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 49) if i is not None else ():
            if seen[data[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, kept, len(data), int(gone.sum()), int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if data else 0))
    return sorted(out, key=repr)


def test_prefix_groups_are_suffix_ranks():
    own = random.Random(2)
    for letters in (b"a", b"ab", b"abcdefgh"):
        text = bytes(own.choice(letters) for _ in range(400)) * 2
        starts = np.arange(len(text) - 49)
        groups = repeats.prefix_groups(text, starts)
        ranked = dict(zip((text[s : s + 50] for s in starts), groups))
        assert all(ranked[text[s : s + 50]] == g for s, g in zip(starts, groups))
        assert [t for t, _ in sorted(ranked.items(), key=lambda x: x[1])] == sorted(ranked)


def test_repeats_equal_brute_force(spark):
    passage, other = text_of(1, 60), "é" * 40
    rows = [
        (4, text_of(2, 50) + passage + text_of(3, 40)), (2, passage), (9, text_of(4, 10) + passage[5:] + other), (3, "x" * 120),
        (5, "y" + "x" * 70), (6, other * 2), (7, passage), (7, passage), (8, passage[:49]), (10, passage[3:53]), *odd_rows(),
    ]
    out = repeats.remove_repeats(frame(spark, rows))
    assert "chunk" in out.columns and "rep_bytes" in out.columns
    got = sorted(((r.doc_id, bytes(r.rep_kept), r.rep_bytes, r.rep_removed, r.rep_spans) for r in out.collect()), key=repr)
    assert got == brute_repeats(rows)
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def hot_line_rows():
    """A common line between different neighbours, some of them shared, a run of one letter, and copies."""
    line = "This line is in each of the documents, whatever else they hold.\n"
    rows = [(i, text_of(1000 + i, 12) + "\n" + line + text_of(2000 + i % 70, 12)) for i in range(90)]
    return rows + [(200, "a" * 300), (201, "b" + "a" * 200), (202, rows[5][1]), (203, None), (204, "ab" * 90)]


def test_repeats_with_split_hashes_equal_brute_force(spark, monkeypatch):
    split, used = repeats._split, set()
    monkeypatch.setattr(repeats, "_split", lambda hot, step, *more: used.add(step) or split(hot, step, *more))
    rows = hot_line_rows()
    out = repeats.remove_repeats(frame(spark, rows), hot_bytes=300)
    got = sorted((r.doc_id, bytes(r.rep_kept), r.rep_bytes, r.rep_removed, r.rep_spans) for r in out.collect())
    assert got == sorted(brute_repeats(rows))
    assert used == {repeats.STEP, 1}


def test_sorting_a_part_takes_few_sorts_of_its_letters():
    """Pieces of few hashes with different neighbours, as chance makes more of them the larger the table is."""
    own = random.Random(9)
    texts = list({text_of(n, 9)[:30] + " one of the common words " + text_of(n + 10**6, 9)[:30] for n in range(12_000)})
    texts = [t.encode() for t in texts if len(t.encode()) >= 50]
    hashes = np.array([own.randrange(300) for _ in texts], np.uint64)
    ids = np.arange(len(texts))
    word = repeats.letters(b"".join(texts))

    def least(run):
        took = []
        for _ in range(3):
            begun = time.process_time()
            run()
            took.append(time.process_time() - begun)
        return min(took)

    assert least(lambda: repeats._solve(texts, hashes, ids)) < 5 * least(lambda: np.argsort(word, kind="stable"))


def test_runs_reach_their_chunks_without_a_join(spark):
    plan = repeats.remove_repeats(frame(spark, hot_line_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan


def test_hot_hash_is_spread():
    """Pieces of one hash with different neighbours: no new hash keeps many of their bytes, equal windows keep one hash."""
    line = b"This line is in each of the documents, whatever else they hold.\n"
    texts = [text_of(i, 12).encode() + b"\n" + line for i in range(3000)]
    buffer = b"".join(texts)
    start, n, value, _ = repeats.pieces(buffer, np.array([len(t) for t in texts]))
    distinct, inverse, counts = np.unique(value, return_inverse=True, return_counts=True)
    own = np.flatnonzero(inverse == max(range(len(distinct)), key=lambda k: len({buffer[s : s + c] for s, c in zip(start[inverse == k], n[inverse == k] + 49)})))
    held = {buffer[start[i] : start[i] + n[i] + 49] for i in own}
    before = sum(map(len, held))
    for step, least in ((repeats.STEP, 2), (1, 500)):
        sizes = np.array([len(t) for t in held], np.int32)
        text = b"".join(held)
        first, windows, new, piece = repeats._cut_again(text, sizes, np.full(len(held), value[own[0]]), step)
        assert windows.sum() == (sizes - 49).sum() and windows.max() <= step
        by_hash, hash_of = {}, {}
        for s, c, v in zip(first.tolist(), windows.tolist(), new.tolist()):
            by_hash.setdefault(v, set()).add(text[s : s + c + 49])
            for k in range(c):
                assert hash_of.setdefault(text[s + k : s + k + 50], v) == v
        assert max(sum(map(len, t)) for t in by_hash.values()) * least < before


# --- 3 pages ------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, None), ("", ""), ("<p>a<p>b", "a\n\nb"), ("a<br>b", "a\nb"), ("a  <b>b</b>\n c", "a b c"),
        ("<ul><li>a<li>b<ol start=4><li>c</ol></ul>", "- a\n- b\n  4. c"),
        ("<table><tr><td>ab<td>1<tr><td>c<td>22</table>", "ab  1\nc   22"),
        ("<table><tr><th colspan=2>h<th>x<tr><td>a<td>b<td>c</table>", "h     x\na  b  c"),
        ("<head><title>t</title></head><p hidden>x</p><p style='display: none'>y</p>z<script>a<b</script>", "z"),
        ("<details><summary>s</summary>h</details>", "s"), ("<pre>\n a\n  b</pre>", " a\n  b"), ("&lt;a&gt; &amp;", "<a> &"),
        ("x</p>y", "x\n\ny"), ("a < b <!-- c --> d", "a < b d"), ("<div>" * 20_000 + "deep", "deep"), ("<td>stray</td>", "stray"),
        ("<table><tr><td><h1>T</h1><p>one</p><ul><li>a<li>b</ul><td>x</table>", "T    x\n\none\n\n- a\n- b"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<table><tr><td colspan=1000>a<td>b</table>", "a  b"),
        ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b></div>", "b"),
        ("<style>.x, #y {display:none} @media print {p {display:none}}</style><p class='w x'>a<p id=y>b<p>c", "c"),
        ("<style>i.k{visibility:hidden}</style><i class=k>a</i><b class=k>b</b>", "b"),
        ("<svg><title>t</title><text>in</text><path d='M'/>no<text>two</text></svg>", "in\ntwo"),
        ("<math><mi>x</mi><annotation>y</annotation><mo>=</mo></math>", "x="),
        ("a <b title='x > y'>b</b> <c", "a b"), ("x <a href=", "x"), ("<p title='never closed>a</p>b", "a\n\nb"),
    ],
)
def test_pages(page, text):
    assert pages.render(page) == text


def test_pages_take_linear_time():
    """Wide tables, padding, unclosed tags and quotes: twice the page is about twice the time."""
    makers = [
        lambda n: "<table><tr><td>" + "x" * n + "".join(f"<tr><td>{k}<td>b" for k in range(n // 16)) + "</table>",
        lambda n: "<table><tr>" + "<td>c" * (n // 8) + "<td>" + "<p>l" * (n // 8) + "</table>",
        lambda n: "<table>" + ("<tr>" + "<td>a" * 100) * (n // 500) + "</table>",
        lambda n: "<a " * (n // 3), lambda n: "<a x=\"" * (n // 6), lambda n: "<a x='" * (n // 6) + ">", lambda n: "<!--" * (n // 4),
        lambda n: "<td rowspan=9 colspan=1000>" * (n // 28), lambda n: "<table>" + "<tr><td rowspan=65534>a" * (n // 23),
        lambda n: " " * n + "<pre>" + "a \t" * (n // 3),
    ]
    for make in makers:
        took = []
        for n in (250_000, 1_000_000):
            began = time.perf_counter()
            text = pages.render(make(n))
            took.append(time.perf_counter() - began)
            assert len(text) < 20 * n
        assert took[1] < 8 * took[0] + 0.5, make(40)


def test_cell_text_is_whole():
    """Every word of random tables comes out once, whatever is padded."""
    own = random.Random(8)
    for _ in range(60):
        words = [f"w{k}" * own.choice([1, 1, 30]) for k in range(own.randint(1, 40))]
        page, left = "<table>", list(words)
        while left:
            page += "<tr>"
            for _ in range(own.randint(1, 5)):
                own_words, left = left[: own.randint(0, 4)], left[own.randint(0, 0) :]
                left = left[len(own_words) :]
                page += f"<td rowspan={own.randint(1, 3)} colspan={own.randint(1, 3)}>" + "<p>".join(own_words)
        assert sorted(pages.render(page + "</table>").split()) == sorted(words)


def test_page_rows(spark):
    df = spark.createDataFrame([(1, None, "u"), (1, "<p>a", None), (None, "", "u")], "page_id INT, html STRING, text STRING")
    assert sorted(map(tuple, pages.extract(df).collect()), key=repr) == [(1, "a"), (1, None), (None, "")]


# --- 4 hidden Markov ------------------------------------------------------------


def test_forward_and_counts_equal_enumeration():
    own = np.random.default_rng(1)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    initial, moves, emissions = norm(own.random(2)), norm(own.random((2, 2))), norm(own.random((2, 3)))
    symbols, lengths = np.array([0, 2, 1, 1, 2]), np.array([2, 3])
    lattice = hidden_markov.Lattice(symbols, lengths)
    scale = lattice.forward(initial, moves, emissions.T[lattice.symbols])[1]
    owner = np.concatenate([lattice.order[:a] for a in lattice.active])
    logs = np.bincount(owner, np.log(scale), 2)
    first, made, out = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3))
    for d, seq in enumerate(([0, 2], [1, 1, 2])):
        paths = {}
        for path in np.ndindex(*[2] * len(seq)):
            p = initial[path[0]] * emissions[path[0], seq[0]]
            for a, b, s in zip(path, path[1:], seq[1:]):
                p *= moves[a, b] * emissions[b, s]
            paths[path] = p
        total = sum(paths.values())
        assert math.isclose(logs[d], math.log(total))
        for path, p in paths.items():
            first[path[0]] += p / total
            for t, k in enumerate(path):
                out[k, seq[t]] += p / total
                if t:
                    made[path[t - 1], k] += p / total
    got = hidden_markov.expected_counts(lattice, initial, moves, emissions)
    assert np.allclose(got[0], first) and np.allclose(got[1], made) and np.allclose(got[2], out)
    assert math.isclose(got[3], logs.sum())


def test_scores_of_odd_rows_and_base(spark):
    rows = [*odd_rows(), (20, "A b a"), (21, "a\tc ")]
    got = hidden_markov.score_texts(frame(spark, rows), F.col("doc_id").isin(20, 21)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    counts = Counter("a b a <end> a c <end>".split())
    n, v = 7, 4
    base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ("a", "b", "a", "<end>"))
    assert (by[20].n_tokens, by[20].n_known, by[20].train_tokens) == (4, 4, 7)
    assert math.isclose(by[20].base_score, base)
    assert (by[1].n_tokens, by[2].n_tokens, by[4].n_tokens, by[4].n_known) == (1, 1, 2, 1)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    none = hidden_markov.score_texts(frame(spark, [(1, "a"), (2, None)]), F.lit(False)).collect()
    assert {r.base_score for r in none} == {0.0} and {r.train_tokens for r in none} == {0}
    assert hidden_markov.score_texts(frame(spark, []), F.lit(True)).count() == 0


def test_hidden_states_beat_single_words_on_held_out_texts(spark):
    out = QUERIES["op4_hidden_markov"](spark, SF).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


# --- 5 licences ------------------------------------------------------------------


def test_licences(spark):
    mit = licences.KNOWN["MIT"].replace("<year> <holder>", "2020 Jo Doe").replace("sublicense", "sub-license").upper()
    rows = [(1, mit), (2, mit + " more"), (3, licences.KNOWN["ISC"].replace("License", "Licence")), *odd_rows()]
    got = {r.doc_id: r.licence for r in licences.scan(frame(spark, rows), licences.known_digests(spark)).collect() if r.licence}
    assert got == {1: "MIT", 3: "ISC"}
    assert licences.scan(frame(spark, odd_rows()), licences.known_digests(spark, {})).filter("doc_id = 1").first().digest is None
    twice = licences.known_digests(spark, {"b": "x y", "a": "X, y."}).collect()
    assert [r.licence for r in twice] == ["a"]


def test_licences_as_people_keep_them(spark):
    """Titles and copyright lines of any form, wrapped lines, another name in the BSD clause."""
    import textwrap

    known = licences.KNOWN
    body = lambda name: known[name].split("\n\n", 2)[2]
    wrapped = lambda text: "\n\n".join(textwrap.fill(p, 70) for p in text.split("\n\n"))
    texts = {
        "MIT": [
            "The MIT License (MIT)\n\nCopyright (c) 2015 Jo Doe\n\n" + body("MIT"), "Copyright Jo Doe 2020\n\n" + body("MIT"), body("MIT"),
            "MIT License\n\nCopyright The Foo Authors\n" + wrapped(body("MIT")), "(c) Jo Doe\nAll rights reserved.\n\n" + body("MIT").upper(),
            "Copyright 2001 A\nCopyright (C) 2002-2009 B, C\n\n" + wrapped(body("MIT")),
        ],
        "BSD-3-Clause": [body("BSD-3-Clause").replace("the copyright holder nor", "Foo, Inc. nor"), "# BSD 3-Clause License\n\nCopyright (c) 2010, Foo\nAll rights reserved.\n\n" + wrapped(body("BSD-3-Clause"))],
        "BSD-2-Clause": [wrapped(known["BSD-2-Clause"])], "ISC": [wrapped(body("ISC"))], "0BSD": [body("0BSD")], "MIT-0": [wrapped(known["MIT-0"])],
        "Unlicense": [wrapped(known["Unlicense"])], "Zlib": [body("Zlib"), wrapped(known["Zlib"])], "BSL-1.0": [wrapped(known["BSL-1.0"])],
    }
    rows = [(k, text, name) for k, (name, text) in enumerate((n, t) for n, own in texts.items() for t in own)]
    other = [body("MIT") + "\nAnd more.", body("MIT")[:-20], "MIT License", "", "Copyright 2020 Me", "words " * 40_000, "copyright me\n" * 5000]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000 + k, t) for k, t in enumerate(other)] + [(None, None)], "doc_id BIGINT, text STRING")
    found = {r.doc_id: r.licence for r in licences.scan(df, licences.known_digests(spark)).collect()}
    assert [(n, found[i]) for i, _, n in rows] == [(n, n) for _, _, n in rows]
    assert {found[1000 + k] for k in range(len(other))} | {found[None]} == {None}
    assert licences.scan(df.limit(0), licences.known_digests(spark)).count() == 0


# --- 6 weak labels ----------------------------------------------------------------


def test_accuracies_are_recovered():
    own = np.random.default_rng(3)
    truth = own.random(20_000) < 0.8
    good, bad = np.array([0.99, 0.98, 0.97, 0.99]), np.array([0.4, 0.5, 0.6, 0.5])
    votes = np.where(truth[:, None], own.random((20_000, 4)) < good, own.random((20_000, 4)) >= bad).astype(int)
    votes[own.random(votes.shape) < 0.1] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, g, b = weak_labels.fit_accuracies(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.05 and np.allclose(g, good, atol=0.03) and np.allclose(b, bad, atol=0.1)


def test_votes_equal_plain_counting():
    """The labellers against regular expressions over random texts."""
    import regex

    def plain(text):
        words, lines, size = text.split(), [x for x in text.split("\n") if x], len(text)
        n, letters = len(words), max(len(regex.findall(r"\p{L}", text)), 1)
        symbols = len(regex.findall(r"[^\p{L}\p{N}\s.,;:'’\"()-]", text)) / max(size, 1)
        upper = len(regex.findall(r"\p{Lu}", text)) / letters
        stuck = sum(a == b for a, b in zip(words, words[1:])) / max(n, 1)
        repeated = 1 - len(set(lines)) / max(len(lines), 1)
        ends = len(regex.findall(r"[.;:,](?=\s|\Z)", text)) / max(n, 1)
        single = sum(len(w) == 1 and not regex.match(r"[\p{L}\p{N}]", w) for w in words) / max(n, 1)
        mean = size / max(n, 1)
        pick = lambda bad, good: 0 if bad else 1 if good else None
        return [
            pick(symbols > 0.05, symbols < 0.01), pick(upper > 0.4, upper < 0.15), pick(stuck > 0.1, stuck < 0.03) if n >= 20 else None,
            pick(repeated > 0.3, repeated < 0.1) if len(lines) >= 4 else None, pick(ends == 0 or ends > 0.5, 0.03 <= ends <= 0.3) if n >= 20 else None,
            pick(single > 0.1, single == 0) if n >= 5 else None, pick(mean < 3 or mean > 14, 4 <= mean <= 9) if n >= 5 else None,
        ]

    own = random.Random(6)
    pieces = ["word", "Word", "WORD", "été", "Ω", "12", "#", "###", ".", "end.", "a,b", "日本", "|", "’", "\n", "\t", "x" * 30, "same same"]
    for _ in range(400):
        text = "".join(own.choice(pieces) + own.choice([" ", " ", "\n", ""]) for _ in range(own.randint(0, 60)))
        assert weak_labels.votes_of(text, text.split()) == plain(text), text


def test_accuracies_equal_those_of_single_documents():
    """Expectation-maximisation over pattern counts is that over documents one by one."""
    own = np.random.default_rng(9)
    votes = own.integers(-1, 2, (600, 5))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    grouped = weak_labels.fit_accuracies(patterns, counts.astype(float))
    single = weak_labels.fit_accuracies(votes, np.ones(len(votes)))
    assert all(np.allclose(a, b) for a, b in zip(grouped, single))


def test_quality_is_the_same_whatever_order_rows_come_in(spark):
    rows = [(k, text_of(k, 30) + ("." if k % 3 else " ###" * 9)) for k in range(60)]
    scores = [sorted(map(tuple, weak_labels.quality(frame(spark, r).repartition(n), 40).collect())) for r, n in ((rows, 1), (rows[::-1], 5))]
    assert scores[0] == scores[1]


def test_quality_agrees_with_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op6_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    kept = {r.quality: r.kept for r in out.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.98 and kept[0] < 0.3


def test_quality_of_odd_rows(spark):
    got = weak_labels.quality(frame(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    assert {(r.posterior, r.score, r.keep) for r in got if r.doc_id in (1, 2)} == {(0.0, 0.0, False)}
    assert weak_labels.quality(frame(spark, [])).count() == 0


# --- 7 top-k ------------------------------------------------------------------------


def test_top_k_with_ties_duplicates_and_odd_vectors(spark):
    own = np.random.default_rng(5)
    rows = [(i, own.normal(0, 0.2, 8).tolist()) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 420)]
    rows += [(500, None), (501, []), (502, [float("nan")] * 8), (503, [None] * 8), (504, [0.1] * 3), (None, [0.1] * 8), (7, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(3)
    got = metric_search.top_k(df, F.col("vec_id") % 50 == 0).collect()
    good = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v in rows if v and None not in v and not np.isnan(v).any() and i is not None]
    want = []
    for a, (i, v) in enumerate(good):
        if i % 50 == 0:
            found = sorted((-int(v @ w), j) for b, (j, w) in enumerate(good) if a != b and len(v) == len(w))[:10]
            want += [(i, n, j, -s) for n, (s, j) in enumerate(found, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert metric_search.top_k(df.limit(0), F.lit(True)).count() == 0


def _exact_top(rows, every, k=10):
    """Top k by Python's integers."""
    good = [(i, [max(min(math.floor(1024 * x), 2**63 - 1), -(2**63)) for x in v]) for i, v in rows]
    want = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            found = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(good) if a != b)[:k]
            want += [(i, n, j, max(min(-s, 2**63 - 1), -(2**63))) for n, (s, j) in enumerate(found, 1)]
    return sorted(want)


@pytest.mark.parametrize("scale", [1e5, 3e6, 1e12, 1e300])
def test_top_k_of_large_components_is_exact(spark, scale):
    """Products past 2 ** 53, 2 ** 63 and 2 ** 126, beside ordinary vectors and with ties."""
    own = np.random.default_rng(8)
    rows = [(i, own.normal(0, scale, 4).tolist()) for i in range(120)] + [(i, own.normal(0, 1, 4).tolist()) for i in range(120, 200)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(3)
    assert sorted(map(tuple, metric_search.top_k(df, F.col("vec_id") % 20 == 0).collect())) == _exact_top(rows, 20)


def test_search_skips_distances():
    own = np.random.default_rng(6)
    centres = own.normal(0, 500, (20, 8))
    vectors = np.floor(centres[own.integers(0, 20, 4000)] + own.normal(0, 5, (4000, 8)))
    longest = float((vectors**2).sum(1).max())
    tree = metric_search.Tree(vectors, longest)
    ordered = vectors[tree.order]
    best = metric_search.Best(10, -float("inf"), float(vectors[0] @ vectors[0]) + longest)
    computed = metric_search.search(vectors[0], -1, [(tree, ordered, tree.order, tree.order)], best)
    assert computed < 2000
    assert best.score.tolist() == sorted((vectors @ vectors[0]).astype(int).tolist(), reverse=True)[:10]


# --- 8 pieces ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    with open(PIECES, "rb") as f:
        return sentencepieces.Vocabulary(f.read())


def best_score(v, text):
    best = [0.0] + [-math.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + v.longest) + 1):
            known = v.pieces.get(text[i:j])
            if known or j == i + 1:
                best[j] = max(best[j], best[i] + (known[1] if known else v.unknown))
    return best[-1]


def test_pieces_are_the_best_path_and_round_trip(vocabulary):
    read = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = sentencepieces.Encoder(vocabulary)
    for text in ("hello world", "  two  spaces ", "héhé 日本 😀\n\nx", "a" * 500, text_of(3, 50), "don't stop, now.", "\t"):
        ids = encoder.encode(text).tolist()
        assert sentencepieces.decode_ids(vocabulary, ids) == text
        assert read.decode(ids) == text
        score = sum(vocabulary.pieces[read.id_to_piece(i)][1] for i in ids if not read.is_byte(i))
        unknown = sum(c not in vocabulary.pieces for c in text.replace(" ", "▁"))
        assert math.isclose(score + unknown * vocabulary.unknown, best_score(vocabulary, "▁" + text.replace(" ", "▁")), rel_tol=1e-9)


def test_stream_is_bounded_and_equal(vocabulary):
    text = text_of(9, 3000).replace(" ", "")
    stream = sentencepieces.StreamingViterbi(vocabulary)
    ids = []
    for i in range(0, len(text), 700):
        ids += stream.feed(text[i : i + 700])
    ids += stream.finish()
    assert ids == list(sentencepieces._short(vocabulary, text)) and stream.widest < 20 * vocabulary.longest
    chunks = [text_of(4, 20)[i : i + 3] for i in range(0, 100, 3)]
    assert list(sentencepieces.stream_ids(vocabulary, chunks)) == sentencepieces.Encoder(vocabulary).encode("".join(chunks)).tolist()


def test_piece_rows(spark):
    out = sentencepieces.encode(frame(spark, odd_rows()), PIECES)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(odd_rows()) and got[1].ids is None and got[2].ids == [] and got[7].round_trip
    back = {r.doc_id: r.text for r in sentencepieces.decode(out, PIECES).collect()}
    assert back[1] is None and back[7] == "ünï 日本 😀"


# --- 9 benchmark ------------------------------------------------------------------------


def brute_hits(docs, items):
    out = []
    for i, t in docs:
        words = decontaminate.words_of((t or "").encode())
        hit, named = set(), set()
        for item, other in items:
            o = decontaminate.words_of((other or "").encode())
            n = min(10, len(o))
            windows = {tuple(o[k : k + n]) for k in range(len(o) - n + 1)} if n else set()
            for k in range(len(words) - n + 1):
                if n and tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    named.add(item)
        out.append((i, len(words), len(hit), sorted(str(x) for x in named if x is not None)))
    return sorted(out, key=repr)


def test_contamination_equals_brute_force(spark):
    long = text_of(1, 40)
    items = [(11, long), (2, "W1 w2, w3"), (3, None), (4, "..."), (None, text_of(2, 12)), (11, text_of(8, 15)), (5, long[:60])]
    docs = [
        (100, text_of(3, 30) + " " + long.upper()), (101, long[: len(long) // 2] + " x " + text_of(2, 12)), (102, "w1 w2 w3 w1 w2 w3"),
        (103, text_of(8, 9)), *odd_rows(),
    ]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = decontaminate.contamination(frame(spark, docs), bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == brute_hits(docs, items)
    empty = decontaminate.contamination(frame(spark, docs), bench.limit(0)).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(empty) == (0, len(docs))


def test_winnowing_keeps_a_hash_of_every_shared_run():
    memo = WordHashes()
    for seed in range(30):
        shared = text_of(seed, 10)
        kept = [set(decontaminate._fingerprints([f"{text_of(seed + k, 20)} {shared} {text_of(seed + k + 1, 20)}".encode()], memo, [])[1].tolist()) for k in (100, 200)]
        assert kept[0] & kept[1]


# --- 10 near copies ------------------------------------------------------------------------


def changed(text, edits, seed):
    words, own = text.split(), random.Random(seed)
    for _ in range(edits):
        words[own.randrange(len(words))] = f"new{own.random()}"
    return " ".join(words)


def pairs_alike(texts, least=0.8):
    """All pairs of indexes of texts whose shingles align to ``least`` or more, by prefix filter and plain alignment."""
    memo = WordHashes()
    grams = [near_copies.shingles(memo.of(near_copies.words_of(t.encode()))).tolist() for t in texts]
    often = Counter(g for own in grams for g in own)
    holders, pairs = {}, set()
    for b, own in enumerate(grams):
        place = {g: k for k, g in enumerate(own)}
        rarest = sorted(own, key=lambda g: (often[g], g))[: len(own) - math.ceil(least * len(own) - 1e-9) + 1]
        for a in {a for g in rarest for a in holders.get(g, ())}:
            tails = []
            for k in (place[g] for g in grams[a] if g in place):
                at = bisect_left(tails, k)
                tails[at : at + 1] = [k]
            if len(tails) >= least * (len(own) + len(grams[a]) - len(tails)) - 1e-9:
                pairs.add((a, b))
        for g in rarest:
            holders.setdefault(g, []).append(b)
    return pairs


def test_no_pair_of_a_whole_table_is_lost(spark):
    """Every pair of different texts of 0.8 or more is in one class, and a class holds nothing that such pairs do not connect."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").filter("text is not null").collect()
    texts = list(dict.fromkeys(r.text for r in docs))
    pairs = pairs_alike(texts)
    number = {t: k for k, t in enumerate(texts)}
    class_of = {r.doc_id: r.class_id for r in QUERIES["op10_near_copies"](spark, sf).collect()}
    found = {number[r.text]: class_of[r.doc_id] for r in docs}
    together = sum(found[a] == found[b] for a, b in pairs)
    print(f"{len(docs)} documents, {len(texts)} texts, {len(pairs)} pairs, {together} of them in one class")
    assert pairs and together >= 0.9 * len(pairs)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for k, c in found.items():
        groups.setdefault(c, set()).add(find(k))
    assert all(len(g) == 1 for g in groups.values())


def test_pairs_alike_equal_the_aligned_comparison_of_all():
    texts = [changed(text_of(s % 3, 40 + s), s % 4, s) for s in range(12)] + ["a b c d e f g h", "x a b c d e f g h", "a b", "a b"]
    memo = WordHashes()
    grams = [near_copies.shingles(memo.of(near_copies.words_of(t.encode()))) for t in texts]
    want = {(a, b) for b in range(len(texts)) for a in range(b) if near_copies.similarity(grams[a], grams[b]) >= 0.8}
    assert pairs_alike(texts) == want


def test_classes_equal_all_pairs(spark):
    base = [text_of(s, 150) for s in range(6)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(200 + 10 * i + k, changed(t, k, k)) for i, t in enumerate(base) for k in range(6)]
    rows += [(300, base[0]), (301, base[0]), (302, "a b c"), (303, "a b c"), (304, "a b c d e f g h"), (305, "a b c d e f g h i"), *odd_rows()]
    memo = WordHashes()
    grams = [near_copies.shingles(memo.of(near_copies.words_of((t or "").encode()))) for _, t in rows]
    root = list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][1] is not None and rows[a][1] == rows[b][1]
            if same or near_copies.similarity(grams[a], grams[b]) >= 0.8:
                root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    want = sorted(((i, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g), key=repr)
    df = frame(spark, rows)
    assert sorted(map(tuple, near_copies.classes(df).collect()), key=repr) == want
    kept = near_copies.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((min((x for x in g if x is not None), default=None) for g in groups.values()), key=repr)
    assert near_copies.classes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n, m, common", [(4, 5, 4), (9, 9, 8), (12, 15, 12), (18, 18, 16)])
def test_short_near_copies_share_a_sketch(n, m, common):
    """Of 12 000 pairs of similarity 0.8 none is missed; 0.1 or less are expected, with 28 sketches of 5 it was up to 11."""
    own = np.random.default_rng(n)
    for _ in range(12_000):
        grams = own.integers(1, 2**63, n + m - common).astype(np.uint64)
        a, b = grams[:n], np.concatenate([grams[:common], grams[n:]])
        assert np.isin(near_copies.sketches(a), near_copies.sketches(b)).any()


def test_buckets_of_several_groups_lose_no_link(spark, monkeypatch):
    """Every text in one bucket: links that the smallest node does not have are still found."""
    monkeypatch.setattr(near_copies, "BLOCK_NODES", 3)
    texts = [text_of(s, 100) for s in range(5)] + [changed(text_of(s, 100), 1, 1) for s in range(5)]
    docs = frame(spark, list(enumerate(texts)))
    nodes = docs.select(F.col("doc_id").alias("node"), F.md5("text").alias("copy"), "doc_id")
    links = near_copies._links(nodes, nodes.select("node", F.lit(1).cast("long").alias("key")), docs)
    assert {tuple(sorted((r.a, r.b))) for r in links.collect()} == {(k, k + 5) for k in range(5)}


def test_similarity_follows_order():
    grams = np.arange(1, 101, dtype=np.uint64)
    assert near_copies.similarity(grams, grams) == 1.0
    assert near_copies.similarity(grams, grams[:90]) == 0.9
    assert near_copies.similarity(grams, np.concatenate([grams[50:], grams[:50]])) < 0.8


def test_similarity_equals_longest_common_subsequence():
    """Also at exactly 0.8 with all that is added in front, where every match is as far off as can be."""

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for k, y in enumerate(b):
                row[k + 1] = before[k] + 1 if x == y else max(before[k + 1], row[k])
        return row[-1] / (len(a) + len(b) - row[-1])

    more = np.arange(1000, 1100, dtype=np.uint64)
    for n in range(4, 101, 4):
        grams = np.arange(1, n + 1, dtype=np.uint64)
        for front in (n // 4, n // 4 + 1, n // 8):
            longer = np.concatenate([more[:front], grams])
            for a, b in ((grams, longer), (longer, grams), (grams, np.concatenate([grams, more[:front]]))):
                want = plain(a.tolist(), b.tolist())
                got = near_copies.similarity(a, b)
                assert got == want if want >= 0.8 else got < 0.8
    memo = WordHashes()
    a, b = (near_copies.shingles(memo.of(near_copies.words_of(t))) for t in (b"a b c d e f g h", b"x a b c d e f g h"))
    assert near_copies.similarity(a, b) == 0.8


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 30)] + [(50, 40), (40, 45)], "a BIGINT, b BIGINT")
    got = {r.node: r.root for r in near_copies.components(edges).collect()}
    assert got == {**{k: 0 for k in range(31)}, 40: 40, 45: 40, 50: 40}


def test_crc_matches_sql(spark):
    got = spark.range(5).select(F.crc32(F.col("id").cast("string").cast("binary")).alias("c")).collect()
    assert [r.c for r in got] == [zlib.crc32(str(i).encode()) for i in range(5)]


def test_queries_searched_together_find_what_each_finds_alone():
    """Scores, ties to the smaller id and then row, own rows left out, and pages skipped."""
    own = np.random.default_rng(7)
    centres = own.normal(0, 500, (20, 8))
    vectors = np.floor(centres[own.integers(0, 20, 4000)] + own.normal(0, 5, (4000, 8)))
    vectors[3000:3200] = vectors[0]  # many equal scores
    longest, forest = float((vectors**2).sum(1).max()), []
    for part in (np.arange(0, 1700), np.arange(1700, 4000)):
        tree = metric_search.Tree(vectors[part], longest)
        rows = part[tree.order]
        forest.append((tree, vectors[rows].astype(np.int64), rows // 2, rows))  # two rows of each id
    asked = np.arange(0, 4000, 50)
    reach = (vectors[asked] ** 2).sum(1) + longest
    bests = metric_search.Bests(10, np.full(len(asked), -np.inf), reach, 8)
    computed = metric_search.search_all(vectors[asked], asked, forest, bests)
    assert computed < 0.5 * len(asked) * len(vectors)
    for n, row in enumerate(asked):
        best = metric_search.Best(10, -float("inf"), float(reach[n]), 8)
        metric_search.search(vectors[row].astype(np.int64), row, forest, best)
        assert (bests.score[n].tolist(), bests.vec[n].tolist(), bests.row[n].tolist()) == (best.score.tolist(), best.vec.tolist(), best.row.tolist())


def test_fewer_rows_than_answers_leave_places_empty():
    vectors = np.array([[1.0, 0.0], [0.0, 2.0], [3.0, 1.0]])
    tree = metric_search.Tree(vectors, 10.0)
    bests = metric_search.Bests(10, np.full(3, -np.inf), (vectors**2).sum(1) + 10.0, 2)
    metric_search.search_all(vectors, np.arange(3), [(tree, vectors[tree.order].astype(np.int64), tree.order, tree.order)], bests)
    assert (bests.score > -np.inf).sum(1).tolist() == [2, 2, 2]
