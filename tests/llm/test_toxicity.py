"""The noisy channel against enumeration, planted disguises, held-out labels and odd rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aisleflow.llm import toxicity
from aisleflow.llm.queries import QUERIES

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCS = "doc_id BIGINT, text STRING, lang STRING, toxic INT, score STRING, feature STRING, h STRING"
HELD_OUT = "pmod(crc32(cast(cast(doc_id AS string) AS binary)), 4) = 2"


@pytest.fixture(scope="module")
def costs(spark):
    from aisleflow.llm.common import read_table

    return toxicity.character_model(read_table(spark, SF, "documents"))


def test_gram_counts():
    texts = ["Hello wörld 12", None, "", "a", "__", "x" * 9]
    symbols = [0]
    for c in " ".join(t for t in texts if t).lower() + " ":
        s = ord(c) - 96 if "a" <= c <= "z" else toxicity.DIGIT if c in "0123456789" else 0
        if s or symbols[-1]:
            symbols.append(s)
    expected = {}
    for k in range(1, len(symbols)):
        context = []
        for j in (k - 1, k - 2, k - 3):
            context.append(0 if j < 0 or (context and 0 in symbols[j + 1 : k]) else symbols[j])
        code = ((context[2] * 28 + context[1]) * 28 + context[0]) * 28 + symbols[k]
        expected[code] = expected.get(code, 0) + 1
    found = toxicity.gram_counts(texts)
    assert {int(k): int(found[k]) for k in np.nonzero(found)[0]} == expected


def test_costs_are_probabilities(costs):
    assert np.allclose(np.exp(-costs.astype(float)).reshape(-1, toxicity.SYMBOLS).sum(1), 1, atol=1e-4)


def all_readings(written, costs):
    """Every way through the lattice, as (cost, restored text)."""
    symbol = lambda r: ord(r) - 96 if "a" <= r <= "z" else toxicity.DIGIT

    def ways(c):
        out = [("put", c, 0.0)] if c.isalnum() else [("drop", "", toxicity.DROP), ("end", "", 0.0 if c.isspace() else toxicity.END)]
        out += [("put", r, toxicity.READ) for r in toxicity.READINGS.get(c, "")]
        return out + [("again", r, cost + toxicity.REPEAT) for kind, r, cost in out if kind == "put"]

    for path in itertools.product(*(ways(c) for c in written)):
        context, last, total, text = [0, 0, 0], "", 0.0, ""
        for kind, r, cost in path:
            total += cost
            if kind == "again" and r != last:
                total = math.inf
                break
            if kind == "put":
                s = symbol(r)
                total += float(costs[((context[0] * 28 + context[1]) * 28 + context[2]) * 28 + s])
                context, last, text = [*context[1:], s], r, text + r
            elif kind == "end":
                total += float(costs[((context[0] * 28 + context[1]) * 28 + context[2]) * 28]) if context[2] else 0.0
                context, last, text = [0, 0, 0], "", text + " "
        if total < math.inf:
            total += float(costs[((context[0] * 28 + context[1]) * 28 + context[2]) * 28]) if context[2] else 0.0
            yield total, " ".join(text.split())


@pytest.mark.parametrize("written", ["1d!0t", "l0$$er", "a b c", "s-t_u", "3335", "aabb11", "$$$", "x!!!", "t.h.e 4"])
def test_restored_text_is_the_cheapest_reading(costs, written):
    ways = list(all_readings(written, costs.tolist()))
    least = min(c for c, _ in ways)
    assert toxicity.restore(written, costs.tolist()) in {t for c, t in ways if c < least + 1e-6}


def test_plain_words_stay(costs):
    restorer = toxicity.Restorer(costs)
    text = "Plain words, (even) naïve ones: 2024 12:30 x"
    assert {w for w, _ in restorer.words(text)} >= {"plain", "words", "even", "naïve", "ones", "2024", "x"}


INSULTS = ["idiot", "moron", "stupid", "pathetic", "clown", "worthless", "disgusting", "loser"]


def disguise(word, own):
    kind = own.randrange(4)
    if kind == 0:
        return "".join({"i": "1", "o": "0", "e": "3", "s": "$", "a": "@", "t": "7"}.get(c, c) for c in word)
    if kind == 1:
        return own.choice(" .-_").join(word)
    k = own.randrange(len(word))
    return word[:k] + word[k] * own.randint(3, 6) + word[k + 1 :] if kind == 2 else word + own.choice(["###", "!!", "***"])


def test_disguised_words_are_found(spark):
    """Trained on plain insults, held-out documents with disguised ones only are found, clean ones are left alone."""
    from aisleflow.llm.common import read_table

    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = toxicity.learn(docs, labels, ~F.expr(HELD_OUT))
    own = random.Random(3)
    clean = [r.text for r in docs.join(labels, "doc_id").filter("toxic = 0 AND lang = 'en' AND n_chars BETWEEN 200 AND 3000").orderBy("doc_id").limit(60).collect()]
    rows = []
    for k, text in enumerate(clean):
        words = text.split()
        for at in range(5, len(words), 25):
            words[at] = disguise(own.choice(INSULTS), own)
        rows += [(2 * k, text), (2 * k + 1, " ".join(words))]
    scored = {r.doc_id: r.score >= toxicity.TOXIC_FROM for r in toxicity.score(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), model).collect()}
    assert sum(scored[2 * k + 1] for k in range(len(clean))) >= 0.9 * len(clean)
    assert sum(scored[2 * k] for k in range(len(clean))) <= 0.05 * len(clean)


def test_held_out_labels(spark):
    from aisleflow.llm.common import read_table

    found = QUERIES["op12_toxicity"](spark, LARGER).filter("held_out").join(read_table(spark, LARGER, "labels"), "doc_id").collect()
    toxic, clean = [r for r in found if r.toxic], [r for r in found if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_odd_rows(spark):
    long = "word " * 20_000 + "1" * 3000 + " " + "a b " * 2000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "!?"), (5, long), (5, long), (None, "you idiot"), (7, "日本 😀 é"), (8, "idiot " * 9)]
    train = [(100 + k, ("you idiot " if k % 2 else "good day ") * 5 + str(k)) for k in range(40)]
    docs = spark.createDataFrame([(i, t, "en", 1, "s", "f", "h") for i, t in rows + train], DOCS)
    labels = spark.createDataFrame([(i, i % 2, "x") for i, _ in train] + [(100, 1, "x"), (None, 1, "x"), (101, None, "x")], "doc_id BIGINT, toxic INT, text STRING")
    model = toxicity.learn(docs, labels, F.lit(True))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) + len(train) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[4] == by_id[7]
    assert by_id[8] > 0.5 > by_id[1] and by_id[None] > 0.5


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some text", "en", 1, "s", "f", "h")], DOCS)
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    assert [r.score for r in toxicity.score(docs, toxicity.learn(docs, none, F.lit(True))).collect()] == [pytest.approx(0.5)]
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.learn(empty, none, F.lit(True))).collect() == []


def test_words_with_signs_around_them_take_no_search_for_ornaments(monkeypatch):
    """A word that is letters once its outer signs are off is done with; texts have one in every sentence."""

    class Never:
        def sub(self, *_):
            raise AssertionError("searched")

    words = ["word.", "(word)", "word!!", "word,", "word***"]
    restorer = toxicity.Restorer(np.zeros(28**4))
    before = [restorer.plain(w) for w in words]
    monkeypatch.setattr(toxicity, "_ORNAMENT", Never())
    assert [restorer.plain(w) for w in words if w.strip(toxicity._NO_READING).isalpha()] == [b for w, b in zip(words, before) if w.strip(toxicity._NO_READING).isalpha()]


@pytest.mark.parametrize("known", [3, 400])
def test_inputs_are_those_of_the_restored_words(costs, known):
    """The short way of plain words gives what restored words and all their features give."""
    texts = ["idiot idiots, 1d10t!! a b.c ... i.d.i.o.t treelle", "plain words only", "", None, "42 !! x", "ab abc= abcd"]
    restorer = toxicity.Restorer(costs)
    every = [[(toxicity.features_of(w), n) for w, n in restorer.words(t)] for t in texts]
    chosen = sorted({f for own in every for fs, _ in own for f in fs})[:known]
    inputs, at = toxicity.Inputs(toxicity.Restorer(costs), chosen), {f: k for k, f in enumerate(chosen)}
    for text, own in zip(texts, every):
        total, shares = sum(n for _, n in own), {}
        for features, n in own:
            for f in features:
                if f in at:
                    shares[at[f]] = shares.get(at[f], 0) + n
        slots, x = inputs.of(text)
        assert {int(k): v for k, v in zip(slots[:-2], x[:-2])} == pytest.approx({k: math.sqrt(n / total) for k, n in shares.items()})
