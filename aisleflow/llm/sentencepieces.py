"""SentencePiece encoding and decoding by streaming Viterbi.

A text is the path of pieces with the largest sum of scores; a character no
piece starts with is spelled in byte pieces. The decoder reads characters in
order and keeps scores and backpointers of a window only. Positions within one
maximum piece length of the end can still be extended; when the backpointer
paths of all of them meet in one boundary, the ids before it are final and are
given out, and the window starts there.

Rules of the vocabulary cut a text beforehand where every path has to pass: before
a run of spaces, if no piece has a space after another character, around
characters that no longer piece holds, and between a letter and a sign that no
piece has behind a letter. Encoded cuts of a task are kept in
a memo of bounded size.

Ids are the best path under the scores of the model file, as the library gives
for a unigram model. For a BPE model file, whose scores are merge ranks, that is
not the order of merges the library's BPE encoder follows.

Defined cases: null has null ids; an empty text has none; among paths of equal
score the earlier piece start wins; decoding gives the text back but for U+2581,
which stands for a space in pieces. Rows are kept as often as they come; other
columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from aisleflow.llm.common import work_groups

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
BATCH_BYTES = 2_000_000
MEMO_CHARS = 64
MEMO_PARTS = 500_000


class Vocabulary:
    """Pieces, scores and byte pieces of a model file given as bytes."""

    def __init__(self, model: bytes):
        read = sentencepiece.SentencePieceProcessor(model_proto=model)
        if read.normalize("ﬁ  x") != f"{SPACE}ﬁ{SPACE}{SPACE}x":
            raise ValueError("only models that keep characters and spaces and put one space first are supported")
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [read.unk_id()] * 256
        for i in range(read.get_piece_size()):
            piece = read.id_to_piece(i)
            if read.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif read.is_control(i) or read.is_unknown(i) or read.is_unused(i):
                self.bytes_of.append(b"" if not read.is_unknown(i) else " ⁇ ".encode())
            else:
                self.pieces[piece] = (i, read.get_score(i))
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.unknown = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces), default=1)
        self.trie: dict = {}  # by character; at "" the score of the piece that ends there
        for piece, (_, score) in self.pieces.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score

    @cached_property
    def cuts(self) -> re.Pattern:
        """Splits a text into parts that no piece crosses."""
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            return re.compile(r"(?s).+")
        longer = [p for p in self.pieces if len(p) > 1]
        inner = {c for p in longer for c in p} - {SPACE}
        letters = {c for c in inner if c.isalpha()}
        after_letters = {b for p in longer for a, b in zip(p, p[1:]) if a in letters}
        many = lambda chars: f"[{''.join(map(re.escape, sorted(chars)))}]"
        parts = [f"{SPACE}+", "."]
        if inner:
            parts.insert(0, f"{SPACE}*{many(inner)}+")
        if letters and inner - letters - after_letters:  # a word ends before a sign that no piece has behind a letter
            parts.insert(0, f"{SPACE}*{many(letters)}++(?={many(inner - letters - after_letters)})")
        return re.compile("(?s)" + "|".join(parts))

    def ids_of(self, piece: str) -> list[int]:
        known = self.pieces.get(piece)
        return [known[0]] if known else [self.byte_ids[b] for b in piece.encode()]


def extend(v: Vocabulary, text: str, start: int, end: int, score: list[float], back: list[int]) -> None:
    """Let the best paths that end at positions from start to end go on by one piece."""
    never, size = float("-inf"), len(text)
    score += [never] * (size + 1 - len(score))
    back += [0] * (size + 1 - len(back))
    for i in range(start, end):
        base, node, j = score[i], v.trie, i
        while j < size:
            node = node.get(text[j])
            j += 1
            if node is None:
                break
            own = node.get("")
            if own is not None and base + own > score[j]:
                score[j], back[j] = base + own, i
        if score[i + 1] == never or "" not in v.trie.get(text[i], {}) and base + v.unknown > score[i + 1]:
            score[i + 1], back[i + 1] = base + v.unknown, i


class StreamingViterbi:
    """Best path over characters fed in chunks, with ids given out as soon as they are final."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text, self.score, self.back, self.done = "", [0.0], [0], 0
        self.widest = 0

    def feed(self, chunk: str) -> list[int]:
        """Take more characters; the ids that they made final."""
        out: list[int] = []
        for at in range(0, len(chunk), self.v.longest):  # the window stays small whatever a chunk holds
            self.text += chunk[at : at + self.v.longest]
            self._advance(len(self.text) - self.v.longest + 1)
            out += self._commit(self._meeting())
        return out

    def finish(self) -> list[int]:
        """The ids of what is left."""
        self._advance(len(self.text))
        return self._commit(len(self.text))

    def _advance(self, end: int) -> None:
        if end > self.done:
            extend(self.v, self.text, self.done, end, self.score, self.back)
            self.done = end
        self.widest = max(self.widest, len(self.text))

    def _meeting(self) -> int:
        """The last boundary that the paths of all positions which can be extended share."""
        alive = {i for i in range(max(0, self.done - self.v.longest), len(self.score)) if self.score[i] > float("-inf")}
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(self.back[last])
        return alive.pop() if alive else 0

    def _commit(self, end: int) -> list[int]:
        if not end:
            return []
        bounds, at = [end], end
        while at:
            at = self.back[at]
            bounds.append(at)
        bounds.reverse()
        out = [i for a, b in zip(bounds, bounds[1:]) for i in self.v.ids_of(self.text[a:b])]
        base = self.score[end]
        self.text, self.done = self.text[end:], max(0, self.done - end)
        self.score = [s - base for s in self.score[end:]]
        self.back = [0, *(b - end for b in self.back[end + 1 :])]
        return out


class Parts(dict):
    """Ids of parts that no piece crosses the ends of; a bounded memo, forgetting costs time only."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary

    def __missing__(self, part: str) -> tuple[int, ...]:
        if len(part) > MEMO_CHARS:
            stream = StreamingViterbi(self.v)
            return tuple(stream.feed(part) + stream.finish())
        if len(self) >= MEMO_PARTS:
            self.clear()
        ids = self[part] = _short(self.v, part)
        return ids


class Encoder(dict):
    """Ids of words with the space before them, put together from parts; a memo like that of parts."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v, self.parts = vocabulary, Parts(vocabulary)
        self.words_apart = not any(SPACE in p.lstrip(SPACE) for p in vocabulary.pieces)

    def _cut(self, marked: str) -> list[str]:
        return self.v.cuts.findall(marked)

    def __missing__(self, word: str) -> tuple[int, ...]:
        parts = self._cut(SPACE + word)
        ids = tuple(chain.from_iterable(map(self.parts.__getitem__, parts)))
        if len(parts) <= 2 and len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_PARTS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if self.words_apart and text[0] != " " and "  " not in text and SPACE not in text:
            found = map(self.__getitem__, text.split(" "))
        else:  # runs of spaces are parts of their own
            found = map(self.parts.__getitem__, self._cut(SPACE + text.replace(" ", SPACE)))
        return np.fromiter(chain.from_iterable(found), np.int32)


def _short(v: Vocabulary, part: str) -> tuple[int, ...]:
    """The ids of a part that the window holds as a whole."""
    score, back, at = [0.0], [0], len(part)
    extend(v, part, 0, at, score, back)
    ids: list[int] = []
    while at:
        ids += v.ids_of(part[back[at] : at])[::-1]
        at = back[at]
    return tuple(ids[::-1])


def stream_ids(vocabulary: Vocabulary, chunks: Iterable[str]) -> Iterator[int]:
    """Ids of one text given in chunks, each as soon as it is final, in memory that its length does not change."""
    stream, first = StreamingViterbi(vocabulary), True
    for chunk in chunks:
        if chunk:
            yield from stream.feed((SPACE if first else "") + chunk.replace(" ", SPACE))
            first = False
    yield from stream.finish()


def decode_ids(vocabulary: Vocabulary, ids: Iterable[int]) -> str:
    """The text of ids: byte pieces joined, spaces restored, the leading one taken off."""
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def _encoded(model):
    def run(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(Vocabulary(model.value))
            texts = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in work_groups(sizes, BATCH_BYTES):
                part = texts.slice(a, b - a).to_pylist()
                ids = [None if t is None else encoder.encode(t) for t in part]
                same = [None if t is None else decode_ids(encoder.v, i.tolist()) == t for t, i in zip(part, ids)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "round_trip"],
                )

    return run


def _decoded(model):
    def run(batches):
        v = Vocabulary(model.value)
        for batch in batches:
            ids = batch.column("ids")
            texts = [None if i is None else decode_ids(v, i) for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: doc_id, ids, and whether decoding them gives the text back. The file is read on the driver."""
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_encoded(model), f"doc_id {kind}, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id and the text of its ids."""
    model = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(model), f"doc_id {kind}, text string")
