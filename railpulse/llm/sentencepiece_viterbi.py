"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Method. A text, with a space put before it and spaces shown as U+2581, falls
into units of a space run and the characters up to the next space; no piece
crosses a unit's end. Distinct units of equal length advance together: length by
length, rolling hashes of all substrings that still begin a piece probe the
sorted hash keys of the pieces' beginnings (a hit is confirmed by its last
character and the hit before it, so no collision passes), and the best score at
every end position is a vectorised maximum that keeps the length of its last
piece. A character without a piece becomes byte pieces. Decoding gathers piece bytes and drops the first space, so
every text comes back exactly; U+2581 itself is encoded as bytes.

Scores. A vocabulary of merge ranks has no probabilities; a piece of rank r
gets Zipf's log(1 / r), so that fewer and more frequent pieces win. A unigram
vocabulary's own scores are taken as they are.

Scale. A projection: no shuffle. The vocabulary (a file given by ``path``) is
read on the driver and shipped once, its size is the vocabulary's. A worker
remembers at most ``MEMORY`` units.

Defined cases: null and empty texts have no tokens and decode to the empty
text; repeated rows get a row each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import ragged_ranges, steps, texts

UNIT = re.compile(" *[^ ]+| +")
MARK = 0x2581  # shows a space
LITERAL = 0x110000  # a U+2581 of the text itself: no code point, matches no piece
BASE = np.uint64(0x9E3779B97F4A7C15)
MEMORY = 300_000
CELLS = 1 << 18  # characters per batch of equal-length units


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    # By length - 1, sorted by hash: the beginnings of that length of all pieces.
    keys: list[np.ndarray]
    before: list[np.ndarray]  # index of the beginning one character shorter
    last: list[np.ndarray]  # last character
    ids: list[np.ndarray]  # piece that ends here, or -1
    scores: list[np.ndarray]  # its score, or -inf
    byte_ids: np.ndarray
    byte_score: float
    piece_bytes: np.ndarray
    piece_starts: np.ndarray
    piece_lengths: np.ndarray


def mix(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (h + c.astype(np.uint64) + np.uint64(1)) * BASE


def load(path: str | None = None) -> Vocabulary:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
    n = sp.get_piece_size()
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    raw = {i: sp.get_score(i) for i in normal}
    # Merge ranks are whole numbers falling by one; character pieces come after
    # all merges, with one score below every rank.
    ranks = all(s == int(s) for s in raw.values())
    order = {i: r for r, i in enumerate(sorted(normal, key=lambda i: (-raw[i], i)), 1)}
    score = {i: -float(np.log(order[i])) if ranks else raw[i] for i in normal}
    names = {sp.id_to_piece(i): i for i in normal}
    beginnings = sorted({p[:n] for p in names for n in range(1, len(p) + 1)}, key=len)
    keys, before, last, ids, scores, place = [], [], [], [], [], {"": 0}
    for length in range(1, len(beginnings[-1]) + 1):
        own = [p for p in beginnings if len(p) == length]
        codes = np.array([[ord(c) for c in p] for p in own], dtype=np.uint32)
        h = np.zeros(len(own), dtype=np.uint64)
        for j in range(length):
            h = mix(h, codes[:, j])
        at = np.argsort(h, kind="stable")
        own = [own[i] for i in at]
        keys.append(h[at])
        before.append(np.array([place[p[:-1]] for p in own], dtype=np.int64))
        last.append(codes[at, -1])
        ids.append(np.array([names.get(p, -1) for p in own], dtype=np.int32))
        scores.append(np.array([score[names[p]] if p in names else -np.inf for p in own]))
        place.update(zip(own, range(len(own))))
    data = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
            else sp.id_to_piece(i).replace("▁", " ").encode() if i in score else b"" for i in range(n)]
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    byte_ids = np.zeros(256, dtype=np.int32)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[data[i][0]] = i
    return Vocabulary(keys, before, last, ids, scores, byte_ids, min(score.values()) - 10.0,
                      np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths)


def code_points(units: list[str], length: int) -> np.ndarray:
    """Positions by units, of units of one length."""
    codes = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32).reshape(len(units), length).T.copy()
    codes[codes == MARK] = LITERAL
    codes[codes == 0x20] = MARK
    return codes


def viterbi(codes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Units of one length (columns) -> (ids, counts): the tokens of all units
    one after another; -1 - c stands for a character c without a piece."""
    length, n = codes.shape
    flat = codes.ravel()
    most = min(length, len(v.keys))
    pieces = np.full((most, length * n), -1, dtype=np.int32)
    gains = np.full((most, length * n), -np.inf)
    gains[0] = v.byte_score
    alive, node, h = np.arange(length * n), np.zeros(length * n, dtype=np.int64), np.zeros(length * n, dtype=np.uint64)
    for size in range(1, most + 1):
        if size > 1:  # starts with room for one more character
            room = alive < (length - size + 1) * n
            alive, node, h = alive[room], node[room], h[room]
        character = flat[alive + (size - 1) * n]
        h = mix(h, character)
        keys = v.keys[size - 1]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = (keys[at] == h) & (v.last[size - 1][at] == character) & (v.before[size - 1][at] == node)
        alive, node, h = alive[hit], at[hit], h[hit]
        if not len(alive):
            most = size
            break
        ends = v.ids[size - 1][node]
        whole = ends >= 0
        pieces[size - 1, alive[whole]] = ends[whole]
        gains[size - 1, alive[whole]] = v.scores[size - 1][node[whole]]
    gains = gains.reshape(-1, length, n)
    best = np.zeros((length + 1, n))
    last = np.zeros((length + 1, n), dtype=np.int64)
    for end in range(1, length + 1):
        best[end] = -np.inf
        for size in range(min(end, most), 0, -1):  # of equal scores the longest last piece
            score = best[end - size] + gains[size - 1, end - size]
            better = score > best[end]
            np.copyto(best[end], score, where=better)
            np.copyto(last[end], size, where=better)
    none = np.iinfo(np.int32).min
    tokens = np.full((n, length), none, dtype=np.int32)
    at, rows, step = np.full(n, length), np.arange(n), 1
    counts = np.zeros(n, dtype=np.int64)
    while len(rows):
        size = last[at[rows], rows]
        at[rows] -= size
        place = at[rows] * n + rows
        found = pieces[size - 1, place]
        tokens[rows, length - step] = np.where(found >= 0, found, -1 - flat[place].astype(np.int32))
        counts[rows] = step
        rows, step = rows[at[rows] > 0], step + 1
    return tokens[tokens > none], counts


def encode_units(units: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, ids, counts): units in another order, their token ids one after
    another, and how many each has."""
    sizes = np.array([len(u) for u in units])
    order, ids, counts = [], [], []
    for length in np.unique(sizes).tolist():
        members = np.flatnonzero(sizes == length)
        step = max(1, CELLS // length)
        for a in range(0, len(members), step):
            own = members[a:a + step]
            codes = code_points([units[i] for i in own], length)
            tokens, count = viterbi(codes, v)
            tokens, count = with_bytes(tokens, count, v)
            order.append(own)
            ids.append(tokens)
            counts.append(count)
    return np.concatenate(order), np.concatenate(ids), np.concatenate(counts)


def with_bytes(tokens: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Replaces -1 - c by the byte pieces of the character c."""
    bare = np.flatnonzero(tokens < 0)
    if not len(bare):
        return tokens, counts
    points, which = np.unique(-1 - tokens[bare], return_inverse=True)
    data = [v.byte_ids[list(chr(MARK if c == LITERAL else c).encode())] for c in points.tolist()]
    size = np.array([len(d) for d in data])
    # Read from the byte pieces of these characters, followed by the tokens.
    source = np.concatenate((*data, tokens))
    starts, lengths = size.sum() + np.arange(len(tokens)), np.ones(len(tokens), dtype=np.int64)
    starts[bare], lengths[bare] = (np.cumsum(size) - size)[which], size[which]
    return source[ragged_ranges(starts, lengths)], np.add.reduceat(lengths, np.cumsum(counts) - counts)


class Encoder:
    """Encodes texts, remembering up to ``MEMORY`` units."""

    def __init__(self, vocabulary: Vocabulary, memory: int = MEMORY):
        self.v, self.memory = vocabulary, memory
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.lengths = np.zeros(0, dtype=np.int64)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts one after another, and how many
        each text has."""
        if len(self.known) > self.memory:
            self.forget()
        units = [UNIT.findall(" " + t) if t else [] for t in batch]
        flat = [u for own in units for u in own]
        new = list(set(flat).difference(self.known))
        if new:
            order, ids, sizes = encode_units(new, self.v)
            base = len(self.known)
            self.known.update(zip((new[i] for i in order.tolist()), range(base, base + len(new))))
            self.flat = np.concatenate((self.flat, ids))
            self.lengths = np.concatenate((self.lengths, sizes))
        known = self.known
        index = np.array(list(map(known.__getitem__, flat)), dtype=np.int64)
        starts = np.cumsum(self.lengths) - self.lengths
        sizes = self.lengths[index]
        of_text = np.repeat(np.arange(len(batch)), [len(u) for u in units])
        counts = np.bincount(of_text, weights=sizes, minlength=len(batch)).astype(np.int64)
        return self.flat[ragged_ranges(starts[index], sizes)], counts


def decode(ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> list[str]:
    """Texts of the ids; ``counts`` ids belong to each."""
    sizes = v.piece_lengths[ids]
    data = v.piece_bytes[ragged_ranges(v.piece_starts[ids], sizes)].tobytes()
    ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    return [data[a + 1:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _apply(docs: DataFrame, schema: str, make, path: str | None) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make(batches, shipped.value)

    return docs.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str | None = None, carry: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The ``carry`` columns of every row with its ``tokens`` array<int>."""
    types = dict(docs.dtypes)

    def make(batches, v):
        encoder = Encoder(v)
        for part in steps(batches, "_text"):
            ids, counts = encoder.encode(texts(part.column("_text")))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), tokens], [*carry, "tokens"])

    schema = ", ".join(f"{c} {types[c]}" for c in carry) + ", tokens array<int>"
    return _apply(docs.select(*carry, F.col("text").alias("_text")), schema, make, path)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded`` to rows of doc_id, text, tokens."""
    def make(batches, v):
        for part in steps(batches, "text"):
            tokens = part.column("tokens")
            counts = np.diff(tokens.offsets.to_numpy())
            back = decode(tokens.flatten().to_numpy(), counts, v)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], [*part.schema.names, "decoded"])

    return _apply(encoded.select("doc_id", "text", "tokens"), "doc_id long, text string, tokens array<int>, decoded string", make, path)
