"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Method. A text is cut into units by the vocabulary's pattern. The bytes of a unit map
one to one to printable characters, which is the alphabet of the tokenizers library's
BPE model; the model is built from a file of ranks, with every pair of tokens that
makes a token as a merge, so that it merges what a merge by ranks merges. Units are
remembered, so each distinct one of a task is merged once. A token's bytes give its
byte offsets by a prefix sum, and a prefix count of the bytes that begin a
character maps those to characters: a token that holds part of a character spans
all of it. Decoding looks the bytes of the ids up and joins them before it reads
characters, so that characters split over tokens come back whole.

Scale. Encoding and decoding are projections: no shuffle, one bounded slice of texts
in memory at a time. Long texts are cut where every match of the pattern ends.

Defined cases: a null text counts as the empty text, which has no tokens; an unknown
or null id decodes to nothing; a null list of ids to the empty text; a very long text
is encoded in parts with the same result (a run of letters without an end is one part);
rows that repeat give rows that repeat; an empty table gives an empty result; extra
columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import models

from railpulse.llm.common import ragged_ranges, steps, texts

RANKS = "byte_bpe_50k.tiktoken"
MEMORY = 400_000  # units remembered
PART = 1 << 20  # characters that are cut into units at a time
DECODED = 1 << 20  # ids that are decoded at a time
# Where every match ends and the next begins, whatever stands around it.
BOUNDARY = regex.compile(r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]|(?<=\S)\s")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters for
    themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Token bytes by id, and the encoder built from them where it is used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.size = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * self.size
        for token, i in ranks.items():
            self.tokens[i] = token
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        shown = byte_characters()
        self.table = {b: c for b, c in enumerate(shown) if chr(b) != c}
        self.merges = [(a, b) for t in self.tokens for a, b in ((t[:i], t[i:]) for i in range(1, len(t))) if a in ranks and b in ranks]
        self._encoder = None

    def characters(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.table)

    @property
    def encoder(self) -> Encoder:
        if self._encoder is None:
            self._encoder = Encoder(self)
        return self._encoder

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_encoder": None}


def load(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """From a file of ranks: per line a token in base64 and its id."""
    import public_tokenizers
    with open(path or public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(i) for token, i in map(bytes.split, lines)}
    return Vocabulary(ranks, pattern or public_tokenizers.PATTERN)


def parts(text: str, limit: int = PART) -> Iterator[str]:
    """The text in parts that are encoded apart."""
    start = 0
    while len(text) - start > limit:
        cut = BOUNDARY.search(text, start + limit)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class Encoder:
    """Encodes texts, remembering up to ``memory`` units."""

    def __init__(self, vocabulary: Vocabulary, memory: int = MEMORY):
        self.v, self.memory = vocabulary, memory
        self.units = regex.compile(vocabulary.pattern).findall
        self.model = models.BPE(vocab={vocabulary.characters(t): i for i, t in enumerate(vocabulary.tokens) if t},
                                merges=[(vocabulary.characters(a), vocabulary.characters(b)) for a, b in vocabulary.merges], ignore_merges=True)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.sizes = np.zeros(0, dtype=np.int64)

    def learn(self, units: Iterable[str]) -> None:
        merge, characters = self.model.tokenize, self.v.characters
        ids = [[t.id for t in merge(characters(u.encode()))] for u in units]
        self.flat = np.concatenate((self.flat, np.array([i for own in ids for i in own], dtype=np.int32)))
        self.sizes = np.concatenate((self.sizes, np.array([len(own) for own in ids], dtype=np.int64)))

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts one after another, and how many
        each text has."""
        ids, counts = [np.zeros(0, dtype=np.int32)], np.zeros(len(batch), dtype=np.int64)
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(batch):
            for part in parts(text):
                waiting.append((i, self.units(part)))
                size += len(part)
                if size > PART:
                    ids.append(self._flush(waiting, counts))
                    waiting, size = [], 0
        ids.append(self._flush(waiting, counts))
        return np.concatenate(ids), counts

    def _flush(self, waiting: list[tuple[int, list[str]]], counts: np.ndarray) -> np.ndarray:
        if len(self.known) > self.memory:
            self.forget()
        known, flat = self.known, [u for _, own in waiting for u in own]
        if new := list(set(flat).difference(known)):
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.learn(new)
        index = np.array(list(map(known.__getitem__, flat)), dtype=np.int64)
        starts, sizes = np.cumsum(self.sizes) - self.sizes, self.sizes[index]
        of_text = np.repeat([i for i, _ in waiting], [len(own) for _, own in waiting]).astype(np.int64)
        np.add.at(counts, of_text, sizes)
        return self.flat[ragged_ranges(starts[index], sizes)]


def decode(ids: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): the bytes of all ids one after another, and where those of
    each id end."""
    known = (ids >= 0) & (ids < v.size)
    at = np.where(known, ids, 0)
    lengths = np.where(known, v.lengths[at], 0) if v.size else np.zeros(len(ids), np.int64)
    return v.bytes[ragged_ranges(v.starts[at], lengths)] if len(ids) else v.bytes[:0], np.cumsum(lengths)


def spans(ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in characters of its text of every id; ``counts`` ids belong to
    each text."""
    data, ends = decode(ids, v)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters begun before a byte
    lengths = v.lengths[ids]
    first = np.repeat(np.concatenate(([0], ends))[np.cumsum(counts) - counts], counts)  # byte at which its text starts
    starts = ends - lengths
    # A token that starts inside a character starts where the character does, and one
    # that ends inside it ends where it ends.
    inside = (data[np.minimum(starts, max(0, len(data) - 1))] & 0xC0) == 0x80 if len(data) else np.zeros(0, bool)
    base = begins[first]
    return begins[starts] - inside - base, begins[ends] - base


def texts_of_tokens(ids: list[int], v: Vocabulary) -> list[str]:
    """What each id adds to the text: a character split over several ids comes
    with the last of them."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    out = [reader.decode(v.tokens[i] if 0 <= i < v.size else b"") for i in ids]
    if out and (rest := reader.decode(b"", final=True)):
        out[-1] += rest
    return out


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def list_sizes(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batch: pa.RecordBatch, limit: int = DECODED) -> Iterator[pa.RecordBatch]:
    """Parts of the batch that hold at most ``limit`` ids (or one row)."""
    ends, start = np.cumsum(list_sizes(batch.column("tokens"))), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, carry: tuple[str, ...] = ("doc_id",),
                     offsets: bool = False) -> DataFrame:
    """The ``carry`` columns of every row with its ``tokens`` array<int>, and with
    ``offsets`` their ``starts`` and ``ends`` in characters."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary or load())
    types = dict(docs.dtypes)
    names = ["tokens", "starts", "ends"] if offsets else ["tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shipped.value
        for part in steps(batches, "_text"):
            ids, counts = v.encoder.encode(texts(part.column("_text")))
            lists = [ids, *(spans(ids, counts, v) if offsets else ())]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), *(_lists(x, counts) for x in lists)], [*carry, *names])

    schema = [*(f"`{c}` {types[c]}" for c in carry), *(f"{c} array<int>" for c in names)]
    return docs.select(*carry, F.col("text").alias("_text")).mapInArrow(run, ", ".join(schema))


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Adds the bytes ``decoded`` to rows with ``tokens``; as text: cast to string."""
    shipped = encoded.sparkSession.sparkContext.broadcast(vocabulary or load())
    names = [c for c in encoded.columns if c != "decoded"]
    types = dict(encoded.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shipped.value
        for b in (part for whole in batches for part in slices(whole)):
            tokens = b.column("tokens")
            counts = list_sizes(tokens)
            ids = tokens.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            data, ends = decode(ids, v)
            at = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
            decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*b.columns, decoded.cast(pa.binary())], [*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in names), "decoded binary"]))
