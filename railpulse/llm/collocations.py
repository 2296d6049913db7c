"""Phrase collocation mining with Rabin-Karp fingerprints.

Method. The texts of a step lie lower-cased in one buffer, every word followed by one
byte. With prefix polynomials over its bytes (modulo 2^64, an odd base) the
fingerprint of any run of words is a difference of two prefixes times an inverse
power; numpy computes those of all n-grams at once, and the language is mixed in.
Fingerprints are counted per task and summed in a shuffle. An n-gram of three words
or more is counted only where both n-grams of one word less within it are frequent, as
no other one can be. The frequent fingerprints become a bit set of bounded size, and
only n-grams that hit it are materialised: within a step every occurrence is
compared byte by byte with the first one of its fingerprint (those that differ form
groups of their own), then texts, not fingerprints, are the keys that sum the counts
and the smallest document that has the phrase. So a collision, of fingerprints or
in the bit set, costs a row and never changes a count.

Scale. The texts are read once for words and pairs, once for each longer length, and once to
materialise; only 16-byte rows are shuffled for n-grams that are not
frequent. Counts are combined in numpy and by the partial aggregate before each
shuffle, so a phrase that fills a third of the input is a row per task. The bit set has
at most 2^27 bits; beyond some 30 million frequent phrases it lets more others
through, which the counts by text remove. Joins are between frequent phrases only.

Defined cases: a null text counts as the empty one and has no words, a null language
as ``und``; rows that repeat count each time; a very long text is read in parts that
overlap by the words of a phrase less one; equal scores rank by count, then by
phrase in byte order; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from railpulse.llm.bitset import bit_set, hit
from railpulse.llm.common import materialise, ragged_ranges, steps, texts

SHORTEST, LONGEST = 2, 3
LEAST = 10
KEEP = 2000
COVER = 50  # per cent of a phrase's occurrences that lie within one longer phrase
STEP = 1 << 20  # bytes of text in one buffer
PENDING = 1 << 20  # fingerprints that a task sorts at a time
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b" \t"
SEPARATOR = re.compile(rb"[ \t.,;:!?\x0a-\x0d]")
WORD, SPACE, END = 0, 1, 2
KIND = np.full(256, WORD, dtype=np.uint8)
KIND[list(SPACES)], KIND[list(ENDS)] = SPACE, END
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps_ = np.full((2, n), [[BASE], [INVERSE]], dtype=np.uint64)
            steps_[:, 0] = 1
            self.up, self.down = np.multiply.accumulate(steps_, axis=1)
        return self.up[:n], self.down[:n]


@dataclass
class Words:
    """Words of several texts: their places in ``data``, the piece and the text that
    each is of, and the prefix polynomial."""
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    prefix: np.ndarray
    down: np.ndarray
    raw_start: np.ndarray  # place in the text itself, where there is one text
    known: int = 0  # words at the beginning that were counted before

    @classmethod
    def of(cls, raw: list[bytes], powers: Powers) -> Words:
        sizes = np.array([len(t) + 1 for t in raw], dtype=np.int64)
        flat = np.frombuffer(b"\n".join([*raw, b""]).translate(LOWER), dtype=np.uint8)
        kind = KIND[flat]
        word = kind == WORD
        edge = np.diff(word.astype(np.int8), prepend=0)
        first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        keep = word.copy()
        keep[after] = True
        data = flat.copy()
        data[after] = 32
        data = np.concatenate((data[keep], np.zeros(8, np.uint8)))
        length = after - first
        start = np.cumsum(length + 1) - length - 1
        piece = np.cumsum(kind == END)[first] if len(first) else first
        up, down = powers.of(len(data) + 1)
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
        text = np.searchsorted(np.cumsum(sizes), first, side="right")
        return cls(data, start, start + length, piece, text, prefix, down, first)

    def grams(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie within a piece and were not counted
        before."""
        if len(self.start) < n:
            return np.zeros(0, dtype=np.int64)
        last = len(self.start) - n + 1
        inside = self.piece[:last] == self.piece[n - 1:]
        inside[:max(0, self.known - n + 1)] = False
        return np.flatnonzero(inside)

    def fingerprints(self, at: np.ndarray, n: int, seeds: np.ndarray) -> np.ndarray:
        start, end = self.start[at], self.end[at + n - 1]
        h = (self.prefix[end] - self.prefix[start]) * self.down[start] ^ seeds[self.text[at]]
        h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ h >> np.uint64(33)


def buffers(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[Words, list[str], np.ndarray]]:
    """(words, language and id of each text) of bounded parts of the texts."""
    powers = Powers()
    for part in steps(batches, "text", STEP):
        langs = part.column("lang").to_pylist()
        ids = part.column("doc_id")
        raw = [t.encode() for t in texts(part.column("text"))]
        if len(raw) > 1 or len(raw[0]) <= 2 * STEP:
            yield Words.of(raw, powers), langs, ids
            continue
        # One long text: parts end after a word and begin with the words before it that
        # a phrase may still need.
        text, at, known, done = raw[0], 0, 0, 0
        while True:
            cut = SEPARATOR.search(text, max(at + STEP, done + 1)) if len(text) - at > 2 * STEP else None
            words = Words.of([text[at:cut.start() if cut else len(text)]], powers)
            words.known = known
            yield words, langs, ids
            if not cut:
                break
            done, known = cut.start(), min(longest - 1, len(words.start))
            at = at + int(words.raw_start[-known]) if known else done


def seeds_of(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x.encode(), 5) for x in langs], dtype=np.uint64)


def frequent(rows: DataFrame, sizes: list[int], longest: int, least: int, known: np.ndarray | None) -> DataFrame:
    """(fp): fingerprints of n-grams of the ``sizes`` that occur ``least`` times or
    more. With ``known`` bits only n-grams are counted of which both n-grams of
    one word less hit them."""
    shipped = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, pending, size = shipped.value, [], 0

        def counted() -> pa.RecordBatch:
            fps, n = np.unique(np.concatenate(pending), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.array(n)], ["fp", "n"])

        for words, langs, _ in buffers(batches, longest):
            seeds = seeds_of(langs)
            for n in sizes:
                at = words.grams(n)
                if bits is not None and len(at):
                    # The n-gram at a place holds the shorter ones there and at the next place.
                    shorter = np.arange(len(words.start) - n + 2)
                    common = hit(bits, words.fingerprints(shorter, n - 1, seeds))
                    at = at[common[at] & common[at + 1]]
                pending.append(words.fingerprints(at, n, seeds))
                size += len(at)
            if size > PENDING:
                yield counted()
                pending, size = [], 0
        if size:
            yield counted()

    return rows.mapInArrow(run, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("fp")


def equal(words: Words, start: np.ndarray, size: np.ndarray, other: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Whether the bytes at two places are the same, pair by pair."""
    same = size == other_size
    eight = np.ndarray((max(0, len(words.data) - 7),), dtype="<u8", buffer=words.data, strides=(1,))
    todo, done = np.flatnonzero(same), 0
    while len(todo) and done < 256:
        left = np.minimum(size[todo] - done, 8)
        mask = np.where(left == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * (left % 8)).astype(np.uint64)) - np.uint64(1))
        ok = (eight[start[todo] + done] ^ eight[other[todo] + done]) & mask == 0
        same[todo[~ok]] = False
        done += 8
        todo = todo[ok & (size[todo] > done)]
    for i in todo.tolist():  # very long words
        same[i] = np.array_equal(words.data[start[i]:start[i] + size[i]], words.data[other[i]:other[i] + size[i]])
    return same


def groups(words: Words, fps: np.ndarray, start: np.ndarray, size: np.ndarray, lang: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first occurrence, group of each occurrence or -1) of the occurrences with
    the same fingerprint, language and bytes; several times if fingerprints collide."""
    left = np.arange(len(fps))
    while len(left):
        _, first, of = np.unique(fps[left], return_index=True, return_inverse=True)
        head = left[first[of]]
        same = equal(words, start[left], size[left], start[head], size[head]) & (lang[left] == lang[head])
        group = np.full(len(fps), -1)
        group[left[same]] = of[same]
        yield left[first], group
        left = left[~same]


def materialised(rows: DataFrame, longest: int, least: int, bits: np.ndarray) -> DataFrame:
    """(lang, phrase, f, first_doc_id) of all phrases of up to ``longest`` words that
    occur ``least`` times or more, and of every language a row without a phrase
    with the number of its words."""
    shipped = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "f", "doc_id"]
        total: dict[str, int] = {}
        for words, langs, ids in buffers(batches, longest):
            seeds = seeds_of(langs)
            codes = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            code = np.array([codes[x] for x in langs], dtype=np.int64)
            spelled = list(codes)
            for x, n in zip(spelled, np.bincount(code[words.text[words.known:]], minlength=len(codes)).tolist()):
                total[x] = total.get(x, 0) + n
            none = np.iinfo(np.int64).max
            ids = np.where(ids.is_null().to_numpy(zero_copy_only=False), none, ids.fill_null(0).to_numpy(zero_copy_only=False))
            for n in range(1, longest + 1):
                at = words.grams(n)
                fps = words.fingerprints(at, n, seeds)
                chosen = hit(shipped.value, fps)
                at, fps = at[chosen], fps[chosen]
                if not len(at):
                    continue
                start, size, text = words.start[at], words.end[at + n - 1] - words.start[at], words.text[at]
                for first, group in groups(words, fps, start, size, code[text]):
                    of = group[group >= 0]
                    smallest = np.full(len(first), none)
                    np.minimum.at(smallest, of, ids[text[group >= 0]])
                    ends = np.concatenate(([0], np.cumsum(size[first]))).astype(np.int64)
                    spelling = words.data[ragged_ranges(start[first], size[first])]
                    phrases = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(spelling)).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(spelled, pa.string()).take(pa.array(code[text[first]])), phrases, pa.array(np.bincount(of, minlength=len(first))),
                        pa.array(smallest, mask=smallest == none)], names)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.nulls(len(total), pa.string()),
                                          pa.array(list(total.values()), pa.int64()), pa.nulls(len(total), pa.int64())], names)

    found = rows.mapInArrow(run, "lang string, phrase string, f long, doc_id long")
    found = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.min("doc_id").alias("first_doc_id"))
    return found.where((F.col("f") >= least) | F.col("phrase").isNull())


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """As ``materialised``, written to the shared folder."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    levels = [materialise(frequent(rows, [1, 2], longest, least, None), "collocations_pairs")]
    bits = bit_set(levels[0])
    for n in range(3, longest + 1):
        levels.append(materialise(frequent(rows, [n], longest, least, bits), f"collocations_{n}"))
        every = levels[0]
        for level in levels[1:]:
            every = every.union(level)
        bits = bit_set(every)
    return materialise(materialised(rows, longest, least, bits), "collocations_phrases")


def collocations(docs: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, least: int = LEAST, keep: int = KEEP,
                 cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, first_doc_id: per language the ``keep``
    phrases whose least tightly bound cut is bound most tightly, score =
    floor(1,000,000 a a / (l r)), left out those that a longer phrase covers."""
    counts = phrase_counts(docs, longest, least)
    phrases = counts.where("phrase is not null")
    totals = counts.where("phrase is null").select(F.col("lang").alias("t_lang"), F.col("f").alias("n"))
    words = F.split("phrase", " ", -1)
    candidates = phrases.withColumn("words", words).where(F.size("words") >= shortest)
    k, size = F.col("k"), F.size("words")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "first_doc_id", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "first_doc_id", "k", F.array_join(F.slice("words", F.lit(1), k), " ").alias("left"),
                       F.array_join(F.slice("words", k + 1, size - k), " ").alias("right"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Counts of 15 digits: a times a times 1,000,000 has 37.
    score = F.expr("cast(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)) as decimal(38,0)) "
                   "div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    scored = cuts.groupBy("lang", "phrase", "a", "first_doc_id").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = candidates.where(size > shortest)
    at = F.explode(F.flatten(F.transform(F.sequence(F.lit(shortest), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " ")))))
    around = longer.select(F.col("lang").alias("c_lang"), at.alias("c_phrase"), F.col("f").alias("longer_f")) \
        .groupBy("c_lang", "c_phrase").agg(F.max("longer_f").alias("longer_f"))
    kept = scored.join(around, (F.col("lang") == F.col("c_lang")) & (F.col("phrase") == F.col("c_phrase")), "left") \
        .where(F.col("longer_f").isNull() | (F.lit(100) * F.col("longer_f") < F.lit(cover) * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return ranked.join(totals, F.col("lang") == F.col("t_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"), "first_doc_id")
