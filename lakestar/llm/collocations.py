"""Phrase collocation mining with mergeable Misra-Gries summaries.

N-grams are dealt to hash parts. Every task summarises its n-grams of each
part, the parts' summaries are merged, and both keep more counters than the
part's mass (its n-grams with repeats) divided by the threshold. So what a
summary has taken from its counters, its error, stays below the threshold,
and an n-gram that is frequent keeps a counter (Agarwal et al., "Mergeable
summaries", 2012). N-grams whose counter and the part's error reach the
threshold are marked in a bit map; a second pass counts those exactly, by
their words.

An n-gram is as frequent at most as the n-grams within it: pairs are only
summarised where both words are marked, longer n-grams where all their pairs
are. The bit maps have a fixed size; full ones cost time, not phrases.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, seeded, ship
from .grams import Cutter, Run, mix, part_of, summed

WORDS = 5  # in a phrase, at most
MAP_BITS = 1 << 28  # of a map of marked n-grams, at most: 32 MB
MARKS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t" + MARKS
RUN_BYTES = 2 << 20  # of texts that are worked on at a time
HELD = 3_000_000  # counters of a task's summaries before it sends them
SALTS = 64


class Words:
    """A run's words with their languages, and which of them are neighbours in a piece."""

    def __init__(self, run: Run, langs: list[str]):
        self.run, self.langs = run, langs[run.first:run.first + run.rows]
        marks = np.r_[0, np.cumsum(IS_MARK[run.data])][run.starts]
        self.joined = (marks[1:] == marks[:-1]) & (run.row[1:] == run.row[:-1])
        names = {x: mix(int.from_bytes(x.encode(), "little") % (1 << 61), len(x)) for x in set(self.langs)}
        self.hashes = mix(run.hashes, np.array([names[x] for x in self.langs], np.uint64)[run.row])

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the n-grams within pieces that end in a new word."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        good, h = np.ones(n, bool), self.hashes[:n]
        for k in range(1, size):
            good &= self.joined[k - 1:n + k - 1]
            h = mix(h, self.hashes[k:n + k])
        good[:max(0, self.run.old - size + 1)] = False
        at = np.flatnonzero(good)
        return at, mix(h[at], size)

    def phrases(self, at: np.ndarray, size: int) -> list[str]:
        raw, starts, stops = self.run.data.tobytes(), self.run.starts, self.run.stops
        cuts = [list(zip(starts[at + k].tolist(), stops[at + k].tolist())) for k in range(size)]
        return [b" ".join([raw[i:j] for i, j in words]).decode("utf-8", "replace") for words in zip(*cuts)]


IS_MARK = np.zeros(256, bool)
IS_MARK[list(MARKS)] = True


def runs_of_words(batches, run_bytes: int):
    cutter = Cutter(GAPS, WORDS - 1, run_bytes)
    for b in batches:
        langs = b.column("lang").to_pylist()
        for run in cutter(b.column("text")):
            yield Words(run, langs)


# -- bit maps of marked n-grams -----------------------------------------------------

def is_marked(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = part_of(hashes, len(bits) * 8)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def open_grams(words: Words, sizes, words_map, pairs_map):
    """(size, starts, hashes) of the n-grams whose parts the maps leave possible."""
    good = pair = None
    if words_map is not None:
        good = is_marked(mix(words.hashes, 1), words_map)
    if pairs_map is not None:
        pair = is_marked(mix(mix(words.hashes[:-1], words.hashes[1:]), 2), pairs_map)
    for size in sizes:
        at, h = words.grams(size)
        keep = np.ones(len(at), bool)
        for k in range(size) if size > 1 and good is not None else ():
            keep &= good[at + k]
        for k in range(size - 1) if size > 2 and pair is not None else ():
            keep &= pair[at + k]
        yield size, at[keep], h[keep]


# -- first pass: summaries ------------------------------------------------------------

def keys_in_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The 32 bits after those that tell the part (a power of two of parts).
    N-grams that share them share a counter, which can only be too high."""
    return (hashes >> np.uint64(33 - parts.bit_length())).astype(np.uint32)


class Summary:
    """Misra-Gries counters of one hash part, kept in order of the keys."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        self.error += error
        self.hashes, self.counts = summed(np.r_[self.hashes, hashes], np.r_[self.counts, counts])
        over = len(self.counts) - self.capacity
        if over > 0:
            # Take the largest counter that doesn't fit from all: each unit
            # taken costs more than ``capacity`` occurrences.
            least = int(np.partition(self.counts, over - 1)[over - 1])
            left = self.counts > least
            self.hashes, self.counts, self.error = self.hashes[left], self.counts[left] - least, self.error + least


def mass_counter(parts: int, run_bytes: int):
    """A task's words of each language, and n-grams of each size and part."""
    def run(batches):
        words: Counter = Counter()
        mass = np.zeros((WORDS + 1, parts), np.int64)
        for found in runs_of_words(batches, run_bytes):
            for size in range(1, WORDS + 1):
                at, h = found.grams(size)
                mass[size] += np.bincount(part_of(h, parts).astype(np.int64), minlength=parts)
                if size == 1:
                    for i, n in enumerate(np.bincount(found.run.row[at], minlength=found.run.rows).tolist()):
                        words[found.langs[i]] += n
        size, part = np.nonzero(mass)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * len(size) + list(words), pa.string()), pa.array(np.r_[size, np.zeros(len(words), int)], pa.int32()),
             pa.array(np.r_[part, np.zeros(len(words), int)], pa.int32()), pa.array(np.r_[mass[size, part], np.array(list(words.values()), int)], pa.int64())],
            ["lang", "size", "part", "mass"])
    return run


SUMMARY_DDL = "part int, size int, packed binary, error long"


def summary_row(part: int, s: Summary):
    """The keys' steps byte by byte, counts in a byte each and those of 255 and more after them, packed."""
    steps = np.diff(s.hashes, prepend=np.uint32(0)).astype("<u4").view("u1").reshape(-1, 4).T
    large = s.counts[s.counts >= 255].astype("<i8")
    packed = zstandard.compress(steps.tobytes() + np.minimum(s.counts, 255).astype("u1").tobytes() + large.tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(s.hashes)], pa.int32()), pa.array([packed]),
                                       pa.array([s.error], pa.int64())], ["part", "size", "packed", "error"])


def read_summary(r):
    raw, n = np.frombuffer(zstandard.decompress(r["packed"]), "u1"), r["size"]
    keys = np.cumsum(raw[:4 * n].reshape(4, n).T.copy().view("<u4").ravel(), dtype=np.uint32)
    counts = raw[4 * n:5 * n].astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[5 * n:].tobytes(), "<i8")
    return keys, counts, r["error"]


def summariser(sizes, capacity, words_map, pairs_map, run_bytes: int):
    """Each task's summaries; they are sent and begun anew when they hold ``HELD`` counters.

    With a map of pairs, the words of marked pairs are sent, too, as parts
    beyond the n-grams': no other words are needed for scores.
    """
    def run(batches):
        most = capacity.value
        parts = len(most)
        needed = np.zeros(0, np.uint64)

        def send():
            for p, s in mine.items():
                yield summary_row(p, s)
            part = part_of(needed, parts).astype(np.int64)
            keys = keys_in_part(needed, parts)
            for p in np.unique(part):
                s = Summary(len(needed))
                s.hashes, s.counts = keys[part == p], np.ones((part == p).sum(), np.int64)
                yield summary_row(parts + int(p), s)

        maps = [m and m.value for m in (words_map, pairs_map)]
        mine: dict[int, Summary] = {}
        held = 0
        for words in runs_of_words(batches, run_bytes):
            h = np.concatenate([h for _, _, h in open_grams(words, sizes, *maps)])
            if maps[1] is not None:
                at, pairs = words.grams(2)
                at = at[is_marked(pairs, maps[1])]
                needed = np.union1d(needed, mix(words.hashes[np.r_[at, at + 1]], 1))
            hashes, counts = np.unique(h, return_counts=True)
            part, keys = part_of(hashes, len(most)).astype(np.int64), keys_in_part(hashes, len(most))
            edges = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)] if len(part) else np.zeros(1, int)
            for i, j in zip(edges[:-1], edges[1:]):
                s = mine.setdefault(int(part[i]), Summary(int(most[part[i]])))
                held -= len(s.hashes)
                s.merge(keys[i:j], counts[i:j])
                held += len(s.hashes)
            if held + len(needed) > HELD:
                yield from send()
                mine, held, needed = {}, 0, needed[:0]
        yield from send()
    return run


def merger(capacity, threshold: int, bits: int):
    """Merges the summaries of a part; its row is the part's range of the bit map."""
    def run(batches):
        most = capacity.value
        width = bits // len(most)

        def marked(part, s):
            rows = s.hashes if part >= len(most) else s.hashes[s.counts + s.error >= threshold]
            out = np.zeros(width, bool)
            out[rows >> np.uint32(33 - width.bit_length())] = True  # the bits after the part's in the map
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(out, bitorder="little").tobytes()]),
                                               pa.array([len(rows)], pa.int64())], ["part", "bits", "marked"])

        part, s = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["part"] != part:
                    if s is not None:
                        yield marked(part, s)
                    part = r["part"]
                    s = Summary(int(most[part]) if part < len(most) else 1 << 32)
                s.merge(*read_summary(r))
        if s is not None:
            yield marked(part, s)
    return run


# -- second pass: exact counts -----------------------------------------------------------

EXACT_DDL = "part int, langs array<string>, sizes array<int>, counts array<long>, phrases binary"


class Exact:
    """A task's counts of n-grams by hash, with the words of each."""

    def __init__(self):
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.words = np.zeros(0, object)

    def add(self, hashes: np.ndarray, counts: np.ndarray, words) -> None:
        """``words(i)``: (lang, phrase, size) of the hashes at ``i``; asked for new ones only."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        self.counts[at[known]] += counts[known]
        new = np.flatnonzero(~known)
        if len(new):
            told = np.empty(len(new), object)
            told[:] = words(new)
            order = np.argsort(merged := np.r_[self.hashes, hashes[new]], kind="stable")
            self.hashes, self.counts = merged[order], np.r_[self.counts, counts[new]][order]
            self.words = np.concatenate([self.words, told])[order]

    def rows(self, parts: int):
        """One row a hash part; no phrase has a line end in it."""
        part = part_of(self.hashes, parts).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, int)
        cuts = pa.array(np.r_[edges, len(part)], pa.int32())
        langs, phrases, sizes = zip(*self.words) if len(part) else ((), (), ())
        columns = [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(self.counts, pa.int64())]
        packed = [zstandard.compress("\n".join(phrases[i:j]).encode(), 3) for i, j in zip(edges, np.r_[edges[1:], len(part)])]
        return pa.RecordBatch.from_arrays([pa.array(part[edges], pa.int32()), *[pa.ListArray.from_arrays(cuts, c) for c in columns], pa.array(packed, pa.binary())],
                                          ["part", "langs", "sizes", "counts", "phrases"])


def exact_counter(maps, parts: int, run_bytes: int):
    """Each task's counts of the marked n-grams, by part."""
    def run(batches):
        words_map, pairs_map, long_map, needed = (m.value for m in maps)
        mine = Exact()
        for found in runs_of_words(batches, run_bytes):
            for size, at, h in open_grams(found, range(1, WORDS + 1), words_map, pairs_map):
                keep = is_marked(h, needed if size == 1 else pairs_map if size == 2 else long_map)
                at = at[keep]
                hashes, first, n = np.unique(h[keep], return_index=True, return_counts=True)

                def words(i, at=at, first=first, size=size):
                    places = at[first[i]]
                    return [(found.langs[r], p, size) for r, p in zip(found.run.row[places].tolist(), found.phrases(places, size))]

                mine.add(hashes, n, words)
            if len(mine.hashes) > HELD // 6:
                yield mine.rows(parts)
                mine = Exact()
        yield mine.rows(parts)
    return run


def exact_merger(threshold: int):
    """The frequent n-grams of a part, counted by their words."""
    def frequent(counts):
        rows = [(*k, n) for k, n in counts.items() if n >= threshold]
        langs, phrases, sizes, n = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32()),
                                           pa.array(n, pa.int64())], ["lang", "phrase", "size", "a"])

    def run(batches):
        part, counts = None, Counter()
        for b in batches:
            for i, p in enumerate(b.column("part").to_pylist()):
                if p != part:
                    yield frequent(counts)
                    part, counts = p, Counter()
                langs, sizes, n = (b.column(c)[i].as_py() for c in ("langs", "sizes", "counts"))
                phrases = zstandard.decompress(b.column("phrases")[i].as_py()).decode().split("\n")
                for *k, x in zip(langs, phrases, sizes, n):
                    counts[tuple(k)] += x
        yield frequent(counts)
    return run


def power_of_two(x: int) -> int:
    return 1 << max(0, (x - 1).bit_length())


def frequent_phrases(docs: DataFrame, scratch: Scratch, *, text: str, lang: str, threshold: int, counters: int,
                     run_bytes: int) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, a) of every n-gram of 2 to WORDS words that
    occurs ``threshold`` times and of their words, (lang, n) of all words)."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(power_of_two(-(-size // (2 * threshold * counters))), 1 << 20)  # a text has a word in two bytes at most
    mass = scratch.keep(rows.mapInArrow(mass_counter(parts, run_bytes), "lang string, size int, part int, mass long")
                        .groupBy("lang", "size", "part").agg(F.sum("mass").alias("mass")), "mass")
    words = mass.where("size = 0").select("lang", F.col("mass").alias("n"))
    table = np.zeros((WORDS + 1, parts), np.int64)
    for r in mass.where("size > 0").collect():
        table[r["size"], r["part"]] = r["mass"]

    def summarise(sizes, words_map=None, pairs_map=None):
        room = table[list(sizes)].sum(axis=0) // threshold + 1
        bits = max(8 * parts, min(MAP_BITS, power_of_two(32 * int(room.sum()))))
        capacity = share(room)
        found = (rows.mapInArrow(summariser(sizes, capacity, words_map, pairs_map, run_bytes), SUMMARY_DDL)
                 .repartition("part").sortWithinPartitions("part")
                 .mapInArrow(merger(capacity, threshold, bits), "part int, bits binary, marked long").collect())
        width = bits // parts // 8
        marks = np.zeros((2, bits // 8), np.uint8)
        for r in found:
            at = r["part"] % parts * width
            marks[r["part"] // parts, at:at + width] = np.frombuffer(r["bits"], "u1")
        return share(marks[0]), marks[1]

    words_map, _ = summarise([1])
    pairs_map, _ = summarise([2], words_map)
    long_map, needed = summarise(range(3, WORDS + 1), words_map, pairs_map)
    maps = (words_map, pairs_map, long_map, share(needed))
    exact = (rows.mapInArrow(exact_counter(maps, parts, run_bytes), EXACT_DDL)
             .repartition("part").sortWithinPartitions("part")
             .mapInArrow(exact_merger(threshold), "lang string, phrase string, size int, a long"))
    return scratch.keep(exact, "frequent"), words


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", threshold: int = 100, top: int = 2_000,
                 counters: int = 50_000, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    Null texts are empty, a null lang is ``und``; every row counts, repeated
    ones, too. A phrase never crosses a piece's or a text's end. Equal
    scores rank by a, then by the phrase's bytes. Extra columns are ignored;
    an empty table, or one without a frequent phrase, gives an empty result.

    ``counters`` is the mean number of counters of a hash part. The driver
    gets the parts' masses and the bit maps (32 MB at most each, broadcast).
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "collocations")
    found, words = frequent_phrases(docs, scratch, text=text, lang=lang, threshold=threshold, counters=counters, run_bytes=run_bytes)
    ws = F.split("phrase", " ")
    phrases = found.where("size > 1").withColumn("w", ws)

    # A phrase within a longer one that is as frequent goes.
    inner = (phrases.where("size > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> array_join(slice(w, i, k), ' '))))")).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (phrases.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer"))

    cuts = kept.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, size - 1), k -> named_struct('k', k, 'first', array_join(slice(w, 1, k), ' '), "
        "'rest', array_join(slice(w, k + 1, size - k), ' ')))")).alias("c")).select("lang", "phrase", "a", "c.*")
    part = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("a").alias("_a"))
    for name, new in (("first", "l"), ("rest", "r")):
        cuts = (cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(name) == F.col("_phrase")))
                .withColumn(new, F.col("_a")).drop("_lang", "_phrase", "_a"))
    # Exact: 1000 * a * n and l * r may pass 64 bits, not 38 digits.
    exact = "cast((cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) as bigint)"
    scored = (cuts.join(words, "lang").withColumn("score", F.expr(exact))
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
              .select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score"))
    # First within a slice of a language, then among the slices' first ones.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    first = (scored.withColumn("_s", seeded(13, "phrase") % SALTS)
             .withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).where(F.col("_r") <= top))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
