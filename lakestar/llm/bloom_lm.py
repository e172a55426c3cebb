"""LM scoring with a log-frequency Bloom filter (Talbot and Osborne, 2007).

Counts of words and of word pairs are quantised to levels, and a filter
holds the events (n-gram, 1) ... (n-gram, level): a count is read by probing
level after level until a probe fails. Scores interpolate the pair's share
of its context with the word's share of all tokens,

    p(w | h) = L * c(h w) / c(h) + (1 - L) * p(w),

with a weight L for each frequency class of the context, the best of a grid
by the leave-one-out likelihood of all training tokens. A context's class is
the level of its own count, however rare it is.

The filter is cut into segments by the hash of a pair's last word. A segment
has all that the probability of a token with that word needs, but the class
of its context, which is looked up among the words of the context's own
segment. Segments are files in the shared folder: within ``broadcast_bytes``
in all, every worker maps all of them and works on the spot; larger ones are
not held by anyone. Then pairs and tokens go to the segments of their
contexts first, and from there to those of their words. Both ways give the
same model and scores.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, open_fs, ship
from .grams import Cutter, mix, part_of, summed
from .token_files import map_file

SPACES = b" \t\n\x0b\x0c\r"
END, START = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B)  # stand for a text's end and start among the hashes
HELD_BYTES = 256 << 20  # of files that every worker may map
WORD_BYTES = 16  # of a word and its count in a segment's file
CHUNK_TOKENS = 500_000  # tokens that are worked on at a time
PROBES = 4
BITS_PER_EVENT = 10  # with 4 bits in a word of 64: about 2 % of absent events are taken for present ones
STEP = 1.2
LAMBDAS = (0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9, 0.97)
START_CLASS = 255
PAIR = 1 << 32  # keeps the keys of pairs apart from those of words


def level_starts() -> np.ndarray:
    """The least count of each level: 1, 2, 3 ... and then in steps of STEP."""
    out = [1]
    while out[-1] < 1 << 52:
        out.append(max(out[-1] + 1, int(out[-1] * STEP)))
    return np.array(out, np.float64)


STARTS = level_starts()  # fewer than START_CLASS


def levels(counts) -> np.ndarray:
    return np.searchsorted(STARTS, np.asarray(counts, np.float64), "right").astype(np.uint8)


#: What a level stands for (0: absent): the middle of its counts.
MEANS = np.r_[0.0, (STARTS[:-1] + STARTS[1:] - 1) / 2, STARTS[-1]]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# -- the filter -------------------------------------------------------------

def build_filter(keys: np.ndarray, lv: np.ndarray) -> np.ndarray:
    """A filter that holds ``keys`` at levels ``lv``. An event's bits are all in one word."""
    size = max(1, -(-int(lv.sum(dtype=np.int64)) * BITS_PER_EVENT // 64))
    table = np.zeros(64 * size, bool)
    for level in range(1, int(lv.max(initial=0)) + 1):
        events = mix(keys[lv >= level], level)
        at = part_of(events, size) << np.uint64(6)
        for probe in range(PROBES):
            table[at | events >> np.uint64(6 * probe) & np.uint64(63)] = True
    return np.packbits(table, bitorder="little").view("<u8")


def read_levels(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The level of each key: the number of probes in a row that succeed."""
    out = np.zeros(len(keys), np.uint8)
    alive = np.arange(len(keys))
    for level in range(1, START_CLASS):
        events = mix(keys[alive], level)
        bits = np.uint64(1) << (events & np.uint64(63))
        for probe in range(1, PROBES):
            bits |= np.uint64(1) << (events >> np.uint64(6 * probe) & np.uint64(63))
        alive = alive[table[part_of(events, len(table))] & bits == bits]
        if not len(alive):
            break
        out[alive] = level
    return out


# -- chunks of tokens ---------------------------------------------------------

@dataclass
class Chunk:
    """Tokens of consecutive texts: ``sizes`` tokens of each row, in order."""
    keys: list
    ids: list
    held: list
    sizes: np.ndarray
    hashes: np.ndarray
    before: np.ndarray  # hash of the token before


def chunks(batches, tokens: int):
    """Cuts a partition's texts into chunks. A text longer than a chunk goes on in the next."""
    cutter = Cutter(SPACES, run_bytes=4 * tokens)
    part = TaskContext.get().partitionId() << 33
    rows, hashes, starts, size, last, done = [], [], [], 0, START, 0

    def cut():
        nonlocal rows, hashes, starts, size, last
        h = np.concatenate(hashes)
        before = np.r_[last, h[:-1]]
        before[np.concatenate(starts)] = START
        chunk = Chunk([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], np.array([r[3] for r in rows]), h, before)
        rows, hashes, starts, size, last = [], [], [], 0, h[-1]
        return chunk

    for b in batches:
        ids, held = b.column("doc_id").to_pylist(), b.column("held").to_pylist()
        for run in cutter(b.column("text")):
            # Every row that ends here gets an end token.
            ended = run.rows if run.ends else run.rows - 1
            sizes = np.bincount(run.row, minlength=run.rows)
            sizes[:ended] += 1
            upto = np.cumsum(sizes)
            h = np.full(upto[-1], END)
            h[np.arange(len(run.row)) + run.row] = run.hashes
            begins = np.r_[0, upto[:-1]] + size
            starts.append(begins[0 if run.begins else 1:])
            rows += [(part + done + i, ids[i], held[i], n) for i, n in enumerate(sizes.tolist(), run.first)]
            hashes.append(h)
            size += len(h)
            if size >= tokens:
                yield cut()
        done += b.num_rows
    if size:
        yield cut()


def word_classes(words: np.ndarray, segment) -> np.ndarray:
    """The frequency class of words of one segment: the level of their counts, 0 if they have none."""
    cls = np.zeros(len(words), np.uint8)
    if segment is not None:
        known, totals = segment[:2]
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        cls = np.where(known[at] == words, levels(totals[at]), 0).astype(np.uint8)
    cls[words == START] = START_CLASS
    return cls


def classes_before(chunk: Chunk, held: dict, segments: int):
    """The classes of a chunk's contexts, with all segments' words at hand."""
    different, where = np.unique(chunk.before, return_inverse=True)
    cls = np.zeros(len(different), np.uint8)
    for seg, i, j in ranges(different, segments):
        cls[i:j] = word_classes(different[i:j], held.get(seg))
    return cls[where]


def ranges(words: np.ndarray, segments: int):
    """(segment, from, to) of words in order."""
    seg = part_of(words, segments)
    at = np.r_[np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]]), len(seg)] if len(seg) else np.zeros(1, int)
    return [(int(seg[i]), i, j) for i, j in zip(at[:-1], at[1:])]


def low32(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def pair_keys(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix(words, before.astype(np.uint64) + np.uint64(PAIR))


# -- first pass: exact word counts --------------------------------------------

def word_blocks(segments: int, tokens: int):
    """Each chunk's counts of different words of training rows, by segment."""
    def run(batches):
        for chunk in chunks(batches, tokens):
            h = chunk.hashes[~np.repeat(np.array(chunk.held, bool), chunk.sizes)]
            words, counts = np.unique(h, return_counts=True)
            for seg, i, j in ranges(words, segments):
                yield pa.RecordBatch.from_pydict({"seg": pa.array([seg], pa.int32()), "words": [words[i:j].tobytes()],
                                                  "counts": [counts[i:j].astype("<u4").tobytes()]})
    return run


def merged(batches, read, fold):
    """(segment, its blocks folded into one) of a partition that is sorted by segment."""
    seg, parts = None, []
    for b in batches:
        for r in b.to_pylist():
            if r["seg"] != seg and parts:
                yield seg, fold(parts)
                parts = []
            seg = r["seg"]
            parts.append(read(r))
            if len(parts) >= 64:
                parts = [fold(parts)]
    if parts:
        yield seg, fold(parts)


def read_counts(r):
    return np.frombuffer(r["words"], "<u8"), np.frombuffer(r["counts"], "<u4").astype(np.int64)


def fold_counts(parts):
    return summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def word_segments(folder: str):
    """Writes each segment's words and counts; a row tells the file and the sums."""
    def run(batches):
        fs, root = open_fs(folder)
        for seg, (words, counts) in merged(batches, read_counts, fold_counts):
            name = f"words-{seg}-{uuid.uuid4().hex[:12]}"
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(words.astype("<u8").tobytes() + counts.astype("<i8").tobytes())
            yield pa.RecordBatch.from_pylist([{"seg": seg, "name": name, "n_words": len(words), "tokens": int(counts.sum())}], schema=WORD_ROWS)
    return run


WORD_ROWS = pa.schema([("seg", pa.int32()), ("name", pa.string()), ("n_words", pa.int64()), ("tokens", pa.int64())])


def read_words(fs, path: str):
    """(words, counts) of a file, memory-mapped where the folder is mounted."""
    data = map_file(fs, path, "<u8")
    return data[:len(data) // 2], data[len(data) // 2:].view("<i8")


_held: dict = {}  # by folder: the segments that a worker has mapped


def held_words(folder: str, names: dict) -> dict:
    """All segments' words and counts, mapped once a worker."""
    if (folder, "words") not in _held:
        _held.clear()
        fs, root = open_fs(folder)
        _held[folder, "words"] = {seg: read_words(fs, f"{root}/{name}") for seg, name in names.items()}
    return _held[folder, "words"]


# -- second pass: the filter's segments and the weights -------------------------

def different_pairs(chunk: Chunk):
    """(words, the words before, counts) of a chunk's different pairs of training rows, in order;
    and the places of the pairs' first tokens."""
    mine = np.flatnonzero(~np.repeat(np.array(chunk.held, bool), chunk.sizes))
    words, at = np.unique(chunk.hashes[mine], return_inverse=True)
    pairs, first, counts = np.unique(at.astype(np.uint64) << np.uint64(32) | chunk.before[mine] & np.uint64(0xFFFFFFFF),
                                     return_index=True, return_counts=True)
    return words[(pairs >> np.uint64(32)).astype(np.int64)], chunk.before[mine[first]], counts, mine[first]


def pair_rows(segments: int, words, before, cls, counts):
    """A row for each segment of pairs that are in order of their words."""
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, int)
    ends = np.r_[first, len(words)]
    for seg, i, j in ranges(words[first], segments):
        p, q = ends[i], ends[j]
        yield pa.RecordBatch.from_pydict({
            "seg": pa.array([seg], pa.int32()), "words": [words[first[i:j]].tobytes()],
            "pairs": [np.diff(ends[i:j + 1]).astype("<u4").tobytes()],
            "before": [low32(before[p:q]).tobytes()], "classes": [cls[p:q].tobytes()],
            "counts": [counts[p:q].astype("<u4").tobytes()]})


def pair_blocks(segments: int, folder: str, names, tokens: int):
    """Each chunk's counts of different pairs of training rows, by the last word's segment."""
    def run(batches):
        held = held_words(folder, names.value)
        for chunk in chunks(batches, tokens):
            words, before, counts, first = different_pairs(chunk)
            yield from pair_rows(segments, words, before, classes_before(chunk, held, segments)[first], counts)
    return run


CONTEXT_DDL = "seg int, salt int, words binary, before binary, counts binary"


def pairs_to_contexts(segments: int, tokens: int, salts: int):
    """Each chunk's counts of different pairs, by the segment of the word before."""
    def run(batches):
        for no, chunk in enumerate(chunks(batches, tokens)):
            words, before, counts, _ = different_pairs(chunk)
            order = np.argsort(before, kind="stable")
            words, before, counts = words[order], before[order], counts[order]
            for seg, i, j in ranges(before, segments):
                yield pa.RecordBatch.from_arrays([
                    pa.array([seg], pa.int32()), pa.array([(chunk.keys[0] + no) % salts], pa.int32()), pa.array([words[i:j].tobytes()]),
                    pa.array([before[i:j].tobytes()]), pa.array([counts[i:j].astype("<u4").tobytes()])],
                    ["seg", "salt", "words", "before", "counts"])
    return run


def pairs_from_contexts(segments: int, folder: str, names, tokens: int):
    """Pairs with their contexts' classes, by the last word's segment; one context segment is mapped at a time."""
    def run(batches):
        fs, root = open_fs(folder)
        seg, segment, parts, size = None, None, [], 0

        def rows():
            words, before, cls, counts = (np.concatenate([p[i] for p in parts]) for i in range(4))
            order = np.lexsort((low32(before), words))
            return pair_rows(segments, words[order], before[order], cls[order], counts[order])

        for b in batches:
            for r in b.to_pylist():
                if r["seg"] != seg:
                    seg = r["seg"]
                    segment = read_words(fs, f"{root}/{names.value[seg]}") if seg in names.value else None
                before = np.frombuffer(r["before"], "<u8")
                parts.append((np.frombuffer(r["words"], "<u8"), before, word_classes(before, segment), np.frombuffer(r["counts"], "<u4")))
                size += len(before)
                if size >= tokens:
                    yield from rows()
                    parts, size = [], 0
        if parts:
            yield from rows()
    return run


def read_pairs(r):
    words = np.repeat(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["pairs"], "<u4"))
    return (words, np.frombuffer(r["before"], "<u4"), np.frombuffer(r["classes"], "u1"), np.frombuffer(r["counts"], "<u4").astype(np.int64))


def fold_pairs(parts):
    words, before, cls, counts = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = np.lexsort((before, words))
    words, before, cls, counts = words[order], before[order], cls[order], counts[order]
    first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (before[1:] != before[:-1])])
    return words[first], before[first], cls[first], np.add.reduceat(counts, first)


def filter_segments(folder: str, names: dict, share, context_counts: np.ndarray):
    """Writes each segment's filter; a row has its likelihoods for each class and weight."""
    def run(batches):
        fs, root = open_fs(folder)
        for seg, (words, before, cls, counts) in merged(batches, read_pairs, fold_pairs):
            known, totals = read_words(fs, f"{root}/{names.value[seg]}")
            first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            total = np.repeat(totals[np.searchsorted(known, words[first])], np.diff(np.r_[first, len(words)]))
            keys = np.r_[mix(known, 0), pair_keys(words, before)]
            table = build_filter(keys, levels(np.r_[totals, counts]))
            name = f"filter-{seg}-{uuid.uuid4().hex[:12]}"
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(table.tobytes())
            # Leave one out: a token doesn't count itself.
            seen = np.minimum((counts - 1) / np.maximum(context_counts[cls] - 1, 1), 1.0)
            alone = share(total - 1)
            gain = np.concatenate([np.bincount(cls, counts * np.log10(x * seen + (1 - x) * alone), 256) for x in LAMBDAS])
            yield pa.RecordBatch.from_pylist([{"seg": seg, "name": name, "bytes": table.nbytes, "gain": gain.tolist()}], schema=FILTER_ROWS)
    return run


FILTER_ROWS = pa.schema([("seg", pa.int32()), ("name", pa.string()), ("bytes", pa.int64()), ("gain", pa.list_(pa.float64()))])


@dataclass(frozen=True)
class Share:
    """p(w) of a word that was counted c times."""
    total: float

    def __call__(self, c):
        return (c + 0.5) / self.total


@dataclass(frozen=True)
class Model:
    """A trained model; ``segments``: (words file, filter file, bytes) by segment."""
    folder: str
    segments: dict = field(repr=False)
    tokens: int
    different: int
    weights: np.ndarray = field(repr=False)  # by class of the context
    context_counts: np.ndarray = field(repr=False)  # by class
    count: int = 1

    @property
    def share(self) -> Share:
        return Share(self.tokens + 0.5 * (self.different + 1))

    def size(self) -> int:
        """Bytes of all segments, as every worker would hold them."""
        return sum(s[2] for s in self.segments.values())


def rows_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), is_held_out(F.col(doc_id)).alias("held"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = 32 << 20,
          chunk_tokens: int = CHUNK_TOKENS, folder: str | None = None, broadcast_bytes: int = HELD_BYTES, salts: int = 16) -> Model:
    """Learn from the rows that aren't held out.

    The number of segments grows with the texts (``segment_bytes`` of them
    each), so no task holds more than its share of the different pairs. The
    driver gets a row a segment and 256 classes' sums. Every word before
    counts in the class of its own count: up to ``broadcast_bytes`` of word
    counts are mapped by every worker, beyond that the pairs go to the
    segments of their contexts first.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or Scratch(spark, "lm").root
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    rows = rows_of(docs, doc_id, text)
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count_if(~F.col("held")).alias("n")).first()
    segments = max(1, -(-(size["b"] or 0) // segment_bytes))
    blocks = rows.mapInArrow(word_blocks(segments, chunk_tokens), "seg int, words binary, counts binary")
    told = (blocks.repartition("seg").sortWithinPartitions("seg").mapInArrow(
        word_segments(folder), "seg int, name string, n_words long, tokens long")
        .collect())
    names = {r["seg"]: r["name"] for r in told}
    tokens, different = sum(r["tokens"] for r in told), sum(r["n_words"] for r in told)
    # Class 0 is that of contexts without a training token.
    context_counts = MEANS[np.minimum(np.arange(256), len(MEANS) - 1)].copy()
    context_counts[0] = 1.0
    context_counts[START_CLASS] = max(1.0, float(size["n"]))

    share = Share(tokens + 0.5 * (different + 1))
    shared = spark.sparkContext.broadcast(names)
    pairs = "seg int, words binary, pairs binary, before binary, classes binary, counts binary"
    if WORD_BYTES * different <= broadcast_bytes:
        blocks = rows.mapInArrow(pair_blocks(segments, folder, shared, chunk_tokens), pairs)
    else:
        blocks = (rows.mapInArrow(pairs_to_contexts(segments, chunk_tokens, salts), CONTEXT_DDL).repartition("seg", "salt")
                  .sortWithinPartitions("seg").mapInArrow(pairs_from_contexts(segments, folder, shared, chunk_tokens), pairs))
    made = Scratch(spark, "lm").keep(
        blocks.repartition("seg").sortWithinPartitions("seg")
        .mapInArrow(filter_segments(folder, shared, share, context_counts),
                    "seg int, name string, bytes long, gain array<double>"), "filters")
    gain = np.zeros(256 * len(LAMBDAS))
    for r in made.select(F.posexplode("gain").alias("i", "g")).groupBy("i").agg(F.sum("g").alias("g")).collect():
        gain[r["i"]] = r["g"]
    gain = gain.reshape(len(LAMBDAS), 256)
    weights = np.where(gain.any(axis=0), np.array(LAMBDAS)[gain.argmax(axis=0)], 0.0)  # 0: no training token has such a context
    sizes = {r["seg"]: r["n_words"] for r in told}
    filters = {r["seg"]: (names[r["seg"]], r["name"], WORD_BYTES * sizes[r["seg"]] + r["bytes"])
               for r in made.select("seg", "name", "bytes").collect()}
    return Model(folder, filters, tokens, different, weights, context_counts, segments)


# -- scoring ------------------------------------------------------------------

def load(model: Model, seg: int, fs, root: str):
    """(words, counts, filter) of a segment; None if no training word is in it."""
    if seg not in model.segments:
        return None
    words, name, _ = model.segments[seg]
    return (*read_words(fs, f"{root}/{words}"), map_file(fs, f"{root}/{name}", "<u8"))


def score_block(model: Model, segment, words, at, before, cls, row, rows: int):
    """Sums for each of ``rows`` rows: (tokens, known tokens, base, score).

    ``words``: different words; by token: ``at`` (place in words), the low
    half of the hash ``before``, that token's class, and the row.
    """
    counts, lv = np.zeros(len(words)), np.zeros(len(words), np.uint8)
    pairs, where = np.unique(at.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64), return_inverse=True)
    both = np.zeros(len(pairs), np.uint8)
    if segment is not None:
        known, totals, table = segment
        i = np.minimum(np.searchsorted(known, words), len(known) - 1)
        counts = np.where(known[i] == words, totals[i], 0).astype(float)
        lv = read_levels(mix(words, 0), table)
        both = read_levels(pair_keys(words[(pairs >> np.uint64(32)).astype(np.int64)], low32(pairs)), table)
    base = np.log10(model.share(counts))[at]
    alone = model.share(MEANS[lv])[at]
    # A pair is as frequent as its words at most: a probe that says more is a false one.
    most = np.minimum(lv[at], np.where(cls == 0, START_CLASS, cls))
    seen = np.minimum(MEANS[np.minimum(both[where], most)] / model.context_counts[cls], 1.0)
    x = model.weights[cls]
    score = np.log10(x * seen + (1 - x) * alone)
    return (np.bincount(row, minlength=rows), np.bincount(row, (counts > 0)[at], rows),
            np.bincount(row, base, rows), np.bincount(row, score, rows))


RESULT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
RESULT_DDL = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def result(keys, ids, held, sums):
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(held, pa.bool_()),
                                       pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)),
                                       pa.array(sums[2]), pa.array(sums[3])], schema=RESULT)


def by_segment(words, before, cls, row, count: int):
    """(segment, words, at, before, class, row) of tokens, a segment at a time."""
    words, at = np.unique(words, return_inverse=True)
    order = np.argsort(at, kind="stable")
    at, before, cls, row = at[order], low32(before)[order], cls[order], row[order]
    for seg, i, j in ranges(words, count):
        p, q = np.searchsorted(at, (i, j))
        yield seg, words[i:j], at[p:q] - i, before[p:q], cls[p:q], row[p:q]


def row_of(chunk: Chunk) -> np.ndarray:
    return np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)


def scorer(shared, tokens: int):
    """Scores on the spot, with all segments in the worker's memory."""
    def run(batches):
        model = shared.value
        fs, root = open_fs(model.folder)
        if model.folder not in _held:
            _held.clear()
            _held[model.folder] = {s: load(model, s, fs, root) for s in model.segments}
        mine = _held[model.folder]
        for chunk in chunks(batches, tokens):
            n = len(chunk.sizes)
            sums = [np.zeros(n) for _ in range(4)]
            cls = classes_before(chunk, mine, model.count)
            for seg, *block in by_segment(chunk.hashes, chunk.before, cls, row_of(chunk), model.count):
                for total, x in zip(sums, score_block(model, mine.get(seg), *block, n)):
                    total += x
            yield result(chunk.keys, chunk.ids, chunk.held, sums)
    return run


BLOCK_DDL = ("seg int, salt int, words binary, at binary, before binary, classes binary, row binary, "
             "keys array<long>, ids array<long>, held array<boolean>")


def block_rows(model: Model, words, before, cls, row, keys, ids, held, salt: int):
    """Tokens by the segments of their words, each block with the rows that it has tokens of."""
    for seg, words, at, before, cls, row in by_segment(words, before, cls, row, model.count):
        here, row = np.unique(row, return_inverse=True)
        yield pa.RecordBatch.from_arrays([
            pa.array([seg], pa.int32()), pa.array([salt], pa.int32()), pa.array([words.tobytes()]),
            pa.array([at.astype("<u4").tobytes()]), pa.array([before.tobytes()]), pa.array([cls.tobytes()]),
            pa.array([row.astype("<u4").tobytes()]), pa.array([[keys[k] for k in here]], pa.list_(pa.int64())),
            pa.array([[ids[k] for k in here]], pa.list_(pa.int64())),
            pa.array([[held[k] for k in here]], pa.list_(pa.bool_()))],
            ["seg", "salt", "words", "at", "before", "classes", "row", "keys", "ids", "held"])


def router(shared, tokens: int, salts: int):
    """Sends a chunk's tokens to their segments, with all segments' words at hand."""
    def run(batches):
        model = shared.value
        words = held_words(model.folder, {seg: names[0] for seg, names in model.segments.items()})
        for no, chunk in enumerate(chunks(batches, tokens)):
            yield from block_rows(model, chunk.hashes, chunk.before, classes_before(chunk, words, model.count), row_of(chunk),
                                  chunk.keys, chunk.ids, chunk.held, (chunk.keys[0] + no) % salts)
    return run


TOKEN_DDL = "seg int, salt int, words binary, before binary, row binary, keys array<long>, ids array<long>, held array<boolean>"


def tokens_to_contexts(shared, tokens: int, salts: int):
    """Sends a chunk's tokens to the segments of the words before."""
    def run(batches):
        model = shared.value
        for no, chunk in enumerate(chunks(batches, tokens)):
            order = np.argsort(chunk.before, kind="stable")
            words, before, row = chunk.hashes[order], chunk.before[order], row_of(chunk)[order]
            for seg, i, j in ranges(before, model.count):
                here, mine = np.unique(row[i:j], return_inverse=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([seg], pa.int32()), pa.array([(chunk.keys[0] + no) % salts], pa.int32()), pa.array([words[i:j].tobytes()]),
                    pa.array([before[i:j].tobytes()]), pa.array([mine.astype("<u4").tobytes()]),
                    pa.array([[chunk.keys[k] for k in here]], pa.list_(pa.int64())),
                    pa.array([[chunk.ids[k] for k in here]], pa.list_(pa.int64())),
                    pa.array([[chunk.held[k] for k in here]], pa.list_(pa.bool_()))],
                    ["seg", "salt", "words", "before", "row", "keys", "ids", "held"])
    return run


def tokens_from_contexts(shared, tokens: int, salts: int):
    """Sends tokens with their contexts' classes on to their own segments."""
    def run(batches):
        model = shared.value
        fs, root = open_fs(model.folder)
        part, sent = TaskContext.get().partitionId(), 0
        seg, segment, parts, rows, size = None, None, [], [], 0

        def blocks():
            columns = (np.concatenate([p[i] for p in parts]) for i in range(4))
            return block_rows(model, *columns, *zip(*rows), (part + sent) % salts)

        for b in batches:
            for r in b.to_pylist():
                if r["seg"] != seg:
                    seg = r["seg"]
                    segment = read_words(fs, f"{root}/{model.segments[seg][0]}") if seg in model.segments else None
                before = np.frombuffer(r["before"], "<u8")
                parts.append((np.frombuffer(r["words"], "<u8"), before, word_classes(before, segment),
                              np.frombuffer(r["row"], "<u4").astype(np.int64) + len(rows)))
                rows += zip(r["keys"], r["ids"], r["held"])
                size += len(before)
                if size >= tokens:
                    yield from blocks()
                    parts, rows, size, sent = [], [], 0, sent + 1
        if parts:
            yield from blocks()
    return run


def at_segments(shared):
    """Scores blocks in order of their segments, holding one segment at a time."""
    def run(batches):
        model = shared.value
        fs, root = open_fs(model.folder)
        seg, segment = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["seg"] != seg:
                    seg, segment = r["seg"], load(model, r["seg"], fs, root)
                read = [np.frombuffer(r[c], d) for c, d in (("words", "<u8"), ("at", "<u4"), ("before", "<u4"), ("classes", "u1"), ("row", "<u4"))]
                sums = score_block(model, segment, read[0], read[1].astype(np.int64), *read[2:4], read[4].astype(np.int64), len(r["keys"]))
                yield result(r["keys"], r["ids"], r["held"], sums)
    return run


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text",
          broadcast_bytes: int = HELD_BYTES, chunk_tokens: int = CHUNK_TOKENS, salts: int = 16) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Null and empty texts have the end token alone. A null id is not held
    out. Repeated rows are scored and counted each. Extra columns are
    ignored; an empty table gives an empty result, and a model without
    training rows scores all tokens as unknown. A text of any length is read
    whole, in chunks whose scores add up.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = rows_of(docs, doc_id, text)
    if model.size() <= broadcast_bytes:
        parts = rows.mapInArrow(scorer(shared, chunk_tokens), RESULT_DDL)
    else:
        # A common word's segment has many tokens: its blocks are dealt over ``salts`` tasks.
        if WORD_BYTES * model.different <= broadcast_bytes:
            blocks = rows.mapInArrow(router(shared, chunk_tokens, salts), BLOCK_DDL)
        else:
            blocks = (rows.mapInArrow(tokens_to_contexts(shared, chunk_tokens, salts), TOKEN_DDL).repartition("seg", "salt")
                      .sortWithinPartitions("seg").mapInArrow(tokens_from_contexts(shared, chunk_tokens, salts), BLOCK_DDL))
        parts = (blocks.repartition("seg", "salt").sortWithinPartitions("seg").mapInArrow(at_segments(shared), RESULT_DDL))
    return (parts.groupBy("key", "doc_id", "held_out")
            .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                    "base_score", "score"))


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows that aren't held out and score all rows."""
    return score(docs, train(docs, doc_id=doc_id, text=text), doc_id=doc_id, text=text)
