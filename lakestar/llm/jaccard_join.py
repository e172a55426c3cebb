"""N-gram Jaccard join with set-relation skipping.

An exact self-join of word-shingle sets (after Wang et al., "Leveraging Set
Relations in Exact Set Similarity Join", PVLDB 10(9), 2017):

* Each set's shingles are put in one global order, rare ones first, and a
  prefix of them goes to inverted lists. Lists are kept in blocks of like
  set size, sorted by position; a block is skipped, or left at the first
  entry, as soon as its positions leave too few shingles for the overlap.
* Sets highly similar to another, by agreeing minima of hashes, hang on it
  as members of a centre and have its candidates: lists hold one entry a
  centre, so a large group of near copies is one entry. Candidates make
  families, and only sets of a family are compared. Before that, candidate
  pairs of few members each are tested by bit maps (see below) pair by pair:
  sets that meet by chance grow with the square of the documents, and beyond
  about one for each document they would tie all of them into one family.
* A family's sets first meet as bit maps of two to four bits a shingle. The
  bits that two maps share, and the shingles that fell on a taken bit of the
  set with fewer of those, are never fewer than the shingles that the sets
  share: pairs below the overlap they need are ruled out, and only families
  of what is left are compared as sets.
* In a family, a block's overlaps with one set are computed in full; those
  with the others are derived from them by the shingles that the others
  have more or less: o(y, w) = o(x, w) + |(y - x) w| - |(x - y) w|.

Pairs of large groups are never rows: list groups return which centres hang
together where they have many pairs a centre, blocks which sets are linked,
one row a set.

Equal sets are one class from the start. All sets are 64-bit hashes of the
shingles; a class is told by a 64-bit hash of its set and the set's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ship
from .components import components

WIDTH = 5  # words in a shingle
MINIMA = 8  # hash functions for finding centres
VOTES = 4  # of them that must agree
BUCKET_BITS = 20  # shingle counts are kept for so many bits of the hash
CHUNKS = 64
BANDS = 8  # size bands to a doubling
POSTINGS = 400_000  # of one task group
HOT_LIST = 20_000  # lists that may be longer are split by hash
BLOCK = 1_024  # sets of a family that are compared at once; larger families are split by hash
BLOCK_SHINGLES = 4_000_000  # of those sets, about
BIN_SHINGLES = 1_000_000  # of small families that share a block, about
MAP_BLOCK = 4_096  # bit maps of a family that are compared at once
MAP_BLOCK_SHINGLES = 64_000_000  # of their sets, about
MAP_BIN_SHINGLES = 16_000_000
MAP_PAIRS = 1 << 20  # surviving pairs held before they are joined up
TIE_PAIRS = 4  # candidate pairs a centre, on average, up to which a component's pairs are tested one by one
TIE_MEMBERS = 64  # pairs of two centres' members that are tested, at most
SLICE = 500_000  # shingles of a block that are counted at once
BATCH_BYTES = 16 << 20  # of sets in one Arrow batch, about
COMMON = 16  # sets of a block that share a shingle for it to be a matrix column
WORD_CACHE = 250_000  # about 150 bytes each, in every worker
FILTER_BITS = 24  # of the table of ids whose sets are wanted
PRIME = np.uint64(0x9E3779B97F4A7C15)
ODD = [np.uint64(0xBF58476D1CE4E5B9 + 0x632BE59BD9B4E01A * 2 * i & 0xFFFFFFFFFFFFFFFF) for i in range(MINIMA)]


class WordHashes(dict):
    """64-bit hashes of words; forgets them all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = WordHashes()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at ASCII
    white space only. Fewer than five words are one shingle, told apart by
    their number.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, "u8")
    w = np.fromiter(map(_words.__getitem__, words), "u8", len(words))
    width = min(WIDTH, len(w))
    n = len(w) - width + 1
    h = np.full(n, width, "u8")
    for i in range(width):
        h = h * PRIME + w[i:i + n]
    return np.unique(mixed(h))


def bit_map(h: np.ndarray) -> np.ndarray:
    """The hashes' low bits as a bit map of 2^k bits, at least 64 and two a hash."""
    bits = np.zeros(max(64, 1 << (2 * len(h) - 1).bit_length()), bool)
    bits[h & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").view("<u8")


def linked(o, a, b):
    """Whether sets of sizes a and b with overlap o link: 100 o >= 75 (a + b - o)."""
    return 7 * o >= 3 * (a + b)


def buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype("i4")


SUMMARY = "doc_id long, text_hash long, n_shingles long, sid long, minima array<long>, bits binary, part int, chunk int, counts binary"


def summarise(batches):
    """A row for each document, and the task's shingle counts by bucket in chunks."""
    from pyspark import TaskContext

    counts, schema = np.zeros(1 << BUCKET_BITS, "u4"), pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()), ("minima", pa.list_(pa.int64())),
        ("bits", pa.binary()), ("part", pa.int32()), ("chunk", pa.int32()), ("counts", pa.binary())])
    for b in batches:
        n, sid, minima, bits, seen = [], [], [], [], []
        for t in b.column("text").to_pylist():
            h = shingle_set(t)
            n.append(len(h))
            sid.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63))
            minima.append([int((h * odd).min().view("i8")) for odd in ODD] if len(h) else [])
            bits.append(bit_map(h).tobytes() if len(h) else b"")
            seen.append(buckets(h))
            if sum(map(len, seen[-1:])) > 1 << 18 or len(seen) >= 512:
                counts += np.bincount(np.concatenate(seen), minlength=1 << BUCKET_BITS).astype("u4")
                seen = []
        if seen:
            counts += np.bincount(np.concatenate(seen), minlength=1 << BUCKET_BITS).astype("u4")
        none = pa.nulls(len(n), pa.int32())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(sid, pa.int64()),
                                          pa.array(minima, pa.list_(pa.int64())), pa.array(bits, pa.binary()), none, none,
                                          pa.nulls(len(n), pa.binary())], schema=schema)
    part = TaskContext.get().partitionId()
    rows = [{"part": part, "chunk": i, "counts": c.tobytes()} for i, c in enumerate(np.split(counts, CHUNKS)) if c.any()]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def add_up(table):
    total = sum(np.frombuffer(c, "u8" if len(c) > 4 << BUCKET_BITS - 6 else "u4").astype("u8")
                for c in table["counts"].to_pylist())
    return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def shingle_counts(summary: DataFrame) -> np.ndarray:
    """How often each bucket of shingles occurs in all documents: a table of
    fixed size, summed in two steps of about the square root of the tasks."""
    rows = summary.where("chunk is not null")
    tasks = rows.agg(F.max("part")).first()[0]
    out = np.zeros(1 << BUCKET_BITS, "u8")
    if tasks is not None:
        rows = rows.select("chunk", (F.col("part") % F.lit(int((tasks + 1) ** 0.5) + 1)).alias("g"), "counts")
        part = rows.groupBy("chunk", "g").applyInArrow(add_up, "chunk int, counts binary")
        size = (1 << BUCKET_BITS) // CHUNKS
        for r in part.groupBy("chunk").applyInArrow(add_up, "chunk int, counts binary").collect():
            out[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(r["counts"], "u8")
    return out


def band(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(n) * BANDS).astype("i8")


def band_floor(b: np.ndarray) -> np.ndarray:
    """The least size that may stand in a band (one less, to be safe from rounding)."""
    return np.maximum(1, np.floor(2.0 ** (b / BANDS)).astype("i8") - 1)


def postings(told, parts: int):
    """Prefix postings (token, centre, size, shingles left) of each set, packed by task group.

    The group of a token is a part of its hash; tokens of a bucket counted
    more than HOT_LIST times go to one group for each pair of hash parts of
    their list, numbered from ``parts`` upwards.
    """
    def run(batches):
        rank, hot = told.value
        for b in batches:
            toks, own = [], []
            for t, sid, centre in zip(*(b.column(c).to_pylist() for c in ("text", "sid", "centre"))):
                h = shingle_set(t)
                if not len(h) or xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63) != sid:
                    continue
                n = len(h)
                first = np.argsort(rank[buckets(h)], kind="stable")[:n - (3 * n + 3) // 4 + 1]
                toks.append(h[first])
                own.append((centre, n, len(first)))
                if sum(map(len, toks[-1:])) > 1 << 20 or len(toks) >= 2_000:
                    yield from packed(toks, own, hot, parts)
                    toks, own = [], []
            if toks:
                yield from packed(toks, own, hot, parts)
    return run


def packed(toks, own, hot, parts):
    tok = np.concatenate(toks)
    k = np.array([x[2] for x in own])
    centre, n = np.repeat([x[0] for x in own], k), np.repeat([x[1] for x in own], k)
    left = n - (np.arange(len(tok)) - np.repeat(np.cumsum(k) - k, k))
    at = buckets(tok)
    part = (mixed(tok) % np.uint64(parts)).astype("i8")
    split_in = np.zeros(len(tok), "i8")
    is_hot = np.isin(at, hot[0])
    if is_hot.any():
        rows = np.flatnonzero(is_hot)
        split = hot[1][np.searchsorted(hot[0], at[rows])]
        salt = (mixed(centre[rows].astype("u8")) % split.astype("u8")).astype("i8")
        times = np.repeat(np.arange(len(rows)), split)
        other = np.arange(len(times)) - np.repeat(np.cumsum(split) - split, split)
        low, high = np.minimum(salt[times], other), np.maximum(salt[times], other)
        more = parts + ((at[rows][times].astype("i8") << 42) | (low << 21) | high)
        tok, centre, n, left, part, split_in = (np.concatenate([x[~is_hot], y]) for x, y in (
            (tok, tok[rows][times]), (centre, centre[rows][times]), (n, n[rows][times]),
            (left, left[rows][times]), (part, more), (split_in, split[times])))
    order = np.argsort(part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.diff(part, prepend=part[0] - 1, append=part[-1] + 1))
    cols = [(tok & np.uint64(0xFFFFFFFF)).astype("<u4")[order], centre.astype("<i8")[order],
            n.astype("<u4")[order], left.astype("<u4")[order]]
    blobs = [b"".join(c[i:j].tobytes() for c in cols) for i, j in zip(cut[:-1], cut[1:])]
    yield pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]], pa.int64()), pa.array(split_in[order][cut[:-1]], pa.int64()),
                                      pa.array(blobs, pa.binary())], ["part", "split", "blob"])


def unpack(blobs: list[bytes]):
    cols = [[], [], [], []]
    for b in blobs:
        k = len(b) // 20
        for col, (kind, at) in zip(cols, (("<u4", 0), ("<i8", 4), ("<u4", 12), ("<u4", 16))):
            col.append(np.frombuffer(b, kind, k, at * k))
    return [np.concatenate(c) for c in cols]


def spans(starts: np.ndarray, ends: np.ndarray, most: int = 2_000_000):
    """(i, j) arrays of every j in [starts[i], ends[i]), in chunks."""
    k = np.maximum(0, ends - starts)
    done = np.cumsum(k)
    at = 0
    while at < len(k):
        stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + most, "right")))
        kk = k[at:stop]
        i = np.repeat(np.arange(at, stop), kk)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(kk) - kk, kk) + starts[i]
        at = stop


def lowest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) over the links a-b, without the smallest ones themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, low = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, x, low[y])
        np.minimum.at(new, y, low[x])
        new = new[new]
        if (new == low).all():
            break
        low = new
    moved = low != np.arange(len(nodes))
    return nodes[moved], nodes[low[moved]]


def told_apart(x: np.ndarray, y: np.ndarray):
    """(a, b, sure) of candidate pairs: the pairs where a component has few of them,
    else which of its nodes hang together (``sure``, as they aren't tested)."""
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
    x, y = pairs
    node, root = lowest(x, y)
    top = np.append(root, 0)[np.searchsorted(node, x)] if len(node) else x
    top = np.where(np.isin(x, node), top, x)
    roots, of = np.unique(top, return_inverse=True)
    nodes = 1 + np.bincount(np.searchsorted(roots, root), minlength=len(roots))
    dense = np.bincount(of, minlength=len(roots)) > TIE_PAIRS * nodes
    whole = dense[np.searchsorted(roots, root)]
    return (np.r_[x[~dense[of]], node[whole]], np.r_[y[~dense[of]], root[whole]],
            np.r_[np.zeros((~dense[of]).sum(), bool), np.ones(whole.sum(), bool)])


def candidates(parts: int):
    """Pairs of centres that the lists of this group leave possible, or which
    centres hang together by them (``sure``) where they are many."""
    def run(key, table):
        part, split = key[0].as_py(), key[1].as_py()
        tok, centre, n, left = unpack(table["blob"].to_pylist())
        n, left = n.astype("i8"), left.astype("i8")
        b = band(n)
        # One entry a (token, band, centre): least and largest size, most shingles left.
        order = np.lexsort((centre, b, tok))
        tok, centre, n, left, b = tok[order], centre[order], n[order], left[order], b[order]
        new = np.ones(len(tok), bool)
        new[1:] = (np.diff(tok) != 0) | (np.diff(b) != 0) | (np.diff(centre) != 0)
        at = np.flatnonzero(new)
        low, high, left = np.minimum.reduceat(n, at), np.maximum.reduceat(n, at), np.maximum.reduceat(left, at)
        tok, centre, b = tok[at], centre[at], b[at]
        no = np.cumsum(np.r_[0, np.diff(tok) != 0])
        more = np.bincount(no)[no] > 1
        centre, b, low, high, left, no = (x[more] for x in (centre, b, low, high, left, no))
        # Blocks: token and band, most shingles left first.
        place = (no << 40) | (b << 32) | (0xFFFFFFFF - left)
        order = np.argsort(place, kind="stable")
        place, centre, b, low, high, left, no = (x[order] for x in (place, centre, b, low, high, left, no))
        half = (mixed(centre.astype("u8")) % np.uint64(split)).astype("i8") if split else np.zeros(len(centre), "i8")
        halves = split > 0 and (part - parts >> 21 & 0x1FFFFF) != (part - parts & 0x1FFFFF)
        found, pairs, held = [], [], 0
        for step in range(BANDS):
            if 2.0 ** ((step - 1) / BANDS) > 4 / 3:
                break
            least = -(-3 * (low + band_floor(b + step)) // 7)
            block = (no << 40) | (b + step << 32)
            start = np.searchsorted(place, block) if step else np.arange(len(place)) + 1
            end = np.searchsorted(place, block | np.maximum(0, 0xFFFFFFFF - least), "right")
            end = np.where(left >= least, end, start)
            for i, j in spans(start, end):
                ok = ((np.minimum(left[i], left[j]) >= -(-3 * (low[i] + low[j]) // 7)) & (centre[i] != centre[j])
                      & (3 * low[j] <= 4 * high[i]) & (3 * low[i] <= 4 * high[j]))
                if halves:  # pairs inside a half belong to another group
                    ok &= half[i] != half[j]
                pairs.append((centre[i[ok]], centre[j[ok]]))
                held += len(pairs[-1][0])
                if held > MAP_PAIRS:
                    found.append(lowest(*map(np.concatenate, zip(*pairs))))
                    pairs, held = [], 0
        a, b = (np.concatenate([*(f[k] for f in found), np.zeros(0, "i8")]) for k in (0, 1))
        a, b = lowest(a, b)
        x, y, sure = told_apart(*map(np.concatenate, zip(*pairs))) if held else (np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, bool))
        return pa.table({"a": np.r_[a, x], "b": np.r_[b, y], "sure": np.r_[np.ones(len(a), bool), sure]})
    return run


def most_shared(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The most shingles that sets of sizes n and m with the bit maps x and y can share, row by row."""
    while x.shape[1] > y.shape[1]:
        x = fold(x)
    while y.shape[1] > x.shape[1]:
        y = fold(y)
    return np.bitwise_count(x & y).sum(axis=1, dtype="i8") + np.minimum(spilt(x, n), spilt(y, m))


def possible(batches):
    """(a, b) of the rows whose two bit maps leave a link possible."""
    for batch in batches:
        a, b, n, m = (np.asarray(batch.column(c)) for c in ("a", "b", "n", "m"))
        x, y = ([np.frombuffer(v.as_buffer(), "<u8") for v in batch.column(c)] for c in ("x", "y"))
        width = np.array([len(v) for v in x]) << 32 | np.array([len(v) for v in y], "i8") if len(x) else np.zeros(0, "i8")
        ok = np.zeros(len(a), bool)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            most = most_shared(np.stack([x[i] for i in rows]), n[rows], np.stack([y[i] for i in rows]), m[rows])
            ok[rows] = linked(most, n[rows], m[rows])
        yield pa.RecordBatch.from_arrays([pa.array(a[ok], pa.int64()), pa.array(b[ok], pa.int64())], ["a", "b"])


def set_rows(ids: list, sets: list[bytes]) -> pa.RecordBatch:
    sid = [xxhash.xxh3_64_intdigest(h) - (1 << 63) for h in sets]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sid, pa.int64()), pa.array(sets, pa.binary())],
                                      ["doc_id", "sid", "h"])


def set_bytes(told):
    """(doc_id, sid, h) of the documents that a bit table of their ids' hashes lets through."""
    def run(batches):
        bits = told.value
        for b in batches:
            at = np.asarray(b.column("at"))
            b = b.filter(pa.array((bits[at >> 6] >> (at & 63).astype("u8") & np.uint64(1)).astype(bool)))
            ids, held, sets = [], 0, []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids.append(i)
                sets.append(shingle_set(t).tobytes())
                held += len(sets[-1])
                if held >= BATCH_BYTES:
                    yield set_rows(ids, sets)
                    ids, held, sets = [], 0, []
            yield set_rows(ids, sets)
    return run


def id_slot() -> Column:
    return F.xxhash64("doc_id").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bit table, of fixed size, of the hashes of ``ids(doc_id)``: it lets all
    of them through, and others by chance only."""
    words = (ids.select(id_slot().alias("at")).groupBy(F.shiftright("at", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")))
    out = np.zeros(1 << FILTER_BITS - 6, "i8")
    for r in words.collect():  # at most 2^(FILTER_BITS - 6) rows
        out[r["w"]] = r["b"]
    return out.view("u8")


def sets_of(rows: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """(cid, n, h, group, blocks) of the classes ``wanted``. Most other
    documents drop out where they are read; the rest meet in a join."""
    told = rows.sparkSession.sparkContext.broadcast(id_bits(wanted.select(F.col("low").alias("doc_id"))))
    found = (rows.select("doc_id", "text", id_slot().alias("at"))
             .mapInArrow(set_bytes(told), "doc_id long, sid long, h binary"))
    wanted = wanted.withColumnRenamed("sid", "class_sid")
    sets = (found.join(wanted, found["doc_id"].eqNullSafe(wanted["low"]) & (found["sid"] == wanted["class_sid"]))
            .select("cid", "n", "h", "group", "blocks"))
    return sets.dropDuplicates(["cid"]) if repeated else sets


def overlap_matrix(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact overlaps of each set of ``left`` with each of ``right``, added up
    over slices of the hashes' range, so that memory doesn't grow with the sets."""
    out = np.zeros((len(left), len(right)), "i4")
    slices = -(-sum(map(len, left + right)) // SLICE)
    if slices <= 1:
        add_overlaps(out, left, right)
        return out
    edges = np.array([i * (1 << 64) // slices for i in range(1, slices)], "u8")

    def cut(h):
        return np.r_[0, np.searchsorted(h, edges), len(h)]

    at, to = [cut(h) for h in left], [cut(h) for h in right]
    for i in range(slices):
        add_overlaps(out, [h[c[i]:c[i + 1]] for h, c in zip(left, at)], [h[c[i]:c[i + 1]] for h, c in zip(right, to)])
    return out


def add_overlaps(out: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> None:
    """Add the overlaps of ``left`` with ``right`` to ``out``."""
    sizes = np.array([len(h) for h in left + right])
    tok, at = np.unique(np.concatenate(left + right), return_inverse=True)
    who = np.repeat(np.arange(len(sizes)), sizes)
    mine = who < len(left)
    a, b = (np.bincount(at[x], minlength=len(tok)) for x in (mine, ~mine))
    common = (a > 0) & (b > 0)
    # Shingles of few sets: every pair that shares one.
    few = common & (a + b < COMMON)
    order = np.argsort(at[few[at]], kind="stable")
    t, w = at[few[at]][order], who[few[at]][order]
    is_left = w < len(left)
    lt, lw, rt, rw = t[is_left], w[is_left], t[~is_left], w[~is_left] - len(left)
    for i, j in spans(np.searchsorted(rt, lt), np.searchsorted(rt, lt, "right")):
        np.add.at(out, (lw[i], rw[j]), 1)
    # Shingles of many sets: from the overlaps with the first set of ``left``.
    many = np.flatnonzero(common & (a + b >= COMMON))
    for s in range(0, len(many), 4_096):
        cols = many[s:s + 4_096]
        col = np.full(len(tok), -1)
        col[cols] = np.arange(len(cols))
        use = col[at] >= 0
        m = np.zeros((len(sizes), len(cols)), "f4")
        m[who[use], col[at[use]]] = 1
        y, w = m[:len(left)], m[len(left):]
        differ = (y != y[0]).any(axis=0)
        out += (w @ y[0]).astype("i4") + ((y[:, differ] - y[0, differ]) @ w[:, differ].T).astype("i4")


def compare(key, table):
    """Which sets of the block, or of its two halves, are linked."""
    cid, n = np.asarray(table["cid"]), np.asarray(table["n"])
    sets = [np.frombuffer(h.as_buffer(), "u8") for h in table["h"]]
    side = np.asarray(table["side"])
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if key[1].as_py() == key[2].as_py():
        b = a
    x, y = np.zeros(0, int), np.zeros(0, int)
    if len(a) and len(b):
        o = overlap_matrix([sets[i] for i in a], [sets[i] for i in b])
        x, y = np.nonzero(linked(o, n[a][:, None], n[b][None, :]) & (cid[a][:, None] != cid[b][None, :]))
    node, root = lowest(cid[a[x]], cid[b[y]])
    return pa.table({"cid": node, "root": root})


def fold(maps: np.ndarray) -> np.ndarray:
    """Bit maps of half the width: the low bits with one bit less."""
    half = maps.shape[1] // 2
    return maps[:, :half] | maps[:, half:]


def spilt(maps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many shingles of each set fell on a bit that another one had set."""
    return n - np.bitwise_count(maps).sum(axis=1, dtype="i8")


def sift(key, table):
    """Which sets of the block, or of its two halves, hang together by pairs
    that their bit maps leave possible."""
    cid, n, side = (np.asarray(table[c]) for c in ("cid", "n", "side"))
    maps = [np.frombuffer(x.as_buffer(), "<u8") for x in table["bits"]]
    same = key[1].as_py() == key[2].as_py()
    right = np.flatnonzero(side == (0 if same else 1))
    right = right[np.argsort(n[right], kind="stable")]
    words = np.array([len(m) for m in maps])
    # Right-hand maps by width, and folded to half of it for sets of smaller maps.
    by_width = {}
    for w in np.unique(words[right]):
        rows = right[words[right] == w]
        m = np.stack([maps[i] for i in rows])
        by_width[int(w), int(w)] = rows, n[rows], m, spilt(m, n[rows])
        if w > 1:
            m = fold(m)
            by_width[int(w), int(w) // 2] = rows, n[rows], m, spilt(m, n[rows])
    a, b, held, found = [], [], 0, []
    for i in np.flatnonzero(side == 0):
        x = maps[i][None, :]
        for w in (len(maps[i]) // 2, len(maps[i]), len(maps[i]) * 2):
            mine = fold(x) if 2 * w == x.shape[1] else x
            rows, sizes, m, lost = by_width.get((w, mine.shape[1]), (None, np.zeros(0, "i8"), None, None))
            lo, hi = np.searchsorted(sizes, -(-3 * n[i] // 4)), np.searchsorted(sizes, 4 * n[i] // 3, "right")
            if lo < hi:
                most = np.bitwise_count(m[lo:hi] & mine).sum(axis=1, dtype="i8") + np.minimum(lost[lo:hi], spilt(mine, n[i])[0])
                y = cid[rows[lo:hi][linked(most, n[i], sizes[lo:hi])]]
                y = y[y != cid[i]]
                a.append(np.full(len(y), cid[i]))
                b.append(y)
                held += len(y)
        if held > MAP_PAIRS:
            found.append(lowest(np.concatenate(a), np.concatenate(b)))
            a, b, held = [], [], 0
    a, b = (np.concatenate([*x, *(f[k] for f in found), np.zeros(0, "i8")]) for k, x in enumerate((a, b)))
    node, root = lowest(a, b)
    return pa.table({"cid": node, "root": root})


def blocked(families: DataFrame, keyed: DataFrame, scratch: Scratch, name: str, sets: int, shingles: int, bin_shingles: int) -> DataFrame:
    """(cid, sid, low, n, blocks, group) of each set of ``families(id, root)``: families
    of more than ``sets`` or about ``shingles`` are groups of several blocks, smaller
    ones share a group by hash."""
    members = families.select(F.col("id").alias("cid"), F.col("root").alias("family")).join(
        keyed.select("cid", "sid", "low", "n"), "cid")
    members = scratch.keep(members, f"{name}_members")
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("m") / sets), F.ceil(F.col("total") / shingles)).cast("int"))
    sizes = scratch.keep(sizes, f"{name}_sizes")
    small = sizes.where("blocks = 1").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("m"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    bins = max(1, -(-small["m"] // (sets // 2)), -(-small["total"] // bin_shingles))
    wanted = members.join(sizes.select("family", "blocks"), "family").select(
        "cid", "sid", "low", "n", "blocks",
        F.when(F.col("blocks") > 1, F.col("family")).otherwise(-1 - F.pmod(F.xxhash64("family"), F.lit(bins))).alias("group"))
    wanted = scratch.keep(wanted, f"{name}_wanted")
    scratch.drop(f"{name}_members", f"{name}_sizes")
    return wanted


def meeting(sets: DataFrame, what: str) -> DataFrame:
    """Each set once for each pair of blocks of its group that its own block is in."""
    s = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    return (sets.withColumn("s", s).select("group", "cid", "n", what, "s", F.explode(F.expr("sequence(0, blocks - 1)")).alias("o"))
            .select("group", F.least("s", "o").alias("l"), F.greatest("s", "o").alias("g"),
                    F.when(F.col("s") <= F.col("o"), 0).otherwise(1).alias("side"), "cid", "n", what)
            .groupBy("group", "l", "g"))


def maps_of(summary: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """The classes ``wanted(cid, sid, low, ...)`` with their bit maps."""
    maps = summary.where("chunk is null").select("doc_id", F.col("sid").alias("doc_sid"), "bits")
    maps = (maps.join(wanted, maps["doc_id"].eqNullSafe(wanted["low"]) & (maps["doc_sid"] == wanted["sid"]))
            .drop("doc_id", "doc_sid", "sid", "low"))
    return maps.dropDuplicates(["cid"]) if repeated else maps


def tested_ties(ties: DataFrame, keyed: DataFrame, summary: DataFrame, scratch: Scratch, repeated: bool) -> DataFrame:
    """The ``ties(a, b, sure)`` of centres without those of which no two members can be linked by their bit maps."""
    centres = keyed.groupBy("centre").agg(F.count(F.lit(1)).alias("size"))
    few = F.col("size_a") * F.col("size_b") <= TIE_MEMBERS
    sized = (ties.where("not sure").join(centres.select(F.col("centre").alias("a"), F.col("size").alias("size_a")), "a")
             .join(centres.select(F.col("centre").alias("b"), F.col("size").alias("size_b")), "b"))
    sized = scratch.keep(sized.select("a", "b", few.alias("few")), "tie_sizes")
    x, y = (keyed.select(F.col("centre").alias(c), F.col("cid").alias(f"cid_{c}"), F.col("n").alias(n)) for c, n in (("a", "n"), ("b", "m")))
    pairs = (sized.where("few").select("a", "b").join(x, "a").join(y, "b").where("3 * n <= 4 * m and 3 * m <= 4 * n"))
    pairs = scratch.keep(pairs, "tie_pairs")
    wanted = pairs.select(F.col("cid_a").alias("cid")).union(pairs.select("cid_b")).distinct()
    maps = scratch.keep(maps_of(summary, keyed.select("cid", "sid", "low").join(wanted, "cid"), repeated), "tie_maps")
    both = (pairs.join(maps.select(F.col("cid").alias("cid_a"), F.col("bits").alias("x")), "cid_a")
            .join(maps.select(F.col("cid").alias("cid_b"), F.col("bits").alias("y")), "cid_b").select("a", "b", "n", "m", "x", "y"))
    left = both.mapInArrow(possible, "a long, b long").distinct()
    left = scratch.keep(left.union(sized.where("not few").select("a", "b")).union(ties.where("sure").select("a", "b")), "tested")
    scratch.drop("tie_sizes", "tie_pairs", "tie_maps")
    return left


def proposals(classes: DataFrame) -> DataFrame:
    """(cid, centre): for each class the smallest class that agrees with it in
    VOTES of the minima, if that is smaller and hangs on none itself."""
    each = classes.select("cid", F.posexplode("minima").alias("i", "m"))
    ends = each.groupBy("i", "m").agg(F.min("cid").alias("lo"))
    votes = (each.join(ends, ["i", "m"]).where("lo < cid").groupBy("cid", "lo").agg(F.count(F.lit(1)).alias("v"))
             .where(F.col("v") >= VOTES).groupBy("cid").agg(F.min("lo").alias("centre")))
    return votes


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, root) of every row: link if Jaccard >= 0.75.

    A-Z are lower-cased, words are runs of anything but ASCII white space, a
    set holds the distinct five-word shingles (of fewer words: all of them as
    one). Null or blank texts have empty sets, link with nothing and are
    components of their own. Equal texts link; repeated ids keep a row each;
    rows without an id take part, and a component's id is its smallest
    non-null id; ``root`` is the same for the rows of a component and null
    for empty sets. Very long texts are read whole. Extra columns are ignored;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    sc = spark.sparkContext
    scratch = Scratch(spark, "jaccard")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    summary = scratch.keep(hashed.mapInArrow(summarise, SUMMARY), "summary")
    per_doc = summary.where("chunk is null").select("doc_id", "text_hash", "n_shingles", "sid", "minima")
    classes = (per_doc.where("n_shingles > 0").groupBy("sid", F.col("n_shingles").alias("n"))
               .agg(F.min("doc_id").alias("low"), F.first("minima").alias("minima"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = scratch.keep(classes, "classes")
    counts = shingle_counts(summary)
    # In eighths of a doubling: rare shingles must be told from the bucket's other ones.
    rank = np.minimum(np.floor(8 * np.log2(counts + 1.0)), 255).astype("u1")
    long_lists = np.flatnonzero(counts > HOT_LIST)
    hot = (long_lists.astype("i4"), np.minimum(-(-counts[long_lists].astype("i8") // HOT_LIST), (1 << 21) - 1))
    told = sc.broadcast((rank, hot))

    # Centres: a class hangs on the smallest similar one, if that hangs on none.
    near = scratch.keep(proposals(classes), "near")
    hangs = near.join(near.select(F.col("cid").alias("centre")), "centre", "left_anti").select("cid", "centre")
    keyed = (classes.select("cid", "sid", "n", "low").join(hangs, "cid", "left")
             .withColumn("centre", F.coalesce("centre", "cid")))
    keyed = scratch.keep(keyed, "keyed")

    # Families: what hangs together by the inverted lists.
    prefix = keyed.agg(F.sum(F.expr("n - (3 * n + 3) div 4 + 1"))).first()[0] or 0
    parts = int(max(1, -(-prefix // POSTINGS)))
    lists = (rows.join(keyed, rows["doc_id"].eqNullSafe(keyed["low"])).select("text", "sid", "centre")
             .mapInArrow(postings(told, parts), "part long, split long, blob binary"))
    ties = lists.groupBy("part", "split").applyInArrow(candidates(parts), "a long, b long, sure boolean")
    ties = scratch.keep(ties.groupBy("a", "b").agg(F.max("sure").alias("sure")), "ties")
    repeated = not per_doc.groupBy("doc_id", "sid").count().where("count > 1").isEmpty()
    ties = tested_ties(ties, keyed, summary, scratch, repeated)
    hung = keyed.where("cid <> centre").select(F.col("cid").alias("a"), F.col("centre").alias("b"))
    families = scratch.keep(components(ties.union(hung), scratch, "family"), "families")

    # Bit maps of each family meet block by block; what they leave possible makes smaller families.
    wanted = blocked(families, keyed, scratch, "map", MAP_BLOCK, MAP_BLOCK_SHINGLES, MAP_BIN_SHINGLES)
    maps = maps_of(summary, wanted, repeated)
    left = scratch.keep(meeting(maps, "bits").applyInArrow(sift, "cid long, root long"), "left")
    left = components(left.select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch, "left")
    left = scratch.keep(left, "left_families")

    # The sets of those meet likewise.
    wanted = blocked(left, keyed, scratch, "set", BLOCK, BLOCK_SHINGLES, BIN_SHINGLES)
    sets = sets_of(rows, wanted, repeated)
    links = scratch.keep(meeting(sets, "h").applyInArrow(compare, "cid long, root long"), "links")
    first = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch, "linked")
    joined = classes.select("sid", "n", "cid", "low").join(first.withColumnRenamed("id", "cid"), "cid", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cid"))
    lows = joined.groupBy("root").agg(F.min("low").alias("component"))
    found = joined.join(lows, "root").select("sid", F.col("n").alias("n_shingles"), "component", "root")
    out = (per_doc.select("doc_id", "text_hash", "n_shingles", "sid").join(found, ["sid", "n_shingles"], "left")
           .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component"))
                   .otherwise(F.col("doc_id")).alias("component_id"), "text_hash", "root"))
    out = scratch.keep(out, "out")
    scratch.drop("summary", "classes", "near", "keyed", "ties", "tested", "families", "map_wanted", "left", "left_families", "set_wanted", "links")
    return out


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with
    the smallest id (then text hash) stays, once, and so does every row
    without words. Rows without an id stay only if their whole component has
    none. All columns pass through.
    """
    found = jaccard_components(docs, doc_id=doc_id, text=text)
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    firsts = found.where("root is not null").groupBy("root").agg(F.min(who).alias("x")).select("x.doc_id", "x.text_hash")
    stay = firsts.join(found.where("root is not null"), [firsts["doc_id"].eqNullSafe(found["doc_id"]), firsts["text_hash"] == found["text_hash"]])
    stay = stay.groupBy(firsts["doc_id"], firsts["text_hash"]).agg(F.count(F.lit(1)).alias("copies"))
    empty = found.where("root is null").select("doc_id", "text_hash", F.lit(1).cast("long").alias("copies")).distinct()
    stay = Scratch(docs.sparkSession, "kept").keep(stay.union(empty), "kept")
    mine = docs.withColumn("_h", F.xxhash64(F.col(text).cast("string")))

    def rows(which):
        return (mine.join(which, mine[doc_id].cast("long").eqNullSafe(which["doc_id"]) & (mine["_h"] == which["text_hash"]), "left_semi"))

    once = rows(stay.where("copies = 1")).select(docs.columns)
    again = stay.where("copies > 1")
    if again.isEmpty():
        return once
    return once.union(rows(again).dropDuplicates([doc_id, "_h"]).select(docs.columns))
