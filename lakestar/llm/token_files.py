"""Token-ID / binary output: flat unsigned integer files plus 64-bit offsets.

A token set is a folder of parts in ascending doc_id order:

``part-K.bin``  token ids, little-endian, uint16 if the vocabulary fits, else uint32
``part-K.idx``  int64 offsets of the part's documents in the whole set, and the end
``part-K.ids``  int64 doc ids (null: the smallest int64)

and ``index.json`` with the dtype and, for each part in order, its names,
documents and first offset. Any document is a slice of a memory-mapped file.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, open_fs, ship
from .grams import Cutter

NO_ID = np.iinfo("i8").min
CACHE_WORDS = 3_000_000  # encoded words that a worker keeps, about 40 bytes each
CACHE_PIECES = 300_000  # encoded pieces of words, about 250 bytes each
PART_BYTES = 256 << 20  # of texts in a part, about
SPACES = b" \t\n\x0b\x0c\r"
MARKS = b".,;:!?%&$#*)]}"  # cut off the ends of words
_encoders: dict = {}  # by tokenizer file: a worker's tokenizer and encoded words


class Encoder:
    """Encodes whole texts.

    A tokenizer whose pattern parts white space, letters and marks (``parts``)
    never joins what white space separates, so a text's ids are its words'
    ids in a row: words are told apart by 64-bit hashes of arrays of bytes,
    and each different one is encoded once. Only ASCII white space splits
    here; the tokenizer itself handles any other. A word's trailing marks are
    encoded on their own, and plain letters in lower case if the tokenizer
    lower-cases anyway: so fewer different pieces need encoding. Texts of any
    other tokenizer are encoded whole.
    """

    def __init__(self, path: str, dtype: str, end_id: int):
        from tokenizers import Tokenizer

        self.tok, self.dtype, self.end_id = Tokenizer.from_file(path), dtype, end_id
        rules = self.tok.to_str()
        self.parts = r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in rules
        self.lowers = '{"type":"Lowercase"}' in rules.replace(" ", "").replace("\n", "")
        self.cutter = Cutter(SPACES, fold=False)
        self.pieces: dict[bytes, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        """Empty the pool of words; its first one is the end id."""
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and their words
        self.pool, self.ids = np.array([self.end_id], self.dtype), 1
        self.first, self.size, self.words = np.zeros(1, np.int64), np.ones(1, np.int64), 1

    def cut(self, word: bytes) -> tuple[bytes, ...]:
        base = word.rstrip(MARKS)
        if self.lowers and base.isalpha() and base.isascii():
            return (base.lower(), word[len(base):]) if len(base) < len(word) else (base.lower(),)
        if not base or len(base) == len(word):
            return (word,)
        last = base[-1:].decode() if base[-1] < 128 else base.decode("utf-8", "replace")[-1]
        # Letters whose lower case ends in another character (a dot above, say) may join a mark.
        if last.isdigit() and base[-1] < 128 or last.isalpha() and len(last.lower()) == 1:
            return base, word[len(base):]
        return (word,)

    def encoded(self, pieces: list[bytes]) -> list[np.ndarray]:
        got = self.tok.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)
        return [np.array(e.ids, self.dtype) for e in got]

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words to the pool (hashes in order)."""
        cuts = [self.cut(w) for w in words]
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {}
        new = list({p for c in cuts for p in c if p not in self.pieces})
        for i in range(0, len(new), 10_000):
            self.pieces.update(zip(new[i:i + 10_000], self.encoded(new[i:i + 10_000])))
        found = [self.pieces[p] for c in cuts for p in c]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        many = np.fromiter(map(len, cuts), np.int64, len(cuts))
        sizes = np.add.reduceat(sizes, np.cumsum(many) - many)
        total, n = self.ids + int(sizes.sum()), self.words + len(words)
        if total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(total, self.dtype)])
        if n > len(self.size):
            self.first, self.size = (np.concatenate([x, np.zeros(n, np.int64)]) for x in (self.first, self.size))
        self.pool[self.ids:total] = np.concatenate(found)
        self.first[self.words:n] = self.ids + np.cumsum(sizes) - sizes
        self.size[self.words:n] = sizes
        at = np.searchsorted(self.keys, hashes)
        self.keys, self.slots = np.insert(self.keys, at, hashes), np.insert(self.slots, at, np.arange(self.words, n))
        self.ids, self.words = total, n

    def encode(self, column):
        """(ids, ids of each row, whether the last row goes on) of an Arrow
        binary column, run by run; every row ends with the end id."""
        if not self.parts:
            for i, j in slices(texts := [t.decode("utf-8", "replace") for t in column.to_pylist()]):
                got = [np.r_[e.ids, self.end_id] for e in self.tok.encode_batch_fast(texts[i:j], add_special_tokens=False)]
                yield np.concatenate(got).astype(self.dtype), np.array([len(x) for x in got]), False
            return
        for run in self.cutter(column):
            if self.words > CACHE_WORDS:
                self.forget()
            different, first, which = np.unique(run.hashes, return_index=True, return_inverse=True)
            at = np.searchsorted(self.keys, different)
            at[at == len(self.keys)] = 0
            slots = np.where(self.keys[at] == different, self.slots[at], -1) if len(self.keys) else np.full(len(different), -1)
            new = np.flatnonzero(slots < 0)
            if len(new):
                raw = run.data.tobytes()
                self.learn(different[new], [raw[i:j] for i, j in zip(run.starts[first[new]].tolist(), run.stops[first[new]].tolist())])
                slots[new] = np.arange(self.words - len(new), self.words)
            ended = run.rows if run.ends else run.rows - 1
            words = np.bincount(run.row, minlength=run.rows)
            words[:ended] += 1
            slot = np.zeros(words.sum(), np.int64)  # 0: the end
            slot[np.arange(len(run.row)) + run.row] = slots[which]
            size = self.size[slot]
            upto = np.cumsum(size)
            ids = self.pool[np.repeat(self.first[slot] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)]
            yield ids, np.diff(np.r_[0, upto][np.r_[0, np.cumsum(words)]]), not run.ends


def encoder(path: str, dtype: str, end_id: int) -> Encoder:
    if (path, dtype, end_id) not in _encoders:
        _encoders[path, dtype, end_id] = Encoder(path, dtype, end_id)
    return _encoders[path, dtype, end_id]


def slices(texts: list, most: int = 4_000_000):
    """Runs of texts of at most ``most`` characters (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def writer(folder: str, tokenizer: str, dtype: str, end_id: int):
    """Writes a partition as one part. Its row names the files, so those of a
    failed or repeated attempt are never part of the set."""
    def run(batches):
        fs, root = open_fs(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex[:12]}"
        enc, lengths, ids = encoder(tokenizer, dtype, end_id), array("q"), array("q")
        with fs.open_output_stream(f"{root}/{name}.bin") as out:
            for b in batches:
                goes_on = False
                for tokens, sizes, more in enc.encode(b.column("text")):
                    out.write(tokens.tobytes())
                    if goes_on:
                        lengths[-1] += int(sizes[0])
                        sizes = sizes[1:]
                    lengths.extend(sizes.tolist())
                    goes_on = more
                ids.extend(b.column("doc_id").fill_null(NO_ID).to_pylist())
        if not ids:
            fs.delete_file(f"{root}/{name}.bin")
            return
        for suffix, values in (("len", lengths), ("ids", ids)):
            with fs.open_output_stream(f"{root}/{name}.{suffix}") as out:
                out.write(np.array(values, "<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(ids)], pa.int64()),
                                          pa.array([sum(lengths)], pa.int64())], ["part", "name", "docs", "tokens"])
    return run


def offset_writer(folder: str):
    def run(batches):
        fs, root = open_fs(folder)
        for b in batches:
            for r in b.to_pylist():
                with fs.open_input_stream(f"{root}/{r['name']}.len") as f:
                    lengths = np.frombuffer(f.read(), "<i8")
                offsets = np.concatenate([[0], np.cumsum(lengths)]) + r["base"]
                with fs.open_output_stream(f"{root}/{r['name']}.idx") as out:
                    out.write(offsets.astype("<i8").tobytes())
                yield pa.RecordBatch.from_pylist([{"name": r["name"]}])
    return run


def write_tokens(docs: DataFrame, folder: str, *, tokenizer: str, end_id: int, doc_id: str = "doc_id",
                 text: str = "text", parts: int | None = None) -> dict:
    """Encode ``docs`` into a token set at ``folder`` (a place all executors share); its index.

    Null texts are empty: the end id alone. Null ids come first. Rows with
    equal ids are ordered by their text's hash; equal rows are interchangeable.
    An empty table gives a set without parts. Extra columns are ignored.

    One range shuffle orders the texts, each task streams its range to one
    part, and the parts' bases are prefix sums of their token counts (one row
    a part on the driver).
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    dtype = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    done = ordered.mapInArrow(writer(folder, tokenizer, dtype, end_id),
                              "part int, name string, docs long, tokens long").collect()
    done.sort(key=lambda r: r["part"])
    bases = [0, *accumulate(r["tokens"] for r in done)]
    index = {"dtype": dtype, "end_id": end_id, "tokens": bases[-1],
             "parts": [{"name": r["name"], "docs": r["docs"], "base": b} for r, b in zip(done, bases)]}
    if done:
        bases_df = spark.createDataFrame([(p["name"], p["base"]) for p in index["parts"]],
                                         "name string, base long").repartition(min(len(done), parts), "name")
        bases_df.mapInArrow(offset_writer(folder), "name string").collect()
        for p in index["parts"]:
            fs.delete_file(f"{root}/{p['name']}.len")
    with fs.open_output_stream(f"{root}/index.json") as out:
        out.write(json.dumps(index).encode())
    return index


def map_file(fs, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is mounted."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if fs.get_file_info(path).size else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def reader(folder: str, dtype: str, rows: int = 2_000):
    def run(batches):
        fs, root = open_fs(folder)
        for b in batches:
            for r in b.to_pylist():
                at = f"{root}/{r['name']}"
                ids, offsets = map_file(fs, f"{at}.ids", "<i8"), map_file(fs, f"{at}.idx", "<i8")
                tokens = map_file(fs, f"{at}.bin", dtype)
                for i in range(r["first"], r["last"], rows):
                    j = min(i + rows, r["last"])
                    cut = [tokens[offsets[k] - offsets[0]:offsets[k + 1] - offsets[0]] for k in range(i, j)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[i:j], mask=np.asarray(ids[i:j] == NO_ID)), pa.array(np.asarray(offsets[i:j])),
                         pa.array(np.diff(offsets[i:j + 1])),
                         pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut], pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_digests(spark: SparkSession, folder: str, rows_per_task: int = 20_000) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    ship(spark)
    fs, root = open_fs(folder)
    with fs.open_input_stream(f"{root}/index.json") as f:
        index = json.loads(f.read())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    runs = [(p["name"], i, min(i + rows_per_task, p["docs"])) for p in index["parts"]
            for i in range(0, p["docs"], rows_per_task)]
    if not runs:
        return spark.createDataFrame([], schema)
    runs_df = spark.createDataFrame(runs, "name string, first long, last long")
    return runs_df.repartition(len(runs)).mapInArrow(reader(folder, index["dtype"]), schema)


def token_digests(docs: DataFrame, *, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as a token set and read the documents' digests back from it."""
    spark = docs.sparkSession
    folder = folder or f"{Scratch(spark, 'tokens').root}/set"
    write_tokens(docs, folder, tokenizer=tokenizer, end_id=end_id)
    return read_digests(spark, folder)
