"""Language ID: segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public
vocabulary. A word's probability is the sum over all ways to cut it into
pieces, by a forward pass over its characters; a text's is the product over
its words. The piece probabilities are learned by expectation maximisation
over the same sums.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import seeded, ship

WORD = re.compile(r"[^\W\d_]+")
START = "▁"  # marks the start of a word in the vocabulary
UNKNOWN = 1e-7  # probability of a character that no piece covers
LOW, LIFT = 1e-150, 1e150
LEAST = 1e-290
CACHE_WORDS = 300_000  # scored words that a worker keeps, about 200 bytes each
CACHE_VALUES = 4_000_000  # log-probabilities of those, 8 bytes each
CACHE_CHARS = 40  # longer words are scored anew each time
SHORT = 4  # characters of a substring that is often a piece, below
TOGETHER = 2_000  # words whose forward passes run as one
BATCH_CHARS = 2_000_000  # texts whose new words are scored together, in characters
UNDETERMINED = "und"
# A text is unlike a language if a letter's log-probability is further below the median of the
# language's own texts than SPREADS times the way from there to their LOW_SHARE quantile (at least MARGIN).
# A whole text may fall short of that by ALLOWED besides: a key or a name in a short text isn't noise.
SPREADS, LOW_SHARE, MARGIN, ALLOWED = 3.5, 0.01, 3.0, 60.0


def load_pieces(path: str) -> list[str]:
    """The vocabulary's pieces, lower-cased, letters only; learned for none in particular."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())}
    return sorted(p for p in found if p.removeprefix(START) and (p.removeprefix(START)).isalpha())


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def cuts(word: str, pieces, longest: int):
    """(start, end, piece) of every piece in the marked word, by end; characters
    that no piece covers are there as unknown pieces (None)."""
    n = len(word)
    for j in range(1, n + 1):
        for i in range(max(0, j - longest), j):
            p = word[i:j]
            if p in pieces:
                yield i, j, p
            elif i == j - 1:
                yield i, j, None


def expected_counts(words: Counter, prob: dict[str, float], longest: int) -> Counter:
    """Expected number of times each piece is used, over all segmentations."""
    out: Counter = Counter()
    for w, n in words.items():
        word = START + w
        found = list(cuts(word, prob, longest))
        fwd, back = [0.0] * (len(word) + 1), [0.0] * (len(word) + 1)
        fwd[0] = back[-1] = 1.0
        for i, j, p in found:
            fwd[j] += fwd[i] * (prob[p] if p else UNKNOWN)
        for i, j, p in reversed(found):
            back[i] += back[j] * (prob[p] if p else UNKNOWN)
        if fwd[-1] <= 0:
            continue
        scale = n / fwd[-1]
        for i, j, p in found:
            if p:
                out[p] += fwd[i] * prob[p] * back[j] * scale
    return out


def learn(words: Counter, pieces: list[str], rounds: int, smooth: float) -> dict[str, float]:
    longest = max(map(len, pieces))
    prob = dict.fromkeys(pieces, 1 / len(pieces))
    for _ in range(rounds):
        got = expected_counts(words, prob, longest)
        total = sum(got.values()) + smooth * len(pieces)
        prob = {p: (got.get(p, 0.0) + smooth) / total for p in pieces}
    return prob


class Scorer:
    """Log-probabilities of words by language, by the scaled forward pass."""

    def __init__(self, langs: list[str], table: dict[str, tuple]):
        self.langs, self.table = langs, table
        # Words that have been scored, by their rows in ``sums`` (a tuple of floats each takes nearly twice the memory).
        self.known: dict[str, int] = {}
        self.sums, self.uses = np.empty((1, len(langs))), np.zeros(1, "i8")
        self.most = min(CACHE_WORDS, CACHE_VALUES // max(1, len(langs)))
        self.longest = max(map(len, table), default=1)
        self.rows = {p: i for i, p in enumerate(table)}
        # Two rows more: a character that no piece covers, and no piece at all.
        self.probs = np.array([*table.values(), (UNKNOWN,) * len(langs), (0.0,) * len(langs)], np.float64).reshape(len(table) + 2, len(langs))

    def word(self, w: str) -> tuple:
        if (at := self.known.get(w)) is not None:
            return tuple(self.sums[at].tolist())
        word, n = START + w, len(w) + 1
        found, lost = [], (UNKNOWN,) * len(self.langs)
        table = self.table
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                p = table.get(word[i:j])
                if p is not None:
                    found.append((i, j, p))
                elif i == j - 1:
                    found.append((i, j, lost))
        out = []
        for k in range(len(self.langs)):
            f, log, at = [1.0] + [0.0] * n, 0.0, 0
            for i, j, p in found:
                if j != at:  # f[at] is complete
                    if f[at] < LOW:
                        for x in range(max(0, at - self.longest), at + 1):
                            f[x] *= LIFT
                        log -= math.log(LIFT)
                    at = j
                f[j] += f[i] * p[k]
            out.append(math.log(f[n]) + log if f[n] > 0 else -1e3)
        if len(w) <= CACHE_CHARS:
            self.keep([w], [out])
        return tuple(out)

    def keep(self, words: list[str], logs: list[list[float]]) -> None:
        """Remember the log-probabilities of words that aren't known yet."""
        n, end = len(self.known), len(self.known) + len(words)
        if end > len(self.sums):
            more = max(end, 2 * len(self.sums)) - n
            self.sums = np.concatenate([self.sums[:n], np.empty((more, len(self.langs)))])
            self.uses = np.concatenate([self.uses[:n], np.zeros(more, "i8")])
        self.sums[n:end], self.uses[n:end] = logs, 0
        self.known.update(zip(words, range(n, end)))

    def forget(self) -> None:
        """Drop all but the words of the most texts, half as many as are kept at most."""
        rows = np.sort(np.argsort(-self.uses[:len(self.known)], kind="stable")[:self.most // 2])
        words = list(self.known)  # in the order of their rows
        self.known = {words[row]: i for i, row in enumerate(rows.tolist())}
        self.sums, self.uses = self.sums[rows], self.uses[rows] // 2

    def score_new(self, words: set[str]) -> None:
        """Score the words that aren't known yet: those of a length in one
        forward pass over arrays (words by languages). A word whose sums come
        near the least number, or one too long to be kept, is left to ``word``.
        The only place that forgets words, so that those of a batch stay until
        its texts are summed."""
        if len(self.known) >= self.most:
            self.forget()
        by_size: dict[int, list[str]] = {}
        for w in words:
            if len(w) <= CACHE_CHARS and w not in self.known:
                by_size.setdefault(len(w), []).append(w)
        get, unknown, none = self.rows.get, len(self.rows), len(self.rows) + 1
        for size, found in by_size.items():
            for k in range(0, len(found), TOGETHER):
                some = found[k:k + TOGETHER]
                marked = [START + w for w in some]
                f = np.zeros((size + 2, len(some), len(self.langs)))
                f[0] = 1.0
                for j in range(1, size + 2):
                    for i in range(max(0, j - self.longest), j):
                        miss = unknown if i == j - 1 else none
                        pieces = np.fromiter(map(get, [m[i:j] for m in marked], repeat(miss)), np.int64, len(some))
                        if j - i < SHORT:
                            f[j] += f[i] * self.probs[pieces]
                        elif len(hits := np.flatnonzero(pieces != none)):  # few of the longer substrings are pieces
                            f[j, hits] += f[i, hits] * self.probs[pieces[hits]]
                told = [(w, list(map(math.log, sums))) for w, sums in zip(some, f[-1].tolist()) if min(sums) > LEAST]
                if told:
                    self.keep(*map(list, zip(*told)))

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float, int]]:
        """(language, its posterior under equal priors, log-probability in it, letters) of each text."""
        out, waiting, size = [], [], 0
        for k, text in enumerate(texts):
            waiting.append(Counter(words_of(text)))
            size += len(text or "")
            if size >= BATCH_CHARS or k == len(texts) - 1:
                if self.langs:
                    self.score_new({w for words in waiting for w in words})
                out += map(self.total, waiting)
                waiting, size = [], 0
        return out

    def predict(self, text: str | None) -> tuple[str, float, float, int]:
        return self.predict_all([text])[0]

    def total(self, words: Counter) -> tuple[str, float, float, int]:
        if not self.langs or not any(any(map(str.isalpha, w)) for w in words):
            return UNDETERMINED, 0.0, 0.0, 0
        counts = np.fromiter(words.values(), np.float64, len(words))
        rows = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        told = rows >= 0
        self.uses[rows[told]] += 1
        logs = np.empty((len(rows), len(self.langs)))
        logs[told] = self.sums[rows[told]]
        if not told.all():
            logs[~told] = [self.word(w) for w, known in zip(words, told) if not known]
        total = (logs * counts[:, None]).sum(axis=0).tolist()
        best = max(range(len(total)), key=lambda k: total[k])
        letters = sum(len(w) * n for w, n in words.items())
        return self.langs[best], 1 / sum(math.exp(max(-700.0, t - total[best])) for t in total), total[best], letters


def least_likely(texts: list[str], lang: str, prob: dict[str, float]) -> float:
    """The least log-probability a letter that a text of the language has, judged by its own texts."""
    told = Scorer([lang], {p: (x,) for p, x in prob.items()}).predict_all(texts)
    own = np.array([x[2] / x[3] for x in told if x[0] == lang])
    if not len(own):
        return -math.inf
    middle = float(np.median(own))
    return middle - max(SPREADS * (middle - float(np.quantile(own, LOW_SHARE))), MARGIN)


_scorers: dict = {}  # by model: a worker's scorer and the words it has scored


def predictor(model_id: str, told, bounds: dict[str, float] | None):
    def run(batches):
        if model_id not in _scorers:
            _scorers.clear()
            langs, table = told.value
            _scorers[model_id] = Scorer(langs, table)
        scorer = _scorers[model_id]
        for b in batches:
            got = scorer.predict_all(b.column("_text").to_pylist())
            names = [c for c in b.schema.names if c != "_text"]
            found = {"lang_pred": pa.array([g[0] for g in got], pa.string()), "score": pa.array([g[1] for g in got], pa.float64())}
            if bounds is not None:
                found["likely"] = pa.array([g[0] in bounds and g[2] >= bounds[g[0]] * g[3] - ALLOWED for g in got], pa.bool_())
            yield pa.RecordBatch.from_arrays([*map(b.column, names), *found.values()], [*names, *found])
    return run


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, *, vocabulary: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          docs_per_lang: int = 400, words_per_lang: int = 30_000, rounds: int = 3, smooth: float = 0.05,
          seed: int = 3, max_langs: int = 1_000, likelihoods: bool = False):
    """Piece probabilities by language: (languages, piece -> probabilities);
    with ``likelihoods`` also language -> least log-probability a letter.

    Learns from at most ``docs_per_lang`` labelled documents a language, not
    held out, taken by a seeded hash, and from the ``words_per_lang`` most
    frequent words among them: a bounded sample for fitting, read whole.
    """
    ship(docs.sparkSession)
    pieces = load_pieces(vocabulary)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"),
                       F.col(lang).cast("string").alias("_lang"))
    rows = rows.where(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~is_held_out(F.col("_id")))
    rows = rows.withColumn("_h", seeded(seed, "_id", "_text"))
    counts = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).limit(max_langs + 1)
    sizes = counts.collect()
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    if not sizes:
        return ([], {}, {}) if likelihoods else ([], {})
    spark = docs.sparkSession
    # The hash thins each language to about twice the bound before the rows are ranked.
    shares = spark.createDataFrame([(s["_lang"], min(2.0**32, 2.0**32 * 2 * docs_per_lang / s["_n"])) for s in sizes],
                                   "_lang string, _most double")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_id", "_text"))
    sample = rows.join(F.broadcast(shares), "_lang").where("_h < _most")

    def fit(table):
        words: Counter = Counter()
        for t in table["_text"].to_pylist():
            words.update(w for w in words_of(t) if len(w) <= CACHE_CHARS)
        most = dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:words_per_lang])
        prob = learn(Counter(most), pieces, rounds, smooth)
        lang = table["_lang"][0].as_py()
        least = least_likely(table["_text"].to_pylist(), lang, prob) if likelihoods else 0.0
        return pa.table({"lang": [lang] * len(pieces), "piece": pieces, "p": [prob[p] for p in pieces],
                         "least": [least] * len(pieces)})

    learned: dict[str, dict[str, float]] = {}
    bounds: dict[str, float] = {}

    def learn_from(some: DataFrame) -> None:
        most = some.withColumn("_r", rank).where(F.col("_r") <= docs_per_lang).select("_lang", "_text")
        for r in most.groupBy("_lang").applyInArrow(fit, "lang string, piece string, p double, least double").collect():  # bounded: pieces times languages
            learned.setdefault(r["lang"], {})[r["piece"]] = r["p"]
            bounds[r["lang"]] = r["least"]

    learn_from(sample)
    lost = [s["_lang"] for s in sizes if s["_lang"] not in learned]
    if lost:  # so few different rows that the hash left none: each counts once
        learn_from(rows.where(F.col("_lang").isin(lost)).dropDuplicates(["_lang", "_id", "_text"]))
    langs = sorted(learned)
    model = langs, {p: tuple(learned[x][p] for x in langs) for p in pieces}
    return (*model, bounds) if likelihoods else model


def identify(docs: DataFrame, model, *, text: str = "text", keep: list[str] | None = None,
             bounds: dict[str, float] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns ``keep`` (default: all).

    With ``bounds`` (of ``train``) also ``likely``: whether the text's letters
    are as probable as those of its language's own texts, or nearly so. Noise
    and most other scripts and languages aren't, and ``und`` never is.

    Only the text is looked at. A null text, or one without a letter, is
    ``und`` with score 0, as is everything if no language was learned.
    Upper case is lower-cased; very long texts and words are read whole;
    equal texts get equal predictions. A tie goes to the language first in
    the alphabet. An empty table gives an empty result; a column of
    ``docs`` named like a result column is replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    told = spark.sparkContext.broadcast(model)
    added = ("lang_pred", "score", *(() if bounds is None else ("likely",)))
    names = [c for c in (docs.columns if keep is None else keep) if c not in (*added, "_text")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text).cast("string").alias("_text"))
    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    if bounds is not None:
        schema = schema.add("likely", "boolean")
    return rows.mapInArrow(predictor(uuid.uuid4().hex, told, bounds), schema)


def predict_languages(docs: DataFrame, *, vocabulary: str, doc_id: str = "doc_id", **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row. A null id is not held out."""
    model = train(docs, vocabulary=vocabulary, doc_id=doc_id, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col("text"))
    return identify(rows, model, keep=["doc_id"]).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
