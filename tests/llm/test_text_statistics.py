"""LM scoring, ranked search and collocations against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lakestar.llm import bloom_lm, collocations, grams, lexical_search, pseudonyms, queries, token_files

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_tokens long, score string, key int"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def frame(spark, rows):
    """(doc_id, text, lang) rows with clashing extra columns."""
    return spark.createDataFrame([(i, t, g, "s", 0, "x", 1) for i, t, g in rows], DOC)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# -- n-gram helpers -----------------------------------------------------------

def test_runs_keep_words_whole():
    rng = random.Random(3)
    raw = b"".join(rng.choice([b"ab", b"c" * 40, b" ", b"\n ", b"\t"]) for _ in range(5_000))
    for most in (1, 7, 100, 1 << 20):
        parts = list(grams.runs(raw, lexical_search.GAP, most))
        assert b"".join(parts) == raw
        assert [w for p in parts for w in p.split()] == raw.split()
    assert list(grams.runs(b"", lexical_search.GAP)) == [b""]


@pytest.mark.parametrize("most", [1, 16, 300, 1 << 20])
def test_cutter_finds_the_words_of_every_row(most):
    rng = random.Random(most)
    texts = ["".join(rng.choice(["Ab", "ab", "É", "x" * 30, " ", ". ", "\n\t"]) for _ in range(rng.randrange(0, 120))) for _ in range(60)]
    texts += ["", "word", "w" * 1_000, " ", "a " * 500]
    column = pa.array([t.encode() for t in texts], pa.binary())
    for cut in (column, column.slice(7, 40)):
        want = [re.findall(r"[^ .\n\t]+", lower(t.decode())) for t in cut.to_pylist()]
        for overlap in (0, 4):
            got, by_hash = [[] for _ in want], {}
            for run in grams.Cutter(b" .\n\t", overlap, most)(cut):
                raw = run.data.tobytes()
                words = [raw[i:j].decode() for i, j in zip(run.starts, run.stops)]
                for k, (r, w) in enumerate(zip(run.row, words)):
                    by_hash.setdefault(w, set()).add(int(run.hashes[k]))
                    if k >= run.old:
                        got[run.first + r].append(w)
                    else:
                        assert got[run.first + r][k - run.old] == w
            assert got == want
            assert all(len(h) == 1 for h in by_hash.values()) and len(set().union(*by_hash.values())) == len(by_hash)


# -- 11: LM scoring --------------------------------------------------------------

def lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text)) + [None]


def is_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def lm_base(rows):
    """{doc_id: (held out, tokens, known, N, base)} by the plain formula."""
    c = Counter(w for i, t, _ in rows if not is_out(i) for w in lm_tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t, _ in rows:
        ws = lm_tokens(t)
        out.append((i, is_out(i), len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)))
    return sorted(out, key=str)


def lm_rows(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_filter_never_reads_too_low():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    lv = bloom_lm.levels(rng.zipf(1.5, 20_000).clip(max=10**9))
    table = bloom_lm.build_filter(keys, lv)
    got = bloom_lm.read_levels(keys, table)
    assert (got >= lv).all() and (got > lv).mean() < 0.03
    absent = bloom_lm.read_levels(rng.integers(0, 1 << 63, 50_000).astype(np.uint64), table)
    assert (absent > 0).mean() < 0.03


def test_levels_bound_counts():
    counts = np.r_[np.arange(1, 2_000), 10 ** np.arange(4, 16)]
    lv = bloom_lm.levels(counts)
    assert len(bloom_lm.STARTS) < bloom_lm.START_CLASS and bloom_lm.levels([0])[0] == 0
    assert (bloom_lm.STARTS[lv - 1] <= counts).all() and (np.diff(lv.astype(int)) >= 0).all()
    assert (np.abs(bloom_lm.MEANS[lv] - counts) <= 0.15 * counts).all()


def test_lm_base_matches_the_formula_and_score_follows_exact_counts(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in documents(spark).collect()]
    rows += [(None, "null id", "en"), (7, None, "en"), (7, "", None), (rows[0][0], rows[0][1], "en"),
             (9_001, " \t\x0b\x0c\r\n", "en"), (9_002, "É Straße x ŠŠ", "de"), (9_003, "w" * 70_000 + " " + "Long text. " * 30_000, "en")]
    df = frame(spark, rows)
    model = bloom_lm.train(df, segment_bytes=100_000, chunk_tokens=3_000)
    assert model.count > 1
    here = bloom_lm.score(df, model, chunk_tokens=3_000)
    assert lm_rows(here) == lm_base(rows)
    away = bloom_lm.score(df, model, broadcast_bytes=0, chunk_tokens=2_000, salts=3)

    def scores(x):
        return sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in x.collect())

    assert scores(here) == scores(away) and lm_rows(away) == lm_base(rows)

    # The same model with a dictionary instead of a filter: false positives make it differ a little.
    one, two = Counter(), Counter()
    for i, t, _ in rows:
        if not is_out(i):
            ws = lm_tokens(t)
            one.update(ws)
            two.update(zip(["start"] + ws, ws))
    n, v = sum(one.values()), len(one)
    mean = lambda c: float(bloom_lm.MEANS[bloom_lm.levels([c])[0]])
    want = {}
    for i, t, _ in rows:
        ws, total = lm_tokens(t), 0.0
        for h, w in zip(["start"] + ws, ws):
            q = 255 if h == "start" else int(bloom_lm.levels([one[h]])[0])
            x, of = model.weights[q], model.context_counts[q]
            total += math.log10(x * min(1.0, mean(two[h, w]) / of) + (1 - x) * (mean(one[w]) + 0.5) / (n + 0.5 * (v + 1)))
        want[str(i), len(ws)] = total
    for i, size, got in scores(here):
        assert abs(got - want[i, size]) <= 0.03 * abs(want[i, size]) + 0.05


def test_lm_knows_every_context_by_its_own_count(spark):
    """470,000 different words of counts 1, 2 and 3: each count is a class of contexts of its own."""
    words = [f"a{i}" for i in range(100_000)] + 2 * [f"b{i}" for i in range(100_000)] + 3 * [f"c{i}" for i in range(270_000)]
    random.Random(4).shuffle(words)
    kept = [i for i in range(1_000) if not is_out(i)][:100]
    size = len(words) // len(kept)
    rows = [(i, " ".join(words[k * size:(k + 1) * size]), "en") for k, i in enumerate(kept)]
    model = bloom_lm.train(frame(spark, rows), segment_bytes=2_000_000)
    assert model.different == 470_001 and model.count > 1
    assert (model.weights[[1, 2, 3]] > 0).all() and model.weights[0] == 0
    assert list(model.context_counts[1:4]) == [1.0, 2.0, 3.0]


def test_lm_is_the_same_when_no_worker_holds_the_words(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in documents(spark).limit(200).collect()]
    rows += [(None, "null id", "en"), (7, None, "en"), (7, "", None), (9_003, "Long text. " * 20_000, "en")]
    df = frame(spark, rows)
    here = bloom_lm.train(df, segment_bytes=50_000, chunk_tokens=3_000)
    away = bloom_lm.train(df, segment_bytes=50_000, chunk_tokens=2_000, broadcast_bytes=0, salts=3)
    assert here.count > 2 and (here.weights == away.weights).all() and here.size() == away.size()

    def scores(model, **how):
        return sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
                      for r in bloom_lm.score(df, model, chunk_tokens=2_500, **how).collect())

    words_only = bloom_lm.WORD_BYTES * here.different
    assert words_only < here.size()
    assert scores(here) == scores(away) == scores(away, broadcast_bytes=0, salts=3) == scores(here, broadcast_bytes=words_only)


def test_lm_beats_its_base_on_held_out_order(spark):
    rng = random.Random(8)
    follow = {w: [f"w{rng.randrange(200)}" for _ in range(3)] for w in (f"w{i}" for i in range(200))}
    rows = []
    for i in range(300):
        ws = ["w0"]
        while len(ws) < 120:
            ws.append(rng.choice(follow[ws[-1]]))
        rows.append((i, " ".join(ws), "en"))
    got = bloom_lm.score_documents(frame(spark, rows)).where("held_out").collect()
    assert got and sum(r.score for r in got) > 0.5 * sum(r.base_score for r in got)


def test_lm_empty_and_untrained(spark):
    assert bloom_lm.score_documents(frame(spark, [])).count() == 0
    out = [i for i in range(100) if is_out(i)][:2]
    got = bloom_lm.score_documents(frame(spark, [(out[0], "a b", "en"), (out[1], None, None)])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 0, 0), (3, 0, 0)]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)


# -- 12: ranked lexical search ------------------------------------------------------

def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def search_by_hand(docs, items, top):
    bags = [(i, search_terms(t)) for i, t, _ in docs]
    bags = [(i, Counter(ws), len(ws)) for i, ws in bags if ws]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, bag, size in bags:
            m = 100 - 50 + (50 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                    for t in set(search_terms(text)) if t in bag)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("top, block, at_once", [(50, 200_000, 4_000_000), (3, 100, 50)])
def test_search_matches_brute_force(spark, monkeypatch, top, block, at_once):
    monkeypatch.setattr(lexical_search, "PAIRS", at_once)
    rng = random.Random(top)
    words = ["alpha", "Beta", "gamma9", "été", "ß", "delta", "x1", "omega", "the", "of"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30))), "en") for i in range(200)]
    docs += [(300 + i, "Alpha, beta; the the", "en") for i in range(80)] + [(400, None, "en"), (401, "", "en"), (402, " .!? ", "en"),
             (None, "alpha été", "en"), (5, docs[5][1], "en"), (403, "the " * 50_000 + "x1", "en")]
    items = [(1, "ALPHA beta alpha"), (2, "été ß"), (2, "été ß"), (3, None), (4, "nothing here"), (5, "the of x1 omega"), (None, "delta")]
    found = spark.createDataFrame([(i, t, 0, "q") for i, t in items], "item_id long, text string, rank int, terms string")
    got = lexical_search.search(frame(spark, docs), found, top=top, terms_per_block=block).collect()
    assert sorted(map(tuple, got), key=str) == search_by_hand(docs, [x for x in items if x[1]], top)


def test_search_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, [(1, "a", "en")])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(some, items.where("false")).count() == 0
    assert lexical_search.search(some, items).count() == 1  # in every document: the weight is floor(1000 * ln(4/3))


# -- 13: collocations -----------------------------------------------------------------

def phrases_by_hand(rows, threshold, top):
    f, n = Counter(), Counter()
    for _, t, g in rows:
        g = "und" if g is None else g
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[g] += len(ws)
            f.update((g, *ws[i:i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
    out = {}
    often = [p for p, a in f.items() if len(p) > 2 and a >= threshold]
    inner = Counter()
    for p in often:
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                inner[p[0], *p[i:i + k]] = max(inner[p[0], *p[i:i + k]], f[p])
    for p in often:
        a, g = f[p], p[0]
        if inner[p] >= a:
            continue
        score, k = min((1000 * a * n[g] // (f[p[:k + 1]] * f[g, *p[k + 1:]]), k) for k in range(1, len(p) - 1))
        phrase = " ".join(p[1:])
        out.setdefault(g, []).append((-score, -a, phrase.encode(), phrase, a, f[p[:k + 1]], f[g, *p[k + 1:]], n[g], score))
    return sorted((g, r + 1, *x[3:]) for g, xs in out.items() for r, x in enumerate(sorted(xs)[:top]))


def phrase_rows(seed):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "é", "a", "b", "rare"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40))) + rng.choice([".", "", "!\n"]) + " New York city hall, the end of the day", rng.choice(["en", "de", None]))
            for i in range(300)]
    rows += [(1, None, "en"), (2, "", "fr"), (3, "the end of the day. " * 400, "en"), rows[0], (None, "x\ty z" * 90, "en"),
             (5, "ha " * 3_000, "en"), (6, "\t \x0b,,.", "en")]
    return rows


@pytest.mark.parametrize("threshold, top, counters, run", [(20, 2_000, 50_000, 4 << 20), (9, 15, 1, 64), (100, 2_000, 2, 1_000)])
def test_phrases_match_brute_force(spark, threshold, top, counters, run):
    rows = phrase_rows(threshold)
    got = collocations.collocations(frame(spark, rows), threshold=threshold, top=top, counters=counters, run_bytes=run)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, threshold, top)


def test_phrases_of_full_maps_and_restarted_summaries(spark, monkeypatch):
    """A map of few bits marks nearly all, and tasks send summaries all the time: the same phrases."""
    monkeypatch.setattr(collocations, "MAP_BITS", 64)
    rows = phrase_rows(4)
    got = collocations.collocations(frame(spark, rows), threshold=30, counters=40, run_bytes=200)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 30, 2_000)


def test_phrases_empty(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, [(1, "too rare", "en")])).count() == 0


def test_merged_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(11)
    for seed in range(20):
        stream = rng.zipf(1.2, 20_000).clip(max=3_000).astype(np.uint64)
        threshold = int(rng.integers(20, 200))
        room = len(stream) // threshold + 1
        parts = [collocations.Summary(room) for _ in range(7)]
        for i, block in enumerate(np.array_split(stream, 50)):
            parts[i % 7].merge(*np.unique(block, return_counts=True))
        whole = collocations.Summary(room)
        for p in parts:
            whole.merge(p.hashes, p.counts, p.error)
        true = dict(zip(*np.unique(stream, return_counts=True)))
        kept = dict(zip(whole.hashes, whole.counts))
        assert len(kept) <= room and whole.error < threshold
        assert all(k in kept and kept[k] + whole.error >= n for k, n in true.items() if n >= threshold)
        assert all(n <= true[k] for k, n in kept.items())


# -- SQL ----------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_of_registered_queries(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    assert df.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want.fetchall(), key=str)


# -- 8: ids of any text and any tokenizer ---------------------------------------------

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("run_bytes", [7, 4 << 20])
def test_ids_equal_those_of_whole_texts(name, run_bytes):
    """Letters whose lower case is two characters, combining marks, added spaces, end-of-word marks."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(name)
    rng = random.Random(1)
    parts = ["a", "B", "İ", "ß", "é", "#", ":", ".", "́", "ſ", "K", "1", "²", "ǅ", "Σ", "ﬁ",
             " ", " ", "​", "　", "日", "-", "'", "ΐ", "\n", "%", "̇", "i", "[UNK]", "<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 12))) for _ in range(8_000)] + ["", "word " * 3_000, "x" * 5_000]
    encoder = token_files.Encoder(path, "<u4", 1)
    encoder.cutter.most = run_bytes
    flat, sizes, open_row = [], [], False
    for ids, counts, more in encoder.encode(pa.array([t.encode() for t in texts], pa.binary())):
        flat += ids.tolist()
        if open_row:
            sizes[-1] += int(counts[0])
            counts = counts[1:]
        sizes += counts.tolist()
        open_row = more
    want = [e.ids + [1] for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    assert sizes == [len(w) for w in want] and flat == [i for w in want for i in w]


# -- 5: hard texts ---------------------------------------------------------------------

def test_addresses_in_hard_texts(spark):
    """Long runs of labels, of %-codes and of at signs are read once and end no task."""
    from pyspark.sql import functions as F

    n = 200_000
    texts = ["x@" + "a." * 2_500 + "com", "x@" + "a." * n + "com", "%20ab" * n, "a@" * n, "ab.cd-" * n, "a.b@c.example " * 1_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string").repartition(2)
    got = df.select("doc_id", F.size(F.regexp_extract_all("t", F.lit(pseudonyms.PATTERN), F.lit(0))).alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1_000}
