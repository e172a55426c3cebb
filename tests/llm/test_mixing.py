"""Mixing against a row-by-row model: repeated rows, null ids, several epochs."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakestar.llm import mixing


def model(spark, rows, schema, fraction, epochs, seed):
    """Taken copies of each row and epoch, by the seeded order of each leaf."""
    df = spark.createDataFrame(rows, schema)
    key = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = df.withColumn("key", key).collect()

    def place(r, e):
        said = ":".join(str(x) for x in (seed, e, r.doc_id, r.key) if x is not None)
        return int(hashlib.md5(said.encode()).hexdigest()[:8], 16), r.doc_id is not None, r.doc_id or 0, r.key

    have = Counter()
    for r in rows:
        have[("v" + r[2],)] += r[3] or 0
    budgets = mixing.leaf_budgets({k: float(v) for k, v in have.items()}, fraction * sum(have.values()) * epochs, {}, epochs)
    out = Counter()
    for leaf, budget in budgets.items():
        full = min(epochs, int(budget // have[leaf])) if have[leaf] else 0
        mine = [r for r in rows if "v" + r[2] == leaf[0]]
        for e in range(full):
            out.update((r[0], r[1], e) for r in mine)
        rest = budget - full * have[leaf] if full < epochs else 0
        took = 0
        if rest > 0:
            for r in sorted((r for r in keyed if "v" + r.source == leaf[0]), key=lambda r: place(r, full)):
                if took >= rest:
                    break
                out[r.doc_id, r.text, full] += 1
                took += r.tokens or 0
    return out


@pytest.mark.parametrize("fraction, epochs, copies", [(0.3, 1, 0), (0.4, 1, 500), (0.6, 2, 300), (0.05, 3, 900)])
def test_mixing_takes_what_the_model_takes(spark, fraction, epochs, copies):
    rng = random.Random(copies)
    schema = "doc_id long, text string, source string, tokens long"
    rows = [(i, f"t{i}", rng.choice("abc"), rng.randrange(1, 30)) for i in range(400)]
    rows += [(7_000, "same", "a", 24)] * copies + [(None, "no id", "b", 5)] * 4 + [(8_000, "no count", "c", None)] * 3
    got = mixing.mix(spark.createDataFrame(rows, schema), {"source": F.col("source")}, tokens=F.col("tokens"),
                     fraction=fraction, epochs=epochs, seed=5, rows_per_bucket=50).collect()
    assert Counter((r.doc_id, r.text, r._epoch) for r in got) == model(spark, rows, schema, fraction, epochs, 5)
    for s in "abc":
        mine = [r for r in got if r.source == s]
        assert sum(r._tokens for r in mine) < mine[0]._budget + 30
