"""The model of order 3 that is counted in compressed blocks, against that of any order, and what it leaves on disk."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.text import words
from corpusflow.operators import lm, trigrams
from corpusflow.session import folder


def lines_of(d):
    rows = [r.value.split("\t") for r in d.collect()]
    out = {r[1]: [float(x) for x in (r[0], *r[2:])] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("chars", [trigrams.CHARS, 300])
def test_lines_are_those_of_the_model_of_any_order(spark, monkeypatch, chars):
    monkeypatch.setattr(trigrams, "CHARS", chars)  # the smaller deals frequent words in parts
    monkeypatch.setattr(trigrams, "LOOKED_AT", 1)
    rng = random.Random(5)
    texts = [" ".join(f"W{int(rng.paretovariate(0.8))}" for _ in range(rng.randint(0, 60))) for _ in range(120)]
    every_after_every = [" ".join(rng.choices("abc", [9, 5, 3], k=40)) for _ in range(20)]
    odd = ["x y", None, "", " \t ", "x y z <s> q", "Ä ö\x0bß ß  x\r\ny\x1cz"] * 2
    for rows in (texts, every_after_every, odd, []):
        d = spark.createDataFrame([(x,) for x in rows], "text string")
        path = folder(spark)
        trigrams.write_arpa(d, "text", path)
        got, want = lines_of(spark.read.text(path)), lines_of(lm.arpa_lines(lm.kn_model(d, "text", 3)))
        assert got.keys() == want.keys()
        assert all(len(got[g]) == len(x) and np.allclose(got[g], x, rtol=0, atol=2e-7) for g, x in want.items())
    assert chars > 300 or trigrams.places_of(spark.createDataFrame([(x,) for x in texts], "text string"), "text").frequent["w1"] > 1


def test_blocks(spark):
    rng = np.random.default_rng(3)
    known = pa.array(sorted({f"{k:x}" * (k % 4 + 1) for k in range(500)} | {"äö"}))
    for top, n in ((1, 0), (5, 3), (500, 40), (500, 3000)):
        ids, numbers = [rng.integers(0, top + 1, n) for _ in range(2)], [np.sort(rng.integers(0, 1 << 40, n)), rng.integers(0, 300, n // 2)]
        held, columns = trigrams.unpacked(trigrams.packed(known, ids, numbers))
        word = lambda k, x: [None if i == 0 else k[int(i) - 1].as_py() for i in x]
        assert [word(held, x) for x in columns[:2]] == [word(known, x) for x in ids]
        assert all((x == y).all() for x, y in zip(columns[2:], numbers, strict=True))
    h = trigrams.hashes(known)
    assert (trigrams.hashes(known.slice(7, 90)) == h[7:97]).all() and len(set(h.tolist())) == len(known)
    text = "<s> a b\x0bc\x0cd\x1ce \t\nf\u0085g </s>"
    assert trigrams.split(pa.array([text]))[0].as_py() == spark.range(1).select(words(F.lit(text)).alias("w")).first().w


def test_query_leaves_its_lines_alone(spark, small_data):
    """Before, counts and levels of all orders stayed as tables, and shuffles beside them."""
    from corpusflow.plans.queries import QUERIES

    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    held = lambda: {p: p.stat().st_size for p in root.rglob("*") if p.is_file()}
    before = held()
    rows = QUERIES["kn_sentence_scores"](spark, small_data).collect()
    made = {p: n for p, n in held().items() if p not in before}
    assert len(rows) == spark.read.parquet(f"{small_data}/benchmark.parquet").count()
    assert sum(n for p, n in made.items() if p.suffix == ".parquet") < 0.5 * Path(f"{small_data}/documents.parquet").stat().st_size
