"""Id stores, impact indexes and band joins against plain Python and the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusflow.llm import band_join, id_store, impact_index, queries, tokens
from corpusflow.llm.scratch import Scratch

BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum, dolor sit amet. " * 9000
ODD = [None, "", " \n\t", "a", "it's  we'll\tdon't 123abc 4,5", "Straße naïve café, 日本語。 😀 é", "x" * 5000, LONG, "a b \x0b c\x1cd\x85 e", "<|endoftext|> a<|endoftext|>b", "?!.,;: a, b. c,d (e). 'f' g's,", "　  x  ", "end  \n\n "]


def pieces(rng, n):
    parts = [" ", "  ", "\n", "\t", "a", "The", "é", "ß", "日", "😀", "'s", "'", ",", ".", "!?", ")", "\"", "12", "٣", " ", " ", "\x0b", "\x1d", "<|endoftext|>", "-", "_", "ǅ", "́"]
    return "".join(rng.choices(parts, k=n))


def test_unit_ids_are_the_librarys():
    rng, t = random.Random(1), Tokenizer.from_file(BYTES)
    texts = [x or "" for x in ODD] + [pieces(rng, rng.randint(1, 40)) for _ in range(6000)]
    got = tokens.ByteUnitIds(BYTES).encode([x.encode() for x in texts])
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 - 5, x, i) for i, x in enumerate([*ODD, *ODD])] + [(4, "again", 0), (4, "again", 1), (None, "no id", 2), (None, "no id", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(5)


def test_id_store(spark, docs):
    t = Tokenizer.from_file(BYTES)
    ids = lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]
    scratch = Scratch(spark)
    store = id_store.IdStore(spark, f"{scratch.root}/store")
    store.write(docs, BYTES)
    got = id_store.with_starts(store.documents(), scratch).collect()
    rows = docs.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0, len(ids(r.text)), zlib.crc32(np.array(ids(r.text), "<u4").tobytes())) for r in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda k: (k is not None, k or 0))
    for key in {r.doc_id for r in rows if r.doc_id is not None}:
        assert sorted(store.ids(key)) == sorted(ids(r.text) for r in rows if r.doc_id == key)
    assert store.ids(10**9) == [] and store.ids(-(10**9)) == []


def test_id_store_of_another_dictionary_is_refused(spark):
    shard = b"\n".join([*id_store.shard(iter([([1, None], [b"one two", None])]), BYTES, b""), b""])
    n, at, size = id_store.read_trailer(shard[-id_store.TRAILER - 1 : -1], b"")
    keys, offset, sizes, count = id_store.read_index(shard[at : at + size], id_store.Codec(b""), n)
    assert keys == [1, None] and count.tolist() == [3, 1]
    assert id_store.Codec(b"").unpack(shard[offset[1] : offset[1] + sizes[1]]) == (2).to_bytes(4, "little")
    with pytest.raises(ValueError, match="another dictionary"):
        id_store.read_trailer(shard[-id_store.TRAILER - 1 : -1], hashlib.sha256(b"x").digest())


def test_dictionary_makes_short_documents_smaller(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=30))) for i in range(600)], "doc_id long, text string")
    known = id_store.train_dictionary(docs, BYTES)
    assert known and known == id_store.train_dictionary(docs.repartition(7), BYTES)
    raw = id_store.serialized(BYTES, [r.text.encode() for r in docs.limit(100).collect()])
    size = lambda d: sum(len(id_store.Codec(d).pack(x)) for x in raw)
    assert size(known) < 0.8 * size(b"")


def test_slices_add_up():
    rng = np.random.default_rng(3)
    for docs in (1, 64, 200):
        words, total, parts = -(-docs // 64), np.zeros(docs, np.int64), []
        for _ in range(12):
            at = np.sort(rng.choice(docs, rng.integers(1, docs + 1), replace=False))
            value, shift = rng.integers(1, 1 << int(rng.integers(1, 30)), len(at)), int(rng.integers(0, 4))
            bits, out = impact_index.sliced(at, value, docs)
            assert out.shape == (bits, words)
            parts.append((out, shift))
            np.add.at(total, at, value << shift)
        summed = impact_index.added(parts, words)
        for k in (1, 5, 20, docs):
            at, score = impact_index.best(summed, k)
            order = np.lexsort((np.arange(docs), -total))[:k]
            want = np.sort(order[total[order] > 0])
            assert at.tolist() == want.tolist() and score.tolist() == total[want].tolist()


def plain_ranking(docs, items, top):
    terms = lambda x: impact_index.terms_of((x or "").encode())
    held = [(k, w) for k, x in docs if (w := terms(x))]
    n, length = len(held), sum(len(w) for _, w in held)
    df: dict = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in {(i, x) for i, x in items if x is not None}:
        rows = []
        for k, w in held:
            m = 75 + (25 * len(w) * n) // length
            s = sum(impact_index.weight(n, df[t]) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 12 * m)) for t in terms(text) if t in df)
            if s > 0:
                rows.append((-s, k is not None, k or 0))
        out += [(item, r + 1, k if known else None, -s) for r, (s, known, k) in enumerate(sorted(rows)[:top])]
    return out


def test_impact_search(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [w + rng.choice(["", "é", "1"]) for w in "ab bc cd de ef fg gh hi ij".split()]
    rows = [(rng.choice([None, rng.randint(0, 90)]) if i % 20 == 0 else i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 30]))), "x") for i in range(300)]
    rows += [(1000, None, "x"), (1001, "--- ...", "x"), (1002, "AB ab, Ab\x00aB", "x"), (1002, "AB ab, Ab\x00aB", "x"), (1003, LONG, "x")]
    items = [(1, "ab bc ab"), (1, "ab bc ab"), (1, "de"), (2, None), (3, ""), (4, "lorem zz"), (None, "hi1 hi hié ij"), (5, "unheard")]
    d = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string")
    key = lambda r: (r[0] is not None, r[0] or 0, -r[3], r[1])
    for docs_a_block, batch in ((4096, 4096), (16, 2)):
        monkeypatch.setattr(impact_index, "BLOCK_DOCS", docs_a_block)
        monkeypatch.setattr(impact_index, "BATCH_ITEMS", batch)
        got = [tuple(r) for r in impact_index.ranked(d, i).collect()]
        assert sorted(got, key=key) == sorted(plain_ranking([r[:2] for r in rows], items, 20), key=key)
    assert impact_index.ranked(d.limit(0), i).count() == 0 and impact_index.ranked(d, i.limit(0)).count() == 0


def plain_band(lines, items, top=5):
    cents = lambda x: None if x is None or not abs(x) <= 1e13 else int(np.floor(100 * x + 0.5))
    sold = []
    for s, n, i, q, a in lines:
        if None in (s, i, q) or not q or cents(a) is None:
            continue
        u = (2 * cents(a) + q) // (2 * q)
        sold.append((u, s, n, i, zlib.crc32(f"{s},{'' if n is None else n},{i}".encode())))
    out = []
    for item, p in {(i, cents(x)) for i, x in items}:
        near = [] if item is None or p is None else sorted(((abs(u - p), u, s, n is not None, n or 0, i, c) for u, s, n, i, c in sold if i != item and abs(u - p) <= max(10, 2 * p // 1000)))
        told = (len(near), sum(x[0] for x in near), sum(x[6] for x in near), p)
        out += [(item, r + 1, g, u, s, n if has else None, i, *told) for r, (g, u, s, has, n, i, _) in enumerate(near[:top])] or [(item, 0, None, None, None, None, None, *told)]
    return out


def test_band_join(spark):
    rng = random.Random(5)
    price = lambda: rng.choice([0.01, 1.0, 1.05, 1.1, 5.0, 5.02, 400.0, 400.5, -3.0, rng.uniform(0.5, 9), rng.uniform(300, 420)])
    lines = []
    for k in range(1500):
        q = rng.choice([1, 2, 3, 7, -2, 0, None] if k % 30 == 0 else [1, 2, 3, 7])
        lines.append((rng.choice([k, 7, 7, None]), rng.choice([1, 2, None]), rng.choice([7, 7, 7, rng.randint(0, 40), None]), q, None if k % 50 == 1 else float("nan") if k % 50 == 2 else round(price() * (q or 1), 2)))
    lines += [(7, 1, 7, 1, 5.0)] * 200 + [(7, 1, 8, 1, 5.0)] * 30 + [(1, 1, 9, 1, 1e20)]
    items = [(i, price()) for i in range(60)] + [(7, 5.0), (7, 5.0), (7, 5.01), (8, None), (None, 5.0), (None, None), (61, float("nan")), (62, 9e6)] + [(100 + i, 5.0) for i in range(300)]
    a = spark.createDataFrame(lines, "sale_id long, line_no int, item_id long, quantity int, amount double").withColumn("u", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    b = spark.createDataFrame(items, "item_id long, price double")
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    want = sorted(plain_band(lines, items), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert sorted((tuple(r) for r in band_join.band_join(a, b).collect()), key=key) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((tuple(r) for r in band_join.band_join(a, b).collect()), key=key) == want
    assert band_join.band_join(a, b.limit(0)).count() == 0
    assert {r.rank for r in band_join.band_join(a.limit(0), b).collect()} == {0}


@pytest.mark.parametrize("name", ["op11_id_store", "op12_impact_search", "op13_band_join"])
def test_registered(name):
    assert name in queries.QUERIES and (name in queries.ORACLES) == (name != "op11_id_store")


def test_blocks_of_pairs_are_bounded(spark, monkeypatch):
    """No block has more shingles than the bound, one pair and one document; every pair lies in one block."""
    from corpusflow.llm import jaccard_join

    rng = random.Random(7)
    size = {i: rng.choice([1, 20, 300, 3000]) for i in range(400)}
    pairs = {tuple(sorted(rng.sample(range(400), 2))) for _ in range(1500)} | {(i, 399) for i in range(399)}
    rare = spark.createDataFrame([(a, b, size[a], size[b]) for a, b in pairs], "a long, b long, na long, nb long")
    for bound in (2000, 20_000):
        monkeypatch.setattr(jaccard_join, "PAIR_BLOCK", bound)
        blocks: dict = {}
        for r in jaccard_join._pair_blocks(rare).collect():
            blocks.setdefault(r.block, set()).add(r.id)
        weight = lambda ids: sum(size[i] + 256 for i in ids)
        assert max(map(weight, blocks.values())) <= bound + 3 * (3000 + 256)
        where: dict = {}
        for name, ids in blocks.items():
            for i in ids:
                where.setdefault(i, set()).add(name)
        assert all(where[a] & where[b] for a, b in pairs) and len(where[399]) > 10
