"""Operators 3 and 6: packing plans, tokens and files."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedsync.llm import packing, token_files
from feedsync.llm.common import ship_package, slices
from feedsync.llm.tokens import byte_tokenizer, word_tokenizer

DOCS = "doc_id long, text string, lang string, sequence_id string"


def fewest(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity:
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    items = sorted(items, reverse=True)
    if items:
        go(0, [])
    return best[0] if items else 0


def laid_out(runs):
    """sequence -> [(offset, length)], and the ranks used of each length."""
    places, ranks = {}, {}
    for length, rank, n, first, per, offset in runs.tolist():
        ranks.setdefault(length, []).extend(range(rank, rank + n))
        for t in range(n):
            places.setdefault(first + t // per, []).append((offset + t % per * length, length))
    return places, ranks


def assert_gapless(places, capacity):
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=9))))
def test_reduction_keeps_the_optimum(case):
    capacity, items = case
    counts = np.bincount(items, minlength=capacity + 1) if items else np.zeros(capacity + 1, np.int64)
    runs = packing._Runs(counts)
    packing.reduce_dominated(runs, capacity)
    rest = [n for n in range(capacity + 1) for _ in range(int(runs.left[n]))]
    assert runs.sequences + fewest(rest, capacity) == fewest(items, capacity)
    places, ranks = laid_out(packing.plan_runs(dict(enumerate(counts.tolist())), capacity))
    assert_gapless(places, capacity)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in enumerate(counts.tolist()) if c}


def test_large_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.geometric(1 / 700, 50_000), 4096)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    runs = packing.plan_runs(histogram)
    places, _ = laid_out(runs)
    assert_gapless(places, 4096)
    assert len(places) <= -(-int(lengths.sum()) // 4096) + 1
    assert len(runs) < 24 * 4096


def odd_texts():
    odd = [0x1C, 0x1F, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000, 0x300, 0x130, 0x3A3, 0x4E2D, 0x1F600, 0]
    texts = [f"a{chr(c)}b {chr(c)} C{chr(c)}'S {chr(c) * 3}\n\n x" for c in [*range(0x250), *odd]]
    return texts + ["", " ", "<|endoftext|> x<|startoftext|>y", "I'LL don't 'S  'd!!", "word., (x) a--b", "x" * 5000]


def test_word_ids_equal_the_tokenizers():
    t = word_tokenizer()
    for text in odd_texts():
        assert np.frombuffer(t.encode(text), "<u4").tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids


def test_byte_ids_equal_the_tokenizers():
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in odd_texts():
        ids = np.frombuffer(byte_tokenizer().encode(text), "<u4").tolist()
        assert ids == other.encode(text, add_special_tokens=False).ids


def test_byte_ids_decode_to_the_text():
    t = byte_tokenizer()
    for text in ["", " a  b\n", "\x00\x1c\x85 é \U0001f600", "<|endoftext|>"]:
        assert t.decode(np.frombuffer(t.encode(text), "<u4")) == text


def documents(spark):
    long = " ".join(f"w{i}" for i in range(9000))
    rows = [(1, "a b c", "en", "x"), (2, None, None, None), (3, "", "en", "x"), (4, long, "en", "x"), (None, "z", "", "")]
    rows += [(5, "same text", "en", "x")] * 3 + [(i, "hot copy", "en", "x") for i in range(100, 400)]
    return spark.createDataFrame(rows, DOCS)


def check_packed(rows, docs, encode, end):
    want = {}
    for i, text in docs:
        ids = np.append(np.frombuffer(encode(text or ""), "<u4"), np.uint32(end)).astype("<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            key = (i, piece, at, len(part), zlib.crc32(part.tobytes()))
            want[key] = want.get(key, 0) + 1
    got, places = {}, {}
    for r in rows:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    assert_gapless(places, 4096)
    return places


def test_pack_documents(spark):
    ship_package(spark)
    docs = documents(spark)
    rows = packing.pack_documents(docs).collect()
    places = check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], word_tokenizer().encode, 1)
    assert len(places) == -(-sum(r["length"] for r in rows) // 4096)
    assert packing.pack_documents(docs.limit(0)).count() == 0
    with_ids = packing.pack_documents(docs, with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in with_ids)


def test_token_files(spark, tmp_path):
    ship_package(spark)
    docs = documents(spark)
    out, manifest = token_files.write_token_files(docs, str(tmp_path / "ids"), shard_tokens=20_000)
    rows = token_files.read_token_files(manifest, out).collect()
    check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], byte_tokenizer().encode, token_files.END_ID)
    shard = next((tmp_path / "ids").glob("shard-*"))
    ids, cu, resets = (np.load(shard / f"{n}.npy") for n in ("ids", "cu_seqlens", "resets"))
    position = token_files.position_ids(resets, *ids.shape)
    assert cu[0] == 0 and cu[-1] == ids.size and (np.diff(cu) > 0).all()
    assert (position.ravel()[resets] == 0).all() and (position < 4096).all()
    out, manifest = token_files.write_token_files(docs.limit(0), str(tmp_path / "none"))
    assert token_files.read_token_files(manifest, out).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40))
def test_capacity_tree_is_best_fit(lengths):
    where, offset, n = token_files.best_fit_decreasing(np.array(lengths, np.int64), 40)
    free, want = [], []
    for i in np.argsort(-np.array(lengths, np.int64), kind="stable"):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else 40) - lengths[i])
        want.append(i)
    assert n == len(free)
    assert sorted(40 - np.bincount(where, lengths, minlength=n)) == sorted(free) if lengths else n == 0


def test_hot_length_is_shared_out(spark):
    items = spark.range(5000).select(F.col("id").alias("k"), F.lit(7).cast("long").alias("length"))
    rows = packing.pack(items, ["k"]).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 5000
    assert len({r["sequence_id"] for r in rows}) == -(-5000 // (4096 // 7))


def test_slices_cover_a_batch():
    values = ["a" * n for n in (0, 5, 3, 40, 1, 1, 1)] + [None, "bb"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(values)], names=["i", "t"])
    parts = list(slices(batch, "t", 6))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(9))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 6 for p in parts)
    assert list(slices(batch.slice(0, 0), "t")) == []
