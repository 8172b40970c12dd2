"""Operators 2, 4, 7 and 8."""

import gzip
import hashlib
import io
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from feedsync.llm import chat, pieces, toxicity, warc
from feedsync.llm.common import ship_package
from feedsync.llm.sharded_files import Attempt, manifest_batch

MARK = chr(0x2581)


# ---------------------------------------------------------------- operator 2


def odd_texts():
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABC0123456789.,!?-'\"() \n  éüñ" + chr(0x4E2D) + chr(0x1F600)
    texts = ["", " ", "   ", "  Hello  world \n\tx ", f"{MARK}x {MARK}{MARK}y", "a" * 300, "e" + chr(0x301)]
    return texts + ["".join(rng.choices(letters, k=80)) for _ in range(400)]


def test_pieces_equal_sentencepiece():
    model = pieces.PieceModel()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    for text, ids in zip(odd_texts(), model.encode(odd_texts()), strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == library.encode(text)
        assert model.decode(ids) == library.decode(ids)


def test_unigram_search_is_optimal():
    """Against every segmentation, with the pieces' scores summed."""
    model = pieces.PieceModel(unigram=True)
    words = sorted({MARK + "".join(random.Random(i).choices("theinabo", k=i % 8)) for i in range(60)} | {MARK + "qé"})

    def best(word):
        if not word:
            return 0.0
        out = -np.inf
        for n in range(1, len(word) + 1):
            known = model.score.get(word[:n])
            if known or n == 1:
                out = max(out, (known[0] if known else model.floor) + best(word[n:]))
        return out

    for word, found in model.segment(words):
        assert "".join(found) == word
        total = sum(model.score[p][0] if p in model.score else model.floor for p in found)
        assert total == pytest.approx(best(word))


def test_prefixes_are_searched_once():
    model, steps = pieces.PieceModel(), []
    words = sorted([MARK + "inter", MARK + "internal", MARK + "international"])
    assert [w for w, _ in model.segment(words, (), lambda path, piece: steps.append(piece))] == words
    assert len(steps) == len({w[:n] for w in words for n in range(1, len(w) + 1)})


def test_long_text_without_spaces_takes_linear_memory():
    rng = random.Random(8)
    kinds = ["abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/", "theinabo\n", chr(0x4E2D) + chr(0x6587) + chr(0x1F600) + "ab"]
    texts = ["".join(rng.choices(letters, k=n)) for letters, n in zip(kinds, (300_000, 20_000, 20_000), strict=True)]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    model = pieces.PieceModel()
    model.encode(["warm up"])
    tracemalloc.start()
    try:
        found = model.encode(texts[:1]) + model.encode(texts[1:])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [library.encode(t) for t in texts]
    assert peak < 200 << 20
    assert not any(len(w) > pieces.LONG for w in model.words)


def test_piece_columns(spark):
    ship_package(spark)
    rows = [(1, "a b", "k"), (2, None, "k"), (3, "", None), (1, "a b", "k"), (4, "x y " * 30_000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded_x string")
    done = pieces.decode_pieces(pieces.encode_pieces(df)).collect()
    assert [(r["doc_id"], r["decoded"], r["decoded_x"]) for r in done] == [(i, t, k) for i, t, k in rows]
    assert pieces.piece_digests(df).count() == 5
    assert pieces.piece_digests(df.limit(0)).count() == 0


# ---------------------------------------------------------------- operator 4


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")


def test_warc_shards_with_an_outlier_and_null_ids(spark, tmp_path):
    ship_package(spark)
    rows = [(i, f"u{i}", f"{i} " * 300) for i in range(400)] + [(1 << 62, "far", "x"), (-(1 << 62), "low", "y")]
    rows += [(None, f"n{i}", f"{i} " * 300) for i in range(400)]
    out, manifest = warc.write_warc(pages(spark, rows), str(tmp_path / "a"), shard_bytes=60_000)
    shards = [r["records"] for r in manifest.collect()]
    assert sum(shards) == len(rows) and max(shards) < 100
    got = sorted((str(r["page_id"]), r["payload_bytes"]) for r in warc.read_warc(manifest, out).collect())
    assert got == sorted((str(i), len(h)) for i, _, h in rows)


def test_warc_round_trip(spark, tmp_path):
    ship_package(spark)
    big = "<p>\r\n\r\nWARC/1.1 é</p>" * 40
    rows = [(i, f"http://h/{i} x\r\ny", f"<html>{i}</html>" * (i % 30)) for i in range(200)]
    rows += [(500, None, None), (501, "u", ""), (600, "u", big), (602, "u", big), (601, "v", big), (None, "n", big)]
    rows += [(700, "r", big + "!"), (700, "r", big + "!"), (703, "u", "short"), (704, "u", "short"), (None, "n", "q")]
    df = pages(spark, rows)
    out, manifest = warc.write_warc(df, str(tmp_path / "a"), shard_bytes=40_000, roll_bytes=2_000)
    got = warc.read_warc(manifest, out).collect()
    keep = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            keep[h] = min(keep.get(h, i), i)
    want, seen = [], set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        payload = (h or "").encode()
        refers = keep.get(h) if i is not None and len(payload) >= 100 else None
        if refers == i and (i, h) not in seen:
            refers = None
        seen.add((i, h))
        want.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    files = [r["name"] for r in manifest.collect()]
    assert len(files) > 5 and len({f.split("/")[0] for f in files}) > 1
    assert any(f.endswith("part-00001.warc.gz") for f in files)
    for r in manifest.collect():
        data = (tmp_path / "a" / r["name"]).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert sum(1 for _ in warc.records(io.BytesIO(data), 100)) == r["records"] + 1
    # the same pages in another order and partitioning give the same archives
    out2, again = warc.write_warc(df.repartition(7, "digest"), str(tmp_path / "b"), shard_bytes=40_000, roll_bytes=2_000)
    columns = ["name", "bytes", "records", "sha256"]
    assert sorted(again.select(*columns).collect()) == sorted(manifest.select(*columns).collect())


def test_warc_empty_and_damaged(spark, tmp_path):
    ship_package(spark)
    out, manifest = warc.write_warc(pages(spark, []), str(tmp_path / "a"))
    assert warc.read_warc(manifest, out).count() == 0
    out, manifest = warc.write_warc(pages(spark, [(1, "u", "x" * 500)]), str(tmp_path / "b"))
    name = manifest.first()["name"]
    path = tmp_path / "b" / name
    parts = [(f, b) for f, b in warc.records(io.BytesIO(path.read_bytes()))]
    broken = gzip.compress(warc._record([(k, v) for k, v in parts[1][0].items() if k != "Content-Length"], parts[1][1] + b"!"))
    path.write_bytes(broken)
    with pytest.raises(Exception, match="digest"):
        warc.read_warc(manifest, out).count()


def test_files_of_lost_attempts_are_not_committed(spark, tmp_path):
    ship_package(spark)
    out = str(tmp_path / "c")

    def lost():
        a = Attempt(out)
        path, f = a.open("shard-0-part-0")
        f.write(b"half")
        f.close()
        return path

    lost()
    out, manifest = warc.write_warc(pages(spark, [(1, "u", "x")]), out)
    names = {str(p.relative_to(out)) for p in (tmp_path / "c").rglob("*.warc.gz") if "_temporary" not in str(p)}
    assert names == {r["name"] for r in manifest.collect()}
    assert manifest_batch([]).num_rows == 0


# ---------------------------------------------------------------- operator 7


def test_escapes_are_reversible():
    rng = random.Random(8)
    parts = [*chat.CONTROLS, "\\", "<", "[", "\\x3c", "\\x5b", "x3c", "a", "/s>", "\\\\"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in chat.CONTROLS)


def test_chat_round_trip(spark):
    ship_package(spark)
    says = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", says), (-7, 1, "assistant", says), (1, 2, "assistant", "b<s>"), (1, 1, "user", None)]
    rows += [(1, 0, "system", "\\x3c é"), (2, 0, None, "no role"), (2, 1, "tool[END]", "t[TEXT]"), (3, 0, "assistant", "")]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "a")]
    rows += [(9, i, ["user", "assistant"][i % 2], f"long {i} " * (i % 40)) for i in range(3000)]
    schema = "conv_id long, turn long, role string, text string, start string, ids string"
    df = spark.createDataFrame([(*r, "s", "i") for r in rows], schema)
    formatted = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.conversation_digests(formatted).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: r[1])
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        g = got[conv]
        assert g["n_turns"] == len(turns)
        assert g["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (g["loss_chars"], g["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    one = sorted((r for r in formatted.filter("conv_id = -7").collect()), key=lambda r: r["turn_no"])
    ids = [np.frombuffer(r["ids"], "<u4") for r in one]
    assert ids[0][0] == chat.BOS and ids[0][1] == chat.INST and ids[0][-1] == chat.END_INST and ids[1][-1] == chat.EOS
    assert [r["start"] for r in one] == [0, len(ids[0])]
    assert sum(int((i >= chat.FIRST_RESERVED).sum()) for i in ids) == 4
    mask = np.frombuffer(one[1]["loss_mask"], np.uint8)
    assert mask[:-1].all() and not mask[-1] and not np.frombuffer(one[0]["loss_mask"], np.uint8).any()
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).count() == 0


def test_repeated_turns_stay(spark):
    ship_package(spark)
    df = spark.createDataFrame([(1, 0, "user", "a")] * 3, "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.format_conversations(df)).first()["n_turns"] == 3


# ---------------------------------------------------------------- operator 8


def test_kernel_matches_the_definition():
    """Folded scores equal the kernel expansion computed subsequence by subsequence."""
    from itertools import combinations

    def vector(word):
        s, out = [0, *[ord(c) - 96 for c in word]], {}
        for at in combinations(range(len(s)), 4):
            if at[3] - at[0] <= toxicity.SPAN:
                key = tuple(s[i] for i in at)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (at[3] - at[0] - 3)
        n = sum(
            max(len(word) + 1 - c, 0) * toxicity.DECAY ** (2 * (c - 3)) for _, _, c in toxicity._OFFSETS
        )
        return {k: v / np.sqrt(n) for k, v in out.items()}

    words = ["idiot", "banana", "xidiotx", "idxiot"]
    model = toxicity.Landmarks([toxicity.symbols(w).tobytes() for w in ["idiot", "banana"]])
    beta = np.array([1.0, -0.5])
    weights = model.folded(beta)
    alpha = model.whiten @ beta
    for w in words:
        got = toxicity.word_scores(toxicity.symbols(w), weights)[0]
        v = vector(w)
        want = sum(
            a * sum(v.get(k, 0) * x for k, x in vector(lm).items())
            for a, lm in zip(alpha, ["idiot", "banana"], strict=True)
        )
        assert got == pytest.approx(want, rel=1e-4, abs=1e-5)
        assert model.features([toxicity.symbols(w).tobytes()])[0] @ beta == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_symbols():
    assert toxicity.symbols("Ab, cD").tolist() == [0, 1, 2, 0, 3, 4]
    assert toxicity.symbols("i.d-i").tolist() == toxicity.symbols("i d i").tolist() == [0, 9, 4, 9]
    assert len(toxicity.symbols("")) == len(toxicity.symbols(" !! ")) == 0
    assert toxicity.symbols("a b x").tolist() == [0, 1, 2, 24]


def test_fillers_and_digits_beside_letters():
    want = toxicity.symbols("zoquork").tolist()
    for w in ("z1o1q1u1o1r1k", "z1o2q3u4o5r6k", "zxoxqxuxoxrxk", "z0qu0rk", "Z.O.Q.U.O.R.K", "z o q u o r k"):
        assert toxicity.symbols(w).tolist() == want, w
    assert toxicity.symbols("1d10t").tolist() == toxicity.symbols("idiot").tolist()
    # ordinary words and numbers stay as they are, digits alone are one symbol
    assert toxicity.symbols("banana").tolist() == [0, 2, 1, 14, 1, 14, 1]
    assert toxicity.symbols("12345678 x\u00b2").tolist() == [0, *[27] * 8, 0, 24, 27]
    both = toxicity.symbols("zoquork banana z1o1q1u1o1r1k").tolist()
    assert both == want + toxicity.symbols("banana").tolist() + want
    # other scripts keep their letters apart
    assert len(set(toxicity.symbols("\u0433\u043b\u0443\u043f\u0435\u0446").tolist())) == 7


def test_first_model_is_a_lower_bound_of_log_odds():
    counts = np.zeros((2, 1 << 20))
    counts[:, 5], counts[:, 6], counts[:, 7] = (1, 40), (40, 40), (0, 1)
    found = toxicity.log_odds(counts, np.array([100, 50]))
    odds = np.log(40.5 / 51) - np.log(1.5 / 101)
    assert found[5] == pytest.approx(odds - toxicity.DOUBT * np.sqrt(1 / 1.5 + 1 / 40.5), rel=1e-5)
    assert 0 < found[6] < np.log(2) and found[7] == found[0] == 0
    s = toxicity.symbols("idiot")
    keys, n = toxicity._keys(np.concatenate([s, s]))
    assert set(n.tolist()) >= {2} and len(keys) == len(toxicity._keys(s)[0])


def toxic_corpus(n=700):
    rng = random.Random(5)
    syllables = ["ka", "lo", "mi", "ne", "ru", "ta", "so", "ve", "bi", "du"]
    rows = []
    for i in range(n):
        text = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            insult = rng.choice(["zoquork", "grunpfel"])
            insult = rng.choice([insult, insult.upper(), ".".join(insult), " ".join(insult), insult[:4] + "a" + insult[4:]])
            text.insert(rng.randrange(len(text)), insult)
        rows.append((i, " ".join(text) + ".", int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    ship_package(spark)
    rows = toxic_corpus()
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [(i, y) for i, _, y in rows if got[i]["held_out"]]
    assert len(held) > 100
    right = [got[i]["predicted"] == y for i, y in held]
    assert np.mean(right) > 0.97
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in got.values())
    # a character in every gap, digits for letters
    model = toxicity.train(toxicity.training_sample(docs, labels))
    hidden = ["z1o1q1u1o1r1k", "zxoxqxuxoxrxk", "z0qu0rk", "zzooqquuoorrkk", "g.r.u.n.p.f.e.l", "kalo mine rutaso"]
    texts = spark.createDataFrame([(i, f"kalo mi {w} neru ta.") for i, w in enumerate(hidden)], "doc_id long, text string")
    found = {hidden[r["doc_id"]]: r["predicted"] for r in toxicity.score(texts, model).collect()}
    assert found == {w: int(w != "kalo mine rutaso") for w in hidden}


def test_toxicity_odd_tables(spark):
    ship_package(spark)
    rows = [(1, None, "x"), (2, "", "x"), (3, "...", "x"), (None, "a", "x"), (4, "kalo " * 50_000, "x"), (4, "kalo", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.toxicity(docs, none).collect()
    assert len(scored) == 6 and all(r["score"] < 1e-6 and r["predicted"] == 0 for r in scored)
    odd = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (4, None), (99, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, odd).count() == 6
    assert toxicity.toxicity(docs.limit(0), odd).count() == 0
    model = toxicity.flat_model(0.0)
    kept = toxicity.score(docs, model, keep_columns=True).select("row.*")
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_pieces_replace_columns_of_their_names(spark):
    ship_package(spark)
    schema = "text string, ids int, decoded int, `my col` string, IDS2 int"
    df = spark.createDataFrame([("the end", 1, 2, "x", 3), (None, 1, 2, "y", 3)], schema)
    coded = pieces.decode_pieces(pieces.encode_pieces(df))
    assert coded.columns == ["text", "my col", "IDS2", "ids", "decoded"]
    rows = {r["my col"]: r for r in coded.collect()}
    assert rows["x"].decoded == "the end" and rows["y"].ids is None and rows["y"].decoded is None
    both = pieces.encode_pieces(df, decoded_col="text").collect()
    assert {r.text for r in both} == {"the end", None}
