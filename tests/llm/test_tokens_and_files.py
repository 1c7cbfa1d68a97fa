"""Packing, sharding and token files: exact round trips."""

from __future__ import annotations

import io
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stridelake.llm import packing, sharding, token_files, tokens


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text, end: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_words_give_the_ids_of_the_text(encode, texts):
    odd = ["", " \n", "It's 10's\u00a0x\x85y\x1cz", "\u03a3\u03a3 \u0301a e\u0301 \u0130", "a<|endoftext|>b <|startoftext|>", "caf\u00e9\u3000\u4e2d\u6587", "J\u030c W\u030a \u0130 \u212a End. A, b.. c., <|STARTOFTEXT|> it's. 10. x,\n"]
    given = odd + [t for _, t in texts]
    for text, ids in zip(given, tokens.WordTokenizer().encode([t.encode() for t in given])):
        assert ids == encode(text, 0)[:-1].tobytes(), text[:50]


def test_words_of_letters_and_symbols_share_what_is_known(encode):
    """Lower-case words take the short way of the tokenizer, and no word with symbols behind it is encoded on its own."""
    tokenizer, alone = tokens.WordTokenizer(), []
    assert tokenizer._encode_ascii != tokenizer._encode
    whole = tokenizer._encode
    tokenizer._encode = lambda texts, **options: (alone.extend(texts), whole(texts, **options))[1]
    texts = ["onhe onhe,### onhe&&& reat.!! a's a's. it.'s x's, re'. zz\\ zz^ zz~ zz` b.", "onhe&&& caf\u00e9!! end... a.b.c. '.. z' q,q <|endoftext|>a|>. \u212ae. won't!"]
    for _ in range(2):  # unknown, then known
        for text, ids in zip(texts, tokenizer.encode([t.encode() for t in texts])):
            assert ids == encode(text, 0)[:-1].tobytes()
    assert "onhe&&&" not in alone and "zz^" not in alone and alone.count("&&&") == 1


def test_each_distinct_word_is_looked_up_once(encode):
    """Repeated words cost no lookup of their own, whatever their case and the point or comma behind them."""
    tokenizer, asked = tokens.WordTokenizer(), []

    class Known(dict):
        def get(self, word, default=None):
            asked.append(word)
            return super().get(word, default)

    tokenizer._known = Known()
    texts = ["Erst \u00dcber den, erst \u00fcber DEN. \u00fcBer\n" * 50, "na\u00efve, na\u00cfve. \u00c9t\u00e9, \u00e9t\u00e9.\n" * 50, None, ""]
    for text, ids in zip(texts, tokenizer.encode([t and t.encode() for t in texts])):
        assert ids == encode(text, 0)[:-1].tobytes()
    assert sorted(asked) == sorted(w.encode() for w in ("erst", "\u00fcber", "den", ",", ".", "na\u00efve", "\u00e9t\u00e9"))


def test_letters_of_latin_1_take_the_short_way(encode):
    """Words of lower-case Latin-1 letters skip the normalizer; signs between the letters, other scripts, combining and special texts do not."""
    tokenizer, long_way = tokens.WordTokenizer(), []
    whole = tokenizer._encode
    tokenizer._encode = lambda texts, **options: (long_way.extend(" ".join(texts).split()), whole(texts, **options))[1]
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    texts = [
        " ".join(f"{c}bc a{c} x{c}{c.lower()}z. {c}, {c}!! {c}'s" for c in letters),
        "a\u00d7b \u00d7. a\u00d7, \u00f7, a\u00f7. \u00e9\u00d7\u00e9. \u00ff.\t\u00df,\r\u00b5. \u00aa, \u0130. \u03c3\u03c2. \u00e9\u3002,\u00a0x\u00c9.\u0085y",
        "\u00c9\u0301, \u00c9. \u00e9, A\u030a. B.",  # combining marks
        "\u00c9<|endoftext|>\u00c9. <|ENDOFTEXT|>, \u00c9, a. .", ".", ",", "\u00c9", "a.", "\u00e9,", ". a", " ", "\u00e9", "\u1100\u1161\u11a8. \u0915\u093c, \u00e9\u0915\u093c.",
    ]
    for some in (texts, texts[:2], *([t] for t in texts), []):
        for text, ids in zip(some, tokens.WordTokenizer().encode([t.encode() for t in some]), strict=True):
            assert ids == encode(text, 0)[:-1].tobytes(), text
    tokenizer.encode([texts[0].encode()])
    assert long_way and not [w for w in long_way if w.isalpha()]


def _check_packing(pieces, rows, encode):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == {i for i, _ in rows}
    for i, text in rows:
        ids, at = encode(text, 1), 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at & (at - 1) == 0 and at <= 2048  # full, or a power of two: no padding
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing_query(spark, sf, texts, encode):
    _check_packing(packing.op1_nnls_packing(spark, sf).collect(), texts, encode)


def test_packing_equal_lengths_and_ids(spark, encode):
    rows = [(i, "word " * 1500) for i in range(40)] + [(99, "x " * 5000), (100, None), (101, "")]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _check_packing(pieces, rows, encode)
    for p in pieces:
        ids = encode(dict(rows)[p["doc_id"]], 1)
        assert bytes(p["ids"]) == ids[p["start"] : p["start"] + p["length"]].tobytes()


def test_nnls_meets_the_conditions():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(20, 35)), rng.normal(size=20)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max() < 1e-6
    histogram = rng.integers(0, 1000, 127)
    used = np.zeros(127, np.int64)
    for strategy, n in packing.repeat_counts(histogram):
        assert sum(strategy) == 128 and n > 0
        for k in strategy:
            used[k - 1] += n
    assert (used <= histogram).all() and used.sum() > 0.6 * histogram.sum()


def test_sharding_query(spark, sf, texts):
    rows = sharding.op2_histogram_sort_sharding(spark, sf).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in texts}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (size[i], zlib.crc32((t or "").encode())) for i, t in texts}
    held = [[r for r in rows if r["shard"] == k] for k in range(8)]
    assert all(sorted(r["slot"] for r in h) == list(range(len(h))) for h in held)
    totals = [sum(r["size"] for r in h) for h in held]
    assert max(totals) - min(totals) <= 2 * max(size.values())


def test_sharding_a_hot_text(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = sharding.shard(df, F.lit(10), F.xxhash64("text"), ranges=2).collect()
    counts = np.bincount([r["shard"] for r in rows], minlength=8)
    assert counts.sum() == 3000 and counts.max() - counts.min() <= 8  # a hundredth of a shard at either edge


def test_sharding_keeps_small_groups_together(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 1000).cast("string").alias("text"))
    rows = sharding.shard(df, F.lit(10), F.xxhash64("text"), ranges=2).collect()
    assert len({(r["text"], r["shard"]) for r in rows}) == 1000
    assert np.ptp(np.bincount([r["shard"] for r in rows], minlength=8)) <= 8


def test_token_files_query(spark, sf, texts, encode):
    got, start = {r["doc_id"]: r for r in token_files.op4_seekable_token_files(spark, sf).collect()}, 0
    assert len(got) == len(texts)
    for i, text in sorted(texts):
        ids, r = encode(text, 2), got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_are_seekable_zstandard(spark, tmp_path, encode):
    rows = [(i, f"some words number {i} " * (i + 1)) for i in range(50)]
    catalogue = token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), f"file://{tmp_path}/t", frame_bytes=2000)
    files = sorted(tmp_path.glob("t/*.zst"))
    assert len(files) == catalogue.count() and not list(tmp_path.glob("t/.part*"))
    for path in files:
        reader = token_files.FrameReader(token_files.open_file(f"file://{path}"))
        for at in (len(reader.ids) - 1, 0):
            assert reader.document(at).tolist() == encode(dict(rows)[reader.ids[at]], 2).tolist()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
        assert whole.startswith(b"".join(reader.documents()))  # any reader of zstandard can read the file
    data = bytearray(files[0].read_bytes())
    data[12] ^= 1
    (tmp_path / "damaged").write_bytes(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.FrameReader(token_files.open_file(f"file://{tmp_path}/damaged")).documents())


def test_odd_rows(spark, odd, empty, tmp_path):
    pieces = packing.pack(odd).collect()
    assert sum(p["length"] for p in pieces if p["start"] == 0 and p["doc_tokens"] == 1) == 4  # null, empty and blank texts
    assert packing.pack(empty).collect() == []
    out = sharding.shard(odd, F.col("n_chars"), F.xxhash64("text"))
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns) and out.columns.count("shard") == 1
    assert sharding.shard(empty, F.col("n_chars"), F.xxhash64("text")).collect() == []
    catalogue = token_files.write_tokens(odd, f"file://{tmp_path}/odd")
    assert token_files.read_back(spark, catalogue, f"file://{tmp_path}/odd").count() == odd.count()
    catalogue = token_files.write_tokens(empty, f"file://{tmp_path}/none")
    assert token_files.read_back(spark, catalogue, f"file://{tmp_path}/none").collect() == []


def test_failed_attempts_leave_no_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, "some words") for i in range(20)], "doc_id long, text string").coalesce(1)
    with pytest.raises(Exception, match="level"):
        token_files.write_tokens(rows, f"file://{tmp_path}/failed", level=99)
    assert [p for p in os.listdir(f"{tmp_path}/failed") if not p.endswith(".crc")] == []


def test_ids_beyond_16_bits_are_an_error(spark):
    rows = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    with pytest.raises(Exception, match="16 bits"):
        packing.pack(rows, end_id=70_000).count()
