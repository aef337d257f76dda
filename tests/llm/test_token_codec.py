import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from skymatch.llm import token_codec as C

P = pytest.importorskip("public_tokenizers")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 300_000])
def test_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 49_000).astype(np.uint32)
    symbols, counts = np.unique(np.append(ids, 1), return_counts=True)
    table = C.Table.of_counts(symbols.astype(np.int64), counts)
    assert table.freqs.sum() == 1 << C.SCALE_BITS and (table.freqs > 0).all()
    e = C.encode(ids, table)
    assert (C.decode(n, e["words"], e["states"], table) == ids).all()
    for row, at, states in zip(e["mark_rows"], e["mark_words"], e["mark_states"], strict=True):
        assert (C.decode(n, e["words"], states, table, row, at) == ids[row * C.LANES :]).all()
        assert (C.decode(n, e["words"], states, table, row, at, row + 1) == ids[row * C.LANES : (row + 1) * C.LANES]).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(), max_size=3))
def test_encoder_agrees_with_whole_texts(texts):
    t = tokenizer()
    got = C.Encoder(t.to_str()).encode([x.encode() for x in texts])
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aZéßİKſΣσ'’.,!<|>sd \u0301\u0345ﬁ1", max_size=12), max_size=4))
def test_encoder_on_tricky_letters(texts):
    t = tokenizer()
    e = C.Encoder(t.to_str(), limit=3)
    for _ in range(2):
        got = e.encode([x.encode() for x in texts])
        assert [np.frombuffer(x, dtype="<u2").tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]


@pytest.mark.parametrize("text", ["<|endoftext|> and<|startoftext|>x", "é é é ́x", "a b c\x1cd\x85e", "don't I'll 12.5 ... ÀΣ", None])
def test_encoder_on_odd_texts(text):
    t = tokenizer()
    got = np.frombuffer(C.Encoder(t.to_str()).encode([text and text.encode()])[0], dtype="<u2").tolist()
    assert got == t.encode(text or "", add_special_tokens=False).ids + [1]


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    e = C.Encoder(t.to_str())
    assert not e.by_words and C.Encoder(tokenizer().to_str()).by_words
    text = "Two  words,\n and a third"
    assert np.frombuffer(e.encode([text.encode()])[0], dtype=e.kind).tolist() == t.encode(text, add_special_tokens=False).ids + [1]


def test_some_documents_from_checkpoints(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "CHECKPOINT_ROWS", 2)
    texts = [(i, " ".join(str((i * 7919 + j) % 1000) for j in range(900))) for i in range(60)]
    path = str(tmp_path / "tokens")
    with open(P.path("word_bpe_49k.json")) as f:
        C.write_tokens(spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1), path, f.read())
    every = {r.doc_id: tuple(r) for r in C.read_tokens(spark, path).collect()}
    some = {r.doc_id: tuple(r) for r in C.read_tokens(spark, path, [3, 31, 59, 1000]).collect()}
    assert set(some) == {3, 31, 59} and all(every[i] == r for i, r in some.items())


@pytest.mark.parametrize("range_ids", [32 << 20, 2000])
def test_report(docs, rows, monkeypatch, range_ids):
    monkeypatch.setattr(C, "BLOCK_IDS", 3000)
    monkeypatch.setattr(C, "RANGE_IDS", range_ids)
    t, start, want = tokenizer(), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in C.report(docs, P.path("word_bpe_49k.json")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words in a text")], "doc_id bigint, text string")
    path = str(tmp_path / "tokens")
    with open(P.path("word_bpe_49k.json")) as f:
        C.write_tokens(df, path, f.read())
    blocks = spark.read.parquet(f"{path}/blocks").toPandas()
    blocks.at[0, "words_crc32"] = 1
    spark.createDataFrame(blocks, spark.read.parquet(f"{path}/blocks").schema).write.parquet(str(tmp_path / "bad/blocks"))
    for part in ("tables", "ranges"):
        spark.read.parquet(f"{path}/{part}").write.parquet(str(tmp_path / "bad" / part))
    assert C.read_tokens(spark, path).count() == 1
    with pytest.raises(Exception, match="damaged"):
        C.read_tokens(spark, str(tmp_path / "bad")).collect()


def test_empty_table(empty):
    assert C.report(empty, P.path("word_bpe_49k.json")).count() == 0
