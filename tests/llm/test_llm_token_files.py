"""Token files: exact round trip, layout and order."""

import glob
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelsift.llm import common, token_files

PATH = common.vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]


def test_files_hold_the_ids_in_order(spark, make_docs, prose, tokenizer, tmp_path):
    rows = [(k, prose(k * 3, k)) for k in range(60)] + [(100, None), (101, ""), (102, "  two  spaces \n\n x <|endoftext|>")]
    token_files.encode_to_files(make_docs(rows), str(tmp_path / "t"), PATH, partitions=5)
    got = sorted((r.doc_id, r.start, r.n_tokens, list(r.ids)) for r in token_files.read_tokens(spark, str(tmp_path / "t")).collect())
    start = 0
    for (doc_id, text), r in zip(sorted(rows), got, strict=True):
        want = ids_of(tokenizer, text)
        assert r == (doc_id, start, len(want), want)
        start += len(want)
    files = sorted(glob.glob(f"{tmp_path}/t/data/*.parquet"))
    assert len(files) > 1
    for f in files:
        table = pq.read_table(f)
        assert table["doc_id"].to_pylist() == sorted(table["doc_id"].to_pylist())
        column = pq.ParquetFile(f).metadata.row_group(0)
        kinds = {column.column(k).path_in_schema: column.column(k) for k in range(column.num_columns)}
        assert "DELTA_BINARY_PACKED" in kinds["doc_id"].encodings and kinds["doc_id"].has_offset_index
        ids = next(v for k, v in kinds.items() if k.startswith("ids"))
        assert "RLE_DICTIONARY" in ids.encodings


def test_lengths_are_read_without_ids(spark, make_docs, tmp_path):
    token_files.encode_to_files(make_docs([(1, "a b"), (2, "c")]), str(tmp_path / "t"), PATH)
    lengths = token_files.read_tokens(spark, str(tmp_path / "t"), ("doc_id", "n_tokens")).where("doc_id = 2")
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "EqualTo(doc_id,2)" in plan


def test_crc(make_docs, tokenizer):
    docs = make_docs([(3, "one two"), (4, None)])
    got = {r.doc_id: r.ids_crc32 for r in token_files.with_crc(token_files.token_files(docs, PATH)).collect()}
    assert got == {i: zlib.crc32(np.array(ids_of(tokenizer, t), "<u4").tobytes()) for i, t in ((3, "one two"), (4, None))}


def test_odd_rows_and_empty_table(odd_docs):
    got = token_files.token_files(odd_docs, PATH).collect()
    assert len(got) == odd_docs.count()
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert token_files.token_files(odd_docs.limit(0), PATH).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t 　 \x85\x1cabAé'sñ1٣½.,!<|>_中"), max_size=40), min_size=1, max_size=6))
def test_pieces_are_encoded_like_whole_texts(texts):
    encoder = token_files._encoder(PATH)
    ids, n = encoder.encode(*common.text_buffers(pa.array(texts)), token_files.END_ID)
    ends = np.cumsum(n)
    for text, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == ids_of(encoder.tokenizer, text)


def test_memory_is_bounded(monkeypatch):
    encoder = token_files.PieceEncoder(PATH, entries=50)
    for k in range(20):
        texts = pa.array([" ".join(f"w{k}x{j}" for j in range(20))])
        ids, _ = encoder.encode(*common.text_buffers(texts), 2)
        assert ids.tolist() == ids_of(encoder.tokenizer, texts[0].as_py())
        assert len(encoder.keys) <= 50


def test_kept_pieces_take_no_more_than_they_may(tokenizer):
    encoder = token_files.PieceEncoder(PATH, size=2000)
    for k in range(20):
        texts = pa.array([" ".join(f"w{k}x{j}" for j in range(30)), "the one " * 3])
        ids, _ = encoder.encode(*common.text_buffers(texts), 2)
        assert ids.tolist() == [i for t in texts.to_pylist() for i in ids_of(tokenizer, t)]
        assert len(encoder.keys) and encoder._size() <= 2000


def test_kept_pieces_are_not_copied_for_a_slice(tokenizer):
    import tracemalloc

    n, ids_each = 400_000, 16
    encoder = token_files.PieceEncoder(PATH)
    keys = np.random.default_rng(1).permutation(np.arange(1, n + 1, dtype=np.uint64) << np.uint64(40))
    encoder._learn(keys, [b"%024d" % k for k in range(n)], np.full(n, ids_each), np.zeros(n * ids_each, "<i4"))
    assert len(encoder.keys) == n
    tracemalloc.start()
    ids, _ = encoder.encode(*common.text_buffers(pa.array(["a few new pieces"])), 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Hashes and numbers are put in order, old and new at once with a mask; the 24 bytes and 16 ids of a piece stay where they are.
    assert ids.tolist() == ids_of(tokenizer, "a few new pieces") and peak < n * 40


def test_ids_of_the_plain_call(spark, make_docs, prose, tokenizer, tmp_path):
    special = ["<|endoftext", "a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  <|endoftext|>y z", "é<|endoftext|>'s <| endoftext |>"]
    texts = [prose(40, k) for k in range(5)] + ["", *special]
    token_files.encode_to_files(make_docs(list(enumerate(texts))), str(tmp_path / "t"), PATH)
    got = {r.doc_id: list(r.ids) for r in token_files.read_tokens(spark, str(tmp_path / "t"), ("doc_id", "ids")).collect()}
    assert all(got[k] == ids_of(tokenizer, t) for k, t in enumerate(texts)) and 50256 in got[7]


def thue_morse(n, flip=0):
    return "".join("ab"[(k.bit_count() + flip) % 2] for k in range(n))


@pytest.mark.parametrize("n", [40, 64, 1032, 2056, 4104])
def test_pieces_alike_under_polynomial_hashes_differ(tokenizer, n):
    texts = ["q" + thue_morse(n) + "zz", "q" + thue_morse(n, 1) + "zz"]
    encoder = token_files.PieceEncoder(PATH)
    for text in texts * 2:
        ids, _ = encoder.encode(*common.text_buffers(pa.array([text])), 2)
        assert ids.tolist() == ids_of(tokenizer, text)


def test_pieces_that_share_a_hash_are_compared(tokenizer, monkeypatch):
    # Hashes of the length alone: every piece of one length meets every other.
    monkeypatch.setattr(token_files, "word_hashes", lambda data, start, end, eight: (end - start).astype(np.uint64))
    encoder = token_files.PieceEncoder(PATH)
    for texts in (["ab cd ef", "cd ab"], ["xy cd", "ab " * 50], ["", "q" * 300 + " " + "r" * 300]):
        ids, n = encoder.encode(*common.text_buffers(pa.array(texts)), 2)
        assert ids.tolist() == [i for t in texts for i in ids_of(tokenizer, t)]
