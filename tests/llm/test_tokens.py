"""BPE and token files against the libraries, on driver documents and odd texts."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tessera.llm import bpe, token_files
from tessera.llm.pretoken import splitter

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_splitter_on_every_character():
    ours, theirs = splitter(P.PATTERN), regex.compile(P.PATTERN).findall
    for c in (*range(0x2000), *range(0x2000, 0x110000, 61)):
        if not 0xD800 <= c < 0xE000:
            text = f"ab{chr(c)}{chr(c)}cd {chr(c)} 12{chr(c)}3 ..{chr(c)}! {chr(c)}x'{chr(c)} 's"
            assert ours(text) == theirs(text)


def rows_of(df):
    return sorted((r[0] is None, r[0] or 0, bytes(r["ids"]), bytes(r["decoded"])) for r in df.collect())


@pytest.mark.parametrize("block_bytes", [1000, 16 << 20])
def test_round_trip(spark, odd, documents, reference, tmp_path, block_bytes):
    for name, df in (("odd", odd), ("documents", documents)):
        df.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        found = bpe.encode_documents(df, RANKS, P.PATTERN, decoded=True, buckets=7, block_bytes=block_bytes)
        again = bpe.decode_documents(found.withColumnRenamed("decoded", "first"), RANKS)
        assert again.where("decoded <> first").isEmpty()
        expected = []
        for doc_id, text in df.select("doc_id", "text").collect():
            ids = np.array(reference.encode_ordinary(text or ""), "<u4")
            expected.append((doc_id is None, doc_id or 0, ids.tobytes(), (text or "").encode()))
        assert rows_of(found) == sorted(expected)
        assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in found.collect())


def test_empty(empty):
    assert bpe.decode_documents(bpe.encode_documents(empty, RANKS, P.PATTERN), RANKS).collect() == []


def test_decode_unknown_id(spark):
    with pytest.raises(Exception, match="token table lacks"):
        bpe.decode_documents(spark.createDataFrame([(bytearray(b"\xff\xff\xff\x00"),)], "ids binary"), RANKS).collect()
    assert bpe.decode_documents(spark.createDataFrame([(None,)], "ids binary"), RANKS).first()["decoded"] is None


def test_token_table(spark):
    assert bpe.token_table(spark, RANKS).count() == 50256


MARKED = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>b <|endoftext", " <|ENDOFTEXT|> "]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_token_files(spark, odd, documents, tmp_path, special_as_text):
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    if special_as_text:
        whole.encode_special_tokens = True
    marked = spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string")
    for name, df in (("odd", odd), ("documents", documents), ("marked", marked)):
        path = str(tmp_path / name)
        token_files.write_token_files(df, path, P.path("byte_bpe_50k.json"), P.PATTERN, special_as_text=special_as_text)
        got = token_files.read_token_files(spark, path).orderBy("start").collect()
        texts = df.select("doc_id", "text").collect()
        assert len(got) == len(texts)
        assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in texts), key=lambda x: (x is not None, x or 0))
        start = 0
        for r in got:
            assert r["start"] == start and len(r["ids"]) == 4 * r["n_tokens"]
            start += r["n_tokens"]
        expected = sorted((r["doc_id"] is None, r["doc_id"] or 0, np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in texts)
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == expected
        one = [r for r in got if r["doc_id"] == 3]
        assert sorted(a.tobytes() for a in token_files.fetch_document(spark, path, 3)) == sorted(bytes(r["ids"]) for r in one)


def test_token_files_check_dictionary(spark, documents, tmp_path):
    path = str(tmp_path / "f")
    token_files.write_token_files(documents, path, P.path("byte_bpe_50k.json"), P.PATTERN)
    dictionary = token_files.open_token_files(spark, path)[1]
    assert dictionary
    wrong = spark.createDataFrame([(hashlib.sha256(b"x").hexdigest(), bytearray(b"x"), 2)], "dict_hash string, dictionary binary, width int")
    wrong.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, path).collect()


def test_token_files_empty(spark, empty, tmp_path):
    token_files.write_token_files(empty, str(tmp_path / "e"), P.path("byte_bpe_50k.json"), P.PATTERN)
    assert token_files.read_token_files(spark, str(tmp_path / "e")).collect() == []


def test_whole_text_tokenizer():
    encode = token_files.WordEncoder(token_files.load_tokenizer(P.path("word_bpe_49k.json")), P.PATTERN)
    assert encode.find is None and len(encode(["some words"])[0]) > 0
