"""Token counts and the BPE codec against the tokenizers library itself."""

import hashlib
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from waycast.llm import bpe_codec, token_counts
from waycast.llm.catalog import CATALOG
from waycast.llm.common import pieces, read

FILE = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    None, "", " ", "\n\n  \n", "a  b   c", "don't can't we'll 'tis", "x<|endoftext|>y <|endoftext|> z",
    "übergröße, straße;naïve", "日本語テキスト。漢字 かな", "a b c 　d", "tab\tsep\x0b\x0c\r\n end ",
    "a\x1cb !\x1c? \x85z", "αβγ,δ naïveβ,x", "1234abc567,89", "word###&&& ### x", "éá ,", "🙂🙂 ok🙂,a",
    "A" * 50_000, "ab, " * 30_000, "  lead", "trail   ", "a 's b", "<|endof text|>",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "ids", None) for i, t in enumerate(HARD)] + [(3, HARD[3], "again", 1), (None, "no id", None, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, n_tokens int").repartition(3)


def test_pieces_join_to_the_text(spark, sf_dir):
    rows = [r.text for r in read(spark, sf_dir, "documents").collect()] + [t or "" for t in HARD]
    assert all("".join(pieces(t)) == t for t in rows)


@pytest.mark.parametrize("table", ["hard", "documents"])
def test_counts_equal_the_library(spark, sf_dir, tokenizer, hard, table):
    docs = hard if table == "hard" else read(spark, sf_dir, "documents")
    got = token_counts.count_tokens(docs, FILE, limit=7)
    wanted = [(r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False))) for r in docs.collect()]
    key = lambda r: str(r)
    rows = got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, rows), key=key) == sorted(((*w, w[2] > 7) for w in wanted), key=key)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_other_libraries(spark, hard, name):
    encode = token_counts.encoder(public_tokenizers.path(name))
    got = token_counts.count_tokens(hard, public_tokenizers.path(name)).select("text", "n_tokens").collect()
    assert all(r.n_tokens == len(encode([r.text or ""])[0]) for r in got)


@pytest.mark.parametrize("table", ["hard", "documents"])
def test_codec_equals_the_library(spark, sf_dir, tokenizer, hard, table):
    docs = hard if table == "hard" else read(spark, sf_dir, "documents").select("doc_id", "text")
    got = bpe_codec.encode(docs, FILE)
    assert set(got.columns) == {*docs.columns, "n_tokens", "ids", "decoded"} - {"text"}
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        want.append((str(r.doc_id), len(ids), struct.pack(f"<{len(ids)}I", *ids), tokenizer.decode(ids, skip_special_tokens=False).encode()))
    assert sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got.collect()) == sorted(want)


def test_codec_query(spark, sf_dir, tokenizer):
    got = {r.doc_id: r for r in CATALOG["op6_bpe_codec"](spark, sf_dir).collect()}
    docs = read(spark, sf_dir, "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_decode_by_join(spark, tokenizer):
    ids = tokenizer.encode("Straße, <|endoftext|> x", add_special_tokens=False).ids
    rows = spark.createDataFrame([(1, ids), (2, []), (3, None)], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe_codec.decode(rows, FILE).collect()}
    assert bytes(got[1]).decode() == "Straße, <|endoftext|> x" and bytes(got[2]) == b"" and got[3] is None


def test_empty_tables(spark, hard):
    none = hard.limit(0)
    assert token_counts.count_tokens(none, FILE).count() == 0 and bpe_codec.encode(none, FILE).count() == 0


def test_blocks_are_computed_once(spark, sf_dir):
    got = CATALOG["op6_bpe_codec"](spark, sf_dir)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
