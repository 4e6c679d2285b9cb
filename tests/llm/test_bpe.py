"""op12 against the library: ids, texts, cuts, special tokens and odd rows."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import bpe, tokens
from tests.conftest import SF
from tests.llm.frames import ODD, empty, odd

PATH = tokens.vocabulary(tokens.BYTE_BPE)
POOL = "ab zÉé ß\n\t  ''s'll'd're've12½²_-!?.…　 ́eͅ漢字Ωσς\x85\x1d|<|endoftext|>\r\nqzjxQ 'S"


def library(special_text=True):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = not special_text
    return t


def some_texts(n=6000):
    rng = random.Random(5)
    pieces = [*POOL, "<|endoftext|>", "'s", "'re", "  ", "\n\n", " the", "ing", "!'"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(50))) for _ in range(n)] + ["", "<|endoftext|>", "", "a" * 5000, ""]


@pytest.mark.parametrize("special_text", [True, False])
@pytest.mark.parametrize("window", [bpe.WINDOW, 64])
def test_ids(special_text, window):
    texts = some_texts() + [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    codec, own = bpe.Codec(PATH, special_text, window), library(special_text)
    want = [x.ids for x in own.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        ids, ends = codec.encode(pa.array(texts, pa.string()))
        got = np.split(ids, ends[:-1])
        assert [x.tolist() for x in got] == want
    assert codec.decode(ids, ends).to_pylist() == [own.decode(x, skip_special_tokens=False) for x in want]


def test_slices_and_empty():
    codec = bpe.Codec(PATH)
    array = pa.array(["first", "second one", "", "third"])
    ids, ends = codec.encode(array.slice(1, 2))
    assert ids.tolist() == library().encode("second one").ids and ends.tolist() == [len(ids)] * 2
    for none in (pa.array([], pa.string()), pa.array(["", ""])):
        ids, ends = codec.encode(none)
        assert len(ids) == 0 and ends.tolist() == [0] * len(none)


def test_any_ids_decode_as_the_library():
    rng, codec, own = np.random.default_rng(2), bpe.Codec(PATH), library()
    many = [rng.integers(0, 50257, rng.integers(0, 30)) for _ in range(2000)]
    # tokens of single bytes, which seldom make UTF-8
    many += [rng.integers(90, 260, rng.integers(0, 12)) for _ in range(2000)] + [np.array([5, 60000, 50256, 6])]
    for skip in (False, True):
        got = codec.decode(np.concatenate(many), np.cumsum([len(x) for x in many]), skip)
        assert got.to_pylist() == [own.decode(x.tolist(), skip_special_tokens=skip) for x in many]


def test_cuts_are_certain():
    """No token spans a cut, and cuts are many."""
    codec, text = bpe.Codec(PATH), "The quick brown fox can't jump over 12 lazy dogs, café crème brûlée. " * 20
    data = np.frombuffer(text.encode(), np.uint8)
    places = np.flatnonzero(codec.cuts(data))
    ends = np.cumsum([codec.width[i] for i in library().encode(text).ids])
    assert set(places.tolist()) <= set(ends.tolist()) and len(places) > 200


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Codec(tokens.vocabulary(tokens.WORD_BPE))


def test_op12_documents(spark):
    got = {r["doc_id"]: r for r in bpe.op12_bpe_round_trip(spark, SF).collect()}
    docs, own = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall(), library()
    assert len(got) == len(docs)
    for i, text in docs:
        ids = own.encode(text, add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op12_odd_rows(spark):
    rows = bpe.decode_ids(bpe.encode_texts(odd(spark))).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=key) == sorted(((r[0], r[1] or "") for r in ODD), key=key)
    assert bpe.decode_ids(bpe.encode_texts(empty(spark))).count() == 0
    kept = bpe.decode_ids(spark.sql("SELECT 1 AS text_id, 'x' AS more, CAST(NULL AS BINARY) AS ids"), text_col="out").collect()
    assert [tuple(r) for r in kept] == [(1, "x", "")]
