import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakestar.llm import queries, tokencount
from lakestar.llm.common import pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def transducer():
    return tokencount.Transducer(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(4)
    made = ["".join(rng.choice("ab \n'1.é日s\tlvr") for _ in range(120)) for _ in range(150)]
    made += ["".join(rng.choice((" ", "  ", "'s", "'re", "''ll", "don't", "\n", " ", "　", "\x85", "²", "٣", "ǆ", "é", "中文", "😀", "--", "x1", "THE", "'VE")) for _ in range(40)) for _ in range(150)]
    return [*made, "", "  ", "\n\n a", "x<|endoftext|>  y <|endoftext|>", "日本語 テスト 😀😀  x", "a" * 3000, " " * 300 + "b", "I'LL don't 's'll", "=" * 99, "x\r\n\ty  z", "\x00\x1c \x85a", "ǆ ɏ ʰ ² ½", "'s", "''s", "x's's", " 's", "\n's", "'ll'", "'l", "'"]


def test_counts_are_the_library_s(transducer, library, monkeypatch):
    want = [len(e.ids) for e in library.encode_batch(texts(), add_special_tokens=False)]
    assert transducer.counts(pa.array(texts())).tolist() == want
    # Whatever the chunks, state maps compose to the same.
    for chunk in (1, 3, 17, 4096):
        monkeypatch.setattr(tokencount, "CHUNK", chunk)
        assert transducer.counts(pa.array(texts())).tolist() == want


def test_pretokens_are_the_library_s(library, transducer):
    for text in texts():
        if "<|" in text or not text:
            continue
        (_, offsets, data), = pieces(pa.array([text]))
        starts = np.flatnonzero(tokencount.token_starts(offsets, data, transducer.classes)).tolist()
        want = [len(text[:a].encode()) for _, (a, _) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert starts == want, text


def test_very_long_texts_with_and_without_white_space(transducer, library):
    rng = random.Random(5)
    long = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000)), "ab" * 100_000, "日本" * 50_000, " ".join("".join(rng.choice("etaoin") for _ in range(rng.randrange(1, 9))) for _ in range(200_000)), "=" * 70_000 + " " * 70_000]
    assert transducer.counts(pa.array(long)).tolist() == [len(e.ids) for e in library.encode_batch(long, add_special_tokens=False)]


def test_a_full_table_is_compiled_anew(transducer, library, monkeypatch):
    monkeypatch.setattr(tokencount, "MAX_STATES", 50)
    want = [len(e.ids) for e in library.encode_batch(texts(), add_special_tokens=False)]
    assert [int(transducer.counts(pa.array([t]))[0]) for t in texts()] == want


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": {"type": "WordPiece"}}, {"model": {"type": "BPE", "byte_fallback": True}}, {"added_tokens": [{"content": "<x>", "lstrip": True}]}])
def test_what_is_not_covered_raises(change):
    spec = {"model": {"type": "BPE"}, "pre_tokenizer": {"type": "ByteLevel", "use_regex": True}, "added_tokens": [], "normalizer": None}
    with pytest.raises(ValueError):
        tokencount.Transducer(json.dumps(spec | change))


def test_query_and_edges(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    got = queries.op4_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and all(r.over_limit == (r.n_tokens > 512) for r in got)
    rows = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "é", 6)], "doc_id long, text string, n_tokens long")
    assert sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in tokencount.count_tokens(rows, PATH).collect())) == [(0, 2, 1), (1, 0, 0), (1, 0, 0)]
    assert tokencount.count_tokens(rows.limit(0), PATH).collect() == []
