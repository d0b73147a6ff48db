import base64
import hashlib

import public_tokenizers as tokenizers
import pytest
import tiktoken

from blockloom.llm import bpe

RANKS = bpe.read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in RANKS.splitlines())}
    return tiktoken.Encoding("library", pat_str=tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    joined = ",".join(map(str, ids)).encode()
    return len(ids), ids, hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_equals_the_library_on_whole_texts(docs, odd, texts, library):
    rows = list(enumerate([*odd, *texts.values()]))
    found = bpe.encode_texts(docs([*rows, (None, "a b"), (1, "")]), RANKS, tokenizers.PATTERN).collect()
    by_id = {r[0]: tuple(r[1:]) for r in found}
    assert len(found) == len(rows) + 2
    assert all(by_id[i] == expected(library, text) for i, text in rows)
    assert by_id[None] == expected(library, "a b")


@pytest.mark.parametrize("size", (1, 2, 7, 100))
def test_chunks_do_not_change_ids(library, odd, texts, size):
    for text in [t for t in odd if t and len(t) < 30_000] + list(texts.values())[:60]:
        parts = list(bpe.encode(text, library, size))
        assert [i for part in parts for i in part] == library.encode_ordinary(text)
        assert "".join(bpe.chunks(text, size)) == text


def test_long_texts_are_cut():
    assert len(list(bpe.chunks("ab12 \n" * 50_000, 1 << 10))) > 100


def test_decoding_gives_the_bytes_back(docs, odd):
    rows = docs(list(enumerate(odd)))
    encoded = bpe.encode_texts(rows, RANKS, tokenizers.PATTERN)
    found = dict(bpe.decode_ids(encoded, RANKS, tokenizers.PATTERN).collect())
    assert all(bytes(found[i]) == (text or "").encode() for i, text in enumerate(odd))


def test_ids_may_end_inside_a_character(spark, library):
    ids = library.encode_ordinary("𐍈")
    rows = spark.createDataFrame([(1, ids[:1]), (2, []), (3, None)], "doc_id long, token_ids array<int>")
    found = dict(bpe.decode_ids(rows, RANKS, tokenizers.PATTERN).collect())
    assert bytes(found[1]) == library.decode_bytes(ids[:1]) and found[2] == b"" and found[3] is None


def test_empty_table(docs):
    assert bpe.encode_texts(docs([]), RANKS, tokenizers.PATTERN).count() == 0
