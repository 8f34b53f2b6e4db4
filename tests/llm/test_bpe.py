import base64
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from ratevane.llm import bpe
from ratevane.llm.textbuf import chunks

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_the_library(library):
    random.seed(1)
    letters = "ab1 '  \nstrevlmd-é٣ 🙂　\u0085"
    texts = ["", "'s's 'll 're' ''s a'sb it's  'S x''t", "a  \n b\n\nc \t", "   ", " ", "\n", "x" * 500, "ab" * 3000, "日本語 テスト１２３", "<|endoftext|>", "é" * 130]
    texts += ["".join(random.choice(letters) for _ in range(random.randint(0, 90))) for _ in range(1500)]
    own = bpe.Encoder(PATH)
    for limit in (50, 1 << 20):
        packed, begins, firsts = [], [], []
        for _, _, data, off in chunks(pa.array(texts), limit):
            a, b, c = own.encode(data, off)
            packed += a
            begins += b
            firsts += c
        for t, p, b, f in zip(texts, packed, begins, firsts, strict=True):
            assert np.frombuffer(p, "<u4").tolist() == library.encode_ordinary(t)
            assert own.decode(np.frombuffer(p, "<u4").astype(np.int64), b, f) == t.encode()
            raw = t.encode()
            edge = [*b.tolist(), len(raw)]
            assert b"".join(raw[x:y] for x, y in zip(edge, edge[1:], strict=False)) == raw


def test_rows(docs, none, library):
    read = bpe.decode_ids(bpe.encode_texts(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in read) == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert bpe.encode_texts(none, PATH).collect() == []


def test_offsets_that_belong_to_another_text_are_refused():
    own = bpe.Encoder(PATH)
    made = [own.encode(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in (b"one two three", b"three, two one")]
    ids = np.frombuffer(made[0][0][0], "<u4").astype(np.int64)
    assert own.decode(ids, made[0][1][0], made[0][2][0]) == b"one two three"
    with pytest.raises(ValueError, match="belong together"):
        own.decode(ids[::-1], made[1][1][0], made[1][2][0][: len(ids)])
