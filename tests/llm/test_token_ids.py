import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import dac, token_ids

from .conftest import ODD

ALPHABET = " \t\n  　​\x85\x1c'´`’abcABCzß1239.,!?<|é́̀İIı中文😀_-##﻿ s'llvere"


def test_random_access_round_trip():
    random.seed(0)
    for n in (0, 1, 8, 511, 512, 513, 3000):
        ids = np.array([random.choice([0, 1, 255, 256, 65535, 65536, 2**32 - 1]) for _ in range(n)], np.uint32)
        f = dac.File(dac.file_bytes([5, None], [n // 3, n - n // 3], ids))
        assert (f.ids(0, n) == ids).all() and f.doc(1)[0] is None and (f.doc(1)[1] == ids[n // 3:]).all()
        assert [f.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
    with pytest.raises(ValueError):
        dac.File(b"nothing of that kind.....")


def test_words_in_a_row_equal_the_whole_text():
    random.seed(1)
    t, e = Tokenizer.from_file(token_ids.word_vocabulary()), token_ids.word_tokeniser(token_ids.word_vocabulary())
    for k in range(3000):
        s = "".join(random.choice(ALPHABET) for _ in range(random.randint(0, 14)))
        s += random.choice(["", "", "<|endoftext|>", "x<|endoftext|>Y"]) if k % 3 == 0 else ""
        assert e(s.encode()).tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_files_hold_all_documents_in_order(spark, docs_of):
    t = Tokenizer.from_file(token_ids.word_vocabulary())
    got = sorted(token_ids.token_ids(docs_of(ODD), token_ids.word_vocabulary(), file_ids=50).collect(), key=lambda r: r.start)
    ids = {r[1]: t.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in ODD}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert [r.doc_id for r in got] == sorted((r[0] for r in ODD), key=lambda x: (x is not None, x or 0))
    assert sorted(r.ids_crc32 for r in got) == sorted(crc(ids[r[1]]) for r in ODD)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert token_ids.token_ids(docs_of(ODD).limit(0), token_ids.word_vocabulary()).count() == 0
