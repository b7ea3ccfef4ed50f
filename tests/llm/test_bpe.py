"""Forced-boundary encoding against the tokenizers library."""
import random

import numpy as np
import pytest

from helpers import docs, with_clashes
from tidewatch.llm import bpe


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer
    source = bpe.vocabulary_source()
    return bpe.ForcedBoundaryBpe(source, cache_fragments=500), Tokenizer.from_str(source)


POOL = [*" \n\t\r '’\"!?.%&aAzéßñ9½中文\xa0 　🙂́\x85\x1c\x00", "'s", "'re", "''", " the",
        "  ", "\n\n", "<|endoftext|>", "<|endof", "it's", "%'s", "therefore", "naïve ", "0x1F"]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(both, seed):
    mine, theirs = both
    rnd = random.Random(seed)
    for _ in range(4000):
        text = "".join(rnd.choice(POOL) if rnd.random() < 0.8 else chr(rnd.randrange(1, 0x3000))
                       for _ in range(rnd.randint(0, 14)))
        ids = theirs.encode(text, add_special_tokens=False).ids
        got = mine.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert mine.decode(got) == theirs.decode(ids, skip_special_tokens=False)


def test_cut_pairs_occur_in_no_token(both):
    mine, _ = both
    cut = mine.cut.reshape(256, 256)
    assert cut.any()
    for token in mine._bytes.values():
        assert not any(cut[a, b] for a, b in zip(token, token[1:]))


def test_any_id_decodes_as_in_the_library(both):
    mine, theirs = both
    rnd = random.Random(9)
    for _ in range(300):
        ids = [rnd.randrange(50257) for _ in range(6)]
        assert mine.decode(np.array(ids, "<u4").tobytes()) == theirs.decode(
            ids, skip_special_tokens=False)


def test_operator_edge_cases(spark, both):
    given = [(1, "plain text"), (None, None), (2, ""), (3, "é " * 50_000), (1, "plain text")]
    got = bpe.encode_decode(with_clashes(docs(spark, given))).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted(
        (str(i), t or "") for i, t in given)
    for r in got:
        ids = both[1].encode(r.decoded, add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
    assert bpe.encode_decode(docs(spark, [])).count() == 0
