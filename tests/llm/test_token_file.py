import uuid

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pursefold.llm import token_file
from pursefold.llm.common import shared_dir


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 99), min_size=1, max_size=700), st.integers(1, 12))
def test_round_trip_of_any_ids(ids, times):
    ids = np.array(ids * times, "<u4")
    assert np.array_equal(token_file.decode(token_file.encode(ids, 100), 100), ids)


def test_round_trip_of_large_blocks():
    random = np.random.default_rng(3)
    for n in (1, 63, 64, 65, 1000, 70_001, 300_000):
        ids = np.minimum(random.zipf(1.3, n), 49_407).astype("<u4")
        ids[n // 2 : n // 2 + 5000] = ids[:5000][: len(ids[n // 2 : n // 2 + 5000])]
        data = token_file.encode(ids, 49_408)
        assert np.array_equal(token_file.decode(data, 49_408), ids)


def test_repeats_are_short():
    ids = np.tile(np.arange(64, dtype="<u4") + 1000, 2000)
    assert len(token_file.encode(ids, 49_408)) < len(ids) * 0.5


def test_damage_is_noticed():
    data = bytearray(token_file.encode(np.arange(5000, dtype="<u4"), 49_408))
    data[len(data) // 2] ^= 255
    with pytest.raises((ValueError, IndexError)):
        token_file.decode(bytes(data), 49_408)
    with pytest.raises(ValueError):
        token_file.decode(b"nothing of the kind, and long enough", 49_408)


def test_files_give_back_every_document(spark, odd):
    from tokenizers import Tokenizer

    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    token_file.write(odd, path, public_tokenizers.path("word_bpe_49k.json"), 2, 49_408)
    got = token_file.read(spark, path, 49_408).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    wanted = sorted(((-1 if r.doc_id is None else r.doc_id), tuple([*plain.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in odd.collect())
    found = sorted(((-1 if r.doc_id is None else r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got)
    assert found == wanted
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((r.doc_id for r in got), key=lambda x: -1 if x is None else x)


def test_empty_table(spark, odd):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    token_file.write(odd.filter("false"), path, public_tokenizers.path("word_bpe_49k.json"), 2, 49_408)
    assert token_file.read(spark, path, 49_408).count() == 0
