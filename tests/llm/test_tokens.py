import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pursefold.llm.tokens import LONGEST, Encoder, chunks

FILES = {"byte_bpe_50k.json": True, "word_bpe_49k.json": False}
ODD = [
    "", " ", "  a  b\n c \n\nd", "a\tb c", "\x1c a\x1cb c\x1c d", "á ́b", "it's 'll 's x.", " lead", "trail ", "a, b. c.. d., ,e .",
    "a <|endoftext|> b<|startoftext|>", "ΟΔΥΣΣΕΥΣ ΟΣ", "a ​ b c  d", "x\r\ny z", "İ I ß ẞ", "1. 2, 3.4 é. é, 中文。 a中, Ġ Ġa",
]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path, spaces = public_tokenizers.path(request.param), FILES[request.param]
    return Encoder(path, spaces), Encoder(path, spaces, limit=5)


def test_odd_texts(pair):
    for own in pair:
        assert own.ids(ODD) == own.whole(ODD)
        assert [own.ids([t])[0] for t in ODD] == own.whole(ODD)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("ab.,'s1é中 \n\t ́\x1c<|"), max_size=30) | st.text(max_size=20), max_size=6))
def test_any_text(pair, texts):
    texts = [t.encode(errors="ignore").decode() for t in texts]
    for own in pair:
        assert own.ids(texts) == own.whole(texts)


def test_ids_are_32_bit_little_endian(pair):
    ids = pair[0].tokenizer.encode("some words", add_special_tokens=False).ids
    assert np.frombuffer(pair[0].ids(["some words"])[0], "<u4").tolist() == ids


def test_very_long_words_are_whole_and_not_remembered(pair):
    rng = np.random.default_rng(3)
    mixed = bytes(rng.choice(np.frombuffer(b"abcDEF019+/", np.uint8), 300_000)).decode()
    texts = [f"a {mixed}, b {mixed}", f"{mixed} c", f"{'x' * 50_000}. {'é' * 70}. {'w' * 66},", mixed, f" {'v' * 65}, {'v' * 65} {'v' * 65}"]
    for own in pair:
        for _ in range(2):
            assert own.ids(texts) == own.whole(texts)
            assert max(map(len, own.known), default=0) <= LONGEST


def test_few_calls_for_many_words(pair):
    """Words are not handed to the library one by one, nor again in other capitals, before a sign or at the end of a line."""
    names = ["".join(chr(97 + n // 26**k % 26) for k in range(4)) for n in range(2000)]
    texts = [" ".join(names[a : a + 100]) for a in range(0, 2000, 100)]
    if not pair[0].spaces:
        texts += [" ".join(n.title() + sign for n in names[:500]) for sign in ("", ",", ".", "?!", ")")] + ["\n".join(names[500:1000])]
    own, handed = Encoder(public_tokenizers.path("byte_bpe_50k.json" if pair[0].spaces else "word_bpe_49k.json"), pair[0].spaces), []
    wanted, whole = own.whole(texts), own.whole
    own.whole = lambda some, *more: handed.extend(some) or whole(some, *more)
    assert own.ids(texts) == wanted
    assert len(handed) < 300


def test_chunks_hold_every_row_and_few_bytes():
    texts = ["a" * 5, None, "é" * 30, "", *"bcdefg", None, "h" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    for rows in (batch, batch.slice(2, 7), batch.slice(0, 0)):
        parts = list(chunks(rows, 1, 10))
        assert [t for p in parts for t in p.column(1).to_pylist()] == rows.column(1).to_pylist()
        assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 10 for p in parts)


def test_columns_and_lists_give_the_same_ids(pair):
    column = pa.array(["x", *ODD, None])
    for own in pair:
        assert own.ids(column.slice(1)) == own.whole([*ODD, ""])
        assert own.ids(column.slice(0, 0)) == own.ids([]) == []
