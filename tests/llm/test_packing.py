import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cabgrid.llm import packing
from cabgrid.llm.encoding import TextEncoder, encoder

ODD = [
    "", " ", "  a", "a  b", "a \nb", "a\n\nb c", "don't I'LL x's", "<|endoftext|> a<|endoftext|>", "\x1ca b", "a\xa0b",
    "İstanbul", "é ́x", "日本 語 12 ab12", "a\x85b  c", "x \x1cb", "ΑΣ ΣΑΣ", "\r\n a", " trailing ", "a \t b",
    "ﬁ ŉ ǰ ß", "🙂 🙂🙂a", "Ǆ ǅx", "a\x00b \x01 c", "a    b", "1234 5,6", " 's 't", "а́ бв", "a b., c", "x ,y",
    "Straße, groß.", "a.b,c 1,2 3.4", "x.\ny", "x. \ny", "end.",
]
LIBRARY = {}


def whole(name, text):
    if name not in LIBRARY:
        LIBRARY[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return LIBRARY[name].encode(text, add_special_tokens=False).ids


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_the_whole_text(name):
    small = TextEncoder(public_tokenizers.path(name), remembered=3)
    for text in ODD:
        assert ids(small, text) == whole(name, text), repr(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@given(text=st.text(st.sampled_from("aB é,.'s \n\t1ß日\x00\x1c\x85 !-İ́"), max_size=30))
@settings(max_examples=200, deadline=None)
def test_any_text_gives_the_ids_of_the_whole_text(name, text):
    assert ids(encoder(name), text) == whole(name, text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@given(
    parts=st.lists(
        st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "endoftext|>", " ", "  ", "\n", "a", "Ab, c.", "é"]),
        max_size=8,
    )
)
@settings(max_examples=300, deadline=None)
def test_added_tokens_are_the_librarys(name, parts):
    """At the start, in the middle, at the end, twice, and next to blanks."""
    text = "".join(parts)
    assert ids(encoder(name), text) == whole(name, text)


def test_added_tokens_have_their_own_ids():
    end = "<|endoftext|>"
    assert ids(encoder("byte_bpe_50k.json"), f"a {end}{end} b") == [64, 220, 50256, 50256, 275]
    assert 49407 in ids(encoder("word_bpe_49k.json"), f"a {end}")


def check_plan(histogram, capacity):
    found = packing.plan(histogram, capacity)
    used = Counter()
    for p in found:
        assert 0 < sum(p.lengths) <= capacity and p.repeats > 0
        for x in p.lengths:
            used[x] += p.repeats
    assert used == Counter({k: v for k, v in histogram.items() if v})
    return sum(p.repeats for p in found)


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
@settings(max_examples=150, deadline=None)
def test_plan_uses_every_piece_once(histogram):
    check_plan(histogram, 40)


def test_plan_is_close_to_the_bound():
    rng = random.Random(3)
    lengths = Counter(min(2048, max(1, int(rng.lognormvariate(6, 1.2)))) for _ in range(20_000))
    bound = -(-sum(k * v for k, v in lengths.items()) // 2048)
    assert check_plan(lengths, 2048) <= bound * 1.002 + 1


def test_nothing_to_pack():
    assert packing.plan({}) == []


def expected_pieces(rows):
    out = {}
    for doc_id, text, *_ in rows:
        found = [*whole(packing.TOKENIZER, text or ""), 0]
        for piece, at in enumerate(range(0, len(found), 2048)):
            part = np.array(found[at : at + 2048], "<u4").tobytes()
            out[doc_id, piece] = (at, len(part) // 4, zlib.crc32(part))
    return out


def test_pieces_and_places(rows, wide):
    found = packing.pack_documents(wide).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == expected_pieces(rows)
    assert len(found) == len(expected_pieces(rows))
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048


def test_empty_and_repeated(empty, repeated):
    assert packing.pack_documents(empty).count() == 0
    assert packing.pack_documents(repeated).count() == repeated.count()
