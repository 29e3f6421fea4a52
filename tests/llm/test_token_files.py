import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cabgrid import session
from cabgrid.llm import token_files
from tests.llm.test_packing import whole


@pytest.mark.parametrize("bits", [1, 8])
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(bits, values):
    planes = token_files.to_planes(np.array(values, "<u4"), bits)
    assert len(planes) == 32 // bits
    assert token_files.from_planes(planes, len(values), bits).tolist() == values


@pytest.mark.parametrize("bits", [1, 8])
def test_shard_round_trip(tmp_path, bits):
    fs, base = token_files.open_folder(f"file://{tmp_path}")
    writer = token_files.ShardWriter(fs, f"{base}/x.ids", "7", bits, block=5)
    docs = [(3, [1, 2, 3]), (None, []), (4, list(range(70_000, 70_017))), (9, [0])]
    for doc_id, values in docs:
        writer.add(doc_id, np.array(values, "<u4").tobytes())
    assert not (tmp_path / "x.ids").exists()
    writer.close()
    assert [p.name for p in tmp_path.iterdir()] == ["x.ids"]
    reader = token_files.ShardReader(fs, f"{base}/x.ids")
    assert list(reader.documents()) == [(d, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for d, v in docs]
    everything = [x for _, v in docs for x in v]
    assert reader.n_ids == len(everything) and len(reader.chunks) == -(-len(everything) // 5)
    assert reader.chunk(2).tolist() == everything[10:15]


def test_incomplete_shards_are_refused(tmp_path):
    (tmp_path / "x.ids").write_bytes(b"x" * 100)
    fs, base = token_files.open_folder(str(tmp_path))
    with pytest.raises(ValueError):
        token_files.ShardReader(fs, f"{base}/x.ids")


@pytest.mark.parametrize("bits", [1, 8])
def test_documents_in_order(spark, rows, wide, bits):
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.write_and_read(wide, bits=bits).collect())
    start, want = 0, []
    for doc_id, text, *_ in sorted(rows):
        found = np.array([*whole(token_files.TOKENIZER, text or ""), 0], "<u4")
        want.append((doc_id, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    assert got == want


def test_shards_roll_over(spark, docs):
    shards = token_files.write(docs, session.scratch_path(spark, "ids"), shard_ids=2000)
    assert shards.filter("n_ids > 2000").count() > 0 and shards.count() > 8
    assert token_files.read(shards).count() == docs.count()


def test_empty_and_repeated(empty, repeated):
    assert token_files.write_and_read(empty).count() == 0
    found = token_files.write_and_read(repeated).collect()
    assert len(found) == repeated.count()
    assert sorted(r.start for r in found)[0] == 0
