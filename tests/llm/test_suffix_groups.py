"""Row groups of operator 3 follow the records, however many buckets a large table has."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from newsflow.llm import suffixdedup

BUCKETS = 400


def _table(r, n, size):
    texts = ["".join(r.choice(list("abcdefg "), size)) for _ in range(n)]
    asked = np.arange(0, size - 100, 400, dtype=np.uint32).tobytes()
    columns = [pa.array(np.arange(n)), pa.array(np.arange(n) * 7), pa.array(texts), pa.array([asked] * n, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["id", "hash", "text", "asked"])


@pytest.mark.parametrize("step", ["_samples", "_windows"])
def test_a_task_sends_one_row_group_per_bucket_and_all_at_once(step):
    table = _table(np.random.default_rng(5), 60, 40_000)
    batches = [table.slice(i, 10) for i in range(0, 60, 10)]
    got = list(getattr(suffixdedup, step)(100, 0, 1, BUCKETS, 1)(iter(batches)))
    assert sum(b.num_rows for b in got) == BUCKETS
    assert len(got) < BUCKETS / 10
    places = sum(len(cell) // 4 for b in got for cell in b.column(4).to_pylist())
    periods = np.add.outer(np.arange(0, 40_000, suffixdedup.PERIOD), suffixdedup.COVER)
    each = (periods <= 40_000 - 100 + suffixdedup.PERIOD - 1).sum() if step == "_samples" else sum(min(a, 56) + 1 for a in range(0, 39_900, 400))
    assert places == 60 * each


def test_groups_are_read_as_they_were_dealt():
    r = np.random.default_rng(7)
    ids, hashes = r.integers(-9, 9, 50), r.integers(0, 1 << 62, 50)
    at, doc, value = r.integers(0, 30, 900), r.integers(0, 50, 900), r.integers(0, 1 << 63, 900, dtype=np.uint64)
    got = pa.Table.from_batches(list(suffixdedup._dealt(suffixdedup.SAMPLE, at, ids, hashes, doc, value)))
    assert sorted(got.column("bucket").to_pylist()) == sorted(set(at.tolist()))
    for bucket in set(at.tolist()):
        rows = got.filter(pc.equal(got.column("bucket"), bucket))
        own_ids, own_hashes, own_doc, own = suffixdedup._gather(rows, {"a": np.uint64})
        want = sorted(zip(ids[doc[at == bucket]].tolist(), hashes[doc[at == bucket]].tolist(), value[at == bucket].tolist(), strict=True))
        assert sorted(zip(own_ids[own_doc].tolist(), own_hashes[own_doc].tolist(), own.tolist(), strict=True)) == want
        assert len(own_ids) == len(np.unique(doc[at == bucket]))
