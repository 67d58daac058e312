import glob
import os

import numpy as np
import pytest

from custvalue.llm import shards as S
from custvalue.llm.queries import op9_token_shards


def decode(records):
    enc = S.tokenizer(open(S.VOCABULARY, "rb").read())
    rows = sorted(records, key=lambda r: r.ordinal)
    ids = np.concatenate([S.read_record(bytes(r.record))[1] for r in rows]) if rows else np.zeros(0, np.uint16)
    return [enc.decode(p.tolist()[:-1]) for p in np.split(ids, np.flatnonzero(ids == S.END) + 1)[:-1]]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_keyed_permutation(n):
    a, b = (S.feistel_slots(np.arange(n), n, key) for key in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 64 or (a != b).any() and (a != np.arange(n)).any()


def test_round_trip(documents):
    got = S.training_records(documents, per_shard=50).collect()
    assert sorted(decode(got)) == sorted(r.text or "" for r in documents.collect())
    assert sorted(r.slot for r in got) == list(range(len(got)))
    stride = S.HEADER.itemsize + 2 * S.LENGTH
    assert all(r.shard == r.slot // 50 and r.offset == r.slot % 50 * stride and len(r.record) == stride for r in got)


def test_files_are_sequential_and_resumable(documents, scratch):
    path = scratch("shards") + "/out"
    S.write_shards(S.training_records(documents, length=128, per_shard=200), path)
    stride, slot = S.HEADER.itemsize + 2 * 128 + 1, 0
    files = sorted(glob.glob(path.removeprefix("file:") + "/shard=*/part*"), key=lambda f: int(f.split("shard=")[1].split("/")[0]))
    assert len(files) > 1
    for f in files:
        data = open(f, "rb").read()
        for at in range(0, len(data), stride):
            head, ids = S.read_record(data[at:at + stride - 1])
            assert head["slot"] == slot and len(ids) == head["n"]
            slot += 1
    with pytest.raises(ValueError):
        S.read_record(data[:50] + b"\xff\xff" + data[52:stride - 1])


def test_odd_rows(odd, empty):
    got = S.training_records(odd, length=256).collect()
    assert sorted(decode(got)) == sorted(r.text or "" for r in odd.collect())
    assert S.training_records(empty).count() == 0


def test_query_writes_the_shards_it_lists(spark, sf, documents):
    got = op9_token_shards(spark, sf)
    files = {int(f.split("shard=")[1].split("/")[0]): f.removeprefix("file:").removeprefix("//") for f in got.inputFiles()}
    stride, want = S.HEADER.itemsize + 2 * S.LENGTH, {r.slot: r for r in S.training_records(documents).collect()}
    rows = got.collect()
    assert sorted(r.slot for r in rows) == sorted(want) and "record" not in got.columns
    for r in rows:
        with open(files[r.shard], "rb") as f:
            f.seek(r.offset)
            head, ids = S.read_record(f.read(stride))
        assert (head["slot"], head["ordinal"], head["n"], head["crc"]) == (r.slot, r.ordinal, r.n_tokens, r.crc)
        assert (r.first_doc_id, r.last_doc_id) == (want[r.slot].first_doc_id, want[r.slot].last_doc_id)


def test_shards_read_back(spark, odd, empty, scratch):
    path = scratch("read-back") + "/out"
    got = S.materialise(odd, path, length=256, per_shard=40, bytes_out=True)
    rows, want = got.collect(), S.training_records(odd, length=256, per_shard=40)
    assert len(got.inputFiles()) > 1 and sorted(decode(rows)) == sorted(r.text or "" for r in odd.collect())
    keys = ["slot", "shard", "ordinal", "first_doc_id", "last_doc_id", "n_tokens", "record"]
    assert sorted(map(tuple, got.select(keys).collect())) == sorted(map(tuple, want.select(keys).collect()))
    assert S.materialise(empty).count() == 0
    file = got.inputFiles()[0].removeprefix("file:").removeprefix("//")
    data = bytearray(open(file, "rb").read())
    data[S.HEADER.itemsize + 3] ^= 1
    os.makedirs(bad := scratch("damaged").removeprefix("file:") + "/out")
    open(bad + "/part-0", "wb").write(data)
    with pytest.raises(Exception, match="is damaged"):
        S.read_shards(spark, bad, 256, 40).count()
