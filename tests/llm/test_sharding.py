import collections
import zlib

import pytest

from credlake.llm import sharding
from credlake.llm.op6_sharding import op6_rendezvous_shards


def test_query_law(spark, sf, docs):
    rows = op6_rendezvous_shards(spark, sf).collect()
    assert len(rows) == docs.count()
    shards, slots = collections.defaultdict(set), collections.defaultdict(list)
    for r in rows:
        shards[r.doc_id].add((r.shard, r.grown_shard))
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.size, r.text_crc32) for r in rows) == want


def test_weights_and_growth(spark):
    ids = spark.range(20000)
    old, new = [1.0, 1.0, 2.0], [1.0, 1.0, 2.0, 4.0]
    rows = sharding.assign(ids, "id", old, new).collect()
    share = collections.Counter(r.shard for r in rows)
    assert abs(share[2] / 20000 - 0.5) < 0.02 and abs(share[0] / 20000 - 0.25) < 0.02
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert all(r.grown_shard == 3 for r in moved) and abs(len(moved) / 20000 - 0.5) < 0.02
    with pytest.raises(ValueError):
        sharding.assign(ids, "id", [1.0, 0.0])


def test_slots_over_many_partitions_with_ties(spark):
    df = spark.range(0, 3000, 1, 7).selectExpr("id div 10 as id", "'x' as place", "1 as part", "2 as before")
    rows = sharding.with_slots(sharding.assign(df, "id", [1.0, 1.0]), "shard", ["id"]).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append((r.slot, r.id))
        assert r.place == "x" and r.before == 2
    for group in by.values():
        group.sort()
        assert [s for s, _ in group] == list(range(len(group)))
        assert [i for _, i in group] == sorted(i for _, i in group)


def test_empty_and_written_shards(spark, empty, docs, tmp_path):
    placed = sharding.with_slots(sharding.assign(empty, "doc_id", [1.0]), "shard", ["doc_id"])
    assert placed.count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"), "doc_id", [1.0, 3.0], files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()
