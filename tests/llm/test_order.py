import numpy as np
import pyarrow as pa
import pytest

from limnia.llm import order, queries
from limnia.llm.tokens import Encoder


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    p = order.Permutation(n, 42)
    slots = p.slot(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert p.number(slots).tolist() == list(range(n))
    if n >= 1000:
        assert order.Permutation(n, 43).slot(np.arange(n)).tolist() != slots.tolist()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


def test_round_trip(spark, tmp_path):
    rows = [(i, f"Stone and river {i} " * (i % 40), 1) for i in range(300)] + [(1, None, 2), (None, "", 3), (1, "x " * 20000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(5)
    placed = order.materialise(docs, length=64, shard_size=100).cache()
    got = placed.collect()
    assert [r["slot"] for r in sorted(got, key=lambda r: r["slot"])] == list(range(len(got)))
    assert all(r["shard"] == r["slot"] // 100 and len(r["ids"]) == 128 for r in got)
    ids = [x for r in sorted(got, key=lambda r: r["number"]) for x in np.frombuffer(r["ids"], "<u2")[: r["n_tokens"]].tolist()]
    want = Encoder.of().encode(pa.array([r[1] for r in rows], pa.string()))[0].tolist()
    assert sorted(ids) == sorted(want)
    placed.unpersist()

    path = str(tmp_path / "shards")
    order.write_shards(order.materialise(docs, length=64, shard_size=100), path)
    by_slot = {r["slot"]: bytes(r["ids"]) for r in got}
    part = order.read_slots(spark, path, 90, 310, 64, 100).collect()
    assert [r["slot"] for r in part] == list(range(90, min(310, len(got))))
    sizes = {p.stat().st_size % 129 for p in (tmp_path / "shards").rglob("part-*.txt")}
    assert sizes == {0}
    assert all(len(r["ids"]) == 128 for r in part) and len(by_slot) == len(got)


def test_same_split_same_slots(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "repeat('river ', 30) AS text").coalesce(1)
    one, two = (order.materialise(docs, length=64, shard_size=10).collect() for _ in range(2))
    assert one == two


def test_empty(spark):
    assert order.materialise(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_writes_shards_that_a_reader_can_seek_in(spark, tmp_path, monkeypatch):
    rows = [(i, f"Stone and river {i} " * (i % 40)) for i in range(300)]
    folder = tmp_path / "shards"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "shared_folder", lambda _: str(folder), raising=False)
    monkeypatch.setattr(order.written, "__defaults__", (*order.written.__defaults__[:2], 64, 100))
    got = sorted(queries.op9_training_order(spark, str(tmp_path)).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in got] == list(range(len(got))) and len(got) > 200
    assert sorted(r["number"] for r in got) == list(range(len(got)))
    for r in got:
        (file,) = (folder / f"shard={r['shard']}").glob("part-*")
        with open(file, "rb") as f:
            f.seek(r["byte_offset"])
            assert f.read(128) == bytes(r["ids"])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = ["shard", "slot", "number", "n_tokens", "ids"]
    want = order.materialise(docs, length=64, shard_size=100).select(columns).collect()
    assert sorted(want, key=lambda r: r["slot"]) == [type(r)(**{c: r[c] for c in columns}) for r in got]
    assert order.written(docs.limit(0), str(tmp_path / "none")).collect() == []
