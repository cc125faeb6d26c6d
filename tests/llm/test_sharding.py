import zlib

import pytest

from tillmarts.llm import sharding as S


def test_places(documents, awkward_rows):
    got = S.place(documents(awkward_rows, extra=True), [1.0] * 8).collect()
    assert len(got) == len(awkward_rows)
    want = sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in awkward_rows)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"key"}
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    by_key = {}
    for r in got:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 8)


def test_empty_table(documents):
    assert S.place(documents([]), [1.0] * 8).count() == 0


def test_slots_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_ROWS", 50)
    df = spark.range(1000).selectExpr("id", "CAST(id % 3 AS INT) AS shard")
    got = S.slots(df, "shard", ["id"]).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shares_follow_weights_and_few_rows_move(spark):
    df = spark.range(20_000)
    placed = df.select(
        S.rendezvous(df.id, [1, 2, 1]).alias("before"), S.rendezvous(df.id, [1, 2, 1, 1]).alias("after")
    ).collect()
    shares = [sum(r.before == s for r in placed) / 20_000 for s in range(3)]
    assert shares == pytest.approx([0.25, 0.5, 0.25], abs=0.015)
    assert all(r.after in (r.before, 3) for r in placed)
    assert sum(r.after == 3 for r in placed) / 20_000 == pytest.approx(0.2, abs=0.015)


def test_a_shard_without_weight_gets_nothing(spark):
    df = spark.range(500)
    assert {r[0] for r in df.select(S.rendezvous(df.id, [0, 1, 1])).collect()} == {1, 2}
    with pytest.raises(ValueError):
        S.rendezvous(df.id, [0, 0])


def test_files(spark, documents, awkward_rows, tmp_path):
    docs = documents(awkward_rows)
    S.write_shards(docs, [1.0] * 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(awkward_rows) and set(docs.columns) <= set(back.columns)
