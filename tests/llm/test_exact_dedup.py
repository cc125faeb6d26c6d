import hashlib
import re
import uuid
from collections import defaultdict

import pytest

from tillmarts.llm import exact_dedup as E
from tillmarts.llm.common import LOWERED


@pytest.fixture
def index(spark):
    name = f"index_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def brute(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[hashlib.sha256((text or "").translate(LOWERED).encode()).hexdigest()].append(i)
    out = []
    for i, text, *_ in rows:
        digest = hashlib.sha256((text or "").translate(LOWERED).encode()).hexdigest()
        ids = groups[digest]
        keep = max((k for k in ids if k is not None), default=None)
        out.append((i, keep, len(ids), i == keep, digest))
    return out


def test_fates(spark, rows, documents, awkward_rows, index):
    got = E.dedup(spark, documents(awkward_rows, extra=True), index)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows(got) == rows(spark.createDataFrame(brute(awkward_rows), got.schema))


def test_empty_table(spark, documents, index):
    assert E.dedup(spark, documents([]), index).count() == 0
    assert spark.table(index).count() == 0


def test_later_batches_meet_the_index(spark, documents, index):
    assert not E.index_exists(spark, index)
    E.dedup(spark, documents([(1, "a", "", ""), (2, "A", "", ""), (3, "b", "", "")]), index)
    second = E.dedup(spark, documents([(9, "B", "", ""), (10, "c", "", ""), (11, "c", "", "")]), index)
    fates = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in second.collect()}
    assert fates == {9: (3, False, 1), 10: (11, False, 2), 11: (11, True, 2)}
    assert sorted(r.keep_id for r in spark.table(index).collect()) == [2, 3, 11]
    assert E.index_exists(spark, index)


def fates_of(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_a_repeated_batch_has_the_same_fates_and_adds_nothing(spark, documents, index):
    docs = documents([(1, "a", "", ""), (2, "b", "", ""), (3, "B", "", "")])
    first = fates_of(E.dedup(spark, docs, index))
    again = fates_of(E.dedup(spark, docs.repartition(1), index))
    assert first == again == [(1, 1, 1, True), (2, 3, 2, False), (3, 3, 2, True)]
    assert spark.table(index).count() == 2
    assert E.drop_duplicates(spark, docs, index).count() == 2


@pytest.mark.parametrize("after", ["before", "part", "all"])
def test_a_batch_that_failed_is_repeated(spark, documents, index, monkeypatch, after):
    """The append fails before, amid or after writing; the repeated batch and later ones see no difference."""
    E.dedup(spark, documents([(1, "old", "", "")]), index)
    docs = documents([(2, "a", "", ""), (3, "OLD", "", ""), (4, "b", "", ""), (5, "A", "", "")])
    whole = E.append

    def fails(spark, index, fresh, batch=""):
        if after != "before":
            whole(spark, index, fresh if after == "all" else fresh.limit(1), batch)
        raise OSError("lost")

    monkeypatch.setattr(E, "append", fails)
    with pytest.raises(OSError):
        E.dedup(spark, docs, index, batch_id="monday")
    monkeypatch.setattr(E, "append", whole)
    want = [(2, 5, 2, False), (3, 1, 1, False), (4, 4, 1, True), (5, 5, 2, True)]
    assert fates_of(E.dedup(spark, docs, index, batch_id="monday")) == want
    assert spark.table(index).count() == 3
    assert fates_of(E.dedup(spark, docs, index, batch_id="tuesday")) == [(i, k, n, False) for i, k, n, _ in want]


def test_batches_in_turn(spark, rows, documents, awkward_rows, index):
    late = [r for r in awkward_rows if r[0] is not None and r[0] > 4]
    early = [r for r in awkward_rows if r not in late]
    got = E.dedup_in_batches(spark, [documents(late, extra=True), documents(early, extra=True)], index)
    assert rows(got) == rows(spark.createDataFrame(brute(awkward_rows), got.schema))


def test_other_numbers_of_buckets_and_compaction(spark, documents, index):
    E.create_index(spark, index, buckets=4)
    for i in range(3):
        E.drop_duplicates(spark, documents([(i, f"t{i}", "", ""), (10 + i, "same", "", "")]), index)
    assert E.buckets_of(spark, index) == 4 and spark.table(index).count() == 4
    before = sorted(map(tuple, spark.table(index).collect()))
    E.compact(spark, index)
    assert sorted(map(tuple, spark.table(index).collect())) == before
    files = spark.table(index).inputFiles()
    assert len(files) == len({f.rsplit("_", 1)[1].split(".")[0] for f in files}) <= 4
    E.compact(spark, index, buckets=2)
    assert E.buckets_of(spark, index) == 2 and E.dedup(spark, documents([(9, "SAME", "", "")]), index).first().keep_id == 10


def test_rows_that_stay_are_whole(spark, rows, documents, awkward_rows, index):
    docs = documents(awkward_rows, extra=True)
    kept = E.drop_duplicates(spark, docs, index)
    assert kept.columns == docs.columns
    want = {(k, d) for i, k, _, stays, d in brute(awkward_rows) if stays}
    assert kept.count() == len(want)
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in want}


def test_anti_join_reads_the_index_by_bucket(spark, documents, index):
    """Sort-merge, with no exchange over the index."""
    E.dedup(spark, documents([(1, "a", "", "")]), index)
    groups = spark.createDataFrame([("d", 1, 1)], "digest string, keep_id long, group_size long")
    plan = E.new_digests(spark, index, groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1, plan


def test_a_compacted_index_is_not_sorted_again(spark, documents, index):
    E.create_index(spark, index, buckets=2)
    for i in range(3):
        E.dedup(spark, documents([(i, f"{i} {j}", "", "") for j in range(9)]), index)
    groups = spark.createDataFrame([("d", 1, 1)], "digest string, keep_id long, group_size long")

    def sorts():
        with E._stored_order(spark):
            plan = E.new_digests(spark, index, groups)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange") == 1, plan
        return len(re.findall(r"\bSort \[", plan))

    assert sorts() == 2
    E.compact(spark, index)
    assert sorts() == 1
