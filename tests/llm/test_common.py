"""Worker caches and the token memo."""
import pyarrow as pa

from bitext.llm import _common
from bitext.llm._common import BATCH_BYTES, map_rows
from bitext.llm.token_files import Memo


def test_another_operator_drops_the_cache():
    kept = dict(_common.worker_cache())
    try:
        _common.claim_worker("a")
        _common.worker_cache()["memo"] = [1]
        _common.claim_worker("a")
        assert _common.worker_cache()["memo"] == [1]
        _common.claim_worker("b")
        assert "memo" not in _common.worker_cache()
    finally:
        _common.worker_cache().clear()
        _common.worker_cache().update(kept)


def test_memo_is_bounded_and_keeps_what_is_used():
    memo = Memo(20)
    for i in range(1000):
        assert memo.find("used") in (None, b"u")
        memo.keep("used", b"u")
        memo.keep(str(i), b"x")
        assert len(memo.young) + len(memo.old) <= 20
    assert memo.find("used") == b"u" and memo.find("3") is None
    memo.keep("x" * 65, b"")
    assert memo.find("x" * 65) is None


def test_batches_of_whole_texts_are_bounded(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": pa.array([batch.nbytes], pa.int64())})

    table = spark.range(0, 9_000, 1, 1).selectExpr("id", "repeat('word ', 400) AS text")
    assert map_rows(table, ["id"], "id long", lambda: lambda ids: iter([{"id": ids}])).count() == 9_000
    found = [r.size for r in table.mapInArrow(sizes, "size long").collect()]
    assert max(found) < 2 * BATCH_BYTES < sum(found)
