"""Near-duplicate removal decides on rows without doc_id one by one."""

import corpus_pipeline


def test_copies_without_id_go_although_another_row_without_id_stays(spark):
    first = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, first), (None, ""), (None, first), (None, first.upper()), (None, None),
        (None, "a text of its own without any id"), (None, "a text of its own without any id"),
        (2, "another text that nobody else has written"), (2, first),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[i] for i in (0, 1, 4, 5, 7)], key=str)
