import random

import pytest
from brute import EDGES, deduped, documents

from tallyhouse.llm.lines import dedup_lines


def rows_of(result):
    return sorted(
        ((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"] or "") for r in
         result.select("doc_id", "deduped.*").collect()), key=repr,
    )


def test_edges(spark):
    docs = documents(spark)
    result = dedup_lines(docs)
    assert set(result.columns) == set(docs.columns)
    assert rows_of(result) == sorted(deduped([(i, t) for i, t, _ in EDGES]), key=repr)


@pytest.mark.parametrize("bits", [1 << 20, 1 << 8])
def test_random_texts_even_with_a_filter_that_is_too_small(spark, bits):
    rng = random.Random(bits)
    lines = ["".join(rng.choice("abC ") for _ in range(rng.randint(0, 6))) for _ in range(120)]
    rows = [(rng.randint(0, 60), "\n".join(rng.choices(lines, k=rng.randint(1, 12))), "en") for _ in range(300)]
    result = dedup_lines(documents(spark, rows).repartition(7), min_chars=3, repeat_bits=bits)
    assert rows_of(result) == sorted(deduped([(i, t) for i, t, _ in rows], min_chars=3), key=repr)


def test_a_null_text_stays_null_and_no_documents_are_none(spark):
    kept = dedup_lines(documents(spark)).where("text is null").select("deduped.kept").collect()
    assert [row["kept"] for row in kept] == [None, None]
    assert dedup_lines(documents(spark, [])).count() == 0
