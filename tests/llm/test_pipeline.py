"""Each stage, and the whole pipeline, against plain Python."""

import random
import string

import duckdb
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from brute import EDGES, contaminated, deduped, documents, fingerprint, near, sha

import corpus_pipeline
from tallyhouse.llm import stages

SF_DIR = "/root/testdata/sf0.001"


def texts(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def benchmark():
    return duckdb.sql(f"select item_id, text from '{SF_DIR}/benchmark.parquet'").fetchall()


def test_whole_pipeline(spark, benchmark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    rows = [(i, t) for i, t in rows if any(map(str.isalpha, t or ""))]
    rows = [(i, kept) for i, _, _, kept in deduped(rows)]
    first = {i for i, _, component in near(rows) if i == component}
    rows = [(i, t) for i, t in rows if i in first]
    clean = {i for i, _, hit, _ in contaminated(rows, benchmark) if not hit}
    rows = [(i, t) for i, t in rows if i in clean]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: library.encode(t) for i, t in rows}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want) < 200
    assert all(r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == sha(",".join(map(str, r["ids"]))) for r in got)


def test_stages_keep_columns_and_stand_edges(spark):
    docs = documents(spark)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, SF_DIR).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == len(EDGES)


def test_language_stage_rejects_texts_without_letters(spark):
    left = texts(stages.known_language(spark, documents(spark), SF_DIR))
    assert left == sorted(((i, t) for i, t, _ in EDGES if any(map(str.isalpha, t or ""))), key=repr)


def test_language_stage_rejects_what_no_label_teaches(spark):
    rng = random.Random(3)
    words = lambda n: ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n)]
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
    junk = [finnish + "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.", polish, " ".join(words(300)), "".join(words(200))]
    clean = duckdb.sql("select doc_id, text, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    clean = [row for row in clean if any(map(str.isalpha, row[1] or ""))]
    planted = [*clean, *((10**9 + n, text, None) for n, text in enumerate(junk))]
    left = texts(stages.known_language(spark, documents(spark, planted), SF_DIR))
    assert left == sorted(((i, t) for i, t, _ in clean), key=repr)


def test_line_stage_changes_texts_and_their_length(spark):
    rows = stages.without_repeated_lines(spark, documents(spark), SF_DIR).collect()
    want = sorted(((i, kept) for i, _, _, kept in deduped([(i, t) for i, t, _ in EDGES])), key=repr)
    assert sorted(((r["doc_id"], r["text"] or "") for r in rows), key=repr) == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_group_stage_keeps_one_of_each(spark):
    rows = [(i, t) for i, t, _ in EDGES]
    left = texts(stages.one_of_each_group(spark, documents(spark), SF_DIR))
    component = {(i, t): c for (i, t), (_, _, c) in zip(rows, near(rows))}
    want = {(i, t) for (i, t), c in component.items() if c == i}
    assert set(left) == want and len(left) == len(want)


def test_group_stage_with_one_id_for_two_texts(spark):
    rows = [(1, "a text of its own here", "en"), (1, "quite another text of words", "en"), (2, "a third text, unlike", "en")]
    left = texts(stages.one_of_each_group(spark, documents(spark, rows), SF_DIR))
    assert [i for i, _ in left] == [1, 2]


def test_group_stage_keeps_one_text_of_a_group_without_id(spark):
    near_text = " ".join(f"word{n}" for n in range(400))
    group = {near_text, near_text + " end"}
    assert (fingerprint(near_text) ^ fingerprint(near_text + " end")).bit_count() <= 4
    rows = [*((None, t, "en") for t in [*group, *group, "quite another text of words", "a third text, unlike"]), (5, "with an id, its own", "en")]
    left = texts(stages.one_of_each_group(spark, documents(spark, rows), SF_DIR))
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64 if xxhash.xxh64_intdigest(t.encode(), 42) >> 63 else 0)
    want = [(None, min(group, key=signed)), (None, "quite another text of words"), (None, "a third text, unlike"), (5, "with an id, its own")]
    assert left == sorted(want, key=repr)


def test_benchmark_stage_drops_what_is_hit(spark, benchmark):
    planted = [(50, "Before. " + benchmark[0][1] + " After.", "en"), (51, "clean words only", "en"), (None, None, "en")]
    left = texts(stages.without_benchmark(spark, documents(spark, planted), SF_DIR))
    assert left == sorted([(51, "clean words only"), (None, None)], key=repr)


def test_benchmark_stage_decides_texts_with_one_id_or_none_by_themselves(spark, benchmark):
    hit, clean = "Before. " + benchmark[0][1] + " After.", [(None, "clean words only"), (None, "more of them"), (60, "clean too")]
    planted = [(None, hit, "en"), (60, hit, "en"), *((i, t, "en") for i, t in clean)]
    left = texts(stages.without_benchmark(spark, documents(spark, planted), SF_DIR))
    assert left == sorted(clean, key=repr)
