import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from brute import EDGES, documents, sha
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm.pieces import codec, encode_decode
from tallyhouse.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    own = codec(MODEL)
    assert own.encode(text) == library.encode(text)
    assert own.decode(own.encode(text)) == library.decode(library.encode(text))


def test_texts_made_of_pieces_and_spaces():
    own, rng = codec(MODEL), random.Random(3)
    pieces = [*own.ids, " ", "  ", "▁", "\n", "².", "m²."]
    for _ in range(5000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 9)))
        assert own.encode(text) == library.encode(text), text


def test_pairs_by_merging_them():
    own, rng = codec(MODEL), random.Random(4)
    whole = [i for i in own.text if i in own.halves]
    for _ in range(3000):
        a, b = rng.choices(whole, k=2)
        merged = own.merged(own.text[a] + own.text[b])[0]
        assert own.compatible(a, b) == (merged == [own.text[a], own.text[b]])


def test_what_is_remembered_does_not_matter():
    own = codec(MODEL)
    texts = [text for _, text, _ in EDGES]
    before = [own.encode(t) for t in texts]
    own.known.clear()
    own.pairs.clear()
    assert [own.encode(t) for t in texts] == before


def test_edges(spark):
    rows = documents(spark).select("text", encode_decode(F.col("text"), MODEL).alias("coded")).select("text", "coded.*").collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        ids = library.encode(row["text"] or "")
        assert (row["ids"], row["decoded"]) == (ids, library.decode(ids) if ids else "")
    assert documents(spark, []).select(encode_decode(F.col("text"), MODEL)).count() == 0


def test_query_over_documents(spark):
    texts = dict(duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    rows = QUERIES["op5_sentencepiece"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]])
        want = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == want


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as model_format

    model = model_format.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    model.normalizer_spec.remove_extra_whitespaces = True
    other = tmp_path / "other.model"
    other.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        codec(str(other))
