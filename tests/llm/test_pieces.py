"""SentencePiece ids and texts against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from odd_texts import odd_texts

from tabweave.llm import pieces, queries

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def some_texts():
    rng = random.Random(4)
    out = ["", " ", "  ", "   a", "a  ", "▁", "a▁b", "\x00a\x00", "日本語 한국어 🙂👍🏽", "<s> </s> <unk> <0x41>", "\n\n\t  x\r\n", "a" * 3000, "==--" * 50, "​﻿"]
    for _ in range(1500):
        alphabet = rng.choice(["abcde  \n▁éx", "aeinrst", "=-(); \t.*", "0123 ", "ab", "日本語の a", "퟿́é\U0001f642 x"])
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(60))))
    return out


def test_ids_and_texts_are_the_librarys(library, model):
    for t in some_texts():
        ids = library.encode(t)
        assert model.encode(t).tolist() == ids, t
        assert model.decode(ids) == library.decode(ids), t
    # The table of prefixes holds for texts that are not taken apart, too.
    for t in some_texts()[:300]:
        whole = "▁" + t.replace(" ", "▁")
        assert model.part_ids(whole) == (library.encode(t) if t else [model.ids["▁"]]), t


def test_any_ids_are_decoded_alike(library, model):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000), 0, 1, 2, 3 + 0xE3, 3 + 0x81, 29871]) for _ in range(rng.randrange(8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_each_prefix_has_the_last_token_of_its_own_encoding(library, model):
    part = "▁unbelievably▁internationalisation==1234"
    last = model.prefix_table(part)
    for n in range(2, len(part) + 1):
        assert last[n] == library.encode(part[1:n].replace("▁", " "))[-1]


def test_frames(spark, odd, odd_rows, no_docs, library):
    got = pieces.decode(pieces.encode(odd, MODEL, keys=("doc_id", "row")), MODEL)
    assert got.columns == ["doc_id", "row", "decoded"] and got.count() == len(odd_rows)
    ids = pieces.encode(odd, MODEL)
    want = sorted((str(r[0]), library.encode(r[1] or "")) for r in odd_rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in ids.collect()) == want
    assert pieces.encode(no_docs, MODEL).count() == 0 == pieces.decode(pieces.encode(no_docs, MODEL), MODEL).count()
    with pytest.raises(ValueError):
        pieces.Pieces(sentencepiece_model(add_dummy_prefix=True, model_type=1))


def sentencepiece_model(add_dummy_prefix, model_type):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = model_type
    proto.normalizer_spec.add_dummy_prefix = add_dummy_prefix
    return proto.SerializeToString()


def test_query(spark, library, tmp_path):
    texts = odd_texts()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_piece_ids(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got[i] == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))


def test_without_dummy_prefix():
    plain = sentencepiece_model(add_dummy_prefix=False, model_type=2)
    own, library = pieces.Pieces(plain), sentencepiece.SentencePieceProcessor(model_proto=plain)
    for t in some_texts()[:400]:
        assert own.encode(t).tolist() == library.encode(t)
        assert own.decode(own.encode(t).tolist()) == library.decode(library.encode(t)), t
