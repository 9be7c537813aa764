"""SentencePiece segmentation against a plain search, the library's lattice and round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from metricwin.llm.pieces import SPACE, PieceModel, decode, digests, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "the", "é", " ", "  ", "\n", "日", "😀", "qu", "\t", "ing", "information", "Ж", "\x00"]


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def best_score(model, library, text):
    """The best sum over all segmentations, position by position."""
    text = SPACE + text.replace(" ", SPACE)
    scores = {p: library.get_score(i) for i, p in enumerate(model.pieces) if i not in model.byte_of}
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            piece = text[start:end]
            if piece in scores and piece not in ("<unk>", "<s>", "</s>"):
                best[end] = max(best[end], best[start] + scores[piece])
        if text[end - 1] not in model.single:
            best[end] = max(best[end], best[end - 1] + model.lowest)
    return best[-1]


def score_of(model, library, ids):
    total, held = 0.0, 0
    for i in ids:
        if i in model.byte_of:
            held += 1
            # A character's bytes count once, at its first one.
            if model.byte_of[i] & 0xC0 != 0x80:
                total += model.lowest
        else:
            total += library.get_score(i)
    return total


def test_best_segmentation(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    random.seed(4)
    texts = ["".join(random.choices(BITS, k=random.randint(1, 14))) for _ in range(400)]
    for text in [*texts, "hello world", "   ", "unbelievable informationing"]:
        ids = model.encode(text).tolist()
        assert score_of(model, library, ids) == best_score(model, library, text), repr(text)
        assert model.decode(np.array(ids)) == text


def test_librarys_lattice_agrees():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    model = PieceModel(PATH)
    for text in ("the", "hello world", "information and thing", "a quick brown fox"):
        assert model.encode(text).tolist() == library.nbest_encode(text, nbest_size=2)[0]


def test_cuts_do_not_matter(model):
    random.seed(9)
    whole = PieceModel(PATH)
    whole.cuttable = False
    for _ in range(300):
        text = "".join(random.choices(BITS, k=random.randint(0, 30)))
        assert model.encode(text).tolist() == whole.encode(text).tolist()


def test_texts_that_share_cuts(model):
    random.seed(11)
    texts = ["".join(random.choices(BITS, k=random.randint(0, 20))) for _ in range(500)]
    texts += ["a b", " a", "a ", "a  b", "", None, f"a{SPACE}b", "the the the", "a\nb c"]
    many = model.encode_many(pa.array(texts))
    assert [x.tolist() for x in many] == [model.encode(t).tolist() for t in texts]
    assert model.encode_many(pa.array([], pa.string())) == []


def test_awkward_documents(awkward, no_docs, model):
    rows = [tuple(r)[:2] for r in awkward.collect()]
    want = []
    for doc_id, text in rows:
        ids = model.encode(text)
        want.append((doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), True))
    got = [tuple(r) for r in digests(awkward, PATH).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    back = [tuple(r) for r in decode(encode(awkward, PATH), PATH).collect()]
    assert sorted(back, key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert digests(no_docs, PATH).collect() == []


def test_the_table_comes_back(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert digests(docs, PATH).where("not round_trip").count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_models_with_rules_of_their_own(spark, tmp_path, rule, squeeze):
    """Models that map characters and squeeze spaces, SentencePiece's defaults, as the library does."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    spec = sentencepiece_model_pb2.NormalizerSpec()
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec.ParseFromString(normalizer.serialized_normalizer_spec())
    proto.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    proto.trainer_spec.model_type = 1
    path = str(tmp_path / "ruled.model")
    (tmp_path / "ruled.model").write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = PieceModel(path)
    texts = ["the  \uff28ello world ", "  \u2460 thing", "information\u3000and thing", "The QUICK brown fox"]
    compared = 0
    for text in texts:
        ready = library.normalize(text)
        assert model.normalised(text) == ready
        # The library's lattice takes characters without a piece, and runs of marks, by other scores.
        if model.single.issuperset(ready) and 2 * SPACE not in ready:
            compared += 1
            assert model.encode(text).tolist() == library.nbest_encode(text, nbest_size=2)[0], repr(text)
    assert compared >= (1 if rule == "identity" else 2)
    random.seed(12)
    texts += ["".join(random.choices(BITS, k=random.randint(0, 20))) for _ in range(200)] + ["   ", None]
    many = model.encode_many(pa.array(texts))
    assert [x.tolist() for x in many] == [model.encode(t).tolist() for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in digests(docs, path).collect()}
    assert all(r["round_trip"] for r in rows.values()) and rows[0]["n_ids"] == len(many[0])
