import random

import numpy as np
import public_tokenizers
import pytest

from fieldglass.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b\n c ", "Ünïcode", "▁x", "日本語 text", "\U0001f600\U00010348", "a" * 3000, "x\ty", "</s><s><unk><0x41>"]


def brute(own, text):
    """All cuts, by the positions from the left."""
    best = [(0.0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 60), end):
            piece = own.pieces.get(text[start:end])
            if best[start] is None or not piece and (end - start > 1):
                continue
            ids, score = ([piece[0]], piece[1]) if piece else ([own.bytes[b] for b in text[start:end].encode()], own.unknown_score)
            total = best[start][0] + score
            if best[end] is None or total > best[end][0]:
                best[end] = (total, best[start][1] + ids)
    return best[-1][1]


def test_best_paths_are_those_of_brute_force_over_whole_texts():
    own = S.model(PATH)
    rng = random.Random(3)
    made = ["".join(rng.choice("abest ntio  \nhé√") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    for text in [x or "" for x in ODD if x is None or len(x) < 100] + made:
        ids, at = own.encode([text])
        assert ids.tolist() == (brute(own, S.SPACE + text.replace(" ", S.SPACE)) if text else []), repr(text)


def test_same_as_the_library_with_these_pieces_and_scores():
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    rng = random.Random(5)
    words = ["the", "encoding", "Tion", "was", "schtz", "quelle", "of", "worthless.", "and", "isn't", "naïve"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(50)]
    ids, at = S.model(PATH).encode(texts)
    # Its search for several paths; that for one adds up scores as single floats from the lowest score, 1e9 here.
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library.nbest_encode_as_ids(x, 2)[0] for x in texts]


def test_round_trip_of_odd_texts_copies_and_clashing_columns(spark, documents):
    from pyspark.sql import functions as F

    texts = [*ODD, *["same copy"] * 3]
    docs = documents(texts).withColumn("ids", F.lit("old")).withColumn("decoded", F.lit(1))
    got = S.decode(S.encode(docs, PATH), PATH).orderBy("doc_id").collect()
    assert [r["decoded"] for r in got] == [(x or "").replace(S.SPACE, " ") for x in texts]
    assert got[0]["source"] == "src0" and len({tuple(r["ids"]) for r in got[-3:]}) == 1
    assert all(r["round_trip"] for r in S.checked(documents(texts), PATH).collect())
    assert S.checked(documents([]), PATH).count() == 0


def test_broken_bytes_and_null_ids():
    own = S.model(PATH)
    assert own.decode(np.array([own.bytes[0xC3]])) == "�"
    assert own.decode(np.array([], np.int64)) == ""
