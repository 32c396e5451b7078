"""Offset-preserving pieces against the library itself: ids, spans, normalised text, decoded text."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tracklake.llm import pieces

PATH = pieces.tokenizer_path("piece_bpe_32k.model")
ALPHABET = " ▁\t\nabcdefgHello wörld日本語　ｶﾞ①ﬁé́­​\x00\U0001f600 <s></s><0x41>0123"
TEXTS = ["", " ", "  ", "a", "Hello  wörld ▁x 日本　語\n", "<s>é\x00</s><0x0A>", "\U0001f600\U0001f601 x", " ▁ ", "ﬁ　ｶﾞ①", "é a­b​"]


def texts(n, seed):
    rng = random.Random(seed)
    return TEXTS + ["".join(rng.choices(ALPHABET, k=rng.randrange(40))) for _ in range(n)]


def changed(model, **spec):
    """The model with another normaliser, and the library's own view of it."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.treat_whitespace_as_suffix = spec.pop("suffix", False)
    fallback = spec.pop("fallback", True)
    if not fallback:
        proto.trainer_spec.byte_fallback = False
        for p in proto.pieces:
            if p.type == pieces.BYTE:
                p.piece, p.type = f"§{p.piece}", 1
    for symbol in spec.pop("symbols", []):
        new = proto.pieces.add()
        new.piece, new.score, new.type = symbol, 0.0, pieces.USER_DEFINED
    for name, value in spec.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


def compiled(rule):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    return proto.normalizer_spec.precompiled_charsmap


@pytest.mark.parametrize("spec", [
    {}, {"add_dummy_prefix": False}, {"remove_extra_whitespaces": True}, {"remove_extra_whitespaces": True, "suffix": True},
    {"precompiled_charsmap": "nmt_nfkc"}, {"precompiled_charsmap": "nfkc", "remove_extra_whitespaces": True},
    {"precompiled_charsmap": "nmt_nfkc_cf", "remove_extra_whitespaces": True, "symbols": ["aﬁ", "ab c", "b①"]}, {"fallback": False},
])
def test_pieces_and_spans_are_the_librarys(spec):
    spec = dict(spec)
    if rule := spec.get("precompiled_charsmap"):
        spec["precompiled_charsmap"] = compiled(rule)
    model = changed(pieces.model_bytes(PATH), **spec)
    library, coder = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.PieceEncoder(model)
    given = texts(1500, 4)
    for text, (ids, begins, ends) in zip(given, coder.encode(given, end=False), strict=True):
        want = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want], text
        size = text.encode()
        surface = [text[p.begin : p.end] for p in want]
        spans = [(len(text[: p.begin].encode()), len(text[: p.end].encode())) for p in want]
        got = list(zip(begins.tolist(), ends.tolist(), strict=True))
        assert got in (spans, [(p.begin, p.end) for p in want]), (text, surface, size)


def test_compiled_maps_take_the_longest_prefix():
    mapping = pieces.character_map(compiled("nmt_nfkc"))
    assert mapping["ｶﾞ"] == "ガ" and mapping["ｶ"] == "カ" and mapping["　"] == " "
    normalize = pieces.Normalizer(mapping, [], True, False, True, True)
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    for text in texts(500, 5):
        new, source = normalize(text)
        assert len(source) == len(new) + 1
        assert (np.diff(source) >= 0).all()
    assert normalize("ｶﾞ①")[1].tolist() == [0, 0, 6, 9]
    assert library.normalize("ｶﾞ①") in (normalize("ｶﾞ①")[0], normalize("ｶﾞ①")[0].replace(pieces.SPACE, " ").strip(), normalize("ｶﾞ①")[0][1:])


def test_query_rows_equal_the_library(spark):
    rng = random.Random(1)
    given = [*texts(200, 6), None, " ".join(f"wort{rng.randrange(10**6)}" for _ in range(30_000))]
    rows = [(None if i == 3 else i // 2, t, 0, "x") for i, t in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, TEXT string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = pieces.decode(spark, pieces.encode(spark, docs, PATH), PATH).collect()
    want = [(i, [*library.encode(t or ""), library.eos_id()]) for i, t, *_ in rows]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["doc_id"], r["ids"]) for r in got], key=order) == sorted(want, key=order)
    assert all(r["text"] == library.decode(r["ids"]) for r in got)
    assert pieces.encode(spark, docs.limit(0), PATH).count() == 0


def test_query_digests(spark, tmp_path):
    rows = [(1, "Hello wörld"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in pieces.op11_pieces(spark, str(tmp_path)).collect():
        ids = [*library.encode(dict(rows)[r["doc_id"]] or ""), 2]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
