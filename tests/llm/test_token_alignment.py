"""Alignment of two tokenizers against byte-by-byte brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tracklake.llm import token_alignment as ta
from tracklake.llm.pieces import model_bytes, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ALPHABET = "  \t\nabcdefgHello wörld日本語ｶﾞ①ﬁé\x00\U0001f600<s><|endoftext|><0x41>0123▁"


def rows():
    rng = random.Random(1)
    texts = ["", None, " ", "a", "plain words and more words", "<|endoftext|></s>", "a▁b", "日本語\U0001f600", "the " * 3000]
    texts += ["".join(rng.choices(ALPHABET[:-1], k=rng.randrange(60))) for _ in range(150)]
    return [(None if i == 4 else i // 2, t) for i, t in enumerate(texts)]


def brute(given):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = ta._byte_alphabet()
    out, links = [], Counter()
    for i, text in given:
        want = b" " + (text or "").encode()
        ids = [a.encode(f" {text or ''}", add_special_tokens=False).ids, b.encode(text or "")]
        parts = [[bytes(alphabet[c] for c in a.id_to_token(x)) for x in ids[0]], []]
        for x in ids[1]:
            p = b.id_to_piece(x)
            parts[1].append(bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode())
        if not text or any(b"".join(p) != want for p in parts):
            out.append((i, [], [], [], ""))
            continue
        owner = [[k for k, p in enumerate(ps) for _ in p] for ps in parts]
        pairs = sorted({(x, y) for x, y in zip(*owner, strict=True)})
        mine = [(ids[0][x], ids[1][y]) for x, y in pairs]
        links.update(mine)
        ends = [set(np.cumsum([len(p) for p in ps]).tolist()) for ps in parts]
        groups, start = [], 0
        for end in sorted(ends[0] & ends[1]):
            groups.append("|".join(",".join(str(ids[s][k]) for k in sorted(set(owner[s][start:end]))) for s in (0, 1)))
            start = end
        out.append((i, *ids, mine, ";".join(groups)))
    most = {}
    for (x, y), n in links.items():
        most[y] = max(most.get(y, 0), n)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    return [
        (i, len(x), len(y), g.count(";") + 1 if g else 0, len(m), sum(links[p] == most[p[1]] for p in m), sum(links[p] for p in m), sha(g))
        for i, x, y, m, g in out
    ]


@pytest.mark.parametrize("limit", [ta.BROADCAST_PAIRS, 3])
def test_alignment_equals_brute_force(spark, limit, monkeypatch):
    monkeypatch.setattr(ta, "TASK_PAIRS", 50)
    given = rows()
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in given], "doc_id long, text string, ids_a int, TEXT string, row int").repartition(3)
    got = ta.align(spark, docs, A, B, broadcast_pairs=limit)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(given), key=str)
    assert ta.align(spark, docs.limit(0), A, B, broadcast_pairs=limit).count() == 0


def test_gallop_finds_ranks_from_any_guess():
    rng = np.random.default_rng(3)
    for _ in range(200):
        longer = np.unique(rng.integers(0, 300, rng.integers(1, 80)))
        driver = np.unique(rng.integers(0, 300, rng.integers(1, 40)))
        rank, shared = ta.gallop(driver, longer, rng.integers(-5, 200, len(driver)))
        assert (rank == np.searchsorted(longer, driver)).all()
        assert shared.tolist() == np.isin(driver, longer).tolist()


def test_byte_ranks_segment_like_the_file_s_own_library():
    models = ta.Tokenizers(model_bytes(A), model_bytes(B))
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for shape in (" a%sb", " 1%s %s\n"):  # every code point between letters, digits and blanks
        texts = ["".join(shape.replace("%s", c) for c in points[i : i + 64]) for i in range(0, len(points), 64)]
        assert models.encode_a(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    changed = model_bytes(A).replace(b'"add_prefix_space":false', b'"add_prefix_space":true').replace(b'"add_prefix_space": false', b'"add_prefix_space": true')
    other = ta.byte_level_encoder(changed, models.bytes_a)
    assert other(["ab"]) == models.encode_a([" ab"]) != models.encode_a(["ab"])


def test_token_bytes_cover_both_vocabularies():
    models = ta.Tokenizers(model_bytes(A), model_bytes(B))
    assert len(models.words) == 2 * len(models.bytes_a) + 2 * len(models.bytes_b)
    assert (models.size_a > 0).sum() >= 50256 and models.bytes_b[3] == b"\x00"
