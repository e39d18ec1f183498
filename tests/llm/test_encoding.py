"""SentencePiece encoding against the library, spans, and the compiled character map."""

from __future__ import annotations

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from cohortspark.llm.pieces_encoding import Encoder, _fields, _length_delimited, encode_documents  # noqa: E402

TEXTS = [
    None, "", " ", "  two  blanks ", "plain words", "tab\tand\nline", "日本 語 😀 ¥", "▁marks ▁▁ x", "é é ﬁ ½", "\x00\x01", "a" * 3000,
    "ｱ　ＡＢ①  x ", "   ", "ends with blank ", "﻿​ x", "Ⅷ ㍿ ﷺ",
]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("piece_bpe_32k.model")


def with_map(model: bytes, rule: str, **flags) -> bytes:
    """The model with another compiled character map, as the library builds it."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule, **flags).serialized_normalizer_spec()
    return b"".join(w for n, _, w in _fields(model) if n != 3) + _length_delimited(3, spec)


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nfkc_cf"])
def test_ids_and_spans(path, rule):
    model = open(path, "rb").read()
    model = with_map(model, rule) if rule else model
    library, encoder = sentencepiece.SentencePieceProcessor(model_proto=model), Encoder(model)
    for text in TEXTS:
        ids, begin, end = encoder.encode(text)
        assert ids.tolist() == library.encode(text or "", add_eos=True)
        assert encoder.decode(ids) == library.decode(ids.tolist())
        raw = (text or "").encode()
        assert all(0 <= a <= b <= len(raw) for a, b in zip(begin, end, strict=True))
        assert (begin[1:] >= begin[:-1]).all()
        # the end id stands behind the text; spans leave out only what the normaliser drops
        assert begin[-1] == end[-1] == len(raw)
        if rule is None and raw:
            assert b"".join(raw[a:b] for a, b in zip(begin, end, strict=True)) == raw


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_and_alignment(path, rule):
    model = with_map(open(path, "rb").read(), rule)
    library = sentencepiece.SentencePieceNormalizer(model_proto=model)
    encoder = Encoder(model)
    for text in filter(None, TEXTS):
        if "\x00" in text:
            continue
        want, offsets = library.normalize(text, with_offsets=True)
        got, origin = encoder.normalise(text)
        assert got == want
        if got:
            raw, place, starts = text.encode(), 0, []
            for c in got:
                starts.append(len(raw[: origin[place]].decode()))
                place += len(c.encode())
            assert starts == offsets[: len(starts)]


def test_rows_and_columns(documents, path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, "plain words")] * 2
    docs = documents(rows, extra=True)
    out = encode_documents(docs, path, fields=("n_tokens", "ids", "begins", "ends", "decoded", "id_text", "covered"))
    assert out.count() == len(rows)
    assert "n_bytes" in out.columns and out.columns.count("ids") == 1
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in out.collect():
        want = library.encode(r["text"] or "", add_eos=True)
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["id_text"] == " ".join(map(str, want))
        assert r["decoded"] == library.decode(want)
        assert r["covered"] == len((r["text"] or "").encode())
    assert encode_documents(documents([]), path).count() == 0
