import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from tallyroom.llm import pieces

TEXTS = ["", " ", "a", "a ", " a", "  a  b ", "hello world", "a\n\nb\tc", "▁x▁ y", "日本語テキスト" * 9, "😀é" * 20, "the" * 120,
         "0x" + "deadbeef" * 60, "internationalization " * 20, " guard ", "<s> </s> <unk> <0x41>"]


@pytest.fixture(scope="module")
def bpe():
    return pieces.load_model()


@pytest.fixture(scope="module")
def unigram():
    """A small unigram model written by hand: pieces and scores, nothing trained."""
    model = pb.ModelProto()
    model.trainer_spec.model_type = 1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = True
    rng = random.Random(2)
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        model.pieces.add(piece=piece, score=0.0, type=kind)
    seen = set()
    for letter in "▁abcde":
        seen.add(letter)
    while len(seen) < 90:
        seen.add(rng.choice(["", "▁"]) + "".join(rng.choices("abcde", k=rng.randint(1, 5))))
    for piece in sorted(seen):
        model.pieces.add(piece=piece, score=-rng.uniform(1, 9) - len(piece), type=1)
    return pieces.Pieces(model.SerializeToString())


def scanned(model, text, size):
    chunks = [pieces.Chunk(model, *rest) for _, *rest in pieces.chunks_of(text, size, model.longest)]
    matrices = [c.transfer() for c in chunks]
    states = pieces.route(matrices)
    total = matrices[0]
    for m in matrices[1:]:
        total = pieces.product(total, m)
    best = max(w for x, y, w in total if x == (0, ""))
    assert any(x == (0, "") and y == states[-1] and w == best for x, y, w in total)
    return [i for c, a, b in zip(chunks, states, states[1:]) for i in c.encode(a, b)]


@pytest.mark.parametrize("size", [1, 2, 7, 33, 200])
def test_scan_gives_the_models_own_pieces(bpe, size):
    for text in TEXTS[1:]:
        assert scanned(bpe, text[:300], size) == bpe.library.encode(text[:300]), text


def test_unigram_scan_reaches_the_best_score(unigram):
    rng = random.Random(4)
    for _ in range(40):
        text = "".join(rng.choices("abcde  ", k=rng.randint(1, 120)))
        want = unigram.library.encode(text)
        for size in (1, 5, 40):
            got = scanned(unigram, text, size)
            assert sum(map(unigram.library.get_score, got)) == pytest.approx(sum(map(unigram.library.get_score, want)), abs=1e-3)
            assert unigram.library.decode(got) == text


def test_whole_texts(bpe):
    assert bpe.encode_texts([*TEXTS, None]).to_pylist() == [*map(bpe.library.encode, TEXTS), None]


def test_query_on_small_chunks(make_docs, bpe):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(90, None), (0, TEXTS[0]), (7, TEXTS[7]), (None, "no id"), (91, "word " * 3000)]
    for chunk in (16, pieces.CHUNK):  # giant documents from 16 characters on, and none
        got = pieces.tokenised(make_docs(rows), bpe, ["doc_id", "text", "ids"][:2], chunk).collect()
        assert len(got) == len(rows)
        for r in got:
            want = None if r.text is None else bpe.library.encode(r.text)
            assert r.ids == want and r.n_tokens == (None if want is None else len(want))
        trip = pieces.round_trip(make_docs(rows), bpe, chunk).collect()
        assert len(trip) == len(rows) and all(r.exact in (True, None) for r in trip)
    assert pieces.round_trip(make_docs([]), bpe).collect() == []


def test_a_lost_task_starts_from_the_models_bytes(bpe):
    import pickle

    again = pickle.loads(pickle.dumps(bpe))
    assert again.library.encode("a b") == bpe.library.encode("a b")
    assert isinstance(again.library, sentencepiece.SentencePieceProcessor)


def test_a_full_table_keeps_what_it_has(bpe, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 8)
    model = pieces.Pieces(bpe.proto)
    handed = []
    fresh = model._fresh
    monkeypatch.setattr(model, "_fresh", lambda b, starts, stops: handed.append(len(starts)) or fresh(b, starts, stops))
    for n in range(6):
        texts = ["common words come again", f"rare{n} other{n}", "common words", None]
        assert model.encode_texts(texts).to_pylist() == [*map(bpe.library.encode, texts[:3]), None]
    assert handed == [6, 2, 2, 2, 2, 2]  # the words met first are never encoded again


def test_columns_of_any_cut(bpe):
    import pyarrow as pa

    texts = pa.array([*TEXTS, None, *TEXTS[::-1]])
    for part in (texts, texts.slice(3, 9), texts.slice(len(TEXTS) - 1, 4), texts.slice(2, 0)):
        ids = bpe.encode_column(part)
        assert ids.to_pylist() == [None if t is None else bpe.library.encode(t) for t in part.to_pylist()]
        assert bpe.decode_column(ids.slice(1)) == [None if x is None else bpe.library.decode(x) for x in ids.to_pylist()[1:]]
