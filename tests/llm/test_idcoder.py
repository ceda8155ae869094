import random
import zlib

import numpy as np
import pytest

from tallyroom.llm import bytepieces, idcoder


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(idcoder.tokenizer_spec())


def order0(ids):
    return idcoder._Order0(*np.unique(ids, return_counts=True))


@pytest.mark.parametrize("n, block", [(1, 8), (7, 8), (8, 8), (9, 8), (5000, 64), (20_000, 4096), (300, 1)])
def test_blocks_come_back(n, block):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 1 << 16, n), rng.zipf(1.3, n) % 50_000, np.zeros(n, int), np.arange(n) % 3,
                np.where(rng.random(n) < 0.001, 65_535, 9)):
        ids = ids.astype(np.uint16)
        words = idcoder.encode_blocks(ids, order0(ids), block)
        assert len(words) == -(-n // block)
        sizes = np.array([len(w) for w in words])
        assert (idcoder.decode_blocks(np.concatenate(words), sizes, order0(ids), n, block) == ids).all()


def test_blocks_do_not_depend_on_each_other():
    ids = (np.random.default_rng(3).zipf(1.4, 4000) % 1000).astype(np.uint16)
    model = order0(ids)
    words = idcoder.encode_blocks(ids, model, 500)
    for k in (0, 3, 7):
        alone = idcoder.encode_blocks(ids[500 * k:500 * (k + 1)], model, 500)[0]
        assert (alone == words[k]).all()
        assert (idcoder.decode_blocks(words[k], np.array([len(words[k])]), model, 500, 500) == ids[500 * k:500 * (k + 1)]).all()


def test_repeats_are_learned():
    rng = np.random.default_rng(5)
    phrase = rng.integers(0, 50_000, 40)
    ids = np.tile(phrase, 100).astype(np.uint16)
    bits = 16 * sum(map(len, idcoder.encode_blocks(ids, order0(ids), 4000))) / len(ids)
    assert bits < 0.6  # a uniform code over the 40 ids takes 5.3


def test_damage_is_noticed():
    ids = (np.random.default_rng(4).zipf(1.3, 3000) % 5000).astype(np.uint16)
    data = idcoder.encode_segment([5, None, 7], [1000, 1500, 500], ids, 256)
    docs, sizes, back = idcoder.decode_segment(data)
    assert docs == [5, None, 7] and sizes.tolist() == [1000, 1500, 500] and (back == ids).all()
    for at in (2, 40, len(data) // 2, len(data) - 300):
        wrong = bytearray(data)
        wrong[at] ^= 1
        with pytest.raises(ValueError, match="checksum|not a segment"):
            idcoder.decode_segment(bytes(wrong))
    with pytest.raises(ValueError, match="65536"):
        bytepieces.checked([70_000])


POOL = ["the", "don't", "we'll", "'sx", " 's", "'re", "'rex", "'", "''s", "x'", "!'s", "'v", "'d'", "ñandú", "Größe", "12345", "x²", "½", "\n",
        "\n\n", "  ", "\t ", "   y", "...", "?!'re", "日本語", "\u00a0", "\u2003", "\x1c", "\x85", "🙂", "<|endoftext|>", "<|endo", "_a_",
        "ªº", "«q»", "¿Qué", "\r\n", "é\u0301", "×", "÷", "a" * 300, "\x7f", "Ω"]


@pytest.mark.parametrize("pieces", [1_000_000, 40])  # with a table that is soon full, too
def test_ids_are_the_librarys(library, pieces):
    rng = random.Random(1)
    coder = bytepieces.Encoder(idcoder.tokenizer_spec(), pieces)
    texts = []
    for _ in range(1500):
        pool = rng.sample(POOL, 8) + ["w", "la"]
        texts.append("".join(rng.choice(pool) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 30))))
    texts += ["", "'s", "a'", "'", " ", "s", "'t", "l", "'l", "l", "  ", "x", "\n"] * 3
    texts.append("long words " * 150_000)
    for few in (texts, texts[::-1]):
        got = coder.encode([np.frombuffer(t.encode(), np.uint8) for t in few])
        want = [x.ids for x in library.encode_batch(few, add_special_tokens=False)]
        for text, a, b in zip(few, got, want, strict=True):
            assert a.tolist() == b, text[:200]
    assert coder.encode([]) == []


def test_other_tokenizers_are_left_to_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, and more."
    got = bytepieces.Encoder(idcoder.tokenizer_spec(path)).encode([np.frombuffer(text.encode(), np.uint8)])[0]
    assert got.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def expected(library, rows):
    """(doc_id, start, n_tokens, crc) one document after the other; rows without doc_id last."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_the_library(make_docs, spark, library, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["la", "casa", "the", "tree", "ñu", "7", "über"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "a long one. " * 20_000), (-5, "negative"), (None, "no id"), (40, rows[40][1]), (1003, "日本 <|endoftext|> x")]
    rng.shuffle(rows)
    docs = make_docs(rows).repartition(5)
    for block, segment in ((4096, 1 << 23), (64, 1000)):
        path = str(tmp_path / f"ids-{block}")
        idcoder.write(docs, path, block_ids=block, segment_ids=segment)
        got = sorted(map(tuple, idcoder.read(spark, path).collect()), key=lambda r: r[1])
        assert got == expected(library, rows)
    back = {r.doc_id: r.ids for r in idcoder.tokens(spark, path).collect()}
    assert back[1002] == library.encode("a long one. " * 20_000, add_special_tokens=False).ids + [0]
    assert back[1000] == back[1001] == [0]
    assert sorted(map(tuple, idcoder.round_trip(docs).collect()), key=lambda r: r[1]) == expected(library, rows)
    assert idcoder.round_trip(make_docs([])).collect() == []


def test_a_piece_is_encoded_once_also_when_slots_collide():
    import numpy as np

    from tallyroom.llm.bytepieces import PieceTable

    table, handed = PieceTable(100), []

    def encode(places):
        handed.append(len(places))
        return [[int(p) % 7] * (1 + int(p) % 3) for p in places]

    h = np.arange(1, 61, dtype=np.uint64)  # all start at the table's first slot
    ids, sizes = table.ids(np.concatenate([h, h]), encode)
    assert handed == [60] and sizes.tolist() == [1 + p % 3 for p in range(60)] * 2
    assert ids.tolist() == [p % 7 for p in range(60) for _ in range(1 + p % 3)] * 2
    again, _ = table.ids(h[::-1].copy(), encode)
    assert handed == [60] and again.tolist() == [p % 7 for p in range(59, -1, -1) for _ in range(1 + p % 3)]


def test_a_segment_takes_few_steps_and_longer_blocks_are_still_read():
    ids = (np.random.default_rng(6).zipf(1.3, 9000) % 50_000).astype(np.uint16)
    assert sum(1 for _ in idcoder._steps(len(ids), idcoder.BLOCK_IDS)) <= 1024
    for block in (idcoder.BLOCK_IDS, 2048):
        assert (idcoder.decode_segment(idcoder.encode_segment([1], [9000], ids, block))[2] == ids).all()
