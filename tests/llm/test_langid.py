import random
import zlib

import numpy as np

from tallyroom.llm import langid


def corpus(n):
    rng = random.Random(2)
    parts = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["sch", "ung", "keit", "ver"], "cc": ["ção", "que", "ñ", "llo"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 40))), lang))
    return rows


def test_held_out_accuracy(make_docs):
    rows = corpus(400)
    docs = make_docs(rows)
    got = {r.doc_id: r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if got[i].held_out]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_backoff_against_its_definition(make_docs):
    docs = make_docs(corpus(120))
    model = langid.train(docs, words=20, grams=30)
    known = next(iter(model.tables[0]))
    assert np.allclose(model.word(known), model.tables[0][known])
    for word in ("kalomita", "schung", "zzz", "q"):
        if word in model.tables[0]:
            continue
        want = np.zeros(len(model.languages))
        for n in range(langid.LONGEST, 0, -1):
            rows = [model.tables[n][g] for g in langid.grams_of(word, n) if g in model.tables[n]]
            if rows:
                want = np.mean(rows, axis=0)
                break
        assert np.allclose(model.word(word), want)


def test_held_out_documents_are_not_read(make_docs):
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = make_docs([(i, "secret words", "xx") for i in held] + [(i, "kalo mita", "aa") for i in range(300) if i not in held])
    assert langid.train(docs).languages == ["aa"]


def test_edges(make_docs):
    docs = make_docs(corpus(60) + [(900, None, "aa"), (901, "", "aa"), (902, "12 %%", None), (902, "12 %%", None), (None, "kalo", "aa"), (903, "ka " * 900_000, None)])
    got = langid.predict(docs, langid.train(docs)).where("doc_id >= 900 OR doc_id IS NULL").collect()
    said = sorted((str(r.doc_id), r.lang_pred, r.score) for r in got)
    assert [s for s in said if s[1] == "und"] == [("900", "und", 0.0), ("901", "und", 0.0), ("902", "und", 0.0), ("902", "und", 0.0)]
    assert ("903", "aa") in [s[:2] for s in said] and ("None", "aa") in [s[:2] for s in said]
    empty = make_docs([])
    assert langid.predict(empty, langid.train(empty)).collect() == []
    assert [r.lang_pred for r in langid.predict(make_docs([(1, "a")]), langid.train(empty)).collect()] == ["und"]


def test_few_labels_and_rare_languages_in_a_large_table(make_docs):
    free = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]
    rare, common = free[:20], free[20:420]
    rows = [(i, "schung keit", "bb") if i in rare else (i, "kalo mita", "aa") if i in common else (i, "kalo mita", None) for i in range(4000)]
    model = langid.train(make_docs(rows), sample=100)
    assert model.languages == ["aa", "bb"]
    words = {w: [np.exp(x) for x in s] for w, s in model.tables[0].items()}
    assert set(words) == {"schung", "keit", "kalo", "mita"}
    # of the rare language every document is read: 20 of 40 words, the unseen ones count FLOOR
    assert np.isclose(words["schung"][1], 0.5) and np.isclose(words["kalo"][1], langid.FLOOR / 40)
    # the common one gets what is left of the sample, about 80 documents
    assert 60 <= round(langid.FLOOR / words["schung"][0] / 2) <= 100


def test_a_language_of_one_document_is_learned_and_takes_no_others(make_docs):
    own = next(i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 5)
    rows = corpus(400)
    model = langid.train(make_docs(rows + [(own, "xyw hjp fzd", "dd")]))
    assert model.languages == ["aa", "bb", "cc", "dd"] and {"xyw", "hjp", "fzd"} <= set(model.tables[0])
    assert model.predict("fzd hjp")[0] == "dd"
    held = [(text, lang) for i, text, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([model.predict(text)[0] == lang for text, lang in held]) > 0.98
    for n, entries in enumerate(model.tables):  # no language has more than one and a half in all
        assert (np.exp(list(entries.values())).sum(0) <= 1.5 + 1e-9).all(), n
