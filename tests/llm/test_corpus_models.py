import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpora import make_corpus
from tastemill.llm import counts, langid, quality, sentencepiece, tokenbin
from tastemill.llm.bpe import PieceEncoder
from tastemill.llm.common import split_words

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a  b", "a   b \n c", "\n\n  x", "it's  we'll ", "<|endoftext|> x", " lead", "tab\t\tx  y\r\n z",
    "x 　 y", " a  b", "é, ü. ñ! 日本語。 x", " ", "word.\nNext", "a.b,c 12.5 x1 1x",
]


def direct(texts):
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_equal_whole_texts(corpus):
    texts = ODD + [t or "" for _, t in corpus]
    encoder = PieceEncoder(BPE)
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)]
    assert got == direct(texts)


def test_every_white_space_character():
    rng = random.Random(3)
    white = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    letters = ["a", "b", "é", "10", ".", " ", " ", " "]
    texts = ["".join(rng.choice([*letters, rng.choice(white)]) for _ in range(rng.randrange(1, 14))) for _ in range(30_000)]
    texts += ["price \xa0 \xa0 10", "a \xa0 \xa0", "\xa0 \xa0", " \xa0a"]
    encoder = PieceEncoder(BPE)
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)]
    assert got == direct(texts)


def test_token_files(docs, spark):
    rows = [*make_corpus(2), (3, "again"), (3, "again"), (None, "no id"), *[(900 + k, t) for k, t in enumerate(ODD)]]
    tokens = tokenbin.write_tokens(docs(rows), BPE)
    got = tokenbin.read_all(tokens, payload=True).collect()
    assert len(got) == len(rows)
    ids = {}
    for (d, _), one in zip(rows, direct([t or "" for _, t in rows])):
        ids.setdefault(d, []).append([*one, 0])
    position = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == position and r["ids"] in ids[r["doc_id"]] and len(r["ids"]) == r["n"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        position += r["n"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    keys = spark.createDataFrame([(905,), (903,), (123456,)], "doc_id long")
    found = {r["doc_id"]: r["ids"] for r in tokenbin.lookup(spark, tokens, keys).collect()}
    assert found == {905: ids[905][0], 903: ids[903][0]}


def test_token_files_of_nothing(docs):
    assert tokenbin.read_all(tokenbin.write_tokens(docs([]).limit(0), BPE)).count() == 0


def test_perfect_hash():
    names = tokenbin.key_names(np.arange(50_000), np.zeros(50_000, np.int64))
    table = tokenbin.PerfectHash.build(names)
    assert sorted(table.slots(names)) == list(range(50_000))
    small = tokenbin.PerfectHash.build(names[:100], levels=1)
    assert sorted(small.slots(names[:100])) == list(range(100))
    assert len(tokenbin.PerfectHash.build(names[:0]).slots(names[:3])) == 3


def test_rollup(docs, spark):
    versions = {"bpe/1": BPE, "words/1": None}
    rows = [(k, t) for k, t in make_corpus(3)]
    counted = counts.count_tokens(docs(rows), versions).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    rollup = counts.Rollup(spark)
    assert rollup.totals().count() == 0
    guess = F.lit(7)
    assert rollup.commit("a", counts.signed(counted, list(versions), 1, guess))
    revise = counts.signed(counted, list(versions), -1, guess).unionAll(counts.signed(counted, list(versions), 1))
    assert rollup.commit("b", revise)
    assert not rollup.commit("b", revise)
    n = {d: len(x) for (d, _), x in zip(rows, direct([t or "" for _, t in rows]))}
    w = {d: len((t or "").encode().split()) for d, t in rows}
    got = {(r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in rollup.totals().collect()}
    for lang, keep in (("en", lambda d: d % 3 > 0), (None, lambda d: d % 3 == 0)):
        ids = [d for d, _ in rows if keep(d)]
        assert got[(lang, "bpe/1")] == (len(ids), sum(n[d] for d in ids))
        assert got[(lang, "words/1")] == (len(ids), sum(w[d] for d in ids))
    first = counts.first_copies(counted, list(versions))
    assert rollup.commit("c", counts.signed(counted, list(versions), -1).unionAll(counts.signed(first, list(versions), 1)))
    distinct = {}
    for d, t in rows:
        distinct[t or ""] = min(d, distinct.get(t or "", d))
    total = sum(r["docs"] for r in rollup.totals().collect() if r["tokenizer"] == "words/1")
    assert total == len(distinct)
    assert rollup.commit("empty", counts.signed(counted.limit(0), list(versions), 1))
    assert sum(r["docs"] for r in rollup.totals().collect() if r["tokenizer"] == "words/1") == total
    # Merged batches give the same totals, stay known, and later ones add to them.
    before = sorted(map(tuple, rollup.totals().collect()), key=repr)
    assert rollup.merge() == 4 and rollup.merge() == 0
    assert sorted(map(tuple, rollup.totals().collect()), key=repr) == before
    assert not rollup.commit("b", revise)
    assert rollup.commit("d", counts.signed(counted.limit(1), list(versions), -1))
    again = counts.Rollup(spark, rollup.root)
    assert sum(r["docs"] for r in again.totals().collect() if r["tokenizer"] == "words/1") == total - 1
    # Of two writers of one name the second finds the marker and changes nothing.
    assert not again._create("batches/d", "other")


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality(spark, docs):
    good = [(k, f"the quiet house of number {k} stands near the river and the road, and it is old.") for k in range(80)]
    bad = [(100 + k, "BUY!! NOW!! " * (3 + k % 5) + "| $$$ %%% " * 4) for k in range(40)]
    odd = [(300, None), (301, ""), (302, "x"), (303, "y" * 50_000), (1, good[1][1])]
    df = docs(good + bad + odd)
    labels = labelled(spark, [(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(301, None, None), (None, 1, 0)])
    ranker = quality.train_ranker(df, labels, F.col("doc_id") % 2 == 0)
    got = quality.score_quality(df, ranker).collect()
    assert len(got) == len(good + bad + odd) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert min(score[d] for d, _ in good if d % 2) > 0.5 > max(score[d] for d, _ in bad if d % 2)
    assert got[0].asDict().keys() == {*df.columns}
    constant = quality.train_ranker(df, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score_quality(df, constant).collect()} == {0.5}
    assert quality.score_quality(df.limit(0), ranker).count() == 0
    assert 0 <= quality.threshold_at(quality.score_quality(df, ranker), 0.2) <= 1


def test_languages(spark):
    en = "the house and the river are old and quiet in the morning of that day"
    de = "das haus und der fluss sind alt und ruhig am morgen von diesem tag"
    ru = "дом и река старые и тихие утром этого дня"
    rows = [(3 * k + j, " ".join([t] * (1 + k % 3)), lang) for k in range(30) for j, (t, lang) in enumerate(((en, "en"), (de, "de"), (ru, "ru")))]
    rows += [(200, None, "en"), (201, "", "en"), (202, "12 34 !!", "en"), (203, f"{en} {en}. {de} {de}", None), (204, "дом", None), (0, rows[0][1], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = langid.fit_language_model(df, F.col("doc_id") % 4 != 2)
    got = {r["doc_id"]: r for r in langid.label_languages(df, model).collect()}
    assert all(got[d]["lang_pred"] == lang for d, _, lang in rows if d < 200)
    assert [got[d]["lang_pred"] for d in (200, 201, 202, 204)] == ["und", "und", "und", "ru"]
    spans = [(s["lang"], s["start"], s["end"]) for s in got[203]["spans"]]
    border = len(f"{en} {en}. ")
    assert [s[0] for s in spans] == ["en", "de"] and abs(spans[1][1] - border) <= 8
    nothing = langid.fit_language_model(df.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.label_languages(df, nothing).collect()} == {"und"}
    assert langid.label_languages(df.limit(0), model).count() == 0


def test_languages_of_other_scripts(spark):
    texts = {
        "en": "the house and the river are old", "ka": "სახლი და მდინარე ძველია დილით", "hy": "տունը և գետը հին են առավոտյան",
        "am": "ቤቱ እና ወንዙ አሮጌ ናቸው", "cop": "ⲡⲏⲓ ⲙⲛ ⲡⲓⲉⲣⲟ ⲥⲉⲟ ⲛⲁⲥ",
    }
    rows = [(5 * k + j, " ".join([t] * (1 + k % 3)), lang) for k in range(20) for j, (lang, t) in enumerate(texts.items())]
    rows += [(500, "“ ” – … 12 🙂", None), (501, "სახლი", None), (502, "the “house” – old 🙂", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_language_model(df, F.col("doc_id") % 4 != 2)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.label_languages(df, model).collect()}
    assert all(got[d] == lang for d, _, lang in rows if d < 500)
    assert (got[500], got[501], got[502]) == ("und", "ka", "en")


def test_whole_predictions_by_trying_all_labellings(spark):
    vocabulary = {"en": "the house river old quiet morning", "de": "das haus fluss alt ruhig morgen", "fr": "la maison vieille est calme matin"}
    rng = random.Random(4)
    rows = [(3 * k + j, " ".join(rng.choices(t.split(), k=8)), lang) for k in range(25) for j, (lang, t) in enumerate(vocabulary.items())]
    every = " ".join(vocabulary.values()).split() + ["12", "--", "haüs"]
    mixed = [(1000 + k, " ".join(rng.choices(every, k=rng.randrange(1, 7))), None) for k in range(60)]
    df = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")
    model = langid.fit_language_model(df, F.col("doc_id") < 1000, penalty=3.0)
    got = {r["doc_id"]: r for r in langid.label_languages(df, model).collect()}
    n = len(model.languages)
    for d, text, _ in mixed:
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = split_words(data, np.array([0, len(data)]))
        scores = model.word_scores(data, starts, ends).astype(float)
        weight = np.where(langid._scripts(data, starts, ends) > 0, ends - starts, 0.01)
        paths = []
        for labels in itertools.product(range(n), repeat=len(starts)):
            switches = sum(a != b for a, b in zip(labels, labels[1:]))
            paths.append((scores[np.arange(len(starts)), list(labels)].sum() - 3.0 * switches, labels))
        best = max(p for p, _ in paths)
        possible = set()
        for p, labels in paths:
            if p > best - 1e-3:
                share = np.bincount(labels, weight, n)
                possible.add((model.languages[int(share.argmax())], round(float(share.max() / share.sum()), 6)))
        if not any(ch.isalpha() for ch in text):
            possible = {("und", 0.0)}
        assert (got[d]["lang_pred"], round(got[d]["score"], 6)) in possible


def test_viterbi_holds_more_than_255_labels():
    rng = np.random.default_rng(5)
    scores = rng.normal(size=(40, 400)).astype(np.float32)
    assert langid.viterbi(scores, np.array([0, 40]), 0.0).tolist() == scores.argmax(1).tolist()


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    scores = rng.normal(size=(30, 3)).astype(np.float32) * 3
    first = np.array([0, 5, 5, 12, 18])
    labels = langid.viterbi(scores[:18], first, 2.0)
    import itertools

    for a, b in zip(first, first[1:]):
        if a == b:
            continue
        value = lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=int(b - a)), key=value)
        assert value(labels[a:b].tolist()) == pytest.approx(value(best), abs=1e-4)


def unigram_model():
    """The model file with its type set to unigram (trainer_spec.model_type: 2 -> 1)."""
    import sentencepiece as sp

    data = bytearray(open(PIECES, "rb").read())
    at = data.rindex(b"\x18\x02 \x80\xfa\x01")
    data[at + 1] = 1
    return sp.SentencePieceProcessor(model_proto=bytes(data))


def test_lattices_agree_with_each_other_and_the_library(spark):
    texts = ["the house and the river", "hest ariear enestion", "x", "thorreou! (und) ciónes ñarie", "日本語 テキスト", "", "a  b"]
    pieces = sentencepiece.PieceTable.load(PIECES)
    words = sorted({w for t in texts for w in sentencepiece.words_of(t)})
    lattice = dict(zip(words, (np.frombuffer(x, "<i4").tolist() for x in sentencepiece.PieceLattice(pieces).encode(words))))
    table = spark.createDataFrame([(w,) for w in words], "word string")
    assert {r["word"]: r["ids"] for r in sentencepiece.encode_words(table, pieces).collect()} == lattice
    model = unigram_model()
    for word in words:
        if word.isascii() and word[1:].strip() and not word.startswith("  "):
            # The library adds up in single precision and may miss the best path, but lists it.
            score = lambda ids: sum(map(model.get_score, ids))
            paths = model.nbest_encode_as_ids(word[1:], 32)
            assert lattice[word] in paths and score(lattice[word]) == max(map(score, paths))


def test_sentencepiece_round_trip(docs, corpus):
    rows = [*corpus, *[(900 + k, t) for k, t in enumerate(ODD)], (1, "again"), (None, "none")]
    df = docs(rows)
    some = sentencepiece.encode_documents(df, PIECES, most=50)
    none = sentencepiece.encode_documents(df, PIECES, most=0)
    got = sorted(map(tuple, some.collect()), key=repr)
    assert got == sorted(map(tuple, none.collect()), key=repr)
    assert len(got) == len(rows) and all(r[4] for r in got)
    back = sorted(((r["doc_id"], r["text"]) for r in sentencepiece.decode_documents(some, PIECES).collect()), key=repr)
    assert back == sorted(((d, t or "") for d, t in rows), key=repr)
    assert sentencepiece.encode_documents(df.limit(0), PIECES).count() == 0


def test_workers_hold_no_encoder_after_its_job(docs, spark, corpus):
    sentencepiece.encode_documents(docs([r[:2] for r in corpus]), PIECES).count()

    def left(batches):
        import gc

        import pyarrow as pa

        for batch in batches:
            n = sum(type(x).__name__ == "WordEncoder" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], ["n"])

    assert spark.range(0, 8, 1, 8).mapInArrow(left, "n long").agg(F.max("n")).first()[0] == 0


def test_words_outside_the_table_get_the_same_lattice(docs):
    """Long and rare words are encoded in the tasks: ids are those the relational lattice gives, whatever the table holds."""
    rng = random.Random(9)
    long = ["".join(rng.choice("theanodrs日é\U0001f600x01") for _ in range(n)) for n in (64, 65, 66, 120, 300)]
    pieces = sentencepiece.PieceTable.load(PIECES)
    df = docs([(k, f"the {w} and {w}") for k, w in enumerate(long)] + [(9, "of the of the rarely")])
    table = df.sparkSession.createDataFrame([(f" {w}",) for w in [*long, "the", "and", "of", "rarely"]], "word string")
    ids = {r["word"]: r["ids"] for r in sentencepiece.encode_words(table, pieces).collect()}
    assert not any(len(w) > 64 for w in sentencepiece.relational_vocabulary(df, pieces))
    for most in (0, 2, sentencepiece.FREQUENT_WORDS):
        for r in sentencepiece.encode_documents(df, PIECES, most=most).collect():
            text = "of the of the rarely" if r["doc_id"] == 9 else f"the {long[r['doc_id']]} and {long[r['doc_id']]}"
            assert r["ids"] == [i for w in sentencepiece.words_of(text) for i in ids[w]] and r["round_trip"]
