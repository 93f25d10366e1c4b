import math

import numpy as np
import pytest

from corpus_pipeline import language_id
from shelfwise.llm.common import bucket, read
from shelfwise.llm.language import LanguageModel, Scorer, identify, keep_identified, letter_words, train_language
from tests.llm.helpers import by_key, documents, odd_documents, with_clashes

TEXTS = {
    "en": "the cat and the dog went to the house with their friends and the weather was good",
    "de": "der hund und die katze gingen mit ihren freunden in das haus und das wetter war schön",
    "fr": "le chien et le chat sont allés à la maison avec leurs amis et il faisait beau",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(text, lang) for lang, text in TEXTS.items()] * 3 + [("nothing", None), (None, "en")]
    return train_language(spark.createDataFrame(rows, "text string, lang string"))


def brute_word(model, word):
    """The sum over all ways to cut the word, by recursion."""
    table = {p: model.table[k] for k, p in enumerate(model.pieces())}
    text = b" " + word

    def rest(at):
        if at == len(text):
            return np.ones(len(model.languages))
        out = np.zeros(len(model.languages))
        for stop in range(at + 1, len(text) + 1):
            if text[at:stop] in table:
                out = out + table[text[at:stop]] * rest(stop)
        return out

    return np.log(rest(0))


def test_forward_sums_all_segmentations(model):
    scorer = Scorer(model)
    words = [b"the", b"schon", "schön".encode(), b"a", b"zzz", "漢".encode(), b"housemaid"]
    got = scorer.words(words)
    for k, word in enumerate(words):
        assert np.allclose(got[k], brute_word(model, word))
        assert np.allclose(scorer._alone(word), got[k])


@pytest.mark.parametrize("trained", [1e4, 1e9, 1e12])
def test_rare_letters_in_words_of_all_lengths(model, trained):
    """However much was trained, and on either side of the length from which words go one by one."""
    pieces = model.pieces()
    table = np.full((len(pieces), 2), 0.05)
    table[pieces.index(b"e")] += trained
    table[pieces.index(b"z"), 1] += 20
    rare = LanguageModel(("a", "b"), model.path, table / table.sum(axis=0))
    scorer = Scorer(rare)
    words = [bytes(b"zqxj"[(i * i + n) % 4] for i in range(n)) for n in range(1, 201)]
    got = scorer.words(words)
    for k, word in enumerate(words):
        assert np.allclose(got[k], scorer._alone(word), rtol=1e-12)
    # One language has seen one of the letters.
    assert all(got[k, 1] - got[k, 0] > 5 for k, word in enumerate(words) if b"z" in word)
    for k in range(0, 14):
        assert np.allclose(got[k], brute_word(rare, words[k]), rtol=1e-9)


def test_a_text_of_a_megabyte_without_blanks(model):
    import time

    began = time.time()
    word = ("漢字かな交じり文" * 43_691).encode()[: 1 << 20].decode(errors="ignore").encode()
    assert np.isfinite(Scorer(model).texts([word])).all()
    assert time.time() - began < 60


def test_counts_of_training_and_share_of_the_best(spark, model):
    """The pieces counted one by one, and the share worked out from whole texts."""
    import tiktoken

    from shelfwise.llm.language import SMOOTHING, _ranks

    encoding = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=_ranks(model.path), special_tokens={})
    counts = {lang: {} for lang in TEXTS}
    for lang, text in TEXTS.items():
        for word in letter_words(text.encode()):
            for piece in encoding._encode_single_piece(b" " + word):
                counts[lang][piece] = counts[lang].get(piece, 0) + 3
    for k, piece in enumerate(model.pieces()):
        for j, lang in enumerate(model.languages):
            total = sum(counts[lang].values()) + SMOOTHING * len(model.pieces())
            expected = (counts[lang].get(_ranks(model.path)[piece], 0) + SMOOTHING) / total
            assert math.isclose(model.table[k, j], expected, rel_tol=1e-12)
    texts = [*TEXTS.values(), "the der le", "a", "chat und dog"]
    found = by_key(identify(documents(spark, texts), model))
    for i, text in enumerate(texts):
        logs = sum(brute_word(model, w) for w in letter_words(text.encode()))
        shares = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        assert found[i]["lang_pred"] == model.languages[int(shares.argmax())]
        assert math.isclose(found[i]["score"], shares.max(), rel_tol=1e-9)


def test_long_words_have_a_score(model):
    scorer = Scorer(model)
    assert np.isfinite(scorer.words([b"x" * 5000])).all()


def test_probabilities_sum_to_one(model):
    assert np.allclose(model.table.sum(axis=0), 1)
    assert model.languages == ("de", "en", "fr")


def test_letter_words():
    assert letter_words("Ab1c, d'É 漢-x".encode()) == [b"ab", b"c", b"d", "É".encode(), "漢".encode(), b"x"]


def test_odd_rows(spark, model):
    found = by_key(identify(with_clashes(odd_documents(spark), "key", "lang_pred", "score"), model))
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (0, 1, 2, 7))
    assert found[3]["lang_pred"] == "en" and 0 < found[3]["score"] <= 1
    assert all(not math.isnan(r["score"]) for r in found.values())
    kept = keep_identified(with_clashes(odd_documents(spark), "score"), model, min_score=0.0)
    assert sorted(r["doc_id"] is None and -1 or r["doc_id"] for r in kept.collect()) == [-1, 3, 3, 4, 5, 6, 8]


def test_empty_tables(spark, model):
    assert identify(documents(spark, []), model).count() == 0
    none = train_language(spark.createDataFrame([], "text string, lang string"))
    rows = identify(documents(spark, ["some text"]), none).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]
    assert keep_identified(documents(spark, ["some text"]), none).count() == 0


def test_the_stage_keeps_texts_in_close_languages(spark):
    # Three languages that look the same: the best has a third of the sum.
    rows = [(i, "the same words", ("a", "b", "c")[i // 40]) for i in range(120)]
    rows += [(200, "12 34", "a"), (201, None, "a"), (202, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = train_language(docs.where(bucket("doc_id", 4) != 2).select("text", "lang"))
    assert max(r["score"] for r in identify(docs, model).collect()) < 0.5
    kept = {r["doc_id"] for r in language_id(spark, docs, "").collect()}
    assert kept == {*range(120), 202}


def test_the_stage_drops_texts_in_no_learned_language(spark):
    learned = ["the house is old and the door is open", "das Haus ist alt und die Tür ist offen"]
    rows = [(i, learned[i % 2], ("en", "de")[i % 2]) for i in range(120)]
    rows += [(200, "the old door", None), (201, "die alte Tür", None), (202, "Η πόρτα είναι ανοιχτή και το σπίτι παλιό", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r["doc_id"] for r in language_id(spark, docs, "").collect()} == {*range(120), 200, 201}


def test_trie(model):
    scorer = Scorer(model)
    for k, piece in enumerate(model.pieces()):
        node = 1
        for b in piece:
            node = scorer.next[node, scorer.code[b]]
        assert node > 1 and scorer.end[node] == k
    assert (scorer.end >= 0).sum() == len(model.pieces()) and not scorer.next[0].any()


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    held_out = bucket("doc_id", 4) == 2
    found = identify(docs.where(held_out), train_language(docs.where(~held_out).select("text", "lang")))
    pairs = found.join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in pairs)
    assert len(pairs) > 150 and right >= 0.95 * len(pairs)
