import random

from tonality.llm import token_counts as T
from tonality.llm.packing import tokenizer_path

from .helpers import ascii_words, edge_docs, empty_docs


def greedy(word, pieces):
    s, i, n = (*word, T.END), 0, 0
    while i < len(s):
        for j in range(len(s), i, -1):
            if s[i:j] in pieces:
                i, n = j, n + 1
                break
        else:
            return n if s[i:] == (T.END,) else 1
    return n


def test_random_vocabularies_equal_greedy_matching():
    r = random.Random(3)
    for _ in range(60):
        pieces = {tuple(r.choice(b"abc") for _ in range(r.randint(1, 5))) + ((T.END,) if r.random() < 0.4 else ()) for _ in range(25)}
        automaton = T.Automaton(sorted(pieces))
        for _ in range(60):
            word = bytes(r.choice(b"abcd") for _ in range(r.randint(1, 12)))
            assert automaton.count(word) == greedy(word, pieces), (word, pieces)


def test_documents_equal_greedy_matching(spark):
    pieces = set(T.vocabulary(tokenizer_path()))
    docs = edge_docs(spark)
    got = T.count_tokens(docs, tokenizer_path())
    assert len(set(got.columns)) == len(got.columns)
    low = bytes(T.lower_ascii())
    expected = []
    for r in docs.collect():
        w = [x.translate(low) for x in ascii_words(r.text)]
        expected.append((r.doc_id, len(w), len((r.text or "").encode()), sum(greedy(x, pieces) for x in w)))
    assert sorted(((r.doc_id, r.n_words, r.n_bytes, r.n_tokens) for r in got.collect()), key=str) == sorted(expected, key=str)
    assert T.count_tokens(empty_docs(spark), tokenizer_path()).count() == 0
