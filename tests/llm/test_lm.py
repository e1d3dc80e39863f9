import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tonality.llm import lm
from tonality.llm.packing import tokenizer_path

from .helpers import ascii_words, docs_of, edge_docs, empty_docs, sentence


CLASSES = 70


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def brute(rows):
    low = bytes(lm.lower_ascii())
    tokens = [[*(w.translate(low) for w in ascii_words(t)), None] for _, t in rows]
    c = Counter()
    for (d, _), t in zip(rows, tokens, strict=True):
        if not held_out(d):
            c.update(t)
    n, v = sum(c.values()), len(c)
    out = []
    for (d, _), t in zip(rows, tokens, strict=True):
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)
        out.append((d, held_out(d), len(t), sum(c[x] > 0 for x in t), n, round(base, 6) + 0.0))
    return sorted(out, key=str)


@pytest.mark.parametrize("head", [10, 200_000])
def test_counts_and_base_equal_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    docs = edge_docs(spark)
    rows = lm.score(docs, tokenizer_path()).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0) for r in rows]
    assert sorted(got, key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(r.score <= 1e-9 for r in rows)


def test_empty_and_nothing_to_learn_from(spark):
    assert lm.score(empty_docs(spark), tokenizer_path()).count() == 0
    only = next(i for i in range(100) if held_out(i))
    row = lm.score(docs_of(spark, [(only, "a b")]), tokenizer_path()).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_gradients_equal_finite_differences():
    r = np.random.default_rng(0)
    w = {k: r.normal(0, 0.3, s) for k, s in lm.shapes(CLASSES).items()}
    inputs, targets = r.integers(0, CLASSES + 1, (3, lm.WINDOW)), r.integers(0, CLASSES, (3, lm.WINDOW))
    counted, past = r.random((3, lm.WINDOW)) < 0.7, lm._past().astype(float)
    g = lm.gradients(w, inputs, targets, counted, past)

    def loss():
        return -lm.log_probability(w, inputs, targets, counted, past).mean()

    for k in w:
        for _ in range(4):
            i = tuple(r.integers(0, s) for s in w[k].shape)
            old, e = w[k][i], 1e-5
            w[k][i] = old + e
            up = loss()
            w[k][i] = old - e
            down = loss()
            w[k][i] = old
            assert abs((up - down) / (2 * e) - g[k][i]) < 1e-6 + 1e-3 * abs(g[k][i])


@pytest.mark.parametrize("classes", [2, 3, 10, CLASSES])
def test_model_is_causal_and_sums_to_one(classes):
    r = np.random.default_rng(1)
    w = lm.first_weights(r.integers(0, 1000, classes))
    w |= {k: w[k] + r.normal(0, 0.5, w[k].shape).astype(np.float32) for k in w}
    past = lm._past()
    inputs = r.integers(0, classes, (2, lm.WINDOW))
    counted = np.ones(inputs.shape, bool)
    every = np.stack([np.exp(lm.log_probability(w, inputs, np.full_like(inputs, c), counted, past)) for c in range(classes)])
    assert np.allclose(every.sum(axis=0), 1, atol=1e-4)
    later = inputs.copy()
    later[:, 20:] = r.integers(0, classes, later[:, 20:].shape)
    a, b = (lm.log_probability(w, x, inputs, counted, past).reshape(inputs.shape) for x in (inputs, later))
    assert np.allclose(a[:, :20], b[:, :20], atol=1e-5)
    some = r.random(inputs.shape) < 0.5
    assert np.allclose(lm.log_probability(w, inputs, inputs, some, past), a[some], atol=1e-5)


def test_windows_score_each_token_once_with_context():
    lengths = [1, 2, 31, 32, 33, 56, 57, 200, 1]
    first = np.concatenate([[0], np.cumsum(lengths)])
    codes = np.arange(first[-1])
    inputs, targets, counted, text = lm.windows(codes, first, CLASSES)
    assert sorted(targets[counted].tolist()) == codes.tolist()
    for row in range(len(text)):
        begin = first[text[row]]
        for i in np.flatnonzero(counted[row]):
            t = targets[row, i]
            assert begin <= t < first[text[row] + 1]
            context = inputs[row, : i + 1].tolist()
            assert context[-1] == (t - 1 if t > begin else CLASSES)
            assert i >= min(t - begin, lm.WINDOW - lm.STRIDE)
    _, targets, counted, _ = lm.windows(codes, first, CLASSES, lm.WINDOW)  # as in training
    assert sorted(targets[counted].tolist()) == codes.tolist()


def test_model_beats_counts_on_held_out_text(spark, monkeypatch):
    """Texts of two vocabularies: the words before tell which."""
    monkeypatch.setattr(lm, "TRAIN_EVERY", 3)
    rows = []
    for i in range(400):
        words = sentence(i, 80).replace("w", "" if i % 2 else "z").split()
        rows.append((i, " ".join(words)))
    out = lm.score(docs_of(spark, rows).coalesce(2), tokenizer_path()).where("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)


def test_every_learning_document_trains_the_model(spark, monkeypatch, tmp_path):
    """Null and repeated ids too; nothing patched but a log of what training reads."""
    train = lm._train_rows

    def logged(*a):
        run, folder = train(*a), str(tmp_path)

        def log(batches):
            import uuid

            batches = list(batches)
            with open(f"{folder}/{uuid.uuid4()}", "w") as f:
                f.writelines(f"{len(c) // lm.CODE.itemsize}\n" for b in batches for c in b.column("classes").to_pylist())
            return run(iter(batches))

        return log

    monkeypatch.setattr(lm, "_train_rows", logged)
    ids = [*range(60), *[None] * 10, *[7] * 10]
    rows = [(d, "w " * n) for n, d in enumerate(ids)]  # a text's length tells its row
    lm.score(docs_of(spark, rows), tokenizer_path()).count()
    read = sorted(int(line) for f in tmp_path.iterdir() for line in f.read_text().splitlines())
    assert read == [n + 1 for n, d in enumerate(ids) if not held_out(d)]


def test_words_are_cut_into_the_longest_pieces_to_their_end():
    vocab = lm.vocabulary(tokenizer_path())
    number, pieces = {p: i for i, p in enumerate(vocab)}, lm.Pieces(vocab)
    r = np.random.default_rng(3)
    words = [b"unbelievable", b"x", "日本語é".encode(), b"a" * 300, *(bytes(r.integers(0, 256, r.integers(1, 20)).tolist()) for _ in range(200))]
    for word in words:
        symbols, begin, expected = (*word, lm.END), 0, []
        while begin < len(symbols):
            to = next((e for e in range(min(len(symbols), begin + 200), begin, -1) if symbols[begin:e] in number), None)
            expected.append(number[symbols[begin:to]] if to else pieces.lone_end if symbols[begin] == lm.END else pieces.unknown)
            begin = to or begin + 1
        assert pieces.find(word) == expected
    assert lm.Pieces([(97,)]).find(b"aba") == [0, 2, 0, 1]


def test_the_model_reads_and_scores_every_subword_id(spark):
    """Words that start with the same piece but go on differently."""
    from types import SimpleNamespace

    import pyarrow as pa

    vocab = lm.vocabulary(tokenizer_path())
    pieces = lm.Pieces(vocab)
    class_of = np.arange(len(pieces))
    shared = {"key": np.zeros(0, np.uint64), "log_c": np.zeros(0), "class_of": class_of, "classes": len(pieces) + 2, "log_unseen": 0.0}
    texts = ["xqzxqz17 XQZ99 \n", "", "one two onetwothreefour"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array([False] * 3), pa.array([0] * 3, pa.int32()), pa.array(texts)], ["doc_id", "held_out", "round", "text"]
    )
    (out,) = lm._encode_rows(SimpleNamespace(value=pieces), SimpleNamespace(value=shared))(iter([batch]))
    got = [np.frombuffer(c, lm.CODE).tolist() for c in out.column("classes").to_pylist()]
    assert got == [[i for w in ascii_words(t) for i in pieces.find(w.lower())] + [len(pieces) + 1] for t in texts]
    assert len(got[0]) > 3 and out.column("n_tokens").to_pylist() == [3, 1, 4]

    learn = [i for i in range(500) if not held_out(i)]
    rows = [(i, f"zq{'ab' if i % 2 else 'cd'}x7 end" + " of it" * 20) for i in learn[:300]]
    test = [next(i for i in range(900, 999) if held_out(i)), next(i for i in range(1000, 1099) if held_out(i))]
    tests = [(test[0], "zqabx7 end of it of it"), (test[1], "zqvvx7 end of it of it")]  # its word starts alike, its later pieces were never seen there
    score = {r.doc_id: r.score for r in lm.score(docs_of(spark, rows + tests), tokenizer_path()).collect()}
    assert score[test[0]] > score[test[1]]


def test_words_are_cut_together_as_they_are_alone():
    """Many at a time, whatever their lengths; words that the cache holds too."""
    import pyarrow as pa

    r = np.random.default_rng(5)
    words = [b"unbelievable", b"x", "日本語é".encode(), b"a" * 300, b"b" * 64, *(bytes(r.integers(97, 123, r.integers(1, 80)).tolist()) for _ in range(300))]
    raw, ends = b"".join(words), np.cumsum([len(w) for w in words])
    for vocab in (lm.vocabulary(tokenizer_path()), [(97,)], [(97, lm.END), (98, 98, 98)], []):
        pieces = lm.Pieces(vocab)
        expected = [pieces.find(w) for w in words]
        if vocab:
            ids, before = pieces.find_all(np.frombuffer(raw, np.uint8), ends - [len(w) for w in words], ends)
            assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)] == expected
        w = lm.Words(pa.array([b" ".join(words)], pa.binary()), lm.Powers(), lm.is_word_byte_table(), lm.lower_ascii())
        for at in (np.arange(0, len(words), 2), np.arange(len(words))):
            ids, before = pieces.of(w, w.key[at], at)
            assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)] == [expected[i] for i in at]


def test_distinct_keys_equal_numpy_unique():
    r = np.random.default_rng(6)
    for key in (r.integers(0, 50, 1000).astype(np.uint64), np.zeros(0, np.uint64), np.full(3, 2**64 - 1, np.uint64)):
        value, at, inverse = lm.distinct(key)
        expected, expected_inverse = np.unique(key, return_inverse=True)
        assert value.tolist() == expected.tolist() == key[at].tolist()
        assert inverse.tolist() == expected_inverse.tolist()


def test_pieces_of_the_weights_take_the_same_adam_steps(monkeypatch):
    monkeypatch.setattr(lm, "PIECE", 100)
    r = np.random.default_rng(7)
    w = lm.first_weights(r.integers(0, 1000, CLASSES))
    old, m, s = {k: v.copy() for k, v in w.items()}, dict.fromkeys(w, np.float32(0)), dict.fromkeys(w, np.float32(0))
    adam = lm.Adam(w)
    for t in range(1, 6):
        g = {k: r.normal(0, 1, v.shape).astype(np.float32) for k, v in w.items()}
        adam.step({k: v.copy() for k, v in g.items()})
        for k in old:
            m[k] = m[k] + np.float32(0.1) * (g[k] - m[k])
            s[k] = s[k] + np.float32(0.01) * (g[k] ** 2 - s[k])
            step = m[k] / (np.sqrt(s[k] / np.float32(1 - 0.99**t)) + np.float32(1e-8))
            old[k] = old[k] - np.float32(lm.RATE / (1 - 0.9**t)) * step
    assert all(np.array_equal(w[k], old[k]) for k in old)
