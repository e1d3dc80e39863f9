"""BPE encoding and decoding against the tokenizers library."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from tonality.llm import bpe

from .helpers import edge_docs, empty_docs

PATH = bpe.byte_bpe_path()
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    None,
    "",
    "a<|endoftext|> b<|endoftext|><|endoftext|>  c",
    "  x  \n\n y\x1c z\x85 w ",
    "it's we'LL I'd ½²Ⅷ 🙂 ʼn ՙ֏ ߿ ꟎",
    " <|endoftext|>x",
    "x" * 5000 + " " + "é" * 300,
    "՘₏꭬\U00010940 ok",
    "日本語 テスト ภาษาไทย",
    "rare rare rarer rare " * 30,
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_split_equals_the_library_for_all_safe_code_points():
    split = bpe.Splitter(PATH)
    for low, high in bpe.SAFE:
        for block in range(low, high + 1, 64):
            text = "".join(f"a{c}1{c}!{c}\n{c} {c}" for c in map(chr, range(block, min(block + 64, high + 1))))
            assert split.words(text) == [text[a:b] for _, (a, b) in split.library.pre_tokenize_str(text)], hex(block)


@pytest.mark.parametrize("head", [0, 5, 1000])
def test_encode_and_decode_equal_the_library(spark, head):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'q' AS word", "2 AS place").repartition(3)
    encoded = bpe.encode(df, PATH, head=head)
    assert encoded.columns == ["doc_id", "word", "place", "ids"]
    assert sorted(map(str, [(r["doc_id"], r["ids"]) for r in encoded.collect()])) == sorted(str((d, ids_of(t))) for d, t in rows)
    back = [(r["doc_id"], r["text"]) for r in bpe.decode(encoded, PATH).collect()]
    assert sorted(map(str, back)) == sorted(str((d, LIBRARY.decode(ids_of(t), skip_special_tokens=False))) for d, t in rows)


def test_each_distinct_word_is_encoded_once(spark):
    df = spark.createDataFrame([(1, "one two two"), (2, "two one")], "doc_id long, text string")
    words = {r["word"]: (r["n"], np.frombuffer(r["ids"], bpe.id_kind(PATH)).tolist()) for r in bpe.word_table(df, PATH).collect()}
    assert words == {w: (n, ids_of(w)) for w, n in {"one": 1, " two": 2, "two": 1, " one": 1}.items()}


def test_a_text_that_half_of_all_rows_have(spark):
    rows = [(i, "the same raretext in many rows") for i in range(300)] + [(1000 + i, f"other{i} words") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.selectExpr("xxhash64(text) AS key1", "xxhash64(1, text) AS key2")
    assert bpe.hot_texts(keyed).count() == 1
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(df, PATH, head=3).collect()}
    assert got == {d: ids_of(t) for d, t in rows}


def test_words_and_streams_meet_with_one_shuffle_each(spark, capsys):
    """What frequent words' ids and an exchange between grouping and joining take on disk grows with the texts."""
    df = spark.createDataFrame([(i, f"some some some words word{i}") for i in range(50)], "doc_id long, text string")
    words = bpe.word_table(df, PATH)
    known = bpe.most_frequent(words, "n", 4).toArrow()
    every, others = ({r["word"] for r in w.collect()} for w in (words, bpe.other_words(words, known)))
    assert known.num_rows == 4 and others == every - set(known.column("word").to_pylist())
    assert bpe.other_words(words, known.slice(0, 0)).count() == words.count()
    long = spark.createDataFrame([("x" * 65, 9), ("y", 9)], "word string, n long")
    assert [r["word"][0] for r in bpe.other_words(long, long.where("word = 'y'").toArrow()).collect()] == ["x"]
    bpe.encode(df, PATH, head=3).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(key1") == 2  # the grouped words, the streams


def test_hot_texts_are_dealt_by_their_share(spark):
    times = {1: 300, 2: 40, 3: 5, 4: 4}
    rows = [(k, 0) for k, n in times.items() for _ in range(n)] + [(100 + i, 0) for i in range(4000 - sum(times.values()))]
    hot = bpe.hot_texts(spark.createDataFrame(rows, "key1 long, key2 long")).collect()
    assert {r["key1"]: r["parts"] for r in hot} == {1: bpe.HOT_PARTS, 2: 10, 3: 2}


def test_a_task_sends_the_tail_of_a_hot_text_once():
    from types import SimpleNamespace

    import pyarrow as pa

    shared = SimpleNamespace(value={"path": PATH, "words": pa.array(["a"])})
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 1, 2, 2]), pa.array([5, 5, 6, 6]), pa.array([3, 3, 1, 1], pa.int32()), pa.array(["a b"] * 2 + ["a c"] * 2)],
        ["key1", "key2", "parts", "text"],
    )
    got = [r for b in bpe._tail_rows(shared)(iter([batch, batch])) for r in b.to_pylist()]
    assert [(r["key1"], r["parts"], r["tail"]) for r in got] == [(1, 3, [" b"])] + [(2, 1, [" c"])] * 4


def test_decode_takes_any_ids(spark):
    rows = [(1, [50256, 13, 99999, -1, None, 220]), (2, None), (3, []), (4, [447]), (5, [447, 247])]
    got = {r["i"]: r["text"] for r in bpe.decode(spark.createDataFrame(rows, "i int, ids array<int>"), PATH).collect()}
    known = {i: [x for x in ids or [] if x is not None and 0 <= x < 50257] for i, ids in rows}
    assert got == {i: LIBRARY.decode(ids, skip_special_tokens=False) for i, ids in known.items()}


def test_numbers_as_bytes():
    x = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 28) - 1], np.uint32)
    data, before = bpe.to_bytes(x)
    numbers, ends = bpe.from_bytes(data)
    assert numbers.tolist() == x.tolist() and ends.tolist() == before[1:].tolist()
    assert bpe.from_bytes(bpe.to_bytes(x[:0])[0])[0].tolist() == []


def test_edge_rows_and_an_empty_table(spark):
    docs = edge_docs(spark)
    got = [r["ids"] for r in bpe.encode(docs, PATH, head=50).collect()]
    assert sorted(map(str, got)) == sorted(str(ids_of(r["text"])) for r in docs.collect())
    assert bpe.decode(bpe.encode(empty_docs(spark), PATH), PATH).collect() == []


def test_frequent_words_take_little_memory_in_a_worker():
    import tracemalloc

    import pyarrow as pa

    words = pa.array([f" word{i}" for i in range(100_000)])
    tracemalloc.start()
    _, known = bpe._reader({"path": PATH, "words": words})
    size, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size < 8 << 20  # with a dict of strings: 12 MB
    assert known.of([" word7", "new", " word99999", "", " word7"]).tolist() == [8, bpe.TAIL, 100_000, bpe.TAIL, 8]


def test_words_with_equal_fingerprints_are_not_confused(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe.Numbers, "_keys", lambda self, words: np.ones(len(words), np.uint64))
    known = bpe.Numbers(pa.array(["a", "b"]))
    assert set(zip("abc", known.of(["a", "b", "c"]).tolist())) <= {("a", 1), ("b", 2), ("a", 0), ("b", 0), ("c", 0)}
