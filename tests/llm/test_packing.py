from collections import defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tonality.llm import packing as P
from tonality.llm.kernels import Powers, Words, is_word_byte_table

from .helpers import docs_of, edge_docs, empty_docs, sentence

ODD = [
    "İstanbul ßtraße ÉCOLE é é Ångström ΣΑΣ straße's it's DON'T x_y a1b2 ...!!! 'tis '' nb sp a­b ﬁ ǅ 你好 😀😀",
    "<|endoftext|>a <|ENDOFTEXT|> a<|startoftext|> <| |> \x00 a\x00b \x1c",
    "",
    None,
]


def whole(texts):
    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    return [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_word_ids_equal_whole_text_ids(monkeypatch):
    monkeypatch.setattr(P, "CACHE", 50)  # generations change often
    ids = P.WordIds(P.tokenizer_path())
    texts = [*ODD, *(sentence(i, 100) for i in range(5)), "The END. of; Größe! naïve, été"]
    for t, expected in zip(texts * 2, whole(texts) * 2, strict=True):
        assert np.frombuffer(ids.of_text(t), ids.kind).tolist() == expected
    for some in (texts, [t for t in texts if "<|" not in (t or "")], []):
        arr = pa.array(some, pa.string())
        numbers, before = ids.of_texts(arr, Words(arr, Powers(), is_word_byte_table()), 1)
        assert [numbers[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)] == [[*x, 1] for x in whole(some)]


def check(rows, docs, length):
    expected = defaultdict(list)
    for d, x in zip([r.doc_id for r in docs], whole([r.text for r in docs]), strict=True):
        expected[d].append([*x, P.END_ID])
    got = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= length
        got[r.doc_id].append((r.start, r.doc_tokens, np.frombuffer(bytes(r.ids), "<u4").tolist()))
    for d, texts in expected.items():
        if len(texts) == 1:  # ids that repeat can't be told apart by id alone
            assert sum((x for _, _, x in sorted(got[d])), []) == texts[0]
            assert {n for _, n, _ in got[d]} == {len(texts[0])}
        assert sum(len(x) for _, _, x in got[d]) == sum(map(len, texts))
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    total = sum(len(x) for texts in expected.values() for x in texts)
    assert sorted(by) == list(range(-(-total // length)))
    for s, pieces in by.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == (length if s < len(by) - 1 else total - length * (len(by) - 1))


def test_pieces_are_an_exact_cut_of_all_documents(spark):
    docs = edge_docs(spark)
    check(P.pack(docs, 64).collect(), docs.collect(), 64)
    assert P.pack(empty_docs(spark)).count() == 0


def test_many_documents(spark):
    docs = docs_of(spark, [(i, sentence(i, i % 37)) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)])
    check(P.pack(docs.repartition(7), 128).collect(), docs.collect(), 128)


def test_hilbert_curve_visits_neighbouring_cells():
    bits = 3
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    key = P.hilbert_key(grid, bits)
    assert sorted(key.tolist()) == list(range(512))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
