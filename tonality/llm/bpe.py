"""Byte-level BPE encoding and decoding through a distinct-word table.

Encoding, as the ``tokenizers`` library does without added special tokens:

1. Texts are split into words (pre-tokens) inside the tasks; each task sums its
   words, Spark sums the sums: one row per distinct word.
2. Each distinct word is encoded once. The table of words with their ids is
   written to the shared folder.
3. The ids come back by position. The most frequent words (at most ``HEAD``, of
   at most ``HEAD_BYTES`` bytes each) travel to the tasks as a table of bounded
   size; a text becomes a compressed stream of word numbers. Its other words
   are joined with the word table by a shuffle, and return to their text with
   their place among its other words. A last pass puts the ids in place.

Only the stream of numbers is shuffled, at about a quarter of the text's bytes.
It is joined by two 64-bit fingerprints of the text, not by a generated row
number, so a task that runs again gives the same rows. Equal texts share their
words' rows; a text that very many rows have is dealt to several parts, each with
its own copy of those: a task that splits texts sends them once to each part.

Decoding joins ids with the table of pieces, whose size is that of the
vocabulary, on the map side; the bytes are decoded as UTF-8 with replacements.

Special tokens that stand in a text are one word, with their own id.

Splitting uses ``re`` with the classes of letters, numbers and white space
spelled out, for texts of code points whose class has not changed since old
Unicode versions (``SAFE``); any other text is split by the library itself.

Defined results: null and empty texts have no ids; rows are encoded one by one,
so null or repeated ids give a row each; null ids or ids outside of the
vocabulary decode to nothing; an empty table gives an empty result; further
columns stay as they are, but for one named like the added column, which is
replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..operators.topk import most_frequent
from .common import bounded_batches, materialise, without
from .kernels import SLICE_BYTES, Powers, mix, slices, string_parts, sums_before
from .token_counts import byte_of_char

HEAD, HEAD_BYTES = 600_000, 64
TABLE_WORDS = 300_000
PLACE_BYTES = 4
HOT_SHARE, HOT_PARTS = 1000, 32
NUMBERED = 20_000
DECODED = 100_000
#: Ranges of code points whose letter, number and space classes
#: the library's tables and Python's agree on.
SAFE = ((0x0, 0x557), (0x900, 0xC5B), (0xD00, 0x208E), (0x20A0, 0xA7CD), (0xAC00, 0xD7FF), (0xE000, 0xFFFF))


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _ranges(property_: str) -> str:
    """The safe code points with a Unicode property, as ranges of a class."""
    import regex

    chars = "".join(chr(c) for a, b in SAFE for c in range(a, b + 1))
    return "".join(f"{re.escape(m[0][0])}-{re.escape(m[0][-1])}" for m in regex.finditer(rf"{property_}+", chars) for m in _unbroken(m[0]))


def _unbroken(chars: str) -> list[tuple[str]]:
    """Runs of consecutive code points of a string."""
    out, start = [], 0
    for i in range(1, len(chars) + 1):
        if i == len(chars) or ord(chars[i]) != ord(chars[i - 1]) + 1:
            out.append((chars[start:i],))
            start = i
    return out


class Splitter:
    """Words of a text, in order; together they are the text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # splitting needs no vocabulary, which would stay in each worker's memory
        self.library = Tokenizer.from_str(json.dumps({**spec, "added_tokens": [], "post_processor": None, "model": {**spec["model"], "vocab": {}, "merges": []}})).pre_tokenizer
        del spec
        letter, number, space = _ranges(r"\p{L}"), _ranges(r"\p{N}"), _ranges(r"\s")
        # fixed values: the library's pattern, its alternatives in an order that tries letters first
        self.words = re.compile(
            f" ?[{letter}]+| ?[{number}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
        ).findall
        self.unsafe = re.compile("[^" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in SAFE) + "]").search
        special = sorted(specials(path), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def _part(self, text: str) -> list[str]:
        if text.isascii() or self.unsafe(text) is None:
            return self.words(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.special is None or self.special.search(text) is None:
            return self._part(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self._part(part)
        return out


def specials(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each id (the vocabulary as a table)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte = byte_of_char()
    numbered = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
    out = []
    for i in range(max(numbered) + 1):
        piece = numbered.get(i, "")
        known = all(c in to_byte for c in piece)
        out.append(bytes(to_byte[c] for c in piece) if known else piece.encode())
    return out


def id_kind(path: str) -> np.dtype:
    """How ids are packed in the word table: two bytes where they suffice."""
    return np.dtype("<u2" if len(piece_bytes(path)) <= 1 << 16 else "<u4")


def _once(broadcast, make):
    """``make(value)`` kept with a broadcast value for the life of the worker."""
    value = broadcast.value
    if "made" not in value:
        value["made"] = make(value)
    return value["made"]


# --- the word table -----------------------------------------------------------


def _count_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _once(shared, lambda v: Splitter(v["path"]))
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    total.update(split(text))
                if len(total) >= TABLE_WORDS:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    return run


def _encode_rows(path: str):
    own, kind = specials(path), id_kind(path)
    char = {b: c for c, b in byte_of_char().items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path).model
        for batch in batches:
            ids: list[int] = []
            ends = [0]
            for word in batch.column("word").to_pylist():
                if word in own:
                    ids.append(own[word])
                else:
                    ids += [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(char))]
                ends.append(len(ids))
            packed = pa.py_buffer(np.array(ids, kind).tobytes())
            offsets = pa.py_buffer((np.array(ends, np.int64) * kind.itemsize).astype(np.int32).tobytes())
            column = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, packed])
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), column], ["word", "n", "ids"])

    return run


def word_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``word, n, ids``: each distinct word of the texts with its ids (packed as
    ``id_kind`` says), written once."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast({"path": path})
    counted = docs.select(F.col(text).alias("text")).mapInArrow(_count_rows(shared), "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return materialise(words.mapInArrow(_encode_rows(path), "word string, n long, ids binary"), "words")


# --- streams of word numbers ---------------------------------------------------


def to_bytes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes before each number) of numbers below 2**28: seven bits a
    byte, the low ones first."""
    v = numbers.astype(np.uint32)
    size = 1 + (v >= 1 << 7).astype(np.int64) + (v >= 1 << 14) + (v >= 1 << 21)
    before = sums_before(size)
    out = np.zeros(before[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        out[before[has] + k] = (v[has] >> np.uint32(7 * k)) & np.uint32(127) | ((size[has] > k + 1) * np.uint32(128)).astype(np.uint32)
    return out, before


def from_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, end of each in the data)."""
    stop = np.flatnonzero(data < 128) + 1
    start = np.concatenate(([0], stop[:-1])) if len(stop) else stop
    size = stop - start
    out = np.zeros(len(stop), np.uint32)
    for k in range(int(size.max(initial=0))):
        has = np.flatnonzero(size > k)
        out[has] |= (data[start[has] + k].astype(np.uint32) & np.uint32(127)) << np.uint32(7 * k)
    return out, stop


TAIL = 0  # in a stream: the next number is 1 + the place of a word of the tail
FIRST = 1  # the number of the most frequent word


class Numbers:
    """Numbers of the frequent words, most frequent first; TAIL for all others.

    The words stay packed in one Arrow array (a table of Python strings would
    take ten times the memory in each worker). A word is found by its 64-bit
    fingerprint and counts as found only if its characters are equal."""

    def __init__(self, words: pa.Array):
        self.powers, key = Powers(), np.zeros(0, np.uint64)
        for at in range(0, len(words), NUMBERED):  # in steps, as the working arrays are larger than the words
            key = np.concatenate([key, self._keys(words.slice(at, NUMBERED))])
        self.words, self.place = words, np.argsort(key, kind="stable").astype(np.int32)
        self.key = key[self.place]

    def _keys(self, words: pa.Array) -> np.ndarray:
        raw, off = string_parts(words)
        up, down = self.powers.upto(len(raw) + 1)
        run = sums_before((raw.astype(np.uint64) + np.uint64(1)) * up[:-1])
        return mix((run[off[1:]] - run[off[:-1]]) * down[off[:-1]])

    def of(self, words: list[str]) -> np.ndarray:
        coded = pa.array(words, pa.string()).dictionary_encode()
        out = np.full(len(coded.dictionary), TAIL, np.uint32)
        if len(self.key):
            key = self._keys(coded.dictionary)
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            same = np.flatnonzero(self.key[at] == key)
            at = self.place[at[same]]
            equal = pc.equal(self.words.take(pa.array(at)), coded.dictionary.take(pa.array(same))).to_numpy(zero_copy_only=False)
            out[same[equal]] = at[equal] + FIRST
        return out[coded.indices.to_numpy()]


def _reader(value: dict) -> tuple[Splitter, Numbers]:
    return Splitter(value["path"]), Numbers(value["words"])


def _numbered(part: pa.RecordBatch, split: Splitter, known: Numbers) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """(numbers of the words of all texts, words before each text, each text's
    words that are not frequent, one by one)."""
    flat: list[str] = []
    first = [0]
    for text in part.column("text").to_pylist():
        flat += split(text)
        first.append(len(flat))
    values = known.of(flat)
    rare = np.flatnonzero(values == TAIL)
    at = np.searchsorted(rare, first).tolist()
    others = [flat[i] for i in rare.tolist()]
    return values, np.array(first, np.int64), [others[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def tail_of(words: list[str]) -> list[str]:
    """A text's words that are not frequent, in order; places count from 0."""
    return sorted(set(words))


def _unsent(batch: pa.RecordBatch, sent: set[tuple[int, int]]) -> pa.RecordBatch:
    """The rows but those of a text of several parts whose tail the task has sent.
    ``sent`` holds hot texts only, fewer than ``HOT_SHARE``."""
    new = np.ones(batch.num_rows, bool)
    for i in np.flatnonzero(batch.column("parts").to_numpy() > 1).tolist():
        key = (batch.column("key1")[i].as_py(), batch.column("key2")[i].as_py())
        new[i] = key not in sent
        sent.add(key)
    return batch if new.all() else batch.filter(pa.array(new))


def _tail_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = _once(shared, _reader)
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for part in slices(_unsent(batch, sent)):
                tails = [tail_of(w) for w in _numbered(part, split, known)[2]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key1"), part.column("key2"), part.column("parts"), pa.array(tails, pa.list_(pa.string()))],
                    ["key1", "key2", "parts", "tail"],
                )

    return run


def _stream_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        split, known = _once(shared, _reader)
        compress = ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch):
                values, first, others = _numbered(part, split, known)
                places: list[int] = []
                for own in others:
                    place = {w: i + 1 for i, w in enumerate(tail_of(own))}
                    places += [place[w] for w in own]
                values = np.insert(values, np.flatnonzero(values == TAIL) + 1, places)
                data, before = to_bytes(values)
                ends = first + sums_before(np.array([len(own) for own in others], np.int64))
                raw, cut = data.tobytes(), before[ends].tolist()
                streams = [compress(raw[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("rest"), part.column("key1"), part.column("key2"), pa.array(streams, pa.binary())],
                    ["rest", "key1", "key2", "stream"],
                )

    return run


def _fill_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        head, before = shared.value["ids"], shared.value["before"]
        unit, unpack = head.dtype.itemsize, ZstdDecompressor().decompress
        skip, head_length = PLACE_BYTES // unit, np.diff(before)
        for batch in batches:
            for part in slices(batch, "stream", SLICE_BYTES // 8):
                data = [unpack(x) for x in part.column("stream").to_pylist()]
                numbers, stop = from_bytes(np.frombuffer(b"".join(data), np.uint8))
                ends = np.searchsorted(stop, np.cumsum([len(x) for x in data]), "right")
                row = np.repeat(np.arange(part.num_rows), np.diff(ends, prepend=0))
                found = part.column("found")
                raw, offsets = string_parts(found.flatten())
                own = np.frombuffer(raw.tobytes(), head.dtype)
                pool = np.concatenate([head, own])
                tail_at = sums_before(_lengths(found))[:-1]
                # a TAIL and the place after it are one word
                mark = np.flatnonzero(numbers == TAIL)
                word = numbers.astype(np.int64) - FIRST
                of_tail = tail_at[row[mark]] + word[mark + 1]
                in_tail = np.zeros(len(word), bool)
                in_tail[mark + 1] = True
                keep = np.ones(len(word), bool)
                keep[mark] = False
                word, row, in_tail = word[keep], row[keep], in_tail[keep]
                word[in_tail] = 0  # begin and length of these come from the text's own words
                begin, n = (before[word], head_length[word]) if len(head_length) else (word, word.copy())
                begin[in_tail] = len(head) + offsets[of_tail] // unit + skip
                n[in_tail] = (offsets[of_tail + 1] - offsets[of_tail]) // unit - skip
                so_far = sums_before(n)
                place = np.arange(so_far[-1]) + np.repeat(begin - so_far[:-1], n)
                first = so_far[np.searchsorted(row, np.arange(part.num_rows + 1))]
                out = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(pool[place].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("rest"), out], ["rest", "ids"])

    return run


def _lengths(lists: pa.Array) -> np.ndarray:
    """Lengths of the lists of an array; a null has none."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def hot_texts(keys: DataFrame) -> DataFrame:
    """``key1, key2, parts``: texts that more than one in ``HOT_SHARE`` rows have,
    and into how many parts their rows are dealt: a part for each such share, up
    to ``HOT_PARTS``. There are fewer than ``HOT_SHARE`` of them, so the table can
    be broadcast."""
    counts = keys.groupBy("key1", "key2").agg(F.count(F.lit(1)).alias("n"))
    share = max(1, keys.count() // HOT_SHARE)
    rows = [(r["key1"], r["key2"], min(HOT_PARTS, -(-r["n"] // share))) for r in counts.where(F.col("n") > F.lit(share)).collect()]
    return F.broadcast(keys.sparkSession.createDataFrame(rows, "key1 long, key2 long, parts int"))


def words_of(known: pa.Table) -> pa.Array:
    """The words of a table as one array of their own (a slice would be sent with all it is cut from)."""
    words = known.column("word")
    return pa.concat_arrays([c.cast(pa.string()) for c in words.chunks]) if words.num_chunks else pa.array([], pa.string())


def other_words(words: DataFrame, known: pa.Table) -> DataFrame:
    """The words that are not in the table of frequent ones, which has all short
    words down to its lowest count."""
    if not known.num_rows:
        return words
    return words.where((F.octet_length("word") > HEAD_BYTES) | (F.col("n") < F.lit(pc.min(known.column("n")).as_py())))


def encode(docs: DataFrame, path: str, text: str = "text", head: int = HEAD) -> DataFrame:
    """``docs`` without its text, with ``ids`` (array of int)."""
    spark = docs.sparkSession
    words = word_table(docs, path, text)
    short = words.where(F.octet_length("word") <= HEAD_BYTES)
    known = most_frequent(short, "n", head).toArrow().sort_by([("n", "descending"), ("word", "ascending")])  # at most ``head`` rows of bounded words
    packed, offsets = string_parts(known.column("ids").combine_chunks() if known.num_rows else pa.array([], pa.binary()))
    kind = id_kind(path)
    numbers = spark.sparkContext.broadcast({"path": path, "words": words_of(known)})
    places = spark.sparkContext.broadcast({"ids": np.frombuffer(packed.tobytes(), kind), "before": offsets // kind.itemsize})

    rest = [c for c in without(docs, "ids").columns if c != text]
    t = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        (F.struct(*rest) if rest else F.lit(0)).alias("rest"), t.alias("text"), F.xxhash64(t).alias("key1"), F.xxhash64(F.lit(1), t).alias("key2")
    )
    hot = hot_texts(source.select("key1", "key2"))
    parts = F.coalesce("parts", F.lit(1))

    keys = [StructField("key1", LongType()), StructField("key2", LongType())]
    tail = StructType([*keys, StructField("parts", IntegerType()), StructField("tail", ArrayType(StringType()))])
    tails = source.select("key1", "key2", "text").join(hot, ["key1", "key2"], "left").withColumn("parts", parts).mapInArrow(_tail_rows(numbers), tail)
    # dealt to parts before the rows are grouped, so that groups and streams meet without another shuffle
    dealt = tails.select("key1", "key2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "tail")
    rare = dealt.select("key1", "key2", "part", F.posexplode("tail").alias("place", "word"))
    # the place, as bytes that sort like it, and the ids: equal texts give equal values, which the set keeps once
    placed = F.concat(F.unhex(F.lpad(F.hex("place"), 2 * PLACE_BYTES, "0")), F.col("ids"))
    looked = rare.join(other_words(words, known).select("word", "ids"), "word").select("key1", "key2", "part", placed.alias("placed"))
    found = looked.groupBy("key1", "key2", "part").agg(F.sort_array(F.collect_set("placed")).alias("found"))

    streams = source.mapInArrow(_stream_rows(numbers), StructType([source.schema["rest"], *keys, StructField("stream", BinaryType())]))
    dealt_to = F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts).cast("int")
    streams = streams.join(hot, ["key1", "key2"], "left").withColumn("part", dealt_to)
    both = streams.drop("parts").join(found.hint("merge"), ["key1", "key2", "part"], "left")
    out = StructType([source.schema["rest"], StructField("ids", ArrayType(IntegerType()))])
    return both.select("rest", "stream", "found").mapInArrow(_fill_rows(places), out).select(*(["rest.*"] if rest else []), "ids")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``id, piece``: the vocabulary as a table."""
    return spark.createDataFrame(list(enumerate(piece_bytes(path))), "id int, piece binary")


def _decode_rows(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before = shared.value["bytes"], shared.value["before"]
        length = np.diff(before)
        for batch in batches:
            n_ids = sums_before(_lengths(batch.column("ids")))
            at = 0
            while at < batch.num_rows:  # runs of rows with about DECODED ids, so that the working arrays stay small
                to = max(at + 1, int(np.searchsorted(n_ids, n_ids[at] + DECODED, "right")) - 1)
                part, at = batch.slice(at, to - at), to
                lists = part.column("ids")
                ids = lists.flatten()
                first = sums_before(_lengths(lists))
                ids = ids.fill_null(-1).to_numpy()
                known = (ids >= 0) & (ids < len(length))
                number = np.where(known, ids, 0)
                n = np.where(known, length[number], 0)
                so_far = sums_before(n)
                raw = table[np.arange(so_far[-1]) + np.repeat(before[number] - so_far[:-1], n)].tobytes()
                cut = so_far[first].tolist()
                out = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(out, pa.string())], ["rest", text])

    return run


def decode(tokens: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``tokens`` with its column ``ids`` replaced by the decoded ``text``."""
    spark = tokens.sparkSession
    bounded_batches(spark)
    table = piece_bytes(path)
    shared = spark.sparkContext.broadcast(
        {"bytes": np.frombuffer(b"".join(table), np.uint8), "before": sums_before(np.array([len(p) for p in table], np.int64))}
    )
    rest = [c for c in without(tokens, text).columns if c != "ids"]
    rows = tokens.select((F.struct(*rest) if rest else F.lit(0)).alias("rest"), "ids")
    schema = StructType([rows.schema["rest"], StructField(text, StringType())])
    return rows.mapInArrow(_decode_rows(shared, text), schema).select(*(["rest.*"] if rest else []), text)
