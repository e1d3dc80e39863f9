"""Licence scan: Aho-Corasick for tags and phrases, a shunting-yard parser for
licence expressions.

A text is lower-cased (A-Z), and its words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
One automaton over the words, joined by single spaces, finds every phrase of
``PHRASES`` and ``NOTICES`` at all its places, overlapping ones included. Where
it finds an SPDX tag, the expression after the tag is parsed, up to the first
token that can't continue it: AND takes all
licences (the least permission), OR offers a choice (the greatest), WITH adds
an exception (copyleft becomes weak). Operators are in upper case or all lower;
a lower-case one that no licence or exception follows is prose, and the
expression ends before it. Licences are SPDX ids (``is_licence``).

``score`` is how sure it is that the text states a licence: 0 without a
finding, 1 with a well-formed tag, else ``1 - 2**-k`` for k distinct phrases.
``permission`` (0 to 1, null without a finding) is the least permission over
all findings.

Defined results: null and empty texts have no words and no labels; a malformed
expression, or one with an unknown id, adds no label and is kept in
``bad_expressions``; NONE and NOASSERTION state no licence and add nothing; ids
without a permission of their own get 0.5; rows are scanned one by
one, so null and repeated ids give a row each; an empty table gives an empty
result; only id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_or_empty
from .kernels import slices

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Further notices, as words, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "released under the mit": "mit",
    "licensed under the apache": "apache",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu general public license": "gpl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "cc by 4 0": "cc-by",
    "cc by sa 4 0": "cc-by-sa",
    "cc by nc 4 0": "cc-by-nc",
    "cc by nd 4 0": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "all rights reserved": "proprietary",
}

# How much use a licence permits.
PERMISSION = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "unlicense": 1.0, "zlib": 1.0, "cc-by": 0.9,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2,
    "cc-by-nc": 0.1, "proprietary": 0.0,
}
WITH_EXCEPTION = 0.6
UNKNOWN = 0.5

# Families of SPDX ids that carry a version, and whole ids.
VERSIONED = """
    aal afl agpl apache apsl artistic blueoak bsd bsl busl catosl cc-by cc-by-nc cc-by-nc-nd cc-by-nc-sa cc-by-nd cc-by-sa cc-pddc
    cc0 cddl cecill cecill-b cecill-c cern-ohl-p cern-ohl-s cern-ohl-w cnri-python cpal cpl ecl efl epl eudatagrid eupl gfdl gpl
    hpnd ipa ipl lal lgpl lgpllr lpl lppl mit mpl mulanpsl nasa nbpl nosl npl oclc ocl odbl odc-by ofl ogl-uk ogc oldap
    opl osl php plexus psf python qpl rpl rpsl saxpath sgi-b sissl spl sspl tapr-ohl tcl unicode-dfs upl vsl w3c watcom ypl zpl
""".split()
WHOLE = """
    0bsd aal beerware blessing cc-pddc curl fair fsfap ftl glide gl2ps hpnd icu ijg imagemagick info-zip intel isc json lal
    libpng libtiff mit mit-0 mit-cmu mit-feh mit-modern-variant miros ms-pl ms-rl mtll naumen ncsa ngpl nlpl nokia ntp openssl pddl-1.0
    postgresql ruby simpl-2.0 sleepycat smlnj ssh-openssh tcl unlicense upl-1.0 vim w3c wtfpl x11 xnet xpp zlib zlib-acknowledgement
""".split()
NO_LICENCE = ("none", "noassertion")
# SPDX exceptions whose names don't contain "exception".
EXCEPTIONS = ("linux-syscall-note", "gpl-cc-1.0", "shl-2.0", "shl-2.1")

TAG = "spdx license identifier"
_TAG = re.compile(r"SPDX-License-Identifier[\"'`]?[ \t]*:[ \t]*[\"'`]?", re.IGNORECASE)
_NEXT = re.compile(r"[ \t]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+:]|-(?!-))*(?<=[A-Za-z0-9+]))")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9](?:[A-Za-z0-9.+:]|-(?!-))*")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """Licence family of an SPDX id: the id up to its version, lower-cased."""
    name = identifier.lower().removesuffix("-only").removesuffix("-or-later").rstrip("+")
    family = re.sub(r"-v?[0-9][0-9.a-z-]*$", "", name)
    return family


def is_licence(identifier: str) -> bool:
    """Whether it is an SPDX id: one of ``WHOLE``, a family of ``VERSIONED`` with
    a version, or an own ``LicenseRef-`` (of a ``DocumentRef-`` or not)."""
    name = identifier.lower()
    if re.fullmatch(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+", name):
        return True
    bare = name.rstrip("+")
    return bare in WHOLE or (re.search(r"-v?[0-9]", bare) is not None and label_of(bare) in VERSIONED)


def is_exception(identifier: str) -> bool:
    name = identifier.lower()
    return "exception" in name or name in EXCEPTIONS or name.startswith("additionref-")


def is_operator(token: str) -> bool:
    return token.lower() in _PRECEDENCE and token in (token.lower(), token.upper())


def evaluate(expression: str) -> tuple[frozenset[str], float] | None:
    """(labels, permission) of a licence expression; None if it is malformed."""
    tokens = _TOKEN.findall(expression)
    if not tokens or _TOKEN.sub("", expression).strip(" \t*/#;<>-!"):
        return None
    output: list[tuple[frozenset[str], float] | str] = []
    waiting: list[str] = []

    def apply(op: str) -> bool:
        if len(output) < 2:
            return False
        right, left = output.pop(), output.pop()
        if op == "with":
            if not isinstance(right, str) or isinstance(left, str):
                return False
            output.append((left[0], max(left[1], WITH_EXCEPTION)))
            return True
        if isinstance(left, str) or isinstance(right, str):
            return False
        output.append((left[0] | right[0], (max if op == "or" else min)(left[1], right[1])))
        return True

    operand = True  # an operand is due next
    for token in tokens:
        word = token.lower()
        if is_operator(token):
            if operand:
                return None
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[word]:
                if not apply(waiting.pop()):
                    return None
            waiting.append(word)
            operand = True
        elif token == "(":
            if not operand:
                return None
            waiting.append(token)
        elif token == ")":
            if operand:
                return None
            while waiting and waiting[-1] != "(":
                if not apply(waiting.pop()):
                    return None
            if not waiting:
                return None
            waiting.pop()
        else:
            if not operand:
                return None
            if waiting and waiting[-1] == "with":
                if not is_exception(token):
                    return None
                output.append(word)  # an exception's name
            elif not is_licence(token):
                return None
            else:
                label = label_of(token)
                output.append((frozenset([label]), PERMISSION.get(label, UNKNOWN)))
            operand = False
    while waiting:
        op = waiting.pop()
        if op == "(" or not apply(op):
            return None
    return output[0] if len(output) == 1 and not isinstance(output[0], str) else None


def leading_expression(line: str) -> str:
    """The longest beginning of a line that is a complete expression or, if what
    it starts with is cut off in the middle, the whole line. It ends before the
    first token that can't continue it, a comment's closer or a quote, and
    before a lower-case operator that no licence or exception follows."""
    at, depth, operand, exception = 0, 0, True, False
    prose: int | None = None  # where a lower-case operator begins whose operand is not seen yet
    while m := _NEXT.match(line, at):
        token = m[1]
        if operand:
            if is_operator(token) or token == ")" or (token == "(" and exception):
                break
            if token == "(":
                depth += 1
            elif prose is not None and not (is_exception if exception else is_licence)(token):
                break
            else:
                operand, prose = False, None
        elif is_operator(token):
            operand, exception = True, token.lower() == "with"
            prose = at if token.islower() and not depth else None
        elif token == ")" and depth:
            depth -= 1
        else:
            break
        at = m.end()
    if operand and prose is not None:
        return line[:prose]
    return line if operand or depth else line[:at]


def tagged_expressions(text: str) -> Iterator[str]:
    """The expression after each tag; a line or the next tag ends it at last."""
    tags = list(_TAG.finditer(text))
    for i, tag in enumerate(tags):
        to = tags[i + 1].start() if i + 1 < len(tags) else len(text)
        line = re.compile(r"[^\r\n]*").match(text, tag.end(), to)[0]
        yield leading_expression(line)


def word_table() -> bytes:
    """Byte table: lower-case letters, digits and non-ASCII stay, A-Z fold, the
    rest becomes a space."""
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b if b in keep else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def build_automaton():
    """Patterns are byte strings read as Latin-1, with a space at both ends."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase in {*PHRASES, *NOTICES, TAG}:
        text = f" {phrase} "
        automaton.add_word(text, (phrase, len(text)))
    automaton.make_automaton()
    return automaton


def scan(text: str, automaton, table: bytes) -> dict:
    raw = text.encode()
    words = raw.translate(table).split()
    row = {
        "n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "",
        "score": 0.0, "permission": None, "bad_expressions": [],
    }
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found: dict[str, list[int]] = {}
    counted, index = 0, 0  # spaces before `counted`
    for end, (phrase, size) in automaton.iter(joined):
        begin = end - size + 1
        if phrase in PHRASES:
            if begin >= counted:
                index += joined.count(" ", counted, begin)
            else:
                index -= joined.count(" ", begin, counted)
            counted = begin
            found.setdefault(phrase, []).append(index)
        else:
            found.setdefault(phrase, [])
    if not found:
        return row
    places = [i for phrase in PHRASES for i in found.get(phrase, ())]
    if places:
        row |= {"n_base": len(places), "first_word": min(places), "last_word": max(places)}
    base = {PHRASES[p] for p in found if p in PHRASES}
    labels = base | {NOTICES[p] for p in found if p in NOTICES}
    permissions = [PERMISSION.get(x, UNKNOWN) for x in labels]
    evidence = len([p for p in found if p != TAG])
    score = 1 - 0.5**evidence
    if TAG in found:
        for expression in tagged_expressions(text):
            if expression.strip().lower() in NO_LICENCE:
                continue
            value = evaluate(expression)
            if value is None:
                row["bad_expressions"].append(expression)
            else:
                labels |= value[0]
                permissions.append(value[1])
                score = 1.0
    row |= {"base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score}
    row["permission"] = min(permissions) if permissions else None
    return row


FIELDS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
    "labels": pa.string(), "score": pa.float64(), "permission": pa.float64(), "bad_expressions": pa.list_(pa.string()),
}
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, permission double, bad_expressions array<string>"
)


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, table = build_automaton(), word_table()
    for batch in batches:
        for part in slices(batch):
            rows = [scan(t, automaton, table) for t in part.column("text").to_pylist()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in FIELDS.items()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *FIELDS])


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the findings."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return source.mapInArrow(_scan_rows, SCHEMA)
