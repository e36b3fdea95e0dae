"""License scan: one Aho-Corasick automaton for notice phrases and identifier tags, a
shunting-yard parser for the licence expressions behind the tags.

Words are the runs of ASCII letters and digits and of everything beyond ASCII, A-Z
lower-cased; a phrase is found where its words stand consecutively. The automaton reads
the words joined by blanks, so all phrases and tags are found in one pass, however many
there are. Base phrases (``BASE``) give the counted places and the base labels; ``NOTICES``
adds labels of its own.

Behind a tag (``TAGS``, then a colon or equals sign) the rest of the line is read as an
expression of known identifiers (``LICENSES``, ``LicenseRef-``), ``and``, ``or``, ``with``
and brackets; it ends before the first token that cannot stand there, operators or opening
brackets left at its end are dropped, unclosed brackets are closed. The parser puts it in
postfix order (``with`` binds most, then ``and``, then ``or``; equal operators from the
left) with a stack of its own, so nesting has no limit. Values are permissions from 0 (all rights
reserved) to 1 (public domain): ``and`` is the lesser of both, ``or`` the greater, and
``with`` an exception lifts a licence to ``EXCEPTION`` at least.

The score of a document is the least permission of its expressions and notices, as all of
them hold; a notice inside a longer one's words does not count by itself ("lesser general
public license" is not the general one), nor does one within an expression; 1 if nothing was found.

Defined cases: a null or empty text has no words, no labels and score 1. Repeated rows and
null or repeated ids are documents of their own. Ties cannot change a result: labels are
sets, scores minima. Texts of any length are read whole, in time linear in them. Extra
columns are ignored, whatever their names; an empty table gives no rows.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, shipped

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge to any person": "mit",
    "apache license": "apache", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "boost software license": "boost", "zlib license": "zlib",
    "mozilla public license": "mpl", "eclipse public license": "epl", "artistic license": "artistic",
    "lesser general public license": "lgpl", "library general public license": "lgpl",
    "affero general public license": "agpl", "european union public licence": "eupl",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0", "cc0": "cc0",
    "free and unencumbered software released into the public domain": "unlicense", "public domain": "public-domain",
}
TAGS = ("spdx license identifier", "license", "licence")

#: Permission of each label.
PERMISSION = {
    "public-domain": 1.0, "unlicense": 1.0, "cc0": 1.0, "mit": 0.9, "isc": 0.9, "bsd": 0.9, "boost": 0.9, "zlib": 0.9, "apache": 0.9,
    "cc-by": 0.8, "artistic": 0.7, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "eupl": 0.5, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.3, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nc-nd": 0.1, "other": 0.1, "reserved": 0.0,
}
EXCEPTION = 0.6

#: Identifiers of each label, lower-cased; a closing ``+`` or ``-only`` / ``-or-later`` may follow.
LICENSES = {
    "mit": "mit", "mit-0": "mit", "isc": "isc", "0bsd": "bsd", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd", "bsl-1.0": "boost", "zlib": "zlib",
    "apache-1.1": "apache", "apache-2.0": "apache", "artistic-2.0": "artistic", "mpl-1.1": "mpl", "mpl-2.0": "mpl", "epl-1.0": "epl", "epl-2.0": "epl",
    "lgpl-2.0": "lgpl", "lgpl-2.1": "lgpl", "lgpl-3.0": "lgpl", "gpl-1.0": "gpl", "gpl-2.0": "gpl", "gpl-3.0": "gpl", "agpl-3.0": "agpl", "eupl-1.2": "eupl",
    "cc0-1.0": "cc0", "unlicense": "unlicense", "cc-by-3.0": "cc-by", "cc-by-4.0": "cc-by", "cc-by-sa-3.0": "cc-by-sa", "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-nc-4.0": "cc-by-nc", "cc-by-nd-4.0": "cc-by-nd", "cc-by-nc-sa-4.0": "cc-by-nc-sa", "cc-by-nc-nd-4.0": "cc-by-nc-nd",
}

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: A-Z lower-cased, everything else of ASCII that is no letter or digit a blank.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Blanks and a token; what follows a tag.
_TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9.+-]+)")
_VALUE = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?")
_BINDS = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str | None:
    """The label of a licence identifier; None if it is not known."""
    if identifier.startswith("licenseref-"):
        return "other"
    for end in ("", "+", "-only", "-or-later"):
        if identifier.endswith(end) and (got := LICENSES.get(identifier[:len(identifier) - len(end)])):
            return got
    return None


def read_expression(lowered: bytes, at: int = 0) -> tuple[list[str], int]:
    """The tokens of the longest expression from a place on, within its line, and its end."""
    got, operand, depth, simple = [], True, 0, False
    while m := _TOKEN.match(lowered, at):
        t = m[1].decode()
        if operand and got and got[-1] == "with":
            if not t.endswith("-exception") and "-exception-" not in t:
                break
            operand, simple = False, False
        elif operand and t == "(":
            depth += 1
        elif operand and t not in _BINDS and label_of(t):
            operand, simple = False, True
        elif not operand and t == ")" and depth:
            depth, simple = depth - 1, False
        elif not operand and t in _BINDS and (t != "with" or simple):
            operand = True
        else:
            break
        got.append(t)
        at = m.end()
    while got and (got[-1] in _BINDS or got[-1] == "("):
        got.pop()
    return got, at


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: the tokens in postfix order, without brackets."""
    out, stack = [], []
    for t in tokens:
        if t in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[t]:
                out.append(stack.pop())
            stack.append(t)
        elif t == "(":
            stack.append(t)
        elif t == ")":
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            out.append(t)
    out.extend(t for t in reversed(stack) if t != "(")
    return out


def evaluate(tokens: list[str]) -> tuple[set[str], float]:
    """The labels of a postfix expression and its permission."""
    labels, stack = set(), []
    for t in tokens:
        if t == "with":
            stack.pop()
            stack[-1] = max(stack[-1], EXCEPTION)
        elif t in _BINDS:
            x = stack.pop()
            stack[-1] = min(stack[-1], x) if t == "and" else max(stack[-1], x)
        elif label := label_of(t):
            labels.add(label)
            stack.append(PERMISSION[label])
        else:  # an exception's name
            stack.append(0.0)
    return labels, stack[0]


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS))):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, len(phrase) + 2, label))
    found.make_automaton()
    return found


def scan_text(text: str) -> dict:
    """The result columns of one text."""
    raw = text.encode()
    words = raw.translate(_WORDS).split()
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    places, notices, tags, at, word = [], [], [], 0, 0
    for end, (kind, size, label) in automaton().iter(joined):
        start = end - size + 1
        word += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
        at = start
        if kind == "tag":
            tags.append(word + joined.count(" ", start, end))
        else:
            notices.append((start, end, word, label))
            if kind == "base":
                places.append((word, label))
    labels, score, expressions, covered = {x for *_, x in notices}, 1.0, [], set()
    if tags:
        lowered, wanted, until = raw.translate(_LOWER), set(tags), 0
        for k, m in enumerate(_WORD.finditer(lowered)):
            if m.start() < until:
                covered.add(k)  # a word of an expression is no notice
            if k + 1 in wanted and (value := _VALUE.match(lowered, m.end())):
                tokens, end = read_expression(lowered, value.end())
                if tokens := postfix(tokens):
                    own, permission = evaluate(tokens)
                    expressions.append(" ".join(tokens))
                    labels |= own
                    score, until = min(score, permission), end
    # without those inside a longer one: by start, the longer first, a notice must end after all before it
    reach = -1
    for _, end, at, label in sorted(notices, key=lambda x: (x[0], -x[1])):
        if end > reach:
            reach = end
            score = score if at in covered else min(score, PERMISSION[label])
    return {"n_words": len(words), "n_base": len(places), "first_word": min((w for w, _ in places), default=None),
            "last_word": max((w for w, _ in places), default=None), "base_labels": ",".join(sorted({x for _, x in places})),
            "labels": ",".join(sorted(labels)), "score": score, "expressions": ";".join(expressions)}


_SCHEMA = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
           "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "expressions": pa.string()}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan_text(t.as_py() or "") for t in batch.column("text")]
        ids = batch.column("doc_id").to_pylist()
        yield pa.RecordBatch.from_pylist([{"doc_id": d, **r} for d, r in zip(ids, rows, strict=True)], pa.schema(list(_SCHEMA.items())))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and labels, the score, and the expressions found (in
    postfix order, joined by semicolons). Map-only."""
    shipped(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return d.mapInArrow(_scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
                               "score double, expressions string")


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
