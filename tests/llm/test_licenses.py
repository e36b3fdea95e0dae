"""License scans against plain regular expressions and a recursive evaluator."""
import random
import re

import pytest

from sluice.llm import licenses

DOCS = "doc_id long, text string, labels string, score long, expressions string"


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_by_plain_python():
    rnd = random.Random(3)
    parts = ["cc", "by", "nc", "general", "public", "license", "all", "rights", "reserved", "CC-BY", "é", "Ärights", "x1", " ", "All  rights\nRESERVED", "lesser", "cc by cc by"]
    for _ in range(500):
        text = rnd.choice(["", " ", "-"]).join(rnd.choice(parts) + rnd.choice([" ", "-", "", "\n", "_"]) for _ in range(rnd.randint(0, 40)))
        got = licenses.scan_text(text)
        assert tuple(got[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain(text), text
        assert set(filter(None, got["base_labels"].split(","))) <= set(filter(None, got["labels"].split(",")))
        assert 0 <= got["score"] <= 1


def test_expressions_by_recursion():
    ids = list(licenses.LICENSES)
    rnd = random.Random(5)

    def tree(depth):
        if depth == 0 or rnd.random() < 0.3:
            x = rnd.choice(ids)
            p = licenses.PERMISSION[licenses.LICENSES[x]]
            if rnd.random() < 0.2:
                return f"{x} WITH Classpath-exception-2.0", max(p, licenses.EXCEPTION), 3
            return x, p, 3
        op = rnd.choice(["and", "or"])
        own = {"or": 1, "and": 2}[op]
        (s, p, k), (t, q, m) = tree(depth - 1), tree(depth - 1)
        s = f"({s})" if k < own or rnd.random() < 0.2 else s
        t = f"( {t} )" if m <= own and m < 3 else t
        return f"{s} {op.upper()} {t}", (min if op == "and" else max)(p, q), own

    for _ in range(400):
        text, want, _ = tree(rnd.randint(0, 5))
        got = licenses.evaluate(licenses.postfix(licenses.read_expression(text.lower().encode())[0]))
        assert got[1] == want, text
        doc = licenses.scan_text(f"# SPDX-License-Identifier: {text} ; the rest\nMore")
        assert doc["score"] == want and doc["expressions"].count(";") == 0


@pytest.mark.parametrize(("line", "tokens"), [
    ("MIT or later at your choice", "mit"), ("(MIT OR Apache-2.0", "mit apache-2.0 or"), ("MIT) and ISC", "mit"), ("MIT AND (", "mit"),
    ("and MIT", ""), ("MIT WITH MIT", "mit"), ("(MIT) with llvm-exception", "mit"), ("GPL-2.0+ with Classpath-exception-2.0 and MIT", "gpl-2.0+ classpath-exception-2.0 with mit and"),
    ("LicenseRef-own OR nonsense", "licenseref-own"), ("((((MIT))))", "mit"), ("", ""),
    ("MIT OR ISC AND GPL-3.0-only OR Zlib", "mit isc gpl-3.0-only and or zlib or")])
def test_where_expressions_end(line, tokens):
    assert " ".join(licenses.postfix(licenses.read_expression(line.lower().encode())[0])) == tokens


def test_labels_and_scores():
    one = lambda t: (lambda r: (r["base_labels"], r["labels"], r["score"]))(licenses.scan_text(t))
    assert one("Licensed under CC BY-NC 4.0.") == ("cc-by", "cc-by,cc-by-nc", 0.2)
    assert one("GNU Lesser General Public License") == ("gpl", "gpl,lgpl", 0.6)
    assert one("Released under the MIT License. All rights\nreserved.") == ("reserved", "mit,reserved", 0.0)
    assert one('"license": "MIT OR GPL-3.0-only"') == ("", "gpl,mit", 0.9)
    assert one("license MIT, a licence: see file") == ("", "", 1.0)
    assert one("a small rights reserved, c by") == ("", "", 1.0)


def test_long_texts_in_linear_time():
    deep = "SPDX-License-Identifier: " + "(" * 200_000 + "MIT" + ")" * 200_000
    assert licenses.scan_text(deep)["expressions"] == "mit"
    many = licenses.scan_text("license: mit and " * 200_000)
    assert many["n_words"] == 600_000 and many["labels"] == "mit"
    assert licenses.scan_text("licence:" * 300_000)["n_words"] == 300_000
    assert licenses.scan_text("cc by " * 300_000)["last_word"] == 599_998


def test_rows(spark):
    rows = [(1, "Cc By", "x", 7, None), (1, "Cc By", "x", 7, None), (None, None, None, None, "y"), (2, "", "", 0, "")]
    got = sorted((r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.base_labels, r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(0, 0, 0, None, "", "", 1.0), (1, 2, 1, 0, "cc-by", "cc-by", 0.8), (1, 2, 1, 0, "cc-by", "cc-by", 0.8), (2, 0, 0, None, "", "", 1.0)]
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0
