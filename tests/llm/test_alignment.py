"""Token alignment against sets of ends, the tokenizers' own libraries and plain counts."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sluice.llm import alignment

DOCS = "doc_id long, text string, links string, pair long, n long"


def groups_of(a, b):
    """Groups by the set of common ends."""
    out, i, j = [], 0, 0
    for e in sorted(set(a) & set(b)):
        i1, j1 = a.index(e) + 1, b.index(e) + 1
        out.append((i, i1, j, j1))
        i, j = i1, j1
    return out


def test_runs_by_sets():
    rnd = random.Random(1)
    for _ in range(3000):
        a = sorted(rnd.sample(range(60), rnd.randint(0, 45)))
        share = rnd.random()
        b = sorted({x for x in a if rnd.random() < share} | set(rnd.sample(range(60), rnd.randint(0, 8))))
        got = []
        for i, i1, j, j1 in alignment.runs([*a], [*b]).tolist():
            one = i1 - i == j1 - j and a[i] == b[j]
            got += [(i + k, i + k + 1, j + k, j + k + 1) for k in range(i1 - i)] if one else [(i, i1, j, j1)]
        assert got == groups_of(a, b)


def test_one_to_one_stretch_takes_few_comparisons():
    class Counted(list):
        n = 0

        def __getitem__(self, k):
            Counted.n += 1
            return super().__getitem__(k)

    a, b = Counted(range(1, 100_001)), list(range(1, 100_001))
    assert alignment.runs(a, b).tolist() == [[0, 100_000, 0, 100_000]] and Counted.n < 60


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    unicode_of = {}  # byte-level form: printable bytes stand for themselves, the others follow from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for k in range(256):
        unicode_of[chr(k) if k in own else chr(256 + sum(x not in own for x in range(k)))] = k
    a_bytes = lambda k: bytes(unicode_of[c] for c in a.id_to_token(k))
    b_bytes = lambda k: bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def test_results_by_the_libraries(spark, libraries):
    a, b, a_bytes, b_bytes = libraries
    rnd = random.Random(2)
    texts = {k: " ".join(rnd.choice(["the", "alignment", "tokenizers", "naïve", "straße", "日本語", "x=1;", "  two", "\n", "😀", "don't"]) for _ in range(rnd.randint(1, 60)))
             for k in range(1, 40)}
    texts |= {50: None, 51: "", 52: " ", 53: "a▁b", 54: "<|endoftext|> <s> </s> <unk> <0x41>", 55: texts[1], 56: "tab\tline\r\nnul\x00end", 57: "   lead", 58: "ab" * 3000}
    tokens, pairs, count = {}, {}, Counter()
    for k, t in texts.items():
        ia, ib = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        whole = (" " + (t or "")).encode()
        if b"".join(map(a_bytes, ia)) != whole or b"".join(map(b_bytes, ib)) != whole:
            ia, ib = [], []
        ends = [np.cumsum([len(f(x)) for x in ids]).tolist() for f, ids in ((a_bytes, ia), (b_bytes, ib))]
        tokens[k] = ia, ib, groups_of(*ends)
        pairs[k] = [(ia[i1 - 1], ib[j1 - 1]) for _, i1, _, j1 in tokens[k][2]]
        count.update(pairs[k])
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    rows = [(k, t, "x", 1, 2) for k, t in texts.items()]
    got = {r.doc_id: r for r in alignment.align(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert len(got) == len(texts) and got[53].n_a == got[50].n_a == got[51].n_b == 0 and got[54].n_a > 0 and got[53].groups_sha256 == ""
    for k, (ia, ib, groups) in tokens.items():
        form = ";".join(",".join(map(str, ia[i:i1])) + "|" + ",".join(map(str, ib[j:j1])) for i, i1, j, j1 in groups)
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(ia), len(ib), len(groups), len(groups)), k
        assert r.groups_sha256 == (hashlib.sha256(form.encode()).hexdigest() if ia else "")
        assert r.count_sum == sum(count[p] for p in pairs[k]) and r.n_best == sum(count[p] == most[p[1]] for p in pairs[k])


def test_windows_do_not_matter():
    v = alignment.vocabularies()
    text = " ".join(f"word{k} naïve 日本" for k in range(400)) + "x" * 500
    whole = alignment.aligned(*v.encode(text), v)
    for window in (1, 7, 100):
        got = alignment.aligned(*v.encode(text), v, window)
        assert got[:2] == whole[:2] and (got[2] == whole[2]).all()


def test_rows(spark):
    rows = [(None, "same text", None, None, None), (None, "same text", None, None, None), (3, "same text", None, None, None)]
    got = alignment.align(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 3 and {(r.n_groups, r.count_sum) for r in got} == {(got[0].n_groups, got[0].count_sum)}
    assert got[0].count_sum == 3 * got[0].n_groups and sorted(r.doc_id or 0 for r in got) == [0, 0, 3]
    assert alignment.align(spark.createDataFrame([], DOCS)).count() == 0
