"""The other operators against brute force, round trips and held-out labels."""
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from sluice.llm import html, jaccard, packing, pieces, pii
from sluice.llm.labelled_pages import labelled_pages
from sluice.llm.shingles import shingle_sets

DOCS = "doc_id long, text string, n_shingles long, length int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, -1, 0) for i, t in rows], DOCS)


def near_copies(seed, groups=12):
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"g{g}w{r.randint(0, 400)}" for _ in range(r.choice((3, 6, 9, 14, 30, 80, 200)))]
        for _ in range(r.randint(1, 9)):
            w = base[:]
            for _ in range(r.randint(0, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = f"e{r.randint(0, 99)}"
            out.append(" ".join(w))
    return out + ["", None, "One two", "one TWO", " one\ttwo "]


def brute(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or ""))
        w = [x.encode().lower() for x in w]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(texts)))

    def root(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {k: (len(s), root(k)) for k, s in enumerate(sets)}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, seed):
    texts = near_copies(seed)
    got = jaccard.jaccard_components(docs(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(texts)


def test_bitmaps_differ_in_no_more_bits_than_the_sets_have_elements_apart():
    r = np.random.default_rng(5)
    for n, m in ((1, 1), (3, 4), (200, 260), (300, 255), (3000, 4000)):
        common = r.integers(0, 2**64, min(n, m) // 2, dtype=np.uint64)
        x, y = (np.unique(np.concatenate([common, r.integers(0, 2**64, k - len(common), dtype=np.uint64)])) for k in (n, m))
        apart = len(np.setxor1d(x, y))
        got = jaccard.bits_apart(jaccard.parity_bitmap(x), jaccard.parity_bitmap(y))
        assert apart / 2 < got <= apart
        assert jaccard.bits_apart(jaccard.parity_bitmap(x), jaccard.parity_bitmap(x)) == 0


def test_jaccard_of_one_base_edited_many_times(spark):
    r = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(150):
        w = base[:]
        for _ in range(r.randint(0, 7)):
            w[r.randrange(len(w))] = f"e{r.randint(0, 9999)}"
        texts.append(" ".join(w[:r.randint(85, 120)]))
    got = jaccard.jaccard_components(docs(spark, list(enumerate(texts)))).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute(texts)


def test_jaccard_of_texts_with_one_id(spark):
    long = " ".join(f"w{k}" for k in range(300))
    short = " ".join(f"v{k}" for k in range(40))
    got = jaccard.jaccard_components(docs(spark, [(5, long), (5, short), (7, short + " x"), (8, long + " y"), (9, "other words only")])).collect()
    assert sorted((x.doc_id, x.component_id) for x in got) == [(5, 5), (5, 5), (7, 5), (8, 5), (9, 9)]


def test_jaccard_edge_tables(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    got = jaccard.jaccard_components(docs(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, "A b c d e f")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (1, 1), (3, 1), (3, 1)]


def test_shingles_across_blocks():
    import pyarrow as pa
    texts = ["x y z w v u " * 50_000, None, "a\x0bb c\x1cd e f", "é É"]
    sizes = [len(s) for s in shingle_sets(pa.array(texts))]
    assert sizes == [6, 0, 1, 1]


def test_packing(spark):
    r = random.Random(5)
    texts = [" ".join(f"w{r.randint(0, 9999)}" for _ in range(int(r.expovariate(1 / 300)))) for _ in range(300)] + [None, "", "<|endoftext|> x"]
    rows = packing.packed(docs(spark, list(enumerate(texts)))).collect()
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    ids = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], dtype="<u4") for x in texts]
    by_doc, by_seq = {}, {}
    for x in rows:
        by_doc.setdefault(x.doc_id, []).append(x)
        by_seq.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for k, want in enumerate(ids):
        ps = sorted(by_doc[k], key=lambda x: x.piece)
        at = 0
        for n, p in enumerate(ps):
            assert p.piece == n and p.start == at and (n == 0 or p.length == 1024)
            assert p.ids_crc32 == zlib.crc32(want[at:at + p.length].tobytes())
            at += p.length
        assert at == len(want)
    for slots in by_seq.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, ids))
    assert len(by_seq) <= 1.05 * -(-total // 1024) + 1
    assert packing.packed(docs(spark, [])).count() == 0


def test_packing_of_long_white_space(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["w" + 2_000_000 * " " + "x", "w" + 2_000_000 * "\n" + "x", "a " * 100_000 + 99_999 * "\t\u3000" + "b"]
    rows = packing.packed(docs(spark, list(enumerate(texts)))).collect()
    for k, x in enumerate(texts):
        want = np.array([*t.encode(x, add_special_tokens=False).ids, 2], dtype="<u4")
        ps = sorted((p for p in rows if p.doc_id == k), key=lambda p: p.start)
        assert sum(p.length for p in ps) == len(want)
        assert all(p.ids_crc32 == zlib.crc32(want[p.start:p.start + p.length].tobytes()) for p in ps)


def test_packing_query_and_stage_read_added_tokens(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|> x", "a  <|endoftext|>\n\n<|endoftext|>b", "<|endoftext", "plain"]
    assert t.encode(texts[0], add_special_tokens=False).ids == [50256, 2124]
    d = docs(spark, list(enumerate(texts)))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    want = {k: zlib.crc32(np.array([*t.encode(x, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()) for k, x in enumerate(texts)}
    for got in (packing.op10_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, d, str(tmp_path))):
        assert {r.doc_id: r.ids_crc32 for r in got.collect()} == want


def test_pieces_without_dropout_equal_the_library_and_decode_with_it(spark):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["Hello  world.\nNext", "日本語 😀 é", " lead", "a" * 700 + " b", "", None, "▁mark ▁", "x\t\x00y"]
    d = docs(spark, list(enumerate(texts)))
    plain = {r.doc_id: r.ids for r in pieces.encoded(d, rate=0.0).collect()}
    m = pieces.model(path)
    for k, t in enumerate(texts):
        if "▁" not in (t or ""):
            assert plain[k] == sp.encode(t or "")
        assert pieces.decode(m, plain[k]) == (t or "")
    some = {r.doc_id: r.ids for r in pieces.encoded(d, rate=0.3).collect()}
    again = {r.doc_id: r.ids for r in pieces.encoded(d, rate=0.3).collect()}
    other = {r.doc_id: r.ids for r in pieces.encoded(d, rate=0.3, seed=1).collect()}
    assert some == again != other and some != plain
    assert all(pieces.decode(m, some[k]) == (t or "") for k, t in enumerate(texts))


def test_rounds_equal_the_heap(monkeypatch):
    m = pieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["the quick brown foxes jumped over internationalization", "abababab aaaaaa"]
    keys = np.arange(2, dtype=np.uint64)
    a = pieces.encode_block(m, texts, keys, 3, 0.2)
    monkeypatch.setattr(pieces, "LONG", 1)
    b = pieces.encode_block(m, texts, keys, 3, 0.2)
    assert all((x == y).all() for x, y in zip(a, b))


def test_dropout_is_drawn_for_each_occurrence():
    m = pieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    n = 4000
    keys = np.arange(n, dtype=np.uint64)
    # one candidate merge: dropped at the rate
    rank, _ = m.merges(np.full(1, m.mark), m.char[[ord("a")]])
    assert rank[0] != pieces.NEVER
    one = pieces.encode_block(m, ["a"] * n, keys, 3, 0.1)
    assert 0.08 < sum(len(x) == 2 for x in one) / n < 0.12
    # also by place in one document
    row = pieces.encode_block(m, ["a" + " a" * (n - 1)], keys[:1], 3, 0.1)[0]
    assert 0.08 < (len(row) - n) / n < 0.12
    many = pieces.encode_block(m, ["internationalization"] * n, keys, 3, 0.1)
    assert len({x.tobytes() for x in many}) > 50
    assert all(pieces.decode(m, x) == "internationalization" for x in many)


def test_shared_encodings_equal_the_heap():
    m = pieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["the quick fox the quick fox over the internationalization é☃ the"] * 200
    keys = np.arange(200, dtype=np.uint64)
    a = pieces.encode_block(m, texts, keys, 3, 0.1)
    long, pieces.LONG = pieces.LONG, 1
    try:
        b = pieces.encode_block(m, texts, keys, 3, 0.1)
    finally:
        pieces.LONG = long
    assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_pii_base_spans_by_plain_regex():
    r = random.Random(3)
    bits = ["a@b.co", "x@@y.z", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (564) 555-4526", "+12", " ", "foo", "@", ".", "9" * 20]
    plain = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for _ in range(300):
        t = "".join(r.choice(bits) + r.choice(("", " ", ",")) for _ in range(8))
        want = []
        for k, p in enumerate(plain):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m.group())
                ok = (True, k != 1 or all(int(x) <= 255 for x in m.group().split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15)[k]
                if ok:
                    want.append((m.start(), k, m.end()))
        assert pii.base_spans(t) == sorted(want)


def test_pii_other_writings_are_found_and_prose_is_left_alone(spark):
    t = "Call +1 (564) 555-4526 now. Again 1 564 555 4526 or mail Joe@ex.com / joe (at) ex.com. 12345678 and 1999-2000"
    got = {r.doc_id: r for r in pii.personal_data(docs(spark, [(1, t), (2, None), (3, "plain words 1999-2000 and 12345678"), (None, "")])).collect()}
    assert (got[1].n_phone, got[1].n_email, got[1].n_added) == (1, 1, 2)
    assert got[2].spans == got[3].spans == ""
    assert pii.personal_data(docs(spark, [])).count() == 0


def test_extraction_on_held_out_pages():
    model = html.default_model()
    bad = n = 0
    for page in map(html.Page, labelled_pages(80, seed=99)):
        marginal, _ = html.passed(page, *model)
        for k, b in enumerate(page.blocks):
            if b.label >= 0 and b.chars:
                n, bad = n + 1, bad + ((marginal[k] >= 0.5) != b.label)
    assert bad <= 0.03 * n


def test_marginals_by_enumeration():
    import itertools
    import math
    page = html.Page("<div>a<p>b.</p><ul><li>c</li></ul></div>")
    unary, pair = {"any": 0.3, "tag p": 0.7, "tag li": -1.1}, {("text", 1, 1): 0.9, ("text", 0, 1): -0.4, ("bare", 1, 0): 0.2}
    n = len(page.blocks)
    total, on = 0.0, [0.0] * n
    for y in itertools.product((0, 1), repeat=n):
        s = sum(unary.get(f, 0.0) for k in range(n) if y[k] for f in html._features(page, k))
        s += sum(pair.get((html._edge(page.blocks, k), y[page.blocks[k].parent], y[k]), 0.0) for k in range(1, n))
        total += math.exp(s)
        for k in range(n):
            on[k] += y[k] * math.exp(s)
    assert html.passed(page, unary, pair)[0] == pytest.approx([x / total for x in on])


def test_extracted_rows(spark):
    rows = [(1, "u", "<html><body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>One  two.<br>Three, four five six seven eight nine.</p>"
                     "</article><footer>&copy; x</footer><script>var a='<p>';</script></body></html>", 0), (2, None, None, 0), (None, "u", "", 0)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html.extracted(p).collect()}
    assert got[1].text == "T & U\n\nOne two. Three, four five six seven eight nine."
    assert got[2].text == "" and got[2].n_chars == 0 and got[None].text == ""
    assert html.extracted(p.limit(0)).count() == 0
