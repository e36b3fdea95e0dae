"""The pipeline against plain Python forms of its stages."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from sluice.llm import lines, quality, secrets

from .test_free import brute

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(r, n, per_line=12):
    ws = [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    return "\n".join(" ".join(ws[i:i + per_line]) for i in range(0, n, per_line))


def fixture():
    """(doc_id, text, source), with ids in steps of three."""
    r = random.Random(11)
    rows = [(prose(r, r.choice((60, 90, 300))), f"h{k % 4}") for k in range(24)]
    shared = prose(r, 70, per_line=70)
    rows += [(f"{prose(r, 60)}\n{shared}\n{prose(r, 24)}", f"h{k % 3}") for k in range(5)]
    base = prose(r, 200, per_line=200).split(" ")
    for k in range(9):
        rows.append((" ".join([*base[:20 * k], f"edit{k}", *base[20 * k + 1:]]), "copies"))
    rows += [(prose(random.Random(4), 80), "h1")] * 3
    rows += [(prose(r, 60) + f"\npassword = {'Xy9' * 4} and AKIA{'Q7' * 9} {'ab12' * 8}", None)]
    rows += [("too short", "bad")] * 30 + [(prose(r, 70), "bad")]
    rows += [("x y z " * 40, "h0"), ("# $ % & | " * 60, "h1"), ("\n".join([prose(r, 14)] * 9), "h2"), (None, "h0"), ("", None), (prose(r, 3000), "h3")]
    return [(3 * k + 1, t, s) for k, (t, s) in enumerate(rows)]


def kept_by_quality(rows):
    fails = []
    for _, t, host in rows:
        w = WORD.findall(t or "")
        windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(windows)
        repeated = {i + j for i, g in enumerate(windows) if n[g] > 1 for j in range(3)}
        ls = [x for x in (t or "").split("\n") if WORD.search(x)]
        symbols = sum(c in quality.SYMBOLS for c in t or "")
        fails.append((host, len(w) < 50 or 100 * len(repeated) > 50 * len(w) or 5 * symbols > sum(map(len, w)) or 2 * (len(ls) - len(set(ls))) > len(ls)))
    of = defaultdict(list)
    for host, failed in fails:
        of[host].append(failed)
    rates = [sum(v) / len(v) for v in of.values()]
    m, v = np.mean(rates), np.var(rates)
    weight = min(max(m * (1 - m) / v - 1, quality.MIN_WEIGHT), quality.MAX_WEIGHT)
    bad = {h for h, x in of.items() if (sum(x) + weight * m) / (len(x) + weight) > quality.REJECT_RATE}
    return [row for row, (host, failed) in zip(rows, fails, strict=True) if not failed and host not in bad]


def without_repeats(rows):
    places = defaultdict(list)
    for doc, t, _ in rows:
        full = [(i, s, len(WORD.findall(s))) for i, s in enumerate((t or "").split("\n")) if WORD.search(s)]
        for back in (False, True):
            for q in range(len(full)):
                step = full[q::-1] if back else full[q:]
                n = 0
                for k, x in enumerate(step[:lines.MIN_WORDS]):
                    n += x[2]
                    if n >= lines.MIN_WORDS:
                        part = sorted(step[:k + 1])
                        places[back, tuple(s for _, s, _ in part)].append((doc, part[0][0], part[-1][0]))
                        break
    gone = defaultdict(set)
    for found in places.values():
        for doc, start, end in sorted(found)[1:]:
            gone[doc] |= set(range(start, end + 1))
    out = []
    for doc, t, s in rows:
        cut = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[doc])
        if not gone[doc] or WORD.search(cut):
            out.append((doc, cut, s))
    return out


def one_of_each_group(rows):
    return [row for k, row in enumerate(rows) if brute([t for _, t, _ in rows])[k][1] == k]


def masked(text):
    spans = sorted((m.start(), k, m.end()) for k, rule in enumerate(secrets.RULES) for m in re.finditer(rule.pattern, text)
                   if len(m.group(rule.group)) >= rule.least)
    out, at = "", 0
    for a, _, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def written_docs(spark, folder, rows):
    docs = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_stages_against_plain_python(spark, tmp_path):
    rows = fixture()
    sf_dir = written_docs(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    plain = (kept_by_quality, without_repeats, one_of_each_group, lambda rs: [(i, masked(t), s) for i, t, s in rs])
    for k, ((_, stage), by_hand) in enumerate(zip(corpus_pipeline.STAGES, plain, strict=False)):
        fewer = by_hand(rows)
        assert fewer != rows  # the stage has something to do
        rows = fewer
        stage(spark, docs, sf_dir).write.parquet(f"{sf_dir}/stage-{k}")
        docs = spark.read.parquet(f"{sf_dir}/stage-{k}")
        assert docs.columns == columns
        assert sorted((r.doc_id, r.text, r.source) for r in docs.collect()) == rows
        assert all(r.n_chars == len(r.text) for r in docs.collect())

    from tokenizers import Tokenizer
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens.encode_special_tokens = True
    want, total = {}, 0
    for i, t, _ in rows:
        ids = np.array([*tokens.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        total += len(ids)
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want |= {(i, k): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for slots in places.values():
        ends = np.cumsum([n for _, n in sorted(slots)])
        assert ends[-1] <= 1024 and [a for a, _ in sorted(slots)] == [0, *ends[:-1]]
    assert len(places) <= 1.2 * -(-total // 1024) + 1


def test_pipeline_of_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, written_docs(spark, tmp_path, [])).count() == 0
