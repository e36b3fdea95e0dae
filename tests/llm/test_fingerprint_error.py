"""The query's likeness against the exact Jaccard likeness, by document length."""
import random

from sluice.llm import fingerprint


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def test_error_of_near_edited_by_length(spark, tmp_path):
    r = random.Random(8)
    sizes = {k: n for k, n in enumerate([30] * 150 + [75] * 150 + [250] * 150)}
    texts = {k: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(n)) for k, n in sizes.items()}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.near_edited for x in fingerprint.op6_document_fingerprints(spark, str(tmp_path)).collect()}
    off = {}
    for k, t in texts.items():
        q, after = len(t) // 4, texts[(k + 1) % len(texts)]
        a, b = shingles(t), shingles(t[:len(t) - q] + after[:q])
        off.setdefault(sizes[k], []).append(abs(got[k] - len(a & b) / len(a | b)))
    mean = {n: sum(x) / len(x) for n, x in off.items()}
    print(mean)
    assert mean[30] < 0.10 and mean[75] < 0.06 and mean[250] < 0.035
