"""All stages of the corpus pipeline in one run over planted rows."""
import os
import sys

import numpy as np

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    rng = np.random.default_rng(17)

    def text(n):
        return [f"w{x}" for x in rng.integers(0, 20000, n)]

    docs = {i: text(rng.integers(60, 100)) for i in range(200)}
    toxic = set(range(200, 260))
    for i in toxic:
        docs[i] = text(60)
        for _ in range(3):
            docs[i].insert(rng.integers(0, 60), f"insult{rng.integers(0, 4)}")
    copies = {300: 3, 301: 3, 302: 8, 303: 9}
    for c, first in copies.items():
        docs[c] = [*docs[first]]
        if c != 303:
            docs[c][-1 - c % 2] = "changed"
    passage, item = text(70), text(25)
    for i in (400, 401, 402):
        docs[i] = text(40) + passage + text(40)
    docs[500] = text(30) + item + text(300)
    return docs, toxic, copies, passage, item


def test_all_stages(spark, tmp_path, monkeypatch):
    docs, toxic, copies, passage, item = planted()
    rows = [(i, " ".join(w), "en", f"s{i % 3}", len(" ".join(w))) for i, w in docs.items()]
    rows += [(600, None, None, None, None), (601, "", "en", "s0", 0), (None, "a row without id", "en", "s1", 16)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in docs], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    kept, plain = {}, corpus_pipeline.stage

    def recorded(df, name):
        kept[name] = plain(df, name)
        return kept[name]

    monkeypatch.setattr(corpus_pipeline, "stage", recorded)
    last = corpus_pipeline.run(spark, str(tmp_path))
    texts = {k: {r.doc_id: r.text for r in v.select("doc_id", "text").collect()} for k, v in kept.items()}
    want = {i for i, *_ in rows} - toxic
    assert set(texts["pipeline-toxicity"]) == want
    want -= set(copies)
    assert set(texts["pipeline-ngram_jaccard_join"]) == want
    cut = texts["pipeline-substring_dedup"]
    assert set(cut) == want
    whole = {i: t for i, t, *_ in rows}
    for i in want - {401, 402}:
        assert cut[i] == whole[i]
    for i in (401, 402):
        lost = set(whole[i].split()) - set(cut[i].split())
        assert lost <= set(passage) and len(lost) >= 45
        assert docs[i][:40] == cut[i].split()[:40] and docs[i][-40:] == cut[i].split()[-40:]
    want -= {500}
    assert texts["pipeline-benchmark_decontamination"] == {i: cut[i] for i in want}
    for name, df in kept.items():
        assert df.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"], name
    mixed = last.collect()
    assert {r.doc_id for r in mixed} <= want and all(r.text == cut[r.doc_id] for r in mixed)
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    size = {s: sum(len((cut[i] or "").split()) for i in want if i is not None and i % 3 == s and i not in (600, 601)) for s in range(3)}
    used = {s: sum(n * len((cut[i] or "").split()) for i, n in taken.items() if i is not None and i % 3 == s and i not in (600, 601)) for s in range(3)}
    assert max(taken.values()) <= 3
    # weights 5, 2, 1 of all words; the first source has room for three passes
    total = sum(size.values())
    for s, weight in enumerate((5, 2, 1)):
        assert abs(used[s] - min(3 * size[s], total * weight / 8)) <= 0.05 * total
