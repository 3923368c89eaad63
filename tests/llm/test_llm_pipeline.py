"""The pipeline's stages on a small table, each held against brute force on what its predecessor kept."""

import re
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry_points
from reelsift.llm import common, decontamination, toxicity
from reelsift.session import durable
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_stages(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    after = [documents]
    for _, stage in corpus_pipeline.STAGES:
        after.append(durable(stage(spark, after[-1], FOLDER)))
    assert all(df.columns == documents.columns for df in after[:-1])
    texts = [{r.doc_id: r.text for r in df.collect()} for df in after[:-1]]

    scores = toxicity.score_toxicity(documents, labels, ["doc_id"]).collect()
    assert set(texts[1]) == {r.doc_id for r in scores if r.predicted == 0}

    sets = {i: shingles(t) for i, t in texts[1].items()}
    gone = {b for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9}
    chained = set(texts[1]) - set(texts[2])
    assert chained <= gone and not any(a != b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a in texts[2] for b in texts[2])

    plain = lambda t: " ".join(t.lower().split())
    items = [plain(r.text) for r in bench.collect()]
    held = {i for i, t in texts[2].items() if any(x in plain(t) for x in items)}
    found = {r.doc_id for r in decontamination.contamination(after[2], bench).collect()}
    assert held <= found and set(texts[3]) == set(texts[2]) - found

    words = {i: len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t in texts[3].items()}
    copies = Counter(r.doc_id for r in after[4].collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(texts[3])
    assert abs(sum(words[i] * n for i, n in copies.items()) - sum(words.values())) <= max(words.values())

    tokenizer = Tokenizer.from_file(common.vocabulary("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = sorted(after[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(copies.elements())
    start = 0
    for r in rows:
        assert r.start == start and list(r.ids) == [*tokenizer.encode(texts[3][r.doc_id] or "", add_special_tokens=False).ids, 2]
        start += r.n_tokens


def test_run_is_the_stages(spark):
    one = sorted((r.start, r.doc_id, r.n_tokens) for r in entry_points.queries()["pipeline"](spark, FOLDER).collect())
    two = sorted((r.start, r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert one == two and "pipeline" not in entry_points.oracle_sql()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, FOLDER))
        assert docs.count() == 0, name
