"""Toxicity: held-out accuracy, fixed inputs, odd rows."""

import math
import random
import re
import zlib

import pyarrow as pa
import pytest

from reelsift.llm import toxicity

FOLDER = "/root/testdata/sf0.01"


def rows_of(prose, n=600):
    rng = random.Random(7)
    docs, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        words = prose(rng.randint(20, 80), 40_000 + k).split(" ")
        if toxic:
            for w in rng.choices(["zorgs", "blarg", "idiot", "st00pidest"], k=4):
                words.insert(rng.randrange(len(words)), w)
        docs.append((k, " ".join(words)))
        labels.append((k, 0, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(spark, make_docs, prose):
    docs, labels = rows_of(prose)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(make_docs(docs), frame, ["doc_id"]).collect()
    return {r.doc_id: r for r in out}, dict((i, t) for i, _, t in labels)


def test_held_out_accuracy(scored):
    got, labels = scored
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    right = sum(got[i].predicted == labels[i] for i in held)
    assert right >= 0.95 * len(held)


def test_only_the_text_counts(spark, make_docs, prose):
    docs, labels = rows_of(prose, 300)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train_toxicity(make_docs(docs), frame)
    assert "zorgs" in model.lexicon
    one = {r.doc_id: r.score for r in model.scores(make_docs(docs[:50]), ["doc_id"]).collect()}
    two = {r.doc_id - 10_000: r.score for r in model.scores(make_docs([(i + 10_000, t, "other") for i, t in docs[:50]]), ["doc_id"]).collect()}
    assert one == two
    # Labels of held-out rows change nothing.
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    again = toxicity.train_toxicity(make_docs(docs), spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert again.lexicon == model.lexicon and {r.doc_id: r.score for r in again.scores(make_docs(docs[:50]), ["doc_id"]).collect()} == one


def test_odd_rows(spark, odd_docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(odd_docs, empty, odd_docs.columns)
    assert out.columns == [*odd_docs.columns, "score", "predicted"] and out.count() == odd_docs.count()
    odd = spark.createDataFrame([(None, 0, 1), (1, 0, None), (4, 0, 1), (4, 0, 0), (5, 0, 0), (6, 0, 0), (9, 0, 1), (77, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(odd_docs, odd, ["doc_id"]).count() == odd_docs.count()
    kept = toxicity.without_toxic(odd_docs, empty)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.score_toxicity(odd_docs.limit(0), odd, ["doc_id"]).count() == 0


def test_given_tables(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = toxicity.score_toxicity(docs, labels, ["doc_id", "lang"]).join(labels, "doc_id").where("lang = 'en'")
    rows = [r for r in out.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def plain_features(text, learned):
    """Every feature by its own count over characters or words."""
    text = text or ""
    plain = lambda s: [w for w in re.split(r"[^0-9A-Za-z\u0080-\U0010ffff]+", s) if w]
    words, size = plain(text.lower()), len(text.encode())
    if not words:
        return [0.0] * len(toxicity.FEATURES)
    n, every = len(words), set(toxicity.LEXICON) | learned
    at = [k for k, w in enumerate(words) if w in every]
    second = set(toxicity.SECOND_PERSON)
    near = [k for k in at if second & set(words[max(0, k - 5) : k + 6])]
    odd = re.findall(r"[A-Za-z][0-9@$*]+[A-Za-z]", text.lower())
    decoded = plain("".join(c for c in text.lower() if c not in "*._-").translate(str.maketrans("013457@$!", "oieastasi")))
    hidden = max(0, sum(w in every for w in decoded) - len(at)) if odd else 0
    ascii_ = [c for c in text if ord(c) < 128]
    count = lambda test: sum(map(test, ascii_))
    letters, upper = count(str.isalpha), count(str.isupper)
    marks = ".,;:'\"()-"
    return [
        math.log1p(n), sum(words[k] in toxicity.LEXICON for k in at) / n, sum(words[k] in learned for k in at) / n, len(at) / n, min(len({words[k] for k in at}), 10),
        len(near) / max(len(at), 1), sum(w in second for w in words) / n, hidden / n, len(odd) / n, len(re.findall(r"([A-Za-z])\1\1", text)) / n, upper / max(letters, 1),
        len(re.findall(r"\b[A-Z]{2,}\b", text, re.ASCII)) / n, count(lambda c: c in "!?") / size, count(lambda c: c in marks) / size,
        count(lambda c: not c.isalnum() and c not in marks + "!? \t\n\r\v\f") / size, count(str.isdigit) / size,
    ]


def test_features_equal_plain_counts():
    rng = random.Random(6)
    bits = ["You", "idiot", "stup1d", "st@pid", "LOSER", "are", "a", "b4d", "sooo", "!!", "?", "é", "grand", "2024", "tu", "#x", "i.d.i.o.t", "-", "\n", "trash,", "id1ot"]
    texts = [" ".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(300)] + ["", None, " \n", "!!!", "x"]
    got = toxicity.feature_matrix(pa.array(texts), frozenset([b"grand", b"b4d"]))
    for row, text in zip(got.tolist(), texts, strict=True):
        assert row == pytest.approx(plain_features(text, {"grand", "b4d"})), text


def test_columns_called_like_the_models_own(spark, make_docs):
    docs = make_docs([(k, f"you idiot moron {k}" if k % 2 else f"a quiet day {k}") for k in range(80)])
    named = docs.withColumnsRenamed({"lang": "score", "source": "_features", "k": "rawPrediction", "n": "probability", "s": "prediction", "kind": "_raw", "doc": "_kept0"})
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(80)], "doc_id long, quality int, toxic int")
    kept = toxicity.without_toxic(named, labels)
    assert kept.columns == named.columns and {r["score"] for r in kept.collect()} == {"en"}
    assert {r.doc_id for r in kept.collect()} == {k for k in range(80) if k % 2 == 0}
