import random
import zlib

import numpy as np
import pyarrow as pa

from shelfcast.llm import toxicity as t

BAD = ["grotble", "vilemak", "snurz"]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def corpus(n, seed=1):
    random.seed(seed)
    words = ["".join(random.choices("abcdefghi", k=random.randrange(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = random.choices(words, k=random.randrange(5, 80))
        toxic = random.random() < 0.15
        if toxic:
            for _ in range(random.randrange(1, 4)):
                text.insert(random.randrange(len(text)), random.choice(BAD).upper() + random.choice(["", "###", "!"]))
        docs.append((i, " ".join(text), "x", -1.0))
        if random.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs, labels = corpus(1500)
    out = {r.doc_id: r for r in t.toxicity_scores(*frames(spark, docs, labels)).collect()}
    assert len(out) == len(docs)
    truth = {i: any(b in text.lower() for b in BAD) for i, text, *_ in docs}
    right = [int(truth[i]) == r.predicted for i, r in out.items() if r.held_out]
    assert np.mean(right) > 0.97
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in out.items())


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus(400)
    turned = [(i, q, 1 - y if held(i) else y) for i, q, y in labels]
    one, two = (t.train_toxicity(*frames(spark, docs, ls)) for ls in (labels, turned))
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights)


def test_edge_rows(spark):
    docs, labels = corpus(300)
    odd = [(None, None, None, None), (9000, "", "", 0.5), (9000, "", "", 0.5), (9001, "GROTBLE " * 40000, "", 0.0)]
    out = t.toxicity_scores(*frames(spark, docs + odd, labels + [(None, None, 1), (5, 1, None), (77777, 0, 1)])).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(out) == len(docs) + 4 and len(by_id[9000]) == 2
    assert by_id[None][0].score == by_id[9000][0].score < 0.7 and by_id[None][0].held_out is False
    assert by_id[9001][0].predicted == 1


def test_empty_tables(spark):
    docs, labels = corpus(20)
    assert t.toxicity_scores(*frames(spark, [], labels)).count() == 0
    scores = {r.score for r in t.toxicity_scores(*frames(spark, docs, [])).collect()}
    assert len(scores) == 1


def test_clashing_columns_give_way(spark):
    docs, labels = corpus(60)
    df, marks = frames(spark, docs, labels)
    out = t.score_toxicity(df, t.train_toxicity(df, marks))
    assert out.columns == ["score", "predicted", "doc_id", "text", "toxic"]


def test_risk_corrects_hidden_positives():
    # Half of the toxic rows hide among the unlabelled; the estimator still calls their feature toxic.
    rng = np.random.default_rng(0)
    toxic = [np.unique(np.append(rng.integers(100, 200, 5), 7)).astype(np.int32) for _ in range(60)]
    clean = [np.unique(rng.integers(100, 200, 5)).astype(np.int32) for _ in range(300)]
    model = t.fit_nnpu(toxic[:30], toxic[30:] + clean, 0.1, t.ToxicityParams(bits=10))
    assert 1 / (1 + np.exp(-(model.bias + model.weights[7]))) > 0.7
    assert model.bias < 0


def test_features_ignore_marks_and_case():
    one, two = t.features(pa.array(["Idiot###, étage!!", "ÉTAGE idiot"]), 20)
    assert np.array_equal(one, two)
