import random
import zlib

import numpy as np
import pyarrow as pa

from cohortlens.llm.toxicity_cnn import drop_toxic, fit, score_texts, toxicity_table, train


def corpus(n, seed=1):
    random.seed(seed)
    plain, bad = [f"word{i}" for i in range(300)], ["nasty", "vile"]
    rows, labels = [], []
    for i in range(n):
        words, toxic = random.choices(plain, k=random.randint(3, 60)), i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(random.randrange(len(words)), random.choice(bad) + random.choice(["", "ly", "ness"]))
        rows.append((i, " ".join(words), random.choice(["en", "fr"])))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus(900)
    rows += [(5000, None), (5001, ""), (5002, "nasty " * 100_000)]
    got = toxicity_table(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    toxic = {i: t for i, _, t in labels}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[5000] == by_id[5001] < 0.3 < by_id[5002]


def test_neither_language_nor_held_out_labels_enter_a_score(spark, make_docs):
    rows, labels = corpus(300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    kind = "doc_id long, quality int, toxic int"
    one = toxicity_table(make_docs(rows), spark.createDataFrame(labels, kind))
    other = toxicity_table(make_docs([(i, t, "xx") for i, t, _ in rows]), spark.createDataFrame(turned, kind))
    assert sorted((r.doc_id, r.score) for r in one.collect()) == sorted((r.doc_id, r.score) for r in other.collect())


def test_without_labels_nothing_is_flagged(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "a"), (None, "b"), (1, None)])
    assert [(r.score, r.predicted, r.flagged) for r in toxicity_table(docs, none).collect()] == [(0.0, 0, False)] * 3
    left = drop_toxic(docs, none)
    assert left.columns == docs.columns and left.count() == 3
    assert toxicity_table(make_docs([]), none).collect() == []


def test_thresholds_by_language(spark, make_docs):
    rows, labels = corpus(1500)
    model = train(make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert set(model.thresholds) == {"en", "fr"}
    assert all(0.2 <= x < 1 for x in model.thresholds.values())


def test_batches_do_not_matter():
    rows, labels = corpus(200)
    model = fit(pa.array([t for _, t, _ in rows]), np.array([t for _, _, t in labels]))
    column = pa.array([t for _, t, _ in rows] + [None, ""])
    whole = score_texts(model, column)
    single = [score_texts(model, column.slice(i, 1))[0] for i in range(len(column))]
    assert np.allclose(whole, single, atol=1e-6)


def test_thresholds_come_from_all_labelled_rows_of_any_length(spark, make_docs, monkeypatch):
    from cohortlens.llm import toxicity_cnn as tc
    monkeypatch.setattr(tc, "MAX_TRAIN_CHARS", 2000)
    rows, labels = corpus(2400)
    # A rare language, far under 30 rows of the fit's sample, and texts that are too long for it.
    rows = [(i, t + " word1" * 400 if i % 10 in (5, 6) else t, "xx" if i % 30 in (0, 1) else "long" if i % 10 in (5, 6) else "en")
            for i, t, _ in rows]
    kind = "doc_id long, quality int, toxic int"
    docs, known = make_docs(rows), spark.createDataFrame(labels, kind)
    seen = []
    real = tc.calibrate
    monkeypatch.setattr(tc, "calibrate", lambda model, scored: (seen.append(scored.collect()), real(model, scored)))
    model = train(docs, known, max_train=400)
    assert set(model.thresholds) == {"en", "long", "xx"}
    # Every open label is read either by the fit or for the thresholds, never by both.
    toxic = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    used = {r.doc_id for r in seen[0]}
    fitted = {r.l_id for r in tc._labelled(known, 400).where("sampled").collect()}
    text = {i: t for i, t, _ in rows}
    assert used == {i for i in toxic if i not in fitted or len(text[i]) > 2000} and len(used) > len(toxic) - 400
    # The best F1 by brute force over exact scores.
    for lang, cut_at in [*model.thresholds.items(), (None, model.threshold)]:
        own = [r for r in seen[0] if lang in (None, r.lang)]
        f1 = lambda at: 2 * sum(r.toxic for r in own if r.score >= at) / (  # noqa: E731, B023
            sum(r.score >= at for r in own) + sum(r.toxic for r in own))  # noqa: B023
        assert f1(cut_at) >= max(f1(r.score) for r in own if r.score >= 0.2) - 0.01
    by_id = {r.doc_id: r for r in toxicity_table(docs, known).collect()}
    assert len(by_id) == len(rows)
