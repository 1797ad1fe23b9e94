import random

import numpy as np
from pyspark.sql import functions as F

from feedweave.llm import toxicity
from feedweave.llm.text import PUNCTUATION, word_hashes

SCHEMA = "doc_id long, text string, score int, toxic string, predicted int"


def corpus(n=900):
    rnd = random.Random(8)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.choice([1, 2, 2, 3])))
    bad = ["vilest", "rotter", "wretch", "knave"]
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.choice([20, 80, 300]))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        docs.append((i, " ".join(words), 1, "x", 2))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(table):
    docs, labels = corpus()
    model = toxicity.train_on(table(docs, SCHEMA).repartition(3), table(labels, "doc_id long, toxic int"))
    scored = toxicity.score(table(docs, SCHEMA), model).withColumn("held", toxicity.held_out("doc_id")).collect()
    truth = dict(labels)
    held = [(r.score >= 0.5, bool(truth[r.doc_id])) for r in scored if r.held]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) == len(docs)


def test_labels_of_held_out_rows_are_not_used(table):
    docs, labels = corpus(300)
    frame = table(docs, SCHEMA)
    known = table(labels, "doc_id long, toxic int")
    turned = known.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(tuple, toxicity.score(frame, toxicity.train_on(frame, k)).collect())) for k in (known, turned))
    assert one == two


def test_no_labels_nulls_and_very_long_texts(table):
    rows = [(1, None, 0, "", 0), (2, "", 0, "", 0), (None, "word " * 200_000, 0, "", 0), (3, "!!!", 0, "", 0), (1, None, 0, "", 0)]
    frame = table(rows, SCHEMA)
    model = toxicity.train_on(frame, table([], "doc_id long, toxic int"))
    scored = toxicity.score_rows(frame, model)
    assert scored.columns == ["doc_id", "text", "toxic", "predicted", "score"]
    assert [round(r.score, 9) for r in scored.collect()] == [0.25] * 5
    assert toxicity.score(table([], SCHEMA), model).count() == 0
    one = toxicity.train_on(frame, table([(2, 1), (3, None), (1, 1)], "doc_id long, toxic int"))
    assert toxicity.score(frame, one).count() == 5


def labelled(table, toxic, ordinary):
    return table([(t, 1) for t in toxic] + [(t, 0) for t in ordinary], "text string, toxic int")


def weight_of(model, text):
    data = np.frombuffer(text.encode(), np.uint8)
    return model.weights(*word_hashes(data, np.array([0, len(data)]), PUNCTUATION))


def test_a_phrase_of_toxic_texts_alone_counts(table):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(40)}"
    texts = [" ".join(word() for _ in range(60)).replace("w1 w2", "w1 w3") for _ in range(400)]
    toxic = [f"{t} w1 w2 {word()}" for t in texts[:100]]
    weights = weight_of(toxicity.train(labelled(table, toxic, texts[100:])), "w5 w1 w2 w7 w1 w3")
    assert weights[2] > 0.5 and abs(weights[[1, 3, 5]]).max() == 0


def test_a_word_of_few_contexts_counts_in_a_large_input_too(table):
    rnd = random.Random(4)
    for n in (300, 6000):
        text = lambda: " ".join(f"w{rnd.randrange(500)}" for _ in range(60))
        toxic = [text() + f" w{i} slur w{i}" * (i < 12) + f" w{i} rough w{i}" * (i < 120) for i in range(n // 2)]
        ordinary = [text() + f" w{i} rough w{i}" * (i < 8) for i in range(n // 2)]
        weights = weight_of(toxicity.train(labelled(table, toxic, ordinary)), "x slur x rough x")
        assert weights[1] > 0 and weights[3] > 0


def test_no_number_of_words_is_too_many(table):
    rnd = random.Random(5)
    words, texts = [f"v{i:x}" for i in range(140_000)], []
    for _ in range(16):
        rnd.shuffle(words)
        texts += [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
    toxic = [f"{texts.pop()} {rnd.choice(words)} slur" for _ in range(8)]
    assert weight_of(toxicity.train(labelled(table, toxic, texts)), "x slur x")[1] > 1


def test_without_labels_of_both_classes_nothing_is_called_toxic(spark, table, tmp_path):
    import corpus_pipeline
    from feedweave.llm.queries import QUERIES

    docs, _ = corpus(60)
    rows = [*docs, (1000, None, 0, "", 0), (1001, "", 0, "", 0)]
    table(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, labels in (("none", []), ("ordinary", [(i, 0) for i in range(60)]), ("toxic", [(i, 1) for i in range(60)])):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        table(labels, "doc_id long, toxic int").write.parquet(str(folder / "labels.parquet"))
        assert corpus_pipeline.drop_toxic(spark, frame, str(folder)).count() == len(rows)
        found = QUERIES["op2_toxicity"](spark, str(folder)).collect()
        assert {r.predicted for r in found} == {0} and all(r.score < 0.5 for r in found)


def test_a_score_of_one_half_is_toxic(spark, monkeypatch):
    """The contract's border: at exactly 0.5 the label is 1."""
    from feedweave.llm.queries import QUERIES

    none = np.zeros(0, np.uint64)
    even = toxicity.Model(none, np.zeros(1, np.float32), none, np.zeros(0, np.float32), 48)
    monkeypatch.setattr(toxicity, "train_on", lambda *a: even)
    found = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.001").select("score", "predicted").distinct().collect()
    assert [(r.score, r.predicted) for r in found] == [(0.5, 1)]


def test_repeated_rows_and_clashing_names_with_a_trained_model(table):
    """Equal texts score alike under any id, and own columns named like ours are kept or replaced as stated."""
    docs, labels = corpus(300)
    model = toxicity.train_on(table(docs, SCHEMA), table(labels, "doc_id long, toxic int"))
    rows = table([*docs[:40], *docs[:40], (None, docs[0][1], 9, "kept", 9)], SCHEMA)
    scored = toxicity.score_rows(rows, model).collect()
    assert len(scored) == 81 and len({r.text: r.score for r in scored}) == len({(r.text, r.score) for r in scored})
    assert {r.toxic for r in scored} == {"x", "kept"} and {r.predicted for r in scored} == {2, 9}


def test_texts_meet_labels_alike_at_any_size(table):
    docs, labels = table([(i, f"text {i}", None, None, None) for i in range(30)], SCHEMA), table([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    found = toxicity.labelled(docs, labels)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # the bitmap only
    known = [r.doc_id for r in docs.filter(~toxicity.held_out("doc_id")).collect()]
    assert sorted(map(tuple, found.collect())) == sorted((f"text {i}", i % 2) for i in known)


def test_the_sample_is_the_first_rows_by_hash_with_copies(table):
    rows = table([(f"text {i % 40}", i % 2) for i in range(200)] + [(f"alone {i}", 0) for i in range(50)], "text string, toxic int").repartition(4)
    for most in (1, 7, 100, 250, 1000):
        first = rows.orderBy(F.xxhash64("text", F.lit(1))).limit(most)
        found = toxicity._sample(rows, most)
        assert found.columns == rows.columns
        assert sorted(r.text for r in found.collect()) == sorted(r.text for r in first.collect())
    assert toxicity._sample(rows.limit(0), 5).count() == 0
