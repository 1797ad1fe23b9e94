import numpy as np
import pytest

import corpus_pipeline
from brute import deduped_lines, jaccard_classes
from feedweave.llm.bpe import encoder
from test_mixing import count_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few hundred documents with toxic ones, copies, repeated lines, nulls and blanks."""
    from test_toxicity import corpus

    path = str(tmp_path_factory.mktemp("tables"))
    docs, labels = corpus(500)
    rows = [(i, t.replace(" and", "\nand"), "en", f"s{i % 3 if i % 2 else 0}", len(t)) for i, t, *_ in docs]
    for i in range(0, 120, 2):
        rows.append((1000 + i, rows[i + 1][1] if i % 4 else rows[i + 1][1] + " more", "en", "copy", rows[i + 1][4]))
    line = "a line that is found in a number of documents, word for word"
    rows += [(2000 + i, f"{line}\nand a text of its own, number {i}, that is long enough", "en", "lines", 0) for i in range(20)]
    rows += [(3000, None, "en", "s0", None), (3001, "", None, None, 0), (3002, line, "en", "s1", len(line))]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_does_what_it_says(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]

    def step(name, rows):
        path = str(tmp_path / name)
        stages[name](spark, rows, folder).write.parquet(path)
        out = spark.read.parquet(path)
        if name != "packing":
            assert out.columns == COLUMNS and out.dtypes == docs.dtypes
        return out

    clean = step("toxicity", docs)
    gone = {r.doc_id for r in docs.select("doc_id").subtract(clean.select("doc_id")).collect()}
    bad = {r.doc_id for r in docs.filter("text rlike 'vilest|rotter|wretch|knave'").collect()}
    assert gone <= bad and len(gone) > 0.9 * len(bad)

    cut = step("line_dedup", clean)
    given = [(r.doc_id, r.text) for r in clean.collect()]
    wanted = {i: t for i, t, n in deduped_lines(given) if not n or any(len(x.strip()) >= 20 for x in t.split("\n"))}
    assert {r.doc_id: r.text for r in cut.collect()} == wanted

    single = step("near_duplicates", cut)
    classes = jaccard_classes([(r.doc_id, r.text) for r in cut.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, c in classes if i == c)

    mixed = step("mixing", single)
    sizes = {r.source: r["count"] for r in single.groupBy("source").count().collect()}
    total, n = sum(x**0.5 for x in sizes.values()), sum(sizes.values())
    wanted = {r.doc_id: count_of(r.doc_id, sizes[r.source] ** 0.5 * n / (total * sizes[r.source]), 7) for r in single.collect()}
    found = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert found == {i: c for i, c in wanted.items() if c}

    pieces = step("packing", mixed).collect()
    ids = [i for r in mixed.collect() for i in encoder().tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]]
    packed = [i for p in pieces for i in np.frombuffer(p.ids, "<i4").tolist()]
    assert sorted(packed) == sorted(ids)
    assert all(sum(p.length for p in pieces if p.sequence_id == s) <= 1024 for s in {p.sequence_id for p in pieces})


def test_run_gives_the_last_stage(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 0


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_short_lines_left_by_line_dedup_stay(spark):
    line = "a line that is found in a number of documents, word for word"
    rows = [(1, line), (2, f"{line}\nmilk\neggs"), (3, f" \n{line}\n\t\x0b\r"), (4, "ay"), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.dedup_lines(spark, docs, "").collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == {
        1: (line, len(line)), 2: ("milk\neggs", 9), 4: ("ay", 2), 5: (None, 0), 6: ("", 0)}
