"""The pipeline against a brute-force version of each stage's decision."""

import corpus_pipeline
from siftwell.llm import decontamination, jaccard, quality, secrets

SF = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [r for r in quality.score(docs, model, score_col="s").collect() if r["s"] >= corpus_pipeline.LEAST_QUALITY]
    sets = {r["doc_id"]: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for r in good for w in [(r["text"] or "").lower().split()]}
    kept = []
    label = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if x == old else x for k, x in label.items()}
    kept = [r for r in good if label[r["doc_id"]] == r["doc_id"]]
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in kept], "doc_id long, text string")
    leaked = {r["doc_id"] for r in decontamination.leaks(frame, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    wanted = {r["doc_id"] for r in kept} - leaked
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(found) == wanted and all(r["lossless"] for r in found.values())
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(frame).collect()}
    assert all(found[k]["n_chars"] == len(clean[k]) for k in wanted)


def test_stages_take_odd_tables(spark):
    rows = [(None, "some words here", "en", "s", 15), (1, None, "en", "s", 0), (2, "", None, None, 0), (3, "x " * 5000, "en", "s", 10_000), (3, "x " * 5000, "en", "s", 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            assert stage(spark, df, SF).count() <= df.count()
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF).columns == docs.columns
    assert jaccard.linked_components(docs).count() == len(rows)


def test_near_copies_with_null_and_repeated_ids(spark):
    """Of each group the smallest id stays, a null one last; rows of one id with different texts are different documents."""
    one, two = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(5, one), (3, one), (3, two), (None, one + " more"), (None, "alone it stands here and there"), (7, "short"), (7, "short"), (8, None), (8, "")]
    docs = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string")
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF).collect()), key=repr)
    assert got == sorted([(3, one), (3, two), (None, "alone it stands here and there"), (7, "short"), (8, None), (8, "")], key=repr)


def test_stages_keep_columns_of_any_name(spark):
    rows = [(1, "some words here and there", "en", "s", 25, 7, "k", [1]), (1, "some words here and there", "en", "s", 25, 7, "k", [1]), (2, None, None, None, 0, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, key string, piece_ids array<int>")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        assert set(found.columns) >= set(docs.columns) - {"text"} and found.count() <= 3, name
    assert set(found.columns) == {*docs.columns, "n_pieces", "lossless"} - {"text"}
    assert corpus_pipeline.ngram_jaccard_join(spark, docs, SF).count() == 2
