"""The pipeline against plain versions of its stages, and its contract."""

import re

import corpus_pipeline
from tallyloom.llm import mixing, queries, toxicity
from test_operators import plain_near


def plain_items(text, items):
    def words(t):
        return " ".join(re.sub(r"[\W_]+", " ", t.lower()).split())
    return any(f" {words(x)} " in f" {words(text)} " for x in items)


def test_stages_against_plain_versions(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    labels = queries.table(spark, sf_dir, "labels")
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).filter("predicted = 1").select("doc_id").collect()}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id not in toxic}
    largest = {}
    for i, r in rows.items():
        largest[r.text] = max(i, largest.get(r.text, -1))
    rows = {i: rows[i] for i in largest.values()}
    near = plain_near([(i, r.text) for i, r in rows.items()], 5)
    rows = {i: r for i, r in rows.items() if near[i][1] == i}
    items = [r.text for r in queries.table(spark, sf_dir, "benchmark").collect()]
    rows = {i: r for i, r in rows.items() if not plain_items(r.text, items)}
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*docs.columns, "epoch", "mix_block", "mix_key"]
    found = out.collect()
    # rewordings may go as well, verbatim items must
    kept = {r.doc_id for r in found}
    assert kept <= set(rows) and len(kept) >= len(rows) - 2
    tokens, total = {}, {}
    for r in found:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        total[r.source] = total.get(r.source, 0) + n
        if r.epoch == 1:
            tokens[r.source] = tokens.get(r.source, 0) + n
    _, weights = mixing.weights(tokens)
    budget = max(n / weights[s] for s, n in tokens.items() if n)
    longest = max(len(r.text.split()) for r in found)
    assert all(abs(total[s] - budget * w) <= longest for s, w in weights.items())


def test_stage_names_and_columns(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_odd_rows_pass_through(spark, tmp_path):
    from test_operators import ODD, made
    docs = made(spark, tmp_path, ODD)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None and r.doc_id > 2) == [3, 4, 5, 6, 7]
