import random
import re

import corpus_pipeline as pipeline
import pytest
from helpers import DOCS, docs

from tidewright.llm import packing, toxicity
from tidewright.llm.common import written

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = DOCS.fieldNames()


def tables(spark, folder, rows, items=(), labels=()):
    docs(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def planted():
    """Clean documents and, for each stage, ones it must drop."""
    rng = random.Random(9)
    words = [f"{a}{b}" for a in "bdfglmnprst" for b in ("ala", "eno", "iru", "oma", "uke")]
    text = lambda n: " ".join(rng.choices(words, k=n))
    item = text(40)
    rows = [(i, text(rng.randint(40, 90))) for i in range(0, 40)]
    gone = set()
    for i in range(40, 50):
        rows.append((i, rows[i - 40][1].replace(" ", "  ")))
    near = rows[3][1].split()
    near[5] = "changed"
    rows.append((50, " ".join(near)))
    parts = item.split()
    rows.append((51, text(30) + " " + " ".join(parts[20:] + parts[:20]) + " " + text(5)))
    rows.append((52, "You are an idiot and a moron. " + text(20) + " What a pathetic loser you are, stupid clown!"))
    gone = set(range(40, 53))
    return rows, [(1, item)], gone


def test_each_stage_drops_what_was_planted(spark, tmp_path):
    rows, items, gone = planted()
    sf_dir = tables(spark, tmp_path / "sf", rows, items)
    current = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dropped = {}
    for name, stage in pipeline.STAGES[:-1]:
        before = {r.doc_id for r in current.collect()}
        current = written(stage(spark, current, sf_dir), name)
        assert current.columns == COLUMNS
        dropped[name] = before - {r.doc_id for r in current.collect()}
    assert dropped == {
        "toxicity": {52}, "exact_dedup": set(range(40, 50)), "ngram_jaccard_join": {50}, "decontamination": {51}
    }
    packed = pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows} - gone
    kept = {r.doc_id: r.text for r in current.collect()}
    sizes = {r["doc_id"]: r["size"] for r in packing.sizes(docs(spark, list(kept.items()))).collect()}
    assert {i: sum(r.n_tokens for r in packed if r.doc_id == i) for i in kept} == sizes


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "a b"), (1, "c" * 50_000), (3, " "), (3, " ")]])
def test_odd_documents(spark, tmp_path, rows):
    packed = pipeline.run(spark, tables(spark, tmp_path / "sf", rows)).collect()
    kept = {(None if i is None else i) for i, t in rows if (i, t) in ((1, None), (None, "a b"), (1, "c" * 50_000), (3, " "))}
    assert {r.doc_id for r in packed} == kept


def test_run_on_the_whole_table(spark):
    """Against plain Python for the stages that compare texts by rules."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.train(table, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = [r for r in table.collect() if model.score(r.text.encode())[0] < 0.5]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    unique = [(r.doc_id, r.text) for r in rows if r.doc_id in set(first.values())]
    from test_decontamination import brute as tiled
    from test_ngram_join import brute as joined

    kept = [(i, t) for i, t in unique if (str(i)) in {c for _, _, c in joined(unique)}]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    words = lambda t: set(re.findall(r"\w+", t.lower()))
    clean = set()
    for i, t in kept:
        near = [(k, b) for k, b in bench if len(words(b) & words(t)) >= 5]
        if len(t) > 6000 or not near or max(c for c, _ in [tiled([(i, t)], near)[i]]) < 0.5:
            clean.add(i)
    assert {r.doc_id for r in pipeline.run(spark, SF_DIR).collect()} <= {i for i, _ in kept}
    assert {r.doc_id for r in pipeline.run(spark, SF_DIR).collect()} ^ clean <= {i for i, t in kept if len(t) > 6000}
