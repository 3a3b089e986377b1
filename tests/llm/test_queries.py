"""Registered queries against their SQL, and the pipeline stage by stage."""

import subprocess
import zlib
from collections import defaultdict
from pathlib import Path

import pytest
from compare import connect, differences
from test_dedup import components_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from saldero.llm.queries import all_oracles, all_queries, tokenizer_path

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_its_sql(spark, name):
    assert differences(all_queries()[name](spark, SMALL), connect(SMALL), all_oracles()[name]) == []


def test_every_operator_is_registered():
    import __spark_entry__ as driver

    names = driver.queries()
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1


def test_nothing_else_imports_this_subpackage():
    found = subprocess.run(
        ["grep", "-rlE", r"^\s*(from|import) .*\bllm\b", "--include=*.py", "."],
        cwd=ROOT, capture_output=True, text=True,
    ).stdout.split()
    allowed = ("./saldero/llm/", "./tests/llm/", "./__spark_entry__.py", "./corpus_pipeline.py")
    assert all(f.startswith(allowed) for f in found)


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"] for r in all_queries()["op6_toxicity"](spark, SMALL).where("predicted = 1").collect()}
    by_text = defaultdict(list)
    for doc, text in kept.items():
        if doc not in toxic:
            by_text[text].append(doc)
    expected = [set(kept) - toxic, {max(ids) for ids in by_text.values()}]
    roots = components_by_hand([(i, kept[i]) for i in sorted(expected[1])])
    expected.append({i for i, root in roots.items() if i == root})
    for (name, stage), ids in zip(corpus_pipeline.STAGES[:3], expected, strict=True):
        path = str(tmp_path / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        assert {r["doc_id"] for r in docs.collect()} == ids, name
    packed = corpus_pipeline.STAGES[3][1](spark, docs, SMALL).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    lengths = defaultdict(int)
    for r in packed:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {i: len(tokenizer.encode(kept[i], add_special_tokens=False).ids) + 1 for i in expected[2]}
    assert len({r["sequence_id"] for r in packed}) <= -(-sum(lengths.values()) // 4096) + 1


def test_pipeline_of_nothing_and_of_odd_rows(spark, tmp_path):
    rows = [(1, None), (None, "same text"), (2, ""), (2, ""), (3, "same text"), (4, "other")]
    frame = spark.createDataFrame(
        [(*r, "en", "s", 1) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for docs in (frame, frame.where("false")):
        some = docs.count() > 0
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{some}")
            stage(spark, docs, SMALL).write.parquet(path)
            docs = spark.read.parquet(path)
            if name == "exact_dedup" and some:
                assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == [
                    (2, ""), (3, "same text"), (4, "other"),
                ]
        assert docs.count() == (3 if some else 0)


def test_checksums_are_of_little_endian_ids(spark):
    row = all_queries()["op7_best_fit_packing"](spark, SMALL).where("piece = 0").orderBy("doc_id").first()
    text = connect(SMALL).execute("SELECT text FROM documents WHERE doc_id = ?", [row["doc_id"]]).fetchall()[0][0]
    ids = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    data = b"".join(i.to_bytes(4, "little") for i in [*ids, 1][:4096])
    assert row["ids_crc32"] == zlib.crc32(data)
