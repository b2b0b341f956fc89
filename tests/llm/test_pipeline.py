import importlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SF, frame
from tests.llm.test_dedup import brute_exact, brute_near
from tests.llm.test_tokens import check_packing
from tillwise.llm import langid, mixing
from tillwise.llm.tokens import vocabulary_path

NAMES = ["language", "exact_dedup", "near_dedup", "mixing", "packing"]


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def staged(spark, docs, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


@pytest.fixture(scope="module")
def stages(llm, documents, tmp_path_factory):
    return staged(llm, documents, tmp_path_factory.mktemp("stages"))


def test_stages_follow_their_operators(stages, llm):
    docs, known, unique, single, mix, packed = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert all(df.columns == docs.columns for df in stages[1:-1])
    letters = {i for i, t in rows(docs) if any(c.isalpha() for c in t or "")}
    assert {i for i, _ in rows(known)} == letters
    assert sorted(i for i, _ in rows(unique)) == sorted(i for i, _, _, kept in brute_exact(rows(known)) if kept)
    assert sorted(i for i, _ in rows(single)) == sorted(i for i, _, _, kept in brute_near(rows(unique)) if kept)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(single).collect() if r["copies"]}
    assert {r["doc_id"]: r["n"] for r in mix.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == copies
    full, used = check_packing(packed.collect(), mix, Tokenizer.from_file(vocabulary_path()))
    assert used <= 1.05 * full + 1


def test_language_stage_fills_null_languages(llm, documents):
    """By the same predictions as the operator's; languages that are there stay."""
    docs = documents.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    out = {r["doc_id"]: r["lang"] for r in langid.keep_known(docs).select("doc_id", "lang").collect()}
    told = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    given = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert out and any(given[i] is None for i in out)
    assert all(lang == (given[i] if given[i] is not None else told[i]) and lang != langid.UNKNOWN for i, lang in out.items())


def test_run_is_the_stages(stages, llm):
    got = corpus_pipeline.run(llm, SF).select("doc_id", "start", "length", "ids_crc32").collect()
    want = stages[-1].select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_edges_and_empty_tables_go_through(llm, edges, nothing, tmp_path):
    out = staged(llm, edges, tmp_path / "edges")
    assert all(df.columns == edges.columns for df in out[1:-1]) and out[-1].count() > 0
    assert staged(llm, nothing, tmp_path / "nothing")[-1].count() == 0


def test_corpus_without_learned_languages_goes_through(llm, tmp_path):
    """No lang at all, or only on rows that are held out: only texts without a letter go."""
    words = ["one two three", "Été déjà vu", "漢字 かな", "4 5 !!", None, "six seven eight nine"]
    ids = llm.range(100).where(langid.held_out(F.col("id"))).limit(len(words)).collect()
    for name, lang in (("null", None), ("held", "en")):
        docs = frame(llm, [(r["id"], text, lang, "a") for r, text in zip(ids, words, strict=True)])
        assert langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))[1] == []
        out = staged(llm, docs, tmp_path / name)
        want = [(r["id"], text) for r, text in zip(ids, words, strict=True) if any(c.isalpha() for c in text or "")]
        assert sorted(rows(out[1])) == want and out[-1].count() > 0


def test_entry_without_the_operators(tmp_path):
    """The entry point imports, and keeps its other queries, where the folders are missing."""
    code = (
        "import sys; sys.modules['tillwise.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; q = e.queries()\n"
        "assert len(q) >= 150 and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    )
    root = importlib.import_module("os").path.dirname(corpus_pipeline.__file__)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
