"""The registered queries: SQL counterparts, and the pipeline against its stages written plainly."""

from __future__ import annotations

import re

import checks
import pytest
from test_text_operators import expected_components, one_edit, quality_counts, sha, words_of
from tokenizers import Tokenizer

import corpus_pipeline
from campuslake.llm import queries, quality_rules


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_result_as_sql(spark, sf_dir, name):
    got = checks.differences(queries.queries()[name](spark, sf_dir), checks.database(sf_dir), queries.oracle_sql()[name])
    assert got == ""


def test_all_operators_and_the_pipeline_are_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_pipeline_against_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = quality_rules.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = quality_rules.statistics(docs, keep=["doc_id", "text"]).withColumn("good", quality_rules.verdict(rules)).collect()
    kept = []
    for r in judged:
        words, *_, repeated = quality_counts(r["row"]["text"])
        if words >= 20 and 100 * repeated <= 30 * words and r["good"]:
            kept.append((r["row"]["doc_id"], r["row"]["text"]))

    seen: dict = {}
    by_length: dict = {}
    cleaned = []
    for doc_id, text in sorted(kept):
        lines = []
        for line in text.split("\n"):
            words = words_of(line)
            near = len(words) >= 8 and any(one_edit(words, o) for n in (-1, 0, 1) for o in by_length.get(len(words) + n, ()))
            if not words or not (words in seen or near):
                lines.append(line)
            if words and words not in seen:
                seen[words] = True
                if len(words) >= 8:
                    by_length.setdefault(len(words), []).append(words)
        if any(words_of(x) for x in lines):
            cleaned.append((doc_id, "\n".join(lines)))

    roots = expected_components(cleaned)
    left = [(d, t) for d, t in cleaned if roots[d] == d]

    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = fold(r["text"] or "")
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(w) for w in windows}
    clean = [
        (d, t) for d, t in left
        if not any(tuple(w[i : i + m]) in windows for w in [fold(t)] for m in sizes for i in range(len(w) - m + 1))
    ]

    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    want = {}
    for doc_id, text in clean:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        want[doc_id] = (len(ids), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
