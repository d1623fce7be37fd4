"""The pipeline against its stages done plainly in one process."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from cardwatch.llm import personal, quality_rules
from cardwatch.llm.shared import documents, write_once
from test_near_dups import wanted
from test_tokens import check_packing


def test_stages_keep_columns_and_rows(spark, small):
    docs = documents(spark, small)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = write_once(stage(spark, docs, small), "stage-test")
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert 0 < out.count() <= docs.count()
        docs = out


def test_pipeline_equals_plain_stages(spark, small):
    rows = {r["doc_id"]: r["text"] for r in documents(spark, small).collect()}
    judged = quality_rules.judge(documents(spark, small)).filter("quality.kept").collect()
    texts = {r["doc_id"]: rows[r["doc_id"]] for r in judged}
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    last = {fold(t): i for i, t in sorted(texts.items())}
    texts = {i: t for i, t in texts.items() if last[fold(t)] == i}
    stay = {min(g) for g in wanted(list(texts), list(texts.values()))}
    texts = {i: personal.redact(t, personal.find_spans(t)) for i, t in texts.items() if i in stay}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = entry_points.queries()["pipeline"](spark, small).collect()
    used = check_packing(packed, texts, tokenizer)
    assert used <= 1.02 * sum(r["length"] for r in packed) / 2048 + 1


def test_entry_names_every_operator():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
