"""Every stage against plain code over what the stage before kept."""
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm.test_op4_simhash import brute_components, brute_fp
from llm.test_op8_decontam import brute as leaks
from llm.test_op10_pii import brute as base_spans
from tokenizers import Tokenizer

import corpus_pipeline as P
from storecast.llm.common import table

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_of_each(rows):
    comps = brute_components(sorted({brute_fp(r[1]) for r in rows}))
    root = {f: i for i, g in enumerate(comps) for f in g}
    best = {}
    for r in rows:
        k = root[brute_fp(r[1])]
        if k not in best or (r[0] is None, r[0] or 0) < (best[k][0] is None, best[k][0] or 0):
            best[k] = r
    return sorted(best.values(), key=repr)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in P.STAGES:
        out.append(docs)
        docs = P.materialize(stage(spark, docs, SF), "test-stage")
    return [*out, docs]


def test_columns_stay(stages):
    assert all(d.columns == stages[0].columns for d in stages[:5])


def test_language_keeps_clean_documents(stages):
    assert rows_of(stages[1]) == rows_of(stages[0].where("text rlike '\\\\p{L}'"))


def test_one_of_each_group_stays(stages):
    assert rows_of(stages[2]) == one_of_each(rows_of(stages[1]))


def test_leaks_go(spark, stages):
    bench = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    before = rows_of(stages[2])
    bad = {d for d, *_ in leaks([r[:2] for r in before], bench)}
    assert bad and rows_of(stages[3]) == [r for r in before if r[0] not in bad]


def test_personal_data_is_masked(stages):
    before, after = ({r[0]: r for r in rows_of(d)} for d in stages[3:5])
    assert set(before) == set(after)
    for d, r in before.items():
        spans = sorted((s, e, k) for k, s, e in base_spans(r[1]))
        text, end = [], 0
        for s, e, k in spans:
            if s >= end:
                text += [re.escape(r[1][end:s]), re.escape(f"[{k.upper()}]")]
            end = max(end, e)
        text = "".join(text) + re.escape(r[1][end:])
        new = after[d]
        if new[1] != re.sub(r"\\(.)", r"\1", text, flags=re.S):  # the method may add spans
            assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", new[1])
        assert not base_spans(new[1]) and new[4] == len(new[1]) and new[2:4] == r[2:4]


def test_tokens(stages):
    lib, texts = Tokenizer.from_file(P.TOKENIZER), {r.doc_id: r.text for r in stages[4].collect()}
    got = stages[5].collect()
    assert len(got) == len(texts) and all(r.decodes for r in got)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and np.frombuffer(r.ids, "<u4").tolist() == ids


def test_edges(spark, docs_of, edge_rows):
    like = ["its own text has an id of null", "with a text, a null id", "null of its own, a text with id", "own id"]
    docs = docs_of([(d, t, "en", "h") for d, t in edge_rows] * 2 + [(70 + i, t, "en", "h") for i, t in enumerate(like)]
                   + [(None, "a null id with a text of its own", "en", "h")])
    for _, stage in P.STAGES[:4]:
        new = P.materialize(stage(spark, docs, SF), "test-stage")
        assert new.columns == docs.columns
        docs = new
    # one of the empty and one-word texts each; equal rows once
    kept = [r.doc_id for r in docs.collect()]
    assert len(kept) == len(set(kept)) and None in kept and {4, 6, 7, 8, 9, 70, 71, 72, 73} >= set(kept) - {None}
    assert P.STAGES[4][1](spark, docs, SF).where("decodes").count() == len(kept)


def test_empty(spark):
    docs = table(spark, SF, "documents").where(F.lit(False))
    for _, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0


def test_language_without_labels_keeps_every_text_with_a_letter(spark, docs_of, edge_rows):
    docs = docs_of([(d, t, None, "h") for d, t in edge_rows] + [(80, "12 34 !"), (81, "some text of its own")])
    kept = P.language(spark, docs, SF)
    assert kept.columns == docs.columns
    assert rows_of(kept) == rows_of(docs.where("text rlike '\\\\p{L}'")) and kept.count() == 9
