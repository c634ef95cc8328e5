"""The pipeline against a plain version of its stages, and the queries' SQL."""

from collections import Counter
from pathlib import Path

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from logloom.llm import pii_crf
from logloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def plain(docs):
    """{doc_id: text} after all stages but packing."""
    kept = []
    for d in docs.itertuples():
        n, _, _, _, repeated = brute.measures(d.text)
        if n >= 10 and 100 * repeated <= 20 * n:
            kept.append((d.doc_id, d.text))
    kept.sort()
    kept = [kept[n] for n in brute.near_groups(kept)]
    seen, out = set(), {}
    for i, text in kept:
        found = list(brute.WORD.finditer(text))
        words = [m.group() for m in found]
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            s = tuple(words[k:k + 20])
            if s in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(s)
        ends = [m.start() for m in found[1:]] + [len(text)]
        rest, at = [], 0
        for m, end, g in zip(found, ends, gone):
            rest.append(text[at:m.start()] if g else text[at:end])
            at = end
        text = "".join([*rest, text[at:]])
        out[i] = pii_crf.redact(text, pii_crf.spans_of([text], pii_crf.default_chain())[0][1])
    return out


def test_run(spark):
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    tokenizer.encode_special_tokens = True
    got = {}
    for p in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda p: (p["doc_id"], p["start"])):
        got.setdefault(p["doc_id"], []).extend(np.frombuffer(p["ids"], "<u4").tolist())
    want = plain(brute.read("documents"))
    assert set(got) == set(want)
    for i, text in want.items():
        assert got[i] == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        assert found.dtypes == docs.dtypes, name
        assert found.filter("n_chars <> length(text)").count() == 0
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_and_empty_tables(spark, stage):
    data = [(i, t, "en", None if i is None else f"s{i % 2}", None) for i, t in brute.ODD]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    function = corpus_pipeline.STAGES[stage][1]
    assert function(spark, docs, "").count() > 0
    assert function(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = Counter(result.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert Counter(map(tuple, got.select(*names).collect())) == want
