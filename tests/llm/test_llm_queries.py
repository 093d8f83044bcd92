"""The registered queries against their SQL, and the pipeline from end to end."""

import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from riskmart.llm.oracle import LLM_ORACLE  # noqa: E402
from riskmart.llm.queries import LLM_QUERIES, WHOLE_QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_ten_queries():
    assert sorted(int(n.split("_")[0][2:]) for n in LLM_QUERIES) == list(range(1, 11))
    assert set(LLM_ORACLE) < set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_agrees_with_sql(spark, sf_dir, duck, name):
    assert compare.differences(LLM_QUERIES[name](spark, sf_dir), duck, LLM_ORACLE[name]) == []


def test_pipeline_against_its_stages_in_plain_python(spark, sf_dir, duck):
    from riskmart.llm.decontamination import build_automaton, scan_text
    from riskmart.llm.tokens import default_vocabulary, encoder
    from plain import components, secret_spans

    docs = {r[0]: r for r in duck.execute("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()}
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    kept = {i for i, r in docs.items() if r[1] and any(map(str.isalpha, r[1]))}
    groups = components({i: docs[i][1] for i in kept}, 5, 4, 5)
    kept = {i for i in kept if groups[i] == i}
    automaton = build_automaton(items, 10)
    kept = {i for i in kept if not scan_text(docs[i][1], automaton)["n_hit"]}
    tokens = encoder(default_vocabulary())

    def redacted(text):
        out, at = [], 0
        for start, end in secret_spans(text):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    expected = {i: len(tokens.encode(redacted(docs[i][1]))) // 4 + 1 for i in kept}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == expected
    assert sum(r.length for r in rows) == sum(expected.values())


def test_stages_keep_the_columns(spark, sf_dir, documents, prose):
    docs = documents([(1, prose), (2, None), (3, "token = abcdefghijklmnop and " + prose[::-1])], extra=("text_", "component_id", "c"))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.schema.names == docs.schema.names
        assert out.count() == 3


def test_rollup_by_the_vocabulary_against_brute_force(spark, sf_dir, duck):
    from collections import Counter
    import re

    from riskmart.llm.tokens import default_vocabulary, encoder

    tokens, n_docs, n_tokens = encoder(default_vocabulary()), Counter(), Counter()
    poor = {r[0] for r in duck.execute("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
    toxic = {r[0] for r in duck.execute("SELECT doc_id FROM labels WHERE toxic = 1").fetchall()}
    for i, t, source, lang in duck.execute("SELECT doc_id, text, source, lang FROM documents").fetchall():
        if i is None or i not in toxic:
            t = re.sub("[0-9]+", " ", t or "") if i in poor and i is not None else t or ""
            n_docs[source, lang] += 1
            n_tokens[source, lang] += len(tokens.encode(t)) // 4
    rows = WHOLE_QUERIES["op9_token_rollup_bpe"](spark, sf_dir).collect()
    assert {r.tokenizer for r in rows} == {"byte_bpe_50k"}
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rows} == {k: (n_docs[k], n_tokens[k]) for k in n_docs}


def test_the_last_stage_carries_the_ids(spark, sf_dir, documents, prose):
    rows = corpus_pipeline.STAGES[-1][1](spark, documents([(1, prose), (2, None), (3, prose * 40)]), sf_dir).collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)


def test_operator_five_by_its_number_is_the_whole_one(spark, documents, tmp_path):
    """A rare address yields terms, and they are marked far from it and where it is not named at all."""
    import __spark_entry__ as contract

    plain = [(i, f"the ship about number {i} to write") for i in range(100, 400)]
    rows = [(1, f"zorro {'the ship ' * 30} a@b.org"), (2, "the ship zorro to write")]
    documents(plain + rows).write.parquet(f"{tmp_path}/documents.parquet")
    name = next(n for n in contract.queries() if n.startswith("op5_"))
    found = {r.doc_id: r for r in contract.queries()[name](spark, str(tmp_path)).collect()}
    assert len(found) == 302 and found[1].n_email == 1
    for i, text in rows:
        at = text.index("zorro")
        assert f":{at}:{at + 5}" in found[i].spans, i
    assert not any(found[i].spans for i, _ in plain)
    assert "op5_pii" in contract.oracle_sql() and "op5_pii" in contract.queries()
