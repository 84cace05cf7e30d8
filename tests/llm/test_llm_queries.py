"""The registered queries on the given tables, against SQL or brute force."""

import brute
import compare
import pytest

import __spark_entry__ as entries
from tagshelf.llm import entries as llm


def rows(spark, sf, name, key, *columns):
    found = llm.queries()[name](spark, sf).select(key, *columns).collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: tuple(r[1:]) for r in found}


def test_every_operator_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 14))
    assert "pipeline" in entries.queries()


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_against_sql(spark, sf, name):
    got = compare.spark_rows(llm.queries()[name](spark, sf))
    with compare.connect(sf) as duck:
        assert got == compare.sql_rows(duck, llm.oracle_sql()[name])


def test_op1(spark, sf, documents):
    assert rows(spark, sf, "op1_simhash", "doc_id", "fingerprint", "component_id") == brute.simhash(documents)


def test_op2(spark, sf, documents):
    got = rows(spark, sf, "op2_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == brute.bpe(documents)


def test_op3_finds_every_pair_that_reaches_the_threshold(spark, sf, documents):
    from tagshelf.llm import decontaminate as d
    items = {r.item_id: d.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    texts = {i: d.words_of(t or "") for i, t in documents.items()}
    want = {(i, j): s for i, t in texts.items() for j, item in items.items() if (s := brute.leaked(t, item)) >= d.THRESHOLD}
    found = {(r.doc_id, r.item_id): r.score for r in llm.queries()["op3_decontaminate"](spark, sf).collect()}
    assert found == want and want


def test_op4(spark, sf):
    found = llm.queries()["op4_url_filter"](spark, sf)
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    joined = pages.join(found, "page_id").collect()
    assert len(joined) == pages.count()
    for r in joined:
        host, path, rule, verdict = brute.url(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score > 0 else "allow"))
    spam = [r for r in joined if r.rule is None and r.host.split(".")[-3] in ("cheap-pills", "spam-farm")]
    assert all(r.verdict == "block" for r in spam)


def test_op5(spark, sf, documents):
    assert rows(spark, sf, "op5_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") \
        == brute.substrings(documents)


def test_op6_on_held_out_documents(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = llm.queries()["op6_toxicity"](spark, sf)
    assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    judged = found.join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in judged)
    clean = [r for r in judged if r.held_out and not r.toxic]
    assert sum(r.predicted for r in clean) <= len(clean) // 20


def test_op6_goes_by_the_grammar(spark, sf):
    """Whatever was learned, an aimed insult counts no less than a plain one, and that more than a negated or
    reported one; a threat counts, though no label tells of any."""
    from tagshelf.llm import toxicity
    model = toxicity.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    model = model._replace(lexicon={**model.lexicon, "blockhead": 3.0})
    texts = {"aimed": "you are a blockhead", "plain": "what a blockhead", "negated": "never a blockhead",
             "reported": "it said blockhead", "none": "what a day", "threat": "to kill", "aimed threat": "they kill"}
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string")
    got = dict(zip(texts, (r.score for r in toxicity.score(table, model).orderBy("doc_id").collect())))
    assert got["aimed"] >= got["plain"] > max(got["negated"], got["reported"]) >= got["none"]
    assert got["aimed threat"] > got["threat"] > got["none"]


def test_op8(spark, sf, documents):
    assert rows(spark, sf, "op8_suffix_array", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") \
        == brute.suffixes(documents)


def test_op9(spark, sf, documents):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = rows(spark, sf, "op9_quality", "doc_id", *columns, "kept")
    assert {d: r[:-1] for d, r in got.items()} == {d: brute.quality(t) for d, t in documents.items()}
    assert {d: r[-1] for d, r in got.items()} == {d: not got[d][-2] and brute.verdict(t) for d, t in documents.items()}


def test_pipeline(spark, sf, documents):
    import corpus_pipeline
    from tagshelf.llm import decontaminate as d
    from tagshelf.llm import toxicity
    table = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.score(table, toxicity.learn(table, labels)).filter("predicted = 1").collect()}
    left = {i: r[2] for i, r in brute.lines({i: t for i, t in documents.items() if i not in toxic}).items()}
    left = {i: left[i] for i, r in brute.simhash(left).items() if r[1] == i}
    items = [d.words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    def leaks(text):
        return any(brute.leaked(d.words_of(text), item) >= d.THRESHOLD for item in items)
    want = brute.bpe({i: t for i, t in left.items() if not leaks(t)})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_stages_return_the_columns_of_documents(spark, sf):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).dtypes == docs.dtypes
