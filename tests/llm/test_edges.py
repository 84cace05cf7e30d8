"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from collections import Counter

import brute
import public_tokenizers
import pytest

from tagshelf.llm import (bpe, decontaminate, line_dedup, quality, simhash, substring_dedup, suffix_dedup, toxicity,
                          url_filter, warc)
from tagshelf.sources.scratch import scratch_path

PATTERN = public_tokenizers.PATTERN


def edge_rows(edge_docs):
    return [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]


def test_simhash(edge_docs, no_docs):
    got = Counter((r.doc_id, r.fp % 2 ** 64) for r in simhash.components(edge_docs).collect())
    assert got == Counter((d, brute.fingerprint(t)) for d, t in edge_rows(edge_docs))
    found = {r.doc_id: r.component_id for r in simhash.components(edge_docs).collect() if r.doc_id in (1, 2, 3, 4, 9)}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3, 9: 1}
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(r.doc_id for r in kept.collect())[3] == 2
    assert simhash.components(no_docs).count() == simhash.one_of_each(no_docs).count() == 0


def test_bpe(edge_docs, no_docs, ranks):
    got = Counter((r.doc_id, r.decoded_sha256) for r in bpe.digests(edge_docs, ranks, PATTERN).collect())
    assert got == Counter((d, brute.sha(t or "")) for d, t in edge_rows(edge_docs))
    back = bpe.decode(bpe.encode(edge_docs, ranks, PATTERN), ranks, PATTERN)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back.collect()) == Counter(
        (d, (t or "").encode()) for d, t in edge_rows(edge_docs))
    assert bpe.digests(no_docs, ranks, PATTERN).count() == 0


def test_line_dedup(edge_docs, no_docs):
    kept = line_dedup.drop_repeated_lines(edge_docs)
    assert kept.columns == [*edge_docs.columns, "n_dropped"]
    by_id = Counter((r.doc_id, r.n_dropped) for r in kept.collect())
    # PROSE is a line of the row without id, of 3 twice, and of 4, which is the largest.
    assert by_id[(None, 1)] == 1 and by_id[(3, 1)] == 2 and by_id[(4, 0)] == 1 and by_id[(1, 0)] == 1
    assert kept.count() == edge_docs.count()
    assert line_dedup.drop_repeated_lines(no_docs).count() == line_dedup.line_bitmaps(no_docs).count() == 0


def test_word_dedup(edge_docs, no_docs):
    found = substring_dedup.drop_repeated_words(edge_docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _ in edge_rows(edge_docs))
    removed = Counter((r.doc_id, r.n_words, r.n_removed) for r in found)
    assert removed[(3, 80, 80)] == 2 and removed[(8, 81, 80)] == 1 and removed[(8, 6, 0)] == 1
    assert removed[(None, 80, 0)] == 1 and removed[(6, 150_000, 0)] == 1
    assert substring_dedup.drop_repeated_words(no_docs).count() == 0


def test_byte_dedup(edge_docs, no_docs):
    found = suffix_dedup.drop_repeated_bytes(edge_docs).collect()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans)) for r in found)
    rows = edge_rows(edge_docs)
    small = {i: t for i, (_, t) in enumerate(rows) if len(t or "") < 10_000}
    want = brute.suffixes(small)
    assert all(got[(rows[i][0], *r[:3])] for i, r in want.items())
    assert got[(6, 300_000, 300_000, 1)] == 1
    assert suffix_dedup.drop_repeated_bytes(no_docs).count() == 0


def test_quality(edge_docs, no_docs, ranks, pieces):
    found = quality.quality(edge_docs, ranks, PATTERN, pieces).collect()
    got = Counter((r.doc_id, *(r[c] for c in quality._COUNTS[:5]), r.base_failed) for r in found)
    rows = [(d, t) for d, t in edge_rows(edge_docs) if d != 6]
    assert all(got[(d, *brute.quality(t))] for d, t in rows)
    assert quality.quality(edge_docs, ranks, PATTERN, pieces, language="lang").count() == len(found)
    assert quality.quality(no_docs, ranks, PATTERN, pieces).count() == 0


def test_toxicity(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(10, 1), (10, 0), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.learn(edge_docs, labels)
    assert toxicity.score(edge_docs, model).count() == edge_docs.count()
    assert toxicity.drop_toxic(edge_docs, model).columns == edge_docs.columns
    for empty in (toxicity.learn(no_docs, labels), toxicity.learn(edge_docs, labels.limit(0))):
        assert toxicity.score(edge_docs, empty).filter("predicted = 1").count() == 0
    assert toxicity.score(no_docs, model).count() == toxicity.drop_toxic(no_docs, model).count() == 0


def test_decontamination(spark, edge_docs, no_docs):
    text = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn"
    items = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (4, "two words"), (None, "a lone item here")],
                                  "item_id long, text string")
    edited = text.replace("brown fox", "red fox").replace("old ", "").upper()
    docs = spark.createDataFrame([(1, f"before {text}, after"), (1, f"before {text}, after"), (2, "nothing of it"),
                                  (3, f"x {edited} y"), (4, None), (5, "here are Two, words!"), (None, text),
                                  (6, "the lazy dog near the house and a cat")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, items).collect()}
    assert set(found) == {(1, 1), (3, 1), (5, 4), (None, 1)}
    assert found[1, 1].score == 1 and (found[1, 1].start, found[1, 1].end) == (1, 17)
    assert 0.5 <= found[3, 1].score < 1
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, items).orderBy("doc_id").collect()] == [2, 4, 6]
    assert decontaminate.leaks(edge_docs, items.limit(0)).count() == decontaminate.leaks(no_docs, items).count() == 0
    assert decontaminate.drop_leaks(edge_docs, items).columns == edge_docs.columns


URLS = [None, "", "no scheme", "http://", "http://X.Net", "https://A.example.NET/en/1?q#f", "http://example.net/en",
        "ftp://notexample.net/x", "http://sub.example.com/de/", "http://example.com?x/de/", "https://ex.org/fr/#a://b",
        "a://b://c/d", "http://net/", "http://host#frag/path", "http://" + "h" * 50_000 + ".org/fr/x"]


@pytest.mark.parametrize("n", [0, 2])
def test_urls(spark, n):
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark).limit(0))
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * n)],
                                  "page_id long, url string, host string, score string")
    found = url_filter.judge_urls(pages, url_filter.RULES, model).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [
        (h, p, rule, verdict or "allow") for h, p, rule, verdict in map(brute.url, URLS * n)]


def test_url_model(spark):
    table = spark.createDataFrame([("http://spam.com/", 1), ("http://spam.com/x", 1), ("http://good.org/", 0),
                                   (None, 0), ("http://q.com", None)], "url string, blocked int")
    judged = url_filter.judge_urls(table, (), url_filter.fit_url_model(table))
    assert {r.url: r.verdict for r in judged.collect()}["http://spam.com/"] == "block"


def test_warc(spark):
    rows = [(1, "http://a/", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://c/\r\nX: y", None), (4, "d", ""),
            (5, "e", "WARC/1.1\r\n\r\n\r\n" * 3), (5, "e", "WARC/1.1\r\n\r\n\r\n" * 3), (None, "f", "<p>é</p>"),
            (6, "g", "long " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch_path(spark)
    warc.archive_pages(pages, path)
    back = warc.read_warc(spark, path)
    got = Counter((r.record_id, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode())
                  for r in back.collect())
    one = "<urn:page:{}>".format
    assert got == Counter([
        (one(1), "revisit", one(2), None), (one(2), "response", None, "<p>é</p>"), (one(3), "revisit", one(4), None),
        (one(4), "response", None, ""), *[(one(5), "response", None, rows[4][2])] * 2,
        (one(""), "revisit", one(2), None), (one(6), "response", None, rows[7][2])])
    pushed = back.filter("record_type = 'revisit' and payload_length = '9'")
    assert pushed.count() == 2
    # The source took both conditions; only tests for NULL are left to Spark.
    assert " = " not in pushed._jdf.queryExecution().executedPlan().toString()
    assert warc.read_warc(spark, path, payload=False).filter("payload is not null").count() == 0
    empty = scratch_path(spark)
    warc.archive_pages(pages.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


def _record(kind, block, *more, length=True):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{kind}>", *more]
    lines += [f"Content-Length: {len(block)}"] if length else []
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    import gzip
    http = "Content-Type: application/http; msgtype=response"
    page = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\nWARC/ of a page" + b"x" * 200_000
    records = [(_record("warcinfo", b"software: x\r\n"), b"software: x\r\n"), (_record("response", page, http), page[page.index(b"body"):]),
               (_record("metadata", b"no length", length=False), b"no length"), (_record("request", b"GET / HTTP/1.1", http), b"GET / HTTP/1.1"),
               (_record("revisit", b"", http), None), (_record("conversion", "é".encode()), "é".encode())]
    (tmp_path / "sub").mkdir()
    whole = b"".join(r for r, _ in records)
    (tmp_path / "plain.warc").write_bytes(whole)
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(r) for r, _ in records))
    (tmp_path / "sub" / "one.warc.gz").write_bytes(gzip.compress(whole[:-4]))
    (tmp_path / "other.txt").write_text("no archive")
    (tmp_path / "empty.warc").write_bytes(b"")
    got = Counter((r.record_type, None if r.payload is None else bytes(r.payload)) for r in warc.read_warc(spark, str(tmp_path)).collect())
    kinds = ["warcinfo", "response", "metadata", "request", "revisit", "conversion"]
    assert got == Counter({(k, p): 3 for k, (_, p) in zip(kinds, records)})
    only = warc.read_warc(spark, str(tmp_path)).filter("record_type = 'conversion'")
    assert [bytes(r.payload).decode() for r in only.collect()] == ["é"] * 3
    assert warc.read_warc(spark, str(tmp_path), payload=False).count() == 18
    (tmp_path / "short.warc").write_bytes(whole[:-20])
    with pytest.raises(Exception, match="ends early"):
        warc.read_warc(spark, str(tmp_path)).count()


def test_a_large_file_has_a_bounded_number_of_ranges(spark, monkeypatch):
    import json
    monkeypatch.setattr(warc, "RANGE_BYTES", 100)
    monkeypatch.setattr(warc, "FILE_RANGES", 4)
    path = scratch_path(spark)
    pages = spark.range(300).coalesce(1).selectExpr("id as page_id", "'u' as url", "sha2(cast(id as string), 512) as html")
    warc.archive_pages(pages, path)
    with open(path.removeprefix("file:") + "/" + warc.MANIFEST) as file:
        assert all(len(places) <= 6 for _, places in json.load(file))
    assert warc.read_warc(spark, path).select("record_id").distinct().count() == 300


def test_small_equal_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "a", "same"), (2, "b", "same")], "page_id long, url string, html string")
    path = scratch_path(spark)
    warc.archive_pages(pages, path, min_bytes=5)
    assert warc.read_warc(spark, path).filter("record_type = 'response'").count() == 2


def test_line_dedup_of_a_text_with_very_many_lines(spark):
    """Linear in the lines: half of 200,000 lines go, in seconds."""
    import time
    long_text = "\n".join(f"line number {i} of a very long text" if i % 2 else f"x{i}" for i in range(200_000))
    docs = spark.createDataFrame([(i, long_text) for i in range(3)], "doc_id long, text string")
    begun = time.time()
    kept = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert time.time() - begun < 60
    assert [kept[i].n_dropped for i in range(3)] == [100_000, 100_000, 0] and kept[2].text == long_text
    assert kept[0].text == "\n".join(f"x{i}" for i in range(0, 200_000, 2))
