"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import audio, bpe, langid, line_frequency, mixing, pii, simhash, toxicity, url_filter, warc
from tallyspark.llm.common import fresh_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, ids string, media string, pii string, score string, is_toxic string, fp string, __x string"
LONG = "mail me at a.b@c.example or +1 (555) 010-9999, " * 4_000 + "4111 1111 1111 1111"
ROWS = [
    (1, "the cat sat on the mat and looked at the dog\n" * 3, "en", "a", 5),
    (1, "the cat sat on the mat and looked at the dog\n" * 3, "en", "a", 5),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t", "de", None, 3),
    (None, "der hund und die katze sitzen auf der matte im haus", "de", "b", 9),
    (None, None, None, None, None),
    (5, LONG, "en", "b", len(LONG)),
    (6, "naïve 🙂 4111-1111-1111-1111 and 1.2.3.4 x@y.de <|endoftext|>", None, "a", 9),
]


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(spark, request):
    rows = [(*r, *["clash"] * 9) for r in ROWS] if request.param == "rows" else []
    return spark.createDataFrame(rows, SCHEMA)


def collected(df):
    assert len(set(df.columns)) == len(df.columns)
    return df.collect()


def test_line_frequency(docs):
    rows = collected(line_frequency.filter_lines(docs))
    assert len(rows) == docs.count()
    assert all(r.kept in (True, False) and (r.n_words > 0 or not r.kept) for r in rows)


def test_langid(docs):
    model = langid.train(docs)
    rows = collected(langid.predict(docs, model))
    assert len(rows) == docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if not (r.text or "").strip())


def test_simhash(docs):
    rows = collected(simhash.near_duplicates(docs))
    assert len(rows) == docs.count()
    assert all(r.component_id == 2 for r in rows if r.fp == 0)


def test_bpe(docs):
    path = corpus_pipeline.tokenizer_path()
    out = bpe.encode(docs, bpe.build_lexicon(docs, path), path, ids_col="ids")
    rows = collected(bpe.decode(out, path))
    assert len(rows) == docs.count()
    assert all(r.ids == [] and r.decoded == "" for r in rows if not (r.text or "").strip())


def test_audio(docs):
    rows = collected(audio.audio_features(audio.store(docs)))
    assert len(rows) == docs.count()
    for r in rows:
        blocks = audio.from_ipc(bytes(r.tensors))
        assert list(blocks.shape) == list(r.shape) and len(r.spans) == len(blocks)
        assert r.payload_bytes % 576 == 0 and r.payload_bytes >= max(576, r.n_bytes)


def test_audio_tail():
    """Payloads that differ only in their last bytes have different tensors."""
    import numpy as np

    given = audio._filters(), audio._mel(), np.hanning(audio.FRAME).astype(np.float32)
    for units in (1, 2, 3, 7):
        head = b"some text " * 1000
        a, b = (head[: 576 * units - 24] + tail * 24 for tail in (b"\xff", b" "))
        (x, e), (y, f) = audio.features(a, *given), audio.features(b, *given)
        assert x.shape == y.shape and len(e) == len(f) == -(-(432 * units - audio.FRAME) // audio.HOP) + 1
        assert (x != y).any() and (e != f).any()


def test_pii(docs):
    rows = collected(pii.find_pii(docs))
    assert len(rows) == docs.count()
    for r in rows:
        assert not pii_left(r.clean_text)
        if r.doc_id == 6:
            assert [x.kind for x in r.pii if x.kind != "term"] == ["email", "ip", "card"]


def pii_left(text):
    return "@c.example" in text or "4111" in text


def test_pii_discloses_terms(spark):
    rows = [(i, f"note {i} on day {i * 7}: zanzibarian clerk wrote from boss@corp.example about plan {i}") for i in range(8)]
    rows += [(100 + i, f"the clerk went about the note and the plan on day {i}") for i in range(50)]
    out = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), min_contexts=2).collect()
    for r in out:
        terms = {r.text[x.start : x.end] for x in r.pii if x.kind == "term"}
        assert ("zanzibarian" in terms) == (r.doc_id < 100)
        assert "the" not in terms and "clerk" not in terms


def test_pii_discloses_terms_of_copies(spark):
    """As above with copies, and with texts that differ only far from the entity: all occurrences are near, so the term is removed."""
    rows = [(i, f"note {i} on day {i * 7}: zanzibarian clerk wrote from boss@corp.example about plan {i}") for i in range(8)]
    rows += [(1000 + i, rows[0][1]) for i in range(1000)]
    rows += [(3000 + i, f"{'far ' * 40}the zanzibarian wrote to boss@corp.example {'and so on ' * 10} nr {i}") for i in range(50)]
    rows += [(100 + i, f"the clerk went about the note and the plan on day {i}") for i in range(50)]
    out = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), min_contexts=2).collect()
    assert len(out) == len(rows)
    for r in out:
        actions = {r.text[x.start : x.end]: x.action for x in r.pii if x.kind == "term"}
        assert actions.get("zanzibarian") == (None if 100 <= r.doc_id < 1000 else "remove")
        assert "the" not in actions and "clerk" not in actions


def test_mixing(docs):
    rows = collected(mixing.mix(docs))
    assert len(rows) == docs.count()
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs).collect()))


def test_mixing_meets_targets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.least(F.col("id") % 5, F.lit(2)) + 1).cast("int")).alias("source"))
    for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 50


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (5, 0, 1), (None, 1, 1), (77, 1, None)], "doc_id long, toxic int, low_quality int")
    for given in (labels, labels.limit(0)):
        rows = collected(toxicity.predict(docs, toxicity.train(docs, given)))
        assert len(rows) == docs.count()
        assert all(0 <= r.p_toxic <= 1 for r in rows)


def test_warc(spark):
    rows = [(1, "http://a/", "same"), (2, None, "same"), (3, "http://c/\r\nx", ""), (4, "u", None), (None, "n", "same"), (2, None, "same"), (5, "u", "é" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload_digest string")
    for given, n in ((pages, 7), (pages.limit(0), 0)):
        at = fresh_dir(spark, "warc-test")
        out = warc.read_warc(warc.write_warc(given, at, max_bytes=1 << 10), at).collect()
        assert len(out) == n and all(r.digest_ok for r in out)
        for r in out:
            if r.record_type == "response" and r.page_id is not None:
                assert bytes(r.payload).decode() in {x[2] or "" for x in rows if x[0] == r.page_id}
        kinds = {(r.page_id, r.record_type, r.refers_to) for r in out}
        if n:
            assert kinds == {(1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (3, "revisit", 4), (4, "response", None), (5, "response", None)}
    at = fresh_dir(spark, "warc-test")
    assert {r.record_type for r in warc.read_warc(warc.write_warc(pages, at, min_revisit_bytes=100), at).collect()} == {"response"}


def test_warc_sees_damage():
    import io

    good = warc._member(7, "http://x/", b"payload" * 100, None, 4)
    assert next(warc.read_records(io.BytesIO(good), True))[6] is True
    with pytest.raises(Exception):
        list(warc.read_records(io.BytesIO(good[:-20]), True))


def test_url_filter(spark):
    urls = ["https://WWW.Example.com/en/x", "http://a.example.com/en/x?y://z", "http://example.com", "com/", None, "", "x://y.net/es/#a", "http://net/fr/", "http://b.org/a", "http://b.org/a", "http://netx/es/", "日本://ひ.com/語"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = collected(url_filter.judge_urls(pages))
    assert len(rows) == len(urls)
    by = {r.page_id: r for r in rows}
    assert [by[i].rule for i in range(12)] == ["www.example.com/en/", "example.com/en/", None, None, None, None, "net/es/", "net/fr/", None, None, None, "com/"]
    assert by[2].path == "" and by[4].host == "" and by[3].host == ""
    assert {r.verdict for r in rows} <= {"allow", "block"}
    assert collected(url_filter.judge_urls(pages.limit(0))) == []


def test_pipeline_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != "BPE":
            assert out.columns == corpus_pipeline.COLUMNS
        out.collect()
