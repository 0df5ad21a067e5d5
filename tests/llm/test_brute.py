"""Operators that SQL can't express against plain versions of the same rules."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs
import pyarrow.ipc
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import audio, common, langid, line_frequency, linear, mixing, pii, registry, simhash, toxicity, url_filter
from tests.helpers import SF, duck
from tests.llm.test_queries import plain_fingerprint, plain_spans

DOCS = f"{SF}/documents.parquet"
MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return {r[0]: r[1] for r in spark.read.parquet(DOCS).select("doc_id", "text").collect()}


def plain_ngrams(text):
    signs, before = [], " "
    for c in (text or "").lower() + " ":
        c = c if c.isalpha() else " "
        if c != " " or before != " ":
            signs.append(ord(c))
        before = c
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(signs) - n + 1):
            h = signs[i]
            for c in signs[i + 1 : i + n]:
                h = ((h * 0x100000001B3) & MASK) ^ c
            out[((h * 0x9E3779B97F4A7C15) & MASK) >> 51] += 1
    return out


@pytest.mark.parametrize("size", [1, 7, 16, 1 << 18])
def test_langid_counts(monkeypatch, size):
    """Texts that are longer than a slice are counted in pieces."""
    monkeypatch.setattr(langid, "SLICE_CHARS", size)
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcABC éßΣ 12.,\n日"), rng.integers(0, 60))) for _ in range(40)] + ["", "  ", "1 2", "x"]
    got = [Counter() for _ in texts]
    for t, f, n in zip(*langid.counts(texts), strict=True):
        got[t][int(f)] += int(n)
    assert got == [plain_ngrams(t) for t in texts]


def test_langid_against_plain(spark, docs):
    known = spark.read.parquet(DOCS).filter(~langid.held_out(F.col("doc_id")))
    model = langid.train(known)
    df, n = Counter(), 0
    for text, lang in known.select("text", "lang").collect():
        if text is not None and lang is not None:
            own = plain_ngrams(text)
            df.update(own.keys())
            n += bool(own)
    assert np.allclose(model.idf, [math.log((1 + n) / (1 + df[i])) + 1 for i in range(langid.DIM)])
    rows = {r.doc_id: r for r in langid.predict(spark.read.parquet(DOCS).select("doc_id", "text"), model).collect()}
    for i, t in docs.items():
        x = {f: math.log1p(c) * model.idf[f] for f, c in plain_ngrams(t).items()}
        if not x:
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0)
            continue
        norm = math.sqrt(sum(v * v for v in x.values()))
        z = [(model.weights[-1, k] + sum(v / norm * langid.NORM * model.weights[f, k] for f, v in x.items())) / model.temp for k in range(len(model.langs))]
        p = [math.exp(v - max(z)) for v in z]
        best = max(range(len(p)), key=lambda k: (p[k], -k))
        assert rows[i].lang_pred == model.langs[best] and abs(rows[i].score - p[best] / sum(p)) < 1e-5


def plain_ftrl(rows, labels, dim, k, epochs, alpha=0.1, beta=1.0, l1=0.5, l2=1.0, seed=1):
    """Weights (dim + 1, k), a coordinate at a time; k = 1 is binary."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, c):
        free = l1 if i < dim else 0.0
        if abs(z[i, c]) <= free:
            return 0.0
        return -(z[i, c] - math.copysign(free, z[i, c])) / ((beta + math.sqrt(n[i, c])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            x = [*zip(rows[r][0].tolist(), rows[r][1].tolist(), strict=True), (dim, 1.0)]
            w = {(i, c): weight(i, c) for i, _ in x for c in range(k)}
            s = [sum(v * w[i, c] for i, v in x) for c in range(k)]
            if k == 1:
                error = [1 / (1 + math.exp(-s[0])) - labels[r]]
            else:
                e = [math.exp(v - max(s)) for v in s]
                error = [e[c] / sum(e) - (c == labels[r]) for c in range(k)]
            for i, v in x:
                for c in range(k):
                    g = v * error[c]
                    sigma = (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / alpha
                    z[i, c] += g - sigma * w[i, c]
                    n[i, c] += g * g
    return np.array([[weight(i, c) for c in range(k)] for i in range(dim + 1)])


def sparse_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    return [(np.sort(rng.choice(dim, 5, replace=False)), rng.random(5)) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 3])
def test_ftrl(k):
    rows = sparse_rows(60, 20, k + 7)
    labels = np.array([int(at[0]) % max(2, k) for at, _ in rows])
    got = linear.Ftrl(20, k, l1=0.8).fit(rows, labels, 3).weights()
    assert np.allclose(got, plain_ftrl(rows, labels, 20, k, 3, l1=0.8)) and (got[:-1] == 0).any()


def test_temperature():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 400)
    scores = rng.normal(size=(400, 3)) + 2.0 * np.eye(3)[labels]

    def loss(t):
        p = linear.softmax(scores / t)
        return -np.log(p[np.arange(400), labels]).mean()

    best = linear.temperature(scores * 7, labels) / 7
    assert loss(best) <= min(map(loss, np.linspace(0.3, 3, 50))) + 1e-3
    assert 0.02 < linear.temperature(30 * np.eye(3)[labels], labels)


def test_toxicity_chain(monkeypatch):
    """Three categories: each model's rows hold the out-of-fold probabilities of those before it."""
    monkeypatch.setattr(toxicity, "DIM", 30)
    rows = sparse_rows(80, 30, 5)
    rng = np.random.default_rng(6)
    labels = {c: (np.array([at[0] for at, _ in rows]) + rng.integers(0, 9, 80)) % (k + 2) == 0 for k, c in enumerate("abc")}
    got = toxicity.train_chain(rows, labels, np.ones(80))
    fold, earlier = np.random.default_rng(1).permutation(80) % toxicity.FOLDS, [[] for _ in rows]
    for k, c in enumerate("abc"):
        own = [(np.array([*at, *range(30, 30 + k)]), np.array([*x, *earlier[i]])) for i, (at, x) in enumerate(rows)]
        y = labels[c].astype(float)
        assert np.allclose(got.weights[k], plain_ftrl(own, y, 30 + k, 1, toxicity.EPOCHS, l1=0.6), atol=1e-6)
        for f in range(toxicity.FOLDS):
            fit = [i for i in range(80) if fold[i] != f]
            w = plain_ftrl([own[i] for i in fit], y[fit], 30 + k, 1, toxicity.EPOCHS, l1=0.6)
            for i in np.flatnonzero(fold == f):
                s = w[-1, 0] + sum(v * w[j, 0] for j, v in zip(*own[i], strict=True))
                earlier[i] = [*earlier[i], 1 / (1 + math.exp(-s))]


def test_toxicity_scores(spark, docs):
    """Every document's probabilities from the weights, word by word."""
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet").selectExpr("*", "1 - quality AS low_quality")
    table = spark.read.parquet(DOCS).select("doc_id", "text")
    chain = toxicity.train(table, labels)
    rows = {r.doc_id: r for r in toxicity.predict(table, chain).collect()}
    for i, t in docs.items():
        got = Counter(f for w in set(regex.findall(r"\p{L}+", (t or "").lower())) for f in toxicity._features_of(w))
        p = []
        for w in chain.weights:
            s = None if w is None else w[-1, 0] + sum(n * w[f, 0] for f, n in got.items()) + sum(a * b for a, b in zip(p, w[toxicity.DIM : -1, 0], strict=True))
            p.append(0.0 if s is None else 1 / (1 + math.exp(-max(-35, min(35, s)))))
        assert np.allclose([rows[i].p_low_quality, rows[i].p_toxic], p, atol=2e-6)
        assert rows[i].is_toxic == (rows[i].p_toxic >= chain.threshold)


def plain_audio(samples):
    """(steps before rounding, frame energies): zero-stuffed signal, one convolution, frame by frame."""
    n = audio.UP * audio.TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / max(audio.UP, audio.DOWN)) * np.hanning(n + 2)[1:-1]
    h *= audio.UP / h.sum()
    stuffed = np.zeros(len(samples) * audio.UP)
    stuffed[:: audio.UP] = (np.frombuffer(samples, np.uint8) - 128.0) / 128
    y = np.convolve(stuffed, h)[: len(stuffed) : audio.DOWN][: len(samples) * audio.UP // audio.DOWN]
    k = max(0, math.ceil((len(y) - audio.FRAME) / audio.HOP)) + 1
    y = np.concatenate([y, np.zeros((k - 1) * audio.HOP + audio.FRAME - len(y))])
    power = np.array([np.abs(np.fft.rfft(y[i * audio.HOP : i * audio.HOP + audio.FRAME] * np.hanning(audio.FRAME))) ** 2 for i in range(k)])
    return (10 * np.log10(power @ audio._mel() + 1e-6) + 60) * 2, 10 * np.log10(power.sum(1) + 1e-6)


def plain_segments(energy):
    middle, spread, on, out = np.median(energy), np.std(energy), False, []
    for i, e in enumerate(energy):
        if not on and e > middle + 0.5 * spread:
            on = True
            out.append([i, i])
        elif on and e < middle - 0.25 * spread:
            on = False
        if on:
            out[-1][1] = i + 1
    return [tuple(x) for x in out]


def test_audio_features(spark, docs, monkeypatch):
    own = audio._Extractor()
    rows = {r.doc_id: r for r in registry.QUERIES["op7_audio"](spark, SF).collect()}
    times = lambda spans: hashlib.md5(",".join(f"{x['start']:.3f}-{x['end']:.3f}" for x in spans).encode()).hexdigest()
    for i, t in docs.items():
        data = (t or "").encode()
        full = data + b"\xff" * (-len(data) % 576 if data else 576)
        said, blocks, spans, segments = own.of(audio.wav(full))
        steps, energy = plain_audio(full)
        flat = blocks.reshape(-1, audio.MELS)
        assert (np.abs(flat[: len(steps)] - np.clip(steps, 0, 255)) <= 0.51).all() and not flat[len(steps) :].any()
        second = audio.HOP / audio.TARGET_RATE
        assert np.allclose([(x["start"], x["end"]) for x in segments], [(a * second, (b + 1) * second) for a, b in plain_segments(energy)] or np.zeros((0, 2)), rtol=1e-5) if segments else not plain_segments(energy)
        shape = "x".join(map(str, blocks.shape))
        assert rows[i].feature.split(":")[:3] == [shape, hashlib.sha256(blocks.tobytes()).hexdigest(), str(len(segments))]
    monkeypatch.setattr(audio, "CHUNK_SAMPLES", 120)
    monkeypatch.setattr(audio, "CHUNK_FRAMES", 3)
    for t in list(docs.values())[:20]:
        full = (t or "").encode() + b"\xff" * (-len((t or "").encode()) % 576 or 576)
        assert np.abs(audio.features(full, *own.given)[0].reshape(-1, audio.MELS)[: len(plain_audio(full)[0])] - np.clip(plain_audio(full)[0], 0, 255)).max() <= 0.51


def test_audio_tensor_files(spark, docs):
    at = common.fresh_dir(spark, "audio-test")
    rows = audio.write_tensors(audio.store(spark.read.parquet(DOCS).select("doc_id", "text")), at).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    fs, root = pyarrow.fs.FileSystem.from_uri(at)
    found = defaultdict(dict)
    for f in fs.get_file_info(pyarrow.fs.FileSelector(root)):
        assert not f.base_name.startswith("_")
        t = pyarrow.ipc.open_file(fs.open_input_file(f.path)).read_all()
        assert isinstance(t.schema.field("tensor").type, pyarrow.FixedShapeTensorType)
        blocks = t["tensor"].combine_chunks().to_numpy_ndarray()
        for i, k, a, b, x in zip(t["id"].to_pylist(), t["block"].to_pylist(), t["start"].to_pylist(), t["end"].to_pylist(), blocks, strict=True):
            found[i][k] = (a, b, x)
    for r in rows:
        own = [found[r.doc_id][k] for k in range(r.shape[0])]
        assert hashlib.sha256(np.stack([x for _, _, x in own]).tobytes()).hexdigest() == r.tensors_sha256
        assert [(a, b) for a, b, _ in own] == [(x.start, x.end) for x in r.spans]


def plain_terms(texts, window=pii.WINDOW, min_contexts=pii.MIN_CONTEXTS, threshold=pii.THRESHOLD):
    """text -> term spans, by the definition."""
    near, n_term, contexts, together, n_entity = defaultdict(list), Counter(), defaultdict(set), defaultdict(set), defaultdict(set)
    for text in set(texts):
        n_term.update(regex.findall(r"\p{L}{3,}", text.lower()))
        spans = []
        for kind, own in plain_spans(text).items():
            for a, b in (map(int, x.split(":")[1:]) for x in own):
                value = text[a:b]
                value = value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)
                spans.append((f"{kind}:{value}", a, b))
        blank = list(text)
        for _, a, b in spans:
            blank[a:b] = " " * (b - a)
        blank = "".join(blank)
        for entity, a, b in spans:
            n_entity[entity].add((text, a))
            lo, hi = max(0, a - window), min(len(text), b + window)
            left, right = blank[lo:a], blank[b:hi]
            cut = len(regex.match(r"\p{L}*", left)[0]) if lo else 0
            end = len(regex.sub(r"\p{L}+$", "", right)) if hi < len(text) else len(right)
            for base, side in ((lo + cut, left[cut:]), (b, right[:end])):
                for m in regex.finditer(r"\p{L}{3,}", side):
                    term = m[0].lower()
                    near[text].append((entity, term, base + m.start(), base + m.end()))
                    contexts[entity, term].add((text[lo:a], text[b:hi]))
                    together[entity, term].add((text, base + m.start()))
    total, risky = sum(n_term.values()), set()
    for (entity, term), seen in contexts.items():
        if len(seen) >= min_contexts:
            k, n, e = len(together[entity, term]), n_term[term], len(n_entity[entity])
            if (1.0 if k >= n else 1 + math.log(k / n) / math.log(total / e) if e < total else 0.0) >= threshold:
                risky.add((entity, term))
    return {t: sorted({(a, b) for entity, term, a, b in own if (entity, term) in risky}) for t, own in near.items()}


@pytest.mark.parametrize("sf", [SF, SF.replace("0.001", "0.01")])
def test_pii_terms(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    want = plain_terms(texts.values())
    assert sf == SF or any(want.values())
    for r in registry.QUERIES["op8_pii"](spark, sf).collect():
        assert [x for x in r.spans.split(",") if x.startswith("term:")] == [f"term:{a}:{b}" for a, b in want.get(texts[r.doc_id], [])]


def test_pii_many_candidates(spark, monkeypatch):
    """More candidate terms than may be broadcast: the same result."""
    table = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    want = sorted(map(str, pii.find_pii(table).collect()))
    monkeypatch.setattr(pii, "BROADCAST_ROWS", -1)
    assert sorted(map(str, pii.find_pii(table).collect())) == want


def test_pii_entity_as_frequent_as_terms(spark):
    rows = [(1, "abc x@y.zz 1"), (2, "abc x@y.zz 2"), (3, "x@y.zz")]
    out = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [x.kind for x in out[1].pii] == ["email", "term"] and out[3].clean_text == "<EMAIL>"
    for rows in ([(1, "abc abc x@y.zz 1"), (2, "abc x@y.zz 2 and abc " + "far " * 40 + "abc")], [(1, "x@y.zz")]):
        assert len(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == len(rows)


def test_pii_dense_text(spark):
    text = "mail me at a.b@c.example or +1 (555) 010-9999, " * 3_000
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    base = [x for k in plain_spans(text).values() for x in k]
    assert [f"{x.kind}:{x.start}:{x.end}" for x in row.pii if x.kind != "term"] == base and "@" not in row.clean_text


def test_line_frequency_counts_documents(spark):
    """A group of copies above the limit loses its lines; with count_copies=False it is one document."""
    rows = [(i, "the same line in every copy of this text here", "h") for i in range(30)] + [(100 + i, f"own line number {'abcdefghij'[i]} with some more words in it", "h") for i in range(5)]
    rows += [(None, "the same line in every copy of this text here", "other")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for count, kept in ((True, False), (False, True)):
        out = line_frequency.filter_lines(docs, count_copies=count).collect()
        assert {r.kept for r in out if r.source == "h" and r.doc_id < 100} == {kept}
        assert all(r.kept for r in out if r.source == "other" or r.doc_id >= 100) and len(out) == len(rows)


def test_long_url(spark):
    pages = spark.createDataFrame([(1, "http://a.com/" + "x/" * 100_000), (2, "http://é.fr/" + "9" * 50_000)], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}[1] == "allow"


def test_mixing_quality_given(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'w w w w' AS text", "element_at(array('a', 'b'), cast(id % 10 = 0 AS int) + 1) AS source", "0.05D + id % 2 AS q")
    out = mixing.mix(docs, quality=F.col("q")).filter("source = 'a'").groupBy("q").agg(F.sum("taken").alias("t")).collect()
    taken = {round(r.q): r.t for r in out}
    assert taken[1] > taken[0]


def test_settings_of_the_user_stay(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "77")
    common.bounded_batches(spark)
    assert spark.conf.get(name) == "77"
    spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_joins(spark, monkeypatch):
    left = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 7 END AS k")
    right = common.written(left.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 10), "join-test")
    want = sorted((r.id, r.k, r.k * 10) for r in left.collect())
    for share, few in ((2, 1), (1000, 1), (1000, 1000)):
        got = common.skew_join(left, right, "k", "n", 1000, 500, share, few)
        assert sorted(map(tuple, got.select("id", "k", "v").collect())) == want
    for limit in (-1, 100):
        got = common.checked_join(left, right, ["k"], "inner", spread="id", limit=limit)
        assert sorted(map(tuple, got.select("id", "k", "v").collect())) == want
    monkeypatch.setattr(common, "BROADCAST_BYTES", 10)
    assert sorted(map(tuple, common.checked_join(left, right, ["k"], "left", spread="id", size=F.lit(99)).select("id", "k", "v").collect())) == want


def test_simhash_hot_nodes(spark, monkeypatch):
    """Nodes with many links take another way to the same components."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    want = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    monkeypatch.setattr(simhash, "HOT_ROWS", 1)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == want


def test_simhash_runs_over_batches():
    """Runs of equal keys that span batches give the links of the whole."""
    import pyarrow as pa

    fps = np.array([0, 1, 3, 7, 15, 1 << 20, (1 << 20) + 1, 9], np.uint64)
    keys = np.array([5, 5, 5, 5, 5, 6, 6, 7])
    batch = lambda a, b: pa.RecordBatch.from_arrays([pa.array(keys[a:b]), pa.array(fps[a:b].view(np.int64))], ["key", "fp"])
    for cuts in ([0, 8], [0, 1, 2, 3, 4, 5, 6, 7, 8], [0, 3, 3, 6, 8]):
        links = [x for b in simhash._link(iter([batch(a, b) for a, b in zip(cuts, cuts[1:], strict=False)])) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        parts = defaultdict(set)
        for a, b in links:
            parts[a].add(b)
        assert dict(parts) == {0: {1, 3, 7, 15}, 1 << 20: {(1 << 20) + 1}}


def test_pipeline_against_plain(spark, docs):
    """Each stage against a plain version of it on the stage's own input."""
    import public_tokenizers
    import tokenizers

    given = spark.read.parquet(DOCS).select(*corpus_pipeline.COLUMNS)
    stages = [f for _, f in corpus_pipeline.STAGES]
    tables = [given]
    for stage in stages:
        tables.append(common.written(stage(spark, tables[-1], SF), "pipeline-test"))
    rows = [[r.asDict() for r in t.collect()] for t in tables]
    # Language: what the method recognises stays, unchanged.
    said = {r.doc_id: r for r in langid.predict(given, langid.train(given.filter(~langid.held_out(F.col("doc_id"))))).collect()}
    langs = len({r["lang"] for r in rows[0] if r["lang"] is not None})
    bag = lambda xs: Counter(tuple(sorted(x.items(), key=str)) for x in xs)
    assert bag(rows[1]) == bag(r for r in rows[0] if said[r["doc_id"]].lang_pred != "und" and said[r["doc_id"]].score >= 1.5 / langs)
    # Near-duplicates: the smallest id of each component, of all pairs.
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows[1]}
    root = dict(zip(fps, fps, strict=True))
    for _ in fps:
        new = {i: min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3) for i in fps}
        if new == root:
            break
        root = new
    assert bag(rows[2]) == bag(r for r in rows[1] if root[r["doc_id"]] == r["doc_id"])
    # Personal data: base spans masked; terms too.
    terms = plain_terms([r["text"] or "" for r in rows[2]])
    after = {r["doc_id"]: r for r in rows[3]}
    assert len(rows[3]) == len(rows[2])
    for r in rows[2]:
        spans = [(int(a), int(b), k) for k, own in plain_spans(r["text"] or "").items() for _, a, b in (x.split(":") for x in own)]
        at, out = 0, ""
        marked = not terms.get(r["text"])
        for a, b, k in sorted(spans, key=lambda x: (x[0], -x[1], x[2])):
            if a >= at:
                out, at = out + r["text"][at:a] + f"<{k.upper()}>", b
        if marked:
            assert after[r["doc_id"]]["text"] == (out + r["text"][at:] if spans else r["text"])
            assert after[r["doc_id"]]["n_chars"] == (len(after[r["doc_id"]]["text"]) if spans else r["n_chars"])
    # Mixing: the SQL of the operator on this input.
    at = common.fresh_dir(spark, "pipeline-mix").removeprefix("file://")
    tables[3].coalesce(1).write.parquet(f"file://{at}")
    sql = mixing.OP9_SQL.replace("FROM documents", f"FROM read_parquet('{at}/*.parquet')")
    taken = Counter({r["doc_id"]: r["taken"] // r["size"] for r in duck(sql).to_pylist() if r["size"]})
    assert Counter(r["doc_id"] for r in rows[4]) == +taken
    # Tokens: the library.
    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    want = Counter(tuple(lib.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows[4])
    assert Counter(tuple(r["ids"]) for r in rows[5]) == want
    assert all(r["decoded_sha256"] == hashlib.sha256(lib.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest() and r["n_tokens"] == len(r["ids"]) for r in rows[5])


def test_pipeline_keeps_texts_of_one_id(spark):
    rows = [(1, "alpha beta gamma delta", "en", "a", 22), (1, "one two three four five six", "en", "a", 27), (1, "alpha beta gamma delta", "en", "a", 22), (None, "seven eight nine ten", "en", "a", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.text for r in out) == sorted({r[1] for r in rows})
