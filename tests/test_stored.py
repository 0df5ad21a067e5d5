"""Stored tables: what a batch rewrites, batches that come twice, and runs that are lost between the steps."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import stored
from tallyspark.operators.write import KEY, write_results

SCHEMA = "id long, status string, price double"


@pytest.fixture
def store(spark, tmp_path):
    old = spark.range(400).select("id", F.lit("O").alias("status"), F.when(F.col("id") % 7 > 0, 1.0).alias("price"))
    return stored.create(spark, f"{tmp_path}/store", ["id"], {"rows": old}, 16)


def files(path, name="rows"):
    return {p: p.stat().st_mtime_ns for p in (path / "store" / name).rglob("*.parquet")}


def rows(store, name="rows"):
    return {r[0]: tuple(r[1:]) for r in store.read(name).collect()}


def change(spark, *ids):
    return spark.createDataFrame([(i, "N", 2.0) for i in ids], SCHEMA)


def test_only_buckets_that_occur(spark, store, tmp_path):
    before = files(tmp_path)
    assert stored.merge(store, change(spark, 5, 1000), 0, stored.upserts(store))
    after = files(tmp_path)
    own = {r[0] for r in change(spark, 5, 1000).select(store.bucket()).collect()}
    changed = {p.parent.name for p, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"{stored.BUCKET}={b}" for b in own} and len(own) <= 2
    got = rows(store)
    assert len(got) == 401 and got[5] == got[1000] == ("N", 2.0) and got[6] == ("O", 1.0)


@pytest.mark.parametrize("how, want", [("force", {5: ("N", 2.0), 7: ("N", 2.0), 999: ("N", 2.0)}), ("skip", {5: ("O", 1.0), 7: ("O", None), 999: ("N", 2.0)}), ("first", {5: ("O", 1.0), 7: ("O", 2.0), 999: ("N", 2.0)}), ("guarded", {5: ("N", 2.0), 7: ("O", None), 999: ("N", 2.0)})])
def test_kinds(spark, store, how, want):
    plan = stored.upserts(store, how, F.col("price") > 0)
    assert stored.merge(store, change(spark, 5, 7, 999), 3, plan)
    assert not stored.merge(store, change(spark, 5, 7, 999), 3, plan)
    got = rows(store)
    assert {k: got[k] for k in want} == want and len(got) == 401


def test_lost_before_the_log_is_complete(spark, store, monkeypatch):
    before = rows(store)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(stored, "_mark", lost)
        with pytest.raises(OSError, match="lost"):
            stored.merge(store, change(spark, 5), 0, stored.upserts(store))
    assert rows(store) == before
    assert stored.merge(store, change(spark, 5), 0, stored.upserts(store))
    assert rows(store) == before | {5: ("N", 2.0)}


def test_lost_in_the_middle_of_publishing(spark, store, tmp_path):
    """The store has lost a bucket; the log still has it."""
    before = rows(store)
    stored.stage(store, change(spark, 5, 6), 0, stored.upserts(store))
    assert rows(store) == before
    b = change(spark, 5).select(store.bucket()).first()[0]
    stored._remove(spark, f"{store.path}/rows/{stored.BUCKET}={b}")
    never = lambda old, new: pytest.fail("computed again from what is lost")
    assert stored.merge(store, change(spark, 5, 6), 0, never)
    assert rows(store) == before | {5: ("N", 2.0), 6: ("N", 2.0)}


def test_buckets_without_rows(spark, store):
    """A plan that removes rows leaves no old file behind."""
    doomed = store.with_bucket("rows").filter(f"{stored.BUCKET} = 3").select("id").limit(1000)
    ids = {r[0] for r in doomed.collect()}
    new = spark.createDataFrame([(i, "gone", 0.0) for i in ids], SCHEMA)
    assert ids and stored.merge(store, new, 0, lambda old, new: {"rows": old["rows"].join(new.select("id"), "id", "left_anti")})
    assert set(rows(store)) == set(range(400)) - ids
    assert stored.merge(store, change(spark, next(iter(ids))), 1, stored.upserts(store))
    assert next(iter(ids)) in rows(store)


def test_empty_batch_and_log(spark, store):
    before = rows(store)
    assert stored.merge(store, change(spark, 1).limit(0), 0, stored.upserts(store)) and rows(store) == before
    assert stored.merge(store, change(spark, 1), 1, lambda old, new: stored.upserts(store)(old, new) | {"audit": new.select("id")})
    assert [r.id for r in store.log(1, "audit").collect()] == [1]
    stored.forget(store, 2)
    assert not stored.merge(store, change(spark, 2), 1, stored.upserts(store))


def test_overwrite_clears_dependants(spark, tmp_path):
    schema = "doc_id long, metric string, model string, period_type string, value double, value_text string, unit string, quote string, section string, kind string, value_usd double, fx_rate double, fx_date date, currency string"
    row = lambda d, v: (d, "m", "x", "FY", v, "5", "count", "it is so", "s", "direct", v, None, None, None)
    old = spark.createDataFrame([row(1, 1.0), row(2, 2.0)], schema)
    children = old.select(*KEY, F.lit("said").alias("excerpt"))
    store = stored.create(spark, f"{tmp_path}/facts", KEY, {"facts": old, "evidence": children, "verdicts": children}, 4)
    docs = spark.createDataFrame([], "doc_id long, currency string, period date")
    rates = spark.createDataFrame([], "currency string, rate_date date, rate double")
    plan = stored.facts_plan(docs, rates, ["value"], True, provenance=lambda d: F.contains(F.lit("so it is so"), F.col("quote")))
    assert stored.merge(store, spark.createDataFrame([row(1, 9.0), row(3, 3.0), (*row(4, 4.0)[:5], "", *row(4, 4.0)[6:])], schema), 0, plan)
    assert sorted((r.doc_id, r.value) for r in store.read("facts").collect()) == [(1, 9.0), (2, 2.0), (3, 3.0)]
    assert [r.doc_id for r in store.read("evidence").collect()] == [r.doc_id for r in store.read("verdicts").collect()] == [2]
    audit = sorted((r.doc_id, r.action, r.payload) for r in store.log(0, "audit").collect())
    assert audit == [
        (1, "inserted", '{"extracting_model":"x","metric_key":"m","source_document_id":1,"value":9.0}'),
        (1, "overwritten", '{"extracting_model":"x","metric_key":"m","new_value":9.0,"old_value":1.0,"old_value_usd":1.0,"period_type":"FY","source_document_id":1}'),
        (3, "inserted", '{"extracting_model":"x","metric_key":"m","source_document_id":3,"value":3.0}'),
    ]
    assert sorted((r.doc_id, r.passed, r.details) for r in store.log(0, "checks").collect()) == [(1, True, '{"quote_length":3}'), (3, True, '{"quote_length":3}')]
    assert [r.messages for r in store.log(0, "errors").collect()] == [["missing or empty required field: value_text"]]


FACT = "doc_id long, metric string, model string, period_type string, value double, value_text string, unit string, quote string, section string, kind string, value_usd double, fx_rate double, fx_date date, currency string"


def fact(doc, value, model="x"):
    return (doc, "m", model, "FY", value, "5", "count", "it is so", "s", "direct", value, None, None, None)


def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, currency string, period date"), spark.createDataFrame([], "currency string, rate_date date, rate double")


def test_publishing_moves_the_log_s_files(spark, store, tmp_path):
    """They are neither shuffled nor written again."""
    stored.stage(store, change(spark, *range(390, 410)), 0, stored.upserts(store))
    staged = {p.name for p in (tmp_path / "store" / "log" / "batch=0" / "rows").rglob("*.parquet")}
    stored.publish(store, 0)
    touched = {r[0] for r in change(spark, *range(390, 410)).select(store.bucket()).collect()}
    assert {p.name for b in touched for p in (tmp_path / "store" / "rows" / f"{stored.BUCKET}={b}").glob("*.parquet")} == staged
    assert len(rows(store)) == 410


@pytest.mark.parametrize("calls", [1, 3, 6])
def test_lost_between_two_moves(spark, store, monkeypatch, calls):
    before = rows(store)
    ids = range(390, 410)
    stored.stage(store, change(spark, *ids), 0, stored.upserts(store))
    left, remove = [None] * calls, stored._remove

    def lost(*args):
        if not left:
            raise OSError("lost")
        left.pop()
        remove(*args)

    with monkeypatch.context() as m:
        m.setattr(stored, "_remove", lost)
        with pytest.raises(OSError, match="lost"):
            stored.publish(store, 0)
    never = lambda old, new: pytest.fail("computed again")
    assert stored.merge(store, change(spark, *ids), 0, never)
    assert rows(store) == before | {i: ("N", 2.0) for i in ids}


def test_results_are_compared_once(spark):
    """All tables of a batch read what was made once; the next batch removes it."""
    old, new = spark.createDataFrame([fact(1, 1.0), fact(2, 2.0)], FACT), spark.createDataFrame([fact(1, 9.0), fact(1, 8.0), fact(3, 3.0)], FACT)
    plan = stored.facts_plan(*no_docs(spark), ["value"], True)
    out = plan({"facts": old, "evidence": old.select(*KEY)}, new)
    assert all("Window" not in t._jdf.queryExecution().optimizedPlan().toString() for t in out.values())
    assert sorted((r.doc_id, r.value) for r in out["facts"].collect()) == [(1, 8.0), (2, 2.0), (3, 3.0)]
    assert [r.doc_id for r in out["evidence"].collect()] == [2]
    assert sorted(tuple(r) for r in out["summary"].collect()) == [("inserted", 1), ("overwritten", 1), ("skipped", 1)]
    at = out["facts"].inputFiles()[0]
    plan({"facts": old}, new.limit(1))
    assert not stored._there(spark, at)


def test_many_rows_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(stored, "TASK_ROWS", 10)
    new = spark.createDataFrame([fact(i, 1.0) for i in range(200)], FACT)
    out = stored.facts_plan(*no_docs(spark), ["value"], False)({"facts": new.limit(50)}, new)
    assert len(out["facts"].inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.doc_id for r in out["facts"].collect()) == list(range(200))


@pytest.mark.parametrize("force", [True, False])
def test_keys_with_a_null_match_nothing(spark, force):
    """Stored rows stay, and of results that repeat such a key the first counts as new."""
    old = spark.createDataFrame([fact(1, 1.0, None), fact(2, 2.0)], FACT)
    new = spark.createDataFrame([fact(1, 6.0, None), fact(1, 5.0, None), fact(2, 7.0)], FACT)
    out = write_results(old, new, *no_docs(spark), ["value"], force, children={"evidence": old.select(*KEY)})
    assert sorted((r.doc_id, r.value) for r in out["facts"].collect()) == [(1, 1.0), (1, 5.0), (2, 7.0 if force else 2.0)]
    assert sorted(r.doc_id for r in out["evidence"].collect()) == ([1] if force else [1, 2])
    assert {r.outcome: r.n for r in out["summary"].collect()} == ({"inserted": 1, "overwritten": 1, "skipped": 1} if force else {"inserted": 1, "skipped": 2})
