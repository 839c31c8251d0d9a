"""Feed invariants, the JSON Lines sink and the error-log path (sf0.001)."""

import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from tessera.plans import oracle, oracle_catalog
from tessera.plans.compare import compare, duck
from tessera.plans.context import stages_for
from tessera.plans.feed import EMPTY_SET_KEYS, published, variant_rows, variants, views
from tessera.plans.job import build_feed, run_feed, stage_documents
from tessera.plans.oracle import SQL
from tessera.plans.staging import Staging
from tessera.plans.stages import OUTPUT_KEY_RENAMES
from tessera.sources.catalog import PIVOT_NAMES
from tessera.sources.sinks import append_error


def _no_dupes(pairs):
    keys = [k for k, _ in pairs]
    assert len(keys) == len(set(keys)), keys
    return dict(pairs)


def _no_nulls(x, path="$"):
    if isinstance(x, dict):
        for k, v in x.items():
            assert v is not None, f"{path}.{k} is null"
            _no_nulls(v, f"{path}.{k}")
    elif isinstance(x, list):
        for i, v in enumerate(x):
            _no_nulls(v, f"{path}[{i}]")


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    rows = build_feed(spark, sf_small).collect()
    spark.catalog.clearCache()
    return rows


def test_documents_parse_and_have_shape(docs):
    assert len(docs) > 0
    for r in docs:
        d = json.loads(r.doc, object_pairs_hook=_no_dupes)
        assert d["op"] == "add" and d["path"] == f"/products/{r.set_id}"
        attrs = d["value"]["attributes"]
        assert attrs["is_special_productset"] == "Y" and attrs["availability"] is True
        assert attrs["is_international"] in ("true", "false")
        _no_nulls(d)
        for vg, v in d["value"].get("variants", {}).items():
            assert set(v) == {"attributes"} and v["attributes"]["availability"] is True
        for site, v in d["value"].get("views", {}).items():
            assert "url" in v["attributes"]
            for path in v["attributes"].get("category_paths", []):
                assert path and all(set(n) == {"id", "name"} for n in path)


def test_one_document_per_set(docs):
    ids = [r.set_id for r in docs]
    assert len(ids) == len(set(ids))


def test_partition_count_does_not_change_output(spark, sf_small, docs):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = build_feed(spark, sf_small).collect()
        spark.catalog.clearCache()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted((r.set_id, r.doc) for r in again) == sorted((r.set_id, r.doc) for r in docs)


def test_run_feed_writes_json_lines(spark, sf_small, docs):
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-feed-"), "feed")
    run_feed(spark, sf_small, out)
    lines = [json.loads(x) for x in spark.read.text(out).toLocalIterator() for x in [x.value]]
    spark.catalog.clearCache()
    assert len(lines) == len(docs)
    assert {d["path"] for d in lines} == {f"/products/{r.set_id}" for r in docs}


def test_run_feed_logs_error_and_reraises(spark):
    base = tempfile.mkdtemp(prefix="tessera-err-")
    log = os.path.join(base, "error_log")
    with pytest.raises(Exception):
        run_feed(spark, os.path.join(base, "no-such-dir"), os.path.join(base, "out"), error_log=log)
    rows = spark.read.parquet(log).collect()
    assert len(rows) == 1 and rows[0].object_name == "run_feed" and rows[0].message.startswith("ERROR")


def test_a_failing_error_log_does_not_hide_the_error(spark, capsys):
    base = tempfile.mkdtemp(prefix="tessera-err-")
    blocked = os.path.join(base, "file")
    open(blocked, "w").close()
    with pytest.raises(Exception, match="no-such-dir"):
        run_feed(spark, os.path.join(base, "no-such-dir"), os.path.join(base, "out"), error_log=os.path.join(blocked, "log"))
    assert "error log could not be written" in capsys.readouterr().err


def test_the_error_log_has_the_whole_trace_and_the_time(spark):
    log = os.path.join(tempfile.mkdtemp(prefix="tessera-err-"), "log")
    try:
        raise ValueError("x" * 3000)
    except ValueError as exc:
        append_error(spark, log, "job", exc)
    row = spark.read.parquet(log).withColumn("age", F.current_timestamp().cast("double") - F.col("logged_at").cast("double")).first()
    assert "test_feed.py" in row.trace and "x" * 3000 in row.trace and 0 <= row.age < 300


def test_nothing_stays_cached_after_the_feed(spark, sf_small):
    spark.catalog.clearCache()
    run_feed(spark, sf_small, os.path.join(tempfile.mkdtemp(prefix="tessera-feed-"), "feed"))
    assert spark._jsc.getPersistentRDDs().isEmpty()


def test_children_are_built_for_published_sets_only(spark, sf_small, docs):
    st = stages_for(spark, sf_small)
    sets = published(st).checkpoint()
    assert sets.count() == len(docs)
    ids = {r.set_id for r in docs}
    rows = variant_rows(st, sets)
    for child in (variants(rows), views(st, sets)):
        assert {r.set_id for r in child.select("set_id").collect()} <= ids
    assert "LeftSemi" in rows._jdf.queryExecution().executedPlan().toString()


def test_every_pivoted_attribute_has_values_of_each_kind(spark, sf_small):
    row = stages_for(spark, sf_small).attributes
    seen = row.agg(*[F.count(f"`{n}`").alias(n) for n in PIVOT_NAMES],
                   *[F.max(F.col(f"`{n}`").contains("|").cast("int")).alias("multi_" + n) for n in PIVOT_NAMES],
                   *[F.max(F.col(f"`{n}`").contains('"').cast("int")).alias("quoted_" + n) for n in PIVOT_NAMES]).first().asDict()
    assert all(seen.values()) and any(r[n] is None for r in row.limit(50).collect() for n in PIVOT_NAMES)


def test_fixture_tells_list_from_sale_price_and_has_two_rows_for_a_set(spark, sf_small):
    p = stages_for(spark, sf_small).promo_prices
    assert not p.filter("list_price <> sale_price").isEmpty()
    assert not p.groupBy("set_id").count().filter("count = 2").isEmpty()
    con = duck(sf_small)
    swapped = p.select("set_id", F.col("sale_price").alias("list_price"), F.col("list_price").alias("sale_price"),
                       *[F.col(f"{b}_price_{x}").alias(f"{a}_price_{x}") for a, b in (("list", "sale"), ("sale", "list")) for x in ("low", "high")])
    assert compare(p, con, SQL["price_range"])["values_match"] and not compare(swapped, con, SQL["price_range"])["values_match"]


def test_dimensions_lack_some_keys(spark, sf_small):
    cat = stages_for(spark, sf_small).cat
    n = cat.product.count()
    for other, key in ((cat.brand, "brand_id"), (cat.classification, "classification"), (cat.site_product, "product_id"),
                       (cat.product_price, "product_id")):
        assert 0 < cat.product.join(other, key, "left_semi").count() < n
    assert not cat.product.filter("is_international is null").isEmpty() and not cat.inventory.filter("quantity is null").isEmpty()


def test_the_oracle_holds_its_own_lists():
    source = open(oracle.__file__).read() + open(oracle_catalog.__file__).read()
    assert "from .feed" not in source and "from .stages" not in source and "sources.catalog import" not in source
    assert tuple(oracle_catalog.ATTRIBUTE_NAMES) == PIVOT_NAMES and tuple(oracle.EMPTY_KEYS) == EMPTY_SET_KEYS
    assert oracle.RENAMED == OUTPUT_KEY_RENAMES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, sf_small):
    """Each staged relation's plan and columns, the documents' plan, and the tables while they are there."""
    plans, tables, write = {}, {}, Staging.table

    def noted(self, name, df, by=None):
        plans[name] = _plan(df)
        tables[name] = write(self, name, df, by)
        return tables[name]

    with pytest.MonkeyPatch.context() as m, Staging(spark) as store:
        m.setattr(Staging, "table", noted)
        docs = stage_documents(spark, sf_small, store)
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the tables are large
        last, n = _plan(docs.select("*")), docs.count()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        rows = {name: [r.asDict() for r in t.collect()] for name, t in tables.items() if name in ("legs", "products", "kept_sets", "published")}
        yield plans, rows, last, n


def test_staged_rows_are_those_of_gated_sellable_sets(spark, sf_small, staged, docs):
    _, rows, _, n = staged
    st = stages_for(spark, sf_small)
    header = st.cat.set_header.filter("searchable_flag = 1 and online_flag = 1 and available_flag = 1")
    want = {r.set_id for r in st.gated_sets.join(header, "set_id").select("set_id").collect()}
    assert {r["set_id"] for r in rows["kept_sets"]} == want and len(want) < st.cat.legs.select("set_id").distinct().count() / 2
    assert {r["set_id"] for r in rows["products"]} <= want and {r["set_id"] for r in rows["legs"]} == want
    full = st.products.filter(F.col("set_id").isin(list(want))).collect()
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(map(key, rows["products"])) == sorted(key(r.asDict()) for r in full)
    assert n == len(docs) == len(rows["published"])


def test_the_whole_job_scans_the_lines_at_most_six_times(staged):
    plans, _, last, _ = staged
    assert sum(p.count("lineitem.parquet") for p in [*plans.values(), last]) <= 6
    assert all("LeftSemi" in plans[name] for name in ("kept_sets", "legs", "variants", "views"))


def test_documents_are_put_together_without_moving_a_row(staged):
    plans, _, last, _ = staged
    assert "Exchange" not in last and last.count("FileScan") == 3 and last.count("Bucketed: true") == 3
    assert "Exchange" in plans["variants"]


def test_staged_tables_are_dropped(spark, sf_small, tmp_path):
    before = {d.name for d in spark.catalog.listDatabases()}
    run_feed(spark, sf_small, str(tmp_path / "out"))
    assert build_feed(spark, sf_small).count() > 0
    assert {d.name for d in spark.catalog.listDatabases()} == before
    with pytest.raises(ValueError), Staging(spark) as store:
        store.table("t", spark.range(3), by="id")
        raise ValueError
    assert {d.name for d in spark.catalog.listDatabases()} == before
