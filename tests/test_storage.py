import os
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from stallkeep.contracts import CLEAN
from stallkeep.session import STEPWISE, exists, new_folder, release, shared_folder, shuffle_partitions_for, side_by_side, stored, tune, work
from stallkeep.sources import landing
from stallkeep.sources.store import TableMissing, publish_formats
from stallkeep.streaming import ingest

SELLERS = CLEAN["sellers"]


def sellers(spark, *ids):
    return spark.createDataFrame([(i, "01037", "sao paulo", "SP") for i in ids], SELLERS.raw_schema)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_stored_reads_back(spark):
    df = stored(spark.range(5).withColumn("d", F.lit(1.5).cast("decimal(16,2)")), "t")
    assert df.count() == 5 and "parquet" in df._jdf.queryExecution().toString().lower()


def test_stored_work_is_released_but_for_what_is_needed(spark):
    folder_of = lambda df: df.inputFiles()[0].rsplit("/", 1)[0]
    outside = stored(spark.range(3), "t")
    with work("a"):
        kept, gone = stored(spark.range(4), "t"), stored(spark.range(5), "t")
        with work("b"):
            other = stored(spark.range(6), "t")
    places = {name: folder_of(df) for name, df in (("outside", outside), ("kept", kept), ("gone", gone), ("other", other))}
    release(spark, "a", kept.where("id > 1"))
    assert {name: exists(spark, place) for name, place in places.items()} == {"outside": True, "kept": True, "gone": False, "other": True}
    release(spark, "a")
    release(spark, "never stored")
    assert not exists(spark, places["kept"]) and exists(spark, places["other"])
    release(spark, "b")


def test_shuffle_partitions():
    assert shuffle_partitions_for(100 * 1024**4, 8000) == 819_200
    assert shuffle_partitions_for(1, 8) == 16


def test_ensure_is_repeatable_and_keeps_rows(store, spark):
    store.ensure("silver", SELLERS)
    assert store.read("silver", "sellers").schema == SELLERS.full_schema
    store.append(sellers(spark, "a"), "silver", "sellers")
    store.ensure("silver", SELLERS)
    assert store.read("silver", "sellers").first()["seller_zip_code_prefix"] == 1037


def test_jobs_side_by_side_do_not_disturb_each_other(spark):
    def job(n):
        return [spark.range(n).repartition(2).count() for _ in range(5)]

    found = side_by_side(spark, [partial(job, n) for n in range(40)], at_once=8)
    assert found == [[n] * 5 for n in range(40)]


def test_missing_table(store):
    with pytest.raises(TableMissing):
        store.read("silver", "nothing")


def test_append_matches_columns_by_name(store, spark):
    store.ensure("silver", SELLERS)
    df = sellers(spark, "a").select("seller_state", "seller_id")
    store.append(df, "silver", "sellers")
    assert tuple(store.read("silver", "sellers").first()) == ("a", None, None, "SP")
    with pytest.raises(ValueError, match="other"):
        store.append(df.withColumn("other", F.lit(1)), "silver", "sellers")


def test_replace_from_itself_with_a_new_column(store, spark):
    store.replace(spark.range(3), "silver", "t", "numbers")
    for _ in range(2):
        store.replace(store.read("silver", "t").withColumn("twice", F.col("id") * 2), "silver", "t")
    assert store.version("silver", "t").comment == "numbers"
    assert sorted(r["twice"] for r in store.read("silver", "t").collect()) == [0, 2, 4]


def test_compact(store, spark):
    store.replace(spark.range(3), "silver", "t")
    store.append(spark.range(3, 5), "silver", "t")
    assert len(store.version("silver", "t").folders) == 2
    store.compact("silver", "t")
    assert len(store.version("silver", "t").folders) == 1 and store.read("silver", "t").count() == 5


def test_added_since(store, spark):
    store.replace(spark.range(3), "bronze", "t")
    store.append(spark.range(3, 5), "bronze", "t")
    added, number = store.read_added("bronze", "t", since=1)
    assert (sorted(r["id"] for r in added.collect()), number) == ([3, 4], 2)
    assert store.read_added("bronze", "t", since=2)[0].count() == 0
    assert store.read_added("bronze", "t", since=0)[0].count() == 5


def test_clean_load_of_increments(store, spark, tmp_path):
    from stallkeep.plans.medallion import load_clean_added

    root = tmp_path / "landing"
    for ids in (("a", "b"), ("b", "c"), ()):
        if ids:
            landing.write_csv(sellers(spark, *ids).coalesce(1), str(root / "sellers" / "-".join(ids)))
        landing.load_pending(store, str(root), SELLERS)
        load_clean_added(store)
    assert sorted(r["seller_id"] for r in store.read("silver", "sellers").collect()) == ["a", "b", "c"]
    # The third delivery is empty: the table is as created and then appended to twice.
    assert store.version("silver", "sellers").number == 3


def test_unfinished_write_is_invisible(store, spark):
    store.replace(spark.range(3), "silver", "t")
    store.write_data(spark.range(100), "silver", "t")
    assert store.read("silver", "t").count() == 3


def test_formats_without_package_are_left_out_only_on_request(spark, tmp_path):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        publish_formats(spark.range(4), str(tmp_path / "strict"))
    paths = publish_formats(spark.range(4), str(tmp_path / "out"), ("parquet", "delta", "orc"), optional=("delta",))
    assert set(paths) == {"parquet", "orc"}
    assert spark.read.orc(paths["orc"]).count() == spark.read.parquet(paths["parquet"]).count() == 4
    publish_formats(spark.range(2), str(tmp_path / "out"), ("parquet",))
    assert spark.read.parquet(paths["parquet"]).count() == 2


def test_csv_round_trip_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    contract = CLEAN["order_reviews"]
    texts = ['say "hi", ok', "two\nlines", "  edges  ", "", None, "comma, too"]
    rows = [(str(i), "o", "5", "t", text, None, None) for i, text in enumerate(texts)]
    landing.write_csv(spark.createDataFrame(rows, contract.raw_schema), str(tmp_path / "reviews"))
    found = landing.read_csv(spark, str(tmp_path / "reviews"), contract).orderBy("review_id").collect()
    # CSV knows no difference between an empty text and none.
    assert [r["review_comment_message"] for r in found] == [text or None for text in texts]


def test_csv_header_must_match(spark, tmp_path):
    sellers(spark, "a").withColumnRenamed("seller_city", "town").write.option("header", "true").csv(str(tmp_path / "s"))
    with pytest.raises(Exception, match="header"):
        landing.read_csv(spark, str(tmp_path / "s"), SELLERS).collect()


def test_full_load_takes_only_csv_of_known_tables(store, spark, tmp_path):
    root = tmp_path / "landing"
    landing.write_csv(sellers(spark, "a", "b"), str(root / "sellers"))
    (root / "sellers" / "notes.txt").write_text("not data")
    landing.write_csv(sellers(spark, "a"), str(root / "unknown"))
    assert set(landing.load_full(store, str(root))) == {"sellers"}
    assert store.read("bronze", "sellers").count() == 2
    landing.load_full(store, str(root))  # a full load replaces
    assert store.read("bronze", "sellers").count() == 2


def test_pending_files(store, spark, tmp_path):
    root = tmp_path / "landing"
    one = root / "sellers" / "one"
    landing.write_csv(sellers(spark, "a").coalesce(1), str(one))
    assert landing.load_pending(store, str(root), SELLERS) == 1
    assert landing.load_pending(store, str(root), SELLERS) == 0
    landing.write_csv(sellers(spark, "b").coalesce(1), str(root / "sellers" / "two"))
    assert landing.load_pending(store, str(root), SELLERS) == 1
    changed = next(one.glob("*.csv"))
    os.utime(changed, (changed.stat().st_mtime + 60,) * 2)
    assert landing.load_pending(store, str(root), SELLERS) == 1
    assert sorted(r["seller_id"] for r in store.read("bronze", "sellers").collect()) == ["a", "a", "b"]


def test_load_lost_half_way_is_repeated_in_full(store, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "landing")
    landing.write_csv(sellers(spark, "a").coalesce(1), f"{root}/sellers/one")
    with monkeypatch.context() as broken:
        broken.setattr(store, "append", lambda *args, **kw: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            landing.load_pending(store, root, SELLERS)
    assert landing.load_pending(store, root, SELLERS) == 1
    assert store.read("bronze", "sellers").count() == 1


def test_full_load_counts_as_loaded(store, spark, tmp_path):
    root = str(tmp_path / "landing")
    landing.write_csv(sellers(spark, "a").coalesce(1), f"{root}/sellers/one")
    landing.load_full(store, root)
    assert landing.load_pending(store, root, SELLERS) == 0


def stream_of(spark, folder):
    return ingest.csv_stream(spark, str(folder), SELLERS)


def test_stream_merges_each_file_once(store, spark, tmp_path):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    for ids in (("a", "b"), ("b", "c")):
        sellers(spark, *ids).coalesce(1).write.mode("append").option("header", "true").csv(str(root))
        ingest.stream_insert_if_absent(
            store, stream_of(spark, root), "silver", "sellers", ["seller_id"], checkpoint, contract=SELLERS
        )
    ingest.stream_insert_if_absent(
        store, stream_of(spark, root), "silver", "sellers", ["seller_id"], checkpoint, contract=SELLERS
    )
    assert sorted(r["seller_id"] for r in store.read("silver", "sellers").collect()) == ["a", "b", "c"]


def test_repeated_batch_is_published_once(store, spark):
    store.publish("bronze", "t", [], spark.range(1).schema)
    store.append(spark.range(3), "bronze", "t", tag="q#0")
    assert store.published("bronze", "t", "q#0") and not store.published("bronze", "t", "q#1")


def test_stream_archives_read_files(store, spark, tmp_path):
    root, archive = tmp_path / "landing", tmp_path / "processed"
    for name in "abc":
        sellers(spark, name).coalesce(1).write.mode("append").option("header", "true").csv(str(root))
    stream = ingest.csv_stream(spark, str(root), SELLERS, archive=str(archive), files_per_batch=1)
    ingest.stream_append(store, stream, "bronze", "sellers", str(tmp_path / "checkpoint"))
    assert store.read("bronze", "sellers").count() == 3
    # Files of a batch are moved once the next batch is planned, so the last may stay.
    assert len(list(archive.rglob("*.csv"))) >= 2


def test_stream_expectations(store, spark, tmp_path):
    root = tmp_path / "landing"
    spark.range(10).coalesce(1).write.parquet(str(root))
    stream = spark.readStream.schema("id long").parquet(str(root))
    rules = {"above_six": "id > 6"}
    ingest.stream_expectations(store, stream, "silver", "numbers", rules, str(tmp_path / "checkpoint"), drop=True)
    assert sorted(r["id"] for r in store.read("silver", "numbers").collect()) == [7, 8, 9]
    row = ingest.metrics_by_rule(store.read("quality", "numbers")).first()
    assert (row["checked_rows"], row["violations"]) == (10, 7)


def test_stream_lost_between_counts_and_rows_publishes_each_once(store, spark, tmp_path, monkeypatch):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    spark.range(10).coalesce(1).write.parquet(str(root))

    def run():
        stream = spark.readStream.schema("id long").parquet(str(root))
        ingest.stream_expectations(store, stream, "silver", "numbers", {"above_six": "id > 6"}, checkpoint)

    publish = store.publish

    def lost(layer, table, *args, tag=None, **kwargs):
        if tag and layer == "silver":
            raise RuntimeError("lost")
        publish(layer, table, *args, tag=tag, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(store, "publish", lost)
        with pytest.raises(Exception, match="lost"):
            run()
    assert store.read("silver", "numbers").count() == 0 and store.read("quality", "numbers").count() == 1
    run()
    assert store.read("silver", "numbers").count() == 10 and store.read("quality", "numbers").count() == 1


def test_stream_checks_the_header_and_reads_sub_folders(spark, store, tmp_path):
    names = SELLERS.raw_schema.names
    (tmp_path / "ok" / "deep").mkdir(parents=True)
    (tmp_path / "ok" / "deep" / "a.csv").write_text(",".join(names) + "\n1,2,town,SP\n")
    ingest.stream_append(store, ingest.csv_stream(spark, str(tmp_path / "ok"), SELLERS), "bronze", "deep", str(tmp_path / "c1"))
    assert store.read("bronze", "deep").count() == 1
    (tmp_path / "turned").mkdir()
    (tmp_path / "turned" / "a.csv").write_text(",".join(reversed(names)) + "\nSP,town,2,1\n")
    with pytest.raises(Exception):
        ingest.stream_append(store, ingest.csv_stream(spark, str(tmp_path / "turned"), SELLERS), "bronze", "turned", str(tmp_path / "c2"))
    assert store.read("bronze", "turned").count() == 0


def test_finished_steps_leave_no_shuffle_files(spark, tmp_path):
    """As the queries of many steps run: what a write has shuffled goes with it."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name and name.endswith(".data")}

    before = shuffled()
    try:
        tune(spark, **STEPWISE)
        spark.range(10_000).groupBy((F.col("id") % 977).alias("k")).count().write.parquet(str(tmp_path / "counts"))
        until = time.time() + 20
        while shuffled() - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffled() - before
    finally:
        for name in STEPWISE:
            spark.conf.unset(name)
    spark.range(10_000).groupBy((F.col("id") % 977).alias("k")).count().write.parquet(str(tmp_path / "others"))
    assert shuffled() - before
