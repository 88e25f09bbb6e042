import pytest
from pyspark.sql import functions as F

from tests.conftest import exchanged_columns
from threadlens import scale
from threadlens.functions import dates
from threadlens.schemas import COMMENTS_RAW
from threadlens.sources import csvstore, tables
from threadlens.sources import upsert as up


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("c", None, 3)], "id string, text string, score long")


@pytest.mark.parametrize("strategy", up.STRATEGIES)
def test_partial_columns_and_nulls(spark, base, strategy):
    incoming = spark.createDataFrame([("b", None), ("d", 9)], "id string, score int")
    got = {r.id: (r.text, r.score) for r in up.upsert(base, incoming, strategy=strategy).collect()}
    assert got == {"a": ("x", 1), "b": ("y", None), "c": (None, 3), "d": (None, 9)}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_last_of_a_batch_wins(spark, base, strategy):
    incoming = spark.createDataFrame([("b", "1st", 1), ("b", None, 3), ("b", "2nd", 2), ("n", "new", 4)],
                                     "id string, text string, seq int")
    got = {r.id: (r.text, r.score) for r in up.upsert(base, incoming, seq="seq", strategy=strategy).collect()}
    assert got == {"a": ("x", 1), "b": (None, 2), "c": (None, 3), "n": ("new", None)}


@pytest.mark.parametrize("strategy", up.STRATEGIES)
def test_keys_stay_unique_without_a_sequence(spark, base, strategy):
    incoming = spark.createDataFrame([("a", "1", 5), ("a", "2", None), ("n", None, 3), ("n", None, 4)], base.schema)
    got = sorted(map(tuple, up.upsert(base, incoming, strategy=strategy).collect()))
    assert got == [("a", "2", None), ("b", "y", 2), ("c", None, 3), ("n", None, 4)]


def test_too_large_for_a_broadcast(spark, base):
    with pytest.raises(ValueError, match="too large"):
        up.upsert(base, base, strategy="broadcast", max_bytes=1)


@pytest.mark.parametrize("strategy", up.STRATEGIES)
def test_defaults_of_new_rows(spark, strategy):
    base = spark.createDataFrame([("a", 1, True, None)], "id string, score int, cleaned boolean, processed boolean")
    incoming = spark.createDataFrame([("a", 2), ("b", 3)], "id string, score int")
    assert sorted(map(tuple, up.upsert(base, incoming, strategy=strategy).collect())) == [("a", 2, True, None), ("b", 3, False, False)]


def test_upsert_is_idempotent(spark, base):
    incoming = spark.createDataFrame([("b", "z"), ("d", "w")], "id string, text string")
    once = up.upsert(base, incoming)
    assert sorted(map(tuple, up.upsert(once, incoming).collect())) == sorted(map(tuple, once.collect()))


def test_unknown_columns_are_refused(spark, base):
    with pytest.raises(ValueError, match="Columns not in the table"):
        up.upsert(base, spark.createDataFrame([("a", 1)], "id string, extra int"))


def test_small_batches_leave_the_base_table_unshuffled(spark, base):
    plan = up.upsert(base, base.limit(1))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan


def test_store_comments_with_reference_check(spark):
    posts = spark.createDataFrame([("p1",), ("p2",)], "id string")
    stored = tables.empty_table(spark, "comment")
    items = spark.createDataFrame(
        [("c1", "p1", "t", "2024-01-02T03:04:05Z"), ("c2", "gone", "t", None), (None, "p2", "t", None),
         ("c3", "p2", "t", "2024-01-02T03:04:05+02:00")], "id string, submission_id string, text string, created_utc string")
    result = up.store_batch(stored, items, "comment", posts=posts, run_ts="2024-02-01T00:00:00")
    assert tuple(result.counts.first()) == (2, 2)
    rows = {r.id: r for r in result.table.select(
        "id", "processed", F.unix_timestamp("created_utc").alias("at"), F.unix_timestamp("processed_at").alias("done")).collect()}
    assert set(rows) == {"c1", "c3"} and rows["c1"].processed
    assert rows["c1"].at - rows["c3"].at == 7200 and rows["c1"].done == 1706745600
    assert result.rejected.count() == 2
    assert result.table.schema.fieldNames() == stored.schema.fieldNames()


def test_snapshots_and_lookup(spark, base, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(base, path)
    with pytest.raises(Exception):
        tables.write_snapshot(base, path)
    found = tables.by_id(spark.read.parquet(path), "b")
    assert found.count() == 1 and tables.by_id(base, "zz").count() == 0
    assert "EqualTo(id,b)" in found._jdf.queryExecution().executedPlan().toString()


def test_read_json_and_lexicon(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"id":"c1","text":"x","score":3,"parent_id":"t3_p","is_root":true,"other":1}\n')
    row = tables.read_json_records(spark, str(tmp_path / "c.json"), COMMENTS_RAW).first()
    assert (row.id, row.score, row.submission_id) == ("c1", 3, None)
    (tmp_path / "lex.txt").write_text('good\t1.9\t0.9\t[1, 2]\n:"\t-1.5\t0.5\t[0]\n')
    assert {r.token: r.valence for r in tables.read_lexicon(spark, str(tmp_path / "lex.txt")).collect()} == {
        "good": 1.9, ':"': -1.5}


NASTY = [("ab12", ' lead, "quoted" and \\ back\\" ', 1), ("ab34", "line\nbreak\r\nand ; tab\t", None),
         ("cd12", "", 2), ("ab1", None, 3), ("é🚀xy", "emoji 🚀", 4), ("ef56", "\\N", 5), ("ef78", "\\\\N", 6)]
ITEMS = "id string, text string, score long"


@pytest.mark.parametrize("compress", [True, False])
def test_batch_round_trip(spark, tmp_path, compress):
    df = spark.createDataFrame(NASTY, ITEMS).withColumn("created_utc", F.lit("2024-01-02 03:04:05.678901").cast("timestamp"))
    store = csvstore.CsvStore(spark, str(tmp_path), compress)
    done = store.store_batch(df, "submission", "b1")
    assert (done["success"], done["failure"], done["batch_id"]) == (7, 0, "b1")
    again = store.store_batch(df.limit(1), "submission", "b1")
    back = store.retrieve_batch(done["path"], df.schema)        # the earlier write stays
    assert again["path"] != done["path"] and again["path"].startswith(store.batch_path("submission", "b1"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert bool(list((tmp_path / "submissions_csv").rglob("*.csv.gz"))) == compress


def test_empty_batch_has_no_id(spark, tmp_path):
    store = csvstore.CsvStore(spark, str(tmp_path))
    assert store.store_batch(spark.createDataFrame([], ITEMS), "comment") == {"success": 0, "failure": 0}
    with pytest.raises(ValueError):
        store.store_batch(spark.createDataFrame([], ITEMS), "page")


def test_failed_batch_tells_why(spark, tmp_path):
    (tmp_path / "submissions_csv").write_text("a file, not a folder")
    done = csvstore.CsvStore(spark, str(tmp_path)).store_batch(spark.createDataFrame(NASTY, ITEMS), "submission", "b")
    assert (done["success"], done["failure"], done["batch_id"]) == (0, None, "b") and done["error"]


def test_items_by_folder(spark, tmp_path):
    df = spark.createDataFrame(NASTY + [(None, "no id", 0)], ITEMS)
    store = csvstore.CsvStore(spark, str(tmp_path))
    assert store.store_items(df, "comment", "2024-02-01T00:00:00").count() == 1
    for item_id, text, score in NASTY:
        row = store.retrieve_item(item_id, "comment", df.schema).first()
        assert (row.id, row.text, row.score, row.item_type) == (item_id, text, score, "comment")
    assert store.retrieve_item("ab99", "comment", df.schema).count() == 0
    plan = store.retrieve_item("ab12", "comment", df.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(s1" in plan.replace("\n", " ")
    newer = spark.createDataFrame([("ab12", "second", 7)], ITEMS)
    store.store_items(newer, "comment", "2024-03-01T00:00:00")
    assert store.retrieve_item("ab12", "comment", df.schema).first().text == "second"
    latest = {r.id: r.text for r in store.latest_items("comment", df.schema).collect()}
    assert latest == {**{item_id: text for item_id, text, _ in NASTY}, "ab12": "second"}


def test_iso_times(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T02:00:00+02:00",), ("nonsense",)], "t string")
    parsed = [r[0] for r in df.select(F.unix_timestamp(dates.parse_iso(F.col("t")))).collect()]
    assert parsed == [1704067200, 1704067200, None]
    assert df.select(dates.format_iso(dates.parse_iso(F.col("t")))).first()[0] == "2024-01-01T00:00:00.000000Z"


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_parents_of_any_number_move_no_text(spark, monkeypatch, max_rows):
    items = spark.createDataFrame([(f"c{i}" if i % 9 else None, f"p{i % 30}" if i % 7 else None, "text " * 20) for i in range(400)],
                                  "id string, submission_id string, text string")
    posts = spark.createDataFrame([(f"p{i}",) for i in range(0, 40, 2)] * 2 + [(None,)], "id string")
    monkeypatch.setattr(up, "settled_side", lambda d: scale.settled_side(d, max_rows=max_rows))
    checked = up.check_reference(items, posts)
    want = lambda r: r["id"] is not None and r["submission_id"] is not None and int(r["submission_id"][1:]) % 2 == 0
    rows = checked.collect()
    assert len(rows) == 400 and all(r["accepted"] == want(r) for r in rows)
    known = sum(r["submission_id"] is not None and int(r["submission_id"][1:]) % 2 == 0 for r in rows)
    assert up.accepted_comments(items, posts).count() == known and up.rejected_comments(items, posts).count() == 400 - known
    assert up.accepted_comments(items, posts).columns == items.columns
    moved, _ = exchanged_columns(checked)
    assert all("text" not in columns for columns in moved)


def test_latest_versions_and_compaction(spark, tmp_path):
    items = spark.createDataFrame([(f"id{i:04d}" if i else "x", f'text "{i}"\nline two', i) for i in range(60)], "id string, text string, score long")
    store = csvstore.CsvStore(spark, str(tmp_path))
    store.store_items(items, "comment", "2024-01-01T00:00:00")
    store.store_items(items.filter("score % 2 = 0").withColumn("score", F.col("score") + 1000), "comment", "2024-01-02T00:00:00")
    want = sorted((r["id"], r["text"], r["score"] + (1000 if r["score"] % 2 == 0 else 0)) for r in items.collect())
    got = lambda: sorted((r["id"], r["text"], r["score"]) for r in store.latest_items("comment", items.schema).collect())
    assert got() == want
    moved, _ = exchanged_columns(store.latest_items("comment", items.schema))
    assert moved and all("text" not in columns for columns in moved)
    before = store.read_items("comment", items.schema)
    old = store.compact("comment", items.schema)
    assert len(old) == 1 and before.count() == 90       # readers that began before still see the old table
    assert store.read_items("comment", items.schema).count() == 60 and got() == want
    store.store_items(items.limit(1).withColumn("score", F.lit(7).cast("long")), "comment", "2024-01-03T00:00:00")
    assert store.read_items("comment", items.schema).count() == 61 and len(store.compact("comment", items.schema)) == 2
    assert store.read_items("comment", items.schema).count() == 60 and 7 in {r[2] for r in got()}
    assert store.retrieve_item("id0004", "comment", items.schema).first()["score"] in (1004, 7)
