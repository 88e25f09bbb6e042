import pytest
from pyspark.sql import functions as F

from tests.conftest import exchanged_columns
from threadlens import scale


def test_shared_folder_is_the_named_one(spark):
    assert scale.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scale.scratch_path(spark, "x") != scale.scratch_path(spark, "x")


def test_without_a_shared_folder_there_is_an_error():
    class Context:
        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scale.shared_dir(Session())


def test_measuring_collects_no_rows(spark, monkeypatch):
    seen = []
    plain = type(spark.range(1)).agg

    def agg(self, *columns):
        result = plain(self, *columns)
        seen.append(result._jdf.queryExecution().executedPlan().toString())
        return result

    monkeypatch.setattr(type(spark.range(1)), "agg", agg)
    scale.broadcast_if_small(spark.range(100, numPartitions=7))
    assert len(seen) == 1 and "Limit" not in seen[0] and "partial_count" in seen[0]


def test_broadcast_follows_the_measured_size(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 100).alias("v"))
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(scale.broadcast_if_small(df))
    assert not hinted(scale.broadcast_if_small(df, max_bytes=1000))
    assert not hinted(scale.broadcast_if_small(df, max_rows=49))
    assert hinted(scale.broadcast_if_small(df, max_rows=50))


def _worded(spark, parts=5):
    rows = [(i, f"Word{i % 7} common w{i} common", None if i % 5 == 0 else f"second {i} w{i + 1}", i * 1.5) for i in range(200)]
    return spark.createDataFrame(rows + [(None, None, None, None), (3, "", "repeated", 0.0), (3, "", "repeated", 0.0)],
                                 "id long, text string, other string, score double").repartition(parts)


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_dictionary_table_moves_words_and_hits_only(spark, max_rows):
    df = _worded(spark).withColumn("_k", F.lit("clash"))
    entries = {f"w{i}": i for i in range(0, 300, 2)} | {"common": -1, "nowhere": 5}
    table = spark.createDataFrame([(k, v) for k, v in entries.items()] + [("w2", 0), (None, 1), ("w4", None)], "token string, v int")
    split = lambda column: F.coalesce(F.split(F.lower(column), " "), F.array().cast("array<string>"))
    joined, lookup = scale.attach_dictionary(df, lambda rows: [split(rows["text"]), split(rows["other"])], table, "token", "v", max_rows=max_rows)
    out = joined.select("id", "text", "other", "score", "_k", F.transform(F.concat(split(F.col("text")), split(F.col("other"))), lookup).alias("found"))
    words = lambda r: [w for t in (r["text"], r["other"]) if t is not None for w in t.lower().split(" ")]
    want = [(*tuple(r), [entries.get(w) for w in words(r)]) for r in df.collect()]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
    moved, plan = exchanged_columns(out)
    assert all(not columns & {"text", "other", "score"} for columns in moved)
    assert (len([c for c in moved if scale.ROW in c]) == 0) == (max_rows > 0)
    assert "Exchange" in plan and "Bucketed: true" in plan


def test_layout_of_an_empty_table(spark):
    assert scale.laid_out(_worded(spark).limit(0)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("laid_out")]


def test_files_of_a_layout_fill_its_buckets_evenly(spark):
    bucket = F.pmod(F.hash(scale.PART), F.lit(16)).alias("bucket")
    for parts, per_bucket in ((16, {1}), (5, {1}), (40, {2, 3})):
        rows = scale.laid_out(spark.range(0, 400, 1, parts), buckets=16)
        files = rows.groupBy(bucket).agg(F.countDistinct(F.shiftright(scale.ROW, 33)).alias("n")).collect()
        assert {f["n"] for f in files} == per_bucket and sum(f["n"] for f in files) == parts
        assert rows.select(scale.PART, scale.ROW).distinct().count() == 400


def test_bytes_of_rows(spark):
    df = spark.createDataFrame([("éa", 1, ["x"]), (None, None, None)], "t string, n int, a array<string>")
    small, large = sorted(r[0] for r in df.select(scale.row_bytes(df)).collect())
    assert small >= 48 and large >= small + 3
    side, broadcast = scale.settled_side(df)
    assert broadcast and side.count() == 2 and not scale.settled_side(df, max_rows=1)[1] and not scale.settled_side(df, max_bytes=10)[1]


def test_inline_lookup_finds_every_entry_and_no_other(spark):
    entries = {f"k{i}é": float(i) for i in range(300)}
    lookup = scale.inline_lookup(entries, "double")
    df = spark.range(400).select(F.concat(F.lit("k"), F.col("id").cast("string"), F.lit("é")).alias("k"))
    got = {r.k: r.v for r in df.select("k", lookup(F.col("k")).alias("v")).collect()}
    assert {k: v for k, v in got.items() if v is not None} == entries


def test_spread_leaves_wide_inputs_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert scale.spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    wide = spark.range(10, numPartitions=cores + 1)
    assert scale.spread(wide) is wide


def test_filters_and_columns_pass_a_mapped_projection(spark):
    df = spark.createDataFrame([("1", "A", "B")], "id string, a string, b string")
    row = scale.map_columns(df, {"x": "a", "y": "b"}, F.lower).first()
    assert (row.x, row.y, row.a) == ("a", "b", "A")
