from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posada.audit import Audit
from posada.sinks.tables import (content_digest, export_extracts, publish, read_table, truncate_texts, truncation_counts, verify,
                                 verify_contents, write_json, write_tables)
from posada.sources.landing import infer_types, land, land_all, read_csv
from posada.sources.runlog import log_excerpt, parse_log, read_log
from posada.sources.store import Store, condition, read_json, scan, union_batches
from posada.staging import Stage, staging_folder


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


# ------------------------------------------------------------------ landing

def test_land_infers_types_and_leaves_empty_columns_out(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,price,vacio,nota,texto,codigo\n1,"$1,000.00",,4.5,"dos\nlíneas, ""sí""",007\n'
        '2,NA,,nan,None,12\n3,"$2.00",N/A,7,x,\n', encoding="utf-8")
    count = land(spark, str(tmp_path / "a.csv"), str(tmp_path / "landed"), ["id"])
    assert count.ok and count.file_rows == 3
    df = spark.read.parquet(str(tmp_path / "landed"))
    assert df.dtypes == [("id", "bigint"), ("price", "string"), ("nota", "double"),
                         ("texto", "string"), ("codigo", "bigint")]
    assert rows_of(df) == [(1, "$1,000.00", 4.5, 'dos\nlíneas, "sí"', 7), (2, None, None, None, 12),
                           (3, "$2.00", 7.0, "x", None)]


def test_tokens_can_be_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,NA\n", encoding="utf-8")
    assert read_csv(spark, str(tmp_path / "a.csv"), na_tokens=None).first()["name"] == "NA"


def test_mixed_column_is_text(spark):
    df = spark.createDataFrame([("1", "1"), ("x", "2.5")], "a string, b string")
    assert infer_types(df).dtypes == [("a", "string"), ("b", "double")]


def test_long_numbers_survive(spark, tmp_path):
    digits = {18: "bigint", 19: "bigint", 20: "string"}
    lines = [",".join(f"c.{n}" for n in digits)]
    lines += [",".join("1" * (n - 1) + str(i) for n in digits) for i in range(4)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    assert land(spark, str(tmp_path / "a.csv"), str(tmp_path / "landed")).ok
    df = spark.read.parquet(str(tmp_path / "landed"))
    assert df.dtypes == [(f"c.{n}", t) for n, t in digits.items()]
    for n in digits:
        assert {str(r[0]) for r in df.select(f"`c.{n}`").collect()} == {"1" * (n - 1) + str(i) for i in range(4)}


def test_schema_and_line_breaks(spark, tmp_path):
    (tmp_path / "calendar.csv").write_text('id,note\n1,"a\nb"\nx,c\n', encoding="utf-8")
    schema = T.StructType([T.StructField("id", T.LongType())])
    counts = land_all(spark, {"calendar": str(tmp_path / "calendar.csv")}, str(tmp_path / "out"), schemas={"calendar": schema})
    assert counts[0].file_rows == 2
    assert {r["id"] for r in spark.read.parquet(str(tmp_path / "out" / "calendar")).collect()} == {1, None}


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        land_all(spark, {"listings": str(tmp_path / "none.csv.gz")}, str(tmp_path / "out"))


# ------------------------------------------------------------------ store

@pytest.fixture
def store(spark, tmp_path):
    days = spark.createDataFrame([(1, f"2026-07-0{d}", "t") for d in range(1, 8)],
                                 "listing_id long, date string, available string")
    spark.range(5).withColumn("_id", F.lit("x")).write.parquet(str(tmp_path / "Listings"))
    days.write.parquet(str(tmp_path / "Calendar"))
    return Store(spark, str(tmp_path))


def test_store_lists_and_counts(store):
    assert store.names() == ["Calendar", "Listings"]
    assert store.counts(["Calendar", "Listings"]) == {"Calendar": 7, "Listings": 5}


def test_internal_id_never_comes_out(store):
    assert store.scan("Listings").columns == ["id"]


def test_filter_and_projection_reach_the_scan(store):
    df = store.scan("Calendar", {"date": {"$gte": "2026-07-05"}}, {"date": 1})
    assert df.columns == ["date"] and df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2026-07-05)" in plan and "ReadSchema: struct<date:string>" in plan


def test_unknown_collection(store):
    with pytest.raises(ValueError):
        store.scan("NoExiste")


@pytest.mark.parametrize("where, ids", [
    ({"v": {"$gt": 2, "$lte": 4}}, [3, 4]), ({"v": 2}, [2]), ({"v": {"$ne": 2}}, [1, 3, 4, 5]),
    ({"v": {"$in": [1, 5]}}, [1, 5]), ({"v": {"$lt": 2}}, [1]), ("v > 4", [5]), (None, [1, 2, 3, 4, 5]),
    ({}, [1, 2, 3, 4, 5]), ({"v": None}, [5])])
def test_conditions(spark, where, ids):
    df = spark.createDataFrame([(i, i) for i in range(1, 5)] + [(5, 5)], "id int, v int")
    if where == {"v": None}:
        df = df.withColumn("v", F.when(F.col("id") < 5, F.col("v")))
    assert [r[0] for r in rows_of(scan(df, where).select("id"))] == ids


def test_unknown_comparison(spark):
    with pytest.raises(ValueError):
        condition({"v": {"$regex": "x"}})


def test_union_of_batches_with_different_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, 9)], "id int, w int")
    assert rows_of(union_batches([a, b]), "id") == [(1, "x", None), (2, None, 9)]


def test_batches_of_different_types_widen_without_loss(spark):
    big = (1 << 60) + 1
    batches = [spark.createDataFrame([(1, 5, 2, "x", True)], "k int, a long, b long, c string, d boolean"),
               spark.createDataFrame([(big, 2.5, 7.5, 1, "t")], "k long, a double, b double, c int, d string"),
               spark.createDataFrame([(3, None, big, None, None)], "k short, a float, b long, c string, d string")]
    for order in (batches, batches[::-1]):
        df = union_batches(order)
        assert dict(df.dtypes) == {"k": "bigint", "a": "double", "b": "string", "c": "string", "d": "string"}
        assert sorted(map(tuple, df.collect())) == sorted(
            [(1, 5.0, "2", "x", "true"), (big, 2.5, "7.5", "1", "t"), (3, None, str(big), None, None)])


def test_types_are_decided_once_over_all_batches(spark, tmp_path):
    texts = ["id,v,w\n1,10,a\n2,,b\n", "id,v,x\n3,2.5,9\n", "id,v\n4,7\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(text, encoding="utf-8")
    count = land(spark, [str(tmp_path / f"{i}.csv") for i in range(3)], str(tmp_path / "out"), ["id"])
    assert count.ok and count.file_rows == 4
    df = spark.read.parquet(str(tmp_path / "out"))
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "w": "string", "x": "bigint"}
    assert rows_of(df.select("id", "v", "w", "x"), "id") == [(1, 10.0, "a", None), (2, None, "b", None), (3, 2.5, None, 9),
                                                          (4, 7.0, None, None)]


def test_collections_with_different_files(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "id int, v string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(2, 9)], "id int, w int").write.mode("append").parquet(str(tmp_path / "t"))
    df = Store(spark, str(tmp_path), merge_schemas=True).table("t").select("id", "v", "w")
    assert rows_of(df, "id") == [(1, "x", None), (2, None, 9)]


# ------------------------------------------------------------------ sinks

@pytest.fixture
def tables(spark):
    listings = spark.createDataFrame([(1, 100.0, None), (2, None, 1), (3, 300.0, 2)],
                                     "id long, price double, bedrooms long")
    reviews = spark.createDataFrame([(1, 10, "bueno\n\"sí\""), (1, 11, "x" * 40_000)],
                                    "listing_id long, id long, comments string")
    days = spark.createDataFrame([(1, f"2026-07-0{d}") for d in range(1, 6)],
                                 "listing_id long, date string")
    return {"listings": listings, "reviews": reviews, "calendar": days}


def test_publish_twice_gives_the_same_tables(spark, tables, tmp_path):
    for _ in range(2):
        report = publish(spark, tables, str(tmp_path / "t"))
    assert rows_of(report, "tabla") == [("calendar", 5, 5, None, True), ("listings", 3, 3, None, True),
                                        ("reviews", 2, 2, None, True)]


def test_extracts_are_whole(spark, tables, tmp_path):
    groups = {"a": ["listings", "reviews", "absent"], "b": ["calendar"], "c": ["none"]}
    exported = export_extracts(tables, str(tmp_path / "x"), groups, max_rows=2)
    assert set(exported) == set(tables) and not (tmp_path / "x" / "c").exists()
    assert len(list((tmp_path / "x" / "b" / "calendar").glob("part-*.csv"))) >= 3
    for name, path in exported.items():
        back = spark.read.schema(tables[name].schema).csv(path, header=True, multiLine=True, escape='"')
        assert sorted(map(str, back.collect())) == sorted(map(str, tables[name].collect()))


def test_extracts_can_be_shortened(spark, tables, tmp_path):
    audit = Audit()
    exported = export_extracts(tables, str(tmp_path / "x"), {"a": ["reviews"]}, max_chars=32_767, audit=audit)
    back = spark.read.csv(exported["reviews"], header=True, multiLine=True, escape='"')
    assert back.where("id = 11").select(F.length("comments")).first()[0] == 32_767
    assert [n for _, _, n in audit.findings] == [1]


def test_truncation(spark, tables):
    assert rows_of(truncation_counts(tables["reviews"], 32_767)) == [("comments", 1)]
    assert truncation_counts(tables["listings"], 32_767).count() == 0
    assert truncate_texts(tables["reviews"], 3).where("id = 10").first()["comments"] == "bue"


def test_verification_sees_differences(spark, tables, tmp_path):
    root = str(tmp_path / "t")
    rows = write_tables(tables, root)
    exported = export_extracts(tables, str(tmp_path / "x"))
    assert all(r["ok"] and r["exportado"] == r["esperado"] for r in
               verify(spark, rows, root, exported).collect())
    wrong = verify(spark, {**rows, "listings": 6, "ausente": 1}, root).collect()
    assert {r["tabla"]: (r["almacenado"], r["ok"]) for r in wrong} == {
        "listings": (3, False), "reviews": (2, True), "calendar": (5, True), "ausente": (None, False)}


def test_partitioned_table(spark, tables, tmp_path):
    days = tables["calendar"].withColumn("mes", F.lit(7))
    write_tables({"calendar": days}, str(tmp_path), partition_by={"calendar": ["mes"]})
    assert (tmp_path / "calendar" / "mes=7").exists()


def test_one_month_reads_its_own_files_only(spark, tmp_path):
    days = spark.range(20_000).select((F.col("id") % 400).alias("listing_id"), F.date_add(F.lit("2031-01-01").cast("date"),
                                      (F.col("id") % 365).cast("int")).cast("string").alias("date")) \
        .withColumns({"anio": F.substring("date", 1, 4).cast("long"), "mes": F.substring("date", 6, 2).cast("long")})
    write_tables({"calendar": days}, str(tmp_path))
    back = read_table(spark, str(tmp_path / "calendar"), days.schema)
    assert back.dtypes == days.dtypes and back.count() == 20_000
    month = back.where("anio = 2031 AND mes = 5")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and "PushedFilters: []" in plan
    files = {r[0] for r in month.select(F.input_file_name()).distinct().collect()}
    assert files and all("mes=5/" in f for f in files) and len(files) < len(list((tmp_path / "calendar").rglob("*.parquet"))) / 6


def test_files_hold_ranges_of_the_lookup_column(spark, tmp_path):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        write_tables({"reviews": spark.range(8000).select((F.col("id") * 7919 % 8000).alias("listing_id"), "id")}, str(tmp_path))
    finally:
        spark.conf.unset(setting)
    spans = spark.read.parquet(str(tmp_path / "reviews")).groupBy(F.input_file_name().alias("file")).agg(
        F.min("listing_id").alias("low"), F.max("listing_id").alias("high")).orderBy("low").collect()
    assert len(spans) > 1 and all(a["high"] < b["low"] for a, b in zip(spans, spans[1:]))


def test_a_changed_cell_is_told(spark, tables, tmp_path):
    root = str(tmp_path / "t")
    written = write_tables(tables, root)
    assert all(r["igual"] for r in verify_contents(spark, written, root).collect())
    tables["listings"].withColumn("price", F.when(F.col("id") == 3, 300.01).otherwise(F.col("price"))) \
        .write.mode("overwrite").parquet(f"{root}/listings")
    told = {r["tabla"]: (r["esperado"], r["almacenado"], r["ok"]) for r in verify(spark, written, root).collect()}
    assert told == {"listings": (3, 3, False), "reviews": (2, 2, True), "calendar": (5, 5, True)}
    moved = spark.createDataFrame([(1, None, 7)], "a int, b int, c int"), spark.createDataFrame([(1, 7, None)], "a int, b int, c int")
    assert len({df.agg(content_digest(df.columns)).first()[0] for df in moved}) == 2
    # The order of rows and columns and the number of files make no difference.
    tables["reviews"].select("comments", "id", "listing_id").repartition(2).write.mode("overwrite").parquet(f"{root}/reviews")
    assert verify_contents(spark, {"reviews": written["reviews"]}, root).first()["igual"]


def test_digest_is_the_sum_of_the_row_hashes_without_a_decimal_for_every_row(spark):
    df = spark.range(-500, 500).select("id", F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("t"))
    row = F.xxhash64("id", "t", F.isnull("id"), F.isnull("t"))
    want = sum(r[0] for r in df.select(row).collect())
    digest = df.agg(content_digest(["t", "id"]).alias("digest"))
    assert digest.first()["digest"] == want
    assert "as decimal(38,0)))" not in digest._jdf.queryExecution().optimizedPlan().toString()
    assert df.limit(0).agg(content_digest(df.columns).alias("digest")).first()["digest"] == 0


def test_json_reports(spark, tmp_path):
    write_json(spark.createDataFrame([("a", 1)], "tabla string, n long"), str(tmp_path / "r"))
    assert rows_of(spark.read.json(str(tmp_path / "r"))) == [(1, "a")] or \
        rows_of(spark.read.json(str(tmp_path / "r")).select("tabla", "n")) == [("a", 1)]
    (tmp_path / "m.json").write_text('{\n "precio": {"mediana": 5.0}\n}', encoding="utf-8")
    assert read_json(spark, str(tmp_path / "m.json")).select("precio.mediana").first()[0] == 5.0


# ------------------------------------------------------------------ staging

def test_stage_uses_the_folder_of_the_session(spark):
    with Stage(spark) as stage:
        assert stage.root.startswith(staging_folder(spark))
        kept = stage.put(spark.range(10), "n")
        assert kept.count() == 10


@pytest.mark.parametrize("master", ["spark://somewhere", "local[4]"])
def test_a_session_must_name_its_folder(master):
    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        staging_folder(SimpleNamespace(conf=conf, sparkContext=context))


# ------------------------------------------------------------------ run log

def _lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "pos long, value string")


def test_excerpt_uses_the_last_run(spark):
    start, end = "t | INFO | m | INICIO DEL PROCESO ETL", "t | INFO | m | FIN DEL PROCESO ETL"
    old, new = "t | ERROR | a | falla vieja", "t | ERROR | a | falla nueva"
    plain, path = "t | INFO | a | sin novedad", r"t | WARNING | a | D:\uno\dos\salida\nota.txt"
    got = rows_of(log_excerpt(_lines(spark, [start, old, end, start, plain, new, path, end])), "pos")
    assert [pos for pos, _ in got] == [3, 5, 6, 7]
    assert got[2][1] == r"t | WARNING | a | salida\nota.txt"


def test_excerpt_keeps_the_last_line(spark):
    lines = [f"t | ERROR | a | {'x' * (i % 7)}" for i in range(61)]
    got = rows_of(log_excerpt(_lines(spark, lines), max_lines=10), "pos")
    assert [p for p, _ in got] == [*range(9), 60]
    assert log_excerpt(_lines(spark, ["t | INFO | a | nada"])).count() == 0


def test_parse_log_file(spark, tmp_path):
    (tmp_path / "log.txt").write_text("2026-10-03 10:15:02 | INFO | etl.x | a | b\nsuelta\n",
                                      encoding="utf-8")
    got = parse_log(read_log(spark, str(tmp_path / "log.txt"))).orderBy("pos").drop("pos").collect()
    assert [tuple(r) for r in got] == [("2026-10-03 10:15:02", "INFO", "etl.x", "a | b"),
                                       (None, None, None, None)]
