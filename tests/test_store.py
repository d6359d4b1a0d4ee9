"""Vector store tables: create, append, read, rewrite, drop."""

import os

import pytest
from pyspark.sql import functions as F

from sparkvec.operators import search
from sparkvec.sources import store as st
from sparkvec.sources.documents import documents_from_list, read_documents


def rows(spark, n=10, dim=3):
    return spark.createDataFrame(
        [(f"text {i}", f'{{"n": {i}}}', [float(i)] * dim, i) for i in range(n)],
        "document_text string, metadata string, embedding array<float>, pos int",
    )


@pytest.fixture
def table(spark):
    name = "store_under_test"
    st.create_vector_store(
        spark, st.VectorStoreConfig(name, dimensions=3, distance="Euclidean", drop_if_exists=True)
    )
    yield name
    st.drop_table(spark, name)


def test_create_reports_settings(spark):
    got = st.create_vector_store(spark, st.VectorStoreConfig("made", 7, drop_if_exists=True))
    assert (got["table"], got["dimensions"], got["distance_metric"]) == ("made", 7, "cosine")
    assert len(got["schema"]) == 6
    assert st.vector_config(spark, "made") == {"dimensions": 7, "distance_metric": "cosine"}
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        st.create_vector_store(spark, st.VectorStoreConfig("made", 7))
    assert st.drop_table(spark, "made") and not st.table_exists(spark, "made")
    assert st.drop_table(spark, "made")


@pytest.mark.parametrize("name", ["", "1a", "a-b", "a b", "a;drop", "x" * 65, "é"])
def test_bad_table_names(spark, name):
    with pytest.raises(ValueError):
        st.create_vector_store(spark, st.VectorStoreConfig(name))


@pytest.mark.parametrize("config", [{"dimensions": 0}, {"dimensions": 65536}, {"distance": "dot"}])
def test_bad_settings(spark, config):
    with pytest.raises(ValueError):
        st.create_vector_store(spark, st.VectorStoreConfig("t", **config))


def test_insert_dense_ids_continue(spark, table):
    assert st.insert_embeddings(spark, table, rows(spark), order_by="pos") == 10
    assert st.insert_embeddings(spark, table, rows(spark, 4), order_by="pos") == 4
    got = spark.table(table).orderBy("id").collect()
    assert [r.id for r in got] == list(range(14))
    assert got[3].document_text == "text 3" and got[12].document_text == "text 2"
    assert all(r.created_at == r.updated_at for r in got)


def test_insert_ids_without_order_are_unique(spark, table):
    st.insert_embeddings(spark, table, rows(spark, 30).repartition(4))
    st.insert_embeddings(spark, table, rows(spark, 30).repartition(4).drop("metadata"))
    assert spark.table(table).select("id").distinct().count() == 60
    assert spark.table(table).filter("metadata = '{}'").count() == 30


def test_bad_rows_leave_nothing_behind(spark, table):
    bad = rows(spark, 5).unionByName(
        spark.createDataFrame([("x", "{}", [1.0], 9)], rows(spark, 1).schema)
    )
    with pytest.raises(Exception, match="not 3 numbers"):
        st.insert_embeddings(spark, table, bad)
    with pytest.raises(Exception, match="is NULL"):
        st.insert_embeddings(spark, table, rows(spark).withColumn("document_text", F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="missing"):
        st.insert_embeddings(spark, table, rows(spark).drop("embedding"))
    with pytest.raises(ValueError, match="exist"):
        st.insert_embeddings(spark, "nowhere", rows(spark))
    assert spark.table(table).count() == 0


def test_info_listing_and_lookup(spark, table):
    spark.range(3).write.mode("overwrite").saveAsTable("plain")
    st.insert_embeddings(spark, table, rows(spark), order_by="pos")
    assert {"plain", table} <= set(st.list_tables(spark))
    assert table in st.list_vector_tables(spark) and "plain" not in st.list_vector_tables(spark)
    info = st.table_info(spark, table)
    assert info["row_count"] == 10 and len(info["columns"]) == 6
    assert [r.id for r in info["sample_data"].collect()] == [0, 1, 2, 3, 4]
    assert info["vector_config"] == {"dimensions": 3, "distance_metric": "euclidean"}
    record = st.get_record_by_id(spark, table, 4)
    assert record["metadata"] == {"n": 4} and "embedding" not in record
    assert st.get_record_by_id(spark, table, 99) is None


def test_delete(spark, table):
    st.insert_embeddings(spark, table, rows(spark), order_by="pos")
    assert st.delete_records(spark, table, "id >= :low", {"low": 7}) == 3
    assert st.delete_records(spark, table, "nullif(id, id) = 1") == 0
    assert [r.id for r in spark.table(table).orderBy("id").collect()] == list(range(7))
    assert st.vector_config(spark, table)["dimensions"] == 3
    st.insert_embeddings(spark, table, rows(spark, 1), order_by="pos")
    assert st.get_record_by_id(spark, table, 7)["document_text"] == "text 0"


def folder_of(spark, table):
    return st._properties(spark, table)["vector.folder"].removeprefix("file:")


def files_of(spark, table, *ids):
    df = spark.table(table).where(F.col("id").isin(*ids)) if ids else spark.table(table)
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_failed_rewrite_changes_nothing(spark, table):
    st.insert_embeddings(spark, table, rows(spark), order_by="pos")
    broken = "CASE WHEN id = 5 THEN raise_error('boom') IS NULL ELSE id = 1 END"
    with pytest.raises(Exception, match="boom"):
        st.delete_records(spark, table, broken)
    old = st._folders(st._with_folder(spark.table(table)))
    with pytest.raises(Exception, match="boom"):
        bad = F.when(F.col("id") == 5, F.raise_error(F.lit("boom")).cast("string"))
        st._replace(spark, table, st._folder(spark, table), old, spark.table(table).withColumn("metadata", bad))
    assert spark.table(table).filter("metadata is not null").count() == 10
    assert len(os.listdir(folder_of(spark, table))) == 1


def test_changes_leave_other_files_alone(spark, table):
    st.insert_embeddings(spark, table, rows(spark, 40), order_by="pos", slices=4)
    before = files_of(spark, table)
    assert len(before) == 4
    untouched = before - files_of(spark, table, 3, 17)
    assert st.delete_records(spark, table, "id = 3") == 1 and st.update_metadata(spark, table, 17, {"a": 1})
    updates = spark.createDataFrame([(4, '{"b": 2}'), (999, "{}")], "id long, metadata string")
    assert st.update_metadata_bulk(spark, table, updates) == 1
    after = files_of(spark, table)
    assert untouched <= after and len(after) == 4 and not (before - untouched) & after
    assert st.delete_records(spark, table, "id < 10") == 9
    assert len(files_of(spark, table)) == 3 and spark.table(table).count() == 30
    assert st.delete_records(spark, table, "true") == 30 and spark.table(table).count() == 0
    assert os.listdir(folder_of(spark, table)) == []
    assert st.insert_embeddings(spark, table, rows(spark, 2), order_by="pos") == 2


def test_ids_are_checked_in_their_ranges_only(spark, table):
    st.insert_embeddings(spark, table, rows(spark, 40), order_by="pos", slices=4)
    given = rows(spark, 3).withColumn("id", F.col("pos").cast("long") + 38)
    with pytest.raises(ValueError, match="twice"):
        st.insert_embeddings(spark, table, given)
    assert len(os.listdir(folder_of(spark, table))) == 1
    assert st.insert_embeddings(spark, table, given.where("pos > 1")) == 1
    # the check reads the slices that may hold the ids, and no others
    assert len(spark.table(table).where(st._may_hold(0, 5)).select("id").inputFiles()) >= 1
    plan = spark.table(table).where(st._may_hold(0, 5)).select("id")
    scanned = {r[0] for r in plan.select("_metadata.file_path").distinct().collect()}
    assert scanned == files_of(spark, table, 0)


def test_bad_ids_and_metadata_are_refused(spark, table):
    plain = rows(spark, 3).withColumn("id", F.col("pos").cast("long"))
    with pytest.raises(Exception, match="id is NULL"):
        st.insert_embeddings(spark, table, plain.withColumn("id", F.when(F.col("pos") != 1, F.col("id"))))
    with pytest.raises(Exception, match="not JSON"):
        st.insert_embeddings(spark, table, plain.withColumn("metadata", F.lit("{a")))
    st.insert_embeddings(spark, table, plain)
    with pytest.raises(Exception, match="not JSON"):
        st.update_metadata_bulk(spark, table, spark.createDataFrame([(1, "[")], "id long, metadata string"))
    assert st.get_record_by_id(spark, table, 1)["metadata"] == {"n": 1}


def test_a_job_killed_in_its_commit(spark, table, monkeypatch):
    """Before the change is decided the old rows stay; after, the next look at the table finishes it."""
    st.insert_embeddings(spark, table, rows(spark, 20), order_by="pos", slices=2)

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(st, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            st.insert_embeddings(spark, table, rows(spark, 5), order_by="pos")
        with pytest.raises(KeyboardInterrupt):
            st.delete_records(spark, table, "id in (1, 15)")
    assert spark.table(table).count() == 20
    with monkeypatch.context() as patch:
        patch.setattr(st, "_settle", lambda *args: None)
        st.delete_records(spark, table, "id in (1, 15)")
    assert spark.table(table).count() == 20
    # half of the change is made, and the process ends
    journal = st._properties(spark, table)["vector.change"]
    change = st.json.loads(spark.read.parquet(journal).head()["change"])
    name, folder = next(iter(change["move"].items()))
    spark.sql(f"ALTER TABLE {table} PARTITION ({st.SLICE} = '{name}') SET LOCATION '{folder}'")
    assert st.table_info(spark, table)["row_count"] == 18
    assert "vector.change" not in st._properties(spark, table) and spark.table(table).count() == 18


def test_commands_report_and_check_every_insert(spark, table):
    st.insert_embeddings(spark, table, rows(spark, 4), order_by="pos")
    columns = "id, document_text, metadata, embedding, created_at, updated_at"
    source = f"SELECT id + 4 AS id, document_text, metadata, embedding, created_at, updated_at FROM {table}"
    assert st.execute_command(spark, f"WITH s AS ({source}) INSERT INTO {table} SELECT * FROM s") == 4
    assert st.execute_command(spark, f"-- note; insert into x\n/* insert */ INSERT INTO {table} ({columns}) {source} WHERE id >= 4") == 4
    with pytest.raises(ValueError, match="twice"):
        st.execute_command(spark, f"INSERT INTO {table} SELECT * FROM {table}")
    with pytest.raises(ValueError, match="overwritten"):
        st.execute_command(spark, f"INSERT OVERWRITE {table} SELECT * FROM {table}")
    more = f"INSERT INTO {table} (id, document_text, embedding) VALUES (:id, 'it''s (new)', array(1, 2, 3))"
    assert st.execute_command(spark, more, {"id": 77}) == 1
    assert st.get_record_by_id(spark, table, 77)["document_text"] in ("it's (new)", "its (new)")
    assert spark.table(table).count() == spark.table(table).select("id").distinct().count() == 13
    st.execute_command(spark, "CREATE TABLE plain_t (a INT, b STRING) USING parquet")
    assert st.execute_command(spark, "INSERT INTO plain_t VALUES (1, 'x'), (2, 'insert into')") == 2
    assert st.execute_command(spark, "insert overwrite plain_t (b) select 'y'") == 1
    assert [tuple(r) for r in spark.table("plain_t").collect()] == [(None, "y")]
    st.drop_table(spark, "plain_t")


def test_promoted_keys_reach_the_scan(spark):
    keys = {"lang": "string", "n": "number", "ok": "boolean", "a.b": "string"}
    st.create_vector_store(spark, st.VectorStoreConfig("promoted", dimensions=1, drop_if_exists=True, promoted=keys))
    documents = ['{"lang": "de", "n": 1}', '{"lang": 1, "n": "1"}', '{"ok": true, "a": {"b": "x"}}', '{"n": 1.0, "ok": "true"}', f'{{"n": {2**60}}}', f'{{"n": {2**60 + 1}}}', None]
    df = spark.createDataFrame([(i, f"t{i}", m, [1.0]) for i, m in enumerate(documents)], "id long, document_text string, metadata string, embedding array<float>")
    st.insert_embeddings(spark, "promoted", df)
    cases = [{"lang": "de"}, {"lang": 1}, {"n": 1}, {"n": "1"}, {"n": [1, "1"]}, {"ok": True}, {"ok": "true"}, {"a.b": "x"}, {"n": 2**60}, {"n": 1, "lang": "de"}]
    for case in cases:
        by_column = search.search_by_metadata("promoted", case).collect()
        by_json = search.search_by_metadata(spark.table("promoted"), case).collect()
        assert [r.id for r in by_column] == [r.id for r in by_json], case
        assert by_json, case
    found = search.search_by_metadata("promoted", {"lang": ["de", "fr"], "n": 1}, top_k=5000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "meta_0" in pushed and "meta_1" in pushed
    st.update_metadata(spark, "promoted", 0, {"lang": "fr"})
    assert search.search_by_metadata("promoted", {"lang": "de"}).collect() == []
    assert [r.id for r in search.search_by_metadata("promoted", {"lang": "fr"}).collect()] == [0]
    st.drop_table(spark, "promoted")
    with pytest.raises(ValueError, match="promoted"):
        st.create_vector_store(spark, st.VectorStoreConfig("promoted", promoted={"a": "date"}))


def test_update_replaces_metadata(spark, table):
    st.insert_embeddings(spark, table, rows(spark), order_by="pos")
    assert st.update_metadata(spark, table, 2, {"a": "b"})
    assert not st.update_metadata(spark, table, 77, {"a": "b"})
    assert st.get_record_by_id(spark, table, 2)["metadata"] == {"a": "b"}
    new = spark.createDataFrame([(3, '{"z": 1}'), (50, "{}")], "id long, metadata string")
    assert st.update_metadata_bulk(spark, table, new) == 1
    assert st.get_record_by_id(spark, table, 3)["metadata"] == {"z": 1}
    assert st.get_record_by_id(spark, table, 4)["metadata"] == {"n": 4}
    assert spark.table(table).filter("updated_at > created_at").count() == 2


def test_optimize_keeps_rows_and_one_generation(spark, table):
    for _ in range(3):
        st.insert_embeddings(spark, table, rows(spark).repartition(3), order_by="pos")
    before = {tuple(r[:3]) for r in spark.table(table).collect()}
    got = st.optimize_table(spark, table, rows_per_file=20)
    assert got == {"table": table, "status": "optimized", "row_count": 30}
    assert {tuple(r[:3]) for r in spark.table(table).collect()} == before
    assert len(spark.table(table).inputFiles()) == 2
    folder = st._properties(spark, table)["vector.folder"].removeprefix("file:")
    assert len(os.listdir(folder)) == 1


def test_files_are_bounded_by_bytes_too(spark, table, monkeypatch):
    monkeypatch.setattr(st, "BYTES_PER_FILE", 5000)
    long = rows(spark).withColumn("document_text", F.repeat(F.col("document_text"), 250))
    st.insert_embeddings(spark, table, long.repartition(3), order_by="pos")
    before = {tuple(r[:3]) for r in spark.table(table).collect()}
    assert st.optimize_table(spark, table)["row_count"] == 10
    assert {tuple(r[:3]) for r in spark.table(table).collect()} == before
    assert len(spark.table(table).inputFiles()) > 1


def test_search_by_table_name(spark, table):
    """The table's own metric, and winners fetched by id."""
    st.insert_embeddings(spark, table, rows(spark, 30), order_by="pos")
    found = search.semantic_search(table, [3.2, 3.2, 3.2], top_k=12, include_distance=True)
    got = found.collect()
    assert [r.id for r in got][:5] == [3, 4, 2, 5, 1]
    assert got[0].distance == pytest.approx(0.2 * 3**0.5, abs=1e-6)  # euclidean
    assert [r.document_text for r in got] == [f"text {r.id}" for r in got]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(In(id, [" in plan and "embedding" not in plan.split("ReadSchema")[1]
    near = search.semantic_search(table, [3.2, 3.2, 3.2], distance_threshold=1.0)
    assert [r.id for r in near.collect()] == [3]
    assert [r.id for r in search.find_similar_documents(table, 8, top_k=2).collect()] == [7, 9]
    newest = search.search_by_metadata(table, {"n": [4, 9]}).collect()
    assert [r.id for r in newest] == [4, 9]
    assert search.search_by_metadata(table, {"n": "none"}).collect() == []


def test_parameterised_sql(spark, table):
    st.insert_embeddings(spark, table, rows(spark), order_by="pos")
    got = st.execute_query(spark, f"SELECT id FROM {table} WHERE id < ? ORDER BY id", [2])
    assert [r.id for r in got.collect()] == [0, 1]
    assert st.execute_command(spark, "CREATE TABLE IF NOT EXISTS other_t (a INT) USING parquet") == 0
    assert st.table_exists(spark, "other_t")
    st.drop_table(spark, "other_t")


def test_read_documents(spark, tmp_path):
    docs = documents_from_list(spark, ["a, b", 'say "hi"\nthere', "c"])
    for fmt in ("parquet", "json", "csv", "orc"):
        path = str(tmp_path / fmt)
        writer = docs.write.option("header", "true").option("escape", '"')
        writer.format(fmt).save(path)
        got = read_documents(spark, path, source_format=fmt)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    (tmp_path / "one.txt").write_text("line 1\nline 2")
    got = read_documents(spark, str(tmp_path / "one.txt"), source_format="text").collect()
    assert [r.text for r in got] == ["line 1\nline 2"]
    with pytest.raises(ValueError):
        read_documents(spark, "x", source_format="avro")
