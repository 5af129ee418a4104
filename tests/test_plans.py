"""What the physical plans must look like, whatever the size of the tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from trackflow.checks import track_queries
from trackflow.operators.features import st_index
from trackflow.operators.ranges import points_within
from trackflow.operators.sinks import write_features
from trackflow.plans.documents import documents, marked_lines, session_lines, staged
from trackflow.plans.outputs import read_output, tagged_outputs, write_outputs
from trackflow.plans.tracks import indexed_track_points, normalized_messages, rejected_messages
from trackflow.session import shared_folder
from trackflow.sources.adapters import raw_messages

PYTHON_NODES = re.compile(r"Python|Pandas|ArrowEval")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def messages(spark, folder, tmp_path):
    path = str(tmp_path / "raw")
    raw_messages(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def xml(spark):
    return spark.createDataFrame([("m", "<TrackMessage/>")], "message_id string, xml string")


def exchanges_with_text(plan):
    """Shuffles whose input still holds the text of the lines."""
    lines = plan.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = lines[i + 1]
            if re.search(r"\bline#\d+(,|\])|\btext#\d+|\bline#\d+ AS|AS line#", below):
                found.append(line.strip(" :+-"))
    return found


def test_lines_move_once_for_framing_and_once_for_assembly(without_broadcast, messages):
    found = exchanges_with_text(plan_of(documents(messages)))
    assert len(found) == 2
    assert re.match(r"Exchange hashpartitioning\(channel#\d+L, session_start#\d+L", found[0])
    assert re.match(r"Exchange hashpartitioning\(channel#\d+L, block#\d+L", found[1])


def test_framing_moves_the_lines_once(without_broadcast, messages):
    assert len(exchanges_with_text(plan_of(session_lines(messages)))) == 1


def test_narrow_passes_read_no_text_from_a_staged_table(without_broadcast, messages):
    plan = plan_of(documents(messages, stage=True))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) >= 3
    assert sum("line:string" in schema for schema in schemas) == 1


def test_staged_table_lies_in_the_shared_folder(spark, messages):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(f"{folder}/x-")
    files = staged(marked_lines(messages)).inputFiles()
    assert files and all(f"{folder}/lines-" in name for name in files)


def test_a_message_is_parsed_once(xml):
    plan = plan_of(normalized_messages(xml))
    typed = [line for line in plan.splitlines() if "from_xml(StructField(messageSecurity" in line]
    assert len(typed) == 1 and typed[0].count("from_xml(StructField(messageSecurity") == 1
    assert plan.count("regexp_extract_all") > 1 and "CASE WHEN exists" in plan


def test_track_points_need_the_typed_parse_only(xml):
    plan = plan_of(indexed_track_points(xml))
    assert plan.count("from_xml(") == 1 and plan.count("regexp_extract_all") == 1  # of the roots


def test_all_outputs_come_from_one_pass(spark, xml, tmp_path):
    plan = plan_of(tagged_outputs(xml, ["message_id"]))
    assert plan.count("from_xml(StructField(messageSecurity") == 1
    assert plan.count("from_xml(VariantType") == 1 and plan.count("from_xml(") == 2
    assert "Exchange" not in plan and not PYTHON_NODES.search(plan)
    path = str(tmp_path / "outputs")
    write_outputs(xml, path, ["message_id"])
    read = plan_of(read_output(spark, path, "point"))
    assert re.search(r"PartitionFilters: \[[^\]]*kind#\d+ = point", read)


def test_rejects_need_no_second_parse(xml):
    assert plan_of(rejected_messages(xml)).count("from_xml(") == 1


def test_normalisation_needs_no_shuffle(xml):
    assert "Exchange" not in plan_of(st_index(track_queries.track_points(normalized_messages(xml))))


@pytest.mark.parametrize(
    "name",
    ["assemble", "assign_sessions", "session_lines_for", "apply_status", "track_points",
     "rejected_messages", "concat_json", "to_track_xml", "sql_functions",
     "message_json", "rewrite_track_xml", "track_children"],
)
def test_no_python_in_the_plan(spark, folder, name):
    assert not PYTHON_NODES.search(plan_of(entry_point.queries()[name](spark, folder)))


def test_a_box_is_read_by_years_and_key_ranges(spark, folder, tmp_path):
    path = str(tmp_path / "features")
    write_features(st_index(track_queries.track_points_query(spark, folder)), path, partitions=4)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = plan_of(points_within(spark.read.parquet(path), *track_queries.BOX))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    years = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S).group(1)
    assert "time_bin" in years and "1995" in years and "1997" in years
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan, re.S).group(1)
    assert "Or(" in pushed and pushed.count("GreaterThanOrEqual(st_key,") > 20


def test_feature_files_are_pruned_by_year_and_skipped_by_key(spark, folder, tmp_path):
    path = str(tmp_path / "features")
    points = st_index(track_queries.track_points_query(spark, folder))
    write_features(points, path, partitions=4)
    read = spark.read.parquet(path).where((F.col("time_bin") == 1996) & (F.col("st_key") < 1000))
    plan = plan_of(read)
    assert re.search(r"PartitionFilters: \[[^\]]*time_bin#\d+ = 1996", plan)
    assert "LessThan(st_key,1000)" in plan
    stored = spark.read.parquet(path)
    assert stored.count() == points.count()
    bounds = (
        stored.groupBy(F.input_file_name().alias("file"), "time_bin")
        .agg(F.min("st_key").alias("low"), F.max("st_key").alias("high"))
        .where("time_bin IS NOT NULL")
        .orderBy("time_bin", "low")
        .collect()
    )
    for before, after in zip(bounds, bounds[1:]):
        assert before.time_bin != after.time_bin or before.high <= after.low


def test_plain_messages_are_not_parsed(spark, tmp_path):
    """The parser gets only messages that are not plain; all others go by patterns."""
    from trackflow.plans.tracks import message_points, valid_documents
    from trackflow.sources.adapters import track_xml

    path = str(tmp_path / "xml")
    track_xml(spark, "/root/testdata/sf0.001").write.parquet(path)
    texts = spark.read.parquet(path)
    for df in (message_points(texts), valid_documents(texts)):
        plan = plan_of(df)
        assert plan.count("from_xml(") == 1 and "CASE WHEN isnull(" in plan
    assert "NOT coalesce(RLIKE(" in plan_of(rejected_messages(texts))


def test_header_parse_reads_no_items(spark, folder):
    plan = plan_of(entry_point.queries()["header"](spark, folder))
    assert "from_xml(" in plan and "trackItemUUID,StringType" not in plan
