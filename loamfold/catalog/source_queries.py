"""Queries for readers, writers and the incremental store."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from loamfold.catalog.registry import Tables, query
from loamfold.catalog.scalar_queries import soil_documents
from loamfold.functions.documents import parse_document
from loamfold.functions.fixed import TARGETS
from loamfold.operators import columns
from loamfold.session import fresh_path
from loamfold.sources import readers, writers
from loamfold.streaming.enrich import enrich_available

SAMPLE_COLUMNS = ["ID", "Latitude", "Longitude", "Depth_cm", "start_date", "ph", "C_organic", "Al"]
SAMPLE_SQL = f"SELECT {', '.join(SAMPLE_COLUMNS)} FROM samples"


def _no_blanks(df):
    """CSV reads an empty text as missing, so the source is written without blanks."""
    return df.withColumn("ph", F.nullif("ph", F.lit("")))


BLANKLESS = SAMPLE_SQL.replace("ph,", "nullif(ph, '') AS ph,")


@query("scan_csv", BLANKLESS, "samples")
def scan_csv(t: Tables):
    samples = _no_blanks(t.view("samples").select(*SAMPLE_COLUMNS))
    path = fresh_path(t.spark, "samples-csv")
    writers.write_csv(samples, path)
    return readers.read_csv(t.spark, path, samples.schema)


@query("scan_csv_pruned", "SELECT ID, Latitude, Longitude FROM samples", "samples")
def scan_csv_pruned(t: Tables):
    samples = t.view("samples").select(*SAMPLE_COLUMNS)
    path = fresh_path(t.spark, "samples-csv")
    writers.write_csv(samples, path)
    return readers.read_csv(t.spark, path, samples.schema, ["ID", "Latitude", "Longitude"])


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_parquet(t: Tables):
    return readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    "scan_json_docs",
    """SELECT CAST(s_suppkey AS VARCHAR) AS "key", s_suppkey % 9 <> 4 AND s_suppkey % 17 <> 3 AND s_suppkey % 23 <> 7 AS usable
       FROM supplier""",
)
def scan_json_docs(t: Tables):
    """Documents with the key in their path; literal nulls, empty objects and cut-off texts are misses."""
    docs = soil_documents(t).select(
        F.col("s_suppkey").cast("string").alias("key"),
        F.when(F.col("s_suppkey") % 23 == 7, F.substring("text", 1, 40)).otherwise(F.col("text")).alias("text"),
    )
    path = fresh_path(t.spark, "documents")
    writers.write_documents(docs, path)
    landed = readers.read_documents(t.spark, path, r"key=([^/]+)/")
    usable = F.coalesce(parse_document(F.col("text"))["properties"].isNotNull(), F.lit(False))
    return landed.select("key", usable.alias("usable"))


@query(
    "scan_jsonl_tolerant",
    "SELECT ID, seq, a, b FROM cache WHERE seq % 10 <> 4",
    "cache",
)
def scan_jsonl_tolerant(t: Tables):
    """Records with varying keys between lines that were cut off."""
    line = F.when(F.col("seq") % 10 == 4, F.lit('{"ID": 12, "a": ')).otherwise(F.to_json(F.struct("ID", "seq", "a", "b")))
    path = fresh_path(t.spark, "cache-lines")
    t.view("cache").select(line.alias("value")).write.text(path)
    return readers.read_json_lines(t.spark, path, "ID long, seq long, a double, b double")


@query(
    "scan_json_list",
    "SELECT CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INT) AS position, p_brand AS name FROM (SELECT DISTINCT p_brand FROM part)",
)
def scan_json_list(t: Tables):
    names = t.table("part").select("p_brand").distinct().agg(F.array_sort(F.collect_list("p_brand")).alias("names"))
    path = fresh_path(t.spark, "names")
    names.select(F.to_json("names").alias("value")).coalesce(1).write.text(path)
    return readers.read_name_list(t.spark, path)


@query("sink_csv", BLANKLESS, "samples")
def sink_csv(t: Tables):
    samples = _no_blanks(t.view("samples").select(*SAMPLE_COLUMNS))
    path = fresh_path(t.spark, "sink-csv")
    writers.write_csv(samples, path)
    return t.spark.read.schema(samples.schema).option("header", True).csv(path)


@query("sink_parquet", f"SELECT ID, Depth_cm, {', '.join(TARGETS)} FROM train", "train")
def sink_parquet(t: Tables):
    path = fresh_path(t.spark, "sink-parquet")
    writers.write_parquet(t.view("train").select("ID", "Depth_cm", *TARGETS), path)
    return t.spark.read.parquet(path)


@query("sink_json", "SELECT site, count(*) AS n, max(Al) AS best FROM train GROUP BY site", "train")
def sink_json(t: Tables):
    table = t.view("train").groupBy("site").agg(F.count("*").alias("n"), F.max("Al").alias("best"))
    path = fresh_path(t.spark, "sink-json")
    writers.write_json(table, path)
    return t.spark.read.schema(table.schema).json(path)


@query(
    "sink_json_list",
    "SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS BIGINT) AS position, name FROM ("
    + " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS name FROM train_numeric HAVING count(DISTINCT {c}) > 1"
        for i, c in enumerate(["site", "Latitude", "Longitude", "electrical_conductivity", "C_organic", "C_total", "ph"])
    )
    + ")",
    "train_numeric",
)
def sink_json_list(t: Tables):
    """The names of the features that vary in the training rows, as one list."""
    train = t.view("train_numeric")
    names = columns.feature_columns(train, TARGETS)
    varies = [F.when(F.min(c) < F.max(c), F.lit(c)) for c in names]
    path = fresh_path(t.spark, "feature-list")
    writers.write_name_list(train.agg(F.array_compact(F.array(*varies)).alias("names")), path)
    return readers.read_name_list(t.spark, path).withColumn("position", F.col("position").cast("bigint"))


@query(
    "source_presence",
    "SELECT DISTINCT replace(p_brand, '#', '-') || '.csv' AS file_name FROM part WHERE p_brand NOT IN "
    "(SELECT p_brand FROM part GROUP BY p_brand HAVING min(p_partkey) % 2 = 0)",
)
def source_presence(t: Tables):
    """Required file names without a landed file: every brand is required, those whose first part key is even have landed."""
    path = fresh_path(t.spark, "landing")
    first = t.table("part").groupBy("p_brand").agg(F.min("p_partkey").alias("first_key"))
    landed = first.where(F.col("first_key") % 2 == 0)
    file_name = F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit(".csv"))
    landed.select(F.lit("x").alias("value"), file_name.alias("name")).write.partitionBy(
        "name"
    ).text(path)
    present = readers.list_folder(t.spark, path, r"name=([^/]+)/")
    required = t.table("part").select(file_name.alias("file_name")).distinct()
    return readers.missing_names(required, present)


@query("memo_table", "SELECT Depth_cm, count(*) AS n FROM train GROUP BY Depth_cm", "train")
def memo_table(t: Tables):
    """The second call reads what the first one stored."""
    path = fresh_path(t.spark, "memo")
    counts = t.view("train").groupBy("Depth_cm").agg(F.count("*").alias("n"))
    writers.memo_table(t.spark, path, lambda: counts)

    def not_again():
        raise AssertionError("the stored table was computed again")

    return writers.memo_table(t.spark, path, not_again)


@query(
    "stream_incremental_enrich",
    """WITH stored AS (SELECT *, row_number() OVER (PARTITION BY ID ORDER BY part, seq DESC) AS rn FROM
         (SELECT *, seq % 3 AS part FROM cache WHERE a IS NOT NULL OR b IS NOT NULL))
       SELECT ID, seq, a, b, coalesce(a, 0e0) + coalesce(b, 0e0) AS total FROM stored WHERE rn = 1""",
    "cache",
)
def stream_incremental_enrich(t: Tables):
    """Three drops of four files each. Two are read in one go, a batch per drop; in between the stream breaks and starts again."""
    cache = t.view("cache")
    root = fresh_path(t.spark, "stream")
    drops, store, checkpoint = f"{root}/drops", f"{root}/store", f"{root}/checkpoint"
    calls = []

    def enrich(batch):
        calls.append(batch)
        # the first call asks for the schema alone; the second, of the first batch, breaks and comes again at the next start
        if len(calls) == 2:
            raise RuntimeError("broken on purpose")
        total = F.coalesce("a", F.lit(0.0)) + F.coalesce("b", F.lit(0.0))
        return batch.withColumn("total", total)

    def run():
        return enrich_available(t.spark, drops, store, checkpoint, cache.schema, "seq", enrich, files_per_batch=4)

    out = None
    for part in range(3):
        cache.where(F.col("seq") % 3 == part).repartition(4).write.mode("append").json(drops)
        if part == 0:
            try:
                run()
            except StreamingQueryException:
                out = run()
            else:
                raise AssertionError("the broken batch was taken for done")
        elif part == 2:
            out = run()
    return out
