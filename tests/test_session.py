"""Work submitted by several threads, and what stored tables leave on disk."""

import os
import time
from threading import Barrier

from pyspark.sql import functions as F

from loamfold import session
from loamfold.session import side_by_side


def test_each_call_has_local_properties_of_its_own(spark):
    started = Barrier(4)

    def work(number):
        spark.sparkContext.setLocalProperty("loamfold.number", str(number))
        started.wait(60)
        return spark.sparkContext.getLocalProperty("loamfold.number"), spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    assert side_by_side(spark, work, range(4), 4) == [(str(n), f"side-{n}") for n in range(4)]


def test_shuffle_files_go_with_the_write(spark):
    """What a stored table was shuffled through is removed when it is written, not when the driver collects its garbage."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    name = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(local.getAllFiles()) if f.getName().startswith("shuffle_")}
    before = name()
    table = session.stored(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count(), "counted")
    until = time.time() + 10
    while name() - before and time.time() < until:
        time.sleep(0.1)
    assert not name() - before and table.count() == 1000 and spark.conf.get(session.CLEANUP) == "false"


def test_a_dropped_table_is_gone(spark):
    kept, gone = (session.stored(spark.range(n), "some") for n in (3, 5))
    path = session._PATHS[gone]
    assert os.path.exists(path)
    session.drop_stored(gone)
    assert not os.path.exists(path) and path not in session._STORED and kept.count() == 3
