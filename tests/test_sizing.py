"""Staged tables: deleted by the context that staged them only; broadcast decided by bytes."""

import threading

from driftwood.operators import sizing


def test_scopes_of_threads_are_their_own(spark):
    inside, go_on, kept = threading.Event(), threading.Event(), {}

    def batch():
        with sizing.discarding(spark):
            kept["inner"] = sizing.materialize(spark.range(3), "inner")
            inside.set()
            go_on.wait(60)
    t = threading.Thread(target=batch)
    t.start()
    assert inside.wait(60)
    other = sizing.materialize(spark.range(5), "outer")  # while the other thread's block is open
    with sizing.discarding(spark):
        gone = sizing.materialize(spark.range(7), "gone")
        assert gone.count() == 7
    go_on.set()
    t.join()
    assert other.count() == 5
    for df in (kept["inner"], gone):
        path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0])
        assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_settled_keeps_the_result_alone(spark):
    made = []

    def build():
        made.append(sizing.materialize(spark.range(4), "step"))
        return made[0].withColumn("x", made[0]["id"] + 1)
    out = sizing.settled(spark, build)
    assert sorted(r.x for r in out.collect()) == [1, 2, 3, 4]
    path = spark._jvm.org.apache.hadoop.fs.Path(made[0].inputFiles()[0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_bytes_decide(spark):
    words = spark.range(100).selectExpr("concat('w', id, repeat('x', 1000)) AS word", "array('ab', 'c') AS parts", "CAST(null AS STRING) AS n")
    size = sizing.table_bytes(words)
    assert 100_000 < size < 130_000
    assert sizing.bounded_broadcast(words, size)[1] and not sizing.bounded_broadcast(words, size - 1)[1]
    assert sizing.table_bytes(words.limit(0)) == 0
