"""Child-to-parent checks behind a key filter: the plain rows, with less shuffled."""

from pyspark.sql import functions as F

from riskmart.operators import membership, references


def shuffled(spark, df) -> int:
    """Bytes written to shuffles by a run."""
    sc = spark.sparkContext._jsc.sc()

    def so_far():
        sc.listenerBus().waitUntilEmpty()
        none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
        stages = sc.statusStore().stageList(
            None, False, False, none, spark.sparkContext._jvm.java.util.ArrayList()
        )
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = so_far()
    df.write.format("noop").mode("overwrite").save()
    return so_far() - before


def tables(spark):
    parent = spark.range(40_000).select(F.concat(F.lit("P"), "id").alias("key"), F.col("id").alias("x"))
    # A third of the rows has one key without parent; one key is null; repeated rows stay repeated.
    child = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "lost")
        .when(F.col("id") == 1, None)
        .otherwise(F.concat(F.lit("P"), F.col("id") * 7))
        .alias("key"),
        (F.col("id") % 100).alias("n"),
        F.sha2(F.col("id").cast("string"), 512).alias("wide"),
    )
    return child, parent


def test_same_rows_and_fewer_bytes_shuffled(spark):
    child, parent = tables(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plain, filtered in (
            (references.orphans, membership.orphans_filtered),
            (references.referenced, membership.referenced_filtered),
        ):
            a, b = plain(child, parent, "key"), filtered(child, parent, "key")
            assert a.columns == b.columns
            assert a.count() == b.count() > 0
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
            assert shuffled(spark, b) < 0.5 * shuffled(spark, a)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_key_of_the_table_is_missed_and_few_others_pass(spark):
    _, parent = tables(spark)
    found = membership.key_filter(parent, "key")
    assert found.may_hold(parent, "key").filter(~F.col(membership.MAY)).isEmpty()
    others = spark.range(20_000).select(F.concat(F.lit("Q"), "id").alias("key"))
    assert found.may_hold(others, "key").filter(membership.MAY).count() < 400


def test_a_filter_beyond_its_bound_or_of_other_types_is_not_used(spark):
    child, parent = tables(spark)
    assert membership.key_filter(parent, "key", max_bytes=1000) is None
    assert membership.orphans_filtered(child, parent, "key", max_bytes=1000).count() == \
        references.orphans(child, parent, "key").count()
    numbers = spark.createDataFrame([(0.0,), (-0.0,), (2.0,)], "key double")
    held = spark.createDataFrame([(0,)], "other int")
    assert [r.key for r in membership.orphans_filtered(numbers, held, "key", "other").collect()] == [2.0]


def test_empty_sides_and_a_parent_key_of_another_name(spark):
    child, parent = tables(spark)
    assert membership.orphans_filtered(child, parent.limit(0), "key").count() == 60_000
    assert membership.referenced_filtered(child, parent.limit(0), "key").isEmpty()
    assert membership.orphans_filtered(child.limit(0), parent, "key").isEmpty()
    named = parent.withColumnRenamed("key", "id")
    assert membership.orphans_filtered(child, named, "key", "id").count() == \
        references.orphans(child, parent, "key").count()
