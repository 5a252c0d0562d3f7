"""
grow with the number of columns, and nothing data-sized reaches the driver."""

import uuid

from tablescout.operators import joinpaths, profile


def _jobs(spark, run) -> int:
    sc = spark.sparkContext
    group = f"structure-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def _tables(spark, width: int):
    cols = ", ".join(f"c{j} string" for j in range(width))
    a = spark.createDataFrame([tuple(str((i * (j + 1)) % 17) for j in range(width)) for i in range(40)], cols)
    b = spark.createDataFrame([tuple(str((i + j) % 13) for j in range(width)) for i in range(30)], cols)
    return [a, b]


def _run(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def test_join_discovery_jobs_do_not_grow_with_columns(spark):
    counts = []
    for width in (3, 30):
        tables = _tables(spark, width)
        counts.append(
            _jobs(spark, lambda: _run(joinpaths.multi_set_resemble(tables, 0, containing_check=True, seed=1))())
        )
    assert counts[0] == counts[1], counts


def test_exact_paths_and_profiles_jobs_do_not_grow_with_columns(spark):
    for build in (
        lambda t: joinpaths.joining_path_naive(t),
        lambda t: profile.cat_describe(t[0]),
        lambda t: profile.value_count_long(t[0]),
        lambda t: profile.null_count(t[0], None),
    ):
        counts = [_jobs(spark, _run(build(_tables(spark, w)))) for w in (3, 30)]
        assert counts[0] == counts[1], counts
